"""Rules of sources, mapping, alignment, completion and the work ledger."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from aggrex.functions.geometry import canonical_geometry, target_keeps_geometry
from aggrex.operators.align import import_status, latest_per_id
from aggrex.operators.completion import merge_ledger
from aggrex.operators.mapping import map_rates_in_place, map_rates_per_extract
from aggrex.schemas import DATA_POINT, RATE_MAPPING
from aggrex.sources import io
from aggrex.streaming.incremental import pending_batches, reopen_units


def _dp(spark, rows):
    return spark.createDataFrame(rows, DATA_POINT)


def test_write_extract_replaces_only_written_partitions(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="aggrex-t-"), "extracts")
    a = _dp(spark, [("DATA_ELEMENT", "D1", "202401", "O1", "C", "A", None, "AGGREGATED", "1"),
                    ("DATA_ELEMENT", "D1", "202402", "O1", "C", "A", None, "AGGREGATED", "2")])
    io.write_extract(a, root, "x", F.col("period"))
    b = _dp(spark, [("DATA_ELEMENT", "D1", "202402", "O1", "C", "A", None, "AGGREGATED", "9")])
    written = io.write_extract(b, root, "x", F.col("period")).collect()
    assert [r["extract_period"] for r in written] == ["202402"]
    got = {(r["period"], r["value"]) for r in io.read_extract_table(spark, root).collect()}
    assert got == {("202401", "1"), ("202402", "9")}
    one = io.scan_extracts_for_period(spark, root, "202401").collect()
    assert [r["value"] for r in one] == ["1"]


def test_scan_extract_refuses_empty(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="aggrex-t-"), "empty")
    _dp(spark, []).write.parquet(path)
    with pytest.raises(ValueError):
        io.scan_extract(spark, path)


def test_rate_mapping_overlap_is_refused(spark):
    m = spark.createDataFrame([(None, "A", "REPORTING_RATE", "B", "c", "a"),
                               (None, "B", "REPORTING_RATE", "C", "c", "a")], RATE_MAPPING)
    df = _dp(spark, [("REPORTING_RATE", "A", "202401", "O", None, None, "REPORTING_RATE", "AGGREGATED", "1")])
    with pytest.raises(ValueError):
        map_rates_in_place(df, m)


def test_rate_mapping_with_holes_is_refused_only_for_present_datasets(spark):
    df = _dp(spark, [("REPORTING_RATE", "A", "202401", "O", None, None, "REPORTING_RATE", "AGGREGATED", "100")])
    df = df.withColumn("extract_id", F.lit("E"))
    ok = spark.createDataFrame([("E", "A", "REPORTING_RATE", "U", "c", "a"),
                                ("E", "Z", "REPORTING_RATE", None, "c", "a")], RATE_MAPPING)
    row = map_rates_per_extract(df, ok).collect()[0]
    assert (row["dx_uid"], row["value"], row["value_num"]) == ("U", "1", 1.0)
    bad = spark.createDataFrame([("E", "A", "REPORTING_RATE", "U", None, "a")], RATE_MAPPING)
    with pytest.raises(ValueError):
        map_rates_per_extract(df, bad)


def test_status_rules_per_generation(spark):
    df = spark.createDataFrame([("CREATE", "a", '{"status":"OK"}'), ("CREATE", "b", '{"status":"WARNING"}'),
                                ("CREATE", "c", '{"status":"ERROR"}'), ("CREATE", "d", None),
                                ("UPDATE", "e", "not json")], "action string, id string, body string")
    got = {r["id"]: (r["status"], r["success"], r["success_gen1"]) for r in import_status(df).collect()}
    assert got["a"] == ("OK", True, True)
    assert got["b"] == ("WARNING", False, True)
    assert got["c"] == ("ERROR", False, False)
    assert got["d"] == ("NOTVALID", False, False)
    assert got["e"] == (None, False, True)


def test_geometry_is_compared_without_key_order(spark):
    df = spark.createDataFrame([('{"type":"Point","coordinates":[1,2]}',), ('{"coordinates": [1, 2], "type": "Point"}',)],
                               "g string")
    canon = [r[0] for r in df.select(canonical_geometry("g")).collect()]
    assert canon[0] == canon[1] == "Point|[1.0,2.0]"
    assert df.select(canonical_geometry("g", keep=False)).first()[0] is None
    assert target_keeps_geometry("2.100") and not target_keeps_geometry("2.32")


def test_last_row_per_id_wins(spark):
    df = spark.createDataFrame([("x", "old", 1), ("x", "new", 2), ("y", "only", 5)], "id string, name string, k int")
    got = {r["id"]: r["name"] for r in latest_per_id(df, "k").collect()}
    assert got == {"x": "new", "y": "only"}


def test_ledger_appends_are_idempotent(spark):
    unit = "dataset string, period string, org_unit string"
    existing = spark.createDataFrame([("D", "2024", "A"), ("D", "2024", None)], unit)
    processed = spark.createDataFrame([("D", "2024", "A"), ("D", "2024", "B"), ("D", "2024", "B"), ("E", "2024", "A")],
                                      unit)
    new = merge_ledger(existing, processed)
    assert sorted(tuple(r) for r in new.collect()) == [("D", "2024", "B"), ("E", "2024", "A")]
    assert merge_ledger(existing.unionByName(new), processed).count() == 0


def test_pending_units_and_reopen(spark):
    t = dt.datetime
    req = spark.createDataFrame([("202401", t(2024, 2, 1)), ("202402", t(2024, 3, 1)), ("202402", t(2024, 3, 9))],
                                "unit string, requested_at timestamp")
    fin = spark.createDataFrame([("202401", t(2024, 2, 5)), ("202402", t(2024, 3, 5))],
                                "unit string, finished_at timestamp")
    got = {r["unit"]: r["n_open_requests"] for r in pending_batches(req, fin).collect()}
    assert got == {"202402": 1}
    again = req.unionByName(reopen_units(spark.createDataFrame([("202401",)], "unit string"), "2024-04-01 00:00:00"))
    got = {r["unit"]: r["n_open_requests"] for r in pending_batches(again, fin).collect()}
    assert got == {"202401": 1, "202402": 1}


def test_micro_batch_replay_does_not_duplicate(spark):
    from aggrex.streaming.incremental import push_batch, read_payloads
    out = os.path.join(tempfile.mkdtemp(prefix="aggrex-t-"), "push")
    rows = [("DATA_ELEMENT", "D", "202401", f"O{i}", "C", "A", None, "AGGREGATED", str(i) if i % 4 else None)
            for i in range(50)]
    df = _dp(spark, rows).withColumn("extract_id", F.lit("E"))
    run = push_batch(lambda d: d, out, max_post=7)
    run(df, 3)
    first = sorted(tuple(r) for r in read_payloads(spark, out).collect())
    run(df, 3)  # the same micro-batch again, as after a failure
    again = sorted(tuple(r) for r in read_payloads(spark, out).collect())
    assert first == again
    assert sum(r["n_points"] for r in read_payloads(spark, out).collect()) == 50


def test_unknown_types_are_set_aside(spark):
    from aggrex.streaming.incremental import push_batch, read_payloads
    out = os.path.join(tempfile.mkdtemp(prefix="aggrex-t-"), "push")
    df = _dp(spark, [("DATA_ELEMENT", "D", "202401", "O1", "C", "A", None, "AGGREGATED", "1"),
                     ("INDICATOR", "I", "202401", "O1", None, None, None, "AGGREGATED", "2")]
             ).withColumn("extract_id", F.lit("E"))
    push_batch({"DATA_ELEMENT": lambda d: d}, out, max_post=10)(df, 0)
    assert sum(r["n_points"] for r in read_payloads(spark, out).collect()) == 1
    unknown = spark.read.parquet(os.path.join(out, "unknown_types")).collect()
    assert [r["data_type"] for r in unknown] == ["INDICATOR"]


def test_unreadable_extract_files_are_listed_and_skipped(spark):
    import glob
    from aggrex.streaming.incremental import incremental_push, read_payloads, read_unreadable_files
    base = tempfile.mkdtemp(prefix="aggrex-t-")
    root = os.path.join(base, "extracts")
    df = _dp(spark, [("DATA_ELEMENT", "D", "202401", "O1", "C", "A", None, "AGGREGATED", "1")])
    io.write_extract(df, root, "x", F.col("period"))
    folder = glob.glob(os.path.join(root, "*", "*", "extract_period=202401"))[0]
    with open(os.path.join(folder, "part-broken.parquet"), "wb") as fh:
        fh.write(b"truncated upload")
    bad = [r["path"] for r in io.unreadable_files(spark, root).collect()]
    assert len(bad) == 1 and bad[0].endswith("part-broken.parquet")
    q = incremental_push(spark, root, os.path.join(base, "out"), os.path.join(base, "ckpt"), lambda d: d, max_post=5,
                         skip_unreadable=True)
    q.awaitTermination()
    assert sum(r["n_points"] for r in read_payloads(spark, os.path.join(base, "out")).collect()) == 1
    aside = read_unreadable_files(spark, os.path.join(base, "out")).collect()
    assert len(aside) == 1 and aside[0]["path"].endswith("part-broken.parquet") and aside[0]["error"]
    with pytest.raises(Exception):  # by default nothing is skipped: the stream fails
        incremental_push(spark, root, os.path.join(base, "out2"), os.path.join(base, "ckpt2"), lambda d: d,
                         max_post=5).awaitTermination()


def test_partly_readable_extract_is_set_aside_whole(spark):
    from aggrex.registry.incremental_q import damage
    base = tempfile.mkdtemp(prefix="aggrex-t-")
    rows = [("DATA_ELEMENT", "D", "202401", f"O{i}", "C", "A", None, "AGGREGATED", str(i * 7919)) for i in range(5000)]
    io.write_extract(_dp(spark, rows).coalesce(1), os.path.join(base, "x"), "x", F.col("period"), files_per_partition=1)
    damage(spark, os.path.join(base, "x"), os.path.join(base, "y", "part-0.parquet"))
    assert len(io.unreadable_files(spark, os.path.join(base, "y")).collect()) == 1
    assert io.unreadable_files(spark, os.path.join(base, "x")).count() == 0


def test_switching_scale_factor_in_one_session(spark):
    import __spark_entry__ as entry
    q = entry.queries()
    small, mid = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
    n_small = spark.read.parquet(f"{small}/orders.parquet").count()
    n_mid = spark.read.parquet(f"{mid}/orders.parquet").count()
    assert q["b1_normalise_data_values"](spark, small).count() == n_small
    assert q["b1_normalise_data_values"](spark, mid).count() == n_mid
    assert q["h9_to_number_or_null"](spark, small).where("src = 'priority'").count() == n_small
    assert q["b1_normalise_data_values"](spark, small).count() == n_small


def test_org_unit_payloads_send_parents_first(spark):
    from aggrex.operators.align import create_payloads, ordered_for_sending
    units = spark.createDataFrame([
        ("C1", "c", "c", "2001-01-01", None, "N1", 4, None), ("N1", "n", "n", "2001-01-01", None, "R1", 3, None),
        ("R1", "r", "r", "2001-01-01", None, "ROOT", 2, '{"type":"Point","coordinates":[1,2]}')],
        "id string, name string, shortName string, openingDate string, closedDate string, parent_id string, "
        "level int, geometry string")
    out = ordered_for_sending(create_payloads(units)).collect()
    assert [r["id"] for r in out] == ["R1", "N1", "C1"]
    assert out[0]["payload"] == ('{"id":"R1","name":"r","shortName":"r","openingDate":"2001-01-01",'
                                 '"parent":{"id":"ROOT"},"geometry":{"type":"Point","coordinates":[1,2]}}')


def test_unknown_category_combos_are_refused(spark):
    from aggrex.plans.extraction import require_known_combos
    unknown = spark.createDataFrame([("CC_GONE",)], "cat_combo string")
    with pytest.raises(ValueError):
        require_known_combos(unknown)
    require_known_combos(unknown, allow_unfiltered=True)
    require_known_combos(unknown.where("false"))


def test_yearly_rewrite_requeues_the_runs_months_of_that_year(spark):
    from aggrex.functions.periods import frequency_of
    from aggrex.streaming.incremental import changed_units
    written = spark.createDataFrame(
        [("DATA_ELEMENT", "e", p) for p in ("2024", "202503", "2024W5", "2024W12", "2024Q1", "2023")],
        "data_type string, extract_id string, extract_period string").withColumn(
        "frequency", frequency_of("extract_period"))
    run = spark.createDataFrame([("202401",), ("202402",), ("202503",)], "month string")
    assert sorted(r["unit"] for r in changed_units(written, run).collect()) == [
        "202401", "202402", "2024Q1", "2024W12", "2024W5", "202503"]
    assert sorted(r["unit"] for r in changed_units(written).collect()) == [
        "2023", "2024", "2024Q1", "2024W12", "2024W5", "202503"]


def test_first_generation_rate_plan_honours_frequency(spark):
    from aggrex.plans.extraction import rate_month_plan
    from aggrex.schemas import RATE_ITEM
    from aggrex.sources.config import rate_item_rows
    cfg = {"RATE_UIDS": {"DSM": {"METRICS": {"REPORTING_RATE": "float"}, "FREQUENCY": "Monthly"},
                         "DSY": {"METRICS": ["ACTUAL_REPORTS"], "FREQUENCY": "Yearly"}}}
    items = spark.createDataFrame(rate_item_rows(cfg), RATE_ITEM)
    got = sorted((r["rate_key"], r["month"], r["period"]) for r in rate_month_plan(items, "202411", "202501").collect())
    assert got == [("DSM.REPORTING_RATE", "202411", "202411"), ("DSM.REPORTING_RATE", "202412", "202412"),
                   ("DSM.REPORTING_RATE", "202501", "202501"), ("DSY.ACTUAL_REPORTS", "202411", "2024"),
                   ("DSY.ACTUAL_REPORTS", "202412", "2024"), ("DSY.ACTUAL_REPORTS", "202501", "2025")]


def test_scale_settings_size_partitions_from_the_input():
    from aggrex.session import scale_settings
    big = scale_settings(100 * 1024 ** 4)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 << 20)
    assert scale_settings(10)["spark.sql.shuffle.partitions"] == "200"


def test_second_generation_configuration(spark):
    from aggrex.sources import config as cfg
    conf = cfg.load_configuration("""{
      "SETTINGS": {"MAX_POST": 500},
      "REPORTING_RATES": {"EXTRACTS": [
        {"EXTRACT_UID": "E1", "DATASET_UID": "DS1", "METRICS": ["REPORTING_RATE"], "PERIOD_WINDOW": 3,
         "PERIOD_FREQUENCY": "MONTHLY",
         "MAPPINGS": {"DS1": {"REPORTING_RATE": {"UID": "T1", "CAT_OPTION_COMBO": "c", "ATTR_OPTION_COMBO": "a"}}}}
      ]}}""")
    dims = cfg.config_dimensions(spark, conf)
    assert dims["settings"]["MAX_POST"] == 500
    assert [tuple(r) for r in dims["rate_mapping"].collect()] == [("E1", "DS1", "REPORTING_RATE", "T1", "c", "a")]
    items = dims["rate_items"].collect()
    assert [(r["extract_uid"], r["dataset_uid"], r["metrics"], r["period_window"]) for r in items] == \
        [("E1", "DS1", ["REPORTING_RATE"], 3)]


def test_work_ledger_queue_operations(spark):
    from aggrex.streaming.incremental import finish_units, next_pending, request_units
    empty_req = spark.createDataFrame([], "unit string, requested_at timestamp")
    empty_fin = spark.createDataFrame([], "unit string, finished_at timestamp")
    u = spark.createDataFrame([("202402",), ("202401",)], "unit string")
    req = empty_req.unionByName(request_units(u.where("unit = '202402'"), "2024-03-01 00:00:00")) \
        .unionByName(request_units(u.where("unit = '202401'"), "2024-03-02 00:00:00"))
    head = next_pending(pending_batches(req, empty_fin)).first()
    assert (head["unit"], head["n_pending"]) == ("202402", 2)  # first requested first
    fin = empty_fin.unionByName(finish_units(u.where("unit = '202402'"), "2024-03-03 00:00:00"))
    head = next_pending(pending_batches(req, fin)).first()
    assert (head["unit"], head["n_pending"]) == ("202401", 1)


def test_push_settings_are_checked():
    from aggrex.sources.config import validate_push_settings
    assert validate_push_settings({}) == {"IMPORT_STRATEGY": "CREATE_AND_UPDATE", "DRY_RUN": True, "MAX_POST": 500}
    assert validate_push_settings({"MAX_POST": 5000, "DRY_RUN": False})["MAX_POST"] == 5000
    for bad in ({"IMPORT_STRATEGY": "DELETE"}, {"MAX_POST": 0}, {"MAX_POST": "10"}, {"DRY_RUN": "yes"}):
        with pytest.raises(ValueError):
            validate_push_settings(bad)


def test_failed_fetches_are_counted(spark):
    from aggrex.operators.completion import split_fetch_errors
    path = os.path.join(tempfile.mkdtemp(prefix="aggrex-t-"), "completions.json")
    with open(path, "w") as fh:
        fh.write('{"dataSet":"DS1","period":"2024","organisationUnit":"O1","date":"2024-01-02","completed":true}\n')
        fh.write('<html>504 Gateway Timeout</html>\n')
        fh.write('{"dataSet":"DS1","period":"2024","organisationUnit":"O2","date":"2024-01-03","completed":false}\n')
    regs = io.scan_completions(spark, path, corrupt_column="_corrupt_record")
    ok, failed = split_fetch_errors(regs)
    assert sorted(r["organisationUnit"] for r in ok.collect()) == ["O1", "O2"]
    assert failed.count() == 1


def test_completion_sync_stream_is_resumable(spark):
    from aggrex.streaming.incremental import completion_sync_stream, record_outcomes
    base = tempfile.mkdtemp(prefix="aggrex-t-")
    todo_root, ledger, out, ckpt = (os.path.join(base, x) for x in ("todo", "ledger", "out", "ckpt"))
    regs = spark.createDataFrame([("DS", "2024", "A", "2024-01-01", True, 1), ("DS", "2024", "B", "2024-01-02", False, 2)],
                                 "dataSet string, period string, organisationUnit string, date string, "
                                 "completed boolean, row_id long")
    pairs = spark.createDataFrame([("DS", "TDS")], "source_dataset string, target_dataset string")
    units = "dataset string, period string, org_unit string"
    spark.createDataFrame([("DS", "2024", "A", -1)], units + ", batch_id long").write.partitionBy("batch_id").parquet(
        ledger)
    spark.createDataFrame([("DS", "2024", "A"), ("DS", "2024", "B")], units).write.mode("append").parquet(todo_root)
    completion_sync_stream(spark, todo_root, ledger, out, ckpt, regs, pairs, "row_id").awaitTermination()
    spark.createDataFrame([("DS", "2024", "B"), ("DS", "2024", "C"), ("DX", "2024", "A")], units).write.mode(
        "append").parquet(todo_root)
    completion_sync_stream(spark, todo_root, ledger, out, ckpt, regs, pairs, "row_id").awaitTermination()
    done = lambda: sorted((r["dataset"], r["org_unit"]) for r in spark.read.schema(units).parquet(ledger).collect())
    # A was done before; B is sent but not known to have arrived; C and DX/A have no status and count as done.
    assert done() == [("DS", "A"), ("DS", "C"), ("DX", "A")]
    sent = spark.read.parquet(os.path.join(out, "completions")).collect()
    assert [(r["org_unit"], r["target_dataset"]) for r in sent] == [("B", "TDS"), ("B", "TDS")]
    outcome = spark.createDataFrame([("DS", "2024", "B", "ok"), ("DS", "2024", "Z", "conflict")],
                                    units + ", outcome string")
    record_outcomes(outcome, ledger, -2)
    record_outcomes(outcome, ledger, -2)
    assert done() == [("DS", "A"), ("DS", "B"), ("DS", "C"), ("DX", "A")]


def test_rate_push_through_the_stream_body(spark):
    from aggrex.streaming.incremental import push_batch, read_payloads
    out = os.path.join(tempfile.mkdtemp(prefix="aggrex-t-"), "push")
    rows = [("REPORTING_RATE", "DS", "202401", "O1", None, None, "REPORTING_RATE", "AGGREGATED", "100"),
            ("REPORTING_RATE", "DS", "202401", "O2", None, None, "REPORTING_RATE", "AGGREGATED", "n/a"),
            ("REPORTING_RATE", "DS", "202401", "O3", None, None, "ACTUAL_REPORTS", "AGGREGATED", "7")]
    df = _dp(spark, rows).withColumn("extract_id", F.lit("E"))
    mapping = spark.createDataFrame([("E", "DS", "REPORTING_RATE", "T", "c", "a"),
                                     ("E", "DS", "ACTUAL_REPORTS", "TA", "c", "a")], RATE_MAPPING)
    push_batch({"REPORTING_RATE": lambda d: map_rates_per_extract(d, mapping)}, out, max_post=10,
               require_numeric=True)(df, 0)
    body = read_payloads(spark, out).collect()[0]["body"]
    assert '"orgUnit":"O1"' in body and '"value":1.0' in body and '"value":7.0' in body
    assert '"orgUnit":"O2"' not in body
    q = spark.read.parquet(os.path.join(out, "quarantine")).collect()
    assert [(r["org_unit"], r["missing"]) for r in q] == [("O2", "value_not_numeric")]


def test_import_status_carries_the_http_code(spark):
    df = spark.createDataFrame([("CREATE", "a", 409, '{"status":"ERROR"}')],
                               "action string, id string, status_code int, body string")
    r = import_status(df).first()
    assert (r["status_code"], r["status"], r["success"]) == (409, "ERROR", False)


def test_first_generation_extract_files_are_canonicalised(spark):
    folder = tempfile.mkdtemp(prefix="aggrex-t-")
    old = _dp(spark, [("DATAELEMENT", "D", "202401", "O", "C", "A", None, "AGGREGATED", "1"),
                      ("DATASET", "DS", "202401", "O", None, None, "REPORTING_RATE", "AGGREGATED", "90")])
    old.toPandas().to_parquet(os.path.join(folder, "ds_extract_202401.parquet"))  # a foreign single file
    got = sorted(r["data_type"] for r in io.scan_extract_files(spark, folder, "*_extract_202401.parquet").collect())
    assert got == ["DATA_ELEMENT", "REPORTING_RATE"]
    got = sorted(r["data_type"] for r in io.scan_extract(spark, os.path.join(folder, "ds_extract_202401.parquet"))
                 .collect())
    assert got == ["DATA_ELEMENT", "REPORTING_RATE"]


def test_payloads_written_per_period(spark):
    from aggrex.operators.push import classify_data_points, payload_batches
    out = os.path.join(tempfile.mkdtemp(prefix="aggrex-t-"), "payloads")
    rows = [("DATA_ELEMENT", "D", p, f"O{i}", "C", "A", None, "AGGREGATED", str(i)) for p in ("202401", "202402")
            for i in range(12)]
    batches = payload_batches(classify_data_points(_dp(spark, rows)), max_post=5)
    io.write_payloads(batches, out, partition_by=["period"])
    assert {"period=202401", "period=202402"} <= set(os.listdir(out))
    back = spark.read.parquet(out)
    assert back.where("period = '202402'").count() == 3 and back.agg(F.sum("n_points")).first()[0] == 24


def test_replayed_completion_batch_keeps_its_payloads(spark):
    from aggrex.streaming.incremental import sync_batch
    base = tempfile.mkdtemp(prefix="aggrex-t-")
    ledger, out = os.path.join(base, "ledger"), os.path.join(base, "out")
    units = "dataset string, period string, org_unit string"
    spark.createDataFrame([], units + ", batch_id long").write.parquet(ledger)
    regs = spark.createDataFrame([("DS1", "2024", "A", "2024-01-01", True, 1)],
                                 "dataSet string, period string, organisationUnit string, date string, "
                                 "completed boolean, row_id long")
    # A has DS1 in the bulk table and DS2 only in its own fetch.
    direct = regs.unionByName(spark.createDataFrame([("DS2", "2024", "A", "2024-02-01", True, 2)], regs.schema))
    pairs = spark.createDataFrame([("DS1", "T1"), ("DS2", "T2")], "source_dataset string, target_dataset string")
    todo = spark.createDataFrame([("DS1", "2024", "A"), ("DS2", "2024", "A"), ("DS1", "2024", "B")], units)
    body = sync_batch(ledger, out, regs, pairs, "row_id", direct)
    for _ in range(2):
        body(todo, 0)
        sent = spark.read.parquet(os.path.join(out, "completions")).collect()
        assert sorted(r["target_dataset"] for r in sent) == ["T1", "T2"]
        done = spark.read.schema(units).parquet(ledger).select("dataset", "period", "org_unit").collect()
        assert [tuple(r) for r in done] == [("DS1", "2024", "B")]


def test_identity_rate_mapping_is_allowed_and_holes_of_other_extracts_are_ignored(spark):
    from aggrex.operators.mapping import invalid_rate_mappings, overlapping_rate_keys
    same = spark.createDataFrame([("E", "A", "R", "A", "c", "a"), ("E", "B", "R", "C", "c", "a")], RATE_MAPPING)
    assert overlapping_rate_keys(same).count() == 0
    chain = spark.createDataFrame([("E", "A", "R", "B", "c", "a"), ("E", "B", "R", "C", "c", "a")], RATE_MAPPING)
    assert overlapping_rate_keys(chain).count() == 1
    hole = spark.createDataFrame([("EXA", "DS", "R", "T", "c", "a"), ("EXB", "DS", "R", None, "c", "a")], RATE_MAPPING)
    data = spark.createDataFrame([("EXA", "DS")], "extract_id string, dx_uid string")
    assert invalid_rate_mappings(hole, data).count() == 0
    both = data.unionByName(spark.createDataFrame([("EXB", "DS")], data.schema))
    assert [r["missing"] for r in invalid_rate_mappings(hole, both).collect()] == ["UID"]


def test_number_formats_are_no_geometry_change_and_duplicate_ids_pair_once(spark):
    from aggrex.operators.align import org_units_matching, org_units_to_update
    unit = "id string, name string, shortName string, openingDate string, closedDate string, parent_id string, " \
           "level int, path string, geometry string"

    def units(*rows):
        return spark.createDataFrame([(i, n, n, "2001-01-01", None, "P", 2, "/P/" + i, g) for i, n, g in rows],
                                     unit).coalesce(1)
    a = units(("x", "old", None), ("x", "n", '{"type":"Point","coordinates":[1,-0,2e1]}'))
    b = units(("x", "other", None), ("x", "n", '{"type":"Point","coordinates":[1.0, 0.00, 20]}'))
    assert org_units_matching(a, b).count() == 1
    assert org_units_to_update(a, b).count() == 0


def test_descendants_of_a_deep_chain_and_of_cycles(spark):
    from aggrex.operators.hierarchy import select_descendants
    chain = [(f"u{i}", f"u{i - 1}" if i else None) for i in range(1100)]
    loop = [("a", "b"), ("b", "a"), ("c", "a"), ("d", "x"), ("d", "u5")]
    units = spark.createDataFrame(chain + loop, "id string, parent_id string")
    got = sorted(r["id"] for r in select_descendants(units, ["u100"]).collect())
    assert got == sorted(f"u{i}" for i in range(100, 1100))
    assert sorted({r["id"] for r in select_descendants(units, ["a"]).collect()}) == ["a", "b", "c"]
    assert "d" in {r["id"] for r in select_descendants(units, ["u3"]).collect()}


def test_an_empty_answer_is_a_push_error(spark):
    from aggrex.operators.reports import completion_outcome
    rows = spark.createDataFrame([(1, "{}"), (2, " { } "), (3, '{"status":"SUCCESS"}'), (4, "null")], "k int, body string")
    got = {r["k"]: (r["outcome"], r["push_errors"]) for r in completion_outcome(rows, ["k"]).collect()}
    assert got == {1: ("no_json", 1), 2: ("no_json", 1), 3: ("ok", 0), 4: ("no_json", 1)}


def test_existing_rate_extracts_are_skipped_or_taken_anew(spark):
    from aggrex.plans.extraction import skip_existing_rates
    plan = spark.createDataFrame([("E", "202401", "k1"), ("E", "202401", "k2"), ("E", "202402", "k1")],
                                 "extract_uid string, period string, rate_key string")
    have = spark.createDataFrame([("E", "202401"), ("X", "202401")], "extract_uid string, period string")
    todo, back = skip_existing_rates(plan, have)
    assert [r["period"] for r in todo.collect()] == ["202402"] and back.count() == 0
    _, back = skip_existing_rates(plan, have, return_existing=True)
    assert [tuple(r) for r in back.collect()] == [("E", "202401")]
    todo, _ = skip_existing_rates(plan, have, download_new=False)
    assert todo.count() == 3


def test_polling_push_takes_later_files_too(spark):
    from aggrex.streaming.incremental import incremental_push, read_payloads
    base = tempfile.mkdtemp(prefix="aggrex-t-")
    root, out = os.path.join(base, "extracts"), os.path.join(base, "out")

    def drop(period):
        io.write_extract(_dp(spark, [("DATA_ELEMENT", "D", period, "O1", "C", "A", None, "AGGREGATED", "1")]), root, "x",
                         F.col("period"))
    drop("202401")
    q = incremental_push(spark, root, out, os.path.join(base, "ckpt"), lambda d: d, max_post=5,
                         continuous_every="1 second", max_files_per_trigger=1)
    try:
        q.processAllAvailable()
        drop("202402")
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert sorted(r["period"] for r in read_payloads(spark, out).collect()) == ["202401", "202402"]


def test_unknown_combos_are_refused_by_the_plan(spark):
    from aggrex.plans.extraction import expand_category_combos
    items = spark.createDataFrame([(0, ["CC", "GONE"], [])],
                                  "item_pos int, cat_combos array<string>, cat_option_combos array<string>")
    bridge = spark.createDataFrame([("CC", "c1")], "cat_combo string, coc string")
    with pytest.raises(ValueError, match="GONE"):
        expand_category_combos(items, bridge)
    assert expand_category_combos(items, bridge, allow_unfiltered=True).count() == 1


def test_a_large_damaged_extract_is_many_damaged_files(spark, monkeypatch):
    """No task writes the whole damaged extract into one file; all of its files are damaged, none of its points sent."""
    import __spark_entry__ as entry
    from aggrex.operators.push import classify_data_points
    from aggrex.registry import incremental_q
    from aggrex.registry.push_q import mapped_data_points
    sf, damaged, one = "/root/testdata/sf0.001", [], incremental_q.damage
    monkeypatch.setattr(incremental_q, "DAMAGED_FILE_ROWS", 400)
    monkeypatch.setattr(incremental_q, "damage", lambda s, source, target: damaged.append(target) or one(s, source, target))
    # Tiny shuffle partitions would be put together again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = entry.queries()["k1_damaged_extract"](spark, sf).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sendable = classify_data_points(mapped_data_points(spark, sf)).where("class in ('valid', 'to_delete')").count()
    assert len(damaged) > 1 and [r["n"] for r in got if r["what"] == "set aside"] == [1]
    assert sum(r["n"] for r in got if r["what"] == "sent") == sendable
