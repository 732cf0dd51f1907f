"""Measured broadcasts, input order, kinds of read errors, states of units, end markers, versions of extracts."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from aggrex.operators.align import latest_per_id
from aggrex.operators.dims import is_small, measured_bytes, plan_bytes, sized_broadcast
from aggrex.schemas import DATA_POINT
from aggrex.sources import io
from aggrex.streaming import outcomes as oc
from aggrex.streaming.incremental import (enqueue_switches, incremental_push, pending_batches, push_batch, read_log,
                                         read_payloads, record_outcomes, sync_batch, write_end_marker)


def scratch(*names):
    base = tempfile.mkdtemp(prefix="aggrex-t-")
    return [os.path.join(base, n) for n in names]


def points(spark, n, period="202401", tag="O"):
    return spark.createDataFrame([("DATA_ELEMENT", "D", period, f"{tag}{i}", "C", "A", None, "AGGREGATED", str(i))
                                  for i in range(n)], DATA_POINT)


def hinted(df):
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_an_exploded_dimension_is_measured_not_estimated(spark):
    """Few rows with long arrays: a small file and a small estimate, millions of rows."""
    (path,) = scratch("scope")
    spark.range(60).select(F.col("id").cast("string").alias("ds"), F.sequence(F.lit(0), F.lit(20_000)).alias("units")) \
        .coalesce(1).write.parquet(path)
    rows = spark.read.parquet(path).select("ds", F.explode("units").alias("unit"))
    assert plan_bytes(rows) < 16 << 20  # the estimate would allow it
    assert measured_bytes(rows) > 1_000_000 * 32
    assert not is_small(rows) and not hinted(sized_broadcast(rows))
    few = rows.where("ds = '1' and unit < 100")
    assert is_small(few) and hinted(sized_broadcast(few))
    nested = spark.read.parquet(path)
    assert measured_bytes(nested) > 60 * 20_000 * 4
    assert measured_bytes(few.where("false")) == 0


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_last_row_wins_in_file_order_however_files_are_packed(spark, fmt):
    (root,) = scratch("pyramid")
    for name, rows in (("b", [("x", "b0"), ("y", "b1"), ("x", "b2")]), ("a", [("x", "a0"), ("y", "a1"), ("z", "a2")]),
                       ("c", [("y", "c0")] + [(f"f{i}", "c") for i in range(2000)] + [("y", "c1")])):
        spark.createDataFrame(rows, "id string, name string").coalesce(1).write.format(fmt).save(f"{root}/{name}")
    for size in ("128m", "2k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            scan = io.scan_pyramid(spark, f"{root}/*", fmt, row_order=True)
            got = {r.id: r.name for r in latest_per_id(scan, None).where("id in ('x', 'y', 'z')").collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert got == {"x": "b2", "y": "c1", "z": "a2"}


def test_only_damage_sets_a_file_aside(spark, monkeypatch):
    (root,) = scratch("extracts")
    points(spark, 5).coalesce(1).write.parquet(root)
    good = [os.path.join(root, f) for f in os.listdir(root) if f.endswith(".parquet")]
    broken = os.path.join(root, "broken.parquet")
    with open(broken, "wb") as f:
        f.write(b"PAR1 nothing")
    ok, bad = io.split_readable(spark, good + [broken])
    assert ok == good and [p for p, _ in bad] == [broken]
    gone = os.path.join(root, "gone.parquet")
    with pytest.raises(Exception):  # noqa: B017 - a file that can't be got at says nothing about its rows
        io.split_readable(spark, good + [gone])
    assert not io.is_damage(RuntimeError("ExecutorLostFailure (executor 3 exited)"))
    assert not io.is_damage(RuntimeError("FAILED_READ_FILE: java.net.SocketTimeoutException"))


ANSWER = ("micro_batch long, phase string, extract_id string, period string, batch_no long, attempt long, body string")
OK, BAD = '{"status":"OK"}', '{"status":"WARNING","conflicts":[{"object":"x"}]}'


def test_units_are_done_when_every_payload_succeeded(spark):
    (out,) = scratch("push")
    body = push_batch(lambda d: d, out, max_post=4)
    rows = points(spark, 10).withColumn("extract_id", F.lit("E"))
    rows = rows.unionByName(points(spark, 3, "202402").withColumn("extract_id", F.lit("E")))
    # Nothing to send: all keys missing.
    rows = rows.unionByName(points(spark, 2, "202403").withColumn("extract_id", F.lit("E")).withColumn(
        "org_unit", F.lit(None).cast("string")))
    body(rows, 0)
    payloads, sent = read_payloads(spark, out), spark.read.parquet(f"{out}/sent")
    assert payloads.count() == 4
    requested = spark.createDataFrame([(f"E|20240{i}", dt.datetime(2024, 1, 1)) for i in (1, 2, 3, 4)],
                                      "unit string, requested_at timestamp")

    def states(rows):
        got = oc.payload_outcomes(payloads, spark.createDataFrame(rows, ANSWER))
        units = oc.sendings(sent, got)
        return ({r.unit: r.state for r in oc.unit_states(requested, units).collect()},
                sorted((r.period, r.batch_no, r.attempt) for r in oc.due_payloads(payloads, got).collect()),
                sorted(r.unit for r in oc.confirmed_units(units).collect()))

    key = [(0, "valid", "E", "202401", i) for i in range(3)]
    got, due, done = states([])
    assert got == {"E|202401": "sent", "E|202402": "sent", "E|202403": "confirmed", "E|202404": "requested"}
    assert len(due) == 4 and done == ["E|202403"]
    answers = [(*key[0], 1, OK), (*key[1], 1, BAD), (*key[2], 1, OK), (0, "valid", "E", "202402", 0, 1, OK)]
    got, due, done = states(answers)
    assert got["E|202401"] == "failed" and got["E|202402"] == "confirmed" and due == [("202401", 1, 2)]
    assert done == ["E|202402", "E|202403"]
    got, due, done = states(answers + [(*key[1], 2, OK)])
    assert got["E|202401"] == "confirmed" and due == [] and len(done) == 3
    # Two answers to one attempt: the failure counts; no JSON is a failure.
    assert states(answers + [(*key[0], 1, "busy")])[0]["E|202401"] == "failed"
    # A request after the sending keeps the unit open, whatever the answers to the earlier one.
    later = requested.unionByName(spark.createDataFrame([("E|202402", dt.datetime(2100, 1, 1))], requested.schema))
    units = oc.sendings(sent, oc.payload_outcomes(payloads, spark.createDataFrame(answers, ANSWER)))
    assert {r.unit: r.state for r in oc.unit_states(later, units).collect()}["E|202402"] == "requested"
    assert "E|202402" in {r.unit for r in pending_batches(later, oc.confirmed_units(units)).collect()}
    # Sent again in a later micro-batch: the earlier failure is superseded.
    body(points(spark, 1).withColumn("extract_id", F.lit("E")), 1)
    got = oc.payload_outcomes(read_payloads(spark, out), spark.createDataFrame(answers, ANSWER))
    assert [(r.period, r.micro_batch) for r in oc.due_payloads(read_payloads(spark, out), got).collect()] == [("202401", 1)]


def test_the_mapping_is_evaluated_once_per_micro_batch(spark):
    (out,) = scratch("push")
    seen = spark.sparkContext.accumulator(0)

    def transform(df):
        def run(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return df.mapInArrow(run, df.schema)

    push_batch(transform, out, max_post=7)(points(spark, 40).withColumn("extract_id", F.lit("E")), 0)
    assert seen.value == 40
    assert read_payloads(spark, out).agg(F.sum("n_points")).first()[0] == 40
    log = spark.read.parquet(f"{out}/sent").first()
    assert (log.n_valid, log.n_to_delete, log.n_invalid) == (40, 0, 0)


def test_end_marker_ends_a_polling_query_and_leaves_what_is_newer(spark):
    root, out, ckpt = scratch("extracts", "push", "ckpt")
    io.write_extract(points(spark, 4, "202401"), root, "E", F.col("period"), feed=False)
    write_end_marker(spark, root, "r1")
    io.write_extract(points(spark, 3, "202402"), root, "E", F.col("period"), feed=False)

    def run():
        q = incremental_push(spark, root, out, ckpt, lambda d: d, continuous_every="1 second", end_marker=True)
        assert q.awaitTermination(120) is not False and not q.isActive
        return {r.period: r.n for r in read_payloads(spark, out).groupBy("period").agg(
            F.sum("n_points").alias("n")).collect()}

    assert run() == {"202401": 4}
    io.write_extract(points(spark, 2, "202403"), root, "E", F.col("period"), feed=False)
    write_end_marker(spark, root, "r2")
    assert run() == {"202401": 4, "202402": 3, "202403": 2}


def test_a_failed_push_is_sent_again_within_the_run_only_once_it_is_known_to_have_failed(spark):
    todo, ledger, out = scratch("todo", "ledger", "out")
    unit = "dataset string, period string, org_unit string"
    regs = spark.createDataFrame([("DS", "2024", x, "2024-01-01", True, 1) for x in "AB"],
                                 "dataSet string, period string, organisationUnit string, date string, "
                                 "completed boolean, row_id long")
    pairs = spark.createDataFrame([("DS", "TDS")], "source_dataset string, target_dataset string")
    spark.createDataFrame([("DS", "2024", "Z", -1)], unit + ", batch_id long").write.partitionBy("batch_id").parquet(ledger)
    spark.createDataFrame([("DS", "2024", "A"), ("DS", "2024", "B")], unit).write.parquet(todo)
    signal = spark.createDataFrame([], unit)
    body = sync_batch(ledger, out, regs, pairs, "row_id", todo_root=todo)

    def sent(batch):
        return sorted(r.org_unit for r in spark.read.schema(unit).parquet(f"{out}/completions/batch_id={batch}").collect())

    body(signal, 0)
    body(signal, 1)
    assert sent(0) == ["A", "B"] and sent(1) == []
    record_outcomes(spark.createDataFrame([("DS", "2024", "A", "ok"), ("DS", "2024", "B", "conflict")],
                                          unit + ", outcome string"), ledger, -2, out, 0)
    body(signal, 2)
    assert sent(2) == ["B"]
    again = sync_batch(ledger, out, regs, pairs, "row_id", todo_root=todo)  # another run
    again(signal, 3)
    assert sent(3) == ["B"]
    # More answers under the same number add to the ledger.
    record_outcomes(spark.createDataFrame([("DS", "2024", "B", "ok")], unit + ", outcome string"), ledger, -2)
    again(signal, 4)
    assert sent(4) == []
    assert sorted(r.org_unit for r in spark.read.schema(unit).parquet(ledger).collect()) == ["A", "B", "Z"]


def test_a_writer_that_dies_before_its_switch_changes_nothing(spark):
    root, asked, ckpt = scratch("versions", "requested", "ckpt")
    for p in ("202401", "202402"):
        io.write_extract_version(points(spark, 4, p), root, "E", F.col("period"))

    def per_period(df):
        return {r.extract_period: r["count"] for r in df.groupBy("extract_period").count().collect()}

    io.write_extract(points(spark, 1), f"{root}/data/version=9", "E", F.col("period"), feed=False)
    assert per_period(io.read_extract_versions(spark, root)) == {"202401": 4, "202402": 4}
    opened = io.read_extract_versions(spark, root)
    both = points(spark, 2).unionByName(points(spark, 2, "202402"))
    io.write_extract_version(both, root, "E", F.col("period"))
    assert per_period(opened) == {"202401": 4, "202402": 4}
    assert per_period(io.read_extract_versions(spark, root)) == {"202401": 2, "202402": 2}
    # The switches are the outbox: nothing that was switched is lost, nothing else is asked for.
    enqueue_switches(spark, root, asked, ckpt).awaitTermination()
    enqueue_switches(spark, root, asked, ckpt).awaitTermination()
    got = sorted(r.unit for r in read_log(spark, asked, "unit string, requested_at timestamp").collect())
    assert got == ["202401", "202401", "202402", "202402"]


def test_completion_sync_looks_its_units_up_once(spark, tmp_path):
    """Both results of a step read the stored look-up: no join with the registrations is left in their plans."""
    from aggrex.operators.completion import completion_sync
    unit = "dataset string, period string, org_unit string"
    regs = spark.createDataFrame([("A", "2024", "O1", "2024-01-01", True, 2), ("A", "2024", "O1", "2024-01-02", False, 1),
                                  ("A", None, "O3", "2024-01-01", True, 3)],
                                 "dataSet string, period string, organisationUnit string, date string, "
                                 "completed boolean, row_id long")
    todo = spark.createDataFrame([("A", "2024", "O1"), ("A", "2024", "O2"), ("A", None, "O3"), ("A", "2024", "O9")], unit)
    ledger = spark.createDataFrame([("A", "2024", "O9"), ("A", "2024", None)], unit)
    pairs = spark.createDataFrame([("A", "TA")], "source_dataset string, target_dataset string")
    payloads, done = completion_sync(todo, regs, ledger, pairs, "row_id", scratch=str(tmp_path / "looked_up"))
    for df in (payloads, done):
        assert "min_by" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["org_unit"], '"date":"2024-01-02"' in r["payload"]) for r in payloads.collect()] == [("O1", True)]
    assert sorted(r["org_unit"] for r in done.collect()) == ["O2", "O3"]
