"""What happens around a push: outcomes, retries, end markers, versions of extracts, input order
(A3, A10, C2, K2-K5)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from aggrex import fixtures
from aggrex.operators.align import latest_per_id
from aggrex.operators.dims import config_dim
from aggrex.operators.mapping import uid_mapper
from aggrex.operators.normalise import normalise_data_values
from aggrex.registry import query
from aggrex.registry.completion_q import _CTES, _K4, VIEWS, _direct, _inputs, _outcomes, _stored
from aggrex.registry.push_q import MAX_POST, UID_DEFAULTS, UID_ROWS
from aggrex.registry.push_q import _oracle as push_oracle
from aggrex.schemas import UID_MAPPING
from aggrex.session import checkpoint_dir
from aggrex.sources import io
from aggrex.streaming import outcomes as oc
from aggrex.streaming.incremental import (completion_sync_stream, enqueue_switches, incremental_push, pending_batches,
                                         read_log, read_payloads, record_outcomes, write_end_marker)

SPLIT_MONTH = "199801"
ASKED = "2020-01-01 00:00:00"
RESPONSE = ("micro_batch long, phase string, extract_id string, period string, batch_no long, attempt long, "
            "body string")


def _scratch(spark, *names):
    base = f"{checkpoint_dir(spark).rstrip('/')}/loop-{uuid.uuid4().hex}"
    return [f"{base}/{n}" for n in names]


def _values(spark, sf_dir):
    return normalise_data_values(fixtures.view(spark, sf_dir, "fx_data_values"))


def _transform(spark):
    return uid_mapper(config_dim(spark, UID_ROWS, UID_MAPPING), UID_DEFAULTS)


@query("k5_success_loop", push_oracle("""
SELECT 'first' AS step, unit, CASE WHEN n_failed > 0 THEN 'failed' ELSE 'confirmed' END AS state, n_payloads,
       n_payloads - n_failed AS n_confirmed, n_failed FROM u
UNION ALL SELECT 'pending', unit, 'pending', 0, 0, 0 FROM u WHERE n_failed > 0
UNION ALL SELECT 'due', unit, 'due', n_failed, 0, 0 FROM u WHERE n_failed > 0
UNION ALL SELECT 'second', unit, 'confirmed', n_payloads, n_payloads, 0 FROM u""", f""",
b AS (SELECT period, class, CAST(ceil(count(*) / {MAX_POST}.0) AS BIGINT) AS n FROM cls
  WHERE class IN ('valid', 'to_delete') GROUP BY ALL),
u AS (SELECT concat_ws('|', 'dsA', p.period) AS unit, CAST(coalesce(sum(b.n), 0) AS BIGINT) AS n_payloads,
    CASE WHEN substr(p.period, 5, 2) = '03' THEN count(b.n) ELSE 0 END AS n_failed
  FROM (SELECT DISTINCT period FROM cls) p LEFT JOIN b ON b.period = p.period GROUP BY p.period)"""))
def q_success_loop(spark, sf_dir):
    """Extracts are pushed; of the answers, those to the first payload of every March are failures. The states
    of all units, what is pending and due then, and the states after the due payloads were sent again; the
    answers' first micro-batch is replayed in between."""
    root, out, ckpt, answers, done, ckpt2 = _scratch(spark, "extracts", "push", "stream", "answers", "finished", "settle")
    feed = io.write_extract(_values(spark, sf_dir), root, extract_id="dsA", extract_period=F.col("period"))
    requested = feed.select(F.concat_ws("|", "extract_id", "extract_period").alias("unit"),
                            F.lit(ASKED).cast("timestamp").alias("requested_at")).checkpoint(eager=True)
    incremental_push(spark, root, out, ckpt, _transform(spark), max_post=MAX_POST).awaitTermination()
    payloads, sent = read_payloads(spark, out), spark.read.parquet(f"{out}/sent")

    def answer(rows, body):
        (rows.select(F.col("micro_batch").cast("long").alias("micro_batch"), "phase", "extract_id", "period", "batch_no",
                     "attempt", body.alias("body")).write.mode("append").parquet(answers))
        oc.settle_stream(spark, out, answers, RESPONSE, done, ckpt2).awaitTermination()

    def state():
        got = oc.payload_outcomes(payloads, spark.read.schema(RESPONSE).parquet(answers))
        return got, oc.unit_states(requested, oc.sendings(sent, got))

    good = F.lit('{"status":"SUCCESS","importCount":{"imported":1,"updated":0,"ignored":0,"deleted":0}}')
    bad = F.when(F.col("phase") == "valid", F.lit('{"status":"ERROR","conflicts":[{"object":"x","value":"y"}]}')).otherwise(
        F.lit("gateway timeout"))
    fails = (F.substring("period", 5, 2) == "03") & (F.col("batch_no") == 0)
    answer(payloads.withColumn("attempt", F.lit(1).cast("long")), F.when(fails, bad).otherwise(good))
    oc.settle_batch(out, answers, RESPONSE, done)(spark.read.schema(RESPONSE).parquet(answers), 0)  # a replay
    got, units = state()
    first = units.checkpoint(eager=True)
    pending = pending_batches(requested, read_log(spark, done, "unit string, finished_at timestamp")).checkpoint(eager=True)
    due = oc.due_payloads(payloads, got).checkpoint(eager=True)
    answer(due, good)
    _, second = state()
    left = pending_batches(requested, read_log(spark, done, "unit string, finished_at timestamp"))
    zero = F.lit(0).cast("long")
    rows = first.select(F.lit("first").alias("step"), "unit", "state", "n_payloads", "n_confirmed", "n_failed")
    for step, df in (("pending", pending), ("still pending", left)):
        rows = rows.unionByName(df.select(F.lit(step).alias("step"), "unit", F.lit("pending").alias("state"), zero.alias(
            "n_payloads"), zero.alias("n_confirmed"), zero.alias("n_failed")))
    rows = rows.unionByName(due.groupBy(oc.unit_name().alias("unit")).agg(F.count(F.lit(1)).alias("n_payloads")).select(
        F.lit("due").alias("step"), "unit", F.lit("due").alias("state"), "n_payloads", zero.alias("n_confirmed"),
        zero.alias("n_failed")))
    return rows.unionByName(second.select(F.lit("second").alias("step"), "unit", "state", "n_payloads", "n_confirmed",
                                          "n_failed"))


@query("k4_failed_units_again", fixtures.with_views(VIEWS, """
SELECT 'first' AS step, dataset, period, org_unit, payload FROM sent
UNION ALL SELECT 'second', s.dataset, s.period, s.org_unit, s.payload FROM sent s
  WHERE NOT EXISTS (SELECT 1 FROM ok o WHERE o.dataset = s.dataset AND o.period = s.period AND o.org_unit = s.org_unit)
UNION ALL SELECT 'ledger', dataset, period, org_unit, CAST(NULL AS VARCHAR) FROM done""", _CTES + _K4))
def q_k4_again(spark, sf_dir):
    """The sync as a stream, run twice over one file of units: the second run, for which no file came, sends
    again what failed or had no answer, and nothing else."""
    regs, todo, processed, pairs = _inputs(spark, sf_dir)
    ledger, out, units, ckpt, kept, answers = _scratch(spark, "ledger", "out", "todo", "stream", "regs", "answers")
    regs = _stored(regs, kept)
    processed.withColumn("batch_id", F.lit(-1).cast("bigint")).write.partitionBy("batch_id").parquet(ledger)
    todo = _stored(todo, units)

    def run():
        completion_sync_stream(spark, units, ledger, out, ckpt, regs, pairs, "row_id", _direct(spark)).awaitTermination()

    run()
    record_outcomes(_stored(_outcomes(spark, sf_dir, (regs, todo, processed, pairs)), answers), ledger, -2, out, 0)
    run()
    sent = spark.read.schema("dataset string, period string, org_unit string, payload string, batch_id long").parquet(
        f"{out}/completions")
    done = spark.read.schema("dataset string, period string, org_unit string").parquet(ledger).where(
        "org_unit is not null").select("dataset", "period", "org_unit").distinct()
    return (sent.select(F.when(F.col("batch_id") == 0, "first").otherwise("second").alias("step"), "dataset", "period",
                        "org_unit", "payload")
            .unionByName(done.select(F.lit("ledger").alias("step"), "*", F.lit(None).cast("string").alias("payload"))))


@query("k2_end_marker", push_oracle(f"""
SELECT CASE WHEN period < '{SPLIT_MONTH}' THEN 'first' ELSE 'second' END AS step, class AS phase, period,
       count(*) AS n_points FROM cls WHERE class IN ('valid', 'to_delete') GROUP BY class, period"""))
def q_k2_marker(spark, sf_dir):
    """A polling consumer that ends by itself: extracts, the producer's end marker, more extracts. The first run
    sends what came before the marker, the next run the rest."""
    root, out, ckpt = _scratch(spark, "extracts", "push", "stream")
    dv = _values(spark, sf_dir)
    io.write_extract(dv.where(F.col("period") < SPLIT_MONTH), root, "dsA", F.col("period"), feed=False)
    write_end_marker(spark, root, "run-1")
    io.write_extract(dv.where(F.col("period") >= SPLIT_MONTH), root, "dsA", F.col("period"), feed=False)

    def run():
        incremental_push(spark, root, out, ckpt, _transform(spark), max_post=MAX_POST, continuous_every="1 second",
                         end_marker=True).awaitTermination()

    run()
    first = read_payloads(spark, out).select("batch_id").distinct().checkpoint(eager=True)
    write_end_marker(spark, root, "run-2")
    run()
    step = F.when(F.col("_first").isNotNull(), "first").otherwise("second")
    return (read_payloads(spark, out).join(first.withColumn("_first", F.lit(1)), "batch_id", "left")
            .groupBy(step.alias("step"), "phase", "period").agg(F.sum("n_points").alias("n_points")))


_PER_PERIOD = "SELECT period AS extract_period, count(*) AS n FROM fx_data_values {} GROUP BY period"


@query("a10_version_switch", fixtures.with_views(["fx_data_values"], f"""
SELECT 'old' AS seen, extract_period, n FROM ({_PER_PERIOD.format('')}) a
UNION ALL SELECT 'old, during the rewrite', extract_period, n FROM ({_PER_PERIOD.format('')}) b
UNION ALL SELECT 'new', extract_period, n FROM ({_PER_PERIOD.format("WHERE orgUnit < 'C5'")}) c
UNION ALL SELECT 'new', a.extract_period, a.n FROM ({_PER_PERIOD.format('')}) a
  WHERE NOT EXISTS (SELECT 1 FROM fx_data_values v WHERE v.orgUnit < 'C5' AND v.period = a.extract_period)"""))
def q_a10(spark, sf_dir):
    """All periods are written, then rewritten. A table opened before the rewrite's switch shows the old
    version throughout, also while new files are there already; opened after it, the new version."""
    (root,) = _scratch(spark, "versions")
    dv = _values(spark, sf_dir)
    io.write_extract_version(dv, root, "dsA", F.col("period"), version="1")
    old = io.read_extract_versions(spark, root)
    new = dv.where(F.col("org_unit") < "C5")
    # The rewrite as it stands before its switch: all files, some of them half the final rows.
    io.write_extract(new.sample(0.5, seed=1), f"{root}/data/version=2", "dsA", F.col("period"), feed=False)
    during = io.read_extract_versions(spark, root)
    rows = None

    def add(seen, df):
        nonlocal rows
        part = df.groupBy("extract_period").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(seen).alias("seen"), "extract_period", "n").checkpoint(eager=True)
        rows = part if rows is None else rows.unionByName(part)

    add("old, during the rewrite", during)
    io.write_extract_version(new, root, "dsA", F.col("period"), version="2")
    add("old", old)
    add("new", io.read_extract_versions(spark, root))
    return rows


@query("k3_outbox", fixtures.with_views(["fx_data_values"], f"""
SELECT unit, count(*) AS n_open_requests FROM (
  SELECT DISTINCT period AS unit, 1 AS v FROM fx_data_values UNION ALL
  SELECT DISTINCT period, 2 FROM fx_data_values WHERE period >= '{SPLIT_MONTH}' UNION ALL
  SELECT DISTINCT substr(period, 1, 4), 3 FROM fx_data_values) a WHERE unit IS NOT NULL GROUP BY unit"""))
def q_outbox(spark, sf_dir):
    """Three versioned writes, their switches streamed into the request log in two runs, the second of which finds
    what the first had not seen; every write of a unit is one open request."""
    root, asked, ckpt = _scratch(spark, "versions", "requested", "stream")
    dv = _values(spark, sf_dir)
    io.write_extract_version(dv, root, "dsA", F.col("period"))
    io.write_extract_version(dv.where(F.col("period") >= SPLIT_MONTH), root, "dsA", F.col("period"))
    enqueue_switches(spark, root, asked, ckpt).awaitTermination()
    io.write_extract_version(dv, root, "dsY", F.substring("period", 1, 4))
    for _ in range(2):
        enqueue_switches(spark, root, asked, ckpt).awaitTermination()
    requested = read_log(spark, asked, "unit string, requested_at timestamp").where(
        f"unit is not null and unit <> '{io.NO_PARTITION}'")
    finished = spark.createDataFrame([], "unit string, finished_at timestamp")
    return pending_batches(requested, finished).select("unit", "n_open_requests")


@query("c2_input_order", fixtures.with_views(["fx_pyramid_source"], """
SELECT id, name || ' 3' AS name, level FROM fx_pyramid_source"""))
def q_c2_order(spark, sf_dir):
    """Three dumps of the pyramid, read as one; the last row of an id in the order of files and rows wins,
    however the files are packed into tasks."""
    (root,) = _scratch(spark, "pyramid")
    units = fixtures.view(spark, sf_dir, "fx_pyramid_source")
    flat = [c for c in units.columns if c in ("id", "name", "shortName", "openingDate", "closedDate", "level", "path",
                                              "geometry")]
    for n in (3, 1, 2):  # not in the order of their names
        (units.select(*flat).withColumn("name", F.concat("name", F.lit(f" {n}"))).repartition(4, "id")
         .write.parquet(f"{root}/dump={n}"))
    scan = io.scan_pyramid(spark, f"{root}/*", row_order=True)
    return latest_per_id(scan, None).select("id", "name", "level")
