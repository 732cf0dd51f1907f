"""Incremental push and work ledger."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from aggrex import fixtures
from aggrex.operators.dims import config_dim
from aggrex.operators.mapping import uid_mapper
from aggrex.operators.normalise import normalise_data_values
from aggrex.operators.push import classify_data_points, payload_batches
from aggrex.registry import ORACLE, query
from aggrex.registry.push_q import MAX_POST, UID_DEFAULTS, UID_ROWS, mapped_data_points
from aggrex.registry.push_q import _oracle as push_oracle
from aggrex.schemas import UID_MAPPING
from aggrex.session import checkpoint_dir
from aggrex.sources import io
from aggrex.functions.periods import month_range
from aggrex.streaming.incremental import (changed_units, incremental_push, pending_batches, read_payloads,
                                         read_unreadable_files, reopen_units)

J2_COLUMNS = ["phase", "phase_order", "period", "batch_no", "n_points", "first_org_unit", "last_org_unit", "body"]
SPLIT_MONTH = "199801"


def _scratch(spark, tag):
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


@query("a11_write_payloads", ORACLE["j2_payload_batches"])
def q_a11(spark, sf_dir):
    path = _scratch(spark, "payloads")
    c = classify_data_points(mapped_data_points(spark, sf_dir))
    io.write_payloads(payload_batches(c, max_post=MAX_POST, tie_break="row_id"), path)
    return spark.read.parquet(path).select(*J2_COLUMNS)


@query("k1_incremental_push", ORACLE["j2_payload_batches"])
def q_k1(spark, sf_dir):
    """Two extract drops, each drained by an availableNow run of the same
    stream; the second run sees only the new files. Rows are routed by data
    type (only data elements have a mapping here)."""
    root, out, ckpt = _scratch(spark, "extracts"), _scratch(spark, "push"), _scratch(spark, "stream")
    dv = normalise_data_values(fixtures.view(spark, sf_dir, "fx_data_values"))
    transform = {"DATA_ELEMENT": uid_mapper(config_dim(spark, UID_ROWS, UID_MAPPING), UID_DEFAULTS)}

    for drop in (dv.where(F.col("period") < SPLIT_MONTH), dv.where(F.col("period") >= SPLIT_MONTH)):
        io.write_extract(drop, root, extract_id="dsA", extract_period=F.col("period"))
        incremental_push(spark, root, out, ckpt, transform, max_post=MAX_POST).awaitTermination()
    return read_payloads(spark, out).select(*J2_COLUMNS)


# Rows of a file of the extract that is damaged: no task writes more into one file, however large the extract is.
DAMAGED_FILE_ROWS = 3_000_000


def damage(spark, source: str, target: str) -> None:
    """Write to ``target`` a copy of the one Parquet file under ``source`` whose
    footer is whole and whose data pages are not. The half that is kept is copied
    from stream to stream: the file is never held in memory."""
    found = _parquet_files(spark, source).first()
    half = found["length"] // 2
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path, copy = jvm.org.apache.hadoop.fs.Path(found["path"]), jvm.org.apache.hadoop.fs.Path(target)
    nothing = spark.sparkContext._gateway.new_array(jvm.byte, 1 << 20)
    taken, out = path.getFileSystem(conf).open(path), copy.getFileSystem(conf).create(copy)
    try:
        out.writeInt(taken.readInt())
        for at in range(4, half, 1 << 20):
            out.write(nothing, 0, min(1 << 20, half - at))
        taken.seek(half)
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(taken, out, 1 << 16, False)
    finally:
        out.close()
        taken.close()


def _parquet_files(spark, root: str):
    """(path, length) of the Parquet files under ``root``; their content is not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").load(root).select("path", "length"))


@query("k1_damaged_extract", push_oracle("""
SELECT 'sent' AS what, period, count(*) AS n FROM cls WHERE class IN ('valid', 'to_delete') GROUP BY period
UNION ALL SELECT 'set aside', NULL, 1"""))
def q_k1_damaged(spark, sf_dir):
    """Good extracts and one whose data pages are damaged (footers whole) in every
    file. Every point of the good ones is sent, none of the damaged one's, whose files
    are listed."""
    root, out, ckpt = _scratch(spark, "extracts"), _scratch(spark, "push"), _scratch(spark, "stream")
    other = _scratch(spark, "other")
    dv = normalise_data_values(fixtures.view(spark, sf_dir, "fx_data_values"))
    io.write_extract(dv, root, extract_id="dsA", extract_period=F.col("period"))
    files = -(-dv.count() // DAMAGED_FILE_ROWS) or 1
    io.write_extract(dv, other, "dsB", SPLIT_MONTH, files_per_partition=files)
    for i, file in enumerate(_parquet_files(spark, other).toLocalIterator()):
        damage(spark, file["path"],
               f"{root}/data_type=DATA_ELEMENT/extract_id=dsB/extract_period={SPLIT_MONTH}/part-{i}.parquet")
    transform = uid_mapper(config_dim(spark, UID_ROWS, UID_MAPPING), UID_DEFAULTS)
    incremental_push(spark, root, out, ckpt, transform, max_post=MAX_POST, skip_unreadable=True).awaitTermination()
    sent = read_payloads(spark, out).groupBy("period").agg(F.sum("n_points").alias("n"))
    # Extracts, each a folder of the table; one has as many files as its size needs.
    aside = read_unreadable_files(spark, out).agg(
        F.count_distinct(F.regexp_replace("path", "/[^/]*$", "")).alias("n"))
    return (sent.select(F.lit("sent").alias("what"), "period", "n")
            .unionByName(aside.select(F.lit("set aside").alias("what"), F.lit(None).cast("string").alias("period"),
                                      "n")))


@query("k2_drain_until_finished", push_oracle(
    "SELECT class AS phase, period, count(*) AS n_points FROM cls WHERE class IN ('valid', 'to_delete') "
    "GROUP BY class, period"))
def q_k2(spark, sf_dir):
    """Drain a backlog in micro-batches of at most 48 files until nothing is left
    (availableNow), then stop. Batches of a period may now be cut per
    micro-batch, so the check is lossless delivery: every valid / to-delete
    point of every period is sent exactly once."""
    root, out, ckpt = _scratch(spark, "extracts"), _scratch(spark, "push"), _scratch(spark, "stream")
    dv = normalise_data_values(fixtures.view(spark, sf_dir, "fx_data_values"))
    transform = uid_mapper(config_dim(spark, UID_ROWS, UID_MAPPING), UID_DEFAULTS)
    io.write_extract(dv, root, extract_id="dsA", extract_period=F.col("period"), files_per_partition=2)
    incremental_push(spark, root, out, ckpt, transform, max_post=MAX_POST,
                     max_files_per_trigger=48).awaitTermination()
    return (read_payloads(spark, out).groupBy("phase", "period")
            .agg(F.sum("n_points").alias("n_points")))


_WEEK = "substr(period, 1, 4) || 'W' || CAST(CAST(substr(period, 5, 2) AS INT) * 4 AS {})"
_QUARTER = "substr(period, 1, 4) || 'Q' || CAST(CAST(floor((CAST(substr(period, 5, 2) AS INT) + 2) / 3) AS INT) AS {})"


@query("k3_change_detection", fixtures.with_views(["fx_data_values"], f"""
SELECT DISTINCT period AS unit, 'monthly' AS frequency FROM fx_data_values
UNION SELECT substr(period, 1, 4), 'yearly' FROM fx_data_values
UNION SELECT {_WEEK.format('VARCHAR')}, 'weekly' FROM fx_data_values
UNION SELECT {_QUARTER.format('VARCHAR')}, 'quarterly' FROM fx_data_values"""))
def q_k3(spark, sf_dir):
    """Writes at four frequencies, some periods twice; every period written is
    to be queued once, weeks 4 to 48 and quarters included."""
    root = _scratch(spark, "extracts")
    dv = normalise_data_values(fixtures.view(spark, sf_dir, "fx_data_values"))
    feed = io.write_extract(dv.where(F.col("period") < SPLIT_MONTH), root, "dsA", F.col("period"))
    feed = feed.unionByName(io.write_extract(dv.where(F.col("period") >= "1997"), root, "dsA", F.col("period")))
    for label, period in (("dsY", "substr(period, 1, 4)"), ("dsW", _WEEK.format("STRING")),
                          ("dsQ", _QUARTER.format("STRING"))):
        feed = feed.unionByName(io.write_extract(dv, root, label, F.expr(period)))
    return changed_units(feed)


@query("k5_pending_batches", fixtures.with_views(["fx_requested", "fx_finished"], """
SELECT r.unit, CAST(min(r.requested_at) AS VARCHAR) AS open_since, count(*) AS n_open_requests,
       CAST(max(d.last_finished) AS VARCHAR) AS last_finished
FROM fx_requested r LEFT JOIN last_done d ON d.unit = r.unit
WHERE d.last_finished IS NULL OR r.requested_at > d.last_finished
GROUP BY r.unit""", [("last_done", "SELECT unit, max(finished_at) AS last_finished FROM fx_finished GROUP BY unit")]))
def q_k5(spark, sf_dir):
    fixtures.register(spark, sf_dir, ["fx_requested", "fx_finished"])
    p = pending_batches(spark.table("fx_requested"), spark.table("fx_finished"))
    return p.select("unit", F.col("open_since").cast("string").alias("open_since"), "n_open_requests",
                    F.col("last_finished").cast("string").alias("last_finished"))


REOPEN = ("199601", "199612", "2100-01-01 00:00:00")


@query("k5_reopen_month_range", fixtures.with_views(["fx_requested", "fx_finished"], """
SELECT r.unit, CAST(min(r.requested_at) AS VARCHAR) AS open_since, count(*) AS n_open_requests,
       CAST(max(d.last_finished) AS VARCHAR) AS last_finished
FROM req r LEFT JOIN last_done d ON d.unit = r.unit
WHERE d.last_finished IS NULL OR r.requested_at > d.last_finished
GROUP BY r.unit""", [
    ("req", f"""SELECT unit, requested_at FROM fx_requested UNION ALL
      SELECT strftime(d, '%Y%m'), TIMESTAMP '{REOPEN[2]}' FROM (SELECT unnest(generate_series(
        strptime('{REOPEN[0]}', '%Y%m'), strptime('{REOPEN[1]}', '%Y%m'), INTERVAL 1 MONTH)) AS d) m"""),
    ("last_done", "SELECT unit, max(finished_at) AS last_finished FROM fx_finished GROUP BY unit")]))
def q_k5_reopen(spark, sf_dir):
    """Re-open a month range by hand (H1 months appended to the request log),
    then list what is pending."""
    fixtures.register(spark, sf_dir, ["fx_requested", "fx_finished"])
    months = spark.range(1).select(F.explode(month_range(F.lit(REOPEN[0]), F.lit(REOPEN[1]))).alias("unit"))
    requested = spark.table("fx_requested").unionByName(reopen_units(months, REOPEN[2]))
    p = pending_batches(requested, spark.table("fx_finished"))
    return p.select("unit", F.col("open_since").cast("string").alias("open_since"), "n_open_requests",
                    F.col("last_finished").cast("string").alias("last_finished"))
