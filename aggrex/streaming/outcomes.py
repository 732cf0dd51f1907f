"""Answers close the push loop (K1, K5, J7): a unit is done when its payloads succeeded.

The push (``incremental.push_batch``) writes payloads and a ``sent`` log per micro-batch;
a sender writes the target's answers to a table. What state a unit is in follows from
joins of these append-only tables by (micro-batch, payload): requested, sent,
confirmed or failed. Only units whose every payload was answered well are written to
the ``finished`` log, as of the time they were sent, so that a request made since stays
open; a failed unit is pending as before, and its payloads are due again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aggrex.operators.dims import sized_broadcast
from aggrex.operators.reports import parse_reports, request_failed
from aggrex.streaming.incremental import finish_units

UNIT_COLUMNS = ("extract_id", "period")


def unit_name(unit_cols=UNIT_COLUMNS) -> Column:
    """A unit's name in the logs of K5: its columns, joined."""
    return F.concat_ws("|", *unit_cols)


def payload_outcomes(payloads: DataFrame, responses: DataFrame, unit_cols=UNIT_COLUMNS,
                     generation: str = "gen2") -> DataFrame:
    """Per payload (micro_batch, phase, unit columns, batch_no): ``state`` — confirmed or
    failed by the last answer (J7's rule), unanswered without one — and ``attempts``.

    ``responses`` has the payload's key, ``attempt`` and the answer's ``body``. The
    last attempt counts; of two answers to one attempt the failure."""
    key = ["micro_batch", "phase", *unit_cols, "batch_no"]
    answered = parse_reports(responses).select(
        *key, F.col("attempt").cast("long").alias("attempt"), request_failed(generation).alias("_bad"))
    last = answered.groupBy(*key).agg(F.max(F.struct("attempt", "_bad")).alias("_last"),
                                      F.count_distinct("attempt").alias("attempts"))
    p, a = payloads.select(*key).alias("p"), last.alias("a")
    same = F.lit(True)
    for c in key:
        same = same & F.col(f"p.{c}").eqNullSafe(F.col(f"a.{c}"))
    state = (F.when(F.col("_last").isNull(), F.lit("unanswered")).when(F.col("_last._bad"), F.lit("failed"))
             .otherwise(F.lit("confirmed")))
    return p.join(a, same, "left").select("p.*", state.alias("state"),
                                          F.coalesce("attempts", F.lit(0)).cast("long").alias("attempts"))


def sendings(sent: DataFrame, outcomes: DataFrame, unit_cols=UNIT_COLUMNS) -> DataFrame:
    """Per unit and micro-batch: unit, micro_batch, sent_at, n_payloads, n_confirmed,
    n_failed and ``state``: failed when any payload failed, confirmed when all are (none
    to send included), else sent."""
    counts = outcomes.groupBy(unit_name(unit_cols).alias("unit"), "micro_batch").agg(
        F.count(F.lit(1)).alias("n_payloads"), F.count_if(F.col("state") == "confirmed").alias("n_confirmed"),
        F.count_if(F.col("state") == "failed").alias("n_failed"))
    log = sent.groupBy(unit_name(unit_cols).alias("unit"), "micro_batch").agg(F.max("sent_at").alias("sent_at"))
    out = log.join(counts, ["unit", "micro_batch"], "left").na.fill(0, ["n_payloads", "n_confirmed", "n_failed"])
    return out.withColumn("state", F.when(F.col("n_failed") > 0, "failed").when(
        F.col("n_confirmed") == F.col("n_payloads"), "confirmed").otherwise("sent"))


def unit_states(requested: DataFrame, sent_units: DataFrame) -> DataFrame:
    """Every unit ever requested or sent, with its state: that of its last sending, or
    ``requested`` when a request is newer than that. ``sent_units`` are ``sendings``."""
    asked = requested.groupBy("unit").agg(F.max("requested_at").alias("requested_at"))
    last = sent_units.groupBy("unit").agg(F.max_by(F.struct(
        "micro_batch", "sent_at", "n_payloads", "n_confirmed", "n_failed", "state"), "micro_batch").alias("s"))
    both = asked.join(last, "unit", "full")
    newer = F.col("s").isNull() | F.coalesce(F.col("requested_at") > F.col("s.sent_at"), F.lit(False))
    return both.select("unit", F.when(newer, F.lit("requested")).otherwise(F.col("s.state")).alias("state"),
                       "requested_at", *[F.when(~newer, F.col(f"s.{c}")).alias(c) for c in (
                           "micro_batch", "sent_at", "n_payloads", "n_confirmed", "n_failed")])


def confirmed_units(sent_units: DataFrame) -> DataFrame:
    """Rows for the ``finished`` log: confirmed units, as of when they were sent."""
    return finish_units(sent_units.where("state = 'confirmed'"), F.col("sent_at"))


def due_payloads(payloads: DataFrame, outcomes: DataFrame, unit_cols=UNIT_COLUMNS,
                 unanswered: bool = True) -> DataFrame:
    """The payloads to send (again), with ``attempt``: of each unit's last micro-batch — an
    older one is superseded — those that failed and, unless left out, those without an
    answer."""
    key = ["micro_batch", "phase", *unit_cols, "batch_no"]
    last = payloads.groupBy(*unit_cols).agg(F.max("micro_batch").alias("_last"))
    wanted = ["failed", "unanswered"] if unanswered else ["failed"]
    due = outcomes.where(F.col("state").isin(wanted)).alias("o")
    p, n = payloads.alias("p"), last.alias("n")
    newest = F.col("p.micro_batch") == F.col("n._last")
    for c in unit_cols:
        newest = newest & F.col(f"p.{c}").eqNullSafe(F.col(f"n.{c}"))
    same = F.lit(True)
    for c in key:
        same = same & F.col(f"p.{c}").eqNullSafe(F.col(f"o.{c}"))
    return p.join(n, newest, "left_semi").join(due, same).select(
        "p.*", (F.col("o.attempts") + 1).alias("attempt"))


def settle_batch(out_root: str, responses_root: str, responses_schema: str, finished_root: str,
                 unit_cols=UNIT_COLUMNS, generation: str = "gen2") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body over new answers: the micro-batches they answer are looked at
    again, with all their answers, and the units confirmed by now are written to the
    ``finished`` log under the batch's number (overwrite). A replay writes the same or,
    if more answers have come, more; a unit finished twice is finished."""
    def run(new: DataFrame, batch_id: int) -> None:
        spark = new.sparkSession
        touched = new.select(F.col("micro_batch").cast("long").alias("batch_id")).distinct().checkpoint(eager=True)
        few = sized_broadcast(touched)

        def of(name: str) -> DataFrame:  # the join on the folder's number prunes the folders
            return spark.read.parquet(f"{out_root}/{name}").join(few, "batch_id", "left_semi").drop("batch_id")

        answers = spark.read.schema(responses_schema).parquet(responses_root).join(
            sized_broadcast(touched.select(F.col("batch_id").alias("micro_batch"))), "micro_batch", "left_semi")
        outcomes = payload_outcomes(of("payloads"), answers, unit_cols, generation)
        confirmed_units(sendings(of("sent"), outcomes, unit_cols)).write.mode("overwrite").parquet(
            f"{finished_root}/batch_id={batch_id}")
    return run


def settle_stream(spark: SparkSession, out_root: str, responses_root: str, responses_schema: str,
                  finished_root: str, checkpoint: str, unit_cols=UNIT_COLUMNS, generation: str = "gen2",
                  continuous_every: str | None = None):
    """New answers under ``responses_root`` through ``settle_batch``; drains and stops, or
    keeps polling. Returns the query handle."""
    body = settle_batch(out_root, responses_root, responses_schema, finished_root, unit_cols, generation)
    w = (spark.readStream.schema(responses_schema).parquet(responses_root).writeStream.foreachBatch(body)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(processingTime=continuous_every) if continuous_every else w.trigger(availableNow=True)
    return w.start()
