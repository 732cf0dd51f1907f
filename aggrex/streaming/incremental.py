"""Incremental push (K1-K3, K5) on Structured Streaming.

The reference's producer -> persistent queue -> polling consumer becomes:
extract writers append partitions to the extract table; a file stream over
that table takes every new file exactly once (the checkpoint is the queue);
``foreachBatch`` maps, classifies and batches each micro-batch and writes the
payloads keyed by the micro-batch id, so a replay after a failure rewrites
the same output instead of duplicating it.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aggrex.operators.dims import sized_broadcast
from aggrex.operators.mapping import dispatch_by_type
from aggrex.operators.push import classify_data_points, payload_batches
from aggrex.sources.io import EXTRACT_PARTITIONS, EXTRACT_TABLE, SWITCH, UNREADABLE_FILE, split_readable

# Fixed value: the columns of Spark's binaryFile source.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"
# Fixed value: the data type of the file that ends a run.
END_MARKER = "FINISH"
# Files a micro-batch takes at most, so that a backlog is worked off in batches of bounded size.
MAX_FILES_PER_TRIGGER = 1000


def extract_stream(spark: SparkSession, root: str,
                   max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """New files of the partitioned extract table, with its fixed schema. A file
    that cannot be read fails the stream (``incremental_push`` can set such
    files aside instead); nothing is skipped silently."""
    r = spark.readStream.schema(EXTRACT_TABLE).option("ignoreCorruptFiles", "false")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(root)


def push_batch(transform, out_root: str, max_post: int = 500,
               generation: str = "gen2", group_cols: tuple = ("extract_id", "period"),
               require_numeric: bool = False) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` body of K1: map -> classify (I1) -> batch (J2) ->
    write payloads and the quarantine under ``batch_id=<micro-batch id>``
    (overwrite: idempotent on replay).

    With ``require_numeric`` (rate extracts) values must be numbers and are
    sent as JSON numbers.

    The mapping is evaluated once: its rows are written by class
    (``classified``) and counted on the way; payloads, the quarantine and the
    ``sent`` log (rows per unit and class, with the time) are made from there.
    Outcomes close the loop in ``streaming.outcomes``.

    ``transform`` is either one mapping function or a dict {data type:
    mapping function} (B12); with a dict, rows of a type without a handler
    are skipped from the push and written to ``unknown_types``.
    """
    def run(df: DataFrame, batch_id: int) -> None:
        if isinstance(transform, dict):
            mapped, unknown = dispatch_by_type(df, transform)
            unknown.write.mode("overwrite").parquet(f"{out_root}/unknown_types/batch_id={batch_id}")
        else:
            mapped = transform(df)
        classified = classify_data_points(mapped, require_numeric=require_numeric).withColumn(
            "missing", F.array_join("missing", ","))
        # The one evaluation of the mapping: counted as it is written, by class; all else reads these files.
        staged = f"{out_root}/classified/batch_id={batch_id}"
        seen = Observation()
        (classified.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("class") == "invalid").alias("bad"))
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("class").parquet(staged))
        if not seen.get["rows"]:
            return
        points = df.sparkSession.read.schema(classified.schema).parquet(staged)
        sent = points.groupBy(*group_cols).agg(
            *[F.count_if(F.col("class") == c).alias(f"n_{c}") for c in ("valid", "to_delete", "invalid")])
        (sent.withColumn("micro_batch", F.lit(batch_id).cast("long")).withColumn("sent_at", F.current_timestamp())
         .write.mode("overwrite").parquet(f"{out_root}/sent/batch_id={batch_id}"))
        batches = payload_batches(points, max_post=max_post, generation=generation,
                                  group_cols=list(group_cols), value_as_number=require_numeric)
        (batches.withColumn("micro_batch", F.lit(batch_id)).write.mode("overwrite")
                .parquet(f"{out_root}/payloads/batch_id={batch_id}"))
        if seen.get["bad"]:
            (points.where(F.col("class") == "invalid")
             .write.mode("overwrite").parquet(f"{out_root}/quarantine/batch_id={batch_id}"))
    return run


def push_readable_files(extract_root: str, out_root: str, push: Callable[[DataFrame, int], None]
                        ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body over new *paths*: files that read in full are
    pushed; the others are written to ``unreadable_files`` under the batch id
    (path, error), none of their rows are sent, and the run goes on. The files
    of a micro-batch are at most ``max_files_per_trigger`` paths."""
    def run(files: DataFrame, batch_id: int) -> None:
        spark = files.sparkSession
        paths = [r["path"] for r in files.select("path").collect()]
        good, bad = split_readable(spark, paths, EXTRACT_TABLE, base_path=extract_root)
        if bad:
            (spark.createDataFrame(bad, UNREADABLE_FILE).write.mode("overwrite")
             .parquet(f"{out_root}/unreadable_files/batch_id={batch_id}"))
        if good:
            push(spark.read.schema(EXTRACT_TABLE).option("basePath", extract_root).parquet(*good), batch_id)
    return run


class Finished(Exception):
    """A micro-batch after the end marker: it is not processed, so its files stay for the next run."""


def write_end_marker(spark: SparkSession, extract_root: str, run: str) -> None:
    """K2: the producer's last act: a file in the extract table that says that ``run`` is over."""
    row = spark.createDataFrame([(END_MARKER, run)], "data_type string, extract_id string")
    row = row.withColumn("extract_period", F.lit(END_MARKER))
    columns = [F.col(c) if c in row.columns else F.lit(None).cast("string").alias(c) for c in EXTRACT_TABLE.names]
    (row.select(*columns).coalesce(1).write.mode("append").partitionBy(*EXTRACT_PARTITIONS).parquet(extract_root))


def until_marker(spark: SparkSession, extract_root: str, out_root: str, push: Callable[[DataFrame, int], None],
                 ended: dict) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body that stops at the end marker: files no newer than the
    marker are pushed; the paths of newer ones in the same micro-batch (as many as
    a micro-batch may take) are written to ``carried_over`` for the next run, and
    ``ended`` tells that the query is to end."""
    def run(df: DataFrame, batch_id: int) -> None:
        if "batch" in ended and batch_id > ended["batch"]:
            raise Finished(f"micro-batch {batch_id} comes after the end marker")
        # A filter on the partition column: only marker files are read.
        marker = df.where(F.col("data_type") == END_MARKER).agg(F.min("_modified")).first()[0]
        points = df.where(F.col("data_type") != END_MARKER) if marker is not None else df
        if marker is not None:
            later = points.where(F.col("_modified") > F.lit(marker)).select("_path").distinct()
            later.write.mode("overwrite").parquet(f"{out_root}/carried_over/batch_id={batch_id}")
            points = points.where(F.col("_modified") <= F.lit(marker))
        push(points.drop("_path", "_modified"), batch_id)
        if marker is not None:
            ended["batch"] = batch_id
    return run


def push_carried_over(spark: SparkSession, extract_root: str, out_root: str, push: Callable[[DataFrame, int], None]
                      ) -> None:
    """The files that a run left behind its end marker, under the number -(batch + 1); what was
    pushed already is written again with the same content."""
    schema = "_path string, batch_id long"
    try:
        left = spark.read.schema(schema).parquet(f"{out_root}/carried_over")
    except AnalysisException:  # no run has ended by a marker
        return
    done = [r["batch_id"] for r in _carried_done(spark, out_root).collect()]  # one row per ended run
    for row in left.where(~F.col("batch_id").isin(done)).select("batch_id").distinct().collect():
        paths = [r["_path"] for r in left.where(F.col("batch_id") == row["batch_id"]).collect()]
        push(spark.read.schema(EXTRACT_TABLE).option("basePath", extract_root).parquet(*paths), -row["batch_id"] - 1)
        (spark.range(1).select(F.lit(row["batch_id"]).alias("batch_id")).write.mode("append")
         .parquet(f"{out_root}/carried_over_done"))


def _carried_done(spark: SparkSession, out_root: str) -> DataFrame:
    try:
        return spark.read.schema("batch_id long").parquet(f"{out_root}/carried_over_done")
    except AnalysisException:
        return spark.createDataFrame([], "batch_id long")


def _stop_when_ended(query, ended: dict, every: float = 0.2) -> None:
    """Stop ``query`` once the micro-batch that saw the end marker is committed."""
    def watch():
        while query.isActive:
            progress = query.lastProgress
            if "batch" in ended and progress is not None and progress["batchId"] >= ended["batch"]:
                query.stop()
                return
            time.sleep(every)
    threading.Thread(target=watch, daemon=True).start()


def incremental_push(spark: SparkSession, extract_root: str, out_root: str, checkpoint: str,
                     transform: Callable[[DataFrame], DataFrame], max_post: int = 500, generation: str = "gen2",
                     continuous_every: str | None = None, skip_unreadable: bool = False,
                     max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER, end_marker: bool = False, **kw):
    """K1 + K2: run the push consumer. By default drain everything available
    and stop (``availableNow``); with ``continuous_every`` (e.g. '5 minutes')
    keep polling like the reference's wait loop. With ``end_marker`` the query ends
    by itself after the micro-batch that saw the producer's marker
    (``write_end_marker``): what was written after the marker is left for the next
    run. An unreadable file fails the query, or with ``skip_unreadable`` is set aside
    (``push_readable_files``; not together with ``end_marker``). Returns the query
    handle."""
    if skip_unreadable and end_marker:
        raise ValueError("end_marker needs readable extracts")
    body = push_batch(transform, out_root, max_post, generation, **kw)
    ended: dict = {}
    if skip_unreadable:
        # The listing is the queue: the content column is not read here.
        r = (spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", "*.parquet"))
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        w = r.load(extract_root).select("path").writeStream.foreachBatch(
            push_readable_files(extract_root, out_root, body))
    else:
        files = extract_stream(spark, extract_root, max_files_per_trigger)
        if end_marker:
            push_carried_over(spark, extract_root, out_root, body)
            files = files.select("*", F.col("_metadata.file_path").alias("_path"),
                                 F.col("_metadata.file_modification_time").alias("_modified"))
            body = until_marker(spark, extract_root, out_root, body, ended)
        w = files.writeStream.foreachBatch(body)
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=continuous_every) if continuous_every else w.trigger(availableNow=True)
    query = w.start()
    if end_marker:
        _stop_when_ended(query, ended)
    return query


def read_unreadable_files(spark: SparkSession, out_root: str) -> DataFrame:
    """The files set aside so far (path, error, batch_id)."""
    return spark.read.schema(f"{UNREADABLE_FILE}, batch_id bigint").parquet(f"{out_root}/unreadable_files")


def read_payloads(spark: SparkSession, out_root: str) -> DataFrame:
    """A11 read side: all payload batches written so far."""
    return spark.read.parquet(f"{out_root}/payloads")


def changed_units(written_partitions: DataFrame, run_months: DataFrame | None = None) -> DataFrame:
    """K3: (unit, frequency) to (re)queue for the partitions written
    (``write_extract``'s feed: extract_period, frequency).

    Every period whose extract was written is a unit, at its own frequency:
    months, weeks, quarters and years. When the run is by month (``run_months``:
    (month), period-sized), a rewritten year re-queues the run's months of that
    year instead of itself, as monthly units are merged with their year."""
    units = written_partitions.select(F.col("extract_period").alias("unit"), "frequency")
    if run_months is None:
        return units.distinct()
    months = sized_broadcast(run_months.select(F.col("month").alias("unit")).distinct())
    years = units.where(F.col("frequency") == "yearly").select(F.col("unit").alias("_year")).distinct()
    yearly = years.join(months, F.col("_year") == F.substring("unit", 1, 4)).select(
        "unit", F.lit("monthly").alias("frequency"))
    return units.where(~F.col("frequency").eqNullSafe("yearly")).unionByName(yearly).distinct()


def enqueue_switches(spark: SparkSession, root: str, requested_root: str, checkpoint: str,
                     run_months: DataFrame | None = None):
    """K3 -> K5 without a gap: the switch files of a versioned extract table
    (``write_extract_version``) are streamed into the ``requested`` log. The switch is
    written in the extract's own commit, the stream takes every switch file once, and
    a micro-batch writes its folder by its number with overwrite: a crash anywhere
    between the write and the request loses no unit and requests none twice. Drains
    what is there and stops; returns the query handle."""
    def run(df: DataFrame, batch_id: int) -> None:
        # One request per unit and switch, as old as the switch: a replay writes the same rows.
        units = df.select("written_at", "extract_period", "frequency").distinct()
        (changed_units_at(units, run_months).select("unit", F.col("written_at").alias("requested_at")).distinct()
         .write.mode("overwrite").parquet(f"{requested_root}/batch_id={batch_id}"))

    stream = spark.readStream.schema(SWITCH).parquet(f"{root}/switches/*")
    return (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def changed_units_at(switches: DataFrame, run_months: DataFrame | None) -> DataFrame:
    """``changed_units`` per time of writing: (unit, frequency, written_at)."""
    units = switches.select(F.col("extract_period").alias("unit"), "frequency", "written_at")
    if run_months is None:
        return units.distinct()
    months = sized_broadcast(run_months.select(F.col("month").alias("unit")).distinct())
    years = units.where(F.col("frequency") == "yearly").select(F.col("unit").alias("_year"), "written_at").distinct()
    yearly = years.join(months, F.col("_year") == F.substring("unit", 1, 4)).select(
        "unit", F.lit("monthly").alias("frequency"), "written_at")
    return units.where(~F.col("frequency").eqNullSafe("yearly")).unionByName(yearly).distinct()


def read_log(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """An append-only log of (unit, time) rows, written under ``batch_id=...``; empty before its first batch."""
    try:
        return spark.read.schema(f"{schema}, batch_id long").parquet(root).drop("batch_id")
    except AnalysisException:
        return spark.createDataFrame([], schema)


def pending_batches(requested: DataFrame, finished: DataFrame) -> DataFrame:
    """K5: units still to do. ``requested`` (unit, requested_at) and
    ``finished`` (unit, finished_at) are append-only logs; a unit is pending
    when it was requested after it last finished. ``open_since`` is the first
    such request (the FIFO order), ``n_open_requests`` how many are open."""
    # One row per unit (units are periods / files, not data): broadcast when
    # provably small, so a unit requested very often does not skew the join.
    last_done = sized_broadcast(finished.groupBy("unit").agg(F.max("finished_at").alias("last_finished")))
    open_req = (requested.join(last_done, "unit", "left")
                .where(F.col("last_finished").isNull() | (F.col("requested_at") > F.col("last_finished"))))
    return open_req.groupBy("unit").agg(F.min("requested_at").alias("open_since"),
                                        F.count(F.lit(1)).alias("n_open_requests"),
                                        F.max("last_finished").alias("last_finished"))


def _at(at):
    return at if not isinstance(at, str) else F.lit(at).cast("timestamp")


def reopen_units(units: DataFrame, at) -> DataFrame:
    """K5 enqueue / re-open by hand (e.g. a month range from H1): the rows to
    append to the ``requested`` log so the units are pending (again)."""
    return units.select(F.col("unit"), _at(at).alias("requested_at"))


request_units = reopen_units


def finish_units(units: DataFrame, at) -> DataFrame:
    """K5 dequeue: the rows to append to the ``finished`` log once a unit has
    been pushed successfully."""
    return units.select(F.col("unit"), _at(at).alias("finished_at"))


def next_pending(pending: DataFrame) -> DataFrame:
    """K5 peek: the pending unit requested first (FIFO), as one row — an
    aggregate, not a sort of the pending set."""
    return pending.agg(F.min_by("unit", F.struct("open_since", "unit")).alias("unit"),
                       F.min("open_since").alias("open_since"), F.count(F.lit(1)).alias("n_pending"))


TODO_UNIT = "dataset string, period string, org_unit string"
SENT_UNIT = "dataset string, period string, org_unit string, batch_id bigint"
ANSWER = "dataset string, period string, org_unit string, outcome string, of_batch bigint"
LEDGER_UNIT = "dataset string, period string, org_unit string, batch_id bigint"


def sync_batch(ledger_path: str, out_root: str, registrations: DataFrame, dataset_pairs: DataFrame,
               order_col: str, direct: DataFrame | None = None, todo_root: str | None = None
               ) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` body of K4: skip units that the ledger has from
    *other* batches, write the payloads of the rest under ``batch_id=<id>``
    (overwrite), and put into the ledger, under the same batch id, the units
    that have no status and so nothing to push. Units that were sent join the
    ledger once their response says so (``record_outcomes``), so a failed push
    is tried again. A replayed batch sees the ledger as it was for its first
    run: it rewrites the same payloads and the same ledger rows.

    With ``todo_root`` the todo table is the state and the micro-batch only the
    signal: every unit of the table that is not done is due, whenever its file
    came. What this run has sent already waits for its answer; a failure that
    is recorded (``record_outcomes`` with ``out_root``) makes it due again, and so
    does the start of another run."""
    from aggrex.operators.completion import UNIT, completion_sync

    first_batch: list[int] = []

    def in_flight(spark: SparkSession, batch_id: int) -> DataFrame:
        sent = (spark.read.schema(SENT_UNIT).parquet(f"{out_root}/completions")
                .where((F.col("batch_id") >= first_batch[0]) & (F.col("batch_id") < batch_id))
                .groupBy(*UNIT).agg(F.max("batch_id").alias("sent_in")))
        try:
            answers = spark.read.schema(ANSWER).parquet(f"{out_root}/answers")
        except AnalysisException:
            return sent.select(*UNIT)
        bad = answers.where("outcome <> 'ok'").groupBy(*UNIT).agg(F.max("of_batch").alias("failed_in"))
        return (sent.join(bad, UNIT, "left").where("failed_in is null or failed_in < sent_in").select(*UNIT))

    def run(todo: DataFrame, batch_id: int) -> None:
        spark = todo.sparkSession
        if not first_batch:
            first_batch.append(batch_id)
        if todo_root is not None:
            todo = spark.read.schema(TODO_UNIT).parquet(todo_root).distinct()
            if batch_id > first_batch[0]:
                todo = todo.join(in_flight(spark, batch_id), UNIT, "left_anti")
        elif todo.isEmpty():
            return
        ledger = spark.read.schema(LEDGER_UNIT).parquet(ledger_path)
        ledger = ledger.where(~F.col("batch_id").eqNullSafe(F.lit(batch_id)))
        payloads, additions = completion_sync(todo, registrations, ledger, dataset_pairs, order_col, direct,
                                              scratch=f"{out_root}/looked_up")
        # Computed before it is written: the ledger is also an input.
        additions = additions.checkpoint(eager=True)
        payloads.write.mode("overwrite").parquet(f"{out_root}/completions/batch_id={batch_id}")
        (additions.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(ledger_path))
    return run


def completion_sync_stream(spark: SparkSession, todo_root: str, ledger_path: str, out_root: str,
                           checkpoint: str, registrations: DataFrame, dataset_pairs: DataFrame,
                           order_col: str, direct: DataFrame | None = None, continuous_every: str | None = None,
                           max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER):
    """K4 as a stream: files of (dataset, period, org_unit) units to sync under
    ``todo_root`` are the state, new files the signal. A run starts with a file
    without rows, so it looks at what is still to be done when nothing new came: units
    whose push failed are sent again without being written again. Returns the query
    handle."""
    spark.createDataFrame([], TODO_UNIT).coalesce(1).write.mode("append").parquet(todo_root)
    body = sync_batch(ledger_path, out_root, registrations, dataset_pairs, order_col, direct, todo_root)
    r = spark.readStream.schema(TODO_UNIT)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    w = r.parquet(todo_root).writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=continuous_every) if continuous_every else w.trigger(availableNow=True)
    return w.start()


def record_outcomes(outcomes: DataFrame, ledger_path: str, batch_id: int, out_root: str | None = None,
                    of_batch: int | None = None) -> None:
    """G3 + J8: the units whose push succeeded join the ledger under ``batch_id`` (a
    number of the caller's own, e.g. negative for outcomes). Later calls with the same
    number add to it; a repeated call changes nothing. Failed pushes stay out and are
    due again: by the next run, or, when the answers to micro-batch ``of_batch`` are
    also recorded under ``out_root``, by the next micro-batch."""
    from aggrex.operators.completion import UNIT, successful_units

    spark = outcomes.sparkSession
    known = spark.read.schema(LEDGER_UNIT).parquet(ledger_path).where(F.col("batch_id") == batch_id).select(*UNIT)
    done = successful_units(outcomes).unionByName(known).distinct().checkpoint(eager=True)
    (done.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(ledger_path))
    if out_root is not None:
        (outcomes.select(*UNIT, "outcome", F.lit(of_batch).cast("long").alias("of_batch")).write.mode("append")
         .parquet(f"{out_root}/answers"))
