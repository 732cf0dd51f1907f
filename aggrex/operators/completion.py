"""Dataset completion sync.

All (dataset, period) pairs are processed in one job: the reference's loop
over org units becomes joins keyed by (period, org_unit).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aggrex.operators.dims import sized_broadcast
from aggrex.operators.hierarchy import descendants_by_path, select_descendants
from aggrex.operators.reports import COUNT_KEYS


UNIT = ["dataset", "period", "org_unit"]


def completions_under(registrations: DataFrame, units: DataFrame, parents: list[str],
                      dataset: str | None = None, period: str | list[str] | None = None,
                      use_path: bool = True) -> DataFrame:
    """Registrations of ``dataset`` and ``period`` for the parents and all
    their descendants (the bulk table the reference fetches per parent)."""
    below = descendants_by_path(units, parents) if use_path else select_descendants(units, parents)
    regs = registrations if dataset is None else registrations.where(F.col("dataSet") == F.lit(dataset))
    if period is not None:
        regs = regs.where(F.col("period").isin([period] if isinstance(period, str) else list(period)))
    return regs.join(sized_broadcast(below.select(F.col("id").alias("organisationUnit"))),
                     "organisationUnit", "left_semi")


def unprocessed_org_units(todo: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """(dataset, period, org_unit) units not yet in the ledger; NULL ledger
    rows are ignored; no ledger -> everything."""
    if ledger is None:
        return todo
    done = ledger.where(F.col("org_unit").isNotNull()).select(*UNIT)
    return todo.join(done, UNIT, "left_anti")


def first_registration(registrations: DataFrame, order_col: str) -> DataFrame:
    """One registration per (dataSet, period, organisationUnit): the first by
    ``order_col``. A partial aggregation (min_by), so no group is gathered."""
    cols = [c for c in registrations.columns]
    return (registrations.groupBy("dataSet", "period", "organisationUnit")
            .agg(F.min_by(F.struct(*cols), F.col(order_col)).alias("_r")).select("_r.*"))


def completion_lookup(todo: DataFrame, registrations: DataFrame, order_col: str,
                      direct: DataFrame | None = None, scratch: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(with status, without status) for the todo units (dataset, period,
    org_unit): the first registration from the bulk table (A8); units it lacks
    — of that dataset — take the first of ``direct`` (all registrations, the
    reference's per-unit fetch) when given. One aggregation over both (bulk
    before direct), one join. Units without any status have nothing to push
    but still count as processed. With ``scratch`` the join is written
    there (replacing what an earlier call left), so that who reads both results does not run it twice."""
    every = registrations.withColumn("_direct", F.lit(0))
    if direct is not None:
        every = every.unionByName(direct.withColumn("_direct", F.lit(1)), allowMissingColumns=True)
    cols = [c for c in registrations.columns]
    first = (every.groupBy("dataSet", "period", "organisationUnit")
             .agg(F.min_by(F.struct(*cols), F.struct("_direct", order_col)).alias("_r")).select("_r.*")
             .withColumnsRenamed({"organisationUnit": "org_unit", "dataSet": "dataset"}))
    looked_up = todo.join(first.withColumn("_found", F.lit(True)), UNIT, "left")
    if scratch is not None:
        looked_up.write.mode("overwrite").parquet(scratch)
        looked_up = todo.sparkSession.read.schema(looked_up.schema).parquet(scratch)
    with_status = looked_up.where(F.col("_found").isNotNull()).drop("_found")
    without = looked_up.where(F.col("_found").isNull()).select(*UNIT, *[c for c in todo.columns if c not in UNIT])
    return with_status, without


def completion_payload(status: DataFrame, dataset_pairs: DataFrame) -> DataFrame:
    """The registration for the target: source dataset id replaced by the
    target one (broadcast join on the configured pairs), date and completed
    carried, wrapped as ``{"completeDataSetRegistrations":[..]}``."""
    pairs = sized_broadcast(dataset_pairs.select(F.col("source_dataset").alias("dataset"), "target_dataset"))
    j = status.join(pairs, "dataset", "inner")
    reg = F.struct(F.col("org_unit").alias("organisationUnit"), F.col("period").alias("period"),
                   F.col("completed").alias("completed"), F.col("date").alias("date"),
                   F.col("target_dataset").alias("dataSet"))
    return j.select("dataset", "period", "org_unit", "target_dataset",
                    F.to_json(F.struct(F.array(reg).alias("completeDataSetRegistrations"))).alias("payload"))


def split_fetch_errors(registrations: DataFrame, corrupt_column: str = "_corrupt_record"
                       ) -> tuple[DataFrame, DataFrame]:
    """(registrations, failed fetches): lines of a completions dump that were
    not valid JSON are the fetches that failed (read with ``corrupt_column``)."""
    ok = registrations.where(F.col(corrupt_column).isNull()).drop(corrupt_column)
    # Referencing another column besides the corrupt one keeps the read legal.
    failed = registrations.where(F.col(corrupt_column).isNotNull() & F.col("dataSet").isNull()) \
        .select(corrupt_column)
    return ok, failed


def completion_summary(outcomes: DataFrame, by: list[str] = (), fetch_errors: int | None = None) -> DataFrame:
    """Import counts and push errors summed, plus the number of failed
    fetches when given (one number for the run)."""
    agg = outcomes.groupBy(*by).agg(
        *[F.sum(k).alias(k) for k in COUNT_KEYS], F.sum("push_errors").alias("push_errors"),
        F.count(F.lit(1)).alias("n_responses"),
        F.count_if(F.col("outcome") == "ok").alias("n_ok"))
    if fetch_errors is not None:
        agg = agg.withColumn("fetch_errors", F.lit(int(fetch_errors)).cast("bigint"))
    return agg


def successful_units(outcomes: DataFrame) -> DataFrame:
    """Units whose completion was pushed (J8 outcome 'ok'): only these are done.
    A failed push stays out of the ledger and is tried again by the next run."""
    return outcomes.where(F.col("outcome") == "ok").select(*UNIT).distinct()


def merge_ledger(existing: DataFrame | None, processed: DataFrame) -> DataFrame:
    """Rows to append so the ledger holds existing ∪ processed — only the
    new (dataset, period, org_unit) units, so appends stay idempotent."""
    new = processed.select(*UNIT).where(F.col("org_unit").isNotNull()).distinct()
    if existing is None:
        return new
    return new.join(existing.select(*UNIT), UNIT, "left_anti")


def completion_sync(todo: DataFrame, registrations: DataFrame, ledger: DataFrame | None,
                    dataset_pairs: DataFrame, order_col: str,
                    direct: DataFrame | None = None, scratch: str | None = None) -> tuple[DataFrame, DataFrame]:
    """K4: one resumable step: skip processed units (C12), look up their status
    (C13), build payloads (J4). The ledger rows returned are the units without a
    status — done, as nothing is to be pushed; units with a payload follow once
    their outcome is known (``successful_units``). ``scratch``: see ``completion_lookup``."""
    todo_now = unprocessed_org_units(todo, ledger)
    with_status, without = completion_lookup(todo_now, registrations, order_col, direct, scratch)
    payloads = completion_payload(with_status, dataset_pairs)
    return payloads, merge_ledger(ledger, without)
