"""Extraction planning (B5, B6, B9-B11, C10, C14): which (item, month,
period, product) units to read, as DataFrames. Items and rate items are
configuration-sized; everything that grows (org units, data elements,
months, data) is joined, never crossed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aggrex.functions.periods import extract_periods, month_range, periods_for_frequency
from aggrex.operators.dims import sized_broadcast


def item_names(items: DataFrame) -> DataFrame:
    """Item name = its datasets joined by '__'; a repeated name gets
    '__2', '__3', ... in item order. (Window over configuration rows.)"""
    base = items.withColumn("_base", F.concat_ws("__", "data_sets"))
    n = F.row_number().over(Window.partitionBy("_base").orderBy("item_pos"))
    return (base.withColumn("_n", n)
                .withColumn("item_name", F.when(F.col("_n") == 1, F.col("_base"))
                            .otherwise(F.concat(F.col("_base"), F.lit("__"), F.col("_n").cast("string"))))
                .drop("_base", "_n"))


def first_dataset(items: DataFrame, datasets: DataFrame) -> DataFrame:
    """(item_pos, dataset_id) — the first metadata dataset (by ``ds_pos``)
    among the item's datasets, as the reference takes the first match."""
    pairs = items.select("item_pos", F.explode("data_sets").alias("dataset_id"))
    j = pairs.join(datasets.select(F.col("id").alias("dataset_id"), "ds_pos").distinct(), "dataset_id")
    return j.groupBy("item_pos").agg(F.min_by("dataset_id", "ds_pos").alias("dataset_id"))


def scope_org_units(items: DataFrame, datasets: DataFrame, ds_org_units: DataFrame,
                    first_only: bool = False) -> DataFrame:
    """(item_pos, org_unit) — the org units assigned to any of the item's
    datasets (or, with ``first_only``, to its first metadata dataset alone)."""
    if first_only:
        chosen = first_dataset(items, datasets)
    else:
        chosen = items.select("item_pos", F.explode("data_sets").alias("dataset_id"))
    return chosen.join(ds_org_units, "dataset_id").select("item_pos", "org_unit").distinct()


def scope_data(data: DataFrame, scope: DataFrame, elements: DataFrame,
               org_unit_col: str = "org_unit", element_col: str = "dx_uid") -> DataFrame:
    """B5 + B6 applied to data: the rows of each item — org unit in the item's
    scope and data element among the item's elements. Both dimensions are
    configuration-derived; they are broadcast when provably small, so a hot
    org unit in the data is never funnelled into one join task."""
    sc = sized_broadcast(scope.withColumnRenamed("org_unit", "_scope_ou"))
    el = sized_broadcast(elements.withColumnsRenamed({"data_element": "_scope_de", "item_pos": "_scope_item"}))
    return (data.join(sc, F.col(org_unit_col) == F.col("_scope_ou"))
                .join(el, (F.col("item_pos") == F.col("_scope_item")) & (F.col(element_col) == F.col("_scope_de")))
                .drop("_scope_ou", "_scope_de", "_scope_item"))


def item_data_elements(items: DataFrame, datasets: DataFrame, ds_elements: DataFrame) -> DataFrame:
    """(item_pos, data_element) — the listed elements, or, for an item
    listing none, all elements of its first metadata dataset."""
    listed = items.select("item_pos", F.explode("data_elements").alias("data_element"))
    empty = items.where(F.size(F.coalesce("data_elements", F.array())) == 0).select("item_pos")
    defaulted = (first_dataset(items, datasets).join(empty, "item_pos", "left_semi")
                 .join(ds_elements, "dataset_id").select("item_pos", "data_element"))
    return listed.unionByName(defaulted).distinct()


def rate_keys(rate_items: DataFrame) -> DataFrame:
    """(extract_uid, dataset_uid, metric, rate_key = 'dataset.metric')."""
    return (rate_items.select("extract_uid", "dataset_uid", F.explode("metrics").alias("metric"))
                      .withColumn("rate_key", F.concat_ws(".", "dataset_uid", "metric")))


def rejected_rate_items(rate_items: DataFrame) -> DataFrame:
    """B10 rejects: rate items without id, dataset or metrics, with the reason."""
    reason = (F.when(F.col("extract_uid").isNull(), F.lit("no EXTRACT_UID"))
               .when(F.col("dataset_uid").isNull(), F.lit("no DATASET_UID"))
               .when(F.size(F.coalesce("metrics", F.array())) == 0, F.lit("no METRICS")))
    return rate_items.withColumn("reason", reason).where(F.col("reason").isNotNull())


def rate_extraction_plan(rate_items: DataFrame, as_of) -> DataFrame:
    """B10, second generation: every valid rate extract x its periods (H7:
    explicit start / end, else ``period_window`` periods back from ``as_of``,
    at the extract's own frequency) x its metrics, as
    (extract_uid, dataset_uid, metric, rate_key, period). Rejected items (see
    ``rejected_rate_items``) are left out. Configuration-sized."""
    valid = rate_items.where(F.col("extract_uid").isNotNull() & F.col("dataset_uid").isNotNull()
                             & (F.size(F.coalesce("metrics", F.array())) > 0))
    periods = extract_periods("period_start", "period_end", F.coalesce("period_window", F.lit(3)),
                              F.col("period_frequency"), as_of)
    return (valid.select("extract_uid", "dataset_uid", F.explode("metrics").alias("metric"),
                         periods.alias("_periods"))
                 .select("extract_uid", "dataset_uid", "metric",
                         F.concat_ws(".", "dataset_uid", "metric").alias("rate_key"),
                         F.explode("_periods").alias("period")))


def rate_month_plan(rate_items: DataFrame, start, end) -> DataFrame:
    """B10, first generation: every rate item with a dataset and metrics x
    the months start..end (H1) x the periods its FREQUENCY covers in each
    month (H5; a yearly item asks for the year, not the month) x its metrics.
    The months come from an expression, so nothing is crossed."""
    valid = rate_items.where(F.col("dataset_uid").isNotNull() & (F.size(F.coalesce("metrics", F.array())) > 0))
    s = start if not isinstance(start, str) else F.lit(start)
    e = end if not isinstance(end, str) else F.lit(end)
    months = valid.select("dataset_uid", "metrics", F.lower(F.coalesce("period_frequency", F.lit("monthly")))
                          .alias("frequency"), F.explode(month_range(s, e)).alias("month"))
    units = months.select("dataset_uid", "metrics", "frequency", "month",
                          F.explode(periods_for_frequency(F.col("frequency"), F.col("month"))).alias("period"))
    return (units.select("dataset_uid", "frequency", "month", "period", F.explode("metrics").alias("metric"))
                 .withColumn("rate_key", F.concat_ws(".", "dataset_uid", "metric")))


def extraction_plan(items: DataFrame, months: DataFrame) -> DataFrame:
    """(item_pos, item_name, frequency, month, period) units. ``months``
    is (item_pos, month) — the months each item is asked for; each month
    expands to the periods its frequency covers (H5). Items without datasets
    are left out (see ``rejected_items``)."""
    named = item_names(items.where(F.size(F.coalesce("data_sets", F.array())) > 0))
    j = named.select("item_pos", "item_name", F.lower("frequency").alias("frequency")).join(months, "item_pos")
    return j.withColumn("period", F.explode(periods_for_frequency(F.col("frequency"), F.col("month"))))


def rejected_items(items: DataFrame) -> DataFrame:
    """Items the plan cannot use (no dataset)."""
    return items.where(F.size(F.coalesce("data_sets", F.array())) == 0).select(
        "item_pos", F.lit("no DATA_SETS").alias("reason"))


def skip_existing(plan: DataFrame, existing: DataFrame, overwrite: bool = False) -> DataFrame:
    """Drop units already extracted (unless ``overwrite``) and keep each
    yearly unit once per run. An extract belongs to an item and a month (a year
    for yearly items) and holds all periods of that month: ``existing`` is
    (item_name, file_period) with file_period the month or the year, so a week
    that two months share is extracted for both."""
    file_period = F.when(F.col("frequency") == "yearly", F.substring("month", 1, 4)).otherwise(F.col("month"))
    todo = plan if overwrite else plan.withColumn("file_period", file_period).join(
        existing.select("item_name", "file_period").distinct(), ["item_name", "file_period"],
        "left_anti").drop("file_period")
    yearly = todo.where(F.col("frequency") == "yearly")
    w = Window.partitionBy("item_name", "period").orderBy("month")
    once = yearly.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_n")
    return todo.where(F.col("frequency") != "yearly").unionByName(once)


def skip_existing_rates(plan: DataFrame, existing: DataFrame, download_new: bool = True,
                        return_existing: bool = False) -> tuple[DataFrame, DataFrame]:
    """C10, second generation: (units to extract, existing extracts handed back).
    An extract belongs to (extract_uid, period); with ``download_new`` existing
    ones are skipped, and handed back when ``return_existing`` (to be pushed
    again); without it all are extracted anew."""
    have = existing.select("extract_uid", "period").distinct()
    if not download_new:
        return plan, have.limit(0)
    back = have.join(plan.select("extract_uid", "period").distinct(), ["extract_uid", "period"], "left_semi")
    return plan.join(have, ["extract_uid", "period"], "left_anti"), back if return_existing else have.limit(0)


def require_known_combos(unknown: DataFrame, allow_unfiltered: bool = False) -> None:
    """A5 / B4 guard: an item whose category combo does not exist would end up
    with an empty option-combo list, i.e. no filter at all (the reference
    lets that through silently). Refuse unless ``allow_unfiltered``.
    ``unknown`` is configuration-sized."""
    if allow_unfiltered:
        return
    names = sorted(r[0] for r in unknown.select("cat_combo").distinct().collect())
    if names:
        raise ValueError(f"unknown category combos (would disable the option combo filter): {names}")


def expand_category_combos(items: DataFrame, combo_bridge: DataFrame, allow_unfiltered: bool = False) -> DataFrame:
    """C14: (item_pos, coc) — the listed option combos plus every option combo
    of the item's category combos (A5 bridge), distinct. A category combo that
    the bridge lacks is refused, unless ``allow_unfiltered``."""
    asked = items.select(F.explode("cat_combos").alias("cat_combo")).distinct()
    require_known_combos(asked.join(combo_bridge, "cat_combo", "left_anti"), allow_unfiltered)
    listed = items.select("item_pos", F.explode("cat_option_combos").alias("coc"))
    via = (items.select("item_pos", F.explode("cat_combos").alias("cat_combo"))
                .join(combo_bridge, "cat_combo").select("item_pos", "coc"))
    return listed.unionByName(via).distinct()
