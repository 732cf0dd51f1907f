"""Identifier remapping through broadcast dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aggrex.functions.values import rate_100_to_1, to_number_or_null
from aggrex.operators.dims import sized_broadcast
from aggrex.schemas import DATA_ELEMENT, REPORTING_RATE

UID_FIELDS = ["dx_uid", "category_option_combo", "attribute_option_combo"]


def uid_mapper(mapping: DataFrame, defaults: dict[str, str] | None = None,
               data_type: str = DATA_ELEMENT) -> Callable[[DataFrame], DataFrame]:
    """C5 + C6 as a reusable transform: the per-field dimensions are split and
    size-checked once (e.g. once per stream, not once per micro-batch)."""
    defaults = defaults or {}
    dims = {}
    for field in UID_FIELDS:
        old, new = f"_old_{field}", f"_new_{field}"
        d = mapping.where(F.col("field") == field).select(F.col("old_uid").alias(old), F.col("new_uid").alias(new))
        dims[field] = sized_broadcast(d)

    def apply(df: DataFrame) -> DataFrame:
        is_type = F.col("data_type") == F.lit(data_type)
        out = df
        for field in UID_FIELDS:
            if defaults.get(field):
                out = out.withColumn(field, F.when(is_type, F.coalesce(F.col(field), F.lit(defaults[field])))
                                     .otherwise(F.col(field)))
            old, new = f"_old_{field}", f"_new_{field}"
            out = (out.join(dims[field], (F.col(field) == F.col(old)) & is_type, "left")
                   .withColumn(field, F.coalesce(F.col(new), F.col(field))).drop(old, new))
        return out
    return apply


def map_uids(df: DataFrame, mapping: DataFrame, defaults: dict[str, str] | None = None,
             data_type: str = DATA_ELEMENT) -> DataFrame:
    """C5 + C6: on rows of ``data_type``, fill NULL option combos with the
    configured defaults, then replace identifiers through ``mapping``
    (field, old_uid, new_uid). Replacement is simultaneous per field — a
    mapped value is never mapped again — and a default can itself be mapped.

    Each field is one broadcast hash join (no shuffle of the data).
    """
    return uid_mapper(mapping, defaults, data_type)(df)


def _rate_dim(rate_mapping: DataFrame) -> DataFrame:
    return rate_mapping.select(
        F.col("dx_uid").alias("_m_dx"), F.col("rate_type").alias("_m_rt"),
        F.trim("uid").alias("_m_uid"), F.trim("cat_option_combo").alias("_m_coc"),
        F.trim("attr_option_combo").alias("_m_aoc"),
        *([F.col("extract_id").alias("_m_ex")] if "extract_id" in rate_mapping.columns else []))


def overlapping_rate_keys(rate_mapping: DataFrame) -> DataFrame:
    """Mappings whose output (uid, rate_type) is the key of another mapping: the
    reference applies them one after the other, so the result would depend on
    order. A mapping onto its own key (which may add option combos) is harmless."""
    keys = rate_mapping.select(F.col("dx_uid").alias("k_dx"), F.col("rate_type").alias("k_rt"))
    return rate_mapping.join(keys, (F.trim("uid") == F.col("k_dx")) & (F.col("rate_type") == F.col("k_rt"))
                             & (F.col("k_dx") != F.col("dx_uid")), "left_semi")


def map_rates_in_place(df: DataFrame, rate_mapping: DataFrame, check: bool = True) -> DataFrame:
    """C7 (first generation): REPORTING_RATE rows matching (dx_uid, rate_type)
    take the mapped uid / coc / aoc; unmatched rows stay as they are."""
    if check and not overlapping_rate_keys(rate_mapping).isEmpty():
        raise ValueError("rate mappings overlap: an output uid is also a mapped key")
    dim = sized_broadcast(_rate_dim(rate_mapping).drop("_m_ex"))
    hit = (F.col("data_type") == F.lit(REPORTING_RATE))
    j = df.join(dim, (F.col("dx_uid") == F.col("_m_dx")) & (F.col("rate_type") == F.col("_m_rt")) & hit, "left")
    matched = F.col("_m_dx").isNotNull()
    return (j.withColumn("dx_uid", F.when(matched, F.col("_m_uid")).otherwise(F.col("dx_uid")))
             .withColumn("category_option_combo",
                         F.when(matched, F.col("_m_coc")).otherwise(F.col("category_option_combo")))
             .withColumn("attribute_option_combo",
                         F.when(matched, F.col("_m_aoc")).otherwise(F.col("attribute_option_combo")))
             .drop("_m_dx", "_m_rt", "_m_uid", "_m_coc", "_m_aoc"))


def invalid_rate_mappings(rate_mapping: DataFrame, data: DataFrame | None = None) -> DataFrame:
    """Metric mappings lacking uid, coc or aoc — only for the datasets of the
    same extract present in ``data`` when it is given. The configuration is
    looked through first; the data are read only if it has such a hole."""
    bad = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c.upper()))
                                    for c in ["uid", "cat_option_combo", "attr_option_combo"]]))
    m = rate_mapping.withColumn("missing", F.array_join(bad, ",")).where(F.size(bad) > 0)
    if data is None or m.isEmpty():
        return m
    keys = ["dx_uid"] + (["extract_id"] if "extract_id" in m.columns and "extract_id" in data.columns else [])
    # Only the holes' own keys are looked for, so the data need no distinct.
    holes = sized_broadcast(m.select(*keys).distinct())
    present = data.select(*keys).join(holes, keys, "left_semi").distinct()
    return m.join(present, keys, "left_semi")


def map_rates_per_extract(df: DataFrame, rate_mapping: DataFrame, validate: bool = True) -> DataFrame:
    """C8 (second generation): rows matching (extract_id, dx_uid, rate_type) are
    mapped, unmatched rows are dropped; then H9 / H10 on the value.

    Adds ``value_num`` (DOUBLE, NULL when not a number) and rewrites ``value``
    to '1' where a REPORTING_RATE of 100 became 1. An extract without any
    mapping passes through unchanged.
    """
    if validate and not invalid_rate_mappings(rate_mapping, df).isEmpty():
        raise ValueError("rate mappings lack UID / CAT_OPTION_COMBO / ATTR_OPTION_COMBO")
    dim = sized_broadcast(_rate_dim(rate_mapping))
    mapped_extracts = sized_broadcast(rate_mapping.select("extract_id").distinct()
                                      .withColumn("_has_map", F.lit(True)))
    # One pass: both dimensions are broadcast; a row is kept when it matched a
    # mapping or when its extract has no mapping at all.
    j = (df.join(mapped_extracts, "extract_id", "left")
           .join(dim, (F.col("extract_id") == F.col("_m_ex")) & (F.col("dx_uid") == F.col("_m_dx"))
                 & (F.col("rate_type") == F.col("_m_rt")), "left")
           .where(F.col("_m_dx").isNotNull() | F.col("_has_map").isNull()))
    hit = F.col("_m_dx").isNotNull()
    num = to_number_or_null("value")
    hundred = hit & (F.col("rate_type") == F.lit(REPORTING_RATE)) & (num == F.lit(100.0))
    return (j.withColumn("dx_uid", F.when(hit, F.col("_m_uid")).otherwise(F.col("dx_uid")))
             .withColumn("category_option_combo",
                         F.when(hit, F.col("_m_coc")).otherwise(F.col("category_option_combo")))
             .withColumn("attribute_option_combo",
                         F.when(hit, F.col("_m_aoc")).otherwise(F.col("attribute_option_combo")))
             .withColumn("value_num", F.when(hit, rate_100_to_1(num, F.col("rate_type"))).otherwise(num))
             .withColumn("value", F.when(hundred, F.lit("1")).otherwise(F.col("value")))
             .drop("_has_map", "_m_ex", "_m_dx", "_m_rt", "_m_uid", "_m_coc", "_m_aoc"))


def dispatch_by_type(df: DataFrame, handlers: dict[str, Callable[[DataFrame], DataFrame]]
                     ) -> tuple[DataFrame | None, DataFrame]:
    """Route rows to the handler of their data type.

    Returns (union of handled rows, rows whose type has no handler). Handles
    mixed files row-wise rather than trusting the first row's type.
    """
    out = None
    for t, fn in handlers.items():
        part = fn(df.where(F.col("data_type") == F.lit(t)))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    handled = list(handlers)
    unknown = df.where(~F.col("data_type").isin(*handled) | F.col("data_type").isNull())
    return out, unknown

