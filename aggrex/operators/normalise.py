"""Normalisation of raw extracts to the 9-column data point table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aggrex.operators.dims import settled_broadcast, sized_broadcast
from aggrex.schemas import (AGGREGATED, DATA_ELEMENT, DATA_POINT_COLUMNS, DATA_TYPE_ALIASES,
                            INDICATOR, PUSH_COLUMNS, REPORTING_RATE)

# Months of a year that one set, a 64-bit number, holds; of more there are several sets.
MONTHS_OF_SET = 60


def _null() -> Column:
    return F.lit(None).cast("string")


def _layout(data_type: str, domain_type: str, dx: Column, coc: Column, aoc: Column,
            rate_type: Column, period="period", org_unit="orgUnit", value="value") -> list[Column]:
    return [
        F.lit(data_type).alias("data_type"), dx.alias("dx_uid"),
        F.col(period).alias("period"), F.col(org_unit).alias("org_unit"),
        coc.alias("category_option_combo"), aoc.alias("attribute_option_combo"),
        rate_type.alias("rate_type"), F.lit(domain_type).alias("domain_type"),
        F.col(value).cast("string").alias("value"),
    ]


def normalise_data_values(df: DataFrame, domain_type: str = AGGREGATED,
                          carry: list[str] = ()) -> DataFrame:
    """B1: raw data values -> data point layout (DATA_ELEMENT rows)."""
    cols = _layout(DATA_ELEMENT, domain_type, F.col("dataElement"),
                   F.col("categoryOptionCombo"), F.col("attributeOptionCombo"), _null())
    return df.select(*cols, *carry)


def normalise_rates(df: DataFrame, domain_type: str = AGGREGATED, strict: bool = True,
                    carry: list[str] = ()) -> DataFrame:
    """B2: analytics rate cells ``dataset.metric`` -> (dx_uid, rate_type).

    No dot gives a NULL rate type. More than two parts is an error (strict,
    as in the reference) or, with ``strict=False``, a NULL dx_uid so the row is
    classified invalid downstream.
    """
    parts = F.split(F.col("dx"), r"\.")
    too_many = F.size(parts) > 2
    dx = F.get(parts, 0)
    if strict:
        dx = F.when(too_many, F.raise_error(F.concat(F.lit("rate id has more than two parts: "),
                                                      F.col("dx")))).otherwise(dx)
    else:
        dx = F.when(~too_many, dx)
    cols = _layout(REPORTING_RATE, domain_type, dx, _null(), _null(), F.get(parts, 1))
    return df.select(*cols, *carry)


def normalise_indicators(df: DataFrame, domain_type: str = AGGREGATED, map_cocs: bool = False,
                         carry: list[str] = ()) -> DataFrame:
    """Analytics indicator cells -> data point layout."""
    coc = F.col("categoryOptionCombo") if map_cocs else _null()
    cols = _layout(INDICATOR, domain_type, F.col("dx"), coc, _null(), _null())
    return df.select(*cols, *carry)


def canonical_data_type(df: DataFrame) -> DataFrame:
    """Accept first-generation type names (DATAELEMENT / DATASET)."""
    expr = F.col("data_type")
    for old, new in DATA_TYPE_ALIASES.items():
        expr = F.when(F.col("data_type") == old, F.lit(new)).otherwise(expr)
    return df.withColumn("data_type", expr)


def filter_category_option_combos(df: DataFrame, combos: DataFrame, item_col: str = "item_id") -> DataFrame:
    """Keep rows whose combo is listed for their item; an item with an empty
    list keeps everything.

    ``combos`` is (item_id, coc) — a configuration-sized dimension, broadcast.
    """
    listed = sized_broadcast(combos.select(item_col).distinct().withColumn("_listed", F.lit(True)))
    pairs = sized_broadcast(combos.select(item_col, F.col("coc").alias("category_option_combo")).distinct()
                            .withColumn("_kept", F.lit(True)))
    # One pass over the data: two broadcast lookups, then keep unlisted items
    # and listed (item, combo) pairs.
    return (df.join(listed, item_col, "left").join(pairs, [item_col, "category_option_combo"], "left")
              .where(F.col("_listed").isNull() | F.col("_kept").isNotNull()).drop("_listed", "_kept"))


def select_push_columns(df: DataFrame, carry: list[str] = ()) -> DataFrame:
    """The six mandatory columns (a missing one is an analysis error)."""
    return df.select(*PUSH_COLUMNS, *carry)


def union_checked(frames: list[DataFrame | None]) -> DataFrame | None:
    """G1: concatenate frames by name; the column *sets* must match."""
    frames = [f for f in frames if f is not None]
    if not frames:
        return None
    first = set(frames[0].columns)
    for f in frames[1:]:
        if set(f.columns) != first:
            raise ValueError(f"column sets differ: {sorted(first)} vs {sorted(f.columns)}")
    return reduce(lambda a, b: a.unionByName(b), frames)


def merge_extracts(extracts: DataFrame, months: DataFrame) -> DataFrame:
    """For every month, the month's extracts plus the extracts of its year,
    whole-row distinct.

    ``extracts`` carries the 9 data point columns and ``extract_period``
    (``yyyyMM`` or ``yyyy``, the partition column). ``months`` is (month).
    The months of a year are numbered, so an extract period stands for a set of
    them: a month for itself, a year for all of its months. A row is shuffled once
    per extract it stands in, not once per month: equal rows of a year are one
    group of a hash aggregate with map-side combine, whose sets are united, and
    only then is a row repeated for every month of its set. Both period-sized
    tables are computed once and broadcast.
    """
    year = Window.partitionBy("_year").orderBy("merge_month")
    numbered = (months.select(F.col("month").alias("merge_month")).where("merge_month is not null").distinct()
                .withColumn("_year", F.substring("merge_month", 1, 4))
                .withColumn("_n", F.row_number().over(year) - 1)
                .select("merge_month", "_year", F.floor(F.col("_n") / MONTHS_OF_SET).alias("_part"),
                        F.expr(f"shiftleft(1L, _n % {MONTHS_OF_SET})").alias("_bit"))
                .checkpoint(eager=True))
    sets = settled_broadcast(
        numbered.select(F.explode(F.array("merge_month", "_year")).alias("_key"), "_year", "_part", "_bit")
        .groupBy("_key", "_year", "_part").agg(F.bit_or("_bit").alias("_set")))
    members = settled_broadcast(numbered.groupBy("_year", "_part").agg(
        F.collect_list(F.struct("_bit", "merge_month")).alias("_months")))
    rows = (extracts.join(sets, F.col("extract_period") == F.col("_key"))
            .groupBy(*DATA_POINT_COLUMNS, "_year", "_part").agg(F.bit_or("_set").alias("_set")))
    every = rows.join(members, ["_year", "_part"]).withColumn("_m", F.explode("_months"))
    return (every.where(F.col("_set").bitwiseAND(F.col("_m._bit")) != 0)
            .select(F.col("_m.merge_month").alias("merge_month"), *DATA_POINT_COLUMNS))
