"""Hierarchy operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_level(units: DataFrame, level: int) -> DataFrame:
    """Ids of the org units at ``level``."""
    return units.where(F.col("level") == F.lit(level)).select("id")


def leaf_org_unit_count(units: DataFrame, levels: DataFrame | None = None) -> DataFrame:
    """Number of distinct ids at the deepest level. The depth comes from the
    level table (default: the distinct levels of the units), not the units."""
    lv = levels if levels is not None else units.select("level").distinct()
    deepest = F.broadcast(lv.agg(F.max("level").alias("level")))  # one row
    return (units.join(deepest, "level", "inner")
                 .groupBy("level").agg(F.count_distinct("id").alias("n_org_units")))


def descendants_by_path(units: DataFrame, roots: list[str]) -> DataFrame:
    """C11 fast path: units whose ``path`` passes through a root (roots
    included). One scan, no iteration."""
    return units.where(F.arrays_overlap(F.split(F.col("path"), "/"), F.array(*[F.lit(r) for r in roots])))


def select_descendants(units: DataFrame, roots: DataFrame | list[str]) -> DataFrame:
    """C11: the given ids and all their descendants, any depth, cycle-safe.

    Pointer doubling over (id, parent_id): after round k every undecided unit
    points 2^k levels up and knows whether one of those levels is a root, so
    the rounds grow with the logarithm of the depth. Units that point nowhere
    any more, and found ones, drop out of the state. A cycle without a root
    never ends its pointers; after log2(number of units) rounds every unit has
    seen all it can reach. Each round's state is checkpointed to the shared
    folder, which cuts lineage and survives executor loss.
    """
    spark = units.sparkSession
    if isinstance(roots, list):
        roots = spark.createDataFrame([(r,) for r in roots], "id string")
    marked = roots.select("id").distinct().withColumn("hit", F.lit(True))
    edges = units.select("id", "parent_id").where(F.col("id").isNotNull()).distinct()
    state = (edges.join(marked, "id", "left").select("id", F.col("parent_id").alias("up"), "hit")
             .unionByName(marked.select("id", F.lit(None).cast("string").alias("up"), "hit")))
    state = state.select("id", F.when(F.col("hit").isNull(), F.col("up")).alias("up"),
                         F.coalesce("hit", F.lit(False)).alias("hit")).distinct().checkpoint(eager=True)
    rounds = max(1, state.count()).bit_length() + 1
    for _ in range(rounds):
        open_units = state.where(~F.col("hit") & F.col("up").isNotNull())
        if open_units.isEmpty():
            break
        above = state.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("hit").alias("_hit"))
        moved = open_units.select("id", "up").join(above, "up", "left").select(
            "id", F.col("_up").alias("up"), F.coalesce("_hit", F.lit(False)).alias("hit"))
        state = state.where(F.col("hit")).unionByName(moved).unionByName(
            state.where(~F.col("hit") & F.col("up").isNull())).distinct().checkpoint(eager=True)
    return units.join(state.where("hit").select("id").distinct(), "id", "left_semi")
