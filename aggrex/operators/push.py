"""Classification, ordering and payload batching of data points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aggrex.operators.dims import sized_broadcast
from aggrex.schemas import INVALID, PUSH_COLUMNS, TO_DELETE, VALID

# Payload key for each data point attribute, in payload order.
PAYLOAD_KEYS = [
    ("dx_uid", "dataElement"),
    ("period", "period"),
    ("org_unit", "orgUnit"),
    ("category_option_combo", "categoryOptionCombo"),
    ("attribute_option_combo", "attributeOptionCombo"),
    ("value", "value"),
]
# Fixed value: comment sent with a deletion.
DELETE_COMMENT = "deleted value"

KEY_COLUMNS = PUSH_COLUMNS[:-1]

# Position of each class in the send sequence: second generation sends valid
# values first, the first generation sends deletions first.
PHASE_ORDER = {"gen2": {VALID: 0, TO_DELETE: 1}, "gen1": {TO_DELETE: 0, VALID: 1}}

_LOCAL_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def missing_fields(require_numeric: bool = False) -> Column:
    """Names of the absent attributes (and ``value_not_numeric``)."""
    items = [F.when(F.col(c).isNull(), F.lit(c)) for c in PUSH_COLUMNS]
    if require_numeric:
        items.append(F.when(F.col("value").isNotNull() & F.col("value_num").isNull(),
                            F.lit("value_not_numeric")))
    return F.array_compact(F.array(*items))


def classify_data_points(df: DataFrame, require_numeric: bool = False) -> DataFrame:
    """``class`` = valid (all six present), to_delete (five keys present,
    value missing) or invalid; ``missing`` lists what is absent.

    With ``require_numeric`` (rate pipeline, needs ``value_num``), a value that
    is present but not a number is invalid — never valid, never a deletion.
    """
    keys_ok = F.lit(True)
    for c in KEY_COLUMNS:
        keys_ok = keys_ok & F.col(c).isNotNull()
    value_ok = F.col("value").isNotNull()
    if require_numeric:
        value_ok = value_ok & F.col("value_num").isNotNull() & ~F.isnan("value_num")
    cls = (F.when(keys_ok & value_ok, F.lit(VALID))
            .when(keys_ok & F.col("value").isNull(), F.lit(TO_DELETE))
            .otherwise(F.lit(INVALID)))
    return df.withColumn("class", cls).withColumn("missing", missing_fields(require_numeric))


def class_counts(classified: DataFrame, by: list[str] = ()) -> DataFrame:
    """Number of valid / to_delete / invalid rows."""
    return classified.groupBy(*by, "class").agg(F.count(F.lit(1)).alias("n"))


def quarantine_report(classified: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Invalid and to-delete rows with a running number per class and the
    list of missing attributes as text."""
    order = order or ["org_unit", "dx_uid", "period", "category_option_combo",
                      "attribute_option_combo", "value"]
    rows = classified.where(F.col("class").isin(INVALID, TO_DELETE))
    pos = global_positions(rows, ["class", *order], group_cols=["class"])
    return pos.select(*[c for c in rows.columns if c != "missing"],
                      F.array_join("missing", ",").alias("missing"),
                      (F.col("_pos") + 1).alias("line_no"))


def data_point_json(classified: DataFrame, value_as_number: bool = False) -> DataFrame:
    """``payload`` = the API object of a valid row, or the deletion object
    (value "" and a comment) of a to_delete row; NULL for invalid rows.
    With ``value_as_number`` (rate pipeline, needs ``value_num``) the value is
    written as a JSON number, as the coerced rates of the reference are."""
    value = F.col("value_num") if value_as_number else F.col("value")
    valid = F.to_json(F.struct(*[F.col(c).alias(k) for c, k in PAYLOAD_KEYS[:-1]], value.alias("value")))
    delete = F.to_json(F.struct(*[F.col(c).alias(k) for c, k in PAYLOAD_KEYS[:-1]],
                                F.lit("").alias("value"), F.lit(DELETE_COMMENT).alias("comment")))
    return classified.withColumn(
        "payload", F.when(F.col("class") == VALID, valid).when(F.col("class") == TO_DELETE, delete))


def _order(cols: list) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_first() for c in cols]


def global_positions(df: DataFrame, order: list, group_cols: list[str] = (),
                     checkpoint: bool = True) -> DataFrame:
    """Dense 0-based position ``_pos`` of every row in ``order``, restarting at 0
    for each ``group_cols`` value (the group columns must lead ``order``).

    Distributed, no single-partition window: a range-partitioned sort, then
    ``monotonically_increasing_id`` gives each row its partition index and its
    index within the sorted partition; per-partition counts (one row per
    partition) turn those into global positions. Ties in ``order`` must only
    occur between rows whose relative order does not matter (identical
    payloads); a row ordinal breaks them so that even a third of the rows
    being one key spreads over many partitions. The numbered data is checkpointed so that the
    counts and the rows come from the same materialisation (a recomputed sort
    could be coalesced differently by AQE) and lineage is cut.
    """
    # A row ordinal closes the order: range partitioning cannot split equal
    # keys, so without it a group of identical copies would land in one task.
    df = df.withColumn("_tie", F.monotonically_increasing_id())
    numbered = (df.orderBy(*_order([*order, "_tie"]))
                  .withColumn("_mid", F.monotonically_increasing_id())
                  .withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
                  .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
                  .drop("_mid", "_tie"))
    if checkpoint:
        numbered = numbered.checkpoint(eager=True)
    # One count per partition (bounded by the partition count, not the data),
    # gathered like zipWithIndex does and turned into running offsets.
    counts = sorted((r["_pid"], r["_n"]) for r in
                    numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect())
    offsets, acc = [], 0
    for pid, n in counts:
        offsets.append((pid, acc))
        acc += n
    spark = df.sparkSession
    off = spark.createDataFrame(offsets or [(0, 0)], "_pid long, _off long")
    out = numbered.join(F.broadcast(off), "_pid").withColumn("_gpos", F.col("_off") + F.col("_loc"))
    out = out.drop("_pid", "_loc", "_off")
    if group_cols:
        # First position of every group; joined null-safely so that a group
        # whose key is NULL keeps its rows.
        firsts = sized_broadcast(out.groupBy(*group_cols).agg(F.min("_gpos").alias("_first"))
                                 .select(*[F.col(c).alias(f"_g_{c}") for c in group_cols], "_first"))
        cond = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group_cols]
        out = (out.join(firsts, cond, "inner")
                  .withColumn("_pos", F.col("_gpos") - F.col("_first"))
                  .drop("_first", *[f"_g_{c}" for c in group_cols]))
        return out.drop("_gpos")
    return out.withColumnRenamed("_gpos", "_pos")


def sort_by_org_unit(df: DataFrame, tie_break: str | None = None) -> DataFrame:
    """rows in ascending org unit order, with a total tie-break (the
    reference's sort is unstable). Adds ``seq`` — the 0-based position."""
    order = ["org_unit", "dx_uid", "period", "category_option_combo", "attribute_option_combo", "value"]
    if tie_break:
        order.append(tie_break)
    return global_positions(df, order).withColumnRenamed("_pos", "seq")


def payload_batches(classified: DataFrame, max_post: int = 500, generation: str = "gen2",
                    group_cols: list[str] = ("period",), tie_break: str | None = None,
                    value_as_number: bool = False) -> DataFrame:
    """Cut the valid and to_delete rows into consecutive batches of at most
    ``max_post`` data points, per (phase, *group_cols), in org unit order.

    Output: one row per batch — phase, phase_order, group columns, batch_no,
    n_points, first/last org unit and the request body
    ``{"dataValues":[...]}``. Each batch is one bounded group (<= max_post
    rows), so no task ever holds more than a batch plus its sort run.
    """
    if max_post < 1:
        raise ValueError("max_post must be >= 1")
    order_of = PHASE_ORDER[generation]
    phase_order = F.when(F.col("class") == VALID, F.lit(order_of[VALID])).otherwise(F.lit(order_of[TO_DELETE]))
    # Only what the order and the payload need goes through the sort; the payload text is made after it.
    need = [*PUSH_COLUMNS, "class", *group_cols, *(["value_num"] if value_as_number else []),
            *([tie_break] if tie_break else [])]
    rows = (classified.where(F.col("class").isin(VALID, TO_DELETE)).select(*dict.fromkeys(need))
            .withColumn("phase_order", phase_order))
    order = ["phase_order", *group_cols, "org_unit", "dx_uid", "period", "category_option_combo",
             "attribute_option_combo", "value"]
    if tie_break:
        order.append(tie_break)
    pos = global_positions(rows, order, group_cols=["phase_order", *group_cols])
    batched = data_point_json(pos, value_as_number).withColumn("phase", F.col("class")).withColumn("batch_no", (F.col("_pos") / F.lit(max_post)).cast("bigint"))
    agg = batched.groupBy("phase", "phase_order", *group_cols, "batch_no").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.min_by("org_unit", "_pos").alias("first_org_unit"),
        F.max_by("org_unit", "_pos").alias("last_org_unit"),
        F.sort_array(F.collect_list(F.struct("_pos", "payload"))).alias("_items"))
    body = F.concat(F.lit('{"dataValues":['),
                    F.array_join(F.transform("_items", lambda x: x["payload"]), ","), F.lit("]}"))
    return agg.withColumn("body", body).drop("_items")
