"""Aligning one org unit pyramid with another.

Org units are flat rows: id, name, shortName, openingDate, closedDate,
parent_id, level, path, geometry (GeoJSON text). ``flatten_org_units`` turns
the API shape (``parent`` struct) into that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aggrex.functions.geometry import (canonical_geometry, geometry_struct, missing_org_unit_fields,
                                       org_unit_is_valid)
from aggrex.operators.push import global_positions

# The fields whose difference makes an update, in report order.
COMPARED_FIELDS = ["name", "shortName", "openingDate", "closedDate", "parent_id", "geometry"]
# Status texts counted as success (second generation).
SUCCESS_STATUSES = ["SUCCESS", "OK"]
NOT_VALID = "NOTVALID"


def flatten_org_units(df: DataFrame) -> DataFrame:
    """``parent`` struct -> ``parent_id`` (no-op when already flat)."""
    if "parent" in df.columns and "parent_id" not in df.columns:
        return df.withColumn("parent_id", F.col("parent.id")).drop("parent")
    return df


def latest_per_id(df: DataFrame, order_col: str | None) -> DataFrame:
    """One row per id; with duplicates the row with the highest ``order_col``
    wins (the reference's dict build keeps the last one). ``row_order``
    (``scan_pyramid``) is the input order of files, and is used when it is there;
    without it the rows count in the order in which Spark reads them, which for
    files depends on how they are packed into partitions. A partial aggregation, so a heavily duplicated id does not gather in
    one task."""
    cols = df.columns
    if order_col is None and "row_order" in cols:
        order_col = "row_order"
    order = F.col(order_col) if order_col else F.monotonically_increasing_id()
    return (df.withColumn("_order", order).groupBy("id")
              .agg(F.max_by(F.struct(*cols), F.col("_order")).alias("_r")).select("_r.*"))


def org_units_to_create(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source units whose id the target lacks (duplicates stay)."""
    return source.join(target.select("id"), "id", "left_anti")


def org_units_matching(source: DataFrame, target: DataFrame, order_col: str | None = None,
                       keep_geometry: bool = True) -> DataFrame:
    """Units present on both sides, one pair per id: ``id``, ``src_*`` and
    ``tgt_*`` for every compared field, geometry canonicalised (H11)."""
    def side(df: DataFrame, p: str) -> DataFrame:
        d = latest_per_id(df, order_col)
        cols = [F.col("id")] + [F.col(c).alias(p + c) for c in COMPARED_FIELDS if c != "geometry"]
        cols += [canonical_geometry("geometry", keep_geometry).alias(p + "geometry_canon"),
                 F.col("geometry").alias(p + "geometry")]
        if p == "src_":
            cols += [F.col("level"), F.col("path")]
        return d.select(*cols)
    return side(source, "src_").join(side(target, "tgt_"), "id", "inner")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def changed_fields() -> Column:
    """C4: names of the compared fields that differ (null-safe)."""
    items = []
    for c in COMPARED_FIELDS:
        a, b = (("src_geometry_canon", "tgt_geometry_canon") if c == "geometry" else ("src_" + c, "tgt_" + c))
        items.append(F.when(~_same(F.col(a), F.col(b)), F.lit(c)))
    return F.array_compact(F.array(*items))


def org_units_to_update(source: DataFrame, target: DataFrame, order_col: str | None = None,
                        keep_geometry: bool = True) -> DataFrame:
    """Matching pairs that differ in any compared field, with ``changed``."""
    m = org_units_matching(source, target, order_col, keep_geometry)
    return m.withColumn("changed", changed_fields()).where(F.size("changed") > 0)


def org_unit_changes(updates: DataFrame) -> DataFrame:
    """C4 long form: (id, field, old_value, new_value) per changed field."""
    pairs = F.map_from_arrays(
        F.array(*[F.lit(c) for c in COMPARED_FIELDS]),
        F.array(*[F.struct(F.col("tgt_" + c).alias("old_value"), F.col("src_" + c).alias("new_value"))
                  for c in COMPARED_FIELDS]))
    return (updates.select("id", F.explode("changed").alias("field"), pairs.alias("_p"))
                   .select("id", "field", F.col("_p")[F.col("field")]["old_value"].alias("old_value"),
                           F.col("_p")[F.col("field")]["new_value"].alias("new_value")))


def _unit_struct(prefix: str = "", keep_geometry: bool = True) -> Column:
    c = (lambda n: F.col(prefix + n))
    geometry = geometry_struct(c("geometry")) if keep_geometry else F.lit(None)
    return F.struct(F.col("id").alias("id"), c("name").alias("name"), c("shortName").alias("shortName"),
                    c("openingDate").alias("openingDate"), c("closedDate").alias("closedDate"),
                    F.when(c("parent_id").isNotNull(), F.struct(c("parent_id").alias("id"))).alias("parent"),
                    geometry.alias("geometry"))


def create_payloads(creates: DataFrame, keep_geometry: bool = True) -> DataFrame:
    """J3 + H12 for creates: valid units get their JSON object (NULL fields
    dropped, parent as {id}, geometry as {type, coordinates}); invalid ones
    get ``missing`` instead. ``level`` is kept so a sink can send parents first."""
    return creates.select(
        F.lit("CREATE").alias("action"), "id", "level",
        org_unit_is_valid().alias("valid"),
        F.array_join(missing_org_unit_fields(), ",").alias("missing"),
        F.when(org_unit_is_valid(), F.to_json(_unit_struct("", keep_geometry))).alias("payload"))


def update_payloads(updates: DataFrame, keep_geometry: bool = True) -> DataFrame:
    """J3 for updates: the source version wrapped in ``{"organisationUnits":[..]}``."""
    body = F.to_json(F.struct(F.array(_unit_struct("src_", keep_geometry)).alias("organisationUnits")))
    return updates.select(F.lit("UPDATE").alias("action"), "id", F.col("level"), body.alias("payload"))


def ordered_for_sending(payloads: DataFrame) -> DataFrame:
    """J3 send order: creates before updates, and parents before children
    (ascending level), id as the tie-break — a global range-partitioned sort,
    so a sink writing the result sequentially never sends a child first."""
    action_rank = F.when(F.col("action") == "CREATE", F.lit(0)).otherwise(F.lit(1))
    return payloads.orderBy(action_rank, F.col("level").asc_nulls_first(), F.col("id"))


def numbered_for_sending(payloads: DataFrame) -> DataFrame:
    """J3 send order as a column: ``seq`` from 0, in the order of
    ``ordered_for_sending``, so that a stored table keeps it."""
    rank = F.when(F.col("action") == "CREATE", F.lit(0)).otherwise(F.lit(1))
    return (global_positions(payloads.withColumn("_rank", rank), ["_rank", "level", "id"])
            .drop("_rank").withColumnRenamed("_pos", "seq"))


def import_status(responses: DataFrame) -> DataFrame:
    """Per org unit request (action, id, body): the response status and
    whether it counts as success — second generation SUCCESS / OK only, first
    generation anything but ERROR. Rows without a body (not sent, invalid)
    get status NOTVALID. ``response`` is the response's content as JSON text;
    ``status_code`` (HTTP code) and ``payload`` (what was sent) are carried
    along, so every unit counted in D3 can be looked up here."""
    status = F.get_json_object("body", "$.status")
    st = F.when(F.col("body").isNull(), F.lit(NOT_VALID)).otherwise(status)
    # HTTP code and the body that was sent, when recorded: the details behind the counts of D3.
    extra = [c for c in ("status_code", "payload") if c in responses.columns]
    return responses.select(
        "action", "id", *extra, st.alias("status"), F.get_json_object("body", "$.response").alias("response"),
        F.coalesce(st.isin(*SUCCESS_STATUSES), F.lit(False)).alias("success"),
        (~st.eqNullSafe(F.lit("ERROR")) & ~st.eqNullSafe(F.lit(NOT_VALID))).alias("success_gen1"))


def alignment_summary(statuses: DataFrame) -> DataFrame:
    """D3: count of created / updated / invalid / failed units per action."""
    outcome = (F.when(F.col("status") == NOT_VALID, F.lit("invalid"))
                .when(F.col("success"), F.lit("ok")).otherwise(F.lit("error")))
    return statuses.groupBy("action", outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
