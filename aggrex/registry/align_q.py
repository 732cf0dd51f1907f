"""Pyramid alignment and hierarchy over fx_pyramid_source / fx_pyramid_target
(A3, B8, C1-C4, C11, D3, D4, H11, H12, J3, J6)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from aggrex import fixtures
from aggrex.functions.geometry import canonical_geometry, missing_org_unit_fields, org_unit_is_valid
from aggrex.operators.align import (COMPARED_FIELDS, alignment_summary, create_payloads, flatten_org_units,
                                    import_status, numbered_for_sending, org_unit_changes, org_units_matching, org_units_to_create,
                                    org_units_to_update, update_payloads)
from aggrex.operators.hierarchy import descendants_by_path, filter_level, leaf_org_unit_count, select_descendants
from aggrex.registry import query
from aggrex.session import checkpoint_dir
from aggrex.sources import io

PYR = ["fx_pyramid_source", "fx_pyramid_target"]
UNIT_COLS = ["id", "name", "shortName", "openingDate", "closedDate", "parent_id", "level", "path", "geometry"]
ROOTS = ["R1", "N7"]


def _src(spark, sf_dir):
    fixtures.register(spark, sf_dir, PYR)
    return spark.table("fx_pyramid_source")


def _tgt(spark, sf_dir):
    fixtures.register(spark, sf_dir, PYR)
    return spark.table("fx_pyramid_target")


def _canon_sql(g: str) -> str:
    return (f"CASE WHEN {g} IS NOT NULL AND json_extract_string({g}, '$.type') IS NOT NULL "
            f"THEN json_extract_string({g}, '$.type') || '|' || replace(CAST(CAST(json_extract({g}, '$.coordinates') "
            f"AS DOUBLE[]) AS VARCHAR), ' ', '') END")


def _obj_sql(p: str) -> str:
    """JSON object of an org unit in SQL (NULL fields left out)."""
    def s(k, c):
        return f"CASE WHEN {p}{c} IS NOT NULL THEN '\"{k}\":\"' || {p}{c} || '\"' END"
    geo = (f"CASE WHEN json_extract_string({p}geometry, '$.type') IS NOT NULL THEN '\"geometry\":{{\"type\":\"' || "
           f"json_extract_string({p}geometry, '$.type') || '\",\"coordinates\":' || "
           f"CAST(json_extract({p}geometry, '$.coordinates') AS VARCHAR) || '}}' END")
    parts = [s("id", "id") if p == "" else "'\"id\":\"' || id || '\"'", s("name", "name"),
             s("shortName", "shortName"), s("openingDate", "openingDate"), s("closedDate", "closedDate"),
             f"CASE WHEN {p}parent_id IS NOT NULL THEN '\"parent\":{{\"id\":\"' || {p}parent_id || '\"}}' END", geo]
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


_MATCH_CTE = [("m", f"""
SELECT s.id, {', '.join(f's.{c} AS src_{c}' for c in COMPARED_FIELDS if c != 'geometry')},
       {_canon_sql('s.geometry')} AS src_geometry_canon, s.geometry AS src_geometry, s.level, s.path,
       {', '.join(f't.{c} AS tgt_{c}' for c in COMPARED_FIELDS if c != 'geometry')},
       {_canon_sql('t.geometry')} AS tgt_geometry_canon, t.geometry AS tgt_geometry
FROM fx_pyramid_source s JOIN fx_pyramid_target t ON s.id = t.id"""),
    ("u", """
SELECT *, concat_ws(',', """ + ", ".join(
        f"CASE WHEN {('src_geometry_canon' if c == 'geometry' else 'src_' + c)} IS DISTINCT FROM "
        f"{('tgt_geometry_canon' if c == 'geometry' else 'tgt_' + c)} THEN '{c}' END" for c in COMPARED_FIELDS)
     + """) AS changed FROM m""")]


@query("a3_scan_pyramid", fixtures.with_views(PYR, f"SELECT {', '.join(UNIT_COLS)} FROM fx_pyramid_source"))
def q_a3(spark, sf_dir):
    path = f"{checkpoint_dir(spark).rstrip('/')}/pyramid-{uuid.uuid4().hex}"
    api = _src(spark, sf_dir).select(
        "id", "name", "shortName", "openingDate", "closedDate",
        F.when(F.col("parent_id").isNotNull(), F.struct(F.col("parent_id").alias("id"))).alias("parent"),
        F.col("level").cast("int").alias("level"), "path", "geometry")
    api.write.json(path)
    return flatten_org_units(io.scan_pyramid(spark, path, fmt="json")).select(*UNIT_COLS)


@query("b8_filter_level", fixtures.with_views(PYR, "SELECT id FROM fx_pyramid_source WHERE level = 4"))
def q_b8(spark, sf_dir):
    return filter_level(_src(spark, sf_dir), 4)


@query("c1_org_units_to_create", fixtures.with_views(PYR, f"""
SELECT s.* FROM fx_pyramid_source s WHERE NOT EXISTS (SELECT 1 FROM fx_pyramid_target t WHERE t.id = s.id)"""))
def q_c1(spark, sf_dir):
    return org_units_to_create(_src(spark, sf_dir), _tgt(spark, sf_dir))


@query("c2_org_units_matching", fixtures.with_views(PYR, "SELECT * FROM m", _MATCH_CTE[:1]))
def q_c2(spark, sf_dir):
    return org_units_matching(_src(spark, sf_dir), _tgt(spark, sf_dir), order_col="k")


@query("c3_org_units_to_update", fixtures.with_views(
    PYR, "SELECT id, level, changed FROM u WHERE changed <> ''", _MATCH_CTE))
def q_c3(spark, sf_dir):
    u = org_units_to_update(_src(spark, sf_dir), _tgt(spark, sf_dir), order_col="k")
    return u.select("id", "level", F.array_join("changed", ",").alias("changed"))


@query("c4_org_unit_changes", fixtures.with_views(PYR, " UNION ALL ".join(
    f"SELECT id, '{c}' AS field, tgt_{c} AS old_value, src_{c} AS new_value FROM u "
    f"WHERE changed <> '' AND list_contains(string_split(changed, ','), '{c}')" for c in COMPARED_FIELDS),
    _MATCH_CTE))
def q_c4(spark, sf_dir):
    return org_unit_changes(org_units_to_update(_src(spark, sf_dir), _tgt(spark, sf_dir), order_col="k"))


@query("h11_canonical_geometry", fixtures.with_views(PYR, f"""
SELECT id, geometry, {_canon_sql('geometry')} AS canon, CAST(NULL AS VARCHAR) AS canon_no_geometry
FROM fx_pyramid_target"""))
def q_h11(spark, sf_dir):
    return _tgt(spark, sf_dir).select("id", "geometry", canonical_geometry("geometry").alias("canon"),
                                      canonical_geometry("geometry", keep=False).alias("canon_no_geometry"))


@query("h12_org_unit_is_valid", fixtures.with_views(PYR, """
SELECT id, id IS NOT NULL AND name IS NOT NULL AND shortName IS NOT NULL AND openingDate IS NOT NULL
       AND parent_id IS NOT NULL AS valid,
       concat_ws(',', CASE WHEN id IS NULL THEN 'id' END, CASE WHEN name IS NULL THEN 'name' END,
                 CASE WHEN shortName IS NULL THEN 'shortName' END, CASE WHEN openingDate IS NULL THEN 'openingDate' END,
                 CASE WHEN parent_id IS NULL THEN 'parent_id' END) AS missing
FROM fx_pyramid_source"""))
def q_h12(spark, sf_dir):
    return _src(spark, sf_dir).select("id", org_unit_is_valid().alias("valid"),
                                      F.array_join(missing_org_unit_fields(), ",").alias("missing"))


_VALID_SQL = ("id IS NOT NULL AND name IS NOT NULL AND shortName IS NOT NULL AND openingDate IS NOT NULL "
              "AND parent_id IS NOT NULL")
_PAYLOADS_SQL = f"""
SELECT 'CREATE' AS action, id, level, CASE WHEN {_VALID_SQL} THEN {_obj_sql('')} END AS payload
FROM fx_pyramid_source s WHERE NOT EXISTS (SELECT 1 FROM fx_pyramid_target t WHERE t.id = s.id)
UNION ALL
SELECT 'UPDATE', id, level, '{{"organisationUnits":[' || {_obj_sql('src_')} || ']}}' FROM u WHERE changed <> ''"""


@query("j3_org_unit_payload", fixtures.with_views(PYR, _PAYLOADS_SQL, _MATCH_CTE))
def q_j3(spark, sf_dir):
    src, tgt = _src(spark, sf_dir), _tgt(spark, sf_dir)
    creates = create_payloads(org_units_to_create(src, tgt)).select("action", "id", "level", "payload")
    updates = update_payloads(org_units_to_update(src, tgt, order_col="k"))
    return creates.unionByName(updates)


@query("j3_send_order", fixtures.with_views(PYR, f"""
SELECT action, id, row_number() OVER (ORDER BY action, level, id) - 1 AS seq FROM ({_PAYLOADS_SQL}) p""", _MATCH_CTE))
def q_j3_order(spark, sf_dir):
    """Creates before updates, parents before children, numbered in send order."""
    p = numbered_for_sending(q_j3(spark, sf_dir))
    return p.select("action", "id", "seq")


# Responses to the org unit requests: the report whose batch id is the
# customer key (creates) or the key + 7 (updates); invalid creates are not sent.
_RESP_SQL = f"""
SELECT 'CREATE' AS action, s.id, r.body
FROM fx_pyramid_source s LEFT JOIN fx_import_reports r ON s.id IS NOT NULL AND s.name IS NOT NULL
  AND s.shortName IS NOT NULL AND s.openingDate IS NOT NULL AND s.parent_id IS NOT NULL
  AND 'C' || CAST(r.batch_id AS VARCHAR) = s.id
WHERE NOT EXISTS (SELECT 1 FROM fx_pyramid_target t WHERE t.id = s.id)
UNION ALL
SELECT 'UPDATE', u.id, r.body FROM u LEFT JOIN fx_import_reports r ON 'C' || CAST(r.batch_id - 7 AS VARCHAR) = u.id
WHERE changed <> ''"""
_STATUS_SQL = f"""
SELECT action, id, status, response, coalesce(status IN ('SUCCESS', 'OK'), false) AS success,
       status IS DISTINCT FROM 'ERROR' AND status IS DISTINCT FROM 'NOTVALID' AS success_gen1
FROM (SELECT action, id, CASE WHEN body IS NULL THEN 'NOTVALID'
                              WHEN json_valid(body) THEN json_extract_string(body, '$.status') END AS status,
             CASE WHEN json_valid(body) THEN CAST(json_extract(body, '$.response') AS VARCHAR) END AS response
      FROM ({_RESP_SQL}) x) y"""


def _statuses(spark, sf_dir):
    src, tgt = _src(spark, sf_dir), _tgt(spark, sf_dir)
    fixtures.register(spark, sf_dir, ["fx_import_reports"])
    rep = spark.table("fx_import_reports")
    creates = create_payloads(org_units_to_create(src, tgt))
    sent_c = creates.join(rep, (F.col("valid")) & (F.concat(F.lit("C"), F.col("batch_id").cast("string"))
                                                   == F.col("id")), "left").select("action", "id", "body")
    updates = update_payloads(org_units_to_update(src, tgt, order_col="k"))
    sent_u = updates.join(rep, F.concat(F.lit("C"), (F.col("batch_id") - 7).cast("string")) == F.col("id"),
                          "left").select("action", "id", "body")
    return import_status(sent_c.unionByName(sent_u))


@query("j6_import_status", fixtures.with_views(PYR + ["fx_import_reports"], _STATUS_SQL, _MATCH_CTE))
def q_j6(spark, sf_dir):
    return _statuses(spark, sf_dir)


@query("d3_alignment_summary", fixtures.with_views(PYR + ["fx_import_reports"], f"""
SELECT action, CASE WHEN status = 'NOTVALID' THEN 'invalid' WHEN success THEN 'ok' ELSE 'error' END AS outcome,
       count(*) AS n
FROM ({_STATUS_SQL}) s GROUP BY 1, 2""", _MATCH_CTE))
def q_d3(spark, sf_dir):
    return alignment_summary(_statuses(spark, sf_dir))


@query("d4_leaf_org_unit_count", fixtures.with_views(PYR, """
SELECT level, count(DISTINCT id) AS n_org_units FROM fx_pyramid_source
WHERE level = (SELECT max(level) FROM fx_pyramid_source) GROUP BY level"""))
def q_d4(spark, sf_dir):
    src = _src(spark, sf_dir)
    return leaf_org_unit_count(src, src.select("level").distinct())


@query("d4_leaf_org_unit_count_of_level_table", fixtures.with_views(PYR, """
SELECT level, count(DISTINCT id) AS n_org_units FROM fx_pyramid_source WHERE level = 3 GROUP BY level"""))
def q_d4_levels(spark, sf_dir):
    """The level table decides how deep the pyramid is, not the units."""
    levels = spark.createDataFrame([(1,), (2,), (3,)], "level int")
    return leaf_org_unit_count(_src(spark, sf_dir), levels)


_DESC_SQL = fixtures.with_views(PYR, f"""
SELECT s.{', s.'.join(UNIT_COLS)} FROM fx_pyramid_source s WHERE s.id IN (SELECT id FROM d)""", [("d", f"""
SELECT id FROM fx_pyramid_source WHERE id IN ({', '.join("'" + r + "'" for r in ROOTS)})
UNION
SELECT s.id FROM fx_pyramid_source s JOIN d ON s.parent_id = d.id""")]).replace("WITH ", "WITH RECURSIVE ", 1)


@query("c11_select_descendants", _DESC_SQL)
def q_c11(spark, sf_dir):
    return select_descendants(_src(spark, sf_dir), ROOTS).select(*UNIT_COLS)


@query("c11_select_descendants_by_path", _DESC_SQL)
def q_c11p(spark, sf_dir):
    return descendants_by_path(_src(spark, sf_dir), ROOTS).select(*UNIT_COLS)
