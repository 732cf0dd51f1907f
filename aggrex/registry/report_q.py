"""Import reports over fx_import_reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from aggrex import fixtures
from aggrex.operators.reports import (COUNT_KEYS, error_details, error_report, import_conflicts, import_summary,
                                      invalid_org_units, rejected_data_points)
from aggrex.registry import query

REP = ["fx_import_reports", "fx_data_values"]


def _reports(spark, sf_dir):
    fixtures.register(spark, sf_dir, REP)
    return spark.table("fx_import_reports")


def _batch_rows(spark, sf_dir):
    """Data values cut into batches of 25 by row id: (batch_id, pos, row)."""
    fixtures.register(spark, sf_dir, REP)
    return spark.table("fx_data_values").select(
        (F.col("row_id") / 25).cast("bigint").alias("batch_id"), (F.col("row_id") % 25).cast("int").alias("pos"),
        "row_id", "dataElement", "period", "orgUnit", "value")


def _arr(path: str) -> str:
    return f"coalesce(CAST(json_extract(body, '{path}') AS JSON[]), [])"


def _len(path: str) -> str:
    return f"coalesce(json_array_length(json_extract(body, '{path}')), 0)"


_PARTS = [("conflict", "top", "$.conflicts"), ("conflict", "response", "$.response.conflicts"),
          ("error_report", "top", "$.errorReports"), ("error_report", "response", "$.response.errorReports")]


def _items_sql() -> str:
    selects = []
    for n, (kind, level, path) in enumerate(_PARTS):
        off = " + ".join([_len(p) for _, _, p in _PARTS[:n]] or ["0"])
        selects.append(f"""
SELECT batch_id, '{kind}' AS kind, '{level}' AS level, i + {off} AS item_pos, arr[i + 1] AS j
FROM (SELECT batch_id, body, arr, unnest(range(len(arr))) AS i
      FROM (SELECT batch_id, body, {_arr(path)} AS arr FROM fx_import_reports WHERE json_valid(body)) a
      WHERE len(arr) > 0) b""")
    return " UNION ALL ".join(selects)


_CONFLICTS_CTE = [("items", _items_sql()), ("conf", """
SELECT batch_id, CAST(item_pos AS INTEGER) AS item_pos, kind, level, json_extract_string(j, '$.object') AS object,
       CASE WHEN kind = 'conflict' THEN CAST(json_extract(j, '$.objects') AS VARCHAR) END AS objects,
       CASE WHEN kind = 'error_report' THEN json_extract_string(j, '$.mainKlass') END AS main_klass,
       CASE WHEN kind = 'conflict' THEN json_extract_string(j, '$.objects.organisationUnit') END AS org_unit,
       CASE WHEN kind = 'conflict' THEN json_extract_string(j, '$.value') END AS value,
       CASE WHEN kind = 'error_report' THEN json_extract_string(j, '$.message') END AS message,
       json_extract_string(j, '$.errorCode') AS error_code,
       CASE WHEN kind = 'conflict' THEN json_extract_string(j, '$.property') END AS property
FROM items""")]

_COUNTS_CTE = [("cnt", "SELECT batch_id, phase, body, " + ", ".join(
    f"coalesce(CAST(CASE WHEN NOT json_valid(body) THEN NULL "
    f"WHEN json_extract(body, '$.importCount') IS NOT NULL THEN json_extract(body, '$.importCount.{k}') "
    f"ELSE json_extract(body, '$.response.importCount.{k}') END AS BIGINT), 0) AS {k}" for k in COUNT_KEYS)
    + " FROM fx_import_reports")]


@query("j5_import_conflicts", fixtures.with_views(REP, "SELECT * FROM conf", _CONFLICTS_CTE))
def q_j5(spark, sf_dir):
    return import_conflicts(_reports(spark, sf_dir))


@query("d1_import_summary", fixtures.with_views(REP, "SELECT phase, " + ", ".join(
    f"CAST(sum({k}) AS BIGINT) AS {k}" for k in COUNT_KEYS) + " FROM cnt GROUP BY phase", _COUNTS_CTE))
def q_d1(spark, sf_dir):
    return import_summary(_reports(spark, sf_dir), by=["phase"])


_COUNTS_GEN1_CTE = [("cnt1", "SELECT batch_id, phase, " + ", ".join(
    f"coalesce(CAST(CASE WHEN json_valid(body) THEN json_extract(body, '$.response.importCount.{k}') END AS BIGINT), 0)"
    f" AS {k}" for k in COUNT_KEYS) + " FROM fx_import_reports")]


@query("d1_import_summary_gen1", fixtures.with_views(REP, "SELECT phase, " + ", ".join(
    f"CAST(sum({k}) AS BIGINT) AS {k}" for k in COUNT_KEYS) + " FROM cnt1 GROUP BY phase", _COUNTS_GEN1_CTE))
def q_d1_gen1(spark, sf_dir):
    """First-generation summary: counts read under ``response`` only."""
    return import_summary(_reports(spark, sf_dir), by=["phase"], generation="gen1")


@query("d5_invalid_org_units", fixtures.with_views(REP, """
SELECT DISTINCT coalesce(nullif(org_unit, ''), nullif(object, '')) AS org_unit FROM conf
WHERE (coalesce(value, '') LIKE '%Organisation unit not found%' OR coalesce(value, '') LIKE '%Invalid organisation unit%'
       OR property IS NOT DISTINCT FROM 'orgUnit' OR error_code IS NOT DISTINCT FROM 'E7612')
  AND coalesce(nullif(org_unit, ''), nullif(object, '')) IS NOT NULL""", _CONFLICTS_CTE))
def q_d5(spark, sf_dir):
    return invalid_org_units(import_conflicts(_reports(spark, sf_dir)))


_REJ_CTE = [("rej", """
SELECT batch_id, CAST(unnest(coalesce(CAST(json_extract(body, '$.response.rejectedIndexes') AS INTEGER[]),
                                      CAST(json_extract(body, '$.rejectedIndexes') AS INTEGER[]))) AS INTEGER) AS pos
FROM fx_import_reports WHERE json_valid(body)"""), ("rows", """
SELECT CAST(row_id // 25 AS BIGINT) AS batch_id, CAST(row_id % 25 AS INTEGER) AS pos, row_id, dataElement, period,
       orgUnit, value FROM fx_data_values""")]


@query("c15_rejected_data_points", fixtures.with_views(REP, """
SELECT r.batch_id, r.pos, w.row_id, w.dataElement, w.period, w.orgUnit, w.value
FROM rej r JOIN rows w ON r.batch_id = w.batch_id AND r.pos = w.pos""", _REJ_CTE))
def q_c15(spark, sf_dir):
    return rejected_data_points(_reports(spark, sf_dir), _batch_rows(spark, sf_dir))


@query("j7_error_report", fixtures.with_views(REP, f"""
SELECT c.batch_id, c.phase, json_valid(c.body) AS is_json,
       CASE WHEN json_valid(c.body) THEN coalesce(json_extract_string(c.body, '$.response.status'),
                                                   json_extract_string(c.body, '$.status')) END AS status,
       CASE WHEN json_valid(c.body) THEN coalesce(json_extract_string(c.body, '$.response.responseType'),
                                                   json_extract_string(c.body, '$.responseType')) END AS response_type,
       CASE WHEN json_valid(c.body) THEN coalesce(json_extract_string(c.body, '$.response.description'),
                                                   json_extract_string(c.body, '$.description')) END AS description,
       CASE WHEN json_valid(c.body) THEN coalesce(json_extract_string(c.body, '$.response.dataSetComplete'),
                                                   json_extract_string(c.body, '$.dataSetComplete')) END
         AS data_set_complete,
       {', '.join('c.' + k for k in COUNT_KEYS)},
       CASE WHEN json_valid(c.body) THEN CAST({' + '.join(_len(p).replace('body', 'c.body') for _, _, p in _PARTS)}
            AS INTEGER) ELSE 0 END AS n_conflicts,
       coalesce(x.n, 0) AS n_rejected_rows
FROM cnt c LEFT JOIN (SELECT r.batch_id, count(*) AS n FROM rej r JOIN rows w ON r.batch_id = w.batch_id
                      AND r.pos = w.pos GROUP BY r.batch_id) x ON x.batch_id = c.batch_id
WHERE NOT json_valid(c.body)
   OR coalesce(coalesce(json_extract_string(c.body, '$.response.status'), json_extract_string(c.body, '$.status'))
               IN ('SUCCESS', 'OK'), false) = false
   OR {' + '.join(_len(p).replace('body', 'c.body') for _, _, p in _PARTS)} > 0""", _COUNTS_CTE + _REJ_CTE))
def q_j7(spark, sf_dir):
    return error_report(_reports(spark, sf_dir), _batch_rows(spark, sf_dir))


_FAILED_CTE = [("failed", f"""
SELECT batch_id FROM fx_import_reports WHERE NOT json_valid(body)
   OR coalesce(coalesce(json_extract_string(body, '$.response.status'), json_extract_string(body, '$.status'))
               IN ('SUCCESS', 'OK'), false) = false
   OR {' + '.join(_len(p) for _, _, p in _PARTS)} > 0""")]


@query("j7_rejected_rows", fixtures.with_views(REP, """
SELECT r.batch_id, r.pos, w.row_id, w.dataElement, w.period, w.orgUnit, w.value
FROM rej r JOIN failed f ON f.batch_id = r.batch_id JOIN rows w ON r.batch_id = w.batch_id AND r.pos = w.pos""",
                                               _REJ_CTE + _FAILED_CTE))
def q_j7_rows(spark, sf_dir):
    """The rejected data points of the failed requests, row by row."""
    return error_details(_reports(spark, sf_dir), _batch_rows(spark, sf_dir))[0]


@query("j7_error_conflicts", fixtures.with_views(
    REP, "SELECT c.* FROM conf c JOIN failed f ON f.batch_id = c.batch_id", _CONFLICTS_CTE + _FAILED_CTE))
def q_j7_conflicts(spark, sf_dir):
    """Every conflict and error report of the failed requests."""
    return error_details(_reports(spark, sf_dir), _batch_rows(spark, sf_dir))[1]


@query("j7_error_report_gen1", fixtures.with_views(REP, """
SELECT batch_id, json_valid(body) AS is_json FROM fx_import_reports
WHERE NOT json_valid(body) OR (json_extract(body, '$.response') IS NOT NULL
   AND json_extract_string(body, '$.httpStatus') IS DISTINCT FROM 'OK')"""))
def q_j7_gen1(spark, sf_dir):
    """First generation: the HTTP status decides, not the conflicts."""
    return error_report(_reports(spark, sf_dir), _batch_rows(spark, sf_dir), generation="gen1").select(
        "batch_id", "is_json")
