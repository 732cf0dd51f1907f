"""Views that shape the driver's tables into the exchange data model.

Each view is one SQL text valid in both Spark SQL and DuckDB, so the same
input feeds the Spark operators and the DuckDB oracle. Views are lazy: on a
cluster they are just projections over the (large) base tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ["region", "nation", "customer", "orders", "events"]

# name -> (SQL body, views it depends on)
VIEWS: dict[str, tuple[str, list[str]]] = {}


def _view(name: str, deps: list[str], sql: str) -> None:
    VIEWS[name] = (sql.strip(), deps)


# ROOT > region > nation > customer
_view("fx_pyramid_source", [], """
SELECT 'ROOT' AS id, 'Country' AS name, 'Country' AS shortName, '2000-01-01' AS openingDate,
       CAST(NULL AS STRING) AS closedDate, CAST(NULL AS STRING) AS parent_id, 1 AS level, '/ROOT' AS path,
       CAST(NULL AS STRING) AS geometry, CAST(-1 AS BIGINT) AS k
UNION ALL
SELECT 'R' || CAST(r_regionkey AS STRING), r_name, substr(r_name, 1, 4), '2000-01-01', CAST(NULL AS STRING), 'ROOT', 2,
       '/ROOT/R' || CAST(r_regionkey AS STRING), CAST(NULL AS STRING), CAST(-1 AS BIGINT) FROM region
UNION ALL
SELECT 'N' || CAST(n_nationkey AS STRING), n_name, n_name, '2000-01-01', CAST(NULL AS STRING),
       'R' || CAST(n_regionkey AS STRING), 3,
       '/ROOT/R' || CAST(n_regionkey AS STRING) || '/N' || CAST(n_nationkey AS STRING), CAST(NULL AS STRING),
       CAST(-1 AS BIGINT) FROM nation
UNION ALL
SELECT 'C' || CAST(c_custkey AS STRING), c_name, CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE c_mktsegment END,
       '2001-01-01', CASE WHEN c_custkey % 11 = 0 THEN '2030-12-31' END, 'N' || CAST(c_nationkey AS STRING), 4,
       '/ROOT/R' || CAST(n_regionkey AS STRING) || '/N' || CAST(c_nationkey AS STRING) || '/C' || CAST(c_custkey AS STRING),
       CASE WHEN c_custkey % 5 = 0 THEN '{"type":"Point","coordinates":[1,2]}' END, c_custkey
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")

# every tenth facility missing; names, closing dates, parents and geometry key order drifted
_view("fx_pyramid_target", ["fx_pyramid_source"], """
SELECT id, CASE WHEN k >= 0 AND k % 7 = 0 THEN upper(name) || ' OLD' ELSE name END AS name, shortName, openingDate,
       CASE WHEN k >= 0 AND k % 13 = 0 THEN NULL ELSE closedDate END AS closedDate,
       CASE WHEN k >= 0 AND k % 17 = 0 THEN 'N0' ELSE parent_id END AS parent_id, level, path,
       CASE WHEN k >= 0 AND k % 15 = 0 THEN '{"coordinates": [1, 2], "type": "Point"}'
            WHEN k >= 0 AND k % 25 = 0 THEN '{"type":"Point","coordinates":[1,3]}'
            WHEN k >= 0 AND k % 5 = 0 AND k % 4 = 1 THEN '{"type":"Point","coordinates":[1.0,2.00]}'
            ELSE geometry END AS geometry, k
FROM fx_pyramid_source WHERE k < 0 OR k % 10 <> 0
""")

# raw data values, with missing keys (invalid) and missing values (to delete)
_view("fx_data_values", [], """
SELECT 'DE' || substr(o_orderpriority, 1, 1) AS dataElement,
       CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING) AS period,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE 'C' || CAST(o_custkey AS STRING) END AS orgUnit,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'COC' || o_orderstatus END AS categoryOptionCombo,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'AOC1' END AS attributeOptionCombo,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS value,
       o_orderkey AS row_id
FROM orders
""")

# rate cells "dataset.metric"; some 100s, some unparseable values, type 'error' has no metric
_view("fx_analytics", [], """
SELECT 'DS' || CAST(user_id % 5 AS STRING) || CASE event_type WHEN 'view' THEN '.REPORTING_RATE'
         WHEN 'click' THEN '.REPORTING_RATE_ON_TIME' WHEN 'signup' THEN '.ACTUAL_REPORTS'
         WHEN 'purchase' THEN '.EXPECTED_REPORTS' ELSE '' END AS dx,
       CAST(year(ts) * 100 + month(ts) AS STRING) AS pe, 'C' || CAST(user_id AS STRING) AS ou,
       CASE WHEN event_id % 10 = 0 THEN '100' WHEN event_id % 41 = 0 THEN 'n/a'
            ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END AS value, event_id AS row_id
FROM events
""")

# several registrations per org unit, ordinal = row_id
_view("fx_completions", [], """
SELECT 'DS' || CAST(o_orderkey % 3 AS STRING) AS dataSet, CAST(year(o_orderdate) AS STRING) AS period,
       'C' || CAST(o_custkey AS STRING) AS organisationUnit,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS date, o_orderstatus = 'F' AS completed, o_orderkey AS row_id
FROM orders
""")

# org units already synchronised
_view("fx_processed", [], """
SELECT DISTINCT 'DS' || CAST(o_orderkey % 2 + 1 AS STRING) AS dataset, CAST(year(o_orderdate) AS STRING) AS period,
       'C' || CAST(o_custkey AS STRING) AS org_unit
FROM orders WHERE o_custkey % 4 = 0
""")

# import reports, one per order: top-level or nested counts, conflicts, error
# reports, rejected indexes and non-JSON bodies
_view("fx_import_reports", [], """
SELECT o_orderkey AS batch_id,
       CASE WHEN o_orderkey % 2 = 0 THEN 'valid' ELSE 'to_delete' END AS phase,
       CASE o_orderkey % 6
         WHEN 0 THEN '{"httpStatus":"Conflict","response":{"responseType":"ImportSummary","status":"WARNING",'
           || '"description":"Import process completed with conflicts","importCount":{"imported":'
           || CAST(o_custkey % 50 AS STRING) || ',"updated":' || CAST(o_orderkey % 7 AS STRING)
           || ',"ignored":2,"deleted":0},"conflicts":[{"object":"C' || CAST(o_custkey AS STRING)
           || '","objects":{"organisationUnit":"C' || CAST(o_custkey AS STRING)
           || '"},"value":"Organisation unit not found or not accessible","errorCode":"E7612","property":"orgUnit"}],'
           || '"rejectedIndexes":[0,' || CAST(o_orderkey % 3 + 1 AS STRING) || ']}}'
         WHEN 1 THEN '{"status":"SUCCESS","importCount":{"imported":' || CAST(o_custkey % 90 AS STRING)
           || ',"updated":' || CAST(o_orderkey % 11 AS STRING) || ',"ignored":0,"deleted":'
           || CAST(o_orderkey % 4 AS STRING) || '}}'
         WHEN 2 THEN '{"status":"ERROR","description":"Conflicts","importCount":{"imported":0,"updated":0,"ignored":'
           || CAST(o_custkey % 13 AS STRING) || ',"deleted":0},"conflicts":[{"object":"DE'
           || substr(o_orderpriority, 1, 1) || '","objects":{"dataElement":"DE' || substr(o_orderpriority, 1, 1)
           || '"},"value":"Data element not found","errorCode":"E7610","property":"dataElement"},'
           || '{"object":"C' || CAST(o_custkey AS STRING) || '","objects":{"organisationUnit":""},'
           || '"value":"Invalid organisation unit: C' || CAST(o_custkey AS STRING)
           || '","errorCode":"E7603","property":"period"}],'
           || '"errorReports":[{"message":"Period not open","errorCode":"E7641","mainKlass":"DataValue"}],'
           || '"rejectedIndexes":[1]}'
         WHEN 3 THEN '<html>502 Bad Gateway</html>'
         WHEN 4 THEN '{"status":"OK","importCount":{"imported":' || CAST(o_custkey % 20 AS STRING) || '},'
           || '"response":{"importCount":{"updated":99}}}'
         ELSE '{"httpStatus":"OK","response":{"status":"SUCCESS","importCount":{"imported":1,"updated":'
           || CAST(o_custkey % 5 AS STRING) || '},"conflicts":[{"object":"C' || CAST(o_custkey AS STRING)
           || '","value":"Value must be numeric","errorCode":"E7619","property":"orgUnit"}],'
           || '"errorReports":[{"message":"Org unit closed","errorCode":"E7612","object":"N'
           || CAST(o_custkey % 25 AS STRING) || '"}]}}'
       END AS body
FROM orders
""")

# work ledger: every order asks for its month; a finished order closes it as of 3 days before its date
_view("fx_requested", [], """
SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING) AS unit, o_orderdate AS requested_at
FROM orders
""")
_view("fx_finished", [], """
SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING) AS unit,
       o_orderdate - INTERVAL 3 DAY AS finished_at
FROM orders WHERE o_orderstatus = 'F'
""")


# Base tables each view reads.
BASE_OF = {
    "fx_pyramid_source": ["region", "nation", "customer"], "fx_pyramid_target": [],
    "fx_data_values": ["orders"], "fx_analytics": ["events"], "fx_completions": ["orders"],
    "fx_processed": ["orders"], "fx_import_reports": ["orders"], "fx_requested": ["orders"],
    "fx_finished": ["orders"],
}

# (session, sf_dir) -> names registered in it; a different sf_dir replaces the views.
_REGISTERED: dict[int, tuple[str, set]] = {}


def _have(spark: SparkSession, sf_dir: str, name: str) -> bool:
    cur = _REGISTERED.get(id(spark))
    return bool(cur and cur[0] == sf_dir and name in cur[1] and spark.catalog.tableExists(name))


def _mark(spark: SparkSession, sf_dir: str, name: str) -> None:
    cur = _REGISTERED.get(id(spark))
    if not cur or cur[0] != sf_dir:
        cur = (sf_dir, set())
        _REGISTERED[id(spark)] = cur
    cur[1].add(name)


def register_base_tables(spark: SparkSession, sf_dir: str, tables=BASE_TABLES) -> None:
    for t in tables:
        if not _have(spark, sf_dir, t):
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
            _mark(spark, sf_dir, t)


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in VIEWS[n][1]:
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def register(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    """Register the requested fixture views (with their views and base tables);
    what this session already has for ``sf_dir`` is not registered again."""
    views = _closure(names or list(VIEWS))
    register_base_tables(spark, sf_dir, sorted({t for v in views for t in BASE_OF[v]}))
    for n in views:
        if not _have(spark, sf_dir, n):
            spark.sql(f"CREATE OR REPLACE TEMP VIEW {n} AS {VIEWS[n][0]}")
            _mark(spark, sf_dir, n)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register(spark, sf_dir, [name])
    return spark.table(name)


def with_views(names: list[str], body: str, extra_ctes: list[tuple[str, str]] | None = None) -> str:
    """DuckDB oracle text: the fixture views as CTEs in front of ``body``."""
    ctes = [(n, VIEWS[n][0]) for n in _closure(names)] + list(extra_ctes or [])
    if not ctes:
        return body
    return "WITH " + ",\n".join(f"{n} AS (\n{sql}\n)" for n, sql in ctes) + "\n" + body
