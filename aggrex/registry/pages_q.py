"""Paged dumps (A6, A7): pages written from the fixture views, read by request."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from aggrex import fixtures
from aggrex.registry import query
from aggrex.session import checkpoint_dir
from aggrex.sources import pages as pg

PAGE_ROWS = 50  # rows per page of the fixture dump
UNIT_ROWS = 100_000  # a unit's row ids stay in one such range: answers are bounded, their number grows with the data
# The request of a row, its place in the answer, and pages: every answer is cut by row id.
_PAGED = """SELECT *, CAST(ceil(nth / 50.0) AS INTEGER) AS page, CAST(ceil(total / 50.0) AS INTEGER) AS page_count FROM (
  SELECT *, row_number() OVER (PARTITION BY request_period, request_unit ORDER BY row_id) AS nth,
    count(*) OVER (PARTITION BY request_period, request_unit) AS total FROM (
    SELECT v.*, substr(v.{period}, 1, 4) AS request_period,
      'U' || CAST(row_id % 4 AS VARCHAR) || '_' || CAST(row_id // 100000 AS VARCHAR) AS request_unit FROM {view} v))"""
_VALUES = [("paged", _PAGED.format(period="period", view="fx_data_values"))]
_CELLS = [("paged", _PAGED.format(period="pe", view="fx_analytics"))]


def _paged(spark, sf_dir, view, period):
    """Rows with request and page, as the SQL above; the window's groups are the requests."""
    rows = fixtures.view(spark, sf_dir, view).select(
        "*", F.substr(F.col(period), F.lit(1), F.lit(4)).alias("request_period"),
        F.concat(F.lit("U"), (F.col("row_id") % 4).cast("string"), F.lit("_"),
                 F.floor(F.col("row_id") / UNIT_ROWS).cast("string")).alias("request_unit"))
    w = Window.partitionBy(*pg.REQUEST)
    nth, total = F.row_number().over(w.orderBy("row_id")), F.count("*").over(w)
    return rows.select("*", F.ceil(nth / PAGE_ROWS).cast("int").alias("page"),
                       F.ceil(total / PAGE_ROWS).cast("int").alias("page_count"))


def _dump(spark, pages):
    path = f"{checkpoint_dir(spark).rstrip('/')}/pages-{uuid.uuid4().hex}"
    pages.write.partitionBy(*pg.REQUEST).json(path)
    return path


def _value_pages(spark, sf_dir):
    """A page of every answer: at most ``PAGE_ROWS`` rows in a list."""
    rows = _paged(spark, sf_dir, "fx_data_values", "period")
    return rows.groupBy(*pg.REQUEST, F.struct("page", F.col("page_count").alias("pageCount")).alias("pager")).agg(
        F.collect_list(F.struct(*pg.DATA_VALUE.names)).alias("dataValues"))


@query("a6_paged_data_values", fixtures.with_views(["fx_data_values"], """
SELECT request_period, request_unit, dataElement, period, orgUnit, categoryOptionCombo, attributeOptionCombo, value
FROM paged WHERE request_period >= '1994' AND request_unit NOT LIKE 'U1%'""", _VALUES))
def q_paged_values(spark, sf_dir):
    """Requests of one unit and of early years are not opened (partition filters)."""
    path = _dump(spark, _value_pages(spark, sf_dir))
    pages = pg.scan_pages(spark, path, pg.DATA_VALUE_PAGE).where(
        "request_period >= '1994' and not startswith(request_unit, 'U1')")
    return pg.page_data_values(pages)


@query("a6_incomplete_requests", fixtures.with_views(["fx_data_values"], """
SELECT request_period, request_unit, max(page_count) AS page_count,
  count(DISTINCT page) AS pages_seen, 'missing page' AS reason
FROM paged WHERE NOT (request_unit LIKE 'U2%' AND page = page_count) GROUP BY ALL HAVING count(DISTINCT page) < max(page_count)""",
                                                      _VALUES))
def q_incomplete(spark, sf_dir):
    """The last page of every answer to units U2 was not fetched (an answer of one page leaves no folder)."""
    lost = F.col("request_unit").startswith("U2") & (F.col("pager.page") == F.col("pager.pageCount"))
    path = _dump(spark, _value_pages(spark, sf_dir).where(~lost))
    return pg.incomplete_requests(pg.scan_pages(spark, path, pg.DATA_VALUE_PAGE))


@query("a7_paged_analytics", fixtures.with_views(["fx_analytics"], """
SELECT request_period, request_unit, dx, pe AS period, ou AS "orgUnit",
  CAST(NULL AS VARCHAR) AS "categoryOptionCombo", value
FROM paged JOIN (SELECT DISTINCT request_period AS rp, request_unit AS ru FROM paged WHERE row_id % 7 = 0) r
  ON rp = request_period AND ru = request_unit WHERE request_unit NOT LIKE 'U3%'""", _CELLS))
def q_paged_analytics(spark, sf_dir):
    """Cells by header names, columns in another order on every other page, for the requests
    wanted; U3's answers have a page that was cut off and are left out whole."""
    rows = _paged(spark, sf_dir, "fx_analytics", "pe")
    turned = F.col("page") % 2 == 0
    cells = F.when(turned, F.array("value", "ou", "dx", "pe")).otherwise(F.array("dx", "pe", "ou", "value"))
    names = F.when(F.col("pager.page") % 2 == 0, F.array(*map(F.lit, ["value", "ou", "dx", "pe"]))).otherwise(
        F.array(*map(F.lit, ["dx", "pe", "ou", "value"])))
    bodies = (rows.groupBy(*pg.REQUEST, F.struct("page", F.col("page_count").alias("pageCount")).alias("pager"))
              .agg(F.collect_list(cells).alias("rows"))
              .withColumn("headers", F.transform(names, lambda n: F.struct(n.alias("name")))))
    text = F.to_json(F.struct("pager", "headers", "rows"), {"ignoreNullFields": "false"})
    cut = F.col("request_unit").startswith("U3") & (F.col("pager.page") == 1)
    path = f"{checkpoint_dir(spark).rstrip('/')}/pages-{uuid.uuid4().hex}"
    (bodies.select(*pg.REQUEST, F.when(cut, F.substr(text, F.lit(1), F.length(text) - 5)).otherwise(text).alias("value"))
     .write.partitionBy(*pg.REQUEST).text(path))
    wanted = rows.where("row_id % 7 = 0").select(*pg.REQUEST)
    return pg.page_analytics(pg.complete_pages(pg.scan_pages(spark, path, pg.ANALYTICS_PAGE, wanted)))
