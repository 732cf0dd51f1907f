"""A6, A7 from dumped pages: one JSON document per response page, in folders by
the period and org unit that were asked for.

A page has a ``pager`` and its rows. The folders are partition columns, so a
filter on them, or a join with the requests wanted, decides which files are
opened. A dump that stops half-way, or pages fetched while the server's answer
changed, show in ``incomplete_requests``; ``complete_pages`` leaves such
requests out whole, as half of an answer would pass for all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aggrex.schemas import ANALYTICS, DATA_VALUE
from aggrex.sources.io import rename_analytics

REQUEST = ["request_period", "request_unit"]
_PAGER = T.StructField("pager", T.StructType([T.StructField("page", T.IntegerType()),
                                              T.StructField("pageCount", T.IntegerType())]))
_FOLDERS = [T.StructField(c, T.StringType()) for c in REQUEST]
_BROKEN = T.StructField("broken", T.StringType())
DATA_VALUE_PAGE = T.StructType([_PAGER, T.StructField("dataValues", T.ArrayType(DATA_VALUE)), _BROKEN, *_FOLDERS])
# Analytics pages name their columns in headers; rows are lists in that order.
ANALYTICS_PAGE = T.StructType([
    _PAGER, T.StructField("headers", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
    T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))), _BROKEN, *_FOLDERS])


def scan_pages(spark: SparkSession, root: str, schema: T.StructType, requests: DataFrame | None = None,
               multi_line: bool = False) -> DataFrame:
    """Pages below ``root``, a line each (``multi_line``: a file each); ``requests``
    (request_period, request_unit) narrows the folders read. Filters on these columns do so
    too. A page that is no whole JSON document has its text in ``broken``."""
    pages = (spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "broken")
             .option("multiLine", multi_line).json(root))
    if requests is None:
        return pages
    return pages.join(requests.select(*REQUEST).distinct(), REQUEST, "left_semi")


def incomplete_requests(pages: DataFrame) -> DataFrame:
    """Requests whose pages are not each there once: (request_period, request_unit, page_count, pages_seen, reason).

    ``reason`` is the first that holds: ``broken page`` (no whole JSON document, or no page number),
    ``page count changed`` (the answer changed while it was fetched), ``repeated page``,
    ``missing page``. One aggregation; a request's rows are combined before the shuffle and
    page bodies don't travel.
    """
    page, of = F.col("pager.page"), F.col("pager.pageCount")
    counts = pages.groupBy(*REQUEST).agg(
        F.max(of).alias("page_count"), F.min(of).alias("least_count"), F.count(page).alias("numbered"),
        F.count_distinct(page).alias("pages_seen"), F.min(page).alias("first"), F.max(page).alias("last"),
        F.max((F.col("broken").isNotNull() | page.isNull() | of.isNull()).cast("int")).alias("any_broken"))
    whole = (F.col("pages_seen") == F.col("page_count")) & (F.col("first") == 1) & (F.col("last") == F.col("page_count"))
    return counts.withColumn("reason", F.when(F.col("any_broken") == 1, "broken page")
                             .when(F.col("least_count") < F.col("page_count"), "page count changed")
                             .when(F.col("numbered") > F.col("pages_seen"), "repeated page")
                             .when(~whole, "missing page")).where("reason is not null").select(
        *REQUEST, "page_count", "pages_seen", "reason")


def complete_pages(pages: DataFrame) -> DataFrame:
    """The pages of requests that are whole (null-safe on the folders)."""
    bad = incomplete_requests(pages).select(*[F.col(c).alias(f"bad_{c}") for c in REQUEST])
    same = [F.col(c).eqNullSafe(F.col(f"bad_{c}")) for c in REQUEST]
    return pages.join(bad, same, "left_anti")


def page_data_values(pages: DataFrame) -> DataFrame:
    """The data values of the pages, with the request they answer."""
    return pages.select(*REQUEST, F.inline("dataValues"))


def page_analytics(pages: DataFrame) -> DataFrame:
    """The cells of the pages by the names in each page's headers, renamed; columns
    that a page doesn't name are NULL."""
    cells = pages.select(*REQUEST, F.col("headers.name").alias("names"), F.explode("rows").alias("cells"))

    def cell(name):
        # Position 0 means the page has no such column.
        at = F.coalesce(F.array_position("names", name).cast("int"), F.lit(0))
        return F.when(at > 0, F.get("cells", at - 1)).alias(name)

    return rename_analytics(cells.select(*REQUEST, *[cell(c) for c in ANALYTICS.names]))
