"""Operator 2: URL filtering by a temporal list join.

A URL list is a log of dated events: an entry (host, domain with its
subdomains, or URL prefix) is added on a day and removed on another. Events
become validity intervals; an as-of join evaluates every capture against the
entries active when it was fetched.

DataFrame expressions only. A capture asks for a bounded number of keys: its
host, the host's parent domains, and the URL's path prefixes. Intervals are
dealt by key and calendar month, so a key with a long history, or a host with a
third of all captures, is not one join group; adaptive execution splits what is
left. Every capture comes back, with the entries that matched merged into one
decision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("host", "domain", "prefix")
OPEN_END = "9999-12-31"


def split_url(url: Column) -> dict[str, Column]:
    """host and path of an http(s) URL: lower-case host without user, port and closing
    dot; path without query and fragment. Both NULL if the URL has no host."""
    rest = F.regexp_extract(url, r"^(?i:https?)://([^/?#\s]+)([^?#\s]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(rest), r"^.*@", ""), r":[0-9]*$|\.$", "")
    path = F.regexp_extract(url, r"^(?i:https?)://([^/?#\s]+)([^?#\s]*)", 2)
    found = F.length(host) > 0
    return {"host": F.when(found, host), "path": F.when(found, F.when(path == "", "/").otherwise(path))}


def _lower_host(entry: Column) -> Column:
    """The entry with its host, which ends at the first slash, in lower case; paths are case-sensitive."""
    return F.concat(F.lower(F.substring_index(entry, "/", 1)), F.regexp_extract(entry, r"(?s)^[^/]*(.*)$", 1))


def validity_intervals(events: DataFrame) -> DataFrame:
    """(kind, entry, category, valid_from, valid_to) of list events (kind, entry,
    category, event_date, action 'add' or 'remove').

    An interval runs from an add to the day before the next event of the entry
    (valid_to is exclusive). Several events of an entry on one day count as the
    last in the order remove, add, so that a removal and an addition on the same
    day leave the entry on the list; of several categories the least name
    stays. Hosts are compared in lower case, paths as they are. Adding what is on the list continues it under the new category.
    Events with a NULL kind, entry or date, and other actions, are left out.
    """
    day = (events.where(F.col("kind").isin(*KINDS) & F.col("entry").isNotNull() & F.col("event_date").isNotNull()
                        & F.col("action").isin("add", "remove"))
           .groupBy("kind", _lower_host(F.col("entry")).alias("entry"), "event_date")
           .agg(F.max((F.col("action") == "add").cast("int")).alias("on_list"),
                F.min(F.when(F.col("action") == "add", F.col("category"))).alias("category")))
    following = F.lead("event_date").over(Window.partitionBy("kind", "entry").orderBy("event_date"))
    return (day.withColumn("valid_to", F.coalesce(following, F.lit(OPEN_END).cast("date")))
            .where("on_list = 1")
            .select("kind", "entry", "category", F.col("event_date").alias("valid_from"), "valid_to"))


def _month(date: Column) -> Column:
    return (F.year(date) * 12 + F.month(date) - 1).cast("int")


def _keys(host: Column, path: Column, labels: int, steps: int) -> Column:
    """What entries can match: the host, it and its parents as domains, and path
    prefixes at each slash; no longer than the longest entries on the list."""
    names, parts = F.split(host, r"\."), F.split(path, "/")
    n = F.size(names)
    parents = F.when(F.lit(labels) > 0, F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(max(labels, 1)))),
        lambda i: F.concat(F.lit("domain "), F.array_join(F.slice(names, n - i + 1, i), "."))))
    # /a/b/c: host/, host/a/, host/a/b/ and host/a/b/c itself.
    prefixes = F.when(F.lit(steps) > 0, F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(steps, 1)))),
        lambda i: F.concat(F.lit("prefix "), host, F.array_join(F.slice(parts, 1, i), "/"),
                           F.when(i < F.size(parts), "/").otherwise(""))))
    none = F.expr("cast(array() as array<string>)")
    return F.array_distinct(F.concat(F.array(F.concat(F.lit("host "), host)), F.coalesce(parents, none),
                                     F.coalesce(prefixes, none)))


def filter_captures(captures: DataFrame, intervals: DataFrame) -> DataFrame:
    """One row per page_id of the captures (page_id, url, fetch_date): page_id,
    blocked, n_entries (matching intervals), categories (ordered, joined by a
    comma), first_listed (earliest valid_from of them).

    Prefix entries are written host/path and match at slashes or as the whole
    path. A capture with a NULL date or URL, or a URL without a host, matches
    nothing. Rows that share a page_id are evaluated together: blocked if one
    of them is; rows with a NULL page_id count as one page. Two small results
    are read first: the months that captures span, and how long the longest
    entries are.
    """
    span = captures.agg(F.min("fetch_date").alias("first"), F.max("fetch_date").alias("last")).first()
    size = intervals.agg(
        F.max(F.when(F.col("kind") == "domain", F.size(F.split("entry", r"\.")))).alias("labels"),
        F.max(F.when(F.col("kind") == "prefix", F.size(F.split("entry", "/")))).alias("steps")).first()
    pages = captures.select("page_id").distinct()
    first, last = F.lit(span["first"]).cast("date"), F.lit(span["last"]).cast("date")
    url = split_url(F.col("url"))
    asked = (captures.where("fetch_date is not null")
             .select("page_id", "fetch_date", _month(F.col("fetch_date")).alias("month"),
                     url["host"].alias("host"), url["path"].alias("path")).where("host is not null")
             .select("page_id", "fetch_date", "month", F.explode(
                 _keys(F.col("host"), F.col("path"), size["labels"] or 0, size["steps"] or 0)).alias("key")))
    dealt = (intervals.where((F.col("valid_from") <= last) & (F.col("valid_to") > first))
             .withColumn("month", F.explode(F.sequence(
                 _month(F.greatest("valid_from", first)), _month(F.least(F.date_sub("valid_to", 1), last)))))
             .select(F.concat_ws(" ", "kind", "entry").alias("key"), "month", "category", "valid_from", "valid_to"))
    hits = (asked.join(dealt, ["key", "month"])
            .where("valid_from <= fetch_date and fetch_date < valid_to")
            .groupBy("page_id").agg(F.count("*").alias("n_entries"), F.collect_set("category").alias("names"),
                                    F.min("valid_from").alias("first_listed")))
    hits = hits.withColumnRenamed("page_id", "hit_id")
    return (pages.join(hits, F.col("page_id").eqNullSafe(F.col("hit_id")), "left")
            .select("page_id", F.col("n_entries").isNotNull().alias("blocked"),
                    F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
                    F.coalesce(F.array_join(F.array_sort("names"), ","), F.lit("")).alias("categories"),
                    "first_listed"))
