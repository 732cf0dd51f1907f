"""Import reports as tables.

A report body is the JSON text the target returned for one request. It is
parsed once with an explicit schema (``from_json``; text that is not JSON
gives a NULL struct). Counts and conflicts may sit at the top level or under
``response``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, L = T.StringType(), T.LongType()
COUNT_KEYS = ["imported", "updated", "ignored", "deleted"]

IMPORT_COUNT = T.StructType([T.StructField(k, L) for k in COUNT_KEYS])
CONFLICT = T.StructType([
    T.StructField("object", S), T.StructField("objects", T.MapType(S, S)), T.StructField("value", S),
    T.StructField("errorCode", S), T.StructField("property", S)])
ERROR_REPORT = T.StructType([
    T.StructField("message", S), T.StructField("errorCode", S), T.StructField("mainKlass", S),
    T.StructField("object", S)])
_LEVEL_FIELDS = [
    T.StructField("status", S), T.StructField("description", S), T.StructField("responseType", S),
    T.StructField("importCount", IMPORT_COUNT), T.StructField("conflicts", T.ArrayType(CONFLICT)),
    T.StructField("errorReports", T.ArrayType(ERROR_REPORT)),
    T.StructField("rejectedIndexes", T.ArrayType(T.IntegerType())), T.StructField("dataSetComplete", S)]
REPORT_BODY = T.StructType([T.StructField("httpStatus", S)] + _LEVEL_FIELDS
                           + [T.StructField("response", T.StructType(_LEVEL_FIELDS))])

# What marks a conflict as an org unit problem.
ORG_UNIT_MESSAGES = ["Organisation unit not found", "Invalid organisation unit"]
ORG_UNIT_PROPERTY = "orgUnit"
ORG_UNIT_ERROR_CODE = "E7612"


# Bodies that are JSON but say nothing; the reference takes them for no answer.
EMPTY_BODIES = ["{}", "[]", "null", '""', "0", "false"]


def parse_reports(reports: DataFrame, body: str = "body") -> DataFrame:
    """Add ``r`` (parsed body), ``is_json`` and ``is_empty`` (JSON that says nothing)."""
    return (reports.withColumn("r", F.from_json(F.col(body), REPORT_BODY))
                   .withColumn("is_json", F.try_parse_json(F.col(body)).isNotNull())
                   .withColumn("is_empty", F.coalesce(F.regexp_replace(body, r"\s", "").isin(*EMPTY_BODIES),
                                                      F.lit(False))))


def _counts(parsed: Column, generation: str = "gen2") -> Column:
    """Counts at the top level when the top level has ``importCount``, else
    under ``response`` (second generation); the first generation reads only
    ``response.importCount``. Missing keys are 0."""
    top, nested = parsed["importCount"], parsed["response"]["importCount"]
    src = nested if generation == "gen1" else F.when(top.isNotNull(), top).otherwise(nested)
    return F.struct(*[F.coalesce(src[k], F.lit(0)).alias(k) for k in COUNT_KEYS])


def import_summary(reports: DataFrame, by: list[str] = (), generation: str = "gen2") -> DataFrame:
    """Imported / updated / ignored / deleted summed over reports."""
    p = parse_reports(reports).withColumn("_c", _counts(F.col("r"), generation))
    return p.groupBy(*by).agg(*[F.sum(F.col("_c")[k]).alias(k) for k in COUNT_KEYS])


def _conflict_rows(arr: Column, level: str) -> Column:
    return F.transform(F.coalesce(arr, F.array().cast(T.ArrayType(CONFLICT))), lambda c: F.struct(
        F.lit("conflict").alias("kind"), F.lit(level).alias("level"), c["object"].alias("object"),
        F.to_json(c["objects"]).alias("objects"), F.lit(None).cast(S).alias("main_klass"),
        c["objects"]["organisationUnit"].alias("org_unit"), c["value"].alias("value"),
        F.lit(None).cast(S).alias("message"), c["errorCode"].alias("error_code"), c["property"].alias("property")))


def _error_rows(arr: Column, level: str) -> Column:
    return F.transform(F.coalesce(arr, F.array().cast(T.ArrayType(ERROR_REPORT))), lambda e: F.struct(
        F.lit("error_report").alias("kind"), F.lit(level).alias("level"), e["object"].alias("object"),
        F.lit(None).cast(S).alias("objects"), e["mainKlass"].alias("main_klass"),
        F.lit(None).cast(S).alias("org_unit"), F.lit(None).cast(S).alias("value"), e["message"].alias("message"),
        e["errorCode"].alias("error_code"), F.lit(None).cast(S).alias("property")))


def import_conflicts(reports: DataFrame, keep: list[str] = ("batch_id",)) -> DataFrame:
    """Every conflict and error report, top level and under ``response``,
    one row each (kind, level, object, objects as JSON text, main_klass,
    org_unit, value, message, error_code, property)."""
    r = F.col("r")
    # Order of the reference's list: all conflicts (top, nested), then all
    # error reports (top, nested).
    items = F.concat(_conflict_rows(r["conflicts"], "top"), _conflict_rows(r["response"]["conflicts"], "response"),
                     _error_rows(r["errorReports"], "top"), _error_rows(r["response"]["errorReports"], "response"))
    return (parse_reports(reports).select(*keep, F.posexplode(items).alias("item_pos", "c"))
            .select(*keep, "item_pos", "c.*"))


def invalid_org_units(conflicts: DataFrame) -> DataFrame:
    """Distinct org unit ids named by org unit conflicts: the value names a
    missing / invalid unit, or the property is orgUnit, or the code is E7612.
    The id is objects.organisationUnit unless empty, else the object."""
    v = F.coalesce(F.col("value"), F.lit(""))
    hit = F.lit(False)
    for m in ORG_UNIT_MESSAGES:
        hit = hit | v.contains(m)
    hit = hit | F.col("property").eqNullSafe(F.lit(ORG_UNIT_PROPERTY)) \
        | F.col("error_code").eqNullSafe(F.lit(ORG_UNIT_ERROR_CODE))
    ou = F.coalesce(F.nullif(F.col("org_unit"), F.lit("")), F.nullif(F.col("object"), F.lit("")))
    return conflicts.where(hit).select(ou.alias("org_unit")).where(F.col("org_unit").isNotNull()).distinct()


def rejected_indexes(reports: DataFrame, keep: list[str] = ("batch_id",)) -> DataFrame:
    """(batch id, position) of every rejected data point (nested first).
    Accepts raw or already parsed reports."""
    p = reports if "r" in reports.columns else parse_reports(reports)
    r = F.col("r")
    idx = F.coalesce(r["response"]["rejectedIndexes"], r["rejectedIndexes"])
    return p.select(*keep, F.explode(idx).alias("pos"))


def rejected_data_points(reports: DataFrame, batch_rows: DataFrame) -> DataFrame:
    """The rows of each batch named by ``rejectedIndexes``; ``batch_rows``
    carries (batch_id, pos, ...). An equi-join on (batch_id, pos)."""
    return rejected_indexes(reports).join(batch_rows, ["batch_id", "pos"], "inner")


def request_failed(generation: str = "gen2") -> Column:
    """J7's rule over parsed reports (``parse_reports``): the request did not succeed."""
    r = F.col("r")
    if generation == "gen1":
        return ~F.col("is_json") | (r["response"].isNotNull() & ~r["httpStatus"].eqNullSafe(F.lit("OK")))
    status = F.coalesce(r["response"]["status"], r["status"])
    n_items = F.lit(0)
    for level in (r, r["response"]):
        for name in ("conflicts", "errorReports"):
            n_items = n_items + F.coalesce(F.size(level[name]), F.lit(0))
    return ~F.col("is_json") | ~F.coalesce(status.isin("SUCCESS", "OK"), F.lit(False)) | (n_items > 0)


def failed_reports(reports: DataFrame, generation: str = "gen2") -> DataFrame:
    """The reports of failed requests, parsed once, as plain columns with the
    arrays that the details of J7 are exploded from.

    Second generation: status not SUCCESS / OK, no JSON, or any conflict. First
    generation: no JSON, or ``httpStatus`` other than OK on a body with a
    ``response`` (its conflicts do not matter). The result is checkpointed: the
    summary, the rejected rows and the conflicts all read it, and none of their
    filters reaches the JSON parser.
    """
    r = F.col("r")
    status = F.coalesce(r["response"]["status"], r["status"])
    items = F.concat(_conflict_rows(r["conflicts"], "top"), _conflict_rows(r["response"]["conflicts"], "response"),
                     _error_rows(r["errorReports"], "top"), _error_rows(r["response"]["errorReports"], "response"))
    base = parse_reports(reports).select(
        "batch_id", "phase", "is_json", status.alias("status"), r["httpStatus"].alias("http_status"),
        r["response"].isNotNull().alias("has_response"),
        F.coalesce(r["response"]["responseType"], r["responseType"]).alias("response_type"),
        F.coalesce(r["response"]["description"], r["description"]).alias("description"),
        F.coalesce(r["response"]["dataSetComplete"], r["dataSetComplete"]).alias("data_set_complete"),
        _counts(r, generation).alias("c"),
        items.alias("items"), F.coalesce(r["response"]["rejectedIndexes"], r["rejectedIndexes"]).alias("rejected"))
    base = base.checkpoint(eager=True)
    if generation == "gen1":
        failed = ~F.col("is_json") | (F.col("has_response") & ~F.col("http_status").eqNullSafe(F.lit("OK")))
    else:
        failed = (~F.col("is_json") | ~F.coalesce(F.col("status").isin("SUCCESS", "OK"), F.lit(False))
                  | (F.size("items") > 0))
    return base.where(failed)


def error_report(reports: DataFrame, batch_rows: DataFrame, generation: str = "gen2") -> DataFrame:
    """One row per failed request: status, description, dataSetComplete,
    counts, number of conflicts (all kept, not only the last) and of rejected
    rows found in the batch. ``error_details`` has the rows themselves."""
    failed = failed_reports(reports, generation)
    rejected = (failed.select("batch_id", F.explode("rejected").alias("pos"))
                .join(batch_rows.select("batch_id", "pos"), ["batch_id", "pos"])
                .groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rejected_rows")))
    return (failed.join(rejected, "batch_id", "left")
                  .select("batch_id", "phase", "is_json", "status", "response_type", "description",
                          "data_set_complete", *[F.col("c")[k].alias(k) for k in COUNT_KEYS],
                          F.size("items").alias("n_conflicts"),
                          F.coalesce("n_rejected_rows", F.lit(0)).alias("n_rejected_rows")))


def error_details(reports: DataFrame, batch_rows: DataFrame, generation: str = "gen2"
                  ) -> tuple[DataFrame, DataFrame]:
    """J7 details of failed requests: (their rejected data points, with the
    columns of ``batch_rows``; their conflicts and error reports, one row each)."""
    failed = failed_reports(reports, generation)
    rows = failed.select("batch_id", F.explode("rejected").alias("pos")).join(batch_rows, ["batch_id", "pos"])
    conflicts = failed.select("batch_id", F.posexplode("items").alias("item_pos", "i")).select(
        "batch_id", "item_pos", "i.*")
    return rows, conflicts


def completion_outcome(responses: DataFrame, keep: list[str]) -> DataFrame:
    """Per completion registration response: no JSON, or JSON that says
    nothing (``{}``) -> one push error;
    status ERROR / WARNING or any conflict -> one push error per conflict
    (counts still added); SUCCESS -> ok, counts added; anything else -> no
    counts."""
    p = parse_reports(responses)
    r = F.col("r")
    n_conf = F.size(F.coalesce(r["conflicts"], F.array()))
    status = r["status"]
    outcome = (F.when(~F.col("is_json") | F.col("is_empty"), F.lit("no_json"))
                .when(status.isin("ERROR", "WARNING") | (n_conf > 0), F.lit("conflict"))
                .when(status == "SUCCESS", F.lit("ok")).otherwise(F.lit("other")))
    counted = F.col("outcome").isin("conflict", "ok")
    out = p.select(*keep, status.alias("status"), outcome.alias("outcome"), n_conf.alias("n_conflicts"),
                   r["importCount"].alias("_ic"))
    return out.select(*keep, "status", "outcome",
                      F.when(F.col("outcome") == "no_json", F.lit(1))
                       .when(F.col("outcome") == "conflict", F.col("n_conflicts")).otherwise(F.lit(0))
                       .alias("push_errors"),
                      *[F.when(counted, F.coalesce(F.col("_ic")[k], F.lit(0))).otherwise(F.lit(0)).alias(k)
                        for k in COUNT_KEYS])
