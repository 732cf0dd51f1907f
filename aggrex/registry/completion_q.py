"""Dataset completion sync over fx_completions / fx_processed."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from aggrex import fixtures
from aggrex.operators.completion import (completion_lookup, completion_payload, completion_summary,
                                         completions_under, merge_ledger, unprocessed_org_units)
from aggrex.operators.dims import config_dim
from aggrex.operators.reports import COUNT_KEYS, completion_outcome
from aggrex.registry import query
from aggrex.schemas import COMPLETION
from aggrex.session import checkpoint_dir
from aggrex.sources import io
from aggrex.streaming.incremental import record_outcomes, sync_batch

COMPLETION_WITH_ORDINAL = T.StructType(COMPLETION.fields + [T.StructField("row_id", T.LongType())])
DATASET_PAIR = T.StructType([T.StructField("source_dataset", T.StringType()),
                             T.StructField("target_dataset", T.StringType())])

VIEWS = ["fx_completions", "fx_processed", "fx_pyramid_source", "fx_data_values", "fx_import_reports"]
# Fixture configuration: parents whose subtree is synchronised and the
# source -> target dataset pairs.
PARENTS = ["R1", "R3"]
PAIRS = [("DS1", "TDS1"), ("DS2", "TDS2")]

_IN_PARENTS_SQL = " OR ".join(f"list_contains(string_split(path, '/'), '{p}')" for p in PARENTS)
_DS_SQL = ", ".join(f"'{s}'" for s, _ in PAIRS)
_PAIRS_SQL = "(VALUES " + ", ".join(f"('{s}', '{t}')" for s, t in PAIRS) + ") AS pr(source_dataset, target_dataset)"

_CTES = [
    ("regs", f"""SELECT * FROM fx_completions WHERE dataSet IN ({_DS_SQL})
      AND organisationUnit IN (SELECT id FROM fx_pyramid_source WHERE {_IN_PARENTS_SQL})"""),
    ("todo", f"""SELECT DISTINCT d.dataset, substr(v.period, 1, 4) AS period, v.orgUnit AS org_unit
      FROM fx_data_values v JOIN (VALUES {", ".join(f"('{x}')" for x, _ in PAIRS)}) AS d(dataset) ON true
      WHERE v.orgUnit IS NOT NULL"""),
    ("todo_now", """SELECT * FROM todo t WHERE NOT EXISTS (SELECT 1 FROM fx_processed p WHERE p.org_unit IS NOT NULL
      AND p.dataset = t.dataset AND p.period = t.period AND p.org_unit = t.org_unit)"""),
    ("bulk", """SELECT dataSet AS dataset, period, organisationUnit AS org_unit, arg_min(date, row_id) AS date,
      arg_min(completed, row_id) AS completed, min(row_id) AS row_id
      FROM regs GROUP BY dataSet, period, organisationUnit"""),
    ("fetched", f"""SELECT dataSet AS dataset, period, organisationUnit AS org_unit, arg_min(date, row_id) AS date,
      arg_min(completed, row_id) AS completed, min(row_id) AS row_id
      FROM fx_completions WHERE dataSet IN ({_DS_SQL}) GROUP BY dataSet, period, organisationUnit"""),
    # One unit (dataset, period, org unit) at a time: the bulk table if it has the unit, else the unit's own fetch.
    ("with_status", """SELECT t.dataset, t.period, t.org_unit, b.date, b.completed, b.row_id
      FROM todo_now t JOIN bulk b USING (dataset, period, org_unit)
      UNION ALL
      SELECT t.dataset, t.period, t.org_unit, f.date, f.completed, f.row_id
      FROM todo_now t JOIN fetched f USING (dataset, period, org_unit)
      WHERE NOT EXISTS (SELECT 1 FROM bulk b WHERE b.dataset = t.dataset AND b.period = t.period
                        AND b.org_unit = t.org_unit)"""),
    ("payloads", f"""SELECT w.dataset, w.period, w.org_unit, pr.target_dataset,
      '{{"completeDataSetRegistrations":[{{"organisationUnit":"' || w.org_unit || '","period":"' || w.period
      || '","completed":' || CASE WHEN w.completed THEN 'true' ELSE 'false' END || ',"date":"' || w.date
      || '","dataSet":"' || pr.target_dataset || '"}}]}}' AS payload
      FROM with_status w JOIN {_PAIRS_SQL} ON pr.source_dataset = w.dataset"""),
    ("resp", """SELECT p.dataset, p.period, p.org_unit, CASE WHEN r.batch_id % 8 = 4 THEN '{ }' ELSE r.body END AS body
      FROM payloads p JOIN fx_import_reports r ON 'C' || CAST(r.batch_id AS VARCHAR) = p.org_unit"""),
    ("outcomes", """SELECT dataset, period, org_unit, status, outcome,
      CASE WHEN outcome = 'no_json' THEN 1 WHEN outcome = 'conflict' THEN n_conf ELSE 0 END AS push_errors, """
     + ", ".join(f"CASE WHEN outcome IN ('conflict', 'ok') THEN coalesce(CAST(json_extract(body, '$.importCount.{k}')"
                 f" AS BIGINT), 0) ELSE 0 END AS {k}" for k in COUNT_KEYS) + """
      FROM (SELECT *, CASE WHEN NOT json_valid(body) OR body = '{ }' THEN 'no_json'
                           WHEN status IN ('ERROR', 'WARNING') OR n_conf > 0 THEN 'conflict'
                           WHEN status = 'SUCCESS' THEN 'ok' ELSE 'other' END AS outcome
            FROM (SELECT *, CASE WHEN json_valid(body) THEN json_extract_string(body, '$.status') END AS status,
                         CAST(CASE WHEN json_valid(body) THEN coalesce(json_array_length(body, '$.conflicts'), 0)
                              ELSE 0 END AS INTEGER) AS n_conf FROM resp) a) b"""),
]


def _oracle(body: str, upto: str) -> str:
    names = [n for n, _ in _CTES]
    return fixtures.with_views(VIEWS, body, _CTES[:names.index(upto) + 1])


def _registrations(spark, sf_dir):
    """Completion registrations dumped as JSON (the API shape) and read back
    with the fixed schema; the ordinal travels along as a column."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/completions-{uuid.uuid4().hex}"
    spark.table("fx_completions").write.json(path)
    return io.scan_completions(spark, path, schema=COMPLETION_WITH_ORDINAL)


def _inputs(spark, sf_dir):
    fixtures.register(spark, sf_dir, VIEWS)
    units = spark.table("fx_pyramid_source")
    regs = completions_under(_registrations(spark, sf_dir).where(F.col("dataSet").isin(*[s for s, _ in PAIRS])),
                             units, PARENTS)
    todo = (spark.table("fx_data_values").where(F.col("orgUnit").isNotNull())
            .select(F.explode(F.array(*[F.lit(s) for s, _ in PAIRS])).alias("dataset"),
                    F.substring("period", 1, 4).alias("period"), F.col("orgUnit").alias("org_unit")).distinct())
    pairs = config_dim(spark, PAIRS, DATASET_PAIR)
    return regs, todo, spark.table("fx_processed"), pairs


def _direct(spark):
    """All registrations of the synchronised datasets (the per-unit fetch)."""
    return spark.table("fx_completions").where(F.col("dataSet").isin(*[s for s, _ in PAIRS]))


def _stored(df, path):
    """``df`` written as Parquet and read back: computed once, and no later filter reaches what it is made of."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


PERIOD = "1995"


@query("a8_scan_completions", _oracle(f"SELECT * FROM regs WHERE dataSet = 'DS1' AND period = '{PERIOD}'", "regs"))
def q_a8(spark, sf_dir):
    fixtures.register(spark, sf_dir, VIEWS)
    return completions_under(_registrations(spark, sf_dir), spark.table("fx_pyramid_source"), PARENTS,
                             dataset="DS1", period=PERIOD)


@query("c12_unprocessed_org_units", _oracle("SELECT * FROM todo_now", "todo_now"))
def q_c12(spark, sf_dir):
    _, todo, ledger, _ = _inputs(spark, sf_dir)
    return unprocessed_org_units(todo, ledger)


@query("c13_completion_lookup", _oracle("SELECT * FROM with_status", "with_status"))
def q_c13(spark, sf_dir):
    regs, todo, ledger, _ = _inputs(spark, sf_dir)
    with_status, _ = completion_lookup(unprocessed_org_units(todo, ledger), regs, "row_id", _direct(spark))
    return with_status.select("dataset", "period", "org_unit", "date", "completed", "row_id")


def _payloads(spark, sf_dir, inputs=None):
    regs, todo, ledger, pairs = inputs or _inputs(spark, sf_dir)
    with_status, _ = completion_lookup(unprocessed_org_units(todo, ledger), regs, "row_id", _direct(spark))
    return completion_payload(with_status, pairs)


@query("j4_completion_payload", _oracle("SELECT * FROM payloads", "payloads"))
def q_j4(spark, sf_dir):
    return _payloads(spark, sf_dir)


def _outcomes(spark, sf_dir, inputs=None):
    p = _payloads(spark, sf_dir, inputs)
    rep = spark.table("fx_import_reports")
    resp = p.join(rep, F.concat(F.lit("C"), F.col("batch_id").cast("string")) == F.col("org_unit"), "inner")
    # Some answers are empty: no error in the JSON, but no answer either.
    body = F.when(F.col("batch_id") % 8 == 4, "{ }").otherwise(F.col("body"))
    return completion_outcome(resp.select("dataset", "period", "org_unit", body.alias("body")),
                              keep=["dataset", "period", "org_unit"])


@query("j8_completion_outcome", _oracle("SELECT * FROM outcomes", "outcomes"))
def q_j8(spark, sf_dir):
    return _outcomes(spark, sf_dir)


@query("d6_completion_summary", _oracle("SELECT dataset, " + ", ".join(
    f"CAST(sum({k}) AS BIGINT) AS {k}" for k in COUNT_KEYS) + ", CAST(sum(push_errors) AS BIGINT) AS push_errors, "
    "count(*) AS n_responses, count(*) FILTER (WHERE outcome = 'ok') AS n_ok FROM outcomes GROUP BY dataset",
    "outcomes"))
def q_d6(spark, sf_dir):
    return completion_summary(_outcomes(spark, sf_dir), by=["dataset"])


@query("g3_merge_ledger", _oracle("SELECT DISTINCT dataset, period, org_unit FROM todo_now", "todo_now"))
def q_g3(spark, sf_dir):
    _, todo, ledger, _ = _inputs(spark, sf_dir)
    return merge_ledger(ledger, unprocessed_org_units(todo, ledger))


_K4 = [("sent", "SELECT * FROM payloads"),
       ("ok", "SELECT DISTINCT dataset, period, org_unit FROM outcomes WHERE outcome = 'ok'"),
       ("none", """SELECT t.* FROM todo_now t WHERE NOT EXISTS (SELECT 1 FROM with_status w
          WHERE w.dataset = t.dataset AND w.period = t.period AND w.org_unit = t.org_unit)"""),
       ("done", """SELECT dataset, period, org_unit FROM fx_processed WHERE org_unit IS NOT NULL
          UNION SELECT dataset, period, org_unit FROM none UNION SELECT dataset, period, org_unit FROM ok""")]


@query("k4_resumable_completion_sync", fixtures.with_views(VIEWS, """
SELECT 'first' AS step, dataset, period, org_unit, payload FROM sent
UNION ALL SELECT 'replay', dataset, period, org_unit, payload FROM sent
UNION ALL SELECT 'second', s.dataset, s.period, s.org_unit, s.payload FROM sent s
  WHERE NOT EXISTS (SELECT 1 FROM ok o WHERE o.dataset = s.dataset AND o.period = s.period AND o.org_unit = s.org_unit)
UNION ALL SELECT 'ledger', dataset, period, org_unit, CAST(NULL AS VARCHAR) FROM done""", _CTES + _K4))
def q_k4(spark, sf_dir):
    """A completion sync with a replayed batch and failed pushes. The payloads
    of the first batch, again after its replay, then of the next run over the
    same units (only what failed or had no answer is due), and the ledger."""
    regs, todo, processed, pairs = _inputs(spark, sf_dir)
    base = f"{checkpoint_dir(spark).rstrip('/')}/sync-{uuid.uuid4().hex}"
    regs, todo = _stored(regs, f"{base}/regs"), _stored(todo, f"{base}/todo")
    ledger, out = f"{base}/ledger", f"{base}/out"
    processed.withColumn("batch_id", F.lit(-1).cast("bigint")).write.partitionBy("batch_id").parquet(ledger)
    body = sync_batch(ledger, out, regs, pairs, "row_id", _direct(spark))
    sent = "dataset string, period string, org_unit string, target_dataset string, payload string"

    def payloads(batch, step):
        return _stored(spark.read.schema(sent).parquet(f"{out}/completions/batch_id={batch}").select(
            "dataset", "period", "org_unit", "payload"), f"{base}/{step}")

    body(todo, 0)
    first = payloads(0, "first")
    body(todo, 0)  # as after a failure between the ledger's write and the stream's commit
    replay = payloads(0, "replay")
    answers = _stored(_outcomes(spark, sf_dir, (regs, todo, processed, pairs)), f"{base}/answers")
    record_outcomes(answers, ledger, -2)
    body(todo, 1)
    done = spark.read.schema("dataset string, period string, org_unit string").parquet(ledger).where(
        "org_unit is not null").select("dataset", "period", "org_unit").distinct()
    out_rows = first.withColumn("step", F.lit("first"))
    for name, rows in (("replay", replay), ("second", payloads(1, "second")),
                       ("ledger", done.withColumn("payload", F.lit(None).cast("string")))):
        out_rows = out_rows.unionByName(rows.withColumn("step", F.lit(name)))
    return out_rows.select("step", "dataset", "period", "org_unit", "payload")
