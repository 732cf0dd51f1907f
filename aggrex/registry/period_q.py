"""Period functions over periods and dates taken from the tables (H1-H8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aggrex import fixtures
from aggrex.functions import periods as P
from aggrex.registry import query


def _orders(spark, sf_dir):
    fixtures.register_base_tables(spark, sf_dir)
    return spark.table("orders")


@query("h1_month_range", """
WITH per AS (
  SELECT o_custkey, min(strftime(o_orderdate, '%Y%m')) AS s, max(strftime(o_orderdate, '%Y%m')) AS e
  FROM orders GROUP BY o_custkey),
ex AS (
  SELECT o_custkey, unnest(generate_series(strptime(s, '%Y%m'), strptime(e, '%Y%m'), INTERVAL 1 MONTH)) AS d
  FROM per)
SELECT o_custkey, strftime(d, '%Y%m') AS month FROM ex""")
def q_h1(spark, sf_dir):
    per = _orders(spark, sf_dir).groupBy("o_custkey").agg(
        F.min(P.month_label("o_orderdate")).alias("s"), F.max(P.month_label("o_orderdate")).alias("e"))
    return per.select("o_custkey", F.explode(P.month_range("s", "e")).alias("month"))


@query("h2_month_window_defaults", """
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate) - INTERVAL 6 MONTH, '%Y%m') AS start_month,
       strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y%m') AS end_month
FROM orders""")
def q_h2(spark, sf_dir):
    w = P.month_window_defaults(F.col("o_orderdate"), 6)
    return _orders(spark, sf_dir).select("o_orderkey", w["start"].alias("start_month"), w["end"].alias("end_month"))


@query("h3_validate_yyyymm", fixtures.with_views(["fx_data_values"], """
SELECT src, id, p, coalesce(length(p) = 6 AND TRY_CAST(substr(p, 5, 2) AS INTEGER) BETWEEN 1 AND 12, false)
       AS is_valid
FROM (SELECT 'period' AS src, row_id AS id, period AS p FROM fx_data_values
      UNION ALL SELECT 'key', o_orderkey, CAST(o_orderkey * 37 AS VARCHAR) FROM orders) c"""))
def q_h3(spark, sf_dir):
    dv = fixtures.view(spark, sf_dir, "fx_data_values")
    cands = dv.select(F.lit("period").alias("src"), F.col("row_id").alias("id"), F.col("period").alias("p")) \
        .unionByName(spark.table("orders").select(F.lit("key").alias("src"), F.col("o_orderkey").alias("id"),
                                                  (F.col("o_orderkey") * 37).cast("string").alias("p")))
    return cands.withColumn("is_valid", P.is_valid_yyyymm("p"))


@query("h4_weeks_of_month", fixtures.with_views(["fx_data_values"], """
SELECT month, CAST(isoyear(d) AS VARCHAR) || 'W' || CAST(week(d) AS VARCHAR) AS week
FROM (SELECT month, unnest(generate_series(date_trunc('week', strptime(month, '%Y%m')),
                                          CAST(last_day(strptime(month, '%Y%m')) AS TIMESTAMP),
                                          INTERVAL 7 DAY)) AS d
      FROM (SELECT DISTINCT period AS month FROM fx_data_values) m) w"""))
def q_h4(spark, sf_dir):
    months = fixtures.view(spark, sf_dir, "fx_data_values").select(F.col("period").alias("month")).distinct()
    return months.select("month", F.explode(P.weeks_of_month("month")).alias("week"))


_FREQ_SQL = "CASE dataElement WHEN 'DE1' THEN 'weekly' WHEN 'DE3' THEN 'yearly' ELSE 'monthly' END"


@query("h5_periods_for_frequency", fixtures.with_views(["fx_data_values"], f"""
SELECT frequency, month, CAST(isoyear(d) AS VARCHAR) || 'W' || CAST(week(d) AS VARCHAR) AS period
FROM (SELECT frequency, month, unnest(generate_series(date_trunc('week', strptime(month, '%Y%m')),
                                     CAST(last_day(strptime(month, '%Y%m')) AS TIMESTAMP), INTERVAL 7 DAY)) AS d
      FROM (SELECT DISTINCT {_FREQ_SQL} AS frequency, period AS month FROM fx_data_values) x
      WHERE frequency = 'weekly') w
UNION ALL
SELECT frequency, month, month FROM (SELECT DISTINCT {_FREQ_SQL} AS frequency, period AS month FROM fx_data_values) x
WHERE frequency = 'monthly'
UNION ALL
SELECT frequency, month, substr(month, 1, 4) FROM (SELECT DISTINCT {_FREQ_SQL} AS frequency, period AS month
  FROM fx_data_values) x WHERE frequency = 'yearly'"""))
def q_h5(spark, sf_dir):
    dv = fixtures.view(spark, sf_dir, "fx_data_values")
    freq = (F.when(F.col("dataElement") == "DE1", "weekly").when(F.col("dataElement") == "DE3", "yearly")
             .otherwise("monthly"))
    items = dv.select(freq.alias("frequency"), F.col("period").alias("month")).distinct()
    return items.select("frequency", "month", F.explode(P.periods_for_frequency(F.col("frequency"), "month"))
                        .alias("period"))


# Per order: a frequency, a count of periods back and the label, from the order date.
_FREQS = ["WEEKLY", "MONTHLY", "QUARTERLY", "YEARLY"]
_FREQ_OF_KEY = "CASE o_orderkey % 4 WHEN 0 THEN 'WEEKLY' WHEN 1 THEN 'MONTHLY' WHEN 2 THEN 'QUARTERLY' ELSE 'YEARLY' END"

_SHIFT_SQL = """CASE f WHEN 'WEEKLY' THEN CAST(as_of AS DATE) - CAST(7 * {k} AS INTEGER)
     WHEN 'MONTHLY' THEN CAST(CAST(as_of AS DATE) - to_months(CAST({k} AS INTEGER)) AS DATE)
     WHEN 'QUARTERLY' THEN CAST(CAST(as_of AS DATE) - to_months(CAST(3 * {k} AS INTEGER)) AS DATE)
     ELSE CAST(CAST(as_of AS DATE) - to_months(CAST(12 * {k} AS INTEGER)) AS DATE) END"""
_LABEL_SQL = """CASE f WHEN 'WEEKLY' THEN CAST(isoyear({d}) AS VARCHAR) || 'W' || CAST(week({d}) AS VARCHAR)
     WHEN 'MONTHLY' THEN strftime({d}, '%Y%m')
     WHEN 'QUARTERLY' THEN CAST(year({d}) AS VARCHAR) || 'Q' || CAST(quarter({d}) AS VARCHAR)
     ELSE CAST(year({d}) AS VARCHAR) END"""


def _freq_col():
    return F.element_at(F.array(*[F.lit(f) for f in _FREQS]), (F.col("o_orderkey") % 4 + 1).cast("int"))


@query("h6_period_back", f"""
SELECT o_orderkey, f AS frequency, n, {_LABEL_SQL.format(d='sd')} AS period
FROM (SELECT *, {_SHIFT_SQL.format(k='n')} AS sd
      FROM (SELECT o_orderkey, {_FREQ_OF_KEY} AS f, CAST(o_orderkey % 13 AS INTEGER) AS n, o_orderdate AS as_of
            FROM orders) a) b""")
def q_h6(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", _freq_col().alias("frequency"),
                                      (F.col("o_orderkey") % 13).cast("int").alias("n"), "o_orderdate")
    return o.select("o_orderkey", "frequency", "n",
                    P.period_back(F.col("o_orderdate"), F.col("n"), F.col("frequency")).alias("period"))


_TRUNC_SQL = """CASE f WHEN 'WEEKLY' THEN CAST(date_trunc('week', {d}) AS DATE)
     WHEN 'MONTHLY' THEN CAST(date_trunc('month', {d}) AS DATE)
     WHEN 'QUARTERLY' THEN CAST(date_trunc('quarter', {d}) AS DATE)
     ELSE CAST(date_trunc('year', {d}) AS DATE) END"""


@query("h7_extract_periods", f"""
WITH a AS (
  SELECT o_orderkey, {_FREQ_OF_KEY} AS f, o_orderdate AS as_of,
         CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE 2 + o_orderkey % 3 END AS kb,
         CASE WHEN o_orderkey % 5 = 0 THEN 0 WHEN o_orderkey % 7 = 0 THEN 5 ELSE o_orderkey % 2 END AS ke
  FROM orders),
b AS (SELECT *, {_SHIFT_SQL.format(k='kb')} AS sd, {_SHIFT_SQL.format(k='ke')} AS ed FROM a),
c AS (SELECT *, {_TRUNC_SQL.format(d='sd')} AS s, {_TRUNC_SQL.format(d='ed')} AS e FROM b),
r AS (
  SELECT o_orderkey, f, unnest(CASE WHEN s < e THEN generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP),
      CASE f WHEN 'WEEKLY' THEN INTERVAL 7 DAY WHEN 'MONTHLY' THEN INTERVAL 1 MONTH
             WHEN 'QUARTERLY' THEN INTERVAL 3 MONTH ELSE INTERVAL 12 MONTH END)
      ELSE [CAST(s AS TIMESTAMP)] END) AS d
  FROM c)
SELECT o_orderkey, f AS frequency, {_LABEL_SQL.format(d='d')} AS period FROM r""")
def q_h7(spark, sf_dir):
    k = F.col("o_orderkey")
    o = _orders(spark, sf_dir).select("o_orderkey", _freq_col().alias("frequency"), "o_orderdate")
    start = F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(
        P.period_back(F.col("o_orderdate"), (k % 3 + 2).cast("int"), F.col("frequency")))
    end = (F.when(k % 5 == 0, F.lit(None).cast("string"))
            .when(k % 7 == 0, P.period_back(F.col("o_orderdate"), F.lit(5), F.col("frequency")))
            .otherwise(P.period_back(F.col("o_orderdate"), (k % 2).cast("int"), F.col("frequency"))))
    o = o.withColumns({"start": start, "end": end})
    periods = P.extract_periods("start", "end", F.lit(3), F.col("frequency"), F.col("o_orderdate"))
    return o.select("o_orderkey", "frequency", F.explode(periods).alias("period"))


@query("h8_first_day_of_future_month", fixtures.with_views(["fx_data_values"], """
SELECT row_id, period, CAST(row_id % 5 AS INTEGER) AS n,
       strftime(strptime(period, '%Y%m') + to_months(CAST(row_id % 5 AS INTEGER)), '%Y-%m-01') AS first_day
FROM fx_data_values"""))
def q_h8(spark, sf_dir):
    dv = fixtures.view(spark, sf_dir, "fx_data_values")
    n = (F.col("row_id") % 5).cast("int")
    return dv.select("row_id", "period", n.alias("n"), P.first_day_of_future_month("period", n).alias("first_day"))
