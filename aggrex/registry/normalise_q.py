"""Sources, normalisation and rate mapping over the fixture views
(A1, A2, A7, A9, A10, B2-B4, B12, C7-C9, G1, G2, H9, H10)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from aggrex import fixtures
from aggrex.functions.values import rate_100_to_1, to_number_or_null
from aggrex.operators.dims import config_dim
from aggrex.operators.mapping import (dispatch_by_type, invalid_rate_mappings, map_rates_in_place,
                                      map_rates_per_extract, map_uids)
from aggrex.operators.normalise import (filter_category_option_combos, merge_extracts, normalise_data_values,
                                        normalise_indicators, normalise_rates, union_checked)
from aggrex.operators.push import classify_data_points, payload_batches
from aggrex.registry import query
from aggrex.registry.push_q import UID_DEFAULTS, UID_ROWS, UID_VALUES_SQL
from aggrex.schemas import DATA_POINT_COLUMNS, RATE_MAPPING, UID_MAPPING
from aggrex.session import checkpoint_dir
from aggrex.sources import config as cfg
from aggrex.sources import io

DP = ", ".join(DATA_POINT_COLUMNS)

# Fixture configuration: second-generation rate mappings per extract. Extract
# EXC has none (passes unchanged); ' CC2 ' checks trimming.
RATE_ROWS = [
    ("EXA", "DS0", "REPORTING_RATE", "RDS0", "CC1", "AC1"),
    ("EXA", "DS0", "REPORTING_RATE_ON_TIME", "RDS0T", "CC1", "AC1"),
    ("EXA", "DS1", "REPORTING_RATE", "RDS1", "CC1", "AC1"),
    ("EXA", "DS2", "ACTUAL_REPORTS", "RDS2A", " CC2 ", "AC1"),
    ("EXB", "DS3", "REPORTING_RATE", "RDS3", "CC1", "AC2"),
    ("EXB", "DS3", "EXPECTED_REPORTS", "RDS3E", "CC3", "AC2"),
]
# First-generation rate mappings (no extract).
RATE_ROWS_GEN1 = [
    (None, "DS0", "REPORTING_RATE_ON_TIME", "G1DS0", "CC1", "AC1"),
    (None, "DS1", "REPORTING_RATE", "G1DS1", "CC1", "AC1"),
    (None, "DS4", "EXPECTED_REPORTS", "G1DS4", "CC4", "AC4"),
]
# Mappings with holes: DS4 lacks the aoc and is in the data; DS9 is not.
RATE_ROWS_BAD = RATE_ROWS + [
    ("EXC", "DS4", "ACTUAL_REPORTS", "RDS4", "CC1", None),
    ("EXC", "DS9", "REPORTING_RATE", None, "CC1", "AC1"),
]
# Category option combos kept per item (item = data element); other items unfiltered.
COC_ROWS = [("DE1", "COCF"), ("DE1", "COCO"), ("DE2", "COCP")]


def _values(rows, names) -> str:
    def lit(v):
        return "NULL" if v is None else "'" + v + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + \
        f") AS t({', '.join(names)})"


RATE_COLS = ["extract_id", "dx_uid", "rate_type", "uid", "cat_option_combo", "attr_option_combo"]
_EXTRACT_OF_DX_SQL = ("CASE WHEN dx_uid IN ('DS0', 'DS1', 'DS2') THEN 'EXA' WHEN dx_uid = 'DS3' THEN 'EXB' "
                      "ELSE 'EXC' END")
_NUM_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_NUM_SQL = ("CASE WHEN {v} IS NOT NULL AND regexp_matches({v}, '" + _NUM_RE + "') "
            "THEN TRY_CAST(trim({v}) AS DOUBLE) END")

_RATES_CTE = f"""
rates AS (
  SELECT 'REPORTING_RATE' AS data_type, string_split(dx, '.')[1] AS dx_uid, pe AS period, ou AS org_unit,
         CAST(NULL AS VARCHAR) AS category_option_combo, CAST(NULL AS VARCHAR) AS attribute_option_combo,
         string_split(dx, '.')[2] AS rate_type, 'AGGREGATED' AS domain_type, value, row_id
  FROM fx_analytics),
rx AS (SELECT *, {_EXTRACT_OF_DX_SQL} AS extract_id FROM rates)"""


def _rates_sql(body: str, extra: str = "", views: tuple = ("fx_analytics",)) -> str:
    head = fixtures.with_views(list(views), "").rstrip()
    return head + "," + _RATES_CTE + extra + "\n" + body


def rates(spark, sf_dir):
    """fx_analytics -> A7 -> B2, with the extract each dataset belongs to."""
    raw = io.rename_analytics(fixtures.view(spark, sf_dir, "fx_analytics"))
    r = normalise_rates(raw, carry=["row_id"])
    ex = (F.when(F.col("dx_uid").isin("DS0", "DS1", "DS2"), "EXA").when(F.col("dx_uid") == "DS3", "EXB")
           .otherwise("EXC"))
    return r.withColumn("extract_id", ex)


def _scratch(spark, tag: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- A-series

@query("a6_scan_data_values", fixtures.with_views(["fx_data_values"], """
SELECT 'DATA_ELEMENT' AS data_type, dataElement AS dx_uid, period, orgUnit AS org_unit,
       categoryOptionCombo AS category_option_combo, attributeOptionCombo AS attribute_option_combo,
       CAST(NULL AS VARCHAR) AS rate_type, 'AGGREGATED' AS domain_type, value FROM fx_data_values"""))
def q_a6(spark, sf_dir):
    """Data value sets dumped as JSON lines (the API response shape), read
    back with the fixed schema and normalised (B1)."""
    path = _scratch(spark, "datavalues")
    fixtures.view(spark, sf_dir, "fx_data_values").drop("row_id").write.json(path)
    return normalise_data_values(io.scan_data_values(spark, path, fmt="json"))


@query("a1_scan_extract", fixtures.with_views(["fx_data_values"], f"""
SELECT 'DATA_ELEMENT' AS data_type, dataElement AS dx_uid, period, orgUnit AS org_unit,
       categoryOptionCombo AS category_option_combo, attributeOptionCombo AS attribute_option_combo,
       CAST(NULL AS VARCHAR) AS rate_type, 'AGGREGATED' AS domain_type, value FROM fx_data_values"""))
def q_a1(spark, sf_dir):
    path = _scratch(spark, "extract")
    normalise_data_values(fixtures.view(spark, sf_dir, "fx_data_values")).write.parquet(path)
    return io.scan_extract(spark, path)


@query("a2_scan_extracts_for_period", fixtures.with_views(["fx_data_values"], """
SELECT 'DATA_ELEMENT' AS data_type, dataElement AS dx_uid, period, orgUnit AS org_unit,
       categoryOptionCombo AS category_option_combo, attributeOptionCombo AS attribute_option_combo,
       CAST(NULL AS VARCHAR) AS rate_type, 'AGGREGATED' AS domain_type, value, period AS extract_period
FROM fx_data_values WHERE period IN ('199601', '199712', '200002')"""))
def q_a2(spark, sf_dir):
    root = _scratch(spark, "extracts")
    dv = normalise_data_values(fixtures.view(spark, sf_dir, "fx_data_values"))
    io.write_extract(dv, root, extract_id="dsA", extract_period=F.col("period"))
    months = spark.createDataFrame([("199601",), ("199712",), ("200002",), ("209901",)], "extract_period string")
    # Each requested period reads only its partition folders; one of them has no extract.
    return io.scan_extracts_for_periods(spark, root, months).select(*DATA_POINT_COLUMNS, "extract_period")


@query("a7_scan_analytics", fixtures.with_views(["fx_analytics"], """
SELECT dx, pe AS period, ou AS orgUnit, CASE WHEN row_id % 3 > 0 THEN 'CO' || CAST(row_id % 3 AS VARCHAR) END
       AS categoryOptionCombo, value FROM fx_analytics"""))
def q_a7(spark, sf_dir):
    """Cells with category option combos, dumped as JSON and read back with the fixed schema."""
    path = _scratch(spark, "analytics")
    _cells_with_combos(spark, sf_dir).select("dx", "pe", "ou", "co", "value").write.json(path)
    return io.scan_analytics(spark, path)


def _cells_with_combos(spark, sf_dir):
    return fixtures.view(spark, sf_dir, "fx_analytics").withColumn(
        "co", F.when(F.col("row_id") % 3 > 0, F.concat(F.lit("CO"), (F.col("row_id") % 3).cast("string"))))


# Fixture configuration file (first-generation push configuration shape).
PUSH_CONFIG_JSON = json.dumps({
    "PUSH_SETTINGS": {"IMPORT_STRATEGY": "CREATE_AND_UPDATE", "DRY_RUN": True, "MAX_POST": 100},
    "DATA_ELEMENT_MAPPINGS": {
        "UIDS": {o: n for f, o, n in UID_ROWS if f == "dx_uid"},
        "CAT_OPTION_COMBOS": {"DEFAULT": UID_DEFAULTS["category_option_combo"],
                              "UIDS": {o: n for f, o, n in UID_ROWS if f == "category_option_combo"}},
        "ATTR_OPTION_COMBOS": {"DEFAULT": UID_DEFAULTS["attribute_option_combo"],
                               "UIDS": {o: n for f, o, n in UID_ROWS if f == "attribute_option_combo"}},
    },
    "RATE_MAPPINGS": {ds: {"RATE_TYPE": rt, "UID": u, "CAT_OPTION_COMBO": c, "ATTR_OPTION_COMBO": a}
                      for _, ds, rt, u, c, a in RATE_ROWS_GEN1},
})


@query("a9_config_dimensions", fixtures.with_views(["fx_data_values"], f"""
SELECT m.field, m.old_uid, m.new_uid, count(d.row_id) AS hits
FROM {UID_VALUES_SQL}
LEFT JOIN (SELECT row_id, dataElement AS dx_uid, coalesce(categoryOptionCombo, 'COCX') AS category_option_combo,
                  coalesce(attributeOptionCombo, 'AOC0') AS attribute_option_combo FROM fx_data_values) d
  ON (m.field = 'dx_uid' AND d.dx_uid = m.old_uid)
  OR (m.field = 'category_option_combo' AND d.category_option_combo = m.old_uid)
  OR (m.field = 'attribute_option_combo' AND d.attribute_option_combo = m.old_uid)
GROUP BY m.field, m.old_uid, m.new_uid"""))
def q_a9(spark, sf_dir):
    dims = cfg.config_dimensions(spark, cfg.load_configuration(PUSH_CONFIG_JSON))
    dv = normalise_data_values(fixtures.view(spark, sf_dir, "fx_data_values"), carry=["row_id"])
    defaults = dims["uid_defaults"]
    for field, default in defaults.items():
        dv = dv.withColumn(field, F.coalesce(F.col(field), F.lit(default)))
    # Long form (field, uid) so that one equi-join covers all three fields.
    long = dv.select("row_id", F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).alias("old_uid"))
        for f in ["dx_uid", "category_option_combo", "attribute_option_combo"]])).alias("u")).select("row_id", "u.*")
    hits = long.groupBy("field", "old_uid").agg(F.count(F.lit(1)).alias("hits"))
    return (dims["uid_mapping"].join(hits, ["field", "old_uid"], "left")
            .select("field", "old_uid", "new_uid", F.coalesce("hits", F.lit(0)).alias("hits")))


@query("a10_write_extract", _rates_sql(f"""
SELECT DISTINCT data_type, extract_id, extract_period FROM (
  SELECT 'DATA_ELEMENT' AS data_type, 'dsA' AS extract_id, period AS extract_period FROM fx_data_values
  UNION ALL SELECT data_type, extract_id, period FROM rx) w""", views=("fx_data_values", "fx_analytics")))
def q_a10(spark, sf_dir):
    root = _scratch(spark, "extracts")
    dv = normalise_data_values(fixtures.view(spark, sf_dir, "fx_data_values"))
    io.write_extract(dv, root, extract_id="dsA", extract_period=F.col("period"))
    r = rates(spark, sf_dir).drop("row_id")
    io.write_extract(r, root, extract_period=F.col("period"))
    return io.read_extract_table(spark, root).select(*io.EXTRACT_PARTITIONS).distinct()


# ---------------------------------------------------------------- B-series

@query("b2_normalise_rates", _rates_sql(f"SELECT {DP}, row_id FROM rates"))
def q_b2(spark, sf_dir):
    raw = io.rename_analytics(fixtures.view(spark, sf_dir, "fx_analytics"))
    return normalise_rates(raw, carry=["row_id"])


@query("b3_normalise_indicators", fixtures.with_views(["fx_analytics"], f"""
SELECT 'INDICATOR' AS data_type, dx AS dx_uid, pe AS period, ou AS org_unit,
       CAST(NULL AS VARCHAR) AS category_option_combo, CAST(NULL AS VARCHAR) AS attribute_option_combo,
       CAST(NULL AS VARCHAR) AS rate_type, 'AGGREGATED' AS domain_type, value, row_id FROM fx_analytics"""))
def q_b3(spark, sf_dir):
    raw = io.rename_analytics(fixtures.view(spark, sf_dir, "fx_analytics"))
    return normalise_indicators(raw, carry=["row_id"])


@query("b3_normalise_indicators_with_combos", fixtures.with_views(["fx_analytics"], """
SELECT 'INDICATOR' AS data_type, dx AS dx_uid, pe AS period, ou AS org_unit,
       CASE WHEN row_id % 3 > 0 THEN 'CO' || CAST(row_id % 3 AS VARCHAR) END AS category_option_combo,
       CAST(NULL AS VARCHAR) AS attribute_option_combo, CAST(NULL AS VARCHAR) AS rate_type,
       'AGGREGATED' AS domain_type, value, row_id FROM fx_analytics"""))
def q_b3_combos(spark, sf_dir):
    raw = io.rename_analytics(_cells_with_combos(spark, sf_dir))
    return normalise_indicators(raw, map_cocs=True, carry=["row_id"])


@query("b4_filter_category_option_combos", fixtures.with_views(["fx_data_values"], f"""
SELECT d.* FROM (SELECT dataElement AS item_id, 'DATA_ELEMENT' AS data_type, dataElement AS dx_uid, period,
                        orgUnit AS org_unit, categoryOptionCombo AS category_option_combo,
                        attributeOptionCombo AS attribute_option_combo, CAST(NULL AS VARCHAR) AS rate_type,
                        'AGGREGATED' AS domain_type, value, row_id FROM fx_data_values) d
WHERE d.item_id NOT IN (SELECT item_id FROM {_values(COC_ROWS, ['item_id', 'coc'])})
   OR EXISTS (SELECT 1 FROM {_values(COC_ROWS, ['item_id', 'coc'])}
              WHERE t.item_id = d.item_id AND t.coc = d.category_option_combo)"""))
def q_b4(spark, sf_dir):
    dv = normalise_data_values(fixtures.view(spark, sf_dir, "fx_data_values"), carry=["row_id"])
    combos = spark.createDataFrame(COC_ROWS, "item_id string, coc string")
    return filter_category_option_combos(dv.withColumn("item_id", F.col("dx_uid")), combos)


def _gen1_rate_sql(src: str) -> str:
    m = _values(RATE_ROWS_GEN1, RATE_COLS)
    return f"""
SELECT r.data_type, CASE WHEN t.dx_uid IS NOT NULL THEN trim(t.uid) ELSE r.dx_uid END AS dx_uid, r.period,
       r.org_unit,
       CASE WHEN t.dx_uid IS NOT NULL THEN trim(t.cat_option_combo) ELSE r.category_option_combo END
         AS category_option_combo,
       CASE WHEN t.dx_uid IS NOT NULL THEN trim(t.attr_option_combo) ELSE r.attribute_option_combo END
         AS attribute_option_combo,
       r.rate_type, r.domain_type, r.value, r.row_id
FROM {src} r LEFT JOIN {m} ON t.dx_uid = r.dx_uid AND t.rate_type = r.rate_type
  AND r.data_type = 'REPORTING_RATE'"""


@query("c7_map_rates_in_place", _rates_sql(_gen1_rate_sql("rates")))
def q_c7(spark, sf_dir):
    r = rates(spark, sf_dir).drop("extract_id")
    return map_rates_in_place(r, config_dim(spark, RATE_ROWS_GEN1, RATE_MAPPING))


_C8_CTE = f""",
mapped AS (
  SELECT r.data_type, trim(t.uid) AS dx_uid, r.period, r.org_unit, trim(t.cat_option_combo) AS category_option_combo,
         trim(t.attr_option_combo) AS attribute_option_combo, r.rate_type, r.domain_type, r.value, r.row_id,
         r.extract_id
  FROM rx r JOIN {_values(RATE_ROWS, RATE_COLS)} ON t.extract_id = r.extract_id AND t.dx_uid = r.dx_uid
    AND t.rate_type = r.rate_type
  UNION ALL
  SELECT data_type, dx_uid, period, org_unit, category_option_combo, attribute_option_combo, rate_type, domain_type,
         value, row_id, extract_id
  FROM rx WHERE extract_id NOT IN (SELECT DISTINCT extract_id FROM {_values(RATE_ROWS, RATE_COLS)})),
numbered AS (SELECT *, {_NUM_SQL.format(v='value')} AS num FROM mapped)"""

_C8_SELECT = f"""
SELECT data_type, dx_uid, period, org_unit, category_option_combo, attribute_option_combo, rate_type, domain_type,
       CASE WHEN extract_id <> 'EXC' AND rate_type = 'REPORTING_RATE' AND num = 100 THEN '1' ELSE value END AS value,
       row_id, extract_id,
       CASE WHEN extract_id <> 'EXC' AND rate_type = 'REPORTING_RATE' AND num = 100 THEN 1.0 ELSE num END
         AS value_num
FROM numbered"""


@query("c8_map_rates_per_extract", _rates_sql(_C8_SELECT, _C8_CTE))
def q_c8(spark, sf_dir):
    return map_rates_per_extract(rates(spark, sf_dir), config_dim(spark, RATE_ROWS, RATE_MAPPING))


@query("c9_validate_mappings", _rates_sql(f"""
SELECT t.*, concat_ws(',', CASE WHEN uid IS NULL THEN 'UID' END,
                      CASE WHEN cat_option_combo IS NULL THEN 'CAT_OPTION_COMBO' END,
                      CASE WHEN attr_option_combo IS NULL THEN 'ATTR_OPTION_COMBO' END) AS missing
FROM {_values(RATE_ROWS_BAD, RATE_COLS)}
WHERE (uid IS NULL OR cat_option_combo IS NULL OR attr_option_combo IS NULL)
  AND t.dx_uid IN (SELECT dx_uid FROM rates)"""))
def q_c9(spark, sf_dir):
    return invalid_rate_mappings(config_dim(spark, RATE_ROWS_BAD, RATE_MAPPING), rates(spark, sf_dir))


def _b12_oracle() -> str:
    from aggrex.registry.push_q import _MAPPED_SQL
    head = fixtures.with_views(["fx_data_values", "fx_analytics"], "").rstrip()
    rates_dot = _gen1_rate_sql("(SELECT * FROM rates WHERE dx_uid IN (SELECT string_split(dx, '.')[1] FROM "
                               "fx_analytics) AND row_id IN (SELECT row_id FROM fx_analytics WHERE dx LIKE '%.%'))")
    body = f"""
SELECT data_type, dx_uid, period, org_unit, category_option_combo, attribute_option_combo, rate_type, domain_type,
       value, row_id FROM mapped
UNION ALL {rates_dot}
UNION ALL
SELECT 'UNHANDLED', dx, pe, ou, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 'AGGREGATED',
       value, row_id FROM fx_analytics WHERE dx NOT LIKE '%.%'"""
    return head + "," + _MAPPED_SQL + "," + _RATES_CTE + "\n" + body


@query("b12_dispatch_by_type", _b12_oracle())
def q_b12(spark, sf_dir):
    dv = normalise_data_values(fixtures.view(spark, sf_dir, "fx_data_values"), carry=["row_id"])
    raw = io.rename_analytics(fixtures.view(spark, sf_dir, "fx_analytics"))
    r = normalise_rates(raw.where(F.col("dx").contains(".")), carry=["row_id"])
    ind = normalise_indicators(raw.where(~F.col("dx").contains(".")), carry=["row_id"])
    mixed = union_checked([dv, r, ind])
    uid_dim = config_dim(spark, UID_ROWS, UID_MAPPING)
    rate_dim = config_dim(spark, RATE_ROWS_GEN1, RATE_MAPPING)
    handled, unknown = dispatch_by_type(mixed, {
        "DATA_ELEMENT": lambda d: map_uids(d, uid_dim, UID_DEFAULTS),
        "REPORTING_RATE": lambda d: map_rates_in_place(d, rate_dim),
    })
    return handled.unionByName(unknown.withColumn("data_type", F.lit("UNHANDLED")))


# ---------------------------------------------------------------- G / H

@query("g1_union_checked", _rates_sql(f"""
SELECT {DP}, row_id FROM rates
UNION ALL
SELECT 'DATA_ELEMENT', dataElement, period, orgUnit, categoryOptionCombo, attributeOptionCombo,
       CAST(NULL AS VARCHAR), 'AGGREGATED', value, row_id FROM fx_data_values""",
    views=("fx_data_values", "fx_analytics")))
def q_g1(spark, sf_dir):
    dv = normalise_data_values(fixtures.view(spark, sf_dir, "fx_data_values"), carry=["row_id"])
    raw = io.rename_analytics(fixtures.view(spark, sf_dir, "fx_analytics"))
    return union_checked([normalise_rates(raw, carry=["row_id"]), None, dv])


@query("g2_merge_extracts", fixtures.with_views(["fx_data_values"], f"""
SELECT DISTINCT m.merge_month, {', '.join('ex.' + c for c in DATA_POINT_COLUMNS)}
FROM ex JOIN months m ON ex.extract_period = m.merge_month OR ex.extract_period = substr(m.merge_month, 1, 4)""",
    [("dv", """SELECT 'DATA_ELEMENT' AS data_type, dataElement AS dx_uid, period, orgUnit AS org_unit,
         categoryOptionCombo AS category_option_combo, attributeOptionCombo AS attribute_option_combo,
         CAST(NULL AS VARCHAR) AS rate_type, 'AGGREGATED' AS domain_type, value FROM fx_data_values"""),
     ("ex", """SELECT *, period AS extract_period FROM dv
       UNION ALL SELECT data_type, dx_uid, substr(period, 1, 4), org_unit, category_option_combo,
                        attribute_option_combo, rate_type, domain_type, value, substr(period, 1, 4) FROM dv"""),
     ("months", "SELECT DISTINCT period AS merge_month FROM dv")]))
def q_g2(spark, sf_dir):
    dv = normalise_data_values(fixtures.view(spark, sf_dir, "fx_data_values"))
    monthly = dv.withColumn("extract_period", F.col("period"))
    yearly = dv.withColumn("period", F.substring("period", 1, 4)).withColumn("extract_period", F.col("period"))
    months = dv.select(F.col("period").alias("month")).distinct()
    return merge_extracts(monthly.unionByName(yearly), months)


@query("h9_to_number_or_null", fixtures.with_views(["fx_analytics"], f"""
SELECT src, id, v, {_NUM_SQL.format(v='v')} AS num FROM (
  SELECT 'rate' AS src, row_id AS id, value AS v FROM fx_analytics
  UNION ALL SELECT 'priority', o_orderkey, o_orderpriority FROM orders
  UNION ALL SELECT 'suffix_d', o_orderkey, CAST(o_custkey AS VARCHAR) || 'd' FROM orders
  UNION ALL SELECT 'padded', o_orderkey, ' ' || CAST(o_orderkey AS VARCHAR) || ' ' FROM orders
  UNION ALL SELECT 'sci', o_orderkey, CAST(o_orderkey % 97 AS VARCHAR) || 'e' || CAST(o_orderkey % 5 AS VARCHAR)
    FROM orders) c"""))
def q_h9(spark, sf_dir):
    a = fixtures.view(spark, sf_dir, "fx_analytics")
    fixtures.register_base_tables(spark, sf_dir, ["orders"])
    o = spark.table("orders")
    k = F.col("o_orderkey")
    c = (a.select(F.lit("rate").alias("src"), F.col("row_id").alias("id"), F.col("value").alias("v"))
         .unionByName(o.select(F.lit("priority").alias("src"), k.alias("id"), F.col("o_orderpriority").alias("v")))
         .unionByName(o.select(F.lit("suffix_d").alias("src"), k.alias("id"),
                               F.concat(F.col("o_custkey").cast("string"), F.lit("d")).alias("v")))
         .unionByName(o.select(F.lit("padded").alias("src"), k.alias("id"),
                               F.concat(F.lit(" "), k.cast("string"), F.lit(" ")).alias("v")))
         .unionByName(o.select(F.lit("sci").alias("src"), k.alias("id"),
                               F.concat((k % 97).cast("string"), F.lit("e"), (k % 5).cast("string")).alias("v"))))
    return c.withColumn("num", to_number_or_null("v"))


@query("h10_rate_100_to_1", _rates_sql(f"""
SELECT row_id, rate_type, value,
       CASE WHEN rate_type = 'REPORTING_RATE' AND {_NUM_SQL.format(v='value')} = 100 THEN 1.0
            ELSE {_NUM_SQL.format(v='value')} END AS value_num
FROM rates"""))
def q_h10(spark, sf_dir):
    r = rates(spark, sf_dir)
    return r.select("row_id", "rate_type", "value",
                    rate_100_to_1(to_number_or_null("value"), F.col("rate_type")).alias("value_num"))


# ---------------------------------------------------------------- rate push (C8 -> I1 -> J2)

RATE_MAX_POST = 50
_RATE_ORDER = ("org_unit NULLS FIRST, dx_uid NULLS FIRST, period NULLS FIRST, category_option_combo NULLS FIRST, "
               "attribute_option_combo NULLS FIRST, value NULLS FIRST, row_id")
_RATE_PUSH_CTE = _C8_CTE + f""",
c8 AS ({_C8_SELECT}),
rcls AS (
  SELECT *, CASE
      WHEN dx_uid IS NOT NULL AND period IS NOT NULL AND org_unit IS NOT NULL AND category_option_combo IS NOT NULL
           AND attribute_option_combo IS NOT NULL AND value IS NOT NULL AND value_num IS NOT NULL
           AND NOT isnan(value_num) THEN 'valid'
      WHEN dx_uid IS NOT NULL AND period IS NOT NULL AND org_unit IS NOT NULL AND category_option_combo IS NOT NULL
           AND attribute_option_combo IS NOT NULL AND value IS NULL THEN 'to_delete'
      ELSE 'invalid' END AS class
  FROM c8),
rjs AS (
  SELECT *, CASE class
      WHEN 'valid' THEN '{{"dataElement":"' || dx_uid || '","period":"' || period || '","orgUnit":"' || org_unit
        || '","categoryOptionCombo":"' || category_option_combo || '","attributeOptionCombo":"'
        || attribute_option_combo || '","value":' || CAST(value_num AS VARCHAR) || '}}'
      WHEN 'to_delete' THEN '{{"dataElement":"' || dx_uid || '","period":"' || period || '","orgUnit":"' || org_unit
        || '","categoryOptionCombo":"' || category_option_combo || '","attributeOptionCombo":"'
        || attribute_option_combo || '","value":"","comment":"deleted value"}}'
    END AS payload
  FROM rcls),
rranked AS (
  SELECT *, CASE class WHEN 'valid' THEN 0 ELSE 1 END AS phase_order,
         row_number() OVER (PARTITION BY CASE class WHEN 'valid' THEN 0 ELSE 1 END, period
                            ORDER BY {_RATE_ORDER}) - 1 AS pos
  FROM rjs WHERE class IN ('valid', 'to_delete'))"""


@query("j2_rate_payload_batches", _rates_sql(f"""
SELECT class AS phase, phase_order, period, CAST(pos // {RATE_MAX_POST} AS BIGINT) AS batch_no, count(*) AS n_points,
       arg_min(org_unit, pos) AS first_org_unit, arg_max(org_unit, pos) AS last_org_unit,
       '{{"dataValues":[' || string_agg(payload, ',' ORDER BY pos) || ']}}' AS body
FROM rranked GROUP BY class, phase_order, period, CAST(pos // {RATE_MAX_POST} AS BIGINT)""", _RATE_PUSH_CTE))
def q_j2_rates(spark, sf_dir):
    """The rate push: per-extract mapping (C8), numeric classification (I1),
    batches with the values as JSON numbers (J2)."""
    mapped = map_rates_per_extract(rates(spark, sf_dir), config_dim(spark, RATE_ROWS, RATE_MAPPING))
    c = classify_data_points(mapped, require_numeric=True)
    return payload_batches(c, max_post=RATE_MAX_POST, tie_break="row_id", value_as_number=True)
