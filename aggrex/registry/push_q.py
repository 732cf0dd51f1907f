"""Push slice: normalise -> map -> classify -> order -> batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aggrex import fixtures
from aggrex.operators.dims import config_dim
from aggrex.operators.mapping import map_uids
from aggrex.operators.normalise import normalise_data_values, select_push_columns
from aggrex.operators.push import (class_counts, classify_data_points, data_point_json,
                                   payload_batches, quarantine_report, sort_by_org_unit)
from aggrex.registry import query
from aggrex.schemas import UID_MAPPING

# Fixture configuration: data element mapping (DE3 -> DE1 checks that mapping
# is simultaneous: DE3 must not go on to NDE1) and option combo defaults (the
# coc default is itself mapped).
UID_ROWS = [
    ("dx_uid", "DE1", "NDE1"), ("dx_uid", "DE2", "NDE2"), ("dx_uid", "DE3", "DE1"),
    ("category_option_combo", "COCF", "NCOCF"), ("category_option_combo", "COCX", "NCOCX"),
    ("attribute_option_combo", "AOC1", "NAOC1"),
]
UID_DEFAULTS = {"category_option_combo": "COCX", "attribute_option_combo": "AOC0"}
MAX_POST = 100

UID_VALUES_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in UID_ROWS) + \
    ") AS m(field, old_uid, new_uid)"

_MAPPED_SQL = f"""
dv AS (
  SELECT 'DATA_ELEMENT' AS data_type, dataElement AS dx_uid, period, orgUnit AS org_unit,
         categoryOptionCombo AS category_option_combo, attributeOptionCombo AS attribute_option_combo,
         CAST(NULL AS VARCHAR) AS rate_type, 'AGGREGATED' AS domain_type, value, row_id
  FROM fx_data_values),
m AS (SELECT * FROM {UID_VALUES_SQL}),
mapped AS (
  SELECT dv.data_type, coalesce(m1.new_uid, dv.dx_uid) AS dx_uid, dv.period, dv.org_unit,
         coalesce(m2.new_uid, coalesce(dv.category_option_combo, 'COCX')) AS category_option_combo,
         coalesce(m3.new_uid, coalesce(dv.attribute_option_combo, 'AOC0')) AS attribute_option_combo,
         dv.rate_type, dv.domain_type, dv.value, dv.row_id
  FROM dv
  LEFT JOIN m m1 ON m1.field = 'dx_uid' AND m1.old_uid = dv.dx_uid
  LEFT JOIN m m2 ON m2.field = 'category_option_combo' AND m2.old_uid = coalesce(dv.category_option_combo, 'COCX')
  LEFT JOIN m m3 ON m3.field = 'attribute_option_combo' AND m3.old_uid = coalesce(dv.attribute_option_combo, 'AOC0')),
cls AS (
  SELECT *, CASE
      WHEN dx_uid IS NOT NULL AND period IS NOT NULL AND org_unit IS NOT NULL AND category_option_combo IS NOT NULL
           AND attribute_option_combo IS NOT NULL AND value IS NOT NULL THEN 'valid'
      WHEN dx_uid IS NOT NULL AND period IS NOT NULL AND org_unit IS NOT NULL AND category_option_combo IS NOT NULL
           AND attribute_option_combo IS NOT NULL THEN 'to_delete'
      ELSE 'invalid' END AS class,
    concat_ws(',', CASE WHEN dx_uid IS NULL THEN 'dx_uid' END, CASE WHEN period IS NULL THEN 'period' END,
      CASE WHEN org_unit IS NULL THEN 'org_unit' END,
      CASE WHEN category_option_combo IS NULL THEN 'category_option_combo' END,
      CASE WHEN attribute_option_combo IS NULL THEN 'attribute_option_combo' END,
      CASE WHEN value IS NULL THEN 'value' END) AS missing
  FROM mapped),
js AS (
  SELECT *, CASE class
      WHEN 'valid' THEN '{{"dataElement":"' || dx_uid || '","period":"' || period || '","orgUnit":"' || org_unit
        || '","categoryOptionCombo":"' || category_option_combo || '","attributeOptionCombo":"'
        || attribute_option_combo || '","value":"' || value || '"}}'
      WHEN 'to_delete' THEN '{{"dataElement":"' || dx_uid || '","period":"' || period || '","orgUnit":"' || org_unit
        || '","categoryOptionCombo":"' || category_option_combo || '","attributeOptionCombo":"'
        || attribute_option_combo || '","value":"","comment":"deleted value"}}'
    END AS payload
  FROM cls)"""

_ORDER_SQL = ("org_unit NULLS FIRST, dx_uid NULLS FIRST, period NULLS FIRST, category_option_combo NULLS FIRST, "
              "attribute_option_combo NULLS FIRST, value NULLS FIRST, row_id")


def _oracle(body: str, more_ctes: str = "") -> str:
    head = fixtures.with_views(["fx_data_values"], "").rstrip()
    return head + "," + _MAPPED_SQL + more_ctes + "\n" + body


def mapped_data_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_data_values -> B1 -> C5/C6."""
    raw = fixtures.view(spark, sf_dir, "fx_data_values")
    mapping = config_dim(spark, UID_ROWS, UID_MAPPING)
    return map_uids(normalise_data_values(raw, carry=["row_id"]), mapping, UID_DEFAULTS)


@query("b1_normalise_data_values", fixtures.with_views(["fx_data_values"], """
SELECT 'DATA_ELEMENT' AS data_type, dataElement AS dx_uid, period, orgUnit AS org_unit,
       categoryOptionCombo AS category_option_combo, attributeOptionCombo AS attribute_option_combo,
       CAST(NULL AS VARCHAR) AS rate_type, 'AGGREGATED' AS domain_type, value, row_id
FROM fx_data_values"""))
def q_b1(spark, sf_dir):
    return normalise_data_values(fixtures.view(spark, sf_dir, "fx_data_values"), carry=["row_id"])


@query("c5_c6_map_uids", _oracle("SELECT data_type, dx_uid, period, org_unit, category_option_combo, "
                                 "attribute_option_combo, rate_type, domain_type, value, row_id FROM mapped"))
def q_c5_c6(spark, sf_dir):
    return mapped_data_points(spark, sf_dir)


@query("b7_select_push_columns", _oracle(
    "SELECT dx_uid, period, org_unit, category_option_combo, attribute_option_combo, value, row_id FROM mapped"))
def q_b7(spark, sf_dir):
    return select_push_columns(mapped_data_points(spark, sf_dir), carry=["row_id"])


@query("i1_classify_data_points", _oracle(
    "SELECT dx_uid, period, org_unit, category_option_combo, attribute_option_combo, value, row_id, class, "
    "missing FROM cls"))
def q_i1(spark, sf_dir):
    c = classify_data_points(select_push_columns(mapped_data_points(spark, sf_dir), carry=["row_id"]))
    return c.withColumn("missing", F.array_join("missing", ","))


@query("d2_data_point_class_counts", _oracle(
    "SELECT period, class, count(*) AS n FROM cls GROUP BY period, class"))
def q_d2(spark, sf_dir):
    return class_counts(classify_data_points(mapped_data_points(spark, sf_dir)), by=["period"])


@query("i2_quarantine_report", _oracle(
    "SELECT dx_uid, period, org_unit, category_option_combo, attribute_option_combo, value, row_id, class, "
    "missing, row_number() OVER (PARTITION BY class ORDER BY " + _ORDER_SQL + ") AS line_no "
    "FROM cls WHERE class IN ('invalid', 'to_delete')"))
def q_i2(spark, sf_dir):
    c = classify_data_points(select_push_columns(mapped_data_points(spark, sf_dir), carry=["row_id"]))
    order = ["org_unit", "dx_uid", "period", "category_option_combo", "attribute_option_combo", "value", "row_id"]
    return quarantine_report(c, order=order)


@query("j1_data_point_json", _oracle(
    "SELECT row_id, class, payload FROM js"))
def q_j1(spark, sf_dir):
    c = classify_data_points(select_push_columns(mapped_data_points(spark, sf_dir), carry=["row_id"]))
    return data_point_json(c).select("row_id", "class", "payload")


@query("f1_sort_by_org_unit", _oracle(
    "SELECT dx_uid, period, org_unit, category_option_combo, attribute_option_combo, value, row_id, "
    "row_number() OVER (ORDER BY " + _ORDER_SQL + ") - 1 AS seq FROM mapped"))
def q_f1(spark, sf_dir):
    df = select_push_columns(mapped_data_points(spark, sf_dir), carry=["row_id"])
    return sort_by_org_unit(df, tie_break="row_id")


@query("j2_payload_batches", _oracle(f"""
SELECT class AS phase, phase_order, period, CAST(pos // {MAX_POST} AS BIGINT) AS batch_no, count(*) AS n_points,
       arg_min(org_unit, pos) AS first_org_unit, arg_max(org_unit, pos) AS last_org_unit,
       '{{"dataValues":[' || string_agg(payload, ',' ORDER BY pos) || ']}}' AS body
FROM ranked GROUP BY class, phase_order, period, CAST(pos // {MAX_POST} AS BIGINT)""", f"""
, ranked AS (
  SELECT *, CASE class WHEN 'valid' THEN 0 ELSE 1 END AS phase_order,
         row_number() OVER (PARTITION BY CASE class WHEN 'valid' THEN 0 ELSE 1 END, period
                            ORDER BY {_ORDER_SQL}) - 1 AS pos
  FROM js WHERE class IN ('valid', 'to_delete'))"""))
def q_j2(spark, sf_dir):
    c = classify_data_points(select_push_columns(mapped_data_points(spark, sf_dir), carry=["row_id"]))
    return payload_batches(c, max_post=MAX_POST, generation="gen2", tie_break="row_id")


@query("j2_payload_batches_gen1", _oracle(f"""
SELECT class AS phase, phase_order, period, CAST(pos // {MAX_POST} AS BIGINT) AS batch_no, count(*) AS n_points,
       arg_min(org_unit, pos) AS first_org_unit, arg_max(org_unit, pos) AS last_org_unit,
       '{{"dataValues":[' || string_agg(payload, ',' ORDER BY pos) || ']}}' AS body
FROM ranked GROUP BY class, phase_order, period, CAST(pos // {MAX_POST} AS BIGINT)""", f"""
, ranked AS (
  SELECT *, CASE class WHEN 'to_delete' THEN 0 ELSE 1 END AS phase_order,
         row_number() OVER (PARTITION BY class, period ORDER BY {_ORDER_SQL}) - 1 AS pos
  FROM js WHERE class IN ('valid', 'to_delete'))"""))
def q_j2_gen1(spark, sf_dir):
    """First generation: deletions are sent before values."""
    c = classify_data_points(select_push_columns(mapped_data_points(spark, sf_dir), carry=["row_id"]))
    return payload_batches(c, max_post=MAX_POST, generation="gen1", tie_break="row_id")
