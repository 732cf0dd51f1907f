"""Extraction planning over dataset metadata derived from the tables
(A4, A5, B5, B6, B9, B10, B11, C10, C14)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from aggrex import fixtures
from aggrex.operators.dims import config_dim
from aggrex.plans.extraction import (expand_category_combos, extraction_plan, item_data_elements, item_names,
                                     rate_extraction_plan, rate_keys, rejected_items, rejected_rate_items,
                                     scope_data, scope_org_units, skip_existing, skip_existing_rates)
from aggrex.registry import query
from aggrex.schemas import EXTRACT_ITEM, RATE_ITEM
from aggrex.session import checkpoint_dir
from aggrex.sources import io

# Fixture configuration (first-generation extract items). Item 1's first
# metadata dataset is DS2 (metadata order), item 4 repeats item 0's name,
# item 5 has no dataset.
ITEMS = [
    (0, ["DS1"], ["DE1", "DE2"], "Monthly", ["CC_STATUS"], []),
    (1, ["DS3", "DS2"], [], "Yearly", [], ["COCF"]),
    (2, ["DS1"], ["DE3"], "Weekly", ["CC_STATUS", "CC_MISSING"], ["COCO"]),
    (3, ["DS4", "DS0"], ["DE4"], "Monthly", [], []),
    (4, ["DS1"], [], "Monthly", [], []),
    (5, [], ["DE5"], "Monthly", [], []),
]
# Second-generation rate extracts; the last three are rejected.
RATE_ITEMS = [
    ("EXA", "DS0", ["REPORTING_RATE", "REPORTING_RATE_ON_TIME"], 3, "MONTHLY", None, None),
    ("EXB", "DS3", ["EXPECTED_REPORTS"], 3, "MONTHLY", None, None),
    (None, "DS1", ["REPORTING_RATE"], 3, "MONTHLY", None, None),
    ("EXD", None, ["REPORTING_RATE"], 3, "MONTHLY", None, None),
    ("EXE", "DS2", [], 3, "MONTHLY", None, None),
]
EXISTING_BEFORE = "199801"

VIEWS = ["fx_data_values"]


def _lit_list(xs):
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]::VARCHAR[]"


_ITEMS_SQL = "(VALUES " + ", ".join(
    f"({p}, {_lit_list(ds)}, {_lit_list(de)}, '{fr}', {_lit_list(cc)}, {_lit_list(coc)})"
    for p, ds, de, fr, cc, coc in ITEMS) + \
    ") AS it(item_pos, data_sets, data_elements, frequency, cat_combos, cat_option_combos)"

_CTES = [
    ("cust", "SELECT n_regionkey AS r, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey"),
    ("ou_pages", """SELECT r, c_custkey // 100 AS page, list_sort(list('C' || CAST(c_custkey AS VARCHAR)))
       AS organisation_units FROM cust GROUP BY r, c_custkey // 100"""),
    ("de_pages", """SELECT r, c_custkey // 100 AS page,
       list_sort(list(DISTINCT 'DE' || substr(o_orderpriority, 1, 1))) AS data_elements
       FROM cust JOIN orders ON o_custkey = c_custkey GROUP BY r, c_custkey // 100"""),
    ("pages", """SELECT 'DS' || CAST(o.r AS VARCHAR) AS id, o.r AS ds_pos, o.page, o.organisation_units,
       coalesce(d.data_elements, []::VARCHAR[]) AS data_elements FROM ou_pages o LEFT JOIN de_pages d
       ON d.r = o.r AND d.page = o.page"""),
    ("ds_ou", "SELECT id AS dataset_id, unnest(organisation_units) AS org_unit FROM pages"),
    ("ds_de", "SELECT DISTINCT id AS dataset_id, unnest(data_elements) AS data_element FROM pages"),
    ("items", f"SELECT * FROM {_ITEMS_SQL}"),
    ("first_ds", """SELECT item_pos, arg_min(dataset_id, ds_pos) AS dataset_id FROM (
       SELECT DISTINCT i.item_pos, p.id AS dataset_id, p.ds_pos FROM (SELECT item_pos, unnest(data_sets) AS ds
       FROM items) i JOIN pages p ON p.id = i.ds) x GROUP BY item_pos"""),
    ("item_de", """SELECT item_pos, unnest(data_elements) AS data_element FROM items
       UNION SELECT f.item_pos, d.data_element FROM first_ds f JOIN ds_de d ON d.dataset_id = f.dataset_id
       WHERE f.item_pos IN (SELECT item_pos FROM items WHERE len(data_elements) = 0)"""),
    ("item_ou", """SELECT DISTINCT i.item_pos, o.org_unit FROM (SELECT item_pos, unnest(data_sets) AS ds FROM items) i
       JOIN ds_ou o ON o.dataset_id = i.ds"""),
    ("named", """SELECT *, CASE WHEN n = 1 THEN base ELSE base || '__' || CAST(n AS VARCHAR) END AS item_name FROM (
       SELECT *, array_to_string(data_sets, '__') AS base,
              row_number() OVER (PARTITION BY array_to_string(data_sets, '__') ORDER BY item_pos) AS n
       FROM items WHERE len(data_sets) > 0) x"""),
    ("item_months", """SELECT DISTINCT e.item_pos, v.period AS month FROM item_de e
       JOIN (SELECT DISTINCT dataElement, period FROM fx_data_values) v ON v.dataElement = e.data_element"""),
    ("plan", """SELECT n.item_pos, n.item_name, lower(n.frequency) AS frequency, m.month,
       unnest(CASE lower(n.frequency)
         WHEN 'weekly' THEN list_transform(generate_series(date_trunc('week', strptime(m.month, '%Y%m')),
             CAST(last_day(strptime(m.month, '%Y%m')) AS TIMESTAMP), INTERVAL 7 DAY),
             lambda d: CAST(isoyear(d) AS VARCHAR) || 'W' || CAST(week(d) AS VARCHAR))
         WHEN 'monthly' THEN [m.month] ELSE [substr(m.month, 1, 4)] END) AS period
       FROM named n JOIN item_months m ON m.item_pos = n.item_pos"""),
]


def _oracle(body: str, upto: str) -> str:
    names = [n for n, _ in _CTES]
    return fixtures.with_views(VIEWS, body, _CTES[:names.index(upto) + 1])


def dataset_pages(spark, sf_dir):
    """Dataset metadata as the API pages it: one dataset per region, its org
    units (the region's customers) in pages of 100 ids, and the data
    elements reported by those customers."""
    fixtures.register_base_tables(spark, sf_dir)
    cust = spark.table("customer").join(spark.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")) \
        .select(F.col("n_regionkey").alias("r"), "c_custkey", (F.col("c_custkey") / 100).cast("bigint").alias("page"))
    ou = cust.groupBy("r", "page").agg(
        F.array_sort(F.collect_list(F.concat(F.lit("C"), F.col("c_custkey").cast("string")))).alias("organisation_units"))
    de = cust.join(spark.table("orders"), F.col("o_custkey") == F.col("c_custkey")).groupBy("r", "page").agg(
        F.array_sort(F.collect_set(F.concat(F.lit("DE"), F.substring("o_orderpriority", 1, 1)))).alias("data_elements"))
    return (ou.join(de, ["r", "page"], "left")
              .select(F.concat(F.lit("DS"), F.col("r").cast("string")).alias("id"), F.col("r").alias("ds_pos"),
                      "page", "organisation_units",
                      F.coalesce("data_elements", F.array().cast("array<string>")).alias("data_elements")))


def stored_pages(spark, sf_dir):
    """The metadata pages as a pipeline keeps them: fetched (here: derived)
    once, stored as JSON, then read back with the fixed schema."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/datasets-{uuid.uuid4().hex}"
    dataset_pages(spark, sf_dir).write.json(path)
    return io.scan_dataset_metadata(spark, path, schema=io.DATASET_PAGE)


def _setup(spark, sf_dir):
    pages = stored_pages(spark, sf_dir)
    ou_bridge, de_bridge = io.dataset_bridges(pages)
    items = config_dim(spark, ITEMS, EXTRACT_ITEM)
    return pages, ou_bridge.select("dataset_id", "org_unit"), de_bridge.select("dataset_id", "data_element").distinct(), items


def category_combos(spark, sf_dir):
    """Category combos from the tables: order status and order priority."""
    fixtures.register_base_tables(spark, sf_dir, ["orders"])
    o = spark.table("orders")

    def combo(cid, name, col, prefix):
        d = o.select(F.col(col).alias("v")).distinct()
        return d.groupBy().agg(F.array_sort(F.collect_list(F.struct(
            F.concat(F.lit(prefix), F.col("v")).alias("id"), F.col("v").alias("displayName")))).alias(
            "categoryOptionCombos")).select(F.lit(cid).alias("id"), F.lit(name).alias("displayName"),
                                            "categoryOptionCombos")
    return combo("CC_STATUS", "Status", "o_orderstatus", "COC").unionByName(
        combo("CC_PRIORITY", "Priority", "o_orderpriority", "PRIO"))


def _combo_bridge(spark, sf_dir, items):
    """Category combos dumped as JSON and read back with the fixed schema (A5)."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/combos-{uuid.uuid4().hex}"
    category_combos(spark, sf_dir).write.json(path)
    configured = items.select(F.explode("cat_combos").alias("cat_combo"))
    return io.category_combo_bridge(io.scan_category_combos(spark, path), configured)


@query("a4_scan_dataset_metadata", _oracle("""
SELECT id AS dataset_id, page, CAST(i AS INTEGER) AS pos, organisation_units[i + 1] AS org_unit
FROM (SELECT *, unnest(range(len(organisation_units))) AS i FROM pages) x""", "pages"))
def q_a4(spark, sf_dir):
    """Metadata pages dumped as JSON (the API shape), read back with the fixed
    schema, then bridged."""
    ou, _ = io.dataset_bridges(stored_pages(spark, sf_dir), carry=["page"])
    return ou


@query("a5_scan_category_combos", """
WITH combos AS (
  SELECT 'CC_STATUS' AS cat_combo, 'COC' || o_orderstatus AS coc FROM (SELECT DISTINCT o_orderstatus FROM orders) s
  UNION ALL SELECT 'CC_PRIORITY', 'PRIO' || o_orderpriority FROM (SELECT DISTINCT o_orderpriority FROM orders) p),
wanted AS (SELECT DISTINCT cat_combo FROM (VALUES ('CC_STATUS'), ('CC_MISSING')) AS w(cat_combo))
SELECT c.cat_combo, c.coc, true AS known FROM combos c WHERE c.cat_combo IN (SELECT cat_combo FROM wanted)
UNION ALL
SELECT w.cat_combo, CAST(NULL AS VARCHAR), false FROM wanted w
WHERE w.cat_combo NOT IN (SELECT cat_combo FROM combos)""")
def q_a5(spark, sf_dir):
    items = config_dim(spark, ITEMS, EXTRACT_ITEM)
    bridge, unknown = _combo_bridge(spark, sf_dir, items)
    return bridge.withColumn("known", F.lit(True)).unionByName(
        unknown.select("cat_combo", F.lit(None).cast("string").alias("coc"), F.lit(False).alias("known")))


@query("b5_scope_to_dataset_org_units", _oracle("""
SELECT o.item_pos, v.row_id FROM fx_data_values v JOIN item_ou o ON o.org_unit = v.orgUnit
JOIN item_de d ON d.item_pos = o.item_pos AND d.data_element = v.dataElement""", "item_ou"))
def q_b5(spark, sf_dir):
    pages, ou, de, items = _setup(spark, sf_dir)
    scope = scope_org_units(items, pages, ou)
    elements = item_data_elements(items, pages, de)
    dv = fixtures.view(spark, sf_dir, "fx_data_values")
    return scope_data(dv, scope, elements, org_unit_col="orgUnit", element_col="dataElement").select(
        "item_pos", "row_id")


@query("b6_default_data_elements", _oracle("SELECT * FROM item_de", "item_de"))
def q_b6(spark, sf_dir):
    pages, _, de, items = _setup(spark, sf_dir)
    return item_data_elements(items, pages, de)


@query("b9_expand_rate_keys", fixtures.with_views(["fx_analytics"], """
SELECT k.extract_uid, k.rate_key, count(a.row_id) AS n_cells FROM (VALUES
  ('EXA', 'DS0.REPORTING_RATE'), ('EXA', 'DS0.REPORTING_RATE_ON_TIME'), ('EXB', 'DS3.EXPECTED_REPORTS'))
  AS k(extract_uid, rate_key) LEFT JOIN fx_analytics a ON a.dx = k.rate_key GROUP BY k.extract_uid, k.rate_key"""))
def q_b9(spark, sf_dir):
    ri = config_dim(spark, RATE_ITEMS, RATE_ITEM)
    keys = rate_keys(ri.join(rejected_rate_items(ri).select("extract_uid", "dataset_uid"),
                             ["extract_uid", "dataset_uid"], "left_anti")
                     .where(F.col("extract_uid").isNotNull() & F.col("dataset_uid").isNotNull()))
    cells = fixtures.view(spark, sf_dir, "fx_analytics").groupBy(F.col("dx").alias("rate_key")).agg(
        F.count(F.lit(1)).alias("n_cells"))
    return keys.join(cells, "rate_key", "left").select(
        "extract_uid", "rate_key", F.coalesce("n_cells", F.lit(0)).alias("n_cells"))


def _plan(spark, sf_dir, setup=None):
    pages, _, de, items = setup or _setup(spark, sf_dir)
    elements = item_data_elements(items, pages, de)
    dv = fixtures.view(spark, sf_dir, "fx_data_values")
    months = (elements.join(dv.select("dataElement", "period").distinct(),
                            F.col("data_element") == F.col("dataElement"))
              .select("item_pos", F.col("period").alias("month")).distinct())
    return extraction_plan(items, months)


@query("b10_extraction_plan", _oracle("SELECT * FROM plan", "plan"))
def q_b10(spark, sf_dir):
    return _plan(spark, sf_dir)


@query("b11_plan_item_names", _oracle("""
SELECT n.item_pos, n.item_name, count(p.period) AS n_units FROM named n LEFT JOIN plan p ON p.item_pos = n.item_pos
GROUP BY n.item_pos, n.item_name""", "plan"))
def q_b11(spark, sf_dir):
    setup = _setup(spark, sf_dir)
    items = setup[3]
    names = item_names(items.where(F.size("data_sets") > 0)).select("item_pos", "item_name")
    counts = _plan(spark, sf_dir, setup).groupBy("item_pos").agg(F.count(F.lit(1)).alias("n_units"))
    return names.join(counts, "item_pos", "left").select("item_pos", "item_name",
                                                        F.coalesce("n_units", F.lit(0)).alias("n_units"))


# One file per item and month, or per item and year for yearly items; the file's name decides.
_FILE_SQL = "item_name || '_' || CASE WHEN frequency = 'yearly' THEN substr(month, 1, 4) ELSE month END"


@query("c10_skip_existing", _oracle(f"""
SELECT item_pos, item_name, frequency, month, period FROM (
  SELECT *, row_number() OVER (PARTITION BY item_name, period ORDER BY month) AS n FROM plan
  WHERE {_FILE_SQL} NOT IN (SELECT {_FILE_SQL} FROM plan WHERE month < '{EXISTING_BEFORE}')) x
WHERE frequency <> 'yearly' OR n = 1""", "plan"))
def q_c10(spark, sf_dir):
    """Months before 1998 are extracted. 1998W1 belongs to a month that is and to
    one that is not; the latter is still to do."""
    plan = _plan(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/existing-{uuid.uuid4().hex}"
    file_period = F.when(F.col("frequency") == "yearly", F.substring("month", 1, 4)).otherwise(F.col("month"))
    (plan.where(F.col("month") < EXISTING_BEFORE).select("item_name", file_period.alias("file_period"))
     .distinct().write.parquet(path))
    existing = spark.read.schema("item_name string, file_period string").parquet(path)
    return skip_existing(plan, existing)


@query("c14_expand_category_combos", _oracle("""
SELECT x.item_pos, x.coc, count(v.row_id) AS n_rows FROM (
  SELECT item_pos, unnest(cat_option_combos) AS coc FROM items
  UNION SELECT i.item_pos, 'COC' || s.o_orderstatus FROM (SELECT item_pos, unnest(cat_combos) AS cc FROM items) i
    JOIN (SELECT DISTINCT o_orderstatus FROM orders) s ON i.cc = 'CC_STATUS') x
LEFT JOIN fx_data_values v ON v.categoryOptionCombo = x.coc GROUP BY x.item_pos, x.coc""", "items"))
def q_c14(spark, sf_dir):
    _, _, _, items = _setup(spark, sf_dir)
    bridge, _ = _combo_bridge(spark, sf_dir, items)
    cocs = expand_category_combos(items, bridge, allow_unfiltered=True)  # one item names a combo that is gone
    counts = fixtures.view(spark, sf_dir, "fx_data_values").groupBy(
        F.col("categoryOptionCombo").alias("coc")).agg(F.count(F.lit(1)).alias("n_rows"))
    return cocs.join(counts, "coc", "left").select("item_pos", "coc", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


_RATE_CTES = [
    ("run_day", "SELECT CAST(max(ts) AS DATE) AS d FROM events"),
    ("rkeys", """SELECT * FROM (VALUES ('EXA', 'DS0', 'REPORTING_RATE'), ('EXA', 'DS0', 'REPORTING_RATE_ON_TIME'),
                 ('EXB', 'DS3', 'EXPECTED_REPORTS')) AS k(extract_uid, dataset_uid, metric)"""),
    ("rperiods", """SELECT strftime(date_trunc('month', d) - to_months(CAST(n AS INTEGER)), '%Y%m') AS period
                    FROM run_day, (SELECT unnest(range(4)) AS n) r"""),
    ("plan_r", """SELECT k.extract_uid, k.dataset_uid, k.metric, k.dataset_uid || '.' || k.metric AS rate_key, p.period
                  FROM rkeys k JOIN rperiods p ON true""")]


@query("b10_rate_extraction_plan", fixtures.with_views(["fx_analytics"], """
SELECT p.extract_uid, p.dataset_uid, p.metric, p.rate_key, p.period, count(a.row_id) AS n_cells
FROM plan_r p LEFT JOIN fx_analytics a ON a.dx = p.rate_key AND a.pe = p.period
GROUP BY p.extract_uid, p.dataset_uid, p.metric, p.rate_key, p.period""", _RATE_CTES))
def q_b10_rates(spark, sf_dir):
    """The second-generation rate plan as of the latest event, with the number
    of analytics cells available for each planned (rate key, period)."""
    cells = fixtures.view(spark, sf_dir, "fx_analytics").groupBy(
        F.col("dx").alias("rate_key"), F.col("pe").alias("period")).agg(F.count(F.lit(1)).alias("n_cells"))
    fixtures.register_base_tables(spark, sf_dir, ["events"])
    as_of = spark.table("events").agg(F.max("ts").cast("date")).first()[0]  # one value: the run's "now"
    plan = rate_extraction_plan(config_dim(spark, RATE_ITEMS, RATE_ITEM), F.lit(as_of))
    return (plan.join(cells, ["rate_key", "period"], "left")
                .select("extract_uid", "dataset_uid", "metric", "rate_key", "period",
                        F.coalesce("n_cells", F.lit(0)).alias("n_cells")))


@query("b10_rejected_items", _oracle("SELECT item_pos, 'no DATA_SETS' AS reason FROM items WHERE len(data_sets) = 0",
                                     "items"))
def q_b10_rejected(spark, sf_dir):
    return rejected_items(_setup(spark, sf_dir)[3])


# Extracts that exist: those of the periods that have any cell of an odd user.
_HAVE_SQL = """SELECT DISTINCT p.extract_uid, p.period FROM plan_r p JOIN fx_analytics a
  ON a.dx = p.rate_key AND a.pe = p.period AND a.row_id % 2 = 1 WHERE p.extract_uid = 'EXA'"""


@query("c10_skip_existing_rates", fixtures.with_views(["fx_analytics"], """
SELECT 'extract' AS what, extract_uid, period, rate_key FROM plan_r p
WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.extract_uid = p.extract_uid AND h.period = p.period)
UNION ALL SELECT 'handed back', extract_uid, period, CAST(NULL AS VARCHAR) FROM have""",
                                                      _RATE_CTES + [("have", _HAVE_SQL)]))
def q_c10_rates(spark, sf_dir):
    """Second generation: extracts that exist are not downloaded again but handed back."""
    fixtures.register_base_tables(spark, sf_dir, ["events"])
    as_of = spark.table("events").agg(F.max("ts").cast("date")).first()[0]  # one value: the run's "now"
    plan = rate_extraction_plan(config_dim(spark, RATE_ITEMS, RATE_ITEM), F.lit(as_of))
    cells = fixtures.view(spark, sf_dir, "fx_analytics").where("row_id % 2 = 1")
    have = (plan.where(F.col("extract_uid") == "EXA")
            .join(cells.select(F.col("dx").alias("rate_key"), F.col("pe").alias("period")).distinct(),
                  ["rate_key", "period"], "left_semi").select("extract_uid", "period").distinct())
    todo, back = skip_existing_rates(plan, have, return_existing=True)
    return (todo.select(F.lit("extract").alias("what"), "extract_uid", "period", "rate_key")
            .unionByName(back.select(F.lit("handed back").alias("what"), "extract_uid", "period",
                                     F.lit(None).cast("string").alias("rate_key"))))
