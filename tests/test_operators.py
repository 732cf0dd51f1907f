"""Operator rules on hand-written rows and invariants that must hold at any size."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from aggrex.functions import periods as P
from aggrex.functions.values import to_number_or_null
from aggrex.operators.hierarchy import select_descendants
from aggrex.operators.normalise import normalise_rates, union_checked
from aggrex.operators.push import classify_data_points, global_positions, payload_batches

COLS = "dx_uid string, period string, org_unit string, category_option_combo string, " \
       "attribute_option_combo string, value string"


def test_classification_rules(spark):
    df = spark.createDataFrame([
        ("D", "202401", "O", "C", "A", "1"),     # all six -> valid
        ("D", "202401", "O", "C", "A", None),    # value missing -> to_delete
        ("D", "202401", None, "C", "A", "1"),    # key missing -> invalid
        ("D", "202401", None, "C", "A", None),   # key and value missing -> invalid
    ], COLS)
    got = [r["class"] for r in classify_data_points(df).collect()]
    assert got == ["valid", "to_delete", "invalid", "invalid"]


def test_non_numeric_rate_is_invalid_not_deleted(spark):
    df = spark.createDataFrame([("D", "202401", "O", "C", "A", "n/a"), ("D", "202401", "O", "C", "A", "1d")], COLS)
    df = df.withColumn("value_num", to_number_or_null("value"))
    out = classify_data_points(df, require_numeric=True).collect()
    assert [r["class"] for r in out] == ["invalid", "invalid"]
    assert all("value_not_numeric" in r["missing"] for r in out)


def test_batches_are_bounded_dense_and_lossless(spark):
    rows = [("D", "202401", f"O{i % 37}", "C", "A", str(i) if i % 9 else None) for i in range(1000)]
    df = classify_data_points(spark.createDataFrame(rows, COLS)).withColumn("rid", F.monotonically_increasing_id())
    b = payload_batches(df, max_post=64, tie_break="rid").collect()
    assert max(r["n_points"] for r in b) <= 64
    assert sum(r["n_points"] for r in b) == 1000
    for phase in ("valid", "to_delete"):
        nos = sorted(r["batch_no"] for r in b if r["phase"] == phase)
        assert nos == list(range(len(nos)))
        sizes = [r["n_points"] for r in sorted((r for r in b if r["phase"] == phase), key=lambda r: r["batch_no"])]
        assert all(s == 64 for s in sizes[:-1])


def test_global_positions_with_a_hot_key(spark):
    # A third of the rows share one org unit: positions must still be dense and ordered.
    rows = [("HOT" if i % 3 == 0 else f"O{i:05d}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "org_unit string, rid long").repartition(7)
    out = global_positions(df, ["org_unit", "rid"]).orderBy("_pos").collect()
    assert [r["_pos"] for r in out] == list(range(3000))
    assert [(r["org_unit"], r["rid"]) for r in out] == sorted(rows)


def test_rate_with_three_parts_raises(spark):
    df = spark.createDataFrame([("a.b.c", "202401", "O", "1")], "dx string, period string, orgUnit string, value string")
    with pytest.raises(Exception):
        normalise_rates(df).collect()
    lenient = normalise_rates(df, strict=False).collect()
    assert lenient[0]["dx_uid"] is None


def test_union_checked_refuses_different_columns(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(1, 2)], "x int, z int")
    with pytest.raises(ValueError):
        union_checked([a, b])
    assert union_checked([None, a, a]).count() == 2


def test_descendants_survive_cycles(spark):
    units = spark.createDataFrame([
        ("A", None), ("B", "A"), ("C", "B"), ("D", "C"), ("X", "Y"), ("Y", "X"), ("Z", "Q")],
        "id string, parent_id string")
    got = sorted(r["id"] for r in select_descendants(units, ["B", "X"]).collect())
    assert got == ["B", "C", "D", "X", "Y"]


def test_period_labels(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 31), "202412")], "d date, m string")
    r = df.select(P.iso_week_label("d").alias("w"), P.weeks_of_month("m").alias("ws"),
                  P.period_back(F.col("d"), F.lit(1), F.lit("QUARTERLY")).alias("q"),
                  P.first_day_of_future_month("m", 1).alias("f"),
                  P.extract_periods(F.lit("2024W52"), F.lit("2025W2"), 0, F.lit("WEEKLY"), F.col("d")).alias("e")
                  ).first()
    assert r["w"] == "2025W1"
    assert r["ws"] == ["2024W48", "2024W49", "2024W50", "2024W51", "2024W52", "2025W1"]
    assert r["q"] == "2024Q3"
    assert r["f"] == "2025-01-01"
    assert r["e"] == ["2024W52", "2025W1", "2025W2"]


def test_month_range_rejects_reversed_bounds(spark):
    df = spark.createDataFrame([("202405", "202401")], "s string, e string")
    with pytest.raises(Exception):
        df.select(P.month_range("s", "e")).collect()


def test_month_validation_follows_the_reference(spark):
    df = spark.createDataFrame([("202401",), ("202413",), ("abcd05",), ("20241",), (None,)], "p string")
    got = [r[0] for r in df.select(P.is_valid_yyyymm("p")).collect()]
    assert got == [True, False, True, False, False]
    strict = [r[0] for r in df.select(P.is_valid_yyyymm("p", strict_year=True)).collect()]
    assert strict == [True, False, False, False, False]
    b = spark.createDataFrame([("202401", "202402"), ("202403", "202402"), (None, "202402")], "s string, e string")
    assert [r[0] for r in b.select(P.month_bounds_ok("s", "e")).collect()] == [True, False, True]


def test_invariants_on_fixture_tables(spark):
    """SURVEY §5 invariants on the sf0.001 fixture views."""
    from aggrex import fixtures
    from aggrex.operators.align import org_units_matching, org_units_to_create
    from aggrex.operators.normalise import merge_extracts, normalise_data_values
    sf = "/root/testdata/sf0.001"
    fixtures.register(spark, sf, ["fx_data_values", "fx_pyramid_target"])
    dv = normalise_data_values(spark.table("fx_data_values"), carry=["row_id"])
    # The three classes partition the input.
    c = classify_data_points(dv)
    assert c.count() == dv.count()
    assert c.groupBy("class").count().agg(F.sum("count")).first()[0] == dv.count()
    assert c.where(F.col("class").isNull()).count() == 0
    # Units to create and matching units together are the source ids.
    src, tgt = spark.table("fx_pyramid_source"), spark.table("fx_pyramid_target")
    ids = {r[0] for r in org_units_to_create(src, tgt).select("id").collect()} | \
          {r[0] for r in org_units_matching(src, tgt, order_col="k").select("id").collect()}
    assert ids == {r[0] for r in src.select("id").collect()}
    # Merging is idempotent (merging the merged months again changes nothing).
    months = dv.select(F.col("period").alias("month")).distinct()
    ex = dv.drop("row_id").withColumn("extract_period", F.col("period"))
    once = merge_extracts(ex, months)
    again = merge_extracts(once.drop("merge_month").withColumn("extract_period", F.col("period")), months)
    def key(r):
        return tuple("" if x is None else str(x) for x in r)
    assert sorted(map(tuple, once.collect()), key=key) == sorted(map(tuple, again.collect()), key=key)


def test_identical_copies_spread_over_range_partitions(spark):
    rows = [("SAME", 0)] * 1000 + [(f"O{i:05d}", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "org_unit string, v long").repartition(8)
    out = global_positions(df, ["org_unit", "v"]).orderBy("_pos").collect()
    assert [r["_pos"] for r in out] == list(range(3000))
    # Tiny test data would be coalesced into one partition by AQE; measure
    # the range partitioning itself.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = (df.withColumn("_tie", F.monotonically_increasing_id()).orderBy("org_unit", "v", "_tie")
                   .groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 2 and max(r["count"] for r in sizes) < 1000


def test_positions_keep_rows_with_null_group_keys(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), ("g", "c")], "grp string, v string")
    out = [(r["grp"], r["v"], r["_pos"]) for r in global_positions(df, ["grp", "v"], group_cols=["grp"]).collect()]
    assert sorted(out, key=lambda x: (x[0] or "", x[1])) == [(None, "a", 0), (None, "b", 1), ("g", "c", 0)]


def test_positions_across_many_range_partitions(spark):
    """Offsets from per-partition counts, with the sort really spread over 16
    partitions (AQE would otherwise coalesce this small input into one)."""
    rows = [(f"O{i % 97:03d}", i) for i in range(5000)]
    df = spark.createDataFrame(rows, "org_unit string, v long")
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = global_positions(df, ["org_unit", "v"]).collect()
        grouped = global_positions(df, ["org_unit", "v"], group_cols=["org_unit"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    assert sorted((r["_pos"], r["org_unit"], r["v"]) for r in out) == \
        [(i, o, v) for i, (o, v) in enumerate(sorted(rows))]
    expect = {}
    for o, v in sorted(rows):
        expect[(o, v)] = sum(1 for k in expect if k[0] == o)
    assert {(r["org_unit"], r["v"]): r["_pos"] for r in grouped} == expect


def test_yearly_extracts_join_every_month_of_their_year(spark):
    from aggrex.operators.normalise import merge_extracts
    from aggrex.schemas import DATA_POINT
    rows = [("DATA_ELEMENT", "M", "202401", "O", "C", "A", None, "AGGREGATED", "1", "202401"),
            ("DATA_ELEMENT", "M", "202401", "O", "C", "A", None, "AGGREGATED", "1", "202401"),  # copy
            ("DATA_ELEMENT", "Y", "2024", "O", "C", "A", None, "AGGREGATED", "9", "2024")]
    ex = spark.createDataFrame(rows, DATA_POINT.simpleString()[:-1] + ",extract_period:string>")
    months = spark.createDataFrame([("202401",), ("202402",)], "month string")
    got = sorted((r["merge_month"], r["dx_uid"]) for r in merge_extracts(ex, months).collect())
    assert got == [("202401", "M"), ("202401", "Y"), ("202402", "Y")]


def test_extract_periods_by_frequency(spark):
    df = spark.createDataFrame([(dt.date(2024, 8, 15),)], "d date")
    r = df.select(
        P.extract_periods(None, None, 2, F.lit("QUARTERLY"), F.col("d")).alias("q"),
        P.extract_periods(F.lit("2022"), None, 0, F.lit("YEARLY"), F.col("d")).alias("y"),
        P.extract_periods(F.lit("202409"), F.lit("202401"), 0, F.lit("MONTHLY"), F.col("d")).alias("rev"),
        P.extract_periods(None, None, 3, F.lit("MONTHLY"), F.col("d")).alias("m")).first()
    assert r["q"] == ["2024Q1", "2024Q2", "2024Q3"]
    assert r["y"] == ["2022", "2023", "2024"]
    assert r["rev"] == ["202409"]  # start not before end: just the start
    assert r["m"] == ["202405", "202406", "202407", "202408"]  # window 3 + the current period


def test_merge_shuffles_rows_by_extract_not_by_month(spark):
    from aggrex.operators.normalise import MONTHS_OF_SET, merge_extracts
    from aggrex.schemas import DATA_POINT
    months = [f"2024{i:03d}" for i in range(2 * MONTHS_OF_SET + 5)] + ["2024", "202302", None]
    rows = [("D", "both", "p", "O", None, "A", None, "X", "1", e) for e in ("2024", "2024007", "2024007", "2023")]
    rows += [("D", "month", "p", "O", "C", "A", None, "X", None, e) for e in (months[3], months[-4], "2025", None)]
    ex = spark.createDataFrame(rows, DATA_POINT.simpleString()[:-1] + ",extract_period:string>")
    got = merge_extracts(ex, spark.createDataFrame([(m,) for m in months], "month string"))
    pairs = [(r["merge_month"], r["dx_uid"]) for r in got.collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(m, "both") for m in months if m} | {(months[3], "month"), (months[-4], "month")}
    # Rows move before they are repeated for every month.
    assert "hashpartitioning(merge_month" not in got._jdf.queryExecution().executedPlan().toString()
