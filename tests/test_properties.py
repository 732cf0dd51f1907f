"""Property tests: period expressions against the calendar, batching invariants."""

import calendar
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aggrex.functions import periods as P

DATES = st.lists(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2035, 12, 31)), min_size=50, max_size=200)


def _minus_months(d: dt.date, n: int) -> dt.date:
    y, m = divmod(d.year * 12 + (d.month - 1) - n, 12)
    return dt.date(y, m + 1, min(d.day, calendar.monthrange(y, m + 1)[1]))


def _weeks_of_month(yyyymm: str) -> list[str]:
    y, m = int(yyyymm[:4]), int(yyyymm[4:])
    first, last = dt.date(y, m, 1), dt.date(y, m, calendar.monthrange(y, m)[1])
    monday, out = first - dt.timedelta(days=first.weekday()), []
    while monday <= last:
        iy, iw, _ = monday.isocalendar()
        out.append(f"{iy}W{iw}")
        monday += dt.timedelta(days=7)
    return out


@settings(max_examples=4, deadline=None)
@given(dates=DATES, n=st.integers(min_value=0, max_value=30))
def test_period_expressions_match_the_calendar(spark, dates, n):
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    got = df.select(
        "d", P.iso_week_label("d").alias("w"), P.month_label("d").alias("m"), P.quarter_label("d").alias("q"),
        P.period_back(F.col("d"), F.lit(n), F.lit("MONTHLY")).alias("back_m"),
        P.period_back(F.col("d"), F.lit(n), F.lit("WEEKLY")).alias("back_w"),
        P.weeks_of_month(P.month_label("d")).alias("weeks"),
        P.first_day_of_future_month(P.month_label("d"), F.lit(n)).alias("first")).collect()
    for r in got:
        d = r["d"]
        iy, iw, _ = d.isocalendar()
        assert r["w"] == f"{iy}W{iw}"
        assert r["m"] == d.strftime("%Y%m")
        assert r["q"] == f"{d.year}Q{(d.month - 1) // 3 + 1}"
        assert r["back_m"] == _minus_months(d, n).strftime("%Y%m")
        wy, ww, _ = (d - dt.timedelta(weeks=n)).isocalendar()
        assert r["back_w"] == f"{wy}W{ww}"
        assert r["weeks"] == _weeks_of_month(d.strftime("%Y%m"))
        assert r["first"] == _minus_months(d.replace(day=1), -n).strftime("%Y-%m-01")


ROWS = st.lists(st.tuples(st.sampled_from(["O1", "O2", "O3", "O4"]), st.sampled_from(["202401", "202402"]),
                          st.one_of(st.none(), st.integers(0, 999).map(str))), min_size=1, max_size=300)


@settings(max_examples=4, deadline=None)
@given(rows=ROWS, max_post=st.integers(min_value=1, max_value=40))
def test_payload_batches_are_bounded_consecutive_and_lossless(spark, rows, max_post):
    import json
    from aggrex.operators.push import classify_data_points, payload_batches
    data = [("D", p, o, "C", "A", v, i) for i, (o, p, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "dx_uid string, period string, org_unit string, category_option_combo string, "
                                     "attribute_option_combo string, value string, rid long")
    batches = payload_batches(classify_data_points(df), max_post=max_post, tie_break="rid").collect()
    assert sum(b["n_points"] for b in batches) == len(rows)
    for (phase, period) in {(b["phase"], b["period"]) for b in batches}:
        group = sorted((b for b in batches if (b["phase"], b["period"]) == (phase, period)), key=lambda b: b["batch_no"])
        assert [b["batch_no"] for b in group] == list(range(len(group)))
        assert all(b["n_points"] == max_post for b in group[:-1]) and 0 < group[-1]["n_points"] <= max_post
        units = [v["orgUnit"] for b in group for v in json.loads(b["body"])["dataValues"]]
        assert units == sorted(units)


@settings(max_examples=4, deadline=None)
@given(texts=st.lists(st.text(alphabet="0123456789.+-eE ", min_size=0, max_size=12), min_size=50, max_size=200))
def test_number_coercion_matches_python(spark, texts):
    import re
    from aggrex.functions.values import NUMBER_PATTERN, to_number_or_null
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for r in df.select("v", to_number_or_null("v").alias("n")).collect():
        if re.match(NUMBER_PATTERN, r["v"]):
            assert r["n"] == float(r["v"].strip())
        else:
            assert r["n"] is None


@settings(max_examples=3, deadline=None)
@given(seed=st.integers(min_value=0, max_value=10 ** 6))
def test_descendants_match_a_plain_closure(spark, seed):
    import random
    from aggrex.operators.hierarchy import select_descendants
    rnd = random.Random(seed)
    n = 40
    # Mostly a forest (parent earlier in the list), sometimes any node: cycles appear.
    parents = [None] + [f"n{rnd.randrange(i)}" if rnd.random() < 0.9 else f"n{rnd.randrange(n)}" for i in range(1, n)]
    units = [(f"n{i}", p) for i, p in enumerate(parents)]
    roots = [f"n{rnd.randrange(n)}" for _ in range(3)] + ["absent"]
    seen, frontier = set(roots), set(roots)
    while frontier:
        frontier = {u for u, p in units if p in frontier} - seen
        seen |= frontier
    want = sorted(u for u, _ in units if u in seen)
    df = spark.createDataFrame(units, "id string, parent_id string")
    assert sorted(r["id"] for r in select_descendants(df, roots).collect()) == want


@settings(max_examples=3, deadline=None)
@given(seed=st.integers(min_value=0, max_value=10 ** 6))
def test_pyramid_diff_matches_a_plain_diff(spark, seed):
    import json
    import random
    from aggrex.operators.align import COMPARED_FIELDS, org_units_to_create, org_units_to_update
    rnd = random.Random(seed)
    geos = [None, '{"type":"Point","coordinates":[1,2]}', '{"coordinates": [1, 2], "type": "Point"}',
            '{"type":"Point","coordinates":[1,3]}']

    def unit(i):
        return {"id": f"u{i}", "name": rnd.choice(["a", "b", None]), "shortName": rnd.choice(["s", None]),
                "openingDate": rnd.choice(["2000-01-01", "2001-01-01"]), "closedDate": rnd.choice([None, "2030-12-31"]),
                "parent_id": rnd.choice(["p1", "p2", None]), "level": 3, "path": f"/p/u{i}",
                "geometry": rnd.choice(geos)}
    src = [unit(i) for i in range(60)]
    tgt = [unit(i) for i in range(60) if rnd.random() < 0.8]
    cols = ["id", "name", "shortName", "openingDate", "closedDate", "parent_id", "level", "path", "geometry"]
    schema = ("id string, name string, shortName string, openingDate string, closedDate string, parent_id string, "
              "level int, path string, geometry string")
    s_df = spark.createDataFrame([tuple(u[c] for c in cols) for u in src], schema)
    t_df = spark.createDataFrame([tuple(u[c] for c in cols) for u in tgt], schema)

    def canon(g):
        return None if g is None else (lambda o: (o["type"], json.dumps(o["coordinates"])))(json.loads(g))
    tmap = {u["id"]: u for u in tgt}
    want_create = sorted(u["id"] for u in src if u["id"] not in tmap)
    want_update = {}
    for u in src:
        t = tmap.get(u["id"])
        if t is None:
            continue
        changed = [c for c in COMPARED_FIELDS
                   if (canon(u[c]) != canon(t[c]) if c == "geometry" else u[c] != t[c])]
        if changed:
            want_update[u["id"]] = changed
    assert sorted(r["id"] for r in org_units_to_create(s_df, t_df).collect()) == want_create
    got = {r["id"]: list(r["changed"]) for r in org_units_to_update(s_df, t_df).collect()}
    assert got == want_update


@settings(max_examples=3, deadline=None)
@given(seed=st.integers(min_value=0, max_value=10 ** 6))
def test_import_counts_match_the_counting_rule(spark, seed):
    import json
    import random
    from aggrex.operators.reports import COUNT_KEYS, import_summary
    rnd = random.Random(seed)

    def counts():
        return {k: rnd.randrange(50) for k in COUNT_KEYS if rnd.random() < 0.7}
    bodies = []
    for _ in range(120):
        kind = rnd.randrange(5)
        if kind == 0:
            bodies.append("not json")
        elif kind == 1:
            bodies.append(json.dumps({"status": "OK", "importCount": counts()}))
        elif kind == 2:
            bodies.append(json.dumps({"response": {"importCount": counts()}}))
        elif kind == 3:
            bodies.append(json.dumps({"importCount": counts(), "response": {"importCount": counts()}}))
        else:
            bodies.append(json.dumps({"status": "ERROR"}))
    want = {k: 0 for k in COUNT_KEYS}
    for b in bodies:
        try:
            r = json.loads(b)
        except ValueError:
            continue
        c = r["importCount"] if "importCount" in r else r.get("response", {}).get("importCount", {})
        for k in COUNT_KEYS:
            want[k] += c.get(k, 0)
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "batch_id long, body string")
    got = import_summary(df).first().asDict()
    assert {k: got[k] for k in COUNT_KEYS} == want


@settings(max_examples=3, deadline=None)
@given(seed=st.integers(min_value=0, max_value=10 ** 6))
def test_conflicts_are_all_extracted_in_order(spark, seed):
    import json
    import random
    from aggrex.operators.reports import import_conflicts
    rnd = random.Random(seed)

    def items(tag):
        return [{"object": f"{tag}{i}", "value": "v", "errorCode": "E1"} for i in range(rnd.randrange(3))]
    bodies, want = [], []
    for b in range(80):
        if rnd.random() < 0.1:
            bodies.append((b, "garbage"))
            continue
        body, conf, errs = {}, [], []
        for level in ("top", "response"):
            c, e = items("c"), [{"message": "m", "errorCode": "E2", "object": f"e{i}"} for i in range(rnd.randrange(2))]
            node = body if level == "top" else body.setdefault("response", {})
            if c:
                node["conflicts"] = c
            if e:
                node["errorReports"] = e
            conf += [(level, "conflict", x["object"]) for x in c]
            errs += [(level, "error_report", x["object"]) for x in e]
        order = conf + errs  # all conflicts first, then all error reports
        bodies.append((b, json.dumps(body)))
        want += [(b, pos, *o) for pos, o in enumerate(order)]
    df = spark.createDataFrame(bodies, "batch_id long, body string")
    got = sorted((r["batch_id"], r["item_pos"], r["level"], r["kind"], r["object"])
                 for r in import_conflicts(df).collect())
    assert got == sorted(want)
