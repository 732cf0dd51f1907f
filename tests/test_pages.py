"""Paged dumps: folders that aren't asked for stay closed, half answers are told apart."""

from __future__ import annotations

import json

from aggrex.sources import pages as pg


def _dump(root, pages):
    """pages: (period, unit, file name, text)."""
    for period, unit, name, text in pages:
        folder = root / f"request_period={period}" / f"request_unit={unit}"
        folder.mkdir(parents=True, exist_ok=True)
        with open(folder / name, "a") as f:
            f.write(text + "\n")
    return str(root)


def _page(page, of, *values, indent=None):
    rows = [{"dataElement": "DE1", "period": "202401", "orgUnit": "C1", "value": v} for v in values]
    return json.dumps({"pager": {"page": page, "pageCount": of}, "dataValues": rows}, indent=indent)


def test_half_answers_are_told_apart(spark, tmp_path):
    root = _dump(tmp_path, [
        ("2024", "whole", "1.json", _page(1, 2, "1", "2")), ("2024", "whole", "2.json", _page(2, 2, "3")),
        ("2024", "empty", "1.json", _page(1, 1)),
        ("2024", "missing", "1.json", _page(1, 3, "4")), ("2024", "missing", "3.json", _page(3, 3, "5")),
        ("2024", "no_first", "2.json", _page(2, 2, "6")),
        ("2024", "changed", "1.json", _page(1, 2, "7")), ("2024", "changed", "2.json", _page(2, 3, "8")),
        ("2024", "repeated", "1.json", _page(1, 2, "9")), ("2024", "repeated", "a.json", _page(1, 2, "9")),
        ("2024", "repeated", "2.json", _page(2, 2, "10")),
        ("2024", "broken", "1.json", _page(1, 2, "11")), ("2024", "broken", "2.json", _page(2, 2, "12")[:-9]),
        ("2024", "no_pager", "1.json", '{"dataValues":[]}'),
        ("2023", "whole", "1.json", _page(1, 1, "13")),
        ("__HIVE_DEFAULT_PARTITION__", "whole", "1.json", _page(1, 2, "14")),
    ])
    pages = pg.scan_pages(spark, root, pg.DATA_VALUE_PAGE)
    bad = {(r.request_period, r.request_unit): (r.page_count, r.pages_seen, r.reason)
           for r in pg.incomplete_requests(pages).collect()}
    assert bad == {
        ("2024", "missing"): (3, 2, "missing page"), ("2024", "no_first"): (2, 1, "missing page"),
        ("2024", "changed"): (3, 2, "page count changed"), ("2024", "repeated"): (2, 2, "repeated page"),
        ("2024", "broken"): (2, 1, "broken page"), ("2024", "no_pager"): (None, 0, "broken page"),
        (None, "whole"): (2, 1, "missing page")}
    whole = pg.page_data_values(pg.complete_pages(pages)).collect()
    assert sorted((r.request_period, r.request_unit, r.value) for r in whole) == [
        ("2023", "whole", "13"), ("2024", "whole", "1"), ("2024", "whole", "2"), ("2024", "whole", "3")]


def test_only_folders_asked_for_are_read(spark, tmp_path):
    root = _dump(tmp_path, [(p, u, "1.json", _page(1, 1, f"{p}{u}")) for p in ("2022", "2023") for u in "ab"])
    pages = pg.scan_pages(spark, root, pg.DATA_VALUE_PAGE).where("request_period = '2023' and request_unit = 'a'")
    plan = spark._jvm.PythonSQLUtils.explainString(pages._jdf.queryExecution(), "formatted")
    filters = next(x for x in plan.splitlines() if x.startswith("PartitionFilters"))
    assert "request_period" in filters and "request_unit" in filters
    values = pg.page_data_values(pages)
    assert [r.value for r in values.collect()] == ["2023a"]
    wanted = spark.createDataFrame([("2022", "b"), ("2022", "b"), ("2021", "a")], pg.REQUEST)
    some = pg.scan_pages(spark, root, pg.DATA_VALUE_PAGE, wanted)
    assert [r.value for r in pg.page_data_values(some).collect()] == ["2022b"]


def test_a_page_over_several_lines(spark, tmp_path):
    root = _dump(tmp_path, [("2024", "a", "1.json", _page(1, 1, "1", "2", indent=2))])
    pages = pg.scan_pages(spark, root, pg.DATA_VALUE_PAGE, multi_line=True)
    assert pg.incomplete_requests(pages).isEmpty()
    assert sorted(r.value for r in pg.page_data_values(pages).collect()) == ["1", "2"]


def test_cells_go_by_the_headers_of_their_page(spark, tmp_path):
    def page(n, names, *rows):
        return json.dumps({"pager": {"page": n, "pageCount": 2}, "headers": [{"name": x} for x in names], "rows": rows})

    root = _dump(tmp_path, [
        ("2024", "a", "1.json", page(1, ["dx", "pe", "ou", "value"], ["D", "202401", "C1", "5"])),
        ("2024", "a", "2.json", page(2, ["value", "extra", "co", "dx", "ou", "pe"],
                                     ["6", "x", "CO", "D", "C2", "202402"], ["7", "x", None, "D"]))])
    got = pg.page_analytics(pg.scan_pages(spark, root, pg.ANALYTICS_PAGE))
    assert sorted(((r.dx, r.period, r.orgUnit, r.categoryOptionCombo, r.value) for r in got.collect()), key=str) == [
        ("D", "202401", "C1", None, "5"), ("D", "202402", "C2", "CO", "6"), ("D", None, None, None, "7")]
