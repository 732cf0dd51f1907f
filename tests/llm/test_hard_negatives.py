"""Operator 11 against a plain search over all pairs."""

from math import floor, inf, isfinite, nan

import numpy as np
import pytest

from aggrex.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, row string, dim string"


def plain(rows, anchor=lambda i: i % 100 == 0, k=5):
    ok = [(i, [floor(x * 256) if abs(x) < 2 ** 53 else floor(x) * 256 for x in v], l) for i, v, l, *_ in rows
          if i is not None and l is not None and v is not None and all(x is not None and isfinite(x) for x in v)]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for n, (i, v, label) in enumerate(ok):
        if not anchor(i):
            continue
        others = [(-score(v, w), j, m) for o, (j, w, m) in enumerate(ok) if o != n and len(w) == len(v)]
        for s, j, _ in sorted(x[:2] + (0,) for x in others if x[2] == label)[:k]:
            window = sorted(x[:2] for x in others if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s)
            out += [(i, j, r, h, -s, -t) for r, (t, h) in enumerate(window[:k], 1)]
    return sorted(out)


def found(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = hn.hard_negatives(df, **kw)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                               "negative_score").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 12))
    rows = []
    for i in range(700):
        label = int(rng.integers(0, 5))
        v = centres[label if i % 3 else (label + 1) % 5] + rng.normal(size=12) * (0.4 if seed == 1 else 2)
        rows.append((i, (v / np.sqrt(v @ v)).tolist(), label, "", ""))
    want = plain(rows, lambda i: i % 20 == 0)
    assert want and found(spark, rows, anchor="vec_id % 20 = 0") == want


def test_ties_copies_and_a_hot_label(spark):
    """A third of the rows are one vector, scores tie across labels, one label holds most rows."""
    rows = [(i, [0.5, -0.25, 0.0], 1 if i % 4 else 2, "", "") for i in range(120)]
    rows += [(1000 + i, [0.5, -0.25 + (i % 3) / 256, 0.0], i % 3, "", "") for i in range(60)]
    rows += [(2000, [0.0, 0.0, 0.0], 1, "", ""), (2100, [0.0, 0.0, 0.0], 2, "", ""), (2200, [-0.5, 0.25, 1.0], 1, "", "")]
    want = plain(rows, lambda i: i % 50 == 0)
    assert want and found(spark, rows, anchor="vec_id % 50 = 0") == want


def test_odd_rows(spark):
    """NULLs, non-finite and huge components, vectors of other lengths, repeated ids; clashing columns in every row."""
    rows = [(0, [1.0, 2.0], 1, "", ""), (0, [1.0, 2.0], 1, "", ""), (100, [1.0, None], 1, "", ""), (200, None, 1, "", ""),
            (300, [1.0, nan], 1, "", ""), (400, [1.0, inf], 1, "", ""), (500, [1.0, 1.0], None, "", ""),
            (None, [1.0, 2.0], 2, "", ""), (600, [], 1, "", ""), (601, [], 1, "", ""), (602, [], 2, "", ""),
            (700, [1.0, 2.0, 3.0], 1, "", ""), (701, [1.0, 2.0, 2.0], 1, "", ""), (702, [1.0, 2.0, 2.0], 2, "", ""),
            (1, [1.0, 1.5], 2, "", ""), (2, [0.9, 1.9], 2, "", ""), (3, [-1.0, 0.5], 1, "", ""), (4, [-1e-9, 0.0], 2, "", "")]
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows, anchor="vec_id < 0") == [] and found(spark, rows[3:5]) == []


def test_scores_beyond_doubles_and_64_bits(spark):
    big = 2.0 ** 22
    rows = [(0, [big, big], 1, "", ""), (1, [big, big - 1 / 256], 1, "", ""), (2, [big, big - 1 / 128], 2, "", ""),
            (3, [big - 1 / 256, big - 1 / 128], 2, "", ""), (4, [big, 0.9 * big], 2, "", "")]
    assert found(spark, rows) == plain(rows)
    huge = [(i, [1e300, 1.0], i % 2, "", "") for i in range(4)]
    got = found(spark, huge)
    assert got and {r[4:] for r in got} == {(hn.MOST, hn.MOST)}


def test_stops_before_the_lists_end():
    """With one strong dimension few rows are read."""
    rng = np.random.default_rng(0)
    values = rng.integers(-3, 4, size=(4000, 4))
    values[:, 0] = rng.permutation(4000) * 50
    block = hn.Block(np.arange(4000), np.zeros(4000, int), values)
    read = []
    scores = block.scores
    block.scores = lambda rows, *a: (read.append(len(rows)), scores(rows, *a))[1]
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    top = [none]
    anchor = np.array([5, 1, -1, 1])
    hn.threshold_search(block, anchor, np.ones(4000, bool), [(None, None)], top, 5)
    assert sum(read) < 1000
    assert top[0][0].tolist() == sorted((values @ anchor).tolist(), reverse=True)[:5]


def test_bounded_units(spark, monkeypatch):
    """Results don't depend on how the work is dealt."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).tolist(), int(rng.integers(0, 3)), "", "") for i in range(300)]
    monkeypatch.setattr(hn, "GROUP", 3)
    assert found(spark, rows, anchor="vec_id % 10 = 0") == plain(rows, lambda i: i % 10 == 0)
