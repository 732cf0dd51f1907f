import random

import pytest
from pyspark.sql import functions as F

from aggrex.llm import embeddings, simhash
from aggrex.llm.common import connected_components
from plain import Groups, simhash_components, vector_links


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(300)],  # a chain
    [(7, i) for i in range(400)] + [(1000, i) for i in range(380, 420)],  # two stars that touch
    [(random.Random(4).randrange(200), random.Random(i).randrange(200)) for i in range(150)],
    [(5, 5)],
    [],
])
def test_connected_components(spark, edges):
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = Groups(2000)
    for a, b in edges:
        groups.join(a, b)
    assert got == {n: groups.root(n) for e in edges for n in e if e[0] != e[1] or n in got}


def _rows(df):
    return sorted(((r.doc_id, f"{r.fp & (2 ** 64 - 1):016x}", r.component_id) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["docs", "odd_docs", "no_docs"])
def test_simhash_equals_all_pairs(name, request):
    table = request.getfixturevalue(name)
    want = simhash_components([tuple(r) for r in table.select("doc_id", "text").collect()])
    assert _rows(simhash.simhash_groups(table)) == sorted(want, key=repr)


def test_trie_join_of_dense_fingerprints_with_sliced_subtrees(spark, monkeypatch):
    """Clusters around centres, dealt into units far smaller than a cluster."""
    monkeypatch.setattr(simhash, "UNIT_LEAVES", 40)
    rng = random.Random(11)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(120):
            p = centre
            for b in rng.sample(range(64), rng.randrange(6)):
                p ^= 1 << b
            prints.add(p)
    prints |= {rng.getrandbits(64) for _ in range(200)} | {0, 2 ** 64 - 1}
    prints = sorted(prints)
    groups = Groups(len(prints))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4:
                groups.join(i, j)
    signed = [p - (p >> 63 << 64) for p in prints]
    links = simhash.trie_links(spark.createDataFrame([(p,) for p in signed], "fp long"), 4).collect()
    found = Groups(len(prints))
    at = {p: i for i, p in enumerate(signed)}
    for r in links:
        assert (prints[at[r.a]] ^ prints[at[r.b]]).bit_count() <= 4
        found.join(at[r.a], at[r.b])
    assert [groups.root(i) for i in range(len(prints))] == [found.root(i) for i in range(len(prints))]


def test_choices_cover_every_error_pattern():
    for n in (2, 10 ** 5, 10 ** 9, 10 ** 12):
        blocks, picks = simhash.choices(n, 4)
        for _ in range(50):
            hit = set(random.sample(range(blocks), 4))
            assert any(not hit & set(p) for p in picks)


def test_keep_one_of_each_group(odd_docs):
    kept = simhash.keep_one_of_each_group(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted((r.doc_id for r in kept.collect() if r.doc_id is not None))
    # 2, 3 and 6 have no words; 1 is there twice and has a copy without an id.
    assert ids == [1, 2, 4, 5, 7, 8]
    # Both rows without an id are copies of rows that have one.
    assert kept.where("doc_id is null").count() == 0


def test_one_row_of_each_group_whatever_its_ids(spark):
    """Unlike texts under one id, copies with and without ids, and groups without any id."""
    texts = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcde"]
    rows = [(1, texts[0], 1), (1, texts[1], 2), (None, texts[2], 3), (None, texts[2], 4), (5, texts[2], 5),
            (None, texts[3], 6), (None, texts[3], 7), (2, texts[0], 8), (6, texts[4], 9), (6, texts[4], 9)]
    for parts in (1, 4):
        kept = simhash.keep_one_of_each_group(
            spark.createDataFrame(rows, "doc_id long, text string, fp long").repartition(parts))
        got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
        assert got == sorted([(1, texts[0]), (1, texts[1]), (5, texts[2]), (None, texts[3]), (6, texts[4])], key=str)


def _vectors(spark):
    rng = random.Random(2)
    rows = []
    for c in range(5):
        centre = [rng.gauss(0, 1) for _ in range(10)]
        for i in range(25):
            rows.append([x + rng.gauss(0, 0.15) for x in centre])
        rows += [centre, centre, [2 * x for x in centre]]
    rows += [[rng.gauss(0, 1) for _ in range(10)] for _ in range(60)]
    rows += [None, [], [0.0] * 10, [float("nan")] * 10, [float("inf")] + [1.0] * 9, [None] + [1.0] * 9,
             [1e300] * 10, [1e300] * 10, [1.0, 1.0], [1.0, 1.0], [1.0, 0.0, 0.0], [None] + [1.0] * 9]
    rows = [(i, [None if x is None else float(x) for x in v] if v is not None else None) for i, v in enumerate(rows)]
    rows += [(None, rows[3][1]), (None, None), (5, rows[5][1])]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vector", F.lit(1))


def test_vectors_equal_all_pairs(spark, monkeypatch):
    rows, table = _vectors(spark)
    want = sorted(vector_links(rows), key=repr)
    for cell, block in ((512, 2048), (16, 8)):  # one cell, then many cells in small blocks
        monkeypatch.setattr(embeddings, "CELL", cell)
        monkeypatch.setattr(embeddings, "BLOCK", block)
        got = embeddings.near_vectors(table).collect()
        assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
        exact = sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr)
        links, all_links = sum(r[1] for r in exact), sum(r[1] for r in want)
        assert [r[0] for r in exact] == [r[0] for r in want]
        assert all(a[1] <= b[1] for a, b in zip(exact, want))  # nothing below the similarity
        assert links >= 0.9 * all_links
        if cell == 512:
            assert exact == want


def test_no_vectors(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    only = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in embeddings.near_vectors(only).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_vectors_of_each_length_have_an_index(spark, monkeypatch):
    """Lengths of many vectors, and one long vector; a length that the sample lacks is compared whole."""
    rng = random.Random(8)
    rows = []
    for dim in (3, 8, 24):
        for _ in range(12):
            centre = [rng.gauss(0, 1) for _ in range(dim)]
            rows += [[x + rng.gauss(0, 0.1) for x in centre] for _ in range(6)]
    rows += [[rng.gauss(0, 1) for _ in range(3000)], [1.0], [2.0], [-1.0]]
    rows = list(enumerate(rows))
    monkeypatch.setattr(embeddings, "CELL", 4)
    want = sorted(vector_links(rows))
    for sample in (20_000, 40):
        monkeypatch.setattr(embeddings, "SAMPLE", sample)
        got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
        found = sorted((r.vec_id, r.n_links, r.component_id) for r in got)
        assert all(a[1] <= b[1] for a, b in zip(found, want)) and len(found) == len(want)
        assert sum(r[1] for r in found) >= 0.9 * sum(r[1] for r in want)


def test_visits_go_on_until_the_target_is_met():
    """Where neighbours lie in far cells, more than the first 256 cells are visited."""
    import numpy as np
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 64))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    first, second = embeddings._codebook(x[:, :32], 60, 1), embeddings._codebook(x[:, 32:], 60, 1)
    n = embeddings.tune_visits(x, first, second, 0.3, 0.98)
    assert 256 < n <= 3600
    assert embeddings.tune_visits(x, first, second, 0.999, 0.98) < 256


def test_visits_are_the_nearest_cells_in_order():
    import numpy as np
    rng = np.random.default_rng(0)
    x, a, b = rng.normal(size=(20, 8)), rng.normal(size=(6, 4)), rng.normal(size=(6, 4))
    got = embeddings.visits(x, a, b, 10)
    for v, cells in zip(x, got):
        d = ((v[:4] - a) ** 2).sum(1)[:, None] + ((v[4:] - b) ** 2).sum(1)
        assert np.allclose(np.sort(d.ravel())[:10], d.ravel()[cells])
