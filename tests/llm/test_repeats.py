"""Operator 8: identity of documents, runs of several sources, whole copies, hot anchors, and line classes
against a plain version."""

import random
from collections import Counter, defaultdict

import numpy as np

from aggrex.llm import paragraphs
from plain import Groups


def prose(rng, n):
    return " ".join(f"{rng.choice('bcdfgh')}{rng.randrange(4000)}" for _ in range(n))


def report(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string, class_id string").repartition(4)
    return paragraphs.repeated_report(docs, **kw).collect()


def test_unlike_texts_of_one_id_are_documents_of_their_own(spark):
    rng = random.Random(1)
    passage = prose(rng, 60)
    rows = [(1, f"{prose(rng, 70)} {passage} {prose(rng, 70)}", ""), (2, f"{passage} {prose(rng, 140)}", ""),
            (2, prose(rng, 200), ""), (2, prose(rng, 200), "")]
    got = sorted((r.doc_id, r.removed) for r in report(spark, rows) if r.n_removed)
    assert got == [(2, "0:60")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class_id string")
    left = sorted(len(r.text.split()) for r in paragraphs.remove_runs(docs, paragraphs.repeated_runs(docs)).collect())
    assert left == [140, 200, 200, 200]


def test_short_phrases_of_many_sources_are_no_run(spark):
    """Every phrase of 11 words stands in some other document, no run of 20 words stands anywhere else."""
    rng = random.Random(2)
    phrases = [prose(rng, 11) for _ in range(120)]
    rows = [(d, "\n".join(rng.sample(phrases, 6)), "") for d in range(40)]
    texts = [r[1].split("\n") for r in rows]
    pairs = Counter(p for t in texts for p in zip(t, t[1:]))
    rows = [r for r, t in zip(rows, texts) if all(pairs[p] == 1 for p in zip(t, t[1:]))]
    got = report(spark, rows)
    assert len(got) == len(rows) > 30 and not any(r.n_removed for r in got)
    assert all(r.class_ids for r in got)  # what repeats is listed all the same


def test_a_run_within_one_source_is_removed_beside_another(spark):
    rng = random.Random(3)
    a, b = prose(rng, 40), prose(rng, 40)
    got = {r.doc_id: r for r in report(spark, [(1, f"{prose(rng, 50)} {a}", ""), (2, f"{b} {prose(rng, 50)}", ""),
                                              (3, f"{prose(rng, 30)} {a} {b} {prose(rng, 30)}", "")])}
    assert got[3].removed_words >= 78 and got[3].of_docs == [1, 2] and not got[1].n_removed and not got[2].n_removed
    assert set(got[3].class_ids) & set(got[1].class_ids) and set(got[3].class_ids) & set(got[2].class_ids)


def test_whole_copies_are_one_run(spark):
    rng = random.Random(4)
    text = prose(rng, 90)
    rows = [(i, text, "") for i in range(5, 60)] + [(5, text, ""), (70, f"{prose(rng, 40)} {text}", ""), (71, "", ""),
                                                    (72, "", ""), (None, text, ""), (73, None, "")]
    got = report(spark, rows)
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert not by_id[5].n_removed and all(by_id[i].removed == "0:90" and by_id[i].of_docs == [5] for i in range(6, 60))
    assert by_id[70].removed_words >= 88 and by_id[70].of_docs == [5]
    assert by_id[5].class_ids and set(by_id[6].class_ids) <= set(by_id[5].class_ids)
    assert by_id[71].class_ids == [] or by_id[71].n_removed == 0
    assert by_id[None].class_ids == [] and by_id[73].class_ids == []


def test_hot_anchors_are_dealt_in_slices(spark, monkeypatch):
    rng = random.Random(5)
    passage = prose(rng, 55)
    rows = [(i, f"{prose(rng, 30)} {passage} {prose(rng, 30)}", "") for i in range(120)]
    want = sorted(tuple(map(str, r)) for r in report(spark, rows))
    monkeypatch.setattr(paragraphs, "UNIT_ROWS", 8)
    got = report(spark, rows)
    assert sorted(tuple(map(str, r)) for r in got) == want
    assert all(r.n_removed == (r.doc_id > 0) for r in got)
    assert all(54 <= r.removed_words <= 56 and 0 in r.of_docs for r in got if r.doc_id)


def test_word_hashes_tell_regular_words_apart():
    words = ["".join("ab"[i.bit_count() & 1] for i in range(1 << k)) for k in (10, 11, 12)]
    words += [w.translate({97: "b", 98: "a"}) for w in words] + ["a", "aa", "a\0", "ab" * 8, "ab" * 9, "é"]
    w, _, _ = paragraphs.Cutter()._hashes([" ".join(words)])
    assert len(np.unique(w)) == len(words)
    a, b = "x", "y"
    lines = [" ".join((a, b)[i.bit_count() & 1] for i in range(1024)), " ".join((b, a)[i.bit_count() & 1] for i in range(1024))]
    p = paragraphs.Cutter().paragraphs(["\n".join(lines)])
    assert len(set(p["content"][p["parts"]:].tolist())) == 2


def test_line_classes_equal_a_plain_version(spark):
    """Lines too short to be cut; every pair of lines by exact Jaccard similarity of five-word shingles."""
    rng = random.Random(6)
    base = [prose(rng, rng.randrange(1, 12)) for _ in range(60)]
    rows = []
    for d in range(80):
        lines = []
        for _ in range(rng.randrange(1, 7)):
            line = rng.choice(base).split() if rng.random() < 0.4 else prose(rng, rng.randrange(1, 12)).split()
            if rng.random() < 0.3:
                line.append("more")
            lines.append(" ".join(line))
        rows.append((d, "\n".join(lines), ""))
    lines = sorted({x for _, t, _ in rows for x in t.split("\n")})

    def shingles(x):
        w = x.split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}

    groups = Groups(len(lines))
    sets = [shingles(x) for x in lines]
    for i in range(len(lines)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and shared >= 0.8 * len(sets[i] | sets[j]):
                groups.join(i, j)
    places, members = Counter(), defaultdict(set)
    for d, t, _ in rows:
        for x in t.split("\n"):
            c = groups.root(lines.index(x))
            places[c] += 1
            members[c].add(d)
    want = sorted(tuple(sorted(members[c])) for c, n in places.items() if n > 1)
    got = defaultdict(set)
    for r in report(spark, rows, least_run=1000):
        for c in r.class_ids:
            got[c].add(r.doc_id)
    assert len(want) > 20 and sorted(tuple(sorted(m)) for m in got.values()) == want


def test_texts_that_the_copy_filter_takes_for_repeated_are_not_left_out(spark):
    """Half of the texts have copies, so the Bloom filter of copies knows a few per cent of the others by mistake."""
    rng = random.Random(31)
    passage = prose(rng, 30)
    rows = [(i, f"copy {i % 7000} {prose(random.Random(i % 7000), 3)}", "") for i in range(14_000)]
    alone = range(20_000, 20_400)
    rows += [(i, f"{prose(rng, 6)}\n{passage}\n{prose(rng, 6)}", "") for i in alone]
    got = {r.doc_id: r for r in report(spark, rows) if r.doc_id in alone}
    assert len(got) == 400 and got[20_000].n_removed == 0
    assert [i for i in alone if i > 20_000 and got[i].removed_words < 20] == []
    assert all(set(got[i].class_ids) & set(got[20_000].class_ids) for i in alone)
