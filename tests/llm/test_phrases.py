"""Operator 12 against plain counts."""

import re
from collections import Counter

import numpy as np
import pytest

from aggrex.llm import phrases

SCHEMA = "text string, lang string, n long, phrase string"


def plain_counts(rows, longest=4):
    counts, totals = Counter(), Counter()
    for text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", small):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    return counts, totals


def plain(rows, least=30, top=2000):
    counts, totals = plain_counts(rows)
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    dropped = {(p[0], *p[i:j]) for p, b in candidates.items() for i in range(1, len(p)) for j in range(i + 2, len(p) + 1)
               if j - i < len(p) - 1 and 100 * b >= 80 * candidates.get((p[0], *p[i:j]), 1 << 70)}
    by_lang = {}
    for p, a in candidates.items():
        if p in dropped:
            continue
        cuts = [(2_000_000 * a // (counts[p[:k + 1]] + counts[(p[0], *p[k + 1:])]), k) for k in range(1, len(p) - 1)]
        score, k = min(cuts)
        by_lang.setdefault(p[0], []).append(
            (-score, -a, " ".join(p[1:]).encode(), counts[p[:k + 1]], counts[(p[0], *p[k + 1:])]))
    return sorted((lang, i, p.decode(), -a, l, r, totals[lang], -s) for lang, found in by_lang.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1))


def found(spark, rows, parts=3, **kw):
    docs = spark.createDataFrame([(*r[:2], 1, "") for r in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, phrases.collocations(docs, **kw).collect()))


def prose(rng, n, words):
    return " ".join(f"{'T' if i % 9 == 0 else 't'}{int(w) % words}{'.,;:!?'[i % 6] if i % 11 == 0 else ''}"
                    for i, w in enumerate(rng.zipf(1.4, n)))


def test_equals_plain_counts(spark):
    rng = np.random.default_rng(1)
    rows = [(prose(rng, 400, 60), ["en", "de", None, "und"][i % 4]) for i in range(60)]
    want = plain(rows)
    assert len(want) > 100 and found(spark, rows) == want
    assert found(spark, rows, top=7) == plain(rows, top=7)


def test_pieces_case_and_white_space(spark):
    rows = [("New York.New  york\tNEW\nYork a\rb\x0bc\x0cd É é É é", "x")] * 20 + [("new york\x1cnew york", "x")] * 15
    want = plain(rows)
    assert want and found(spark, rows) == want


def test_odd_rows(spark):
    """NULL and empty texts and languages, one word repeated, very long texts, no blanks, repeated rows, empty tables."""
    rows = [(None, "a"), ("", None), (" \t\n.", "a"), ("w " * 20_000, "a"), ("x" * 100_000, "a"), ("one", "a"),
            ("a b c d e " * 40, None), ("a b c d e " * 40, "und"), ("\U0001F600 ß " * 50, ""), ("", "empty")]
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows[:3] + rows[5:6]) == []
    assert spark.createDataFrame([], SCHEMA).transform(phrases.collocations).count() == 0


def test_bounds_cut_through_phrases(spark, monkeypatch):
    """Small ranges, small batches, all suffixes as samples; a phrase in a third of the rows is several bounds."""
    monkeypatch.setattr(phrases, "UNIT", 64)
    monkeypatch.setattr(phrases, "SAMPLE_EVERY", 2)
    monkeypatch.setattr(phrases, "BATCH_CHARS", 300)
    rng = np.random.default_rng(2)
    rows = [(prose(rng, 60, 40), "en") for _ in range(60)] + [("the same old line again", "en")] * 60
    want = plain(rows)
    assert want and found(spark, rows) == want


def test_another_salt_when_words_share_a_hash(spark, monkeypatch):
    rows = [("alpha beta gamma delta. " * 40, "en"), ("epsilon zeta eta theta iota. " * 40, "en")]
    tried = []
    count = phrases._word_counts

    def first_collides(docs, salt, depth):
        tried.append(salt)
        out = count(docs, salt, depth)
        return out.withColumn("code", out["code"] % 5) if salt == 0 else out

    monkeypatch.setattr(phrases, "_word_counts", first_collides)
    assert found(spark, rows) == plain(rows) and tried == [0, 1]


@pytest.mark.parametrize("seed", range(4))
def test_multikey_quicksort(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 3000))
    words = rng.zipf(1.3, (4, n)).astype(np.int32) % 50
    words *= np.minimum.accumulate(words > 0, axis=0)
    words[0] = np.maximum(words[0], 1)
    weight = rng.integers(1, 4, n)
    counts = Counter()
    for row, w in zip(words.T.tolist(), weight.tolist()):
        for k in range(1, 5):
            if row[k - 1]:
                counts[tuple(row[:k])] += w
    at, length, count = phrases.multikey_quicksort(words, weight, 10)
    got = {tuple(words[:k, p].tolist()): c for p, k, c in zip(at, length.tolist(), count.tolist())}
    assert len(got) == len(at)
    rows = sorted(map(tuple, words.T.tolist()))
    ends = {r[:k] for r in (rows[0], rows[-1]) for k in range(1, 5) if r[k - 1]}
    assert got == {p: c for p, c in counts.items() if c >= 10 or p in ends}


def test_combined_suffixes_are_exact():
    rng = np.random.default_rng(3)
    for base in (7, 60_000, 1 << 20, 1 << 31):
        columns = rng.integers(0, min(base, 5), (4, 2000)) * (base // 5 or 1)
        got, times = phrases._combined(columns, base)
        assert dict(zip(map(tuple, got.T.tolist()), times.tolist())) == Counter(map(tuple, columns.T.tolist()))
