"""Operator 13: base counts against a plain version, fences against plain quartiles, odd rows."""

import re
from collections import defaultdict

from aggrex.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i:i + 8])].append(i)
    repeated = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(repeated))


def counts(df):
    return sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                   r.n_repeat_words) for r in df.collect())


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words string")
    want = sorted((d, *plain_counts(t)) for d, t, *_ in rows)
    got = quality_rules.judge(docs)
    assert counts(got) == want
    for r in got.collect():
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_counts_equal_the_plain_version(spark):
    eight = "a b c d e f g h"
    rows = [(1, f"{eight} x {eight} y z {eight}", "en", "s", ""), (2, "w " * 30, "en", "s", ""),
            (3, "w " * 8, "en", "s", ""), (4, "w " * 7, "en", "s", ""), (5, f"{eight} b c d e f g h", "en", "s", ""),
            (6, "one\n\none\n \n\t\none \none\r\none", None, None, ""), (7, "#a *b $ % & | < > é\U0001F600 ", "", "", ""),
            (8, None, None, "s", ""), (9, "", "en", None, ""), (10, " \t\n\x0b\x0c\r", "en", "s", ""),
            (11, "    a b " * 9, "en", "s", ""), (11, "again", "en", "s", ""), (11, "again", "en", "s", ""),
            (12, " ".join(f"u{i}" for i in range(40_000)) + f" {eight} {eight}", "en", "s", ""),
            (13, "a b " * 20, "en", "s", ""), (14, "x" * 100_000, "en", "s", "")]
    check(spark, rows)


def test_counts_on_the_documents(spark, docs):
    want = sorted((r.doc_id, *plain_counts(r.text)) for r in docs.collect())
    assert counts(quality_rules.judge(docs)) == want


def test_odd_rows_and_an_empty_table(spark, odd_docs, no_docs):
    from pyspark.sql import functions as F
    odd = odd_docs.select("doc_id", "text", F.col("pii").alias("lang"), F.lit(None).cast("string").alias("source"),
                          F.lit(1).alias("kept"), F.lit(2).alias("measure"))
    got = quality_rules.judge(odd)
    assert sorted(map(str, got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words").rdd.map(tuple).collect())) == sorted(
        str((r.doc_id, *plain_counts(r.text))) for r in odd.collect())
    assert quality_rules.judge(odd).count() == odd.count()
    assert quality_rules.judge(odd.where("false")).count() == 0
    assert quality_rules.keep_good(odd).columns == odd.columns


def test_sketch_merges_and_follows_the_group(spark):
    """A source whose documents hold many symbols keeps them; the same document is rejected elsewhere."""
    def text(i, symbols):
        return " ".join(f"w{i}x{k}" + "#" * (k < symbols) for k in range(40))

    rows = [(i, text(i, 1), "en", "plain") for i in range(300)]
    rows += [(1000 + i, text(i, 25), "en", "marked") for i in range(300)]
    rows += [(2000, text(7, 25), "en", "plain"), (2001, text(8, 25), "en", "marked")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: (r.kept, r.failed) for r in quality_rules.judge(docs).collect()}
    assert got[2000] == (False, "symbol_rate") and got[2001] == (True, "")
    assert sum(not k for k, _ in got.values()) == 1

    measured = quality_rules.measure(docs)
    whole = quality_rules.merge(quality_rules.sketch(measured), ["lang"]).collect()
    halves = [quality_rules.sketch(measured.where(f"doc_id % 2 = {i}")) for i in (0, 1)]
    merged = quality_rules.merge(halves[0].unionByName(halves[1]), ["lang"]).collect()
    assert sorted(map(str, whole)) == sorted(map(str, merged))


def test_sketch_quartiles_are_within_their_bound(spark):
    import numpy as np

    values = (np.random.default_rng(3).pareto(1.0, 5000) * 500).astype(int)
    df = spark.createDataFrame([(int(v),) for v in values], "value long").selectExpr(
        "'a' lang", "'b' source", "'m' measure",
        "value - value % (1L << greatest(length(bin(value)) - 6, 0)) AS bin").groupBy(
        "lang", "source", "measure", "bin").count().withColumnRenamed("count", "n")
    r = quality_rules.quartiles(df, ["lang", "source"]).first()
    for got, q in ((r.q1, 25), (r.q3, 75)):
        true = np.percentile(values, q, method="inverted_cdf")
        assert true * 31 / 32 - 1 <= got <= true
