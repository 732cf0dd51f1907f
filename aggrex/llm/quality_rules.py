"""Operator 13: quality rules with thresholds that follow the data.

DataFrame expressions only. Every text is measured once (words, symbols,
repeated lines and words). The measures of the documents that pass the base
rules go into quantile sketches per language and source; the fences that judge
a document come from its own group's sketch, not from fixed cutoffs, and are
joined back to the measures.

The sketch is a histogram whose bins keep the leading six bits of a value: exact
below 64, within 1/32 above. Two sketches merge by adding counts, in any order
and with one result, so a language's sketch is the sum of its sources', and a
recomputed task changes nothing. A group holds a few hundred bins, whatever its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aggrex.llm.common import materialise, pick

WHITE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8  # words of a window that may repeat
LEAST_WORDS = 20  # fewer fail the base rules
REPEAT_PERCENT = 30  # more words than this in repeated windows fail the base rules
LEAST_GROUP = 200  # documents of a sketch that gives fences; smaller groups use their language's, then everyone's
SPREADS = 3  # interquartile ranges between a quartile and its fence
FEW_GROUPS = 20_000  # groups whose fences are broadcast (their number is counted); more are joined by a shuffle
# Measures that are judged: the least interquartile range, in the measure's own unit, that a group is taken to
# have, and whether low values are suspect too.
JUDGED = {
    "symbol_rate": (20, False),  # symbols per 1000 words
    "word_size": (50, True),  # hundredths of a code point per word
    "stutter_rate": (20, False),  # words equal to the word before, per 1000 words
    "dup_line_rate": (150, False),  # repeated lines per 1000 lines with a word
    "repeat_rate": (80, False),  # words in repeated windows per 1000 words
}


def _with_next(column: str, step: int) -> Column:
    """Every element hashed together with the one ``step`` places on."""
    return F.transform(column, lambda h, i: F.xxhash64(h, F.get(F.col(column), i + step)))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source") -> DataFrame:
    """doc_id, lang, source and the counts of every whole text; one pass, no shuffle.

    Words are runs without ASCII white space; NULL texts have none. Repeated
    windows are found by a sort of (hash, place) inside the row, only for texts in
    which some window's hash occurs twice, and confirmed on the words themselves.
    """
    d = pick(docs, doc_id=id_col, text=text_col, lang=lang_col, source=source_col)
    d = d.withColumn("text", F.coalesce("text", F.lit("")))
    d = d.withColumn("words", F.array_remove(F.split("text", f"{WHITE}+", -1), ""))
    d = d.withColumn("lines", F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.select(
        "doc_id", "lang", "source", "words", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w, i: F.get(F.col("words"), i + 1) == w)).cast("long").alias("n_stutters"),
        _with_next("words", 1).alias("two"))
    # Hashes of 2, 4 and 8 words from each place on. A column that an inner function reads is named outside of it
    # too, so that the optimizer computes it beforehand instead of once for every element.
    d = d.withColumn("four", F.when(F.size("two") > 0, _with_next("two", 2))).drop("two")
    d = d.withColumn("eight", F.when(F.size("four") > 0, _with_next("four", 4))).drop("four")
    d = d.withColumn("windows", F.when(F.size("words") >= WINDOW, F.slice(
        "eight", F.lit(1), F.size("words") - (WINDOW - 1)))).drop("eight")
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    d = d.withColumn("sorted", F.when(twice, F.sort_array(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))))

    def equal(x: Column, y: Column) -> Column:
        # Single words by place: slice() would copy the whole array each time.
        words = F.col("words")
        return F.coalesce(reduce(lambda a, b: a & b, [F.get(words, x["at"] + k) == F.get(words, y["at"] + k)
                                                      for k in range(WINDOW)], x["h"] == y["h"]), F.lit(False))

    found = F.filter("sorted", lambda x, j: equal(x, F.get(F.col("sorted"), j + 1))
                     | equal(x, F.get(F.col("sorted"), j - 1)))
    places = F.sort_array(F.transform(found, lambda x: x["at"]))
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, p: F.struct((p + WINDOW).alias("end"),
                                (acc["n"] + WINDOW - F.greatest(F.lit(0), acc["end"] - p)).alias("n")))
    return d.withColumn("n_repeat_words", F.coalesce(covered["n"], F.lit(0)).cast("long")).drop(
        "words", "windows", "sorted")


def _base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)


def _rates() -> dict[str, Column]:
    """The judged measures, as whole numbers; documents that pass the base rules have words."""
    def per(n: str, of: str, unit: int) -> Column:
        return F.expr(f"({n} * {unit}) div greatest({of}, 1)")

    return {"symbol_rate": per("n_symbols", "n_words", 1000), "word_size": per("word_chars", "n_words", 100),
            "stutter_rate": per("n_stutters", "n_words", 1000), "dup_line_rate": per("n_dup_lines", "n_lines", 1000),
            "repeat_rate": per("n_repeat_words", "n_words", 1000)}


def sketch(measures: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, n): the sketches of every language and source.
    A bin is the least value that falls into it. Counts are combined before the shuffle."""
    value = F.col("value")
    low = F.greatest(F.length(F.bin(value)) - 6, F.lit(0)).cast("int")
    every = measures.select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), rate.alias("value")) for m, rate in _rates().items()])).alias("m"))
    return (every.select("lang", "source", "m.measure", "m.value")
            .withColumn("bin", F.expr("value") - F.pmod(value, F.expr("1L") * F.pow(F.lit(2), low).cast("long")))
            .groupBy("lang", "source", "measure", "bin").agg(F.count("*").alias("n")))


def merge(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of coarser groups: counts add up."""
    return sketches.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(*by, measure, total, q1, q3): the bins that hold the lower and the upper quartile."""
    group = Window.partitionBy(*by, "measure")
    upto = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    return (sketches.withColumn("upto", upto).withColumn("total", F.sum("n").over(group))
            .groupBy(*by, "measure").agg(
                F.max("total").alias("total"), F.min(F.when(F.expr("upto * 4 >= total"), F.col("bin"))).alias("q1"),
                F.min(F.when(F.expr("upto * 4 >= total * 3"), F.col("bin"))).alias("q3")))


def fences(sketches: DataFrame) -> DataFrame:
    """(lang, source, low, high): maps from measure to the least and the greatest value that
    passes, for every group; groups of fewer than ``LEAST_GROUP`` documents take the fences of
    their language, and these of all documents."""
    own = quartiles(sketches, ["lang", "source"]).alias("own")
    language = quartiles(merge(sketches, ["lang"]), ["lang"]).alias("language")
    every = quartiles(merge(sketches, []), []).alias("every")
    joined = (own.join(language, (F.col("own.measure") == F.col("language.measure"))
                       & F.col("own.lang").eqNullSafe(F.col("language.lang")))
              .join(F.broadcast(every), F.col("own.measure") == F.col("every.measure")))  # one row per measure

    def chosen(c: str) -> Column:
        return (F.when(F.col("own.total") >= LEAST_GROUP, F.col(f"own.{c}"))
                .when(F.col("language.total") >= LEAST_GROUP, F.col(f"language.{c}")).otherwise(F.col(f"every.{c}")))

    flat = joined.select("own.lang", "own.source", "own.measure", chosen("q1").alias("q1"), chosen("q3").alias("q3"))
    least = F.create_map(*[F.lit(x) for m, (spread, _) in JUDGED.items() for x in (m, spread)])
    reach = F.greatest(F.col("q3") - F.col("q1"), least[F.col("measure")]) * SPREADS
    both = F.array(*[F.lit(m) for m, (_, low) in JUDGED.items() if low])
    flat = flat.withColumn("high", F.col("q3") + reach).withColumn(
        "low", F.when(F.array_contains(both, F.col("measure")), F.col("q1") - reach))

    def of(measure: str, side: str) -> Column:
        return F.max(F.when(F.col("measure") == measure, F.col(side))).alias(f"{measure}_{side}")

    return flat.groupBy("lang", "source").agg(
        *[of(m, "high") for m in JUDGED], *[of(m, "low") for m, (_, low) in JUDGED.items() if low])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """One row per document row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, and failed (the measures beyond their
    fences, comma-joined; '' for base failures).

    Documents that fail the base rules are not kept and enter no sketch. NULL
    languages and sources are groups of their own; NULL texts have no words and
    fail; NULL ids stay; repeated rows count each; other columns are not read. An
    empty table gives an empty result. Texts are read once; what moves is bin
    counts, and the fences are broadcast only when counted to be few.
    """
    measured = materialise(measure(docs, id_col, text_col, lang_col, source_col)
                           .withColumn("base_failed", _base_failed()), "measures")
    sketches = materialise(sketch(measured.where("not base_failed")), "sketches")
    limits = materialise(fences(sketches).withColumnsRenamed({"lang": "of_lang", "source": "of_source"}), "fences")
    if limits.count() <= FEW_GROUPS:
        limits = F.broadcast(limits)
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("of_lang"))
                           & F.col("source").eqNullSafe(F.col("of_source")), "left")
    rates = _rates()
    beyond = []
    for m, (_, low) in JUDGED.items():
        out = rates[m] > F.col(f"{m}_high")
        if low:
            out = out | (rates[m] < F.col(f"{m}_low"))
        beyond.append(F.when(out & ~F.col("base_failed"), F.lit(m)))
    return joined.withColumn("failed", F.concat_ws(",", *beyond)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("failed") == "")).alias("kept"), "failed")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              source_col: str = "source") -> DataFrame:
    """``docs`` without the rows that ``judge`` rejects; all columns stay. The verdict depends on the
    text, language and source alone, so rows are matched by these, NULLs included."""
    key = F.struct(*[F.col(c).alias(n) for c, n in ((text_col, "t"), (lang_col, "l"), (source_col, "s"))])
    columns = [docs[c] for c in docs.columns]
    keyed = docs.select(F.struct(*columns).alias("row"), F.sha2(F.to_json(key), 256).alias("key"),
                        docs[text_col].alias("text"), docs[lang_col].alias("lang"), docs[source_col].alias("source"))
    good = (judge(keyed.select("key", "text", "lang", "source"), id_col="key", text_col="text", lang_col="lang",
                  source_col="source").where("kept").select(F.col("doc_id").alias("key")).distinct())
    return keyed.join(good, "key", "left_semi").select("row.*")
