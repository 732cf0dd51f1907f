"""Operator 12: phrase collocations by multikey quicksort of suffix pointers.

Every place of a text starts a suffix of up to ``LONGEST`` words. Suffixes are routed
by their leading words to ranges that hold about as many each (the bounds come from a
sample, which decides nothing but the balance), and a range's pointers are sorted by
three-way multikey quicksort: a pivot word cuts a partition into smaller, equal and
greater; the equal part is a phrase, its size the phrase's count, and goes on with the
next word, down to the full depth. Partitions too small for any frequent phrase are
abandoned at once. A range's bound may cut through a phrase, so what touches a range's
first or last suffix is never abandoned, and counts are added up over ranges.

Words travel as 64-bit hashes of (language, word), so languages never mix; a hash that
two words share, one of them or both together frequent, is looked for over all words,
and the pass starts again with another salt. Equal suffixes of a batch are one pointer
with a weight before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aggrex.llm.bpe import text_batches
from aggrex.llm.common import materialise, pick, shuffle_partitions

LONGEST = 4  # words of a phrase
LEAST = 30  # occurrences of a candidate
DROP_PERCENT = 80  # a longer candidate with this share of the occurrences stands for what it holds
SCALE = 2_000_000  # of scores
TOP = 2_000  # phrases returned per language
NO_LANGUAGE = "und"
BATCH_CHARS = 8 << 20  # of text, whose equal suffixes are combined before the shuffle
UNIT = 1 << 20  # suffixes of a range aimed at
MOST_UNITS = 1 << 20  # ranges; their bounds (32 bytes each) go to every task
SAMPLE_EVERY = 1024  # a suffix in so many is a sample for the bounds
MOST_SAMPLES = 1 << 20  # samples gathered on the driver; thinned by hash beyond
SALTS = 64  # parts in which a language's best phrases are looked for first
# What ends a piece becomes a line end, tabs blanks.
PIECE_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")


class _Numbers(dict):
    """Words of a batch, numbered as they come; 0 ends a piece, -1 is nothing."""

    def __missing__(self, word):
        n = self[word] = len(self) - 1
        return n


def _languages(batch, texts):
    """(language, word of each number, numbers in order) per language of a batch.

    Number 0 stands between pieces; texts end pieces, too.
    """
    import numpy as np

    parts: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), texts):
        if text:
            parts.setdefault(lang, []).append(text.encode())
    for lang, coded in parts.items():
        # On bytes, lower() touches A-Z alone.
        data = b"\n".join(coded).lower().translate(PIECE_ENDS)
        tokens = data.replace(b"\n", b" \n ").split(b" ")
        numbers = _Numbers({b"": -1, b"\n": 0})
        got = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
        yield lang, list(numbers)[1:], got[got >= 0]


def _codes(lang: str, words: list[bytes], salt: int):
    """64-bit hashes by number; 0 for the end of a piece."""
    import numpy as np
    import xxhash

    seed = xxhash.xxh64_intdigest(lang.encode(), salt)
    digest = xxhash.xxh64_intdigest
    return np.array([0] + [digest(w, seed) for w in words[1:]], np.uint64)


def _suffixes(numbers, depth: int):
    """Numbers of the ``depth`` words from every place on, 0 from the end of the piece on; and the places."""
    import numpy as np

    padded = np.append(numbers, np.zeros(depth, np.int64))
    start = np.flatnonzero(numbers)
    out = np.empty((depth, len(start)), np.int64)
    alive = np.ones(len(start), bool)
    for d in range(depth):
        word = padded[start + d]
        alive &= word > 0
        out[d] = np.where(alive, word, 0)
    return out


def _combined(columns, base: int):
    """(distinct suffixes as columns, how often each occurs); exact, by ranks where a product would overflow."""
    import numpy as np

    if not columns.shape[1]:
        return columns, np.zeros(0, np.int64)
    key = columns[0]
    decode = []
    size = base
    for column in columns[1:]:
        if size * base >= 1 << 62:
            values, key = np.unique(key, return_inverse=True)
            decode.append(values)
            size = len(values)
        else:
            decode.append(None)
        key = key * base + column
        size *= base
    key, times = np.unique(key, return_counts=True)
    out = []
    for values in reversed(decode):
        key, word = np.divmod(key, base)
        out.append(word)
        if values is not None:
            key = values[key]
    return np.stack([key, *reversed(out)]), times


def _word_counts(docs: DataFrame, salt: int, depth: int) -> DataFrame:
    """(lang, word, code, suffix, n): occurrences of words; and samples of suffixes, without a word."""
    schema = "lang string, word string, code bigint, suffix array<bigint>, n bigint"

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        for b, texts in text_batches(batches, rows=1 << 16, chars=BATCH_CHARS):
            for lang, words, numbers in _languages(b, texts):
                codes = _codes(lang, words, salt)
                times = np.bincount(numbers, minlength=len(words))[1:]
                n = len(times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n, pa.string()), pa.array([w.decode() for w in words[1:]], pa.string()),
                     pa.array(codes[1:].view(np.int64)), pa.nulls(n, pa.list_(pa.int64())), pa.array(times)],
                    ["lang", "word", "code", "suffix", "n"])
                suffixes = _suffixes(numbers, depth)
                first = xxhash.xxh32_intdigest(numbers[:4096].tobytes()) % SAMPLE_EVERY
                some = codes[suffixes[:, first::SAMPLE_EVERY]].T
                n = len(some)
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()),
                         pa.array(some.view(np.int64).tolist(), pa.list_(pa.int64())), pa.array(np.ones(n, np.int64))],
                        ["lang", "word", "code", "suffix", "n"])

    rows = docs.mapInArrow(run, schema)
    return rows.groupBy("lang", "word", "code", "suffix").agg(F.sum("n").alias("n"))


def _sortable(codes):
    """Suffixes (rows of unsigned 64-bit words) as byte strings in the same order."""
    import numpy as np

    return np.ascontiguousarray(codes.astype(">u8")).view(f"S{8 * codes.shape[1]}").ravel()


def _bounds(samples: DataFrame, units: int):
    """Suffixes that cut the samples into ``units`` ranges; a suffix with the share of several is repeated."""
    import numpy as np

    count = samples.count()
    if count > MOST_SAMPLES:
        samples = samples.where(F.pmod(F.xxhash64("suffix"), F.lit(-(-count // MOST_SAMPLES))) == 0)
    table = samples.select("suffix", "n").toArrow()
    if not table.num_rows or units < 2:
        return np.zeros(0, f"S{8 * LONGEST}")
    suffix = table.column("suffix").combine_chunks()
    rows = suffix.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(table.num_rows, -1)
    keys = _sortable(rows)
    order = np.argsort(keys, kind="stable")
    upto = np.cumsum(table.column("n").to_numpy()[order])
    cut = np.searchsorted(upto, upto[-1] * np.arange(1, units) / units)
    return keys[order][np.minimum(cut, len(keys) - 1)]


def multikey_quicksort(words, weight, least: int):
    """(pointer, length, count) of the phrases that occur ``least`` times in the rows of
    ``words`` (columns of numbers, 0 after the end; each row counts ``weight`` times), and
    of those, whatever their count, that are the start of the least or the greatest row.

    All partitions are cut by their pivots in one step over the arrays; the equal parts
    go one word deeper, parts below ``least`` are abandoned.
    """
    import numpy as np

    depth_most, n = words.shape
    if not n:
        return (np.zeros(0, np.int64),) * 3
    flat = np.ascontiguousarray(words.T).ravel()  # word d of row r stands at r * depth + d

    def extreme(best):
        rows = np.arange(n)
        out = []
        for d in range(depth_most):
            column = words[d, rows]
            out.append(best(column))
            rows = rows[column == out[-1]]
        return np.array(out)

    edges = [extreme(np.min), extreme(np.max)]
    pointer, size, depth = np.arange(n), np.array([n]), np.zeros(1, np.int64)
    edge = np.ones((2, 1), bool)  # the partition may hold the least, the greatest row
    found = []
    while len(size):
        begin = np.cumsum(size) - size
        key = flat[pointer * depth_most + np.repeat(depth, size)]
        # The median of three rows of the partition is its pivot.
        a, b, c = key[begin], key[begin + size // 2], key[begin + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))
        of = np.repeat(pivot, size)
        own = weight[pointer]
        at_edge = np.stack([e[depth] for e in edges])
        parts = []
        for mask, near in ((key < of, at_edge < pivot), (key == of, at_edge == pivot), (key > of, at_edge > pivot)):
            sizes = np.add.reduceat(mask, begin, dtype=np.int64)
            total = np.add.reduceat(np.where(mask, own, 0), begin)
            near = edge & near
            parts.append([mask, sizes, total, near, (sizes > 0) & ((total >= least) | near.any(axis=0))])
        mask, sizes, total, near, keep = parts[1]
        keep &= pivot > 0  # the end of a piece is no word
        inside = pointer[mask]
        first = np.minimum(np.cumsum(sizes) - sizes, max(0, len(inside) - 1))
        found.append((inside[first[keep]], depth[keep] + 1, total[keep]))
        keep &= depth + 1 < depth_most
        kept = [(pointer[mask][np.repeat(keep, sizes)], sizes[keep], depth[keep] + deeper, near[:, keep])
                for (mask, sizes, total, near, keep), deeper in zip(parts, (0, 1, 0))]
        pointer, size, depth = (np.concatenate([k[i] for k in kept]) for i in range(3))
        edge = np.concatenate([k[3] for k in kept], axis=1)
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


def _routed(docs: DataFrame, bounds, units: int, parts: int, salt: int, depth: int) -> DataFrame:
    """(part, unit, codes, places, times): the suffixes of a batch that belong to a unit; places are
    numbers of the codes, row by row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(bounds)  # at most MOST_UNITS of 32 bytes

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        names = ["part", "unit", "codes", "places", "times"]
        for b, texts in text_batches(batches, rows=1 << 16, chars=BATCH_CHARS):
            for lang, words, numbers in _languages(b, texts):
                codes = _codes(lang, words, salt)
                columns, times = _combined(_suffixes(numbers, depth), len(words))
                if not len(times):
                    continue
                keys = _sortable(codes[columns].T)
                low = np.searchsorted(shared.value, keys, "left")
                high = np.searchsorted(shared.value, keys, "right")
                # A suffix that is several bounds at once may go to any of the ranges around them.
                unit = low + xxhash.xxh32_intdigest(numbers[:4096].tobytes()) % (high - low + 1)
                order = np.argsort(unit, kind="stable")
                columns, times, unit = columns[:, order], times[order], unit[order]
                first = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
                rows = []
                for s, e in zip(first.tolist(), np.append(first[1:], len(unit)).tolist()):
                    own, places = np.unique(columns[:, s:e].T.ravel(), return_inverse=True)
                    small = np.uint16 if len(own) <= 1 << 16 else np.uint32
                    often = times[s:e]
                    rows.append((int(unit[s]) * parts // units, int(unit[s]), codes[own].tobytes(),
                                 places.astype(small).tobytes(),
                                 often.astype(np.uint16 if often.max() < 1 << 16 else np.int64).tobytes()))
                    if len(rows) == 1024 or e == len(unit):
                        types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows = []

    return docs.mapInArrow(run, "part int, unit int, codes binary, places binary, times binary")


def _counted(routed: DataFrame, parts: int, least: int, depth: int) -> DataFrame:
    """(codes, n): phrases of every unit; those at its ends may be parts of a count."""

    def phrases(rows):
        import numpy as np
        import pyarrow as pa

        own = [np.frombuffer(c, np.uint64) for c, _, _ in rows]
        every = np.unique(np.concatenate([np.zeros(1, np.uint64), *own]))
        words, weight = [], []
        for code, (_, places, times) in zip(own, rows):
            n = len(places) // depth
            wide = len(code) > 1 << 16
            place = np.frombuffer(places, np.uint32 if wide else np.uint16).reshape(-1, depth)
            words.append(np.searchsorted(every, code).astype(np.int32)[place].T)
            n = len(place)
            weight.append(np.frombuffer(times, np.uint16 if len(times) == 2 * n else np.int64).astype(np.int64))
        words, weight = np.concatenate(words, axis=1), np.concatenate(weight)
        pointer, length, count = multikey_quicksort(words, weight, least)
        signed = every.view(np.int64)
        for s in range(0, len(pointer), 50_000):
            at, size = pointer[s:s + 50_000], length[s:s + 50_000]
            table = signed[words[:, at].T]
            inside = np.arange(depth) < size[:, None]
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)),
                                             pa.array(table[inside]))
            yield pa.RecordBatch.from_arrays([lists, pa.array(count[s:s + 50_000])], ["codes", "n"])

    def run(batches):
        unit, held = None, []
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("unit", "codes", "places", "times")]
            for u, *row in zip(*cols):
                if u != unit:
                    if held:
                        yield from phrases(held)
                    unit, held = u, []
                held.append(row)
        if held:
            yield from phrases(held)

    dealt = routed.repartitionById(parts, "part").sortWithinPartitions("unit")
    found = dealt.drop("part").mapInArrow(run, "codes array<bigint>, n bigint")
    return found.groupBy("codes").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                  longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """((codes, n), (lang, word, code, n)): phrases of one to ``longest`` words that occur
    ``least`` times in their language, and all words."""
    spark = docs.sparkSession
    docs = pick(docs, text=text_col, lang=lang_col).withColumn("lang", F.coalesce("lang", F.lit(NO_LANGUAGE)))
    for salt in range(20):
        counted = materialise(_word_counts(docs, salt, longest), f"words-{salt}")
        words = counted.where("suffix is null").select("lang", "word", "code", "n")
        shared = (words.groupBy("code").agg(F.count("*").alias("words"), F.sum("n").alias("n"))
                  .where(f"(words > 1 and n >= {least}) or code = 0"))
        if shared.isEmpty():
            break
    else:
        raise RuntimeError("no salt keeps the words apart")
    places = words.agg(F.sum("n")).first()[0] or 0
    parts = shuffle_partitions(spark)
    units = min(MOST_UNITS, max(parts, -(-places // UNIT)))
    bounds = _bounds(counted.where("suffix is not null"), units)
    found = _counted(_routed(docs, bounds, units, parts, salt, longest), parts, least, longest)
    return materialise(found, "phrases"), words


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                 longest: int = LONGEST, drop_percent: int = DROP_PERCENT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: per language the ``top`` phrases of 2 to
    ``longest`` words by score, then count, descending, then phrase.

    a is the phrase's count, l and r those of its two parts at the cut that gives the
    lowest score (SCALE * a / (l + r), rounded down), n the language's words.
    Phrases inside a longer candidate that has drop_percent of their count are
    dropped. Words are compared with A-Z in lower case; pieces end at
    ``[.,;:!?\\n-\\r]`` and at a text's end. NULL texts are empty, NULL languages are
    'und'; repeated rows count each; other columns are not read. An empty table,
    and one without frequent phrases, gives an empty result.
    """
    counts, words = phrase_counts(docs, text_col, lang_col, least, longest)
    candidates = counts.where(F.size("codes") > 1).select("codes", F.col("n").alias("a"))
    # The parts of a candidate occur as often as it does, so their counts are all there.
    cuts = candidates.select("codes", "a", F.explode(F.sequence(F.lit(1), F.size("codes") - 1)).alias("k"))
    cuts = cuts.select("codes", "a", "k", F.slice("codes", F.lit(1), F.col("k")).alias("left"),
                       F.slice("codes", F.col("k") + 1, F.size("codes") - F.col("k")).alias("right"))
    scored = (cuts.join(counts.select(F.col("codes").alias("left"), F.col("n").alias("l")), "left")
              .join(counts.select(F.col("codes").alias("right"), F.col("n").alias("r")), "right")
              .withColumn("score", F.expr(f"(cast({SCALE} as decimal(19, 0)) * cast(a as decimal(19, 0)))"
                                          " div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")))
    lowest = scored.groupBy("codes", "a").agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("s"))
    # Every phrase of two words or more inside a longer one, with the longer one's count.
    spans = [(s, n) for n in range(2, longest) for s in range(longest - n + 1)]
    inner = F.array(*[F.when(F.size("codes") >= s + n + (s == 0), F.slice("codes", s + 1, n)) for s, n in spans])
    inside = (candidates.where(F.size("codes") > 2).select(F.explode(inner).alias("codes"), F.col("a").alias("longer"))
              .where("codes is not null").groupBy("codes").agg(F.max("longer").alias("longer")))
    covered = inside.join(candidates, "codes").where(
        f"cast(longer as decimal(38, 0)) * 100 >= cast(a as decimal(38, 0)) * {drop_percent}").select("codes")
    kept = materialise(lowest.join(covered, "codes", "left_anti"), "candidates")
    # Names: at most ``longest`` words a phrase.
    named = (kept.select("codes", F.posexplode("codes").alias("at", "code"))
             .join(words.where(F.col("n") >= least).select("code", "lang", "word"), "code")
             .groupBy("codes").agg(F.first("lang").alias("lang"), F.array_join(F.transform(F.array_sort(
                 F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    rows = kept.join(named, "codes").select("lang", "phrase", "a", "s.l", "s.r", "s.score")
    # A language may hold most phrases: the best of each part first, then the best of these.
    best = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).where(
        F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(
        F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return rows.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                            "n", F.col("score").cast("long").alias("score"))
