"""Operator 3: benchmark decontamination by CGK embedding and bit-sampling LSH.

The CGK random walk reads a sequence of words: at step j it notes the word it
stands on and moves on or stays, by bit j of the word's hash. Two sequences
that stand on the same word move alike, so after an edit the walks meet again,
and a small edit distance becomes a small Hamming distance of the notes. Keys
are samples of the notes of a window; windows of texts that share a key with a
window of an item are candidates, and an exact edit distance decides.

Item windows start at every word that leaves a window of enough words; windows
of a text start at every ``stride``-th word, so whatever place a passage has,
some window of the text starts on the word of an item window. A window is as
long as what is left of the item (by size class). A walk's notes don't depend
on the window's length, so one walk per place serves all classes. How many keys
are drawn is tuned on edited copies of the items until every length class of
them reaches the target recall.

Short items have too few windows for that. They, and classes that miss the
target with the most keys, are found exactly: cut into one piece more than they
may have edits, one piece at least is in the text as it is. The cuts are chosen
so that the pieces' words are rare, and where a piece occurs, enough of the
item's other words must stand near their places before anything else is done.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aggrex.llm.bpe import text_batches
from aggrex.llm.common import pick

SIMILARITY = 0.8  # 1 - edits / length of the item, in words
LEAST_WORDS = 5  # items of fewer words are in too many texts to tell anything
STRIDE = 7
WINDOW = 9  # least words of an item window; items with fewer are one window
CLASSES = (LEAST_WORDS, 6, 7, WINDOW, 13, 20, 30, 45, 70, 110, 170, 256)  # window sizes, in words
NOTES = 4  # notes per key
KEYS = (4, 8, 12, 16, 24)  # keys per class and walk, tried until the target recall
TARGET = 0.95  # of the copies of each length class
SHORT = 18  # items of fewer words are found by pieces: keys miss the target on them (README)
LENGTHS = (SHORT, 25, 35, 50, 80, 130, 256)  # least words of the length classes
INDEX_BYTES = 64 << 20  # index sent to the executors at a time; more items take more passes
WORD_BYTES = KEYS[-1] * 16 + 200  # most that a word of an item adds to an index: a window's keys, the word in list and set
PAIRS = 1 << 18  # occurrences of pieces times their items looked at together
REMEMBER = 300_000


def _words(text: str) -> list[str]:
    return text.lower().split()


def _mix(x, salt: int):
    import numpy as np

    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(30))


def walk(symbols, starts, steps: int):
    """Notes (steps x starts) of the walks from ``starts``; symbol 0 stands for the end and holds the walk."""
    import numpy as np

    at = starts.copy()
    notes = np.empty((steps, len(starts)), np.uint64)
    bits = symbols
    with np.errstate(over="ignore"):
        for j in range(steps):
            if j % 64 == 0 and j:
                bits = np.where(symbols == 0, np.uint64(0), _mix(symbols, j))
            notes[j] = symbols[at]
            at += ((bits[at] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64)
    return notes


@cache
def _samples(size: int, keys: int):
    """The sampled steps of each key, for windows of ``size`` words (walks cover about half a word a step)."""
    import numpy as np

    rng = np.random.default_rng(size * 1000 + 17)
    steps = max(NOTES, int(1.5 * size))
    return [np.sort(rng.choice(steps, NOTES, replace=False)) for _ in range(keys)]


def _keys(notes, size: int, keys: int):
    """Per key an array of hashes, one per walk."""
    import numpy as np

    out = []
    with np.errstate(over="ignore"):
        for k, steps in enumerate(_samples(size, keys)):
            h = np.full(notes.shape[1], size * 64 + k + 1, np.uint64)
            for s in steps:
                h *= np.uint64(0x9E3779B97F4A7C15)
                h += notes[s]
            out.append(_mix(h, 71))
    return out


@dataclass
class Index:
    """Item windows by key, with the items."""

    ids: list
    words: list[list[str]]
    stride: int
    keys: int
    sizes: list[int] = field(default_factory=list)
    hashes: object = None  # sorted window keys
    item: object = None
    offset: object = None
    piece_sizes: list[int] = field(default_factory=list)
    pieces: tuple = ()  # sorted piece hashes, with item and offset
    short: object = None  # symbols of the items found by pieces, a row each, closed by 0
    row: object = None  # item -> row of ``short``

    def nbytes(self) -> int:
        """Bytes of the arrays and of the words."""
        arrays = [self.hashes, self.item, self.offset, *self.pieces, self.short, self.row]
        return sum(a.nbytes for a in arrays) + sum(60 + len(w) for ws in self.words for w in ws)

    def steps(self) -> int:
        return max(max(NOTES, int(1.5 * s)) for s in self.sizes)


def word_symbols(words: list[str], known: dict[str, int]):
    """Hashes of words, never 0."""
    import numpy as np
    import xxhash

    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w.encode()) or 1
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _size_class(left: int) -> int:
    return max(c for c in CLASSES if c <= max(left, CLASSES[0]))


def _length_class(n_words: int) -> int:
    """Least words of the item's length class; 0 for short items."""
    return max((c for c in LENGTHS if c <= n_words), default=0)


def cuts(words: list[str], counts: dict[str, int], pieces: int) -> list[int]:
    """Bounds that cut ``words`` into so many pieces with the least sum of expected occurrences.

    A piece is expected as often as its words' shares multiplied; ``counts`` are word
    counts (an unknown word counts as one). Any cut finds the same, the choice saves work.
    """
    from math import log2

    n, total = len(words), max(2, sum(counts.values()))
    rare = [log2(total) - log2(counts.get(w, 1)) for w in words]
    # best[b] = least sum for the first b words in so many pieces, with the bounds.
    best = {0: (0.0, [0])}
    for k in range(1, pieces + 1):
        step = {}
        for b in range(k, n - (pieces - k) + 1):
            bits = 0.0
            for a in range(b - 1, k - 2, -1):
                bits += rare[a]
                if a in best and (b not in step or best[a][0] + 2.0 ** -bits < step[b][0]):
                    step[b] = best[a][0] + 2.0 ** -bits, best[a][1] + [b]
        best = step
    return best[n][1]


def build_index(items: list[tuple], keys: int | None = None, exact: set[int] = frozenset({0})) -> Index:
    """Index of (id, text) items; ``keys``, and the length classes that are found by
    pieces (``exact``), are tuned if not given."""
    from collections import Counter

    import numpy as np

    words = [_words(t) for _, t in items]
    counts = Counter(w for ws in words for w in ws)
    if keys is None:
        keys, exact = _tuned(items)
    by_piece = [_length_class(len(w)) in exact for w in words]
    least = min((len(w) for w, x in zip(words, by_piece) if not x), default=WINDOW)
    stride = max(1, min(STRIDE, least - WINDOW + 1))
    index = Index([i for i, _ in items], words, stride, keys)
    known: dict[str, int] = {}
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32))
    index.row = np.full(len(words), -1, np.int32)
    index.row[by_piece] = np.arange(sum(by_piece))
    index.short = np.zeros((sum(by_piece), max((len(w) for w, x in zip(words, by_piece) if x), default=0) + 1),
                           np.uint64)
    parts, all_sizes, pieces, piece_sizes = [none], set(), [none], set()
    for n, ws in enumerate(words):
        symbols = np.append(word_symbols(ws, known), np.uint64(0))
        if by_piece[n]:
            index.short[index.row[n], :len(ws)] = symbols[:-1]
            bounds = cuts(ws, counts, budget(len(ws)) + 1)
            for a, b in zip(bounds, bounds[1:]):
                piece_sizes.add(b - a)
                pieces.append((_grams(symbols[a:b], b - a), np.array([n], np.int32), np.array([a], np.int32)))
            continue
        starts = np.arange(max(1, len(ws) - WINDOW + 1))
        by_size: dict[int, list[int]] = {}
        for o in starts.tolist():
            by_size.setdefault(_size_class(len(ws) - o), []).append(o)
        for size, offsets in by_size.items():
            all_sizes.add(size)
            offsets = np.array(offsets)
            notes = walk(symbols, offsets, max(NOTES, int(1.5 * size)))
            for h in _keys(notes, size, keys):
                parts.append((h, np.full(len(h), n, np.int32), offsets.astype(np.int32)))

    def in_order(rows):
        hashes, item, offset = (np.concatenate(x) for x in zip(*rows))
        order = np.argsort(hashes, kind="stable")
        return hashes[order], item[order], offset[order]

    index.sizes, index.piece_sizes = sorted(all_sizes), sorted(piece_sizes)
    index.hashes, index.item, index.offset = in_order(parts)
    index.pieces = in_order(pieces)
    return index


def _grams(symbols, size: int):
    """Hashes of all runs of ``size`` symbols."""
    import numpy as np

    n = max(0, len(symbols) - size + 1)
    h = np.full(n, size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + symbols[k:n + k]
        return _mix(h, 73)


def budget(n_words: int) -> int:
    """Edits that an item of so many words may have."""
    return int((1 - SIMILARITY) * n_words + 1e-9)


def _tuned(items: list[tuple]) -> tuple[int, set[int]]:
    """(keys, length classes to find by pieces): the fewest keys under which every class
    reaches the target; a class that the most keys miss is found by pieces."""
    classes: dict[int, list[tuple]] = {}
    for item in items:
        classes.setdefault(_length_class(len(_words(item[1]))), []).append(item)
    exact, most = {0}, KEYS[0]
    for c in sorted(classes.keys() - exact):
        reached = next((k for k in KEYS if _recall(classes[c], k) >= TARGET), None)
        if reached is None:
            exact.add(c)
        else:
            most = max(most, reached)
    return most, exact


def _recall(items: list[tuple], keys: int, most: int = 60, copies: int = 4, exact: set[int] = frozenset({0})) -> float:
    """Share of edited copies of the items, ``copies`` each at the least similarity, that are candidates."""
    import random

    rng = random.Random(3)
    some = rng.sample(items, min(most, len(items)))
    index = build_index(some, keys, exact)
    scanner = Scanner(index)
    found = 0
    for n, item in enumerate(index.words * copies):
        words = list(item)
        for _ in range(budget(len(item))):  # words replaced, inserted or dropped
            at = rng.randrange(len(words))
            words[at:at + 1] = [[f"x{rng.random()}"], [words[at], f"x{rng.random()}"], []][rng.randrange(3)]
        filler = [f"y{rng.random()}" for _ in range(rng.randrange(20, 40))]
        found += any(i == n % len(some) for _, i, _ in scanner.candidates([filler + words + filler]))
    return found / max(1, len(some) * copies)


def edit_distance_within(item, text) -> int:
    """Least edit distance of the sequence ``item`` to a contiguous part of ``text``.

    Bit-parallel dynamic programming over the item's symbols.
    """
    m = len(item)
    if not m:
        return 0
    where: dict = {}
    for i, symbol in enumerate(item):
        where[symbol] = where.get(symbol, 0) | 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = mask, 0, m
    best = m
    for symbol in text:
        eq = where.get(symbol, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        right = down | ~(xh | up) & mask
        left = up & xh
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        right, left = (right << 1) & mask, (left << 1) & mask
        up = left | ~(xv | right) & mask
        down = right & xv
        best = min(best, score)
    return best


class Scanner:
    """Candidates and verified matches of texts against an index."""

    def __init__(self, index: Index):
        import numpy as np

        self.index = index
        self.sets = [set(w) for w in index.words]
        self.known: dict[str, int] = {}
        self.table = np.zeros(1 << 22, bool)
        self.table[(index.hashes >> np.uint64(42)).astype(np.int64)] = True
        self.piece_table = np.zeros(1 << 22, bool)
        self.piece_table[(index.pieces[0] >> np.uint64(42)).astype(np.int64)] = True

    def candidates(self, texts: list[list[str]]):
        """(text number, item number, word where the item would start)."""
        import numpy as np

        index = self.index
        if len(self.known) > REMEMBER:
            self.known.clear()
        # Texts one after the other, each closed by the end symbol.
        flat, begin = [], []
        for ws in texts:
            begin.append(len(flat))
            flat += ws
            flat.append("")
        known = self.known
        known[""] = 1
        symbols = word_symbols(flat, known)
        begin = np.array(begin)
        stop = np.append(begin[1:], len(flat)) - 1
        symbols[stop] = 0
        out = set()

        # Room for shifts beyond both ends.
        room = index.short.shape[1]
        padded = np.pad(symbols, room)

        def near_places(start, item):
            """Whether an item that starts at ``start``, moved by as many words as it may have edits, misses no more
            words than that: true wherever the item is, as an edit takes one word of the item and moves the rest by one."""
            rows = index.short[index.row[item]]
            n = (rows != 0).sum(axis=1)
            most = (1 - SIMILARITY) * n + 1e-9
            most = most.astype(np.int64)
            here = np.zeros(rows.shape, bool)
            columns = np.arange(rows.shape[1])
            for shift in range(-int(most.max(initial=0)), int(most.max(initial=0)) + 1):
                mine = np.flatnonzero(most >= abs(shift))
                there = np.clip(start[mine, None] + columns + room + shift, 0, len(padded) - 1)
                here[mine] |= padded[there] == rows[mine]
            return (here & (rows != 0)).sum(axis=1) >= n - most

        def look_up(h, at, text, table, rows, check=None):
            hashes, item, offset = rows
            maybe = np.flatnonzero(table[(h >> np.uint64(42)).astype(np.int64)])
            if not len(maybe):
                return
            lo = np.searchsorted(hashes, h[maybe], "left")
            many = np.searchsorted(hashes, h[maybe], "right") - lo
            until = np.cumsum(many)
            # Occurrences times items, so many at a time.
            for s in range(0, int(until[-1]), PAIRS):
                pair = np.arange(s, min(s + PAIRS, int(until[-1])))
                p = np.searchsorted(until, pair, "right")
                r = lo[p] + pair - (until[p] - many[p])
                t, start, i = text[maybe[p]], at[maybe[p]] - offset[r], item[r]
                if check is not None:
                    good = check(start, i)
                    t, start, i = t[good], start[good], i[good]
                out.update(zip(t.tolist(), i.tolist(), (start - begin[t]).tolist()))

        if index.piece_sizes:
            everywhere = np.arange(len(flat))
            each = np.repeat(np.arange(len(texts)), stop + 1 - begin)
            for size in index.piece_sizes:
                look_up(_grams(symbols, size), everywhere, each, self.piece_table, index.pieces, near_places)
        if not index.sizes:
            return sorted(out)
        counts = -(-(stop - begin) // index.stride)
        of = np.repeat(np.arange(len(texts)), counts)
        starts = begin[of] + index.stride * (np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts))
        rows = index.hashes, index.item, index.offset
        for s in range(0, len(starts), 1 << 16):
            at, text = starts[s:s + (1 << 16)], of[s:s + (1 << 16)]
            notes = walk(symbols, at, index.steps())
            for size in index.sizes:
                for h in _keys(notes, size, index.keys):
                    look_up(h, at, text, self.table, rows)
        return sorted(out)

    def matches(self, texts: list[str]):
        """(text number, item id, edits, similarity, first word of the region searched), one per text and item."""
        words = [_words(t) for t in texts]
        best: dict[tuple[int, int], tuple] = {}
        tried: dict[tuple[int, int], list[int]] = {}
        for t, i, place in self.candidates(words):
            item = self.index.words[i]
            n, most = len(item), budget(len(item))
            known = best.get((t, i))
            if known and known[0] == 0:
                continue
            # Edits move the item's start by ``most`` at either side; a region searched nearby holds this one too.
            if any(abs(place - p) <= most for p in tried.get((t, i), ())):
                continue
            first = max(0, place - 3 * most - 1)
            region = words[t][first:max(0, place + n + 3 * most + 1)]
            # An edit takes one word of the item at most.
            if len(self.sets[i].difference(region)) > most:
                continue
            tried.setdefault((t, i), []).append(place)
            edits = edit_distance_within(item, region)
            if edits <= most and (known is None or edits < known[0]):
                best[t, i] = edits, first
        for (t, i), (edits, first) in sorted(best.items()):
            yield t, self.index.ids[i], edits, 1 - edits / len(self.index.words[i]), first


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, text, n_words) of the items searched for."""
    items = pick(benchmark, item_id=id_col, text=text_col).where("item_id is not null and text is not null")
    return items.withColumn("n_words", F.size(F.split(F.trim(F.regexp_replace(F.lower("text"), r"\s+", " ")), " "))
                            ).where(F.col("n_words") >= LEAST_WORDS)


def _slices(items: DataFrame):
    """Indexes of the items' different texts, under each text's SHA-256, of at most ``INDEX_BYTES`` each
    (or of one item, if its own windows take more)."""
    texts = items.select(F.sha2("text", 256).alias("item"), "text", "n_words").dropDuplicates(["text"])
    n_words = texts.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    parts = -(-n_words * WORD_BYTES // INDEX_BYTES)
    for p in range(parts):
        # A part's texts are a small share of its index; what the hash deals unevenly is cut here.
        mine = texts.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == p).orderBy("item")
        rows, size = [], 0
        for r in mine.collect():
            n = len(_words(r["text"]))
            if n < LEAST_WORDS:
                continue
            if rows and (size + n) * WORD_BYTES > INDEX_BYTES:
                yield build_index(rows)
                rows, size = [], 0
            rows.append((r["item"], r["text"]))
            size += n
        if rows:
            yield build_index(rows)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document row and item found in it: doc_id, item_id, edits, similarity, near_word.

    An item is found where some run of the text's words is within ``budget``
    word edits of the item's words (lower case, cut at white space). Items of fewer than ``LEAST_WORDS`` words or
    with a NULL id or text are not searched; NULL texts hold nothing; a NULL
    doc_id stays NULL; repeated rows are found each. Items with the same text are
    searched once and found under each id. The index goes to the executors in slices
    of bounded size, one pass over the documents each.
    """
    spark = docs.sparkSession
    table = pick(docs, doc_id=id_col, text=text_col)
    items = _items(benchmark, item_col, item_text_col)
    found = spark.createDataFrame([], FOUND)
    for index in _slices(items):
        found = found.unionByName(_scan(table, spark.sparkContext.broadcast(index)))
    return found.join(items.select("item_id", F.sha2("text", 256).alias("item")), "item").select(
        "doc_id", F.col("item_id").cast("long").alias("item_id"), "edits", "similarity", "near_word")


FOUND = "doc_id bigint, item string, edits int, similarity double, near_word int"


def _scan(table: DataFrame, shared) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        scanner = Scanner(shared.value)
        for b, texts in text_batches(batches):
            found = list(scanner.matches(texts))
            if found:
                ids = b.column("doc_id").cast(pa.int64())
                t, item, edits, similarity, first = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(t)), pa.array(item, pa.string()), pa.array(edits, pa.int32()),
                     pa.array(similarity, pa.float64()), pa.array(first, pa.int32())],
                    ["doc_id", "item", "edits", "similarity", "near_word"])

    return table.mapInArrow(run, FOUND)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item of the benchmark; columns as they were."""
    spark = docs.sparkSession
    for index in _slices(_items(benchmark, "item_id", "text")):
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            import pyarrow as pa

            scanner = Scanner(shared.value)
            for whole in batches:
                texts = whole.select([text_col]).rename_columns(["text"])
                at = 0
                for part, rows in text_batches([texts]):
                    hit = {m[0] for m in scanner.matches(rows)}
                    yield whole.slice(at, len(rows)).filter(pa.array([i not in hit for i in range(len(rows))]))
                    at += len(rows)

        docs = docs.mapInArrow(run, docs.schema)
    return docs
