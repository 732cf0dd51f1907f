"""Operator 8: substring deduplication by paragraph MinHash banding.

Texts are cut into paragraphs: lines, and long lines at content-defined places
(a word pair whose hash is the least among its neighbours), so a passage that
stands in the middle of other text is cut alike in every document. MinHash
signatures of five-word shingles are banded; paragraphs that collide in a band
are verified by the exact Jaccard similarity of their shingles; verified links
and equal paragraphs form components. Lines of several parts are compared whole
as well, and removed whole.

Passages that keep to no cut are found by anchors: of every ``WINDOW`` word
grams in a row the one with the least hash, so that ``GRAM + WINDOW - 1`` equal
words hold an equal anchor wherever they stand. A repeated anchor is compared
with its first occurrence word by word, outwards and over edits, to the true
borders of the passage; pieces of one source are one passage as long as their
estimated Jaccard similarity, gaps included, is enough.

The first occurrence stays, the others are removed where they make up a run of
enough words. A whole text that several rows hold is compared once, for its first
row; the other rows lose it whole.

Texts are read twice for that and never shuffled. What moves is a band key and a content
hash per paragraph and band, pre-aggregated in the task; then, for paragraphs
and anchors that repeat or collide only (a Bloom filter of fixed size tells
which), their places and shingles, or the words around an anchor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aggrex.llm.bpe import text_batches
from aggrex.llm.common import connected_components, materialise, pick, shuffle_partitions

SHINGLE = 5
SIMILARITY = 0.8
REACH = 6  # a cut is the least of the hashes this many word pairs before and after it
LONGEST = 64  # words; longer paragraphs are cut here
RECALL = 0.99  # of pairs at SIMILARITY, that the bands must bring together
ROWS = 2  # signature values per band
LINE_ROWS = 4  # of whole lines, whose shingles are many: fewer unlike lines are brought together
LEAST_RUN = 20  # words of adjacent repeated paragraphs that are worth removing
UNIT_ROWS = 1024  # paragraphs of a bucket that one unit of work compares
GRAM = 8  # words of an anchor
WINDOW = 18  # grams in a row of which one is an anchor: 25 equal words hold one, half of 51 with one edit
AROUND = 48  # words before and after an anchor that are compared
REJOIN = 4  # equal words after an edit that continue a passage
FEW = 100_000  # rows of a counted table that may be broadcast
EDITS = ((1, 1), (1, 0), (0, 1), (2, 2))  # words skipped here and in the first occurrence


def bands_for(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> int:
    """Fewest bands under which a pair at ``similarity`` collides with probability ``recall``."""
    from math import ceil, log

    return ceil(log(1 - recall) / log(1 - similarity ** rows))


def _mix(x, salt: int):
    """A bijective scramble of 64-bit integers."""
    import numpy as np

    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Cutter:
    """Paragraphs of a batch of texts, as arrays.

    Words are runs of bytes that are no ASCII white space. Their hashes come
    from one pass over the batch's bytes. Sums that stand for sequences are over
    scrambled (item, place) pairs: no sequence is likelier to collide than others.
    """

    def __init__(self):
        import numpy as np

        self.powers = np.ones(1, np.uint64)
        self.white = np.zeros(256, bool)
        self.white[[9, 10, 11, 12, 13, 32]] = True

    def _hashes(self, texts):
        """Word hashes of all texts, the line and the text of each word."""
        import numpy as np

        coded = [t.encode() for t in texts]
        data = np.frombuffer(b"\n".join(coded), np.uint8)
        at = np.flatnonzero(~self.white[data])
        if not len(at):
            return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2
        first = np.flatnonzero(np.append(True, np.diff(at) > 1))
        size = np.diff(np.append(first, len(at)))
        start = at[first]
        inside = np.arange(len(at)) - np.repeat(first, size)
        # Eight bytes are one number; each is scrambled with its place in the word before they are added up.
        eight = np.flatnonzero(inside & 7 == 0)
        chunks = np.add.reduceat(data[at].astype(np.uint64) << ((inside & 7) << 3).astype(np.uint64), eight)
        chunks = _mix(chunks ^ _mix((inside[eight] >> 3).astype(np.uint64), 7), 13)
        w = _mix(np.add.reduceat(chunks, np.flatnonzero(inside[eight] == 0)) + size.astype(np.uint64), 13)
        begin = np.cumsum([0] + [len(c) + 1 for c in coded[:-1]])
        return w, np.searchsorted(np.flatnonzero(data == 10), start), np.searchsorted(begin, start, "right") - 1

    def paragraphs(self, texts):
        """dict of arrays: text, first word (within the text), size, content hash, and the
        shingle hashes with the number of them per paragraph; lines of several parts
        follow the parts. words and word_text hold the hash and the text of every word."""
        import numpy as np

        with np.errstate(over="ignore"):
            w, line, text = self._hashes(texts)
            n = len(w)
            if not n:
                return None
            pair = _mix(w + _mix(np.append(w[1:], w[:1]), 7), 11)
            least = np.ones(n, bool)
            for k in range(1, REACH + 1):
                least[k:] &= pair[k:] < pair[:-k]
                least[:-k] &= pair[:-k] <= pair[k:]
            new_line = np.append(True, line[1:] != line[:-1])
            # Near a line's ends the neighbours are other lines: no cut there.
            begin = np.flatnonzero(new_line)
            lengths = np.diff(np.append(begin, n))
            place = np.arange(n) - np.repeat(begin, lengths)
            least &= (place >= REACH) & (np.repeat(lengths, lengths) - place > REACH)
            start = new_line | least
            first = np.flatnonzero(start)
            size = np.diff(np.append(first, n))
            inside = np.arange(n) - np.repeat(first, size)
            start |= inside % LONGEST == 0
            first = np.flatnonzero(start)
            size = np.diff(np.append(first, n))
            several = np.add.reduceat(start.astype(np.int64), begin) > 1
            if len(self.powers) < GRAM:  # of shingles and grams, too short for their terms to cancel out
                self.powers = np.cumprod(np.full(GRAM, 0xD6E8FEB86659FD93, np.uint64), dtype=np.uint64)
            inside = np.arange(n) - np.repeat(first, size)
            content = _mix(np.add.reduceat(_mix(w + _mix(inside.astype(np.uint64), 3), 3), first)
                           + size.astype(np.uint64), 5)
            whole = _mix(np.add.reduceat(_mix(w + _mix(place.astype(np.uint64), 3), 3), begin)
                         + lengths.astype(np.uint64), 5)
            parts = len(first)
            first, size, content = (np.concatenate([x, y[several]]) for x, y in (
                (first, begin), (size, lengths), (content, whole)))
            five = np.zeros(n, np.uint64)
            mixed = _mix(w, 17)
            for k in range(SHINGLE):
                five[:n - k] += mixed[k:] * self.powers[k]
            short = size < SHINGLE
            per = np.where(short, 1, size - SHINGLE + 1)
            at = np.cumsum(per) - per
            shingles = _mix(five[np.repeat(first - at, per) + np.arange(per.sum())], 23)
            # Fewer words than a shingle: the whole paragraph is the one shingle.
            shingles[at[short]] = _mix(content[short], 23)
        text_begin = np.searchsorted(text, np.arange(len(texts)))
        return {"text": text[first], "start": first - text_begin[text[first]], "size": size, "content": content,
                "shingles": shingles, "per": per, "parts": parts, "words": w, "word_text": text, "text_begin": text_begin}

    def anchors(self, p):
        """(places within the batch's words, hashes) of the anchors."""
        import numpy as np

        w, text = p["words"], p["word_text"]
        n = len(w) - GRAM + 1
        if n < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        gram = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            mixed = _mix(w, 19)
            for k in range(GRAM):
                gram += mixed[k:n + k] * self.powers[k]
            gram = _mix(gram, 29)
        valid = text[:n] == text[GRAM - 1:]
        # The upper half of the hash, then the place: the least is found with its place.
        low = np.uint64((1 << 32) - 1)
        least = np.where(valid, gram & ~low, ~low) | np.arange(n, dtype=np.uint64)
        span, window = 1, min(WINDOW, n)
        while span < window:
            step = min(span, window - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        place = np.unique(least & low).astype(np.int64)
        place = place[valid[place]]
        # A run of one word: every gram is the least of some window; one in GRAM is enough.
        again = np.append(False, (np.diff(place) == 1) & (gram[place[1:]] == gram[place[:-1]])) & (place % GRAM > 0)
        place = place[~again]
        return place, gram[place]

    def around(self, p, place, before, after):
        """The words (uint16, 0 beyond) from ``before`` words before the anchors to ``after``
        words after them; ``AROUND`` at most."""
        import numpy as np

        text = p["word_text"]
        step = np.arange(-AROUND, GRAM + AROUND)
        at = place[:, None] + step
        inside = (at >= 0) & (at < len(text)) & (step >= -before[:, None]) & (step < GRAM + after[:, None])
        at = np.where(inside, at, 0)
        inside &= text[at] == text[place][:, None]
        return np.where(inside, np.maximum(p["words"][at] >> np.uint64(48), np.uint64(1)), 0).astype(np.uint16)

    def keys(self, p, similarity: float):
        """(first, last paragraph, band keys of these, whether it is their first band)."""
        import numpy as np

        at = np.cumsum(p["per"]) - p["per"]
        with np.errstate(over="ignore"):
            for first, last, rows, salt in ((0, p["parts"], ROWS, 1000), (p["parts"], len(at), LINE_ROWS, 2000)):
                if first == last:
                    continue
                begin = at[first]
                shingles = p["shingles"][begin:at[last] if last < len(at) else None]
                for b in range(bands_for(similarity, rows=rows)):
                    key = np.full(last - first, b + 1 + salt, np.uint64)
                    for r in range(rows):
                        key = _mix(key + np.minimum.reduceat(_mix(shingles, salt + b * rows + r),
                                                             at[first:last] - begin), 31)
                    yield first, last, key, b == 0


def _signed(x):
    import numpy as np
    import pyarrow as pa

    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _text_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash) of every row; together they name a document, as an id may stand at several texts."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"))


def _copies(ids: DataFrame) -> DataFrame:
    """(text_hash, first_doc) of texts that stand in several rows."""
    return (ids.groupBy("text_hash").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n"))
            .where("n > 1").select("text_hash", "first_doc"))


class _Firsts:
    """Leaves out rows whose text another row has and holds first. Two Bloom filters, of the texts in several
    rows and of the rows to keep among those that the first one knows (their first rows, and rows whose text stands
    alone but looks repeated to it), let some copies through; these do no harm but the work. No other row is left out."""

    def __init__(self, ids: DataFrame, copies: DataFrame):
        self.repeated = _bloom(copies.select(F.col("text_hash").alias("content")), copies.count())
        alone = _known(ids, "text_hash", self.repeated).join(copies, "text_hash", "left_anti")
        keep = materialise(copies.select(F.col("first_doc").alias("doc_id"), "text_hash").unionByName(alone).select(
            F.xxhash64("doc_id", "text_hash").alias("content")), "rows-to-keep")
        self.first = _bloom(keep, keep.count())

    def columns(self, docs: DataFrame) -> DataFrame:
        return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.xxhash64(
            "doc_id", F.xxhash64("text")).alias("row_hash"), "text")

    def batches(self, batches):
        """(batch slice, texts, which texts several rows have); texts left out are empty."""
        import numpy as np

        tables = [(np.unpackbits(np.frombuffer(data, np.uint8)).astype(bool), bits)
                  for data, bits in (self.repeated, self.first)]
        for b, texts in text_batches(batches):
            many, first = (np.logical_and.reduce([table[x] for x in _bloom_places(
                b.column(c).to_numpy().view(np.uint64), bits)]) for c, (table, bits) in zip(
                    ("text_hash", "row_hash"), tables))
            yield b, ["" if x else t for t, x in zip(texts, (many & ~first).tolist())], many


def _band_rows(docs: DataFrame, similarity: float, firsts: _Firsts) -> DataFrame:
    """(key, content, n): paragraphs by band; n counts occurrences, in band 0 only.
    Anchors are their own key."""
    shared = docs.sparkSession.sparkContext.broadcast(firsts)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        cutter = Cutter()
        for _, texts, _ in shared.value.batches(batches):
            p = cutter.paragraphs(texts)
            if p is None:
                continue
            for first, last, key, counted in cutter.keys(p, similarity):
                if counted:
                    # Equal paragraphs of a batch are one row: a paragraph in a third of all texts stays small.
                    content, once, times = np.unique(p["content"][first:last], return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [_signed(key[once]), _signed(content), pa.array(times if counted else np.zeros_like(times))],
                    ["key", "content", "n"])
            anchor, times = np.unique(cutter.anchors(p)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(anchor), _signed(anchor), pa.array(times)],
                                             ["key", "content", "n"])

    return firsts.columns(docs).mapInArrow(run, "key bigint, content bigint, n bigint")


def _runs(batches, columns, keys=1, squeeze=None):
    """Numpy columns of a sorted partition, in pieces that end where the first ``keys`` columns change.
    ``squeeze`` shortens what is held of a key that goes on in the next batch."""
    import numpy as np

    held = None
    for b in batches:
        now = [b.column(c).to_numpy() for c in columns]
        if held is not None:
            now = [np.concatenate([x, y]) for x, y in zip(held, now)]
        cut = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in now[:keys]]))
        stop = cut[-1] + 1 if len(cut) else 0
        if stop:
            yield [x[:stop] for x in now]
        held = [x[stop:] for x in now]
        if squeeze is not None and len(held[0]):
            held = squeeze(*held)
    if held is not None and len(held[0]):
        yield held


def _collisions(rows: DataFrame) -> DataFrame:
    """(key, content, together): contents that occur more than once (together
    false), and all contents of keys that several contents share (true)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def summed(key, content, n):
            """One row per key and content: what a hot key holds are its contents, not their occurrences."""
            at = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (content[1:] != content[:-1])))
            return [key[at], content[at], np.add.reduceat(n, at)]

        for found in _runs(batches, ["key", "content", "n"], squeeze=summed):
            key, content, times = summed(*found)
            new_key = np.append(True, key[1:] != key[:-1])
            size = np.diff(np.append(np.flatnonzero(new_key), len(key)))
            together = np.repeat(size, size) > 1
            for keep, flag in ((together, True), (times > 1, False)):
                if keep.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[keep]), pa.array(content[keep]), pa.array(np.full(keep.sum(), flag))],
                        ["key", "content", "together"])

    parts = shuffle_partitions(rows.sparkSession)
    return (rows.repartition(parts, "key").sortWithinPartitions("key", "content")
            .mapInArrow(run, "key bigint, content bigint, together boolean"))


def _bloom(contents: DataFrame, count: int, most_bits: int = 27) -> tuple[bytes, int]:
    """Bit table of the contents (column content); at most 2**most_bits bits, whatever their number."""
    import numpy as np

    bits = min(most_bits, max(16, (8 * max(count, 1)).bit_length()))

    def run(batches):
        import pyarrow as pa

        table = np.zeros(1 << bits, bool)
        for b in batches:
            for place in _bloom_places(b.column("content").to_numpy().view(np.uint64), bits):
                table[place] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(table).tobytes()], pa.binary())], ["bits"])

    table = np.zeros(1 << bits >> 3, np.uint8)
    for r in contents.coalesce(4).mapInArrow(run, "bits binary").toLocalIterator():
        table |= np.frombuffer(r["bits"], np.uint8)
    return table.tobytes(), bits


def _known(rows: DataFrame, column: str, bloom: tuple[bytes, int]) -> DataFrame:
    """The rows whose ``column`` the Bloom filter knows: all that were put in, and some others."""
    import numpy as np

    shared = rows.sparkSession.sparkContext.broadcast(bloom)

    def run(batches):
        import pyarrow as pa

        data, bits = shared.value
        table = np.unpackbits(np.frombuffer(data, np.uint8)).astype(bool)
        for b in batches:
            yield b.filter(pa.array(np.logical_and.reduce([
                table[x] for x in _bloom_places(b.column(column).to_numpy().view(np.uint64), bits)])))

    return rows.mapInArrow(run, rows.schema)


def _bloom_places(content, bits: int):
    import numpy as np

    with np.errstate(over="ignore"):
        return [(_mix(content, salt) >> np.uint64(64 - bits)).astype(np.int64) for salt in (41, 43)]


PLACE = ("content bigint, doc_id bigint, text_hash bigint, start bigint, size bigint, shingles array<bigint>, "
         "around binary")


def _occurrences(docs: DataFrame, repeated: tuple[bytes, int], together: tuple[bytes, int], firsts: _Firsts
                 ) -> DataFrame:
    """Places of the paragraphs whose content the first Bloom filter knows, with
    their shingles where the second one does (once per batch and content), and of
    the anchors that the first one knows, with the words around them. Texts that
    several rows have are listed whole, with start -1."""
    shared = docs.sparkSession.sparkContext.broadcast((repeated, together, firsts))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        *blooms, firsts = shared.value
        tables = [(np.unpackbits(np.frombuffer(data, np.uint8)).astype(bool), bits) for data, bits in blooms]
        cutter = Cutter()

        def rows(b, of, content, start, size, shingles=None, around=None):
            names = b.take(pa.array(of))
            none = len(of)
            return pa.RecordBatch.from_arrays(
                [content, names.column("doc_id"), names.column("text_hash"), pa.array(start, pa.int64()),
                 pa.array(size, pa.int64()), pa.nulls(none, pa.list_(pa.int64())) if shingles is None else shingles,
                 pa.nulls(none, pa.binary()) if around is None else around],
                ["content", "doc_id", "text_hash", "start", "size", "shingles", "around"])

        for b, texts, many in firsts.batches(batches):
            p = cutter.paragraphs(texts)
            if p is None:
                continue
            b = b.select(["doc_id", "text_hash"])
            of = np.flatnonzero(many & np.array([bool(t) for t in texts]))
            if len(of):
                sizes = np.bincount(p["word_text"], minlength=len(texts))[of]
                yield rows(b, of, b.column("text_hash").take(pa.array(of)), np.full(len(of), -1), sizes)
            known = [np.logical_and.reduce([table[x] for x in _bloom_places(p["content"], bits)])
                     for table, bits in tables]
            keep = known[0]
            _, once = np.unique(p["content"], return_index=True)
            carries = np.zeros(len(keep), bool)
            carries[once] = known[1][once]
            carries &= keep
            sizes = np.where(carries, p["per"], 0)[keep]
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)),
                _signed(p["shingles"][np.repeat(carries, p["per"])]), mask=pa.array(~carries[keep]))
            yield rows(b, p["text"][keep], _signed(p["content"][keep]), p["start"][keep], p["size"][keep], lists)
            place, anchor = cutter.anchors(p)
            table, bits = tables[0]
            keep = np.logical_and.reduce([table[x] for x in _bloom_places(anchor, bits)])
            # Next to an anchor that is sent too, less is enough: every word between is compared from both.
            near, far = GRAM + WINDOW, AROUND
            of = p["word_text"][place]
            beside = keep[1:] & keep[:-1] & (of[1:] == of[:-1])
            before = np.where(np.append(False, beside)[:len(place)], near, far)[keep]
            after = np.where(np.append(beside, False)[:len(place)], near, far)[keep]
            place, anchor = place[keep], anchor[keep]
            for s in range(0, len(place), 4096):
                at, of = place[s:s + 4096], p["word_text"][place[s:s + 4096]]
                words = cutter.around(p, at, before[s:s + 4096], after[s:s + 4096])
                ends = np.arange(len(at) + 1, dtype=np.int32) * np.int32(2 * words.shape[1])
                yield rows(b, of, _signed(anchor[s:s + 4096]), at - p["text_begin"][of], np.full(len(at), GRAM),
                           around=pa.Array.from_buffers(pa.binary(), len(at), [
                               None, pa.py_buffer(ends), pa.py_buffer(words.tobytes())]))

    return firsts.columns(docs).mapInArrow(run, PLACE)


def _extend(a, b):
    """Pieces (rows, first, last) of equal words of the rows of ``a`` and ``b`` from their
    first word on, over edits after which ``REJOIN`` words or the end of a text are equal again."""
    import numpy as np

    width = a.shape[1]
    # A border on which nothing is equal.
    a, b = (np.pad(x, ((0, 0), (0, 1))) for x in (a, b))

    def equal(rows, i, j):
        n, on = np.zeros(len(rows), np.int64), np.ones(len(rows), bool)
        for _ in range(width):
            x = a[rows, np.minimum(i + n, width)]
            on &= (x == b[rows, np.minimum(j + n, width)]) & (x != 0)
            if not on.any():
                break
            n += on
        return n

    rows = np.arange(len(a))
    i = j = np.zeros(len(a), np.int64)
    n = equal(rows, i, j)
    out = [(rows, i, i + n)]
    i, j = i + n, j + n
    while len(rows):
        tried = np.stack([equal(rows, i + x, j + y) for x, y in EDITS])
        best = tried.argmax(axis=0)
        n = tried.max(axis=0)
        skip = np.array(EDITS)[best]
        go = n >= REJOIN
        rows, n, i, j = rows[go], n[go], (i + skip[:, 0])[go], (j + skip[:, 1])[go]
        out.append((rows, i, i + n))
        i, j = i + n, j + n
    return out


SPAN = ("doc_id bigint, text_hash bigint, start bigint, stop bigint, of_doc bigint, of_text bigint, of_start bigint, "
        "class_id bigint")


def _pieces(seen: DataFrame) -> DataFrame:
    """``SPAN`` rows: words that are equal around anchors (content, doc_id, text_hash, start,
    around) and around their first occurrences.

    The first occurrence comes first in a sort. Anchors over ``UNIT_ROWS`` occurrences
    are dealt in slices, each with a copy of the first one at its head.
    """
    spark = seen.sparkSession
    heavy = materialise(seen.groupBy("content").count().where(f"count > {UNIT_ROWS}").select(
        "content", F.ceil(F.col("count") / UNIT_ROWS).cast("int").alias("slices")), "heavy-anchors")
    row = ["doc_id", "text_hash", "start", "around"]
    few = heavy.count() <= FEW
    seen = seen.join(F.broadcast(heavy) if few else heavy, "content", "left")
    dealt = seen.withColumn("slice", F.coalesce(F.pmod(F.xxhash64("doc_id", "text_hash", "start"), F.col("slices")),
                                                F.lit(0)).cast("int"))
    heads = (seen.where("slices is not null").groupBy("content", "slices").agg(F.min(F.struct(*row)).alias("f"))
             .select("content", "f.*", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")))
    dealt = dealt.select("content", "slice", *row).unionByName(heads.select("content", "slice", *row))

    def pieces(doc, text, start, around, kind, of):
        import numpy as np
        import pyarrow as pa

        other = np.flatnonzero((doc != doc[of]) | (text != text[of]) | (start != start[of]))
        for s in range(0, len(other), 8192):
            at = other[s:s + 8192]
            x, y = (np.frombuffer(b"".join(around[z]), np.uint16).reshape(len(at), -1) for z in (at, of[at]))
            after = _extend(x[:, AROUND:], y[:, AROUND:])
            before = _extend(x[:, :AROUND][:, ::-1], y[:, :AROUND][:, ::-1])
            # The words next to the anchor at either side are one piece.
            spans = [(after[0][0], -before[0][2], after[0][2])]
            spans += after[1:] + [(r, -q, -p) for r, p, q in before[1:]]
            rows = at[np.concatenate([r for r, _, _ in spans])]
            p, q = (np.concatenate([x[i] for x in spans]) for i in (1, 2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[rows]), pa.array(text[rows]), pa.array(start[rows] + p), pa.array(start[rows] + q),
                 pa.array(doc[of[rows]]), pa.array(text[of[rows]]), pa.array(start[of[rows]] + p),
                 pa.array(kind[rows])],
                ["doc_id", "text_hash", "start", "stop", "of_doc", "of_text", "of_start", "class_id"])

    def run(batches):
        import numpy as np

        held = None  # the first occurrence of the anchor that the last batch ended in, and the last row
        for b in batches:
            if not b.num_rows:
                continue
            rows = [b.column(c).to_numpy(zero_copy_only=False) for c in ("slice", "content", *row)]
            if held is not None:
                rows = [np.concatenate([h, x]) for h, x in zip(held, rows)]
            part, kind, doc, text, start, around = rows
            new = np.append(True, (kind[1:] != kind[:-1]) | (part[1:] != part[:-1]))
            of = np.maximum.accumulate(np.where(new, np.arange(len(kind)), 0))
            last = np.array([of[-1], len(kind) - 1])
            # Rows that repeat an id and its text are one document.
            again = np.append(False, ~new[1:] & (doc[1:] == doc[:-1]) & (text[1:] == text[:-1])
                              & (start[1:] == start[:-1]))
            if held is not None:
                again[:2] = True
            keep = np.flatnonzero(~again)
            place = np.zeros(len(kind), np.int64)
            need = np.union1d(keep, of[keep])
            place[need] = np.arange(len(need))
            yield from pieces(*(x[need] for x in (doc, text, start, around, kind)), place[of[need]])
            held = [x[last] for x in rows]

    return (dealt.repartition(shuffle_partitions(spark), "content", "slice")
            .sortWithinPartitions("content", "slice", "doc_id", "text_hash", "start").mapInArrow(run, SPAN))


def _passages(spans, similarity: float):
    """Passages (start, stop, class_id) of one document and one source, of its spans (start,
    stop, of_start, class_id) in order: spans that meet, and spans at either side of an edit
    as long as the passage's similarity is enough. A word that isn't equal takes a
    shingle, and four more at each place."""
    joined = []  # start, stop, shift of the last span, class of the first
    at_shift: dict[int, list] = {}
    for start, stop, of_start, kind in spans:
        shift = start - of_start
        # Side by side here is one passage only if it is so in the source, give or take an edit.
        near = next((x for x in map(at_shift.get, (shift, shift - 1, shift + 1, shift - 2, shift + 2))
                     if x is not None and start <= x[1]), None)
        if near is None:
            near = [start, stop, shift, kind]
            joined.append(near)
        elif stop > near[1]:
            near[1:3] = [stop, shift]
        at_shift[shift] = near
    out = []
    for start, stop, shift, kind in joined:
        lost = 0
        out.append([start, stop, lost, shift, kind])
        while len(out) > 1:
            a, b = out[-2], out[-1]
            gap = max(0, b[0] - a[1])
            lost = a[2] + b[2] + gap + SHINGLE - 1
            n = b[1] - a[0] - SHINGLE + 1
            if abs(b[3] - a[3]) > gap + 2 or n - lost < similarity * (n + lost) - 1e-9:
                break
            out[-2:] = [[a[0], max(a[1], b[1]), lost, b[3], a[4]]]
    return [(x[0], x[1], x[4]) for x in out]


RUN = ("doc_id bigint, text_hash bigint, start bigint, stop bigint, "
       "passages array<struct<of_doc:bigint,of_text:bigint,class_id:bigint>>")


def _removed(spans: DataFrame, similarity: float, least_run: int) -> DataFrame:
    """``RUN`` rows. A run is made of passages that are each long enough from one source:
    short ones of different sources side by side are no run."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for cols in _runs(batches, ["doc_id", "text_hash", "of_doc", "of_text", "start", "stop", "of_start", "class_id"],
                          keys=2):
            doc, text = cols[:2]
            new = np.append(True, (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]))
            cut = np.append(np.flatnonzero(new), len(doc))
            found = []
            for s, e in zip(cut[:-1].tolist(), cut[1:].tolist()):
                by_source: dict[tuple, list] = {}
                for o, t, *span in zip(*(c[s:e].tolist() for c in cols[2:])):
                    by_source.setdefault((o, t), []).append(span)
                passages = sorted((a, z, o, t, k) for (o, t), v in by_source.items()
                                  for a, z, k in _passages(v, similarity) if z - a >= least_run)
                runs = []
                for a, z, *source in passages:
                    if not runs or a > runs[-1][1]:
                        runs.append([a, z, []])
                    runs[-1][1] = max(runs[-1][1], z)
                    if source not in runs[-1][2]:
                        runs[-1][2].append(source)
                found += [(int(doc[s]), int(text[s]), a, z, [dict(zip(("of_doc", "of_text", "class_id"), x)) for x in v])
                          for a, z, v in runs]
            if found:
                kinds = [pa.int64()] * 4 + [pa.list_(pa.struct([(n, pa.int64()) for n in (
                    "of_doc", "of_text", "class_id")]))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)],
                                                 ["doc_id", "text_hash", "start", "stop", "passages"])

    return (spans.repartition(shuffle_partitions(spans.sparkSession), "doc_id", "text_hash")
            .sortWithinPartitions("doc_id", "text_hash", "of_doc", "of_text", "start", "stop").mapInArrow(run, RUN))


def _similar_pairs(sets: list, groups_a, groups_b, similarity: float):
    """Links (i, j) of sets at Jaccard >= similarity between two groups of set numbers
    (or within one); enough of them to connect all that link."""
    import numpy as np

    def flat(group):
        sizes = np.array([len(sets[i]) for i in group])
        return np.concatenate([sets[i] for i in group]), np.repeat(np.arange(len(group)), sizes), sizes

    va, ia, na = flat(groups_a)
    own = groups_a is groups_b
    vb, ib, nb = (va, ia, na) if own else flat(groups_b)
    order = np.argsort(vb, kind="stable")
    vb, ib = vb[order], ib[order]
    parent = np.arange(len(sets))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    ends = np.cumsum(na)
    lo, hi = np.searchsorted(vb, va, "left"), np.searchsorted(vb, va, "right")
    for i, (s, e) in enumerate(zip(ends - na, ends)):
        near = np.concatenate([ib[x:y] for x, y in zip(lo[s:e], hi[s:e])])
        shared = np.bincount(near, minlength=len(groups_b))
        found = np.flatnonzero(shared >= similarity * (na[i] + nb - shared) - 1e-9)
        for j in found:
            a, b = groups_a[i], groups_b[j]
            if a != b and shared[j]:
                ra, rb = root(a), root(b)
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
                    out.append((a, b))
    return out


def _verified_links(collided: DataFrame, shingles: DataFrame, similarity: float) -> DataFrame:
    """(a, b) contents at Jaccard >= similarity among those that share a band key.

    Buckets over ``UNIT_ROWS`` are dealt into slices that meet pairwise.
    """
    sizes = collided.groupBy("key").count().where(f"count > {UNIT_ROWS}")
    heavy = materialise(sizes.select("key", F.ceil(F.col("count") / (UNIT_ROWS // 2)).cast("int").alias("slices")),
                        "heavy-buckets")
    rows = collided.join(shingles, "content")
    if heavy.isEmpty():
        dealt = rows.select("key", F.lit(0).alias("s"), F.lit(0).alias("t"), F.lit(0).alias("me"), "content",
                            "shingles")
    else:
        cut = rows.join(heavy, "key", "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
        cut = cut.withColumn("me", F.pmod(F.xxhash64("content"), F.col("slices")).cast("int"))
        cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        dealt = cut.select("key", F.least("me", "other").alias("s"), F.greatest("me", "other").alias("t"), "me",
                           "content", "shingles")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def links(unit, group):
            s, t = unit[1:]
            if len(group) == 2 and s == t:  # most buckets
                (a, x, _), (b, y, _) = group
                x, y = set(x), set(y)
                shared = len(x & y)
                if shared and shared >= similarity * (len(x) + len(y) - shared) - 1e-9:
                    yield a, b
                return
            content = np.array([g[0] for g in group])
            # A set, so that a shingle that repeats inside a paragraph counts once.
            sets = [np.unique(np.array(g[1], np.int64)) for g in group]
            me = np.array([g[2] for g in group])
            a, b = np.flatnonzero(me == s).tolist(), np.flatnonzero(me == t).tolist()
            if len(group) > 1 and a and b:
                for i, j in _similar_pairs(sets, a, a if s == t else b, similarity):
                    yield content[i], content[j]

        unit, group, out = None, [], []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("key", "s", "t", "me", "content", "shingles")]
            for k, s, t, me, c, x in zip(*cols):
                if (k, s, t) != unit:
                    if len(group) > 1:
                        out += links(unit, group)
                    unit, group = (k, s, t), []
                group.append((c, x, me))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()),
                                                  pa.array([y for _, y in out], pa.int64())], ["a", "b"])
                out = []
        if len(group) > 1:
            out += links(unit, group)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()),
                                              pa.array([y for _, y in out], pa.int64())], ["a", "b"])

    parts = shuffle_partitions(collided.sparkSession)
    return (dealt.repartition(parts, "key", "s", "t").sortWithinPartitions("key", "s", "t")
            .mapInArrow(run, "a bigint, b bigint"))


def _few(table: DataFrame) -> DataFrame:
    """``table`` with a broadcast hint when it is counted to have at most ``FEW`` rows (of a few numbers)."""
    return F.broadcast(table) if table.count() <= FEW else table


def _repeats(docs: DataFrame, similarity: float, least_run: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, runs, members): (doc_id, text_hash) of every row; ``RUN`` rows; (doc_id, text_hash,
    class_id) of every paragraph class with several places, whatever its length, and of
    every passage, for the documents that keep it as well as for those that lose it."""
    key = ["doc_id", "text_hash"]
    ids = materialise(_text_ids(docs), "ids")
    copies = materialise(_copies(ids), "copies")
    firsts = _Firsts(ids, copies)
    copied = materialise(ids.join(copies, "text_hash").where("doc_id <> first_doc").select(*key, "first_doc").distinct(),
                         "copied")

    found = materialise(_collisions(_band_rows(docs, similarity, firsts)), "collisions")
    wanted = found.select("content").distinct()
    together = found.where("together")
    contents = together.select("content").distinct()
    n = contents.count()
    places = materialise(_occurrences(docs, _bloom(wanted, wanted.count()), _bloom(contents, n), firsts), "places")
    whole = places.where("start < 0").select("text_hash", F.col("size").alias("words")).distinct()
    # Copies that the Bloom filters let through: texts listed whole alone can be such.
    leaked = materialise(places.where("start < 0").join(_few(copied), key, "left_semi").select(*key).distinct(), "leaked")
    places = places.where("start >= 0").join(_few(leaked), key, "left_anti")
    units, anchors = places.where("around is null"), places.where("around is not null")
    if n:
        sets = units.where("shingles is not null").groupBy("content").agg(F.first("shingles").alias("shingles"))
        links = materialise(_verified_links(together.select("key", "content"), sets, similarity), "links")
        groups = materialise(connected_components(links), "groups")
        placed = (units.join(groups.withColumnRenamed("node", "content"), "content", "left")
                  .select(F.coalesce("component", "content").alias("class_id"), *key, "start", "size"))
    else:
        placed = units.select(F.col("content").alias("class_id"), *key, "start", "size")
    placed = materialise(placed.distinct(), "placed")
    first = materialise(placed.groupBy("class_id").agg(F.min(F.struct(*key, "start")).alias("first"),
                                                       F.count("*").alias("n")).where("n > 1")
                        .select("class_id", F.col("first.doc_id").alias("of_doc"),
                                F.col("first.text_hash").alias("of_text"),
                                F.col("first.start").alias("of_start")), "first-places")
    several = placed.join(first, "class_id")
    spans = (several.where("doc_id <> of_doc or text_hash <> of_text or start <> of_start")
             .select(*key, "start", (F.col("start") + F.col("size")).alias("stop"), "of_doc", "of_text", "of_start",
                     "class_id"))
    seen = anchors.select("content", *key, "start", "around")
    runs = materialise(_removed(spans.unionByName(_pieces(seen)), similarity, least_run), "runs")

    # A copy of a whole text is one run, if long enough; its class is the text's.
    again = copied.join(whole, "text_hash").where(f"words >= {int(least_run)}").select(
        *key, F.lit(0).cast("long").alias("start"), F.col("words").alias("stop"),
        F.expr("array(named_struct('of_doc', first_doc, 'of_text', text_hash, 'class_id', text_hash))").alias(
            "passages"))
    runs = runs.unionByName(again)
    texts = ids.join(copies, "text_hash", "left_semi").select(*key, F.col("text_hash").alias("class_id"))
    passages = runs.select(*key, F.explode("passages").alias("p"))
    members = (several.select(*key, "class_id").unionByName(texts)
               .unionByName(passages.select(*key, "p.class_id"))
               .unionByName(passages.select("p.of_doc", "p.of_text", "p.class_id").toDF(*key, "class_id")).distinct())
    return ids, runs, members


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                  least_run: int = LEAST_RUN) -> DataFrame:
    """One row per run to remove: doc_id, text_hash (XXH64 of the text), start and stop
    (word positions, words being runs without ASCII white space), passages (of_doc and
    of_text that hold the first occurrence, class_id: a component's least content hash,
    an anchor's hash, or a whole text's).

    The first occurrence, by doc_id and place, of each component stays. Runs are
    made of passages of at least ``least_run`` words from one source each. A document
    is an id with a text: rows that repeat both are one document, unlike texts of one
    id are documents of their own. A text that stands under several ids is compared
    once, under the least id; the others lose it whole. Rows with a NULL id or text
    have no runs; an empty table gives none.
    """
    return _repeats(_documents(docs, id_col, text_col), similarity, least_run)[1]


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs = pick(docs, doc_id=id_col, text=text_col).where("doc_id is not null and text is not null")
    return docs.withColumn("doc_id", F.col("doc_id").cast("long"))


def repeated_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                    least_run: int = LEAST_RUN) -> DataFrame:
    """One row per document row: doc_id, n_removed (runs), removed_words, removed
    (start:stop word positions), of_docs (that keep what is removed), class_ids (of all
    repeated paragraphs, short ones and kept ones too, and of all passages); none: 0,
    0, '', empty. Documents that share a class id hold the same passage."""
    ids, runs, members = _repeats(_documents(docs, id_col, text_col), similarity, least_run)
    key = ["doc_id", "text_hash"]
    by_doc = runs.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("start", "stop", "passages"))).alias("r")).select(
        *key, F.size("r").alias("n_removed"),
        F.aggregate("r", F.lit(0).cast("bigint"), lambda a, x: a + x["stop"] - x["start"]).alias("removed_words"),
        F.array_join(F.transform("r", lambda x: F.concat_ws(":", x["start"].cast("string"), x["stop"].cast(
            "string"))), ",").alias("removed"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("r", lambda x: x["passages"]["of_doc"])))).alias("of_docs"))
    classes = members.groupBy(*key).agg(F.array_sort(F.collect_list("class_id")).alias("class_ids"))
    none = F.expr("cast(array() as array<bigint>)")
    found = (ids.join(by_doc, key, "left").join(classes, key, "left").select(
        "doc_id", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed_words", F.lit(0)).cast("long").alias("removed_words"),
        F.coalesce("removed", F.lit("")).alias("removed"), F.coalesce("of_docs", none).alias("of_docs"),
        F.coalesce("class_ids", none).alias("class_ids")))
    nothing = docs.where(F.col(id_col).isNull() | F.col(text_col).isNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("removed_words"), F.lit("").alias("removed"), none.alias("of_docs"),
        none.alias("class_ids"))
    return found.unionByName(nothing)


def remove_runs(docs: DataFrame, runs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the words of the runs taken out of the texts; white space
    before a removed word goes with it. Columns and rows stay."""
    spans = runs.groupBy(F.col("doc_id").alias("_run_id"), F.col("text_hash").alias("_run_text")).agg(
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("_runs"))
    columns = docs.columns
    joined = docs.join(spans, (docs[id_col] == spans["_run_id"]) & (F.xxhash64(docs[text_col]) == spans["_run_text"]),
                       "left").drop("_run_id", "_run_text")

    def run(batches):
        import re

        import pyarrow as pa

        for b in batches:
            texts = []
            for t, rs in zip(b.column(text_col).to_pylist(), b.column("_runs").to_pylist()):
                if t is not None and rs:
                    words, at, kept = re.findall(r"[ \t-\r]*[^ \t-\r]+", t), 0, []
                    tail = t[sum(map(len, words)):]
                    for r in rs:
                        kept += words[at:r["start"]]
                        at = max(at, r["stop"])
                    t = "".join(kept + words[at:]) + tail
                texts.append(t)
            b = b.drop_columns(["_runs"])
            yield b.set_column(columns.index(text_col), text_col, pa.array(texts, pa.string()))

    return joined.mapInArrow(run, docs.schema)
