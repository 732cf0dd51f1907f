"""Operator 7: token ids in directly addressable files.

An id is cut into 8-bit chunks, least significant first. Level 0 holds the
first chunk of every id and a bitmap that says which ids go on; level 1 holds
the next chunk of those ids alone, with its own bitmap, and so on. A rank
directory counts the set bits before every 512th position of a bitmap, so the
place of an id's next chunk is one directory entry and at most eight 64-bit
words away: any id is read without decoding its neighbours.

A file is a sequence of segments, rows of a Parquet table written by Spark's
own writer (so tasks commit whole or not at all, on any store): the segment's
bytes, the ids and lengths of its documents, and its place in the order. The
documents are in ascending id order over the whole table.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aggrex.llm.bpe import PieceCutter, gather, no_cycle_collection, text_batches
from aggrex.llm.common import pick
from aggrex.session import checkpoint_dir

MAGIC = b"DACS"
BLOCK = 512  # positions per rank directory entry
PART_ROWS = 8192  # documents per file; a file is written as a stream of segments, whatever its size
MOST_PARTS = 10_000  # files; beyond PART_ROWS times as many documents files grow instead
SAMPLE_ROWS = 64  # rows per file that the ranges are cut from; they decide the balance alone
FIRST, LAST = -(1 << 63), (1 << 63) - 1
SEGMENT_TOKENS = 1 << 20  # a segment ends with the document that passes this
REMEMBER = 250_000  # text pieces a task remembers, twice: those in use and those before
REMEMBER_LENGTH = 48


def pack(ids) -> bytes:
    """A segment of the ids (unsigned 32-bit integers)."""
    import numpy as np

    rest = np.asarray(ids, dtype=np.uint32)
    parts = []
    while True:
        low = (rest & 255).astype(np.uint8)
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % 64))
        blocks = np.bitwise_count(bits.reshape(-1, 64).view("<u8")).sum(axis=1, dtype=np.uint32)
        directory = (np.cumsum(blocks, dtype=np.uint32) - blocks).astype("<u4")
        parts.append(struct.pack("<I", len(low)) + low.tobytes() + bits.tobytes() + directory.tobytes())
        rest = rest[more] >> np.uint32(8)
        if not len(rest):
            return MAGIC + struct.pack("<I", len(parts)) + b"".join(parts)


class Segment:
    """Random access to the ids of a packed segment."""

    def __init__(self, data: bytes):
        import numpy as np

        if data[:4] != MAGIC:
            raise ValueError("not a token segment")
        (n_levels,) = struct.unpack_from("<I", data, 4)
        at, self.levels = 8, []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<I", data, at)
            blocks = -(-n // BLOCK)
            low = np.frombuffer(data, np.uint8, n, at + 4)
            bits = np.frombuffer(data, np.uint8, blocks * 64, at + 4 + n)
            directory = np.frombuffer(data, "<u4", blocks, at + 4 + n + blocks * 64)
            self.levels.append((low, bits, directory))
            at += 4 + n + blocks * 68
        self.n = len(self.levels[0][0])

    def rank(self, level: int, at: int) -> int:
        """Set bits before position ``at``: one directory entry and part of its block."""
        import numpy as np

        low, bits, directory = self.levels[level]
        if at >= len(low):
            return len(self.levels[level + 1][0]) if level + 1 < len(self.levels) else 0
        block, whole, rest = at // BLOCK, at // 8, at % 8
        n = int(directory[block]) + int(np.bitwise_count(bits[block * 64:whole]).sum(dtype=np.int64))
        return n + (int(bits[whole]) & ((1 << rest) - 1)).bit_count()

    def token(self, at: int) -> int:
        """The id at one position."""
        value, shift = 0, 0
        for level, (low, bits, _) in enumerate(self.levels):
            value |= int(low[at]) << shift
            if not bits[at // 8] >> (at % 8) & 1:
                break
            at, shift = self.rank(level, at), shift + 8
        return value

    def tokens(self, start: int, stop: int):
        """The ids of a range, read from the range's own chunks alone."""
        import numpy as np

        out = np.zeros(stop - start, np.uint32)
        rows = np.arange(stop - start)
        for level, (low, bits, _) in enumerate(self.levels):
            if start >= stop:
                break
            out[rows] |= low[start:stop].astype(np.uint32) << np.uint32(8 * level)
            more = np.unpackbits(bits[start // 8:-(-stop // 8)], bitorder="little")[start % 8:][:stop - start] > 0
            rows = rows[more]
            if len(rows):
                start = self.rank(level, start)
                stop = start + len(rows)
            else:
                break
        return out


class PieceEncoder(PieceCutter):
    """Texts to ids by the tokenizers library's model, each distinct piece once."""

    def __init__(self, path: str):
        super().__init__(path)
        self.pieces: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ids_of(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces, from memory or from the model."""
        if len(self.pieces) > REMEMBER:
            self.older, self.pieces = self.pieces, {}
        known, older, tokenize = self.pieces, self.older.get, self.library.model.tokenize
        out = list(map(known.get, pieces))
        for i, p in enumerate(pieces):
            if out[i] is None:
                ids = older(p)
                if ids is None:
                    ids = array("I", [t.id for w in self.split(p.decode()) for t in tokenize(w)]).tobytes()
                out[i] = ids
                if len(p) <= REMEMBER_LENGTH:
                    known[p] = ids
        return out

    def encode(self, texts: list[str]) -> list:
        """The ids (numpy, unsigned 32-bit) of every text."""
        import numpy as np

        whole, pieces, which, ends = self.cut(texts)
        with no_cycle_collection():
            ids = gather(self._ids_of(pieces), which, ends, "<u4")
        for i in whole:
            ids[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return ids


def _bounds(keys: DataFrame) -> list[tuple[int, int]]:
    """Where the ranges of (doc_id, hash) begin, from a sample of at most about
    ``MOST_PARTS * SAMPLE_ROWS`` rows. Hashes are read only where an id fills a range."""
    n = keys.count()
    parts = max(1, min(MOST_PARTS, -(-n // PART_ROWS)))
    if parts == 1:
        return []

    def cut(*columns):
        got = keys.select(*columns).sample(min(1.0, parts * SAMPLE_ROWS / n), seed=7).toPandas()
        got = got.sort_values(list(columns))
        return list(got.iloc[[len(got) * i // parts for i in range(1, parts)]].itertuples(index=False, name=None)
                    ) if len(got) else []

    ids = [d for d, in cut("doc_id")]
    return cut("doc_id", "hash") if len(set(ids)) < len(ids) else [(d, FIRST) for d in ids]


class Ranges:
    """Which range a row belongs to. Rows equal to several bounds are copies of
    one text under one id: any of these ranges may have them, so they are dealt
    in turn, by their number within the task, which a repeated task deals alike."""

    def __init__(self, bounds: list[tuple[int, int]], task: int = 0):
        import numpy as np

        self.ids = np.array([d for d, _ in bounds], np.int64)
        self.hashes = [h for _, h in bounds]
        self.task, self.dealt = task, {}

    def of(self, ids, hashes):
        """Range numbers (numpy) of rows, given numpy arrays."""
        import numpy as np

        low, high = (np.searchsorted(self.ids, ids, side=side) for side in ("left", "right"))
        place = high.astype(np.int32)
        for i in np.flatnonzero(high > low).tolist():
            first, h = int(low[i]), int(hashes[i])
            begin = bisect_left(self.hashes, h, first, int(high[i]))
            end = bisect_right(self.hashes, h, begin, int(high[i]))
            if end - begin > 1:
                turn = self.dealt.get(begin, self.task)
                self.dealt[begin] = turn + 1
                end = begin + 1 + turn % (end - begin)
            place[i] = end
        return place


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id",
                      text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id``, and write the files at ``path``.

    Range bounds come from a sample of the ids alone; texts are encoded where
    they are read, and only ids are shuffled, once, straight to the range they
    belong to. NULL texts are empty (the end id only); NULL ids come first;
    documents of one id stand next to each other, within a file ordered by their
    ids' bytes. One id in a large share of the rows spreads over as many files as
    its share, by the hash of the text; copies of one text under one id are dealt
    in turn.
    """
    docs = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    # NULL ids take the least number; that number itself, as an id, then comes after them.
    docs = docs.withColumn("hash", F.when(F.col("doc_id") == FIRST, F.lit(LAST)).otherwise(F.xxhash64("text")))
    bounds = _bounds(docs.select(F.coalesce("doc_id", F.lit(FIRST)).alias("doc_id"), "hash"))

    def encode(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        coder = PieceEncoder(tokenizer)
        ranges = Ranges(bounds, TaskContext.get().partitionId())
        for b, texts in text_batches(batches, rows=1024, chars=1 << 20):
            ids = b.column("doc_id")
            place = ranges.of(ids.fill_null(FIRST).to_numpy(zero_copy_only=False),
                              b.column("hash").to_numpy(zero_copy_only=False))
            coded = [np.append(x, np.uint32(end_id)).astype("<u4") for x in coder.encode(texts)]
            # Two bytes an id where they suffice: what is shuffled stays small.
            rows = [x.astype("<u2").tobytes() if x.max() < 65536 else x.tobytes() for x in coded]
            yield pa.RecordBatch.from_arrays(
                [pa.array(place), ids, pa.array([len(x) for x in coded], pa.int64()),
                 pa.array(rows, pa.binary())], ["part", "doc_id", "n", "ids"])

    def segments(batches):
        import numpy as np
        import pyarrow as pa

        part, seq, held, docs_held, total = None, 0, [], [], 0

        def flush():
            data = pack(np.concatenate(held))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([total], pa.int64()),
                 pa.array([[d for d, _ in docs_held]], pa.list_(pa.int64())),
                 pa.array([[n for _, n in docs_held]], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                ["part", "seq", "n_tokens", "doc_ids", "lengths", "data"])

        for b in batches:
            for p, d, n, x in zip(*(b.column(c).to_pylist() for c in ("part", "doc_id", "n", "ids"))):
                if held and (p != part or total >= SEGMENT_TOKENS):
                    yield flush()
                    seq, held, docs_held, total = (seq + 1 if p == part else 0), [], [], 0
                part = p
                held.append(np.frombuffer(x, "<u2" if len(x) == 2 * n else "<u4"))
                docs_held.append((d, n))
                total += n
        if held:
            yield flush()

    coded = docs.mapInArrow(encode, "part int, doc_id bigint, n bigint, ids binary")
    (coded.repartitionById(len(bounds) + 1, "part")
     .sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "ids")
     .mapInArrow(segments, "part int, seq bigint, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>, "
                           "data binary")
     .write.mode("overwrite").parquet(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Segments with ``start``, the number of ids in all segments before.

    Starts need two small sums: one row per part (as many as files), and the
    running sum inside a part.
    """
    files = spark.read.schema("part int, seq bigint, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>, "
                              "data binary").parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    before = F.sum("in_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.sum("n_tokens").over(
        Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    places = (files.select("part", "seq", "n_tokens").withColumn("inside", F.coalesce(inside, F.lit(0)))
              .join(offsets, "part").select("part", "seq", (F.col("before") + F.col("inside")).alias("start")))
    return files.join(F.broadcast(places) if _few(places) else places, ["part", "seq"])


def _few(places: DataFrame, most: int = 100_000) -> bool:
    """One row per segment (a million ids each); broadcast only up to ``most`` of them."""
    return places.count() <= most


def document_digests(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the segments."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("start", "doc_ids", "lengths", "data")))
            for start, ids, lengths, data in rows:
                segment = Segment(data)
                ends = np.cumsum(lengths)
                begins = ends - np.array(lengths)
                # All documents of the segment are asked for, so one range has them.
                found = memoryview(segment.tokens(0, segment.n).astype("<u4")).cast("B")
                crc = [zlib.crc32(found[4 * s:4 * e]) for s, e in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(begins + start), pa.array(lengths, pa.int64()),
                     pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return (segments.select("start", "doc_ids", "lengths", "data")
            .mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))


def write_and_read_back(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = 2,
                        **columns: str) -> DataFrame:
    """Write the token files (below the shared folder unless ``path`` is given)
    and return per document what they hold. An empty table gives no rows."""
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/tokens"
    write_token_files(docs, path, tokenizer, end_id, **columns)
    return document_digests(read_token_files(spark, path))
