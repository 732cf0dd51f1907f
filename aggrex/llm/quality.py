"""Operator 9: quality by compression with two dictionaries.

A zstandard dictionary is built from text labelled good, another from text
labelled bad. A document, cut into windows, is compressed with each; it is
shorter with the dictionary of the text it resembles. The difference, divided
by the sum of both sizes, becomes a probability by a logistic calibration that
also sees how well the text compresses at all and how long it is (repetitive
text is short with either dictionary, and says less by the difference).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aggrex.llm.bpe import text_batches
from aggrex.llm.common import bounded_sample, fold, materialise, pick

SAMPLE_ROWS = 4_000  # labelled rows of each label that a dictionary is built from
SAMPLE_PIECES = 6_000  # pieces of them
PIECE = 1024
DICTIONARY = 262_144
CALIBRATION_ROWS = 20_000
WINDOW = 2048  # bytes compressed at a time
LEVEL = 3


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    weights: list[float]
    mean: list[float]
    spread: list[float]


class Compressors:
    """Sizes of whole texts with both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        def compressor(data):
            d = zstandard.ZstdCompressionDict(data)
            d.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False,
                                            write_dict_id=False)

        self.good, self.bad = compressor(good).compress, compressor(bad).compress

    def features(self, text: str) -> list[float]:
        """Calibration inputs, the normalised size difference first."""
        from math import log

        data = text.encode()
        good = bad = 0
        for i in range(0, len(data) or 1, WINDOW):
            part = data[i:i + WINDOW]
            good += len(self.good(part))
            bad += len(self.bad(part))
        difference = (good - bad) / (good + bad)
        ratio, length = log((good + bad) / 2 / (len(data) + 16)), log(len(data) + 16)
        return [difference, ratio, ratio * ratio, length, difference * length, difference * ratio]


def _by_hash(marks: DataFrame, rows: int) -> DataFrame:
    return marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> CompressionModel | None:
    """Dictionaries from labelled rows whose ``fold`` is 0, calibration on those whose fold is 2.

    Rows of fold 1 are held out: nothing of them is read here. The samples are
    the first rows in hash order of the id, at most ``SAMPLE_ROWS`` of each
    label and ``CALIBRATION_ROWS``, also when ids stand at many texts; labels above 0
    count as 1, all others as 0; ids labelled twice count with the lower
    label. None if a label has no row to learn from.
    """
    import numpy as np
    import zstandard

    marks = (pick(labels, doc_id=id_col, quality=label_col).where("doc_id is not null and quality is not null")
             .groupBy("doc_id").agg(F.min((F.col("quality") > 0).cast("int")).alias("quality"))
             .withColumn("fold", fold("doc_id")).where("fold <> 1"))
    texts = pick(docs, doc_id=id_col, text=text_col)
    building = _by_hash(marks.where("fold = 0 and quality = 1"), SAMPLE_ROWS).unionByName(
        _by_hash(marks.where("fold = 0 and quality = 0"), SAMPLE_ROWS))
    checking = _by_hash(marks.where("fold = 2"), CALIBRATION_ROWS)
    found = materialise(texts.join(F.broadcast(building.unionByName(checking)), "doc_id"), "quality-sample")
    # An id may stand at many texts: rows are bounded as well.
    building = [bounded_sample(found.where(f"fold = 0 and quality = {q}"), SAMPLE_ROWS, "doc_id", "text") for q in (1, 0)]
    checking = bounded_sample(found.where("fold = 2"), CALIBRATION_ROWS, "doc_id", "text")

    def pieces(batches):
        import pyarrow as pa

        for b, part in text_batches(batches):
            cut = [(q, t.encode()[i:i + PIECE]) for q, t in zip(b.column("quality").to_pylist(), part)
                   for i in range(0, len(t.encode()), PIECE)]
            yield pa.RecordBatch.from_arrays([pa.array([q for q, _ in cut], pa.int32()),
                                              pa.array([x for _, x in cut], pa.binary())], ["quality", "piece"])

    dictionaries = []
    for rows in building:
        cut = rows.select("quality", "text").mapInArrow(pieces, "quality int, piece binary")
        got = [bytes(r["piece"]) for r in cut.distinct()
               .orderBy(F.xxhash64("piece"), "piece").limit(SAMPLE_PIECES).collect()]
        if not got:
            return None
        try:
            dictionaries.append(zstandard.train_dictionary(DICTIONARY, got).as_bytes())
        except zstandard.ZstdError:  # too little text to select from: the text itself is the dictionary
            dictionaries.append(b"".join(got)[:DICTIONARY].ljust(8, b" "))
    good, bad = dictionaries

    def measure(batches):
        import pyarrow as pa

        sizes = Compressors(good, bad)
        for b, part in text_batches(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column("quality"), pa.array([sizes.features(t) for t in part], pa.list_(pa.float64()))],
                ["quality", "x"])

    data = (checking.select("quality", "text")
            .mapInArrow(measure, "quality int, x array<double>").collect())
    y = np.array([r["quality"] for r in data], float)
    if not len(y) or y.min() == y.max():
        return None
    x = np.array([r["x"] for r in data])
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    a = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(50):  # Newton steps of the penalised logistic likelihood
        p = 1 / (1 + np.exp(-np.clip(a @ w, -60, 60)))
        h = a.T @ (a * (p * (1 - p))[:, None]) + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (p - y) + 1e-2 * w)
        w -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return CompressionModel(good, bad, w.tolist(), mean.tolist(), spread.tolist())


def score(docs: DataFrame, model: CompressionModel | None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1, higher: good likelier), predicted.

    Every whole text is scored, NULL as empty; without a model all scores are
    0.5. Repeated rows get equal scores; a NULL id stays NULL and is not held
    out. One pass, no shuffle.
    """

    def run(batches):
        from math import exp

        import pyarrow as pa

        sizes = Compressors(model.good, model.bad) if model else None
        for b, part in text_batches(batches):
            out = []
            for t in part:
                z = 0.0
                if model:
                    x = sizes.features(t)
                    z = model.weights[-1] + sum(w * (v - m) / s for w, v, m, s in zip(
                        model.weights, x, model.mean, model.spread))
                out.append(1 / (1 + exp(-max(-60.0, min(60.0, z)))))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(out)],
                                             ["doc_id", "score"])

    scored = pick(docs, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", (fold("doc_id") == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
