"""Operator 1: toxicity severity by cumulative-link ordinal regression.

P(grade >= k) = sigmoid(w . x - t_k) with one weight vector for all ordered
thresholds t_1 < t_2 < ...; x holds which text features a document has (words,
and the first four and five letters of words, so inflected insults of other
languages share weights). Expected severity is the sum of P(grade >= k).

Learning: features are counted over a bounded sample of labelled rows, by
Spark; those most associated with the label are kept; the regression is fitted
on the sample's sparse rows. Scoring: one pass over all documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aggrex.llm.bpe import text_batches
from aggrex.llm.common import bounded_sample, materialise, pick

SAMPLE_ROWS = 20_000  # labelled rows learnt from, in hash order of their ids
FEATURES = 4096  # features kept, at most
LEAST_Z = 2.5  # association with the label, in standard errors of the log odds, that a feature must show
LEAST_ROWS = 3  # sample rows a feature must occur in
LEXICON_ODDS = 3.0  # log odds from which a feature counts as a toxic expression
WORD = re.compile(r"[^\W\d_]+")
REMEMBER = 200_000


def word_features(word: str) -> list[str]:
    """The word, and its first four and five letters where it is longer."""
    return [word, *(f"{word[:n]}-" for n in (4, 5) if len(word) > n)]


class FeatureReader:
    """Distinct features of a text; with ``known``, only those, as their numbers."""

    def __init__(self, known: dict[str, int] | None = None):
        self.known = known
        self.pieces: dict[str, tuple] = {}

    def read(self, text: str) -> set:
        out: set = set()
        pieces = self.pieces
        if len(pieces) > REMEMBER:
            pieces.clear()
        for p in set(text.split()):
            got = pieces.get(p)
            if got is None:
                got = [f for w in WORD.findall(p.lower()) for f in word_features(w)]
                if self.known is not None:
                    got = [self.known[f] for f in got if f in self.known]
                got = tuple(got)
                if len(p) <= 48:
                    pieces[p] = got
            if got:
                out.update(got)
        return out


@dataclass
class OrdinalModel:
    features: dict[str, int]
    weights: list[float]
    thresholds: list[float]

    def at_least(self, present) -> list[float]:
        """P(grade >= k) for k = 1, 2, ..."""
        import math

        eta = sum(self.weights[i] for i in present)
        return [1 / (1 + math.exp(-max(-60.0, min(60.0, eta - t)))) for t in self.thresholds]


def fit_cumulative_link(rows: list, grades: list[int], n_features: int, n_grades: int, penalty: float = 0.1,
                        steps: int = 500, rate: float = 0.05):
    """Weights and ordered thresholds by penalised maximum likelihood (Adam on the full sample)."""
    import numpy as np

    y = np.array(grades)
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.fromiter((f for r in rows for f in r), np.int64, len(at))
    share = np.array([max(1e-3, (y >= k).mean()) for k in range(1, n_grades)])
    start = -np.log(share / (1 - np.minimum(share, 0.999)))
    gaps = np.log(np.maximum(np.diff(start), 0.1))
    theta = np.concatenate([np.zeros(n_features), start[:1], gaps])
    m, v = np.zeros_like(theta), np.zeros_like(theta)

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -60, 60)))

    for step in range(1, steps + 1):
        w = theta[:n_features]
        t = theta[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(theta[n_features + 1:]))])
        eta = np.bincount(at, w[col], len(y))
        # P(y >= k) at both borders of each row's own grade, and their slopes.
        up = np.where(y > 0, sigmoid(eta - t[np.maximum(y, 1) - 1]), 1.0)
        down = np.where(y < n_grades - 1, sigmoid(eta - t[np.minimum(y, n_grades - 2)]), 0.0)
        p = np.maximum(up - down, 1e-12)
        s_up, s_down = up * (1 - up) / p, down * (1 - down) / p
        d_eta = s_down - s_up  # of the negative log likelihood
        g = np.zeros_like(theta)
        g[:n_features] = np.bincount(col, d_eta[at], n_features) + penalty * w
        d_t = np.array([s_up[y == k].sum() - s_down[y == k - 1].sum() for k in range(1, n_grades)])
        g[n_features] = d_t.sum()
        for i in range(1, n_grades - 1):
            g[n_features + i] = d_t[i:].sum() * np.exp(theta[n_features + i])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    t = theta[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(theta[n_features + 1:]))])
    return theta[:n_features].tolist(), t.tolist()


def _features(rows: DataFrame, schema: str, known: dict[str, int] | None = None):
    """Per batch: rows' labels with their features, or with ``known`` unset the counts of features."""

    def run(batches):
        import pyarrow as pa

        reader, counts = FeatureReader(known), {}
        for b, texts in text_batches(batches):
            toxic = b.column("toxic").to_pylist()
            if known is None:
                for y, t in zip(toxic, texts):
                    for f in reader.read(t):
                        c = counts.setdefault(f, [0, 0])
                        c[y] += 1
                if len(counts) > 500_000:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(counts)), pa.array([c[1] for c in counts.values()], pa.int64()),
                         pa.array([c[0] for c in counts.values()], pa.int64())], ["feature", "toxic", "clean"])
                    counts = {}
            else:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(toxic, pa.int32()), pa.array([sorted(reader.read(t)) for t in texts],
                                                           pa.list_(pa.int32()))], ["toxic", "present"])
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts)), pa.array([c[1] for c in counts.values()], pa.int64()),
                 pa.array([c[0] for c in counts.values()], pa.int64())], ["feature", "toxic", "clean"])

    return rows.mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Fit on at most ``sample_rows`` labelled rows (the first in hash order of the id; of ids that stand at
    many texts, the first in hash order of the texts).

    Labels are 0 or 1, so the ordered grades are made from them: 0 is label 0;
    a row of label 1 is graded 1 or 2 by how many different toxic expressions
    it holds (fewer than the median of such rows, or not). Toxic expressions
    are the features whose log odds for label 1 reach ``LEXICON_ODDS``.
    Labels above 0 count as 1, all others as 0. Rows with NULL ids or labels teach nothing; an id labelled twice, or a text
    that several rows hold, counts once, with its higher label. Without rows of both labels the model has no
    features and says grade 0 for all.
    """
    marks = (pick(labels, doc_id=id_col, toxic=label_col).where("doc_id is not null and toxic is not null")
             .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")))
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = pick(docs, doc_id=id_col, text=text_col).join(F.broadcast(chosen), "doc_id")
    # A text copied many times would lift all its words; each text teaches once.
    once = rows.groupBy(F.xxhash64("text").alias("h")).agg(F.max(F.struct("toxic", "text")).alias("r"))
    sample = bounded_sample(materialise(once.select("r.text", "r.toxic"), "toxicity-sample"), sample_rows, "text")
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not (n.get(0) and n.get(1)):
        return OrdinalModel({}, [], [20.0, 21.0])
    counts = (_features(sample, "feature string, toxic bigint, clean bigint").groupBy("feature")
              .agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).where(f"t + c >= {LEAST_ROWS}"))
    odds = F.log((F.col("t") + 0.5) / (n[1] - F.col("t") + 0.5)) - F.log(
        (F.col("c") + 0.5) / (n[0] - F.col("c") + 0.5))
    spread = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    best = (counts.select("feature", odds.alias("odds"), F.abs(odds / spread).alias("z"))
            .where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "feature").limit(FEATURES).collect())
    known = {r["feature"]: i for i, r in enumerate(best)}
    lexicon = {i for i, r in enumerate(best) if r["odds"] >= LEXICON_ODDS}
    data = _features(sample, "toxic int, present array<int>", known).collect()
    hits = [len(lexicon.intersection(r["present"])) for r in data]
    among = sorted(h for h, r in zip(hits, data) if r["toxic"])
    middle = max(among[len(among) // 2], 1)
    grades = [0 if not r["toxic"] else 1 + (h >= middle) for h, r in zip(hits, data)]
    weights, thresholds = fit_cumulative_link([r["present"] for r in data], grades, len(known), 3)
    return OrdinalModel(known, weights, thresholds)


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, p_toxic (grade 1 or more), expected_severity, grade
    (the most severe one with a probability of at least a half), toxic.

    NULL and empty texts have no features; repeated rows get equal scores; NULL
    ids stay NULL. One pass, no shuffle.
    """

    def run(batches):
        import pyarrow as pa

        reader = FeatureReader(model.features)
        for b, texts in text_batches(batches):
            # Sorted, so that equal texts add up in one order.
            p = [model.at_least(sorted(reader.read(t))) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array([x[0] for x in p]), pa.array([sum(x) for x in p]),
                 pa.array([sum(v >= 0.5 for v in x) for x in p], pa.int32()), pa.array([x[0] >= 0.5 for x in p])],
                ["doc_id", "p_toxic", "expected_severity", "grade", "toxic"])

    return pick(docs, doc_id=id_col, text=text_col).mapInArrow(
        run, "doc_id bigint, p_toxic double, expected_severity double, grade int, toxic boolean")


def drop_toxic(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model doesn't find toxic; columns as they were."""
    columns = docs.columns

    def run(batches):
        import pyarrow as pa

        reader = FeatureReader(model.features)
        for b in batches:
            keep = []
            for t in b.column(text_col):
                keep.append(model.at_least(sorted(reader.read(t.as_py() or "")))[0] < 0.5)
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema).select(columns)
