"""Operator 5: near-duplicate vectors by an inverted multi-index.

Unit vectors are cut into halves; each half has a codebook of its own, and the
product of both is a grid of cells. Every vector is listed in its own cell and
visits the cells nearest to it, in the order of the multi-sequence algorithm
(sums of the distances to both codewords), until a neighbour at the least
similarity lies in a visited cell with the target recall. Cells verify by exact
cosine in double precision. Equal vectors are one entry of the index; a cell
that many vectors share is dealt in blocks that meet pairwise. Vectors of each
length have an index of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aggrex.llm.common import connected_components, materialise, pick, shuffle_partitions

SAMPLE = 20_000  # vectors that codebooks are fitted on, and visits tuned on
CELL = 512  # vectors per cell aimed at
MOST_WORDS = 2048  # codewords per half; cells grow beyond two billion vectors of one length
BLOCK = 2048  # vectors of a cell that one unit of work holds on each side
TARGET = 0.98  # recall of neighbours at exactly the least similarity


def _unit(rows, dim: int):
    """Rows as unit vectors in double precision, padded to ``dim``; scaled first, so squares can't overflow."""
    import numpy as np

    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def _codebook(x, k: int, rounds: int = 12):
    """Lloyd's k-means from evenly spaced sample rows."""
    import numpy as np

    words = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = np.concatenate([np.argmin((words * words).sum(axis=1) - 2 * x[s:s + 4096] @ words.T, axis=1)
                               for s in range(0, len(x), 4096)])
        n = np.bincount(near, minlength=k)
        for d in range(x.shape[1]):
            total = np.bincount(near, x[:, d], k)
            words[n > 0, d] = total[n > 0] / n[n > 0]
    return words


def visits(x, first, second, count: int):
    """The ``count`` cells nearest to each unit vector, nearest first (cell = i * k + j).

    The multi-sequence order visits (i, j) by the sum of distances; the cell of
    the a-th nearest word of one half and the b-th of the other can be among
    the first ``count`` only if (a + 1) * (b + 1) <= count.
    """
    import numpy as np

    half, k = first.shape[1], len(first)
    count = min(count, k * k)

    def sorted_words(part, words):
        d = (part * part).sum(axis=1)[:, None] + (words * words).sum(axis=1) - 2 * part @ words.T
        order = np.argsort(d, axis=1, kind="stable")[:, :count]
        return order, np.take_along_axis(d, order, axis=1)

    o1, d1 = sorted_words(x[:, :half], first)
    o2, d2 = sorted_words(x[:, half:], second)
    a, b = np.divmod(np.arange(o1.shape[1] * o2.shape[1]), o2.shape[1])
    may = (a + 1) * (b + 1) <= count
    a, b = a[may], b[may]
    out = np.empty((len(x), count), np.int32)
    step = max(1, min(1024, (1 << 23) // len(a)))
    for s in range(0, len(x), step):
        sums = d1[s:s + step][:, a] + d2[s:s + step][:, b]
        order = np.argsort(sums, axis=1, kind="stable")[:, :count]
        out[s:s + step] = (np.take_along_axis(o1[s:s + step][:, a], order, axis=1) * k
                           + np.take_along_axis(o2[s:s + step][:, b], order, axis=1))
    return out


def tune_visits(sample, first, second, similarity: float, target: float) -> int:
    """Fewest visits under which a neighbour at exactly ``similarity`` is met by
    either vector's visits with probability ``target`` (seeded random neighbours);
    all cells if it takes as many."""
    import numpy as np

    x = sample[:2000]
    noise = np.random.default_rng(5).normal(size=x.shape)
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    norm = np.sqrt((noise * noise).sum(axis=1, keepdims=True))
    y = similarity * x + np.sqrt(1 - similarity * similarity) * noise / np.maximum(norm, 1e-300)
    cells = len(first) ** 2
    most = min(cells, 256)
    while True:
        vx, vy = visits(x, first, second, most), visits(y, first, second, most)

        def rank(v, home):
            hit = v == home[:, None]
            return np.where(hit.any(axis=1), hit.argmax(axis=1), most)

        both = np.sort(np.minimum(rank(vx, vy[:, 0]), rank(vy, vx[:, 0])))
        needed = int(both[min(len(both) - 1, int(len(both) * target))])
        if needed < most or most == cells:
            return min(cells, needed + 1)
        most = min(cells, 4 * most)


class Grid:
    """Codebooks of the vectors of one length, with the visits that reach the target."""

    def __init__(self, sample, count: float, similarity: float):
        self.dim = len(sample[0])
        self.even = self.dim + self.dim % 2
        x = _unit(sample, self.even)
        k = int(min(MOST_WORDS, max(1, round((count / CELL) ** 0.5)), len(x)))
        half = self.even // 2
        self.first, self.second = _codebook(x[:, :half], k), _codebook(x[:, half:], k)
        self.n_visits = tune_visits(x, self.first, self.second, similarity, TARGET)

    def visits(self, rows):
        return visits(_unit(rows, self.even), self.first, self.second, self.n_visits)


def grids(sample: list, count: int, similarity: float) -> dict[int, Grid]:
    """A grid per length of vector in ``sample``, which stands for ``count`` vectors.
    Lengths too rare to be in the sample have one cell, which is compared in blocks."""
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(len(r), []).append(r)
    return {d: Grid(rows, count * len(rows) / len(sample), similarity) for d, rows in by_dim.items()}


def _valid(vector):
    return (F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
        & F.exists(vector, lambda v: v != 0))


def _entries(table: DataFrame):
    return table.groupBy("vector").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("weight"))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 similarity: float = 0.9) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    n_links counts the other vectors linked directly (copies included),
    component_id is the smallest vec_id reachable, itself included. Vectors that
    are NULL, empty, zero or hold NULL or non-finite components link with
    nothing, also not with their copies; vectors of different length never
    link. A NULL vec_id keeps its row and counts as a link; a component of such
    rows alone has component_id NULL and is not kept. An empty table gives an
    empty result.
    """
    spark = vectors.sparkSession
    table = pick(vectors, vec_id=id_col, vector=vector_col).withColumn(
        "vector", F.col("vector").cast("array<double>"))
    table = materialise(table.withColumn("valid", F.coalesce(_valid("vector"), F.lit(False))), "vectors")
    entries = materialise(_entries(table.where("valid")).withColumn("entry", F.monotonically_increasing_id()),
                          "entries")
    alone = table.where("not valid").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
        F.col("vec_id").isNotNull().alias("kept"))
    count = entries.count()
    if not count:
        return alone
    links = materialise(_links(spark, entries, count, similarity), "links")
    degree = links.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    groups = connected_components(links.where("b is not null").select("a", "b"))
    groups = materialise(groups.select(F.col("node").alias("entry"), "component"), "groups")
    named = (entries.select("entry", "first_id", "weight").join(groups, "entry", "left")
             .withColumn("component", F.coalesce("component", "entry")))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = materialise(
        named.join(least, "component").join(degree.withColumnRenamed("a", "entry"), "entry", "left")
        .join(entries.select("entry", "vector"), "entry")
        .select("vector", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"),
        "entries-known")
    linked = table.where("valid").join(known, "vector").select(
        "vec_id", "n_links", "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    return linked.unionByName(alone)


def _links(spark, entries: DataFrame, count: int, similarity: float) -> DataFrame:
    """Rows (a, NULL, n): n vectors link with entry a, of one unit of work; and
    (a, b, NULL): edges that connect what links."""
    import numpy as np

    sample = entries.select("vector", F.xxhash64("vector").alias("h")).orderBy("h").limit(SAMPLE).collect()
    by_dim = grids([r["vector"] for r in sample], count, similarity)

    def place(batches):
        import pyarrow as pa

        for b in batches:
            for s in range(0, b.num_rows, 2000):
                p = b.slice(s, 2000)
                rows = [np.array(r) for r in p.column("vector").to_pylist()]
                lengths = np.array([len(r) for r in rows])
                for dim in np.unique(lengths).tolist():
                    mine = np.flatnonzero(lengths == dim)
                    some = [rows[i] for i in mine]
                    grid = by_dim.get(dim)
                    v = grid.visits(some) if grid else np.zeros((len(some), 1), np.int64)
                    lists = pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1],
                                                     pa.array(v.ravel().astype(np.int32)))
                    # Half the bytes where single precision holds the vector as it is.
                    data = [(r.astype("<f4") if (r.astype("<f4") == r).all() else r.astype("<f8")).tobytes()
                            for r in some]
                    at = pa.array(mine)
                    yield pa.RecordBatch.from_arrays(
                        [p.column("entry").take(at), p.column("weight").take(at),
                         pa.array([dim] * len(some), pa.int32()), pa.array(data, pa.binary()), lists],
                        ["entry", "weight", "dim", "data", "visits"])

    placed = materialise(
        entries.select("entry", "weight", "vector").mapInArrow(
            place, "entry bigint, weight bigint, dim int, data binary, visits array<int>"), "placed")
    # Blocks: how many of members and of visitors a cell needs.
    seen = placed.select("dim", F.posexplode("visits").alias("nth", "cell"))
    blocks = materialise(seen.groupBy("dim", "cell").agg(
        F.ceil(F.sum((F.col("nth") == 0).cast("int")) / BLOCK).cast("int").alias("m"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("q")).where("m > 0"), "cells")

    def block(n):
        return F.pmod(F.xxhash64("entry"), n).cast("int")

    members = (placed.withColumn("cell", F.get("visits", F.lit(0))).join(blocks, ["dim", "cell"])
               .withColumn("mb", block(F.col("m")))
               .select("cell", "mb", F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("qb"),
                       F.lit(True).alias("member"), "entry", "weight", "dim", "data", "visits"))
    visitors = (placed.select("entry", "weight", "dim", "data", F.get("visits", F.lit(0)).alias("home"),
                              F.explode("visits").alias("cell")).join(blocks, ["dim", "cell"])
                .withColumn("qb", block(F.col("q")))
                .select("cell", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("mb"), "qb",
                        F.lit(False).alias("member"), "entry", "weight", "dim", "data",
                        F.array("home").alias("visits")))
    dealt = (members.unionByName(visitors).repartition(shuffle_partitions(spark), "dim", "cell", "mb", "qb")
             .sortWithinPartitions("dim", "cell", "mb", "qb"))

    def verify(batches):
        import pyarrow as pa

        def unit(rows):
            m, q = [r for r in rows if r[1]], [r for r in rows if not r[1]]
            if not m or not q:
                return None
            dim = rows[0][0][0]

            def matrix(rs):
                return _unit([np.frombuffer(r[4], "<f4" if len(r[4]) == 4 * dim else "<f8") for r in rs], dim)

            em, eq = np.array([r[2] for r in m]), np.array([r[2] for r in q])
            wm, wq = np.array([r[3] for r in m]), np.array([r[3] for r in q])
            near = matrix(q) @ matrix(m).T >= similarity
            near &= eq[:, None] != em
            i, j = np.nonzero(near)
            if not len(i):
                return None
            # A pair met in both cells counts for the visitor in each; met here alone, for both here.
            home = [r[5][0] for r in q]
            seen_by = [set(r[5]) for r in m]
            here_alone = np.array([home[a] not in seen_by[b] for a, b in zip(i, j)])
            n = np.bincount(i, wm[j], len(q))
            back = np.bincount(j[here_alone], wq[i[here_alone]], len(m))
            # Least entry reachable inside the unit: one edge per entry connects all of it.
            low_q, low_m = eq.copy(), em.copy()
            while True:
                a, b = low_q.copy(), low_m.copy()
                np.minimum.at(low_q, i, low_m[j])
                np.minimum.at(low_m, j, low_q[i])
                if (a == low_q).all() and (b == low_m).all():
                    break
            entry, low = np.concatenate([eq, em]), np.concatenate([low_q, low_m])
            edges = entry != low
            gain_e, gain_n = np.concatenate([eq[n > 0], em[back > 0]]), np.concatenate([n[n > 0], back[back > 0]])
            a = np.concatenate([gain_e, entry[edges]])
            return pa.RecordBatch.from_arrays(
                [pa.array(a),
                 pa.array(np.concatenate([np.zeros_like(gain_e), low[edges]]),
                          mask=np.arange(len(a)) < len(gain_e)),
                 pa.array(np.concatenate([gain_n.astype(np.int64), np.zeros(edges.sum(), np.int64)]))],
                ["a", "b", "n"])

        key, rows = None, []
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("dim", "cell", "mb", "qb", "member", "entry", "weight", "data",
                                                      "visits")]
            for d, c, mb, qb, *rest in zip(*cols):
                if (d, c, mb, qb) != key:
                    out = unit(rows) if rows else None
                    if out is not None:
                        yield out
                    key, rows = (d, c, mb, qb), []
                rows.append((key, *rest))
        out = unit(rows) if rows else None
        if out is not None:
            yield out

    return dealt.mapInArrow(verify, "a bigint, b bigint, n bigint")
