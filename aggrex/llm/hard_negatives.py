"""Operator 11: hard negatives by Fagin's threshold algorithm.

Components become integers, so scores (inner products) are exact. A block of rows
has one candidate list per dimension, sorted by that dimension. For an anchor the
lists are read from the end that its component's sign calls for; every row met is
scored in full (random access). No unread row can score above the threshold, the
sum of the anchor's components times the values last read; a window [low, high] of
scores is done when the threshold falls below ``low``, or strictly below the k-th
score found in it (an equal score might still win by its id).

Positives are the window without bounds over the rows of the anchor's label; each
positive's score then sets a window for the negatives, over the rows of the other
labels. Anchors, in groups, meet all rows, in slices; a unit of work keeps k rows
per window while it reads its slice block by block, and what the units found is
ranked per anchor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aggrex.llm.common import materialise, pick, shuffle_partitions

SCALE = 256  # a component x becomes floor(SCALE * x)
GROUP = 4096  # anchors that one unit of work holds
BLOCK = 4096  # rows whose lists are sorted together
STEP = 32  # list entries read before the threshold is looked at first; doubled from then on
K = 5
LEAST, MOST = -(1 << 63), (1 << 63) - 1


class Block:
    """Rows with one sorted list per dimension."""

    def __init__(self, ids, labels, values):
        import numpy as np

        self.ids, self.labels, self.values = ids, labels, values
        # Rows by value within each dimension, least first; equal values by row, so that lists never depend on more.
        self.lists = np.argsort(values, axis=0, kind="stable").T
        self.size = int(np.abs(values).max()) if values.dtype != object and values.size else 0
        self.single = values.astype(np.float64) if values.dtype != object else None

    def scores(self, rows, anchor, exact_in_double):
        """Integer inner products; products of small integers are exact in double precision, which is faster."""
        if exact_in_double:
            return (self.single[rows] @ anchor.astype("float64")).astype("int64")
        return self.values[rows] @ anchor


def best_of(score, ids, k: int):
    """Places of the first ``k`` by score, then by smaller id."""
    import numpy as np

    return np.lexsort((ids, -score))[:k]


def threshold_search(block: Block, anchor, eligible, windows, found, k: int):
    """Add to ``found`` (per window a pair of scores and ids, best first) the block's rows.

    ``eligible`` marks the rows that may be taken; ``windows`` has (low, high) per
    window, both included, None for no bound.
    """
    import numpy as np

    n, dims = block.values.shape
    big = anchor.dtype == object or block.values.dtype == object
    bound = 0 if big else dims * block.size * int(np.abs(anchor).max(initial=0))
    if not big and bound >= 1 << 63:  # int() products would wrap: Python's integers instead
        big, anchor = True, anchor.astype(object)
    values = block.values.astype(object) if big and block.values.dtype != object else block.values
    down, up = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    weights = np.concatenate([anchor[down], anchor[up]])
    seen = np.zeros(n, bool)
    open_windows = list(range(len(windows)))
    depth, step = 0, STEP
    while depth < n and open_windows:
        to = min(n, depth + step) if len(weights) else n
        # Largest values first where the component is positive, smallest first where it is negative.
        met = np.zeros(n, bool)
        met[block.lists[down, n - to:n - depth].ravel()] = True
        met[block.lists[up, depth:to].ravel()] = True
        if not len(weights):
            met[:] = True
        fresh = np.flatnonzero(met & ~seen & eligible)
        seen |= met
        depth, step = to, 2 * step
        if len(fresh):
            if big:
                score = np.array([sum(int(a) * int(b) for a, b in zip(values[r], anchor)) for r in fresh], object)
            else:
                score = block.scores(fresh, anchor, bound < 1 << 53)
            ids = block.ids[fresh]
            for w in open_windows:
                low, high = windows[w]
                inside = np.ones(len(fresh), bool)
                if low is not None:
                    inside &= score >= low
                if high is not None:
                    inside &= score <= high
                if inside.any():
                    s, i = np.concatenate([found[w][0], score[inside]]), np.concatenate([found[w][1], ids[inside]])
                    top = best_of(s, i, k)
                    found[w] = s[top], i[top]
        if depth < n and len(weights):
            last = np.concatenate([values[block.lists[down, n - depth], down], values[block.lists[up, depth - 1], up]])
            threshold = sum(int(a) * int(b) for a, b in zip(weights, last)) if big or bound >= 1 << 53 else int(
                weights.astype(np.float64) @ last.astype(np.float64))
            open_windows = [w for w in open_windows
                            if not ((windows[w][0] is not None and threshold < windows[w][0])
                                    or (len(found[w][0]) == k and threshold < found[w][0][-1]))]


def _search(rows: DataFrame, anchors: DataFrame, by_label: bool, k: int) -> DataFrame:
    """(row, high, score, id): per anchor and window the first ``k`` rows of every slice.

    ``rows`` has vec_id, label, row (a number of its own), dim and data (the integers);
    ``anchors`` the same with windows, an array of (low, high). ``by_label``: among
    the anchor's own label, else among the others.
    """
    slices = shuffle_partitions(rows.sparkSession)
    keys = ["dim"] + (["label"] if by_label else [])
    # Groups of anchors that meet the same rows; their number follows the number of anchors.
    sizes = anchors.groupBy(*keys).agg(F.ceil(F.count("*") / GROUP).cast("int").alias("groups"))
    sizes = materialise(sizes, "anchor-groups")
    columns = ["vec_id", "label", "row", "dim", "data", "windows"]
    # Slices by content, not by place: a recomputed task deals the same way.
    a = (anchors.join(sizes, keys).withColumn("g", F.pmod(F.xxhash64("row"), F.col("groups")).cast("int"))
         .withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))))
    r = (rows.join(sizes, keys).withColumn("s", F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int"))
         .withColumn("g", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
         .withColumn("windows", F.lit(None).cast(anchors.schema["windows"].dataType)))
    own = F.col("label") if by_label else F.lit(0).cast("long")
    unit = ["dim", "own", "g", "s"]
    dealt = (a.withColumn("own", own).select(*unit, F.lit(0).alias("side"), *columns[:3], "data", "windows").unionByName(
        r.withColumn("own", own).select(*unit, F.lit(1).alias("side"), *columns[:3], "data", "windows"))
        .repartition(slices, *unit).sortWithinPartitions(*unit, "side"))

    def integers(datas, dim):
        import numpy as np

        if all(len(d) == 8 * dim for d in datas):
            return np.frombuffer(b"".join(datas), "<i8").reshape(len(datas), dim)
        return np.array([[int(x) for x in d.decode().split(",")] if len(d) != 8 * dim
                         else np.frombuffer(d, "<i8").tolist() for d in datas], object).reshape(len(datas), dim)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def search(group, held):
            if not held or not group:
                return
            dim = held[0][0]
            block = Block(np.array([h[1] for h in held], np.int64), np.array([h[2] for h in held], np.int64),
                          integers([h[4] for h in held], dim))
            numbers = np.array([h[3] for h in held], np.int64)
            for anchor in group:
                eligible = (block.labels == anchor["label"]) == by_label
                eligible &= numbers != anchor["row"]
                if eligible.any():
                    threshold_search(block, anchor["vector"], eligible, anchor["windows"], anchor["found"], k)

        def flush(group):
            out = [(a["row"], n, s, i) for a in group for n, (scores, ids) in enumerate(a["found"])
                   for s, i in zip(scores.tolist(), ids.tolist())]
            for s in range(0, len(out), 50_000):
                row, n, score, ids = zip(*out[s:s + 50_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row, pa.int64()), pa.array(n, pa.int32()),
                     # Scores beyond 64 bits end at its limits, after all comparisons within the unit.
                     pa.array([min(MOST, max(LEAST, x)) for x in score], pa.int64()), pa.array(ids, pa.int64())],
                    ["row", "window", "score", "id"])

        key, group, held = None, [], []
        for b in batches:
            cols = [b.column(c).to_pylist() for c in (*unit, "side", "vec_id", "label", "row", "data", "windows")]
            for dim, own_label, g, s, side, vec_id, label, row, data, windows in zip(*cols):
                if (dim, own_label, g, s) != key:
                    search(group, held)
                    yield from flush(group)
                    key, group, held = (dim, own_label, g, s), [], []
                if side == 0:
                    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
                    group.append({"label": label, "row": row, "vector": integers([data], dim)[0],
                                  "windows": [(w["low"], None if w["high"] == MOST else w["high"])
                                              for w in windows],
                                  "found": [none for _ in windows]})
                elif group:
                    held.append((dim, vec_id, label, row, data))
                    if len(held) == BLOCK:
                        search(group, held)
                        held = []
        search(group, held)
        yield from flush(group)

    return dealt.mapInArrow(run, "row bigint, window int, score bigint, id bigint")


def _integers(vectors: DataFrame) -> DataFrame:
    """The rows that take part, with data: the integers, eight bytes each, or as text where one needs more."""
    valid = F.coalesce(F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))),
                       F.lit(False))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & valid)

    def run(batches):
        from math import floor

        import numpy as np
        import pyarrow as pa

        for b in batches:
            lists = b.column("vector")
            flat = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            ends = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))).astype(int)
            small = np.abs(flat) < 2.0 ** 62
            numbers = np.where(small, flat, 0).astype("<i8")
            original = lists.flatten().to_numpy(zero_copy_only=False)
            data = [numbers[s:e].tobytes() if small[s:e].all() else ",".join(
                # SCALE is a power of two: exact as an integer, also where the double would overflow.
                str(floor(x) * SCALE if abs(x) > 2.0 ** 53 else floor(SCALE * x)) for x in original[s:e].tolist()).encode()
                for s, e in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(np.diff(ends).astype(np.int32)),
                 pa.array(data, pa.binary())], ["vec_id", "label", "dim", "data"])

    return rows.mapInArrow(run, "vec_id bigint, label bigint, dim int, data binary")


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor: str = "vec_id % 100 = 0", id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label", k: int = K,
                   least_percent: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` is a condition on vec_id and label. An anchor's positives are its
    first ``k`` other rows of the same label; per positive the first ``k`` rows of
    other labels with least_percent * positive <= 100 * negative <= 100 * positive,
    by score, ties by smaller id. Scores are inner products of the components
    times 256, rounded down, with vectors of the same length.

    Rows whose id, label or vector is NULL, or whose vector holds a NULL or
    non-finite component, take no part. Rows that repeat an id are rows of their
    own: a copy of an anchor is one of its other rows, and a repeated anchor has
    results of its own. Empty vectors score 0 with each other. Scores beyond 64 bits
    are compared exactly inside a unit of work and returned as the limit of 64
    bits; a window with that limit as its upper end has no upper end.
    An empty table gives an empty result.
    """
    table = pick(vectors, vec_id=id_col, vector=vector_col, label=label_col)
    table = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias(
        "vector"), F.col("label").cast("long").alias("label"))
    rows = materialise(_integers(table).withColumn("row", F.monotonically_increasing_id()), "rows")
    anchors = materialise(rows.where(anchor), "anchors")
    open_window = F.expr("array(named_struct('low', cast(null as bigint), 'high', cast(null as bigint)))")
    near = _search(rows, anchors.withColumn("windows", open_window), True, k)
    positives = materialise(_ranked(near, ["row"], k).select(
        "row", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.col("rank").alias("positive")), "positives")
    # A window per positive score above or at 0; below 0 no score is at once above and below.
    limits = positives.where("positive_score >= 0").select(
        "row", F.expr(f"(cast(positive_score as decimal(38, 0)) * {least_percent} + 99) div 100").alias("low"),
        F.col("positive_score").alias("high")).distinct()
    # At most k windows an anchor; in order, so that a window's place names it.
    windows = materialise(limits.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias(
        "windows")), "windows")
    far = _search(rows, anchors.join(windows, "row"), False, k)
    ranked = _ranked(far, ["row", "window"], k)
    scored = (windows.select("row", F.posexplode("windows").alias("window", "w"))
              .select("row", "window", F.col("w.high").alias("positive_score")))
    return (positives.join(scored, ["row", "positive_score"]).join(ranked, ["row", "window"])
            .join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                    F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
