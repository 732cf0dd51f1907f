"""Operator 6: SimHash near-duplicates by a binary trie self-join.

Distinct fingerprints are the leaves of a binary trie. Node pairs are walked
down together, differing bits are added up, and a pair is given up as soon as
it exceeds the error budget. To deal the trie over tasks, the bits are cut into
``blocks`` blocks and ``clean`` of them are put at the top of the trie, once
for every choice: ``max_distance`` errors touch at most that many blocks, so
each link has a choice whose blocks agree, and only subtrees with an equal top
need to meet. A subtree is one unit of work; one with more leaves than a task
should hold is dealt by leaf hash into slices and its slices meet pairwise.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aggrex.llm.bpe import text_batches
from aggrex.llm.common import connected_components, materialise, pick, shuffle_partitions

BITS = 64
UNIT_LEAVES = 2048  # leaves of a subtree that one unit of work holds


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp, text_hash): the 64-bit SimHash of every whole text, as a signed long.

    A-Z are lower-cased, words are runs without ASCII white space, shingles are
    ``shingle_words`` words joined by a blank (repeats count; a shorter text is
    one shingle), hashed by XXH64 of their UTF-8 bytes. A bit is set if it is
    set in over half the hashes. No words, or NULL: zero. text_hash (XXH64 of the
    whole text) tells unlike texts of one id apart.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        hash64, n = xxhash.xxh64_intdigest, shingle_words
        for b, texts in text_batches(batches):
            out = np.zeros(len(texts), np.uint64)
            for i, text in enumerate(texts):
                # bytes.lower() and bytes.split() know A-Z and the six ASCII blanks only.
                words = text.encode().lower().split()
                if not words:
                    continue
                joined = b" ".join(words)
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
                first = [0, *ends[:max(0, len(words) - n)].tolist()]
                stop = (ends[min(n, len(words)) - 1:] - 1).tolist()
                h = np.fromiter((hash64(joined[s:e], seed) for s, e in zip(first, stop)), np.uint64, len(stop))
                ones = np.zeros(BITS, np.int64)
                for at in range(0, len(h), 65536):  # long texts: bounded memory
                    ones += np.unpackbits(h[at:at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(
                        axis=0, dtype=np.int64)
                out[i] = np.packbits(ones * 2 > len(h)).view(">u8")[0]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(out.view(np.int64)),
                                              b.column("text_hash")], ["doc_id", "fp", "text_hash"])

    return pick(docs, doc_id=id_col, text=text_col).withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        run, "doc_id bigint, fp bigint, text_hash bigint")


def choices(n_leaves: int, max_distance: int) -> tuple[int, list[tuple[int, ...]]]:
    """(number of blocks, choices of clean blocks) for a trie of ``n_leaves``.

    ``max_distance`` errors leave at least ``blocks - max_distance`` blocks
    clean. More blocks give longer tops, for larger tries, and more choices;
    the shortest top under which a subtree of random leaves stays small is taken.
    """
    for clean in range(1, 5):
        blocks = max_distance + clean
        if blocks >= 16 or n_leaves >> (BITS * clean // blocks) <= UNIT_LEAVES // 4:
            break
    return blocks, list(combinations(range(blocks), clean))


def _links_within(fp, a_rows, b_rows, budget, unit=None):
    """Trie pair walk between two sorted leaf sets; yields arrays of linked leaf numbers.

    ``a_rows is b_rows`` is a self-join; ``unit`` then numbers the subtrees that
    the leaves belong to, and each subtree meets itself only. Nodes are runs of
    leaves with equal leading bits; a step takes 4 bits. Pairs wait on a stack,
    in pieces of bounded size. A pair whose leaves are known to be one
    component is dropped.
    """
    import numpy as np

    step, depths = 4, BITS // 4
    own = a_rows is b_rows

    def levels(rows):
        keys = fp[rows]
        cut = unit[1:] != unit[:-1] if unit is not None else np.zeros(len(rows) - 1, bool)
        out = []
        for d in range(depths + 1):
            if d:
                top = keys >> np.uint64(BITS - step * d) if d < depths else keys
                cut = cut | (top[1:] != top[:-1])
            out.append(np.concatenate([[0], np.flatnonzero(cut) + 1, [len(rows)]]))
        return out

    a_levels = levels(a_rows)
    b_levels = a_levels if own else levels(b_rows)
    a_keys, b_keys = fp[a_rows], fp[b_rows]
    parent = np.arange(len(fp))

    def roots():
        p = parent
        while True:
            q = p[p]
            if (q == p).all():
                return p
            p = q

    ones = np.array([bin(i).count("1") for i in range(16)], np.int64)
    tops = np.arange(len(a_levels[0]) - 1)
    stack = [(0, tops, tops, np.zeros(len(tops), np.int64))]
    while stack:
        d, a, b, err = stack.pop()
        if d:
            # One component already: nothing to learn below this pair.
            root = parent[:] = roots()
            ra, rb = root[a_rows], root[b_rows]
            lo_a, hi_a = np.minimum.reduceat(ra, a_levels[d][:-1]), np.maximum.reduceat(ra, a_levels[d][:-1])
            lo_b, hi_b = (lo_a, hi_a) if own else (np.minimum.reduceat(rb, b_levels[d][:-1]),
                                                   np.maximum.reduceat(rb, b_levels[d][:-1]))
            live = (lo_a[a] != hi_a[a]) | (lo_b[b] != hi_b[b]) | (lo_a[a] != lo_b[b])
            a, b, err = a[live], b[live], err[live]
        if not len(a):
            continue
        if d == depths:
            la, lb = a_rows[a_levels[d][a]], b_rows[b_levels[d][b]]
            differ = la != lb
            la, lb = la[differ], lb[differ]
            while len(la):
                # Hang the larger root below the smaller one until all these links hold.
                root = roots()
                x, y = root[la], root[lb]
                apart = x != y
                if not apart.any():
                    parent[:] = root
                    break
                la, lb, x, y = la[apart], lb[apart], x[apart], y[apart]
                big, small = np.maximum(x, y), np.minimum(x, y)
                _, once = np.unique(big, return_index=True)
                parent[:] = root
                parent[big[once]] = small[once]
                yield la[once], lb[once]
            continue
        # Children of both nodes, every pair of them within the budget.
        a_cut = np.searchsorted(a_levels[d + 1], a_levels[d])
        b_cut = np.searchsorted(b_levels[d + 1], b_levels[d])
        na, nb = a_cut[a + 1] - a_cut[a], b_cut[b + 1] - b_cut[b]
        total = na * nb
        pair = np.repeat(np.arange(len(a)), total)
        at = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
        ca = a_cut[a][pair] + at // nb[pair]
        cb = b_cut[b][pair] + at % nb[pair]
        shift = np.uint64(BITS - step * (d + 1))
        bits_a = (a_keys[a_levels[d + 1][ca]] >> shift) & np.uint64(15)
        bits_b = (b_keys[b_levels[d + 1][cb]] >> shift) & np.uint64(15)
        e = err[pair] + ones[(bits_a ^ bits_b).astype(np.int64)]
        fits = e <= budget
        if own:
            fits &= ca <= cb
            if d + 1 == depths:
                fits &= ca < cb
        ca, cb, e = ca[fits], cb[fits], e[fits]
        for s in range(0, len(ca), 65536):
            stack.append((d + 1, ca[s:s + 65536], cb[s:s + 65536], e[s:s + 65536]))


def trie_links(leaves: DataFrame, max_distance: int = 4) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) at ``max_distance``
    or fewer differing bits, enough of them to connect all that link (exact
    groups; links inside a group already known are skipped)."""
    spark = leaves.sparkSession
    count = leaves.count()
    if count < 2:
        return spark.createDataFrame([], "a bigint, b bigint")
    blocks, picks = choices(count, max_distance)
    edge = [BITS * i // blocks for i in range(blocks + 1)]

    def top(choice):
        """The clean blocks' bits in place, and the choice's number above them."""
        mask = sum(((1 << (edge[i + 1] - edge[i])) - 1) << (BITS - edge[i + 1]) for i in choice)
        mask -= (mask >> 63) << 64
        return F.col("fp").bitwiseAND(F.lit(mask))

    tops = leaves.select("fp", F.posexplode(F.array(*[top(c) for c in picks])).alias("choice", "top"))
    heavy = materialise(
        tops.groupBy("choice", "top").count().where(f"count > {UNIT_LEAVES}")
        .select("choice", "top", F.ceil(F.col("count") / F.lit(UNIT_LEAVES // 2)).cast("int").alias("slices")),
        "heavy-subtrees")
    if heavy.isEmpty():
        dealt = tops.withColumns({"s": F.lit(0), "t": F.lit(0), "mine": F.lit(True), "theirs": F.lit(True)})
    else:
        cut = tops.join(heavy, ["choice", "top"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
        cut = cut.withColumn("me", F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int"))
        dealt = (cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
                 .withColumns({"s": F.least("me", "other"), "t": F.greatest("me", "other")})
                 .withColumns({"mine": F.col("me") == F.col("s"), "theirs": F.col("me") == F.col("t")}))
    parts = shuffle_partitions(spark)
    dealt = (dealt.select("choice", "top", "s", "t", "mine", "theirs", "fp")
             .repartition(parts, "choice", "top", "s", "t")
             .sortWithinPartitions("choice", "top", "s", "t"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def links(keys, fp, mine, theirs):
            unit = np.concatenate([[0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))])
            order = np.lexsort([fp, unit])
            unit, fp, mine, theirs = unit[order], fp[order], mine[order], theirs[order]
            whole = np.flatnonzero(keys[2][order] == keys[3][order])
            if len(whole):
                rows = np.arange(len(whole))
                found = fp[whole]
                for a, b in _links_within(found, rows, rows, max_distance, unit[whole]):
                    yield found[a], found[b]
            for u in np.unique(unit[keys[2][order] != keys[3][order]]):
                at = np.flatnonzero(unit == u)
                rows_a, rows_b = np.flatnonzero(mine[at]), np.flatnonzero(theirs[at])
                if len(rows_a) and len(rows_b):
                    found = fp[at]
                    for a, b in _links_within(found, rows_a, rows_b, max_distance):
                        yield found[a], found[b]

        def out(rows):
            for a, b in links(*rows):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                                 ["a", "b"])

        held = None  # rows of the unit that the last batch ended in
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                             for c in ("choice", "top", "s", "t")])
            fp = batch.column("fp").to_numpy().view(np.uint64)
            mine, theirs = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("mine", "theirs"))
            if held is not None:
                keys, fp, mine, theirs = (np.concatenate([x, y], axis=-1)
                                          for x, y in zip(held, (keys, fp, mine, theirs)))
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            s = cuts[-1] if len(cuts) else 0
            if s:
                yield from out((keys[:, :s], fp[:s], mine[:s], theirs[:s]))
            held = keys[:, s:], fp[s:], mine[s:], theirs[s:]
        if held is not None:
            yield from out(held)

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _groups(prints: DataFrame, max_distance: int) -> DataFrame:
    """(fp, component, component_id) of every fingerprint: the least fingerprint and the least doc_id
    of its group. Copies are merged to one leaf before any join."""
    leaves = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "leaves")
    edges = materialise(trie_links(leaves, max_distance), "links")
    if edges.isEmpty():
        named = leaves.select("fp", F.col("fp").alias("component"), F.col("first_id").alias("component_id"))
    else:
        groups = materialise(connected_components(edges), "groups").withColumnRenamed("node", "fp")
        member = leaves.join(groups, "fp").select("fp", "component", "first_id")
        least = member.groupBy("component").agg(F.min("first_id").alias("component_id"))
        linked = materialise(groups.join(least, "component").select(
            "fp", "component", F.col("component_id").alias("linked_id")), "linked")
        named = leaves.join(linked, "fp", "left").select(
            "fp", F.coalesce("component", "fp").alias("component"),
            F.coalesce("linked_id", "first_id").alias("component_id"))
    return materialise(named, "named")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4,
                   max_distance: int = 4) -> DataFrame:
    """One row per document: doc_id, fp (long), component_id.

    component_id is the smallest doc_id reachable over links of
    ``max_distance`` or fewer differing bits, the document's own included.
    Texts without words share fingerprint zero and link like any other. Rows
    whose id is NULL keep their row and can connect others; a group of such
    rows alone has component_id NULL. Other columns are not read; an empty table
    gives an empty result.
    """
    prints = materialise(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    return prints.join(_groups(prints, max_distance), "fp").select("doc_id", "fp", "component_id")


def keep_one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4,
                           max_distance: int = 4) -> DataFrame:
    """One row of every group, all columns as they were: the one with the least id, of unlike
    texts under one id the one with the least hash of the text. Rows without an id come
    last: they stay only in groups that have no row with an id, one row of each. Of rows
    that repeat id and text the one with the least hash of all columns stays.
    """
    prints = materialise(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    kept = (prints.join(_groups(prints, max_distance), "fp").groupBy("component")
            .agg(F.min(first).alias("k")).select("k.doc_id", "k.text_hash"))
    kept = materialise(kept.select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_text")), "kept")
    columns = docs.columns
    text_hash = F.xxhash64(docs[text_col])
    rows = docs.join(kept, docs[id_col].cast("long").eqNullSafe(F.col("_kept_id"))
                     & (text_hash == F.col("_kept_text")), "left_semi")
    # Rows that repeat id and text: few or none, found without the texts.
    several = prints.groupBy("doc_id", "text_hash").count().where("count > 1")
    twice = materialise(several.select(F.col("doc_id").alias("_twice_id"), F.col("text_hash").alias("_twice_text")),
                        "repeated-rows")
    if not twice.isEmpty():
        same = (rows[id_col].cast("long").eqNullSafe(F.col("_twice_id"))
                & (F.xxhash64(rows[text_col]) == F.col("_twice_text")))
        again = (rows.join(twice, same, "left_semi").select(F.struct(*[F.col(c) for c in columns]).alias("_row"))
                 .groupBy(F.col("_row")[id_col].alias("_id"), F.xxhash64(F.col("_row")[text_col]).alias("_text"))
                 .agg(F.min_by("_row", F.xxhash64("_row")).alias("_row")).select("_row.*"))
        rows = rows.join(twice, same, "left_anti").unionByName(again)
    return rows.select(columns)
