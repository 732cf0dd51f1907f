"""Shared helpers: scratch tables in the shared folder, Arrow mapping over
documents, and connected components of an edge table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aggrex.session import checkpoint_dir


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with a copy that all executors see: what was computed is
    neither run twice by later consumers nor lost with an executor.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{label}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under their canonical names, whatever else ``df`` has."""
    return df.select(*[df[src].alias(name) for name, src in columns.items()])


def fold(doc_id: Column | str, n: int = 3) -> Column:
    """crc32 of the id's decimal text, modulo ``n``; NULL ids count as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def bounded_sample(rows: DataFrame, most: int, *by: str) -> DataFrame:
    """``rows`` as they are when there are at most ``most``; else one of each value of ``by``, the first ``most``
    by the hash of ``by``. ``rows`` is a stored table; only hashes are sorted."""
    if rows.count() <= most:
        return rows
    hashed = rows.withColumn("_hash", F.xxhash64(*by)).dropDuplicates(["_hash"])
    last = hashed.select("_hash").orderBy("_hash").limit(most).agg(F.max("_hash")).first()[0]
    return hashed.where(F.col("_hash") <= last).drop("_hash")


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the
    smallest node reachable.

    Alternating large-star / small-star contraction: every round hangs each
    node's neighbours on the node's smallest one, so chains halve and trees end
    as stars. Edges only ever move between nodes; no group is collected. The
    smallest parents are written as a table of their own, so that the join with
    the edges runs between two plain shuffles and adaptive execution can split
    a parent that holds a large share of the edges. ``max_rounds`` is a guard
    against a run without progress (rounds grow with the logarithm of the node
    count), it raises instead of returning partial groups.
    """
    e = (edges.where("a <> b")
         .select(F.greatest("a", "b").alias("c"), F.least("a", "b").alias("p")).distinct())
    e = materialise(e, "edges-0")
    state = _edge_state(e)
    for i in range(max_rounds):
        if state[0] == 0:
            break
        parents = materialise(e.groupBy("c").agg(F.min("p").alias("m")), f"parents-{i}")
        up = parents.select(F.col("c").alias("p"), F.col("m").alias("pm"))
        # Large star: the child goes to its parent's smallest parent.
        large = (e.join(up, "p", "left").select("c", F.coalesce("pm", "p").alias("p")).distinct())
        # Small star: a child's parents go to the smallest of them.
        least = large.groupBy("c").agg(F.min("p").alias("m"), F.max("p").alias("x"))
        several = least.where("x > m").select("c", "m")
        moved = large.join(several, "c").where("p > m").select(F.col("p").alias("c"), F.col("m").alias("p"))
        e2 = least.select("c", F.col("m").alias("p")).unionByName(moved).distinct()
        e2 = materialise(e2, f"edges-{i + 1}")
        new = _edge_state(e2)
        e = e2
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("connected components did not settle")
    roots = e.select(F.col("p").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("c").alias("node"), F.col("p").alias("component")).unionByName(roots)


def _edge_state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("c", "p"), F.lit(1 << 40)))).first()
    return r[0], r[1]
