"""Small dimensions: built from configuration, broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A dimension is broadcast only when its rows are measured to hold at most this many bytes;
# beyond it the join is left to the planner, which measures its inputs as they
# are shuffled (adaptive execution broadcasts what turns out small, and splits
# skewed partitions of what does not).
BROADCAST_BYTES = 16 << 20


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the plan's output: file sizes for scans, unknown
    (huge) for rows handed over by the driver. Reads no data, runs no job; it knows
    nothing of compression and of arrays that are exploded, so it only rules out."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _row_bytes(field: T.StructField) -> Column:
    """Bytes of a column's value in memory: 16 for a number, with the length of texts; nested values as JSON."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.lit(16) + F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.lit(32) + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) * 2
    return F.lit(16)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows that ``df`` really has: one aggregation over it."""
    total = F.lit(0)
    for field in df.schema.fields:
        total = total + _row_bytes(field)
    return df.agg(F.sum(total.cast("long"))).first()[0] or 0


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """The rows take at most ``max_bytes``: counted, unless the estimate is beyond it already."""
    return plan_bytes(df) <= max_bytes and measured_bytes(df) <= max_bytes


def sized_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Return ``df`` with a broadcast hint when its rows are measured to take at most
    ``max_bytes``. A hint that ``df`` has from ``config_dim`` stays in force."""
    return F.broadcast(df) if is_small(df, max_bytes) else df


def settled_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` computed once (checkpointed) and broadcast when its rows are measured to take at most
    ``max_bytes``: for dimensions derived from data, whose estimate is the size of the data."""
    done = df.checkpoint(eager=True)
    return F.broadcast(done) if measured_bytes(done) <= max_bytes else done


def config_dim(spark: SparkSession, rows: list, schema: T.StructType,
               max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A dimension built from configuration rows, whose size the driver knows."""
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(repr(rows)) <= max_bytes else df
