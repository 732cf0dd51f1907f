"""Sources and sinks (A1-A8, A10, A11): typed readers of dumped API responses
and extract tables, and the partitioned writers.

Schemas are always given, never inferred. Extract tables are one Parquet
dataset partitioned by (data_type, extract_id, extract_period): readers
filter on the partition columns so Spark prunes files instead of listing a
folder per period.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aggrex.functions.periods import frequency_of
from aggrex.schemas import (ANALYTICS, CATEGORY_COMBO, COMPLETION, DATA_POINT, DATA_POINT_COLUMNS,
                            DATA_VALUE, DATASET, ORG_UNIT)

# Fixed value: the folder name of a NULL partition value.
NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"
EXTRACT_PARTITIONS = ["data_type", "extract_id", "extract_period"]
# The extract table: data point columns plus the partition columns, all text
# (period labels such as 202401 must never be inferred as numbers).
EXTRACT_TABLE = T.StructType(DATA_POINT.fields + [T.StructField("extract_id", T.StringType()),
                                                  T.StructField("extract_period", T.StringType())])


def read_extract_table(spark: SparkSession, root: str) -> DataFrame:
    """The partitioned extract table with its fixed schema."""
    return spark.read.schema(EXTRACT_TABLE).parquet(root)


def _reader(spark: SparkSession, schema, fmt: str, **options):
    r = spark.read.schema(schema).format(fmt)
    for k, v in options.items():
        r = r.option(k, v)
    return r


def _canonical(df: DataFrame) -> DataFrame:
    from aggrex.operators.normalise import canonical_data_type
    return canonical_data_type(df)


def scan_extract(spark: SparkSession, path: str, require_rows: bool = True) -> DataFrame:
    """A1: one extract (9-column data point table). A missing path raises
    (analysis error); an empty extract raises when ``require_rows``. First-
    generation type names (DATAELEMENT, DATASET) are mapped at ingest."""
    df = spark.read.schema(DATA_POINT).parquet(path)
    if require_rows and df.isEmpty():
        raise ValueError(f"extract is empty: {path}")
    return _canonical(df)


def scan_extracts_for_period(spark: SparkSession, root: str, period: str,
                             include_year: bool = False) -> DataFrame:
    """A2: every extract of ``period`` from the partitioned extract table (the
    file-name pattern of the reference becomes a partition filter, so only the
    period's folders are read). ``include_year`` adds the yearly extracts."""
    df = read_extract_table(spark, root)
    periods = [period, period[:4]] if include_year else [period]
    return df.where(F.col("extract_period").isin(*periods))


def scan_extracts_for_periods(spark: SparkSession, root: str, periods: DataFrame) -> DataFrame:
    """A2 for many periods at once: ``periods`` is (extract_period). The join on
    the partition column lets dynamic partition pruning skip every folder whose
    period is not requested; the period list is broadcast behind a size check."""
    from aggrex.operators.dims import sized_broadcast
    df = read_extract_table(spark, root)
    return df.join(sized_broadcast(periods.select("extract_period").distinct()), "extract_period", "left_semi")


# What the Parquet and JSON readers say, in the chain of causes, of a file they cannot make sense of.
# Spark's own FAILED_READ_FILE says as much of a file that it could not get at.
DAMAGE_CAUSES = ["is not a Parquet file", "CANNOT_READ_FILE_FOOTER", "ParquetDecodingException", "ParquetCryptoRuntime",
                 "can not read class org.apache.parquet.format", "TProtocolException", "could not read page",
                 "CorruptStatistics", "MALFORMED_RECORD_IN_PARSING", "MalformedInputException", "PARQUET_COLUMN_DATA_TYPE",
                 "FAILED_READ_FILE.PARQUET", "SNAPPY", "ZstdIOException", "Corrupted block", "negative value in size"]
# What such a message holds when the file itself is not to blame.
NO_DAMAGE = ["FILE_NOT_EXIST", "FileNotFoundException", "AccessControlException", "Permission denied", "OutOfMemoryError",
             "ExecutorLostFailure", "FetchFailed", "No space left on device", "Connection refused", "SocketTimeout"]


def is_damage(error: Exception) -> bool:
    """The reader could not make sense of a file, as opposed to not getting at it."""
    text = str(error)
    return not any(x in text for x in NO_DAMAGE) and any(x in text for x in DAMAGE_CAUSES)


def split_readable(spark: SparkSession, paths: list[str], schema=DATA_POINT, fmt: str = "parquet",
                   base_path: str | None = None) -> tuple[list[str], list[tuple[str, str]]]:
    """(readable paths, [(unreadable path, error)]). Every column of every row is
    read: footers say nothing about damaged pages. All files are read in one
    job; only if that fails are halves tried, until the damaged files stand
    alone, so the extra jobs grow with the damaged files."""
    def reads(some: list[str]) -> str | None:
        r = spark.read.schema(schema).format(fmt).option("ignoreCorruptFiles", "false")
        if base_path:
            r = r.option("basePath", base_path)
        try:
            r.load(some).write.format("noop").mode("overwrite").save()
        except (PySparkException, Py4JJavaError) as e:
            if not is_damage(e):
                raise
            lines = [x for x in str(e).strip().splitlines() if "Exception: " in x or x.startswith("[")]
            return (lines or [type(e).__name__])[0].strip()[:500]
        return None

    good, bad, todo = [], [], [list(paths)] if paths else []
    while todo:
        some = todo.pop()
        error = reads(some)
        if error is None:
            good += some
        elif len(some) == 1:
            bad.append((some[0], error))
        else:
            todo += [some[:len(some) // 2], some[len(some) // 2:]]
    return sorted(good), sorted(bad)


UNREADABLE_FILE = "path string, error string"


def unreadable_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """(path, error) of the extract files under ``root`` that cannot be read in
    full — damaged, truncated or partly readable ones."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "true").load(root).select("path"))
    paths = [r["path"] for r in listed.toLocalIterator()]
    return spark.createDataFrame(split_readable(spark, paths)[1], UNREADABLE_FILE)


def scan_extract_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """A2 for foreign, non-partitioned folders: all files matching ``glob``
    (e.g. ``*_extract_202401.parquet``) with the data point schema; first-
    generation type names are mapped at ingest."""
    return _canonical(spark.read.schema(DATA_POINT).option("pathGlobFilter", glob).parquet(folder))


def with_row_order(scan: DataFrame, fmt: str = "parquet") -> DataFrame:
    """``scan`` (a direct read of files) with ``row_order``: rows of one file in their order,
    files by path — the input order, however Spark packs files into partitions. A
    Parquet row knows its place in the file; a line of text has its block's start and its
    place among the block's rows, which one task reads in order."""
    place = (F.col("_metadata.row_index") if fmt == "parquet" else F.monotonically_increasing_id())
    block = F.lit(0).cast("long") if fmt == "parquet" else F.col("_metadata.file_block_start")
    return scan.select("*", F.struct(F.col("_metadata.file_path").alias("file"), block.alias("block"),
                                     place.alias("place")).alias("row_order"))


def scan_pyramid(spark: SparkSession, path: str, fmt: str = "parquet", row_order: bool = False) -> DataFrame:
    """A3: organisation units with their nine fields (JSON dump or Parquet), with
    ``row_order`` also the input order ("the last row of an id wins", C2)."""
    if fmt == "json":
        out = _reader(spark, ORG_UNIT, "json").load(path)
    else:
        out = spark.read.schema(ORG_UNIT).parquet(path)
    return with_row_order(out, fmt) if row_order else out


# Dataset metadata as paged by the API: one row per (dataset, page).
DATASET_PAGE = T.StructType(DATASET.fields + [T.StructField("ds_pos", T.IntegerType()),
                                              T.StructField("page", T.LongType())])


def scan_dataset_metadata(spark: SparkSession, path: str, fmt: str = "json", schema=DATASET) -> DataFrame:
    """A4: datasets with org unit and data element lists (``DATASET_PAGE``
    for paged dumps)."""
    return _reader(spark, schema, fmt).load(path)


def dataset_bridges(datasets: DataFrame, carry: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """A4: (dataset_id, pos, org_unit) and (dataset_id, pos, data_element).
    Metadata may arrive in pages (one row per page): ``carry`` keeps the page."""
    ou = datasets.select(F.col("id").alias("dataset_id"), *carry,
                         F.posexplode("organisation_units").alias("pos", "org_unit"))
    de = datasets.select(F.col("id").alias("dataset_id"), *carry,
                         F.posexplode("data_elements").alias("pos", "data_element"))
    return ou, de


def scan_category_combos(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """A5 input: category combos with their option combos."""
    return _reader(spark, CATEGORY_COMBO, fmt).load(path)


def category_combo_bridge(combos: DataFrame, configured: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A5: (cat_combo, coc) for the *distinct* configured combos, and the
    configured combos that do not exist (to be reported, not silently used)."""
    wanted = configured.select("cat_combo").distinct()
    known = combos.select(F.col("id").alias("cat_combo"),
                          F.explode("categoryOptionCombos").alias("c"))
    bridge = (known.join(wanted, "cat_combo", "left_semi")
                   .select("cat_combo", F.col("c.id").alias("coc")))
    unknown = wanted.join(combos.select(F.col("id").alias("cat_combo")), "cat_combo", "left_anti")
    return bridge, unknown


def scan_data_values(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Raw data value set rows."""
    return _reader(spark, DATA_VALUE, fmt).load(path)


def rename_analytics(df: DataFrame) -> DataFrame:
    """Analytics columns pe / ou / co -> period / orgUnit / categoryOptionCombo."""
    return df.withColumnsRenamed({"pe": "period", "ou": "orgUnit", "co": "categoryOptionCombo"})


def scan_analytics(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Analytics cells (dx, pe, ou, co, value) renamed."""
    return rename_analytics(_reader(spark, ANALYTICS, fmt).load(path))


def scan_completions(spark: SparkSession, path: str, fmt: str = "json", schema=COMPLETION,
                     corrupt_column: str | None = None) -> DataFrame:
    """A8 input: dataset completion registrations (``completions_under`` narrows
    them to a dataset, a period and a subtree). With ``corrupt_column``,
    lines that are not valid JSON (failed fetches) are kept with their raw
    text in that column instead of being read as all-NULL rows."""
    if corrupt_column:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType())])
        return _reader(spark, schema, fmt, mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt_column).load(path)
    return _reader(spark, schema, fmt).load(path)


def write_extract(df: DataFrame, root: str, extract_id: str | None = None,
                  extract_period=None, files_per_partition: int | None = None,
                  feed: bool = True) -> DataFrame | None:
    """A10: write data points into the partitioned extract table, replacing
    only the partitions present in ``df`` (dynamic partition overwrite; the
    output commit protocol makes the replacement task-atomic).

    Returns the (data_type, extract_id, extract_period, frequency) partitions
    written — the change feed for K3 (the session needs a checkpoint folder);
    nothing without ``feed``. ``write_extract_version`` makes the change of all
    partitions, and its feed, one commit.

    The write shuffle is a range partitioning on (partition columns, row
    ordinal): Spark samples the data, so a hot period is split over as many
    writer tasks as its size needs while each task still writes into few
    partition folders. ``files_per_partition`` instead hash-spreads each
    partition over exactly that many tasks (small, predictable file counts).
    """
    out = df
    if extract_id is not None:
        out = out.withColumn("extract_id", F.lit(extract_id))
    if extract_period is not None:
        out = out.withColumn("extract_period", extract_period if not isinstance(extract_period, str)
                             else F.lit(extract_period))
    out = out.select(*DATA_POINT_COLUMNS, *[c for c in EXTRACT_PARTITIONS if c not in DATA_POINT_COLUMNS])
    if files_per_partition:
        salt = F.pmod(F.xxhash64(*DATA_POINT_COLUMNS), F.lit(files_per_partition))
        spread = out.repartition(*EXTRACT_PARTITIONS, salt)
    else:
        # The row ordinal (not a content hash) closes the key, so even
        # identical copies spread over writer tasks.
        spread = out.repartitionByRange(*EXTRACT_PARTITIONS, F.monotonically_increasing_id())
    # The feed comes from the rows themselves, not from the table: it costs no
    # scan of the extract's history, and later writes cannot change it.
    rows = (out.select(*EXTRACT_PARTITIONS).distinct().withColumn("frequency", frequency_of("extract_period"))
            .checkpoint(eager=True)) if feed else None
    (spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*EXTRACT_PARTITIONS).parquet(root))
    return rows


# The switch of a versioned extract table: one row per partition and version.
SWITCH = ("version string, data_type string, extract_id string, extract_period string, frequency string, "
          "written_at timestamp")


def write_extract_version(df: DataFrame, root: str, extract_id: str | None = None, extract_period=None,
                          files_per_partition: int | None = None, version: str | None = None) -> DataFrame:
    """A10 for readers that must never see half of a rewrite: the data goes into a
    folder of its own (``data/version=...``), then one file with a row per partition
    switches all of them at once (``switches``). Until that file stands, readers
    see the old extract; a writer that dies before leaves a folder nobody reads.

    The switch file is the change feed as well (K3): what is written and what is to be
    queued are one commit. Returns its rows. ``version`` names sort by time; a
    repeated write of one version replaces it.
    """
    spark = df.sparkSession
    version = version or f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    folder = f"{root}/data/version={version}"
    write_extract(df, folder, extract_id, extract_period, files_per_partition, feed=False)
    # From the files that were written: no second evaluation of the input. An empty write has no folder.
    written = (spark.read.schema(EXTRACT_TABLE).parquet(folder).select(*EXTRACT_PARTITIONS).distinct()
               .withColumn("frequency", frequency_of("extract_period")))
    # One task, one file: its rename is the switch. A row per partition of this write.
    (written.select(F.lit(version).alias("version"), *EXTRACT_PARTITIONS, "frequency",
                    F.current_timestamp().alias("written_at")).coalesce(1)
     .write.mode("overwrite").parquet(f"{root}/switches/of={version}"))
    return spark.read.schema(SWITCH).parquet(f"{root}/switches/of={version}")


def read_switches(spark: SparkSession, root: str) -> DataFrame:
    """All switches of a versioned extract table so far."""
    return spark.read.schema(f"{SWITCH}, of string").parquet(f"{root}/switches").drop("of")


def read_extract_versions(spark: SparkSession, root: str, switches: DataFrame | None = None) -> DataFrame:
    """The versioned extract table: every partition in its latest version. The
    switches that are there when the table is opened decide (or those given, to read
    an earlier state); the join prunes folders."""
    from aggrex.operators.dims import sized_broadcast

    seen = read_switches(spark, root) if switches is None else switches
    latest = seen.groupBy(*EXTRACT_PARTITIONS).agg(F.max("version").alias("version"))
    # What counts is the state now, whenever the rows are read.
    latest = latest.checkpoint(eager=True)
    schema = T.StructType(EXTRACT_TABLE.fields + [T.StructField("version", T.StringType())])
    data = spark.read.schema(schema).option("basePath", f"{root}/data").parquet(f"{root}/data")
    return data.join(sized_broadcast(latest), [*EXTRACT_PARTITIONS, "version"], "left_semi").drop("version")


def write_payloads(batches: DataFrame, path: str, fmt: str = "parquet",
                   partition_by: list[str] | None = None) -> None:
    """The send-ready batches, one row per request body, optionally one
    folder per ``partition_by`` value (e.g. period). Inside each file the
    rows are in send order (phase, then batch number) so a sequential sender
    can read them as they are. Delivery over HTTP is left to the platform."""
    order = [c for c in ("phase_order", "period", "batch_no") if c in batches.columns]
    out = batches.sortWithinPartitions(*order) if order else batches
    w = out.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
