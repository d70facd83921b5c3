"""The file manifest: one row per data file, in commit order (tick, seq, table_name)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.functions.scalars import file_path
from spanloom.operators.stats import file_stats
from spanloom.schemas import Signal
from spanloom.session import estimated_bytes, path_exists

MANIFEST = [
    "table_name",
    "tick",
    "seq",
    "path",
    "record_count",
    "file_size_bytes",
    "commit_time",
    "column_stats",
    "typed_bounds",
    "services",
]

# Estimated size of a manifest's file keys up to which they are sent to all executors.
BROADCAST_BYTES = 256 << 20

_HIGHEST = (1 << 63) - 1

# What a file is found by: the two partition columns of a table's folder, and the name below.
_KEYS = ["regexp_extract(path, '/batch=([^/]+)/', 1) AS batch", "tick", "element_at(split(path, '/'), -1) AS file_name"]


def written_manifest(
    spark: SparkSession, folder: str, signal: Signal, table: str, committed_at: Column | None = None
) -> DataFrame:
    """Manifest of the Parquet files below a batch's folder, read back once for counts and statistics.

    `seq` is the first time in a file; files cut from ordered rows sort by it. A file is committed when it was written,
    or at `committed_at`, which may depend on its tick.
    """
    rows = read_files(spark, folder, signal.schema, extra="tick BIGINT").select(
        "*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("file_size_bytes"),
        F.col("_metadata.file_modification_time").alias("commit_time"),
    )
    files = file_stats(rows, signal, ["tick", "path", "file_size_bytes", "commit_time"])
    first = F.filter("typed_bounds", lambda b: b["column_name"] == signal.time_column)[0]["min_value"]
    return (
        # Once per file, not once per row.
        files.withColumn("path", file_path(F.col("path")))
        .withColumn("table_name", F.lit(table))
        .withColumn("seq", F.coalesce(first, F.lit(0).cast("bigint")))
        .withColumn("commit_time", F.col("commit_time") if committed_at is None else committed_at)
        .select(*MANIFEST)
    )


def read_files(spark: SparkSession, folder: str, schema: T.StructType, extra: str | None = None) -> DataFrame:
    reader = spark.read.schema(f"{_ddl(schema)}, {extra}" if extra else schema)
    return reader.parquet(folder)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def live_files(commits: DataFrame, snapshot_id: int | None = None) -> DataFrame:
    """Files a reader of a snapshot sees, by default of the newest one."""
    end = F.col("end_snapshot")
    if snapshot_id is None:
        return commits.filter(end.isNull())
    return commits.filter((F.col("snapshot_id") <= snapshot_id) & (end.isNull() | (end > snapshot_id)))


def may_hold(column: str, low: int | Column | None = None, high: int | Column | None = None) -> Column:
    """Whether a file's typed bounds overlap [low, high]. Files without bounds are kept.

    Written as plain comparisons, which Spark takes as a reason to prune the partitions of what is joined.
    """
    bounds = F.filter("typed_bounds", lambda b: b["column_name"] == column)[0]
    keep = F.lit(True)
    if low is not None:
        keep = keep & (F.coalesce(bounds["max_value"], F.lit(_HIGHEST)) >= _literal(low))
    if high is not None:
        keep = keep & (F.coalesce(bounds["min_value"], F.lit(-_HIGHEST)) <= _literal(high))
    return keep


def _literal(bound: int | Column) -> Column:
    return bound if isinstance(bound, Column) else F.lit(bound)


def bound(column: str, end: str) -> Column:
    """A file's typed min_value or max_value of a column; NULL if it has none."""
    return F.filter("typed_bounds", lambda b: b["column_name"] == column)[0][end]


def may_hold_service(service: str) -> Column:
    """Whether a file has rows of a service. Files whose services are not known are kept."""
    return F.coalesce(F.array_contains("services", service), F.lit(True)) == F.lit(True)


def newest_time(commits: DataFrame, column: str) -> Column:
    """The latest time in a table as a scalar, from the files' bounds instead of their rows."""
    return commits.agg(F.timestamp_micros(F.max(bound(column, "max_value")))).scalar()


def may_be_among_largest(files: DataFrame, column: str, n: int, surely: Column) -> Column:
    """Whether a file may hold one of the n largest values of a column.

    A file that is `surely` in the range asked for holds its own maximum, so the n-th largest maximum of such files is no
    more than the n-th largest value. With fewer than n such files every file may hold one.
    """
    top = files.filter(surely).select(bound(column, "max_value").alias("m")).filter("m IS NOT NULL").orderBy(F.desc("m")).limit(n)
    least = top.agg(F.when(F.count(F.lit(1)) >= n, F.min("m"))).scalar()
    return F.coalesce(bound(column, "max_value"), F.lit(_HIGHEST)) >= F.coalesce(least, F.lit(-_HIGHEST))


def scan_files(
    spark: SparkSession, files: DataFrame, signal: Signal, table_dir: str, *, keep: list[str] | None = None
) -> DataFrame:
    """Read exactly the files named in a manifest, however many. `keep` names manifest columns that the rows get.

    The table's folder is joined with the manifest on its partition columns and the file name. No path comes to the
    driver: Spark turns the manifest's side into a partition filter when the scan starts (dynamic partition pruning), so
    folders without a wanted file are not opened. The keys are broadcast if Spark's estimate of them is below
    BROADCAST_BYTES; beyond, Spark picks the join and runs the partition filter as a query of its own.
    """
    keep = keep or []
    if not path_exists(spark, table_dir):
        return spark.createDataFrame([], signal.schema).join(files.select(*keep), F.lit(False)) if keep else spark.createDataFrame([], signal.schema)
    rows = spark.read.schema(f"{_ddl(signal.schema)}, batch STRING, tick BIGINT").parquet(table_dir)
    rows = rows.select("*", F.col("_metadata.file_name").alias("file_name"))
    keys = files.selectExpr(*_KEYS, *keep)
    if estimated_bytes(keys) <= BROADCAST_BYTES:
        keys = F.broadcast(keys)
    names = ["batch", "tick", "file_name"]
    return rows.join(keys, names, "inner" if keep else "left_semi").drop(*names)
