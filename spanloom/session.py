"""Session settings and the shared scratch folder. Never creates a session: it sets up the one it is given."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Microsecond timestamps instead of the INT96 default, so that other readers get statistics.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # A repeated attribute key keeps its last value; the default raises.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Lets read_compat() open files whose timestamps are in nanoseconds; no effect on other files.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # Files whose statistics a task keeps in a hash table before it sorts; some 20 KB each.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "2048",
    # What opening a file counts for when tasks get their files. Stored files are small: at Spark's 4 MB a task has some 30 of
    # them, and each task makes the code of its statistics anew.
    "spark.sql.files.openCostInBytes": "1048576",
    # Code beyond this, as that of many statistics, is not compiled by the JVM; Spark then takes smaller steps.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A table is pruned by its manifest also where the manifest is too large to broadcast.
    "spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by the cluster in spark.checkpoint.dir.

    Only a local session may fall back to a temporary folder: on a cluster that would be one machine's disk.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spanloom-"))
    return sc.getCheckpointDir().rstrip("/")


def new_scratch(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove a table that new_scratch() named, once nothing reads it any more."""
    if not path.startswith(shared_dir(spark) + "/"):
        raise ValueError(f"not in the shared folder: {path}")
    remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop_path(spark, path)
    fs.delete(target, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, target = _hadoop_path(spark, path)
    fs.create(target, True).close()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again, so that Spark knows its size when it picks joins with it."""
    path = new_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small table that several later steps read (reliable, survives lost executors)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop_path(spark, path)
    return fs.exists(target)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, as one listing."""
    fs, target = _hadoop_path(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(target) or [])


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a plan; no job runs for it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# Input bytes per shuffle partition.
BYTES_PER_PARTITION = 256 << 20


def size_shuffles(spark: SparkSession, path: str) -> int:
    """Let shuffles start with as many partitions as the input needs. AQE merges small ones but never splits a
    whole shuffle that was started too coarse. A larger number that is already set stays."""
    fs, target = _hadoop_path(spark, path)
    needed = -(-fs.getContentSummary(target).getLength() // BYTES_PER_PARTITION)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    current = int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(current, needed)
    spark.conf.set(key, str(partitions))
    return partitions
