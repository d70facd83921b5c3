"""Reading stored tables without the catalog, and files of other writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.functions.scalars import zero_if_null
from spanloom.schemas import Signal


def scan_glob(spark: SparkSession, folder: str, signal: Signal, table: str) -> DataFrame:
    """All files <table>_*.parquet at any depth below a folder."""
    return (
        spark.read.schema(signal.schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"{table}_*.parquet")
        .parquet(folder)
    )


def describe(df: DataFrame) -> DataFrame:
    """(column_name, column_type, column_order, value_count): the schema, with the non-null values of each column."""
    counts = df.agg(*[F.count(f.name).alias(f.name) for f in df.schema])
    listed = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
                F.lit(i).cast("bigint").alias("column_order"),
                F.col(f.name).alias("value_count"),
            )
            for i, f in enumerate(df.schema, start=1)
        ]
    )
    return counts.select(F.inline(listed))


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """All files below a folder with the columns that their footers name."""
    return spark.read.option("recursiveFileLookup", "true").parquet(folder)


def rows_leaving_scan(df: DataFrame) -> tuple[int, int]:
    """Run a filtered scan and tell how many rows its scans gave and how many were left: what the reader skipped by
    statistics and bloom filters never leaves the scan. For filters that leave few rows, as those come to the driver."""
    left = len(df.collect())
    scanned = 0
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    for i in range(leaves.size()):
        scanned += leaves.apply(i).metrics().apply("numOutputRows").value()
    return scanned, left


def compat_schema(signal: Signal) -> T.StructType:
    """The schema of files whose timestamps are 64-bit nanoseconds."""
    return T.StructType(
        [T.StructField(n, T.LongType() if k == "timestamptz" else f.dataType)
         for (n, k), f in zip(signal.columns, signal.schema)]
    )


def from_compat(rows: DataFrame, signal: Signal) -> DataFrame:
    """Nanoseconds to timestamps and left-out zeros back to 0."""

    def fixed(name: str, kind: str):
        column = F.col(name)
        if kind == "timestamptz":
            column = F.timestamp_micros(F.call_function("div", column, F.lit(1000).cast("bigint")))
        elif kind == "uint32":
            column = zero_if_null(column)
        return column.alias(name)

    return rows.select(*[fixed(n, k) for n, k in signal.columns])


def read_compat(spark: SparkSession, folder: str, signal: Signal) -> DataFrame:
    """Files with nanosecond timestamps and zeros stored as NULL, as other writers of these tables make them.

    Relies on spark.sql.legacy.parquet.nanosAsLong, see session.py.
    """
    return from_compat(spark.read.schema(compat_schema(signal)).parquet(folder), signal)
