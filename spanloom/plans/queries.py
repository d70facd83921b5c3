"""The documented queries over the log and span tables. Each takes the table as a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions.scalars import service_name
from spanloom.options import LakeOptions
from spanloom.plans.commit import table_files
from spanloom.plans.manifest import bound, may_be_among_largest, may_hold, may_hold_service, newest_time, scan_files
from spanloom.schemas import LOGS, TRACES, Signal

# Producers spell the severity text as they like.
ERROR_TEXTS = ["ERROR", "FATAL", "Error", "Fatal", "error", "fatal"]


def newer_than(df: DataFrame, time: str, lookback: str, as_of: Column | None = None) -> Column:
    """Times within `lookback` of `as_of`, by default of the newest row, so that results can be repeated.

    Pass current_timestamp() for a live table, or manifest.newest_time() to take the newest time from the catalog. The
    bound is a scalar subquery and reaches the Parquet scan.
    """
    newest = df.agg(F.max(time)).scalar() if as_of is None else as_of
    return F.col(time) > newest - F.expr(f"INTERVAL {lookback}")


def recent_error_logs(logs: DataFrame, lookback: str = "1 HOUR", limit: int = 100, as_of: Column | None = None):
    return (
        logs.filter(F.col("severity_text").isin(*ERROR_TEXTS) & newer_than(logs, "timestamp", lookback, as_of))
        .select("timestamp", "severity_text", "body", "trace_id")
        .orderBy(F.desc("timestamp"), "trace_id", "body")
        .limit(limit)
    )


def logs_for_trace(logs: DataFrame, trace_id: str) -> DataFrame:
    return (
        logs.filter(F.col("trace_id") == trace_id)
        .select("timestamp", "severity_text", "body")
        .orderBy("timestamp", "body")
    )


def slow_spans(
    spans: DataFrame,
    lookback: str = "1 HOUR",
    limit: int = 100,
    slower_than_ns: int = 1_000_000_000,
    as_of: Column | None = None,
) -> DataFrame:
    return (
        spans.filter((F.col("duration_ns") > slower_than_ns) & newer_than(spans, "start_time", lookback, as_of))
        .orderBy(F.desc("duration_ns"), "start_time", "trace_id", "span_id")
        .limit(limit)
        .select("trace_id", "name", (F.col("duration_ns") / F.lit(1e9)).alias("duration_sec"), "start_time")
    )


def spans_by_service(spans: DataFrame, service: str) -> DataFrame:
    return (
        spans.filter(service_name() == service)
        .orderBy(F.desc("start_time"), "trace_id", "span_id")
        .select("trace_id", "span_id", "name", "duration_ns")
    )


def nonempty_trace_spans(spans: DataFrame) -> DataFrame:
    return spans.filter(F.col("trace_id").isNotNull() & (F.col("trace_id") != "")).select(
        F.col("trace_id").cast("string").alias("trace_id"),
        F.col("span_id").cast("string").alias("span_id"),
        "name",
        "kind",
        "start_time",
        "end_time",
        "duration_ns",
        "status_code",
    )


def recent_rows(table: DataFrame, time: str, columns: list[str], lookback: str, limit: int) -> DataFrame:
    """The newest rows of a direct scan."""
    return table.filter(newer_than(table, time, lookback)).select(*columns).orderBy(F.desc(time), *columns).limit(limit)


def logs_with_span(logs: DataFrame, spans: DataFrame) -> DataFrame:
    """Logs next to the span they were written in.

    A plain equi-join: Spark broadcasts by size, else sort-merges, and AQE splits a span that owns very many logs.
    """
    found = spans.select("trace_id", "span_id", F.col("name").alias("span_name"), "duration_ns", "status_code")
    return (
        logs.filter(F.col("trace_id").isNotNull() & F.col("span_id").isNotNull())
        .join(found, ["trace_id", "span_id"])
        .select("trace_id", "span_id", "timestamp", "severity_text", "body", "span_name", "duration_ns", "status_code")
    )


def span_parent_join(spans: DataFrame) -> DataFrame:
    """Child spans with their parent, and what share of the parent's time they take."""
    parents = spans.select(
        "trace_id",
        F.col("span_id").alias("parent_span_id"),
        F.col("name").alias("parent_name"),
        F.col("duration_ns").alias("parent_duration_ns"),
    )
    return spans.join(parents, ["trace_id", "parent_span_id"]).select(
        "trace_id", "span_id", "parent_span_id", "name", "parent_name", "duration_ns", "parent_duration_ns"
    )


def orphan_spans(spans: DataFrame) -> DataFrame:
    """Spans whose parent is not in the same trace of the table."""
    parents = spans.select("trace_id", F.col("span_id").alias("parent_span_id"))
    return spans.filter(F.col("parent_span_id").isNotNull()).join(parents, ["trace_id", "parent_span_id"], "left_anti")


def time_range(table: DataFrame, time: str) -> DataFrame:
    return table.agg(
        F.count(F.lit(1)).alias("record_count"), F.min(time).alias("min_time"), F.max(time).alias("max_time")
    )


# --- the same over a lake, whose catalog tells which files matter ----------------------------------------------------


def _since(files: DataFrame, time: str, lookback: str, as_of: Column | None) -> tuple[Column, Column]:
    """The end and the start of the time asked for. Without `as_of` the newest time is taken from the files' bounds."""
    end = newest_time(files, time) if as_of is None else as_of
    return end, F.unix_micros(end - F.expr(f"INTERVAL {lookback}"))


def _scan(spark: SparkSession, options: LakeOptions, signal: Signal, files: DataFrame) -> DataFrame:
    return scan_files(spark, files, signal, options.data_dir(signal.name))


def lake_recent_error_logs(
    spark: SparkSession, options: LakeOptions, lookback: str = "1 HOUR", limit: int = 100, as_of: Column | None = None
) -> DataFrame:
    """Only files whose times reach into the lookback are read."""
    files = table_files(spark, options, LOGS)
    end, start = _since(files, "timestamp", lookback, as_of)
    logs = _scan(spark, options, LOGS, files.filter(may_hold("timestamp", low=start)))
    return recent_error_logs(logs, lookback, limit, end)


def lake_slow_spans(
    spark: SparkSession,
    options: LakeOptions,
    lookback: str = "1 HOUR",
    limit: int = 100,
    slower_than_ns: int = 1_000_000_000,
    as_of: Column | None = None,
) -> DataFrame:
    """Only files in the lookback that may hold one of the `limit` longest spans are read."""
    files = table_files(spark, options, TRACES)
    end, start = _since(files, "start_time", lookback, as_of)
    inside = may_hold("start_time", low=start) & may_hold("duration_ns", low=slower_than_ns + 1)
    longest = may_be_among_largest(files, "duration_ns", limit, surely=bound("start_time", "min_value") > start)
    return slow_spans(_scan(spark, options, TRACES, files.filter(inside & longest)), lookback, limit, slower_than_ns, end)


def lake_spans_by_service(spark: SparkSession, options: LakeOptions, service: str) -> DataFrame:
    """Only files with rows of the service are read."""
    files = table_files(spark, options, TRACES).filter(may_hold_service(service))
    return spans_by_service(_scan(spark, options, TRACES, files), service)
