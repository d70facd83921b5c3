"""Per-file column statistics, all columns in one aggregation.

Two kinds of bounds are kept. Text bounds compare the printed values, also for numbers ("13" < "9"), and are what the
catalog tables show. Typed bounds compare numbers and times and are what file skipping uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions.scalars import TIMESTAMP_TEXT, TIMESTAMP_TEXT_BYTES, service_name
from spanloom.schemas import Signal

# The number of rows. A list that stays empty is counted with them, because an aggregation that keeps an object is done in a
# hash table: bounds are texts, for which Spark would otherwise sort the rows, wide as they are, before it shuffles.
_ROWS = "(count(1) + size(collect_list(CAST(NULL AS INT))))"

_NUMBERS = ("int32", "int64", "uint32")


def _size(name: str, kind: str) -> str:
    if kind == "timestamptz":
        return f"count({name}) * {TIMESTAMP_TEXT_BYTES}L"
    return f"coalesce(sum(CAST(octet_length(CAST({name} AS STRING)) AS BIGINT)), 0L)"


def _column_stats(name: str, kind: str) -> str:
    """Size, counts and text bounds. Empty text counts as null; JSON has no bounds and "{}" is null too.

    Every row goes through all of these, so values that are there are counted, numbers and times are not asked for empty
    text, and the empty text, which is the least of all, is kept from the minimum only.
    """
    low, high = f"min(CAST({name} AS STRING))", f"max(CAST({name} AS STRING))"
    there = f"count({name})"
    if kind == "timestamptz":
        # The printed form has a fixed width and sorts like the time itself, so print only the two results.
        low, high = (f"date_format({f}({name}), '{TIMESTAMP_TEXT}')" for f in ("min", "max"))
    elif kind == "json":
        there, low, high = f"count(CASE WHEN {name} NOT IN ('', '{{}}') THEN 1 END)", "''", "''"
    elif kind not in _NUMBERS:
        there = f"count(CASE WHEN {name} <> '' THEN 1 END)"
        low, high = f"min(CASE WHEN {name} <> '' THEN {name} END)", f"max({name})"
    return f"""named_struct('column_name', '{name}', 'column_size_bytes', {_size(name, kind)},
      'value_count', {_ROWS}, 'null_count', {_ROWS} - {there}, 'min_value', coalesce({low}, ''),
      'max_value', coalesce({high}, ''))"""


def _typed_bounds(name: str, kind: str) -> str:
    """Bounds as BIGINT; times are epoch microseconds."""
    low, high = f"min({name})", f"max({name})"
    if kind == "timestamptz":
        low, high = f"unix_micros({low})", f"unix_micros({high})"
    return (
        f"named_struct('column_name', '{name}', 'min_value', CAST({low} AS BIGINT), 'max_value', CAST({high} AS BIGINT))"
    )


def file_stats(rows: DataFrame, signal: Signal, keys: list[str]) -> DataFrame:
    """One row per file: record_count, last_time, text_bytes, column_stats, typed_bounds and services.

    `services` are the service names in a file, taken from its different resources: reading the name in the JSON of every row
    costs as much as all other statistics of a few columns.
    """
    names = F.transform(F.collect_set("resource_attributes"), lambda resource: service_name(resource))
    services = F.array_sort(F.array_distinct(F.array_compact(names)))
    typed = [(n, k) for n, k in signal.columns if k == "timestamptz" or k in _NUMBERS]
    return rows.groupBy(*keys).agg(
        F.expr(_ROWS).alias("record_count"),
        F.max(signal.time_column).alias("last_time"),
        F.expr(" + ".join(_size(n, k) for n, k in signal.columns)).alias("text_bytes"),
        F.expr(f"array({', '.join(_column_stats(n, k) for n, k in signal.columns)})").alias("column_stats"),
        F.expr(f"array({', '.join(_typed_bounds(n, k) for n, k in typed)})").alias("typed_bounds"),
        services.alias("services"),
    )


def long_form(files: DataFrame, keep: list[str], column: str = "column_stats") -> DataFrame:
    """One row per file and column."""
    return files.select(*keep, F.inline(column))


def merge_column_stats(stats: DataFrame, keys: list[str]) -> DataFrame:
    """Column statistics of several files as one. Empty bounds are ignored."""
    return stats.groupBy(*keys).agg(
        F.expr("bool_or(null_count > 0)").alias("contains_null"),
        F.expr("coalesce(min(nullif(min_value, '')), '')").alias("min_value"),
        F.expr("coalesce(max(nullif(max_value, '')), '')").alias("max_value"),
    )
