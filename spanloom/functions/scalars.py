"""Ids, times and names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSSx"  # fixed value: microseconds and an hour-only offset
TIMESTAMP_TEXT_BYTES = 29


def hex_or_null_text(raw_id: str, width: int) -> str:
    """SQL text: lower-case hex of a binary id of `width` bytes; NULL when it is missing, empty or all zero."""
    return f"CASE WHEN {raw_id} <> X'{'00' * width}' THEN nullif(lower(hex({raw_id})), '') END"


def trace_id_text(raw_id: str) -> Column:
    return F.expr(hex_or_null_text(raw_id, 16))


def span_id_text(raw_id: str) -> Column:
    return F.expr(hex_or_null_text(raw_id, 8))


def nanos_to_timestamp(nanos: Column) -> Column:
    """Epoch nanoseconds to a microsecond timestamp. An unset time is 0, that is 1970-01-01."""
    # Integer division: going through DOUBLE would lose the last digits.
    return F.timestamp_micros(F.call_function("div", F.coalesce(nanos, F.lit(0).cast("bigint")), F.lit(1000)))


def timestamp_text(ts: Column) -> Column:
    return F.date_format(ts, TIMESTAMP_TEXT)


def null_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def zero_if_null(count: Column) -> Column:
    return F.coalesce(count, F.lit(0).cast("bigint"))


def service_name(resource_attributes: str | Column = "resource_attributes") -> Column:
    """Attribute keys are stored flat, so the key is quoted although it has a dot."""
    return F.get_json_object(resource_attributes, "$['service.name']")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def translate_path(path: Column, output_path: str, data_path: str) -> Column:
    """Swap the writer's prefix for the reader's. Other paths stay as they are.

    Spark names local files with the scheme `file:`, options mostly without; both mean the same folder.
    """
    old, new = re.sub("^file:/+", "/", output_path.rstrip("/")), data_path.rstrip("/")
    plain = F.regexp_replace(path, "^file:/+", "/")
    return F.when(
        F.startswith(plain, F.lit(old + "/")), F.concat(F.lit(new), F.substring(plain, len(old) + 1, 1 << 30))
    ).otherwise(path)


def file_path(metadata_path: Column) -> Column:
    """The path behind _metadata.file_path, which is URL-encoded."""
    return F.url_decode(F.replace(metadata_path, F.lit("+"), F.lit("%2B")))
