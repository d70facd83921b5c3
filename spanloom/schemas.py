"""Fixed table schemas, payload schemas and catalog type names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Column name and catalog type of the two stored tables, in column order.
LOG_COLUMNS = [
    ("timestamp", "timestamptz"),
    ("trace_id", "varchar"),
    ("span_id", "varchar"),
    ("severity_number", "int32"),
    ("severity_text", "varchar"),
    ("body", "varchar"),
    ("scope_name", "varchar"),
    ("scope_version", "varchar"),
    ("resource_attributes", "json"),
    ("log_attributes", "json"),
    ("flags", "uint32"),
    ("observed_timestamp", "timestamptz"),
]
SPAN_COLUMNS = [
    ("trace_id", "varchar"),
    ("span_id", "varchar"),
    ("parent_span_id", "varchar"),
    ("name", "varchar"),
    ("kind", "int32"),
    ("start_time", "timestamptz"),
    ("end_time", "timestamptz"),
    ("duration_ns", "int64"),
    ("status_code", "int32"),
    ("status_message", "varchar"),
    ("scope_name", "varchar"),
    ("scope_version", "varchar"),
    ("resource_attributes", "json"),
    ("span_attributes", "json"),
    ("events", "json"),
    ("links", "json"),
    ("dropped_attributes_count", "uint32"),
    ("dropped_events_count", "uint32"),
    ("dropped_links_count", "uint32"),
    ("trace_state", "varchar"),
    ("flags", "uint32"),
]

# uint32 has no Spark type of its own and is kept as BIGINT; JSON is text at rest.
SPARK_TYPES = {
    "timestamptz": T.TimestampType(),
    "varchar": T.StringType(),
    "json": T.StringType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "uint32": T.LongType(),
}


def _struct(columns: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, SPARK_TYPES[kind]) for name, kind in columns])


LOG_SCHEMA = _struct(LOG_COLUMNS)
SPAN_SCHEMA = _struct(SPAN_COLUMNS)


@dataclass(frozen=True)
class Signal:
    """What differs between the two stored tables."""

    name: str
    columns: list
    schema: T.StructType
    time_column: str

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]


LOGS = Signal("logs", LOG_COLUMNS, LOG_SCHEMA, "timestamp")
TRACES = Signal("traces", SPAN_COLUMNS, SPAN_SCHEMA, "start_time")
SIGNALS = {"logs": LOGS, "traces": TRACES}

# Nested payloads. An attribute value or body is any scalar, list or map, hence VARIANT.
ATTRIBUTES = "ARRAY<STRUCT<key: STRING, value: VARIANT>>"
_SCOPE = "STRUCT<name: STRING, version: STRING>"
_RESOURCE = f"STRUCT<attributes: {ATTRIBUTES}>"

LOG_RECORD = f"""STRUCT<
  time_unix_nano: BIGINT, observed_time_unix_nano: BIGINT, severity_number: INT, severity_text: STRING,
  body: VARIANT, attributes: {ATTRIBUTES}, flags: BIGINT, trace_id: BINARY, span_id: BINARY>"""
SPAN_EVENT = f"""STRUCT<
  time_unix_nano: BIGINT, name: STRING, attributes: {ATTRIBUTES}, dropped_attributes_count: BIGINT>"""
SPAN_LINK = f"""STRUCT<
  trace_id: BINARY, span_id: BINARY, trace_state: STRING, attributes: {ATTRIBUTES},
  dropped_attributes_count: BIGINT, flags: BIGINT>"""
SPAN_RECORD = f"""STRUCT<
  trace_id: BINARY, span_id: BINARY, parent_span_id: BINARY, trace_state: STRING, flags: BIGINT, name: STRING,
  kind: INT, start_time_unix_nano: BIGINT, end_time_unix_nano: BIGINT, attributes: {ATTRIBUTES},
  dropped_attributes_count: BIGINT, events: ARRAY<{SPAN_EVENT}>, dropped_events_count: BIGINT,
  links: ARRAY<{SPAN_LINK}>, dropped_links_count: BIGINT, status: STRUCT<code: INT, message: STRING>>"""

LOGS_PAYLOAD = f"""resource_logs ARRAY<STRUCT<resource: {_RESOURCE},
  scope_logs: ARRAY<STRUCT<scope: {_SCOPE}, log_records: ARRAY<{LOG_RECORD}>>>>>"""
TRACES_PAYLOAD = f"""resource_spans ARRAY<STRUCT<resource: {_RESOURCE},
  scope_spans: ARRAY<STRUCT<scope: {_SCOPE}, spans: ARRAY<{SPAN_RECORD}>>>>>"""

COLUMN_STATS = """ARRAY<STRUCT<column_name: STRING, column_size_bytes: BIGINT, value_count: BIGINT,
  null_count: BIGINT, min_value: STRING, max_value: STRING>>"""
TYPED_BOUNDS = "ARRAY<STRUCT<column_name: STRING, min_value: BIGINT, max_value: BIGINT>>"

# One row per registered file, as written by a commit.
COMMIT_SCHEMA = f"""table_name STRING, tick BIGINT, seq BIGINT, path STRING, record_count BIGINT,
  file_size_bytes BIGINT, commit_time TIMESTAMP, column_stats {COLUMN_STATS}, typed_bounds {TYPED_BOUNDS}, services ARRAY<STRING>,
  snapshot_id BIGINT, end_snapshot BIGINT, data_file_id BIGINT, file_order BIGINT, next_row_id BIGINT, schema_version BIGINT,
  next_catalog_id BIGINT, next_file_id BIGINT, first_column_id BIGINT, commit_id STRING"""
