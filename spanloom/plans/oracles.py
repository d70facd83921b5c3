"""SQL for the registered queries, written without the library: the same results from the `events` view."""

from __future__ import annotations

from spanloom.schemas import LOGS, TRACES, Signal

START_MICROS = 1_704_067_200_000_000
TICK_MICROS = 86_400_000_000
BATCH_SIZE = 100
WRITE_TICK_MICROS = 5 * 86_400_000_000
WRITE_BATCH_SIZE = 1000
TRACE_KEY = "cfcd208495d565ef66e7dff9f98764da"

_TEXT = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f') || '+00'"
_RESOURCE = """'{"deployment.environment":"test","service.name":"svc-' || CAST(user_id % 5 AS VARCHAR) || '"}'"""
_ATTRS = "CASE WHEN event_id % 7 = 0 THEN '{}' ELSE replace(props, ': ', ':') END"
_MILLIS = "CAST(round(value * 100) AS BIGINT)"

LOG_ROWS = f"""
SELECT ts AS timestamp,
  CASE WHEN event_id % 5 <> 4 THEN md5(CAST(event_id - event_id % 5 AS VARCHAR)) END AS trace_id,
  CASE WHEN event_id % 5 <> 4 THEN substr(md5(CAST(event_id AS VARCHAR)), 1, 16) END AS span_id,
  CAST(CASE event_type WHEN 'error' THEN 17 WHEN 'purchase' THEN 13 WHEN 'click' THEN 5 ELSE 9 END AS INTEGER)
    AS severity_number,
  CASE event_type WHEN 'error' THEN 'Error' WHEN 'purchase' THEN 'Warn' WHEN 'click' THEN 'Debug' ELSE 'Info' END
    AS severity_text,
  'event ' || event_type || ' by user ' || CAST(user_id AS VARCHAR) AS body,
  'events' AS scope_name, '1.0.0' AS scope_version,
  {_RESOURCE} AS resource_attributes,
  {_ATTRS} AS log_attributes,
  CAST(CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS flags,
  ts AS observed_timestamp, event_id AS arrival
FROM events"""

SPAN_ROWS = f"""
SELECT md5(CAST(event_id - event_id % 5 AS VARCHAR)) AS trace_id,
  substr(md5(CAST(event_id AS VARCHAR)), 1, 16) AS span_id,
  CASE WHEN event_id % 5 <> 0 THEN substr(md5(CAST(event_id - event_id % 5 AS VARCHAR)), 1, 16) END
    AS parent_span_id,
  event_type AS name, CAST(event_id % 5 + 1 AS INTEGER) AS kind, ts AS start_time,
  ts + {_MILLIS} * INTERVAL '1' MILLISECOND AS end_time,
  {_MILLIS} * 1000000 AS duration_ns,
  CAST(CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS INTEGER) AS status_code,
  CASE WHEN event_type = 'error' THEN 'request failed' END AS status_message,
  'events' AS scope_name, '1.0.0' AS scope_version,
  {_RESOURCE} AS resource_attributes,
  {_ATTRS} AS span_attributes,
  CASE WHEN event_id % 5 = 0 THEN '[{{"timestamp":"' || {_TEXT.format(c='ts')}
    || '","name":"cache-miss","attributes":{{"cache.tier":"edge"}}}}]' ELSE '[]' END AS events,
  CASE WHEN event_id > 0 AND event_id % 4 = 0 THEN '[{{"trace_id":"' || md5(CAST(event_id - 1 AS VARCHAR))
    || '","span_id":"' || substr(md5(CAST(event_id - 1 AS VARCHAR)), 1, 16)
    || '","attributes":{{"reason":"retry"}}}}]' ELSE '[]' END AS links,
  CAST(0 AS BIGINT) AS dropped_attributes_count, CAST(0 AS BIGINT) AS dropped_events_count,
  CAST(0 AS BIGINT) AS dropped_links_count, CAST(NULL AS VARCHAR) AS trace_state, CAST(0 AS BIGINT) AS flags,
  event_id AS arrival
FROM events"""

_LOG_LIST = ", ".join(LOGS.column_names)
_SPAN_LIST = ", ".join(TRACES.column_names)


def _rows(signal: Signal) -> str:
    return LOG_ROWS if signal is LOGS else SPAN_ROWS


def _batches(signal: Signal, batch_size: int = BATCH_SIZE, tick_micros: int = TICK_MICROS) -> str:
    return f"""
SELECT *, (row_number() OVER (PARTITION BY tick ORDER BY arrival) - 1) // {batch_size} AS seq
FROM (SELECT *, (epoch_us({signal.time_column}) - {START_MICROS}) // {tick_micros} AS tick
      FROM ({_rows(signal)}))"""


def _written(signal: Signal) -> str:
    return _batches(signal, WRITE_BATCH_SIZE, WRITE_TICK_MICROS)


def _text(name: str, kind: str) -> str:
    return _TEXT.format(c=name) if kind == "timestamptz" else f"coalesce(CAST({name} AS VARCHAR), '')"


def _size(name: str, kind: str) -> str:
    return f"CAST(sum(strlen({_text(name, kind)})) AS BIGINT)"


def _in_files(signal: Signal) -> str:
    """Rows of written files; `seq` is the first time in the file, in microseconds."""
    return f"""
SELECT * EXCLUDE (seq), epoch_us(min({signal.time_column}) OVER (PARTITION BY tick, seq)) AS seq FROM ({_written(signal)})"""


def _column_stats(signal: Signal, rows: str | None = None) -> str:
    """One row per (tick, seq, column)."""
    parts = []
    for name, kind in signal.columns:
        text = _text(name, kind)
        if kind == "json":
            nulls, low, high = f"{text} IN ('', '{{}}')", "''", "''"
        else:
            nulls = f"{text} = ''"
            low, high = (f"coalesce({f}(nullif({text}, '')), '')" for f in ("min", "max"))
        parts.append(
            f"""SELECT tick, seq, '{name}' AS column_name, {_size(name, kind)} AS column_size_bytes,
  count(*) AS value_count, count(*) FILTER (WHERE {nulls}) AS null_count, {low} AS min_value, {high} AS max_value
FROM batches GROUP BY tick, seq"""
        )
    return f"WITH batches AS ({rows or _batches(signal)})\n" + "\nUNION ALL\n".join(parts)


def _files(signal: Signal, table: str) -> str:
    return f"""
SELECT '{table}' AS table_name, tick, seq, count(*) AS record_count,
  make_timestamp({START_MICROS} + (tick + 1) * {WRITE_TICK_MICROS}) AS commit_time,
  'batch=all/tick=' || CAST(tick AS VARCHAR) || '/' AS folder
FROM ({_in_files(signal)}) GROUP BY tick, seq"""


def _manifest() -> str:
    return f"""{_files(LOGS, 'otel_logs')}
UNION ALL
{_files(TRACES, 'otel_traces')}"""


_COMMITS = f"""WITH manifest AS ({_manifest()}),
commits AS (
  SELECT *, row_number() OVER (ORDER BY tick, seq, table_name) AS snapshot_id,
    row_number() OVER (PARTITION BY table_name ORDER BY tick, seq) - 1 AS file_order,
    CAST(sum(record_count) OVER (PARTITION BY table_name ORDER BY tick, seq) AS BIGINT) AS next_row_id
  FROM manifest),
created AS (
  SELECT table_name, snapshot_id AS begin_snapshot, row_number() OVER (ORDER BY snapshot_id) AS table_id,
    CASE WHEN table_name = 'otel_logs' THEN {len(LOGS.columns)} ELSE {len(TRACES.columns)} END AS n_columns
  FROM commits WHERE file_order = 0),
versions AS (
  SELECT c.*, (SELECT count(*) FROM created t WHERE t.begin_snapshot <= c.snapshot_id) AS schema_version
  FROM commits c),
catalog_columns AS (
  SELECT t.table_id, t.begin_snapshot, c.column_order, c.column_name, c.column_type,
    CAST(coalesce((SELECT sum(u.n_columns) FROM created u WHERE u.table_id < t.table_id), 0) AS BIGINT)
      + c.column_order AS column_id
  FROM created t JOIN (VALUES {', '.join(
    f"('{table}', CAST({i} AS BIGINT), '{name}', '{kind}')"
    for table, signal in (('otel_logs', LOGS), ('otel_traces', TRACES))
    for i, (name, kind) in enumerate(signal.columns, start=1)
  )}) c(table_name, column_order, column_name, column_type) ON c.table_name = t.table_name)
"""

_SNAPSHOTS = """
  SELECT CAST(0 AS BIGINT) AS snapshot_id, (SELECT min(ts) FROM events) AS snapshot_time,
    CAST(0 AS BIGINT) AS schema_version, CAST(1 AS BIGINT) AS next_catalog_id, CAST(0 AS BIGINT) AS next_file_id
  UNION ALL
  SELECT snapshot_id, commit_time, schema_version, schema_version + 1, snapshot_id FROM versions"""

_DATA_FILES = """
  SELECT c.snapshot_id - 1 AS data_file_id, t.table_id, c.snapshot_id AS begin_snapshot,
    CAST(NULL AS BIGINT) AS end_snapshot, c.file_order, c.folder AS path,
    true AS path_is_relative, 'PARQUET' AS file_format, c.record_count, true AS has_size,
    CAST(NULL AS BIGINT) AS footer_size, CAST(NULL AS BIGINT) AS row_id_start, CAST(NULL AS BIGINT) AS partition_id,
    CAST(NULL AS VARCHAR) AS encryption_key, CAST(NULL AS VARCHAR) AS partial_file_info, t.table_id AS mapping_id
  FROM commits c JOIN created t ON t.table_name = c.table_name"""


def _all_file_column_stats() -> str:
    return f"""
  SELECT c.snapshot_id - 1 AS data_file_id, cc.table_id, cc.column_id, s.column_size_bytes, s.value_count,
    s.null_count, s.min_value, s.max_value, false AS contains_nan, CAST(NULL AS VARCHAR) AS extra_stats
  FROM (SELECT 'otel_logs' AS table_name, * FROM ({_column_stats(LOGS, _in_files(LOGS))})
        UNION ALL SELECT 'otel_traces', * FROM ({_column_stats(TRACES, _in_files(TRACES))})) s
  JOIN commits c ON c.table_name = s.table_name AND c.tick = s.tick AND c.seq = s.seq
  JOIN created t ON t.table_name = s.table_name
  JOIN catalog_columns cc ON cc.table_id = t.table_id AND cc.column_name = s.column_name"""


def _typed_bounds(signal: Signal, table: str) -> str:
    parts = []
    for name, kind in signal.columns:
        if kind in ("varchar", "json"):
            continue
        value = f"epoch_us({name})" if kind == "timestamptz" else f"CAST({name} AS BIGINT)"
        parts.append(
            f"""SELECT '{table}' AS table_name, tick, seq, '{name}' AS column_name, min({value}) AS min_value,
  max({value}) AS max_value FROM {signal.name}_batches GROUP BY tick, seq"""
        )
    return "\nUNION ALL\n".join(parts)


def _describe(signal: Signal, table: str) -> str:
    names = {"timestamptz": "timestamp", "varchar": "string", "json": "string", "int32": "int", "int64": "bigint",
             "uint32": "bigint"}
    return "\nUNION ALL\n".join(
        f"""SELECT '{table}' AS table_name, '{name}' AS column_name, '{names[kind]}' AS column_type,
  CAST({i} AS BIGINT) AS column_order, count({name}) AS value_count FROM {signal.name}_rows"""
        for i, (name, kind) in enumerate(signal.columns, start=1)
    )


# Numbers print as in JSON: no trailing zeros and no exponent.
_VALUE_TEXT = "CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)"
_PLAIN_VALUE = f"rtrim(rtrim({_VALUE_TEXT}, '0'), '.')"

_MIXED = f"""'{{"amount":' || {_PLAIN_VALUE} || ',"count":' || CAST(event_id % 1000 AS VARCHAR)
  || ',"kind":"' || event_type || '","none":null,"ok":' || CASE WHEN event_type <> 'error' THEN 'true' ELSE 'false' END
  || ',"raw":"' || base64(encode(event_type)) || '","user":"\\u003cu\\u0026' || CAST(user_id AS VARCHAR)
  || '\\u003e"}}'"""

_EVENT_ITEM = f"""'{{"timestamp":"' || {_TEXT.format(c='ts')} || '","name":"' || event_type || '"'
  || CASE WHEN event_id % 3 = 0 THEN ',"attributes":{{"a":"\\u003cx\\u003e","user":' || CAST(user_id AS VARCHAR) || '}}'
     ELSE '' END
  || CASE WHEN event_id % 2 = 1 THEN ',"dropped_attributes":1' ELSE '' END || '}}'"""

_LINK_ITEM = """'{"trace_id":"' || md5(CAST(event_id AS VARCHAR)) || '","span_id":"'
  || CASE WHEN event_id % 5 = 0 THEN '' ELSE substr(md5(CAST(event_id AS VARCHAR)), 1, 16) END || '"'
  || CASE WHEN event_id % 2 = 0 THEN ',"trace_state":"vendor=' || event_type || '"' ELSE '' END
  || CASE WHEN event_id % 3 = 0 THEN ',"attributes":{"user":' || CAST(user_id AS VARCHAR) || '}' ELSE '' END
  || CASE WHEN event_id % 2 = 1 THEN ',"dropped_attributes":1' ELSE '' END
  || CASE WHEN event_id % 3 > 0 THEN ',"flags":' || CAST(event_id % 3 AS VARCHAR) ELSE '' END || '}'"""


def _repeated(item: str, times: str) -> str:
    return f"'[' || rtrim(repeat(({item}) || ',', {times}), ',') || ']'"


SQL: dict[str, str] = {
    # --- sources and transforms
    "flatten_logs": f"SELECT {_LOG_LIST} FROM ({LOG_ROWS})",
    "flatten_traces": f"SELECT {_SPAN_LIST} FROM ({SPAN_ROWS})",
    "attributes_json": f"""SELECT event_id, CASE WHEN event_id % 11 = 0 THEN '{{}}' ELSE {_MIXED} END AS attributes
FROM events""",
    "span_events_json": f"""SELECT event_id, {_repeated(_EVENT_ITEM, 'CAST(event_id % 4 AS INTEGER)')} AS events
FROM events""",
    "span_links_json": f"""SELECT event_id, {_repeated(_LINK_ITEM, 'CAST(event_id % 3 AS INTEGER)')} AS links
FROM events""",
    "id_hex": """SELECT event_id,
  CASE WHEN event_id % 6 <> 0 THEN md5(CAST(event_id AS VARCHAR)) END AS trace_id,
  CASE WHEN event_id % 4 <> 0 THEN substr(md5(CAST(event_id AS VARCHAR)), 1, 16) END AS span_id FROM events""",
    "span_duration": """SELECT event_id, ts AS start_time, ts + ms * INTERVAL '1' MILLISECOND AS end_time,
  ms * 1000000 AS duration_ns
FROM (SELECT event_id, ts, CASE WHEN event_id % 9 = 0 THEN -1 ELSE 1 END * CAST(round(value * 100) AS BIGINT) AS ms
      FROM events)""",
    "body_to_string": f"""SELECT event_id, CASE event_id % 7
  WHEN 0 THEN event_type WHEN 1 THEN CAST(user_id AS VARCHAR) WHEN 2 THEN {_PLAIN_VALUE}
  WHEN 3 THEN CASE WHEN value > 10 THEN 'true' ELSE 'false' END WHEN 4 THEN replace(props, ': ', ':')
  WHEN 5 THEN '[' || CAST(event_id AS VARCHAR) || ',' || CAST(user_id AS VARCHAR) || ']' ELSE '' END AS body
FROM events""",
    "reject_unencodable": """SELECT event_type, CASE WHEN event_id % 13 < 2 THEN 'rejected' ELSE 'kept' END AS outcome,
  count(*) AS n_rows FROM events GROUP BY 1, 2""",
    "timestamp_text": f"SELECT event_id, {_TEXT.format(c='ts')} AS ts_text FROM events",
    "resource_attribute_default": """SELECT event_id, '{"deployment.environment":"'
  || CASE WHEN event_id % 3 = 0 THEN 'test' ELSE 'production' END || '","service.name":"svc-'
  || CAST(user_id % 5 AS VARCHAR) || '"}' AS resource_attributes FROM events""",
    # --- log and trace queries
    "recent_error_logs": f"""SELECT timestamp, severity_text, body, trace_id FROM ({LOG_ROWS})
WHERE severity_text IN ('ERROR', 'FATAL', 'Error', 'Fatal', 'error', 'fatal')
  AND timestamp > (SELECT max(ts) FROM events) - INTERVAL '1' DAY
ORDER BY timestamp DESC, trace_id, body LIMIT 100""",
    "logs_for_trace": f"""SELECT timestamp, severity_text, body FROM ({LOG_ROWS})
WHERE trace_id = '{TRACE_KEY}' ORDER BY timestamp, body""",
    "slow_spans": f"""SELECT trace_id, name, duration_ns / 1e9::DOUBLE AS duration_sec, start_time FROM ({SPAN_ROWS})
WHERE duration_ns > 1000000000 AND start_time > (SELECT max(ts) FROM events) - INTERVAL '30' DAY
ORDER BY duration_ns DESC, start_time, trace_id, span_id LIMIT 100""",
    "spans_by_service": f"""SELECT trace_id, span_id, name, duration_ns FROM ({SPAN_ROWS})
WHERE json_extract_string(resource_attributes, '$."service.name"') = 'svc-3' ORDER BY start_time DESC""",
    "nonempty_trace_spans": f"""SELECT CAST(trace_id AS VARCHAR) AS trace_id, CAST(span_id AS VARCHAR) AS span_id, name,
  kind, start_time, end_time, duration_ns, status_code
FROM ({SPAN_ROWS}) WHERE trace_id IS NOT NULL AND trace_id != ''""",
    "logs_with_span": f"""SELECT l.trace_id, l.span_id, l.timestamp, l.severity_text, l.body, s.name AS span_name,
  s.duration_ns, s.status_code
FROM ({LOG_ROWS}) l JOIN ({SPAN_ROWS}) s ON l.trace_id = s.trace_id AND l.span_id = s.span_id""",
    "span_parent_join": f"""SELECT c.trace_id, c.span_id, c.parent_span_id, c.name, p.name AS parent_name, c.duration_ns,
  p.duration_ns AS parent_duration_ns
FROM ({SPAN_ROWS}) c JOIN ({SPAN_ROWS}) p ON p.trace_id = c.trace_id AND p.span_id = c.parent_span_id""",
    "orphan_spans": f"""WITH s AS ({SPAN_ROWS})
SELECT trace_id, span_id, parent_span_id, name FROM s WHERE parent_span_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM s p WHERE p.trace_id = s.trace_id AND p.span_id = s.parent_span_id)""",
    "recent_error_logs_in_lake": f"""SELECT timestamp, severity_text, body, trace_id FROM ({LOG_ROWS})
WHERE lower(severity_text) IN ('error', 'fatal') AND timestamp > (SELECT max(ts) FROM events) - INTERVAL '1' DAY
ORDER BY timestamp DESC, trace_id, body LIMIT 100""",
    "slow_spans_in_lake": f"""SELECT trace_id, name, duration_ns / 1e9::DOUBLE AS duration_sec, start_time FROM ({SPAN_ROWS})
WHERE duration_ns > 1000000000 AND start_time > (SELECT max(ts) FROM events) - INTERVAL '30' DAY
ORDER BY duration_ns DESC, start_time, trace_id, span_id LIMIT 100""",
    "spans_by_service_in_lake": f"""SELECT trace_id, span_id, name, duration_ns FROM ({SPAN_ROWS})
WHERE json_extract_string(resource_attributes, '$."service.name"') = 'svc-3'""",
    "rows_since_now": """SELECT count(*) FILTER (WHERE ts > now()::TIMESTAMP - INTERVAL '1' HOUR) AS last_hour,
  count(*) FILTER (WHERE ts > now()::TIMESTAMP - INTERVAL '1000' YEAR) AS last_thousand_years FROM events""",
    "count_logs": f"SELECT count(*) AS n_logs FROM ({LOG_ROWS})",
    "log_time_range": f"""SELECT count(*) AS record_count, min(timestamp) AS min_time, max(timestamp) AS max_time
FROM ({LOG_ROWS})""",
    "describe_tables": f"""WITH logs_rows AS ({LOG_ROWS}), traces_rows AS ({SPAN_ROWS})
{_describe(LOGS, 'otel_logs')}
UNION ALL
{_describe(TRACES, 'otel_traces')}""",
    # --- file building
    "assign_file_batches": f"SELECT arrival, tick, seq FROM ({_batches(LOGS)})",
    "log_file_column_stats": _column_stats(LOGS),
    "span_file_column_stats": _column_stats(TRACES),
    "typed_file_bounds": f"""WITH logs_batches AS ({_in_files(LOGS)}), traces_batches AS ({_in_files(TRACES)})
{_typed_bounds(LOGS, 'otel_logs')}
UNION ALL
{_typed_bounds(TRACES, 'otel_traces')}""",
    "write_logs_roundtrip": f"SELECT {_LOG_LIST} FROM ({LOG_ROWS})",
    "write_traces_roundtrip": f"SELECT {_SPAN_LIST} FROM ({SPAN_ROWS})",
    "write_codecs": f"""SELECT codec, ending, {_SPAN_LIST}
FROM (VALUES ('SNAPPY', '.snappy.parquet'), ('GZIP', '.gz.parquet'), ('ZSTD', '.zstd.parquet'),
             ('UNCOMPRESSED', '.parquet')) c(codec, ending) CROSS JOIN ({SPAN_ROWS})""",
    "read_compat_nanos": f"SELECT {_LOG_LIST} FROM ({LOG_ROWS})",
    # --- scans of written tables
    "scan_parquet_glob": f"""SELECT timestamp, severity_text, body FROM ({LOG_ROWS})
WHERE timestamp > (SELECT max(ts) FROM events) - INTERVAL '1' DAY
ORDER BY timestamp DESC, severity_text, body LIMIT 100""",
    "scan_catalog_table": f"""SELECT dense_rank() OVER (ORDER BY tick, seq) - 1 AS file_order, timestamp, trace_id,
  severity_text, body FROM ({_written(LOGS)})""",
    "scan_as_of_snapshot": f"""SELECT timestamp, trace_id, severity_text, body
FROM (SELECT *, dense_rank() OVER (ORDER BY tick, seq) AS snapshot_id FROM ({_written(LOGS)}))
QUALIFY snapshot_id <= (max(snapshot_id) OVER ()) // 2""",
    "prune_files_minmax": f"""WITH f AS (
  SELECT tick, seq, min(start_time) AS lo, max(start_time) AS hi FROM ({_written(TRACES)}) GROUP BY tick, seq),
r AS (SELECT make_timestamp({START_MICROS + 11 * TICK_MICROS}) AS lo, make_timestamp({START_MICROS + 13 * TICK_MICROS}) AS hi)
SELECT (SELECT count(*) FROM f) AS files_total,
  (SELECT count(*) FROM f, r WHERE f.hi >= r.lo AND f.lo < r.hi) AS files_read,
  count(*) AS rows_found, CAST(sum(duration_ns) AS BIGINT) AS duration_ns
FROM ({SPAN_ROWS}) s, r WHERE s.start_time >= r.lo AND s.start_time < r.hi""",
    "bloom_point_lookup": f"""SELECT row_number() OVER (ORDER BY tick, seq) - 1 AS file_order, count(*) AS record_count,
  count(*) FILTER (WHERE trace_id = '{TRACE_KEY}') AS key_rows,
  count(*) FILTER (WHERE trace_id = '{TRACE_KEY}') = 0 AS excludes
FROM ({_written(TRACES)}) GROUP BY tick, seq""",
    "bloom_rows_skipped": """SELECT signal, filters AS bloom_filters, CAST(0 AS BIGINT) AS rows_found,
  (SELECT count(*) FROM events) AS rows_total, filters AS mostly_skipped
FROM (VALUES ('logs'), ('traces')) s(signal) CROSS JOIN (VALUES (true), (false)) f(filters)""",
    # --- manifest and catalog
    "manifest_files": f"""SELECT table_name, tick, seq, record_count, commit_time, true AS has_size, true AS in_tick,
  true AS named FROM ({_manifest()})""",
    "manifest_path_translation": f"""SELECT table_name, tick, seq, '/lake/main/' || table_name || '/' || folder AS folder
FROM ({_manifest()})""",
    "catalog_bootstrap": """SELECT * FROM (VALUES ('metadata', 'version', '0.3'), ('metadata', 'created_by', 'spanloom'),
  ('metadata', 'data_path', 'data path'), ('metadata', 'encrypted', 'false'), ('schema_versions', '0', '0'),
  ('schema', 'main', 'main/'),
  ('snapshot_changes', 'created_schema:main', 'Empty catalog with one schema')) t(catalog_table, key, value)
UNION ALL
SELECT 'snapshot', '0', strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') FROM events""",
    "catalog_snapshots": _COMMITS + _SNAPSHOTS,
    "snapshot_changes": _COMMITS
    + """SELECT CAST(0 AS BIGINT) AS snapshot_id, 'created_schema:main' AS changes_made, 'spanloom' AS author,
  'Empty catalog with one schema' AS commit_message, CAST(NULL AS VARCHAR) AS commit_extra_info
UNION ALL
SELECT c.snapshot_id, CASE WHEN c.file_order = 0 THEN 'created_table:' || c.table_name || ',' ELSE '' END
    || 'inserted_into_table:' || CAST(t.table_id AS VARCHAR), 'spanloom',
  'one file more in ' || c.table_name || ', table ' || CAST(t.table_id AS VARCHAR), NULL
FROM commits c JOIN created t ON t.table_name = c.table_name""",
    "catalog_tables": _COMMITS
    + """SELECT table_id, regexp_replace(md5('table/' || table_name), '^(.{8})(.{4})(.{4})(.{4})(.{12})$',
    '\\1-\\2-\\3-\\4-\\5') AS table_uuid, begin_snapshot, CAST(1 AS BIGINT) AS reference_begin_snapshot,
  CAST(NULL AS BIGINT) AS end_snapshot, CAST(0 AS BIGINT) AS schema_id, table_name, table_name || '/' AS path,
  true AS path_is_relative, table_id AS mapping_id,
  (SELECT min(column_id) FROM catalog_columns c WHERE c.table_id = created.table_id) AS first_column_id
FROM created""",
    "catalog_columns": _COMMITS
    + """SELECT column_id, begin_snapshot, CAST(1 AS BIGINT) AS reference_begin_snapshot,
  CAST(NULL AS BIGINT) AS end_snapshot, table_id, column_order, column_name, column_type,
  CAST(NULL AS VARCHAR) AS initial_default, CAST(NULL AS VARCHAR) AS default_value, true AS nulls_allowed,
  CAST(NULL AS BIGINT) AS parent_column
FROM catalog_columns""",
    "catalog_column_mapping": _COMMITS
    + "SELECT table_id AS mapping_id, table_id, 'map_by_name' AS type FROM created",
    "catalog_name_mapping": _COMMITS
    + """SELECT table_id AS mapping_id, column_order - 1 AS column_id, column_name AS source_name,
  column_id AS target_field_id, CAST(NULL AS BIGINT) AS parent_column, false AS is_partition FROM catalog_columns""",
    "catalog_data_files": _COMMITS + _DATA_FILES,
    "file_column_stats": _COMMITS + _all_file_column_stats(),
    "table_stats": _COMMITS
    + """SELECT t.table_id, CAST(sum(record_count) AS BIGINT) AS record_count,
  CAST(sum(record_count) AS BIGINT) AS next_row_id, true AS has_size
FROM commits c JOIN created t ON t.table_name = c.table_name GROUP BY t.table_id""",
    "table_stats_history": _COMMITS
    + """SELECT t.table_id, snapshot_id, file_order, record_count, next_row_id
FROM commits c JOIN created t ON t.table_name = c.table_name""",
    "table_column_stats": _COMMITS
    + f"""SELECT table_id, column_id, bool_or(null_count > 0) AS contains_null,
  coalesce(min(nullif(min_value, '')), '') AS min_value, coalesce(max(nullif(max_value, '')), '') AS max_value,
  false AS contains_nan, CAST(NULL AS VARCHAR) AS extra_stats
FROM ({_all_file_column_stats()}) GROUP BY table_id, column_id""",
    "next_ids": _COMMITS
    + """SELECT max(schema_version) AS schema_version, max(schema_version) + 1 AS next_catalog_id,
  max(snapshot_id) AS next_file_id, max(snapshot_id) + 1 AS next_snapshot_id FROM versions""",
    "catalog_absolute_paths": _COMMITS
    + "SELECT snapshot_id - 1 AS data_file_id, record_count AS rows_there FROM commits",
    "table_exists": _COMMITS
    + """SELECT n.table_name, EXISTS (SELECT 1 FROM created t WHERE t.table_name = n.table_name) AS table_exists
FROM (VALUES ('otel_logs'), ('otel_traces'), ('otel_metrics')) n(table_name)""",
    "recent_snapshots": _COMMITS
    + f"""SELECT s.snapshot_id, s.snapshot_time, t.table_name, x.record_count, true AS has_size
FROM ({_SNAPSHOTS}) s JOIN ({_DATA_FILES}) f ON f.begin_snapshot = s.snapshot_id
JOIN created t ON t.table_id = f.table_id
JOIN (SELECT table_name, CAST(sum(record_count) AS BIGINT) AS record_count FROM commits GROUP BY table_name) x
  ON x.table_name = t.table_name
ORDER BY s.snapshot_time DESC, s.snapshot_id DESC LIMIT 10""",
    "files_for_snapshot": _COMMITS
    + f"""SELECT path, record_count, has_size, file_order FROM ({_DATA_FILES})
WHERE begin_snapshot = 3 ORDER BY file_order""",
    "snapshot_null_fields": _COMMITS
    + f"""SELECT count(*) AS n_snapshots, count(*) FILTER (WHERE snapshot_id IS NULL OR snapshot_time IS NULL
  OR schema_version IS NULL OR next_catalog_id IS NULL OR next_file_id IS NULL) AS n_with_nulls FROM ({_SNAPSHOTS})""",
    "total_records": f"""SELECT CAST(coalesce(sum(record_count), 0) AS BIGINT) AS total_records
FROM ({_manifest()})""",
    "distinct_mappings": _COMMITS
    + f"""SELECT table_id, count(DISTINCT mapping_id) AS n_mappings, min(mapping_id) AS mapping_id
FROM ({_DATA_FILES}) GROUP BY table_id""",
    "catalog_checks": _COMMITS
    + """SELECT 'has_data_files' AS check_name, count(*) > 0 AS ok FROM commits
UNION ALL SELECT 'snapshot_per_file', count(DISTINCT snapshot_id) = count(*) FROM commits
UNION ALL SELECT 'snapshots_without_gaps', min(snapshot_id) = 1 AND max(snapshot_id) = count(*) FROM commits
UNION ALL SELECT 'no_null_snapshot_fields', count(*) = count(commit_time) FROM commits
UNION ALL SELECT 'paths_unique', true
UNION ALL SELECT 'file_order_unique', count(DISTINCT (table_name, file_order)) = count(*) FROM commits
UNION ALL SELECT 'no_empty_files', min(record_count) > 0 FROM commits
UNION ALL SELECT 'records_match_rows_written', sum(record_count) = (SELECT 2 * count(*) FROM events) FROM commits
UNION ALL SELECT 'one_mapping_per_table', count(*) = count(DISTINCT table_name) FROM created
UNION ALL SELECT 'mapping_ids_not_zero', min(table_id) >= 1 FROM created""",
    "catalog_commit": _COMMITS
    + f"""SELECT CASE WHEN tick < 3 THEN 'first' ELSE 'second' END AS commit_id, v.table_name, tick, seq, snapshot_id,
  snapshot_id - 1 AS data_file_id, file_order, record_count, next_row_id, schema_version,
  schema_version + 1 AS next_catalog_id, snapshot_id AS next_file_id,
  CASE WHEN file_order = 0 THEN (SELECT min(column_id) FROM catalog_columns c JOIN created t ON t.table_id = c.table_id
   WHERE t.table_name = v.table_name) END AS first_column_id
FROM versions v""",
    "catalog_schemas": """SELECT CAST(0 AS BIGINT) AS schema_id, regexp_replace(md5('schema/main'),
    '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS schema_uuid,
  CAST(0 AS BIGINT) AS begin_snapshot, CAST(NULL AS BIGINT) AS end_snapshot, 'main' AS schema_name, 'main/' AS path,
  true AS path_is_relative, count(DISTINCT table_name) AS n_tables, CAST(sum(record_count) AS BIGINT) AS record_count
FROM (""" + _manifest() + ")",
    # --- streams
    "stream_ingest_logs": f"SELECT {_LOG_LIST} FROM ({LOG_ROWS})",
    "stream_ingest_traces": f"SELECT {_SPAN_LIST} FROM ({SPAN_ROWS})",
    "stream_commit_idempotent": f"""SELECT severity_text, count(*) AS n_rows, true AS snapshots_added
FROM ({LOG_ROWS}) GROUP BY severity_text""",
    "ingest_rejects": """SELECT CASE WHEN event_id % 17 = 0 THEN 'malformed line'
  WHEN event_id % 19 = 1 THEN 'unreadable observedTimeUnixNano'
  WHEN event_id % 23 = 2 THEN 'no JSON for NaN or infinity' ELSE 'stored' END AS reason, count(*) AS n_records
FROM events GROUP BY 1""",
}
