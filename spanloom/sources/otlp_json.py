"""OTLP/JSON payloads (one payload per line, as the public protocol defines them) and how their records are read.

In OTLP/JSON ids are hex text, numbers may be text, and every value is wrapped: {"stringValue": "x"},
{"arrayValue": {"values": [...]}} and so on.

Nothing is lost unseen: a line that is no JSON object is kept in the column `malformed`, a record with a number or an id
that cannot be read names these fields in its `problem`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanloom.functions.json_text import folded_text, nodes_text, plain_double_text
from spanloom.schemas import LOGS, Signal

_ANY = "VARIANT"
_PAIRS = f"ARRAY<STRUCT<key: STRING, value: {_ANY}>>"
_RESOURCE = f"STRUCT<attributes: {_PAIRS}>"
_SCOPE = "STRUCT<name: STRING, version: STRING>"

LOGS_JSON = f"""resourceLogs ARRAY<STRUCT<resource: {_RESOURCE}, scopeLogs: ARRAY<STRUCT<scope: {_SCOPE},
  logRecords: ARRAY<STRUCT<timeUnixNano: STRING, observedTimeUnixNano: STRING, severityNumber: STRING,
    severityText: STRING, body: {_ANY}, attributes: {_PAIRS}, flags: STRING, traceId: STRING, spanId: STRING>>>>>>"""

TRACES_JSON = f"""resourceSpans ARRAY<STRUCT<resource: {_RESOURCE}, scopeSpans: ARRAY<STRUCT<scope: {_SCOPE},
  spans: ARRAY<STRUCT<traceId: STRING, spanId: STRING, parentSpanId: STRING, traceState: STRING, flags: STRING,
    name: STRING, kind: STRING, startTimeUnixNano: STRING, endTimeUnixNano: STRING, attributes: {_PAIRS},
    droppedAttributesCount: STRING,
    events: ARRAY<STRUCT<timeUnixNano: STRING, name: STRING, attributes: {_PAIRS}, droppedAttributesCount: STRING>>,
    droppedEventsCount: STRING,
    links: ARRAY<STRUCT<traceId: STRING, spanId: STRING, traceState: STRING, attributes: {_PAIRS},
      droppedAttributesCount: STRING, flags: STRING>>,
    droppedLinksCount: STRING, status: STRUCT<code: STRING, message: STRING>>>>>>>"""

# The names the protocol's JSON form allows instead of enum numbers.
SPAN_KINDS = {
    "SPAN_KIND_UNSPECIFIED": 0,
    "SPAN_KIND_INTERNAL": 1,
    "SPAN_KIND_SERVER": 2,
    "SPAN_KIND_CLIENT": 3,
    "SPAN_KIND_PRODUCER": 4,
    "SPAN_KIND_CONSUMER": 5,
}
STATUS_CODES = {"STATUS_CODE_UNSET": 0, "STATUS_CODE_OK": 1, "STATUS_CODE_ERROR": 2}
SEVERITY_BASES = {"TRACE": 1, "DEBUG": 5, "INFO": 9, "WARN": 13, "ERROR": 17, "FATAL": 21}
SEVERITY_NAMES = {
    f"SEVERITY_NUMBER_{level}{'' if step == 0 else step + 1}": base + step
    for level, base in SEVERITY_BASES.items()
    for step in range(4)
}


# What came with a payload: the line itself if it cannot be read, and the file it is from.
MALFORMED = "malformed"
SOURCE_FILE = "source_file"


def _enum(text: str, names: dict[str, int]) -> str:
    pairs = ", ".join(f"'{name}', {number}" for name, number in names.items())
    return f"coalesce(try_cast({text} AS INT), try_element_at(map({pairs}), {text}))"


def _problem(checks: dict[str, str]) -> str:
    """SQL text: the names of the fields that hold a text but could not be read, comma-joined; NULL if all could."""
    named = ", ".join(f"CASE WHEN nullif({text}, '') IS NOT NULL AND {value} IS NULL THEN '{text.split('.')[-1]}' END" for text, value in checks.items())
    return f"nullif(concat_ws(',', {named}), '')"


def _id(text: str) -> str:
    return f"try_to_binary({text}, 'hex')"


_WRAPPED_CHILDREN = """coalesce(
    transform(try_variant_get(nd.v, '$.arrayValue.values', 'array<variant>'), c -> named_struct('key', CAST(NULL AS STRING), 'v', c)),
    transform(try_variant_get(nd.v, '$.kvlistValue.values', 'array<struct<key:string,value:variant>>'),
      c -> named_struct('key', coalesce(c.key, ''), 'v', c.value)))"""


def _held(value: str, name: str, kind: str) -> str:
    return f"try_variant_get({value}, '$.{name}', '{kind}')"


def _scalar(value: str) -> str:
    return f"""coalesce(CAST({_held(value, 'stringValue', 'string')} AS VARIANT), CAST({_held(value, 'intValue', 'bigint')} AS VARIANT),
      element_at(transform(array({_held(value, 'doubleValue', 'double')}), f -> {plain_double_text('f')}), 1),
      CAST({_held(value, 'boolValue', 'boolean')} AS VARIANT),
      CAST(try_to_binary({_held(value, 'bytesValue', 'string')}, 'base64') AS VARIANT))"""


def unwrap(value: str) -> str:
    """SQL text that turns a wrapped value of any depth into a plain VARIANT; an empty wrapper becomes JSON null."""

    def nested(v: str) -> str:
        return f"{_held(v, 'arrayValue', 'variant')} IS NOT NULL OR {_held(v, 'kvlistValue', 'variant')} IS NOT NULL"

    # Each level has a "values" of its own.
    levels = f"""2 + CAST((length(to_json({value})) - length(replace(to_json({value}), '"values"', ''))) div 8 AS INT)"""
    answer = f"""CASE WHEN {_held('nd.v', 'arrayValue', 'variant')} IS NOT NULL THEN to_variant_object(transform(below, c -> c.r))
      WHEN {_held('nd.v', 'kvlistValue', 'variant')} IS NOT NULL
        THEN to_variant_object(map_from_entries(transform(below, c -> named_struct('key', c.key, 'value', c.r))))
      ELSE coalesce({_scalar('nd.v')}, parse_json('null')) END"""
    walked = folded_text(nodes_text(value, _WRAPPED_CHILDREN, levels), answer, "VARIANT")
    return f"coalesce({_scalar(value)}, CASE WHEN {nested(value)} THEN {walked} END, parse_json('null'))"


def plain_pairs(attributes: str) -> str:
    """SQL text: attribute pairs with wrapped values as pairs with plain ones."""
    return f"transform({attributes}, a -> named_struct('key', a.key, 'value', {unwrap('a.value')}))"


def _whole(text: str) -> str:
    """Numbers may be written as numbers or as text."""
    return f"try_cast({text} AS BIGINT)"


def _struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {text}" for name, text in fields.items()) + ")"


# What is read from text in a record, an event and a link: the field, its name in the payload schema, and how.
_LOG_READ = {
    "timeUnixNano": ("time_unix_nano", _whole),
    "observedTimeUnixNano": ("observed_time_unix_nano", _whole),
    "severityNumber": ("severity_number", lambda text: _enum(text, SEVERITY_NAMES)),
    "flags": ("flags", _whole),
    "traceId": ("trace_id", _id),
    "spanId": ("span_id", _id),
}
_SPAN_READ = {
    "traceId": ("trace_id", _id),
    "spanId": ("span_id", _id),
    "parentSpanId": ("parent_span_id", _id),
    "flags": ("flags", _whole),
    "startTimeUnixNano": ("start_time_unix_nano", _whole),
    "endTimeUnixNano": ("end_time_unix_nano", _whole),
    "droppedAttributesCount": ("dropped_attributes_count", _whole),
    "droppedEventsCount": ("dropped_events_count", _whole),
    "droppedLinksCount": ("dropped_links_count", _whole),
    "kind": ("kind", lambda text: _enum(text, SPAN_KINDS)),
    "status.code": ("status_code", lambda text: _enum(text, STATUS_CODES)),
}
_EVENT_READ = {"timeUnixNano": ("time_unix_nano", _whole), "droppedAttributesCount": ("dropped_attributes_count", _whole)}
_LINK_READ = {
    "traceId": ("trace_id", _id),
    "spanId": ("span_id", _id),
    "droppedAttributesCount": ("dropped_attributes_count", _whole),
    "flags": ("flags", _whole),
}


def _read(r: str, fields: dict) -> dict[str, str]:
    """SQL text of what is read, by its name in the payload schema."""
    return {name: how(f"{r}.{field}") for field, (name, how) in fields.items()}


def _inner(items: str, fields: dict, **more: str) -> str:
    """Events or links without their attributes."""
    return f"transform({items}, i -> {_struct(**_read('i', fields), **{name: f'i.{field}' for name, field in more.items()})})"


def record_fields(signal: Signal, r: str) -> dict[str, str]:
    """SQL text of the fields of a wrapped record, by their names in the payload schema; a status as status_code and
    status_message. `attributes` of a log record are plain pairs; `lists` are those of a span, its events and its links."""
    if signal is LOGS:
        return {
            **_read(r, _LOG_READ),
            "severity_text": f"{r}.severityText",
            "body": f"CASE WHEN {r}.body IS NOT NULL THEN {unwrap(f'{r}.body')} END",
            "attributes": plain_pairs(f"{r}.attributes"),
        }
    return {
        **_read(r, _SPAN_READ),
        "trace_state": f"{r}.traceState",
        "name": f"{r}.name",
        "status_message": f"{r}.status.message",
        "events": _inner(f"{r}.events", _EVENT_READ, name="name"),
        "links": _inner(f"{r}.links", _LINK_READ, trace_state="traceState"),
        "lists": f"transform({attribute_lists(r)}, l -> {plain_pairs('l')})",
    }


def attribute_lists(r: str) -> str:
    """SQL text: the attributes of a span, then those of its events, then those of its links."""
    inner = ", ".join(f"coalesce(transform({r}.{items}, i -> i.attributes), array())" for items in ("events", "links"))
    return f"concat(array({r}.attributes), {inner})"


def record_problem(signal: Signal, r: str, read: str) -> str:
    """SQL text: the names of a wrapped record's fields that hold a text but could not be read, comma-joined; NULL if all
    could. `read` is what comes before the name of a column that holds what was read."""

    def of(fields: dict) -> str:
        return _problem({f"{r}.{field}": f"{read}{name}" for field, (name, _) in fields.items()})

    if signal is LOGS:
        return of(_LOG_READ)

    def inner(items: str, fields: dict) -> str:
        problem = _problem({f"i.{field}": how(f"i.{field}") for field, (_, how) in fields.items()})
        return f"CASE WHEN size({r}.{items}) > 0 THEN nullif(concat_ws(',', array_compact(transform({r}.{items}, i -> {problem}))), '') END"

    return f"nullif(concat_ws(',', {of(_SPAN_READ)}, {inner('events', _EVENT_READ)}, {inner('links', _LINK_READ)}), '')"


# A payload's levels as OTLP/JSON names them.
LEVELS = {"logs": ("resourceLogs", "scopeLogs", "logRecords"), "traces": ("resourceSpans", "scopeSpans", "spans")}


def is_wrapped(payloads: DataFrame, signal: Signal) -> bool:
    """Whether a payload's records are as its line has them, for flatten() to read one by one."""
    return LEVELS[signal.name][0] in payloads.columns


def from_otlp_json(lines: DataFrame, signal: Signal) -> DataFrame:
    """Text lines (value, source_file) to payload rows, with `malformed`, the line if it is no JSON object that fits the
    schema, and `source_file`. A malformed line gives no records, not even those that could be read before the fault; blank
    lines are no lines. Map-only.

    Payloads keep the names and wrapped values of their lines. Their records are read by flatten(), once they are rows: inside
    lists Spark would interpret each expression instead of compiling it."""
    options = "map('columnNameOfCorruptRecord', '_corrupt')"
    parsed = lines.where("trim(value) <> ''").selectExpr(
        f"from_json(value, '{json_schema(signal)}, _corrupt STRING', {options}) AS line", SOURCE_FILE
    )
    resources = LEVELS[signal.name][0]
    return parsed.selectExpr(
        f"CASE WHEN line._corrupt IS NULL THEN line.{resources} END AS {resources}", f"line._corrupt AS {MALFORMED}", SOURCE_FILE
    )


def json_schema(signal: Signal) -> str:
    return LOGS_JSON if signal is LOGS else TRACES_JSON


def _lines(read, folder: str) -> DataFrame:
    return read.text(folder).selectExpr("value", f"_metadata.file_path AS {SOURCE_FILE}")


def read_otlp_json(spark: SparkSession, folder: str, signal: Signal) -> DataFrame:
    return from_otlp_json(_lines(spark.read, folder), signal)


def stream_otlp_json(spark: SparkSession, folder: str, signal: Signal, files_per_batch: int | None = None) -> DataFrame:
    """A landing folder as a stream of lines, for from_otlp_json() to decode inside each micro-batch. What a stream has
    worked out is made in full whenever a micro-batch is read, also for one column of it."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _lines(reader, folder)


def is_lines(df: DataFrame) -> bool:
    """Whether these are lines that are still to be decoded."""
    return df.columns == ["value", SOURCE_FILE]
