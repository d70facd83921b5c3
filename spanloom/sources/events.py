"""Telemetry made from the `events` table, the only input at hand.

Every event gives one log record and one span; five consecutive events form one trace whose first event is the
root. The same rows are also available as nested payloads. All of it is map-only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions.scalars import TIMESTAMP_TEXT
from spanloom.schemas import LOGS, Signal

# `ts` is read straight as TIMESTAMP (UTC), without a cast that would keep time filters from the scan.
EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


# Expressions shared by the flat and the nested form.
_TRACE = "md5(CAST(event_id - event_id % 5 AS STRING))"
_SPAN = "substr(md5(CAST(event_id AS STRING)), 1, 16)"
_ROOT_SPAN = "substr(md5(CAST(event_id - event_id % 5 AS STRING)), 1, 16)"
_LINKED_TRACE = "md5(CAST(event_id - 1 AS STRING))"
_LINKED_SPAN = "substr(md5(CAST(event_id - 1 AS STRING)), 1, 16)"
_SEVERITY = "CASE event_type WHEN 'error' THEN 17 WHEN 'purchase' THEN 13 WHEN 'click' THEN 5 ELSE 9 END"
_SEVERITY_TEXT = (
    "CASE event_type WHEN 'error' THEN 'Error' WHEN 'purchase' THEN 'Warn' WHEN 'click' THEN 'Debug' ELSE 'Info' END"
)
_BODY = "concat('event ', event_type, ' by user ', CAST(user_id AS STRING))"
_SERVICE = "concat('svc-', CAST(user_id % 5 AS STRING))"
_RESOURCE_JSON = f"concat('{{\"deployment.environment\":\"test\",\"service.name\":\"', {_SERVICE}, '\"}}')"
_ATTRIBUTES_JSON = "CASE WHEN event_id % 7 = 0 THEN '{}' ELSE replace(props, ': ', ':') END"
_MILLIS = "CAST(round(value * 100) AS BIGINT)"
_TS_TEXT = f"date_format(ts, '{TIMESTAMP_TEXT}')"


def log_rows(events: DataFrame) -> DataFrame:
    """Flat log rows plus `arrival`, the order in which they came in."""
    return events.selectExpr(
        "ts AS timestamp",
        f"CASE WHEN event_id % 5 <> 4 THEN {_TRACE} END AS trace_id",
        f"CASE WHEN event_id % 5 <> 4 THEN {_SPAN} END AS span_id",
        f"{_SEVERITY} AS severity_number",
        f"{_SEVERITY_TEXT} AS severity_text",
        f"{_BODY} AS body",
        "'events' AS scope_name",
        "'1.0.0' AS scope_version",
        f"{_RESOURCE_JSON} AS resource_attributes",
        f"{_ATTRIBUTES_JSON} AS log_attributes",
        "CAST(CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS flags",
        "ts AS observed_timestamp",
        "event_id AS arrival",
    )


def span_rows(events: DataFrame) -> DataFrame:
    """Flat span rows plus `arrival`."""
    return events.selectExpr(
        f"{_TRACE} AS trace_id",
        f"{_SPAN} AS span_id",
        f"CASE WHEN event_id % 5 <> 0 THEN {_ROOT_SPAN} END AS parent_span_id",
        "event_type AS name",
        "CAST(event_id % 5 + 1 AS INT) AS kind",
        "ts AS start_time",
        f"timestamp_micros(unix_micros(ts) + {_MILLIS} * 1000) AS end_time",
        f"{_MILLIS} * 1000000 AS duration_ns",
        "CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS status_code",
        "CASE WHEN event_type = 'error' THEN 'request failed' END AS status_message",
        "'events' AS scope_name",
        "'1.0.0' AS scope_version",
        f"{_RESOURCE_JSON} AS resource_attributes",
        f"{_ATTRIBUTES_JSON} AS span_attributes",
        f"""CASE WHEN event_id % 5 = 0 THEN concat('[{{"timestamp":"', {_TS_TEXT},
            '","name":"cache-miss","attributes":{{"cache.tier":"edge"}}}}]') ELSE '[]' END AS events""",
        f"""CASE WHEN event_id > 0 AND event_id % 4 = 0 THEN concat('[{{"trace_id":"', {_LINKED_TRACE},
            '","span_id":"', {_LINKED_SPAN}, '","attributes":{{"reason":"retry"}}}}]') ELSE '[]' END AS links""",
        "0L AS dropped_attributes_count",
        "0L AS dropped_events_count",
        "0L AS dropped_links_count",
        "CAST(NULL AS STRING) AS trace_state",
        "0L AS flags",
        "event_id AS arrival",
    )


def rows(events: DataFrame, signal: Signal) -> DataFrame:
    return log_rows(events) if signal is LOGS else span_rows(events)


def _pair(key: str, value: Column) -> Column:
    return F.struct(F.lit(key).alias("key"), value.cast("variant").alias("value"))


def resource_pairs() -> Column:
    # Deliberately not in key order: printing sorts.
    return F.array(_pair("service.name", F.expr(_SERVICE)), _pair("deployment.environment", F.lit("test")))


def event_pairs() -> Column:
    """The event's `props` as attribute pairs, none for every seventh event."""
    pairs = F.map_entries(F.from_json("props", "map<string,variant>"))
    return F.when(F.expr("event_id % 7 = 0"), F.slice(pairs, 1, 0)).otherwise(pairs)


def _nanos() -> Column:
    return F.expr("unix_micros(ts) * 1000")


def log_payloads(events: DataFrame) -> DataFrame:
    """One payload per event; some also have an empty scope and an empty resource, which must give no rows."""
    record = F.struct(
        _nanos().alias("time_unix_nano"),
        _nanos().alias("observed_time_unix_nano"),
        F.expr(_SEVERITY).alias("severity_number"),
        F.expr(_SEVERITY_TEXT).alias("severity_text"),
        F.expr(_BODY).cast("variant").alias("body"),
        event_pairs().alias("attributes"),
        F.expr("CAST(CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS BIGINT)").alias("flags"),
        # An all-zero id means "not set".
        F.expr(f"unhex(CASE WHEN event_id % 5 <> 4 THEN {_TRACE} ELSE repeat('0', 32) END)").alias("trace_id"),
        F.expr(f"unhex(CASE WHEN event_id % 5 <> 4 THEN {_SPAN} ELSE repeat('0', 16) END)").alias("span_id"),
    )
    return nested(events, record, "resource_logs", "scope_logs", "log_records")


def span_payloads(events: DataFrame) -> DataFrame:
    no_count = F.lit(0).cast("bigint")
    event = F.struct(
        _nanos().alias("time_unix_nano"),
        F.lit("cache-miss").alias("name"),
        F.array(_pair("cache.tier", F.lit("edge"))).alias("attributes"),
        no_count.alias("dropped_attributes_count"),
    )
    link = F.struct(
        F.expr(f"unhex({_LINKED_TRACE})").alias("trace_id"),
        F.expr(f"unhex({_LINKED_SPAN})").alias("span_id"),
        F.lit("").alias("trace_state"),
        F.array(_pair("reason", F.lit("retry"))).alias("attributes"),
        no_count.alias("dropped_attributes_count"),
        no_count.alias("flags"),
    )

    def one_if(condition: str, item: Column) -> Column:
        return F.when(F.expr(condition), F.array(item)).otherwise(F.slice(F.array(item), 1, 0))

    record = F.struct(
        F.expr(f"unhex({_TRACE})").alias("trace_id"),
        F.expr(f"unhex({_SPAN})").alias("span_id"),
        F.expr(f"unhex(CASE WHEN event_id % 5 <> 0 THEN {_ROOT_SPAN} ELSE repeat('0', 16) END)").alias(
            "parent_span_id"
        ),
        F.lit("").alias("trace_state"),
        no_count.alias("flags"),
        F.col("event_type").alias("name"),
        F.expr("CAST(event_id % 5 + 1 AS INT)").alias("kind"),
        _nanos().alias("start_time_unix_nano"),
        F.expr(f"unix_micros(ts) * 1000 + {_MILLIS} * 1000000").alias("end_time_unix_nano"),
        event_pairs().alias("attributes"),
        no_count.alias("dropped_attributes_count"),
        one_if("event_id % 5 = 0", event).alias("events"),
        no_count.alias("dropped_events_count"),
        one_if("event_id > 0 AND event_id % 4 = 0", link).alias("links"),
        no_count.alias("dropped_links_count"),
        F.struct(
            F.expr("CASE WHEN event_type = 'error' THEN 2 ELSE 1 END").alias("code"),
            F.expr("CASE WHEN event_type = 'error' THEN 'request failed' ELSE '' END").alias("message"),
        ).alias("status"),
    )
    return nested(events, record, "resource_spans", "scope_spans", "spans")


def payloads(events: DataFrame, signal: Signal) -> DataFrame:
    return log_payloads(events) if signal is LOGS else span_payloads(events)


def nested(events: DataFrame, record: Column, resources: str, scopes: str, records: str) -> DataFrame:
    def scope(name: str, items: Column) -> Column:
        named = F.struct(F.lit(name).alias("name"), F.lit("1.0.0").alias("version")).alias("scope")
        return F.struct(named, items.alias(records))

    def resource(pairs: Column, items: Column) -> Column:
        return F.struct(F.struct(pairs.alias("attributes")).alias("resource"), items.alias(scopes))

    found = F.array(record)
    with_idle = F.expr("event_id % 8 = 0")
    full_scope = scope("events", found)
    scopes_found = F.when(with_idle, F.array(scope("idle", F.slice(found, 1, 0)), full_scope)).otherwise(
        F.array(full_scope)
    )
    full = resource(resource_pairs(), scopes_found)
    empty = resource(resource_pairs(), F.slice(F.array(full_scope), 1, 0))
    payload = F.when(with_idle, F.array(empty, full)).otherwise(F.array(full))
    return events.select(F.col("event_id").alias("arrival"), payload.alias(resources))


def otlp_lines(events: DataFrame, signal: Signal, keep: list[str] | None = None) -> DataFrame:
    """The same payloads in OTLP/JSON form, to be written as a landing folder with write.json(). `keep` names columns of
    the events that stay beside them."""

    def text(value: Column) -> Column:
        return F.struct(value.alias("stringValue"))

    def pair(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), text(value).alias("value"))

    numbers = F.map_entries(F.from_json("props", "map<string,string>"))
    attributes = F.transform(
        F.when(F.expr("event_id % 7 <> 0"), numbers),
        lambda e: F.struct(e["key"].alias("key"), F.struct(e["value"].alias("intValue")).alias("value")),
    )
    nanos = _nanos().cast("string")
    if signal is LOGS:
        names = ("resourceLogs", "scopeLogs", "logRecords")
        record = F.struct(
            nanos.alias("timeUnixNano"),
            nanos.alias("observedTimeUnixNano"),
            F.expr(_SEVERITY).alias("severityNumber"),
            F.expr(_SEVERITY_TEXT).alias("severityText"),
            text(F.expr(_BODY)).alias("body"),
            attributes.alias("attributes"),
            F.expr("CASE WHEN event_id % 10 = 0 THEN 1 END").alias("flags"),
            F.expr(f"CASE WHEN event_id % 5 <> 4 THEN {_TRACE} ELSE '' END").alias("traceId"),
            F.expr(f"CASE WHEN event_id % 5 <> 4 THEN {_SPAN} ELSE '' END").alias("spanId"),
        )
    else:
        names = ("resourceSpans", "scopeSpans", "spans")
        event = F.struct(
            nanos.alias("timeUnixNano"),
            F.lit("cache-miss").alias("name"),
            F.array(pair("cache.tier", F.lit("edge"))).alias("attributes"),
        )
        link = F.struct(
            F.expr(_LINKED_TRACE).alias("traceId"),
            F.expr(_LINKED_SPAN).alias("spanId"),
            F.array(pair("reason", F.lit("retry"))).alias("attributes"),
        )
        record = F.struct(
            F.expr(_TRACE).alias("traceId"),
            F.expr(_SPAN).alias("spanId"),
            F.expr(f"CASE WHEN event_id % 5 <> 0 THEN {_ROOT_SPAN} END").alias("parentSpanId"),
            F.col("event_type").alias("name"),
            F.expr("CAST(event_id % 5 + 1 AS INT)").alias("kind"),
            nanos.alias("startTimeUnixNano"),
            F.expr(f"CAST(unix_micros(ts) * 1000 + {_MILLIS} * 1000000 AS STRING)").alias("endTimeUnixNano"),
            attributes.alias("attributes"),
            F.when(F.expr("event_id % 5 = 0"), F.array(event)).alias("events"),
            F.when(F.expr("event_id > 0 AND event_id % 4 = 0"), F.array(link)).alias("links"),
            F.struct(
                F.expr("CASE WHEN event_type = 'error' THEN 2 ELSE 1 END").alias("code"),
                F.expr("CASE WHEN event_type = 'error' THEN 'request failed' END").alias("message"),
            ).alias("status"),
        )
    scope = F.struct(F.lit("events").alias("name"), F.lit("1.0.0").alias("version"))
    scoped = F.struct(scope.alias("scope"), F.array(record).alias(names[2]))
    pairs = F.array(pair("service.name", F.expr(_SERVICE)), pair("deployment.environment", F.lit("test")))
    resource = F.struct(F.struct(pairs.alias("attributes")).alias("resource"), F.array(scoped).alias(names[1]))
    return events.select(*(keep or []), F.array(resource).alias(names[0]))
