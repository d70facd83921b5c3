"""Nested payloads to flat rows.

One payload row holds resources, each with scopes, each with records. Levels are exploded one after the other and
each level's own columns are computed before the next explode, so a resource's attributes are printed once and not
once per record. No shuffle: a payload's records stay in the task that read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions.json_text import attributes_json, body_text, encodable_text, events_json, links_json, object_text, with_kinds
from spanloom.functions.scalars import nanos_to_timestamp, null_if_empty, span_id_text, trace_id_text, zero_if_null
from spanloom.schemas import LOGS, TRACES, Signal
from spanloom.sources import otlp_json

POSITIONS = ["resource_pos", "scope_pos", "record_pos"]
ENCODABLE = "encodable"
REASON = "reason"  # why a record cannot be stored; NULL if it can

# A payload's levels in the payload schema.
_LEVELS = {"logs": ("resource_logs", "scope_logs", "log_records"), "traces": ("resource_spans", "scope_spans", "spans")}


def _exploded(payloads: DataFrame, signal: Signal, carry: list[str]) -> DataFrame:
    """One row per record, with its fields as columns rec_<field> and what its line holds that cannot be read as `_problem`.
    Inner explodes: a resource without scopes and a scope without records give no rows."""
    wrapped = otlp_json.is_wrapped(payloads, signal)
    resources, scopes, records = (otlp_json.LEVELS if wrapped else _LEVELS)[signal.name]
    pairs = "r.resource.attributes"
    # The outer form of the first explode keeps Spark from adding a size() filter below it, which would decode every
    # payload twice when the payload is computed. Its NULL rows end at the next explode.
    level = payloads.select(*carry, F.posexplode_outer(resources).alias("resource_pos", "r"))
    level = level.select(
        *carry,
        "resource_pos",
        F.expr(with_kinds(otlp_json.plain_pairs(pairs) if wrapped else pairs)).alias("pairs"),
        F.col(f"r.{scopes}").alias("scopes"),
    )
    level = level.select(
        *carry,
        "resource_pos",
        attributes_json("pairs", object_text("pairs")).alias("resource_attributes"),
        F.expr(encodable_text("pairs")).alias("resource_ok"),
        "scopes",
    )
    level = level.select(
        *carry, "resource_pos", "resource_attributes", "resource_ok", F.posexplode("scopes").alias("scope_pos", "s")
    )
    kept = [*carry, *POSITIONS, "resource_attributes", "resource_ok", "scope_name", "scope_version"]
    level = level.select(
        *carry,
        "resource_pos",
        "scope_pos",
        "resource_attributes",
        "resource_ok",
        null_if_empty(F.col("s.scope.name")).alias("scope_name"),
        null_if_empty(F.col("s.scope.version")).alias("scope_version"),
        F.posexplode(F.col(f"s.{records}")).alias("record_pos", "rec"),
    )
    known = level.schema["rec"].dataType.names
    if wrapped:
        fields = otlp_json.record_fields(signal, "rec")
        problem = otlp_json.record_problem(signal, "rec", "rec_")
    else:
        fields = {name: f"rec.{name}" for name in known if name not in ("attributes", "status")}
        if signal is LOGS:
            fields["attributes"] = "rec.attributes"
        else:
            fields |= {"status_code": "rec.status.code", "status_message": "rec.status.message", "lists": otlp_json.attribute_lists("rec")}
        # The problem a source found in a record; payloads of other sources have no such field.
        problem = "rec.problem" if "problem" in known else "CAST(NULL AS STRING)"
    level = level.select(*kept, "rec", *[F.expr(text).alias(f"rec_{name}") for name, text in fields.items()])
    return level.select(*kept, *[f"rec_{name}" for name in fields], F.expr(problem).alias("_problem"))


def _judged(rows: DataFrame) -> DataFrame:
    """`encodable` and `reason` from the record's own problem and from whether all attributes can be written as JSON."""
    ok, problem = F.col("_writable"), F.col("_problem")
    reason = F.when(problem.isNotNull(), F.concat(F.lit("unreadable "), problem)).when(~ok, F.lit("no JSON for NaN or infinity"))
    return rows.withColumns({ENCODABLE: ok & problem.isNull(), REASON: reason}).drop("_writable", "_problem")


def flatten_logs(payloads: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Log payload rows to log rows, with record positions, the `encodable` flag and the reason where it is not set."""
    carry = carry or []
    rec = F.col
    records = _exploded(payloads, LOGS, carry)
    records = records.withColumn("rec_attributes", F.expr(with_kinds("rec_attributes")))
    return _judged(records.select(
        *carry,
        *POSITIONS,
        nanos_to_timestamp(rec("rec_time_unix_nano")).alias("timestamp"),
        trace_id_text("rec_trace_id").alias("trace_id"),
        span_id_text("rec_span_id").alias("span_id"),
        F.coalesce(rec("rec_severity_number"), F.lit(0)).alias("severity_number"),
        null_if_empty(rec("rec_severity_text")).alias("severity_text"),
        body_text("rec_body").alias("body"),
        "scope_name",
        "scope_version",
        "resource_attributes",
        attributes_json("rec_attributes", object_text("rec_attributes")).alias("log_attributes"),
        zero_if_null(rec("rec_flags")).alias("flags"),
        nanos_to_timestamp(rec("rec_observed_time_unix_nano")).alias("observed_timestamp"),
        (rec("resource_ok") & F.expr(encodable_text("rec_attributes"))).alias("_writable"),
        "_problem",
    ))


def flatten_traces(payloads: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Span payload rows to span rows, with record positions, the `encodable` flag and the reason where it is not set."""
    carry = carry or []
    rec = F.col
    start, end = (F.coalesce(rec(f"rec_{c}"), F.lit(0)) for c in ("start_time_unix_nano", "end_time_unix_nano"))
    records = _exploded(payloads, TRACES, carry)
    # Attributes of the span, its events and its links go through one expression.
    printed = f"named_struct('json', CASE WHEN size(l) > 0 THEN {object_text('l')} END, 'ok', {encodable_text('l')})"
    records = records.withColumn("_lists", F.expr(f"transform(rec_lists, l -> {with_kinds('l')})"))
    records = records.withColumn("_printed", F.expr(f"transform(_lists, l -> {printed})"))
    return _judged(records.select(
        *carry,
        *POSITIONS,
        trace_id_text("rec_trace_id").alias("trace_id"),
        span_id_text("rec_span_id").alias("span_id"),
        span_id_text("rec_parent_span_id").alias("parent_span_id"),
        F.coalesce(rec("rec_name"), F.lit("")).alias("name"),
        F.coalesce(rec("rec_kind"), F.lit(0)).alias("kind"),
        nanos_to_timestamp(start).alias("start_time"),
        nanos_to_timestamp(end).alias("end_time"),
        (end - start).alias("duration_ns"),
        F.coalesce(rec("rec_status_code"), F.lit(0)).alias("status_code"),
        null_if_empty(rec("rec_status_message")).alias("status_message"),
        "scope_name",
        "scope_version",
        "resource_attributes",
        attributes_json("rec_lists[0]", "_printed[0].json").alias("span_attributes"),
        events_json("rec_events", "_printed[n + 1].json").alias("events"),
        links_json("rec_links", "_printed[n + 1 + greatest(size(rec_events), 0)].json").alias("links"),
        zero_if_null(rec("rec_dropped_attributes_count")).alias("dropped_attributes_count"),
        zero_if_null(rec("rec_dropped_events_count")).alias("dropped_events_count"),
        zero_if_null(rec("rec_dropped_links_count")).alias("dropped_links_count"),
        null_if_empty(rec("rec_trace_state")).alias("trace_state"),
        zero_if_null(rec("rec_flags")).alias("flags"),
        (rec("resource_ok") & F.expr("forall(_printed, p -> p.ok)")).alias("_writable"),
        "_problem",
    ))


def flatten(payloads: DataFrame, signal: Signal, carry: list[str] | None = None) -> DataFrame:
    return (flatten_logs if signal is LOGS else flatten_traces)(payloads, carry)


def encodable_rows(rows: DataFrame) -> DataFrame:
    """Rows fit for storing; one bad record never holds back the others."""
    return rows.filter(F.col(ENCODABLE)).drop(ENCODABLE, REASON)


def rejected_rows(rows: DataFrame) -> DataFrame:
    """Rows that cannot be stored, with the reason."""
    return rows.filter(~F.col(ENCODABLE)).drop(ENCODABLE)


def insert_missing_attributes(attributes, defaults: dict[str, str]):
    """Add attributes that are not there yet; those present keep their value."""

    def added(key: str, value: str):
        present = F.coalesce(F.exists(attributes, lambda a: a["key"] == F.lit(key)), F.lit(False))
        pair = F.struct(F.lit(key).alias("key"), F.lit(value).cast("variant").alias("value"))
        return F.when(~present, pair)

    absent = F.array(*[added(key, value) for key, value in defaults.items()])
    return F.concat(F.array_compact(absent), F.coalesce(attributes, F.array()))
