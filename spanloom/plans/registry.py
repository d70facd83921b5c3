"""All queries by name, over the `events` table of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions.json_text import attributes_json, body_text, events_json, links_json
from spanloom.functions.scalars import base_name, file_path, span_id_text, timestamp_text, trace_id_text, translate_path
from spanloom.operators import stats
from spanloom.operators.batching import assign_file_batches
from spanloom.operators.flatten import (
    ENCODABLE,
    encodable_rows,
    flatten_logs,
    flatten_traces,
    insert_missing_attributes,
)
from spanloom.operators.sink import configured_writer, write_batches
from spanloom.options import CODECS, LakeOptions
from spanloom.plans import catalog, commit, manifest, queries
from spanloom.schemas import LOGS, TRACES, Signal
from spanloom.session import checkpointed, configure, new_scratch, size_shuffles
from spanloom.sources import events as source
from spanloom.sources import otlp_json, tables
from spanloom.streaming import ingest

# Parameters of the registered queries; the SQL in oracles.py uses the same.
START_MICROS = 1_704_067_200_000_000
TICK_SECONDS = 86_400
BATCH_SIZE = 100
# Written tables are cut more coarsely, so that files are not tiny.
WRITE_TICK_SECONDS = 5 * 86_400
WRITE_BATCH_SIZE = 1_000
DATA_PATH = "/lake"
TRACE_KEY = "cfcd208495d565ef66e7dff9f98764da"
ABSENT_TRACE = "7" * 32
SERVICE = "svc-3"
SPLIT_TICK = 3
PRUNE_DAYS = (11, 13)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore only keeps it apart from an imported one."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


# --- inputs ----------------------------------------------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    size_shuffles(configure(spark), f"{sf_dir}/events.parquet")
    return source.read_events(spark, sf_dir)


def _rows(spark: SparkSession, sf_dir: str, signal: Signal) -> DataFrame:
    return source.rows(_events(spark, sf_dir), signal).select(*signal.column_names)


def _options(output_path: str = "/staging/lake", data_path: str = "", **more) -> LakeOptions:
    more = {"batch_size": BATCH_SIZE, "batch_timeout_seconds": TICK_SECONDS, **more}
    return LakeOptions(output_path=output_path, data_path=data_path, **more)


def _write_options(spark: SparkSession, data_path: str = "", **more) -> LakeOptions:
    more = {"batch_size": WRITE_BATCH_SIZE, "batch_timeout_seconds": WRITE_TICK_SECONDS, **more}
    return _options(new_scratch(spark, "lake"), data_path, **more)


def _batches(spark: SparkSession, sf_dir: str, signal: Signal, options: LakeOptions | None = None) -> DataFrame:
    options = options or _options()
    return assign_file_batches(
        source.rows(_events(spark, sf_dir), signal),
        time=signal.time_column,
        arrival="arrival",
        batch_size=options.batch_size,
        timeout_seconds=options.batch_timeout_seconds,
        start_micros=START_MICROS,
    )


def _tick_end(options: LakeOptions):
    """Files are committed when their tick ends, so that results can be repeated."""
    width = int(options.batch_timeout_seconds * 1_000_000)
    return F.timestamp_micros(F.lit(START_MICROS) + (F.col("tick") + 1) * F.lit(width))


def _files(spark: SparkSession, sf_dir: str, signal: Signal, options: LakeOptions) -> DataFrame:
    """Write the table of a signal and describe its files."""
    batches = _batches(spark, sf_dir, signal, options)
    folder = write_batches(batches, signal, options, commit_id="all", arrival="arrival")
    return manifest.written_manifest(spark, folder, signal, options.table(signal.name), _tick_end(options))


def _both(spark: SparkSession, sf_dir: str, options: LakeOptions) -> DataFrame:
    """Both tables written, at the same time, and their files in one list, as the two streams share one catalog."""
    with ThreadPoolExecutor(max_workers=2) as pool:
        logs, spans = pool.map(lambda signal: _files(spark, sf_dir, signal, options), (LOGS, TRACES))
    return logs.unionByName(spans)


# Per application and input, the lake that the queries over stored tables share.
_LAKES: dict[tuple, LakeOptions] = {}


def _lake(spark: SparkSession, sf_dir: str, *signals: Signal, **more) -> LakeOptions:
    """A lake with the tables of the signals, both if none is named, written and committed; the one of an earlier query if
    it is still there."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir, *[s.name for s in signals], *sorted(more.items()))
    if key not in _LAKES or not commit.is_committed(spark, _LAKES[key], "all"):
        _LAKES[key] = _new_lake(spark, sf_dir, *signals, **more)
    return _LAKES[key]


def _new_lake(spark: SparkSession, sf_dir: str, *signals: Signal, **more) -> LakeOptions:
    options = _write_options(spark, **more)
    commit.open_catalog(spark, options, _started(spark, sf_dir))
    files = _files(spark, sf_dir, signals[0], options) if signals else _both(spark, sf_dir, options)
    commit.commit_files(files, options, "all")
    return options


def _commits(spark: SparkSession, sf_dir: str) -> tuple[LakeOptions, DataFrame]:
    options = _lake(spark, sf_dir)
    return options, commit.read_commits(spark, options)


def _started(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).agg(F.min("ts").alias("started"))


# --- sources and transforms ------------------------------------------------------------------------------------------


@query
def flatten_logs_(spark, sf_dir):
    rows = encodable_rows(flatten_logs(source.log_payloads(_events(spark, sf_dir))))
    return rows.select(*LOGS.column_names)


@query
def flatten_traces_(spark, sf_dir):
    rows = encodable_rows(flatten_traces(source.span_payloads(_events(spark, sf_dir))))
    return rows.select(*TRACES.column_names)


def _pair(key: str, value):
    return F.struct(F.lit(key).alias("key"), value.cast("variant").alias("value"))


def _mixed_pairs():
    """Attributes of all kinds, out of order, with a repeated key and characters that need escapes."""
    return F.array(
        _pair("user", F.expr("concat('<u&', user_id, '>')")),
        _pair("ok", F.expr("event_type <> 'error'")),
        _pair("amount", F.col("value")),
        _pair("kind", F.lit("first")),
        _pair("count", F.expr("event_id % 1000")),
        _pair("kind", F.col("event_type")),
        _pair("raw", F.expr("CAST(event_type AS BINARY)")),
        _pair("none", F.lit(None).cast("string")),
    )


@query
def attributes_json_(spark, sf_dir):
    pairs = F.when(F.expr("event_id % 11 = 0"), F.slice(_mixed_pairs(), 1, 0)).otherwise(_mixed_pairs())
    return _events(spark, sf_dir).select("event_id", pairs.alias("pairs")).select(
        "event_id", attributes_json("pairs").alias("attributes")
    )


@query
def span_events_json(spark, sf_dir):
    item = F.struct(
        F.expr("unix_micros(ts) * 1000 + 999").alias("time_unix_nano"),
        F.col("event_type").alias("name"),
        F.when(F.expr("event_id % 3 = 0"), F.array(_pair("user", F.col("user_id")), _pair("a", F.lit("<x>"))))
        .otherwise(F.slice(F.array(_pair("user", F.col("user_id"))), 1, 0))
        .alias("attributes"),
        F.expr("event_id % 2").alias("dropped_attributes_count"),
    )
    items = F.array_repeat(item, F.expr("CAST(event_id % 4 AS INT)"))
    return _events(spark, sf_dir).select("event_id", items.alias("items")).select(
        "event_id", events_json("items").alias("events")
    )


@query
def span_links_json(spark, sf_dir):
    item = F.struct(
        F.expr("unhex(md5(CAST(event_id AS STRING)))").alias("trace_id"),
        F.expr("unhex(CASE WHEN event_id % 5 = 0 THEN repeat('0', 16) ELSE substr(md5(CAST(event_id AS STRING)), 1, 16) END)")
        .alias("span_id"),
        F.expr("CASE WHEN event_id % 2 = 0 THEN concat('vendor=', event_type) ELSE '' END").alias("trace_state"),
        F.when(F.expr("event_id % 3 = 0"), F.array(_pair("user", F.col("user_id"))))
        .otherwise(F.slice(F.array(_pair("user", F.col("user_id"))), 1, 0))
        .alias("attributes"),
        F.expr("event_id % 2").alias("dropped_attributes_count"),
        F.expr("event_id % 3").alias("flags"),
    )
    items = F.array_repeat(item, F.expr("CAST(event_id % 3 AS INT)"))
    return _events(spark, sf_dir).select("event_id", items.alias("items")).select(
        "event_id", links_json("items").alias("links")
    )


@query
def id_hex(spark, sf_dir):
    trace = F.expr("unhex(CASE WHEN event_id % 6 = 0 THEN repeat('0', 32) ELSE upper(md5(CAST(event_id AS STRING))) END)")
    span = F.expr("unhex(CASE WHEN event_id % 4 = 0 THEN repeat('0', 16) ELSE substr(md5(CAST(event_id AS STRING)), 1, 16) END)")
    return _events(spark, sf_dir).select("event_id", trace.alias("t"), span.alias("s")).select(
        "event_id", trace_id_text("t").alias("trace_id"), span_id_text("s").alias("span_id")
    )


@query
def span_duration(spark, sf_dir):
    """Every ninth span ends before it starts."""
    events = _events(spark, sf_dir).withColumn("value", F.expr("CASE WHEN event_id % 9 = 0 THEN -value ELSE value END"))
    rows = flatten_traces(source.span_payloads(events), carry=["arrival"])
    return rows.select(F.col("arrival").alias("event_id"), "start_time", "end_time", "duration_ns")


@query
def body_to_string(spark, sf_dir):
    body = (
        F.when(F.expr("event_id % 7 = 0"), F.col("event_type").cast("variant"))
        .when(F.expr("event_id % 7 = 1"), F.col("user_id").cast("variant"))
        .when(F.expr("event_id % 7 = 2"), F.col("value").cast("variant"))
        .when(F.expr("event_id % 7 = 3"), (F.col("value") > 10).cast("variant"))
        .when(F.expr("event_id % 7 = 4"), F.parse_json("props"))
        .when(F.expr("event_id % 7 = 5"), F.to_variant_object(F.array("event_id", "user_id")))
    )
    return _events(spark, sf_dir).select("event_id", body.alias("raw")).select("event_id", body_text("raw").alias("body"))


@query
def reject_unencodable(spark, sf_dir):
    """Kept and rejected records per event type. NaN and infinities sit at the top and inside lists."""
    bad = F.expr("""CASE WHEN event_id % 13 = 0 THEN double('NaN') WHEN event_id % 13 = 1 THEN double('Infinity')
                    ELSE value END""")
    pairs = F.array(
        _pair("text", F.lit("NaN")),
        F.struct(
            F.lit("number").alias("key"),
            F.when(F.expr("event_id % 2 = 0"), bad.cast("variant"))
            .otherwise(F.to_variant_object(F.array(F.lit(1.5), bad)))
            .alias("value"),
        ),
    )
    events = _events(spark, sf_dir)
    record = F.struct(
        F.expr("unix_micros(ts) * 1000").alias("time_unix_nano"),
        F.expr("unix_micros(ts) * 1000").alias("observed_time_unix_nano"),
        F.lit(9).alias("severity_number"),
        F.lit("Info").alias("severity_text"),
        F.col("event_type").cast("variant").alias("body"),
        pairs.alias("attributes"),
        F.lit(0).cast("bigint").alias("flags"),
        F.lit(None).cast("binary").alias("trace_id"),
        F.lit(None).cast("binary").alias("span_id"),
    )
    rows = flatten_logs(source.nested(events, record, "resource_logs", "scope_logs", "log_records"))

    outcome = F.when(F.col(ENCODABLE), "kept").otherwise("rejected").alias("outcome")
    return rows.groupBy(F.col("body").alias("event_type"), outcome).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def timestamp_text_(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", timestamp_text(F.col("ts")).alias("ts_text"))


@query
def resource_attribute_default(spark, sf_dir):
    present = F.when(F.expr("event_id % 3 = 0"), source.resource_pairs()).otherwise(
        F.slice(source.resource_pairs(), 1, 1)
    )
    filled = insert_missing_attributes(present, {"deployment.environment": "production"})
    return _events(spark, sf_dir).select("event_id", filled.alias("pairs")).select(
        "event_id", attributes_json("pairs").alias("resource_attributes")
    )


# --- the documented log and trace queries ----------------------------------------------------------------------------


@query
def recent_error_logs(spark, sf_dir):
    return queries.recent_error_logs(_rows(spark, sf_dir, LOGS), lookback="1 DAY")


@query
def logs_for_trace(spark, sf_dir):
    return queries.logs_for_trace(_rows(spark, sf_dir, LOGS), TRACE_KEY)


@query
def slow_spans(spark, sf_dir):
    return queries.slow_spans(_rows(spark, sf_dir, TRACES), lookback="30 DAYS")


@query
def spans_by_service(spark, sf_dir):
    return queries.spans_by_service(_rows(spark, sf_dir, TRACES), SERVICE)


@query
def nonempty_trace_spans(spark, sf_dir):
    return queries.nonempty_trace_spans(_rows(spark, sf_dir, TRACES))


@query
def logs_with_span(spark, sf_dir):
    return queries.logs_with_span(_rows(spark, sf_dir, LOGS), _rows(spark, sf_dir, TRACES))


@query
def span_parent_join(spark, sf_dir):
    return queries.span_parent_join(_rows(spark, sf_dir, TRACES))


@query
def orphan_spans(spark, sf_dir):
    """Of all spans; the tables at hand have none whose parent is missing, unless rows are."""
    return queries.orphan_spans(_rows(spark, sf_dir, TRACES)).select("trace_id", "span_id", "parent_span_id", "name")


@query
def count_logs(spark, sf_dir):
    return _rows(spark, sf_dir, LOGS).agg(F.count(F.lit(1)).alias("n_logs"))


@query
def log_time_range(spark, sf_dir):
    return queries.time_range(_rows(spark, sf_dir, LOGS), "timestamp")


@query
def recent_error_logs_in_lake(spark, sf_dir):
    return queries.lake_recent_error_logs(spark, _lake(spark, sf_dir, LOGS), lookback="1 DAY")


@query
def slow_spans_in_lake(spark, sf_dir):
    return queries.lake_slow_spans(spark, _lake(spark, sf_dir, TRACES), lookback="30 DAYS")


@query
def spans_by_service_in_lake(spark, sf_dir):
    return queries.lake_spans_by_service(spark, _lake(spark, sf_dir, TRACES), SERVICE)


@query
def rows_since_now(spark, sf_dir):
    """The lookback against the clock: all events are older than an hour, and none is older than a thousand years."""
    logs = _rows(spark, sf_dir, LOGS)
    now = F.current_timestamp()
    return logs.agg(
        F.count_if(queries.newer_than(logs, "timestamp", "1 HOUR", now)).alias("last_hour"),
        F.count_if(queries.newer_than(logs, "timestamp", "1000 YEARS", now)).alias("last_thousand_years"),
    )


@query
def describe_tables(spark, sf_dir):
    """The columns that the footers of written files name, with the values that the files hold of each."""
    options = _lake(spark, sf_dir)
    parts = [
        tables.describe(tables.stored(spark, options.table_dir(signal.name))).select(F.lit(options.table(signal.name)).alias("table_name"), "*")
        for signal in (LOGS, TRACES)
    ]
    return parts[0].unionByName(parts[1])


# --- file building ---------------------------------------------------------------------------------------------------


@query
def assign_file_batches_(spark, sf_dir):
    return _batches(spark, sf_dir, LOGS).select("arrival", "tick", "seq")


@query
def log_file_column_stats(spark, sf_dir):
    return stats.long_form(stats.file_stats(_batches(spark, sf_dir, LOGS), LOGS, ["tick", "seq"]), ["tick", "seq"])


@query
def span_file_column_stats(spark, sf_dir):
    return stats.long_form(stats.file_stats(_batches(spark, sf_dir, TRACES), TRACES, ["tick", "seq"]), ["tick", "seq"])


@query
def typed_file_bounds(spark, sf_dir):
    _, files = _commits(spark, sf_dir)
    return stats.long_form(files, ["table_name", "tick", "seq"], "typed_bounds")


@query
def write_logs_roundtrip(spark, sf_dir):
    options = _write_options(spark)
    folder = write_batches(_batches(spark, sf_dir, LOGS, options), LOGS, options, commit_id="all", arrival="arrival")
    return manifest.read_files(spark, folder, LOGS.schema).select(*LOGS.column_names)


@query
def write_traces_roundtrip(spark, sf_dir):
    options = _write_options(spark)
    folder = write_batches(_batches(spark, sf_dir, TRACES, options), TRACES, options, commit_id="all", arrival="arrival")
    return manifest.read_files(spark, folder, TRACES.schema).select(*TRACES.column_names)


@query
def write_codecs(spark, sf_dir):
    """The span table once per codec: every row as it was read back, and the file name ending."""
    rows = _rows(spark, sf_dir, TRACES)

    def write(codec: str) -> str:
        options = _write_options(spark, compression=codec)
        folder = options.table_dir("traces")
        configured_writer(rows, options, options.traces_table).parquet(folder)
        return folder

    # At the same time, so that what each write waits for and its last tasks leave no cores idle.
    with ThreadPoolExecutor(max_workers=len(CODECS)) as pool:
        folders = list(pool.map(write, CODECS))
    parts = []
    for codec, folder in zip(CODECS, folders, strict=True):
        ending = F.regexp_extract(F.col("_metadata.file_name"), r"((\.[a-z]+)?\.parquet)$", 1)
        parts.append(manifest.read_files(spark, folder, TRACES.schema).select(F.lit(codec).alias("codec"), ending.alias("ending"), "*"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query
def read_compat_nanos(spark, sf_dir):
    """Log files with 64-bit nanoseconds, and NULL where a flag is 0."""
    nanos = [
        (F.expr(f"unix_micros({name}) * 1000 + 7") if kind == "timestamptz"
         else F.nullif(F.col(name), F.lit(0)) if kind == "uint32" else F.col(name)).alias(name)
        for name, kind in LOGS.columns
    ]
    folder = new_scratch(spark, "nanos")
    _rows(spark, sf_dir, LOGS).select(*nanos).write.parquet(folder)
    return tables.read_compat(spark, folder, LOGS)


# --- scans of written tables -----------------------------------------------------------------------------------------


@query
def scan_parquet_glob(spark, sf_dir):
    options = _lake(spark, sf_dir, LOGS)
    logs = tables.scan_glob(spark, options.table_dir("logs"), LOGS, options.logs_table)
    return queries.recent_rows(logs, "timestamp", ["timestamp", "severity_text", "body"], "1 DAY", 100)


@query
def scan_catalog_table(spark, sf_dir):
    """All rows of the log table, found through the catalog, with the file each lies in."""
    options = _lake(spark, sf_dir, LOGS)
    files = commit.table_files(spark, options, LOGS)
    rows = manifest.scan_files(spark, files, LOGS, options.data_dir("logs"), keep=["file_order"])
    return rows.select("file_order", "timestamp", "trace_id", "severity_text", "body")


@query
def scan_as_of_snapshot(spark, sf_dir):
    """The log table when half of its files were committed."""
    options = _lake(spark, sf_dir, LOGS)
    half = catalog.read_state(commit.read_commits(spark, options)).snapshot_id // 2
    return commit.read_table(spark, options, LOGS, half).select("timestamp", "trace_id", "severity_text", "body")


@query
def prune_files_minmax(spark, sf_dir):
    """Spans of two days: files in all, files left by their bounds, and rows found in those."""
    options = _lake(spark, sf_dir, TRACES)
    files = commit.table_files(spark, options, TRACES)
    low, high = (START_MICROS + day * 86_400_000_000 for day in PRUNE_DAYS)
    kept = files.filter(manifest.may_hold("start_time", low, high - 1))
    rows = manifest.scan_files(spark, kept, TRACES, options.data_dir("traces")).filter(
        (F.col("start_time") >= F.timestamp_micros(F.lit(low))) & (F.col("start_time") < F.timestamp_micros(F.lit(high)))
    )
    return rows.agg(F.count(F.lit(1)).alias("rows_found"), F.sum("duration_ns").alias("duration_ns")).select(
        files.agg(F.count(F.lit(1))).scalar().alias("files_total"),
        kept.agg(F.count(F.lit(1))).scalar().alias("files_read"),
        "rows_found",
        "duration_ns",
    )


@query
def bloom_point_lookup(spark, sf_dir):
    """Per span file, whether it can be left out when looking for one trace.

    The equality filter reaches the Parquet reader, which skips row groups by their bloom filters.
    """
    options = _lake(spark, sf_dir, TRACES)
    files = commit.table_files(spark, options, TRACES)
    hits = (
        manifest.scan_files(spark, files, TRACES, options.data_dir("traces"), keep=["file_order"])
        .filter(F.col("trace_id") == TRACE_KEY)
        .groupBy("file_order")
        .agg(F.count(F.lit(1)).alias("key_rows"))
    )
    return files.join(hits, "file_order", "left").select(
        "file_order",
        "record_count",
        F.coalesce("key_rows", F.lit(0).cast("bigint")).alias("key_rows"),
        F.col("key_rows").isNull().alias("excludes"),
    )


@query
def bloom_rows_skipped(spark, sf_dir):
    """Rows that leave the scan for a trace that is in no file but within the bounds of all: with bloom filters hardly any
    (a filter may be wrong for one file in a hundred), without them all rows."""
    found = []
    for signal in (LOGS, TRACES):
        for filters in (True, False):
            options = _write_options(spark, enable_bloom_filters=filters)
            batches = _batches(spark, sf_dir, signal, options)
            folder = write_batches(batches, signal, options, commit_id="all", arrival="arrival")
            # Small files have dictionaries that tell the same; columns of many values have none.
            reader = spark.read.schema(signal.schema).option("parquet.filter.dictionary.enabled", "false")
            rows = reader.parquet(folder).filter(F.col("trace_id") == ABSENT_TRACE)
            left, matched = tables.rows_leaving_scan(rows.select("trace_id"))
            total = spark.read.schema(signal.schema).parquet(folder).count()
            found.append((signal.name, filters, matched, total, left * 2 < total))
    return spark.createDataFrame(found, "signal string, bloom_filters boolean, rows_found bigint, rows_total bigint, mostly_skipped boolean")


# --- manifest and catalog, all over written and committed files -----------------------------------------------------


def _folder_of(path: str = "path"):
    return F.regexp_replace(path, "[^/]+$", "")


def _sized(df: DataFrame, column: str = "file_size_bytes") -> DataFrame:
    """The size of a file depends on the machine that wrote it: only whether there is one is returned."""
    return df.withColumn("has_size", F.col(column) > 0).drop(column)


@query
def manifest_files(spark, sf_dir):
    _, files = _commits(spark, sf_dir)
    name = base_name(F.col("path"))
    return _sized(
        files.select(
            "table_name", "tick", "seq", "record_count", "commit_time", "file_size_bytes", _folder_of("path").rlike("/batch=all/tick=[0-9]+/$").alias("in_tick"),
            (name.startswith(F.concat("table_name", F.lit("_"))) & name.rlike(r"_[0-9]{8}_[0-9]{6}-[0-9]+-.*\.snappy\.parquet$")).alias("named"),
        )
    )


@query
def manifest_path_translation(spark, sf_dir):
    """The folders that readers are told, where they see the writer's folder under another path."""
    options = _lake(spark, sf_dir, data_path=DATA_PATH)
    return commit.read_commits(spark, options).select("table_name", "tick", "seq", _folder_of().alias("folder"))


@query
def catalog_bootstrap(spark, sf_dir):
    """The rows of a new catalog, which commits and a second bootstrap leave as they are."""
    options = _lake(spark, sf_dir)
    rows = commit.open_catalog(spark, options)
    own = F.col("value") == F.lit(options.data_path.rstrip("/") + "/")
    return rows.withColumn("value", F.when(own, "data path").otherwise(F.col("value")))


@query
def catalog_snapshots(spark, sf_dir):
    options, commits = _commits(spark, sf_dir)
    return catalog.snapshots(commits, commit.started_at(spark, options))


@query
def snapshot_changes(spark, sf_dir):
    options, commits = _commits(spark, sf_dir)
    return catalog.snapshot_changes(commits, commit.started_at(spark, options))


@query
def catalog_tables(spark, sf_dir):
    return catalog.tables(_commits(spark, sf_dir)[1])


@query
def catalog_schemas(spark, sf_dir):
    """The schema with the number of its tables and their records."""
    options, commits = _commits(spark, sf_dir)
    files = commits.join(F.broadcast(catalog.tables(commits).select("table_name", "schema_id")), "table_name")
    held = files.groupBy("schema_id").agg(
        F.count_distinct("table_name").alias("n_tables"), F.sum("record_count").alias("record_count")
    )
    return catalog.schemas(commit.started_at(spark, options)).join(held, "schema_id")


@query
def catalog_columns(spark, sf_dir):
    options, commits = _commits(spark, sf_dir)
    return catalog.columns(commits, options)


@query
def catalog_column_mapping(spark, sf_dir):
    return catalog.column_mapping(_commits(spark, sf_dir)[1])


@query
def catalog_name_mapping(spark, sf_dir):
    options, commits = _commits(spark, sf_dir)
    return catalog.name_mapping(commits, options)


@query
def catalog_data_files(spark, sf_dir):
    options, commits = _commits(spark, sf_dir)
    return _sized(catalog.data_files(commits, options)).withColumn("path", _folder_of())


@query
def file_column_stats(spark, sf_dir):
    options, commits = _commits(spark, sf_dir)
    return catalog.file_column_stats(commits, options)


@query
def table_stats(spark, sf_dir):
    return _sized(catalog.table_stats(_commits(spark, sf_dir)[1]))


@query
def table_stats_history(spark, sf_dir):
    return catalog.table_stats_history(_commits(spark, sf_dir)[1])


@query
def table_column_stats(spark, sf_dir):
    options, commits = _commits(spark, sf_dir)
    return catalog.table_column_stats(commits, options)


@query
def next_ids(spark, sf_dir):
    return catalog.next_ids(_commits(spark, sf_dir)[1])


@query
def catalog_absolute_paths(spark, sf_dir):
    """Per file, the rows found under the path that the catalog leads to."""
    options, commits = _commits(spark, sf_dir)
    leading = catalog.absolute_paths(commits, options, commit.started_at(spark, options))
    counts = []
    for signal in (LOGS, TRACES):
        rows = spark.read.schema(signal.schema).parquet(f"{options.data_dir(signal.name)}/batch=*/tick=*")
        found = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows_there"))
        counts.append(found.withColumn("path", translate_path(file_path(F.col("path")), options.output_path, options.data_path)))
    return leading.join(counts[0].unionByName(counts[1]), "path").select("data_file_id", "rows_there")


@query
def table_exists(spark, sf_dir):
    options, commits = _commits(spark, sf_dir)
    return catalog.table_exists(commits, commit.started_at(spark, options), ["otel_logs", "otel_traces", "otel_metrics"])


@query
def recent_snapshots(spark, sf_dir):
    options, commits = _commits(spark, sf_dir)
    return _sized(catalog.recent_snapshots(commits, options, commit.started_at(spark, options)), "total_size")


@query
def files_for_snapshot(spark, sf_dir):
    options, commits = _commits(spark, sf_dir)
    return _sized(catalog.files_for_snapshot(commits, options, 3)).withColumn("path", _folder_of())


@query
def snapshot_null_fields(spark, sf_dir):
    options, commits = _commits(spark, sf_dir)
    made = catalog.snapshots(commits, commit.started_at(spark, options))
    missing = F.lit(False)
    for name in made.columns:
        missing = missing | F.col(name).isNull()
    return made.agg(F.count(F.lit(1)).alias("n_snapshots"), F.count_if(missing).alias("n_with_nulls"))


@query
def total_records(spark, sf_dir):
    return _commits(spark, sf_dir)[1].agg(F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records"))


@query
def distinct_mappings(spark, sf_dir):
    options, commits = _commits(spark, sf_dir)
    return catalog.data_files(commits, options).groupBy("table_id").agg(
        F.count_distinct("mapping_id").alias("n_mappings"), F.min("mapping_id").alias("mapping_id")
    )


@query
def catalog_checks(spark, sf_dir):
    written = _events(spark, sf_dir).agg((F.count(F.lit(1)) * F.lit(2)).alias("rows_written"))
    return catalog.checks(_commits(spark, sf_dir)[1], written)


@query
def catalog_commit(spark, sf_dir):
    """Two commits one after the other, the second of them tried twice."""
    options = _write_options(spark)
    files = checkpointed(_both(spark, sf_dir, options))
    commit.commit_files(files.filter(F.col("tick") < SPLIT_TICK), options, "first")
    for _ in range(2):
        commit.commit_files(files.filter(F.col("tick") >= SPLIT_TICK), options, "second")
    return commit.read_commits(spark, options).select(
        "commit_id", "table_name", "tick", "seq", "snapshot_id", "data_file_id", "file_order", "record_count",
        "next_row_id", "schema_version", "next_catalog_id", "next_file_id", "first_column_id",
    )


# --- streams ---------------------------------------------------------------------------------------------------------


def _landing(spark: SparkSession, sf_dir: str, signal: Signal) -> str:
    """OTLP/JSON files as a collector would drop them."""
    folder = new_scratch(spark, "landing")
    lines = source.otlp_lines(_events(spark, sf_dir), signal)
    lines.write.option("maxRecordsPerFile", 25_000).json(folder)
    return folder


def _ingested(spark, sf_dir, signal: Signal, landing: str, options: LakeOptions) -> None:
    payloads = otlp_json.stream_otlp_json(spark, landing, signal, files_per_batch=4)
    stream = ingest.start_ingest(
        payloads, signal, options, checkpoint=new_scratch(spark, "progress"), drain=True
    )
    stream.awaitTermination()


def _streamed(spark: SparkSession, sf_dir: str, signal: Signal) -> DataFrame:
    options = LakeOptions(output_path=new_scratch(spark, "lake"))
    _ingested(spark, sf_dir, signal, _landing(spark, sf_dir, signal), options)
    return commit.read_table(spark, options, signal)


@query
def stream_ingest_logs(spark, sf_dir):
    return _streamed(spark, sf_dir, LOGS)


@query
def stream_ingest_traces(spark, sf_dir):
    return _streamed(spark, sf_dir, TRACES)


@query
def stream_commit_idempotent(spark, sf_dir):
    """A stream that loses its progress while a file arrives, and whose files come in other groups then, takes in the new
    file alone: every row once."""
    options = LakeOptions(output_path=new_scratch(spark, "lake"))
    landing = new_scratch(spark, "landing")
    lines = source.otlp_lines(_events(spark, sf_dir), LOGS, keep=["event_id"])

    def land(part: DataFrame, files: int) -> None:
        part.drop("event_id").repartition(files).write.mode("append").json(landing)

    def run(files_per_batch: int) -> int:
        payloads = otlp_json.stream_otlp_json(spark, landing, LOGS, files_per_batch)
        ingest.start_ingest(payloads, LOGS, options, checkpoint=new_scratch(spark, "progress"), drain=True).awaitTermination()
        return catalog.read_state(commit.read_commits(spark, options)).snapshot_id

    land(lines.filter("event_id % 10 <> 3"), 5)
    before = run(2)
    land(lines.filter("event_id % 10 = 3"), 1)
    added = run(3) - before
    rows = commit.read_table(spark, options, LOGS).groupBy("severity_text").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.select("severity_text", "n_rows", F.lit(added > 0).alias("snapshots_added"))


@query
def ingest_rejects(spark, sf_dir):
    """What becomes of a landing folder with truncated lines, unreadable times and NaN: records by outcome."""
    options = LakeOptions(output_path=new_scratch(spark, "lake"))
    landing = new_scratch(spark, "landing")
    lines = source.otlp_lines(_events(spark, sf_dir), LOGS, keep=["event_id"])
    whole = F.to_json(F.struct("resourceLogs"))
    unreadable = F.replace(whole, F.lit('"observedTimeUnixNano":"'), F.lit('"observedTimeUnixNano":"x'))
    not_a_number = F.replace(whole, F.lit('{"stringValue":"test"}'), F.lit('{"doubleValue":"NaN"}'))
    broken = (
        F.when(F.expr("event_id % 17 = 0"), F.substring(whole, 1, 200))
        .when(F.expr("event_id % 19 = 1"), unreadable)
        .when(F.expr("event_id % 23 = 2"), not_a_number)
        .otherwise(whole)
    )
    lines.select(broken.alias("value")).write.option("maxRecordsPerFile", 25_000).text(landing)
    _ingested(spark, sf_dir, LOGS, landing, options)
    lost = ingest.read_rejects(spark, options, LOGS).groupBy("reason").agg(F.count(F.lit(1)).alias("n_records"))
    kept = commit.read_table(spark, options, LOGS).agg(F.count(F.lit(1)).alias("n_records"))
    return lost.unionByName(kept.select(F.lit("stored").alias("reason"), "n_records"))
