"""Queries that answer from all rows of their tables, and the steps they share."""

import glob
import hashlib
import json
import threading

import pyarrow.parquet as pq
import pytest

from spanloom.operators import stats
from spanloom.operators.batching import assign_file_batches
from spanloom.options import LakeOptions
from spanloom.plans import registry
from spanloom.schemas import LOGS
from spanloom.sources import otlp_json
from spanloom.streaming import ingest


@pytest.fixture()
def events_dir(spark, tmp_path):
    """Fifteen events without the one that is the root of the third trace; an error is a root, another a child."""
    events = spark.sql("""SELECT id AS event_id, timestamp_micros(1704067200000000 + id) AS ts, id AS user_id,
        CASE WHEN id IN (5, 12) THEN 'error' ELSE 'click' END AS event_type, 1D AS value, '{"k": 1}' AS props
        FROM range(15) WHERE id <> 10""")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_orphan_spans_query_takes_all_spans(spark, events_dir):
    """An error is a parent like any other, and an error without a parent an orphan."""
    found = registry.QUERIES["orphan_spans"](spark, events_dir).collect()
    assert sorted(r.name for r in found) == ["click", "click", "click", "error"]
    assert {r.parent_span_id for r in found} == {hashlib.md5(b"10").hexdigest()[:16]}


def test_describe_tables_counts_the_values_in_the_files(spark, events_dir):
    rows = registry.QUERIES["describe_tables"](spark, events_dir).collect()
    counts = {(r.table_name, r.column_name): r.value_count for r in rows}
    assert counts["otel_logs", "timestamp"] == counts["otel_traces", "span_id"] == 14
    # A fifth of the logs have no trace (4, 9, 14), root spans no parent (0, 5).
    assert counts["otel_logs", "trace_id"] == 11 and counts["otel_traces", "parent_span_id"] == 12
    assert counts["otel_traces", "trace_state"] == 0


def _log_line(i, time=None):
    record = {"timeUnixNano": time or str(1_704_067_200_000_000_000 + i * 1000), "body": {"stringValue": f"b{i}"}}
    return json.dumps({"resourceLogs": [{"scopeLogs": [{"logRecords": [record]}]}]})


def test_a_micro_batch_of_lines_is_cut_in_order(spark, tmp_path):
    """Rejected records and broken lines take no place in a file; rows stay in the order of their files and lines."""
    n, bad, broken = 100, {3, 4, 57}, {10, 60}
    for part in range(4):
        with open(f"{tmp_path}/in-{part}.json", "w") as out:
            for i in range(part * 25, part * 25 + 25):
                line = _log_line(i, "soon" if i in bad else None)
                out.write((line[:40] if i in broken else line) + "\n")
    options = LakeOptions(output_path=f"{tmp_path}/lake", batch_size=10)
    lines = otlp_json._lines(spark.read, sorted(glob.glob(f"{tmp_path}/in-*.json"))).repartition(3).sortWithinPartitions("value")
    arrival = [json.loads(r.value)["resourceLogs"][0]["scopeLogs"][0]["logRecords"][0]["body"]["stringValue"]
               for r in lines.collect() if len(r.value) > 40 and '"soon"' not in r.value]
    counts = ingest.ingest_batch(lines, 7, signal=LOGS, options=options, stream="logs", checkpoint="c")
    assert (counts["rows"], counts["rejected"], counts["malformed"]) == (n - len(broken), len(bad), len(broken))
    files = sorted(glob.glob(f"{tmp_path}/lake/main/otel_logs/*/tick=7/*.parquet"))
    kept = [pq.read_table(f, columns=["body"], partitioning=None)["body"].to_pylist() for f in files]
    assert sorted(map(len, kept)) == [5] + [10] * 9
    assert sorted(map(tuple, kept)) == sorted(tuple(arrival[i:i + 10]) for i in range(0, len(arrival), 10))


def test_a_stream_leaves_decoding_to_its_batches(spark, tmp_path):
    """What a stream has decoded would be decoded again for each look at a batch, also for its file names alone."""
    (tmp_path / "a.json").write_text(_log_line(1))
    stream = otlp_json.stream_otlp_json(spark, str(tmp_path), LOGS)
    assert stream.isStreaming and "from_json" not in stream._jdf.queryExecution().analyzed().toString()


def test_rows_are_not_shuffled_for_their_file_cuts(spark, tmp_path):
    """The cuts are small although Spark takes the rows that they are worked out from for too large to be broadcast."""
    rows = spark.sql("SELECT id AS arrival, timestamp_micros(1704067200000000 + id) AS ts, uuid() AS text FROM range(20000)")
    rows.coalesce(1).write.parquet(f"{tmp_path}/rows")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50000")
        cut = assign_file_batches(spark.read.parquet(f"{tmp_path}/rows"), time="ts", arrival="arrival", batch_size=1000,
                                  timeout_seconds=60, start_micros=1_704_067_200_000_000)
        assert "BroadcastHashJoin" in cut._jdf.queryExecution().executedPlan().toString()
        found = cut.select("arrival", "tick", "seq").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted((r.arrival, r.tick, r.seq) for r in found) == [(i, 0, i // 1000) for i in range(20000)]


def test_statistics_read_a_service_name_once_per_resource(spark):
    """Not in the aggregation, which sees every row; empty text is the least only where there is nothing else."""
    resources = ['{"service.name":"b"}', '{"service.name":"a","x":1}', '{"service.name":"a"}', "{}", None, ""]
    texts = ["", "m", None, "z", "", "m"]
    rows = spark.createDataFrame([(1, r, t) for r, t in zip(resources, texts)] * 50 + [(2, None, "")], "f int, resource_attributes string, body string")
    others = [c for c in LOGS.schema if c.name not in rows.columns]
    files = stats.file_stats(rows.selectExpr("*", *[f"CAST(NULL AS {c.dataType.simpleString()}) AS {c.name}" for c in others]), LOGS, ["f"])
    plan = files._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set(resource_attributes" in plan and "collect_set(get_json_object" not in plan
    one, two = sorted(files.collect(), key=lambda r: r.f)
    assert (one.services, two.services) == (["a", "b"], [])
    body = {r.f: next(c for c in r.column_stats if c.column_name == "body") for r in (one, two)}
    assert [body[1][k] for k in ("column_size_bytes", "value_count", "null_count", "min_value", "max_value")] == [150, 300, 150, "m", "z"]
    assert [body[2][k] for k in ("column_size_bytes", "value_count", "null_count", "min_value", "max_value")] == [0, 1, 1, "", ""]
    resource = next(c for c in one.column_stats if c.column_name == "resource_attributes")
    flags = next(c for c in one.column_stats if c.column_name == "flags")
    assert (resource.null_count, flags.null_count, flags.min_value, flags.column_size_bytes) == (150, 300, "", 0)


def test_codecs_are_written_at_the_same_time(spark, events_dir, monkeypatch):
    """Each write waits until all have begun."""
    all_begun = threading.Barrier(4, timeout=30)
    writer = registry.configured_writer

    def begun(*args):
        all_begun.wait()
        return writer(*args)

    monkeypatch.setattr(registry, "configured_writer", begun)
    found = registry.QUERIES["write_codecs"](spark, events_dir).groupBy("codec", "ending").count().collect()
    assert sorted((r.codec, r.ending, r["count"]) for r in found) == [
        ("GZIP", ".gz.parquet", 14), ("SNAPPY", ".snappy.parquet", 14), ("UNCOMPRESSED", ".parquet", 14), ("ZSTD", ".zstd.parquet", 14)]
