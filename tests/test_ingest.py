"""Flattening, OTLP/JSON, file cuts, statistics, catalog and streams on small fixtures."""

import hashlib
import json
import os
import random
import time
from collections import defaultdict
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from spanloom.operators.batching import assign_file_batches
from spanloom.operators.flatten import encodable_rows, flatten, rejected_rows
from spanloom.operators.numbering import running_totals
from spanloom.operators.sink import write_batches
from spanloom.operators.stats import file_stats
from spanloom.options import LakeOptions, OptionsError
from spanloom.plans import catalog, commit, manifest, queries
from spanloom.schemas import COLUMN_STATS, LOGS, TRACES, TYPED_BOUNDS
from spanloom.session import new_scratch, shared_dir
from spanloom.sources import otlp_json, tables
from spanloom.sources.events import EVENTS_SCHEMA, log_rows, span_rows
from spanloom.streaming import ingest

BASE = 1_704_067_200_000_000_000


def landing(tmp_path, name, payloads):
    folder = tmp_path / name
    folder.mkdir()
    for i, lines in enumerate(payloads):
        (folder / f"p{i}.json").write_text("\n".join(json.dumps(p) for p in lines) + "\n")
    return str(folder)


def any_value(v):
    if isinstance(v, bool):
        return {"boolValue": v}
    if isinstance(v, int):
        return {"intValue": str(v)}
    if isinstance(v, float):
        return {"doubleValue": v}
    if isinstance(v, str):
        return {"stringValue": v}
    if isinstance(v, list):
        return {"arrayValue": {"values": [any_value(x) for x in v]}}
    if isinstance(v, dict):
        return {"kvlistValue": {"values": pairs(v)}}
    return {}


def pairs(d):
    return [{"key": k, "value": any_value(v)} for k, v in d.items()]


def hex_id(kind, i, digits):
    """Some id that is not all zero."""
    return hashlib.md5(f"{kind}{i}".encode()).hexdigest()[:digits]


def log_record(i):
    """A record of a shop: one in three is a complaint, those of gold customers are traced, even ones are marked."""
    complaint = i % 3 == 2
    record = {
        "timeUnixNano": BASE + i * 250_000_000,
        "observedTimeUnixNano": str(BASE + i * 250_000_000 + 40),
        "severityNumber": "SEVERITY_NUMBER_ERROR" if complaint else 9,
        "severityText": "Error" if complaint else "Info",
        "body": any_value(f"parcel {i} was {'lost' if complaint else 'sent'}"),
        "attributes": pairs({"parcel": i, "gold": i % 4 == 1, "grams": i * 0.5, "town": f"T{i % 6}"}),
    }
    if i % 4 == 1:
        record |= {"traceId": hex_id("trace", i, 32).upper(), "spanId": hex_id("span", i, 16)}
    if i % 2 == 0:
        record["flags"] = "1"
    return record


def logs_payload(records, resource=None, scope=None):
    resource = {"service.name": "parcels", "rack": 7} if resource is None else resource
    return {
        "resourceLogs": [
            {
                "resource": {"attributes": pairs(resource)},
                "scopeLogs": [{"scope": scope or {"name": "desk", "version": "2"}, "logRecords": records}],
            }
        ]
    }


def test_log_records(spark, tmp_path):
    folder = landing(tmp_path, "in", [[logs_payload([log_record(i) for i in range(60)])]])
    rows = flatten(otlp_json.read_otlp_json(spark, folder, LOGS), LOGS).orderBy("record_pos").collect()
    assert [r.record_pos for r in rows] == list(range(60))
    for i, r in enumerate(rows):
        traced = i % 4 == 1
        assert (r.trace_id, r.span_id) == ((hex_id("trace", i, 32), hex_id("span", i, 16)) if traced else (None, None))
        assert (r.severity_number, r.severity_text) == ((17, "Error") if i % 3 == 2 else (9, "Info"))
        assert r.body == f"parcel {i} was {'lost' if i % 3 == 2 else 'sent'}"
        grams = str(i // 2) if i % 2 == 0 else f"{i // 2}.5"
        assert r.log_attributes == f'{{"gold":{str(traced).lower()},"grams":{grams},"parcel":{i},"town":"T{i % 6}"}}'
        assert r.flags == (i % 2 == 0) and r.encodable and r.reason is None
        assert r.timestamp == r.observed_timestamp == datetime(2024, 1, 1) + timedelta(microseconds=250_000 * i)
    assert {(r.resource_attributes, r.scope_name, r.scope_version) for r in rows} == {('{"rack":7,"service.name":"parcels"}', "desk", "2")}


def test_empty_levels_and_positions(spark, tmp_path):
    payload = {
        "resourceLogs": [
            {"resource": {}, "scopeLogs": []},
            {"resource": {"attributes": pairs({"r": 1})}},
            {
                "scopeLogs": [
                    {"logRecords": []},
                    {"scope": {"name": ""}, "logRecords": [{"body": any_value("a")}, {}]},
                ]
            },
        ]
    }
    folder = landing(tmp_path, "in", [[payload, {"resourceLogs": []}, {}]])
    rows = flatten(otlp_json.read_otlp_json(spark, folder, LOGS), LOGS).collect()
    assert sorted((r.resource_pos, r.scope_pos, r.record_pos, r.body) for r in rows) == [(2, 1, 0, "a"), (2, 1, 1, "")]
    row = rows[0]
    assert (row.resource_attributes, row.log_attributes, row.scope_name) == ("{}", "{}", None)
    assert row.timestamp == datetime(1970, 1, 1) and row.severity_number == 0 and row.encodable


def test_nested_values_and_rejects(spark, tmp_path):
    deep = {"list": [1, "two", [3.5, {"k": [True, None]}]], "map": {"z": 1, "a": {}}, "none": []}
    records = [
        {"attributes": pairs(deep)},
        {"attributes": [{"key": "x", "value": {"doubleValue": "NaN"}}]},
        {"attributes": pairs({"x": "NaN"})},
        {"attributes": [{"key": "x", "value": {"bytesValue": "AP8="}}], "body": any_value(deep)},
    ]
    folder = landing(tmp_path, "in", [[logs_payload(records)]])
    rows = flatten(otlp_json.read_otlp_json(spark, folder, LOGS), LOGS)
    kept = encodable_rows(rows).orderBy("record_pos").collect()
    assert [r.record_pos for r in kept] == [0, 2, 3]
    assert [r.record_pos for r in rejected_rows(rows).collect()] == [1]
    text = '{"list":[1,"two",[3.5,{"k":[true,null]}]],"map":{"a":{},"z":1},"none":[]}'
    assert kept[0].log_attributes == text
    assert kept[1].log_attributes == '{"x":"NaN"}'
    assert kept[2].log_attributes == '{"x":"AP8="}' and kept[2].body == text


def test_span_records(spark, tmp_path):
    kinds = [("SPAN_KIND_CONSUMER", 5), (4, 4), ("SPAN_KIND_CLIENT", 3), ("2", 2), (None, 0)]

    def span(i):
        start = BASE + i * 3_000_000_000
        s = {
            "traceId": "0" * 32 if i == 0 else hex_id("trace", i // 10, 32),
            "spanId": hex_id("span", i, 16),
            "parentSpanId": hex_id("span", i - 1, 16) if i % 10 else "",
            "name": f"stop {i}",
            "startTimeUnixNano": start,
            "endTimeUnixNano": str(start + 7 * i),
            "status": [{}, {"code": "STATUS_CODE_OK"}, {"code": 2, "message": "late"}][i % 3],
            "attributes": pairs({"km": [i, i + 0.25]}),
            "traceState": "a=b" if i % 2 else "",
        }
        if kinds[i % 5][0] is not None:
            s["kind"] = kinds[i % 5][0]
        if i % 6 == 1:
            s["events"] = [{"timeUnixNano": start + 1999, "name": "stuck", "attributes": pairs({"min": i})}, {"name": ""}]
        if i % 6 == 2:
            s["links"] = [{"traceId": "ab" * 16, "spanId": "cd" * 8, "flags": 2, "attributes": pairs({"why": "turn"})}]
        return s

    payload = {"resourceSpans": [{"resource": {}, "scopeSpans": [{"spans": [span(i) for i in range(40)]}]}]}
    folder = landing(tmp_path, "in", [[payload]])
    rows = encodable_rows(flatten(otlp_json.read_otlp_json(spark, folder, TRACES), TRACES)).orderBy("record_pos").collect()
    assert len(rows) == 40 and rows[0].trace_id is None
    for i, r in enumerate(rows):
        assert i == 0 or r.trace_id == hex_id("trace", i // 10, 32)
        assert r.parent_span_id == (hex_id("span", i - 1, 16) if i % 10 else None)
        assert (r.kind, r.duration_ns, r.name) == (kinds[i % 5][1], 7 * i, f"stop {i}")
        assert (r.status_code, r.status_message) == [(0, None), (1, None), (2, "late")][i % 3]
        assert r.span_attributes == f'{{"km":[{i},{i}.25]}}' and r.trace_state == ("a=b" if i % 2 else None)
        at = (datetime(2024, 1, 1) + timedelta(seconds=3 * i)).strftime("%Y-%m-%d %H:%M:%S.000001+00")
        stuck = f'[{{"timestamp":"{at}","name":"stuck","attributes":{{"min":{i}}}}},{{"timestamp":"1970-01-01 00:00:00.000000+00","name":""}}]'
        assert r.events == (stuck if i % 6 == 1 else "[]")
        link = '[{"trace_id":"' + "ab" * 16 + '","span_id":"' + "cd" * 8 + '","attributes":{"why":"turn"},"flags":2}]'
        assert r.links == (link if i % 6 == 2 else "[]")


def test_rejects_name_what_is_wrong(spark, tmp_path):
    """Broken lines and records with numbers or ids that cannot be read are told apart; the rest is stored."""
    records = [
        log_record(0) | {"flags": "abc"},
        log_record(1),
        log_record(1) | {"traceId": "xyz", "timeUnixNano": "soon"},
        log_record(2) | {"attributes": [{"key": "x", "value": {"arrayValue": {"values": [{"doubleValue": "NaN"}]}}}]},
        log_record(3) | {"severityNumber": "LOUD"},
        log_record(4) | {"flags": None, "spanId": ""},
    ]
    options = LakeOptions(output_path=str(tmp_path / "lake"))
    folder = tmp_path / "in"
    folder.mkdir()
    good = json.dumps(logs_payload(records))
    broken = [good[: len(good) // 2], "[1, 2]", "no JSON", '{"resourceLogs": 5}']
    (folder / "p.json").write_text("\n".join([good, *broken, "", "  ", "{}"]) + "\n")
    run_stream(spark, str(folder), options, new_scratch(spark, "progress"))
    assert {r.body for r in commit.read_table(spark, options, LOGS).collect()} == {"parcel 1 was sent", "parcel 4 was sent"}
    found = ingest.read_rejects(spark, options, LOGS).collect()
    assert sorted((r.record_pos, r.reason) for r in found if r.line is None) == [
        (0, "unreadable flags"), (2, "unreadable timeUnixNano,traceId"), (3, "no JSON for NaN or infinity"), (4, "unreadable severityNumber"),
    ]
    assert sorted(r.line for r in found if r.line is not None) == sorted(broken)
    assert {r.source_file.endswith("/p.json") for r in found} == {True}
    spans = [{"name": "a", "events": [{"timeUnixNano": "never"}]}, {"name": "b", "links": [{"spanId": "q"}], "status": {"code": "X"}}, {"name": "c"}]
    rows = flatten(otlp_json.read_otlp_json(spark, landing(tmp_path, "spans", [[{"resourceSpans": [{"scopeSpans": [{"spans": spans}]}]}]]), TRACES), TRACES)
    assert {r.name: r.reason for r in rows.collect()} == {"a": "unreadable timeUnixNano", "b": "unreadable code,spanId", "c": None}


@pytest.mark.parametrize("depth", [7, 12, 40])
def test_deep_values_from_lines(spark, tmp_path, depth):
    def nested(leaf):
        for i in range(depth):
            leaf = {"k": leaf, "z": [i]} if i % 2 else [leaf, i]
        return leaf

    records = [{"body": any_value(nested("leaf")), "attributes": pairs({"a": nested(1e-7), "b": nested(True)})},
               {"attributes": pairs({"a": nested("LEAF")})}]
    folder = landing(tmp_path, "in", [[logs_payload(records)]])
    text = (tmp_path / "in" / "p0.json").read_text().replace('{"stringValue": "LEAF"}', '{"doubleValue": "NaN"}')
    (tmp_path / "in" / "p0.json").write_text(text)
    good, bad = flatten(otlp_json.read_otlp_json(spark, folder, LOGS), LOGS).orderBy("record_pos").collect()
    printed = {leaf: json.dumps(nested(leaf), separators=(",", ":")) for leaf in ("leaf", "TINY", True)}
    assert good.body == printed["leaf"] and good.encodable
    assert good.log_attributes == '{"a":' + printed["TINY"].replace('"TINY"', "1e-7") + ',"b":' + printed[True] + "}"
    assert not bad.encodable and bad.reason == "no JSON for NaN or infinity"


def test_running_totals_brute_force(spark):
    rng = random.Random(7)
    rows = [(rng.choice("ab"), i, rng.randint(0, 9)) for i in rng.sample(range(100_000), 3000)]
    df = spark.createDataFrame(rows, "g string, i long, v long").selectExpr("*", "i div 4096 AS _u", "i div 64 AS _b")
    got = running_totals(df, order=["i"], block=["_b"], upper=["_u"], totals={"n": "1", "s": "v"}, within=["g"])
    want, seen = set(), defaultdict(lambda: [0, 0])
    for g, i, v in sorted(rows, key=lambda r: r[1]):
        seen[g][0] += 1
        seen[g][1] += v
        want.add((g, i, seen[g][0], seen[g][1]))
    assert got.columns == ["g", "i", "v", "n", "s"]
    assert {(r.g, r.i, r.n, r.s) for r in got.collect()} == want


def events_at(spark, seconds):
    rows = [(i, datetime(2024, 1, 1) + timedelta(seconds=s), 1, "view", 1.0, '{"k": 1}') for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, EVENTS_SCHEMA)


def test_batch_cuts(spark):
    """Ticks with 0, 3, 4 and 7 rows give 0, 1, 2 and 3 files of at most 3 rows."""
    seconds = [10] * 3 + [20] * 4 + [30] * 7
    batches = assign_file_batches(
        log_rows(events_at(spark, seconds)), time="timestamp", arrival="arrival", batch_size=3, timeout_seconds=10,
        start_micros=BASE // 1000,
    )
    files = batches.groupBy("tick", "seq").count().collect()
    assert sorted((r.tick, r.seq, r["count"]) for r in files) == [
        (1, 0, 3), (2, 0, 3), (2, 1, 1), (3, 0, 3), (3, 1, 3), (3, 2, 1)
    ]


def test_times_before_start_and_missing(spark):
    df = events_at(spark, [-1, 0, 1]).withColumn("ts", F.when(F.col("event_id") != 1, F.col("ts")))
    batches = assign_file_batches(
        log_rows(df), time="timestamp", arrival="arrival", batch_size=3, timeout_seconds=10, start_micros=BASE // 1000
    )
    assert sorted(r.tick for r in batches.collect()) == [-1, -1, 0]


def test_hot_tick_is_written_as_full_files(spark, tmp_path):
    """One tick with most rows: spread over tasks, and still every file but a tick's last is full."""
    options = LakeOptions(output_path=str(tmp_path / "lake"), batch_size=20)
    seconds = [0] * 900 + list(range(10, 200))
    batches = assign_file_batches(
        log_rows(events_at(spark, seconds)), time="timestamp", arrival="arrival", batch_size=20, timeout_seconds=60,
        start_micros=BASE // 1000,
    )
    folder = write_batches(batches, LOGS, options, commit_id="c1", arrival="arrival")
    files = manifest.written_manifest(spark, folder, LOGS, "otel_logs").collect()
    per_tick = defaultdict(list)
    for f in files:
        per_tick[f.tick].append(f.record_count)
        assert f.path.split("/")[-1].startswith("otel_logs_") and f.file_size_bytes > 0
    expected = defaultdict(int)
    for s in seconds:
        expected[s // 60] += 1
    for tick, rows in expected.items():
        assert sorted(per_tick[tick], reverse=True) == [20] * (rows // 20) + ([rows % 20] if rows % 20 else [])


def stats_of(spark, rows, schema="severity_number int, body string, log_attributes string"):
    base = {f.name: F.lit(None).cast(f.dataType) for f in LOGS.schema}
    df = spark.createDataFrame(rows, schema)
    df = df.select(*[(F.col(n) if n in df.columns else base[n]).alias(n) for n in LOGS.column_names], F.lit(1).alias("f"))
    row = file_stats(df, LOGS, ["f"]).first()
    return {s.column_name: s for s in row.column_stats}, {b.column_name: b for b in row.typed_bounds}


def test_statistics_rules(spark):
    stats, typed = stats_of(spark, [(9, "", "{}"), (13, "é<", "[]"), (17, None, "")])
    s = stats["severity_number"]
    assert (s.min_value, s.max_value, s.column_size_bytes, s.value_count) == ("13", "9", 5, 3)
    assert (typed["severity_number"].min_value, typed["severity_number"].max_value) == (9, 17)
    body = stats["body"]
    assert (body.min_value, body.max_value, body.null_count, body.column_size_bytes) == ("é<", "é<", 2, 3)
    attributes = stats["log_attributes"]
    assert (attributes.min_value, attributes.max_value, attributes.null_count) == ("", "", 2)
    assert attributes.column_size_bytes == 4
    scope = stats["scope_name"]
    assert (scope.null_count, scope.min_value, scope.max_value) == (3, "", "")


def test_options():
    good = LakeOptions(output_path="/tmp/x", batch_size=100, batch_timeout_seconds=1).validate()
    assert good.data_path == "/tmp/x" and good.compression == "SNAPPY" and good.enable_bloom_filters
    assert (good.logs_table, good.traces_table) == ("otel_logs", "otel_traces")
    assert LakeOptions(output_path="s3a://b/p", data_path="/else").data_path == "s3a://b/p"
    assert LakeOptions(output_path="/in", data_path="/out").data_path == "/out"
    for codec in ("SNAPPY", "GZIP", "ZSTD", "UNCOMPRESSED"):
        LakeOptions(output_path="/tmp/x", compression=codec).validate()
    bad = LakeOptions(output_path="", batch_size=0, batch_timeout_seconds=0, compression="LZ9", logs_table="t", traces_table="t")
    with pytest.raises(OptionsError) as e:
        bad.validate()
    assert len(str(e.value).splitlines()) == 5
    assert LakeOptions(output_path=__file__).problems() == [f"output_path names a file, not a folder: {__file__}"]
    assert LakeOptions(output_path="s3a:///p").problems() == ["output_path has no bucket or host: s3a:///p"]


def test_settings():
    settings = {
        "catalog": {"host": "localhost", "port": 5432},
        "parquet": {"batch_size": 100, "batch_timeout": "1m30s", "compression": "ZSTD", "enable_bloom_filters": False},
        "lake": {"output_path": "/tmp/x", "logs_table_name": "test_logs", "traces_table_name": "test_traces"},
    }
    options = LakeOptions.from_settings(settings).validate()
    assert options == LakeOptions("/tmp/x", "", 100, 90.0, "ZSTD", False, "test_logs", "test_traces")
    assert LakeOptions.from_settings({}).problems() == ["no output_path given"]
    assert LakeOptions.from_settings({"batch_timeout": "250ms", "output_path": "/x"}).batch_timeout_seconds == 0.25
    with pytest.raises(OptionsError):
        LakeOptions.from_settings({"batch_timeout": "soon"})


def test_compat_reader_on_nanosecond_files(spark, tmp_path):
    """Files of another writer: annotated nanosecond timestamps, zero flags left out."""
    n = 3
    table = pa.table(
        {
            "timestamp": pa.array([BASE + i * 10**9 + 1999 for i in range(n)], pa.timestamp("ns", "UTC")),
            "trace_id": pa.array([None, "a", "b"]),
            "span_id": pa.array([None, None, "c"]),
            "severity_number": pa.array([9, 13, 17], pa.int32()),
            "severity_text": pa.array(["Info"] * n),
            "body": pa.array(["x"] * n),
            "scope_name": pa.array([None] * n, pa.string()),
            "scope_version": pa.array([None] * n, pa.string()),
            "resource_attributes": pa.array(["{}"] * n),
            "log_attributes": pa.array(["{}"] * n),
            "flags": pa.array([None, 1, 4294967295], pa.uint32()),
            "observed_timestamp": pa.array([0] * n, pa.timestamp("ns", "UTC")),
        }
    )
    pq.write_table(table, tmp_path / "f.parquet")
    rows = tables.read_compat(spark, str(tmp_path), LOGS).orderBy("timestamp").collect()
    assert rows[0].timestamp == datetime(2024, 1, 1, 0, 0, 0, 1)
    assert [r.flags for r in rows] == [0, 1, 4294967295]
    assert rows[0].observed_timestamp == datetime(1970, 1, 1)


def test_bloom_filters_and_names_in_files(spark, tmp_path):
    options = LakeOptions(output_path=str(tmp_path / "lake"))
    rows = assign_file_batches(
        log_rows(events_at(spark, range(50))), time="timestamp", arrival="arrival", batch_size=1000, timeout_seconds=60,
        start_micros=BASE // 1000,
    )
    folder = write_batches(rows, LOGS, options, commit_id="c1", arrival="arrival", written_at=datetime(2024, 1, 2, 3, 4, 5))
    found = tables.scan_glob(spark, str(tmp_path), LOGS, "otel_logs")
    assert found.count() == 50
    (path,) = [f.replace("file:", "") for f in found.inputFiles()]
    path = path.replace("//", "/")
    assert "/main/otel_logs/batch=c1/tick=0/otel_logs_20240102_030405-" in path
    meta = pq.ParquetFile(path).metadata.row_group(0)
    encodings = {meta.column(i).path_in_schema: meta.column(i).encodings for i in range(meta.num_columns)}
    assert not any("DICTIONARY" in e for e in encodings["trace_id"])
    assert any("DICTIONARY" in e for e in encodings["severity_text"])
    import duckdb

    con = duckdb.connect()
    probe = "SELECT bloom_filter_excludes FROM parquet_bloom_probe(?, 'trace_id', ?)"
    present = spark.read.parquet(folder).filter("trace_id IS NOT NULL").first().trace_id
    assert con.execute(probe, [path, present]).fetchall() == [(False,)]
    assert con.execute(probe, [path, "0" * 32]).fetchall() == [(True,)]


def run_stream(spark, folder, options, checkpoint, signal=LOGS, **kw):
    payloads = otlp_json.stream_otlp_json(spark, folder, signal, files_per_batch=1)
    ingest.start_ingest(payloads, signal, options, checkpoint=checkpoint, drain=True, **kw).awaitTermination()


def test_stream_commits_restarts_and_replays(spark, tmp_path):
    """Three flushes of 30 records, a restart with more data, a replay, and a second table in the same catalog."""
    options = LakeOptions(output_path=str(tmp_path / "lake"), batch_size=100)
    flushes = [[logs_payload([log_record(30 * k + i) for i in range(30)])] for k in range(3)]
    folder = landing(tmp_path, "in", flushes)
    progress = new_scratch(spark, "progress")
    run_stream(spark, folder, options, progress)
    commits = commit.read_commits(spark, options)
    assert commits.agg(F.sum("record_count")).first()[0] == 90
    assert commits.count() >= 3
    started = spark.sql("SELECT timestamp'2024-01-01' AS started")
    assert catalog.snapshots(commits, started).count() >= 4

    run_stream(spark, folder, options, progress)  # nothing new
    assert commit.read_commits(spark, options).count() == commits.count()
    (tmp_path / "in" / "more.json").write_text(json.dumps(logs_payload([log_record(i) for i in range(90, 100)])) + "\n")
    run_stream(spark, folder, options, progress)
    bad = {"attributes": [{"key": "x", "value": {"doubleValue": "Infinity"}}]}
    (tmp_path / "in" / "bad.json").write_text(json.dumps(logs_payload([bad])) + "\n")
    run_stream(spark, folder, options, progress)  # a batch with rejected rows only makes no file
    commit._STATES.clear()  # as after a restart of the application
    spans = {"resourceSpans": [{"scopeSpans": [{"spans": [{"traceId": "ab" * 16, "spanId": "cd" * 8, "name": "s"}]}]}]}
    run_stream(spark, landing(tmp_path, "spans", [[spans]]), options, new_scratch(spark, "progress"), TRACES)
    run_stream(spark, folder, options, new_scratch(spark, "progress"))  # lost progress: every batch again

    commits = commit.read_commits(spark, options)
    rows = commit.read_table(spark, options, LOGS)
    assert rows.count() == 100 and rows.select("body").distinct().count() == 100
    assert commit.read_table(spark, options, TRACES).count() == 1
    n = commits.count()
    assert sorted(r.snapshot_id for r in commits.collect()) == list(range(1, n + 1))
    files = catalog.data_files(commits, options)
    mappings = {(r.table_id, r.mapping_id) for r in files.collect()}
    assert mappings == {(1, 1), (2, 2)}
    assert catalog.columns(commits, options).agg(F.max("column_id")).first()[0] == 33
    assert {r.ok for r in catalog.checks(commits, spark.range(101).agg(F.count("*"))).collect()} == {True}
    first = commits.filter("snapshot_id = 1").first()
    assert commit.read_table(spark, options, LOGS, snapshot_id=1).count() == first.record_count


@pytest.mark.parametrize("seq_block", [1, 64, 60_000_000])
def test_numbering_brute_force(spark, seq_block):
    rng = random.Random(3)
    rows = [(rng.choice(["otel_logs", "otel_traces"]), t, s, f"p{t}-{s}", rng.randint(1, 9))
            for t in [-1, *rng.sample(range(20_000), 40)] for s in range(rng.choice([1, 2, 300]))]
    files = spark.createDataFrame(rows, "table_name string, tick long, seq long, path string, record_count long")
    options, state = LakeOptions(output_path="/x"), catalog.CatalogState({"otel_logs": 5}, {"otel_logs": 50})
    got = {r.path: r for r in catalog.number_commits(files, options, state, seq_block).collect()}
    n, order, records = 5, {"otel_logs": 5, "otel_traces": 0}, {"otel_logs": 50, "otel_traces": 0}
    for table, _, _, path, count in sorted(rows, key=lambda r: (r[1], r[2], r[0], r[3])):
        n, records[table] = n + 1, records[table] + count
        r = got[path]
        assert (r.snapshot_id, r.data_file_id, r.file_order, r.next_row_id) == (n, n - 1, order[table], records[table])
        assert r.schema_version == (1 if not order["otel_traces"] and table == "otel_logs" else 2)
        order[table] += 1
    plan = catalog.number_commits(files, options, state, seq_block)._jdf.queryExecution().optimizedPlan().toString()
    assert all("record_count" not in line for line in plan.splitlines() if "Window [" in line and ", [], [" in line)


def test_log_of_commits_is_folded(spark, tmp_path, monkeypatch):
    """Readers name a bounded number of paths; a fold that breaks off, or is found by another process, changes nothing."""
    monkeypatch.setattr(commit, "FOLD_EVERY", 3)
    options = LakeOptions(output_path=str(tmp_path / "lake"))
    for i in range(8):
        files = [("otel_logs", i, i, f"{tmp_path}/lake/main/otel_logs/batch=b{i}/tick={i}/f", 10, 1, datetime(2024, 1, 1), [], [], [])]
        manifest_rows = spark.createDataFrame(files, manifest_schema())
        for _ in range(2):
            commit.commit_files(manifest_rows, options, f"b{i}")
        if i == 4:
            (tmp_path / "lake/_catalog/folds/fold=00000002").mkdir()  # broken off: no _SUCCESS
            (tmp_path / "lake/_catalog/folds/fold=00000002/part-x.parquet").write_text("half")
        if i == 6:
            commit._STATES.clear()
    got = commit.read_commits(spark, options)
    assert sorted((r.commit_id, r.snapshot_id, r.next_row_id) for r in got.collect()) == [(f"b{i}", i + 1, 10 * i + 10) for i in range(8)]
    segment = commit._segment(spark, options)
    assert segment == 2 and len(commit._finished(spark, options, segment)) <= 3
    assert all(commit.is_committed(spark, options, f"b{i}") for i in range(8)) and not commit.is_committed(spark, options, "b9")
    assert commit.committed_ids(spark, options, "b") == [f"b{i}" for i in range(8)]
    assert sorted(os.listdir(tmp_path / "lake/_catalog/folds")) == ["fold=00000001", "fold=00000002"]


def test_long_log_is_read_by_few_paths(spark, tmp_path):
    """A log of ten thousand commits: one fold and the commits of one segment are opened, and the next commit goes on from there."""
    options = LakeOptions(output_path=str(tmp_path / "lake"))
    rows = spark.range(10_000).selectExpr(
        "'otel_logs' AS table_name", "id AS tick", "id AS seq", f"concat('{tmp_path}/lake/main/otel_logs/batch=b', id, '/tick=', id, '/f') AS path",
        "3L AS record_count", "1L AS file_size_bytes", "timestamp'2024-01-01' AS commit_time", f"CAST(array() AS {COLUMN_STATS}) AS column_stats",
        f"CAST(array() AS {TYPED_BOUNDS}) AS typed_bounds", "CAST(array() AS ARRAY<STRING>) AS services",
    )
    numbered = catalog.number_commits(rows, options).withColumn("commit_id", F.concat(F.lit("b"), F.col("tick").cast("string")))
    segment = 10_000 // commit.FOLD_EVERY
    numbered.write.parquet(commit._fold_dir(options, segment))
    commit.commit_files(rows.limit(1).withColumns({"tick": F.lit(10_000).cast("bigint"), "path": F.lit("x")}), options, "next")
    commits = commit.read_commits(spark, options)
    assert commits.count() == 10_001 and len(commits.inputFiles()) <= 20
    last = commits.filter("commit_id = 'next'").first()
    assert (last.snapshot_id, last.file_order, last.next_row_id) == (10_001, 10_000, 30_003)


def manifest_schema():
    return "table_name string, tick long, seq long, path string, record_count long, file_size_bytes long, commit_time timestamp, " + (
        f"column_stats {COLUMN_STATS}, typed_bounds {TYPED_BOUNDS}, services array<string>")


def test_new_checkpoint_takes_in_new_files_only(spark, tmp_path):
    """Lost progress, other groups of files, a file more, a commit without its progress: every row once."""
    options = LakeOptions(output_path=str(tmp_path / "lake"))
    folder = landing(tmp_path, "in", [[logs_payload([log_record(10 * k + i) for i in range(10)])] for k in range(4)])

    def run(progress, files):
        payloads = otlp_json.stream_otlp_json(spark, folder, LOGS, files_per_batch=files)
        ingest.start_ingest(payloads, LOGS, options, checkpoint=progress, drain=True).awaitTermination()
        return sorted(r.body for r in commit.read_table(spark, options, LOGS).collect())

    want = sorted(f"parcel {i} was {'lost' if i % 3 == 2 else 'sent'}" for i in range(40))
    assert run(new_scratch(spark, "progress"), 1) == want
    assert run(new_scratch(spark, "progress"), 3) == want
    (tmp_path / "in" / "late.json").write_text(json.dumps(logs_payload([log_record(i) for i in range(40, 45)])) + "\n")
    want = sorted(want + [f"parcel {i} was {'lost' if i % 3 == 2 else 'sent'}" for i in range(40, 45)])
    progress = new_scratch(spark, "progress")
    assert run(progress, 2) == want
    assert run(progress, 2) == want
    assert run(new_scratch(spark, "progress"), 5) == want


def test_running_stream_cuts_files_by_size_and_timer(spark, tmp_path):
    """A stream under a running timer: each tick's rows make full files and one with what remained, as predicted."""
    options = LakeOptions(output_path=str(tmp_path / "lake"), batch_size=7, batch_timeout_seconds=3)
    folder = landing(tmp_path, "in", [[logs_payload([log_record(20 * k + i) for i in range(20)])] for k in range(2)])
    payloads = otlp_json.stream_otlp_json(spark, folder, LOGS)
    stream = ingest.start_ingest(payloads, LOGS, options, checkpoint=new_scratch(spark, "progress"))
    try:
        for total in (40, 55):
            deadline = time.time() + 120
            while commit.read_commits(spark, options).agg(F.sum("record_count")).first()[0] != total:
                assert time.time() < deadline and stream.exception() is None
                time.sleep(0.5)
            if total == 40:
                (tmp_path / "in" / "more.json").write_text(json.dumps(logs_payload([log_record(i) for i in range(40, 55)])) + "\n")
    finally:
        stream.stop()
    per_tick = defaultdict(list)
    for r in commit.read_commits(spark, options).collect():
        per_tick[r.tick].append(r.record_count)
    ticks = [(tick, n) for tick, counts in per_tick.items() for n in range(sum(counts))]
    rows = [(i, datetime(2024, 1, 1) + timedelta(seconds=3 * tick)) for i, (tick, _) in enumerate(sorted(ticks))]
    predicted = assign_file_batches(
        spark.createDataFrame(rows, "arrival long, ts timestamp"), time="ts", arrival="arrival", batch_size=7, timeout_seconds=3, start_micros=BASE // 1000
    )
    want = defaultdict(list)
    for r in predicted.groupBy("tick", "seq").count().collect():
        want[r.tick].append(r["count"])
    assert {t: sorted(c) for t, c in per_tick.items()} == {t: sorted(c) for t, c in want.items()}
    assert commit.read_table(spark, options, LOGS).select("body").distinct().count() == 55


def test_paths_for_readers(spark, tmp_path):
    """A lake that is read under another path than it is written: the catalog names the readers' paths, and leads there."""
    (tmp_path / "seen").symlink_to(tmp_path / "lake")
    options = LakeOptions(output_path=str(tmp_path / "lake"), data_path=str(tmp_path / "seen"), batch_size=10)
    batches = assign_file_batches(
        log_rows(events_at(spark, range(50))), time="timestamp", arrival="arrival", batch_size=10, timeout_seconds=20, start_micros=BASE // 1000
    )
    commit.store_batches(batches, LOGS, options, commit_id="c1", arrival="arrival")
    commits = commit.read_commits(spark, options)
    paths = [r.path for r in commits.collect()]
    assert len(paths) == 5 and all(p.startswith(f"{tmp_path}/seen/main/otel_logs/batch=c1/tick=") and os.path.exists(p) for p in paths)
    absolute = catalog.absolute_paths(commits, options, commit.started_at(spark, options))
    assert sorted(r.path for r in absolute.collect()) == sorted(paths)
    sizes = {r.path: r.file_size_bytes for r in commits.collect()}
    assert sizes == {p: os.path.getsize(p) for p in paths}
    assert commit.read_table(spark, options, LOGS).count() == 50
    started = commit.open_catalog(spark, options).collect()
    assert commit.open_catalog(spark, options, spark.sql("SELECT timestamp'2020-01-01' AS started")).collect() == started


def test_two_streams_share_a_catalog(spark, tmp_path):
    """Logs and traces ingested at the same time get one gap-free sequence of snapshots."""
    options = LakeOptions(output_path=str(tmp_path / "lake"))
    logs = landing(tmp_path, "logs", [[logs_payload([log_record(i)])] for i in range(3)])
    spans = [{"traceId": f"{i:032x}", "spanId": f"{i:016x}", "name": "s"} for i in range(1, 4)]
    traces = landing(tmp_path, "traces", [[{"resourceSpans": [{"scopeSpans": [{"spans": [s]}]}]}] for s in spans])
    running = [
        ingest.start_ingest(
            otlp_json.stream_otlp_json(spark, folder, signal, files_per_batch=1), signal, options,
            checkpoint=new_scratch(spark, "progress"), drain=True,
        )
        for folder, signal in ((logs, LOGS), (traces, TRACES))
    ]
    for stream in running:
        stream.awaitTermination()
    commits = commit.read_commits(spark, options).collect()
    assert sorted(c.snapshot_id for c in commits) == list(range(1, 7))
    for table in ("otel_logs", "otel_traces"):
        own = sorted((c for c in commits if c.table_name == table), key=lambda c: c.snapshot_id)
        assert [c.file_order for c in own] == [0, 1, 2] and [c.next_row_id for c in own] == [1, 2, 3]


@pytest.mark.parametrize("broadcast_bytes", [0, 256 << 20])
def test_scan_prunes_folders(spark, tmp_path, monkeypatch, broadcast_bytes):
    """The manifest prunes the scan's folders, whether or not it may be broadcast; files of one name stay apart."""
    monkeypatch.setattr(manifest, "BROADCAST_BYTES", broadcast_bytes)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if not broadcast_bytes else "10m")
    try:
        options = LakeOptions(output_path=str(tmp_path / "lake"), batch_size=10)
        batches = assign_file_batches(
            log_rows(events_at(spark, range(400))), time="timestamp", arrival="arrival", batch_size=10, timeout_seconds=20,
            start_micros=BASE // 1000,
        )
        commit.store_batches(batches, LOGS, options, commit_id="c1", arrival="arrival")
        files = commit.table_files(spark, options, LOGS)
        some = files.filter(manifest.may_hold("timestamp", BASE // 1000 + 45_000_000, BASE // 1000 + 55_000_000))
        rows = manifest.scan_files(spark, some, LOGS, options.data_dir("logs"))
        got = rows.collect()
        assert sorted(r.timestamp for r in got) == [datetime(2024, 1, 1) + timedelta(seconds=s) for s in range(40, 60)]
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in plan
        counted = manifest.scan_files(spark, some, LOGS, options.data_dir("logs"), keep=["file_order"]).groupBy("file_order").count().collect()
        assert sorted((r.file_order, r["count"]) for r in counted) == [(4, 10), (5, 10)]
        assert manifest.scan_files(spark, files.filter("tick = 99"), LOGS, options.data_dir("logs")).count() == 0
        assert manifest.scan_files(spark, files, LOGS, str(tmp_path / "none")).count() == 0
        assert manifest.scan_files(spark, files, LOGS, str(tmp_path / "none"), keep=["file_order"]).columns == [*LOGS.column_names, "file_order"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lake_queries_read_the_files_that_matter(spark, tmp_path):
    options = LakeOptions(output_path=str(tmp_path / "lake"), batch_size=20)
    events = events_at(spark, range(600)).withColumns({"event_type": F.expr("CASE WHEN event_id % 2 = 0 THEN 'error' ELSE 'view' END"),
                                                      "value": F.expr("CAST((event_id * 7919) % 1000 + 10 AS DOUBLE)"), "user_id": F.col("event_id").cast("bigint") * F.lit(0) + F.expr("event_id div 100")})
    for signal, rows in ((LOGS, log_rows(events)), (TRACES, span_rows(events))):
        batches = assign_file_batches(rows, time=signal.time_column, arrival="arrival", batch_size=20, timeout_seconds=60, start_micros=BASE // 1000)
        commit.store_batches(batches, signal, options, commit_id=f"{signal.name}-1", arrival="arrival")
    logs, spans = (commit.read_table(spark, options, s) for s in (LOGS, TRACES))
    for limit in (5, 100):
        assert queries.lake_recent_error_logs(spark, options, "90 SECONDS", limit).collect() == queries.recent_error_logs(logs, "90 SECONDS", limit).collect()
        for lookback in ("90 SECONDS", "1 DAY"):
            assert queries.lake_slow_spans(spark, options, lookback, limit).collect() == queries.slow_spans(spans, lookback, limit).collect()
    assert queries.lake_spans_by_service(spark, options, "svc-3").collect() == queries.spans_by_service(spans, "svc-3").collect()
    files = commit.table_files(spark, options, TRACES)
    assert files.filter(manifest.may_hold_service("svc-3")).count() == 5 and files.filter(manifest.may_hold_service("none")).count() == 0
    kept = files.filter(manifest.may_be_among_largest(files, "duration_ns", 3, F.lit(True)))
    assert 3 <= kept.count() < files.count()
    assert queries.lake_recent_error_logs(spark, options, "1 HOUR", as_of=F.current_timestamp()).count() == 0


def test_batch_ingest_through_the_catalog(spark, tmp_path):
    options = LakeOptions(output_path=str(tmp_path / "lake"), batch_size=10, batch_timeout_seconds=60)
    events = events_at(spark, range(100))

    def store(part, commit_id):
        batches = assign_file_batches(
            log_rows(part), time="timestamp", arrival="arrival", batch_size=10, timeout_seconds=60,
            start_micros=BASE // 1000,
        )
        commit.store_batches(batches, LOGS, options, commit_id=commit_id, arrival="arrival")

    store(events.filter("event_id < 60"), "c1")
    store(events.filter("event_id >= 60"), "c2")
    store(events.filter("event_id >= 60"), "c2")
    commits = commit.read_commits(spark, options)
    assert commits.count() == 10
    logs = commit.read_table(spark, options, LOGS)
    assert logs.count() == 100
    newest = manifest.newest_time(commits, "timestamp")
    assert spark.range(1).select(newest.alias("t")).first().t == datetime(2024, 1, 1, 0, 1, 39)
    recent = queries.recent_rows(logs, "timestamp", ["timestamp", "body"], "5 SECONDS", 100)
    assert recent.count() == 5
    kept = commits.filter(manifest.may_hold("timestamp", BASE // 1000 + 95 * 10**6))
    assert kept.count() == 1
    assert manifest.scan_files(spark, kept, LOGS, options.data_dir("logs")).count() == 10


def test_scratch_needs_a_shared_folder(spark):
    assert shared_dir(spark)


def test_file_batches_brute_force(spark):
    """Gaps in arrival numbers, a tick with most rows, many blocks."""
    rng = random.Random(11)
    arrivals = sorted(rng.sample(range(200_000), 5_000))
    rows = [(a, datetime(2024, 1, 1) + timedelta(seconds=(0 if i % 3 else i // 100))) for i, a in enumerate(arrivals)]
    df = spark.createDataFrame(rows, "arrival long, ts timestamp")
    for batch_size in (1, 7, 1000):
        want, seen = {}, defaultdict(int)
        for a, ts in rows:
            tick = (ts - datetime(2024, 1, 1)).seconds // 10
            want[a] = (tick, seen[tick] // batch_size)
            seen[tick] += 1
        got = assign_file_batches(
            df, time="ts", arrival="arrival", batch_size=batch_size, timeout_seconds=10, start_micros=BASE // 1000
        )
        assert got.columns == ["arrival", "ts", "tick", "seq"]
        assert {r.arrival: (r.tick, r.seq) for r in got.collect()} == want


def test_numbers_written_as_text(spark, tmp_path):
    link = {"traceId": "ab" * 16, "spanId": "cd" * 8, "flags": "3", "droppedAttributesCount": 4}
    event = {"name": "e", "droppedAttributesCount": "5"}
    span = {"flags": "1", "droppedAttributesCount": "2", "droppedEventsCount": 6, "droppedLinksCount": "7", "links": [link], "events": [event]}
    folder = landing(tmp_path, "spans", [[{"resourceSpans": [{"scopeSpans": [{"spans": [span]}]}]}]])
    row = flatten(otlp_json.read_otlp_json(spark, folder, TRACES), TRACES).first()
    assert (row.flags, row.dropped_attributes_count, row.dropped_events_count, row.dropped_links_count) == (1, 2, 6, 7)
    assert json.loads(row.links)[0]["flags"] == 3 and json.loads(row.links)[0]["dropped_attributes"] == 4
    assert json.loads(row.events)[0]["dropped_attributes"] == 5
    folder = landing(tmp_path, "logs", [[logs_payload([{"flags": "9"}, {"flags": 8}, {"flags": 4294967295}])]])
    rows = flatten(otlp_json.read_otlp_json(spark, folder, LOGS), LOGS).orderBy("record_pos").collect()
    assert [r.flags for r in rows] == [9, 8, 4294967295]


def test_orphan_spans(spark):
    spans = spark.createDataFrame(
        [("t", "root", None, "a"), ("t", "kid", "root", "b"), ("t", "lost", "gone", "c"), ("u", "other", "root", "d")],
        "trace_id string, span_id string, parent_span_id string, name string",
    )
    assert {r.name for r in queries.orphan_spans(spans).collect()} == {"c", "d"}
