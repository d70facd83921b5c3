"""What a micro-batch of a stream costs, and that it comes to the same."""

import json
import random
import threading
from datetime import datetime

import pytest

from spanloom.operators.flatten import flatten
from spanloom.options import LakeOptions
from spanloom.plans import catalog, commit
from spanloom.schemas import COLUMN_STATS, LOGS, TRACES, TYPED_BOUNDS
from spanloom.sources import otlp_json
from spanloom.streaming import ingest

MANIFEST = "table_name string, tick long, seq long, path string, record_count long"


def test_few_files_are_numbered_in_one_go(spark):
    """The same numbers as in blocks, without the joins and the second look at the files that blocks take."""
    rng = random.Random(5)
    rows = [(rng.choice(["otel_logs", "otel_traces"]), t, s // 2, f"p{t}-{s}", rng.randint(1, 9)) for t in (-1, 3, 70) for s in range(-4, 9)]
    rng.shuffle(rows)
    files = spark.createDataFrame(rows, MANIFEST)
    options, state = LakeOptions(output_path="/x"), catalog.CatalogState({"otel_logs": 5}, {"otel_logs": 50})
    few = catalog.number_commits(files, options, state, few=True)
    assert "Join" not in few._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(few.collect()) == sorted(catalog.number_commits(files, options, state).collect())


def test_commits_of_few_files_carry_their_totals_on(spark, tmp_path, monkeypatch):
    """None reads the one before, also where a fold is between them; another process finds the same totals."""
    monkeypatch.setattr(commit, "FOLD_EVERY", 3)
    options = LakeOptions(output_path=str(tmp_path / "lake"))
    schema = f"{MANIFEST}, file_size_bytes long, commit_time timestamp, column_stats {COLUMN_STATS}, typed_bounds {TYPED_BOUNDS}, services array<string>"
    reads = []
    read_state = commit.read_state
    monkeypatch.setattr(commit, "read_state", lambda commits: reads.append(1) or read_state(commits))
    for i in range(8):
        table = "otel_traces" if i in (2, 5) else "otel_logs"
        rows = [(table, i, s, f"{tmp_path}/lake/main/{table}/batch=b{i}/tick={i}/f{s}", 10, 1, datetime(2024, 1, 1), [], [], []) for s in (0, 1)]
        for _ in range(2):
            commit.commit_files(spark.createDataFrame(rows, schema), options, f"b{i}", files=2)
    # A fold is opened twice; all other commits know what came before.
    assert len(reads) == 2
    carried = commit._state(spark, options)[2]
    commit._STATES.clear()
    assert carried == commit._state(spark, options)[2] == catalog.CatalogState({"otel_logs": 12, "otel_traces": 4}, {"otel_logs": 120, "otel_traces": 40})
    assert sorted(r.snapshot_id for r in commit.read_commits(spark, options).collect()) == list(range(1, 17))


def _span_line(i):
    span = {"name": f"s{i}", "attributes": [{"key": "d", "value": {"doubleValue": i + 0.5}}] if i % 2 else None}
    if i % 3:
        span["events"] = [{"name": "e"}, {"name": "f<", "attributes": [{"key": "n", "value": {"arrayValue": {"values": [{"doubleValue": 1e-7}]}}}]}]
    if i % 5:
        span["links"] = [{"attributes": [{"key": "n", "value": {"intValue": str(i)}}, {"key": "a", "value": {"stringValue": "&"}}]}, {"traceState": "t"}]
    if i == 7:
        span["links"][0]["attributes"][0]["value"] = {"doubleValue": "NaN"}
    if i == 8:
        span["events"][0]["timeUnixNano"] = "never"
    return json.dumps({"resourceSpans": [{"scopeSpans": [{"spans": [span]}]}]})


def test_records_are_read_as_rows(spark, tmp_path):
    """Not inside the payload's lists; attributes of a span, its events and its links stay with what they are of."""
    (tmp_path / "a.json").write_text("\n".join(_span_line(i) for i in range(12)))
    payloads = otlp_json.read_otlp_json(spark, str(tmp_path), TRACES)
    assert "transform" not in payloads._jdf.queryExecution().analyzed().toString()
    rows = flatten(payloads, TRACES)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("$.arrayValue.values") == 2  # those of the resource, and all others together
    found = {int(r.name[1:]): r for r in rows.collect()}
    event = '{"timestamp":"1970-01-01 00:00:00.000000+00","name":"'
    for i, r in found.items():
        assert r.span_attributes == (f'{{"d":{i}.5}}' if i % 2 else "{}")
        assert r.events == (f'[{event}e"}},{event}f\\u003c","attributes":{{"n":[1e-7]}}}}]' if i % 3 else "[]")
        if i != 7:
            link = '{"trace_id":"","span_id":"",'
            assert r.links == (f'[{link}"attributes":{{"a":"\\u0026","n":{i}}}}},{link}"trace_state":"t"}}]' if i % 5 else "[]")
    assert len(found) == 12
    assert {i: r.reason for i, r in found.items() if not r.encodable} == {7: "no JSON for NaN or infinity", 8: "unreadable timeUnixNano"}


@pytest.fixture()
def lines(spark, tmp_path):
    line = {"resourceLogs": [{"scopeLogs": [{"logRecords": [{"body": {"stringValue": "b"}}]}]}]}
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / f"in/{i}.json").write_text(json.dumps(line) + "\n" if i else "  \n")
    return otlp_json._lines(spark.read, str(tmp_path / "in"))


def _batch(lines, options):
    return ingest.ingest_batch(lines, 0, signal=LOGS, options=options, stream="logs", checkpoint="c")


def test_files_are_listed_while_a_batch_is_decoded(spark, tmp_path, lines, monkeypatch):
    begun = threading.Event()
    record, count = ingest._record_inputs, ingest._task_counts

    def recorded(*args):
        begun.set()
        record(*args)

    def counted(rows):
        assert begun.wait(30)
        return count(rows)

    monkeypatch.setattr(ingest, "_record_inputs", recorded)
    monkeypatch.setattr(ingest, "_task_counts", counted)
    options = LakeOptions(output_path=str(tmp_path / "lake"))
    assert _batch(lines, options)["rows"] == 2
    listed = spark.read.parquet(f"{ingest._inputs_dir(options, 'logs')}/checkpoint=c/commit_id={ingest.commit_name('logs', 'c', 0)}")
    # A file without payloads is known as well.
    assert sorted(r.source_file[-7:] for r in listed.collect()) == ["/0.json", "/1.json", "/2.json"]


def test_a_batch_whose_files_are_not_listed_is_not_committed(spark, tmp_path, lines, monkeypatch):
    def broken(*args):
        raise OSError("no space left")

    options = LakeOptions(output_path=str(tmp_path / "lake"))
    with monkeypatch.context() as patched:
        patched.setattr(ingest, "_record_inputs", broken)
        with pytest.raises(OSError):
            _batch(lines, options)
    assert commit.read_commits(spark, options).count() == 0
    assert _batch(lines, options)["rows"] == 2 and commit.read_table(spark, options, LOGS).count() == 2
