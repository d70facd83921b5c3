"""Streams of payloads into the lake.

Every micro-batch is one timer tick: its rows are numbered as they come, cut into files of batch_size rows, of which the
last takes what remains at the tick, written into a folder of their own, read back once for their statistics and
committed. So streamed files obey the same rule as those of a batch load. A batch is known by its stream, the id of the checkpoint it runs under and its number, so a
batch that Spark runs again after a failure replaces its files and is not committed twice.

With every commit goes the list of the files its payloads came from. A stream that starts under another checkpoint leaves
out what commits of the earlier one have taken in, however it is cut into batches now. Payloads of sources without files
are taken in again by a new checkpoint: no row is lost, some may come twice.

What cannot be stored is kept beside the tables, with the reason: see `read_rejects`.
"""

from __future__ import annotations

import json
import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.util import inheritable_thread_target

from spanloom.operators.flatten import ENCODABLE, POSITIONS, encodable_rows, flatten, rejected_rows
from spanloom.operators.sink import batch_folder, write_batches
from spanloom.options import LakeOptions
from spanloom.plans.commit import commit_files, committed_ids, is_committed
from spanloom.plans.manifest import MANIFEST, written_manifest
from spanloom.schemas import COMMIT_SCHEMA, Signal
from spanloom.session import configure, matching_paths
from spanloom.sources.otlp_json import MALFORMED, SOURCE_FILE, from_otlp_json, is_lines

log = logging.getLogger(__name__)

REJECTS = "reason STRING, source_file STRING, resource_pos INT, scope_pos INT, record_pos INT, line STRING"
MALFORMED_LINE = "malformed line"
ARRIVAL = "_arrival"


def commit_name(stream: str, checkpoint_id: str, batch_id: int) -> str:
    return f"{stream}-{checkpoint_id}-{batch_id:012d}"


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """What Spark calls a query that runs under a checkpoint; a new checkpoint has a new one."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value)["id"][:8]


def _inputs_dir(options: LakeOptions, stream: str) -> str:
    return f"{options.catalog_dir}/inputs/stream={stream}"


def _record_inputs(payloads: DataFrame, options: LakeOptions, stream: str, checkpoint: str, commit_id: str) -> None:
    """Written before the commit, and of account only once the commit is finished."""
    path = f"{_inputs_dir(options, stream)}/checkpoint={checkpoint}/commit_id={commit_id}"
    payloads.select(SOURCE_FILE).distinct().write.mode("overwrite").parquet(path)


def _without_known(payloads: DataFrame, options: LakeOptions, stream: str, checkpoint: str) -> DataFrame:
    """Leave out payloads of files that commits of the stream's other checkpoints took in."""
    spark = payloads.sparkSession
    folders = matching_paths(spark, f"{_inputs_dir(options, stream)}/checkpoint=*")
    others = [f for f in folders if not f.endswith(f"/checkpoint={checkpoint}")]
    if not others:
        return payloads
    ids = [i for f in others for i in committed_ids(spark, options, f"{stream}-{f.split('/checkpoint=')[1]}-")]
    done = spark.createDataFrame([(i,) for i in ids], "commit_id string")
    known = spark.read.schema(f"{SOURCE_FILE} STRING, commit_id STRING").option("basePath", _inputs_dir(options, stream)).parquet(*others)
    # The files of this batch alone are compared, so what is joined with the payloads is as small as the batch.
    seen = payloads.select(SOURCE_FILE).distinct().join(known.join(done, "commit_id", "left_semi"), SOURCE_FILE, "left_semi")
    # At most the names of one batch's files. A broadcast also keeps the payloads in the order of their files, which the
    # numbering of rows has to find again if a task is repeated.
    return payloads.join(F.broadcast(seen), SOURCE_FILE, "left_anti").select(*payloads.columns)


def rejects_dir(options: LakeOptions, signal: Signal) -> str:
    return f"{options.output_path.rstrip('/')}/_rejects/{options.table(signal.name)}"


def rejects(payloads: DataFrame, rows: DataFrame) -> DataFrame:
    """What of a batch cannot be stored: records by their position in their payload, and malformed lines as they are."""
    source = F.col(SOURCE_FILE) if SOURCE_FILE in payloads.columns else F.lit(None).cast("string")
    records = rejected_rows(rows).select("reason", source.alias(SOURCE_FILE), *POSITIONS, F.lit(None).cast("string").alias("line"))
    if MALFORMED not in payloads.columns:
        return records
    nowhere = [F.lit(None).cast("int").alias(p) for p in POSITIONS]
    lines = payloads.filter(F.col(MALFORMED).isNotNull()).select(
        F.lit(MALFORMED_LINE).alias("reason"), source.alias(SOURCE_FILE), *nowhere, F.col(MALFORMED).alias("line")
    )
    return records.unionByName(lines)


def read_rejects(spark: SparkSession, options: LakeOptions, signal: Signal) -> DataFrame:
    """All rejects of a table's finished commits, with the commit each belongs to."""
    folder = rejects_dir(options, signal)
    written = matching_paths(spark, f"{folder}/batch=*")
    done = [p for p in written if is_committed(spark, options, p.split("/batch=")[1])]
    if not done:
        return spark.createDataFrame([], f"{REJECTS}, batch STRING")
    return spark.read.schema(f"{REJECTS}, batch STRING").option("basePath", folder).parquet(*done)


def _line_counts(payloads: DataFrame) -> list:
    malformed = F.count_if(F.col(MALFORMED).isNotNull()) if MALFORMED in payloads.columns else F.count_if(F.lit(False))
    return [F.count(F.lit(1)).alias("payloads"), malformed.alias("malformed")]


def _task_counts(rows: DataFrame) -> list:
    """Rows and rejected records of each task that has any, as (task, rows, rejected)."""
    return rows.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col(ENCODABLE)).alias("rejected")
    ).collect()


def _cut_batch(rows: DataFrame, batch_id: int, tasks: list, batch_size: int) -> DataFrame:
    """The storable rows with `tick`, the batch, and `seq`, their file in it. Rows keep the order in which they came:
    the earlier tasks' storable rows come before a row, and those before it in its own task."""
    stored = {t.task: t.rows - t.rejected for t in tasks}
    earlier, total = [], 0
    for task in range(max(stored) + 1):
        earlier.append(f"{total}L")
        total += stored.get(task, 0)
    # The number of a row: its task above 33 bits, its position in the task below.
    numbered = encodable_rows(rows).withColumn(ARRIVAL, F.monotonically_increasing_id())
    position = f"element_at(array({', '.join(earlier)}), CAST(shiftright({ARRIVAL}, 33) AS INT) + 1) + ({ARRIVAL} & {(1 << 33) - 1}L)"
    return numbered.selectExpr("*", f"{batch_id}L AS tick", f"({position}) div {batch_size} AS seq")


def ingest_batch(
    payloads: DataFrame, batch_id: int, *, signal: Signal, options: LakeOptions, stream: str, checkpoint: str
) -> dict[str, int]:
    """One micro-batch under a checkpoint's id: the numbers of rows, rejected records and malformed lines."""
    spark = configure(payloads.sparkSession)
    commit_id = commit_name(stream, checkpoint, batch_id)
    if is_committed(spark, options, commit_id):
        return {}
    from_files = SOURCE_FILE in payloads.columns
    if from_files:
        payloads = _without_known(payloads, options, stream, checkpoint)
    arrived = payloads
    if is_lines(payloads):
        payloads = from_otlp_json(payloads, signal)
    folder = batch_folder(options, signal, commit_id)
    lines = Observation()
    carried = [SOURCE_FILE] if from_files else []
    observed = payloads.observe(lines, *_line_counts(payloads))
    # Read for the counts, the files and the rejects; what is lost with an executor comes out the same again.
    rows = flatten(observed, signal, carry=carried).persist(StorageLevel.DISK_ONLY)
    beside = ThreadPoolExecutor(max_workers=1)
    try:
        # The list of files is written meanwhile, as a job of this batch too.
        if from_files:
            listed = beside.submit(inheritable_thread_target(spark)(_record_inputs), arrived, options, stream, checkpoint, commit_id)
        tasks = _task_counts(rows)
        totals = {name: sum(t[name] for t in tasks) for name in ("rows", "rejected")}
        # Nothing is observed in a plan that turns out to have no rows.
        seen = lines.get if totals["rows"] else payloads.agg(*_line_counts(payloads)).first().asDict()
        counts = {**totals, **seen}
        if counts["rows"] > counts["rejected"]:
            batches = _cut_batch(rows, batch_id, tasks, options.batch_size)
            write_batches(batches, signal, options, commit_id=commit_id, arrival=ARRIVAL)
        if counts["rejected"] or counts["malformed"]:
            log.warning("%s: %d of %d records and %d of %d lines rejected", commit_id, counts["rejected"], counts["rows"], counts["malformed"], counts["payloads"])
            rejects(payloads, rows).write.mode("overwrite").parquet(f"{rejects_dir(options, signal)}/batch={commit_id}")
        if from_files:
            listed.result()
    finally:
        beside.shutdown()
        rows.unpersist()
    stored = counts["rows"] - counts["rejected"]
    if stored:
        manifest = written_manifest(spark, folder, signal, options.table(signal.name))
    else:
        manifest = spark.createDataFrame([], COMMIT_SCHEMA).select(*MANIFEST)
    commit_files(manifest, options, commit_id, files=-(-stored // options.batch_size))
    return counts


def start_ingest(
    payloads: DataFrame,
    signal: Signal,
    options: LakeOptions,
    *,
    checkpoint: str,
    stream: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Start a stream. `drain` works off what is there and stops; otherwise a batch runs every batch_timeout."""
    options.validate()
    stream = stream or signal.name

    def run(batch: DataFrame, batch_id: int) -> None:
        own = checkpoint_id(batch.sparkSession, checkpoint)
        ingest_batch(batch, batch_id, signal=signal, options=options, stream=stream, checkpoint=own)

    writer = payloads.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).queryName(stream)
    if drain:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{options.batch_timeout_seconds} seconds").start()
