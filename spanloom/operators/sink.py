"""Parquet sink: codec, file names, file cuts, dictionary and bloom filter settings."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, DataFrameWriter

from spanloom.options import LakeOptions
from spanloom.schemas import Signal

ID_COLUMNS = ("trace_id", "span_id")
FALSE_POSITIVES = 0.01  # about 10 bits per value


def configured_writer(rows: DataFrame, options: LakeOptions, table: str, written_at: datetime | None = None):
    """A writer whose files are named <table>_<UTC time>-<task>-<job id>... and hold at most batch_size rows."""
    options.validate()
    stamp = (written_at or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")
    writer = (
        rows.write.mode("overwrite")
        .option("compression", options.compression.lower())
        .option("maxRecordsPerFile", options.batch_size)
        .option("mapreduce.output.basename", f"{table}_{stamp}")
        # Tasks move their own files when they commit, instead of the driver all files one after the other at the end. A
        # write that breaks off leaves files in its folder; a folder is of account only once its commit is finished, and the
        # next attempt replaces it.
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    )
    return _with_bloom_filters(writer, options) if options.enable_bloom_filters else writer


def _with_bloom_filters(writer: DataFrameWriter, options: LakeOptions) -> DataFrameWriter:
    for column in ID_COLUMNS:
        writer = (
            writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
            .option(f"parquet.bloom.filter.expected.ndv#{column}", str(options.batch_size))
            .option(f"parquet.bloom.filter.fpp#{column}", str(FALSE_POSITIVES))
            # A dictionary-encoded column chunk gets no bloom filter; other columns keep their dictionaries.
            .option(f"parquet.enable.dictionary#{column}", "false")
        )
    return writer


def batch_folder(options: LakeOptions, signal: Signal, commit_id: str) -> str:
    """Each commit writes below a folder of its own, which a repeated attempt may overwrite."""
    return f"{options.table_dir(signal.name)}/batch={commit_id}"


def write_batches(
    batches: DataFrame,
    signal: Signal,
    options: LakeOptions,
    *,
    commit_id: str,
    arrival: str,
    written_at: datetime | None = None,
) -> str:
    """Write rows that carry (tick, seq) so that every (tick, seq) becomes one file below tick=<n>/.

    One shuffle on (tick, seq), which spreads a busy tick over all tasks. Inside a task rows are ordered by tick and
    seq; only the last file of a tick is not full, and it sorts last in its tick, so cutting at batch_size rows cuts
    between files.
    """
    folder = batch_folder(options, signal, commit_id)
    rows = (
        batches.repartition("tick", "seq")
        .sortWithinPartitions("tick", "seq", arrival)
        .select(*signal.column_names, "tick")
    )
    configured_writer(rows, options, options.table(signal.name), written_at).partitionBy("tick").parquet(folder)
    return folder
