"""The snapshot catalog as functions of the manifest.

One file is one commit is one snapshot. All numbers (snapshot ids, file ids, file order, row ids, schema versions)
are running totals over the commit order, so a whole set of new files is numbered in one go. Later commits continue
from the totals reached so far instead of numbering history again.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators.numbering import running_totals
from spanloom.operators.stats import long_form, merge_column_stats
from spanloom.options import SCHEMA_NAME, LakeOptions
from spanloom.schemas import SIGNALS

# Fixed values of a new catalog.
CATALOG_VERSION = "0.3"
BOOTSTRAP_MESSAGE = "Empty catalog with one schema"
MAPPING_TYPE = "map_by_name"
FILE_FORMAT = "PARQUET"
AUTHOR = "spanloom"

# Numbering blocks: files of one tick whose first times, in microseconds, are of one minute; then runs of ticks.
_SEQ_BLOCK = 60_000_000
_TICKS_PER_BLOCK = 64


@dataclass(frozen=True)
class CatalogState:
    """Totals reached by earlier commits: files and records per table, and the creation order of the tables."""

    files: dict = field(default_factory=dict)
    records: dict = field(default_factory=dict)

    @property
    def snapshot_id(self) -> int:
        return sum(self.files.values())

    def after(self, newer: "CatalogState") -> "CatalogState":
        """The totals once newer commits, which continue from these, are in."""
        return CatalogState({**self.files, **newer.files}, {**self.records, **newer.records})


def read_state(commits: DataFrame) -> CatalogState:
    """One small row per table; the number of tables is fixed by the options."""
    rows = commits.groupBy("table_name").agg(
        F.max("file_order").alias("last_order"), F.max("next_row_id").alias("next_row_id")
    )
    found = rows.collect()
    return CatalogState(
        files={r.table_name: r.last_order + 1 for r in found}, records={r.table_name: r.next_row_id for r in found}
    )


def number_commits(
    manifest: DataFrame, options: LakeOptions, state: CatalogState | None = None, seq_block: int = _SEQ_BLOCK, few: bool = False
) -> DataFrame:
    """Add the catalog numbers to manifest rows, whose paths are unique and which should be persisted.

    Running totals are taken over narrow rows, in blocks of `seq_block` seq values, and joined back by path. The rows of a
    `few` files are put in order in one task instead, and are read once.
    """
    state = state or CatalogState()
    signals = {"logs": options.logs_table, "traces": options.traces_table}
    totals = {}
    for signal, table in signals.items():
        totals[f"_files_{signal}"] = f"CASE WHEN table_name = '{table}' THEN 1 ELSE 0 END"
        totals[f"_records_{signal}"] = f"CASE WHEN table_name = '{table}' THEN record_count ELSE 0 END"
    if few:
        so_far = "OVER (ORDER BY tick, seq, table_name, path ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        numbered = manifest.selectExpr("*", *[f"sum(CAST({text} AS BIGINT)) {so_far} AS {name}" for name, text in totals.items()])
    else:
        narrow = running_totals(
            manifest.selectExpr(
                "tick", "seq", "table_name", "path", "record_count",
                f"tick div {_TICKS_PER_BLOCK} AS _tick_block", f"seq div {seq_block} AS _seq_block",
            ),
            order=["seq", "table_name", "path"],
            upper=["_tick_block"],
            block=["tick", "_seq_block"],
            totals=totals,
        )
        numbered = manifest.join(narrow.select("path", *totals), "path")
    numbered = numbered.selectExpr(
        *manifest.columns,
        *[f"_files_{s} + {state.files.get(t, 0)} AS _files_{s}" for s, t in signals.items()],
        *[f"_records_{s} + {state.records.get(t, 0)} AS _records_{s}" for s, t in signals.items()],
    )

    def of_table(value: dict[str, str]) -> str:
        cases = " ".join(f"WHEN '{t}' THEN {value[s]}" for s, t in signals.items())
        return f"CASE table_name {cases} END"

    n_files = of_table({s: f"_files_{s}" for s in signals})
    all_files = " + ".join(f"_files_{s}" for s in signals)
    known_tables = " + ".join(f"CAST(_files_{s} > 0 AS BIGINT)" for s in signals)
    # Column ids run through the tables in the order of their creation.
    known_columns = " + ".join(f"CAST(_files_{s} > 0 AS BIGINT) * {len(SIGNALS[s].columns)}" for s in signals)
    own_columns = of_table({s: str(len(SIGNALS[s].columns)) for s in signals})
    return numbered.selectExpr(
        *manifest.columns,
        f"{all_files} AS snapshot_id",
        "CAST(NULL AS BIGINT) AS end_snapshot",
        f"{all_files} - 1 AS data_file_id",
        f"{n_files} - 1 AS file_order",
        f"{of_table({s: f'_records_{s}' for s in signals})} AS next_row_id",
        f"{known_tables} AS schema_version",
        f"{known_tables} + 1 AS next_catalog_id",
        f"{all_files} AS next_file_id",
        # Set where a table is created, that is on its first file.
        f"CASE WHEN {n_files} = 1 THEN CAST({known_columns} - {own_columns} + 1 AS BIGINT) END AS first_column_id",
    )


def _unset(*names: str, kind: str = "bigint") -> list[Column]:
    """Catalog columns that are never filled."""
    return [F.lit(None).cast(kind).alias(name) for name in names]


def bootstrap(spark: SparkSession, options: LakeOptions, started: DataFrame, existing: DataFrame | None = None):
    """Rows of a new catalog as (catalog_table, key, value); none if `existing` snapshots contain snapshot 0.

    `started` is one row with the catalog's start time.
    """
    data_path = options.data_path.rstrip("/") + "/"
    rows = [
        ("metadata", "version", F.lit(CATALOG_VERSION)),
        ("metadata", "created_by", F.lit(AUTHOR)),
        ("metadata", "data_path", F.lit(data_path)),
        ("metadata", "encrypted", F.lit("false")),
        ("snapshot", "0", F.date_format("started", "yyyy-MM-dd HH:mm:ss.SSSSSS")),
        ("schema_versions", "0", F.lit("0")),
        ("schema", SCHEMA_NAME, F.lit(f"{SCHEMA_NAME}/")),
        ("snapshot_changes", f"created_schema:{SCHEMA_NAME}", F.lit(BOOTSTRAP_MESSAGE)),
    ]
    structs = [
        F.struct(F.lit(t).alias("catalog_table"), F.lit(k).alias("key"), v.alias("value")) for t, k, v in rows
    ]
    made = started.select(F.lit(0).cast("bigint").alias("snapshot_id"), F.inline(F.array(*structs)))
    if existing is not None:
        made = made.join(existing.select("snapshot_id"), "snapshot_id", "left_anti")
    return made.drop("snapshot_id")


def snapshots(commits: DataFrame, started: DataFrame) -> DataFrame:
    """Snapshot 0 and one snapshot per file."""
    zero = started.select(
        F.lit(0).cast("bigint").alias("snapshot_id"),
        F.col("started").alias("snapshot_time"),
        F.lit(0).cast("bigint").alias("schema_version"),
        F.lit(1).cast("bigint").alias("next_catalog_id"),
        F.lit(0).cast("bigint").alias("next_file_id"),
    )
    made = commits.select(
        "snapshot_id", F.col("commit_time").alias("snapshot_time"), "schema_version", "next_catalog_id", "next_file_id"
    )
    return zero.unionByName(made)


def _creating(commits: DataFrame) -> DataFrame:
    """The first commit of each table: one row per table."""
    return commits.filter(F.col("file_order") == 0)


def _stable_uuid(text: Column) -> Column:
    """A uuid that is the same whenever it is derived again."""
    return F.regexp_replace(F.md5(text), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def tables(commits: DataFrame) -> DataFrame:
    """A table's id is the schema version its creation led to."""
    return _creating(commits).select(
        F.col("schema_version").alias("table_id"),
        _stable_uuid(F.concat(F.lit("table/"), F.col("table_name"))).alias("table_uuid"),
        F.col("snapshot_id").alias("begin_snapshot"),
        F.lit(1).cast("bigint").alias("reference_begin_snapshot"),
        F.lit(None).cast("bigint").alias("end_snapshot"),
        F.lit(0).cast("bigint").alias("schema_id"),
        "table_name",
        F.concat("table_name", F.lit("/")).alias("path"),
        F.lit(True).alias("path_is_relative"),
        (F.col("next_catalog_id") - 1).alias("mapping_id"),
        "first_column_id",
    )


def schemas(started: DataFrame) -> DataFrame:
    return started.select(
        F.lit(0).cast("bigint").alias("schema_id"),
        _stable_uuid(F.lit(f"schema/{SCHEMA_NAME}")).alias("schema_uuid"),
        F.lit(0).cast("bigint").alias("begin_snapshot"),
        *_unset("end_snapshot"),
        F.lit(SCHEMA_NAME).alias("schema_name"),
        F.lit(f"{SCHEMA_NAME}/").alias("path"),
        F.lit(True).alias("path_is_relative"),
    )


def columns(commits: DataFrame, options: LakeOptions) -> DataFrame:
    def listing(signal: str) -> Column:
        return F.array(
            *[
                F.struct(F.lit(name).alias("column_name"), F.lit(kind).alias("column_type"))
                for name, kind in SIGNALS[signal].columns
            ]
        )

    listed = F.when(F.col("table_name") == F.lit(options.logs_table), listing("logs")).otherwise(listing("traces"))
    return (
        tables(commits)
        .select("table_id", "table_name", "begin_snapshot", "first_column_id", F.posexplode(listed).alias("pos", "c"))
        .select(
            (F.col("first_column_id") + F.col("pos")).alias("column_id"),
            "begin_snapshot",
            F.lit(1).cast("bigint").alias("reference_begin_snapshot"),
            F.lit(None).cast("bigint").alias("end_snapshot"),
            "table_id",
            (F.col("pos") + 1).cast("bigint").alias("column_order"),
            "c.column_name",
            "c.column_type",
            *_unset("initial_default", "default_value", kind="string"),
            F.lit(True).alias("nulls_allowed"),
            *_unset("parent_column"),
        )
    )


def column_mapping(commits: DataFrame) -> DataFrame:
    return tables(commits).select("mapping_id", "table_id", F.lit(MAPPING_TYPE).alias("type"))


def name_mapping(commits: DataFrame, options: LakeOptions) -> DataFrame:
    """Parquet column position (from 0) and name to catalog column id."""
    return (
        columns(commits, options)
        .join(F.broadcast(column_mapping(commits)), "table_id")
        .select(
            "mapping_id",
            (F.col("column_order") - 1).alias("column_id"),
            F.col("column_name").alias("source_name"),
            F.col("column_id").alias("target_field_id"),
            F.lit(None).cast("bigint").alias("parent_column"),
            F.lit(False).alias("is_partition"),
        )
    )


def _with_table_id(commits: DataFrame) -> DataFrame:
    # Broadcast of one row per configured table.
    return commits.join(F.broadcast(tables(commits).select("table_name", "table_id", "mapping_id")), "table_name")


def snapshot_changes(commits: DataFrame, started: DataFrame) -> DataFrame:
    changes = F.concat_ws(
        ",",
        F.when(F.col("file_order") == 0, F.concat(F.lit("created_table:"), F.col("table_name"))),
        F.concat(F.lit("inserted_into_table:"), F.col("table_id").cast("string")),
    )
    message = F.concat(
        F.lit("one file more in "), F.col("table_name"), F.lit(", table "), F.col("table_id").cast("string")
    )
    made = _with_table_id(commits).select(
        "snapshot_id",
        changes.alias("changes_made"),
        F.lit(AUTHOR).alias("author"),
        message.alias("commit_message"),
        F.lit(None).cast("string").alias("commit_extra_info"),
    )
    zero = started.select(
        F.lit(0).cast("bigint").alias("snapshot_id"),
        F.lit(f"created_schema:{SCHEMA_NAME}").alias("changes_made"),
        F.lit(AUTHOR).alias("author"),
        F.lit(BOOTSTRAP_MESSAGE).alias("commit_message"),
        F.lit(None).cast("string").alias("commit_extra_info"),
    )
    return zero.unionByName(made)


def data_files(commits: DataFrame, options: LakeOptions) -> DataFrame:
    """A file's path is relative to its table's folder, batch and tick folders included, so that it leads to the file."""
    root = F.concat(F.lit(f"{options.data_path.rstrip('/')}/{SCHEMA_NAME}/"), F.col("table_name"), F.lit("/"))
    below = F.startswith(F.col("path"), root)
    return _with_table_id(commits).select(
        "data_file_id",
        "table_id",
        F.col("snapshot_id").alias("begin_snapshot"),
        "end_snapshot",
        "file_order",
        F.when(below, F.substring(F.col("path"), F.length(root) + 1, F.length("path"))).otherwise(F.col("path")).alias("path"),
        below.alias("path_is_relative"),
        F.lit(FILE_FORMAT).alias("file_format"),
        "record_count",
        "file_size_bytes",
        *_unset("footer_size", "row_id_start", "partition_id"),
        *_unset("encryption_key", "partial_file_info", kind="string"),
        "mapping_id",
    )


def file_column_stats(commits: DataFrame, options: LakeOptions) -> DataFrame:
    """File statistics under catalog ids; statistics of unknown columns are left out."""
    ids = columns(commits, options).select("table_id", "column_name", "column_id")
    stats = long_form(_with_table_id(commits), ["data_file_id", "table_id"])
    # Broadcast of one row per column of the configured tables.
    return stats.join(F.broadcast(ids), ["table_id", "column_name"]).select(
        "data_file_id",
        "table_id",
        "column_id",
        "column_size_bytes",
        "value_count",
        "null_count",
        "min_value",
        "max_value",
        F.lit(False).alias("contains_nan"),
        *_unset("extra_stats", kind="string"),
    )


def table_stats(commits: DataFrame) -> DataFrame:
    return (
        _with_table_id(commits)
        .groupBy("table_id")
        .agg(
            F.sum("record_count").alias("record_count"),
            F.max("next_row_id").alias("next_row_id"),
            F.sum("file_size_bytes").alias("file_size_bytes"),
        )
    )


def table_stats_history(commits: DataFrame) -> DataFrame:
    """A table's next row id after each of its files."""
    return _with_table_id(commits).select("table_id", "snapshot_id", "file_order", "record_count", "next_row_id")


def table_column_stats(commits: DataFrame, options: LakeOptions) -> DataFrame:
    merged = merge_column_stats(file_column_stats(commits, options), ["table_id", "column_id"])
    return merged.select("*", F.lit(False).alias("contains_nan"), *_unset("extra_stats", kind="string"))


def table_exists(commits: DataFrame, started: DataFrame, names: list[str]) -> DataFrame:
    """(table_name, table_exists) for the asked names, looked up in schema `main`."""
    asked = started.select(F.explode(F.array(*[F.lit(n) for n in names])).alias("table_name"))
    found = (
        tables(commits)
        .join(F.broadcast(schemas(started).filter(F.col("schema_name") == SCHEMA_NAME).select("schema_id")), "schema_id")
        .groupBy("table_name")
        .agg(F.lit(True).alias("found"))
    )
    return asked.join(F.broadcast(found), "table_name", "left").select(
        "table_name", F.coalesce("found", F.lit(False)).alias("table_exists")
    )


def next_ids(commits: DataFrame) -> DataFrame:
    return commits.agg(
        F.coalesce(F.max("schema_version"), F.lit(0)).cast("bigint").alias("schema_version"),
        F.coalesce(F.max("next_catalog_id"), F.lit(1)).cast("bigint").alias("next_catalog_id"),
        F.coalesce(F.max("next_file_id"), F.lit(0)).cast("bigint").alias("next_file_id"),
        (F.coalesce(F.max("snapshot_id"), F.lit(0)) + 1).cast("bigint").alias("next_snapshot_id"),
    )


def absolute_paths(commits: DataFrame, options: LakeOptions, started: DataFrame) -> DataFrame:
    """Where a data file lies: data path, schema path, table path and file name, as far as they are relative."""
    root = options.data_path.rstrip("/") + "/"
    schema = schemas(started).select("schema_id", F.col("path").alias("schema_path"),
                                     F.col("path_is_relative").alias("schema_relative"))
    table = tables(commits).select("table_id", "schema_id", F.col("path").alias("table_path"),
                                   F.col("path_is_relative").alias("table_relative"))
    joined = data_files(commits, options).join(F.broadcast(table), "table_id").join(F.broadcast(schema), "schema_id")
    in_schema = F.when(F.col("schema_relative"), F.concat(F.lit(root), "schema_path")).otherwise(F.col("schema_path"))
    in_table = F.when(F.col("table_relative"), F.concat(in_schema, F.col("table_path"))).otherwise(F.col("table_path"))
    return joined.select(
        "data_file_id",
        F.when(F.col("path_is_relative"), F.concat(in_table, F.col("path"))).otherwise(F.col("path")).alias("path"),
    )


def recent_snapshots(commits: DataFrame, options: LakeOptions, started: DataFrame, limit: int = 10) -> DataFrame:
    """The newest snapshots with their table and its totals."""
    files = data_files(commits, options).select(F.col("begin_snapshot").alias("snapshot_id"), "table_id")
    names = tables(commits).select("table_id", "table_name")
    totals = table_stats(commits).select("table_id", "record_count", F.col("file_size_bytes").alias("total_size"))
    return (
        snapshots(commits, started)
        .select("snapshot_id", "snapshot_time")
        .join(files, "snapshot_id")
        .join(F.broadcast(names), "table_id")
        .join(F.broadcast(totals), "table_id")
        .select("snapshot_id", "snapshot_time", "table_name", "record_count", "total_size")
        .orderBy(F.desc("snapshot_time"), F.desc("snapshot_id"))
        .limit(limit)
    )


def files_for_snapshot(commits: DataFrame, options: LakeOptions, snapshot_id: int) -> DataFrame:
    return (
        data_files(commits, options)
        .filter(F.col("begin_snapshot") == snapshot_id)
        .select("path", "record_count", "file_size_bytes", "file_order")
        .orderBy("file_order")
    )


def checks(commits: DataFrame, written: DataFrame) -> DataFrame:
    """What must hold in every catalog, as (check_name, ok). `written` has one row with one column, the rows written."""
    facts = commits.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("records"),
        F.count_distinct("snapshot_id").alias("snapshot_ids"),
        F.min("snapshot_id").alias("first_snapshot"),
        F.max("snapshot_id").alias("last_snapshot"),
        F.count_distinct("path").alias("paths"),
        F.sum(F.when(F.col("commit_time").isNull() | F.col("snapshot_id").isNull(), 1).otherwise(0)).alias("gaps"),
        F.count_distinct("table_name", "file_order").alias("orders"),
        F.min("record_count").alias("smallest"),
    )
    file_tests = {
        "has_data_files": F.col("files") > 0,
        "snapshot_per_file": F.col("snapshot_ids") == F.col("files"),
        "snapshots_without_gaps": (F.col("first_snapshot") == 1) & (F.col("last_snapshot") == F.col("files")),
        "no_null_snapshot_fields": F.col("gaps") == 0,
        "paths_unique": F.col("paths") == F.col("files"),
        "file_order_unique": F.col("orders") == F.col("files"),
        "no_empty_files": F.col("smallest") > 0,
        "records_match_rows_written": F.col("records") == written.scalar(),
    }
    mappings = column_mapping(commits).agg(
        F.count(F.lit(1)).alias("mappings"),
        F.count_distinct("table_id").alias("mapped_tables"),
        F.min("mapping_id").alias("first_mapping"),
    )
    mapping_tests = {
        "one_mapping_per_table": F.col("mappings") == F.col("mapped_tables"),
        "mapping_ids_not_zero": F.col("first_mapping") >= 1,
    }

    def listed(tests: dict[str, Column]) -> Column:
        return F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"), ok.alias("ok")) for n, ok in tests.items()]))

    return facts.select(listed(file_tests)).unionByName(mappings.select(listed(mapping_tests)))
