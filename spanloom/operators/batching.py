"""Which file a row goes to.

The buffer is cut when it holds `batch_size` rows and emptied at every tick of a free-running timer, so a row's file
is fixed by its tick and by its position inside the tick.

Positions are worked out on (tick, arrival) alone. What comes out is a small table of cuts: per block of arrival
numbers, the files that start in it. Whole rows find their file by a lookup there and are not shuffled for it: the table
is written first, since Spark takes it for as large as the rows that it is worked out from until it sees its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators.numbering import running_totals
from spanloom.session import written

# A block spans at least this many arrival numbers, and a few files. Arrival numbers are unique, so that is also the
# most rows a block can have, even if most rows fall into a single tick.
SMALLEST_BLOCK = 4096
FILES_PER_BLOCK = 4
BLOCKS_PER_UPPER = 4096


def tick_of(time: str, start_micros: int, timeout_seconds: float) -> str:
    """SQL text: the number of the timer interval a time falls in, counted from the start; -1 if the time is unknown.

    Never NULL, so no row is lost in a join on it, and no IS NOT NULL filters keep equal subplans from being shared.
    """
    width = int(timeout_seconds * 1_000_000)
    elapsed = f"(unix_micros({time}) - {start_micros}L)"
    return f"coalesce(({elapsed} - pmod({elapsed}, {width}L)) div {width}L, -1L)"


def file_cuts(arrivals: DataFrame, batch_size: int, block: int) -> DataFrame:
    """From (tick, arrival, block): per tick and block, the arrivals at which files start, and `earlier`, the number of
    files of the tick that started before the block."""
    numbered = running_totals(
        arrivals.selectExpr("*", f"arrival div {block * BLOCKS_PER_UPPER} AS _upper"),
        order=["arrival"],
        block=["block"],
        upper=["_upper"],
        totals={"position": "1"},
        within=["tick"],
    )
    # At most a handful of starts per block, since a block is a few files wide.
    return numbered.groupBy("tick", "block").agg(
        F.expr(f"(min(position) + {batch_size} - 2) div {batch_size}").alias("earlier"),
        F.expr(f"collect_list(CASE WHEN (position - 1) % {batch_size} = 0 THEN arrival END)").alias("starts"),
    )


def assign_file_batches(
    df: DataFrame,
    *,
    time: str,
    arrival: str,
    batch_size: int,
    timeout_seconds: float,
    start_micros: int,
) -> DataFrame:
    """Add `tick` and `seq`, the file's tick and its number inside the tick.

    `arrival` is a unique, non-negative integer that grows with arrival, `time` the arrival time. The cuts, a row for
    some 4096 rows at least, are worked out now and joined with the rows; Spark broadcasts them where they are small enough
    for that.
    """
    return cut_into_files(df, tick_of(time, start_micros, timeout_seconds), arrival, batch_size)


def cut_into_files(df: DataFrame, tick: str, arrival: str, batch_size: int) -> DataFrame:
    """Add `tick`, given as SQL text that is never NULL, and `seq`, the file's number inside the tick."""
    block = max(SMALLEST_BLOCK, FILES_PER_BLOCK * batch_size)
    number = f"coalesce(CAST({arrival} AS BIGINT), -1L)"
    arrivals = df.selectExpr(f"{tick} AS tick", f"{number} AS arrival", f"{number} div {block} AS block")
    cuts = written(file_cuts(arrivals, batch_size, block), "cuts").withColumnRenamed("block", "_block")
    found = df.selectExpr("*", f"{tick} AS tick", f"{number} div {block} AS _block").join(cuts, ["tick", "_block"])
    return found.selectExpr(
        *df.columns, "tick", f"earlier + size(filter(starts, s -> s <= {number})) - 1 AS seq"
    )
