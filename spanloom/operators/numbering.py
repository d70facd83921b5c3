"""Running totals over a total order, without putting the order into one task.

The usual window without PARTITION BY (or with a few hot partitions) sends everything to one task. Here the order is
cut into blocks, and the blocks into upper blocks. Totals are taken per block and turned into offsets on two ever
smaller tables, then added to the running total inside each block. No task sees more than the rows of one block, the
blocks of one upper block, or the list of upper blocks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def running_totals(
    df: DataFrame,
    *,
    order: Sequence[str],
    block: Sequence[str],
    upper: Sequence[str],
    totals: Mapping[str, str],
    within: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running sums and drop the `block` and `upper` helper columns named with a leading underscore.

    `upper` and `block` are non-null columns of `df` that, read as one key, never decrease along `order`; `within`
    restarts the sums. `totals` maps new column names to SQL text of non-null integers. Rows equal in `order` share
    no defined sequence, so make it unique.
    """
    upper_key = [*within, *upper]
    block_key = [*upper_key, *block]
    names = list(totals)

    def running(value: str, partition: Sequence[str], by: Sequence[str], end: str) -> str:
        parted = f"PARTITION BY {', '.join(partition)} " if partition else ""
        frame = f"ROWS BETWEEN UNBOUNDED PRECEDING AND {end}"
        return f"sum({value}) OVER ({parted}ORDER BY {', '.join(by)} {frame})"

    measured = df.selectExpr("*", *[f"CAST({text} AS BIGINT) AS {n}" for n, text in totals.items()])
    local = df.selectExpr(
        "*", *[f"{running(f'CAST({text} AS BIGINT)', block_key, order, 'CURRENT ROW')} AS {n}" for n, text in totals.items()]
    )
    # Per block, the total of the earlier blocks of its upper block.
    per_block = measured.groupBy(*block_key).agg(*[F.sum(n).alias(n) for n in names])
    in_upper = per_block.selectExpr(
        *block_key, *names,
        *[f"coalesce({running(n, upper_key, block, '1 PRECEDING')}, 0) AS _before_{n}" for n in names],
    )
    # Per upper block, the total of the earlier upper blocks. It needs no further shuffle of the blocks.
    per_upper = in_upper.groupBy(*upper_key).agg(*[F.sum(n).alias(n) for n in names])
    across = per_upper.selectExpr(
        *upper_key, *[f"coalesce({running(n, within, upper, '1 PRECEDING')}, 0) AS _across_{n}" for n in names]
    )
    offsets = in_upper.join(across, upper_key).selectExpr(
        *block_key, *[f"_before_{n} + _across_{n} AS _offset_{n}" for n in names]
    )
    helpers = {c for c in (*upper, *block) if c.startswith("_")}
    return local.join(offsets, block_key).selectExpr(
        *[c for c in df.columns if c not in helpers], *[f"{n} + _offset_{n} AS {n}" for n in names]
    )
