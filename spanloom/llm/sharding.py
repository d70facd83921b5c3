"""Sharding by a lookup table: every shard has its own permutation of the slots of a prime-sized table, and the shards
take turns in claiming the first slot of their permutation that is still free."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SLOTS = 65_537


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str] | Mapping[str, int], slots: int = TABLE_SLOTS) -> list[str]:
    """The shard of each slot. `shards`: names, or names with the number of claims each has per round.

    A shard's preferences are offset, offset + skip, offset + 2 skip ... modulo `slots`, both numbers from its name;
    `slots` being prime, they visit every slot. Depends on names only, so any program builds the same table.
    """
    weights = dict(shards) if isinstance(shards, Mapping) else dict.fromkeys(shards, 1)
    if not weights or min(weights.values()) < 1 or len(weights) > slots:
        raise ValueError("name at least one shard, with at least one claim each, and no more shards than slots")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"the number of slots must be prime, not {slots}")
    place = {s: _number(f"offset:{s}") % slots for s in weights}
    skip = {s: _number(f"skip:{s}") % (slots - 1) + 1 for s in weights}
    owner: list[str | None] = [None] * slots
    free = slots
    while free:
        for shard, claims in weights.items():
            for _ in range(min(claims, free)):
                while owner[place[shard]] is not None:
                    place[shard] = (place[shard] + skip[shard]) % slots
                owner[place[shard]] = shard
                free -= 1
    return owner  # type: ignore[return-value]


def table_frame(spark: SparkSession, shards: Sequence[str] | Mapping[str, int], slots: int = TABLE_SLOTS) -> DataFrame:
    """The table as (slot, shard). Its size is `slots`, whatever the data, so it may be broadcast."""
    names = lookup_table(shards, slots)
    order = {s: i for i, s in enumerate(dict.fromkeys(names))}
    text = ",".join(str(order[s]) for s in names)
    label = F.array(*[F.lit(s) for s in order])
    numbered = spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("slot", "n"))
    return numbered.select("slot", F.element_at(label, F.col("n").cast("int") + 1).alias("shard"))


def slot_of(key: str, slots: int = TABLE_SLOTS) -> str:
    """SQL for the slot of a key: its text's hash, modulo the table. A null key is placed as an empty text."""
    return f"CAST(pmod(CAST(conv(substr(md5(coalesce(CAST({key} AS STRING), '')), 1, 15), 16, 10) AS BIGINT), {slots}) AS INT)"


def place(df: DataFrame, key: str, shards: Sequence[str] | Mapping[str, int], slots: int = TABLE_SLOTS) -> DataFrame:
    """`df` with the columns slot and shard (replaced if it has such columns): one lookup in a broadcast table per row.

    Rows with equal keys share a shard, so choose a key finer than the largest group that one shard may hold. A null
    key has the shard of the empty text. An empty table stays empty.
    """
    kept = [c for c in df.columns if c.lower() not in ("slot", "shard")]
    keyed = df.withColumn("slot", F.expr(slot_of(f"`{key}`", slots))).select(*kept, "slot")
    table = F.broadcast(table_frame(df.sparkSession, shards, slots))
    return keyed.join(table, "slot").select(*kept, "slot", "shard")


def write_shards(df: DataFrame, key: str, shards: Sequence[str] | Mapping[str, int], path: str, slots: int = TABLE_SLOTS) -> None:
    """Write one folder per shard. Rows are dealt by shard and slot, so one shard is written by many tasks."""
    placed = place(df, key, shards, slots)
    placed.repartition("shard", F.expr("slot % 64")).drop("slot").write.partitionBy("shard").parquet(path)


SHARDS = [f"shard-{i:03d}" for i in range(64)]


def document_shards(docs: DataFrame) -> DataFrame:
    """Per document its slot and shard, and its shard when one more shard joins: few documents move."""
    now = place(docs.select("doc_id"), "doc_id", SHARDS)
    grown = F.broadcast(table_frame(docs.sparkSession, [*SHARDS, f"shard-{len(SHARDS):03d}"]).withColumnRenamed("shard", "shard_after_growth"))
    return now.join(grown, "slot").select("doc_id", "slot", "shard", "shard_after_growth")
