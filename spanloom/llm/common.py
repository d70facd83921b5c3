"""What several operators share: written tables, connected components, the next key in a total order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_scratch

# Keys of one window task in `successors`.
KEYS_PER_WINDOW_BITS = 12
# Rows of a table of numbers that may be broadcast.
BROADCAST_ROWS = 1 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several steps read, in the shared folder, and read it again: cuts lineage for good."""
    path = new_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def limited(numbers: DataFrame) -> DataFrame:
    """A table of one to three columns of numbers, marked for broadcast if counting it shows that it is small; beyond
    that Spark joins it by a shuffle."""
    return F.broadcast(numbers) if numbers.count() <= BROADCAST_ROWS else numbers


def whole_text(column: str = "text") -> str:
    """SQL for a text whose null counts as empty."""
    return f"coalesce({column}, '')"


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable over undirected `edges` (a, b); nodes without an edge are absent.

    Alternates large-star and small-star steps: every node's larger neighbours, then its smaller ones, are joined to its
    smallest neighbour. A hub's edges are reduced by a partial minimum and joined back, so no task has to hold them.
    Rounds grow with the logarithm of the longest path.
    """
    pairs = edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").where("a > b").distinct()
    pairs = written(pairs, name)
    state = _state(pairs)
    while state[0]:
        both = pairs.union(pairs.selectExpr("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a AS u", "least(a, m) AS m")
        large = both.join(least, both.a == least.u).where("b > a").selectExpr("b AS a", "m AS b").where("a <> b").distinct()
        # In one plan with the small step it would stand four times, with all its exchanges.
        large = written(large, name)
        smallest = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        joined = large.join(smallest, large.a == smallest.u)
        small = joined.selectExpr("explode(array(b, a)) AS a", "m AS b")
        pairs = written(small.where("a <> b").distinct(), name)
        if (now := _state(pairs)) == state:
            break
        state = now
    members = pairs.selectExpr("a AS node", "b AS component")
    return members.union(pairs.selectExpr("b AS node", "b AS component")).distinct()


def _state(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count("*"), F.sum(F.expr("CAST(xxhash64(a, b) AS DECIMAL(38, 0))"))).first()
    return row[0], row[1]


def successors(keys: DataFrame, key: str) -> DataFrame:
    """(key, next) for distinct non-null integers: the next larger one; after the largest, the smallest.

    Windows see at most 2^KEYS_PER_WINDOW_BITS keys; the step to the next window's keys is looked up in the same way
    among the windows.
    """
    low, high = keys.agg(F.min(key), F.max(key)).first()
    keys = keys.select(F.col(key).cast("bigint").alias("k"))
    if low is None:
        return keys.selectExpr(f"k AS {key}", "k AS next")
    following = _following(keys, int(low), int(high))
    return following.selectExpr(f"k AS {key}", f"coalesce(next, {int(low)}L) AS next")


def _following(keys: DataFrame, low: int, high: int) -> DataFrame:
    if high - low < 1 << KEYS_PER_WINDOW_BITS:
        return keys.select("k", F.lead("k").over(Window.orderBy("k")).alias("next"))
    bits = KEYS_PER_WINDOW_BITS
    parted = keys.selectExpr("k", f"shiftright(k, {bits}) AS p")
    firsts = parted.groupBy("p").agg(F.min("k").alias("first"))
    above = _following(firsts.selectExpr("p AS k"), low >> bits, high >> bits).selectExpr("k AS p", "next AS np")
    entry = above.join(firsts.selectExpr("p AS np", "first"), "np").select("p", "first")
    inside = parted.select("k", "p", F.lead("k").over(Window.partitionBy("p").orderBy("k")).alias("next"))
    return inside.join(entry, "p", "left").selectExpr("k", "coalesce(next, first) AS next")
