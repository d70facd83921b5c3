"""Exact Lloyd clustering of integer vectors with ns-bounds.

Each vector keeps, for every centroid, its distance to it at the round in which it was last worked out, and that round.
The centroids of all rounds are kept, so a stored distance is loosened by how far the centroid has moved since that
round in total, not by the sum of its moves. Only vectors whose bounds do not settle their cluster are looked at again,
and only against the centroids that may be nearer, with exact integer distances.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_scratch, remove_scratch

# Integer components up to this size have squared distances that fit 64 bits, at LARGEST_DIMENSION too.
LARGEST_COMPONENT = 1 << 26
LARGEST_DIMENSION = 256
# Room for rounding in the comparison of bounds; nothing is settled by less than this share.
MARGIN = 1e-9
ROWS_PER_BLOCK = 4096

STATE = "vec_id bigint, x array<bigint>, prior int, cluster int, bounds array<double>, rounds array<int>"


@dataclass
class Model:
    """Centroids of all rounds, each a (k, d) array of integers."""

    history: list[np.ndarray] = field(default_factory=list)
    n_vectors: int = 0

    @property
    def centroids(self) -> np.ndarray:
        return self.history[-1]

    def moved(self) -> np.ndarray:
        """(rounds, k): the norm of each centroid's displacement from a round to the newest."""
        return np.sqrt(np.stack([((self.centroids - past).astype(float) ** 2).sum(1) for past in self.history]))

    def digests(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids.tolist()]


def integer_vectors(df: DataFrame, column: str = "embedding", scale: int = 1024, dimension: int = 64) -> DataFrame:
    """(vec_id, x): vectors of exactly `dimension` components, none null or non-finite, each turned into
    floor(scale * component). Other rows are left out; repeated rows stay. A component beyond LARGEST_COMPONENT is an
    error, since squared distances would not fit a bigint."""
    if dimension > LARGEST_DIMENSION:
        raise ValueError(f"at most {LARGEST_DIMENSION} dimensions")
    whole = f"forall(`{column}`, c -> c IS NOT NULL AND NOT isnan(c) AND abs(CAST(c AS DOUBLE)) < double('Infinity'))"
    scaled = f"""transform(`{column}`, c -> CASE WHEN abs({scale}D * CAST(c AS DOUBLE)) <= {LARGEST_COMPONENT}D
      THEN CAST(floor({scale}D * CAST(c AS DOUBLE)) AS BIGINT) ELSE raise_error('component too large for exact distances') END)"""
    return df.where(f"`{column}` IS NOT NULL AND size(`{column}`) = {dimension} AND coalesce({whole}, false)").selectExpr("CAST(vec_id AS BIGINT) AS vec_id", f"{scaled} AS x")


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[np.ndarray]:
    """The k vectors with the smallest sha256 of "seed:vec_id" (a null id counts as empty); equal ids by their components."""
    ordered = vectors.selectExpr("x", f"sha2(concat('{seed}:', coalesce(CAST(vec_id AS STRING), '')), 256) AS h")
    return [np.array(r.x, np.int64) for r in ordered.orderBy("h", "x").limit(k).collect()]


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """A list column without nulls, whose lists have one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def distances(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Squared distances of rows to a centroid, or to a centroid each: exact integers."""
    return ((x - centroid) ** 2).sum(1)


def assign(x: np.ndarray, cluster: np.ndarray, bounds: np.ndarray, rounds: np.ndarray, model: Model) -> int:
    """Update cluster, bounds and rounds in place to the newest centroids; the number of distances worked out.

    `cluster` is -1 for rows never assigned. Ties go to the smaller centroid number.
    """
    now, k = len(model.history) - 1, len(model.centroids)
    every, moved = np.arange(k), model.moved()
    known = cluster >= 0
    drift = moved[rounds, every]
    nearest_possible = np.where(known[:, None], bounds - drift, -1.0)
    own = np.maximum(cluster, 0)
    at = np.arange(len(x))
    farthest = np.where(known, bounds[at, own] + drift[at, own], np.inf)
    others = every != own[:, None]
    open_ = ~(nearest_possible * (1 - MARGIN) > farthest[:, None] * (1 + MARGIN)) & others
    # First the distance to the own centroid becomes exact; often that settles it.
    rows = np.flatnonzero(open_.any(1))
    if not len(rows):
        return 0
    worked = len(rows)
    exact = np.full((len(rows), k), np.iinfo(np.int64).max)
    exact[np.arange(len(rows)), own[rows]] = distances(x[rows], model.centroids[own[rows]])
    bounds[rows, own[rows]] = np.sqrt(exact[np.arange(len(rows)), own[rows]])
    rounds[rows, own[rows]] = now
    tight = bounds[rows, own[rows]]
    open_ = open_[rows] & ~(nearest_possible[rows] * (1 - MARGIN) > tight[:, None] * (1 + MARGIN))
    for j in range(k):
        asked = np.flatnonzero(open_[:, j])
        if len(asked):
            exact[asked, j] = distances(x[rows[asked]], model.centroids[j])
            bounds[rows[asked], j] = np.sqrt(exact[asked, j])
            rounds[rows[asked], j] = now
            worked += len(asked)
    cluster[rows] = exact.argmin(1)  # the first of several least
    return worked


def _assign_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.centroids)
        for whole in batches:
            for start in range(0, len(whole), ROWS_PER_BLOCK):
                batch = whole.slice(start, ROWS_PER_BLOCK)
                x = _matrix(batch["x"], np.int64)
                prior = batch["cluster"].to_numpy(zero_copy_only=False).astype(np.int32)
                new = prior < 0
                if new.all():
                    bounds, rounds = np.zeros((len(x), k)), np.zeros((len(x), k), np.int32)
                else:
                    bounds, rounds = _matrix(batch["bounds"], float).copy(), _matrix(batch["rounds"], np.int32).copy()
                cluster = prior.copy()
                assign(x, cluster, bounds, rounds, model)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["vec_id"],
                        batch["x"],
                        pa.array(prior),
                        pa.array(cluster),
                        pa.ListArray.from_arrays(np.arange(0, k * len(x) + 1, k, np.int32), pa.array(bounds.ravel())),
                        pa.ListArray.from_arrays(np.arange(0, k * len(x) + 1, k, np.int32), pa.array(rounds.ravel())),
                    ],
                    names=["vec_id", "x", "prior", "cluster", "bounds", "rounds"],
                )

    return run


def _stored(state: DataFrame) -> tuple[DataFrame, str]:
    """A round's table, written into the shared folder and read again, and its path."""
    path = new_scratch(state.sparkSession, "centroids")
    state.write.parquet(path)
    return state.sparkSession.read.schema(STATE).parquet(path), path


def _changes(k: int, d: int):
    """Per task, what each cluster gained since the last round: vectors and component sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, d + 1), np.int64)
        for batch in batches:
            x = np.column_stack([_matrix(batch["x"], np.int64), np.ones(len(batch), np.int64)])
            prior, cluster = (batch[c].to_numpy(zero_copy_only=False) for c in ("prior", "cluster"))
            for j in range(k):
                total[j] += x[cluster == j].sum(0) - x[prior == j].sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["place", "gained"])

    return run


def fit(vectors: DataFrame, k: int, rounds: int, seed: int) -> tuple[DataFrame | None, Model]:
    """Cluster (vec_id, x): the table with each vector's last cluster, and the centroids of all rounds.

    Every round reads the table of the one before, writes its own into the shared folder and removes the older one, so at
    most two are kept and a lost executor costs one round's tasks. Sums change by the vectors that moved only: exact
    integers, added up per task first; the k x (d + 1) totals are all that reaches the driver. None without vectors.
    """
    first = first_centroids(vectors, k, seed)
    if not first:
        return None, Model()
    model = Model([np.stack(first)])
    k, d = model.centroids.shape
    state = vectors.selectExpr(
        "vec_id", "x", "-1 AS prior", "-1 AS cluster", "CAST(array() AS ARRAY<DOUBLE>) AS bounds", "CAST(array() AS ARRAY<INT>) AS rounds"
    )
    total = np.zeros((k, d + 1), dtype=object)
    older = None
    for turn in range(rounds + 1):
        state, path = _stored(state.mapInArrow(_assign_batches(model), STATE))
        if older:
            remove_scratch(vectors.sparkSession, older)
        older = path
        if turn == rounds:
            break
        moved = state.where("prior <> cluster").select("x", "prior", "cluster")
        gained = moved.mapInArrow(_changes(k, d), "place bigint, gained bigint").groupBy("place").agg(F.expr("sum(CAST(gained AS DECIMAL(38, 0)))").alias("gained"))
        for r in gained.collect():
            total[r.place // (d + 1), r.place % (d + 1)] += int(r.gained)
        model.history.append(
            np.array([[s // row[d] for s in row[:d]] if row[d] else past for row, past in zip(total.tolist(), model.centroids.tolist(), strict=True)], np.int64)
        )
    model.n_vectors = int(sum(total[:, d]))
    return state, model


def _final_distances(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = batch["cluster"].to_numpy(zero_copy_only=False)
            far = distances(_matrix(batch["x"], np.int64), centroids[cluster]) if len(batch) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["cluster"], pa.array(far)], names=["vec_id", "cluster", "distance"])

    return run


RESULT = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def clustered(df: DataFrame, column: str = "embedding", *, k: int = 8, rounds: int = 10, seed: int = 3, scale: int = 1024, dimension: int = 64) -> DataFrame:
    """One row per vector of `dimension` finite components: its cluster after `rounds` rounds of Lloyd's algorithm, its
    squared distance to that centroid, the distances summed over its cluster and over all, and the centroid's digest.

    Rows whose vector is null, of another length, or holds a null, NaN or infinity are left out; a vec_id may be null or
    repeated, and repeated rows count as often as they occur. Fewer vectors than k give as many clusters. Equal distances
    go to the smaller number. No vectors give no rows. Other columns are not read.
    """
    state, model = fit(integer_vectors(df.select("vec_id", column), column, scale, dimension), k, rounds, seed)
    if state is None:
        return df.sparkSession.createDataFrame([], RESULT)
    far = state.select("vec_id", "x", "cluster").mapInArrow(_final_distances(model.centroids), "vec_id bigint, cluster int, distance bigint")
    # One row per cluster: sums per task first, then k numbers.
    inertia = {r.cluster: int(r.inertia) for r in far.groupBy("cluster").agg(F.expr("sum(CAST(distance AS DECIMAL(38, 0)))").alias("inertia")).collect()}

    def by_cluster(values: list[str]) -> str:
        return f"element_at(array({', '.join(values)}), cluster + 1)"

    return far.selectExpr(
        "vec_id",
        "cluster",
        "distance",
        by_cluster([f"{inertia.get(j, 0)}L" for j in range(len(model.centroids))]) + " AS cluster_inertia",
        f"{sum(inertia.values())}L AS inertia",
        by_cluster([f"'{h}'" for h in model.digests()]) + " AS centroid_sha256",
    )
