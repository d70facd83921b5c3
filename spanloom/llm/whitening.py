"""Embedding whitening by singular values: blockwise QR of the centred rows, Householder bidiagonalisation of R, its
singular values by dqds, and its right singular vectors, the whitening directions, by twisted factorisations.

The covariance is never formed to find them: the squared singular values of R over the number of rows are its
eigenvalues, and small ones keep their digits. Rows stay in Spark; what the driver holds is d x d, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

LARGEST_DIMENSION = 4096
FAN_IN = 32  # R factors that one task puts together
EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny
# A squared superdiagonal entry below this share of the value beside it moves no digit.
NEGLIGIBLE = (4 * EPS) ** 2
# Eigenvalues below this share of the largest are zero to rounding: such directions cannot be whitened.
LEAST_SHARE = 1e-20
# Singular values closer than this, relative to each other, are treated as one group when vectors are made.
GROUP_GAP = 1e-4


# --- d x d ----------------------------------------------------------------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of the upper bidiagonal U' r V, and V, by Householder reflections from both sides."""
    b = r.astype(float).copy()
    d = b.shape[1]
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        scale = np.abs(x).max(initial=0.0)
        if scale == 0:
            return None
        w = x / scale
        w[0] += np.copysign(np.linalg.norm(w), w[0])
        return w / np.linalg.norm(w)

    for j in range(d):
        if (w := reflector(b[j:, j])) is not None:
            b[j:, j:] -= 2 * np.outer(w, w @ b[j:, j:])
        if j < d - 2 and (w := reflector(b[j, j + 1 :])) is not None:
            b[j:, j + 1 :] -= 2 * np.outer(b[j:, j + 1 :] @ w, w)
            v[:, j + 1 :] -= 2 * np.outer(v[:, j + 1 :] @ w, w)
    return np.diagonal(b).copy(), np.diagonal(b, 1).copy(), v


def _dqds_step(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One differential qd transform with a shift: the new q and e, and the d of every place."""
    n = len(q)
    nq, ne, ds = np.empty(n), np.empty(n - 1), np.empty(n)
    d = q[0] - shift
    for i in range(n - 1):
        ds[i] = d
        nq[i] = d + e[i]
        if nq[i] == 0:  # d and e are zero: what follows starts anew
            ne[i], d = 0.0, q[i + 1] - shift
        else:
            t = q[i + 1] / nq[i]
            ne[i], d = e[i] * t, d * t - shift
    ds[n - 1] = nq[n - 1] = d
    return nq, ne, ds


def singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The singular values of the upper bidiagonal with diagonal a and superdiagonal b, ascending, to high relative
    accuracy: dqds on q = a^2 and e = b^2 with shifts that never pass the smallest value.

    The shift is 1 / sum(1 / d) of an unshifted transform: the d's inverses add up to the inverse's trace, so this is a
    lower bound of the smallest eigenvalue, and a Newton step towards it.
    """
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if scale == 0:
        return np.zeros(len(a))
    found: list[float] = []
    todo = [((a / scale) ** 2, (b / scale) ** 2, 0.0)]
    while todo:
        q, e, moved = todo.pop()
        while len(q):
            if len(q) == 1:
                found.append(moved + q[0])
                break
            if e[-1] <= NEGLIGIBLE * (moved + q[-1]) or e[-1] < TINY:
                found.append(moved + q[-1])
                q, e = q[:-1], e[:-1]
                continue
            # Between parts that hold each other by no more than rounding the matrix falls apart.
            cut = np.flatnonzero((e <= NEGLIGIBLE * (moved + q[1:])) | (e < TINY))
            if len(cut):
                at = int(cut[-1]) + 1
                todo.append((q[:at], e[: at - 1], moved))
                q, e = q[at:], e[at:]
                continue
            if 1.5 * q[0] < q[-1]:  # small values belong to the end: the same matrix, read from its other end
                q, e = q[::-1].copy(), e[::-1].copy()
            zq, ze, ds = _dqds_step(q, e, 0.0)
            if ds.min() <= TINY:
                q, e = zq, ze
                continue
            shift = (1 - 4 * len(q) * EPS) / (1 / ds).sum()
            nq, ne, ds = _dqds_step(q, e, shift)
            if ds.min() >= 0 and np.isfinite(nq).all():
                q, e, moved = nq, ne, moved + shift
            else:
                q, e = zq, ze
    return np.sort(np.sqrt(np.maximum(found, 0.0))) * scale


def _twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """The unit eigenvector of B'B at `value`: factor it from the top and from the bottom, join both where the middle
    pivot is least, and solve outward from there."""
    n = len(a)
    q, e, ab = a * a, b * b, a[:-1] * b
    down, up = np.empty(n), np.empty(n)
    lower, upper = np.empty(max(n - 1, 0)), np.empty(max(n - 1, 0))
    down[0] = -value
    for i in range(n - 1):
        pivot = down[i] + q[i]
        if pivot == 0:
            pivot = EPS * max(value, TINY)
        lower[i] = ab[i] / pivot
        down[i + 1] = lower[i] * (b[i] / a[i]) * down[i] - value
    up[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        pivot = e[i] + up[i + 1]
        if pivot == 0:
            pivot = EPS * max(value, TINY)
        upper[i] = ab[i] / pivot
        up[i] = up[i + 1] * (q[i] / pivot) - value
    middle = np.abs(down + up + value)
    r = int(np.nanargmin(middle))
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -upper[i] * z[i]
    return z / np.linalg.norm(z)


def _group_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors of B'B for values that lie close together: twisted factorisations at values spread a
    little apart span their space; solving once more and turning the basis to the values sharpens it."""
    n, m = len(a), len(values)
    if m == 1:
        return _twisted_vector(a, b, float(values[0]))[:, None]
    gram = _dense(a, b).T @ _dense(a, b)
    start = np.column_stack([_twisted_vector(a, b, float(x)) for x in values])
    basis = np.linalg.qr(start + 1e-3 * np.sin(np.arange(1, n * m + 1)).reshape(n, m))[0]
    shifted = gram - (float(values.mean()) * (1 + 8 * EPS) + TINY) * np.eye(n)
    for _ in range(4):
        basis = np.linalg.qr(np.linalg.solve(shifted, basis))[0]
    # Turned within the group, on B itself so that small values keep their digits.
    _, _, turn = np.linalg.svd(_dense(a, b) @ basis, full_matrices=False)
    return basis @ turn[::-1].T  # ascending


def _dense(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.diag(a) + (np.diag(b, 1) if len(b) else 0)


def directions(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The singular values of r, falling, and its right singular vectors as columns."""
    a, b, v = bidiagonal(r)
    d = len(a)
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if scale == 0:
        return np.zeros(d), np.eye(d)
    a, b = a / scale, b / scale
    # Where the superdiagonal vanishes to rounding the matrix falls into parts with vectors of their own.
    cuts = [0, *(np.flatnonzero(np.abs(b) <= EPS * EPS * (np.abs(a[:-1]) + np.abs(a[1:])) + TINY) + 1).tolist(), d]
    values, vectors = [], np.zeros((d, d))
    for first, last in zip(cuts[:-1], cuts[1:], strict=True):
        pa_, pb = a[first:last].copy(), b[first : last - 1]
        own = singular_values(pa_, pb)
        # A zero on the diagonal would divide: the least number instead changes nothing that double precision sees.
        pa_[np.abs(pa_) < 1e-150] = 1e-150
        squares = own**2
        start = 0
        for j in range(1, len(own) + 1):
            if j == len(own) or own[j] - own[j - 1] > GROUP_GAP * own[j]:
                vectors[first:last, first + start : first + j] = _group_vectors(pa_, pb, squares[start:j])
                start = j
        values += own.tolist()
    order = np.argsort(values, kind="stable")[::-1]
    return np.array(values)[order] * scale, (v @ vectors)[:, order]


# --- rows -----------------------------------------------------------------------------------------------------------


@dataclass
class Whitening:
    """`offset` and `n`: x is centred as (n * x - offset) / n. `directions`: d x c, one column per component."""

    n: int
    offset: np.ndarray
    eigenvalues: np.ndarray
    directions: np.ndarray
    trace: float


def integer_vectors(df: DataFrame, column: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """(vec_id, x): vectors without null and non-finite components, each component c turned into floor(scale * c) + shift.

    Vectors of another length than most have (of as many, the longest) are left out, as no covariance spans two lengths.
    A component beyond 2^52 is an error: its place value is lost in a double already.
    """
    whole = f"forall(`{column}`, c -> c IS NOT NULL AND NOT isnan(c) AND abs(CAST(c AS DOUBLE)) < double('Infinity'))"
    scaled = f"""transform(`{column}`, c -> CASE WHEN abs({scale}D * CAST(c AS DOUBLE)) <= {1 << 52}D
      THEN CAST(floor({scale}D * CAST(c AS DOUBLE)) AS BIGINT) + {shift}L ELSE raise_error('component too large') END)"""
    kept = df.where(f"`{column}` IS NOT NULL AND size(`{column}`) > 0 AND coalesce({whole}, false)")
    lengths = kept.groupBy(F.expr(f"size(`{column}`)").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return df.sparkSession.createDataFrame([], "vec_id bigint, x array<bigint>")
    if lengths.d > LARGEST_DIMENSION:
        raise ValueError(f"at most {LARGEST_DIMENSION} dimensions, not {lengths.d}")
    return kept.where(f"size(`{column}`) = {lengths.d}").selectExpr("CAST(vec_id AS BIGINT) AS vec_id", f"{scaled} AS x")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: the number of rows at place 0, then the sums of the components as decimals."""
    total: np.ndarray | None = None
    for batch in batches:
        if len(batch):
            x = _matrix(batch["x"])
            # Halves of 32 bits: neither sum can overflow.
            own = [len(x), *(int(h) * (1 << 32) + int(l) for h, l in zip((x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0), strict=True))]
            total = np.array(own, object) if total is None else total + np.array(own, object)
    if total is not None:
        sums = pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), sums], names=["place", "total"])


def centred(x: np.ndarray, n: int, offset: np.ndarray) -> np.ndarray:
    """x - offset / n in double precision, with no digits lost to a large common part."""
    return (x - offset // n) - (offset % n).astype(float) / n


def _r_of(rows: np.ndarray) -> np.ndarray:
    """A square R with the same R'R, from any number of rows."""
    d = rows.shape[1]
    if len(rows) < d:
        rows = np.vstack([rows, np.zeros((d - len(rows), d))])
    return np.linalg.qr(rows, mode="r")


def _block_factors(n: int, offset: np.ndarray):
    """Per task, the R factor of its centred rows, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r: np.ndarray | None = None
        for batch in batches:
            if len(batch):
                rows = centred(_matrix(batch["x"]), n, offset)
                r = _r_of(rows if r is None else np.vstack([r, rows]))
        if r is not None:
            yield pa.RecordBatch.from_pydict({"r": [r.ravel().tolist()]})

    return run


def _joined_factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    r: np.ndarray | None = None
    for batch in batches:
        for flat in batch["r"]:
            own = np.asarray(flat.values.to_numpy())
            own = own.reshape(int(round(len(own) ** 0.5)), -1)
            r = own if r is None else _r_of(np.vstack([r, own]))
    if r is not None:
        yield pa.RecordBatch.from_pydict({"r": [r.ravel().tolist()]})


def fit(vectors: DataFrame, components: int) -> Whitening | None:
    """Fit (vec_id, x) by passes over the rows: exact sums, then R factors that are put together FAN_IN at a time until
    one is left. None without rows. Components of a covariance that is zero to rounding in their direction are left out."""
    totals = vectors.mapInArrow(_totals, "place bigint, total decimal(38, 0)").groupBy("place").agg(F.expr("CAST(sum(total) AS DECIMAL(38, 0))").alias("total"))
    sums = {r.place: int(r.total) for r in totals.collect()}
    if not sums:
        return None
    n, offset = sums[0], np.array([sums[i] for i in range(1, len(sums))], np.int64)
    factors = written(vectors.mapInArrow(_block_factors(n, offset), "r array<double>"), "factors")
    while (left := factors.count()) > 1:
        factors = written(factors.repartition(-(-left // FAN_IN)).mapInArrow(_joined_factors, "r array<double>"), "factors")
    flat = np.array(factors.first().r)
    r = flat.reshape(len(offset), len(offset))
    values, vectors_ = directions(r)
    eigenvalues = values**2 / n
    kept = [j for j in range(min(components, len(values))) if values[j] > 0 and eigenvalues[j] > LEAST_SHARE * eigenvalues[0]]
    return Whitening(n, offset, eigenvalues[kept], vectors_[:, kept], float((r**2).sum() / n))


def _whitened(model: Whitening):
    scales = model.directions / np.sqrt(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = scales.shape[1]
        for batch in batches:
            x = _matrix(batch["x"])
            whitened = centred(x, model.n, model.offset) @ scales
            lists = pa.ListArray.from_arrays(np.arange(0, c * len(x) + 1, c, np.int32), pa.array(whitened.ravel()))
            yield pa.RecordBatch.from_arrays([batch["vec_id"], _deviations(x, model), lists], names=["vec_id", "deviation", "whitened"])

    return run


def _deviations(x: np.ndarray, model: Whitening) -> pa.Array:
    """Sum over the dimensions of (n * x - offset)^2, exact; null where it does not fit 64 bits."""
    far = np.abs(x.astype(float) - model.offset / model.n).max(initial=0.0) * model.n
    if len(x) and x.shape[1] * far * far < 2**62 and np.abs(x).max() * float(model.n) < 2**62:
        return pa.array(((model.n * x - model.offset) ** 2).sum(1))
    wide = ((model.n * x.astype(object) - model.offset.astype(object)) ** 2).sum(1) if len(x) else []
    return pa.array([int(t) if t < 1 << 63 else None for t in wide], pa.int64())


def _products(model: Whitening):
    """Per task, the sum of the outer products of the whitened rows, flattened."""
    scales = model.directions / np.sqrt(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = scales.shape[1]
        total = np.zeros((c, c))
        for batch in batches:
            w = centred(_matrix(batch["x"]), model.n, model.offset) @ scales
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(c * c)), pa.array(total.ravel())], names=["place", "total"])

    return run


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, measured over all rows."""
    c = len(model.eigenvalues)
    sums = vectors.mapInArrow(_products(model), "place bigint, total double").groupBy("place").agg(F.sum("total").alias("total"))
    covariance = np.zeros(c * c)
    for r in sums.collect():
        covariance[r.place] = r.total / model.n
    return float(np.abs(covariance.reshape(c, c) - np.eye(c)).max(initial=0.0))


RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whitened(df: DataFrame, column: str = "embedding", *, components: int = 32, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """One row per usable vector and component (from 1, by falling eigenvalue): the centred vector along the component's
    direction over the root of its eigenvalue, with the eigenvalue's share of the trace.

    Rows whose vector is null, empty, of an unusual length, or holds a null, NaN or infinity are left out; a vec_id may be
    null or repeated, and repeated rows count as often as they occur. Directions in which nothing varies have no
    component, so equal vectors only, or a single one, give no rows. No vectors give no rows. Other columns are not read.
    """
    vectors = integer_vectors(df.select("vec_id", column), column, scale, shift)
    model = fit(vectors, components)
    if model is None or not len(model.eigenvalues):
        return df.sparkSession.createDataFrame([], RESULT)
    error = identity_error(vectors, model)
    shares = ", ".join(f"double('{x!r}')" for x in (model.eigenvalues / model.trace).tolist())
    rows = vectors.mapInArrow(_whitened(model), "vec_id bigint, deviation bigint, whitened array<double>")
    return rows.selectExpr("vec_id", "deviation", "posexplode(whitened) AS (pos, whitened)").selectExpr(
        "vec_id",
        "CAST(pos + 1 AS INT) AS component",
        f"{model.n}L AS n",
        "deviation",
        "whitened",
        f"element_at(array({shares}), pos + 1) AS explained",
        f"double('{error!r}') AS identity_error",
    )
