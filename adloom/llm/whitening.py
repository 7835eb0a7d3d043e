"""Whitening of vectors by refined principal components.

Entries become integers, x = floor(scale · c) + shift, so that sums and the covariance of the distinct vectors are exact whatever
the partitioning. The covariance is summed where the vectors are; its eigenvectors start from a float32 decomposition and are
corrected by Ogita-Aishima iterations, matrix multiplications in extended precision whose error squares with every step. Eigenvalues
that a step cannot tell apart form a cluster: its subspace gets a solve of its own, shifted by the cluster's centre, and a rotation.

Rows whose vector is null, empty or holds null or non-finite entries are dropped, and so are vectors whose length is not the
commonest one (of equally common ones the longest). Repeated rows and equal vectors under several ids give a row each, but count
once in the fit. Entries beyond the range of a long take its bounds. Components whose eigenvalue is zero (at most ``ZERO`` of the
trace) have null coordinates and take no part in the identity error. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from adloom.session import materialize

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
# Rows multiplied at once; with entries below 2^LIMB_BITS the products of so many rows sum exactly in a double.
ROWS, LIMB_BITS = 2048, 21
ZERO = 1e-16
ITERATIONS = 12
LARGEST = (1 << 63) - 1
# Sums travel as multiples of this number and the rest, either of which fits a decimal.
SPLIT = 10**18


class Fit(NamedTuple):
    """What the distinct vectors say: their number, sums, components (columns) with eigenvalues, and the quality."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None


def whole(vector: Column) -> Column:
    """Entries as integers."""
    return F.transform(vector, lambda c: F.least(F.floor(c.cast("double") * SCALE), F.lit(LARGEST - SHIFT)) + SHIFT)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(_id, x) of the rows that take part, stored."""
    finite = F.forall(F.col(vector_col), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = df.where(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).where(finite)
    rows = materialize(rows.select(F.col(id_col).alias("_id"), whole(F.col(vector_col)).alias("x")), "vectors")
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == sizes["d"]) if sizes else rows


def matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _summed(df: DataFrame, fn: Callable[[np.ndarray], np.ndarray]) -> dict[int, int]:
    """Exact totals, by place, of the flat integer vectors that ``fn`` makes of each block of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for block in blocks(batches):
            total = total + fn(matrix(block.column("x"))).astype(object)
        if not isinstance(total, int):
            high, low = zip(*(divmod(int(v), SPLIT) for v in total), strict=True)
            number = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int64()), *(pa.array(list(map(Decimal, v)), number) for v in (high, low))], ["place", "high", "low"])

    out = df.select("x").mapInArrow(run, "place long, high decimal(38,0), low decimal(38,0)")
    return {r.place: int(r.high) * SPLIT + int(r.low) for r in out.groupBy("place").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()}


def less(x: np.ndarray, base: list[int]) -> np.ndarray:
    """x − base; as unbounded integers where a long might not hold it."""
    if np.abs(x.astype(np.float64)).max(initial=0) < 1 << 61:
        return x - np.array(base, np.int64)
    return x.astype(object) - np.array(base, object)


def products(y: np.ndarray) -> np.ndarray:
    """Yᵀ Y, exact, as integers: whole numbers are cut into limbs whose products a double holds."""
    if not y.size or int(np.abs(y).max()) < 1 << LIMB_BITS:
        z = y.astype(np.float64)
        return (z.T @ z).astype(np.int64)
    limbs, sign = [], np.sign(y.astype(object))
    rest = y.astype(object) * sign
    while (rest > 0).any():
        limbs.append((rest % (1 << LIMB_BITS) * sign).astype(np.float64))
        rest = rest // (1 << LIMB_BITS)
    return sum((a.T @ b).astype(np.int64).astype(object) * (1 << LIMB_BITS * (i + j)) for i, a in enumerate(limbs) for j, b in enumerate(limbs))


def refined(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix in extended precision."""
    a = a.astype(np.longdouble)
    d = len(a)
    scale = np.abs(a).max() or np.longdouble(1)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(np.longdouble)
    eye = np.eye(d, dtype=np.longdouble)
    norm, last, stalled = np.abs(a).sum(1).max(), np.inf, 0
    for _ in range(ITERATIONS):
        r, s = eye - x.T @ x, x.T @ a @ x
        r, s = (r + r.T) / 2, (s + s.T) / 2
        value = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(value)
        delta = 2 * (np.abs(off).sum(1).max() + norm * np.abs(r).sum(1).max())
        gap = value[None, :] - value[:, None]
        apart = np.abs(gap) > delta
        e = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        # Runs of eigenvalues nearer than delta: solve within their subspace, around their centre.
        order = np.argsort(-value, kind="stable")
        x, value = x[:, order], value[order]
        edges = np.flatnonzero(np.r_[True, value[:-1] - value[1:] > delta, True])
        for i, k in zip(edges[:-1], edges[1:], strict=True):
            if k - i > 1:
                sub = x[:, i:k]
                for _ in range(2):  # Towards orthonormal columns, whose error squares too.
                    sub = sub @ (3 * eye[: k - i, : k - i] - sub.T @ sub) / 2
                b = sub.T @ (a @ sub - value[i:k].mean() * sub)
                size = np.abs(b).max()
                if size > 0:
                    w = np.linalg.eigh(((b + b.T) / (2 * size)).astype(np.float64))[1][:, ::-1].astype(np.longdouble)
                    # The float64 rotation is made orthogonal to extended precision.
                    x[:, i:k] = sub @ (w @ (3 * eye[: k - i, : k - i] - w.T @ w) / 2)
        change = np.abs(e).max()
        stalled = stalled + 1 if change >= last / 2 else 0
        if change < 1e-18 or stalled > 1:
            break
        last = change
    x = x @ (3 * eye - x.T @ x) / 2
    x = x / np.sqrt((x * x).sum(0))
    value = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-value, kind="stable")
    x, value = x[:, order], value[order] * scale
    # The largest entry is positive.
    return value, x * np.sign(x[np.abs(x).argmax(0), np.arange(d)])


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Fit the distinct vectors of ``usable`` rows; None where there are none. The covariance, whose size is the square of the
    dimension, is all that the driver sees."""
    distinct = materialize(rows.select("x").distinct(), "fit")
    # Entries before the last are sums; the last counts the vectors. Halves keep sums of large entries exact.
    half = np.int64(1 << 32)
    counted = _summed(distinct, lambda x: np.r_[(x // half).sum(0).astype(object) * (1 << 32) + (x % half).sum(0), np.array([len(x)], object)])
    if not counted:
        return None
    d, n = len(counted) - 1, counted[len(counted) - 1]
    sums = [counted[i] for i in range(d)]
    base = [s // n for s in sums]
    rest = [s - n * b for s, b in zip(sums, base, strict=True)]
    upper = np.triu_indices(d)
    cross = _summed(distinct, lambda x: products(less(x, base))[upper])
    covariance = np.zeros((d, d), np.longdouble)
    for place, (i, j) in enumerate(zip(*upper, strict=True)):
        top, bottom = n * cross[place] - rest[i] * rest[j], n * n
        whole_part, part = divmod(top, bottom)
        covariance[i, j] = covariance[j, i] = np.longdouble(whole_part) + np.longdouble(part) / np.longdouble(bottom)
    values, vectors = refined(covariance)
    k = min(components, d)
    trace = float(np.trace(covariance))
    found = Fit(n, sums, vectors[:, :k].astype(np.float64), values[:k].astype(np.float64), trace, None)
    return found._replace(identity_error=_identity_error(distinct, found))


def coordinates(x: np.ndarray, model: Fit) -> np.ndarray:
    """Whitened coordinates of integer vectors; null ones are NaN."""
    base = np.array([s // model.n for s in model.sums], np.float64)
    rest = np.array([s % model.n / model.n for s in model.sums])
    live = model.values > ZERO * model.trace
    weight = model.vectors / np.sqrt(np.where(live, model.values, np.nan))
    return (x.astype(np.float64) - base - rest) @ weight


def _identity_error(distinct: DataFrame, model: Fit) -> float | None:
    """Largest entry of the covariance of the fit list's coordinates minus the identity."""
    live = np.flatnonzero(model.values > ZERO * model.trace)
    if not len(live):
        return None
    k = len(live)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for block in blocks(batches):
            z = np.c_[coordinates(matrix(block.column("x")), model)[:, live], np.ones(block.num_rows)]
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int64()), pa.array(total.ravel())], ["place", "total"])

    totals = distinct.mapInArrow(run, "place long, total double").groupBy("place").agg(F.sum("total").alias("total")).collect()
    second = np.zeros((k + 1) ** 2)
    for r in totals:
        second[r.place] = r.total
    second = second.reshape(k + 1, k + 1) / model.n
    return float(np.abs(second[:k, :k] - np.outer(second[:k, k], second[k, :k]) - np.eye(k)).max())


def deviations(x: np.ndarray, model: Fit) -> list[int | None]:
    """Sum over dimensions of (n · x − S)², exact; null beyond the range of a long."""
    base = [s // model.n for s in model.sums]
    rest = [s - model.n * b for s, b in zip(model.sums, base, strict=True)]
    y = less(x, base)
    bound = model.n * (int(np.abs(y).max(initial=0)) + 1)
    if bound * bound * x.shape[1] <= LARGEST:
        z = y * model.n - np.array(rest)
        return np.einsum("ij,ij->i", z, z)
    z = y.astype(object) * model.n - np.array(rest, object)
    return [v if v <= LARGEST else None for v in (z * z).sum(1).tolist()]


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(``id_col``, n, deviation, whitened, explained, identity_error): one row for each vector that takes part.

    ``whitened`` holds its coordinates on the first ``components`` components by falling eigenvalue, ``explained`` the share of each
    component in the trace (null where that is zero).
    """
    kind = df.schema[id_col].dataType.simpleString()
    schema = _parse_datatype_string(f"_id {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double")
    rows = usable(df, id_col, vector_col)
    model = fit(rows, components)
    if model is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("_id", id_col)
    arrow = to_arrow_schema(schema)
    explained = [float(v / model.trace) if model.trace > 0 else None for v in model.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            x, size = matrix(block.column("x")), block.num_rows
            z = coordinates(x, model)
            flat = pa.array(z.ravel(), from_pandas=True)
            offsets = pa.array(np.arange(size + 1, dtype=np.int32) * z.shape[1])
            shares = pa.ListArray.from_arrays(offsets, pa.array(explained * size, pa.float64()))
            out = [block.column("_id"), pa.array([model.n] * size), pa.array(deviations(x, model), pa.int64()), pa.ListArray.from_arrays(offsets, flat), shares, pa.array([model.identity_error] * size, pa.float64())]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(out, arrow, strict=True)], schema=arrow)

    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
