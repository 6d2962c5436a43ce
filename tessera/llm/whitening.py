"""Whitened embeddings from an exact integer covariance (bit-sliced scatter).

Vectors become whole numbers. A task packs the bit planes of each dimension, shifted to
start at zero, across rows into 64-bit words; the number of common bits of two planes times
two to the sum of their places, added over all plane pairs, is the exact cross-product of two
dimensions. Sums over tasks are exact decimals, the covariance is centred as a whole number
and rounded once, and only its eigenvectors are floating point.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise

#: A vector entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Components returned, and rows that are bit-sliced at a time (64 words a plane).
COMPONENTS, BLOCK_ROWS = 16, 4096
#: Components whose eigenvalue is below this part of the largest one are rounding, not variance.
LEAST_PART = 1e-11
# Cross-products travel as two decimals, high * 2^60 + low, each far from decimal's 38 digits.
_LOW = 1 << 60


def whole_vector(vector: Column) -> Column:
    """Array of longs; null where the vector or an entry is null, not finite or beyond 2^56
    (a long can't hold it)."""
    fit = F.forall(vector, lambda c: F.abs(c.cast("double")) < float(1 << 56))
    return F.when(fit, F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT))


def planes_of(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, dimension, place) of the bit planes of a non-negative (rows, dims) block: one
    row of 64-bit words per plane, ordered by dimension; planes without a bit are left out."""
    rows, dims = y.shape
    top = int(y.max()).bit_length() if y.size else 0
    pad = -rows % 64
    packed = np.empty((dims, top, (rows + pad) // 64), np.uint64)
    for b in range(top):
        bits = ((y >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        packed[:, b] = np.packbits(np.pad(bits, ((0, pad), (0, 0))).T.copy(), axis=1).view(np.uint64)
    used = packed.any(axis=2)
    dim, place = np.nonzero(used)
    return packed[used], dim, place


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, cross-products) of the columns of a block of longs, exact (Python ints)."""
    rows, dims = x.shape
    low = x.min(axis=0)
    words, dim, place = planes_of((x - low).view(np.uint64))
    common = np.zeros((len(words), len(words)), np.int64)
    for p in range(len(words)):
        common[p, p:] = np.bitwise_count(words[p:] & words[p]).sum(axis=1, dtype=np.int64)
    common += np.triu(common, 1).T
    # small places: the weighted counts of a block fit a long; else Python's whole numbers
    kind = np.int64 if 2 * int(place.max(initial=0)) + 2 + rows.bit_length() < 62 else object
    weight = np.array([1 << int(b) for b in place], kind)
    weighted = common.astype(kind) * weight[:, None] * weight[None, :]
    cross, sums = np.zeros((dims, dims), object), np.zeros(dims, object)
    if len(dim):
        starts = np.flatnonzero(np.r_[True, dim[1:] != dim[:-1]])
        at = dim[starts]
        by_dim = np.add.reduceat(np.add.reduceat(weighted, starts, axis=0), starts, axis=1)
        cross[np.ix_(at, at)] = by_dim.astype(object)
        sums[at] = np.add.reduceat(np.diag(common).astype(kind) * weight, starts).astype(object)
    # undo the shift: x = low + y
    low = low.astype(object)
    cross = cross + np.outer(low, sums) + np.outer(sums, low) + rows * np.outer(low, low)
    return sums + rows * low, cross


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


@dataclass
class Whitening:
    """``sums`` and ``n`` of the fit list, unit ``vectors`` (dims x components) by falling
    ``values``; ``trace`` of the covariance."""

    n: int
    dims: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def deviations(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """(x - mean, sum over the dimensions of (n x - S)^2; null beyond a long)."""
        base = np.array([round(s / self.n) for s in self.sums], object)
        rest = np.array([s - self.n * b for s, b in zip(self.sums, base)], object)
        near = x - base.astype(np.int64)
        most = max(1, int(np.abs(near).max(initial=0)) + 1) * self.n
        if most * most * self.dims < 1 << 62:
            d = near * self.n - rest.astype(np.int64)
            squares = (d * d).sum(axis=1).tolist()
        else:
            d = near.astype(object) * self.n - rest
            squares = [v if v < 1 << 63 else None for v in (d * d).sum(axis=1).tolist()]
        return np.asarray(d / self.n, dtype=float).reshape(x.shape), squares

    def project(self, centred: np.ndarray) -> np.ndarray:
        return (centred @ self.vectors) / np.sqrt(self.values)


def fit_list(docs: DataFrame, vector_col: str) -> DataFrame:
    """(x, size): every distinct whole vector once, copies combined per task first; stored."""
    x = whole_vector(docs[vector_col])
    return materialise(docs.select(x.alias("x")).filter("x IS NOT NULL").distinct()
                       .select("x", F.size("x").alias("size")), "fit-list")


def fit(fitted: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a ``fit_list``; None where it is empty. The driver gets dims^2 numbers."""
    sizes = fitted.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if sizes is None or not sizes["size"]:
        return None
    dims = sizes["size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            for lo in range(0, len(x), BLOCK_ROWS):
                s, c = scatter(x[lo:lo + BLOCK_ROWS])
                sums, cross = sums + s, cross + c
            n += len(x)
        if not n:
            return
        i, j = np.triu_indices(dims)
        rows = [(-1, -1, n), *((-1, k, v) for k, v in enumerate(sums)), *zip(i.tolist(), j.tolist(), cross[i, j])]
        digits = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([Decimal(int(r[2]) // _LOW) for r in rows], digits),
             pa.array([Decimal(int(r[2]) % _LOW) for r in rows], digits)], names=["i", "j", "high", "low"])

    parts = fitted.filter(F.col("size") == dims).select("x").mapInArrow(
        run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    total = {(r["i"], r["j"]): int(r["h"]) * _LOW + int(r["l"])
             for r in parts.groupBy("i", "j").agg(F.sum("high").alias("h"), F.sum("low").alias("l")).collect()}
    n = total[-1, -1]
    sums = [total[-1, k] for k in range(dims)]
    v = np.zeros((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            v[i, j] = v[j, i] = (n * total[i, j] - sums[i] * sums[j]) / (n * n)  # whole numbers, one rounding
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = min(components, int((values > LEAST_PART * max(values[0], 0)).sum()) if values[0] > 0 else 0)
    vectors = vectors[:, :keep].copy()
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(keep)])
    return Whitening(n, dims, sums, vectors * signs, values[:keep].copy(), float(np.trace(v)))


def identity_error(fitted: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity,
    from one more pass over the fit list."""
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cross = np.zeros((k, k))
        for batch in batches:
            w = model.project(model.deviations(_matrix(batch.column(0), model.dims))[0])
            cross += w.T @ w
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(cross[i, j])],
                                         names=["i", "j", "v"])

    sums = (fitted.filter(F.col("size") == model.dims).select("x").mapInArrow(run, "i int, j int, v double")
            .groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    return max((abs(r["v"] / model.n - (r["i"] == r["j"])) for r in sums), default=0.0)


def whiten_vectors(docs: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                   components: int = COMPONENTS) -> DataFrame:
    """One row per kept row of ``docs`` and component: vec_id, component (from 1, by falling
    eigenvalue), n (distinct vectors of the fit), deviation, whitened, explained, identity_error.

    Rows are dropped whose vector is null, holds a null or not finite entry or one beyond 2^56,
    or has another length than most distinct vectors (of equally frequent lengths the longer).
    Copies count once in the fit and are all returned; null ids are carried, repeated ids stay.
    Components without variance (the eigenvalue is rounding) don't exist: fewer than
    ``components`` are returned then, none where all vectors are equal. Components of equal
    eigenvalue come in any basis of theirs. ``deviation`` is null where a long can't hold it.
    Empty table: empty result. Other columns are not read."""
    id_type = docs.select(docs[id_col]).schema[0].dataType.simpleString()
    schema = (f"vec_id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    fitted = fit_list(docs, vector_col)
    model = fit(fitted, components)
    k = len(model.values) if model else 0
    if not k:
        return docs.sparkSession.createDataFrame([], schema)
    error = identity_error(fitted, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        explained = model.values / model.trace
        for batch in batches:
            rows = batch.num_rows
            centred, squares = model.deviations(_matrix(batch.column(1), model.dims))
            at = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                 pa.array(np.full(rows * k, model.n)), pa.array(squares, pa.int64()).take(at),
                 pa.array(model.project(centred).ravel()), pa.array(np.tile(explained, rows)),
                 pa.array(np.full(rows * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    rows = docs.select(docs[id_col].alias("vec_id"), whole_vector(docs[vector_col]).alias("x"))
    return rows.filter(F.col("x").isNotNull() & (F.size("x") == model.dims)).mapInArrow(run, schema)
