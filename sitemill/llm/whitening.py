"""Whitening of vectors by block subspace iteration, without a matrix of dimension by dimension per row.

A vector's entries become whole numbers, so that sums and distances are exact. The covariance V of
the distinct vectors is never formed: each pass over them computes X'(XQ) for a block Q of a few
orthonormal columns, on centred rows. The driver orthonormalises the block (QR), rotates it to Ritz
vectors, and ends when the residuals ``|V q - e q|`` certify all components asked for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Entries are counted in steps of one by so many.
STEPS = 256
#: Columns of the first block beyond the components asked for.
SPARE = 8
#: A residual of this share of the largest eigenvalue certifies a component.
TOLERANCE = 1e-13
#: A block that would need more passes than this to converge is doubled, up to the dimension.
PATIENCE = 6
#: Eigenvalues up to this share of the largest are zero to double precision.
RANK = 1e-13
#: Numbers of steps of this size and more are refused: their products could leave 64 bits.
LARGEST = 2**31


@dataclass
class Whitening:
    """Components (dimension x k), eigenvalues (k) and what is needed to apply them; bounded by the dimension."""

    n: int
    dim: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float | None
    residual: float
    passes: int


def _steps(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, whole numbers) of the vectors that are neither null nor hold null or non-finite entries."""
    for i, v in enumerate(column):
        if not v.is_valid or v.values.null_count:
            continue
        x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
        if not np.isfinite(x).all():
            continue
        x = np.floor(STEPS * x)
        if (np.abs(x) >= LARGEST).any():
            raise ValueError(f"an entry of {np.abs(x).max() / STEPS:g} is beyond {LARGEST / STEPS:g}")
        yield i, x.astype("<i4")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector as the bytes of its whole numbers, without the zeros at its end, and its length."""
    for b in batches:
        x = [v for _, v in _steps(b.column(0))]
        packed = [np.trim_zeros(v, "b").tobytes() for v in x]
        yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), pa.array([len(v) for v in x], pa.int32())], names=["x", "size"])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The whole numbers of a batch of packed vectors, shorter ones filled with zeros."""
    out = np.zeros((len(column), dim), "<i4")
    for i, v in enumerate(column):
        x = np.frombuffer(v.as_buffer(), "<i4")
        out[i, : len(x)] = x
    return out


def _total(fit: DataFrame, partial, size: int) -> np.ndarray:
    """The sum over all rows of ``partial`` (a matrix of whole numbers -> ``size`` doubles or longs), by entry.

    One row of sums for each task; rows are added in as many tasks as the root of their number, and those in one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _added(partial(b.column(0)).ravel() for b in batches if b.num_rows)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _added(v.values.to_numpy() for b in batches for v in b.column(0))

    schema = f"v array<{'long' if partial.whole else 'double'}>"
    few = max(1, math.isqrt(fit.rdd.getNumPartitions()))
    rows = fit.select("x").mapInArrow(run, schema).repartition(few).mapInArrow(add, schema).repartition(1).mapInArrow(add, schema).collect()
    return np.array(rows[0]["v"] if rows else [0] * size, object if partial.whole else float)


def _added(arrays: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    got = None
    for a in arrays:
        got = a.copy() if got is None else got + a
    if got is not None:
        yield pa.RecordBatch.from_arrays([pa.array([got])], names=["v"])


def _partial(f, whole: bool = False):
    f.whole = whole
    return f


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues of V on the block by falling size, Ritz vectors, and V times them."""
    h = q.T @ vq
    e, w = np.linalg.eigh((h + h.T) / 2)
    w = w[:, ::-1]
    return e[::-1], q @ w, vq @ w


def fit_whitening(df: DataFrame, vector: str = "embedding", k: int = 4, seed: int = 7) -> Whitening | None:
    """Components 1 to ``k`` of the distinct vectors' covariance (divisor n); None where no vector is left.

    Vectors that are null or hold null or non-finite entries are passed over, empty ones and zeros are
    not. Shorter vectors count as filled with zeros up to the longest. The only shuffle is the one
    that makes vectors distinct, with equal ones merged before it; they are written once and each pass
    reads them. A pass sends one row of sums for each task, added in two steps; the driver holds dimension x
    block numbers. A block starts with k and eight columns; where eigenvalues lie close it
    is doubled, so the passes stay few; at the full dimension one pass is exact.
    """
    data = df.select(F.col(f"`{vector}`").alias("v"))
    fit = cut(data.mapInArrow(_pack, "x binary, size int").groupBy("x").agg(F.max("size").alias("size")))
    head = fit.agg(F.count("*").alias("n"), F.max("size").alias("dim")).first()
    n, dim = head["n"], head["dim"] or 0
    if not n:
        return None
    if not dim:
        return Whitening(n, 0, np.zeros(0, object), np.zeros((0, 0)), np.zeros(0), 0.0, None, 0.0, 0)
    sums = _total(fit, _partial(lambda c: _matrix(c, dim).sum(0, dtype=np.int64), True), dim)
    mean = np.array([float(s) / n for s in sums])
    trace = float(_total(fit, _partial(lambda c: ((_matrix(c, dim) - mean) ** 2).sum(0)), dim).sum()) / n
    k = min(k, dim)
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((dim, min(dim, k + SPARE))))[0]
    before, passes, best = None, 0, None
    while True:
        passes += 1
        now = q

        def product(c: pa.Array) -> np.ndarray:
            x = _matrix(c, dim) - mean
            return x.T @ (x @ now)

        vq = _total(fit, _partial(product), q.size).reshape(q.shape) / n
        e, u, vu = _ritz(q, vq)
        residual = float(np.linalg.norm(vu[:, :k] - u[:, :k] * e[:k], axis=0).max() / max(e[0], np.finfo(float).tiny))
        if best is None or residual <= best[0]:
            best = (residual, e[:k], u[:, :k])
        whole = q.shape[1] == dim
        if residual <= TOLERANCE or whole or e[0] <= 0:
            break
        fall = residual / before if before else None
        before = residual
        if fall is not None and (fall >= 1 or np.log(TOLERANCE / residual) / np.log(fall) > PATIENCE):
            more = rng.standard_normal((dim, min(q.shape[1], dim - q.shape[1])))
            q, before = np.linalg.qr(np.c_[vu / max(e[0], 1e-300), more])[0], None
        else:
            q = np.linalg.qr(vu)[0]
    residual, e, u = best
    live = e > RANK * max(e[0], 0)
    identity = None
    if live.any():
        scale = u[:, live] / np.sqrt(e[live])
        gram = _total(fit, _partial(lambda c: (lambda w: w.T @ w)((_matrix(c, dim) - mean) @ scale)), scale.shape[1] ** 2)
        identity = float(np.abs(gram.reshape(scale.shape[1], -1) / n - np.eye(scale.shape[1])).max())
    return Whitening(n, dim, sums, u, np.where(live, e, 0.0), trace, identity, residual, passes)


def whiten(df: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each usable vector and component: n, deviation, whitened, explained, identity_error.

    Repeated rows and rows with a null id are kept like any other. ``deviation`` is exact, a
    decimal of 38 digits. A component without variance (fewer distinct vectors than components, or all
    equal) has null in whitened and explained zero, and stays out of identity_error. An empty table, or
    one without a usable vector, gives no rows. Other columns may have any names.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType
    data = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").alias("v"))
    if model is None or not model.dim:
        return spark.createDataFrame(
            [], f"{'`' + id_col + '`'} {kind.simpleString()}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        )
    n, dim, sums, c, e = model.n, model.dim, model.sums, model.components, model.eigenvalues
    k = len(e)
    mean = np.array([float(s) / n for s in sums])
    scale = np.divide(c, np.sqrt(e), out=np.full(c.shape, np.nan), where=e > 0)
    square, reach = int(sum(s * s for s in sums)), int(sum(abs(s) for s in sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = list(_steps(b.column(1)))
            if not got:
                continue
            at = np.array([i for i, _ in got])
            x = np.zeros((len(got), dim), np.int64)
            for r, (_, v) in enumerate(got):
                x[r, : len(v)] = v
            # sum((n x - S)^2) = n^2 sum(x^2) - 2 n sum(x S) + sum(S^2), in whole numbers of any size
            fits = int(np.abs(x).max(initial=0)) * reach < 2**62
            own, cross = (x * x).sum(1).astype(object), x @ sums.astype(np.int64) if fits else x.astype(object) @ sums
            far = [Decimal(int(n * n * a - 2 * n * p + square)) for a, p in zip(own, cross.tolist())]
            w = (x - mean) @ scale
            rows = np.repeat(np.arange(len(got)), k)
            flat = w.ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(at[rows])),
                    pa.array(np.tile(np.arange(1, k + 1), len(got)), pa.int32()),
                    pa.array([far[r] for r in rows], pa.decimal128(38, 0)),
                    pa.array(flat, mask=np.isnan(flat)),
                ],
                names=["id", "component", "deviation", "whitened"],
            )

    out = data.mapInArrow(run, f"id {kind.simpleString()}, component int, deviation decimal(38,0), whitened double")
    share = F.array(*[F.lit(float(v / model.trace) if model.trace > 0 else 0.0) for v in e])
    return out.select(
        F.col("id").alias(id_col),
        "component",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        share[F.col("component") - 1].alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
