"""Whitening of embeddings by a Jacobi-Davidson eigensolver that never forms the covariance.

The vectors stay in blocks on the executors.  What the solver needs from them is the
centred product V W = 1/n sum (x - mean)((x - mean) W) for a few columns W: one Spark
job, in which each task sends one matrix as large as W.  The driver keeps the subspace
(dimension of the vectors times at most ``most_basis`` numbers): Rayleigh-Ritz on it,
locking of what has converged, and inner MINRES for the projected correction
equations, all columns of one step sharing a product.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from ipscope.llm.common import staged

SCALE, SHIFT = 1024.0, 100_000
LARGEST = 1 << 62  # entries beyond it are held at it
TASK_BYTES = 8 << 20  # of integer entries in a task of a product
ROWS = 4096  # vectors worked on at once


def usable(v: Column) -> Column:
    """Whether a vector is not null and all its entries are finite."""
    return v.isNotNull() & F.coalesce(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))), F.lit(False))


def integers(values: np.ndarray) -> np.ndarray:
    """floor(1024 c) + 100000 as 64-bit integers."""
    return np.clip(np.floor(SCALE * values), -LARGEST, LARGEST - 2 * SHIFT).astype(np.int64) + SHIFT


def offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S, exactly: 64-bit integers where they are wide enough, else Python's."""
    if len(x) == 0 or max(abs(int(x.min())), abs(int(x.max()))) * n + max(map(abs, sums)) < LARGEST:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (offsets(x, n, sums) / n).astype(np.float64)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of squares of n*x - S in each row; None where it does not fit in 64 bits."""
    t = offsets(x, n, sums)
    if t.dtype != object and t.size and int(np.abs(t).max()) ** 2 * t.shape[1] >= LARGEST:
        t = t.astype(object)
    return [s if s < 1 << 63 else None for s in map(int, (t * t).sum(axis=1))] if t.size else [0] * len(x)


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: size of the fit list, its sums, eigenvalues (falling) and unit eigenvectors (columns)."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    residual: float  # largest ||V u - e u|| / e_1

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.values]

    def apply(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ (self.vectors / np.sqrt(self.values))


# ---------------------------------------------------------------- the solver
def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Approximate solutions of A x = b for each column of ``b``, A symmetric; one call of ``apply`` a step for all."""
    tiny = np.finfo(float).tiny
    x, w, w2 = (np.zeros_like(b) for _ in range(3))
    r1 = r2 = y = b
    first = beta = np.linalg.norm(b, axis=0)
    old, dbar, eps = np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    left, cs, sn = beta.copy(), -np.ones_like(beta), np.zeros_like(beta)
    for k in range(steps):
        live = (beta > tiny) & (left > tolerance * first)
        if not live.any():
            break
        y, r1, r2, w, w2 = (np.where(live, c, 0.0) for c in (y, r1, r2, w, w2))
        eps, dbar = np.where(live, eps, 0.0), np.where(live, dbar, 0.0)
        safe = np.where(live, beta, 1.0)
        v = y / safe
        y = apply(v)
        if k:
            y = y - (safe / old) * r1
        alpha = (v * y).sum(axis=0)
        y = y - (alpha / safe) * r2
        r1, r2, old = r2, y, safe
        beta = np.linalg.norm(y, axis=0)
        before, delta, gbar = eps, cs * dbar + sn * alpha, sn * dbar - cs * alpha
        eps, dbar = sn * beta, -cs * beta
        gamma = np.maximum(np.hypot(gbar, beta), tiny)
        cs, sn = gbar / gamma, beta / gamma
        step, left = cs * left, np.where(live, sn * left, 0.0)
        w, w2 = (v - before * w2 - delta * w) / gamma, w
        x = x + step * w
    return x


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """The part of ``new`` outside the spans of ``against`` (orthonormal columns), orthonormal; what lies inside goes."""
    for column in ("once", "twice"):  # the second pass takes away what rounding left
        for q in against:
            new = new - q @ (q.T @ new)
        size = np.linalg.norm(new, axis=0)
        new = new[:, size > (0.0 if column == "once" else 1e-8)] / size[size > (0.0 if column == "once" else 1e-8)]
    if not new.shape[1]:
        return new
    u, s, _ = np.linalg.svd(new, full_matrices=False)
    u = u[:, s > 1e-8 * s[0]]
    for q in against:
        u = u - q @ (q.T @ u)
    return np.linalg.qr(u)[0]


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, *, tolerance: float = 1.5e-14,
                    most_basis: int = 48, inner: int = 6, outer: int = 200, seed: int = 11) -> tuple[np.ndarray, np.ndarray, float]:
    """Largest eigenvalues (falling), unit eigenvectors and the largest relative residual of a positive semidefinite matrix.

    Each round does Rayleigh-Ritz on the subspace, locks from the top what has a residual
    of ``tolerance`` times the largest eigenvalue (so nothing below a vector that still
    moves), solves the correction equations of the others outside locked and current
    Ritz vectors with at most ``inner`` MINRES steps, and extends the subspace.  A subspace of
    ``most_basis`` columns is cut back to its best Ritz vectors.  The round limit guards
    against matrices whose products are noisier than the tolerance: what has not got
    there then is returned with its residual.
    """
    wanted = min(wanted, size)
    spare = wanted + 4
    most_basis = max(most_basis, 3 * spare)
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.normal(size=(size, min(size, spare))))[0]
    image = product(basis)
    locked = np.zeros((size, 0))
    top = 0.0
    for turn in range(outer):
        small = basis.T @ image
        theta, turned = np.linalg.eigh((small + small.T) / 2)
        theta, turned = theta[::-1], turned[:, ::-1]
        basis, image = basis @ turned, image @ turned
        top = max(top, float(theta[0]) if len(theta) else 0.0)
        residual = image - basis * theta
        residual = residual - locked @ (locked.T @ residual)
        norm = np.linalg.norm(residual, axis=0)
        done = 0
        while done < min(len(theta), wanted - locked.shape[1]) and norm[done] <= tolerance * top:
            done += 1
        full = locked.shape[1] + basis.shape[1] >= size
        if turn == outer - 1 or full:  # a subspace that is the whole space has exact Ritz vectors
            done = min(basis.shape[1], wanted - locked.shape[1])
        locked = np.linalg.qr(np.hstack([locked, basis[:, :done]]))[0]
        basis, image, theta, residual, norm = basis[:, done:], image[:, done:], theta[done:], residual[:, done:], norm[done:]
        left = wanted - locked.shape[1]
        if left <= 0:
            break
        if locked.shape[1] + basis.shape[1] + left > most_basis:
            basis, image = basis[:, :spare], image[:, :spare]
        aims = np.flatnonzero(norm[:left] > tolerance * top)
        outside = np.hstack([locked, basis[:, :left]])
        project = lambda t: t - outside @ (outside.T @ t)
        shift = theta[aims]
        step = minres(lambda t: project(product(project(t)) - shift * project(t)), -project(residual[:, aims]), inner, 1e-2)
        new = _orthonormal(step, locked, basis)
        if not new.shape[1]:
            new = _orthonormal(rng.normal(size=(size, len(aims))), locked, basis)
        basis, image = np.hstack([basis, new]), np.hstack([image, product(new)])
    small = locked.T @ (image := product(locked))
    theta, turned = np.linalg.eigh((small + small.T) / 2)
    theta, turned = theta[::-1], turned[:, ::-1]
    vectors = locked @ turned
    worst = float(np.linalg.norm(image @ turned - vectors * theta, axis=0).max()) if wanted else 0.0
    return theta, vectors, worst / theta[0] if wanted and theta[0] > 0 else 0.0


# ---------------------------------------------------------------- on Spark
def _blocks(rows: DataFrame, size: int, count: int) -> DataFrame:
    """The vectors as rows of up to ROWS vectors: their integers in 32 bits where these are wide enough, else 64."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column("v").flatten().to_numpy().reshape(-1, size)
            out = []
            for s in range(0, len(values), ROWS):
                x = integers(values[s:s + ROWS])
                out.append(x.astype(np.int32).tobytes() if np.abs(x).max() < 1 << 31 else x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([min(ROWS, len(values) - s) for s in range(0, len(values), ROWS)], pa.int32()),
                                              pa.array(out, pa.binary())], names=["rows", "x"])

    tasks = max(1, -(-count * size * 4 // TASK_BYTES))
    return staged(rows.select("v").mapInArrow(pack, "rows int, x binary").repartition(tasks), "whitening_blocks")


def _unpack(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    for b in batches:
        for n, x in zip(b.column("rows").to_pylist(), b.column("x").to_pylist()):
            yield np.frombuffer(x, np.int32 if len(x) == 4 * n * size else np.int64).reshape(n, size).astype(np.int64)


def _total(blocks: DataFrame, size: int, shape: tuple[int, ...], part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``part(x)`` over all blocks; tasks send one array each, many tasks by way of a square root of them."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for x in _unpack(batches, size):
            total += part(x)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            for p in b.column("part").to_pylist():
                total += np.frombuffer(p).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts = blocks.mapInArrow(add, "part binary")
    tasks = len(blocks.inputFiles())
    if tasks > 256:
        parts = parts.repartition(math.isqrt(tasks)).mapInArrow(fold, "part binary")
    return sum((np.frombuffer(r.part).reshape(shape) for r in parts.collect()), np.zeros(shape))


def _sums(blocks: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * size
        for x in _unpack(batches, size):
            narrow = np.abs(x).max() < LARGEST // ROWS
            n, total = n + len(x), [t + int(s) for t, s in zip(total, (x if narrow else x.astype(object)).sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, size), pa.int32()),
                                          pa.array(map(Decimal, [n, *total]), pa.decimal128(38, 0))], names=["dim", "total"])

    got = {r.dim: int(r.total) for r in blocks.mapInArrow(add, "dim int, total decimal(38,0)")
           .groupBy("dim").agg(F.sum("total").alias("total")).collect()}  # one row a dimension
    return got.get(-1, 0), [got.get(d, 0) for d in range(size)]


def _rows(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    return vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("v")).filter(
        usable(F.col("v")) & (F.size("v") > 0))


def fit(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = 8) -> Whitening | None:
    """Components of the vectors' integers floor(1024 c) + 100000; None where there is no usable vector.

    Null and empty vectors and those with a null or non-finite entry are left out, as are vectors
    whose length is not the commonest (the larger of equally common ones).  Vectors
    that repeat count as often as they occur.  Components whose eigenvalue is at most
    1e-12 of the largest are left out: the vectors do not extend into them.
    """
    rows = _rows(vectors, vec_id, embedding)
    lengths = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if lengths is None:
        return None
    size = lengths["size"]
    blocks = _blocks(rows.filter(F.size("v") == size), size, lengths["count"])
    n, sums = _sums(blocks, size)

    def product(w: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            z = centred(x, n, sums)
            return z.T @ (z @ w)
        return _total(blocks, size, w.shape, part) / n

    trace = float(_total(blocks, size, (), lambda x: np.square(centred(x, n, sums)).sum()) / n)
    if not trace > 0.0:
        return Whitening(n, sums, np.zeros(0), np.zeros((size, 0)), trace, 0.0, 0.0)
    values, found, residual = jacobi_davidson(product, size, components)
    keep = values > 1e-12 * values[0]
    values, found = values[keep], found[:, keep]
    found = found * np.where(found[np.abs(found).argmax(axis=0), range(found.shape[1])] < 0, -1.0, 1.0)
    to = found / np.sqrt(values)
    mean = _total(blocks, size, values.shape, lambda x: (centred(x, n, sums) @ to).sum(axis=0)) / n

    def spread(x: np.ndarray) -> np.ndarray:
        t = centred(x, n, sums) @ to - mean
        return t.T @ t

    covariance = _total(blocks, size, (len(values), len(values)), spread) / n
    return Whitening(n, sums, values, found, trace, float(np.abs(covariance - np.eye(len(values))).max()), residual)


def whiten(vectors: DataFrame, model: Whitening | None, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per usable vector of the model's length: vec_id, deviation, whitened (one double a component).

    deviation is the sum over dimensions of (n*x - S)**2, exact, and null where that does
    not fit in a long.  Entries are read as doubles; 1024 c beyond 2**62 is held there.
    Rows that repeat a vec_id or vector each give a row; a null vec_id stays null.  An
    empty table, or no model, gives no rows.  Other columns are not read.
    """
    out = StructType([StructField("vec_id", vectors.schema[vec_id].dataType), StructField("deviation", LongType()),
                      StructField("whitened", ArrayType(DoubleType()))])
    if model is None:
        return vectors.sparkSession.createDataFrame([], out)
    size = len(model.sums)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, ROWS):
                b = batch.slice(s, ROWS)
                x = integers(b.column("v").flatten().to_numpy().reshape(-1, size))
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id"), pa.array(deviations(x, model.n, model.sums), pa.int64()),
                     pa.array(list(model.apply(x)), pa.list_(pa.float64()))], names=out.names)

    return _rows(vectors, vec_id, embedding).filter(F.size("v") == size).mapInArrow(turn, out)


def components(whitened: DataFrame, model: Whitening | None) -> DataFrame:
    """``whitened`` with a row for each component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error, residual."""
    n, explained, error, residual = (0, [], 0.0, 0.0) if model is None else (
        model.n, model.explained, model.identity_error, model.residual)
    shares = F.lit(explained).cast("array<double>") if explained else F.array().cast("array<double>")
    return whitened.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "value")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.col("value").alias("whitened"), F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"), F.lit(residual).alias("residual"))
