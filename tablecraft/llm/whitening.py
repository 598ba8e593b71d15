"""Embedding whitening by a matrix-free block Jacobi-Davidson method.

The covariance is never formed: the tasks multiply their centred vectors with a
block of directions and only the summed product (dimension x block) comes back.
The driver works in the small search space: Rayleigh-Ritz, corrections from the
projected equations solved by a few inner MINRES steps (all columns in lock
step, one distributed product a step), locking of what has settled, restarts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.common import share, written
from tablecraft.session import ship_package

SCALE, SHIFT = 64, 1_000_000
#: Entries whose scaled value is not below this have no long and count as non-finite.
LARGEST = float(1 << 61)
COMPONENTS = 16
#: Directions beyond the wanted ones in a block, inner steps, blocks in the search space, outer rounds.
GUARD, INNER_STEPS, SPACE_BLOCKS, MAX_ROUNDS = 4, 4, 6, 300
EPS = float(np.finfo(np.float64).eps)


# ------------------------------------------------------------------ vectors as whole numbers
def quantised(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key`` and ``x``, longs ``floor(64 c) + 1000000``, of the rows whose vector is whole.

    Rows go whose vector is null or holds a null or non-finite entry, or one
    whose 64-fold is beyond 2**61.
    """
    def good(c):
        return F.coalesce(F.abs(c.cast("double") * SCALE) < LARGEST, F.lit(False))

    whole = vectors.filter(F.col(vector).isNotNull() & F.forall(vector, good))
    return whole.select(key, F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT)).cast("array<long>").alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


@dataclass
class Centre:
    """The mean of ``n`` integer vectors as ``base + rest / n``, whole numbers with 0 <= rest < n."""
    n: int
    base: np.ndarray
    rest: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Centred rows: the whole difference is exact, so only the last place is rounded."""
        return (x - self.base).astype(np.float64) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sum over dimensions of (n x - sum)**2 of every row; null beyond 64 bits."""
        y, n = x - self.base, self.n
        most = max(int(np.abs(y).max(initial=0)), 1)
        if most * max(most, n) * y.shape[1] < 1 << 62:
            squares, cross = (y * y).sum(axis=1).tolist(), (y * self.rest).sum(axis=1).tolist()
        else:
            squares = [sum(v * v for v in row) for row in y.tolist()]
            cross = [sum(v * r for v, r in zip(row, self.rest.tolist(), strict=True)) for row in y.tolist()]
        last = sum(r * r for r in self.rest.tolist())
        out = [n * n * a - 2 * n * b + last for a, b in zip(squares, cross, strict=True)]
        return [v if v < 1 << 63 else None for v in out]


def _centre(fit: DataFrame, d: int) -> Centre:
    """Exact sums, in two halves of 32 bits that no task can overflow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), d)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array((x >> 32).sum(axis=0)),
                                              pa.array((x & 0xFFFFFFFF).sum(axis=0)), pa.array(np.full(d, len(x)))],
                                             names=["at", "high", "low", "n"])

    parts = fit.select("x").mapInArrow(run, "at int, high long, low long, n long")
    sums = {r["at"]: r for r in parts.groupBy("at").agg(
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "n")]).collect()}  # a row per dimension
    n = int(sums[0]["n"])
    total = [(int(sums[i]["high"]) << 32) + int(sums[i]["low"]) for i in range(d)]
    return Centre(n, np.array([t // n for t in total], np.int64), np.array([t % n for t in total], np.int64))


def _summed(fit: DataFrame, d: int, centre: Centre, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all centred rows of ``part(rows)``, an array whose size depends on the dimension only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                got = part(centre(_matrix(batch.column(0), d)))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["at", "value"])

    rows = fit.select("x").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(rows))
    for r in rows:
        out[r["at"]] = r["value"]
    return out


# ------------------------------------------------------------------ the eigenproblem
def _orthonormal(new: np.ndarray, old: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the orthonormal ``old``; empty if nothing."""
    for _ in range(2):
        new = new - old @ (old.T @ new)
        size = np.linalg.norm(new, axis=0)
        new = new[:, size > 0] / size[size > 0]
        u, s, _ = np.linalg.svd(new, full_matrices=False) if new.size else (new, np.empty(0), None)
        new = u[:, s > 1e-8 * max(1.0, s.max(initial=0.0))]
    return new[:, :max(0, old.shape[0] - old.shape[1])]


def minres(multiply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int) -> np.ndarray:
    """``steps`` MINRES steps for the symmetric systems ``multiply(x)[:, j] = rhs[:, j]``, all columns at once."""
    tiny = np.finfo(np.float64).tiny
    beta = np.linalg.norm(rhs, axis=0)
    v, before = rhs / np.maximum(beta, tiny), np.zeros_like(rhs)
    x, w, w_before = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    c = c_before = np.ones_like(beta)
    s = s_before = np.zeros_like(beta)
    eta = beta
    for _ in range(steps):
        image = multiply(v)
        alpha = (v * image).sum(axis=0)
        image = image - alpha * v - beta * before
        beta_next = np.linalg.norm(image, axis=0)
        diagonal = c * alpha - c_before * s * beta
        r1 = np.maximum(np.hypot(diagonal, beta_next), tiny)
        w, w_before = (v - s_before * beta * w_before - (s * alpha + c_before * c * beta) * w) / r1, w
        c_before, s_before, c, s = c, s, diagonal / r1, beta_next / r1
        x = x + c * eta * w
        eta = -s * eta
        before, v, beta = v, image / np.maximum(beta_next, tiny), beta_next
    return x


def jacobi_davidson(multiply: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, seed: int = 12) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``wanted`` largest eigenvalues (falling), unit eigenvectors, and the largest residual
    relative to the first eigenvalue, of a symmetric positive semi-definite d x d matrix.

    ``multiply`` gives the matrix times a block.  A vector is locked once its
    residual is at most ``max(d, 64)`` units of rounding of the largest
    eigenvalue; locked vectors leave the search space.  A last product of all
    locked vectors and a Rayleigh-Ritz step in their span give the result.
    """
    wanted = min(wanted, d)
    block = min(d, wanted + GUARD)
    locked = np.empty((d, 0))
    space = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, block)))[0]
    image = multiply(space)
    tolerance, largest = max(d, 64) * EPS, 0.0
    for _ in range(MAX_ROUNDS):
        values, turn = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
        turn = turn[:, ::-1]
        values, space, image = values[::-1], space @ turn, image @ turn
        residual = image - space * values - locked @ (locked.T @ image)
        largest = max(largest, float(values[0]))
        small = np.linalg.norm(residual, axis=0) <= tolerance * max(largest, np.finfo(np.float64).tiny)
        settled = int(np.argmin(small)) if not small.all() else len(small)  # from the top, without a gap
        settled = min(settled, wanted - locked.shape[1])
        if settled:
            locked = np.linalg.qr(np.hstack([locked, space[:, :settled]]))[0]
            values, space, image, residual = values[settled:], space[:, settled:], image[:, settled:], residual[:, settled:]
        if locked.shape[1] == wanted:
            break
        active = min(block, space.shape[1])
        known = np.hstack([locked, space[:, :active]])

        def projected(t: np.ndarray, basis=known, shift=values[:active]) -> np.ndarray:
            t = t - basis @ (basis.T @ t)
            t = multiply(t) - shift * t
            return t - basis @ (basis.T @ t)

        rhs = residual[:, :active]
        correction = minres(projected, -(rhs - known @ (known.T @ rhs)), INNER_STEPS)
        if space.shape[1] + active > SPACE_BLOCKS * block:  # restart from the best Ritz vectors
            space, image = space[:, :2 * block], image[:, :2 * block]
        new = _orthonormal(correction, np.hstack([locked, space]))
        if not new.shape[1]:  # the space cannot grow: a fresh direction, or everything is spanned
            new = _orthonormal(np.random.default_rng(seed + locked.shape[1]).standard_normal((d, block)), np.hstack([locked, space]))
        if new.shape[1]:
            space, image = np.hstack([space, new]), np.hstack([image, multiply(new)])
        else:  # products afresh, of an orthonormal basis
            space = _orthonormal(space, locked)
            image = multiply(space)
    else:
        raise RuntimeError("Jacobi-Davidson did not settle")
    image = multiply(locked)
    values, turn = np.linalg.eigh((locked.T @ image + image.T @ locked) / 2)
    values, vectors, image = values[::-1], locked @ turn[:, ::-1], image @ turn[:, ::-1]
    left = np.linalg.norm(image - vectors * values, axis=0).max(initial=0.0)
    return values, vectors, float(left / max(values[0], np.finfo(np.float64).tiny))


# ------------------------------------------------------------------ whitening
@dataclass
class Whitening:
    """Unit directions by falling variance, and what they were fitted on."""
    centre: Centre
    variances: np.ndarray
    directions: np.ndarray
    trace: float
    residual: float
    identity_error: float

    def __call__(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.directions / np.sqrt(self.variances)


def _dimension(vectors: DataFrame) -> int:
    """The most frequent number of entries (ties: the larger); 0 without rows or entries."""
    row = vectors.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return row["d"] if row else 0


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on each distinct vector of ``quantised`` rows once; null if there is no variance at all.

    Vectors of other lengths than the most frequent one are left out of the fit.
    Directions whose variance is only rounding are left out.
    """
    d = _dimension(vectors)
    if not d:
        return None
    ship_package(vectors.sparkSession)
    fit = written(vectors.filter(F.size("x") == d).select("x").distinct(), "fit-vectors")
    centre = _centre(fit, d)
    trace = float(_summed(fit, d, centre, lambda c: np.array([(c * c).sum()]))[0]) / centre.n
    if trace <= 0:
        return None

    def multiply(block: np.ndarray) -> np.ndarray:
        held = share(fit.sparkSession, block)  # dimension x block numbers
        got = _summed(fit, d, centre, lambda c: (c.T @ (c @ held.value)).ravel()).reshape(block.shape) / centre.n
        held.unpersist()
        return got

    values, directions, residual = jacobi_davidson(multiply, d, components)
    real = values > max(d, 64) * EPS * values[0]
    made = Whitening(centre, values[real], directions[:, real], trace, residual, 0.0)
    k = len(made.variances)

    def moments(c: np.ndarray) -> np.ndarray:
        w = made(c)
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    got = _summed(fit, d, centre, moments) / centre.n
    mean, second = got[:k], got[k:].reshape(k, k)
    made.identity_error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())
    return made


ROWS = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, fitted: Whitening | None, key: str = "vec_id") -> DataFrame:
    """Per row of ``quantised`` and component (from 1, by falling variance): ``key, component, n,
    deviation, whitened, explained, identity_error``.

    No variance: no rows.  A vector of another length than the fitted ones has
    no projection: it comes out once, with null in all but its key.  Null and
    repeated keys come out row by row.
    """
    spark = vectors.sparkSession
    kind = vectors.select(key).schema[0].dataType.simpleString()
    ddl = f"{key} {kind}, {ROWS}"
    if fitted is None:
        return spark.createDataFrame([], ddl)
    ship_package(spark)
    held = share(spark, fitted)
    d, k = fitted.directions.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        explained = model.variances / model.trace
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), d)
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), model.centre.n)), pa.array(model.centre.deviation(x), pa.int64()).take(pa.array(each)),
                pa.array(model(model.centre(x)).ravel()), pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(each), model.identity_error))], names=[key, *[f.split()[0] for f in ROWS.split(", ")]])

    fits = vectors.filter(F.size("x") == d).select(key, "x").mapInArrow(run, ddl)
    other = vectors.filter(F.size("x") != d).select(key, *[F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in ROWS.split(", ")])
    return fits.unionByName(other)
