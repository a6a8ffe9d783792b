"""Whitening of embeddings by a block Jacobi-Davidson method over distributed products."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from petrichor.session import materialize

#: Rows that a task multiplies at once.
ROWS = 8192
#: Residuals, relative to the largest eigenvalue, at which a vector is locked, and rounds until the method gives up.
TOLERANCE, ROUNDS = 1e-13, 200
#: Steps of the inner solver in one round, and the share of its residual at which it stops early.
INNER_STEPS, INNER_SHARE = 6, 1e-3

#: Gives the covariance times a block of vectors.
Product = Callable[[np.ndarray], np.ndarray]


@dataclass
class Axes:
    """The leading components of a fit list: its size n, sums S, trace, eigenvalues and unit eigenvectors (columns)."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray


def whole_vectors(rows: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    """vec_id, x: ``floor(scale * c)`` of each entry; rows without a vector, or with an entry that is not a finite number, go."""
    entries = F.col("v")
    broken = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    found = rows.select(rows[id].cast("long").alias("vec_id"), rows[vector].cast("array<double>").alias("v"))
    found = found.where(entries.isNotNull() & (F.size("v") > 0) & ~F.coalesce(broken, F.lit(True)))
    found = found.select("vec_id", F.transform("v", lambda c: F.floor(scale * c).cast("long")).alias("x"))
    # The length of most vectors, the smaller one of two equally frequent ones.
    usual = found.groupBy(F.size("x").alias("m")).count().orderBy(F.desc("count"), "m").first()
    return found.where(F.size("x") == (usual.m if usual else 0))


def _matrices(batches: Iterable[pa.RecordBatch], at: int, dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for low in range(0, len(batch), ROWS):
            yield batch.column(at).slice(low, ROWS).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _summed(rows: DataFrame, column: str, part: Callable[[np.ndarray], np.ndarray], dim: int, shape: tuple[int, ...], kind: str) -> np.ndarray:
    """The sum over all vectors of ``part``, an array of ``shape``. Each task sums its own; Spark sums these cell by cell."""
    arrow = pa.int64() if kind == "long" else pa.float64()
    cells = int(np.prod(shape))

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _matrices(batches, 0, dim):
            found = part(x).ravel()
            total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells, dtype=np.int32)), pa.array(total, arrow)], ["cell", "value"])

    summed = rows.select(column).mapInArrow(fold, f"cell int, value {kind}").groupBy("cell").agg(F.sum("value").alias("value"))
    out = np.zeros(cells, np.int64 if kind == "long" else np.float64)
    for row in summed.collect():  # as many as the result has cells
        out[row.cell] = row.value
    return out.reshape(shape)


def _orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to the given bases; twice, as once loses digits."""
    block = block / np.maximum(np.linalg.norm(block, axis=0), np.finfo(float).tiny)
    for _ in range(2):
        for basis in against:
            block = block - basis @ (basis.T @ block)
        q, r = np.linalg.qr(block)
        block = q[:, np.abs(np.diag(r)) > 1e-10]
        if not block.shape[1]:
            break
    return block


def corrections(times: Product, values: np.ndarray, ritz: np.ndarray, residuals: np.ndarray, locked: np.ndarray) -> np.ndarray:
    """Approximate solutions t of (I - QQ')(A - value I)(I - QQ') t = -residual, one column for each Ritz pair.

    Q holds the locked vectors and the pair's own Ritz vector. All columns take a step of MINRES
    together, so that a step is one distributed product however many columns there are.
    """

    def project(block: np.ndarray) -> np.ndarray:
        block = block - locked @ (locked.T @ block)
        return block - ritz * np.sum(ritz * block, axis=0)

    k = ritz.shape[1]
    v = project(-residuals)
    beta = np.linalg.norm(v, axis=0)
    tiny = np.finfo(float).tiny
    start, eta = np.maximum(beta, tiny), beta.copy()
    v, v_old = v / start, np.zeros_like(v)
    w, w_old, t = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    c, c_old, s, s_old = np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    beta = np.zeros(k)
    for _ in range(INNER_STEPS):
        product = project(times(v) - v * values)
        alpha = np.sum(v * product, axis=0)
        product = product - v * alpha - v_old * beta
        beta_next = np.linalg.norm(product, axis=0)
        # The new column of the tridiagonal matrix, turned by the two rotations before, and the next one.
        rho3, rest = s_old * beta, c_old * beta
        rho2, delta = c * rest + s * alpha, c * alpha - s * rest
        rho1 = np.maximum(np.hypot(delta, beta_next), tiny)
        c_old, s_old, c, s = c, s, delta / rho1, beta_next / rho1
        w_old, w = w, (v - w * rho2 - w_old * rho3) / rho1
        t = t + w * (c * eta)
        eta = -s * eta
        v_old, v, beta = v, product / np.maximum(beta_next, tiny), beta_next
        if np.all(np.abs(eta) <= INNER_SHARE * start):
            break
    return project(t)


def leading_pairs(times: Product, dim: int, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix that is only known by its products, and their unit vectors.

    The subspace grows by the corrections of the Ritz pairs that are not locked yet. A pair is
    locked, from the largest on, once its residual reaches double precision. A subspace that is too large is cut
    back to its best Ritz vectors. At the end the locked pairs are multiplied afresh, rotated by
    Rayleigh-Ritz and checked; if one does not hold, the search goes on from them.
    """
    wanted = min(wanted, dim)
    rng = np.random.default_rng(seed)
    extra = min(dim, 2 * wanted + 2)
    basis = _orthonormal(rng.standard_normal((dim, extra)))
    products = times(basis)
    locked = np.empty((dim, 0))
    largest = 0.0
    for _ in range(ROUNDS):
        small = basis.T @ products
        values, turns = np.linalg.eigh((small + small.T) / 2)
        values, turns = values[::-1], turns[:, ::-1]
        ritz, images = basis @ turns, products @ turns
        largest = max(largest, abs(values[0])) if len(values) else largest
        missing = wanted - locked.shape[1]
        residuals = images[:, :missing] - ritz[:, :missing] * values[:missing]
        residuals -= locked @ (locked.T @ residuals)
        good = np.linalg.norm(residuals, axis=0) <= TOLERANCE * largest
        # A basis of the whole space leaves nothing to add.
        whole = locked.shape[1] + basis.shape[1] >= dim
        ready = missing if whole else int(np.argmin(np.append(good, False)))
        if ready:
            locked = np.hstack((locked, _orthonormal(ritz[:, :ready], locked)))
            ritz, images, values, residuals = ritz[:, ready:], images[:, ready:], values[ready:], residuals[:, ready:]
        if locked.shape[1] >= wanted:
            fresh = times(locked)
            small = locked.T @ fresh
            values, turns = np.linalg.eigh((small + small.T) / 2)
            locked, fresh, values = locked @ turns[:, ::-1], fresh @ turns[:, ::-1], values[::-1]
            left = np.linalg.norm(fresh - locked * values, axis=0)
            if whole or np.all(left <= 4 * TOLERANCE * largest):
                return values, locked
            basis, products, locked = locked, fresh, np.empty((dim, 0))
            continue
        if basis.shape[1] > 8 * wanted:
            ritz, images = ritz[:, :extra], images[:, :extra]
        basis, products = ritz, images
        open_ = wanted - locked.shape[1]
        if residuals.shape[1] < open_:
            new = rng.standard_normal((dim, open_))
        else:
            new = corrections(times, values[:open_], ritz[:, :open_], residuals[:, :open_], locked)
        new = _orthonormal(new, locked, basis)
        if not new.shape[1]:
            new = _orthonormal(rng.standard_normal((dim, 1)), locked, basis)
        basis, products = np.hstack((basis, new)), np.hstack((products, times(new)))
    raise ArithmeticError(f"no {wanted} eigenpairs to {TOLERANCE} in {ROUNDS} rounds")


def fit_axes(fit: DataFrame, dim: int, components: int) -> Axes | None:
    """The leading components of a table of distinct vectors ``x``; None if it has no vector, or only one.

    The covariance is never formed: each task centres its vectors and multiplies them with a block of a few
    columns, and the tasks' blocks are summed. Components without variance are left out.
    """
    n = fit.count()
    if n < 2:
        return None
    sums = _summed(fit, "x", lambda x: x.sum(axis=0), dim, (dim,), "long")

    def centred(x: np.ndarray) -> np.ndarray:
        # n * x - S is exact in whole numbers up to 2**63; beyond, the mean is rounded first.
        if n * max(1, int(np.abs(x).max(initial=0))) < 1 << 61:
            return (n * x - sums) / n
        return x - sums / n

    def times(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            return c.T @ (c @ block)

        return _summed(fit, "x", part, dim, block.shape, "double") / n

    trace = float(_summed(fit, "x", lambda x: np.square(centred(x)).sum(keepdims=True).reshape(1), dim, (1,), "double")[0]) / n
    if trace == 0:
        return None
    values, vectors = leading_pairs(times, dim, components)
    some = values > 1e-12 * trace
    return Axes(n, sums, trace, values[some], vectors[:, some])


def _scores(x: np.ndarray, axes: Axes) -> np.ndarray:
    if axes.n * max(1, int(np.abs(x).max(initial=0))) < 1 << 61:
        centred = (axes.n * x - axes.sums) / axes.n
    else:
        centred = x - axes.sums / axes.n
    return centred @ axes.vectors / np.sqrt(axes.values)


def identity_error(fit: DataFrame, dim: int, axes: Axes) -> float:
    """The largest entry, by size, of the covariance of the whitened fit list less the identity."""
    k = len(axes.values)
    mean = _summed(fit, "x", lambda x: _scores(x, axes).sum(axis=0), dim, (k,), "double") / axes.n

    def part(x: np.ndarray) -> np.ndarray:
        w = _scores(x, axes) - mean
        return w.T @ w

    return float(np.abs(_summed(fit, "x", part, dim, (k, k), "double") / axes.n - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """The sum over dimensions of (n * x - S) squared, exact at any size."""
    most = n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if most * most * max(1, x.shape[1]) < 1 << 63:
        return np.square(n * x - sums).sum(axis=1).tolist()
    return [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]


def whiten(rows: DataFrame, components: int = 4, scale: int = 256, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained, identity_error.

    One row for each remaining row of ``rows`` and each component. Entries become whole numbers,
    ``floor(scale * c)``; each distinct vector counts once in the fit, whichever rows hold it.
    Components are unit eigenvectors of the fit list's covariance, largest eigenvalue first.

    Rows whose vector is null, empty, or holds null or not finite entries go, and so do vectors of another
    length than most. Repeated rows get equal results, ids may be null. Components without
    variance are left out: an empty table, a single distinct vector or equal vectors give no rows,
    and vectors of fewer dimensions give fewer components. Other columns are not read.
    """
    found = materialize(whole_vectors(rows, id, vector, scale), "vectors")
    fit = materialize(found.select("x").distinct(), "fit")
    first = fit.first()
    dim = len(first.x) if first else 0
    axes = fit_axes(fit, dim, components)
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if axes is None:
        return rows.sparkSession.createDataFrame([], schema)
    error, k = identity_error(fit, dim, axes), len(axes.values)
    explained = axes.values / axes.trace

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), ROWS):
                part = batch.slice(low, ROWS)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                m = len(x)
                each = pa.array(np.repeat(np.arange(m), k))
                columns = [
                    part.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, axes.n)),
                    pa.array(deviations(x, axes.n, axes.sums), pa.decimal128(38, 0)).take(each), pa.array(_scores(x, axes).ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    return found.mapInArrow(score, schema)
