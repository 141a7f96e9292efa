"""Embedding whitening by leading principal components, found by Jacobi-Davidson iteration.

Vectors are put on a grid: an entry c becomes the integer floor(256 c). The covariance V of the
different vectors is never formed: the solver asks for products V W with a few columns W, and each is
one pass over the table in which tasks add up C'(C W) of their centred rows C; only sums of the size of
W come to the driver.

The solver keeps a search space, small beside the table, and takes Ritz pairs from it. For each leading
pair (u, t) whose residual r is not yet at double precision it solves the correction equation

    (I - UU')(V - t I)(I - UU') z = -r

by a few steps of MINRES, where U holds the locked and the current leading Ritz vectors; the systems of
all open pairs advance together, a pass each step. The solutions are added to the search space, and pairs are
locked from the first on when their residual, of a fresh product, is at double precision.

Results by definition: rows are dropped whose vector is null or holds null, NaN or infinite entries; a
shorter vector is filled up with zeros to the longest one's length; entries beyond a long's range take its
ends; copies of a vector count once in the fit and each row has its result rows; components whose
variance isn't positive (to double precision) are left out, so one vector alone, empty vectors and an empty table give no rows; equal
variances share an arbitrary basis; a deviation beyond a long's range is null; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, inf, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .rows import cut, pick

COMPONENTS = 4
BLOCK_ROWS = 4096
TASK_BYTES = 8 << 20  # of vectors that a task of a pass takes at least
PRECISION = 1e-14  # of a residual, as a share of the largest eigenvalue
MINRES_STEPS, MINRES_SHARE = 8, 1e-3
MOST_ROUNDS, MOST_SPACE, KEPT_SPACE = 60, 40, 12


def grid(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(F.lit(256.0) * c.cast("double")) + F.lit(0).cast("long"))


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): rows whose vectors are whole, on the grid."""
    rows = pick(df, id=id_col, v=vector_col)
    odd = F.exists("v", lambda c: F.coalesce(F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == inf), F.lit(True)))
    return rows.where(F.col("v").isNotNull() & ~odd).select("id", grid(F.col("v")).alias("x"))


def filled(x: Column, width: int) -> Column:
    return F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(x)))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _pack(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(0), width)
            for i in range(0, len(x), BLOCK_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x[i:i + BLOCK_ROWS], np.int64).tobytes()], pa.binary())], names=["m"])

    return run


@dataclass
class Fit:
    """The different vectors, packed, and what centres them."""
    blocks: DataFrame
    width: int
    n: int
    sums: list[int]

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def total(self, part: Callable[[np.ndarray], np.ndarray], kind=np.float64, centre: bool = True) -> np.ndarray:
        """The sum of ``part(block)`` over all blocks: one pass. Tasks add up their own blocks; if there are many, groups of tasks' sums are added before the driver's."""
        width, mean = self.width, self.mean if centre else None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = None
            for batch in batches:
                for raw in batch.column(0).to_pylist():
                    x = np.frombuffer(raw, np.int64).reshape(-1, width)
                    one = part(x if mean is None else x - mean)
                    found = one if found is None else found + one
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array([found], pa.list_(pa.from_numpy_dtype(kind)))], names=["s"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = [s for batch in batches for s in batch.column(0).to_pylist()]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([np.sum(np.array(found, kind), axis=0)], pa.list_(pa.from_numpy_dtype(kind)))], names=["s"])

        schema = f"s array<{'double' if kind is np.float64 else 'bigint'}>"
        sums = self.blocks.mapInArrow(run, schema)
        groups = isqrt(self.blocks.rdd.getNumPartitions())
        if groups > 8:
            sums = sums.repartition(groups).mapInArrow(add, schema)
        return np.sum(np.array(sums.toArrow()["s"].to_pylist(), kind), axis=0)

    def product(self, w: np.ndarray) -> np.ndarray:
        """V w."""
        shape = w.shape
        return self.total(lambda c: (c.T @ (c @ w)).ravel()).reshape(shape) / self.n


def _sums(x: np.ndarray) -> np.ndarray:
    """Rows, and sums of upper and lower halves of entries: exact for up to 2^31 rows of any entries."""
    return np.concatenate([[len(x)], (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])


def fit(vectors: DataFrame, width: int) -> Fit | None:
    """``vectors``: a column x of integers. Their different values, written once and packed; None if there are none."""
    spark = vectors.sparkSession
    ship_package(spark)
    blocks = cut(spark, vectors.select(filled(F.col("x"), width).alias("x")).distinct().mapInArrow(_pack(width), "m binary"))
    size = blocks.agg(F.coalesce(F.sum(F.octet_length("m")), F.lit(0)).alias("n")).first()["n"]
    if not size:
        return None
    found = Fit(blocks.coalesce(max(1, ceil(size / TASK_BYTES))), width, 1, [0] * width)
    counts = [int(v) for v in found.total(_sums, np.int64, centre=False)]
    found.n = counts[0]
    found.sums = [(hi << 32) + lo for hi, lo in zip(counts[1:width + 1], counts[width + 1:])]
    return found


def orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Columns that add what ``new`` has beyond the orthonormal columns of ``against``."""
    old = np.hstack(against) if against else np.zeros((len(new), 0))
    kept: list[np.ndarray] = []
    for v in new.T:
        size = np.linalg.norm(v)
        if not size > 0:
            continue
        v = v / size
        for _ in range(3):
            v = v - old @ (old.T @ v)
            for k in kept:
                v = v - k * (k @ v)
        size = np.linalg.norm(v)
        if size > 1e-10 and len(kept) + old.shape[1] < len(v):
            v = v / size
            v = v - old @ (old.T @ v)
            kept.append(v / np.linalg.norm(v))
    return np.array(kept).T.reshape(len(new), len(kept))


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, share: float) -> np.ndarray:
    """MINRES from zero for several symmetric systems, one a column, each with its own scalars; ``apply`` takes all columns at once."""
    size = np.linalg.norm(b, axis=0)
    x, safe = np.zeros_like(b), lambda a: np.where(a == 0, 1.0, a)
    v_old, v, beta = np.zeros_like(b), b / safe(size), np.zeros(b.shape[1])
    w_old, w = np.zeros_like(b), np.zeros_like(b)
    rest, c_old, c, s_old, s = size.copy(), np.ones(b.shape[1]), np.ones(b.shape[1]), np.zeros(b.shape[1]), np.zeros(b.shape[1])
    for _ in range(steps):
        p = apply(v) - beta * v_old
        alpha = np.sum(v * p, axis=0)
        p = p - alpha * v
        beta_new = np.linalg.norm(p, axis=0)
        # The new column of the tridiagonal matrix, turned by the last two rotations and then by its own.
        eps, bar = s_old * beta, c_old * beta
        delta, gamma = c * bar + s * alpha, c * alpha - s * bar
        r = np.hypot(gamma, beta_new)
        go = r > 1e-300
        c_old, s_old = c, s
        c, s = np.where(go, gamma / safe(r), 1.0), np.where(go, beta_new / safe(r), 0.0)
        w_old, w = w, np.where(go, (v - delta * w - eps * w_old) / safe(r), 0.0)
        x = x + (c * rest) * w
        rest = -s * rest
        v_old, v, beta = v, p / safe(beta_new), beta_new
        if np.all(np.abs(rest) <= share * size):
            break
    return x


def leading(product: Callable[[np.ndarray], np.ndarray], width: int, k: int = COMPONENTS, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors as columns, of the symmetric positive operator ``product``."""
    k = min(k, width)
    rng = np.random.default_rng(seed)
    space = orthonormal(rng.standard_normal((width, min(width, k + 4))))
    image = product(space)
    for _ in range(2):  # powers of the start, so that the first Ritz pairs are near
        more = orthonormal(image[:, -(k + 4):], space)
        if more.shape[1]:
            space, image = np.hstack([space, more]), np.hstack([image, product(more)])
    locked, values = np.zeros((width, 0)), []
    for _ in range(MOST_ROUNDS):
        h = space.T @ image
        theta, y = np.linalg.eigh((h + h.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        ritz, ritz_image = space @ y, image @ y
        scale = max([*values, theta[0] if len(theta) else 0.0, 1e-300])
        open_ = min(k - locked.shape[1], ritz.shape[1])
        u, t = ritz[:, :open_], theta[:open_]
        residual = ritz_image[:, :open_] - u * t
        size = np.linalg.norm(residual, axis=0)
        whole = locked.shape[1] + space.shape[1] >= width  # the search space is all that is left: its Ritz pairs are the eigenpairs
        n_done = next((j for j in range(open_) if size[j] > 10 * PRECISION * scale * max(1, width ** 0.5 / 8)), open_)
        if n_done or whole:
            # A fresh product of the candidates decides.
            n_try = open_ if whole else n_done
            fresh = product(u[:, :n_try])
            t_fresh = np.sum(u[:, :n_try] * fresh, axis=0)
            size_fresh = np.linalg.norm(fresh - u[:, :n_try] * t_fresh, axis=0)
            n_lock = n_try if whole else next((j for j in range(n_try) if size_fresh[j] > 20 * PRECISION * scale * max(1, width ** 0.5 / 8)), n_try)
            if n_lock:
                locked, values = np.hstack([locked, u[:, :n_lock]]), [*values, *t_fresh[:n_lock]]
                space, image = ritz[:, n_lock:], ritz_image[:, n_lock:]
            else:
                image = np.hstack([fresh, ritz_image[:, n_try:]])
                space = ritz
            if locked.shape[1] >= k:
                break
            if n_lock:
                continue
        if space.shape[1] > MOST_SPACE:
            space, image = ritz[:, :KEPT_SPACE], ritz_image[:, :KEPT_SPACE]
        shut = np.hstack([locked, u])

        def off(z: np.ndarray) -> np.ndarray:
            return z - shut @ (shut.T @ z)

        z = minres(lambda v: off(product(off(v)) - v * t), -off(residual), MINRES_STEPS, MINRES_SHARE)
        more = orthonormal(z, locked, space)
        if not more.shape[1]:
            more = orthonormal(rng.standard_normal((width, 2)), locked, space)
        space, image = np.hstack([space, more]), np.hstack([image, product(more)])
    else:
        raise ArithmeticError(f"{locked.shape[1]} of {k} eigenvectors reached double precision in {MOST_ROUNDS} rounds")
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], locked[:, order]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Row sums of (n x - S)^2, exact; null beyond a long's range."""
    most = n * int(max(abs(int(x.max())), abs(int(x.min())), 1)) + max(map(abs, sums))
    if most * most * x.shape[1] < 1 << 63:
        d = n * x - np.array(sums, np.int64)
        return np.sum(d * d, axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [v if v < 1 << 63 else None for v in exact]


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of each usable row and leading component."""
    rows = usable(df, id_col, vector_col)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    width = rows.agg(F.max(F.size("x")).alias("n")).first()["n"] or 0
    found = fit(rows, width) if width else None
    trace = float(found.total(lambda c: np.array([np.sum(c * c)]))[0]) / found.n if found else 0.0
    if not trace > 0:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    values, directions = leading(found.product, width, components)
    kept = values > values[0] * width * np.finfo(float).eps * 8
    values, directions = values[kept], directions[:, kept]
    scaled = directions / np.sqrt(values)
    centre = found.total(lambda c: (c @ scaled).sum(axis=0)) / found.n
    spread = found.total(lambda c: ((c @ scaled - centre).T @ (c @ scaled - centre)).ravel()).reshape(len(values), -1) / found.n
    error = float(np.max(np.abs(spread - np.eye(len(values)))))
    n, sums, mean, shares = found.n, found.sums, found.mean, values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1), width)
            m = len(x)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, np.int64)), pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(((x - mean) @ scaled).ravel()), pa.array(np.tile(shares, m)), pa.array(np.full(m * k, error))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("id", filled(F.col("x"), width).alias("x")).mapInArrow(run, schema).withColumnRenamed("id", id_col)
