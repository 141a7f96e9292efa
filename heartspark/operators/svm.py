"""Linear support vector machines with the squared hinge loss, a whole grid fitted together and calibrated.

Each model minimises half the squared norm of its coefficients, the intercept's with them, plus C times the
class-weighted squared hinge loss. Its Newton step needs the rows within the margin only: one pass gives loss, gradient and Hessian
of every (setting, outer fold, inner fold) model, and the driver solves systems of d + 1 unknowns; a step that doesn't
lower the loss is halved. Then a sigmoid of each model's margin is fitted on the inner fold that the model hasn't seen,
again for all models in the same passes, and a row's score is the mean of its models' sigmoids.

A row's inner fold is a hash of its id; features are standardised over a model's own training rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..session import cut_lineage, ship_package
from .logistic import FEATURES, SCALED, matrix
from .passes import summed

INNER = 3
TOLERANCE, MOST_PASSES = 1e-12, 100


@dataclass(frozen=True)
class Machine:
    """Coefficients on the rows' own values (intercept first), and slope and offset of the sigmoid. ``held`` and ``inner`` are the folds left out (-1: none)."""
    penalty: float
    held: int
    inner: int
    coefficients: np.ndarray
    slope: float = -1.0
    offset: float = 0.0
    converged: bool = False

    def learns(self, fold: np.ndarray, inner: np.ndarray) -> np.ndarray:
        return (fold != self.held) & (inner != self.inner)

    def calibrates(self, fold: np.ndarray, inner: np.ndarray) -> np.ndarray:
        return (fold != self.held) & (inner == self.inner)

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(np.clip(self.slope * margin + self.offset, -700, 700)))


def as_rows(df: DataFrame, label: str = S.TARGET, key: str = "respondent_id", inner: int = INNER) -> DataFrame:
    """(x, y, fold, inner)."""
    return df.select(F.array(*[F.col(c).cast("double") for c in FEATURES]).alias("x"), F.col(label).cast("int").alias("y"),
                     F.col("fold").cast("int").alias("fold"), F.pmod(F.xxhash64(key), F.lit(inner)).cast("int").alias("inner"))


def _scales(rows: DataFrame, models: list[Machine]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each model the matrix that standardises a row (1, x), and both classes' weights, of its training rows."""
    d = len(FEATURES)
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)] + [F.sum(F.col("x")[i] * F.col("x")[i]).alias(f"q{i}") for i in range(d)]
    found = rows.groupBy("fold", "inner", "y").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    scaled = np.array([c in SCALED for c in FEATURES])
    out, weights = [], np.zeros((2, len(models)))
    for k, m in enumerate(models):
        own = [r for r in found if m.learns(np.array(r["fold"]), np.array(r["inner"]))]
        counts = [sum(r["n"] for r in own if r["y"] == y) for y in (0, 1)]
        n = max(1, sum(counts))
        weights[:, k] = [n / (2 * c) if c else 0.0 for c in counts]
        s, q = (np.array([sum(r[f"{name}{i}"] for r in own) for i in range(d)], float) for name in "sq")
        mean = s / n
        std = np.sqrt(np.maximum(0.0, (q - n * mean * mean) / max(1, n - 1)))
        std, mean = np.where(scaled & (std > 0), std, 1.0), np.where(scaled, mean, 0.0)
        a = np.eye(d + 1)
        a[1:, 0], a[1:, 1:] = -mean / std, np.diag(1 / std)
        out.append(a)
    return out, weights


def _sums(rows: DataFrame, models: list[Machine], beta: np.ndarray, weights: np.ndarray, tasks: int) -> np.ndarray:
    """Of each model: loss, gradient and Hessian over its training rows, on the rows' own values."""
    p = len(beta)
    light = [replace(m, coefficients=np.zeros(0)) for m in models]
    size = 1 + p + p * p

    def part(batch: pa.RecordBatch) -> np.ndarray:
        x, y, fold, inner = matrix(batch), *[batch.column(i).to_numpy() for i in (1, 2, 3)]
        sign = np.where(y == 1, 1.0, -1.0)
        short = np.maximum(0.0, 1.0 - sign[:, None] * (x @ beta))
        out = np.zeros((len(light), size))
        for k, m in enumerate(light):
            own = np.flatnonzero(m.learns(fold, inner) & (short[:, k] > 0))
            w, gap, some = weights[y[own], k], short[own, k], x[own]
            out[k, 0] = (w * gap * gap).sum()
            out[k, 1:1 + p] = -2 * some.T @ (w * gap * sign[own])
            out[k, 1 + p:] = (2 * some.T @ (some * w[:, None])).ravel()
        return out.ravel()

    return summed(rows, part, len(models) * size, tasks).reshape(len(models), size)


def fit_all(rows: DataFrame, penalties: list[float], held: list[int], inner: list[int] | None = None, tolerance: float = TOLERANCE) -> tuple[list[Machine], int]:
    """Machines (setting, held-out fold, inner fold) in this order of nesting, without sigmoids, and the passes made. ``rows`` as as_rows() gives them."""
    ship_package(rows.sparkSession)
    d = len(FEATURES) + 1
    models = [Machine(c, f, j, np.zeros(d)) for c in penalties for f in held for j in (range(INNER) if inner is None else inner)]
    shift, weights = _scales(rows, models)
    tasks = rows.rdd.getNumPartitions()
    at, step = np.zeros((len(models), d)), np.zeros((len(models), d))
    best, way, done = np.full(len(models), np.inf), np.ones(len(models)), np.zeros(len(models), bool)
    passes = 0
    while not done.all() and passes < MOST_PASSES:
        live = np.flatnonzero(~done)
        trial = at[live] + way[live, None] * step[live]
        found = _sums(rows, [models[k] for k in live], np.stack([shift[k].T @ t for k, t in zip(live, trial)], axis=1), weights[:, live], tasks)
        passes += 1
        for k, t, row in zip(live, trial, found):
            c = models[k].penalty
            loss = c * row[0] + t @ t / 2
            if loss > best[k] + 1e-12 * abs(best[k]):
                way[k] /= 2
                done[k] = way[k] < 1e-9
                continue
            at[k], best[k], way[k] = t, loss, 1.0
            gradient = c * shift[k] @ row[1:1 + d] + t
            hessian = c * shift[k] @ row[1 + d:].reshape(d, d) @ shift[k].T + np.eye(d)
            step[k] = -np.linalg.solve(hessian, gradient)
            done[k] = -gradient @ step[k] <= 2 * tolerance * max(1.0, loss)
    return [replace(m, coefficients=shift[k].T @ at[k], converged=bool(done[k] and way[k] >= 1e-9)) for k, m in enumerate(models)], passes


def calibrated(rows: DataFrame, models: list[Machine]) -> list[Machine]:
    """With the sigmoid of each: Newton's method on the log loss of the rows of its inner fold, whose targets are drawn in a little
    by the numbers of both classes."""
    tasks = rows.rdd.getNumPartitions()
    beta = np.stack([m.coefficients for m in models], axis=1)
    light = [replace(m, coefficients=np.zeros(0)) for m in models]

    def sums(at: np.ndarray, target: np.ndarray | None) -> np.ndarray:
        def part(batch: pa.RecordBatch) -> np.ndarray:
            x, y, fold, inner = matrix(batch), *[batch.column(i).to_numpy() for i in (1, 2, 3)]
            margin = x @ beta
            out = np.zeros((len(light), 6))
            for k, m in enumerate(light):
                own = m.calibrates(fold, inner)
                z, label = margin[own, k], y[own]
                if target is None:
                    out[k, :2] = (label == 0).sum(), (label == 1).sum()
                    continue
                t = target[label, k]
                u = at[k, 0] * z + at[k, 1]  # minus the log-odds
                p = 1.0 / (1.0 + np.exp(np.clip(u, -700, 700)))
                gap, v = t - p, p * (1 - p)
                out[k] = (t * np.logaddexp(0, u) + (1 - t) * np.logaddexp(0, -u)).sum(), (gap * z).sum(), gap.sum(), (v * z * z).sum(), (v * z).sum(), v.sum()
            return out.ravel()

        return summed(rows, part, 6 * len(light), tasks).reshape(-1, 6)

    counts = sums(np.zeros((len(models), 2)), None)[:, :2]
    target = np.stack([1 / (counts[:, 0] + 2), (counts[:, 1] + 1) / (counts[:, 1] + 2)])
    at = np.stack([np.zeros(len(models)), np.log((counts[:, 0] + 1) / (counts[:, 1] + 1))], axis=1)
    step, best, way, done = np.zeros_like(at), np.full(len(models), np.inf), np.ones(len(models)), np.zeros(len(models), bool)
    for _ in range(MOST_PASSES):
        trial = at + way[:, None] * step
        for k, (loss, gz, g, hzz, hz, h) in enumerate(sums(trial, target)):
            if done[k]:
                continue
            if loss > best[k] + 1e-12 * abs(best[k]):
                way[k] /= 2
                done[k] = way[k] < 1e-9
                continue
            at[k], best[k], way[k] = trial[k], loss, 1.0
            step[k] = -np.linalg.solve(np.array([[hzz, hz], [hz, h]]) + 1e-12 * np.eye(2), np.array([gz, g]))
            done[k] = abs(np.array([gz, g]) @ step[k]) <= 1e-12 * max(1.0, loss)
        if done.all():
            break
    return [replace(m, slope=float(a), offset=float(b)) for m, (a, b) in zip(models, at)]


def grouped_counts(rows: DataFrame, models: list[Machine], groups: list[int], folds: list[int] | None) -> DataFrame:
    """(grp, score, pos, neg): rows scored by the mean of a group's machines; with ``folds`` only rows of the group's held-out fold."""
    ship_package(rows.sparkSession)
    own = {g: [m for m, k in zip(models, groups) if k == g] for g in dict.fromkeys(groups)}

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, fold = matrix(batch), *[batch.column(i).to_numpy() for i in (1, 2)]
            for g, machines in own.items():
                use = np.ones(len(y), bool) if folds is None else fold == machines[0].held
                score = sum(m.probability(x[use] @ m.coefficients) for m in machines) / len(machines)
                score, at = np.unique(score, return_inverse=True)
                pos = np.bincount(at, y[use], len(score)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), g, np.int32)), pa.array(score), pa.array(pos),
                                                  pa.array(np.bincount(at, minlength=len(score)).astype(np.int64) - pos)], names=["grp", "score", "pos", "neg"])

    out = rows.mapInArrow(run, "grp int, score double, pos long, neg long")
    return out.groupBy("grp", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def grid_counts(folds: DataFrame, penalties: list[float], held: list[int]) -> DataFrame:
    """(grp, score, pos, neg) of the whole grid: grp = setting * folds + fold."""
    rows = cut_lineage(as_rows(folds)).cache()
    models, _ = fit_all(rows, penalties, held)
    models = calibrated(rows, models)
    groups = [k // INNER for k in range(len(models))]
    out = cut_lineage(grouped_counts(rows, models, groups, held))
    rows.unpersist()
    return out
