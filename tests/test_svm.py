"""Squared-hinge machines and their sigmoids: conditions of the optimum, by hand, on each model's own rows."""
import numpy as np

from heartspark import schema as S
from heartspark.operators import svm as V
from heartspark.operators.logistic import FEATURES, SCALED
from heartspark.operators import sampling as SP
from heartspark.sources.tables import survey_base


def test_machines_and_sigmoids_are_optimal(spark):
    b = survey_base(spark, "/root/testdata/sf0.001").select("respondent_id", *S.FEATURES, S.TARGET)
    folds = SP.stratified_folds(b, 2)
    rows = V.as_rows(folds).repartition(3).cache()
    models, passes = V.fit_all(rows, [0.01, 1.0], [0, 1])
    assert len(models) == 2 * 2 * 3 and all(m.converged for m in models) and passes < 30
    data = rows.collect()
    x, y = np.array([r.x for r in data]), np.array([r.y for r in data])
    fold, inner = np.array([r.fold for r in data]), np.array([r.inner for r in data])
    scaled = np.array([c in SCALED for c in FEATURES])
    for m in models:
        own = (fold != m.held) & (inner != m.inner)
        mean, std = np.where(scaled, x[own].mean(axis=0), 0), np.where(scaled, x[own].std(axis=0, ddof=1), 1)
        z = np.hstack([np.ones((own.sum(), 1)), (x[own] - mean) / std])
        sign, n = np.where(y[own] == 1, 1.0, -1.0), own.sum()
        weight = np.where(y[own] == 1, n / (2 * y[own].sum()), n / (2 * (n - y[own].sum())))
        w = np.concatenate([[m.coefficients[0] + m.coefficients[1:] @ mean], m.coefficients[1:] * std])
        gap = np.maximum(0, 1 - sign * (z @ w))
        gradient = w - 2 * m.penalty * z.T @ (weight * gap * sign)
        assert np.abs(gradient).max() < 1e-5 * max(1.0, np.abs(w).max())
    done = V.calibrated(rows, models)
    for m in done:
        own = (fold != m.held) & (inner == m.inner)
        margin = np.hstack([np.ones((own.sum(), 1)), x[own]]) @ m.coefficients
        pos = y[own].sum()
        target = np.where(y[own] == 1, (pos + 1) / (pos + 2), 1 / (own.sum() - pos + 2))
        gap = target - m.probability(margin)
        assert abs(gap.sum()) < 1e-4 and abs((gap * margin).sum()) < 1e-4
    counts = {}
    for r in V.grouped_counts(rows, done, [k // 3 for k in range(12)], [0, 1]).collect():
        counts[r.grp] = counts.get(r.grp, 0) + r.score * (r.pos + r.neg)
    for g in range(4):
        own = fold == done[3 * g].held
        z = np.hstack([np.ones((own.sum(), 1)), x[own]])
        assert np.isclose(counts[g], sum(m.probability(z @ m.coefficients) for m in done[3 * g:3 * g + 3]).sum() / 3)
    rows.unpersist()


def test_one_class(spark):
    """Rows of one class: nothing to part, no error."""
    b = survey_base(spark, "/root/testdata/sf0.001").where(f"{S.TARGET} = 0").limit(60).select("respondent_id", *S.FEATURES, S.TARGET)
    from pyspark.sql import functions as F
    rows = V.as_rows(b.withColumn("fold", F.lit(0)))
    models, _ = V.fit_all(rows, [1.0], [-1])
    assert all(np.isfinite(m.coefficients).all() for m in V.calibrated(rows, models))
