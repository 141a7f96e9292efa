"""Embedding whitening against a dense eigenvalue solver, and on odd vectors."""
import math

import numpy as np
import pytest

from edge_tables import SF0001
from heartspark.llm import queries
from heartspark.llm import whitening as wh


@pytest.mark.parametrize("width,spectrum", [
    (1, [3.0]), (3, [5.0, 4.0, 1.0]), (4, [1.0, 1.0, 1.0, 1.0]), (20, [10.0, 9.999, 9.998, 9.99, 9.0]), (64, [1e6, 10.0, 9.0, 8.0, 7.999]),
    (200, [50.0, 49.9, 49.8, 49.7, 49.6, 49.5]), (90, [4.0, 3.0])])
def test_solver(width, spectrum):
    """Eigenpairs to double precision: separated, close, equal, far apart and missing ones."""
    rng = np.random.default_rng(width)
    q, _ = np.linalg.qr(rng.standard_normal((width, width)))
    full = np.concatenate([spectrum, np.linspace(min(spectrum) * 0.9, 0.01, width)])[:width] if len(spectrum) > 2 else np.array(spectrum + [0.0] * (width - len(spectrum)))
    a = (q * full) @ q.T
    a = (a + a.T) / 2
    passes = []
    values, vectors = wh.leading(lambda w: passes.append(w.shape[1]) or a @ w, width)
    k = min(4, width)
    assert np.allclose(values, np.sort(full)[::-1][:k], rtol=1e-13, atol=1e-13 * full.max())
    assert np.max(np.abs(vectors.T @ vectors - np.eye(k))) < 1e-13
    assert np.max(np.linalg.norm(a @ vectors - vectors * values, axis=0)) < 1e-12 * full.max()
    assert len(passes) < 200


def test_minres_solves():
    rng = np.random.default_rng(2)
    m = rng.standard_normal((30, 30))
    a, b, shifts = m + m.T, rng.standard_normal((30, 3)), np.array([0.0, 1.0, -2.0])
    x = wh.minres(lambda v: a @ v - v * shifts, b, 60, 1e-13)
    assert np.max(np.abs(a @ x - x * shifts - b)) < 1e-9


def by_hand(rows):
    """Dense version: {id: rows of (component, n, deviation, |whitened|)} and shares."""
    good = [(i, [math.floor(256 * float(np.float64(c))) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max(len(v) for _, v in good)
    good = [(i, v + [0] * (width - len(v))) for i, v in good]
    u = np.unique(np.array([v for _, v in good]), axis=0)
    mean, n, sums = u.mean(axis=0), len(u), u.sum(axis=0)
    values, q = np.linalg.eigh((u - mean).T @ (u - mean) / n)
    values, q = values[::-1], q[:, ::-1]
    k = min(4, int(np.sum(values > 1e-9 * values[0])))
    out = [(i, c + 1, n, int(((n * np.array(v) - sums) ** 2).sum()), abs(float((np.array(v) - mean) @ q[:, c]) / math.sqrt(values[c])))
           for i, v in good for c in range(k)]
    return sorted(out, key=str), values[:k] / values.sum()


def compare(df, rows):
    got = df.collect()
    want, shares = by_hand(rows)
    mine = sorted([(r.vec_id, r.component, r.n, r.deviation, abs(r.whitened)) for r in got], key=str)
    assert [r[:4] for r in mine] == [r[:4] for r in want]
    assert np.allclose([r[4] for r in mine], [r[4] for r in want], rtol=1e-8, atol=1e-9)
    for r in got:
        assert math.isclose(r.explained, shares[r.component - 1], rel_tol=1e-9) and 0 <= r.identity_error < 1e-9
    signs = {}
    return got, signs


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").collect()]
    compare(queries.op12_whitening(spark, SF0001), rows)


def test_odd_vectors(spark):
    """Null, empty, short, not finite, repeated and clashing; a null id; one row of large entries."""
    rng = np.random.default_rng(4)
    rows = [(k, [float(c) for c in rng.standard_normal(6)]) for k in range(40)]
    rows += [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan")] * 6), (103, [float("inf")] + [0.0] * 5), (104, []), (105, [0.5, -0.25]),
             (None, [0.1] * 6), (0, list(rows[0][1])), (107, [-0.0] * 6), (108, [3000.0, -2.0, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in ("id", "x", "v", "m", "n", "component", "label"):
        df = df.withColumn(name, df.vec_id)
    got, _ = compare(wh.whiten(df), rows)
    assert len(got) == 4 * 46
    copies = {r.component: r.whitened for r in got if r.vec_id == 0}
    assert len(copies) == 4
    assert all(len({r.whitened for r in got if r.vec_id == 0 and r.component == c}) == 1 for c in copies)


def test_few_vectors(spark):
    """Fewer components than four where the variance ends; none for one vector, empty vectors and an empty table."""
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    line = [(k, [float(k), 2.0 * k, 0.0, 0.0, 0.0, 0.0]) for k in range(5)]
    compare(wh.whiten(make(line)), line)
    assert {r.component for r in wh.whiten(make(line)).collect()} == {1}
    narrow = [(k, [float(k % 3), float(k % 2)]) for k in range(6)]
    compare(wh.whiten(make(narrow)), narrow)
    for rows in ([(1, [0.5, 0.5])] * 3, [(1, []), (2, [])], [(1, None)], []):
        assert wh.whiten(make(rows)).count() == 0


def test_exact_deviations():
    """Beyond what 64 bits hold on the way, and null beyond what a long holds."""
    x = np.array([[3_000_000_000, 1], [2, 5]], np.int64)
    assert wh.deviations(x, 1, [0, 0]) == [9 * 10**18 + 1, 29]
    assert wh.deviations(x * 2, 1, [0, 0])[0] is None
    assert list(wh._sums(np.array([[-1, 1 << 40], [-5, 3]], np.int64))) == [2, -2, 256, (1 << 33) - 6, 3]
