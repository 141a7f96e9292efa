"""Boosted trees on shared histograms against trees grown by hand."""
import math
import random

import numpy as np
import pytest

from heartspark.operators import binned
from heartspark.operators import boosting as B

NAMES = ["a", "b", "c"]


def table(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.randrange(8), rng.randrange(2), rng.randrange(30) / 3
        y = int(rng.random() < 1 / (1 + math.exp(-(a - 4) * 0.8 + b - c * 0.1)))
        rows.append((i, a, b, c, y, i % 2))
    return rows


def by_hand(rows, setting, held, positive):
    """Trees as nested tuples of all rows but the held-out ones, and the margins of all rows."""
    x = np.array([r[1:4] for r in rows], float)
    y = np.array([r[4] for r in rows])
    train = np.array([r[5] != held for r in rows])
    w = np.where(y == 1, positive, 1.0)
    margin, trees = np.zeros(len(rows)), []

    def grow(own, g, h, depth):
        gs, hs = g[own].sum(), h[own].sum()
        best = None
        if depth < setting.depth:
            for f in range(3):
                values = np.unique(x[:, f])
                for cut in (values[1:] + values[:-1]) / 2:
                    left = own & (x[:, f] <= cut)
                    gl, hl = g[left].sum(), h[left].sum()
                    if min(hl, hs - hl) < setting.least_weight * (1 - 1e-9):
                        continue
                    gain = gl ** 2 / (hl + setting.penalty) + (gs - gl) ** 2 / (hs - hl + setting.penalty) - gs ** 2 / (hs + setting.penalty)
                    if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-9)):
                        best = gain, f, cut
        if best is None:
            return -setting.rate * gs / (hs + setting.penalty)
        left = x[:, best[1]] <= best[2]
        return best[1], best[2], grow(own & left, g, h, depth + 1), grow(own & ~left, g, h, depth + 1)

    def value(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    for _ in range(setting.rounds):
        p = 1 / (1 + np.exp(-margin))
        trees.append(grow(train, w * (p - y), w * p * (1 - p), 0))
        margin = margin + np.array([value(trees[-1], row) for row in x])
    return trees, margin


def as_tuples(tree, bins, i=0):
    if tree.feature[i] < 0:
        return tree.value[i]
    f = int(tree.feature[i])
    return f, bins.cuts[f][tree.cut[i]], as_tuples(tree, bins, 2 * i + 1), as_tuples(tree, bins, 2 * i + 2)


def same(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if not isinstance(a, tuple):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return a[0] == b[0] and math.isclose(a[1], b[1]) and same(a[2], b[2]) and same(a[3], b[3])


def test_trees_equal_those_by_hand(spark, monkeypatch):
    """Several depths, rates, penalties and folds at once; margins kept, renewed and cut on the way."""
    monkeypatch.setattr(B, "NEW_TREES", 2)
    monkeypatch.setattr(B, "CHAIN", 2)
    rows = table(240)
    df = spark.createDataFrame(rows, "respondent_id long, a int, b int, c double, heart_disease int, fold int").repartition(3)
    settings = [B.Setting(1, 0.3, 1.0, 6), B.Setting(3, 0.1, 5.0, 5), B.Setting(4, 0.5, 1.0, 7, 2.0)]
    bins = binned.learn_bins(df, NAMES)
    assert [len(c) for c in bins.cuts] == [7, 1, 29]
    fit = B.fit_all(df, NAMES, settings, [0, 1, -1], bins=bins)
    positive = sum(r[4] == 0 for r in rows) / sum(r[4] for r in rows)
    counts = {}
    for r in fit.counts().collect():
        counts.setdefault(r.grp, []).append((round(r.score, 9), r.pos, r.neg))
    for k, m in enumerate(fit.models):
        trees, margin = by_hand(rows, m.setting, m.held, positive)
        assert len(m.trees) == m.setting.rounds and all(same(as_tuples(a, bins), b) for a, b in zip(m.trees, trees))
        held = [(1 / (1 + math.exp(-margin[r[0]])), r[4]) for r in rows if r[5] == m.held]
        if m.held >= 0:
            want = {}
            for s, y in held:
                want.setdefault(round(s, 9), [0, 0])[1 - y] += 1
            assert sorted(counts[k]) == sorted((s, p, n) for s, (p, n) in want.items())
    done = {r.respondent_id: r.score for r in B.scores(df.select("respondent_id", *NAMES), [B.Booster.from_json(fit.boosters()[-1].to_json())], ["score"]).collect()}
    assert all(math.isclose(done[r[0]], 1 / (1 + math.exp(-margin[r[0]])), rel_tol=1e-9) for r in rows)
    assert fit.passes <= 7 * 4
    fit.release()


def test_shares_and_made_rows(spark):
    """A model of a share learns from the first rows by hash alone, and made rows go to the model that holds out their fold."""
    rows = table(240)
    made = [(1000 + i, *r[1:5], B.MADE + r[5]) for i, r in enumerate(rows[:60])]
    df = spark.createDataFrame(rows + made, "respondent_id long, a int, b int, c double, heart_disease int, fold int")
    order = B.order_of(np.array([r[0] for r in rows + made]))
    setting = B.Setting(3, 0.1, 1.0, 4)
    fit = B.fit_all(df, NAMES, [setting], [0, 1], positive=2.0, shares=[0.4, 1.0])
    sizes = {}
    for r in fit.counts(training=True).collect():
        sizes[r.grp] = sizes.get(r.grp, 0) + r.pos + r.neg
    for k, m in enumerate(fit.models):
        own = [r for r, o in zip(rows + made, order) if o < m.share and r[5] != m.held and (r[5] < B.MADE or r[5] == B.MADE + m.held)]
        assert sizes[2 * k] == 120 and sizes[2 * k + 1] == len(own)
        inside = {r[0] for r in own}
        trees, _ = by_hand([(*r[:5], int(r[0] in inside)) for r in rows + made], setting, 0, 2.0)
        assert all(same(as_tuples(a, fit.bins), b) for a, b in zip(m.trees, trees))
    small, whole = fit.models[0], fit.models[2]
    assert (small.share, whole.share) == (0.4, 1.0) and sizes[1] < 0.6 * sizes[5]
    fit.release()


@pytest.mark.parametrize("rows", [[(0, 1, 0, 0.5, 1, 0)], [(i, 3, 1, 2.0, i % 2, i % 2) for i in range(40)]])
def test_nothing_to_split(spark, rows):
    """One row, one class, one value for each feature: trees of one leaf."""
    df = spark.createDataFrame(rows, "respondent_id long, a int, b int, c double, heart_disease int, fold int")
    fit = B.fit_all(df, NAMES, [B.Setting(3, 0.1, 1.0, 3)], [-1])
    assert all(t.feature[0] == -1 for t in fit.models[0].trees) and len(fit.models[0].trees) == 3
    fit.release()


def test_bins(spark):
    """Few values: a cut between any two. Many: quantiles, within the number of bins."""
    df = spark.createDataFrame([(i % 5, i / 7) for i in range(4000)], "a int, b double")
    bins = binned.learn_bins(df, ["a", "b"])
    assert list(bins.cuts[0]) == [0.5, 1.5, 2.5, 3.5] and 100 < len(bins.cuts[1]) < binned.MOST_BINS
    codes = bins.codes([np.array([0.0, 2.0, 4.0, 9.0]), np.array([-1.0, 0.0, 300.0, 1e9])])
    assert list(codes[0]) == [0, 2, 4, 4] and codes[1][0] == 0 and codes[1][3] == len(bins.cuts[1])


def test_passes_and_one_task_grow_the_same_trees(spark, monkeypatch):
    """Few rows: each model is one task's and no pass is a job. More: passes, whose trees and margins are the same, however often margins are renewed."""
    rows = table(240)
    df = spark.createDataFrame(rows, "respondent_id long, a int, b int, c double, heart_disease int, fold int").repartition(3)
    settings = [B.Setting(1, 0.3, 1.0, 6), B.Setting(4, 0.5, 1.0, 7)]

    def fitted():
        fit = B.fit_all(df, NAMES, settings, [0, 1], shares=[0.6, 1.0])
        counts = sorted((r.grp, round(r.score, 9), r.pos, r.neg) for r in fit.counts(training=True).collect())
        fit.release()
        return fit, [[as_tuples(t, fit.bins) for t in m.trees] for m in fit.models], counts

    one, trees, counts = fitted()
    assert one.passes == 0 and all(len(t) == m.setting.rounds for t, m in zip(trees, one.models))
    monkeypatch.setattr(B, "LOCAL_ROWS", 0)
    for renewal in (0.0, 1e18):
        monkeypatch.setattr(B, "RENEWAL_NS", renewal)
        passes, others, again = fitted()
        assert 0 < passes.passes <= 7 * 4 and again == counts
        assert all(same(a, b) for x, y in zip(trees, others) for a, b in zip(x, y))


def test_packs(spark):
    """Groups of features hold each feature once, have at most 256 cells, lead down trees as the features do, and give the features' counts."""
    rng = np.random.default_rng(1)
    widths = [2] * 9 + [1, 3, 31, 128, 87]
    bins = binned.Bins([f"f{i}" for i in range(len(widths))], [np.arange(w - 1) + 0.5 for w in widths])
    packs = binned.Packs(bins)
    assert sorted(f for g in packs.groups for f in g) == list(range(len(widths))) and max(packs.sizes) <= 256 and len(packs.groups) < len(widths) / 2
    codes = np.stack([rng.integers(0, w, 500) for w in widths]).astype(np.uint8)
    groups, weight = packs.codes(codes), rng.random(500)
    sums = np.concatenate([np.bincount(g, weight, size) for g, size in zip(groups, packs.sizes)])[None, :]
    want = np.concatenate([np.bincount(c, weight, w) for c, w in zip(codes, widths)])
    assert np.allclose(packs.spread(sums, 1)[0, 0], want)
    tree = B.Tree.empty(4)
    for i in [0, 1, 2, 4, 5, 9, 11]:
        tree.feature[i] = rng.integers(0, len(widths))
        tree.cut[i] = rng.integers(0, widths[tree.feature[i]])
    assert all((B.Route(tree, k, packs).nodes(groups) == tree.nodes(codes, k)).all() for k in range(5))


def test_a_task_gets_its_models_rows_alone(spark):
    """The rows dealt to a model's task are those that it learns from or holds out, and carry no cells back."""
    rows = table(240)
    made = [(1000 + i, *r[1:5], B.MADE + r[5]) for i, r in enumerate(rows[:60])]
    df = spark.createDataFrame(rows + made, "respondent_id long, a int, b int, c double, heart_disease int, fold int")
    fit = B.fit_all(df, NAMES, [B.Setting(2, 0.1, 1.0, 3), B.Setting(3, 0.1, 1.0, 2)], [0, 1], positive=2.0, shares=[0.4, 1.0])
    order = B.order_of(np.array([r[0] for r in rows + made]))
    got = {}
    for r in fit.rows.collect():
        assert not r.groups and len(r.margins) == 8 * len(r.y)
        got[r.model] = got.get(r.model, 0) + len(r.y)
    for k, m in enumerate(fit.models):
        fold = np.array([r[5] for r in rows + made])
        assert got[k] == int(((fold == m.held) | B.trains(m, fold, order)).sum()) < len(rows + made)
    fit.release()


def test_ways_down_many_trees():
    """Levels and masks lead rows to the leaves that the trees' nodes do, in whole trees, cut ones and stumps."""
    rng = np.random.default_rng(5)
    widths = [2] * 9 + [1, 3, 31, 128, 87]
    bins = binned.Bins([f"f{i}" for i in range(len(widths))], [np.arange(w - 1) + 0.5 for w in widths])
    packs = binned.Packs(bins)
    codes = np.stack([rng.integers(0, w, 900) for w in widths]).astype(np.uint8)
    groups = packs.codes(codes)
    for depth in (1, 3, 6):
        trees = []
        for share in (1.0, 0.6, 0.0):
            tree = B.Tree.empty(depth)
            for i in range(2 ** depth - 1):
                if (i == 0 and share) or (i and tree.feature[(i - 1) // 2] >= 0 and rng.random() < share):
                    tree.feature[i] = rng.integers(0, len(widths))
                    tree.cut[i] = rng.integers(0, widths[tree.feature[i]])
            tree.value[:] = rng.normal(size=len(tree.value))
            trees.append(tree)
        want = sum(t.value.take(t.nodes(codes, depth)) for t in trees)
        assert np.allclose(B.margins_by(trees, depth, packs, groups), want)
        assert np.allclose(B.Booster(B.Setting(depth), trees, bins).margins(codes), want)
        for tree in trees:
            at = np.zeros(900, np.int32)
            for level in range(depth):
                at = B.Step(tree, level, packs).down(groups, at)
            assert (at == tree.nodes(codes, depth)).all()
