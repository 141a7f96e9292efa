"""Tree contributions against brute-force Shapley values computed row by row."""
import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from heartspark import schema as S
from heartspark.operators import models as MD
from heartspark.operators import treeshap as TS
from heartspark.sources.tables import survey_base


def _brute(nodes, x, n_features):
    def expect(i, subset):
        n = nodes[i]
        if n["feature"] is None:
            return n["value"]
        if n["feature"] in subset:
            return expect(n["left"] if x[n["feature"]] <= n["threshold"] else n["right"], subset)
        cl, cr = nodes[n["left"]]["cover"], nodes[n["right"]]["cover"]
        return (cl * expect(n["left"], subset) + cr * expect(n["right"], subset)) / (cl + cr)
    feats = list(range(n_features))
    used = sorted({n["feature"] for n in nodes if n["feature"] is not None})
    phi = np.zeros(n_features)
    m = len(used)
    for j in used:
        others = [f for f in used if f != j]
        for k in range(m):
            for sub in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                phi[j] += w * (expect(0, set(sub) | {j}) - expect(0, set(sub)))
    return phi


def test_contributions_match_brute_force(spark):
    b = survey_base(spark, "/root/testdata/sf0.001").select("respondent_id", *S.FEATURES, S.TARGET)
    m = MD.fit(b, "boosting", {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.1})
    names = MD.SCALED + MD.PASSTHROUGH
    got = TS.contributions(m, b, names).where("respondent_id <= 15").toPandas()
    prep = b
    for st in m.stages[:-1]:
        prep = st.transform(prep)
    rows = prep.where("respondent_id <= 15").select("respondent_id", vector_to_array("features").alias("x")).collect()
    gbt = m.stages[-1]
    trees = [TS._tree_nodes(t._java_obj.rootNode()) for t in gbt.trees]
    for r in rows:
        exp = sum(2 * w * _brute(nodes, r["x"], len(names)) for nodes, w in zip(trees, gbt.treeWeights))
        g = got[got.respondent_id == r["respondent_id"]].set_index("variable")["value"].reindex(names).to_numpy()
        assert np.allclose(g, exp, atol=1e-12)


@pytest.mark.parametrize("depth", [3, 5, 7])
def test_local_accuracy(spark, depth):
    """At every depth of the boosting grid: there is no limit on the splits of a tree."""
    b = survey_base(spark, "/root/testdata/sf0.001").select("respondent_id", *S.FEATURES, S.TARGET)
    m = MD.fit(b, "boosting", {"n_estimators": 3, "max_depth": depth, "learning_rate": 0.1})
    c = TS.contributions(m, b, MD.SCALED + MD.PASSTHROUGH)
    s = c.groupBy("respondent_id").agg(F.sum("value").alias("s"), F.first("base").alias("base"))
    raw = m.transform(b).select("respondent_id", (vector_to_array("rawPrediction")[1] * 2).alias("lo"))
    worst = s.join(raw, "respondent_id").agg(F.max(F.abs(F.col("s") + F.col("base") - F.col("lo")))).first()[0]
    assert worst < 1e-9


def test_tables_of_ways():
    """A tree of few splits is looked up, one of many is reckoned for the rows, with the same contributions."""
    import numpy as np
    from heartspark.operators import boosting as B
    from heartspark.operators import treeshap as TS
    from heartspark.operators.binned import Bins
    rng = np.random.default_rng(2)
    bins = Bins(["a", "b", "c"], [np.arange(7) + 0.5] * 3)
    trees = []
    for depth in (0, 3, 5):
        tree = B.Tree.empty(depth)
        inner = 2 ** depth - 1
        tree.feature[:inner], tree.cut[:inner] = rng.integers(0, 3, inner), rng.integers(0, 7, inner)
        tree.value[inner:] = rng.normal(size=inner + 1)
        tree.weight[inner:] = rng.random(inner + 1) + 0.1
        for i in range(inner - 1, -1, -1):
            tree.weight[i] = tree.weight[2 * i + 1] + tree.weight[2 * i + 2]
        trees.append((2.0, *TS._leaves(TS._heap_nodes(tree, bins))))
    ready = TS.tables(trees)
    assert [t is None for t in ready] == [False, False, True]
    x = rng.integers(0, 8, (9000, 3)).astype(float)
    assert np.allclose(TS.shap_values(trees, x, 3), TS.shap_values(trees, x, 3, [None] * 3))
