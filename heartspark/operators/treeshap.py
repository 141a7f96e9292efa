"""Exact path-dependent SHAP contributions of a boosted-tree model, at scale.

For one tree, the path-dependent conditional expectation of a feature subset
S is: at a split on a feature in S follow the row's side, otherwise average
both children weighted by their training cover. Its Shapley values are the
row's contributions (local accuracy: they add up to the margin minus the
expected margin).

A tree is the sum of its leaves, and a leaf depends on the few features of its
path: feature k counts with o_k = 1 if the row takes the path at all of its
splits on k, else 0, and when averaged with z_k, the product of the cover
shares of those splits. Since the Shapley weight of a subset of size s among m
features is the integral of t^s (1 - t)^(m - 1 - s) over [0, 1], feature j gets

    value * (o_j - z_j) * integral of prod_{k != j} (o_k t + z_k (1 - t)) dt,

a polynomial of degree m - 1 that Gauss-Legendre points integrate exactly. The
cost is polynomial in the depth, with no limit on it. The model (bounded by its
trees, not by the data) is broadcast and applied batch by batch,
vectorised over the rows.

A tree's contributions depend on which way a row goes at each split, and on nothing else. Those of a tree
of few splits are computed once for all ways, and looked up for rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package, spread_out

#: Trees of up to this many splits have a table of all their ways.
TABLE_SPLITS = 10
#: Rows at a time, which a processor's cache holds.
STRETCH = 4096


def _tree_nodes(java_root):
    """Flatten a Spark tree: list of dicts (feature, threshold, left, right, cover, value)."""
    nodes = []

    def walk(n):
        i = len(nodes)
        nodes.append(None)
        cover = float(n.impurityStats().count())
        if n.getClass().getSimpleName() == "InternalNode":
            sp = n.split()
            left = walk(n.leftChild())
            right = walk(n.rightChild())
            nodes[i] = dict(feature=int(sp.featureIndex()), threshold=float(sp.threshold()), left=left, right=right,
                            cover=cover, value=None)
        else:
            nodes[i] = dict(feature=None, threshold=None, left=None, right=None, cover=cover, value=float(n.prediction()))
        return i
    walk(java_root)
    return nodes


def _leaves(nodes):
    """(splits, leaves): splits as (feature, threshold); a leaf is (value, features, z of each, its
    (split, goes left) conditions of each)."""
    splits, leaves = [], []

    def walk(i, path):
        n = nodes[i]
        if n["feature"] is None:
            by = {}
            for split, left, share in path:
                by.setdefault(splits[split][0], []).append((split, left, share))
            leaves.append((n["value"], list(by), [float(np.prod([p[2] for p in c])) for c in by.values()],
                           [[p[:2] for p in c] for c in by.values()]))
            return
        k = len(splits)
        splits.append((n["feature"], n["threshold"]))
        for side, left in ((n["left"], True), (n["right"], False)):
            walk(side, [*path, (k, left, nodes[side]["cover"] / n["cover"])])

    walk(0, [])
    return splits, leaves


def explain_gbt(gbt_model, scale: float = 2.0):
    """(weight, splits, leaves) of every tree of a Spark GBT classifier, and the expected value, in log-odds units (margin x 2)."""
    trees, base = [], 0.0
    for tree, w in zip(gbt_model.trees, gbt_model.treeWeights):
        splits, leaves = _leaves(_tree_nodes(tree._java_obj.rootNode()))
        trees.append((w * scale, splits, leaves))
        base += w * scale * sum(v * float(np.prod(z)) for v, _, z, _ in leaves)
    return trees, base


def _tree_values(goes_left: list[np.ndarray], leaves, n: int) -> dict[int, np.ndarray]:
    """feature -> contributions of one tree to ``n`` rows, told by the way they go at each split."""
    phi: dict[int, np.ndarray] = {}
    for value, features, z, conditions in leaves:
        m = len(features)
        if not m or value == 0.0:
            continue
        taken = []
        for own in conditions:
            o = np.ones(n, bool)
            for split, left in own:
                o &= goes_left[split] == left
            taken.append(o.astype(float))
        points, weights = np.polynomial.legendre.leggauss((m + 1) // 2)
        parts = np.zeros((m, n))
        for t, w in zip((points + 1) / 2, weights / 2):
            terms = [o * t + zk * (1 - t) for o, zk in zip(taken, z)]
            before = [np.ones(n)]
            for term in terms[:-1]:
                before.append(before[-1] * term)
            after = np.ones(n)
            for j in range(m - 1, -1, -1):
                parts[j] += w * before[j] * after
                after = after * terms[j]
        for j, f in enumerate(features):
            phi[f] = phi.get(f, 0.0) + value * (taken[j] - z[j]) * parts[j]
    return phi


def tables(trees) -> list[dict[int, np.ndarray] | None]:
    """Of each tree, its contributions for every way through its splits (bit i: left at split i); None for trees of many."""
    out = []
    for _, splits, leaves in trees:
        ways = np.arange(1 << len(splits)) if len(splits) <= TABLE_SPLITS else None
        out.append(None if ways is None else _tree_values([(ways >> i & 1).astype(bool) for i in range(len(splits))], leaves, len(ways)))
    return out


def shap_values(trees, X: np.ndarray, n_features: int, ready=None) -> np.ndarray:
    """Contributions (rows x features) of the trees' sum. ``ready``: the trees' tables, if they are at hand."""
    ready = tables(trees) if ready is None else ready
    phi = np.zeros((n_features, len(X)))
    for a in range(0, len(X), STRETCH):
        x = np.ascontiguousarray(X[a:a + STRETCH].T)
        n = x.shape[1]
        for (weight, splits, leaves), table in zip(trees, ready):
            goes_left = (x[f] <= t for f, t in splits)
            if table is None:
                found = _tree_values(list(goes_left), leaves, n)
            else:
                way = np.zeros(n, np.int64)
                for i, left in enumerate(goes_left):
                    way |= left.astype(np.int64) << i
                found = {f: values.take(way) for f, values in table.items()}
            for f, values in found.items():
                phi[f, a:a + n] += weight * values
    return phi.T


def contributions(pipeline_model, df: DataFrame, feature_names: list[str], id_col: str = "respondent_id") -> DataFrame:
    """Per-row contributions (id, variable, value) of the pipeline's final GBT stage; base value in column ``base``.

    The features are assembled by the fitted pipeline's own preprocessing, so
    the split thresholds apply to the same scaled values the model saw.
    """
    spark = df.sparkSession
    gbt = pipeline_model.stages[-1]
    trees, base = explain_gbt(gbt)
    ship_package(spark)
    bc = spark.sparkContext.broadcast(trees)
    names = list(feature_names)
    prep = pipeline_model.stages[:-1]
    x = df
    for st in prep:
        x = st.transform(x)
    x = x.select(F.col(id_col).alias("id"), vector_to_array("features").alias("x"))

    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            phi = shap_values(bc.value, np.vstack(pdf["x"].to_numpy()), len(names))
            yield pd.DataFrame({
                id_col: np.repeat(pdf["id"].to_numpy(), len(names)),
                "variable": np.tile(names, len(pdf)),
                "value": phi.reshape(-1),
                "base": base,
            })
    return x.mapInPandas(run, f"{id_col} long, variable string, value double, base double")


def _heap_nodes(tree, bins):
    """The nodes of a boosted tree in the form of _tree_nodes(); a node's cover is its sum of Hessians."""
    nodes = []

    def walk(i):
        k = len(nodes)
        nodes.append(None)
        f = int(tree.feature[i])
        inner = dict(feature=f, threshold=float(bins.cuts[f][tree.cut[i]]), left=walk(2 * i + 1), right=walk(2 * i + 2)) if f >= 0 else dict(
            feature=None, threshold=None, left=None, right=None)
        nodes[k] = inner | dict(cover=float(tree.weight[i]), value=None if f >= 0 else float(tree.value[i]))
        return k
    walk(0)
    return nodes


def booster_contributions(model, df: DataFrame, id_col: str = "respondent_id") -> DataFrame:
    """Per-row contributions (id, variable, value) of a boosted model in log-odds, and the expected margin in ``base``."""
    ship_package(df.sparkSession)
    names = model.bins.names
    trees, base = [], 0.0
    for tree in model.trees:
        splits, leaves = _leaves(_heap_nodes(tree, model.bins))
        trees.append((1.0, splits, leaves))
        base += sum(v * float(np.prod(z)) for v, _, z, _ in leaves)
    bc = df.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        ready = tables(bc.value)
        for batch in batches:
            n, d = batch.num_rows, len(names)
            if not n:
                continue
            x = np.stack([batch.column(1 + i).to_numpy(zero_copy_only=False).astype(float) for i in range(d)], axis=1)
            phi = shap_values(bc.value, x, d, ready)
            variables = pa.DictionaryArray.from_arrays(pa.array(np.tile(np.arange(d, dtype=np.int32), n)), pa.array(names)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(np.arange(n), d))), variables, pa.array(phi.ravel()), pa.array(np.full(n * d, base))],
                                             names=[id_col, "variable", "value", "base"])
    return spread_out(df.select(F.col(id_col).cast("long").alias(id_col), *names)).mapInArrow(run, f"{id_col} long, variable string, value double, base double")
