"""Unsupervised mining on the 21 standardised features: PCA, k-means, profiles of clusters.

PCA is Spark ML (a distributed Gram matrix); k-means, its silhouettes and the Ward linkage work on
every row by way of its distinct points (``lloyd``, ``ward``).
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from . import lloyd
from .lloyd import Points


def scaler_pipeline(cols: list[str] = S.FEATURES, center: bool = True) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="_raw"),
                            StandardScaler(inputCol="_raw", outputCol="features", withMean=center, withStd=True)])


def scaled(df: DataFrame, cols: list[str] = S.FEATURES, center: bool = True) -> tuple[DataFrame, PipelineModel]:
    m = scaler_pipeline(cols, center).fit(df)
    return m.transform(df).drop("_raw"), m


def pca_model(x: DataFrame, k: int = len(S.FEATURES)):
    return PCA(k=k, inputCol="features", outputCol="pcs").fit(x)


def variance_table(model, spark) -> DataFrame:
    ev = [float(v) for v in model.explainedVariance.toArray()]
    rows, cum = [], 0.0
    for i, v in enumerate(ev):
        cum += v
        rows.append((i + 1, v * 100, cum * 100))
    df = spark.createDataFrame(rows, "component long, explained_pct double, cumulative_pct double")
    first80 = min((r[0] for r in rows if r[2] >= 80 - 1e-9), default=None)
    return df.withColumn("components_to_80", F.lit(first80).cast("long"))


def loadings(model, spark, cols: list[str] = S.FEATURES, n_comp: int = 2) -> DataFrame:
    """Component weights x sqrt(eigenvalue): the correlation of each variable with PC1..n (standardised data)."""
    pc = model.pc.toArray()
    ev = model.explainedVariance.toArray() * len(cols)  # eigenvalues of the correlation matrix
    rows = [(c, *[float(pc[j, k] * math.sqrt(ev[k])) for k in range(n_comp)]) for j, c in enumerate(cols)]
    return spark.createDataFrame(rows, "variable string, " + ", ".join(f"pc{k + 1} double" for k in range(n_comp)))


def kmeans_best(points: Points, k: int = 4, seeds=range(10)) -> lloyd.Run:
    """Of several seeds the run with the lowest within-cluster cost, then the first; all advance in the same passes."""
    runs, _ = lloyd.fit_all(points, [(k, s) for s in seeds])
    return min(runs, key=lambda r: r.cost)


def choose_k(points: Points, ks=range(2, 9), seeds=range(10)) -> list[tuple[int, float, float]]:
    """(k, cost, silhouette) of the best of ``len(seeds)`` runs for each k; all runs of all k advance in the same passes."""
    runs, _ = lloyd.fit_all(points, [(k, s) for k in ks for s in seeds])
    best = [min((r for r in runs if r.k == k), key=lambda r: r.cost) for k in ks]
    return [(r.k, r.cost, s) for r, s in zip(best, lloyd.silhouettes(points, [r.centres for r in best]))]


def profile_summary(labelled: DataFrame, cluster: str = "cluster", target: str = S.TARGET) -> DataFrame:
    """Size, share and target rate per cluster; profiles ranked 1.. by ascending target rate."""
    g = labelled.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), (F.avg(target) * 100).alias("target_pct"))
    tot = g.agg(F.sum("n").alias("_t"))
    w = Window.orderBy("target_pct", cluster)
    return g.crossJoin(F.broadcast(tot)).select(
        cluster, F.row_number().over(w).alias("profile"), "n", (F.col("n") / F.col("_t") * 100).alias("share_pct"), "target_pct")


def profile_means(labelled: DataFrame, cols: list[str], cluster: str = "profile") -> DataFrame:
    return labelled.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in cols])


def profile_signature(labelled: DataFrame, cols: list[str], cluster: str = "profile") -> DataFrame:
    """(profile mean - overall mean) / overall std per feature, long format."""
    glob = labelled.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols])
    means = profile_means(labelled, cols, cluster).crossJoin(F.broadcast(glob))
    stack = ", ".join(f"'{c}', (`{c}` - m_{c}) / s_{c}" for c in cols)
    return means.selectExpr(cluster, f"stack({len(cols)}, {stack}) AS (variable, signature)")


def pcs_columns(model, x: DataFrame, n: int = 2) -> DataFrame:
    t = model.transform(x)
    arr = vector_to_array("pcs")
    return t.select(*[c for c in x.columns if c != "features"], *[arr[i].alias(f"pc{i + 1}") for i in range(n)])
