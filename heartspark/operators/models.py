"""Supervised models as Spark ML pipelines.

Preprocessing is part of every pipeline, so it is fitted on the training rows
only and re-applied unchanged when scoring. Imbalance is handled with a class
weight column ``n / (2 n_c)`` (a broadcast two-row table). Fold and split
membership are hash-based columns (see ``sampling``); the grid loop trains on
the other folds, scores the held-out fold and measures it with the exact
distributed curve operators.
"""

from __future__ import annotations

import json
import time
from dataclasses import asdict

import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..session import ship_package
from . import boosting, isotonic
from . import curves as CV
from .isotonic import IsotonicMap

#: Bins of tree splits: more than any feature has codes (bmi has the most), so that no split point is lost.
MAX_BINS = 128
#: A bound that convergence to the tolerance comes before.
LOGREG_ITERATIONS = 1000

SCALED = S.FEATURES_CONTINUOUS + S.FEATURES_ORDINAL
PASSTHROUGH = S.FEATURES_BINARY
#: In the order of ``preprocessing_stages()``.
FEATURES = [*SCALED, *PASSTHROUGH]


def preprocessing_stages() -> list:
    """Scale continuous + ordinal columns (centred, unit variance), pass the 13 binaries through."""
    return [
        VectorAssembler(inputCols=SCALED, outputCol="_num", handleInvalid="error"),
        StandardScaler(inputCol="_num", outputCol="_num_scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=["_num_scaled", *PASSTHROUGH], outputCol="features"),
    ]


def class_counts(df: DataFrame, label: str = S.TARGET) -> dict:
    """Rows per class: one grouped count whose result has one row per class (two here)."""
    return {int(r[0]): int(r[1]) for r in df.groupBy(label).count().collect()}


def with_class_weight(df: DataFrame, label: str = S.TARGET, name: str = "weight", counts: dict | None = None) -> DataFrame:
    """Balanced weight n / (2 n_c) as a literal CASE (the class counts are two numbers)."""
    counts = counts or class_counts(df, label)
    n = sum(counts.values())
    w = None
    for c, nc in counts.items():
        v = F.lit(n / (len(counts) * nc))
        w = F.when(F.col(label) == c, v) if w is None else w.when(F.col(label) == c, v)
    return df.withColumn(name, w)


def estimator(family: str, params: dict, weighted: bool = True, sum_weights: float | None = None):
    lab, wcol = S.TARGET, ("weight" if weighted else None)
    common = dict(featuresCol="features", labelCol=lab)
    if wcol:
        common["weightCol"] = wcol
    if family == "logreg":
        c = params.get("C", 1.0)
        reg = 1.0 / (c * (sum_weights or 1.0))
        return LogisticRegression(regParam=reg, elasticNetParam=0.0, standardization=False, maxIter=LOGREG_ITERATIONS, **common)
    if family == "tree":
        return DecisionTreeClassifier(maxDepth=params.get("max_depth", 5), minInstancesPerNode=params.get("min_samples_leaf", 1),
                                      maxBins=MAX_BINS, seed=S.SEED, **common)
    if family == "forest":
        return RandomForestClassifier(numTrees=params.get("n_estimators", 200), maxDepth=params.get("max_depth", 8),
                                      minInstancesPerNode=params.get("min_samples_leaf", 1), maxBins=MAX_BINS, seed=S.SEED, **common)
    if family == "boosting":
        return GBTClassifier(maxIter=params.get("n_estimators", 300), maxDepth=params.get("max_depth", 3),
                             stepSize=params.get("learning_rate", 0.1), maxBins=MAX_BINS, seed=S.SEED, **common)
    raise ValueError(family)


def whole(df: DataFrame) -> None:
    """An error if a feature is missing somewhere, as the assembler of ``preprocessing_stages()`` raises one."""
    lacking = df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c) for c in FEATURES]).first()
    if any(lacking):
        raise ValueError("missing values in " + ", ".join(c for c in FEATURES if lacking[c]))


def fit(train: DataFrame, family: str, params: dict, weighted: bool = True, counts: dict | None = None) -> PipelineModel:
    counts = counts or class_counts(train)
    tr = with_class_weight(train, counts=counts) if weighted else train
    # Balanced weights sum to n, like the unweighted row count.
    sw = float(sum(counts.values()))
    pipe = Pipeline(stages=preprocessing_stages() + [estimator(family, params, weighted, sw)])
    return pipe.fit(tr)


def score(model: PipelineModel, df: DataFrame, name: str = "score") -> DataFrame:
    """Positive-class score: probability, or the margin for a linear SVM."""
    out = model.transform(df)
    if "probability" in out.columns:
        s = vector_to_array("probability")[1]
    else:
        s = vector_to_array("rawPrediction")[1]
    keep = [c for c in df.columns]
    return out.select(*keep, s.alias(name))


def metrics(scored: DataFrame, score_col: str = "score", label: str = S.TARGET, threshold: float = 0.5) -> DataFrame:
    """ROC-AUC, PR-AUC (average precision), precision, recall, F1 (at ``threshold``) in one row.

    The scored rows are reduced once to (score, pos, neg) -- one pass, so the
    model transform runs once -- and every metric is read from that table
    (kept in memory: one row per distinct score, recomputable from lineage).
    """
    counts = CV.score_counts(scored, score_col, label).cache()
    return CV.summary_from_counts(counts, threshold)


def evaluate(train: DataFrame, test: DataFrame, family: str, params: dict, weighted: bool = True,
             threshold: float = 0.5) -> DataFrame:
    t0 = time.time()
    m = fit(train, family, params, weighted)
    sc = score(m, test)
    out = metrics(sc, "score", S.TARGET, threshold)
    return out.withColumn("fit_seconds", F.lit(round(time.time() - t0, 3)))


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage before iterative training: a reliable checkpoint in the cluster's checkpoint folder.

    Every optimizer iteration re-reads its input; without the cut, each one
    would recompute the split/fold ranks from the source tables.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _fold_metrics(folds: DataFrame, family: str, p: dict, weighted: bool, f: int, counts: dict | None = None) -> dict:
    """Metrics of one (setting, fold) and the seconds that its fit took (others run beside it)."""
    tr, va = folds.where(F.col("fold") != f), folds.where(F.col("fold") == f)
    started = time.time()
    m = fit(tr, family, p, weighted, counts)
    seconds = time.time() - started
    sc = score(m, va)
    return metrics(sc).first().asDict() | {"fit_seconds": seconds}


def grid(folds: DataFrame, family: str, settings: list[dict], weighted: bool = True, k: int = S.N_FOLDS,
         parallelism: int = 8) -> DataFrame:
    """Cross-validated metrics of every setting: mean over k folds of the five metrics, seconds, rank by ROC-AUC.

    (setting, fold) fits are submitted concurrently from driver threads, as
    ``CrossValidator(parallelism=...)`` does; each fit is itself distributed.
    """
    from concurrent.futures import ThreadPoolExecutor
    spark = folds.sparkSession
    folds = materialize(folds)
    # Class counts of every training part from one (fold, class) count: total minus the held-out fold.
    per = {(int(r["fold"]), int(r[S.TARGET])): int(r["count"]) for r in folds.groupBy("fold", S.TARGET).count().collect()}
    labels = sorted({c for _, c in per})
    train_counts = {f: {c: sum(v for (g, cc), v in per.items() if cc == c and g != f) for c in labels} for f in range(k)}
    tasks = [(i, f) for i in range(len(settings)) for f in range(k)]
    started = time.time()
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(tasks)))) as pool:
        futs = {(i, f): pool.submit(_fold_metrics, folds, family, settings[i], weighted, f, train_counts[f])
                for i, f in tasks}
        res = {key: fu.result() for key, fu in futs.items()}
    elapsed = time.time() - started
    rows = []
    for i, p in enumerate(settings):
        per = [res[(i, f)] for f in range(k)]
        mean = {key: sum(d[key] for d in per) / k for key in per[0]}
        rows.append((i, str(p), mean["roc_auc"], mean["pr_auc"], mean["precision"], mean["recall"], mean["f1"],
                     round(mean["fit_seconds"], 3), round(elapsed, 3)))
    df = spark.createDataFrame(rows, "setting long, params string, roc_auc double, pr_auc double, precision double, "
                                     "recall double, f1 double, fit_seconds double, family_seconds double")
    from pyspark.sql import Window
    return df.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("roc_auc"), "setting")))


class CalibratedModel:
    """k models, each with an exact isotonic map fitted on the rows that it hasn't seen; scores are averages over the k.

    Boosted models of all folds are fitted together (``boosting``), those of other families one by one as Spark ML pipelines.
    ``metadata`` (JSON values: family, parameters, features, threshold, ...) is saved with the model.
    """

    def __init__(self, models: list, maps: list[IsotonicMap], metadata: dict):
        self.models, self.maps, self.metadata = models, maps, metadata

    @staticmethod
    def fit(folds: DataFrame, family: str, params: dict, k: int = S.N_FOLDS, parallelism: int = S.N_FOLDS) -> CalibratedModel:
        if family == "boosting":
            fitted = boosting.fit_all(folds, S.FEATURES, [boosting_setting(params)], list(range(k)))
            models, maps = fitted.boosters(), isotonic.fit_groups(fitted.counts())
            fitted.release()
        else:
            from concurrent.futures import ThreadPoolExecutor
            folds = materialize(folds)
            with ThreadPoolExecutor(max_workers=parallelism) as pool:
                models = list(pool.map(lambda f: fit(folds.where(F.col("fold") != f), family, params), range(k)))
            counts = None
            for f, m in enumerate(models):
                own = CV.score_counts(score(m, folds.where(F.col("fold") == f)), "score", S.TARGET).withColumn("grp", F.lit(f))
                counts = own if counts is None else counts.unionByName(own)
            maps = isotonic.fit_groups(counts)
        return CalibratedModel(models, [maps.get(f, IsotonicMap([], [])) for f in range(k)], {"family": family, "params": params, "features": S.FEATURES, "folds": k})

    def score(self, df: DataFrame, raw: str = "score_raw", calibrated: str = "score_calibrated") -> DataFrame:
        """``df`` with the mean raw and mean calibrated score; the transforms are chained on one frame, without a join."""
        names = [f"_raw{f}" for f in range(len(self.models))]
        if self.metadata["family"] == "boosting":
            out = boosting.scores(df, self.models, names)
        else:
            out = df
            for m, name in zip(self.models, names):
                out = score(m, out, name)
        maps, n = self.maps, len(df.columns)

        def run(batches):
            for batch in batches:
                raws = [batch.column(n + f).to_numpy(zero_copy_only=False) for f in range(len(maps))]
                means = [sum(x) / len(maps) for x in (raws, [m.apply(x) for m, x in zip(maps, raws)])]
                yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(n)], *[pa.array(x) for x in means]], names=columns)

        columns = [*df.columns, raw, calibrated]
        schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + [f"`{c}` double" for c in (raw, calibrated)])
        ship_package(df.sparkSession)
        return out.select(*[F.col(f"`{c}`") for c in df.columns], *names).mapInArrow(run, schema)

    def save(self, spark, path: str) -> None:
        texts = [("metadata", json.dumps(self.metadata)), *[(f"isotonic-{f}", json.dumps(asdict(m))) for f, m in enumerate(self.maps)]]
        for f, m in enumerate(self.models):
            if isinstance(m, boosting.Booster):
                texts.append((f"model-{f}", m.to_json()))
            else:
                m.write().overwrite().save(f"{path}/pipeline-{f}")
        spark.createDataFrame(texts, "name string, value string").coalesce(1).write.mode("overwrite").json(f"{path}/documents")

    @staticmethod
    def load(spark, path: str) -> CalibratedModel:
        texts = {r["name"]: r["value"] for r in spark.read.schema("name string, value string").json(f"{path}/documents").collect()}
        metadata = json.loads(texts["metadata"])
        models = [boosting.Booster.from_json(texts[f"model-{f}"]) if f"model-{f}" in texts else PipelineModel.load(f"{path}/pipeline-{f}")
                  for f in range(metadata["folds"])]
        return CalibratedModel(models, [IsotonicMap(**json.loads(texts[f"isotonic-{f}"])) for f in range(metadata["folds"])], metadata)


def boosting_setting(params: dict) -> boosting.Setting:
    return boosting.Setting(params["max_depth"], params["learning_rate"], float(params.get("reg_lambda", 1)), params.get("n_estimators", 300))


def boosted(train: DataFrame, params: dict) -> boosting.Booster:
    """One boosted model of all rows."""
    fitted = boosting.fit_all(train.withColumn("fold", F.lit(0)), S.FEATURES, [boosting_setting(params)], [-1])
    model = fitted.boosters()[0]
    fitted.release()
    return model


def isotonic_calibrated(folds: DataFrame, test: DataFrame, family: str, params: dict, k: int = S.N_FOLDS) -> DataFrame:
    """k (model, isotonic map) pairs, each calibrated on its held-out fold; the test score is their average."""
    out = CalibratedModel.fit(folds, family, params, k).score(test)
    return out.select("respondent_id", S.TARGET, "score_raw", "score_calibrated")
