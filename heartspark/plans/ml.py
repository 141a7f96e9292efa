"""Model training queries: stochastic / iterative, so rows-only checks,
except the fitted scaler statistics, which have an exact SQL oracle."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import binned as BN
from ..operators import boosting as BO
from ..operators import curves as CV
from ..operators import forest as FO
from ..operators import logistic as LG
from ..operators import models as MD
from ..operators import neighbours as NB
from ..operators import sampling as SP
from ..operators import scoring as SC
from ..operators import svm as SV
from ..sources.tables import survey_base
from .common import Registry
from .sqlbase import ctes

R = Registry()
q = R.add

# Best settings published for each family, and the logistic grid.
BEST = {
    "logreg": {"C": 10},
    "tree": {"max_depth": 10, "min_samples_leaf": 100},
    "forest": {"n_estimators": 200, "max_depth": 12, "min_samples_leaf": 20},
    "boosting": {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 3},
    "svm": {"C": 1.0},
}
# The family that the grids keep, which diagnostics and the saved model use.
KEPT = "boosting"
LOGREG_GRID = [{"C": c} for c in (0.001, 0.01, 0.1, 1, 10)]
TREE_GRID = [{"max_depth": d, "min_samples_leaf": m} for d in (3, 5, 7, 10) for m in (20, 100)]
KNN_GRID = [{"n_neighbors": k, "weights": w} for k in (15, 25, 50) for w in ("uniform", "distance")]
FOREST_GRID = [{"max_depth": d, "min_samples_leaf": m} for d in (8, 12, 16) for m in (5, 20)]
FOREST_TREES = 200
BOOSTING_GRID = [{"max_depth": d, "learning_rate": r, "reg_lambda": p} for d in (3, 5, 7) for r in (0.05, 0.1) for p in (1, 5)]
BOOSTING_ROUNDS = 300
SVM_GRID = [{"C": c} for c in (0.01, 0.1, 1)]


def _prepared(spark, sf):
    """Features with split and fold columns, materialised once (lineage cut): every model reads them many times."""
    b = survey_base(spark, sf).select("respondent_id", *S.FEATURES, S.TARGET)
    return MD.materialize(SP.split_with_folds(b))


def _split(spark, sf, prepared=None):
    s = _prepared(spark, sf) if prepared is None else prepared
    return s.where("split = 'train'").drop("split", "fold"), s.where("split = 'test'").drop("split", "fold")


def _folds(spark, sf, prepared=None):
    s = _prepared(spark, sf) if prepared is None else prepared
    return s.where("split = 'train'").drop("split")


_FITTED: dict = {}


def once(spark, sf, name, make):
    """A fitted model of this session and input: made by the first query that asks, used by those after it as long as the input's files stay the same."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    newest = orders.select(F.max(F.col("_metadata.file_modification_time")).alias("t")).first()["t"]
    key = spark.sparkContext.applicationId, sf, tuple(sorted(orders.inputFiles())), newest, name
    if key not in _FITTED:
        _FITTED[key] = make()
    return _FITTED[key]


def calibrated_model(spark, sf, prepared=None):
    """The kept family's calibrated model of the training part; ``prepared``: the rows of ``_prepared``, where the caller has them."""
    return once(spark, sf, "calibrated", lambda: MD.CalibratedModel.fit(_folds(spark, sf, prepared), KEPT, BEST[KEPT]))


def boosted_model(spark, sf, prepared=None):
    """The kept family's best setting fitted on the training part."""
    return once(spark, sf, "boosted", lambda: MD.boosted(_split(spark, sf, prepared)[0], BEST["boosting"]))


@q("ml_preprocess", ctes(f"sp AS ({SP.split_sql()})") + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(AVG(CAST({c} AS DOUBLE)), 9) AS mean, ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 9) AS std "
    f"FROM sp WHERE split = 'train'" for c in MD.SCALED))
def ml_preprocess(spark, sf):
    """Scaler statistics fitted on the training part only (mean, std with ddof=1 as Spark ML computes it)."""
    from pyspark.ml import Pipeline
    train, _ = _split(spark, sf)
    model = Pipeline(stages=MD.preprocessing_stages()).fit(train)
    scaler = model.stages[1]
    rows = [(c, round(float(m), 9), round(float(s), 9)) for c, m, s in zip(MD.SCALED, scaler.mean.toArray(), scaler.std.toArray())]
    return spark.createDataFrame(rows, "feature string, mean double, std double")


def _family(name, family):
    def run(spark, sf, _f=family):
        train, test = _split(spark, sf)
        return MD.evaluate(train, test, _f, BEST[_f]).withColumn("model", F.lit(_f))
    run.__doc__ = f"Fit the {family} pipeline (published best setting, class weights) on train; metrics on test."
    q(name)(run)


_family("ml_logreg", "logreg")
_family("ml_tree", "tree")


@q("ml_forest")
def ml_forest(spark, sf):
    """The forest family's published best setting (class weights), all trees grown together on train; metrics on test."""
    both = _prepared(spark, sf).withColumn("fold", F.when(F.col("split") == "test", 1).otherwise(0)).drop("split")
    MD.whole(both)
    started, p = time.time(), BEST["forest"]
    depth, leaf = p["max_depth"], p["min_samples_leaf"]
    fit = FO.fit_all(both, MD.FEATURES, p["n_estimators"], depth, [leaf], [1], bins=BN.learn_bins(both.where("fold = 0"), MD.FEATURES))
    out = CV.summary_by_group(fit.held_out_counts([depth], [leaf], [1])).drop("grp")
    return out.withColumns({"fit_seconds": F.lit(round(time.time() - started, 3)), "model": F.lit("forest")})


@q("ml_boosting")
def ml_boosting(spark, sf):
    """The boosting family's published best setting (leaf penalty 1), fitted on train; metrics on test."""
    prepared = _prepared(spark, sf)
    _, test = _split(spark, sf, prepared)
    started = time.time()
    model = boosted_model(spark, sf, prepared)
    out = MD.metrics(BO.scores(test, [model], ["score"]))
    return out.withColumns({"fit_seconds": F.lit(round(time.time() - started, 3)), "model": F.lit("boosting")})




@q("ml_svm")
def ml_svm(spark, sf):
    """The SVM family's published best setting fitted on train (three inner folds, sigmoids); metrics on test."""
    both = _prepared(spark, sf)
    started = time.time()
    rows = MD.materialize(SV.as_rows(both.where("split = 'train'"))).cache()
    models, _ = SV.fit_all(rows, [BEST["svm"]["C"]], [-1])
    models = SV.calibrated(rows, models)
    rows.unpersist()
    test = SV.as_rows(both.where("split = 'test'").withColumn("fold", F.lit(0)))
    out = CV.summary_by_group(SV.grouped_counts(test, models, [0] * len(models), None)).drop("grp")
    return out.withColumns({"fit_seconds": F.lit(round(time.time() - started, 3)), "model": F.lit("svm")})



def _grid_frame(spark, settings, metrics, k, seconds):
    """One row per setting: means over the folds, the family's total seconds, rank by ROC-AUC."""
    rows = []
    for i, p in enumerate(settings):
        own = [metrics[i * k + f] for f in range(k)]
        rows.append((i, str(p), *[sum(m[c] for m in own) / k for c in ("roc_auc", "pr_auc", "precision", "recall", "f1")], round(seconds, 3)))
    rows.sort(key=lambda r: (-r[2], r[0]))
    return spark.createDataFrame([(*r, n + 1) for n, r in enumerate(rows)],
                                 "setting long, params string, roc_auc double, pr_auc double, precision double, recall double, f1 double, "
                                 "family_seconds double, rank long")


def _logistic_grid(spark, sf):
    started = time.time()
    rows = MD.materialize(LG.as_profiles(_folds(spark, sf))).cache()
    models = LG.fit_all(rows, [s["C"] for s in LOGREG_GRID], list(range(S.N_FOLDS)))
    got = {r["grp"]: r for r in CV.summary_by_group(LG.held_out_counts(rows, models)).collect()}
    rows.unpersist()
    return _grid_frame(spark, LOGREG_GRID, got, S.N_FOLDS, time.time() - started), models


@q("ml_grid")
def ml_grid(spark, sf):
    """Cross-validated grid of the logistic family: 5 metrics per setting, the family's seconds, ranked by ROC-AUC.
    All 25 models are fitted and scored together."""
    return _logistic_grid(spark, sf)[0]


@q("ml_grid_refit")
def ml_grid_refit(spark, sf):
    """The winner of the logistic grid refitted on the whole training part; metrics on the test part, passes, convergence."""
    grid, _ = _logistic_grid(spark, sf)
    best = LOGREG_GRID[grid.orderBy("rank").first()["setting"]]
    both = _prepared(spark, sf)
    model = LG.fit_all(LG.as_rows(both.where("split = 'train'")), [best["C"]], [-1])[0, -1]
    test = LG.as_rows(both.where("split = 'test'").withColumn("fold", F.lit(0)))
    got = CV.summary_by_group(LG.held_out_counts(test, {(0, 0): model})).drop("grp")
    return got.select(F.lit(str(best)).alias("params"), "*", F.lit(model.passes).cast("long").alias("passes"), F.lit(int(model.converged)).cast("long").alias("converged"))


@q("ml_grid_tree")
def ml_grid_tree(spark, sf):
    """Cross-validated grid of the decision-tree family (depth 3/5/7/10 x leaf 20/100): trees are grown once to depth 10, in the same passes for
    all folds and leaves, and read at each depth (siblings of the same class merged)."""
    folds = _folds(spark, sf)
    MD.whole(folds)
    started = time.time()
    depths, leaves = ([*dict.fromkeys(p[name] for p in TREE_GRID)] for name in ("max_depth", "min_samples_leaf"))
    held = list(range(S.N_FOLDS))
    fit = FO.fit_all(folds, MD.FEATURES, 0, max(depths), leaves, held)
    seconds = F.lit(round(time.time() - started, 3))
    got = {r["grp"]: r for r in CV.summary_by_group(fit.held_out_counts(depths, leaves, held, prune=True)).collect()}
    grid = _grid_frame(spark, TREE_GRID, got, S.N_FOLDS, time.time() - started)
    return grid.withColumn("fit_seconds", seconds).select(*[c for c in grid.columns if c not in ("family_seconds", "rank")], "fit_seconds", "family_seconds", "rank")


@q("ml_grid_boosting")
def ml_grid_boosting(spark, sf):
    """Cross-validated grid of the boosting family (depth 3/5/7 x rate .05/.1 x leaf penalty 1/5, 300 rounds): all 60 models grow together."""
    folds = _folds(spark, sf)
    started = time.time()
    fit = BO.fit_all(folds, LG.FEATURES, [MD.boosting_setting(p | {"n_estimators": BOOSTING_ROUNDS}) for p in BOOSTING_GRID], list(range(S.N_FOLDS)))
    got = {r["grp"]: r for r in CV.summary_by_group(fit.counts()).collect()}
    fit.release()
    return _grid_frame(spark, BOOSTING_GRID, got, S.N_FOLDS, time.time() - started)


@q("ml_grid_forest")
def ml_grid_forest(spark, sf):
    """Cross-validated grid of the forest family (depth 8/12/16 x leaf 5/20, 200 trees): trees are grown once to depth 16 and read at each depth."""
    folds = _folds(spark, sf)
    started = time.time()
    depths, leaves = ([*dict.fromkeys(p[name] for p in FOREST_GRID)] for name in ("max_depth", "min_samples_leaf"))
    held = list(range(S.N_FOLDS))
    fit = FO.fit_all(folds, LG.FEATURES, FOREST_TREES, max(depths), leaves, held)
    got = {r["grp"]: r for r in CV.summary_by_group(fit.held_out_counts(depths, leaves, held)).collect()}
    return _grid_frame(spark, FOREST_GRID, got, S.N_FOLDS, time.time() - started)


@q("ml_grid_svm")
def ml_grid_svm(spark, sf):
    """Cross-validated grid of the linear SVM (squared hinge, C .01/.1/1), sigmoids of three inner folds: all 45 models are fitted in the same passes."""
    folds = _folds(spark, sf)
    started = time.time()
    got = {r["grp"]: r for r in CV.summary_by_group(SV.grid_counts(folds, [s["C"] for s in SVM_GRID], list(range(S.N_FOLDS)))).collect()}
    return _grid_frame(spark, SVM_GRID, got, S.N_FOLDS, time.time() - started)


def _knn_counts(scored, settings, grp):
    """(grp, score, pos, neg) of scored rows, one group per setting."""
    each = F.array(*[F.struct(F.lit(grp(i)).alias("grp"), F.col(f"s{i}").alias("score")) for i in range(len(settings))])
    rows = scored.select(S.TARGET, F.explode(each).alias("e"))
    return rows.groupBy(F.col("e.grp").alias("grp"), F.col("e.score").alias("score")).agg(
        F.sum(F.col(S.TARGET).cast("long")).alias("pos"), F.sum((1 - F.col(S.TARGET)).cast("long")).alias("neg"))


@q("ml_knn")
def ml_knn(spark, sf):
    """The six kNN settings fitted on the whole training part (rows_used says how many rows); metrics on test."""
    train, test = _split(spark, sf)
    scored, used = NB.knn_scores(NB.preprocessing(train), train, test, KNN_GRID, ["respondent_id", S.TARGET])
    got = {r["grp"]: r for r in CV.summary_by_group(_knn_counts(scored, KNN_GRID, lambda i: i)).collect()}
    rows = [(p["n_neighbors"], p["weights"], *[got[i][c] for c in ("roc_auc", "pr_auc", "precision", "recall", "f1")], used) for i, p in enumerate(KNN_GRID)]
    return spark.createDataFrame(rows, "n_neighbors long, weights string, roc_auc double, pr_auc double, precision double, recall double, f1 double, rows_used long")


@q("ml_grid_knn")
def ml_grid_knn(spark, sf):
    """Cross-validated grid of kNN (k 15/25/50, uniform or distance votes) on all rows of the training folds."""
    folds = _folds(spark, sf)
    started, counts = time.time(), None
    for f in range(S.N_FOLDS):
        train, held = folds.where(F.col("fold") != f), folds.where(F.col("fold") == f)
        scored, _ = NB.knn_scores(NB.preprocessing(train), train, held, KNN_GRID, ["respondent_id", S.TARGET])
        own = _knn_counts(scored, KNN_GRID, lambda i, f=f: i * S.N_FOLDS + f)
        counts = own if counts is None else counts.unionByName(own)
    got = {r["grp"]: r for r in CV.summary_by_group(counts).collect()}
    return _grid_frame(spark, KNN_GRID, got, S.N_FOLDS, time.time() - started)


@q("ml_smote", ctes(f"sp AS ({SP.split_sql()}), n AS (SELECT heart_disease, COUNT(*) AS n FROM sp WHERE split = 'train' GROUP BY 1)")
   + "SELECT heart_disease, CAST(n AS BIGINT) AS rows_before, (SELECT CAST(MAX(n) AS BIGINT) FROM n) AS rows_after, "
   "(SELECT CAST(MAX(n) AS BIGINT) FROM n) - CAST(n AS BIGINT) AS rows_made FROM n")
def ml_smote(spark, sf):
    """SMOTE on the training part: rows of each class before and after, and the synthetic rows made."""
    train, _ = _split(spark, sf)
    made, info = NB.smote(spark, NB.preprocessing(train), train)
    n = made.groupBy(S.TARGET).agg(F.count(F.lit(1)).alias("rows_made"))
    sizes = spark.createDataFrame([(c, info["before"][c], info["after"][c]) for c in sorted(info["before"])], f"{S.TARGET} int, rows_before long, rows_after long")
    return sizes.join(F.broadcast(n), S.TARGET, "left").withColumn("rows_made", F.coalesce("rows_made", F.lit(0)))


def strategy_table(spark, metrics):
    """(strategy, means over the folds, chosen): the strategy with the highest mean ROC-AUC; weighting wins ties."""
    rows = [(s, *[sum(m[c] for m in own) / len(own) for c in ("roc_auc", "pr_auc", "precision", "recall", "f1")]) for s, own in metrics.items()]
    best = max(rows, key=lambda r: (r[1], r[0] == "weighting"))[0]
    return spark.createDataFrame([(*r, best) for r in rows], "strategy string, roc_auc double, pr_auc double, precision double, recall double, f1 double, chosen string")


@q("ml_pick_strategy")
def ml_pick_strategy(spark, sf):
    """Class weighting against SMOTE inside each fold, on the kept family's best setting; weighting wins ties.

    Fold f's model sees its own training folds, and for SMOTE the synthetic rows made from them alone, without class weights.
    """
    folds = _folds(spark, sf)
    setting, held = MD.boosting_setting(BEST[KEPT]), list(range(S.N_FOLDS))
    bins = BN.learn_bins(folds, LG.FEATURES)
    columns = ["respondent_id", *S.FEATURES, S.TARGET, "fold"]
    both = folds.select(*[F.col(c).cast("double").alias(c) if c in S.FEATURES else F.col(c) for c in columns])
    for f in held:
        train = folds.where(F.col("fold") != f)
        prep = NB.preprocessing(train)
        made, _ = NB.smote(spark, prep, train)
        own = NB.raw_columns(prep, made).withColumns({"respondent_id": -1 - F.col("j"), "fold": F.lit(BO.MADE + f)})
        both = both.unionByName(own.select(*columns))
    out = {}
    for name, rows, positive in (("weighting", folds, None), ("smote", MD.materialize(both), 1.0)):
        fit = BO.fit_all(rows, LG.FEATURES, [setting], held, positive=positive, bins=bins)
        out[name] = [r.asDict() for r in CV.summary_by_group(fit.counts()).collect()]
        fit.release()
    return strategy_table(spark, out)


def boosted_pairs(folds, settings, shares=None):
    """(setting, share) places -> of every fold, metrics on the rows that its model learnt from and on the held-out ones; all models grow together."""
    held, shares = list(range(S.N_FOLDS)), shares or [1.0]
    fit = BO.fit_all(folds, LG.FEATURES, settings, held, shares=shares)
    got = {r["grp"]: r.asDict() for r in CV.summary_by_group(fit.counts(training=True)).collect()}
    fit.release()
    place = lambda i, j, f: ((i * len(shares) + j) * len(held) + f) * 2
    return {(i, j): [(got[place(i, j, f) + 1], got[place(i, j, f)]) for f in held] for i in range(len(settings)) for j in range(len(shares))}


def fit_gap_rows(scores):
    """(metric, training mean, validation mean, gap, gap in percent of the training score) from pairs of metrics per fold."""
    out = []
    for c in ("roc_auc", "pr_auc"):
        a, b = (sum(pair[k][c] for pair in scores) / len(scores) for k in (0, 1))
        out.append((c, a, b, a - b, (a - b) / a * 100))
    return out


@q("ml_fit_gap")
def ml_fit_gap(spark, sf):
    """Training against validation ROC-AUC and PR-AUC of the kept family, means over all five folds,
    with the gap and the gap relative to the training score (%)."""
    scores = boosted_pairs(_folds(spark, sf), [MD.boosting_setting(BEST[KEPT])])[0, 0]
    return spark.createDataFrame(fit_gap_rows(scores), "metric string, train_mean double, val_mean double, gap double, gap_pct double")


def curve_rows(pairs, places):
    """(place, training mean, std, validation mean, std) of ROC-AUC over the folds."""
    rows = []
    for place, own in zip(places, pairs):
        row = [place]
        for k in (0, 1):
            aucs = [pair[k]["roc_auc"] for pair in own]
            mean = sum(aucs) / len(aucs)
            row += [mean, (sum((a - mean) ** 2 for a in aucs) / len(aucs)) ** 0.5]
        rows.append(tuple(row))
    return rows


@q("ml_learning_curve")
def ml_learning_curve(spark, sf):
    """Training and validation ROC-AUC of the kept family at 10..100 % of the training folds, mean and std over folds.
    A smaller share's rows (first by hash) are part of a greater one's; all 30 models grow together."""
    shares = [0.1, 0.28, 0.46, 0.64, 0.82, 1.0]
    pairs = boosted_pairs(_folds(spark, sf), [MD.boosting_setting(BEST[KEPT])], shares)
    return spark.createDataFrame(curve_rows([pairs[0, j] for j in range(len(shares))], shares),
                                 "fraction double, train_roc_auc_mean double, train_roc_auc_std double, val_roc_auc_mean double, val_roc_auc_std double")


@q("ml_validation_curve")
def ml_validation_curve(spark, sf):
    """Training and validation ROC-AUC of the kept family by tree depth 1, 2, 3, 4, 6, 8, 10, means over all five folds; the best depth
    is flagged. All 35 models grow together, each with the kept family's rounds."""
    depths = [1, 2, 3, 4, 6, 8, 10]
    pairs = boosted_pairs(_folds(spark, sf), [MD.boosting_setting(BEST[KEPT] | {"max_depth": d}) for d in depths])
    rows = curve_rows([pairs[i, 0] for i in range(len(depths))], depths)
    best = max(rows, key=lambda r: (r[3], -r[0]))[0]
    return spark.createDataFrame([(d, a, v, d == best) for d, a, _, v, _ in rows], "depth long, train_roc_auc double, val_roc_auc double, best boolean")


@q("ml_calibrate")
def ml_calibrate(spark, sf):
    """Isotonic calibration of the kept family, 5 folds averaged: test rows with raw and calibrated scores."""
    prepared = _prepared(spark, sf)
    _, test = _split(spark, sf, prepared)
    return calibrated_model(spark, sf, prepared).score(test).select("respondent_id", S.TARGET, "score_raw", "score_calibrated")


def shift_of(scored):
    """ROC-AUC, PR-AUC and mean probability before and after calibration, and the real rate, of rows with both scores."""
    before = MD.metrics(scored, "score_raw").select(F.col("roc_auc").alias("roc_auc_before"), F.col("pr_auc").alias("pr_auc_before"))
    after = MD.metrics(scored, "score_calibrated").select(F.col("roc_auc").alias("roc_auc_after"), F.col("pr_auc").alias("pr_auc_after"))
    means = scored.agg((F.avg("score_raw") * 100).alias("mean_before_pct"), (F.avg("score_calibrated") * 100).alias("mean_after_pct"),
                       (F.avg(S.TARGET) * 100).alias("real_rate_pct"))
    return before.crossJoin(after).crossJoin(means)


@q("ml_calibration_shift")
def ml_calibration_shift(spark, sf):
    """What calibration does to the kept family's test scores."""
    prepared = _prepared(spark, sf)
    _, test = _split(spark, sf, prepared)
    return shift_of(MD.materialize(calibrated_model(spark, sf, prepared).score(test).select("respondent_id", S.TARGET, "score_raw", "score_calibrated")))


def _auc_sql(score):
    n = f"(SELECT {score} AS s, CAST(SUM(heart_disease) AS DOUBLE) AS p, CAST(SUM(1 - heart_disease) AS DOUBLE) AS n FROM given GROUP BY 1)"
    c = f"(SELECT s, p, n, SUM(p) OVER (ORDER BY s DESC) AS tp, SUM(n) OVER (ORDER BY s DESC) AS fp, SUM(p) OVER () AS pp, SUM(n) OVER () AS nn FROM {n} x)"
    return f"(SELECT ROUND(SUM(n * (tp - p * 0.5)) / (MAX(pp) * MAX(nn)), 9) FROM {c} y)", f"(SELECT ROUND(SUM(p / pp * (tp / (tp + fp))), 9) FROM {c} y)"


_RAW, _CAL = _auc_sql("score_raw"), _auc_sql("score_calibrated")


@q("ml_calibration_shift_given", ctes("given AS (SELECT heart_disease, CAST(risk_factor_count AS DOUBLE) / 8 AS score_raw, "
   "CAST(FLOOR(risk_factor_count / 2) AS DOUBLE) / 10 AS score_calibrated FROM base)") + f"SELECT {_RAW[0]} AS roc_auc_before, {_RAW[1]} AS pr_auc_before, "
   f"{_CAL[0]} AS roc_auc_after, {_CAL[1]} AS pr_auc_after, ROUND(AVG(score_raw) * 100, 9) AS mean_before_pct, ROUND(AVG(score_calibrated) * 100, 9) AS mean_after_pct, "
   "AVG(heart_disease) * 100 AS real_rate_pct FROM given")
def ml_calibration_shift_given(spark, sf):
    """The same figures on given scores (risk factors, and the same in steps)."""
    r = F.col("risk_factor_count")
    given = survey_base(spark, sf).select(S.TARGET, (r.cast("double") / 8).alias("score_raw"), (F.floor(r / 2).cast("double") / 10).alias("score_calibrated"))
    return shift_of(given).withColumns({c: F.round(c, 9) for c in ("mean_before_pct", "mean_after_pct")})


@q("sc_scenarios_model")
def sc_scenarios_model(spark, sf):
    """The what-if scenarios rescored by a fitted tree, whose splits use all the features that scenarios change."""
    train, _ = _split(spark, sf)
    m = MD.fit(train, "tree", BEST["tree"])
    rows = MD.score(m, survey_base(spark, sf).select("respondent_id", *S.FEATURES), "risk")
    return SC.scenarios(rows, SC.model_variant(m), "risk")


@q("sc_position_model")
def sc_position_model(spark, sf):
    """Peer positions on a fitted model's score."""
    train, _ = _split(spark, sf)
    m = MD.fit(train, "logreg", BEST["logreg"])
    return SC.peer_position(MD.score(m, survey_base(spark, sf).select("respondent_id", *S.FEATURES), "risk"), "risk")


@q("sc_score_model")
def sc_score_model(spark, sf):
    """Score every row with the fitted boosting model (positive-class probability)."""
    m = boosted_model(spark, sf)
    return BO.scores(survey_base(spark, sf).select("respondent_id", *S.FEATURES), [m], ["risk"]).select("respondent_id", "risk")


def _tree_contrib(spark, sf):
    from ..operators import treeshap as TS
    m = boosted_model(spark, sf)
    return TS.booster_contributions(m, survey_base(spark, sf).select("respondent_id", *S.FEATURES))


@q("ml_contrib_tree")
def ml_contrib_tree(spark, sf):
    """Exact path-dependent SHAP contributions (log-odds) of the boosting model for every row, long format."""
    return _tree_contrib(spark, sf)


@q("ml_importance_tree")
def ml_importance_tree(spark, sf):
    """Mean absolute SHAP contribution per variable of the boosting model, ranked (the published SHAP ranking)."""
    from pyspark.sql import Window
    g = _tree_contrib(spark, sf).groupBy("variable").agg(F.avg(F.abs("value")).alias("mean_abs"))
    return g.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mean_abs"), "variable")))
