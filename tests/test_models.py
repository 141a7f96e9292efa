"""Sanity checks for the rows-only (trained) operators, SURVEY 5.3 item 4, plus exact invariants."""
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

import __spark_entry__ as E
from heartspark import schema as S
from heartspark.functions import columns as C
from heartspark.operators import models as MD
from heartspark.operators import sampling as SP
from heartspark.operators import scoring as SC
from heartspark.sources.tables import survey_base

SF = "/root/testdata/sf0.01"


def test_logistic_beats_chance(spark):
    r = E.queries()["ml_logreg"](spark, SF).first()
    assert r["roc_auc"] > 0.6 and 0 < r["pr_auc"] < 1


def test_calibration_brings_mean_to_rate(spark):
    r = E.queries()["ml_calibration_shift"](spark, SF).first()
    assert abs(r["mean_after_pct"] - r["real_rate_pct"]) < 1.0
    assert r["mean_before_pct"] > r["mean_after_pct"]  # class weights inflate raw probabilities


def test_inertia_non_increasing(spark):
    rows = sorted(E.queries()["dm_choose_k"](spark, SF).collect(), key=lambda r: r["k"])
    assert all(a["inertia"] >= b["inertia"] for a, b in zip(rows, rows[1:]))


def test_pca_variance_sums_to_100(spark):
    rows = E.queries()["dm_pca_variance"](spark, SF).collect()
    assert len(rows) == 21 and abs(max(r["cumulative_pct"] for r in rows) - 100) < 1e-6


def test_linear_contributions_add_up(spark):
    b = survey_base(spark, SF)
    means = b.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in S.SCORECARD_POINTS])
    contrib = SC.linear_contributions(b, S.SCORECARD_POINTS, means).groupBy("respondent_id").agg(F.sum("value").alias("s"))
    base_pts = sum(w * m for (c, w), m in zip(S.SCORECARD_POINTS.items(), means.first()))
    pts = b.select("respondent_id", C.scorecard_points().alias("p"))
    bad = contrib.join(pts, "respondent_id").where(F.abs(F.col("s") + F.lit(base_pts) - F.col("p")) > 1e-9).count()
    assert bad == 0


def test_model_save_load_roundtrip(spark, tmp_path):
    b = survey_base(spark, "/root/testdata/sf0.001").select("respondent_id", *S.FEATURES, S.TARGET)
    m = MD.fit(b, "tree", {"max_depth": 4, "min_samples_leaf": 20})
    m.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    a = MD.score(m, b).select("respondent_id", F.col("score").alias("a"))
    c = MD.score(loaded, b).select("respondent_id", F.col("score").alias("c"))
    assert a.join(c, "respondent_id").where("a != c").count() == 0


def test_fit_gap_is_relative_to_the_training_score():
    from heartspark.plans import ml
    rows = ml.fit_gap_rows([({"roc_auc": 0.9, "pr_auc": 0.5}, {"roc_auc": 0.8, "pr_auc": 0.4}), ({"roc_auc": 0.7, "pr_auc": 0.5}, {"roc_auc": 0.7, "pr_auc": 0.3})])
    assert [r[0] for r in rows] == ["roc_auc", "pr_auc"]
    assert rows[0][1:] == pytest.approx((0.8, 0.75, 0.05, 6.25)) and rows[1][1:] == pytest.approx((0.5, 0.35, 0.15, 30.0))


def test_weighting_wins_ties(spark):
    from heartspark.plans import ml
    same = {"roc_auc": 0.8, "pr_auc": 0.4, "precision": 0.1, "recall": 0.2, "f1": 0.3}
    assert {r.chosen for r in ml.strategy_table(spark, {"smote": [same], "weighting": [same]}).collect()} == {"weighting"}
    assert {r.chosen for r in ml.strategy_table(spark, {"smote": [same | {"roc_auc": 0.81}], "weighting": [same]}).collect()} == {"smote"}


def test_calibration_keeps_rows_and_nears_the_rate(spark):
    b = survey_base(spark, "/root/testdata/sf0.01").select("respondent_id", *S.FEATURES, S.TARGET)
    both = MD.materialize(SP.split_with_folds(b))
    folds, test = both.where("split = 'train'").drop("split"), both.where("split = 'test'").drop("split", "fold")
    out = MD.isotonic_calibrated(folds, test, "logreg", {"C": 1.0}).toPandas()
    assert len(out) == test.count() and out.respondent_id.is_unique
    assert abs(out.score_calibrated.mean() - out[S.TARGET].mean()) < 0.03 < abs(out.score_raw.mean() - out[S.TARGET].mean())
