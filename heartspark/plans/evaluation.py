"""Deterministic model-evaluation queries: split, folds, samples, curves, metrics.

Curves and metrics run on the scorecard risk, a deterministic score with the
same shape as a model probability, so they have an exact SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..operators import curves as CV
from ..operators import ordering
from ..operators import sampling as SP
from ..operators.duplicates import arith_hash_sql
from ..sources.tables import survey_base
from .common import Registry
from .sqlbase import ctes

R = Registry()
q = R.add
RISK_SQL = C.scorecard_risk_sql()


def _scored(spark, sf):
    return survey_base(spark, sf).select("respondent_id", *S.FEATURES, S.TARGET).withColumn("risk", C.scorecard_risk())


_SCORED_CTE = f"sc AS (SELECT respondent_id, heart_disease, {RISK_SQL} AS risk FROM base)"


@q("ml_split", ctes(f"sp AS ({SP.split_sql()})") + "SELECT respondent_id, heart_disease, split FROM sp")
def ml_split(spark, sf):
    """Stratified 80/20 split, seed 42: per class the first ceil(20 %) rows in hash order are test."""
    return SP.stratified_split(survey_base(spark, sf).select("respondent_id", S.TARGET))


@q("ml_split_summary", ctes(f"sp AS ({SP.split_sql()})") +
   "SELECT split, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(heart_disease) AS BIGINT) AS positives, "
   "AVG(heart_disease) * 100 AS prevalence_pct FROM sp GROUP BY split")
def ml_split_summary(spark, sf):
    s = SP.stratified_split(survey_base(spark, sf).select("respondent_id", S.TARGET))
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum(S.TARGET).alias("positives"),
                                  (F.avg(S.TARGET) * 100).alias("prevalence_pct"))


@q("ml_folds", ctes(f"sf AS ({SP.split_folds_sql()})") + "SELECT respondent_id, heart_disease, fold FROM sf WHERE split = 'train'")
def ml_folds(spark, sf):
    """5 stratified folds over the training part: after the test rows, class-wise round robin in hash order."""
    s = SP.split_with_folds(survey_base(spark, sf).select("respondent_id", S.TARGET))
    return s.where("split = 'train'").select("respondent_id", S.TARGET, "fold")


def _subsample_sql(size):
    h = arith_hash_sql("respondent_id", S.SEED)
    return ctes(f"sp AS ({SP.split_sql()}), train AS (SELECT respondent_id, heart_disease FROM sp WHERE split = 'train'), "
                f"r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY heart_disease ORDER BY {h}, respondent_id) AS rk, "
                "COUNT(*) OVER (PARTITION BY heart_disease) AS nc, COUNT(*) OVER () AS n FROM train)") + \
        f"SELECT respondent_id, heart_disease FROM r WHERE n <= {size} OR rk <= FLOOR(CAST(nc AS DOUBLE) * {size} / n + 0.5)"


@q("ml_subsample", _subsample_sql(80000))
def ml_subsample(spark, sf):
    """Stratified sample of 80 000 training rows (the training part itself when smaller)."""
    s = SP.stratified_split(survey_base(spark, sf).select("respondent_id", S.TARGET))
    return SP.stratified_subsample(s.where("split = 'train'").drop("split"), 80000)


@q("ml_subsample_small", _subsample_sql(3000))
def ml_subsample_small(spark, sf):
    """The same operator at a size below the input (3 000 rows), so the quota path runs."""
    s = SP.stratified_split(survey_base(spark, sf).select("respondent_id", S.TARGET))
    return SP.stratified_subsample(s.where("split = 'train'").drop("split"), 3000)


@q("ml_sample", ctes() + f"SELECT respondent_id, age_group, sex, heart_disease FROM base ORDER BY {arith_hash_sql('respondent_id', S.SEED)}, "
   "respondent_id LIMIT 3000")
def ml_sample(spark, sf):
    """3 000 rows without replacement, chosen by hash (the sample size is the feature)."""
    return SP.hash_sample(survey_base(spark, sf).select("respondent_id", "age_group", "sex", S.TARGET), 3000)


@q("ml_baseline", ctes("c AS (SELECT heart_disease, COUNT(*) AS n FROM base GROUP BY 1)") +
   "SELECT CAST(ARG_MAX(heart_disease, n) AS BIGINT) AS majority_class, CAST(MAX(n) AS DOUBLE) / SUM(n) AS accuracy, 0.5 AS roc_auc FROM c")
def ml_baseline(spark, sf):
    """Majority-class predictor: its accuracy, and ROC-AUC 0.5."""
    c = survey_base(spark, sf).groupBy(S.TARGET).agg(F.count(F.lit(1)).alias("n"))
    return c.agg(F.max_by(S.TARGET, "n").alias("majority_class"), (F.max("n") / F.sum("n")).alias("accuracy"),
                 F.lit(0.5).alias("roc_auc"))


@q("ml_class_weight", ctes("c AS (SELECT heart_disease, COUNT(*) AS n FROM base GROUP BY 1)") +
   "SELECT heart_disease, CAST(n AS BIGINT) AS n, CAST(SUM(n) OVER () AS DOUBLE) / (2 * n) AS weight, "
   "CAST(SUM(CASE WHEN heart_disease = 0 THEN n END) OVER () AS DOUBLE) / SUM(CASE WHEN heart_disease = 1 THEN n END) OVER () "
   "AS neg_pos_ratio FROM c")
def ml_class_weight(spark, sf):
    """Balanced class weights n / (2 n_c) and the negative:positive ratio."""
    c = survey_base(spark, sf).groupBy(S.TARGET).agg(F.count(F.lit(1)).alias("n"))
    t = c.agg(F.sum("n").alias("_t"), F.sum(F.when(F.col(S.TARGET) == 0, F.col("n"))).alias("_neg"),
              F.sum(F.when(F.col(S.TARGET) == 1, F.col("n"))).alias("_pos"))
    j = c.crossJoin(F.broadcast(t))
    return j.select(S.TARGET, "n", (F.col("_t").cast("double") / (2 * F.col("n"))).alias("weight"),
                    (F.col("_neg").cast("double") / F.col("_pos")).alias("neg_pos_ratio"))


_CURVE_CTE = (_SCORED_CTE + ", cnt AS (SELECT risk AS score, SUM(heart_disease) AS pos, SUM(1 - heart_disease) AS neg FROM sc GROUP BY risk), "
              "cu AS (SELECT score, pos, neg, SUM(pos) OVER (ORDER BY score DESC) AS tp, SUM(neg) OVER (ORDER BY score DESC) AS fp, "
              "SUM(pos) OVER () AS P, SUM(neg) OVER () AS N FROM cnt)")


@q("win_curve_cumsum", ctes(_CURVE_CTE) + "SELECT score, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg, "
   "CAST(tp AS BIGINT) AS cum_pos, CAST(fp AS BIGINT) AS cum_neg FROM cu")
def win_curve_cumsum(spark, sf):
    """Cumulative positives / negatives by descending score (distributed prefix sum)."""
    c = CV.score_counts(_scored(spark, sf), "risk", S.TARGET).withColumn("_k", -F.col("score"))
    return ordering.running_sum(c, [F.col("_k")], ["pos", "neg"]).drop("_k")


@q("ml_roc", ctes(_CURVE_CTE) + "SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, "
   "CAST(tp AS DOUBLE) / P AS tpr, CAST(fp AS DOUBLE) / N AS fpr FROM cu")
def ml_roc(spark, sf):
    """ROC points, one per distinct threshold."""
    return CV.curve(_scored(spark, sf), "risk", S.TARGET).select("threshold", "tp", "fp", "tpr", "fpr")


@q("ml_pr", ctes(_CURVE_CTE) + "SELECT score AS threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / P AS recall FROM cu")
def ml_pr(spark, sf):
    """Precision-recall points, one per distinct threshold."""
    return CV.curve(_scored(spark, sf), "risk", S.TARGET).select("threshold", "precision", "recall")


@q("ml_metrics", ctes(_CURVE_CTE + ", au AS (SELECT ROUND(SUM(neg * (tp - pos * 0.5)) / (MAX(P) * MAX(N)), 9) AS roc_auc, "
                      "ROUND(SUM(CAST(pos AS DOUBLE) / P * (CAST(tp AS DOUBLE) / (tp + fp))), 9) AS average_precision FROM cu), "
                      "cf AS (SELECT COUNT(*) FILTER (WHERE risk >= 0.5 AND heart_disease = 1) AS tp, "
                      "COUNT(*) FILTER (WHERE risk >= 0.5 AND heart_disease = 0) AS fp, "
                      "COUNT(*) FILTER (WHERE risk < 0.5 AND heart_disease = 1) AS fn FROM sc), "
                      "pr AS (SELECT COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0) AS precision, "
                      "COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0) AS recall FROM cf)")
   + "SELECT roc_auc, average_precision, precision, recall, COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0) AS f1 "
     "FROM au CROSS JOIN pr")
def ml_metrics(spark, sf):
    """ROC-AUC, average precision (step sum), and precision / recall / F1 at 0.5."""
    sc = _scored(spark, sf)
    a = CV.auc_ap(sc, "risk", S.TARGET)
    t = CV.threshold_metrics(sc, "risk", S.TARGET, 0.5).select("precision", "recall", "f1")
    return a.crossJoin(t)


@q("ml_threshold", ctes(_CURVE_CTE) + f"SELECT score AS threshold, CAST(tp AS DOUBLE) / P AS recall, CAST(tp AS DOUBLE) / (tp + fp) "
   f"AS precision FROM cu WHERE CAST(tp AS DOUBLE) / P >= {S.TARGET_RECALL} ORDER BY score DESC LIMIT 1")
def ml_threshold(spark, sf):
    """Highest threshold with recall >= 0.75."""
    return CV.pick_threshold(_scored(spark, sf), "risk", S.TARGET, S.TARGET_RECALL)


_THR_CTE = _CURVE_CTE + f", th AS (SELECT MAX(score) AS t FROM cu WHERE CAST(tp AS DOUBLE) / P >= {S.TARGET_RECALL})"


@q("ml_confusion", ctes(_THR_CTE) + "SELECT CAST(COUNT(*) FILTER (WHERE risk >= t AND heart_disease = 1) AS BIGINT) AS tp, "
   "CAST(COUNT(*) FILTER (WHERE risk < t AND heart_disease = 1) AS BIGINT) AS fn, "
   "CAST(COUNT(*) FILTER (WHERE risk >= t AND heart_disease = 0) AS BIGINT) AS fp, "
   "CAST(COUNT(*) FILTER (WHERE risk < t AND heart_disease = 0) AS BIGINT) AS tn FROM sc CROSS JOIN th")
def ml_confusion(spark, sf):
    """TN/FP/FN/TP at the chosen threshold (the threshold is a one-row aggregate, broadcast)."""
    sc = _scored(spark, sf)
    th = CV.pick_threshold(sc, "risk", S.TARGET, S.TARGET_RECALL).select(F.col("threshold").alias("_t"))
    x = sc.crossJoin(F.broadcast(th))
    return CV.threshold_metrics(x, "risk", S.TARGET, F.col("_t")).select("tp", "fn", "fp", "tn")


def _class_report_sql():
    cf = ("cf AS (SELECT COUNT(*) FILTER (WHERE risk >= t AND heart_disease = 1) AS tp, COUNT(*) FILTER (WHERE risk < t AND heart_disease = 1) AS fn, "
          "COUNT(*) FILTER (WHERE risk >= t AND heart_disease = 0) AS fp, COUNT(*) FILTER (WHERE risk < t AND heart_disease = 0) AS tn FROM sc CROSS JOIN th), "
          "m AS (SELECT COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0) AS p1, COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0) AS r1, "
          "COALESCE(CAST(tn AS DOUBLE) / NULLIF(tn + fn, 0), 0) AS p0, COALESCE(CAST(tn AS DOUBLE) / NULLIF(tn + fp, 0), 0) AS r0, "
          "CAST(tp + fn AS DOUBLE) AS s1, CAST(tn + fp AS DOUBLE) AS s0 FROM cf), "
          "f AS (SELECT *, COALESCE(2 * p1 * r1 / NULLIF(p1 + r1, 0), 0) AS f1, COALESCE(2 * p0 * r0 / NULLIF(p0 + r0, 0), 0) AS f0 FROM m)")
    rows = [
        "SELECT '0' AS label, ROUND(p0, 9) AS precision, ROUND(r0, 9) AS recall, ROUND(f0, 9) AS f1, s0 AS support FROM f",
        "SELECT '1', ROUND(p1, 9), ROUND(r1, 9), ROUND(f1, 9), s1 FROM f",
        "SELECT 'macro avg', ROUND((p0 + p1) / 2, 9), ROUND((r0 + r1) / 2, 9), ROUND((f0 + f1) / 2, 9), s1 + s0 FROM f",
        "SELECT 'weighted avg', ROUND((p0 * s0 + p1 * s1) / (s1 + s0), 9), ROUND((r0 * s0 + r1 * s1) / (s1 + s0), 9), "
        "ROUND((f0 * s0 + f1 * s1) / (s1 + s0), 9), s1 + s0 FROM f",
    ]
    return ctes(_THR_CTE + ", " + cf) + " UNION ALL ".join(rows)


@q("ml_class_report", _class_report_sql())
def ml_class_report(spark, sf):
    """Per-class precision / recall / F1 / support, macro and weighted averages, at the chosen threshold."""
    sc = _scored(spark, sf)
    th = CV.pick_threshold(sc, "risk", S.TARGET, S.TARGET_RECALL).select(F.col("threshold").alias("_t"))
    conf = CV.threshold_metrics(sc.crossJoin(F.broadcast(th)), "risk", S.TARGET, F.col("_t"))
    return CV.class_report(conf)


@q("ml_reliability", ctes(_SCORED_CTE + ", e AS (SELECT " + ", ".join(
    f"QUANTILE_CONT(risk, {i / 10}) AS e{i}" for i in range(1, 10)) + " FROM sc)") +
   "SELECT CAST(" + " + ".join(f"CASE WHEN e{i} < risk THEN 1 ELSE 0 END" for i in range(1, 10)) + " AS BIGINT) AS bin, "
   "CAST(COUNT(*) AS BIGINT) AS n, ROUND(AVG(risk), 12) AS mean_predicted, AVG(CAST(heart_disease AS DOUBLE)) AS observed_rate FROM sc CROSS JOIN e GROUP BY 1")
def ml_reliability(spark, sf):
    """Reliability diagram data: 10 quantile bins of the score, mean predicted vs observed rate."""
    return CV.reliability(_scored(spark, sf), "risk", S.TARGET)
