"""Exact ROC / PR curves and the metrics built on them.

Rows are first reduced to one row per distinct score (positives, negatives):
a partial aggregate, so a score shared by a third of the rows is one row per
map task. Cumulative counts along descending score come from the bucketed
``running_sum`` (no global window). Every metric is then a sum over the
distinct scores, so the whole computation is linear and exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import ordering

DIGITS = 9


def score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum((1 - F.col(label)).cast("long")).alias("neg"))


def curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """One point per distinct threshold, descending: tp, fp (score >= threshold), tpr, fpr, precision, recall."""
    return curve_from_counts(score_counts(df, score, label))


def curve_from_counts(counts: DataFrame) -> DataFrame:
    """The curve from a (score, pos, neg) table, one row per distinct score."""
    c = counts.withColumn("_k", -F.col("score"))
    cum = ordering.running_sum(c, [F.col("_k")], ["pos", "neg"])
    tot = c.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    x = cum.crossJoin(F.broadcast(tot))
    return x.select(
        F.col("score").alias("threshold"), "pos", "neg",
        F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        (F.col("cum_pos") / F.col("P")).alias("tpr"), (F.col("cum_neg") / F.col("N")).alias("fpr"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        (F.col("cum_pos") / F.col("P")).alias("recall"), "P", "N")


def auc_ap(df: DataFrame, score: str, label: str) -> DataFrame:
    """ROC-AUC (Mann-Whitney, ties count one half) and average precision (step sum)."""
    return auc_ap_from_counts(score_counts(df, score, label))


def auc_ap_from_counts(counts: DataFrame) -> DataFrame:
    c = curve_from_counts(counts)
    return c.agg(
        F.round(F.sum(F.col("neg") * (F.col("tp") - F.col("pos") * 0.5)) / (F.first("P") * F.first("N")), DIGITS).alias("roc_auc"),
        F.round(F.sum(F.col("pos") / F.col("P") * F.col("precision")), DIGITS).alias("average_precision"))


def threshold_metrics(df: DataFrame, score: str, label: str, threshold) -> DataFrame:
    """Confusion counts and precision / recall / F1 of ``score >= threshold`` (a Column or number)."""
    t = threshold if not isinstance(threshold, (int, float)) else F.lit(float(threshold))
    pred = (F.col(score) >= t).cast("int")
    y = F.col(label)
    c = df.agg(F.count_if((pred == 1) & (y == 1)).alias("tp"), F.count_if((pred == 0) & (y == 1)).alias("fn"),
               F.count_if((pred == 1) & (y == 0)).alias("fp"), F.count_if((pred == 0) & (y == 0)).alias("tn"))
    prec = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
    rec = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))
    return c.select("tp", "fn", "fp", "tn", F.coalesce(prec, F.lit(0.0)).alias("precision"),
                    F.coalesce(rec, F.lit(0.0)).alias("recall")).withColumn(
        "f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))


def summary_from_counts(counts: DataFrame, threshold: float = 0.5) -> DataFrame:
    """ROC-AUC, PR-AUC and precision / recall / F1 of ``score >= threshold`` from one (score, pos, neg) table."""
    a = auc_ap_from_counts(counts).withColumnRenamed("average_precision", "pr_auc")
    t = counts.agg(F.sum(F.when(F.col("score") >= threshold, F.col("pos")).otherwise(0)).alias("tp"),
                   F.sum(F.when(F.col("score") >= threshold, F.col("neg")).otherwise(0)).alias("fp"),
                   F.sum("pos").alias("P"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("P").cast("double")), F.lit(0.0))
    t = t.select(prec.alias("precision"), rec.alias("recall"))
    t = t.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                   F.col("precision") + F.col("recall")), F.lit(0.0)))
    return a.crossJoin(t)


def summary_by_group(counts: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The same metrics for many models at once: (grp, score, pos, neg) -> (grp, roc_auc, pr_auc, precision, recall, f1).

    One bucketed running sum along (grp, score descending), the groups in disjoint
    ranges of the leading key, less each group's start; scores lie in [0, 1].
    """
    c = cut_lineage(counts.withColumn("_k", -F.col("score")))
    lead = F.col("grp") * 2 + F.col("_k")
    cum = ordering.running_sum(c, [F.col("grp"), F.col("_k")], ["pos", "neg"], lead=lead)
    tot = c.groupBy("grp").agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    w = Window.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)  # one row per model
    tot = tot.select("grp", "P", "N", F.coalesce(F.sum("P").over(w), F.lit(0)).alias("_p0"), F.coalesce(F.sum("N").over(w), F.lit(0)).alias("_n0"))
    x = cum.join(F.broadcast(tot), "grp").withColumns({"tp": F.col("cum_pos") - F.col("_p0"), "fp": F.col("cum_neg") - F.col("_n0")})
    at = F.col("score") >= threshold
    g = x.groupBy("grp").agg(
        F.round(F.sum(F.col("neg") * (F.col("tp") - F.col("pos") * 0.5)) / (F.first("P") * F.first("N")), DIGITS).alias("roc_auc"),
        F.round(F.sum(F.col("pos") / F.col("P") * (F.col("tp") / (F.col("tp") + F.col("fp")))), DIGITS).alias("pr_auc"),
        F.sum(F.when(at, F.col("pos")).otherwise(0)).alias("_tp"), F.sum(F.when(at, F.col("neg")).otherwise(0)).alias("_fp"), F.first("P").alias("_P"))
    prec = F.coalesce(F.try_divide(F.col("_tp").cast("double"), (F.col("_tp") + F.col("_fp")).cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("_tp").cast("double"), F.col("_P").cast("double")), F.lit(0.0))
    g = g.select("grp", "roc_auc", "pr_auc", prec.alias("precision"), rec.alias("recall"))
    return g.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))


def pick_threshold(df: DataFrame, score: str, label: str, target_recall: float) -> DataFrame:
    """Highest threshold whose recall reaches ``target_recall`` (from the PR points)."""
    c = curve(df, score, label).where(F.col("recall") >= target_recall)
    return c.orderBy(F.desc("threshold")).limit(1).select("threshold", "recall", "precision")


def class_report(conf: DataFrame) -> DataFrame:
    """precision / recall / F1 / support per class, macro and weighted averages, from confusion counts."""
    def prf(tp, fp, fn):
        p = F.coalesce(F.try_divide(tp.cast("double"), (tp + fp).cast("double")), F.lit(0.0))
        r = F.coalesce(F.try_divide(tp.cast("double"), (tp + fn).cast("double")), F.lit(0.0))
        f = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
        return p, r, f
    tp, fn, fp, tn = F.col("tp"), F.col("fn"), F.col("fp"), F.col("tn")
    p1, r1, f1 = prf(tp, fp, fn)
    p0, r0, f0 = prf(tn, fn, fp)
    s1, s0 = (tp + fn).cast("double"), (tn + fp).cast("double")
    n = s1 + s0
    rows = [
        F.struct(F.lit("0").alias("label"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1"), s0.alias("support")),
        F.struct(F.lit("1").alias("label"), p1.alias("precision"), r1.alias("recall"), f1.alias("f1"), s1.alias("support")),
        F.struct(F.lit("macro avg").alias("label"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f0 + f1) / 2).alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), ((p0 * s0 + p1 * s1) / n).alias("precision"),
                 ((r0 * s0 + r1 * s1) / n).alias("recall"), ((f0 * s0 + f1 * s1) / n).alias("f1"), n.alias("support")),
    ]
    out = conf.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.select("label", *[F.round(c, DIGITS).alias(c) for c in ("precision", "recall", "f1")], "support")


def reliability(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Quantile bins of the score (a value on an inner edge goes to the lower bin):
    mean predicted and observed rate per non-empty bin.

    The inner edges are exact quantiles read from the per-score counts and
    their running sum (no buffer of all distinct scores in one task).
    """
    probs = [i / bins for i in range(1, bins)]
    names = [f"e{i}" for i in range(1, bins)]
    c = score_counts(df, score, label).select("score", (F.col("pos") + F.col("neg")).alias("c"))
    cum = ordering.running_sum(c, [F.col("score")], ["c"])
    n = c.agg(F.sum("c").alias("_n"))
    cum = cum.crossJoin(F.broadcast(n)).withColumn("_grp", F.lit(0))
    edges = ordering.quantiles_from_cumulative(cum, ["_grp"], "score", "c", "cum_c", "_n", probs, names)
    edges = edges.select(F.array(*names).alias("_e"))
    x = df.crossJoin(F.broadcast(edges))
    s = F.col(score).cast("double")
    x = x.withColumn("bin", F.size(F.filter("_e", lambda e: e < s)))
    return x.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(s), 12).alias("mean_predicted"),
                                F.avg(F.col(label).cast("double")).alias("observed_rate"))
