"""Exploratory statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..operators import duplicates as D
from ..operators import measures as M
from ..operators import star
from ..operators import stats as ST
from ..sources.tables import analytical_base, report_fact as fact, survey_base
from .common import Registry
from .sqlbase import SRC22, ctes, with_fact

R = Registry()
q = R.add
DG = ST.DIGITS

CONT4 = ["bmi", "ment_hlth_days", "phys_hlth_days", "total_unhealthy_days"]
BOX4 = ["bmi", "ment_hlth_days", "phys_hlth_days", "risk_factor_count"]
LIM3 = ["bmi", "ment_hlth_days", "phys_hlth_days"]
SCALE10 = ["bmi", "ment_hlth_days", "phys_hlth_days", "age_group", "gen_hlth",
           "income", "education", "risk_factor_count", "high_bp", "smoker"]
CORR16 = ["heart_disease", "high_bp", "high_chol", "bmi", "smoker", "stroke", "diabetes", "phys_activity", "gen_hlth",
          "ment_hlth_days", "phys_hlth_days", "diff_walk", "sex", "age_group", "education", "income"]
STATUS11 = ["high_bp", "high_chol", "smoker", "stroke", "diabetes", "phys_activity", "fruits", "veggies",
            "hvy_alcohol", "diff_walk", "has_care_access"]


def _long_sql(cols, keep=""):
    k = f"{keep}, " if keep else ""
    return " UNION ALL ".join(f"SELECT {k}'{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM base" for c in cols)


_TYPES = {c: ("bigint" if c == "respondent_id" else "float" if c == "bmi" else "int") for c in S.ANALYTICAL_COLUMNS}


@q("agg_overview", ctes() + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{_TYPES[c]}' AS type, CAST(COUNT(DISTINCT {c}) AS BIGINT) AS n_distinct, "
    f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_missing FROM base" for c in S.ANALYTICAL_COLUMNS))
def agg_overview(spark, sf):
    """Per column: type, distinct values, missing values (unpivot + grouped distinct, no Expand blow-up)."""
    b = analytical_base(spark, sf)
    types = {f.name: f.dataType.simpleString() for f in b.schema.fields}
    long = ST.unpivot(b, S.ANALYTICAL_COLUMNS)
    distinct = long.where(F.col("value").isNotNull()).select("column_name", "value").distinct().groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n_distinct"))
    missing = long.groupBy("column_name").agg(F.count_if(F.col("value").isNull()).alias("n_missing"))
    t = spark.createDataFrame(list(types.items()), "column_name string, type string")
    return F.broadcast(t).join(distinct, "column_name", "left").join(missing, "column_name", "left").select(
        "column_name", "type", F.coalesce("n_distinct", F.lit(0)).cast("long").alias("n_distinct"),
        F.col("n_missing").cast("long"))


@q("agg_class_balance", ctes("c AS (SELECT heart_disease, COUNT(*) AS n FROM base GROUP BY 1)") +
   "SELECT heart_disease, CAST(n AS BIGINT) AS n, CAST(n AS DOUBLE) / SUM(n) OVER () * 100 AS share_pct, "
   "CAST(SUM(CASE WHEN heart_disease = 0 THEN n END) OVER () AS DOUBLE) / SUM(CASE WHEN heart_disease = 1 THEN n END) OVER () "
   "AS neg_pos_ratio FROM c")
def agg_class_balance(spark, sf):
    b = survey_base(spark, sf)
    c = b.groupBy(S.TARGET).agg(F.count(F.lit(1)).alias("n"))
    tot = c.agg(F.sum("n").alias("_t"), F.sum(F.when(F.col(S.TARGET) == 0, F.col("n"))).alias("_neg"),
                F.sum(F.when(F.col(S.TARGET) == 1, F.col("n"))).alias("_pos"))
    j = c.crossJoin(F.broadcast(tot))
    return j.select(S.TARGET, "n", (F.col("n") / F.col("_t") * 100).alias("share_pct"),
                    (F.col("_neg").cast("double") / F.col("_pos")).alias("neg_pos_ratio"))


@q("agg_describe", ctes(f"l AS ({_long_sql(CONT4)})") +
   "SELECT column_name, CAST(COUNT(value) AS BIGINT) AS count, AVG(value) AS mean, ROUND(STDDEV_SAMP(value), 9) AS std, "
   "MIN(value) AS min, QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.5) AS median, QUANTILE_CONT(value, 0.75) AS q3, "
   "MAX(value) AS max, ROUND(SKEWNESS(value), 9) AS skew, ROUND(KURTOSIS(value), 9) AS kurtosis FROM l GROUP BY column_name")
def agg_describe(spark, sf):
    """describe() + bias-corrected skewness and kurtosis for the 4 continuous columns."""
    return ST.describe(survey_base(spark, sf), CONT4)


@q("agg_histogram", ctes(f"l AS ({_long_sql(CONT4)}), mm AS (SELECT column_name, MIN(value) AS lo, MAX(value) AS hi FROM l GROUP BY 1), "
                         "b AS (SELECT l.column_name, CAST(CASE WHEN hi = lo THEN 0 ELSE LEAST(FLOOR((value - lo) / (hi - lo) * 40), 39) END AS BIGINT) AS bin "
                         "FROM l JOIN mm ON l.column_name = mm.column_name), "
                         "c AS (SELECT column_name, bin, COUNT(*) AS n FROM b GROUP BY 1, 2), "
                         "g AS (SELECT column_name, lo, hi, CAST(i AS BIGINT) AS bin FROM mm CROSS JOIN range(0, 40) t(i))")
   + "SELECT g.column_name, g.bin, g.lo + g.bin * ((g.hi - g.lo) / 40) AS bin_start, CAST(COALESCE(c.n, 0) AS BIGINT) AS n "
     "FROM g LEFT JOIN c ON g.column_name = c.column_name AND g.bin = c.bin")
def agg_histogram(spark, sf):
    """40 equal-width bins for the 4 continuous columns, empty bins included."""
    return ST.histogram(survey_base(spark, sf), CONT4, 40)


@q("agg_box", ctes(f"l AS ({_long_sql(BOX4, 'heart_disease')}), "
                   "qq AS (SELECT column_name, heart_disease, QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.5) AS median, "
                   "QUANTILE_CONT(value, 0.75) AS q3 FROM l GROUP BY 1, 2)")
   + "SELECT l.column_name, l.heart_disease, q1, median, q3, "
     "MIN(CASE WHEN value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) THEN value END) AS whisker_low, "
     "MAX(CASE WHEN value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) THEN value END) AS whisker_high, "
     "CAST(COUNT(*) FILTER (WHERE NOT (value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1))) AS BIGINT) AS n_outliers "
     "FROM l JOIN qq ON l.column_name = qq.column_name AND l.heart_disease = qq.heart_disease GROUP BY 1, 2, 3, 4, 5")
def agg_box(spark, sf):
    """Box statistics by status for 4 columns: quartiles, whiskers inside 1.5 IQR, outliers."""
    return ST.box(survey_base(spark, sf), BOX4)


@q("agg_outliers", ctes(f"l AS ({_long_sql(CONT4)}), st AS (SELECT column_name, QUANTILE_CONT(value, 0.25) AS q1, "
                        "QUANTILE_CONT(value, 0.5) AS median, QUANTILE_CONT(value, 0.75) AS q3, AVG(value) AS mean, "
                        "STDDEV_SAMP(value) AS std FROM l GROUP BY 1), "
                        "g AS (SELECT l.column_name, q1, median, q3, COUNT(*) AS n, "
                        "COUNT(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_out_iqr, "
                        "COUNT(*) FILTER (WHERE std > 0 AND ABS(value - mean) / std > 3) AS n_out_z "
                        "FROM l JOIN st ON l.column_name = st.column_name GROUP BY 1, 2, 3, 4)")
   + "SELECT column_name, q1, median, q3, q3 - q1 AS iqr, CAST(n_out_iqr AS BIGINT) AS n_out_iqr, "
     "CAST(n_out_iqr AS DOUBLE) / n * 100 AS pct_out_iqr, CAST(n_out_z AS BIGINT) AS n_out_z, CAST(n_out_z AS DOUBLE) / n * 100 AS pct_out_z FROM g")
def agg_outliers(spark, sf):
    """Q1/median/Q3/IQR and counts and shares outside the IQR fences and beyond |z| > 3."""
    return ST.outliers(survey_base(spark, sf), CONT4)


@q("agg_outlier_limits", ctes(f"l AS ({_long_sql(LIM3)})") +
   "SELECT column_name, MAX(value) AS max, QUANTILE_CONT(value, 0.75) + 1.5 * (QUANTILE_CONT(value, 0.75) - QUANTILE_CONT(value, 0.25)) "
   "AS iqr_limit, ROUND(AVG(value) + 3 * STDDEV_SAMP(value), 9) AS z3_limit FROM l GROUP BY 1")
def agg_outlier_limits(spark, sf):
    return ST.outlier_limits(survey_base(spark, sf), LIM3)


@q("agg_tail_quantiles", ctes() + " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS prob, QUANTILE_CONT(CAST(bmi AS DOUBLE), {p}) AS value FROM base" for p in (0.95, 0.99, 0.999, 1.0)))
def agg_tail_quantiles(spark, sf):
    """Upper quantiles of bmi (95, 99, 99.9, 100 %)."""
    return ST.tail_quantiles(survey_base(spark, sf))


@q("agg_scales", ctes(f"l AS ({_long_sql(SCALE10)})") +
   "SELECT column_name, MIN(value) AS min, MAX(value) AS max, MAX(value) - MIN(value) AS range, AVG(value) AS mean, "
   "ROUND(STDDEV_SAMP(value), 9) AS std FROM l GROUP BY 1")
def agg_scales(spark, sf):
    """min/max/range/mean/std of 10 columns, ordered by range."""
    return ST.scales(survey_base(spark, sf), SCALE10)


@q("agg_scale_ratio", ctes(f"l AS ({_long_sql(SCALE10)}), g AS (SELECT MAX(value) - MIN(value) AS r, "
                           "(MAX(value) - MIN(value)) / STDDEV_SAMP(value) AS rz FROM l GROUP BY column_name)")
   + "SELECT MAX(r) / MIN(r) AS ratio_before, ROUND(MAX(rz) / MIN(rz), 9) AS ratio_after FROM g")
def agg_scale_ratio(spark, sf):
    return ST.scale_ratio(survey_base(spark, sf), SCALE10)


def _prev_sql(segs):
    parts = []
    for s in segs:
        parts.append(f"SELECT '{s}' AS segment, CAST({s} AS BIGINT) AS code, CAST(COUNT(*) AS BIGINT) AS n, "
                     f"AVG(heart_disease) * 100 AS prevalence_pct, {C.case_sql(S.SEGMENT_LABELS[s], s)} AS label FROM base GROUP BY {s}")
    return ctes() + " UNION ALL ".join(parts)


@q("agg_prevalence_by", _prev_sql(S.SEGMENTS))
def agg_prevalence_by(spark, sf):
    """n and target rate per code of six segment columns, labelled, in one pass."""
    return ST.prevalence_by(survey_base(spark, sf), S.SEGMENTS, S.SEGMENT_LABELS)


@q("agg_bmi_curve", _prev_sql(["bmi_class"]))
def agg_bmi_curve(spark, sf):
    """Target rate by BMI class (the J curve)."""
    return ST.prevalence_by(survey_base(spark, sf), ["bmi_class"], S.SEGMENT_LABELS)


@q("agg_risk_gradient", ctes() + "SELECT risk_factor_count, CAST(COUNT(*) AS BIGINT) AS n, AVG(heart_disease) * 100 AS prevalence_pct "
   "FROM base GROUP BY 1")
def agg_risk_gradient(spark, sf):
    b = survey_base(spark, sf)
    return b.groupBy("risk_factor_count").agg(F.count(F.lit(1)).alias("n"), (F.avg(S.TARGET) * 100).alias("prevalence_pct")).orderBy(
        "risk_factor_count")


@q("agg_age_extremes", ctes("r AS (SELECT age_group, AVG(heart_disease) * 100 AS p FROM base GROUP BY 1)") +
   "SELECT MIN(p) AS min_rate_pct, MAX(p) AS max_rate_pct, CAST(ARG_MIN(age_group, p) AS BIGINT) AS age_min, "
   "CAST(ARG_MAX(age_group, p) AS BIGINT) AS age_max FROM r")
def agg_age_extremes(spark, sf):
    """Lowest and highest target rate over age groups (aggregate of an aggregate)."""
    b = survey_base(spark, sf)
    r = b.groupBy("age_group").agg((F.avg(S.TARGET) * 100).alias("p"))
    return r.agg(F.min("p").alias("min_rate_pct"), F.max("p").alias("max_rate_pct"),
                 F.min_by("age_group", "p").alias("age_min"), F.max_by("age_group", "p").alias("age_max"))


def _corr_sql():
    pairs = [(a, b) for i, a in enumerate(CORR16) for b in CORR16[i:]]
    parts = [f"SELECT '{a}' AS var1, '{b}' AS var2, ROUND(CORR(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 9) AS corr FROM base"
             for a, b in pairs]
    parts += [f"SELECT '{b}', '{a}', ROUND(CORR(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 9) FROM base" for a, b in pairs if a != b]
    return ctes() + " UNION ALL ".join(parts)


@q("agg_corr_matrix", _corr_sql())
def agg_corr_matrix(spark, sf):
    """Pearson 16 x 16, all pairs in one aggregation pass, long format."""
    return ST.corr_pairs(survey_base(spark, sf), CORR16)


@q("agg_corr_target", ctes() + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, ROUND(CORR(CAST({c} AS DOUBLE), CAST(heart_disease AS DOUBLE)), 9) AS corr FROM base" for c in CORR16[1:]))
def agg_corr_target(spark, sf):
    """Correlation with the target, by descending absolute value."""
    return ST.corr_target(survey_base(spark, sf), CORR16[1:])


@q("agg_status_profile", ctes("s AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS indicator, AVG(CASE WHEN heart_disease = 0 THEN CASE WHEN {c} > 0 THEN 1 ELSE 0 END END) * 100 AS healthy_pct, "
    f"AVG(CASE WHEN heart_disease = 1 THEN CASE WHEN {c} > 0 THEN 1 ELSE 0 END END) * 100 AS sick_pct FROM base" for c in STATUS11) + ")")
   + "SELECT indicator, healthy_pct, sick_pct, sick_pct - healthy_pct AS gap_pts FROM s")
def agg_status_profile(spark, sf):
    """% with value > 0 for 11 indicators by status, and the gap, sorted."""
    return ST.status_profile(survey_base(spark, sf), STATUS11)


# Written by hand, apart from the operator: codebook sizes, and one more member where the base needs it.
_DWH_DIMS = (("dim_age", "age_group", 1, 13), ("dim_education", "education", 1, 6), ("dim_income", "income", 1, 8), ("dim_sex", "sex", 0, 1),
             ("dim_genhlth", "gen_hlth", 1, 5), ("dim_diabetes", "diabetes", 0, 2), ("dim_bmi_class", "bmi_class", 1, 6))


def _dwh_sql():
    dims = ", ".join(f"(SELECT CAST({high - low + 1} + CASE WHEN COUNT(*) FILTER (WHERE {src} IS NULL OR {src} NOT BETWEEN {low} AND {high}) > 0 "
                     f"THEN 1 ELSE 0 END AS BIGINT) FROM base) AS {t}_rows" for t, src, low, high in _DWH_DIMS)
    return with_fact() + (f"SELECT CAST(COUNT(*) AS BIGINT) AS fact_rows, CAST(31 AS BIGINT) AS fact_columns, "
                          f"CAST(SUM(heart_disease) AS DOUBLE) / COUNT(*) AS taux_maladie, {dims}, CAST(0 AS BIGINT) AS orphans_total FROM fact")


@q("agg_dwh_stats", _dwh_sql())
def agg_dwh_stats(spark, sf):
    """Fact rows and columns, disease rate, rows per published dimension, fact keys without a dimension row."""
    base = survey_base(spark, sf)
    published = star.published_dims(spark, base)
    keys = {t: [r[0] for r in published[t].select(key).collect()] for t, key, *_ in S.DIMENSIONS}
    lost = [F.count_if(F.col(key).isNull() | ~F.col(key).isin(keys[t])) for t, key, *_ in S.DIMENSIONS]
    out = fact(spark, sf).agg(F.count(F.lit(1)).alias("fact_rows"), M.disease_rate().alias("taux_maladie"),
                                     sum(lost[1:], lost[0]).cast("long").alias("orphans_total"))
    return out.select("fact_rows", F.lit(len(S.FACT_COLUMNS)).alias("fact_columns"), "taux_maladie",
                      *[F.lit(len(keys[t])).cast("long").alias(f"{t}_rows") for t, *_ in S.DIMENSIONS], "orphans_total")


@q("agg_eda_report", ctes(f"g AS (SELECT COUNT(*) AS n FROM base GROUP BY {SRC22}), "
                          "d AS (SELECT CAST(SUM(n - 1) AS BIGINT) AS redundant_rows, CAST(SUM(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS rows_in_groups FROM g), "
                          f"dd AS (SELECT AVG(heart_disease) * 100 AS rate_dedup_pct FROM (SELECT DISTINCT {SRC22} FROM base) x), "
                          "o AS (SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, AVG(heart_disease) * 100 AS rate_pct, "
                          "CAST(COUNT(*) FILTER (WHERE bmi > 60) AS BIGINT) AS bmi_gt_60, "
                          "CAST(COUNT(*) FILTER (WHERE bmi > 60 OR bmi < 14) AS BIGINT) AS bmi_implausible, "
                          "CAST(SUM(flag_sante_incoherente) AS BIGINT) AS incoherent, "
                          "AVG(CASE WHEN bmi > 60 THEN heart_disease END) * 100 AS rate_bmi_gt_60_pct, "
                          "AVG(CASE WHEN phys_hlth_days = 30 THEN heart_disease END) * 100 AS rate_phys_30_pct FROM base)")
   + "SELECT * FROM o CROSS JOIN d CROSS JOIN dd")
def agg_eda_report(spark, sf):
    """Headline numbers of the exploratory report in one row."""
    b = survey_base(spark, sf)
    o = b.agg(F.count(F.lit(1)).alias("n_rows"), (F.avg(S.TARGET) * 100).alias("rate_pct"),
              F.count_if(F.col("bmi") > 60).alias("bmi_gt_60"),
              F.count_if((F.col("bmi") > 60) | (F.col("bmi") < 14)).alias("bmi_implausible"),
              F.sum("flag_sante_incoherente").alias("incoherent"),
              (F.avg(F.when(F.col("bmi") > 60, F.col(S.TARGET))) * 100).alias("rate_bmi_gt_60_pct"),
              (F.avg(F.when(F.col("phys_hlth_days") == 30, F.col(S.TARGET))) * 100).alias("rate_phys_30_pct"))
    t = D.totals(b).select("redundant_rows", "rows_in_groups")
    dd = D.dedup_impact(b).select(F.col("rate_without_pct").alias("rate_dedup_pct"))
    return o.crossJoin(t).crossJoin(dd)


@q("agg_overview_approx")
def agg_overview_approx(spark, sf):
    """Per column: approximate distinct count (HyperLogLog++, 1 % relative error) and missing values:
    the bounded-memory mode of agg_overview for very large tables."""
    b = analytical_base(spark, sf)
    long = ST.unpivot(b, S.ANALYTICAL_COLUMNS)
    return long.groupBy("column_name").agg(F.approx_count_distinct("value", 0.01).alias("n_distinct_approx"),
                                           F.count_if(F.col("value").isNull()).cast("long").alias("n_missing"))


@q("agg_tail_quantiles_approx")
def agg_tail_quantiles_approx(spark, sf):
    """Upper bmi quantiles with the bounded-memory sketch (percentile_approx, accuracy 10 000)."""
    probs = [0.95, 0.99, 0.999, 1.0]
    one = survey_base(spark, sf).agg(F.percentile_approx(F.col("bmi").cast("double"), probs, 10000).alias("q"))
    return one.select(F.posexplode("q").alias("i", "value")).select(
        F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("i") + 1).alias("prob"), "value")
