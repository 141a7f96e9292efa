"""Unsupervised mining queries and the reference-population document (2.11 sc_population)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import lloyd as LL
from ..operators import mining as MN
from ..operators import models as MD
from ..operators import sampling as SP
from ..operators import ward as WD
from ..sources.tables import survey_base
from .common import Registry
from .sqlbase import ctes

R = Registry()
q = R.add

PROFILE12 = ["age_group", "bmi", "gen_hlth", "high_bp", "high_chol", "diff_walk", "phys_activity", "income",
             "education", "any_healthcare", "smoker", "stroke"]


def _x(spark, sf):
    b = survey_base(spark, sf).select("respondent_id", *S.FEATURES, S.TARGET, "has_care_access")
    x, _ = MN.scaled(b)
    return MD.materialize(x)


def _nz(e: str) -> str:
    return f"(ROUND({e}, 9) + 0.0)"


@q("dm_scale", ctes() + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(AVG(CAST({c} AS DOUBLE)), 9) AS mean, ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 9) AS std FROM base"
    for c in S.FEATURES))
def dm_scale(spark, sf):
    """Standardisation statistics of the 21 features (fitted scaler: mean, std ddof=1)."""
    b = survey_base(spark, sf).select(*S.FEATURES)
    m = MN.scaler_pipeline().fit(b).stages[1]
    rows = [(c, round(float(a), 9), round(float(s), 9)) for c, a, s in zip(S.FEATURES, m.mean.toArray(), m.std.toArray())]
    return spark.createDataFrame(rows, "feature string, mean double, std double")


@q("prj_std_check", ctes("st AS (SELECT " + ", ".join(
    f"AVG(CAST({c} AS DOUBLE)) AS m_{c}, STDDEV_SAMP(CAST({c} AS DOUBLE)) AS s_{c}" for c in S.FEATURES) + " FROM base)") +
   " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {_nz(f'm_{c}')} AS mean_before, {_nz(f's_{c}')} AS std_before, "
    f"(SELECT {_nz(f'AVG(({c} - m_{c}) / s_{c})')} FROM base, st) AS mean_after, "
    f"(SELECT {_nz(f'STDDEV_SAMP(({c} - m_{c}) / s_{c})')} FROM base, st) AS std_after FROM st" for c in S.FEATURES))
def prj_std_check(spark, sf):
    """Mean and std of each feature before and after standardisation (one aggregate, unpivoted)."""
    b = survey_base(spark, sf).select(*S.FEATURES)
    st = b.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in S.FEATURES],
               *[F.stddev_samp(F.col(c).cast("double")).alias(f"s_{c}") for c in S.FEATURES])
    z = b.crossJoin(F.broadcast(st))
    after = z.agg(*[F.avg((F.col(c) - F.col(f"m_{c}")) / F.col(f"s_{c}")).alias(f"ma_{c}") for c in S.FEATURES],
                  *[F.stddev_samp((F.col(c) - F.col(f"m_{c}")) / F.col(f"s_{c}")).alias(f"sa_{c}") for c in S.FEATURES])
    j = st.crossJoin(after)

    def nz(c):
        return f"(ROUND({c}, 9) + 0.0)"
    stack = ", ".join(f"'{c}', {nz(f'm_{c}')}, {nz(f's_{c}')}, {nz(f'ma_{c}')}, {nz(f'sa_{c}')}" for c in S.FEATURES)
    return j.selectExpr(f"stack({len(S.FEATURES)}, {stack}) AS (feature, mean_before, std_before, mean_after, std_after)")


@q("dm_pca_variance")
def dm_pca_variance(spark, sf):
    """Explained and cumulative variance (%) of the 21 components; components needed for 80 %."""
    x = _x(spark, sf)
    return MN.variance_table(MN.pca_model(x), spark)


@q("dm_pca_loadings")
def dm_pca_loadings(spark, sf):
    """Correlation circle: each variable's loading on PC1 and PC2."""
    x = _x(spark, sf)
    return MN.loadings(MN.pca_model(x), spark)


@q("dm_pca_scores")
def dm_pca_scores(spark, sf):
    """PC1/PC2 coordinates of a 5 000-row hash sample, with the status."""
    x = _x(spark, sf)
    m = MN.pca_model(x, 2)
    sample = SP.hash_sample(x, 5000)
    return MN.pcs_columns(m, sample.select("respondent_id", S.TARGET, "features"))


@q("dm_choose_k")
def dm_choose_k(spark, sf):
    """k = 2..8, ten seeds each: within-cluster cost and silhouette (squared Euclidean, every row) of the best seed; all 70 runs share their passes."""
    points = LL.points_of(_x(spark, sf))
    rows = MN.choose_k(points)
    points.release()
    return spark.createDataFrame(rows, "k long, inertia double, silhouette double")


def _kmeans_labelled(spark, sf):
    x = _x(spark, sf)
    points = LL.points_of(x)
    best = MN.kmeans_best(points, 4, range(10))
    points.release()
    return LL.assigned(x, best.centres)


@q("dm_kmeans")
def dm_kmeans(spark, sf):
    """k = 4, ten seeds, least cost kept: cluster of every row."""
    return _kmeans_labelled(spark, sf).select("respondent_id", "cluster")


@q("dm_profile_summary")
def dm_profile_summary(spark, sf):
    """Size, share and target rate per cluster, ranked into profiles 1..4 (also jn_cluster_rank, win_profile_rank)."""
    return MN.profile_summary(_kmeans_labelled(spark, sf))


def _profiled(spark, sf):
    lab = _kmeans_labelled(spark, sf)
    ranks = MN.profile_summary(lab).select("cluster", "profile")
    return lab.join(F.broadcast(ranks), "cluster")


@q("dm_profile_means")
def dm_profile_means(spark, sf):
    """Mean of 12 descriptive variables per profile."""
    return MN.profile_means(_profiled(spark, sf), PROFILE12)


@q("dm_profile_signature")
def dm_profile_signature(spark, sf):
    """(profile mean - mean) / std for the 21 features."""
    return MN.profile_signature(_profiled(spark, sf), S.FEATURES)


def _linked(spark, sf):
    x = _x(spark, sf)
    points = LL.points_of(x)
    centres, weights = WD.micro_clusters(points)
    points.release()
    return x, centres, WD.linkage(centres, weights)


@q("dm_hierarchy")
def dm_hierarchy(spark, sf):
    """Ward linkage of every row (through micro-clusters), cut into 4 groups: size and target rate."""
    x, centres, merges = _linked(spark, sf)
    lab = LL.assigned(x, centres, labels=WD.groups(merges, len(centres), 4))
    return lab.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), (F.avg(S.TARGET) * 100).alias("target_pct"))


@q("dm_dendrogram")
def dm_dendrogram(spark, sf):
    """The last 30 merges of the linkage: the clusters joined, height and rows of the new one."""
    _, centres, merges = _linked(spark, sf)
    rows = [(i - len(merges), a, b, height, int(n)) for i, (a, b, height, n) in enumerate(merges)][-30:]
    return spark.createDataFrame(rows, "step long, first long, second long, height double, n long")


# The profile tables on given labels (education code as the cluster), which SQL can hold the operators against.
_GIVEN = ctes("lab AS (SELECT *, education AS cluster FROM base)")


def _given(spark, sf):
    return survey_base(spark, sf).withColumn("cluster", F.col("education"))


@q("dm_profile_summary_given", _GIVEN + "SELECT CAST(cluster AS BIGINT) AS cluster, CAST(ROW_NUMBER() OVER (ORDER BY AVG(heart_disease), cluster) AS BIGINT) AS profile, "
   "CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM lab) * 100 AS share_pct, AVG(heart_disease) * 100 AS target_pct FROM lab GROUP BY cluster")
def dm_profile_summary_given(spark, sf):
    """Size, share, target rate and rank of given clusters."""
    return MN.profile_summary(_given(spark, sf))


@q("dm_profile_means_given", _GIVEN + "SELECT CAST(cluster AS BIGINT) AS cluster, " + ", ".join(f"ROUND(AVG(CAST({c} AS DOUBLE)), 9) AS {c}" for c in PROFILE12) + " FROM lab GROUP BY cluster")
def dm_profile_means_given(spark, sf):
    """Mean of the 12 descriptive variables of given clusters."""
    m = MN.profile_means(_given(spark, sf), PROFILE12, "cluster")
    return m.select("cluster", *[F.round(c, 9).alias(c) for c in PROFILE12])


@q("dm_profile_signature_given", _GIVEN + " UNION ALL ".join(
    f"SELECT CAST(cluster AS BIGINT) AS cluster, '{c}' AS variable, ROUND((AVG(CAST({c} AS DOUBLE)) - (SELECT AVG(CAST({c} AS DOUBLE)) FROM lab)) / "
    f"(SELECT STDDEV_SAMP(CAST({c} AS DOUBLE)) FROM lab), 9) AS signature FROM lab GROUP BY cluster" for c in S.FEATURES))
def dm_profile_signature_given(spark, sf):
    """(cluster mean - mean) / std of the 21 features of given clusters."""
    return MN.profile_signature(_given(spark, sf), S.FEATURES, "cluster").withColumn("signature", F.round("signature", 9))


@q("sc_population")
def sc_population(spark, sf):
    """Reference-population document: totals, real rate, mean risk by the calibrated model, threshold, profiles (array of structs, with the
    mean age code), mean risk by age and sex (maps)."""
    from .ml import calibrated_model
    lab = _profiled(spark, sf)
    base = MD.materialize(calibrated_model(spark, sf).score(survey_base(spark, sf).select("respondent_id", *S.FEATURES, S.TARGET), calibrated="risk"))
    tot = base.agg(F.count(F.lit(1)).alias("n"), (F.avg(S.TARGET) * 100).alias("real_rate_pct"),
                   (F.avg("risk") * 100).alias("mean_risk_pct"), F.lit(float(S.DECISION_THRESHOLD)).alias("threshold"))
    prof = MN.profile_summary(lab).join(
        lab.groupBy("cluster").agg(F.avg("bmi").alias("mean_bmi"), F.avg("age_group").alias("mean_age_group"), ((1 - F.avg("any_healthcare")) * 100).alias("uninsured_pct")), "cluster")
    profiles = prof.agg(F.sort_array(F.collect_list(F.struct("profile", "n", "share_pct", "target_pct", "mean_bmi", "mean_age_group", "uninsured_pct"))).alias("profiles"))
    by_age = base.groupBy("age_group").agg((F.avg("risk") * 100).alias("v")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("age_group").cast("string"), "v"))).alias("mean_risk_by_age"))
    by_sex = base.groupBy("sex").agg((F.avg("risk") * 100).alias("v")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("sex").cast("string"), "v"))).alias("mean_risk_by_sex"))
    return tot.crossJoin(profiles).crossJoin(by_age).crossJoin(by_sex)
