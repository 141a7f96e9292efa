"""Scoring a table: risk, bands, levels, peer positions, what-if scenarios, advice.

Rules (scenarios, advice) are data: a condition Column and its outcome. A row
gets ``filter(array(rule structs), applies)`` then ``posexplode`` - one narrow
projection, no join, no Python per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..session import cut_lineage
from . import ordering

# ---------------------------------------------------------------------------
# What-if scenarios (applicability, label, changes).
# ---------------------------------------------------------------------------
SCENARIOS = [
    ("smoker == 1", "Arrêter de fumer", {"smoker": 0}),
    ("phys_activity == 0", "Reprendre une activité physique", {"phys_activity": 1}),
    ("bmi >= 25", "Atteindre un IMC de 24 (corpulence normale)", {"bmi": 24.0}),
    ("high_bp == 1", "Faire baisser la tension (traitement / hygiène de vie)", {"high_bp": 0}),
    ("high_chol == 1", "Faire baisser le cholestérol", {"high_chol": 0}),
    ("fruits == 0 OR veggies == 0", "Fruits et légumes au quotidien", {"fruits": 1, "veggies": 1}),
    ("hvy_alcohol == 1", "Réduire la consommation d'alcool", {"hvy_alcohol": 0}),
]

# Advice rules in priority order (condition, title), and the default.
ADVICE = [
    ("high_bp == 1", "Hypertension artérielle"),
    ("smoker == 1", "Tabagisme"),
    ("high_chol == 1", "Cholestérol élevé"),
    ("diabetes >= 1", "Diabète ou prédiabète"),
    ("phys_activity == 0", "Sédentarité"),
    ("bmi >= 30", "Surpoids important (IMC ≥ 30)"),
    ("fruits == 0 OR veggies == 0", "Alimentation"),
    ("hvy_alcohol == 1", "Consommation d'alcool"),
    ("any_healthcare == 0 OR no_doc_cost == 1", "Accès aux soins"),
]
ADVICE_DEFAULT = "Profil favorable"


def scorecard(df: DataFrame, name: str = "risk") -> DataFrame:
    """Deterministic risk (points^2 / 20000) used as the exact scoring oracle."""
    return df.withColumn(name, C.scorecard_risk())


def batch_kpis(scored: DataFrame, risk: str, threshold: float) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(risk) >= threshold).alias("flagged"),
        (F.count_if(F.col(risk) >= threshold) / F.count(F.lit(1))).alias("flagged_share"),
        F.round(F.avg(risk), 12).alias("mean_risk"))


def band_distribution(scored: DataFrame, risk: str) -> DataFrame:
    """Rows per risk band, all five bands present (zero and out-of-range risks fall in no band)."""
    spark = scored.sparkSession
    bands = spark.createDataFrame([(i + 1, lab) for i, lab in enumerate(S.RISK_BAND_LABELS)], "band int, band_label string")
    counts = scored.groupBy(C.risk_band(risk).alias("band")).agg(F.count(F.lit(1)).alias("n")).where(F.col("band").isNotNull())
    return F.broadcast(bands).join(counts, "band", "left").select(
        "band", "band_label", F.coalesce("n", F.lit(0)).cast("long").alias("n")).orderBy("band")


def calibration_by_band(scored: DataFrame, risk: str, target: str = S.TARGET) -> DataFrame:
    """Mean estimated risk and real rate (%) per non-empty band."""
    return scored.where(C.risk_band(risk).isNotNull()).groupBy(C.risk_band(risk).alias("band")).agg(
        F.round(F.avg(risk) * 100, 10).alias("mean_risk_pct"), (F.avg(F.col(target).cast("double")) * 100).alias("real_rate_pct"))


def top_decoded(scored: DataFrame, risk: str, k: int = 10) -> DataFrame:
    """k highest risks (ties: lowest id first), decoded after the limit so only k rows are decoded."""
    top = ordering.top_k(scored.select("respondent_id", risk, "age_group", "gen_hlth", "high_bp"), k,
                         [F.desc(risk), F.asc("respondent_id")])
    return top.select("respondent_id", (F.col(risk) * 100).alias("risk_pct"),
                      C.map_lookup(S.LABELS_AGE, "age_group").alias("age"),
                      C.map_lookup(S.LABELS_GENHLTH, "gen_hlth").alias("sante"),
                      C.map_lookup({0: "Non", 1: "Oui"}, "high_bp").alias("hypertension"))


def peer_position(scored: DataFrame, risk: str = "risk") -> DataFrame:
    """Each row against its peers: (age, sex) if that group has >= 30 rows, else age, else everyone.

    The table is read twice: once for the counts of (group, risk) at the three
    grains (group ids 100 + 2 age + sex, 200 + age, 300; pre-aggregated, then
    kept), once for the result. A bucketed running sum along (group, risk)
    gives strictly-lower counts; group size, mean and median (grouped ``min``
    over the cumulative counts) come from the same table. Rows join the
    statistics of their (group, risk); both sides of that join are exchanged
    for it alone, so Spark can split a risk that many rows share.
    """
    base = scored.select("respondent_id", "age_group", "sex", F.col(risk).cast("double").alias("r"))
    g_as = (F.lit(100) + F.col("age_group") * 2 + F.col("sex")).cast("long")
    g_a = (F.lit(200) + F.col("age_group")).cast("long")
    g_all = F.lit(300).cast("long")
    cnt = cut_lineage(base.select(F.explode(F.array(g_as, g_a, g_all)).alias("_g"), "r").groupBy("_g", "r").agg(
        F.count(F.lit(1)).alias("_c")))
    # One double leads the rows to buckets; inside a bucket the exact pair orders them.
    cum = cut_lineage(ordering.running_sum(cnt, [F.col("_g"), F.col("r")], ["_c"], lead=F.col("_g") * 2 + F.col("r")))
    grp = cum.groupBy("_g").agg(F.min(F.col("cum__c") - F.col("_c")).alias("_start"), F.sum("_c").alias("_n"),
                                (F.sum(F.col("_c") * F.col("r")) / F.sum("_c")).alias("_mean"))
    within = cum.join(F.broadcast(grp), "_g").select(
        "_g", "r", "_c", "_n", "_mean", (F.col("cum__c") - F.col("_start")).alias("_cum"))
    med = ordering.quantiles_from_cumulative(within, ["_g"], "r", "_c", "_cum", "_n", [0.5], ["_median"])
    stats = within.join(F.broadcast(med), "_g").select(
        "_g", "r", (F.col("_cum") - F.col("_c")).alias("_below"), "_n", "_mean", "_median")
    # One row per group: (age, sex), age and everyone, some tens in all.
    sizes = grp.select("_g", F.col("_n").alias("_size"))
    x = base.withColumns({"_g_as": g_as, "_g_a": g_a})
    x = x.join(F.broadcast(sizes.select(F.col("_g").alias("_g_as"), F.col("_size").alias("_n_as"))), "_g_as", "left")
    x = x.join(F.broadcast(sizes.select(F.col("_g").alias("_g_a"), F.col("_size").alias("_n_a"))), "_g_a", "left")
    grain = F.when(F.col("_n_as") >= S.MIN_PEERS, F.lit("age_sex")).when(F.col("_n_a") >= S.MIN_PEERS, F.lit("age")).otherwise(F.lit("all"))
    x = x.withColumn("grain", grain).withColumn(
        "_g", F.when(F.col("grain") == "age_sex", F.col("_g_as")).when(F.col("grain") == "age", F.col("_g_a")).otherwise(g_all))
    out = x.join(stats, ["_g", "r"])
    return out.select("respondent_id", "grain", (F.col("_below") / F.col("_n") * 100).alias("percentile_pct"),
                      F.round("_mean", 12).alias("peers_mean"), F.round("_median", 12).alias("peers_median"),
                      F.col("_n").cast("long").alias("peers_n"), F.col("r").alias("risk"))


def vs_peers(p: Column, peers_mean: Column) -> Column:
    gap = p - peers_mean
    return F.when(gap > S.PEER_DEAD_BAND, F.lit("supérieur")).when(gap < -S.PEER_DEAD_BAND, F.lit("inférieur")).otherwise(
        F.lit("comparable"))


def scorecard_variant(df: DataFrame, changes: dict, name: str) -> DataFrame:
    """Adds the scorecard risk of each row with some of its columns replaced (column -> Column)."""
    return df.withColumn(name, C.scorecard_risk(changes))


def model_variant(model) -> Callable[[DataFrame, dict, str], DataFrame]:
    """The same for a fitted pipeline: the changed columns stand in while it scores, then the row's own return."""
    def variant(df: DataFrame, changes: dict, name: str) -> DataFrame:
        from . import models as MD
        own = {f"_own_{c}": F.col(c) for c in changes}
        x = df.withColumns(own) if own else df
        x = x.withColumns({c: v.cast(df.schema[c].dataType) for c, v in changes.items()}) if changes else x
        x = MD.score(model, x, name)
        return x.withColumns({c: F.col(f"_own_{c}") for c in changes}).drop(*own) if own else x
    return variant


def _changes(cond: str, changes: dict, df: DataFrame) -> dict:
    return {c: F.when(F.expr(cond), F.lit(v)).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, v in changes.items() if c in df.columns}


def scenarios(df: DataFrame, variant=scorecard_variant, risk: str = "risk") -> DataFrame:
    """For each row and each applicable scenario: new risk and delta, ranked by delta ascending.

    ``variant`` rescores rows with replaced columns (scorecard or fitted model).
    All scenarios of a row are scored next to each other and ranked inside the
    row before they are exploded, so nothing is shuffled.
    """
    x = df
    for i, (cond, _, changes) in enumerate(SCENARIOS):
        x = variant(x, _changes(cond, changes, df), f"_risk_{i}")
    found = F.array(*[F.struct((F.col(f"_risk_{i}") - F.col(risk)).alias("delta"), F.lit(i + 1).alias("scenario_id"),
                               F.lit(label).alias("scenario"), F.col(f"_risk_{i}").alias("risk_new"), F.expr(cond).alias("applies"))
                      for i, (cond, label, _) in enumerate(SCENARIOS)])
    ranked = F.array_sort(F.filter(found, lambda s: s["applies"]))
    out = x.select("respondent_id", F.col(risk).alias("risk_current"), F.posexplode(ranked).alias("_k", "s"))
    return out.select("respondent_id", "s.scenario_id", "s.scenario", "risk_current", "s.risk_new", "s.delta",
                      (F.col("_k") + 1).alias("rank"))


def scenario_all(df: DataFrame, variant=scorecard_variant, risk: str = "risk") -> DataFrame:
    """All applicable changes at once: attainable risk and the number of changed variables."""
    changed = {}
    for cond, _, changes in SCENARIOS:
        for c, v in changes.items():
            changed.setdefault(c, []).append((cond, v))
    new, n_changed = {}, F.lit(0)
    for c, opts in changed.items():
        n_changed = n_changed + F.coalesce(F.expr(" OR ".join(f"({o})" for o, _ in opts)), F.lit(False)).cast("int")
        value = F.col(c)
        for o, v in opts:  # later scenarios win, like successive dict updates
            value = F.when(F.expr(o), F.lit(v)).otherwise(value)
        new[c] = value.cast(df.schema[c].dataType)
    x = variant(df, new, "risk_all")
    any_rule = " OR ".join(f"({cond})" for cond, _, _ in SCENARIOS)
    return x.where(any_rule).select("respondent_id", "risk_all", n_changed.cast("long").alias("n_changes"))


def advice(df: DataFrame) -> DataFrame:
    """Ordered advice titles per row; the default message when no rule applies."""
    rules = F.array(*[F.struct(F.lit(i + 1).alias("priority"), F.lit(t).alias("title"), F.expr(c).alias("applies"))
                      for i, (c, t) in enumerate(ADVICE)])
    fired = F.filter(rules, lambda r: r["applies"])
    default = F.array(F.struct(F.lit(0).alias("priority"), F.lit(ADVICE_DEFAULT).alias("title"), F.lit(True).alias("applies")))
    x = df.select("respondent_id", F.when(F.size(fired) == 0, default).otherwise(fired).alias("a"))
    return x.select("respondent_id", F.explode("a").alias("r")).select("respondent_id", "r.priority", "r.title")


def linear_contributions(df: DataFrame, weights: dict, means: DataFrame) -> DataFrame:
    """Exact additive contributions of a linear score: w_j * (x_j - mean_j), long format (id, variable, value)."""
    x = df.crossJoin(F.broadcast(means))
    stack = ", ".join(f"'{c}', CAST({w} * (CAST(`{c}` AS DOUBLE) - `m_{c}`) AS DOUBLE)" for c, w in weights.items())
    return x.selectExpr("respondent_id", f"stack({len(weights)}, {stack}) AS (variable, value)")


def top_contributions(df: DataFrame, weights: dict, means: DataFrame, k: int) -> DataFrame:
    """Each row's k largest contributions by absolute value (then by name; nulls last), ranked inside the row: no shuffle."""
    x = df.crossJoin(F.broadcast(means))
    each = [F.struct(v.isNull().alias("none"), (-F.abs(v)).alias("order"), F.lit(c).alias("variable"), v.alias("value"))
            for c, w in weights.items() for v in [(F.lit(w) * (F.col(c).cast("double") - F.col(f"m_{c}"))).cast("double")]]
    top = F.slice(F.array_sort(F.array(*each)), 1, k)
    return x.select("respondent_id", F.posexplode(top).alias("_k", "s")).select(
        "respondent_id", "s.variable", "s.value", (F.col("_k") + 1).alias("rank"))
