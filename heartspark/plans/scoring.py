"""Scoring queries on the scorecard risk."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..operators import ordering
from ..operators import scoring as SC
from ..sources.tables import survey_base
from .common import Registry
from .sqlbase import ctes

R = Registry()
q = R.add
RISK_SQL = C.scorecard_risk_sql()
SC_CTE = f"sc AS (SELECT *, {RISK_SQL} AS risk FROM base)"
THR = S.DECISION_THRESHOLD


def _scored(spark, sf):
    return survey_base(spark, sf).withColumn("risk", C.scorecard_risk())


@q("sc_score", ctes(SC_CTE) + "SELECT respondent_id, risk FROM sc")
def sc_score(spark, sf):
    """Risk per row (the deterministic scorecard stands in for the model so the result is exact)."""
    return _scored(spark, sf).select("respondent_id", "risk")


@q("prj_flagged", ctes(SC_CTE) + f"SELECT respondent_id, CAST(risk >= {THR} AS BIGINT) AS signale FROM sc")
def prj_flagged(spark, sf):
    return _scored(spark, sf).select("respondent_id", (F.col("risk") >= THR).cast("int").alias("signale"))


@q("prj_risk_band", ctes(SC_CTE) + f"SELECT respondent_id, CAST({C.risk_band_sql('risk')} AS BIGINT) AS band FROM sc")
def prj_risk_band(spark, sf):
    """Right-closed bands; a risk of exactly 0 gets no band."""
    return _scored(spark, sf).select("respondent_id", C.risk_band("risk").alias("band"))


@q("prj_risk_level", ctes(SC_CTE) + f"SELECT respondent_id, {C.risk_level_sql('risk')} AS niveau FROM sc")
def prj_risk_level(spark, sf):
    return _scored(spark, sf).select("respondent_id", C.risk_level("risk").alias("niveau"))


@q("prj_vs_reference", ctes(SC_CTE) + f"SELECT respondent_id, risk / {S.REFERENCE_PREVALENCE} AS ratio, "
   f"risk - {S.REFERENCE_PREVALENCE} AS ecart FROM sc")
def prj_vs_reference(spark, sf):
    return _scored(spark, sf).select("respondent_id", (F.col("risk") / S.REFERENCE_PREVALENCE).alias("ratio"),
                                     (F.col("risk") - S.REFERENCE_PREVALENCE).alias("ecart"))


@q("sc_batch_kpis", ctes(SC_CTE) + f"SELECT CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(*) FILTER (WHERE risk >= {THR}) AS BIGINT) AS flagged, "
   f"CAST(COUNT(*) FILTER (WHERE risk >= {THR}) AS DOUBLE) / COUNT(*) AS flagged_share, ROUND(AVG(risk), 12) AS mean_risk FROM sc")
def sc_batch_kpis(spark, sf):
    """Rows, flagged rows, flagged share, mean risk of a scored batch."""
    return SC.batch_kpis(_scored(spark, sf), "risk", THR)


_BANDS_SQL = "(SELECT * FROM (VALUES " + ", ".join(f"({i + 1}, '{lab}')" for i, lab in enumerate(S.RISK_BAND_LABELS)) + ") t(band, band_label))"


@q("sc_band_distribution", ctes(SC_CTE + f", c AS (SELECT {C.risk_band_sql('risk')} AS band, COUNT(*) AS n FROM sc GROUP BY 1)")
   + f"SELECT CAST(b.band AS BIGINT) AS band, b.band_label, CAST(COALESCE(c.n, 0) AS BIGINT) AS n FROM {_BANDS_SQL} b LEFT JOIN c ON b.band = c.band")
def sc_band_distribution(spark, sf):
    """Rows per risk band, all five bands listed."""
    return SC.band_distribution(_scored(spark, sf), "risk")


@q("sc_calibration_by_band", ctes(SC_CTE) + f"SELECT CAST({C.risk_band_sql('risk')} AS BIGINT) AS band, ROUND(AVG(risk) * 100, 10) AS mean_risk_pct, "
   f"AVG(CAST(heart_disease AS DOUBLE)) * 100 AS real_rate_pct FROM sc WHERE {C.risk_band_sql('risk')} IS NOT NULL GROUP BY 1")
def sc_calibration_by_band(spark, sf):
    """Mean estimated risk and real rate per non-empty band."""
    return SC.calibration_by_band(_scored(spark, sf), "risk")


@q("sc_risk_by_age", ctes(SC_CTE) + "SELECT age_group, ROUND(AVG(risk) * 100, 10) AS mean_risk_pct FROM sc GROUP BY 1")
def sc_risk_by_age(spark, sf):
    return _scored(spark, sf).groupBy("age_group").agg(F.round(F.avg("risk") * 100, 10).alias("mean_risk_pct"))


@q("sc_risk_by_sex", ctes(SC_CTE) + "SELECT sex, ROUND(AVG(risk) * 100, 10) AS mean_risk_pct FROM sc GROUP BY 1")
def sc_risk_by_sex(spark, sf):
    return _scored(spark, sf).groupBy("sex").agg(F.round(F.avg("risk") * 100, 10).alias("mean_risk_pct"))


def _top_sql(k):
    return ctes(SC_CTE) + f"SELECT respondent_id, risk, age_group, gen_hlth, high_bp FROM sc ORDER BY risk DESC, respondent_id LIMIT {k}"


@q("top_risk_10", _top_sql(10))
def top_risk_10(spark, sf):
    """nlargest(10, risk); ties keep the first row (lowest id)."""
    return ordering.top_k(_scored(spark, sf).select("respondent_id", "risk", "age_group", "gen_hlth", "high_bp"), 10,
                          [F.desc("risk"), F.asc("respondent_id")])


@q("top_risk_8", _top_sql(8))
def top_risk_8(spark, sf):
    return ordering.top_k(_scored(spark, sf).select("respondent_id", "risk", "age_group", "gen_hlth", "high_bp"), 8,
                          [F.desc("risk"), F.asc("respondent_id")])


@q("sc_top_decoded", ctes(SC_CTE + ", t AS (SELECT * FROM sc ORDER BY risk DESC, respondent_id LIMIT 10)") +
   f"SELECT respondent_id, risk * 100 AS risk_pct, {C.case_sql(S.LABELS_AGE, 'age_group')} AS age, "
   f"{C.case_sql(S.LABELS_GENHLTH, 'gen_hlth')} AS sante, CASE WHEN high_bp = 1 THEN 'Oui' WHEN high_bp = 0 THEN 'Non' END AS hypertension FROM t")
def sc_top_decoded(spark, sf):
    """Top 10 risks decoded to labels (decoding after the limit)."""
    return SC.top_decoded(_scored(spark, sf), "risk", 10)


_POS_SQL = (
    "p AS (SELECT respondent_id, age_group, sex, risk, "
    "RANK() OVER (PARTITION BY age_group, sex ORDER BY risk) - 1 AS b_as, COUNT(*) OVER (PARTITION BY age_group, sex) AS n_as, "
    "ROUND(AVG(risk) OVER (PARTITION BY age_group, sex), 12) AS m_as, ROUND(MEDIAN(risk) OVER (PARTITION BY age_group, sex), 12) AS md_as, "
    "RANK() OVER (PARTITION BY age_group ORDER BY risk) - 1 AS b_a, COUNT(*) OVER (PARTITION BY age_group) AS n_a, "
    "ROUND(AVG(risk) OVER (PARTITION BY age_group), 12) AS m_a, ROUND(MEDIAN(risk) OVER (PARTITION BY age_group), 12) AS md_a, "
    "RANK() OVER (ORDER BY risk) - 1 AS b_all, COUNT(*) OVER () AS n_all, ROUND(AVG(risk) OVER (), 12) AS m_all, ROUND(MEDIAN(risk) OVER (), 12) AS md_all FROM sc), "
    f"g AS (SELECT *, CASE WHEN n_as >= {S.MIN_PEERS} THEN 'age_sex' WHEN n_a >= {S.MIN_PEERS} THEN 'age' ELSE 'all' END AS grain FROM p)"
)


def _pick(a, b, c):
    return f"CASE grain WHEN 'age_sex' THEN {a} WHEN 'age' THEN {b} ELSE {c} END"


@q("sc_position", ctes(SC_CTE + ", " + _POS_SQL) +
   f"SELECT respondent_id, grain, CAST({_pick('b_as', 'b_a', 'b_all')} AS DOUBLE) / {_pick('n_as', 'n_a', 'n_all')} * 100 AS percentile_pct, "
   f"{_pick('m_as', 'm_a', 'm_all')} AS peers_mean, {_pick('md_as', 'md_a', 'md_all')} AS peers_median, "
   f"CAST({_pick('n_as', 'n_a', 'n_all')} AS BIGINT) AS peers_n, risk FROM g")
def sc_position(spark, sf):
    """Percentile (share of peers strictly lower), mean, median and count of each row's peers
    ((age, sex), falling back to age then everyone below 30 peers); also jn_peers and win_percentile_strict."""
    return SC.peer_position(_scored(spark, sf), "risk")


@q("prj_vs_peers", ctes(SC_CTE + ", m AS (SELECT age_group, sex, AVG(risk) AS pm FROM sc GROUP BY 1, 2)") +
   f"SELECT respondent_id, CASE WHEN risk - pm > {S.PEER_DEAD_BAND} THEN 'supérieur' WHEN risk - pm < -{S.PEER_DEAD_BAND} "
   "THEN 'inférieur' ELSE 'comparable' END AS comparatif FROM sc JOIN m USING (age_group, sex)")
def prj_vs_peers(spark, sf):
    """Above / below / comparable to the (age, sex) peer mean, with a 0.005 dead band."""
    s = _scored(spark, sf)
    m = s.groupBy("age_group", "sex").agg(F.avg("risk").alias("pm"))
    j = s.join(F.broadcast(m), ["age_group", "sex"])
    return j.select("respondent_id", SC.vs_peers(F.col("risk"), F.col("pm")).alias("comparatif"))


def _scenario_sql():
    pts = S.SCORECARD_POINTS
    parts = []
    for i, (cond, label, changes) in enumerate(SC.SCENARIOS):
        def v(c):
            return str(changes[c]) if c in changes else c
        p = " + ".join(f"{w} * CAST({v(c)} AS BIGINT)" for c, w in pts.items())
        lab = label.replace("'", "''")
        cond_sql = cond.replace("==", "=")
        parts.append(f"SELECT respondent_id, {i + 1} AS scenario_id, '{lab}' AS scenario, risk AS risk_current, "
                     f"CAST(({p}) * ({p}) AS DOUBLE) / {S.SCORECARD_DIVISOR} AS risk_new FROM sc WHERE {cond_sql}")
    return ctes(SC_CTE + ", x AS (" + " UNION ALL ".join(parts) + ")") + \
        ("SELECT respondent_id, CAST(scenario_id AS BIGINT) AS scenario_id, scenario, risk_current, risk_new, risk_new - risk_current AS delta, "
         "CAST(ROW_NUMBER() OVER (PARTITION BY respondent_id ORDER BY risk_new - risk_current, scenario_id) AS BIGINT) AS rank FROM x")


@q("sc_scenarios", _scenario_sql())
def sc_scenarios(spark, sf):
    """Each row x each applicable what-if scenario: rescored risk and delta, ranked ascending (also jn_scenarios)."""
    return SC.scenarios(_scored(spark, sf), SC.scorecard_variant, "risk")


def _scenario_all_sql():
    pts = S.SCORECARD_POINTS
    changed = {}
    for cond, _, changes in SC.SCENARIOS:
        for c, v in changes.items():
            changed.setdefault(c, []).append((cond.replace("==", "="), v))

    def newval(c):
        if c not in changed:
            return c
        return "CASE " + " ".join(f"WHEN {o} THEN {v}" for o, v in reversed(changed[c])) + f" ELSE {c} END"
    p = " + ".join(f"{w} * CAST({newval(c)} AS BIGINT)" for c, w in pts.items())
    n = " + ".join("CASE WHEN " + " OR ".join(f"({o})" for o, _ in opts) + " THEN 1 ELSE 0 END" for c, opts in changed.items())
    anyc = " OR ".join(f"({c.replace('==', '=')})" for c, _, _ in SC.SCENARIOS)
    return ctes(SC_CTE) + f"SELECT respondent_id, CAST(({p}) * ({p}) AS DOUBLE) / {S.SCORECARD_DIVISOR} AS risk_all, " \
                          f"CAST({n} AS BIGINT) AS n_changes FROM sc WHERE {anyc}"


@q("sc_scenario_all", _scenario_all_sql())
def sc_scenario_all(spark, sf):
    """All applicable changes together: attainable risk and number of changed variables."""
    return SC.scenario_all(_scored(spark, sf), SC.scorecard_variant, "risk")


def _advice_sql():
    parts = []
    for i, (cond, title) in enumerate(SC.ADVICE):
        t = title.replace("'", "''")
        parts.append(f"SELECT respondent_id, {i + 1} AS priority, '{t}' AS title FROM base WHERE {cond.replace('==', '=')}")
    anyc = " OR ".join(f"({c.replace('==', '=')})" for c, _ in SC.ADVICE)
    parts.append(f"SELECT respondent_id, 0, '{SC.ADVICE_DEFAULT}' FROM base WHERE NOT ({anyc})")
    return ctes() + "SELECT respondent_id, CAST(priority AS BIGINT) AS priority, title FROM (" + " UNION ALL ".join(parts) + ") a"


@q("sc_advice", _advice_sql())
def sc_advice(spark, sf):
    """Ordered advice per row (9 rules), the default message when none applies."""
    return SC.advice(survey_base(spark, sf))


_VARNAME_SQL = "(SELECT * FROM (VALUES " + ", ".join(
    "('{}', '{}')".format(k, v.replace("'", "''")) for k, v in S.VARIABLE_NAMES.items()) + ") t(variable, display_name))"


def _contrib_sql():
    pts = S.SCORECARD_POINTS
    means = ", ".join(f"AVG(CAST({c} AS DOUBLE)) AS m_{c}" for c in pts)
    parts = [f"SELECT respondent_id, '{c}' AS variable, CAST({w} * (CAST({c} AS DOUBLE) - m_{c}) AS DOUBLE) AS value FROM base CROSS JOIN mm"
             for c, w in pts.items()]
    return f"mm AS (SELECT {means} FROM base), ct AS (" + " UNION ALL ".join(parts) + ")"


def _contrib(spark, sf):
    b = survey_base(spark, sf)
    means = b.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in S.SCORECARD_POINTS])
    return SC.linear_contributions(b, S.SCORECARD_POINTS, means)


@q("ml_contrib", ctes(_contrib_sql()) + "SELECT respondent_id, variable, value FROM ct")
def ml_contrib(spark, sf):
    """Exact per-row contributions of a linear score: w_j (x_j - mean_j), long format."""
    return _contrib(spark, sf)


@q("ml_importance", ctes(_contrib_sql()) + "SELECT variable, ROUND(AVG(ABS(value)), 9) AS mean_abs, "
   "CAST(ROW_NUMBER() OVER (ORDER BY AVG(ABS(value)) DESC, variable) AS BIGINT) AS rank FROM ct GROUP BY variable")
def ml_importance(spark, sf):
    """Mean absolute contribution per variable, ranked (also top_importance)."""
    from pyspark.sql import Window
    g = _contrib(spark, sf).groupBy("variable").agg(F.avg(F.abs("value")).alias("_m"))
    w = Window.orderBy(F.desc("_m"), "variable")
    return g.select("variable", F.round("_m", 9).alias("mean_abs"), F.row_number().over(w).alias("rank"))


def _topc_sql(k):
    return ctes(_contrib_sql() + f", r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY respondent_id ORDER BY ABS(value) DESC, variable) AS rk FROM ct)") + \
        "SELECT respondent_id, variable, COALESCE(d.display_name, r.variable) AS display_name, " \
        "CASE WHEN value > 0 THEN value END AS increases, CASE WHEN value <= 0 THEN value END AS decreases, CAST(rk AS BIGINT) AS rank " \
        f"FROM r LEFT JOIN {_VARNAME_SQL} d USING (variable) WHERE rk <= {k}"


def _topc(spark, sf, k):
    b = survey_base(spark, sf)
    means = b.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in S.SCORECARD_POINTS])
    j = SC.top_contributions(b, S.SCORECARD_POINTS, means, k)
    return j.select("respondent_id", "variable", F.coalesce(C.map_lookup(S.VARIABLE_NAMES, "variable"), "variable").alias("display_name"),
                    F.when(F.col("value") > 0, F.col("value")).alias("increases"),
                    F.when(F.col("value") <= 0, F.col("value")).alias("decreases"), "rank")


@q("sc_contrib_split", _topc_sql(8))
def sc_contrib_split(spark, sf):
    """Top 8 contributions per row by absolute value, split into increasing / decreasing (also top_contrib_8)."""
    return _topc(spark, sf, 8)


@q("top_contrib_6", _topc_sql(6))
def top_contrib_6(spark, sf):
    return _topc(spark, sf, 6)


def _var_label_sql():
    cols = [c for c in S.ANALYTICAL_COLUMNS if c != "flag_profil_duplique"]
    long = " UNION ALL ".join(f"SELECT '{c}' AS variable FROM base" for c in cols)
    return ctes(f"l AS ({long})") + f"SELECT DISTINCT l.variable, COALESCE(d.display_name, l.variable) AS display_name FROM l LEFT JOIN {_VARNAME_SQL} d USING (variable)"


@q("prj_var_label", _var_label_sql())
def prj_var_label(spark, sf):
    """Display name of every variable present in the table; unknown names show as themselves."""
    from ..operators.stats import unpivot
    b = survey_base(spark, sf)
    cols = [c for c in S.ANALYTICAL_COLUMNS if c != "flag_profil_duplique"]
    v = unpivot(b, cols).select(F.col("column_name").alias("variable")).distinct()
    names = spark.createDataFrame(list(S.VARIABLE_NAMES.items()), "variable string, display_name string")
    return v.join(F.broadcast(names), "variable", "left").select("variable", F.coalesce("display_name", "variable").alias("display_name"))
