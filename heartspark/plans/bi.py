"""Report measures and the six report pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..operators import measures as M
from ..sources.tables import report_fact as fact
from .common import Registry
from .sqlbase import dim_values, with_fact

R = Registry()
q = R.add

RATE = "CAST(SUM({c}) AS DOUBLE) / NULLIF(COUNT(*), 0)"
SQL_MEASURES = {
    "nb_repondants": "CAST(COUNT(*) AS BIGINT)",
    "taux_maladie": RATE.format(c="heart_disease"),
    "imc_moyen": "AVG(bmi)",
    "facteurs_risque_moyens": "AVG(risk_factor_count)",
    "jours_malaise_moyens": "AVG(total_unhealthy_days)",
    "taux_hypertension": RATE.format(c="high_bp"),
    "taux_fumeurs": RATE.format(c="smoker"),
    "taux_activite": RATE.format(c="phys_activity"),
    "taux_fruits": RATE.format(c="fruits"),
    "taux_legumes": RATE.format(c="veggies"),
    "taux_acces_soins": RATE.format(c="has_care_access"),
}


def _m_sql(names):
    return ", ".join(f"{SQL_MEASURES[n]} AS {n}" for n in names)


def _card(name, measure_names):
    sql = with_fact() + f"SELECT {_m_sql(measure_names)} FROM fact"

    def run(spark, sf, _n=measure_names):
        return M.cards(fact(spark, sf), _n)
    q(name, sql)(run)


_card("kpi_count", ["nb_repondants"])
_card("kpi_disease_rate", ["taux_maladie"])
_card("kpi_bmi_avg", ["imc_moyen"])
_card("kpi_risk_factors_avg", ["facteurs_risque_moyens"])
_card("kpi_unhealthy_avg", ["jours_malaise_moyens"])
_card("kpi_hypertension", ["taux_hypertension"])
_card("kpi_smokers", ["taux_fumeurs"])
_card("kpi_activity", ["taux_activite"])
_card("kpi_fruits", ["taux_fruits"])
_card("kpi_veggies", ["taux_legumes"])
_card("kpi_care", ["taux_acces_soins"])
_card("bi_p1_cards", ["nb_repondants", "taux_maladie", "imc_moyen", "facteurs_risque_moyens"])
_card("bi_p6_cards", ["taux_fumeurs", "taux_activite", "taux_fruits", "taux_legumes", "taux_acces_soins"])

_NAT = ("seg AS (SELECT age_key, " + RATE.format(c="heart_disease") + " AS taux_maladie FROM fact GROUP BY age_key), "
        "nat AS (SELECT " + RATE.format(c="heart_disease") + " AS taux_national FROM fact)")


@q("kpi_national", with_fact() + "SELECT " + RATE.format(c="heart_disease") + " AS taux_national FROM fact")
def kpi_national(spark, sf):
    """Rate with every filter removed (a one-row aggregate)."""
    return fact(spark, sf).agg(M.disease_rate().alias("taux_national"))


@q("kpi_gap", with_fact(_NAT) + "SELECT age_key, taux_maladie - taux_national AS ecart_national FROM seg CROSS JOIN nat")
def kpi_gap(spark, sf):
    """Segment (age) rate minus the national rate."""
    return M.versus_national(fact(spark, sf), "age_key").select("age_key", "ecart_national")


@q("kpi_overrisk", with_fact(_NAT) + "SELECT age_key, taux_maladie / NULLIF(taux_national, 0) AS sur_risque FROM seg CROSS JOIN nat")
def kpi_overrisk(spark, sf):
    """Segment (age) rate divided by the national rate."""
    return M.versus_national(fact(spark, sf), "age_key").select("age_key", "sur_risque")


def _by_dim(name, table, measure_names, where=None, where_sql=None):
    _, key, _, label, _ = S.DIM_BY_TABLE[table]
    w = f" WHERE {where_sql}" if where_sql else ""
    sql = with_fact() + (f"SELECT a.{key}, d.{label}, " + ", ".join(f"a.{n}" for n in measure_names)
                         + f" FROM (SELECT {key}, {_m_sql(measure_names)} FROM fact{w} GROUP BY {key}) a "
                         f"LEFT JOIN {dim_values(table)} d ON a.{key} = d.{key}")

    def run(spark, sf, _t=table, _n=measure_names, _w=where):
        f = fact(spark, sf)
        if _w is not None:
            f = f.where(_w)
        return M.by_dimension(spark, f, _t, _n)
    q(name, sql)(run)


_by_dim("bi_p1_rate_by_age", "dim_age", ["taux_maladie"])
_by_dim("bi_p2_rate_by_bmi", "dim_bmi_class", ["taux_maladie"])
_by_dim("bi_p3_rate_by_income", "dim_income", ["taux_maladie"])
_by_dim("bi_p3_rate_by_education", "dim_education", ["taux_maladie"])
_by_dim("bi_p4_rate_by_health", "dim_genhlth", ["taux_maladie"])
_by_dim("bi_p4_rate_by_diabetes", "dim_diabetes", ["taux_maladie"])
_by_dim("bi_p4_bmi_vs_rate", "dim_age", ["imc_moyen", "taux_maladie"])
_by_dim("bi_p5_count_by_age", "dim_age", ["nb_repondants"])
_by_dim("bi_p5_count_by_sex", "dim_sex", ["nb_repondants"])
_by_dim("bi_p5_count_by_income", "dim_income", ["nb_repondants"])
_by_dim("bi_p6_count_by_health", "dim_genhlth", ["nb_repondants"])
_by_dim("bi_p6_unhealthy_by_age", "dim_age", ["jours_malaise_moyens"])
# Page-3 slicer on sex (Femme): the filter sits below the aggregate and reaches the scan.
_by_dim("flt_slicer_sex", "dim_age", ["taux_maladie"], where="sex_key = 0", where_sql="sex_key = 0")

_STATUS_SQL = f"CASE WHEN heart_disease = 1 THEN '{S.STATUS_SICK}' ELSE '{S.STATUS_HEALTHY}' END"


@q("bi_p1_status_split", with_fact() + f"SELECT {_STATUS_SQL} AS statut_cardiaque, CAST(COUNT(*) AS BIGINT) AS nb_repondants "
   "FROM fact GROUP BY 1")
def bi_p1_status_split(spark, sf):
    return M.by_column(fact(spark, sf), C.status_label(), "statut_cardiaque", ["nb_repondants"])


@q("bi_p2_bp_by_status", with_fact() + f"SELECT {_STATUS_SQL} AS statut_cardiaque, {SQL_MEASURES['taux_hypertension']} "
   "AS taux_hypertension FROM fact GROUP BY 1")
def bi_p2_bp_by_status(spark, sf):
    return M.by_column(fact(spark, sf), C.status_label(), "statut_cardiaque", ["taux_hypertension"])


@q("bi_p2_rate_by_factors", with_fact() + f"SELECT risk_factor_count, {SQL_MEASURES['taux_maladie']} AS taux_maladie "
   "FROM fact GROUP BY 1")
def bi_p2_rate_by_factors(spark, sf):
    return M.by_column(fact(spark, sf), "risk_factor_count", "risk_factor_count", ["taux_maladie"])


@q("bi_p5_count_by_bmi_bin", with_fact() + "SELECT CAST(FLOOR(bmi / 2) * 2 AS DOUBLE) AS bmi_bin, "
   "CAST(COUNT(*) AS BIGINT) AS nb_repondants FROM fact GROUP BY 1")
def bi_p5_count_by_bmi_bin(spark, sf):
    return M.by_column(fact(spark, sf), C.bmi_bin2(), "bmi_bin", ["nb_repondants"])


@q("bi_p3_rate_by_age_sex", with_fact() + "SELECT a.age_key, d.tranche_age, a.sex_key, s.sexe, a.taux_maladie FROM "
   f"(SELECT age_key, sex_key, {SQL_MEASURES['taux_maladie']} AS taux_maladie FROM fact GROUP BY 1, 2) a "
   f"LEFT JOIN {dim_values('dim_age')} d ON a.age_key = d.age_key LEFT JOIN {dim_values('dim_sex')} s ON a.sex_key = s.sex_key")
def bi_p3_rate_by_age_sex(spark, sf):
    """Rate by age x sex (two grouping keys), labels attached after the aggregate."""
    from ..operators import star
    f = fact(spark, sf)
    agg = f.groupBy("age_key", "sex_key").agg(M.disease_rate().alias("taux_maladie"))
    agg = agg.join(F.broadcast(star.codebook_dim(spark, "dim_age")), "age_key", "left")
    agg = agg.join(F.broadcast(star.codebook_dim(spark, "dim_sex")), "sex_key", "left")
    return agg.select("age_key", "tranche_age", "sex_key", "sexe", "taux_maladie").orderBy("age_key", "sex_key")


@q("bi_p3_rate_by_age_sex_pivot", with_fact() + "SELECT a.age_key, d.tranche_age, a.Femme, a.Homme FROM (SELECT age_key, "
   "CAST(SUM(CASE WHEN sex_key = 0 THEN heart_disease END) AS DOUBLE) / NULLIF(COUNT(CASE WHEN sex_key = 0 THEN 1 END), 0) AS Femme, "
   "CAST(SUM(CASE WHEN sex_key = 1 THEN heart_disease END) AS DOUBLE) / NULLIF(COUNT(CASE WHEN sex_key = 1 THEN 1 END), 0) AS Homme "
   f"FROM fact GROUP BY age_key) a LEFT JOIN {dim_values('dim_age')} d ON a.age_key = d.age_key")
def bi_p3_rate_by_age_sex_pivot(spark, sf):
    """Rate by age with one column per sex label (pivot over the fixed sex codebook: no extra pass)."""
    from ..operators import star
    f = fact(spark, sf)
    sex_label = C.map_lookup(S.LABELS_SEX, "sex_key")
    p = f.withColumn("sexe", sex_label).groupBy("age_key").pivot("sexe", list(S.LABELS_SEX.values())).agg(
        M.disease_rate())
    return p.join(F.broadcast(star.codebook_dim(spark, "dim_age")), "age_key", "left").select(
        "age_key", "tranche_age", *S.LABELS_SEX.values())
