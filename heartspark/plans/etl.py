"""Queries of the ETL stage: projections, derived columns, row id."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..operators import transform as TR
from ..sources import fixture
from ..sources.tables import survey_base as analytical_base
from .common import Registry
from .sqlbase import ctes

R = Registry()
q = R.add

_ALL31 = ", ".join(S.ANALYTICAL_COLUMNS)


@q("prj_transform_all", ctes() + f"SELECT {_ALL31} FROM base")
def prj_transform_all(spark, sf):
    """Whole ETL chain from the raw file shape: rename, type, derive, flag, dense id."""
    return TR.transform_all(fixture.raw_survey(spark, sf))


@q("prj_row_id", ctes() + "SELECT respondent_id, CAST(bmi AS DOUBLE) AS bmi, age_group FROM base")
def prj_row_id(spark, sf):
    """Dense 1..n id in file order over the raw file shape."""
    raw = TR.rename(fixture.raw_survey(spark, sf))
    return TR.dense_row_id(raw).select("respondent_id", "bmi", F.col("age_group").cast("long"))


@q("prj_rename", ctes() + "SELECT " + ", ".join(S.SOURCE_COLUMNS) + " FROM typed")
def prj_rename(spark, sf):
    raw = fixture.raw_survey(spark, sf)
    return TR.cast_types(TR.rename(raw)).select(*S.SOURCE_COLUMNS)


@q("prj_types", ctes() + "SELECT respondent_id, " + ", ".join(S.SOURCE_COLUMNS) + " FROM typed")
def prj_types(spark, sf):
    return TR.cast_types(fixture.respondents(spark, sf)).select("respondent_id", *S.SOURCE_COLUMNS)


@q("prj_bmi_class", ctes() + "SELECT respondent_id, bmi, bmi_class FROM base")
def prj_bmi_class(spark, sf):
    return analytical_base(spark, sf).select("respondent_id", "bmi", "bmi_class")


@q("prj_unhealthy_days", ctes() + "SELECT respondent_id, ment_hlth_days, phys_hlth_days, total_unhealthy_days FROM base")
def prj_unhealthy_days(spark, sf):
    return analytical_base(spark, sf).select("respondent_id", "ment_hlth_days", "phys_hlth_days", "total_unhealthy_days")


@q("prj_risk_factors", ctes() + "SELECT respondent_id, risk_factor_count FROM base")
def prj_risk_factors(spark, sf):
    return analytical_base(spark, sf).select("respondent_id", "risk_factor_count")


@q("prj_healthy_habits", ctes() + "SELECT respondent_id, healthy_habits_count FROM base")
def prj_healthy_habits(spark, sf):
    return analytical_base(spark, sf).select("respondent_id", "healthy_habits_count")


@q("prj_care_access", ctes() + "SELECT respondent_id, has_care_access FROM base")
def prj_care_access(spark, sf):
    return analytical_base(spark, sf).select("respondent_id", "has_care_access")


@q("prj_flag_bmi", ctes() + "SELECT respondent_id, flag_bmi_extreme FROM base")
def prj_flag_bmi(spark, sf):
    return analytical_base(spark, sf).select("respondent_id", "flag_bmi_extreme")


@q("prj_flag_incoherent", ctes() + "SELECT respondent_id, flag_sante_incoherente FROM base")
def prj_flag_incoherent(spark, sf):
    return analytical_base(spark, sf).select("respondent_id", "flag_sante_incoherente")


@q("prj_features", ctes() + "SELECT respondent_id, " + ", ".join(S.FEATURES) + ", heart_disease FROM base")
def prj_features(spark, sf):
    """Model feature projection in model order (scan_pruned: only these columns are read)."""
    return analytical_base(spark, sf).select("respondent_id", *S.FEATURES, S.TARGET)


@q("prj_status_label", ctes() + f"SELECT respondent_id, CASE WHEN heart_disease = 1 THEN '{S.STATUS_SICK}' "
   f"ELSE '{S.STATUS_HEALTHY}' END AS statut_cardiaque FROM base")
def prj_status_label(spark, sf):
    return analytical_base(spark, sf).select("respondent_id", C.status_label().alias("statut_cardiaque"))


@q("prj_bmi_bin2", ctes() + "SELECT respondent_id, CAST(FLOOR(bmi / 2) * 2 AS DOUBLE) AS bmi_bin FROM base")
def prj_bmi_bin2(spark, sf):
    return analytical_base(spark, sf).select("respondent_id", C.bmi_bin2().alias("bmi_bin"))


_DECODE_SQL = (
    "SELECT respondent_id, "
    + f"{C.case_sql(S.LABELS_AGE, 'age_group')} AS age_label, "
    + f"{C.case_sql(S.LABELS_EDUCATION, 'education')} AS education_label, "
    + f"{C.case_sql(S.LABELS_INCOME, 'income')} AS income_label, "
    + f"{C.case_sql(S.LABELS_GENHLTH, 'gen_hlth')} AS health_label, "
    + f"{C.case_sql(S.LABELS_DIABETES, 'diabetes')} AS diabetes_label, "
    + f"{C.case_sql(S.LABELS_SEX, 'sex')} AS sex_label, "
    + "CASE WHEN high_bp = 1 THEN 'Oui' WHEN high_bp = 0 THEN 'Non' END AS high_bp_label FROM base"
)


@q("prj_decode", ctes() + _DECODE_SQL)
def prj_decode(spark, sf):
    """Code -> label with literal maps (fixed codebooks, no join)."""
    b = analytical_base(spark, sf)
    return b.select(
        "respondent_id",
        C.map_lookup(S.LABELS_AGE, "age_group").alias("age_label"),
        C.map_lookup(S.LABELS_EDUCATION, "education").alias("education_label"),
        C.map_lookup(S.LABELS_INCOME, "income").alias("income_label"),
        C.map_lookup(S.LABELS_GENHLTH, "gen_hlth").alias("health_label"),
        C.map_lookup(S.LABELS_DIABETES, "diabetes").alias("diabetes_label"),
        C.map_lookup(S.LABELS_SEX, "sex").alias("sex_label"),
        C.map_lookup({0: "Non", 1: "Oui"}, "high_bp").alias("high_bp_label"),
    )


_ZCOLS = ["bmi", "ment_hlth_days", "phys_hlth_days", "age_group", "gen_hlth",
          "income", "education", "risk_factor_count", "high_bp", "smoker"]


@q("prj_zscore", ctes("st AS (SELECT " + ", ".join(
    f"AVG({c}) AS m_{c}, STDDEV_SAMP({c}) AS s_{c}" for c in _ZCOLS) + " FROM base)")
   + "SELECT respondent_id, " + ", ".join(f"ROUND(({c} - m_{c}) / s_{c}, 9) AS z_{c}" for c in _ZCOLS)
   + " FROM base CROSS JOIN st")
def prj_zscore(spark, sf):
    """(x - mean) / std (ddof=1) on 10 columns; one-row stats broadcast to every row."""
    b = analytical_base(spark, sf)
    st = b.agg(*[F.avg(c).alias(f"m_{c}") for c in _ZCOLS], *[F.stddev_samp(c).alias(f"s_{c}") for c in _ZCOLS])
    j = b.crossJoin(F.broadcast(st))
    return j.select("respondent_id", *[F.round((F.col(c) - F.col(f"m_{c}")) / F.col(f"s_{c}"), 9).alias(f"z_{c}") for c in _ZCOLS])
