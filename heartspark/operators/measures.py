"""Report measures (count, rates, averages) and the report visuals built on them.

A measure is a Column aggregate, so any visual is ``groupBy(axis).agg(measures)``
over the star: partial aggregation on the map side, a tiny shuffle of at most
(axis cardinality x partitions) rows, labels attached by broadcast after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from . import star


def n_respondents() -> Column:
    return F.count(F.lit(1))


def rate_of(col: str) -> Column:
    """SUM(col) / COUNTROWS, blank when there are no rows."""
    return C.safe_rate(F.sum(col), F.count(F.lit(1)))


def disease_rate() -> Column:
    return rate_of(S.TARGET)


MEASURES = {
    "nb_repondants": lambda: n_respondents(),
    "taux_maladie": disease_rate,
    "imc_moyen": lambda: F.avg("bmi"),
    "facteurs_risque_moyens": lambda: F.avg("risk_factor_count"),
    "jours_malaise_moyens": lambda: F.avg("total_unhealthy_days"),
    "taux_hypertension": lambda: rate_of("high_bp"),
    "taux_fumeurs": lambda: rate_of("smoker"),
    "taux_activite": lambda: rate_of("phys_activity"),
    "taux_fruits": lambda: rate_of("fruits"),
    "taux_legumes": lambda: rate_of("veggies"),
    "taux_acces_soins": lambda: rate_of("has_care_access"),
}


def cards(fact: DataFrame, names: list[str]) -> DataFrame:
    return fact.agg(*[MEASURES[n]().alias(n) for n in names])


def by_dimension(spark: SparkSession, fact: DataFrame, table: str, names: list[str]) -> DataFrame:
    """Measures per dimension member: aggregate on the key, then attach the label."""
    _, key, _, label, _ = S.DIM_BY_TABLE[table]
    agg = fact.groupBy(key).agg(*[MEASURES[n]().alias(n) for n in names])
    dim = F.broadcast(star.codebook_dim(spark, table))
    return agg.join(dim, key, "left").select(key, label, *names).orderBy(key)


def by_column(fact: DataFrame, col: Column | str, alias: str, names: list[str]) -> DataFrame:
    c = F.col(col) if isinstance(col, str) else col
    return fact.groupBy(c.alias(alias)).agg(*[MEASURES[n]().alias(n) for n in names]).orderBy(alias)


def versus_national(fact: DataFrame, axis: str) -> DataFrame:
    """Segment rate, national rate (all filters removed), gap and over-risk per axis value.

    The national rate is a one-row aggregate cross-joined by broadcast.
    """
    seg = fact.groupBy(axis).agg(disease_rate().alias("taux_maladie"))
    nat = fact.agg(disease_rate().alias("taux_national"))
    j = seg.crossJoin(F.broadcast(nat))
    return j.select(
        axis, "taux_maladie", "taux_national",
        (F.col("taux_maladie") - F.col("taux_national")).alias("ecart_national"),
        F.try_divide(F.col("taux_maladie"), F.col("taux_national")).alias("sur_risque"),
    )
