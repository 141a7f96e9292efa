"""Readers for the driver's tables and the analytical base built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import transform as TR
from . import fixture


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def analytical_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """31-column analytical table of the respondent fixture (lazy plan)."""
    return TR.transform_all(fixture.respondents(spark, sf_dir), id_col="respondent_id")


def survey_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analytical table without the duplicate flag: narrow steps only, no shuffle."""
    return TR.transform_all(fixture.respondents(spark, sf_dir), id_col="respondent_id", dup_flag=False)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published 31-column fact (dimension joins, duplicate flag)."""
    from ..operators import star
    return star.build_fact(spark, analytical_base(spark, sf_dir))


def report_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows for report measures: keys by codebook membership, no duplicate flag.

    Same keys as the published fact; every step is a projection, so a report
    reading two columns scans two source columns.
    """
    from ..operators import star
    return star.build_fact(spark, survey_base(spark, sf_dir), via="codebook")
