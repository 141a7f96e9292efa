"""Respondent fixture: one survey respondent per order.

The published survey file is not available, so respondents are derived from the
``orders`` table by integer arithmetic only (the test-data contract). The same
expressions are emitted as Spark ``selectExpr`` stages and as SQL text for the
DuckDB oracle, so both engines read one definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S

# Stage 1: seed and key noise per order.
_SEEDED = [
    "CAST(o_orderkey AS BIGINT) + 1 AS respondent_id",
    "CAST(CASE WHEN o_orderkey % 4 = 0 THEN o_custkey % 60 "
    "ELSE o_orderkey * 131 + o_custkey END AS BIGINT) AS s",
    "CAST(o_orderkey * 7919 AS BIGINT) % 1009 AS noise",
]
# Stage 2: latent frailty f in 0..99.
_LAT = ["*", "(s * 7919 + 17) % 1000003 % 100 AS f"]
# Stage 3: the 21 answers.
_SRC = [
    "respondent_id", "noise", "f",
    "CASE WHEN 2 * ((s * 15485 + 3) % 1000003 % 100) < 40 + f THEN 1 ELSE 0 END AS high_bp",
    "CASE WHEN 2 * ((s * 32452 + 5) % 1000003 % 100) < 40 + f THEN 1 ELSE 0 END AS high_chol",
    "CASE WHEN (s * 49979 + 7) % 1000003 % 100 < 96 THEN 1 ELSE 0 END AS chol_check",
    "CASE WHEN (s * 67867 + 11) % 1000003 % 97 = 0 THEN 70 "
    "WHEN (s * 67867 + 11) % 1000003 % 89 = 0 THEN 13 "
    "ELSE 18 + (s * 67867 + 11) % 1000003 % 23 END AS bmi",
    "CASE WHEN (s * 86028 + 13) % 1000003 % 100 < 44 THEN 1 ELSE 0 END AS smoker",
    "CASE WHEN 10 * ((s * 10428 + 19) % 1000003 % 100) < f THEN 1 ELSE 0 END AS stroke",
    "CASE WHEN 5 * ((s * 12214 + 23) % 1000003 % 100) < f THEN 2 "
    "WHEN (s * 12214 + 23) % 1000003 % 100 < 22 THEN 1 ELSE 0 END AS diabetes",
    "CASE WHEN (s * 14107 + 29) % 1000003 % 100 < 76 THEN 1 ELSE 0 END AS phys_activity",
    "CASE WHEN (s * 15485 + 31) % 1000003 % 100 < 63 THEN 1 ELSE 0 END AS fruits",
    "CASE WHEN (s * 17624 + 37) % 1000003 % 100 < 81 THEN 1 ELSE 0 END AS veggies",
    "CASE WHEN (s * 19491 + 41) % 1000003 % 100 < 6 THEN 1 ELSE 0 END AS hvy_alcohol",
    "CASE WHEN (s * 21438 + 43) % 1000003 % 100 < 95 THEN 1 ELSE 0 END AS any_healthcare",
    "CASE WHEN (s * 23187 + 47) % 1000003 % 100 < 8 THEN 1 ELSE 0 END AS no_doc_cost",
    "CASE WHEN f >= 90 THEN 5 WHEN f >= 75 THEN 4 WHEN f >= 45 THEN 3 WHEN f >= 18 THEN 2 ELSE 1 END AS gen_hlth",
    "CASE WHEN (s * 25015 + 53) % 1000003 % 10 < 7 THEN 0 "
    "WHEN (s * 25015 + 53) % 1000003 % 10 = 9 THEN 30 "
    "ELSE (s * 27031 + 59) % 1000003 % 30 END AS ment_hlth_days",
    "CASE WHEN (s * 28803 + 61) % 1000003 % 100 >= f THEN 0 "
    "WHEN f >= 92 THEN 30 "
    "ELSE (s * 30803 + 67) % 1000003 % 30 END AS phys_hlth_days",
    "CASE WHEN 3 * ((s * 32416 + 71) % 1000003 % 100) < f THEN 1 ELSE 0 END AS diff_walk",
    "(s * 34591 + 73) % 1000003 % 2 AS sex",
    "1 + (s * 36523 + 79) % 1000003 % 13 AS age_group",
    "1 + (s * 38459 + 83) % 1000003 % 6 AS education",
    "1 + (s * 40609 + 89) % 1000003 % 8 AS income",
]
# Stage 4: target and final column order (the 22 survey columns, snake_case).
_FINAL = [
    "respondent_id",
    "CASE WHEN noise % 100 < CASE WHEN f * age_group >= 700 THEN 40 "
    "WHEN f * age_group >= 350 THEN 15 ELSE 2 END THEN 1 ELSE 0 END AS heart_disease",
    "high_bp", "high_chol", "chol_check", "CAST(bmi AS DOUBLE) AS bmi", "smoker", "stroke",
    "diabetes", "phys_activity", "fruits", "veggies", "hvy_alcohol", "any_healthcare",
    "no_doc_cost", "gen_hlth", "ment_hlth_days", "phys_hlth_days", "diff_walk", "sex",
    "age_group", "education", "income",
]


def fixture_sql(orders: str = "orders") -> str:
    """The fixture as one SQL query over a relation named ``orders``."""
    return (
        "WITH seeded AS (SELECT " + ", ".join(_SEEDED) + f" FROM {orders}), "
        "lat AS (SELECT " + ", ".join(_LAT) + " FROM seeded), "
        "src AS (SELECT " + ", ".join(_SRC) + " FROM lat) "
        "SELECT " + ", ".join(_FINAL) + " FROM src"
    )


def respondents_from_orders(orders: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Respondents (22 survey columns + respondent_id) from an orders DataFrame.

    Narrow transformations only: no shuffle, pruned to two order columns
    (plus ``keep``, carried through unchanged).
    """
    k = list(keep)
    return (
        orders.select("o_orderkey", "o_custkey", *k)
        .selectExpr(*_SEEDED, *k)
        .selectExpr(*_LAT)
        .selectExpr(*_SRC, *k)
        .selectExpr(*_FINAL, *k)
    )


def respondents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture respondents read from ``{sf_dir}/orders.parquet`` (ids come from the order key)."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    return respondents_from_orders(orders)


def raw_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture shaped like the raw survey file: 22 CamelCase DOUBLE columns, file order.

    This is what the survey CSV reader returns, so the whole ETL chain
    (rename, typing, derivations, row id) runs on it unchanged.
    """
    back = {v: k for k, v in S.RENAME.items()}
    scan = spark.read.parquet(f"{sf_dir}/orders.parquet")
    scan = scan.select("*", F.col("_metadata.file_path").alias("_src_file"),
                       F.col("_metadata.file_block_start").alias("_src_block"))
    df = respondents_from_orders(scan, keep=("_src_file", "_src_block"))
    return df.select(*[df[c].cast("double").alias(back[c]) for c in S.SOURCE_COLUMNS],
                     "_src_file", "_src_block")
