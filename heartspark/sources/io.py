"""Readers and writers: survey CSV, warehouse exports, scored batches, reference files, models.

Paths are plain strings on shared storage (the cluster's checkpoint folder
in the registered queries). Dimension exports are coalesced to one file (at
most 14 rows each); the fact and scored tables keep their partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S

RAW_SCHEMA = T.StructType([T.StructField(c, T.DoubleType(), True) for c in S.RENAME])
PROFILE_SCHEMA = T.StructType([T.StructField(c, T.DoubleType(), True) for c in S.FEATURES])


class MissingColumns(ValueError):
    """A file lacks declared columns; ``names`` tells which."""

    def __init__(self, names: list[str], path: str):
        self.names = names
        super().__init__(f"missing column(s) {', '.join(names)} in {path}")


def read_csv_by_name(spark: SparkSession, path: str, declared: T.StructType, strict: bool = True) -> DataFrame:
    """CSV files whose header names the columns, in any order: declared columns typed and first, others kept as text.

    The first header gives the names; Spark holds every file's own header against
    them (``enforceSchema`` off), so files in different orders are an error, not a
    mix-up. A missing declared column is a ``MissingColumns`` error, or left out
    if not ``strict``, for checks that report it.
    """
    names = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    missing = [f.name for f in declared.fields if f.name not in names]
    if missing and strict:
        raise MissingColumns(missing, path)
    types = {f.name: f.dataType for f in declared.fields}
    found = T.StructType([T.StructField(n, types.get(n, T.StringType()), True) for n in names])
    df = spark.read.schema(found).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    first = [f.name for f in declared.fields if f.name in names]
    return df.select(*[F.col(f"`{c}`") for c in first + [n for n in names if n not in types]], F.col("_metadata"))


def read_survey_csv(spark: SparkSession, path: str, sample: int | None = None, strict: bool = True) -> DataFrame:
    """The raw survey file: 22 DOUBLE columns by name (no inference), header row, fail fast on a bad row.

    ``sample`` keeps the first n rows in file order (sample mode); a missing path fails in Spark's own analysis.
    """
    df = read_csv_by_name(spark, path, RAW_SCHEMA, strict)
    df = df.select(*[c for c in RAW_SCHEMA.names if c in df.columns], F.col("_metadata.file_path").alias("_src_file"),
                   F.col("_metadata.file_block_start").alias("_src_block"))
    if not sample:
        return df
    return (df.withColumn("_src_row", F.monotonically_increasing_id()).orderBy("_src_file", "_src_block", "_src_row")
            .limit(sample).drop("_src_row"))


def read_profiles_csv(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """A batch of profiles to score: the 21 model features by name, further columns kept after them as text."""
    return read_csv_by_name(spark, path, PROFILE_SCHEMA, strict).drop("_metadata")


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, single_file: bool = False) -> None:
    (df.coalesce(1) if single_file else df).write.mode("overwrite").parquet(path)


def load_analytical(df: DataFrame, path: str) -> int:
    """Replace the analytical table and return its row count read back."""
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path).count()


def export_star(dims: dict, fact: DataFrame, root: str) -> list[str]:
    """Every dimension and the fact to CSV (header) and Parquet; returns the table names written."""
    names = []
    for name, d in dims.items():
        write_csv(d, f"{root}/csv/{name}", single_file=True)
        write_parquet(d, f"{root}/parquet/{name}", single_file=True)
        names.append(name)
    # Computed once: the CSV files are written from the stored Parquet files.
    write_parquet(fact, f"{root}/parquet/fact_respondent")
    write_csv(fact.sparkSession.read.parquet(f"{root}/parquet/fact_respondent"), f"{root}/csv/fact_respondent")
    return names + ["fact_respondent"]


def write_json_doc(df: DataFrame, path: str) -> None:
    """A one-row nested document (structs, arrays, maps) as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_json_doc(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read.option("multiLine", False)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def inventory(spark: SparkSession, names: list[str]) -> DataFrame:
    """(table, rows, columns) of registered views: one count per table, unioned."""
    parts = []
    for n in names:
        t = spark.table(n)
        parts.append(t.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(n).alias("table_name"), "n_rows", F.lit(len(t.columns)).cast("long").alias("n_columns")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def columns_of(df: DataFrame) -> DataFrame:
    """(position, name, type) of a table's columns."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position long, column_name string, data_type string")
