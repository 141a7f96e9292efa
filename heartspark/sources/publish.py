"""Publishing several tables as one: all of them change together, or none does.

Tables of a version are written beside the older ones, and one line in the manifest, written last by a
commit that moves a single file, makes the version the current one. A driver or executor lost on the way leaves files
that no manifest line names, and readers on the version before. Older versions stay readable by name.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "seq long, version string, tables array<string>"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """(seq, version, tables) of all published versions; none where nothing has been published."""
    try:
        return spark.read.schema(MANIFEST).json(f"{root}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], small: frozenset[str] = frozenset()) -> str:
    """Writes all tables as Parquet and CSV under a new version, then names it in the manifest; the version's name.
    ``small``: tables that go into one file."""
    last = versions(spark, root).agg(F.max("seq")).first()[0]
    seq = 0 if last is None else last + 1
    version = f"{seq:08d}-{uuid.uuid4().hex}"
    for name, df in tables.items():
        path = f"{root}/versions/{version}"
        (df.coalesce(1) if name in small else df).write.parquet(f"{path}/parquet/{name}")
        back = spark.read.parquet(f"{path}/parquet/{name}")  # the CSV says what was stored, and the table is computed once
        (back.coalesce(1) if name in small else back).write.option("header", True).csv(f"{path}/csv/{name}")
    spark.createDataFrame([(seq, version, list(tables))], MANIFEST).coalesce(1).write.mode("append").json(f"{root}/manifest")
    return version


def current(spark: SparkSession, root: str) -> tuple[str, list[str]] | None:
    """The version in force and its tables: of two with one number (two publishers at once) the one whose name is greater."""
    row = versions(spark, root).orderBy(F.desc("seq"), F.desc("version")).first()
    return None if row is None else (row["version"], row["tables"])


def read(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """A table of the version in force, or of a given one."""
    version = version or current(spark, root)[0]
    return spark.read.parquet(f"{root}/versions/{version}/parquet/{name}")
