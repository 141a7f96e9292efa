"""Deterministic sampling: stratified split, folds, fixed-size samples.

Every choice is a pure function of (id, seed): an arithmetic hash orders the
rows, so the same rows are chosen on any cluster size, after any retry, and by
the SQL oracle. Per-class ranks come from one bucketed global rank on the
composite key ``class * 2^31 + hash`` (classes occupy disjoint key ranges), so
no window is ever partitioned by the 2-valued class column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from . import ordering
from .duplicates import arith_hash, arith_hash_sql

_SPAN = 2147483648  # 2^31 > every hash value


def rank_in_class(df: DataFrame, seed: int, cls: str = S.TARGET, id_col: str = "respondent_id",
                  name: str = "class_rank") -> DataFrame:
    """1-based rank of each row inside its class, ordered by (hash(id, seed), id)."""
    h = arith_hash(id_col, seed)
    x = df.withColumn("_h", h).withColumn("_key", F.col(cls).cast("long") * F.lit(_SPAN) + F.col("_h"))
    r = ordering.global_rank(x, [F.col("_key"), F.col(id_col)], "_grank")
    counts = df.groupBy(cls).agg(F.count(F.lit(1)).alias("_nc"))
    from pyspark.sql import Window
    w = Window.orderBy(cls).rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(cls, "_nc", F.coalesce(F.sum("_nc").over(w), F.lit(0)).alias("_coff"))
    out = r.join(F.broadcast(offs), cls)
    return out.withColumn(name, F.col("_grank") - F.col("_coff")).drop("_h", "_key", "_grank", "_coff")


def stratified_split(df: DataFrame, test_pct: int = int(S.TEST_SHARE * 100), seed: int = S.SEED,
                     cls: str = S.TARGET) -> DataFrame:
    """Adds ``split`` in {'train', 'test'}: the first ceil(test_pct % of n_c) rows of each class go to test."""
    r = rank_in_class(df, seed, cls)
    n_test = F.floor((F.col("_nc") * test_pct + 99) / 100)
    return r.withColumn("split", F.when(F.col("class_rank") <= n_test, F.lit("test")).otherwise(F.lit("train"))).drop(
        "_nc", "class_rank")


def stratified_folds(train: DataFrame, k: int = S.N_FOLDS, seed: int = S.SEED + 1, cls: str = S.TARGET) -> DataFrame:
    """Adds ``fold`` in 0..k-1: class-wise round robin along the hash order (fold sizes differ by <= 1 per class)."""
    r = rank_in_class(train, seed, cls)
    return r.withColumn("fold", ((F.col("class_rank") - 1) % k).cast("int")).drop("_nc", "class_rank")


def split_with_folds(df: DataFrame, test_pct: int = int(S.TEST_SHARE * 100), k: int = S.N_FOLDS,
                     seed: int = S.SEED, cls: str = S.TARGET) -> DataFrame:
    """Split and folds from one per-class hash rank: the first ceil(test_pct %) rows of each
    class are the test part, the rest go round robin to k folds (``fold`` is null on test rows).
    One distributed rank instead of two."""
    r = rank_in_class(df, seed, cls)
    n_test = F.floor((F.col("_nc") * test_pct + 99) / 100)
    is_test = F.col("class_rank") <= n_test
    return r.select(*df.columns, F.when(is_test, F.lit("test")).otherwise(F.lit("train")).alias("split"),
                    F.when(is_test, F.lit(None)).otherwise((F.col("class_rank") - n_test - 1) % k).cast("int").alias("fold"))


def stratified_subsample(df: DataFrame, size: int, seed: int = S.SEED, cls: str = S.TARGET) -> DataFrame:
    """Fixed-size stratified sample; the input itself when it is not larger than ``size``."""
    r = rank_in_class(df, seed, cls)
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    r = r.crossJoin(F.broadcast(total))
    quota = F.floor(F.col("_nc") * F.lit(size) / F.col("_n") + F.lit(0.5))
    keep = (F.col("_n") <= size) | (F.col("class_rank") <= quota)
    return r.where(keep).drop("_nc", "_n", "class_rank")


def hash_sample(df: DataFrame, n: int, seed: int = S.SEED, id_col: str = "respondent_id") -> DataFrame:
    """n rows without replacement: the n smallest (hash, id) (TakeOrderedAndProject, bounded by n)."""
    x = df.withColumn("_h", arith_hash(id_col, seed))
    return x.orderBy("_h", id_col).limit(n).drop("_h")


def split_sql(seed: int = S.SEED, test_pct: int = 20, src: str = "base") -> str:
    """SQL for the split column (oracle): rank within class by (hash, id)."""
    h = arith_hash_sql("respondent_id", seed)
    return (f"SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY heart_disease ORDER BY {h}, respondent_id) <= "
            f"FLOOR((COUNT(*) OVER (PARTITION BY heart_disease) * {test_pct} + 99) / 100) THEN 'test' ELSE 'train' END AS split FROM {src}")


def split_folds_sql(seed: int = S.SEED, test_pct: int = 20, k: int = S.N_FOLDS, src: str = "base") -> str:
    """SQL (oracle) of ``split_with_folds``."""
    h = arith_hash_sql("respondent_id", seed)
    return (f"SELECT *, CASE WHEN r <= nt THEN 'test' ELSE 'train' END AS split, "
            f"CASE WHEN r > nt THEN CAST((r - nt - 1) % {k} AS BIGINT) END AS fold FROM ("
            f"SELECT *, ROW_NUMBER() OVER (PARTITION BY heart_disease ORDER BY {h}, respondent_id) AS r, "
            f"FLOOR((COUNT(*) OVER (PARTITION BY heart_disease) * {test_pct} + 99) / 100) AS nt FROM {src}) z")
