"""Star schema: dimensions from the codebook, the fact table, integrity checks.

Dimensions are fixed codebook tables (at most 14 rows), so broadcasting them is
size-proven; the fact build is seven broadcast hash joins inside one stage and
never shuffles the base table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S


def codebook_dim(spark: SparkSession, table: str) -> DataFrame:
    """(key INT NOT NULL, label STRING NOT NULL) rows of one dimension, codebook order."""
    _, key, _, label, members = S.DIM_BY_TABLE[table]
    sch = T.StructType([T.StructField(key, T.IntegerType(), False), T.StructField(label, T.StringType(), False)])
    return spark.createDataFrame([(int(k), v) for k, v in members.items()], sch)


def need_unknown(base: DataFrame) -> DataFrame:
    """One pass: per dimension, does the base hold a null or a code outside the codebook?

    Returns (dimension, n_null, n_outside, need_unknown).
    """
    aggs = []
    for table, _, src, _, members in S.DIMENSIONS:
        codes = list(members.keys())
        aggs.append(F.count_if(F.col(src).isNull()).alias(f"{table}__null"))
        aggs.append(F.count_if(F.col(src).isNotNull() & ~F.col(src).isin(codes)).alias(f"{table}__out"))
    row = base.agg(*aggs)
    stack = ", ".join(f"'{t}', `{t}__null`, `{t}__out`" for t, *_ in S.DIMENSIONS)
    out = row.selectExpr(f"stack({len(S.DIMENSIONS)}, {stack}) AS (dimension, n_null, n_outside)")
    return out.select(
        "dimension",
        F.col("n_null").cast("long").alias("n_null"),
        F.col("n_outside").cast("long").alias("n_outside"),
        ((F.col("n_null") + F.col("n_outside")) > 0).alias("need_unknown"),
    )


def code_values(base: DataFrame) -> DataFrame:
    """(dimension, code) of all distinct codes in the base, from one pass: a row gives its seven
    codes as structs, and the distinct is pre-aggregated in each task."""
    pairs = F.array(*[F.struct(F.lit(t).alias("dimension"), F.col(src).cast("int").alias("code")) for t, _, src, _, _ in S.DIMENSIONS])
    return base.select(F.explode(pairs).alias("p")).select("p.*").distinct()


def codebook_pairs(spark: SparkSession) -> DataFrame:
    """(dimension, code, label) of every codebook row."""
    rows = [(t, int(k), v) for t, _, _, _, members in S.DIMENSIONS for k, v in members.items()]
    return spark.createDataFrame(rows, "dimension string, code int, label string")


def outside_codes(base: DataFrame, spark: SparkSession) -> DataFrame:
    """Distinct codes of every coded fact column that are absent from its dimension (set difference)."""
    known = F.broadcast(codebook_pairs(spark).drop("label"))
    return code_values(base).where("code is not null").join(known, ["dimension", "code"], "left_anti")


def load_dims(spark: SparkSession, base: DataFrame) -> DataFrame:
    """All published dimensions as (dimension, dim_key, dim_label): the codebook, and the (-1, 'Inconnu')
    member where the one-pass check says that the data need it."""
    need = need_unknown(base).where("need_unknown").select(
        "dimension", F.lit(S.UNKNOWN_KEY).cast("int").alias("dim_key"), F.lit(S.UNKNOWN_LABEL).alias("dim_label"))
    return codebook_pairs(spark).withColumnsRenamed({"code": "dim_key", "label": "dim_label"}).unionByName(need)


def published_dims(spark: SparkSession, base: DataFrame) -> dict:
    """All seven published dimensions from ONE aggregation pass over the base.

    The pass yields seven (dimension, needs-unknown) flags -- a bounded result --
    and each dimension is its codebook plus, only where needed, the unknown member.
    """
    need = {r["dimension"]: bool(r["need_unknown"]) for r in need_unknown(base).collect()}
    out = {}
    for table, key, _, label, _ in S.DIMENSIONS:
        d = codebook_dim(spark, table)
        if need.get(table):
            unknown = spark.createDataFrame([(S.UNKNOWN_KEY, S.UNKNOWN_LABEL)], d.schema)
            d = unknown.unionByName(d)
        out[table] = d
    return out


def published_dim(spark: SparkSession, base: DataFrame, table: str) -> DataFrame:
    """One published dimension."""
    return published_dims(spark, base)[table]


def orphans_against(fact: DataFrame, dims: dict) -> DataFrame:
    """Fact keys absent from the given (published) dimensions, per dimension: one pass over the fact.

    The keys of a dimension are a handful, so each is tested as a membership list.
    """
    keys = {t: [r[0] for r in dims[t].select(key).collect()] for t, key, *_ in S.DIMENSIONS}
    aggs = [F.count_if(F.col(key).isNull() | ~F.col(key).isin(keys[t])).alias(t) for t, key, *_ in S.DIMENSIONS]
    stack = ", ".join(f"'{t}', `{t}`" for t, *_ in S.DIMENSIONS)
    return fact.agg(*aggs).selectExpr(f"stack({len(S.DIMENSIONS)}, {stack}) AS (dimension, orphans)").select(
        "dimension", F.col("orphans").cast("long"))


def build_fact(spark: SparkSession, base: DataFrame, via: str = "join") -> DataFrame:
    """31-column fact: unmatched codes -> -1.

    ``via="join"``: seven LEFT joins to the broadcast dimensions (the star
    build). ``via="codebook"``: the dimension key equals the source code, so
    the join only tests membership; ``CASE WHEN code IN (codebook)`` gives the
    same key as a projection that Catalyst prunes column by column.
    """
    fact = base
    for table, key, src, _, members in S.DIMENSIONS:
        if via == "codebook":
            fact = fact.withColumn(key, F.when(F.col(src).isin(list(members)), F.col(src).cast("int"))
                                   .otherwise(F.lit(S.UNKNOWN_KEY)))
        else:
            dim = F.broadcast(codebook_dim(spark, table).select(key))
            fact = fact.join(dim, fact[src] == dim[key], "left").withColumn(
                key, F.coalesce(F.col(key), F.lit(S.UNKNOWN_KEY)))
    return fact.select(*[c for c in S.FACT_COLUMNS if c in fact.columns])


def dimension_join(spark: SparkSession, base: DataFrame, table: str) -> DataFrame:
    """One dimension attached to the base: (respondent_id, key, label)."""
    _, key, src, label, _ = S.DIM_BY_TABLE[table]
    dim = F.broadcast(codebook_dim(spark, table))
    j = base.select("respondent_id", src).join(dim, F.col(src) == F.col(key), "left")
    return j.select("respondent_id", F.coalesce(F.col(key), F.lit(S.UNKNOWN_KEY)).alias(key), label)


def orphans(spark: SparkSession, fact: DataFrame, base: DataFrame) -> DataFrame:
    """Foreign keys of the fact with no row in the dimension as published for ``base`` (codebook, and the
    unknown member where the base needs it), per dimension: one pass over the base, one over the fact."""
    return orphans_against(fact, published_dims(spark, base))


def unknown_counts(fact: DataFrame) -> DataFrame:
    """Rows attached to the unknown member, per dimension, in one pass."""
    aggs = [F.count_if(F.col(key) == S.UNKNOWN_KEY).alias(table) for table, key, *_ in S.DIMENSIONS]
    row = fact.agg(*aggs)
    stack = ", ".join(f"'{t}', `{t}`" for t, *_ in S.DIMENSIONS)
    return row.selectExpr(f"stack({len(S.DIMENSIONS)}, {stack}) AS (dimension, unknown_rows)").select(
        "dimension", F.col("unknown_rows").cast("long"))


def star_view(spark: SparkSession, fact: DataFrame) -> DataFrame:
    """Fact with every dimension label attached (inner, many-to-one), for reports."""
    out = fact
    for table, key, _, label, _ in S.DIMENSIONS:
        out = out.join(F.broadcast(codebook_dim(spark, table)), key, "inner")
    return out
