"""Exploratory statistics.

Pattern used throughout: unpivot the studied columns into (column_name, value)
with ``stack`` (narrow), then one grouped aggregate per statistic family, so
k columns cost one scan and one small shuffle instead of k jobs. Exact
quantiles use ``percentile`` (linear interpolation, the same definition as
pandas and DuckDB ``quantile_cont``); its buffer is a value->count map, so its
memory follows the number of distinct values (small for these coded and
rounded measures), not the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S

DIGITS = 9  # rounding of floating statistics whose last bits depend on summation order


def unpivot(df: DataFrame, cols: list[str], keep: list[str] = ()) -> DataFrame:
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return df.selectExpr(*keep, f"stack({len(cols)}, {stack}) AS (column_name, value)")


def corrected_skew(g1: Column, n: Column) -> Column:
    """Population skewness g1 -> adjusted Fisher-Pearson G1 (pandas/DuckDB definition)."""
    return g1 * F.sqrt(n * (n - 1)) / (n - 2)


def corrected_kurt(g2: Column, n: Column) -> Column:
    """Population excess kurtosis g2 -> bias-corrected G2."""
    return (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count/mean/std/min/q1/median/q3/max/skew/kurtosis per column (std ddof=1)."""
    long = unpivot(df, cols)
    n = F.count("value").cast("double")
    g = long.groupBy("column_name").agg(
        F.count("value").cast("long").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.percentile("value", 0.25).alias("q1"),
        F.percentile("value", 0.5).alias("median"),
        F.percentile("value", 0.75).alias("q3"),
        F.max("value").alias("max"),
        corrected_skew(F.skewness("value"), n).alias("skew"),
        corrected_kurt(F.kurtosis("value"), n).alias("kurtosis"),
    )
    return g.select("column_name", "count", "mean", F.round("std", DIGITS).alias("std"), "min", "q1", "median", "q3",
                    "max", F.round("skew", DIGITS).alias("skew"), F.round("kurtosis", DIGITS).alias("kurtosis"))


def histogram(df: DataFrame, cols: list[str], bins: int = 40) -> DataFrame:
    """Equal-width bins between min and max (last bin closed), empty bins included."""
    long = unpivot(df, cols)
    mm = long.groupBy("column_name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    b = long.join(F.broadcast(mm), "column_name").select(
        "column_name",
        F.when(F.col("hi") == F.col("lo"), 0).otherwise(
            F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
        ).cast("long").alias("bin"))
    counts = b.groupBy("column_name", "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = mm.select("column_name", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.withColumn("bin", F.col("bin").cast("long")).join(counts, ["column_name", "bin"], "left")
    return out.select("column_name", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_start"),
                      F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def box(df: DataFrame, cols: list[str], by: str = S.TARGET) -> DataFrame:
    """Box statistics per (column, group): quartiles, whiskers within 1.5 IQR, outlier count."""
    long = unpivot(df, cols, keep=[by])
    q = long.groupBy("column_name", by).agg(
        F.percentile("value", 0.25).alias("q1"), F.percentile("value", 0.5).alias("median"),
        F.percentile("value", 0.75).alias("q3"))
    j = long.join(F.broadcast(q), ["column_name", by])
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("value") >= lo) & (F.col("value") <= hi)
    return j.groupBy("column_name", by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).cast("long").alias("n_outliers"),
    )


def outliers(df: DataFrame, cols: list[str]) -> DataFrame:
    """IQR fences and |z| > 3 counts and shares per column (std ddof=1)."""
    long = unpivot(df, cols)
    st = long.groupBy("column_name").agg(
        F.percentile("value", 0.25).alias("q1"), F.percentile("value", 0.5).alias("median"),
        F.percentile("value", 0.75).alias("q3"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    j = long.join(F.broadcast(st), "column_name")
    iqr = F.col("q3") - F.col("q1")
    out_iqr = (F.col("value") < F.col("q1") - 1.5 * iqr) | (F.col("value") > F.col("q3") + 1.5 * iqr)
    out_z = F.when(F.col("std") > 0, F.abs(F.col("value") - F.col("mean")) / F.col("std") > 3).otherwise(False)
    g = j.groupBy("column_name", "q1", "median", "q3").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(out_iqr).alias("n_out_iqr"), F.count_if(out_z).alias("n_out_z"))
    return g.select("column_name", "q1", "median", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
                    F.col("n_out_iqr").cast("long"), (F.col("n_out_iqr") / F.col("_n") * 100).alias("pct_out_iqr"),
                    F.col("n_out_z").cast("long"), (F.col("n_out_z") / F.col("_n") * 100).alias("pct_out_z"))


def outlier_limits(df: DataFrame, cols: list[str]) -> DataFrame:
    long = unpivot(df, cols)
    g = long.groupBy("column_name").agg(
        F.max("value").alias("max"), F.percentile("value", 0.25).alias("q1"), F.percentile("value", 0.75).alias("q3"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    return g.select("column_name", "max", (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("iqr_limit"),
                    F.round(F.col("mean") + 3 * F.col("std"), DIGITS).alias("z3_limit"))


def tail_quantiles(df: DataFrame, col: str = "bmi", probs=(0.95, 0.99, 0.999, 1.0)) -> DataFrame:
    one = df.agg(F.percentile(F.col(col).cast("double"), list(probs)).alias("q"))
    return one.select(F.posexplode("q").alias("i", "value")).select(
        F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("i") + 1).alias("prob"), "value")


def scales(df: DataFrame, cols: list[str]) -> DataFrame:
    """min/max/range/mean/std per column, by range descending."""
    long = unpivot(df, cols)
    g = long.groupBy("column_name").agg(F.min("value").alias("min"), F.max("value").alias("max"),
                                        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    return g.select("column_name", "min", "max", (F.col("max") - F.col("min")).alias("range"), "mean",
                    F.round("std", DIGITS).alias("std")).orderBy(F.desc("range"), "column_name")


def scale_ratio(df: DataFrame, cols: list[str]) -> DataFrame:
    """Largest/smallest range before and after z-scoring (after = range / std)."""
    long = unpivot(df, cols)
    g = long.groupBy("column_name").agg((F.max("value") - F.min("value")).alias("r"), F.stddev_samp("value").alias("s"))
    g = g.select("r", (F.col("r") / F.col("s")).alias("rz"))
    return g.agg((F.max("r") / F.min("r")).alias("ratio_before"),
                 F.round(F.max("rz") / F.min("rz"), DIGITS).alias("ratio_after"))


def prevalence_by(df: DataFrame, segments: list[str], labels: dict | None = None) -> DataFrame:
    """n and target rate (%) per code of each segment column, labelled; one pass."""
    stack = ", ".join(f"'{c}', CAST(`{c}` AS BIGINT)" for c in segments)
    long = df.selectExpr(S.TARGET, f"stack({len(segments)}, {stack}) AS (segment, code)")
    g = long.groupBy("segment", "code").agg(F.count(F.lit(1)).cast("long").alias("n"),
                                           (F.avg(S.TARGET) * 100).alias("prevalence_pct"))
    if labels:
        lab = df.sparkSession.createDataFrame(
            [(s, int(k), v) for s in segments for k, v in labels.get(s, {}).items()], "segment string, code long, label string")
        g = g.join(F.broadcast(lab), ["segment", "code"], "left")
    return g


def corr_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson matrix of ``cols`` in long form (var1, var2, corr); a pair leaves out the rows where one of its two is null.

    Without nulls (one counting pass tells) all pairs have the same rows, and Spark
    ML's ``Correlation.corr`` computes the d x d Gram matrix in one tree-aggregated
    pass (BLAS on dense vectors); only the d x d result reaches the driver to be
    reshaped. With nulls every pair is a ``corr`` aggregate of its own, all in one
    pass: more buffers and no whole-stage code, but each pair's own rows.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    missing = F.lit(False)
    for c in cols:
        missing = missing | F.col(c).isNull() | F.isnan(c)
    if x.where(missing).limit(1).count():
        pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
        value = [F.when(~F.isnan(c), F.col(c)) for c in cols]
        one = x.agg(*[F.corr(value[i], value[j]).alias(f"c_{i}_{j}") for i, j in pairs])
        both = [(a, b) for i, j in pairs for a, b in {(i, j), (j, i)}]
        items = F.array(*[F.struct(F.lit(cols[a]).alias("var1"), F.lit(cols[b]).alias("var2"),
                                   F.round(f"c_{min(a, b)}_{max(a, b)}", DIGITS).alias("corr")) for a, b in both])
        return one.select(F.explode(items).alias("r")).select("r.*")
    v = VectorAssembler(inputCols=cols, outputCol="_v", handleInvalid="error").transform(x)
    m = Correlation.corr(v, "_v", "pearson").first()[0].toArray()
    rows = [(a, b, round(float(m[i, j]), DIGITS)) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "var1 string, var2 string, corr double")


def corr_target(df: DataFrame, cols: list[str], target: str = S.TARGET) -> DataFrame:
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = one.selectExpr(f"stack({len(cols)}, {stack}) AS (variable, corr)")
    return long.select("variable", F.round("corr", DIGITS).alias("corr")).orderBy(F.desc(F.abs("corr")), "variable")


def status_profile(df: DataFrame, cols: list[str], target: str = S.TARGET) -> DataFrame:
    """% with value > 0 per indicator, by target status, and the gap."""
    aggs = []
    for c in cols:
        aggs.append((F.avg(F.when(F.col(target) == 0, (F.col(c) > 0).cast("int"))) * 100).alias(f"h__{c}"))
        aggs.append((F.avg(F.when(F.col(target) == 1, (F.col(c) > 0).cast("int"))) * 100).alias(f"s__{c}"))
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', h__{c}, s__{c}" for c in cols)
    long = one.selectExpr(f"stack({len(cols)}, {stack}) AS (indicator, healthy_pct, sick_pct)")
    return long.withColumn("gap_pts", F.col("sick_pct") - F.col("healthy_pct")).orderBy("gap_pts")


def rank_segments(agg: DataFrame, by: str) -> DataFrame:
    w = Window.orderBy(F.desc(by))
    return agg.withColumn("rank", F.row_number().over(w))
