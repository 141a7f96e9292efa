"""Order-dependent primitives without a global (unpartitioned) window.

``global_rank`` numbers rows 1..n in a total order and ``running_sum`` gives
prefix sums, both in three steps that keep every task bounded:

1. bucket each row by its leading order key against approximate quantile
   bounds, found by one small aggregate and looked up by binary search - the
   bucket is a pure function of the row, so a recomputed task after an
   executor loss lands every row in the same bucket again (unlike a sampled
   range partitioner re-run under a new shuffle id); the number of buckets
   follows the number of rows, so a bucket's size does not;
2. per-bucket counts or sums (one row a bucket, proven small) and their
   running total give each bucket's carry-in;
3. inside a bucket a window partitioned by bucket numbers or sums the rows.

The leading key should be near-unique (a hash, a pre-aggregated score); ties
in it stay in one bucket. Where the order starts with several exact columns
whose combination is only approximate in one double, that double is passed as
``lead`` and the exact columns as the order.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a bucket, about, and the most buckets.
ROWS_PER_BUCKET = 10_000
MOST_BUCKETS = 10_000


def n_buckets(rows: int) -> int:
    """Buckets for so many rows: one up to ROWS_PER_BUCKET, then in proportion."""
    return max(1, min(MOST_BUCKETS, -(-rows // ROWS_PER_BUCKET)))


def bounds_of(df: DataFrame, lead: Column, n: int | None = None) -> list[float]:
    """Increasing bounds between buckets of about equal size (at most MOST_BUCKETS numbers come to the driver).

    Two levels of precision in one pass: a sketch of as many points as there can be buckets, thinned
    to the number that the row count asks for.
    """
    points = n or 1_000
    probs = [i / points for i in range(1, points)]
    key = lead.cast("double")
    if n is None:
        row = df.agg(F.count(F.lit(1)), F.percentile_approx(key, probs, 10 * points)).first()
        wanted = n_buckets(row[0])
        if wanted > points:  # rare: a finer sketch in a second pass
            return bounds_of(df, lead, wanted)
        cuts = row[1] or []
        step = points / wanted
        cuts = [cuts[min(len(cuts) - 1, round(k * step) - 1)] for k in range(1, wanted)] if cuts else []
    else:
        cuts = (df.agg(F.percentile_approx(key, probs, 10 * points)).first()[0] or []) if probs else []
    return sorted({c for c in cuts if c is not None and c == c and abs(c) != float("inf")})


def bucketize(df: DataFrame, lead: Column, n: int | None = None, name: str = "_bkt") -> DataFrame:
    """Add ``name`` = number of quantile bounds at or below the leading key, by binary search; nulls come first, NaN last."""
    cuts = bounds_of(df, lead, n)
    if not cuts:
        return df.withColumn(name, F.lit(0))
    low, high = float("-inf"), float("inf")
    keyed = df.withColumn("_lead", F.coalesce(lead.cast("double"), F.lit(low)))
    found = Bucketizer(splits=[low, *cuts, high], inputCol="_lead", outputCol=name, handleInvalid="keep").transform(keyed)
    return found.withColumn(name, F.col(name).cast("int")).drop("_lead")


def global_rank(df: DataFrame, order: list[Column], name: str = "rank", n: int | None = None, lead: Column | None = None) -> DataFrame:
    """1-based position in ``order`` (make it total: end with a unique key)."""
    x = bucketize(df, order[0] if lead is None else lead, n)
    cnt = x.groupBy("_bkt").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    cnt = cnt.select("_bkt", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    wi = Window.partitionBy("_bkt").orderBy(*order)
    y = x.join(F.broadcast(cnt), "_bkt")
    return y.withColumn(name, (F.col("_off") + F.row_number().over(wi)).cast("long")).drop("_bkt", "_off")


def running_sum(df: DataFrame, order: list[Column], value_cols: list[str], prefix: str = "cum_",
                n: int | None = None, lead: Column | None = None) -> DataFrame:
    """Inclusive running sums of ``value_cols`` along ``order`` (a total order)."""
    x = bucketize(df, order[0] if lead is None else lead, n)
    tot = x.groupBy("_bkt").agg(*[F.sum(c).alias(f"_t_{c}") for c in value_cols])
    w = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select("_bkt", *[F.coalesce(F.sum(f"_t_{c}").over(w), F.lit(0)).alias(f"_c_{c}") for c in value_cols])
    wi = Window.partitionBy("_bkt").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    y = x.join(F.broadcast(tot), "_bkt")
    return y.select(*df.columns, *[(F.col(f"_c_{c}") + F.sum(c).over(wi)).alias(f"{prefix}{c}") for c in value_cols])


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """``nlargest`` semantics with a deterministic tie order (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, k: int, group: list[str], order: list[Column], rank_col: str = "rank") -> DataFrame:
    """First k rows per group (used where a group is one row's small set of values)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def quantiles_from_cumulative(cum: DataFrame, group: list[str], value: str, count: str, cum_col: str, n_col: str,
                              probs: list[float], names: list[str]) -> DataFrame:
    """Exact linear-interpolation quantiles from a table of distinct values per group.

    ``cum`` holds one row per (group, value) with its row count, the inclusive
    cumulative count within the group (ascending value) and the group size.
    For p, h = p (n - 1); the value at 0-based position k is the smallest value
    whose cumulative count exceeds k. Every quantile is a grouped ``min``
    (partial aggregation), so no group's values are ever buffered together.
    """
    aggs = []
    for p, name in zip(probs, names):
        h = F.lit(p) * (F.col(n_col) - 1)
        lo = F.floor(h)
        aggs.append(F.min(F.when(F.col(cum_col) > lo, F.col(value))).alias(f"_lo_{name}"))
        aggs.append(F.min(F.when(F.col(cum_col) > lo + 1, F.col(value))).alias(f"_hi_{name}"))
        aggs.append(F.first(h - lo).alias(f"_fr_{name}"))
    g = cum.groupBy(*group).agg(*aggs)
    out = []
    for name in names:
        lo, hi, fr = F.col(f"_lo_{name}"), F.coalesce(F.col(f"_hi_{name}"), F.col(f"_lo_{name}")), F.col(f"_fr_{name}")
        out.append(F.when(fr == 0, lo).otherwise(lo + (hi - lo) * fr).alias(name))
    return g.select(*group, *out)


def kth_smallest(df: DataFrame, order: list[Column], positions: DataFrame, pos_col: str = "pos",
                 n: int | None = None) -> DataFrame:
    """Rows at given 1-based positions of a total order, without ranking every row.

    Per-bucket counts and their running total locate the bucket holding each
    requested position; only rows of those buckets (at most one bucket per
    position) are sorted. ``positions`` is a small table with column ``pos_col``.
    """
    x = bucketize(df, order[0], n)
    cnt = x.groupBy("_bkt").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    cnt = cnt.select("_bkt", "_n", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    want = positions.crossJoin(F.broadcast(cnt)).where(
        (F.col(pos_col) > F.col("_off")) & (F.col(pos_col) <= F.col("_off") + F.col("_n"))).select(
        *positions.columns, "_bkt", (F.col(pos_col) - F.col("_off")).alias("_local"))
    hit = x.join(F.broadcast(want.select("_bkt").distinct()), "_bkt")
    wi = Window.partitionBy("_bkt").orderBy(*order)
    ranked = hit.withColumn("_local", F.row_number().over(wi))
    return ranked.join(F.broadcast(want), ["_bkt", "_local"]).drop("_bkt", "_local")
