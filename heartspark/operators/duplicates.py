"""Duplicate profiles and profile collisions.

All of these start from ``groupBy(profile).agg(...)``: map-side partial
aggregation means a profile holding a third of all rows costs one partial row
per map task before the shuffle, never a third of the table in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from .transform import attach_profile_counts, profile_counts

PROFILE22 = S.SOURCE_COLUMNS
PROFILE21 = [c for c in S.SOURCE_COLUMNS if c != S.TARGET]


def dup_flag(base: DataFrame) -> DataFrame:
    """(respondent_id, profile_n, dup_flag): row equal to at least one other on 22 columns."""
    x = attach_profile_counts(base.select("respondent_id", *PROFILE22), PROFILE22, "profile_n")
    return x.select("respondent_id", "profile_n", (F.col("profile_n") > 1).cast("int").alias("dup_flag"))


def totals(base: DataFrame) -> DataFrame:
    """Redundant rows (keep first), rows inside duplicate groups, largest group, distinct profiles."""
    g = profile_counts(base, PROFILE22, "n")
    return g.agg(
        F.sum(F.col("n") - 1).cast("long").alias("redundant_rows"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).cast("long").alias("rows_in_groups"),
        F.max("n").cast("long").alias("largest_group"),
        F.count(F.lit(1)).cast("long").alias("distinct_profiles"),
    )


def group_sizes(base: DataFrame) -> DataFrame:
    """How many profiles occur n times."""
    g = profile_counts(base, PROFILE22, "group_size")
    return g.groupBy("group_size").agg(F.count(F.lit(1)).cast("long").alias("n_profiles")).orderBy("group_size")


def first_kept(base: DataFrame) -> DataFrame:
    """``duplicated()`` default: every row of a profile except the first (lowest id).

    min(id) per profile (pre-aggregated) joined back, instead of a row_number
    window that would sort a hot profile in one task.
    """
    b = base.select("respondent_id", *PROFILE22)
    firsts = b.groupBy(*PROFILE22).agg(F.min("respondent_id").alias("_first"))
    keys = [f"_k{i}" for i in range(len(PROFILE22))]
    firsts = firsts.select(*[F.col(c).alias(k) for c, k in zip(PROFILE22, keys)], "_first")
    j = b.join(firsts, [b[c].eqNullSafe(firsts[k]) for c, k in zip(PROFILE22, keys)], "left")
    return j.select("respondent_id", (F.col("respondent_id") != F.col("_first")).cast("int").alias("dup_not_first"))


def dedup_impact(base: DataFrame) -> DataFrame:
    """Target rate (%) with and without deduplication on the 22 columns, and the difference."""
    with_ = base.agg((F.avg(S.TARGET) * 100).alias("rate_with_pct"))
    without = base.select(*PROFILE22).dropDuplicates(PROFILE22).agg((F.avg(S.TARGET) * 100).alias("rate_without_pct"))
    j = with_.crossJoin(without)
    return j.select("rate_with_pct", "rate_without_pct", (F.col("rate_without_pct") - F.col("rate_with_pct")).alias("difference_pts"))


def irreducible(base: DataFrame) -> DataFrame:
    """Profiles on the 21 features: distinct, repeated, ambiguous (both classes), rows, irreducible error."""
    g = base.groupBy(*PROFILE21).agg(F.count(F.lit(1)).alias("n"), F.sum(S.TARGET).alias("pos"))
    amb = (F.col("pos") > 0) & (F.col("pos") < F.col("n"))
    out = g.agg(
        F.count(F.lit(1)).cast("long").alias("distinct_profiles"),
        F.count_if(F.col("n") > 1).cast("long").alias("repeated_profiles"),
        F.count_if(amb).cast("long").alias("ambiguous_profiles"),
        F.sum(F.when(amb, F.col("n")).otherwise(0)).cast("long").alias("ambiguous_rows"),
        F.sum(F.least(F.col("pos"), F.col("n") - F.col("pos"))).cast("long").alias("min_class_sum"),
        F.sum("n").cast("long").alias("n_rows"),
        F.count_if(F.col("n") == 1).cast("long").alias("singletons"),
    )
    return out.select(
        "*",
        (F.col("min_class_sum") / F.col("n_rows") * 100).alias("irreducible_error_pct"),
        (F.col("singletons") / F.col("distinct_profiles") * 100).alias("singleton_share_pct"),
    )


def profile_compare(base: DataFrame) -> DataFrame:
    """Four rates (%), duplicated rows vs unique rows."""
    g = base.groupBy(*PROFILE22).agg(F.count(F.lit(1)).alias("_n"))
    # Each indicator is a function of the profile, so the profiles' counts are all that is needed.
    ind = {
        "zero_mental_days": F.col("ment_hlth_days") == 0,
        "zero_physical_days": F.col("phys_hlth_days") == 0,
        "bmi_le_30": F.col("bmi") <= 30,
        "heart_disease": F.col(S.TARGET) == 1,
    }
    aggs = []
    for k, cond in ind.items():
        for name, rows in (("d", F.col("_n") > 1), ("u", F.col("_n") == 1)):
            aggs.append((F.sum(F.when(rows & cond, F.col("_n")).when(rows & cond.isNotNull(), 0)) / F.sum(F.when(rows & cond.isNotNull(), F.col("_n"))) * 100)
                        .alias(f"{name}__{k}"))
    one = g.agg(*aggs)
    stack = ", ".join(f"'{k}', d__{k}, u__{k}" for k in ind)
    return one.selectExpr(f"stack({len(ind)}, {stack}) AS (indicator, duplicated_pct, unique_pct)")


_P = 2147483647  # 2^31 - 1, so every product below stays under 2^62


def arith_hash(id_col: str, seed: int):
    """Deterministic arithmetic hash in [0, 2^31-1), identical in any SQL engine.

    Affine step, a squaring step (non-linear, so consecutive ids scatter) and a
    second affine step, all modulo a prime; ties are broken by id by callers.
    """
    h1 = (F.col(id_col) % _P * F.lit(48271) + F.lit(seed * 7919 % _P)) % _P
    h2 = (h1 * h1 + F.lit(seed)) % _P
    return ((h2 * F.lit(16807) + F.lit(12345)) % _P).cast("long")


def arith_hash_sql(id_col: str, seed: int) -> str:
    h1 = f"(({id_col}) % {_P} * 48271 + {seed * 7919 % _P}) % {_P}"
    h2 = f"(({h1}) * ({h1}) + {seed}) % {_P}"
    return f"CAST((({h2}) * 16807 + 12345) % {_P} AS BIGINT)"


#: Equal ranges of a hash; at most so many counts a seed come to the driver.
BUCKETS = 16_384

FRACTIONS = [0.05, 0.10, 0.25, 0.50, 1.00]
SEEDS = [11, 22, 33]


def rate_by_size(base: DataFrame, fractions=FRACTIONS, seeds=SEEDS) -> DataFrame:
    """Duplicate rate (keep first, %) of hash samples of 5 sizes, mean over 3 seeds.

    Sample (f, s) = the floor(n*f) rows with the smallest key_s = (hash_s(id), id).
    Hashes are spread evenly over their range, so arithmetic gives buckets
    without looking for bounds: one pass over the ids counts the buckets of all
    seeds, a second sorts the few that hold a cut and picks the cut keys (15
    rows, which become literals). A profile is in a sample iff its smallest
    key is within the cut, so one pass over the base with a grouped min per
    seed and 15 conditional counts finishes it.
    """
    ids = base.select(F.col("respondent_id").alias("id"))
    each = ids.select("id", F.explode(F.array(*[F.struct(F.lit(s).alias("seed"), arith_hash("id", s).alias("h")) for s in seeds])).alias("x")).select("id", "x.*")
    each = each.withColumn("bucket", F.floor(F.col("h") * BUCKETS / (_P + 1)).cast("int"))
    counted = each.groupBy("seed", "bucket").count().collect()  # at most BUCKETS rows a seed
    n_all = sum(r["count"] for r in counted) // len(seeds)
    sizes = [int(n_all * f) for f in fractions]
    wanted = []
    for s in seeds:
        before = 0
        for r in sorted((r for r in counted if r["seed"] == s), key=lambda r: r["bucket"]):
            wanted += [(s, r["bucket"], i, size - before) for i, size in enumerate(sizes) if before < size <= before + r["count"]]
            before += r["count"]
    if not wanted:
        return base.sparkSession.createDataFrame([], "fraction double, sample_size long, dup_rate_pct double")
    spots = base.sparkSession.createDataFrame(wanted, "seed int, bucket int, fi int, place int")
    inside = each.join(F.broadcast(spots.select("seed", "bucket").distinct()), ["seed", "bucket"])
    inside = inside.withColumn("place", F.row_number().over(Window.partitionBy("seed", "bucket").orderBy("h", "id")))
    cuts = {(r["seed"], r["fi"]): (r["h"], r["id"]) for r in inside.join(F.broadcast(spots), ["seed", "bucket", "place"]).collect()}
    keyed = base.select(*PROFILE22, *[F.struct(arith_hash("respondent_id", s).alias("h"), F.col("respondent_id").alias("id")).alias(f"_k{s}") for s in seeds])
    g = keyed.groupBy(*PROFILE22).agg(*[F.min(f"_k{s}").alias(f"_m{s}") for s in seeds])

    def within(s: int, i: int):
        h, last = cuts[s, i]
        m = F.col(f"_m{s}")
        return (m["h"] < h) | ((m["h"] == h) & (m["id"] <= last))

    found = [(s, i) for i in range(len(fractions)) for s in seeds if (s, i) in cuts]
    one = g.agg(*[F.count_if(within(s, i)).alias(f"d_{s}_{i}") for s, i in found])
    rows = []
    for i, f in enumerate(fractions):
        rates = [(F.lit(sizes[i]) - F.col(f"d_{s}_{i}")) / F.lit(sizes[i]) * 100 for s in seeds if (s, i) in cuts]
        if rates:
            rows.append(F.struct(F.lit(f).alias("fraction"), F.lit(sizes[i]).cast("long").alias("sample_size"),
                                 (sum(rates[1:], rates[0]) / len(rates)).alias("dup_rate_pct")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
