"""Data-quality checks compiled into one aggregation pass.

Every scalar check (nulls, domains, bounds, volume, prevalence, extreme-BMI
rate) is one aggregate expression of a single ``agg``; the id-uniqueness check
is one extra grouped count. The result is a report DataFrame
``(check, column_name, severity, observed, low, high, failed)``; ``raise_on_errors``
turns failed ERROR rows into an exception, like the pipeline's blocking checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S

ERROR = "ERROR"
ALERT = "ALERT"


class QualityCheckFailed(Exception):
    pass


def _row(check, col, sev, observed, low, high, failed):
    return F.struct(
        F.lit(check).alias("check"), F.lit(col).alias("column_name"), F.lit(sev).alias("severity"),
        observed.cast("double").alias("observed"),
        (low if low is not None else F.lit(None)).cast("double").alias("low"),
        (high if high is not None else F.lit(None)).cast("double").alias("high"),
        failed.cast("long").alias("failed"),
    )


def check_report(df: DataFrame, sample_mode: bool = False, raw: DataFrame | None = None) -> DataFrame:
    """One pass over ``df`` (the analytical table) -> one report row per check and column.

    ``raw`` (optional, same columns before typing) adds the fractional-code
    check on raw values, which a cast would otherwise hide.
    """
    cols = df.columns
    n = F.count(F.lit(1))
    aggs = {"n": n}
    for c in cols:
        aggs[f"null__{c}"] = F.count_if(F.col(c).isNull())
    for c, dom in S.DOMAINS.items():
        if c in cols:
            aggs[f"dom__{c}"] = F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(dom))
    for c in S.BOUNDS:
        if c in cols:
            aggs[f"min__{c}"] = F.min(c).cast("double")
            aggs[f"max__{c}"] = F.max(c).cast("double")
    if S.TARGET in cols:
        aggs["prev"] = F.avg(S.TARGET) * 100
    if "flag_bmi_extreme" in cols:
        aggs["bmi_rate"] = F.avg("flag_bmi_extreme") * 100
    one = df.agg(*[v.alias(k) for k, v in aggs.items()])

    dup_ids = (df.groupBy("respondent_id").count().where(F.col("count") > 1)
               .agg(F.count(F.lit(1)).alias("dup_ids")))
    one = one.crossJoin(dup_ids)

    rows = [
        _row("empty", "*", ERROR, F.col("n"), None, None, F.col("n") == 0),
        _row("unique_id", "respondent_id", ERROR, F.col("dup_ids"), None, None, F.col("dup_ids") > 0),
        _row("target_present", S.TARGET, ERROR, F.lit(1 if S.TARGET in cols else 0), None, None,
             F.lit(S.TARGET not in cols)),
    ]
    rows += [_row("nulls", c, ERROR, F.col(f"null__{c}"), None, None, F.col(f"null__{c}") > 0) for c in cols]
    rows += [_row("domain", c, ERROR, F.col(f"dom__{c}"), F.lit(min(d)), F.lit(max(d)), F.col(f"dom__{c}") > 0)
             for c, d in S.DOMAINS.items() if c in cols]
    for c, (lo, hi) in S.BOUNDS.items():
        if c in cols:
            bad = (F.col(f"min__{c}") < lo) | (F.col(f"max__{c}") > hi)
            rows.append(_row("bounds_min", c, ERROR, F.col(f"min__{c}"), F.lit(lo), F.lit(hi), F.coalesce(bad, F.lit(False))))
            rows.append(_row("bounds_max", c, ERROR, F.col(f"max__{c}"), F.lit(lo), F.lit(hi), F.coalesce(bad, F.lit(False))))
    if not sample_mode:
        rows.append(_row("volume", "*", ALERT, F.col("n"), F.lit(S.EXPECTED_ROWS), F.lit(S.EXPECTED_ROWS),
                         F.col("n") != S.EXPECTED_ROWS))
        if S.TARGET in cols:
            lo, hi = S.PREVALENCE_RANGE_PCT
            rows.append(_row("prevalence_pct", S.TARGET, ALERT, F.col("prev"), F.lit(lo), F.lit(hi),
                             ~F.col("prev").between(lo, hi)))
    if "flag_bmi_extreme" in cols:
        rows.append(_row("extreme_bmi_pct", "flag_bmi_extreme", ALERT, F.col("bmi_rate"), None,
                         F.lit(S.EXTREME_BMI_ALERT_PCT), F.col("bmi_rate") > S.EXTREME_BMI_ALERT_PCT))
    report = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    if raw is not None:
        report = report.unionByName(fractional_codes(raw))
    return report


def fractional_codes(raw: DataFrame) -> DataFrame:
    """Raw coded values that are not whole numbers (checked before any cast)."""
    coded = [c for c in S.DOMAINS if c in raw.columns]
    one = raw.agg(*[F.count_if(F.col(c) != F.floor(F.col(c))).alias(c) for c in coded])
    rows = [_row("fractional_code", c, ERROR, F.col(c), None, None, F.col(c) > 0) for c in coded]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def outside_values(df: DataFrame) -> DataFrame:
    """Distinct out-of-codebook values per coded column: (column_name, value, rows).

    Unpivot then a grouped count: distributed, no per-column set in one buffer.
    """
    coded = [c for c in S.DOMAINS if c in df.columns]
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in coded)
    long = df.selectExpr(f"stack({len(coded)}, {stack}) AS (column_name, value)")
    dom = df.sparkSession.createDataFrame(
        [(c, float(v)) for c in coded for v in S.DOMAINS[c]], "column_name string, value double")
    out = long.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))
    return out.join(F.broadcast(dom), ["column_name", "value"], "left_anti")


def raise_on_errors(report: DataFrame) -> None:
    """Driver side: raise when any ERROR check failed (reads only the failed rows)."""
    bad = report.where((F.col("severity") == ERROR) & (F.col("failed") == 1)).collect()
    if bad:
        detail = "; ".join(f"{r['check']}:{r['column_name']}={r['observed']}" for r in bad)
        raise QualityCheckFailed(f"{len(bad)} blocking check(s) failed: {detail}")


def batch_contract(df: DataFrame, required: list[str]) -> DataFrame:
    """Scoring batch contract: missing columns (schema), empty input, nulls in required columns."""
    present = [c for c in required if c in df.columns]
    missing = [c for c in required if c not in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null__{c}") for c in present])
    rows = [F.struct(F.lit("missing_column").alias("check"), F.lit(c).alias("column_name"),
                     F.lit(1).cast("long").alias("observed"), F.lit(1).cast("long").alias("failed")) for c in missing]
    rows.append(F.struct(F.lit("empty").alias("check"), F.lit("*").alias("column_name"),
                         F.col("n").cast("long").alias("observed"), (F.col("n") == 0).cast("long").alias("failed")))
    rows += [F.struct(F.lit("nulls").alias("check"), F.lit(c).alias("column_name"),
                      F.col(f"null__{c}").cast("long").alias("observed"),
                      (F.col(f"null__{c}") > 0).cast("long").alias("failed")) for c in present]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
