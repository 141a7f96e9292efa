"""Quality checks and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import checks as CK
from ..sources import fixture
from ..sources.tables import analytical_base, survey_base
from .common import Registry
from .sqlbase import ctes

R = Registry()
q = R.add


def _report_sql(where: str | None = None, sample_mode: bool = False) -> str:
    cols = S.ANALYTICAL_COLUMNS
    aggs = ["COUNT(*) AS n"]
    aggs += [f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null__{c}" for c in cols]
    aggs += [f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({', '.join(map(str, d))})) AS dom__{c}"
             for c, d in S.DOMAINS.items()]
    aggs += [f"CAST(MIN({c}) AS DOUBLE) AS min__{c}, CAST(MAX({c}) AS DOUBLE) AS max__{c}" for c in S.BOUNDS]
    aggs += [f"AVG({S.TARGET}) * 100 AS prev", "AVG(flag_bmi_extreme) * 100 AS bmi_rate"]
    extra = ("one AS (SELECT " + ", ".join(aggs) + " FROM base), "
             "dup AS (SELECT COUNT(*) AS dup_ids FROM (SELECT respondent_id FROM base GROUP BY respondent_id HAVING COUNT(*) > 1) x)")

    def row(check, col, sev, obs, low, high, failed):
        return (f"SELECT '{check}' AS \"check\", '{col}' AS column_name, '{sev}' AS severity, CAST({obs} AS DOUBLE) AS observed, "
                f"CAST({low} AS DOUBLE) AS low, CAST({high} AS DOUBLE) AS high, CAST({failed} AS BIGINT) AS failed FROM one, dup")
    rows = [row("empty", "*", "ERROR", "n", "NULL", "NULL", "n = 0"),
            row("unique_id", "respondent_id", "ERROR", "dup_ids", "NULL", "NULL", "dup_ids > 0"),
            row("target_present", S.TARGET, "ERROR", "1", "NULL", "NULL", "0")]
    rows += [row("nulls", c, "ERROR", f"null__{c}", "NULL", "NULL", f"null__{c} > 0") for c in cols]
    rows += [row("domain", c, "ERROR", f"dom__{c}", min(d), max(d), f"dom__{c} > 0") for c, d in S.DOMAINS.items()]
    for c, (lo, hi) in S.BOUNDS.items():
        bad = f"COALESCE(min__{c} < {lo} OR max__{c} > {hi}, FALSE)"
        rows.append(row("bounds_min", c, "ERROR", f"min__{c}", lo, hi, bad))
        rows.append(row("bounds_max", c, "ERROR", f"max__{c}", lo, hi, bad))
    if not sample_mode:
        rows.append(row("volume", "*", "ALERT", "n", S.EXPECTED_ROWS, S.EXPECTED_ROWS, f"n <> {S.EXPECTED_ROWS}"))
        lo, hi = S.PREVALENCE_RANGE_PCT
        rows.append(row("prevalence_pct", S.TARGET, "ALERT", "prev", lo, hi, f"NOT (prev BETWEEN {lo} AND {hi})"))
    rows.append(row("extreme_bmi_pct", "flag_bmi_extreme", "ALERT", "bmi_rate", "NULL", S.EXTREME_BMI_ALERT_PCT,
                    f"bmi_rate > {S.EXTREME_BMI_ALERT_PCT}"))
    body = " UNION ALL ".join(rows)
    sql = ctes(extra + f", rep AS ({body})") + "SELECT * FROM rep"
    if where:
        sql += f" WHERE {where}"
    return sql


def _report(spark, sf, sample_mode=False):
    return CK.check_report(analytical_base(spark, sf), sample_mode=sample_mode)


@q("chk_report", _report_sql())
def chk_report(spark, sf):
    """The whole check report in one pass (ERROR rows block the load, ALERT rows are printed)."""
    return _report(spark, sf)


@q("chk_report_sample_mode", _report_sql(sample_mode=True))
def chk_report_sample_mode(spark, sf):
    """Sample mode: volume and prevalence alerts are skipped."""
    return _report(spark, sf, sample_mode=True)


def _sub(name, checks):
    where = "\"check\" IN (" + ", ".join(f"'{c}'" for c in checks) + ")"

    def run(spark, sf, _c=checks):
        return _report(spark, sf).where(F.col("check").isin(_c))
    run.__doc__ = f"Report rows of check(s) {', '.join(checks)}."
    q(name, _report_sql(where))(run)


_sub("chk_empty", ["empty"])
_sub("chk_unique_id", ["unique_id"])
_sub("chk_nulls", ["nulls"])
_sub("chk_domains", ["domain"])
_sub("chk_bounds", ["bounds_min", "bounds_max"])
_sub("chk_target", ["target_present"])
_sub("chk_volume", ["volume"])
_sub("chk_prevalence", ["prevalence_pct"])
_sub("chk_bmi_rate", ["extreme_bmi_pct"])


_CODED = [c for c in S.DOMAINS]


@q("chk_domain_values", ctes() + "SELECT column_name, value, CAST(COUNT(*) AS BIGINT) AS \"rows\" FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM base WHERE {c} IS NOT NULL AND {c} NOT IN "
    f"({', '.join(map(str, d))})" for c, d in S.DOMAINS.items()) + ") x GROUP BY 1, 2")
def chk_domain_values(spark, sf):
    """Each distinct out-of-codebook value per coded column, with its row count."""
    return CK.outside_values(analytical_base(spark, sf))


@q("chk_fractional", ctes() + " UNION ALL ".join(
    f"SELECT 'fractional_code' AS \"check\", '{c}' AS column_name, 'ERROR' AS severity, "
    f"CAST(COUNT(*) FILTER (WHERE CAST({c} AS DOUBLE) <> FLOOR(CAST({c} AS DOUBLE))) AS DOUBLE) AS observed, "
    f"CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high, "
    f"CAST(COUNT(*) FILTER (WHERE CAST({c} AS DOUBLE) <> FLOOR(CAST({c} AS DOUBLE))) > 0 AS BIGINT) AS failed FROM survey"
    for c in _CODED))
def chk_fractional(spark, sf):
    """Raw coded values that are not whole numbers, checked before the integer cast."""
    from ..operators import transform as TR
    return CK.fractional_codes(TR.rename(fixture.raw_survey(spark, sf)))


def _contract_sql():
    parts = ["SELECT 'empty' AS \"check\", '*' AS column_name, CAST(COUNT(*) AS BIGINT) AS observed, "
             "CAST(COUNT(*) = 0 AS BIGINT) AS failed FROM survey"]
    parts += [f"SELECT 'nulls', '{c}', CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT), "
              f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) > 0 AS BIGINT) FROM survey" for c in S.FEATURES]
    return ctes() + " UNION ALL ".join(parts)


@q("chk_batch_contract", _contract_sql())
def chk_batch_contract(spark, sf):
    """Scoring-batch contract on the 21 model features: missing columns, empty input, nulls."""
    return CK.batch_contract(fixture.respondents(spark, sf).select(*S.FEATURES), S.FEATURES)


_EXT = {"bmi_gt_60": "bmi > 60", "bmi_gt_80": "bmi > 80", "ment_days_30": "ment_hlth_days = 30",
        "phys_days_30": "phys_hlth_days = 30"}


@q("flt_extremes", ctes("one AS (SELECT COUNT(*) AS n, " + ", ".join(
    f"COUNT(*) FILTER (WHERE {c}) AS n_{k}, AVG(CASE WHEN {c} THEN heart_disease END) * 100 AS r_{k}" for k, c in _EXT.items())
    + " FROM base)") + " UNION ALL ".join(
    f"SELECT '{k}' AS condition, CAST(n_{k} AS BIGINT) AS n, CAST(n_{k} AS DOUBLE) / n * 100 AS share_pct, r_{k} AS rate_pct FROM one"
    for k in _EXT))
def flt_extremes(spark, sf):
    """Count, share and target rate of extreme rows (bmi > 60, bmi > 80, 30 bad days), one pass."""
    b = survey_base(spark, sf)
    conds = {"bmi_gt_60": F.col("bmi") > 60, "bmi_gt_80": F.col("bmi") > 80,
             "ment_days_30": F.col("ment_hlth_days") == 30, "phys_days_30": F.col("phys_hlth_days") == 30}
    aggs = [F.count(F.lit(1)).alias("n")]
    for k, c in conds.items():
        aggs += [F.count_if(c).alias(f"n_{k}"), (F.avg(F.when(c, F.col(S.TARGET))) * 100).alias(f"r_{k}")]
    one = b.agg(*aggs)
    stack = ", ".join(f"'{k}', n_{k}, CAST(n_{k} AS DOUBLE) / n * 100, r_{k}" for k in conds)
    return one.selectExpr(f"stack({len(conds)}, {stack}) AS (condition, n, share_pct, rate_pct)")


@q("qa_flag_totals", ctes() + "SELECT " + ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in S.FLAGS) + " FROM base")
def qa_flag_totals(spark, sf):
    b = analytical_base(spark, sf)
    return b.agg(*[F.sum(c).cast("long").alias(c) for c in S.FLAGS])
