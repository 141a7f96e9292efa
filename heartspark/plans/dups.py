"""Duplicate and profile-collision queries."""

from __future__ import annotations

from .. import schema as S
from ..operators import duplicates as D
from ..sources.tables import survey_base as analytical_base
from .common import Registry
from .sqlbase import SRC22, ctes

R = Registry()
q = R.add

P21 = ", ".join(D.PROFILE21)


@q("dup_flag", ctes() + f"SELECT respondent_id, COUNT(*) OVER (PARTITION BY {SRC22}) AS profile_n, "
   f"CAST(COUNT(*) OVER (PARTITION BY {SRC22}) > 1 AS BIGINT) AS dup_flag FROM base")
def dup_flag(spark, sf):
    """Row equal to at least one other row on the 22 columns (keep=False); also win_dup_count."""
    return D.dup_flag(analytical_base(spark, sf))


@q("dup_totals", ctes(f"g AS (SELECT COUNT(*) AS n FROM base GROUP BY {SRC22})") +
   "SELECT CAST(SUM(n - 1) AS BIGINT) AS redundant_rows, CAST(SUM(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS rows_in_groups, "
   "CAST(MAX(n) AS BIGINT) AS largest_group, CAST(COUNT(*) AS BIGINT) AS distinct_profiles FROM g")
def dup_totals(spark, sf):
    return D.totals(analytical_base(spark, sf))


@q("dup_group_sizes", ctes(f"g AS (SELECT COUNT(*) AS n FROM base GROUP BY {SRC22})") +
   "SELECT CAST(n AS BIGINT) AS group_size, CAST(COUNT(*) AS BIGINT) AS n_profiles FROM g GROUP BY n")
def dup_group_sizes(spark, sf):
    return D.group_sizes(analytical_base(spark, sf))


@q("win_first_kept", ctes() + f"SELECT respondent_id, CAST(ROW_NUMBER() OVER (PARTITION BY {SRC22} ORDER BY respondent_id) > 1 "
   "AS BIGINT) AS dup_not_first FROM base")
def win_first_kept(spark, sf):
    """Duplicates except the first occurrence (pandas ``duplicated()`` default)."""
    return D.first_kept(analytical_base(spark, sf))


@q("dup_dedup_impact", ctes("w AS (SELECT AVG(heart_disease) * 100 AS rate_with_pct FROM base), "
                            f"wo AS (SELECT AVG(heart_disease) * 100 AS rate_without_pct FROM (SELECT DISTINCT {SRC22} FROM base) d)")
   + "SELECT rate_with_pct, rate_without_pct, rate_without_pct - rate_with_pct AS difference_pts FROM w CROSS JOIN wo")
def dup_dedup_impact(spark, sf):
    return D.dedup_impact(analytical_base(spark, sf))


@q("dup_irreducible", ctes(f"g AS (SELECT COUNT(*) AS n, SUM(heart_disease) AS pos FROM base GROUP BY {P21}), "
                           "a AS (SELECT CAST(COUNT(*) AS BIGINT) AS distinct_profiles, "
                           "CAST(COUNT(*) FILTER (WHERE n > 1) AS BIGINT) AS repeated_profiles, "
                           "CAST(COUNT(*) FILTER (WHERE pos > 0 AND pos < n) AS BIGINT) AS ambiguous_profiles, "
                           "CAST(SUM(CASE WHEN pos > 0 AND pos < n THEN n ELSE 0 END) AS BIGINT) AS ambiguous_rows, "
                           "CAST(SUM(LEAST(pos, n - pos)) AS BIGINT) AS min_class_sum, CAST(SUM(n) AS BIGINT) AS n_rows, "
                           "CAST(COUNT(*) FILTER (WHERE n = 1) AS BIGINT) AS singletons FROM g)")
   + "SELECT *, CAST(min_class_sum AS DOUBLE) / n_rows * 100 AS irreducible_error_pct, "
     "CAST(singletons AS DOUBLE) / distinct_profiles * 100 AS singleton_share_pct FROM a")
def dup_irreducible(spark, sf):
    """Irreducible error of the 21 features: ambiguous profiles carry both classes."""
    return D.irreducible(analytical_base(spark, sf))


_IND = {"zero_mental_days": "ment_hlth_days = 0", "zero_physical_days": "phys_hlth_days = 0",
        "bmi_le_30": "bmi <= 30", "heart_disease": "heart_disease = 1"}


@q("dup_profile_compare", ctes(f"x AS (SELECT *, CASE WHEN COUNT(*) OVER (PARTITION BY {SRC22}) > 1 THEN 1 ELSE 0 END AS dup FROM base)")
   + " UNION ALL ".join(
       f"SELECT '{k}' AS indicator, AVG(CASE WHEN dup = 1 THEN CASE WHEN {c} THEN 1 ELSE 0 END END) * 100 AS duplicated_pct, "
       f"AVG(CASE WHEN dup = 0 THEN CASE WHEN {c} THEN 1 ELSE 0 END END) * 100 AS unique_pct FROM x" for k, c in _IND.items()))
def dup_profile_compare(spark, sf):
    return D.profile_compare(analytical_base(spark, sf))


def _rate_by_size_sql():
    ranks = ", ".join(f"ROW_NUMBER() OVER (ORDER BY {D.arith_hash_sql('respondent_id', s)}, respondent_id) AS r{s}" for s in D.SEEDS)
    samples = " UNION ALL ".join(f"SELECT {i} AS fi, CAST({f} AS DOUBLE) AS f, {s} AS s" for i, f in enumerate(D.FRACTIONS) for s in D.SEEDS)
    rank_case = "CASE " + " ".join(f"WHEN sm.s = {s} THEN rk.r{s}" for s in D.SEEDS) + " END"
    extra = (f"rk AS (SELECT {SRC22}, {ranks} FROM base), "
             "na AS (SELECT COUNT(*) AS n_all FROM base), "
             f"sm AS ({samples}), "
             f"mem AS (SELECT sm.fi, sm.f, sm.s, {', '.join('rk.' + c for c in S.SOURCE_COLUMNS)} FROM rk CROSS JOIN sm CROSS JOIN na "
             f"WHERE {rank_case} <= FLOOR(na.n_all * sm.f)), "
             f"grp AS (SELECT fi, f, s, COUNT(*) AS c FROM mem GROUP BY fi, f, s, {SRC22}), "
             "per AS (SELECT fi, f, s, SUM(c) AS size, COUNT(*) AS d FROM grp GROUP BY fi, f, s), "
             "rates AS (SELECT fi, f, s, size, (CAST(size AS DOUBLE) - d) / size * 100 AS r FROM per)")
    piv = ", ".join(f"MAX(CASE WHEN s = {s} THEN r END) AS r{s}" for s in D.SEEDS)
    mean = "(" + " + ".join(f"r{s}" for s in D.SEEDS) + f") / {len(D.SEEDS)}"
    return ctes(extra + f", pv AS (SELECT fi, f, CAST(MAX(size) AS BIGINT) AS sample_size, {piv} FROM rates GROUP BY fi, f)") + \
        f"SELECT f AS fraction, sample_size, {mean} AS dup_rate_pct FROM pv"


@q("dup_rate_by_size", _rate_by_size_sql())
def dup_rate_by_size(spark, sf):
    """Duplicate rate at 5/10/25/50/100 % hash samples, mean of three seeds."""
    return D.rate_by_size(analytical_base(spark, sf))
