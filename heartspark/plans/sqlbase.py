"""Shared SQL text for the independent DuckDB oracle.

Every oracle query starts from the same fixture and analytical-base CTEs, so a
query only states its own logic. Plain ANSI SQL (window functions, CASE,
GROUP BY); no engine-specific extension is needed.
"""

from __future__ import annotations

from .. import schema as S
from ..functions import columns as C
from ..sources.fixture import _FINAL, _LAT, _SEEDED, _SRC

SRC22 = ", ".join(S.SOURCE_COLUMNS)


def ctes(extra: str = "") -> str:
    """``WITH seeded, lat, src, survey, base[, extra]`` prefix (integers as BIGINT, bmi DOUBLE)."""
    typed = ", ".join(
        ["CAST(respondent_id AS BIGINT) AS respondent_id"]
        + [f"CAST({c} AS BIGINT) AS {c}" if c != "bmi" else "CAST(bmi AS DOUBLE) AS bmi" for c in S.SOURCE_COLUMNS]
    )
    derived = [
        (f"{C.bmi_class_sql('bmi')}", "bmi_class"),
        (f"LEAST(ment_hlth_days + phys_hlth_days, {S.DAY_CAP})", "total_unhealthy_days"),
        ("high_bp + high_chol + smoker + stroke + diff_walk + CASE WHEN diabetes > 0 THEN 1 ELSE 0 END"
         " + CASE WHEN bmi >= 30 THEN 1 ELSE 0 END", "risk_factor_count"),
        ("phys_activity + fruits + veggies", "healthy_habits_count"),
        ("CASE WHEN any_healthcare = 1 AND no_doc_cost = 0 THEN 1 ELSE 0 END", "has_care_access"),
        (f"CASE WHEN bmi > {S.BMI_MAX_PLAUSIBLE} OR bmi < {S.BMI_MIN_PLAUSIBLE} THEN 1 ELSE 0 END", "flag_bmi_extreme"),
        (f"CASE WHEN COUNT(*) OVER (PARTITION BY {SRC22}) > 1 THEN 1 ELSE 0 END", "flag_profil_duplique"),
        (f"CASE WHEN gen_hlth >= 4 AND LEAST(ment_hlth_days + phys_hlth_days, {S.DAY_CAP}) = 0 THEN 1 ELSE 0 END",
         "flag_sante_incoherente"),
    ]
    base_cols = ",\n  ".join(["respondent_id", *S.SOURCE_COLUMNS] + [f"CAST({e} AS BIGINT) AS {n}" for e, n in derived])
    sql = (
        "WITH seeded AS (SELECT " + ", ".join(_SEEDED) + " FROM orders),\n"
        "lat AS (SELECT " + ", ".join(_LAT) + " FROM seeded),\n"
        "src AS (SELECT " + ", ".join(_SRC) + " FROM lat),\n"
        "survey AS (SELECT " + ", ".join(_FINAL) + " FROM src),\n"
        f"typed AS (SELECT {typed} FROM survey),\n"
        f"base AS (SELECT\n  {base_cols}\nFROM typed)"
    )
    if extra:
        sql += ",\n" + extra
    return sql + "\n"


def dim_values(table: str) -> str:
    """A dimension as an inline VALUES relation: (key, label)."""
    _, key, _, label, members = S.DIM_BY_TABLE[table]
    rows = ", ".join(f"({k}, '{v}')" for k, v in members.items())
    return f"(SELECT * FROM (VALUES {rows}) AS t({key}, {label}))"


def fact_sql() -> str:
    """The fact table as a CTE body (base LEFT JOIN 7 dims, COALESCE -1)."""
    joins = []
    keys = []
    for i, (table, key, src, _, _) in enumerate(S.DIMENSIONS):
        joins.append(f"LEFT JOIN {dim_values(table)} AS d{i} ON ab.{src} = d{i}.{key}")
        keys.append(f"COALESCE(d{i}.{key}, -1) AS {key}")
    rest = [c for c in S.FACT_COLUMNS if c != "respondent_id" and c not in [d[1] for d in S.DIMENSIONS]]
    return (
        "SELECT ab.respondent_id, " + ", ".join(keys) + ", " + ", ".join(f"ab.{c}" for c in rest)
        + " FROM base AS ab " + " ".join(joins)
    )


def with_fact(extra: str = "") -> str:
    body = f"fact AS ({fact_sql()})"
    if extra:
        body += ",\n" + extra
    return ctes(body)
