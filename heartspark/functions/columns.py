"""Column expressions shared by operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S


def bmi_class(bmi: Column | str = "bmi") -> Column:
    """WHO class 1..6, left-closed bounds (18.5 is class 2); null bmi stays null."""
    c = F.col(bmi) if isinstance(bmi, str) else bmi
    expr = None
    for lo, hi, code in S.BMI_CLASSES:
        cond = c >= F.lit(lo) if hi == float("inf") else (c >= F.lit(lo)) & (c < F.lit(hi))
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr.cast("int")


def bmi_class_sql(col: str = "bmi") -> str:
    parts = []
    for lo, hi, code in S.BMI_CLASSES:
        if hi == float("inf"):
            parts.append(f"WHEN {col} >= {lo} THEN {code}")
        else:
            parts.append(f"WHEN {col} >= {lo} AND {col} < {hi} THEN {code}")
    return "CASE " + " ".join(parts) + " END"


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 integer (null stays null)."""
    return cond.cast("int")


def risk_band(p: Column | str, include_zero: bool = False) -> Column:
    """Right-closed bands (0,.05], (.05,.10], (.10,.20], (.20,.40], (.40,1]; out of range -> null.

    Faithful default: a risk of exactly 0 gets no band (an isotonic calibrator
    can emit 0); ``include_zero=True`` puts it in the first band.
    """
    c = F.col(p) if isinstance(p, str) else p
    e = S.RISK_BAND_EDGES
    expr = None
    for i in range(1, len(e)):
        lower_ok = (c >= F.lit(e[0])) if (i == 1 and include_zero) else (c > F.lit(e[i - 1]))
        cond = lower_ok & (c <= F.lit(e[i]))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.cast("int")


def risk_band_sql(col: str) -> str:
    e = S.RISK_BAND_EDGES
    parts = [f"WHEN {col} > {e[i - 1]} AND {col} <= {e[i]} THEN {i}" for i in range(1, len(e))]
    return "CASE " + " ".join(parts) + " END"


def risk_level(p: Column | str) -> Column:
    """Level relative to the reference prevalence: ratio <.5, <1.5, <3, else."""
    c = F.col(p) if isinstance(p, str) else p
    ratio = c / F.lit(S.REFERENCE_PREVALENCE)
    expr = None
    for bound, label in S.RISK_LEVELS:
        expr = F.when(ratio < F.lit(bound), F.lit(label)) if expr is None else expr.when(ratio < F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(S.RISK_LEVEL_TOP))


def risk_level_sql(col: str) -> str:
    parts = [f"WHEN {col} / {S.REFERENCE_PREVALENCE} < {b} THEN '{lab}'" for b, lab in S.RISK_LEVELS]
    return "CASE " + " ".join(parts) + f" ELSE '{S.RISK_LEVEL_TOP}' END"


def scorecard_points(values: dict | None = None) -> Column:
    """Points of a row; ``values`` puts other Columns in place of some of its own."""
    terms = [F.lit(w) * (values or {}).get(c, F.col(c)).cast("long") for c, w in S.SCORECARD_POINTS.items()]
    return reduce(lambda a, b: a + b, terms)


def scorecard_risk(values: dict | None = None) -> Column:
    p = scorecard_points(values)
    return (p * p).cast("double") / F.lit(S.SCORECARD_DIVISOR)


def scorecard_points_sql() -> str:
    return " + ".join(f"{w} * CAST({c} AS BIGINT)" for c, w in S.SCORECARD_POINTS.items())


def scorecard_risk_sql() -> str:
    p = f"({scorecard_points_sql()})"
    return f"CAST({p} * {p} AS DOUBLE) / {S.SCORECARD_DIVISOR}"


def map_lookup(mapping: dict, key: Column | str) -> Column:
    """Small fixed code -> label decode as a literal map (no join needed)."""
    k = F.col(key) if isinstance(key, str) else key
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return m[k]


def case_sql(mapping: dict, col: str) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    return "CASE " + " ".join(f"WHEN {col} = {lit(k)} THEN {lit(v)}" for k, v in mapping.items()) + " END"


def status_label(target: str = S.TARGET) -> Column:
    return F.when(F.col(target) == 1, F.lit(S.STATUS_SICK)).otherwise(F.lit(S.STATUS_HEALTHY))


def bmi_bin2(bmi: str = "bmi") -> Column:
    """Equal-width BMI bins of size 2 (bin start)."""
    return (F.floor(F.col(bmi) / 2) * 2).cast("double")


def safe_rate(num: Column, den: Column) -> Column:
    """DIVIDE semantics: blank (null) when the denominator is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))
