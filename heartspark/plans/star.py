"""Star-schema queries: dimensions, fact, integrity."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import star
from ..sources.tables import fact, report_fact, survey_base as analytical_base
from .common import Registry
from .sqlbase import ctes, dim_values, with_fact

R = Registry()
q = R.add


@q("jn_fact", with_fact() + "SELECT " + ", ".join(S.FACT_COLUMNS) + " FROM fact")
def jn_fact(spark, sf):
    """fact_respondent: base LEFT JOIN 7 broadcast dimensions, COALESCE(key, -1)."""
    return fact(spark, sf)


def _jn(table):
    _, key, src, label, _ = S.DIM_BY_TABLE[table]
    sql = ctes() + (f"SELECT b.respondent_id, CAST(COALESCE(d.{key}, -1) AS BIGINT) AS {key}, d.{label} "
                    f"FROM base b LEFT JOIN {dim_values(table)} d ON b.{src} = d.{key}")

    def run(spark, sf, _t=table):
        return star.dimension_join(spark, analytical_base(spark, sf), _t)
    run.__doc__ = f"Base rows joined to {table} (broadcast left join)."
    return sql, run


for _t in ["dim_age", "dim_education", "dim_income", "dim_sex", "dim_genhlth", "dim_diabetes", "dim_bmi_class"]:
    _sql, _run = _jn(_t)
    q("jn_" + _t[4:], _sql)(_run)


def _need_sql():
    parts = []
    for table, key, src, _, members in S.DIMENSIONS:
        codes = ", ".join(str(k) for k in members)
        parts.append(
            f"SELECT '{table}' AS dimension, CAST(COUNT(*) FILTER (WHERE {src} IS NULL) AS BIGINT) AS n_null, "
            f"CAST(COUNT(*) FILTER (WHERE {src} IS NOT NULL AND {src} NOT IN ({codes})) AS BIGINT) AS n_outside FROM base"
        )
    return ctes("nu AS (" + " UNION ALL ".join(parts) + ")") + \
        "SELECT dimension, n_null, n_outside, CAST(n_null + n_outside > 0 AS BIGINT) AS need_unknown FROM nu"


@q("jn_need_unknown", _need_sql())
def jn_need_unknown(spark, sf):
    """Does a dimension need the -1 member: any null or code outside the codebook (one pass)."""
    return star.need_unknown(analytical_base(spark, sf))


def _dim_load_sql():
    parts = []
    for table, key, src, label, members in S.DIMENSIONS:
        codes = ", ".join(str(k) for k in members)
        parts.append(f"SELECT '{table}' AS dimension, CAST({key} AS BIGINT) AS dim_key, {label} AS dim_label FROM {dim_values(table)}")
        parts.append(
            f"SELECT '{table}', -1, 'Inconnu' WHERE EXISTS (SELECT 1 FROM base WHERE {src} IS NULL OR {src} NOT IN ({codes}))")
    return ctes() + " UNION ALL ".join(parts)


@q("dim_load", _dim_load_sql())
def dim_load(spark, sf):
    """All published dimensions (codebook + 'Inconnu' only when needed) as (dimension, key, label)."""
    return star.load_dims(spark, analytical_base(spark, sf))


# Written by hand, apart from the operator: a dimension has the codes of its codebook, and -1 exactly
# if some row of the base is null or outside it.
_ORPHANS_SQL = with_fact() + " UNION ALL ".join(
    f"SELECT '{dim}' AS dimension, CAST(COUNT(*) FILTER (WHERE f.{key} IS NULL OR (f.{key} NOT BETWEEN {low} AND {high} AND NOT (f.{key} = -1 AND "
    f"EXISTS (SELECT 1 FROM base WHERE {src} IS NULL OR {src} NOT BETWEEN {low} AND {high})))) AS BIGINT) AS orphans FROM fact f"
    for dim, key, src, low, high in (
        ("dim_age", "age_key", "age_group", 1, 13), ("dim_education", "education_key", "education", 1, 6),
        ("dim_income", "income_key", "income", 1, 8), ("dim_sex", "sex_key", "sex", 0, 1),
        ("dim_genhlth", "genhlth_key", "gen_hlth", 1, 5), ("dim_diabetes", "diabetes_key", "diabetes", 0, 2),
        ("dim_bmi_class", "bmi_class_key", "bmi_class", 1, 6)))


@q("jn_orphans", _ORPHANS_SQL)
def jn_orphans(spark, sf):
    """Fact keys without a row in the published dimension, per dimension."""
    base = analytical_base(spark, sf)
    return star.orphans(spark, report_fact(spark, sf), base)


def _unknown_sql():
    parts = [f"SELECT '{t}' AS dimension, CAST(COUNT(*) FILTER (WHERE {k} = -1) AS BIGINT) AS unknown_rows FROM fact"
             for t, k, *_ in S.DIMENSIONS]
    return with_fact() + " UNION ALL ".join(parts)


@q("jn_unknown_count", _unknown_sql())
def jn_unknown_count(spark, sf):
    return star.unknown_counts(fact(spark, sf))


def _star_sql():
    joins = " ".join(f"JOIN {dim_values(t)} d{i} ON f.{k} = d{i}.{k}" for i, (t, k, *_) in enumerate(S.DIMENSIONS))
    labels = ", ".join(f"d{i}.{lab}" for i, (_, _, _, lab, _) in enumerate(S.DIMENSIONS))
    return with_fact() + f"SELECT f.respondent_id, {labels}, f.heart_disease FROM fact f {joins}"


@q("jn_star_labels", _star_sql())
def jn_star_labels(spark, sf):
    """v_star: fact with every dimension label (inner many-to-one joins)."""
    v = star.star_view(spark, fact(spark, sf))
    return v.select("respondent_id", *[d[3] for d in S.DIMENSIONS], S.TARGET)


def _except_sql():
    parts = []
    for table, key, src, _, _ in S.DIMENSIONS:
        parts.append(f"SELECT '{table}' AS dimension, code FROM (SELECT DISTINCT CAST({src} AS BIGINT) AS code FROM base "
                     f"WHERE {src} IS NOT NULL EXCEPT SELECT {key} FROM {dim_values(table)}) x")
    return ctes() + " UNION ALL ".join(parts)


@q("set_except_codes", _except_sql())
def set_except_codes(spark, sf):
    """Distinct fact codes minus codebook codes, per dimension."""
    return star.outside_codes(analytical_base(spark, sf), spark)

# set_union_unknown (≡ dim_load): the unknown member is unioned by name in published_dim.
