"""Every query with an oracle: Spark result == DuckDB result on sf0.001 (order-insensitive)."""
import math

import pytest

import __spark_entry__ as E
from conftest import SF0001

SQL = E.oracle_sql()
NAMES = sorted(SQL)


def _canon(rows, cols):
    order = sorted(cols)
    idx = [cols.index(c) for c in order]
    out = []
    for r in rows:
        t = []
        for i in idx:
            v = r[i]
            if isinstance(v, float) and not math.isnan(v):
                v = round(v, 9)
            t.append(v)
        out.append(tuple(t))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r)), order


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF0001)
    s_rows, s_cols = _canon([tuple(r) for r in df.collect()], df.columns)
    res = duck.execute(SQL[name])
    d_cols = [d[0] for d in res.description]
    d_rows, d_cols = _canon(res.fetchall(), d_cols)
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 13 and df.columns == ["age_key", "tranche_age", "taux_maladie"]
