"""Helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DecimalType)


def normalize(df: DataFrame) -> DataFrame:
    """Integral columns -> BIGINT, float/decimal -> DOUBLE, booleans -> BIGINT 0/1.

    Gives every registered query the same small set of output types as its
    DuckDB oracle (one extra projection, fused into the last codegen stage).
    """
    cols = []
    changed = False
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _INTEGRAL) and not isinstance(f.dataType, T.LongType):
            cols.append(c.cast("long").alias(f.name)); changed = True
        elif isinstance(f.dataType, _FRACTIONAL):
            cols.append(c.cast("double").alias(f.name)); changed = True
        elif isinstance(f.dataType, T.BooleanType):
            cols.append(c.cast("long").alias(f.name)); changed = True
        else:
            cols.append(c)
    return df.select(*cols) if changed else df


class Registry:
    """Collects ``name -> (builder, oracle sql or None)``."""

    def __init__(self):
        self.builders = {}
        self.sql = {}

    def add(self, name: str, sql: str | None = None):
        def deco(fn):
            def run(spark, sf_dir, _fn=fn):
                return normalize(_fn(spark, sf_dir))
            run.__name__ = name
            run.__doc__ = fn.__doc__
            self.builders[name] = run
            if sql is not None:
                self.sql[name] = sql
            return fn
        return deco
