"""Helpers shared by the operators of this subpackage.

Every operator first selects the columns it needs under names of its own, so further
columns of the input, whatever their names, can neither clash nor get lost on the way:
results carry the id and the operator's own columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package


def col(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def col_of(alias: str, name: str) -> Column:
    """The column of exactly this name of an aliased frame."""
    return F.col(f"{alias}.`" + name.replace("`", "``") + "`")


def pick(df: DataFrame, **names: str) -> DataFrame:
    """``pick(df, doc_id="id")`` selects column ``id`` as ``doc_id``."""
    return df.select(*[col(old).alias(new) for new, old in names.items()])


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once, however often ``f`` mentions it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


#: Code points of texts that are worked on together.
TEXTS_CHARS = 1 << 21


def map_texts(df: DataFrame, fields: list[tuple[str, str, pa.DataType]], make: Callable[[], Callable[[str], tuple]]) -> DataFrame:
    """Adds one column per field, computed from the last column (a text) of each row by the function that ``make()`` gives; see map_text_lists()."""
    def lists():
        one = make()

        class Each:
            release = staticmethod(getattr(getattr(one, "__self__", None), "release", lambda: None))

            def all(self, texts: list[str]) -> Iterable[tuple]:
                return map(one, texts)

        return Each().all

    return map_text_lists(df, fields, lists)


def map_text_lists(df: DataFrame, fields: list[tuple[str, str, pa.DataType]], make: Callable[[], Callable[[list[str]], Iterable[tuple]]]) -> DataFrame:
    """Adds one column per field, computed from the last column (a text) of each row.

    ``make()`` runs once per task and returns a function from some texts to a tuple of values for each;
    null texts are passed as ''. The text itself isn't returned. Rows are taken and given back
    one Arrow batch at a time, so a task holds one batch and what ``make`` keeps; if that has a
    ``release``, it is called at the end of the task.
    """
    ship_package(df.sparkSession)
    keep = df.columns[:-1]
    kinds = [pa.field(name, kind) for name, _, kind in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        work = make()
        for batch in batches:
            n = len(keep)
            rows, some, size = [], [], 0
            for t in batch.column(n).to_pylist():
                some.append(t or "")
                size += len(some[-1])
                if size >= TEXTS_CHARS:
                    rows += work(some)
                    some, size = [], 0
            rows += work(some)
            cols = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(n)] + cols, names=[*keep, *[f.name for f in kinds]])
        getattr(getattr(work, "__self__", None), "release", lambda: None)()

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-1]]
                       + [f"`{name}` {kind}" for name, kind, _ in fields])
    return df.mapInArrow(run, schema)


def summed(df: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], size: int, kind=np.float64) -> np.ndarray:
    """The sum of ``part(batch)``, ``size`` numbers, over all Arrow batches: one pass. Tasks add up their own batches;
    if there are many tasks, groups of their sums are added before the driver's."""
    ship_package(df.sparkSession)
    each = pa.list_(pa.from_numpy_dtype(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        found = np.zeros(size, kind)
        for batch in batches:
            if batch.num_rows:
                found += part(batch)
        yield pa.RecordBatch.from_arrays([pa.array([found], each)], names=["s"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        found = np.zeros(size, kind)
        for batch in batches:
            for s in batch.column(0).to_pylist():
                found += np.array(s, kind)
        yield pa.RecordBatch.from_arrays([pa.array([found], each)], names=["s"])

    schema = f"s array<{'double' if kind is np.float64 else 'bigint'}>"
    sums = df.mapInArrow(run, schema)
    groups = isqrt(df.rdd.getNumPartitions())
    if groups > 8:
        sums = sums.repartition(groups).mapInArrow(add, schema)
    rows = sums.toArrow()["s"].to_pylist()
    return np.sum(np.array(rows, kind), axis=0) if rows else np.zeros(size, kind)


def cut(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared checkpoint folder and reads it back: a lost executor costs
    a reread, and plans of loops stay short."""
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)
