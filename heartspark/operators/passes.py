"""One pass over a table that adds up a long vector of numbers, as iterative fits need it."""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import ship_package


def summed(df: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], size: int, tasks: int | None = None) -> np.ndarray:
    """The sum of ``part(batch)``, ``size`` doubles, over all Arrow batches of ``df``.

    A task adds up its own batches and gives one row back. If there are many tasks, groups of about the
    square root of their number are added before the driver adds the groups, so that what reaches it stays small.
    ``tasks``: the number of partitions of ``df``, for callers that know it (asking costs another planning of the query).
    """
    ship_package(df.sparkSession)

    def row(found: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], names=["s"])

    def run(batches):
        found = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                found += part(batch)
        yield row(found)

    def add(batches):
        found = np.zeros(size)
        for batch in batches:
            for s in batch.column(0).to_pylist():
                found += np.frombuffer(s)
        yield row(found)

    sums = df.mapInArrow(run, "s binary")
    groups = isqrt(df.rdd.getNumPartitions() if tasks is None else tasks)
    if groups > 8:
        sums = sums.repartition(groups).mapInArrow(add, "s binary")
    found = np.zeros(size)
    for s in sums.toArrow()["s"].to_pylist():
        found += np.frombuffer(s)
    return found
