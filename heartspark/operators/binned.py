"""Features as small bin numbers, packed in blocks of rows: what tree growers read once a pass.

A feature's cuts lie halfway between neighbouring values where it has few of them (so that no split is
lost), else at quantiles. A row's bin is the number of cuts below its value.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..session import ship_package

MOST_BINS = 128
BLOCK_ROWS = 1 << 14


@dataclass(frozen=True)
class Bins:
    names: list[str]
    cuts: list[np.ndarray]

    @property
    def starts(self) -> np.ndarray:
        """Where each feature's bins begin among all bins, and their number at the end."""
        return np.concatenate([[0], np.cumsum([len(c) + 1 for c in self.cuts])]).astype(np.int64)

    def codes(self, columns: list[np.ndarray]) -> np.ndarray:
        """Features x rows."""
        return np.stack([np.searchsorted(c, x, side="left").astype(np.uint8) for c, x in zip(self.cuts, columns)])


#: Cells of a group of features, whose code is a byte.
CELLS = 256


class Packs:
    """Groups of features whose bins are counted and kept together, as one byte a group: fewer numbers to count, and the
    features' own counts are sums of theirs. A group has at most ``CELLS`` cells."""

    def __init__(self, bins: Bins):
        self.starts, self.widths = bins.starts, [len(c) + 1 for c in bins.cuts]
        self.groups: list[list[int]] = []
        for f in sorted(range(len(self.widths)), key=lambda f: -self.widths[f]):
            own = next((g for g in self.groups if np.prod([self.widths[i] for i in g]) * self.widths[f] <= CELLS), None)
            if own is None:
                self.groups.append([f])
            else:
                own.append(f)
        self.shapes = [[self.widths[f] for f in g] for g in self.groups]
        self.sizes = [int(np.prod(shape)) for shape in self.shapes]
        #: Of each feature, its group, and its bin in every cell of that group.
        self.group, self.bin = np.zeros(len(self.widths), np.int64), np.zeros((len(self.widths), CELLS), np.uint8)
        for i, (g, shape, size) in enumerate(zip(self.groups, self.shapes, self.sizes)):
            for f, at in zip(g, np.unravel_index(np.arange(size), shape)):
                self.group[f], self.bin[f, :size] = i, at

    def codes(self, codes: np.ndarray) -> np.ndarray:
        """Groups x rows, from features x rows."""
        return np.stack([np.ravel_multi_index(tuple(codes[g]), shape).astype(np.uint8) for g, shape in zip(self.groups, self.shapes)])

    def spread(self, sums: np.ndarray, n: int) -> np.ndarray:
        """(n, kinds, bins of all features) from kinds x (of each group, n x its cells)."""
        out, at = np.zeros((n, len(sums), int(self.starts[-1]))), 0
        for group, shape, size in zip(self.groups, self.shapes, self.sizes):
            cells = sums[:, at:at + n * size].reshape(len(sums), n, *shape)
            for i, f in enumerate(group):
                out[:, :, self.starts[f]:self.starts[f + 1]] = cells.sum(axis=tuple(2 + j for j in range(len(group)) if j != i)).swapaxes(0, 1)
            at += n * size
        return out


def learn_bins(df: DataFrame, names: list[str], most: int = MOST_BINS) -> Bins:
    """Two aggregates: about how many values each feature has, then these or quantiles of them."""
    about = df.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first()
    few = {c: (about[c] or 0) <= most * 3 // 4 for c in names}
    probs = [i / most for i in range(1, most)]
    found = df.agg(*[F.sort_array(F.collect_set(F.col(c).cast("double"))).alias(c) if few[c] else
                     F.percentile_approx(F.col(c).cast("double"), probs, 10_000).alias(c) for c in names]).first()
    cuts = []
    for c in names:
        values = np.unique(np.array(found[c] or [], float))
        cuts.append((values[1:] + values[:-1]) / 2 if few[c] and len(values) <= most else values)
    return Bins(names, cuts)


def packed(df: DataFrame, bins: Bins, label: str = S.TARGET, fold: str = "fold", key: str = "respondent_id", block: int = BLOCK_ROWS) -> DataFrame:
    """Blocks (codes, y, fold, id) of at most ``block`` rows each, as bytes."""
    ship_package(df.sparkSession)
    d = len(bins.names)

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, block):
                part = batch.slice(a, block)
                columns = [part.column(i).to_numpy(zero_copy_only=False) for i in range(d)]
                rest = [np.ascontiguousarray(part.column(d + i).to_numpy(zero_copy_only=False).astype(t)).tobytes()
                        for i, t in enumerate((np.uint8, np.int8, np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in (bins.codes(columns).tobytes(), *rest)], names=["codes", "y", "fold", "id"])

    rows = df.select(*[F.col(c).cast("double").alias(c) for c in bins.names], F.col(label).cast("int").alias("y"),
                     F.col(fold).cast("int").alias("fold"), F.col(key).cast("long").alias("id"))
    return rows.mapInArrow(run, "codes binary, y binary, fold binary, id binary")


def block_of(batch: pa.RecordBatch, i: int, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, y, fold, id) of a packed row."""
    codes, y, fold, key = (batch.column(k)[i].as_buffer() for k in range(4))
    return np.frombuffer(codes, np.uint8).reshape(d, -1), np.frombuffer(y, np.uint8), np.frombuffer(fold, np.int8), np.frombuffer(key, np.int64)
