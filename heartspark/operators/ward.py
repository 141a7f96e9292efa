"""Ward linkage of a whole table through weighted micro-clusters.

Where there are at most ``MOST_MICRO`` distinct points, each is a micro-cluster and the linkage is that of all
rows. Otherwise points are put to ``MOST_MICRO`` centres by k-means passes that start from points drawn by hash,
and the linkage joins the centres with their weights: a merge costs wa wb / (wa + wb) |ca - cb|^2, the
growth of the squared distances within, whatever is inside. The nearest-neighbour chain takes time and space of
the square of the micro-clusters only. Heights are the square root of twice a merge's cost, so that two
single points merge at their distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import lloyd
from .lloyd import Points

MOST_MICRO = 1000
MICRO_PASSES = 12


def micro_clusters(points: Points, most: int = MOST_MICRO) -> tuple[np.ndarray, np.ndarray]:
    """(centres, weights), at most ``most`` of them."""
    d = points.width

    def run(batches):
        for batch in batches:
            for b in range(batch.num_rows):
                x, w = lloyd.block(batch, b, d)
                h = lloyd.uniform(lloyd.point_hashes(x), 7)
                at = np.argsort(h, kind="stable")[:most]
                yield pa.RecordBatch.from_arrays([pa.array(h[at]), pa.array([x[i].tobytes() for i in at], pa.binary()), pa.array(w[at])], names=["h", "x", "w"])

    rows = points.blocks.mapInArrow(run, "h double, x binary, w double").orderBy("h", "x").limit(most).collect()
    centres = np.array([np.frombuffer(bytes(r["x"])) for r in rows]).reshape(-1, d)
    if points.n <= most:
        return centres, np.array([r["w"] for r in rows])
    (run_,), _ = lloyd.fit_all(points, [(most, 0)], [centres], most=MICRO_PASSES)
    (weights, sums, _), = lloyd.cluster_sums(points, [run_.centres])
    full = weights > 0
    return sums[full] / weights[full][:, None], weights[full]


def linkage(centres: np.ndarray, weights: np.ndarray) -> list[tuple[int, int, float, float]]:
    """Merges (a, b, height, weight) in order of height; clusters 0 to n - 1 are the given ones, merge i makes cluster n + i."""
    n = len(centres)
    if n < 2:
        return []
    c, w = centres.astype(float).copy(), weights.astype(float).copy()
    open_ = np.ones(n, bool)
    found, chain = [], []

    def costs(i: int) -> np.ndarray:
        out = w * w[i] / (w + w[i]) * ((c - c[i]) ** 2).sum(axis=1)
        out[~open_] = np.inf
        out[i] = np.inf
        return out

    for _ in range(n - 1):
        if not chain:
            chain.append(int(np.argmax(open_)))
        while True:
            cost = costs(chain[-1])
            near = int(np.argmin(cost))
            if len(chain) > 1 and cost[chain[-2]] <= cost[near]:
                near = chain[-2]  # of equals the one before, so that the chain ends
            if len(chain) > 1 and near == chain[-2]:
                break
            chain.append(near)
        b, a = chain.pop(), chain.pop()
        found.append((min(a, b), max(a, b), float(np.sqrt(2 * cost[a])), w[a] + w[b]))
        keep, gone = min(a, b), max(a, b)
        c[keep] = (w[a] * c[a] + w[b] * c[b]) / (w[a] + w[b])
        w[keep] = w[a] + w[b]
        open_[gone] = False
    # The chain finds merges out of order; sorted by height, places become cluster numbers.
    number, out = list(range(n)), []
    for a, b, height, weight in sorted(found, key=lambda m: m[2]):
        x, y = _root(number, a), _root(number, b)
        out.append((min(x[1], y[1]), max(x[1], y[1]), height, weight))
        _join(number, x[0], y[0], n + len(out) - 1)
    return out


def _root(number: list, place: int) -> tuple[int, int]:
    """The place whose entry is a cluster number, following entries that name another place, and that number."""
    while isinstance(number[place], tuple):
        place = number[place][0]
    return place, number[place]


def _join(number: list, a: int, b: int, new: int) -> None:
    number[a], number[b] = new, (a,)


def groups(merges: list[tuple[int, int, float, float]], n: int, k: int) -> np.ndarray:
    """Labels 0 to k - 1 of the n micro-clusters after all but the last k - 1 merges, numbered by their least member."""
    of = {i: [i] for i in range(n)}
    for i, (a, b, _, _) in enumerate(merges[:max(0, n - k)]):
        of[n + i] = of.pop(a) + of.pop(b)
    labels = np.zeros(n, int)
    for label, members in enumerate(sorted(of.values(), key=min)):
        labels[members] = label
    return labels
