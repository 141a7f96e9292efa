"""Gradient-boosted trees for many settings and folds at once, by shared histograms.

All models grow side by side. One pass over the rows adds up, for each model, each tree node of its
present level and each bin of each feature, the gradients and Hessians of the weighted log loss; the
driver takes the best splits from these sums, whose size depends on models, nodes and bins and not
on the rows. Of two sister nodes the pass sums only the lighter one; the other is the parent less it.
A leaf's value is the Newton step -eta G / (H + lambda), and a split must gain by the same penalised
objective and leave a Hessian of ``least_weight`` on both sides.

Models of different depths go through their own rounds at their own pace; a pass serves whichever
level each is at.

Margins of finished trees are kept with the rows: each pass adds the few trees that are newer than
the kept margins. Once passes have spent as long on these as new margins would take, new margins are made from the old and persisted (lost
parts are made again from their parents; every so often the chain is cut by a checkpoint). So a pass costs a row a few levels of trees,
however many trees there are. Features of few bins are kept and counted together, as ``binned.Packs``: a row is a few bytes and its margins.

Up to ``LOCAL_ROWS`` rows a model is grown by one task by the same steps, which gets the rows that the model learns from or holds out, some 20 bytes
each: a pass as a job costs more than its work there. It goes through them in stretches that a processor's cache holds.

Ties in gain go to the first feature, then the lowest cut. Rows of a model's held-out fold get margins and don't train.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..session import cut_lineage, ship_package, spread_out
from .binned import BLOCK_ROWS, CELLS, Bins, Packs, block_of, learn_bins, packed
from .passes import summed

#: Trees of a model, and of all models, that passes add to the kept margins, at most; margins that are made from margins before a checkpoint.
NEW_TREES, ALL_NEW_TREES, CHAIN = 32, 240, 12
NO_GAIN = 1e-9
MADE = 100
TASK_WORK = 1 << 15  # rows times models that are worth a task
#: Nanoseconds, about: of a row at one level of a tree; of new margins by themselves, of a row in them, and of a row and model.
LEVEL_NS, RENEWAL_NS, RENEWED_ROW_NS, RENEWED_MODEL_NS = 15, 50e6, 100, 110
#: Nodes of a level that are looked up one by one, at most.
FEW_NODES = 8
#: Rows of a model up to which it is grown by one task, and how many of them it works on at once, at least.
LOCAL_ROWS, STRETCH = 1 << 23, 1 << 14


@dataclass(frozen=True)
class Setting:
    depth: int
    rate: float = 0.1
    penalty: float = 1.0
    rounds: int = 300
    least_weight: float = 1.0


@dataclass
class Tree:
    """Nodes in heap order: the children of node i are 2 i + 1 (bin <= cut) and 2 i + 2. ``feature`` is -1 at leaves and unused places."""
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    weight: np.ndarray  # sum of Hessians

    @staticmethod
    def empty(depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1, np.int16), np.zeros(n, np.uint8), np.zeros(n), np.zeros(n))

    def nodes(self, codes: np.ndarray, levels: int) -> np.ndarray:
        """The node that each row is in after ``levels`` splits, or the leaf where it stopped before."""
        n = codes.shape[1]
        flat, rows = codes.ravel(), np.arange(n)
        feature, at = self.feature.astype(np.int64), np.zeros(n, np.int64)
        for _ in range(levels):
            f = feature.take(at)
            right = flat.take(np.maximum(f, 0) * n + rows) > self.cut.take(at)
            at = np.where(f >= 0, 2 * at + 1 + right, at)
        return at


class Route:
    """The ways down the first ``levels`` levels of a tree, by codes of groups: of each node its group, and the next node of each cell (a leaf's is itself)."""

    def __init__(self, tree: Tree, levels: int, packs: Packs):
        n = 2 ** levels - 1
        f = tree.feature[:n].astype(np.int64)
        nodes = np.arange(n)[:, None]
        self.levels, self.group = levels, np.concatenate([packs.group[f], np.zeros(n + 1, np.int64)])
        down = np.where(f[:, None] >= 0, 2 * nodes + 1 + (packs.bin[f] > tree.cut[:n, None]), nodes)
        self.next = down.ravel()

    def down(self, groups: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
        cell = groups.ravel().take(self.group.take(at) * groups.shape[1] + rows)
        return self.next.take(at * CELLS + cell)

    def nodes(self, groups: np.ndarray) -> np.ndarray:
        """The node that each row of groups x rows is in after all levels, or the leaf where it stopped before."""
        rows = np.arange(groups.shape[1])
        at = np.zeros(len(rows), np.int64)
        for _ in range(self.levels):
            at = self.down(groups, at, rows)
        return at


@dataclass
class Growing:
    """A model on its way: its setting, its held-out fold, its trees, and the present tree's level."""
    setting: Setting
    held: int
    share: float = 1.0  # of the rows that aren't held out, those that train: the first by hash of id, so that smaller shares are part of greater ones
    trees: list[Tree] = field(default_factory=list)
    kept: int = 0  # trees that the kept margins have
    tree: Tree | None = None
    level: int = 0
    slots: dict[int, int] = field(default_factory=dict)  # node -> place among those that the next pass sums
    sisters: dict[int, tuple[int, int]] = field(default_factory=dict)  # node that is left out -> (its sister, its parent)
    sums: dict[int, np.ndarray] = field(default_factory=dict)  # of the level before

    def start(self) -> None:
        self.tree, self.level, self.slots, self.sisters, self.sums = Tree.empty(self.setting.depth), 0, {0: 0}, {}, {}

    def done(self) -> bool:
        return len(self.trees) >= self.setting.rounds


def best_splits(sums: np.ndarray, starts: np.ndarray, penalty: float, least_weight: float) -> tuple[np.ndarray, ...]:
    """(gain, feature, cut, sums on the left) of each node from (nodes, 2, bins) sums; gain 0 where no split is better than none."""
    g, h = sums[:, :, :starts[1]].sum(axis=2).T[:, :, None]  # of each node
    both = np.cumsum(sums, axis=2)
    left = both - np.repeat(np.concatenate([np.zeros((len(sums), 2, 1)), both], axis=2)[:, :, starts[:-1]], np.diff(starts), axis=2)
    gl, hl = left[:, 0], left[:, 1]
    gr, hr = g - gl, h - hl
    least = least_weight * (1 - NO_GAIN)  # sums of the least weight itself may come out a rounding below
    ok = (hl >= least) & (hr >= least)
    ok[:, starts[1:] - 1] = False  # a feature's last bin has nothing on its right
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(ok, gl ** 2 / (hl + penalty) + gr ** 2 / (hr + penalty) - g * g / (h + penalty), 0.0)
    most = gain.max(axis=1, initial=0.0)
    at = np.argmax(gain >= (most - NO_GAIN * most)[:, None], axis=1)
    f = np.searchsorted(starts, at, side="right") - 1
    return np.where(most > NO_GAIN, most, 0.0), f, at - starts[f], left[np.arange(len(sums)), :, at]


def advance(m: Growing, found: np.ndarray, starts: np.ndarray) -> None:
    """Takes a pass's (slots, 2, bins) sums of a model's level, splits its nodes, and goes to the next level or tree."""
    sums = {node: found[k] for node, k in m.slots.items()}
    for node, (sister, parent) in m.sisters.items():
        sums[node] = m.sums[parent] - sums[sister]
    nodes = sorted(sums)
    tree, s = m.tree, m.setting
    gain, feature, cut, left = best_splits(np.stack([sums[k] for k in nodes]), starts, s.penalty, s.least_weight)
    m.slots, m.sisters, m.sums = {}, {}, sums
    for i, node in enumerate(nodes):
        total = sums[node][:, :starts[1]].sum(axis=1)
        tree.weight[node] = total[1]
        if gain[i] <= 0:
            tree.value[node] = -s.rate * total[0] / (total[1] + s.penalty) if total[1] + s.penalty > 0 else 0.0
            continue
        tree.feature[node], tree.cut[node] = feature[i], cut[i]
        a, b = 2 * node + 1, 2 * node + 2
        for child, (g, h) in ((a, left[i]), (b, total - left[i])):
            tree.value[child], tree.weight[child] = -s.rate * g / (h + s.penalty), h
        light, other = (a, b) if left[i][1] <= total[1] - left[i][1] else (b, a)
        m.slots[light] = len(m.slots)
        m.sisters[other] = (light, node)
    m.level += 1
    if m.level == s.depth or not m.slots:
        m.trees.append(tree)
        if not m.done():
            m.start()


def trains(m: Growing, fold: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Which rows a model learns from. Folds from MADE on hold made rows, each fold's only for the model that holds it out."""
    return (fold != m.held) & ((fold < MADE) | (fold == MADE + m.held)) & (order < m.share)


def order_of(ids: np.ndarray) -> np.ndarray:
    """Where rows stand by hash of id, from 0 to 1."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0 ** -53


def routes(m: Growing, packs: Packs) -> list[tuple[Route, np.ndarray]]:
    """Of newer trees than the kept margins have, the ways down and the values."""
    return [(Route(tree, m.setting.depth, packs), tree.value) for tree in m.trees[m.kept:]]


def margins_of(new: list[tuple[Route, np.ndarray]], groups: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Kept margins and what newer trees add."""
    out = kept
    for route, value in new:
        out = out + value.take(route.nodes(groups))
    return out


def slots_of(m: Growing) -> np.ndarray:
    """Of each node of the tree, its place among those to sum, or -1."""
    slot = np.full(len(m.tree.feature), -1, np.int64)
    slot[list(m.slots)] = list(m.slots.values())
    return slot


def add_sums(out: np.ndarray, groups: np.ndarray, own: np.ndarray | None, slots: np.ndarray | None, y: np.ndarray, margin: np.ndarray, n: int, positive: float, packs: Packs) -> None:
    """Adds to ``out``, (2, n slots x cells of each group), the gradients and Hessians of the rows ``own`` (None: all), which have these slots, labels and margins."""
    p, weight = 1.0 / (1.0 + np.exp(-margin)), np.where(np.arange(256) == 1, positive, 1.0).take(y)
    both, done = (weight * (p - y), np.maximum(weight * p * (1 - p), 1e-16)), 0
    for group, size in zip(groups, packs.sizes):
        at = (group if own is None else group.take(own)).astype(np.int64)
        if n > 1:
            at += slots * size
        for j in range(2):
            out[j, done:done + n * size] += np.bincount(at, both[j], n * size)
        done += n * size


def block_rows(batch: pa.RecordBatch, i: int, n_groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(groups, y, fold, order) of a row with margins; the order is 0 where ids weren't kept."""
    groups, y, fold, key = (np.frombuffer(batch.column(k)[i].as_buffer(), t) for k, t in enumerate((np.uint8, np.uint8, np.int8, np.int64)))
    return groups.reshape(n_groups, -1), y, fold, order_of(key) if len(key) else np.zeros(1)


def _level_sums(rows: DataFrame, models: list[Growing], active: list[int], packs: Packs, positive: float, tasks: int | None = None) -> list[np.ndarray]:
    """Of each active model, the (slots, 2, bins) sums of its level."""
    width, n_models, n_groups = int(packs.starts[-1]), len(models), len(packs.groups)
    ends = np.cumsum([0] + [len(models[k].slots) * 2 * width for k in active])
    light = [(k, replace(models[k], trees=models[k].trees[models[k].kept:], kept=0, sisters={}, sums={})) for k in active]

    def part(batch: pa.RecordBatch) -> np.ndarray:
        ready = [(k, m, Route(m.tree, m.level, packs), slots_of(m), routes(m, packs), np.zeros((2, len(m.slots) * sum(packs.sizes)))) for k, m in light]
        for i in range(batch.num_rows):
            groups, y, fold, order = block_rows(batch, i, n_groups)
            kept = np.frombuffer(batch.column(4)[i].as_buffer()).reshape(n_models, -1)
            learns = {}
            for k, m, route, slot, new, out in ready:
                if (m.held, m.share) not in learns:
                    learns[m.held, m.share] = trains(m, fold, order)
                slots = slot.take(route.nodes(groups))
                own = np.flatnonzero((slots >= 0) & learns[m.held, m.share])
                if len(own):
                    margin = kept[k].take(own)
                    if new:
                        margin = margins_of(new, groups.take(own, axis=1), margin)
                    add_sums(out, groups, own, slots.take(own), y.take(own), margin, len(m.slots), positive, packs)
        return np.concatenate([packs.spread(out, len(m.slots)).ravel() for _, m, _, _, _, out in ready])

    found = summed(rows, part, int(ends[-1]), tasks)
    return [found[ends[j]:ends[j + 1]].reshape(-1, 2, width) for j in range(len(active))]


def _with_margins(rows: DataFrame, models: list[Growing], packs: Packs) -> DataFrame:
    """The rows with margins of all finished trees."""
    light, names = [replace(m, trees=m.trees[m.kept:], kept=0, tree=None, sisters={}, sums={}) for m in models], rows.columns

    def run(batches):
        new = [routes(m, packs) for m in light]
        for batch in batches:
            for i in range(batch.num_rows):
                groups = block_rows(batch, i, len(packs.groups))[0]
                kept = np.frombuffer(batch.column(4)[i].as_buffer()).reshape(len(light), -1)
                now = np.stack([margins_of(x, groups, kept[k]) for k, x in enumerate(new)])
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(i, 1) for c in range(4)], pa.array([now.tobytes()], pa.binary())], names=names)

    return rows.mapInArrow(run, rows.schema)


def _in_groups(rows: DataFrame, n: int, packs: Packs, ids: bool) -> DataFrame:
    """(groups, y, fold, id, margins) of packed rows: margins of 0 for ``n`` models; ids only where asked for."""
    d = len(packs.widths)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                codes, y, fold, key = block_of(batch, i, d)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (packs.codes(codes), y, fold, key if ids else key[:0], np.zeros((n, len(y))))],
                                                 names=["groups", "y", "fold", "id", "margins"])

    return rows.mapInArrow(run, "groups binary, y binary, fold binary, id binary, margins binary")


def node_type(depth: int) -> type:
    """The least type for nodes of a tree."""
    return np.uint8 if depth <= 7 else np.int32


class Step:
    """The way down one level of a tree: node and cells of a stretch of rows to the next nodes. A few nodes are looked up one by one, more by ``Route``."""

    def __init__(self, tree: Tree, level: int, packs: Packs):
        self.level, self.split = level, [k for k in range(2 ** level - 1, 2 ** (level + 1) - 1) if tree.feature[k] >= 0]
        self.route = Route(tree, level + 1, packs) if len(self.split) > FEW_NODES else None
        self.right = [(int(packs.group[f]), (packs.bin[f] > tree.cut[k]).astype(np.uint8)) for k in self.split for f in [int(tree.feature[k])]]

    def down(self, groups: np.ndarray, at: np.ndarray) -> np.ndarray:
        if self.route is not None:
            return self.route.down(groups, at.astype(np.int64), np.arange(groups.shape[1])).astype(at.dtype)
        if not self.split:
            return at
        if self.level == 0:
            (g, right), = self.right
            return (right.take(groups[g]) + 1).astype(at.dtype)
        # Arithmetic on bytes instead of choices: 2 at + 1 or 2 for rows that are in a split node.
        add = np.zeros(len(at), np.uint8)
        for k, (g, right) in zip(self.split, self.right):
            add += (right.take(groups[g]) + np.uint8(1)) * (at == k)
        return at + (at * (add > 0) + add).astype(at.dtype)


class Look:
    """A tree of at most eight leaves as masks: every cell of a group leaves the leaves that its splits allow, and the first
    leaf that all groups leave is a row's."""

    def __init__(self, tree: Tree, depth: int, packs: Packs):
        leaves, groups = [], {}

        def walk(node: int) -> int:
            """Numbers the leaves below a node from the left; masks of the node's split: rows that go right lose the leaves on the left."""
            first = len(leaves)
            f = int(tree.feature[node])
            if f < 0:
                leaves.append(tree.value[node])
                return first
            walk(2 * node + 1)
            left = (1 << len(leaves)) - (1 << first)
            walk(2 * node + 2)
            mask = groups.setdefault(int(packs.group[f]), np.full(CELLS, 255, np.uint8))
            mask[packs.bin[f] > tree.cut[node]] &= np.uint8(255 - left)
            return first

        walk(0)
        self.masks = list(groups.items())
        first = [(k & -k).bit_length() - 1 for k in range(256)]
        self.value = np.array([leaves[i] if 0 <= i < len(leaves) else 0.0 for i in first])

    def values(self, groups: np.ndarray) -> np.ndarray:
        """Of the rows of groups x rows."""
        if not self.masks:
            return np.full(groups.shape[1], self.value[1])
        (g, mask), *others = self.masks
        left = mask.take(groups[g])
        for g, mask in others:
            left &= mask.take(groups[g])
        return self.value.take(left)


def margins_by(trees: list[Tree], depth: int, packs: Packs, groups: np.ndarray) -> np.ndarray:
    """The sums of the trees' values, of the rows of groups x rows."""
    out = np.zeros(groups.shape[1])
    if depth <= 3:
        looks = [Look(tree, depth, packs) for tree in trees]
        for a in range(0, len(out), STRETCH):
            some = groups[:, a:a + STRETCH].astype(np.int64)
            for look in looks:
                out[a:a + STRETCH] += look.values(some)
    else:
        steps = [([Step(tree, k, packs) for k in range(depth)], tree.value) for tree in trees]
        for a in range(0, len(out), STRETCH):
            some = np.ascontiguousarray(groups[:, a:a + STRETCH])
            for downs, value in steps:
                at = np.zeros(some.shape[1], node_type(depth))
                for step in downs:
                    if step.split:
                        at = step.down(some, at)
                out[a:a + STRETCH] += value.take(at)
    return out


def grown_alone(m: Growing, groups: np.ndarray, y: np.ndarray, positive: float, packs: Packs) -> np.ndarray:
    """Grows all of a model's trees over these rows, which it learns from; gives their margins."""
    margin, at = np.zeros(len(y)), np.zeros(len(y), node_type(m.setting.depth))
    step = value = None  # what the rows have still to go through: the last splits, and the values of a finished tree
    while True:
        over = m.done()
        tree, level, n, slots = m.tree, m.level, len(m.trees), None if over else slots_of(m)
        size = max(STRETCH, 4 * CELLS * (0 if over else len(m.slots)))
        out = np.zeros((2, 0 if over else len(m.slots) * sum(packs.sizes)))
        for a in range(0, len(y), size):
            some, own = groups[:, a:a + size], slice(a, a + size)
            if step is not None:
                at[own] = step.down(some, at[own])
            if value is not None:
                margin[own] += value.take(at[own])
                at[own] = 0
            if over:
                continue
            if level == 0:
                add_sums(out, some, None, None, y[own], margin[own], 1, positive, packs)
            else:
                place = slots.take(at[own])
                there = np.flatnonzero(place >= 0)
                if len(there):
                    add_sums(out, some, there, place.take(there), y[own].take(there), margin[own].take(there), len(m.slots), positive, packs)
        if over:
            return margin
        advance(m, packs.spread(out, len(m.slots)), packs.starts)
        step, value = Step(tree, level, packs), tree.value if len(m.trees) > n else None


def _alone(rows: DataFrame, models: list[Growing], packs: Packs, positive: float) -> DataFrame:
    """Grows each model by one task over the rows that it learns from or holds out, at most ``LOCAL_ROWS``; these rows with the model's margins, once a model."""
    n_groups, names = len(packs.groups), ["groups", "y", "fold", "id", "margins", "model", "trees"]
    schema = "groups binary, y binary, fold binary, id binary, margins binary, model int, trees binary"
    # Most work first.
    work = sorted(range(len(models)), key=lambda k: (-models[k].setting.depth * models[k].setting.rounds * models[k].share, k))
    turn = {k: i for i, k in enumerate(work)}
    light = [replace(m, trees=[], tree=None, sisters={}, sums={}) for m in models]

    def dealt(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                groups, y, fold, order = block_rows(batch, i, n_groups)
                key = np.frombuffer(batch.column(3)[i].as_buffer(), np.int64)
                for k, m in enumerate(light):
                    own = np.flatnonzero((fold == m.held) | trains(m, fold, order))
                    if len(own):
                        parts = groups.take(own, axis=1), y.take(own), fold.take(own), key.take(own) if len(key) else key
                        yield pa.RecordBatch.from_arrays([*[pa.array([x.tobytes()], pa.binary()) for x in parts], pa.array([turn[k]], pa.int32())],
                                                         names=["groups", "y", "fold", "id", "turn"])

    def run(batches):
        blocks: dict[int, list] = {}
        for batch in batches:
            for i, k in enumerate(batch.column(4).to_pylist()):
                blocks.setdefault(work[k], []).append(tuple(batch.column(c)[i].as_py() for c in range(4)))
        for k, own in blocks.items():
            m = models[k]
            own.sort()  # so that sums don't depend on the order in which blocks come
            groups, y, fold, key = (np.concatenate([np.frombuffer(b[c], t).reshape((n_groups, -1) if c == 0 else -1) for b in own], axis=-1)
                                    for c, t in enumerate((np.uint8, np.uint8, np.int8, np.int64)))
            own.clear()
            learns = trains(m, fold, order_of(key) if len(key) else np.zeros(1))
            margins = np.zeros(len(y))
            if learns.all():
                margins = grown_alone(m, groups, y, positive, packs)
            else:
                margins[learns] = grown_alone(m, groups[:, learns], y[learns], positive, packs)
                margins[~learns] = margins_by(m.trees, m.setting.depth, packs, groups[:, ~learns])
            # What reads the margins needs no cells.
            for a in range(0, len(y), BLOCK_ROWS):
                parts = b"", *[x[a:a + BLOCK_ROWS].tobytes() for x in (y, fold, key, margins)]
                trees = None if a else b"".join(getattr(t, f.name).tobytes() for t in m.trees for f in fields(Tree))
                yield pa.RecordBatch.from_arrays([*[pa.array([x], pa.binary()) for x in parts], pa.array([k], pa.int32()), pa.array([trees], pa.binary())], names=names)

    each = rows.mapInArrow(dealt, "groups binary, y binary, fold binary, id binary, turn int").repartitionById(len(models), F.col("turn"))
    done = cut_lineage(each.mapInArrow(run, schema))
    for r in done.where("trees IS NOT NULL").select("model", "trees").toLocalIterator():
        m, at = models[r["model"]], 0
        empty, m.trees = Tree.empty(m.setting.depth), []
        while at < len(r["trees"]):
            parts = []
            for f in fields(Tree):
                like = getattr(empty, f.name)
                parts.append(np.frombuffer(r["trees"], like.dtype, len(like), at))
                at += like.nbytes
            m.trees.append(Tree(*parts))
        m.kept = len(m.trees)
    for m in models:  # of no rows at all
        while not m.done():
            advance(m, np.zeros((len(m.slots), 2, int(packs.starts[-1]))), packs.starts)
    return done.drop("trees")


@dataclass
class Booster:
    """A fitted model by itself."""
    setting: Setting
    trees: list[Tree]
    bins: Bins

    def margins(self, codes: np.ndarray) -> np.ndarray:
        """Of features x rows."""
        packs = Packs(self.bins)
        return margins_by(self.trees, self.setting.depth, packs, packs.codes(codes))

    def to_json(self) -> str:
        return json.dumps({"setting": asdict(self.setting), "names": self.bins.names, "cuts": [c.tolist() for c in self.bins.cuts],
                           "trees": [{f.name: getattr(t, f.name).tolist() for f in fields(Tree)} for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> Booster:
        x = json.loads(text)
        kinds = {"feature": np.int16, "cut": np.uint8, "value": float, "weight": float}
        return Booster(Setting(**x["setting"]), [Tree(**{k: np.array(v, kinds[k]) for k, v in t.items()}) for t in x["trees"]],
                       Bins(x["names"], [np.array(c, float) for c in x["cuts"]]))


@dataclass
class Boosted:
    """All models of a fit, and the rows with their margins."""
    models: list[Growing]
    bins: Bins
    rows: DataFrame
    passes: int

    def counts(self, training: bool = False) -> DataFrame:
        """(grp, score, pos, neg): rows of each model's held-out fold; grp = place of the model among all.
        With ``training`` grp is twice that, and twice that and 1 are the rows that the model learnt from."""
        n_groups, models = len(Packs(self.bins).groups), [replace(m, trees=[], tree=None, sisters={}, sums={}) for m in self.models]

        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    _, y, fold, order = block_rows(batch, i, n_groups)
                    margins = np.frombuffer(batch.column(4)[i].as_buffer()).reshape(-1, len(y))
                    # All models' margins, or those of one.
                    for at, k in enumerate(range(len(models)) if batch.num_columns == 5 else [batch.column(5)[i].as_py()]):
                        m = models[k]
                        parts = [(2 * k, fold == m.held), (2 * k + 1, trains(m, fold, order))] if training else [(k, fold == m.held)]
                        for grp, own in parts:
                            score, place = np.unique(1.0 / (1.0 + np.exp(-margins[at, own])), return_inverse=True)
                            pos = np.bincount(place, y[own], len(score)).astype(np.int64)
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), grp, np.int32)), pa.array(score), pa.array(pos),
                                                              pa.array(np.bincount(place, minlength=len(score)).astype(np.int64) - pos)], names=["grp", "score", "pos", "neg"])

        out = self.rows.mapInArrow(run, "grp int, score double, pos long, neg long")
        return out.groupBy("grp", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))

    def boosters(self) -> list[Booster]:
        return [Booster(m.setting, m.trees, self.bins) for m in self.models]

    def release(self) -> None:
        self.rows.unpersist()


def fit_all(folds: DataFrame, names: list[str], settings: list[Setting], held: list[int], positive: float | None = None, label: str = S.TARGET,
            bins: Bins | None = None, shares: list[float] | None = None) -> Boosted:
    """Models (setting, share of the training rows, held-out fold) in this order of nesting; a held-out fold of -1 holds nothing out.

    ``folds`` has the features, the label, ``fold`` and ``respondent_id``. ``positive``: weight of positive rows, by default as
    many as negatives are per positive.
    """
    ship_package(folds.sparkSession)
    bins = bins or learn_bins(folds, names)
    found = [(int(r[0]), r[1], int(r[2])) for r in folds.groupBy(label, F.col("fold").cast("int")).count().collect()]
    n: dict[int, int] = {}
    for y, _, rows in found:
        n[y] = n.get(y, 0) + rows
    if positive is None:
        positive = n.get(0, 0) / n[1] if n.get(1) else 1.0
    models = [Growing(s, f, share) for s in settings for share in shares or [1.0] for f in held]
    for m in models:
        if not m.done():
            m.start()
    packs, total = Packs(bins), sum(n.values())
    ids = any(m.share < 1.0 for m in models)
    # Rows are read once a level and tree: dealt once to as many tasks as their work is worth, however few files they come from.
    tasks = max(folds.rdd.getNumPartitions(), min(folds.sparkSession.sparkContext.defaultParallelism, total * len(models) // TASK_WORK + 1))
    blocks = cut_lineage(packed(folds.repartition(tasks, "respondent_id"), bins, label))
    if max((sum(rows for _, fold, rows in found if fold is None or fold < MADE or fold == MADE + m.held) for m in models), default=0) <= LOCAL_ROWS:
        return Boosted(models, bins, _alone(_in_groups(blocks, 0, packs, ids), models, packs, positive), 0)
    rows = _in_groups(blocks, len(models), packs, ids).persist(StorageLevel.MEMORY_AND_DISK)
    each, passes, chain, spent = total / tasks, 0, 0, 0.0
    renewal = RENEWAL_NS + each * (RENEWED_ROW_NS + RENEWED_MODEL_NS * len(models))
    old = None
    while active := [k for k, m in enumerate(models) if not m.done()]:
        for k, found in zip(active, _level_sums(rows, models, active, packs, positive, tasks)):
            advance(models[k], found, bins.starts)
        passes += 1
        if old is not None:  # the pass has made the new margins
            old.unpersist()
            old = None
        new = [len(m.trees) - m.kept for m in models]
        spent += each * LEVEL_NS * sum(m.setting.depth * t for m, t in zip(models, new) if not m.done())
        if max(new) >= NEW_TREES or sum(new) >= ALL_NEW_TREES or (max(new) and spent >= renewal) or all(m.done() for m in models):
            old, spent = rows, 0.0
            rows, chain = _renewed(rows, models, packs, chain)
    return Boosted(models, bins, rows, passes)


def _renewed(rows: DataFrame, models: list[Growing], packs: Packs, chain: int) -> tuple[DataFrame, int]:
    """Rows whose kept margins have all trees; whatever reads them next makes them."""
    new = _with_margins(rows, models, packs)
    chain = (chain + 1) % CHAIN
    if chain == 0:
        new = cut_lineage(new)
    for m in models:
        m.kept = len(m.trees)
    return new.persist(StorageLevel.MEMORY_AND_DISK), chain


def scores(df: DataFrame, models: list[Booster], names: list[str]) -> DataFrame:
    """``df`` with each model's probability of a positive row; the models have the same bins."""
    ship_package(df.sparkSession)
    bins = models[0].bins
    shared = df.sparkSession.sparkContext.broadcast(models)
    d, columns = len(bins.names), [*df.columns, *names]

    def run(batches):
        for batch in batches:
            n = batch.num_columns - d
            codes = bins.codes([batch.column(n + i).to_numpy(zero_copy_only=False) for i in range(d)])
            found = [pa.array(1.0 / (1.0 + np.exp(-m.margins(codes)))) for m in shared.value]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(n)], *found], names=columns)

    df = spread_out(df)
    features = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(bins.names)]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + [f"`{name}` double" for name in names])
    return df.select("*", *features).mapInArrow(run, schema)
