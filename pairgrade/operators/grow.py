"""Forests on more rows than MLlib's fit carries in time.

MLlib sends a dense histogram of every open node from every partition, in as
many passes a level as ``max_memory_mb`` asks for; deep levels have hundreds of
thousands of open nodes, most of a few rows.  Here only nodes of more than
``LOCAL_ROWS`` rows are split that way, all trees in one job a level.  Then the
rows go once, binned, to the node they have come to in each tree, and one task
grows all that is below a node.  The nodes never meet in the driver but for
those above.

Splits look at a row's bins only.  Where the features have far fewer bins than
there are rows, rows of the same bins (and class) are added up first, with the
weights that they have in each tree: the same sums, so the same splits, from as
many entries as there are cells.

Splits are MLlib's: bins from the midpoints of a sample's values (as many rows
as MLlib takes), Poisson weights, features drawn for each node, the greatest
gain and of equal ones the first, leaves of the same class united.  Without
draws (one tree, no ``bootstrap``) the tree is MLlib's.  The draws are a function of the seed, the
tree and the node or the row's place in the layout, so other than MLlib's.
Nodes are numbered by place (root 0, children of n 2n + 1 and 2n + 2).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairgrade.sources.sinks import Scratch, materialize

#: Rows (by weight) of a node below which one task grows the rest.
LOCAL_ROWS = 400_000
#: Rows on a cell of bins (and class) that may occur, from which on rows are added up by cell;
#: the rows of an entry that count in ``LOCAL_ROWS`` as one, at most.
MERGE_ROWS, MERGED_LOCAL = 2, 8
#: Rows of a cell in one block from which on the cell is dealt by its partition, too.
HOT_ROWS = 64
#: Rows whose bins are added up in one task, and rows that are dealt at once.
MERGE_PART, DEAL_ROWS = 1 << 19, 1 << 19
#: Rows of a block, and cells of the histograms that are looked at at once.
BLOCK_ROWS = 1 << 16
CELLS = 1 << 21
EPSILON = 2.0 ** -52

_NODES = ("tree_id int, node_id int, is_leaf boolean, feature int, threshold double, left_child int, right_child int, "
          "prediction double, impurity double, gain double, count long, stats array<double>")


@dataclass
class Plan:
    """What all tasks of a fit know."""

    kind: str
    stats: int  # classes, or 3: count, sum, sum of squares
    trees: int
    max_depth: int
    per_node: int  # features drawn for a node
    min_instances: int
    seed: int
    splits: list[np.ndarray] = field(default_factory=list)  # thresholds of each feature
    merged: bool = False  # blocks have sums by cell, not rows

    @property
    def bins(self) -> int:
        return max(len(s) for s in self.splits) + 1

    @property
    def bin_type(self):
        return np.int16 if self.bins > 256 else np.uint8

    @property
    def weight_type(self):
        return np.uint8 if not self.merged else np.int32 if self.kind == "class" else np.float64

    def cells(self) -> int:
        """The cells of bins (and class) that there may be."""
        return math.prod(len(s) + 1 for s in self.splits) * (self.stats if self.kind == "class" else 1)


def features_per_node(kind: str, features: int, trees: int) -> int:
    """MLlib's ``auto``."""
    if trees == 1:
        return features
    return math.ceil(math.sqrt(features)) if kind == "class" else math.ceil(features / 3)


def split_points(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Thresholds of one feature from a sample of its values, as MLlib has them."""
    found, counts = np.unique(values, return_counts=True)
    middle = (found[:-1] + found[1:]) / 2
    wanted = min(max_bins, max(len(values), 2)) - 1
    if len(middle) <= wanted:
        return middle
    stride = len(values) / (wanted + 1)
    target, before, out = stride, counts[0], []
    for n in range(1, len(found)):
        now = before + counts[n]
        if abs(before - target) < abs(now - target):
            out.append(middle[n - 1])
            target += stride
        before = now
    return np.array(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn_features(plan: Plan, tree: int, ids: np.ndarray) -> np.ndarray:
    """(nodes, per_node) features of the nodes ``ids``."""
    count = len(plan.splits)
    if plan.per_node >= count:
        return np.tile(np.arange(count), (len(ids), 1))
    with np.errstate(over="ignore"):
        base = np.uint64(plan.seed % (1 << 64)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tree + 1)
        rows = _mix(_mix(np.full(1, base)) + ids.astype(np.uint64))
        cells = _mix(rows[:, None] + np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.argsort(cells, axis=1, kind="stable")[:, :plan.per_node]


def impurity(plan: Plan, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weight, impurity) by the last axis of ``stats``: gini or variance."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if plan.kind == "reg":
            n = stats[..., 0]
            value = (stats[..., 2] - stats[..., 1] * stats[..., 1] / n) / n
        else:
            n = stats.sum(axis=-1)
            value = np.ones(n.shape)
            for c in range(stats.shape[-1]):
                share = stats[..., c] / n
                value -= share * share
    return n, np.where(n > 0, value, 0.0)


def prediction(plan: Plan, stats: np.ndarray) -> np.ndarray:
    return stats[..., 1] / stats[..., 0] if plan.kind == "reg" else stats.argmax(axis=-1).astype(float)


@dataclass
class Best:
    """The best split of each of some nodes."""

    gain: np.ndarray  # not above 0: none
    feature: np.ndarray
    bin: np.ndarray
    total: np.ndarray
    impurity: np.ndarray
    left: np.ndarray
    right: np.ndarray


def best_splits(plan: Plan, hist: np.ndarray, drawn: np.ndarray) -> Best:
    """``hist``: (nodes, drawn features, bins, stats)."""
    left = hist.cumsum(axis=2)
    total = left[:, 0, -1]
    right = left[:, :, -1:] - left[:, :, :-1]
    left = left[:, :, :-1]
    n, own = impurity(plan, total)
    (ln, li), (rn, ri) = impurity(plan, left), impurity(plan, right)
    at = n[:, None, None]
    gain = own[:, None, None] - ln / at * li - rn / at * ri
    gain = np.where((ln >= plan.min_instances) & (rn >= plan.min_instances), gain, -np.inf).reshape(len(hist), -1)
    if not gain.shape[1]:
        none = np.zeros(len(hist), np.int64)
        return Best(np.full(len(hist), -np.inf), none, none, total, own, total, total)
    place, nodes = gain.argmax(axis=1), np.arange(len(hist))
    j, b = np.divmod(place, plan.bins - 1)
    return Best(gain[nodes, place], drawn[nodes, j], b, total, own, left[nodes, j, b], right[nodes, j, b])


def histograms(plan: Plan, drawn: np.ndarray, node: np.ndarray, bins: np.ndarray, y: np.ndarray | None,
               w: np.ndarray) -> np.ndarray:
    """(nodes, drawn features, bins, stats) of rows in the nodes ``node``; ``bins``: a row's bins;
    ``w``: its weight, or (regression) weight, weighted label and weighted square."""
    count, wide, s = len(drawn), plan.bins, plan.stats
    out = np.empty((count, drawn.shape[1], wide, s))
    flat, base, first = bins.reshape(-1), np.arange(len(node)) * bins.shape[1], node * wide
    for j in range(drawn.shape[1]):
        cell = first + flat.take(base + drawn[:, j].take(node))
        if plan.kind == "class":
            out[:, j] = np.bincount(cell * s + y, w, count * wide * s).reshape(count, wide, s)
        else:
            for k in range(3):
                out[:, j, :, k] = np.bincount(cell, w[k], count * wide).reshape(count, wide)
    return out


# ---------------------------------------------------------------------------
# Blocks of rows
# ---------------------------------------------------------------------------
def _blocks(trees: int, seed: int, bootstrap: bool):
    """mapInArrow body: the rows of a partition as blocks: features and labels as
    doubles, and a weight for each tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held, number, part = [], 0, 0, None

        def block(x, y):
            nonlocal number
            rng = np.random.default_rng([seed % (1 << 32), part, number])
            w = (rng.poisson(1.0, (trees, len(y))) if bootstrap else np.ones((trees, len(y)))).astype(np.uint8)
            number += 1
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()),
                                               "block": pa.array([number - 1], pa.int32()),
                                               "x": [x.tobytes()], "y": [y.tobytes()], "w": [w.tobytes()]})

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch["part"][0].as_py()
            y = batch["y"].to_numpy()
            kept.append((batch["x"].flatten().to_numpy().reshape(len(y), -1), y))
            held += len(y)
            while held >= BLOCK_ROWS:
                x, y = (np.concatenate(v) for v in zip(*kept))
                yield block(x[:BLOCK_ROWS], y[:BLOCK_ROWS])
                kept, held = [(x[BLOCK_ROWS:], y[BLOCK_ROWS:])], held - BLOCK_ROWS
        if held:
            yield block(*(np.concatenate(v) for v in zip(*kept)))

    return run


def _sampled(features: int, share: float, seed: int):
    """mapInArrow body: rows of the blocks, each with the chance ``share``."""
    def run(batches):
        for batch in batches:
            for part, number, x in zip(*(batch[c].to_pylist() for c in ("part", "block", "x"))):
                x = np.frombuffer(x).reshape(-1, features)
                take = np.random.default_rng([seed % (1 << 32), part, number, 1]).random(len(x)) < share
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()),
                                                  "block": pa.array([number], pa.int32()),
                                                  "x": [x[take].tobytes()]})

    return run


def _raw(plan: Plan, batches: Iterator[pa.RecordBatch]):
    """(part, block, bins by row, labels, weights by tree) of each block of rows."""
    for batch in batches:
        for part, number, x, y, w in zip(*(batch[c].to_pylist() for c in ("part", "block", "x", "y", "w"))):
            x, y = np.frombuffer(x).reshape(-1, len(plan.splits)), np.frombuffer(y)
            bins = np.stack([np.searchsorted(s, x[:, f]) for f, s in enumerate(plan.splits)], axis=1)
            yield (part, number, bins.astype(plan.bin_type), y.astype(np.uint16) if plan.kind == "class" else y,
                   np.frombuffer(w, np.uint8).reshape(-1, len(y)))


_BLOCK = "part int, block int, bins binary, y binary, w binary"


def _binned(plan: Plan):
    """mapInArrow body: the blocks with bins in place of features."""
    def run(batches):
        for part, number, bins, y, w in _raw(plan, batches):
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "block": pa.array([number], pa.int32()),
                                              "bins": [bins.tobytes()], "y": [y.tobytes()], "w": [w.tobytes()]})

    return run


def _keys(plan: Plan, bins: np.ndarray) -> np.ndarray:
    """The number of each row's cell of bins."""
    key = np.zeros(len(bins), np.int64)
    for f, split in enumerate(plan.splits):
        key = key * (len(split) + 1) + bins[:, f]
    return key


def _order(values: np.ndarray, top: int) -> np.ndarray:
    """A stable order of whole numbers below ``top`` (numpy sorts short ones by radix)."""
    return np.argsort(values.astype(np.uint16) if top <= 1 << 16 else values, kind="stable")


def _slices(rows: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Runs of rows as bytes, without a copy."""
    rows = np.ascontiguousarray(rows)
    width = rows.itemsize * math.prod(rows.shape[1:])
    ends = (np.append(starts, len(rows)) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(rows.reshape(-1))])


def _starts(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def _same(count: int, value: int) -> pa.Array:
    return pa.array(np.full(count, value, np.int32))


def _by_cell(plan: Plan, parts: int):
    """mapInArrow body: the rows of each block, dealt by their cells.  A cell that
    many rows of a block are in is dealt by the block's partition, too."""
    def run(batches):
        for part, number, bins, y, w in _raw(plan, batches):
            key = _keys(plan, bins)
            _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
            with np.errstate(over="ignore"):
                salt = np.where(counts[inverse] >= HOT_ROWS, np.uint64(part + 1), np.uint64(0))
                to = (_mix(_mix(key.astype(np.uint64)) + salt) % np.uint64(parts)).astype(np.int64)
            order = _order(to, parts)
            starts = _starts(to[order])
            yield pa.RecordBatch.from_pydict({
                "to": pa.array(to[order][starts], pa.int32()), "part": _same(len(starts), part),
                "block": _same(len(starts), number), "bins": _slices(bins[order], starts),
                "y": _slices(y[order], starts), "w": _slices(w.T[order], starts)})

    return run


def _in_order(group: pa.Table) -> pa.Table:
    return group.take(np.lexsort((group["block"].to_numpy(), group["part"].to_numpy())))


def _joined(group: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(group[column].to_pylist()), kind)


def _added_up(plan: Plan):
    """applyInArrow body: the entries of the cells of one part, as blocks."""
    def run(group: pa.Table) -> pa.Table:
        part, group = group["to"][0].as_py(), _in_order(group)
        bins = _joined(group, "bins", plan.bin_type).reshape(-1, len(plan.splits))
        y = _joined(group, "y", np.uint16 if plan.kind == "class" else float)
        w = _joined(group, "w", np.uint8).reshape(len(y), plan.trees)
        key = _keys(plan, bins)
        if plan.kind == "class":
            key = key * plan.stats + y
        found, first, at = np.unique(key, return_index=True, return_inverse=True)
        bins, count = bins[first], len(found)
        if plan.kind == "class":
            sums = np.stack([np.bincount(at, w[:, t], count) for t in range(plan.trees)]).astype(np.int32)
            y = y[first]
        else:
            sums = np.empty((plan.trees, 3, count))
            for t in range(plan.trees):
                own = w[:, t] * y
                for k, v in enumerate((w[:, t], own, own * y)):
                    sums[t, k] = np.bincount(at, v, count)
            y = np.zeros(0)
        blocks = range(0, count, BLOCK_ROWS)
        cut = lambda v: [np.ascontiguousarray(v[..., n:n + BLOCK_ROWS]).tobytes() for n in blocks]
        return pa.table({"part": _same(len(blocks), part), "block": pa.array(range(len(blocks)), pa.int32()),
                         "bins": pa.array([bins[n:n + BLOCK_ROWS].tobytes() for n in blocks], pa.binary()),
                         "y": pa.array(cut(y), pa.binary()), "w": pa.array(cut(sums), pa.binary())})

    return run


def _read(plan: Plan, batches: Iterator[pa.RecordBatch], rows: int = 0):
    """(part, block, bins by row, labels, weights by tree) of each block; blocks of
    one part are joined up to ``rows`` rows.  Sums by cell of a regression have no
    labels; their weights are weight, weighted label and weighted square."""
    kept: list[tuple] = []

    def joined():
        part, number = kept[0][:2]
        bins, y, w = (v[0] if len(v) == 1 else np.concatenate(v, axis=axis)
                      for v, axis in zip(list(zip(*kept))[2:], (0, 0, -1)))
        kept.clear()
        return part, number, bins, y, w

    for batch in batches:
        for part, number, bins, y, w in zip(*(batch[c].to_pylist() for c in ("part", "block", "bins", "y", "w"))):
            bins = np.frombuffer(bins, plan.bin_type).reshape(-1, len(plan.splits))
            y = np.frombuffer(y, np.uint16).astype(np.int64) if plan.kind == "class" else np.frombuffer(y)
            w = np.frombuffer(w, plan.weight_type)
            w = w.reshape(plan.trees, 3, -1) if plan.merged and plan.kind == "reg" else w.reshape(plan.trees, -1)
            if kept and (kept[0][0] != part or sum(len(b[2]) for b in kept) + len(bins) > rows):
                yield joined()
            kept.append((part, number, bins, y, w))
    if kept:
        yield joined()


def _drawn_rows(plan: Plan, w: np.ndarray, tree: int) -> np.ndarray:
    """The rows that have a weight in a tree."""
    return np.flatnonzero((w[tree, 0] if w.ndim == 3 else w[tree]) > 0)


def _weights(plan: Plan, w: np.ndarray, y: np.ndarray, tree: int, rows: np.ndarray) -> np.ndarray:
    """What ``histograms`` adds up of the rows."""
    if w.ndim == 3:
        return w[tree][:, rows]
    own = w[tree][rows].astype(float)
    if plan.kind == "class":
        return own
    own_y = own * y[rows]
    return np.stack([own, own_y, own_y * y[rows]])


class Top:
    """The upper part of a tree: nodes by place in lists."""

    def __init__(self):
        self.id, self.feature, self.bin, self.left = [0], [-1], [0], [-1]
        self.found: list[tuple | None] = [None]  # (stats, impurity, gain) of a node looked at

    def split(self, at: int, feature: int, bin_: int) -> tuple[int, int]:
        left = len(self.id)
        self.feature[at], self.bin[at], self.left[at] = feature, bin_, left
        self.id += [2 * self.id[at] + 1, 2 * self.id[at] + 2]
        self.feature += [-1, -1]
        self.bin += [0, 0]
        self.left += [-1, -1]
        self.found += [None, None]
        return left, left + 1

    def walker(self, places: np.ndarray):
        """A function that takes rows (numbers, bins) to the ``places``, which have no
        children: (numbers, places, bins) of those that come there, and of some
        others.  Ends lead to themselves; rows that can come to none of the places
        are left behind on the way."""
        feature, left, every = np.array(self.feature), np.array(self.left), np.arange(len(self.id))
        inner, parent, leads = feature >= 0, np.full(len(every), -1), np.zeros(len(every), bool)
        for side in (0, 1):
            parent[left[inner] + side] = every[inner]
        at = np.asarray(places)
        while len(at):
            leads[at] = True
            at = parent[at]
            at = np.unique(at[(at >= 0) & ~leads[at]])
        inner &= leads
        bound, left = np.where(inner, self.bin, 1 << 20), np.where(inner, left, every)
        feature, depth = np.where(inner, feature, 0), max((self.id[p] + 1).bit_length() - 1 for p in [0, *places])

        def walk(rows: np.ndarray, bins: np.ndarray):
            at, flat, base = np.zeros(len(bins), np.int64), bins.reshape(-1), np.arange(len(bins)) * bins.shape[1]
            for _ in range(depth):
                at = left.take(at) + (flat.take(base + feature.take(at)) > bound.take(at))
                on = leads.take(at)
                if np.count_nonzero(on) < 0.7 * len(at):
                    on = np.flatnonzero(on)
                    rows, at, bins = rows[on], at[on], bins[on]
                    flat, base = bins.reshape(-1), base[:len(on)]
            return rows, at, bins

        return walk


def _at_places(plan: Plan, tops: list[Top], wanted: list[np.ndarray]):
    """A function (tree, bins, w) -> (rows that come to the places ``wanted`` of the
    tree, the place's rank among them, their bins)."""
    walks = [top.walker(places) for top, places in zip(tops, wanted)]
    ranks = [np.full(len(top.id), -1) for top in tops]
    for rank, places in zip(ranks, wanted):
        rank[places] = np.arange(len(places))

    def run(tree, bins, w):
        rows = _drawn_rows(plan, w, tree)
        rows, at, own = walks[tree](rows, bins[rows])
        node = ranks[tree].take(at)
        inside = np.flatnonzero(node >= 0)
        return (rows, node, own) if len(inside) == len(rows) else (rows[inside], node[inside], own[inside])

    return run


def _level(plan: Plan, tops: list[Top], wanted: list[np.ndarray]):
    """mapInArrow body: histograms of the nodes at the places ``wanted`` of each
    tree, of a task (counts are exact in any order), or of each part."""
    def run(batches):
        find, sums, part = _at_places(plan, tops, wanted), {}, None
        drawn = [drawn_features(plan, tree, np.array(top.id)[places]) if len(places) else None
                 for tree, (top, places) in enumerate(zip(tops, wanted))]
        kind = np.int32 if plan.kind == "class" else float

        def sent():
            for tree, hist in sums.items():
                own = np.flatnonzero(hist.reshape(len(hist), -1).any(axis=1))
                places = wanted[tree][own]
                yield pa.RecordBatch.from_pydict({
                    "part": _same(len(own), part), "tree": _same(len(own), tree), "place": pa.array(places, pa.int32()),
                    "id": pa.array([tops[tree].id[p] for p in places.tolist()], pa.int32()),
                    "hist": pa.array([hist[n].tobytes() for n in own.tolist()], pa.binary())})
            sums.clear()

        for number, _, bins, y, w in _read(plan, batches):
            if part is None or number != part and plan.kind == "reg":
                yield from sent()
                part = number
            for tree, places in enumerate(wanted):
                if not len(places):
                    continue
                rows, node, own = find(tree, bins, w)
                label, weights = y[rows] if plan.kind == "class" else None, _weights(plan, w, y, tree, rows)
                if tree not in sums:
                    sums[tree] = np.zeros((len(places), drawn[tree].shape[1], plan.bins, plan.stats), kind)
                step = max(1, CELLS // (drawn[tree].shape[1] * plan.bins * plan.stats))
                for first in range(0, len(places), step):
                    lot = slice(None) if step >= len(places) else np.flatnonzero((node >= first) & (node < first + step))
                    sums[tree][first:first + step] += histograms(
                        plan, drawn[tree][first:first + step], node[lot] - first, own[lot],
                        label if label is None else label[lot], weights[..., lot]).astype(kind, copy=False)
        yield from sent()

    return run


def _chosen(plan: Plan):
    """applyInArrow body: the best split of one node from all its histograms."""
    def run(group: pa.Table) -> pa.Table:
        tree, place, node = (group[c][0].as_py() for c in ("tree", "place", "id"))
        hists = [np.frombuffer(h, np.int32 if plan.kind == "class" else float)
                 for _, h in sorted(zip(group["part"].to_pylist(), group["hist"].to_pylist()))]
        hist = np.sum([h.astype(float) for h in hists], axis=0).reshape(1, plan.per_node, plan.bins, plan.stats)
        best = best_splits(plan, hist, drawn_features(plan, tree, np.array([node])))
        return pa.table({"tree": pa.array([tree], pa.int32()), "place": pa.array([place], pa.int32()),
                         "gain": best.gain, "feature": pa.array(best.feature, pa.int32()),
                         "bin": pa.array(best.bin, pa.int32()), "impurity": best.impurity,
                         "total": [best.total[0]], "left": [best.left[0]], "right": [best.right[0]]})

    return run


# ---------------------------------------------------------------------------
# Below a node
# ---------------------------------------------------------------------------
def _dealt(plan: Plan, tops: list[Top], ready: list[np.ndarray]):
    """mapInArrow body: the rows of each part at the places ``ready``, by node."""
    def run(batches):
        find = _at_places(plan, tops, ready)
        for part, number, bins, y, w in _read(plan, batches, DEAL_ROWS):
            label = y.astype(np.uint16) if plan.kind == "class" else y
            for tree, places in enumerate(ready):
                if not len(places):
                    continue
                rows, node, own = find(tree, bins, w)
                order = _order(node, len(places))
                rows, starts = rows[order], _starts(node[order])
                ids = [tops[tree].id[p] for p in places[node[order][starts]].tolist()]
                none = pa.array([b""] * len(ids), pa.binary())
                yield pa.RecordBatch.from_pydict({
                    "part": _same(len(ids), part), "block": _same(len(ids), number), "tree": _same(len(ids), tree),
                    "id": pa.array(ids, pa.int32()), "bins": _slices(own[order], starts),
                    "y": none if w.ndim == 3 else _slices(label[rows], starts),
                    "w": _slices(w[tree][:, rows].T if w.ndim == 3 else w[tree][rows], starts)})

    return run


def node_table(plan: Plan, tree: int, ids, feature, bound, stats, value, gain) -> pa.Table:
    """Rows of ``_NODES``; ``feature`` -1: a leaf."""
    ids, feature, bound, leaf = np.asarray(ids, np.int64), np.asarray(feature), np.asarray(bound), np.asarray(feature) < 0
    threshold = [None if f < 0 else float(plan.splits[f][b]) for f, b in zip(feature.tolist(), bound.tolist())]
    stats = np.asarray(stats, float).reshape(len(ids), plan.stats)
    child = lambda n: pa.array(np.where(leaf, -1, 2 * ids + n), pa.int32())
    weight = stats[:, 0] if plan.kind == "reg" else stats.sum(axis=1)
    return pa.table({
        "tree_id": pa.array(np.full(len(ids), tree), pa.int32()), "node_id": pa.array(ids, pa.int32()),
        "is_leaf": pa.array(leaf), "feature": pa.array(np.where(leaf, -1, feature), pa.int32()),
        "threshold": pa.array(threshold, pa.float64()), "left_child": child(1), "right_child": child(2),
        "prediction": prediction(plan, stats), "impurity": np.asarray(value, float),
        "gain": np.where(leaf, -1.0, np.asarray(gain, float)), "count": pa.array(weight.astype(np.int64)),
        "stats": pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * plan.stats, pa.int32()),
                                          pa.array(stats.ravel()))})


def grow(plan: Plan, tree: int, root: int, bins: np.ndarray, y: np.ndarray | None, w: np.ndarray) -> list[dict]:
    """The levels below and with the node ``root``, given its rows (as for
    ``histograms``): nodes of a level as arrays, ``child`` being the place of the
    left child in the next."""
    depth = (root + 1).bit_length() - 1
    ids, open_, node = np.array([root]), np.ones(1, bool), np.zeros(len(bins), np.int64)
    stats, value = np.zeros((1, plan.stats)), np.zeros(1)
    levels = []
    while True:
        level = {"ids": ids, "feature": np.full(len(ids), -1), "bin": np.zeros(len(ids), np.int64), "stats": stats,
                 "value": value, "gain": np.full(len(ids), -1.0), "child": np.full(len(ids), -1)}
        levels.append(level)
        if not open_.any():
            return levels
        # rows are in the order of their nodes, which are open ones
        at = np.flatnonzero(open_)
        rank = np.cumsum(open_) - 1
        node = rank[node]
        drawn = drawn_features(plan, tree, ids[at])
        starts = np.searchsorted(node, np.arange(len(at) + 1))
        step = max(1, CELLS // (drawn.shape[1] * plan.bins * plan.stats))
        found = []
        for first in range(0, len(at), step):
            rows = slice(starts[first], starts[min(first + step, len(at))])
            own = drawn[first:first + step]
            found.append(best_splits(plan, histograms(plan, own, node[rows] - first, bins[rows],
                                                      y if y is None else y[rows], w[..., rows]), own))
        best = Best(*(np.concatenate([getattr(f, name) for f in found]) for name in Best.__dataclass_fields__))
        if depth == (root + 1).bit_length() - 1:
            level["stats"], level["value"] = best.total, best.impurity
        splits = (best.gain > 0) & (depth < plan.max_depth)
        cut = at[splits]
        if not len(cut):
            return levels
        level["feature"][cut], level["bin"][cut], level["gain"][cut] = (v[splits] for v in (best.feature, best.bin, best.gain))
        level["child"][cut] = 2 * np.arange(len(cut))
        depth += 1
        ids = (2 * ids[cut][:, None] + np.array([1, 2])).ravel()
        stats = np.stack([best.left[splits], best.right[splits]], axis=1).reshape(len(ids), -1)
        value = impurity(plan, stats)[1]
        open_ = (depth < plan.max_depth) & (np.abs(value) >= EPSILON)
        into = np.full(len(at), -1)
        into[splits] = 2 * np.arange(len(cut))
        at = np.arange(len(node)) * bins.shape[1] + best.feature.take(node)
        to = into.take(node)
        to = np.where(to < 0, -1, to + (bins.reshape(-1).take(at) > best.bin.take(node)))
        rows = np.flatnonzero((to >= 0) & open_[to])
        rows = rows[_order(to[rows], len(ids))]
        node, bins, y, w = to[rows], bins[rows], y if y is None else y[rows], w[..., rows]


def prune(plan: Plan, levels: list[dict]) -> None:
    """Two leaves that predict the same become one, from below."""
    for above, below in zip(levels[-2::-1], levels[:0:-1]):
        below.setdefault("gone", np.zeros(len(below["ids"]), bool))
        value = prediction(plan, below["stats"])
        inner = np.flatnonzero(above["child"] >= 0)
        left = above["child"][inner]
        same = (below["feature"][left] < 0) & (below["feature"][left + 1] < 0) & (value[left] == value[left + 1])
        above["feature"][inner[same]] = -1
        above["child"][inner[same]] = -1
        for side in (0, 1):
            below["gone"][left[same] + side] = True


def _grown(plan: Plan):
    """applyInArrow body: all nodes below (and with) one node of a tree."""
    def run(group: pa.Table) -> pa.Table:
        tree, root = group["tree"][0].as_py(), group["id"][0].as_py()
        group = _in_order(group)
        bins = _joined(group, "bins", plan.bin_type).reshape(-1, len(plan.splits))
        w = _joined(group, "w", plan.weight_type)
        if plan.kind == "class":
            y, w = _joined(group, "y", np.uint16).astype(np.int64), w.astype(float)
        elif plan.merged:
            y, w = None, np.ascontiguousarray(w.reshape(-1, 3).T)
        else:
            own = w * _joined(group, "y", float)
            y, w = None, np.stack([w, own, own * _joined(group, "y", float)])
        levels = grow(plan, tree, root, bins, y, w)
        prune(plan, levels)
        keep = [~level.get("gone", np.zeros(len(level["ids"]), bool)) for level in levels]
        col = {c: np.concatenate([level[c][k] for level, k in zip(levels, keep)])
               for c in ("ids", "feature", "bin", "stats", "value", "gain")}
        return node_table(plan, tree, *col.values())

    return run


# ---------------------------------------------------------------------------
# The fit
# ---------------------------------------------------------------------------
def _upper(blocks: DataFrame, plan: Plan, rows: int, local: int) -> tuple[list[Top], list[np.ndarray]]:
    """Trees as far as their nodes have more than ``local`` rows, and the places
    whose rows one task takes."""
    tops = [Top() for _ in range(plan.trees)]
    ready: list[list[int]] = [[] for _ in tops]
    open_: list[list[int]] = [[0] for _ in tops]
    if rows <= local:
        ready, open_ = open_, [[] for _ in tops]
    while any(open_):
        wanted = [np.array(sorted(places), np.int64) for places in open_]
        found = (blocks.mapInArrow(_level(plan, tops, wanted), "part int, tree int, place int, id int, hist binary")
                 .groupBy("tree", "place").applyInArrow(
                     _chosen(plan), "tree int, place int, gain double, feature int, bin int, impurity double, "
                                    "total array<double>, left array<double>, right array<double>").collect())
        open_ = [[] for _ in tops]
        for row in sorted(found, key=lambda r: (r.tree, r.place)):
            top = tops[row.tree]
            top.found[row.place] = np.array(row.total), row.impurity, row.gain
            depth = (top.id[row.place] + 1).bit_length() - 1
            if not row.gain > 0 or depth >= plan.max_depth:
                continue
            for place, stats in zip(top.split(row.place, row.feature, row.bin), (np.array(row.left), np.array(row.right))):
                weight, value = impurity(plan, stats)
                top.found[place] = stats, float(value), -1.0
                if depth + 1 < plan.max_depth and abs(value) >= EPSILON:
                    (open_ if weight > local else ready)[row.tree].append(place)
    return tops, [np.array(sorted(places), np.int64) for places in ready]


def _upper_nodes(plan: Plan, tree: int, top: Top, ready: np.ndarray, leaves: dict[int, float],
                 ) -> tuple[pa.Table | None, list[int]]:
    """The nodes of the upper part, and the numbers of leaves below it that are
    united there.  ``leaves``: what the tasks' nodes that are leaves predict."""
    given, gone = set(ready.tolist()), set()
    value = lambda p: leaves.get(top.id[p]) if p in given else (
        float(prediction(plan, top.found[p][0])) if top.feature[p] < 0 else None)
    for place in range(len(top.id) - 1, -1, -1):
        left = top.left[place]
        if left >= 0 and value(left) is not None and value(left) == value(left + 1):
            top.feature[place] = top.left[place] = -1
            gone |= {left, left + 1}
    own = [p for p in range(len(top.id)) if p not in given and p not in gone]
    if not own:
        return None, []
    table = node_table(plan, tree, [top.id[p] for p in own], [top.feature[p] for p in own], [top.bin[p] for p in own],
                       [top.found[p][0] for p in own], [top.found[p][1] for p in own], [top.found[p][2] for p in own])
    return table, [top.id[p] for p in gone & given]


def grow_forest(data: DataFrame, kind: str, label: str, features: str, rows: int, count: int, *, num_trees: int,
                max_depth: int, max_bins: int, seed: int, num_classes: int = 0, min_instances: int = 1,
                bootstrap: bool = True) -> DataFrame:
    """The node table of a forest on ``data`` in its layout (see ``laid_out``),
    of ``rows`` rows with ``count`` features, written."""
    spark = data.sparkSession
    with Scratch(spark) as scratch:
        blocks = scratch.write(
            data.select(F.spark_partition_id().alias("part"), F.col(label).cast("double").alias("y"),
                        vector_to_array(F.col(features)).alias("x"))
            .mapInArrow(_blocks(num_trees, seed, bootstrap), "part int, block int, x binary, y binary, w binary"), "forest-blocks")
        wanted = max(max_bins * max_bins, 10_000)
        sample = (blocks.select("part", "block", "x")
                  .mapInArrow(_sampled(count, min(1.0, wanted / rows), seed), "part int, block int, x binary").collect())
        values = np.concatenate([np.frombuffer(r.x).reshape(-1, count) for r in sorted(sample, key=lambda r: r[:2])])
        plan = Plan(kind, num_classes if kind == "class" else 3, num_trees, max_depth,
                    features_per_node(kind, count, num_trees), min_instances, seed,
                    [split_points(values[:, f], max_bins) for f in range(count)])
        local, plan.merged = LOCAL_ROWS, plan.cells() * MERGE_ROWS <= rows
        if plan.merged:
            parts = max(1, -(-rows // MERGE_PART))
            blocks = scratch.write(
                blocks.mapInArrow(_by_cell(plan, parts), "`to` int, " + _BLOCK).groupBy("to")
                .applyInArrow(_added_up(plan), _BLOCK), "forest-cells")
            entries = blocks.agg(F.sum(F.length("bins"))).first()[0] // (count * np.dtype(plan.bin_type).itemsize)
            local *= max(1, min(MERGED_LOCAL, rows // entries))
        else:
            blocks = scratch.write(blocks.mapInArrow(_binned(plan), _BLOCK), "forest-binned")
        tops, ready = _upper(blocks, plan, rows, local)
        below = scratch.write(
            blocks.mapInArrow(_dealt(plan, tops, ready),
                              "part int, block int, tree int, id int, bins binary, y binary, w binary")
            .groupBy("tree", "id").applyInArrow(_grown(plan), _NODES), "forest-below")
        # the nodes at the border that are leaves: as few as the upper parts' nodes
        border = spark.createDataFrame([(t, tops[t].id[p]) for t, places in enumerate(ready) for p in places.tolist()],
                                       "tree_id int, node_id int")
        ends = below.where("is_leaf").join(F.broadcast(border), ["tree_id", "node_id"]).select(
            "tree_id", "node_id", "prediction").collect()
        upper, gone = [], []
        for tree, top in enumerate(tops):
            table, ids = _upper_nodes(plan, tree, top, ready[tree],
                                      {r.node_id: r.prediction for r in ends if r.tree_id == tree})
            upper += [table] if table is not None else []
            gone += [(tree, n) for n in ids]
        if gone:
            below = below.join(F.broadcast(spark.createDataFrame(gone, "tree_id int, node_id int")),
                               ["tree_id", "node_id"], "left_anti")
        if upper:
            below = below.unionByName(spark.createDataFrame(pa.concat_tables(upper).to_pylist(), _NODES))
        return materialize(below, "forest-nodes")
