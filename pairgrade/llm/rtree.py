"""Hard-negative mining over an R-tree packed by sort-tile-recursive.

Rows are cut into slabs along the two coordinates of greatest spread (cuts are
quantiles of all rows) and each tile is written as packed records of bounded
size, its rows in the order of the same packing along further coordinates.  A
tile that holds more rows than a record, as one vector stands in it very often,
is dealt to several records by a hash; boxes may overlap.

The anchors are the query set.  They come in blocks of bounded size, which are
broadcast; a job takes one block to all tiles.  There a record becomes a tree of
minimum bounding boxes.  Per coordinate, an anchor's component times the box's
bounds gives an interval, their sum one of the inner product.  A queue expands
the box of the greatest upper end first; a box is pruned if its interval lies
outside of the score windows, or its upper end strictly below the kth score found
(not at it: ties go to the smaller id).  The first job finds the best rows of the
anchor's own label, which set the windows of the second.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairgrade.llm.vectors import integer_vectors
from pairgrade.sources.sinks import materialize

POSITIVES = 5
NEGATIVES = 10
#: Scores of negatives, in hundredths of the positive's.
WINDOW = (30, 90)
#: Rows of a packed record and of a leaf, children of a box.
RECORD_ROWS = 4096
LEAF_ROWS = 128
FANOUT = 8
#: Slabs of each of the two coordinates, at most.
SLABS = 64
#: Anchors of a job (with their positives, a few MB that are broadcast).
BLOCK = 4096
LONG = (-(1 << 63), (1 << 63) - 1)


# ---------------------------------------------------------------------------
# Tree of one record (numpy)
# ---------------------------------------------------------------------------
def packed_order(x: np.ndarray, leaf: int = LEAF_ROWS) -> np.ndarray:
    """Sort-tile-recursive: rows sorted along one coordinate, cut into slabs,
    each slab along the next one; coordinates by falling spread."""
    axes = np.argsort(-(x.max(axis=0) - x.min(axis=0)).astype(float), kind="stable") if len(x) else []

    def pack(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        leaves = -(-len(rows) // leaf)
        if leaves <= 1 or depth == len(axes):
            return [rows]
        rows = rows[np.argsort(x[rows, axes[depth]], kind="stable")]
        slabs = min(leaves, FANOUT)
        size = -(-leaves // slabs) * leaf
        return [part for at in range(0, len(rows), size) for part in pack(rows[at:at + size], depth + 1)]

    return np.concatenate(pack(np.arange(len(x)), 0)) if len(x) else np.zeros(0, np.int64)


def _greatest(x: np.ndarray) -> int:
    """The greatest absolute value; inner products of vectors of ``d`` integers
    up to it are exact as doubles if its square times ``d`` is below 2**53."""
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


class Tree:
    """Boxes of the rows of one record, level by level; leaves first."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        low = np.minimum.reduceat(x, np.arange(0, len(x), LEAF_ROWS))
        high = np.maximum.reduceat(x, np.arange(0, len(x), LEAF_ROWS))
        self.levels = [(low, high)]
        while len(low) > 1:
            at = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((low, high))

    def intervals(self, level: int, boxes: slice, up: np.ndarray, down: np.ndarray):
        """(lower, upper) ends of the inner products with an anchor, given its
        positive and its negative part."""
        low, high = (side[boxes] for side in self.levels[level])
        return low @ up + high @ down, high @ up + low @ down

    def best_first(self, anchor: np.ndarray, wanted) -> None:
        """Shows ``wanted`` the rows of every leaf that it doesn't prune."""
        up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
        top = len(self.levels) - 1
        lower, upper = self.intervals(top, slice(0, 1), up, down)
        queue = [(-upper[0], top, 0, lower[0])]
        while queue:
            upper, level, box, lower = heapq.heappop(queue)
            if wanted.prunes(lower, -upper):
                continue
            if level == 0:
                rows = slice(box * LEAF_ROWS, (box + 1) * LEAF_ROWS)
                wanted.see(self.x[rows] @ anchor, self.ids[rows], self.labels[rows])
            else:
                first = box * FANOUT
                lower, upper = self.intervals(level - 1, slice(first, first + FANOUT), up, down)
                for n, (lo, hi) in enumerate(zip(lower, upper)):
                    if not wanted.prunes(lo, hi):
                        heapq.heappush(queue, (-hi, level - 1, first + n, lo))


class Best:
    """The first ``k`` rows by falling score, then rising id, of those of one
    label (``same``) or of the other ones, within each of several windows."""

    def __init__(self, vec_id: int, label: int, same: bool, k: int, windows: list[tuple[int, int]] | None = None):
        self.vec_id, self.label, self.same, self.k = vec_id, label, same, k
        self.windows = windows  # (30 * positive, 90 * positive); None: any score
        self.found: list[list[tuple[int, int]]] = [[] for _ in ([0] if windows is None else windows)]

    def prunes(self, lower, upper) -> bool:
        for n, found in enumerate(self.found):
            if self.windows is not None and (100 * upper < self.windows[n][0] or 100 * lower > self.windows[n][1]):
                continue
            if len(found) < self.k or upper >= -found[-1][0]:
                return False
        return True

    def see(self, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        ok = (labels == self.label) & (ids != self.vec_id) if self.same else labels != self.label
        for n, found in enumerate(self.found):
            now = ok
            if self.windows is not None:
                low, high = self.windows[n]
                now = now & (100 * scores >= low) & (100 * scores <= high)
            if len(found) == self.k:
                now = now & (scores >= -found[-1][0])
            at = np.flatnonzero(now)
            if len(at):
                found.extend(zip((-int(s) for s in scores[at]), ids[at].tolist()))
                found.sort()
                del found[self.k:]


# ---------------------------------------------------------------------------
# Index
# ---------------------------------------------------------------------------
def _spread_axes(rows: DataFrame, dim: int) -> list[int]:
    spread = (rows.select(F.posexplode("x").alias("at", "x")).groupBy("at")
              .agg(F.stddev_pop(F.col("x").cast("double")).alias("s")).collect())
    order = sorted(spread, key=lambda row: (-row.s, row.at))
    return [row.at for row in order[:2]] * (2 if dim == 1 else 1)


def packed_tiles(rows: DataFrame, dim: int, record_rows: int = RECORD_ROWS) -> DataFrame:
    """(width, ids, labels, x): the index, written; a record holds at most
    ``record_rows`` rows of one tile, its integers of ``width`` bytes."""
    total = rows.count()
    slabs = int(min(max(np.ceil(np.sqrt(total / record_rows)), 1), SLABS))
    rows = rows.withColumn("a", F.lit(0)).withColumn("b", F.lit(0))
    if slabs > 1:
        first, second = _spread_axes(rows, dim)
        shares = [s / slabs for s in range(1, slabs)]
        cuts = lambda at: F.percentile_approx(F.col("x")[at], shares, 10_000).alias("cuts")
        slab = lambda at, ends: F.size(F.filter(ends, lambda c: c < F.col("x")[at]))
        ends = F.array(*[F.lit(c) for c in rows.agg(cuts(first)).first().cuts])  # SLABS numbers at most
        rows = rows.withColumn("a", slab(first, ends))
        of_slab = rows.groupBy("a").agg(cuts(second))  # SLABS rows at most
        rows = rows.join(F.broadcast(of_slab), "a").withColumn("b", slab(second, F.col("cuts"))).drop("cuts")
    sizes = rows.groupBy("a", "b").agg(F.ceil(F.count("*") / record_rows).cast("int").alias("pieces"))
    dealt = (rows.join(F.broadcast(sizes), ["a", "b"])  # at most SLABS * SLABS rows
             .withColumn("piece", F.pmod(F.xxhash64("vec_id", "x"), F.col("pieces")))
             .select("a", "b", "piece", "vec_id", "label", "x"))
    parts = max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-total // (8 * record_rows)))
    laid = dealt.repartition(parts, "a", "b", "piece").sortWithinPartitions("a", "b", "piece")

    def record(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        batch = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        x = batch.column(2).flatten().to_numpy().reshape(-1, dim)
        order = packed_order(x)
        width = next(w for w in (2, 4, 8) if w == 8 or -(1 << 8 * w - 1) <= x.min() <= x.max() < 1 << 8 * w - 1)
        arrays = [batch.column(0).to_numpy()[order], batch.column(1).to_numpy()[order], x[order].astype(f"i{width}")]
        return pa.RecordBatch.from_arrays([pa.array([width], pa.int32()),
                                           *[pa.array([a.tobytes()], pa.binary()) for a in arrays]],
                                          names=["width", "ids", "labels", "x"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, unit = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in range(3)])
            edges = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *edges], [*edges, batch.num_rows]):
                if unit is not None and unit != tuple(key[:, lo]):
                    yield record(held)
                    held, n = [], 0
                unit = tuple(key[:, lo])
                while lo < hi:
                    take = min(hi - lo, record_rows - n)
                    held.append(batch.slice(lo, take).select(["vec_id", "label", "x"]))
                    lo, n = lo + take, n + take
                    if n == record_rows:
                        yield record(held)
                        held, n, unit = [], 0, None if lo == hi else unit
        if held:
            yield record(held)

    return materialize(laid.mapInArrow(run, "width int, ids binary, labels binary, x binary"), "rtree-tiles")


# ---------------------------------------------------------------------------
# Search
# ---------------------------------------------------------------------------
def _search(tiles: DataFrame, dim: int, block: list, same: bool, k: int, windows: dict | None = None) -> DataFrame:
    """(anchor, place, score, vec_id): for each anchor of the block (its number
    there) and each of its windows the ``k`` best rows of every task."""
    sent = tiles.sparkSession.sparkContext.broadcast((block, windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, windows = sent.value
        anchors = np.array([x for _, _, x in block], np.int64).reshape(-1, dim)
        far = _greatest(anchors)
        best = [Best(vec_id, label, same, k, None if windows is None else windows.get(n, []))
                for n, (vec_id, label, _) in enumerate(block)]
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                x = np.frombuffer(row["x"], f"i{row['width']}").reshape(-1, dim)
                top = max(_greatest(x), far)
                exact = float if top * top * dim < 1 << 53 else object
                tree = Tree(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64),
                            x.astype(exact))
                for anchor, wanted in zip(anchors.astype(exact), best):
                    tree.best_first(anchor, wanted)
        rows = [(n, place, min(max(-score, LONG[0]), LONG[1]), vec_id) for n, wanted in enumerate(best)
                for place, found in enumerate(wanted.found) for score, vec_id in found]
        columns = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names=["anchor", "place", "score", "vec_id"])

    found = tiles.mapInArrow(run, "anchor int, place int, score bigint, vec_id bigint")
    order = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   window: tuple[int, int] = WINDOW, block: int = BLOCK,
                   record_rows: int = RECORD_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each row whose id is divisible by ``every`` and each of
    its best ``positives`` other rows of its label, the best ``negatives`` rows
    of other labels whose score lies within ``window`` hundredths of the
    positive's.

    Rows without a label, an id or a usable vector (``integer_vectors``) take no
    part.  Equal rows (id, label, vector) count once; rows that share an id only
    are rows of their own, each an anchor, but not each other's positive.  Ties
    of scores go to the smaller id.  An anchor without positives, or a positive
    without negatives, has no rows, and so has an empty table.  Scores are
    exact; one beyond a long is given as the end of its range.  Other columns
    are ignored.
    """
    spark = df.sparkSession
    rows, dim = integer_vectors(df.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull()),
                                id_col, vector_col, F.col(f"`{label_col}`").cast("bigint").alias("label"))
    rows = materialize(rows.distinct(), "rtree-rows")
    tiles = packed_tiles(rows, dim, record_rows)
    anchors = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-anchors.count() // block))
    anchors = materialize(anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "x"), F.lit(blocks)))
                          .repartition("block"), "rtree-anchors")
    schema = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
              "negative_score bigint")
    parts = [spark.createDataFrame([], schema)]
    for number in range(blocks):
        held = [(row.vec_id, row.label, row.x) for row in
                anchors.where(F.col("block") == number).select("vec_id", "label", "x").toLocalIterator()]
        for at in range(0, len(held), block):
            parts.append(_mine(spark, tiles, dim, held[at:at + block], positives, negatives, window))
    return _union(parts)


def _mine(spark, tiles: DataFrame, dim: int, block: list, positives: int, negatives: int,
          window: tuple[int, int]) -> DataFrame:
    best: dict[int, list[tuple[int, int]]] = {}
    for row in _search(tiles, dim, block, True, positives).orderBy("anchor", "rank").collect():
        best.setdefault(row.anchor, []).append((row.score, row.vec_id))
    windows = {n: [(window[0] * score, window[1] * score) for score, _ in found] for n, found in best.items()}
    of_place = spark.createDataFrame(
        [(n, place, block[n][0], vec_id, score) for n, found in best.items()
         for place, (score, vec_id) in enumerate(found)],
        "anchor int, place int, anchor_id bigint, positive_id bigint, positive_score bigint")
    found = _search(tiles, dim, block, False, negatives, windows).select(
        "anchor", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return materialize(found.join(of_place, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "rtree-found")


def _union(parts: list[DataFrame]) -> DataFrame:
    """A balanced union, so that its plan stays flat for many blocks."""
    while len(parts) > 1:
        parts = [a.unionByName(b) for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) // 2 * 2:]
    return parts[0]
