"""Alternating least squares on aggregated (user, item) pairs, as Spark jobs.

Explicit ALS minimises, per user u (and symmetrically per item),

    sum over u's rating rows k of (r_k - u.v_k)^2  +  reg * n_u * |u|^2

with n_u the number of rating rows of u (repeated pairs count as separate
rows, as in MLlib).  Rows that repeat a (user, item) pair only enter through
their count c and rating sum s, so the same minimiser follows from the normal
equations

    (sum_i c_ui v_i v_i^T + reg * n_u I) u = sum_i s_ui v_i,    n_u = sum_i c_ui

over *distinct* pairs.  Several models, told apart by a number, are fitted at
once: a half-iteration is one job for all of them.  The solver

1. aggregates the ratings into pairs (model, u, i, c, s): a groupBy with
   map-side partial aggregation, so an id holding a third of all rows is
   combined before any shuffle, and a categorical column collapses to a few
   pairs.  The pairs of many models come from one scan with grouping sets, those
   of a sweep from ``pairgrade.operators.cells``;
2. salts ids with many distinct partners: their pairs are spread over
   ``ceil(pairs / target_pairs)`` sub-groups, each producing a partial normal
   equation, combined by a small second aggregation (one row per sub-group);
   other ids are solved where their pairs land.  The few heavy ids are
   broadcast (their number is bounded), so no id's pairs meet in one task;
3. keeps the pairs in parts by (model, id, sub-group) of the side to be solved,
   cached in that order.  A factor is sent once to each part that holds a
   partner: one shuffle a half-iteration, nothing is broadcast.  Where one side
   has few ids and the other many, only the many side's parts are kept: a part
   solves its ids and at once sums what they add to the normal equations of the
   few ids, so the many factors never leave their part, only those sums do;
4. solves the systems of a part in batches.  An id with m partners, m below the
   rank, needs only a system of m unknowns: with F its partners' factors,
   u = F^T y and (C F F^T + reg * n_u I) y = s.

Sums run in order of (id, sub-group, partner), and the parts that sum for few ids
follow from the pairs alone, so factors do not depend on the cluster or on the
order in which rows arrive; every ``checkpoint_interval``
iterations and at the end the factors are written to the shared checkpoint
folder, which cuts the lineage.

Initial user factors are derived from a hash of (seed, id, position), so they
do not depend on partitioning, or on what else is fitted.  The factors differ
from MLlib's (its random start is per block) but solve the same objective.
Scoring uses the same float dot product as MLlib (``pairgrade.operators.factor``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairgrade.sources.sinks import Scratch, materialize

TARGET_PAIRS = 200_000     # pairs per sub-group of one id before it is salted
PARTITION_PAIRS = 500_000  # pairs per partition of a half-iteration, about
LOCAL_PAIRS = 250_000      # pairs per part that sums the equations of few ids, about
LOCAL_CELLS = 1 << 23      # numbers of the equations that one such part sums, at most
MAX_HEAVY_IDS = 1_000_000  # ids split into sub-groups at most (broadcast, 20 MB)
BROADCAST_FACTORS_MB = 256
BATCH_CELLS = 1 << 20      # numbers of the factors that are solved for at once

#: A solved factor, or the partial normal equation of one of an id's sub-groups;
#: ``to`` are the other side's parts that need the factor.
_STEP = ("model int, id int, salt int, final boolean, `to` array<int>, features array<float>, "
         "ata array<double>, atb array<double>, n double")

#: What one part adds to the normal equation of one of few ids; ``ata`` has the
#: upper triangle.
_SUMS = "model int, id int, part int, ata array<double>, atb array<double>, n double"
_FACTORS = "model int, id int, features array<float>"


@dataclass
class PairFactors:
    """Fitted factors: ``user_factors`` / ``item_factors`` are DataFrames
    (id int, features array<float>) stored in the shared checkpoint folder.
    ``broadcast_mb`` bounds what scoring broadcasts."""

    user_factors: DataFrame
    item_factors: DataFrame
    rank: int
    user_col: str
    item_col: str
    cold_start: str = "drop"
    prediction_col: str = "prediction"
    broadcast_mb: float | None = BROADCAST_FACTORS_MB


# ---------------------------------------------------------------------------
# Aggregated pairs
# ---------------------------------------------------------------------------
def aggregate_pairs(df: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """(u, i, c, s): rows per distinct pair and their rating sum."""
    return (df.groupBy(F.col(user).cast("int").alias("u"), F.col(item).cast("int").alias("i"))
              .agg(F.count(F.lit(1)).alias("c"), F.sum(F.col(rating).cast("double")).alias("s")))


def aggregate_models(df: DataFrame, models: Sequence[tuple[str, str]], rating: str) -> DataFrame:
    """(model, u, i, c, s) of several ordered (user, item) column pairs, by one
    scan: a model is the pair's place in ``models``.

    Columns are int ids; rows without one of a pair's ids have no part in it.
    Each set of two columns is one grouping set, which serves both orders."""
    columns = list(dict.fromkeys(c for pair in models for c in pair))
    place = {c: n for n, c in enumerate(columns)}
    sets = sorted({tuple(sorted(pair, key=place.get)) for pair in models}, key=lambda s: [place[c] for c in s])
    # the grouping id has a bit for each column that isn't in the set
    bits = {s: sum(1 << len(columns) - 1 - place[c] for c in columns if c not in s) for s in sets}
    which = df.sparkSession.createDataFrame(
        [(bits[tuple(sorted(pair, key=place.get))], n, place[pair[0]] > place[pair[1]])
         for n, pair in enumerate(models)], "gid long, model int, swapped boolean")
    ids = F.array_compact(F.array(*[F.col(f"`{c}`") for c in columns]))  # all others are null
    found = (df.groupingSets([[F.col(f"`{c}`") for c in s] for s in sets], *[F.col(f"`{c}`") for c in columns])
             .agg(F.grouping_id().cast("bigint").alias("gid"), F.count(F.lit(1)).alias("c"),
                  F.sum(F.col(rating).cast("double")).alias("s"))
             .select("gid", ids.alias("ids"), "c", "s").where(F.size("ids") == 2))
    one, two = F.col("ids")[0], F.col("ids")[1]
    return (found.join(F.broadcast(which), "gid")
            .select("model", F.when(F.col("swapped"), two).otherwise(one).alias("u"),
                    F.when(F.col("swapped"), one).otherwise(two).alias("i"), "c", "s"))


@dataclass
class ModelSize:
    """Pairs of a model, and about how many users and items they have."""

    pairs: int
    users: int
    items: int

    def local_parts(self, rank: int) -> int:
        """In how many parts to sum the equations of the side with few ids; 0 if
        that sends more than the factors would."""
        few, many = sorted((self.users, self.items))
        parts = math.ceil(self.pairs / LOCAL_PAIRS)
        sent = max(many, min(parts * many, self.pairs))  # factors, each to the parts of its partners
        return parts if few * rank * (rank + 3) <= 2 * LOCAL_CELLS and few * parts * (rank + 3) <= sent else 0


def model_sizes(pairs: DataFrame) -> dict[int, ModelSize]:
    rows = pairs.groupBy("model").agg(F.count("*"), F.approx_count_distinct("u", 0.02),
                                      F.approx_count_distinct("i", 0.02)).collect()
    return {model: ModelSize(*counts) for model, *counts in rows}


def _heavy_bound(pairs: DataFrame, side: str, target: int) -> int:
    """Least partners of a heavy id: the target, or more if more than
    ``MAX_HEAVY_IDS`` ids would be heavy."""
    counts = pairs.groupBy("model", side).agg(F.count(F.lit(1)).alias("m"))
    steps = [target * 4 ** k for k in range(16)]
    row = counts.agg(*[F.count_if(F.col("m") > t).alias(f"t{k}") for k, t in enumerate(steps)]).first()
    return next(t for k, t in enumerate(steps) if row[f"t{k}"] <= MAX_HEAVY_IDS)


def _with_salt(pairs: DataFrame, side: str, other: str, target: int) -> DataFrame:
    """Add ``salt_<side>`` and ``groups_<side>``: ids with more than ``target``
    distinct partners are split into sub-groups of about that many by a hash of
    the partner id."""
    heavy = (pairs.groupBy("model", side).agg(F.count(F.lit(1)).alias("__m")).where(F.col("__m") > target)
             .select("model", side, F.ceil(F.col("__m") / F.lit(target)).cast("int").alias("__groups")))
    groups = F.coalesce("__groups", F.lit(1))
    return (pairs.join(F.broadcast(heavy), ["model", side], "left")
            .withColumn(f"groups_{side}", groups)
            .withColumn(f"salt_{side}", F.pmod(F.xxhash64(F.col(other)), groups).cast("int"))
            .drop("__groups"))


def _part(side: str, sizes: dict[int, int], tasks: int) -> Column:
    """The part of a pair: a model's pairs make one or more parts, by their
    share in all pairs; a part has pairs of one model."""
    total = sum(sizes.values())
    first, count, at = [], [], 0
    for model in range(max(sizes) + 1):
        own = sizes.get(model, 0)
        first.append(at)
        count.append(max(1, round(2 * tasks * own / total), math.ceil(own / PARTITION_PAIRS)))
        at += count[-1]
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("model") + 1)
    return (pick(first) + F.pmod(F.xxhash64(side, f"salt_{side}"), pick(count))).cast("int")


# ---------------------------------------------------------------------------
# Normal equations of one part (numpy)
# ---------------------------------------------------------------------------
def initial_factors(ids: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """Unit-norm pseudo-Gaussian factors, a pure function of (seed, id)."""
    def spread(x):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    with np.errstate(over="ignore"):
        rows = spread(ids.astype(np.int64).view(np.uint64) + np.uint64(seed % (1 << 64)) * np.uint64(0x9E3779B97F4A7C15))
        cells = spread(rows[:, None] + np.arange(1, 2 * rank + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    unit = ((cells >> np.uint64(11)).astype(float) + 0.5) / 2.0 ** 53
    raw = np.sqrt(-2 * np.log(unit[:, :rank])) * np.cos(2 * np.pi * unit[:, rank:])
    return (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32)


def _solutions(lhs: np.ndarray, rhs: np.ndarray, strict: bool) -> np.ndarray:
    """Solutions of a batch of systems; NaN for a singular one unless ``strict``."""
    try:
        return np.linalg.solve(lhs, rhs[..., None])[..., 0]
    except np.linalg.LinAlgError:
        if strict:
            raise
    out = np.full(rhs.shape, np.nan)
    for n in range(len(lhs)):
        try:
            out[n] = np.linalg.solve(lhs[n], rhs[n])
        except np.linalg.LinAlgError:
            pass
    return out


def solve_groups(table: np.ndarray, where: np.ndarray, starts: np.ndarray, c: np.ndarray, s: np.ndarray,
                 whole: np.ndarray, reg: float, strict: bool = True):
    """(factors, partials): the factor of each group of pairs that is ``whole``;
    of the others {group: (ata, atb)}.  ``table`` has the partners' factors,
    ``where`` each pair's row in it."""
    rank, total = table.shape[1], len(where)
    sizes = np.diff(np.append(starts, total))
    n = np.add.reduceat(c, starts)
    out, partials = np.full((len(starts), rank), np.nan), {}
    few = whole & (sizes < rank)
    for m in np.unique(sizes[few]).tolist():
        own = np.flatnonzero(few & (sizes == m))
        for lot in np.array_split(own, -(-len(own) * m * rank // BATCH_CELLS)):
            rows = starts[lot][:, None] + np.arange(m)
            f = table[where[rows]]
            lhs = c[rows][:, :, None] * (f @ f.transpose(0, 2, 1))
            lhs[:, np.arange(m), np.arange(m)] += reg * n[lot][:, None]
            y = _solutions(lhs, s[rows], strict)
            out[lot] = (y[:, None, :] @ f)[:, 0, :]
    many = np.flatnonzero(~few)
    for lot in np.array_split(many, -(-len(many) * rank * rank // BATCH_CELLS)) if len(many) else ():
        ata, atb = np.empty((len(lot), rank, rank)), np.empty((len(lot), rank))
        for k, g in enumerate(lot):
            pairs = slice(starts[g], starts[g] + sizes[g])
            f = table[where[pairs]]
            ata[k], atb[k] = f.T @ (f * c[pairs, None]), f.T @ s[pairs]
        done = whole[lot]
        out[lot[done]] = _solutions(ata[done] + reg * n[lot[done]][:, None, None] * np.eye(rank), atb[done], strict)
        partials |= {g: (ata[k], atb[k]) for k, g in enumerate(lot.tolist()) if not done[k]}
    return out, partials


def _lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), pa.array(values, kind))


def _equations(rank: int, reg: float, seed: int, strict: bool) -> Callable:
    """Cogroup body for one part: its pairs, and the factors sent to it (none
    in the first half-iteration, which starts from initial factors)."""
    def run(pairs: pa.Table, factors: pa.Table | None = None) -> pa.Table:
        col = {x: pairs[x].to_numpy() for x in ("dst", "salt", "groups", "src", "c", "s", "to", "model")}
        dst, salt = col["dst"], col["salt"]
        if len(dst) > 1:
            order = np.lexsort((col["src"], salt, dst))
            if (order[1:] < order[:-1]).any():
                col = {x: v[order] for x, v in col.items()}
                dst, salt = col["dst"], col["salt"]
        if factors is None:
            known = np.unique(col["src"])
            table = initial_factors(known, rank, seed)
        else:
            known = factors["src"].to_numpy()
            order = np.argsort(known, kind="stable")
            known = known[order]
            table = factors["f"].combine_chunks().flatten().to_numpy().reshape(-1, rank)[order]
        starts = np.flatnonzero(np.append(True, (dst[1:] != dst[:-1]) | (salt[1:] != salt[:-1]))) \
            if len(dst) else np.zeros(0, np.int64)
        whole = col["groups"][starts] == 1
        c, s = col["c"].astype(float), col["s"].astype(float)
        if len(starts):
            x, partials = solve_groups(table.astype(float), np.searchsorted(known, col["src"]), starts, c, s, whole,
                                       reg, strict)
            n = np.add.reduceat(c, starts)
        else:
            x, partials, n = np.zeros((0, rank)), {}, np.zeros(0)
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(dst))))
        routes = np.unique(np.stack([group, col["to"]], axis=1), axis=0)
        to = _lists(routes[:, 1], np.searchsorted(routes[:, 0], np.arange(len(starts))), pa.int32())
        features = _lists(x.astype(np.float32).ravel(), np.arange(len(starts)) * rank, pa.float32())
        blank = [None] * len(starts)
        ata, atb = list(blank), list(blank)
        for g, (a, b) in partials.items():
            ata[g], atb[g] = a.ravel(), b
        return pa.table({
            "model": pa.array(col["model"][starts], pa.int32()), "id": pa.array(dst[starts], pa.int32()),
            "salt": pa.array(salt[starts], pa.int32()), "final": pa.array(whole, pa.bool_()), "to": to,
            "features": features, "ata": pa.array(ata, pa.list_(pa.float64())),
            "atb": pa.array(atb, pa.list_(pa.float64())), "n": pa.array(n, pa.float64())})

    return run


def _combine(rank: int, reg: float, strict: bool):
    """applyInPandas body for one salted id: sum its partial normal
    equations (one per sub-group) and solve."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("salt")
        ata = np.sum(np.stack(pdf["ata"].to_numpy()), axis=0).reshape(1, rank, rank)
        atb = np.sum(np.stack(pdf["atb"].to_numpy()), axis=0).reshape(1, rank)
        x = _solutions(ata + reg * float(pdf["n"].sum()) * np.eye(rank), atb, strict)[0]
        to = sorted({int(t) for part in pdf["to"] for t in part})
        return pd.DataFrame({"model": [int(pdf["model"].iloc[0])], "id": [int(pdf["id"].iloc[0])], "to": [to],
                             "features": [x.astype(np.float32).tolist()]})

    return run


def _local(rank: int, reg: float, seed: int, strict: bool, last: bool) -> Callable:
    """Cogroup body for one part of a model with few ids (``src``) on one side:
    solves its other ids (``dst``) and returns what they add to the equations of
    the few, or, ``last``, their factors.  Without factors of the few ids (first
    half-iterations) those of the users are initial ones."""
    upper = np.triu_indices(rank)

    def run(pairs: pa.Table, factors: pa.Table | None = None) -> pa.Table:
        col = {x: pairs[x].to_numpy() for x in ("dst", "src", "c", "s")}
        order = np.lexsort((col["src"], col["dst"]))
        dst, src, c, s = (col[x][order] for x in ("dst", "src", "c", "s"))
        c, s = c.astype(float), s.astype(float)
        if not len(dst):
            return _SUMS_TABLE.empty_table() if not last else _FACTORS_TABLE.empty_table()
        model, part = pairs["model"][0].as_py(), pairs["part"][0].as_py()
        starts = np.flatnonzero(np.append(True, dst[1:] != dst[:-1]))
        if factors is None and pairs["lead"][0].as_py():
            x = initial_factors(dst[starts], rank, seed)
        else:
            if factors is None:
                known = np.unique(src)
                table = initial_factors(known, rank, seed)
            else:
                known = factors["src"].to_numpy()
                order = np.argsort(known, kind="stable")
                known = known[order]
                table = factors["f"].combine_chunks().flatten().to_numpy().reshape(-1, rank)[order]
            x = solve_groups(table.astype(float), np.searchsorted(known, src), starts, c, s,
                             np.ones(len(starts), bool), reg, strict)[0].astype(np.float32)
        if last:
            return pa.table({"model": pa.array([model] * len(starts), pa.int32()),
                             "id": pa.array(dst[starts], pa.int32()),
                             "features": _lists(x.ravel(), np.arange(len(starts)) * rank, pa.float32())})
        owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(dst))))
        order = np.argsort(src, kind="stable")
        src, c, s, owner = src[order], c[order], s[order], owner[order]
        own = np.flatnonzero(np.append(True, src[1:] != src[:-1]))
        ends = np.append(own[1:], len(src))
        ata, atb = np.empty((len(own), len(upper[0]))), np.zeros((len(own), rank))
        for k in range(len(own)):
            square = np.zeros((rank, rank))
            for at in range(own[k], ends[k], BATCH_CELLS // rank):
                lot = slice(at, min(at + BATCH_CELLS // rank, ends[k]))
                f = x[owner[lot]].astype(float)
                square += f.T @ (f * c[lot, None])
                atb[k] += f.T @ s[lot]
            ata[k] = square[upper]
        return pa.table({
            "model": pa.array([model] * len(own), pa.int32()), "id": pa.array(src[own], pa.int32()),
            "part": pa.array([part] * len(own), pa.int32()),
            "ata": _lists(ata.ravel(), np.arange(len(own)) * ata.shape[1], pa.float64()),
            "atb": _lists(atb.ravel(), np.arange(len(own)) * rank, pa.float64()),
            "n": pa.array(np.add.reduceat(c, own), pa.float64())})

    return run


_SUMS_TABLE = pa.schema([("model", pa.int32()), ("id", pa.int32()), ("part", pa.int32()),
                         ("ata", pa.list_(pa.float64())), ("atb", pa.list_(pa.float64())), ("n", pa.float64())])
_FACTORS_TABLE = pa.schema([("model", pa.int32()), ("id", pa.int32()), ("features", pa.list_(pa.float32()))])


def _few(rank: int, reg: float, strict: bool) -> Callable:
    """applyInArrow body for one of few ids: adds up what the parts summed, in
    their order, and solves."""
    upper = np.triu_indices(rank)

    def run(sums: pa.Table) -> pa.Table:
        sums = sums.sort_by("part")
        cells = lambda name: sums[name].combine_chunks().flatten().to_numpy().reshape(len(sums), -1).sum(axis=0)
        ata = np.zeros((1, rank, rank))
        ata[0][upper] = cells("ata")
        ata[0].T[upper] = ata[0][upper]
        n = float(sums["n"].to_numpy().sum())
        x = _solutions(ata + reg * n * np.eye(rank), cells("atb").reshape(1, rank), strict)[0]
        return pa.table({"model": sums["model"][:1], "id": sums["id"][:1],
                         "to": pa.array([sums["part"].to_numpy()], pa.list_(pa.int32())),
                         "features": pa.array([x.astype(np.float32)], pa.list_(pa.float32()))})

    return run


# ---------------------------------------------------------------------------
# Half-iterations
# ---------------------------------------------------------------------------
@dataclass
class _Side:
    """The pairs as one half-iteration needs them: those of an id (``dst``)
    together, partners called ``src``; ``to`` is the part that the id's factor
    goes to."""

    pairs: DataFrame  # part, model, dst, salt, groups, src, c, s, to; partitioned by part, sorted
    salted: bool


def _side(pairs: DataFrame, dst: str, src: str, partitions: int, salted: bool) -> _Side:
    own = pairs.select(F.col(f"part_{dst}").alias("part"), "model", F.col(dst).alias("dst"),
                       F.col(f"salt_{dst}").alias("salt"), F.col(f"groups_{dst}").alias("groups"),
                       F.col(src).alias("src"), "c", "s", F.col(f"part_{src}").alias("to"))
    laid = own.repartition(partitions, "part").sortWithinPartitions("part", "dst", "salt", "src")
    return _Side(laid.persist(), salted)


def _half_step(side: _Side, sent: DataFrame | None, rank: int, reg: float, seed: int, strict: bool,
               scratch: Scratch) -> DataFrame:
    """(model, id, to, features): one side solved, given the other's factors
    (part, src, f)."""
    body = _equations(rank, reg, seed, strict)
    pairs = side.pairs.groupBy("part")
    if sent is None:
        step = pairs.applyInArrow(lambda part: body(part), _STEP)
    else:
        step = pairs.cogroup(sent.groupBy("part")).applyInArrow(lambda part, factors: body(part, factors), _STEP)
    columns = ["model", "id", "to", "features"]
    if not side.salted:
        return step.select(*columns)
    step = scratch.write(step, "wals-step")  # read twice below
    combined = step.where("not final").groupBy("model", "id").applyInPandas(
        _combine(rank, reg, strict), "model int, id int, `to` array<int>, features array<float>")
    return step.where("final").select(*columns).unionByName(combined)


def _sent(step: DataFrame) -> DataFrame:
    return step.select(F.explode("to").alias("part"), F.col("id").alias("src"), F.col("features").alias("f"))


def _fit_local(pairs: DataFrame, sizes: dict[int, ModelSize], rank: int, max_iter: int, reg: float, seed: int,
               strict: bool, every: int, scratch: Scratch, caches: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(users, items) of models with few ids on one side.  ``lead``: the few are
    the items, which are solved first, from initial users."""
    lead = [model for model, size in sizes.items() if size.items <= size.users]
    first, at = {}, 0
    for model, size in sorted(sizes.items()):
        first[model] = at
        at += size.local_parts(rank)
    pick = lambda values: F.element_at(F.map_from_arrays(
        F.array(*[F.lit(m) for m in values]), F.array(*[F.lit(v) for v in values.values()])), F.col("model"))
    leads = F.col("model").isin(lead)
    part = pick(first) + F.pmod(F.xxhash64("dst"), pick({m: size.local_parts(rank) for m, size in sizes.items()}))
    tasks = max(1, min(at, max(pairs.sparkSession.sparkContext.defaultParallelism, math.ceil(at / 2))))
    laid = (pairs.select("model", leads.alias("lead"), F.when(leads, F.col("u")).otherwise(F.col("i")).alias("dst"),
                         F.when(leads, F.col("i")).otherwise(F.col("u")).alias("src"), "c", "s")
            .withColumn("part", part.cast("int")).repartition(tasks, "part").sortWithinPartitions("part", "dst", "src")
            .persist())
    caches.append(laid)

    def parts(own: DataFrame, few: DataFrame | None, last: bool) -> DataFrame:
        body = _local(rank, reg, seed, strict, last)
        schema = _FACTORS if last else _SUMS
        if few is None:
            return own.groupBy("part").applyInArrow(lambda part: body(part), schema)
        return own.groupBy("part").cogroup(_sent(few).groupBy("part")).applyInArrow(
            lambda part, factors: body(part, factors), schema)

    few = before = None
    for it in range(1, max_iter + 1):
        before = few
        few = parts(laid, few, False).groupBy("model", "id").applyInArrow(
            _few(rank, reg, strict), "model int, id int, `to` array<int>, features array<float>")
        if it >= max_iter - 1 or it % every == 0:
            few = scratch.write(few, "wals-few")
    few_of = few.select("model", "id", "features")
    users = parts(laid.where("lead"), few.where(leads), True).unionByName(few_of.where(~leads))
    if before is not None:
        before = before.where(~leads)
    return users, parts(laid.where("not lead"), before, True).unionByName(few_of.where(leads))


def fit_models(pairs: DataFrame, *, rank: int = 70, max_iter: int = 10, reg_param: float = 0.01, seed: int = 123,
               target_pairs: int = TARGET_PAIRS, checkpoint_interval: int = 10, strict: bool = True,
               scratch: Scratch, keep: Callable[[DataFrame, str], DataFrame] = materialize,
               sizes: dict[int, ModelSize] | None = None) -> tuple[DataFrame, DataFrame]:
    """User and item factors (model, id, features) of the models whose pairs
    (model, u, i, c, s) are given, written by ``keep``.

    ``pairs`` is read several times: a written table; ``sizes``: its
    ``model_sizes``, if known.  Half-iterations chain lazily; every
    ``checkpoint_interval`` iterations both sides' factors are written, so a lost
    executor costs at most that many iterations.  A singular system (no
    regularisation) raises if ``strict``; else its factor is NaN."""
    if max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    sizes = model_sizes(pairs) if sizes is None else sizes
    if not sizes:
        raise ValueError("no usable ratings to factorise")
    local = {model: size for model, size in sizes.items() if size.local_parts(rank)}
    other = {model: size.pairs for model, size in sizes.items() if model not in local}
    every = max(1, checkpoint_interval)
    caches, fits = [], []
    try:
        if local:
            own = pairs.where(F.col("model").isin(list(local)))
            fits.append(_fit_local(own, local, rank, max_iter, reg_param, seed, strict, every, scratch, caches))
        if other:
            own = pairs.where(F.col("model").isin(list(other))) if local else pairs
            fits.append(_fit_sent(own, other, rank, max_iter, reg_param, seed, target_pairs, strict, every, scratch,
                                  caches))
        sides = [fits[0][k].unionByName(fits[1][k]) if len(fits) == 2 else fits[0][k] for k in (0, 1)]
        return tuple(keep(side, "wals-factors") for side in sides)
    finally:
        for laid in caches:
            laid.unpersist()


def _fit_sent(pairs: DataFrame, sizes: dict[int, int], rank: int, max_iter: int, reg: float, seed: int,
              target_pairs: int, strict: bool, every: int, scratch: Scratch,
              caches: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(users, items) of models of which both sides' factors are sent."""
    tasks = max(pairs.sparkSession.sparkContext.defaultParallelism, math.ceil(sum(sizes.values()) / PARTITION_PAIRS))
    for dst, src in (("u", "i"), ("i", "u")):
        pairs = _with_salt(pairs, dst, src, _heavy_bound(pairs, dst, target_pairs))
    gu, gi = pairs.agg(F.max("groups_u"), F.max("groups_i")).first()
    pairs = pairs.withColumn("part_u", _part("u", sizes, tasks)).withColumn("part_i", _part("i", sizes, tasks))
    by_u, by_i = _side(pairs, "u", "i", tasks, gu > 1), _side(pairs, "i", "u", tasks, gi > 1)
    caches += [by_u.pairs, by_i.pairs]
    solve = lambda side, sent: _half_step(side, sent, rank, reg, seed, strict, scratch)
    users = None
    for it in range(1, max_iter + 1):
        items = solve(by_i, None if users is None else _sent(users))
        if it == max_iter or it % every == 0:
            items = scratch.write(items, "wals-items")
        users = solve(by_u, _sent(items))
        if it == max_iter or it % every == 0:
            users = scratch.write(users, "wals-users")
    return tuple(side.select("model", "id", "features") for side in (users, items))


def fit_pair_factors(df: DataFrame, user: str, item: str, rating: str, *,
                     cold_start: str = "drop", broadcast_mb: float | None = BROADCAST_FACTORS_MB,
                     prediction: str = "prediction", rank: int = 70, **params) -> PairFactors:
    """Fit one model on rows with non-null int ids and a rating (callers
    filter); the other parameters are those of ``fit_models``."""
    with Scratch(df.sparkSession) as scratch:
        pairs = scratch.write(aggregate_pairs(df, user, item, rating).withColumn("model", F.lit(0)), "wals-pairs")
        users, items = fit_models(pairs, rank=rank, scratch=scratch, **params,
                                  keep=lambda side, name: materialize(side.drop("model"), name))
    return PairFactors(users, items, rank, user, item, cold_start, prediction, broadcast_mb)
