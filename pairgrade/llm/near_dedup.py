"""MinHash near-dedup by a multi-index Hamming join.

A document's signature has one b-bit symbol for each of several hash functions:
low bits of the least hash of its shingles.  The share of symbols in which two
documents differ follows the distance of their shingle sets.  The signature is
split into chunks; by the pigeonhole principle two signatures that differ in
fewer than ``chunks * (errors + 1)`` symbols differ in at most ``errors``
symbols of some chunk, and so share that chunk with some ``errors`` symbols
left out.  All those remainders are the index keys: every pair within that
distance meets (and by far most pairs beyond it that are as similar as the
threshold).  Pairs that meet are held against their whole signatures; those not
far apart are confirmed on their full sets.

No pairs are listed within a group.  Documents with equal sets are one node.
In each of the first rounds the nodes of a key are compared with one of them,
and what links becomes one component.  Then the nodes of different components
that still share a key meet in units of bounded size, a pair under its first
common key only.  Signatures go there first; texts only of nodes that have a
partner close enough, once for a unit and not once for a pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairgrade.llm.bitmap import flag_in
from pairgrade.llm.common import Words, gram_hashes, id_text, lower_ascii, mix, slices, text_buffers, text_hash
from pairgrade.llm.components import components
from pairgrade.llm.countmin import DEPTH, cell_bits, estimated_repeated, repeated_cells
from pairgrade.sources.sinks import materialize

SHINGLE = 5
PERCENT = 80
SYMBOLS = 240
CHUNK = 10
ERRORS = 1
STAR_ROUNDS = 2
MEMBERS = 500
#: Nodes of a unit: heads (kept in memory) and those that are compared with them.
HEADS, OTHERS = 256, 2048


# ---------------------------------------------------------------------------
# Sets and signatures
# ---------------------------------------------------------------------------
def shingle_sets(raw: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, where each text's begin): the distinct shingles of each text,
    ascending; a text of fewer words has one, the whole."""
    words = Words(lower_ascii(raw), at, "visible")
    h, counts = words.hashes(), words.counts()
    ok = words.gram_ok(size)
    x, owner = gram_hashes(h, size)[ok], words.text_of()[ok]
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        alone = [mix(gram_hashes(h[words.first[t]:words.first[t + 1]], int(counts[t]))[:1]
                     + np.uint64(counts[t])) for t in few]
        x, owner = np.concatenate([x, *alone]), np.concatenate([owner, few])
    order = np.lexsort((x, owner))
    x, owner = x[order], owner[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (owner[1:] != owner[:-1])
    x, owner = x[new], owner[new]
    return x, np.searchsorted(owner, np.arange(len(at)))


def signatures(x: np.ndarray, first: np.ndarray, symbols: int, seed: int = 5) -> np.ndarray:
    """A row of 16-bit symbols for each set that isn't empty."""
    starts = first[:-1][np.diff(first) > 0]
    rng = np.random.default_rng(seed)
    out = np.zeros((len(starts), symbols), np.uint16)
    if len(starts):
        for j in range(symbols):
            turn, odd = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
            least = np.minimum.reduceat((x ^ turn) * (odd | np.uint64(1)), starts)
            out[:, j] = (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def left_out(chunk: int, errors: int) -> np.ndarray:
    """A row for each key of a chunk: which of its symbols are left out."""
    rows = np.ones((math.comb(chunk, errors), chunk), bool)
    for n, kept in enumerate(combinations(range(chunk), chunk - errors)):
        rows[n, list(kept)] = False
    return rows


def index_keys(sig: np.ndarray, chunk: int, errors: int) -> np.ndarray:
    """For each row of symbols its keys: every chunk with every choice of
    ``errors`` symbols left out."""
    keys = []
    for c in range(0, sig.shape[1], chunk):
        for n, out in enumerate(left_out(chunk, errors)):
            h = np.full(len(sig), (c << 16) + n, np.uint64)
            for j in np.flatnonzero(~out):
                h = mix(h ^ sig[:, c + j].astype(np.uint64))
            keys.append(h)
    return np.stack(keys, axis=1)


def far_apart(symbols: int, percent: int) -> int:
    """Differing symbols that a pair at the threshold does not exceed but once
    in a billion times (6.5 deviations)."""
    q = 1 - percent / 100
    return int(symbols * q + 6.5 * math.sqrt(symbols * q * (1 - q)))


def near_heads(heads: np.ndarray, sig: np.ndarray, place: int, chunk: int, out: np.ndarray, far: int) -> np.ndarray:
    """Which ``heads`` (rows of symbols) are at most ``far`` from ``sig`` and
    share no key with it before the one at ``place``."""
    differ = heads != sig
    near = differ.sum(axis=1) <= far
    if near.any():
        errors = int(out[0].sum())
        wrong = differ.reshape(len(heads), -1, chunk)
        c, n = divmod(place, len(out))
        near &= (wrong.sum(axis=2) <= errors).argmax(axis=1) == c
        near &= (~(wrong[:, c, None, :] & ~out).any(axis=2)).argmax(axis=1) == n
    return near


def signed(own: DataFrame, size: int, symbols: int) -> DataFrame:
    """(doc_id, mark, n_shingles, digest, sig): a digest and the signature of the
    set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            x, first = shingle_sets(*text_buffers(part.column(1)), size)
            n = np.diff(first)
            some = np.flatnonzero(n)
            digests = np.zeros((2, len(n)), np.uint64)
            if len(some):
                for k in (0, 1):
                    sums = np.add.reduceat(mix(x + np.uint64(k)), first[:-1][some])
                    digests[k, some] = mix(sums ^ n[some].astype(np.uint64))
            sig = np.zeros(len(n), object)
            for i, row in zip(some, signatures(x, first, symbols)):
                sig[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array(digests[0].view(np.int64)),
                 pa.array(digests[1].view(np.int64)), pa.array([s or None for s in sig], pa.binary())],
                names=["doc_id", "mark", "n_shingles", "d1", "d2", "sig"])

    return own.select("doc_id", "text", "mark").mapInArrow(
        run, "doc_id bigint, mark bigint, n_shingles bigint, d1 bigint, d2 bigint, sig binary") \
        .select("doc_id", "mark", "n_shingles", F.struct("d1", "d2").alias("digest"), "sig")


def shared_keys(nodes: DataFrame, chunk: int, errors: int, n_keys: int) -> DataFrame:
    """(key, place, node) of the keys that more than one node has, and of some
    others; written."""
    def keys_of(part: pa.RecordBatch) -> np.ndarray:
        sig = np.frombuffer(b"".join(part.column(part.schema.get_field_index("text")).to_pylist()), np.uint16)
        return index_keys(sig.reshape(part.num_rows, -1), chunk, errors)

    bits = cell_bits(n_keys)
    flat = nodes.select("node", F.col("sig").alias("text"))
    sent = nodes.sparkSession.sparkContext.broadcast(
        repeated_cells(flat.select("text"), lambda part: keys_of(part).ravel(), DEPTH, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, max_bytes=1 << 20):
            keys = keys_of(part)
            live = np.flatnonzero(estimated_repeated(sent.value, keys.ravel(), bits))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()[live].view(np.int64)), pa.array(live % keys.shape[1], pa.int32()),
                 part.column(0).take(pa.array(live // keys.shape[1]))], names=["key", "place", "node"])

    found = materialize(flat.mapInArrow(run, "key bigint, place int, node bigint"), "keys")
    sent.unpersist()
    return found


# ---------------------------------------------------------------------------
# Confirmation
# ---------------------------------------------------------------------------
def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose sets share ``percent`` in a hundred of their
    union.  A task reads a's text, then each b's; an a with many partners is
    spread over several tasks, each with a copy of its text."""
    salts = F.ceil(F.col("partners") / MEMBERS).cast("int")
    counted = pairs.groupBy("a").agg(F.count("*").alias("partners")).withColumn("salts", salts)
    heads = (counted.join(texts.withColumnRenamed("node", "a"), "a")
             .select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                     F.lit(None).cast("bigint").alias("b"), "text"))
    members = (pairs.join(counted, "a")
               .withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
               .select("a", "salt", "b").join(texts.withColumnRenamed("node", "b"), "b")
               .select("a", "salt", "b", "text"))
    laid = (heads.unionByName(members).repartition("a", "salt")
            .sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()).select("a", "salt", "b", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, head = None, None
        for part in slices(batches):
            x, first = shingle_sets(*text_buffers(part.column(3)), size)
            found = []
            for i, (a, salt, b) in enumerate(zip(*(part.column(k).to_pylist() for k in range(3)))):
                own = x[first[i]:first[i + 1]]
                if b is None:
                    group, head = (a, salt), own.copy()
                elif group == (a, salt):
                    both = len(np.intersect1d(head, own, assume_unique=True))
                    if 100 * both >= percent * (len(head) + len(own) - both):
                        found.append((a, b))
            yield _pairs(found)

    return laid.mapInArrow(run, "a bigint, b bigint")


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], []))],
                                      names=["a", "b"])


def _close(pairs: DataFrame, nodes: DataFrame, far: int) -> DataFrame:
    """The ``pairs`` (a, b) whose signatures differ in at most ``far`` symbols."""
    sig = lambda side: nodes.select(F.col("node").alias(side), F.col("sig").alias(f"sig_{side}"))
    both = pairs.join(sig("a"), "a").join(sig("b"), "b").select("a", "b", "sig_a", "sig_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                a, b = (np.frombuffer(b"".join(part.column(n).to_pylist()), np.uint16).reshape(part.num_rows, -1)
                        for n in (2, 3))
                yield part.select([0, 1]).filter(pa.array((a != b).sum(axis=1) <= far))

    return both.mapInArrow(run, "a bigint, b bigint")


def _apart(keys: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The rows of keys that nodes of several components have, with ``comp`` and
    the key's least and greatest one (``low``, ``high``); written."""
    own = keys.withColumn("comp", F.col("node")) if labels is None else (
        keys.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    per_key = own.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
    return materialize(own.join(per_key, "key"), "apart")


def _star_pairs(apart: DataFrame, center: str) -> DataFrame:
    """For each node the partner that it meets most often, when each key's
    partner is the first node of its least or greatest component."""
    return (apart.where(F.col(center) != F.col("comp"))
            .groupBy("node", center).agg(F.count("*").alias("n"))
            .groupBy("node").agg(F.max(F.struct("n", F.col(center).alias("center"))).alias("best"))
            .select(F.col("best.center").alias("a"), F.col("node").alias("b")))


def _units(apart: DataFrame) -> DataFrame:
    """(key, x, y, other, few, place, node, comp): of any pair of components
    under a key one is outside the key's largest.  Nodes outside of it (``few``)
    are heads; their blocks meet the blocks of all the key's nodes."""
    sizes = (apart.groupBy("key", "comp").agg(F.count("*").alias("n"))
             .groupBy("key").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("n"))
             .select("key", F.col("top.comp").alias("largest"),
                     F.ceil((F.col("n") - F.col("top.n")) / HEADS).cast("int").alias("xs"),
                     F.ceil(F.col("n") / OTHERS).cast("int").alias("ys")))
    own = (apart.select("key", "place", "node", "comp").join(sizes, "key")
           .withColumn("few", F.col("comp") != F.col("largest")))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    columns = ["key", "x", "y", "other", "few", "place", "node", "comp"]
    heads = own.where("few").withColumn("x", block("xs")).withColumn("y", each("ys")).withColumn("other", F.lit(False))
    others = own.withColumn("y", block("ys")).withColumn("x", each("xs")).withColumn("other", F.lit(True))
    return heads.select(*columns).unionByName(others.select(*columns))


_UNIT = "key bigint, x int, y int, other boolean, few boolean, place int, node bigint, comp bigint"


def _laid(units: DataFrame, *more: str) -> DataFrame:
    """Units one after the other, heads first."""
    return (units.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "other")
            .select("key", "x", "y", "other", "few", "place", "node", "comp", "sig", *more))


class _Unit:
    """The heads of the unit at hand, and the pairs of one more node with them."""

    def __init__(self, chunk: int, errors: int, far: int):
        self.chunk, self.out, self.far = chunk, left_out(chunk, errors), far
        self.at: tuple | None = None

    def meet(self, row: tuple, sig: bytes) -> list[int] | None:
        """The numbers of the heads to compare with, or none for a head, which
        is taken in."""
        key, x, y, other, few, place, node, comp = row
        if self.at != (key, x, y):
            self.at, self.heads, self.sigs, self.matrix = (key, x, y), [], [], None
        if not other:
            self.heads.append(row)
            self.sigs.append(sig)
            self.matrix = None
            return None
        if not self.heads:
            return []
        if self.matrix is None:
            self.matrix = np.frombuffer(b"".join(self.sigs), np.uint16).reshape(len(self.heads), -1)
        near = np.flatnonzero(near_heads(self.matrix, np.frombuffer(sig, np.uint16), place, self.chunk, self.out, self.far))
        # two heads meet twice, and count once
        return [n for n in near.tolist() if self.heads[n][7] != comp and (not few or self.heads[n][6] < node)]


def _screened(units: DataFrame, nodes: DataFrame, chunk: int, errors: int, far: int) -> DataFrame:
    """The rows of ``units`` with a partner that is close enough; written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = _Unit(chunk, errors, far)
        told: set[int] = set()
        names = [f.split()[0] for f in _UNIT.split(", ")]
        for part in batches:
            rows = []
            for row, sig in zip(zip(*(part.column(n).to_pylist() for n in range(8))), part.column(8).to_pylist()):
                if unit.at != row[:3]:
                    told.clear()
                met = unit.meet(row, sig)
                if met:
                    rows += [unit.heads[n] for n in met if n not in told] + [row]
                    told.update(met)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(
                zip(*rows) if rows else [[]] * 8, part.schema)], names=names)

    laid = _laid(units.join(nodes.select("node", "sig"), "node"))
    return materialize(laid.mapInArrow(run, _UNIT), "screened")


def _linked(screened: DataFrame, nodes: DataFrame, texts: DataFrame, size: int, percent: int, chunk: int, errors: int,
            far: int) -> DataFrame:
    """(a, b): links that join all components which have a link in some unit."""
    laid = _laid(screened.join(nodes.select("node", "sig"), "node").join(texts, "node"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = _Unit(chunk, errors, far)
        sets: list[np.ndarray] = []
        root: dict[int, int] = {}

        def find(c):
            while c in root:
                c = root[c]
            return c

        for part in slices(batches):
            x, first = shingle_sets(*text_buffers(part.column(9)), size)
            found = []
            columns = [part.column(n).to_pylist() for n in range(8)]
            for i, (row, sig) in enumerate(zip(zip(*columns), part.column(8).to_pylist())):
                if unit.at != row[:3]:
                    sets, root = [], {}
                own, met = x[first[i]:first[i + 1]], unit.meet(row, sig)
                if met is None:
                    sets.append(own.copy())
                    continue
                for n in met:
                    a, b = find(unit.heads[n][7]), find(row[7])
                    if a == b:
                        continue
                    at = np.searchsorted(own, sets[n])
                    both = int((own[np.minimum(at, len(own) - 1)] == sets[n]).sum())
                    if 100 * both >= percent * (len(own) + len(sets[n]) - both):
                        root[a] = b
                        found.append((unit.heads[n][6], row[6]))
            yield _pairs(found)

    return laid.mapInArrow(run, "a bigint, b bigint")


def _texts(own: DataFrame, nodes: DataFrame, needed: DataFrame) -> DataFrame:
    """(node, text) of the nodes ``needed``; of the texts only theirs (and a few
    that a bitmap takes for theirs) are shuffled."""
    met = nodes.join(needed.distinct(), "node").select("node", "least.doc_id", F.col("least.mark").alias("mark"))
    row = F.xxhash64("doc_id", "mark")
    return (flag_in(own.where("doc_id is not null").withColumn("row", row), "row", met.select(row.alias("mark")), "met")
            .where("met").select("doc_id", "mark", "text").dropDuplicates(["doc_id", "mark"])
            .join(met, ["doc_id", "mark"]).select("node", "text"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, symbols: int = SYMBOLS,
                    chunk: int = CHUNK, errors: int = ERRORS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, mark, n_shingles, component_id, kept), one row per input row;
    ``mark`` tells apart rows that share an id.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a set
    holds the distinct runs of ``size`` words (a text of fewer words: the whole
    of it).  Linked are sets that share ``percent`` in a hundred of their union;
    ``component_id`` is the least id reachable.  Null and empty texts have an
    empty set and are linked with nothing; a row without an id plays no part
    (``component_id`` null, kept); rows that repeat an id are judged each by
    its text; other columns are ignored.

    An empty table gives no rows; a task needs memory for its longest text, and
    for the sets of a unit's heads.

    Complete up to a signature distance of ``symbols / chunk * (errors + 1) - 1``
    symbols; at the threshold itself about one pair in 80,000 shares no key.
    """
    own = id_text(docs, id_col, text_col).withColumn("mark", text_hash())
    base = materialize(signed(own, size, symbols), "signatures")
    nodes = (base.where("n_shingles > 0 and doc_id is not null").groupBy("digest")
             .agg(F.min(F.struct("doc_id", "mark")).alias("least"), F.first("sig").alias("sig"))
             .withColumn("node", F.monotonically_increasing_id()))
    nodes = materialize(nodes, "nodes")  # numbers that are short to shuffle; written, so they stay
    per_node = symbols // chunk * math.comb(chunk, errors)
    keys = shared_keys(nodes, chunk, errors, nodes.count() * per_node)

    labels, far = None, far_apart(symbols, percent)
    for turn in range(STAR_ROUNDS):
        apart = _apart(keys, labels)
        keys = apart.select("key", "place", "node")  # a key of one component is done with
        close = materialize(_close(_star_pairs(apart, "high" if turn % 2 else "low"), nodes, far), "pairs")
        needed = close.select(F.explode(F.array("a", "b")).alias("node"))
        links = materialize(confirmed(close, _texts(own, nodes, needed), size, percent), "links")
        if not links.isEmpty():
            labels = components(links, labels)
    screened = _screened(_units(_apart(keys, labels)), nodes, chunk, errors, far)
    texts = _texts(own, nodes, screened.select("node"))
    links = materialize(_linked(screened, nodes, texts, size, percent, chunk, errors, far), "links")
    if not links.isEmpty():
        labels = components(links, labels)

    if labels is None:
        of_node = nodes.select("digest", F.col("least.doc_id").alias("component_id"))
    else:
        placed = nodes.join(labels, "node", "left").select("digest", F.coalesce("comp", "node").alias("comp"),
                                                           "least.doc_id")
        heads = placed.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
        of_node = placed.join(heads, "comp").select("digest", "component_id")
    return (base.join(of_node, "digest", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNull(), F.lit(None).cast("bigint"))
                        .when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
            .select("doc_id", "mark", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))
