"""Line dedup: equal lines, and lines within a small edit distance.

Near lines are found by a segment-partition join.  A line is cut into one
segment more than the distance allowed; a line within that distance must hold
one of the segments unchanged, not far from its place.  So the segments of each
length are an index, and a line probes it with its substrings of those sizes
at the places that its length and the segment's number leave possible.  What
meets is verified by a banded bit-parallel edit distance.

Lines and segment keys that nothing else shares are held back by a count-min
sketch; what is left is grouped by key, in blocks of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairgrade.llm.bitmap import flag_in
from pairgrade.llm.common import id_text, mix, slices, texts_of, text_hash
from pairgrade.llm.countmin import DEPTH, cell_bits, estimated_repeated, repeated_cells
from pairgrade.sources.sinks import materialize

DISTANCE = 2
MIN_CHARS = 20
BLOCK_ROWS = 20_000
_R = np.uint64(0x5851F42D4C957F2D)


# ---------------------------------------------------------------------------
# Edit distance
# ---------------------------------------------------------------------------
def within(a: str, b: str, limit: int) -> bool:
    """Whether the edit distance of two texts is ``limit`` at most.

    What both begin and end with is left out.  The rest is compared a column
    (a character of the longer text) at a time: the differences between
    neighbouring cells are the bits of two words that hold only the band of
    cells that ``limit`` edits can reach, so a step costs the same whatever the
    length, and the band's lower end tells when to stop."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > limit:
        return False
    lo, top = 0, len(a)
    if a == b:
        return True
    step = 64
    while lo < top and a[lo:lo + step] == b[lo:lo + step]:
        lo += step
    lo = min(lo, top)
    while lo < top and a[lo] == b[lo]:
        lo += 1
    end = 0
    while end < top - lo and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[lo:len(a) - end], b[lo:len(b) - end]
    if not a or not limit:
        return len(b) <= limit
    return _banded(a, b, limit)


def _banded(a: str, b: str, limit: int) -> bool:
    """Bit ``i`` of the words stands for the cell ``i`` rows below the band's
    upper edge, which moves down a row with each column."""
    m, n = len(a), len(b)
    width = 2 * limit + 1
    full = (1 << width) - 1
    # before the first column the band covers rows -limit .. limit; rows below 0 cost their depth
    plus, minus = (full >> limit << limit) & full, (1 << limit) - 1
    low = limit  # the value at the band's lowest row
    for j in range(n):
        match = 0
        base = j - limit
        for i in range(max(0, -base), min(width, m - base)):
            if a[base + i] == b[j]:
                match |= 1 << i
        # Myers' step with the band moving along the diagonal
        d0 = ((((match & plus) + plus) ^ plus) | match | minus) & full
        hp = (minus | ~(d0 | plus)) & full
        hm = plus & d0
        low += 1 - (d0 >> (width - 1) & 1)
        x = d0 >> 1
        plus = (hm | ~(x | hp)) & full
        minus = x & hp
        if low - limit > 2 * limit:  # no cell of the band can come back
            return False
    # from the band's lowest row, n - 1 + limit + 1, up to row m
    value = low
    for row in range(n + limit, m, -1):
        bit = 1 << (row - (n - limit) - 1)
        value += bool(minus & bit) - bool(plus & bit)
    return value <= limit


# ---------------------------------------------------------------------------
# Segment keys
# ---------------------------------------------------------------------------
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def segment_keys(lines: list[str], distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the line, key, whether it is an index key) of every key of
    the lines, which are longer than twice the distance.  All keys probe; those
    of a line's own segments at their own places are the index as well."""
    size = np.array([len(x) for x in lines], np.int64)
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    start = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points + np.uint64(1)) * _powers(int(_R), len(points)), out=total[1:])
    shift = _powers(pow(int(_R), -1, 1 << 64), len(points) + 1)
    parts, out = distance + 1, []
    for less in range(parts):
        indexed = size - less  # the length of the index that is probed
        base, longer = indexed // parts, indexed % parts
        for i in range(parts):
            extra = i - (parts - longer)  # the last ``longer`` segments have one character more
            place = i * base + np.maximum(extra, 0)
            span = base + (extra >= 0)
            for move in range(-distance, distance + 1):
                ok = (abs(move) <= i) & (abs(move - less) <= distance - i)
                if not ok:
                    continue
                at = place + move
                inside = np.flatnonzero((at >= 0) & (at + span <= size))
                lo = start[inside] + at[inside]
                h = (total[lo + span[inside]] - total[lo]) * shift[lo]
                tag = (indexed[inside] * parts + i).astype(np.uint64)
                out.append((inside, mix(h ^ mix(tag)), np.full(len(inside), less == 0 and move == 0)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _digest(line: str) -> tuple[int, int]:
    raw = hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def _groups(lines: list[str], chars: int = 2 << 20) -> Iterator[tuple[int, list[str]]]:
    """Runs of lines of about ``chars`` characters, with the first one's number."""
    lo, held = 0, 0
    for hi, line in enumerate(lines):
        held += len(line)
        if held >= chars:
            yield lo, lines[lo:hi + 1]
            lo, held = hi + 1, 0
    if lo < len(lines):
        yield lo, lines[lo:]


# ---------------------------------------------------------------------------
# The passes
# ---------------------------------------------------------------------------
FLUSH_CHARS = 16 << 20
_ROWS = ("kind string, key bigint, h1 bigint, h2 bigint, indexed boolean, "
         "doc_id bigint, mark bigint, line int, text string")
_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(),
          pa.string()]


class _Held:
    """Lines of some documents: each different one with its first place, and
    the places that an earlier equal line covers."""

    def __init__(self):
        self.first: dict[tuple[int, int], tuple[tuple, str]] = {}
        self.gone: list[tuple] = []
        self.chars = 0

    def add(self, digest: tuple[int, int], place: tuple, line: str) -> None:
        met = self.first.get(digest)
        if met is None:
            self.first[digest] = place, line
            self.chars += len(line)
        elif place < met[0]:
            self.gone.append(met[0])
            self.first[digest] = place, line
        elif place > met[0]:
            self.gone.append(place)


def _lines(part: pa.RecordBatch, least: int) -> Iterator[tuple[int, int, str]]:
    for row, text in enumerate(texts_of(part)):
        for n, line in enumerate(text.split("\n")):
            if len(line) >= least:
                yield row, n, line


def shared_lines(own: DataFrame, distance: int, least: int, sketch_bits: int) -> DataFrame:
    """What may be shared (written), by kind: ``line`` (an equal line may exist
    elsewhere), ``key`` (a segment key that another line may hold), ``text``
    (of a line with such a key), ``gone`` (covered by an equal line of the same
    partition)."""
    def hashes(part: pa.RecordBatch) -> np.ndarray:
        lines = [line for _, _, line in _lines(part, least)]
        digests = [_digest(x) for x in lines]
        once = list({d: x for d, x in zip(digests, lines)}.values())
        return np.concatenate([np.array([d[0] for d in digests], np.int64).view(np.uint64),
                               *(segment_keys(some, distance)[1] for _, some in _groups(once))])

    sent = own.sparkSession.sparkContext.broadcast(repeated_cells(own.select("text"), hashes, DEPTH, sketch_bits))

    def told(held: _Held) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)],
                                              names=[x.split()[0] for x in _ROWS.split(", ")])

        if held.gone:
            yield batch([("gone", None, None, None, None, *place, None) for place in held.gone])
        digests, firsts = list(held.first), list(held.first.values())
        h1 = np.array([d[0] for d in digests], np.int64).view(np.uint64)
        again = np.flatnonzero(estimated_repeated(sent.value, h1, sketch_bits)).tolist()
        if again:
            yield batch([("line", None, *digests[i], None, *firsts[i][0], None) for i in again])
        for lo, some in _groups([line for _, line in firsts]):
            number, keys, indexed = segment_keys(some, distance)
            live = estimated_repeated(sent.value, keys, sketch_bits)
            number, keys, indexed = number[live] + lo, keys[live].view(np.int64), indexed[live]
            if len(number):
                yield batch([("key", k, *digests[i], x, *firsts[i][0], None)
                             for i, k, x in zip(number.tolist(), keys.tolist(), indexed.tolist())])
                yield batch([("text", None, *digests[i], None, None, None, None, firsts[i][1])
                             for i in np.unique(number).tolist()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for part in slices(batches):
            ids, marks = part.column(0).to_pylist(), part.column(2).to_pylist()
            for row, n, line in _lines(part, least):
                if ids[row] is not None:
                    held.add(_digest(line), (ids[row], marks[row], n), line)
            if held.chars >= FLUSH_CHARS:
                yield from told(held)
                held = _Held()
        yield from told(held)

    shared = materialize(own.select("doc_id", "text", "mark").mapInArrow(run, _ROWS), "shared-lines")
    sent.unpersist()
    return shared


def linked_lines(shared: DataFrame, distance: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, mark, line): first places of lines that another line, first met
    earlier, is within the distance of.

    The lines of a key are taken in order of first place, in blocks; each pair
    of blocks is a task's group of its own, so a key that very many lines hold
    is spread and no group outgrows two blocks."""
    place = F.struct("doc_id", "mark", "line")
    met = (shared.where("kind = 'key'").groupBy("key", "h1", "h2")
           .agg(F.min(place).alias("place"), F.max("indexed").alias("indexed")))
    of_key = Window.partitionBy("key")
    met = (met.withColumn("n", F.count("*").over(of_key))
           .withColumn("any_indexed", F.max("indexed").over(of_key))
           .where("n > 1 and any_indexed")
           .withColumn("block", ((F.row_number().over(of_key.orderBy("place")) - 1) / block_rows).cast("int"))
           .withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("int")))
    texts = shared.where("kind = 'text'").groupBy("h1", "h2").agg(F.first("text").alias("text"))
    own = F.transform(F.sequence(F.lit(0), F.col("block")), lambda j: F.struct(
        F.col("block").alias("later_block"), j.alias("earlier_block"), F.lit(True).alias("later"),
        (j == F.col("block")).alias("earlier")))
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: i > F.col("block"))
    ahead = F.transform(others, lambda i: F.struct(
        i.alias("later_block"), F.col("block").alias("earlier_block"), F.lit(False).alias("later"),
        F.lit(True).alias("earlier")))
    group = ["key", "later_block", "earlier_block"]
    tasks = (met.join(texts, ["h1", "h2"])
             .select("key", "place", "indexed", "text", F.explode(F.concat(own, ahead)).alias("t"))
             .select("key", "place.*", "indexed", "text", "t.*")
             .repartition(*group).sortWithinPartitions(*group, "doc_id", "mark", "line")
             .select(*group, "doc_id", "mark", "line", "indexed", "text", "later", "earlier"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, before = None, []
        for batch in batches:
            found = []
            for key, i, j, doc, mark, line, indexed, text, later, earlier in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if (key, i, j) != group:
                    group, before = (key, i, j), []
                if later and any((indexed or x) and within(other, text, distance) for x, other in before):
                    found.append((doc, mark, line))
                if earlier:
                    before.append((indexed, text))
            columns = list(zip(*found)) if found else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.int32())], names=["doc_id", "mark", "line"])

    return tasks.mapInArrow(verify, "doc_id bigint, mark bigint, line int")


def covered_lines(own: DataFrame, distance: int = DISTANCE, least: int = MIN_CHARS,
                  sketch_bits: int | None = None) -> DataFrame:
    """(doc_id, mark, line, near), written: the lines of ``own`` (doc_id, text,
    mark) that go; ``near`` are those that no equal line stands before."""
    if least <= 2 * distance:
        raise ValueError("lines must be longer than twice the distance")
    if sketch_bits is None:
        size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first().bytes
        sketch_bits = cell_bits(size // 16)
    shared = shared_lines(own, distance, least, sketch_bits)
    place = F.struct("doc_id", "mark", "line")
    equal = (shared.where("kind = 'line'")
             .withColumn("first", F.min(place).over(Window.partitionBy("h1", "h2")))
             .where(place != F.col("first")))
    covered = (shared.where("kind = 'gone'").unionByName(equal, allowMissingColumns=True)
               .select("doc_id", "mark", "line", F.lit(False).alias("near")))
    return materialize(covered.unionByName(linked_lines(shared, distance).withColumn("near", F.lit(True))),
                       "covered-lines")


def dedup_lines(docs: DataFrame, distance: int = DISTANCE, least: int = MIN_CHARS, id_col: str = "doc_id",
                text_col: str = "text", sketch_bits: int | None = None) -> DataFrame:
    """(doc_id, mark, n_lines, n_removed, n_near, kept, kept_sha256), one row
    per input row; ``kept`` is the lines left, joined by line feeds, ``mark``
    tells apart rows that share an id.

    A line of ``least`` characters or more goes if an equal line stands
    earlier (in a document with a smaller id, or above it), or if it is the
    first of its kind and a line within ``distance`` edits stands earlier.
    ``n_near`` counts the latter.  Shorter lines stay.  Null and empty texts
    have no lines; a null text is kept null.  A row without an id is kept whole
    and covers nothing.  Of rows that share an id but not a text one order
    holds; rows that repeat give equal rows; other columns are ignored.  Memory
    follows the longest line.
    """
    own = id_text(docs, id_col, text_col).withColumn("mark", text_hash())
    gone = covered_lines(own, distance, least, sketch_bits)
    touched = flag_in(own, "mark", gone, "touched")
    per_doc = (gone.groupBy("doc_id", "mark")
               .agg(F.collect_set("line").alias("gone"),
                    F.size(F.collect_set(F.when(F.col("near"), F.col("line")))).cast("bigint").alias("n_near")))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            n_lines, removed, kept, shas = [], [], [], []
            for text, lost in zip(part.column(1).to_pylist(), part.column(3).to_pylist()):
                lines = text.split("\n") if text else []
                lost = set(lost or ())
                left = "\n".join([x for i, x in enumerate(lines) if i not in lost]) if lost else text
                n_lines.append(len(lines))
                removed.append(len(lost))
                kept.append(left)
                shas.append(hashlib.sha256((left or "").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(n_lines, pa.int64()), pa.array(removed, pa.int64()),
                 part.column(4), pa.array(kept, pa.string()), pa.array(shas, pa.string())],
                names=["doc_id", "mark", "n_lines", "n_removed", "n_near", "kept", "kept_sha256"])

    # only texts that may lose lines are shuffled
    joined = (touched.where("touched").join(per_doc, ["doc_id", "mark"], "left")
              .select("doc_id", "text", "mark", "gone", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near")))
    whole = (touched.where("not touched")
             .select("doc_id", "text", "mark", F.lit(None).cast("array<int>").alias("gone"),
                     F.lit(0).cast("bigint").alias("n_near")))
    schema = ("doc_id bigint, mark bigint, n_lines bigint, n_removed bigint, n_near bigint, "
              "kept string, kept_sha256 string")
    return joined.mapInArrow(strip, schema).unionByName(whole.mapInArrow(strip, schema))


def without_lines(docs: DataFrame, gone: DataFrame, mark: str) -> DataFrame:
    """``docs`` (with the column ``mark`` to tell rows apart) without the lines
    ``gone``; ``n_chars`` follows.  Texts that lose no line are left as they
    are, those that lose all are left out.  Only texts that may lose lines are
    shuffled."""
    flagged = flag_in(docs, mark, gone, "_touched")
    whole = flagged.where("not _touched").drop("_touched", mark)
    per_doc = (gone.groupBy("doc_id", F.col("mark").alias(mark)).agg(F.collect_set("line").alias("_gone")))
    names = whole.columns

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_at, gone_at = names.index("text"), len(names)
        for part in slices(batches):
            kept, some = [], []
            for text, lost in zip(part.column(text_at).to_pylist(), part.column(gone_at).to_pylist()):
                lost = set(lost or ())
                left = [x for i, x in enumerate(text.split("\n")) if i not in lost] if lost else None
                some.append(left is None or any(left))
                kept.append(text if left is None else "\n".join(left))
            columns = {name: part.column(i) for i, name in enumerate(names)}
            columns["text"] = pa.array(kept, pa.string())
            if "n_chars" in columns:
                sizes = [None if t is None else len(t) for t in kept]
                columns["n_chars"] = pa.array(sizes, pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names).filter(pa.array(some))

    joined = flagged.where("_touched").join(per_doc, ["doc_id", mark], "left").select(*names, "_gone")
    return whole.unionByName(joined.mapInArrow(strip, whole.schema))
