"""Substring dedup: word windows of earlier documents, with a count-min prefilter.

Every partition counts the hashes of its windows in a count-min sketch (cells
that saturate at two).  The sketches are merged cell by cell; a window's count
is at most the least of its cells, so a window that repeats anywhere is
estimated as repeated, and only such windows go to the second pass, which
groups them exactly by a 96-bit hash.  A partition first settles what its own
rows settle: of a window's documents only the smallest goes on, the others are
covered already.  So a window that a third of all documents hold reaches the
exact grouping once for each partition, not once for each document.

Before both passes documents with equal texts are found by their hashes.  All
windows of a copy start in the one with the smallest id as well, so a copy loses
every word (if it has a window at all) and no window of it needs to be counted,
grouped or shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairgrade.llm.bitmap import flag_in
from pairgrade.llm.common import Words, gram_hashes, id_text, mix, slices, text_buffers, text_hash
from pairgrade.llm.countmin import (
    DEPTH, cell_bits, estimated_repeated, pack_gaps, repeated_cells, unpack_gaps,
)
from pairgrade.sources.sinks import materialize

SPAN = 13
FLUSH_WINDOWS = 3_000_000
BUCKET_WINDOWS = 2_000_000
#: Words whose least hash within a window decides its bucket.
LOCAL_WORDS = 6


def windows_of(part: pa.RecordBatch, span: int, column: int) -> tuple[Words, np.ndarray, np.ndarray]:
    """(words, places where a window begins, its hash)."""
    raw, at = text_buffers(part.column(column))
    words = Words(raw, at, "visible")
    places = np.flatnonzero(words.gram_ok(span))
    return words, places, gram_hashes(words.hashes(1), span)[places]


def bucket_of(words: np.ndarray, places: np.ndarray, span: int, buckets: int) -> np.ndarray:
    """The bucket of the windows at ``places``, by the least hash of the runs of
    ``LOCAL_WORDS`` words in them: equal windows share it, and so do most that
    follow one another, whose document is then told once."""
    k = min(LOCAL_WORDS, span)
    runs = gram_hashes(words, k)
    least = runs[places]
    for j in range(1, span - k + 1):
        np.minimum(least, runs[places + j], out=least)
    return (mix(least) % np.uint64(buckets)).astype(np.int32)


# ---------------------------------------------------------------------------
# Second pass: exact groups
# ---------------------------------------------------------------------------
@dataclass
class Held:
    """Windows waiting to be grouped: two hashes, document, mark, place, bucket."""

    columns: list[list[np.ndarray]] = field(default_factory=lambda: [[] for _ in range(6)])
    n: int = 0

    def add(self, *columns: np.ndarray) -> None:
        for to, column in zip(self.columns, columns):
            to.append(column)
        self.n += len(columns[0])

    def settle(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(windows in the smallest of their documents, (document, mark, place)
        of those in a larger one), both by document and place."""
        h1, h2, doc, mark, at, bucket = (np.concatenate(c) for c in self.columns)
        self.__init__()
        order = np.lexsort((doc, h2, h1))
        h1, h2, doc, mark, at, bucket = (x[order] for x in (h1, h2, doc, mark, at, bucket))
        first = np.empty(len(h1), bool)
        first[:1] = True
        first[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        least = doc[np.flatnonzero(first)][np.cumsum(first) - 1] if len(doc) else doc
        out = []
        for picked, some in ((doc == least, (h1, h2, bucket, doc, mark, at)), (doc != least, (doc, mark, at))):
            some = [x[picked] for x in some]
            by = np.lexsort((some[-1], some[-2], some[-3]))
            out.append([x[by] for x in some])
        return out[0], out[1]


def _pack(doc: np.ndarray, mark: np.ndarray, at: np.ndarray) -> bytes:
    """Places by document, as compressed steps."""
    import zstandard

    steps = np.concatenate([np.diff(x, prepend=0) for x in (doc, mark, at)]).astype(np.int64)
    return zstandard.ZstdCompressor(level=1).compress(steps.tobytes())


def _unpack(blob: bytes) -> list[np.ndarray]:
    import zstandard

    steps = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.int64)
    return [np.cumsum(x) for x in steps.reshape(3, -1)]


def _dealt(by: np.ndarray, groups: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each group's rows, in their order."""
    order = np.argsort(by, kind="stable")
    edges = np.searchsorted(by[order], np.arange(groups + 1))
    for g in np.flatnonzero(np.diff(edges)).tolist():
        yield g, order[edges[g]:edges[g + 1]]


def _by_document(doc: np.ndarray, mark: np.ndarray, groups: int) -> np.ndarray:
    return (mix(doc.view(np.uint64) ^ mix(mark.view(np.uint64))) % np.uint64(groups)).astype(np.int64)


def _rows(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def covered_windows(own: DataFrame, sketch: np.ndarray, span: int, bits: int, buckets: int) -> DataFrame:
    """(doc_id, mark, gone), written: for each document the places of its windows whose
    words also start in a document with a smaller id.

    Rows between the passes are packed: windows by a bucket (``bucket_of``), then
    covered places by a group of documents, so their number follows the number
    of partitions and not that of documents."""
    sent = own.sparkSession.sparkContext.broadcast(sketch)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = Held(), 0

        def flush():
            rivals, gone = held.settle()
            rows = []
            for b, some in _dealt(_by_document(*gone[:2], buckets), buckets):
                rows.append((b, _pack(*(x[some] for x in gone)), None, None, None))
            for b, some in _dealt(rivals[2], buckets):
                h1, h2, _, *place = (x[some] for x in rivals)
                rows.append((b, None, h1.tobytes(), h2.tobytes(), _pack(*place)))
            return _rows(rows, ["bucket", "gone", "h1", "h2", "places"],
                         [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()])

        for part in slices(batches, "text"):
            words, places, h1 = windows_of(part, span, 1)
            n += len(places)
            ids = part.column(0)
            known = np.asarray(ids.is_valid())
            doc, mark = ids.fill_null(0).to_numpy(), part.column(2).to_numpy()
            owner = words.text_of()[places]
            some = estimated_repeated(sent.value, h1, bits) & known[owner]
            places, owner = places[some], owner[some]
            other = words.hashes(2)
            h2 = gram_hashes(other, span)[places] >> np.uint64(32)
            held.add(h1[some], h2.astype(np.uint32), doc[owner], mark[owner], places - words.first[owner],
                     bucket_of(other, places, span, buckets))
            if n >= FLUSH_WINDOWS:
                if held.n:
                    yield flush()
                held, n = Held(), 0
        if held.n:
            yield flush()

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = Held(), None
        gone: list[list[np.ndarray]] = []

        def told():
            doc, mark, at = (np.concatenate(c) for c in zip(*gone))
            gone.clear()
            by = _by_document(doc, mark, buckets)
            order = np.lexsort((at, mark, doc))
            doc, mark, at, by = doc[order], mark[order], at[order], by[order]
            return _rows([(g, _pack(doc[some], mark[some], at[some])) for g, some in _dealt(by, buckets)],
                         ["bucket", "gone"], [pa.int32(), pa.binary()])

        for batch in batches:
            for b, done, h1, h2, places in zip(*(c.to_pylist() for c in batch.columns)):
                if b != bucket:
                    if held.n:
                        gone.append(held.settle()[1])
                    bucket = b
                    if sum(len(c[0]) for c in gone) >= FLUSH_WINDOWS:
                        yield told()
                if done is not None:
                    gone.append(_unpack(done))
                else:
                    held.add(np.frombuffer(h1, np.uint64), np.frombuffer(h2, np.uint32), *_unpack(places),
                             np.zeros(len(h2) // 4, np.int32))
        if held.n:
            gone.append(held.settle()[1])
        if gone:
            yield told()

    def per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []

        def told():
            doc, mark, at = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((at, mark, doc))
            doc, mark, at = doc[order], mark[order], at[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])
            edges = [*np.flatnonzero(new).tolist(), len(doc)]
            return _rows([(int(doc[lo]), int(mark[lo]), pack_gaps(np.unique(at[lo:hi])))
                          for lo, hi in zip(edges, edges[1:])], ["doc_id", "mark", "gone"],
                         [pa.int64(), pa.int64(), pa.binary()])

        for batch in batches:
            for g, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if g != group and held:
                    yield told()
                    held = []
                group = g
                held.append(_unpack(blob))
        if held:
            yield told()

    covered = materialize(
        own.select("doc_id", "text", "mark")
        .mapInArrow(candidates, "bucket int, gone binary, h1 binary, h2 binary, places binary")
        .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(resolve, "bucket int, gone binary")
        .repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(per_document, "doc_id bigint, mark bigint, gone binary"), "covered-windows")
    sent.unpersist()
    return covered


def split_copies(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that are no copies, copies), both (doc_id, text, mark): a copy's
    text also stands under a smaller id.

    Texts are told apart by two 64-bit hashes and their length.  Only rows that
    may be copies are shuffled, and written."""
    keys = own.where("doc_id is not null").select(
        "doc_id", "mark", F.xxhash64(F.lit(1), F.coalesce("text", F.lit(""))).alias("m2"),
        F.octet_length(F.coalesce("text", F.lit(""))).alias("bytes"))
    least = (keys.groupBy("mark", "m2", "bytes").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
             .where("least < most").drop("most"))
    row = F.xxhash64("doc_id", "mark")
    copies = materialize(keys.join(least, ["mark", "m2", "bytes"]).where("doc_id > least").select("doc_id", "mark")
                         .distinct(), "copies")
    flagged = flag_in(own.withColumn("row", row), "row", copies.select(row.alias("mark")), "maybe").drop("row")
    maybe = materialize(flagged.where("maybe").drop("maybe").join(
        copies.withColumn("copy", F.lit(True)), ["doc_id", "mark"], "left"), "maybe-copies")
    columns = ["doc_id", "text", "mark"]
    rest = flagged.where("not maybe").select(*columns).unionByName(maybe.where("copy is null").select(*columns))
    return rest, maybe.where("copy").select(*columns)


def dedup_substrings(docs: DataFrame, span: int = SPAN, depth: int = DEPTH, id_col: str = "doc_id",
                     text_col: str = "text", sketch_bits: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, kept_sha256), one row per input row;
    ``kept`` is the words left, joined by one space.

    Words are runs of anything but ASCII white space.  A word goes if a window
    of ``span`` words over it also starts in a document with a smaller id;
    windows are those of the input.  A null text has no words.  A row without
    an id is kept whole and covers nothing.  Rows that share an id do not cover
    each other; rows that repeat give equal rows; other columns are ignored.  An
    empty table gives no rows; a text is never divided, so a task needs memory
    in proportion to its longest one.
    """
    own, copies = split_copies(id_text(docs, id_col, text_col).withColumn("mark", text_hash()))
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first().bytes
    windows = size // 6 + 1
    bits = sketch_bits or cell_bits(windows)
    sketch = repeated_cells(own.select("text"), lambda part: windows_of(part, span, 0)[2], depth, bits)
    gone = covered_windows(own, sketch, span, bits, windows // BUCKET_WINDOWS + 1)
    touched = flag_in(own, "mark", gone, "touched")

    def strip(batches: Iterator[pa.RecordBatch], whole: bool = False) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            raw, at = text_buffers(part.column(1))
            words = Words(raw, at, "visible")
            counts, removed, kept, shas = words.counts(), [], [], []
            for i, packed in enumerate(part.column(2).to_pylist()):
                n, lo = int(counts[i]), int(words.first[i])
                edge = np.zeros(n + 1, np.int64)
                if packed is not None:
                    starts = unpack_gaps(packed)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + span, -1)
                left = np.flatnonzero(np.cumsum(edge)[:n] == 0) + lo
                if whole and n >= span:
                    left = left[:0]
                text = b" ".join([words.raw[s:e].tobytes()
                                  for s, e in zip(words.start[left].tolist(), words.end[left].tolist())])
                removed.append(n - len(left))
                kept.append(text)
                shas.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string()), pa.array(shas)],
                names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    # only texts that may lose words are shuffled
    joined = touched.where("touched").join(gone, ["doc_id", "mark"], "left").select("doc_id", "text", "gone")
    whole = touched.where("not touched").select("doc_id", "text", F.lit(None).cast("binary").alias("gone"))
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string"
    copies = copies.select("doc_id", "text", F.lit(None).cast("binary").alias("gone"))
    return (joined.mapInArrow(strip, schema).unionByName(whole.mapInArrow(strip, schema))
            .unionByName(copies.mapInArrow(lambda batches: strip(batches, True), schema)))
