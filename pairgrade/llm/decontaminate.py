"""Benchmark decontamination by winnowing.

From every six consecutive 5-grams of words the one with the least hash is
kept.  Two texts that share ten words or more share those six 5-grams
somewhere, so both keep the same one there: every shared span of ten words has
a fingerprint in common.  Fingerprints of documents and benchmark items are
joined, and each hit is extended to both sides, word by word, as far as the
five words that a ten-word span around it could reach; the words of hits that
reach ten words are exactly the words of shared ten-word spans.  An item of
fewer words has one fingerprint, the whole of it, looked up at every place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairgrade.llm.bitmap import build_bitmap, in_bitmap
from pairgrade.llm.common import (
    Words, gram_hashes, id_text, lower_ascii, mix, slices, text_buffers, text_hash,
)

SPAN = 10
BROADCAST_BYTES = 32 << 20
SALTS = 16
_HIT = ("k int, hash bigint, gram string, before array<string>, after array<string>, at array<int>")


def _gram_size(span: int) -> int:
    return (span + 1) // 2


def winnowed(grams: np.ndarray, ok: np.ndarray, window: int) -> np.ndarray:
    """Places of the least hash (the last, of equal ones) of each ``window``
    hashes; ``ok`` says where a window begins that lies in one text."""
    m = len(grams) - window + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    best, place = grams[:m].copy(), np.arange(m)
    for j in range(1, window):
        other = grams[j:j + m]
        less = other <= best
        best[less] = other[less]
        place[less] = np.flatnonzero(less) + j
    return np.unique(place[ok[:m]])


class _Reader:
    """Fingerprints of the texts of a slice."""

    def __init__(self, part: pa.RecordBatch, span: int):
        raw, at = text_buffers(part.column(part.schema.get_field_index("text")))
        self.words = Words(lower_ascii(raw), at, "alnum")
        self.h = self.words.hashes()
        self.owner = self.words.text_of()
        self.span, self.k = span, _gram_size(span)

    def long(self) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) kept by winnowing."""
        grams = gram_hashes(self.h, self.k)
        places = winnowed(grams, self.words.gram_ok(self.span), self.span - self.k + 1)
        return places, self.tagged(grams[places], self.k)

    def short(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of all runs of ``k`` words."""
        places = np.flatnonzero(self.words.gram_ok(k))
        return places, self.tagged(gram_hashes(self.h, k)[places], -k)

    @staticmethod
    def tagged(grams: np.ndarray, k: int) -> np.ndarray:
        return mix(grams + np.uint64(k & 0xFF))

    def strings(self, lo: int, hi: int) -> list[str]:
        return [self.words.word(i).decode() for i in range(lo, hi)]

    def hit(self, place: int, k: int, whole: bool) -> tuple[str, list[str], list[str]]:
        """(the gram's words, the words before it, nearest first, and after it)
        as far as a span around it reaches."""
        t = self.owner[place]
        lo, hi = self.words.first[t], self.words.first[t + 1]
        reach = 0 if whole else self.span - k
        return (" ".join(self.strings(place, place + k)),
                self.strings(max(lo, place - reach), place)[::-1],
                self.strings(place + k, min(hi, place + k + reach)))


def item_fingerprints(items: DataFrame, span: int = SPAN, id_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """(item_id, k, hash, gram, before, after): the kept 5-grams of each item,
    or the whole of one below ``span`` words (k negative)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            ids = part.column(0).to_pylist()
            reader = _Reader(part, span)
            rows = []
            places, hashes = reader.long()
            for p, h in zip(places.tolist(), hashes.view(np.int64).tolist()):
                rows.append((ids[reader.owner[p]], reader.k, h, *reader.hit(p, reader.k, False)))
            counts = reader.words.counts()
            for t in np.flatnonzero((counts > 0) & (counts < span)).tolist():
                n, p = int(counts[t]), int(reader.words.first[t])
                h = int(reader.tagged(gram_hashes(reader.h[p:p + n], n)[:1], -n).view(np.int64)[0])
                rows.append((ids[t], -n, h, *reader.hit(p, n, True)))
            yield _batch(rows, ["item_id", "k", "hash", "gram", "before", "after"],
                         [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.string()),
                          pa.list_(pa.string())])

    named = items.select(F.col(f"`{id_col}`").cast("string").alias("item_id"),
                         F.col(f"`{text_col}`").cast("string").alias("text"))
    return named.where(F.col("item_id").isNotNull()).mapInArrow(
        run, "item_id string, k int, hash bigint, gram string, before array<string>, after array<string>")


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def document_hits(docs: DataFrame, bitmap: np.ndarray, short: list[int], span: int = SPAN) -> DataFrame:
    """For each document one row with its number of words (k = 0), and a row
    for each fingerprint that the items may hold."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            ids, marks = part.column(0).to_pylist(), part.column(2).to_pylist()
            reader = _Reader(part, span)
            counts = reader.words.counts().tolist()
            rows = [(i, m, n, 0, None, None, None, None, None) for i, m, n in zip(ids, marks, counts)]
            for k in [None, *short]:
                places, hashes = reader.long() if k is None else reader.short(k)
                seen = in_bitmap(sent.value, hashes)
                places, hashes = places[seen], hashes[seen].view(np.int64)
                if k is None:
                    for p, h in zip(places.tolist(), hashes.tolist()):
                        t = reader.owner[p]
                        rows.append((ids[t], marks[t], None, reader.k, h, *reader.hit(p, reader.k, False),
                                     [p - int(reader.words.first[t])]))
                else:  # the same words at many places of a text: one row
                    order = np.lexsort((places, hashes, reader.owner[places]))
                    places, hashes = places[order], hashes[order]
                    owner = reader.owner[places]
                    new = np.flatnonzero(np.diff(owner, prepend=-1).astype(bool)
                                         | (np.diff(hashes, prepend=hashes[:1]) != 0))
                    for lo, hi in zip(new.tolist(), [*new[1:].tolist(), len(places)]):
                        t, p = owner[lo], int(places[lo])
                        rows.append((ids[t], marks[t], None, -k, int(hashes[lo]), *reader.hit(p, k, True),
                                     (places[lo:hi] - reader.words.first[t]).tolist()))
            yield _batch(rows, ["doc_id", "mark", "n_words", "k", "hash", "gram", "before", "after", "at"],
                         [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(),
                          pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int32())])

    return docs.mapInArrow(run, "doc_id bigint, mark bigint, n_words bigint, " + _HIT)


def _shared(a: str, b: str) -> Column:
    """How many words two lists share from their beginning."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    differ = F.array_position(same, F.lit(False)).cast("int")
    return F.when(differ > 0, differ - 1).otherwise(F.size(same))


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                  bitmap_bits: int = 24) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, items_sha256, contaminated,
    mark), one row per input row; ``mark`` tells apart rows that share an id.

    Words are ASCII letters and digits, lower-cased, and all beyond ASCII.  A
    null text has no words and an empty one neither; a null id stays null; rows
    that repeat give equal rows; benchmark items without an id or without words
    play no part, items that repeat an id count once; other columns are
    ignored.

    The items' fingerprints are broadcast if they take ``BROADCAST_BYTES`` at
    most; beyond that both sides are shuffled, the documents' hits salted
    against fingerprints that very many documents hold.
    """
    prints = item_fingerprints(items, span, item_id_col, item_text_col)
    sizes = prints.agg(
        F.coalesce(F.sum(64 + F.length("gram") * 4 + F.length(F.array_join("before", " ")) * 4
                         + F.length(F.array_join("after", " ")) * 4), F.lit(0)).alias("bytes"),
        F.collect_set(F.when(F.col("k") < 0, -F.col("k"))).alias("short")).first()
    bitmap = build_bitmap(prints, "hash", bitmap_bits)
    own = id_text(docs, id_col, text_col).withColumn("mark", text_hash())
    hits = document_hits(own, bitmap, sorted(sizes.short), span)

    held = prints.select("item_id", "k", "hash", "gram", F.col("before").alias("item_before"),
                         F.col("after").alias("item_after"))
    keys = ["k", "hash", "gram"]
    if sizes.bytes <= BROADCAST_BYTES:
        held = F.broadcast(held)
    else:
        hits = hits.withColumn("salt", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(SALTS)).cast("int"))
        held = held.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        keys = [*keys, "salt"]
    met = (hits.join(held, keys, "left")
           .withColumn("left", _shared("before", "item_before"))
           .withColumn("right", _shared("after", "item_after"))
           .withColumn("full", F.col("item_id").isNotNull()
                       & ((F.col("k") < 0) | (F.col("left") + F.col("k") + F.col("right") >= span))))
    per = met.groupBy("doc_id", "mark").agg(
        F.sum((F.col("k") == 0).cast("int")).cast("int").alias("copies"),
        F.max("n_words").alias("n_words"),
        F.collect_set(F.when(F.col("full"), F.struct("at", "left", (F.abs("k") + F.col("right")).alias("right"))))
        .alias("hits"),
        F.collect_set(F.when(F.col("full"), F.col("item_id"))).alias("items"))
    words = F.array_distinct(F.flatten(F.flatten(F.transform(
        "hits", lambda x: F.transform(x["at"], lambda p: F.sequence(p - x["left"], p + x["right"] - 1))))))
    return (per.withColumn("n_hit", F.size(words).cast("bigint"))
            .withColumn("items", F.array_sort("items"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items",
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"), "mark"))
