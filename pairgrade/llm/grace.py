"""Exact dedup by Grace hash partitioning.

Records are written to spill tables in the shared folder.  A first pass, before
anything is shuffled, settles equal texts inside each partition; one record for
each text is left.  Then, in rounds, the records are dealt to buckets by bits of
their hash.  A bucket that fits is settled by an open-addressing table that
compares whole texts.  A bucket that doesn't fit is written again for the next
round, which deals it by more bits; until then its records are dealt to pieces
that fit and equal texts of a piece are settled, so a bucket that is large as one
text stands in it very often (which no hash can split) shrinks as well.

Each round writes (rep, parent): the record that stands for another one.  Only
the first pass and the rounds touch texts; the ids of a group are numbers, joined
through the records that stand for them, so no group meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairgrade.llm.common import id_text, slices
from pairgrade.sources.sinks import materialize

#: Text bytes of a bucket that is settled at once, and of the first pass's table.
BUCKET_BYTES = 16 << 20
#: Rows that one record of the first pass stands for, at most.
LOCAL_ROWS = 100_000
#: Bits more of the hash that a round uses than the one before.
STEP_BITS = 4
MAX_BITS = 60
#: Rounds after which buckets are settled as they are: only texts that share all
#: bits of the hash and are longer than a bucket would still be left.
MAX_ROUNDS = 40
#: Buckets that do not fit, up to which their list (24 bytes each) is broadcast.
BROADCAST_BUCKETS = 1_000_000


class Table:
    """Open addressing with linear probing: hash and whole text -> number of
    the first record with that text."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.slots: list[int] = [-1] * 64
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.owners: list[int] = []
        self.size = 0

    def _free(self, h: int) -> int:
        mask = len(self.slots) - 1
        at = h & mask
        while self.slots[at] >= 0:
            at = (at + 1) & mask
        return at

    def put(self, h: int, text: bytes, owner: int) -> int:
        """The owner of the text; ``owner`` itself if it is new."""
        mask = len(self.slots) - 1
        at = h & mask
        while (found := self.slots[at]) >= 0:
            if self.hashes[found] == h and self.texts[found] == text:
                return self.owners[found]
            at = (at + 1) & mask
        self.slots[at] = len(self.texts)
        self.hashes.append(h)
        self.texts.append(text)
        self.owners.append(owner)
        self.size += len(text)
        if 2 * len(self.texts) > len(self.slots):
            self.slots = [-1] * (4 * len(self.slots))
            for n, old in enumerate(self.hashes):
                self.slots[self._free(old)] = n
        return owner


def _texts(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _settle_locally(own: DataFrame, bucket_bytes: int) -> DataFrame:
    """(doc_id, tag, rep, h, bytes, text): a number for each row, and that of
    the row that stands for it; only the latter keeps its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, tag, rows = Table(), TaskContext.get().partitionId() << 33, 0
        for part in slices(batches):
            texts = part.column(1).cast(pa.binary()).to_pylist()
            reps, tags, own = [], range(tag, tag + part.num_rows), []
            for t, h, text in zip(tags, part.column(2).to_pylist(), texts):
                if table.size > bucket_bytes or rows >= LOCAL_ROWS:
                    table.clear()
                    rows = 0
                reps.append(table.put(h, text, t))
                own.append(text if reps[-1] == t else None)
                rows += 1
            tag += part.num_rows
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(tags, pa.int64()), pa.array(reps, pa.int64()), part.column(2),
                 part.column(3), _texts(own)], names=["doc_id", "tag", "rep", "h", "bytes", "text"])

    return own.mapInArrow(run, "doc_id bigint, tag bigint, rep bigint, h bigint, bytes bigint, text string")


def _bucket(bits: int):
    return F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("bigint")


def _settle(records: DataFrame, bits: int, turn: int, bucket_bytes: int) -> DataFrame:
    """(rep, parent, h, bytes, text) of one round; a record whose bucket did
    not fit keeps its text, if it stands for itself."""
    own = records.withColumn("bucket", _bucket(bits))
    total = records.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first().n
    # three records a piece and more, so that pieces of equal texts shrink
    pieces = F.least(F.ceil(F.col("all") / bucket_bytes), F.greatest(F.expr("n div 3"), F.lit(1)))
    large = materialize(own.groupBy("bucket").agg(F.sum("bytes").alias("all"), F.count("*").alias("n"))
                        .withColumn("pieces", pieces.cast("bigint")).where(F.col("pieces") > 1)
                        .where(F.lit(turn < MAX_ROUNDS)).select("bucket", "pieces"), "grace-large")
    small = large.count() <= BROADCAST_BUCKETS
    parts = max(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (4 * bucket_bytes)))
    laid = (own.join(F.broadcast(large) if small else large, "bucket", "left")
            .withColumn("piece", F.coalesce(F.pmod(F.xxhash64("rep", F.lit(turn)), F.col("pieces")), F.lit(-1)))
            .repartition(parts, "bucket", "piece").sortWithinPartitions("bucket", "piece")
            .select("bucket", "piece", "rep", "h", "bytes", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, unit = Table(), None
        for part in slices(batches):
            parents, kept = [], []
            columns = [part.column(n).to_pylist() for n in range(4)]
            for bucket, piece, rep, h, text in zip(*columns, part.column(5).cast(pa.binary()).to_pylist()):
                if unit != (bucket, piece):
                    table.clear()
                    unit = bucket, piece
                parents.append(table.put(h, text, rep))
                kept.append(text if piece >= 0 and parents[-1] == rep else None)
            yield pa.RecordBatch.from_arrays(
                [part.column(2), pa.array(parents, pa.int64()), part.column(3), part.column(4), _texts(kept)],
                names=["rep", "parent", "h", "bytes", "text"])

    return materialize(laid.mapInArrow(run, "rep bigint, parent bigint, h bigint, bytes bigint, text string"),
                       "grace-round")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row.

    Texts are equal if their bytes are; null is an empty text.  Of equal texts
    the row with the largest id stays (of rows that repeat that id, one); a row
    without an id comes last, and stays only if no row of its group has one
    (``keep_id`` null).  An empty table gives no rows; other columns are
    ignored.  A text is never divided: a task needs memory for a bucket, or for
    five texts if those are longer.
    """
    text = F.coalesce("text", F.lit(""))
    own = id_text(docs, id_col, text_col).select("doc_id", text.alias("text"))
    own = own.withColumn("h", F.xxhash64("text")).withColumn("bytes", F.octet_length("text").cast("bigint"))
    rows = materialize(_settle_locally(own, bucket_bytes)
                       .withColumn("sha", F.when(F.col("tag") == F.col("rep"), F.sha2("text", 256))), "grace-rows")
    heads = rows.where("tag = rep")

    roots = rows.groupBy("rep").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "tag")).alias("keep"),
                                    F.max("sha").alias("sha")).withColumn("root", F.col("rep"))
    left = heads.select("rep", "h", "bytes", "text")
    total = left.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first().n
    bits, turn = min((4 * total // bucket_bytes).bit_length(), MAX_BITS), 0
    while True:
        settled = _settle(left, bits, turn, bucket_bytes)
        step = settled.where("rep != parent").select(F.col("rep").alias("root"), "parent")
        roots = roots.join(step, "root", "left").withColumn("root", F.coalesce("parent", "root")).drop("parent")
        left = settled.where("text is not null").select("rep", "h", "bytes", "text")
        if left.isEmpty():
            break
        bits, turn = min(bits + STEP_BITS, MAX_BITS), turn + 1

    roots = materialize(roots, "grace-roots")
    groups = roots.groupBy("root").agg(F.sum("n").alias("group_size"), F.max("keep").alias("keep"))
    of_rep = roots.select("rep", "root", "sha").join(groups, "root").select("rep", "group_size", "keep", "sha")
    return rows.select("doc_id", "tag", "rep").join(of_rep, "rep").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("keep.tag") == F.col("tag")).alias("kept"),
        F.col("sha").alias("text_sha256"))
