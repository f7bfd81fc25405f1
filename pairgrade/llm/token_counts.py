"""Token counts: how many tokens a public tokenizer makes of each text.

Only lengths leave Python.  A text is cut at spaces and line feeds, which the
tokenizer's own splitter drops and its normaliser never joins across, so the
counts of the parts add up to the count of the whole.  The parts repeat a lot:
each worker keeps the counts of those it has met and encodes only new ones, in
batches balanced by bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairgrade.llm.common import id_text, kept, slices, text_buffers, texts_of

BATCH_BYTES = 256 << 10
PIECE_CHARS = 1 << 20
CACHE_WORDS = 1 << 20


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Pieces of about ``size`` characters, cut at a space or line feed only;
    a run without one stays whole."""
    lo = 0
    while len(text) - lo > size:
        cuts = [c for c in (text.find(" ", lo + size), text.find("\n", lo + size)) if c >= 0]
        if not cuts:
            break
        yield text[lo:min(cuts)]
        lo = min(cuts) + 1
    yield text[lo:]


class WordCounter:
    """Counts tokens with a bounded memory of words already encoded."""

    def __init__(self, tokenizer_json: bytes, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.seen: dict[str, int] = {}
        self.cache_words = cache_words

    def _learn(self, words: list[str]) -> None:
        """Encodes new words in batches of about ``BATCH_BYTES``."""
        if len(self.seen) > self.cache_words:
            self.seen.clear()
        ends = np.cumsum([len(w) + 1 for w in words])
        lo = 0
        while lo < len(words):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + BATCH_BYTES, "right")))
            part = words[lo:hi]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.seen[w] = len(e)
            lo = hi

    def counts(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        todo: list[tuple[int, list[str]]] = []
        held = 0
        for i, text in enumerate(texts):
            for piece in safe_pieces(text):
                todo.append((i, piece.replace("\n", " ").split(" ")))
                held += len(piece)
                if held >= PIECE_CHARS:
                    self._add(todo, out)
                    todo, held = [], 0
        self._add(todo, out)
        return out

    def _add(self, todo: list[tuple[int, list[str]]], out: list[int]) -> None:
        words = set().union(*(w for _, w in todo)) if todo else set()
        if len(self.seen) + len(words) > self.cache_words:
            self.seen.clear()
        new = words.difference(self.seen)
        if new:
            self._learn(list(new))
        get = self.seen.__getitem__
        for i, ws in todo:
            out[i] += sum(map(get, ws))


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int = 2048,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per input row.

    ``tokenizer_file``: a ``tokenizers`` JSON; it is read once on the driver
    and sent to the executors (a vocabulary: a few MB whatever the corpus).
    Special strings inside a text count as the library's default counts them;
    no special tokens are added, nothing is truncated or padded.  A null text
    counts as empty (0 bytes, 0 tokens); a null id stays null; repeated rows
    give repeated rows; other columns are ignored.
    """
    with open(tokenizer_file, "rb") as f:
        vocabulary = f.read()
    blob = docs.sparkSession.sparkContext.broadcast(vocabulary)
    name = f"counter {hashlib.sha256(vocabulary).hexdigest()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # words met in one task serve the worker's next
        counter = kept(name, lambda: WordCounter(blob.value))
        for part in slices(batches, keep=name):
            _, at = text_buffers(part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(at), pa.int64()),
                 pa.array(counter.counts(texts_of(part)), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    counted = id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
