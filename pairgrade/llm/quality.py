"""Quality classifier: a linear support vector machine on naive Bayes features.

A text's features are indicators of its byte n-grams, hashed into a fixed
number of buckets.  Each indicator is scaled by its class log-count ratio, and
dual coordinate descent fits a linear model under hinge loss to the scaled
indicators of a bounded sample of labelled rows.  A logistic curve, fitted to
margins of rows left out of a fit, turns margins into scores.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairgrade.llm.common import Words, id_text, mix, slices, text_buffers

BUCKET_BITS = 18
GRAMS = (2, 3, 4)
REPEATS = 8
MAX_TRAIN = 6000


def features(raw: np.ndarray, grams: Sequence[int] = GRAMS, bits: int = BUCKET_BITS) -> np.ndarray:
    """The buckets of a text's byte n-grams, each once, ascending, and of the
    lengths (2, 3, ... REPEATS) up to which some word repeats at once: the
    n-grams of one word, whichever it is."""
    found = [_repeats(raw)]
    for n in grams:
        m = len(raw) - n + 1
        if m > 0:
            x = np.full(m, n, np.uint64)
            for j in range(n):
                x = (x << np.uint64(8)) | raw[j:j + m]
            found.append(x)
    hit = np.zeros(1 << bits, bool)
    hit[(mix(np.concatenate(found)) >> np.uint64(64 - bits)).astype(np.int64)] = True
    return np.flatnonzero(hit).astype(np.int32)


def _repeats(raw: np.ndarray) -> np.ndarray:
    h = Words(raw, np.array([0, len(raw)]), "visible").hashes()
    same = np.flatnonzero(np.diff(h, prepend=h[:1] + np.uint64(1)) != 0)  # where another word begins
    longest = int(np.diff(same, append=len(h)).max(initial=0))
    return np.arange(2, min(longest, REPEATS) + 1, dtype=np.uint64)


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, bits: int, alpha: float = 1.0) -> np.ndarray:
    """Per bucket the log of its share of class 1 over its share of class 0."""
    counts = np.full((2, 1 << bits), alpha)
    for row, y in zip(rows, labels):
        counts[int(y), row] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def dual_descent(rows: list[np.ndarray], signs: np.ndarray, scale: np.ndarray, cost: float,
                 epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model: one dual variable a row, moved
    to its best value within [0, cost] in turn.  Rows have length 1, and a
    constant feature carries the bias."""
    rng = np.random.default_rng(seed)
    norms = [np.sqrt((scale[r] ** 2).sum()) or 1.0 for r in rows]
    weights, bias = np.zeros(len(scale)), 0.0
    duals = np.zeros(len(rows))
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            row, y = rows[i], signs[i]
            x = scale[row] / norms[i]
            gradient = y * (weights[row] @ x + bias) - 1
            new = min(max(duals[i] - gradient / 2, 0.0), cost)  # the row's squared length is 1 + 1
            step = (new - duals[i]) * y
            if step:
                weights[row] += step * x
                bias += step
                moved = max(moved, abs(step))
                duals[i] = new
        if moved < 1e-4:
            break
    return weights, bias


def sigmoid_fit(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve for the margins (Newton steps on
    the log loss, targets drawn in from 0 and 1 by the class sizes)."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    at = np.array([1.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-6 * at)
        at = at - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(at[0], 1e-6)), float(at[1])


@dataclass
class Model:
    """``weights`` are for indicators (ratios multiplied in), ``ratios`` give a
    row's length."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    shift: float
    grams: tuple = GRAMS
    bits: int = BUCKET_BITS

    def margin(self, row: np.ndarray) -> float:
        length = np.sqrt(self.squares[row].sum()) or 1.0
        return float(self.weights[row].sum() / length + self.bias)

    def score(self, row: np.ndarray) -> float:
        z = self.slope * self.margin(row) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, epochs: int = 20, folds: int = 4,
        seed: int = 7, grams: tuple = GRAMS, bits: int = BUCKET_BITS) -> Model:
    """With one class only (or no rows) every score is that class's share."""
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        empty = np.zeros(1 << bits)
        return Model(empty, empty, 0.0, 1.0, float(np.log(share / (1 - share))), grams, bits)

    def one(picked: np.ndarray) -> Model:
        own = [rows[i] for i in picked]
        ratios = log_count_ratios(own, labels[picked], bits)
        weights, bias = dual_descent(own, np.where(labels[picked] == 1, 1.0, -1.0), ratios, cost, epochs, seed)
        return Model(weights * ratios, ratios ** 2, bias, 1.0, 0.0, grams, bits)

    everything = np.arange(len(rows))
    fold = np.empty(len(rows), int)  # each class over all folds
    for y in (0, 1):
        of = np.flatnonzero(labels == y)
        fold[of] = np.arange(len(of)) % folds
    margins = np.zeros(len(rows))
    for k in range(folds):
        if len(set(labels[fold != k].tolist())) == 2 and (fold == k).any():
            part = one(everything[fold != k])
            margins[fold == k] = [part.margin(rows[i]) for i in everything[fold == k]]
    model = one(everything)
    model.slope, model.shift = sigmoid_fit(margins, labels)
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text divisible by 5 (and
    rows without an id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train_sample(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN,
                 label_col: str = "quality", seed: int = 11) -> DataFrame:
    """(text, label) of about ``max_train`` labelled rows outside the held-out
    part, picked by a hash of the id; all of them if there are no more.  A row
    labelled more than once has its highest label."""
    own = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         F.col(f"`{label_col}`").cast("int").alias("label"))
           .where(F.col("label").isin(0, 1) & ~held_out())
           .groupBy("doc_id").agg(F.max("label").alias("label")))
    share = min(1.0, max_train / max(own.count(), 1))
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / F.lit(1 << 30)
    picked = own.where(place < share)
    return id_text(docs).join(F.broadcast(picked), "doc_id").select("text", "label")


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, cost: float = 1.0,
          epochs: int = 20, label_col: str = "quality") -> Model:
    """The model for ``labels`` (doc_id, 0 or 1).  Features are made where the
    texts are; the sample (bounded by ``max_train`` rows) is fitted in one
    task, and only the weights come to the driver."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            raw, at = text_buffers(part.column(0))
            rows = [features(raw[at[i]:at[i + 1]]).tobytes() for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), part.column(1)],
                                             names=["row", "label"])

    def fitted(group: pa.Table) -> pa.Table:
        rows = [np.frombuffer(r, np.int32) for r in group["row"].to_pylist()]
        labels = group["label"].to_numpy()
        order = sorted(range(len(rows)), key=lambda i: (rows[i].tobytes(), labels[i]))  # whatever order they came in
        m = fit([rows[i] for i in order], labels[order].astype(float), cost, epochs)
        return pa.table({"weights": pa.array([m.weights.tobytes()], pa.binary()),
                         "squares": pa.array([m.squares.tobytes()], pa.binary()),
                         "bias": [m.bias], "slope": [m.slope], "shift": [m.shift]})

    got = (train_sample(docs, labels, max_train, label_col)
           .mapInArrow(extract, "row binary, label int")
           .withColumn("all", F.lit(1)).groupBy("all").applyInArrow(
               fitted, "weights binary, squares binary, bias double, slope double, shift double")
           .collect())
    if not got:
        return fit([], np.zeros(0))
    m = got[0]
    return Model(np.frombuffer(m.weights), np.frombuffer(m.squares), m.bias, m.slope, m.shift)


def score_texts(docs: DataFrame, model: Model, threshold: float = 0.3,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row.

    Only the text counts.  A null text scores as an empty one; a null id stays
    null (and counts as held out); repeated rows give repeated rows; other
    columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            raw, at = text_buffers(part.column(1))
            scores = [sent.value.score(features(raw[at[i]:at[i + 1]])) for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())],
                                             names=["doc_id", "score"])

    return (id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, score double")
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``threshold`` or
    more; a map without a shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at_text = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            raw, at = text_buffers(part.column(at_text))
            yield part.filter(pa.array([sent.value.score(features(raw[at[i]:at[i + 1]])) >= threshold
                                        for i in range(part.num_rows)]))

    return docs.mapInArrow(run, docs.schema)
