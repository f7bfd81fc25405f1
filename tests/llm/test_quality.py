"""The classifier's parts, and its accuracy on rows it never saw."""

import zlib

import duckdb
import numpy as np
import pytest

from pairgrade.llm import quality
from pairgrade.llm.registry import op6_quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = op6_quality(spark, SF).collect()
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    seen = [(labels[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    good = [s for y, s, _ in seen if y == 1]
    bad = [s for y, s, _ in seen if y == 0]
    assert np.mean([y == p for y, _, p in seen]) > 0.95
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_odd_rows_and_missing_labels(spark, docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (77, 0)], "doc_id bigint, quality int")
    d = docs([(1, "some text"), (1, "some text"), (2, None), (3, ""), (None, "x" * 50000)])
    model = quality.train(d, labels)
    got = quality.score_texts(d, model).collect()
    assert len(got) == 5 and all(0 < r.score < 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [True]
    assert quality.score_texts(docs([]), model).count() == 0


def test_dual_descent_separates_and_keeps_the_box():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 40, 12) + 40 * (i % 2)).astype(np.int32) for i in range(80)]
    signs = np.array([1.0 if i % 2 else -1.0 for i in range(80)])
    weights, bias = quality.dual_descent(rows, signs, np.ones(80), 1.0, 50, 1)
    margins = [y * (weights[r].sum() / np.sqrt(len(r)) + bias) for r, y in zip(rows, signs)]
    assert min(margins) > 0.9
    slope, shift = quality.sigmoid_fit(np.array([-2.0, -1, 1, 2]), np.array([0.0, 0, 1, 1]))
    assert slope > 0 and shift == pytest.approx(0, abs=1e-3)


def test_repeated_words_are_features():
    f = lambda t: set(quality.features(np.frombuffer(t.encode(), np.uint8)).tolist())
    assert len(f("ab ab ab ab cd") - f("ab cd ab cd ab ab")) >= 2 and f("") == set()
