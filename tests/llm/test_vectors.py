import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairgrade.llm.rtree import Best, Tree, hard_negatives, packed_order
from pairgrade.llm.whitening import leading_components, polar_factor, whitened_embeddings

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, a int, block string, n int"


def table(spark, rows, partitions=4):
    return spark.createDataFrame([(i, v, y, "clash", 0, "b", 7) for i, v, y in rows], SCHEMA).repartition(partitions)


def random_rows(n, dim, seed, hot=0):
    rng = random.Random(seed)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(dim)], rng.randrange(3)) for i in range(n)]
    return rows + [(n + i, [0.5] * dim, 1) for i in range(hot)]


def usable(rows):
    fine = [r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    dim = max((len(r[1]) for r in fine), default=0)
    return [(i, [math.floor(256 * float(np.float32(c))) for c in v], y) for i, v, y in fine if len(v) == dim]


# ---------------------------------------------------------------------------
# Hard negatives
# ---------------------------------------------------------------------------
def plain_negatives(rows, every=100):
    rows = {(i, tuple(x), y) for i, x, y in usable(rows) if i is not None and y is not None}
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for i, x, y in rows:
        if i % every:
            continue
        scored = sorted((-dot(x, z), j, w) for j, z, w in rows)
        for score, j, w in [r for r in scored if r[2] == y and r[1] != i][:5]:
            p = -score
            hard = [r for r in scored if r[2] != y and 30 * p <= -100 * r[0] <= 90 * p][:10]
            out += [(i, j, n, r[1], p, -r[0]) for n, r in enumerate(hard, 1)]
    return sorted(out)


def mined(df, **params):
    return sorted(tuple(row) for row in hard_negatives(df, **params).collect())


@pytest.mark.parametrize("record_rows", [40, 4096])
def test_negatives_match_brute_force(spark, record_rows):
    rows = random_rows(500, 6, 1, hot=150)
    got = mined(table(spark, rows), every=50, record_rows=record_rows, block=5)
    assert got == plain_negatives(rows, 50) and got


def test_negatives_of_odd_tables(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (0, [0.5, 0.5], 1), (None, [1.0, 1.0], 1), (3, [1.0, 0.0], None),
            (4, None, 1), (5, [], 2), (6, [float("nan"), 1.0], 2), (7, [float("inf"), 1.0], 2), (8, [None, 1.0], 2),
            (9, [1.0], 2), (10, [0.9, 0.1], 1), (11, [0.9, 0.1], 1), (12, [0.5, -0.5], 2), (13, [0.5, -0.5], 2),
            (14, [0.0, 0.0], 2), (100, [-1.0, 0.0], 3), (200, [0.0, 0.0], 1), (201, [0.0, 0.0], 1)]
    got = mined(table(spark, rows))
    assert got == plain_negatives(rows) and got
    assert mined(table(spark, [])) == []
    assert mined(table(spark, [(0, [1.0], 1)])) == []


def test_negatives_of_huge_components(spark):
    rows = [(0, [3e5, 1.0], 1), (1, [3e5, 2.0], 1), (2, [1.5e5, 5.0], 2), (3, [1.5e5, 5.1], 2), (4, [2.0, 2.0], 2)]
    assert mined(table(spark, rows)) == plain_negatives(rows) and plain_negatives(rows)


def test_pruned_search_sees_less(spark):
    """Boxes outside of a window are not opened, and nothing is lost by it."""
    rng = np.random.default_rng(3)
    x = np.floor(256 * rng.normal(0, 1, (20_000, 3)))
    order = packed_order(x)
    assert sorted(order) == list(range(len(x)))
    tree, seen = Tree(np.arange(len(x)), np.zeros(len(x), int), x[order]), []

    class Counted(Best):
        def see(self, scores, ids, labels):
            seen.append(len(ids))
            super().see(scores, ids, labels)

    anchor = np.array([256.0, 10.0, -5.0])
    wanted = Counted(-1, 0, True, 5)
    tree.best_first(anchor, wanted)
    scores = x[order] @ anchor
    first = sorted(zip(-scores, range(len(x))))[:5]
    assert wanted.found[0] == [(int(s), i) for s, i in first]
    assert sum(seen) < len(x) / 10


# ---------------------------------------------------------------------------
# Whitening
# ---------------------------------------------------------------------------
def test_polar_factor():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(30, 30))
    a = a + a.T
    values, vectors = np.linalg.eigh(a)
    sign = vectors @ np.diag(np.sign(values)) @ vectors.T
    assert np.abs(polar_factor(a) - sign).max() < 1e-12


@pytest.mark.parametrize("values", [
    np.linspace(1, 50, 40), np.r_[1e-9, 1e-3, 1, 5, 1e4, 1e8], np.r_[np.zeros(5), 3, 7.0], np.ones(6),
    np.r_[2, 2, 2, 9, 9, 1.0], np.r_[-4, -1, 0, 2, 3.0], np.r_[1, 1 + 1e-6, 1 + 2e-6, 5], np.zeros(3), np.array([4.0])])
def test_components_match_eigh(values):
    rng = np.random.default_rng(len(values))
    q, _ = np.linalg.qr(rng.normal(size=(len(values),) * 2))
    a = q @ np.diag(values) @ q.T
    got, vectors = leading_components(a, 4)
    want = np.sort(values)[::-1][:4]
    size = max(np.abs(values).max(), 1e-300)
    assert np.abs(got - want).max() <= 1e-13 * size * len(values)
    assert np.abs(vectors @ vectors.T - np.eye(len(want))).max() < 1e-12
    assert np.abs(a @ vectors.T - vectors.T * got).max() <= 1e-13 * size * len(values)


def plain_whitening(rows):
    rows = usable(rows)
    fit = np.array(sorted({tuple(x) for _, x, _ in rows}), float)
    n, s = len(fit), [sum(c) for c in zip(*{tuple(x) for _, x, _ in rows})]
    cov = (fit - fit.mean(axis=0)).T @ (fit - fit.mean(axis=0)) / n
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:4]
    return rows, n, s, cov, values[order], vectors[:, order]


def test_whitening_matches_eigh(spark):
    rows = random_rows(300, 7, 4, hot=100) + [(900, None, 1), (901, [float("nan")] * 7, 1), (902, [1.0], 1),
                                              (None, [0.25] * 7, 2), (5, [-0.0] * 7, None), (5, [-0.0] * 7, None)]
    rows, n, s, cov, values, vectors = plain_whitening(rows)
    got = whitened_embeddings(table(spark, rows_as_floats(rows))).toPandas()
    assert len(got) == 4 * len(rows)
    assert set(got.n) == {n} and got.identity_error.max() < 1e-9
    want = {}
    for i, x, _ in rows:
        dev = sum((n * a - b) ** 2 for a, b in zip(x, s))
        want.setdefault(i, []).append((dev, (np.array(x) - np.array(s) / n) @ vectors / np.sqrt(values)))
    assert (got.groupby("vec_id", dropna=False).size() % 4 == 0).all()
    signs = {}
    for row in got[got.vec_id.notna()].itertuples():
        dev, w = min(want[int(row.vec_id)], key=lambda d: abs(d[0] - row.deviation))
        assert row.deviation == dev and abs(row.explained - values[row.component - 1] / np.trace(cov)) < 1e-12
        expected = w[row.component - 1]
        if abs(expected) > 1e-3:
            sign = signs.setdefault(row.component, np.sign(row.whitened * expected))
            assert abs(row.whitened - sign * expected) < 1e-8


def rows_as_floats(rows):
    return [(i, [c / 256 for c in x], y) for i, x, y in rows]


def test_whitening_of_few_vectors(spark):
    assert whitened_embeddings(table(spark, [])).count() == 0
    assert whitened_embeddings(table(spark, [(1, [0.5, 0.5], 1), (2, [0.5, 0.5], 2)])).count() == 0
    got = whitened_embeddings(table(spark, [(1, [0.5, 0.5], 1), (2, [0.25, 0.5], 2), (2, [0.25, 0.5], 2)])).toPandas()
    assert sorted(got.component) == [1, 1, 1] and set(got.n) == {2} and set(got.whitened.abs().round(9)) == {1.0}


def test_whitening_of_huge_entries(spark):
    got = whitened_embeddings(table(spark, [(1, [1e14, 0.5], 1), (2, [-1e14, 0.25], 2), (3, [0.0, 0.75], 2)]))
    rows = got.where("component = 1").collect()
    assert len(rows) == 3 and all(r.deviation is None for r in rows if r.vec_id != 3)
