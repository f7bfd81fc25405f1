"""Models with few ids on one side: the many factors stay in their parts, and
the rows of few distinct pairs are scored without a shuffle or a copy."""

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from pairgrade.operators import cells, wals
from pairgrade.plans import sweep
from pairgrade.plans.sweep import pair_sweep
from pairgrade.sources.sinks import Scratch


@pytest.fixture(scope="module")
def pairs(spark):
    """Model 0 has 4 items, model 1 has 4 users, model 2 few of both."""
    rng = random.Random(3)
    rows = [(0, u, i, rng.randrange(1, 4), rng.uniform(1, 9)) for u in range(300) for i in rng.sample(range(4), 2)]
    rows += [(1, i, u, c, s) for _, u, i, c, s in rows]
    rows += [(2, u, i, 2, rng.uniform(1, 9)) for u in range(6) for i in range(5)]
    return spark.createDataFrame(rows, "model int, u int, i int, c long, s double").persist()


def fitted(spark, pairs, **params):
    with Scratch(spark) as scratch:
        sides = wals.fit_models(pairs, rank=6, scratch=scratch, keep=scratch.write, **params)
        return [{(r.model, r.id): np.array(r.features) for r in side.collect()} for side in sides]


@pytest.mark.parametrize("max_iter, every", [(1, 10), (2, 1), (5, 2)])
def test_sums_in_the_parts_give_the_factors_that_sending_gives(spark, pairs, monkeypatch, max_iter, every):
    monkeypatch.setattr(wals, "LOCAL_PAIRS", 250)
    sizes = wals.model_sizes(pairs)
    assert [sizes[m].local_parts(6) > 0 for m in range(3)] == [True, True, False]
    local = fitted(spark, pairs, max_iter=max_iter, checkpoint_interval=every)
    other = fitted(spark, pairs.repartition(7), max_iter=max_iter, checkpoint_interval=every)
    monkeypatch.setattr(wals, "LOCAL_CELLS", 0)
    sent = fitted(spark, pairs, max_iter=max_iter, checkpoint_interval=every)
    for own, again, old in zip(local, other, sent):
        assert own.keys() == again.keys() == old.keys()
        for key in own:
            assert (own[key] == again[key]).all()
            assert own[key] == pytest.approx(old[key], abs=1e-3)


def test_only_factors_of_few_ids_are_sent(spark, pairs, monkeypatch):
    sent, send = [], wals._sent
    monkeypatch.setattr(wals, "_sent", lambda step: sent.append(step.count()) or send(step))
    fitted(spark, pairs.where("model < 2"), max_iter=3)
    assert sent and max(sent) <= 8


def test_rows_of_few_distinct_pairs_are_not_written(spark, monkeypatch):
    rng = random.Random(4)
    rows = spark.createDataFrame([(k, k % 5, rng.randrange(4), rng.randrange(3), k % 3 + 1.0) for k in range(900)],
                                 "k long, x int, y int, z int, r double")
    written, write = [], Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, name="table": written.append(name) or write(self, df, name))
    metrics = lambda: {(r.user, r.item): r for r in pair_sweep(
        rows, ["x", "y", "z"], "r", "k", bias="r", rank=4, max_iter=3).collect()}
    few = metrics()
    assert "sweep-scored" not in written
    monkeypatch.setattr("pairgrade.plans.sweep.BROADCAST_PAIRS", 30)  # some go by a shuffle
    monkeypatch.setattr("pairgrade.plans.sweep.BROADCAST_IDS", 20)
    many = metrics()
    assert "sweep-scored" in written
    assert few.keys() == many.keys() and len(few) == 6
    for pair, row in few.items():
        assert tuple(row[2:10]) == pytest.approx(tuple(many[pair][2:10]), rel=1e-9)


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, ids at the ends of the int range, null and NaN labels, null, NaN
    and constant bias."""
    rng, rows = random.Random(5), [(9999, 0, 3, 0, 1.0, float("nan"))]
    for k in range(1200):
        x, y = rng.choice([None, 0, 1, -7]), rng.choice([3, 2 ** 31 - 1, -2 ** 31, None])
        rows.append((k, x, y, rng.randrange(3), rng.choice([None, float("nan"), 1.0, 2.0, 2.5]),
                     rng.choice([None, 1.0, 4.0, 9.5]) if x != 1 else 4.0))
    return spark.createDataFrame(rows, "k long, x int, y int, z int, r double, b double")


@pytest.mark.parametrize("rows, dense", [(50, 1 << 22), (1 << 21, 0)])
def test_sums_by_cell_give_the_metrics_of_joined_rows(spark, odd, monkeypatch, rows, dense):
    monkeypatch.setattr(cells, "BLOCK_ROWS", rows)
    monkeypatch.setattr(cells, "METRIC_ROWS", rows)
    monkeypatch.setattr(cells, "DENSE_CELLS", dense)
    pairs = sweep.ordered_pairs(["x", "y", "z"])
    with Scratch(spark) as scratch:
        table = sweep.sweep_table(odd, ["x", "y", "z"], "r", "k", bias="b", write=scratch.write)
        fitted = sweep._fitted(table, pairs, True, scratch, rank=4, max_iter=2, seed=1)
        assert sorted(fitted.few) == [0, 1, 2] and not fitted.many
        bounds = fitted.scored.groupBy("model").agg(F.min("low"), F.max("high")).collect()
        few = sweep._few_metrics(table, fitted, {m: own for m, *own in bounds}, True, True, 0.5, 5.0).collect()
        many = sweep.stacked_metrics(sweep._scored_rows(table, fitted, [0, 1, 2], True), True, True, 0.5, 5.0).collect()
        counts = sweep._all_counts(table, pairs)
        monkeypatch.setattr(sweep, "PATTERN_COLUMNS", 0)
        assert counts == sweep._all_counts(table, pairs)
    assert len(few) == len(many) == 6
    for one, two in zip(sorted(few), sorted(many)):
        assert tuple(one) == pytest.approx(tuple(two), rel=1e-9, nan_ok=True)


@pytest.mark.parametrize("rows", [50, 1 << 21])
def test_cells_are_counted_as_by_grouping(spark, odd, monkeypatch, rows):
    monkeypatch.setattr(cells, "BLOCK_ROWS", rows)
    table = odd.withColumn("t", F.col("k") % 3 > 0).withColumnRenamed("b", "bias")
    sets = [("x", "y"), ("z", "x")]
    found = sorted(map(repr, cells.cell_sums(table, sets, "t", "r", "bias").collect()))
    rated = F.col("t") & F.col("r").isNotNull() & ~F.isnan("r")
    want = []
    for n, (a, b) in enumerate(sets):
        bias = F.when(~F.col("t"), F.col("bias"))
        want += (table.where(f"{a} is not null and {b} is not null")
                 .groupBy(F.lit(n).alias("set"), F.col(a).alias("a"), F.col(b).alias("b"))
                 .agg(F.count_if(rated).alias("c"), F.sum(F.when(rated, F.col("r")).otherwise(0.0)).alias("s"),
                      F.count_if(~F.col("t")).alias("t"), F.min(bias).alias("low"), F.max(bias).alias("high"))
                 .where("c + t > 0").collect())
    assert found == sorted(map(repr, want))


def test_a_side_without_rows_and_unseen_ids(spark):
    """No training rows in a block, a column of nulls, and test rows of which no id was seen."""
    rows = spark.createDataFrame([(k, 1000 + k, k, None) for k in range(60)], "k int, x int, y int, z int")
    held = cells.cell_sums(rows.withColumn("t", F.lit(False)), [("x", "y"), ("x", "z")], "t", "k").collect()
    assert len(held) == 60 and {(r.set, r.c, r.s, r.t) for r in held} == {(0, 0, 0.0, 1)}
    found = pair_sweep(rows, ["x", "y", "z"], "k", "k", bias="k", rank=2, max_iter=1).collect()
    assert {(r.user, r.item): r.n for r in found if r.error is None} == {("x", "y"): 0, ("y", "x"): 0}
