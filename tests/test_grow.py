"""Forests beyond MLlib's rows: the same trees, whatever is grown where."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pairgrade.operators import assemble, fit_forest, forest, forest_nodes, grow, score_forest
from pairgrade.operators.forest import NodeForest


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(4000).select(
        F.col("id").alias("k"), (F.col("id") % 3).cast("double").alias("label"),
        *[(F.pmod(F.xxhash64("id", F.lit(n)), F.lit(60 * n + 20)) + (F.col("id") % 3) * n).cast("double").alias(f"f{n}")
          for n in range(4)])
    return assemble(df, [f"f{n}" for n in range(4)]).cache()


def shape(nodes):
    """Nodes by their place: (feature, threshold, prediction, count)."""
    by = {(r.tree_id, r.node_id): r for r in nodes.collect()}
    out, open_ = {}, [(t, n, 0) for t, n in by if n == 0]
    while open_:
        tree, node, place = open_.pop()
        r = by[tree, node]
        out[tree, place] = (r.feature, r.threshold, pytest.approx(r.prediction), r["count"], pytest.approx(r.gain, abs=1e-9),
                            pytest.approx(r.impurity, abs=1e-9))
        if not r.is_leaf:
            open_ += [(tree, r.left_child, 2 * place + 1), (tree, r.right_child, 2 * place + 2)]
    assert len(out) == len(by)
    return out


def fit(table, kind, **params):
    return fit_forest(table, kind, num_classes=5 if kind == "class" else None, key=["k"], **params)


@pytest.mark.parametrize("kind", ["class", "reg"])
@pytest.mark.parametrize("local", [150, 1000, 10 ** 6])
def test_one_tree_is_mllibs(spark, table, kind, local, monkeypatch):
    model = fit(table, kind, num_trees=1, max_depth=7, bootstrap=False)
    monkeypatch.setattr(forest, "MLLIB_ROWS", 100)
    monkeypatch.setattr(grow, "LOCAL_ROWS", local)
    own = fit(table, kind, num_trees=1, max_depth=7, bootstrap=False)
    assert isinstance(own, NodeForest)
    assert shape(own.nodes) == shape(forest_nodes(model, spark))
    ours, mllibs = (sorted((r.k, pytest.approx(r.prediction)) for r in score_forest(m, table).collect()) for m in (own, model))
    assert [k for k, _ in ours] == list(range(4000)) and ours == mllibs


@pytest.mark.parametrize("kind", ["class", "reg"])
def test_forest_does_not_depend_on_where_it_grows(spark, table, kind, monkeypatch):
    monkeypatch.setattr(forest, "MLLIB_ROWS", 100)
    found = []
    for local in (400, 10 ** 6):
        monkeypatch.setattr(grow, "LOCAL_ROWS", local)
        found.append(fit(table.repartition(3 if local == 400 else 5), kind, num_trees=5, max_depth=6))
    assert shape(found[0].nodes) == shape(found[1].nodes)
    error = score_forest(found[0], table).agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]
    mllib = score_forest(fit(table, kind, num_trees=5, max_depth=6, max_memory_mb=256), table)
    assert abs(error - mllib.agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]) < 0.1


def test_constant_rows_and_bad_labels(spark, table, monkeypatch):
    monkeypatch.setattr(forest, "MLLIB_ROWS", 100)
    monkeypatch.setattr(grow, "LOCAL_ROWS", 50)
    same = assemble(table.select("k", "label", F.lit(1.0).alias("c")), ["c"])
    nodes = fit(same, "class", num_trees=2).nodes.collect()
    assert [(r.node_id, r.is_leaf) for r in nodes] == [(0, True)] * 2
    with pytest.raises(ValueError, match="whole numbers"):
        fit(table.withColumn("label", F.lit(9.0)), "class")


def test_without_a_key(spark, table, monkeypatch):
    """Equal rows, dealt in lots by their content."""
    monkeypatch.setattr(forest, "MLLIB_ROWS", 100)
    monkeypatch.setattr(grow, "LOCAL_ROWS", 500)
    rows = table.select("label", "features")
    rows = rows.unionByName(rows)
    found = [fit_forest(rows.repartition(n), "class", num_classes=3, num_trees=3, max_depth=4).nodes for n in (2, 5)]
    assert shape(found[0]) == shape(found[1])
    assert found[0].where("node_id = 0").count() == 3


@pytest.mark.parametrize("kind", ["class", "reg"])
@pytest.mark.parametrize("hot", [2, 10 ** 6])
def test_rows_added_up_by_cell_give_the_same_forest(spark, table, kind, hot, monkeypatch):
    """A cell that a third of the rows is in; few entries, whole sums."""
    coarse = assemble(table.select("k", (F.col("label") + 0.5 * (F.lit(kind) == "reg").cast("int")).alias("label"), *[
        F.when(F.col("k") % 3 == 0, 1.0).otherwise(F.floor(F.pmod(F.xxhash64("k", F.lit(n)), F.lit(5 + n))).cast("double"))
        .alias(f"c{n}") for n in range(3)]), ["c0", "c1", "c2"])
    monkeypatch.setattr(forest, "MLLIB_ROWS", 100)
    monkeypatch.setattr(grow, "LOCAL_ROWS", 300)
    monkeypatch.setattr(grow, "HOT_ROWS", hot)
    monkeypatch.setattr(grow, "MERGE_PART", 1000)
    monkeypatch.setattr(grow, "BLOCK_ROWS", 512)
    written, write = [], grow.Scratch.write
    monkeypatch.setattr(grow.Scratch, "write", lambda self, df, name="table": written.append(name) or write(self, df, name))
    merged = fit(coarse, kind, num_trees=4, max_depth=5)
    assert "forest-cells" in written and "forest-binned" not in written
    monkeypatch.setattr(grow, "MERGE_ROWS", 10 ** 9)
    rows = fit(coarse, kind, num_trees=4, max_depth=5)
    assert "forest-binned" in written
    assert shape(merged.nodes) == shape(rows.nodes)


def test_equal_rows_and_others_are_scored_alike(spark, table, monkeypatch):
    """One of many equal rows goes down the trees; NaN goes right."""
    monkeypatch.setattr(forest, "MLLIB_ROWS", 100)
    monkeypatch.setattr(forest, "WALK_ROWS", 7)
    model = fit(table, "class", num_trees=3, max_depth=5)
    odd = table.where("k < 5").select("k", "features")
    odd = odd.unionByName(spark.createDataFrame(
        [(100 + n, Vectors.dense([float("nan"), 1.0 * n, float("inf"), n])) for n in range(3)], ["k", "features"]))
    many = odd.crossJoin(spark.range(40).select("id"))
    one = {r.k: r.prediction for r in score_forest(model, odd).collect()}
    found = score_forest(model, many).collect()
    assert len(found) == 320 and {(r.k, r.prediction) for r in found} == set(one.items())
    nodes = {(r.tree_id, r.node_id): r for r in model.nodes.collect()}
    for row in odd.collect():
        votes = 0
        for tree in range(3):
            node = nodes[tree, 0]
            while not node.is_leaf:
                node = nodes[tree, node.left_child if row.features[node.feature] <= node.threshold else node.right_child]
            votes = votes + np.array(node.stats) / sum(node.stats)
        assert one[row.k] == np.argmax(votes)
