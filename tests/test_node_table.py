"""The node table of a forest is a model: scored by joins, fitted in batches."""

import pytest
from pyspark.sql import functions as F

from pairgrade.operators import assemble, fit_forest, forest_nodes, score_forest
from pairgrade.operators.forest import NodeForest, score_nodes, tree_depth


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(900).select(
        F.col("id").alias("k"), (F.col("id") % 3).cast("double").alias("label"),
        *[(F.pmod(F.xxhash64("id", F.lit(n)), F.lit(50)) + (F.col("id") % 3) * n).cast("double").alias(f"f{n}")
          for n in range(4)])
    return assemble(df, [f"f{n}" for n in range(4)]).cache()


def predictions(df):
    return sorted((r.k, r.prediction) for r in df.select("k", "prediction").collect())


@pytest.mark.parametrize("kind", ["class", "reg"])
def test_table_predicts_as_the_model(spark, table, kind):
    model = fit_forest(table, kind, num_classes=5, key=["k"], num_trees=6, max_depth=5)
    nodes = forest_nodes(model, spark)
    assert tree_depth(nodes) == max(t.depth for t in model.trees)
    assert predictions(score_nodes(nodes, table, kind)) == predictions(score_forest(model, table))


def test_constant_label_and_empty_frame(spark, table):
    model = fit_forest(table.withColumn("label", F.lit(2.0)), "class", num_classes=3, key=["k"], num_trees=2)
    nodes = forest_nodes(model, spark)
    assert tree_depth(nodes) == 0
    assert {p for _, p in predictions(score_nodes(nodes, table, "class"))} == {2.0}
    assert score_nodes(nodes, table.limit(0), "class").count() == 0


@pytest.mark.parametrize("kind", ["class", "reg"])
def test_batches_unite(spark, table, kind):
    """Trees and votes are those of the batches' own models."""
    params = dict(key=["k"], max_depth=5, num_classes=3)
    forest = fit_forest(table, kind, num_trees=7, tree_batch=3, seed=11, **params)
    assert isinstance(forest, NodeForest)
    counts = forest.nodes.groupBy("tree_id").count().orderBy("tree_id").collect()
    assert [r.tree_id for r in counts] == list(range(7))
    parts = [fit_forest(table, kind, num_trees=n, seed=11 + first, **params) for first, n in ((0, 3), (3, 3), (6, 1))]
    own = [sum(t.numNodes for t in p.trees) for p in parts]
    assert sum(r["count"] for r in counts) == sum(own)
    one, many = score_forest(forest, table), score_forest(fit_forest(table, kind, num_trees=7, seed=11, **params), table)
    error = [df.agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0] for df in (one, many)]
    assert abs(error[0] - error[1]) < 0.1
    if kind == "reg":
        each = [predictions(score_forest(p, table)) for p in parts]
        mean = [(a[0], (3 * a[1] + 3 * b[1] + c[1]) / 7) for a, b, c in zip(*each)]
        assert predictions(one) == [(k, pytest.approx(v, rel=1e-12)) for k, v in mean]
