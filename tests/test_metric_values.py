"""Metric values of the experiments, recomputed by DuckDB from written predictions."""

import pytest
from pyspark.sql import functions as F

from data_paths import SF_SMALL
from pairgrade.plans import forest_predictions, pair_predictions, pair_sweep
from pairgrade.plans.experiments import biased_scores, forest_metrics, pair_metrics
from pairgrade.plans.sweep import stacked_metrics, stacked_scores, sweep_table
from pairgrade.sources import tpch_items, write_metrics, write_predictions
from pairgrade.sources.sinks import Scratch

KEY = ["order_id", "line_no"]

# the formulas as published: rounded prediction against label, price bias
# scaled over the scored rows, capped at 5 on the upper side only
METRICS = """
WITH s AS (SELECT label, CAST(prediction AS DOUBLE) AS p, {bias} AS b FROM read_parquet('{path}/*.parquet') {where}),
n AS (SELECT *, (b - (SELECT min(b) FROM s)) / nullif((SELECT max(b) - min(b) FROM s), 0) AS n FROM s)
SELECT count(*), sqrt(avg(power(label - p, 2))), count(*) FILTER (WHERE label <> round(p)) / count(*),
       sqrt(avg(power(label - CASE WHEN n < 0.5 THEN p - n WHEN p + n > 5 THEN 5 ELSE p + n END, 2)))
FROM n"""


@pytest.fixture(scope="module")
def items(spark):
    return tpch_items(spark, SF_SMALL).cache()


def recomputed(duck, path, bias="NULL", where=""):
    return duck.execute(METRICS.format(path=path, bias=bias, where=where)).fetchone()


def same(got, want):
    for a, b in zip(got, want):
        if a is not None:
            assert a == pytest.approx(b, rel=1e-9)


def test_grade_and_bias_of_a_pair(duck, items, tmp_dir):
    _, scored, dropped = pair_predictions(items, "quantity", "kind", "grade", KEY, bias="price",
                                          add_bias_columns=False, rank=4, max_iter=3)
    write_predictions(scored, f"{tmp_dir}/p", columns=("label", "prediction", "bias_value"))
    m = pair_metrics(biased_scores(scored), "quantity", "kind", dropped=dropped).first()
    want = recomputed(duck, f"{tmp_dir}/p", "bias_value")
    assert m.n == m.n_bias > 0 and m.rmse_bias is not None
    same((m.n, m.rmse, m.error_fraction, m.rmse_bias), want)


def test_scaled_price_of_a_pair(duck, items, tmp_dir):
    _, scored, dropped = pair_predictions(items, "quantity", "size", "price", KEY, scale_rating=(1.0, 5.0),
                                          rank=4, max_iter=3)
    write_predictions(scored, f"{tmp_dir}/p", columns=("label", "prediction"))
    m = pair_metrics(scored, "quantity", "size", False, dropped).first()
    same((m.n, m.rmse), recomputed(duck, f"{tmp_dir}/p"))
    assert m.error_fraction is None


@pytest.mark.parametrize("kind, label, features", [
    ("class", "grade", ["kind", "flag", "quantity", "discount", "tax", "size", "price"]),
    ("class", "grade", ["quantity", "discount", "tax"]),
    ("reg", "price", ["grade", "kind", "quantity", "size"])])
def test_forests(duck, items, tmp_dir, kind, label, features):
    _, scored = forest_predictions(items, label, features, KEY, kind=kind, num_classes=9, num_trees=3, max_depth=4)
    write_predictions(scored, f"{tmp_dir}/p")
    m, want = forest_metrics(scored, kind).first(), recomputed(duck, f"{tmp_dir}/p")
    same((m.n, m.rmse, m.error_fraction), (want[0], want[1], want[2]))
    assert (m.rmse is None) == (kind == "class") and (m.error_fraction is None) == (kind == "reg")


def test_every_pair_of_a_sweep_and_its_table(spark, duck, items, tmp_dir):
    """All metrics of all pairs, from the stacked table, and as written."""
    cols = ["quantity", "kind", "size"]
    params = dict(rank=3, max_iter=2, seed=123)
    sweep = pair_sweep(items, cols, "grade", KEY, bias="price", **params)
    pairs = [(r.user, r.item) for r in sweep.collect()]
    with Scratch(spark) as scratch:
        table = sweep_table(items, cols, "grade", KEY, bias="price", write=scratch.write)
        scored = stacked_scores(table, pairs, True, scratch, **params)
        scored.write.parquet(f"{tmp_dir}/p")
        own = {r.model: r for r in stacked_metrics(scored, True, True, 0.5, 5.0).collect()}
    write_metrics(sweep, f"{tmp_dir}/m")
    back = spark.read.option("header", True).option("inferSchema", True).csv(f"{tmp_dir}/m").collect()
    assert len(own) == len(back) == 6
    for n, row in enumerate(back):
        assert (row.user, row.item) == pairs[n]
        want = recomputed(duck, f"{tmp_dir}/p", "bias_value", f"WHERE model = {n}")
        same((row.n, row.rmse, row.error_fraction, row.rmse_bias), want)
        same((own[n].n, own[n].rmse, own[n].error_fraction, own[n].rmse_bias), want)


def test_a_sweep_row_is_the_experiment_of_its_pair(items):
    """One solver: the same numbers whatever else is fitted."""
    from pairgrade.plans import pair_experiment
    params = dict(bias="price", rank=5, max_iter=3)
    rows = {(r.user, r.item): r for r in pair_sweep(items, ["quantity", "price", "kind"], "grade", KEY, **params).collect()}
    for user, item in (("quantity", "price"), ("price", "kind")):
        one = pair_experiment(items, user, item, "grade", KEY, **params).first()
        same((one.n, one.rmse, one.error_fraction, one.rmse_bias),
             (rows[user, item].n, rows[user, item].rmse, rows[user, item].error_fraction, rows[user, item].rmse_bias))


def test_null_ids_of_a_sweep(spark, items):
    """A null id has no part in the pairs of its column only."""
    df = items.withColumn("size", F.when(F.col("size") % 5 != 0, F.col("size")))
    rows = {(r.user, r.item): r for r in pair_sweep(df, ["quantity", "kind", "size"], "grade", KEY, rank=2, max_iter=1)
            .collect()}
    assert rows["quantity", "kind"].dropped_train == 0 < rows["quantity", "size"].dropped_train
    assert rows["quantity", "size"].n == rows["size", "quantity"].n < rows["quantity", "kind"].n
