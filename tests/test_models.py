"""ALS and forests: planted signal, cold start, duplicates, nulls, sweeps."""

import random

import pytest
from pyspark.sql import functions as F

from pairgrade.operators import factor_ids, fit_als, forest_nodes, score_als
from pairgrade.plans import (
    forest_experiment, forest_predictions, ordered_pairs, pair_experiment,
    pair_predictions, pair_sweep,
)


@pytest.fixture(scope="module")
def additive(spark):
    rng = random.Random(7)
    a = [rng.uniform(0.5, 2.5) for _ in range(20)]
    b = [rng.uniform(0.5, 2.5) for _ in range(20)]
    rows = [(k, u, i, a[u] + b[i]) for k, (u, i) in enumerate(
        (u, i) for u in range(20) for i in range(20) for _ in range(3))]
    return spark.createDataFrame(rows, "k long, u int, i int, r double")


def test_als_learns_additive_signal(additive):
    row = pair_experiment(additive, "u", "i", "r", "k", rank=4, max_iter=15,
                          classify=False).first()
    std = additive.agg(F.stddev("r")).first()[0]
    assert row["n"] > 300
    assert row["rmse"] < 0.25 * std


def test_als_factor_ids_are_train_users(spark, additive):
    from pairgrade.plans.experiments import pair_frame
    frame = pair_frame(additive, "u", "i", "r", "k")
    train = frame.where("is_train")
    model = fit_als(train, "user_id", "item_id", "label", rank=2, max_iter=2)
    got = {r.id for r in factor_ids(model).collect()}
    assert got == {r.user_id for r in train.select("user_id").distinct().collect()}


def test_all_cold_gives_empty_metrics(additive):
    # splitting by the user id puts every test user out of training
    row = pair_experiment(additive, "u", "i", "r", "u", rank=2, max_iter=2).first()
    assert row["n"] == 0
    assert row["rmse"] is None and row["error_fraction"] is None


def test_duplicate_pair_is_averaged(spark):
    rows = [(1, 1, 1.0), (1, 1, 5.0), (1, 2, 3.0), (2, 1, 3.0), (2, 2, 3.0)]
    df = spark.createDataFrame(rows, "u int, i int, r double")
    model = fit_als(df, "u", "i", "r", rank=4, max_iter=15, reg_param=0.01)
    p = score_als(model, df.where("u = 1 and i = 1").limit(1)).first()["prediction"]
    assert 2.0 < p < 4.0


def test_null_ids_and_ratings_are_dropped(spark):
    rows = [(1, 1, 2.0), (None, 1, 3.0), (2, None, 3.0), (2, 2, None), (2, 1, float("nan")),
            (1, 2, 4.0), (2, 2, 1.0)]
    df = spark.createDataFrame(rows, "u int, i int, r double")
    model = fit_als(df, "u", "i", "r", rank=2, max_iter=2)
    scored = score_als(model, df)
    assert scored.count() == 5  # null ids cannot be scored; the rest can


def test_bias_experiment_reports_unbiased_error(spark, additive):
    df = additive.withColumn("price", F.col("k") * 1.0).withColumn("grade", F.round("r").cast("int"))
    plain = pair_experiment(df, "u", "i", "grade", "k", rank=3, max_iter=5).first()
    biased = pair_experiment(df, "u", "i", "grade", "k", rank=3, max_iter=5, bias="price").first()
    assert plain["n"] == biased["n"]
    assert plain["rmse"] == pytest.approx(biased["rmse"], rel=1e-12)
    assert plain["error_fraction"] == biased["error_fraction"]
    assert biased["rmse_bias"] is not None


def test_bias_scale_uses_scored_rows(spark, additive):
    df = additive.withColumn("price", F.col("k") * 1.0)
    _, scored, _ = pair_predictions(df, "u", "i", "r", "k", rank=2, max_iter=2, bias="price")
    r = scored.agg(F.min("bias_n"), F.max("bias_n")).first()
    assert r[0] == 0.0 and r[1] == 1.0


def test_scaled_rating_range(spark, additive):
    _, scored, _ = pair_predictions(additive, "u", "i", "r", "k", rank=2, max_iter=2,
                                 scale_rating=(1.0, 5.0))
    r = scored.agg(F.min("label"), F.max("label")).first()
    assert 1.0 <= r[0] and r[1] <= 5.0


def test_ordered_pairs_count():
    cols = ["carat", "color", "clarity", "depth", "table", "price", "x", "y", "z"]
    pairs = ordered_pairs(cols)
    assert len(pairs) == 72 == len(set(pairs))
    assert ("price", "depth") in pairs and ("depth", "price") in pairs


def test_sweep_keeps_order_and_isolates_failures(spark, additive):
    df = additive.withColumn("bad", F.lit(None).cast("int"))
    out = pair_sweep(df, ["u", "i", "bad"], "r", "k", classify=False, rank=2, max_iter=2,
                     parallelism=3).collect()
    assert [(r.user, r.item) for r in out] == ordered_pairs(["u", "i", "bad"])
    good = {(r.user, r.item): r for r in out if r.error is None}
    assert set(good) == {("u", "i"), ("i", "u")}
    assert all(r.n is None and r.error for r in out if "bad" in (r.user, r.item))


def test_sweep_matches_single_experiment(spark, additive):
    one = pair_experiment(additive, "u", "i", "r", "k", rank=3, max_iter=4, classify=False).first()
    sw = pair_sweep(additive, ["u", "i"], "r", "k", pairs=[("u", "i")], classify=False,
                    rank=3, max_iter=4).first()
    assert sw.n == one.n
    assert sw.rmse == pytest.approx(one.rmse, rel=1e-6)


@pytest.fixture(scope="module")
def step(spark):
    rng = random.Random(11)
    rows = []
    for k in range(3000):
        f1, f2, f3 = rng.random(), rng.random(), rng.random()
        rows.append((k, 2.0 if f1 > 0.5 else 1.0, f1, f2, f3,
                     float(rng.choices([0, 1, 2], [0.6, 0.2, 0.2])[0])))
    return spark.createDataFrame(rows, "k long, label double, f1 double, f2 double, f3 double, noise double")


def test_forest_learns_step(step):
    row = forest_experiment(step, "label", ["f1", "f2", "f3"], "k", kind="class",
                            num_trees=5, max_depth=3).first()
    assert row["error_fraction"] < 0.02


def test_forest_on_noise_is_near_majority_rate(step):
    row = forest_experiment(step, "noise", ["f1", "f2", "f3"], "k", kind="class",
                            num_trees=5, max_depth=3).first()
    assert 0.3 < row["error_fraction"] < 0.5


def test_forest_regression_rmse(step):
    df = step.withColumn("y", F.col("f1") * 10)
    row = forest_experiment(df, "y", ["f1", "f2"], "k", kind="reg", num_trees=5, max_depth=6).first()
    assert row["rmse"] < 0.5 and row["error_fraction"] is None


def test_forest_class_count_and_nodes(spark, step):
    model, scored = forest_predictions(step, "label", ["f1", "f2", "f3"], "k", kind="class",
                                       num_classes=9, num_trees=3, max_depth=3)
    assert model.numClasses == 9
    nodes = forest_nodes(model, spark)
    assert nodes.count() == model.totalNumNodes
    assert nodes.select("tree_id").distinct().count() == 3
    leaves = nodes.where("is_leaf")
    assert leaves.where("feature <> -1 or threshold is not null").count() == 0


def test_forest_subset_by_vector_slice(step):
    from pairgrade.operators import assemble
    vec = assemble(step, ["f2", "f3", "f1"])
    row = forest_experiment(vec, "label", "features", "k", kind="class", subset=[2],
                            num_trees=3, max_depth=2).first()
    assert row["error_fraction"] < 0.02


def test_constant_price_scaled_rating_is_rejected(spark, additive):
    df = additive.withColumn("price", F.lit(7.0))
    with pytest.raises(ValueError, match="no usable ratings"):
        pair_experiment(df, "u", "i", "price", "k", scale_rating=(1.0, 5.0), rank=2, max_iter=1)


def test_dropped_ratings_count(spark):
    from pairgrade.operators import dropped_ratings
    rows = [(1, 1, 2.0), (None, 1, 3.0), (2, None, 3.0), (2, 2, None), (2, 1, float("nan"))]
    df = spark.createDataFrame(rows, "u int, i int, r double")
    r = dropped_ratings(df, "u", "i", "r").first()
    assert (r.rows, r.dropped) == (5, 4)


def test_metrics_independent_of_partitioning(spark):
    from pairgrade.operators import prediction_metrics
    rng = random.Random(3)
    rows = [(rng.randint(1, 5), rng.uniform(0, 6)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "label int, prediction double")
    a = prediction_metrics(df.repartition(1), "label").first()
    b = prediction_metrics(df.repartition(9), "label").first()
    assert a.n == b.n and a.error_fraction == b.error_fraction
    assert a.rmse == pytest.approx(b.rmse, rel=1e-12)


def test_als_rmse_independent_of_input_partitioning(additive):
    a = pair_experiment(additive.repartition(1), "u", "i", "r", "k", rank=3, max_iter=5,
                        classify=False, materialized=False).first()
    b = pair_experiment(additive.repartition(8), "u", "i", "r", "k", rank=3, max_iter=5,
                        classify=False, materialized=False).first()
    assert a.n == b.n
    assert a.rmse == pytest.approx(b.rmse, rel=1e-5)


@pytest.mark.parametrize("cold", ["drop", "nan"])
def test_broadcast_scoring_equals_transform(spark, additive, cold):
    from pairgrade.operators.factor import score_als as score
    from pairgrade.plans.experiments import pair_frame
    frame = pair_frame(additive, "u", "i", "r", "u")  # split by user: test users are cold
    frame = frame.union(pair_frame(additive, "u", "i", "r", "k"))
    model = fit_als(frame.where("is_train"), "user_id", "item_id", "label", rank=5,
                    max_iter=3, cold_start=cold)
    test = frame.where("not is_train")
    a = score(model, test, broadcast_mb=64)
    b = score(model, test, broadcast_mb=None)
    assert "BroadcastHashJoin" in a._jdf.queryExecution().executedPlan().toString() or \
        "Broadcast" in a._jdf.queryExecution().toString()
    assert a.columns == b.columns
    rows_a = sorted(map(tuple, a.collect()), key=str)
    rows_b = sorted(map(tuple, b.collect()), key=str)
    assert len(rows_a) == len(rows_b)
    for x, y in zip(rows_a, rows_b):
        assert x[:-1] == y[:-1]
        assert (x[-1] == y[-1]) or (x[-1] != x[-1] and y[-1] != y[-1])  # equal or both NaN


def test_scaled_rating_bounds_read_written_frame(spark):
    from data_paths import SF_SMALL
    from pairgrade.sources import tpch_items
    items = tpch_items(spark, SF_SMALL)
    _, scored, _ = pair_predictions(items, "kind", "size", "price", ["order_id", "line_no"],
                                 scale_rating=(1.0, 5.0), rank=2, max_iter=1)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan and "orders" not in plan
    r = scored.agg(F.min("label"), F.max("label")).first()
    assert 1.0 <= r[0] and r[1] <= 5.0


def test_sweep_scaled_rating_bounds_before_split(spark, additive):
    from pairgrade.plans.sweep import sweep_table
    table = sweep_table(additive, ["u", "i"], "r", "k", scale_rating=(1.0, 5.0))
    r = table.agg(F.min("__label"), F.max("__label")).first()
    assert (r[0], r[1]) == (1.0, 5.0)  # bounds of the whole table, both sides
    train = table.where("is_train").agg(F.min("__label"), F.max("__label")).first()
    assert 1.0 <= train[0] and train[1] <= 5.0


def test_forest_is_the_same_on_any_layout(spark):
    from pairgrade.operators import assemble, fit_forest, forest_nodes
    rows = [(k, float(k % 4), float(k % 17), float(k * 7 % 23)) for k in range(600)]
    df = spark.createDataFrame(rows, "k long, label double, f1 double, f2 double")
    nodes = []
    for n in (2, 8):
        vec = assemble(df.repartition(n), ["f1", "f2"])
        model = fit_forest(vec, "class", num_classes=4, key=["k"], num_trees=4, max_depth=4)
        nodes.append(sorted(map(str, forest_nodes(model, spark).collect())))
    assert nodes[0] == nodes[1]
