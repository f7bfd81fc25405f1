"""The pair solver: same objective as MLlib's explicit ALS, on aggregated
pairs with salting of heavy ids."""

import random

import pytest
from pyspark.sql import functions as F

from pairgrade.operators import fit_als, score_als
from pairgrade.operators import wals
from pairgrade.operators.wals import aggregate_pairs
from pairgrade.plans import pair_experiment


@pytest.fixture(scope="module")
def hot(spark):
    """User 0 holds a third of all rows, spread over many items; (u, i)
    pairs repeat."""
    rng = random.Random(5)
    a = [rng.uniform(0.5, 2.5) for _ in range(30)]
    b = [rng.uniform(0.5, 2.5) for _ in range(60)]
    rows = []
    for k in range(6000):
        u = 0 if k % 3 == 0 else rng.randrange(1, 30)
        i = rng.randrange(60)
        rows.append((k, u, i, a[u] + b[i] + rng.gauss(0, 0.05)))
    return spark.createDataFrame(rows, "k long, u int, i int, r double")


def test_pairs_solver_learns_like_mllib(hot):
    m = pair_experiment(hot, "u", "i", "r", "k", rank=4, max_iter=10, classify=False,
                        solver="mllib").first()
    p = pair_experiment(hot, "u", "i", "r", "k", rank=4, max_iter=10, classify=False,
                        solver="pairs").first()
    assert p.n == m.n
    assert p.rmse < 0.2
    assert p.rmse == pytest.approx(m.rmse, abs=0.05)


def test_salting_does_not_change_factors(spark, hot):
    pairs = aggregate_pairs(hot, "u", "i", "r")
    assert pairs.agg(F.sum("c")).first()[0] == 6000
    plain = fit_als(hot, "u", "i", "r", rank=3, max_iter=4, solver="pairs")
    salted = fit_als(hot, "u", "i", "r", rank=3, max_iter=4, solver="pairs", target_pairs=7)
    a = {r.id: r.features for r in plain.user_factors.collect()}
    b = {r.id: r.features for r in salted.user_factors.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-4)
    ai = {r.id: r.features for r in plain.item_factors.collect()}
    bi = {r.id: r.features for r in salted.item_factors.collect()}
    for k in ai:
        assert ai[k] == pytest.approx(bi[k], abs=1e-4)


def test_pairs_scoring_broadcast_equals_shuffle(hot):
    model = fit_als(hot, "u", "i", "r", rank=3, max_iter=2, solver="pairs")
    a = sorted(map(tuple, score_als(model, hot, broadcast_mb=64).collect()))
    b = sorted(map(tuple, score_als(model, hot, broadcast_mb=None).collect()))
    assert a == b and len(a) == 6000


def _factors(model):
    return [{r.id: r.features for r in side.collect()} for side in (model.user_factors, model.item_factors)]


def _assert_same(one, two, tolerance):
    for a, b in zip(one, two):
        assert a.keys() == b.keys()
        for k in a:
            assert a[k] == pytest.approx(b[k], abs=tolerance)


def test_factors_do_not_depend_on_the_layout(spark, hot, monkeypatch):
    """More partitions (of the source, of the pairs), shuffled instead of
    broadcast factors: the same factors."""
    plain = _factors(fit_als(hot, "u", "i", "r", rank=3, max_iter=4))
    monkeypatch.setattr(wals, "PARTITION_PAIRS", 20)
    many = _factors(fit_als(hot.repartition(40), "u", "i", "r", rank=3, max_iter=4))
    _assert_same(plain, many, 1e-5)
    routed = _factors(fit_als(hot, "u", "i", "r", rank=3, max_iter=4, broadcast_mb=None, target_pairs=7))
    _assert_same(plain, routed, 1e-5)


def test_hot_id_with_a_small_broadcast_bound(hot, monkeypatch):
    """One id holds a third of the rows and nothing may be broadcast."""
    monkeypatch.setattr(wals, "MAX_HEAVY_IDS", 5)
    a = pair_experiment(hot, "u", "i", "r", "k", rank=4, max_iter=6, classify=False, target_pairs=5,
                        broadcast_mb=0).first()
    b = pair_experiment(hot, "u", "i", "r", "k", rank=4, max_iter=6, classify=False).first()
    assert a.n == b.n and a.rmse == pytest.approx(b.rmse, abs=1e-4)


def test_unknown_solver_rejected(hot):
    with pytest.raises(ValueError):
        fit_als(hot, "u", "i", "r", solver="nope")


def test_sweep_with_pair_solver(hot):
    from pairgrade.plans import pair_sweep
    rows = pair_sweep(hot, ["u", "i"], "r", "k", classify=False, rank=3, max_iter=3,
                      solver="pairs").collect()
    assert [(r.user, r.item) for r in rows] == [("u", "i"), ("i", "u")]
    assert all(r.error is None and r.n > 0 and r.rmse is not None for r in rows)


def test_parameters_are_checked_before_any_fit(hot):
    from pairgrade.plans import pair_sweep
    with pytest.raises(ValueError, match="implicit"):
        fit_als(hot, "u", "i", "r", implicit=True)
    with pytest.raises(ValueError, match="broadcast_mb"):
        fit_als(hot, "u", "i", "r", solver="mllib", broadcast_mb=64)
    with pytest.raises(TypeError, match="no_such_option"):
        fit_als(hot, "u", "i", "r", no_such_option=1)
    with pytest.raises(TypeError, match="no_such_option"):
        pair_sweep(hot, ["u", "i"], "r", "k", no_such_option=1)


def test_default_solver_is_the_pair_solver_at_every_size(hot):
    from pairgrade.operators.wals import PairFactors
    assert isinstance(fit_als(hot.limit(5), "u", "i", "r", rank=2, max_iter=1), PairFactors)
    assert isinstance(fit_als(hot, "u", "i", "r", rank=2, max_iter=1), PairFactors)


def test_dropped_rows_and_covered_rows_are_counted(spark):
    rows = [(k, None if k % 10 == 0 else k % 7, k % 5, None if k % 9 == 0 else float(k % 5),
             None if k % 4 == 0 else float(k)) for k in range(400)]
    df = spark.createDataFrame(rows, "k long, u int, i int, r double, price double")
    frame = df.where("u is not null and r is not null")
    m = pair_experiment(df, "u", "i", "r", "k", rank=2, max_iter=2, bias="price", classify=False).first()
    from pairgrade.plans.experiments import pair_frame
    split = pair_frame(df, "u", "i", "r", "k").collect()
    assert m.dropped_train == sum(r.is_train and (r.user_id is None or r.label is None) for r in split) > 0
    assert m.dropped_test == sum(not r.is_train and r.user_id is None for r in split) > 0
    assert 0 < m.n_bias < m.n_labelled < m.n
    assert frame.count() < 400


def test_ids_outside_the_int_range_fail(spark):
    df = spark.createDataFrame([(k, 5_000_000_000 + k % 3, k % 4, 1.0) for k in range(50)],
                               "k long, u long, i long, r double")
    with pytest.raises(Exception, match="id outside the int range"):
        pair_experiment(df, "u", "i", "r", "k", rank=2, max_iter=1).collect()


def test_an_absurd_prediction_is_wrong(spark):
    from pairgrade.operators import prediction_metrics
    df = spark.createDataFrame([(5, 1e10), (5, float("nan")), (5, 5.2), (5, None)], "label int, prediction double")
    m = prediction_metrics(df, "label").first()
    assert m.error_fraction == 0.5 and m.n == 4 and m.n_labelled == 3


def test_failed_pair_keeps_its_whole_message_and_all_failed_raises(spark, hot):
    from pairgrade.plans import pair_sweep
    from pairgrade.sources import metric_table
    df = hot.withColumn("empty", F.lit(None).cast("int"))
    out = pair_sweep(df, ["u", "i", "empty"], "r", "k", classify=False, rank=2, max_iter=2)
    rows = {(r.user, r.item): r for r in out.collect()}
    assert rows["u", "i"].error is None and "no usable ratings" in rows["u", "empty"].error
    assert rows["u", "empty"].dropped_train > 0
    table = {(r.User, r.Item): r for r in metric_table(out, "grade").collect()}
    assert table["u", "empty"].Error == rows["u", "empty"].error and table["u", "i"].Error is None
    with pytest.raises(RuntimeError, match="every pair"):
        pair_sweep(df, ["u", "empty"], "r", "k", rank=2, max_iter=1)


def test_a_sweep_leaves_only_what_is_still_read(spark, hot):
    import os
    from pairgrade.plans import pair_sweep
    from pairgrade.session import checkpoint_root
    at = checkpoint_root(spark).removeprefix("file:") + "/pairgrade"
    at = "/" + at.lstrip("/")
    before = set(os.listdir(at)) if os.path.isdir(at) else set()
    pair_sweep(hot, ["u", "i"], "r", "k", bias="r", classify=False, rank=2, max_iter=2)
    left = sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(at)) - before)
    assert left == []  # the metrics are rows of their own
