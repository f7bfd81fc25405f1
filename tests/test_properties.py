"""Property-based checks of the scalar operators and metrics against plain
Python formulas (one Spark job per generated batch)."""

import math
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairgrade.functions import bias_adjust, fixed_point, minmax, round_class
from pairgrade.operators import prediction_metrics

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

finite = st.floats(min_value=-1e5, max_value=1e5, allow_nan=False, allow_infinity=False)


def half_up(x: float) -> int:
    return int(Decimal(repr(x)).quantize(Decimal(1), rounding=ROUND_HALF_UP))


@SETTINGS
@given(st.lists(finite, min_size=1, max_size=30), st.sampled_from([0, 1, 2]))
def test_fixed_point_matches_python(spark, xs, digits):
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    got = [r[0] for r in df.select(fixed_point("v", digits)).collect()]
    want = [half_up(x * 10 ** digits) if digits else half_up(x) for x in xs]
    assert got == want


@SETTINGS
@given(st.lists(finite, min_size=1, max_size=30))
def test_round_class_matches_python(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    assert [r[0] for r in df.select(round_class("v")).collect()] == [half_up(x) for x in xs]


@SETTINGS
@given(st.lists(finite, min_size=2, max_size=30), st.floats(-5, 5), st.floats(6, 20))
def test_minmax_matches_python(spark, xs, a, b):
    lo, hi = min(xs), max(xs)
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    got = [r[0] for r in df.select(minmax(F.col("v"), lo, hi, a, b)).collect()]
    for x, g in zip(xs, got):
        if hi == lo:
            assert g is None
        else:
            assert g == (x - lo) / (hi - lo) * (b - a) + a


@SETTINGS
@given(st.lists(st.tuples(st.floats(-2, 8, allow_nan=False), st.floats(0, 1)), min_size=1, max_size=30))
def test_bias_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "p double, n double")
    got = [r[0] for r in df.select(bias_adjust(F.col("p"), F.col("n"))).collect()]
    for (p, n), g in zip(rows, got):
        want = p - n if n < 0.5 else (5.0 if p + n > 5 else p + n)
        assert g == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.floats(-1, 7, allow_nan=False)), min_size=1, max_size=40))
def test_metrics_match_python(spark, rows):
    df = spark.createDataFrame(rows, "label int, prediction double")
    m = prediction_metrics(df, "label", "prediction").first()
    n = len(rows)
    rmse = math.sqrt(sum((y - p) ** 2 for y, p in rows) / n)
    wrong = sum(1 for y, p in rows if y != half_up(p))
    assert m["n"] == n
    assert m["rmse"] == __import__("pytest").approx(rmse, rel=1e-9, abs=1e-12)
    assert m["error_fraction"] == wrong / n
    assert m["rmse_bias"] is None
