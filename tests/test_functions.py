"""Scalar expressions: encoding, rounding, scaling, bias, split."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructField, StructType

from pairgrade.functions import (
    as_id, bias_adjust, fixed_point, minmax, ordinal, round_class, split_unit, typed,
)
from pairgrade.functions.encode import CLARITY_LEVELS, COLOR_LEVELS, CUT_LEVELS
from pairgrade.operators import hash_split, minmax_bounds, minmax_scale, minmax_unit


def test_ordinal_levels_unknown_and_null(spark):
    df = spark.createDataFrame([("Fair",), ("Ideal",), ("Very Good",), ("Excellent",), (None,)], "s string")
    got = [r[0] for r in df.select(ordinal("s", CUT_LEVELS)).collect()]
    assert got == [1, 5, 3, 0, 0]


def test_ordinal_lists_are_ordered():
    assert len(CUT_LEVELS) == 5 and len(COLOR_LEVELS) == 7 and len(CLARITY_LEVELS) == 8
    assert COLOR_LEVELS[0] == "J" and COLOR_LEVELS[-1] == "D"
    assert CLARITY_LEVELS[0] == "I1" and CLARITY_LEVELS[-1] == "IF"


def test_typed_cast_malformed_is_null(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), ("",), (None,), ("7",)], "s string")
    got = [r[0] for r in df.select(typed("s", "double")).collect()]
    assert got == [1.5, None, None, None, 7.0]
    got = [r[0] for r in df.select(typed("s", "int")).collect()]
    assert got[1:] == [None, None, None, 7]


def test_fixed_point_half_up_and_negative(spark):
    df = spark.createDataFrame([(0.57,), (0.125,), (-0.125,), (2.5,), (-2.5,), (None,)], "d double")
    got = [r[0] for r in df.select(fixed_point("d", 2)).collect()]
    # 0.125*100 = 12.5 exactly -> 13; -12.5 -> -13 (half away from zero)
    assert got == [57, 13, -13, 250, -250, None]
    got = [r[0] for r in df.select(fixed_point("d", 0)).collect()]
    assert got == [1, 0, 0, 3, -3, None]


def test_fixed_point_overflow_is_null(spark):
    df = spark.createDataFrame([(1e12,)], "d double")
    assert df.select(fixed_point("d", 2)).first()[0] is None


def test_round_class_nan_and_ties(spark):
    df = spark.createDataFrame([(2.5,), (-0.5,), (float("nan"),), (4.49,)], "p double")
    got = [r[0] for r in df.select(round_class("p")).collect()]
    assert got == [3, -1, None, 4]


def test_as_id(spark):
    from pyspark.sql.types import IntegerType
    df = spark.createDataFrame([(12.4, 3), (12.5, 4)], "d double, i int")
    assert [r[0] for r in df.select(as_id("d")).collect()] == [12, 13]
    assert [r[0] for r in df.select(as_id("i", IntegerType())).collect()] == [3, 4]


@pytest.mark.parametrize("n,p,expected", [
    (0.0, 3.0, 3.0),        # unbiased at n = 0
    (0.49, 3.0, 2.51),      # lower branch subtracts
    (0.5, 3.0, 3.5),        # jump at the pivot
    (1.0, 3.0, 4.0),
    (0.5, 4.5, 5.0),        # p + n == 5 -> not above cap -> 5.0 anyway
    (0.6, 4.5, 5.0),        # capped
    (0.2, 0.1, -0.1),       # no floor
    (None, 3.0, None),
])
def test_bias_edges(spark, n, p, expected):
    schema = StructType([StructField("prediction", FloatType()), StructField("n", DoubleType())])
    df = spark.createDataFrame([(p, n)], schema)
    got = df.select(bias_adjust(F.col("prediction"), F.col("n"))).first()[0]
    if expected is None:
        assert got is None
    else:
        assert got == pytest.approx(expected, abs=1e-6)


def test_minmax_scale_hits_bounds_and_constant(spark):
    df = spark.createDataFrame([(i, float(i * 3)) for i in range(10)], "k int, v double")
    out = minmax_scale(df, "v", "s", 1.0, 5.0)
    vals = [r["s"] for r in out.orderBy("k").collect()]
    assert vals[0] == 1.0 and vals[-1] == 5.0
    assert all(a < b for a, b in zip(vals, vals[1:]))
    flat = spark.createDataFrame([(i, 7.0) for i in range(5)], "k int, v double")
    assert {r["s"] for r in minmax_scale(flat, "v", "s").collect()} == {None}


def test_minmax_fit_on_other_frame(spark):
    df = spark.createDataFrame([(0.0,), (10.0,)], "v double")
    ref = spark.createDataFrame([(0.0,), (20.0,)], "v double")
    got = sorted(r["u"] for r in minmax_unit(df, "v", "u", fit_on=ref).collect())
    assert got == [0.0, 0.5]


def test_minmax_bounds_empty(spark):
    df = spark.createDataFrame([], "v double")
    row = minmax_bounds(df, "v").first()
    assert row[0] is None and row[1] is None


def test_minmax_expr_literals(spark):
    df = spark.createDataFrame([(5.0,)], "v double")
    assert df.select(minmax(F.col("v"), 0.0, 10.0, 1.0, 5.0)).first()[0] == 3.0


def test_split_properties(spark):
    df = spark.range(0, 20000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("j"))
    train, test = hash_split(df, ["k", "j"], 0.7, seed=123)
    n_train, n_test = train.count(), test.count()
    assert n_train + n_test == 20000
    assert 0.69 < n_train / 20000 < 0.71
    assert train.join(test, ["k", "j"]).count() == 0


def test_split_independent_of_partitioning(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("k"))
    a = {r.k for r in hash_split(df.repartition(1), ["k"])[0].collect()}
    b = {r.k for r in hash_split(df.repartition(7), ["k"])[0].collect()}
    c = {r.k for r in hash_split(df.orderBy(F.desc("k")).repartition(3), ["k"])[0].collect()}
    assert a == b == c


def test_split_same_key_same_side(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 1, "c")] * 50, "k int, j int, v string")
    train, test = hash_split(df, ["k", "j"])
    tk = {(r.k, r.j) for r in train.collect()}
    sk = {(r.k, r.j) for r in test.collect()}
    assert not tk & sk


def test_split_unit_matches_md5_rule(spark):
    import hashlib
    row = spark.createDataFrame([(42, 7)], "a long, b int").select(split_unit(["a", "b"], 123)).first()[0]
    h = hashlib.md5(b"123|42|7").hexdigest()[:8]
    assert row == int(h, 16) / 2 ** 32


def test_split_xxhash_range(spark):
    df = spark.range(0, 2000).select(split_unit(["id"], 5, "xxhash64").alias("u"))
    r = df.agg(F.min("u"), F.max("u")).first()
    assert 0.0 <= r[0] and r[1] < 1.0
    with pytest.raises(ValueError):
        split_unit(["id"], 5, "nope")


def test_encoding_independent_of_partitioning_and_order(spark):
    from data_paths import SF_SMALL
    from pairgrade.operators import with_split
    from pairgrade.sources import tpch_items
    items = tpch_items(spark, SF_SMALL)
    base = with_split(items, ["order_id", "line_no"])
    a = sorted(map(tuple, base.collect()))
    b = sorted(map(tuple, with_split(items.repartition(5).orderBy(F.rand(3)),
                                     ["order_id", "line_no"]).collect()))
    assert a == b
