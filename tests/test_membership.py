"""Bloom filters of trained ids, and scoring behind them."""

import pytest
from pyspark.sql import functions as F

from pairgrade.operators import fit_als, score_als
from pairgrade.operators.membership import bloom_words, keep_members


def test_members_stay_and_most_others_go(spark):
    ids = spark.range(0, 3000, 3).select(F.col("id").cast("int").alias("id"))
    df = spark.range(100_000).select(F.col("id").cast("int").alias("u"), F.lit("x").alias("word"))
    kept = keep_members(df, "u", ids, "id", bits=16)
    assert kept.columns == df.columns
    got = {r.u for r in kept.collect()}
    assert {r.id for r in ids.collect()} <= got and len(got) < 4000
    assert bloom_words(ids, "id", bits=10).count() <= 1 << 4  # whatever the ids
    assert keep_members(df, "u", ids.limit(0), "id").count() == 0
    assert keep_members(df.withColumn("u", F.lit(None).cast("int")), "u", ids, "id", bits=10).count() <= 100_000


@pytest.mark.parametrize("solver", ["pairs", "mllib"])
def test_scoring_above_the_bound_filters_before_the_joins(spark, solver):
    train = spark.range(600).select((F.col("id") % 40).cast("int").alias("u"), (F.col("id") % 7).cast("int").alias("i"),
                                    (F.col("id") % 5).cast("double").alias("r"))
    model = fit_als(train, "u", "i", "r", rank=2, max_iter=2, solver=solver)
    test = spark.range(5000).select((F.col("id") % 2000).cast("int").alias("u"), (F.col("id") % 9).cast("int").alias("i"),
                                    "id")
    near, far = score_als(model, test), score_als(model, test, broadcast_mb=0)
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, far.collect())) != []
    plan = far._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan and "bit_or" not in near._jdf.queryExecution().optimizedPlan().toString()
