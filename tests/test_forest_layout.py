"""The layout that forests are fitted on: sized by the rows, no hot partition."""

from collections import Counter

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pairgrade.operators import assemble, fit_forest, forest, forest_nodes


def rows(spark, n, hot, layout=3):
    """``n`` different rows, and one more that stands ``hot`` times."""
    df = spark.range(n + hot).select(
        (F.least("id", F.lit(n)) % 4).cast("double").alias("label"),
        F.least("id", F.lit(n)).cast("double").alias("f1"), F.lit(2.0).alias("f2"))
    return assemble(df.repartition(layout), ["f1", "f2"])


def dealt(df):
    """(rows by partition, rows by content)"""
    got = df.select(F.spark_partition_id(), "label", vector_to_array("features")).collect()
    return Counter(r[0] for r in got), Counter((r[1], tuple(r[2])) for r in got)


def test_partitions_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(forest, "PARTITION_ROWS", 100)
    df = rows(spark, 6000, 0).withColumn("k", F.col("label"))
    for key in ([], ["k"]):
        assert forest.laid_out(df, key=key).rdd.getNumPartitions() == 60
        assert forest.laid_out(df.limit(50), key=key).rdd.getNumPartitions() == forest.PARTITIONS
        assert forest.laid_out(df, partitions=5, key=key).rdd.getNumPartitions() == 5


def test_equal_rows_are_spread_and_none_is_lost(spark, monkeypatch):
    monkeypatch.setattr(forest, "COPIES", 50)
    n, hot = 3000, 6001
    tasks, content = dealt(forest.laid_out(rows(spark, n, hot)))
    assert sum(content.values()) == n + hot and len(content) == n + 1
    assert content[(n % 4, (float(n), 2.0))] == hot
    assert len(tasks) == forest.PARTITIONS and max(tasks.values()) < (n + hot) / 4


def test_the_same_forest_without_a_key_on_any_layout(spark, monkeypatch):
    monkeypatch.setattr(forest, "COPIES", 50)
    nodes = [sorted(map(str, forest_nodes(fit_forest(rows(spark, 300, 700, layout), "class", num_classes=4,
                                                     num_trees=3, max_depth=4), spark).collect()))
             for layout in (2, 7)]
    assert nodes[0] == nodes[1]
