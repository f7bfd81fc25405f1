"""Results that queries share follow their input."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


def test_rewritten_tables_are_read_again(spark, tmp_path):
    made = []

    def total():
        def make():
            made.append(1)
            return entry._t(spark, str(tmp_path), "part").selectExpr("sum(id) AS n")
        return entry._once(spark, str(tmp_path), "total", make).first().n

    spark.range(10).write.parquet(str(tmp_path / "part.parquet"))
    assert (total(), total(), len(made)) == (45, 45, 1)
    spark.range(10, 20).write.mode("overwrite").parquet(str(tmp_path / "part.parquet"))
    assert (total(), total(), len(made)) == (145, 145, 2)
    one = next((tmp_path / "part.parquet").glob("*.parquet"))
    os.utime(one, (1, 1))  # the same name and size
    assert (total(), len(made)) == (145, 3)
