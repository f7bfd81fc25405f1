"""Labelled sparse vectors in LibSVM text (``label index:value ...``, 1-based
indexes on disk, 0-based in Spark).  Spark's own data source does the
parsing on the executors, both ways."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairgrade.session import scratch_path

_NUMBER = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
#: A label and index:value items; a comment or an empty line is no row.
_LINE = rf"^{_NUMBER}( \d+:{_NUMBER})*$"
_BLANK = r"^\s*(#.*)?$"


def checked_lines(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """(line, ok): the lines of LibSVM text but for empty ones and comments; of
    sound ones one space stands for any others, and a comment behind is cut off.

    A line is sound if it has a number as its label, then items
    ``index:value`` of which the indexes rise from 1 on, up to ``num_features``
    if that is given."""
    line = F.trim(F.regexp_replace(F.regexp_replace("value", r"#.*$", ""), r"\s+", " "))
    indexes = F.transform(F.expr(r"regexp_extract_all(line, '(\\d+):', 1)"), lambda i: i.try_cast("bigint"))
    last = F.lit(num_features if num_features is not None else 2 ** 31 - 1)
    steps = F.zip_with("indexes", F.concat(F.array(F.lit(0).cast("bigint")), F.slice("indexes", 1, F.size("indexes"))),
                       lambda here, before: F.coalesce(here.isNull() | (here > before), F.lit(False)))
    rising = F.forall(F.slice(steps, 1, F.size("indexes")), lambda up: up) & \
        F.forall("indexes", lambda i: i.isNotNull() & (i <= last))
    return (spark.read.text(path).where(~F.col("value").rlike(_BLANK))
            .select(F.col("value"), line.alias("line")).withColumn("indexes", indexes)
            .withColumn("ok", F.col("line").rlike(_LINE) & rising)
            .select(F.when(F.col("ok"), F.col("line")).otherwise(F.col("value")).alias("line"), "ok"))


def read_libsvm_checked(spark: SparkSession, path: str, num_features: int | None = None,
                        ) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantined lines): the sound lines as ``read_libsvm`` gives them,
    and the others as ``line``, both written in the shared folder.

    One bad line fails a job over Spark's data source, hours into it perhaps.
    The lines are checked on the executors first and dealt to two text tables;
    the data source reads the sound one."""
    at = scratch_path(spark, "libsvm-checked")
    (checked_lines(spark, path, num_features).select(F.col("line").alias("value"), F.col("ok").cast("string").alias("ok"))
     .write.partitionBy("ok").text(at))
    lines = lambda ok: spark.read.schema("value string, ok string").text(at).where(F.col("ok") == ok)
    bad = lines("false").select(F.col("value").alias("line"))
    if lines("true").isEmpty():
        none = spark.createDataFrame([], "value string")
        none.write.mode("append").text(f"{at}/ok=true")
    return read_libsvm(spark, f"{at}/ok=true", num_features), bad


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """``label double, features vector``.  Give ``num_features`` when known:
    otherwise Spark needs an extra pass over the files to find it."""
    reader = spark.read.format("libsvm")
    if num_features is not None:
        reader = reader.option("numFeatures", int(num_features))
    return reader.load(path)


def write_libsvm(df: DataFrame, path: str, label: str = "label",
                 features: str = "features", mode: str = "overwrite") -> None:
    (df.select(df[label].cast("double").alias("label"), df[features].alias("features"))
       .write.format("libsvm").mode(mode).save(path))
