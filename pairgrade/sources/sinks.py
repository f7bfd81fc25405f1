"""Result sinks and lineage cuts.

Every sink is a distributed write; nothing is collected to the driver.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairgrade.session import scratch_path


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: the lineage is cut (a lost executor re-reads files instead of
    recomputing joins), and later readers prune columns and row groups."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return _reader(spark, path)


def _reader(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``; the frame knows where it is (``written_at``)."""
    df = spark.read.parquet(path)
    df.written_at = path
    return df


def written_bounds(df: DataFrame, col: str) -> tuple:
    """(min, max) of a number column of a written frame (as ``materialize``
    gives it): taken from the footers, not from the rows, by pushing the
    aggregate into the scan.

    The push-down belongs to Spark's second data source interface; a session of
    its own turns it on, the caller's settings stay.  Where the footers have no
    bounds (a NaN in the column, say), or the frame is no written one, the rows
    are read."""
    path = vars(df).get("written_at")  # not a column of that name
    try:
        low, high = pushed_bounds(df.sparkSession, col, path).first() if path else (None, None)
    except (PySparkException, Py4JJavaError):
        low = high = None
    # a footer leaves out NaN, and has no bounds for a column of nulls
    if low is None or low != low or high != high:
        low, high = df.agg(F.min(col), F.max(col)).first()
    return (low, high) if low is None else (low + 0, high + 0)  # footers have -0.0 for zero


def pushed_bounds(spark: SparkSession, col: str, path: str) -> DataFrame:
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.min(col), F.max(col))


class Scratch:
    """Tables of one computation under the shared folder, removed when it is
    done (``with Scratch(spark) as scratch``).  Only what nothing returned
    reads any more belongs here."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def write(self, df: DataFrame, name: str = "table") -> DataFrame:
        """``materialize``, to be removed."""
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        df.write.mode("overwrite").parquet(path)
        return _reader(self.spark, path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in self.paths:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
        self.paths.clear()


# ---------------------------------------------------------------------------
# Committed tables
# ---------------------------------------------------------------------------
def _marks(spark: SparkSession, path: str) -> list[str]:
    """Names of the commit marks below ``path``, oldest first."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_commits")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def commit_table(df: DataFrame, path: str, fmt: str = "parquet", **options) -> str:
    """Write ``df`` as a new version of the table at ``path``; returns its name.

    The rows go to a folder of their own, ``<path>/<version>``.  Only when all
    of them are written an empty file ``_commits/<time>-<version>`` is made,
    one atomic step on any store, and from then on readers see the version.  A
    job that is lost before that, or run twice, leaves what was committed as it
    is: a rerun commits a version of its own, and ``drop_uncommitted`` removes
    the remains."""
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    df.write.format(fmt).options(**options).mode("errorifexists").save(f"{path}/{version}")
    fs, mark = _files(spark, f"{path}/_commits/{time.time_ns():020d}-{version}")
    fs.create(mark, False).close()
    return version


def committed_versions(spark: SparkSession, path: str) -> list[str]:
    """The committed versions, oldest first."""
    return [name.split("-", 1)[1] for name in _marks(spark, path)]


def read_committed(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """The last committed version of the table at ``path``."""
    versions = committed_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no committed version at {path}")
    return spark.read.format(fmt).options(**options).load(f"{path}/{versions[-1]}")


def drop_uncommitted(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove the versions that were never committed and all but the last
    ``keep`` committed ones; not while a writer is at work.  Returns them."""
    marks = _marks(spark, path)
    held = {name.split("-", 1)[1] for name in marks[-keep:]} if keep else set()
    fs, at = _files(spark, path)
    gone = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    gone = [name for name in gone if name.startswith("v-") and name not in held]
    for name in marks[:len(marks) - keep]:  # the mark first: a version that is seen is whole
        fs.delete(_files(spark, f"{path}/_commits/{name}")[1], False)
    for name in gone:
        fs.delete(_files(spark, f"{path}/{name}")[1], True)
    return gone


def write_predictions(scored: DataFrame, path: str,
                      columns: Sequence[str] = ("label", "features", "prediction"),
                      mode: str = "overwrite") -> None:
    """One row per scored test row (parquet keeps vectors as structs)."""
    scored.select(*columns).write.mode(mode).parquet(path)


def write_metrics(metrics: DataFrame, path: str, fmt: str = "csv",
                  mode: str = "overwrite") -> None:
    """Metric table (user, item, rmse, ...); CSV with a header by default.
    The table is small (one row per experiment), so it is written as one file."""
    writer = metrics.coalesce(1).write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


# ---------------------------------------------------------------------------
# Column headers of the three published metric tables
# (error fraction is a 0..1 fraction despite its name).
# ---------------------------------------------------------------------------
METRIC_TABLE_HEADERS = {
    "grade": ("User", "Item", "RMSE", "ErrorPercentage"),
    "grade_bias": ("User", "Item", "RMSE", "ErrorPercentage", "RMSEBias"),
    "price": ("User", "Item", "RMSE"),
}
_METRIC_SOURCES = ("user", "item", "rmse", "error_fraction", "rmse_bias")


def metric_table(sweep: DataFrame, kind: str, errors: bool = True) -> DataFrame:
    """A sweep result in the layout of the published tables: ``grade``,
    ``grade_bias`` or ``price``.  ``errors`` adds the column ``Error``, which
    tells why a pair has no metrics."""
    headers = METRIC_TABLE_HEADERS[kind]
    columns = [F.col(src).alias(h) for src, h in zip(_METRIC_SOURCES, headers)]
    return sweep.select(*columns, *([F.col("error").alias("Error")] if errors else []))


def preview(scored: DataFrame, order_by: Sequence[str], n: int = 25,
            columns: Sequence[str] = ("label", "prediction")) -> DataFrame:
    """First ``n`` (label, prediction) rows in key order: a top-k (each task
    keeps its n smallest rows, one task merges n per input task).  Ties on the
    key are broken by the shown columns, so the result is the same for any
    partitioning even when keys repeat."""
    out = list(dict.fromkeys([*columns, *order_by]))
    order = list(dict.fromkeys([*order_by, *columns]))
    return scored.select(*out).orderBy(*[F.col(c) for c in order]).limit(n)
