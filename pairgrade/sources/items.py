"""Graded-item tables.

``read_items_csv`` + ``encode_items`` turn a header CSV of graded items
(carat, cut, color, clarity, depth, table, price, x, y, z) into the all-integer
frame the experiments use.  ``tpch_items`` builds the stand-in item table from
the TPC-H style tables (lineitem, orders, part) used by tests and benchmarks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pairgrade.functions.encode import (
    CLARITY_LEVELS, COLOR_LEVELS, CUT_LEVELS, FIXED_POINT_DIGITS,
    fixed_point, ordinal, typed,
)
from pairgrade.sources.sinks import materialize


# ---------------------------------------------------------------------------
# Fixed values of the stand-in item table: ordered levels of the TPC-H style
# columns.  Code = 1-based position, anything else 0.
# ---------------------------------------------------------------------------
PRIORITY_LEVELS = ("5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT")
PART_TYPE_LEVELS = ("SMALL", "MEDIUM", "LARGE", "STANDARD", "ECONOMY", "PROMO")
RETURN_FLAG_LEVELS = ("A", "N", "R")


CORRUPT_COL = "_corrupt_line"


def read_items_csv(spark: SparkSession, path: str, corrupt: str | None = None) -> DataFrame:
    """Header CSV, every column a string (no schema inference pass); casting
    is done by ``encode_items`` so that malformed values become null.

    ``corrupt``: a column that holds the text of each malformed line (one with
    more or fewer cells than the header) and is null elsewhere.  Without it such
    a line passes with cells missing or cut off."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    plain = reader.csv(path)
    if corrupt is None:
        return plain
    schema = StructType([*plain.schema.fields, StructField(corrupt, StringType())])
    # the parser counts the cells of a line only if it doesn't skip any
    return (reader.schema(schema).option("columnNameOfCorruptRecord", corrupt).option("columnPruning", False)
            .csv(path))


def split_malformed(raw: DataFrame, corrupt: str = CORRUPT_COL) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows without ``corrupt``, malformed lines as ``line``).  The
    files are parsed once and written, both parts read what was written."""
    parsed = materialize(raw, "items-parsed")
    good = parsed.where(F.col(corrupt).isNull()).drop(corrupt)
    return good, parsed.where(F.col(corrupt).isNotNull()).select(F.col(corrupt).alias("line"))


#: Columns with a number of their own; the three others are levels.
NUMBER_COLUMNS = ("carat", "depth", "table", "price", "x", "y", "z")


def malformed_counts(raw: DataFrame, corrupt: str = CORRUPT_COL) -> DataFrame:
    """One row, by one aggregate: ``n_lines``, ``n_malformed_lines`` (wrong
    number of cells), and of the well-formed ones for each number column
    ``bad_<column>``, the cells with text that is no number, and
    ``empty_<column>``, those without text."""
    ok = F.col(corrupt).isNull()
    cells = []
    for c in NUMBER_COLUMNS:
        own = F.col(f"`{c}`")
        cells += [F.count_if(ok & own.isNotNull() & typed(own, "double").isNull()).alias(f"bad_{c}"),
                  F.count_if(ok & own.isNull()).alias(f"empty_{c}")]
    return raw.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(~ok).alias("n_malformed_lines"), *cells)


def encode_items(df: DataFrame, price_type: str = "int",
                 keep: Sequence[str] = ()) -> DataFrame:
    """String item columns -> integer ids and codes, in one projection.

    carat, x, y, z: x100; depth, table: x10 (rounded half up, int); price:
    ``price_type`` ("int" for grade experiments, "double" for price ones);
    cut, color, clarity: ordinal codes (unknown or null -> 0).  Columns in
    ``keep`` (e.g. a row id used as split key) pass through unchanged; any
    other input column is dropped."""
    def fixed(name: str):
        return fixed_point(typed(name, "double"), FIXED_POINT_DIGITS[name]).alias(name)

    return df.select(
        *keep,
        fixed("carat"),
        ordinal("color", COLOR_LEVELS).alias("color"),
        ordinal("clarity", CLARITY_LEVELS).alias("clarity"),
        fixed("depth"),
        fixed("table"),
        typed("price", price_type).alias("price"),
        fixed("x"),
        fixed("y"),
        fixed("z"),
        ordinal("cut", CUT_LEVELS).alias("cut"),
    )


def tpch_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders x part as a graded-item table.

    Columns: order_id, line_no (split key, not unique), grade (order priority
    code 1..5), kind (part type 1..6), flag (return flag 1..3), quantity,
    discount (x100), tax (x100), size, price (extended price, double).

    Only the needed columns are read from each file.  The lineitem-orders join
    shuffles on the order key (AQE splits a skewed key); part is joined the
    way the planner picks from its measured size."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_orderpriority")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", "p_type", "p_size")
    joined = (li.join(orders, li.l_orderkey == orders.o_orderkey)
                .join(part, li.l_partkey == part.p_partkey))
    return joined.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        ordinal("o_orderpriority", PRIORITY_LEVELS).alias("grade"),
        ordinal("p_type", PART_TYPE_LEVELS).alias("kind"),
        ordinal("l_returnflag", RETURN_FLAG_LEVELS).alias("flag"),
        fixed_point("l_quantity", 0).alias("quantity"),
        fixed_point("l_discount", 2).alias("discount"),
        fixed_point("l_tax", 2).alias("tax"),
        F.col("p_size").alias("size"),
        F.col("l_extendedprice").alias("price"),
    )
