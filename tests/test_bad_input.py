"""Malformed lines are counted and kept apart; a lost write leaves the table as
it was."""

import os

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pairgrade.sources import (
    CORRUPT_COL, commit_table, committed_versions, drop_uncommitted, encode_items, malformed_counts, read_committed,
    read_items_csv, read_libsvm_checked, split_malformed,
)
from pairgrade.sources.sinks import materialize, pushed_bounds, written_bounds

HEADER = "id,carat,cut,color,clarity,depth,table,price,x,y,z"


def lines():
    out = []
    for n in range(400):
        cells = [str(n), "0.5", "Ideal", "E", "SI2", "61.5", "55", str(300 + n), "4", "4.1", "2.5"]
        if n % 7 == 0:
            cells[7] = "n/a"
        if n % 11 == 0:
            cells[1] = ""
        if n % 13 == 0:
            cells = cells[:5]
        elif n % 17 == 0:
            cells.append("more")
        out.append(",".join(cells))
    return out


def test_malformed_lines_are_counted_as_duckdb_counts_them(spark, duck, tmp_dir):
    path = os.path.join(tmp_dir, "items")
    os.mkdir(path)
    rows = lines()
    for part in range(4):  # a header in each file
        with open(f"{path}/p{part}.csv", "w") as f:
            f.write("\n".join([HEADER, *rows[part::4]]) + "\n")
    raw = read_items_csv(spark, path, corrupt=CORRUPT_COL)
    got = malformed_counts(raw).first().asDict()
    want = duck.execute(f"""
        WITH l AS (SELECT string_split(c, ',') AS v FROM (
               SELECT unnest(string_split(content, chr(10))) AS c FROM read_text('{path}/*.csv'))
             WHERE c <> '' AND c <> '{HEADER}'),
             g AS (SELECT v FROM l WHERE len(v) = 11)
        SELECT (SELECT count(*) FROM l), (SELECT count(*) FROM l WHERE len(v) <> 11),
               (SELECT count(*) FROM g WHERE v[8] <> '' AND TRY_CAST(v[8] AS DOUBLE) IS NULL),
               (SELECT count(*) FROM g WHERE v[2] = '')""").fetchone()
    assert (got["n_lines"], got["n_malformed_lines"], got["bad_price"], got["empty_carat"]) == want
    assert want[0] == 400 and min(want) > 0 and got["bad_carat"] == got["empty_x"] == 0
    good, bad = split_malformed(raw)
    assert good.count() + bad.count() == 400
    assert {r.line for r in bad.collect()} == {r for r in rows if r.count(",") != 10}
    assert encode_items(good, keep=["id"]).where("price is not null").count() == sum(
        r.count(",") == 10 and "n/a" not in r for r in rows)


def test_bad_libsvm_lines_are_quarantined(spark, tmp_dir):
    path = os.path.join(tmp_dir, "rows.libsvm")
    good = ["1 1:0.5 3:2", "0", "  2.5 2:-1e-3 3:4.  ", "-1 1:1 2:2 3:3", "1 3:.5 # a remark"]
    bad = ["1 0:0.5", "1 2:1 1:1", "1 2:1 2:1", "x 1:1", "1 1:one", "1 1:", "1 1", "1 4:1", "1 99999999999999999999:1",
           "1,1:2"]
    with open(path, "w") as f:
        f.write("\n".join([*good, "", "# a comment", *bad]) + "\n")
    rows, quarantined = read_libsvm_checked(spark, path, num_features=3)
    got = rows.select("label", vector_to_array("features").alias("x")).collect()
    assert sorted((r.label, *r.x) for r in got) == sorted(
        [(1, 0.5, 0, 2), (0, 0, 0, 0), (2.5, 0, -1e-3, 4), (-1, 1, 2, 3), (1, 0, 0, 0.5)])
    assert sorted(r.line for r in quarantined.collect()) == sorted(bad)


def test_libsvm_without_a_sound_or_a_bad_line(spark, tmp_dir):
    for name, text, n, lost in (("a", "x\ny\n", 0, 2), ("b", "1 1:1\n", 1, 0), ("c", "", 0, 0)):
        path = os.path.join(tmp_dir, name)
        with open(path, "w") as f:
            f.write(text)
        rows, quarantined = read_libsvm_checked(spark, path, num_features=2)
        assert (rows.count(), quarantined.count()) == (n, lost)


def test_a_killed_write_leaves_the_committed_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "predictions")
    with pytest.raises(FileNotFoundError):
        read_committed(spark, path)
    first = commit_table(spark.range(10), path)

    lost = spark.range(1000).select(F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        commit_table(lost, path)
    assert read_committed(spark, path).count() == 10 and committed_versions(spark, path) == [first]

    # killed after the rows, before the commit
    spark.range(77).write.parquet(f"{path}/v-killed")
    assert read_committed(spark, path).count() == 10

    second = commit_table(spark.range(20), path)  # the rerun
    assert read_committed(spark, path).count() == 20 and committed_versions(spark, path) == [first, second]
    gone = drop_uncommitted(spark, path)
    assert first in gone and "v-killed" in gone and second not in gone
    assert read_committed(spark, path).count() == 20 and committed_versions(spark, path) == [second]
    assert drop_uncommitted(spark, path) == []


def test_bounds_come_from_footers(spark):
    df = spark.range(1000).select((F.col("id") * 0.5).alias("label"), F.lit(None).cast("double").alias("none"),
                                  F.when(F.col("id") == 5, F.lit(float("nan"))).otherwise(1.0).alias("nan"))
    written = materialize(df, "bounds")
    plan = pushed_bounds(spark, "label", written.written_at)._jdf.queryExecution().toString()
    assert "PushedAggregation: [MIN(label), MAX(label)]" in plan
    for col in df.columns:
        want = written.agg(F.min(col), F.max(col)).first()
        assert str(written_bounds(written, col)) == str(tuple(want))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
