"""CSV and LibSVM sources, sinks, materialisation, preview."""

import os

from pyspark.sql import functions as F

from pairgrade.operators import assemble
from pairgrade.plans import forest_experiment, forest_predictions
from pairgrade.session import checkpoint_root
from pairgrade.sources import (
    encode_items, materialize, preview, read_items_csv, read_libsvm, tpch_items,
    write_libsvm, write_metrics, write_predictions,
)
from data_paths import SF_SMALL

CSV = """,carat,cut,color,clarity,depth,table,price,x,y,z
1,0.23,Ideal,E,SI2,61.5,55,326,3.95,3.98,2.43
2,0.21,Premium,E,SI1,59.8,61,326,3.89,3.84,2.31
3,0.23,Good,E,VS1,56.9,65,327,4.05,4.07,2.31
4,bad,Excellent,Q,VVS3,,58,n/a,4.2,4.23,2.63
5,0.125,Very Good,D,IF,62.45,57.5,336,3.94,3.96,2.48
"""


def test_csv_items_encode(spark, tmp_dir):
    path = os.path.join(tmp_dir, "items.csv")
    with open(path, "w") as f:
        f.write(CSV)
    rows = encode_items(read_items_csv(spark, path)).collect()
    assert rows[0].asDict() == dict(carat=23, color=6, clarity=2, depth=615, table=550,
                                    price=326, x=395, y=398, z=243, cut=5)
    bad = rows[3]
    assert bad.carat is None and bad.cut == 0 and bad.color == 0 and bad.clarity == 0
    assert bad.depth is None and bad.price is None
    tie = rows[4]
    assert tie.carat == 13 and tie.depth == 625 and tie.table == 575 and tie.clarity == 8
    assert tie.color == 7 and tie.cut == 3
    dbl = encode_items(read_items_csv(spark, path), price_type="double").first()
    assert dbl.price == 326.0


def test_libsvm_round_trip_and_forest(spark, tmp_dir):
    items = tpch_items(spark, SF_SMALL)
    vec = assemble(items, ["kind", "flag", "quantity", "tax"])
    path = os.path.join(tmp_dir, "items.libsvm")
    write_libsvm(vec, path, label="grade")
    back = read_libsvm(spark, path, num_features=4)
    assert back.count() == items.count()
    assert back.agg(F.sum("label")).first()[0] == items.agg(F.sum("grade")).first()[0]
    row = forest_experiment(back, "label", "features", None, kind="class",
                            num_trees=3, max_depth=3).first()
    assert row["n"] > 0 and 0.0 <= row["error_fraction"] <= 1.0


def test_prediction_sink_and_preview(spark, tmp_dir):
    items = tpch_items(spark, SF_SMALL)
    _, scored = forest_predictions(items, "grade", ["kind", "quantity"], ["order_id", "line_no"],
                                   kind="class", num_trees=2, max_depth=2)
    path = os.path.join(tmp_dir, "pred")
    write_predictions(scored, path)
    back = spark.read.parquet(path)
    assert back.columns == ["label", "features", "prediction"]
    assert back.count() == scored.count()
    p1 = [tuple(r) for r in preview(scored, ["order_id", "line_no", "label"]).collect()]
    p2 = [tuple(r) for r in preview(scored.repartition(3), ["order_id", "line_no", "label"]).collect()]
    assert len(p1) == 25 and p1 == p2


def test_metrics_sink_csv(spark, tmp_dir):
    m = spark.createDataFrame([("a", "b", 3, 0.5)], "user string, item string, n long, rmse double")
    path = os.path.join(tmp_dir, "metrics")
    write_metrics(m, path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["user", "item", "n", "rmse"] and back.count() == 1


def test_materialize_uses_checkpoint_folder(spark):
    df = spark.range(10)
    out = materialize(df, "t")
    root = checkpoint_root(spark)
    files = out.inputFiles()
    def bare(p):
        return p.split(":", 1)[-1].lstrip("/")
    assert files and all(bare(f).startswith(bare(root)) for f in files)
    assert out.count() == 10


def test_metric_table_layouts(spark):
    from pairgrade.plans.sweep import SWEEP_SCHEMA
    from pairgrade.sources import metric_table
    sweep = spark.createDataFrame([("carat", "color", 10, 10, 1.0, 0.5, 9, 1.1, 0, 0, None)], SWEEP_SCHEMA)
    assert metric_table(sweep, "grade", errors=False).columns == ["User", "Item", "RMSE", "ErrorPercentage"]
    assert metric_table(sweep, "grade_bias").columns[-2:] == ["RMSEBias", "Error"]
    assert metric_table(sweep, "price", errors=False).first().asDict() == {"User": "carat", "Item": "color", "RMSE": 1.0}
