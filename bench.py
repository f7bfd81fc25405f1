"""Benchmark: headline experiments at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_wall", "value": <sec>, "unit": "sec", "queries": {...}, "sf": ...,
 "results": {...}}

Experiments run with the reference's model sizes (ALS rank 70, 10
iterations, regParam 0.01; forests of 25 trees, depth 15 / 20, 32 bins; seed
123; 70/30 split).  ``results`` carries the metric rows so quality can be read
next to time.  BENCH_QUERIES=a,b limits the run; once BENCH_BUDGET_SEC
(default 1800) has passed, the remaining queries are listed as skipped.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from pairgrade import build_session  # noqa: E402
from pairgrade.functions import bias_adjust  # noqa: E402
from pairgrade.operators import minmax_unit, prediction_metrics  # noqa: E402
from pairgrade.plans import forest_experiment, pair_experiment, pair_sweep  # noqa: E402
from pairgrade.sources import tpch_items  # noqa: E402
from pairgrade.sources.sinks import materialize  # noqa: E402

KEY = ["order_id", "line_no"]
FEATURES = ["kind", "flag", "quantity", "discount", "tax", "size", "price"]
SUBSET = ["quantity", "discount", "tax"]
PRICE_FEATURES = ["grade", "kind", "flag", "quantity", "discount", "tax", "size"]


def q_encode_metrics(items):
    s = materialize(items.select(*KEY, "grade", (F.col("quantity") / 10).alias("prediction"), "price"), "bench")
    s = minmax_unit(s, "price", "bias_n").withColumn(
        "prediction_bias", bias_adjust(F.col("prediction"), F.col("bias_n")))
    return prediction_metrics(s, "grade", "prediction", biased_prediction="prediction_bias")


# cheapest first, so a time budget drops only the expensive tail
QUERIES = {
    "encode_metrics": q_encode_metrics,
    "pair_price": lambda it: pair_experiment(it, "quantity", "kind", "price", KEY, scale_rating=(1.0, 5.0)),
    "pair_grade": lambda it: pair_experiment(it, "quantity", "discount", "grade", KEY),
    "forest_grade_subset": lambda it: forest_experiment(it, "grade", SUBSET, KEY, kind="class", num_classes=9),
    "pair_grade_bias": lambda it: pair_experiment(it, "quantity", "price", "grade", KEY, bias="price"),
    "forest_grade": lambda it: forest_experiment(it, "grade", FEATURES, KEY, kind="class", num_classes=9),
    "sweep_grade_bias": lambda it: pair_sweep(it, ["quantity", "price", "kind"], "grade", KEY,
                                              bias="price"),
    # E1 again with MLlib's solver: speed and RMSE next to the default's
    "pair_grade_mllib": lambda it: pair_experiment(it, "quantity", "discount", "grade", KEY,
                                                   solver="mllib"),
    "forest_price": lambda it: forest_experiment(it, "price", PRICE_FEATURES, KEY, kind="reg"),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    budget = float(os.environ.get("BENCH_BUDGET_SEC", "1800"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          app_name="pairgrade-bench")
    items = tpch_items(spark, sf_dir)
    times, results, skipped = {}, {}, []
    start = time.time()
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        if time.time() - start > budget:
            skipped.append(name)
            continue
        t0 = time.time()
        rows = fn(items).collect()
        times[name] = round(time.time() - t0, 3)
        results[name] = [{k: (round(v, 6) if isinstance(v, float) else v)
                          for k, v in r.asDict().items()} for r in rows]
    print(json.dumps({"metric": "total_wall", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus),
                      "skipped": skipped, "results": results}))
    spark.stop()


if __name__ == "__main__":
    main()
