"""Print the formatted physical plans of the main stages.

usage: python tools/explain_plans.py [sf_dir]

1. the narrow pair frame that is written once (scan pruning, joins, split);
2. min-max scaling of the written frame (bounds as one merged subquery);
3. ALS scoring with broadcast factor tables + the one-aggregate metrics;
4. the aggregated pairs of two models (one scan, grouping sets);
5. one half-iteration of the pair solver for both models (one shuffle of the
   factors, none of the cached pairs).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from pairgrade import build_session  # noqa: E402
from pairgrade.operators import fit_als, score_als  # noqa: E402
from pairgrade.operators import wals  # noqa: E402
from pairgrade.plans.experiments import pair_frame, pair_metrics, scale_label  # noqa: E402
from pairgrade.sources import materialize, tpch_items  # noqa: E402
from pairgrade.sources.sinks import Scratch  # noqa: E402

KEY = ["order_id", "line_no"]


def show(title, df):
    print(f"\n{'=' * 78}\n{title}\n{'=' * 78}")
    df.explain("formatted")


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("local[4]", driver_memory="4g")
    explain(spark, sf_dir)
    spark.stop()


def explain(spark, sf_dir):
    items = tpch_items(spark, sf_dir)
    frame = pair_frame(items, "quantity", "price", "grade", KEY, bias="price")
    show("1. narrow pair frame (written once)", frame)
    written = materialize(frame, "explain")
    show("2. rating scaled over the written frame", scale_label(
        written.withColumn("label", F.col("label").cast("double")), (1.0, 5.0)))
    model = fit_als(written.where("is_train"), "user_id", "item_id", "label",
                    rank=4, max_iter=1, solver="mllib")
    scored = score_als(model, written.where("not is_train"))
    show("3. broadcast scoring + one-aggregate metrics",
         pair_metrics(scored, "quantity", "price"))
    models = [("user_id", "item_id"), ("item_id", "user_id")]
    pairs = wals.aggregate_models(written.where("is_train"), models, "label")
    show("4. pairs of two models by one scan with grouping sets", pairs)
    pairs = materialize(pairs, "explain-pairs")
    sizes = {r.model: r["count"] for r in pairs.groupBy("model").count().collect()}
    for dst, src in (("u", "i"), ("i", "u")):
        pairs = wals._with_salt(pairs, dst, src, 1000)
    pairs = pairs.withColumn("part_u", wals._part("u", sizes, 4)).withColumn("part_i", wals._part("i", sizes, 4))
    by_u, by_i = wals._side(pairs, "u", "i", 4, False), wals._side(pairs, "i", "u", 4, False)
    with Scratch(spark) as scratch:
        step = lambda side, sent: wals._half_step(side, sent, 4, 0.01, 1, True, scratch)
        show("5. pair solver half-iteration, both models", step(by_u, wals._sent(step(by_i, None))))


if __name__ == "__main__":
    main(sys.argv)
