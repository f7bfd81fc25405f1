"""Connected components by the least node reachable, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairgrade.sources.sinks import materialize


def components(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b) and of ``labels``: the
    least node that it reaches.

    In each round a node takes the least label around it, then its label's own
    label; rounds are written to the shared folder, so neither the plan nor a
    lost executor's work grows with their number.  ``labels`` may hold what
    earlier edges gave: (node, comp), both in one component.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    if labels is not None:  # known components are edges to their least node
        known = labels.where(F.col("node") != F.col("comp"))
        both = both.unionByName(known.select("node", F.col("comp").alias("other"))).unionByName(
            known.select(F.col("comp").alias("node"), F.col("node").alias("other")))
    both = materialize(both.distinct(), "edges")
    now = materialize(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("comp")), "labels")
    while True:
        around = (both.join(now.select(F.col("node").alias("other"), F.col("comp").alias("seen")), "other")
                  .groupBy("node").agg(F.min("seen").alias("seen")))
        step = now.join(around, "node").select("node", F.col("comp").alias("was"),
                                               F.least("comp", "seen").alias("comp"))
        far = now.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        nxt = materialize(step.join(far, "comp", "left")
                          .select("node", "was", F.least("comp", F.coalesce("further", "comp")).alias("comp")),
                          "labels")
        moved = nxt.where(F.col("was") != F.col("comp")).limit(1).count()
        now = nxt.select("node", "comp")
        if not moved:
            return now
