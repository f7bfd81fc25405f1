"""Random forests (classification and regression) and their node table.

Training is MLlib's level-wise forest: feature values are binned once
(``max_bins``), every level aggregates per-node histograms across the
partitions, node ids are cached and checkpointed into the shared checkpoint
folder so deep trees (15-20 levels) do not grow the lineage.

MLlib draws bootstrap weights partition by partition, so the rows' layout is
part of the model.  ``fit_forest`` lays them out by a hash of their key (or
content) in ``partitions`` partitions, sorted: the same rows, seed and
parameters give the same forest on any cluster.  Their number follows the
number of rows unless it is given; another number gives another forest.

``max_memory_mb`` bounds the per-task histogram buffer of one pass.  A smaller
one means more passes over the data, and as MLlib draws each pass's feature
subsets as it goes, another forest.

MLlib keeps all trees of a fit in the driver: a tree of depth d has at most
2**(d+1) - 1 nodes (about 2 million at depth 20, some hundred bytes each),
whatever the rows.  A forest of more than ``tree_batch`` trees is therefore
fitted in batches with seeds of their own.  Each batch's nodes go to the node
table in the shared folder before the next one starts, so the driver holds one
batch whatever ``num_trees``; such a forest (``NodeForest``) is its node table.

MLlib's passes and shuffled histograms grow with rows times nodes.  On more than
``MLLIB_ROWS`` rows the forest is fitted by ``pairgrade.operators.grow``
instead, with the same parameters and another draw, and is a ``NodeForest`` too.
Rows are scored by a node table in groups, each of which gets all trees, packed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (
    RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pairgrade.operators.grow import grow_forest
from pairgrade.session import checkpoint_root, scratch_path
from pairgrade.sources.sinks import materialize

# Defaults of the reference experiments.
NUM_TREES = 25
MAX_DEPTH_CLASS = 15
MAX_DEPTH_REG = 20
MAX_BINS = 32
SEED = 123
#: Trees of one fit, all of them in the driver.
TREE_BATCH = 50
#: The least number of partitions, and the rows that one has on average.
PARTITIONS = 8
PARTITION_ROWS = 1 << 17
#: Equal rows that stay together.
COPIES = 1000
#: Training rows that MLlib fits; the least number of partitions beyond, and the rows of one.
MLLIB_ROWS = PARTITIONS * PARTITION_ROWS
GROW_PARTITIONS = 32
GROW_PARTITION_ROWS = 1 << 19
#: Parameters that only MLlib's fit has.
MLLIB_ONLY = {"impurity", "subset", "max_memory_mb", "cache_node_ids", "checkpoint_interval"}
#: Rows that are scored together at most; fewer while there are not SCORE_GROUPS groups.
SCORE_ROWS, SCORE_LEAST, SCORE_GROUPS = 1_000_000, 20_000, 24
#: Rows that go down a tree together.
WALK_ROWS = 1 << 14


@dataclass
class NodeForest:
    """A forest as its node table (the columns of ``forest_nodes``, written)."""

    nodes: DataFrame
    kind: str
    num_trees: int
    features_col: str = "features"
    prediction_col: str = "prediction"


ForestModel = RandomForestClassificationModel | RandomForestRegressionModel | NodeForest


def assemble(df: DataFrame, features: Sequence[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """Pack numeric columns into one vector column (all continuous)."""
    return VectorAssembler(inputCols=list(features), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def slice_features(df: DataFrame, indices: Sequence[int], features: str = "features",
                   out: str = "features_subset") -> DataFrame:
    """Keep only some positions of a feature vector (train on fewer features)."""
    return VectorSlicer(inputCol=features, outputCol=out,
                        indices=list(indices)).transform(df)


def with_class_count(df: DataFrame, label: str, num_classes: int) -> DataFrame:
    """Declare ``num_classes`` classes in the label's ML metadata; without it
    MLlib infers max(label) + 1."""
    meta = {"ml_attr": {"type": "nominal", "name": label, "num_vals": int(num_classes)}}
    return df.withColumn(label, F.col(label).cast("double").alias(label, metadata=meta))


def forest_estimator(kind: str, label: str = "label", features: str = "features",
                     *, num_trees: int = NUM_TREES, max_depth: int | None = None,
                     max_bins: int = MAX_BINS, impurity: str | None = None,
                     subset: str = "auto", seed: int = SEED,
                     min_instances: int = 1, max_memory_mb: int = 256,
                     cache_node_ids: bool = True, checkpoint_interval: int = 10, bootstrap: bool = True,
                     prediction: str = "prediction"):
    common = dict(
        labelCol=label, featuresCol=features, predictionCol=prediction,
        numTrees=num_trees, maxBins=max_bins, featureSubsetStrategy=subset,
        seed=seed, minInstancesPerNode=min_instances, maxMemoryInMB=max_memory_mb,
        cacheNodeIds=cache_node_ids, checkpointInterval=checkpoint_interval, bootstrap=bootstrap,
    )
    if kind == "class":
        return RandomForestClassifier(maxDepth=max_depth or MAX_DEPTH_CLASS,
                                      impurity=impurity or "gini", **common)
    if kind == "reg":
        return RandomForestRegressor(maxDepth=max_depth or MAX_DEPTH_REG,
                                     impurity=impurity or "variance", **common)
    raise ValueError(f"kind must be 'class' or 'reg', not {kind!r}")


def laid_out(train: DataFrame, label: str = "label", features: str = "features",
             partitions: int | None = None, key: Sequence[str] = ()) -> DataFrame:
    """(label, features) of the rows with a label, in a layout that only the
    rows decide.  Without a ``key`` equal rows are counted and dealt out in
    lots, so content that very many rows share is spread."""
    data = train.where(F.col(label).isNotNull())
    if partitions is None:
        partitions = max(PARTITIONS, -(-data.count() // PARTITION_ROWS))
    by = [*key, label, vector_to_array(F.col(features))]
    if key:
        return (data.repartition(partitions, F.xxhash64(*by)).sortWithinPartitions(*by)
                .select(label, features))
    lots = F.least(F.ceil(F.col("__n") / COPIES), F.lit(4 * partitions))
    of_lot = F.expr("__n div __lots + if(__lot < __n % __lots, 1, 0)")
    at = F.when(F.col("__lot") == 0, F.xxhash64(*by)).otherwise(F.xxhash64(*by, "__lot"))
    return (data.groupBy(label, features).agg(F.count("*").alias("__n"))
            .withColumn("__lots", lots)
            .withColumn("__lot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__lots") - 1)))
            .select(label, features, "__lot", of_lot.alias("__copies"))
            .repartition(partitions, at)
            .select(label, features, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__copies"))))
            .sortWithinPartitions(*by).select(label, features))


def fit_forest(train: DataFrame, kind: str, label: str = "label",
               features: str = "features", num_classes: int | None = None,
               partitions: int | None = None, key: Sequence[str] = (), num_trees: int = NUM_TREES,
               tree_batch: int = TREE_BATCH, seed: int = SEED, **params) -> ForestModel:
    """Fit on the rows with a label.  ``key``: columns that tell rows apart;
    without them the content does.  ``partitions``: by default one for each
    ``PARTITION_ROWS`` rows, ``PARTITIONS`` at least.  Up to ``tree_batch``
    trees and ``MLLIB_ROWS`` rows: MLlib's model; more: a ``NodeForest``.  With
    ``partitions``, or one of ``MLLIB_ONLY``, MLlib fits whatever the rows."""
    spark = train.sparkSession
    checkpoint_root(spark)
    if partitions is None:
        rows = train.where(F.col(label).isNotNull()).count()
        if rows > MLLIB_ROWS and not MLLIB_ONLY & params.keys():
            return _grown(train, kind, label, features, num_classes, rows, key, num_trees, seed, **params)
        partitions = max(PARTITIONS, -(-rows // PARTITION_ROWS))
    data = laid_out(train, label, features, partitions, key)
    if kind == "class" and num_classes is not None:
        data = with_class_count(data, label, num_classes)
    fit = lambda n, own: forest_estimator(kind, label, features, num_trees=n, seed=own, **params).fit(data)
    if num_trees <= tree_batch:
        return fit(num_trees, seed)
    data = data.persist()
    batches = []
    try:
        for first in range(0, num_trees, tree_batch):
            nodes = forest_nodes(fit(min(tree_batch, num_trees - first), seed + first), spark)
            batches.append(nodes.withColumn("tree_id", F.col("tree_id") + first))
    finally:
        data.unpersist()
    table = batches[0]
    for other in batches[1:]:
        table = table.unionByName(other)
    return NodeForest(materialize(table, "forest-nodes"), kind, num_trees, features,
                      params.get("prediction", "prediction"))


def _grown(train: DataFrame, kind: str, label: str, features: str, num_classes: int | None, rows: int,
           key: Sequence[str], num_trees: int, seed: int, max_depth: int | None = None, max_bins: int = MAX_BINS,
           min_instances: int = 1, bootstrap: bool = True, prediction: str = "prediction") -> NodeForest:
    forest_estimator(kind, label, features, num_trees=num_trees, max_depth=max_depth, max_bins=max_bins,
                     min_instances=min_instances)  # its checks of the parameters
    labelled = train.where(F.col(label).isNotNull())
    if kind == "class":
        low, high, whole = labelled.agg(F.min(label), F.max(label), F.bool_and(F.col(label) % 1 == 0)).first()
        num_classes = num_classes or int(high) + 1
        if low < 0 or high >= num_classes or not whole:
            raise ValueError(f"labels must be whole numbers from 0 to {num_classes - 1}, not {low} to {high}")
    width = labelled.select(F.size(vector_to_array(F.col(features)))).first()[0]
    data = laid_out(train, label, features, max(GROW_PARTITIONS, -(-rows // GROW_PARTITION_ROWS)), key)
    nodes = grow_forest(data, kind, label, features, rows, width, num_trees=num_trees, seed=seed, max_bins=max_bins,
                        max_depth=max_depth or (MAX_DEPTH_CLASS if kind == "class" else MAX_DEPTH_REG),
                        min_instances=min_instances, num_classes=num_classes or 0, bootstrap=bootstrap)
    return NodeForest(nodes, kind, num_trees, features, prediction)


def score_forest(model: ForestModel, df: DataFrame) -> DataFrame:
    """All columns of ``df`` plus ``prediction`` (and class scores, if the model
    is MLlib's)."""
    if isinstance(model, NodeForest):
        return score_nodes(model.nodes, df, model.kind, model.features_col, model.prediction_col)
    return model.transform(df)


def forest_nodes(model: ForestModel, spark: SparkSession | None = None) -> DataFrame:
    """One row per tree node, read from the model as MLlib stores it.

    The model is saved into the shared checkpoint folder and its node table
    read back, so the structure never passes through the driver as text.
    Columns: tree_id, node_id, is_leaf, feature (-1 for a leaf), threshold
    (go left when feature <= threshold), left_child, right_child,
    prediction, impurity, gain, count, stats (a class's weights; of a regression
    count, sum and sum of squares)."""
    if isinstance(model, NodeForest):
        return model.nodes
    spark = spark or SparkSession.getActiveSession()
    path = scratch_path(spark, "forest")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    d = F.col("nodeData")
    leaf = d["leftChild"] < 0
    return nodes.select(
        F.col("treeID").alias("tree_id"),
        d["id"].alias("node_id"),
        leaf.alias("is_leaf"),
        F.when(leaf, F.lit(-1)).otherwise(d["split"]["featureIndex"]).alias("feature"),
        F.when(leaf, F.lit(None).cast("double"))
         .otherwise(F.element_at(d["split"]["leftCategoriesOrThreshold"], 1)).alias("threshold"),
        d["leftChild"].alias("left_child"),
        d["rightChild"].alias("right_child"),
        d["prediction"].alias("prediction"),
        d["impurity"].alias("impurity"),
        d["gain"].alias("gain"),
        d["rawCount"].alias("count"),
        d["impurityStats"].alias("stats"),
    )


def _in_levels(ids: np.ndarray, children: np.ndarray) -> list[np.ndarray]:
    """Places of a tree's nodes (``ids`` rise) by level, a node's children side by side."""
    level, levels = np.zeros(1, np.int64), []
    while len(level):
        levels.append(np.searchsorted(ids, level))
        below = children[levels[-1]].ravel()
        level = below[below >= 0]
    return levels


def _tree(tree: pa.Table) -> tuple[pa.Table, list[np.ndarray]]:
    tree = tree.sort_by("node_id")
    children = np.stack([tree["left_child"].to_numpy(), tree["right_child"].to_numpy()], axis=1)
    return tree, _in_levels(tree["node_id"].to_numpy(), children)


def tree_depth(nodes: DataFrame) -> int:
    """Levels below the roots.  One task follows the children of one tree, which
    has at most 2**(d+1) - 1 nodes."""
    return (nodes.select("tree_id", "node_id", "left_child", "right_child").groupBy("tree_id")
            .applyInArrow(lambda tree: pa.table({"depth": pa.array([len(_tree(tree)[1]) - 1], pa.int32())}), "depth int")
            .agg(F.max("depth").alias("d")).first().d)


_PACKED = "tree int, feature binary, known binary, at binary, votes binary"


def _packed(tree: pa.Table) -> pa.Table:
    """One tree in a row: features of its nodes by level (-1: a leaf), the
    thresholds that occur, their places for the inner nodes, and the leaves' votes.
    The n-th inner node's children are the nodes 2n + 1 and 2n + 2."""
    number = tree["tree_id"][0].as_py()
    tree, levels = _tree(tree)
    order = np.concatenate(levels)
    feature = tree["feature"].to_numpy()[order]
    inner = feature >= 0
    known, at = np.unique(tree["threshold"].to_numpy()[order][inner].astype(float), return_inverse=True)
    votes = tree["votes"].combine_chunks()
    votes = votes.flatten().to_numpy().reshape(len(feature), -1)[order][~inner]
    return pa.table({"tree": pa.array([number], pa.int32()), "feature": [feature.astype(np.int16).tobytes()],
                     "known": [known.tobytes()], "at": [at.astype(np.uint16 if len(known) < 1 << 16 else np.int32).tobytes()],
                     "votes": [votes.tobytes()]})


def _cast_votes(x: np.ndarray, tree: dict) -> np.ndarray:
    """The votes of a packed tree for each row of ``x``.  A leaf leads to itself, so
    rows go down together, as many as a processor's cache holds."""
    feature, known = np.frombuffer(tree["feature"], np.int16), np.frombuffer(tree["known"])
    inner = feature >= 0
    leaf = np.cumsum(~inner, dtype=np.int32) - 1
    bound, right = np.full(len(feature), np.inf), np.arange(1, len(feature) + 1)
    bound[inner] = known[np.frombuffer(tree["at"], np.uint16 if len(known) < 1 << 16 else np.int32)]
    right[inner] = 2 * np.arange(1, inner.sum() + 1)
    votes = np.frombuffer(tree["votes"]).reshape(leaf[-1] + 1, -1)
    depth, first, size = 0, 0, 1
    while below := int(np.count_nonzero(inner[first:first + size])):
        depth, first, size = depth + 1, first + size, 2 * below
    feature, out = np.where(inner, feature, 0), np.empty((len(x), votes.shape[1]))
    for start in range(0, len(x), WALK_ROWS):
        own = x[start:start + WALK_ROWS]
        flat, base = np.where(np.isnan(own), np.inf, own).reshape(-1), np.arange(len(own)) * x.shape[1]  # NaN goes right
        node = np.zeros(len(own), np.int64)
        for _ in range(depth):
            node = right.take(node) - (flat.take(base + feature.take(node)) <= bound.take(node))
        out[start:start + WALK_ROWS] = votes[leaf[node]]
    return out


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(a row of each kind of equal rows, each row's kind) where that is less than
    half of the rows."""
    head = x[:4096]
    if not x.shape[1] or max(len(np.unique(head[:, f])) for f in range(x.shape[1])) > len(head) * 3 / 4:
        return None
    code, wide = np.zeros(len(x), np.int64), 1
    for f in range(x.shape[1]):
        found, at = np.unique(x[:, f], return_inverse=True)
        wide *= len(found)
        if wide >= 1 << 62:
            return None
        code = code * len(found) + at
    _, first, kind = np.unique(code, return_index=True, return_inverse=True)
    return (first, kind) if 2 * len(first) <= len(x) else None


def score_nodes(nodes: DataFrame, df: DataFrame, kind: str, features: str = "features",
                prediction: str = "prediction") -> DataFrame:
    """All columns of ``df`` plus the prediction of a node table, the same as
    MLlib's of the model that the table is of.

    The rows are dealt into groups of at most about ``SCORE_ROWS``, each of which
    gets all trees, packed by one task a tree; the trees' votes are added up in
    their order: the sum of the leaves' class shares, the least class of the
    largest; of a regression the mean.  Where a group has many equal rows, one of
    each kind goes down the trees.  Vectors come back dense."""
    groups = df.count()
    groups = max(1, min(SCORE_GROUPS, -(-groups // SCORE_LEAST)), -(-groups // SCORE_ROWS))
    weight = F.aggregate("stats", F.lit(0.0), lambda acc, v: acc + v)
    votes = F.transform("stats", lambda v: F.when(weight != 0, v / weight).otherwise(0.0)) if kind == "class" \
        else F.array("prediction")
    trees = (nodes.select("tree_id", "node_id", "feature", "threshold", "left_child", "right_child", votes.alias("votes"))
             .groupBy("tree_id").applyInArrow(_packed, _PACKED)
             .withColumn("__group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    vectors = [f.name for f in df.schema if isinstance(f.dataType, VectorUDT)]
    own = [vector_to_array(F.col(f"`{c}`")).alias(c) if c in vectors else F.col(f"`{c}`") for c in df.columns]
    rows = df.select(*own, F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("int").alias("__group"))
    fields = rows.schema.fields[:-1]

    def run(rows: pa.Table, trees: pa.Table) -> pa.Table:
        order = np.argsort(trees["tree"].to_numpy())
        x = rows[features].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1) if rows.num_rows else None
        total, alike = 0.0, None if x is None else _distinct(x)
        x = x if alike is None else x[alike[0]]
        for n in order if rows.num_rows else ():
            total = total + _cast_votes(x, {c: trees[c][int(n)].as_py() for c in trees.column_names})
        found = np.zeros(0) if x is None else total.argmax(axis=1).astype(float) if kind == "class" \
            else total[:, 0] / len(order)
        found = found if alike is None else found[alike[1]]
        return rows.drop_columns(["__group"]).append_column(prediction, pa.array(found, pa.float64()))

    scored = rows.groupBy("__group").cogroup(trees.groupBy("__group")).applyInArrow(
        run, StructType([*fields, StructField(prediction, DoubleType())]))
    back = [array_to_vector(F.col(f"`{c}`")).alias(c) if c in vectors else F.col(f"`{c}`") for c in df.columns]
    return scored.select(*back, prediction)
