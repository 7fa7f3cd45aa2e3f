"""Relational scoring of fitted tree ensembles (ML2): the nodes as a table, and the walk down over that table.

A saved ensemble keeps its nodes as rows. ``node_table`` gives them in a plain form that any SQL engine can
walk; ``score_with_trees`` scores rows by it without a model object, and ``leaves_by_joins`` gives the leaf of every row in every
tree. Both look up a batch of rows at once, level by level, in the node table that every task holds (``_Table``; as large as
the model and independent of the data); an ensemble too large for that is walked by one join per level.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import fraud_flag, high_risk_flag
from ..session import let_workers_import, scratch_path
from .features import vector_nonzeros


def node_table(spark: SparkSession, model) -> DataFrame:
    """One row per node of a fitted ensemble: tree, weight, node (0 = root), left, right (-1 for a leaf), feature,
    threshold (left if value <= threshold), categories (left if the value is among them; null for a
    continuous feature), prediction, and class_counts of the node's training rows."""
    path = scratch_path(spark, "ensemble")
    model.write().save(path)
    n = F.col("nodeData")
    continuous = n["split"]["numCategories"] == -1
    values = n["split"]["leftCategoriesOrThreshold"]
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"), F.when(continuous, F.get(values, F.lit(0))).alias("threshold"),
        F.when((n["leftChild"] >= 0) & ~continuous, values).alias("categories"), n["prediction"].alias("prediction"),
        n["impurityStats"].alias("class_counts"))
    weights = spark.createDataFrame([(k, float(w)) for k, w in enumerate(model.treeWeights)], "tree int, weight double")
    return nodes.join(F.broadcast(weights), "tree")  # one row per tree


#: Values of one dense block of rows that a walk looks up (8 bytes each).
BLOCK_VALUES = 1 << 20


class _Table:
    """The node table as arrays, sorted by (tree, node). A leaf is its own child, so a walk that has ended stays."""

    def __init__(self, nodes: DataFrame):
        let_workers_import(nodes.sparkSession)
        of = ["tree", "node", "left", "right", "feature", "threshold", "categories", "prediction", "class_counts", "weight"]
        t = nodes.select(*of).orderBy("tree", "node").toArrow()
        col = {c: t[c].combine_chunks() for c in of[:6] + of[7:8] + of[9:]}
        tree, self.node, left, right = (col[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in of[:4])
        self.roots = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if len(tree) else np.zeros(0, np.int64)
        key, own = (tree << 32) + self.node, np.arange(len(tree))
        at = lambda child: np.where(left < 0, own, np.searchsorted(key, (tree << 32) + child))
        self.children = np.stack([at(right), at(left)], axis=1).astype(np.int32).ravel()  # 2 * place + whether it goes left
        self.depth = self._depth()
        inner = left >= 0
        feature = np.where(inner, col["feature"].to_numpy(zero_copy_only=False), -1)
        self.features = np.unique(feature[inner]).astype(np.int64)  # those that some split asks for
        self.feature = np.where(inner, np.searchsorted(self.features, feature), 0).astype(np.int32)
        self.threshold = col["threshold"].fill_null(np.nan).to_numpy(zero_copy_only=False)
        sets = t["categories"].combine_chunks()
        chosen = np.flatnonzero(~np.asarray(sets.is_null()))
        width = 1 + int(max((max(sets[int(i)].as_py(), default=0) for i in chosen), default=-1))
        self.category_row = np.full(len(tree), -1, np.int32)
        self.category_row[chosen] = np.arange(len(chosen))
        self.goes_left = np.zeros((len(chosen), width + 1), bool)  # the last column is of any other value
        for k, i in enumerate(chosen):
            self.goes_left[k, np.asarray(sets[int(i)].as_py(), int)] = True
        self.prediction = col["prediction"].to_numpy(zero_copy_only=False)
        self.weight = col["weight"].to_numpy(zero_copy_only=False)
        self.class_counts = t["class_counts"].to_pylist()

    def _depth(self) -> int:
        depth, at = 0, self.roots
        while len(at):
            below = self.children.reshape(-1, 2)[at]
            at = below[below[:, 0] != at].ravel()
            depth += len(at) > 0
        return depth

    def dense(self, entries: pa.Array) -> np.ndarray:
        """The values that splits ask for, one line per row; a row without a vector has NaN everywhere and goes right."""
        lengths = entries.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = entries.flatten()
        index, x = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        out = np.zeros((len(entries), max(1, len(self.features))))
        at = np.minimum(np.searchsorted(self.features, index), max(0, len(self.features) - 1))
        used = self.features[at] == index if len(self.features) else np.zeros(len(index), bool)
        out[np.repeat(np.arange(len(entries)), lengths)[used], at[used]] = x[used]
        if entries.null_count:
            out[np.asarray(entries.is_null())] = np.nan
        return out

    def leaves(self, entries: pa.Array) -> np.ndarray:
        """Place in the table of the leaf of each row (line) in each tree (column). NaN goes right at a threshold."""
        parts, step = [], max(1, BLOCK_VALUES // max(1, len(self.features)))
        for i in range(0, len(entries), step):
            x = self.dense(entries.slice(i, step))
            first = np.repeat(np.arange(len(x), dtype=np.int64) * x.shape[1], len(self.roots))
            at = np.tile(self.roots.astype(np.int32), len(x))
            x = x.ravel()
            for _ in range(self.depth):
                value = x[first + self.feature[at]]
                left = value <= self.threshold[at]
                if len(self.goes_left):
                    row = self.category_row[at]
                    some = np.flatnonzero(row >= 0)
                    v, last = value[some], self.goes_left.shape[1] - 1
                    known = (v >= 0) & (v < last) & (v == np.floor(v))
                    left[some] = self.goes_left[row[some], np.where(known, v, last).astype(int)]
                at = self.children[2 * at + left]
            parts.append(at.reshape(-1, len(self.roots)))
        return np.concatenate(parts) if parts else np.zeros((0, len(self.roots)), np.int32)


def score_with_trees(df: DataFrame, nodes: DataFrame, model, features: str = "features") -> DataFrame:
    """``df`` with prediction, fraud_probability, predicted_fraud and is_high_risk from a node table.

    Boosted trees add weight * prediction to a margin m with p = 1 / (1 + exp(-2 m)); forests average the class
    shares of their leaves. ``model`` only tells which of the two it is.
    """
    table, boosted = _Table(nodes), isinstance(model, GBTClassificationModel)
    if boosted:
        part = table.weight * table.prediction
    else:
        part = np.array([w * c[1] / sum(c) if len(c) > 1 else np.nan for w, c in zip(table.weight, table.class_counts)])

    @F.arrow_udf("double")
    def total_of(entries: pa.Array) -> pa.Array:
        leaves = table.leaves(entries)
        total = np.zeros(len(leaves))
        for t in range(leaves.shape[1]):  # one after the other, as the model adds them up
            total += part[leaves[:, t]]
        return pa.array(total)

    out = df.withColumn("__sum", total_of(vector_nonzeros(features)))
    if boosted:
        probability, prediction = 1.0 / (1.0 + F.exp(-2.0 * F.col("__sum"))), F.col("__sum") > 0
    else:
        weights = float(sum(model.treeWeights))
        probability, prediction = F.col("__sum") / F.lit(weights), 2 * F.col("__sum") > F.lit(weights)
    out = out.withColumn("prediction", prediction.cast("double")).withColumn("fraud_probability", probability)
    return (out.withColumn("predicted_fraud", fraud_flag("prediction")).withColumn("is_high_risk", high_risk_flag("fraud_probability"))
            .drop("__sum"))


#: Nodes of an ensemble that may be broadcast to the rows (a node takes about 100 bytes).
BROADCAST_NODES = 1_000_000


def leaves_by_joins(df: DataFrame, nodes: DataFrame, model, key: str, features: str = "features") -> DataFrame:
    """(key, tree, weight, prediction, class_counts, class_total) of the leaf that each row reaches in each tree.

    Up to ``BROADCAST_NODES`` nodes, counted by the model, every task holds the node table and looks a batch of rows up in
    it, one level at a time for all trees; the row then has the numbers of its leaves, which one join turns into the leaves.
    Beyond that the walk is one equi join with the node table per level, left to Spark. A value of NaN goes right at a
    threshold, as in ``score_with_trees``.
    """
    ends = nodes.filter("left < 0").select("tree", F.col("node").alias("at"), "weight", "prediction", "class_counts",
                                           F.aggregate("class_counts", F.lit(0.0), lambda s, c: s + c).alias("class_total"))
    if model.totalNumNodes <= BROADCAST_NODES:
        table = _Table(nodes)

        @F.arrow_udf("array<int>")
        def leaf_numbers(entries: pa.Array) -> pa.Array:
            leaves = table.leaves(entries)
            ends_at = np.arange(len(leaves) + 1, dtype=np.int32) * leaves.shape[1]
            return pa.ListArray.from_arrays(pa.array(ends_at, pa.int32()), pa.array(table.node[leaves.ravel()], pa.int32()))

        walk = df.select(key, F.posexplode(leaf_numbers(vector_nonzeros(features))).alias("tree", "at"))
        ends = F.broadcast(ends)
    else:
        walk = _walk_by_joins(df, nodes, model, key, features)
    return walk.join(ends, ["tree", "at"]).select(key, "tree", "weight", "prediction", "class_counts", "class_total")


def _walk_by_joins(df: DataFrame, nodes: DataFrame, model, key: str, features: str) -> DataFrame:
    """(key, tree, at): a row goes through the joins once per tree, so it carries the non-zeros of its vector only, and looks
    a value up by a higher-order function: that ends the generated code of a level, which for all levels in one would
    be more than the JVM compiles."""
    depth = max((t.depth for t in model.trees), default=0)
    step = nodes.filter("left >= 0").select("tree", F.col("node").alias("at"), "left", "right", "feature", "threshold", "categories")
    walk = df.select(key, vector_nonzeros(features).alias("entries"),
                     F.explode(F.sequence(F.lit(0), F.lit(len(model.trees) - 1))).alias("tree"), F.lit(0).alias("at"))
    for _ in range(depth):
        value = F.aggregate("entries", F.lit(0.0), lambda x, e: F.when(e["i"] == F.col("feature"), e["x"]).otherwise(x))
        goes_left = F.when(F.col("categories").isNull(), value <= F.col("threshold")).otherwise(F.array_contains("categories", value))
        # a row that has reached a leaf finds no inner node and stays
        walk = walk.join(step, ["tree", "at"], "left").select(
            key, "entries", "tree", F.when(F.col("left").isNull(), F.col("at")).when(goes_left, F.col("left")).otherwise(F.col("right")).alias("at"))
    return walk.drop("entries")


def forest_probability(leaves: DataFrame, key: str) -> DataFrame:
    """(key, fraud_probability) of a forest: the trees' weighted mean of the share of class 1 in the reached leaf.
    All leaves of a row are in one task, so they are added up before the exchange."""
    share = F.get("class_counts", F.lit(1)) / F.col("class_total")
    return leaves.groupBy(key).agg((F.sum(F.col("weight") * share) / F.sum("weight")).alias("fraud_probability"))
