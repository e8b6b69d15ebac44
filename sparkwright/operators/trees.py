"""Fitted trees as a relational node table, and what follows from it.

``node_table`` turns a fitted tree or forest into rows (tree, node, parent, depth, split, class counts, impurity, the
bounds of the path). On that table the split minimum is a filter (``collapse``), importances are one aggregate
(``importances``), and a tree becomes an expression that walks it without a join (``walk``). A forest's trees also give
every smaller forest: ``prefix_scores`` scores the first t trees for several t in one pass over the rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkwright.functions.numeric import nan_to_null

NODES = ("tree int, node int, parent int, depth int, feature int, threshold double, left int, right int, leaf int, impurity double, "
         "gain double, rows long, counts array<double>, lo array<double>, hi array<double>")
LARGEST_CASE = 128         # nodes up to which a tree is written as nested CASE; larger ones walk arrays


def _with_paths(nodes: pd.DataFrame, features: int) -> pd.DataFrame:
    """Adds parent, depth, leaf number and path bounds to one tree's nodes (numbered in preorder)."""
    nodes = nodes.sort_values("node").reset_index(drop=True)
    n = len(nodes)
    parent, depth = np.full(n, -1), np.zeros(n, int)
    lo, hi = np.full((n, features), -np.inf), np.full((n, features), np.inf)
    left, right, feature, threshold = (nodes[c].to_numpy() for c in ("left", "right", "feature", "threshold"))
    for i in range(n):                         # parents come before children
        if left[i] >= 0:
            for child in (left[i], right[i]):
                parent[child], depth[child], lo[child], hi[child] = i, depth[i] + 1, lo[i], hi[i]
            hi[left[i], feature[i]] = min(hi[i, feature[i]], threshold[i])
            lo[right[i], feature[i]] = max(lo[i, feature[i]], threshold[i])
    is_leaf = left < 0
    nodes["parent"], nodes["depth"] = parent, depth
    nodes["leaf"] = np.where(is_leaf, np.cumsum(is_leaf) - 1, -1)
    nodes["lo"], nodes["hi"] = list(lo), list(hi)
    return nodes


def impurity_of(counts: Column, kind: str) -> Column:
    """Gini index or entropy (in bits) of class counts; 0 without rows. The saved form lacks it for some leaves."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    share = lambda c: F.when(total > 0, c / total).otherwise(F.lit(0.0))
    if kind == "gini":
        return F.when(total > 0, F.lit(1.0) - F.aggregate(counts, F.lit(0.0), lambda a, c: a + share(c) * share(c))).otherwise(F.lit(0.0))
    return F.aggregate(counts, F.lit(0.0), lambda a, c: a - F.when(c > 0, share(c) * F.log2(share(c))).otherwise(F.lit(0.0)))


def _saved_nodes(model, spark: SparkSession) -> DataFrame:
    """The nodes of a fitted tree or forest as its saved form has them: a table, read tree by tree."""
    from sparkwright.operators.models import save_model
    data = spark.read.parquet(f"{save_model(model, spark, 'nodes')}/data")
    if "nodeData" in data.columns:
        return data.select(F.col("treeID").alias("tree"), "nodeData.*")
    return data.withColumn("tree", F.lit(0))


def node_table(model, spark: SparkSession) -> DataFrame:
    """One row per node of a fitted tree or forest (splits on numbers only).

    A node's rows satisfy lo[f] < x[f] <= hi[f] for every feature f; left takes x[feature] <= threshold. ``leaf`` numbers
    a tree's leaves as the model's leaf column does (-1: inner node); ``rows`` and ``counts`` are the node's training rows
    and weighted class counts."""
    data = _saved_nodes(model, spark)
    split = F.col("split")
    flat = data.select(
        "tree", F.col("id").alias("node"), F.when(F.col("leftChild") >= 0, split["featureIndex"]).otherwise(-1).alias("feature"),
        F.when(F.col("leftChild") < 0, F.lit(None)).when(split["numCategories"] >= 0, F.raise_error(F.lit("only splits on numbers")))
        .otherwise(F.get(split["leftCategoriesOrThreshold"], 0)).cast("double").alias("threshold"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        impurity_of(F.col("impurityStats"), model.getImpurity()).alias("impurity"), "gain", F.col("rawCount").alias("rows"),
        F.col("impurityStats").alias("counts"))
    features = model.numFeatures
    columns = [c.split()[0] for c in NODES.split(", ")]
    return flat.groupBy("tree").applyInPandas(lambda t: _with_paths(t, features)[columns], NODES)


def collapse(nodes: DataFrame, min_split: int) -> DataFrame:
    """The table of the trees in which no node of fewer than min_split rows is split.

    A node's rows only shrink on the way down, so a node stays if its parent has enough rows, and a split node
    that has not becomes a leaf: growing first and collapsing from the top gives the tree grown under that rule. Leaves
    have no number in the result (``leaf`` is null)."""
    parents = nodes.select(F.col("tree").alias("__tree"), F.col("node").alias("__node"), F.col("rows").alias("__rows"))
    kept = nodes.join(parents, (F.col("tree") == F.col("__tree")) & (F.col("parent") == F.col("__node")), "left") \
        .where((F.col("parent") < 0) | (F.col("__rows") >= min_split)).drop("__tree", "__node", "__rows")
    cut = (F.col("left") >= 0) & (F.col("rows") < min_split)
    return kept.select(*[{"feature": F.when(cut, -1).otherwise(F.col("feature")), "threshold": F.when(~cut, F.col("threshold")),
                          "left": F.when(cut, -1).otherwise(F.col("left")), "right": F.when(cut, -1).otherwise(F.col("right")),
                          "gain": F.when(cut, -1.0).otherwise(F.col("gain")), "leaf": F.lit(None).cast("int")}.get(c, F.col(c)).alias(c)
                         for c in nodes.columns])


def importances(nodes: DataFrame) -> DataFrame:
    """feature (index), importance: impurity decrease gain * weighted rows summed over a tree's splits, normalised per tree,
    averaged over the trees and normalised again; features that never split are not listed."""
    weight = F.aggregate("counts", F.lit(0.0), lambda a, b: a + b)
    per_tree = nodes.where(F.col("left") >= 0).groupBy("tree", "feature").agg(F.sum(F.col("gain") * weight).alias("__g"))
    # a table of trees x features
    total = per_tree.groupBy("tree").agg(F.sum("__g").alias("__t"))
    share = per_tree.join(total, "tree").where(F.col("__t") > 0).groupBy("feature").agg(F.sum(F.col("__g") / F.col("__t")).alias("__s"))
    return share.crossJoin(F.broadcast(share.agg(F.sum("__s").alias("__all")))).select("feature", (F.col("__s") / F.col("__all")).alias("importance"))


def _numbers(values, kind: str) -> Column:
    """A constant array: one literal after constant folding, however long."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def walk(nodes: list, inputs: list[Column], values: dict) -> Column:
    """The number that ``values`` gives for the leaf a row reaches in one tree, without a join.

    nodes: that tree's rows of the node table; values: node -> number (double). Small trees are nested CASE expressions;
    larger ones step through constant arrays, one step per level. A missing input goes right, as NaN does in the fitted model."""
    table = {r["node"]: r for r in nodes}
    x = [F.coalesce(nan_to_null(c.cast("double")), F.lit(float("nan"))) for c in inputs]   # NaN is above every number
    if len(table) <= LARGEST_CASE:
        def step(node):
            r = table[node]
            if r["left"] < 0:
                return F.lit(float(values[node]))
            return F.when(x[r["feature"]] <= F.lit(float(r["threshold"])), step(r["left"])).otherwise(step(r["right"]))
        return step(0)
    order = sorted(table)
    place = {node: i for i, node in enumerate(order)}
    column = lambda name, other: [table[n][name] if table[n]["left"] >= 0 else other for n in order]
    feature, threshold = _numbers(column("feature", 0), "int"), _numbers(column("threshold", 0.0), "double")
    left = _numbers([place.get(v, -1) for v in column("left", -1)], "int")
    right = _numbers([place.get(v, -1) for v in column("right", -1)], "int")
    depth, row = max(r["depth"] for r in nodes), F.array(*x)
    at = lambda a, i: F.element_at(a, i + 1)
    end = F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), F.lit(0), lambda i, _: F.when(at(left, i) < 0, i).when(
        at(row, at(feature, i)) <= at(threshold, i), at(left, i)).otherwise(at(right, i)))
    return F.element_at(_numbers([values.get(n, 0.0) for n in order], "double"), end + 1)


def leaf_shares(nodes: list) -> dict:
    """node -> share of class 1 among the leaf's training rows."""
    return {r["node"]: (r["counts"][1] / sum(r["counts"]) if sum(r["counts"]) else 0.0) for r in nodes if r["left"] < 0}


def _leaf_shares_at(model, spark: SparkSession, depths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(first leaf of every tree, leaves x depths): the share of class 1 in a leaf's ancestor at every depth limit (in the
    leaf itself, if it is not deeper). The forest's nodes come to the driver, where the fitted forest itself lies."""
    nodes = _saved_nodes(model, spark).select("tree", "id", "leftChild", "rightChild", F.get("impurityStats", 0).alias("n0"),
                                              F.get("impurityStats", 1).alias("n1")).toArrow()
    tree, node, left, right, n0, n1 = (np.asarray(c) for c in nodes.columns)
    order = np.lexsort((node, tree))
    tree, left, right, n0, n1 = (c[order] for c in (tree, left, right, n0, n1))
    root = np.searchsorted(tree, np.arange(tree.max() + 1))
    total, leaf = n0 + n1, left < 0
    own = np.divide(n1, total, out=np.zeros(len(total)), where=total > 0)
    at, limits = np.repeat(own[:, None], len(depths), axis=1), np.array(depths)
    level, depth = root, 0
    while len(level):                          # children go by their number inside the tree
        depth += 1
        inner = level[~leaf[level]]
        base = root[tree[inner]]
        for child in (left[inner] + base, right[inner] + base):
            at[child] = np.where(depth > limits, at[inner], at[child])
        level = np.concatenate([left[inner] + base, right[inner] + base])
    return np.searchsorted(tree[leaf], np.arange(tree.max() + 1)), at[leaf]


def prefix_scores(model: PipelineModel, df: DataFrame, sizes: list[int], keep: list[str], depths: list[int] | None = None) -> DataFrame:
    """keep, trees, depth, score: P(1) by the first t trees of the pipeline's forest, cut at each depth, from one pass.

    The first t trees of a forest are a forest of t trees, and a tree cut at depth d (nodes at depth d are leaves with
    their own class counts) is a tree grown to depth d: no split above looks at what is below. The model tells each row's leaf
    in every tree; the class shares of the leaf's ancestor at each depth, a table of the forest's size, are broadcast,
    and the running sum over the trees gives every size. All trees at full depth score as the model itself does."""
    spark, forest = df.sparkSession, model.stages[-1]
    deepest = forest.getOrDefault("maxDepth")
    depths = sorted(depths or [deepest])
    first, shares = _leaf_shares_at(forest, spark, depths)
    sent = spark.sparkContext.broadcast((first, shares))
    wanted = np.array(sorted(sizes))
    if wanted[-1] > len(first) or wanted[0] < 1:
        raise ValueError(f"the forest has {len(first)} trees")
    if depths[-1] > deepest:
        raise ValueError(f"the forest was grown to depth {deepest}")

    placed = forest.copy().setLeafCol("__leaf")
    rows = df
    for stage in model.stages[:-1]:
        rows = stage.transform(rows)
    rows = placed.transform(rows).select(*keep, vector_to_array("__leaf").alias("__leaf"))
    points = len(wanted) * len(depths)

    def run(batches):
        begin, table = sent.value
        for batch in batches:
            at = batch.column("__leaf").flatten().to_numpy().reshape(-1, len(begin)).astype(np.int64) + begin
            sums = [np.cumsum(table[at, d], axis=1)[:, wanted - 1] / wanted for d in range(len(depths))]
            rest = [batch.column(c).take(pa.array(np.repeat(np.arange(batch.num_rows), points))) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(np.tile(np.tile(wanted, len(depths)), batch.num_rows).astype(np.int32)),
                 pa.array(np.tile(np.repeat(depths, len(wanted)), batch.num_rows).astype(np.int32)), pa.array(np.hstack(sums).ravel())],
                names=[*keep, "trees", "depth", "score"])

    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{kept}, trees int, depth int, score double")
