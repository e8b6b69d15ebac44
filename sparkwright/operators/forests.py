"""Forests and boosted trees grown on cells instead of rows.

A tree sees a number only through the candidate thresholds of its feature: rows that fall between the same thresholds in
every feature and have the same label are one cell with a count. ``cell_table`` counts them in one pass; without equal
rows it has as many cells as the input has rows, and what follows is as large as before. ``grow_forest`` draws each
tree's bootstrap weights per cell (a sum of n Poisson(1) draws is one Poisson(n) draw, hashed from cell, tree and seed)
and grows all trees a level at a time: tasks add up class counts per (tree, node, feature, bin), blocks of nodes are
combined and split in parallel, and only the chosen splits, which are the forest, come to the driver. Boosting has no
bootstrap, so Spark's own fit on weighted cells is the fit on the rows. Both end as Spark models with the real thresholds.

Up to FINISH_CELLS cells are broadcast and every task grows whole trees from them, so nothing is shuffled; the trees are those
that the passes by level would grow. With more cells, ``grow_forest`` makes a pass per level, and ``grow_deep``, for which that
would be too many, only while a node has more than FINISH_CELLS drawn cells: the cells of smaller nodes are shuffled by (tree, node)
and each such subtree is grown to its end in one task. ``grid_scores`` grows the trees of a search and scores the first t of them at
several depths in the tasks that grow them; beyond the bound ``prefix_scores_of_cells`` does it in a pass of its own.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkwright.session import ensure_checkpoint_dir, stored

ACCURACY = 10_000          # candidate thresholds of a feature with many values: quantiles with this rank error
CELLS_AT_ONCE = 250_000    # cells of one partition
BLOCK = 64                 # nodes whose counts are combined and split together
FINISH_CELLS = 1_500_000   # drawn cells of a node whose subtree one task grows, cells that are broadcast (about 25 bytes each, 100 in the task)
TREES_AT_ONCE = 25         # trees of a search that one task grows and scores
SCORES_AT_ONCE = 1 << 18   # held-out cells whose sums over the tasks are added together
COUNTS_AT_ONCE = 1 << 20   # (node, bin) pairs of a feature that such a task counts together
APART = 1500              # cells of an open node, on average, from which each node is counted by itself
WALKS_AT_ONCE = 1 << 15    # cells that walk a tree together, so that they stay in the processor's cache
_NODE = ("struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,leftChild:int,"
         "rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")


# ---------------------------------------------------------------- cells
def thresholds(rows: DataFrame, features: int, max_bins: int) -> list[np.ndarray]:
    """Candidate thresholds per feature of the array column ``x``: all midpoints of a feature with at most max_bins values,
    else max_bins - 1 quantiles of all rows. A missing value (NaN) is above all of them."""
    def few(batches):
        seen = [set() for _ in range(features)]
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, features)
            for f, s in enumerate(seen):
                if len(s) <= max_bins:
                    s.update(v for v in np.unique(x[:, f]).tolist() if v == v)
        for f, s in enumerate(seen):       # too many values: one row without a value
            values = sorted(s) if len(s) <= max_bins else [None]
            yield pa.RecordBatch.from_arrays([pa.array([f] * len(values), pa.int32()), pa.array(values, pa.float64())], names=["f", "v"])

    values = {f: set() for f in range(features)}
    for r in rows.select("x").mapInArrow(few, "f int, v double").distinct().collect():
        values[r["f"]].add(r["v"])
    many = [f for f, v in values.items() if None in v or len(v) > max_bins]
    out = [np.array([]) if f in many or not v else (lambda s: (s[1:] + s[:-1]) / 2)(np.array(sorted(v))) for f, v in values.items()]
    if many:
        marks = [i / max_bins for i in range(1, max_bins)]
        number = lambda f: F.when(~F.isnan(F.col("x")[f]), F.col("x")[f])
        found = rows.agg(*[F.percentile_approx(number(f), marks, ACCURACY).alias(f"q{f}") for f in many]).first()
        for f in many:
            out[f] = np.unique(found[f"q{f}"])
    return out


def cell_table(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """(bins, y, n): how many rows (array column ``x``, label ``y``) fall into each combination of bins; one byte a bin."""
    features = len(edges)

    def place(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, features)
            b = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1).astype(np.uint8)
            fixed = pa.Array.from_buffers(pa.binary(features), len(b), [None, pa.py_buffer(b.tobytes())])
            yield pa.RecordBatch.from_arrays([fixed.cast(pa.binary()), batch.column("y")], names=["bins", "y"])

    counted = rows.select("x", "y").mapInArrow(place, "bins binary, y double").groupBy("bins", "y").agg(F.count(F.lit(1)).alias("n"))
    return stored(counted.withColumn("k", F.xxhash64("bins", "y")), "cells")


def number_rows(df: DataFrame, features: str, label: str, columns: list[str] | None = None) -> DataFrame:
    """The array column ``x`` and the label ``y``; ``columns`` are those that the vector was assembled from (missing: NaN) and
    spare its decoding."""
    nan = F.lit(float("nan"))
    x = F.array(*[F.coalesce(F.col(c).cast("double"), nan) for c in columns]) if columns else vector_to_array(features)
    return df.select(x.alias("x"), F.col(label).cast("double").alias("y"))


def _cells_of(df: DataFrame, features: str, label: str, max_bins: int, columns: list[str] | None = None) -> tuple[DataFrame, list[np.ndarray]]:
    if max_bins > 256:
        raise ValueError("at most 256 bins")
    rows = number_rows(df, features, label, columns)
    first = rows.select(F.size("x")).first()
    if first is None:
        raise ValueError("no rows to fit")
    edges = thresholds(rows, first[0], max_bins)
    cells = cell_table(rows, edges)
    if cells.where(F.col("y").isNull() | ~F.col("y").isin(0.0, 1.0)).limit(1).count():
        raise ValueError("labels are 0 and 1")
    return cells, edges


def _bins_of(column: pa.Array, features: int) -> np.ndarray:
    """Cells x features of a column of bins."""
    first = np.frombuffer(column.buffers()[1], np.int32)[column.offset] if len(column) else 0
    flat = np.frombuffer(column.buffers()[2], np.uint8)[first:first + features * len(column)] if len(column) else np.zeros(0, np.uint8)
    return flat.reshape(-1, features)


def _on_driver(cells: DataFrame, features: int) -> tuple:
    """(bins, labels, rows, keys) of a bounded number of cells, those of few rows first."""
    table = cells.select("bins", "y", "n", "k").toArrow()
    column = lambda c: table.column(c).to_numpy()
    x = np.concatenate([np.zeros((0, features), np.uint8), *[_bins_of(chunk.cast(pa.binary()), features) for chunk in table.column("bins").chunks]])
    order = np.argsort(column("n"), kind="stable")
    return x[order], column("y")[order].astype(np.uint8), column("n")[order], column("k")[order].view(np.uint64)


# ---------------------------------------------------------------- forest
def _poisson_cdf(n: int) -> tuple[int, np.ndarray]:
    """(least value, cumulative probabilities from it on) of Poisson(n), without the tails below about 1e-20."""
    low, high = max(0, int(n - 10 * n ** 0.5 - 10)), int(n + 10 * n ** 0.5 + 25)
    logs = np.r_[0.0, np.cumsum(np.log(n) - np.log(np.arange(low + 1, high + 1)))]
    p = np.exp(logs - logs.max())
    return low, np.cumsum(p) / p.sum()


def _uniform(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A uniform number per (key, tree, seed): the splitmix64 finaliser twice."""
    def mix(z):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))
    salt = np.array([(tree * 0x9E3779B97F4A7C15 + seed * 0xD1342543DE82EF95 + 1) % 2 ** 64], np.uint64)
    return (mix(mix(keys + salt) + salt) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def bootstrap_counts(keys: np.ndarray, counts: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often the rows of each cell are drawn for a tree: Poisson(count), a function of (key, tree, seed)."""
    u, out = _uniform(keys, tree, seed), np.empty(len(keys))
    rises = np.diff(counts)
    order = None if (rises >= 0).all() else np.argsort(counts, kind="stable")        # cells in memory are sorted
    starts = np.flatnonzero(np.r_[True, (rises if order is None else np.diff(counts[order])) > 0]) if len(counts) else []
    for a, b in zip(starts, [*starts[1:], len(counts)]):
        some = slice(a, b) if order is None else order[a:b]
        low, cdf = _poisson_cdf(int(counts[a] if order is None else counts[order[a]]))
        out[some] = low + np.searchsorted(cdf, u[some], side="right")
    return out


def _counts_of_level(sent, level: int, features: int, bins: int, seed: int):
    """Per (tree, block of open nodes): the weighted class counts per (node, offered feature, bin) of one partition's cells."""
    def run(batches):
        trees = sent.value
        batches = list(batches)            # one partition: at most about CELLS_AT_ONCE small rows
        if not batches:
            return
        column = lambda c: np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in batches])
        x = np.frombuffer(b"".join(v for b in batches for v in b.column("bins").to_pylist()), np.uint8)
        y, n, keys = column("y").astype(np.int64), column("n"), column("k").view(np.uint64)
        order = np.argsort(n, kind="stable")
        x, y, n, keys = x.reshape(-1, features)[order].ravel(), y[order], n[order], keys[order]
        for t, (feature, cut, child, slot, offered) in enumerate(trees):
            if not len(offered):
                continue
            w = bootstrap_counts(keys, n, t, seed)
            at = np.flatnonzero(w)
            node = np.zeros(len(at), np.int64)
            base = at * features
            for _ in range(level):
                node = child[2 * node + (x[base + feature[node]] > cut[node])]
            s = slot[node]
            keep = s >= 0
            s, base, at = s[keep], base[keep], at[keep]
            if not len(s):
                continue
            m, yy, ww = offered.shape[1], y[at], w[at]
            size = len(offered) * m * bins * 2
            total = np.zeros(size)
            for j in range(m):
                i = ((s * m + j) * bins + x[base + offered[s, j]]) * 2 + yy
                total += np.bincount(i, weights=ww, minlength=size)
            full = np.flatnonzero(total)
            cell = m * bins * 2 * BLOCK
            block = full // cell
            cuts = np.flatnonzero(np.r_[True, np.diff(block) > 0])
            ends = np.r_[cuts[1:], len(full)]
            offsets = pa.array(np.r_[cuts, len(full)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cuts), t), pa.int32()), pa.array(block[cuts], pa.int32()),
                 pa.ListArray.from_arrays(offsets, pa.array(full % cell, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(total[full])),
                 pa.array(np.pad(drawn := np.bincount(s, minlength=len(offered)), (0, -len(drawn) % BLOCK)).reshape(-1, BLOCK)[block[cuts]].tolist(),
                          pa.list_(pa.int64()))], names=["tree", "block", "i", "v", "c"])
    return run


def _best_splits(m: int, bins: int, least: int):
    """Per open node of a block: class counts, and of all (offered feature, bin) the split with the largest Gini gain."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        i, v = np.concatenate(part["i"].to_numpy()), np.concatenate(part["v"].to_numpy())
        h = np.bincount(i, weights=v, minlength=BLOCK * m * bins * 2).reshape(BLOCK, m, bins, 2)
        left = np.cumsum(h, axis=2)
        total = left[:, :, -1:, :]
        right = total - left
        mass = lambda c: c.sum(axis=-1)
        with np.errstate(divide="ignore", invalid="ignore"):
            gini = lambda c: np.nan_to_num(1.0 - ((c / mass(c)[..., None]) ** 2).sum(axis=-1))
            gain = gini(total) - mass(left) / mass(total) * gini(left) - mass(right) / mass(total) * gini(right)
        gain = np.where((mass(left) >= least) & (mass(right) >= least), np.nan_to_num(gain, nan=-1.0), -1.0).reshape(BLOCK, -1)
        best = gain.argmax(axis=1)
        own, rows = total[:, 0, 0, :], np.arange(BLOCK)
        side = left.reshape(BLOCK, -1, 2)[rows, best]
        have = own.sum(axis=1) > 0
        out = pd.DataFrame({"tree": part["tree"].iloc[0], "slot": part["block"].iloc[0] * BLOCK + rows, "offer": best // bins, "bin": best % bins,
                            "gain": gain[rows, best], "n0": own[:, 0], "n1": own[:, 1], "l0": side[:, 0], "l1": side[:, 1], "cells": np.sum(part["c"].to_numpy(), axis=0)})
        return out[have]
    return run


def _gini(n0: float, n1: float) -> float:
    n = n0 + n1
    return 1.0 - (n0 / n) ** 2 - (n1 / n) ** 2 if n > 0 else 0.0


def _dealt(cells: DataFrame) -> DataFrame:
    """The cells in partitions of at most about CELLS_AT_ONCE."""
    parts = max(cells.sparkSession.sparkContext.defaultParallelism, -(-cells.count() // CELLS_AT_ONCE))
    return stored(cells.repartition(parts, "k"), "dealt_cells")


def _child_table(nodes: list[dict]) -> np.ndarray:
    """Left and right child per node, a leaf's children being itself."""
    return np.array([[r["left"], r["right"]] if r["left"] >= 0 else [i, i] for i, r in enumerate(nodes)], np.int64).ravel()


def grow_forest(cells: DataFrame, sizes: list[int], trees: int, depth: int, least: int, offered: int, seed: int,
                finish: int | None = None) -> list[dict]:
    """Each tree as arrays over its nodes like ``grow_subtree``'s, siblings of one class not merged yet; up to ``finish``
    (FINISH_CELLS) cells are grown on in tasks, others level by level."""
    if depth > 0 and cells.count() <= (FINISH_CELLS if finish is None else finish):
        return _grow_in_tasks(cells, sizes, trees, depth, least, offered, seed, [], _gain_of_level)
    return [_as_arrays(nodes) for nodes in _grow_levels(_dealt(cells), len(sizes), max(sizes), trees, depth, least, offered, seed)[0]]


def _grow_levels(dealt: DataFrame, features: int, bins: int, trees: int, depth: int, least: int, offered: int, seed: int,
                 finish: int = 0) -> tuple[list[list[dict]], list[dict]]:
    """The trees, and per tree the level of each node that is left open as it has at most ``finish`` drawn cells."""
    spark = dealt.sparkSession
    left_open = [{} for _ in range(trees)]
    leaf = lambda n0, n1: {"feature": -1, "bin": 0, "n0": n0, "n1": n1, "gain": -1.0, "left": -1, "right": -1}
    forest = [[leaf(0.0, 0.0)] for _ in range(trees)]
    open_nodes = [[0] for _ in range(trees)]
    for level in range(depth + 1):             # the last pass only matters if the roots are leaves (depth 0)
        if not any(open_nodes) or (level == depth and depth > 0):
            break
        tables, offers = [], []
        for t, nodes in enumerate(forest):
            child = _child_table(nodes)
            slot = np.full(len(nodes), -1, np.int64)
            slot[open_nodes[t]] = np.arange(len(open_nodes[t]))
            draw = np.random.default_rng([seed, t, level]).random((len(open_nodes[t]), features))
            offers.append(np.argsort(draw, axis=1)[:, :offered])
            tables.append((np.array([max(0, r["feature"]) for r in nodes], np.int64), np.array([r["bin"] for r in nodes], np.int64), child, slot, offers[t]))
        sent = spark.sparkContext.broadcast(tables)
        counted = dealt.mapInArrow(_counts_of_level(sent, level, features, bins, seed), "tree int, block int, i array<int>, v array<double>, c array<long>")
        found = counted.groupBy("tree", "block").applyInPandas(
            _best_splits(offered, bins, least),
            "tree int, slot int, offer int, bin int, gain double, n0 double, n1 double, l0 double, l1 double, cells long").toPandas()
        sent.destroy()
        following = [[] for _ in range(trees)]
        for r in found.sort_values(["tree", "slot"]).itertuples(index=False):
            nodes, node = forest[r.tree], open_nodes[r.tree][r.slot]
            here = nodes[node]
            here["n0"], here["n1"] = r.n0, r.n1
            if r.cells <= finish and depth > 0:
                left_open[r.tree][node] = level
                continue
            if r.gain <= 0 or depth == 0:
                continue
            sides = [(r.l0, r.l1), (r.n0 - r.l0, r.n1 - r.l1)]
            here.update(feature=int(offers[r.tree][r.slot][r.offer]), bin=int(r.bin), gain=r.gain, left=len(nodes), right=len(nodes) + 1)
            for n0, n1 in sides:
                if n0 > 0 and n1 > 0:          # a pure node is a leaf
                    following[r.tree].append(len(nodes))
                nodes.append(leaf(n0, n1))
        open_nodes = following
    return forest, left_open


# ---------------------------------------------------------------- deep forests: subtrees finished in tasks
def _cells_of_open(sent, features: int, seed: int):
    """Per (tree, open node): one partition's drawn cells in it, packed."""
    def run(batches):
        batches = list(batches)            # one partition: at most about CELLS_AT_ONCE small rows
        if not batches:
            return
        column = lambda c: np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in batches])
        flat = np.frombuffer(b"".join(v for b in batches for v in b.column("bins").to_pylist()), np.uint8)
        x, y, n, keys = flat.reshape(-1, features), column("y").astype(np.uint8), column("n"), column("k").view(np.uint64)
        for t, (feature, cut, child, levels, opened) in enumerate(sent.value):
            if not len(opened):
                continue
            w = bootstrap_counts(keys, n, t, seed).astype(np.int64)
            at = np.flatnonzero(w)
            node = np.zeros(len(at), np.int64)
            for _ in range(levels):
                node = child[2 * node + (flat[at * features + feature[node]] > cut[node])]
            for o in opened.tolist():
                here = at[node == o]
                if len(here):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([t], pa.int32()), pa.array([o], pa.int32()),
                         *[pa.array([c.tobytes()], pa.binary()) for c in (x[here], y[here], w[here])]], names=["tree", "node", "x", "y", "w"])
    return run


def _gini_of(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    n = np.maximum(n0 + n1, 1.0)
    return 1.0 - (n0 / n) ** 2 - (n1 / n) ** 2


def _gain_of_subtree(t0, t1, l0, l1):
    """Gini gain of splits into (l0, l1) and the rest of (t0, t1)."""
    r0, r1 = t0 - l0, t1 - l1
    left, right = l0 + l1, r0 + r1
    return _gini_of(t0, t1) - (left * _gini_of(l0, l1) + right * _gini_of(r0, r1)) / (left + right)


def _gain_of_level(t0, t1, l0, l1):
    """The same gain, added up as ``_best_splits`` does (ties of rounded gains fall alike)."""
    def gini(a, b, n):
        return np.nan_to_num(1.0 - ((a / n) ** 2 + (b / n) ** 2))
    r0, r1 = t0 - l0, t1 - l1
    total, left, right = t0 + t1, l0 + l1, r0 + r1
    with np.errstate(divide="ignore", invalid="ignore"):
        return gini(t0, t1, total) - left / total * gini(l0, l1, left) - right / total * gini(r0, r1, right)


def grow_subtree(x: np.ndarray, y: np.ndarray, w: np.ndarray, sizes: list[int], depth: int, least: int, offered: int, draw) -> dict:
    """The tree of some cells (bins ``x`` of the features, labels ``y``, drawn rows ``w``) as arrays over its nodes.

    feature (-1: leaf), bin, left (the right child is the next node), gain, n0, n1; parents come before children.
    ``draw(level, nodes)`` gives a random row per open node, whose order tells the features that it is offered."""
    return grow_subtrees(x, y, w, sizes, depth, [least], offered, draw)[0]


def grow_subtrees(x: np.ndarray, y: np.ndarray, w: np.ndarray, sizes: list[int], depth: int, leasts: list[int], offered: int, draw,
                  gain_of=_gain_of_subtree) -> list[dict]:
    """``grow_subtree`` for several least leaf sizes: the trees grow as one until their splits differ. ``x`` is cells x features.

    While the open nodes are large, the cells of each lie together and are counted by themselves; later all are counted at once."""
    own = np.bincount(y, weights=w, minlength=2)[None]
    root = {"feature": np.array([-1]), "bin": np.array([0]), "left": np.array([-1]), "gain": np.array([-1.0]), "own": own}
    opened = np.array([0]) if (own > 0).all() else np.array([], np.int64)
    out = [None] * len(leasts)
    narrow, features = max(sizes) <= 128, x.shape[1]
    xy = np.zeros((len(x), 8 if narrow and features < 8 else features), np.uint8 if narrow else np.uint16)       # up to eight bytes are copied as one number
    np.add(np.left_shift(x, 1, dtype=xy.dtype), y.astype(xy.dtype)[:, None], out=xy[:, :features])
    pending = [([root], [(xy, w)], opened, own, 0, 1, [*range(len(leasts))])]
    while pending:
        nodes, cells, opened, total, level, count, which = pending.pop()
        while level < depth and len(opened):
            m = len(opened)
            if isinstance(cells, list) and sum(len(v) for _, v in cells) < APART * m:
                cells = _joined(cells)
            offer = np.argsort(draw(level, m), axis=1)[:, :offered]
            found = (_splits_apart if isinstance(cells, list) else _splits_joined)(cells, total, offer, sizes, [leasts[k] for k in which], gain_of)
            same = [k for k, f in zip(which, found) if all(np.array_equal(a, b) for a, b in zip(f[:3], found[0][:3]))]
            if len(same) < len(which):         # the others go on by themselves from here
                again = [*nodes[:-1], {c: v.copy() for c, v in nodes[-1].items()}]
                pending.append((again, cells, opened, total, level, count, [k for k in which if k not in same]))
                which = same
            split, feature, cut, gain, side = found[0]
            k, inside = len(split), nodes[-1]  # the level that holds the open nodes, at their places ``opened``
            inside["feature"][opened[split]], inside["bin"][opened[split]] = feature, cut
            inside["left"][opened[split]], inside["gain"][opened[split]] = count + 2 * np.arange(k), gain
            own = np.stack([side, total[split] - side], axis=1).reshape(-1, 2)
            nodes.append({"feature": np.full(2 * k, -1), "bin": np.zeros(2 * k, np.int64), "left": np.full(2 * k, -1), "gain": np.full(2 * k, -1.0), "own": own})
            goes_on = (own > 0).all(axis=1)                           # a pure node is a leaf
            cells = (_routed_apart if isinstance(cells, list) else _routed_joined)(cells, m, split, feature, cut, goes_on)
            opened = np.flatnonzero(goes_on)
            total, count, level = own[opened], count + 2 * k, level + 1
        tree = {c: np.concatenate([n[c] for n in nodes]) for c in nodes[0]}
        own = tree.pop("own")
        for k in which:
            out[k] = {**tree, "n0": own[:, 0], "n1": own[:, 1]}
    return out


def _routed_apart(cells: list, m: int, split, feature, cut, goes_on) -> list:
    """The cells of the children that stay open, each with its own (2 * bin + label by feature, drawn rows)."""
    out = []
    for s, f, c, sides in zip(split, feature, cut, goes_on.reshape(-1, 2)):
        xy, w = cells[s]
        right = xy[:, f] > 2 * c + 1
        for stays, here in zip(sides, (~right, right)):
            if stays:
                at = np.flatnonzero(here)
                out.append((_rows_at(xy, at), w.take(at)))
    return out


def _rows_at(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    if rows.shape[1] * rows.itemsize == 8:
        return rows.view(np.uint64)[:, 0].take(at).view(rows.dtype).reshape(-1, rows.shape[1])
    return rows.take(at, axis=0)


def _joined(cells: list) -> tuple:
    """(bins, code, drawn rows) of all open nodes; the code is 2 * node + label."""
    xy, w = np.concatenate([c for c, _ in cells]), np.concatenate([v for _, v in cells])
    slot = np.repeat(np.arange(len(cells)), [len(v) for _, v in cells])
    return (xy >> 1).astype(np.uint8), 2 * slot + (xy[:, 0] & 1), w


def _routed_joined(cells: tuple, m: int, split, feature, cut, goes_on) -> tuple:
    x, code, w = cells
    child, at, bound = np.full(2 * m, -1, np.int64), np.zeros(m, np.int64), np.zeros(m, np.uint8)
    number = np.where(goes_on, np.cumsum(goes_on) - 1, -1)
    child[2 * split], child[2 * split + 1] = number[::2], number[1::2]
    at[split], bound[split] = feature, cut
    slot = code >> 1
    value = x.ravel().take(at.take(slot) + np.arange(len(code)) * x.shape[1])
    slot = child.take(2 * slot + (value > bound.take(slot)))
    keep = np.flatnonzero(slot >= 0)
    return _rows_at(x, keep), 2 * slot.take(keep) + (code.take(keep) & 1), w.take(keep)


def _splits_apart(cells: list, total, offer, sizes, leasts, gain_of) -> list[tuple]:
    """Per least leaf size: the open nodes that split, and their features, bins, gains and left class counts."""
    counts = np.zeros((*offer.shape, 2 * max(sizes)))              # bins that a feature does not have stay empty: no cut
    for own, features, (xy, w) in zip(counts, offer.tolist(), cells):
        for here, f in zip(own, features):
            here[:2 * sizes[f]] = np.bincount(xy[:, f], weights=w, minlength=2 * sizes[f])
    low = counts.reshape(*offer.shape, -1, 2).cumsum(axis=2)[:, :, :-1]
    if not low.size:
        low = np.zeros((*offer.shape, 1, 2))
    l0, l1, whole = low[..., 0], low[..., 1], total[:, None, None]
    g, left = gain_of(whole[..., 0], whole[..., 1], l0, l1), l0 + l1
    right = whole.sum(axis=-1) - left
    gain, at = [], []
    for least in leasts:
        masked = np.where((left < least) | (right < least), -1.0, g)
        at.append(masked.argmax(axis=2))
        gain.append(np.take_along_axis(masked, at[-1][..., None], axis=2)[..., 0])
    side = [np.take_along_axis(low, best[..., None, None], axis=2)[:, :, 0] for best in at]
    return _chosen(gain, at, side, offer)


def _splits_joined(cells: tuple, total, offer, sizes, leasts, gain_of) -> list[tuple]:
    """The same for cells of many nodes at once."""
    x, code, w = cells
    (m, offered), places = offer.shape, len(leasts)
    gain, at, side = np.full((places, m, offered), -1.0), np.zeros((places, m, offered), np.int64), np.zeros((places, m, offered, 2))
    for f, bins in enumerate(sizes):
        whole, rank = np.nonzero(offer == f)
        all_nodes = 2 * m * bins <= min(COUNTS_AT_ONCE, max(4096, len(code)))       # counting all is less than choosing cells
        for a in range(0, len(whole) if bins > 1 else 0, step := max(1, len(whole) if all_nodes else COUNTS_AT_ONCE // bins)):
            node, r = whole[a:a + step], rank[a:a + step]
            if all_nodes:
                i, v, size = code * bins, w, 2 * m * bins
                i += x[:, f]
            else:
                place = np.full(2 * m, -1, np.int64)
                place[2 * node], place[2 * node + 1] = 2 * np.arange(len(node)), 2 * np.arange(len(node)) + 1
                p = place.take(code)
                chosen = np.flatnonzero(p >= 0)
                i, v, size = p.take(chosen) * bins + x[:, f].take(chosen), w.take(chosen), 2 * len(node) * bins
            counts = np.bincount(i, weights=v, minlength=size).reshape(-1, 2, bins)
            low = (counts[node] if all_nodes else counts).cumsum(axis=2)[:, :, :-1]
            l0, l1 = low[:, 0], low[:, 1]
            g, left = gain_of(total[node, :1], total[node, 1:], l0, l1), l0 + l1
            right, here = total[node].sum(axis=1)[:, None] - left, np.arange(len(node))
            for k, least in enumerate(leasts):
                masked = np.where((left < least) | (right < least), -1.0, g)
                best = masked.argmax(axis=1)
                gain[k, node, r], at[k, node, r] = masked[here, best], best
                side[k, node, r, 0], side[k, node, r, 1] = l0[here, best], l1[here, best]
    return _chosen(gain, at, side, offer)


def _chosen(gain, at, side, offer) -> list[tuple]:
    out, here = [], np.arange(len(offer))
    for g, a, low in zip(gain, at, side):
        j = g.argmax(axis=1)
        split = np.flatnonzero(g[here, j] > 0)
        best = (split, j[split])
        out.append((split, offer[best], a[best], g[best], low[best]))
    return out


_PACKED = {"feature": np.int16, "bin": np.int16, "left": np.int32, "gain": np.float64, "n0": np.float64, "n1": np.float64}


def _finish(sent, sizes: list[int], depth: int, least: int, offered: int, seed: int):
    """One (tree, open node) after the other: its subtree, packed."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        t, o = int(part["tree"].iloc[0]), int(part["node"].iloc[0])
        x, y, w = (np.frombuffer(b"".join(part[c]), kind) for c, kind in (("x", np.uint8), ("y", np.uint8), ("w", np.int64)))
        tree = grow_subtree(x.reshape(-1, len(sizes)), y, w.astype(np.float64), sizes, depth - sent.value[t][o], least, offered,
                            lambda level, m: np.random.default_rng([seed, t, o, level]).random((m, len(sizes))))
        return pd.DataFrame([{"tree": t, "node": o, **{c: tree[c].astype(kind).tobytes() for c, kind in _PACKED.items()}}])
    return run


def _as_arrays(nodes: list[dict]) -> dict:
    return {c: np.array([r[c] for r in nodes], kind) for c, kind in _PACKED.items()}


def _whole_tree(held: tuple, t: int, sizes: list[int], depth: int, leasts: list[int], offered: int, seed: int, place: list[int], gain_of) -> list[dict]:
    """Tree t of the cells in memory, per least leaf size."""
    x, y, n, keys = held
    w = bootstrap_counts(keys, n, t, seed)
    at = np.flatnonzero(w)
    return grow_subtrees(x.take(at, axis=0), y.take(at), w.take(at), sizes, depth, leasts, offered,
                         lambda level, m: np.random.default_rng([seed, t, *place, level]).random((m, len(sizes))), gain_of)


def _grow_in_tasks(cells: DataFrame, sizes: list[int], trees: int, depth: int, least: int, offered: int, seed: int, place: list[int], gain_of) -> list[dict]:
    """All trees of a bounded number of cells, which are broadcast; ``place`` goes into the draws of offered features."""
    spark = cells.sparkSession
    sent = spark.sparkContext.broadcast(_on_driver(cells, len(sizes)))

    def run(batches):
        for batch in batches:
            for t in batch.column(0).to_pylist():
                tree = _whole_tree(sent.value, t, sizes, depth, [least], offered, seed, place, gain_of)[0]
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), *[pa.array([tree[c].astype(kind).tobytes()], pa.binary())
                                                                               for c, kind in _PACKED.items()]], names=["tree", *_PACKED])

    numbers = spark.range(0, trees, 1, min(trees, 4 * spark.sparkContext.defaultParallelism))
    found = numbers.mapInArrow(run, "tree int, " + ", ".join(f"{c} binary" for c in _PACKED)).toPandas().sort_values("tree")
    sent.destroy()
    return [{c: np.frombuffer(getattr(r, c), kind) for c, kind in _PACKED.items()} for r in found.itertuples(index=False)]


def grow_deep(cells: DataFrame, sizes: list[int], trees: int, depth: int, least: int, offered: int, seed: int, finish: int | None = None) -> list[dict]:
    """Each tree as arrays over its nodes like ``grow_subtree``'s, siblings of one class not merged yet.

    ``sizes`` are the numbers of bins. Nodes of more than ``finish`` (FINISH_CELLS) drawn cells are split level by level, the subtrees
    of smaller ones in tasks of their own. A tree of less depth is the upper part of a deeper one: draws depend on the place only."""
    spark, features, finish = cells.sparkSession, len(sizes), FINISH_CELLS if finish is None else finish
    if cells.count() <= finish:
        return _grow_in_tasks(cells, sizes, trees, depth, least, offered, seed, [0], _gain_of_subtree)
    dealt = _dealt(cells)
    forest, left_open = _grow_levels(dealt, features, max(sizes), trees, depth, least, offered, seed, finish)
    out = [_as_arrays(nodes) for nodes in forest]
    groups = sum(map(len, left_open))
    if not groups:
        return out
    tables = [(np.maximum(tree["feature"], 0).astype(np.int64), tree["bin"].astype(np.int64), _child_table(nodes),
               max(levels.values(), default=0), np.array(sorted(levels), np.int64)) for nodes, tree, levels in zip(forest, out, left_open)]
    sent, at = spark.sparkContext.broadcast(tables), spark.sparkContext.broadcast(left_open)
    packed = dealt.mapInArrow(_cells_of_open(sent, features, seed), "tree int, node int, x binary, y binary, w binary") \
        .repartition(min(groups, 16 * spark.sparkContext.defaultParallelism), "tree", "node").groupBy("tree", "node").applyInPandas(
            _finish(at, sizes, depth, least, offered, seed), "tree int, node int, " + ", ".join(f"{c} binary" for c in _PACKED))
    found = packed.toPandas().sort_values(["tree", "node"])
    sent.destroy()
    at.destroy()
    for t, subs in found.groupby("tree"):
        parts, base = [out[t]], len(out[t]["left"])
        for r in subs.itertuples(index=False):
            sub = {c: np.frombuffer(getattr(r, c), kind) for c, kind in _PACKED.items()}
            sub["left"] = np.where(sub["left"] >= 0, sub["left"] + base - 1, -1)     # the root takes the open node's place
            for c in _PACKED:
                parts[0][c][r.node] = sub[c][0]
            parts.append({c: v[1:] for c, v in sub.items()})
            base += len(sub["left"]) - 1
        out[t] = {c: np.concatenate([p[c] for p in parts]) for c in _PACKED}
    return out


def _levels_of(left: np.ndarray) -> list[np.ndarray]:
    """The inner nodes of each level."""
    level, out = np.array([0]), []
    while len(inner := level[left[level] >= 0]):
        out.append(inner)
        level = np.concatenate([left[inner], left[inner] + 1])
    return out


def _leaves_at(tree: dict, levels: list[np.ndarray], depth: int) -> np.ndarray:
    """Which nodes are leaves if the tree ends at a depth and sibling leaves of one class are merged, from the bottom up."""
    left, positive = tree["left"], tree["n1"] > tree["n0"]
    leaf = left < 0
    for i, inner in reversed([*enumerate(levels)]):
        a, b = left[inner], left[inner] + 1
        leaf[inner] = (leaf[a] & leaf[b] & (positive[a] == positive[b])) if i < depth else True
    return leaf


def _merged_arrays(tree: dict) -> dict:
    """The tree with sibling leaves of one class merged, its nodes numbered level by level."""
    levels = _levels_of(tree["left"])
    leaf = _leaves_at(tree, levels, len(levels))
    level, order = np.array([0]), [np.array([0])]
    while len(inner := level[~leaf[level]]):
        level = np.stack([tree["left"][inner], tree["left"][inner] + 1], axis=1).ravel()
        order.append(level)
    order = np.concatenate(order)
    place = np.full(len(leaf), -1)
    place[order] = np.arange(len(order))
    kept = {c: v[order] for c, v in tree.items()}
    end = leaf[order]
    return {**kept, "left": np.where(end, -1, place[kept["left"]]), "feature": np.where(end, -1, kept["feature"]), "gain": np.where(end, -1.0, kept["gain"])}


def _share_table(tree: dict, depths: list[int]) -> np.ndarray:
    """Nodes x depths: the share of class 1 that a row of this node gets from the tree that ends at the depth."""
    total = tree["n0"] + tree["n1"]
    own = np.divide(tree["n1"], total, out=np.zeros(len(total)), where=total > 0)
    levels, out = _levels_of(tree["left"]), np.repeat(own[:, None], len(depths), axis=1)
    for d, depth in enumerate(depths):
        leaf = _leaves_at(tree, levels, depth)
        for inner in levels:
            ends = inner[leaf[inner]]
            for child in (tree["left"][ends], tree["left"][ends] + 1):
                out[child, d] = out[ends, d]
                leaf[child] = True
    return out


def prefix_scores_of_cells(cells: DataFrame, forest: list[dict], sizes: list[int], depths: list[int]) -> DataFrame:
    """trees, depth, score, y, n per cell: P(1) by the first t trees, each ending at the depth, with the cell's label and rows.

    The first t trees are a forest of t trees, and a tree ended at a depth is one grown to it, so every point scores as a forest
    fitted for it. The forest, which lies on the driver, is broadcast."""
    wanted = sorted(sizes)
    if not 1 <= wanted[0] <= wanted[-1] <= len(forest):
        raise ValueError(f"the forest has {len(forest)} trees")
    sent = cells.sparkSession.sparkContext.broadcast([
        (np.maximum(t["feature"], 0).astype(np.int64), t["bin"].astype(np.int64),
         np.stack([np.where(t["left"] < 0, np.arange(len(t["left"])), t["left"] + i * (t["left"] >= 0)) for i in (0, 1)], axis=1).ravel(),
         len(_levels_of(t["left"])), _share_table(t, depths)) for t in forest[:wanted[-1]]])
    points = [(t, d) for t in wanted for d in depths]

    def run(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8)
            rows = batch.num_rows
            base, sums, found = np.arange(rows) * (len(x) // max(rows, 1)), np.zeros((rows, len(depths))), []
            for t, (feature, cut, child, levels, share) in enumerate(sent.value, 1):
                node = np.zeros(rows, np.int64)
                for _ in range(levels):
                    node = child[2 * node + (x[base + feature[node]] > cut[node])]
                sums += share[node]
                if t in wanted:
                    found.append(sums / t)
            again = pa.array(np.repeat(np.arange(rows), len(points)))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(np.tile(np.array([p[i] for p in points], np.int32), rows)) for i in (0, 1)], pa.array(np.hstack(found).ravel()),
                 *[batch.column(c).take(again) for c in ("y", "n")]], names=["trees", "depth", "score", "y", "n"])

    return cells.select("bins", "y", "n").mapInArrow(run, "trees int, depth int, score double, y double, n long")


def _add_shares(sums: np.ndarray, x: np.ndarray, tree: dict, share: np.ndarray) -> None:
    """Adds to each cell (a row of bins) the shares of its leaf."""
    feature, cut, left = np.maximum(tree["feature"], 0).astype(np.int64), tree["bin"].astype(np.uint8), tree["left"].astype(np.int64)
    flat, width = x.ravel(), x.shape[1]
    for a in range(0, len(x), WALKS_AT_ONCE):
        leaf = np.zeros(min(WALKS_AT_ONCE, len(x) - a), np.int64)
        cells, node = np.arange(len(leaf)), leaf
        base = (cells + a) * width
        while len(cells):
            inner = left.take(node)
            on = np.flatnonzero(inner >= 0)
            if len(on) < len(cells):
                leaf[cells] = node
                cells, node, inner, base = cells.take(on), node.take(on), inner.take(on), base.take(on)
            node = inner + (flat.take(feature.take(node) + base) > cut.take(node))
        sums[a:a + len(leaf)] += share.take(leaf, axis=0)


def grid_scores(cells: DataFrame, held: DataFrame, edges: list[np.ndarray], forests: list[RandomForestClassifier], sizes: list[int],
                depths: list[int]) -> DataFrame:
    """trees, depth, least, score, y, n: like ``prefix_scores_of_cells`` of held-out cells, for forests that differ in their least
    leaf size only; equal scores of a label may be added up.

    Up to FINISH_CELLS cells, the trees stay where they grow: a task grows TREES_AT_ONCE of them for all leaf sizes and adds up what
    they say of the held-out cells, and only these sums are shuffled."""
    e, wanted, spark = forests[0], sorted(sizes), cells.sparkSession
    leasts = [f.getMinInstancesPerNode() for f in forests]
    if max(cells.count(), held.count()) > FINISH_CELLS:
        parts = [prefix_scores_of_cells(held, deep_forest(cells, edges, f), wanted, depths).select(
            "trees", "depth", F.lit(least).alias("least"), "score", "y", "n") for least, f in zip(leasts, forests)]
        return reduce(DataFrame.unionByName, parts)
    if not 1 <= wanted[0] <= wanted[-1] <= e.getNumTrees():
        raise ValueError(f"the forest has {e.getNumTrees()} trees")
    bins, depth, offered, seed = [len(v) + 1 for v in edges], e.getMaxDepth(), _offered(e, len(edges)), e.getSeed()
    sent, out = spark.sparkContext.broadcast(_on_driver(cells, len(edges))), spark.sparkContext.broadcast(_on_driver(held, len(edges)))
    blocks = [(a, min(a + TREES_AT_ONCE, end)) for start, end in zip([0, *wanted], wanted) for a in range(start, end, TREES_AT_ONCE)]

    def grown(batches):
        for batch in batches:
            for b in batch.column(0).to_pylist():
                x = out.value[0]
                sums = [np.zeros((len(x), len(depths))) for _ in leasts]
                for t in range(*blocks[b]):
                    for own, tree in zip(sums, _whole_tree(sent.value, t, bins, depth, leasts, offered, seed, [0], _gain_of_subtree)):
                        _add_shares(own, x, tree, _share_table(tree, depths))
                for i, own in enumerate(sums):
                    for d in range(len(depths)):
                        for c in range(0, len(own), SCORES_AT_ONCE):
                            yield pa.RecordBatch.from_arrays([*[pa.array([v], pa.int32()) for v in (i, d, c, b)],
                                                              pa.array([own[c:c + SCORES_AT_ONCE, d].tobytes()], pa.binary())],
                                                             names=["i", "d", "c", "b", "s"])

    def added(part: pd.DataFrame) -> pd.DataFrame:
        i, d, c = (int(part[k].iloc[0]) for k in "idc")
        y, n = (v[c:c + SCORES_AT_ONCE] for v in out.value[1:3])
        total, found = 0.0, []
        for r in part.sort_values("b").itertuples(index=False):
            total, end = total + np.frombuffer(r.s), blocks[r.b][1]
            if end in wanted:
                for label in (0, 1):
                    score, which = np.unique(total[y == label] / end, return_inverse=True)
                    found.append(pd.DataFrame({"trees": end, "depth": depths[d], "least": leasts[i], "score": score, "y": float(label),
                                               "n": np.bincount(which, weights=n[y == label], minlength=len(score)).astype(np.int64)}))
        return pd.concat(found)

    sums = spark.range(0, len(blocks), 1, len(blocks)).mapInArrow(grown, "i int, d int, c int, b int, s binary")
    return sums.groupBy("i", "d", "c").applyInPandas(added, "trees int, depth int, least int, score double, y double, n long")


# ---------------------------------------------------------------- boosting in a task
_BOOSTED = {"feature": np.int16, "bin": np.int16, "left": np.int32, "gain": np.float64, "w": np.float64, "s": np.float64, "q": np.float64}
_EPSILON = 2.0 ** -52     # a node of less variance is not split


def boosted_trees(x: np.ndarray, y: np.ndarray, n: np.ndarray, sizes: list[int], rounds: int, depth: int, rate: float):
    """The regression trees of Spark's ``GBTClassifier`` on weighted cells (bins by feature, labels, rows), as arrays over their nodes.

    feature (-1: leaf), bin, left, gain, and the rows, the sum and the sum of squares of the residuals; the first tree has weight 1,
    the others ``rate``."""
    sign, score = 2.0 * y - 1.0, np.zeros(len(y))
    target, cuts = sign, sum(sizes)
    for t in range(rounds):
        weighted, slot, tree, first = n * target, np.zeros(len(y), np.int64), [], 0
        square, leaf = weighted * target, np.zeros(len(y), np.int64)
        opened, count = np.array([0]), 1
        stats = [np.array([v.sum()]) for v in (n, weighted, square)]
        for level in range(depth + 1):
            w, s, q = stats
            nodes = {"feature": np.full(len(w), -1), "bin": np.zeros(len(w), np.int64), "left": np.full(len(w), -1), "gain": np.full(len(w), -1.0),
                     "w": w, "s": s, "q": q}
            tree.append(nodes)
            m = len(opened)
            if level == depth or not m:
                break
            gain, sides, at = np.full((m, cuts), -1.0), [np.zeros((m, cuts)) for _ in stats], 0
            for f, bins in enumerate(sizes):                       # cells of closed nodes are counted at place m
                i = slot * bins
                i += x[f]
                low = [np.bincount(i, weights=v, minlength=(m + 1) * bins).reshape(m + 1, bins)[:m].cumsum(axis=1) for v in (n, weighted)]
                lw, ls = low
                rw, rs = w[opened, None] - lw, s[opened, None] - ls
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = (ls ** 2 / lw + rs ** 2 / rw - (s ** 2 / w)[opened, None]) / w[opened, None]
                gain[:, at:at + bins - 1] = np.where((lw > 0) & (rw > 0), g, -1.0)[:, :-1]
                at += bins
            best = gain.argmax(axis=1)
            split = np.flatnonzero(gain[np.arange(m), best] > 0)
            k, starts = len(split), np.cumsum([0, *sizes])
            feature = np.searchsorted(starts, best[split], side="right") - 1
            cut = best[split] - starts[feature]
            nodes["feature"][opened[split]], nodes["bin"][opened[split]] = feature, cut
            nodes["left"][opened[split]], nodes["gain"][opened[split]] = count + 2 * np.arange(k), gain[split, best[split]]
            child, has, bound = np.full(m + 1, -1), np.zeros(m + 1, np.int64), np.zeros(m + 1, np.uint8)
            child[split], has[split], bound[split] = 2 * np.arange(k), feature, cut
            place = child.take(slot)                               # among the nodes of the next level
            place += (x[has[0]] if m == 1 else x.ravel().take(has.take(slot) * len(y) + np.arange(len(y)))) > bound.take(slot)
            place[child.take(slot) < 0] = 2 * k
            leaf = np.where(place < 2 * k, count + place, leaf)
            stats = [np.bincount(place, weights=v, minlength=2 * k + 1)[:2 * k] for v in (n, weighted, square)]
            variance = np.abs(stats[2] - stats[1] ** 2 / np.maximum(stats[0], 1e-300)) / np.maximum(stats[0], 1e-300)
            goes_on = variance >= _EPSILON
            number = np.full(2 * k + 1, int(goes_on.sum()))
            number[:2 * k][goes_on] = np.arange(goes_on.sum())
            slot, opened, count = number.take(place), np.flatnonzero(goes_on), count + 2 * k
        tree = {c: np.concatenate([v[c] for v in tree]) for c in _BOOSTED}
        yield tree
        score += (1.0 if t == 0 else rate) * (tree["s"] / tree["w"]).take(leaf)
        with np.errstate(over="ignore"):
            target = 4.0 * sign / (1.0 + np.exp(2.0 * sign * score))


def _boost_in_task(cells: DataFrame, sizes: list[int], rounds: int, depth: int, rate: float) -> list[dict]:
    """``boosted_trees`` of a bounded number of cells, in one task."""
    def run(batches):
        table = pa.Table.from_batches(list(batches))
        order = np.argsort(table.column("k").to_numpy(), kind="stable")            # sums in one order, whatever the partitions
        x = np.concatenate([_bins_of(chunk.cast(pa.binary()), len(sizes)) for chunk in table.column("bins").chunks])
        y, n = (table.column(c).to_numpy()[order].astype(np.float64) for c in ("y", "n"))
        for t, tree in enumerate(boosted_trees(np.ascontiguousarray(x[order].T), y, n, sizes, rounds, depth, rate)):
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), *[pa.array([tree[c].astype(kind).tobytes()], pa.binary())
                                                                           for c, kind in _BOOSTED.items()]], names=["tree", *_BOOSTED])

    found = cells.select("bins", "y", "n", "k").coalesce(1).mapInArrow(run, "tree int, " + ", ".join(f"{c} binary" for c in _BOOSTED))
    return [{c: np.frombuffer(getattr(r, c), kind) for c, kind in _BOOSTED.items()} for r in found.toPandas().sort_values("tree").itertuples(index=False)]


def _boosted_rows(t: int, tree: dict, edges: list[np.ndarray]) -> list[tuple]:
    """The rows of a boosted tree's nodes; leaves of one parent that predict the same become one."""
    left, mean = tree["left"].copy(), tree["s"] / tree["w"]
    for i in reversed(range(len(left))):
        a = left[i]
        if a >= 0 and left[a] < 0 and left[a + 1] < 0 and mean[a] == mean[a + 1]:
            left[i] = -1
    kept = [0]
    for i in kept:
        kept += [left[i], left[i] + 1] if left[i] >= 0 else []
    place = {i: p for p, i in enumerate(kept)}
    rows = []
    for p, i in enumerate(kept):
        w, s, q = (float(tree[c][i]) for c in "wsq")
        f, inner = int(tree["feature"][i]), left[i] >= 0
        rows.append((t, (p, float(mean[i]), (q - s * s / w) / w, [w, s, q], round(w), float(tree["gain"][i]) if inner else -1.0,
                         place[left[i]] if inner else -1, place[left[i] + 1] if inner else -1,
                         (f, [float(edges[f][tree["bin"][i]])], -1) if inner else (-1, [], -1))))
    return rows


# ---------------------------------------------------------------- as Spark models
def _new_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{name}-{uuid.uuid4().hex[:8]}"


def _with_nodes(spark: SparkSession, path: str, nodes: DataFrame) -> str:
    """The model saved at path with other nodes, saved anew."""
    other = f"{path}-nodes"
    spark.read.text(f"{path}/metadata").write.text(f"{other}/metadata")
    spark.read.parquet(f"{path}/treesMetadata").write.parquet(f"{other}/treesMetadata")
    nodes.write.parquet(f"{other}/data")
    return other


class _OnCells(Estimator):
    """Fits ``estimator`` on cells of the rows; labels are 0 and 1."""

    def __init__(self, estimator=None):
        super().__init__()
        self.estimator, self.columns = estimator, None

    def copy(self, extra=None):
        other = super().copy(extra)
        other.estimator = self.estimator.copy(extra)
        return other

    def reading(self, columns: list[str]) -> "_OnCells":
        """The same estimator in a pipeline whose stage before it assembles these columns."""
        other = self.copy()
        other.columns = list(columns)
        return other

    def _fit(self, df: DataFrame) -> Model:
        e = self.estimator
        cells, edges = _cells_of(df, e.getFeaturesCol(), e.getLabelCol(), e.getMaxBins(), self.columns)
        model = self._fit_cells(df.sparkSession, cells, edges)
        model.cell_edges = edges           # rows between the same thresholds score the same (counted_scores)
        return model


def _offered(e: RandomForestClassifier, features: int) -> int:
    if e.getImpurity() != "gini" or e.getFeatureSubsetStrategy() != "sqrt":
        raise ValueError("the forest splits by gini and is offered sqrt(features)")
    return int(np.ceil(np.sqrt(features)))


def deep_forest(cells: DataFrame, edges: list[np.ndarray], e: RandomForestClassifier, finish: int | None = None) -> list[dict]:
    """``grow_deep`` with the parameters of the estimator."""
    return grow_deep(cells, [len(v) + 1 for v in edges], e.getNumTrees(), e.getMaxDepth(), e.getMinInstancesPerNode(), _offered(e, len(edges)),
                     e.getSeed(), finish)


class CellForest(_OnCells):
    """A random forest (bootstrap rows, Gini) with the parameters of a ``RandomForestClassifier``, grown on cells."""

    def _grown(self, cells: DataFrame, edges: list[np.ndarray]) -> list[dict]:
        e, k = self.estimator, len(edges)
        return grow_forest(cells, [len(v) + 1 for v in edges], e.getNumTrees(), e.getMaxDepth(), e.getMinInstancesPerNode(), _offered(e, k), e.getSeed())

    def _nodes(self, spark: SparkSession, cells: DataFrame, edges: list[np.ndarray]) -> DataFrame:
        forest = [_merged_arrays(t) for t in self._grown(cells, edges)]
        sizes = np.array([len(t["left"]) for t in forest])
        tree = {c: np.concatenate([t[c] for t in forest]) for c in _PACKED}
        inner, n = tree["left"] >= 0, len(tree["left"])
        lists = lambda values, ends: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.float64()))
        cut = np.array([edges[f][b] for f, b in zip(tree["feature"][inner], tree["bin"][inner])], np.float64)
        split = pa.StructArray.from_arrays(
            [pa.array(tree["feature"], pa.int32()), lists(cut, np.r_[0, np.cumsum(inner)]), pa.array(np.full(n, -1), pa.int32())],
            names=["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
        data = pa.StructArray.from_arrays(
            [pa.array(np.concatenate([np.arange(s) for s in sizes]), pa.int32()), pa.array((tree["n1"] > tree["n0"]).astype(float)),
             pa.array(_gini_of(tree["n0"], tree["n1"])), lists(np.stack([tree["n0"], tree["n1"]], axis=1).ravel(), np.arange(0, 2 * n + 1, 2)),
             pa.array((tree["n0"] + tree["n1"]).astype(np.int64)), pa.array(tree["gain"]), pa.array(tree["left"], pa.int32()),
             pa.array(np.where(inner, tree["left"] + 1, -1), pa.int32()), split],
            names=["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
        ids = pa.array(np.repeat(np.arange(len(forest)), sizes), pa.int32())
        return spark.createDataFrame(pa.Table.from_arrays([ids, data], names=["treeID", "nodeData"]), f"treeID int, nodeData {_NODE}")

    def _fit_cells(self, spark: SparkSession, cells: DataFrame, edges: list[np.ndarray]) -> Model:
        e, nodes = self.estimator, self._nodes(spark, cells, edges)
        # the frame of the saved model: the same estimator on two rows
        frame = spark.createDataFrame([(Vectors.dense([float(c)] * len(edges)), float(c)) for c in (0, 1)], [e.getFeaturesCol(), e.getLabelCol()])
        path = _new_path(spark, "forest")
        e.fit(frame).write().save(path)
        return RandomForestClassificationModel.load(_with_nodes(spark, path, nodes))


class DeepForest(CellForest):
    """A ``CellForest`` for trees of any depth: small subtrees are finished in tasks."""

    def _grown(self, cells: DataFrame, edges: list[np.ndarray]) -> list[dict]:
        return deep_forest(cells, edges, self.estimator)


class CellBoosting(_OnCells):
    """A ``GBTClassifier`` fitted on weighted cells: residuals depend on cell and label only, so the trees are those of the rows.

    Up to FINISH_CELLS cells, one task makes all rounds in memory (a round is seconds of cluster time in jobs of its own); beyond, and
    with parameters that ``boosted_trees`` does not know, it is Spark's fit."""

    def _fit_cells(self, spark: SparkSession, cells: DataFrame, edges: list[np.ndarray]) -> Model:
        e = self.estimator
        plain = (e.getMinInstancesPerNode(), e.getMinInfoGain(), e.getMinWeightFractionPerNode(), e.getSubsamplingRate(), e.getFeatureSubsetStrategy(),
                 e.getLossType(), e.isDefined(e.validationIndicatorCol)) == (1, 0.0, 0.0, 1.0, "all", "logistic", False)
        if not plain or cells.count() > FINISH_CELLS:
            return self._fit_spark(spark, cells, edges)
        trees = _boost_in_task(cells, [len(v) + 1 for v in edges], e.getMaxIter(), e.getMaxDepth(), e.getStepSize())
        rows = [r for t, tree in enumerate(trees) for r in _boosted_rows(t, tree, edges)]
        # the frame of the saved model: one round on two rows, told of the others
        frame = spark.createDataFrame([(Vectors.dense([float(c)] * len(edges)), float(c)) for c in (0, 1)], [e.getFeaturesCol(), e.getLabelCol()])
        path = _new_path(spark, "boosting")
        e.copy({e.maxIter: 1}).fit(frame).write().save(path)
        about = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        about["numTrees"] = about["paramMap"]["maxIter"] = len(trees)
        line = spark.read.parquet(f"{path}/treesMetadata")
        text = line.first()[1]             # tree, its parameters, its weight
        lines = [(t, text, e.getStepSize() if t else 1.0) for t in range(len(trees))]
        other = f"{path}-nodes"
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{other}/metadata")
        spark.createDataFrame(lines, line.schema).write.parquet(f"{other}/treesMetadata")
        spark.createDataFrame(rows, f"treeID int, nodeData {_NODE}").write.parquet(f"{other}/data")
        return GBTClassificationModel.load(other)

    def _fit_spark(self, spark: SparkSession, cells: DataFrame, edges: list[np.ndarray]) -> Model:
        e, k = self.estimator, len(edges)

        def numbers(batches):
            for batch in batches:
                x = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) + 1, k), pa.int32()), pa.array(x)),
                                                  batch.column("y"), batch.column("n").cast(pa.float64())], names=["x", "y", "n"])

        rows = cells.select("bins", "y", "n").mapInArrow(numbers, "x array<double>, y double, n double").select(
            array_to_vector("x").alias(e.getFeaturesCol()), F.col("y").alias(e.getLabelCol()), F.col("n").alias("__n"))
        rows = stored(rows.repartition(spark.sparkContext.defaultParallelism), "boosting_cells")
        fitted = e.copy({e.weightCol: "__n"}).fit(rows)
        path = _new_path(spark, "boosting")
        fitted.write().save(path)
        # a threshold between two bins becomes the number that separates them
        table = F.array(*[F.array(*[F.lit(float(v)) for v in edge]).cast("array<double>") for edge in edges])
        split, data = F.col("nodeData.split"), spark.read.parquet(f"{path}/data")
        real = F.transform(split["leftCategoriesOrThreshold"], lambda t: F.get(F.get(table, split["featureIndex"]), F.floor(t).cast("int")))
        nodes = data.withColumn("nodeData", F.col("nodeData").withField("split", split.withField("leftCategoriesOrThreshold", real))
                                .withField("rawCount", F.round(F.get("nodeData.impurityStats", 0)).cast("long")))
        return GBTClassificationModel.load(_with_nodes(spark, path, nodes))


# ---------------------------------------------------------------- scores of cells
def cells_as_vectors(rows: DataFrame, edges: list[np.ndarray], out: str) -> DataFrame:
    """Rows (array column ``x``, label ``y``) counted by cell: a vector of each cell, ``y`` and ``n``."""
    points = [np.r_[e, np.inf] for e in edges]     # the largest number of each bin
    k = len(edges)

    def numbers(batches):
        for batch in batches:
            b = _bins_of(batch.column("bins").cast(pa.binary()), k)
            x = np.stack([p[b[:, f]] for f, p in enumerate(points)], axis=1).ravel() if k else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) + 1, k), pa.int32()), pa.array(x)),
                                              batch.column("y"), batch.column("n")], names=["x", "y", "n"])

    return cell_table(rows, edges).select("bins", "y", "n").mapInArrow(numbers, "x array<double>, y double, n long").select(
        array_to_vector("x").alias(out), "y", "n")
