"""Forests and boosting on cells: thresholds, counts, bootstrap draws, splits against the cells, and Spark's own fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.operators import evaluate as V
from sparkwright.operators import forests as FO
from sparkwright.operators import models as M
from sparkwright.operators import trees as T

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    x = np.c_[rng.integers(0, 30, 4000), rng.normal(size=4000).round(1), rng.integers(0, 4, 4000)]
    y = ((x[:, 0] > 14) ^ (x[:, 1] > 0.3) ^ (rng.random(4000) < 0.1)).astype(float)
    return spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                                 "row_key long, a double, b double, c double, label double").repartition(5).cache()


def test_thresholds_of_few_and_many_values(spark):
    rows = spark.range(2000).select(F.array((F.col("id") % 3).cast("double"), F.col("id") / 7, F.lit(float("nan"))).alias("x")).repartition(4)
    few, many, none = FO.thresholds(rows, 3, 16)
    assert few.tolist() == [0.5, 1.5] and len(none) == 0 and len(many) == 15
    below = [(np.arange(2000) / 7 <= e).mean() for e in many]
    assert np.allclose(below, np.arange(1, 16) / 16, atol=1e-3)


def test_cells_hold_every_row(spark, data):
    rows = M.assemble_stages(FEATS, None, impute=False, scale=False).fit(data).transform(data)
    cells, edges = FO._cells_of(rows, "features", "label", 128)
    x = data.toPandas()
    exact = x.groupby([*FEATS, "label"]).size()
    assert cells.count() == len(exact) < 4000 and cells.agg(F.sum("n")).first()[0] == 4000
    assert sorted(r.n for r in cells.collect()) == sorted(exact)


def test_bootstrap_counts_are_poisson():
    keys, n = np.arange(200_000, dtype=np.uint64), np.repeat([1, 40, 100_000], [150_000, 40_000, 10_000])
    w = FO.bootstrap_counts(keys, n, 3, 42)
    for c in (1, 40, 100_000):
        got = w[n == c]
        assert got.mean() == pytest.approx(c, abs=5 * (c / len(got)) ** 0.5) and got.var() == pytest.approx(c, rel=0.06)
    back = np.random.default_rng(0).permutation(len(keys))
    assert (FO.bootstrap_counts(keys[back], n[back], 3, 42) == w[back]).all()        # whatever the order
    assert not np.array_equal(FO.bootstrap_counts(keys, n, 4, 42), w)


def test_forest_agrees_with_its_draws(spark, data):
    """Every node's counts are the drawn cells inside its bounds; no split of the root beats the one taken of all features."""
    stages = M.assemble_stages(FEATS, FO.CellForest(M.random_forest(6, 5, 3, label="label")), impute=False, scale=False)
    model = stages.fit(data)
    rows = model.stages[0].transform(data)
    cells, edges = FO._cells_of(rows, "features", "label", 128)
    table = cells.toPandas()
    x = np.array([list(b) for b in table["bins"]])
    y, keys = table["y"].to_numpy(), table["k"].to_numpy().view(np.uint64)
    mids = [np.r_[e, np.inf][x[:, f]] for f, e in enumerate(edges)]      # a bin's upper threshold
    forest = model.stages[-1]
    assert forest.getNumTrees == 6 and forest.numFeatures == 3
    seen = 0
    for t, nodes in T.node_table(forest, spark).toPandas().groupby("tree"):
        w = FO.bootstrap_counts(keys, table["n"].to_numpy(), int(t), 42)
        for r in nodes.itertuples():
            inside = np.all([(m > lo) & (m <= hi) for m, lo, hi in zip(mids, r.lo, r.hi)], axis=0)
            assert list(r.counts) == [w[inside & (y == 0)].sum(), w[inside & (y == 1)].sum()]
            assert r.rows >= 3 and r.depth <= 5
            seen += 1
    assert seen > 60
    assert forest.featureImportances.toArray().sum() == pytest.approx(1.0)


def test_forest_scores_like_sparks(spark, data):
    own = M.assemble_stages(FEATS, FO.CellForest(M.random_forest(30, 6, label="label")), impute=False).fit(data)
    sparks = M.assemble_stages(FEATS, M.random_forest(30, 6, label="label"), impute=False).fit(data)
    auc = [V.roc_auc(M.score(m, data, ["label"])).first()["auc"] for m in (own, sparks)]
    assert auc[0] == pytest.approx(auc[1], abs=0.01) and auc[0] > 0.9
    assert np.allclose(own.stages[-1].featureImportances.toArray(), sparks.stages[-1].featureImportances.toArray(), atol=0.08)
    again = M.assemble_stages(FEATS, FO.CellForest(M.random_forest(30, 6, label="label")), impute=False).fit(data.repartition(3))
    a, b = M.score(own, data, ["row_key"]), M.score(again, data, ["row_key"])
    assert a.join(b.withColumnRenamed("score", "other"), "row_key").where(F.abs(F.col("score") - F.col("other")) > 1e-9).count() == 0
    loaded = M.load_model(M.save_model(own, spark, "cell_forest"))
    assert sorted(map(tuple, M.score(loaded, data, ["row_key"]).collect())) == sorted(map(tuple, a.collect()))


def test_boosting_on_cells_is_boosting_on_rows(spark, data):
    """Few values a feature: the same trees, thresholds and scores as Spark's fit on the rows."""
    own = M.assemble_stages(FEATS, FO.CellBoosting(M.gradient_boosting(8, 3, 0.1, label="label")), impute=False).fit(data)
    sparks = M.assemble_stages(FEATS, M.gradient_boosting(8, 3, 0.1, label="label"), impute=False).fit(data)
    a, b = M.score(own, data, ["row_key"]), M.score(sparks, data, ["row_key"]).select("row_key", F.col("score").alias("other"), F.col("pred").alias("p"))
    assert a.join(b, "row_key").where((F.abs(F.col("score") - F.col("other")) > 1e-9) | (F.col("pred") != F.col("p"))).count() == 0
    assert own.stages[-1].getNumTrees == 8


def test_fits_shuffle_cells_not_rows(spark):
    """Ten thousand rows of twenty kinds are at most twenty cells; a forest's passes read only them."""
    rows = spark.range(10_000).select(F.array((F.col("id") % 10).cast("double")).alias("x"), (F.col("id") % 2).cast("double").alias("y"))
    assert FO.cell_table(rows, FO.thresholds(rows, 1, 128)).count() <= 20


def test_accuracy_of_counted_rows(spark):
    rows = [("m", False, 1, 1), ("m", False, 0, 1), ("m", True, 1, 1), ("m", True, 1, 1), ("m", True, 0, 1), ("m", True, None, 1)]
    df = spark.createDataFrame(rows, "model string, is_test boolean, label int, pred int")
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("w"))
    a, b = V.accuracy_gap(df, "is_test", by=["model"]).first(), V.accuracy_gap(counted, "is_test", by=["model"], weight="w").first()
    assert a == b and a.train_acc == 0.5 and a.test_acc == pytest.approx(2 / 3)


def _cells(data):
    rows = M.assemble_stages(FEATS, None, impute=False, scale=False).fit(data).transform(data)
    cells, edges = FO._cells_of(rows, "features", "label", 128)
    return cells, edges, rows


@pytest.mark.parametrize("finish", [0, 300, 10**6])
def test_deep_trees_hold_their_draws(spark, data, finish):
    """Counts of every node are the drawn cells inside it, whether levels or tasks grew it; no leaf could still be split."""
    cells, edges, _ = _cells(data)
    sizes = [len(e) + 1 for e in edges]
    forest = FO.grow_deep(cells, sizes, 3, 30, 2, 3, 42, finish)
    table = cells.toPandas()
    x, y = np.array([list(b) for b in table["bins"]]), table["y"].to_numpy()
    keys, n = table["k"].to_numpy().view(np.uint64), table["n"].to_numpy()
    assert len(forest) == 3
    for t, tree in enumerate(forest):
        w = FO.bootstrap_counts(keys, n, t, 42)
        inside = {0: w > 0}
        assert len(tree["left"]) > 100
        for i, (f, b, left) in enumerate(zip(tree["feature"], tree["bin"], tree["left"])):
            here = inside.pop(i)
            own = [w[here & (y == c)].sum() for c in (0, 1)]
            assert [tree["n0"][i], tree["n1"][i]] == own and sum(own) >= 2
            if left >= 0:
                assert left > i
                inside[left], inside[left + 1] = here & (x[:, f] <= b), here & (x[:, f] > b)
            elif min(own) > 0:             # all features are offered: what is left has no split that gains
                for g in range(3):
                    for c in range(sizes[g] - 1):
                        low = [w[here & (y == k) & (x[:, g] <= c)].sum() for k in (0, 1)]
                        high = [own[0] - low[0], own[1] - low[1]]
                        assert sum(low) < 2 or sum(high) < 2 or low[0] * high[1] == pytest.approx(low[1] * high[0])


def test_finished_subtrees_do_not_depend_on_partitions_or_chunks(spark, data, monkeypatch):
    cells, edges, _ = _cells(data)
    sizes = [len(e) + 1 for e in edges]
    a = FO.grow_deep(cells, sizes, 4, 30, 1, 2, 7, 300)
    monkeypatch.setattr(FO, "COUNTS_AT_ONCE", 64)
    b = FO.grow_deep(cells.repartition(3), sizes, 4, 30, 1, 2, 7, 300)
    for s, t in zip(a, b):
        assert all(np.array_equal(s[c], t[c]) for c in s)


def test_deep_forest_points_score_as_their_own_fits(spark, data):
    """A prefix ended at a depth scores as the forest that is fitted with that size and depth."""
    cells, edges, rows = _cells(data)
    forest = FO.deep_forest(cells, edges, M.random_forest(6, 30, 2, label="label"))
    points = FO.prefix_scores_of_cells(cells, forest, [2, 6], [3, 30]).toPandas()
    assert len(points) == 4 * cells.count()
    for t, d in ((2, 3), (6, 3), (2, 30), (6, 30)):
        model = FO.DeepForest(M.random_forest(t, d, 2, label="label")).fit(rows)
        assert model.getNumTrees == t and max(x.depth for x in model.trees) == (3 if d == 3 else max(x.depth for x in model.trees))
        got = points[(points["trees"] == t) & (points["depth"] == d)]
        own = M.score(model, rows, ["label"]).toPandas()
        assert np.allclose(np.sort(np.repeat(got["score"], got["n"])), np.sort(own["score"]), atol=1e-12)
        loaded = T.node_table(model, spark).toPandas()
        assert (loaded["rows"] >= 2).all() and len(loaded) > t
    with pytest.raises(ValueError):
        FO.prefix_scores_of_cells(cells, forest, [7], [3])


def test_deep_forest_scores_like_sparks(spark, data):
    own = M.assemble_stages(FEATS, FO.DeepForest(M.random_forest(30, 30, 5, label="label")), impute=False).fit(data)
    sparks = M.assemble_stages(FEATS, M.random_forest(30, 30, 5, label="label"), impute=False).fit(data)
    auc = [V.roc_auc(M.score(m, data, ["label"])).first()["auc"] for m in (own, sparks)]
    assert auc[0] == pytest.approx(auc[1], abs=0.01) and auc[0] > 0.9
    nodes = [m.stages[-1].totalNumNodes for m in (own, sparks)]
    assert nodes[0] == pytest.approx(nodes[1], rel=0.1)


def test_trees_of_several_leaf_sizes_grow_as_one(spark, data, monkeypatch):
    """Together or alone, node by node or all at once: the same trees; the draws by level give the forest of the level passes."""
    cells, edges, _ = _cells(data)
    sizes = [len(e) + 1 for e in edges]
    x, y, n, keys = FO._on_driver(cells, 3)
    assert len(x) == cells.count() and n.sum() == 4000 and (np.diff(n) >= 0).all()
    draw = lambda level, m: np.random.default_rng([5, level]).random((m, 3))
    w = FO.bootstrap_counts(keys, n, 1, 42)
    both = FO.grow_subtrees(x, y, w, sizes, 30, [1, 5], 2, draw)
    monkeypatch.setattr(FO, "APART", 10**9)
    for least, tree in zip((1, 5), both):
        alone = FO.grow_subtree(x, y, w, sizes, 30, least, 2, draw)
        assert all(np.array_equal(alone[c], tree[c]) for c in tree)
    assert len(both[0]["left"]) > len(both[1]["left"])
    passes = FO.grow_forest(cells, sizes, 3, 6, 2, 2, 42, finish=0)
    for a, b in zip(passes, FO.grow_forest(cells, sizes, 3, 6, 2, 2, 42)):
        assert all(np.array_equal(a[c], b[c]) for c in a)


def test_grid_scores_in_tasks_are_those_of_the_whole_forest(spark, data, monkeypatch):
    cells, edges, _ = _cells(data)
    forests = [M.random_forest(6, 30, m, label="label") for m in (1, 4)]
    monkeypatch.setattr(FO, "TREES_AT_ONCE", 2)
    monkeypatch.setattr(FO, "SCORES_AT_ONCE", 100)

    def counted(found):
        found = found.toPandas()
        return found.assign(score=found["score"].round(9)).groupby(["trees", "depth", "y", "score"])["n"].sum()

    scores = FO.grid_scores(cells, cells, edges, forests, [3, 6], [3, 30])
    for m, forest in zip((1, 4), forests):
        whole = FO.prefix_scores_of_cells(cells, FO.deep_forest(cells, edges, forest), [3, 6], [3, 30])
        assert counted(scores.where(F.col("least") == m)).equals(counted(whole))
    with pytest.raises(ValueError):
        FO.grid_scores(cells, cells, edges, forests, [7], [3])
    monkeypatch.setattr(FO, "FINISH_CELLS", 0)         # too many cells for one task
    assert FO.grid_scores(cells, cells, edges, forests, [3, 6], [3, 30]).agg(F.sum("n")).first()[0] == 8 * 4000


def test_cells_score_as_their_rows(spark, data):
    gaps = data.withColumn("c", F.when(F.col("c") > 0, F.col("c")))
    for e, df in ((FO.CellForest(M.random_forest(5, 4, label="label")), gaps), (FO.CellBoosting(M.gradient_boosting(5, 3, label="label")), gaps),
                  (M.decision_tree(3, label="label"), data)):
        model = M.assemble_stages(FEATS, e, impute=False).fit(df)
        counts, rows = M.counted_scores(model, df, "label"), M.score(model, df, ["label"])
        by = ["label", "pred", "score"]
        assert sorted(map(tuple, counts.groupBy(*by).agg(F.sum("rows")).collect())) == sorted(map(tuple, rows.groupBy(*by).count().collect()))


def test_boosting_in_a_task_is_sparks_fit_on_cells(spark, data, monkeypatch):
    est = lambda: M.assemble_stages(FEATS, FO.CellBoosting(M.gradient_boosting(12, 3, 0.1, label="label")), impute=False)
    own = est().fit(data)
    monkeypatch.setattr(FO, "FINISH_CELLS", 0)
    sparks = est().fit(data)
    a, b = (M.score(m, data, ["row_key"]) for m in (own, sparks))
    assert a.join(b.withColumnRenamed("score", "other"), "row_key").where(F.abs(F.col("score") - F.col("other")) > 1e-9).count() == 0
    assert own.stages[-1].getNumTrees == 12 and own.stages[-1].treeWeights == sparks.stages[-1].treeWeights
    nodes = [T.node_table(m.stages[-1], spark).toPandas()[["tree", "depth", "feature", "threshold"]].sort_values(["tree", "depth", "feature"]) for m in (own, sparks)]
    assert len(nodes[0]) == len(nodes[1])
