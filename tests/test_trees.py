"""Node tables: counts, bounds and impurities against the rows, the split minimum, importances, walks and forest prefixes."""

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sparkwright.operators import models as M
from sparkwright.operators import trees as T

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = np.c_[rng.integers(0, 40, 3000), rng.normal(size=3000).round(2), rng.integers(0, 5, 3000)]
    y = ((x[:, 0] > 20) ^ (x[:, 1] > 0.3) ^ (rng.random(3000) < 0.15)).astype(float)
    return spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                                 "row_key long, a double, b double, c double, label double").repartition(4).cache()


@pytest.fixture(scope="module")
def tree(data):
    return M.assemble_stages(FEATS, M.decision_tree(None, label="label"), impute=False, scale=False).fit(data)


@pytest.fixture(scope="module")
def forest(data):
    return M.assemble_stages(FEATS, M.random_forest(12, 6, label="label"), impute=False).fit(data)


def test_every_node_agrees_with_its_rows(spark, data, tree):
    """The rows inside a node's bounds give its counts and its Gini impurity; children split them by the threshold."""
    rows = data.toPandas()
    x, y = rows[FEATS].to_numpy(), rows["label"].to_numpy()
    nodes = {r.node: r for r in T.node_table(tree.stages[-1], spark).collect()}
    assert len(nodes) > 100
    for r in nodes.values():
        inside = ((x > np.array(r.lo)) & (x <= np.array(r.hi))).all(axis=1)
        n1, n = y[inside].sum(), inside.sum()
        assert r.rows == n and r.counts == [n - n1, n1]
        assert r.impurity == pytest.approx(1 - (n1 / n) ** 2 - (1 - n1 / n) ** 2)
        if r.left >= 0:
            a, b = nodes[r.left], nodes[r.right]
            assert a.parent == b.parent == r.node and a.depth == b.depth == r.depth + 1 and a.rows + b.rows == r.rows
            assert r.gain == pytest.approx(r.impurity - a.rows / n * a.impurity - b.rows / n * b.impurity)


def test_leaf_numbers_are_the_models(spark, data, tree):
    nodes = {r.leaf: r.counts for r in T.node_table(tree.stages[-1], spark).where("leaf >= 0").collect()}
    vectors = tree.stages[0].transform(data)
    got = tree.stages[-1].copy().setLeafCol("leaf").transform(vectors).groupBy("leaf").agg(F.sum("label").alias("n1"), F.count("*").alias("n")).collect()
    assert {int(r.leaf): [r.n - r.n1, r.n1] for r in got} == nodes


@pytest.mark.parametrize("largest", [0, 10**6])
def test_walks_score_as_the_model(spark, data, tree, monkeypatch, largest):
    """Both forms of the walk, also for missing values."""
    monkeypatch.setattr(T, "LARGEST_CASE", largest)
    gaps = data.withColumn("b", F.when(F.col("row_key") % 7 == 0, None).otherwise(F.col("b")))
    if largest:
        small = M.assemble_stages(FEATS, M.decision_tree(4, label="label"), impute=False, scale=False).fit(data)
    else:
        small = tree
    nodes = T.node_table(small.stages[-1], spark).collect()
    mine = gaps.select("row_key", T.walk(nodes, [F.col(f) for f in FEATS], T.leaf_shares(nodes)).alias("p"))
    model = M.score(small, gaps, ["row_key"])
    assert mine.join(model, "row_key").where(F.abs(F.col("p") - F.col("score")) > 1e-12).count() == 0


def test_split_minimum(spark, data):
    """No split node under 20 rows, leaves under 10 occur, what is left is the free tree's, and the pipeline saves and loads."""
    free = M.assemble_stages(FEATS, M.decision_tree(8, label="label"), impute=False).fit(data)
    kept = M.assemble_stages(FEATS, M.decision_tree(8, min_split=20, label="label"), impute=False).fit(data)
    nodes = kept.stages[-1].node_rows()
    whole = {r.node: r for r in T.node_table(free.stages[-1], spark).collect()}
    assert len(nodes) < len(whole) and all(r["rows"] >= 20 for r in nodes if r["left"] >= 0)
    assert min(r["rows"] for r in nodes) < 10
    for r in nodes:
        w = whole[r["node"]]
        assert r["counts"] == w.counts and (r["left"] == w.left if w.left < 0 or w.rows >= 20 else r["left"] == -1)
    loaded = M.load_model(M.save_model(kept, spark, "collapsed"))
    a, b = M.score(kept, data, ["row_key"]), M.score(loaded, data, ["row_key"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    # leaves' training shares are their rows' own
    leaves = a.groupBy("score").agg(F.count("*").alias("n")).agg(F.sum("n")).first()[0]
    assert leaves == data.count()
    pairs = M.score(kept, data, ["label"]).groupBy("score").agg(F.avg("label").alias("y"), F.count("*").alias("n")).collect()
    assert all(r.y == pytest.approx(r.score) for r in pairs)


def test_importances_equal_sparks_and_sqls(spark, data, forest, tmp_path):
    nodes = T.node_table(forest.stages[-1], spark)
    got = {r.feature: r.importance for r in T.importances(nodes).collect()}
    exact = forest.stages[-1].featureImportances.toArray()
    assert all(got.get(i, 0.0) == pytest.approx(v, abs=1e-12) for i, v in enumerate(exact))
    path = str(tmp_path / "nodes")
    nodes.write.parquet(path)
    sql = duckdb.sql(f"""WITH g AS (SELECT tree, feature, sum(gain * list_sum(counts)) AS g FROM read_parquet('{path}/*.parquet') WHERE "left" >= 0 GROUP BY ALL),
        s AS (SELECT feature, sum(share) AS s FROM (SELECT feature, g / sum(g) OVER (PARTITION BY tree) AS share FROM g) GROUP BY feature)
        SELECT feature, s / sum(s) OVER () FROM s""").fetchall()
    assert {f: pytest.approx(v) for f, v in sql} == got


def test_forest_prefixes(spark, data, forest):
    """t trees score as the mean of the first t trees' own probabilities; all trees as the forest."""
    sizes = [1, 5, 12]
    got = T.prefix_scores(forest, data, sizes, ["row_key"]).toPandas().pivot(index="row_key", columns="trees", values="score")
    rows = data
    for stage in forest.stages[:-1]:
        rows = stage.transform(rows)
    each = []
    for t in forest.stages[-1].trees:
        p = t.transform(rows).select("row_key", vector_to_array("probability")[1].alias("p")).toPandas().set_index("row_key")["p"]
        each.append(p.sort_index())
    for s in sizes:
        assert np.allclose(got[s], np.mean(each[:s], axis=0), atol=1e-12)
    whole = M.score(forest, data, ["row_key"]).toPandas().set_index("row_key")["score"].sort_index()
    assert np.allclose(got[12], whole, atol=1e-12)
    with pytest.raises(ValueError):
        T.prefix_scores(forest, data, [13], ["row_key"])


def test_cut_depths(spark, data, forest):
    """A forest cut at depth d: every tree stops at its nodes of depth d, which score with their own counts."""
    got = T.prefix_scores(forest, data, [12], ["row_key"], [2, 6]).toPandas()
    rows = data
    for stage in forest.stages[:-1]:
        rows = stage.transform(rows)
    x = rows.select("row_key", *FEATS).toPandas().set_index("row_key")
    total = 0
    for _, tree in T.node_table(forest.stages[-1], spark).toPandas().groupby("tree"):
        nodes = {r.node: r for r in tree.itertuples()}

        def share(row):
            r = nodes[0]
            while r.left >= 0 and r.depth < 2:
                r = nodes[r.left if row[r.feature] <= r.threshold else r.right]
            return r.counts[1] / sum(r.counts)
        total = total + x.apply(lambda row: share(row.to_numpy()), axis=1)
    cut = got[got.depth == 2].set_index("row_key")["score"].sort_index()
    assert np.allclose(cut, (total / 12).sort_index(), atol=1e-12)
    whole = M.score(forest, data, ["row_key"]).toPandas().set_index("row_key")["score"].sort_index()
    assert np.allclose(got[got.depth == 6].set_index("row_key")["score"].sort_index(), whole, atol=1e-12)


def test_grid_points_equal_a_fold_by_fold_search(spark, data):
    """A small grid against fits and scores made one by one."""
    from sparkwright.operators import evaluate as V
    from sparkwright.operators import features as FE
    folded = FE.stratified_folds(data.withColumn("y", F.col("label").cast("int")), "row_key", "y", 3, 1).cache()
    grid = {"numTrees": [2, 6], "maxDepth": [2, 3], "minInstancesPerNode": [1, 40]}
    found = M.forest_grid_search(folded, FEATS, grid, k=3)
    rows = found.table.collect()
    assert len(rows) == 8
    table = {(r.numTrees, r.minInstancesPerNode): r.cv_auc for r in rows if r.maxDepth == 3}
    for leaf in (1, 40):
        aucs = []
        for i in range(3):
            m = M.assemble_stages(FEATS, M.random_forest(6, 3, leaf, label="label")).fit(folded.where(F.col("fold") != i))
            aucs.append(V.roc_auc(M.score(m, folded.where(F.col("fold") == i), ["label"])).first()["auc"])
        assert table[6.0, float(leaf)] == pytest.approx(np.mean(aucs), abs=0.02)
    best = max(rows, key=lambda r: (r.cv_auc, -r.numTrees, -r.maxDepth, -r.minInstancesPerNode))
    assert found.bestModel.stages[-1].getNumTrees == best.numTrees
