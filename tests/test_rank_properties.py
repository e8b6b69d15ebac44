"""The bucketed rank must equal pandas' average rank, for any bucket count, with ties,
groups and weights; folds and splits must be deterministic and balanced."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkwright.operators import features as FE
from sparkwright.operators.ranking import average_rank, descending_cumulative


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_average_rank_matches_pandas(spark, buckets):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 2000), "v": rng.integers(0, 150, 2000).astype(float)})
    pdf.loc[rng.choice(2000, 700, replace=False), "v"] = 42.0  # one value holds a third of the rows
    got = average_rank(spark.createDataFrame(pdf), "v", ["g"], buckets=buckets).toPandas()
    exp = pdf.assign(r=pdf.groupby("g")["v"].rank(method="average")).groupby(["g", "v"])["r"].first().reset_index()
    m = got.merge(exp, on=["g", "v"])
    assert len(m) == len(exp) == len(got)
    assert np.allclose(m["rank"], m["r"])


def test_weighted_rank_equals_replicated_rows(spark):
    pdf = pd.DataFrame({"v": [1.0, 2.0, 2.0, 3.0, 5.0], "w": [2, 1, 3, 0, 1]})
    got = average_rank(spark.createDataFrame(pdf), "v", weight="w", buckets=2).toPandas().set_index("v")["rank"]
    rep = pdf.loc[pdf.index.repeat(pdf["w"])]
    exp = rep.assign(r=rep["v"].rank()).groupby("v")["r"].first()
    assert got.sort_index().tolist() == exp.sort_index().tolist()


def test_descending_cumulative(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0)], "score double, label int")
    rows = {r["score"]: (r["tp"], r["fp"]) for r in descending_cumulative(df, "score", "label", buckets=2).collect()}
    assert rows == {0.9: (1.0, 0.0), 0.8: (2.0, 1.0), 0.1: (2.0, 2.0)}


def test_folds_balanced_per_class_and_deterministic(spark):
    df = spark.range(0, 1003).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    a = FE.stratified_folds(df, "k", "y", 5, 42)
    sizes = a.groupBy("y", "fold").count().toPandas()
    for _, g in sizes.groupby("y"):
        assert g["count"].max() - g["count"].min() <= 1 and len(g) == 5
    b = FE.stratified_folds(df.repartition(7), "k", "y", 5, 42)
    assert a.join(b.withColumnRenamed("fold", "fold2"), ["k", "y"]).where("fold <> fold2").count() == 0


def test_exact_split_size_and_nested_prefixes(spark):
    df = spark.range(0, 997).select(F.col("id").alias("k"))
    assert FE.split_flag(df, "k", 42, 0.2, exact=True).where("is_test").count() == 200
    small = {r["k"] for r in FE.nested_prefix(df, "k", 42, 0.2).collect()}
    big = {r["k"] for r in FE.nested_prefix(df, "k", 42, 0.6).collect()}
    assert len(small) == 199 and len(big) == 598 and small <= big


def test_spearman_equals_pandas_with_and_without_gaps(spark):
    from sparkwright.operators.correlation import spearman
    from tests.conftest import SF001
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    gaps = ev.withColumn("value", F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("value")))
    cols = ["event_id", "user_id", "value"]
    for df in (ev, gaps):
        a = {(r["col_a"], r["col_b"]): r["value"] for r in spearman(df, cols).collect()}
        pdf = df.select(*cols).toPandas().corr(method="spearman")
        assert len(a) == 3 and all(abs(v - pdf.loc[k]) < 1e-9 for k, v in a.items())


def test_pearson_blocks_equal_pandas(spark):
    from sparkwright.operators import correlation as C
    from tests.conftest import SF001
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_partkey"]
    wide = li.select(*[(F.col(c) * (i + 1) + F.col("l_suppkey")).alias(f"{c}{i}") for i in range(5) for c in cols])
    a = {(r["col_a"], r["col_b"]): r["value"] for r in C.pearson(wide, wide.columns).collect()}
    pdf = wide.toPandas().corr()
    assert len(a) == 30 * 29 // 2 and all(abs(v - pdf.loc[k]) < 1e-9 for k, v in a.items())


def test_ranks_beyond_one_level_of_buckets(spark):
    """More buckets than one search level holds: ranks equal pandas."""
    from sparkwright.operators import ranking as R
    df = spark.range(0, 30000).select((F.hash("id") % 20000).cast("double").alias("v"))
    pdf = df.toPandas()
    pdf["r"] = pdf["v"].rank()
    want = dict(zip(pdf["v"], pdf["r"]))
    out = R.average_rank(df, "v", buckets=700)
    got = {r["v"]: r["rank"] for r in out.collect()}
    assert got == want
    hist = R.histogram(df, "v")
    assert R.assign_buckets(hist, "v", None, 700).select("__bucket").distinct().count() > 600


def test_repeated_keys_keep_their_rows(spark):
    """20 keys with two rows each, labels 0 and 1: the bootstrap keeps all rows."""
    from sparkwright.operators import evaluate as V
    rows = [(m, f"k{i}", y, (i % 5) / 5 + y * 0.1 * (m == "a")) for i in range(20) for y in (0, 1) for m in ("a", "b")]
    df = spark.createDataFrame(rows, "model string, row_key string, label int, score double")
    out = V.bootstrap_auc_difference(df, "a", "b", 40).collect()
    assert len(out) == 40 and 0.55 < sum(r["auc_a"] for r in out) / 40 < 0.75
    assert abs(sum(r["auc_b"] for r in out) / 40 - 0.5) < 0.1


def test_quantiles_shuffle_only_candidates(spark):
    from sparkwright.operators.quantile import exact_quantiles
    import numpy as np
    df = spark.range(0, 40000).select((F.hash("id") / 1000.0).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 11).alias("b"))
    got = {(r["column_name"], r["prob"]): r["value"] for r in exact_quantiles(df, ["a", "b"], [0.0, 0.1, 0.5, 0.975, 1.0]).collect()}
    pdf = df.toPandas()
    assert len(got) == 10
    for (c, p), v in got.items():
        assert abs(v - np.quantile(pdf[c].dropna(), p)) < 1e-9



def test_wide_pearson_with_gaps(spark):
    """200 columns, each with gaps of its own, some constant, far from zero: pandas' pairwise-complete matrix, one Python pass."""
    import numpy as np
    import pandas as pd
    from sparkwright.operators import correlation as C
    rng = np.random.default_rng(4)
    base = rng.normal(size=(400, 6))
    x = base @ rng.normal(size=(6, 200)) + rng.normal(size=(400, 200)) * 0.3 + rng.integers(0, 10**6, 200)
    x[rng.random(x.shape) < 0.15] = np.nan
    x[:, 7], x[:, 8] = 3.0, np.nan
    x[1:, 9] = np.nan
    x[:, 10] = np.where(np.isnan(x[:, 11]), x[:, 10], 5.0)       # constant wherever column 11 is there
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(200)])
    tall = C.pearson(spark.createDataFrame(pdf).repartition(4), list(pdf.columns))
    assert tall._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 2        # one pass, read by both sides of the pairs
    got = {(r.ord_a, r.ord_b): r.value for r in tall.collect()}
    with np.errstate(all="ignore"):
        exp = pdf.corr(min_periods=2).to_numpy()
    assert len(got) == 200 * 199 // 2
    for (i, j), v in got.items():
        e = None if np.isnan(exp[i, j]) or {i, j} & {7, 8, 9} or (i, j) == (10, 11) else exp[i, j]
        assert (v is None) == (e is None) and (v is None or abs(v - e) < 1e-8), (i, j, v, e)


def test_fold_tasks_do_not_grow_with_the_rows(spark, monkeypatch):
    """More rows are dealt by more tasks, evenly, to the same folds."""
    df = spark.range(60_000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 2).cast("int").alias("y"))
    few = {r.k: r.fold for r in FE.stratified_folds(df, "k", "y", 5, 42).collect()}
    monkeypatch.setattr(FE, "FOLD_ROWS", 2_000)
    dealt = FE.stratified_folds(df, "k", "y", 5, 42)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 30 and max(sizes) <= 2_500
    assert {r.k: r.fold for r in dealt.collect()} == few
