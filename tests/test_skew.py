"""One key / value holding a third of the rows: results stay exact (checked against pandas)."""

import numpy as np
import pandas as pd
import pytest

from sparkwright.operators import evaluate as V
from sparkwright.operators import profile as P
from sparkwright.operators.quantile import exact_quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    n = 30000
    key = np.where(np.arange(n) < n // 3, "hot", rng.choice(["a", "b", "c", "d"], n))
    value = np.where(np.arange(n) % 3 == 0, 7.0, rng.normal(100, 20, n).round(2))
    label = (rng.random(n) < 0.4).astype(int)
    score = np.where(np.arange(n) % 2 == 0, 0.5, rng.random(n).round(3))
    pdf = pd.DataFrame({"k": key, "v": value, "label": label, "score": score})
    return pdf, spark.createDataFrame(pdf).repartition(6)


def test_group_stats_hot_key(spark, skewed):
    pdf, df = skewed
    got = P.group_stats(df, "k", "v").toPandas().set_index("k").sort_index()
    exp = pdf.groupby("k")["v"].agg(["mean", "std", "count"]).sort_index()
    assert np.allclose(got["mean"], exp["mean"]) and np.allclose(got["std"], exp["std"])
    assert (got["count"].values == exp["count"].values).all()


def test_grouped_exact_quantiles_hot_key_and_value(spark, skewed):
    pdf, df = skewed
    for few in (True, False):
        got = exact_quantiles(df, ["v"], [0.1, 0.5, 0.9], by=["k"], few_groups=few).toPandas()
        for (k, p), g in got.groupby(["k", "prob"]):
            assert g["value"].iloc[0] == pytest.approx(pdf.loc[pdf.k == k, "v"].quantile(p), abs=1e-9)


def test_auc_with_a_hot_score(spark, skewed):
    pdf, df = skewed
    got = V.roc_auc(df).first()["auc"]
    r = pdf["score"].rank()
    n1, n0 = pdf.label.sum(), (1 - pdf.label).sum()
    exp = (r[pdf.label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)
    assert got == pytest.approx(exp, abs=1e-12)


def test_duplicates_with_a_hot_group(spark, skewed):
    pdf, df = skewed
    d = P.duplicate_count(df.select("k", "v")).first()
    assert d["duplicates"] == int(pdf[["k", "v"]].duplicated().sum())


def test_bootstrap_with_hot_scores_and_ties(spark):
    """Replicate by replicate against numpy: two scores hold most rows, so their segments are dealt to lanes."""
    from sparkwright.operators.evaluate import _weights
    rng = np.random.default_rng(8)
    n, reps = 3000, 12
    y = (rng.random(n) < 0.4).astype(int)
    scores = {"a": np.where(rng.random(n) < 0.4, 0.5, rng.random(n).round(2)), "b": np.where(rng.random(n) < 0.9, 0.25, (rng.random(n) + y).round(3))}
    rows = [(m, f"k{i}", int(y[i]), float(s[i])) for m, s in scores.items() for i in range(n)]
    df = spark.createDataFrame(rows, "model string, row_key string, label int, score double").repartition(5)
    got = {r.replicate: (r.auc_a, r.auc_b) for r in V.bootstrap_auc_difference(df, "a", "b", reps, 42).collect()}
    w = _weights([f"k{i}" for i in range(n)], reps, 42).astype(float)
    for r in range(reps):
        for j, s in enumerate(scores.values()):
            wins = sum(w[:, r][(s == v) & (y == 1)].sum() * (w[:, r][(s < v) & (y == 0)].sum() + w[:, r][(s == v) & (y == 0)].sum() / 2) for v in np.unique(s))
            assert got[r + 1][j] == pytest.approx(wins / (w[:, r][y == 1].sum() * w[:, r][y == 0].sum()), abs=1e-12)


def test_bootstrap_shuffles_no_vectors(spark, skewed):
    """Every exchange below the sums carries narrow rows; only segments x replicates rows come after them."""
    _, df = skewed
    two = df.selectExpr("inline(array(struct('a' AS model, score), struct('b' AS model, v AS score)))", "label", "k AS row_key")
    plan = V.bootstrap_auc_difference(two, "a", "b", 50)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow"):]
    assert "binary" not in below and "array<double>" not in below and "Exchange" in below


def test_class_weights_do_not_shuffle_rows_by_label(spark, monkeypatch):
    """A few classes' weights are broadcast; many are joined. Both give n / (K n_k), and rows without a label go."""
    from sparkwright.operators import features as FE
    df = spark.createDataFrame([(i, None if i == 0 else int(i % 10 == 1)) for i in range(400)], "k int, label int").repartition(4)
    few = FE.with_class_weights(df, "label")
    assert "Exchange hashpartitioning(label" not in few._jdf.queryExecution().executedPlan().toString()
    rows = {r.k: r.weight for r in few.collect()}
    assert len(rows) == 399 and rows[1] == pytest.approx(400 / (3 * 40)) and rows[2] == pytest.approx(400 / (3 * 359))
    monkeypatch.setattr(FE, "FEW_CLASSES", 1)
    assert sorted(map(tuple, FE.with_class_weights(df, "label").collect())) == sorted(map(tuple, few.collect()))


def test_every_bootstrap_weight_has_its_own_hash(spark):
    """P9 draws row by replicate: the first word of md5(key|replicate|seed)."""
    import hashlib
    from sparkwright.functions.hashing import POISSON1_CDF
    keys = [f"k{i}" for i in range(40)]
    got = {r.replicate: (r.drawn_rows, r.total_weight) for r in V.bootstrap_draws(spark.createDataFrame([(k,) for k in keys], "k string"), "k", 9, 42).collect()}
    for r in range(1, 10):
        u = [int(hashlib.md5(f"{k}|{r}|42".encode()).hexdigest()[:8], 16) / 2 ** 32 for k in keys]
        w = [sum(x >= c for c in POISSON1_CDF) for x in u]
        assert got[r] == (sum(x > 0 for x in w), sum(w))
