"""Model stage: parameter translations against closed forms, custom stages, persistence."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from sparkwright.operators import evaluate as V
from sparkwright.operators import models as M
from tests.conftest import SF0001

FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@pytest.fixture(scope="module")
def data(spark):
    li = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    df = li.select(*FEATS, (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("net"))
    med = df.approxQuantile("net", [0.5], 0.0)[0]
    return df.withColumn("label", (F.col("net") > med).cast("double"))


def _scaled(pdf):
    x = pdf[FEATS].to_numpy()
    return (x - x.mean(0)) / x.std(0)


def test_custom_stages_match_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, None, 3.0, 10.0, None, 4.0], "b": [3.0] * 6})
    df = spark.createDataFrame(pdf)
    imp = M.ExactMedianImputer(inputCols=["a", "b"]).fit(df)
    assert imp.getOrDefault(imp.stats) == [pdf["a"].median(), 3.0]
    filled = imp.transform(df)
    sc = M.PopulationStandardScaler(inputCols=["a", "b"]).fit(filled)
    out = sc.transform(filled).toPandas()
    a = pdf["a"].fillna(pdf["a"].median())
    assert np.allclose(out["a"], (a - a.mean()) / a.std(ddof=0))
    assert (out["b"] == 0.0).all()  # constant column centred, not scaled


def test_ridge_translation_matches_closed_form(spark, data):
    pdf = data.toPandas()
    x, y = _scaled(pdf), pdf["net"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 1.0 * np.eye(len(FEATS)), xc.T @ yc)
    st = M.PopulationStandardScaler(inputCols=FEATS).fit(data)
    va = VectorAssembler(inputCols=FEATS, outputCol="features")
    prepared = va.transform(st.transform(data))
    n, sd = M.train_size_and_label_std(data, "net")
    model = M.ridge(1.0, n, sd, "net").fit(prepared)
    assert np.allclose(model.coefficients.toArray(), w, rtol=1e-6, atol=1e-6)


def test_logistic_translation_matches_newton(spark, data):
    pdf = data.toPandas()
    x, y = _scaled(pdf), pdf["label"].to_numpy()
    n = len(y)
    cw = {k: n / (2 * (y == k).sum()) for k in (0.0, 1.0)}
    sw = np.array([cw[v] for v in y])
    C = 1.0
    X = np.hstack([np.ones((n, 1)), x])
    beta = np.zeros(X.shape[1])
    for _ in range(50):  # Newton on C * sum w logloss + 0.5 ||coef||^2 (intercept unpenalised)
        p = 1 / (1 + np.exp(-X @ beta))
        pen = np.diag([0.0] + [1.0] * len(FEATS))
        g = C * X.T @ (sw * (p - y)) + pen @ beta
        H = C * (X * (sw * p * (1 - p))[:, None]).T @ X + pen
        beta -= np.linalg.solve(H, g)
    st = M.PopulationStandardScaler(inputCols=FEATS).fit(data)
    prepared = VectorAssembler(inputCols=FEATS, outputCol="features").transform(st.transform(data))
    prepared = prepared.withColumn("weight", F.when(F.col("label") == 1, cw[1.0]).otherwise(cw[0.0]))
    model = M.logistic(C, n, "label").fit(prepared)
    assert np.allclose(model.coefficients.toArray(), beta[1:], rtol=1e-3, atol=1e-3)
    assert model.intercept == pytest.approx(beta[0], rel=1e-3, abs=1e-3)


def test_pipeline_persistence_and_auc_evaluator(spark, data):
    pipe = M.assemble_stages(FEATS, M.decision_tree(5, label="label"))
    model = pipe.fit(data)
    loaded = M.load_model(M.save_model(model, spark, "tree_test"))
    a = M.score(model, data, FEATS).withColumnRenamed("score", "s1")
    b = M.score(loaded, data, FEATS).withColumnRenamed("score", "s2")
    assert a.select("s1").collect() == b.select("s2").collect()
    ev = M.RankSumAUC("label").evaluate(model.transform(data))
    auc = V.roc_auc(M.score(model, data, ["label"]).withColumn("label", F.col("label").cast("int"))).first()["auc"]
    assert ev == pytest.approx(auc) and ev > 0.95


def test_ols_quality(spark, data):
    model = M.assemble_stages(FEATS, M.ols("net"), impute=False).fit(data)
    p = model.transform(data).select("net", F.col("prediction").alias("p"))
    r2 = V.regression_metrics(p, "net", "p").first()["r2"]
    assert r2 > 0.99
