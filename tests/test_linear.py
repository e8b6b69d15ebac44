"""Linear fits from sums, Newton's weights and gradient, and compiled pipelines against the fitted ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.operators import linear as L
from sparkwright.operators import models as M
from tests.conftest import SF0001

FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@pytest.fixture(scope="module")
def data(spark):
    li = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    df = li.select(F.monotonically_increasing_id().alias("row_key"), *FEATS,
                   (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("net"))
    med = df.approxQuantile("net", [0.5], 0.0)[0]
    gaps = {c: F.expr(f"nullif({c}, 0)") for c in ("l_discount", "l_tax")}
    return df.withColumn("label", (F.col("net") > med).cast("double")).withColumns(gaps).cache()


def test_ridge_path_matches_closed_form(spark, data):
    full = data.na.fill(0.0)
    pdf = full.toPandas()
    x, y = pdf[FEATS].to_numpy(), pdf["net"].to_numpy()
    z, yc = (x - x.mean(0)) / x.std(0), y - y.mean()
    for alpha, s in zip((0.0, 1.0, 500.0), L.least_squares(full, FEATS, "net", [0.0, 1.0, 500.0])):
        w = np.linalg.solve(z.T @ z + alpha * np.eye(4), z.T @ yc)
        assert np.allclose(s.coefficients, w, rtol=1e-9) and s.intercept == pytest.approx(y.mean())
        pred = np.array([r.pred for r in s.predict(full, ["row_key"]).orderBy("row_key").collect()])
        assert np.allclose(pred, z @ w + y.mean())


def test_gram_leaves_incomplete_rows_out(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 5.0), (3.0, float("nan")), (4.0, 1.0)], "a double, b double")
    assert L.gram(df, [F.col("a"), F.col("b")]).tolist() == [[17.0, 6.0], [6.0, 5.0]]
    assert L.gram(df.limit(0), [F.col("a")]).tolist() == [[0.0]]


@pytest.mark.parametrize("C", [1.0, 0.01])
def test_newton_matches_numpy_and_ends_at_a_stationary_point(spark, data, C):
    full = data.na.fill(0.0)
    pdf = full.toPandas()
    x, y = pdf[FEATS].to_numpy(), pdf["label"].to_numpy()
    z = np.c_[np.ones(len(x)), (x - x.mean(0)) / x.std(0)]
    pen, beta = np.array([0.0] + [1.0] * 4), np.zeros(5)
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ beta))
        beta -= np.linalg.solve(C * (z * (p * (1 - p))[:, None]).T @ z + np.diag(pen), C * z.T @ (p - y) + pen * beta)
    fit = L.logistic_newton(full, FEATS, "label", C)
    assert fit.gradient < 1e-6 and fit.steps < 30
    assert np.allclose([fit.scorer.intercept, *fit.scorer.coefficients], beta, rtol=1e-7, atol=1e-8)


@pytest.mark.parametrize("impute", [True, False])
def test_compiled_pipeline_equals_the_fitted_one(spark, data, impute):
    """Every row, missing values included, scored by columns and by the pipeline's own stages."""
    fitted = M.assemble_stages(FEATS, M.logistic(1.0, data.count(), "label", weight=None), impute=impute).fit(
        data if impute else data.na.fill(0.0))
    mine, theirs = L.compile_pipeline(fitted).predict(data, ["row_key"]), M.score(fitted, data, ["row_key"])
    both = mine.alias("a").join(theirs.alias("b"), "row_key")
    same = (F.abs(F.col("a.score") - F.col("b.score")) < 1e-12) | (F.isnan("a.score") & F.isnan("b.score"))
    assert both.count() == data.count() and both.where(~same | (F.col("a.pred") != F.col("b.pred"))).count() == 0
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "Python" not in plan


def test_compiled_regression(spark, data):
    fitted = M.assemble_stages(FEATS, M.ols("net")).fit(data)
    mine = L.compile_pipeline(fitted).predict(data, ["row_key"])
    theirs = fitted.transform(data).select("row_key", "prediction")
    assert mine.join(theirs, "row_key").where(F.abs(F.col("pred") - F.col("prediction")) > 1e-6).count() == 0


def test_only_linear_pipelines_compile(spark, data):
    with pytest.raises(ValueError):
        L.compile_pipeline(M.assemble_stages(FEATS, M.decision_tree(2, label="label")).fit(data.na.fill(0.0)))
