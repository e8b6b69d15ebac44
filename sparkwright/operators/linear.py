"""Linear models as aggregates and as plain columns.

A least-squares or ridge fit needs one Gram matrix, a logistic fit one weighted Gram matrix and gradient per Newton
step: k(k+3)/2 sums in one aggregate with map-side partial sums, whatever the number of rows. Only these sums reach
the driver, where a k x k system is solved. A fitted pipeline (median fill, scaling, linear or logistic model) is
compiled to a ``LinearScorer``, whose prediction is column arithmetic inside generated code: no vector, no stage
objects, and the same expression can be written in SQL.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from sparkwright.functions.numeric import nan_to_null
from sparkwright.operators.quantile import quantile_wide


# ---------------------------------------------------------------- scoring as columns
@dataclass(frozen=True)
class LinearScorer:
    """(fill, centre, scale) per feature, coefficients and intercept; ``logistic`` adds the probability of class 1."""
    features: list
    coefficients: list
    intercept: float = 0.0
    means: list | None = None
    stds: list | None = None
    medians: list | None = None
    logistic: bool = True
    threshold: float = 0.5

    def inputs(self) -> list[Column]:
        """The model's inputs: filled and scaled features. A missing value without a fill is NaN, as in an assembled vector."""
        out = []
        for i, f in enumerate(self.features):
            x = nan_to_null(F.col(f"`{f}`").cast("double"))
            x = F.coalesce(x, F.lit(float("nan") if self.medians is None else float(self.medians[i])))
            if self.means is not None:
                x = (x - F.lit(float(self.means[i]))) / F.lit(float(self.stds[i]) if self.stds[i] > 0 else 1.0)
            out.append(x)
        return out

    def margin(self) -> Column:
        total = None
        for x, c in zip(self.inputs(), self.coefficients):
            total = x * F.lit(float(c)) if total is None else total + x * F.lit(float(c))
        return (F.lit(0.0) if total is None else total) + F.lit(float(self.intercept))

    def score(self) -> Column:
        """P(1) of a logistic model, the predicted value of a linear one."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin())) if self.logistic else self.margin()

    def predict(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """keep, pred and (logistic) score. NaN scores are class 0, as the model's own comparison gives."""
        if not self.logistic:
            return df.select(*keep, self.score().alias("pred"))
        out = df.select(*keep, self.score().alias("score"))
        return out.select(*keep, (~F.isnan("score") & (F.col("score") > self.threshold)).cast("int").alias("pred"), "score")

    def fitted(self, df: DataFrame, fill: bool = True) -> "LinearScorer":
        """The same coefficients with df's exact medians, means and population deviations (of the filled columns)."""
        medians = None
        if fill:
            row = quantile_wide(df, self.features, [0.5]).first()
            medians = [float(row[f"{f}__q0"]) if row and row[f"{f}__q0"] is not None else 0.0 for f in self.features]
        filled = replace(self, medians=medians, means=None, stds=None).inputs()
        means, stds = moments(df, [nan_to_null(c) for c in filled])
        return replace(self, medians=medians, means=means, stds=stds)


def compile_pipeline(model: PipelineModel) -> LinearScorer:
    """The scorer of a fitted pipeline of median fill, scaling, assembly and a linear or binary logistic model."""
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegressionModel
    from sparkwright.operators.models import ExactMedianImputerModel, PopulationStandardScalerModel
    fills, scales, features = {}, {}, None
    for stage in model.stages:
        if isinstance(stage, ExactMedianImputerModel) and not scales:
            fills = dict(zip(stage.getInputCols(), stage.getOrDefault(stage.stats)))
        elif isinstance(stage, PopulationStandardScalerModel):
            scales = dict(zip(stage.getInputCols(), zip(stage.getOrDefault(stage.stats), stage.getOrDefault(stage.stats2))))
        elif isinstance(stage, VectorAssembler):
            features = stage.getInputCols()
        elif isinstance(stage, (LogisticRegressionModel, LinearRegressionModel)):
            logistic = isinstance(stage, LogisticRegressionModel)
            if logistic and stage.numClasses != 2:
                raise ValueError("only binary logistic models are compiled")
            # a column without a fill or scale of its own keeps its value
            return LinearScorer(
                features, [float(c) for c in stage.coefficients.toArray()], float(stage.intercept),
                [scales.get(f, (0.0, 1.0))[0] for f in features], [scales.get(f, (0.0, 1.0))[1] for f in features],
                [fills.get(f, math.nan) for f in features] if fills else None, logistic,
                stage.getThreshold() if logistic else 0.5)
        else:
            raise ValueError(f"cannot compile {type(stage).__name__} in this place")
    raise ValueError("no linear model at the end of the pipeline")


# ---------------------------------------------------------------- aggregates
def moments(df: DataFrame, columns: list[Column]) -> tuple[list[float], list[float]]:
    """Means and population deviations of columns in one aggregate (0 for a column without values)."""
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return ([float(row[f"m{i}"] or 0.0) for i in range(len(columns))], [float(row[f"s{i}"] or 0.0) for i in range(len(columns))])


def gram(df: DataFrame, columns: list[Column], weight: Column | None = None) -> np.ndarray:
    """Sums of weight * a * b over all pairs of columns, as a symmetric matrix: one aggregate, one row to the driver.

    Columns are evaluated once per row; a row with a missing value in any of them is left out of every sum."""
    k = len(columns)
    inner = df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)], (F.lit(1.0) if weight is None else weight).alias("w"))
    inner = inner.where(~F.exists(F.array(*[f"c{i}" for i in range(k)], "w"), lambda v: v.isNull() | F.isnan(v)))
    row = inner.agg(*[F.sum(F.col("w") * F.col(f"c{i}") * F.col(f"c{j}")).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    out = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            out[i, j] = out[j, i] = row[f"g{i}_{j}"] or 0.0
    return out


def least_squares(df: DataFrame, features: list[str], label: str, alphas: list[float] = (0.0,)) -> list[LinearScorer]:
    """Ordinary (alpha 0) and ridge fits ||y - Xw||^2 + alpha ||w||^2 on scaled features, the intercept free (M1-M3).

    All alphas come from one Gram matrix of the centred columns. Equal or constant columns give the solution of least norm."""
    cols = [nan_to_null(F.col(f"`{f}`").cast("double")) for f in [*features, label]]
    means, stds = moments(df, cols)
    scaled = [(c - F.lit(m)) / F.lit(s if s > 0 else 1.0) for c, m, s in zip(cols, means, [*stds[:-1], 1.0])]
    g = gram(df, scaled)
    k = len(features)
    out = []
    for alpha in alphas:
        a = g[:k, :k] + float(alpha) * np.eye(k)
        w = np.linalg.lstsq(a, g[:k, k], rcond=None)[0]
        out.append(LinearScorer(list(features), w.tolist(), means[-1], means[:-1], stds[:-1], None, logistic=False))
    return out


@dataclass(frozen=True)
class NewtonFit:
    scorer: LinearScorer
    steps: int
    gradient: float            # largest absolute entry of the objective's gradient at the returned weights


def logistic_newton(df: DataFrame, features: list[str], label: str, C: float = 1.0, weight: Column | None = None,
                    tolerance: float = 1e-9, most_steps: int = 50) -> NewtonFit:
    """Minimises C * sum(weight * logloss) + ||w||^2 / 2 on scaled features, the intercept free (M4, M5).

    Every step is one aggregate: the loss, the gradient and the weighted Gram matrix at the current weights. A step that
    raises the objective is halved. df is read once per step: cut its lineage first."""
    raw = [nan_to_null(F.col(f"`{f}`").cast("double")) for f in features]
    means, stds = moments(df, raw)
    z = [F.lit(1.0), *[(c - F.lit(m)) / F.lit(s if s > 0 else 1.0) for c, m, s in zip(raw, means, stds)]]
    k = len(z)
    rows = df.select(*[c.alias(f"z{i}") for i, c in enumerate(z)], F.col(f"`{label}`").cast("double").alias("y"),
                     (F.lit(1.0) if weight is None else weight).alias("w"))
    rows = rows.where(~F.exists(F.array(*[f"z{i}" for i in range(k)], "y", "w"), lambda v: v.isNull() | F.isnan(v)))
    penalty = np.array([0.0] + [1.0] * (k - 1))

    def at(beta: np.ndarray):
        m = sum((F.col(f"z{i}") * F.lit(float(b)) for i, b in enumerate(beta)), F.lit(0.0))
        p = rows.select("*", m.alias("m")).select("*", (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("m")))).alias("p"))
        loss = F.log1p(F.exp(-F.abs("m"))) + F.greatest(F.col("m"), F.lit(0.0)) - F.col("y") * F.col("m")
        curve = p.select("*", (F.col("w") * (F.col("p") - F.col("y"))).alias("r"), (F.col("w") * F.col("p") * (F.lit(1.0) - F.col("p"))).alias("h"))
        row = curve.agg(F.sum(F.col("w") * loss).alias("loss"), *[F.sum(F.col("r") * F.col(f"z{i}")).alias(f"g{i}") for i in range(k)],
                        *[F.sum(F.col("h") * F.col(f"z{i}") * F.col(f"z{j}")).alias(f"h{i}_{j}") for i in range(k) for j in range(i, k)]).first()
        grad = C * np.array([row[f"g{i}"] or 0.0 for i in range(k)]) + penalty * beta
        hess = np.diag(penalty).astype(float)
        for i in range(k):
            for j in range(i, k):
                hess[i, j] += C * (row[f"h{i}_{j}"] or 0.0)
                hess[j, i] = hess[i, j]
        return C * (row["loss"] or 0.0) + 0.5 * float(penalty @ beta ** 2), grad, hess

    beta, steps = np.zeros(k), 0
    value, grad, hess = at(beta)
    while np.abs(grad).max() > tolerance and steps < most_steps:
        move = np.linalg.lstsq(hess, grad, rcond=None)[0]
        size = 1.0
        while True:
            after = at(beta - size * move)
            if after[0] <= value + 1e-12 * abs(value) or size < 1e-6:
                break
            size /= 2
        steps += 1
        if np.abs(after[1]).max() >= np.abs(grad).max() and after[0] >= value:      # nothing left to gain in doubles
            break
        beta, (value, grad, hess) = beta - size * move, after
    scorer = LinearScorer(list(features), beta[1:].tolist(), float(beta[0]), means, stds, None)
    return NewtonFit(scorer, steps, float(np.abs(grad).max()))
