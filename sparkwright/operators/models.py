"""Model fitting, tuning and scoring with Spark ML.

Pipelines are ``ExactMedianImputer -> PopulationStandardScaler -> VectorAssembler
-> estimator``. The two custom stages exist for parity with the reference's
statistics: Spark's ``Imputer`` uses an approximate quantile and ``StandardScaler``
the sample std. Both are ordinary persistable ``pyspark.ml`` stages whose fit is one
aggregate; their transform is column arithmetic (no Python per row).

AUC everywhere is the exact rank-sum operator (``evaluate.roc_auc``), also wrapped
as an ``Evaluator`` so ``CrossValidator`` can use it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.functions.numeric import nan_to_null
from sparkwright.operators import forests as FO
from sparkwright.operators.evaluate import roc_auc
from sparkwright.operators.quantile import quantile_wide
from sparkwright.operators.trees import collapse, leaf_shares, node_table, walk
from sparkwright.session import ensure_checkpoint_dir, stored


# ---------------------------------------------------------------- custom stages
class _Stats(Params):
    stats = Param(Params._dummy(), "stats", "fitted per-column statistics", typeConverter=TypeConverters.toListFloat)
    stats2 = Param(Params._dummy(), "stats2", "second fitted statistic", typeConverter=TypeConverters.toListFloat)


class ExactMedianImputerModel(Model, HasInputCols, _Stats, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, df: DataFrame) -> DataFrame:
        meds = self.getOrDefault(self.stats)
        return df.withColumns({c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(m))
                               for c, m in zip(self.getInputCols(), meds)})


class ExactMedianImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Median imputation with the exact (interpolated) median, as sklearn's SimpleImputer."""

    def __init__(self, inputCols=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _fit(self, df: DataFrame) -> ExactMedianImputerModel:
        cols = self.getInputCols()
        row = quantile_wide(df, cols, [0.5]).first()
        m = ExactMedianImputerModel()
        m._set(inputCols=cols, stats=[float(row[f"{c}__q0"]) if row and row[f"{c}__q0"] is not None else 0.0
                                      for c in cols])
        return m


class PopulationStandardScalerModel(Model, HasInputCols, _Stats, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, df: DataFrame) -> DataFrame:
        means, stds = self.getOrDefault(self.stats), self.getOrDefault(self.stats2)
        return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s if s > 0 else 1.0)
                               for c, m, s in zip(self.getInputCols(), means, stds)})


class PopulationStandardScaler(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population std; a constant column is centred only (sklearn StandardScaler)."""

    def __init__(self, inputCols=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _fit(self, df: DataFrame) -> PopulationStandardScalerModel:
        cols = self.getInputCols()
        v = [nan_to_null(F.col(c).cast("double")) for c in cols]
        row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(v)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(v)]).first()
        m = PopulationStandardScalerModel()
        m._set(inputCols=cols, stats=[float(row[f"m{i}"] or 0.0) for i in range(len(cols))],
               stats2=[float(row[f"s{i}"] or 0.0) for i in range(len(cols))])
        return m


class CollapsedTreeModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A binary decision tree as its node table; the prediction is a walk written as columns."""
    nodes = Param(Params._dummy(), "nodes", "the tree's nodes as JSON rows", typeConverter=TypeConverters.toString)

    def node_rows(self) -> list[dict]:
        return json.loads(self.getOrDefault(self.nodes))

    def _transform(self, df: DataFrame) -> DataFrame:
        rows = self.node_rows()
        width = 1 + max(r["feature"] for r in rows)
        x = df.withColumn("__x", vector_to_array("features"))
        share = walk(rows, [F.col("__x")[i] for i in range(width)], leaf_shares(rows))
        return (x.withColumn("__p", share).withColumn("probability", array_to_vector(F.array(1 - F.col("__p"), F.col("__p"))))
                .withColumn("prediction", (F.col("__p") > 0.5).cast("double")).drop("__x", "__p"))


class CollapsedTree(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """A decision tree in which no node of fewer than ``minSplit`` rows is split (M7): grown freely to its depth, then
    collapsed from the top on its node table."""
    minSplit = Param(Params._dummy(), "minSplit", "rows a split node has at least", typeConverter=TypeConverters.toInt)

    def __init__(self, tree: DecisionTreeClassifier | None = None, minSplit: int = 2):
        super().__init__()
        self.tree = tree
        self._set(minSplit=minSplit)

    def copy(self, extra=None):
        other = super().copy(extra)
        other.tree = self.tree
        return other

    def _fit(self, df: DataFrame) -> CollapsedTreeModel:
        # one tree of bounded depth: its nodes come to the driver, as the fitted model's do
        nodes = collapse(node_table(self.tree.fit(df), df.sparkSession), self.getOrDefault(self.minSplit))
        rows = [r.asDict() for r in nodes.drop("tree", "leaf", "lo", "hi").orderBy("node").collect()]
        return CollapsedTreeModel()._set(nodes=json.dumps(rows))


class RankSumAUC(Evaluator):
    """Exact ROC AUC (ties count half) on P(1), for CrossValidator / TrainValidationSplit."""

    def __init__(self, labelCol: str = "label", probabilityCol: str = "probability"):
        super().__init__()
        self.labelCol, self.probabilityCol = labelCol, probabilityCol

    def _evaluate(self, df: DataFrame) -> float:
        s = df.select(vector_to_array(self.probabilityCol)[1].alias("score"),
                      F.col(self.labelCol).cast("int").alias("label"))
        v = roc_auc(s, "score", "label").first()["auc"]
        return float(v) if v is not None else 0.0     # one class only: the worst value, so that it is never picked

    def isLargerBetter(self) -> bool:
        return True


# ---------------------------------------------------------------- pipelines
def assemble_stages(features: list[str], estimator, impute: bool = True, scale: bool = True) -> Pipeline:
    stages = []
    if impute:
        stages.append(ExactMedianImputer(inputCols=features))
    if scale:
        stages.append(PopulationStandardScaler(inputCols=features))
    stages.append(VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"))
    if estimator is not None:
        stages.append(estimator.reading(features) if isinstance(estimator, FO._OnCells) else estimator)
    return Pipeline(stages=stages)


def train_size_and_label_std(df: DataFrame, label: str) -> tuple[int, float]:
    r = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
    return int(r["n"]), float(r["s"] or 0.0)


def ols(label: str = "label") -> LinearRegression:
    """Ordinary least squares with intercept (M1)."""
    return LinearRegression(labelCol=label, featuresCol="features", regParam=0.0, solver="normal")


def ridge(alpha: float, n: int, label_std: float, label: str = "label") -> LinearRegression:
    """sklearn Ridge(alpha) objective ||y - Xw||^2 + alpha ||w||^2 (M2).

    Spark's normal-equation solver works on the label scaled by its std, so the
    equivalent regParam is alpha / n * std_pop(y)."""
    return LinearRegression(labelCol=label, featuresCol="features", elasticNetParam=0.0, standardization=False,
                            solver="normal", regParam=alpha / n * label_std)


def logistic(C: float, n: int, label: str = "label", weight: str | None = "weight") -> LogisticRegression:
    """sklearn LogisticRegression(C, L2, class_weight='balanced') (M4, M5): regParam = 1 / (C * sum(w)),
    and with balanced weights sum(w) = n."""
    lr = LogisticRegression(labelCol=label, featuresCol="features", elasticNetParam=0.0, standardization=False,
                            regParam=1.0 / (C * n), maxIter=1000, tol=1e-8)
    if weight:
        lr.setWeightCol(weight)
    return lr


def decision_tree(max_depth: int | None = None, impurity: str = "gini", min_instances: int = 1,
                  label: str = "label", max_bins: int = 128, min_split: int = 2):
    """Unlimited depth maps to 30, Spark's maximum; min_split > 2 collapses the grown tree (M6-M9)."""
    tree = DecisionTreeClassifier(labelCol=label, featuresCol="features", maxDepth=30 if max_depth is None else max_depth,
                                  impurity=impurity, minInstancesPerNode=min_instances, maxBins=max_bins, seed=42)
    return CollapsedTree(tree, min_split) if min_split > 2 else tree


def random_forest(trees: int = 100, max_depth: int | None = 10, min_leaf: int = 1, label: str = "label",
                  max_bins: int = 128, seed: int = 42) -> RandomForestClassifier:
    """sqrt(features) per split, bootstrap rows, seeded."""
    return RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees,
                                  maxDepth=30 if max_depth is None else max_depth, minInstancesPerNode=min_leaf,
                                  featureSubsetStrategy="sqrt", maxBins=max_bins, seed=seed)


def gradient_boosting(rounds: int = 100, max_depth: int = 3, rate: float = 0.1, label: str = "label",
                      max_bins: int = 128, seed: int = 42) -> GBTClassifier:
    """Gradient-boosted trees (M12); Spark has no Newton leaf step, so compare AUC, not scores."""
    return GBTClassifier(labelCol=label, featuresCol="features", maxIter=rounds, maxDepth=max_depth,
                         stepSize=rate, maxBins=max_bins, seed=seed)


# ---------------------------------------------------------------- scoring and tables
def score(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """Predicted class and P(1)."""
    out = model.transform(df)
    cols = [*keep, F.col("prediction").cast("int").alias("pred")]
    if "probability" in out.columns:
        cols.append(vector_to_array("probability")[1].alias("score"))
    return out.select(*cols)


def counted_scores(model: PipelineModel, df: DataFrame, label: str = "label") -> DataFrame:
    """(label, pred, score, rows): ``score`` counted per label and score, not yet added up.

    A forest grown on cells scores all rows between the same thresholds alike, so it scores each cell once."""
    last = model.stages[-1]
    edges = getattr(last, "cell_edges", None)
    if edges is None:
        return score(model, df, [label]).select(label, "pred", "score", F.lit(1).cast("long").alias("rows"))
    ready = PipelineModel(model.stages[:-1]).transform(df)
    columns = model.stages[-2].getInputCols()
    cells = FO.cells_as_vectors(FO.number_rows(ready, "features", label, columns), edges, "features")
    kind = df.schema[label].dataType
    return last.transform(cells).select(F.col("y").cast(kind).alias(label), F.col("prediction").cast("int").alias("pred"),
                                        vector_to_array("probability")[1].alias("score"), F.col("n").alias("rows"))


def coefficient_table(spark, model: PipelineModel, features: list[str]) -> DataFrame:
    """feature, coef sorted by |coef| desc (M3); k rows from the fitted model's metadata."""
    est = model.stages[-1]
    rows = [(f, float(c)) for f, c in zip(features, est.coefficients.toArray())]
    return (spark.createDataFrame(rows, "feature string, coef double")
            .orderBy(F.abs("coef").desc(), "feature"))


def importance_table(spark, model: PipelineModel, features: list[str]) -> DataFrame:
    """feature, importance sorted desc (M11); normalised impurity decrease, as sklearn."""
    est = model.stages[-1]
    rows = [(f, float(v)) for f, v in zip(features, est.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def least_important(spark, model: PipelineModel, features: list[str], k: int) -> list[str]:
    imp = sorted(zip(features, model.stages[-1].featureImportances.toArray()), key=lambda t: (t[1], t[0]))
    return [f for f, _ in imp[:k]]


def fit_all(jobs: list, parallelism: int = 4) -> list:
    """Run independent fits ``[(pipeline, frame), ...]`` concurrently (as CrossValidator's
    ``parallelism`` does): each fit is its own set of Spark jobs, and small fits leave most
    executor slots idle when run one after another."""
    return run_all([lambda job=job: job[0].fit(job[1]) for job in jobs], parallelism)


def run_all(calls: list, parallelism: int = 4) -> list:
    """The results of independent calls, ``parallelism`` at a time."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(lambda call: call(), calls))


def out_of_fold_predictions(df: DataFrame, features: list[str], estimators: dict, fold: str = "fold",
                            label: str = "label", key: str = "row_key", k: int = 5, impute: bool = False,
                            parallelism: int = 4, prepare=None, counted: bool = False) -> DataFrame:
    """Tall (model, fold, key, label, score): each fold scored by a model fit on the other folds (M14);
    ``counted``: (model, fold, label, pred, score, rows), as ``counted_scores``.

    ``estimators`` maps a name to an estimator, or to a function of the fold's training rows that returns one (a
    penalty that depends on their number); ``prepare`` is applied to those rows first (class weights of the fold).

    One fit per (model, fold), run ``parallelism`` at a time — a loop over folds, never over
    rows — and the union of all out-of-fold predictions is evaluated in one grouped job.
    """
    plan = [(name, i) for name in estimators for i in range(k)]
    rows = {i: (prepare or (lambda tr: tr))(df.where(F.col(fold) != i)) for i in range(k)}
    build = {(name, i): e(rows[i]) if callable(e) else e for name, e in estimators.items() for i in range(k)}
    models = fit_all([(assemble_stages(features, build[name, i], impute=impute), rows[i]) for name, i in plan], parallelism)
    def scored(m, name, i):
        rows = df.where(F.col(fold) == i)
        found = counted_scores(m, rows, label).withColumn(fold, F.lit(i)) if counted else score(m, rows, [key, label, fold])
        return found.withColumn("model", F.lit(name))

    parts = run_all([lambda m=m, p=p: scored(m, *p) for p, m in zip(plan, models)], parallelism)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def grid_search(df: DataFrame, features: list[str], estimator, grid: dict, fold: str = "fold",
                label: str = "label", parallelism: int = 4, k: int = 5):
    """CrossValidator over a parameter grid on the given folds, refit on all rows.

    Returns (fitted CrossValidatorModel, table of (params..., cv_auc))."""
    pipe = assemble_stages(features, estimator)
    builder = ParamGridBuilder()
    for p, values in grid.items():
        builder = builder.addGrid(getattr(estimator, p), values)
    maps = builder.build()
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=maps, evaluator=RankSumAUC(label), foldCol=fold,
                        numFolds=k, parallelism=parallelism, seed=42)
    cvm = cv.fit(df)
    rows = [tuple(float(m[getattr(estimator, p)]) for p in grid) + (float(a),)
            for m, a in zip(maps, cvm.avgMetrics)]
    schema = ", ".join([f"{p} double" for p in grid] + ["cv_auc double"])
    table = df.sparkSession.createDataFrame(rows, schema)
    return cvm, table


@dataclass
class ForestSearch:
    """The refitted best pipeline and the table (numTrees, maxDepth, minInstancesPerNode, cv_auc)."""
    bestModel: PipelineModel
    table: DataFrame


def forest_grid_search(df: DataFrame, features: list[str], grid: dict, fold: str = "fold", label: str = "label", key: str = "row_key",
                       k: int = 5, parallelism: int = 4) -> ForestSearch:
    """Grid search over numTrees x maxDepth x minInstancesPerNode of a random forest on the given folds, refit on all rows.

    The largest forest is grown once per (leaf size, fold), on counted cells and to the largest depth; its first t trees, ended at
    depth d, are a forest of t trees of depth d, so sizes and depths cost no fit of their own (``forests.prefix_scores_of_cells``).
    Fills, scales and the feature vector are fitted once per fold; held-out rows are scored as counted cells, too
    (``forests.grid_scores``). All scores of all points go through one grouped AUC. A point's AUC is the mean over the folds (a fold of one class counts 0); of equal
    points the smallest is the best, and it is fitted anew."""
    spark = df.sparkSession
    sizes, depths = sorted(grid["numTrees"]), sorted(grid["maxDepth"])

    def scores_of(i: int) -> DataFrame:
        train = df.where(F.col(fold) != i)
        prepared = assemble_stages(features, None).fit(train)
        cells, edges = FO._cells_of(prepared.transform(train), "features", label, random_forest().getMaxBins(), features)
        held = FO.cell_table(FO.number_rows(prepared.transform(df.where(F.col(fold) == i)), "features", label, features), edges)
        forests = [random_forest(sizes[-1], depths[-1], m, label=label) for m in grid["minInstancesPerNode"]]
        scores = FO.grid_scores(cells, held, edges, forests, sizes, depths).select(
            F.col("trees").cast("double").alias("numTrees"), F.col("depth").cast("double").alias("maxDepth"),
            F.col("least").cast("double").alias("minInstancesPerNode"), F.lit(i).alias(fold), F.col("y").alias(label), "score", "n")
        return stored(scores, "fold_scores")

    points = ["numTrees", "maxDepth", "minInstancesPerNode"]
    scores = reduce(DataFrame.unionByName, run_all([lambda i=i: scores_of(i) for i in range(k)], parallelism))
    table = roc_auc(scores, "score", label, [*points, fold], weight="n").groupBy(*points).agg((F.sum(F.coalesce("auc", F.lit(0.0))) / k).alias("cv_auc"))
    rows = sorted(table.collect(), key=lambda r: (-r["cv_auc"], *[r[p] for p in points]))      # one row per point
    best = rows[0]
    estimator = FO.DeepForest(random_forest(int(best["numTrees"]), int(best["maxDepth"]), int(best["minInstancesPerNode"]), label=label))
    model = assemble_stages(features, estimator).fit(df)
    return ForestSearch(model, spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{c} double" for c in [*points, "cv_auc"])))


def save_model(model: PipelineModel, spark, name: str) -> str:
    """Persist under the cluster's shared checkpoint directory (S6); returns the path."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/models/{name}-{uuid.uuid4().hex[:8]}"
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
