"""Registered queries for feature preparation and model-free evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.functions.hashing import hash_unit
from sparkwright.operators import evaluate as V
from sparkwright.operators import features as FE
from sparkwright.operators import positions as PO
from sparkwright.operators import profile as P
from sparkwright.plans.common import rounded
from sparkwright.plans.fixtures import FEATURES, SEED, lineitem_base, lineitem_features, scored, scored_all, table

# Fixed declared order for the priority encoder; '1-URGENT' is left out on purpose (-> -1).
PRIORITY_LEVELS = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH"]
THRESHOLDS = [0.3, 0.4, 0.5, 0.6, 0.7]


def f1_ordinal_encode(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return FE.ordinal_encode(o, {"o_orderpriority": PRIORITY_LEVELS}, suffix="_ord")


def p10_replace_columns(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return FE.ordinal_encode(li, {"l_returnflag": ["N", "R", "A"], "l_linestatus": ["O", "F"]})


def p11_round_half_even(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 2).alias("half"))
    return li.select("l_orderkey", "l_linenumber", "half", F.bround("half", 0).alias("r_even"),
                     F.round("half", 0).alias("r_up"))


def f2_split(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    return FE.split_flag(o, "o_orderkey", SEED, 0.2)


def f2_split_exact(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    return FE.split_flag(o, "o_orderkey", SEED, 0.2, exact=True)


def f3_standardize(spark, d):
    lf = lineitem_features(spark, d).select("row_key", "is_test", *FEATURES)
    stats = FE.fit_standard_scaler(lf.where(~F.col("is_test")), FEATURES)
    return rounded(FE.apply_standard_scaler(lf, stats, FEATURES).drop("is_test"))


def f4_median_imputer(spark, d):
    li = table(spark, d, "lineitem").select(
        F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("row_key"),
        F.expr("nullif(l_discount, 0)").alias("l_discount"), F.expr("nullif(l_tax, 0)").alias("l_tax"))
    li = FE.split_flag(li, "row_key", SEED, 0.2)
    med = FE.fit_median_imputer(li.where(~F.col("is_test")), ["l_discount", "l_tax"])
    return FE.apply_median_imputer(li, med, ["l_discount", "l_tax"])


def f5_class_weights(spark, d):
    lf = lineitem_features(spark, d).where(~F.col("is_test")).select("row_key", "label")
    return FE.with_class_weights(lf, "label")


def f6_stratified_folds(spark, d):
    lf = lineitem_features(spark, d).where(~F.col("is_test")).select("row_key", "label")
    return FE.stratified_folds(lf, "row_key", "label", 5, SEED)


def p8_nested_prefix(spark, d):
    lf = lineitem_features(spark, d).where(~F.col("is_test")).select("row_key", "label")
    return FE.nested_prefixes(lf, "row_key", SEED, [0.2, 0.4, 0.6, 0.8, 1.0]).groupBy("fraction").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").cast("bigint").alias("positives"))


def p6_threshold_predicate(spark, d):
    s = scored(spark, d)
    return s.select("model", "row_key", (F.col("score") >= F.lit(0.4)).cast("int").alias("pred_t040"))


def v1_mse(spark, d):
    return rounded(V.regression_metrics(scored(spark, d), "net", "pred_net", ["model"]).select("model", "mse"), 2)


def v2_r2(spark, d):
    return rounded(V.regression_metrics(scored(spark, d), "net", "pred_net", ["model"]).select("model", "r2"))


def v3_confusion_matrix(spark, d):
    return V.confusion_matrix(scored(spark, d), by=["model"])


def v4_classification_report(spark, d):
    return rounded(V.classification_report(scored(spark, d), by=["model"]))


def v5_roc_auc(spark, d):
    return rounded(V.roc_auc(scored(spark, d), by=["model"]))


def v6_roc_curve(spark, d):
    return rounded(V.roc_curve(scored(spark, d), by=["model"]))


def v6_roc_corners(spark, d):
    return rounded(V.roc_curve(scored(spark, d), by=["model"], drop_intermediate=True))


def r5_descending_cumulative(spark, d):
    from sparkwright.operators.ranking import descending_cumulative
    return descending_cumulative(scored(spark, d), "score", "label", ["model"])


def v7_precision_recall_f1(spark, d):
    return rounded(V.precision_recall_f1(scored(spark, d), by=["model"]))


def v8_threshold_sweep(spark, d):
    return V.threshold_sweep(scored(spark, d), THRESHOLDS, by=["model"])


def r4_best_threshold(spark, d):
    return V.best_threshold(V.threshold_sweep(scored(spark, d), THRESHOLDS, by=["model"]), ["model"])


def v9_accuracy_gap(spark, d):
    return rounded(V.accuracy_gap(scored_all(spark, d), "is_test", by=["model"]))


def v10_bootstrap_auc_diff(spark, d):
    return rounded(V.bootstrap_auc_difference(scored(spark, d), "model_a", "model_b", 500, SEED), 8)


def v11_bootstrap_ci(spark, d):
    return rounded(V.confidence_interval(V.bootstrap_auc_difference(scored(spark, d), "model_a", "model_b", 500, SEED)), 8)


def v12_ci_excludes_zero(spark, d):
    ci = V.confidence_interval(V.bootstrap_auc_difference(scored(spark, d), "model_a", "model_b", 500, SEED))
    return ci.select("excludes_zero")


def v13_model_comparison(spark, d):
    return V.model_comparison(scored(spark, d))


def _by_order(spark, d):
    """Scores keyed by order: a key repeats once per line, with labels of both classes."""
    return scored(spark, d).withColumn("row_key", F.substring_index("row_key", "|", 1))


def v10_bootstrap_repeated_keys(spark, d):
    return rounded(V.bootstrap_auc_difference(_by_order(spark, d), "model_a", "model_b", 50, SEED), 8)


def f6_folds_repeated_keys(spark, d):
    """Folds keyed by order: rows that share a hash are still dealt one by one."""
    lf = lineitem_features(spark, d).where(~F.col("is_test")).select(
        F.substring_index("row_key", "|", 1).alias("order_key"), "row_key", "label")
    return FE.stratified_folds(lf, "order_key", "label", 5, SEED).groupBy("label", "fold").agg(F.count(F.lit(1)).alias("rows"))


def f4_imputer_nan(spark, d):
    """NaN is missing: the imputer and the scaler treat it as NULL."""
    li = table(spark, d, "lineitem").select(
        F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("row_key"),
        F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_linenumber") == 1, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"))
    done = FE.apply_median_imputer(li, FE.fit_median_imputer(li, ["l_discount"]), ["l_discount"])
    return rounded(FE.apply_standard_scaler(done, FE.fit_standard_scaler(done, ["l_tax"]), ["l_tax"])
                   .withColumn("l_tax", F.nanvl("l_tax", F.lit(None).cast("double"))))


def a22_fold_auc_summary(spark, d):
    tr = scored_all(spark, d).where(~F.col("is_test"))
    folds = FE.stratified_folds(tr.where(F.col("model") == "model_a").select("row_key", "label"),
                                "row_key", "label", 5, SEED).select("row_key", "fold")
    per_fold = V.roc_auc(tr.join(folds, "row_key"), by=["model", "fold"])
    return rounded(P.mean_pop_std(per_fold, "auc", by=["model"]))


def p9_bootstrap_weights(spark, d):
    s = scored(spark, d).where(F.col("model") == "model_a").select("row_key")
    return V.bootstrap_draws(s, "row_key", 500, SEED)


def p9_gather(spark, d):
    """One pick per row of the feature table, by its own seeded draw (rows repeat), some of them past the end."""
    lf = lineitem_base(spark, d).select("row_key", "l_extendedprice", "net")
    n = lf.count()
    u = hash_unit(F.concat_ws("|", "row_key", F.lit("pick")), SEED)
    picks = lf.select("row_key", F.floor(u * (n * 1.01)).alias("index"))
    got = PO.gather(lf, picks, ["row_key", "l_extendedprice", "net"])
    return rounded(got.select("row_key", "index", F.col("row.row_key").alias("picked_key"), F.col("row.net").alias("picked_net")))


def j2_zip_by_position(spark, d):
    """Orders by key beside orders by falling price, partitioned differently, aligned by position."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    z = PO.zip_rows(o.repartition(7, "o_totalprice"), ["o_orderkey"], o.repartition(3), [F.col("o_totalprice").desc(), "o_orderkey"])
    return z.select("position", F.col("left.o_orderkey").alias("key_by_key"), F.col("right.o_orderkey").alias("key_by_price"))


def p7_drop_list_columns(spark, d):
    drop = ["l_tax", "ls_code"]
    keep = [f for f in FEATURES if f not in drop]
    return lineitem_features(spark, d).select("row_key", *keep)


def f7_fitted_stages(spark, d):
    """Imputer and scaler stages fitted on train rows as one pipeline, applied to every row."""
    from pyspark.ml import Pipeline
    from sparkwright.operators.models import ExactMedianImputer, PopulationStandardScaler
    li = table(spark, d, "lineitem").select(
        F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("row_key"),
        "l_quantity", F.expr("nullif(l_discount, 0)").alias("l_discount"), F.expr("nullif(l_tax, 0)").alias("l_tax"))
    li = FE.split_flag(li, "row_key", SEED, 0.2)
    cols = ["l_quantity", "l_discount", "l_tax"]
    pipe = Pipeline(stages=[ExactMedianImputer(inputCols=cols), PopulationStandardScaler(inputCols=cols)])
    model = pipe.fit(li.where(~F.col("is_test")))
    return rounded(model.transform(li).select("row_key", *cols))


def f8_feature_vector(spark, d):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    lf = lineitem_features(spark, d)
    va = VectorAssembler(inputCols=FEATURES, outputCol="features")
    return va.transform(lf).select("row_key", vector_to_array("features").alias("features"))


QUERIES = {name: fn for name, fn in list(globals().items())
           if callable(fn) and name[:1] in "fpvraj" and name[1:2].isdigit()}
