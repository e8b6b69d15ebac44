"""Registered queries for sources, projections, cleaning and descriptive statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.functions.numeric import coerce_numeric, numeric_columns
from sparkwright.operators import profile as P
from sparkwright.plans.common import rounded
from sparkwright.plans.fixtures import (
    GAPS_COLUMNS, GAPS_NUMERIC, lineitem_dups, lineitem_features, lineitem_gaps, lineitem_text, table,
)


def s3_shape(spark, d):
    return P.shape(table(spark, d, "lineitem"))


def s3_schema(spark, d):
    return P.schema_table(table(spark, d, "lineitem"))


def s3_preview(spark, d):
    from sparkwright.sources import preview
    return preview(table(spark, d, "orders").orderBy("o_orderkey"), 5)


def q1_null_profile(spark, d):
    return rounded(P.null_profile(lineitem_gaps(spark, d), GAPS_COLUMNS))


def q2_high_null_columns(spark, d):
    return rounded(P.high_null_columns(P.null_profile(lineitem_gaps(spark, d), GAPS_COLUMNS), 20.0))


def p3_summary_filter(spark, d):
    return rounded(P.high_null_columns(P.null_profile(lineitem_gaps(spark, d), GAPS_COLUMNS), 5.0))


def q3_conditional_median_fill(spark, d):
    return P.median_fill(lineitem_gaps(spark, d), GAPS_NUMERIC, max_null_pct=20.0)


def q4_median_fill_named(spark, d):
    return P.median_fill(lineitem_gaps(spark, d), ["qty_sparse", "l_tax"], max_null_pct=None)


def q5_post_fill_nulls(spark, d):
    filled = P.median_fill(lineitem_gaps(spark, d), ["qty_sparse", "l_tax"], max_null_pct=None)
    return rounded(P.null_profile(filled, ["qty_sparse", "l_tax"]))


def q6_duplicate_count(spark, d):
    return P.duplicate_count(lineitem_dups(spark, d))


def q7_drop_duplicates(spark, d):
    return P.drop_duplicates(lineitem_dups(spark, d))


def q8_null_drift(spark, d):
    before = lineitem_gaps(spark, d)
    after = P.drop_duplicates(P.median_fill(before, GAPS_NUMERIC, max_null_pct=20.0))
    return rounded(P.null_drift(before, after, GAPS_COLUMNS))


def q9_coerce_numeric(spark, d):
    return lineitem_text(spark, d).withColumn("qty", coerce_numeric("qty_text"))


def q10_category_codes(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return P.category_encode(orders, "o_orderpriority", code_col="priority_code")


def q11_storage_profile(spark, d):
    return P.storage_profile(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"])


def a1_describe(spark, d):
    return rounded(P.describe(lineitem_gaps(spark, d), GAPS_NUMERIC))


def a2_quantiles(spark, d):
    return rounded(P.quantiles(table(spark, d, "events"), "value", [0.1, 0.25, 0.5, 0.75, 0.9], by=["event_type"],
                               few_groups=True))


def a3_skewness(spark, d):
    return rounded(P.skewness_table(lineitem_gaps(spark, d), GAPS_NUMERIC))


def a4_top_skewed(spark, d):
    ev = table(spark, d, "events")
    return rounded(P.top_skewed(ev, 2, ["event_id", "user_id", "value"]))


def a5_iqr_outliers(spark, d):
    return rounded(P.iqr_outliers(table(spark, d, "events"), ["value", "user_id"]))


def a6_group_mean_sorted(spark, d):
    return rounded(P.group_mean_sorted(table(spark, d, "orders"), "o_orderpriority", "o_totalprice"))


def a7_group_stats(spark, d):
    return rounded(P.group_stats(table(spark, d, "orders"), "o_orderpriority", "o_totalprice"))


def a8_group_argmax(spark, d):
    stats = P.group_stats(table(spark, d, "orders"), "o_orderpriority", "o_totalprice")
    return rounded(P.group_argmax(stats, "o_orderpriority", ["mean", "std"]))


def a9_spread_ratio(spark, d):
    stats = P.group_stats(table(spark, d, "orders"), "o_orderpriority", "o_totalprice")
    return rounded(P.spread_ratio(stats, "mean"))


def a14_imputation_comparison(spark, d):
    return rounded(P.imputation_comparison(lineitem_gaps(spark, d), 2, GAPS_NUMERIC))


def a15_value_counts(spark, d):
    return P.value_counts(table(spark, d, "lineitem"), "l_quantity")


def a16_min_max(spark, d):
    return P.min_max(table(spark, d, "lineitem"), "l_extendedprice")


def a21_percentile_interval(spark, d):
    return rounded(P.percentile_interval(table(spark, d, "events"), "value", by=["event_type"], few_groups=True))


def a22_mean_pop_std(spark, d):
    return rounded(P.mean_pop_std(table(spark, d, "events"), "value", by=["event_type"]))


def p1_drop_columns(spark, d):
    return table(spark, d, "orders").drop("o_orderdate", "o_orderstatus")


def p2_numeric_columns(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(*numeric_columns(li))


def p4_median_label(spark, d):
    return rounded(lineitem_features(spark, d).select("row_key", "net", "label"))


def p5_outside_range(spark, d):
    return P.outside_range(table(spark, d, "lineitem"), "l_extendedprice", 2000.0, 90000.0) \
        .select("l_orderkey", "l_linenumber", "l_extendedprice")


def p13_keyed_lookup_default(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    labels = table(spark, d, "labels")
    return (docs.join(labels, "doc_id", "left")
            .select("doc_id", "lang", F.coalesce("quality", F.lit(0)).alias("quality"),
                    F.coalesce("toxic", F.lit(0)).alias("toxic")))


def _events_nan(spark, d):
    """events with NaN in place of every 7th value."""
    ev = table(spark, d, "events")
    return ev.select("event_id", "event_type", F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))


def a6_group_mean_nan(spark, d):
    return rounded(P.group_mean_sorted(_events_nan(spark, d), "event_type", "value"))


def a15_value_counts_nan(spark, d):
    df = _events_nan(spark, d).select(F.when(F.isnan("value"), F.col("value")).otherwise(F.floor("value").cast("double")).alias("whole"))
    return P.value_counts(df, "whole")


def a8_argmax_null_std(spark, d):
    """The largest order alone is a group of one row: its std is NULL and must not win."""
    o = table(spark, d, "orders")
    alone = o.withColumn("grp", F.when(F.col("o_orderkey") == F.lit(o.agg(F.min("o_orderkey")).first()[0]), F.lit("alone"))
                         .otherwise(F.col("o_orderpriority")))
    stats = P.group_stats(alone, "grp", "o_totalprice")
    return rounded(P.group_argmax(stats, "grp", ["std", "count"]).withColumn("value", F.col("value").cast("double")))


def a7_group_stats_domain(spark, d):
    """Declared categories, one of which does not occur, keep their row."""
    levels = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NEVER"]
    domain = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in levels])).alias("o_orderpriority"))
    return rounded(P.group_stats(table(spark, d, "orders"), "o_orderpriority", "o_totalprice", domain))


def q10_category_codes_wide(spark, d):
    """Dictionary codes of a column with a value per row."""
    keys = table(spark, d, "orders").select(F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("name"))
    return P.category_domain(keys, "name")


QUERIES = {name: fn for name, fn in list(globals().items())
           if callable(fn) and name[:1] in "sqap" and name[1:2].isdigit()}
