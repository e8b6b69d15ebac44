"""Registered queries for ranks, correlation and chart tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.operators import correlation as C
from sparkwright.operators import ranking as R
from sparkwright.operators import shape as S
from sparkwright.plans.common import rounded
from sparkwright.plans.fixtures import CORR_COLUMNS, lineitem_corr, table


def r1_average_rank(spark, d):
    return R.average_rank(table(spark, d, "events"), "user_id").select("user_id", "cnt", "cum", "rank")


def r1_rank_rows(spark, d):
    ev = table(spark, d, "events").select("event_id", "value")
    return R.rank_rows(ev, "value", out="value_rank")


def r2_sort_by_abs(spark, d):
    return rounded(R.sort_by_abs(C.pearson(lineitem_corr(spark, d), CORR_COLUMNS), "value", ["ord_a", "ord_b"])
                   .select("col_a", "col_b", "value"))


def r3_head_tail(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return R.head_tail(o, ["o_totalprice", "o_orderkey"], 5)


def a10_pearson(spark, d):
    return rounded(C.pearson(lineitem_corr(spark, d), CORR_COLUMNS).select("col_a", "col_b", "value"))


def a10_pearson_square(spark, d):
    return rounded(C.to_square(C.pearson(lineitem_corr(spark, d), CORR_COLUMNS)).select("col_a", "col_b", "value"))


def _wide_gaps(spark, d):
    """30 columns of lineitem measures, every other one with gaps of its own."""
    li = table(spark, d, "lineitem")
    cols = []
    for i in range(30):
        v = F.col("l_extendedprice") * ((i % 5) - 2) + F.col("l_quantity") * (i * 37 % 11) + F.col("l_discount") * (1000 * (i % 3))
        cols.append((F.when(F.col("l_orderkey") % (i + 2) == 0, F.lit(None)).otherwise(v) if i % 2 else v).alias(f"c{i}"))
    return li.select(*cols)


def a10_pearson_wide(spark, d):
    """30 columns with gaps: pairs in blocks, one path for every width."""
    return rounded(C.pearson(_wide_gaps(spark, d), [f"c{i}" for i in range(30)]).select("col_a", "col_b", "value"))


def a11_spearman(spark, d):
    return rounded(C.spearman(lineitem_corr(spark, d), CORR_COLUMNS).select("col_a", "col_b", "value"))


def a11_spearman_complete(spark, d):
    """Spearman on null-free columns: each column ranked once, ranks joined onto the rows."""
    cols = ["event_id", "user_id", "value"]
    return rounded(C.spearman(table(spark, d, "events"), cols).select("col_a", "col_b", "value"))


def a12_strongest_pair(spark, d):
    return rounded(C.strongest_pair(C.pearson(lineitem_corr(spark, d), CORR_COLUMNS)))


def a13_corr_difference(spark, d):
    lc = lineitem_corr(spark, d)
    return rounded(C.difference_table(C.pearson(lc, CORR_COLUMNS), C.spearman(lc, CORR_COLUMNS)))


def a17_histogram(spark, d):
    return rounded(S.histogram_table(table(spark, d, "documents"), "n_chars", 20))


def a18_box_table(spark, d):
    return rounded(S.box_table(table(spark, d, "events"), "event_type", "value", few_groups=True))


def a19_ordered_series(spark, d):
    return rounded(S.ordered_series(table(spark, d, "orders"), "o_orderkey", "o_totalprice", 50))


def a20_density_2d(spark, d):
    return S.density_2d(table(spark, d, "lineitem"), "l_extendedprice", "l_quantity", 10, 10)


QUERIES = {name: fn for name, fn in list(globals().items())
           if callable(fn) and name[:1] in "ra" and name[1:2].isdigit()}
