"""Registered queries for sources and sinks (round trips through shared storage)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright import sources as S
from sparkwright.operators import profile as P
from sparkwright.plans.common import rounded
from sparkwright.plans.fixtures import GAPS_NUMERIC, lineitem_gaps, table


def s1_csv_scan(spark, d):
    """orders written as CSV with pandas null tokens in place of some values, read back typed."""
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") == "P", F.lit("NA")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("null")).otherwise(F.col("o_totalprice").cast("string"))
        .alias("o_totalprice"),
        "o_orderpriority",
        F.concat(F.lit('{"key": "'), F.col("o_orderkey").cast("string"), F.lit('", "note": "a, ""b""\n'),
                 F.col("o_orderpriority"), F.lit('"}')).alias("note"))
    path = S.write_csv(o, S.scratch_path(spark, "orders_csv"))
    # bound by name: declared in another order than written
    return S.read_csv(spark, path, "o_custkey bigint, o_orderkey bigint, note string, o_orderstatus string, "
                                   "o_totalprice double, o_orderpriority string")


def s2_stage_scan(spark, d):
    """Cleaned table (conditional median fill, de-duplicated) handed to the next stage as Parquet."""
    cleaned = P.drop_duplicates(P.median_fill(lineitem_gaps(spark, d), GAPS_NUMERIC, 20.0))
    path = S.write_table(cleaned, S.scratch_path(spark, "cleaned"))
    return S.read_stage(spark, path, "profile and clean")


def s5_csv_report(spark, d):
    """Grouped statistics report written as CSV with a header and read back."""
    rep = rounded(P.group_stats(table(spark, d, "orders"), "o_orderpriority", "o_totalprice"))
    path = S.write_csv(rep, S.scratch_path(spark, "group_report"), index_by=["o_orderpriority"])
    return S.read_csv(spark, path, "`Unnamed: 0` int, o_orderpriority string, mean double, std double, count bigint") \
        .withColumnRenamed("Unnamed: 0", "row")


def s4_literal_rows_joined(spark, d):
    """Literal lookup rows (declared priority ranks) joined to orders and counted; other priorities have no rank."""
    lit = S.literal_rows(spark, [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3)], "o_orderpriority string, rank int")
    o = table(spark, d, "orders")
    return o.join(F.broadcast(lit), "o_orderpriority", "left").groupBy("o_orderpriority", "rank") \
        .agg(F.count(F.lit(1)).alias("orders"))


QUERIES = {name: fn for name, fn in list(globals().items())
           if callable(fn) and name[:1] == "s" and name[1:2].isdigit()}
