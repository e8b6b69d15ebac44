"""Tables behind the reference's charts (A17-A20), computed at scale.

Each returns the aggregate a chart would be drawn from, never the raw points:
equal-width histograms, box-plot statistics, a bucketed series and a 2-D
density. Empty bins are kept by a left join from the bin ids (a parameter-
sized range), so the shape of the table does not depend on the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.functions.numeric import nan_to_null
from sparkwright.operators.quantile import quantile_wide
from sparkwright.operators.ranking import average_rank


def _bin(v, lo, hi, k: int):
    width = hi - lo
    raw = F.when(width == 0, F.lit(0)).otherwise(F.floor((v - lo) / width * k))
    return F.least(raw, F.lit(k - 1)).cast("int")


def histogram_table(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max], the last bin closed on the right: bin, lower, upper, count."""
    v = nan_to_null(column)
    vals = df.select(v.alias("v")).where(F.col("v").isNotNull())
    mm = vals.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    counts = (vals.crossJoin(F.broadcast(mm)).select(_bin(F.col("v"), F.col("lo"), F.col("hi"), bins).alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    ids = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    edges = ids.crossJoin(F.broadcast(mm)).select(
        "bin", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bin") / bins).alias("lower"),
        (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("bin") + 1) / bins).alias("upper"))
    return edges.join(counts, "bin", "left").select("bin", "lower", "upper",
                                                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def box_table(df: DataFrame, key: str, value: str, k: float = 1.5, few_groups: bool | None = None) -> DataFrame:
    """Per group: Q1, median, Q3, whiskers (extreme points within k*IQR of the box), flier count."""
    v = nan_to_null(value)
    base = df.where(F.col(key).isNotNull()).select(key, v.alias("v")).where(F.col("v").isNotNull())
    q = quantile_wide(base, ["v"], [0.25, 0.5, 0.75], by=[key], few_groups=few_groups).select(
        key, F.col("v__q0").alias("q1"), F.col("v__q1").alias("median"), F.col("v__q2").alias("q3"))
    lo = F.col("q1") - F.lit(k) * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + F.lit(k) * (F.col("q3") - F.col("q1"))
    # q has one row per group: broadcast when the groups are known to be few, else AQE decides.
    j = base.join(F.broadcast(q) if few_groups else q, key)
    return j.groupBy(key, "q1", "median", "q3").agg(
        F.min(F.when(F.col("v") >= lo, F.col("v"))).alias("whisker_low"),
        F.max(F.when(F.col("v") <= hi, F.col("v"))).alias("whisker_high"),
        F.count_if((F.col("v") < lo) | (F.col("v") > hi)).alias("fliers"))


def ordered_series(df: DataFrame, order_key: str, value: str, points: int = 100) -> DataFrame:
    """Measure against row position, down-sampled to ``points`` buckets of consecutive rows.

    Position = rank of the (unique) key, computed without a global sort; bucket =
    floor((position - 1) * points / n). Returns bucket, first/last key, min/mean/max.
    """
    ranked = average_rank(df, order_key).select(order_key, "rank")
    n = df.agg(F.count(F.lit(1)).alias("__n"))
    pos = df.select(order_key, value).join(ranked, order_key).crossJoin(F.broadcast(n))
    b = pos.withColumn("bucket", F.floor((F.col("rank") - 1) * points / F.col("__n")).cast("int"))
    return b.groupBy("bucket").agg(F.min(order_key).alias("first_key"), F.max(order_key).alias("last_key"),
                                   F.min(value).alias("min"), F.avg(value).alias("mean"),
                                   F.max(value).alias("max"), F.count(F.lit(1)).alias("rows"))


def density_2d(df: DataFrame, x: str, y: str, bins_x: int = 20, bins_y: int = 20) -> DataFrame:
    """Counts on an equal-width bins_x x bins_y grid over both ranges (non-empty cells)."""
    base = df.select(nan_to_null(x).alias("x"), nan_to_null(y).alias("y")) \
        .where(F.col("x").isNotNull() & F.col("y").isNotNull())
    mm = base.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    return (base.crossJoin(F.broadcast(mm))
            .select(_bin(F.col("x"), F.col("x0"), F.col("x1"), bins_x).alias("bin_x"),
                    _bin(F.col("y"), F.col("y0"), F.col("y1"), bins_y).alias("bin_y"))
            .groupBy("bin_x", "bin_y").agg(F.count(F.lit(1)).alias("count")))
