"""Ranks without a global window.

``average_rank`` never sorts the table in one task. It works on the value
histogram (one row per distinct value and group, counts pre-aggregated on the
map side, so a value that holds a third of the rows is one row), splits each
group's distinct values into order-preserving buckets at approximate quantile
boundaries, runs the cumulative sum inside each bucket, and adds the bucket's
offset (the sum of all earlier buckets, a table of groups x buckets rows).
Average rank for ties = cum - (cnt - 1) / 2, as pandas ``rank()`` and the
rank-sum AUC need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.functions.numeric import is_missing

# Fan-out of one search level: the unrolled binary search is a nested CASE of 2 * buckets nodes; at 1024
# the generated code no longer compiles (Spark falls back to interpreted evaluation), at 256 it does.
# More buckets are reached by searching again inside each bucket, level by level.
FAN_OUT = 256


def _default_buckets(df: DataFrame) -> int:
    """One bucket per shuffle partition (at least 16) per group."""
    try:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # noqa: BLE001
        parts = 200
    return max(16, parts)


def _count_below(bounds: str, value: str, n: int):
    """Number of elements of the sorted array ``bounds`` (length n) that are < value.

    A binary search unrolled into nested CASE expressions: log2(n) comparisons per
    row, all in generated code (a higher-order ``filter`` would be O(n) and interpreted).
    """
    def search(lo: int, hi: int):
        if lo >= hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.element_at(F.col(bounds), mid + 1) < F.col(value), search(mid + 1, hi)) \
            .otherwise(search(lo, mid))
    return search(0, n)


def bucket_bounds(df: DataFrame, order: str, by: list[str] | None = None, buckets: int | None = None,
                  accuracy: int = 10000) -> DataFrame:
    """Per group, the approximate-quantile boundaries of ``order`` for one search level (one row per group)."""
    by = list(by or [])
    nb = min(buckets or _default_buckets(df), FAN_OUT)
    probs = [i / nb for i in range(1, max(nb, 2))]
    return df.where(F.col(order).isNotNull()).groupBy(*by).agg(
        F.percentile_approx(order, probs, accuracy).alias("__bounds", metadata={"n": len(probs)}))


def assign_buckets(hist: DataFrame, order: str, by: list[str] | None, buckets: int | None = None,
                   accuracy: int = 10000, few_groups: bool = False) -> DataFrame:
    """Add ``__bucket``: the order-preserving slice of the group's distinct values a row falls in.

    More than ``FAN_OUT`` buckets are found level by level: each bucket of a level has boundaries
    of its own. A bounds table has one row of at most ``FAN_OUT - 1`` doubles per group (and outer
    bucket). ``few_groups=True`` (the groups are parameter-sized: models, folds, replicates, column
    pairs, classes) broadcasts it: a shuffle join on a handful of group keys would send each group's
    whole histogram to one task. Otherwise AQE chooses after measuring it.
    """
    by = list(by or [])
    nb = buckets or _default_buckets(hist)
    if nb <= 1:
        return hist.withColumn("__bucket", F.lit(0))
    if nb > FAN_OUT:
        inner = -(-nb // FAN_OUT)
        outer = assign_buckets(hist, order, by, FAN_OUT, accuracy, few_groups).withColumnRenamed("__bucket", f"__outer{nb}")
        # the outer buckets of few groups are few as well: FAN_OUT rows of bounds per group and level
        both = assign_buckets(outer, order, [*by, f"__outer{nb}"], inner, accuracy, few_groups or not by)
        return both.withColumn("__bucket", F.col(f"__outer{nb}") * inner + F.col("__bucket")).drop(f"__outer{nb}")
    bounds = bucket_bounds(hist, order, by, nb, accuracy)
    keys = [c for c in bounds.columns if c != "__bounds"]
    n_bounds = bounds.schema["__bounds"].metadata["n"]
    # One row per group: tiny for a parameter-sized group set. With groups the
    # planner (AQE) picks broadcast only after measuring the table.
    if not keys:
        hb = hist.crossJoin(F.broadcast(bounds))
    else:
        hb = hist.join(F.broadcast(bounds) if few_groups else bounds, keys)
    return hb.withColumn("__bucket", _count_below("__bounds", order, n_bounds)).drop("__bounds")


def cumulative(hist: DataFrame, order: str, by: list[str] | None, sums: list[str],
               buckets: int | None = None, accuracy: int = 10000, few_groups: bool = False) -> DataFrame:
    """Inclusive prefix sums ``cum_<s>`` of columns ``sums`` along ``order`` within ``by``.

    ``hist`` must have one row per (by, order) value. No window ever spans a
    whole group: buckets split each group into ~equal slices of distinct values.
    """
    by = list(by or [])
    hb = assign_buckets(hist, order, by, buckets, accuracy, few_groups)
    within = Window.partitionBy(*by, "__bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    hb = hb.withColumns({f"__run_{s}": F.sum(s).over(within) for s in sums})

    totals = hb.groupBy(*by, "__bucket").agg(*[F.sum(s).alias(f"__tot_{s}") for s in sums])
    # groups x buckets rows; this window covers at most ``nb`` rows per group.
    before = Window.partitionBy(*([F.col(c) for c in by] or [F.lit(0)])).orderBy("__bucket") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "__bucket", *[
        F.coalesce(F.sum(f"__tot_{s}").over(before), F.lit(0.0)).alias(f"__off_{s}") for s in sums])

    out = hb.join(offsets, [*by, "__bucket"])
    out = out.withColumns({f"cum_{s}": F.col(f"__off_{s}") + F.col(f"__run_{s}") for s in sums})
    return out.drop("__bucket", *[f"__off_{s}" for s in sums], *[f"__run_{s}" for s in sums])


def histogram(df: DataFrame, value: str, by: list[str] | None = None, weight: str | None = None,
              extra_sums: dict | None = None) -> DataFrame:
    """One row per (by, non-null value): ``cnt`` (weighted) and optional extra sums; map-side combined."""
    by = list(by or [])
    w = F.col(weight) if weight else F.lit(1)
    aggs = [F.sum(w).cast("double").alias("cnt")]
    for name, col in (extra_sums or {}).items():
        aggs.append(F.sum(col).cast("double").alias(name))
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(*aggs).where(F.col("cnt") > 0)


def average_rank(df: DataFrame, value: str, by: list[str] | None = None, weight: str | None = None,
                 buckets: int | None = None, accuracy: int = 10000, extra_sums: dict | None = None,
                 few_groups: bool = False) -> DataFrame:
    """Histogram ``(by..., value, cnt, [extra sums], cum, rank)`` with average ranks per group.

    ``weight`` counts a row ``weight`` times (bootstrap replicate weights);
    ``extra_sums`` maps output names to columns summed per value (e.g. positives).
    NULL values are not ranked (pandas leaves them NaN).
    """
    by = list(by or [])
    hist = histogram(df, value, by, weight, extra_sums)
    c = cumulative(hist, value, by, ["cnt"], buckets, accuracy, few_groups).withColumnRenamed("cum_cnt", "cum")
    return c.withColumn("rank", F.col("cum") - (F.col("cnt") - F.lit(1.0)) / F.lit(2.0))


def rank_rows(df: DataFrame, value: str, by: list[str] | None = None, out: str = "rank",
              buckets: int | None = None) -> DataFrame:
    """Attach the average rank of ``value`` (within ``by``) to every row: histogram join-back.

    The join is on (group, value); a hot value is one row on the histogram side,
    and AQE's skew-join handling splits the matching partition of the row side.
    """
    by = list(by or [])
    h = average_rank(df, value, by, buckets=buckets).select(*by, value, F.col("rank").alias(out))
    return df.join(h, [*by, value], "left")


def sort_by_abs(df: DataFrame, column: str, tie_cols: list[str] | None = None) -> DataFrame:
    """Sort by |column| descending, ties by ``tie_cols`` (R2)."""
    return df.orderBy(F.abs(column).desc_nulls_last(), *(tie_cols or []))


def head_tail(df: DataFrame, order: list, k: int) -> DataFrame:
    """The first k and last k rows under ``order`` (R3), tagged 'head' / 'tail'.

    Each side is a TakeOrderedAndProject (per-task top-k, then a k-row merge).
    """
    if not all(isinstance(o, str) for o in order):
        raise ValueError("head_tail needs column names so the order can be reversed")
    head = df.orderBy(*[F.col(o).asc() for o in order]).limit(k).withColumn("end", F.lit("head"))
    tail = df.orderBy(*[F.col(o).desc() for o in order]).limit(k).withColumn("end", F.lit("tail"))
    return head.unionByName(tail)


def arg_max_row(df: DataFrame, by_col: str, ret_col: str, tie_col: str | None = None) -> DataFrame:
    """Value of ``ret_col`` on the row with the largest ``by_col``; first (smallest tie_col) on ties.

    Rows whose ``by_col`` is missing (NULL or NaN) never win."""
    tie = tie_col or ret_col
    return df.where(~is_missing(df, by_col)).agg(F.min_by(F.col(ret_col), F.struct(F.negative(F.col(by_col)), F.col(tie))).alias(ret_col),
                  F.max(by_col).alias(by_col))


def descending_cumulative(df: DataFrame, score: str, label: str, by: list[str] | None = None,
                          buckets: int | None = None, few_groups: bool = True) -> DataFrame:
    """Per distinct score, descending: cumulative positives ``tp`` and negatives ``fp``.

    ``few_groups``: the groups are models or splits; say False for groups that grow with the data."""
    by = list(by or [])
    neg = df.select(*by, F.negative(F.col(score)).alias("__ns"), F.col(label).cast("double").alias("__pos"))
    h = histogram(neg, "__ns", by, extra_sums={"pos": F.col("__pos")})
    c = cumulative(h, "__ns", by, ["cnt", "pos"], buckets, few_groups=few_groups)
    return c.select(*by, F.negative("__ns").alias(score), F.col("cnt").alias("n_at_score"),
                    F.col("pos").alias("pos_at_score"), F.col("cum_pos").alias("tp"),
                    (F.col("cum_cnt") - F.col("cum_pos")).alias("fp"))
