"""Exact quantiles without funnelling a column into one task (A2 at scale).

Spark's ``percentile`` is exact but merges a value->count map per group in a
single final task, so its memory grows with the number of distinct values.
Here the order statistics are found by refinement: a first pass sketches, for each
column and quantile, an interval that is guaranteed to hold them
(``percentile_approx`` states its rank error); a second counts the values below each
interval; only the values inside the intervals, about 3 in 2000 of a column, are
counted per distinct value, shuffled and ranked with the bucketed prefix sums of
``ranking.cumulative``. The statistics at ranks floor(h)+1 and ceil(h)+1,
h = (n-1)q, are interpolated linearly, as pandas / numpy / DuckDB's
``quantile_cont`` do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwright.functions.numeric import nan_to_null
from sparkwright.operators.ranking import cumulative, histogram


ACCURACY = 2000          # of the first sketch: a value's rank is off by at most n / ACCURACY
SMALL = 2 * ACCURACY     # up to so many values, where the sketch's margin may be under two ranks, all are candidates


def _as_double(df: DataFrame, c: str):
    col = F.col(c).cast("double")
    return nan_to_null(col) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else col


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], by: list[str] | None = None,
                    buckets: int | None = None, few_groups: bool | None = None) -> DataFrame:
    """Tall (by..., column_name, prob, value): exact linear-interpolation quantiles; NULLs ignored.

    ``few_groups``: the ``by`` groups are known to be few (e.g. a handful of event types), so
    the per-group tables are broadcast; by default they are only when there is no ``by``."""
    by = list(by or [])
    few = (not by) if few_groups is None else few_groups
    vals = [f"__v{i}" for i in range(len(columns))]
    base = df.select(*by, *[_as_double(df, c).alias(v) for c, v in zip(columns, vals)])
    # ranks (p -+ margin) n around each target: wider than the sketch's error of n / ACCURACY on either side
    margin = 2.0 / ACCURACY
    marks = [max(0.0, p - margin) for p in probs] + [min(1.0, p + margin) for p in probs]
    sketch = base.groupBy(*by).agg(*[F.percentile_approx(v, [float(m) for m in marks], ACCURACY).alias(f"__s{i}")
                                     for i, v in enumerate(vals)],
                                   *[F.struct(F.count(v) <= SMALL, F.min(v), F.max(v)).alias(f"__e{i}")
                                     for i, v in enumerate(vals)])
    # one row of (columns x probs x 2) doubles per group
    near = base.crossJoin(F.broadcast(sketch)) if not by else base.join(F.broadcast(sketch) if few else sketch, by)
    k = len(probs)
    each = [(i, t) for i in range(len(columns)) for t in range(k)]
    low = lambda i, t: F.when(F.col(f"__e{i}.col1"), F.col(f"__e{i}.col2")).otherwise(F.col(f"__s{i}")[t])
    high = lambda i, t: F.when(F.col(f"__e{i}.col1"), F.col(f"__e{i}.col3")).otherwise(F.col(f"__s{i}")[t + k])
    wide = near.groupBy(*by).agg(*[F.count(v).alias(f"__n{i}") for i, v in enumerate(vals)],
                                 *[F.count_if(F.col(vals[i]) < low(i, t)).alias(f"__b{i}_{t}") for i, t in each])
    targets = wide.select(*by, F.inline(F.array(*[
        F.struct(F.lit(i).alias("__c"), F.lit(t).alias("__t"), F.lit(float(probs[t])).alias("prob"),
                 F.col(f"__n{i}").alias("__n"), F.col(f"__b{i}_{t}").alias("__below")) for i, t in each]))).where("__n > 0")
    h = F.col("prob") * (F.col("__n") - 1)
    targets = targets.select(*by, "__c", "__t", "prob", (F.floor(h) + 1 - F.col("__below")).alias("k_lo"),
                             (F.ceil(h) + 1 - F.col("__below")).alias("k_hi"), (h - F.floor(h)).alias("frac"))
    inside = near.select(*by, F.inline(F.array_compact(F.array(*[
        F.when((F.col(vals[i]) >= low(i, t)) & (F.col(vals[i]) <= high(i, t)),
               F.struct(F.lit(i).alias("__c"), F.lit(t).alias("__t"), F.col(vals[i]).alias("v"))) for i, t in each]))))
    keys = [*by, "__c", "__t"]
    cum = cumulative(histogram(inside, "v", keys), "v", keys, ["cnt"], buckets, few_groups=few)
    # Each candidate is matched to its target's two ranks in ONE join with (groups x columns x probs) rows;
    # without user groups those are few: broadcast, since a shuffle join on a handful of keys would put each
    # column's candidates in one task. Otherwise the planner broadcasts when AQE measures them small.
    lo_hit = (F.col("cum_cnt") - F.col("cnt") < F.col("k_lo")) & (F.col("k_lo") <= F.col("cum_cnt"))
    hi_hit = (F.col("cum_cnt") - F.col("cnt") < F.col("k_hi")) & (F.col("k_hi") <= F.col("cum_cnt"))
    hits = cum.join(F.broadcast(targets) if few else targets, keys).where(lo_hit | hi_hit)
    picked = hits.groupBy(*keys, "prob", "frac").agg(F.max(F.when(lo_hit, F.col("v"))).alias("x_lo"),
                                                     F.max(F.when(hi_hit, F.col("v"))).alias("x_hi"))
    names = F.array(*[F.lit(c) for c in columns])
    return picked.select(*by, names[F.col("__c")].alias("column_name"), "prob",
                         (F.col("x_lo") + (F.col("x_hi") - F.col("x_lo")) * F.col("frac")).alias("value"))


def quantile_wide(df: DataFrame, columns: list[str], probs: list[float], by: list[str] | None = None,
                  buckets: int | None = None, few_groups: bool | None = None) -> DataFrame:
    """One row per group with ``{column}__q{j}`` for the j-th prob (for broadcasting back to rows)."""
    by = list(by or [])
    t = exact_quantiles(df, columns, probs, by, buckets, few_groups)
    aggs = [F.max(F.when((F.col("column_name") == c) & (F.col("prob") == float(p)), F.col("value"))).alias(f"{c}__q{j}")
            for c in columns for j, p in enumerate(probs)]
    return t.groupBy(*by).agg(*aggs)
