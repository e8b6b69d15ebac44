"""Profiling and cleaning operators.

Each summary is computed by ONE aggregate over the scan (partial aggregation on
the map side, a single-row final merge) and then unpivoted into a tall
``(column, metric...)`` table. Statistics are broadcast back to rows through a
cross join with a one-row aggregate, which Catalyst plans as a broadcast of
that single row: no shuffle of the big side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwright.session import cut_lineage
from sparkwright.operators.quantile import exact_quantiles, quantile_wide
from sparkwright.functions.numeric import (
    bias_corrected_skew, is_missing, nan_to_null, numeric_columns, safe_ratio,
)


def _cols(df: DataFrame, columns: list[str] | None, numeric: bool = False) -> list[str]:
    if columns is not None:
        return list(columns)
    return numeric_columns(df) if numeric else list(df.columns)


def _tall(one_row: DataFrame, columns: list[str], fields: dict[str, str], carry: list[str] | None = None) -> DataFrame:
    """Unpivot a one-row wide aggregate ``{metric}__{i}`` into rows per column.

    ``carry`` columns (e.g. the row count) are copied into every row, so the
    aggregate is referenced once and the table is scanned once.
    """
    structs = [
        F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("ordinal"),
                 *[F.col(f"{m}__{i}").cast(t).alias(m) for m, t in fields.items()],
                 *[F.col(k) for k in (carry or [])])
        for i, c in enumerate(columns)
    ]
    return one_row.select(F.inline(F.array(*structs)))


def _normalised(df: DataFrame, columns: list[str]) -> DataFrame:
    """Project to ``columns`` with NaN turned into NULL in floating columns."""
    exprs = []
    for c in columns:
        dt = df.schema[c].dataType
        exprs.append(nan_to_null(c).alias(c) if isinstance(dt, (T.DoubleType, T.FloatType)) else F.col(c))
    return df.select(*exprs)


# ---------------------------------------------------------------- S3 shape
def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) as one row."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def schema_table(df: DataFrame) -> DataFrame:
    """Schema as rows (ordinal, column, type). Built from metadata only."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column_name string, type string")


# ---------------------------------------------------------------- Q1 / Q2 / Q5 / Q8
def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column null_count and null_pct = 100*nulls/rows, sorted by pct desc, column asc."""
    cols = _cols(df, columns)
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count_if(is_missing(df, c)).alias(f"null_count__{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    tall = _tall(one, cols, {"null_count": "bigint"}, carry=["__n"])
    return (tall
            .select("column_name", "ordinal", "null_count",
                    (F.col("null_count") * F.lit(100.0) / F.col("__n")).alias("null_pct"))
            .orderBy(F.col("null_pct").desc(), F.col("ordinal"))
            .drop("ordinal"))


def high_null_columns(profile: DataFrame, threshold_pct: float = 20.0) -> DataFrame:
    """Columns whose null_pct is strictly above the threshold."""
    return profile.where(F.col("null_pct") > F.lit(threshold_pct)).select("column_name", "null_pct")


def null_drift(before: DataFrame, after: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """pct_after - pct_before per column (Q8), full outer join on the column name."""
    b = null_profile(before, columns).select("column_name", F.col("null_pct").alias("pct_before"))
    a = null_profile(after, columns).select("column_name", F.col("null_pct").alias("pct_after"))
    return (b.join(a, "column_name", "full_outer")
            .withColumn("drift", F.col("pct_after") - F.col("pct_before")))


# ---------------------------------------------------------------- Q3 / Q4 / F4
def median_fill(df: DataFrame, columns: list[str] | None = None, max_null_pct: float | None = 20.0,
                method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Fill NULL/NaN with the column median.

    With ``max_null_pct`` set (Q3) only numeric columns with ``0 < nulls`` and
    ``pct < max_null_pct`` are filled; ``None`` fills unconditionally (Q4).
    Null counts come from one aggregate, medians from the distributed exact
    quantile (``method="exact"``), Spark's ``percentile`` (``"percentile"``, fine
    for low-cardinality columns) or ``percentile_approx`` (``"approx"``); both
    are single rows, broadcast back to the rows.
    """
    cols = _cols(df, columns, numeric=True)
    norm = {c: nan_to_null(c) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.col(c)
            for c in cols}
    base = df.withColumns({c: e for c, e in norm.items()})
    aggs = [F.count(F.lit(1)).alias("__n")] + [F.count_if(F.col(c).isNull()).alias(f"__nulls{i}")
                                               for i, c in enumerate(cols)]
    stats = base.agg(*aggs)
    if method == "exact":
        meds = quantile_wide(base, cols, [0.5]).select(*[F.col(f"{c}__q0").alias(f"__med{i}") for i, c in enumerate(cols)])
        stats = stats.crossJoin(meds)
    else:
        stats = base.agg(*aggs, *[_median_expr(c, method, accuracy).alias(f"__med{i}") for i, c in enumerate(cols)])
    joined = base.crossJoin(F.broadcast(stats))
    out = {}
    for i, c in enumerate(cols):
        fill = F.coalesce(F.col(c), F.col(f"__med{i}").cast(df.schema[c].dataType))
        if max_null_pct is None:
            out[c] = fill
        else:
            pct = F.col(f"__nulls{i}") * 100.0 / F.col("__n")
            ok = (F.col(f"__nulls{i}") > 0) & (pct < F.lit(max_null_pct))
            out[c] = F.when(ok, fill).otherwise(F.col(c))
    return joined.withColumns(out).select(*df.columns)


def _median_expr(col: str, method: str, accuracy: int) -> Column:
    if method == "approx":
        return F.percentile_approx(col, 0.5, accuracy).cast("double")
    return F.percentile(F.col(col), F.lit(0.5)).cast("double")


# ---------------------------------------------------------------- Q6 / Q7
def duplicate_count(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each identical group (NULLs equal), as one row.

    A hash aggregate on the whole row with map-side combine: a group holding a
    third of the table collapses to one partial row per task before the shuffle.
    """
    cols = _cols(df, columns)
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__c"))
    return groups.agg(F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
                      F.coalesce(F.sum("__c"), F.lit(0)).cast("bigint").alias("rows"),
                      F.count(F.lit(1)).alias("distinct_rows"))


def drop_duplicates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Keep one row per identical group (whole-row match, or on ``columns``)."""
    return df.dropDuplicates(columns) if columns else df.dropDuplicates()


def dedup_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """rows_before, rows_after, rows_removed for a whole-row de-duplication (Q7)."""
    d = duplicate_count(df, columns)
    return d.select(F.col("rows").alias("rows_before"), F.col("distinct_rows").alias("rows_after"),
                    F.col("duplicates").alias("rows_removed"))


# ---------------------------------------------------------------- Q10 / Q11
def category_domain(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values with a 0-based code (dictionary encoding), for any number of values.

    The distinct values are range-partitioned (they are unique, so the ranges are even) and numbered inside
    their range; the sizes of the earlier ranges, a table of one row per partition, are added.
    """
    dom = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(dom.repartitionByRange(parts, "value").withColumn("__range", F.spark_partition_id()))
    sizes = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)   # one row per range
    starts = sizes.select("__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy("value")) - 1
    return (ranged.withColumn("__row", inside).join(F.broadcast(starts), "__range")
            .select("value", (F.col("__start") + F.col("__row")).cast("int").alias("code")))


def category_encode(df: DataFrame, column: str, code_col: str | None = None) -> DataFrame:
    """Replace a text column by its dictionary code; AQE broadcasts the domain when it measures it small."""
    dom = category_domain(df, column)
    out = code_col or f"{column}_code"
    return df.join(dom.withColumnRenamed("value", column), column, "left").withColumnRenamed("code", out)


def storage_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Raw text bytes vs dictionary-encoded bytes per column (Q11), in one scan.

    The columns are unpivoted to (column, value), grouped once by (column, value)
    with map-side combine (a hot value collapses to one partial row per task),
    then summarised per column: raw_bytes = sum(len * count); dict_bytes = sum of
    distinct value lengths + rows * code width (1/2/4 bytes for <=256 / <=65536 /
    more levels).
    """
    tall = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("ordinal"), F.col(c).cast("string").alias("v"))
                                        for i, c in enumerate(columns)])))
    per_value = tall.groupBy("ordinal", "v").agg(F.count(F.lit(1)).alias("cnt"))
    ln = F.octet_length("v")
    per_col = per_value.groupBy("ordinal").agg(
        F.sum("cnt").alias("__n"),
        F.coalesce(F.sum(ln * F.col("cnt")), F.lit(0)).cast("bigint").alias("raw_bytes"),
        F.count("v").alias("distinct_values"),
        F.coalesce(F.sum(ln), F.lit(0)).cast("bigint").alias("dict_value_bytes"))
    names = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("ordinal") + 1)
    width = (F.when(F.col("distinct_values") <= 256, 1)
             .when(F.col("distinct_values") <= 65536, 2).otherwise(4))
    return (per_col.withColumn("column_name", names)
            .withColumn("code_width", width.cast("int"))
            .withColumn("dict_bytes", (F.col("dict_value_bytes") + F.col("__n") * F.col("code_width")).cast("bigint"))
            .withColumn("saved_bytes", (F.col("raw_bytes") - F.col("dict_bytes")).cast("bigint"))
            .select("column_name", "raw_bytes", "distinct_values", "code_width", "dict_bytes", "saved_bytes"))


# ---------------------------------------------------------------- A1 / A2 / A3 / A4
def _pivot_probs(tall: DataFrame, keys: list[str], probs: list[float], names: list[str]) -> DataFrame:
    return tall.groupBy(*keys).agg(*[F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(n)
                                     for p, n in zip(probs, names)])


def describe(df: DataFrame, columns: list[str] | None = None, method: str = "exact",
             accuracy: int = 10000) -> DataFrame:
    """count, mean, std (n-1), min, 25%, 50%, 75%, max per numeric column; exact quantiles by default."""
    cols = _cols(df, columns, numeric=True)
    base = _normalised(df, cols)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"count__{i}"), F.avg(c).alias(f"mean__{i}"),
                 F.stddev_samp(c).alias(f"std__{i}"), F.min(c).cast("double").alias(f"min__{i}"),
                 F.max(c).cast("double").alias(f"max__{i}")]
        if method != "exact":
            q = (F.percentile_approx(c, [0.25, 0.5, 0.75], accuracy) if method == "approx"
                 else F.percentile(F.col(c), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))))
            aggs.append(q.alias(f"__q{i}"))
    one = base.agg(*aggs)
    fields = {"count": "bigint", "mean": "double", "std": "double", "min": "double", "max": "double"}
    if method != "exact":
        for i, _ in enumerate(cols):
            one = one.withColumns({f"q25__{i}": F.col(f"__q{i}")[0], f"q50__{i}": F.col(f"__q{i}")[1],
                                   f"q75__{i}": F.col(f"__q{i}")[2]})
        fields.update({"q25": "double", "q50": "double", "q75": "double"})
        tall = _tall(one, cols, fields)
    else:
        q = _pivot_probs(exact_quantiles(base, cols, [0.25, 0.5, 0.75]), ["column_name"], [0.25, 0.5, 0.75],
                         ["q25", "q50", "q75"])
        tall = _tall(one, cols, fields).join(q, "column_name", "left")
    return tall.select("column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def quantiles(df: DataFrame, column: str, probs: list[float], by: list[str] | None = None,
              method: str = "exact", accuracy: int = 10000, few_groups: bool | None = None) -> DataFrame:
    """Quantiles (linear interpolation, as pandas), optionally grouped; exact and distributed by default."""
    by = list(by or [])
    names = [f"p{round(p * 1000):03d}" for p in probs]
    if method == "exact":
        return _pivot_probs(exact_quantiles(df, [column], probs, by, few_groups=few_groups), by, probs, names)
    c = nan_to_null(column)
    q = F.percentile_approx(c, probs, accuracy) if method == "approx" \
        else F.percentile(c, F.array(*[F.lit(float(p)) for p in probs]))
    g = df.groupBy(*by).agg(q.alias("__q"))
    return g.select(*by, *[F.col("__q")[i].cast("double").alias(n) for i, n in enumerate(names)])


def skewness_table(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Bias-corrected skew (G1) per numeric column, ranked by |skew| desc (A3, A4)."""
    cols = _cols(df, columns, numeric=True)
    base = _normalised(df, cols)
    one = base.agg(*[bias_corrected_skew(c).alias(f"skew__{i}") for i, c in enumerate(cols)])
    return (_tall(one, cols, {"skew": "double"})
            .orderBy(F.abs("skew").desc_nulls_last(), "ordinal").drop("ordinal"))


def top_skewed(df: DataFrame, k: int, columns: list[str] | None = None) -> DataFrame:
    """The k columns with the largest |skew| (A4); ties keep column order."""
    return skewness_table(df, columns).limit(k)


def imputation_comparison(df: DataFrame, k: int = 2, columns: list[str] | None = None) -> DataFrame:
    """skew, mean, median and null count for the k most skewed columns."""
    cols = _cols(df, columns, numeric=True)
    base = _normalised(df, cols)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [bias_corrected_skew(c).alias(f"skew__{i}"), F.avg(c).alias(f"mean__{i}"),
                 F.count_if(F.col(c).isNull()).alias(f"nulls_before__{i}")]
    one = base.agg(*aggs)
    tall = _tall(one, cols, {"skew": "double", "mean": "double", "nulls_before": "bigint"})
    med = exact_quantiles(base, cols, [0.5]).select("column_name", F.col("value").alias("median"))
    return (tall.join(med, "column_name", "left")
            .orderBy(F.abs("skew").desc_nulls_last(), "ordinal").limit(k)
            .select("column_name", "skew", "mean", "median", "nulls_before"))


# ---------------------------------------------------------------- A5 / P5
def iqr_outliers(df: DataFrame, columns: list[str], k: float = 1.5) -> DataFrame:
    """Q1, Q3, IQR, fences at k*IQR and the count strictly outside them, per column.

    Two scans: one aggregate for the quartiles (broadcast as a single row),
    one conditional count over the rows; all columns share both scans.
    """
    base = _normalised(df, columns)
    qs = quantile_wide(base, columns, [0.25, 0.75]).select(
        *[F.array(F.col(f"{c}__q0"), F.col(f"{c}__q1")).alias(f"__q{i}") for i, c in enumerate(columns)])
    fences = {}
    for i, _ in enumerate(columns):
        q1, q3 = F.col(f"__q{i}")[0], F.col(f"__q{i}")[1]
        fences[f"Q1__{i}"] = q1
        fences[f"Q3__{i}"] = q3
        fences[f"IQR__{i}"] = q3 - q1
        fences[f"lower__{i}"] = q1 - F.lit(k) * (q3 - q1)
        fences[f"upper__{i}"] = q3 + F.lit(k) * (q3 - q1)
    fences_row = qs.withColumns(fences)
    counts = base.crossJoin(F.broadcast(fences_row)).agg(
        *[F.first(F.col(f"{m}__{i}")).alias(f"{m}__{i}") for i in range(len(columns))
          for m in ("Q1", "Q3", "IQR", "lower", "upper")],
        *[F.count_if((F.col(c) < F.col(f"lower__{i}")) | (F.col(c) > F.col(f"upper__{i}")))
          .alias(f"outlier_count__{i}") for i, c in enumerate(columns)])
    fields = {"Q1": "double", "Q3": "double", "IQR": "double", "lower": "double", "upper": "double",
              "outlier_count": "bigint"}
    return _tall(counts, columns, fields).drop("ordinal")


def outside_range(df: DataFrame, column: str, lower: float, upper: float) -> DataFrame:
    """Rows with value < lower or > upper (strict at both ends, P5)."""
    return df.where((F.col(column) < F.lit(lower)) | (F.col(column) > F.lit(upper)))


# ---------------------------------------------------------------- A6 - A9
def group_stats(df: DataFrame, key: str, value: str, domain: DataFrame | None = None) -> DataFrame:
    """mean, std (n-1) and count of ``value`` per non-null ``key``.

    ``domain``: one row per category in column ``key`` (a categorical's declared levels); categories that
    do not occur are kept with NULL mean and std and count 0, as pandas does with observed=False."""
    if domain is not None:
        found = group_stats(df, key, value)
        return domain.select(key).join(found, key, "left").select(key, "mean", "std", F.coalesce("count", F.lit(0)).alias("count"))
    v = nan_to_null(value) if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)) else F.col(value)
    return (df.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.count(v).alias("count")))


def group_mean_sorted(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean per group, ascending."""
    v = nan_to_null(value) if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)) else F.col(value)
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(v).alias("mean"))
            .orderBy("mean", key))


def group_argmax(stats: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    """For each metric, the group with the highest value; ties go to the smallest key.

    A group without the metric (NULL or NaN, as the std of one row) never wins."""
    # min over (-value, key): the highest value first, then the smallest key. One pass, no join.
    parts = [stats.where(~is_missing(stats, m)).agg(F.lit(m).alias("metric"),
                       F.min_by(F.col(key), F.struct(F.negative(F.col(m)), F.col(key))).alias("group"),
                       F.max(m).alias("value"))
             for m in metrics]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def spread_ratio(stats: DataFrame, metric: str = "mean") -> DataFrame:
    """max(metric) / min(metric) over groups."""
    return stats.agg(safe_ratio(F.max(metric), F.min(metric)).alias("ratio"))


# ---------------------------------------------------------------- A15 / A16 / A21 / A22
def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each non-null value, most frequent first (ties by value)."""
    return (df.where(~is_missing(df, column)).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(column)))


def min_max(df: DataFrame, column: str) -> DataFrame:
    """min and max of a column in one pass."""
    c = nan_to_null(column)
    return df.agg(F.min(c).alias("min"), F.max(c).alias("max"))


def percentile_interval(df: DataFrame, column: str, lo: float = 0.025, hi: float = 0.975,
                        by: list[str] | None = None, few_groups: bool | None = None) -> DataFrame:
    """mean and the [lo, hi] percentile interval of a sample (A21 / V11), exact and distributed."""
    by = list(by or [])
    q = _pivot_probs(exact_quantiles(df, [column], [lo, hi], by, few_groups=few_groups), by, [lo, hi],
                     ["ci_low", "ci_high"])
    m = df.groupBy(*by).agg(F.avg(column).alias("mean"))
    return (m.join(q, by, "left") if by else m.crossJoin(q)).select(*by, "mean", "ci_low", "ci_high")


def mean_pop_std(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """Mean and population standard deviation (numpy ddof=0) per group."""
    by = by or []
    return df.groupBy(*by).agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"),
                               F.count(column).alias("n"))
