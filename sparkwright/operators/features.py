"""Feature preparation (F1-F6, P4, P8, P10): encoding, splits, folds, scaling, weights.

Splits and folds are functions of an md5 hash of the row key and a seed, so a
row lands in the same split on every run, on any partitioning, and in DuckDB.
Fitted statistics (scaler means, medians, class counts) are one-row or
K-row aggregates broadcast back to the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwright.functions.encoding import ordinal_code
from sparkwright.functions.hashing import hash_order, hash_unit
from sparkwright.functions.numeric import nan_to_null
from sparkwright.operators.positions import with_positions
from sparkwright.operators.quantile import quantile_wide
from sparkwright.session import stored


def ordinal_encode(df: DataFrame, levels: dict[str, list[str]], suffix: str = "") -> DataFrame:
    """Replace (suffix='') or add columns with declared-order codes; unknown -> -1 (F1, P10)."""
    return df.withColumns({f"{c}{suffix}": ordinal_code(c, lv) for c, lv in levels.items()})


def median_label(df: DataFrame, value: str, out: str = "label") -> DataFrame:
    """Binary label ``value > median(value)`` (strict), median over the whole table."""
    med = quantile_wide(df, [value], [0.5]).select(F.col(f"{value}__q0").alias("__median"))
    return df.crossJoin(F.broadcast(med)).withColumn(out, (F.col(value) > F.col("__median")).cast("int")) \
        .drop("__median")


def split_flag(df: DataFrame, key, seed: int = 42, test_fraction: float = 0.2, out: str = "is_test",
               exact: bool = False) -> DataFrame:
    """Seeded train/test assignment (F2).

    Default: ``hash_unit(key, seed) < fraction`` (size is fraction*n in
    expectation). ``exact=True`` takes exactly ceil(fraction * n) rows, those of the
    smallest hashes, by a cut-off found with counts; of rows that share the cut-off's hash (a repeated key) as
    many as are missing, in the order of a hash of the whole row.
    """
    if not exact:
        return df.withColumn(out, hash_unit(key, seed) < F.lit(test_fraction))
    h = df.withColumn("__h", hash_order(key, seed))
    cut = hash_cutoffs(h.select("__h"), [test_fraction], F.ceil).first()
    if cut["__take"] == cut["__of"]:
        return h.withColumn(out, F.col("__h") <= cut["__cut"]).drop("__h")
    tied = with_positions(h.where(F.col("__h") == cut["__cut"]), [], name="__place").withColumn(out, F.col("__place") < cut["__take"])
    rest = h.where(F.col("__h") != cut["__cut"]).withColumn(out, F.col("__h") < cut["__cut"])
    return rest.drop("__h").unionByName(tied.drop("__h", "__place"))


# A 60-bit hash is uniform: its top bits are buckets by arithmetic, without quantile boundaries.
_TOP, _MID = 12, 16
FOLD_BITS = 14            # hash buckets of a class when many rows are dealt to folds: many more than tasks, so that these are even
FOLD_ROWS = 250_000       # rows that one task numbers
HOT_ROWS = 10_000         # rows beyond twice the average that make a hash bucket too large for one task's window


def hash_cutoffs(h: DataFrame, fractions: list[float], rounding) -> DataFrame:
    """(fraction, __cut, __take, __of): the hash of the rounding(n * fraction)-th row in hash order (-1 for none of the
    rows), how many rows of that very hash belong to the first, and how many there are.

    ``h`` has the 60-bit hash ``__h``. The row is found by counting: rows per value of the top bits (at most
    2^12 table rows), then of the next bits inside the one bucket that holds it, then per hash among the about
    n / 2^28 hashes left. A hash that many rows share is one counted row throughout.
    """
    top = F.shiftright("__h", 60 - _TOP)
    mid = F.shiftright("__h", 60 - _TOP - _MID)
    wanted = F.explode(F.array(*[F.lit(float(f)) for f in fractions])).alias("fraction")
    upto = lambda *by: Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    counts = h.groupBy(top.alias("__b")).agg(F.count(F.lit(1)).alias("__c"))
    total = counts.agg(F.sum("__c").alias("__n")).select(wanted, "__n")
    goal = total.select("fraction", rounding(F.col("__n") * F.col("fraction")).alias("__k"))
    run = counts.withColumn("__run", F.sum("__c").over(upto(F.lit(0))))          # at most 2^12 rows
    first = run.join(F.broadcast(goal), (F.col("__run") - F.col("__c") < F.col("__k")) & (F.col("__k") <= F.col("__run"))) \
        .select("fraction", F.col("__b").alias("__top"), (F.col("__k") - F.col("__run") + F.col("__c")).alias("__k"))
    inner = h.select("__h", top.alias("__top")).join(F.broadcast(first), "__top")
    run = inner.groupBy("fraction", "__k", mid.alias("__b")).agg(F.count(F.lit(1)).alias("__c")) \
        .withColumn("__run", F.sum("__c").over(upto("fraction")))                # at most 2^16 rows per fraction
    second = run.where((F.col("__run") - F.col("__c") < F.col("__k")) & (F.col("__k") <= F.col("__run"))) \
        .select("fraction", F.col("__b").alias("__mid"), (F.col("__k") - F.col("__run") + F.col("__c")).alias("__k"))
    left = h.select("__h", mid.alias("__mid")).join(F.broadcast(second), "__mid")
    run = left.groupBy("fraction", "__k", "__h").agg(F.count(F.lit(1)).alias("__c")).withColumn(
        "__run", F.sum("__c").over(Window.partitionBy("fraction").orderBy("__h").rowsBetween(Window.unboundedPreceding, 0)))
    cut = run.where((F.col("__run") - F.col("__c") < F.col("__k")) & (F.col("__k") <= F.col("__run"))) \
        .select(F.col("fraction").alias("__f"), "__h", (F.col("__k") - F.col("__run") + F.col("__c")).alias("__t"), "__c")
    return goal.join(F.broadcast(cut), F.col("fraction") == F.col("__f"), "left") \
        .select("fraction", F.coalesce("__h", F.lit(-1)).alias("__cut"), F.coalesce("__t", F.lit(0)).alias("__take"), F.coalesce("__c", F.lit(0)).alias("__of"))


def nested_prefixes(df: DataFrame, key, seed: int, fractions: list[float]) -> DataFrame:
    """Every row once per fraction whose first int(fraction * n) rows of a seeded shuffle hold it (P8), with ``fraction``.

    The subsets are nested; all cut-offs come from one counting pass. Rows that share a cut-off's hash are taken in the
    order of a hash of the whole row."""
    h = df.withColumn("__h", hash_order(key, seed))
    cuts = hash_cutoffs(h.select("__h"), fractions, F.floor).collect()             # one row per fraction
    tied = sorted({r["__cut"] for r in cuts if r["__take"] != r["__of"]})
    table = df.sparkSession.createDataFrame(
        [(r["fraction"], r["__cut"], r["__take"], r["__cut"] if r["__cut"] in tied else r["__cut"] + 1) for r in cuts],
        "fraction double, __cut long, __take long, __below long")
    whole = h.join(F.broadcast(table), F.col("__h") < F.col("__below"))
    if tied:
        placed = with_positions(h.where(F.col("__h").isin(tied)), [], by=["__h"], name="__place")
        part = placed.join(F.broadcast(table), (F.col("__h") == F.col("__cut")) & (F.col("__cut") == F.col("__below"))
                           & (F.col("__place") < F.col("__take")))
        whole = whole.unionByName(part.drop("__place"))
    return whole.drop("__h", "__cut", "__take", "__below")


def nested_prefix(df: DataFrame, key, seed: int, fraction: float) -> DataFrame:
    """First int(fraction * n) rows of a seeded shuffle (P8); subsets are nested across fractions."""
    return nested_prefixes(df, key, seed, [fraction]).drop("fraction")


def stratified_folds(df: DataFrame, key, label: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold 0..k-1 per row; within each class the seeded order is dealt round-robin, so
    fold sizes per class differ by at most one (F6), also when keys repeat: rows of one hash
    are ordered by their columns. Rows are numbered inside (class, top hash bits) buckets, and the
    sizes of a class's earlier buckets (classes x buckets rows) are added; a key that fills a bucket is spread over range
    partitions instead (``positions``). There are more tasks as there are more rows, so that none grows with the table."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(6, (parts - 1).bit_length())
    fine, h = max(FOLD_BITS, bits), df.withColumn("__h", hash_order(key, seed))
    ties = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.StringType, T.BooleanType,
                                                                          T.DateType, T.TimestampType))]
    counted = stored(h.groupBy(label, F.shiftright("__h", 60 - fine).alias("__f")).agg(F.count(F.lit(1)).alias("__c")), "fold_counts")
    rows = counted.agg(F.sum("__c")).first()[0] or 0
    bits = fine if rows > parts * FOLD_ROWS else bits
    h = h.withColumn("__b", F.shiftright("__h", 60 - bits))
    sizes = stored(counted.groupBy(label, F.shiftright("__f", fine - bits).alias("__b")).agg(F.sum("__c").alias("__c")), "fold_sizes")
    most = sizes.agg(F.max("__c").alias("top"), F.avg("__c").alias("mean")).first()
    if most["top"] is not None and most["top"] > 2 * most["mean"] + HOT_ROWS:
        # a key repeats so often that its bucket stands out: the same numbers from range partitions
        placed = with_positions(h, ["__h", *ties], by=[label], name="__r")
        return placed.select(label, *[c for c in df.columns if c not in (label, out)], F.pmod("__r", F.lit(k)).cast("int").alias(out))
    if rows > parts * FOLD_ROWS:
        h = h.repartition(-(-rows // FOLD_ROWS), label, "__b")
    before = Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(label, "__b", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__s"))
    inside = F.row_number().over(Window.partitionBy(label, "__b").orderBy("__h", *[F.col(f"`{c}`") for c in ties])) - 1
    return (h.withColumn("__r", inside).join(starts, [label, "__b"])
            .withColumn(out, F.pmod(F.col("__s") + F.col("__r"), F.lit(k)).cast("int")).drop("__h", "__b", "__r", "__s"))


def fit_standard_scaler(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: mean and population std of each column (fit on the rows given, e.g. train only)."""
    v = {c: _present(df, c) for c in columns}
    return df.agg(*[F.avg(v[c]).alias(f"__mean_{c}") for c in columns],
                  *[F.stddev_pop(v[c]).alias(f"__std_{c}") for c in columns])


def _present(df: DataFrame, c: str):
    """The column with NaN as NULL (the one missing marker)."""
    return nan_to_null(c) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.col(c)


def apply_standard_scaler(df: DataFrame, stats: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / std; a constant column (std 0) is centred but not scaled, as sklearn does."""
    j = df.crossJoin(F.broadcast(stats))
    scaled = {c: (F.col(c) - F.col(f"__mean_{c}")) /
              F.when(F.col(f"__std_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"__std_{c}")) for c in columns}
    return j.withColumns(scaled).drop(*[f"__mean_{c}" for c in columns], *[f"__std_{c}" for c in columns])


def standardize(df: DataFrame, columns: list[str], fit_on: str | None = None) -> DataFrame:
    """Fit the scaler on rows where ``fit_on`` is true (or all rows) and apply it to every row."""
    fit_rows = df.where(F.col(fit_on)) if fit_on else df
    return apply_standard_scaler(df, fit_standard_scaler(fit_rows, columns), columns)


def fit_median_imputer(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row of exact medians (linear interpolation) per column (F4 fit)."""
    return quantile_wide(df, columns, [0.5]).select(*[F.col(f"{c}__q0").alias(f"__med_{c}") for c in columns])


def apply_median_imputer(df: DataFrame, medians: DataFrame, columns: list[str]) -> DataFrame:
    j = df.crossJoin(F.broadcast(medians))
    return j.withColumns({c: F.coalesce(_present(df, c), F.col(f"__med_{c}")) for c in columns}) \
        .drop(*[f"__med_{c}" for c in columns])


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights w_k = n / (K * n_k), one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_k"))
    tot = counts.agg(F.sum("n_k").alias("__n"), F.count(F.lit(1)).alias("__K"))
    return counts.crossJoin(F.broadcast(tot)).select(
        label, "n_k", (F.col("__n") / (F.col("__K") * F.col("n_k"))).alias("weight"))


FEW_CLASSES = 10_000      # weight tables of up to so many rows are broadcast


def with_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Attach the balanced weight to every row. The weight table, one row per class, is stored and counted: of a few
    classes it is broadcast, as a shuffle by the label would send each class to one task; with more it is joined."""
    w = stored(class_weights(df, label).select(label, F.col("weight").alias(out)), "class_weights")
    few = w.limit(FEW_CLASSES + 1).count() <= FEW_CLASSES
    return df.join(F.broadcast(w) if few else w, label)
