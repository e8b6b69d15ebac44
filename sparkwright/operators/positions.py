"""Positions of rows: an index from 0 in a declared order, gathers by it and zips along it.

Rows are range-partitioned by the order, then by a hash of the whole row and the row's place in the input, so that
equal order values, and even equal rows, spread over several partitions: no key is too hot. The sorted partitions are
stored; the rows of a group lie side by side in a partition, so a row's position is its place in the partition plus a
shift per (group, partition): the group's rows in earlier partitions. These shifts (groups + partitions rows) are the
only thing counted; no window spans a group's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from sparkwright.session import stored

HOT_PICKS = 1000           # an index that more than 1/HOT_PICKS of all picks ask for is hot: there are fewer than HOT_PICKS


def _row_hash(df: DataFrame):
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))])


def _sorted_rows(df: DataFrame, order: list) -> DataFrame:
    """The rows range-partitioned and sorted, stored with ``__at``: partition number * 2^33 + place in the partition."""
    keys = [*order, "__row_hash", "__rid"]
    tagged = df.withColumns({"__row_hash": _row_hash(df), "__rid": F.monotonically_increasing_id()})
    return stored(tagged.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__row_hash", "__rid")
                  .withColumn("__at", F.monotonically_increasing_id()), "positions")


def with_positions(df: DataFrame, order: list, by: list[str] | None = None, name: str = "position") -> DataFrame:
    """df with each row's position (long, from 0) in the given order, inside its group if ``by`` is given.

    order: column names or sort expressions; rows equal in all of them follow a hash of the whole row. The rows are
    stored, so positions stay when the result is read again or an executor is lost. Null is a group like any other."""
    by = by or []
    rows = _sorted_rows(df.drop(name), [*by, *order])
    part = F.shiftright("__at", 33).alias("__b")
    sizes = rows.groupBy(*by, part).agg(F.count(F.lit(1)).alias("__c"), F.min("__at").alias("__first"))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*[F.col(b).alias(f"__by{i}") for i, b in enumerate(by)], F.col("__b").alias("__part"),
                          (F.coalesce(F.sum("__c").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    on = F.shiftright("__at", 33) == F.col("__part")
    for i, b in enumerate(by):
        on = on & F.col(b).eqNullSafe(F.col(f"__by{i}"))
    # without groups there is one shift per range partition
    return rows.join(shifts if by else F.broadcast(shifts), on).withColumn(name, F.col("__at") + F.col("__shift")) \
        .select(*[c for c in df.columns if c != name], name)


def gather(df: DataFrame, picks: DataFrame, order: list, index: str = "index", missing: str = "null", row: str = "row") -> DataFrame:
    """Every row of picks with the row of df at its index, as a struct; repeated indexes repeat the row.

    Indexes count from 0 in the given order, negative ones from the end (-1 is the last row). An index out of range or
    null gives a null row (missing="null"), no row ("drop") or an error when the result is computed ("raise").
    Indexes that many picks share are looked up in a broadcast table of fewer than HOT_PICKS rows."""
    if missing not in ("null", "drop", "raise"):
        raise ValueError(f"missing={missing!r}")
    placed = with_positions(df, order, name="__position")
    n = placed.count()
    found = placed.select("__position", F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"))
    i = F.col(f"`{index}`").cast("long")
    asked = picks.drop(row).withColumn("__i", F.when(i < 0, i + n).otherwise(i))
    per_index = asked.groupBy("__i").agg(F.count(F.lit(1)).alias("__c"))
    total = per_index.agg(F.sum("__c").alias("__n"))
    hot = per_index.crossJoin(F.broadcast(total)).where(F.col("__c") * HOT_PICKS > F.col("__n")).select(F.col("__i").alias("__position"))
    hot_rows = found.join(F.broadcast(hot), "__position").select(F.col("__position").alias("__hot"), F.col("__row").alias("__hot_row"))
    seen = asked.join(F.broadcast(hot_rows), F.col("__i") == F.col("__hot"), "left")
    # picks that are answered, out of range or null go to unmatched keys of their own, spread over the partitions
    answered = F.col("__hot").isNotNull() | F.col("__i").isNull() | ~F.col("__i").between(0, n - 1)
    key = F.when(answered, -1 - F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))).otherwise(F.col("__i"))
    out = seen.withColumn("__key", key).join(found, F.col("__key") == F.col("__position"), "left") \
        .withColumn(row, F.coalesce("__hot_row", "__row"))
    if missing == "drop":
        out = out.where(F.col(row).isNotNull())
    elif missing == "raise":
        out = out.withColumn(row, F.coalesce(row, F.raise_error(F.concat(F.lit("index out of range: "), F.coalesce(i.cast("string"), F.lit("null"))))))
    return out.select(*[c for c in picks.columns if c != row], row)


def zip_rows(left: DataFrame, left_order: list, right: DataFrame, right_order: list) -> DataFrame:
    """position, left, right (structs): the two tables side by side in their orders, however they are partitioned.

    Tables of different length do not belong together: a ValueError tells both lengths."""
    a, b = with_positions(left, left_order, name="__position"), with_positions(right, right_order, name="__position")
    if a.count() != b.count():
        raise ValueError(f"tables of {a.count()} and {b.count()} rows cannot be zipped")
    whole = lambda d, src, alias: d.select("__position", F.struct(*[F.col(f"`{c}`") for c in src.columns]).alias(alias))
    return whole(a, left, "left").join(whole(b, right, "right"), "__position").withColumnRenamed("__position", "position")
