"""Positions, gathers, zips, and exact split, prefix and fold sizes when one key holds a third of the rows."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkwright.operators import features as FE
from sparkwright.operators import positions as PO


@pytest.fixture(scope="module")
def hot(spark):
    """One key, and some wholly equal rows, on a third of 30000 rows."""
    return spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"),
        (F.col("id") % 2).cast("int").alias("label"), F.when(F.col("id") % 6 == 0, 7).otherwise(F.col("id")).alias("v")).repartition(5).cache()


def test_positions_are_the_sorted_order(spark, hot):
    out = PO.with_positions(hot, ["key", "v"]).collect()
    assert sorted(r.position for r in out) == list(range(30000))
    assert [(r.key, r.v) for r in sorted(out, key=lambda r: r.position)] == sorted((r.key, r.v) for r in out)
    down = PO.with_positions(hot, [F.col("v").desc()]).orderBy("position").select("v").collect()
    assert [r.v for r in down] == sorted((r.v for r in out), reverse=True)


def test_positions_inside_groups_and_even_partitions(spark, hot):
    df = hot.withColumn("key", F.when(F.col("key") != "hot", F.expr("nullif(substr(key, 2, 1), '1')")).otherwise(F.col("key")))
    out = PO.with_positions(df, ["v"], by=["key"])
    rows = {}
    for r in out.collect():
        rows.setdefault(r.key, []).append((r.position, r.v))
    assert None in rows and len(rows["hot"]) == 10000
    for parts in rows.values():
        parts.sort()
        assert [p for p, _ in parts] == list(range(len(parts))) and [v for _, v in parts] == sorted(v for _, v in parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = [r["count"] for r in PO._sorted_rows(hot, ["key"]).groupBy(F.shiftright("__at", 33)).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(files) > 4 and max(files) < 2 * sorted(files)[len(files) // 2]      # the hot key is in several of them


def test_gather(spark, hot):
    table = PO.with_positions(hot, ["key", "v"]).select("position", "v").collect()
    at = {r.position: r.v for r in table}
    wanted = [0, 5, 5, -1, 29999, 30000, -30001, None] + [11] * 400
    picks = spark.createDataFrame([(i, w) for i, w in enumerate(wanted)], "pick long, index long").repartition(4)
    got = {r.pick: (r.row.v if r.row else None) for r in PO.gather(hot, picks, ["key", "v"]).collect()}
    assert got == {i: (at.get(w + 30000 if w < 0 else w) if w is not None else None) for i, w in enumerate(wanted)}
    assert PO.gather(hot, picks, ["key", "v"], missing="drop").count() == len(wanted) - 3
    with pytest.raises(Exception, match="index out of range"):
        PO.gather(hot, picks, ["key", "v"], missing="raise").collect()
    assert PO.gather(hot.limit(0), picks, ["key"]).where("row is not null").count() == 0


def test_zip(spark, hot):
    z = PO.zip_rows(hot.repartition(7), ["key", "v", "label"], hot.coalesce(1), ["key", "v", "label"])
    assert z.where(F.col("left") != F.col("right")).count() == 0 and z.count() == 30000
    with pytest.raises(ValueError, match="30000 and 10000"):
        PO.zip_rows(hot, ["v"], hot.where("key = 'hot'"), ["v"])


@pytest.mark.parametrize("fraction", [0.2, 0.37, 0.5, 0.0, 1.0])
def test_exact_split(spark, hot, fraction):
    out = FE.split_flag(hot, "key", 42, fraction, exact=True)
    assert out.columns == hot.columns + ["is_test"]
    n = out.groupBy("is_test").count().collect()
    assert {r.is_test: r["count"] for r in n}.get(True, 0) == math.ceil(fraction * 30000) and sum(r["count"] for r in n) == 30000


def test_nested_prefixes_are_exact_and_nested(spark, hot):
    fractions = [0.1, 0.33, 0.5, 0.9, 1.0]
    rows = FE.nested_prefixes(hot, "key", 1, fractions).collect()
    by = {f: Counter((r.key, r.label, r.v) for r in rows if r.fraction == f) for f in fractions}
    assert {f: sum(c.values()) for f, c in by.items()} == {f: int(f * 30000) for f in fractions}
    assert all(not by[a] - by[b] for a, b in zip(fractions, fractions[1:]))


def test_folds_differ_by_one_with_a_hot_key(spark, hot, monkeypatch):
    monkeypatch.setattr(FE, "HOT_ROWS", 100)
    out = FE.stratified_folds(hot, "key", "label", 5, 3)
    sizes = {(r.label, r.fold): r["count"] for r in out.groupBy("label", "fold").count().collect()}
    assert len(sizes) == 10 and out.count() == 30000
    for label in (0, 1):
        n = [sizes[label, f] for f in range(5)]
        assert max(n) - min(n) <= 1
    monkeypatch.setattr(FE, "HOT_ROWS", 10**9)
    plain = FE.stratified_folds(hot, "key", "label", 5, 3)
    assert out.exceptAll(plain).count() == 0                       # both ways deal the same rows
