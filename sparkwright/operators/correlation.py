"""Pearson and Spearman matrices, strongest pair, and their difference.

Both matrices are tall ``(col_a, col_b, ord_a, ord_b, value)`` with a < b by
column order (the upper triangle); ``to_square`` mirrors it with a diagonal
for the k x k view. Pairwise-complete semantics as pandas: each pair uses
the rows where both values are present.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.functions.numeric import nan_to_null
from sparkwright.operators.ranking import cumulative


def _clean(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])


def _pair_corr(a, b):
    """Pearson on pair-complete rows; NULL (pandas NaN) when a side is constant, never raises."""
    both = a.isNotNull() & b.isNotNull()
    aa, bb = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_samp(aa, bb), F.stddev_samp(aa) * F.stddev_samp(bb))


TILE = 12   # columns on either side of a block of pairs that one aggregate computes


def _corr_table(df: DataFrame, columns: list[str], left, right) -> DataFrame:
    """Tall correlation of all pairs i < j between ``left(i, j)`` and ``right(i, j)``.

    Pairs are computed in blocks of TILE x TILE columns, one aggregate pass per block that reads only the
    block's columns; up to TILE columns are a single pass."""
    tiles = [range(s, min(s + TILE, len(columns))) for s in range(0, len(columns), TILE)]
    out = None
    for x, y in combinations_with_replacement(range(len(tiles)), 2):
        pairs = [(i, j) for i in tiles[x] for j in tiles[y] if i < j]
        if not pairs:
            continue
        one = df.agg(*[_pair_corr(F.col(left(i, j)), F.col(right(i, j))).alias(f"r{i}_{j}") for i, j in pairs])
        rows = [F.struct(F.lit(columns[i]).alias("col_a"), F.lit(columns[j]).alias("col_b"),
                         F.lit(i).alias("ord_a"), F.lit(j).alias("ord_b"), F.col(f"r{i}_{j}").alias("value"))
                for i, j in pairs]
        part = one.select(F.inline(F.array(*rows)))
        out = part if out is None else out.unionByName(part)
    return out


_FLAT = 1e-12     # a variance below this share of the mean square (about the column's mean) is rounding, not spread


def _wide(base: DataFrame, columns: list[str]) -> DataFrame:
    """All pairs from masked cross products: two passes whatever the number of columns.

    The first pass takes the columns' means. In the second every task adds up four k x k matrices over its centred rows X
    (0 where missing) and their mask M: M'M counts a pair's complete rows, X'M, (X*X)'M and X'X are its sums. Spark adds the
    partial matrices cell by cell, so only tasks x k x k numbers are shuffled and none reach the driver."""
    k = len(columns)
    first = base.agg(*[F.avg(F.col(c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    means = np.array([first[f"m{i}"] or 0.0 for i in range(k)])

    def run(batches):
        n, sx, sxx, sxy = (np.zeros((k, k)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) - means
            present = ~np.isnan(x)
            x, mask = np.where(present, x, 0.0), present.astype(float)
            n += mask.T @ mask
            sx += x.T @ mask
            sxx += (x * x).T @ mask
            sxy += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), *[pa.array(list(m), pa.list_(pa.float64())) for m in (n, sx, sxx, sxy)]],
                                         names=["i", "n", "sx", "sxx", "sxy"])

    parts = base.mapInArrow(run, "i int, n array<double>, sx array<double>, sxx array<double>, sxy array<double>")
    cells = parts.select("i", F.posexplode(F.arrays_zip("n", "sx", "sxx", "sxy")).alias("j", "v")).groupBy("i", "j").agg(
        *[F.sum(f"v.{c}").alias(c) for c in ("n", "sx", "sxx", "sxy")])
    turned = cells.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("sx").alias("sy"), F.col("sxx").alias("syy"))
    per_row = lambda total: F.try_divide(total, F.col("n"))
    vx, vy = F.col("sxx") - per_row(F.col("sx") * F.col("sx")), F.col("syy") - per_row(F.col("sy") * F.col("sy"))
    spread = (F.col("n") > 1) & (vx > F.col("sxx") * _FLAT) & (vy > F.col("syy") * _FLAT)
    value = F.when(spread, (F.col("sxy") - per_row(F.col("sx") * F.col("sy"))) / F.sqrt(vx * vy))
    names = F.array(*[F.lit(c) for c in columns])
    return cells.where(F.col("i") < F.col("j")).join(turned, ["i", "j"]).select(
        names[F.col("i")].alias("col_a"), names[F.col("j")].alias("col_b"), F.col("i").alias("ord_a"), F.col("j").alias("ord_b"), value.alias("value"))


def pearson(df: DataFrame, columns: list[str]) -> DataFrame:
    """All k(k-1)/2 pairs over pair-complete rows: one aggregate for up to TILE columns, masked cross products beyond."""
    if len(columns) > TILE:
        return _wide(_clean(df, columns), columns)
    return _corr_table(_clean(df, columns), columns, lambda i, j: columns[i], lambda i, j: columns[j])


def spearman(df: DataFrame, columns: list[str], buckets: int | None = None) -> DataFrame:
    """Pearson of average ranks, ranks taken per pair over its pair-complete rows.

    A column has one histogram: per distinct value, how many rows also have partner j, for every other
    column j. One set of prefix sums turns the counts into the value's average rank among the rows complete
    with each partner, and the ranks are joined onto the rows once per column (k joins of the table; AQE
    broadcasts a small histogram and splits a hot value). A column without gaps has equal ranks for all partners.
    """
    base = _clean(df, columns)
    ranked = base
    for i, c in enumerate(columns):
        with_partner = {j: f"__n{i}_{j}" for j in range(len(columns)) if j != i}
        hist = base.where(F.col(c).isNotNull()).groupBy(c).agg(*[
            F.count_if(F.col(columns[j]).isNotNull()).cast("double").alias(n) for j, n in with_partner.items()])
        cum = cumulative(hist, c, None, list(with_partner.values()), buckets)
        ranks = cum.select(c, *[(F.col(f"cum_{n}") - (F.col(n) - F.lit(1.0)) / F.lit(2.0)).alias(f"__r{i}_{j}")
                                for j, n in with_partner.items()])
        ranked = ranked.join(ranks, c, "left")
    return _corr_table(ranked, columns, lambda i, j: f"__r{i}_{j}", lambda i, j: f"__r{j}_{i}")


def to_square(tall: DataFrame) -> DataFrame:
    """Mirror the upper triangle and add the diagonal: (col_a, col_b, value) for all k x k cells."""
    mirrored = tall.select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"),
                           F.col("ord_b").alias("ord_a"), F.col("ord_a").alias("ord_b"), "value")
    names = tall.select(F.col("col_a").alias("c"), F.col("ord_a").alias("o")).unionByName(
        tall.select(F.col("col_b").alias("c"), F.col("ord_b").alias("o"))).distinct()
    diag = names.select(F.col("c").alias("col_a"), F.col("c").alias("col_b"), F.col("o").alias("ord_a"),
                        F.col("o").alias("ord_b"), F.lit(1.0).alias("value"))
    return tall.unionByName(mirrored).unionByName(diag)


def strongest_pair(tall: DataFrame) -> DataFrame:
    """Pair with the largest |r| (strictly above 0; NULL never wins; first in column order on ties)."""
    return (tall.where(F.abs("value") > 0)
            .orderBy(F.abs("value").desc(), "ord_a", "ord_b").limit(1)
            .select("col_a", "col_b", "value"))


def difference_table(pearson_tall: DataFrame, spearman_tall: DataFrame) -> DataFrame:
    """pair, pearson, spearman, abs_diff sorted by abs_diff desc."""
    p = pearson_tall.select("col_a", "col_b", "ord_a", "ord_b", F.col("value").alias("pearson"))
    s = spearman_tall.select("col_a", "col_b", F.col("value").alias("spearman"))
    return (p.join(s, ["col_a", "col_b"])
            .select(F.concat_ws(" vs ", "col_a", "col_b").alias("pair"), "pearson", "spearman",
                    F.abs(F.col("spearman") - F.col("pearson")).alias("abs_diff"), "ord_a", "ord_b")
            .orderBy(F.col("abs_diff").desc_nulls_last(), "ord_a", "ord_b")
            .drop("ord_a", "ord_b"))
