"""Numeric helpers: NaN/NULL normalisation, text coercion, bias-corrected skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A number as pandas.to_numeric accepts it: optional sign, digits with an optional
# fraction and exponent, or inf/infinity/nan, surrounded by optional whitespace.
# Spark's own cast is laxer (it accepts a trailing 'd'/'f' type suffix), so the
# cast only runs behind this guard.
NUMERIC_TEXT_PATTERN = (
    r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"
)


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns whose type is numeric, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _is_float(df: DataFrame | None, name: str) -> bool:
    if df is None:
        return True
    dt = df.schema[name].dataType
    return isinstance(dt, (T.DoubleType, T.FloatType))


def nan_to_null(c: str | Column) -> Column:
    """NaN becomes NULL, so NULL is the one missing marker (pandas semantics)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)


def is_missing(df: DataFrame, name: str) -> Column:
    """True for NULL, and for NaN in floating columns."""
    col = F.col(name)
    if _is_float(df, name):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def coerce_numeric(c: str | Column) -> Column:
    """Text -> double, unparseable -> NULL (Q9). NaN text also becomes NULL."""
    col = F.col(c) if isinstance(c, str) else c
    s = col.cast("string")
    return F.when(s.rlike(NUMERIC_TEXT_PATTERN) & ~F.isnan(F.trim(s).try_cast("double")),
                  F.trim(s).try_cast("double"))


def bias_corrected_skew(c: str | Column) -> Column:
    """Adjusted Fisher-Pearson skewness G1 = g1 * sqrt(n(n-1)) / (n-2).

    Spark's ``skewness`` is the population g1. NULL for n < 3; a constant column
    (g1 undefined) gives 0.0 as pandas does.
    """
    col = F.col(c) if isinstance(c, str) else c
    n = F.count(col).cast("double")
    g1 = F.skewness(col)
    return F.when(n < 3, F.lit(None).cast("double")).otherwise(
        F.coalesce(g1 * F.sqrt(n * (n - 1)) / (n - 2), F.lit(0.0)))


def safe_ratio(num: Column, den: Column, default=None) -> Column:
    """num / den, NULL (or ``default``) when the divisor is zero; never raises under ANSI."""
    r = F.try_divide(num.cast("double"), den.cast("double"))
    return r if default is None else F.coalesce(r, F.lit(default))
