"""Declared-order ordinal encoding (F1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordinal_code(c: str | Column, levels: list[str], null_code: float | None = None) -> Column:
    """Position of the value in ``levels`` (0-based) as double; unknown -> -1.0.

    ``array_position`` is 1-based and returns 0 when absent, so absent maps to -1.
    A NULL input stays NULL unless ``null_code`` is given.
    """
    col = F.col(c) if isinstance(c, str) else c
    code = (F.array_position(F.array(*[F.lit(v) for v in levels]), col) - 1).cast("double")
    if null_code is not None:
        code = F.when(col.isNull(), F.lit(float(null_code))).otherwise(code)
    return code
