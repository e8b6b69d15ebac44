"""sparkwright: profiling, cleaning, correlation, feature preparation, model
training/evaluation and guarded explanation as lazy Spark DataFrame operators.

Every operator is a plain function ``op(df, columns..., options...) -> DataFrame``.
Nothing here iterates over rows on the driver; the only driver reads are
bounded metadata (a handful of scalars, a column list, bucket totals whose size
is a parameter).
"""

__version__ = "0.1.0"
