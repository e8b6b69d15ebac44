"""Sources and sinks.

Text sources are read with an explicit schema (never ``inferSchema``: it is an
extra full pass over the data). Outputs go to shared storage: Parquet for tables,
CSV with a header for small reports. Scratch locations live under the cluster's
``spark.checkpoint.dir``, never a machine-local temporary folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwright.session import ensure_checkpoint_dir

# The text tokens pandas.read_csv treats as missing by default.
PANDAS_NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                      "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:8]}"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, null_tokens: list[str] | None = None,
             header: bool = True, multi_line: bool = True, strict: bool = True) -> DataFrame:
    """CSV scan with an explicit schema (S1); quoted fields may hold commas, doubled quotes and line breaks.

    Columns are bound by the header's names (by position without a header). Every column is read as text first so
    that pandas' null tokens can be nulled (Spark has a single ``nullValue``); each column is then cast to its
    declared type: a value that does not parse fails the job, or becomes NULL with ``strict=False``.
    ``multi_line=False`` lets Spark split large files that are known to have no quoted line breaks.
    """
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    tokens = PANDAS_NULL_TOKENS if null_tokens is None else null_tokens
    reader = (spark.read.option("header", header).option("nullValue", None).option("emptyValue", "").option("quote", '"')
              .option("escape", '"').option("multiLine", multi_line).option("mode", "PERMISSIVE"))
    if not header:
        reader = reader.schema(T.StructType([T.StructField(f.name, T.StringType(), True) for f in st.fields]))
    raw = reader.csv(path)
    missing = [f.name for f in st.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header {raw.columns}")
    cols = []
    for f in st.fields:
        c = F.when(~F.col(f"`{f.name}`").isin(*tokens), F.col(f"`{f.name}`"))
        typed = c if isinstance(f.dataType, T.StringType) else c.try_cast(f.dataType)
        if strict and not isinstance(f.dataType, T.StringType):
            told = F.concat(F.lit(f"column {f.name}: not a {f.dataType.simpleString()}: "), c)
            typed = F.when(c.isNotNull() & typed.isNull(), F.raise_error(told).cast(f.dataType)).otherwise(typed)
        cols.append(typed.alias(f.name))
    return raw.select(*cols)


def write_csv(df: DataFrame, path: str, single_file: bool = False, index_by: list[str] | None = None) -> str:
    """CSV sink with a header, quoted as pandas reads it (S5). ``single_file`` only for small reports (one writer task).

    ``index_by``: a report's rows are numbered from 0 in this order, in an unnamed first column as pandas' index."""
    out = df
    if index_by:
        position = F.row_number().over(Window.orderBy(*index_by)) - 1      # a report: one task numbers its rows
        out = df.select(position.alias("Unnamed: 0"), "*").orderBy("Unnamed: 0")
    out = out.coalesce(1) if single_file or index_by else out
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Parquet sink for tables handed to a later stage."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_stage(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """Read the output of an earlier stage; a missing input names the stage that should have written it."""
    try:
        return spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(f"missing input of stage '{stage}': {path}. Run that stage first.") from e
        raise


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First rows for display (S3); use an ``orderBy`` first for a deterministic preview."""
    return df.limit(n)


def literal_rows(spark: SparkSession, rows: list, schema: str | T.StructType) -> DataFrame:
    """Literal rows -> table."""
    return spark.createDataFrame(rows, schema)
