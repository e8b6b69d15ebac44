"""Session helpers: one place that decides configuration for tests and bench.

On a cluster the session is created by the platform; ``ensure_checkpoint_dir``
only fills in a checkpoint directory when the cluster did not name one
(``spark.checkpoint.dir``), which is the case in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "sparkwright") -> SparkSession:
    """Local session tuned like a small cluster: AQE, skew-join splitting, UTC."""
    parts = shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint directory; create a scratch one only when unset.

    ``spark.checkpoint.dir`` names shared storage on a cluster. Only a local
    session without that setting (tests) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set on this cluster; "
                           "set it to shared storage before running lineage-cutting operators")
    scratch = tempfile.mkdtemp(prefix="sparkwright-ckpt-")
    sc.setCheckpointDir(scratch)
    return scratch


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared checkpoint directory (never a local one).

    The rows are persisted (memory, spilling to disk) while the checkpoint is written;
    without that, writing the checkpoint files recomputes the whole lineage a second time.
    """
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to a new folder of the shared checkpoint directory and read again."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored/{name}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
