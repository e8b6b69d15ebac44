"""The guarded-explanation operators on Structured Streaming.

The reference has no stream. Its explanation step, however, is row-local (gate,
respond, validate), so the same column operators run unchanged on a streaming
DataFrame in append mode; only the per-batch audit needs an aggregation, written
with ``foreachBatch`` so each micro-batch is summarised once, in a folder of its own.
State-free: no watermark or state store is involved.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sparkwright.operators import explain as X
from sparkwright.session import ensure_checkpoint_dir


def explain_stream(stream: DataFrame, prompt: str, temperature: float = 0.0,
                   rules: X.ResponderRules = X.DEFAULT_RULES) -> DataFrame:
    """Gate, respond and validate each incoming prompt (stateless, append mode)."""
    r = X.respond(stream, prompt, temperature, "raw", rules)
    return X.parse_and_validate(r, "raw").withColumnRenamed("raw_status", "status")


def _checkpoint(df: DataFrame, path: str, name: str) -> str:
    """Checkpoint folder of one sink: the same name writing to another path starts afresh."""
    tag = hashlib.sha256(path.encode()).hexdigest()[:12]
    return f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/streams/{name}-{tag}"


def start_parquet_sink(df: DataFrame, path: str, name: str, available_now: bool = True) -> StreamingQuery:
    """Append validated rows to Parquet; the checkpoint lives under the shared checkpoint dir."""
    ckpt = _checkpoint(df, path, name)
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", ckpt).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def start_audit_sink(df: DataFrame, path: str, name: str, available_now: bool = True) -> StreamingQuery:
    """Per micro-batch (status, error) counts in Parquet (T14 on a stream), one ``batch_id`` folder per batch:
    a batch that is retried overwrites its own counts instead of adding them twice."""
    ckpt = _checkpoint(df, path, name)

    def write(batch: DataFrame, batch_id: int):
        X.guardrail_audit(batch, "status", "error").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    w = df.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
