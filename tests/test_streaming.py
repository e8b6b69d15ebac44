"""The explanation operators give the same answers on a stream as in batch."""

from pyspark.sql import functions as F

from sparkwright import sources as S
from sparkwright.operators import explain as X
from sparkwright.streaming import explain_stream, start_audit_sink, start_parquet_sink
from tests.conftest import SF001


def test_stream_matches_batch(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    src = S.write_table(docs.repartition(4), S.scratch_path(spark, "docs_stream_src"))
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = S.scratch_path(spark, "docs_stream_out")
    q = start_parquet_sink(explain_stream(stream, "text").select("doc_id", "status", "error"), out, "explain_test")
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    batch = X.parse_and_validate(X.respond(docs, "text", 0.0, "raw"), "raw") \
        .select("doc_id", F.col("raw_status").alias("status"), "error")
    assert got.count() == docs.count()
    assert got.exceptAll(batch).count() == 0

    audit = S.scratch_path(spark, "docs_stream_audit")
    q2 = start_audit_sink(explain_stream(spark.readStream.schema(docs.schema).parquet(src), "text"), audit, "audit_test")
    q2.awaitTermination(300)
    totals = spark.read.parquet(audit).groupBy("status").agg(F.sum("n").alias("n"))
    assert totals.agg(F.sum("n")).first()[0] == docs.count()
