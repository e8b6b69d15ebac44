"""Registered queries for the guarded explanation stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.operators import explain as X
from sparkwright.plans.fixtures import FEATURES, explain_input, lineitem_features, table


def _prompts(spark, d):
    ei = explain_input(spark, d)
    return ei.withColumn("prompt", X.render_prompt(FEATURES, "pred", "prob"))


def _responses(spark, d):
    p = X.pii_flag(_prompts(spark, d), "prompt", "prompt_pii")  # one PII scan for both temperatures
    p = X.respond(p, "prompt", 0.0, "raw_t0", pii_col="prompt_pii")
    return X.respond(p, "prompt", 0.7, "raw_t07", pii_col="prompt_pii")


def _raw_union(spark, d):
    """Responses to validate: the responder's output for every scored row, plus the JSON
    property strings of ``events`` and the free text of ``conversations`` (never valid)."""
    r = _responses(spark, d).select(F.lit("response").alias("source"), F.col("row_key").alias("id"),
                                    F.col("raw_t0").alias("raw"))
    e = table(spark, d, "events").select(F.lit("event_props").alias("source"),
                                         F.col("event_id").cast("string").alias("id"), F.col("props").alias("raw"))
    c = table(spark, d, "conversations").select(
        F.lit("conversation").alias("source"), F.concat_ws("|", "conv_id", "turn").alias("id"), F.col("text").alias("raw"))
    return r.unionByName(e).unionByName(c)


def t1_pii_documents(spark, d):
    return X.pii_flag(table(spark, d, "documents").select("doc_id", "text"), "text").drop("text")


def t1_pii_conversations(spark, d):
    return X.pii_flag(table(spark, d, "conversations").select("conv_id", "turn", "text"), "text").drop("text")


def t2_guardrail_status(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return X.respond(docs, "text", 0.0, "raw").select("doc_id", F.col("raw_status").alias("status"))


def t3_prompt(spark, d):
    return _prompts(spark, d).select("row_key", "prompt")


def t3_prompt_edges(spark, d):
    """Missing, very small and very large feature values, and unrounded probabilities."""
    lf = lineitem_features(spark, d).where("is_test")
    x = F.col("l_extendedprice")
    edge = lf.select("row_key", F.expr("nullif(l_discount, 0)").alias("l_discount"), (F.col("l_tax") / 100).alias("l_tax"),
                     (x * 1000).alias("l_extendedprice"), (F.col("l_quantity") * 1e15).alias("l_quantity"),
                     (F.col("l_tax") / 1e6).alias("rf_code"), (-x * 1e9).alias("ls_code"),
                     (1 / (1 + F.exp(-(x - 36000.0) / 9000.0))).alias("prob"), F.col("label").alias("pred"))
    return edge.select("row_key", X.render_prompt(FEATURES, "pred", "prob").alias("prompt"))


def t4_extract(spark, d):
    p = _prompts(spark, d)
    prob = X.parsed_probability(F.col("prompt"))
    return p.select("row_key", prob.alias("prob_parsed"), X.parsed_class(F.col("prompt"), prob).alias("class_parsed"))


def t5_confidence_tier(spark, d):
    p = t4_extract(spark, d)
    return p.select("row_key", "prob_parsed", X.confidence_tier(F.col("prob_parsed")).alias("tier"))


def t6_next_step(spark, d):
    p = t4_extract(spark, d)
    return p.select("row_key", X.next_step(F.col("class_parsed"), 0.0).alias("next_step_t0"),
                    X.next_step(F.col("class_parsed"), 0.7).alias("next_step_t07"))


def t7_review_flag(spark, d):
    p = t4_extract(spark, d)
    return p.select("row_key", X.review_flag(F.col("class_parsed"), F.col("prob_parsed")).alias("requires_review"))


def t8_label_name(spark, d):
    p = t4_extract(spark, d)
    return p.select("row_key", X.label_name(F.col("class_parsed")).alias("prediction_label"))


def t9_response_json(spark, d):
    return _responses(spark, d).select("row_key", "raw_t0", "raw_t07")


def t10_validate(spark, d):
    v = X.parse_and_validate(_raw_union(spark, d), "raw")
    return v.select("source", "id", "valid", "error")


def t11_fallback_record(spark, d):
    v = X.parse_and_validate(_raw_union(spark, d), "raw")
    return v.select("source", "id", *X.RESPONSE_KEYS)


def t12_ab_compare(spark, d):
    ab = X.ab_compare(_responses(spark, d), "raw_t0", "raw_t07")
    return ab.select("row_key", F.col("a_valid").alias("valid_temp0"), F.col("b_valid").alias("valid_temp07"),
                     "key_diff", F.col("a_next_step").alias("next_step_t0"), F.col("b_next_step").alias("next_step_t07"))


def t13_result_table(spark, d):
    r = X.parse_and_validate(_responses(spark, d), "raw_t0", "t0_")
    return r.select("row_key", X.features_json(FEATURES, indent=False).alias("features"),
                    F.col("pred").alias("pred_class"), "prob", "raw_t0", F.col("t0_valid").alias("valid_temp0"),
                    F.col("raw_t0_status").alias("guardrail"))


def t14_guardrail_audit(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    r = X.parse_and_validate(X.respond(docs, "text", 0.0, "raw"), "raw")
    return X.guardrail_audit(r.withColumnRenamed("raw_status", "status"), "status", "error")


QUERIES = {name: fn for name, fn in list(globals().items())
           if callable(fn) and name[:1] == "t" and name[1:2].isdigit()}
