"""Derived inputs shared by the registered queries.

The given tables have no nulls, no duplicates and no learnable target, so each
condition an operator needs is created by the SAME expression on both sides:
a Spark builder here and the matching SQL common table expression for DuckDB.
Every fixture reads a whole table; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- lineitem with gaps: nulls under 20 % (discount, tax) and over 20 % (qty_sparse)
def lineitem_gaps(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_quantity", "l_extendedprice",
        F.expr("nullif(l_discount, 0)").alias("l_discount"),
        F.expr("nullif(l_tax, 0)").alias("l_tax"),
        F.when(F.col("l_returnflag") == "A", F.lit(None)).otherwise(F.col("l_quantity")).alias("qty_sparse"),
        "l_returnflag", "l_linestatus")


LINEITEM_GAPS_SQL = """lg AS (
  SELECT l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax,
         CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_quantity END AS qty_sparse,
         l_returnflag, l_linestatus
  FROM lineitem)"""

GAPS_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "qty_sparse", "l_returnflag", "l_linestatus"]
GAPS_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "qty_sparse"]


# ---- lineitem projected to five columns: many whole-row duplicates
DUP_COLUMNS = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def lineitem_dups(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*DUP_COLUMNS)


LINEITEM_DUPS_SQL = "ld AS (SELECT l_quantity, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem)"


# ---- numeric text with unparseable entries
def lineitem_text(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.when(F.col("l_linenumber") == 7, F.lit("n/a"))
                     .otherwise(F.col("l_quantity").cast("string")).alias("qty_text"))


LINEITEM_TEXT_SQL = """lt AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END AS qty_text
  FROM lineitem)"""


# ---- feature table: learnable target net, binary label net > median(net), split by md5 of key
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "rf_code", "ls_code"]
# Fixed declared orders used by the ordinal encoder on lineitem flags.
RETURNFLAG_LEVELS = ["N", "R", "A"]
LINESTATUS_LEVELS = ["O", "F"]


def lineitem_base(spark, sf_dir) -> DataFrame:
    """Key, encoded features, net and the seeded test flag (no label)."""
    from sparkwright.functions.encoding import ordinal_code
    from sparkwright.functions.hashing import hash_unit
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("row_key"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        ordinal_code("l_returnflag", RETURNFLAG_LEVELS).alias("rf_code"),
        ordinal_code("l_linestatus", LINESTATUS_LEVELS).alias("ls_code"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("net")) \
        .withColumn("is_test", hash_unit("row_key", SEED) < F.lit(0.2))


def lineitem_features(spark, sf_dir) -> DataFrame:
    """``lineitem_base`` plus the binary label net > median(net) over the whole table."""
    from sparkwright.operators.features import median_label
    return median_label(lineitem_base(spark, sf_dir), "net")


LINEITEM_FEATURES_SQL = """lf0 AS (
  SELECT concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_key, l_quantity, l_extendedprice, l_discount, l_tax,
         CAST(coalesce(list_position(['N','R','A'], l_returnflag), 0) - 1 AS DOUBLE) AS rf_code,
         CAST(coalesce(list_position(['O','F'], l_linestatus), 0) - 1 AS DOUBLE) AS ls_code,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS net
  FROM lineitem),
lf AS (
  SELECT lf0.*, CAST(net > (SELECT quantile_cont(net, 0.5) FROM lf0) AS INTEGER) AS label,
         (('0x' || substr(md5(row_key || '|42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE) < 0.2 AS is_test
  FROM lf0)"""


# ---- deterministic scores for two fixed "models": evaluation without a fit
def scored_all(spark, sf_dir) -> DataFrame:
    """Tall predictions(model, row_key, is_test, label, score, pred, net, pred_net) over all rows.

    model_a: logistic of scaled extended price (strong); model_b: logistic of
    scaled quantity (weak, heavily tied). Scores rounded to 6 decimals on both
    sides. pred_net is a fixed linear regression prediction of net per model.
    """
    lf = lineitem_features(spark, sf_dir)
    # both models from one scan: each row emits (model_a, ...) and (model_b, ...)
    a = F.struct(F.lit("model_a").alias("model"),
                 F.round(1 / (1 + F.exp(-(F.col("l_extendedprice") - 36000.0) / 9000.0)), 6).alias("score"),
                 (F.col("l_extendedprice") * 0.95).alias("pred_net"))
    b = F.struct(F.lit("model_b").alias("model"),
                 F.round(1 / (1 + F.exp(-(F.col("l_quantity") - 25.0) / 8.0)), 6).alias("score"),
                 (F.col("l_extendedprice") * 0.9 + 1000.0).alias("pred_net"))
    return (lf.select("row_key", "is_test", "label", "net", F.inline(F.array(a, b)))
            .select("model", "row_key", "is_test", "label", "score", "net", "pred_net")
            .withColumn("pred", (F.col("score") >= 0.5).cast("int")))


def scored(spark, sf_dir) -> DataFrame:
    """Test-split predictions."""
    return scored_all(spark, sf_dir).where("is_test")


SCORED_SQL = LINEITEM_FEATURES_SQL + """,
sca AS (
  SELECT *, CAST(score >= 0.5 AS INTEGER) AS pred FROM (
    SELECT 'model_a' AS model, row_key, is_test, label,
           round(1 / (1 + exp(-(l_extendedprice - 36000.0) / 9000.0)), 6) AS score,
           net, l_extendedprice * 0.95 AS pred_net FROM lf
    UNION ALL
    SELECT 'model_b' AS model, row_key, is_test, label,
           round(1 / (1 + exp(-(l_quantity - 25.0) / 8.0)), 6) AS score,
           net, l_extendedprice * 0.9 + 1000.0 AS pred_net FROM lf)),
pr AS (SELECT * FROM sca WHERE is_test)"""


# ---- correlated measures with pair-dependent gaps (pairwise-complete semantics)
CORR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net"]


def lineitem_corr(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_quantity", "l_extendedprice",
                     F.expr("nullif(l_discount, 0)").alias("l_discount"),
                     F.expr("nullif(l_tax, 0)").alias("l_tax"),
                     (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("net"))


LINEITEM_CORR_SQL = """lc AS (
  SELECT l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS net
  FROM lineitem)"""


# ---- scored test rows with their features: input of the explanation stage
def explain_input(spark, sf_dir) -> DataFrame:
    lf = lineitem_base(spark, sf_dir).where("is_test")
    prob = F.round(1 / (1 + F.exp(-(F.col("l_extendedprice") - 36000.0) / 9000.0)), 6)
    return lf.select("row_key", *FEATURES, prob.alias("prob")).withColumn("pred", (F.col("prob") >= 0.5).cast("int"))


EXPLAIN_INPUT_SQL = LINEITEM_FEATURES_SQL + """,
ei AS (SELECT row_key, l_quantity, l_extendedprice, l_discount, l_tax, rf_code, ls_code, prob,
              CAST(prob >= 0.5 AS INTEGER) AS pred
       FROM (SELECT *, round(1 / (1 + exp(-(l_extendedprice - 36000.0) / 9000.0)), 6) AS prob FROM lf WHERE is_test))"""
