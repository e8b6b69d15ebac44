"""Edge fixtures (FIXTURES.md section 4)."""

import math

import pytest
from pyspark.sql import functions as F

from sparkwright import sources as S
from sparkwright.functions.numeric import coerce_numeric
from sparkwright.functions.text import has_pii
from sparkwright.operators import correlation as C
from sparkwright.operators import evaluate as V
from sparkwright.operators import explain as X
from sparkwright.operators import features as FE
from sparkwright.operators import profile as P


def test_constant_column(spark):
    df = spark.createDataFrame([(3.0, float(i)) for i in range(6)], "c double, v double")
    sk = {r["column_name"]: r["skew"] for r in P.skewness_table(df).collect()}
    assert sk["c"] == 0.0
    assert C.pearson(df, ["c", "v"]).first()["value"] is None
    scaled = FE.standardize(df, ["c"]).select("c").distinct().collect()
    assert [r["c"] for r in scaled] == [0.0]


def test_one_row_group_std_is_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 4.0)], "k string, v double")
    got = {r["k"]: r for r in P.group_stats(df, "k", "v").collect()}
    assert got["a"]["std"] is None and got["a"]["count"] == 1
    assert got["b"]["std"] == pytest.approx(math.sqrt(2.0))


def test_nan_null_and_signed_zero(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (-0.0,), (0.0,), (float("nan"),), (None,)], "v double")
    prof = P.null_profile(df).first()
    assert prof["null_count"] == 4
    d = P.duplicate_count(df).first()
    assert d["distinct_rows"] == 3 and d["duplicates"] == 3


def test_numeric_text_coercion(spark):
    cases = {"1d": None, " 5 ": 5.0, "0x1A": None, "inf": float("inf"), "abc": None, "1e3": 1000.0, "NaN": None,
             "": None, "1_000": None, "1,000": None, "-2.5": -2.5, ".5": 0.5}
    df = spark.createDataFrame([(k,) for k in cases], "s string").select("s", coerce_numeric("s").alias("v"))
    got = {r["s"]: r["v"] for r in df.collect()}
    assert got == cases


def test_csv_null_tokens(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a,b\nNA,1\nnull,2\nNaN,3\n,4\nx,n/a\n")
    rows = S.read_csv(spark, str(p), "a string, b double").orderBy(F.col("b").asc_nulls_last()).collect()
    assert [r["a"] for r in rows] == [None, None, None, None, "x"]
    assert rows[-1]["b"] is None


def test_interpolated_quartiles_and_skew(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 2, 5, 9, 30)], "v double")
    q = P.quantiles(df, "v", [0.25, 0.5, 0.75]).first()
    assert (q["p250"], q["p500"], q["p750"]) == (2.0, 3.5, 8.0)
    assert P.skewness_table(df).first()["skew"] == pytest.approx(2.0987866618, abs=1e-9)
    out = P.iqr_outliers(df, ["v"]).first()
    assert (out["lower"], out["upper"], out["outlier_count"]) == (-7.0, 17.0, 1)


def test_one_class_auc_null_and_bootstrap_skip(spark):
    df = spark.createDataFrame([("m", str(i), 1, i / 10.0) for i in range(10)], "model string, row_key string, label int, score double")
    assert V.roc_auc(df).first()["auc"] is None
    two = df.unionByName(df.withColumn("model", F.lit("n")))
    assert V.bootstrap_auc_difference(two, "m", "n", replicates=20).count() == 0


def test_no_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], "label int, pred int")
    r = V.precision_recall_f1(df).first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)


VALID = ('{"prediction_label": "a", "confidence_level": "low", "top_reason": "r", "second_reason": "s", '
         '"next_step": "n", "requires_human_review": false}')


@pytest.mark.parametrize("raw,expected", [
    (VALID, None), ("  " + VALID + "\n", None), (None, "no_response"),
    (VALID + " t", "json_error"), (VALID + "]", "json_error"), (VALID + "," + VALID, "json_error"),
    ('{"a":"x",}', "json_error"), ('{"a":01}', "json_error"), ("{'a':'x'}", "json_error"), ("", "json_error"),
    ("[1]", "schema_error"), ("5", "schema_error"), ("null", "schema_error"),
    (VALID.replace(', "next_step": "n"', ""), "schema_error"),
    (VALID.replace("}", ', "extra": 1}'), "schema_error"),
    (VALID.replace('"top_reason": "r"', '"top_reason": 5'), "schema_error"),
    (VALID.replace("false", '"true"'), "schema_error"),
    (VALID.replace('"low"', '["low"]'), "schema_error"),
    (VALID.replace('"low"', '"very"'), "schema_error"),
])
def test_json_validation(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "raw string")
    r = X.parse_and_validate(df, "raw").first()
    assert r["error"] == expected
    assert r["valid"] == (expected is None)
    if expected is not None:
        assert all(r[k] is None for k in X.RESPONSE_KEYS)
    else:
        assert r["requires_human_review"] is False and r["confidence_level"] == "low"


@pytest.mark.parametrize("text,expected", [
    ("x 555-123-4567 y", True), ("5551234567", True), ("55512345678", False), ("a@b", False), ("a@b.c", True),
    ("call ٥٥٥١٢٣٤٥٦٧ now", True), ("555 123 4567", True),
    ("+1 (663) 555-6869", False), ("no contact here", False),
])
def test_pii(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(has_pii("t").alias("p")).first()["p"] is expected


@pytest.mark.parametrize("raw", [VALID + "}", VALID + "]}", VALID + ',"#end-of-response#"', VALID + "]]", "[" + VALID])
def test_json_trailing_and_unbalanced(spark, raw):
    r = X.parse_and_validate(spark.createDataFrame([(raw,)], "raw string"), "raw").first()
    assert r["error"] == "json_error"


def test_expected_variant_schema_matches_a_valid_response(spark):
    got = spark.createDataFrame([(VALID,)], "j string").selectExpr("schema_of_variant(parse_json(j)) AS s").first()["s"]
    assert got == X.EXPECTED_VARIANT_SCHEMA


def test_caller_supplied_responder_and_failed_status(spark):
    """A responder runs per Arrow batch on non-blocked prompts only; None -> 'failed'."""
    seen = []

    def responder(system_prompt, prompts, temperature):
        assert system_prompt == "Answer as JSON."
        seen.extend(prompts.tolist())
        return prompts.map(lambda p: None if "fail" in p else VALID)

    df = spark.createDataFrame([(1, "explain a@b.com"), (2, "please fail"), (3, "explain")], "id int, p string")
    rows = {r["id"]: r for r in X.respond(df, "p", 0.0, "raw", responder=responder, system_prompt="Answer as JSON.").collect()}
    assert rows[1]["raw_status"] == "blocked" and rows[1]["raw"] is None
    assert rows[2]["raw_status"] == "failed" and rows[2]["raw"] is None
    assert rows[3]["raw_status"] == "passed" and rows[3]["raw"] == VALID


def test_roc_drop_intermediate(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.7, 0), (0.6, 0)], "score double, label int")
    pts = V.roc_curve(df, drop_intermediate=True).orderBy(F.col("threshold").desc()).collect()
    assert [r["threshold"] for r in pts] == [float("inf"), 0.9, 0.8, 0.6]
    assert [(r["fpr"], r["tpr"]) for r in pts] == [(0.0, 0.0), (0.0, 0.5), (0.0, 1.0), (1.0, 1.0)]


def test_stage_scan_names_missing_stage(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="profile and clean"):
        S.read_stage(spark, str(tmp_path / "nope"), "profile and clean")


def test_category_domain_takes_any_number_of_values(spark):
    df = spark.range(0, 500).select(F.col("id").cast("string").alias("c"))
    assert sorted((r.value, r.code) for r in P.category_domain(df, "c").collect()) == [(v, i) for i, v in enumerate(sorted(r.c for r in df.select("c").distinct().collect()))]
