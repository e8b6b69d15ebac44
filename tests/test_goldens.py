"""Replay recorded tables of the reference through the operators (inputs and expected outputs
are the reference's published results; see FIXTURES.md section 2)."""

import csv
import io

import pytest
from pyspark.sql import functions as F

from sparkwright.operators import correlation as C
from sparkwright.operators import evaluate as V
from sparkwright.operators import explain as X
from sparkwright.operators import profile as P
from sparkwright.operators import ranking as R

NAMES = ["carat", "depth", "table", "price", "x", "y", "z"]
PEARSON = [
    [1.0, 0.02786088988604045, 0.18109110520764224, 0.9215483214030162, 0.9753796376444227, 0.951908406507332, 0.9535419924501989],
    [0.02786088988604045, 1.0, -0.2976691225286014, -0.011047521867952178, -0.02534832054165634, -0.029389122919680107, 0.09475724793583404],
    [0.18109110520764224, -0.2976691225286014, 1.0, 0.12656608744342743, 0.19485492285832526, 0.18323095190618846, 0.1502703192128784],
    [0.9215483214030162, -0.011047521867952178, 0.12656608744342743, 1.0, 0.88450403751755, 0.8653952444044999, 0.8612077326584772],
    [0.9753796376444227, -0.02534832054165634, 0.19485492285832526, 0.88450403751755, 1.0, 0.9745922289703873, 0.9706862032534104],
    [0.951908406507332, -0.029389122919680107, 0.18323095190618846, 0.8653952444044999, 0.9745922289703873, 1.0, 0.9518439491151917],
    [0.9535419924501989, 0.09475724793583404, 0.1502703192128784, 0.8612077326584772, 0.9706862032534104, 0.9518439491151917, 1.0],
]
SPEARMAN = [
    [1.0, 0.030288367523009004, 0.19416628822632137, 0.9629237103605653, 0.996161316027518, 0.995614499218142, 0.9932554165694383],
    [0.030288367523009004, 1.0, -0.24519443610160432, 0.010180992547264225, -0.02327299774519407, -0.0252468991419927, 0.10365133135920004],
    [0.19416628822632137, -0.24519443610160432, 1.0, 0.17102534698069036, 0.2014660593625918, 0.19495182095321803, 0.15910469115125705],
    [0.9629237103605653, 0.010180992547264225, 0.17102534698069036, 1.0, 0.9632599234537772, 0.9627883524929848, 0.9573092469126283],
    [0.996161316027518, -0.02327299774519407, 0.2014660593625918, 0.9632599234537772, 1.0, 0.9978926871145888, 0.9873662068242928],
    [0.995614499218142, -0.0252468991419927, 0.19495182095321803, 0.9627883524929848, 0.9978926871145888, 1.0, 0.9870809377475049],
    [0.9932554165694383, 0.10365133135920004, 0.15910469115125705, 0.9573092469126283, 0.9873662068242928, 0.9870809377475049, 1.0],
]


def _tall(spark, m):
    rows = [(NAMES[i], NAMES[j], i, j, m[i][j]) for i in range(7) for j in range(i + 1, 7)]
    return spark.createDataFrame(rows, "col_a string, col_b string, ord_a int, ord_b int, value double")


def test_a13_difference_table_top3(spark):
    d = C.difference_table(_tall(spark, PEARSON), _tall(spark, SPEARMAN)).collect()
    assert len(d) == 21
    assert [r["pair"] for r in d[:3]] == ["price vs y", "price vs z", "price vs x"]
    assert d[0]["abs_diff"] == pytest.approx(0.09739310808848489, abs=1e-12)


def test_a12_strongest_pair(spark):
    r = C.strongest_pair(_tall(spark, PEARSON)).first()
    assert (r["col_a"], r["col_b"]) == ("carat", "x")
    assert round(r["value"], 4) == 0.9754


def test_a8_a9_group_argmax_and_ratio(spark):
    stats = spark.createDataFrame([
        ("Fair", 4341.954317897372, 3540.1181375899655, 1598), ("Good", 3919.1210386424045, 3671.0709297752214, 4891),
        ("Ideal", 3462.7499534623976, 3810.926394322424, 21488), ("Premium", 4583.501891184173, 4348.052679510775, 13748),
        ("Very Good", 3981.016157096694, 3934.8131753885596, 12069)], "cut string, mean double, std double, count long")
    best = {r["metric"]: r["group"] for r in P.group_argmax(stats, "cut", ["mean", "std"]).collect()}
    assert best == {"mean": "Premium", "std": "Premium"}
    assert round(P.spread_ratio(stats).first()["ratio"], 4) == 1.3237


def _confusion_rows(spark, cells):
    df = spark.createDataFrame(cells, "label int, pred int, n int")
    return df.select("label", "pred", F.explode(F.array_repeat(F.lit(1), F.col("n"))).alias("_")).drop("_")


def test_v4_v7_from_confusion(spark):
    rows = _confusion_rows(spark, [(0, 0, 5227), (0, 1, 118), (1, 0, 153), (1, 1, 5261)])
    prf = V.precision_recall_f1(rows).first()
    assert round(prf["precision"], 4) == 0.9781 and round(prf["recall"], 4) == 0.9717
    rep = {r["cls"]: r for r in V.classification_report(rows).collect()}
    assert rep["accuracy"]["support"] == 10759
    assert round(rep["accuracy"]["precision"], 2) == 0.97
    cm = {(r["label"], r["pred"]): r["n"] for r in V.confusion_matrix(rows).collect()}
    assert cm == {(0, 0): 5227, (0, 1): 118, (1, 0): 153, (1, 1): 5261}


def test_r4_best_threshold(spark):
    sweep = spark.createDataFrame([(0.3, 0.9567, 0.9884, 0.9723), (0.4, 0.9699, 0.9808, 0.9753), (0.5, 0.9781, 0.9717, 0.9749),
                                   (0.6, 0.9849, 0.9612, 0.9729), (0.7, 0.989, 0.9474, 0.9677)],
                                  "threshold double, precision double, recall double, f1 double")
    assert V.best_threshold(sweep).first()["threshold"] == 0.4


def test_v12_interval_excludes_zero(spark):
    pos = spark.createDataFrame([(float(x) * 1e-5,) for x in range(7, 51)], "diff double")
    assert V.confidence_interval(pos).first()["excludes_zero"] is True
    mixed = spark.createDataFrame([(float(x) * 1e-5,) for x in range(-10, 51)], "diff double")
    assert V.confidence_interval(mixed).first()["excludes_zero"] is False


def test_r2_m3_coefficients_top3(spark):
    coef = spark.createDataFrame([("carat", 5116.673948049634), ("x", -1005.79844102926), ("clarity", 827.4624200920089),
                                  ("color", 547.4495759510702), ("cut", 134.37755676310928), ("depth", -120.28825523720764),
                                  ("table", -59.218890613637), ("y", 28.690265961895932), ("z", 15.6721940208042)],
                                 "feature string, coef double")
    assert [r["feature"] for r in R.sort_by_abs(coef, "coef", ["feature"]).limit(3).collect()] == ["carat", "x", "clarity"]


def test_r3_p7_bottom5_importances(spark):
    imp = spark.createDataFrame([("y", 0.38458125552736677), ("x", 0.21150531296708508), ("carat", 0.1989823271707657),
                                 ("z", 0.12090088950794935), ("clarity", 0.03799560873247201), ("color", 0.030553288196338062),
                                 ("depth", 0.0060655687578744216), ("cut", 0.004936905638572403), ("table", 0.004478843501576136)],
                                "feature string, importance double")
    tail = {r["feature"] for r in R.head_tail(imp, ["importance", "feature"], 5).where("end = 'head'").collect()}
    assert tail == {"clarity", "color", "depth", "cut", "table"}


# Recorded offline responses (part4 A/B table), three inputs.
FEATS = ["carat", "cut", "color", "clarity", "depth", "table", "x", "y", "z"]
INPUTS = [((0.30, 4.0, 6.0, 7.0, 61.5, 55.0, 4.29, 4.31, 2.64), 0, 0.0008333333333333333),
          ((1.20, 3.0, 4.0, 3.0, 62.0, 58.0, 6.80, 6.75, 4.20), 1, 1.0),
          ((1.80, 1.0, 1.0, 1.0, 63.5, 61.0, 7.65, 7.60, 4.85), 1, 1.0)]
RECORDED_AB = '''input,output_temp0,output_temp07,valid_temp0,valid_temp07,key_diff,next_step_t0,next_step_t07
1,"{""prediction_label"": ""below_median_price"", ""confidence_level"": ""low"", ""top_reason"": ""Stone dimensions are the main driver of price."", ""second_reason"": ""Quality grades (cut, clarity) add secondary signal."", ""next_step"": ""Use standard pricing workflow."", ""requires_human_review"": false}","{""prediction_label"": ""below_median_price"", ""confidence_level"": ""low"", ""top_reason"": ""Stone dimensions are the main driver of price."", ""second_reason"": ""Quality grades (cut, clarity) add secondary signal."", ""next_step"": ""Route to standard catalog with QA check."", ""requires_human_review"": false}",True,True,content varies,Use standard pricing workflow.,Route to standard catalog with QA check.
2,"{""prediction_label"": ""above_median_price"", ""confidence_level"": ""high"", ""top_reason"": ""Stone dimensions are the main driver of price."", ""second_reason"": ""Quality grades (cut, clarity) add secondary signal."", ""next_step"": ""Use standard pricing workflow."", ""requires_human_review"": false}","{""prediction_label"": ""above_median_price"", ""confidence_level"": ""high"", ""top_reason"": ""Stone dimensions are the main driver of price."", ""second_reason"": ""Quality grades (cut, clarity) add secondary signal."", ""next_step"": ""Escalate to premium pricing analyst."", ""requires_human_review"": false}",True,True,content varies,Use standard pricing workflow.,Escalate to premium pricing analyst.
3,"{""prediction_label"": ""above_median_price"", ""confidence_level"": ""high"", ""top_reason"": ""Stone dimensions are the main driver of price."", ""second_reason"": ""Quality grades (cut, clarity) add secondary signal."", ""next_step"": ""Use standard pricing workflow."", ""requires_human_review"": false}","{""prediction_label"": ""above_median_price"", ""confidence_level"": ""high"", ""top_reason"": ""Stone dimensions are the main driver of price."", ""second_reason"": ""Quality grades (cut, clarity) add secondary signal."", ""next_step"": ""Escalate to premium pricing analyst."", ""requires_human_review"": false}",True,True,content varies,Use standard pricing workflow.,Escalate to premium pricing analyst.
'''


def _scored_inputs(spark):
    rows = [(i + 1, *f, c, p) for i, (f, c, p) in enumerate(INPUTS)]
    schema = "input int, " + ", ".join(f"{f} double" for f in FEATS) + ", pred int, prob double"
    df = spark.createDataFrame(rows, schema).withColumn("prompt", X.render_prompt(FEATS, "pred", "prob"))
    return X.respond(X.respond(df, "prompt", 0.0, "raw_t0"), "prompt", 0.7, "raw_t07")


def test_t3_to_t13_replay_recorded_responses(spark):
    expected = list(csv.DictReader(io.StringIO(RECORDED_AB)))
    ab = X.ab_compare(_scored_inputs(spark), "raw_t0", "raw_t07").orderBy("input").collect()
    for got, exp in zip(ab, expected):
        assert got["raw_t0"] == exp["output_temp0"]
        assert got["raw_t07"] == exp["output_temp07"]
        assert got["a_valid"] and got["b_valid"]
        assert got["key_diff"] == exp["key_diff"] == "content varies"
        assert got["a_next_step"] == exp["next_step_t0"] and got["b_next_step"] == exp["next_step_t07"]
        assert got["raw_t0_status"] == "passed"


def test_t3_prompt_layout(spark):
    p = _scored_inputs(spark).orderBy("input").first()["prompt"]
    assert p.startswith('Feature values:\n{\n  "carat": 0.3,\n  "cut": 4.0,')
    assert p.endswith('"z": 2.64\n}\n\nPredicted class: 0\nPredicted probability for class 1: 0.0008\n\n'
                      'Explain this prediction as JSON only.')


def test_t5_t8_tiers(spark):
    rows = _scored_inputs(spark).select("input", X.parsed_probability(F.col("prompt")).alias("p")) \
        .select("input", X.confidence_tier(F.col("p")).alias("tier")).orderBy("input").collect()
    assert [r["tier"] for r in rows] == ["low", "high", "high"]


def test_t1_t2_guardrail_demo(spark):
    df = spark.createDataFrame([("My email is alice@example.com. Explain this.",),
                                ("Explain this prediction in JSON only.",)], "text string")
    st = [r["raw_status"] for r in X.respond(df, "text", 0.0, "raw").collect()]
    assert st == ["blocked", "passed"]
