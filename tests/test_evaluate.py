import pytest
from pyspark.sql import functions as F

from flatspan.operators import evaluate, facts
from tests.conftest import rows


def pairs(spark, data):
    return spark.createDataFrame(data, "actual int, predicted int")


def test_confusion_and_macro(spark):
    df = pairs(spark, [(0, 0)] * 5 + [(1, 0)] * 5)
    assert rows(evaluate.confusion_matrix(df)) == [(0, 0, 5), (0, 1, 0), (1, 0, 5), (1, 1, 0)]
    row = evaluate.macro_scores(df).first()
    assert row["recall_macro"] == 0.5 and row["precision_macro"] == 0.25 and row["f1_macro"] == pytest.approx(1 / 3, abs=1e-6)
    only_predicted = evaluate.macro_scores(pairs(spark, [(0, 2), (0, 0)])).first()
    assert only_predicted["recall_macro"] == 0.25


def test_accuracy_below_baseline(spark):
    row = evaluate.accuracy_vs_baseline(evaluate.confusion_matrix(pairs(spark, [(0, 1)] * 3 + [(0, 0)] * 5 + [(1, 1)] * 2))).first()
    assert (row["accuracy"], row["majority_baseline"], row["below_baseline"]) == (0.7, 0.8, True)


def test_roc_auc_with_ties(spark):
    data = [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1), (0, 0.5), (1, 0.2)]
    df = spark.createDataFrame(data, "label int, score double")
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert evaluate.roc_auc(df) == pytest.approx(want)
    assert evaluate.roc_auc(df.where("label = 1")) is None


def test_threshold_sweep_recall_falls(spark):
    df = spark.range(500).selectExpr("int(id % 5 = 0) AS label", "(id % 97) / 97.0D AS score")
    out = evaluate.threshold_sweep(df).orderBy("threshold").collect()
    assert [r["threshold"] for r in out] == [0.3, 0.4, 0.5]
    recalls = [r["recall_minority"] for r in out]
    assert recalls == sorted(recalls, reverse=True)
    assert all(r["true_positive"] + r["false_negative"] == 100 and r["true_negative"] + r["false_positive"] == 400 for r in out)


def test_threshold_sweep_other_labels(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.9), (2, 0.2)], "label int, score double")
    assert evaluate.threshold_sweep(df, thresholds=(0.5,)).first()["recall_minority"] == 0.5


def test_regression_metrics(spark):
    df = spark.createDataFrame([(float(y), 2.5) for y in (1, 2, 3, 4)], "actual double, predicted double")
    row = evaluate.regression_metrics(df, 1).first()
    assert row["rmse"] == pytest.approx(1.25**0.5, abs=1e-6) and row["mae"] == 1.0
    assert row["r2"] == 0.0 and row["adjusted_r2"] == -0.5
    assert evaluate.regression_metrics(df, 3).first()["adjusted_r2"] is None


def test_calibration(spark):
    bins = spark.createDataFrame([(0, 1, 0.0, 1.0), (1, 999, 0.51, 0.50)], "bin int, n long, prob_true double, prob_pred double")
    assert evaluate.calibration_error(bins).first()["ece"] == pytest.approx((1 + 0.01 * 999) / 1000, abs=1e-6)
    assert evaluate.calibration_error(bins.limit(0)).first()["ece"] == 0.0
    df = spark.range(1000).selectExpr("int(id % 3 = 0) AS label", "(id * 7919 % 1000) / 1000.0D AS score")
    out = evaluate.reliability_bins(df).collect()
    assert len(out) == 10 and sum(r["n"] for r in out) == 1000
    assert evaluate.reliability_bins(df.withColumn("score", F.lit(0.5))).count() == 0
    lumpy = df.withColumn("score", F.when(F.col("score") < 0.7, 0.2).otherwise(F.col("score")))
    assert sum(r["n"] for r in evaluate.reliability_bins(lumpy).collect()) == 1000


def test_segments_binary(spark):
    data = []
    for region, fn, fp in (("A", 3, 3), ("B", 3, 3), ("C", 27, 3)):
        data += [(region, 1, 0 if i < fn else 1) for i in range(30)] + [(region, 0, 1 if i < fp else 0) for i in range(30)]
    df = spark.createDataFrame(data, "region string, actual int, predicted int")
    out = {r["segment_value"]: r for r in evaluate.segment_errors_binary(df, ["region"]).collect()}
    assert [v for v, r in sorted(out.items()) if r["elevated_false_negative_rate"]] == ["C"]
    assert out["C"]["overall_false_negative_rate"] == pytest.approx(33 / 90, abs=1e-6)
    assert not any(r["elevated_false_positive_rate"] for r in out.values())
    worst = facts.worst_segments(evaluate.segment_errors_binary(df, ["region"])).collect()
    assert [(r["segment_value"], r["elevated"]) for r in worst] == [("C", "false negative rate")]


def test_small_segments_left_out(spark):
    df = spark.createDataFrame([("big", i % 2, 0) for i in range(80)] + [("tiny", 1, 0)] * 2, "grp string, actual int, predicted int")
    assert [r["segment_value"] for r in evaluate.segment_errors_binary(df, ["grp"]).collect()] == ["big"]
    only_negative = evaluate.segment_errors_binary(df.where("actual = 0"), ["grp"]).first()
    assert only_negative["n"] == 40


def test_segments_regression(spark):
    df = spark.range(100).selectExpr("IF(id < 50, 'low', 'high') AS zone", "100.0D AS actual", "IF(id < 50, 100.0D + id % 3 - 1, 20.0D) AS predicted")
    out = {r["segment_value"]: r for r in evaluate.segment_errors_regression(df, ["zone"]).collect()}
    assert out["high"]["elevated_mae"] and out["high"]["elevated_bias"] and out["high"]["mean_error"] > 0
    assert not out["low"]["elevated_mae"] and not out["low"]["elevated_bias"]


def test_segment_columns(spark):
    df = spark.range(500).select("id", *[(F.col("id") % k).alias(f"cat_{k}") for k in range(2, 7)])
    out = evaluate.segment_columns(df, ["id", *[f"cat_{k}" for k in range(2, 7)]], limit=2)
    assert [r["column_name"] for r in out.orderBy("place").collect()] == ["cat_6", "cat_5"]


def test_prediction_tables(spark):
    df = spark.range(100).selectExpr("id", "int(id % 2) AS actual", "int(id % 3 = 0) AS predicted", "0.75D AS confidence")
    some = evaluate.predictions_table_classification(df, "id", cap=10)
    assert some.count() == 10 and rows(some) == rows(evaluate.predictions_table_classification(df.repartition(5), "id", cap=10))
    assert evaluate.predictions_table_classification(df, "id").count() == 100
    row = evaluate.predictions_table_regression(spark.createDataFrame([(1, 3.0, 1.0)], "id int, actual double, predicted double"), "id").first()
    assert (row["error"], row["abs_error"]) == (-2.0, 2.0)


def test_importance_summary(spark):
    data = [("a", 0.3), ("a", 0.5), ("b", 0.1), ("b", -0.1), ("c", -0.4), ("c", -0.6)]
    out = facts.importance_summary(spark.createDataFrame(data, "feature string, drop double"))
    flags = {r["feature"]: r["distinguishable_from_zero"] for r in out.collect()}
    assert flags == {"a": True, "b": False, "c": True}
    assert [r["feature"] for r in facts.material_features(out).orderBy("place").collect()] == ["a", "c"]
