import pytest
from pyspark.sql import functions as F

from flatspan.operators import features
from tests.conftest import rows


def test_redundant(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 5.0 - i * i) for i in range(1, 5)], "a double, b double, c double")
    assert features.redundant_columns(df) == ["b", "c"]
    assert features.redundant_columns(df, protected=["b", "c"]) == []
    order = spark.createDataFrame([(1.0, 1.1, 10.0), (2.0, 2.1, 1.0), (3.0, 3.1, 5.0)], "a double, b double, c double")
    assert features.redundant_columns(order) == ["b"]
    assert features.redundant_columns(order.select("a")) == []


def test_dropped_column_drops_no_other(spark):
    # b goes with a, c goes with b only: c stays, as b is gone before its turn.
    df = spark.range(200).select(
        F.col("id").cast("double").alias("a"), (F.col("id") + 12 * (F.col("id") % 2) * 2).cast("double").alias("b")
    ).withColumn("c", F.col("b") + 24 * ((F.col("a") / 2).cast("int") % 2) * 2.2)
    pairs = {(r[0], r[1]): r[2] for r in __import__("flatspan.operators.profile", fromlist=["x"]).correlation_pairs(df).collect()}
    threshold = (pairs["a", "c"] + min(pairs["a", "b"], pairs["b", "c"])) / 2
    assert features.redundant_columns(df, threshold) == ["b"]


def test_log_and_scale(spark):
    df = spark.createDataFrame([(1.0, -1.0, 7.0)] * 30 + [(1000.0, 900.0, 7.0)], "x double, neg double, k double")
    assert features.skewed_columns(df) == ["x"]
    logged = features.apply_log1p(df, ["x", "absent"])
    scale = features.fit_scale(logged)
    assert scale.zero_variance == ["k"]
    out = features.apply_scale(logged, scale).agg(F.avg("x"), F.stddev_samp("x"), F.max("k")).first()
    assert out[0] == pytest.approx(0.0, abs=1e-9) and out[1] == pytest.approx(1.0) and out[2] == 7.0


def test_one_hot_with_missing_and_unseen(spark):
    fit = spark.createDataFrame([("red",), ("blue",), (None,)], "color string")
    new = spark.createDataFrame([("red",), ("purple",), (None,)], "color string")
    encoding = features.fit_encoding(fit)
    out = features.apply_encoding(new, encoding)
    assert out.columns == ["color___unknown__", "color_blue", "color_red"]
    assert rows(out) == [(0, 0, 0), (0, 0, 1), (1, 0, 0)]


def test_dummy_names_stay_apart(spark):
    names = features.dummy_names("c", ["a b", "a.b", "a_b"])
    assert len(set(names.values())) == 3


def test_frequency(spark):
    fit = spark.createDataFrame([("SP",)] * 50 + [("RJ",)] * 30 + [("MG",)] * 20, "state string")
    encoding = features.fit_encoding(fit, ohe_threshold=2)
    assert encoding.strategies == {"state": "frequency"}
    new = spark.createDataFrame([(1, "SP"), (2, "RJ"), (3, "nowhere"), (4, None)], "id int, state string")
    assert rows(features.apply_encoding(new, encoding)) == [(1, 0.5), (2, 0.3), (3, 0.0), (4, 0.0)]


def test_frequency_denominator_has_the_missing_rows(spark):
    fit = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    assert rows(features.frequency_table(fit, "c")) == [("a", 2, 0.5), ("b", 1, 0.25)]


def test_frequency_hot_and_cold_values(spark):
    # One value has half of the rows, 2000 values have one row each: both ways of the lookup.
    df = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("v"))
    out = features.apply_frequency(df, "v", features.frequency_table(df, "v"))
    assert out.count() == 4000
    assert {(r["v"], r["n"]) for r in out.groupBy("v").agg(F.count("*").alias("n")).collect()} == {(0.5, 2000), (0.00025, 2000)}


def test_pipeline_protects(spark):
    df = spark.range(300).select(
        F.col("id").cast("string").alias("order_id"),
        (F.exp(F.pmod(F.xxhash64("id"), F.lit(100)) / 20)).alias("price"),
        (F.exp(F.pmod(F.xxhash64("id"), F.lit(100)) / 20) * 1.05).alias("total"),
        F.concat(F.lit("city"), (F.col("id") % 30).cast("string")).alias("city"),
        F.concat(F.lit("pay"), (F.col("id") % 3).cast("string")).alias("pay"),
        (F.col("id") % 10 == 0).cast("int").alias("late"),
    )
    model = features.fit_features(df, protected=["order_id", "late"])
    out = features.apply_features(df, model)
    assert model.redundant == ["total"] and model.log_columns == ["price"]
    assert model.encoding.strategies == {"city": "frequency", "pay": "one_hot"}
    assert rows(out, "order_id", "late") == rows(df, "order_id", "late")
    steps = {r["step"] for r in features.feature_report(df, model).collect()}
    assert steps == {"redundant_dropped", "log1p", "scaled", "frequency", "one_hot"}


def test_dummies_keep_clear_of_other_columns(spark):
    df = spark.createDataFrame([("b", 1, "x"), ("c", 2, "y")], "a string, a_b int, z string")
    out = features.apply_one_hot(df, {"a": ["b", "c"], "z": ["x", "y"]})
    assert out.columns == ["a_b", "a_b_2", "a_c", "z_x", "z_y"]


def test_frequency_of_a_single_column(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    out = features.apply_frequency(df, "v", features.frequency_table(df, "v"))
    assert sorted(r["v"] for r in out.collect()) == [0.0, 0.25, 0.5, 0.5]
