import pytest
from pyspark.sql import functions as F

from flatspan.operators import clean
from tests.conftest import column, rows


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "a int, b string")
    assert rows(clean.drop_duplicates(df)) == [(1, "x"), (2, "y")]
    assert clean.duplicate_counts(df).first()["n_duplicates_removed"] == 1
    empty = df.where("a > 9")
    assert clean.drop_duplicates(empty).count() == 0
    assert clean.duplicate_counts(empty).first()["n_duplicates_removed"] == 0


def test_duplicates_nulls_are_equal_and_first_by_order_stays(spark):
    df = spark.createDataFrame([(None, 3, "c"), (None, 1, "a"), (None, 2, "b"), (5, 1, "z")], "k int, t int, v string")
    assert rows(clean.drop_duplicates(df, ["k"], ["t"]), "k", "t", "v") == [(5, 1, "z"), (None, 1, "a")]


def test_placeholders(spark):
    df = spark.createDataFrame([("Cash",), ("UNKNOWN",), ("ERROR",), ("Credit Card",), ("N/A",)], "payment string")
    assert column(clean.placeholders_to_null(df), "payment") == ["Cash", "Credit Card", None, None, None]
    assert rows(clean.placeholder_counts(df)) == [("payment", 3)]


@pytest.mark.parametrize("text", ["AB-12", "CD-34", "real category", "-error-", "unknowns"])
def test_placeholder_needs_the_whole_text(spark, text):
    df = spark.createDataFrame([(text,)], "c string")
    assert clean.placeholders_to_null(df).first()["c"] == text
    assert clean.placeholder_counts(df).count() == 0


def test_placeholder_trims_every_white_space(spark):
    df = spark.createDataFrame([("\t Unknown \n",), ("  ",), ("x",)], "c string")
    assert column(clean.placeholders_to_null(df), "c") == ["x", None, None]


def test_custom_placeholders_replace_the_list(spark):
    df = spark.createDataFrame([("MISSING",), ("TBD",), ("real_value",), ("UNKNOWN",)], "c string")
    assert column(clean.placeholders_to_null(df, ["missing", "tbd"]), "c") == ["UNKNOWN", "real_value", None, None]


def test_numeric_text(spark):
    df = spark.createDataFrame([("10.5", "sao paulo", True), ("20.3", "rio", False), ("", "brasilia", True), ("1e3", "1d", True)], "amount string, city string, flag boolean")
    out, converted = clean.correct_types(df)
    assert converted == ["amount", "flag"]
    assert dict(out.dtypes) == {"amount": "double", "city": "string", "flag": "boolean"}
    assert column(out, "amount") == [10.5, 20.3, 1000.0, None]


def test_numeric_text_share_is_strict(spark):
    nine = spark.createDataFrame([(str(i),) for i in range(9)] + [("x",)], "c string")
    assert clean.correct_types(nine)[1] == []
    many = spark.createDataFrame([(str(i),) for i in range(19)] + [("x",)], "c string")
    assert clean.correct_types(many)[1] == ["c"]


def test_fill_values_learned_once(spark):
    fit = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (None, "b")], "x double, c string")
    new = spark.createDataFrame([(None, None), (100.0, "z")], "x double, c string")
    fills = clean.fit_fill_values(fit)
    assert fills.numeric == {"x": 2.0} and fills.categorical == {"c": "b"}
    assert rows(clean.fill_missing(new, fills)) == [(100.0, "z"), (2.0, "b")]


def test_fill_ties_and_all_null(spark):
    df = spark.createDataFrame([("b", None, None), ("a", None, None)], "c string, n double, s string")
    fills = clean.fit_fill_values(df)
    assert fills.categorical == {"c": "a", "s": "unknown"}
    assert fills.numeric == {"n": None}
    assert sorted(fills.high_missing) == ["n", "s"]


def test_integer_key_keeps_its_type(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (3, 2), (4, 5)], "id long, n int")
    out = clean.fill_missing(df, clean.fit_fill_values(df))
    assert dict(out.dtypes) == {"id": "bigint", "n": "int"}
    half = spark.createDataFrame([(1, 1), (2, None), (3, 2)], "id long, n int")
    assert column(clean.fill_missing(half, clean.fit_fill_values(half)), "n") == [1.0, 1.5, 2.0]


@pytest.mark.parametrize("threshold", [0.98, 0.5])
def test_low_variance(spark, threshold):
    df = spark.range(100).select(
        F.when(F.col("id") == 7, "canceled").otherwise("delivered").alias("constant"),
        F.col("id").alias("varied"),
        F.when(F.col("id") == 1, 1).alias("mostly_null"),
    )
    assert sorted(clean.low_variance_columns(df, threshold)) == ["constant", "mostly_null"]
    share = {r["column_name"]: r["top_share"] for r in clean.top_value_shares(df, threshold).collect()}
    assert share == {"constant": 0.99, "varied": None, "mostly_null": 0.99}


def test_clean_end_to_end(spark):
    data = [("1", "10.0", "books", "delivered"), ("2", "20.0", "toys", "delivered"), ("2", "20.0", "toys", "delivered"), ("3", None, "books", "delivered"), ("4", "40.0", None, "delivered")]
    df = spark.createDataFrame(data, "order_id string, price string, category string, status string")
    out, model, report = clean.clean(df, low_variance_threshold=0.9)
    assert report.n_duplicates_removed == 1
    assert report.low_variance_columns_dropped == ["status"]
    assert report.input_shape == (5, 4) and report.output_shape == (4, 3)
    assert sorted(report.columns_type_corrected) == ["order_id", "price"]
    assert out.where("price IS NULL OR category IS NULL").count() == 0
    again = clean.apply_cleaning(spark.createDataFrame([("9", "n/a", "NULL", "x")], df.schema), model)
    assert rows(again) == [(9.0, 20.0, "books")]


def test_clean_can_drop_mostly_missing_columns(spark):
    df = spark.createDataFrame(list(enumerate(["n/a", "-", "null", "ERROR", "a", "b", "c"])), "id int, c string")
    assert clean.clean(df)[0].columns == ["id", "c"]
    out, _, report = clean.clean(df, drop_high_missing=True)
    assert out.columns == ["id"] and report.high_missing_columns_dropped == ["c"]


def test_protected_columns_and_row_ids(spark):
    df = spark.createDataFrame([(1, None, 0.0), (1, None, 0.0), (2, None, 0.0), (3, 5.0, 1.0), (None, 5.0, None)], "k long, x double, y double")
    out, _, report = clean.clean(df, protected=["y"], row_id="row_id", low_variance_threshold=0.5)
    assert report.numeric_columns_imputed == ["k", "x"] and "y" in out.columns
    assert out.where("y is null").count() == 1 and out.select("row_id").distinct().count() == 4
