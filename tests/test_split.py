import math

import pytest
from pyspark.sql import functions as F

from flatspan.operators import select, split
from tests.conftest import rows


@pytest.fixture(scope="module")
def frame(spark):
    # One group has a third of the rows, one class a tenth.
    return spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 200).alias("grp"),
        (F.col("id") % 10 == 0).cast("int").alias("y"),
    ).persist()


@pytest.mark.parametrize(
    "make, kind",
    [("int(id % 2)", split.BINARY), ("int(id % 4)", split.MULTICLASS), ("string(id % 4)", split.MULTICLASS), ("rand(1)", split.REGRESSION), ("int(id)", split.REGRESSION), ("double(id % 4)", split.REGRESSION)],
)
def test_task_type(spark, make, kind):
    assert split.detect_task_type(spark.range(100).selectExpr(f"{make} AS y"), "y") == kind


def test_stratified_split_is_exact_and_repeatable(frame):
    a = split.split_rows(frame, "id", "y")
    counts = {(r["y"], r["is_test"]): r["count"] for r in a.groupBy("y", "is_test").count().collect()}
    assert counts == {(0, False): 2160, (0, True): 540, (1, False): 240, (1, True): 60}
    assert rows(a.where("is_test"), "id") == rows(split.split_rows(frame.repartition(7), "id", "y").where("is_test"), "id")
    assert rows(a.where("is_test"), "id") != rows(split.split_rows(frame, "id", "y", seed=7).where("is_test"), "id")


def test_grouped_split(frame):
    out = split.split_groups(frame, "grp")
    assert split.group_overlap(out, "grp").isEmpty()
    groups = out.select("grp").distinct().count()
    assert out.where("is_test").select("grp").distinct().count() == math.ceil(groups * 0.2)
    assert not split.group_overlap(split.split_rows(frame, "id"), "grp").isEmpty()


def test_folds(frame):
    out = split.assign_folds(frame, "id", 5, "y")
    counts = {(r["y"], r["fold"]): r["count"] for r in out.groupBy("y", "fold").count().collect()}
    assert counts == {(y, k): 540 if y == 0 else 60 for y in (0, 1) for k in range(5)}
    plain = split.assign_folds(frame.limit(1001), "id", 5)
    assert sorted(r["count"] for r in plain.groupBy("fold").count().collect()) == [200, 200, 200, 200, 201]


def test_class_weights(frame):
    assert rows(split.class_weights(frame, "y")) == [(0, 2700, 3000 / 5400), (1, 300, 5.0)]


def test_feature_matrix(spark):
    df = spark.createDataFrame([(1, "g", 2.0, "t", 0)], "id int, grp string, x double, text string, y int")
    assert split.feature_matrix(df, "y", "id", "grp")[:2] == (["x"], ["text"])
    with pytest.raises(ValueError):
        split.feature_matrix(df, "absent")
    assert len(split.feature_matrix(df, "y", "no_id", "no_group")[2]) == 3


@pytest.mark.parametrize("scores, tie", [({"a": [0.9, 0.9], "b": [0.5, 0.5]}, False), ({"a": [0.9, 0.7], "b": [0.85, 0.65]}, True), ({"a": [0.5, 0.5], "b": [0.5, 0.5]}, False)])
def test_near_tie(spark, scores, tie):
    df = spark.createDataFrame([(m, i, s) for m, v in scores.items() for i, s in enumerate(v)], "model string, fold int, score double")
    board = select.leaderboard(df)
    row = select.near_tie(board).first()
    assert row["near_tie"] == tie and (row["note"] is not None) == tie
    assert board.where("is_best").first()["model"] == "a"
    assert select.near_tie(select.leaderboard(df.where("model = 'a'"))).count() == 0
