import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from flatspan.functions.quantiles import exact_quantiles, order_statistics
from flatspan.functions.schema import column_kinds, nan_to_null
from flatspan.operators import charts, profile
from tests.conftest import rows


def values(spark, name, xs):
    return spark.createDataFrame([(None if x is None else float(x),) for x in xs], f"{name} double")


def test_kinds_and_nan(spark):
    df = spark.createDataFrame([(1, "a", True, float("nan"), [1])], "i int, s string, b boolean, d double, l array<int>")
    assert [(r["column_name"], r["kind"]) for r in column_kinds(df).collect()] == [
        ("i", "numeric"), ("s", "categorical"), ("b", "categorical"), ("d", "numeric"), ("l", "excluded"),
    ]
    assert nan_to_null(df).first()["d"] is None


@pytest.mark.parametrize("limit", [10**6, 25, 1])
def test_quantiles_are_exact_on_both_paths(spark, limit):
    rng = random.Random(5)
    xs = [rng.choice([0.0, 0.0, rng.gauss(0, 1), rng.expovariate(1e-6), -1e12]) for _ in range(3000)]
    ys = [7.0] * 2900 + [rng.random() for _ in range(100)]
    df = spark.createDataFrame(list(zip(xs, ys)), "x double, y double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, ["x", "y"], probs, limit)
    for name, data in (("x", sorted(xs)), ("y", sorted(ys))):
        for p, value in zip(probs, got[name]):
            spot = (len(data) - 1) * p
            low = int(spot)
            want = data[low] + (data[min(low + 1, len(data) - 1)] - data[low]) * (spot - low)
            assert value == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_order_statistics_with_hot_values_and_extremes(spark):
    xs = [1.0] * 500 + [2.0] * 500 + [1e308, -1e308, 5e-324, 0.0]
    df = values(spark, "x", xs)
    got = order_statistics(df, {"x": list(range(0, len(xs), 97)) + [len(xs) - 1]}, open_limit=2)
    assert all(sorted(xs)[r] == v for (_, r), v in got.items())


def test_describe(spark):
    row = profile.describe(values(spark, "price", [10, 20, 30, 40, 1000, None])).first()
    assert (row["n"], row["mean"], row["min"], row["q50"], row["max"]) == (5, 220.0, 10.0, 30.0, 1000.0)
    assert row["std"] == pytest.approx(statistics.stdev([10, 20, 30, 40, 1000]))
    assert profile.describe(values(spark, "x", [None, None])).first()["q50"] is None


def test_correlation_matrix_is_symmetric_with_nulls_for_constants(spark):
    data = [(1.0, 2.0, 5.0, None), (2.0, 4.1, 5.0, 1.0), (3.0, 5.9, 5.0, 9.0), (4.0, 8.0, 5.0, 4.0)]
    df = spark.createDataFrame(data, "a double, b double, k double, g double")
    m = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation_matrix(df).collect()}
    assert len(m) == 16 and all(m[a, b] == m[b, a] for a, b in m)
    assert m["a", "a"] == 1.0 and m["k", "k"] is None and m["a", "k"] is None
    g, a = [1.0, 9.0, 4.0], [2.0, 3.0, 4.0]
    assert m["a", "g"] == pytest.approx(statistics.correlation(a, g))
    assert profile.correlation_matrix(df.select("a")).count() == 0


def test_skewness(spark):
    assert profile.skewness(values(spark, "x", [7] * 10)).first()["skewness"] == 0.0
    assert profile.skewness(values(spark, "x", [1, 2])).first()["skewness"] is None
    xs = [1, 2, 3, 10]
    n, m = 4, statistics.mean(xs)
    m2, m3 = sum((x - m) ** 2 for x in xs) / n, sum((x - m) ** 3 for x in xs) / n
    want = (n * (n - 1)) ** 0.5 / (n - 2) * m3 / m2**1.5
    assert profile.skewness(values(spark, "x", xs)).first()["skewness"] == pytest.approx(want)


def test_outliers(spark):
    row = profile.outlier_summary(values(spark, "x", [*range(1, 11), 100])).first()
    assert row["n_outliers"] == 1 and row["upper_fence"] < 100
    row = profile.outlier_summary(values(spark, "x", [*range(1, 9), 1000, -1000])).first()
    assert (row["n_outliers"], row["pct_outliers"]) == (2, 20.0)
    assert profile.outlier_summary(values(spark, "x", [5] * 4)).first()["n_outliers"] == 0
    assert rows(profile.outlier_summary(values(spark, "x", [None]))) == [("x", 0, 0.0, None, None)]


def test_rankings(spark):
    skew = spark.createDataFrame([("a", 0.5), ("b", -3.0), ("c", None)], "column_name string, skewness double")
    assert [r["column_name"] for r in profile.skew_ranking(skew).orderBy("place").collect()] == ["b", "a", "c"]


def test_histogram_keeps_the_maximum_in_the_last_bin(spark):
    out = charts.histogram(values(spark, "x", [0, 1, 2, 3, 4, None]), ["x"], bins=4).orderBy("bin").collect()
    assert [r["n"] for r in out] == [1, 1, 1, 2]
    assert sum(r["density"] * (r["right_edge"] - r["left_edge"]) for r in out) == pytest.approx(1.0)
    one = charts.histogram(values(spark, "x", [3, 3]), ["x"], bins=4).collect()
    assert sum(r["n"] for r in one) == 2


def test_density_of_cells_is_close_to_the_exact_one(spark):
    df = spark.range(4000).select((F.log(F.lit(1.0) + F.pmod(F.xxhash64("id"), F.lit(1000))) * 10 + F.col("id") / 4000).alias("x"))
    xs = [r["x"] for r in df.collect()]
    width = statistics.stdev(xs) * len(xs) ** -0.2
    cells = charts.density_curve(df, ["x"]).collect()
    exact = {r["point"]: sum(math.exp(-0.5 * ((r["x"] - x) / width) ** 2) for x in xs) / (len(xs) * width * math.sqrt(2 * math.pi)) for r in cells}
    top = max(exact.values())
    assert len(cells) == 300 and all(abs(exact[r["point"]] - r["density"]) < 1e-4 * top for r in cells)


def test_box_and_trend(spark):
    df = spark.createDataFrame([(0, float(x)) for x in [1, 2, 3, 4, 100]] + [(1, 5.0)], "y int, x double")
    zero = charts.box_by_class(df, "x", "y").where("label = '0'").first()
    assert (zero["q1"], zero["median"], zero["q3"], zero["high_whisker"], zero["n_outside"]) == (2.0, 3.0, 4.0, 4.0, 1)
    line = spark.createDataFrame([(float(x), 3.0 * x + 1) for x in range(10)], "x double, y double")
    points = charts.trend_line(line, "x", "y").orderBy("point").collect()
    assert len(points) == 100 and points[-1]["y"] == pytest.approx(28.0)
    assert charts.trend_line(line.limit(1), "x", "y").count() == 0


@pytest.mark.parametrize("limit", [10**6, 1])
def test_nan_and_infinity_are_missing(spark, limit):
    xs = [float(i) for i in range(40)] + [float("nan")] * 10 + [float("inf"), float("-inf")]
    df = values(spark, "`a.b`", xs)
    told = profile.describe(df, direct_limit=limit).first()
    assert (told["n"], told["mean"], told["max"], told["q50"]) == (40, 19.5, 39.0, 19.5)
    assert profile.outlier_summary(df, direct_limit=limit).first()["n_outliers"] == 0
    assert abs(profile.skewness(df).first()["skewness"]) < 1e-12
    two = df.withColumn("c", F.col("`a.b`") * 2 + 1)
    assert profile.correlation_pairs(two).first()["r"] == pytest.approx(1)


def test_quantile_scans_make_one_candidate_a_column(spark, monkeypatch):
    """However many ranges a column has, a row gives one candidate for each column."""
    from flatspan.functions import quantiles

    df = spark.range(5000).selectExpr("pmod(id * 7919, 5000) AS a", "CAST(id AS DOUBLE) / 3 AS b", "IF(id % 2 = 0, NULL, id) AS c")
    seen = []
    monkeypatch.setattr(quantiles, "BINS", 16)
    inside = quantiles._inside
    monkeypatch.setattr(quantiles, "_inside", lambda d, spans: seen.append((spans, inside(d, spans))) or seen[-1][1])
    got = quantiles.exact_quantiles(df, ["a", "b", "c"], [0.25, 0.5, 0.75], direct_limit=50)
    assert got["a"] == [1249.75, 2499.5, 3749.25] and got["c"] == [1250.5, 2500.0, 3749.5]
    assert [round(v * 3, 6) for v in got["b"]] == [1249.75, 2499.5, 3749.25]
    assert max(len(spans) for spans, _ in seen) > 3
    for spans, frame in seen:
        assert frame.count() == sum(df.where(f"{c} BETWEEN {low!r} AND {high!r}").count() for c, low, high, _ in spans)
