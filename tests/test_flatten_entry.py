from datetime import datetime

from pyspark.sql import functions as F

import __spark_entry__ as entry
from flatspan.operators import flatten
from flatspan.session import shared_folder, write_stage
from tests.conftest import rows


def test_summary_by_key(spark):
    df = spark.createDataFrame(
        [("o1", 1, "s1", 2.0, "b"), ("o1", 2, "s2", 3.0, "a"), ("o1", 3, "s1", None, None), ("o2", 1, None, 1.0, None)],
        "o string, line int, seller string, price double, kind string",
    )
    out = flatten.summarise_by_key(
        df, "o", {"n": ("count", "line"), "total": ("sum", "price"), "mean": ("avg", "price"), "top": ("max", "line")},
        {"sellers": "seller"}, {"kind": ("kind", "unknown"), "bare": ("kind", None), "seller": ("seller", None)},
    )
    assert rows(out, "o", "n", "total", "mean", "top", "sellers", "kind", "bare", "seller") == [
        ("o1", 3, 5.0, 2.5, 3, 2, "a", "a", "s1"), ("o2", 1, 1.0, 1.0, 1, 0, "unknown", None, None),
    ]


def test_summary_of_a_hot_key(spark):
    df = spark.range(9000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS line", "string(id % 1000) AS v")
    out = flatten.summarise_by_key(df, "k", {"n": ("count", "line")}, {"d": "v"}, {"m": ("v", None)}).where("k = 0").first()
    assert (out["n"], out["d"], out["m"]) == (3000, 1000, "0")


def test_summary_shuffles_rows_once_and_spreads_hot_keys_only(spark, monkeypatch):
    """Rows are placed by key once and folded there; only keys above the limit go another way, with the same results."""
    monkeypatch.setattr(flatten, "TASK_ROWS", 500)
    df = spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 WHEN id % 7 = 0 THEN NULL ELSE id % 1000 END AS k", "id AS line", "string(id % 10) AS v", "CAST(id % 4 AS DOUBLE) AS x")
    asked = ["k", {"n": ("count", "line"), "s": ("sum", "x"), "a": ("avg", "x"), "top": ("max", "line")}, {"d": "v"}, {"m": ("v", "none")}]
    plain = rows(flatten._fold_by_key(df, *asked))
    for limit in (10, 600, 100_000):  # many hot keys, the null key and 0, none
        assert rows(flatten.summarise_by_key(df, *asked, hot_rows=limit)) == plain
    assert flatten.summarise_by_key(df, *asked)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_orders_are_shuffled_once_for_each_key(spark):
    from flatspan.plans import marts

    with_sort = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2500")  # the nations alone are broadcast
    try:
        plan = marts.flat_orders(spark, entry.SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_sort)
    nodes = [x for x in plan.splitlines() if "Exchange hashpartitioning(o_" in x]
    assert sum("(o_custkey" in x for x in nodes) == 1 and sum("(o_orderkey" in x for x in nodes) == 1


def test_latest_label_and_days(spark):
    t = lambda d, h=0: datetime(2024, 1, d, h)
    df = spark.createDataFrame([("a", t(1), 1), ("a", t(3), 2), ("b", t(2), 3), ("a", t(3), 4)], "k string, at timestamp_ntz, v int")
    assert rows(flatten.latest_per_key(df, "k", ["at", "v"], ["v"])) == [("a", 4), ("b", 3)]
    pair = spark.createDataFrame([(t(2, 1), t(1, 12)), (t(1, 12), t(2, 1)), (t(3), t(1)), (None, t(1))], "a timestamp_ntz, b timestamp_ntz")
    got = pair.select(flatten.whole_days(F.col("a"), F.col("b")), flatten.late_label(F.col("a"), F.col("b")))
    assert [tuple(r) for r in got.collect()] == [(0, 1), (-1, 0), (2, 1), (None, None)]
    text = spark.createDataFrame([("2024-01-01 10:00:00",), ("nonsense",), (None,)], "t string")
    assert [r[0] for r in text.select(flatten.parse_timestamp(F.col("t"))).collect()] == [t(1, 10), None, None]


def test_drop_present(spark):
    assert flatten.drop_present(spark.range(1).withColumn("x", F.lit(1)), ["x", "absent"]).columns == ["id"]


def test_entry_and_contract(spark):
    assert entry.entry(spark).count() > 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 100


def test_stage_goes_to_the_shared_folder(spark):
    df = spark.range(10).withColumn("x", F.rand(3))
    staged = write_stage(df, "t")
    assert all(f.startswith(f"file://{shared_folder(spark)}") or shared_folder(spark) in f for f in staged.inputFiles())
    assert staged.count() == 10


def test_small_dimensions_do_not_shuffle_the_lines(spark):
    from flatspan.plans import marts

    for frame in (marts.items_agg(spark, entry.SMALL), entry.queries()["flatten_dimension_lookups"](spark, entry.SMALL)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "l_suppkey" not in "".join(x for x in plan.splitlines() if "hashpartitioning(l_suppkey" in x)
        assert "SortMergeJoin" not in plan
