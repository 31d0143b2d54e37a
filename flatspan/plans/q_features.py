"""Queries of the feature step, over the flat order table."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from flatspan.operators import features
from flatspan.plans import marts
from flatspan.plans.base import query, table
from flatspan.plans.marts import FLAT_CTE

PROTECTED = ["o_orderkey", "o_custkey", "is_late"]
NUMERIC = [
    "o_totalprice", "c_acctbal", "n_items", "n_distinct_sellers", "n_distinct_products", "total_price", "total_freight",
    "avg_product_weight",
]
KEPT = [c for c in NUMERIC if c not in ("n_distinct_sellers", "n_distinct_products")]
SKEW = 0.8
CATEGORICAL = ["product_category", "primary_payment_type", "customer_nation"]
INPUT = [*PROTECTED, *NUMERIC, *CATEGORICAL]
PRIORITIES = {"1-URGENT": "1-URGENT", "2-HIGH": "2-HIGH", "3-MEDIUM": "3-MEDIUM", "4-NOT SPECIFIED": "4-NOT_SPECIFIED", "5-LOW": "5-LOW"}

INPUT_CTE = f"{FLAT_CTE}, fe AS (SELECT {', '.join(INPUT)} FROM order_mart)"


def feature_input(spark, sf):
    return marts.order_mart(spark, sf).select(*INPUT)


def _strong(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS ia, {j} AS ib, '{a}' AS a, '{b}' AS b, abs(corr({a}, {b})) > 0.95 AS strong FROM {source}"
        for (i, a), (j, b) in itertools.combinations(enumerate(NUMERIC), 2)
    )


@query(
    "redundant_cols",
    f"""WITH {INPUT_CTE}, pairs AS (SELECT * FROM ({_strong('fe')}) WHERE strong),
        roots AS (SELECT DISTINCT a FROM pairs WHERE a NOT IN (SELECT b FROM pairs))
        SELECT DISTINCT b AS column_name FROM pairs WHERE a IN (SELECT a FROM roots)""",
)
def _(spark, sf):
    df = feature_input(spark, sf)
    dropped = features.redundant_columns(df, protected=PROTECTED)
    return spark.createDataFrame([(c,) for c in dropped], "column_name string")


@query(
    "log1p_columns",
    """SELECT event_id, CASE WHEN (SELECT abs(skewness(value)) > 1.0 AND min(value) >= 0 FROM events)
         THEN round(ln(1 + value), 6) ELSE round(value, 6) END AS value FROM events""",
)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value")
    out = features.apply_log1p(df, features.skewed_columns(df, protected=["event_id"]))
    return out.withColumn("value", F.round("value", 6))


_STD = ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS {c}" for c in NUMERIC)


@query("standard_scale", f"WITH {INPUT_CTE} SELECT o_orderkey, o_custkey, is_late, {_STD} FROM fe")
def _(spark, sf):
    df = feature_input(spark, sf).drop(*CATEGORICAL)
    out = features.apply_scale(df, features.fit_scale(df, PROTECTED))
    return out.withColumns({c: F.round(c, 6) for c in NUMERIC})


@query(
    "scale_fit_apply",
    """WITH fit AS (SELECT avg(p_retailprice) AS m, stddev_samp(p_retailprice) AS s FROM part WHERE p_partkey % 2 = 0)
       SELECT p_partkey, round((p_retailprice - m) / s, 6) AS p_retailprice, 1 AS constant FROM part, fit WHERE p_partkey % 2 = 1""",
)
def _(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_retailprice", F.lit(1).alias("constant"))
    scale = features.fit_scale(df.where("p_partkey % 2 = 0"), ["p_partkey"])
    out = features.apply_scale(df.where("p_partkey % 2 = 1"), scale)
    return out.withColumn("p_retailprice", F.round("p_retailprice", 6))


_ONE_HOT = ", ".join(
    f"""CAST(o_orderpriority = '{v}' AS INTEGER) AS "o_orderpriority_{n}\"""" for v, n in PRIORITIES.items()
)


@query("one_hot", f"SELECT o_orderkey, {_ONE_HOT} FROM orders")
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return features.apply_one_hot(df, features.fit_encoding(df, protected=["o_orderkey"]).one_hot)


_UNSEEN = ", ".join(
    f"""CAST(o_orderpriority = '{v}' AS INTEGER) AS "o_orderpriority_{n}\"""" for v, n in list(PRIORITIES.items())[:3]
)


@query("one_hot_unseen", f"SELECT o_orderkey, {_UNSEEN} FROM orders WHERE o_orderpriority >= '3'")
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    encoding = features.fit_encoding(df.where("o_orderpriority < '4'"), protected=["o_orderkey"])
    return features.apply_one_hot(df.where("o_orderpriority >= '3'"), encoding.one_hot)


@query(
    "frequency_encode",
    """SELECT c_custkey, round(n / (SELECT count(*) FROM customer), 6) AS nation FROM customer
       JOIN nation ON c_nationkey = n_nationkey JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) f ON k = c_nationkey""",
)
def _(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    df = table(spark, sf, "customer").join(nation, "c_nationkey").select("c_custkey", "nation")
    out = features.apply_encoding(df, features.fit_encoding(df, protected=["c_custkey"]))
    return out.withColumn("nation", F.round("nation", 6))


@query(
    "frequency_encode_many_values",
    """SELECT doc_id, round(n / (SELECT count(*) FROM documents), 6) AS text FROM documents
       JOIN (SELECT text AS t, count(*) AS n FROM documents GROUP BY 1) ON t = text""",
)
def _(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "text")
    out = features.apply_frequency(df, "text", features.frequency_table(df, "text"))
    return out.withColumn("text", F.round("text", 6))


@query(
    "frequency_decode",
    """WITH f AS (SELECT n_name AS value, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
       d AS (SELECT n, count(*) AS n_values, min(value) AS first_value, sum(n)::BIGINT AS n_rows FROM f GROUP BY n)
       SELECT round(n / (SELECT count(*) FROM customer), 9) AS frequency, n_rows, n_values, first_value FROM d""",
)
def _(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    df = table(spark, sf, "customer").join(nation, "c_nationkey").select("c_custkey", "nation")
    freq = features.frequency_table(df, "nation")
    out = features.decode_frequency(features.apply_frequency(df, "nation", freq), "nation", freq)
    return out.withColumn("frequency", F.round("frequency", 9))


_REPORT = " UNION ALL ".join(
    [
        *[f"SELECT 'redundant_dropped' AS step, '{c}' AS column_name, NULL::DOUBLE AS mean, NULL::DOUBLE AS std" for c in NUMERIC if c not in KEPT],
        "SELECT 'log1p', 'total_freight', NULL, NULL",
        *[f"SELECT 'scaled', '{c}', round(avg({x}), 6), round(stddev_samp({x}), 6) FROM fe" for c in KEPT for x in [f"ln(1 + {c})" if c == "total_freight" else c]],
        "SELECT 'one_hot', 'product_category', NULL, NULL",
        "SELECT 'one_hot', 'primary_payment_type', NULL, NULL",
        "SELECT 'frequency', 'customer_nation', NULL, NULL",
    ]
)


@query("feature_report", f"WITH {INPUT_CTE} {_REPORT}")
def _(spark, sf):
    df = feature_input(spark, sf)
    report = features.feature_report(df, features.fit_features(df, skew_threshold=SKEW, protected=PROTECTED))
    return report.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_PAYS = ["__unknown__", "click", "error", "purchase", "signup", "view"]


def _scaled(c: str) -> str:
    x = f"ln(1 + {c})" if c == "total_freight" else c
    return f"round(({x} - avg({x}) OVER ()) / stddev_samp({x}) OVER (), 6) AS {c}"


def pipeline_sql() -> str:
    dummies = [f"""CAST(product_category = '{v}' AS INTEGER) AS "product_category_{v}\"""" for v in _TYPES]
    dummies += [f"""CAST(coalesce(primary_payment_type, '__unknown__') = '{v}' AS INTEGER) AS "primary_payment_type_{v}\"""" for v in _PAYS]
    return f"""WITH {INPUT_CTE} SELECT o_orderkey, o_custkey, is_late, {', '.join(_scaled(c) for c in KEPT)}, {', '.join(dummies)},
        round(count(*) OVER (PARTITION BY customer_nation) / count(*) OVER (), 6) AS customer_nation FROM fe"""


@query("feature_pipeline", pipeline_sql())
def _(spark, sf):
    df = feature_input(spark, sf)
    out = features.apply_features(df, features.fit_features(df, skew_threshold=SKEW, protected=PROTECTED))
    return out.withColumns({c: F.round(c, 6) for c in [*KEPT, "customer_nation"]})
