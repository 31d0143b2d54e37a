"""Queries of the relational flatten job."""

from __future__ import annotations

from pyspark.sql import functions as F

from flatspan.operators import flatten
from flatspan.plans import marts
from flatspan.plans.base import query, table
from flatspan.plans.marts import FLAT_CTE, ITEMS_CTE, LATEST_CTE, PAYMENTS_CTE

_MONEY = ["total_price", "total_freight", "avg_product_weight", "avg_product_photos", "total_payment_value"]


def rounded(df, columns=_MONEY):
    return df.withColumns({c: F.round(c, 4) for c in columns if c in df.columns})


def sql_rounded(columns=_MONEY):
    return "REPLACE (" + ", ".join(f"round({c}, 4) AS {c}" for c in columns) + ")"


@query("flatten_items_agg", f"WITH {ITEMS_CTE} SELECT * {sql_rounded(_MONEY[:4])} FROM items_agg")
def _(spark, sf):
    return rounded(marts.items_agg(spark, sf))


@query("flatten_payments_agg", f"WITH {PAYMENTS_CTE} SELECT * {sql_rounded(_MONEY[4:])} FROM payments_agg")
def _(spark, sf):
    return rounded(marts.payments_agg(spark, sf))


@query("flatten_latest_event", f"WITH {LATEST_CTE} SELECT * FROM latest_event")
def _(spark, sf):
    return marts.latest_event(spark, sf)


@query(
    "flatten_dimension_lookups",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand, p_type, s_name, n_name, r_name
       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    region = table(spark, sf, "region")
    nation = table(spark, sf, "nation")
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    out = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    out = out.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    out = out.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    out = out.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "p_brand", "p_type", "s_name", "n_name", "r_name"
    )


@query("flatten_order_mart", f"WITH {FLAT_CTE} SELECT * {sql_rounded()} FROM order_mart")
def _(spark, sf):
    return rounded(marts.order_mart(spark, sf))


@query("flatten_undelivered", f"WITH {FLAT_CTE} SELECT * {sql_rounded()} FROM flat_orders WHERE delivered_at IS NULL")
def _(spark, sf):
    return rounded(flatten.split_delivered(marts.all_orders(spark, sf))[1])


@query(
    "flatten_review_projection",
    f"""WITH {FLAT_CTE} SELECT o_orderkey, latest_event_value, is_late, product_category, round(total_price, 4) AS total_price,
        round(total_freight, 4) AS total_freight, purchase_to_delivered_days FROM flat_orders WHERE delivered_at IS NOT NULL""",
)
def _(spark, sf):
    delivered, _ = flatten.split_delivered(marts.all_orders(spark, sf))
    return rounded(
        delivered.select(
            "o_orderkey", "latest_event_value", "is_late", "product_category", "total_price", "total_freight",
            "purchase_to_delivered_days",
        )
    )


@query("label_rate", f"WITH {FLAT_CTE} SELECT count(*) AS n_rows, round(avg(is_late), 6) AS rate FROM order_mart")
def _(spark, sf):
    return flatten.rate_summary(marts.order_mart(spark, sf), "is_late").withColumn("rate", F.round("rate", 6))


@query(
    "whole_days_floor",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(floor(epoch((l_shipdate + INTERVAL 12 HOUR) - o_orderdate) / 86400) AS BIGINT) AS days_after,
         CAST(floor(epoch(o_orderdate - (l_shipdate + INTERVAL 12 HOUR)) / 86400) AS BIGINT) AS days_before
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    noon = F.expr("l_shipdate + INTERVAL 12 HOURS")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        flatten.whole_days(noon, F.col("o_orderdate")).alias("days_after"),
        flatten.whole_days(F.col("o_orderdate"), noon).alias("days_before"),
    )


@query(
    "tolerant_timestamps",
    """SELECT event_id, TRY_CAST(CASE WHEN event_id % 5 = 0 THEN 'not a date' WHEN event_id % 7 = 0 THEN ''
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS parsed FROM events""",
)
def _(spark, sf):
    text = (
        F.when(F.col("event_id") % 5 == 0, "not a date")
        .when(F.col("event_id") % 7 == 0, "")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    return table(spark, sf, "events").select("event_id", flatten.parse_timestamp(text).alias("parsed"))
