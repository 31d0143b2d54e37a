"""The frames most queries start from, in Spark and as SQL text for the check.

``order_mart`` is the flat table: one row per order with customer, item, payment and latest-event
columns.  ``dirty_orders`` adds missing values, placeholders and numeric text by rules on the key,
as the given tables are clean.  ``scored_orders`` adds a score by a rule on the key, so that the
evaluation operators can be checked without a model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatspan.functions.seeded import hash_unit
from flatspan.operators import flatten
from flatspan.plans.base import kept, table

ESTIMATE_DAYS = 1800
LEAKY = ["o_orderstatus", "delivered_at", "latest_event_value", "latest_event_type"]


def items_agg(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_tax", "l_shipdate"
    )
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("seller_region"))
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    # One small table after the other: joined beforehand their estimate is too large to broadcast, and the lines are shuffled.
    full = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    full = full.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    full = full.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    full = full.withColumn("freight", F.col("l_extendedprice") * F.col("l_tax"))
    return flatten.aggregate_items(
        full,
        key="l_orderkey",
        line="l_linenumber",
        seller="l_suppkey",
        product="l_partkey",
        price="l_extendedprice",
        freight="freight",
        weight="p_size",
        photos="p_retailprice",
        seller_region="seller_region",
        category="p_type",
        delivered="l_shipdate",
        lines=lines,
    )


def payments_agg(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn(
        "k", F.get_json_object("props", "$.k").try_cast("long")
    )
    return flatten.aggregate_payments(events, "user_id", "value", "k", "event_type")


def latest_event(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.latest_per_key(
        table(spark, sf, "events"), "user_id", ["ts", "event_id"], ["ts", "event_id", "event_type", "value"]
    )


def flat_orders(spark: SparkSession, sf: str) -> DataFrame:
    """All orders, delivered or not."""
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("customer_nation"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    orders = table(spark, sf, "orders")
    out = flatten.left_lookup(orders, customer, "o_custkey", "c_custkey")
    out = flatten.left_lookup(out, nation, "c_nationkey", "n_nationkey").drop("c_nationkey")
    items = items_agg(spark, sf)
    payments = payments_agg(spark, sf).withColumnRenamed("user_id", "pay_user")
    order = [*out.columns, *[c for c in [*items.columns, *payments.columns] if c not in ("l_orderkey", "pay_user")]]
    # All lookups by customer come before the one by order, so the orders are shuffled once for each key.
    out = flatten.left_lookup(out, payments, "o_custkey", "pay_user")
    last = latest_event(spark, sf).select(
        F.col("user_id").alias("last_user"),
        F.col("event_type").alias("latest_event_type"),
        F.col("value").alias("latest_event_value"),
    )
    out = flatten.left_lookup(out, last, "o_custkey", "last_user")
    out = flatten.left_lookup(out, items, "o_orderkey", "l_orderkey").select(*order, "latest_event_type", "latest_event_value")
    out = out.withColumn("estimated_at", F.expr(f"o_orderdate + INTERVAL {ESTIMATE_DAYS} DAYS"))
    return out.withColumn(
        "purchase_to_delivered_days", flatten.whole_days(F.col("delivered_at"), F.col("o_orderdate"))
    ).withColumn("is_late", flatten.late_label(F.col("delivered_at"), F.col("estimated_at")))


def all_orders(spark: SparkSession, sf: str) -> DataFrame:
    return kept(spark, sf, "flat_orders", flat_orders)


def order_mart(spark: SparkSession, sf: str) -> DataFrame:
    """Delivered orders without the columns only known afterwards."""
    delivered, _ = flatten.split_delivered(all_orders(spark, sf))
    return flatten.drop_present(delivered, [*LEAKY, "purchase_to_delivered_days", "estimated_at"])


ITEMS_CTE = """
items_full AS (
  SELECT l.*, l.l_extendedprice * l.l_tax AS freight, p.p_type, p.p_size, p.p_retailprice, n.n_name AS seller_region
  FROM lineitem l
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey),
region_mode AS (
  SELECT l_orderkey, seller_region FROM (
    SELECT l_orderkey, seller_region, row_number() OVER (PARTITION BY l_orderkey ORDER BY count(*) DESC, seller_region) AS rn
    FROM items_full WHERE seller_region IS NOT NULL GROUP BY l_orderkey, seller_region) WHERE rn = 1),
category_mode AS (
  SELECT l_orderkey, p_type FROM (
    SELECT l_orderkey, p_type, row_number() OVER (PARTITION BY l_orderkey ORDER BY count(*) DESC, p_type) AS rn
    FROM items_full WHERE p_type IS NOT NULL GROUP BY l_orderkey, p_type) WHERE rn = 1),
items_sums AS (
  SELECT l_orderkey, count(l_linenumber) AS n_items, count(DISTINCT l_suppkey) AS n_distinct_sellers,
    count(DISTINCT l_partkey) AS n_distinct_products, sum(l_extendedprice) AS total_price, sum(freight) AS total_freight,
    avg(p_size) AS avg_product_weight, avg(p_retailprice) AS avg_product_photos, max(l_shipdate) AS delivered_at
  FROM items_full GROUP BY l_orderkey),
items_agg AS (
  SELECT i.l_orderkey, n_items, n_distinct_sellers, n_distinct_products, total_price, total_freight, avg_product_weight,
    avg_product_photos, r.seller_region AS primary_seller_region, coalesce(c.p_type, 'unknown') AS product_category, delivered_at
  FROM items_sums i LEFT JOIN region_mode r USING (l_orderkey) LEFT JOIN category_mode c USING (l_orderkey))"""

PAYMENTS_CTE = """
pay_events AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
pay_mode AS (
  SELECT user_id, event_type FROM (
    SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn
    FROM events WHERE event_type IS NOT NULL GROUP BY user_id, event_type) WHERE rn = 1),
payments_agg AS (
  SELECT e.user_id, sum(value) AS total_payment_value, max(k) AS max_installments,
    count(DISTINCT e.event_type) AS n_payment_methods, any_value(m.event_type) AS primary_payment_type
  FROM pay_events e LEFT JOIN pay_mode m USING (user_id) GROUP BY e.user_id)"""

LATEST_CTE = """
latest_event AS (
  SELECT user_id, ts, event_id, event_type, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1)"""

FLAT_CTE = f"""{ITEMS_CTE},{PAYMENTS_CTE},{LATEST_CTE},
flat_orders AS (
  SELECT o.*, c.c_acctbal, c.c_mktsegment, n.n_name AS customer_nation,
    i.n_items, i.n_distinct_sellers, i.n_distinct_products, i.total_price, i.total_freight, i.avg_product_weight,
    i.avg_product_photos, i.primary_seller_region, i.product_category, i.delivered_at,
    p.total_payment_value, p.max_installments, p.n_payment_methods, p.primary_payment_type,
    e.event_type AS latest_event_type, e.value AS latest_event_value,
    o.o_orderdate + INTERVAL {ESTIMATE_DAYS} DAY AS estimated_at,
    CAST(floor(epoch(i.delivered_at - o.o_orderdate) / 86400) AS BIGINT) AS purchase_to_delivered_days,
    CASE WHEN i.delivered_at IS NOT NULL THEN CAST(i.delivered_at > o.o_orderdate + INTERVAL {ESTIMATE_DAYS} DAY AS INTEGER) END AS is_late
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN items_agg i ON o.o_orderkey = i.l_orderkey
  LEFT JOIN payments_agg p ON o.o_custkey = p.user_id
  LEFT JOIN latest_event e ON o.o_custkey = e.user_id),
order_mart AS (
  SELECT * EXCLUDE (o_orderstatus, delivered_at, latest_event_value, latest_event_type, purchase_to_delivered_days, estimated_at)
  FROM flat_orders WHERE delivered_at IS NOT NULL)"""


# --- dirty orders -----------------------------------------------------------------------------

_DIRTY = {
    "status": "CASE WHEN o_orderkey % 11 = 0 THEN ' UNKNOWN ' WHEN o_orderkey % 13 = 0 THEN 'n/a' "
    "WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END",
    "priority": "CASE WHEN o_orderkey % 3 = 0 THEN '--' WHEN o_orderkey % 3 = 1 THEN NULL ELSE o_orderpriority END",
    "price": "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_totalprice END",
    "amount_text": "CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE CAST(CAST(round(o_totalprice) AS BIGINT) AS {text}) END",
    "channel": "CASE WHEN o_orderkey % 1000 = 0 THEN 'store' ELSE 'web' END",
    "empty_number": "CAST(NULL AS DOUBLE)",
}


def dirty_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    made = orders.selectExpr("o_orderkey", "o_custkey", *[f"{e.format(text='STRING')} AS {c}" for c, e in _DIRTY.items()])
    # Every seventh order occurs twice.
    copies = F.when(F.col("o_orderkey") % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return made.withColumn("copy", F.explode(copies)).drop("copy")


DIRTY_CTE = f"""
dirty AS (
  SELECT o_orderkey, o_custkey, {', '.join(f"{e.format(text='VARCHAR')} AS {c}" for c, e in _DIRTY.items())}
  FROM orders CROSS JOIN (VALUES (1), (2)) v(copy) WHERE copy = 1 OR o_orderkey % 7 = 0)"""


# --- scored orders ----------------------------------------------------------------------------


def scored_orders(spark: SparkSession, sf: str) -> DataFrame:
    """label and predicted for a binary, a three-way and a numeric target, by rules on the key."""
    mart = order_mart(spark, sf)
    u = hash_unit(F.concat(F.lit("s:"), F.col("o_orderkey")))
    scored = mart.withColumn("u", u).withColumn("score", F.round(F.col("u") * 0.6 + F.col("is_late") * 0.4, 4))
    size = F.when(F.col("n_items") <= 2, "small").when(F.col("n_items") <= 5, "medium").otherwise("large")
    return scored.select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        "c_mktsegment",
        "customer_nation",
        "primary_seller_region",
        "product_category",
        "n_items",
        "u",
        "score",
        F.col("is_late").alias("actual"),
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.round(F.when(F.col("score") >= 0.5, F.col("score")).otherwise(1 - F.col("score")), 6).alias("confidence"),
        size.alias("size_actual"),
        F.when(F.col("u") < 0.7, size).when(F.col("u") < 0.9, "medium").otherwise("small").alias("size_predicted"),
        F.round("total_price", 2).alias("price_actual"),
        F.round(F.col("total_price") * (F.col("u") * 0.4 + 0.85), 2).alias("price_predicted"),
    )


SCORED_CTE = f"""{FLAT_CTE},
scored0 AS (
  SELECT *, CAST(('0x' || substr(md5('s:' || o_orderkey), 1, 8)) AS BIGINT) / 4294967296.0 AS u FROM order_mart),
scored1 AS (
  SELECT *, round(u * 0.6 + is_late * 0.4, 4) AS score,
    CASE WHEN n_items <= 2 THEN 'small' WHEN n_items <= 5 THEN 'medium' ELSE 'large' END AS size_actual FROM scored0),
scored AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, c_mktsegment, customer_nation, primary_seller_region, product_category,
    n_items, u, score, is_late AS actual, CAST(score >= 0.5 AS INTEGER) AS predicted,
    round(CASE WHEN score >= 0.5 THEN score ELSE 1 - score END, 6) AS confidence, size_actual,
    CASE WHEN u < 0.7 THEN size_actual WHEN u < 0.9 THEN 'medium' ELSE 'small' END AS size_predicted,
    round(total_price, 2) AS price_actual, round(total_price * (u * 0.4 + 0.85), 2) AS price_predicted
  FROM scored1)"""
