"""From relational tables to one flat analysis table.

The detail tables are aggregated to one row per order before they are joined, so no join fans out.
An order with very many lines is spread over its values, so it is no hot spot.  Joins are plain LEFT
equi-joins: Spark broadcasts a side only below ``spark.sql.autoBroadcastJoinThreshold`` and splits
skewed partitions at run time otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatspan.operators.clean import MODE_FALLBACK


def left_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """LEFT join of a dimension; the dimension's key is dropped when its name differs."""
    joined = fact.join(dim, fact[fact_key] == dim[dim_key], "left")
    return joined.drop(dim[dim_key])


#: Rows of a key from which it is hot: spread over its values instead of being one task's work.
HOT_ROWS = 100_000
#: Rows of a task that folds whole keys.
TASK_ROWS = 250_000


def summarise_by_key(
    df: DataFrame,
    key: str,
    measures: dict[str, tuple[str, str]],
    distinct: dict[str, str],
    modes: dict[str, tuple[str, str | None]],
    counted: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per key: measures (``count``, ``sum``, ``avg`` or ``max`` of a column), numbers of
    distinct values, and modes (most frequent text, ties to the smallest, a default when none).

    A scan counts the rows of each key, in ``counted`` where ``df`` is that frame with lookups joined.  Rows of all but
    the hot keys (at most one in ``hot_rows`` rows) are shuffled once, by key, and folded where they are.  A hot key is
    spread over its values first, and no buffer holds a set or a map.
    """
    sizes = (df if counted is None else counted).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = F.when(F.col("n") > hot_rows, F.struct(F.col(key).alias("key")))
    found = sizes.agg(F.sum("n").alias("n"), F.collect_list(hot).alias("hot")).first()
    tasks = -(-(found["n"] or 0) // TASK_ROWS)
    if tasks <= 1 and not found["hot"]:
        return _fold_by_key(df, key, measures, distinct, modes)  # one task's rows: nothing to place
    hot_keys = [r["key"] for r in found["hot"]]
    is_hot = F.coalesce(F.col(key).isin([k for k in hot_keys if k is not None]), F.lit(None in hot_keys))
    rest = (df.where(~is_hot) if hot_keys else df).repartition(max(tasks, 1), key)
    out = _fold_by_key(rest, key, measures, distinct, modes)
    return out.unionByName(_fold_by_key(df.where(is_hot), key, measures, distinct, modes)) if hot_keys else out


def _fold_by_key(
    df: DataFrame, key: str, measures: dict[str, tuple[str, str]], distinct: dict[str, str], modes: dict[str, tuple[str, str | None]]
) -> DataFrame:
    """``summarise_by_key`` for rows as they lie.

    Each input row becomes one row per attribute; the first of them also carries the measures.
    These are counted per (key, attribute, value) and then folded per key, both times combined
    before the shuffle, which rows placed by key do without.
    """
    slots = [*distinct.items(), *[(name, column) for name, (column, _) in modes.items()]]
    slot = F.col("_slot")
    value = F.lit(None).cast("string")
    for i, (_, column) in enumerate(slots):
        value = F.when(slot == i, F.col(column).cast("string")).otherwise(value)
    spread = df.withColumn("_slot", F.explode(F.array(*[F.lit(i) for i in range(max(len(slots), 1))])))
    pieces = {f"_{kind}_{name}": F.when(slot == 0, F.col(column)) for name, (kind, column) in measures.items()}
    wide = spread.select(key, "_slot", value.alias("_value"), *[c.alias(n) for n, c in pieces.items()])
    first, second = [F.count(F.lit(1)).alias("_n")], []
    for name, (kind, _) in measures.items():
        x = f"_{kind}_{name}"
        first.append({"count": F.count, "sum": F.sum, "avg": F.sum, "max": F.max}[kind](x).alias(x))
        if kind == "avg":
            first.append(F.count(x).alias(f"{x}_n"))
            second.append(F.try_divide(F.sum(x), F.sum(f"{x}_n")).alias(name))
        else:
            second.append((F.max(x) if kind == "max" else F.sum(x)).alias(name))
    present = F.col("_value").isNotNull()
    for i, (name, _) in enumerate(slots):
        here = present & (slot == i)
        if name in distinct:
            second.append(F.count_if(here).alias(name))
        else:
            best = F.min(F.when(here, F.struct((-F.col("_n")).alias("n"), F.col("_value").alias("v"))))["v"]
            default = modes[name][1]
            second.append((best if default is None else F.coalesce(best, F.lit(default))).alias(name))
    return wide.groupBy(key, "_slot", "_value").agg(*first).groupBy(key).agg(*second)


def aggregate_items(
    items: DataFrame,
    key: str,
    line: str,
    seller: str,
    product: str,
    price: str,
    freight: str,
    weight: str,
    photos: str,
    seller_region: str,
    category: str,
    delivered: str,
    lines: DataFrame | None = None,
) -> DataFrame:
    """One row per order from its item lines (already joined to product and seller); ``lines`` are they before these joins."""
    return summarise_by_key(
        items,
        key,
        {
            "n_items": ("count", line),
            "total_price": ("sum", price),
            "total_freight": ("sum", freight),
            "avg_product_weight": ("avg", weight),
            "avg_product_photos": ("avg", photos),
            "delivered_at": ("max", delivered),
        },
        {"n_distinct_sellers": seller, "n_distinct_products": product},
        {"primary_seller_region": (seller_region, None), "product_category": (category, MODE_FALLBACK)},
        lines,
    )


def aggregate_payments(payments: DataFrame, key: str, value: str, installments: str, kind: str) -> DataFrame:
    return summarise_by_key(
        payments,
        key,
        {"total_payment_value": ("sum", value), "max_installments": ("max", installments)},
        {"n_payment_methods": kind},
        {"primary_payment_type": (kind, None)},
    )


def latest_per_key(df: DataFrame, key: str, order_by: list[str], keep: list[str]) -> DataFrame:
    """The last row per key: a maximum of a struct, combined before the shuffle.  The order columns
    should settle every tie."""
    latest = F.max(F.struct(*order_by, *[c for c in keep if c not in order_by])).alias("_last")
    return df.groupBy(key).agg(latest).select(key, *[F.col(f"_last.{c}").alias(c) for c in keep])


def parse_timestamp(value: Column) -> Column:
    """Text to timestamp, null where it does not parse."""
    return value.try_cast("timestamp_ntz")


def whole_days(later: Column, earlier: Column) -> Column:
    """Elapsed 24-hour periods, rounded down (also below zero); not calendar days."""
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    return F.floor(micros / F.lit(86_400_000_000)).cast("long")


def late_label(delivered: Column, estimated: Column) -> Column:
    """1 when delivered after the estimate, 0 when not, null when not delivered."""
    return F.when(delivered.isNotNull(), (delivered > estimated).cast("int"))


def drop_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def split_delivered(df: DataFrame, delivered: str = "delivered_at") -> tuple[DataFrame, DataFrame]:
    """(delivered rows, the rest): the rest is kept as an audit table, not dropped."""
    return df.where(F.col(delivered).isNotNull()), df.where(F.col(delivered).isNull())


def rate_summary(df: DataFrame, label: str) -> DataFrame:
    """n_rows and the label's mean."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(label).alias("rate"))
