"""Exact quantiles and order statistics that need no task to hold a whole column.

``percentile`` keeps every distinct value of a column in one buffer.  That is right for small
columns and impossible for large ones, so the work is split by row count:

* up to ``direct_limit`` rows: ``percentile`` in one aggregate;
* above: a histogram over the column's range finds the bin of each wanted rank, and the bin's own
  smallest and largest value become the next range.  A bin holds few rows, or one value, after one
  or two rounds; each round is one scan with counts combined before the shuffle, for all columns at
  once.  The rows of the last bins are then grouped by value and ranked.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flatspan.functions.schema import as_double

DIRECT_LIMIT = 20_000
OPEN_LIMIT = 100_000
BINS = 4096


@dataclass(frozen=True)
class _Bracket:
    """``rows`` rows of ``column`` lie in [low, high], ``below`` rows under it; ``rank`` is inside."""

    column: str
    rank: int
    low: float
    high: float
    below: int
    rows: int


def count_and_range(df: DataFrame, columns: list[str]) -> dict[str, tuple[int, float, float]]:
    """Non-null rows, minimum and maximum per column, in one aggregate."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [
            F.count(as_double(c)).alias(f"n{i}"),
            F.min(as_double(c)).alias(f"lo{i}"),
            F.max(as_double(c)).alias(f"hi{i}"),
        ]
    row = df.agg(*aggs).first()
    return {c: (row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(columns)}


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    direct_limit: int = DIRECT_LIMIT,
    known: dict[str, tuple[int, float, float]] | None = None,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column, nulls left out; all None for an empty column."""
    if not columns:
        return {}
    known = known or count_and_range(df, columns)
    out: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    small = [c for c in columns if 0 < known[c][0] <= direct_limit]
    if small:
        probs = F.array(*[F.lit(float(p)) for p in probabilities])
        row = df.agg(*[F.percentile(as_double(c), probs).alias(f"q{i}") for i, c in enumerate(small)]).first()
        for i, c in enumerate(small):
            out[c] = [float(v) for v in row[f"q{i}"]]
    large = [c for c in columns if known[c][0] > direct_limit]
    if large:
        ranks = {}
        for c in large:
            spots = [(known[c][0] - 1) * p for p in probabilities]
            ranks[c] = sorted({f(s) for s in spots for f in (math.floor, math.ceil)})
        values = order_statistics(df, ranks, OPEN_LIMIT if direct_limit >= DIRECT_LIMIT else direct_limit, known)
        for c in large:
            for j, p in enumerate(probabilities):
                spot = (known[c][0] - 1) * p
                low, high = math.floor(spot), math.ceil(spot)
                a, b = values[c, low], values[c, high]
                out[c][j] = a if low == high else a + (b - a) * (spot - low)
    return out


def order_statistics(
    df: DataFrame,
    ranks: dict[str, list[int]],
    open_limit: int = OPEN_LIMIT,
    known: dict[str, tuple[int, float, float]] | None = None,
) -> dict[tuple[str, int], float]:
    """The value at each zero-based rank of each column, exactly."""
    known = known or count_and_range(df, list(ranks))
    brackets = [
        _Bracket(c, r, known[c][1], known[c][2], 0, known[c][0]) for c, wanted in ranks.items() for r in wanted
    ]
    found: dict[tuple[str, int], float] = {}
    small: list[_Bracket] = []
    while brackets:
        found |= {(b.column, b.rank): b.low for b in brackets if b.low == b.high}
        brackets = [b for b in brackets if b.low < b.high]
        small += [b for b in brackets if b.rows <= open_limit]
        brackets = [b for b in brackets if b.rows > open_limit]
        if brackets:
            brackets = _shrink(df, brackets)
    return found | _pick(df, small)


def _shrink(df: DataFrame, brackets: list[_Bracket]) -> list[_Bracket]:
    """One histogram per distinct range; the smallest and the largest value always fall in
    different bins, so every round makes progress."""
    spans = list(dict.fromkeys((b.column, b.low, b.high, b.below) for b in brackets))
    wanted = []
    for i, span in enumerate(spans):
        inner = [b.rank - b.below for b in brackets if (b.column, b.low, b.high, b.below) == span]
        wanted += [F.lit(i), F.array(*[F.lit(r).cast("long") for r in inner])]
    scales = [1.0 if math.isfinite(high - low) else 0.5 for _, low, high, _ in spans]
    of = lambda numbers: F.get(F.array(*[F.lit(v) for v in numbers]), F.col("s"))
    starts = [low * scale for (_, low, _, _), scale in zip(spans, scales, strict=True)]
    widths = [high * scale - start for (_, _, high, _), scale, start in zip(spans, scales, starts, strict=True)]
    share = (F.col("x") * of(scales) - of(starts)) / of(widths)
    counted = (
        _inside(df, spans)
        .select("s", F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int").alias("bin"), "x")
        .groupBy("s", "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    )
    running = Window.partitionBy("s").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = (
        counted.withColumn("upto", F.sum("n").over(running))
        .withColumn("rank", F.explode(F.create_map(*wanted)[F.col("s")]))
        .where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        .collect()  # one row per bracket
    )
    out = []
    for r in hits:
        column, _, _, below = spans[r["s"]]
        out.append(_Bracket(column, r["rank"] + below, r["low"], r["high"], below + r["upto"] - r["n"], r["n"]))
    return out


def _inside(df: DataFrame, spans: list[tuple[str, float, float, int]]) -> DataFrame:
    """Rows (s, x): the values that lie in a span, with the span's number.  Ranges of a column do not overlap, so a value
    goes to one span, and a row gives one candidate a column whatever the number of spans."""
    columns = list(dict.fromkeys(column for column, *_ in spans))
    cells = [F.struct(F.lit(j).alias("c"), as_double(c).alias("x")) for j, c in enumerate(columns)]
    number = F
    for j, name in enumerate(columns):
        own = F
        for i, (column, low, high, _) in enumerate(spans):
            if column == name:
                own = own.when((F.col("x") >= F.lit(low)) & (F.col("x") <= F.lit(high)), F.lit(i))
        number = number.when(F.col("c") == j, own)
    return df.select(F.inline(F.array(*cells))).select(number.alias("s"), "x").where("s IS NOT NULL")


def _pick(df: DataFrame, brackets: list[_Bracket]) -> dict[tuple[str, int], float]:
    if not brackets:
        return {}
    spans = list(dict.fromkeys((b.column, b.low, b.high, b.below) for b in brackets))
    wanted = []
    for i, span in enumerate(spans):
        inner = sorted({x.rank - x.below for x in brackets if (x.column, x.low, x.high, x.below) == span})
        wanted += [F.lit(i), F.array(*[F.lit(r).cast("long") for r in inner])]
    counted = _inside(df, spans).groupBy("s", F.col("x").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("s").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = (
        counted.withColumn("upto", F.sum("n").over(running))
        .withColumn("rank", F.explode(F.create_map(*wanted)[F.col("s")]))
        .where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        .select("s", "v", "rank")
        .collect()  # one row per wanted rank
    )
    return {(spans[r["s"]][0], r["rank"] + spans[r["s"]][3]): r["v"] for r in hits}
