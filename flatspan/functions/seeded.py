"""Seeded, repeatable randomness: every draw is the md5 of a seed and a row's own id.

A task that runs again draws the same values, and the draw needs no shuffle.  Exact shares ("20 %
of every class") are turned into one cut-off hash per class, so that assigning the rows is a plain
comparison: no rank over all rows of a class is ever computed in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatspan.session import write_stage

#: More groups than this cannot be classes of a target; their cut-offs are not collected.
MAX_GROUPS = 10_000


def seeded_hash(seed: int, *ids: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids]))


def hash_unit(text: Column) -> Column:
    """A number in [0, 1) from the first eight hex digits of the md5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_cutoffs(
    df: DataFrame,
    hash_col: str,
    ranks_of: Callable[[Column], list[Column]],
    by: str | None = None,
) -> dict[object, list[str]]:
    """Per value of ``by``: the hashes at the wanted 1-based ranks (in hash order).

    ``ranks_of`` maps the group's row count to the wanted ranks; rank 0 gives ``""``, below every
    hash.  A histogram over the first four hex digits finds the bucket of each rank; only the rows
    of those buckets (1 in 65536) are ranked.
    """
    group = F.col(by) if by else F.lit(0)
    keys = df.select(group.alias("g"), F.substring(hash_col, 1, 4).alias("b"), F.col(hash_col).alias("h"))
    histogram = keys.groupBy("g", "b").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("g").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = histogram.withColumn("upto", F.sum("n").over(running)).withColumn(
        "total", F.sum("n").over(Window.partitionBy("g"))
    )
    hits = (
        summed.select("g", "b", "n", "upto", F.posexplode(F.array(*ranks_of(F.col("total")))).alias("j", "k"))
        .where((F.col("k") <= F.col("upto")) & (F.col("k") > F.col("upto") - F.col("n")) | (F.col("k") == 0))
        .select("g", "j", "k", F.when(F.col("k") > 0, F.col("b")).alias("b"), (F.col("k") - F.col("upto") + F.col("n")).alias("r"))
        .withColumn("r", F.when(F.col("k") > 0, F.col("r")).otherwise(0))
        .distinct()
        .limit(MAX_GROUPS * 16 + 1)
        .collect()  # groups x wanted ranks, at most one row each
    )
    if len(hits) > MAX_GROUPS * 16:
        raise ValueError(f"more than {MAX_GROUPS} groups: split by a hash share instead")
    cutoffs: dict[object, dict[int, str]] = {}
    ranked: dict[tuple[object, str], list[tuple[int, int]]] = {}
    for row in hits:
        if row["k"] == 0:
            cutoffs.setdefault(row["g"], {})[row["j"]] = ""
        else:
            ranked.setdefault((row["g"], row["b"]), []).append((row["j"], row["r"]))
    if ranked:
        wanted = df.sparkSession.createDataFrame(
            [(g, b, j, r) for (g, b), picks in ranked.items() for j, r in picks],
            keys.select("g", "b").schema.add("j", T.IntegerType()).add("r", T.LongType()),
        )
        # The wanted list has groups x ranks rows (checked above), so it is safe to broadcast.
        order = Window.partitionBy("g", "b").orderBy("h")
        near = keys.join(F.broadcast(wanted.select("g", "b").distinct()), ["g", "b"], "left_semi").withColumn(
            "r", F.row_number().over(order).cast("long")
        )
        for row in near.join(F.broadcast(wanted), ["g", "b", "r"]).collect():
            cutoffs.setdefault(row["g"], {})[row["j"]] = row["h"]
    return {g: [v[j] for j in sorted(v)] for g, v in cutoffs.items()}


def cutoff_position(hash_col: Column, cutoffs: dict[object, list[str]], by: str | None = None) -> Column:
    """How many of the group's cut-offs lie strictly below the hash."""

    def position(cuts: list[str]) -> Column:
        return sum((F.when(hash_col > F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))

    if by is None:
        return position(next(iter(cutoffs.values())))
    out = F.lit(None).cast("int")
    branches = None
    for value, cuts in cutoffs.items():
        test = F.col(by).eqNullSafe(F.lit(value))
        branches = F.when(test, position(cuts)) if branches is None else branches.when(test, position(cuts))
    return out if branches is None else branches


def seeded_sample(df: DataFrame, id_col: str, cap: int, seed: int = 42) -> DataFrame:
    """At most ``cap`` rows, picked by hash order: a top-k, not a sort of the table."""
    return (
        df.withColumn("_h", seeded_hash(seed, id_col)).orderBy("_h", F.col(id_col)).limit(cap).drop("_h")
    )


def placed_rows(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """All rows with ``at``, their place (from 0) in the order of the seeded hash of their id.

    The rows are sorted over the cluster and numbered within their partitions, whose sizes are then summed; no task numbers
    them all.  Equal ids are placed next to each other in any order.
    """
    session = df.sparkSession
    order = [F.col("_h"), F.col(id_col)]
    dealt = df.withColumn("_h", seeded_hash(seed, id_col)).repartitionByRange(*order).withColumn("_p", F.spark_partition_id())
    dealt = write_stage(dealt, "placed")
    sizes = dealt.groupBy("_p").count().collect()  # one row a partition
    starts, at = [], 0
    for row in sorted(sizes, key=lambda r: r["_p"]):
        starts.append((row["_p"], at))
        at += row["count"]
    before = F.broadcast(session.createDataFrame(starts, "_p int, _start long"))
    within = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    return dealt.withColumn("_r", within).join(before, "_p").withColumn("at", F.col("_start") + F.col("_r")).drop("_h", "_p", "_r", "_start")
