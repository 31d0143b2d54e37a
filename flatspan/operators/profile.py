"""Profiling: describe, correlation, skewness, outliers.

All columns share one aggregate per pass.  Quantiles come from ``functions.quantiles`` and are
exact at any size; results hold one row per column or column pair.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatspan.functions.quantiles import DIRECT_LIMIT, exact_quantiles
from flatspan.functions.schema import as_double, numeric_columns, quoted
from flatspan.operators.blocks import add_up, keyed

#: Rows whose products a task takes at once, and tasks that hold a matrix each, at most.
GRAM_ROWS, GRAM_TASKS = 1024, 4096
#: A variance below this share of the mean square about the shift is rounding.
FLAT = 1e-13


def describe(df: DataFrame, columns: list[str] | None = None, direct_limit: int = DIRECT_LIMIT) -> DataFrame:
    """column_name, n, mean, std (sample), min, q25, q50, q75, max."""
    cols = columns or numeric_columns(df)
    moments = _moments(df, cols)
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75], direct_limit, {c: m[:3] for c, m in moments.items()})
    rows = [
        (c, moments[c][0], moments[c][3], moments[c][4], moments[c][1], *quartiles[c], moments[c][2]) for c in cols
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "column_name string, n long, mean double, std double, min double, q25 double, q50 double, q75 double, max double",
    )


def _moments(df: DataFrame, cols: list[str]) -> dict[str, tuple]:
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        x = as_double(c)
        aggs += [
            F.count(as_double(c)).alias(f"n{i}"),
            F.min(x).alias(f"lo{i}"),
            F.max(x).alias(f"hi{i}"),
            F.avg(x).alias(f"mean{i}"),
            F.stddev_samp(x).alias(f"std{i}"),
        ]
    row = df.agg(*aggs).first()
    return {
        c: (row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"], row[f"mean{i}"], row[f"std{i}"]) for i, c in enumerate(cols)
    }


def correlation(a: Column, b: Column, spread: Column | None = None) -> Column:
    """Pearson over rows where both are present; null when either is constant there.

    ``spread`` is the product of the two standard deviations where it is known already.
    """
    if spread is None:
        spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    r = F.try_divide(F.covar_pop(a, b), spread)
    # greatest and least pass over nulls, so an undefined r must not reach them.
    return F.when(r.isNotNull() & ~F.isnan(r), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def pair_sums(df: DataFrame, columns: list[str]) -> np.ndarray:
    """For all pairs of columns, over the rows where both are present: [rows, sum of a, sum of a squared, sum of a b], a and b
    taken about their means; one scan whatever the number of columns.

    A task multiplies blocks of rows, with gaps as zeros and a matrix of what is there, and what it has summed is a row for each
    column; these are added over the cluster."""
    c = len(columns)
    means = df.agg(*[F.avg(as_double(name)).alias(f"m{i}") for i, name in enumerate(columns)]).first()
    shift = np.array([m if m is not None else 0.0 for m in means])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((c, 4, c)), False
        for batch in (x for x in batches if x.num_rows):
            flat, seen = batch.column(0).flatten(), True
            there = ~np.asarray(flat.is_null()).reshape(-1, c)
            values = np.where(there, flat.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, c) - shift, 0.0)
            for at in range(0, len(values), GRAM_ROWS):
                x, m = values[at : at + GRAM_ROWS], there[at : at + GRAM_ROWS].astype(float)
                total[:, 0] += m.T @ m
                total[:, 1] += x.T @ m
                total[:, 2] += (x * x).T @ m
                total[:, 3] += x.T @ x
        if seen:
            yield keyed(list(range(c)), list(total))

    rows = df.select(F.array(*[as_double(name) for name in columns]).alias("x")).coalesce(GRAM_TASKS).mapInArrow(multiply, "key int, sums binary")
    out = np.zeros((c, 4, c))
    for r in add_up(rows).collect():  # one row a column
        out[r["key"]] = np.frombuffer(r["sums"]).reshape(4, c)
    return out.transpose(1, 0, 2)


def correlation_pairs(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """col_a, col_b, r for each unordered pair, in column order, over rows where both are present; null where either is constant
    there, no row for fewer than two columns."""
    cols = columns or numeric_columns(df)
    schema = "col_a string, col_b string, r double"
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], schema)
    n, sums, squares, products = pair_sums(df, cols)
    many = np.maximum(n, 1)
    spread = squares - sums**2 / many
    spread = np.where(spread > FLAT * squares, spread, np.nan)
    with np.errstate(invalid="ignore", divide="ignore"):
        r = (products - sums * sums.T / many) / np.sqrt(spread * spread.T)
    r = np.clip(r, -1.0, 1.0)
    rows = [(cols[i], cols[j], float(r[i, j]) if np.isfinite(r[i, j]) else None) for i, j in itertools.combinations(range(len(cols)), 2)]
    return df.sparkSession.createDataFrame(rows, schema)


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """col_a, col_b, r in both directions and with the diagonal (null for a constant column)."""
    cols = columns or numeric_columns(df)
    if len(cols) < 2:
        return correlation_pairs(df, cols)
    pairs = correlation_pairs(df, cols)
    both = pairs.select(
        F.inline(
            F.array(
                F.struct("col_a", "col_b", "r"),
                F.struct(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), F.col("r")),
            )
        )
    )
    spread = df.agg(*[F.when(F.min(as_double(c)) < F.max(as_double(c)), 1.0).alias(c) for c in cols])
    diagonal = spread.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("col_a"), F.lit(c).alias("col_b"), quoted(c).alias("r")) for c in cols])
        )
    )
    return both.unionByName(diagonal)


def skewness_of(x: Column) -> Column:
    """Bias-adjusted skewness; null under three rows, 0 for a constant column."""
    n = F.count(x).cast("double")
    adjusted = F.try_divide(F.skewness(x) * F.sqrt(n * (n - 1)), n - 2)
    return F.when(n < 3, None).when(F.min(x) == F.max(x), 0.0).otherwise(adjusted)


def skewness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column_name, skewness."""
    cols = columns or numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, skewness double")
    one_row = df.agg(*[skewness_of(as_double(c)).alias(c) for c in cols])
    return one_row.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), quoted(c).alias("skewness")) for c in cols]))
    )


def outlier_summary(
    df: DataFrame, columns: list[str] | None = None, k: float = 1.5, direct_limit: int = DIRECT_LIMIT
) -> DataFrame:
    """column_name, n_outliers, pct_outliers, lower_fence, upper_fence.

    Fences lie k interquartile ranges outside the quartiles; the first pass finds them, the second
    counts what is strictly outside, with the fences as literals.
    """
    cols = columns or numeric_columns(df)
    quartiles = exact_quantiles(df, cols, [0.25, 0.75], direct_limit)
    fences = {}
    for c, (q1, q3) in quartiles.items():
        fences[c] = (None, None) if q1 is None else (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    aggs = []
    for i, c in enumerate(cols):
        x, (low, high) = as_double(c), fences[c]
        outside = F.lit(False) if low is None else (x < F.lit(low)) | (x > F.lit(high))
        aggs += [F.count_if(outside).alias(f"o{i}"), F.count(as_double(c)).alias(f"n{i}")]
    if not aggs:
        return df.sparkSession.createDataFrame([], _OUTLIER_SCHEMA)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"o{i}").alias("n_outliers"),
                F.coalesce(F.round(F.try_divide(F.col(f"o{i}"), F.col(f"n{i}")) * 100, 4), F.lit(0.0)).alias(
                    "pct_outliers"
                ),
                F.lit(fences[c][0]).cast("double").alias("lower_fence"),
                F.lit(fences[c][1]).cast("double").alias("upper_fence"),
            )
            for i, c in enumerate(cols)
        ]
    )
    return df.agg(*aggs).select(F.inline(rows))


_OUTLIER_SCHEMA = "column_name string, n_outliers long, pct_outliers double, lower_fence double, upper_fence double"


# --- views over the profile tables (a row per column, so sorting them is cheap) -----------------


def skew_ranking(skew: DataFrame) -> DataFrame:
    """Most skewed first, undefined last; ``place`` keeps the order in the result itself."""
    return _ranked(skew, F.abs("skewness").desc_nulls_last())


def outlier_ranking(outliers: DataFrame) -> DataFrame:
    return _ranked(outliers, F.col("pct_outliers").desc())


def _ranked(df: DataFrame, order: Column) -> DataFrame:
    from pyspark.sql import Window

    # One row per profiled column: a window without partitions is safe here.
    return df.withColumn("place", F.row_number().over(Window.orderBy(order, "column_name")))


def describe_long(described: DataFrame) -> DataFrame:
    """column_name, stat, value."""
    stats = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    return described.withColumn("n", as_double("n")).unpivot(["column_name"], ["n", *stats], "stat", "value")


@dataclass
class Profile:
    """What one look at a table gives: its size, and a row for each column or pair of columns."""

    shape: DataFrame
    describe: DataFrame
    correlation: DataFrame
    skewness: DataFrame
    outliers: DataFrame

    def facts(self) -> DataFrame:
        """All of it as part, column_name, other, measure, value."""
        none = F.lit(None).cast("string")
        shape = self.shape.unpivot([], self.shape.columns, "measure", "value").select(F.lit("shape").alias("part"), none.alias("column_name"), none.alias("other"), "measure", as_double("value").alias("value"))
        told = describe_long(self.describe).select(F.lit("describe"), "column_name", none, "stat", "value")
        pairs = self.correlation.select(F.lit("correlation"), "col_a", "col_b", F.lit("r"), "r")
        skew = self.skewness.select(F.lit("skewness"), "column_name", none, F.lit("skewness"), "skewness")
        measures = ["n_outliers", "pct_outliers", "lower_fence", "upper_fence"]
        outside = self.outliers.withColumn("n_outliers", as_double("n_outliers")).unpivot(["column_name"], measures, "measure", "value")
        outside = outside.select(F.lit("outliers"), "column_name", none, "measure", "value")
        return shape.union(told).union(pairs).union(skew).union(outside)


def profile(df: DataFrame, k: float = 1.5, columns: list[str] | None = None) -> Profile:
    """The whole profile of a table: shape, description, correlations, skewness, and outliers beyond k interquartile ranges."""
    cols = columns or numeric_columns(df)
    shape = df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"), F.lit(len(cols)).cast("long").alias("n_numeric"))
    return Profile(shape, describe(df, cols), correlation_matrix(df, cols), skewness(df, cols), outlier_summary(df, cols, k))


def correlation_wide(matrix: DataFrame, columns: list[str]) -> DataFrame:
    """One row and one value column per table column."""
    return matrix.groupBy("col_a").pivot("col_b", columns).agg(F.first("r"))
