"""Feature engineering: redundant columns, skew, scale, encoding.

Each step has a ``fit`` that learns a small state from one frame and an ``apply`` that uses it on
any frame.  Protected columns pass through every step unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatspan.functions.schema import as_double, as_text, categorical_columns, numeric_columns, quoted
from flatspan.session import write_stage
from flatspan.operators.profile import correlation_pairs, skewness_of

UNKNOWN_CATEGORY = "__unknown__"  # fixed value: the dummy column of missing values

#: A value with at least this share of the rows is looked up by broadcast; there are at most
#: 1 / HOT_SHARE such values, whatever the size of the table.
HOT_SHARE = 0.001


# --- redundant columns ------------------------------------------------------------------------


def redundant_columns(df: DataFrame, threshold: float = 0.95, protected: Iterable[str] = ()) -> list[str]:
    """Columns whose |r| with an earlier kept column is above the threshold, in column order."""
    cols = numeric_columns(df, protected)
    if len(cols) < 2:
        return []
    strong = {
        (r["col_a"], r["col_b"])
        for r in correlation_pairs(df, cols).where(F.abs("r") > threshold).collect()  # column pairs only
    }
    dropped: list[str] = []
    for place, kept in enumerate(cols):
        if kept not in dropped:
            dropped += [c for c in cols[place + 1 :] if (kept, c) in strong and c not in dropped]
    return [c for c in cols if c in dropped]


# --- skew -------------------------------------------------------------------------------------


def skewed_columns(df: DataFrame, threshold: float = 1.0, protected: Iterable[str] = ()) -> list[str]:
    """Non-negative numeric columns with |skewness| above the threshold."""
    cols = numeric_columns(df, protected)
    if not cols:
        return []
    aggs = []
    for i, c in enumerate(cols):
        aggs += [skewness_of(as_double(c)).alias(f"s{i}"), F.min(as_double(c)).alias(f"m{i}")]
    row = df.agg(*aggs).first()
    return [
        c
        for i, c in enumerate(cols)
        if row[f"s{i}"] is not None and abs(row[f"s{i}"]) > threshold and row[f"m{i}"] >= 0
    ]


def apply_log1p(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.log1p(as_double(c)) for c in columns if c in df.columns})


# --- scale ------------------------------------------------------------------------------------


@dataclass
class ScaleStats:
    stats: dict[str, tuple[float, float]] = field(default_factory=dict)  # column: (mean, sample std)
    zero_variance: list[str] = field(default_factory=list)


def fit_scale(df: DataFrame, protected: Iterable[str] = ()) -> ScaleStats:
    cols = numeric_columns(df, protected)
    out = ScaleStats()
    if not cols:
        return out
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(as_double(c)).alias(f"a{i}"), F.stddev_samp(as_double(c)).alias(f"s{i}"), (F.min(quoted(c)) == F.max(quoted(c))).alias(f"z{i}")]
    row = df.agg(*aggs).first()
    for i, c in enumerate(cols):
        if row[f"z{i}"] or row[f"s{i}"] == 0.0:
            out.zero_variance.append(c)
        elif row[f"s{i}"] is not None:
            out.stats[c] = (row[f"a{i}"], row[f"s{i}"])
    return out


def apply_scale(df: DataFrame, scale: ScaleStats) -> DataFrame:
    return df.withColumns(
        {c: (as_double(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scale.stats.items() if c in df.columns}
    )


# --- encoding ---------------------------------------------------------------------------------


@dataclass
class Encoding:
    """``one_hot``: column -> its values; ``frequency``: column -> table of (value, frequency).

    The tables are DataFrames, as a column may have as many values as there are rows.
    """

    one_hot: dict[str, list[str]] = field(default_factory=dict)
    frequency: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def strategies(self) -> dict[str, str]:
        return {**{c: "one_hot" for c in self.one_hot}, **{c: "frequency" for c in self.frequency}}


def distinct_counts(df: DataFrame, columns: list[str], exact_below: int) -> dict[str, int]:
    """Distinct non-null values per column: exact where there are few, else the sketch's estimate.

    Exact counting of many columns expands every row; it is only worth it, and only decides
    anything, where the sketch is within a factor of two of the bound that matters.
    """
    if not columns:
        return {}
    rough = df.agg(*[F.approx_count_distinct(quoted(c), 0.02).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    out = {c: rough[f"d{i}"] for i, c in enumerate(columns)}
    close = [c for c in columns if out[c] <= 2 * exact_below]
    if close:
        row = df.agg(*[F.size(F.collect_set(quoted(c))).alias(f"d{i}") for i, c in enumerate(close)]).first()
        out.update({c: row[f"d{i}"] for i, c in enumerate(close)})
    return out


def fit_encoding(df: DataFrame, ohe_threshold: int = 20, protected: Iterable[str] = ()) -> Encoding:
    cols = categorical_columns(df, protected)
    counts = distinct_counts(df, cols, ohe_threshold)
    few = [c for c in cols if counts[c] < ohe_threshold]
    out = Encoding()
    if few:
        seen = df.agg(
            *[F.array_sort(F.collect_set(as_text(c))).alias(f"v{i}") for i, c in enumerate(few)],
            *[(F.count(quoted(c)) < F.count(F.lit(1))).alias(f"m{i}") for i, c in enumerate(few)],
        ).first()
        for i, c in enumerate(few):
            out.one_hot[c] = sorted([*seen[f"v{i}"], *([UNKNOWN_CATEGORY] if seen[f"m{i}"] else [])])
    many = [c for c in cols if c not in few]
    total = df.count() if many else 0
    for c in many:
        # Written once: it is read for frequent and for other values, and for every batch of a stream.
        out.frequency[c] = write_stage(frequency_table(df, c, total), "frequency")
    return out


def frequency_table(df: DataFrame, column: str, total: int | None = None) -> DataFrame:
    """value, n, frequency; frequency is the share of all rows, those without a value included."""
    total = df.count() if total is None else total
    return (
        df.where(quoted(column).isNotNull())
        .groupBy(quoted(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("frequency", F.col("n") / F.lit(float(total)))
    )


def dummy_names(column: str, values: list[str], taken: Iterable[str] = ()) -> dict[str, str]:
    """Column name per value; characters that are awkward in column names become ``_``, and values
    that would share a name, with each other or with a column that is there, get a number."""
    out: dict[str, str] = {}
    taken = set(taken)
    for value in values:
        name = plain = f"{column}_{re.sub(r'[^0-9A-Za-z_#@+-]+', '_', value)}"
        number = 1
        while name in out.values() or name in taken:
            number += 1
            name = f"{plain}_{number}"
        out[value] = name
    return out


def apply_one_hot(df: DataFrame, one_hot: dict[str, list[str]]) -> DataFrame:
    """Replace each column by its dummies, at the end; values not seen in the fit give zeros."""
    here = {c: v for c, v in one_hot.items() if c in df.columns}
    dummies, taken = [], {c for c in df.columns if c not in here}
    for c, values in here.items():
        names = dummy_names(c, values, taken)
        taken |= set(names.values())
        filled = F.coalesce(as_text(c), F.lit(UNKNOWN_CATEGORY))
        dummies += [(filled == F.lit(v)).cast("int").alias(n) for v, n in names.items()]
    return df.select(*[quoted(c) for c in df.columns if c not in here], *dummies)


def apply_frequency(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """Replace values by their frequency; unseen and missing values give 0.

    Values with a large share of the rows come from a broadcast of at most 1 / HOT_SHARE values.
    The other values are joined by shuffle; rows that are already answered (or have no value)
    get a spread-out salt, so no task of that join has more than a small share of the rows.
    """
    hot = table.where(F.col("frequency") >= HOT_SHARE).select(
        F.col("value").alias(column), F.col("frequency").alias("_hot")
    )
    cold = table.where(F.col("frequency") < HOT_SHARE).select(
        F.col("value").alias(column), F.lit(0).alias("_salt"), F.col("frequency").alias("_cold")
    )
    others = [c for c in df.columns if c != column] or [column]
    spread = F.pmod(F.xxhash64(*[quoted(c) for c in others]), F.lit(4096)).cast("int") + 1
    answered = F.col("_hot").isNotNull() | quoted(column).isNull()
    joined = (
        df.join(F.broadcast(hot), column, "left")
        .withColumn("_salt", F.when(answered, spread).otherwise(0))
        .join(cold, [column, "_salt"], "left")
    )
    value = F.coalesce("_hot", "_cold", F.lit(0.0))
    return joined.select(*[value.alias(c) if c == column else quoted(c) for c in df.columns])


def apply_encoding(df: DataFrame, encoding: Encoding) -> DataFrame:
    out = apply_one_hot(df, encoding.one_hot)
    for c, table in encoding.frequency.items():
        if c in out.columns:
            out = apply_frequency(out, c, table)
    return out


def decode_frequency(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """Which values stand behind each encoded frequency: frequency, n_values, first_value, rows.

    Several values may share a frequency, so decoding gives the candidates' number and smallest
    name.  Both sides are grouped by frequency before they meet.
    """
    names = table.groupBy("frequency").agg(F.count(F.lit(1)).alias("n_values"), F.min("value").alias("first_value"))
    used = df.groupBy(F.col(column).alias("frequency")).agg(F.count(F.lit(1)).alias("n_rows"))
    return used.join(names, "frequency", "left")


# --- the whole step ---------------------------------------------------------------------------


@dataclass
class FeatureModel:
    redundant: list[str]
    log_columns: list[str]
    scale: ScaleStats
    encoding: Encoding
    protected: list[str]


def fit_features(
    df: DataFrame,
    corr_threshold: float = 0.95,
    skew_threshold: float = 1.0,
    ohe_threshold: int = 20,
    protected: Iterable[str] = (),
) -> FeatureModel:
    """Redundant columns, then skew, then scale, then encoding; each learned on the result of the
    step before.  Fit on the training rows only to keep the test rows out of the statistics."""
    keep = list(protected)
    redundant = redundant_columns(df, corr_threshold, keep)
    pruned = df.drop(*redundant)
    logs = skewed_columns(pruned, skew_threshold, keep)
    scale = fit_scale(apply_log1p(pruned, logs), keep)
    return FeatureModel(redundant, logs, scale, fit_encoding(pruned, ohe_threshold, keep), keep)


def apply_features(df: DataFrame, model: FeatureModel) -> DataFrame:
    pruned = df.drop(*model.redundant)
    return apply_encoding(apply_scale(apply_log1p(pruned, model.log_columns), model.scale), model.encoding)


def feature_report(df: DataFrame, model: FeatureModel) -> DataFrame:
    """step, column_name, mean, std; one row per decision."""
    rows: list[tuple] = [("redundant_dropped", c, None, None) for c in model.redundant]
    rows += [("log1p", c, None, None) for c in model.log_columns]
    rows += [("scaled", c, m, s) for c, (m, s) in model.scale.stats.items()]
    rows += [("zero_variance", c, None, None) for c in model.scale.zero_variance]
    rows += [(kind, c, None, None) for c, kind in model.encoding.strategies.items()]
    return df.sparkSession.createDataFrame(rows, "step string, column_name string, mean double, std double")
