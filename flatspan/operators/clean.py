"""Cleaning: duplicates, placeholders, numeric text, missing values, near-constant columns.

Every decision about a table is taken from one fused aggregate over all columns; what is learned is
a small dataclass of per-column values, so that it can be applied to any other frame, a stream
included.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatspan.functions.quantiles import DIRECT_LIMIT, exact_quantiles
from flatspan.functions.schema import as_double, as_text, categorical_columns, content_id, nan_to_null, numeric_columns, quoted, strip

# The texts that stand for a missing value, and those that count as blank.
PLACEHOLDERS = ["unknown", "error", "n/a", "na", "none", "null", "-", "--", ""]
BLANK_TEXTS = ["", "nan", "None", "NaN"]
MODE_FALLBACK = "unknown"

#: What a whole text must look like to be read as a number; narrower than a cast, which also takes
#: suffixed Java literals such as ``1d``.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


# --- duplicates -------------------------------------------------------------------------------


def drop_duplicates(df: DataFrame, subset: list[str] | None = None, order_by: list[str] | None = None) -> DataFrame:
    """One row per distinct key; nulls are equal.

    Without an order any row of a group may stay, which is only well defined when all columns are
    compared.  With an order the first row stays: the minimum of a struct, which is combined before
    the shuffle, so that a key with very many copies costs no more than any other.
    """
    if not order_by:
        return df.dropDuplicates(subset)
    keys = subset or df.columns
    rest = [c for c in df.columns if c not in keys]
    first = F.min(F.struct(*[quoted(c) for c in order_by], *[quoted(c) for c in rest if c not in order_by])).alias("_first")
    picked = df.groupBy(*keys).agg(first)
    return picked.select(*[quoted(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def duplicate_counts(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """rows, distinct rows and rows removed."""
    keys = subset or df.columns
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))
        .withColumn("n_duplicates_removed", F.col("n_rows") - F.col("n_distinct"))
    )


# --- placeholders -----------------------------------------------------------------------------


def _is_placeholder(name: str, values: Iterable[str] | None) -> Column:
    wanted = sorted({str(v).strip().lower() for v in (PLACEHOLDERS if values is None else values)})
    return F.lower(strip(F.col(name))).isin(wanted)


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def placeholders_to_null(df: DataFrame, values: Iterable[str] | None = None) -> DataFrame:
    """Texts that equal a placeholder (trimmed, any case) become null; other types are left alone."""
    return df.withColumns({c: F.when(~_is_placeholder(c, values), quoted(c)) for c in _text_columns(df)})


def placeholder_counts(df: DataFrame, values: Iterable[str] | None = None) -> DataFrame:
    """column_name, n_placeholders; only columns that have any."""
    cols = _text_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, n_placeholders long")
    counts = df.agg(*[F.count_if(_is_placeholder(c, values)).alias(c) for c in cols])
    return long_format(counts, cols, "n_placeholders").where("n_placeholders > 0")


def long_format(one_row: DataFrame, cols: list[str], value_name: str) -> DataFrame:
    """Turn a one-row frame with one column per table column into one row per table column."""
    return one_row.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), quoted(c).alias(value_name)) for c in cols]))
    )


# --- numeric text -----------------------------------------------------------------------------


def parse_number(value: Column) -> Column:
    return F.when(value.rlike(NUMBER_PATTERN), F.trim(value).try_cast("double"))


def type_correction_decisions(
    df: DataFrame, columns: list[str] | None = None, min_share: float = 0.9
) -> DataFrame:
    """column_name, n_non_blank, n_parsed, converts.

    A column converts when more than ``min_share`` of its non-blank values read as numbers.
    Booleans read as 0 and 1, so they are listed, although their type stays.
    """
    wanted = [c for c in (columns or categorical_columns(df)) if c in df.columns]
    kinds = dict(df.dtypes)
    aggs = []
    for c in wanted:
        text = as_text(c)
        aggs.append(F.count_if(text.isNotNull() & ~strip(text).isin(BLANK_TEXTS)).alias(f"{c}|n"))
        parsed = quoted(c).isNotNull() if kinds[c] == "boolean" else parse_number(text).isNotNull()
        aggs.append(F.count_if(parsed).alias(f"{c}|p"))
    if not aggs:
        return df.sparkSession.createDataFrame(
            [], "column_name string, n_non_blank long, n_parsed long, converts boolean"
        )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"`{c}|n`").alias("n_non_blank"),
                F.col(f"`{c}|p`").alias("n_parsed"),
            )
            for c in wanted
        ]
    )
    return df.agg(*aggs).select(F.inline(rows)).withColumn(
        "converts",
        F.coalesce(F.try_divide("n_parsed", "n_non_blank") > min_share, F.lit(False)),
    )


def correct_types(df: DataFrame, columns: list[str] | None = None, min_share: float = 0.9) -> tuple[DataFrame, list[str]]:
    """Numeric-looking text columns become double, what does not parse becomes null."""
    decided = type_correction_decisions(df, columns, min_share).where("converts").collect()  # columns only
    convert = [r["column_name"] for r in decided]
    return apply_type_correction(df, convert), convert


def apply_type_correction(df: DataFrame, convert: list[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns(
        {c: parse_number(quoted(c)) for c in convert if kinds.get(c) == "string"}
    )


# --- missing values ---------------------------------------------------------------------------


def missing_fractions(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """column_name, missing_fraction, high_missing (more than ``threshold`` missing)."""
    shares = df.agg(*[F.avg(quoted(c).isNull().cast("int")).alias(c) for c in df.columns])
    return long_format(shares, df.columns, "missing_fraction").withColumn(
        "high_missing", F.coalesce(F.col("missing_fraction") > threshold, F.lit(False))
    )


def column_modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, mode_value, mode_count: the most frequent non-null value, ties to the smallest.

    Counting (column, value) pairs first keeps any one task from holding all values of a column;
    values are compared as text.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), as_text(c).alias("value")) for c in columns])
    counted = (
        df.select(F.inline(pairs)).where(F.col("value").isNotNull()).groupBy("column_name", "value").count()
    )
    best = F.min(F.struct((-F.col("count")).alias("n"), F.col("value"))).alias("best")
    return counted.groupBy("column_name").agg(best).select(
        "column_name", F.col("best.value").alias("mode_value"), (-F.col("best.n")).alias("mode_count")
    )


@dataclass
class FillValues:
    """What the imputer learned: medians, modes, and which columns are mostly missing."""

    numeric: dict[str, float | None] = field(default_factory=dict)
    categorical: dict[str, str] = field(default_factory=dict)
    high_missing: list[str] = field(default_factory=list)
    had_missing: list[str] = field(default_factory=list)


def fit_fill_values(df: DataFrame, threshold: float = 0.5, direct_limit: int = DIRECT_LIMIT) -> FillValues:
    """Median per numeric column (None when all null), mode per other column."""
    numeric, categorical = numeric_columns(df), categorical_columns(df)
    medians = exact_quantiles(df, numeric, [0.5], direct_limit)
    modes = {}
    if categorical:
        modes = {r["column_name"]: r["mode_value"] for r in column_modes(df, categorical).collect()}
    missing = missing_fractions(df, threshold).where("missing_fraction > 0").collect()  # columns only
    return FillValues(
        {c: medians[c][0] for c in numeric},
        {c: modes.get(c, MODE_FALLBACK) for c in categorical},
        [r["column_name"] for r in missing if r["high_missing"]],
        [r["column_name"] for r in missing],
    )


def fill_missing(df: DataFrame, fills: FillValues) -> DataFrame:
    """Apply learned values; columns the frame does not have are passed over.

    A median may fall between two integers: an integer column that had gaps in the fit then
    becomes double.  One that had none keeps its type (keys above all).
    """
    kinds = dict(df.dtypes)
    changed = {}
    for c, value in fills.numeric.items():
        if c in kinds and value is not None:
            widen = c in fills.had_missing and not float(value).is_integer()
            changed[c] = F.coalesce(as_double(c), F.lit(value)) if widen else F.coalesce(quoted(c), F.lit(value).cast(kinds[c]))
    for c, value in fills.categorical.items():
        if c in kinds:
            changed[c] = F.coalesce(quoted(c), F.lit(value).try_cast(kinds[c]))
    return df.withColumns(changed)


# --- near-constant columns --------------------------------------------------------------------


def top_value_shares(df: DataFrame, threshold: float = 0.99) -> DataFrame:
    """column_name, top_share, low_variance: columns where one value (null counts as one) has at
    least ``threshold`` of all rows.  ``top_share`` is given for those columns only.

    For a threshold clearly above one half only a sketch of frequent values is needed to name the one
    possible candidate per column, and a second aggregate counts it: two scans with one row per
    task to shuffle, however many distinct values the columns have.
    """
    cols = [f.name for f in df.schema]
    if threshold <= 0.51:  # the sketch is within half a percent
        return _top_shares_by_count(df, cols, threshold)
    sketch = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.expr(f"approx_top_k(cast(`{c}` as string), 1, 1000)").alias(c) for c in cols],
        *[F.count_if(quoted(c).isNull()).alias(f"{c}|null") for c in cols],
    ).first()
    rows = sketch["_rows"]
    if not rows:
        return df.sparkSession.createDataFrame([], _SHARE_SCHEMA)
    checks = {}
    for c in cols:
        if sketch[f"{c}|null"] >= threshold * rows:
            checks[c] = F.count_if(quoted(c).isNull())
        else:
            frequent = [x["item"] for x in (sketch[c] or []) if x["item"] is not None]
            if frequent:
                checks[c] = F.count_if(as_text(c) == F.lit(frequent[0]))
    counted = df.agg(*[v.alias(c) for c, v in checks.items()]).first().asDict() if checks else {}
    shares = {c: counted.get(c, 0) / rows for c in cols}
    return df.sparkSession.createDataFrame(
        [(c, s if s >= threshold else None, s >= threshold) for c, s in shares.items()], _SHARE_SCHEMA
    )


_SHARE_SCHEMA = "column_name string, top_share double, low_variance boolean"


def _top_shares_by_count(df: DataFrame, cols: list[str], threshold: float) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), as_text(c).alias("value")) for c in cols])
    counted = df.select(F.inline(pairs)).groupBy("column_name", "value").count()
    shares = counted.groupBy("column_name").agg((F.max("count") / F.sum("count")).alias("share"))
    low = F.col("share") >= threshold
    return shares.select("column_name", F.when(low, F.col("share")).alias("top_share"), low.alias("low_variance"))


def low_variance_columns(df: DataFrame, threshold: float = 0.99) -> list[str]:
    return [r["column_name"] for r in top_value_shares(df, threshold).where("low_variance").collect()]


# --- the whole step ---------------------------------------------------------------------------


# The fields of a report, and the default thresholds of ``clean``.
@dataclass
class CleaningReport:
    input_shape: tuple[int, int]
    output_shape: tuple[int, int]
    n_duplicates_removed: int
    placeholder_values_normalized: dict[str, int]
    columns_type_corrected: list[str]
    high_missing_columns_flagged: list[str]
    numeric_columns_imputed: list[str]
    categorical_columns_imputed: list[str]
    low_variance_columns_dropped: list[str]
    high_missing_columns_dropped: list[str] = field(default_factory=list)


@dataclass
class CleaningModel:
    """All that cleaning learned from one frame, ready to be applied to another."""

    placeholder_values: list[str] | None
    converted: list[str]
    fills: FillValues
    dropped: list[str]


def clean(
    df: DataFrame,
    high_missing_threshold: float = 0.5,
    low_variance_threshold: float = 0.99,
    drop_high_missing: bool = False,
    placeholder_values: list[str] | None = None,
    direct_limit: int = DIRECT_LIMIT,
    stage: Callable[[DataFrame], DataFrame] = DataFrame.persist,
    protected: Iterable[str] = (),
    row_id: str | None = None,
) -> tuple[DataFrame, CleaningModel, CleaningReport]:
    """Duplicates, placeholders, types, missing values, near-constant columns, in this order.

    The frame after duplicate removal, the one full shuffle of the step, is scanned several times:
    ``stage`` keeps it.  The default persists it; large jobs pass ``session.write_stage``.

    ``protected`` columns (a target, ids, groups) are neither filled nor dropped.  ``row_id`` adds an id from the rows' content
    as it is after duplicate removal, when rows still differ.
    """
    source = nan_to_null(df)
    unique = source.dropDuplicates()
    if row_id is not None:
        unique = content_id(unique, row_id)
    unique = stage(unique)
    kept = {*protected, *([row_id] if row_id is not None else [])}
    n_in, n_unique = source.count(), unique.count()
    counts = {r["column_name"]: r["n_placeholders"] for r in placeholder_counts(unique.drop(*kept - set(protected)), placeholder_values).collect()}
    normalized = placeholders_to_null(unique, placeholder_values)
    typed, converted = correct_types(normalized)
    open_ = typed.drop(*kept)
    fills = fit_fill_values(open_, high_missing_threshold, direct_limit)
    numeric, categorical = numeric_columns(open_), categorical_columns(open_)
    filled = fill_missing(typed, fills)
    dropped = low_variance_columns(filled.drop(*kept), low_variance_threshold) if n_unique else []
    too_empty = [c for c in fills.high_missing if drop_high_missing and c not in dropped]
    result = filled.drop(*dropped, *too_empty)
    report = CleaningReport(
        (n_in, len(df.columns)),
        (n_unique, len(result.columns)),
        n_in - n_unique,
        counts,
        converted,
        fills.high_missing,
        numeric,
        categorical,
        dropped,
        too_empty,
    )
    return result, CleaningModel(placeholder_values, converted, fills, dropped + too_empty), report


def apply_cleaning(df: DataFrame, model: CleaningModel) -> DataFrame:
    """Row-wise part of the step with learned values: no aggregate, so it also runs on a stream."""
    normalized = placeholders_to_null(nan_to_null(df), model.placeholder_values)
    return fill_missing(apply_type_correction(normalized, model.converted), model.fills).drop(*model.dropped)


def report_rows(spark: SparkSession, report: CleaningReport) -> DataFrame:
    """The report as rows (item, column_name, value)."""
    rows: list[tuple[str, str | None, int | None]] = [
        ("input_rows", None, report.input_shape[0]),
        ("input_columns", None, report.input_shape[1]),
        ("output_rows", None, report.output_shape[0]),
        ("output_columns", None, report.output_shape[1]),
        ("duplicates_removed", None, report.n_duplicates_removed),
    ]
    rows += [("placeholders", c, n) for c, n in report.placeholder_values_normalized.items()]
    for item in (
        "columns_type_corrected",
        "high_missing_columns_flagged",
        "numeric_columns_imputed",
        "categorical_columns_imputed",
        "low_variance_columns_dropped",
        "high_missing_columns_dropped",
    ):
        rows += [(item, c, None) for c in getattr(report, item)]
    return spark.createDataFrame(rows, "item string, column_name string, value long")
