"""Column kinds, missing values and row identity."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NESTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Everything flat that is not numeric: strings, booleans, dates and timestamps."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema
        if not isinstance(f.dataType, (T.NumericType, *NESTED)) and f.name not in skip
    ]


def nested_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NESTED)]


def column_kinds(df: DataFrame) -> DataFrame:
    """One row per column: position, name, kind and type."""
    numeric, categorical = set(numeric_columns(df)), set(categorical_columns(df))
    rows = [
        (
            i,
            f.name,
            "numeric" if f.name in numeric else "categorical" if f.name in categorical else "excluded",
        )
        for i, f in enumerate(df.schema)
    ]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, kind string")


def quoted(name: str) -> Column:
    """A column by its exact name, which may hold dots and back quotes."""
    return F.col("`" + name.replace("`", "``") + "`")


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN and infinity of float columns become null."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    bad = (float("inf"), float("-inf"))
    return df.select(
        *[
            F.when(F.isnan(quoted(c)) | quoted(c).isin(*bad), None).otherwise(quoted(c)).alias(c)
            if c in floats
            else quoted(c)
            for c in df.columns
        ]
    )


def as_double(name: str | Column) -> Column:
    """The value as a double; NaN and infinity are missing, as everywhere."""
    value = (quoted(name) if isinstance(name, str) else name).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def as_text(name: str) -> Column:
    return quoted(name).cast("string")


def content_id(df: DataFrame, name: str = "row_id", columns: Iterable[str] | None = None) -> DataFrame:
    """A row id taken from the row's own values, so that it never changes when a task is run again.

    Rows must differ (run duplicate removal first); equal rows get the same id.
    """
    cols = list(columns) if columns is not None else df.columns
    parts = [F.coalesce(as_text(c), F.lit("\u0000")) for c in cols]
    return df.withColumn(name, F.md5(F.concat_ws("\u0001", *parts)))


# What counts as white space at the ends of a text, and as a line end inside it.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
LINE_ENDS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


def strip(value: Column) -> Column:
    """Cut white space of every kind at both ends."""
    return F.btrim(value, F.lit(WHITE_SPACE))


def plain_lines(text: Column) -> Column:
    """Every kind of line end as a newline."""
    return F.translate(F.replace(text, F.lit("\r\n"), F.lit("\n")), LINE_ENDS, "\n" * len(LINE_ENDS))
