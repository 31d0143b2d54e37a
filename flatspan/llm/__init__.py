"""Operators for preparing language-model training data.  Nothing else in the package imports them."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores behind where the frame has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
