"""Task detection, feature matrix, train/test splits, folds and class weights.

Splits are exact (20 % of every class, 20 % of the groups) and still need no shuffle of the rows:
see ``functions.seeded``.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatspan.functions.schema import as_double, numeric_columns
from flatspan.functions.seeded import cutoff_position, hash_cutoffs, seeded_hash
from flatspan.operators.features import distinct_counts

BINARY, MULTICLASS, REGRESSION = "binary_classification", "multiclass_classification", "regression"

log = logging.getLogger(__name__)


def detect_task_type(df: DataFrame, target: str, max_classes: int = 20) -> str:
    """Two distinct values: binary; few distinct integers or texts: multiclass; else regression."""
    n = distinct_counts(df, [target], max_classes)[target]
    if n == 2:
        return BINARY
    discrete = isinstance(df.schema[target].dataType, (T.IntegralType, T.StringType))
    return MULTICLASS if discrete and n <= max_classes else REGRESSION


def feature_matrix(
    df: DataFrame, target: str, id_col: str | None = None, group_col: str | None = None
) -> tuple[list[str], list[str], list[str]]:
    """(feature columns, dropped non-numeric columns, warnings); a missing target is an error."""
    if target not in df.columns:
        raise ValueError(f"no target column {target!r} in {df.columns}")
    notes = [f"no {what} column {c!r}: going on without it" for what, c in (("id", id_col), ("group", group_col)) if c and c not in df.columns]
    used = {target, id_col, group_col}
    features = [c for c in numeric_columns(df) if c not in used]
    dropped = [c for c in df.columns if c not in used and c not in features]
    if dropped:
        notes.append(f"non-numeric columns left out: {', '.join(dropped)}")
    for note in notes:
        log.warning(note)
    return features, dropped, notes


# --- splits -----------------------------------------------------------------------------------


def split_rows(
    df: DataFrame, id_col: str, label: str | None = None, test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Adds ``is_test``: the first round(test_size * n) rows of each class in hash order (of all
    rows when no label is given)."""
    return df.withColumn("is_test", test_rows(df, id_col, test_size, seed, label))


def split_groups(df: DataFrame, group_col: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: whole groups, ceil(test_size * groups) of them, in hash order.

    The cut-off is found on the distinct groups; rows are then compared with it one by one, so a
    group may be as large as it likes.
    """
    return df.withColumn("is_test", test_rows(df, group_col, test_size, seed, groups=True))


def test_rows(df: DataFrame, key: str, test_size: float, seed: int, label: str | None = None, groups: bool = False) -> Column:
    """Whether a row is tested: by the hash of its id, per class, or of its group.  The cut-offs come from ``df``; the expression
    is a comparison with literals."""
    if groups:
        df = df.select(F.col(key)).distinct()
    share = (lambda n: F.ceil(n * test_size)) if groups else (lambda n: F.round(n * test_size))
    hashed = df.withColumn("_h", seeded_hash(seed, key))
    cuts = hash_cutoffs(hashed, "_h", lambda n: [share(n).cast("long")], label)
    return cutoff_position(seeded_hash(seed, key), cuts, label) == 0 if cuts else F.lit(False)


def group_overlap(df: DataFrame, group_col: str) -> DataFrame:
    """Groups that have rows on both sides of ``is_test``: there must be none."""
    return (
        df.groupBy(group_col)
        .agg(F.min("is_test").alias("low"), F.max("is_test").alias("high"))
        .where(F.col("low") != F.col("high"))
        .select(group_col)
    )


def assign_folds(
    df: DataFrame, id_col: str, n_folds: int = 5, label: str | None = None, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Adds the fold number: equal slices of each class (or of all rows) in hash order."""
    return df.withColumn(name, fold_number(df, id_col, n_folds, label, seed))


def fold_number(df: DataFrame, id_col: str, n_folds: int = 5, label: str | None = None, seed: int = 42) -> Column:
    """The fold of a row, from cut-offs over the rows of ``df``."""
    hashed = df.withColumn("_h", seeded_hash(seed, id_col))
    cuts = hash_cutoffs(
        hashed, "_h", lambda n: [F.ceil(n * F.lit(j) / n_folds).cast("long") for j in range(1, n_folds)], label
    )
    return cutoff_position(seeded_hash(seed, id_col), cuts, label) if cuts else F.lit(0)


# --- class weights ----------------------------------------------------------------------------


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """label, n, weight = rows / (classes * rows of the class); rows without a label do not count."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total, classes = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    return counts.withColumn("weight", F.lit(float(total or 0)) / (F.lit(classes) * F.col("n")))
