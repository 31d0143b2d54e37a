"""Model selection over a table of fold scores (model, fold, score)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def leaderboard(fold_scores: DataFrame) -> DataFrame:
    """model, cv_score, cv_std (population), place, is_best; equal scores go by ``candidate`` (the place in
    the list of candidates) where the scores tell it, then by model name.

    The window runs over one row per candidate model.
    """
    order = Window.orderBy(F.col("cv_score").desc(), "candidate", "model")
    candidate = F.min("candidate") if "candidate" in fold_scores.columns else F.lit(0)
    scores = F.round(F.avg("score"), 6).alias("cv_score"), F.round(F.stddev_pop("score"), 6).alias("cv_std")
    return (
        fold_scores.groupBy("model")
        .agg(*scores, candidate.alias("candidate"))
        .withColumn("place", F.row_number().over(order))
        .withColumn("is_best", F.col("place") == 1)
        .drop("candidate")
    )


def near_tie(board: DataFrame) -> DataFrame:
    """Compares the first two of a leaderboard: a difference within their summed standard
    deviations is no difference.  ``note`` is null unless it is a near tie; no row for one model."""
    order = Window.orderBy("place")
    pair = board.select(
        F.col("place"),
        F.col("model").alias("model_1"),
        F.lead("model").over(order).alias("model_2"),
        F.col("cv_score").alias("score_1"),
        F.lead("cv_score").over(order).alias("score_2"),
        F.col("cv_std").alias("std_1"),
        F.lead("cv_std").over(order).alias("std_2"),
    ).where((F.col("place") == 1) & F.col("model_2").isNotNull())
    gap = F.abs(F.col("score_1") - F.col("score_2"))
    spread = F.coalesce("std_1", F.lit(0.0)) + F.coalesce("std_2", F.lit(0.0))
    tie = (spread > 0) & (gap <= spread)
    note = F.format_string(
        "%s (%.4f +/- %.4f) and %s (%.4f +/- %.4f) are %.4f apart, within their combined deviation of %.4f: a close call",
        "model_1", "score_1", "std_1", "model_2", "score_2", "std_2", gap, spread,
    )
    return pair.select(
        "model_1",
        "model_2",
        F.round(gap, 6).alias("difference"),
        F.round(spread, 6).alias("combined_std"),
        tie.alias("near_tie"),
        F.when(tie, note).alias("note"),
    )
