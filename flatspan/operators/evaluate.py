"""Evaluation of a scored frame: every operator is an aggregate over (actual, predicted, score).

Counts by class or by segment are combined before the shuffle, so their results are small however
uneven the classes are.
"""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatspan.functions.quantiles import DIRECT_LIMIT, exact_quantiles
from flatspan.functions.schema import as_double, as_text
from flatspan.functions.seeded import seeded_sample
from flatspan.operators.features import distinct_counts

# Thresholds, bins, margins and segment limits.  The segment limits are features and do not grow with a table.
THRESHOLDS = (0.3, 0.4, 0.5)
CALIBRATION_BINS = 10
MIN_CATEGORIES, MAX_CATEGORIES, MAX_SEGMENT_COLUMNS = 2, 50, 5
MIN_SEGMENT_ROWS = 20
RELATIVE_MARGIN, ABSOLUTE_MARGIN = 0.5, 0.10


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


# --- classification ---------------------------------------------------------------------------


def confusion_matrix(scored: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """actual, predicted, n over the union of labels, zero cells included."""
    counts = scored.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # The counts have classes x classes rows; the label list is collected from them.
    labels = counts.agg(
        F.array_distinct(F.flatten(F.collect_set(F.array("actual", "predicted")))).alias("labels")
    )
    grid = labels.select(F.explode("labels").alias("actual"), "labels").select(
        "actual", F.explode("labels").alias("predicted")
    )
    return grid.join(counts, ["actual", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))


def label_counts(scored: DataFrame, actual: str = "actual", predicted: str = "predicted", by: list[str] = []) -> DataFrame:
    """Per label: true positives, actual rows, predicted rows."""
    hit = (F.col(actual) == F.col(predicted)).cast("long")
    pairs = scored.groupBy(*by, F.col(actual).alias("_a"), F.col(predicted).alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(hit).alias("_hit")
    )
    sides = F.array(
        F.struct(F.col("_a").alias("label"), F.col("_hit").alias("tp"), F.col("_n").alias("a"), F.lit(0).cast("long").alias("p")),
        F.struct(F.col("_p").alias("label"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("a"), F.col("_n").alias("p")),
    )
    return (
        pairs.select(*by, F.inline(sides))
        .groupBy(*by, "label")
        .agg(F.sum("tp").alias("true_positive"), F.sum("a").alias("n_actual"), F.sum("p").alias("n_predicted"))
    )


def macro_scores(scored: DataFrame, actual: str = "actual", predicted: str = "predicted", by: list[str] = []) -> DataFrame:
    """precision_macro, recall_macro, f1_macro: plain means over the labels, 0/0 is 0."""
    per_label = label_counts(scored, actual, predicted, by)
    tp, n_a, n_p = as_double("true_positive"), as_double("n_actual"), as_double("n_predicted")
    return per_label.groupBy(*by).agg(
        F.round(F.avg(ratio(tp, n_p)), 6).alias("precision_macro"),
        F.round(F.avg(ratio(tp, n_a)), 6).alias("recall_macro"),
        F.round(F.avg(ratio(2 * tp, n_a + n_p)), 6).alias("f1_macro"),
    )


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> float | None:
    """Area under the ROC curve, ties count half; None unless both classes occur.

    ``numBins=0`` keeps every distinct score; the evaluator range-sorts them and carries partial
    sums between partitions, so no task sees them all.
    """
    both = scored.agg(F.min(label).alias("low"), F.max(label).alias("high")).first()
    if both["low"] is None or both["low"] == both["high"]:
        return None
    frame = scored.select(as_double(score).alias("score"), as_double(label).alias("label"))
    return BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", metricName="areaUnderROC", numBins=0
    ).evaluate(frame)


def threshold_sweep(
    scored: DataFrame, label: str = "label", score: str = "score", thresholds: tuple[float, ...] = THRESHOLDS
) -> DataFrame:
    """Per threshold: macro F1, precision and recall of the higher label, and the four cells."""
    top = F.max(label).alias("top")
    high = scored.agg(top).first()["top"]
    positive, s = F.col(label) == F.lit(high), as_double(score)
    aggs = [F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")]
    for i, t in enumerate(thresholds):
        aggs += [F.count_if(positive & (s >= t)).alias(f"tp{i}"), F.count_if(~positive & (s >= t)).alias(f"fp{i}")]
    cells = F.array(
        *[
            F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"))
            for i, t in enumerate(thresholds)
        ]
    )
    rows = scored.agg(*aggs).select("pos", "neg", F.inline(cells))
    fn, tn = F.col("pos") - F.col("tp"), F.col("neg") - F.col("fp")
    f1_pos = ratio(2.0 * F.col("tp"), 2.0 * F.col("tp") + F.col("fp") + fn)
    f1_neg = ratio(2.0 * tn, 2.0 * tn + F.col("fp") + fn)
    return rows.select(
        "threshold",
        F.round((f1_pos + f1_neg) / 2, 6).alias("f1_macro"),
        F.round(ratio(as_double("tp"), F.col("tp") + F.col("fp")), 6).alias("precision_minority"),
        F.round(ratio(as_double("tp"), as_double("pos")), 6).alias("recall_minority"),
        tn.alias("true_negative"),
        F.col("fp").alias("false_positive"),
        fn.alias("false_negative"),
        F.col("tp").alias("true_positive"),
    )


def accuracy_vs_baseline(confusion: DataFrame) -> DataFrame:
    """accuracy, majority_baseline and below_baseline, from the confusion matrix."""
    rows = confusion.groupBy("actual").agg(
        F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)).alias("hit"),
        F.sum("n").alias("n"),
    )
    out = rows.agg(
        F.try_divide(F.sum("hit"), F.sum("n")).alias("accuracy"),
        F.try_divide(F.max("n"), F.sum("n")).alias("majority_baseline"),
    )
    return out.withColumn("below_baseline", F.col("accuracy") < F.col("majority_baseline"))


# --- regression -------------------------------------------------------------------------------


def adjusted_r2(r2: Column, n: Column, n_features: int) -> Column:
    free = n - F.lit(n_features) - 1
    return F.when(free > 0, 1 - (1 - r2) * (n - 1) / F.when(free > 0, free))


def regression_metrics(
    scored: DataFrame, n_features: int, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """rmse, mae, r2, adjusted_r2."""
    a, p = as_double(actual), as_double(predicted)
    sums = scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((a - p) * (a - p)).alias("sse"),
        F.avg(F.abs(a - p)).alias("mae"),
        (F.var_pop(a) * F.count(a)).alias("sst"),
    )
    r2 = 1 - F.try_divide(F.col("sse"), F.col("sst"))
    return sums.select(
        F.round(F.sqrt(F.try_divide(F.col("sse"), F.col("n"))), 6).alias("rmse"),
        F.round("mae", 6).alias("mae"),
        F.round(r2, 6).alias("r2"),
        F.round(adjusted_r2(r2, F.col("n"), n_features), 6).alias("adjusted_r2"),
    )


# --- calibration ------------------------------------------------------------------------------


def reliability_bins(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    n_bins: int = CALIBRATION_BINS,
    direct_limit: int = DIRECT_LIMIT,
) -> DataFrame:
    """bin, n, prob_true, prob_pred over quantile bins of the score; empty bins are left out, and
    there are no rows when the scores do not spread over two bins."""
    distinct = distinct_counts(scored, [score], n_bins)[score]
    bins = min(n_bins, distinct)
    edges: list[float] = []
    if bins >= 2:
        cuts = exact_quantiles(scored, [score], [i / bins for i in range(bins + 1)], direct_limit)[score]
        edges = sorted({c for c in cuts if c is not None})
    if len(edges) < 3:
        return scored.sparkSession.createDataFrame([], "bin int, n long, prob_true double, prob_pred double")
    s, y = as_double(score), as_double(label)
    place = sum((F.when(s > F.lit(e), 1).otherwise(0) for e in edges[1:-1]), F.lit(0))
    return (
        scored.groupBy(place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(y), 6).alias("prob_true"), F.round(F.avg(s), 6).alias("prob_pred"))
    )


def calibration_error(bins: DataFrame) -> DataFrame:
    """ece: mean |observed - predicted| weighted by bin size, 0 without rows."""
    gap = F.col("n") * F.abs(F.col("prob_true") - F.col("prob_pred"))
    return bins.agg(F.round(ratio(F.sum(gap), F.sum("n")), 6).alias("ece"))


def brier_score(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    gap = as_double(label) - as_double(score)
    return scored.agg(F.round(F.avg(gap * gap), 6).alias("brier_score"))


# --- error by segment -------------------------------------------------------------------------


def segment_columns(
    df: DataFrame,
    columns: list[str],
    low: int = MIN_CATEGORIES,
    high: int = MAX_CATEGORIES,
    limit: int = MAX_SEGMENT_COLUMNS,
) -> DataFrame:
    """place, column_name, n_values: columns with a handful of values, most values first, ties in
    column order."""
    counts = distinct_counts(df, columns, high)
    n_rows = df.count()
    fit = [(c, counts[c]) for c in columns if low <= counts[c] <= high and counts[c] < n_rows]
    fit.sort(key=lambda x: -x[1])
    return df.sparkSession.createDataFrame(
        [(i + 1, c, n) for i, (c, n) in enumerate(fit[:limit])], "place int, column_name string, n_values int"
    )


def _by_segment(scored: DataFrame, columns: list[str], sums: dict[str, Column]) -> DataFrame:
    """One row per (column, value), and one with neither for the whole frame: a single scan, every
    row counted once per segment column and combined before the shuffle."""
    axes = F.array(
        F.struct(F.lit(None).cast("string").alias("segment_column"), F.lit(None).cast("string").alias("segment_value")),
        *[F.struct(F.lit(c).alias("segment_column"), as_text(c).alias("segment_value")) for c in columns],
    )
    measured = scored.select(F.inline(axes), *[v.alias(k) for k, v in sums.items()])
    return measured.groupBy("segment_column", "segment_value").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(k).alias(k) for k in sums]
    )


def _against_overall(rows: DataFrame, metrics: list[str], min_rows: int) -> DataFrame:
    """Puts the overall metrics (one row, a scalar subquery) next to each segment with enough rows."""
    overall = rows.where(F.col("segment_column").isNull()).select(F.struct(*metrics)).scalar()
    segments = rows.where(
        F.col("segment_column").isNotNull() & F.col("segment_value").isNotNull() & (F.col("n") >= min_rows)
    ).withColumn("_overall", overall)
    return segments.withColumns({f"overall_{m}": F.col(f"_overall.{m}") for m in metrics}).drop("_overall")


def is_elevated(segment: Column, overall: Column, absolute: float | None = None) -> Column:
    margin = overall * RELATIVE_MARGIN
    if absolute is not None:
        margin = F.greatest(margin, F.lit(absolute))
    return F.coalesce(segment - overall >= margin, F.lit(False))


def flag_of(metric: str, raised: Column) -> Column:
    """A flag column that says which metric it is about."""
    return raised.alias("flag", metadata={"metric": metric})


def segment_errors_binary(
    scored: DataFrame,
    columns: list[str],
    label: str = "actual",
    predicted: str = "predicted",
    min_rows: int = MIN_SEGMENT_ROWS,
) -> DataFrame:
    """False negative and false positive rate per segment, and whether they stand out."""
    high = scored.agg(F.max(label).alias("top")).first()["top"]
    pos, hit = F.col(label) == F.lit(high), F.col(predicted) == F.lit(high)
    rows = _by_segment(
        scored,
        columns,
        {
            "n_positive": pos.cast("long"),
            "n_negative": (~pos).cast("long"),
            "fn": (pos & ~hit).cast("long"),
            "fp": (~pos & hit).cast("long"),
        },
    ).select(
        "segment_column",
        "segment_value",
        "n",
        "n_positive",
        "n_negative",
        F.try_divide(as_double("fn"), as_double("n_positive")).alias("false_negative_rate"),
        F.try_divide(as_double("fp"), as_double("n_negative")).alias("false_positive_rate"),
    )
    names = ["false_negative_rate", "false_positive_rate"]
    joined = _against_overall(rows, names, min_rows)
    for name, size in zip(names, ["n_positive", "n_negative"]):
        flag = is_elevated(F.col(name), F.col(f"overall_{name}"), ABSOLUTE_MARGIN) & (F.col(size) >= min_rows)
        joined = joined.withColumn(f"elevated_{name}", flag_of(name, flag))
    return _rounded(joined, [*names, *[f"overall_{m}" for m in names]])


def segment_errors_multiclass(
    scored: DataFrame,
    columns: list[str],
    label: str = "actual",
    predicted: str = "predicted",
    min_rows: int = MIN_SEGMENT_ROWS,
) -> DataFrame:
    """Share of wrong predictions per segment."""
    wrong = (~F.col(label).eqNullSafe(F.col(predicted))).cast("long")
    rows = _by_segment(scored, columns, {"wrong": wrong}).select(
        "segment_column", "segment_value", "n", (F.col("wrong") / F.col("n")).alias("misclassification_rate")
    )
    joined = _against_overall(rows, ["misclassification_rate"], min_rows).withColumn(
        "elevated_misclassification_rate",
        flag_of(
            "misclassification_rate",
            is_elevated(F.col("misclassification_rate"), F.col("overall_misclassification_rate"), ABSOLUTE_MARGIN),
        ),
    )
    return _rounded(joined, ["misclassification_rate", "overall_misclassification_rate"])


def segment_errors_regression(
    scored: DataFrame,
    columns: list[str],
    actual: str = "actual",
    predicted: str = "predicted",
    min_rows: int = MIN_SEGMENT_ROWS,
) -> DataFrame:
    """MAE and mean error (actual - predicted) per segment."""
    gap = as_double(actual) - as_double(predicted)
    rows = _by_segment(scored, columns, {"abs_sum": F.abs(gap), "gap_sum": gap}).select(
        "segment_column",
        "segment_value",
        "n",
        (F.col("abs_sum") / F.col("n")).alias("mae"),
        (F.col("gap_sum") / F.col("n")).alias("mean_error"),
    )
    joined = (
        _against_overall(rows, ["mae", "mean_error"], min_rows)
        .withColumn("elevated_mae", flag_of("mae", is_elevated(F.col("mae"), F.col("overall_mae"))))
        .withColumn("elevated_bias", flag_of("mean_error", F.abs("mean_error") >= F.col("overall_mae") * RELATIVE_MARGIN))
    )
    return _rounded(joined, ["mae", "mean_error", "overall_mae", "overall_mean_error"])


def _rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


# --- prediction tables ------------------------------------------------------------------------


def predictions_table_classification(
    scored: DataFrame, id_col: str, actual: str = "actual", predicted: str = "predicted",
    confidence: str = "confidence", cap: int | None = None, seed: int = 42,
) -> DataFrame:
    """row_id, actual_label, predicted_label, confidence, correct; all rows, or ``cap`` sampled ones."""
    rows = scored if cap is None else seeded_sample(scored, id_col, cap, seed)
    return rows.select(
        F.col(id_col).alias("row_id"),
        F.col(actual).alias("actual_label"),
        F.col(predicted).alias("predicted_label"),
        F.round(as_double(confidence), 6).alias("confidence"),
        F.col(actual).eqNullSafe(F.col(predicted)).alias("correct"),
    )


def predictions_table_regression(
    scored: DataFrame, id_col: str, actual: str = "actual", predicted: str = "predicted",
    cap: int | None = None, seed: int = 42,
) -> DataFrame:
    """row_id, actual_value, predicted_value, error (predicted - actual), abs_error."""
    rows = scored if cap is None else seeded_sample(scored, id_col, cap, seed)
    error = as_double(predicted) - as_double(actual)
    return rows.select(
        F.col(id_col).alias("row_id"),
        F.round(as_double(actual), 6).alias("actual_value"),
        F.round(as_double(predicted), 6).alias("predicted_value"),
        F.round(error, 6).alias("error"),
        F.round(F.abs(error), 6).alias("abs_error"),
    )


def prediction_points(
    scored: DataFrame, id_col: str, actual: str = "actual", predicted: str = "predicted",
    cap: int | None = None, seed: int = 42,
) -> DataFrame:
    """(actual, predicted, residual) points for plots: all rows, or ``cap`` sampled ones."""
    rows = scored if cap is None else seeded_sample(scored, id_col, cap, seed)
    return rows.select(
        F.round(as_double(actual), 6).alias("actual"),
        F.round(as_double(predicted), 6).alias("predicted"),
        F.round(as_double(actual) - as_double(predicted), 6).alias("residual"),
    )
