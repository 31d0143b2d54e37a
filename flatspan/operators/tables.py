"""Report tables and their filters: diagnostics, metric tables, search, pages, text sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flatspan.functions.schema import plain_lines, quoted, strip
from flatspan.operators.clean import CleaningReport, report_rows

# Display names of metrics and tasks, and the words that place a section.
METRIC_LABELS = {
    "f1_macro": "F1 (macro)",
    "precision_macro": "Precision (macro)",
    "recall_macro": "Recall (macro)",
    "roc_auc": "ROC-AUC",
    "rmse": "RMSE",
    "mae": "MAE",
    "r2": "R²",
    "adjusted_r2": "Adjusted R²",
}
TASK_LABELS = {
    "binary_classification": "Classification",
    "multiclass_classification": "Classification",
    "regression": "Regression",
}
SECTION_WORDS = {
    "executive_summary": "found",
    "business_insights": "matter",
    "recommendations": "recommend",
}


#: Keys that divide the rows once on the way to a far page.
PAGE_DIVIDERS = 64


def _lookup(key: Column, values: dict[str, str], default: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return F.coalesce(table[key], default)


def metric_table(metrics: DataFrame) -> DataFrame:
    """metric, label, value from a one-row frame of metrics."""
    return (
        metrics.unpivot([], metrics.columns, "metric", "value")
        .where(F.col("value").isNotNull())
        .select("metric", _lookup(F.col("metric"), METRIC_LABELS, F.col("metric")).alias("label"), "value")
    )


def diagnostics_rows(spark: SparkSession, report: CleaningReport) -> DataFrame:
    """step, effect, column_name, n: what cleaning did, a row for each effect on the table or on a column.

    ``n`` counts rows, columns or values; a column that was converted, flagged, filled or dropped counts one.
    """
    item = F.col("item")
    step = F.when(item.startswith("input") | item.startswith("output"), "shape").when(item.startswith("dupl"), "rows")
    step = step.when(item == "placeholders", "values").otherwise("columns")
    effect = F.regexp_replace(item, "^(columns|numeric_columns|categorical_columns|high_missing_columns|low_variance_columns)_", "")
    reason = F.regexp_extract(item, "^(numeric|categorical|high_missing|low_variance)_columns_", 1)
    effect = F.concat_ws(": ", F.replace(effect, F.lit("_"), F.lit(" ")), F.when(reason != "", F.replace(reason, F.lit("_"), F.lit(" "))))
    return report_rows(spark, report).select(
        step.alias("step"), effect.alias("effect"), "column_name", F.coalesce("value", F.lit(1)).cast("long").alias("n")
    )


# --- filters over a predictions table -----------------------------------------------------------


def incorrect_only(predictions: DataFrame) -> DataFrame:
    """Wrong rows; unchanged where there is no ``correct`` column."""
    return predictions.where(~F.col("correct")) if "correct" in predictions.columns else predictions


def large_errors(predictions: DataFrame, at_least: float) -> DataFrame:
    """Rows with an absolute error of at least ``at_least``; unchanged without that column."""
    return predictions.where(F.col("abs_error") >= at_least) if "abs_error" in predictions.columns else predictions


def search_rows(predictions: DataFrame, text: str | None, column: str = "row_id") -> DataFrame:
    """Rows whose id holds the text, any case, taken literally; a blank text keeps all rows."""
    if not text or not text.strip() or column not in predictions.columns:
        return predictions
    return predictions.where(F.lower(F.col(column).cast("string")).contains(text.strip().lower()))


def page(df: DataFrame, number: int, size: int, order_by: str, near_limit: int = 100_000) -> DataFrame:
    """One page in key order (nulls first), counted from 1; numbers outside go to the nearest page.

    A page is a top-k.  For a page far into a table the key it begins near is found first: a few keys, compared in their own
    type, divide the rows, one aggregate counts the rows below each, and the range that holds the page is divided again, until no
    more than ``near_limit`` rows come before the page's end.  So no task sorts what comes before, whatever the key's type.
    """
    rows = df.count()
    pages = max(1, -(-rows // size))
    start = (min(max(1, number), pages) - 1) * size
    key, low, high, before = quoted(order_by), None, None, 0
    while True:
        here = df if low is None else df.where(key >= F.lit(low))
        if start - before + size <= near_limit:
            break
        inside = here.where(key.isNotNull() if low is None else key > F.lit(low))
        inside = inside if high is None else inside.where(key < F.lit(high))
        divided = inside.select(key.alias("k")).orderBy(F.xxhash64("k")).limit(PAGE_DIVIDERS).distinct().collect()
        keys = sorted(r["k"] for r in divided)
        if not keys:
            break
        counts = here.agg(*[F.count_if(key.isNull() | (key < F.lit(k))).alias(f"c{i}") for i, k in enumerate(keys)]).first()
        reached = [(k, before + counts[i]) for i, k in enumerate(keys)]
        high = next((k for k, n in reached if n > start), high)
        low, before = next(((k, n) for k, n in reversed(reached) if n <= start), (low, before))
    return here.orderBy(key).offset(start - before).limit(size)


def preview(df: DataFrame, n: int = 10) -> tuple[DataFrame, tuple[int, int]]:
    """(first n rows, (rows, columns))."""
    return df.limit(n), (df.count(), len(df.columns))


# --- per-run texts ------------------------------------------------------------------------------


def task_label(task_type: Column) -> Column:
    return _lookup(task_type, TASK_LABELS, F.lit("Unknown"))


def run_captions(experiments: DataFrame) -> DataFrame:
    """Adds task_label, banner and caveat; the caveat is for binary runs, with the calibration error
    where one was measured.  Expects target_col, task_type, ece."""
    label = task_label(F.col("task_type"))
    banner = F.when(
        F.coalesce(F.col("target_col"), F.lit("")) != "",
        F.concat(label, F.lit(" of "), F.col("target_col"), F.lit(" (kind of task told from its values)")),
    )
    note = F.lit("Probabilities come from class-weighted training: read a threshold as a cutoff, not as a chance.")
    measured = F.when(F.col("ece").isNotNull(), F.format_string(" Measured calibration error (ECE): %.3f.", "ece")).otherwise("")
    caveat = F.when(F.col("task_type") == "binary_classification", F.concat(note, measured))
    return experiments.withColumns({"task_label": label, "banner": banner, "caveat": caveat})


# --- sections of a text -------------------------------------------------------------------------


def _sections(text: Column) -> Column:
    """array<struct(header, body)> of the parts under ``## `` lines."""
    parts = F.split(F.concat(F.lit("\n"), plain_lines(text)), "\n## ", -1)

    def section(part):
        end = F.instr(part, "\n")
        body = F.when(end > 0, F.substr(part, end + 1)).otherwise("")
        return F.struct(strip(F.substring_index(part, "\n", 1)).alias("header"), strip(body).alias("body"))

    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), section)


def text_sections(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, position (from 1), header, body: one row per section of each text."""
    return df.select(F.col(id_col), F.posexplode(_sections(F.col(text_col))).alias("position", "section")).select(
        id_col, (F.col("position") + 1).alias("position"), "section.header", "section.body"
    )


def _header_has(word: str):
    return lambda s: s["h"].contains(word)


def _unused(sections: str, taken: list[str]) -> Column:
    """The sections not yet given to one of the taken slots."""
    used = F.array(*[F.coalesce(F.col(t)["i"], F.lit(-1)) for t in taken], F.lit(-1))
    return F.filter(F.col(sections), lambda s: ~F.array_contains(used, s["i"]))


def section_slots(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and one column per slot: a section goes to the slot whose word its header has; slots still
    empty take the remaining sections in order."""
    numbered = F.transform(
        _sections(F.col(text_col)), lambda s, i: F.struct(i.alias("i"), F.lower(s["header"]).alias("h"), s["body"].alias("b"))
    )
    out = df.select(F.col(id_col), numbered.alias("s"))
    taken: list[str] = []
    for slot, word in SECTION_WORDS.items():
        free = _unused("s", taken)
        fitting = F.filter(free, _header_has(word))
        out = out.withColumn(f"_{slot}", F.try_element_at(fitting, F.lit(1)))
        taken.append(f"_{slot}")
    out = out.withColumn("_rest", _unused("s", taken))
    columns, empty_before = [], F.lit(0)
    for t in taken:
        spare = F.try_element_at(F.col("_rest"), empty_before + 1)
        columns.append(F.coalesce(F.col(t)["b"], F.when(F.col(t).isNull(), spare["b"])).alias(t[1:]))
        empty_before = empty_before + F.col(t).isNull().cast("int")
    return out.select(id_col, *columns)
