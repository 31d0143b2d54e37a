"""History of runs and experiments: row rules and queries over append-only tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatspan.functions.schema import plain_lines, strip

RUN_SCHEMA = (
    "run_id string, step string, started_at timestamp_ntz, finished_at timestamp_ntz, status string, input_path string, "
    "output_path string, error_message string, duration_seconds double"
)
# The column names of the experiment table.
EXPERIMENT_SCHEMA = (
    "experiment_id string, logged_at timestamp_ntz, data_path string, target_col string, task_type string, "
    "best_model_name string, split_strategy string, group_col string, random_state int, n_features int, "
    "best_hyperparameters string, cv_scores string, cv_std string, test_metrics string, model_selection_note string, "
    "nested_cv_score double, nested_cv_std double, report_path string"
)

# Which metric stands for a run, the first that is present; and the log line format.
PRIMARY_METRICS = ["roc_auc", "f1_macro", "adjusted_r2", "r2", "rmse", "mae"]
LOG_LINE = r"^(\S+ \S+) \| (\w+) *\| (.*?) \| (.*)$"
RECOVERY_ACTIONS = ["retry", "skip", "abort"]


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1_000_000.0)


# --- runs -------------------------------------------------------------------------------------


def run_rows(events: DataFrame) -> DataFrame:
    """Turn raw step events into run rows.

    Expects step, started_at, finished_at, ok, message, error (an exception's text), inputs
    (array).  A step that neither succeeded, failed nor raised was skipped.
    """
    ok, raised = F.col("ok"), F.col("error").isNotNull()
    status = F.when(raised, "failure").when(ok.isNull(), "skipped").when(ok, "success").otherwise("failure")
    inputs = F.filter("inputs", lambda x: x.isNotNull())
    return events.withColumns(
        {
            "status": status,
            "input_path": F.when(F.size(inputs) > 0, F.concat_ws("; ", inputs)),
            "output_path": F.when(status == "success", F.col("message")),
            "error_message": F.when(raised, F.col("error")).when(status != "success", F.col("message")),
            "duration_seconds": seconds_between(F.col("started_at"), F.col("finished_at")),
        }
    ).drop("ok", "message", "error", "inputs")


def recent_runs(runs: DataFrame, limit: int = 50, id_col: str = "run_id") -> DataFrame:
    """Latest first; a top-k, not a sort of the history."""
    return runs.orderBy(F.col("started_at").desc(), F.col(id_col).desc()).limit(limit)


def filter_runs(runs: DataFrame, steps: list[str] | None = None, statuses: list[str] | None = None) -> DataFrame:
    out = runs.withColumn("duration_seconds", F.round("duration_seconds", 3))
    if steps is not None:
        out = out.where(F.col("step").isin(steps))
    return out if statuses is None else out.where(F.col("status").isin(statuses))


def run_health(runs: DataFrame, window: str = "1 hour", time: str = "started_at") -> DataFrame:
    """window_start, step, n_runs, n_failures, avg_seconds per tumbling window; batch or stream."""
    return (
        runs.groupBy(F.window(time, window).alias("w"), "step")
        .agg(
            F.count(F.lit(1)).alias("n_runs"),
            F.count_if(F.col("status") == "failure").alias("n_failures"),
            F.avg("duration_seconds").alias("avg_seconds"),
        )
        .select(F.col("w.start").alias("window_start"), "step", "n_runs", "n_failures", "avg_seconds")
    )


# --- experiments ------------------------------------------------------------------------------


def encode_maps(experiments: DataFrame, columns: list[str]) -> DataFrame:
    """Map columns to JSON text, an empty map for null."""
    return experiments.withColumns({c: F.coalesce(F.to_json(c), F.lit("{}")) for c in columns})


def decode_maps(experiments: DataFrame, columns: list[str], value_type: str = "double") -> DataFrame:
    return experiments.withColumns({c: F.from_json(F.coalesce(F.col(c), F.lit("{}")), f"map<string,{value_type}>") for c in columns})


def recent_experiments(experiments: DataFrame, limit: int = 50) -> DataFrame:
    """Latest first, with the JSON columns decoded."""
    latest = experiments.orderBy(F.col("logged_at").desc(), F.col("experiment_id").desc()).limit(limit)
    decoded = decode_maps(latest, ["cv_scores", "cv_std", "test_metrics"])
    return decode_maps(decoded, ["best_hyperparameters"], "string")


def primary_metric(experiments: DataFrame, metrics: str = "test_metrics") -> DataFrame:
    """Adds primary_metric_name and primary_metric_value (4 digits): the first of a fixed list that
    the run has, else the run's first metric."""
    m = F.col(metrics)
    keys = F.map_keys(m)
    known = F.coalesce(*[F.when(F.array_contains(keys, k), F.lit(k)) for k in PRIMARY_METRICS])
    name = F.coalesce(known, F.try_element_at(keys, F.lit(1)))
    return experiments.withColumn("primary_metric_name", name).withColumn(
        "primary_metric_value", F.round(F.try_element_at(m, F.col("primary_metric_name")), 4)
    )


def metric_over_time(experiments: DataFrame, datasets: list[str] | None = None, models: list[str] | None = None) -> DataFrame:
    """logged_at, primary_metric_name, primary_metric_value in time order, and ``n_metrics``: more
    than one means the points are not comparable."""
    out = experiments
    if datasets is not None:
        out = out.where(F.col("data_path").isin(datasets))
    if models is not None:
        out = out.where(F.col("best_model_name").isin(models))
    points = out.where(F.col("primary_metric_value").isNotNull()).select("logged_at", "primary_metric_name", "primary_metric_value")
    used = out.agg(F.count_distinct("primary_metric_name").alias("n_metrics")).scalar()
    return points.withColumn("n_metrics", used).orderBy("logged_at")


# --- logs and decisions -----------------------------------------------------------------------


def parse_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """logged_at, level, logger, message from ``time | LEVEL | name | message`` lines; others out."""
    parts = [F.regexp_extract(column, LOG_LINE, i) for i in range(1, 5)]
    return lines.where(F.col(column).rlike(LOG_LINE)).select(
        F.regexp_replace(parts[0], ",", ".").try_cast("timestamp_ntz").alias("logged_at"),
        parts[1].alias("level"),
        F.trim(parts[2]).alias("logger"),
        parts[3].alias("message"),
    )


def parse_decisions(answers: DataFrame, column: str) -> DataFrame:
    """Adds action and reason from ``ACTION:`` / ``REASON:`` lines: the last recognised action (none
    when there is none) and the last reason, else the first 300 characters of the answer."""
    lines = F.transform(F.split(plain_lines(F.col(column)), "\n"), strip)

    def after(label: str) -> Column:
        found = F.filter(lines, lambda x: F.upper(x).startswith(label))
        return F.transform(found, lambda x: strip(F.substr(x, F.lit(len(label) + 1))))

    actions = F.filter(F.transform(after("ACTION:"), F.lower), lambda a: a.isin(RECOVERY_ACTIONS))
    last_reason = F.try_element_at(after("REASON:"), F.lit(-1))
    whole = F.substring(strip(F.col(column)), 1, 300)
    return answers.withColumn("action", F.try_element_at(actions, F.lit(-1))).withColumn(
        "reason", F.when(F.coalesce(last_reason, F.lit("")) != "", last_reason).otherwise(whole)
    )


# --- step outcomes ----------------------------------------------------------------------------


def step_outcomes(attempts: DataFrame, max_retries: int = 1) -> DataFrame:
    """run_id, step, step_order, status, attempts, message, seconds from one row per attempt.

    Expects run_id, step, step_order, attempt, ok, message, action, seconds.  The last attempt
    decides; it is found by a maximum, so no window over a run is needed.
    """
    last = F.max_by(F.struct("ok", "message", "action"), F.col("attempt")).alias("last")
    rows = attempts.groupBy("run_id", "step_order", "step").agg(
        last, F.count(F.lit(1)).alias("attempts"), F.sum("seconds").alias("seconds")
    )
    tried = F.col("attempts")
    status = (
        F.when(F.col("last.ok") & (tried == 1), "success")
        .when(F.col("last.ok"), "success_after_retry")
        .when(tried > max_retries, "failed")
        .when(F.col("last.action") == "skip", "skipped")
        .otherwise("failed")
    )
    return rows.select(
        "run_id", "step", "step_order", status.alias("status"), "attempts", F.col("last.message").alias("message"), "seconds"
    )


def run_outcomes(outcomes: DataFrame) -> DataFrame:
    """run_id, n_steps, aborted, abort_reason, total_seconds: the first failed step ends a run."""
    failed = F.when(F.col("status") == "failed", F.struct("step_order", "step", "message"))
    return (
        outcomes.groupBy("run_id")
        .agg(
            F.count(F.lit(1)).alias("n_steps"),
            F.min(failed).alias("first"),
            F.sum("seconds").alias("total_seconds"),
        )
        .select(
            "run_id",
            "n_steps",
            F.col("first").isNotNull().alias("aborted"),
            F.when(
                F.col("first").isNotNull(),
                F.concat_ws(": ", F.concat(F.lit("ended by step "), F.col("first.step")), "first.message"),
            ).alias("abort_reason"),
            "total_seconds",
        )
    )


def missing_upstream(outcomes: DataFrame, needed: list[str]) -> DataFrame:
    """run_id and the reason to skip a step that needs the results of others: runs where at least
    one of the needed steps has none."""
    present = F.collect_set(F.when(F.col("status").isin("success", "success_after_retry"), F.col("step")))
    rows = outcomes.where(F.col("step").isin(needed)).groupBy("run_id").agg(present.alias("present"))
    absent = F.array_except(F.array(*[F.lit(n) for n in needed]), "present")
    reason = F.concat(F.lit("not run for want of results of: "), F.array_join(absent, ", "))
    return rows.where(F.size(absent) > 0).select("run_id", reason.alias("reason"))
