"""The whole job on one table: clean, profile, features, train, charts, facts, report.

Every step reads what the step before wrote and writes tables of its own under
``<folder>/<run id>/``, so a step can be looked at, and lineage does not grow over the job.  One run
row per step goes to the run history, one experiment row to the experiment history.  The first step
that fails ends the job; the steps after it are recorded as skipped.
"""

from __future__ import annotations

import logging
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatspan.functions.schema import categorical_columns, numeric_columns
from flatspan.operators import charts, clean, evaluate, facts, features, history, profile, select, split, tables, train
from flatspan.session import write_stage
from flatspan.sources import runs as run_files
from flatspan.sources.tables import write_table

log = logging.getLogger(__name__)

STEPS = ["clean", "profile", "features", "train", "charts", "facts", "report"]


@dataclass
class PipelineResult:
    run_id: str
    folder: str
    runs: DataFrame
    outputs: dict[str, str] = field(default_factory=dict)
    aborted: bool = False
    abort_reason: str | None = None


class _Job:
    """One run: the inputs, and what the finished steps left for the next ones."""

    def __init__(self, df, target, id_col, group_col, config, folder, data_path, names):
        self.spark: SparkSession = df.sparkSession
        self.df, self.target, self.id_col, self.group_col = df, target, id_col, group_col
        self.config, self.folder, self.data_path = config, folder, data_path
        self.positive, self.negative, self.unit = names
        self.outputs: dict[str, str] = {}
        self.result: train.Result | None = None
        self.cleaning: clean.CleaningReport | None = None
        self.frames: dict[str, DataFrame] = {}

    def _table(self, df: DataFrame, name: str) -> DataFrame:
        self.outputs[name] = write_table(df, os.path.join(self.folder, name))
        return self.spark.read.parquet(self.outputs[name])

    def _report(self, df: DataFrame, name: str) -> DataFrame:
        """A small table, kept as JSON and read back, so that later steps do not compute it again."""
        self.outputs[name] = run_files.write_report(df, os.path.join(self.folder, "reports"), name)
        self.frames[name] = self.spark.read.schema(df.schema).json(self.outputs[name])
        return self.frames[name]

    def clean(self) -> str:
        row_id = None
        if self.id_col is None or self.id_col not in self.df.columns:
            self.id_col = row_id = "row_id"
        protected = [c for c in (self.id_col, self.target, self.group_col) if c in self.df.columns]
        cleaned, _, self.cleaning = clean.clean(
            self.df, stage=lambda d: write_stage(d, "unique"), protected=protected, row_id=row_id
        )
        self.frames["cleaned"] = self._table(cleaned, "cleaned")
        self._report(clean.report_rows(self.spark, self.cleaning), "cleaning")
        return self.outputs["cleaned"]

    def profile(self) -> str:
        df = self.frames["cleaned"]
        found = profile.profile(df)
        for name in ("describe", "correlation", "skewness", "outliers"):
            self._report(getattr(found, name), name)
        return self.outputs["describe"]

    def features(self) -> str:
        df = self.frames["cleaned"]
        protected = [c for c in (self.id_col, self.target, self.group_col) if c]
        model = features.fit_features(df, protected=protected)
        self.frames["features"] = self._table(features.apply_features(df, model), "features")
        self._report(features.feature_report(df, model), "feature_steps")
        return self.outputs["features"]

    def train(self) -> str:
        r = train.train(
            self.frames["features"], self.target, self.id_col, self.group_col, self.config, os.path.join(self.folder, "model")
        )
        self.result = r
        self.outputs["model"] = os.path.join(self.folder, "model")
        metrics = self.spark.createDataFrame([(k, float(v)) for k, v in r.metrics.items()], "metric string, value double")
        self._report(metrics, "metrics")
        self._report(r.board, "leaderboard")
        self._report(r.importances, "importances")
        names = self.config.segment_columns or [
            x["column_name"] for x in evaluate.segment_columns(r.prepared.test, r.features).collect()
        ]
        if r.task == split.REGRESSION:
            self._report(evaluate.predictions_table_regression(r.scored, self.id_col), "predictions")
            segments = evaluate.segment_errors_regression(r.scored, names)
        else:
            self._report(evaluate.predictions_table_classification(r.scored, self.id_col), "predictions")
            self._report(evaluate.confusion_matrix(r.scored), "confusion")
            binary = r.task == split.BINARY
            segments = (evaluate.segment_errors_binary if binary else evaluate.segment_errors_multiclass)(r.scored, names)
            if "score" in r.scored.columns:
                self._report(evaluate.threshold_sweep(r.scored, "label"), "thresholds")
                self._report(evaluate.reliability_bins(r.scored, "label"), "calibration")
                self._report(train.calibration_comparison(r, self.config), "calibration_errors")
                if r.calibrated is not None:
                    self._report(evaluate.reliability_bins(r.calibrated, "label"), "calibrated")
        self._report(segments, "segments")
        self.segment_names = names
        run_files.append_experiments(self._experiment(r), os.path.join(os.path.dirname(self.folder), "experiments"))
        return self.outputs["model"]

    def _experiment(self, r: train.Result) -> DataFrame:
        board = {x["model"]: (x["cv_score"], x["cv_std"]) for x in self.frames["leaderboard"].collect()}
        note = [x["note"] for x in select.near_tie(r.board).select("note").collect()]
        row = (
            uuid.uuid4().hex, _now(), self.data_path, self.target, r.task, r.best, r.prepared.strategy, self.group_col,
            self.config.seed, len(r.features), {k: str(v) for k, v in r.params.items()}, {k: v[0] for k, v in board.items()},
            {k: v[1] for k, v in board.items()}, {k: float(v) for k, v in r.metrics.items()}, note[0] if note else None,
            r.nested[0] if r.nested else None, r.nested[1] if r.nested else None, self.outputs["metrics"],
        )
        schema = history.EXPERIMENT_SCHEMA.replace("best_hyperparameters string", "best_hyperparameters map<string,string>")
        for c in ("cv_scores", "cv_std", "test_metrics"):
            schema = schema.replace(f"{c} string", f"{c} map<string,double>")
        return history.encode_maps(
            self.spark.createDataFrame([row], schema), ["best_hyperparameters", "cv_scores", "cv_std", "test_metrics"]
        )

    def charts(self) -> str:
        df, r = self.frames["cleaned"], self.result
        importances = self.frames["importances"]
        made: dict[str, DataFrame | str] = {
            "distributions": charts.histogram(df, charts.histogram_columns(df, importances)),
            "densities": charts.density_curve(df, charts.histogram_columns(df, importances)),
            "heatmap": charts.heatmap_cells(self.frames["correlation"]),
            "importance": charts.importance_bars(importances),
        }
        numeric = set(numeric_columns(df)) - {self.target}
        ranked = importances.orderBy(F.col("importance_mean").desc(), "feature").collect()  # top features only
        best = next((x["feature"] for x in ranked if x["feature"] in numeric), None)
        regression = r.task == split.REGRESSION
        if best is None:
            made["top_feature"] = "no numeric column among the top features"
        elif regression:
            made["top_feature"] = charts.trend_line(df, best, self.target)
            made["top_feature_points"] = charts.scatter_points(df, best, self.target, self.id_col)
        else:
            made["top_feature"] = charts.box_by_class(df, best, self.target)
        made.setdefault("top_feature_points", "classification run" if best and not regression else made["top_feature"])
        if regression:
            made["residuals"] = evaluate.prediction_points(r.scored, self.id_col)
            made["confusion"] = "regression run"
        else:
            made["confusion"] = charts.confusion_cells(self.frames["confusion"], self.positive, self.negative)
            made["residuals"] = "classification run"
        made["thresholds"] = charts.threshold_curve(self.frames["thresholds"]) if "thresholds" in self.frames else "no probabilities"
        made["calibration"] = charts.calibration_curve(self.frames["calibration"], self.frames.get("calibrated")) if "calibration" in self.frames else "no probabilities"
        segments = self.frames["segments"]
        metrics = [c.removeprefix("overall_") for c in segments.columns if c.startswith("overall_")]
        made["segments"] = charts.segment_bars(segments, self.segment_names, metrics)
        kept = {k: v if isinstance(v, str) else self._report(v, f"chart_{k}") for k, v in made.items()}
        self._report(charts.chart_catalogue(kept), "chart_catalogue")
        return self.outputs["chart_catalogue"]

    def facts(self) -> str:
        df = self.frames["cleaned"]
        shape = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            "n_rows",
            F.lit(len(df.columns)).alias("n_columns"),
            F.lit(len(numeric_columns(df))).alias("n_numeric"),
            F.lit(len(categorical_columns(df))).alias("n_categorical"),
        )
        pairs = self.frames["correlation"].where("col_a < col_b")
        found = facts.profile_facts(shape, pairs, self.frames["skewness"], self.frames["outliers"])
        metrics = self.spark.createDataFrame([{k: float(v) for k, v in self.result.metrics.items()}])
        self._report(found.unionByName(facts.model_facts(metrics, self.frames["importances"], self.frames["segments"])), "facts")
        return self.outputs["facts"]

    def report(self) -> str:
        self._report(tables.diagnostics_rows(self.spark, self.cleaning), "diagnostics")
        wide = self.spark.createDataFrame([{k: float(v) for k, v in self.result.metrics.items()}])
        self._report(tables.metric_table(wide), "metric_table")
        return self.outputs["diagnostics"]


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def run_pipeline(
    df: DataFrame,
    target: str,
    folder: str,
    run_id: str,
    id_col: str | None = None,
    group_col: str | None = None,
    config: train.Config = train.Config(),
    data_path: str = "",
    positive: str = "Positive",
    negative: str = "Negative",
    unit: str = "record",
) -> PipelineResult:
    """Run all steps; ``target`` and ``group_col`` go through cleaning and features unchanged."""
    job = _Job(df, target, id_col, group_col, config, os.path.join(folder, run_id), data_path, (positive, negative, unit))
    rows, reason, last = [], None, data_path
    for name in STEPS:
        started = _now()
        if reason is not None:
            rows.append((name, started, started, None, f"not run: {rows[-1][0]} has no result", None, [None]))
            continue
        step: Callable[[], str] = getattr(job, name)
        try:
            output, error = step(), None
            log.info("%s done: %s", name, output)
        except Exception as exc:  # the history must have a row for a step that fails
            log.exception("%s failed", name)
            output, error = None, str(exc).splitlines()[0]
            reason = f"ended by step '{name}': {error}"
        rows.append((name, started, _now(), error is None, output, error, [last or None]))
        last = output
    events = job.spark.createDataFrame(
        [(f"{run_id}/{i}", *r) for i, r in enumerate(rows)],
        "run_id string, step string, started_at timestamp_ntz, finished_at timestamp_ntz, ok boolean, message string, error string, inputs array<string>",
    )
    path = os.path.join(folder, "runs")
    run_files.append_runs(history.run_rows(events), path)
    log_rows = run_files.read_history(job.spark, path, history.RUN_SCHEMA).where(F.col("run_id").startswith(f"{run_id}/"))
    return PipelineResult(run_id, job.folder, log_rows, job.outputs, reason is not None, reason)
