"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8); BENCH_QUERIES may name queries,
``all`` times every registered one.
"""

from __future__ import annotations

import json
import os
import sys
import threading
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = os.pathsep.join([HERE, *filter(None, [os.environ.get("PYTHONPATH")])])  # for the workers

from flatspan.plans import base, q_train  # noqa: E402
from flatspan.plans.catalog import QUERIES  # noqa: E402
from flatspan.session import build_session  # noqa: E402

HEADLINE = [
    "flatten_items_agg", "flatten_order_mart", "flatten_dimension_lookups", "dedupe_exact", "dedupe_text", "placeholder_null",
    "type_correct", "impute_median", "column_modes", "low_variance_cols", "clean_pipeline", "describe_numeric", "corr_matrix",
    "skewness", "iqr_outliers", "redundant_cols", "standard_scale", "one_hot", "frequency_encode_many_values", "feature_pipeline",
    "split_stratified", "split_grouped", "cv_folds", "confusion_matrix", "roc_auc", "threshold_sweep", "reliability_bins",
    "segment_errors_binary", "regression_metrics", "predictions_table", "leaderboard", "hist_bins", "kde_grid", "top_correlations",
    "worst_segments", "markdown_sections", "run_rows", "step_outcomes", "primary_metric", "train_leaderboard",
]


#: A key's bound for one run, and that of all keys; what runs out is named and not counted.
KEY_SECONDS = float(os.environ.get("BENCH_KEY_SECONDS", "240"))
TOTAL_SECONDS = float(os.environ.get("BENCH_TOTAL_SECONDS", "1500"))


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else asked.split(",") if asked else HEADLINE
    spark = build_session(
        "flatspan-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One warm-up of the engine (class loading, code generation), not of the measured results.
    spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    out: list[str] = []
    started = time.perf_counter()

    def report(final: bool) -> None:
        """One JSON line; before the last one it goes to the error stream after each key, so that a stopped bench loses nothing."""
        line = {"metric": "total_wall_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "first_run": first, "out_of_time": out, "sf": os.path.basename(sf.rstrip("/"))}
        print(json.dumps(line), file=sys.stdout if final else sys.stderr, flush=True)

    def timed(name: str) -> float | None:
        """Seconds of one run; its jobs are cancelled at the key's bound."""
        left = min(KEY_SECONDS, TOTAL_SECONDS - (time.perf_counter() - started))
        stopped = threading.Event()

        def stop() -> None:
            stopped.set()
            spark.sparkContext.cancelAllJobs()

        timer = threading.Timer(max(left, 0.1), stop)
        timer.start()
        begun = time.perf_counter()
        try:
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        except Exception:
            if not stopped.is_set():
                raise
        finally:
            timer.cancel()
        return None if stopped.is_set() else round(time.perf_counter() - begun, 3)

    for name in names:
        # Nothing that another query has kept is used; the first run builds what the query keeps, the second is its time.
        spark.catalog.clearCache()
        base.forget()
        q_train.forget()
        for into in (first, times):
            seconds = timed(name)
            if seconds is None:
                out.append(name)
                break
            into[name] = seconds
        report(False)
    report(True)
    spark.stop()


if __name__ == "__main__":
    main()
