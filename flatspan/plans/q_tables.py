"""Queries of the report tables, the run history, and the sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from flatspan.operators import clean, evaluate, history, tables
from flatspan.plans import marts
from flatspan.plans.base import query, table
from flatspan.plans.marts import SCORED_CTE
from flatspan.plans.q_evaluate import REGRESSION_SQL, TABLE_SQL, scored
from flatspan.session import new_stage_path
from flatspan.sources import runs as run_files
from flatspan.sources.tables import derived_path, read_csv, read_tables, write_table


@query(
    "metric_table",
    f"""WITH {SCORED_CTE}, {REGRESSION_SQL} SELECT metric, CASE metric WHEN 'rmse' THEN 'RMSE' WHEN 'mae' THEN 'MAE' WHEN 'r2' THEN 'R²' ELSE 'Adjusted R²' END AS label, value
        FROM metrics UNPIVOT (value FOR metric IN (rmse, mae, r2, adjusted_r2))""",
)
def _(spark, sf):
    return tables.metric_table(evaluate.regression_metrics(scored(spark, sf), 10, "price_actual", "price_predicted"))


@query(
    "diagnostics_rows",
    """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'UNKNOWN' ELSE o_orderstatus END AS status,
         CASE WHEN o_orderkey % 2 = 0 THEN '--' WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE o_orderpriority END AS priority FROM orders),
       c AS (SELECT count(*) AS n, count_if(status = 'UNKNOWN')::BIGINT AS s, count_if(priority IN ('--', 'n/a'))::BIGINT AS p FROM o)
       SELECT 'shape' AS step, 'input rows' AS effect, NULL::VARCHAR AS column_name, n AS n FROM c
       UNION ALL SELECT 'shape', 'output rows', NULL, n FROM c
       UNION ALL SELECT 'shape', unnest(['input columns', 'output columns']), NULL, 3::BIGINT
       UNION ALL SELECT 'rows', 'duplicates removed', NULL, n - (SELECT count(*) FROM (SELECT DISTINCT * FROM o)) FROM c
       UNION ALL SELECT 'values', 'placeholders', 'status', s FROM c
       UNION ALL SELECT 'values', 'placeholders', 'priority', p FROM c
       UNION ALL SELECT 'columns', 'flagged: high missing', 'priority', 1 FROM c WHERE p > 0.5 * n
       UNION ALL SELECT 'columns', 'imputed: numeric', 'o_orderkey', 1
       UNION ALL SELECT 'columns', 'imputed: categorical', unnest(['status', 'priority']), 1""",
)
def _(spark, sf):
    key = F.col("o_orderkey")
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(key % 11 == 0, "UNKNOWN").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(key % 2 == 0, "--").when(key % 7 == 0, "n/a").otherwise(F.col("o_orderpriority")).alias("priority"),
    )
    return tables.diagnostics_rows(spark, clean.clean(df)[2])


def predictions(spark, sf):
    return evaluate.predictions_table_classification(scored(spark, sf), "o_orderkey", cap=None)


@query("incorrect_only", f"WITH {SCORED_CTE} SELECT * FROM ({TABLE_SQL}) WHERE NOT correct")
def _(spark, sf):
    return tables.incorrect_only(predictions(spark, sf))


@query(
    "large_errors",
    f"""WITH {SCORED_CTE} SELECT * FROM (SELECT o_orderkey AS row_id, price_actual AS actual_value, price_predicted AS predicted_value,
        round(price_predicted - price_actual, 6) AS error, round(abs(price_predicted - price_actual), 6) AS abs_error FROM scored) WHERE abs_error >= 25000""",
)
def _(spark, sf):
    rows = evaluate.predictions_table_regression(scored(spark, sf), "o_orderkey", "price_actual", "price_predicted", cap=None)
    return tables.large_errors(rows, 25000)


@query("rowid_search", "SELECT c_custkey, c_name AS row_id, c_mktsegment FROM customer WHERE contains(lower(c_name), 'omer#00000012')")
def _(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("row_id"), "c_mktsegment")
    return tables.search_rows(rows, " OMER#00000012 ")


@query("page_slice", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 300")
def _(spark, sf):
    return tables.page(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 4, 100, "o_orderkey")


@query(
    "page_slice_deep",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100
       OFFSET CAST((SELECT floor(0.9 * count(*) / 100) FROM orders) AS BIGINT) * 100""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    number = int(0.9 * orders.count() / 100) + 1
    return tables.page(orders, number, 100, "o_orderkey", near_limit=1000)


@query("page_clamped", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET CAST((SELECT ceil(count(*) / 100) - 1 FROM orders) AS BIGINT) * 100")
def _(spark, sf):
    return tables.page(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 10**9, 100, "o_orderkey")


_MARKDOWN = r"""'Preamble ' || doc_id || E'\n## What we found (' || lang || E')\n' || text || E'\n\n## Source \n' || source || E'\n## We recommend\nkeep ' || doc_id"""
_SQL_LINES = r"regexp_replace(x, '\r\n|[\r\x{0B}\x{0C}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]', chr(10), 'g')"
_SQL_STRIP = r"regexp_replace({0}, '^[\s\x{{0B}}\x{{85}}\x{{A0}}\x{{1C}}-\x{{1F}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+|[\s\x{{0B}}\x{{85}}\x{{A0}}\x{{1C}}-\x{{1F}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+$', '', 'g')"
SECTIONS_CTE = f"""docs AS (SELECT doc_id, {_MARKDOWN} AS x FROM documents),
parts AS (SELECT doc_id, string_split(chr(10) || {_SQL_LINES}, chr(10) || '## ')[2:] AS p FROM docs),
sections AS (SELECT doc_id, i AS position, {_SQL_STRIP.format("string_split(s, chr(10))[1]")} AS header,
    {_SQL_STRIP.format("array_to_string(string_split(s, chr(10))[2:], chr(10))")} AS body
  FROM (SELECT doc_id, unnest(p) AS s, CAST(generate_subscripts(p, 1) AS INTEGER) AS i FROM parts))"""


def markdown(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        F.concat(
            F.lit("Preamble "), "doc_id", F.lit("\n## What we found ("), "lang", F.lit(")\n"), "text", F.lit("\n\n## Source \n"),
            "source", F.lit("\n## We recommend\nkeep "), "doc_id",
        ).alias("text"),
    )


@query("markdown_sections", f"WITH {SECTIONS_CTE} SELECT * FROM sections")
def _(spark, sf):
    return tables.text_sections(markdown(spark, sf), "doc_id", "text")


@query(
    "markdown_slots",
    f"""WITH {SECTIONS_CTE}, n AS (SELECT *, contains(lower(header), 'found') AS f, contains(lower(header), 'recommend') AS r FROM sections),
        fixed AS (SELECT doc_id, min(position) FILTER (WHERE f) AS pf, min(position) FILTER (WHERE r AND NOT f) AS pr FROM n GROUP BY doc_id)
        SELECT doc_id, (SELECT body FROM n s WHERE s.doc_id = fixed.doc_id AND s.position = pf) AS executive_summary,
          (SELECT body FROM n s WHERE s.doc_id = fixed.doc_id AND s.position = (SELECT min(position) FROM n t WHERE t.doc_id = fixed.doc_id AND position NOT IN (pf, pr))) AS business_insights,
          (SELECT body FROM n s WHERE s.doc_id = fixed.doc_id AND s.position = pr) AS recommendations FROM fixed""",
)
def _(spark, sf):
    return tables.section_slots(markdown(spark, sf), "doc_id", "text")


@query("preview_rows", "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_partkey LIMIT 10")
def _(spark, sf):
    return tables.preview(table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice").orderBy("p_partkey"))[0]


# --- history ----------------------------------------------------------------------------------

# Events stand in for steps of runs: the type is the step, the value the seconds it took.
RUNS_CTE = """raw AS (SELECT *, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value >= 5 END AS ok FROM events),
runs AS (SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS step, ts AS started_at, ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS finished_at,
  CASE WHEN event_type = 'error' THEN 'failure' WHEN ok IS NULL THEN 'skipped' WHEN ok THEN 'success' ELSE 'failure' END AS status,
  'in_' || user_id || CASE WHEN event_id % 2 = 0 THEN '; ' || props ELSE '' END AS input_path,
  CASE WHEN event_type <> 'error' AND ok THEN 'out_' || event_id END AS output_path,
  CASE WHEN event_type = 'error' THEN 'raised ' || props WHEN ok IS NULL OR NOT ok THEN 'out_' || event_id END AS error_message,
  round(value, 6) AS duration_seconds FROM raw)"""


def step_events(events):
    micros = F.round(F.col("value") * 1_000_000).cast("bigint")
    return events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("event_type").alias("step"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (micros / F.lit(1000000)).cast("decimal(18,6)"))).alias("finished_at"),
        F.when(F.col("event_id") % 10 != 0, F.col("value") >= 5).alias("ok"),
        F.concat(F.lit("out_"), "event_id").alias("message"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("raised "), "props")).alias("error"),
        F.array(F.concat(F.lit("in_"), "user_id"), F.when(F.col("event_id") % 2 == 0, F.col("props"))).alias("inputs"),
    )


def runs(spark, sf):
    out = history.run_rows(step_events(table(spark, sf, "events")))
    return out.withColumn("duration_seconds", F.round("duration_seconds", 6))


@query("run_rows", f"WITH {RUNS_CTE} SELECT * FROM runs")
def _(spark, sf):
    return runs(spark, sf)


@query("recent_runs", f"WITH {RUNS_CTE} SELECT * FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 50")
def _(spark, sf):
    return history.recent_runs(runs(spark, sf))


@query(
    "run_filter",
    f"WITH {RUNS_CTE} SELECT * REPLACE (round(duration_seconds, 3) AS duration_seconds) FROM runs WHERE step IN ('click', 'view') AND status IN ('failure', 'skipped')",
)
def _(spark, sf):
    return history.filter_runs(runs(spark, sf), ["click", "view"], ["failure", "skipped"])


@query("run_log_append", f"WITH {RUNS_CTE} SELECT * FROM runs")
def _(spark, sf):
    path = new_stage_path(spark, "runs")
    rows = runs(spark, sf)
    run_files.append_runs(rows.where("step IN ('click', 'view')"), path)
    run_files.append_runs(rows.where("step NOT IN ('click', 'view')"), path)
    return run_files.read_history(spark, path, history.RUN_SCHEMA)


@query(
    "run_health",
    f"""WITH {RUNS_CTE} SELECT time_bucket(INTERVAL 1 HOUR, started_at) AS window_start, step, count(*) AS n_runs,
        count(*) FILTER (WHERE status = 'failure') AS n_failures, round(avg(duration_seconds), 9) AS avg_seconds FROM runs GROUP BY 1, 2""",
)
def _(spark, sf):
    return history.run_health(runs(spark, sf)).withColumn("avg_seconds", F.round("avg_seconds", 9))


# Experiments: which metrics a run has depends on the event type.
_METRICS = {
    "click": ["f1_macro", "roc_auc"],
    "view": ["rmse", "mae"],
    "purchase": ["r2", "adjusted_r2"],
    "signup": ["top_k_hit", "coverage"],
    "error": [],
}
EXPERIMENTS_CTE = """experiments AS (SELECT event_id, ts AS logged_at, 'data_' || user_id % 7 AS data_path, event_type AS best_model_name,
  CASE event_type WHEN 'click' THEN 'roc_auc' WHEN 'view' THEN 'rmse' WHEN 'purchase' THEN 'adjusted_r2' WHEN 'signup' THEN 'top_k_hit' END AS primary_metric_name,
  CASE event_type WHEN 'click' THEN round(value / 2, 3) WHEN 'view' THEN round(value, 3) WHEN 'purchase' THEN round(value / 2, 3) WHEN 'signup' THEN round(value, 3) END AS primary_metric_value
  FROM events)"""


def experiments(spark, sf):
    metrics = None
    empty = F.create_map().cast("map<string,double>")
    for kind, names in _METRICS.items():
        made = empty
        if names:
            first, second = F.round("value", 3), F.round(F.col("value") / 2, 3)
            made = F.create_map(F.lit(names[0]), first, F.lit(names[1]), second)
        test = F.col("event_type") == kind
        metrics = F.when(test, made) if metrics is None else metrics.when(test, made)
    return table(spark, sf, "events").select(
        "event_id",
        F.col("ts").alias("logged_at"),
        F.concat(F.lit("data_"), (F.col("user_id") % 7).cast("string")).alias("data_path"),
        F.col("event_type").alias("best_model_name"),
        metrics.alias("test_metrics"),
    )


@query(
    "experiment_json_roundtrip",
    """SELECT event_id, metric, value FROM (SELECT event_id, CASE event_type WHEN 'click' THEN 'f1_macro' WHEN 'view' THEN 'rmse' WHEN 'purchase' THEN 'r2'
         WHEN 'signup' THEN 'top_k_hit' END AS metric, round(value, 3) AS value FROM events
       UNION ALL SELECT event_id, CASE event_type WHEN 'click' THEN 'roc_auc' WHEN 'view' THEN 'mae' WHEN 'purchase' THEN 'adjusted_r2'
         WHEN 'signup' THEN 'coverage' END, round(value / 2, 3) FROM events) WHERE metric IS NOT NULL""",
)
def _(spark, sf):
    text = history.encode_maps(experiments(spark, sf), ["test_metrics"])
    return history.decode_maps(text, ["test_metrics"]).select("event_id", F.explode("test_metrics").alias("metric", "value"))


@query(
    "recent_experiments",
    """SELECT CAST(event_id AS VARCHAR) AS experiment_id, ts AS logged_at, event_type AS best_model_name,
       CASE event_type WHEN 'click' THEN round(value / 2, 3) END AS roc_auc, 'depth_' || user_id AS depth
       FROM events ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC LIMIT 50""",
)
def _(spark, sf):
    path = new_stage_path(spark, "experiments")
    made = experiments(spark, sf).join(table(spark, sf, "events").select("event_id", "user_id"), "event_id")
    rows = made.withColumn("experiment_id", F.col("event_id").cast("string")).withColumn(
        "best_hyperparameters", F.create_map(F.lit("depth"), F.concat(F.lit("depth_"), "user_id"))
    )
    rows = history.encode_maps(rows, ["test_metrics", "best_hyperparameters"])
    present = set(rows.columns)
    fields = [part.split() for part in history.EXPERIMENT_SCHEMA.split(", ")]
    rows = rows.select(*[F.col(n) if n in present else F.lit(None).cast(t).alias(n) for n, t in fields])
    run_files.append_experiments(rows, path)
    latest = history.recent_experiments(run_files.read_history(spark, path, history.EXPERIMENT_SCHEMA))
    return latest.select(
        "experiment_id",
        "logged_at",
        "best_model_name",
        F.try_element_at("test_metrics", F.lit("roc_auc")).alias("roc_auc"),
        F.try_element_at("best_hyperparameters", F.lit("depth")).alias("depth"),
    )


def headline(spark, sf):
    text = history.encode_maps(experiments(spark, sf), ["test_metrics"])
    return history.primary_metric(history.decode_maps(text, ["test_metrics"]))


@query("primary_metric", f"WITH {EXPERIMENTS_CTE} SELECT * FROM experiments")
def _(spark, sf):
    return headline(spark, sf).drop("test_metrics")


@query(
    "metric_over_time",
    f"""WITH {EXPERIMENTS_CTE}, f AS (SELECT * FROM experiments WHERE data_path IN ('data_1', 'data_2') AND best_model_name IN ('click', 'view', 'error'))
        SELECT logged_at, primary_metric_name, primary_metric_value, (SELECT count(DISTINCT primary_metric_name) FROM f) AS n_metrics
        FROM f WHERE primary_metric_value IS NOT NULL""",
)
def _(spark, sf):
    return history.metric_over_time(headline(spark, sf), ["data_1", "data_2"], ["click", "view", "error"])


@query(
    "run_captions",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 'Regression' WHEN 'click' THEN 'Classification' WHEN 'purchase' THEN 'Classification' ELSE 'Unknown' END AS task_label,
       CASE WHEN event_id % 3 <> 0 THEN
         CASE event_type WHEN 'view' THEN 'Regression' WHEN 'click' THEN 'Classification' WHEN 'purchase' THEN 'Classification' ELSE 'Unknown' END
         || ' of t' || event_id % 3 || ' (kind of task told from its values)' END AS banner,
       CASE WHEN event_type = 'click' THEN 'Probabilities come from class-weighted training: read a threshold as a cutoff, not as a chance.' ||
         CASE WHEN event_id % 2 = 0 THEN printf(' Measured calibration error (ECE): %.3f.', (event_id % 1000) / 1000) ELSE '' END END AS caveat FROM events""",
)
def _(spark, sf):
    kind, key = F.col("event_type"), F.col("event_id")
    task = F.when(kind == "view", "regression").when(kind == "click", "binary_classification").when(kind == "purchase", "multiclass_classification")
    runs_ = table(spark, sf, "events").select(
        "event_id",
        F.when(key % 3 != 0, F.concat(F.lit("t"), (key % 3).cast("string"))).alias("target_col"),
        task.alias("task_type"),
        F.when(key % 2 == 0, (key % 1000) / F.lit(1000.0)).alias("ece"),
    )
    return tables.run_captions(runs_).select("event_id", "task_label", "banner", "caveat")


@query(
    "log_parse",
    """SELECT event_id, date_trunc('millisecond', ts) AS logged_at, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
       'Step' || user_id AS logger, event_type || ' | ' || props AS message FROM events WHERE event_id % 9 <> 0""",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    level = F.rpad(F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO"), 8, " ")
    line = F.concat_ws(
        " | ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), level, F.concat(F.lit("Step"), "user_id"), F.concat_ws(" | ", "event_type", F.concat("props", F.lit("#"), "event_id"))
    )
    lines = events.select(F.when(F.col("event_id") % 9 == 0, "Traceback").otherwise(line).alias("value"))
    parsed = history.parse_log(lines)
    return parsed.withColumn("event_id", F.regexp_extract("message", r"#(\d+)$", 1).cast("bigint")).withColumn(
        "message", F.regexp_replace("message", r"#\d+$", "")
    )


@query(
    "decision_parse",
    r"""SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'retry' WHEN 1 THEN 'skip' WHEN 4 THEN 'abort' END AS action,
       CASE event_id % 5 WHEN 0 THEN 'transient: ' || props WHEN 1 THEN 'not needed' WHEN 2 THEN left('no idea ' || repeat(props, 40), 300)
         WHEN 3 THEN E'ACTION: explode\nREASON:' ELSE 'bad input' END AS reason FROM events""",
)
def _(spark, sf):
    key = F.col("event_id") % 5
    answer = (
        F.when(key == 0, F.concat(F.lit("ACTION: Retry\nREASON: transient: "), "props"))
        .when(key == 1, "Let us see\n  action: skip \n reason:  not needed")
        .when(key == 2, F.concat(F.lit("no idea "), F.repeat("props", 40)))
        .when(key == 3, " ACTION: explode\nREASON:\n")
        .otherwise("ACTION: retry\r\nACTION: ABORT\r\nREASON: first\r\nREASON: bad input")
    )
    answers = table(spark, sf, "events").select("event_id", answer.alias("answer"))
    return history.parse_decisions(answers, "answer").drop("answer")


# A run is a user's day, a step an event type, an attempt an event.
ATTEMPTS_CTE = """attempts AS (SELECT user_id || '/' || strftime(ts, '%Y-%m-%d') AS run_id, event_type AS step,
    CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END AS step_order,
    event_id AS attempt, value >= 10 AS ok, props AS message, CASE event_id % 3 WHEN 0 THEN 'skip' WHEN 1 THEN 'retry' ELSE 'abort' END AS action, value AS seconds FROM events),
last AS (SELECT run_id, step, step_order, arg_max(ok, attempt) AS ok, arg_max(message, attempt) AS message, arg_max(action, attempt) AS action,
    count(*) AS attempts, sum(seconds) AS seconds FROM attempts GROUP BY 1, 2, 3),
outcomes AS (SELECT run_id, step, step_order, CASE WHEN ok AND attempts = 1 THEN 'success' WHEN ok THEN 'success_after_retry' WHEN attempts > 1 THEN 'failed'
    WHEN action = 'skip' THEN 'skipped' ELSE 'failed' END AS status, attempts, message, round(seconds, 4) AS seconds FROM last)"""


def attempts(spark, sf):
    kind = F.col("event_type")
    place = F.when(kind == "signup", 1).when(kind == "view", 2).when(kind == "click", 3).when(kind == "purchase", 4).otherwise(5)
    return table(spark, sf, "events").select(
        F.concat_ws("/", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("run_id"),
        kind.alias("step"),
        place.alias("step_order"),
        F.col("event_id").alias("attempt"),
        (F.col("value") >= 10).alias("ok"),
        F.col("props").alias("message"),
        F.when(F.col("event_id") % 3 == 0, "skip").when(F.col("event_id") % 3 == 1, "retry").otherwise("abort").alias("action"),
        F.col("value").alias("seconds"),
    )


@query("step_outcomes", f"WITH {ATTEMPTS_CTE} SELECT * FROM outcomes")
def _(spark, sf):
    return history.step_outcomes(attempts(spark, sf)).withColumn("seconds", F.round("seconds", 4))


@query(
    "run_outcomes",
    f"""WITH {ATTEMPTS_CTE} SELECT run_id, count(*) AS n_steps, bool_or(status = 'failed') AS aborted,
        'ended by step ' || arg_min(step, step_order) FILTER (WHERE status = 'failed') || coalesce(': ' || arg_min(message, step_order) FILTER (WHERE status = 'failed'), '') AS abort_reason,
        round(sum(seconds), 4) AS total_seconds FROM outcomes GROUP BY run_id""",
)
def _(spark, sf):
    steps = history.step_outcomes(attempts(spark, sf)).withColumn("seconds", F.round("seconds", 4))
    return history.run_outcomes(steps).withColumn("total_seconds", F.round("total_seconds", 4))


@query(
    "missing_upstream",
    f"""WITH {ATTEMPTS_CTE}, p AS (SELECT run_id, bool_or(step = 'view' AND status LIKE 'success%') AS v, bool_or(step = 'click' AND status LIKE 'success%') AS c
          FROM outcomes WHERE step IN ('view', 'click') GROUP BY run_id)
        SELECT run_id, 'not run for want of results of: ' || CASE WHEN v THEN 'click' WHEN c THEN 'view' ELSE 'view, click' END AS reason FROM p WHERE NOT (v AND c)""",
)
def _(spark, sf):
    return history.missing_upstream(history.step_outcomes(attempts(spark, sf)), ["view", "click"])


# --- sources and sinks --------------------------------------------------------------------------


@query(
    "run_id_sanitize",
    r"""WITH n AS (SELECT page_id, regexp_replace(regexp_replace(lower(regexp_replace(regexp_extract(url, '[^/]*$'), '^(\.*[^.].*)\.[^.]*$', '\1')),
         '[^a-z0-9_-]+', '_', 'g'), '^_+|_+$', '', 'g') AS x FROM pages)
       SELECT page_id, CASE WHEN x = '' THEN 'run_20240102_030405' ELSE x END AS run_id FROM n""",
)
def _(spark, sf):
    now = F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")
    return table(spark, sf, "pages").select("page_id", run_files.run_name(F.col("url"), now).alias("run_id"))


@query("csv_roundtrip", "SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority, o_orderkey % 2 = 0 AS even FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.when(F.col("o_orderkey") % 5 == 0, "N/A").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        (F.col("o_orderkey") % 2 == 0).alias("even"),
    )
    path = write_table(orders, derived_path(new_stage_path(spark, "orders") + ".csv", "cleaned"), "csv")
    return read_csv(spark, path)


@query(
    "csv_text_roundtrip",
    r"""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '  "' || text || '",' || chr(10) || ' a\b ' WHEN 1 THEN text
         WHEN 2 THEN 'two' || chr(10) || chr(10) || 'lines, ""' || lang || '""' END AS text, n_chars FROM documents""",
)
def _(spark, sf):
    key, text = F.col("doc_id"), F.col("text")
    odd = F.when(key % 4 == 0, F.concat(F.lit('  "'), text, F.lit('",\n a\\b '))).when(key % 4 == 1, text)
    odd = odd.when(key % 4 == 2, F.concat(F.lit('two\n\nlines, ""'), F.col("lang"), F.lit('""'))).otherwise("NA")
    path = write_table(table(spark, sf, "documents").select("doc_id", odd.alias("text"), "n_chars"), new_stage_path(spark, "texts") + ".csv", "csv")
    return read_csv(spark, path, "doc_id bigint, text string, n_chars bigint")


@query(
    "multi_table_load",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ["orders", "customer", "lineitem", "part", "supplier", "nation", "region", "events"]),
)
def _(spark, sf):
    frames = read_tables(spark, sf, ["orders", "customer", "lineitem", "part", "supplier", "nation", "region", "events"])
    out = None
    for name, frame in frames.items():
        row = frame.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


@query("partitioned_write", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    path = write_table(events, new_stage_path(spark, "events"), partition_by=["event_type"])
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query(
    "report_roundtrip",
    """SELECT event_type AS item, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY event_type
       UNION ALL SELECT 'warning: missing: no path given', NULL, NULL""",
)
def _(spark, sf):
    report = table(spark, sf, "events").groupBy(F.col("event_type").alias("item")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean")
    )
    schema = "item string, n long, mean double"
    path = run_files.write_report(report, new_stage_path(spark, "reports"), "events")
    rows, _ = run_files.read_report(spark, path, "events", schema)
    none, warning = run_files.read_report(spark, " ", "missing", schema)
    return rows.unionByName(none).unionByName(spark.createDataFrame([(f"warning: {warning}", None, None)], schema))
