from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flatspan.operators import charts, evaluate, facts, history, tables
from flatspan.operators.clean import CleaningReport
from flatspan.session import new_stage_path
from flatspan.sources import runs as run_files
from flatspan.sources.tables import derived_path, read_csv, write_table
from tests.conftest import column, rows


def test_filters(spark):
    df = spark.createDataFrame([("AB-1", True, 5.0), ("ab-2", False, 10.0), ("x.y", False, 15.0)], "row_id string, correct boolean, abs_error double")
    assert column(tables.incorrect_only(df), "row_id") == ["ab-2", "x.y"]
    assert tables.incorrect_only(df.drop("correct")).count() == 3
    assert column(tables.large_errors(df, 10), "row_id") == ["ab-2", "x.y"]
    assert tables.large_errors(df.drop("abs_error"), 10).count() == 3
    assert column(tables.search_rows(df, " Ab- "), "row_id") == ["AB-1", "ab-2"]
    assert column(tables.search_rows(df, "."), "row_id") == ["x.y"]
    assert tables.search_rows(df, "  ").count() == 3


@pytest.mark.parametrize("near", [100_000, 0])
@pytest.mark.parametrize("page, first", [(1, 0), (3, 20), (99, 90), (-4, 0)])
def test_pages(spark, near, page, first):
    df = spark.range(95).repartition(3)
    assert column(tables.page(df, page, 10, "id", near_limit=near), "id") == list(range(first, min(first + 10, 95)))


@pytest.mark.parametrize("key", ["id + bigint(1152921504606846976)", "lpad(id, 5, '0')", "id div 3", "if(id < 30, null, id)", "double(id) / 7"])
def test_far_pages_of_any_key(spark, key):
    df = spark.range(200).selectExpr(f"{key} AS k").repartition(3)
    want = [r["k"] for r in df.orderBy("k").collect()][110:120]
    assert column(tables.page(df, 12, 10, "k", near_limit=12), "k") == want


def test_page_of_nothing(spark):
    assert tables.page(spark.range(0), 2, 10, "id").count() == 0


def test_diagnostics(spark):
    report = CleaningReport((1200, 3), (1000, 2), 200, {"a": 5, "b": 1500}, ["x"], [], ["x"], ["a", "b"], ["z"])
    out = {(r["step"], r["effect"], r["column_name"]): r["n"] for r in tables.diagnostics_rows(spark, report).collect()}
    assert out["shape", "input rows", None] == 1200 and out["rows", "duplicates removed", None] == 200
    assert out["values", "placeholders", "b"] == 1500 and out["columns", "dropped: low variance", "z"] == 1
    assert not any(effect == "flagged: high missing" for _, effect, _ in out) and len(out) == 12


def test_sections(spark):
    texts = [
        (1, "intro\n## What We Found\nbody one\n\n## Why It Matters\r\nbody two\n## We Recommend\n"),
        (2, "## First\nx\n## Second\ny\n## Third\nz"),
        (3, "## Other\nx\n## We found\ny"),
        (4, "no headers at all\n ## not one"),
    ]
    df = spark.createDataFrame(texts, "id int, text string")
    assert rows(tables.text_sections(df.where("id = 1"), "id", "text")) == [
        (1, 1, "What We Found", "body one"), (1, 2, "Why It Matters", "body two"), (1, 3, "We Recommend", ""),
    ]
    assert tables.text_sections(df.where("id = 4"), "id", "text").count() == 0
    assert rows(tables.section_slots(df, "id", "text")) == [
        (1, "body one", "body two", ""), (2, "x", "y", "z"), (3, "y", "x", None), (4, None, None, None),
    ]


def test_captions(spark):
    df = spark.createDataFrame([("late", "binary_classification", 0.3061), ("late", "binary_classification", None), ("price", "regression", None), (None, "odd", None)], "target_col string, task_type string, ece double")
    out = tables.run_captions(df).collect()
    assert out[0]["caveat"].endswith("(ECE): 0.306.") and not out[1]["caveat"].endswith("0.306.")
    assert [r["task_label"] for r in out] == ["Classification", "Classification", "Regression", "Unknown"]
    assert out[2]["caveat"] is None and out[3]["banner"] is None


def test_facts_do_not_mix_tasks(spark):
    metrics = spark.createDataFrame([(1.5, 0.5)], "rmse double, r2 double")
    importances = spark.createDataFrame([("a", 0.2, 0.01, True)], "feature string, importance_mean double, importance_std double, distinguishable_from_zero boolean")
    frame = spark.range(100).selectExpr("IF(id < 50, 'l', 'h') AS zone", "10.0D AS actual", "IF(id < 50, 10.0D, 1.0D) AS predicted")
    out = facts.model_facts(metrics, importances, evaluate.segment_errors_regression(frame, ["zone"]))
    assert {r["item"] for r in out.collect()} == {"rmse", "r2", "a", "zone=h"}


def test_confusion_words_and_cells(spark):
    confusion = evaluate.confusion_matrix(spark.createDataFrame([(1, 1)] * 3 + [(1, 0)] + [(0, 0)] * 2, "actual int, predicted int"))
    out = {r["cell"]: r["n"] for r in facts.confusion_words(confusion, "order", "late", "on time").collect()}
    assert out == {"true_positive": 3, "false_negative": 1, "false_positive": 0, "true_negative": 2}
    assert ("Late (1)", "On time (0)", 1) in rows(charts.confusion_cells(confusion, "Late", "On time"))
    three = evaluate.confusion_matrix(spark.createDataFrame([("a", "b"), ("c", "c")], "actual string, predicted string"))
    assert ("a", "b", 1) in rows(charts.confusion_cells(three))


def test_run_rows(spark):
    start = datetime(2024, 1, 1)
    schema = "run_id string, step string, started_at timestamp_ntz, finished_at timestamp_ntz, ok boolean, message string, error string, inputs array<string>"
    df = spark.createDataFrame(
        [
            ("1", "a", start, start + timedelta(seconds=1.5), True, "out", None, ["x", None, "y"]),
            ("2", "b", start, start, False, "bad", None, [None]),
            ("3", "c", start, start, None, "not run", None, []),
            ("4", "d", start, start, None, None, "boom", ["x"]),
        ],
        schema,
    )
    out = {r["run_id"]: r for r in history.run_rows(df).collect()}
    assert (out["1"]["status"], out["1"]["input_path"], out["1"]["output_path"], out["1"]["duration_seconds"]) == ("success", "x; y", "out", 1.5)
    assert (out["2"]["status"], out["2"]["input_path"], out["2"]["output_path"], out["2"]["error_message"]) == ("failure", None, None, "bad")
    assert (out["3"]["status"], out["3"]["error_message"]) == ("skipped", "not run")
    assert (out["4"]["status"], out["4"]["error_message"]) == ("failure", "boom")


def test_history_appends(spark):
    path = new_stage_path(spark, "history")
    assert run_files.read_history(spark, path, history.RUN_SCHEMA).count() == 0
    rows_ = spark.createDataFrame([("1", "a", datetime(2024, 1, 1), datetime(2024, 1, 1), "success", None, None, None, 0.0)], history.RUN_SCHEMA)
    run_files.append_runs(rows_, path)
    run_files.append_runs(rows_.withColumn("run_id", F.lit("2")).withColumn("started_at", F.lit("2024-02-01").cast("timestamp_ntz")), path)
    assert [r["run_id"] for r in history.recent_runs(run_files.read_history(spark, path, history.RUN_SCHEMA), 1).collect()] == ["2"]


def test_primary_metric(spark):
    df = spark.createDataFrame([({"mae": 1.0, "rmse": 2.0},), ({"zeta": 3.00004, "alpha": 1.0},), ({},)], "test_metrics map<string,double>")
    out = [(r["primary_metric_name"], r["primary_metric_value"]) for r in history.primary_metric(history.decode_maps(history.encode_maps(df, ["test_metrics"]), ["test_metrics"])).collect()]
    assert out[0] == ("rmse", 2.0) and out[1][0] in ("zeta", "alpha") and out[2] == (None, None)


def test_log_and_decisions(spark):
    lines = spark.createDataFrame([("2024-01-01 10:00:00,123 | INFO     | Clean | a | b",), ("junk",)], "value string")
    assert rows(history.parse_log(lines)) == [(datetime(2024, 1, 1, 10, 0, 0, 123000), "INFO", "Clean", "a | b")]
    answers = spark.createDataFrame([("ACTION: Skip\nREASON: fine",), ("action: explode\nhm",), ("x" * 400,)], "t string")
    out = history.parse_decisions(answers, "t").collect()
    assert [(r["action"], len(r["reason"])) for r in out] == [("skip", 4), (None, 18), (None, 300)]


def test_step_outcomes(spark):
    data = [
        ("r1", "clean", 1, 1, True, "ok", None, 1.0),
        ("r1", "train", 2, 1, False, "bad", "retry", 1.0), ("r1", "train", 2, 2, True, "ok", None, 1.0),
        ("r2", "clean", 1, 1, False, "no file", "abort", 1.0),
        ("r3", "clean", 1, 1, False, "odd", "skip", 1.0), ("r3", "train", 2, 1, False, "a", "retry", 1.0), ("r3", "train", 2, 2, False, "b", "skip", 2.0),
    ]
    df = spark.createDataFrame(data, "run_id string, step string, step_order int, attempt int, ok boolean, message string, action string, seconds double")
    out = history.step_outcomes(df)
    assert rows(out, "run_id", "step", "status", "attempts") == [
        ("r1", "clean", "success", 1), ("r1", "train", "success_after_retry", 2), ("r2", "clean", "failed", 1),
        ("r3", "clean", "skipped", 1), ("r3", "train", "failed", 2),
    ]
    ends = {r["run_id"]: (r["aborted"], r["abort_reason"], r["total_seconds"]) for r in history.run_outcomes(out).collect()}
    assert ends == {"r1": (False, None, 3.0), "r2": (True, "ended by step clean: no file", 1.0), "r3": (True, "ended by step train: b", 4.0)}
    reasons = {r["run_id"]: r["reason"] for r in history.missing_upstream(out, ["clean", "train"]).collect()}
    assert set(reasons) == {"r2", "r3"} and reasons["r3"].endswith(": clean, train")


@pytest.mark.parametrize(
    "path, name",
    [("/a/My Data (v2).csv", "my_data_v2"), ("plain", "plain"), ("a.b.csv", "a_b"), ("/x/.hidden", "hidden"), ("/x/###.csv", "run_20240102_030405"), ("UP-er_1.CSV", "up-er_1")],
)
def test_run_name(spark, path, name):
    df = spark.createDataFrame([(path, datetime(2024, 1, 2, 3, 4, 5))], "p string, t timestamp_ntz")
    assert df.select(run_files.run_name(F.col("p"), F.col("t"))).first()[0] == name


def test_csv_and_reports(spark):
    df = spark.createDataFrame([(1, 2.5, "a", True, None), (2, None, "NA", False, "x, \"y\""), (3, 4.0, "None", True, "z")], "i int, d double, s string, b boolean, t string")
    path = write_table(df, derived_path(new_stage_path(spark, "t") + ".csv", "cleaned"), "csv")
    assert path.endswith("_cleaned.csv")
    back = read_csv(spark, path)
    assert dict(back.dtypes) == {"i": "bigint", "d": "double", "s": "string", "b": "boolean", "t": "string"}
    assert rows(back) == [(1, 2.5, "a", True, None), (2, None, None, False, 'x, "y"'), (3, 4.0, None, True, "z")]
    missing, warning = run_files.read_report(spark, "/nowhere/at/all", "profile", "a int")
    assert missing.count() == 0 and "profile" in warning
    assert run_files.read_report(spark, None, "profile", "a int")[1] == "profile: no path given"


def test_chart_catalogue(spark):
    out = charts.chart_catalogue({"a": spark.range(3), "b": "no data", "c": spark.range(0)})
    assert rows(out) == [("a", 3, None), ("b", 0, "no data"), ("c", 0, "no rows")]


def test_csv_keeps_quotes_line_breaks_and_blanks(spark, tmp_path):
    from flatspan.sources.tables import read_csv, write_table

    texts = ['a "quoted" word, here', "  pad ", "x\ny", 'end"', "back\\slash", None, "NA", "5"]
    df = spark.createDataFrame([(i, t, float(i)) for i, t in enumerate(texts)], "id long, text string, v double")
    path = write_table(df, str(tmp_path / "t.csv"), "csv")
    want = [(i, None if t == "NA" else t) for i, t in enumerate(texts)]
    for schema in (None, "id bigint, text string, v double"):
        assert sorted((r["id"], r["text"]) for r in read_csv(spark, path, schema).collect()) == want
    other = tmp_path / "other.csv"
    other.write_text('id,text,v\n1,"a ""quoted"" word, here",5\n2,NA,n/a\n3,"two\nlines",x\n')
    got = sorted(tuple(r) for r in read_csv(spark, str(other), "id bigint, text string, v double").collect())
    assert got == [(1, 'a "quoted" word, here', 5.0), (2, None, None), (3, "two\nlines", None)]


def test_recent_history_reads_recent_days_only(spark, tmp_path):
    from flatspan.sources import runs as files

    path = str(tmp_path / "runs")
    assert files.read_recent(spark, path, history.RUN_SCHEMA, 5).count() == 0
    rows_ = spark.range(60).selectExpr(
        "string(id) AS run_id", "'clean' AS step", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, int(id div 10)) AS started_at",
        "cast(NULL AS timestamp_ntz) AS finished_at", "'success' AS status", "'' AS input_path", "'' AS output_path", "'' AS error_message", "0D AS duration_seconds",
    )
    files.append_runs(rows_, path)
    recent = files.read_recent(spark, path, history.RUN_SCHEMA, 15)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert recent.count() == 20 and "PartitionFilters: [isnotnull(day" in plan
    assert files.read_recent(spark, path, history.RUN_SCHEMA, 999).count() == 60


def test_appends_count_once(spark):
    from concurrent.futures import ThreadPoolExecutor

    path, schema = new_stage_path(spark, "commits"), history.RUN_SCHEMA
    names = [c.split()[0] for c in schema.split(", ")]
    many = spark.range(6).select(*[(F.col("id").cast("string") if n == "run_id" else F.lit(None)).cast(t).alias(n) for n, t in (c.split(" ", 1) for c in schema.split(", "))])
    one, two = many.where("run_id < 3"), many.where("run_id >= 3")
    with ThreadPoolExecutor(4) as pool:  # parallel writers, two of them with the same rows
        list(pool.map(lambda rows_: run_files.append_runs(rows_, path), [one, two, one.orderBy(F.desc("run_id")), two]))
    run_files.append_runs(one, path)  # a retry
    one.write.partitionBy("run_id").parquet(f"{path}/attempt=broken")  # an attempt without its commit
    assert sorted(r["run_id"] for r in run_files.read_history(spark, path, schema).collect()) == [str(i) for i in range(6)]
    assert len(run_files.attempts(spark, path)) == 2 and run_files.append_name(one) != run_files.append_name(two) and len(names) > 3
