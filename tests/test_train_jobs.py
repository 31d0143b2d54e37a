from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from flatspan.functions.seeded import hash_unit
from flatspan.operators import clean, evaluate, features, split, train
from flatspan.operators.models import FittedModel
from flatspan.plans.pipeline import STEPS, run_pipeline
from flatspan.session import new_stage_path
from flatspan.streaming import stream
from tests.conftest import rows

TINY = train.Config(
    folds=2,
    grids={"logistic_regression": {"C": [1], "max_iter": [10]}, "random_forest": {"trees": [3], "depth": [3]}, "linear_regression": {}},
    importance_repeats=3,
    nested=False,
)


def noise(name):
    return hash_unit(F.concat(F.lit(name), F.col("id")))


@pytest.fixture(scope="module")
def frame(spark):
    """Label and price follow x and y; z says nothing; grp holds some rows of each."""
    base = spark.range(400).select("id", (F.col("id") % 60).alias("grp"), noise("x").alias("x"), noise("y").alias("y"), noise("z").alias("z"))
    return base.select(
        F.concat(F.lit("r"), "id").alias("row"), "grp", "x", "y", "z",
        (F.col("x") + F.col("y") > 1).cast("int").alias("label"), (F.col("x") * 10 + F.col("y")).alias("price"),
    ).persist()


@pytest.fixture(scope="module")
def binary(frame):
    return train.train(frame.drop("price"), "label", "row", "grp", TINY)


def test_binary_run(binary):
    assert binary.task == split.BINARY and binary.prepared.strategy == "grouped"
    assert binary.metrics["roc_auc"] > 0.9 and binary.metrics["f1_macro"] > 0.8
    assert binary.board.where("is_best").first()["model"] == binary.best
    assert binary.fold_scores.count() == 4
    top = binary.importances.collect()
    assert {r["feature"] for r in top} == {"x", "y", "z"} and min(top, key=lambda r: r["importance_mean"])["feature"] == "z"
    table = evaluate.predictions_table_classification(binary.scored, "row")
    assert table.where("confidence < 0.5 OR confidence > 1").count() == 0
    assert table.count() == binary.prepared.test.count()


def test_calibration(binary):
    for method in ("sigmoid", "isotonic"):
        out = {r["series"]: r for r in train.calibration_comparison(binary, replace(TINY, calibration=method), limit=-1.0).collect()}
        assert out["calibrated"]["method"] == method and 0 <= out["calibrated"]["brier_score"] <= 1
    assert [r["series"] for r in train.calibration_comparison(binary, TINY, limit=1.0).collect()] == ["raw"]
    isotonic = train.calibrated_scores(binary.prepared, binary.best, binary.params, TINY, "isotonic")
    assert isotonic.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert isotonic.count() == binary.prepared.test.count()


def test_regression_run_and_saved_model(spark, frame):
    path = new_stage_path(spark, "model")
    r = train.train(frame.drop("label"), "price", "row", None, train.Config(**{**TINY.__dict__, "grids": {"linear_regression": {}}}), path)
    assert r.best == "linear_regression" and r.metrics["r2"] > 0.999 and r.nested is None
    again = FittedModel.load(path).transform(r.prepared.test)
    assert rows(again, "row", "prediction") == rows(r.scored, "row", "prediction")
    assert train.nested_cv(r.prepared, "linear_regression", TINY) is None


def test_multiclass_with_gaps(frame):
    three = frame.drop("price", "label").withColumn("kind", F.when(F.col("x") < 0.3, "a").when(F.col("x") < 0.6, "b").otherwise("c"))
    holes = three.withColumn("y", F.when(F.col("y") > 0.2, F.col("y")))
    r = train.train(holes, "kind", "row", config=TINY)
    assert r.task == split.MULTICLASS and r.prepared.labels == ["a", "b", "c"] and "roc_auc" not in r.metrics
    assert r.prepared.strategy == "row_random" and r.metrics["f1_macro"] > 0.7
    assert set(x[0] for x in r.scored.select("predicted").distinct().collect()) <= {"a", "b", "c"}


def test_robustness(spark):
    models = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "seed int, model string")
    assert rows(train.model_agreement(models)) == [("a", 2, True, False), ("b", 1, False, False)]
    metrics = spark.createDataFrame([(1, "f1", 0.5), (2, "f1", 0.7)], "seed int, metric string, value double")
    assert rows(train.metric_stability(metrics)) == [("f1", 0.6, 0.1, 0.5, 0.7)]
    feats = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "x"), (2, 2, "z"), (2, 3, "y")], "seed int, place int, feature string")
    assert rows(train.feature_stability(feats, 2)) == [("x", 2, True), ("y", 1, False), ("z", 1, False)]


def test_failed_seed_is_listed(frame):
    out = train.run_seeds(frame, "no such column", "row", None, (1, 2), TINY)
    assert out.failed.count() == 2 and out.models.count() == 0


def test_figures_need_every_seed(frame, monkeypatch):
    """A seed without a result is named and the others keep theirs, but no summary is given over fewer seeds; a failed job is no failed seed."""
    result = lambda p: SimpleNamespace(prepared=p, best="a", metrics={"f1": 0.5}, importances=frame.sparkSession.createDataFrame([("x", 1.0)], "feature string, importance_mean double"))

    def fails(some, _):
        if any(p.seed == 2 for p in some):
            raise ValueError("too few rows\nmore")
        return [result(p) for p in some]

    monkeypatch.setattr(train, "train_prepared", fails)
    out = train.run_seeds(frame.drop("price"), "label", "row", None, (1, 2, 3), TINY)
    assert rows(out.failed) == [(2, "too few rows")] and rows(out.models) == [(1, "a"), (3, "a")]
    for name in ("metrics", "features"):
        with pytest.raises(RuntimeError, match="seed 2: too few rows"):
            getattr(out, name)
    whole = train.run_seeds(frame.drop("price"), "label", "row", None, (1, 3), TINY)
    assert rows(whole.metrics) == [(1, "f1", 0.5), (3, "f1", 0.5)] and rows(whole.features) == [(1, 1, "x"), (3, 1, "x")] and whole.failed.isEmpty()

    def lost(some, _):
        raise RuntimeError("job cancelled")

    monkeypatch.setattr(train, "train_prepared", lost)
    with pytest.raises(RuntimeError, match="job cancelled"):
        train.run_seeds(frame.drop("price"), "label", "row", None, (1,), TINY)
    with pytest.raises(ValueError):
        train.run_seeds(frame.drop("price"), "label", "row", None, (), TINY)


def test_pipeline(spark, frame):
    folder = new_stage_path(spark, "job")
    df = frame.drop("price").withColumn("city", F.concat(F.lit("c"), (F.col("grp") % 25).cast("string")))
    done = run_pipeline(df, "label", folder, "first", "row", "grp", TINY, "in.csv")
    assert not done.aborted, done.abort_reason
    assert rows(done.runs, "step", "status") == sorted((s, "success") for s in STEPS)
    made = spark.read.parquet(done.outputs["features"])
    assert rows(made, "row", "label", "grp") == rows(df, "row", "label", "grp")
    assert spark.read.json(done.outputs["facts"]).count() > 4
    bad = run_pipeline(df, "absent", folder, "second", "row", None, TINY, "in.csv")
    assert bad.aborted and "'train'" in bad.abort_reason
    status = {r["step"]: r["status"] for r in bad.runs.collect()}
    assert status["features"] == "success" and status["train"] == "failure" and status["report"] == "skipped"


def test_stream_equals_batch(spark):
    folder = new_stage_path(spark, "in")
    df = spark.range(200).selectExpr("id", "IF(id % 5 = 0, 'N/A', concat('k', id % 3)) AS kind", "IF(id % 7 = 0, NULL, double(id)) AS value")
    df.repartition(3).write.parquet(folder)
    _, model, _ = clean.clean(df)
    cleaned = stream.drain(stream.clean_stream(stream.read_folder(spark, folder, df.schema), model), "cleaned")
    assert rows(cleaned) == rows(clean.apply_cleaning(df, model))
    fitted = features.fit_features(cleaned, protected=["id"], ohe_threshold=2)
    source = stream.read_folder(spark, folder, df.schema)
    out = stream.drain(stream.feature_stream(stream.clean_stream(source, model), fitted), "features")
    assert rows(out) == rows(features.apply_features(cleaned, fitted))


def test_stream_duplicates(spark):
    folder = new_stage_path(spark, "dup")
    df = spark.range(100).selectExpr("id % 10 AS k", "timestamp_seconds(id) AS at")
    df.write.parquet(folder)
    out = stream.drain(stream.drop_late_duplicates(stream.read_folder(spark, folder, df.schema), ["k"], "at", "1 hour"), "unique")
    assert sorted(r["k"] for r in out.collect()) == list(range(10))


def test_rows_without_an_id(spark):
    df = spark.range(60).selectExpr("double(id % 7) AS x", "double(id) AS z", "int(id % 2) AS y")
    p = train.prepare(df, "y", "nothing")
    assert p.features == ["x", "z"] and p.train.count() + p.test.count() == 60


def test_placed_rows(spark):
    from flatspan.functions.seeded import placed_rows

    out = placed_rows(spark.range(500).repartition(7), "id", 3).collect()
    assert sorted(r["at"] for r in out) == list(range(500)) and [r["id"] for r in sorted(out, key=lambda r: r["at"])] != list(range(500))
    assert placed_rows(spark.range(0), "id").count() == 0


def test_registered_searches_are_the_full_ones(spark, monkeypatch):
    from types import SimpleNamespace

    from flatspan.plans import base, catalog, marts, q_jobs, q_train  # noqa: F401

    seen = {}
    frame = spark.createDataFrame([(1, [0.0] * 64, 0)], "vec_id long, embedding array<double>, label int")
    done = SimpleNamespace(prepared=None, best="random_forest", metrics=frame)
    monkeypatch.setattr(q_train, "training_frame", lambda *_: frame)
    monkeypatch.setattr(q_train, "table", lambda *_: frame)
    monkeypatch.setattr(q_train, "_results", {})
    monkeypatch.setattr(train, "train", lambda df, target, *a, **k: seen.setdefault(target, next(x for x in (*a, *k.values()) if isinstance(x, train.Config))) and done)
    monkeypatch.setattr(train, "nested_cv", lambda p, name, config, outer=train.OUTER_FOLDS: seen.update(nested=config, outer=outer))
    monkeypatch.setattr(train, "run_seeds", lambda *a, seeds=train.SEEDS, config=None: seen.update(seeds=seeds, robustness=config) or done)
    monkeypatch.setattr(train, "metric_stability", lambda x: x)
    for kind in ("binary", "regression", "multiclass"):
        q_train.result(spark, "", kind)
    base.QUERIES["nested_cv"](spark, "")
    base.QUERIES["robustness_run"](spark, "")
    assert (seen.pop("outer"), seen.pop("seeds")) == (train.OUTER_FOLDS, train.SEEDS)
    assert set(seen) == {"is_late", "total_price", "label", "nested", "robustness"}
    assert all(c == train.Config() for c in (*seen.values(), q_jobs.CONFIG))
