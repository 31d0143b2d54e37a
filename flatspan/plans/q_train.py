"""Queries that train models, and the stability summaries.

The searches are the library's full ones (``train.Config``), so a query takes hours on one machine.  Search
results have no SQL twin; models with a closed answer have one, and the stability summaries are also run over rules, which have one too.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flatspan.operators import evaluate, features, profile, split, train
from flatspan.plans import marts
from flatspan.plans.base import kept, query, table
from flatspan.plans.marts import SCORED_CTE
from flatspan.plans.q_features import PROTECTED, feature_input
from flatspan.plans.q_split import RULES

CONFIG = train.Config()


def training_frame(spark, sf):
    return kept(spark, sf, "training_frame", engineered)


def engineered(spark, sf):
    """Orders with the purchase day, after the feature step; key, customer and label protected."""
    day = marts.order_mart(spark, sf).select("o_orderkey", F.datediff("o_orderdate", F.lit("1992-01-01").cast("date")).alias("purchase_day"))
    df = feature_input(spark, sf).join(day, "o_orderkey")
    return features.apply_features(df, features.fit_features(df, protected=PROTECTED))


_results: dict[tuple[str, str, str], train.Result] = {}


def forget() -> None:
    """Let go of all trained models."""
    for r in _results.values():
        r.prepared.release()
    _results.clear()


def result(spark, sf, kind: str = "binary") -> train.Result:
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _results:
        if kind == "binary":
            _results[key] = train.train(training_frame(spark, sf), "is_late", "o_orderkey", "o_custkey", CONFIG)
        elif kind == "regression":
            frame = training_frame(spark, sf).drop("is_late", "total_freight")
            _results[key] = train.train(frame, "total_price", "o_orderkey", config=CONFIG)
        else:
            vectors = table(spark, sf, "embeddings").select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(64)])
            _results[key] = train.train(vectors, "label", "vec_id", config=CONFIG)
    return _results[key]


def _metric_rows(spark, r):
    rows = [(r.task, r.best, k, float(v)) for k, v in sorted(r.metrics.items())]
    return spark.createDataFrame(rows, "task_type string, model string, metric string, value double")


@query("train_leaderboard")
def _(spark, sf):
    return result(spark, sf).board


@query("train_metrics_binary")
def _(spark, sf):
    return _metric_rows(spark, result(spark, sf))


@query("train_metrics_multiclass")
def _(spark, sf):
    return _metric_rows(spark, result(spark, sf, "multiclass"))


@query("train_metrics_regression")
def _(spark, sf):
    return _metric_rows(spark, result(spark, sf, "regression"))


@query("train_predictions")
def _(spark, sf):
    return evaluate.predictions_table_classification(result(spark, sf).scored, "o_orderkey")


@query("train_thresholds")
def _(spark, sf):
    return evaluate.threshold_sweep(result(spark, sf).scored, "label", "score")


@query("permutation_importance")
def _(spark, sf):
    return result(spark, sf).importances


@query("nested_cv")
def _(spark, sf):
    r = result(spark, sf)
    score, std = train.nested_cv(r.prepared, r.best, CONFIG) or (None, None)
    return spark.createDataFrame([(r.best, score, std)], "model string, nested_cv_score double, nested_cv_std double")


@query("calibrated_compare")
def _(spark, sf):
    return train.calibration_comparison(result(spark, sf), CONFIG)


@query("train_segment_errors")
def _(spark, sf):
    r = result(spark, sf)
    names = [x["column_name"] for x in evaluate.segment_columns(r.prepared.test, r.features).collect()]
    return evaluate.segment_errors_binary(r.scored, names, "label", "prediction")


@query("robustness_run")
def _(spark, sf):
    runs = train.run_seeds(training_frame(spark, sf), "is_late", "o_orderkey", "o_custkey", config=CONFIG)
    return train.metric_stability(runs.metrics)


# --- models whose answer has a closed form, so that SQL can give it ---------------------------------


def urgent_orders(spark, sf):
    """Orders with one 0/1 feature, an amount and a 0/1 label."""
    x = F.col("o_orderpriority").startswith("1").cast("double")
    late = (F.pmod(F.col("o_orderkey"), F.when(x == 1, 3).otherwise(5)) == 0).cast("double")
    frame = table(spark, sf, "orders").select("o_orderkey", x.alias("x"), F.col("o_totalprice").alias("amount"), late.alias("late"))
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(frame).withColumn("weight", F.lit(1.0))


def prepared(frame, task: str, labels: list) -> train.Prepared:
    return train.Prepared(frame, ["x"], task, labels, "o_orderkey", "row_random")


def fitted(spark, sf, name: str, params: dict, task: str, target: str, labels: list):
    frame = urgent_orders(spark, sf).withColumn("label", F.col(target))
    model = train.fit_on(prepared(frame, task, labels), name, params, frame, train.SEED)
    return model.transform(frame)


URGENT_CTE = """u AS (SELECT (o_orderpriority LIKE '1%')::DOUBLE AS x, o_totalprice AS amount,
  (o_orderkey % CASE WHEN o_orderpriority LIKE '1%' THEN 3 ELSE 5 END = 0)::DOUBLE AS late FROM orders)"""
MEANS_SQL = f"WITH {URGENT_CTE} SELECT x, count(*) AS n, round(avg(amount), 3) AS prediction FROM u GROUP BY x"


@query(
    "train_linear_closed_form",
    "SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("label"), F.lit(1.0).alias("weight"))
    frame = VectorAssembler(inputCols=["x"], outputCol="features").transform(lines)
    model = train.fit_on(prepared(frame, split.REGRESSION, []), "linear_regression", {}, frame, train.SEED)
    line = [(float(model.coefficients[0]), float(model.intercept))]
    return spark.createDataFrame(line, "slope double, intercept double").select(F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"))


@query(
    "train_logistic_shares",
    f"""WITH {URGENT_CTE}, w AS (SELECT late, (SELECT count(*) FROM u) / (2.0::DOUBLE * count(*)) AS weight FROM u GROUP BY late)
        SELECT x, count(*) AS n, round(sum(weight * late) / sum(weight), 3) AS score FROM u JOIN w USING (late) GROUP BY x""",
)
def _(spark, sf):
    out = fitted(spark, sf, "logistic_regression", {"C": 1e12}, split.BINARY, "late", [0, 1])
    score = F.round(F.avg(vector_to_array("probability")[1]), 3).alias("score")
    return out.groupBy("x").agg(F.count(F.lit(1)).alias("n"), score)


@query("train_tree_means", MEANS_SQL)
def _(spark, sf):
    out = fitted(spark, sf, "random_forest", {"trees": 1, "depth": 1, "bootstrap": False}, split.REGRESSION, "amount", [])
    return out.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), 3).alias("prediction"))


@query("train_boosting_means", MEANS_SQL)
def _(spark, sf):
    out = fitted(spark, sf, "gradient_boosting", {"iterations": 1, "rate": 1.0}, split.REGRESSION, "amount", [])
    return out.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), 3).alias("prediction"))


# --- stability over rules -----------------------------------------------------------------------

SEEDS = train.SEEDS
_SEED_ROWS = " UNION ALL ".join(
    f"SELECT {s} AS seed, * FROM (SELECT *, row_number() OVER (ORDER BY md5('{s}:' || o_orderkey)) <= round(count(*) OVER () * 0.2::DOUBLE) AS t FROM scored) WHERE t"
    for s in SEEDS
)
SEED_CTE = f"""{SCORED_CTE}, held AS ({_SEED_ROWS}),
rule_f1 AS (SELECT seed, model, round((2.0 * tp / (2.0 * tp + fp + fn) + 2.0 * tn / (2.0 * tn + fp + fn)) / 2, 6)::DOUBLE AS f1 FROM
  (SELECT seed, model, sum((score >= th AND actual = 1)::INT) AS tp, sum((score >= th AND actual = 0)::INT) AS fp, sum((score < th AND actual = 1)::INT) AS fn,
     sum((score < th AND actual = 0)::INT) AS tn FROM held, (VALUES {', '.join(f"('{m}', {t}::DOUBLE)" for m, t in RULES.items())}) r(model, th) GROUP BY seed, model)),
winners AS (SELECT seed, model, f1 FROM (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY f1 DESC, model) AS rn FROM rule_f1) WHERE rn = 1),
feats AS ({" UNION ALL ".join(f"SELECT seed, '{c}' AS feature, abs(corr({c}, actual)) AS r FROM held GROUP BY seed" for c in ("n_items", "u", "price_actual", "o_custkey", "o_orderkey"))}),
ranked AS (SELECT seed, feature, row_number() OVER (PARTITION BY seed ORDER BY r DESC, feature) AS place FROM feats)"""


def held_out(spark, sf):
    scored = marts.scored_orders(spark, sf)
    out = None
    for seed in SEEDS:
        part = split.split_rows(scored, "o_orderkey", seed=seed).where("is_test").drop("is_test").withColumn("seed", F.lit(seed))
        out = part if out is None else out.unionByName(part)
    return out


def rule_scores(spark, sf):
    rules = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(t).alias("th")) for m, t in RULES.items()])
    predicted = held_out(spark, sf).select("seed", "actual", "score", F.inline(rules)).withColumn("predicted", (F.col("score") >= F.col("th")).cast("int"))
    return evaluate.macro_scores(predicted, by=["seed", "model"])


def winners(spark, sf):
    best = F.min(F.struct((-F.col("f1_macro")).alias("f"), F.col("model"))).alias("b")
    return rule_scores(spark, sf).groupBy("seed").agg(best).select("seed", F.col("b.model").alias("model"), (-F.col("b.f")).alias("f1"))


@query(
    "robustness_models",
    f"""WITH {SEED_CTE}, c AS (SELECT model, count(*) AS n_seeds FROM winners GROUP BY model)
        SELECT model, n_seeds, row_number() OVER (ORDER BY n_seeds DESC, model) = 1 AS is_winner, n_seeds = {len(SEEDS)} AS unanimous FROM c""",
)
def _(spark, sf):
    return train.model_agreement(winners(spark, sf).select("seed", "model"))


@query(
    "robustness_summary",
    f"""WITH {SEED_CTE} SELECT 'f1_macro' AS metric, round(avg(f1), 6) AS mean, round(stddev_pop(f1), 6) AS std, round(min(f1), 6) AS min, round(max(f1), 6) AS max FROM winners""",
)
def _(spark, sf):
    return train.metric_stability(winners(spark, sf).select("seed", F.lit("f1_macro").alias("metric"), F.col("f1").alias("value")))


@query(
    "robustness_features",
    f"""WITH {SEED_CTE} SELECT feature, count(*) AS n_seeds, count(*) = {len(SEEDS)} AS always_in_top FROM ranked WHERE place <= 3 GROUP BY feature""",
)
def _(spark, sf):
    names = ["n_items", "u", "price_actual", "o_custkey", "o_orderkey"]
    actual = F.col("actual").cast("double")
    wide = held_out(spark, sf).groupBy("seed").agg(*[F.abs(profile.correlation(F.col(c).cast("double"), actual)).alias(c) for c in names])
    from pyspark.sql import Window

    order = Window.partitionBy("seed").orderBy(F.col("r").desc(), "feature")  # five features per seed
    ranked = wide.unpivot(["seed"], names, "feature", "r").withColumn("place", F.row_number().over(order))
    return train.feature_stability(ranked.select("seed", "place", "feature"), 3)
