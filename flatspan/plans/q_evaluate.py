"""Queries of model evaluation, over orders scored by a rule on the key."""

from __future__ import annotations

from pyspark.sql import functions as F

from flatspan.operators import evaluate
from flatspan.plans import marts
from flatspan.plans.base import query
from flatspan.plans.marts import SCORED_CTE

SEGMENTS = ["o_orderpriority", "c_mktsegment", "product_category", "customer_nation"]


def scored(spark, sf):
    return marts.scored_orders(spark, sf)


CONFUSION_CTE = f"""{SCORED_CTE}, confusion AS (
  SELECT a.size_actual AS actual, b.size_actual AS predicted, (SELECT count(*) FROM scored s WHERE s.size_actual = a.size_actual
    AND s.size_predicted = b.size_actual) AS n
  FROM (SELECT DISTINCT size_actual FROM scored) a, (SELECT DISTINCT size_actual FROM scored) b)"""


@query("confusion_matrix", f"WITH {CONFUSION_CTE} SELECT * FROM confusion")
def _(spark, sf):
    return evaluate.confusion_matrix(scored(spark, sf), "size_actual", "size_predicted")


MACRO_SQL = """per AS (SELECT l, sum((a = l AND p = l)::INT) AS tp, sum((a = l)::INT) AS na, sum((p = l)::INT) AS np
  FROM pairs, (SELECT DISTINCT a AS l FROM pairs UNION SELECT DISTINCT p FROM pairs) GROUP BY l)
  SELECT round(avg(coalesce(tp / nullif(np, 0), 0)), 6) AS precision_macro, round(avg(coalesce(tp / nullif(na, 0), 0)), 6) AS recall_macro,
    round(avg(coalesce(2 * tp / nullif(na + np, 0), 0)), 6) AS f1_macro FROM per"""


@query("macro_prf", f"WITH {SCORED_CTE}, pairs AS (SELECT actual AS a, predicted AS p FROM scored), {MACRO_SQL}")
def _(spark, sf):
    return evaluate.macro_scores(scored(spark, sf))


@query("macro_prf_multiclass", f"WITH {SCORED_CTE}, pairs AS (SELECT size_actual AS a, size_predicted AS p FROM scored), {MACRO_SQL}")
def _(spark, sf):
    return evaluate.macro_scores(scored(spark, sf), "size_actual", "size_predicted")


@query(
    "roc_auc",
    f"""WITH {SCORED_CTE}, g AS (SELECT score, sum(actual) AS pos, sum(1 - actual) AS neg FROM scored GROUP BY score),
        c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
        SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6)::DOUBLE AS roc_auc FROM c""",
)
def _(spark, sf):
    value = evaluate.roc_auc(scored(spark, sf), "actual", "score")
    return spark.createDataFrame([(None if value is None else round(value, 6),)], "roc_auc double")


SWEEP_SQL = """cells AS (SELECT t AS threshold, sum((score >= t AND actual = 1)::BIGINT)::BIGINT AS tp, sum((score >= t AND actual = 0)::BIGINT)::BIGINT AS fp,
    sum((score < t AND actual = 1)::BIGINT)::BIGINT AS fn, sum((score < t AND actual = 0)::BIGINT)::BIGINT AS tn
  FROM scored, (VALUES (0.3::DOUBLE), (0.4::DOUBLE), (0.5::DOUBLE)) v(t) GROUP BY t),
sweep AS (SELECT threshold, round((2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fp + fn)) / 2, 6) AS f1_macro,
    round(tp / (tp + fp), 6) AS precision_minority, round(tp / (tp + fn), 6) AS recall_minority,
    tn AS true_negative, fp AS false_positive, fn AS false_negative, tp AS true_positive FROM cells)"""


@query("threshold_sweep", f"WITH {SCORED_CTE}, {SWEEP_SQL} SELECT * FROM sweep")
def _(spark, sf):
    return evaluate.threshold_sweep(scored(spark, sf), "actual", "score")


REGRESSION_SQL = """m AS (SELECT count(*) AS n, sum((price_actual - price_predicted) ** 2) AS sse, avg(abs(price_actual - price_predicted)) AS mae,
    var_pop(price_actual) * count(*) AS sst FROM scored),
metrics AS (SELECT round(sqrt(sse / n), 6) AS rmse, round(mae, 6) AS mae, round(1 - sse / sst, 6) AS r2,
    round(1 - (sse / sst) * (n - 1) / (n - 10 - 1), 6) AS adjusted_r2 FROM m)"""


@query("regression_metrics", f"WITH {SCORED_CTE}, {REGRESSION_SQL} SELECT * FROM metrics")
def _(spark, sf):
    return evaluate.regression_metrics(scored(spark, sf), 10, "price_actual", "price_predicted")


BINS_CTE = f"""{SCORED_CTE},
edges AS (SELECT list_sort(list_distinct(quantile_cont(score, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM scored),
bins AS (SELECT bin, count(*) AS n, round(avg(actual), 6) AS prob_true, round(avg(score), 6) AS prob_pred
  FROM (SELECT *, CAST(len(list_filter(e[2:len(e) - 1], lambda x: x < score)) AS INTEGER) AS bin FROM scored, edges) GROUP BY bin)"""


@query("reliability_bins", f"WITH {BINS_CTE} SELECT * FROM bins")
def _(spark, sf):
    return evaluate.reliability_bins(scored(spark, sf), "actual", "score")


@query(
    "ece_brier",
    f"""WITH {BINS_CTE} SELECT (SELECT round(sum(n * abs(prob_true - prob_pred)) / sum(n), 6) FROM bins) AS ece,
        (SELECT round(avg((actual - score) ** 2), 6) FROM scored) AS brier_score""",
)
def _(spark, sf):
    df = scored(spark, sf)
    ece = evaluate.calibration_error(evaluate.reliability_bins(df, "actual", "score")).scalar()
    return evaluate.brier_score(df, "actual", "score").withColumn("ece", ece)


@query(
    "segment_columns",
    f"""WITH {SCORED_CTE}, c AS ({" UNION ALL ".join(f"SELECT {i} AS i, '{c}' AS column_name, count(DISTINCT {c}) AS n_values FROM scored"
        for i, c in enumerate(["o_orderkey", "o_orderpriority", "c_mktsegment", "customer_nation", "primary_seller_region", "product_category", "n_items"]))})
        SELECT CAST(row_number() OVER (ORDER BY n_values DESC, i) AS INTEGER) AS place, column_name, CAST(n_values AS INTEGER) AS n_values
        FROM c WHERE n_values BETWEEN 2 AND 50 ORDER BY n_values DESC, i LIMIT 5""",
)
def _(spark, sf):
    columns = ["o_orderkey", "o_orderpriority", "c_mktsegment", "customer_nation", "primary_seller_region", "product_category", "n_items"]
    return evaluate.segment_columns(scored(spark, sf), columns)


_AXES = " UNION ALL ".join(f"SELECT '{c}' AS segment_column, {c} AS segment_value, * FROM scored" for c in SEGMENTS)

SEGMENT_BINARY_CTE = f"""{SCORED_CTE}, axes AS ({_AXES}),
overall AS (SELECT sum((actual = 1 AND predicted = 0)::INT) / sum((actual = 1)::INT) AS ofn, sum((actual = 0 AND predicted = 1)::INT) / sum((actual = 0)::INT) AS ofp FROM scored),
seg AS (SELECT segment_column, segment_value, count(*) AS n, sum((actual = 1)::INT)::BIGINT AS n_positive, sum((actual = 0)::INT)::BIGINT AS n_negative,
    sum((actual = 1 AND predicted = 0)::INT) / nullif(sum((actual = 1)::INT), 0) AS fn, sum((actual = 0 AND predicted = 1)::INT) / nullif(sum((actual = 0)::INT), 0) AS fp
  FROM axes GROUP BY 1, 2 HAVING count(*) >= 20),
segments AS (SELECT segment_column, segment_value, n, n_positive, n_negative, round(fn, 6) AS false_negative_rate, round(fp, 6) AS false_positive_rate,
    round(ofn, 6) AS overall_false_negative_rate, round(ofp, 6) AS overall_false_positive_rate,
    coalesce(n_positive >= 20 AND fn - ofn >= greatest(0.5 * ofn, 0.1), false) AS elevated_false_negative_rate,
    coalesce(n_negative >= 20 AND fp - ofp >= greatest(0.5 * ofp, 0.1), false) AS elevated_false_positive_rate FROM seg, overall)"""


@query("segment_errors_binary", f"WITH {SEGMENT_BINARY_CTE} SELECT * FROM segments")
def _(spark, sf):
    return evaluate.segment_errors_binary(scored(spark, sf), SEGMENTS)


@query(
    "segment_errors_multiclass",
    f"""WITH {SCORED_CTE}, axes AS ({_AXES}), overall AS (SELECT avg((size_actual <> size_predicted)::INT) AS o FROM scored),
        seg AS (SELECT segment_column, segment_value, count(*) AS n, avg((size_actual <> size_predicted)::INT) AS m FROM axes GROUP BY 1, 2 HAVING count(*) >= 20)
        SELECT segment_column, segment_value, n, round(m, 6) AS misclassification_rate, round(o, 6) AS overall_misclassification_rate,
          m - o >= greatest(0.5 * o, 0.1) AS elevated_misclassification_rate FROM seg, overall""",
)
def _(spark, sf):
    return evaluate.segment_errors_multiclass(scored(spark, sf), SEGMENTS, "size_actual", "size_predicted")


@query(
    "segment_errors_regression",
    f"""WITH {SCORED_CTE}, axes AS ({_AXES}),
        overall AS (SELECT avg(abs(price_actual - price_predicted)) AS om, avg(price_actual - price_predicted) AS oe FROM scored),
        seg AS (SELECT segment_column, segment_value, count(*) AS n, avg(abs(price_actual - price_predicted)) AS m, avg(price_actual - price_predicted) AS e
          FROM axes GROUP BY 1, 2 HAVING count(*) >= 20)
        SELECT segment_column, segment_value, n, round(m, 6) AS mae, round(e, 6) AS mean_error, round(om, 6) AS overall_mae, round(oe, 6) AS overall_mean_error,
          m - om >= 0.5 * om AS elevated_mae, abs(e) >= 0.5 * om AS elevated_bias FROM seg, overall""",
)
def _(spark, sf):
    return evaluate.segment_errors_regression(scored(spark, sf), SEGMENTS, "price_actual", "price_predicted")


TABLE_SQL = """SELECT o_orderkey AS row_id, actual AS actual_label, predicted AS predicted_label, confidence, actual = predicted AS correct FROM scored"""


@query("predictions_table", f"WITH {SCORED_CTE} {TABLE_SQL}")
def _(spark, sf):
    return evaluate.predictions_table_classification(scored(spark, sf), "o_orderkey")


@query(
    "predictions_table_regression",
    f"""WITH {SCORED_CTE} SELECT o_orderkey AS row_id, price_actual AS actual_value, price_predicted AS predicted_value,
        round(price_predicted - price_actual, 6) AS error, round(abs(price_predicted - price_actual), 6) AS abs_error FROM scored""",
)
def _(spark, sf):
    return evaluate.predictions_table_regression(scored(spark, sf), "o_orderkey", "price_actual", "price_predicted")


@query(
    "predictions_sample",
    f"""WITH {SCORED_CTE} SELECT price_actual AS actual, price_predicted AS predicted, round(price_actual - price_predicted, 6) AS residual FROM scored""",
)
def _(spark, sf):
    return evaluate.prediction_points(scored(spark, sf), "o_orderkey", "price_actual", "price_predicted")


ACCURACY_SQL = """SELECT round(sum(hit) / sum(n), 6) AS accuracy, round(max(n) / sum(n), 6) AS majority_baseline,
  sum(hit) / sum(n) < max(n) / sum(n) AS below_baseline FROM (SELECT actual, count(*) AS n, sum((actual = predicted)::INT) AS hit FROM scored GROUP BY actual)"""


@query("accuracy_vs_baseline", f"WITH {SCORED_CTE} {ACCURACY_SQL}")
def _(spark, sf):
    out = evaluate.accuracy_vs_baseline(evaluate.confusion_matrix(scored(spark, sf)))
    return out.withColumns({c: F.round(c, 6) for c in ("accuracy", "majority_baseline")})
