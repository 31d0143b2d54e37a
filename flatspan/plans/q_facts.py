"""Queries of the facts and the chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from flatspan.functions.schema import categorical_columns, numeric_columns
from flatspan.operators import charts, evaluate, facts, profile
from flatspan.plans import marts
from flatspan.plans.base import query, table
from flatspan.plans.marts import FLAT_CTE, SCORED_CTE
from flatspan.plans.q_evaluate import ACCURACY_SQL, BINS_CTE, SEGMENT_BINARY_CTE, SEGMENTS, SWEEP_SQL, scored
from flatspan.plans.q_profile import round6, sql_matrix, sql_outliers, sql_pairs, sql_skew

MART_COLS = ["o_totalprice", "c_acctbal", "n_items", "total_price", "total_freight", "avg_product_weight", "is_late"]


def mart(spark, sf):
    return marts.order_mart(spark, sf).select("o_orderkey", *MART_COLS)


TOP_CORR_SQL = f"""SELECT col_a, col_b, round(r, 6) AS r, CAST(row_number() OVER (ORDER BY abs(r) DESC, col_a, col_b) AS INTEGER) AS place
  FROM ({sql_pairs('order_mart', MART_COLS)}) ORDER BY abs(r) DESC, col_a, col_b LIMIT 5"""


@query("top_correlations", f"WITH {FLAT_CTE} {TOP_CORR_SQL}")
def _(spark, sf):
    return round6(facts.top_correlations(profile.correlation_pairs(mart(spark, sf), MART_COLS)))


@query(
    "most_skewed",
    f"""WITH {FLAT_CTE} SELECT column_name, round(skewness, 6) AS skewness, CAST(row_number() OVER (ORDER BY abs(skewness) DESC, column_name) AS INTEGER) AS place
        FROM ({sql_skew('order_mart', MART_COLS)}) WHERE abs(skewness) > 0.5 ORDER BY abs(skewness) DESC, column_name LIMIT 5""",
)
def _(spark, sf):
    return round6(facts.most_skewed(profile.skewness(mart(spark, sf), MART_COLS), level=0.5))


@query(
    "outlier_highlights",
    f"""WITH {FLAT_CTE} SELECT column_name, pct_outliers, CAST(row_number() OVER (ORDER BY pct_outliers DESC, column_name) AS INTEGER) AS place
        FROM ({sql_outliers('order_mart', MART_COLS)}) WHERE pct_outliers >= 5 ORDER BY pct_outliers DESC, column_name LIMIT 5""",
)
def _(spark, sf):
    return facts.outlier_highlights(profile.outlier_summary(mart(spark, sf), MART_COLS))


# Importances without a model: how far a feature goes with the label, repeated on five slices.
FEATURES = MART_COLS[:-1]
_DROPS = " UNION ALL ".join(f"SELECT '{c}' AS feature, o_orderkey % 5 AS repeat, abs(corr({c}, is_late)) AS drop_ FROM order_mart GROUP BY 2" for c in FEATURES)
IMPORTANCE_CTE = f"""{FLAT_CTE}, drops AS ({_DROPS}), imp0 AS (SELECT feature, avg(drop_) AS m, stddev_pop(drop_) AS s FROM drops GROUP BY feature),
importances AS (SELECT feature, round(m, 6) AS importance_mean, round(s, 6) AS importance_std, NOT (m - s <= 0 AND 0 <= m + s) AS distinguishable_from_zero FROM imp0)"""


def importances(spark, sf):
    grouped = mart(spark, sf).groupBy((F.col("o_orderkey") % 5).alias("repeat")).agg(
        *[F.abs(profile.correlation(F.col(c).cast("double"), F.col("is_late").cast("double"))).alias(c) for c in FEATURES]
    )
    return facts.importance_summary(grouped.unpivot(["repeat"], FEATURES, "feature", "drop"))


@query("importance_summary", f"WITH {IMPORTANCE_CTE} SELECT * FROM importances")
def _(spark, sf):
    return importances(spark, sf)


MATERIAL_SQL = """SELECT *, CAST(row_number() OVER (ORDER BY importance_mean DESC, feature) AS INTEGER) AS place FROM importances
  WHERE abs(importance_mean) > 0.01 ORDER BY importance_mean DESC, feature LIMIT 8"""


@query("material_features", f"WITH {IMPORTANCE_CTE} {MATERIAL_SQL}")
def _(spark, sf):
    return facts.material_features(importances(spark, sf))


# Segments for which something is bound to stand out: each value of the item count.
PRICE_AXES = "SELECT 'n_items' AS segment_column, CAST(n_items AS VARCHAR) AS segment_value, * FROM scored UNION ALL SELECT 'customer_nation', customer_nation, * FROM scored"
PRICE_SEGMENT_CTE = f"""{SCORED_CTE}, axes AS ({PRICE_AXES}),
overall AS (SELECT avg(abs(price_actual - price_predicted)) AS om, avg(price_actual - price_predicted) AS oe FROM scored),
seg AS (SELECT segment_column, segment_value, count(*) AS n, avg(abs(price_actual - price_predicted)) AS m, avg(price_actual - price_predicted) AS e
  FROM axes GROUP BY 1, 2 HAVING count(*) >= 20),
segments AS (SELECT segment_column, segment_value, n, round(m, 6) AS mae, round(e, 6) AS mean_error, round(om, 6) AS overall_mae, round(oe, 6) AS overall_mean_error,
  m - om >= 0.5 * om AS elevated_mae, abs(e) >= 0.5 * om AS elevated_bias FROM seg, overall),
worst AS (SELECT segment_column, segment_value, n, concat_ws(', ', CASE WHEN elevated_mae THEN 'mae' END, CASE WHEN elevated_bias THEN 'bias' END) AS elevated,
  round(greatest(0, CASE WHEN elevated_mae THEN abs(mae - overall_mae) END, CASE WHEN elevated_bias THEN abs(mean_error - overall_mean_error) END), 6) AS excess
  FROM segments WHERE elevated_mae OR elevated_bias),
worst8 AS (SELECT *, CAST(row_number() OVER (ORDER BY excess DESC, segment_column, segment_value) AS INTEGER) AS place FROM worst ORDER BY place LIMIT 8)"""


def price_segments(spark, sf):
    return evaluate.segment_errors_regression(scored(spark, sf), ["n_items", "customer_nation"], "price_actual", "price_predicted")


@query("worst_segments", f"WITH {PRICE_SEGMENT_CTE} SELECT * FROM worst8")
def _(spark, sf):
    return facts.worst_segments(price_segments(spark, sf))


@query(
    "confusion_words",
    f"""WITH {SCORED_CTE}, c AS (SELECT actual, predicted, count(*) AS n FROM scored GROUP BY ALL)
        SELECT CASE WHEN actual = 1 AND predicted = 1 THEN 'true_positive' WHEN actual = 1 THEN 'false_negative' WHEN predicted = 1 THEN 'false_positive' ELSE 'true_negative' END AS cell,
          n, format('{{:,}}', n) || ' ' || 'of the orders that are ' || CASE actual WHEN 1 THEN 'late' ELSE 'on time' END
          || ' are taken for ' || CASE predicted WHEN 1 THEN 'late' ELSE 'on time' END AS fact
        FROM (SELECT a.v AS actual, p.v AS predicted, coalesce(n, 0) AS n FROM (VALUES (0), (1)) a(v) CROSS JOIN (VALUES (0), (1)) p(v)
          LEFT JOIN c ON c.actual = a.v AND c.predicted = p.v)""",
)
def _(spark, sf):
    return facts.confusion_words(evaluate.confusion_matrix(scored(spark, sf)), "order", "late", "on time")


@query(
    "fact_summary_profile",
    f"""WITH {FLAT_CTE}, m AS (SELECT o_orderkey, {', '.join(MART_COLS)} FROM order_mart)
    SELECT 'dataset' AS section, 1 AS place, 'n_rows' AS item, count(*)::DOUBLE AS value FROM m
    UNION ALL SELECT 'dataset', 2, 'n_columns', 8 UNION ALL SELECT 'dataset', 3, 'n_numeric', 8 UNION ALL SELECT 'dataset', 4, 'n_categorical', 0
    UNION ALL SELECT 'correlation', place, col_a || ' <-> ' || col_b, round(r, 2) FROM ({TOP_CORR_SQL})
    UNION ALL SELECT 'skewness', CAST(row_number() OVER (ORDER BY abs(skewness) DESC, column_name) AS INTEGER), column_name, round(skewness, 2)
      FROM ({sql_skew('order_mart', MART_COLS)}) WHERE abs(skewness) > 1
    UNION ALL SELECT 'outliers', CAST(row_number() OVER (ORDER BY pct_outliers DESC, column_name) AS INTEGER), column_name, round(pct_outliers, 1)
      FROM ({sql_outliers('order_mart', MART_COLS)}) WHERE pct_outliers >= 5""",
)
def _(spark, sf):
    df = mart(spark, sf)
    shape = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(len(numeric_columns(df))).alias("n_numeric"),
        F.lit(len(categorical_columns(df))).alias("n_categorical"),
    )
    return facts.profile_facts(
        shape, profile.correlation_pairs(df, MART_COLS), profile.skewness(df, MART_COLS), profile.outlier_summary(df, MART_COLS)
    )


@query(
    "fact_summary_model",
    f"""WITH {PRICE_SEGMENT_CTE}, {IMPORTANCE_CTE.split(FLAT_CTE)[1].lstrip(', ')}, acc AS ({ACCURACY_SQL})
    SELECT 'metric' AS section, 1 AS place, 'accuracy' AS item, accuracy AS value FROM acc
    UNION ALL SELECT 'metric', 2, 'majority_baseline', majority_baseline FROM acc
    UNION ALL SELECT 'feature', place, feature, importance_mean FROM ({MATERIAL_SQL})
    UNION ALL SELECT 'segment', place, segment_column || '=' || segment_value, excess FROM worst8""",
)
def _(spark, sf):
    accuracy = evaluate.accuracy_vs_baseline(evaluate.confusion_matrix(scored(spark, sf))).select(
        F.round("accuracy", 6).alias("accuracy"), F.round("majority_baseline", 6).alias("majority_baseline")
    )
    return facts.model_facts(accuracy, importances(spark, sf), price_segments(spark, sf))


# --- charts -----------------------------------------------------------------------------------


def _histogram_sql(source: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, b AS bin, round(low + (b - 1) * width, 6) AS left_edge, round(low + b * width, 6) AS right_edge,
            count(x) AS n, round(count(x) / (any_value(total) * any_value(width)), 6) AS density
            FROM (SELECT CAST(range AS INTEGER) AS b FROM range(1, 41)) LEFT JOIN LATERAL (SELECT 1) ON true
            CROSS JOIN (SELECT CAST(min({c}) AS DOUBLE) AS low, (CAST(max({c}) AS DOUBLE) - CAST(min({c}) AS DOUBLE)) / 40 AS width, count({c}) AS total FROM {source}) r
            LEFT JOIN (SELECT {c} AS x FROM {source} WHERE {c} IS NOT NULL) v ON least(floor((x - low) / width) + 1, 40) = b
            GROUP BY b, low, width"""
        for c in cols
    )


@query("hist_bins", _histogram_sql("lineitem", ["l_quantity", "l_extendedprice"]).replace(" LEFT JOIN LATERAL (SELECT 1) ON true", ""))
def _(spark, sf):
    return round6(charts.histogram(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"]))


@query(
    "hist_columns",
    """SELECT CAST(row_number() OVER (ORDER BY v DESC) AS INTEGER) AS place, column_name FROM (
       SELECT 'l_orderkey' AS column_name, var_samp(l_orderkey) AS v FROM lineitem UNION ALL SELECT 'l_partkey', var_samp(l_partkey) FROM lineitem
       UNION ALL SELECT 'l_suppkey', var_samp(l_suppkey) FROM lineitem UNION ALL SELECT 'l_linenumber', var_samp(l_linenumber) FROM lineitem
       UNION ALL SELECT 'l_quantity', var_samp(l_quantity) FROM lineitem UNION ALL SELECT 'l_extendedprice', var_samp(l_extendedprice) FROM lineitem
       UNION ALL SELECT 'l_discount', var_samp(l_discount) FROM lineitem UNION ALL SELECT 'l_tax', var_samp(l_tax) FROM lineitem) ORDER BY v DESC LIMIT 5""",
)
def _(spark, sf):
    cols = charts.histogram_columns(table(spark, sf, "lineitem"))
    return spark.createDataFrame([(i + 1, c) for i, c in enumerate(cols)], "place int, column_name string")


def _kde_sql(source: str, c: str) -> str:
    return f"""SELECT '{c}' AS column_name, CAST(p AS INTEGER) AS point, round(low + p * (high - low) / 299, 6) AS x,
        round(sum(k * exp(-0.5 * ((low + p * (high - low) / 299 - v) / h) ** 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
        FROM (SELECT min({c})::DOUBLE AS low, max({c})::DOUBLE AS high, count({c}) AS n, stddev_samp({c}) * pow(count({c}), -0.2) AS h FROM {source}) s,
          (SELECT {c} AS v, count(*) AS k FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}) g, (SELECT range AS p FROM range(0, 300)) r
        GROUP BY p, low, high"""


@query("kde_grid", f"{_kde_sql('lineitem', 'l_quantity')} UNION ALL {_kde_sql('lineitem', 'l_discount')} UNION ALL {_kde_sql('part', 'p_size')}")
def _(spark, sf):
    lines = charts.density_curve(table(spark, sf, "lineitem"), ["l_quantity", "l_discount"])
    return round6(lines.unionByName(charts.density_curve(table(spark, sf, "part"), ["p_size"])))


@query("heatmap_cells", f"WITH {FLAT_CTE} SELECT col_a, col_b, round(r, 6) AS r FROM ({sql_matrix('order_mart', MART_COLS)}) WHERE col_a <> col_b")
def _(spark, sf):
    return round6(charts.heatmap_cells(profile.correlation_matrix(mart(spark, sf), MART_COLS)))


@query(
    "importance_bars",
    f"""WITH {IMPORTANCE_CTE} SELECT *, CASE WHEN NOT distinguishable_from_zero THEN 'unclear' WHEN importance_mean >= 0 THEN 'positive' ELSE 'negative' END AS bar
        FROM importances ORDER BY importance_mean DESC, feature LIMIT 10""",
)
def _(spark, sf):
    return charts.importance_bars(importances(spark, sf))


@query(
    "threshold_curve",
    f"WITH {SCORED_CTE}, {SWEEP_SQL} SELECT threshold, measure, value FROM sweep UNPIVOT (value FOR measure IN (precision_minority, recall_minority, f1_macro))".replace(
        "SELECT threshold, measure, value FROM sweep", "SELECT threshold, measure, value FROM (SELECT threshold, precision_minority, recall_minority, f1_macro FROM sweep)"
    ),
)
def _(spark, sf):
    return charts.threshold_curve(evaluate.threshold_sweep(scored(spark, sf), "actual", "score"))


@query("calibration_curve", f"WITH {BINS_CTE} SELECT 'raw' AS series, bin, n, prob_pred, prob_true FROM bins")
def _(spark, sf):
    return charts.calibration_curve(evaluate.reliability_bins(scored(spark, sf), "actual", "score"))


@query(
    "residuals",
    f"""WITH {SCORED_CTE} SELECT price_predicted AS predicted, price_actual AS actual, round(price_actual - price_predicted, 6) AS residual FROM scored""",
)
def _(spark, sf):
    return evaluate.prediction_points(scored(spark, sf), "o_orderkey", "price_actual", "price_predicted", seed=7)


@query(
    "box_by_class",
    f"""WITH {FLAT_CTE}, q AS (SELECT is_late, quantile_cont(total_price, 0.25) AS q1, quantile_cont(total_price, 0.5) AS q2, quantile_cont(total_price, 0.75) AS q3
          FROM order_mart GROUP BY is_late)
        SELECT CAST(is_late AS VARCHAR) AS label, count(*) AS n, round(q1, 4) AS q1, round(q2, 4) AS median, round(q3, 4) AS q3,
          round(min(total_price) FILTER (WHERE total_price >= q1 - 1.5 * (q3 - q1)), 4) AS low_whisker, round(max(total_price) FILTER (WHERE total_price <= q3 + 1.5 * (q3 - q1)), 4) AS high_whisker,
          count(*) FILTER (WHERE total_price < q1 - 1.5 * (q3 - q1) OR total_price > q3 + 1.5 * (q3 - q1)) AS n_outside
        FROM order_mart JOIN q USING (is_late) GROUP BY is_late, q1, q2, q3""",
)
def _(spark, sf):
    out = charts.box_by_class(mart(spark, sf), "total_price", "is_late")
    return out.withColumns({c: F.round(c, 4) for c, t in out.dtypes if t == "double"})


@query(
    "trend_line",
    f"""WITH {FLAT_CTE}, f AS (SELECT regr_slope(total_price, n_items) AS b, regr_intercept(total_price, n_items) AS a, min(n_items)::DOUBLE AS low, max(n_items)::DOUBLE AS high FROM order_mart)
        SELECT CAST(p AS INTEGER) AS point, round(low + p * (high - low) / 99, 6) AS x, round(a + b * (low + p * (high - low) / 99), 3) AS y FROM f, (SELECT range AS p FROM range(0, 100))""",
)
def _(spark, sf):
    out = charts.trend_line(mart(spark, sf), "n_items", "total_price")
    return out.withColumns({"x": F.round("x", 6), "y": F.round("y", 3)})


@query(
    "scatter_points",
    f"WITH {FLAT_CTE} SELECT CAST(n_items AS DOUBLE) AS x, round(total_price, 4) AS y FROM order_mart",
)
def _(spark, sf):
    return charts.scatter_points(mart(spark, sf), "n_items", "total_price", "o_orderkey").withColumn("y", F.round("y", 4))


@query(
    "segment_bars",
    f"""WITH {SEGMENT_BINARY_CTE}, bars AS (SELECT *, segment_value || CASE WHEN elevated_false_negative_rate OR elevated_false_positive_rate THEN '*' ELSE '' END AS bar
          FROM segments WHERE segment_column IN ('o_orderpriority', 'c_mktsegment'))
        SELECT segment_column, bar, 'false_negative_rate' AS metric, coalesce(false_negative_rate, 0) AS value, overall_false_negative_rate AS overall FROM bars
        UNION ALL SELECT segment_column, bar, 'false_positive_rate', coalesce(false_positive_rate, 0), overall_false_positive_rate FROM bars""",
)
def _(spark, sf):
    errors = evaluate.segment_errors_binary(scored(spark, sf), SEGMENTS)
    return charts.segment_bars(errors, SEGMENTS, ["false_negative_rate", "false_positive_rate"])


@query(
    "confusion_cells",
    f"""WITH {SCORED_CTE}, c AS (SELECT actual, predicted, count(*) AS n FROM scored GROUP BY ALL)
        SELECT CASE a.v WHEN 0 THEN 'On time (0)' ELSE 'Late (1)' END AS actual, CASE p.v WHEN 0 THEN 'On time (0)' ELSE 'Late (1)' END AS predicted, coalesce(n, 0) AS n
        FROM (VALUES (0), (1)) a(v) CROSS JOIN (VALUES (0), (1)) p(v) LEFT JOIN c ON c.actual = a.v AND c.predicted = p.v""",
)
def _(spark, sf):
    return charts.confusion_cells(evaluate.confusion_matrix(scored(spark, sf)), "Late", "On time")


@query(
    "chart_catalogue",
    f"""WITH {FLAT_CTE} SELECT 'histogram' AS chart, 80::BIGINT AS n_rows, NULL::VARCHAR AS skipped_reason
        UNION ALL SELECT 'heatmap', 42, NULL UNION ALL SELECT 'trend', 100, NULL
        UNION ALL SELECT 'outliers', 0, 'no rows' UNION ALL SELECT 'confusion_matrix', 0, 'regression run' """,
)
def _(spark, sf):
    df = mart(spark, sf)
    return charts.chart_catalogue(
        {
            "histogram": charts.histogram(df, ["total_price", "o_totalprice"]),
            "heatmap": charts.heatmap_cells(profile.correlation_matrix(df, MART_COLS)),
            "trend": charts.trend_line(df, "n_items", "total_price"),
            "outliers": facts.outlier_highlights(profile.outlier_summary(df, ["o_totalprice"])),
            "confusion_matrix": "regression run",
        }
    )
