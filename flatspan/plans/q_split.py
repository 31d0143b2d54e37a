"""Queries of model preparation: task types, splits, folds, weights, selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from flatspan.operators import evaluate, select, split
from flatspan.plans import marts
from flatspan.plans.base import query, table
from flatspan.plans.marts import SCORED_CTE


@query(
    "task_type",
    """SELECT * FROM (VALUES ('labels.quality', 'binary_classification'), ('embeddings.label', 'multiclass_classification'),
       ('documents.lang', 'multiclass_classification'), ('events.value', 'regression'), ('orders.o_custkey', 'regression'))
       v(target, task_type)""",
)
def _(spark, sf):
    targets = [("labels", "quality"), ("embeddings", "label"), ("documents", "lang"), ("events", "value"), ("orders", "o_custkey")]
    rows = [(f"{t}.{c}", split.detect_task_type(table(spark, sf, t), c)) for t, c in targets]
    return spark.createDataFrame(rows, "target string, task_type string")


@query(
    "feature_matrix",
    """SELECT p_partkey AS id, p_retailprice AS target, p_size::DOUBLE AS p_size FROM part""",
)
def _(spark, sf):
    df = table(spark, sf, "part")
    used, _, _ = split.feature_matrix(df, "p_retailprice", "p_partkey")
    return df.select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("target"), *[F.col(c).cast("double").alias(c) for c in used])


@query(
    "split_stratified",
    """SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id))
         <= round(count(*) OVER (PARTITION BY quality) * 0.2::DOUBLE) AS is_test FROM labels""",
)
def _(spark, sf):
    return split.split_rows(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "quality")


@query(
    "split_plain",
    """SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:' || o_orderkey)) <= round(count(*) OVER () * 0.2::DOUBLE) AS is_test FROM orders""",
)
def _(spark, sf):
    return split.split_rows(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


_GROUPED = """g AS (SELECT o_custkey, row_number() OVER (ORDER BY md5('42:' || o_custkey)) <= ceil(count(*) OVER () * 0.2::DOUBLE) AS is_test
  FROM (SELECT DISTINCT o_custkey FROM orders))"""


@query("split_grouped", f"WITH {_GROUPED} SELECT o_orderkey, o_custkey, is_test FROM orders JOIN g USING (o_custkey)")
def _(spark, sf):
    return split.split_groups(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey")


@query(
    "split_overlap",
    f"""WITH {_GROUPED} SELECT 'grouped' AS strategy, 0::BIGINT AS n_overlapping UNION ALL
        SELECT 'row_random', count(*) FROM (SELECT o_custkey FROM (SELECT o_custkey,
          row_number() OVER (ORDER BY md5('42:' || o_orderkey)) <= round(count(*) OVER () * 0.2::DOUBLE) AS t FROM orders)
          GROUP BY o_custkey HAVING min(t::INT) <> max(t::INT))""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    out = None
    for name, frame in (
        ("grouped", split.split_groups(orders, "o_custkey")),
        ("row_random", split.split_rows(orders, "o_orderkey")),
    ):
        row = split.group_overlap(frame, "o_custkey").agg(F.count(F.lit(1)).alias("n_overlapping")).select(
            F.lit(name).alias("strategy"), "n_overlapping"
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "cv_folds",
    """SELECT doc_id, quality, CAST(((row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id)) - 1) * 5)
         // count(*) OVER (PARTITION BY quality) AS INTEGER) AS fold FROM labels""",
)
def _(spark, sf):
    return split.assign_folds(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", 5, "quality")


@query(
    "cv_folds_plain",
    "SELECT o_orderkey, CAST(((row_number() OVER (ORDER BY md5('43:' || o_orderkey)) - 1) * 3) // count(*) OVER () AS INTEGER) AS fold FROM orders",
)
def _(spark, sf):
    return split.assign_folds(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 3, seed=43)


@query(
    "class_weights",
    """SELECT label, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM
       (SELECT label, count(*) AS n FROM embeddings GROUP BY label)""",
)
def _(spark, sf):
    return split.class_weights(table(spark, sf, "embeddings"), "label").withColumn("weight", F.round("weight", 6))


# Model selection over rules that stand in for models: "late when the score is at least t".
RULES = {"rule_35": 0.35, "rule_45": 0.45, "rule_50": 0.5, "rule_60": 0.6}

FOLD_SCORES_CTE = f"""{SCORED_CTE},
folded AS (SELECT *, CAST(((row_number() OVER (PARTITION BY actual ORDER BY md5('42:' || o_orderkey)) - 1) * 5)
  // count(*) OVER (PARTITION BY actual) AS INTEGER) AS fold FROM scored),
cells AS (SELECT model, fold, sum((p = 1 AND actual = 1)::INT) AS tp, sum((p = 1 AND actual = 0)::INT) AS fp,
    sum((p = 0 AND actual = 1)::INT) AS fn, sum((p = 0 AND actual = 0)::INT) AS tn
  FROM (SELECT model, fold, actual, CAST(score >= t AS INTEGER) AS p FROM folded,
    (VALUES {', '.join(f"('{m}', {t}::DOUBLE)" for m, t in RULES.items())}) r(model, t)) GROUP BY model, fold),
fold_scores AS (SELECT model, fold, round((2.0 * tp / (2.0 * tp + fp + fn) + 2.0 * tn / (2.0 * tn + fp + fn)) / 2, 6)::DOUBLE AS score FROM cells),
board AS (SELECT model, round(avg(score), 6) AS cv_score, round(stddev_pop(score), 6) AS cv_std FROM fold_scores GROUP BY model)"""


def fold_scores(spark, sf):
    scored = marts.scored_orders(spark, sf).select("o_orderkey", "actual", "score")
    folded = split.assign_folds(scored, "o_orderkey", 5, "actual")
    rules = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(t).alias("t")) for m, t in RULES.items()])
    predicted = folded.select("actual", "fold", "score", F.inline(rules)).withColumn(
        "predicted", (F.col("score") >= F.col("t")).cast("int")
    )
    return evaluate.macro_scores(predicted, by=["model", "fold"]).select("model", "fold", F.col("f1_macro").alias("score"))


@query("cv_fold_scores", f"WITH {FOLD_SCORES_CTE} SELECT * FROM fold_scores")
def _(spark, sf):
    return fold_scores(spark, sf)


@query(
    "leaderboard",
    f"""WITH {FOLD_SCORES_CTE} SELECT *, CAST(row_number() OVER (ORDER BY cv_score DESC, model) AS INTEGER) AS place,
        row_number() OVER (ORDER BY cv_score DESC, model) = 1 AS is_best FROM board""",
)
def _(spark, sf):
    return select.leaderboard(fold_scores(spark, sf))


@query(
    "near_tie_note",
    f"""WITH {FOLD_SCORES_CTE}, r AS (SELECT *, row_number() OVER (ORDER BY cv_score DESC, model) AS rn FROM board),
        t AS (SELECT a.model AS model_1, b.model AS model_2, a.cv_score AS s1, b.cv_score AS s2, a.cv_std + b.cv_std AS spread
          FROM r a JOIN r b ON a.rn = 1 AND b.rn = 2)
        SELECT model_1, model_2, round(abs(s1 - s2), 6) AS difference, round(spread, 6) AS combined_std,
          spread > 0 AND abs(s1 - s2) <= spread AS near_tie FROM t""",
)
def _(spark, sf):
    return select.near_tie(select.leaderboard(fold_scores(spark, sf))).drop("note")
