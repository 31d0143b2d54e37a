"""Queries of the profiling step."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from flatspan.operators import profile
from flatspan.plans.base import query, table

LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PART_COLS = ["p_partkey", "p_size", "p_retailprice"]


def round6(df):
    return df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})


def sql_describe(source: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
            round(CAST(min({c}) AS DOUBLE), 6) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75,
            round(CAST(max({c}) AS DOUBLE), 6) AS max FROM {source}"""
        for c in cols
    )


def sql_pairs(source: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM {source}" for a, b in itertools.combinations(cols, 2)
    )


def sql_matrix(source: str, cols: list[str]) -> str:
    pairs = sql_pairs(source, cols)
    ones = " UNION ALL ".join(f"SELECT '{c}' AS col_a, '{c}' AS col_b, 1.0::DOUBLE AS r" for c in cols)
    return f"SELECT col_a, col_b, r FROM ({pairs}) UNION ALL SELECT col_b AS col_a, col_a AS col_b, r FROM ({pairs}) UNION ALL {ones}"


def sql_skew(source: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CASE WHEN min({c}) = max({c}) THEN 0.0 ELSE skewness({c}) END AS skewness FROM {source}" for c in cols
    )


def sql_outliers(source: str, cols: list[str], k: float = 1.5) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS n_outliers,
            round(count(*) FILTER (WHERE {c} < lo OR {c} > hi) / count({c}) * 100, 4) AS pct_outliers,
            any_value(lo) AS lower_fence, any_value(hi) AS upper_fence
            FROM {source}, (SELECT q1 - {k} * (q3 - q1) AS lo, q3 + {k} * (q3 - q1) AS hi FROM
              (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {source}))"""
        for c in cols
    )


@query("describe_numeric", sql_describe("lineitem", LINE_COLS))
def _(spark, sf):
    return round6(profile.describe(table(spark, sf, "lineitem"), LINE_COLS))


@query(
    "describe_long",
    f"""SELECT column_name, stat, value FROM (SELECT column_name, CAST(n AS DOUBLE) AS n, mean, std, min, q25, q50, q75, max FROM
        ({sql_describe('part', PART_COLS)})) UNPIVOT INCLUDE NULLS (value FOR stat IN (n, mean, std, min, q25, q50, q75, max))""",
)
def _(spark, sf):
    return round6(profile.describe_long(profile.describe(table(spark, sf, "part"), PART_COLS)))


@query("corr_matrix", f"SELECT col_a, col_b, round(r, 6) AS r FROM ({sql_matrix('lineitem', LINE_COLS)})")
def _(spark, sf):
    return round6(profile.correlation_matrix(table(spark, sf, "lineitem"), LINE_COLS))


@query(
    "corr_constant_null",
    """SELECT 'p_size' AS col_a, 'p_retailprice' AS col_b, round(corr(p_size, p_retailprice), 6) AS r FROM part
       UNION ALL SELECT 'p_size', 'constant', NULL UNION ALL SELECT 'p_retailprice', 'constant', NULL""",
)
def _(spark, sf):
    df = table(spark, sf, "part").select("p_size", "p_retailprice", F.lit(7).alias("constant"))
    return round6(profile.correlation_pairs(df))


@query("corr_wide", f"SELECT col_a, {', '.join(f'''round(max(r) FILTER (WHERE col_b = '{c}'), 6) AS {c}''' for c in LINE_COLS)} FROM ({sql_matrix('lineitem', LINE_COLS)}) GROUP BY col_a")
def _(spark, sf):
    return round6(profile.correlation_wide(profile.correlation_matrix(table(spark, sf, "lineitem"), LINE_COLS), LINE_COLS))


@query("skewness", f"SELECT column_name, round(skewness, 6) AS skewness FROM ({sql_skew('lineitem', LINE_COLS)})")
def _(spark, sf):
    return round6(profile.skewness(table(spark, sf, "lineitem"), LINE_COLS))


@query("iqr_outliers", f"SELECT * REPLACE (round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence) FROM ({sql_outliers('events', ['value', 'user_id'])})")
def _(spark, sf):
    return round6(profile.outlier_summary(table(spark, sf, "events"), ["value", "user_id"]))


@query("iqr_outliers_wide_fence", f"SELECT * REPLACE (round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence) FROM ({sql_outliers('documents', ['n_chars'], 3.0)})")
def _(spark, sf):
    return round6(profile.outlier_summary(table(spark, sf, "documents"), ["n_chars"], k=3.0))


_PROFILED = ["c_custkey", "c_nationkey", "c_acctbal"]


@query(
    "profile_tables",
    f"""SELECT 'shape' AS part, NULL::VARCHAR AS column_name, NULL::VARCHAR AS other, m AS measure, v::DOUBLE AS value FROM
          (SELECT 'n_rows' AS m, count(*) AS v FROM customer UNION ALL SELECT 'n_columns', count(*) FROM (DESCRIBE customer) UNION ALL SELECT 'n_numeric', {len(_PROFILED)})
        UNION ALL SELECT 'describe', column_name, NULL, stat, value FROM (SELECT column_name, CAST(n AS DOUBLE) AS n, mean, std, min, q25, q50, q75, max FROM
          ({sql_describe('customer', _PROFILED)})) UNPIVOT INCLUDE NULLS (value FOR stat IN (n, mean, std, min, q25, q50, q75, max))
        UNION ALL SELECT 'correlation', col_a, col_b, 'r', round(r, 6) FROM ({sql_matrix('customer', _PROFILED)})
        UNION ALL SELECT 'skewness', column_name, NULL, 'skewness', round(skewness, 6) FROM ({sql_skew('customer', _PROFILED)})
        UNION ALL SELECT 'outliers', column_name, NULL, measure, round(value, 6) FROM (SELECT column_name, n_outliers::DOUBLE AS n_outliers, pct_outliers, lower_fence, upper_fence
          FROM ({sql_outliers('customer', _PROFILED, 1.0)})) UNPIVOT INCLUDE NULLS (value FOR measure IN (n_outliers, pct_outliers, lower_fence, upper_fence))""",
)
def _(spark, sf):
    return round6(profile.profile(table(spark, sf, "customer"), k=1.0).facts())


@query(
    "skew_ranking",
    f"""SELECT column_name, round(skewness, 6) AS skewness, CAST(row_number() OVER (ORDER BY abs(skewness) DESC NULLS LAST, column_name) AS INTEGER) AS place
        FROM ({sql_skew('documents', ['doc_id', 'n_chars'])} UNION ALL {sql_skew('events', ['value'])})""",
)
def _(spark, sf):
    docs = profile.skewness(table(spark, sf, "documents"), ["doc_id", "n_chars"])
    return round6(profile.skew_ranking(docs.unionByName(profile.skewness(table(spark, sf, "events"), ["value"]))))


@query(
    "outlier_ranking",
    f"""SELECT column_name, n_outliers, pct_outliers, round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence,
        CAST(row_number() OVER (ORDER BY pct_outliers DESC, column_name) AS INTEGER) AS place
        FROM ({sql_outliers('events', ['value', 'event_id'])} UNION ALL {sql_outliers('documents', ['n_chars'])})""",
)
def _(spark, sf):
    both = profile.outlier_summary(table(spark, sf, "events"), ["value", "event_id"]).unionByName(
        profile.outlier_summary(table(spark, sf, "documents"), ["n_chars"])
    )
    return round6(profile.outlier_ranking(both))


# A table with NaN and infinity, which count as missing, and with dots in its column names.
GAPPY_SQL = "(SELECT event_id, CASE WHEN event_id % 7 IN (0, 3) THEN NULL ELSE value END AS value FROM events)"


def gappy(spark, sf):
    key = F.col("event_id")
    odd = F.when(key % 7 == 0, float("nan")).when(key % 7 == 3, F.when(key % 2 == 0, float("inf")).otherwise(float("-inf")))
    return table(spark, sf, "events").select(key, odd.otherwise(F.col("value")).alias("value"))


@query("describe_nan", sql_describe(GAPPY_SQL, ["event_id", "value"]))
def _(spark, sf):
    return round6(profile.describe(gappy(spark, sf)))


@query("outliers_nan", f"SELECT * REPLACE (round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence) FROM ({sql_outliers(GAPPY_SQL, ['event_id', 'value'])})")
def _(spark, sf):
    return round6(profile.outlier_summary(gappy(spark, sf)))


@query("dotted_columns", f"SELECT * REPLACE ('the.' || column_name AS column_name) FROM ({sql_describe(GAPPY_SQL, ['event_id', 'value'])})")
def _(spark, sf):
    return round6(profile.describe(gappy(spark, sf).toDF("the.event_id", "the.value")))
