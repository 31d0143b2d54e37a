"""Queries of the cleaning step, over orders with derived dirt and over the event and text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from flatspan.functions.schema import column_kinds, content_id
from flatspan.operators import clean
from flatspan.plans import marts
from flatspan.plans.base import kept, query, table
from flatspan.plans.marts import DIRTY_CTE

# SQL twins of the cleaning rules.
_IS_PLACEHOLDER = "lower(trim({c})) IN ('unknown','error','n/a','na','none','null','-','--','')"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_TEXTS = ["status", "priority", "amount_text", "channel"]
_ALL = ["o_orderkey", "o_custkey", "status", "priority", "price", "amount_text", "channel", "empty_number"]

UNIQUE_CTE = f"{DIRTY_CTE}, uniq AS (SELECT DISTINCT * FROM dirty)"
NORMAL_CTE = f"""{UNIQUE_CTE}, normal AS (SELECT o_orderkey, o_custkey,
  {', '.join(f"CASE WHEN {_IS_PLACEHOLDER.format(c=c)} THEN NULL ELSE {c} END AS {c}" for c in _TEXTS)}, price, empty_number FROM uniq)"""
TYPED_CTE = f"{NORMAL_CTE}, typed AS (SELECT * REPLACE (TRY_CAST(amount_text AS DOUBLE) AS amount_text) FROM normal)"


def _mode(c: str, source: str) -> str:
    return f"""coalesce((SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1), 'unknown')"""


def _median(c: str, source: str) -> str:
    return f"(SELECT quantile_cont({c}, 0.5) FROM {source})"


FILLED_CTE = f"""{TYPED_CTE}, filled AS (SELECT o_orderkey, o_custkey,
  {', '.join(f"coalesce({c}, {_mode(c, 'typed')}) AS {c}" for c in ("status", "priority", "channel"))},
  {', '.join(f"coalesce({c}, {_median(c, 'typed')}) AS {c}" for c in ("price", "amount_text"))}, empty_number FROM typed)"""


def unique(spark, sf):
    return kept(spark, sf, "unique_orders", lambda s, f: marts.dirty_orders(s, f).dropDuplicates())


def typed(spark, sf):
    return clean.apply_type_correction(clean.placeholders_to_null(unique(spark, sf)), ["amount_text"])


@query("dedupe_exact", f"WITH {UNIQUE_CTE} SELECT * FROM uniq")
def _(spark, sf):
    return clean.drop_duplicates(marts.dirty_orders(spark, sf))


@query(
    "dedupe_counts",
    f"""WITH {DIRTY_CTE} SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS n_distinct,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS n_duplicates_removed FROM dirty""",
)
def _(spark, sf):
    return clean.duplicate_counts(marts.dirty_orders(spark, sf))


@query(
    "dedupe_subset",
    """SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER
       (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
)
def _(spark, sf):
    return clean.drop_duplicates(table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "dedupe_text",
    """SELECT doc_id, text, lang, source, n_chars FROM (SELECT *, row_number() OVER
       (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
)
def _(spark, sf):
    return clean.drop_duplicates(table(spark, sf, "documents"), ["text"], ["doc_id"])


@query(
    "content_row_id",
    f"""WITH {UNIQUE_CTE} SELECT o_orderkey, md5({" || chr(1) || ".join(
        f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in ("o_orderkey", "o_custkey", "status", "priority", "channel"))}) AS row_id
        FROM uniq""",
)
def _(spark, sf):
    cols = ["o_orderkey", "o_custkey", "status", "priority", "channel"]
    return content_id(unique(spark, sf), "row_id", cols).select("o_orderkey", "row_id")


@query("placeholder_null", f"WITH {NORMAL_CTE} SELECT * FROM normal")
def _(spark, sf):
    return clean.placeholders_to_null(unique(spark, sf))


@query(
    "placeholder_counts",
    f"WITH {UNIQUE_CTE} SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {_IS_PLACEHOLDER.format(c=c)}) AS n_placeholders FROM uniq" for c in _TEXTS
    )
    + ") WHERE n_placeholders > 0",
)
def _(spark, sf):
    return clean.placeholder_counts(unique(spark, sf))


@query(
    "placeholder_custom_list",
    f"""WITH {UNIQUE_CTE} SELECT o_orderkey, CASE WHEN lower(trim(status)) IN ('p', 'web') THEN NULL ELSE status END AS status,
        CASE WHEN lower(trim(channel)) IN ('p', 'web') THEN NULL ELSE channel END AS channel FROM uniq""",
)
def _(spark, sf):
    return clean.placeholders_to_null(unique(spark, sf).select("o_orderkey", "status", "channel"), [" P", "WEB"])


@query(
    "type_correct_decisions",
    f"WITH {NORMAL_CTE} SELECT *, n_non_blank > 0 AND n_parsed / n_non_blank > 0.9 AS converts FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NOT NULL AND trim({c}) NOT IN ('', 'nan', 'None', 'NaN')) AS n_non_blank,
            count(*) FILTER (WHERE regexp_matches({c}, '{_NUMBER}')) AS n_parsed FROM normal"""
        for c in _TEXTS
    )
    + ")",
)
def _(spark, sf):
    return clean.type_correction_decisions(clean.placeholders_to_null(unique(spark, sf)))


@query("type_correct", f"WITH {TYPED_CTE} SELECT * FROM typed")
def _(spark, sf):
    return clean.correct_types(clean.placeholders_to_null(unique(spark, sf)))[0]


@query(
    "missing_fraction",
    f"WITH {TYPED_CTE} SELECT column_name, round(missing_fraction, 6) AS missing_fraction, missing_fraction > 0.5 AS high_missing FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS missing_fraction FROM typed" for c in _ALL)
    + ")",
)
def _(spark, sf):
    return clean.missing_fractions(typed(spark, sf)).withColumn("missing_fraction", F.round("missing_fraction", 6))


@query(
    "high_missing_flag",
    f"WITH {TYPED_CTE} SELECT column_name FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS f FROM typed" for c in _ALL)
    + ") WHERE f > 0.5",
)
def _(spark, sf):
    return clean.missing_fractions(typed(spark, sf)).where("high_missing").select("column_name")


@query(
    "impute_median",
    f"""WITH {TYPED_CTE} SELECT o_orderkey, coalesce(price, {_median('price', 'typed')}) AS price,
        coalesce(amount_text, {_median('amount_text', 'typed')}) AS amount_text, empty_number FROM typed""",
)
def _(spark, sf):
    df = typed(spark, sf).select("o_orderkey", "price", "amount_text", "empty_number")
    return clean.fill_missing(df, clean.fit_fill_values(df))


@query(
    "impute_mode",
    f"""WITH {TYPED_CTE} SELECT o_orderkey, {', '.join(f"coalesce({c}, {_mode(c, 'typed')}) AS {c}" for c in ("status", "priority", "channel"))} FROM typed""",
)
def _(spark, sf):
    df = typed(spark, sf).select("o_orderkey", "status", "priority", "channel")
    return clean.fill_missing(df, clean.fit_fill_values(df))


@query(
    "column_modes",
    f"WITH {UNIQUE_CTE} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, * FROM (SELECT {c} AS mode_value, count(*) AS mode_count FROM uniq
            WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"""
        for c in _TEXTS
    ),
)
def _(spark, sf):
    return clean.column_modes(unique(spark, sf), _TEXTS)


@query(
    "impute_fit_apply",
    f"""WITH {TYPED_CTE}, fit AS (SELECT * FROM typed WHERE o_custkey % 2 = 0)
        SELECT o_orderkey, coalesce(price, {_median('price', 'fit')}) AS price, coalesce(status, {_mode('status', 'fit')}) AS status
        FROM typed WHERE o_custkey % 2 = 1""",
)
def _(spark, sf):
    df = typed(spark, sf).select("o_orderkey", "o_custkey", "price", "status")
    fills = clean.fit_fill_values(df.where("o_custkey % 2 = 0").drop("o_custkey", "o_orderkey"))
    return clean.fill_missing(df.where("o_custkey % 2 = 1").drop("o_custkey"), fills)


_SHARES = f"""SELECT column_name, CASE WHEN share >= 0.99 THEN round(share, 6) END AS top_share, share >= 0.99 AS low_variance FROM (
  {" UNION ALL ".join(f"SELECT '{c}' AS column_name, max(n) / sum(n) AS share FROM (SELECT {c}, count(*) AS n FROM filled GROUP BY {c})" for c in _ALL)})"""


@query("low_variance_cols", f"WITH {FILLED_CTE} {_SHARES}")
def _(spark, sf):
    df = typed(spark, sf)
    filled = clean.fill_missing(df, clean.fit_fill_values(df))
    return clean.top_value_shares(filled).withColumn("top_share", F.round("top_share", 6))


_CLEAN_COLUMNS = "o_orderkey, o_custkey, status, price, amount_text"


@query("clean_pipeline", f"WITH {FILLED_CTE} SELECT {_CLEAN_COLUMNS}, priority FROM filled")
def _(spark, sf):
    return clean.clean(marts.dirty_orders(spark, sf))[0]


@query(
    "clean_report",
    f"""WITH {FILLED_CTE}
    SELECT 'input_rows' AS item, NULL::VARCHAR AS column_name, (SELECT count(*) FROM dirty) AS value
    UNION ALL SELECT 'input_columns', NULL, 8
    UNION ALL SELECT 'output_rows', NULL, (SELECT count(*) FROM uniq)
    UNION ALL SELECT 'output_columns', NULL, 6
    UNION ALL SELECT 'duplicates_removed', NULL, (SELECT count(*) FROM dirty) - (SELECT count(*) FROM uniq)
    {" ".join(f"UNION ALL SELECT 'placeholders', '{c}', (SELECT count(*) FROM uniq WHERE {_IS_PLACEHOLDER.format(c=c)})" for c in ("status", "priority", "amount_text"))}
    UNION ALL SELECT 'columns_type_corrected', 'amount_text', NULL
    UNION ALL SELECT 'high_missing_columns_flagged', c, NULL FROM (SELECT 'priority' AS c, avg((priority IS NULL)::INT) AS f FROM typed
      UNION ALL SELECT 'empty_number', avg((empty_number IS NULL)::INT) FROM typed) WHERE f > 0.5
    {" ".join(f"UNION ALL SELECT 'numeric_columns_imputed', '{c}', NULL" for c in ("o_orderkey", "o_custkey", "price", "amount_text", "empty_number"))}
    {" ".join(f"UNION ALL SELECT 'categorical_columns_imputed', '{c}', NULL" for c in ("status", "priority", "channel"))}
    UNION ALL SELECT 'low_variance_columns_dropped', column_name, NULL FROM ({_SHARES}) WHERE low_variance""",
)
def _(spark, sf):
    df = marts.dirty_orders(spark, sf)
    return clean.report_rows(spark, clean.clean(df)[2])


_KINDS = {"numeric": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"], "categorical": ["l_returnflag", "l_linestatus", "l_shipdate"]}


@query(
    "column_kinds",
    " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, '{c}' AS column_name, count({c}) AS n_present, count(DISTINCT {c}) AS n_distinct FROM lineitem" for kind, cols in _KINDS.items() for c in cols
    ),
)
def _(spark, sf):
    """What each kind of column holds: the columns are told apart by their types, their values are counted."""
    df = table(spark, sf, "lineitem")
    kinds = [(r["kind"], r["column_name"]) for r in column_kinds(df).collect() if r["kind"] != "excluded"]
    cells = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for k, c in kinds])
    values = df.select(F.inline(cells)).groupBy("kind", "column_name", "v").agg(F.count("v").alias("n"))
    return values.groupBy("kind", "column_name").agg(F.sum("n").alias("n_present"), F.count("v").alias("n_distinct"))
