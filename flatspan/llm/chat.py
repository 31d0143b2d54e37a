"""Chat formatting with perspective rotation: a dialogue is rendered once for every participant.

In a participant's rendering its turns are the assistant's, all others are turns of users that bear their role as name, and system turns
(which belong to no participant) stay the system's.  The mask holds the character spans that a model is trained on: what the assistant
says, its end mark included.

A conversation may hold any share of all turns, so it is neither gathered nor ranked in one task: turns are sorted over the cluster,
ranked within their sorted partitions, and shifted by the sizes of the partitions before.  ``PART_TURNS`` successive turns make a
part, which is rendered as one text; parts in order are the whole dialogue.

No turn can forge another: ``<|`` in a text or a role is written as ``< |``, and line breaks in a role as blanks, so the marks around a
turn are the only ones; the perspective itself is the role as it is.

Defined results: equal turns (same conversation, number, role and text) are one turn; turns without a number come first, and ties go by role, then
text; a null text is empty; a turn without role is rendered as a user without name and is no participant; a
conversation without participants gives no rows; conversations without an id are one conversation; an empty table gives no rows.  Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flatspan.session import write_stage

PART_TURNS = 64
SYSTEM = "system"
#: Marks around a turn, from the public ChatML layout.
START, END = "<|im_start|>", "<|im_end|>\n"


def ranked(turns: DataFrame) -> DataFrame:
    """(conv_id, role, text, place): the place of every distinct turn in its conversation, from 0."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text")]
    rows = turns.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    rows = write_stage(rows, "chat-turns").repartitionByRange(*order).withColumn("piece", F.spark_partition_id())
    rows = write_stage(rows, "chat-sorted")
    sizes = write_stage(rows.groupBy("conv_id", "piece").agg(F.count("*").alias("n")), "chat-sizes")
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("conv_id").alias("c"), F.col("piece").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("conv_id", "piece").orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(within) - 1)
    rows = rows.join(starts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("piece") == F.col("p")))
    return rows.select("conv_id", "role", "text", (F.col("start") + F.col("rank")).alias("place"))


def escaped(text: Column) -> Column:
    """A text without the signs that begin a mark."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def turn_text(turn: Column, assistant: Column) -> Column:
    """A rendered turn, seen by ``assistant``."""
    name = F.when(turn["role"].isNull(), "user").otherwise(F.concat(F.lit("user name="), F.translate(escaped(turn["role"]), "\r\n", "  ")))
    who = F.when(turn["role"] == assistant, "assistant").when(turn["role"] == SYSTEM, SYSTEM).otherwise(name)
    return F.concat(F.lit(START), who, F.lit("\n"), escaped(turn["text"]), F.lit(END))


def rotate(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, perspective, part, n_turns, text, mask): ``mask`` an array of (start, end) in characters of the part's text."""
    rows = write_stage(ranked(turns), "chat-ranked")
    part = F.floor(F.col("place") / part_turns).alias("part")
    parts = rows.groupBy("conv_id", part).agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    speakers = rows.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("role").alias("perspective")).distinct()
    parts, speakers = write_stage(parts, "chat-parts"), write_stage(speakers, "chat-speakers")
    seen = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    seen = seen.withColumn("texts", F.transform("turns", lambda t: turn_text(t, F.col("perspective"))))
    # Ends of the turns, summed along; then the spans of the assistant's turns without their head line.
    seen = seen.withColumn("ends", F.aggregate("texts", F.array(F.lit(0)), lambda ends, t: F.concat(ends, F.array(F.element_at(ends, -1) + F.length(t)))))
    head = len(START) + len("assistant\n")
    spans = F.transform("turns", lambda t, i: F.struct((F.col("ends")[i] + head).alias("start"), F.col("ends")[i + 1].alias("end"), t["role"].alias("role")))
    own = F.filter(spans, lambda s: s["role"] == F.col("perspective"))
    mask = F.transform(own, lambda s: F.struct(s["start"], s["end"]))
    return seen.select("conv_id", "perspective", "part", F.size("turns").cast("long").alias("n_turns"), F.array_join("texts", "").alias("text"), mask.alias("mask"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    spans = F.array_join(F.transform("mask", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.select("conv_id", "perspective", "part", "n_turns", "text", spans.alias("mask"))


OP3_SQL = f"""
with t as (select distinct conv_id, turn, role, coalesce(text, '') as text from conversations),
r as (select *, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text) - 1 as place from t),
s as (select distinct conv_id, role as perspective from r where role <> '{SYSTEM}'),
x as (
  select r.*, s.perspective, place // {PART_TURNS} as part,
    '{START}' || case when role = perspective then 'assistant' when role = '{SYSTEM}' then '{SYSTEM}'
      when role is null then 'user' else 'user name=' || translate(replace(role, '<|', '< |'), chr(13) || chr(10), '  ') end || chr(10) || replace(text, '<|', '< |') || '{END.rstrip()}' || chr(10) as line
  from r join s on r.conv_id is not distinct from s.conv_id),
y as (select *, sum(length(line)) over (partition by conv_id, perspective, part order by place) as ends from x)
select conv_id, perspective, cast(part as bigint) as part, count(*) as n_turns, string_agg(line, '' order by place) as text,
  coalesce(string_agg(cast(ends - length(line) + {len(START) + len("assistant") + 1} as bigint) || '-' || cast(ends as bigint), ',' order by place)
    filter (role = perspective), '') as mask
from y group by conv_id, perspective, part
"""
