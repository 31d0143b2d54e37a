"""Benchmark decontamination with DataFrame functions only.

The windows of ``WINDOW`` words of all benchmark items (the whole item where it has fewer) are a hash set that is broadcast,
provided that they are at most ``BROADCAST_WINDOWS``; beyond that the same join is shuffled.  Each word of a document is hashed once, and
the hash of a window is put together from those of its halves, so all windows of all sizes cost a few hashes a word and no string is
built.  One pass looks every window up and counts the words; the windows found are then verified by their words, in the
documents that hold them.

Defined results: a null text has no words, and neither has a null item; a document with fewer words than a window can only be hit by
items as short; equal rows have equal results, and rows that share an id but not a text are told apart; a null doc_id is a row like any
other; empty tables give no hits or no rows.  Only doc_id and text, item_id and text are read, whatever other columns there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flatspan.session import write_stage

WINDOW = 10
#: Windows (about 100 bytes each) that may be broadcast.
BROADCAST_WINDOWS = 1_000_000

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What lies between words: everything in ASCII but digits and letters.
_BETWEEN = "".join(chr(i) for i in range(128) if not chr(i).isalnum())


def words(text: Column) -> Column:
    """The words of a text, capitals A-Z made small; none for null."""
    plain = F.translate(F.coalesce(text, F.lit("")), _BETWEEN + _CAPITALS, " " * len(_BETWEEN) + _CAPITALS.lower())
    return F.array_remove(F.split(plain, " "), "")


def window_texts(of: Column, starts: Column, length: Column | int) -> Column:
    """The windows of an array of words that begin at ``starts`` (from 0), each joined with spaces."""
    return F.transform(starts, lambda i: F.array_join(F.slice(of, (i + 1).cast("int"), length), " "))


def until(n: Column) -> Column:
    """The array 0 .. n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def with_windows(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """``rows`` (w: words) with ``n``, their number, and for each size an array ``h<size>`` of the hashes of all windows of so many words.

    ``p1`` holds the hashes of words; that of twice as many words is the hash of the two halves, and a size is put together from
    powers of two."""
    rows = rows.withColumn("n", F.size("w")).withColumn("p1", F.transform("w", lambda w: F.xxhash64(w)))
    joined = lambda left, right, skip: F.zip_with(left, F.slice(right, skip + 1, F.greatest(F.col("n"), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    power = 1
    while 2 * power <= max(sizes, default=1):
        rows = rows.withColumn(f"p{2 * power}", joined(f"p{power}", f"p{power}", power))
        power *= 2
    for size in sizes:
        parts = [1 << i for i in range(size.bit_length() - 1, -1, -1) if size >> i & 1]
        name, done = f"p{parts[0]}", parts[0]
        for part in parts[1:]:
            rows = rows.withColumn(f"s{size}_{done + part}", joined(name, f"p{part}", done))
            name, done = f"s{size}_{done + part}", done + part
        rows = rows.withColumn(f"h{size}", F.slice(name, 1, F.greatest(F.col("n") - size + 1, F.lit(0))))
    return rows


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, size, window), distinct."""
    items = benchmark.select(F.col("item_id"), words(F.col("text")).alias("w")).select("*", F.size("w").alias("n")).where("n > 0")
    size = F.least(F.col("n"), F.lit(WINDOW))
    rows = items.select("item_id", size.alias("size"), F.explode(window_texts(F.col("w"), until(F.col("n") - size + 1), size)).alias("window"))
    return write_stage(rows.distinct(), "decontaminate-windows")


def window_hashes(windows: DataFrame, sizes: list[int]) -> DataFrame:
    """(size, window, hash) of distinct windows; the hash is that of ``with_windows``."""
    rows = windows.select("size", "window").distinct().withColumn("w", F.split("window", " "))
    hash_ = F.lit(None).cast("long")
    for size in sizes:
        hash_ = F.when(F.col("size") == size, F.get(f"h{size}", F.lit(0))).otherwise(hash_)
    return write_stage(with_windows(rows, sizes).select("size", "window", hash_.alias("hash")), "decontaminate-keys")


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, places, items): a row for each row of ``docs``, ``places`` the hit words and ``items``
    the ids of the items whose windows occur, as sorted text."""
    found = benchmark_windows(benchmark)
    sizes = sorted(r["size"] for r in found.select("size").distinct().collect())  # at most WINDOW
    keys = window_hashes(found, sizes)
    asked = keys.select("hash", F.col("size").alias("of")).distinct()
    small = keys.count() <= BROADCAST_WINDOWS
    if small:
        asked = F.broadcast(asked)

    base = docs.select(F.col("doc_id"), F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    base = with_windows(base, sizes)
    every = F.concat(F.array(F.lit(None).cast("long")), *[F.col(f"h{size}") for size in sizes])  # the first one stands for the document
    # The words go along by reference, as only windows that are found become rows of their own.
    seen = base.select("doc_id", "text_hash", "n", *(["w"] if small else []), F.posexplode(every).alias("i", "hash"))
    start, place, size_of = F.lit(1), F.lit(None).cast("int"), F.lit(None).cast("int")
    for size in sizes:  # the windows of each size follow one another
        after = start + F.greatest(F.col("n") - size + 1, F.lit(0))
        here = (F.col("i") >= start) & (F.col("i") < after)
        place, size_of = F.when(here, F.col("i") - start).otherwise(place), F.when(here, size).otherwise(size_of)
        start = after
    met = seen.join(asked, "hash", "left").where("i = 0 or of is not null")
    window = F.when(F.col("i") > 0, F.array_join(F.slice("w", place + 1, size_of), " ")) if small else F.lit(None).cast("string")
    met = met.select("doc_id", "text_hash", "n", "i", "of", place.alias("place"), size_of.alias("size"), window.alias("window")).where("i = 0 or of = size")
    met = write_stage(met, "decontaminate-met")
    counted = met.where("i = 0").select("doc_id", "text_hash", F.col("n").cast("long").alias("n_words"))
    key = ["doc_id", "text_hash"]
    candidates = met.where("i > 0").select(*key, "place", "size", "window").distinct()
    matches = candidates.join(keys.select("size", "window"), ["size", "window"], "left_semi") if small else verified(docs, candidates, keys)
    matches = write_stage(matches, "decontaminate-matches")

    place = F.explode(F.sequence(F.col("place"), F.col("place") + F.col("size") - 1)).alias("place")
    covered = matches.select(*key, place).distinct().groupBy(*key).agg(F.count("*").alias("n_hit"), F.collect_list("place").alias("places"))
    of = matches.select(*key, "size", "window").distinct().join(found, ["size", "window"])
    items = of.select(*key, F.col("item_id").cast("string").alias("item")).distinct().groupBy(*key).agg(F.sort_array(F.collect_list("item")).alias("items"))
    hit = write_stage(covered.withColumnsRenamed({k: f"c_{k}" for k in key}).join(items, _same("c_", ""), "left").drop(*key), "decontaminate-hits")
    out = counted.join(hit, _same("", "c_"), "left")
    return out.select(
        *key, "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("places", F.array().cast("array<int>")).alias("places"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def verified(docs: DataFrame, candidates: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id, text_hash, place, size, window): the candidates whose words are those of a window of ``keys``."""
    places = candidates.groupBy(F.col("doc_id").alias("c_doc_id"), F.col("text_hash").alias("c_text_hash"))
    places = write_stage(places.agg(F.collect_list(F.struct("place", "size")).alias("at")), "decontaminate-candidates")
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").join(places, _same("", "c_"))
    texts = texts.dropDuplicates(["doc_id", "text_hash"]).select("doc_id", "text_hash", "at", words(F.col("text")).alias("w"))
    window = lambda x: F.array_join(F.slice("w", x["place"] + 1, x["size"]), " ")
    shown = F.transform("at", lambda x: F.struct(x["place"].alias("place"), x["size"].alias("size"), window(x).alias("window")))
    return texts.select("doc_id", "text_hash", F.inline(shown)).join(keys.select("size", "window"), ["size", "window"], "left_semi")


def _same(left: str, right: str) -> Column:
    """Equality of ids (also null ones) and text hashes under the two prefixes."""
    return F.col(f"{left}doc_id").eqNullSafe(F.col(f"{right}doc_id")) & F.col(f"{left}text_hash").eqNullSafe(F.col(f"{right}text_hash"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "document") -> DataFrame:
    """``docs`` without contaminated documents, or (``action`` "span") with the hit words and what follows them cut out of the texts."""
    if action not in ("document", "span"):
        raise ValueError(f"unknown action {action!r}")
    found = hits(docs, benchmark).where("n_hit > 0").select(F.col("doc_id").alias("c_doc_id"), F.col("text_hash").alias("c_text_hash"), "places")
    found = write_stage(found.dropDuplicates(["c_doc_id", "c_text_hash"]), "decontaminate-found")
    same = docs["doc_id"].eqNullSafe(found["c_doc_id"]) & F.xxhash64(docs["text"]).eqNullSafe(found["c_text_hash"])
    if action == "document":
        return docs.join(found, same, "left_anti").select(docs.columns)
    small = F.translate(docs["text"], _CAPITALS, _CAPITALS.lower())
    # A piece is a word and what lies between it and the next; pieces have the same lengths in the text as it was.
    pieces = F.regexp_extract_all(small, F.lit(r"([0-9a-z\x{80}-\x{10FFFF}]+[\x00-\x2F\x3A-\x60\x7B-\x7F]*)"), 1)
    ends = F.aggregate(
        pieces,
        F.array(F.length(small) - F.length(F.regexp_replace(small, r"^[\x00-\x2F\x3A-\x60\x7B-\x7F]+", ""))),
        lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(p))),
    )
    kept = F.transform(
        pieces,
        lambda p, i: F.when(~F.array_contains(found["places"], i), docs["text"].substr(F.element_at(ends, i + 1) + 1, F.length(p))).otherwise(""),
    )
    lead = docs["text"].substr(F.lit(1), F.element_at(ends, 1))
    text = F.when(found["places"].isNull(), docs["text"]).otherwise(F.concat(lead, F.array_join(kept, "")))
    return docs.join(found, same, "left").select(*(text.alias(c) if c == "text" else docs[c] for c in docs.columns))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return hits(docs, benchmark).select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = "list_filter(regexp_split_to_array(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

OP7_SQL = f"""
with d as (select doc_id, coalesce({_WORDS.format("text")}, []) as w from documents),
b as (select item_id, {_WORDS.format("text")} as w from benchmark where text is not null),
bw as (
  select distinct item_id, least(len(w), {WINDOW}) as size, unnest(list_transform(range(1, len(w) - least(len(w), {WINDOW}) + 2),
    lambda i: array_to_string(w[i : i + least(len(w), {WINDOW}) - 1], ' '))) as win
  from b where len(w) > 0),
sizes as (select distinct size from bw),
places as (
  select doc_id, size, unnest(range(1, len(w) - size + 2)) as i, w from d, sizes where len(w) >= size),
dw as (select doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') as win from places),
m as (select dw.doc_id, dw.i, bw.size, bw.item_id from dw join bw using (size, win)),
hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + size)) as p from m) group by doc_id),
it as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from m) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (doc_id) left join it using (doc_id)
"""
