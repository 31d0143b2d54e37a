"""Near-duplicates by 64-bit SimHash fingerprints, found with BK-trees.

A pair of fingerprints within ``RADIUS`` = 3 bits agrees on at least one of four blocks of bits, so fingerprints are dealt into
shards, one for each block and value.  A shard becomes a BK-tree (children keyed by the integer Hamming distance to their
parent) in the task that holds it, and every fingerprint of the shard searches it, following only edges whose distance is within
the radius of its own.  A shard with more than ``SHARD_ROWS`` fingerprints is dealt again by four blocks of the bits
it does not agree on yet, so a shard never outgrows a task: after the last of the four levels its members differ in
at most 21 bits.  The trees reach their queries through the shuffle on the shard and not through a driver broadcast, for
together they hold every fingerprint of the corpus, which has no size bound.

Defined results: a null text counts as empty; a text without words has fingerprint zero, linked like any other; equal rows
have equal results; a null doc_id takes part in links, but the component's id is the smallest doc_id that is not null (null if there is
none); an empty table gives no rows.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from flatspan.llm import unused
from flatspan.llm.components import Forest, connected
from flatspan.session import write_stage

RADIUS = 3
#: Words of a shingle and the seed of its XXH64.
SHINGLE = 3
SEED = 42
#: Fingerprints of a shard that one task searches without dealing them again.
SHARD_ROWS = 4096
#: Fingerprints searched together, and (query, node) pairs looked at in one step.
FOREST_ROWS = 1 << 17
FRONTIER = 1 << 20
LEVELS = 4
ALL_BITS = (1 << 64) - 1

_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, some 1 MB of it at a time; no word is cut."""
    at = 0
    while at < len(data):
        end = at + size
        if end < len(data):
            blank = _BLANK.search(data, end)
            end = blank.start() if blank else len(data)
        yield data[at:end].split()
        at = end


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text given as UTF-8, as an unsigned number."""
    ones, n, kept = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for words in word_blocks(data.lower()):  # bytes.lower() changes A-Z only
        words = kept + words
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
        hashes = np.fromiter((digest(g, SEED) for g in grams), np.uint64)
        ones += _bit_counts(hashes)
        n += len(hashes)
        kept = words[max(0, len(words) - shingle + 1) :]
    if not n and kept:
        ones, n = _bit_counts(np.array([digest(b" ".join(kept), SEED)], np.uint64)), 1
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        part = np.ascontiguousarray(hashes[at : at + 8192])
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row's text as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(x.as_py() or b"", shingle) for x in batch.column(1)]
            fps = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _quarters(mask: int) -> list[int]:
    """Four masks, each ``mask`` and a quarter of the bits outside it."""
    rest = [i for i in range(64) if not mask >> i & 1]
    return [mask | sum(1 << i for i in part.tolist()) for part in np.array_split(np.array(rest), 4)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def bk_forest(shard: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One BK-tree for each shard over rows sorted by shard: the root of every row, and the edges as (65 * parent +
    distance, child), sorted.  Rows are the nodes; a tree grows one level at a time, all trees together."""
    first = np.r_[True, shard[1:] != shard[:-1]]
    root = np.flatnonzero(first)[np.cumsum(first) - 1]
    keys, children = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    active = np.flatnonzero(~first)
    above = root[active]
    while len(active):
        key = above * 65 + np.bitwise_count(fps[active] ^ fps[above])
        edge, at, of = np.unique(key, return_index=True, return_inverse=True)
        child = active[at]
        keys.append(edge)
        children.append(child)
        below = child[of]
        later = below != active
        active, above = active[later], below[later]
    keys, children = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(keys, kind="stable")
    return root, keys[order], children[order]


def forest_links(shard: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each row the first row of its component within its shard.  Links are merged as they are found and never kept."""
    root, keys, children = bk_forest(shard, fps)
    found = Forest(len(fps))
    todo = [(part, root[part]) for part in np.array_split(np.arange(len(fps)), len(fps) // FRONTIER + 1)]
    while todo:
        query, node = todo.pop()
        if len(query) > FRONTIER:
            half = len(query) // 2
            todo += [(query[half:], node[half:]), (query[:half], node[:half])]
            continue
        gap = np.bitwise_count(fps[query] ^ fps[node]).astype(np.int64)
        near = (gap <= radius) & (query != node)
        found.link(query[near], node[near])
        low = np.searchsorted(keys, node * 65 + np.maximum(gap - radius, 0))
        many = np.searchsorted(keys, node * 65 + np.minimum(gap + radius, 64), side="right") - low
        if many.any():
            ends = np.cumsum(many)
            edge = np.arange(ends[-1]) + np.repeat(low - (ends - many), many)
            todo.append((np.repeat(query, many), children[edge]))
    return found.root


def shard_links(shards: DataFrame) -> DataFrame:
    """Links (a, b) that connect the fingerprints of each shard: rows (mask, value, fp) in, at most one link a row out."""

    def search(mask: np.ndarray, value: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        new = np.r_[True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])]
        root = forest_links(np.cumsum(new), fp.view(np.uint64))
        moved = root != np.arange(len(fp))
        return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[root[moved]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns, strict=True)]
            if len(held[0]) >= FOREST_ROWS:
                mask, value, _ = held
                last = np.flatnonzero((mask != mask[-1]) | (value != value[-1]))
                cut = int(last[-1]) + 1 if len(last) else 0  # the last shard may go on
                if cut:
                    yield search(*(h[:cut] for h in held))
                    held = [h[cut:] for h in held]
        if len(held[0]):
            yield search(*held)

    dealt = shards.repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
    return dealt.mapInArrow(run, "a long, b long")


def link_fingerprints(fps: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (a, b) that connect all fingerprints within the radius of each other; ``fps`` has distinct values ``fp``."""
    masks, rows, found = [0], fps.select(F.lit(0).cast("long").alias("mask"), F.col("fp")), None
    for level in range(LEVELS):
        parts = {m: _quarters(m) for m in masks}
        split = F.create_map(*(F.lit(x) for m, q in parts.items() for x in (_signed(m), [_signed(y) for y in q])))
        dealt = rows.select(F.explode(split[F.col("mask")]).alias("mask"), "fp")
        dealt = dealt.select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("value"), "fp")
        masks, large = sorted({x for q in parts.values() for x in q}), None
        if level < LEVELS - 1:
            sizes = dealt.groupBy("mask", "value").count()
            large = write_stage(sizes.where(F.col("count") > shard_rows).select("mask", "value"), "simhash-large")
            if large.isEmpty():
                large = None
        small = dealt if large is None else dealt.join(large, ["mask", "value"], "left_anti")
        links = shard_links(small)
        found = links if found is None else found.union(links)
        if large is None:
            return found
        rows = write_stage(dealt.join(large, ["mask", "value"], "left_semi").select("mask", "fp").distinct(), "simhash-rows")
    return found


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, fp, component_id), a row for each row of ``docs``.

    Copies share a fingerprint, so they are one row before any shuffle by block; only distinct fingerprints are linked.
    """
    marked = write_stage(fingerprints(docs, shingle), "simhash-marked")
    classes = write_stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    return components_of(marked, classes, link_fingerprints(classes, shard_rows), "simhash")


def components_of(marked: DataFrame, classes: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """(doc_id, fp, component_id) of the rows ``marked`` (doc_id, fp); ``classes`` (fp, first) has the smallest id of each ``fp``."""
    labels = connected(links, name)
    joined = labels.join(classes.withColumnRenamed("fp", "vertex"), "vertex")
    least = write_stage(joined.groupBy("label").agg(F.min("first").alias("least")), f"{name}-least")
    linked = write_stage(labels.join(least, "label").select(F.col("vertex").alias("fp"), "least"), f"{name}-linked")
    named = classes.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    named = write_stage(named, f"{name}-named")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document left of each group: the one with the smallest doc_id.

    Rows that share their doc_id and fingerprint are copies of one document, of which one stays; documents without an id
    stay once for each fingerprint of a group without any id.
    """
    return one_of_each(docs, simhash_groups(docs), lambda data: _signed(fingerprint(data)))


def one_of_each(docs: DataFrame, groups: DataFrame, code: Callable[[bytes], int]) -> DataFrame:
    """The rows of ``docs`` that name their group in ``groups`` (doc_id, fp, component_id); ``code`` gives a text's signed ``fp``."""
    groups = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = write_stage(groups.select("doc_id", "fp").distinct(), "simhash-kept")
    twice = kept.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty()
    if twice:
        once = docs.join(kept.select("doc_id"), "doc_id", "left_semi")
        return once.dropDuplicates(["doc_id"]).select(docs.columns)
    name = unused(docs, "fp")
    marked = fingerprints_of(docs, name, code)
    same = marked["doc_id"].eqNullSafe(kept["doc_id"]) & (marked[name] == kept["fp"])
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", name]).drop(name)


def fingerprints_of(docs: DataFrame, name: str, code: Callable[[bytes], int]) -> DataFrame:
    """All columns of ``docs`` and the code of the text as ``name``."""
    schema = StructType([*docs.schema.fields, StructField(name, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            codes = [code((x.as_py() or "").encode()) for x in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.int64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    groups = simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")
