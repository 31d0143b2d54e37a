"""Removal of repeated byte strings: every byte covered by a string of 200 bytes that also starts anywhere else.

A corpus is too large for one suffix array, so its suffixes are dealt into shards in which equal strings of 200 bytes meet.  Every
string is filed under its anchor: of the substrings of ``GRAM`` bytes in it, the one with the smallest hash, which equal strings have
in common.  A run is the strings of a text that follow each other with one anchor.  Runs whose anchor nowhere else occurs
hold nothing repeated and go no further.  Equal runs are one run with a count before any bytes are shuffled (two hashes
of 64 bits tell them apart), and the bytes of those that share their anchor with other runs are dealt by
anchor to shards, where a suffix array built by induced sorting and its permuted common prefixes tell the strings that start more than
once (``suffixes.py``).  An anchor with more than ``SHARD_RUNS`` different runs is dealt again by longer anchors, each for half of the
strings, until groups are small or the anchor is the whole string.

Defined results: a null text is empty; texts shorter than a string keep all bytes; matches never cross texts; equal rows repeat each
other; a null doc_id is a row like any other; an empty table gives no rows.  Only doc_id and text are read.  Texts of any length are read whole, some 1 MB at a time.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatspan.llm.suffixes import repeated_starts
from flatspan.session import write_stage

#: Bytes of a string, and of the substrings among which its anchor is chosen.
LENGTH = 200
GRAM = 64
#: Different runs of an anchor that are sorted together, and bytes of the runs of a suffix array.
SHARD_RUNS = 4096
SHARD_BYTES = 2 << 20
#: Strings whose anchors are found together.
CHUNK = 1 << 16
_PLACE_BITS = 17
_BASES = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1)


@functools.lru_cache(maxsize=2)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2 ** 64."""
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, base, np.uint64)], dtype=np.uint64)
        down = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, inverse, np.uint64)], dtype=np.uint64)
    return up, down


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(32)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(29))


def runs(data: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """The runs of a text, a chunk at a time: (hash of the anchor, hash of the run, first start, anchor less first start, starts)."""
    top = CHUNK + length
    window = length - gram + 1
    (up, down), (up2, down2) = (_powers(b, top + 1) for b in _BASES)
    whole = np.frombuffer(data, np.uint8)
    for base in range(0, len(whole) - length + 1, CHUNK):
        x = whole[base : base + CHUNK - 1 + length].astype(np.uint64)
        n = len(x)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((x + np.uint64(1)) * up[:n], out=sums[1:])
        hashes = _mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
        bits = np.uint64(_PLACE_BITS)
        least = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)  # ties go to the left
        width = 1
        while width < window:
            step = min(width, window - width)
            least = np.minimum(least[: len(least) - step], least[step:])
            width += step
        anchor = (least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        after = np.r_[first[1:], len(anchor)]
        at = anchor[first]
        np.cumsum((x + np.uint64(1)) * up2[:n], out=sums[1:])
        content = _mix((sums[after - 1 + length] - sums[first]) * down2[first])
        yield hashes[at].view(np.int64), content.view(np.int64), base + first, at - first, after - first


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, check, text): two hashes tell texts apart."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("key"), F.hash("text").cast("long").alias("check"), "text")


def anchors(docs: DataFrame) -> DataFrame:
    """(hash, run, key, check, start, shape) of every run; ``shape`` holds the anchor's distance and the number of starts."""
    schema = "hash long, run long, key long, check long, start long, shape int"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key, check, text in zip(batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2), strict=True):
                for hashes, content, first, back, n in runs(text.as_py()):
                    found.append((hashes, content, np.full(len(n), key), np.full(len(n), check), first, (back << 8 | n - 1).astype(np.int32)))
                    if len(found) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=names)
                        found = []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=names)

    long_enough = keyed(docs).where(F.octet_length("text") >= LENGTH)
    return long_enough.select("key", "check", "text").mapInArrow(run, schema)


PIECE = "shard long, hash long, run long, shape int, copies long, first int, n int, anchor int, width int, bytes binary"


def run_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``PIECE`` rows of the runs ``wanted`` (doc_id, key, check, runs), from the texts that hold them."""
    names = [x.split()[0] for x in PIECE.split(", ")]
    wanted = wanted.withColumnRenamed("doc_id", "of")
    same = ["key", "check"]
    rows = keyed(docs).join(wanted, same).where(F.col("doc_id").eqNullSafe(F.col("of"))).select("runs", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for some, text in zip(batch.column(0), batch.column(1), strict=True):
                data = text.as_py()
                for r in some.as_py():
                    back, n = r["shape"] >> 8, (r["shape"] & 255) + 1
                    part = data[r["start"] : r["start"] + n - 1 + LENGTH]
                    out.append((r["hash"], r["hash"], r["run"], r["shape"], r["copies"], 0, n, back, GRAM, part))
                    size += len(part)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out, strict=True)), strict=True)), schema=_PIECE_TYPES)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out, strict=True)), strict=True)), schema=_PIECE_TYPES)

    return rows.mapInArrow(run, PIECE)


_PIECE_TYPES = pa.schema(
    [(x.split()[0], {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[x.split()[1]]) for x in PIECE.split(", ")]
)


def halved(pieces: DataFrame) -> DataFrame:
    """Each piece as two, under anchors longer by half of what a string leaves free: to the left for the strings that reach further to
    the left of the anchor, else to the right."""
    left = F.ceil((LENGTH - F.col("width")) / 2).cast("int")
    right = F.lit(LENGTH) - F.col("width") - left + 1
    # Starts i of a piece lie anchor - i bytes left of the anchor.
    cut = F.greatest(F.lit(0), F.least(F.col("n"), F.col("anchor") - left + 1))
    one = F.struct(F.lit(0).alias("from"), cut.alias("to"), (F.col("anchor") - left).alias("anchor"), (F.col("width") + left).alias("width"))
    two = F.struct(cut.alias("from"), F.col("n").alias("to"), F.col("anchor").alias("anchor"), (F.col("width") + right).alias("width"))
    rows = pieces.select("hash", "run", "shape", "copies", "first", "bytes", F.explode(F.array(one, two)).alias("x")).where("x.from < x.to")
    part = F.substring("bytes", F.col("x.from") + 1, F.col("x.to") - F.col("x.from") - 1 + LENGTH)
    rows = rows.select(
        "hash", "run", "shape", "copies",
        (F.col("first") + F.col("x.from")).alias("first"), (F.col("x.to") - F.col("x.from")).alias("n"),
        (F.col("x.anchor") - F.col("x.from")).alias("anchor"), F.col("x.width").alias("width"), part.alias("bytes"),
    )
    shard = F.xxhash64("hash", "width", F.substring("bytes", F.col("anchor") + 1, F.col("width")))
    return rows.select(shard.alias("shard"), *rows.columns)


JUDGED = "hash long, run long, shape int, low int, high int"


def sorted_shards(pieces: DataFrame) -> DataFrame:
    """``JUDGED`` ranges of starts (within their runs) that are repeated among the pieces of their shard."""

    def judge(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        hits = repeated_starts(table.column("bytes").to_pylist(), LENGTH)
        keys = [table.column(c).to_numpy() for c in ("hash", "run", "shape", "first", "copies")]
        out = [[], [], [], [], []]
        for i, hit in enumerate(hits):
            if keys[4][i] == 1 and hit.any():
                edge = np.flatnonzero(np.diff(np.r_[False, hit, False]))
                for low, high in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                    for column, value in zip(out, (keys[0][i], keys[1][i], keys[2][i], keys[3][i] + low, keys[3][i] + high), strict=True):
                        column.append(value)
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["hash", "run", "shape", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in (x for x in batches if x.num_rows):
            shard = batch.column(0).to_numpy()
            lengths = np.diff(np.frombuffer(batch.column(9).buffers()[1], np.int32)[batch.column(9).offset :][: len(shard) + 1])
            begins = np.flatnonzero(np.r_[last is None or shard[0] != last, shard[1:] != shard[:-1]])
            done, sums = 0, np.r_[0, np.cumsum(lengths)]
            for at in begins.tolist():  # a suffix array holds whole shards
                if size + sums[at] - sums[done] >= SHARD_BYTES:
                    if at > done:
                        held.append(batch.slice(done, at - done))
                    if held:
                        yield judge(held)
                    held, size, done = [], 0, at
            held.append(batch.slice(done))
            size += sums[-1] - sums[done]
            last = shard[-1]
        if held:
            yield judge(held)

    return pieces.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, JUDGED)


def judged_pieces(pieces: DataFrame, shard_runs: int = SHARD_RUNS) -> DataFrame:
    """``JUDGED`` of all pieces; shards that are too large are dealt again by longer anchors."""
    found, width = None, GRAM
    while True:
        if width == LENGTH:  # a shard is one string now
            sizes = pieces.groupBy("shard", "bytes").agg(F.count("*").alias("size"))
            sizes = write_stage(sizes.where("size > 1").select("shard", "bytes"), "suffix-sizes")
            same = pieces.join(sizes, ["shard", "bytes"], "left_semi").where("copies = 1")
            return found.union(same.select("hash", "run", "shape", F.col("first").alias("low"), (F.col("first") + F.col("n")).cast("int").alias("high")))
        sizes = pieces.groupBy("shard").agg(F.count("*").alias("size"))
        large = write_stage(sizes.where(F.col("size") > shard_runs).select("shard"), "suffix-large")
        none = large.isEmpty()
        small = sorted_shards(pieces if none else pieces.join(large, "shard", "left_anti"))
        found = small if found is None else found.union(small)
        if none:
            return found
        pieces = write_stage(halved(pieces.join(large, "shard", "left_semi")), "suffix-halved")
        width += -(-(LENGTH - width) // 2)  # the longer of the two new anchors: the other is as long or one byte longer


def repeated_spans(docs: DataFrame, shard_runs: int = SHARD_RUNS) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): (key, check, copies, doc_id, n_bytes, full_hash) of each text, and (key, check, spans) of the texts that
    hold strings which start elsewhere too; spans are ranges of starts."""
    of = ["key", "check"]
    found = write_stage(anchors(docs), "suffix-anchors")
    many = write_stage(found.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "suffix-many")
    # Written before copies are dropped: an aggregate right behind the join would keep a frequent anchor in one task.
    kept = write_stage(found.join(many, "hash", "left_semi"), "suffix-repeated")
    kept = write_stage(kept.distinct(), "suffix-kept")  # copies of a text are one text
    place = F.struct("key", "check", "start")
    same = kept.groupBy("hash", "run", "shape").agg(F.count("*").alias("copies"), F.min(place).alias("at"))
    same = write_stage(same, "suffix-runs")
    shared = write_stage(same.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "suffix-shared")
    compared = same.join(shared, "hash", "left_semi")

    texts = keyed(docs).select("doc_id", *of, F.octet_length("text").cast("long").alias("n_bytes"))
    texts = write_stage(texts.groupBy(*of).agg(F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes")), "suffix-texts")
    item = F.struct(F.col("at.start").alias("start"), "hash", "run", "shape", "copies")
    wanted = compared.groupBy("at.key", "at.check").agg(F.collect_list(item).alias("runs"))
    wanted = write_stage(wanted.join(texts.select(*of, "doc_id"), of), "suffix-wanted")
    pieces = write_stage(run_bytes(docs, wanted).dropDuplicates(["hash", "run", "shape"]), "suffix-pieces")
    everywhere = same.where("copies > 1").select("hash", "run", "shape", F.lit(0).alias("low"), F.expr("shape & 255").cast("int") + 1)
    judged = write_stage(judged_pieces(pieces, shard_runs).union(everywhere), "suffix-judged")
    spans = kept.join(judged, ["hash", "run", "shape"]).select(*of, F.struct((F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high")).alias("x"))
    return texts, write_stage(spans.groupBy(*of).agg(F.sort_array(F.collect_list("x")).alias("spans")), "suffix-spans")


def removed_runs(spans: list[dict], length: int = LENGTH) -> list[tuple[int, int]]:
    """The maximal runs of bytes that the strings starting in ``spans`` (sorted) cover."""
    out: list[tuple[int, int]] = []
    for x in spans:
        low, high = x["low"], x["high"] - 1 + length
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], high)
        else:
            out.append((low, high))
    return out


def remove_repeats(docs: DataFrame, shard_runs: int = SHARD_RUNS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), a row for each row of ``docs``."""
    of = ["key", "check"]
    texts, spans = repeated_spans(docs, shard_runs)
    rows = keyed(docs).select("doc_id", *of, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("full"))
    fate = texts.select(*of, "copies").join(spans.select(*of, F.lit(True).alias("cut")), of, "left")
    fate = write_stage(fate.where("copies > 1 or cut"), "suffix-fate")
    plain = rows.join(fate, of, "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)  # every string starts in the copies too
    zero = F.lit(0).cast("long")
    plain = plain.where(whole | F.col("cut").isNull() | F.col("copies").isNull()).select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(zero).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(zero).alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256().hexdigest())).otherwise(F.col("full")).alias("kept_sha256"),
    )
    single = spans.join(texts.where("copies = 1").select(*of), of, "left_semi")
    cut = keyed(docs).join(write_stage(single, "suffix-single"), of).select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, some in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                data, at, kept, gone = text.as_py(), 0, hashlib.sha256(), removed_runs(some.as_py())
                for low, high in gone:
                    kept.update(data[at:low])
                    at = high
                kept.update(data[at:])
                out.append((doc, len(data), sum(b - a for a, b in gone), len(gone), kept.hexdigest()))
            if out:
                columns = list(zip(*out, strict=True))
                arrays = [pa.array(c, pa.string() if i == 4 else pa.int64()) for i, c in enumerate(columns)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return plain.unionByName(cut.mapInArrow(run, schema))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
