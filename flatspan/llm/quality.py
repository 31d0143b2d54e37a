"""A quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

The n-grams are words, their shapes (letters in small or capitals, digits, marks; runs are one sign) and the pairs of
neighbouring words and shapes; a pair of equal words is one n-gram of its own.  Each is hashed to one of ``DIMENSIONS`` weights,
and a text's score is the sparse dot product of its n-gram shares with the weights.

Training reads at most ``TRAIN_ROWS`` labelled texts, chosen by the hash of their id: the documented bound of the model, not of
what is scored.  Tasks train on parts of them side by side, and their states are averaged after each of ``ROUNDS`` rounds.  The
model is one vector of fixed size, so it may pass the driver; scoring is one pass without a shuffle.

Defined results: a null or empty text scores as the bias alone; a text of any length is scored whole, a part at a time; labels
other than 0 and 1, null ids and ids with contradicting labels are not learned from; with no labels every score is 0.5; an empty table gives no
rows.  Columns other than doc_id and text are never read, nor are labels for scoring.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from flatspan.llm import unused
from flatspan.session import write_stage

DIMENSIONS = 1 << 18
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
PARTS = 8
ROUNDS = 4
#: What n-gram shares are multiplied by, so that a text's inputs are of the size of one.
SCALE = 30.0
#: Learning rate, its offset, and the penalties of the updates.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-5, 1e-6
#: Of five folds by the CRC of the id, the first is held out.
FOLDS = 5

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_BLANK = re.compile(r"\s")
_BLOCK = 1 << 20
_BIAS = 0


class Hasher:
    """Hashed n-grams of texts.  Words are looked up in a table that is emptied when it is full, and at the end of a task."""

    def __init__(self, limit: int = 1 << 16) -> None:
        self.limit, self.known = limit, {}

    def _look(self, word: str) -> int:
        if len(self.known) >= self.limit:
            self.known.clear()
        signs = ["0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in word]
        shape = "".join(c for c, before in zip(signs, [""] + signs, strict=False) if c != before)
        code = zlib.crc32(word.encode("utf-8", "replace")) | zlib.crc32(b"\0" + shape.encode("utf-8", "replace")) << 32
        self.known[word] = code
        return code

    def ngrams(self, text: str) -> np.ndarray:
        """The place of every n-gram of the text, repeats included; never the bias's."""
        return self.places(_TOKEN.findall(text))

    def places(self, words: list[str], seen: int = 0) -> np.ndarray:
        """The places of the n-grams of some words, of which the first ``seen`` only begin pairs."""
        known, look = self.known, self._look
        codes = np.array([known[w] if w in known else look(w) for w in words], np.uint64)
        word, shape = codes & np.uint64(0xFFFFFFFF), codes >> np.uint64(32)
        same = word[1:] == word[:-1]
        pair = np.where(same, np.uint64(7), word[1:] * np.uint64(0x9E3779B1) + word[:-1])
        shapes = (shape[1:] * np.uint64(0x85EBCA6B) + shape[:-1]) ^ np.uint64(0x5BD1E995)
        every = np.concatenate([word[seen:], shape[seen:], pair, shapes]) * np.uint64(0x9E3779B97F4A7C15)
        return (every >> np.uint64(20)) % np.uint64(DIMENSIONS - 1) + np.uint64(1)

    def blocks(self, text: str | None) -> Iterator[np.ndarray]:
        """The places of a text, about ``_BLOCK`` signs of it at a time; no word is cut and no pair is lost."""
        text, at, last = text or "", 0, []
        while at < len(text):
            end = at + _BLOCK
            if end < len(text):
                blank = _BLANK.search(text, end)
                end = blank.start() if blank else len(text)
            words = last + _TOKEN.findall(text, at, end)
            yield self.places(words, len(last)).astype(np.int64)
            last, at = words[-1:], end


def release(hasher: Hasher) -> None:
    """Give back what a task has held, as workers live on for other tasks."""
    hasher.known.clear()
    pa.default_memory_pool().release_unused()


def mean_weight(blocks: Iterator[np.ndarray], weights: np.ndarray) -> float:
    """The sparse dot product of a text's n-gram shares with the weights, and the bias."""
    total, n = 0.0, 0
    for places in blocks:
        total += float(weights[places].sum(dtype=np.float64))
        n += len(places)
    return float(weights[_BIAS]) + (SCALE * total / n if n else 0.0)


def shares(blocks: Iterator[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The places of a text's n-grams and the scaled share of each, the bias with one first."""
    places, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for block in blocks:
        at, of = np.unique(np.concatenate([places, block]), return_inverse=True)
        counts = np.bincount(of, weights=np.concatenate([counts, np.ones(len(block), np.int64)]), minlength=len(at))
        places = at
    return np.r_[_BIAS, places], np.r_[1.0, SCALE * counts / max(counts.sum(), 1)]


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def train_once(rows: list[tuple[np.ndarray, np.ndarray, float]], z: np.ndarray, n: np.ndarray) -> None:
    """One pass of the updates over rows (places, shares, label); ``z`` and ``n`` are the state of each weight."""
    for places, share, label in rows:
        w = weights_of(z[places], n[places])
        score = 1 / (1 + np.exp(-np.clip((w * share).sum(), -35, 35)))
        gradient = (score - label) * share
        grown = n[places] + gradient * gradient
        z[places] += gradient - (np.sqrt(grown) - np.sqrt(n[places])) / ALPHA * w
        n[places] = grown


def held_out(doc_id) -> object:
    """Whether the CRC of an id as text leaves no remainder by the number of folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(label, text) of the labelled rows that may be learned from, at most about ``train_rows`` of them."""
    label = F.col("quality").cast("int")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), label.alias("label")).where("doc_id is not null and label in (0, 1)")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    known = write_stage(known.where("label = other").select("doc_id", "label"), "quality-labels")
    n = known.count()
    if n > train_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * train_rows / n))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(known), "doc_id").select("doc_id", "label", "text")  # bounded by train_rows


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """The weights, bias first."""
    spark = docs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            found = [shares(hasher.blocks(x.as_py())) for x in batch.column(2)]
            places = pa.array([p.astype(np.int32).tobytes() for p, _ in found], pa.binary())
            share = pa.array([s.astype(np.float64).tobytes() for _, s in found], pa.binary())
            names = ["doc_id", "label", "places", "shares"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), places, share], names=names)
        release(hasher)

    rows = training_rows(docs, labels, train_rows).mapInArrow(count, "doc_id long, label int, places binary, shares binary")
    rows = write_stage(rows.withColumn("part", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(PARTS)).cast("int")), "quality-rows")
    state = np.zeros((2, DIMENSIONS), np.float32)
    for _ in range(ROUNDS):
        start = spark.sparkContext.broadcast(state)  # of fixed size

        def train(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            z, n = start.value.astype(np.float64)
            seen = 0
            for batch in batches:
                data = []
                for label, places, share in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                    data.append((np.frombuffer(places.as_py(), np.int32), np.frombuffer(share.as_py()), float(label.as_py())))
                train_once(data, z, n)
                seen += len(data)
            if seen:
                yield pa.RecordBatch.from_pydict({"n": [seen], "state": [np.stack([z, n]).astype(np.float32).tobytes()]})

        dealt = rows.repartition(PARTS, "part").sortWithinPartitions("part", F.xxhash64("doc_id"), "doc_id", "label")
        states = dealt.select("doc_id", "label", "places", "shares").mapInArrow(train, "n long, state binary").collect()  # PARTS rows of fixed size
        if not states:
            break
        total = sum(r["n"] for r in states)
        state = sum(np.frombuffer(r["state"], np.float32).reshape(2, -1) * np.float32(r["n"] / total) for r in states)
        start.unpersist()
    return weights_of(*state.astype(np.float64))


def score(docs: DataFrame, weights: np.ndarray, name: str) -> DataFrame:
    """All columns of ``docs`` and the score as ``name``."""
    model = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, w = Hasher(), model.value
        for batch in batches:
            raw = [mean_weight(hasher.blocks(x.as_py()), w) for x in batch.column(batch.schema.get_field_index("text"))]
            out = 1 / (1 + np.exp(-np.clip(np.array(raw), -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, name])
        release(hasher)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def drop_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with the columns they have."""
    name = unused(docs, "score")
    return score(docs, fit(docs, labels), name).where(F.col(name) >= threshold).drop(name)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    weights = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, weights, "score")
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
