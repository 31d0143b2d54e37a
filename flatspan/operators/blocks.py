"""Training rows as blocks of numbers, which fits scan again and again.

A block holds some rows: their features, the bin of each feature, the label, and the values of the split columns that say which fits a
row belongs to.  Many fits (folds, seeds, grid points) run side by side over the same blocks: a ``Fit`` names the rows it
leaves out and the rows it is scored on, so one scan serves all of them.  Blocks are written to the shared folder once.

Fits are many small jobs over the same blocks, whose partial sums are added along a tree; they are scanned as an RDD of blocks, as a
job that has to be planned takes three to four times as long there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatspan.session import write_stage

BLOCK_ROWS = 4096
#: Rows of a task, once there are enough for all tasks.
TASK_ROWS = 1 << 17
#: Bins of a feature: edges are quantiles of the rows, with a rank error of at most one in ``ACCURACY``.
BINS = 32
ACCURACY = 10_000
#: Features whose quantiles are taken in one pass.
QUANTILE_COLUMNS = 200

#: Features of fewer bins may be bundled: so many at a time, of no more combinations.
NARROW, NARROW_FEATURES, COMBINATIONS = 4, 31, 4096

COLUMNS = "block long, n int, x binary, bins binary, y binary, splits binary"


@dataclass(frozen=True)
class Fit:
    """A fit: the values (split column, value) of the rows it leaves out, and the one of the rows it is scored on."""

    out: tuple[tuple[str, int], ...] = ()
    held: tuple[str, int] | None = None


@dataclass
class Block:
    """One block, unpacked."""

    block: int
    n: int
    x: np.ndarray  # rows x features
    bins: np.ndarray  # features x rows
    y: np.ndarray
    splits: dict[str, np.ndarray]

    def member(self, fit: Fit) -> np.ndarray:
        inside = np.ones(self.n, bool)
        for column, value in fit.out:
            inside &= self.splits[column] != value
        return inside

    def held(self, fit: Fit) -> np.ndarray:
        return self.splits[fit.held[0]] == fit.held[1] if fit.held else np.zeros(self.n, bool)


@dataclass
class Blocks:
    """``frame`` (``COLUMNS``) holds the blocks as they are written, ``rdd`` unpacked."""

    frame: DataFrame
    rdd: RDD
    features: int
    splits: list[str]
    edges: list[np.ndarray]
    n_classes: int  # 0 for numbers
    n_rows: int

    def release(self) -> None:
        self.rdd.unpersist()


def unpack(block: int, n: int, data: list, features: int, splits: list[str]) -> Block:
    x, bins, y, by = (np.frombuffer(v, t) for v, t in zip(data, ("<f8", "u1", "<f8", "<i2"), strict=True))
    values = dict(zip(splits, by.reshape(len(splits), n), strict=True)) if splits else {}
    return Block(block, n, x.reshape(n, features), bins.reshape(features, n), y, values)


def unpacked(batches: Iterator[pa.RecordBatch], features: int, splits: list[str]) -> Iterator[Block]:
    """Every block of some batches of ``COLUMNS``."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield unpack(batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), [batch.column(c)[i].as_buffer() for c in range(2, 6)], features, splits)


def add(a: list | None, b: list | None) -> list | None:
    if a is None or b is None:
        return b if a is None else a
    return [x + y for x, y in zip(a, b, strict=True)]


def sum_over(rdd: RDD, visit: Callable[[Iterable], list[np.ndarray] | None], at_once: bool = False) -> list[np.ndarray] | None:
    """The sums of what ``visit`` makes of the blocks of each task, added along a tree, or by the driver where it may have those of all
    tasks at once; None without blocks."""
    parts = rdd.mapPartitions(lambda it: [visit(it)])
    return reduce(add, parts.collect(), None) if at_once else parts.treeAggregate(None, add, add)


def bin_edges(frame: DataFrame, features: int) -> list[np.ndarray]:
    """Up to ``BINS`` - 1 rising edges of every feature; bin b holds what is above edge b - 1 and not above edge b."""
    shares = [i / BINS for i in range(1, BINS)]
    x = frame.select(vector_to_array("features").alias("x"))
    edges: list[np.ndarray] = []
    for at in range(0, features, QUANTILE_COLUMNS):
        some = range(at, min(at + QUANTILE_COLUMNS, features))
        row = x.agg(*[F.percentile_approx(F.get("x", F.lit(i)), shares, ACCURACY).alias(f"q{i}") for i in some]).collect()[0]
        edges += [np.unique(np.array(row[f"q{i}"] or [], float)) for i in some]
    return edges


def make_blocks(frame: DataFrame, id_col: str, splits: list[str], n_classes: int) -> Blocks:
    """Blocks of ``frame`` (features, label, split columns of small whole numbers; null is -1)."""
    spark = frame.sparkSession
    first = frame.select(F.size(vector_to_array("features")).alias("d")).first()
    features, n_rows = (first["d"] if first else 0), frame.count()
    edges = bin_edges(frame, features)
    tasks = max(min(spark.sparkContext.defaultParallelism, -(-n_rows // BLOCK_ROWS)), -(-n_rows // TASK_ROWS), 1)
    by = F.array(*[F.coalesce(F.col(c).cast("short"), F.lit(-1).cast("short")) for c in splits]) if splits else F.array().cast("array<short>")
    placed = F.xxhash64(id_col) if id_col in frame.columns else F.xxhash64(vector_to_array("features"), "label")
    rows = frame.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"), by.alias("s"), placed.alias("h"))
    rows = rows.repartition(tasks, "h").sortWithinPartitions("h").withColumn("part", F.spark_partition_id()).drop("h")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(at, BLOCK_ROWS)
                n = some.num_rows
                x = some.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, features)
                bins = np.array([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], np.uint8).reshape(features, n)
                y, s = some.column(1).to_numpy(zero_copy_only=False), some.column(2).flatten().to_numpy(zero_copy_only=False)
                s = s.astype("<i2").reshape(n, len(splits)).T
                block = (some.column(3)[0].as_py() << 32) + number
                number += 1
                data = [x.astype("<f8").tobytes(), bins.tobytes(), y.astype("<f8").tobytes(), s.tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([n], pa.int32()), *[pa.array([v], pa.binary()) for v in data]],
                    names=[c.split()[0] for c in COLUMNS.split(", ")],
                )

    blocks = write_stage(rows.mapInArrow(pack, COLUMNS), "blocks")
    rdd = blocks.rdd.map(lambda r: unpack(r[0], r[1], r[2:], features, splits)).persist(StorageLevel.MEMORY_AND_DISK)
    return Blocks(blocks, rdd, features, splits, edges, n_classes, n_rows)


@dataclass
class Bundle:
    """Features with few bins that are summed as one column: ``keys`` are the bins that occur together, ``codes`` x features unpacked."""

    features: np.ndarray
    keys: np.ndarray
    bins: np.ndarray

    def column(self, bins: np.ndarray) -> np.ndarray:
        """The code of every row of a block's bins."""
        return np.searchsorted(self.keys, packed(bins[self.features])).astype(np.uint8)


def packed(bins: np.ndarray) -> np.ndarray:
    """One number for the bins of each row (features x rows; below ``NARROW``)."""
    out = np.zeros(bins.shape[1], np.int64)
    for x in bins:
        out = out * NARROW + x
    return out


def bundles(blocks: Blocks) -> list[Bundle]:
    """Features of fewer than ``NARROW`` bins, put together as long as no more than ``BINS`` combinations of their bins occur in the rows."""
    narrow = np.array([j for j, e in enumerate(blocks.edges) if len(e) < NARROW], int)
    out: list[Bundle] = []
    for at in range(0, len(narrow), NARROW_FEATURES):
        some = narrow[at : at + NARROW_FEATURES]

        def visit(task: Iterable[Block], some: np.ndarray = some) -> list[np.ndarray]:
            found = np.zeros(0, np.int64)
            for b in task:
                found = np.union1d(found, packed(b.bins[some]))
                if len(found) > COMBINATIONS:
                    break
            return [found[: COMBINATIONS + 1]]

        seen = reduce(np.union1d, (x[0] for x in blocks.rdd.mapPartitions(lambda it, visit=visit: [visit(it)]).collect()), np.zeros(0, np.int64))
        if len(seen) > COMBINATIONS or not len(seen):
            continue  # hardly any go together
        rows = np.array([seen // NARROW ** (len(some) - 1 - i) % NARROW for i in range(len(some))])  # features x combinations
        begin = 0
        while begin < len(some):
            end = begin + 1
            while end < len(some) and len(np.unique(packed(rows[begin : end + 1]))) <= BINS:
                end += 1
            if end - begin > 1:
                keys, first = np.unique(packed(rows[begin:end]), return_index=True)
                out.append(Bundle(some[begin:end], keys, rows[begin:end, first].T))
            begin = end
    return out


def add_up(parts: DataFrame) -> DataFrame:
    """Sum the binary double arrays ``sums`` of equal ``key`` over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(0)
        for batch in batches:
            for key, sums in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(sums.as_buffer())
                if key == now:
                    total += part
                    continue
                if now is not None:
                    yield keyed([now], [total])
                now, total = key, part.copy()
        if now is not None:
            yield keyed([now], [total])

    return parts.repartition("key").sortWithinPartitions("key").mapInArrow(run, "key int, sums binary")


def keyed(keys: list[int], sums: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([s.tobytes() for s in sums], pa.binary())], names=["key", "sums"])


def class_counts(blocks: Blocks, fits: list[Fit]) -> np.ndarray:
    """Rows of each class (one for numbers) that each fit is made on: fits x classes."""
    k, classify = max(blocks.n_classes, 1), blocks.n_classes > 0

    def visit(task: Iterable[Block]) -> list[np.ndarray]:
        total = np.zeros((len(fits), k))
        for b in task:
            label = b.y.astype(int) if classify else np.zeros(b.n, int)
            for m, fit in enumerate(fits):
                total[m] += np.bincount(label[b.member(fit)], minlength=k)
        return [total]

    return (sum_over(blocks.rdd, visit) or [np.zeros((len(fits), k))])[0]


def balanced(counts: np.ndarray, n_classes: int) -> np.ndarray:
    """Weight of a row of each class in each fit, so that classes weigh the same and weights add up to the rows; ones for numbers."""
    if not n_classes:
        return np.ones_like(counts)
    there = np.maximum((counts > 0).sum(axis=1, keepdims=True), 1)
    return np.where(counts > 0, counts.sum(axis=1, keepdims=True) / (there * np.maximum(counts, 1)), 0.0)
