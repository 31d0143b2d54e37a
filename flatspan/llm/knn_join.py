"""Exact top-k by integer inner product: a Voronoi kNN join of a set of query rows with all rows.

Vectors become integers, floor(64 c).  With one more entry, sqrt(m - |x|^2) for candidates (m the largest squared length) and 0 for queries,
a larger inner product is a smaller Euclidean distance, so the bounds of a metric hold.  Queries are grouped by their nearest
pivot.  A summary of one pass holds, for each pivot, the distance of the (k+1)-th nearest candidate row and of its farthest query; by
the triangle inequality a candidate is needed by a pivot's queries only if it is no farther from the pivot than the first and twice
the second.  Cells of queries are gathered into groups, a large cell into several; a candidate is sent once to each group that needs
it, and each group is solved, a shard of its candidates at a time, with exact scores.  The best of the shards are merged.

Copies of a vector are one class: only the k+1 smallest ids of a class can be among the first k of any query, and queries that are
copies are solved once.  Pivots come from a bounded sample (``SAMPLE``); results do not depend on it, nor on any other parameter.

Defined results: a vector that is null or holds null or non-finite components takes no part, nor does a row without vec_id; shorter
vectors (empty ones too) count as padded with zeros; components beyond 2^52 / 64 count as that; rows are told apart even if they are equal, so a
query's own row is left out once; ties go to the smaller vec_id; an empty table or no queries give no rows; a score that no long
holds is an error.  Columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flatspan.session import write_stage

K = 20
EVERY = 20
UNIT, LARGEST = 64, 1 << 52
#: Pivots (a bit of a long each), the vectors they are chosen from, and the rounds of that.
PIVOTS, SAMPLE, ROUNDS = 64, 4096, 5
#: Distinct queries of a group, and candidates of a shard of it.
GROUP_QUERIES, SHARD_ROWS = 8192, 65_536
#: Scores that a task holds at once.
SCORES = 1 << 21
#: What rounding may add to a distance, as a share of the largest length.
SLACK = 1e-5

RESULT = "query_id long, rank int, vec_id long, score long"


@dataclass
class Shape:
    """What tasks need to read packed vectors: their dimension and type, the largest component and squared length."""

    dim: int
    dtype: str
    largest: int
    squared: float

    def read(self, column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), self.dtype).reshape(len(column), self.dim)

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Vectors with the entry that turns products into distances."""
        x = x.astype(np.float64)
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.squared - (x * x).sum(axis=1), 0.0))
        return np.column_stack([x, more])

    def numbers(self, x: np.ndarray) -> np.ndarray:
        """Vectors whose inner products are exact: doubles where these hold every sum, else longs."""
        return x.astype(np.float64 if self.dim * self.largest * self.largest < 1 << 53 else np.int64)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(square, 0.0))


# --- classes, queries, pivots ----------------------------------------------------------------------


def packed(vectors: DataFrame, chosen: Column) -> tuple[DataFrame, Shape] | None:
    """(vec_id, vec, chosen) of the rows that take part, and the shape of ``vec``; None where there are none."""
    finite = F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))
    bound = float(LARGEST)
    floor = lambda c: F.floor(F.greatest(F.least(UNIT * c, F.lit(bound)), F.lit(-bound)))
    rows = rows.select("vec_id", F.transform("e", floor).alias("x"), F.coalesce(chosen, F.lit(False)).alias("chosen"))
    rows = write_stage(rows, "knn-integers")
    square = F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    seen = rows.agg(F.max(F.size("x")), F.min(F.array_min("x")), F.max(F.array_max("x")), F.max(square), F.count_if("chosen")).collect()[0]
    if not seen[4]:
        return None
    dim, least, most = max(seen[0], 1), min(seen[1] or 0, 0), max(seen[2] or 0, 0)
    largest = max(-least, most)
    if dim * largest * largest >= 1 << 63:
        raise OverflowError("inner products of these vectors do not fit a long")
    dtype = next(t for t in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(t).min <= least and most <= np.iinfo(t).max)
    shape = Shape(dim, dtype, largest, seen[3] * (1 + 1e-12))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), dim).astype(dtype)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in x], pa.binary()), batch.column(2)], names=["vec_id", "vec", "chosen"])

    padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), dim - F.size("x")))
    return rows.select("vec_id", padded.alias("x"), "chosen").mapInArrow(pack, "vec_id long, vec binary, chosen boolean"), shape


def choose_pivots(classes: DataFrame, shape: Shape, pivots: int) -> np.ndarray:
    """Centres of a bounded sample of the classes."""
    some = classes.select("v", "vec").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
    x = shape.lifted(shape.read(pa.array([bytes(r["vec"]) for r in some], pa.binary())))
    centres = x[:pivots]
    for _ in range(ROUNDS):
        near = distances(x, centres).argmin(axis=1)
        size = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
    return centres


def kth_distances(classes: DataFrame, shape: Shape, pivots: np.ndarray, k: int) -> np.ndarray:
    """For each pivot the distance of the k-th nearest candidate row, infinite where there are fewer."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((k, len(pivots)), np.inf)
        for batch in (x for x in batches if x.num_rows):
            gap = np.repeat(distances(shape.lifted(shape.read(batch.column(0))), pivots), batch.column(1).to_numpy(), axis=0)
            best = np.partition(np.concatenate([best, gap]), k - 1, axis=0)[:k]
        i, j = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(j.astype(np.int32)), pa.array(best[i, j])], names=["cell", "gap"])

    gaps = classes.select("vec", F.size("ids").alias("n")).mapInArrow(nearest, "cell int, gap double")
    ranked = gaps.withColumn("rank", F.row_number().over(Window.partitionBy("cell").orderBy("gap"))).where(F.col("rank") <= k)
    out = np.full(len(pivots), np.inf)
    for r in ranked.where(F.col("rank") == k).collect():  # at most one a pivot
        out[r["cell"]] = r["gap"]
    return out


def placed_queries(wanted: DataFrame, shape: Shape, pivots: np.ndarray) -> DataFrame:
    """(v, vec, cell, gap): the nearest pivot of every distinct query, and its distance."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for x in batches if x.num_rows):
            gap = distances(shape.lifted(shape.read(batch.column(1)), query=True), pivots)
            cell = gap.argmin(axis=1)
            columns = [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(gap[np.arange(len(cell)), cell])]
            yield pa.RecordBatch.from_arrays(columns, names=["v", "vec", "cell", "gap"])

    return wanted.select("v", "vec").mapInArrow(place, "v long, vec binary, cell int, gap double")


def deal_cells(counts: np.ndarray, pivots: np.ndarray, group_queries: int) -> tuple[np.ndarray, np.ndarray]:
    """(first group, number of groups) of every cell: near cells share a group until it is full, a large cell has several."""
    first, parts = np.zeros(len(counts), np.int64), np.maximum(1, -(-counts // group_queries))
    left, at, group, held = set(np.flatnonzero(counts).tolist()), None, 0, 0
    while left:
        rest = sorted(left)
        at = rest[0] if at is None else rest[int(distances(pivots[at : at + 1], pivots[rest])[0].argmin())]
        left.remove(at)
        if held and (parts[at] > 1 or held + counts[at] > group_queries):
            group, held = group + 1, 0
        first[at] = group
        if parts[at] > 1:
            group += parts[at]
        else:
            held += counts[at]
    return first, parts


# --- the join --------------------------------------------------------------------------------------

TASK = "place long, shard long, kind int, v long, vec_id long, cells long, vec binary"


def replicate(classes: DataFrame, shape: Shape, pivots: np.ndarray, reach: np.ndarray, first: np.ndarray, parts: np.ndarray, shards: int) -> DataFrame:
    """``TASK`` rows of the candidates for each group that needs them; ``cells`` has a bit for each cell that does."""
    cells = np.flatnonzero(reach >= 0)
    groups = int((first + parts)[cells].max())
    member = np.zeros((len(cells), groups), bool)
    for row, c in enumerate(cells.tolist()):
        member[row, first[c] : first[c] + parts[c]] = True
    bits = np.uint64(1) << cells.astype(np.uint64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for x in batches if x.num_rows):
            v, vec_id, vec = batch.columns
            need = distances(shape.lifted(shape.read(vec)), pivots[cells]) <= reach[cells]
            i, group = np.nonzero(need.astype(np.float32) @ member.astype(np.float32) > 0)
            mask = (need * bits).sum(axis=1, dtype=np.uint64).view(np.int64)
            number = v.to_numpy()
            shard = ((number.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(shards)
            columns = [pa.array(group), pa.array(shard.astype(np.int64)[i]), pa.array(np.ones(len(i), np.int32)), pa.array(number[i])]
            columns += [vec_id.take(pa.array(i)), pa.array(mask[i]), vec.take(pa.array(i))]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in TASK.split(", ")])

    return classes.select("v", F.explode("ids").alias("vec_id"), "vec").mapInArrow(send, TASK)


class Best:
    """The best ``k`` candidates of some queries; candidates come by rising vec_id, so that of equal scores the earlier ones stay."""

    def __init__(self, queries: np.ndarray, v: np.ndarray, bits: np.ndarray, shape: Shape, k: int) -> None:
        self.x, self.v, self.bits, self.shape, self.k = shape.numbers(queries), v, bits, shape, k
        self.found = [np.zeros(0, np.int64) for _ in range(4)]  # query, score, vec_id, v
        self.least = np.full(len(v), np.iinfo(np.int64).min)

    def take(self, x: np.ndarray, v: np.ndarray, vec_id: np.ndarray, cells: np.ndarray) -> None:
        step = max(1, SCORES // max(len(self.v), 1))
        for at in range(0, len(v), step):
            score = self.x @ self.shape.numbers(x[at : at + step]).T
            good = (cells[at : at + step] & self.bits[:, None]) != 0
            good &= score > self.least[:, None]
            if score.shape[1] > 2 * self.k:  # the k best of these are enough
                edge = np.partition(np.where(good, score, score.min()), score.shape[1] - self.k, axis=1)[:, score.shape[1] - self.k]
                good &= score >= edge[:, None]
            q, j = np.nonzero(good)
            if len(q):
                self.merge(q, score[q, j].astype(np.int64), vec_id[at + j], v[at + j])

    def merge(self, *new: np.ndarray) -> None:
        q, score, vec_id, v = (np.concatenate(x) for x in zip(self.found, new, strict=True))
        order = np.lexsort((v, vec_id, -score, q))
        q = q[order]
        start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        rank = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)]))
        order = order[rank < self.k]
        self.found = [np.concatenate(x)[order] for x in zip(self.found, new, strict=True)]
        size = np.bincount(self.found[0], minlength=len(self.v))
        lowest = np.full(len(self.v), np.iinfo(np.int64).max)
        np.minimum.at(lowest, self.found[0], self.found[1])
        self.least = np.where(size == self.k, lowest, self.least)

    def batch(self) -> pa.RecordBatch:
        q, score, vec_id, v = self.found
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.v[q], v, vec_id, score)], names=["query", "v", "vec_id", "score"])


def solve(tasks: DataFrame, shape: Shape, k: int) -> DataFrame:
    """(query, v, vec_id, score): the best k candidates of each query in each shard of its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, best = None, [], None
        for batch in (x for x in batches if x.num_rows):
            place, shard, kind = (batch.column(i).to_numpy() for i in range(3))
            cut = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])])
            for low, high in zip(cut.tolist(), [*cut[1:].tolist(), len(place)], strict=True):
                part = batch.slice(low, high - low)
                if now != (place[low], shard[low]):
                    if best is not None:
                        yield best.batch()
                    now, held, best = (place[low], shard[low]), [], None
                if kind[low] == 0:
                    held.append(part)
                    continue
                if best is None and held:
                    asked = pa.concat_batches(held)
                    best = Best(shape.read(asked.column(6)), asked.column(3).to_numpy(), asked.column(5).to_numpy(), shape, k)
                if best is not None:
                    best.take(shape.read(part.column(6)), *(part.column(i).to_numpy() for i in (3, 4, 5)))
        if best is not None:
            yield best.batch()

    dealt = tasks.repartition("place", "shard").sortWithinPartitions("place", "shard", "kind", "vec_id", "v")
    return dealt.mapInArrow(run, "query long, v long, vec_id long, score long")


def knn_join(vectors: DataFrame, chosen: Column, k: int = K, pivots: int = PIVOTS, group_queries: int = GROUP_QUERIES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``RESULT``: for every row of ``vectors`` where ``chosen`` (over vec_id) holds, the k other rows of the highest scores."""
    spark = vectors.sparkSession
    known = packed(vectors, chosen)
    if known is None:
        return spark.createDataFrame([], RESULT)
    rows, shape = write_stage(known[0], "knn-packed"), known[1]
    order = Window.partitionBy("vec").orderBy("vec_id")
    few = rows.select("vec", "vec_id", F.row_number().over(order).alias("place")).where(F.col("place") <= k + 1)
    classes = few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # k + 1 of a class at most
    classes = write_stage(classes.withColumn("v", F.monotonically_increasing_id()), "knn-classes")
    queries = rows.where("chosen").select(F.col("vec_id").alias("query_id"), "vec").join(classes.select("v", "vec"), "vec").select("query_id", "v")
    queries = write_stage(queries, "knn-queries")
    wanted = classes.join(queries.select("v").distinct(), "v", "left_semi")

    centres = choose_pivots(classes, shape, min(pivots, 64))
    placed = write_stage(placed_queries(wanted, shape, centres), "knn-placed")
    counts, radius = np.zeros(len(centres), np.int64), np.zeros(len(centres))
    for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("far")).collect():  # one a pivot
        counts[r["cell"]], radius[r["cell"]] = r["n"], r["far"]
    reach = kth_distances(classes, shape, centres, k + 1) + 2 * radius + SLACK * (1 + np.sqrt(shape.squared))
    reach[counts == 0] = -1.0
    first, parts = deal_cells(counts, centres, group_queries)
    total = classes.agg(F.sum(F.size("ids"))).collect()[0][0]
    groups = int((first + parts)[counts > 0].max())
    # Enough shards for bounded ones, and for all tasks of the cluster.
    shards = max(-(-total // shard_rows), -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // groups))

    cell = F.col("cell")
    pick = lambda values: F.element_at(F.array(*[F.lit(int(x)) for x in values]), cell + 1).cast("long")
    asked = placed.select(
        (pick(first) + F.pmod(F.xxhash64("v"), pick(parts))).alias("place"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        F.lit(0).alias("kind"), "v", F.lit(None).cast("long").alias("vec_id"), F.expr("shiftleft(1L, cell)").alias("cells"), "vec",
    )
    tasks = asked.unionByName(replicate(classes, shape, centres, reach, first, parts, shards))
    found = solve(tasks, shape, k + 1)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "v")
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    lists = found.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "v", "vec_id", "score"))).alias("l"))  # k + 1 of a query
    lists = write_stage(lists, "knn-lists")
    joined = queries.join(lists.withColumnRenamed("query", "v"), "v")
    own = F.array_position(F.transform("l", lambda x: (x["v"] == F.col("v")) & (x["vec_id"] == F.col("query_id"))), True)
    others = F.filter("l", lambda _, i: i != F.col("own") - 1)
    picked = joined.withColumn("own", own).select("query_id", F.posexplode(F.slice(others, 1, k)).alias("i", "x"))
    return picked.select("query_id", (F.col("i") + 1).alias("rank"), "x.vec_id", "x.score")


def op13_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_join(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % EVERY == 0)


OP13_SQL = f"""
with x as (
  select vec_id, row_number() over () as r, [floor({UNIT} * c::double)::double for c in embedding] as x
  from embeddings
  where vec_id is not null and embedding is not null and len([c for c in embedding if c is null or not isfinite(c)]) = 0),
s as (
  select q.vec_id as query_id, q.r, d.vec_id, cast(list_inner_product(q.x, d.x) as bigint) as score
  from x q join x d on q.r <> d.r where q.vec_id % {EVERY} = 0),
n as (select *, row_number() over (partition by r order by score desc, vec_id) as n from s)
select query_id, cast(n as int) as rank, vec_id, score from n where n <= {K}
"""
