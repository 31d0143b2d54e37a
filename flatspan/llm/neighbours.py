"""Near-duplicate vectors by NN-descent: all links with a cosine of at least 0.95, their number for each vector, and components.

Copies are one vertex.  The first graph comes from random orders of the vectors (by the signs of random projections), where blocks of
neighbours are compared.  Each round compares, around every vertex whose list changed, its neighbours and some vertices that name
it with one another, and keeps the best of each list.  A list that holds threshold links only is saturated and is enlarged; its length
never falls again, so the links of the graph only grow.  Links are counted from the threshold edges of the graph; only where a list is
still saturated at ``MOST_NEIGHBOURS``, all members of its component are compared, block by block.  A descent ends when a round finds
next to nothing or after ``ROUNDS`` rounds; then recall is audited against brute force over bounded samples of queries, of
all vectors and of those with few links, as a mean over queries.  The search goes on with longer lists and new orders while it is below
``RECALL``, and fails after ``TRIES``.

No list, group of copies or hub is gathered: lists are ranked and cut in each task before they are shuffled, reverse neighbours are
picked by minima, and components are dealt into blocks.  Every round is written to the shared folder.

Defined results: a vector that is null, empty, zero or holds null or non-finite numbers links with nothing and is its own component; shorter
vectors count as padded with zeros; equal vectors are linked, whatever their ids; a null vec_id is counted as a link, but is
no component's id, and a component without any id has none; an empty table gives no rows.  Only vec_id and embedding are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatspan.llm.components import connected
from flatspan.session import write_stage

THRESHOLD = 0.95
NEIGHBOURS = 8
MOST_NEIGHBOURS = 64
#: Random orders of a search, and the vectors of a block there.
ORDERS = 4
BLOCK = 64
#: A round that finds fewer new links than this share ends a descent, as does the last of so many rounds.
PROGRESS = 0.001
ROUNDS = 24
#: Vectors of a block of a component.
MEMBERS = 1024
#: Queries of the audit (a bounded sample) and the recall it asks for.
AUDITED = 512
AUDITED_SHORT = 2048
#: Searches with new orders before a recall that stays too low is an error.
TRIES = 12
RECALL = 0.99
SEED = 7

LINKS = "a long, b long, sim double"


def vectors_of(column: pa.Array, dtype: str) -> np.ndarray:
    """A binary column of equally long vectors as unit vectors in double precision."""
    if not len(column):
        return np.zeros((0, 1))
    raw = np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1).astype(np.float64)
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)  # no overflow in squares
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def grouped(batches: Iterator[pa.RecordBatch], keys: int, rows: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Tables of whole groups from batches sorted by the first ``keys`` columns (longs), about ``rows`` rows each, and the starts of the
    groups there, the end included."""
    held: list[pa.RecordBatch] = []

    def starts(table: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for i in range(keys):
            key = table.column(i).to_numpy(zero_copy_only=False)
            new[1:] |= key[1:] != key[:-1]
        return np.flatnonzero(new)

    for batch in (x for x in batches if x.num_rows):
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            table = pa.concat_batches(held)
            at = starts(table)
            if at[-1]:
                yield table.slice(0, at[-1]), at
            held = [table.slice(at[-1])]  # the last group may go on
    if held and (table := pa.concat_batches(held)).num_rows:
        yield table, np.r_[starts(table), table.num_rows]


def link_batch(a: list, b: list, sim: list) -> pa.RecordBatch:
    if not a:
        a, b, sim = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b, sim)], names=["a", "b", "sim"])


class Search:
    """The neighbour graph of the distinct vectors ``points`` (v, vec): ``graph`` holds the best neighbours of each, as ``LINKS``."""

    def __init__(self, points: DataFrame, dim: int, dtype: str, threshold: float) -> None:
        self.points, self.dim, self.dtype, self.threshold = points, dim, dtype, threshold
        self.most, self.order = NEIGHBOURS, 0
        self.graph: DataFrame | None = None

    def seeded(self) -> DataFrame:
        """Links between the vectors of a block of some new random orders."""
        dim, dtype, tables, most = self.dim, self.dtype, range(self.order, self.order + ORDERS), self.most
        self.order += ORDERS

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            planes = [np.random.default_rng([SEED, t]).standard_normal((dim, 32)) for t in tables]
            bits = 1 << np.arange(31, -1, -1, dtype=np.int64)
            for batch in (x for x in batches if x.num_rows):
                unit = vectors_of(batch.column(1), dtype)
                for t, plane in zip(tables, planes, strict=True):
                    code = ((unit @ plane > 0) * bits).sum(axis=1)
                    table = pa.array(np.full(len(code), t, np.int64))
                    yield pa.RecordBatch.from_arrays([table, pa.array(code), *batch.columns], names=["t", "code", "v", "vec"])

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table, at in grouped(batches, 1, 8 * BLOCK):
                unit, ids = vectors_of(table.column(3), dtype), table.column(2).to_numpy()
                a, b, sims = [], [], []
                for start, end in zip(at[:-1], at[1:], strict=True):
                    for low in range(start, end, BLOCK):
                        high = min(low + BLOCK, end)
                        sim = unit[low:high] @ unit[low:high].T
                        np.fill_diagonal(sim, -2)
                        k = min(most, high - low - 1)
                        if k > 0:
                            best = np.argpartition(-sim, k - 1, axis=1)[:, :k]
                            a.append(np.repeat(ids[low:high], k))
                            b.append(ids[low:high][best].ravel())
                            sims.append(np.take_along_axis(sim, best, axis=1).ravel())
                yield link_batch(a, b, sims)

        placed = self.points.mapInArrow(place, "t long, code long, v long, vec binary")
        dealt = placed.repartitionByRange("t", "code", "v").sortWithinPartitions("t", "code", "v")
        return dealt.mapInArrow(lambda x: compare(_blocks(x)), LINKS)

    def merge(self, links: DataFrame) -> None:
        """Take links into the lists, of which each keeps as many as its ``room``: ``most``, doubled whenever the list is saturated."""
        old = self.graph
        every = links if old is None else links.union(old.select("a", "b", "sim"))
        best = every.groupBy("a", "b").agg(F.max("sim").alias("sim"))
        rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
        lists = best.withColumn("rank", rank).where(F.col("rank") <= MOST_NEIGHBOURS)  # each task keeps so many before the shuffle
        if old is None:
            rows = lists.withColumns({"room": F.lit(self.most), "new": F.lit(True)})
        else:
            room = self.rooms().select("a", F.when(self.saturated(), F.least(2 * F.col("room"), F.lit(MOST_NEIGHBOURS))).otherwise(F.col("room")).alias("room"))
            known = old.select("a", "b", F.lit(False).alias("known"))
            rows = lists.join(known, ["a", "b"], "left").withColumn("new", F.coalesce("known", F.lit(True)))
            rows = rows.join(room, "a", "left").withColumn("room", F.greatest(F.coalesce("room", F.lit(self.most)), F.lit(self.most)))
        rows = rows.where(F.col("rank") <= F.col("room"))
        self.graph = write_stage(rows.select("a", "b", "sim", "new", "room"), "neighbours-graph")

    def rooms(self) -> DataFrame:
        """(a, n, worst, room) of every list."""
        return self.graph.groupBy("a").agg(F.count("*").alias("n"), F.min("sim").alias("worst"), F.max("room").alias("room"))

    def saturated(self) -> Column:
        """Whether a list of ``rooms`` is full of threshold links."""
        return (F.col("n") >= F.col("room")) & (F.col("worst") >= self.threshold)

    def round(self) -> DataFrame:
        """Links among the neighbours of every vertex whose list has changed."""
        graph, dtype = self.graph, self.dtype
        changed = graph.where("new").select(F.col("a").alias("v")).distinct()
        slot = F.pmod(F.xxhash64("a", "b"), F.lit(NEIGHBOURS))
        back = graph.groupBy(F.col("b").alias("v"), slot.alias("slot")).agg(F.min("a").alias("m")).select("v", "m")
        ahead = graph.select(F.col("a").alias("v"), F.col("b").alias("m"))
        around = ahead.union(back).union(graph.select(F.col("a").alias("v"), F.col("a").alias("m"))).distinct().join(changed, "v", "left_semi")
        open_ = (F.col("n") < F.col("room")) | (self.saturated() & (F.col("room") < MOST_NEIGHBOURS))
        worst = self.rooms().select(F.col("a").alias("m"), F.when(open_, -2.0).otherwise(F.col("worst")).alias("worst"))
        known = write_stage(self.points.select(F.col("v").alias("m"), "vec").join(worst, "m", "left").na.fill({"worst": -2.0}), "neighbours-known")
        members = write_stage(around, "neighbours-around").join(known, "m").select("v", "m", "worst", "vec")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table, at in grouped(batches, 1, 20_000):
                unit, ids, least = vectors_of(table.column(3), dtype), table.column(1).to_numpy(), table.column(2).to_numpy()
                a, b, sims = [], [], []
                for low, high in zip(at[:-1], at[1:], strict=True):
                    sim = unit[low:high] @ unit[low:high].T
                    np.fill_diagonal(sim, -2)
                    i, j = np.nonzero(sim > least[low:high, None])
                    a.append(ids[low + i])
                    b.append(ids[low + j])
                    sims.append(sim[i, j])
                yield link_batch(a, b, sims)

        return members.repartition("v").sortWithinPartitions("v", "m").mapInArrow(compare, LINKS)

    def links(self) -> DataFrame:
        return self.graph.where(F.col("sim") >= self.threshold)

    def descend(self) -> None:
        """Seed with new orders and go on until a round finds next to nothing."""
        self.merge(self.seeded())
        found = self.links().count()
        for _ in range(ROUNDS):
            self.merge(self.round())
            near = F.col("sim") >= self.threshold
            lists = self.graph.groupBy("a").agg(F.count_if(near).alias("n"), F.count_if(near & F.col("new")).alias("more"), F.min("sim").alias("worst"))
            short = F.col("worst") < self.threshold  # a list that holds all links it knows, as those outside of large components do
            seen = lists.agg(F.sum("n"), F.count_if(short & (F.col("n") > 0)), F.count_if(short & (F.col("more") > 0))).collect()[0]
            now, linked, changed = (x or 0 for x in seen)
            if now - found <= PROGRESS * now and changed <= PROGRESS * linked:
                return
            found = now


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of each order in blocks, so that a block is a group: the first column becomes order and block in one."""
    seen: dict[int, int] = {}
    for batch in (x for x in batches if x.num_rows):
        t = batch.column(0).to_numpy()
        number = np.empty(len(t), np.int64)
        for x in np.unique(t).tolist():
            mine = np.flatnonzero(t == x)
            number[mine] = seen.get(x, 0) + np.arange(len(mine))
            seen[x] = seen.get(x, 0) + len(mine)
        yield pa.RecordBatch.from_arrays([pa.array((t << 40) | number // BLOCK), *batch.columns[1:]], names=batch.schema.names)


def link_counts(search: Search, points: DataFrame, labels: DataFrame) -> DataFrame:
    """(v, n_vertices, n_rows): with how many vertices, and rows of those, each vertex is linked.  The threshold edges of the graph
    are counted; a component with a list that is still saturated is compared whole.  ``points`` (v, vec, n), ``labels`` (vertex, label)."""
    cut = search.rooms().where(search.saturated()).select(F.col("a").alias("vertex"))
    whole = write_stage(labels.join(cut, "vertex", "left_semi").select("label").distinct(), "neighbours-whole")
    edges = search.links().select("a", "b")
    edges = edges.union(edges.select("b", "a")).distinct()  # one list may hold what the other's room has cut
    edges = edges.join(points.select(F.col("v").alias("b"), "n"), "b")
    counts = edges.groupBy(F.col("a").alias("v")).agg(F.count("*").alias("n_vertices"), F.sum("n").alias("n_rows"))
    if whole.isEmpty():
        return counts
    inside = labels.join(whole, "label", "left_semi")
    rest = counts.join(inside.select(F.col("vertex").alias("v")), "v", "left_anti")
    return rest.unionByName(component_links(points, inside, search.dtype, search.threshold))


def component_links(points: DataFrame, labels: DataFrame, dtype: str, threshold: float) -> DataFrame:
    """(v, n_vertices, n_rows): with how many vertices of its component, and rows of those, each vertex is linked; all
    members are compared, block by block.  ``points`` (v, vec, n), ``labels`` (vertex, label)."""
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    member = labels.join(sizes, "label").join(points.withColumnRenamed("v", "vertex"), "vertex")
    blocks = F.ceil(F.col("size") / MEMBERS).cast("int")
    own = F.pmod(F.xxhash64("vertex"), blocks).cast("int")
    member = member.select("label", F.col("vertex").alias("v"), "n", "vec", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    pair = F.least("own", "other").cast("long").alias("low"), F.greatest("own", "other").cast("long").alias("high")
    dealt = member.select("label", *pair, F.col("own").cast("long").alias("own"), "v", "n", "vec")
    dealt = dealt.repartition("label", "low", "high").sortWithinPartitions("label", "low", "high", "own", "v")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in grouped(batches, 3, 8192):
            unit = vectors_of(table.column(6), dtype)
            own, high, low, n = (table.column(i).to_numpy() for i in (3, 2, 1, 5))
            links, rows = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for start, end in zip(at[:-1], at[1:], strict=True):
                if low[start] == high[start]:
                    near = unit[start:end] @ unit[start:end].T >= threshold
                    np.fill_diagonal(near, False)
                    links[start:end], rows[start:end] = near.sum(axis=1), (near * n[start:end]).sum(axis=1)
                else:
                    cut = start + int((own[start:end] == low[start]).sum())
                    near = unit[start:cut] @ unit[cut:end].T >= threshold
                    links[start:cut], rows[start:cut] = near.sum(axis=1), (near * n[cut:end]).sum(axis=1)
                    links[cut:end], rows[cut:end] = near.sum(axis=0), (near * n[start:cut, None]).sum(axis=0)
            yield pa.RecordBatch.from_arrays([table.column(4), pa.array(links), pa.array(rows)], names=["v", "n_vertices", "n_rows"])

    parts = dealt.mapInArrow(compare, "v long, n_vertices long, n_rows long")
    return parts.groupBy("v").agg(F.sum("n_vertices").alias("n_vertices"), F.sum("n_rows").alias("n_rows"))


def audit(points: DataFrame, counts: DataFrame, dtype: str, threshold: float) -> float:
    """The recall of ``counts`` (v, n_vertices) by brute force for some vertices: the mean over those with links of the share that was found.
    The lower one of at most ``AUDITED`` of all vertices and ``AUDITED_SHORT`` of those with few links."""
    every = points.join(counts.select("v", "n_vertices"), "v", "left").select("v", "vec", F.coalesce("n_vertices", F.lit(0)).alias("found"))
    some = lambda df, n: df.orderBy(F.xxhash64(F.lit(SEED), "v")).limit(n).collect()
    rows = some(every, AUDITED)
    cut = len(rows)
    rows += some(every.where(F.col("found") <= NEIGHBOURS), AUDITED_SHORT)
    if not rows:
        return 1.0
    queries = points.sparkSession.sparkContext.broadcast([bytes(r["vec"]) for r in rows])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = vectors_of(pa.array(queries.value), dtype)
        total = np.zeros(len(unit), np.int64)
        for batch in (x for x in batches if x.num_rows):
            data = vectors_of(batch.column(0), dtype)
            for at in range(0, len(data), 4096):
                total += (unit @ data[at : at + 4096].T >= threshold).sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(unit))), pa.array(total)], names=["i", "n"])

    there = points.select("vec").mapInArrow(compare, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    true = {r["i"]: r["n"] - 1 for r in there}  # without themselves
    shares = [(i, min(r["found"] / true[i], 1.0)) for i, r in enumerate(rows) if true.get(i, 0) > 0]
    parts = [[x for i, x in shares if i < cut], [x for i, x in shares if i >= cut]]
    return min((float(np.mean(p)) for p in parts if p), default=1.0)


def vector_links(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id), a row for each row of ``vectors``."""
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    dtype, kind = ("<f4", "float") if single else ("<f8", "double")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("e"))
    fine = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("e", lambda x: x != 0)
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    dim = rows.where("fine").agg(F.max(F.size("e"))).collect()[0][0] or 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = [np.pad(np.array(x, dtype) + 0, (0, dim - len(x))).tobytes() if ok else None for x, ok in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vec, pa.binary())], names=["vec_id", "vec"])

    packed = write_stage(rows.mapInArrow(pack, "vec_id long, vec binary"), "neighbours-packed")
    classes = packed.where("vec is not null").groupBy("vec").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    points = write_stage(classes.withColumn("v", F.monotonically_increasing_id()), "neighbours-points")

    search = Search(points.select("v", "vec"), dim, dtype, threshold)
    for _ in range(TRIES):
        search.descend()
        labels = connected(search.links(), "neighbours")
        counts = write_stage(link_counts(search, points.select("v", "vec", "n"), labels), "neighbours-counts")
        reached = audit(points, counts, dtype, threshold)
        if reached >= recall:
            break
        search.most = min(2 * search.most, MOST_NEIGHBOURS)
    else:
        raise RuntimeError(f"the audited recall is {reached:.4f} after {TRIES} searches; {recall} is asked for")
    least = labels.join(points.withColumnRenamed("v", "vertex"), "vertex").groupBy("label").agg(F.min("first").alias("least"))
    least = write_stage(labels.join(write_stage(least, "neighbours-least"), "label").select(F.col("vertex").alias("v"), "least"), "neighbours-of")
    known = points.join(least, "v", "left").join(counts, "v", "left")
    known = known.select("vec", F.coalesce("least", "first").alias("component_id"), (F.coalesce("n_rows", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    known = write_stage(known, "neighbours-vectors")
    linked = packed.where("vec is not null").join(known, "vec").select("vec_id", "n_links", "component_id")
    alone = packed.where("vec is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone)


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
