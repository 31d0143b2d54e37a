"""Packing documents into training sequences as a cutting-stock problem, solved by column generation.

A document is its token ids and an end id.  It is cut at every ``capacity`` ids; whole pieces fill a sequence each, and the rests
are packed.  The histogram of piece lengths, rounded up to a grid, has at most ``capacity / GRID`` entries whatever the input, so the linear program over
patterns (how many pieces of each length share a sequence) is solved on the driver: a knapsack by dynamic programming over
the duals prices the next patterns, until the program is within ``TOLERANCE`` of its lower bound.  Pattern counts are
rounded down; what that leaves (fewer pieces than patterns in the basis hold) is filled by a bounded subset-sum program.  Pieces
are then ranked within their length, and a table of patterns maps length and rank to sequence and offset, all
on the cluster.

Defined results: a null text is an empty one and gives the end id alone; equal rows are documents of their own; an empty table gives
no rows.  Texts of any length are encoded whole, some 1 MB at a time and cut where no token can lie across.  Only doc_id and
text are read, whatever other columns there are.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flatspan.session import write_stage

CAPACITY = 1024
END_ID = 0
#: The share of sequences by which the program may miss its lower bound.
TOLERANCE = 1e-3
#: Lengths are counted in steps of this many ids; a sequence loses at most one less for each of its pieces.
GRID = 4
#: Columns that may enter for one run of the knapsack.
PIVOTS = 5
#: Pieces of one size that are ranked together.
RANK_ROWS = 200
#: Fixed value: the pattern by which the byte-level vocabulary splits a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CUT = re.compile(r"(?<=\S) (?=\S)")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(maxsize=2)
def load_encoder(path: str):
    """A function from text to ids, equal to the ``tokenizers`` file's own encoding without added special tokens.

    The vocabulary and merge order of the file are given to ``tiktoken``, which finds the same ids in a fifth of the time.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    # Byte-level vocabularies write the byte b as the character chr(b) where that is printable, else as the next of U+0100...
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(odd)}
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in k): i for k, i in spec["model"]["vocab"].items() if k not in special}
    encoder = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> list[int]:
        if any(x in text for x in special):
            return encoder.encode(text, allowed_special="all")
        return encoder.encode_ordinary(text)

    return encode


def text_blocks(text: str, size: int = 1 << 20) -> Iterator[str]:
    """A text in parts that end before a single space between words, where a token always begins."""
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + size) if len(text) - at > size else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def token_ids(text: str | None, encode) -> np.ndarray:
    parts = [np.array(encode(x), "<u4") for x in text_blocks(text or "")]
    return np.concatenate([*parts, np.array([END_ID], "<u4")])


def cut_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): the pieces of every row's text."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_encoder(tokenizer or default_tokenizer())
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = token_ids(text.as_py(), encode)
                data = memoryview(ids.tobytes())
                for at in range(0, len(ids), capacity):
                    crc = zlib.crc32(data[4 * at : 4 * (at + capacity)])
                    rows.append((doc, at, min(capacity, len(ids) - at), crc, len(ids)))
            if rows:
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def price(worth: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every room up to ``capacity`` the largest worth of pieces that fit, and the last piece taken: an unbounded knapsack.

    ``worth[x]`` is what a piece of length x is worth, minus infinity where there is none.
    """
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        value = best[c - 1 :: -1] + worth[1 : c + 1]
        j = int(value.argmax())
        if value[j] > best[c - 1]:
            best[c], last[c] = value[j], j + 1
        else:
            best[c] = best[c - 1]
    return best, last


def first_basis(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> np.ndarray:
    """A column for each length: the length with its complement where that is needed as often, else the length repeated."""
    at = {int(x): i for i, x in enumerate(lengths)}
    basis = np.zeros((len(lengths), len(lengths)))
    for i, x in enumerate(lengths.tolist()):
        j = at.get(capacity - x, i)
        rarer = demand[i] < demand[j] or demand[i] == demand[j] and x > capacity - x
        if j != i and rarer:
            basis[i, i] = basis[j, i] = 1
        else:
            basis[i, i] = capacity // x
    return basis


def solve_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the final basis and how often each is used (not rounded): fewest sequences with room for every piece.

    A revised simplex method.  It ends when the number of sequences is within ``TOLERANCE`` of the best lower bound that the
    prices have given.  A tiny disturbance of the demand keeps degenerate steps from going in circles.
    """
    n, eye = len(lengths), np.eye(len(lengths))
    place = np.full(capacity + 1, -1)
    place[lengths] = np.arange(n)
    basis, cost = first_basis(lengths, demand, capacity), np.ones(n)
    # Off the diagonal only columns paired with an unpaired one have an entry, so the inverse is written down.
    share = 1 / np.diag(basis)
    inverse = np.diag(share) - share[:, None] * (basis - np.diag(np.diag(basis))) * share
    used = np.maximum((inverse * (demand + np.random.default_rng(0).random(n) * 1e-4)).sum(axis=1), 0)
    bound = float((lengths * demand).sum()) / capacity

    def enter(column: np.ndarray, price: float) -> bool:
        nonlocal inverse, used
        there = np.flatnonzero(column)
        step = (inverse[:, there] * column[there]).sum(axis=1)
        if price - (cost * step).sum() > -1e-7:
            return False
        ratio = np.full(n, np.inf)
        up = step > 1e-9
        ratio[up] = used[up] / step[up]
        row = int(ratio.argmin())
        used = np.maximum(used - ratio[row] * step, 0)
        used[row], basis[:, row], cost[row] = ratio[row], column, price
        pivot = inverse[row] / step[row]
        inverse = inverse - np.outer(step, pivot)
        inverse[row] = pivot
        return True

    while True:
        dual = np.maximum(inverse[cost == 1].sum(axis=0), 0)
        worth = np.full(capacity + 1, -np.inf)
        worth[lengths] = dual
        best, last = price(worth, capacity)
        bound = max(bound, float((demand * dual).sum()) / max(best[capacity], 1e-9))
        if (cost * used).sum() <= bound * (1 + TOLERANCE):
            break
        entered = 0
        gain = dual + best[capacity - lengths]
        for i in np.argsort(-gain, kind="stable")[: 4 * PIVOTS].tolist():
            column, c = eye[i].copy(), capacity - int(lengths[i])
            while c > 0 and best[c] > 0:
                while not last[c]:
                    c -= 1
                column[place[last[c]]] += 1
                c -= int(last[c])
            entered += enter(column, 1.0)
            if entered == PIVOTS:
                break
        for i in np.argsort(inverse[cost == 1].sum(axis=0))[:PIVOTS].tolist():
            entered += enter(-eye[i], 0.0)  # room left free
        if not entered:
            break
    return basis[:, cost == 1], used[cost == 1]


def fill_rest(rest: dict[int, int], capacity: int) -> list[Counter]:
    """Sequences for the pieces that rounding leaves: the longest piece, and the fullest choice of others beside it."""
    out = []
    while rest:
        longest = max(rest)
        chosen, room = Counter({longest: 1}), capacity - longest
        _take(rest, longest, 1)
        # reach[k] has bit s set if the first k lengths can sum to s
        steps, reach = [], [1]
        limit = (1 << (room + 1)) - 1
        for x in sorted((x for x in rest if x <= room), reverse=True):
            for _ in range(min(rest[x], room // x)):
                steps.append(x)
                reach.append((reach[-1] | reach[-1] << x) & limit)
                if reach[-1] >> room & 1:
                    break
            if reach[-1] >> room & 1:
                break
        total = reach[-1].bit_length() - 1
        for k in range(len(steps), 0, -1):
            if not reach[k - 1] >> total & 1:
                chosen[steps[k - 1]] += 1
                _take(rest, steps[k - 1], 1)
                total -= steps[k - 1]
        out.append(chosen)
    return out


def _take(rest: dict[int, int], x: int, n: int) -> None:
    rest[x] -= n
    if not rest[x]:
        del rest[x]


def plan_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """(pieces of each length, number of sequences) that use every piece of the histogram exactly once."""
    out = [(Counter({capacity: 1}), histogram[capacity])] if histogram.get(capacity) else []
    rest = {x: n for x, n in histogram.items() if x != capacity and n}
    if rest:
        lengths = np.array(sorted(rest))
        basis, used = solve_patterns(lengths, np.array([rest[x] for x in lengths.tolist()], float), capacity)
        for column, times in zip(basis.T, np.floor(used + 1e-2).astype(int).tolist(), strict=True):
            pattern = Counter({int(lengths[i]): int(column[i]) for i in np.flatnonzero(column)})
            times = min([times, *(rest.get(x, 0) // k for x, k in pattern.items())])
            if times > 0:
                out.append((pattern, times))
                for x, k in pattern.items():
                    _take(rest, x, k * times)
        again = Counter(tuple(sorted(p.items(), reverse=True)) for p in fill_rest(rest, capacity))
        out += [(Counter(dict(p)), n) for p, n in again.items()]
    return out


def slot_rows(patterns: list[tuple[Counter, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, pieces a sequence, first sequence, first place there)."""
    rows, ranks, sequence = [], Counter(), 0
    for pattern, times in patterns:
        place = 0
        for x, k in sorted(pattern.items(), reverse=True):
            rows.append((x, ranks[x], ranks[x] + k * times, k, sequence, place))
            ranks[x] += k * times
            place += k
        sequence += times
    return rows


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece, with its sequence and its offset there."""
    spark = docs.sparkSession
    pieces = write_stage(cut_pieces(docs, tokenizer, capacity), "packing-pieces")
    size = F.ceil(F.col("length") / GRID).alias("size")
    histogram = {r["size"]: r["n"] for r in pieces.groupBy(size).agg(F.count("*").alias("n")).collect()}  # <= capacity / GRID rows
    slots = spark.createDataFrame(
        slot_rows(plan_patterns(histogram, capacity // GRID)), "size long, low long, high long, each long, first long, place long"
    )
    # Ranks within a size: a size is dealt into parts of about RANK_ROWS pieces, so no task ranks a frequent size.
    parts = spark.createDataFrame([(x, n // RANK_ROWS + 1) for x, n in histogram.items()], "size long, parts long")
    part = F.pmod(F.xxhash64("doc_id", "start"), "parts").alias("part")
    sized = pieces.select("*", size).join(F.broadcast(parts), "size").select(*pieces.columns, "size", part)
    counts = sized.groupBy("size", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("size", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("size", "part").orderBy("doc_id", "start", "ids_crc32")
    ranked = sized.join(starts, ["size", "part"]).withColumn("rank", F.col("before") + F.row_number().over(own) - 1)
    # One row for each size of each pattern; patterns are at most as many as sizes, and those of the rests.
    placed = ranked.join(F.broadcast(slots), "size").where("rank >= low and rank < high")
    placed = placed.selectExpr(*pieces.columns, "first + (rank - low) div each as sequence_id", "place + (rank - low) % each as place")
    along = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*pieces.columns, "sequence_id", F.coalesce(F.sum("length").over(along), F.lit(0)).alias("offset"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
