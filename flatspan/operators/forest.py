"""Random forests, many fits side by side, each grown once for all grid points.

The draws of a row in a tree and the features of a node come from hashes of seed, tree, row and place, so the first 100 of 200 trees
are the forest of 100, and a tree cut at depth 5 is the tree grown to that depth: one growth serves every number of trees and
every depth.  Nodes with more rows than a task may hold are split over the cluster, a level of many trees in one aggregate; the rows of a
smaller node are shuffled to one task, which grows what is below it.  Rows that a fit is scored on travel with them, so scores need no forest
in one place; where the trees themselves are asked for, they come back as arrays.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flatspan.operators.blocks import BINS, TASK_ROWS, Block, Blocks, Fit, add_up, balanced, class_counts, keyed, sum_over, unpacked

#: The deepest tree; a node of so many rows is grown by one task.
MAX_DEPTH = 30
LOCAL_ROWS = 4096
#: With few features a task grows nodes of more rows, up to so many bins.
LOCAL_CELLS = 1 << 22
#: Bytes of sums that one aggregate brings back.
SUM_BYTES = 1 << 26
#: Cells (node, feature, bin) that a task sums up at once.
CELLS = 1 << 18
#: Rows a node has on average below which they are sorted rather than summed by bin.
FEW_ROWS = 24
#: Gains that differ by less than this share of a node's score are equal.
NEAR = 1e-9
#: Bytes of sums of scored rows that a task holds before it passes them on.
HELD_BYTES = 64 << 20
#: Bits of a row's number in its block.
ROW_BITS = 12

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # of the public SplitMix64


def mix(*parts) -> np.ndarray:
    """A 64-bit hash of whole numbers (arrays are matched by shape)."""
    with np.errstate(over="ignore"):
        h = np.uint64(0)
        for p in parts:
            h = (h ^ np.asarray(p).astype(np.uint64)) + _A
            h = (h ^ (h >> np.uint64(30))) * _B
            h = (h ^ (h >> np.uint64(27))) * _C
            h = h ^ (h >> np.uint64(31))
    return h


#: Chances that a row is drawn at most 0, 1, 2 ... times: the Poisson law of mean one.
_DRAWN = np.cumsum([np.exp(-1.0) / float(np.prod(np.arange(1, i + 1))) for i in range(12)])


def draws(seed: int, tree: int, block: int, n: int) -> np.ndarray:
    """How often each row of a block is in the sample of a tree."""
    share = mix(seed, tree, block, np.arange(n)).astype(np.float64) / 2.0**64
    return np.searchsorted(_DRAWN, share).astype(np.int64)


def feature_order(seed: int, tree: np.ndarray, path: np.ndarray, features: int) -> np.ndarray:
    """The features in the order in which each node tries them: nodes x features."""
    return np.argsort(mix(seed, tree[:, None], path[:, None], np.arange(features) + (1 << 40)), axis=1, kind="stable")


@dataclass(frozen=True)
class Spec:
    """What is grown: trees of a fit, features tried at a node, and whether rows are drawn."""

    trees: int
    depth: int
    tried: int
    bootstrap: bool
    seed: int
    n_classes: int

    @property
    def outputs(self) -> int:
        return max(self.n_classes, 1)


# --- a node's rows in one task ---------------------------------------------------------------------


@dataclass
class Rows:
    """The rows of a node: ``bins`` is rows x features, ``y`` their class or number, ``times`` says how often each counts (below 16)."""

    bins: np.ndarray
    y: np.ndarray
    times: np.ndarray
    weights: np.ndarray  # of the classes
    n_classes: int

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What ``by_key`` asks of some rows: their class, or their number as often as it counts, and how often they count."""
        times = self.times[rows].astype(float)
        return (self.y[rows] if self.n_classes else self.y[rows] * times), times

    def by_key(self, key: np.ndarray, of: tuple[np.ndarray, np.ndarray], size: int) -> np.ndarray:
        """Sums [outputs, weight] x ``size`` of some rows by ``key``; classes are counted, so theirs do not depend on the order of rows."""
        y, times = of
        k = self.n_classes
        if not k:
            return np.stack([np.bincount(key, y, size), np.bincount(key, times, size)])
        return self.weighed(np.bincount(key * k + y, times, size * k).reshape(size, k))

    def weighed(self, counts: np.ndarray) -> np.ndarray:
        """[outputs, weight] x places of the counts (places x classes)."""
        sums = np.empty((self.n_classes + 1, len(counts)))
        np.multiply(counts.T, self.weights[:, None], out=sums[:-1])
        sums[:-1].sum(axis=0, out=sums[-1])
        return sums


def grow_here(data: Rows, held: np.ndarray, spec: Spec, tree: int, path: int, depth: int, cuts: list[int]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Grow what is below a node from all its rows.

    ``held`` is the bins of rows to be scored.  Returns the nodes (feature or -1, cut, left, right, value) and, for every depth of
    ``cuts``, the values of the held rows where the tree ends at that depth; NaN where the node is below that depth already.
    """
    k = spec.outputs
    parts: list[tuple[np.ndarray, ...]] = []  # of each level: feature, cut, left, right, value
    out = np.full((len(cuts), len(held), k), np.nan)
    rows, place = np.arange(len(data.bins)), np.zeros(len(data.bins), np.int64)  # rows still going, the place of their node in the level
    hrows, hplace = np.arange(len(held)), np.zeros(len(held), np.int64)
    paths, count = np.array([path], np.uint64), 1
    while len(paths):
        a = len(paths)
        total = data.by_key(place, data.of(rows), a)
        value = (total[:k] / np.maximum(total[k:], 1e-300)).T
        feature, cut, left, right = np.full(a, -1), np.zeros(a, np.int64), np.zeros(a, np.int64), np.zeros(a, np.int64)
        parts.append((feature, cut, left, right, value))
        last = depth >= spec.depth
        for i, at in enumerate(cuts):
            if at == depth or (last and at > depth):
                out[i, hrows] = value[hplace]
        if last:
            break
        best, by, where = split_nodes(data, rows, place, total, spec, tree, paths)
        go = np.flatnonzero(best > -np.inf)
        number = np.full(a, -1)
        number[go] = np.arange(len(go))
        feature[go], cut[go] = by[go], where[go]
        left[go], right[go] = count + 2 * np.arange(len(go)), count + 2 * np.arange(len(go)) + 1
        at = number[hplace]
        ends = at < 0
        for i, deep in enumerate(cuts):
            if deep > depth:
                out[i, hrows[ends]] = value[hplace[ends]]
        rows, place = below(data.bins, rows, place, number, by, where)
        hrows, hplace = below(held, hrows, hplace, number, by, where)
        count, depth = count + 2 * len(go), depth + 1
        paths = (2 * paths[go, None] + np.arange(2, dtype=np.uint64)).ravel()
    return dict(zip(NAMES, (np.concatenate(x) for x in zip(*parts, strict=True)), strict=True)), out


def below(bins: np.ndarray, rows: np.ndarray, place: np.ndarray, number: np.ndarray, by: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows whose nodes are split, and the place of their child in the next level."""
    child = number[place]
    stay = np.flatnonzero(child >= 0)
    if len(stay) < len(rows):
        rows, place, child = rows[stay], place[stay], child[stay]
    return rows, 2 * child + (bins.ravel()[rows * bins.shape[1] + by[place]] > where[place])


def split_nodes(data: Rows, rows: np.ndarray, place: np.ndarray, total: np.ndarray, spec: Spec, tree: int, paths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each node of a level the gain (minus infinity: a leaf), the feature and the last bin that goes left; ``total`` is their sums.

    Of the features in the node's order the first ``tried`` are looked at, and the others where none of these splits."""
    a, d = len(paths), data.bins.shape[1]
    best, by, where = np.full(a, -np.inf), np.zeros(a, np.int64), np.zeros(a, np.int64)
    # A node whose rows are alike is a leaf.
    alike = total[:-1].max(axis=0) > (1 - 1e-12) * total[-1] if spec.n_classes else spread(data.y, rows, place, a) <= 1e-12
    asked = np.flatnonzero(~alike)
    order = feature_order(spec.seed, np.full(len(asked), tree), paths[asked], d)
    for some in (slice(spec.tried), slice(spec.tried, d)):
        features = order[:, some]
        if not features.size:
            continue
        number = np.full(a, -1)
        number[asked] = np.arange(len(asked))
        node = number[place]
        here = np.flatnonzero(node >= 0)
        r, node = (rows, node) if len(here) == len(rows) else (rows[here], node[here])
        few = len(r) < FEW_ROWS * len(asked)
        step = len(asked) * 4 * CELLS // max(1, len(r) * features.shape[1]) if few else CELLS // (features.shape[1] * BINS)
        step = max(1, step)
        if step < len(asked):
            by_node = np.argsort(node, kind="stable")
            r, node = r[by_node], node[by_node]
        for at in range(0, len(asked), step):
            mine = asked[at : at + step]
            span = slice(*np.searchsorted(node, [at, at + step])) if step < len(asked) else slice(None)
            found = (cut_few if few else cut_many)(data, r[span], node[span] - at, features[at : at + step], total[:, mine])
            best[mine], by[mine], where[mine] = found
        still = best[asked] == -np.inf
        asked, order = asked[still], order[still]
    return best, by, where


def cut_many(data: Rows, rows: np.ndarray, node: np.ndarray, features: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best split of nodes over their ``features`` (nodes x features), from sums by bin; ``node`` is the node of each of ``rows``."""
    a, t = features.shape
    flat, start, cell, of = data.bins.ravel(), rows * data.bins.shape[1], node * BINS, data.of(rows)
    by_bin = np.empty((len(total), a, t, BINS))
    for j in range(t):
        by_bin[:, :, j] = data.by_key(cell + flat[start + features[:, j].take(node)], of, a * BINS).reshape(-1, a, BINS)
    gain, near = gains(by_bin)
    first = (gain >= near[:, None]).argmax(axis=1)  # the first of the best
    j, cut = np.divmod(first, BINS)
    return gain[np.arange(a), first], features[np.arange(a), j], cut


def cut_few(data: Rows, rows: np.ndarray, node: np.ndarray, features: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``cut_many`` gives, for nodes with few rows: the rows of each node and feature are sorted by bin, so that bins without
    rows cost nothing."""
    a, t = features.shape
    k = data.n_classes
    cell = (node * t)[:, None] + np.arange(t)
    cell = cell * BINS + data.bins.ravel()[(rows * data.bins.shape[1])[:, None] + features[node]]
    if k:  # what is sorted holds all that is asked of a row
        key = np.sort((((cell * k + data.y[rows][:, None]) << 4) + data.times[rows][:, None]).ravel())
        of = key >> 4
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        n, of = np.add.reduceat(key & 15, first), of[first]
        cell, label = np.divmod(of, k)
        new = np.r_[True, cell[1:] != cell[:-1]]
        counts = np.zeros((int(new.sum()), k), np.int64)
        counts[np.cumsum(new) - 1, label] = n
        cell = cell[new]
        left = counts.cumsum(axis=0)
    else:
        bits = int(len(rows) * t).bit_length()
        key = np.sort(((cell.ravel() << bits) + np.arange(cell.size)))
        r = rows[(key & ((1 << bits) - 1)) // t]
        cell = key >> bits
        last = np.flatnonzero(np.r_[cell[1:] != cell[:-1], True])
        # Distances from the mean of the node add up to none in each group, so that no sum is large beside its node's.
        times, mean = data.times[r], total[0] / total[1]
        weight = np.cumsum(times)[last]
        far = np.cumsum((data.y[r] - mean[cell // (t * BINS)]) * times)[last]
        cell = cell[last]
        left = np.column_stack([far, weight])
    group = cell // BINS  # node and feature
    begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    before = np.zeros((len(begins), left.shape[1]), left.dtype)
    before[1:] = left[begins[1:] - 1]
    left = left - np.repeat(before, np.diff(np.r_[begins, len(group)]), axis=0)
    of = group // t
    left = data.weighed(left) if k else np.stack([left[:, 0] + mean[of] * left[:, 1], left[:, 1]])
    whole = total[:, of]
    right = whole - left
    base = score(whole)
    value = score(left) + score(right) - base
    least = 1e-9 * np.maximum(whole[-1], 1e-300)
    gain = np.where((left[-1] > least) & (right[-1] > least), np.maximum(value, 0.0), -np.inf)
    nodes = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])  # every node has rows
    most = np.maximum.reduceat(gain, nodes)
    good = np.flatnonzero(gain >= (most - NEAR * base[nodes])[of])
    first = good[np.r_[True, of[good][1:] != of[good][:-1]]]  # the first of the best
    return gain[first], features[np.arange(a), group[first] % t], cell[first] % BINS


def gains(by_bin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gain of every cut of nodes, from sums ([outputs, weight] x nodes x features x bins), and what counts as the best of a node;
    minus infinity where a side is empty."""
    left = by_bin.cumsum(axis=3)
    whole = left[..., -1:]
    right = whole - left
    total = score(whole)
    value = score(left)
    value += score(right)
    value -= total
    least = 1e-9 * np.maximum(whole[-1], 1e-300)
    flat = np.where((left[-1] > least) & (right[-1] > least), np.maximum(value, 0.0), -np.inf).reshape(by_bin.shape[1], -1)
    return flat, flat.max(axis=1) - NEAR * total[:, 0, 0]


def score(s: np.ndarray) -> np.ndarray:
    """Squares of the sums over the weight: what a split gains is the difference of these."""
    out = s[0] * s[0]
    for x in s[1:-1]:
        out += x * x
    return out / np.maximum(s[-1], 1e-300)


def node_value(total: np.ndarray) -> np.ndarray:
    """The value of a node from its sums [outputs, weight, rows]."""
    return total[:-2] / max(total[-2], 1e-300)


def spread(y: np.ndarray, rows: np.ndarray, place: np.ndarray, a: int) -> np.ndarray:
    """The largest distance between the numbers of a node's rows, as a share of the largest number."""
    y = y[rows]
    low, high = np.full(a, np.inf), np.full(a, -np.inf)
    np.minimum.at(low, place, y)
    np.maximum.at(high, place, y)
    return (high - low) / np.maximum(np.maximum(np.abs(low), np.abs(high)), 1e-300)


# --- the nodes above them --------------------------------------------------------------------------


class Tops:
    """The upper nodes of all trees (``slots``: fit x tree), as far as they are split over the cluster."""

    def __init__(self, slots: int) -> None:
        self.feature, self.cut = np.full((slots, 1), -1, np.int64), np.zeros((slots, 1), np.int64)
        self.left = np.zeros((slots, 1), np.int64)  # the right child is the next
        self.path, self.depth = np.ones((slots, 1), np.uint64), np.zeros((slots, 1), np.int64)
        self.value: list[dict[int, np.ndarray]] = [{} for _ in range(slots)]  # of the split nodes and of leaves
        self.size = np.ones(slots, np.int64)

    def route(self, slot: int, bins: np.ndarray, levels: int, rows: np.ndarray | None = None) -> np.ndarray:
        """The node of every row of ``bins`` in a tree, or of some rows."""
        flat, n = bins.ravel(), bins.shape[1]
        rows = np.arange(n) if rows is None else rows
        node = np.zeros(len(rows), np.int64)
        feature, cut, left = self.feature[slot], self.cut[slot], self.left[slot]
        going = np.arange(len(rows)) if feature[0] >= 0 else rows[:0]  # those that are not where they end
        at = node[going]
        for _ in range(levels):
            if not len(going):
                break
            at = left.take(at) + (flat.take(feature.take(at) * n + rows.take(going)) > cut.take(at))
            node[going] = at
            more = np.flatnonzero(feature.take(at) >= 0)
            if len(more) < len(at):
                going, at = going[more], at[more]
        return node

    def widen(self, width: int) -> None:
        more = width - self.feature.shape[1]
        if more > 0:
            pad = lambda x, v: np.pad(x, ((0, 0), (0, more)), constant_values=v)
            self.feature, self.cut, self.left = pad(self.feature, -1), pad(self.cut, 0), pad(self.left, 0)
            self.path, self.depth = pad(self.path, 0), pad(self.depth, 0)


class Forest:
    """Forests of some fits over some blocks."""

    def __init__(self, blocks: Blocks, fits: list[Fit], spec: Spec, local_rows: int | None = None) -> None:
        self.blocks, self.fits, self.spec = blocks, fits, spec
        self.local_rows = local_rows or max(LOCAL_ROWS, LOCAL_CELLS // max(blocks.features, 1))
        self.weights = balanced(class_counts(blocks, fits), blocks.n_classes)
        self.tops = Tops(len(fits) * spec.trees)
        self.levels = 0
        self.split_tops()

    def split_tops(self) -> None:
        """Split the nodes with many rows, level by level; a level is done in as many aggregates as its sums need."""
        spec, d = self.spec, self.blocks.features
        slots = range(len(self.fits) * spec.trees)
        nodes = [(s, 0) for s in slots]
        if self.blocks.n_rows <= self.local_rows:
            return
        while nodes and self.levels < spec.depth:
            trees = np.array([s % spec.trees for s, _ in nodes])
            order = feature_order(spec.seed, trees, np.array([self.tops.path[s, i] for s, i in nodes], np.uint64), d)
            tried = min(spec.tried, d)
            found = self.best_of(nodes, order[:, :tried])
            none = [i for i, (gain, *_) in enumerate(found) if gain == -np.inf and tried < d]  # not split by any of these features
            for i, other in zip(none, self.best_of([nodes[i] for i in none], order[none, tried:]), strict=True):
                found[i] = other
            following = []
            for (s, node), (gain, feature, cut, left, total) in zip(nodes, found, strict=True):
                if total[-1] <= self.local_rows:
                    continue  # small enough for a task
                value = self.tops.value[s][node] = node_value(total)
                if gain == -np.inf or (gain <= 0 if not spec.n_classes else value.max() > 1 - 1e-12):
                    continue  # a leaf
                child = int(self.tops.size[s])
                self.tops.widen(child + 2)
                self.tops.size[s] += 2
                self.tops.feature[s, node], self.tops.cut[s, node], self.tops.left[s, node] = feature, cut, child
                for side, part in enumerate((left, total - left)):
                    self.tops.path[s, child + side] = 2 * int(self.tops.path[s, node]) + side
                    self.tops.depth[s, child + side] = self.levels + 1
                    if self.levels + 1 == spec.depth:
                        self.tops.value[s][child + side] = node_value(part)
                    elif part[-1] > self.local_rows:
                        following.append((s, child + side))
            self.levels += 1
            nodes = following

    def best_of(self, nodes: list[tuple[int, int]], order: np.ndarray) -> list[tuple]:
        """(gain, feature, cut, sums of the left side, sums of all) of the best split of each node over the features of ``order``."""
        out: list[tuple] = []
        step = max(1, SUM_BYTES // max(1, order.shape[1] * BINS * (self.spec.outputs + 2) * 8))
        for at in range(0, len(nodes), step):
            some = order[at : at + step]
            sums = self.node_sums(nodes[at : at + step], some)
            gain, near = gains(np.moveaxis(sums[..., :-1], 3, 0))
            left = sums.cumsum(axis=2)
            best = (gain >= near[:, None]).argmax(axis=1)  # the first of the best
            for i, (j, cut) in enumerate(zip(*np.divmod(best, BINS), strict=True)):
                out.append((gain[i, best[i]], some[i, j], cut, left[i, j, cut], left[i, 0, -1]))
        return out

    def node_sums(self, nodes: list[tuple[int, int]], order: np.ndarray) -> np.ndarray:
        """Sums (nodes x tried features x bins x [outputs, weight, rows]) of some nodes."""
        spec, fits = self.spec, self.fits
        tops, levels, tried, k = self.tops, self.levels, order.shape[1], spec.n_classes
        asked: dict[int, dict[int, list[tuple[int, int]]]] = {}  # by tree and slot
        for i, (s, node) in enumerate(nodes):
            asked.setdefault(s % spec.trees, {}).setdefault(s, []).append((node, i))

        def visit(task: Iterable[Block]) -> list[np.ndarray]:
            total = np.zeros((len(nodes), tried, BINS, k or 2))  # rows by class, or sums and rows
            for b in task:
                member = [b.member(f) for f in fits]
                y = b.y.astype(np.int64) if k else b.y
                for t, slots in asked.items():
                    n = draws(spec.seed, t, b.block, b.n) if spec.bootstrap else np.ones(b.n, np.int64)  # the same in every fit
                    for s, mine in slots.items():
                        r = np.flatnonzero((n > 0) & member[s // spec.trees])
                        node = tops.route(s, b.bins, levels, r)
                        # All nodes of a tree at once: a scan of the rows for each node would make the work rows times nodes.
                        spot, i = np.full(int(node.max(initial=0)) + 1, -1), np.array([i for _, i in mine])
                        for number, (want, _) in enumerate(mine):
                            if want < len(spot):
                                spot[want] = number
                        at = spot[node]
                        here = np.flatnonzero(at >= 0)
                        at, r = at[here], r[here]
                        label, times = y[r], n[r]
                        for j in range(tried):
                            cell = at * BINS + b.bins[order[i[at], j], r]
                            if k:
                                total[i, j] += np.bincount(cell * k + label, times, len(mine) * BINS * k).reshape(-1, BINS, k)
                            else:
                                for x, v in enumerate((label * times, times)):
                                    total[i, j, :, x] += np.bincount(cell, v, len(mine) * BINS).reshape(-1, BINS)
            return [total]

        total = (sum_over(self.blocks.rdd, visit) or [np.zeros((len(nodes), tried, BINS, k or 2))])[0]  # SUM_BYTES at most
        if not k:
            return total[..., [0, 1, 1]]
        weights = self.weights[[s // spec.trees for s, _ in nodes]].reshape(-1, 1, 1, k)
        return np.concatenate([total * weights, (total * weights).sum(axis=3, keepdims=True), total.sum(axis=3, keepdims=True)], axis=3)

    # --- below the tops ---

    def parts(self, with_held: bool) -> DataFrame:
        """The rows of every unfinished node, a row for each of them in each block: (slot, node, block, bins, y, drawn, held...)."""
        spec, fits, features, splits = self.spec, self.fits, self.blocks.features, self.blocks.splits
        tops, levels, kind = self.tops, self.levels, number_type(spec)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in unpacked(batches, features, splits):
                drawn = [draws(spec.seed, t, b.block, b.n) if spec.bootstrap else np.ones(b.n, np.int64) for t in range(spec.trees)]
                bins, y = np.ascontiguousarray(b.bins.T), b.y.astype(kind)
                for m, fit in enumerate(fits):
                    member, held = b.member(fit), b.held(fit) & with_held
                    out = []
                    for t in range(spec.trees):
                        s = m * spec.trees + t
                        weight = drawn[t] * member
                        some = np.flatnonzero((weight > 0) | held)
                        node = tops.route(s, b.bins, levels, some)
                        by_node = np.argsort(node, kind="stable")
                        some, node = some[by_node], node[by_node]
                        for here in np.split(np.arange(len(some)), np.flatnonzero(node[1:] != node[:-1]) + 1) if len(some) else []:
                            i, rows = int(node[here[0]]), some[here]
                            # Rows of a finished leaf are not needed: its value is known.
                            r = rows[weight[rows] > 0] if i not in tops.value[s] else rows[:0]
                            h = rows[held[rows]]
                            if len(r) or len(h):
                                out.append((s, i, b.block, bins[r].tobytes(), y[r].tobytes(), weight[r].astype("u1").tobytes(), h.astype("<i4").tobytes(), bins[h].tobytes(), y[h].tobytes()))
                    if out:
                        kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 6]
                        names = ["slot", "node", "block", "bins", "y", "drawn", "held", "held_bins", "held_y"]
                        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        schema = "slot int, node int, block long, bins binary, y binary, drawn binary, held binary, held_bins binary, held_y binary"
        return self.blocks.frame.mapInArrow(run, schema).repartition("slot", "node").sortWithinPartitions("slot", "node", "block")

    def finish(self, cuts: list[int], sizes: list[int]) -> DataFrame:
        """(fit, part, band, rows, sums, y): for the rows each fit is scored on, dealt to parts by block, their place, the sums of their
        values over trees that are in no smaller number of ``sizes`` (a band), [rows, depth of ``cuts``, outputs], and their labels.
        A task adds up what its trees say of a row as long as the sums take no more than ``HELD_BYTES``."""
        spec, tops, features, weights = self.spec, self.tops, self.blocks.features, self.weights
        parts = -(-self.blocks.n_rows // TASK_ROWS)

        def passed(found: dict) -> Iterator[pa.RecordBatch]:
            for (m, band), pile in found.items():
                at, v, y = pile.close()
                part = (mix(at >> ROW_BITS) % np.uint64(parts)).astype(np.int64)
                for i in np.unique(part).tolist():
                    mine = part == i
                    data = [at[mine].tobytes(), v[mine].tobytes(), y[mine].tobytes()]
                    yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int32()) for x in (m, i, band)), *(pa.array([x], pa.binary()) for x in data)], names=["fit", "part", "band", "rows", "sums", "y"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[tuple[int, int], Pile] = {}
            for s, node, group in node_rows(batches, features, weights, spec):
                m, t = divmod(s, spec.trees)
                band = int(np.searchsorted(sizes, t, side="right"))
                if len(group["at"]) and band < len(sizes):
                    found.setdefault((m, band), Pile()).add(group["at"], grown_values(tops, spec, s, node, group, cuts).swapaxes(0, 1), group["held_y"])
                    if sum(x.bytes for x in found.values()) > HELD_BYTES:
                        for x in found.values():
                            x.fold()
                        if sum(x.bytes for x in found.values()) > HELD_BYTES // 2:
                            yield from passed(found)
                            found = {}
            yield from passed(found)

        return self.parts(True).mapInArrow(run, "fit int, part int, band int, rows binary, sums binary, y binary")

    def scores(self, cuts: list[int], sizes: list[int]) -> np.ndarray:
        """Fits x sizes x cuts x [actual x predicted class, or rows and squared errors] of the rows each fit is scored on."""
        k, n_classes, shape = self.spec.outputs, self.spec.n_classes, (len(sizes), len(cuts))
        width, trees, fits = (n_classes * n_classes or 2), np.array(sizes, float)[:, None], len(self.fits)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, now, held = np.zeros((fits, *shape, width)), None, {}

            def close() -> None:
                found = {band: pile.close() for band, pile in held.items()}
                every = np.unique(np.concatenate([at for at, *_ in found.values()]))
                v, y = np.zeros((len(every), *shape, k)), np.zeros(len(every))
                for band, (at, x, labels) in found.items():
                    of = np.searchsorted(every, at)
                    v[of, band], y[of] = x, labels
                v = v.cumsum(axis=1)
                if n_classes:
                    code = y.astype(int)[:, None, None] * n_classes + v.argmax(axis=3)
                    for i in np.ndindex(shape):
                        total[(now[0], *i)] += np.bincount(code[(slice(None), *i)], minlength=width)
                else:
                    total[now[0], :, :, 0] += len(every)
                    total[now[0], :, :, 1] += ((v[..., 0] / trees - y[:, None, None]) ** 2).sum(axis=0)

            for batch in batches:
                for m, part, band, at, v, y in zip(*(batch.column(i).to_pylist() for i in range(3)), *batch.columns[3:], strict=True):
                    if now is not None and now != (m, part):
                        close()
                        held = {}
                    now = (m, part)
                    at, v, y = (np.frombuffer(x.as_buffer(), t) for x, t in ((at, "<i8"), (v, "<f8"), (y, "<f8")))
                    pile = held.setdefault(band, Pile())
                    pile.add(at, v.reshape(len(at), len(cuts), k), y)
                    if pile.bytes > HELD_BYTES:
                        pile.fold()
            if held:
                close()
            yield keyed([0], [total])

        dealt = self.finish(cuts, sizes).repartition("fit", "part").sortWithinPartitions("fit", "part")
        rows = add_up(dealt.mapInArrow(run, "key int, sums binary")).collect()  # one row
        total = sum((np.frombuffer(r["sums"]) for r in rows), np.zeros(fits * shape[0] * shape[1] * width))
        return total.reshape(fits, *shape, *((n_classes, n_classes) if n_classes else (2,)))

    def trees(self) -> list[dict[str, np.ndarray]]:
        """The trees of the first fit, whole: nodes with feature (-1: a leaf), threshold, left, right and value."""
        spec, tops, features, weights = self.spec, self.tops, self.blocks.features, self.weights

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for s, node, group in node_rows(batches, features, weights, spec):
                below, _ = grow_here(group["rows"], group["held"], spec, s % spec.trees, int(tops.path[s, node]), int(tops.depth[s, node]), [])
                columns = [below["feature"].astype("<i4"), below["cut"].astype("<i4"), below["left"].astype("<i4"), below["right"].astype("<i4"), below["value"].astype("<f8")]
                yield pa.RecordBatch.from_pydict({"slot": pa.array([s], pa.int32()), "node": pa.array([node], pa.int32()), **{n: [c.tobytes()] for n, c in zip(NAMES, columns, strict=True)}})

        schema = "slot int, node int, " + ", ".join(f"{n} binary" for n in NAMES)
        rows = self.parts(False).where(f"slot < {spec.trees}").mapInArrow(run, schema).collect()  # a model, as any other that is trained
        below = {(r["slot"], r["node"]): r for r in rows}
        return [self.whole_tree(s, below) for s in range(spec.trees)]

    def whole_tree(self, slot: int, below: dict) -> dict[str, np.ndarray]:
        size, k = int(self.tops.size[slot]), self.spec.outputs
        feature, cut = self.tops.feature[slot, :size].copy(), self.tops.cut[slot, :size].copy()
        left = np.where(feature >= 0, self.tops.left[slot, :size], 0)
        right = np.where(feature >= 0, left + 1, 0)
        value = np.zeros((size, k))
        for node, v in self.tops.value[slot].items():
            value[node] = v
        tables = [[feature], [cut], [left], [right], [value]]
        for node in range(size):
            if (slot, node) not in below:
                continue
            r = below[slot, node]
            f, c, lo, hi = (np.frombuffer(r[n], "<i4").astype(np.int64) for n in NAMES[:4])
            v = np.frombuffer(r["value"]).reshape(-1, k)
            shift = sum(len(x) for x in tables[0]) - 1  # the first node below takes the place that is there
            lo, hi = np.where(f >= 0, lo + shift, 0), np.where(f >= 0, hi + shift, 0)
            for table, x in zip(tables, (f, c, lo, hi, v), strict=True):
                table[0][node] = x[0]
                table.append(x[1:])
        out = dict(zip(NAMES, (np.concatenate(t) for t in tables), strict=True))
        edges = self.blocks.edges
        out["threshold"] = np.array([edges[f][c] if f >= 0 else 0.0 for f, c in zip(out["feature"].tolist(), out.pop("cut").tolist(), strict=True)])
        return out


NAMES = ["feature", "cut", "left", "right", "value"]


def number_type(spec: Spec) -> str:
    return "<i2" if spec.n_classes else "<f8"


def node_rows(batches: Iterator[pa.RecordBatch], features: int, weights: np.ndarray, spec: Spec) -> Iterator[tuple[int, int, dict]]:
    """(slot, node, its rows) of batches sorted by slot and node."""
    now, held, kind = None, [], number_type(spec)

    def close() -> dict:
        take = lambda i, t: np.concatenate([np.frombuffer(r[i].as_buffer(), t) for r in held])
        at = [(r[0].as_py() << ROW_BITS) + np.frombuffer(r[4].as_buffer(), "<i4").astype(np.int64) for r in held]
        y = take(2, kind).astype(np.int64 if spec.n_classes else float)
        rows = Rows(take(1, "u1").reshape(-1, features), y, take(3, "u1").astype(np.int64), weights[now[0] // spec.trees], spec.n_classes)
        return {"rows": rows, "held": take(5, "u1").reshape(-1, features), "at": np.concatenate(at), "held_y": take(6, kind).astype(float)}

    for batch in batches:
        for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *batch.columns[2:], strict=True):
            if now is not None and now != row[:2]:
                yield *now, close()
                held = []
            now = row[:2]
            held.append(row[2:])
    if held:
        yield *now, close()


class Pile:
    """Sums by row: the places of rows, an array of values for each, and their labels; equal places are added up when it is folded."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.bytes = 0

    def add(self, at: np.ndarray, v: np.ndarray, y: np.ndarray) -> None:
        self.parts.append((at, v, y))
        self.bytes += at.nbytes + v.nbytes + y.nbytes

    def fold(self) -> None:
        at, v, y = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(at, kind="stable")
        at = at[order]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        self.parts, self.bytes = [], 0
        self.add(at[first], np.add.reduceat(v[order], first, axis=0), y[order[first]])

    def close(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each row once."""
        self.fold()
        return self.parts[0]


def grown_values(tops: Tops, spec: Spec, slot: int, node: int, group: dict, cuts: list[int]) -> np.ndarray:
    """The values of a node's held rows where its tree ends at each depth of ``cuts``."""
    path, depth, known = int(tops.path[slot, node]), int(tops.depth[slot, node]), tops.value[slot]
    if node in known:  # a leaf above
        out = np.broadcast_to(known[node], (len(cuts), len(group["held"]), spec.outputs)).copy()
    else:
        _, out = grow_here(group["rows"], group["held"], spec, slot % spec.trees, path, depth, cuts)
    for i, cut in enumerate(cuts):
        if cut < depth:  # the tree ends above this node
            above, lower = 0, path.bit_length() - 1
            for level in range(cut):
                above = int(tops.left[slot, above]) + (path >> (lower - level - 1) & 1)
            out[i] = known[above]
    return out
