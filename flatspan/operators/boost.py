"""Gradient boosting on histograms, many fits side by side.

A round grows one tree for each fit and each output (one for numbers and for two classes, one a class for more: softmax).  A level of all
these trees is one aggregate over the blocks: sums of gradients, hessians and rows for every node, feature and bin.  Only the
smaller child of a split is summed; its sibling is the parent less it.  Folds, seeds and learning rates are further fits, so
their number changes the size of the sums and not the number of jobs.  A fit of 200 rounds holds the one of 100 as its first 100 trees: it is
scored on the way.  Raw scores are kept with the bins of the blocks after each round, and written every ``CHECKPOINT`` rounds, so that what a
lost executor held is worked out again from at most that many.

What reaches the driver is bounded by fits, nodes, features and bins, whatever the number of rows; fits whose sums of a level would be
above ``SUM_BYTES`` together grow their trees one part of the fits after the other.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD, StorageLevel

from flatspan.operators.blocks import BINS, Block, Blocks, Fit, balanced, bundles, class_counts, sum_over
from flatspan.session import new_stage_path

DEPTH, MIN_ROWS, MIN_HESSIAN = 5, 20, 1e-3
CHECKPOINT = 10
#: Sums of a level that reach the driver at once; a single fit may be above.
SUM_BYTES = 16 << 20
LEFT = 255  # the cut of a node that sends all rows left


@dataclass
class Trees:
    """Complete trees of one depth: [round, output, place] of features and cuts, values of the leaves, and the scores before the first."""

    base: np.ndarray
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)


def descend(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node (heap place) of every row (columns of ``bins``) in every tree after some levels: trees x rows."""
    flat, rows, node = bins.ravel(), np.arange(bins.shape[1]), np.zeros((len(feature), bins.shape[1]), np.int64)
    first = np.arange(len(feature))[:, None] * feature.shape[1]
    feature, cut = feature.ravel(), cut.ravel()
    for _ in range(levels):
        at = first + node
        node = 2 * node + 1 + (flat.take(feature.take(at) * len(rows) + rows) > cut.take(at))
    return node


def gradients(raw: np.ndarray, y: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss by each output: squared error, logistic or softmax."""
    if n_classes == 0:
        return raw - y, np.ones_like(raw)
    if n_classes == 2:
        p = 1 / (1 + np.exp(-raw))
        return p - y, p * (1 - p)
    each = raw.reshape(-1, n_classes, raw.shape[1])
    p = np.exp(each - each.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    return (p - (np.arange(n_classes)[:, None] == y)).reshape(raw.shape), (p * (1 - p)).reshape(raw.shape)


def best_splits(sums: np.ndarray, min_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each node of ``sums`` (nodes x features x bins x [gradient, hessian, rows]) whether it splits, the feature, the bin
    of the last row that goes left, and what goes left."""
    left = sums.cumsum(axis=2)
    total = left[:, :, -1:, :]
    right = total - left
    score = lambda s: s[..., 0] ** 2 / np.maximum(s[..., 1], 1e-12)
    gain = score(left) + score(right) - score(total)
    good = (left[..., 2] >= min_rows) & (right[..., 2] >= min_rows) & (left[..., 1] >= MIN_HESSIAN) & (right[..., 1] >= MIN_HESSIAN)
    flat = np.where(good, gain, -np.inf).reshape(len(sums), -1)
    best = flat.argmax(axis=1)
    feature, cut = np.divmod(best, sums.shape[2])
    value = flat[np.arange(len(sums)), best]
    return value > 1e-12 * np.maximum(1.0, score(total)[:, 0, 0]), feature, cut, left[np.arange(len(sums)), feature, cut]


class Boosting:
    """Some fits over some blocks: ``rates`` holds the learning rate of each."""

    def __init__(self, blocks: Blocks, fits: list[Fit], rates: list[float], depth: int = DEPTH, min_rows: int = MIN_ROWS) -> None:
        self.blocks, self.fits, self.depth, self.min_rows = blocks, fits, depth, min_rows
        self.outputs = blocks.n_classes if blocks.n_classes > 2 else 1
        self.rate = np.repeat(np.array(rates, float), self.outputs)
        counts = class_counts(blocks, fits)
        self.weights = balanced(counts, blocks.n_classes)
        self.trees = Trees(self.first_scores(counts))
        base, joint = self.trees.base, bundles(blocks)
        self.bundles, alone = joint, sorted({*range(blocks.features)} - {int(j) for x in joint for j in x.features})
        self.alone = np.array(alone, int)
        #: Whether the driver may have the sums of all tasks at once.
        self.at_once = blocks.rdd.getNumPartitions() * self.level_bytes * min(self.part_size, len(fits)) <= SUM_BYTES
        # What is summed is in the place of the features: the bins of bundles.
        slim = lambda b: Block(b.block, b.n, np.array([x.column(b.bins) for x in joint], np.uint8).reshape(-1, b.n), b.bins, b.y, b.splits)
        # Blocks with their raw scores after all rounds so far.
        self.state = blocks.rdd.map(lambda b: (slim(b), np.repeat(base[:, None], b.n, axis=1))).persist(StorageLevel.MEMORY_AND_DISK)
        self.older: RDD | None = None

    def first_scores(self, counts: np.ndarray) -> np.ndarray:
        """The best constant of every output: the mean, or the logarithms of the weighted shares."""
        if self.blocks.n_classes == 0:
            fits = self.fits
            sums = sum_over(self.blocks.rdd, lambda task: [sum((np.array([b.y[b.member(f)].sum() for f in fits]) for b in task), np.zeros(len(fits)))])
            return np.zeros(len(fits)) if sums is None else sums[0] / np.maximum(counts[:, 0], 1)
        share = counts * self.weights
        share = np.maximum(share / np.maximum(share.sum(axis=1, keepdims=True), 1), 1e-9)
        if self.blocks.n_classes == 2:
            return np.log(share[:, 1] / share[:, 0])
        logs = np.log(share)
        return (logs - logs.mean(axis=1, keepdims=True)).ravel()

    # --- scans over the blocks ---

    def aggregate(self, of) -> np.ndarray | None:
        """The sum over all blocks of the array that ``of(fits, block, raw)`` gives: bounded by fits, nodes, features and bins."""
        fits = self.fits

        def visit(task: Iterable[tuple[Block, np.ndarray]]) -> list[np.ndarray] | None:
            total = None
            for b, raw in task:
                part = of(fits, b, raw)
                total = part if total is None else total + part
            return None if total is None else [total]

        found = sum_over(self.state, visit, self.at_once)
        return None if found is None else found[0]

    # --- growing ---

    def grow(self, rounds: int) -> Trees:
        """Go on until there are ``rounds`` trees for each output."""
        while len(self.trees.value) < rounds:
            self.one_round()
            self.add_last()
        return self.trees

    def add_last(self) -> None:
        """Add the last trees to the raw scores; every ``CHECKPOINT`` rounds these are written, which cuts their lineage."""
        feature, cut, value, depth = self.trees.feature[-1], self.trees.cut[-1], self.trees.value[-1], self.depth

        def more(pair: tuple[Block, np.ndarray]) -> tuple[Block, np.ndarray]:
            b, raw = pair
            leaf = descend(b.bins, feature, cut, depth) - (2**depth - 1)
            return b, raw + value.ravel().take(leaf + np.arange(len(value))[:, None] * value.shape[1])

        self.forget()
        self.older, self.state = self.state, self.state.map(more)
        if len(self.trees.value) % CHECKPOINT == 0:
            path = new_stage_path(self.blocks.frame.sparkSession, "boosting")
            self.state.saveAsPickleFile(path, 1)
            self.state = self.blocks.rdd.context.pickleFile(path, self.blocks.rdd.getNumPartitions())
        self.state = self.state.persist(StorageLevel.MEMORY_AND_DISK)

    def forget(self) -> None:
        """Let go of the raw scores before the last, once these are there."""
        if self.older is not None:
            self.older.unpersist()
            self.older = None

    def release(self) -> None:
        self.forget()
        self.state.unpersist()

    def level_sums(self, some: slice, feature: np.ndarray, cut: np.ndarray, level: int, place: np.ndarray, active: int) -> np.ndarray:
        """The sums of ``active`` nodes of a level of some fits; ``place`` (outputs x nodes of the level) has their numbers, or -1."""
        weights, outputs, k, alone = self.weights[some], self.outputs, self.blocks.n_classes, self.alone
        mine, columns = slice(some.start * outputs, some.stop * outputs), len(self.alone) + len(self.bundles)

        def of(fits: list[Fit], b: Block, raw: np.ndarray) -> np.ndarray:
            member = np.repeat(np.stack([b.member(f) for f in fits[some]]), outputs, axis=0)
            node = descend(b.bins, feature, cut, level) - (2**level - 1)
            number = place.ravel().take(node + np.arange(len(place))[:, None] * place.shape[1])
            pairs = np.flatnonzero((number >= 0) & member)  # of outputs and rows
            s, r = np.divmod(pairs, b.n)
            y, raw = b.y.take(r), raw[mine]
            if outputs == 1:
                g, h = gradients(raw.ravel().take(pairs), y, k)
            else:
                g, h = (x.ravel().take(pairs) for x in gradients(raw, b.y, k))
            if k:
                w = weights.ravel().take(s // outputs * k + y.astype(int))
                g, h = g * w, h * w
            start = number.ravel().take(pairs) * BINS
            sums = np.empty((columns, active * BINS, 3))
            for c in range(columns):
                at = start + (b.bins[alone[c]] if c < len(alone) else b.x[c - len(alone)]).take(r)
                for i, v in enumerate((g, h, None)):
                    sums[c, :, i] = np.bincount(at, v, active * BINS)
            return sums

        whole = self.aggregate(of)
        if whole is None:
            return np.zeros((0, self.blocks.features, BINS, 3))
        return self.by_feature(whole.reshape(columns, active, BINS, 3))

    def by_feature(self, sums: np.ndarray) -> np.ndarray:
        """Nodes x features x bins x 3 of the sums by column; those of a bundle are added up by the bins of each of its features."""
        out = np.zeros((sums.shape[1], self.blocks.features, BINS, 3))
        out[:, self.alone] = sums[: len(self.alone)].swapaxes(0, 1)
        for column, x in zip(sums[len(self.alone) :], self.bundles, strict=True):
            for i, j in enumerate(x.features):
                for v in np.unique(x.bins[:, i]):
                    out[:, j, v] = column[:, np.flatnonzero(x.bins[:, i] == v)].sum(axis=1)
        return out

    @property
    def level_bytes(self) -> int:
        """The sums of the last level of a fit, half its nodes."""
        return max(self.outputs * max(2 ** (self.depth - 2), 1) * self.blocks.features * BINS * 3 * 8, 1)

    @property
    def part_size(self) -> int:
        return max(SUM_BYTES // self.level_bytes, 1)

    def parts(self) -> list[slice]:
        """The fits in parts whose sums of the last level, half its nodes, stay within ``SUM_BYTES``."""
        size = self.part_size
        return [slice(at, min(at + size, len(self.fits))) for at in range(0, len(self.fits), size)]

    def one_round(self) -> None:
        """A tree for each output of each fit."""
        grown = [self.one_part(some) for some in self.parts()]
        for kept, found in zip((self.trees.feature, self.trees.cut, self.trees.value), zip(*grown, strict=True), strict=True):
            kept.append(np.concatenate(found))

    def one_part(self, some: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next trees of some fits, level by level: features, cuts, values."""
        rate, depth = self.rate[some.start * self.outputs : some.stop * self.outputs], self.depth
        n = len(rate)
        feature, cut = np.zeros((n, 2**depth - 1), np.int64), np.full((n, 2**depth - 1), LEFT, np.int64)
        value = np.zeros((n, 2**depth))
        nodes = [(s, 0) for s in range(n)]  # (output, place in the level) whose sums are asked for
        siblings: list[tuple[int, int]] = []  # of each asked node but the roots, and the sums of their parents
        parents = np.zeros(0)
        for level in range(depth):
            place = np.full((n, 2**level), -1, np.int64)
            for i, (s, p) in enumerate(nodes):
                place[s, p] = i
            sums = self.level_sums(some, feature, cut, level, place, len(nodes))
            if level == 0:
                self.forget()
            if not len(sums):
                break
            if level:
                sums, nodes = np.concatenate([sums, parents - sums]), nodes + siblings
            else:
                total = sums[:, 0].sum(axis=1)
                value[:] = leaf_values(total, rate)[:, None]
            splits, by, last, left = best_splits(sums, self.min_rows)
            whole = sums[:, 0].sum(axis=1)
            width = 2 ** (depth - level)
            asked, siblings, kept = [], [], []
            for i in np.flatnonzero(splits).tolist():
                s, p = nodes[i]
                feature[s, 2**level - 1 + p], cut[s, 2**level - 1 + p] = by[i], last[i]
                sides = np.stack([left[i], whole[i] - left[i]])
                v = leaf_values(sides, rate[s])
                value[s, p * width : p * width + width // 2], value[s, p * width + width // 2 : (p + 1) * width] = v
                small = int(sides[1, 2] < sides[0, 2])
                if level + 1 < depth and sides[:, 2].max() >= 2 * self.min_rows:
                    asked.append((s, 2 * p + small))
                    siblings.append((s, 2 * p + 1 - small))
                    kept.append(i)
            nodes, parents = asked, sums[kept]
            if not nodes:
                break
        return feature, cut, value

    # --- scores ---

    def confusion(self) -> np.ndarray:
        """Fits x actual x predicted class: rows that each fit is scored on, after the trees so far."""
        k, outputs = self.blocks.n_classes, self.outputs

        def of(fits: list[Fit], b: Block, raw: np.ndarray) -> np.ndarray:
            out = np.zeros((len(fits), k, k))
            for m, f in enumerate(fits):
                held = b.held(f)
                each = raw[m * outputs : (m + 1) * outputs, held]
                predicted = each.argmax(axis=0) if k > 2 else (each[0] > 0).astype(int)
                out[m] = np.bincount(b.y[held].astype(int) * k + predicted, minlength=k * k).reshape(k, k)
            return out

        found = self.aggregate(of)
        return np.zeros((len(self.fits), k, k)) if found is None else found

    def squared_errors(self) -> np.ndarray:
        """Fits x [rows, sum of squared errors] of the rows that each fit is scored on."""

        def of(fits: list[Fit], b: Block, raw: np.ndarray) -> np.ndarray:
            held = [b.held(f) for f in fits]
            return np.array([[h.sum(), ((raw[m, h] - b.y[h]) ** 2).sum()] for m, h in enumerate(held)])

        found = self.aggregate(of)
        return np.zeros((len(self.fits), 2)) if found is None else found


def leaf_values(sums: np.ndarray, rate) -> np.ndarray:
    return np.where(sums[..., 1] > 0, -sums[..., 0] * rate / np.maximum(sums[..., 1], 1e-12), 0.0)
