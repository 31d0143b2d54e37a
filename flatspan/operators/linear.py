"""Linear and logistic regression of many fits side by side, from sums over blocks.

Sums of products of [1, x, y] are taken once, over all rows and over each value of a split column; a fit's are the total less those of the
values it leaves out (which share no row).  They are all that linear regression and its errors need.  Logistic regression starts
from the ridge solution that they give for every penalty, and goes on with Newton steps, of all fits in one scan each.

What reaches the driver is bounded by fits, classes and features.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

from flatspan.operators.blocks import Block, Blocks, Fit, balanced, class_counts, sum_over

STEPS, TOLERANCE = 40, 1e-8
#: Bytes of second derivatives that one scan brings back.
SUM_BYTES = 16 << 20


def products(blocks: Blocks, values: list[tuple[str, int]]) -> tuple[np.ndarray, dict[tuple[str, int], np.ndarray]]:
    """Sums of the products of [1, x, y] by class, over all rows and over the rows of each value of a split column."""
    k, p, classes = max(blocks.n_classes, 1), blocks.features + 2, blocks.n_classes

    def visit(task: Iterable[Block]) -> list[np.ndarray]:
        total = np.zeros((len(values) + 1, k, p, p))
        for b in task:
            z = np.column_stack([np.ones(b.n), b.x, b.y])
            label = b.y.astype(int) if classes else np.zeros(b.n, int)
            for c in range(k):
                of = label == c
                total[0, c] += z[of].T @ z[of]
                for i, (column, value) in enumerate(values, 1):
                    some = z[of & (b.splits[column] == value)]
                    total[i, c] += some.T @ some
        return [total]

    out = (sum_over(blocks.rdd, visit) or [np.zeros((len(values) + 1, k, p, p))])[0]
    return out[0], dict(zip(values, out[1:], strict=True))


def left_over(total: np.ndarray, by: dict, fit: Fit) -> np.ndarray:
    return total - sum((by[v] for v in fit.out), np.zeros_like(total))


def linear_fits(blocks: Blocks, fits: list[Fit]) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients, the constant first, of every fit, and [rows, squared errors] of the rows it is scored on; one scan."""
    values = sorted({v for f in fits for v in [*f.out, *([f.held] if f.held else [])]})
    total, by = products(blocks, values)
    betas, errors = [], []
    for f in fits:
        g = left_over(total, by, f)[0]
        n = max(g[0, 0], 1.0)
        mean = g[0] / n
        centred = g - n * np.outer(mean, mean)
        scale = np.sqrt(np.maximum(np.diag(centred)[1:-1], 0.0))
        scale = np.where(scale > 1e-9 * np.sqrt(np.maximum(np.diag(g)[1:-1], 1e-300)), scale, np.inf)  # constant features have no part
        slope = np.linalg.lstsq(centred[1:-1, 1:-1] / np.outer(scale, scale), centred[1:-1, -1] / scale, rcond=1e-12)[0] / scale
        beta = np.r_[mean[-1] - mean[1:-1] @ slope, slope]
        betas.append(beta)
        h = by[f.held][0] if f.held else np.zeros_like(g)
        gap = np.r_[-beta, 1.0]
        errors.append((h[0, 0], max(gap @ h @ gap, 0.0)))
    return np.array(betas).reshape(len(fits), -1), np.array(errors).reshape(-1, 2)


def chances(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Rows x classes: the chance of each class; ``beta`` is [1 or classes] x [1, features]."""
    raw = beta[:, 0] + x @ beta[:, 1:].T
    raw = np.column_stack([np.zeros(len(x)), raw]) if len(beta) == 1 else raw
    e = np.exp(raw - raw.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Logistic:
    """Logistic regressions: ``points`` are (fit, C); C is the inverse of the penalty on the squared coefficients but the constants."""

    def __init__(self, blocks: Blocks, points: list[tuple[Fit, float]]) -> None:
        self.blocks, self.points = blocks, points
        self.fits = [f for f, _ in points]
        self.p, self.k = blocks.features + 1, blocks.n_classes if blocks.n_classes > 2 else 1
        plain = np.r_[0.0, np.ones(blocks.features)]
        self.penalty = np.array([np.tile(plain / c, self.k) for _, c in points])
        self.weights = balanced(class_counts(blocks, self.fits), blocks.n_classes)
        self.beta = self.ridge_start()
        self.solve()

    def ridge_start(self) -> np.ndarray:
        """The first Newton step from zero of every point, from sums of products alone."""
        values = sorted({v for f in self.fits for v in f.out})
        total, by = products(self.blocks, values)
        classes, k, p, out = max(self.blocks.n_classes, 2), self.k, self.p, []
        for i, f in enumerate(self.fits):
            g = left_over(total, by, f) * self.weights[i][:, None, None]
            second, sums = g.sum(axis=0)[:p, :p], g[:, 0, :p]
            if k == 1:
                hessian, slope = second / 4, (sums[0] - sums[1]) / 2
            else:
                hessian = np.kron(np.eye(k) / k - 1 / k**2, second)
                slope = (sums.sum(axis=0) / classes - sums).ravel()
            out.append(-step(hessian, slope, self.penalty[i]))
        return np.array(out).reshape(len(self.points), k, p)

    def derivatives(self, some: list[int], beta: np.ndarray) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Loss, gradient and second derivatives (without the penalty) of some points at ``beta``."""
        fits, weights, k, p = [self.fits[i] for i in some], self.weights[some], self.k, self.p
        here, size = beta[some], self.k * self.p

        def visit(task: Iterable[Block]) -> list[np.ndarray]:
            total = np.zeros((len(fits), 1 + size + size * size))
            for b in task:
                label = b.y.astype(int)
                z = np.column_stack([np.ones(b.n), b.x])
                for i, f in enumerate(fits):
                    of = np.flatnonzero(b.member(f))
                    x, y, w = z[of], label[of], weights[i][label[of]]
                    c = chances(b.x[of], here[i])
                    total[i, 0] += -(w * np.log(np.maximum(c[np.arange(len(of)), y], 1e-300))).sum()
                    gap = (c - (np.arange(c.shape[1]) == y[:, None]))[:, -k:] * w[:, None]
                    total[i, 1 : 1 + size] += (gap.T @ x).ravel()
                    second = total[i, 1 + size :].reshape(k, p, k, p)
                    c = c[:, -k:]
                    for a in range(k):
                        for o in range(a + 1):
                            part = (x * (w * c[:, a] * ((a == o) - c[:, o]))[:, None]).T @ x
                            second[a, :, o, :] += part
                            if o < a:
                                second[o, :, a, :] += part
            return [total]

        total = (sum_over(self.blocks.rdd, visit) or [np.zeros((len(fits), 1 + size + size * size))])[0]
        return [(v[0], v[1 : 1 + size], v[1 + size :].reshape(size, size)) for v in total]

    def solve(self) -> None:
        """Newton steps of all points that have not settled, halved where the loss does not fall."""
        size = self.k * self.p
        at_once = max(1, SUM_BYTES // (8 * size * size))
        flat = self.beta.reshape(len(self.points), size)
        best = [(np.inf, None)] * len(self.points)  # loss and the step taken from the best place
        place = np.zeros_like(flat)
        todo = list(range(len(self.points)))
        for _ in range(STEPS):
            following = []
            for start in range(0, len(todo), at_once):
                some = todo[start : start + at_once]
                for i, (loss, slope, hessian) in zip(some, self.derivatives(some, flat.reshape(self.beta.shape)), strict=True):
                    loss += 0.5 * (self.penalty[i] * flat[i] ** 2).sum()
                    before, move = best[i]
                    if loss > before + 1e-12 * abs(before):
                        move = move / 2
                        best[i] = (before, move)
                        if np.abs(move).max() > TOLERANCE * (1 + np.abs(place[i]).max()):
                            flat[i] = place[i] + move
                            following.append(i)
                        else:
                            flat[i] = place[i]
                        continue
                    place[i] = flat[i]
                    slope = slope + self.penalty[i] * flat[i]
                    move = -step(hessian, slope, self.penalty[i])
                    best[i] = (loss, move)
                    if np.abs(move).max() > TOLERANCE * (1 + np.abs(flat[i]).max()) and -(slope @ move) > 1e-12 * (1 + abs(loss)):
                        flat[i] = place[i] + move
                        following.append(i)
            todo = following
            if not todo:
                break
        flat[todo] = place[todo]
        self.beta = flat.reshape(self.beta.shape)

    def confusion(self) -> np.ndarray:
        """Points x actual x predicted class of the rows that each is scored on."""
        fits, beta, c = self.fits, self.beta, self.blocks.n_classes

        def visit(task: Iterable[Block]) -> list[np.ndarray]:
            total = np.zeros((len(fits), c, c))
            for b in task:
                for i, f in enumerate(fits):
                    held = b.held(f)
                    predicted = chances(b.x[held], beta[i]).argmax(axis=1)
                    total[i] += np.bincount(b.y[held].astype(int) * c + predicted, minlength=c * c).reshape(c, c)
            return [total]

        return (sum_over(self.blocks.rdd, visit) or [np.zeros((len(fits), c, c))])[0]


def step(hessian: np.ndarray, slope: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """The solution of a Newton step.  Directions that the rows say nothing about, and no penalty, are left alone."""
    h = hessian + np.diag(penalty)
    scale = 1 / np.sqrt(np.maximum(np.diag(h), 1e-300))
    scaled = h * np.outer(scale, scale)
    try:
        np.linalg.cholesky(scaled + 1e-11 * np.eye(len(h)))
        return scale * np.linalg.solve(scaled + 1e-11 * np.eye(len(h)), scale * slope)
    except np.linalg.LinAlgError:
        values, axes = np.linalg.eigh(scaled)
        good = values > 1e-13 * max(values[-1], 1e-300)
        return scale * (axes[:, good] @ ((axes[:, good].T @ (scale * slope)) / values[good]))
