"""Alignment and counting kernels that have no column expression."""

from __future__ import annotations

import math

import numpy as np


def _scores(a: np.ndarray, b: np.ndarray, local: bool, match: int, mismatch: int, gap_open: int, gap_extend: int) -> np.ndarray:
    """Affine-gap scores of pairs of code-point rows of one length each, all pairs at once, a character of a at a time."""
    n, width = b.shape
    steps = np.arange(width + 1) * gap_extend
    row = np.zeros((n, width + 1))
    if not local:
        row[:, 1:] = gap_open + steps[:-1]
    down, best = np.full((n, width + 1), -np.inf), np.zeros(n)
    for i in range(a.shape[1]):
        down = np.maximum(down + gap_extend, row + gap_open)
        cell = np.empty((n, width + 1))
        cell[:, 0] = 0 if local else gap_open + i * gap_extend
        cell[:, 1:] = row[:, :-1] + np.where(b == a[:, [i]], match, mismatch)
        cell = np.maximum(cell, down)
        if local:
            cell = np.maximum(cell, 0)
        # a gap along the row opens from the best cell to its left
        left = np.maximum.accumulate(cell - steps, axis=1)
        row = cell
        row[:, 1:] = np.maximum(cell[:, 1:], left[:, :-1] + steps[1:] + gap_open - gap_extend)
        best = np.maximum(best, row.max(1))
    return best if local else row[:, -1]


def scores(a: list[str], b: list[str], local: bool, match: int = 1, mismatch: int = -1, gap_open: int = -3, gap_extend: int = -1) -> list[int]:
    """Best alignment scores of pairs with affine gaps, of all of both texts or of any part of each; pairs of equal lengths go together."""
    out = np.zeros(len(a), np.int64)
    groups: dict[tuple[int, int], list[int]] = {}
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        groups.setdefault((len(x), len(y)), []).append(i)
    points = lambda texts, size: np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(len(texts), size)
    for (m, n), at in groups.items():
        out[at] = _scores(points([a[i] for i in at], m), points([b[i] for i in at], n), local, match, mismatch, gap_open, gap_extend)
    return out.tolist()


def binomial_cdf(k: int, n: int, p: float) -> float:
    """Chance of at most k successes."""
    if k >= n or p <= 0:
        return 1.0
    if k < 0 or p >= 1:
        return 0.0
    i = np.arange(k + 1)
    logs = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) for j in i] + i * math.log(p) + (n - i) * math.log1p(-p)
    return float(min(1.0, np.exp(logs).sum()))


def few_distinct(m: int, x: int, n: int) -> float:
    """Chance that x draws out of n kinds show at most m of them."""
    if m >= min(x, n):
        return 1.0
    state = np.zeros(m + 2)  # kinds seen so far; the last place holds more than m
    state[0] = 1.0
    seen = np.arange(m + 2)
    stay, move = seen / n, (n - seen) / n
    for _ in range(x):
        fresh = state * move
        state = state * stay
        state[1:] += fresh[:-1]
        state[-1] += fresh[-1]
    return float(min(1.0, state[: m + 1].sum()))


def total_cells(seen: float, partitions: int) -> float:
    """Cells that fill so many partitions with at least one, when each takes any: seen = n (1 - (1 - 1/n)^cells)."""
    if not 0 <= seen < partitions:
        raise ValueError("more partitions are filled than there are")
    return math.log1p(-seen / partitions) / math.log1p(-1 / partitions)
