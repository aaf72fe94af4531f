"""Logistic regression on sparse rows, in numpy: the small learner both classifiers share."""

from __future__ import annotations

import numpy as np


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def fit_logistic(row: np.ndarray, col: np.ndarray, value: np.ndarray, y: np.ndarray, weight: np.ndarray, width: int,
                 l2: float = 1.0, steps: int = 100, memory: int = 10) -> tuple[np.ndarray, float]:
    """Weights and bias for soft labels ``y`` of rows given as (row, col, value) triples.

    Minimises the weighted mean log loss plus l2 / (2n) of the squared weights
    by limited-memory quasi-Newton steps; the same input gives the same weights.
    """
    n = len(y)
    weight = weight / weight.sum()

    def loss(x):
        z = np.bincount(row, value * x[col], n) + x[width]
        p = sigmoid(z)
        miss = (p - y) * weight
        f = (weight * (np.logaddexp(0, z) - y * z)).sum() + l2 / (2 * n) * (x[:width] @ x[:width])
        return f, np.append(np.bincount(col, value * miss[row], width) + l2 / n * x[:width], miss.sum())

    x = np.zeros(width + 1)
    f, g = loss(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, kept = -g, []
        for s, u in reversed(past):
            a = (s @ d) / (s @ u)
            d = d - a * u
            kept.append(a)
        if past:
            s, u = past[-1]
            d = d * ((s @ u) / (u @ u))
        for (s, u), a in zip(past, reversed(kept)):
            d = d + s * (a - (u @ d) / (s @ u))
        slope, step = g @ d, 1.0 if past else 1.0 / max(1.0, np.abs(g).sum())
        while True:
            f2, g2 = loss(x + step * d)
            if f2 <= f + 1e-4 * step * slope or step < 1e-10:
                break
            step /= 2
        s, u = step * d, g2 - g
        x, done, f, g = x + s, abs(f - f2) <= 1e-9 * max(1.0, abs(f)), f2, g2
        if s @ u > 1e-12:
            past = [*past[1 - memory:], (s, u)] if memory > 1 else [(s, u)]
        if done:
            break
    return x[:width], float(x[width])
