"""Naive Bayes support vectors: a linear model over binary features.

Features are the indices (0 .. ``dimensions`` - 1) that a text has. Each is scaled
by the logarithm of the ratio of its smoothed class frequencies, then a linear
hinge-loss model is fitted by dual coordinate descent, classes weighted alike.
Margins become probabilities by a logistic fit on held-back thirds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Model:
    """``weights``: two rows, a feature's weight times its log-count ratio, and the
    square of the ratio (texts are scaled to unit length)."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, texts: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[0][t].sum() / (np.sqrt(self.weights[1][t].sum()) + 1e-9) for t in texts], float).reshape(-1)

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (margins + self.bias) + self.shift, -60, 60)))


def log_ratio(texts: list[np.ndarray], labels: np.ndarray, dimensions: int) -> np.ndarray:
    """Log of the ratio of a feature's share in class 1 to that in class 0."""
    share = []
    for c in (1, 0):
        own = [t for t, y in zip(texts, labels) if y == c]
        count = np.bincount(np.concatenate(own), minlength=dimensions) if own else np.zeros(dimensions)
        share.append((count + 1) / (len(own) + 2))
    return np.log(share[0] / share[1])


def descend(texts: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost=1.0, epochs=12, seed=7) -> tuple[np.ndarray, float]:
    """Hinge-loss weights and bias by dual coordinate descent (L1 loss).

    Rows are scaled to unit length, so texts of any length weigh alike."""
    sign = np.where(labels == 1, 1.0, -1.0)
    upper = np.where(labels == 1, cost * len(labels) / (2 * max(1, (labels == 1).sum())), cost * len(labels) / (2 * max(1, (labels == 0).sum())))
    values = [ratio[t] for t in texts]
    norm = np.array([np.sqrt((v * v).sum()) + 1e-9 for v in values])
    values = [v / k for v, k in zip(values, norm)]
    square = np.array([(v * v).sum() + 1.0 for v in values])
    alpha, weights, bias = np.zeros(len(texts)), np.zeros(len(ratio)), 0.0
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(len(texts)):
            slope = sign[i] * (weights[texts[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), upper[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                weights[texts[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weights, bias


def margins_of(texts: list[np.ndarray], weights: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    out = np.zeros(len(texts))
    for i, t in enumerate(texts):
        v = ratio[t]
        out[i] = (weights[t] @ v) / (np.sqrt((v * v).sum()) + 1e-9)
    return out


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic fit (Newton steps, smoothed targets)."""
    n1, n0 = (labels == 1).sum(), (labels == 0).sum()
    goal = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -60, 60)))
        w = p * (1 - p) + 1e-6
        gradient = np.array([((p - goal) * margins).sum() + 1e-3 * slope, (p - goal).sum()])
        hessian = np.array([[(w * margins * margins).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hessian, gradient)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return float(slope), float(shift)
