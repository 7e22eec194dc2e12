"""Sparse logistic regression on a bounded sample, and calibration of its scores."""

from __future__ import annotations

import numpy as np

from carelake.llm.scan import sums


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(index: np.ndarray, values: np.ndarray, off: np.ndarray, target: np.ndarray, dims: int, epochs: int, rate: float = 0.1, l2: float = 1e-6) -> tuple[np.ndarray, float]:
    """(weights, bias) by full-batch Adam; ``target`` may hold probabilities. Rows are [off[i], off[i+1]) of index and values."""
    w, b = np.zeros(dims), 0.0
    m, v = np.zeros(dims + 1), np.zeros(dims + 1)
    if not len(target):
        return w, b
    mean = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    b, lens = float(np.log(mean / (1 - mean))), np.diff(off)
    for t in range(1, epochs + 1):
        error = sigmoid(sums(w[index] * values, off) + b) - target
        g = np.append(np.bincount(index, np.repeat(error, lens) * values, dims) / len(target) + l2 * w, error.mean())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - float(step[-1])
    return w, b


def calibrate(scores: np.ndarray, labels: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Platt scaling: (slope, shift) so that sigmoid(slope * score + shift) is a probability. Labels are smoothed."""
    if len(labels) < 2 or labels.min() == labels.max():
        return 1.0, 0.0
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    spread = max(float(scores.std()), 1e-9)
    x = np.stack(((scores - scores.mean()) / spread, np.ones(len(scores))))
    a = np.zeros(2)
    for _ in range(steps):
        p = sigmoid(a @ x)
        hessian = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x @ (p - target))
        a -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(a[0] / spread), float(a[1] - a[0] * scores.mean() / spread)
