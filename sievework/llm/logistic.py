"""A small weighted logistic regression, fitted by Newton steps on the driver."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Logistic:
    """Weights over standardised features; `bias` alone where there was nothing to learn."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((np.asarray(x, float) - self.mean) / self.scale) @ self.weights + self.bias

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None, l2: float = 1.0, steps: int = 30) -> Logistic:
    """Fit on rows x with labels or probabilities y in [0, 1] and row weights w."""
    n, k = x.shape
    w = np.ones(n) if w is None else w
    if not n or not 0 < (share := float((w * y).sum() / max(w.sum(), 1e-12))) < 1:
        share = float(np.clip(share if n else 0.5, 0.01, 0.99))
        return Logistic(np.zeros(k), np.ones(k), np.zeros(k), float(np.log(share / (1 - share))))
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.column_stack([(x - mean) / scale, np.ones(n)])
    penalty = np.diag([l2] * k + [1e-6])
    b = np.zeros(k + 1)
    b[-1] = np.log(share / (1 - share))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        g = z.T @ (w * (p - y)) + penalty @ b
        h = (z * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + penalty
        step = np.linalg.solve(h, g)
        b -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-7:
            break
    return Logistic(mean, scale, b[:-1], float(b[-1]))
