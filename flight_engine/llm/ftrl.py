"""Sparse multinomial logistic regression by follow-the-regularised-leader.

Per-coordinate FTRL-proximal updates with elastic-net penalties, over a bounded
sample of rows on the driver; the samples' bounds are parameters of the callers.
"""

from __future__ import annotations

import numpy as np


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Weights (dims x classes); coordinate 0 of every row is the bias."""

    def __init__(self, dims: int, classes: int, alpha: float = 0.5, beta: float = 1.0,
                 l1: float = 1e-4, l2: float = 1e-4):
        self.z = np.zeros((dims, classes))
        self.n = np.zeros((dims, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def step(self, ids: np.ndarray, x: np.ndarray, y: int) -> None:
        """One row: distinct coordinates, their values, the class."""
        w = self.weights(ids)
        p = softmax(x @ w)
        p[y] -= 1
        g = x[:, None] * p[None, :]
        n = self.n[ids]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[ids] += g - sigma * w
        self.n[ids] = n + g * g


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], dims: int, classes: int, epochs: int = 4,
          seed: int = 7, **penalty) -> np.ndarray:
    """Weights learnt from (ids, values, class) rows in a fixed random order."""
    model, order = Ftrl(dims, classes, **penalty), np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            model.step(*rows[i])
    return model.weights()


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log-loss on held-back rows (golden section on its logarithm)."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return float(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).mean())

    a, b, r = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))
