"""Logistic regression on sparse rows, for a bounded sample on the driver or in a task."""

from __future__ import annotations

import numpy as np


class SparseRows:
    """Rows of (column, value) with ``width`` columns."""

    def __init__(self, owner: np.ndarray, column: np.ndarray, rows: int, width: int, value: np.ndarray | None = None):
        self.owner, self.column, self.rows, self.width = owner, column, rows, width
        self.value = np.ones(len(owner)) if value is None else value

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights[self.column] * self.value, self.rows)

    def transposed_dot(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, errors[self.owner] * self.value, self.width)

    def of(self, chosen: np.ndarray) -> SparseRows:
        """The rows marked in ``chosen``, renumbered."""
        entries = chosen[self.owner]
        number = np.cumsum(chosen) - 1
        return SparseRows(number[self.owner[entries]], self.column[entries], int(chosen.sum()), self.width, self.value[entries])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def minimise(function, start: np.ndarray, steps: int = 60, memory: int = 8, tolerance: float = 1e-5) -> np.ndarray:
    """L-BFGS with step halving; ``function`` returns the value and the gradient."""
    x = start.copy()
    value, slope = function(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction, kept = slope.copy(), []
        for s, y in reversed(moves):
            a = s @ direction / (y @ s)
            kept.append(a)
            direction -= a * y
        if moves:
            s, y = moves[-1]
            direction *= s @ y / (y @ y)
        for (s, y), a in zip(moves, reversed(kept)):
            direction += (a - y @ direction / (y @ s)) * s
        step, fall = 1.0 if moves else 1.0 / max(1.0, np.abs(slope).max()), slope @ direction
        while step > 1e-10:
            there, slope_there = function(x - step * direction)
            if there <= value - 1e-4 * step * fall:
                break
            step /= 2
        else:
            break
        move, change = -step * direction, slope_there - slope
        if move @ change > 1e-12:
            moves = [*moves, (move, change)][-memory:]
        done = value - there < tolerance * max(abs(value), 1e-12)
        x, value, slope = x + move, there, slope_there
        if done:
            break
    return x


def fit_logistic(rows: SparseRows, label: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights, the last one the intercept, that minimise log loss plus ``penalty`` / 2 times the squared weights."""

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = rows.dot(w[:-1]) + w[-1]
        error = sigmoid(z) - label
        value = np.logaddexp(0, z).sum() - (label * z).sum() + penalty / 2 * (w[:-1] @ w[:-1])
        return value, np.append(rows.transposed_dot(error) + penalty * w[:-1], error.sum())

    return minimise(loss, np.zeros(rows.width + 1))


def predict_logistic(rows: SparseRows, weights: np.ndarray) -> np.ndarray:
    return sigmoid(rows.dot(weights[:-1]) + weights[-1])
