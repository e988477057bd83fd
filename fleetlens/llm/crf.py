"""Linear-chain conditional random field with two labels over sequences of sparse feature rows.

All sequences of a batch are worked on at once: step t of the forward, backward or Viterbi recursion
takes the t-th element of every sequence that has one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from fleetlens.llm.linear import SparseRows, minimise


@dataclass
class Chain:
    """``weights`` score label 1 against 0 per feature; ``moves[a, b]`` scores label b after label a."""

    weights: np.ndarray
    bias: float
    moves: np.ndarray

    def emissions(self, rows: SparseRows) -> np.ndarray:
        return rows.dot(self.weights) + self.bias


def _steps(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences by falling length: their first elements, lengths, and how many have more than t elements."""
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    size = size[order]
    live = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), "right")
    return bounds[:-1][order], size, live


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(1)
    return top + np.log(np.exp(x - top[:, None]).sum(1))


def forward_backward(emission: np.ndarray, bounds: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Chance of label 1 of each element, expected number of each move, and the sum of log partition values."""
    first, size, live = _steps(bounds)
    score = np.stack([np.zeros(len(emission)), emission], 1)
    ahead, back = np.zeros((len(emission), 2)), np.zeros((len(emission), 2))
    for t, n in enumerate(live):
        at = first[:n] + t
        ahead[at] = score[at]
        if t:
            ahead[at] += np.stack([_log_sum(ahead[at - 1] + moves[:, b]) for b in (0, 1)], 1)
    for t in range(len(live) - 2, -1, -1):
        at = first[: live[t + 1]] + t
        coming = score[at + 1] + back[at + 1]
        back[at] = np.stack([_log_sum(coming + moves[a]) for a in (0, 1)], 1)
    some = size > 0
    total = np.zeros(len(size))
    total[some] = _log_sum(ahead[first[some] + size[some] - 1])
    norm = np.zeros(len(bounds) - 1)
    norm[np.argsort(-np.diff(bounds), kind="stable")] = total
    each = np.repeat(norm, np.diff(bounds))
    marginal = np.exp(np.minimum(ahead[:, 1] + back[:, 1] - each, 0))
    inner = np.ones(len(emission), bool)
    inner[bounds[:-1][np.diff(bounds) > 0]] = False
    at = np.flatnonzero(inner)
    expected = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            expected[a, b] = np.exp(ahead[at - 1, a] + moves[a, b] + score[at, b] + back[at, b] - each[at]).sum()
    return marginal, expected, float(norm.sum())


def viterbi(emission: np.ndarray, bounds: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best label sequence of each sequence; label 0 on ties."""
    first, size, live = _steps(bounds)
    best = np.stack([np.zeros(len(emission)), emission], 1)
    came = np.zeros((len(emission), 2), np.int8)
    for t, n in enumerate(live[1:], 1):
        at = first[:n] + t
        ways = best[at - 1][:, :, None] + moves  # sequence, label before, label
        came[at] = ways.argmax(1)
        best[at] += ways.max(1)
    label = np.zeros(len(emission), np.int8)
    ends = first[size > 0] + size[size > 0] - 1
    label[ends] = best[ends].argmax(1)
    for t in range(len(live) - 2, -1, -1):
        at = first[: live[t + 1]] + t
        label[at] = came[at + 1, label[at + 1]]
    return label


def fit_chain(rows: SparseRows, bounds: np.ndarray, label: np.ndarray, weight: np.ndarray | None = None, penalty: float = 1.0, steps: int = 60) -> Chain:
    """Weights that minimise the negative log likelihood of the labels plus ``penalty`` / 2 times their squares."""
    size = np.diff(bounds)
    inner = np.ones(len(label), bool)
    inner[bounds[:-1][size > 0]] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[at - 1], label[at]), 1)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        moves = w[-4:].reshape(2, 2)
        emission = rows.dot(w[: rows.width]) + w[rows.width]
        marginal, expected, norm = forward_backward(emission, bounds, moves)
        value = norm - emission[label == 1].sum() - (moves * seen).sum() + penalty / 2 * (w @ w - w[rows.width] ** 2)
        error = marginal - label
        slope = np.concatenate([rows.transposed_dot(error) + penalty * w[: rows.width], [error.sum()], (expected - seen).ravel() + penalty * w[-4:]])
        return value, slope

    w = minimise(loss, np.zeros(rows.width + 5), steps=steps)
    return Chain(w[: rows.width], float(w[rows.width]), w[-4:].reshape(2, 2))
