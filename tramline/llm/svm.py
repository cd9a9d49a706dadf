"""A linear hinge-loss model by dual coordinate descent, for sparse rows."""

from __future__ import annotations

import numpy as np


class SparseRows:
    """Rows of (feature, value) pairs, one after the other."""

    def __init__(self, features: list[np.ndarray], values: list[np.ndarray]):
        self.features = np.concatenate(features) if features else np.zeros(0, np.int64)
        self.values = np.concatenate(values) if values else np.zeros(0)
        self.ends = np.cumsum([0, *map(len, features)])

    def __len__(self) -> int:
        return len(self.ends) - 1

    def __getitem__(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.ends[row], self.ends[row + 1])
        return self.features[part], self.values[part]


def dual_coordinate_descent(
    rows: SparseRows,
    signs: np.ndarray,
    size: int,
    cost: np.ndarray,
    epochs: int = 30,
    tolerance: float = 0.01,
    seed: int = 0,
) -> tuple[np.ndarray, float]:
    """(weights, bias) that minimise |w|^2 / 2 + sum of cost * max(0, 1 - sign * (w x + b)).

    One dual variable per row is optimised at a time, in a new random order each epoch, until
    the projected gradients of an epoch lie within `tolerance` of each other. The bias is the
    weight of a feature that is 1 in every row.
    """
    weights, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    norms = np.array([rows[i][1] @ rows[i][1] + 1.0 for i in range(len(rows))])
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        lowest, highest = np.inf, -np.inf
        for i in random.permutation(len(rows)):
            features, values = rows[i]
            gradient = signs[i] * (weights[features] @ values + bias) - 1.0
            projected = gradient
            if alpha[i] <= 0.0:
                projected = min(gradient, 0.0)
            elif alpha[i] >= cost[i]:
                projected = max(gradient, 0.0)
            lowest, highest = min(lowest, projected), max(highest, projected)
            if projected:
                changed = min(max(alpha[i] - gradient / norms[i], 0.0), cost[i])
                step = (changed - alpha[i]) * signs[i]
                alpha[i] = changed
                weights[features] += step * values
                bias += step
        if highest - lowest < tolerance:
            break
    return weights, bias


def margins(rows: SparseRows, weights: np.ndarray, bias: float) -> np.ndarray:
    return np.array([weights[f] @ v + bias for f, v in (rows[i] for i in range(len(rows)))])


def calibrate(margin: np.ndarray, positive: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of the logistic curve through weighted outcomes of margins."""
    # Targets short of 0 and 1, so that separable margins have a finite slope.
    up, down = positive.sum(), len(positive) - positive.sum()
    target = np.where(positive, (up + 1) / (up + 2), 1 / (down + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        chance = logistic(slope * margin + shift)
        error, spread = weight * (chance - target), weight * chance * (1 - chance)
        gradient = np.array([error @ margin, error.sum()])
        hessian = np.array(
            [[spread @ margin**2 + 1e-6, spread @ margin], [spread @ margin, spread.sum() + 1e-6]]
        )
        step = np.clip(np.linalg.solve(hessian, gradient), -2.0, 2.0)
        slope, shift = slope - step[0], shift - step[1]
        if abs(step).max() < 1e-6:
            break
    return float(max(slope, 1e-3)), float(shift)


def logistic(value):
    return 1.0 / (1.0 + np.exp(-np.clip(value, -500, 500)))
