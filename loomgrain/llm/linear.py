"""Logistic regression on a bounded sample, with plain numpy."""

from __future__ import annotations

import numpy as np


def fit_logistic(x, y, weight=None, ridge: float = 1e-3, steps: int = 60):
    """Weights (the last one is the intercept) by Newton steps with a ridge; ``y`` may be soft labels.

    One class only, or no rows at all, gives the constant that fits.
    """
    x = np.asarray(x, float).reshape(len(y), -1)
    y = np.asarray(y, float)
    w = np.ones(len(y)) if weight is None else np.asarray(weight, float)
    design = np.column_stack([x, np.ones(len(y))])
    size = design.shape[1]
    beta = np.zeros(size)
    share = (float(w @ y) + 1.0) / (float(w.sum()) + 2.0)
    beta[-1] = np.log(share / (1 - share))
    if len(y) == 0 or y.min() == y.max():
        return beta
    penalty = np.full(size, ridge * w.sum() / 100 + 1e-6)
    penalty[-1] = 1e-9

    def loss(b):
        z = design @ b
        return float(w @ (np.logaddexp(0, z) - y * z) + 0.5 * penalty @ (b * b))

    current = loss(beta)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -35, 35)))
        gradient = design.T @ (w * (p - y)) + penalty * beta
        hessian = design.T @ (design * (w * np.maximum(p * (1 - p), 1e-9))[:, None]) + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        size_of_step = 1.0
        while size_of_step > 1e-4 and loss(beta - size_of_step * step) > current:
            size_of_step /= 2
        beta = beta - size_of_step * step
        new = loss(beta)
        if current - new < 1e-9 * max(1.0, abs(current)):
            break
        current = new
    return beta


def logistic(x, beta):
    z = np.asarray(x, float) @ beta[:-1] + beta[-1]
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))
