"""An autoregressive moving-average model step by step in numpy, to hold the expressions against."""

from __future__ import annotations

import numpy as np


def arma_shocks(w: np.ndarray, model: dict) -> np.ndarray:
    """One-step errors of the differenced series; values before its start count as its mean."""
    phi, theta = model["phi"], model["theta"]
    p, q = len(phi), len(theta)
    mean = model["const"] / (1 - phi.sum()) if p else model["const"]
    padded = np.r_[np.full(p, mean), w]
    base = w - model["const"] - sum((phi[j] * padded[p - 1 - j : p - 1 - j + len(w)] for j in range(p)), np.zeros(len(w)))
    if not q:
        return base
    errors = [0.0] * q
    back = list(theta[::-1])
    for v in base.tolist():
        errors.append(v - sum(t * e for t, e in zip(back, errors[-q:])))
    return np.array(errors[q:])


def arima_one_step(y: np.ndarray, d: int, model: dict) -> np.ndarray:
    """Prediction of each value from the ones before it; the first d values stand for themselves."""
    return y - np.r_[np.zeros(d), arma_shocks(np.diff(y, d), model)]


def arima_forecast(y: np.ndarray, d: int, model: dict, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean path and its standard error."""
    phi, theta = model["phi"], model["theta"]
    w, e = list(np.diff(y, d)), list(arma_shocks(np.diff(y, d), model))
    mean = model["const"] / (1 - phi.sum()) if len(phi) else model["const"]
    w, e = [mean] * len(phi) + w, [0.0] * len(theta) + e
    for _ in range(steps):
        w.append(model["const"] + sum(a * w[-j] for j, a in enumerate(phi, 1)) + sum(b * e[-j] for j, b in enumerate(theta, 1)))
        e.append(0.0)
    path = np.array(w[-steps:])
    for level in range(d - 1, -1, -1):
        path = np.diff(y, level)[-1] + np.cumsum(path)
    ar = np.r_[1.0, -phi]
    for _ in range(d):
        ar = np.convolve(ar, [1.0, -1.0])
    psi = [1.0]
    for j in range(1, steps):
        psi.append((theta[j - 1] if j <= len(theta) else 0.0) - sum(ar[i] * psi[j - i] for i in range(1, min(j, len(ar) - 1) + 1)))
    return path, np.sqrt(model["sigma2"] * np.cumsum(np.square(psi)))
