"""Numerical helpers for one series inside a task (numpy). Spark partitions and shuffles the series."""

from __future__ import annotations

import math

import numpy as np

# MacKinnon (1994) response surface of the unit root statistic with a constant.
TAU_MAX, TAU_MIN, TAU_STAR = 2.74, -18.83, -1.61
TAU_SMALL = (2.1659, 1.4412, 0.038269)
TAU_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)


def unit_root_p(tau: float) -> float:
    if tau > TAU_MAX:
        return 1.0
    if tau < TAU_MIN:
        return 0.0
    coef = TAU_SMALL if tau <= TAU_STAR else TAU_LARGE
    z = sum(c * tau**i for i, c in enumerate(coef))
    return 0.5 * (1 + math.erf(z / math.sqrt(2)))


def _adf_design(y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    dy = np.diff(y)
    n = len(dy) - k
    past = [dy[k - j : k - j + n] for j in range(1, k + 1)]
    return np.column_stack([np.ones(n), y[k : k + n], *past]), dy[k:]


def adf(y: np.ndarray) -> tuple[float, float, int]:
    """Augmented Dickey-Fuller test with a constant: statistic, p-value and the lag count with the least AIC."""
    n = len(y)
    if n == 0 or y.max() == y.min():
        raise ValueError("constant series")
    top = min(n // 2 - 2, math.ceil(12 * (n / 100) ** 0.25))
    if top < 0:
        raise ValueError("series too short")
    # One QR gives the residual sum of squares of every leading set of columns.
    x, dy = _adf_design(y, top)
    q, _ = np.linalg.qr(x)
    rss = np.maximum(dy @ dy - np.cumsum((q.T @ dy) ** 2), 1e-300)[1:]
    k = int(np.argmin(len(dy) * np.log(rss / len(dy)) + 2 * np.arange(2, len(rss) + 2)))
    x, dy = _adf_design(y, k)
    beta, *_ = np.linalg.lstsq(x, dy, rcond=None)
    resid = dy - x @ beta
    cov = np.linalg.pinv(x.T @ x) * (resid @ resid) / (len(dy) - x.shape[1])
    stat = float(beta[1] / math.sqrt(cov[1, 1]))
    return stat, unit_root_p(stat), k


def difference_order(y: np.ndarray) -> int:
    try:
        if adf(y)[1] < 0.05:
            return 0
        return 1 if adf(np.diff(y))[1] < 0.05 else 2
    except (ValueError, ZeroDivisionError, np.linalg.LinAlgError):
        return 1


def _inside(coef: np.ndarray) -> bool:
    """Whether z^k - c1 z^(k-1) - ... has all roots inside the unit circle."""
    return len(coef) == 0 or bool(np.all(np.abs(np.roots(np.r_[1.0, -coef])) < 0.999))


def arma_candidates(w: np.ndarray, orders: list[tuple[int, int]], constant: bool) -> dict[tuple[int, int], dict]:
    """Hannan-Rissanen: a long autoregression gives the shocks, then least squares per (p, q).

    All orders share one design and one sample, so their criteria compare. Orders with unstable
    coefficients are left out.
    """
    widest = max(max(o) for o in orders)
    m = max(widest + 1, min(int(10 * math.log10(max(len(w), 2))), len(w) // 4))
    n = len(w) - m - widest
    if n < 3 * widest + 5:
        return {}
    lag = lambda v, j, start: v[start - j : len(v) - j]
    c = [np.ones(len(w) - m)] if constant else []
    long = np.column_stack([*c, *[lag(w, j, m) for j in range(1, m + 1)]])
    shocks = np.r_[np.zeros(m), w[m:] - long @ np.linalg.lstsq(long, w[m:], rcond=None)[0]]
    s = m + widest
    y, found = w[s:], {}
    for p, q in orders:
        cols = [np.ones(n)] * constant + [lag(w, j, s) for j in range(1, p + 1)] + [lag(shocks, j, s) for j in range(1, q + 1)]
        x = np.column_stack(cols) if cols else np.zeros((n, 0))
        beta = np.linalg.lstsq(x, y, rcond=None)[0] if cols else np.zeros(0)
        const, phi, theta = (beta[0] if constant else 0.0), beta[constant : constant + p], beta[constant + p :]
        sigma2 = float(np.mean((y - x @ beta) ** 2))
        if sigma2 <= 0 or not np.isfinite(sigma2) or not _inside(phi) or not _inside(-theta):
            continue
        k, fit = len(beta) + 1, n * (math.log(2 * math.pi * sigma2) + 1)
        found[(p, q)] = dict(const=const, phi=phi, theta=theta, sigma2=sigma2, aic=fit + 2 * k, bic=fit + k * math.log(n))
    return found


def sparse_ridge(x: np.ndarray, y: np.ndarray, scales: np.ndarray, sparse: slice, rounds: int = 4) -> tuple[np.ndarray, float]:
    """Least squares with priors of the given scales, Laplace for the columns `sparse` and normal for the rest.

    The most likely coefficients: the normal ones are solved out of the sums of products, and the sparse ones are found one at a time, so
    those that the data do not ask for are 0. The noise variance is settled in a few rounds.
    """
    gram, xy, noise = x.T @ x, x.T @ y, max(float(np.var(y)), 1e-12)
    some, rest = np.arange(x.shape[1])[sparse], np.delete(np.arange(x.shape[1]), sparse)
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        inner = gram[np.ix_(rest, rest)] + np.diag(noise / scales[rest] ** 2)
        out = np.linalg.solve(inner, np.column_stack([gram[np.ix_(rest, some)], xy[rest]]))
        left = gram[np.ix_(some, some)] - gram[np.ix_(some, rest)] @ out[:, :-1]
        beta[some] = soft_least_squares(left, xy[some] - gram[np.ix_(some, rest)] @ out[:, -1], noise / scales[some], beta[some])
        beta[rest] = out[:, -1] - out[:, :-1] @ beta[some]
        noise = max(float(np.mean((y - x @ beta) ** 2)), 1e-12)
    return beta, math.sqrt(noise)


def soft_least_squares(gram: np.ndarray, xy: np.ndarray, price: np.ndarray, start: np.ndarray, tolerance: float = 1e-7) -> np.ndarray:
    """The b with the least b'gram b / 2 - xy'b + price'|b|.

    Feature-sign search (Lee et al. 2007): with the signs given, the coefficients are the solution of a linear system. One that is 0 is let
    in when the slope there is above its price, and the way to the new solution ends at the best of the points where a sign changes.
    """
    b, cost = start.copy(), lambda v: v @ gram @ v / 2 - xy @ v + price @ np.abs(v)
    for _ in range(50 * len(b)):
        slope, signs = xy - gram @ b, np.sign(b)
        if (np.abs(slope - price * signs)[signs != 0] <= tolerance * price[signs != 0]).all():
            over = np.where(signs == 0, np.abs(slope) - (1 + tolerance) * price, -1.0)
            if over.max() <= 0:
                break
            signs[over.argmax()] = np.sign(slope[over.argmax()])
        on = np.flatnonzero(signs)
        aim = np.zeros(len(b))
        aim[on] = np.linalg.lstsq(gram[np.ix_(on, on)], (xy - price * signs)[on], rcond=None)[0]
        turns, ways = np.flatnonzero(b * aim < 0), [aim]
        for j in turns:
            way = b + b[j] / (b[j] - aim[j]) * (aim - b)
            way[j] = 0.0
            ways.append(way)
        best = min(ways, key=cost)
        if cost(best) >= cost(b):
            break
        b = best
    return b


# Seasonal decomposition by local regression (Cleveland et al. 1990).


def _local_lines(y: np.ndarray, q: int, weight: np.ndarray, ahead: int = 0) -> np.ndarray:
    """Local linear fits with q neighbours at the positions -ahead .. n-1+ahead of an evenly spaced series."""
    n = len(y)
    at = np.arange(-ahead, n + ahead, dtype=float)
    left = np.clip(np.round(at).astype(int) - (q - 1) // 2, 0, max(n - q, 0)) if q < n else np.zeros(len(at), int)
    width = min(q, n)
    index = left[:, None] + np.arange(width)
    gap = np.abs(index - at[:, None])
    reach = np.maximum(at - left, left + width - 1 - at) + ((q - n) // 2 if q > n else 0)
    reach = np.maximum(reach, 1e-12)[:, None]
    w = np.where(gap <= 0.001 * reach, 1.0, np.where(gap <= 0.999 * reach, (1 - (gap / reach) ** 3) ** 3, 0.0)) * weight[index]
    total = w.sum(axis=1, keepdims=True)
    dead = total[:, 0] <= 0
    w = w / np.where(total > 0, total, 1.0)
    centre = (w * index).sum(axis=1, keepdims=True)
    spread = (w * (index - centre) ** 2).sum(axis=1, keepdims=True)
    tilt = np.where(np.sqrt(spread) > 0.001 * max(n - 1, 1), (at[:, None] - centre) / np.where(spread > 0, spread, 1.0), 0.0)
    fit = (w * (1 + tilt * (index - centre)) * y[index]).sum(axis=1)
    return np.where(dead, y[np.clip(at.astype(int), 0, n - 1)], fit)


def _moving_mean(y: np.ndarray, k: int) -> np.ndarray:
    return np.convolve(y, np.full(k, 1.0 / k), mode="valid")


def _odd(x: float) -> int:
    k = math.ceil(x)
    return k + 1 if k % 2 == 0 else k


def robust_stl(y: np.ndarray, period: int = 7, seasonal: int = 7, inner: int = 2, outer: int = 15) -> tuple[np.ndarray, np.ndarray]:
    """Trend and seasonal part of an evenly spaced series, with robustness weights."""
    n = len(y)
    trend_q, low_q = _odd(1.5 * period / (1 - 1.5 / seasonal)), _odd(period + 1)
    ones, rough, trend, season = np.ones(n), np.ones(n), np.zeros(n), np.zeros(n)
    for _ in range(outer + 1):
        for _ in range(inner):
            cycle, flat = np.empty(n + 2 * period), y - trend
            for phase in range(period):
                cycle[phase::period] = _local_lines(flat[phase::period], seasonal, rough[phase::period], ahead=1)
            low = _local_lines(_moving_mean(_moving_mean(_moving_mean(cycle, period), period), 3), low_q, ones)
            season = cycle[period : period + n] - low
            trend = _local_lines(y - season, trend_q, rough)
        rest = np.abs(y - season - trend)
        scale = 6 * np.median(rest)
        u = rest / scale if scale > 0 else np.zeros(n)
        rough = np.where(u <= 0.001, 1.0, np.where(u <= 0.999, (1 - u**2) ** 2, 0.0))
    return trend, season
