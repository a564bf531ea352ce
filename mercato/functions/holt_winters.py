"""Additive Holt-Winters (level, trend, season) fitted by least squares.

A small numeric helper run inside ``applyInPandas`` for one (series, fold) group; the
group is one daily series, so its length is bounded by the calendar.  Smoothing weights
are chosen by minimising the one-step-ahead squared error over a grid that is refined
three times around the best point; every grid point is evaluated in one vectorised pass.
"""

from __future__ import annotations

import numpy as np


def _initial_state(y: np.ndarray, m: int) -> tuple[float, float, np.ndarray]:
    first = y[:m].mean()
    second = y[m:2 * m].mean()
    return first, (second - first) / m, y[:m] - first


def _sse(y: np.ndarray, m: int, params: np.ndarray) -> np.ndarray:
    """One-step-ahead SSE for each row (alpha, beta, gamma) of ``params``."""
    alpha, beta, gamma = params[:, 0], params[:, 1], params[:, 2]
    l0, b0, s0 = _initial_state(y, m)
    k = len(params)
    level = np.full(k, l0)
    trend = np.full(k, b0)
    season = np.tile(s0, (k, 1))
    sse = np.zeros(k)
    for t, obs in enumerate(y):
        p = t % m
        s_old = season[:, p]
        err = obs - (level + trend + s_old)
        sse += err * err
        new_level = alpha * (obs - s_old) + (1 - alpha) * (level + trend)
        season[:, p] = gamma * (obs - level - trend) + (1 - gamma) * s_old
        trend = beta * (new_level - level) + (1 - beta) * trend
        level = new_level
    return sse


def fit(y: np.ndarray, m: int = 7) -> tuple[float, float, float]:
    """Smoothing weights (alpha, beta, gamma) in [0, 1] minimising the SSE."""
    y = np.asarray(y, dtype=float)
    centre = np.array([0.5, 0.5, 0.5])
    half = 0.5
    for _ in range(3):
        axis = [np.clip(c + half * (np.arange(7) - 3) / 3, 0.0, 1.0) for c in centre]
        grid = np.array(np.meshgrid(*axis, indexing="ij")).reshape(3, -1).T
        grid = np.unique(grid, axis=0)
        centre = grid[int(np.argmin(_sse(y, m, grid)))]
        half /= 3.5
    return float(centre[0]), float(centre[1]), float(centre[2])


def forecast(y: np.ndarray, horizon: int, m: int = 7,
             params: tuple[float, float, float] | None = None) -> np.ndarray:
    """Point forecasts for the ``horizon`` steps after the end of ``y``."""
    y = np.asarray(y, dtype=float)
    if len(y) < 2 * m:
        raise ValueError(f"{len(y)} observations, two seasons ({2 * m}) are needed")
    alpha, beta, gamma = params or fit(y, m)
    level, trend, season = _initial_state(y, m)
    season = season.copy()
    for t, obs in enumerate(y):
        p = t % m
        s_old = season[p]
        new_level = alpha * (obs - s_old) + (1 - alpha) * (level + trend)
        season[p] = gamma * (obs - level - trend) + (1 - gamma) * s_old
        trend = beta * (new_level - level) + (1 - beta) * trend
        level = new_level
    n = len(y)
    steps = np.arange(1, horizon + 1)
    return level + steps * trend + season[(n + steps - 1) % m]
