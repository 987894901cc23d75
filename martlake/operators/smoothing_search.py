"""Search of the smoothing parameters of many series at once (A2).

Series of one season length are rows of a matrix, and their candidate points
(alpha, beta, gamma) are columns: one step of the recursion is a few numpy
operations for all series and points together. All series take their rounds of
the search side by side, each with a step of its own; a series that came to
rest leaves.
"""

from __future__ import annotations

import sys
from itertools import product

import numpy as np
from pyspark import cloudpickle

# Runs on workers that need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRID = np.linspace(0.05, 0.95, 10)  # of each parameter, where the search begins
LIMITS = (0.001, 0.999)
TOLERANCE = 1e-4  # of the parameters
TOGETHER = 128  # series in one matrix, which bounds the memory of a step


def squared_errors(y: np.ndarray, lengths: np.ndarray, season: int, points: np.ndarray) -> np.ndarray:
    """Sums of squared one-step errors, a row for each series and a column for each of its points.

    ``y`` holds a series in each row, the longest first; ``points`` has the shape
    (series, points, 3). Additive trend and, with ``season`` above 0, additive
    season. Start values: level is the mean of the first cycle (first value
    without season), trend the mean difference of the first two cycles per step
    (first difference), seasonal indices the first cycle less its mean.
    """
    alpha, beta, gamma = np.moveaxis(points, 2, 0)
    shape = alpha.shape
    first, second = y[:, : max(season, 1)].mean(axis=1), y[:, max(season, 1) : 2 * max(season, 1)].mean(axis=1)
    level = np.broadcast_to(first[:, None], shape).copy()
    trend = np.broadcast_to(((second - first) / max(season, 1))[:, None], shape).copy()
    indices = np.broadcast_to((y[:, :season] - first[:, None]).T[:, :, None], (season, *shape)).copy()
    errors = np.zeros(shape)
    running = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")  # series that have a value at each step
    size = 0
    for t, s in enumerate(running.tolist()):
        if s != size:
            size = s
            alpha, beta, gamma, level, trend, total = (x[:s] for x in (alpha, beta, gamma, level, trend, errors))
        off = y[:s, t, None] - (level := level + trend)
        if season:
            off -= (index := indices[t % season, :s])
        total += off * off
        gain = alpha * off
        level += gain  # alpha (y - index) + (1 - alpha) (level + trend)
        trend += beta * gain  # beta (new level - level) + (1 - beta) trend
        if season:
            off -= gain
            off *= gamma
            index += off  # gamma (y - new level) + (1 - gamma) index
    return errors


def _best(y, lengths, season, points) -> tuple[np.ndarray, np.ndarray]:
    """The point of least error of each series, and that error."""
    errors = squared_errors(y, lengths, season, points)
    at = np.argmin(errors, axis=1)
    rows = np.arange(len(y))
    return points[rows, at], errors[rows, at]


def _search(y: np.ndarray, lengths: np.ndarray, season: int) -> np.ndarray:
    gammas = GRID if season else [0.0]
    best, least = np.zeros((len(y), 3)), np.full(len(y), np.inf)
    for alpha in GRID:  # a slice of the grid at a time
        points = np.array(list(product([alpha], GRID, gammas)))
        point, error = _best(y, lengths, season, np.broadcast_to(points, (len(y), *points.shape)))
        better = error < least
        best[better], least[better] = point[better], error[better]
    widest = (GRID[1] - GRID[0]) / 2
    step = np.full(len(y), widest)
    around = np.array(list(product((-1, 0, 1), (-1, 0, 1), (-1, 0, 1) if season else (0,))), float)
    while len(live := np.flatnonzero(step > TOLERANCE)):
        points = np.clip(best[live, None] + step[live, None, None] * around, *LIMITS)
        if not season:
            points[..., 2] = 0.0
        point, error = _best(y[live], lengths[live], season, points)
        better = error < least[live]
        best[live[better]], least[live[better]] = point[better], error[better]
        step[live] = np.where(better, np.minimum(2 * step[live], widest), step[live] / 2)
    return np.column_stack([best, least])


def search(series: list[np.ndarray], seasons: list[int]) -> np.ndarray:
    """(alpha, beta, gamma, squared error) of each series.

    The grid's best point first; then 27 points around the best one. Where one of
    them is better, the search moves there and doubles its step (up to the first
    one); where none is, it halves it. It ends with a step below TOLERANCE.
    """
    out = np.zeros((len(series), 4))
    lengths = np.array([len(s) for s in series], np.int64)
    order = np.lexsort([-lengths, seasons])
    kinds = np.asarray(seasons)[order]
    for season in np.unique(kinds).tolist():
        same = order[kinds == season]
        for at in range(0, len(same), TOGETHER):
            rows = same[at : at + TOGETHER]
            y = np.zeros((len(rows), lengths[rows[0]]))
            for i, r in enumerate(rows):
                y[i, : lengths[r]] = series[r]
            out[rows] = _search(y, lengths[rows], season)
    return out
