"""Piecewise trends from sums: changepoints in each fold's own span, and a Laplace prior on the trend's changes.

Rolling-origin folds differ in where their history ends, and so in where their changepoints lie. A hinge
``max(t - c, 0)`` is a straight line on every row from ``c`` on. Its products with all other terms follow from sums of
1, t and t² times those terms over the rows from ``c`` on. Such sums are kept per bin of a grid that all folds share
(days, unless told otherwise) and added up from the newest bin back, so each fold places its changepoints on the grid
within its own first four fifths, without another look at the history.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

DAY = 86400


def changepoint_times(first: int, last: int, count: int, grain: int = DAY) -> list[int]:
    """Epoch seconds of changepoints spread over the first four fifths of a span, each at the nearest grid line."""
    spots = [first + 0.8 * (i + 1) / (count + 1) * (last - first) for i in range(count)]
    return [int(np.floor(s / grain + 0.5)) * grain for s in spots]


def own_block_sums(y: np.ndarray, season: np.ndarray, seconds: np.ndarray, first: int, grain: int = DAY) -> dict:
    """Sums of one series and block: products of the seasonal terms at three powers of time, and per bin of the grid.

    Time is in days since the series began, a unit that no fold changes.
    """
    z = np.hstack([np.ones((len(y), 1)), season])
    u = ((seconds - first) / DAY)[:, None]
    upper = np.triu_indices(z.shape[1])
    products = [(z.T @ (z * w))[upper] for w in (1.0, u, u * u)]
    sides = [z.T @ y, z.T @ (y * u[:, 0])]
    rows = np.hstack([z, z * u, z * u * u, y[:, None], y[:, None] * u])
    bins, place = np.unique(seconds // grain, return_inverse=True)
    per_bin = np.zeros((len(bins), rows.shape[1]))
    np.add.at(per_bin, place, rows)
    return {
        "n": len(y),
        "y_max": float(np.abs(y).max()),
        "y_squares": float(y @ y),
        "newest": int(seconds.max()),
        "sums": np.concatenate(products + sides),
        "bins": bins.astype(np.int64),
        "bin_sums": per_bin.ravel(),
    }


class OwnSums:
    """Block sums of one series, added up from the oldest block on; gives the system of a fold in its own time."""

    def __init__(self, seasons: int, changepoints: int, first: int, grain: int = DAY):
        self.inner, self.changepoints, self.first, self.grain = 1 + seasons, changepoints, first, grain
        self.width = 2 + changepoints + seasons
        self.n, self.y_max, self.y_squares, self.last = 0, 0.0, 0.0, first
        self.flat = np.zeros(3 * (self.inner * (self.inner + 1) // 2) + 2 * self.inner)
        self.bins: dict[int, np.ndarray] = {}

    def add(self, block) -> None:
        self.n += block.n
        self.y_max = max(self.y_max, block.y_max)
        self.y_squares += block.y_squares
        self.last = max(self.last, int(block.newest))
        self.flat += block.sums
        for day, row in zip(block.bins, np.asarray(block.bin_sums).reshape(len(block.bins), -1)):
            self.bins[int(day)] = self.bins.get(int(day), 0) + row

    @property
    def span(self) -> float:
        """Length of the fold's history in days."""
        return max(self.last - self.first, 1) / DAY

    def knots(self) -> list[float]:
        """Changepoints in the fold's own time, which runs from 0 to 1."""
        return [(c - self.first) / max(self.last - self.first, 1) for c in changepoint_times(self.first, self.last, self.changepoints, self.grain)]

    def _products(self) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        size, products = self.inner * (self.inner + 1) // 2, []
        for power in range(3):
            m = np.zeros((self.inner, self.inner))
            m[np.triu_indices(self.inner)] = self.flat[power * size : (power + 1) * size] / self.span**power
            products.append(m + np.triu(m, 1).T)
        sides = self.flat[3 * size :]
        return products, sides[: self.inner], sides[self.inner :] / self.span

    def _from(self) -> list[np.ndarray]:
        """For each changepoint the sums (terms, t terms, t² terms, y, t y) over the rows from it on, in the fold's time."""
        days = np.array(sorted(self.bins))
        upto = np.vstack([np.cumsum(np.array([self.bins[d] for d in days])[::-1], axis=0)[::-1], np.zeros(3 * self.inner + 2)])
        scale = np.concatenate([np.repeat([1.0, 1 / self.span, 1 / self.span**2], self.inner), [1.0, 1 / self.span]])
        lines = [c // self.grain for c in changepoint_times(self.first, self.last, self.changepoints, self.grain)]
        return [upto[np.searchsorted(days, line)] * scale for line in lines]

    def system(self, mode: str, trend_width: int):
        """Normal equations for a mode, and the line that multiplies the seasonal terms in it."""
        (m0, m1, m2), y0, y1 = self._products()
        knots, tails, w = self.knots(), self._from(), self.inner
        left, right = np.zeros((self.width, self.width)), np.zeros(self.width)
        left[:2, :2] = [[m0[0, 0], m1[0, 0]], [m1[0, 0], m2[0, 0]]]
        right[:2] = y0[0], y1[0]
        lift = (1.0, 0.0)
        if mode != "additive":
            lift = tuple(float(v) for v in np.linalg.lstsq(left[:2, :2], right[:2], rcond=None)[0])
        a, b = lift
        season = slice(trend_width, None)
        left[0, season], left[1, season] = a * m0[0, 1:] + b * m1[0, 1:], a * m1[0, 1:] + b * m2[0, 1:]
        left[season, season] = (a * a * m0 + 2 * a * b * m1 + b * b * m2)[1:, 1:]
        right[season] = a * y0[1:] + b * y1[1:]
        for i, (c, tail) in enumerate(zip(knots, tails)):
            v0, v1, v2, ys, yt = tail[:w], tail[w : 2 * w], tail[2 * w : 3 * w], tail[-2], tail[-1]
            at = 2 + i
            left[0, at], left[1, at] = v1[0] - c * v0[0], v2[0] - c * v1[0]
            left[at, season] = a * (v1 - c * v0)[1:] + b * (v2 - c * v1)[1:]
            right[at] = yt - c * ys
            for j in range(i + 1):
                left[2 + j, at] = v2[0] - (c + knots[j]) * v1[0] + c * knots[j] * v0[0]
        upper = np.triu(left, 1)
        return np.diag(np.diag(left)) + upper + upper.T, right, lift

    def variances(self) -> np.ndarray:
        """Variance of each seasonal term over the rows seen; 0 for the trend, whose terms are not scaled by it."""
        m0 = self._products()[0][0]
        season = np.maximum(np.diag(m0) / self.n - (m0[0] / self.n) ** 2, 0.0)[1:]
        return np.concatenate([np.zeros(self.width - len(season)), season])


def soft(x, by: float):
    """Move a number, or each of an array, towards 0."""
    return np.sign(x) * np.maximum(np.abs(x) - by, 0.0)


def lasso(gram: np.ndarray, side: np.ndarray, by: float, tolerance: float = 1e-9, rounds: int = 1000) -> np.ndarray:
    """The minimum of ``d'Gd / 2 - d's + by * sum|d|`` by coordinate descent.

    Between sweeps the coordinates that are not 0 move together (:func:`_together`), since single coordinates creep
    over near-collinear hinges. The end is where no coordinate has a slope left beyond the tolerance.
    """
    d = np.zeros(len(side))
    reach = tolerance * max(float(np.abs(side).max(initial=0.0)), by, 1e-300)
    for _ in range(rounds):
        slope = side - gram @ d
        if (np.abs(np.where(d == 0, soft(slope, by), slope - by * np.sign(d))) <= reach).all():
            break
        for j in range(len(d)):
            d[j] = soft(side[j] - gram[j] @ d + gram[j, j] * d[j], by) / max(gram[j, j], 1e-300)
        d = _together(gram, side, by, d)
    return d


def _together(gram: np.ndarray, side: np.ndarray, by: float, d: np.ndarray) -> np.ndarray:
    """Move all coordinates that are not 0 towards their joint minimum, as far as the loss falls.

    The way there is straight; a coordinate that would change its sign on it may stop at 0 and leave the set.
    """
    loss = lambda x: x @ gram @ x / 2 - x @ side + by * np.abs(x).sum()
    while d.any():
        active, signs = np.flatnonzero(d), np.sign(d[d != 0])
        goal = np.zeros(len(d))
        goal[active] = np.linalg.lstsq(gram[np.ix_(active, active)], side[active] - by * signs, rcond=None)[0]
        if (np.sign(goal[active]) == signs).all():
            return goal if loss(goal) <= loss(d) else d
        best, value = d, loss(d)
        for j in active:
            if goal[j] * d[j] <= 0:
                stop = d + (goal - d) * (d[j] / (d[j] - goal[j]))
                stop[j] = 0.0
                if loss(stop) < value:
                    best, value = stop, loss(stop)
        if best is d:
            return d
        d = best
    return d


def solve_sparse(left: np.ndarray, right: np.ndarray, weights: np.ndarray, trend_width: int, by: float) -> np.ndarray:
    """Coefficients with an absolute penalty on the trend's changes and ridge ``weights`` on all other terms.

    For given changes the other terms have a closed form. Put in, it leaves a problem in the changes alone, as many as
    there are changepoints, for :func:`lasso`; the closed form then gives the rest.
    """
    floor = 1e-9 * max(np.trace(left) / len(left), 1e-12)
    system = left + np.diag(weights + floor)
    change = np.zeros(len(left), bool)
    change[2:trend_width] = True
    inner = np.linalg.solve(system[np.ix_(~change, ~change)], np.column_stack([system[np.ix_(~change, change)], right[~change]]))
    across, alone = inner[:, :-1], inner[:, -1]
    gram = system[np.ix_(change, change)] - system[np.ix_(change, ~change)] @ across
    side = right[change] - system[np.ix_(change, ~change)] @ alone
    coef = np.zeros(len(left))
    coef[change] = lasso((gram + gram.T) / 2, side, by)
    coef[~change] = alone - across @ coef[change]
    return coef


def drift(changes: np.ndarray) -> float:
    """Variance that future trend changes add, per cubed unit of time beyond the history.

    Changes go on at the rate of the changepoints (so many per unit of time) with Laplace sizes of the mean absolute
    size fitted, whose variance is twice its square. A change at s adds its size times (t - s) at t; with s uniform in
    time the variances add up to rate * 2 size² * (t - 1)³ / 3.
    """
    return float(2 * np.mean(np.abs(changes)) ** 2 * len(changes) / 3) if len(changes) else 0.0


def seconds_of(table: pa.Table, column: str) -> np.ndarray:
    return table[column].to_numpy().astype(np.int64)
