"""ARIMA(p, d, q) forecasts of a batch of series, vectorised across the series.

The series, differenced d times, is an ARMA(p, q); without differences its mean is taken off. Start values
come from two linear regressions (Hannan and Rissanen 1982); Levenberg-Marquardt steps then maximise the exact
Gaussian likelihood, written as a sum of squared standardised innovations of a state-space filter
(Harvey 1989). A missing value is stepped over: the state is predicted and nothing is learned.
Parameters are kept stationary and invertible through partial autocorrelations (Monahan 1984). Every step
advances all series of the batch at once; the time axis is the only Python loop.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from shelfcast.constants import ARIMA_ORDER, FORECAST_HORIZON, MIN_SERIES_POINTS
from shelfcast.functions.shipping import ship_by_value

ship_by_value(__name__)

MAX_STEPS = 500  # a series that still improves after so many is not fitted
IMPROVES = 1e-5  # share of the cost by which one of SLOW steps in a row has to lower it
SLOW = 3
CHUNK = 256
Order = tuple[int, int, int]


def _levinson(r: np.ndarray) -> np.ndarray:
    """Autoregressive coefficients of partial autocorrelations, row by row."""
    out = r[:, :0]
    for k in range(r.shape[1]):
        last = r[:, k : k + 1]
        out = np.concatenate([out - last * out[:, ::-1], last], axis=1)
    return out


def _reflections(coefficients: np.ndarray) -> np.ndarray:
    """Inverse of the above; zeros for coefficients at or beyond the edge of stationarity."""
    rest, found = coefficients, []
    with np.errstate(divide="ignore", invalid="ignore"):
        while rest.shape[1]:
            last = rest[:, -1:]
            found.append(last)
            rest = (rest[:, :-1] + last * rest[:, -2::-1]) / (1 - last * last) if rest.shape[1] > 1 else rest[:, :0]
    out = np.concatenate([*found[::-1], coefficients[:, :0]], axis=1)
    inside = (np.abs(out) < 0.98).all(axis=1)
    return np.where(inside[:, None], out, 0.0)


def _to_coefficients(u: np.ndarray, p: int) -> np.ndarray:
    """Unconstrained (n, p + q) to (phi_1 .. phi_p, theta_1 .. theta_q), stationary and invertible."""
    r = u / np.sqrt(1.0 + u * u)
    return np.concatenate([_levinson(r[:, :p]), -_levinson(r[:, p:])], axis=1)


def _to_unconstrained(c: np.ndarray, p: int) -> np.ndarray:
    r = np.concatenate([_reflections(c[:, :p]), _reflections(-c[:, p:])], axis=1)
    return r / np.sqrt(1.0 - r * r)


def _start_values(w: np.ndarray, p: int, q: int) -> np.ndarray:
    """Two-stage regression for one series without gaps."""
    n, reach = len(w), max(p, q)
    order = min(max(5, int(np.log(n) ** 2 // 2)), n // 4)
    if n - order - reach < p + q + 1 or order < 1 or not p + q:
        return np.zeros(p + q)
    lags = np.stack([w[order - k : n - k] for k in range(1, order + 1)], axis=1)
    tail = w[order:]
    e = tail - lags @ np.linalg.lstsq(lags, tail, rcond=None)[0]
    columns = [tail[reach - k : len(tail) - k] for k in range(1, p + 1)]
    columns += [e[reach - k : len(e) - k] for k in range(1, q + 1)]
    return np.linalg.lstsq(np.stack(columns, axis=1), tail[reach:], rcond=None)[0]


def _moved_up(x: np.ndarray, axis: int) -> np.ndarray:
    """The next entry along ``axis``, zero at its end."""
    out = np.zeros_like(x)
    if axis == 1:
        out[:, :-1] = x[:, 1:]
    else:
        out[:, :, :-1] = x[:, :, 1:]
    return out


def _filter(w: np.ndarray, seen: np.ndarray, c: np.ndarray, p: int):
    """Scaled standardised innovations (n, T) whose squared sum is to be minimised, and the predicted
    state after the last step. Series end together; where ``seen`` is false there is no value."""
    n, steps = w.shape
    size = max(p, c.shape[1] - p + 1)
    phi, shock = np.zeros((n, size)), np.zeros((n, size))
    phi[:, :p], shock[:, 0], shock[:, 1 : c.shape[1] - p + 1] = c[:, :p], 1.0, c[:, p:]
    noise = shock[:, :, None] * shock[:, None, :]
    move = np.zeros((n, size, size))
    move[:, :, 0] = phi
    move[:, np.arange(size - 1), np.arange(1, size)] = 1.0
    kron = np.einsum("nij,nkl->nikjl", move, move).reshape(n, size * size, size * size)
    cov = np.linalg.solve(np.eye(size * size) - kron, noise.reshape(n, -1, 1)).reshape(n, size, size)
    state = np.zeros((n, size))
    out, log_f, known = np.zeros((n, steps)), np.zeros(n), seen.sum(axis=1)
    gaps = np.flatnonzero(~seen.all(axis=0))
    whole_from = gaps[-1] + 1 if len(gaps) else 0
    settled = False
    for t in range(steps):
        here = seen[:, t]
        if not settled:
            f = cov[:, 0, 0]
            root, gain = np.sqrt(f), cov[:, :, 0] / f[:, None]
        v = np.where(here, w[:, t] - state[:, 0], 0.0)
        out[:, t] = v / root
        log_f += np.where(here, np.log(f), 0.0)
        after = state + gain * v[:, None]
        state = phi * after[:, :1] + _moved_up(after, 1)
        if settled:
            continue
        left = np.where(here[:, None, None], cov - gain[:, :, None] * cov[:, None, 0, :], cov)
        half = phi[:, :, None] * left[:, :1, :] + _moved_up(left, 1)
        before, cov = cov, phi[:, None, :] * half[:, :, :1] + _moved_up(half, 2) + noise
        settled = t >= whole_from and np.abs(cov - before).max() < 1e-13
    scale = np.exp(0.5 * log_f / np.maximum(known, 1))
    return out * scale[:, None], state


def _maximise(w: np.ndarray, seen: np.ndarray, u: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """(parameters, done) by Levenberg-Marquardt; a series leaves the batch when it can't improve."""
    u, m = u.copy(), u.shape[1]
    done = np.full(len(w), m == 0)
    if m == 0:
        return u, done
    damping, slow = np.full(len(w), 1e-2), np.zeros(len(w), int)
    residual, _ = _filter(w, seen, _to_coefficients(u, p), p)
    cost = np.sum(residual**2, axis=1)
    h = 1e-6
    for _ in range(MAX_STEPS):
        rows = np.flatnonzero(~done)
        if not len(rows):
            break
        own, now, there = w[rows], u[rows], seen[rows]
        nudged = np.concatenate([now + h * np.eye(m)[k] for k in range(m)])
        moved, _ = _filter(np.tile(own, (m, 1)), np.tile(there, (m, 1)), _to_coefficients(nudged, p), p)
        slope = (moved.reshape(m, len(rows), -1) - residual[rows]) / h
        gradient = np.einsum("knt,nt->nk", slope, residual[rows])
        normal = np.einsum("knt,lnt->nkl", slope, slope)
        diagonal = np.einsum("nkk->nk", normal)
        damped = normal + np.eye(m) * (damping[rows, None] * (diagonal + 1e-12))[:, None, :]
        step = np.linalg.solve(damped + 1e-12 * np.eye(m), -gradient[:, :, None])[:, :, 0]
        trial = np.clip(now + np.clip(step, -1.0, 1.0), -30.0, 30.0)
        tried, _ = _filter(own, there, _to_coefficients(trial, p), p)
        after = np.sum(tried**2, axis=1)
        better = after < cost[rows]
        little = cost[rows] - after <= IMPROVES * cost[rows]
        slow[rows] = np.where(better, np.where(little, slow[rows] + 1, 0), slow[rows])
        done[rows] = (slow[rows] >= SLOW) | (damping[rows] > 1e8)
        kept = rows[better]
        u[kept], residual[kept], cost[kept] = trial[better], tried[better], after[better]
        damping[rows] = np.where(better, damping[rows] / 5.0, damping[rows] * 5.0)
    return u, done


def _forecast_chunk(series: Sequence[np.ndarray], horizon: int, order: Order) -> tuple[np.ndarray, np.ndarray]:
    """(forecasts, fitted) of series that begin and end with a value."""
    p, d, q = order
    changes = [np.diff(s, d) for s in series]
    centre = np.array([0.0 if d else np.nanmean(x) for x in changes])
    changes = [x - m for x, m in zip(changes, centre, strict=True)]
    spread = np.array([np.sqrt(np.nanmean(x * x)) if np.isfinite(x).any() else 0.0 for x in changes])
    w = np.zeros((len(series), max(map(len, changes))))
    seen = np.zeros(w.shape, bool)
    start = np.zeros((len(series), p + q))
    for i, x in enumerate(changes):
        if spread[i] > 0:
            there = np.isfinite(x)
            w[i, w.shape[1] - len(x) :] = np.where(there, x, 0.0) / spread[i]
            seen[i, w.shape[1] - len(x) :] = there
            start[i] = _start_values(w[i, w.shape[1] - len(x) :], p, q)
    u, done = _maximise(w, seen, _to_unconstrained(start, p), p)
    c = _to_coefficients(u, p)
    _, state = _filter(w, seen, c, p)
    phi = np.zeros_like(state)
    phi[:, :p] = c[:, :p]
    ahead = np.zeros((len(series), horizon))
    for k in range(horizon):
        ahead[:, k] = state[:, 0]
        state = phi * state[:, :1] + _moved_up(state, 1)
    out = centre[:, None] + spread[:, None] * ahead
    for i, s in enumerate(series):
        tail = s[-(len(s) if not np.isfinite(s[-d - 1 :]).all() else d + 1) :]
        missing = ~np.isfinite(tail)
        if missing.any():  # the last levels are known or lie on the line between their neighbours
            tail = np.interp(np.arange(len(tail)), np.flatnonzero(~missing), tail[~missing])
        for j in reversed(range(d)):
            out[i] = np.diff(tail, j)[-1] + np.cumsum(out[i])
    return np.maximum(out, 0.0), done


def fit_batch(
    series: Sequence[np.ndarray],
    horizon: int = FORECAST_HORIZON,
    min_points: int = MIN_SERIES_POINTS,
    order: Order = ARIMA_ORDER,
) -> tuple[np.ndarray, np.ndarray]:
    """(n, horizon) forecasts, never negative, and for each series whether it was fitted. Zeros for one that
    was not: too short, infinite, with too few values for its parameters, or still improving
    after MAX_STEPS. Missing values are stepped over; behind the last value they only lengthen the forecast."""
    result, fitted = np.zeros((len(series), horizon)), np.zeros(len(series), bool)
    usable: list[tuple[int, np.ndarray, int]] = []
    for i, s in enumerate(series):
        there = np.flatnonzero(np.isfinite(s))
        if len(s) >= min_points and len(there) > sum(order) + 1 and not np.isinf(s).any():
            usable.append((i, s[there[0] : there[-1] + 1], len(s) - 1 - there[-1]))
    for at in range(0, len(usable), CHUNK):
        rows = usable[at : at + CHUNK]
        longest = horizon + max(gap for _, _, gap in rows)
        try:
            forecast, done = _forecast_chunk([s for _, s, _ in rows], longest, order)
        except np.linalg.LinAlgError:
            forecast, done = np.zeros((len(rows), longest)), np.zeros(len(rows), bool)
            for k, (_, s, _) in enumerate(rows):
                try:
                    one, ok = _forecast_chunk([s], longest, order)
                    forecast[k], done[k] = one[0], ok[0]
                except np.linalg.LinAlgError:
                    pass
        for k, (i, _, gap) in enumerate(rows):
            steps = forecast[k, gap : gap + horizon]
            fitted[i] = done[k] and np.isfinite(steps).all()
            result[i] = steps if fitted[i] else 0.0
    return result, fitted


def forecast_batch(
    series: Sequence[np.ndarray],
    horizon: int = FORECAST_HORIZON,
    min_points: int = MIN_SERIES_POINTS,
    order: Order = ARIMA_ORDER,
) -> np.ndarray:
    return fit_batch(series, horizon, min_points, order)[0]
