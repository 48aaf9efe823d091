"""Least-squares fits of weekly models to many daily series at once, in numpy arrays.

Tasks call these functions on packs of series. Series of a pack are aligned at their last day and have
zeros before their first, so that one array operation serves all of them.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# These functions travel by value, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEASON = 7
#: Days that a model needs to start.
SMOOTHING_DAYS, ARIMA_DAYS = 2 * SEASON, 4 * SEASON
SMOOTHING_BOUNDS, ARIMA_BOUNDS = (0.001, 0.999), (-0.98, 0.98)
#: Starting points of the descents (every combination), and how many of the best go on.
SMOOTHING_STARTS = ((0.05, 0.3, 0.8), (0.01, 0.2), (0.05, 0.3))
ARIMA_STARTS = ((-0.6, 0.0, 0.6),) * 4
ARIMA_KEPT, SMOOTHING_KEPT = 2, 2
ROUNDS = 60
#: Values of a pack that are worked on at once; more would not stay in a core's cache.
VALUES = 1 << 15


def aligned(series):
    """Arrays of any lengths as rows of one array, ending together."""
    wide = np.zeros((len(series), max(map(len, series))))
    for row, values in zip(wide, series):
        row[len(row) - len(values):] = values
    return wide


def descended(model, points, low, high, rounds=ROUNDS, least_gain=1e-9):
    """Levenberg-Marquardt inside a box for many problems side by side.

    ``model(points, rows)`` gives the residuals (n x days) and their derivatives (n x parameters x
    days) of the problems ``rows`` at ``points``. A parameter at a bound stays there while the slope
    leads outwards. A descent ends with a relative gain below ``least_gain``. Returns the points and
    their squared errors.
    """
    points = points.copy()
    residual, slope = model(points, np.arange(len(points)))
    error = (residual ** 2).sum(-1)
    gradient, square = (slope @ residual[..., None])[..., 0], slope @ slope.transpose(0, 2, 1)
    damping, open_ = np.full(len(points), 1e-3), np.arange(len(points))
    unit = np.eye(points.shape[1])
    for _ in range(rounds):
        if not len(open_):
            break
        at, g, a = points[open_], gradient[open_], square[open_]
        fixed = (at <= low) & (g > 0) | (at >= high) & (g < 0)
        g = np.where(fixed, 0.0, g)
        a = np.where(fixed[:, :, None] | fixed[:, None, :], 0.0, a)
        own = np.einsum("ijj->ij", a)
        a = a + unit * (own * damping[open_, None] + np.where(fixed, 1.0, 1e-12))[:, None, :]
        moved = np.clip(at - np.linalg.solve(a, g[..., None])[..., 0], low, high)
        residual, slope = model(moved, open_)
        tried = (residual ** 2).sum(-1)
        better = tried < error[open_]
        now = open_[better]
        gain = 1 - tried[better] / error[now]
        points[now], error[now] = moved[better], tried[better]
        gradient[now] = (slope[better] @ residual[better][..., None])[..., 0]
        square[now] = slope[better] @ slope[better].transpose(0, 2, 1)
        damping[open_] = np.where(better, damping[open_] / 5, damping[open_] * 4)
        done = np.zeros(len(points), bool)
        done[now] = gain < least_gain
        # Nowhere to go: at its bounds, or by steps below rounding.
        done[open_] |= np.abs(moved - at).max(1) < 1e-12
        done |= damping > 1e9
        open_ = open_[~done[open_]]
    return points, error


def _grid(axes):
    return np.stack(np.meshgrid(*axes, indexing="ij"), -1).reshape(-1, len(axes))


def _best_starts(errors, grid, count):
    """The best points of the grid for each series, as (series numbers, points)."""
    kept = np.argsort(errors, axis=1, kind="stable")[:, :count]
    return np.repeat(np.arange(len(errors)), kept.shape[1]), grid[kept.ravel()]


def _winners(error, series, count):
    """For each series the number of its descent with the least error, the first of equals."""
    order = np.lexsort((error, series))
    return order[np.searchsorted(series[order], np.arange(count))]


# --- seasonal ARIMA (1,1,1)(1,1,1)_7 -----------------------------------------------------------

def differenced(values):
    """(1 - B)(1 - B^7) of each row; the first eight days have none."""
    once = values[:, 1:] - values[:, :-1]
    return once[:, SEASON:] - once[:, :-SEASON]


def _undone(values, rate, days, part):
    """y with y_t + rate * y_(t - days) = values_t, in place; ``part`` is an array of the same shape to work in.

    1 / (1 - q) is the product of 1 + q, 1 + q^2, 1 + q^4 and so on: few array operations, and none per
    day. Powers of a rate below 1 die out.
    """
    power, step = -rate, days
    while step < values.shape[-1] and np.abs(power).max() > 1e-17:
        own = np.multiply(values[:, :-step], power, out=part[:, step:])
        values[:, step:] += own
        power, step = power * power, 2 * step
    return values


def _less(values, rate, days, part):
    """values_t - rate * values_(t - days), as a new array."""
    found = values.copy()
    found[:, days:] -= np.multiply(values[:, :-days], rate, out=part[:, days:])
    return found


def _columns(points):
    return (points[:, i, None] for i in range(4))


def arima_errors(w, points):
    """One-step errors of the differences ``w`` (n x days); terms before the start are 0."""
    phi, theta, sphi, stheta = _columns(points)
    part = np.empty_like(w)
    shocks = _undone(_undone(w.copy(), theta, 1, part), stheta, SEASON, part)
    return _less(_less(shocks, phi, 1, part), sphi, SEASON, part)


def arima_slopes(w, points):
    """Errors and their derivatives by phi, theta, sphi and stheta.

    All factors commute, as terms before the start are 0: a derivative by phi or sphi leaves its factor
    out, one by theta or stheta undoes its own factor of the errors once more.
    """
    phi, theta, sphi, stheta = _columns(points)
    part = np.empty_like(w)
    shocks = _undone(_undone(w.copy(), theta, 1, part), stheta, SEASON, part)
    half = _less(shocks, phi, 1, part)
    errors = _less(half, sphi, SEASON, part)
    slopes = np.zeros((len(w), 4, w.shape[1]))
    np.negative(_less(shocks, sphi, SEASON, part)[:, :-1], out=slopes[:, 0, 1:])
    np.negative(half[:, :-SEASON], out=slopes[:, 2, SEASON:])
    np.negative(_undone(errors.copy(), theta, 1, part)[:, :-1], out=slopes[:, 1, 1:])
    np.negative(_undone(errors.copy(), stheta, SEASON, part)[:, :-SEASON], out=slopes[:, 3, SEASON:])
    return errors, slopes


def arima_grid(w):
    """Squared errors of each row of ``w`` at all points of the grid of starts, in its order.

    The errors are a polynomial of phi and sphi in four lags of the shocks, so that the products of the
    lags give the squared errors of all pairs of these for one pair of theta and stheta.
    """
    phis, thetas, sphis, sthetas = map(np.array, ARIMA_STARTS)
    found = np.empty((len(w), len(phis), len(thetas), len(sphis), len(sthetas)))
    part = np.empty_like(w)
    weights = np.stack([np.stack([1 + 0 * sphis, 0 * sphis - phi, -sphis, phi * sphis]) for phi in phis], 1)
    for i, theta in enumerate(thetas):
        first = _undone(w.copy(), np.full((len(w), 1), theta), 1, part)
        for j, stheta in enumerate(sthetas):
            shocks = _undone(first.copy(), np.full((len(w), 1), stheta), SEASON, part)
            lags = np.zeros((len(w), 4, w.shape[1]))
            for k, days in enumerate((0, 1, SEASON, SEASON + 1)):
                lags[:, k, days:] = shocks[:, :w.shape[1] - days]
            gram = lags @ lags.transpose(0, 2, 1)
            found[:, :, i, :, j] = np.einsum("kab,nkl,lab->nab", weights, gram, weights)
    return found.reshape(len(w), -1)


def fit_arima(series):
    """Fits of arrays of values: (points, squared errors, mean square of the errors after the first
    eight, last eight differences, last eight errors)."""
    found = [[], [], [], [], []]
    grid = _grid(ARIMA_STARTS)
    for start, stop in _slices(series, 4 * ARIMA_KEPT):
        values = aligned(series[start:stop])
        w = differenced(values)
        opening, late = np.zeros_like(w), np.zeros_like(w)
        # A series that starts later has no differences before its own ninth day. Its first error is
        # its first difference, whatever the parameters, and is left out of the descent.
        for i, length in enumerate(map(len, series[start:stop])):
            first = w.shape[1] - (length - SEASON - 1)
            w[i, :first] = 0.0
            opening[i, first] = w[i, first]
            late[i, first + SEASON + 1:] = 1.0

        def model(points, rows):
            errors, slopes = arima_slopes(w[owner[rows]], points)
            return errors - opening[owner[rows]], slopes

        coarse = arima_grid(w) - (opening ** 2).sum(-1)[:, None]
        owner, points = _best_starts(coarse, grid, ARIMA_KEPT)
        points, error = descended(model, points, *ARIMA_BOUNDS)
        best = _winners(error, owner, len(w))
        errors = arima_errors(w, points[best])
        for part, made in zip(found, (
                points[best], (errors ** 2).sum(-1), (errors ** 2 * late).sum(-1) / late.sum(-1),
                w[:, -SEASON - 1:], errors[:, -SEASON - 1:])):
            part.append(made)
    return [np.concatenate(part) for part in found]


# --- additive smoothing with a weekly season ---------------------------------------------------

def smoothing_responses(values, begin, points, final=False):
    """One-step errors of each series for its values alone and for each unit starting state.

    The starting level, trend and seven seasons enter the errors linearly: column 0 has them all at 0,
    columns 1 to 9 have one of them at 1 and no values. ``begin`` is the first day of each row. With
    ``final`` the states after the last day come too: (9 x 10 x n), the next day's season first.
    """
    n, days = values.shape
    alpha, gamma = (np.tile(points[:, i], (10, 1)) for i in (0, 2))
    drift = alpha * points[:, 1]
    ahead, trend, part = np.zeros((10, n)), np.zeros((10, n)), np.empty((10, n))
    season, rows = np.zeros((SEASON, 10, n)), np.arange(n)
    ahead[1:3], trend[2] = 1.0, 1.0
    for j in range(SEASON):
        season[(begin + j) % SEASON, 3 + j, rows] = 1.0
    errors, all_begun = np.zeros((days, 10, n)), int(begin.max())
    errors[:, 0] = values.T
    # ``ahead`` is level + trend, the forecast of the next day but for its season.
    for day in range(days):
        own, error = season[day % SEASON], errors[day]
        np.subtract(error, ahead, out=error)
        np.subtract(error, own, out=error)
        if day < all_begun:
            error *= begin <= day
        np.multiply(alpha, error, out=part)
        np.add(ahead, part, out=ahead)
        np.multiply(drift, error, out=part)
        np.add(trend, part, out=trend)
        if day < all_begun:
            ahead += trend * (begin <= day)
        else:
            np.add(ahead, trend, out=ahead)
        np.multiply(gamma, error, out=part)
        np.add(own, part, out=own)
    if not final:
        return errors
    return errors, np.concatenate([[ahead - trend, trend],
                                   season[(days + np.arange(SEASON)) % SEASON]])


def _solved(errors):
    """(starting states n x 9, residuals n x days) of least squares for the columns of ``errors``."""
    columns = np.ascontiguousarray(errors.transpose(2, 1, 0))
    normal = columns @ columns.transpose(0, 2, 1)
    a, b = normal[:, 1:, 1:].copy(), -normal[:, 1:, :1]
    # Level and seasons can be shifted against each other at no cost; the seasons shall add up to 0.
    scale = np.einsum("ijj->i", a) / 9
    a[:, 2:, 2:] += scale[:, None, None]
    a += (1e-10 * scale + 1e-300)[:, None, None] * np.eye(9)
    states = np.linalg.solve(a, b)[..., 0]
    residual = columns[:, 0] + (states[:, None] @ columns[:, 1:])[:, 0]
    return states, residual


def smoothing_slopes(values, begin, points, step=1e-5):
    """Errors at the best starting states, and their derivatives by alpha, beta and gamma."""
    n = len(values)
    shift = np.where(points + step > SMOOTHING_BOUNDS[1], -step, step)
    near = [points] + [points + shift * unit for unit in np.eye(3)]
    residual = _solved(smoothing_responses(np.tile(values, (4, 1)), np.tile(begin, 4),
                                           np.concatenate(near)))[1].reshape(4, n, -1)
    return residual[0], ((residual[1:] - residual[0]) / shift.T[..., None]).transpose(1, 0, 2)


def fit_smoothing(series):
    """(points, squared errors, level, trend, season) after the last day of arrays of values."""
    found = [[], [], [], [], []]
    grid = _grid(SMOOTHING_STARTS)
    for start, stop in _slices(series, 40 * SMOOTHING_KEPT):
        values = aligned(series[start:stop])
        begin = values.shape[1] - np.array([len(s) for s in series[start:stop]])
        tried = smoothing_responses(np.repeat(values, len(grid), 0), np.repeat(begin, len(grid)),
                                    np.tile(grid, (len(values), 1)))
        coarse = (_solved(tried)[1] ** 2).sum(-1).reshape(len(values), -1)
        owner, points = _best_starts(coarse, grid, SMOOTHING_KEPT)
        points, error = descended(
            lambda p, rows: smoothing_slopes(values[owner[rows]], begin[owner[rows]], p), points,
            *SMOOTHING_BOUNDS, rounds=30, least_gain=1e-6)
        best = _winners(error, owner, len(values))
        errors, ends = smoothing_responses(values, begin, points[best], final=True)
        states, residual = _solved(errors)
        weights = np.concatenate([np.ones((len(states), 1)), states], 1)
        ends = np.einsum("scn,nc->ns", ends, weights)
        for part, made in zip(found, (points[best], (residual ** 2).sum(-1), ends[:, 0], ends[:, 1],
                                      ends[:, 2:])):
            part.append(made)
    return [np.concatenate(part) for part in found]


def _slices(series, copies):
    """Runs of consecutive series whose arrays hold about VALUES values in ``copies`` copies."""
    start = longest = 0
    for i, values in enumerate(series):
        longest = max(longest, len(values))
        if i > start and (i + 1 - start) * longest * copies > 8 * VALUES:
            yield start, i
            start, longest = i, len(values)
    if series:
        yield start, len(series)


# --- packs of series ---------------------------------------------------------------------------

ARIMA_FIT = ("struct<phi:double,theta:double,sphi:double,stheta:double,sse:double,spread:double,w:array<double>,"
             "e:array<double>>")
SMOOTHING_FIT = ("struct<alpha:double,beta:double,gamma:double,sse:double,level:double,trend:double,"
                 "season:array<double>>")


def _whole_packs(batches):
    """Arrow batches sorted by ``pack`` as one table per pack."""
    held = None
    for batch in batches:
        fresh = pa.Table.from_batches([batch])
        held = fresh if held is None else pa.concat_tables([held, fresh])
        number = held["pack"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1)]
        for start, stop in zip(cuts, cuts[1:]):
            yield held.slice(start, stop - start)
        held = held.slice(cuts[-1])
    if held is not None and len(held):
        yield held


def _values(column):
    """The arrays of an Arrow column of lists; None where null."""
    lists = column.combine_chunks()
    flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return [None if missing else flat[a:b] for missing, a, b in zip(
        lists.is_null().to_pylist(), offsets, offsets[1:])]


def fit_packs(batches, arima):
    """Rows (train, pack, others) with ``fit``; null where a series is too short or has a null day."""
    fit, least = (fit_arima, ARIMA_DAYS) if arima else (fit_smoothing, SMOOTHING_DAYS)
    names = (["phi", "theta", "sphi", "stheta", "sse", "spread", "w", "e"] if arima else
             ["alpha", "beta", "gamma", "sse", "level", "trend", "season"])
    doubles = pa.float64()
    kind = pa.struct([(n, pa.list_(doubles) if n in ("w", "e", "season") else doubles) for n in names])
    for table in _whole_packs(batches):
        series = _values(table["train"])
        fits = [None] * len(series)
        rows = sorted((i for i, x in enumerate(series) if x is not None and len(x) >= least
                       and np.isfinite(x).all()), key=lambda i: len(series[i]))
        if rows:
            points, *others = fit([series[i] for i in rows])
            for i, point, *other in zip(rows, points.tolist(), *(x.tolist() for x in others)):
                fits[i] = dict(zip(names, point + other))
        yield from table.append_column("fit", pa.array(fits, kind)).combine_chunks().to_batches()
