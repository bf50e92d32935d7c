"""Forecasts as expressions against the same rules in numpy, one series at a time."""

import datetime as dtm

import numpy as np
import pytest

from cargolith.plans import timeseries as ts


def smooth(y: np.ndarray, horizon: int) -> np.ndarray:
    """Additive trend and, for more than 24 points, additive season; the smoothing
    weights are the best of a grid, all candidates stepping through the series at once."""
    n = len(y)
    period = min(12, n // 3) if n > 24 else 0
    seasonal = period > 1
    grid = np.array([0.05, 0.1, 0.3, 0.5, 0.8])
    a, b, g = (m.ravel() for m in np.meshgrid(grid, grid * 0.5, grid * 0.5 if seasonal else np.zeros(1), indexing="ij"))
    if seasonal:
        # First cycle: slope between cycle means, season as the detrended rest.
        slope = (y[period:2 * period].mean() - y[:period].mean()) / period
        offsets = np.arange(period) - (period - 1) / 2
        level = np.full_like(a, y[:period].mean() + slope * offsets[-1])
        trend = np.full_like(a, slope)
        season = np.tile((y[:period] - y[:period].mean() - slope * offsets)[:, None], (1, len(a)))
        start = period
    else:
        level, trend = np.full_like(a, y[0]), np.full_like(a, y[1] - y[0] if n > 1 else 0.0)
        season, start = np.zeros((1, len(a))), 1
    errors = np.zeros_like(a)
    for i in range(start, n):
        s = season[i % len(season)].copy()
        errors += (y[i] - (level + trend + s)) ** 2
        before = level
        level = a * (y[i] - s) + (1 - a) * (level + trend)
        trend = b * (level - before) + (1 - b) * trend
        season[i % len(season)] = g * (y[i] - level) + (1 - g) * s
    k = int(np.argmin(errors))
    steps = np.arange(1, horizon + 1)
    return level[k] + trend[k] * steps + season[(n - 1 + steps) % len(season), k]


def autoregress(y: np.ndarray, horizon: int, max_p: int = 2, max_d: int = 1) -> np.ndarray:
    """Autoregression on the series or its differences by least squares, order by AIC."""
    best = None
    for d in range(max_d + 1):
        z = np.diff(y, d) if d else y
        for p in range(max_p + 1):
            m = len(z) - max_p
            if m < p + 3:
                continue
            target = z[max_p:]
            design = np.column_stack([np.ones(m), *[z[max_p - j:len(z) - j] for j in range(1, p + 1)]])
            weights, *_ = np.linalg.lstsq(design, target, rcond=None)
            sse = float(((target - design @ weights) ** 2).sum())
            aic = m * np.log(max(sse / m, 1e-12)) + 2 * (p + 1)
            if best is None or aic < best[0]:
                best = (aic, d, weights)
    if best is None:
        return np.full(horizon, y.mean())
    _, d, weights = best
    z = list(np.diff(y, d) if d else y)
    for _ in range(horizon):
        z.append(weights[0] + sum(w * z[-j] for j, w in enumerate(weights[1:], 1)))
    ahead = np.array(z[-horizon:])
    return y[-1] + np.cumsum(ahead) if d else ahead


def made(n, seed):
    rng = np.random.default_rng(seed)
    return 20 + 0.05 * np.arange(n) + 5 * np.sin(np.arange(n) * 2 * np.pi / 12) + rng.normal(scale=2, size=n)


SERIES = {"long": made(200, 1), "week": made(7, 2), "edge24": made(24, 3), "edge25": made(25, 4), "one": made(1, 5), "two": made(2, 6), "five": made(5, 7), "flat": np.full(40, 3.0), "zeros": np.zeros(30)}


@pytest.mark.parametrize("method,rule", [(ts.smoothing_forecast, smooth), (ts.autoregressive_forecast, autoregress)])
def test_forecasts(spark, method, rule):
    day = dtm.date(2024, 1, 1)
    rows = [(name, day + dtm.timedelta(days=i), float(v)) for name, y in SERIES.items() for i, v in enumerate(y)]
    np.random.default_rng(0).shuffle(rows)
    got = {}
    for r in method(spark.createDataFrame(rows, "series_id string, ds date, y double"), 9).orderBy("ds").collect():
        got.setdefault(r.series_id, []).append((r.ds, r.yhat))
    assert set(got) == set(SERIES)
    for name, y in SERIES.items():
        assert [d for d, _ in got[name]] == [day + dtm.timedelta(days=len(y) + k) for k in range(9)]
        assert np.allclose([v for _, v in got[name]], rule(y, 9), atol=1e-6), name
