"""Least squares in expressions, the ARMA model, k-means steps and quantile plans against plain numpy."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradelens.functions import ols
from tradelens.functions.quantiles import group_quantiles
from tradelens.operators import forecast as FC
from tradelens.operators import segment as G
from tradelens.params import ForecastParams


def test_fit_equals_numpy(spark):
    rng = np.random.default_rng(1)
    n = 300
    x = rng.normal(size=(n, 4)) * [1, 5, 0.1, 1e6] + [0, 3, 7, -2e6]
    y = 3 + x @ np.array([1.0, 2.0, -1.0, 1e-6]) + rng.normal(size=n)
    rows = [(int(i % 3), *map(float, x[i]), float(y[i])) for i in range(n)]
    rows += [(0, None, 1.0, 1.0, 1.0, 1.0), (1, 1.0, float("nan"), 1.0, 1.0, 1.0), (2, 1.0, 1.0, 1.0, 1.0, None), (9, None, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k int, x0 double, x1 double, x2 double, x3 double, y double")
    got = {r.k: r for r in ols.fit(df, ["k"], "y", ["x0", "x1", "x2", "x3"]).collect()}
    assert set(got) == {0, 1, 2}
    for k, r in got.items():
        own = np.arange(n) % 3 == k
        a = np.column_stack([np.ones(own.sum()), x[own]])
        b, *_ = np.linalg.lstsq(a, y[own], rcond=None)
        e = y[own] - a @ b
        assert r.n_obs == own.sum() and np.isclose(r.rss, e @ e, rtol=1e-9)
        assert np.allclose([r.b_const, r.b_x0, r.b_x1, r.b_x2, r.b_x3], b, rtol=1e-7)
        assert np.isclose(r.last_scale, np.linalg.inv(a.T @ a)[-1, -1], rtol=1e-7)


def test_constant_and_dependent_terms_get_zero(spark):
    rng = np.random.default_rng(2)
    rows = [(1, float(a), 0.1, float(2 * a), float(3 * a + 1)) for a in rng.normal(size=50)] + [(2, float(a), 0.1, 0.3, 5.0) for a in range(9)]
    got = {r.k: r for r in ols.fit(spark.createDataFrame(rows, "k int, a double, c double, d double, y double"), ["k"], "y", ["a", "c", "d"]).collect()}
    assert got[1].b_c == 0 and got[1].b_d == 0 and abs(got[1].b_a - 3) < 1e-9 and abs(got[1].b_const - 1) < 1e-9 and got[1].rss < 1e-9
    assert (got[2].b_a, got[2].b_c, got[2].b_d, got[2].b_const) == (0, 0, 0, 5)


def _months(n):
    return [dt.date(1990 + i // 12, i % 12 + 1, 1) for i in range(n)]


def _arma(rng, n, ar, sar, ma, scale=10.0):
    e, d = rng.normal(size=n) * scale, np.zeros(n)
    for t in range(n):
        d[t] = e[t] + (ar * d[t - 1] + ma * e[t - 1] if t else 0) + (sar * d[t - 12] if t >= 12 else 0)
    y = np.zeros(n)
    for t in range(n):
        y[t] = d[t] + (y[t - 12] if t >= 12 else 1000)
    return y


def test_model_recovers_simulated_coefficients(spark):
    rng, want, rows = np.random.default_rng(3), {}, []
    for s, (ar, sar, ma) in enumerate([(0.6, -0.3, 0.4), (-0.4, 0.2, 0.5), (0.5, -0.5, -0.2)]):
        want[f"s{s}"] = (ar, sar, ma)
        rows += [(f"s{s}", m, float(v)) for m, v in zip(_months(4000), _arma(rng, 4000, ar, sar, ma))]
    panel = spark.createDataFrame(rows, "series string, month date, y double")
    got = {}
    for r in FC.arx_effects(panel, [], ForecastParams()).collect():
        got.setdefault(r.series, {})[r.term] = r.coef
        assert abs(r.sigma - 10) < 0.5
    for s, (ar, sar, ma) in want.items():
        assert abs(got[s]["ar1"] - ar) < 0.08 and abs(got[s]["sar12"] - sar) < 0.06 and abs(got[s]["ma1"] - ma) < 0.1


def test_criteria_prefer_the_fitted_order_and_short_series_are_skipped(spark):
    rng = np.random.default_rng(4)
    rows = [("long", m, float(v)) for m, v in zip(_months(240), _arma(rng, 240, 0.5, -0.3, 0.3))]
    rows += [("short", m, 5.0 + i) for i, m in enumerate(_months(30))] + [("flat", m, 5.0) for m in _months(60)]
    panel = spark.createDataFrame(rows, "series string, month date, y double")
    p = ForecastParams(horizon=12)
    out = FC.arx_forecast(panel, [], p).collect()
    by = {s: sorted((r for r in out if r.series == s), key=lambda r: r.h or 0) for s in ("long", "short", "flat")}
    assert [r.status for r in by["short"]] == ["skipped"] and [r.h for r in by["long"]] == list(range(1, 13))
    assert all(0 <= r.yhat_lo <= r.yhat <= r.yhat_hi and r.bic > r.aic for r in by["long"])
    assert by["long"][0].month == dt.date(2010, 1, 1) and all(abs(r.yhat - 5) < 1e-9 for r in by["flat"])
    wide = [r.yhat_hi - r.yhat for r in by["long"]]
    assert all(a <= b + 1e-9 for a, b in zip(wide, wide[1:]))
    with pytest.raises(ValueError):
        FC.arx_forecast(panel, [], ForecastParams(horizon=13))


def test_forecast_recursion_by_hand(spark):
    """The first months ahead from the reported coefficients, in plain Python."""
    rng = np.random.default_rng(5)
    y = _arma(rng, 96, 0.4, -0.2, 0.3)
    panel = spark.createDataFrame([("s", m, float(v)) for m, v in zip(_months(96), y)], "series string, month date, y double")
    b = {r.term: r.coef for r in FC.arx_effects(panel, [], ForecastParams()).collect()}
    d = np.concatenate([np.full(12, np.nan), y[12:] - y[:-12]])
    e = 0.0
    for t in range(24, 96):
        e = d[t] - b["const"] - b["ar1"] * d[t - 1] - b["sar12"] * d[t - 12] - b["ma1"] * e
    want, last = [], d[-1]
    for h in range(6):
        last = b["const"] + b["ar1"] * last + b["sar12"] * d[84 + h] + (b["ma1"] * e if h == 0 else 0)
        want.append(max(y[84 + h] + last, 0))
    got = sorted(FC.arx_forecast(panel, [], ForecastParams()).collect(), key=lambda r: r.h)
    assert np.allclose([r.yhat for r in got], want)


def test_kmeans_steps_equal_numpy(spark):
    rng = np.random.default_rng(6)
    points = np.concatenate([rng.normal(size=(40, 4)) + c for c in (0, 6, -6)])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "key int, " + ", ".join(f"{c} double" for c in G.FEATURES))
    starts = G.start_points(df, 3, 4, 42)
    assert sorted(starts) == [0, 1, 2, 3] and all(len(s) == 3 for s in starts.values()) and starts[0] != starts[1]
    found, inertia = G.lloyd(df, {("a", r): s for r, s in starts.items()}, 15)
    for r, s in starts.items():
        c = np.array(s)
        for _ in range(15):
            near = ((points[:, None] - c) ** 2).sum(2).argmin(1)
            c = np.array([points[near == i].mean(0) if (near == i).any() else c[i] for i in range(3)])
        assert np.allclose(found["a", r], c) and np.isclose(inertia["a", r], ((points[:, None] - c) ** 2).sum(2).min(1).sum())
    centroids, assigned, cost = G.kmeans_best(df, 3, 42, 6)
    assert np.isclose(cost, min(G.best_models(df, [3], 42, 6)[3][0], cost)) and len({r.cluster_id for r in assigned.collect()}) == 3


def test_quantiles_shuffle_no_values(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i % 2), float(v)) for i, v in enumerate(rng.lognormal(size=5000))] + [(0, None), (None, 1.0), (None, 3.0), (3, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    q = group_quantiles(df, ["g"], "v", {"a": 0.25, "b": 0.99}, "n")
    got = {r.g: r for r in q.collect()}
    for g in (0, 1):
        own = np.array([v for k, v in rows if k == g and v is not None])
        assert np.allclose([got[g].a, got[g].b], np.quantile(own, [0.25, 0.99])) and got[g].n == sum(k == g for k, _ in rows)
    assert (got[None].a, got[None].n) == (1.5, 2) and got[3].a is None and got[3].n == 1
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert group_quantiles(df.where("false"), [], "v", {"a": 0.5}).collect()[0].a is None
