"""Risk, segmentation, time-series and forecast invariants on literal frames
and on the smallest test tables."""

import datetime as dt

from pyspark.sql import functions as F

from tradelens.functions.stats import minmax_scale
from tradelens.operators import drivers as D
from tradelens.operators import forecast as FC
from tradelens.operators import risk as K
from tradelens.operators import seasonality as S
from tradelens.operators import segment as G
from tradelens.params import ForecastParams, RiskParams, SegmentParams
from tradelens.plans import q_segment, q_timeseries

SF = "/root/testdata/sf0.001"


def _d(y, m):
    return dt.date(y, m, 1)


def test_minmax_constant_column_is_five(spark):
    df = spark.createDataFrame([(1, 3.0, 1.0), (2, 3.0, 3.0)], "k int, a double, b double")
    out = {r["k"]: (r["a"], r["b"]) for r in minmax_scale(df, ["a", "b"]).collect()}
    assert out == {1: (5.0, 0.0), 2: (5.0, 10.0)}


def test_risk_single_month_cv_is_zero_and_trend(spark):
    rows = [("A", _d(2019, m), 10.0, 1.0, "p1", False) for m in range(1, 8)]
    rows += [("B", _d(2019, 1), 5.0, 1.0, "p1", False)] * 7   # one active month only
    rows += [("A", _d(2022, 1), 20.0, 2.0, "p2", True)]
    df = spark.createDataFrame(rows, "key string, d date, v double, price double, p string, o boolean")
    params = RiskParams(min_active_months=1)
    sig = {r["key"]: r for r in K.risk_signals(df, "key", "d", "v", "price", "p", "o",
                                               params).collect()}
    assert sig["B"]["price_volatility"] == 0.0 and sig["B"]["shipment_irregular"] == 0.0
    assert sig["B"]["revenue_trend"] == 1 / 0.01          # no late rows -> ratio 0
    assert abs(sig["A"]["revenue_trend"] - 1 / (20.0 / 70.0 + 0.01)) < 1e-12
    assert sig["A"]["hs_concentration"] == 0.5
    bands = K.risk_bands(K.risk_scores(K.risk_signals(df, "key", "d", "v", "price", "p", "o",
                                                      params)))
    assert {r["risk_band"] for r in bands.collect()} <= {"Low", "Medium", "High"}


def test_cagr_zero_start_is_null_then_zero(spark):
    rows = [("A", _d(1996, m), 0.0) for m in range(1, 7)] + [("A", _d(2000, 1), 50.0)]
    rows += [("B", _d(1996, m), 10.0) for m in range(1, 7)] + [("B", _d(2000, 1), 160.0)]
    df = spark.createDataFrame(rows, "key string, d date, v double")
    p = SegmentParams(start_year=1996, end_year=2000, last_year=2000)
    f = {r["key"]: r["cagr"] for r in G.segment_features(df, "key", "d", "v", p).collect()}
    assert f["A"] == 0.0
    assert abs(f["B"] - ((160.0 / 60.0) ** 0.25 - 1)) < 1e-12
    raw = {r["key"]: r["cagr"] for r in
           G.segment_features(df, "key", "d", "v", p, fill_cagr=False).collect()}
    assert raw["A"] is None


def test_kmeans_labels_each_once(spark):
    km = q_segment.segment_kmeans(spark, SF)
    labels = km.groupBy("cluster_label").agg(F.countDistinct("cluster_id").alias("n")).collect()
    assert sorted(r["cluster_label"] for r in labels) == ["Core", "Declining", "Rising Star",
                                                          "Untapped"]
    assert all(r["n"] == 1 for r in labels)


def test_elbow_k1_is_total_sum_of_squares(spark):
    el = {r["k"]: r["inertia"] for r in q_segment.segment_elbow(spark, SF).collect()}
    assert el[1] == max(el.values())


def test_kmeans_step_measures_points_in_blocks(spark):
    """Every point meets every model without a row per point and model; ties, NULLs and blocks."""
    import math
    import random

    rnd = random.Random(3)
    points = [(f"p{i}", float(rnd.randrange(-3, 4)), float(rnd.randrange(-3, 4))) for i in range(5000)]
    points += [("tie", 0.0, 0.0), ("null", None, 2.0)]
    models = {"one": [[0.5, 0.5]], "two": [[-1.0, 0.0], [1.0, 0.0]], "other": [[1.0, 1.0], [-2.0, 0.5]],
              "three": [[0.0, 2.0], [0.0, -2.0], [50.0, 50.0]]}
    df = spark.createDataFrame(points, "key string, a double, b double").repartition(3)
    got = G._step(df, models, ("a", "b"))
    want = {}
    for name, centers in models.items():
        for _, a, b in points:
            d = [None if a is None else (a - c[0]) * (a - c[0]) + (b - c[1]) * (b - c[1]) for c in centers]
            i = 0 if a is None else d.index(min(d))
            n, t, (x, y) = want.get((name, i), (0, 0.0, (0.0, 0.0)))
            want[name, i] = n + 1, t + (d[i] or 0.0), (x + (a or 0.0), y + b)
    assert got.keys() == want.keys()
    for at, (n, t, xy) in want.items():
        assert got[at][0] == n and math.isclose(got[at][1], t)
        assert all(math.isclose(g, w, abs_tol=1e-9) for g, w in zip(got[at][2], xy))
    plan = G.cluster_sums(df, list(models.values()), ("a", "b"))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and G.cluster_sums(df, list(models.values()), ("a", "b")).count() <= 3 * 8


def test_densify_fills_missing_month(spark):
    df = spark.createDataFrame([("a", _d(2020, 1), 1.0), ("a", _d(2020, 3), 3.0)],
                               "k string, month date, total double")
    out = sorted((r["month"], r["total"]) for r in S.densify_monthly(df, ["k"]).collect())
    assert out == [(_d(2020, 1), 1.0), (_d(2020, 2), 0.0), (_d(2020, 3), 3.0)]


def test_fill_both_ways_start_and_middle(spark):
    df = spark.createDataFrame([(_d(2020, 1), None), (_d(2020, 2), 2.0), (_d(2020, 3), None),
                                (_d(2020, 4), 4.0)], "month date, v double")
    targets = df.select("month")
    out = sorted((r["month"], r["v"]) for r in D.align_to_months(df, targets, "v").collect())
    assert [v for _, v in out] == [2.0, 2.0, 2.0, 4.0]


def test_yearly_broadcast_default(spark):
    y = spark.createDataFrame([(2020, 90.0)], "year int, lpa double")
    t = spark.createDataFrame([(_d(2020, 5),), (_d(2021, 1),)], "month date")
    out = sorted((r["month"], r["lpa"]) for r in D.yearly_to_months(y, t, "year", "lpa").collect())
    assert out == [(_d(2020, 5), 90.0), (_d(2021, 1), 100.0)]


def test_annual_to_weekly_mondays(spark):
    y = spark.createDataFrame([(2019, 1000.7), (2024, 580.2)], "year int, v double")
    w = D.annual_to_weekly(y, "year", "v").collect()
    assert len(w) == 52 + 53   # Mondays in 2019 and in 2024 (leap year starting on a Monday)
    assert all(r["week_start_date"].weekday() == 0 for r in w)
    assert {r["value"] for r in w} == {1000, 580}


def test_fold_count_formula(spark):
    n, p = 72, ForecastParams(horizon=6, initial=36, step=3)
    months = [dt.date(2019 + (i // 12), i % 12 + 1, 1) for i in range(n)]
    df = spark.createDataFrame([("s", m, float(i)) for i, m in enumerate(months)],
                               "product string, month date, total double")
    idx = FC.with_time_index(df, ["product"])
    assert FC.fold_cuts(idx, ["product"], p).count() == (n - p.horizon - p.initial) // p.step + 1


def test_arx_forecast_invariants(spark):
    fc = q_timeseries.arx_forecast(spark, "/root/testdata/sf0.01")
    ok = fc.filter(F.col("status") == "ok")
    bad = ok.filter((F.col("yhat") < 0) | (F.col("yhat_lo") > F.col("yhat"))
                    | (F.col("yhat") > F.col("yhat_hi")))
    assert ok.count() > 0 and bad.count() == 0
    per = ok.groupBy("series").agg(F.count("*").alias("n"), F.min("h").alias("lo"),
                                   F.max("h").alias("hi"))
    assert per.filter((F.col("n") != 6) | (F.col("lo") != 1) | (F.col("hi") != 6)).count() == 0


def test_adf_flags_random_walk_vs_noise(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    walk = np.cumsum(rng.normal(size=120))
    noise = rng.normal(size=120)
    months = [dt.date(2010 + i // 12, i % 12 + 1, 1) for i in range(120)]
    rows = [("walk", m, float(v)) for m, v in zip(months, walk)]
    rows += [("noise", m, float(v)) for m, v in zip(months, noise)]
    df = spark.createDataFrame(rows, "series string, month date, y double")
    res = {r["series"]: r["stationary"] for r in FC.adf_test(df).collect()}
    assert res == {"walk": False, "noise": True}


def test_annual_to_weekly_reference_span_has_313_weeks(spark):
    y = spark.createDataFrame([(yr, 100.0) for yr in range(2019, 2025)], "year int, v double")
    w = D.annual_to_weekly(y, "year", "v")
    r = w.agg(F.count("*").alias("n"), F.min("week_start_date").alias("lo"),
              F.max("week_start_date").alias("hi")).first()
    assert (r["n"], r["lo"], r["hi"]) == (313, dt.date(2019, 1, 7), dt.date(2024, 12, 30))


def test_decomposition_seasonal_is_centred_and_trend_edges_null(spark):
    import math
    months = [dt.date(2015 + i // 12, i % 12 + 1, 1) for i in range(48)]
    rows = [("s", m, 100.0 + i + 10.0 * math.sin(2 * math.pi * (i % 12) / 12))
            for i, m in enumerate(months)]
    df = spark.createDataFrame(rows, "k string, month date, total double")
    d = S.seasonal_decompose(df, ["k"]).orderBy("month").collect()
    assert all(r["trend"] is None for r in d[:6] + d[-6:])
    assert all(r["trend"] is not None for r in d[6:-6])
    assert abs(sum(r["seasonal"] for r in d[:12])) < 1e-9      # one period sums to 0
    for r in d[6:-6]:
        assert abs(r["trend"] + r["seasonal"] + r["resid"] - r["total"]) < 1e-9


def test_scenario_grid_shape_and_monotone(spark):
    base = spark.createDataFrame([(dt.date(2025, m, 1), 100.0, 20.0) for m in range(1, 13)],
                                 "month date, base double, effect double")
    g = FC.scenario_grid(base, tuple(range(-40, 45, 5)))
    assert g.count() == 17 * 12
    tot = {r["scenario_pct"]: r["total"] for r in FC.scenario_swing(g).collect()}
    levels = sorted(tot)
    assert all(tot[a] < tot[b] for a, b in zip(levels, levels[1:]))
    sw = FC.scenario_swing(g).first()["swing"]
    assert abs(sw - (tot[30] - tot[-30])) < 1e-9


def test_short_series_has_no_folds(spark):
    from tradelens.operators.forecast import fold_cuts
    from tradelens.params import ForecastParams

    indexed = spark.createDataFrame([("short", 10), ("edge", 42), ("long", 72)], "brand string, n long")
    got = fold_cuts(indexed, ["brand"], ForecastParams()).groupBy("brand").count().collect()
    assert {r["brand"]: r["count"] for r in got} == {"edge": 1, "long": 11}
