"""Panel time-series models: folds, baselines, grouped seasonal-ARX fits,
forecasts with intervals, driver scenarios.

IDs: W-8..W-15, J-13, J-15.

Re-aimed from one exact-likelihood SARIMA fit on one series to a panel job:
thousands of (product x market) series (and their folds) are fitted at once by
aggregates and expressions; nothing gathers a group but the innovations
recursion, which folds the (calendar-bounded) months of one series.  The model
on the seasonal difference d_t = y_t - y_{t-12} is

    d_t = c + a1 d_{t-1} + a12 d_{t-12} + sum_j b_j dx_{j,t} + m1 e_{t-1} + e_t

i.e. AR(1), seasonal AR(1), the seasonal difference and the MA(1) term of the
reference's (1,0,1)(1,1,0,12) with exogenous drivers, in additive form, fitted
by the Hannan-Rissanen regressions instead of exact likelihood: coefficients
will not equal the reference's.  AIC and BIC are those of the conditional
Gaussian likelihood.  Forecasts are recursive; the 90 % interval is
+-1.645 sigma sqrt(sum psi_j^2); everything is clipped at 0.  Series shorter
than ``min_points`` return a 'skipped' row.  Baselines (seasonal naive, linear
trend) are pure DataFrame/SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelens.functions import ols
from tradelens.functions.stats import measured
from tradelens.params import ForecastParams


# --- indexing and folds --------------------------------------------------------------

def with_time_index(series: DataFrame, keys: list[str], month_col: str = "month") -> DataFrame:
    """Dense series -> t = 0..n-1 per key and n (windows partitioned by key)."""
    w = Window.partitionBy(*keys).orderBy(month_col)
    return (series.withColumn("t", F.row_number().over(w) - 1)
                  .withColumn("n", F.count("*").over(Window.partitionBy(*keys))))


def fold_cuts(indexed: DataFrame, keys: list[str], params: ForecastParams) -> DataFrame:
    """W-10: cut = initial, initial+step, ..., n-horizon per key.

    A series too short for one fold has no cuts.
    """
    n = indexed.groupBy(*keys).agg(F.max("n").alias("n"))
    last = (F.col("n") - params.horizon).cast("int")
    cuts = F.when(last >= params.initial, F.sequence(F.lit(params.initial), last, F.lit(params.step)))
    return n.select(*keys, F.explode(cuts).alias("cut"))


def seasonal_naive_cv(indexed: DataFrame, keys: list[str], params: ForecastParams,
                      value_col: str = "total") -> DataFrame:
    """W-10 + W-15: rolling-origin evaluation of the seasonal naive model
    yhat_{cut+h-1} = y_{cut+h-1-season} (clipped >= 0); all equi-joins."""
    cuts = fold_cuts(indexed, keys, params)
    hs = cuts.select(*keys, "cut", F.explode(F.sequence(F.lit(1), F.lit(params.horizon)))
                     .alias("h")).withColumn("t", F.col("cut") + F.col("h") - 1)
    y = indexed.select(*keys, "t", F.col(value_col).alias("y"), "month")
    past = indexed.select(*keys, (F.col("t") + params.season).alias("t"),
                          F.col(value_col).alias("yhat"))
    return (hs.join(y, [*keys, "t"]).join(past, [*keys, "t"], "left")
              .withColumn("yhat", F.greatest(F.col("yhat"), F.lit(0.0))))


def cv_metrics(folds: DataFrame, keys: list[str], by_horizon: bool = False,
               mape_target: float = 20.0) -> DataFrame:
    """W-11: pct = |y - yhat| / max(y, 1); MAPE %, RMSE, pass flag."""
    err = F.abs(F.col("y") - F.col("yhat"))
    pct = err / F.greatest(F.col("y"), F.lit(1.0))
    g = [*keys, "h"] if by_horizon else keys
    out = folds.groupBy(*g).agg((F.avg(pct) * 100).alias("mape"),
                                F.sqrt(F.avg(err * err)).alias("rmse"),
                                F.count("*").alias("n_points"))
    return out.withColumn("passed", F.col("mape") < mape_target)


def trend_regression(indexed: DataFrame, keys: list[str], value_col: str = "total") -> DataFrame:
    """W-15: least-squares linear trend y ~ a + b t per series."""
    return indexed.groupBy(*keys).agg(F.regr_slope(value_col, "t").alias("slope"),
                                      F.regr_intercept(value_col, "t").alias("intercept"),
                                      F.regr_r2(value_col, "t").alias("r2"))


# --- seasonal ARMA with drivers, in expressions ------------------------------------------

#: A moving-average term beyond this would make the innovations grow; it is set to it.
MAX_MA = 0.98


def _lagged(panel: DataFrame, drivers: list[str], season: int) -> DataFrame:
    """Adds t, d = y_t - y_{t-season}, its lags, the drivers' seasonal differences, and
    ``before`` = y_{t-season}; ``t`` counts the months of a series."""
    w = Window.partitionBy("series").orderBy("month")
    rows = panel.withColumn("t", F.row_number().over(w) - 1)
    y = F.col("y").cast("double")
    rows = rows.withColumns({"y": y, "before": F.lag(y, season).over(w),
                             **{f"d_{c}": F.col(c) - F.lag(c, season).over(w) for c in drivers}})
    rows = rows.withColumn("d", F.col("y") - F.col("before"))
    return rows.withColumns({**{f"d_lag{i}": F.lag("d", i).over(w) for i in (1, 2, 3)}, "d_season": F.lag("d", season).over(w)})


def _fits(rows: DataFrame, keys: list[str], drivers: list[str]) -> DataFrame:
    """Hannan-Rissanen per group: a long autoregression gives innovations, the regression on
    their first lag the coefficients; the recursion e_t = d_t - fit_t - ma1 e_{t-1} (0 before
    the first complete month) gives ``rss``, ``last_e``, ``n_obs`` and the criteria.

    ``rows``: training rows with the columns of ``_lagged``, written (they are read several times).
    """
    dx = [f"d_{c}" for c in drivers]
    long, short = ["d_lag1", "d_lag2", "d_lag3", "d_season", *dx], ["d_lag1", "d_season", *dx]
    w = Window.partitionBy(*keys).orderBy("t")
    first = measured(ols.fit(rows, keys, "d", long, prefix="l_").drop("n_obs", "rss", "last_scale"), "arma-first")
    known = (rows.join(first, keys).withColumn("_u", F.col("d") - ols.fitted(long, "l_"))
             .withColumn("e_lag1", F.lag("_u").over(w)))
    known = measured(known.select(*keys, "t", "d", *short, "e_lag1"), "arma-innovations")
    second = ols.fit(known, keys, "d", [*short, "e_lag1"]).drop("rss", "last_scale")
    second = second.withColumn("b_e_lag1", F.least(F.greatest("b_e_lag1", F.lit(-MAX_MA)), F.lit(MAX_MA)))
    months = (rows.where(ols.complete(["d", *short])).groupBy(*keys)
              .agg(F.array_sort(F.collect_list(F.struct("t", "d", *short))).alias("_c")))  # the months of one series
    k = len(short) + 2
    fit = measured(second.withColumnRenamed("n_obs", "n_fit"), "arma-second").join(months, keys).where(F.col("n_fit") > k)
    fit = fit.withColumn("n_obs", F.size("_c")).withColumn("_i", _innovations("_c", short, "b_e_lag1"))
    fit = fit.withColumns({"rss": F.col("_i.rss"), "last_e": F.col("_i.e")}).drop("_c", "_i")
    fit = fit.withColumn("sigma", F.sqrt(F.col("rss") / (F.col("n_obs") - k)))
    # twice the negative log-likelihood of Gaussian innovations; k coefficients and the variance are estimated
    loss = F.col("n_obs") * (F.log(2 * math.pi * F.col("rss") / F.col("n_obs")) + 1)
    return fit.withColumns({"aic": loss + 2.0 * (k + 1), "bic": loss + F.log(F.col("n_obs").cast("double")) * (k + 1)}).drop("n_fit")


def _innovations(months: str, terms: list[str], ma: str) -> Column:
    """The last innovation ``e`` and the sum of squares ``rss`` of a row with its series' months and coefficients."""
    def step(a, x):
        e = x["d"] - ols.fitted(terms, of=x) - F.col(ma) * a["e"]
        return F.struct(e.alias("e"), (a["rss"] + e * e).alias("rss"))

    return F.aggregate(months, F.struct(F.lit(0.0).alias("e"), F.lit(0.0).alias("rss")), step)


def _ahead(rows: DataFrame, fits: DataFrame, keys: list[str], drivers: list[str], z90: float, carry: tuple = ()) -> DataFrame:
    """keys, h, month, y, yhat, yhat_lo, yhat_hi of the months after each group's training rows.

    ``rows``: those months, with the columns of ``_lagged``, h = 1, 2, ... and ``last_d``, the
    last difference before them.  h may not exceed the season, so every seasonal lag is observed.
    ``carry``: further columns to return, of the rows, the fits, or _yhat and _half (before the clip at 0).
    """
    terms = ["d_season", *[f"d_{c}" for c in drivers]]
    known = rows.join(fits, keys).withColumn(
        "_w", ols.fitted(terms) + F.when(F.col("h") == 1, F.col("b_e_lag1") * F.col("last_e")).otherwise(0.0))
    own = Window.partitionBy(*keys).orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    known = known.withColumn("_ws", F.collect_list("_w").over(own))  # h entries, a season at most
    ar, ma = F.col("b_d_lag1"), F.col("b_e_lag1")
    dhat = F.aggregate("_ws", F.col("last_d"), lambda a, x: a * ar + x)
    steps = F.when(F.col("h") > 1, F.sequence(F.lit(1), F.col("h") - 1)).otherwise(F.array().cast("array<int>"))
    # psi_0 = 1, psi_j = ar psi_{j-1} (+ ma for j = 1): below a season the seasonal lag adds nothing
    psi = F.aggregate(steps, F.struct(F.lit(1.0).alias("s"), (ar + ma).alias("p")),
                      lambda a, i: F.struct((a["s"] + a["p"] * a["p"]).alias("s"), (a["p"] * ar).alias("p")), lambda a: a["s"])
    known = known.withColumns({"_yhat": F.col("before") + dhat, "_half": z90 * F.col("sigma") * F.sqrt(psi)})
    floor = F.lit(0.0)
    return known.select(*keys, "h", "month", "y", F.greatest("_yhat", floor).alias("yhat"),
                        F.greatest(F.col("_yhat") - F.col("_half"), floor).alias("yhat_lo"),
                        F.greatest(F.col("_yhat") + F.col("_half"), floor).alias("yhat_hi"), "b_e_lag1", "aic", "bic", *carry)


def _checked(params: ForecastParams) -> None:
    if params.horizon > params.season:
        raise ValueError("the horizon may not exceed the season")


def _with_future(panel: DataFrame, drivers: list[str], params: ForecastParams) -> tuple[DataFrame, DataFrame]:
    """(series with their last drivers ``_l`` and length n; the columns of ``_lagged`` for the months
    and, with h, the ``horizon`` months after them) of a panel; written."""
    panel = measured(panel, "arma-panel")
    last = panel.groupBy("series").agg(F.max(F.struct("month", *drivers)).alias("_l"), F.count(F.lit(1)).alias("n"))
    months = F.transform(F.sequence(F.lit(1), F.lit(params.horizon)), lambda h: F.struct(
        h.alias("h"), F.add_months("_l.month", h).alias("month")))
    future = (last.select("series", "_l", F.explode(months).alias("_m"))
              .select("series", "_m.month", F.lit(None).cast("double").alias("y"), *[F.col(f"_l.{c}").alias(c) for c in drivers],
                      F.col("_m.h").alias("h")))
    both = panel.select("series", "month", F.col("y").cast("double").alias("y"), *drivers, F.lit(None).cast("int").alias("h")).union(future)
    rows = _lagged(both, drivers, params.season)
    rows = rows.join(last.where(F.col("n") >= params.min_points).select("series"), "series", "left_semi")
    rows = rows.withColumn("last_d", F.last("d", ignorenulls=True).over(
        Window.partitionBy("series").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)))
    return last, measured(rows, "arma-months")


def arx_forecast(panel: DataFrame, drivers: list[str], params: ForecastParams) -> DataFrame:
    """W-9 + W-12: per series, fit on all months and forecast ``horizon`` more; future
    drivers are held at their last value.  Also the MA coefficient, AIC and BIC of the fit.
    ``panel``: (series, month, y, *drivers), dense monthly.  A series that is too short or
    whose terms outnumber its complete months has one row, status 'skipped'."""
    _checked(params)
    last, rows = _with_future(panel, drivers, params)
    fits = _fits(rows.where("h is null"), ["series"], drivers)
    out = _ahead(rows.where("h is not null"), fits, ["series"], drivers, params.z90)
    return (last.select("series").join(out, "series", "left")
            .select("series", "h", "month", "yhat", "yhat_lo", "yhat_hi", F.col("b_e_lag1").alias("ma1"), "aic", "bic",
                    F.when(F.col("h").isNull(), "skipped").otherwise("ok").alias("status")))


def scenario_forecast(panel: DataFrame, driver: str, levels, params: ForecastParams) -> DataFrame:
    """W-13: the fitted model's forecast with its 90 % interval when the driver moves by each of
    ``levels`` percent of its last value and stays there.

    The move enters every month's difference through the driver's coefficient and is handed on by
    the AR term: after h months it has added b * move * (1 + ar + ... + ar^(h-1)).  The interval's
    width is that of the innovations; a series without a fit has no rows."""
    _checked(params)
    last, rows = _with_future(panel, [driver], params)
    fits = _fits(rows.where("h is null"), ["series"], [driver])
    own = f"b_d_{driver}"
    base = _ahead(rows.where("h is not null"), fits, ["series"], [driver], params.z90, carry=("_yhat", "_half", "b_d_lag1", own))
    base = base.join(last.select("series", F.col(f"_l.{driver}").alias("_x")), "series")
    passed = F.aggregate(F.sequence(F.lit(1), F.col("h")), F.struct(F.lit(0.0).alias("s"), F.lit(1.0).alias("p")),
                         lambda a, i: F.struct((a["s"] + a["p"]).alias("s"), (a["p"] * F.col("b_d_lag1")).alias("p")), lambda a: a["s"])
    each = base.withColumn("_passed", passed).withColumn("scenario_pct", F.explode(F.array(*[F.lit(int(v)) for v in levels])))
    moved = F.col("_yhat") + F.col(own) * F.col("_x") * F.col("scenario_pct") / 100.0 * F.col("_passed")
    floor = F.lit(0.0)
    return each.withColumn("_m", moved).select(
        "series", "scenario_pct", "h", "month", F.greatest("_m", floor).alias("yhat"), F.greatest(F.col("_m") - F.col("_half"), floor).alias("yhat_lo"),
        F.greatest(F.col("_m") + F.col("_half"), floor).alias("yhat_hi"))


def arx_cv(panel: DataFrame, drivers: list[str], params: ForecastParams) -> DataFrame:
    """W-10 with the model: one fit per (series, cut) on t < cut, scored on the next
    ``horizon`` months with the drivers known; folds without a fit report status 'failed',
    never vanish.  (A fit has a constant, so z-scoring the drivers inside the fold, trap
    T-19, would change no forecast.)"""
    _checked(params)
    keys = ["series", "cut"]
    rows = measured(_lagged(panel, drivers, params.season), "arma-months")
    cuts = fold_cuts(rows.withColumn("n", F.count("*").over(Window.partitionBy("series"))), ["series"], params)
    folds = rows.join(cuts, "series").where(F.col("t") < F.col("cut") + params.horizon)
    folds = folds.withColumn("h", F.when(F.col("t") >= F.col("cut"), F.col("t") - F.col("cut") + 1).cast("int"))
    folds = folds.withColumn("last_d", F.last(F.when(F.col("h").isNull(), F.col("d")), ignorenulls=True).over(
        Window.partitionBy(*keys).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)))
    folds = measured(folds, "arma-folds")
    fits = _fits(folds.where("h is null"), keys, drivers)
    out = _ahead(folds.where("h is not null"), fits, keys, drivers, params.z90)
    return (cuts.join(out, keys, "left")
            .select("series", "cut", "h", "y", "yhat", F.when(F.col("h").isNull(), "failed").otherwise("ok").alias("status")))


def arx_effects(panel: DataFrame, drivers: list[str], params: ForecastParams) -> DataFrame:
    """W-14: fitted coefficients per series in long form; driver terms are per +1 sd of the
    (z-scored) driver's seasonal difference.  A series without a fit has the term 'skipped'."""
    rows = measured(_lagged(panel, drivers, params.season), "arma-months")
    fits = _fits(rows, ["series"], drivers)
    names = {"const": "b_const", "ar1": "b_d_lag1", "sar12": "b_d_season", "ma1": "b_e_lag1", **{c: f"b_d_{c}" for c in drivers}}
    each = fits.select("series", "sigma", "n_obs", F.explode(F.array(*[
        F.struct(F.lit(t).alias("term"), F.col(c).alias("coef")) for t, c in names.items()])).alias("_t"))
    return (rows.select("series").distinct().join(each, "series", "left")
            .select("series", F.coalesce("_t.term", F.lit("skipped")).alias("term"), F.col("_t.coef").alias("coef"), "sigma", "n_obs"))


def adf_test(panel: DataFrame, lags: int = 1, critical_5pct: float = -2.86) -> DataFrame:
    """W-8: Dickey-Fuller t statistic per series from the OLS
    dy_t = a + b y_{t-1} + sum_i g_i dy_{t-i}; stationary when t < the 5 %
    critical value (constant, no trend).  The library's AIC lag search and
    p-value surface are not reproduced (fixed ``lags``)."""
    w = Window.partitionBy("series").orderBy("month")
    rows = panel.withColumn("level", F.lag(F.col("y").cast("double")).over(w))
    rows = rows.withColumn("dy", F.col("y").cast("double") - F.col("level"))
    rows = rows.withColumns({f"dy_lag{i}": F.lag("dy", i).over(w) for i in range(1, lags + 1)})
    rows = measured(rows, "adf-months")
    fits = ols.fit(rows, ["series"], "dy", [*[f"dy_lag{i}" for i in range(1, lags + 1)], "level"])
    enough = F.col("n_obs") > lags + 3
    spread = F.sqrt(F.col("rss") / (F.col("n_obs") - (lags + 2)) * F.col("last_scale"))
    stat = F.when(enough & (spread > 0), F.col("b_level") / spread)
    return (rows.select("series").distinct().join(fits, "series", "left")
            .select("series", stat.alias("adf_stat"), F.coalesce("n_obs", F.lit(0).cast("long")).alias("n_obs"), F.lit(lags).alias("lags"),
                    F.lit(critical_5pct).alias("critical_5pct"), (stat < critical_5pct).alias("stationary")))


# --- scenarios (J-13, J-15, W-13) -----------------------------------------------------

def scenario_grid(base_forecast: DataFrame, levels, effect_col: str = "effect") -> DataFrame:
    """J-13 + W-13: every scenario level x future month:
    yhat = max(base + effect * level / 100, 0).  ``base_forecast`` has
    (month, base, effect); levels are a fixed, bounded list (broadcast)."""
    spark = base_forecast.sparkSession
    lv = spark.createDataFrame([(int(v),) for v in levels], "scenario_pct int")
    return (base_forecast.crossJoin(F.broadcast(lv))
            .select("scenario_pct", "month",
                    F.greatest(F.col("base") + F.col(effect_col) * F.col("scenario_pct") / 100.0,
                               F.lit(0.0)).alias("yhat")))


def scenario_swing(grid: DataFrame, low: int = -30, high: int = 30) -> DataFrame:
    """J-15: total per scenario, its difference to the base (0 %) scenario,
    and the swing between ``high`` and ``low`` -- conditional sums, no self join."""
    tot = grid.groupBy("scenario_pct").agg(F.sum("yhat").alias("total"))
    ref = tot.agg(F.sum(F.when(F.col("scenario_pct") == 0, F.col("total"))).alias("__base"),
                  (F.sum(F.when(F.col("scenario_pct") == high, F.col("total")))
                   - F.sum(F.when(F.col("scenario_pct") == low, F.col("total")))).alias("swing"))
    return (tot.crossJoin(F.broadcast(ref))
               .withColumn("vs_base", F.col("total") - F.col("__base"))
               .drop("__base"))
