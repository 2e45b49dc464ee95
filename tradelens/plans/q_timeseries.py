"""Drivers, baselines, panel forecasts and scenarios on the test tables.

Weekly driver  = orders per Monday week (weeks below the median count are
                 treated as unpublished, leaving gaps to fill).
Yearly driver  = yearly mean order price relative to the all-order mean x 100,
                 published for complete years only (2001 is partial ->
                 the 100.0 default applies).
Target months  = the fact's month range (from lineitem ship dates).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tradelens.functions.numeric import fround
from tradelens.operators import drivers as D
from tradelens.operators import forecast as FC
from tradelens.operators import seasonality as S
from tradelens.params import ForecastParams
from tradelens.plans.registry import register
from tradelens.sources.tables import read_table, trade, with_trade

CV_PARAMS = ForecastParams(horizon=6, initial=36, step=3)
ARX_PARAMS = ForecastParams(horizon=6, initial=48, step=6)
SCENARIO_LEVELS = tuple(range(-40, 45, 5))


def target_months(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    span = li.agg(F.trunc(F.to_date(F.min("l_shipdate")), "month").alias("lo"),
                  F.trunc(F.to_date(F.max("l_shipdate")), "month").alias("hi"))
    return span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month"))


def weekly_driver(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    wk = (o.groupBy(F.to_date(F.date_trunc("week", "o_orderdate")).alias("week_start_date"))
           .agg(F.count("*").alias("orders")))
    med = wk.agg(F.percentile(F.col("orders").cast("double"), 0.5).alias("__med"))
    return (wk.crossJoin(F.broadcast(med)).filter(F.col("orders") >= F.col("__med"))
              .drop("__med"))


def weekly_monthly(spark, sf_dir):
    m = D.weekly_to_monthly(weekly_driver(spark, sf_dir), "week_start_date", "orders")
    return D.align_to_months(m.withColumnRenamed("orders", "rig"),
                             target_months(spark, sf_dir), "rig")


def yearly_driver(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    allmean = o.agg(F.avg("o_totalprice").alias("__all"))
    y = (o.groupBy(F.year("o_orderdate").alias("year"))
          .agg(F.avg("o_totalprice").alias("__avg"),
               F.count_distinct(F.month("o_orderdate")).alias("__months")))
    return (y.filter(F.col("__months") == 12).crossJoin(F.broadcast(allmean))
             .select("year", (F.col("__avg") / F.col("__all") * 100).alias("lpa_pct")))


def drivers_frame(spark, sf_dir):
    w = weekly_monthly(spark, sf_dir).select("month", "rig")
    return D.yearly_to_months(yearly_driver(spark, sf_dir), w, "year", "lpa_pct")


DRIVER_SQL = (
    """tm AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', min(l_shipdate)) AS TIMESTAMP),
                                                CAST(date_trunc('month', max(l_shipdate)) AS TIMESTAMP),
                                                INTERVAL 1 MONTH)) AS DATE) AS month FROM lineitem)""",
    """wk0 AS (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start_date, count(*) AS orders
              FROM orders GROUP BY 1)""",
    """wk AS (SELECT * FROM wk0 WHERE orders >= (SELECT quantile_cont(orders, 0.5) FROM wk0))""",
    """wm AS (SELECT CAST(date_trunc('month', week_start_date) AS DATE) AS month, avg(orders) AS rig
             FROM wk GROUP BY 1)""",
    """aligned AS (SELECT tm.month, wm.rig AS raw,
         coalesce(last_value(wm.rig IGNORE NULLS) OVER (ORDER BY tm.month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                  first_value(wm.rig IGNORE NULLS) OVER (ORDER BY tm.month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
           AS rig
       FROM tm LEFT JOIN wm USING (month))""",
    """yd AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
                    avg(o_totalprice) / (SELECT avg(o_totalprice) FROM orders) * 100 AS lpa_pct
             FROM orders GROUP BY 1 HAVING count(DISTINCT month(o_orderdate)) = 12)""",
    """drv AS (SELECT a.month, a.rig, coalesce(yd.lpa_pct, 100.0) AS lpa_pct
              FROM aligned a LEFT JOIN yd ON year(a.month) = yd.year)""",
)


@register("annual_to_weekly", """
WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, avg(o_totalprice) AS v FROM orders GROUP BY 1)
SELECT CAST(unnest(generate_series(
         CAST(make_date(year, 1, 1) + CAST((8 - isodow(make_date(year, 1, 1))) % 7 AS INTEGER) AS TIMESTAMP),
         CAST(make_date(year, 12, 31) AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week_start_date,
       CAST(trunc(v) AS INTEGER) AS value
FROM y""", ids=("S-9",))
def annual_to_weekly(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    y = o.groupBy(F.year("o_orderdate").alias("year")).agg(F.avg("o_totalprice").alias("v"))
    return D.annual_to_weekly(y, "year", "v").select("week_start_date", "value")


@register("weekly_driver_monthly", with_trade("""
SELECT month, round(raw, 6) AS raw, round(rig, 6) AS rig FROM aligned""", *DRIVER_SQL),
          ids=("J-11", "W-4"))
def weekly_driver_monthly(spark, sf_dir):
    return _weekly_raw_and_filled(spark, sf_dir)


def _weekly_raw_and_filled(spark, sf_dir):
    """Monthly mean of the published weeks on the target calendar, raw and
    filled both ways (one window over the calendar months)."""
    m = D.weekly_to_monthly(weekly_driver(spark, sf_dir), "week_start_date", "orders")
    j = target_months(spark, sf_dir).join(m.withColumnRenamed("orders", "raw"), "month", "left")
    f = D.fill_both_ways(j.withColumn("__k", F.lit(0)), ["__k"], "month", "raw", out="rig")
    return f.select("month", fround("raw", 6).alias("raw"), fround("rig", 6).alias("rig"))


@register("fill_both_ways", with_trade("""
SELECT month, rig IS NOT NULL AND raw IS NULL AS was_filled, round(rig, 6) AS rig FROM aligned""",
    *DRIVER_SQL), ids=("W-4",))
def fill_both_ways(spark, sf_dir):
    f = _weekly_raw_and_filled(spark, sf_dir)
    return f.select("month", (F.col("rig").isNotNull() & F.col("raw").isNull()).alias("was_filled"),
                    "rig")


@register("yearly_driver_broadcast", with_trade("""
SELECT month, round(lpa_pct, 6) AS lpa_pct FROM drv""", *DRIVER_SQL), ids=("J-12",))
def yearly_driver_broadcast(spark, sf_dir):
    y = D.yearly_to_months(yearly_driver(spark, sf_dir), target_months(spark, sf_dir), "year",
                           "lpa_pct")
    return y.select("month", fround("lpa_pct", 6).alias("lpa_pct"))


@register("zscore_drivers", with_trade("""
SELECT month, round((rig - avg(rig) OVER ()) / stddev_samp(rig) OVER (), 6) AS rig_z,
       round((lpa_pct - avg(lpa_pct) OVER ()) / stddev_samp(lpa_pct) OVER (), 6) AS lpa_pct_z
FROM drv""", *DRIVER_SQL), ids=("W-5",))
def zscore_drivers(spark, sf_dir):
    z = D.zscore_drivers(drivers_frame(spark, sf_dir), ["rig", "lpa_pct"])
    return z.select("month", fround("rig_z", 6).alias("rig_z"),
                    fround("lpa_pct_z", 6).alias("lpa_pct_z"))


@register("drop_invalid_driver_rows", """
SELECT year, state, round(rainfall_mm, 6) AS rainfall_mm, round(lpa_pct, 6) AS lpa_pct FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, upper(substr(o_orderpriority, 3)) AS state,
         avg(o_totalprice) / 1000 AS rainfall_mm,
         avg(o_totalprice) / (SELECT avg(o_totalprice) FROM orders) * 100 - 100 AS lpa_pct
  FROM orders GROUP BY 1, 2)
WHERE coalesce(rainfall_mm > 0 AND lpa_pct > 0, false)""", ids=("S-10",))
def drop_invalid_driver_rows(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    allmean = o.agg(F.avg("o_totalprice").alias("__all"))
    a = (o.groupBy(F.year("o_orderdate").alias("year"),
                   F.upper(F.substring("o_orderpriority", 3, 100)).alias("state"))
          .agg(F.avg("o_totalprice").alias("__avg"))
          .crossJoin(F.broadcast(allmean))
          .select("year", "state", (F.col("__avg") / 1000).alias("rainfall_mm"),
                  (F.col("__avg") / F.col("__all") * 100 - 100).alias("lpa_pct")))
    positive = ["rainfall_mm", "lpa_pct"]
    good = D.validate_annual(D.valid_driver_rows(a, positive), ["year", "state", *positive], positive)
    return good.select("year", "state", fround("rainfall_mm", 6).alias("rainfall_mm"),
                       fround("lpa_pct", 6).alias("lpa_pct"))


# --- baselines on the product series ------------------------------------------------

def product_series(spark, sf_dir):
    m = S.monthly_totals(trade(spark, sf_dir), ["product"])
    return FC.with_time_index(S.densify_monthly(m, ["product"]), ["product"])


SERIES_SQL = (
    """m0 AS (SELECT product, shipment_date AS month, CAST(sum(value) AS DOUBLE) AS total FROM trade GROUP BY 1, 2)""",
    """b AS (SELECT product, min(month) AS lo, max(month) AS hi FROM m0 GROUP BY 1)""",
    """g AS (SELECT product, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                                        INTERVAL 1 MONTH)) AS DATE) AS month FROM b)""",
    """ser AS (SELECT g.product, g.month, coalesce(m0.total, 0.0) AS total,
                      CAST(row_number() OVER (PARTITION BY g.product ORDER BY g.month) - 1 AS INTEGER) AS t,
                      count(*) OVER (PARTITION BY g.product) AS n
               FROM g LEFT JOIN m0 USING (product, month))""",
    """cuts AS (SELECT product, CAST(unnest(generate_series(36, max(n) - 6, 3)) AS INTEGER) AS cut
               FROM ser GROUP BY product)""",
    """folds AS (SELECT c.product, c.cut, CAST(h AS INTEGER) AS h, s.month, s.total AS y,
                        greatest(p.total, 0.0) AS yhat
                 FROM cuts c CROSS JOIN (SELECT unnest(generate_series(1, 6)) AS h) hh
                 JOIN ser s ON s.product = c.product AND s.t = c.cut + hh.h - 1
                 LEFT JOIN ser p ON p.product = c.product AND p.t + 12 = c.cut + hh.h - 1)""",
)


def _naive(spark, sf_dir):
    return FC.seasonal_naive_cv(product_series(spark, sf_dir), ["product"], CV_PARAMS)


@register("seasonal_naive_cv", with_trade("""
SELECT product, cut, h, month, y, yhat FROM folds""", *SERIES_SQL), ids=("W-10", "W-15"))
def seasonal_naive_cv(spark, sf_dir):
    return _naive(spark, sf_dir).select("product", "cut", "h", "month", "y", "yhat")


@register("cv_metrics", with_trade("""
SELECT product, round(avg(abs(y - yhat) / greatest(y, 1.0)) * 100, 6) AS mape,
       round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS rmse, count(*) AS n_points,
       avg(abs(y - yhat) / greatest(y, 1.0)) * 100 < 20.0 AS passed
FROM folds GROUP BY product""", *SERIES_SQL), ids=("W-11",))
def cv_metrics(spark, sf_dir):
    m = FC.cv_metrics(_naive(spark, sf_dir), ["product"])
    return m.select("product", fround("mape", 6).alias("mape"), fround("rmse", 4).alias("rmse"),
                    "n_points", "passed")


@register("cv_metrics_by_horizon", with_trade("""
SELECT h, round(avg(abs(y - yhat) / greatest(y, 1.0)) * 100, 6) AS mape, count(*) AS n_points
FROM folds GROUP BY h""", *SERIES_SQL), ids=("W-11",))
def cv_metrics_by_horizon(spark, sf_dir):
    m = FC.cv_metrics(_naive(spark, sf_dir), [], by_horizon=True)
    return m.select("h", fround("mape", 6).alias("mape"), "n_points")


@register("trend_regression", with_trade("""
SELECT product, round(regr_slope(total, t), 4) AS slope, round(regr_intercept(total, t), 2) AS intercept
FROM ser GROUP BY product""", *SERIES_SQL), ids=("W-15",))
def trend_regression(spark, sf_dir):
    r = FC.trend_regression(product_series(spark, sf_dir), ["product"])
    return r.select("product", fround("slope", 4).alias("slope"),
                    fround("intercept", 2).alias("intercept"))


# --- panel ARX on (product x market) series with both drivers ------------------------

def arx_panel(spark, sf_dir):
    m = S.monthly_totals(trade(spark, sf_dir), ["product", "market"])
    dense = S.densify_monthly(m, ["product", "market"], span="global")
    drv = D.zscore_drivers(drivers_frame(spark, sf_dir), ["rig", "lpa_pct"])
    return (dense.join(F.broadcast(drv.select("month", "rig_z", "lpa_pct_z")), "month", "left")
                 .select(F.concat_ws("|", "product", "market").alias("series"), "month",
                         F.col("total").alias("y"), "rig_z", "lpa_pct_z"))


PANEL_SQL = (
    """zdrv AS (SELECT month, (rig - avg(rig) OVER ()) / stddev_samp(rig) OVER () AS rig_z,
                    (lpa_pct - avg(lpa_pct) OVER ()) / stddev_samp(lpa_pct) OVER () AS lpa_pct_z FROM drv)""",
    """pm AS (SELECT product, market, shipment_date AS month, CAST(sum(value) AS DOUBLE) AS total FROM trade GROUP BY 1, 2, 3)""",
    """pmonths AS (SELECT CAST(unnest(generate_series(CAST(min(month) AS TIMESTAMP), CAST(max(month) AS TIMESTAMP),
                                                      INTERVAL 1 MONTH)) AS DATE) AS month FROM pm)""",
    """panel0 AS (SELECT k.product || '|' || k.market AS series, pmonths.month, coalesce(pm.total, 0.0) AS y, rig_z, lpa_pct_z
                  FROM (SELECT DISTINCT product, market FROM pm) k CROSS JOIN pmonths
                  LEFT JOIN pm ON pm.product = k.product AND pm.market = k.market AND pm.month = pmonths.month
                  LEFT JOIN zdrv ON zdrv.month = pmonths.month)""",
    """panel AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY month) - 1 AS t, count(*) OVER (PARTITION BY series) AS n
                 FROM panel0)""",
)


def ols_sql(name: str, source: str, keys: str, target: str, terms: list[str]) -> tuple[str, ...]:
    """CTEs up to ``<name>``: least squares per group with the coefficients of ``terms`` as
    b_<term> and b_const, by elimination on the correlation matrix."""
    k = range(len(terms))
    moments = [f"count(*) AS n_obs, avg({target}) AS my, var_pop({target}) AS vy"]
    for i, x in enumerate(terms):
        moments.append(f"avg({x}) AS m{i}, var_pop({x}) AS v{i}, covar_pop({x}, {target}) AS y{i}")
        moments += [f"covar_pop({x}, {terms[j]}) AS c{i}_{j}" for j in range(i)]
    known = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in (target, *terms))
    last = len(terms) - 1
    levels = [", ".join([f"CASE WHEN v{i} > 0 AND vy > 0 THEN y{i} / sqrt(v{i} * vy) ELSE 0.0 END AS r{i}" for i in k]
                        + [f"CASE WHEN v{i} > 0 AND v{j} > 0 THEN c{i}_{j} / sqrt(v{i} * v{j}) ELSE 0.0 END AS s{i}_{j}"
                           for i in k for j in range(i)]
                        + [f"CASE WHEN v{i} > 0 THEN 1.0 ELSE 0.0 END AS s{i}_{i}" for i in k])]
    for j in k:  # a column of the factor at a time
        levels.append(f"s{j}_{j}{''.join(f' - l{j}_{m} * l{j}_{m}' for m in range(j))} AS p{j}")
        levels.append(f"CASE WHEN p{j} > 1e-9 THEN 1 / sqrt(p{j}) ELSE 0.0 END AS q{j}")
        levels.append(", ".join([f"(r{j}{''.join(f' - l{j}_{m} * z{m}' for m in range(j))}) * q{j} AS z{j}"]
                                + [f"(s{i}_{j}{''.join(f' - l{i}_{m} * l{j}_{m}' for m in range(j))}) * q{j} AS l{i}_{j}" for i in k if i > j]))
    for j in reversed(k):
        levels.append(f"(z{j}{''.join(f' - l{m}_{j} * g{m}' for m in k if m > j)}) * q{j} AS g{j}")
    levels.append(", ".join(f"CASE WHEN v{i} > 0 THEN g{i} * sqrt(vy / v{i}) ELSE 0.0 END AS b_{x}" for i, x in enumerate(terms)))
    ctes = [f"{name}_0 AS MATERIALIZED (SELECT {keys}, {', '.join(moments)} FROM {source} WHERE {known} GROUP BY {keys})"]
    ctes += [f"{name}_{i + 1} AS (SELECT *, {x} FROM {name}_{i})" for i, x in enumerate(levels)]
    return (*ctes, f"""{name} AS MATERIALIZED (SELECT {keys}, n_obs, {', '.join(f'b_{x}' for x in terms)},
                my{''.join(f' - b_{x} * m{i}' for i, x in enumerate(terms))} AS b_const,
                greatest(0.0, n_obs * vy * (1{''.join(f' - z{i} * z{i}' for i in k)})) AS rss,
                CASE WHEN v{last} > 0 THEN q{last} * q{last} / (n_obs * v{last}) END AS last_scale FROM {name}_{len(levels)})""")


DRIVER_TERMS = ["rig_z", "lpa_pct_z"]


def arma_sql(source: str, keys: str, drivers=("rig_z", "lpa_pct_z")) -> tuple[str, ...]:
    """CTEs of the two regressions, the innovations and the criteria of every group of ``source``
    (training rows with lags); the last one is ``fits``."""
    same = lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in keys.split(", "))
    with_fit = lambda f, terms: "".join(f" - {f}.b_{x} * r.{x}" for x in terms)
    short = ["d_lag1", "d_season", *(f"d_{c}" for c in drivers)]
    long, k = ["d_lag1", "d_lag2", "d_lag3", *short[1:]], len(short) + 2
    known = " AND ".join(f"{c} IS NOT NULL" for c in ("d", *short))
    return (
        *ols_sql("long_fit", source, keys, "d", long),
        f"""resid AS MATERIALIZED (SELECT r.*, lag(r.d - f.b_const{with_fit('f', long)}) OVER (PARTITION BY {', '.join('r.' + c for c in keys.split(', '))}
                                                                                 ORDER BY r.t) AS e_lag1
                      FROM {source} r JOIN long_fit f ON {same('r', 'f')})""",
        *ols_sql("short_fit", "resid", keys, "d", [*short, "e_lag1"]),
        """ma_fit AS (SELECT * REPLACE (least(greatest(b_e_lag1, -0.98), 0.98) AS b_e_lag1) FROM short_fit)""",
        f"""u AS (SELECT {', '.join('r.' + c for c in keys.split(', '))}, f.b_e_lag1 AS ma, r.d - f.b_const{with_fit('f', short)} AS u,
                         row_number() OVER (PARTITION BY {', '.join('r.' + c for c in keys.split(', '))} ORDER BY r.t) AS i
                  FROM (SELECT * FROM {source} WHERE {known}) r JOIN ma_fit f ON {same('r', 'f')})""",
        f"""e AS (SELECT {', '.join('a.' + c for c in keys.split(', '))}, a.i, sum(pow(-a.ma, a.i - b.i) * b.u) AS e
                  FROM u a JOIN u b ON {same('a', 'b')} AND b.i <= a.i GROUP BY ALL)""",
        f"""fits0 AS (SELECT {keys}, count(*) AS n, sum(e * e) AS css, max_by(e, i) AS last_e FROM e GROUP BY {keys})""",
        f"""fits AS (SELECT f.* EXCLUDE (n_obs, rss), x.n AS n_obs, x.last_e, sqrt(x.css / (x.n - {k})) AS sigma,
                            x.n * (ln(2 * pi() * x.css / x.n) + 1) + {2.0 * (k + 1)} AS aic,
                            x.n * (ln(2 * pi() * x.css / x.n) + 1) + ln(x.n) * {k + 1} AS bic
                     FROM ma_fit f JOIN fits0 x ON {same('f', 'x')} WHERE f.n_obs > {k})""")


def lags_sql(name: str, source: str, drivers=("rig_z", "lpa_pct_z")) -> tuple[str, str]:
    """CTEs ``<name>_d`` and ``<name>``: seasonal differences and their lags."""
    w = "OVER (PARTITION BY series ORDER BY month)"
    return (f"""{name}_d AS (SELECT *, lag(y, 12) {w} AS before, y - lag(y, 12) {w} AS d,
                                    {', '.join(f'{c} - lag({c}, 12) {w} AS d_{c}' for c in drivers)} FROM {source})""",
            f"""{name} AS MATERIALIZED (SELECT *, lag(d) {w} AS d_lag1, lag(d, 2) {w} AS d_lag2, lag(d, 3) {w} AS d_lag3, lag(d, 12) {w} AS d_season
                           FROM {name}_d)""")


def ahead_sql(source: str, keys: str, drivers=("rig_z", "lpa_pct_z")) -> tuple[str, ...]:
    """CTE ``ahead``: forecasts of the rows of ``source`` (h, last_d and lags) with their groups' fits."""
    same = lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in keys.split(", "))
    return (
        f"""w AS (SELECT r.*, f.b_d_lag1 AS ar, f.b_e_lag1 AS ma, f.sigma, f.aic, f.bic,
                         f.b_const + f.b_d_season * r.d_season{''.join(f' + f.b_d_{c} * r.d_{c}' for c in drivers)}
                         + CASE WHEN r.h = 1 THEN f.b_e_lag1 * f.last_e ELSE 0.0 END AS w
                  FROM {source} r JOIN fits f ON {same('r', 'f')})""",
        f"""steps AS (SELECT {', '.join('a.' + c for c in keys.split(', '))}, a.h, sum(pow(a.ar, a.h - b.h) * b.w) AS moved,
                             1 + sum(CASE WHEN b.h < a.h THEN pow((a.ar + a.ma) * pow(a.ar, b.h - 1), 2) ELSE 0.0 END) AS psi2
                      FROM w a JOIN w b ON {same('a', 'b')} AND b.h <= a.h GROUP BY ALL)""",
        f"""ahead AS (SELECT w.*, before + pow(ar, w.h) * last_d + moved AS raw, 1.645 * sigma * sqrt(psi2) AS half
                      FROM w JOIN steps ON {same('w', 'steps')} AND w.h = steps.h)""")


def _series_sql(body: str, *more: str) -> str:
    return with_trade(body, *DRIVER_SQL, *PANEL_SQL, *more)


def _rounded_effects(df):
    lagged = F.col("term").isin("ar1", "sar12", "ma1")
    return df.select("series", "term", F.when(lagged, fround("coef", 6)).otherwise(fround("coef", 2)).alias("coef"),
                     fround("sigma", 2).alias("sigma"), "n_obs")


@register("arx_forecast", _series_sql("""
SELECT s.series, a.h, a.month, round(greatest(a.raw, 0.0), 2) AS yhat, round(greatest(a.raw - a.half, 0.0), 2) AS yhat_lo,
       round(greatest(a.raw + a.half, 0.0), 2) AS yhat_hi, round(a.ma, 6) AS ma1, round(a.aic, 4) AS aic, round(a.bic, 4) AS bic,
       CASE WHEN a.h IS NULL THEN 'skipped' ELSE 'ok' END AS status
FROM (SELECT DISTINCT series FROM panel) s LEFT JOIN ahead a ON a.series = s.series""",
    """future AS (SELECT series, CAST(month + to_months(CAST(h AS INTEGER)) AS DATE) AS month, CAST(NULL AS DOUBLE) AS y, rig_z, lpa_pct_z, h
                  FROM (SELECT * FROM panel WHERE t = n - 1) l, (SELECT CAST(unnest(generate_series(1, 6)) AS INTEGER) AS h) hh)""",
    """longer AS (SELECT series, month, y, rig_z, lpa_pct_z, CAST(NULL AS INTEGER) AS h FROM panel WHERE n >= 36
                  UNION ALL SELECT * FROM future WHERE series IN (SELECT series FROM panel WHERE n >= 36))""",
    *lags_sql("lagged", "longer"),
    """known AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY month) AS t FROM lagged WHERE h IS NULL)""",
    *arma_sql("known", "series"),
    """next AS (SELECT l.*, x.last_d FROM lagged l JOIN (SELECT series, max_by(d, month) AS last_d FROM known GROUP BY 1) x
                USING (series) WHERE l.h IS NOT NULL)""",
    *ahead_sql("next", "series")), ids=("W-9", "W-12"))
def arx_forecast(spark, sf_dir):
    f = FC.arx_forecast(arx_panel(spark, sf_dir), DRIVER_TERMS, ARX_PARAMS)
    return f.select("series", "h", "month", *[fround(c, 2).alias(c) for c in ("yhat", "yhat_lo", "yhat_hi")],
                    fround("ma1", 6).alias("ma1"), *[fround(c, 4).alias(c) for c in ("aic", "bic")], "status")


FOLD_SQL = (
    *lags_sql("lagged", "panel"),
    """cuts2 AS (SELECT series, CAST(unnest(generate_series(48, max(n) - 6, 6)) AS INTEGER) AS cut FROM panel GROUP BY series)""",
    """train AS (SELECT l.*, c.cut FROM lagged l JOIN cuts2 c USING (series) WHERE l.t < c.cut)""",
    *arma_sql("train", "series, cut"),
    """next AS (SELECT l.*, c.cut, CAST(l.t - c.cut + 1 AS INTEGER) AS h, x.last_d FROM lagged l JOIN cuts2 c USING (series)
                JOIN (SELECT series, cut, max_by(d, t) AS last_d FROM train GROUP BY 1, 2) x ON x.series = c.series AND x.cut = c.cut
                WHERE l.t BETWEEN c.cut AND c.cut + 5)""",
    *ahead_sql("next", "series, cut"),
    """scored AS (SELECT c.series, c.cut, a.h, a.y, greatest(a.raw, 0.0) AS yhat, CASE WHEN a.h IS NULL THEN 'failed' ELSE 'ok' END AS status
                  FROM cuts2 c LEFT JOIN ahead a ON a.series = c.series AND a.cut = c.cut)""",
)


@register("arx_cv", _series_sql("""
SELECT series, cut, h, round(y, 2) AS y, round(yhat, 2) AS yhat, status FROM scored""", *FOLD_SQL), ids=("W-10",))
def arx_cv(spark, sf_dir):
    f = FC.arx_cv(arx_panel(spark, sf_dir), DRIVER_TERMS, ARX_PARAMS)
    return f.select("series", "cut", "h", fround("y", 2).alias("y"), fround("yhat", 2).alias("yhat"), "status")


@register("arx_effects", _series_sql("""
SELECT s.series, coalesce(l.term, 'skipped') AS term,
       CASE WHEN l.term IN ('ar1', 'sar12', 'ma1') THEN round(l.coef, 6) ELSE round(l.coef, 2) END AS coef,
       round(l.sigma, 2) AS sigma, l.n_obs
FROM (SELECT DISTINCT series FROM panel) s LEFT JOIN (
  SELECT series, unnest(['const', 'ar1', 'sar12', 'ma1', 'rig_z', 'lpa_pct_z']) AS term,
         unnest([b_const, b_d_lag1, b_d_season, b_e_lag1, b_d_rig_z, b_d_lpa_pct_z]) AS coef, sigma, CAST(n_obs AS INTEGER) AS n_obs
  FROM fits) l ON l.series = s.series""", *lags_sql("lagged", "panel"), *arma_sql("lagged", "series")), ids=("W-14",))
def arx_effects(spark, sf_dir):
    return _rounded_effects(FC.arx_effects(arx_panel(spark, sf_dir), DRIVER_TERMS, ARX_PARAMS))


@register("adf_stat", _series_sql("""
SELECT s.series, round(CASE WHEN n_obs > 4 AND rss > 0 THEN b_level / sqrt(rss / (n_obs - 3) * last_scale) END, 6) AS adf_stat,
       coalesce(n_obs, 0) AS n_obs, 1 AS lags, -2.86::DOUBLE AS critical_5pct,
       CASE WHEN n_obs > 4 AND rss > 0 THEN b_level / sqrt(rss / (n_obs - 3) * last_scale) END < -2.86 AS stationary
FROM (SELECT DISTINCT series FROM panel) s LEFT JOIN adf ON adf.series = s.series""",
    """lev AS (SELECT *, lag(y) OVER (PARTITION BY series ORDER BY month) AS level, y - lag(y) OVER (PARTITION BY series ORDER BY month) AS dy
               FROM panel)""",
    """dys AS (SELECT *, lag(dy) OVER (PARTITION BY series ORDER BY month) AS dy_lag1 FROM lev)""",
    *ols_sql("adf", "dys", "series", "dy", ["dy_lag1", "level"])), ids=("W-8",))
def adf_stat(spark, sf_dir):
    a = FC.adf_test(arx_panel(spark, sf_dir), lags=ARX_PARAMS.adf_lags)
    return a.select("series", fround("adf_stat", 6).alias("adf_stat"), "n_obs", "lags", "critical_5pct", "stationary")


# --- scenarios on the total series with the weekly driver -----------------------------

def scenario_base(spark, sf_dir):
    """12 future months: seasonal-naive base + linear driver effect.

    effect = slope(total ~ rig) x mean rig of the last 12 months, so a
    scenario of s % on the driver moves the month by effect x s / 100."""
    tot = S.monthly_totals(trade(spark, sf_dir), [])
    j = tot.join(weekly_monthly(spark, sf_dir).select("month", "rig"), "month")
    last = tot.agg(F.max("month").alias("__lm"))
    recent = j.crossJoin(F.broadcast(last)).filter(
        F.col("month") > F.add_months(F.col("__lm"), -12))
    coef = j.agg(F.regr_slope("total", "rig").alias("__slope"))
    rb = recent.agg(F.avg("rig").alias("__rig_base"))
    base = recent.select(F.add_months("month", 12).alias("month"), F.col("total").alias("base"))
    return (base.crossJoin(F.broadcast(coef)).crossJoin(F.broadcast(rb))
                .select("month", "base", (F.col("__slope") * F.col("__rig_base")).alias("effect")))


SCEN_SQL = (
    """tot AS (SELECT shipment_date AS month, CAST(sum(value) AS DOUBLE) AS total FROM trade GROUP BY 1)""",
    """j AS (SELECT tot.month, total, rig FROM tot JOIN aligned USING (month))""",
    """lm AS (SELECT max(month) AS lm FROM tot)""",
    """recent AS (SELECT j.* FROM j, lm WHERE j.month > lm.lm - INTERVAL 12 MONTH)""",
    """base AS (SELECT CAST(month + INTERVAL 12 MONTH AS DATE) AS month, total AS base,
                       (SELECT regr_slope(total, rig) FROM j) * (SELECT avg(rig) FROM recent) AS effect
                FROM recent)""",
    """grid AS (SELECT CAST(s AS INTEGER) AS scenario_pct, month,
                       greatest(base + effect * CAST(s AS INTEGER) / 100.0, 0.0) AS yhat
                FROM base CROSS JOIN (SELECT unnest(generate_series(-40, 40, 5)) AS s) lv)""",
)


@register("scenario_grid", with_trade("""
SELECT scenario_pct, month, round(yhat, 2) AS yhat FROM grid""", *DRIVER_SQL, *SCEN_SQL),
          ids=("J-13", "W-13"))
def scenario_grid(spark, sf_dir):
    g = FC.scenario_grid(scenario_base(spark, sf_dir), SCENARIO_LEVELS)
    return g.select("scenario_pct", "month", fround("yhat", 2).alias("yhat"))


@register("scenario_swing", with_trade("""
SELECT scenario_pct, round(total, 2) AS total, round(total - base_total, 2) AS vs_base, round(swing, 2) AS swing
FROM (SELECT scenario_pct, sum(yhat) AS total FROM grid GROUP BY 1) t
CROSS JOIN (SELECT sum(CASE WHEN scenario_pct = 0 THEN yhat END) AS base_total,
                   sum(CASE WHEN scenario_pct = 30 THEN yhat END) - sum(CASE WHEN scenario_pct = -30 THEN yhat END) AS swing
            FROM grid) r""", *DRIVER_SQL, *SCEN_SQL), ids=("J-15", "W-13"))
def scenario_swing(spark, sf_dir):
    g = FC.scenario_grid(scenario_base(spark, sf_dir), SCENARIO_LEVELS)
    sw = FC.scenario_swing(g)
    return sw.select("scenario_pct", fround("total", 2).alias("total"),
                     fround("vs_base", 2).alias("vs_base"), fround("swing", 2).alias("swing"))


@register("arx_cv_metrics", _series_sql("""
SELECT s.series, round(avg(abs(y - yhat) / greatest(y, 1.0)) FILTER (status = 'ok') * 100, 4) AS mape,
       round(sqrt(avg((y - yhat) * (y - yhat)) FILTER (status = 'ok')), 2) AS rmse,
       nullif(count(*) FILTER (status = 'ok'), 0) AS n_points,
       avg(abs(y - yhat) / greatest(y, 1.0)) FILTER (status = 'ok') * 100 < 20.0 AS passed,
       count(*) FILTER (status <> 'ok') AS failed_folds
FROM scored s GROUP BY s.series""", *FOLD_SQL), ids=("W-10", "W-11"))
def arx_cv_metrics(spark, sf_dir):
    """W-11 on the folds of the model: MAPE / RMSE / pass flag per series, failed folds
    counted separately (never silently dropped)."""
    folds = FC.arx_cv(arx_panel(spark, sf_dir), DRIVER_TERMS, ARX_PARAMS)
    ok = folds.filter(F.col("status") == "ok")
    failed = (folds.groupBy("series")
                   .agg(F.count_if(F.col("status") != "ok").alias("failed_folds")))
    m = FC.cv_metrics(ok, ["series"]).join(failed, "series", "right")
    return m.select("series", fround("mape", 4).alias("mape"), fround("rmse", 2).alias("rmse"), "n_points", "passed", "failed_folds")


# --- scenarios of the fitted model, with intervals ------------------------------------

SCEN_PARAMS = ForecastParams(horizon=12)


@register("scenario_intervals", with_trade("""
SELECT lv.s AS scenario_pct, a.h, a.month, round(greatest(m, 0.0), 2) AS yhat, round(greatest(m - half, 0.0), 2) AS yhat_lo,
       round(greatest(m + half, 0.0), 2) AS yhat_hi
FROM (SELECT ahead.*, f.b_d_rig AS b, l.rig AS x FROM ahead, fits f, (SELECT * FROM panel WHERE t = n - 1) l) a,
     (SELECT CAST(unnest(generate_series(-40, 40, 5)) AS INTEGER) AS s) lv,
     LATERAL (SELECT a.raw + a.b * a.x * lv.s / 100.0 * list_sum(list_transform(range(a.h), lambda i: pow(a.ar, i))) AS m)""",
    *DRIVER_SQL, SCEN_SQL[0],
    """panel AS (SELECT 'all' AS series, month, total AS y, rig, row_number() OVER (ORDER BY month) - 1 AS t, count(*) OVER () AS n
                 FROM tot JOIN aligned USING (month))""",
    """longer AS (SELECT series, month, y, rig, CAST(NULL AS INTEGER) AS h FROM panel
                  UNION ALL SELECT series, CAST(month + to_months(CAST(i AS INTEGER)) AS DATE), NULL, rig, CAST(i AS INTEGER)
                            FROM (SELECT * FROM panel WHERE t = n - 1) l, (SELECT unnest(generate_series(1, 12)) AS i) hh)""",
    *lags_sql("lagged", "longer", ("rig",)),
    """known AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY month) AS t FROM lagged WHERE h IS NULL)""",
    *arma_sql("known", "series", ("rig",)),
    """next AS (SELECT l.*, x.last_d FROM lagged l JOIN (SELECT series, max_by(d, month) AS last_d FROM known GROUP BY 1) x
                USING (series) WHERE l.h IS NOT NULL)""",
    *ahead_sql("next", "series", ("rig",))), ids=("W-13", "J-13"))
def scenario_intervals(spark, sf_dir):
    tot = S.monthly_totals(trade(spark, sf_dir), [])
    panel = tot.join(weekly_monthly(spark, sf_dir).select("month", "rig"), "month").select(
        F.lit("all").alias("series"), "month", F.col("total").alias("y"), "rig")
    g = FC.scenario_forecast(panel, "rig", SCENARIO_LEVELS, SCEN_PARAMS)
    return g.select("scenario_pct", "h", "month", *[fround(c, 2).alias(c) for c in ("yhat", "yhat_lo", "yhat_hi")])
