"""Risk scoring bound to the test tables: key = buyer (customer).

Early years 1995-1996 vs late years 1999-2000 (2001 is partial, like the
reference's last year); at least 6 active months to be scored.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tradelens.functions.numeric import fround
from tradelens.operators import clean as C
from tradelens.operators import risk as K
from tradelens.params import RiskParams
from tradelens.plans.registry import register
from tradelens.sources.tables import read_table, trade, with_trade

PARAMS = RiskParams(early_years=(1995, 1996), late_years=(1999, 2000))
FX = 83.0


def _base(spark, sf_dir):
    t = trade(spark, sf_dir).select("buyer", "shipment_date", "value", "value_units", "qty",
                                    "product")
    t = C.with_unit_price(t, "value", "qty", out="price")
    return C.flag_outliers(t, "product", "price")


def signals(spark, sf_dir):
    return K.risk_signals(_base(spark, sf_dir), "buyer", "shipment_date", "value", "price",
                          "product", "is_outlier", PARAMS)


def scores(spark, sf_dir):
    return K.risk_scores(signals(spark, sf_dir), PARAMS)


def bands(spark, sf_dir):
    return K.risk_bands(scores(spark, sf_dir), PARAMS)


SIG_SQL = (
    """base AS (SELECT buyer AS key, shipment_date, value, product,
                      round(CAST(value AS DOUBLE) / qty, 4) AS price FROM trade)""",
    """thr AS (SELECT product, CASE WHEN count(*) >= 20 THEN quantile_cont(price, 0.99) END AS t
              FROM base GROUP BY product)""",
    """b2 AS (SELECT base.*, coalesce(price > thr.t, false) AS is_outlier FROM base JOIN thr USING (product))""",
    """monthly AS (
  SELECT key, shipment_date AS ym, sum(value) AS m_value,
         CAST(sum(CAST(price AS DECIMAL(18,4))) AS DOUBLE) / count(price) AS m_price,
         count(*) AS n, count_if(is_outlier) AS n_out,
         sum(CASE WHEN year(shipment_date) IN (1995, 1996) THEN value END) AS early_part,
         sum(CASE WHEN year(shipment_date) IN (1999, 2000) THEN value END) AS late_part,
         count_if(year(shipment_date) IN (1995, 1996, 1999, 2000)) AS n_trend_rows
  FROM b2 GROUP BY 1, 2)""",
    """pk AS (
  SELECT key, count(*) AS active_months, stddev_samp(m_price) AS sd_p, avg(m_price) AS mu_p,
         stddev_samp(CAST(m_value AS DOUBLE)) AS sd_v, CAST(sum(m_value) AS DOUBLE) / count(m_value) AS mu_v,
         sum(early_part) AS early, sum(late_part) AS late, sum(n_trend_rows) AS n_trend,
         CAST(sum(n_out) AS DOUBLE) / sum(n) AS outlier_rate, CAST(sum(m_value) AS DOUBLE) AS total_value
  FROM monthly GROUP BY key)""",
    """np AS (SELECT buyer AS key, count(DISTINCT product) AS n_products FROM trade GROUP BY 1)""",
    """sig AS (
  SELECT pk.key, active_months, total_value,
         CASE WHEN n_trend > 0 THEN 1.0 / (coalesce(CAST(late AS DOUBLE) / nullif(CAST(early AS DOUBLE), 0), 0.0) + 0.01) END
           AS revenue_trend,
         CASE WHEN mu_p IS NULL OR mu_p <= 0 THEN 0.0 ELSE coalesce(sd_p / mu_p, 0.0) END AS price_volatility,
         CASE WHEN mu_v IS NULL OR mu_v <= 0 THEN 0.0 ELSE coalesce(sd_v / mu_v, 0.0) END AS shipment_irregular,
         1.0 / n_products AS hs_concentration, coalesce(outlier_rate, 0.0) AS outlier_rate
  FROM pk JOIN np USING (key) WHERE active_months >= 6)""",
)


def _scaled(c):
    return (f"CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 5.0 "
            f"ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) * 10 END")


_W = dict(PARAMS.weights)
SCORE_SQL = (
    f"""sc0 AS (SELECT key, active_months, total_value,
                      {", ".join(f"{_scaled(c)} AS {c}_scaled" for c in K.SIGNALS)}
               FROM sig)""",
    f"""sc AS (SELECT *, round(least(greatest(0 + {" + ".join(f"{c}_scaled * {_W[c]}" for c in K.SIGNALS)}, 1.0), 10.0), 2)
                      AS risk_score FROM sc0)""",
    """bd AS (SELECT sc.*, q.p60, q.p85,
                     CASE WHEN risk_score < q.p60 THEN 'Low' WHEN risk_score <= q.p85 THEN 'Medium'
                          WHEN risk_score IS NOT NULL THEN 'High' END AS risk_band
              FROM sc CROSS JOIN (SELECT quantile_cont(risk_score, 0.6) AS p60,
                                         quantile_cont(risk_score, 0.85) AS p85 FROM sc) q)""",
)


@register("risk_signals", with_trade(f"""
SELECT key, active_months, {", ".join(f"round({c}, 6) AS {c}" for c in K.SIGNALS)} FROM sig""",
    *SIG_SQL), ids=("A-18", "A-19", "A-20", "J-6"))
def risk_signals(spark, sf_dir):
    s = signals(spark, sf_dir)
    return s.select("key", "active_months", *[fround(c, 6).alias(c) for c in K.SIGNALS])


@register("risk_scores", with_trade(f"""
SELECT key, {", ".join(f"round({c}_scaled, 6) AS {c}_scaled" for c in K.SIGNALS)}, risk_score FROM sc""",
    *SIG_SQL, *SCORE_SQL), ids=("A-21", "A-22"))
def risk_scores(spark, sf_dir):
    s = scores(spark, sf_dir)
    return s.select("key", *[fround(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in K.SIGNALS],
                    "risk_score")


@register("risk_bands", with_trade("""
SELECT key, risk_score, risk_band, round(p60, 6) AS p60, round(p85, 6) AS p85 FROM bd""",
    *SIG_SQL, *SCORE_SQL), ids=("A-22",))
def risk_bands(spark, sf_dir):
    b = bands(spark, sf_dir)
    return b.select("key", "risk_score", "risk_band", fround("p60", 6).alias("p60"),
                    fround("p85", 6).alias("p85"))


@register("risk_exposure", with_trade(f"""
SELECT (SELECT count(*) FROM bd WHERE risk_band = 'High') AS n_high,
       (SELECT CAST(sum(CAST(round(total_value * {FX} / 1e7, 1) AS DECIMAL(20,1))) AS DOUBLE) FROM bd WHERE risk_band = 'High') AS all_high_inr_cr,
       count(*) AS n_top, CAST(sum(CAST(round(total_value * {FX} / 1e7, 1) AS DECIMAL(20,1))) AS DOUBLE) AS top_n_inr_cr
FROM (SELECT * FROM bd WHERE risk_band = 'High' ORDER BY total_value DESC, key LIMIT 15)""",
    *SIG_SQL, *SCORE_SQL), ids=("A-23", "L-3"))
def risk_exposure(spark, sf_dir):
    e = K.exposure(bands(spark, sf_dir), FX, PARAMS.exposure_top_n)
    return e.select("n_high", "all_high_inr_cr", "n_top", "top_n_inr_cr")


@register("top_risk_signals", with_trade(f"""
SELECT key, risk_score, risk_band, {", ".join(f"round({c}_scaled, 6) AS {c}_scaled" for c in K.SIGNALS)}
FROM bd ORDER BY risk_score DESC, key LIMIT 25""", *SIG_SQL, *SCORE_SQL), ids=("L-3",))
def top_risk_signals(spark, sf_dir):
    b = bands(spark, sf_dir).orderBy(F.col("risk_score").desc(), F.col("key")).limit(25)
    return b.select("key", "risk_score", "risk_band",
                    *[fround(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in K.SIGNALS])


@register("band_counts", with_trade("""
SELECT risk_band, count(*) AS n FROM bd GROUP BY risk_band""", *SIG_SQL, *SCORE_SQL),
          ids=("A-24",))
def band_counts(spark, sf_dir):
    from tradelens.operators.marts import value_counts
    return value_counts(bands(spark, sf_dir), "risk_band")


@register("relabel_by_key", with_trade("""
SELECT bd.key, c.c_name AS name, bd.risk_score, bd.risk_band, bd.total_value, bd.active_months
FROM bd LEFT JOIN customer c ON c.c_custkey = bd.key""", *SIG_SQL, *SCORE_SQL), ids=("J-7",))
def relabel_by_key(spark, sf_dir):
    names = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"),
                                                          F.col("c_name").alias("name"))
    b = bands(spark, sf_dir)
    return (b.join(names, "key", "left")
             .select("key", "name", "risk_score", "risk_band", "total_value", "active_months"))


@register("risk_signal_matrix", with_trade(f"""
SELECT key, active_months, round(total_value, 4) AS total_value,
       {", ".join(f"round({c}, 6) AS {c}" for c in K.SIGNALS)}
FROM sig
WHERE NOT ({" AND ".join(f"{c} IS NULL" for c in K.SIGNALS)})""", *SIG_SQL), ids=("J-6", "J-5"))
def risk_signal_matrix(spark, sf_dir):
    """J-6: the five signals aligned per qualified key in ONE conditional
    aggregate (no per-signal frames to join), rows with every signal
    missing dropped (dropna(how='all'))."""
    s = signals(spark, sf_dir)
    all_null = None
    for c in K.SIGNALS:
        cond = F.col(c).isNull()
        all_null = cond if all_null is None else (all_null & cond)
    return (s.filter(~all_null)
             .select("key", "active_months", fround("total_value", 4).alias("total_value"),
                     *[fround(c, 6).alias(c) for c in K.SIGNALS]))


@register("risk_score_describe", with_trade("""
SELECT count(risk_score) AS count, round(avg(risk_score), 6) AS mean,
       round(stddev_samp(risk_score), 6) AS std, min(risk_score) AS min,
       round(quantile_cont(risk_score, 0.25), 6) AS p25, round(quantile_cont(risk_score, 0.5), 6) AS p50,
       round(quantile_cont(risk_score, 0.75), 6) AS p75, max(risk_score) AS max
FROM sc""", *SIG_SQL, *SCORE_SQL), ids=("A-24",))
def risk_score_describe(spark, sf_dir):
    from tradelens.operators.marts import describe
    d = describe(scores(spark, sf_dir), "risk_score")
    return d.select("count", *[fround(c, 6).alias(c) for c in ("mean", "std")], "min",
                    *[fround(c, 6).alias(c) for c in ("p25", "p50", "p75")], "max")
