"""Seasonality queries on the trade fact (A-4, A-9, A-10, W-3, W-6, W-7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradelens.functions.numeric import fround

from tradelens.operators import seasonality as S
from tradelens.plans.registry import register
from tradelens.sources.tables import trade, with_trade

SEGMENT_A = ("ECONOMY", "SMALL", "MEDIUM")  # stand-in for the handicraft set


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


MONTHLY_CTE = """
m AS (SELECT product, shipment_date AS month, sum(value) AS total
      FROM trade GROUP BY product, shipment_date)"""


def xmean(expr: str) -> str:
    """SQL twin of ``exact_mean``: exact decimal sum, one double division."""
    return f"(CAST(sum({expr}) AS DOUBLE) / count({expr}))"


PEAK = xmean("CASE WHEN month(month) IN (9,10,11) THEN total END")
ALLM = xmean("total")


@register("peak_premium", with_trade(f"""
SELECT product, round({PEAK}, 4) AS peak_mean,
       round({ALLM}, 4) AS annual_mean, count(*) AS n_months,
       round({PEAK} / {ALLM} - 1, 6) AS premium
FROM m GROUP BY product""", MONTHLY_CTE), ids=("A-4", "A-9"))
def peak_premium(spark, sf_dir):
    out = S.peak_premium(trade(spark, sf_dir), ["product"])
    return out.select("product", fround("peak_mean", 4).alias("peak_mean"),
                      fround("annual_mean", 4).alias("annual_mean"), "n_months",
                      fround("premium", 6).alias("premium"))


@register("peak_premium_rollup", with_trade(f"""
SELECT segment,
       round({PEAK}, 4) AS peak_mean,
       round({ALLM}, 4) AS annual_mean,
       round({PEAK} / {ALLM} - 1, 6) AS premium
FROM (
  SELECT CASE WHEN product IN ({_in(SEGMENT_A)}) THEN 'SEGMENT_A' ELSE 'SEGMENT_B' END AS segment,
         shipment_date AS month, sum(value) AS total
  FROM trade GROUP BY 1, 2
  UNION ALL
  SELECT 'ALL', shipment_date, sum(value) FROM trade GROUP BY 2
) GROUP BY segment"""), ids=("A-9",))
def peak_premium_rollup(spark, sf_dir):
    seg = F.when(F.col("product").isin(list(SEGMENT_A)), "SEGMENT_A").otherwise("SEGMENT_B")
    out = S.peak_premium_rollup(trade(spark, sf_dir), seg)
    return out.select("segment", fround("peak_mean", 4).alias("peak_mean"),
                      fround("annual_mean", 4).alias("annual_mean"),
                      fround("premium", 6).alias("premium"))


@register("peak_premium_by_year", with_trade(f"""
SELECT CAST(year(month) AS INTEGER) AS year,
       round(coalesce(CAST(sum(CASE WHEN month(month) IN (9,10,11) THEN total END) AS DOUBLE), 0.0) / 3.0, 4)
         AS peak_mean,
       round({xmean("CASE WHEN total > 0 THEN total END")}, 4) AS annual_mean,
       round(coalesce(CAST(sum(CASE WHEN month(month) IN (9,10,11) THEN total END) AS DOUBLE), 0.0) / 3.0
             / {xmean("CASE WHEN total > 0 THEN total END")} - 1, 6) AS premium
FROM (SELECT shipment_date AS month, sum(value) AS total FROM trade GROUP BY 1)
GROUP BY year(month) HAVING sum(total) <> 0"""), ids=("A-10",))
def peak_premium_by_year(spark, sf_dir):
    out = S.peak_premium_by_year(trade(spark, sf_dir))
    return out.select("year", fround("peak_mean", 4).alias("peak_mean"),
                      fround("annual_mean", 4).alias("annual_mean"),
                      fround("premium", 6).alias("premium"))


@register("monthly_total", with_trade("""
SELECT shipment_date AS month, CAST(sum(value) AS DOUBLE) AS total,
       CAST(coalesce(sum(CASE WHEN product IN ('ECONOMY','SMALL','MEDIUM') THEN value END), 0)
            AS DOUBLE) AS segment_a_total
FROM trade GROUP BY shipment_date"""), ids=("A-4",))
def monthly_total(spark, sf_dir):
    t = trade(spark, sf_dir)
    return (t.groupBy(F.col("shipment_date").alias("month"))
             .agg(F.sum("value").cast("double").alias("total"),
                  F.coalesce(F.sum(F.when(F.col("product").isin(list(SEGMENT_A)),
                                          F.col("value"))),
                             F.lit(0)).cast("double").alias("segment_a_total")))


@register("monthly_total_stats", with_trade("""
SELECT count(*) AS n_months, round(avg(total), 4) AS mean_total,
       round(stddev_samp(total), 4) AS std_total
FROM (SELECT shipment_date, CAST(sum(value) AS DOUBLE) AS total FROM trade GROUP BY 1)"""),
          ids=("A-4",))
def monthly_total_stats(spark, sf_dir):
    m = S.monthly_totals(trade(spark, sf_dir), [])
    return m.agg(F.count("*").alias("n_months"),
                 fround(F.avg("total"), 4).alias("mean_total"),
                 fround(F.stddev_samp("total"), 4).alias("std_total"))


DENSE_BRAND_CTES = (
    """m AS (SELECT brand, market, shipment_date AS month, CAST(sum(value) AS DOUBLE) AS total
            FROM trade GROUP BY 1, 2, 3)""",
    """b AS (SELECT brand, market, min(month) AS lo, max(month) AS hi FROM m GROUP BY 1, 2)""",
    """g AS (SELECT brand, market,
                   CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                               INTERVAL 1 MONTH)) AS DATE) AS month FROM b)""",
)


@register("series_densify", with_trade("""
SELECT g.brand, g.market, g.month, coalesce(m.total, 0.0) AS total
FROM g LEFT JOIN m USING (brand, market, month)""", *DENSE_BRAND_CTES), ids=("W-3",))
def series_densify(spark, sf_dir):
    t = trade(spark, sf_dir)
    m = S.monthly_totals(t, ["brand", "market"])
    return S.densify_monthly(m, ["brand", "market"]).select("brand", "market", "month", "total")


DECOMP_CTE = """
m0 AS (SELECT product, shipment_date AS month, CAST(sum(value) AS DOUBLE) AS total
       FROM trade GROUP BY 1, 2),
b AS (SELECT product, min(month) AS lo, max(month) AS hi FROM m0 GROUP BY 1),
g AS (SELECT product, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                                  INTERVAL 1 MONTH)) AS DATE) AS month FROM b),
m AS (SELECT g.product, g.month, coalesce(m0.total, 0.0) AS total
      FROM g LEFT JOIN m0 USING (product, month)),
s AS (SELECT product, month, total,
        CAST(datediff('month', min(month) OVER (PARTITION BY product), month) AS INTEGER) % 12 AS pos,
        CASE WHEN count(total) OVER (PARTITION BY product ORDER BY month
                                     ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13
             THEN (avg(total) OVER (PARTITION BY product ORDER BY month ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)
                 + avg(total) OVER (PARTITION BY product ORDER BY month ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING)) / 2
        END AS trend
      FROM m),
p AS (SELECT product, pos, avg(total - trend) AS pos_mean FROM s GROUP BY 1, 2),
c AS (SELECT product, pos, pos_mean - avg(pos_mean) OVER (PARTITION BY product) AS seasonal FROM p),
d AS (SELECT s.product, s.month, s.total, s.trend, c.seasonal,
             s.total - s.trend - c.seasonal AS resid
      FROM s JOIN c USING (product, pos))"""


@register("seasonal_decompose", with_trade("""
SELECT product, month, total, round(trend, 4) AS trend, round(seasonal, 4) AS seasonal,
       round(resid, 4) AS resid FROM d""", DECOMP_CTE), ids=("W-6",))
def seasonal_decompose(spark, sf_dir):
    m = S.monthly_totals(trade(spark, sf_dir), ["product"])
    d = S.seasonal_decompose(S.densify_monthly(m, ["product"]), ["product"])
    return d.select("product", "month", "total", fround("trend", 4).alias("trend"),
                    fround("seasonal", 4).alias("seasonal"), fround("resid", 4).alias("resid"))


@register("seasonal_profile", with_trade("""
SELECT product, month_of_year, round(seasonal_mean, 4) AS seasonal_mean,
       round(avg(CASE WHEN month_of_year IN (9,10,11) THEN seasonal_mean END)
             OVER (PARTITION BY product), 4) AS peak_lift
FROM (SELECT product, CAST(month(month) AS INTEGER) AS month_of_year, avg(seasonal) AS seasonal_mean
      FROM d GROUP BY 1, 2)""", DECOMP_CTE), ids=("W-7",))
def seasonal_profile(spark, sf_dir):
    m = S.monthly_totals(trade(spark, sf_dir), ["product"])
    d = S.seasonal_decompose(S.densify_monthly(m, ["product"]), ["product"])
    p = S.seasonal_profile(d, ["product"])
    return p.select("product", "month_of_year", fround("seasonal_mean", 4).alias("seasonal_mean"),
                    fround("peak_lift", 4).alias("peak_lift"))
