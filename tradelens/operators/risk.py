"""Five-signal risk scoring with percentile bands.

IDs: A-18..A-23, J-6, J-7, L-3, A-24, K-5.

Plan: ONE scan of the fact, then aggregates of shrinking grain.
  1. (key, month, product) hash aggregate with fixed-width buffers only
     (money and prices as exact LONG units): value, price sums, row and
     outlier counts, early/late-year sums.  Partial aggregation makes hot
     keys cheap.
  2. (key, month) from (1): monthly value and exact mean price.
  3. key from (2): CVs, active months, outlier rate, trend ratio; distinct
     products come from (1)'s (key, product) pairs -- no collect_set.
Global scaling (min/max) and the p60/p85 band thresholds are 1-row
aggregates attached by broadcast (never an unpartitioned window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.functions.numeric import cv, exact_long_sum, fround
from tradelens.functions.stats import attach_scalars, materialize, minmax_scale, quantile_scalars
from tradelens.params import RiskParams

SIGNALS = ("revenue_trend", "price_volatility", "shipment_irregular", "hs_concentration",
           "outlier_rate")


def risk_signals(df: DataFrame, key: str, date_col: str, value_col: str, price_col: str,
                 product_col: str, outlier_col: str, params: RiskParams = RiskParams()
                 ) -> DataFrame:
    """A-18..A-20 + J-6: the five raw signals and active months per qualified key.

    revenue_trend      1 / (late/early + eps); early missing/0 or late
                       missing -> ratio 0 -> 1/eps (pandas fillna(0));
                       NULL when the key has no rows in early or late years
    price_volatility   CV of the monthly mean price (sample std; 0 if NaN/mean<=0)
    shipment_irregular CV of the monthly value
    hs_concentration   1 / distinct products
    outlier_rate       share of flagged rows
    """
    year = F.year(date_col)
    early, late = list(params.early_years), list(params.late_years)
    units = f"{value_col}_units"
    money = F.col(units) if units in df.columns else F.col(value_col)
    total = exact_long_sum if units in df.columns else F.sum
    scale = 10_000.0 if units in df.columns else 1.0
    # price carries 4 dp: an exact LONG count of 1e-4 units sums without
    # object-backed decimals
    price_units = F.round(F.col(price_col) * 10_000).cast("long")
    # stage 1: (key, month, product) -- fixed-width buffers only, so this is
    # a hash aggregate with map-side combine (collect_set here would force
    # the sort-based object aggregate for every (key, month) group)
    kmp = (df.groupBy(F.col(key).alias("key"), F.trunc(date_col, "month").alias("ym"),
                      F.col(product_col).alias("product"))
             .agg(total(money).alias("v"), exact_long_sum(price_units).alias("pu"),
                  F.count(price_units).alias("np"), F.count("*").alias("n"),
                  F.count_if(F.col(outlier_col)).alias("n_out"),
                  total(F.when(year.isin(early), money)).alias("early_part"),
                  total(F.when(year.isin(late), money)).alias("late_part"),
                  F.count_if(year.isin(early + late)).alias("n_trend_rows")))
    monthly = (kmp.groupBy("key", "ym")
                  .agg((F.sum("v").cast("double") / scale).alias("m_value"),
                       (F.sum("pu").cast("double") / 10_000.0 / F.sum("np")).alias("m_price"),
                       F.sum("n").alias("n"), F.sum("n_out").alias("n_out"),
                       F.sum("early_part").alias("early_part"),
                       F.sum("late_part").alias("late_part"),
                       F.sum("n_trend_rows").alias("n_trend_rows"),
                       F.sum("v").alias("v_exact")))
    n_products = (kmp.groupBy("key", "product").agg(F.count("*").alias("__c"))
                     .groupBy("key").agg(F.count("*").alias("n_products")))
    per_key = (monthly.groupBy("key")
               .agg(F.count("*").alias("active_months"),
                    F.stddev_samp("m_price").alias("__sd_p"), F.avg("m_price").alias("__mu_p"),
                    F.stddev_samp("m_value").alias("__sd_v"),
                    (F.sum("v_exact").cast("double") / scale / F.count("v_exact")).alias("__mu_v"),
                    (F.sum("early_part").cast("double") / scale).alias("__early"),
                    (F.sum("late_part").cast("double") / scale).alias("__late"),
                    F.sum("n_trend_rows").alias("__n_trend"),
                    (F.sum("n_out") / F.sum("n")).alias("outlier_rate"),
                    (F.sum("v_exact").cast("double") / scale).alias("total_value"))
               .join(n_products, "key"))
    early_v = F.when(F.col("__early") != 0, F.col("__early"))
    ratio = F.coalesce(F.try_divide(F.col("__late"), early_v), F.lit(0.0))
    return (per_key.filter(F.col("active_months") >= params.min_active_months)
            .select(F.col("key"), "active_months", "total_value",
                    F.when(F.col("__n_trend") > 0, 1.0 / (ratio + params.epsilon))
                     .alias("revenue_trend"),
                    cv("__sd_p", "__mu_p").alias("price_volatility"),
                    cv("__sd_v", "__mu_v").alias("shipment_irregular"),
                    (1.0 / F.col("n_products")).alias("hs_concentration"),
                    F.coalesce("outlier_rate", F.lit(0.0)).alias("outlier_rate")))


def risk_scores(signals: DataFrame, params: RiskParams = RiskParams(),
                checkpoint: bool = True) -> DataFrame:
    """A-21 + A-22: min-max scale each signal to [0, 10] (constant -> 5), weighted
    sum, clip to [score_min, score_max], round to 2 dp.

    The per-key signals feed the rows, the min/max aggregate and (later) the
    band percentiles; ``checkpoint`` materialises them once in the shared
    folder so the fact is not re-scanned per branch."""
    if checkpoint:
        signals = materialize(signals)
    scaled = minmax_scale(signals, list(SIGNALS), suffix="_scaled")
    score = sum(F.col(f"{name}_scaled") * w for name, w in params.weights)
    clipped = F.least(F.greatest(score, F.lit(params.score_min)), F.lit(params.score_max))
    return scaled.withColumn("risk_score", fround(clipped, 2))


def risk_bands(scores: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """A-22: Low < p60 <= Medium <= p85 < High, thresholds from the score
    distribution (exact linear percentiles, one 1-row aggregate)."""
    q = quantile_scalars(scores, "risk_score", {"p60": params.band_low_q,
                                                "p85": params.band_high_q})
    s = attach_scalars(scores, q)
    band = (F.when(F.col("risk_score") < F.col("p60"), "Low")
             .when(F.col("risk_score") <= F.col("p85"), "Medium")
             .when(F.col("risk_score").isNotNull(), "High"))
    return s.withColumn("risk_band", band)


def exposure(bands: DataFrame, fx: float, top_n: int = 15) -> DataFrame:
    """A-23: High-band exposure in crore -- the top-n by total (what the study
    reports) and all High keys (trap T-18), one row."""
    high = bands.filter(F.col("risk_band") == "High")
    top = high.orderBy(F.col("total_value").desc(), F.col("key")).limit(top_n)
    # each amount is rounded to 1 dp, then summed exactly (DECIMAL) so the
    # total does not depend on summation order
    cr = lambda c: fround(F.col(c) * fx / 1e7, 1).cast("decimal(20,1)")
    t = top.agg(F.sum(cr("total_value")).cast("double").alias("top_n_inr_cr"),
                F.count("*").alias("n_top"))
    a = high.agg(F.sum(cr("total_value")).cast("double").alias("all_high_inr_cr"),
                 F.count("*").alias("n_high"))
    return a.crossJoin(t)
