"""Competitor price benchmark and opportunity sizing.

IDs: A-14, A-15, A-16, J-8, J-9, J-14, P-13, P-14.

Shape of the job: one aggregate of the fact to (reporter, year, product)
(partial aggregation, small output), then everything else runs on that
panel, whose size is reporters x years x products -- independent of the
number of shipments.  The baseline is attached by an equi-join on product
(J-8), not by row-wise Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.functions.numeric import fround, money_sum
from tradelens.params import BenchmarkParams


def reporter_panel(df: DataFrame, reporter: str, year: str, product: str, value: str,
                   qty: str, partner: str, base_reporter: str, world_code=0) -> DataFrame:
    """A-14: (reporter, year, product) -> fob, qty, weighted price sum(v)/sum(q).

    Competitor rows exclude the world partner (no double counting) and keep
    only groups with qty > 0; the base reporter's own rows are used as is.
    """
    is_base = F.col(reporter) == base_reporter
    keep = is_base | ~F.coalesce(F.col(partner) == world_code, F.lit(False))
    g = (df.filter(keep)
           .groupBy(F.col(reporter).alias("reporter"), F.col(year).alias("year"),
                    F.col(product).alias("product"))
           .agg(money_sum(df, value).alias("fob"), F.sum(qty).alias("qty")))
    g = g.filter((F.col("reporter") == base_reporter) | (F.col("qty") > 0))
    return g.withColumn("price", F.try_divide(F.col("fob").cast("double"),
                                              F.col("qty").cast("double")))


def avg_prices(panel: DataFrame) -> DataFrame:
    """A-15 long form: unweighted mean over years of the yearly prices."""
    return panel.groupBy("product", "reporter").agg(F.avg("price").alias("avg_price"))


def price_matrix(panel: DataFrame, reporters: list[str]) -> DataFrame:
    """A-15: product x reporter matrix, baseline column first (explicit pivot values)."""
    return (panel.groupBy("product").pivot("reporter", reporters).agg(F.avg("price")))


def price_gaps(avg: DataFrame, base_reporter: str, params: BenchmarkParams = BenchmarkParams()
               ) -> DataFrame:
    """J-8 + P-14: competitor price minus baseline, per (product, competitor).

    ``warn`` flags gap > threshold; ``gap_ratio`` = gap / base price and
    ``price_ratio`` = competitor / base price (NULL when base <= 0, the
    reference's infinity).  Both ratios are kept explicit (trap T-17).
    """
    base = avg.filter(F.col("reporter") == base_reporter).select(
        "product", F.col("avg_price").alias("base_price"))
    comp = avg.filter(F.col("reporter") != base_reporter).select(
        "product", F.col("reporter").alias("competitor"),
        F.col("avg_price").alias("competitor_price"))
    j = comp.join(base, "product", "left")
    gap = F.col("competitor_price") - F.col("base_price")
    pos_base = F.col("base_price") > 0
    return (j.withColumn("gap", gap)
             .withColumn("warn", F.coalesce(gap > params.gap_threshold, F.lit(False)))
             .withColumn("gap_ratio", F.when(pos_base, gap / F.col("base_price")))
             .withColumn("price_ratio",
                         F.when(pos_base, F.col("competitor_price") / F.col("base_price"))))


def opportunity(gaps: DataFrame, panel: DataFrame, base_reporter: str,
                params: BenchmarkParams = BenchmarkParams()) -> DataFrame:
    """A-16 + J-9: max(gap, 0) x capture x base-year volume, in USD and crore.

    The base-year volume is a left join on product, so a product without
    base-year rows gets NULL opportunity (pandas index alignment).
    """
    vol = (panel.filter((F.col("reporter") == base_reporter) & (F.col("year") == params.base_year))
                .select("product", F.col("qty").cast("double").alias("base_volume"),
                        F.col("fob").cast("double").alias("base_fob")))
    j = gaps.join(vol, "product", "left")
    usd = F.greatest(F.col("gap"), F.lit(0.0)) * params.capture * F.col("base_volume")
    return (j.withColumn("opportunity_usd", usd)
             .withColumn("opportunity_inr_cr", fround(usd * params.fx / 1e7, 2)))


def opportunity_totals(opp: DataFrame, excluded_products, excluded_competitor: str
                       ) -> DataFrame:
    """A-16 totals: sum of crore figures, and the grade-adjusted total that
    removes the excluded products' opportunity vs the excluded competitor."""
    excl = (F.col("product").isin(list(excluded_products))
            & (F.col("competitor") == excluded_competitor))
    return opp.agg(
        F.sum("opportunity_inr_cr").alias("total_inr_cr"),
        F.coalesce(F.sum(F.when(excl, F.col("opportunity_inr_cr"))), F.lit(0.0))
         .alias("excluded_inr_cr"),
    ).withColumn("adjusted_inr_cr", F.col("total_inr_cr") - F.col("excluded_inr_cr"))


def fx_sensitivity(totals: DataFrame, base_fx: float, rates, col: str = "adjusted_inr_cr"
                   ) -> DataFrame:
    """J-14: a total scaled to alternative exchange rates (crossJoin with a
    fixed, bounded list of rates)."""
    spark = totals.sparkSession
    r = spark.createDataFrame([(float(x),) for x in rates], "fx_rate double")
    return (totals.crossJoin(F.broadcast(r))
                  .select("fx_rate", (F.col(col) * F.col("fx_rate") / base_fx).alias("scaled_inr_cr")))
