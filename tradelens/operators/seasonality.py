"""Seasonality: monthly totals, peak premium, densification, decomposition.

IDs: A-4, A-9, A-10, W-3, W-6, W-7.

Every operator here is a *keyed* computation: the first aggregation collapses
the fact to (series key, month) -- a partial/final hash aggregate with
map-side combine, so a hot key costs one partial row per map task -- and all
later work (windows, second-level aggregates) runs on that small monthly
panel partitioned by the series key.  No window is ever unpartitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradelens.functions.numeric import money_sum
from tradelens.params import PEAK_MONTHS


def monthly_totals(df: DataFrame, keys: list[str], date_col: str = "shipment_date",
                   value_col: str = "value", out: str = "total", as_double: bool = True
                   ) -> DataFrame:
    """A-4: sum of value per (keys, first-of-month).

    The sum runs in the value's own type (exact DECIMAL for money) and is
    converted to DOUBLE once at the end (``as_double``), so totals do not
    depend on summation order.
    """
    month = F.trunc(F.col(date_col), "month").alias("month")
    total = money_sum(df, value_col)
    return (df.groupBy(*keys, month)
              .agg((total.cast("double") if as_double else total).alias(out)))


def exact_mean(c: Column | str) -> Column:
    """Mean of an exact (DECIMAL) column: exact sum, then one double division.

    Unlike a running double average this is independent of row order, so
    every engine (and every partitioning) returns the same bits.
    """
    x = F.col(c) if isinstance(c, str) else c
    return F.sum(x).cast("double") / F.count(x)


def peak_premium(df: DataFrame, keys: list[str], date_col: str = "shipment_date",
                 value_col: str = "value", peak_months=PEAK_MONTHS) -> DataFrame:
    """A-9: mean(peak-month totals) / mean(all monthly totals) - 1 per key.

    Means are over the months *present* for the key (no zero fill).
    """
    m = monthly_totals(df, keys, date_col, value_col, as_double=False)
    return (m.groupBy(*keys)
             .agg(exact_mean(F.when(F.month("month").isin(list(peak_months)), F.col("total")))
                   .alias("peak_mean"),
                  exact_mean("total").alias("annual_mean"),
                  F.count("*").alias("n_months"))
             .withColumn("premium", F.col("peak_mean") / F.col("annual_mean") - 1))


def peak_premium_rollup(df: DataFrame, segment: Column, date_col: str = "shipment_date",
                        value_col: str = "value", peak_months=PEAK_MONTHS,
                        whole_label: str = "ALL") -> DataFrame:
    """A-9 with a whole-population row: one scan, GROUPING SETS((seg, month), (month)).

    The first aggregate expands each row twice (Expand node) and partially
    aggregates before the shuffle, so the 'whole' level costs no extra scan.
    """
    month = F.trunc(F.col(date_col), "month")
    extra = [f"{value_col}_units"] if f"{value_col}_units" in df.columns else []
    base = df.select(segment.alias("segment"), month.alias("month"), F.col(value_col), *extra)
    totals = (base.rollup("month", "segment")
                  .agg(money_sum(base, value_col).alias("total"),
                       F.grouping_id().alias("gid"))
                  .filter(F.col("gid") < 3)  # drop the grand-total (no month) row
                  .select(F.when(F.col("gid") == 1, F.lit(whole_label))
                           .otherwise(F.col("segment")).alias("segment"),
                          "month", "total"))
    return (totals.groupBy("segment")
                  .agg(exact_mean(F.when(F.month("month").isin(list(peak_months)),
                                         F.col("total"))).alias("peak_mean"),
                       exact_mean("total").alias("annual_mean"))
                  .withColumn("premium", F.col("peak_mean") / F.col("annual_mean") - 1))


def peak_premium_by_year(df: DataFrame, keys: list[str] | None = None,
                         date_col: str = "shipment_date", value_col: str = "value",
                         peak_months=PEAK_MONTHS) -> DataFrame:
    """A-10: per year, peak mean over zero-filled peak months vs mean of non-zero months.

    Calendar-densified over months 1..12: a peak month with no rows counts as
    0 in the peak mean; the annual mean excludes zero months; all-zero years
    are skipped.  The zero fill needs no join -- sum(peak)/len(peak) is it.
    """
    keys = list(keys or [])
    m = (monthly_totals(df, keys, date_col, value_col, as_double=False)
         .withColumn("year", F.year("month")))
    n_peak = float(len(peak_months))
    peak_sum = F.sum(F.when(F.month("month").isin(list(peak_months)), F.col("total")))
    return (m.groupBy(*keys, "year")
             .agg((F.coalesce(peak_sum.cast("double"), F.lit(0.0)) / n_peak).alias("peak_mean"),
                  exact_mean(F.when(F.col("total") > 0, F.col("total"))).alias("annual_mean"),
                  F.sum("total").alias("year_total"))
             .filter(F.col("year_total") != 0)
             .withColumn("premium", F.col("peak_mean") / F.col("annual_mean") - 1)
             .drop("year_total"))


def densify_monthly(totals: DataFrame, keys: list[str], month_col: str = "month",
                    value_col: str = "total", span: str = "key") -> DataFrame:
    """W-3: calendar densification (resample('MS').sum()): missing month -> 0.

    ``span='key'`` fills each key between its own first and last month;
    ``span='global'`` fills every key over the global first..last month.
    Implemented as explode(sequence(lo, hi)) per key + left join -- linear in
    keys x months, never a cross product of data rows.
    """
    if span == "key":
        bounds = totals.groupBy(*keys).agg(F.min(month_col).alias("__lo"),
                                           F.max(month_col).alias("__hi"))
    else:
        g = totals.agg(F.min(month_col).alias("__lo"), F.max(month_col).alias("__hi"))
        bounds = totals.select(*keys).distinct().crossJoin(F.broadcast(g))
    grid = bounds.select(*keys, F.explode(F.sequence("__lo", "__hi",
                                                     F.expr("INTERVAL 1 MONTH")))
                         .alias(month_col))
    return (grid.join(totals, [*keys, month_col], "left")
                .withColumn(value_col, F.coalesce(F.col(value_col), F.lit(0.0))))


def seasonal_decompose(series: DataFrame, keys: list[str], month_col: str = "month",
                       value_col: str = "total", period: int = 12) -> DataFrame:
    """W-6: classical additive decomposition per series (even period).

    trend    = centred 2 x period moving average (NULL for the first/last
               period/2 points);
    seasonal = mean detrended value per position (months since series start
               mod period), re-centred so the period means sum to 0;
    resid    = y - trend - seasonal.
    Input must be dense (see ``densify_monthly``).
    """
    half = period // 2
    w = Window.partitionBy(*keys).orderBy(month_col)
    start = F.min(month_col).over(Window.partitionBy(*keys))
    ma_a = F.avg(value_col).over(w.rowsBetween(-half, half - 1))
    ma_b = F.avg(value_col).over(w.rowsBetween(-half + 1, half))
    full = F.count(value_col).over(w.rowsBetween(-half, half)) == (2 * half + 1)
    step = (series
            .withColumn("pos", F.pmod(F.months_between(F.col(month_col), start).cast("int"),
                                      F.lit(period)))
            .withColumn("trend", F.when(full, (ma_a + ma_b) / 2))
            .withColumn("detrended", F.col(value_col) - F.col("trend")))
    pos_means = step.groupBy(*keys, "pos").agg(F.avg("detrended").alias("pos_mean"))
    centred = pos_means.withColumn(
        "seasonal",
        F.col("pos_mean") - F.avg("pos_mean").over(Window.partitionBy(*keys)))
    return (step.join(centred.select(*keys, "pos", "seasonal"), [*keys, "pos"])
                .withColumn("resid", F.col(value_col) - F.col("trend") - F.col("seasonal"))
                .select(*keys, month_col, value_col, "trend", "seasonal", "resid"))


def seasonal_profile(decomposed: DataFrame, keys: list[str], month_col: str = "month",
                     peak_months=PEAK_MONTHS) -> DataFrame:
    """W-7: mean seasonal component per calendar month + mean peak lift per key."""
    by_month = (decomposed.groupBy(*keys, F.month(month_col).alias("month_of_year"))
                          .agg(F.avg("seasonal").alias("seasonal_mean")))
    lift = F.avg(F.when(F.col("month_of_year").isin(list(peak_months)),
                        F.col("seasonal_mean"))).over(Window.partitionBy(*keys))
    return by_month.withColumn("peak_lift", lift)
