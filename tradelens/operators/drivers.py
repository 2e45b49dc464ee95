"""External driver series: annual->weekly broadcast, weekly->monthly as-of
fill, yearly->monthly broadcast, z-scores.

IDs: S-9, S-10, J-11, J-12, W-4, W-5.

Driver series are tiny next to the fact (weeks x regions, years x states),
but they are still processed as keyed DataFrame operations: fills are
windows partitioned by the series key, never over the whole table, and
the monthly target calendar is generated per key with ``sequence``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelens.functions.stats import zscore


def annual_to_weekly(annual: DataFrame, year_col: str, value_col: str,
                     keys: list[str] | None = None, out_value: str = "value") -> DataFrame:
    """S-9: one row per Monday of each year carrying that year's value (cast to
    int, truncating), sorted, de-duplicated on (keys, week)."""
    keys = list(keys or [])
    y = F.col(year_col).cast("int")
    first_monday = F.next_day(F.date_sub(F.make_date(y, F.lit(1), F.lit(1)), 1), "Mon")
    weeks = F.sequence(first_monday, F.make_date(y, F.lit(12), F.lit(31)),
                       F.expr("INTERVAL 7 DAYS"))
    out = annual.select(*keys, F.explode(weeks).alias("week_start_date"),
                        F.col(value_col).cast("int").alias(out_value))
    return out.dropDuplicates([*keys, "week_start_date"])


def _all_positive(cols):
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.col(c) > 0)
    return cond


def validate_annual(df: DataFrame, required: list[str], positive: list[str]) -> DataFrame:
    """S-10 gate: required columns present (metadata) and no non-positive
    value (one aggregate).  Raises ValueError; returns df unchanged."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    bad = df.agg(F.count_if(~F.coalesce(_all_positive(positive), F.lit(False))).alias("n"))
    n = bad.first()["n"]
    if n:
        raise ValueError(f"{n} rows with non-positive {positive}")
    return df


def invalid_driver_rows(df: DataFrame, positive: list[str]) -> DataFrame:
    """S-10 report: rows that would make the load fail (non-positive/NULL)."""
    return df.filter(~F.coalesce(_all_positive(positive), F.lit(False)))


def valid_driver_rows(df: DataFrame, positive: list[str]) -> DataFrame:
    """S-10: the rows that pass the gate (all of ``positive`` known and above zero)."""
    return df.filter(F.coalesce(_all_positive(positive), F.lit(False)))


def weekly_to_monthly(weekly: DataFrame, week_col: str, value_col: str,
                      keys: list[str] | None = None) -> DataFrame:
    """J-11 part 1: mean of the weekly values per month of the week start."""
    keys = list(keys or [])
    return (weekly.groupBy(*keys, F.trunc(week_col, "month").alias("month"))
                  .agg(F.avg(value_col).alias(value_col)))


def fill_both_ways(df: DataFrame, keys: list[str], order_col: str, value_col: str,
                   out: str | None = None) -> DataFrame:
    """W-4: forward fill, then backward fill the leading gap (pandas
    ``ffill().bfill()``), per key, ordered by ``order_col``."""
    out = out or value_col
    w = Window.partitionBy(*keys).orderBy(order_col)
    ff = F.last(value_col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    bf = F.first(value_col, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn(out, F.coalesce(ff, bf))


def align_to_months(monthly: DataFrame, targets: DataFrame, value_col: str,
                    keys: list[str] | None = None) -> DataFrame:
    """J-11: reindex a monthly driver to the target months (left join from the
    target calendar), then ffill + bfill -- an as-of join in both directions.
    Without keys the driver is a single series (one small window partition
    over the target calendar, i.e. months, not data rows)."""
    keys = list(keys or [])
    j = targets.join(monthly, [*keys, "month"], "left")
    if keys:
        return fill_both_ways(j, keys, "month", value_col)
    j = j.withColumn("__k", F.lit(0))
    return fill_both_ways(j, ["__k"], "month", value_col).drop("__k")


def yearly_to_months(yearly: DataFrame, targets: DataFrame, year_col: str, value_col: str,
                     default: float = 100.0) -> DataFrame:
    """J-12: broadcast a yearly value to every target month of that year;
    missing years get ``default``.  The yearly table has one row per year
    (bounded by the calendar) and is broadcast."""
    y = F.broadcast(yearly.select(F.col(year_col).alias("__y"), F.col(value_col)))
    return (targets.join(y, F.year("month") == F.col("__y"), "left")
                   .withColumn(value_col, F.coalesce(F.col(value_col), F.lit(default)))
                   .drop("__y"))


def zscore_drivers(df: DataFrame, cols: list[str]) -> DataFrame:
    """W-5: z-score each driver with the SAMPLE std (pandas .std())."""
    return zscore(df, cols, sample=True, suffix="_z")
