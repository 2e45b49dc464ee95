"""Exploratory marts: profiles, concentration, mixes, heat maps, top-k, YoY.

IDs: P-9, P-13, A-3, A-5..A-8, A-11, A-13, A-24, A-26, W-2, J-10, L-1..L-3, L-5.

All are keyed aggregates with partial aggregation; global totals are a
1-row aggregate attached by broadcast; top-k is TakeOrderedAndProject (each
task keeps k rows) and per-group top-k is a window over the *aggregated*
key table, never over raw rows; pivots always receive explicit values so no
extra distinct-values job runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelens.functions.numeric import money_sum
from tradelens.functions.quantiles import group_quantiles
from tradelens.functions.stats import attach_scalars, measured, quantile_scalars


def map_category(df: DataFrame, code_col: str, mapping: dict[str, str], out: str = "category"
                 ) -> DataFrame:
    """P-9: dictionary lookup code -> category (unmapped -> NULL), as a map literal
    evaluated in codegen (no join, no Python)."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return df.withColumn(out, F.element_at(F.create_map(*pairs), F.col(code_col))
                         if pairs else F.lit(None).cast("string"))


def dataset_profile(df: DataFrame, key_cols: list[str], date_col: str, value_col: str,
                    qty_col: str, flag_col: str | None = None, approx: bool = False) -> DataFrame:
    """A-3: rows, distinct keys, date range, sums, flag count and rate -- one agg.

    ``approx=True`` swaps exact distinct counts (one extra shuffle each) for
    HyperLogLog sketches that merge map-side.
    """
    dc = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    aggs = [F.count("*").alias("n_rows")]
    aggs += [dc(c).alias(f"n_distinct_{c}") for c in key_cols]
    aggs += [F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
             money_sum(df, value_col).alias("total_value"), F.sum(qty_col).alias("total_qty")]
    if flag_col:
        aggs += [F.count_if(F.col(flag_col)).alias("n_flagged"),
                 F.avg(F.col(flag_col).cast("double")).alias("flag_rate")]
    return df.agg(*aggs)


def totals_with_share(df: DataFrame, key: str, value_col: str) -> DataFrame:
    """A-5 / A-7: total per key and its share of the grand total."""
    per = df.groupBy(key).agg(money_sum(df, value_col).cast("double").alias("total"))
    grand = per.agg(F.sum("total").alias("__grand"))
    return (attach_scalars(per, grand)
            .withColumn("share", F.col("total") / F.col("__grand")).drop("__grand"))


def top_k(df: DataFrame, order_col: str, k: int, tie_cols: list[str]) -> DataFrame:
    """L-1: k rows with the largest ``order_col``; ties broken by ``tie_cols``."""
    return df.orderBy(F.col(order_col).desc(), *[F.col(c).asc() for c in tie_cols]).limit(k)


def concentration(df: DataFrame, key: str, value_col: str, top_n: int = 10) -> DataFrame:
    """A-5: one row -- number of keys, top-1 share, top-N share.

    The per-key totals feed two branches (their count and sum, and the top-N
    rows from ``top_k``); both share one scan and one exchange.
    """
    per = df.groupBy(key).agg(money_sum(df, value_col).cast("double").alias("total"))
    whole = per.agg(F.count("*").alias("n_keys"), F.sum("total").alias("__grand"))
    shares = (attach_scalars(top_k(per, "total", top_n, [key]), whole)
              .select(F.try_divide(F.col("total"), F.col("__grand")).alias("share")))
    head = shares.agg(F.max("share").alias("top1_share"), F.sum("share").alias(f"top{top_n}_share"))
    return attach_scalars(head, whole.select("n_keys")).select("n_keys", "top1_share", f"top{top_n}_share")


def pivot_sum(df: DataFrame, row_key: str, pivot_col: str, values: list, value_col: str,
              fill: float = 0.0) -> DataFrame:
    """A-6 / A-8: groupBy(row).pivot(col, explicit values).sum(), NULL -> fill."""
    p = (df.groupBy(row_key).pivot(pivot_col, values)
           .agg(money_sum(df, value_col).cast("double")))
    return p.fillna(fill, subset=[str(v) for v in values])


def price_quantiles(df: DataFrame, key: str, price_col: str, qs=(0.5, 0.95)) -> DataFrame:
    """A-11: exact linear-interpolated quantiles per key (pandas .quantile)."""
    return group_quantiles(df, [key], price_col, {f"p{int(round(q * 100))}": q for q in qs})


def histogram(df: DataFrame, key: str, value_col: str, bins: int = 30,
              clip_quantile: float = 0.95) -> DataFrame:
    """A-26: per key, ``bins`` equal-width bins over values clipped at the key's
    quantile; returns (key, bin, count) for non-empty bins.

    Bin edges follow numpy: [min, max] split in ``bins``; the max lands in
    the last bin.  NULL values are in no bin; a NULL key has no bins.  Caps and
    ranges are one row per key, joined back by their measured size.
    """
    x = F.col(value_col).cast("double")
    rows = df.select(F.col(key), x.alias("__x")).where(F.col(key).isNotNull() & F.col("__x").isNotNull())
    cap = F.col("__cap")
    ranges = (group_quantiles(rows, [key], "__x", {"__cap": clip_quantile})
              .join(rows.groupBy(key).agg(F.min("__x").alias("__min"), F.max("__x").alias("__max")), key)
              .select(key, "__cap", F.least("__min", cap).alias("__lo"), F.least("__max", cap).alias("__hi")))
    v = F.least(F.col("__x"), cap)
    b = F.when(F.col("__hi") == F.col("__lo"), F.lit(0)).otherwise(
        F.least(F.floor((v - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins),
                F.lit(bins - 1)))
    return (rows.join(measured(ranges, "histogram-ranges"), key)
                .groupBy(key, b.cast("int").alias("bin")).agg(F.count("*").alias("n")))


def yoy_change(df: DataFrame, key: str, year_col: str, value_col: str) -> DataFrame:
    """W-2: yearly totals per key densified over the global year range (0 fill),
    then (x / previous - 1) * 100 with x/0 -> NULL; the first year is dropped."""
    yearly = df.groupBy(key, F.col(year_col).alias("year")).agg(
        money_sum(df, value_col).cast("double").alias("total"))
    span = yearly.agg(F.min("year").alias("__lo"), F.max("year").alias("__hi"))
    grid = (yearly.select(key).distinct().crossJoin(F.broadcast(span))
                  .select(key, F.explode(F.sequence("__lo", "__hi")).alias("year")))
    dense = (grid.join(yearly, [key, "year"], "left")
                 .withColumn("total", F.coalesce("total", F.lit(0.0))))
    w = Window.partitionBy(key).orderBy("year")
    prev = F.lag("total").over(w)
    return (dense.withColumn("yoy_pct", (F.try_divide(F.col("total"), prev) - 1) * 100)
                 .withColumn("__first", prev.isNull())
                 .filter(~F.col("__first")).drop("__first"))


def top_n_per_group(df: DataFrame, group_col: str, order_col: str, n: int, tie_col: str
                    ) -> DataFrame:
    """L-2: top-n rows per group by ``order_col`` desc, ties by ``tie_col``.

    Two phases so a group holding most rows is never sorted in one task:
    (1) rank within (group, input partition) and keep each partition's top n
    -- the window's tasks are as balanced as the input partitions; (2) rank
    the surviving <= n x partitions candidates per group."""
    order = [F.col(order_col).desc(), F.col(tie_col)]
    local = Window.partitionBy(group_col, "__part").orderBy(*order)
    cand = (df.withColumn("__part", F.spark_partition_id())
              .withColumn("__r", F.row_number().over(local))
              .filter(F.col("__r") <= n).drop("__r", "__part"))
    final = Window.partitionBy(group_col).orderBy(*order)
    return cand.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= n)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A-24: rows per value."""
    return df.groupBy(col).agg(F.count("*").alias("n"))


def describe(df: DataFrame, col: str) -> DataFrame:
    """A-24 describe(): count, mean, sample std, min, quartiles (exact, linear
    interpolation as pandas), max -- one row.  (Spark's own ``summary()`` uses
    approximate percentiles.)"""
    x = F.col(col).cast("double")
    moments = df.agg(F.count(x).alias("count"), F.avg(x).alias("mean"),
                     F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))
    quartiles = quantile_scalars(df, col, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return attach_scalars(moments, quartiles).select("count", "mean", "std", "min", "p25", "p50",
                                                     "p75", "max")


def unpivot_prices(df: DataFrame, id_cols: list[str], value_cols: list[str], suffix: str,
                   var_name: str = "reporter", value_name: str = "price") -> DataFrame:
    """P-13: wide competitor columns -> long rows, suffix stripped, title-cased."""
    long = df.unpivot(id_cols, value_cols, var_name, value_name)
    label = F.initcap(F.regexp_replace(F.regexp_replace(F.col(var_name), suffix + "$", ""),
                                       "_", " "))
    return long.withColumn(var_name, label)
