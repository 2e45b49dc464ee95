"""Exact per-group quantiles (linear interpolation, pandas/numpy default = SQL
``quantile_cont``), by one path for every size.

Spark's exact ``percentile`` aggregate keeps a value->count map per group and
merges it in ONE task per group.  Here no group is gathered:

1. rows per (group, bucket), counted straight from the rows with map-side
   combine, where the bucket is a monotone function of the value (sign and 1/256
   octave): at most about 1.2 million buckets a group whatever its size, some
   thousands for prices.  Running counts over them say which buckets hold the ranks
   floor(q(n-1)) and ceil(q(n-1)).  These located buckets, two a group and quantile
   at most, are written to the shared folder, so that the planner knows their size;
2. a second scan keeps the rows of the located buckets only (a broadcast join
   while they are few), counts them per value with map-side combine, and ranks
   those (a window over (group, bucket), which streams and spills);
3. interpolate: (hi - pos) * v_lo + (pos - lo) * v_hi with pos = q(n-1).

Values outside the located buckets are never shuffled.  The first step runs while
the plan is built.  NULL values are ignored; a group without values gets NULL
quantiles; a NULL key is a group of its own; NaN is the largest value; an empty
table has no groups, and NULL quantiles if there are no keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelens.functions.stats import measured

BUCKETS_PER_OCTAVE = 256
_POSITIVE = 300_000  # log2 of a double is above -1075, so 256 times it is above -275,200
_INFINITE = 590_000
_NAN = 600_000


def value_bucket(v: Column) -> Column:
    """A long that never falls as the double ``v`` rises (log2 is StrictMath's, the
    same on every executor)."""
    size = F.abs(v)
    octave = F.floor(F.log2(F.when(size < float("inf"), size)) * BUCKETS_PER_OCTAVE) + _POSITIVE
    place = F.coalesce(octave, F.lit(_INFINITE))
    return (F.when(F.isnan(v), F.lit(_NAN)).when(v == 0, F.lit(0))
             .when(v > 0, place).when(v < 0, -place).cast("long"))


def group_quantiles(df: DataFrame, group_cols: list[str], value_col: str,
                    qs: dict[str, float], count_col: str | None = None) -> DataFrame:
    """One row per group: the exact quantiles ``qs`` (name -> fraction) of ``value_col``
    and, as ``count_col``, the group's rows (those with NULL values included)."""
    keys = [f"__k{i}" for i in range(len(group_cols))] or ["__k0"]
    key_cols = [F.col(g).alias(k) for g, k in zip(group_cols, keys)] or [F.lit(0).alias("__k0")]
    rows = (df.select(*key_cols, F.col(value_col).cast("double").alias("__v"))
              .withColumn("__b", value_bucket(F.col("__v"))))
    blocks = rows.groupBy(*keys, "__b").agg(F.count(F.lit(1)).alias("__rows"), F.count("__v").alias("__cnt"))
    w = Window.partitionBy(*keys)
    blocks = (blocks.withColumn("__n", F.sum("__cnt").over(w))
                    .withColumn("__total", F.sum("__rows").over(w))
                    .withColumn("__start", F.sum("__cnt").over(
                        w.orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__cnt")))

    def pos(q):
        return F.lit(float(q)) * (F.col("__n") - 1)

    ranks = [r for q in qs.values() for r in (F.floor(pos(q)), F.ceil(pos(q)))]
    start, end = F.col("__start"), F.col("__start") + F.col("__cnt")
    needed = reduce(lambda a, b: a | b, [(r >= start) & (r < end) for r in ranks])
    # the rows without a value, and a group's first bucket, carry the totals of a group
    kept = measured(blocks.withColumn("__needed", F.coalesce(needed, F.lit(False)) & (F.col("__cnt") > 0))
                          .where("__needed or __b is null or __start = 0"), "quantile-buckets")
    located = kept.where("__needed").select(*[F.col(k).alias(k + "r") for k in keys],
                                            F.col("__b").alias("__br"), "__n", "__start")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(k + "r")) for k in keys],
                  F.col("__b") == F.col("__br"))
    values = (rows.join(located, same).groupBy(*keys, "__b", "__n", "__start", "__v")
                  .agg(F.count(F.lit(1)).alias("__c")))
    in_bucket = (Window.partitionBy(*keys, "__b").orderBy("__v")
                       .rowsBetween(Window.unboundedPreceding, 0))
    ranked = (values.withColumn("__to", F.col("__start") + F.sum("__c").over(in_bucket))
                    .withColumn("__from", F.col("__to") - F.col("__c")))
    held = [(r >= F.col("__from")) & (r < F.col("__to")) for r in ranks]
    picked = ranked.select(*keys, "__n", F.lit(None).cast("long").alias("__total"),
                           *[F.when(h, F.col("__v")).alias(f"__r{i}") for i, h in enumerate(held)])
    groups = kept.groupBy(*keys).agg(F.max("__total").alias("__total"), F.max("__n").alias("__n"))
    nothing = [F.lit(None).cast("double").alias(f"__r{i}") for i in range(len(ranks))]
    both = (groups.select(*keys, "__n", "__total", *nothing).union(picked)
                  .groupBy(*keys).agg(F.max("__n").alias("__n"), F.max("__total").alias("__total"),
                                      *[F.max(f"__r{i}").alias(f"__r{i}") for i in range(len(ranks))]))

    def interpolated(i, q):
        lo, hi = F.col(f"__r{2 * i}"), F.col(f"__r{2 * i + 1}")
        p = pos(q)
        return F.when(F.floor(p) == F.ceil(p), lo).otherwise(
            (F.ceil(p) - p) * lo + (p - F.floor(p)) * hi)

    out = [F.col(k).alias(g) for g, k in zip(group_cols, keys)]
    out += [F.col("__total").alias(count_col)] if count_col else []
    out += [interpolated(i, q).alias(name) for i, (name, q) in enumerate(qs.items())]
    if not group_cols:  # one row even for an empty table
        both = both.groupBy().agg(*[F.max(c).alias(c) for c in both.columns if c not in keys])
        out = [F.coalesce(c, F.lit(0)).alias(count_col) if count_col and i == 0 else c
               for i, c in enumerate(out)]
    return both.select(*out)
