"""Whole-column statistics applied row-wise, without unpartitioned windows.

A naive ``Window.partitionBy()`` (no keys) moves every row into one task.
Instead each helper computes a ONE-ROW aggregate (partial aggregation on every
partition, then a single tiny final merge) and attaches it with a broadcast
cross join.  The broadcast side is exactly one row, so its size is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach a 1-row frame of scalars to every row (broadcast, no shuffle)."""
    return df.crossJoin(F.broadcast(scalars))


def minmax_scale(df: DataFrame, cols: list[str], scale: float = 10.0,
                 constant_value: float = 5.0, suffix: str = "") -> DataFrame:
    """A-21: (x - min)/(max - min) * scale per column; constant column -> 5.0."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"__lo_{c}"), F.max(c).alias(f"__hi_{c}")]
    out = attach_scalars(df, df.agg(*aggs))
    for c in cols:
        lo, hi = F.col(f"__lo_{c}"), F.col(f"__hi_{c}")
        scaled = F.when(hi == lo, F.lit(constant_value)).otherwise(
            (F.col(c) - lo) / (hi - lo) * scale)
        out = out.withColumn(c + suffix, scaled)
    return out.drop(*[f"__lo_{c}" for c in cols], *[f"__hi_{c}" for c in cols])


def zscore(df: DataFrame, cols: list[str], sample: bool = True,
           suffix: str = "") -> DataFrame:
    """W-5 (sample std) / M-1 (population std): (x - mean) / std per column."""
    std = F.stddev_samp if sample else F.stddev_pop
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"__mu_{c}"), std(c).alias(f"__sd_{c}")]
    out = attach_scalars(df, df.agg(*aggs))
    for c in cols:
        out = out.withColumn(c + suffix,
                             (F.col(c) - F.col(f"__mu_{c}")) / F.col(f"__sd_{c}"))
    return out.drop(*[f"__mu_{c}" for c in cols], *[f"__sd_{c}" for c in cols])


def quantile_scalars(df: DataFrame, col: str, qs: dict[str, float]) -> DataFrame:
    """1-row frame of exact (linear-interpolated) quantiles of ``col``
    (``functions.quantiles``: no single task holds the column)."""
    from tradelens.functions.quantiles import group_quantiles
    return group_quantiles(df, [], col, qs)


def measured(df: DataFrame, name: str) -> DataFrame:
    """Write a per-group table to the shared folder and read it back, so that joins
    with it are planned by its true size: broadcast below the session's threshold,
    shuffled above it.  The fact on the other side is then not shuffled on a key
    of a few values only because the planner could not know."""
    import uuid

    from tradelens.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, "measured", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used where a *small, keyed* intermediate (one row per key) feeds several
    branches of one plan -- its rows, a min/max aggregate, a percentile
    aggregate.  Without it each branch re-runs the whole lineage down to the
    fact scan; with it the fact is read once and a lost executor recovers
    from the checkpoint files, not by recomputing the fact.
    """
    from tradelens.session import shared_dir
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
