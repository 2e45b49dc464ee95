"""Named queries bound to the driver's test tables, each with its SQL twin.

A query is a function ``(spark, sf_dir) -> DataFrame``.  Its oracle is an
ANSI SQL string DuckDB runs over the same Parquet tables (pre-registered as
views), or ``None`` for operators that are not SQL-expressible (k-means,
grouped least-squares fits), which are then checked by invariants in tests.

Conventions so both sides compare equal: every computed column is aliased
to the same name; money is summed as DECIMAL and cast to DOUBLE; ratios are
rounded to ``R`` decimals on both sides; integer outputs are BIGINT/INT as
declared in the SQL with explicit casts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

R = 6  # decimals kept for derived doubles on both sides


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: tuple


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, ids: tuple = ()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(ids))
        return fn
    return deco


def load_all() -> dict[str, Query]:
    """Import every query module (registration happens on import)."""
    from tradelens.plans import (  # noqa: F401
        q_clean,
        q_benchmark,
        q_marts,
        q_pipeline,
        q_quality,
        q_risk,
        q_seasonality,
        q_segment,
        q_sources,
        q_timeseries,
        q_warehouse,
    )
    return REGISTRY
