"""File sources and sinks: CSV, source resolution, clean-table writer.

IDs: S-3, S-5, S-7, S-11.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tradelens.functions.text import pad_code


def read_csv(spark: SparkSession, path: str, schema: str, date_format: str = "yyyy-MM-dd",
             code_col: str | None = None) -> DataFrame:
    """S-5: header CSV with an explicit schema (no inference pass) and the
    product code re-padded to 6 characters."""
    df = (spark.read.schema(schema).option("header", True).option("dateFormat", date_format)
               .option("mode", "PERMISSIVE").csv(path))
    if code_col:
        df = df.withColumn(code_col, pad_code(code_col))
    return df


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """S-3: concatenate frames by column name; missing columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _absent(exc: Exception) -> bool:
    text = str(exc)
    return ("PATH_NOT_FOUND" in text or "TABLE_OR_VIEW_NOT_FOUND" in text
            or "does not exist" in text)


def resolve_source(candidates: list[tuple[str, Callable[[], DataFrame]]]
                   ) -> tuple[str, DataFrame]:
    """S-7: the first candidate that exists and is non-empty.

    Falls back ONLY when a source is absent or empty; any other error (a
    wrong query, a bad schema) propagates instead of being mistaken for
    "source unavailable" (trap T-25).  Returns (chosen name, frame)."""
    for name, load in candidates:
        try:
            df = load()
            if df.limit(1).count() == 0:
                continue
            return name, df
        except (AnalysisException, FileNotFoundError) as exc:
            if isinstance(exc, FileNotFoundError) or _absent(exc):
                continue
            raise
    raise FileNotFoundError("no candidate source is available: "
                            + ", ".join(n for n, _ in candidates))


def write_clean(df: DataFrame, out_dir: str, csv_twin: bool = False,
                partition_by: str | None = "year") -> None:
    """S-11: Parquet (snappy), partitioned by year for pruning, files sorted
    within partitions; the CSV twin is an opt-in export."""
    w = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.parquet(f"{out_dir.rstrip('/')}/clean.parquet")
    if csv_twin:
        (df.write.mode("overwrite").option("header", True)
           .csv(f"{out_dir.rstrip('/')}/clean.csv"))

