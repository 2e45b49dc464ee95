"""DataFrame helpers shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.session import apply_semantics, scratch_path, ship_package

#: Rows per Arrow batch; texts are long, so far fewer than Spark's default.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Settings and code that the operators need on any session."""
    apply_semantics(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text) -> F.Column:
    """16 bytes that identify a text; null counts as the empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """One row per distinct text: key, n (rows that hold it), text.

    Aggregated map-side first, so a group of copies of any size costs one row
    per task.  The result is hash-partitioned by key: joins on key move only
    their other side.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return (docs.select(text_key(F.col("text")).alias("key"), text.alias("text"))
            .where("key is not null")  # always true; else joins on key add it and their exchange is another one
            .groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first("text").alias("text")))


def quoted(name: str) -> str:
    """A column's name as a reference, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def packed_row(columns: list[str]) -> F.Column:
    """The columns as one struct ``row``, so that their names meet no others."""
    return F.struct(*(F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(columns))).alias("row")


def unpacked_row(columns: list[str]) -> list[F.Column]:
    """The columns of ``packed_row`` again."""
    return [F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)]
