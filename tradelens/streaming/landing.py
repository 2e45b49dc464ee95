"""Incremental refresh of the published fact from the landing zone.

The reference refreshes weekly in batch: re-read the newest snapshot per
(product, year), clean, gate, reload.  Here the same job is a Structured
Streaming query over the landing folder with ``trigger(availableNow=True)``:
each run processes exactly the files that arrived since the last run (the
file source's checkpoint in the shared folder records them), then stops.
A re-run after a crash or a lost executor resumes from that checkpoint.

Per micro-batch (``foreachBatch``):
  1. keep strictly named snapshot files (trap T-8), per (code, year) the newest
     stamp in the batch, and none older than the stamp already published;
  2. flatten, tag, clean (the batch cleaning chain, unchanged);
  3. merge: a refreshed slice replaces the published one, also when no row of it
     survived; outlier flags are set anew from all rows of each product, as the
     batch job sets them;
  4. run the quality suite in one aggregate and stop on failure;
  5. write the merged fact as a new immutable version and flip the pointer
     (readers see the old or the new version, never a mixture), then record the
     stamps.  A crash between the two repeats the batch with the same result.
A refresh rewrites the fact, as the reference's reload does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.operators import clean as C
from tradelens.operators import quality as Q
from tradelens.operators import warehouse as W
from tradelens.params import SNAPSHOT_FILE_PATTERN, CleanParams
from tradelens.session import scratch_path
from tradelens.sources.raw_json import DOCUMENT, flatten_documents

FACT = "fact_shipment"
STAMPS = "landing_stamps"


def _newest(docs: DataFrame, published: DataFrame | None) -> DataFrame:
    """Documents of the newest stamp per (code, year), none older than the published one."""
    parts = docs.select("*", *[F.regexp_extract("__file", SNAPSHOT_FILE_PATTERN, i).alias(n)
                                for i, n in ((1, "__code"), (2, "__year"), (3, "__stamp"))])
    named = parts.filter(F.col("__code") != "")
    stamps = named.select("__code", "__year", "__stamp")
    if published is not None:
        stamps = stamps.union(published)
    best = stamps.groupBy("__code", "__year").agg(F.max("__stamp").alias("__stamp"))
    return named.join(best, ["__code", "__year", "__stamp"], "left_semi")


def refresh_batch(batch: DataFrame, warehouse_dir: str, iso_table: DataFrame,
                  suite: list, params: CleanParams = CleanParams()) -> int | None:
    """Clean one batch of landed documents and merge it into the fact; the new
    version, or None when the batch holds nothing newer."""
    spark = batch.sparkSession
    known = W.current_version(spark, warehouse_dir, STAMPS) is not None
    docs = _newest(batch, W.read_current(spark, warehouse_dir, STAMPS) if known else None)
    # a malformed document replaces nothing
    ok = docs.filter(F.col("_corrupt_record").isNull() | F.col("data").isNotNull())
    slices = ok.select("__code", "__year", "__stamp").distinct()
    if slices.isEmpty():
        return None
    ov = C.overrides_frame(spark, params.overrides)
    fact = C.clean_from_tagged(C.tag_records(flatten_documents(ok), iso_table, ov, params), params)
    if W.current_version(spark, warehouse_dir, FACT) is not None:
        current = W.read_current(spark, warehouse_dir, FACT)
        keys = slices.select(F.col("__code").alias("hs_code"), F.col("__year").cast("int").alias("year"))
        kept = current.join(keys, ["hs_code", "year"], "left_anti")
        both = kept.select(*fact.columns).unionByName(fact).drop("is_outlier")
        fact = C.canonical_projection(C.flag_outliers(
            both, "hs_code", "unit_price_usd", quantile=params.outlier_quantile,
            min_rows=params.outlier_min_rows))
    if suite:
        Q.gate(Q.run_suite(fact, suite))
    version = W.write_version(fact, warehouse_dir, FACT, partition_by=["year"])
    W.write_version(slices, warehouse_dir, STAMPS, mode="append")
    return version


def start_refresh(spark: SparkSession, raw_dir: str, warehouse_dir: str, iso_table: DataFrame,
                  suite: list | None = None, params: CleanParams = CleanParams(),
                  checkpoint_location: str | None = None):
    """Start the availableNow refresh; returns the StreamingQuery (call
    ``awaitTermination()`` to wait for the catch-up to finish)."""
    ckpt = checkpoint_location or scratch_path(spark, "streams", "landing_refresh")
    stream = (spark.readStream.schema(DOCUMENT)
                   .option("multiLine", True).option("mode", "PERMISSIVE")
                   .option("columnNameOfCorruptRecord", "_corrupt_record")
                   .option("pathGlobFilter", "comtrade_*.json")
                   .json(raw_dir)
                   .select(F.col("_metadata.file_name").alias("__file"), "data",
                           "_corrupt_record"))

    def each(batch: DataFrame, batch_id: int) -> None:
        refresh_batch(batch, warehouse_dir, iso_table, suite or [], params)

    return (stream.writeStream.foreachBatch(each)
                  .option("checkpointLocation", ckpt)
                  .trigger(availableNow=True).start())
