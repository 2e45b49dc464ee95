"""Raw landed JSON documents: snapshot selection, flattening, manifest.

IDs: S-1, S-2, S-8, S-12, S-20.

Landing zone layout (one JSON document per pull):
``comtrade_{code6}_{year}_{yyyymmdd}.json`` = ``{"data": [record, ...], ...}``.
The newest stamp per (code, year) wins.  The choice is made on the *file
list* (names only, from the file system listing) before any row is read,
so superseded snapshots cost nothing.  The strict name pattern also keeps
the competitor cache (``comtrade_benchmark_...``) out (trap T-8).
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelens.params import SNAPSHOT_FILE_PATTERN
from tradelens.session import list_files, path_exists

RECORD = T.StructType([
    T.StructField("refYear", T.IntegerType()),
    T.StructField("refMonth", T.IntegerType()),
    T.StructField("partnerCode", T.IntegerType()),
    T.StructField("partnerDesc", T.StringType()),
    T.StructField("reporterDesc", T.StringType()),
    T.StructField("cmdCode", T.StringType()),
    T.StructField("cmdDesc", T.StringType()),
    T.StructField("primaryValue", T.StringType()),   # coerced later (P-4)
    T.StructField("qty", T.StringType()),
])
DOCUMENT = T.StructType([
    T.StructField("data", T.ArrayType(RECORD)),
    T.StructField("_corrupt_record", T.StringType()),
])


def snapshot_files(spark: SparkSession, raw_dir: str,
                   pattern: str = SNAPSHOT_FILE_PATTERN) -> DataFrame:
    """File names in the landing folder parsed into (file, code, year, stamp).

    The listing is metadata (one entry per landed file), not data rows."""
    rx = re.compile(pattern)
    rows = []
    for name in list_files(spark, raw_dir):
        m = rx.match(name)
        if m:
            rows.append((name, m.group(1), int(m.group(2)), m.group(3)))
    return spark.createDataFrame(rows, "file string, code string, year int, stamp string")


def latest_snapshots(files: DataFrame) -> DataFrame:
    """S-2: the greatest stamp per (code, year) -- grouped max of a struct."""
    best = F.max(F.struct("stamp", "file"))
    return (files.groupBy("code", "year").agg(best.alias("__b"))
                 .select("code", "year", F.col("__b.stamp").alias("stamp"),
                         F.col("__b.file").alias("file")))


def read_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """S-1: read documents with an explicit schema; malformed files are kept
    as rows with ``_corrupt_record`` set (PERMISSIVE) instead of failing."""
    return (spark.read.schema(DOCUMENT).option("multiLine", True)
                 .option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", "_corrupt_record")
                 .json(paths)
                 .select(F.col("_metadata.file_name").alias("__file"), "data", "_corrupt_record"))


def flatten_documents(docs: DataFrame) -> DataFrame:
    """S-1: one row per record with its (file, position) as a tie-free input
    order; malformed and empty documents yield no rows."""
    ok = docs.filter(F.col("_corrupt_record").isNull() & F.col("data").isNotNull())
    return ok.select("__file", F.posexplode("data").alias("__pos", "r")).select(
        "__file", "__pos", "r.*")


def rejected_documents(docs: DataFrame) -> DataFrame:
    """Malformed files, for the warning report.  (The parsed ``data`` column is
    referenced too: Spark refuses queries over the corrupt-record column
    alone, since it would have to re-parse the files.)"""
    return (docs.filter(F.col("_corrupt_record").isNotNull() & F.col("data").isNull())
                .groupBy("__file").agg(F.count("*").alias("bad_records")))


def load_latest(spark: SparkSession, raw_dir: str) -> tuple[DataFrame, DataFrame]:
    """S-1 + S-2: newest snapshot per (code, year) -> flat records, rejects.

    Raises when no snapshot file exists or every chosen file is empty."""
    chosen = latest_snapshots(snapshot_files(spark, raw_dir))
    names = [r["file"] for r in chosen.select("file").collect()]  # file names, not rows
    if not names:
        raise FileNotFoundError(f"no raw snapshot files under {raw_dir}")
    docs = read_documents(spark, [f"{raw_dir.rstrip('/')}/{n}" for n in names])
    flat = flatten_documents(docs)
    if flat.limit(1).count() == 0:
        raise ValueError("every raw snapshot is empty or malformed")
    return flat, rejected_documents(docs)


def competitor_panel(spark: SparkSession, cache_dir: str,
                     pattern: str = r"^comtrade_benchmark_(.+)_(\d{6})_(\d{4})\.json$") -> DataFrame:
    """S-8: competitor records from cached documents with the reference's
    defaults: year and code fall back to the file name, value/qty to 0."""
    rx = re.compile(pattern)
    files = [(n, *rx.match(n).groups()) for n in list_files(spark, cache_dir) if rx.match(n)]
    if not files:
        return spark.createDataFrame([], "reporter string, year int, code string, partner_code int, "
                                         "fob_usd double, quantity_kg double")
    meta = spark.createDataFrame(files, "__file string, reporter string, code string, year string")
    docs = read_documents(spark, [f"{cache_dir.rstrip('/')}/{f[0]}" for f in files])
    flat = flatten_documents(docs).join(F.broadcast(meta), "__file")
    return flat.select(
        "reporter",
        F.coalesce(F.col("refYear"), F.col("year").cast("int")).alias("year"),
        F.coalesce(F.col("cmdCode"), F.col("code")).alias("code"),
        F.col("partnerCode").alias("partner_code"),
        F.coalesce(F.col("primaryValue").try_cast("double"), F.lit(0.0)).alias("fob_usd"),
        F.coalesce(F.col("qty").try_cast("double"), F.lit(0.0)).alias("quantity_kg"))


def land_records(records: DataFrame, landing_dir: str, code: str, year: int, stamp: str) -> str:
    """S-12: land one pull as the document ``comtrade_{code}_{year}_{stamp}.json``
    that S-1 reads; never overwrites, so history is immutable.

    One pull is one answer of the statistics API, which limits its size, so it is
    one document.  It is written aside (Spark's listings skip the ``_`` folder) and
    renamed when complete."""
    spark = records.sparkSession
    base = landing_dir.rstrip("/")
    target = f"{base}/comtrade_{code}_{year}_{stamp}.json"
    if path_exists(spark, target):
        raise FileExistsError(target)
    aside = f"{base}/_landing-{uuid.uuid4().hex}"
    rows = F.collect_list(F.struct(*[F.col(c) for c in records.columns]))
    records.agg(rows.alias("data")).coalesce(1).write.json(aside)
    part = next(n for n in list_files(spark, aside) if n.startswith("part-"))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(path(f"{aside}/{part}"), path(target)):
        raise FileExistsError(target)
    fs.delete(path(aside), True)
    return target


def landing_manifest(files: DataFrame, docs: DataFrame, expected: DataFrame) -> DataFrame:
    """S-20: (code, year, rows, status) of every expected (code, year).

    By the file list, so that documents without records are seen: MISSING (no file),
    FAILED (the newest document is malformed), EMPTY (no records) or OK.  ``files`` is
    ``snapshot_files``, ``docs`` their ``read_documents``."""
    per_doc = docs.groupBy("__file").agg(
        F.sum(F.size(F.coalesce("data", F.array().cast(DOCUMENT["data"].dataType)))).alias("rows"),
        F.max(F.col("_corrupt_record").isNotNull() & F.col("data").isNull()).alias("bad"))
    newest = latest_snapshots(files).select("code", "year", F.col("file").alias("__file"))
    j = expected.join(newest.join(per_doc, "__file", "left"), ["code", "year"], "left")
    status = (F.when(F.col("__file").isNull(), "MISSING").when(F.col("bad"), "FAILED")
               .when(F.coalesce("rows", F.lit(0)) == 0, "EMPTY").otherwise("OK"))
    return j.select("code", "year", F.coalesce("rows", F.lit(0)).alias("rows"), status.alias("status"))


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """S-20: documents and records per status."""
    return manifest.groupBy("status").agg(F.count("*").alias("documents"), F.sum("rows").alias("rows"))
