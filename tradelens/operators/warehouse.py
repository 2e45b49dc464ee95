"""Star schema on files: dimensions, surrogate keys, upserts, versioned tables.

IDs: K-1..K-6, J-1..J-3, A-1, A-2, S-13..S-19, Q-9 publish step.

Plain Parquet has no MERGE, so every write produces a new immutable version
directory ``<root>/<table>/v=<n>/`` and then publishes a pointer record
``<root>/<table>/_published/n=<n>`` (the data folders of that version);
readers take the highest complete pointer.  A failed or
interrupted job never touches the published version (the reference's
truncate-then-insert can leave an empty fact).  Single writer per table is
assumed, as in the reference's weekly job.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradelens.functions.dates import calendar_columns, date_key
from tradelens.session import list_files, path_exists


# --- K-1: calendar ----------------------------------------------------------------

def calendar_dimension(span: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """K-1: one row per day between ``lo`` and ``hi`` (a 1-row frame).

    Columns: time_id (yyyymmdd INT), date, year, month, quarter,
    financial_year, is_peak_season, iso_week.
    """
    days = span.select(F.explode(F.sequence(F.col(lo), F.col(hi))).alias("date"))
    cal = calendar_columns("date")
    return days.select(date_key("date").alias("time_id"), "date",
                       cal["year"].alias("year"), cal["month"].alias("month"),
                       cal["quarter"].alias("quarter"),
                       cal["financial_year"].alias("financial_year"),
                       cal["is_peak_season"].alias("is_peak_season"),
                       F.weekofyear("date").alias("iso_week"))


def calendar_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    span = spark.range(1).select(F.to_date(F.lit(start)).alias("lo"),
                                 F.to_date(F.lit(end)).alias("hi"))
    return calendar_dimension(span)


# --- K-2 / K-3 / K-4: dimensions and surrogate keys --------------------------------

def first_name_per_key(df: DataFrame, key: str, name: str, order_col: str,
                       out_name: str = "country_name") -> DataFrame:
    """K-2: one deterministic name per key -- the name of the earliest row
    (ties broken by the name itself).  Grouped ``min`` of a struct: partial
    aggregation keeps hot keys cheap."""
    first = F.min(F.struct(F.col(order_col), F.col(name)))
    return df.groupBy(key).agg(first.getField(name).alias(out_name))


def assign_surrogate_keys(new_keys: DataFrame, key_cols, id_col: str,
                          offset: int | DataFrame = 0) -> DataFrame:
    """Dense ids offset+1..offset+n in key order, computed distributed and
    JVM-side.

    The keys are range-partitioned (sampled bounds, so partitions hold
    ordered, disjoint key ranges); a tiny per-partition count table gives
    each partition its starting offset; a row number *within* a partition
    (a window bounded by the partition, not by the key set) completes the
    id.  No single-task window, no Python round trip.
    ``offset`` may be a 1-row frame with column ``max_id``.
    """
    key_cols = list(key_cols)
    spark = new_keys.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (new_keys.select(*key_cols).distinct()
                      .repartitionByRange(n_parts, *key_cols)
                      .withColumn("__pid", F.spark_partition_id()))
    counts = ranged.groupBy("__pid").agg(F.count("*").alias("__cnt"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__pid", F.coalesce(F.sum("__cnt").over(before), F.lit(0))
                           .alias("__start"))  # one row per partition: bounded
    within = Window.partitionBy("__pid").orderBy(*key_cols)
    indexed = (ranged.withColumn("__idx", F.row_number().over(within) - 1)
                     .join(F.broadcast(starts), "__pid"))
    if isinstance(offset, DataFrame):
        indexed = indexed.crossJoin(F.broadcast(offset.select(
            F.coalesce(F.col("max_id"), F.lit(0)).cast("long").alias("__off"))))
    else:
        indexed = indexed.withColumn("__off", F.lit(int(offset)).cast("long"))
    return indexed.select(*key_cols, (F.col("__off") + F.col("__start") + F.col("__idx") + 1)
                          .cast("long").alias(id_col))


def extend_dimension(existing: DataFrame, candidates: DataFrame, key_cols, id_col: str
                     ) -> DataFrame:
    """K-4: existing keys keep their ids, new keys get max(id)+1.. in key order."""
    key_cols = list(key_cols)
    new = candidates.select(*key_cols).distinct().join(existing.select(*key_cols), key_cols,
                                                        "left_anti")
    max_id = existing.agg(F.max(id_col).alias("max_id"))
    added = assign_surrogate_keys(new, key_cols, id_col, max_id)
    return existing.select(*key_cols, id_col).unionByName(added)


# --- S-14 / S-15 / S-16: upserts ---------------------------------------------------

def upsert(target: DataFrame, updates: DataFrame, keys, update_cols=None,
           status_col: str | None = None) -> DataFrame:
    """S-14: INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols = new.

    Full outer join on the natural key: matched rows take the update's
    values for ``update_cols`` (even NULL, as EXCLUDED.c does) and keep the
    target's other columns; new keys are inserted; other target rows stay.
    """
    keys = list(keys)
    cols = [c for c in target.columns if c not in keys]
    update_cols = list(update_cols) if update_cols is not None else [
        c for c in cols if c in updates.columns]
    t = target.select(*keys, *[F.col(c).alias(f"__t_{c}") for c in cols],
                      F.lit(True).alias("__t"))
    u = updates.select(*keys, *[F.col(c).alias(f"__u_{c}") for c in cols if c in updates.columns],
                       F.lit(True).alias("__u"))
    j = t.join(u, keys, "full_outer")
    out = []
    for c in cols:
        if c in update_cols:
            out.append(F.when(F.col("__u"), F.col(f"__u_{c}")).otherwise(F.col(f"__t_{c}")).alias(c))
        elif c in updates.columns:
            out.append(F.when(F.col("__t"), F.col(f"__t_{c}")).otherwise(F.col(f"__u_{c}")).alias(c))
        else:
            out.append(F.col(f"__t_{c}").alias(c))
    sel = [*keys, *out]
    if status_col:
        sel.append(F.when(F.col("__t") & F.col("__u"), "updated")
                    .when(F.col("__u"), "inserted").otherwise("kept").alias(status_col))
    return j.select(*sel)


def insert_absent(target: DataFrame, updates: DataFrame, keys) -> DataFrame:
    """S-15: INSERT ... ON CONFLICT DO NOTHING = target + (updates anti target)."""
    keys = list(keys)
    new = updates.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new.select(*target.columns))


def write_back_labels(target: DataFrame, labels: DataFrame, key: str, label_col: str
                      ) -> DataFrame:
    """S-16: UPDATE target SET label = new WHERE key in scored keys."""
    lab = labels.select(F.col(key), F.col(label_col).alias("__new"), F.lit(True).alias("__hit"))
    return (target.join(lab, key, "left")
                  .withColumn(label_col, F.when(F.col("__hit"), F.col("__new"))
                                          .otherwise(F.col(label_col)))
                  .drop("__new", "__hit"))


def buyer_dimension(scored: DataFrame, countries: DataFrame, key: str, name_col: str,
                    country_id_col: str = "country_id") -> DataFrame:
    """K-5: one '<name> Market' BUYER row per scored key with a country id."""
    j = scored.select(key).distinct().join(countries.select(key, name_col, country_id_col), key)
    return j.select(F.concat(F.col(name_col), F.lit(" Market")).alias("company_name"),
                    F.lit("BUYER").alias("company_type"), country_id_col)


# --- J-2: FK resolution with a gate ------------------------------------------------

def resolve_foreign_keys(fact: DataFrame, lookups: list[tuple[DataFrame, str, str]]
                         ) -> tuple[DataFrame, DataFrame]:
    """J-2: left-join each (dim, natural_key, id_col); return (resolved, check).

    ``check`` is ONE aggregate with the NULL count of every id column; call
    ``assert_resolved(check)`` before loading (the reference raises).
    """
    out = fact
    for dim, nat, id_col in lookups:
        out = out.join(dim.select(nat, id_col), nat, "left")
    check = out.agg(F.count("*").alias("rows"),
                    *[F.count_if(F.col(i).isNull()).alias(f"null_{i}") for _, _, i in lookups])
    return out, check


def assert_resolved(check: DataFrame) -> dict:
    row = check.first().asDict()
    bad = {k: v for k, v in row.items() if k.startswith("null_") and v}
    if bad:
        raise ValueError(f"unresolved foreign keys: {bad}")
    return row


# --- A-1 / A-2 / J-3: analytical views ---------------------------------------------

def monthly_export_view(fact: DataFrame, countries: DataFrame, products: DataFrame,
                        date_col="shipment_date", value_col="fob_usd", qty_col="quantity_kg",
                        price_col="unit_price_usd") -> DataFrame:
    """A-1: (month, iso, name, code, category) -> sums, unweighted avg price, count.

    Prices carry 4 dp, so their mean is taken as an exact DECIMAL sum over a
    count (order-independent, identical on every engine).  The fact is
    aggregated by (month, country_id, product_id) first: the dimensions join
    one row per id pair and month, not every shipment.
    """
    ids = (fact.groupBy(F.trunc(date_col, "month").alias("month"), "country_id", "product_id")
               .agg(F.sum(value_col).alias("__value"), F.sum(qty_col).alias("__qty"),
                    F.sum(F.col(price_col).cast("decimal(18,4)")).alias("__price"),
                    F.count(price_col).alias("__priced"), F.count("*").alias("__n")))
    j = ids.join(countries, "country_id").join(products, "product_id")
    return (j.groupBy("month", "iso_alpha3", "country_name", "hs_code", "category")
             .agg(F.sum("__value").alias("total_fob_usd"),
                  F.sum("__qty").alias("total_quantity_kg"),
                  F.try_divide(F.sum("__price").cast("double"), F.sum("__priced"))
                   .alias("avg_unit_price_usd"),
                  F.sum("__n").alias("shipment_count")))


def risk_register_view(companies: DataFrame, countries: DataFrame, fact: DataFrame,
                       as_of: str, buyer_col="buyer_id", date_col="shipment_date",
                       value_col="fob_usd") -> DataFrame:
    """A-2 / J-3: BUYER companies with a score, last-12-month value and count.

    ``as_of`` replaces CURRENT_DATE so results are reproducible.  The fact
    is pre-aggregated per buyer *before* the join (filtered sums), so the
    join sees one row per buyer instead of every shipment.
    """
    since = F.add_months(F.to_date(F.lit(as_of)), -12)
    recent = F.col(date_col) >= since
    per_buyer = (fact.groupBy(F.col(buyer_col).alias("company_id"))
                     .agg(F.sum(F.when(recent, F.col(value_col))).alias("fob_last_12m"),
                          F.count_if(recent).alias("shipments_last_12m")))
    c = companies.filter((F.col("company_type") == "BUYER") & F.col("risk_score").isNotNull())
    j = (c.join(countries.select("country_id", F.col("country_name").alias("buyer_country")),
                "country_id", "left")
          .join(per_buyer, "company_id", "left"))
    return j.select("company_id", "company_name", "buyer_country", "risk_score",
                    "avg_payment_days", "fob_last_12m",
                    F.coalesce("shipments_last_12m", F.lit(0)).alias("shipments_last_12m"))


# --- S-13 / S-17 / S-19: versioned tables, audit, status ---------------------------

def _versions(spark: SparkSession, table_dir: str) -> list[int]:
    """Data version folders v=<n> (published or not)."""
    out = []
    for name in list_files(spark, table_dir):
        if name.startswith("v="):
            try:
                out.append(int(name[2:]))
            except ValueError:
                pass
    return sorted(out)


def _published(spark: SparkSession, root: str, table: str) -> list[int]:
    """Versions whose pointer record is completely written (has _SUCCESS)."""
    base = f"{root}/{table}/_published"
    out = []
    for name in list_files(spark, base):
        if name.startswith("n=") and path_exists(spark, f"{base}/{name}/_SUCCESS"):
            out.append(int(name[2:]))
    return sorted(out)


def current_version(spark: SparkSession, root: str, table: str) -> int | None:
    pub = _published(spark, root, table)
    return pub[-1] if pub else None


def _current_paths(spark: SparkSession, root: str, table: str) -> list[str]:
    v = current_version(spark, root, table)
    if v is None:
        return []
    row = spark.read.json(f"{root}/{table}/_published/n={v}").first()
    return list(row["paths"])


def write_version(df: DataFrame, root: str, table: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> int:
    """S-13: write a new version, then publish it with a new pointer record.

    ``mode='overwrite'``: the new version is exactly ``df`` (full replace).
    ``mode='append'``: only ``df`` is written; the new version is the previous
    version's data folders plus this one (cost grows with the appended rows,
    not with the table).
    Publishing never deletes or rewrites: each version gets its own pointer
    folder ``_published/n=<n>`` and readers take the highest complete one, so
    a crash mid-write leaves the last good version in place.
    """
    spark = df.sparkSession
    versions = _versions(spark, f"{root}/{table}")
    nxt = (max(versions) if versions else 0) + 1
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{root}/{table}/v={nxt}")
    paths = (_current_paths(spark, root, table) if mode == "append" else []) + [f"v={nxt}"]
    rec = spark.createDataFrame(
        [(nxt, paths, _dt.datetime.now(_dt.timezone.utc).isoformat())],
        "version int, paths array<string>, published_at string")
    rec.coalesce(1).write.mode("errorifexists").json(f"{root}/{table}/_published/n={nxt}")
    return nxt


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    paths = _current_paths(spark, root, table)
    if not paths:
        raise FileNotFoundError(f"table {table} has no published version under {root}")
    full = [f"{root}/{table}/{p}" for p in paths]
    return spark.read.option("mergeSchema", len(full) > 1).parquet(*full)


AUDIT_SCHEMA = ("run_id string, started_at timestamp, finished_at timestamp, status string, "
                "rows_ingested long, rows_loaded long, failed_step string, error_message string")


def append_audit(spark: SparkSession, root: str, record: dict) -> None:
    """S-17: append one audit row (append-only table, no versions needed)."""
    row = spark.createDataFrame([record], AUDIT_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{root}/pipeline_run")


def table_status(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """S-19: row count per expected table, 'missing' when absent.

    ``tables`` maps name -> parquet path.  Each count is a metadata-only
    Parquet count (footer statistics), so this stays cheap at any size.
    """
    rows = []
    for name, path in tables.items():
        if path_exists(spark, path):
            rows.append((name, "present", spark.read.parquet(path).count()))
        else:
            rows.append((name, "missing", None))
    return spark.createDataFrame(rows, "table_name string, status string, row_count long")
