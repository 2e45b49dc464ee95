"""Cleaning chain: raw trade records -> canonical clean table.

IDs: P-1..P-10, J-4, W-1, A-12, A-25.  Each step is ``DataFrame -> DataFrame``
so the chain composes with ``df.transform``; counters come from ONE
aggregate over a ``reject_reason`` column instead of a count per step.

Scale notes
* Aggregate-partner and name-override lookups are fixed, bounded tables
  (tens of rows) and are broadcast; the ISO reference table is bounded by
  the number of countries (< 300) and is broadcast too.
* De-duplication keeps the *first* row per key with a grouped ``min`` over
  ``struct(order..., payload...)``: partial aggregation collapses a hot key
  to one row per map task before the shuffle, so a key holding a third of
  all rows never lands whole in one task (a ``row_number`` window would).
* The outlier threshold is an exact per-group percentile that gathers no group
  (``functions.quantiles``); ``approx_accuracy`` takes the ``percentile_approx``
  sketch instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.functions.dates import calendar_columns, month_from_parts
from tradelens.functions.numeric import coerce_double, unit_price
from tradelens.functions.quantiles import group_quantiles
from tradelens.functions.stats import measured
from tradelens.params import CleanParams

CANONICAL_COLUMNS = (
    "shipment_date", "year", "month", "quarter", "financial_year", "is_peak_season",
    "hs_code", "hs_desc", "dest_iso_alpha3", "dest_country_name",
    "reporter_country_name", "fob_usd", "quantity_kg", "unit_price_usd",
    "is_outlier", "source",
)

# Types of the canonical clean table (used to read partitioned copies without
# partition-value type inference, which would turn '044209' into 44209).
CLEAN_SCHEMA = ("shipment_date date, year int, month int, quarter int, financial_year string, "
                "is_peak_season boolean, hs_code string, hs_desc string, "
                "dest_iso_alpha3 string, dest_country_name string, "
                "reporter_country_name string, fob_usd double, quantity_kg double, "
                "unit_price_usd double, is_outlier boolean, source string")

RAW_RENAMES = {
    "cmdCode": "hs_code",
    "cmdDesc": "hs_desc",
    "primaryValue": "fob_usd",
    "qty": "quantity_kg",
    "partnerDesc": "dest_country_name",
    "reporterDesc": "reporter_country_name",
}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- P-1 / P-2 / P-3 / P-4 -------------------------------------------------

def with_shipment_date(df: DataFrame, year_col: str = "refYear",
                       month_col: str = "refMonth", out: str = "shipment_date") -> DataFrame:
    """P-1: first-of-month date; month 52 (annual rows) and bad parts -> NULL."""
    return df.withColumn(out, month_from_parts(F.col(year_col).try_cast("int"),
                                               F.col(month_col).try_cast("int")))


def not_aggregate_partner(code_col, codes) -> Column:
    """P-2 predicate: code not in the aggregate set; NULL codes are KEPT."""
    return ~F.coalesce(_c(code_col).isin(list(codes)), F.lit(False))


def drop_aggregate_partners(df: DataFrame, code_col: str, codes) -> DataFrame:
    return df.filter(not_aggregate_partner(code_col, codes))


def rename_canonical(df: DataFrame, renames: dict[str, str] = RAW_RENAMES) -> DataFrame:
    """P-3: rename raw fields to canonical names (absent fields are skipped)."""
    present = {k: v for k, v in renames.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """P-4: coercing numeric cast of each column (bad text -> NULL)."""
    return df.withColumns({c: coerce_double(c) for c in cols})


# --- J-4: names -> ISO with an override table -------------------------------

def overrides_frame(spark: SparkSession, overrides: dict[str, str | None]) -> DataFrame:
    rows = [(k, v) for k, v in overrides.items()]
    return spark.createDataFrame(rows, "source_name string, standard_name string")


def map_names_to_iso(df: DataFrame, name_col: str, overrides: DataFrame,
                     iso_table: DataFrame, out: str = "dest_iso_alpha3") -> DataFrame:
    """J-4: name -> (override) -> ISO code.

    ``overrides(source_name, standard_name)``: a NULL standard_name means
    "drop, not a country".  ``iso_table(name, iso)`` is the reference list.
    Adds ``out`` (NULL when unmapped or dropped) and ``name_status`` in
    {'mapped', 'dropped', 'unmapped'}.  Both lookup tables are bounded
    (override list, country list) and broadcast.
    """
    ov = F.broadcast(overrides.select(F.col("source_name").alias("__src"),
                                      F.col("standard_name").alias("__std"),
                                      F.lit(True).alias("__has_ov")))
    iso = F.broadcast(iso_table.select(F.col("name").alias("__iso_name"),
                                       F.col("iso").alias(out)))
    step = (df.join(ov, F.col(name_col) == F.col("__src"), "left")
              .withColumn("__lookup", F.when(F.col("__has_ov"), F.col("__std"))
                                       .otherwise(F.col(name_col))))
    res = step.join(iso, F.col("__lookup") == F.col("__iso_name"), "left")
    status = (F.when(F.col(out).isNotNull(), F.lit("mapped"))
               .when(F.col("__has_ov") & F.col("__std").isNull(), F.lit("dropped"))
               .otherwise(F.lit("unmapped")))
    return res.withColumn("name_status", status).drop(
        "__src", "__std", "__has_ov", "__lookup", "__iso_name")


def unmapped_names(mapped: DataFrame, name_col: str, iso_col: str = "dest_iso_alpha3") -> DataFrame:
    """J-4 report: every non-NULL name without an ISO code, incl. broken overrides."""
    return (mapped.filter(F.col(iso_col).isNull() & F.col(name_col).isNotNull()
                          & (F.col("name_status") == "unmapped"))
                  .groupBy(F.col(name_col).alias("name"))
                  .agg(F.count("*").alias("n_rows")))


# --- P-5 / P-6 / P-7 / P-8 ----------------------------------------------------

def validity_reason(date_col="shipment_date", value_col="fob_usd", qty_col="quantity_kg") -> Column:
    """P-5 as a reason column: NULL when the row is valid."""
    d, v, q = F.col(date_col), F.col(value_col), F.col(qty_col)
    return (F.when(d.isNull(), F.lit("null_date"))
             .when(v.isNull(), F.lit("null_value"))
             .when(v <= 0, F.lit("non_positive_value"))
             .when(q.isNull(), F.lit("null_qty"))
             .when(q <= 0, F.lit("non_positive_qty")))


def valid_rows(df: DataFrame, date_col="shipment_date", value_col="fob_usd",
               qty_col="quantity_kg") -> DataFrame:
    """P-5: date, value and qty present and value, qty > 0."""
    return df.filter(validity_reason(date_col, value_col, qty_col).isNull())


def with_unit_price(df: DataFrame, value_col="fob_usd", qty_col="quantity_kg",
                    out="unit_price_usd", scale: int = 4) -> DataFrame:
    """P-6: unit price rounded to ``scale`` dp (half-up, see trap T-3)."""
    return df.withColumn(out, unit_price(value_col, qty_col, scale))


def with_calendar(df: DataFrame, date_col="shipment_date", params=CleanParams()) -> DataFrame:
    """P-7: year, month, quarter, financial year, peak flag."""
    return df.withColumns(calendar_columns(date_col, params.peak_months))


# --- W-1: keep-first de-duplication -----------------------------------------

def dedupe_keep_first(df: DataFrame, keys, order_cols) -> DataFrame:
    """W-1: one row per key, the first by ``order_cols`` (must be tie-free).

    Grouped min over a struct led by the order columns: deterministic, and
    skew-safe thanks to partial aggregation (see module docstring).
    """
    keys = list(keys)
    order_cols = list(order_cols)
    payload = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order_cols)],
                      *[F.col(c) for c in payload])
    first = df.groupBy(*keys).agg(F.min(packed).alias("__first"))
    out = first.select(*keys, *[F.col(f"__first.__o{i}").alias(c) for i, c in enumerate(order_cols)],
                       *[F.col(f"__first.{c}").alias(c) for c in payload])
    return out.select(*df.columns)


def dedupe_counts(valid: DataFrame, keys) -> DataFrame:
    """A-25 for W-1: (kept, duplicate) row counts as one row -- per-key counts
    with partial aggregation, no row identity needed (exact duplicates
    included)."""
    per_key = valid.groupBy(*list(keys)).agg(F.count("*").alias("__n"))
    return per_key.agg(F.count("*").alias("kept"),
                       (F.sum("__n") - F.count("*")).alias("duplicate"))


def duplicate_flag(df: DataFrame, keys, order_cols, out="is_duplicate") -> DataFrame:
    """W-1 as a row flag: every row but the first of its key.  ``order_cols``
    must be tie-free within a key (rows tying with the first are not
    flagged); use ``dedupe_counts`` for counters."""
    keys, order_cols = list(keys), list(order_cols)
    firsts = (df.groupBy(*keys)
                .agg(F.min(F.struct(*order_cols)).alias("__first")))
    joined = df.join(firsts, keys, "left")
    is_first = F.struct(*[F.col(c) for c in order_cols]) == F.col("__first")
    return joined.withColumn(out, ~is_first).drop("__first")


# --- A-12: outlier flag ---------------------------------------------------------

def outlier_thresholds(df: DataFrame, group_col: str, price_col: str,
                       quantile: float = 0.99, min_rows: int = 20,
                       approx_accuracy: int | None = None) -> DataFrame:
    """Per group: row count and the exact ``quantile`` of price (NULL below ``min_rows``
    rows).  ``approx_accuracy``: the mergeable ``percentile_approx`` sketch instead
    (bounded memory, not exact)."""
    x = F.col(price_col).cast("double")
    if approx_accuracy:
        thr = df.groupBy(group_col).agg(
            F.count("*").alias("group_rows"),
            F.percentile_approx(x, quantile, approx_accuracy).alias("threshold"))
    else:
        thr = group_quantiles(df, [group_col], price_col, {"threshold": quantile},
                              count_col="group_rows")
    return thr.withColumn("threshold", F.when(F.col("group_rows") >= min_rows,
                                              F.col("threshold")))


def flag_outliers(df: DataFrame, group_col: str, price_col: str, out: str = "is_outlier",
                  quantile: float = 0.99, min_rows: int = 20,
                  approx_accuracy: int | None = None) -> DataFrame:
    """A-12: price strictly above the group's quantile, only for groups >= min_rows.

    The thresholds (one row per group) are written and read back, so the join
    back is planned by their measured size: no hint, and no shuffle of the rows
    while the thresholds fit the broadcast threshold.
    """
    thr = measured(outlier_thresholds(df, group_col, price_col, quantile, min_rows,
                                      approx_accuracy), "outlier-thresholds")
    thr = thr.select(F.col(group_col).alias("__group"), "threshold")
    return (df.join(thr, F.col(group_col).eqNullSafe(F.col("__group")), "left")
              .withColumn(out, F.coalesce(F.col(price_col) > F.col("threshold"), F.lit(False)))
              .drop("threshold", "__group"))


# --- A-25: one-pass counters ----------------------------------------------------

def reject_counts(df: DataFrame, reason_col: str = "reject_reason") -> DataFrame:
    """A-25: rows per reject reason ('kept' for survivors) in ONE aggregate."""
    return (df.groupBy(F.coalesce(F.col(reason_col), F.lit("kept")).alias("reason"))
              .agg(F.count("*").alias("n_rows")))


NULL_REASONS = ("null_date", "null_value", "non_positive_value", "null_qty", "non_positive_qty")


def clean_report(tagged: DataFrame, clean: DataFrame, reason_col: str = "reject_reason",
                 outlier_col: str = "is_outlier") -> DataFrame:
    """A-25: the CleanReport counters as one row.

    One aggregate over the tagged input (reasons) and one over the clean
    output (rows out, outliers); de-duplicated = valid - out.
    """
    r = F.col(reason_col)
    ins = tagged.agg(
        F.count("*").alias("rows_in"),
        F.count_if(r == "aggregate_partner").alias("rows_dropped_aggregate"),
        F.count_if(r.isin(*NULL_REASONS)).alias("rows_dropped_null"),
        F.count_if(r.isNull()).alias("__valid"))
    outs = clean.agg(F.count("*").alias("rows_out"),
                     F.count_if(F.col(outlier_col)).alias("rows_outlier_flagged"))
    return (ins.crossJoin(outs)
               .withColumn("rows_deduped", F.col("__valid") - F.col("rows_out"))
               .select("rows_in", "rows_dropped_aggregate", "rows_dropped_null",
                       "rows_deduped", "rows_outlier_flagged", "rows_out"))


# --- Full chain -----------------------------------------------------------------

def tag_records(flat: DataFrame, iso_table: DataFrame, overrides: DataFrame,
                params: CleanParams = CleanParams()) -> DataFrame:
    """Raw flattened records -> every row kept, with a ``reject_reason``
    (NULL = valid) and the derived columns (date, ISO, price, calendar)."""
    df = with_shipment_date(flat)
    df = df.withColumn("partnerCode", F.col("partnerCode").try_cast("int"))
    df = map_names_to_iso(df, "partnerDesc", overrides, iso_table)
    df = rename_canonical(df)
    df = coerce_numeric(df, ["fob_usd", "quantity_kg"])
    reason = (F.when(~not_aggregate_partner("partnerCode", params.aggregate_codes),
                     F.lit("aggregate_partner"))
               .when(F.col("dest_iso_alpha3").isNull(), F.lit("aggregate_partner"))
               .otherwise(validity_reason()))
    df = df.withColumn("reject_reason", reason)
    df = with_unit_price(df, scale=params.price_scale)
    return with_calendar(df, params=params)


def clean_from_tagged(tagged: DataFrame, params: CleanParams = CleanParams(),
                      order_cols=("__file", "__pos")) -> DataFrame:
    """Valid rows -> keep-first dedupe -> outlier flag -> source -> projection."""
    df = tagged.filter(F.col("reject_reason").isNull())
    df = dedupe_keep_first(df, params.dedupe_keys, order_cols)
    df = flag_outliers(df, "hs_code", "unit_price_usd", quantile=params.outlier_quantile,
                       min_rows=params.outlier_min_rows)
    df = df.withColumn("source", F.lit(params.source_tag))
    return canonical_projection(df)


def clean_records(flat: DataFrame, iso_table: DataFrame, overrides: DataFrame,
                  params: CleanParams = CleanParams(), order_cols=("__file", "__pos")
                  ) -> DataFrame:
    """Flattened raw records -> canonical clean table (S-1 output in, P-10 out).

    ``flat`` carries the raw fields plus tie-free input-order columns
    (``order_cols``, e.g. file name and position in file) used by the
    keep-first de-duplication.
    """
    return clean_from_tagged(tag_records(flat, iso_table, overrides, params), params, order_cols)


def canonical_projection(df: DataFrame) -> DataFrame:
    """P-10: canonical columns in order (absent ones skipped), sorted within
    partitions by (date, product, destination) for min/max skipping on write."""
    keep = [c for c in CANONICAL_COLUMNS if c in df.columns]
    sort_cols = [c for c in ("shipment_date", "hs_code", "dest_iso_alpha3") if c in keep]
    return df.select(*keep).sortWithinPartitions(*sort_cols)
