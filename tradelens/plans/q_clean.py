"""Cleaning-chain queries bound to the test tables.

Stand-in rules on the trade fact (FIXTURES.md section 2): a returned line
('R') carries no value, and the quantity is shifted down by one so that
single-unit lines have zero quantity -- this exercises the validity rules
(P-5) with data-derived rejects rather than hand-picked ids.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tradelens.functions.numeric import fround

from tradelens.functions import dates as D
from tradelens.functions.dates import calendar_columns
from tradelens.functions.numeric import clip, coerce_double
from tradelens.functions.stats import measured
from tradelens.functions.text import millions, signed_pct
from tradelens.operators import clean as C
from tradelens.plans.registry import register
from tradelens.sources.tables import read_table, trade, with_trade

DEDUPE_KEYS = ("l_orderkey", "l_linenumber")
DEDUPE_ORDER = ("l_partkey", "l_suppkey")


def raw_trade(spark, sf_dir):
    """Trade rows in raw-ish form: nullable value, zero quantities possible."""
    t = trade(spark, sf_dir)
    return t.select(
        "shipment_date", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "product", "market", "market_key",
        F.when(F.col("l_returnflag") == "R", F.lit(None))
         .otherwise(F.col("value").cast("double")).alias("fob_usd"),
        (F.col("qty") - 1).alias("quantity_kg"))


RAW_TRADE_SQL = """
raw AS (SELECT shipment_date, l_orderkey, l_linenumber, l_partkey, l_suppkey, product, market,
               market_key,
               CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(value AS DOUBLE) END AS fob_usd,
               qty - 1 AS quantity_kg
        FROM trade)"""


@register("clean_dedupe", with_trade("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, market, CAST(value AS DOUBLE) AS value
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_partkey, l_suppkey, market, value) AS rn FROM trade)
WHERE rn = 1"""), ids=("W-1",))
def clean_dedupe(spark, sf_dir):
    """Keep-first by (l_partkey, l_suppkey); remaining ties are broken by the
    payload columns in order (the grouped struct minimum is a total order)."""
    t = trade(spark, sf_dir).select(*DEDUPE_KEYS, *DEDUPE_ORDER, "market",
                                    F.col("value").cast("double").alias("value"))
    return C.dedupe_keep_first(t, DEDUPE_KEYS, DEDUPE_ORDER)


@register("clean_valid_rows", with_trade("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, fob_usd, quantity_kg FROM raw
WHERE shipment_date IS NOT NULL AND fob_usd IS NOT NULL AND fob_usd > 0
  AND quantity_kg IS NOT NULL AND quantity_kg > 0""", RAW_TRADE_SQL), ids=("P-5",))
def clean_valid_rows(spark, sf_dir):
    v = C.valid_rows(raw_trade(spark, sf_dir))
    return v.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "fob_usd",
                    "quantity_kg")


@register("clean_reject_counts", with_trade("""
SELECT reason, count(*) AS n_rows FROM (
  SELECT CASE WHEN reason IS NOT NULL THEN reason
              WHEN row_number() OVER (PARTITION BY l_orderkey, l_linenumber, reason IS NULL
                                      ORDER BY l_partkey, l_suppkey) > 1 THEN 'duplicate'
              ELSE 'kept' END AS reason
  FROM (SELECT *, CASE WHEN shipment_date IS NULL THEN 'null_date'
                       WHEN fob_usd IS NULL THEN 'null_value'
                       WHEN fob_usd <= 0 THEN 'non_positive_value'
                       WHEN quantity_kg IS NULL THEN 'null_qty'
                       WHEN quantity_kg <= 0 THEN 'non_positive_qty' END AS reason
        FROM raw))
GROUP BY reason""", RAW_TRADE_SQL), ids=("A-25", "P-5", "W-1"))
def clean_reject_counts(spark, sf_dir):
    """One aggregate of reject reasons + per-key counts for duplicates."""
    raw = raw_trade(spark, sf_dir).withColumn("reject_reason", C.validity_reason())
    invalid = C.reject_counts(raw.filter(F.col("reject_reason").isNotNull()))
    dd = C.dedupe_counts(raw.filter(F.col("reject_reason").isNull()), DEDUPE_KEYS)
    valid = dd.select(F.explode(F.array(
        F.struct(F.lit("kept").alias("reason"), F.col("kept").alias("n_rows")),
        F.struct(F.lit("duplicate").alias("reason"), F.col("duplicate").alias("n_rows"))))
        .alias("r")).select("r.*")
    return invalid.unionByName(valid).filter(F.col("n_rows") > 0)


@register("drop_aggregate_partners", with_trade("""
SELECT partner_code, count(*) AS n_rows
FROM (SELECT nullif(market_key, 7) AS partner_code FROM trade)
WHERE NOT coalesce(partner_code IN (0, 5, 10), false)
GROUP BY partner_code"""), ids=("P-2",))
def drop_aggregate_partners(spark, sf_dir):
    t = trade(spark, sf_dir).select(
        F.when(F.col("market_key") != 7, F.col("market_key")).alias("partner_code"))
    kept = C.drop_aggregate_partners(t, "partner_code", (0, 5, 10))
    return kept.groupBy("partner_code").agg(F.count("*").alias("n_rows"))


@register("calendar_features", """
SELECT d AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(quarter(d) AS INTEGER) AS quarter,
       printf('FY%02d-%02d', (year(d) - CASE WHEN month(d) < 4 THEN 1 ELSE 0 END) % 100,
              (year(d) - CASE WHEN month(d) < 4 THEN 1 ELSE 0 END + 1) % 100) AS financial_year,
       month(d) IN (9, 10, 11) AS is_peak_season
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)""", ids=("P-7",))
def calendar_features(spark, sf_dir):
    d = (read_table(spark, sf_dir, "lineitem")
         .select(F.to_date("l_shipdate").alias("date")).distinct())
    return d.select("date", *[v.alias(k) for k, v in calendar_columns("date").items()])


@register("dim_time", """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS time_id, d AS date,
       CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(quarter(d) AS INTEGER) AS quarter,
       printf('FY%02d-%02d', (year(d) - CASE WHEN month(d) < 4 THEN 1 ELSE 0 END) % 100,
              (year(d) - CASE WHEN month(d) < 4 THEN 1 ELSE 0 END + 1) % 100) AS financial_year,
       month(d) IN (9, 10, 11) AS is_peak_season, CAST(weekofyear(d) AS INTEGER) AS iso_week
FROM (SELECT CAST(unnest(generate_series(make_timestamp(year(min(l_shipdate)), 1, 1, 0, 0, 0),
                                         make_timestamp(year(max(l_shipdate)), 12, 31, 0, 0, 0),
                                         INTERVAL 1 DAY)) AS DATE) AS d
      FROM lineitem)""", ids=("K-1",))
def dim_time(spark, sf_dir):
    from tradelens.operators.warehouse import calendar_dimension
    li = read_table(spark, sf_dir, "lineitem")
    span = li.agg(F.make_date(F.year(F.min("l_shipdate")), F.lit(1), F.lit(1)).alias("lo"),
                  F.make_date(F.year(F.max("l_shipdate")), F.lit(12), F.lit(31)).alias("hi"))
    return calendar_dimension(span)


@register("outlier_flag", with_trade("""
SELECT g.product, g.group_rows, round(g.threshold, 6) AS threshold,
       CAST(count_if(coalesce(p.price > g.threshold, false)) AS BIGINT) AS n_outliers
FROM p JOIN g USING (product) GROUP BY g.product, g.group_rows, g.threshold""",
    "p AS (SELECT product, round(CAST(value AS DOUBLE) / qty, 4) AS price FROM trade)",
    """g AS (SELECT product, count(*) AS group_rows,
                CASE WHEN count(*) >= 20 THEN quantile_cont(price, 0.99) END AS threshold
         FROM p GROUP BY product)"""), ids=("A-12", "P-6"))
def outlier_flag(spark, sf_dir):
    t = trade(spark, sf_dir).select("product", "value", "qty")
    t = C.with_unit_price(t, "value", "qty", out="price")
    thr = measured(C.outlier_thresholds(t, "product", "price", quantile=0.99, min_rows=20),
                   "outlier-thresholds")
    counts = (t.join(thr.select("product", "threshold"), "product", "left")
               .groupBy("product")
               .agg(F.count_if(F.coalesce(F.col("price") > F.col("threshold"), F.lit(False)))
                     .alias("n_outliers")))
    return (thr.join(counts, "product")
               .select("product", "group_rows", fround("threshold", 6).alias("threshold"),
                       "n_outliers"))


@register("month_from_parts", """
SELECT o_orderkey, y AS year_part, m AS month_part,
       CASE WHEN m BETWEEN 1 AND 12 THEN make_date(y, m, 1) END AS shipment_date
FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y,
             CAST(CASE WHEN o_orderpriority = '5-LOW' THEN 52 ELSE month(o_orderdate) END AS INTEGER) AS m
      FROM orders)""", ids=("P-1",))
def month_from_parts(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year_part"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(52))
         .otherwise(F.month("o_orderdate")).alias("month_part"))
    return o.withColumn("shipment_date", D.month_from_parts("year_part", "month_part"))


@register("coerce_numeric", """
SELECT o_orderkey, TRY_CAST(txt AS DOUBLE) AS amount
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'n/a'
                              ELSE CAST(o_totalprice AS VARCHAR) END AS txt FROM orders)""",
          ids=("P-4",))
def coerce_numeric(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.lit("n/a"))
                       .otherwise(F.col("o_totalprice").cast("string")).alias("txt"))
    return o.select("o_orderkey", coerce_double("txt").alias("amount"))


@register("canonical_projection", with_trade("""
SELECT shipment_date, CAST(year(shipment_date) AS INTEGER) AS year,
       CAST(month(shipment_date) AS INTEGER) AS month,
       CAST(quarter(shipment_date) AS INTEGER) AS quarter,
       printf('FY%02d-%02d', (year(shipment_date) - CASE WHEN month(shipment_date) < 4 THEN 1 ELSE 0 END) % 100,
              (year(shipment_date) - CASE WHEN month(shipment_date) < 4 THEN 1 ELSE 0 END + 1) % 100)
         AS financial_year,
       month(shipment_date) IN (9, 10, 11) AS is_peak_season,
       product AS hs_code, brand AS hs_desc, market AS dest_country_name,
       reporter AS reporter_country_name, CAST(value AS DOUBLE) AS fob_usd, qty AS quantity_kg,
       round(CAST(value AS DOUBLE) / qty, 4) AS unit_price_usd, 'COMTRADE' AS source,
       l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM trade"""), ids=("P-3", "P-6", "P-7", "P-8", "P-10"))
def canonical_projection(spark, sf_dir):
    t = trade(spark, sf_dir).withColumn("value", F.col("value").cast("double"))
    renamed = C.rename_canonical(
        t, {"product": "hs_code", "brand": "hs_desc", "market": "dest_country_name",
            "reporter": "reporter_country_name", "value": "fob_usd", "qty": "quantity_kg"})
    df = C.with_calendar(C.with_unit_price(renamed)).withColumn("source", F.lit("COMTRADE"))
    proj = C.canonical_projection(df)
    return df.select(*proj.columns, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# Override table for the name-lookup binding: a remap, a drop, a broken target.
NAME_OVERRIDES = {"NATION_1": "NATION_11", "NATION_2": None, "NATION_3": "ATLANTIS"}

NAME_SQL = """
ov AS (SELECT * FROM (VALUES ('NATION_1', 'NATION_11'), ('NATION_2', NULL), ('NATION_3', 'ATLANTIS'))
       AS t(source_name, standard_name)),
iso AS (SELECT n_name AS name, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso
        FROM nation WHERE n_name <> 'NATION_4'),
mapped AS (
  SELECT t.market, iso.iso,
         CASE WHEN iso.iso IS NOT NULL THEN 'mapped'
              WHEN ov.source_name IS NOT NULL AND ov.standard_name IS NULL THEN 'dropped'
              ELSE 'unmapped' END AS name_status
  FROM trade t LEFT JOIN ov ON t.market = ov.source_name
  LEFT JOIN iso ON (CASE WHEN ov.source_name IS NOT NULL THEN ov.standard_name ELSE t.market END) = iso.name)"""


def _name_lookup(spark, sf_dir):
    t = trade(spark, sf_dir).select("market")
    iso = (read_table(spark, sf_dir, "nation").filter(F.col("n_name") != "NATION_4")
           .select(F.col("n_name").alias("name"),
                   F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
                    .alias("iso")))
    ov = C.overrides_frame(spark, NAME_OVERRIDES)
    return C.map_names_to_iso(t, "market", ov, iso, out="iso")


@register("name_lookup", with_trade("""
SELECT market, iso, name_status, count(*) AS n_rows FROM mapped GROUP BY 1, 2, 3""", NAME_SQL),
          ids=("J-4",))
def name_lookup(spark, sf_dir):
    m = _name_lookup(spark, sf_dir)
    return m.groupBy("market", "iso", "name_status").agg(F.count("*").alias("n_rows"))


@register("name_lookup_unmapped", with_trade("""
SELECT market AS name, count(*) AS n_rows FROM mapped
WHERE iso IS NULL AND market IS NOT NULL AND name_status = 'unmapped' GROUP BY 1""", NAME_SQL),
          ids=("J-4",))
def name_lookup_unmapped(spark, sf_dir):
    return C.unmapped_names(_name_lookup(spark, sf_dir), "market", iso_col="iso")


CATEGORY_MAP = {"ECONOMY": "Value", "SMALL": "Value", "MEDIUM": "Core", "LARGE": "Core",
                "PROMO": "Promo"}


@register("category_map", with_trade("""
SELECT product, category, CASE WHEN category IN ('Value', 'Core') THEN category ELSE 'Other' END AS grp,
       coalesce(category, product) AS label, CAST(sum(value) AS DOUBLE) AS total, count(*) AS n_rows
FROM (SELECT t.*, m.category FROM trade t LEFT JOIN
      (VALUES ('ECONOMY','Value'), ('SMALL','Value'), ('MEDIUM','Core'), ('LARGE','Core'),
              ('PROMO','Promo')) AS m(code, category) ON t.product = m.code)
GROUP BY 1, 2, 3, 4"""), ids=("P-9",))
def category_map(spark, sf_dir):
    from tradelens.operators.marts import map_category
    t = map_category(trade(spark, sf_dir), "product", CATEGORY_MAP, out="category")
    grp = F.when(F.col("category").isin("Value", "Core"), F.col("category")).otherwise("Other")
    return (t.groupBy("product", "category", grp.alias("grp"),
                      F.coalesce("category", "product").alias("label"))
             .agg(F.sum("value").cast("double").alias("total"), F.count("*").alias("n_rows")))


@register("clip_values", with_trade("""
SELECT product, sum(greatest(qty, 5.0)) AS qty_clip_lower, sum(least(qty, 45.0)) AS qty_clip_upper,
       sum(least(greatest(qty, 5.0), 45.0)) AS qty_clip_both
FROM trade GROUP BY product"""), ids=("P-12",))
def clip_values(spark, sf_dir):
    t = trade(spark, sf_dir)
    return t.groupBy("product").agg(
        F.sum(clip("qty", lower=5.0)).alias("qty_clip_lower"),
        F.sum(clip("qty", upper=45.0)).alias("qty_clip_upper"),
        F.sum(clip("qty", 5.0, 45.0)).alias("qty_clip_both"))


@register("format_labels", with_trade("""
SELECT market, printf('$%.1fM', total / 1e6) AS total_label,
       printf('%+.1f%%', (total / sum(total) OVER () - 0.04) * 100) AS share_vs_even_label
FROM (SELECT market, CAST(sum(value) AS DOUBLE) AS total FROM trade GROUP BY market)"""),
          ids=("P-15",))
def format_labels(spark, sf_dir):
    from tradelens.functions.stats import attach_scalars
    m = (trade(spark, sf_dir).groupBy("market")
         .agg(F.sum("value").cast("double").alias("total")))
    m = attach_scalars(m, m.agg(F.sum("total").alias("grand")))
    return m.select("market", millions("total").alias("total_label"),
                    signed_pct(F.col("total") / F.col("grand") - 0.04)
                    .alias("share_vs_even_label"))
