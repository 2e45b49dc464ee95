"""Star-schema maintenance bound to the test tables.

Dimension 'country' = customer nation (iso 'Nxx').  The upserts apply the
(buyer, brand) totals of the lines that were not returned to a target built
from the returned and the annual ones: together the whole fact, with keys in
either part alone and in both.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tradelens.operators import warehouse as W
from tradelens.plans.q_marts import _cat_sql, products
from tradelens.plans.registry import register
from tradelens.session import scratch_path
from tradelens.sources.tables import TABLES, trade, with_trade



def iso_col():
    return F.concat(F.lit("N"), F.lpad(F.col("market_key").cast("string"), 2, "0"))

ISO_SQL = "'N' || lpad(CAST(market_key AS VARCHAR), 2, '0')"


def dim_market_frame(spark, sf_dir):
    t = trade(spark, sf_dir).withColumn("iso_alpha3", iso_col())
    names = W.first_name_per_key(t, "iso_alpha3", "market", "shipment_date")
    ids = W.assign_surrogate_keys(names.select("iso_alpha3"), ["iso_alpha3"], "country_id")
    return names.join(ids, "iso_alpha3")


@register("dim_market", with_trade(f"""
SELECT iso_alpha3, country_name, CAST(row_number() OVER (ORDER BY iso_alpha3) AS BIGINT) AS country_id
FROM (SELECT {ISO_SQL} AS iso_alpha3, arg_min(market, (shipment_date, market)) AS country_name
      FROM trade GROUP BY 1)"""), ids=("K-2", "K-4"))
def dim_market(spark, sf_dir):
    return dim_market_frame(spark, sf_dir).select("iso_alpha3", "country_name", "country_id")


@register("fk_resolve", with_trade(f"""
SELECT count(*) AS rows, CAST(count_if(p.product_id IS NULL) AS BIGINT) AS null_product_id,
       CAST(count_if(dm.country_id IS NULL) AS BIGINT) AS null_country_id,
       count(DISTINCT year(shipment_date) * 10000 + month(shipment_date) * 100 + day(shipment_date)) AS n_time_id
FROM trade t LEFT JOIN (SELECT p_type AS hs_code, row_number() OVER (ORDER BY p_type) AS product_id
                        FROM (SELECT DISTINCT p_type FROM part)) p ON t.product = p.hs_code
LEFT JOIN dm ON dm.iso_alpha3 = {ISO_SQL}""",
    f"""dm AS (SELECT iso_alpha3, CAST(row_number() OVER (ORDER BY iso_alpha3) AS BIGINT) AS country_id
              FROM (SELECT DISTINCT {ISO_SQL} AS iso_alpha3 FROM trade) WHERE iso_alpha3 <> 'N04')"""),
    ids=("J-2",))
def fk_resolve(spark, sf_dir):
    """FK resolution with its gate check (one aggregate).  The country dim
    deliberately lacks N04, so the gate reports unresolved rows."""
    t = trade(spark, sf_dir).withColumn("iso_alpha3", iso_col()).withColumn(
        "time_id", F.year("shipment_date") * 10000 + F.month("shipment_date") * 100
        + F.dayofmonth("shipment_date"))
    countries = W.assign_surrogate_keys(
        t.select("iso_alpha3").distinct().filter(F.col("iso_alpha3") != "N04"),
        ["iso_alpha3"], "country_id")
    prods = products(spark, sf_dir).select(F.col("hs_code").alias("product"), "product_id")
    resolved, check = W.resolve_foreign_keys(
        t, [(prods, "product", "product_id"), (countries, "iso_alpha3", "country_id")])
    n_time = resolved.agg(F.count_distinct("time_id").alias("n_time_id"))
    return check.select("rows", "null_product_id", "null_country_id").crossJoin(n_time)


KEY = ["buyer", "brand"]


def _loads(spark, sf_dir):
    """(target, updates): totals per key of the first and of the second load."""
    t = trade(spark, sf_dir)
    second = F.col("l_returnflag") == "N"

    def totals(rows):
        return rows.groupBy(*KEY).agg(F.sum("value").cast("double").alias("total"), F.count("*").alias("n_rows"))

    return totals(t.filter(~second)), totals(t.filter(second))


LOAD_SQL = (
    """tg AS (SELECT buyer, brand, CAST(sum(value) AS DOUBLE) AS total, count(*) AS n_rows
             FROM trade WHERE l_returnflag <> 'N' GROUP BY 1, 2)""",
    """up AS (SELECT buyer, brand, CAST(sum(value) AS DOUBLE) AS total, count(*) AS n_rows
             FROM trade WHERE l_returnflag = 'N' GROUP BY 1, 2)""",
)


@register("upsert_market", with_trade("""
SELECT coalesce(u.buyer, t.buyer) AS buyer, coalesce(u.brand, t.brand) AS brand,
       CASE WHEN u.buyer IS NOT NULL THEN u.total ELSE t.total END AS total,
       CASE WHEN u.buyer IS NOT NULL THEN u.n_rows ELSE t.n_rows END AS n_rows,
       CASE WHEN t.buyer IS NOT NULL AND u.buyer IS NOT NULL THEN 'updated'
            WHEN u.buyer IS NOT NULL THEN 'inserted' ELSE 'kept' END AS status
FROM tg t FULL OUTER JOIN up u ON t.buyer = u.buyer AND t.brand = u.brand""", *LOAD_SQL),
          ids=("S-14",))
def upsert_market(spark, sf_dir):
    return W.upsert(*_loads(spark, sf_dir), KEY, status_col="status")


@register("insert_absent", with_trade("""
SELECT * FROM tg UNION ALL
SELECT * FROM up WHERE NOT EXISTS (SELECT 1 FROM tg WHERE tg.buyer = up.buyer AND tg.brand = up.brand)""",
    *LOAD_SQL), ids=("S-15",))
def insert_absent(spark, sf_dir):
    return W.insert_absent(*_loads(spark, sf_dir), KEY)


@register("dim_product", f"""
SELECT p_type AS hs_code, CAST(row_number() OVER (ORDER BY p_type) AS BIGINT) AS product_id,
       coalesce({_cat_sql('p_type')}, 'Unmapped') AS category
FROM (SELECT DISTINCT p_type FROM part)""", ids=("K-3",))
def dim_product(spark, sf_dir):
    return products(spark, sf_dir).select("hs_code", "product_id", "category")


@register("surrogate_keys", with_trade("""
SELECT buyer, brand, CAST(row_number() OVER (ORDER BY buyer, brand) AS BIGINT) AS key_id FROM tg
UNION ALL
SELECT buyer, brand, (SELECT count(*) FROM tg) + CAST(row_number() OVER (ORDER BY buyer, brand) AS BIGINT)
FROM (SELECT buyer, brand FROM up EXCEPT SELECT buyer, brand FROM tg)""", *LOAD_SQL), ids=("K-4",))
def surrogate_keys(spark, sf_dir):
    first, second = _loads(spark, sf_dir)
    existing = W.assign_surrogate_keys(first.select(*KEY), KEY, "key_id")
    return W.extend_dimension(existing, second.select(*KEY), KEY, "key_id")


@register("buyer_dim", with_trade(f"""
SELECT market || ' Market' AS company_name, 'BUYER' AS company_type, c.country_id
FROM (SELECT market, {ISO_SQL} AS iso_alpha3 FROM trade GROUP BY 1, 2
      HAVING count(DISTINCT shipment_date) >= 6) s
JOIN (SELECT iso_alpha3, CAST(row_number() OVER (ORDER BY iso_alpha3) AS BIGINT) AS country_id
      FROM (SELECT DISTINCT {ISO_SQL} AS iso_alpha3 FROM trade) WHERE iso_alpha3 <> 'N04') c
  USING (iso_alpha3)"""), ids=("K-5",))
def buyer_dim(spark, sf_dir):
    t = trade(spark, sf_dir).withColumn("iso_alpha3", iso_col())
    scored = (t.groupBy("iso_alpha3", "market").agg(F.count_distinct("shipment_date").alias("m"))
               .filter(F.col("m") >= 6))
    countries = W.assign_surrogate_keys(
        t.select("iso_alpha3").distinct().filter(F.col("iso_alpha3") != "N04"),
        ["iso_alpha3"], "country_id")
    names = scored.select("iso_alpha3", F.col("market").alias("country_name"))
    return W.buyer_dimension(scored, countries.join(names, "iso_alpha3"), "iso_alpha3",
                             "country_name")


@register("fact_replace", with_trade("""
SELECT CAST(year(shipment_date) AS INTEGER) AS year, count(*) AS n_rows,
       CAST(sum(value) AS DOUBLE) AS fob_usd
FROM trade GROUP BY 1"""), ids=("S-13",))
def fact_replace(spark, sf_dir):
    """Versioned full replace: publish a partial load, then the full load,
    and read back whatever the pointer names (the full one)."""
    root = scratch_path(spark, "warehouse", uuid.uuid4().hex)
    fact = (trade(spark, sf_dir)
            .select("shipment_date", F.year("shipment_date").alias("year"), "value"))
    W.write_version(fact.filter(F.col("year") < 1997), root, "fact_shipment",
                    partition_by=["year"])
    W.write_version(fact, root, "fact_shipment", partition_by=["year"])
    back = W.read_current(spark, root, "fact_shipment")
    return back.groupBy("year").agg(F.count("*").alias("n_rows"),
                                    F.sum("value").cast("double").alias("fob_usd"))


@register("table_status", " UNION ALL ".join(
    [f"SELECT '{t}' AS table_name, 'present' AS status, CAST(count(*) AS BIGINT) AS row_count FROM {t}"
     for t in TABLES]
    + ["SELECT 'fact_shipment', 'missing', CAST(NULL AS BIGINT)"]), ids=("S-19",))
def table_status(spark, sf_dir):
    paths = {t: f"{sf_dir.rstrip('/')}/{t}.parquet" for t in TABLES}
    paths["fact_shipment"] = f"{sf_dir.rstrip('/')}/fact_shipment.parquet"
    return W.table_status(spark, paths)

