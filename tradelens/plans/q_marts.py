"""Exploratory marts and star views bound to the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradelens.functions.numeric import fround
from tradelens.functions.stats import measured
from tradelens.operators import marts as M
from tradelens.operators import warehouse as W
from tradelens.plans.q_clean import CATEGORY_MAP
from tradelens.plans.q_seasonality import SEGMENT_A
from tradelens.plans.registry import register
from tradelens.sources.tables import read_table, trade, with_trade

PRODUCTS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
AS_OF = "2001-11-01"


def _cat_sql(col: str) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in CATEGORY_MAP.items())
    return f"CASE {whens} END"


# --- star binding: dims derived from the data ---------------------------------------

def countries(spark, sf_dir):
    n = read_table(spark, sf_dir, "nation")
    return n.select((F.col("n_nationkey") + 1).alias("country_id"),
                    F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
                     .alias("iso_alpha3"),
                    F.col("n_name").alias("country_name"), "n_nationkey")


def products(spark, sf_dir):
    p = read_table(spark, sf_dir, "part").select(F.col("p_type").alias("hs_code")).distinct()
    ids = W.assign_surrogate_keys(p, ["hs_code"], "product_id")
    ids = M.map_category(ids, "hs_code", CATEGORY_MAP)
    return ids.withColumn("category", F.coalesce("category", F.lit("Unmapped")))


def fact(spark, sf_dir, dim_product=None):
    t = trade(spark, sf_dir)
    p = (dim_product if dim_product is not None else products(spark, sf_dir)).select("hs_code", "product_id")
    return (t.join(p, t.product == p.hs_code)
             .select("shipment_date", (F.col("market_key") + 1).alias("country_id"),
                     "product_id", F.col("buyer").alias("buyer_id"),
                     F.col("value").alias("fob_usd"), F.col("qty").alias("quantity_kg"),
                     fround(F.col("value").cast("double") / F.col("qty"), 4)
                      .alias("unit_price_usd")))


STAR_SQL = (
    """countries AS (SELECT n_nationkey + 1 AS country_id,
                            'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso_alpha3,
                            n_name AS country_name FROM nation)""",
    f"""products AS (SELECT p_type AS hs_code, CAST(row_number() OVER (ORDER BY p_type) AS BIGINT) AS product_id,
                            coalesce({_cat_sql('p_type')}, 'Unmapped') AS category
                     FROM (SELECT DISTINCT p_type FROM part))""",
    """fact AS (SELECT shipment_date, market_key + 1 AS country_id, product_id, buyer AS buyer_id,
                       value AS fob_usd, qty AS quantity_kg,
                       round(CAST(value AS DOUBLE) / qty, 4) AS unit_price_usd
                FROM trade JOIN products ON product = hs_code)""",
)


@register("monthly_export_view", with_trade("""
SELECT CAST(date_trunc('month', shipment_date) AS DATE) AS month, iso_alpha3, country_name, hs_code,
       category, CAST(sum(fob_usd) AS DOUBLE) AS total_fob_usd, sum(quantity_kg) AS total_quantity_kg,
       round(CAST(sum(CAST(unit_price_usd AS DECIMAL(18,4))) AS DOUBLE) / count(unit_price_usd), 6) AS avg_unit_price_usd, count(*) AS shipment_count
FROM fact JOIN countries USING (country_id) JOIN products USING (product_id)
GROUP BY 1, 2, 3, 4, 5""", *STAR_SQL), ids=("A-1", "J-1", "S-6"))
def monthly_export_view(spark, sf_dir):
    p = measured(products(spark, sf_dir), "dim-product")  # used twice: ids are assigned once
    v = W.monthly_export_view(fact(spark, sf_dir, p),
                              countries(spark, sf_dir).drop("n_nationkey"), p)
    return (v.withColumn("total_fob_usd", F.col("total_fob_usd").cast("double"))
             .withColumn("avg_unit_price_usd", fround("avg_unit_price_usd", 6)))


COMPANY_SQL = """companies AS (
  SELECT c_custkey AS company_id, c_name AS company_name, 'BUYER' AS company_type,
         c_nationkey + 1 AS country_id,
         CASE WHEN c_acctbal > 0 THEN round(c_acctbal / 1000, 2) END AS risk_score,
         CAST(NULL AS DOUBLE) AS avg_payment_days
  FROM customer)"""


def companies(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("company_id"), F.col("c_name").alias("company_name"),
                    F.lit("BUYER").alias("company_type"),
                    (F.col("c_nationkey") + 1).alias("country_id"),
                    F.when(F.col("c_acctbal") > 0, fround(F.col("c_acctbal") / 1000, 2))
                     .alias("risk_score"),
                    F.lit(None).cast("double").alias("avg_payment_days"))


@register("risk_register_view", with_trade(f"""
SELECT c.company_id, c.company_name, dc.country_name AS buyer_country, c.risk_score,
       c.avg_payment_days,
       CAST(sum(f.fob_usd) FILTER (WHERE f.shipment_date >= DATE '{AS_OF}' - INTERVAL 12 MONTH) AS DOUBLE)
         AS fob_last_12m,
       count(f.fob_usd) FILTER (WHERE f.shipment_date >= DATE '{AS_OF}' - INTERVAL 12 MONTH)
         AS shipments_last_12m
FROM companies c LEFT JOIN countries dc ON dc.country_id = c.country_id
LEFT JOIN fact f ON f.buyer_id = c.company_id
WHERE c.company_type = 'BUYER' AND c.risk_score IS NOT NULL
GROUP BY 1, 2, 3, 4, 5""", *STAR_SQL, COMPANY_SQL), ids=("A-2", "J-3"))
def risk_register_view(spark, sf_dir):
    v = W.risk_register_view(companies(spark, sf_dir), countries(spark, sf_dir),
                             fact(spark, sf_dir), AS_OF)
    return v.withColumn("fob_last_12m", F.col("fob_last_12m").cast("double"))


@register("dataset_profile", with_trade("""
SELECT count(*) AS n_rows, count(DISTINCT market) AS n_distinct_market,
       count(DISTINCT product) AS n_distinct_product, count(DISTINCT buyer) AS n_distinct_buyer,
       min(shipment_date) AS min_date, max(shipment_date) AS max_date,
       CAST(sum(value) AS DOUBLE) AS total_value, sum(qty) AS total_qty,
       CAST(count_if(l_returnflag = 'R') AS BIGINT) AS n_flagged,
       round(avg(CAST(l_returnflag = 'R' AS INTEGER)), 6) AS flag_rate
FROM trade"""), ids=("A-3",))
def dataset_profile(spark, sf_dir):
    t = trade(spark, sf_dir).withColumn("is_flag", F.col("l_returnflag") == "R")
    p = M.dataset_profile(t, ["market", "product", "buyer"], "shipment_date", "value", "qty",
                          "is_flag")
    return (p.withColumn("total_value", F.col("total_value").cast("double"))
             .withColumn("flag_rate", fround("flag_rate", 6)))


SHARE_CTES = (
    "s AS (SELECT market, CAST(sum(value) AS DOUBLE) AS total FROM trade GROUP BY market)",
    "sh AS (SELECT market, total, total / sum(total) OVER () AS share FROM s)",
)


@register("concentration", with_trade("""
SELECT (SELECT count(*) FROM sh) AS n_keys, round(max(share), 6) AS top1_share,
       round(sum(share), 6) AS top10_share
FROM (SELECT * FROM sh ORDER BY share DESC, market LIMIT 10)""", *SHARE_CTES), ids=("A-5",))
def concentration(spark, sf_dir):
    c = M.concentration(trade(spark, sf_dir), "market", "value", top_n=10)
    return c.select("n_keys", fround("top1_share", 6).alias("top1_share"),
                    fround("top10_share", 6).alias("top10_share"))


@register("top_markets", with_trade("""
SELECT market, total, round(share, 6) AS share FROM sh ORDER BY total DESC, market LIMIT 10""",
                                   *SHARE_CTES), ids=("L-1", "A-5"))
def top_markets(spark, sf_dir):
    s = M.totals_with_share(trade(spark, sf_dir), "market", "value")
    return M.top_k(s, "total", 10, ["market"]).select("market", "total",
                                                      fround("share", 6).alias("share"))


@register("product_mix_by_year", with_trade(f"""
SELECT CAST(year(shipment_date) AS INTEGER) AS year,
       {", ".join(f"CAST(coalesce(sum(CASE WHEN product = '{p}' THEN value END), 0) AS DOUBLE) AS {p}" for p in PRODUCTS)}
FROM trade GROUP BY 1"""), ids=("A-6",))
def product_mix_by_year(spark, sf_dir):
    t = trade(spark, sf_dir).withColumn("year", F.year("shipment_date"))
    return M.pivot_sum(t, "year", "product", list(PRODUCTS), "value")


@register("category_share", with_trade(f"""
SELECT label, CAST(sum(value) AS DOUBLE) AS total,
       round(100.0 * CAST(sum(value) AS DOUBLE) / sum(CAST(sum(value) AS DOUBLE)) OVER (), 6) AS share_pct
FROM (SELECT coalesce({_cat_sql('product')}, product) AS label, value FROM trade)
GROUP BY label"""), ids=("A-7", "P-9"))
def category_share(spark, sf_dir):
    t = M.map_category(trade(spark, sf_dir), "product", CATEGORY_MAP)
    t = t.withColumn("label", F.coalesce("category", "product"))
    s = M.totals_with_share(t, "label", "value")
    return s.select("label", "total", fround(F.col("share") * 100, 6).alias("share_pct"))


@register("heatmap_year_month", with_trade(f"""
SELECT CAST(year(shipment_date) AS INTEGER) AS year,
       {", ".join(f"CAST(coalesce(sum(CASE WHEN month(shipment_date) = {m} THEN value END), 0) AS DOUBLE) AS m{m:02d}" for m in range(1, 13))}
FROM trade GROUP BY 1"""), ids=("A-8",))
def heatmap_year_month(spark, sf_dir):
    t = trade(spark, sf_dir).select(F.year("shipment_date").alias("year"),
                                    F.month("shipment_date").alias("m"), "value")
    p = M.pivot_sum(t, "year", "m", list(range(1, 13)), "value")
    return p.select("year", *[F.col(str(m)).alias(f"m{m:02d}") for m in range(1, 13)])


@register("month_by_group", with_trade(f"""
SELECT shipment_date AS month,
       CASE WHEN product IN ({", ".join(f"'{p}'" for p in SEGMENT_A)}) THEN 'SEGMENT_A' ELSE 'SEGMENT_B' END AS grp,
       CAST(sum(value) AS DOUBLE) AS total
FROM trade GROUP BY 1, 2"""), ids=("A-13",))
def month_by_group(spark, sf_dir):
    t = trade(spark, sf_dir)
    grp = F.when(F.col("product").isin(list(SEGMENT_A)), "SEGMENT_A").otherwise("SEGMENT_B")
    return t.groupBy(F.col("shipment_date").alias("month"), grp.alias("grp")).agg(
        F.sum("value").cast("double").alias("total"))


PRICE_CTE = "p AS (SELECT product, round(CAST(value AS DOUBLE) / qty, 4) AS price FROM trade)"


@register("price_quantiles", with_trade("""
SELECT product, round(quantile_cont(price, 0.5), 6) AS p50, round(quantile_cont(price, 0.95), 6) AS p95
FROM p GROUP BY product""", PRICE_CTE), ids=("A-11",))
def price_quantiles(spark, sf_dir):
    t = trade(spark, sf_dir).withColumn("price", fround(F.col("value").cast("double")
                                                         / F.col("qty"), 4))
    q = M.price_quantiles(t, "product", "price")
    return q.select("product", fround("p50", 6).alias("p50"), fround("p95", 6).alias("p95"))


@register("price_histogram", with_trade("""
SELECT product, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / (hi - lo) * 30), 29) END AS INTEGER) AS bin,
       count(*) AS n
FROM (SELECT product, v, min(v) OVER (PARTITION BY product) AS lo, max(v) OVER (PARTITION BY product) AS hi
      FROM (SELECT p.product, least(p.price, c.cap) AS v FROM p
            JOIN (SELECT product, quantile_cont(price, 0.95) AS cap FROM p GROUP BY product) c USING (product)))
GROUP BY 1, 2""", PRICE_CTE), ids=("A-26",))
def price_histogram(spark, sf_dir):
    t = trade(spark, sf_dir).withColumn("price", fround(F.col("value").cast("double")
                                                         / F.col("qty"), 4))
    return M.histogram(t, "product", "price", bins=30, clip_quantile=0.95)


@register("yoy_top15", with_trade("""
SELECT market, year, total, round((total / nullif(prev, 0) - 1) * 100, 6) AS yoy_pct
FROM (SELECT d.market, d.year, d.total,
             lag(d.total) OVER (PARTITION BY d.market ORDER BY d.year) AS prev
      FROM (SELECT k.market, y.year, coalesce(t.total, 0.0) AS total
            FROM top k
            CROSS JOIN (SELECT CAST(unnest(generate_series(min(year), max(year))) AS INTEGER) AS year
                        FROM yearly) y
            LEFT JOIN yearly t ON t.market = k.market AND t.year = y.year) d)
WHERE prev IS NOT NULL""",
    """top AS (SELECT market FROM trade GROUP BY market ORDER BY sum(value) DESC, market LIMIT 15)""",
    """yearly AS (SELECT market, CAST(year(shipment_date) AS INTEGER) AS year,
                         CAST(sum(value) AS DOUBLE) AS total
                  FROM trade WHERE market IN (SELECT market FROM top) GROUP BY 1, 2)"""),
    ids=("W-2", "J-10", "L-1"))
def yoy_top15(spark, sf_dir):
    t = trade(spark, sf_dir)
    top = M.top_k(t.groupBy("market").agg(F.sum("value").alias("total")), "total", 15, ["market"])
    sub = t.join(top.select("market"), "market", "left_semi")
    y = M.yoy_change(sub.withColumn("year", F.year("shipment_date")), "market", "year", "value")
    return y.select("market", "year", "total", fround("yoy_pct", 6).alias("yoy_pct"))
