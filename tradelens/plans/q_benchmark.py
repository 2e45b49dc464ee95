"""Price benchmark bound to the test tables.

reporter = supplier nation; baseline NATION_0 against NATION_1 and NATION_2;
partner = customer nation key with key 0 standing for the world row;
base year 2000 (last full year); the grade-artifact exclusion drops
PROMO/STANDARD opportunity against NATION_2.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tradelens.functions.numeric import fround
from tradelens.operators import benchmark as B
from tradelens.operators import marts as M
from tradelens.params import BenchmarkParams
from tradelens.plans.registry import register
from tradelens.sources.tables import trade, with_trade

BASE = "NATION_0"
COMPETITORS = ("NATION_1", "NATION_2")
REPORTERS = [BASE, *COMPETITORS]
PARAMS = BenchmarkParams(base_reporter=BASE, competitors=COMPETITORS, base_year=2000)
EXCLUDED_PRODUCTS = ("PROMO", "STANDARD")
EXCLUDED_COMPETITOR = "NATION_2"


def panel(spark, sf_dir):
    t = (trade(spark, sf_dir).filter(F.col("reporter").isin(REPORTERS))
         .withColumn("year", F.year("shipment_date")))
    return B.reporter_panel(t, "reporter", "year", "product", "value", "qty", "market_key",
                            BASE, world_code=0)


_rep = ", ".join(f"'{r}'" for r in REPORTERS)
PANEL_SQL = f"""
panel AS (
  SELECT reporter, year, product, fob, qty, CAST(fob AS DOUBLE) / CAST(qty AS DOUBLE) AS price
  FROM (SELECT reporter, CAST(year(shipment_date) AS INTEGER) AS year, product,
               sum(value) AS fob, sum(qty) AS qty
        FROM trade
        WHERE reporter IN ({_rep})
          AND (reporter = '{BASE}' OR NOT coalesce(market_key = 0, false))
        GROUP BY 1, 2, 3)
  WHERE reporter = '{BASE}' OR qty > 0)"""
AVG_SQL = "avg_p AS (SELECT product, reporter, avg(price) AS avg_price FROM panel GROUP BY 1, 2)"
GAP_SQL = f"""gaps AS (
  SELECT c.product, c.reporter AS competitor, c.avg_price AS competitor_price, b.avg_price AS base_price,
         c.avg_price - b.avg_price AS gap,
         coalesce(c.avg_price - b.avg_price > 5.0, false) AS warn,
         CASE WHEN b.avg_price > 0 THEN (c.avg_price - b.avg_price) / b.avg_price END AS gap_ratio,
         CASE WHEN b.avg_price > 0 THEN c.avg_price / b.avg_price END AS price_ratio
  FROM avg_p c LEFT JOIN (SELECT * FROM avg_p WHERE reporter = '{BASE}') b USING (product)
  WHERE c.reporter <> '{BASE}')"""
OPP_SQL = f"""opp AS (
  SELECT g.*, v.base_volume,
         greatest(g.gap, 0.0) * 0.3 * v.base_volume AS opportunity_usd,
         round(greatest(g.gap, 0.0) * 0.3 * v.base_volume * 83.0 / 1e7, 2) AS opportunity_inr_cr
  FROM gaps g LEFT JOIN (SELECT product, CAST(qty AS DOUBLE) AS base_volume FROM panel
                         WHERE reporter = '{BASE}' AND year = 2000) v USING (product))"""
TOT_SQL = f"""tot AS (
  SELECT sum(opportunity_inr_cr) AS total_inr_cr,
         coalesce(sum(CASE WHEN product IN ('PROMO', 'STANDARD') AND competitor = '{EXCLUDED_COMPETITOR}'
                           THEN opportunity_inr_cr END), 0.0) AS excluded_inr_cr
  FROM opp)"""


def _avg(spark, sf_dir):
    return B.avg_prices(panel(spark, sf_dir))


def _gaps(spark, sf_dir):
    return B.price_gaps(_avg(spark, sf_dir), BASE, PARAMS)


def _opp(spark, sf_dir):
    p = panel(spark, sf_dir)
    return B.opportunity(B.price_gaps(B.avg_prices(p), BASE, PARAMS), p, BASE, PARAMS)


@register("reporter_panel", with_trade("""
SELECT reporter, year, product, CAST(fob AS DOUBLE) AS fob, qty, round(price, 6) AS price FROM panel""",
    PANEL_SQL), ids=("A-14", "S-3"))
def reporter_panel(spark, sf_dir):
    p = panel(spark, sf_dir)
    return p.select("reporter", "year", "product", F.col("fob").cast("double").alias("fob"), "qty",
                    fround("price", 6).alias("price"))


@register("avg_price_matrix", with_trade(f"""
SELECT product, {", ".join(f"round(avg(CASE WHEN reporter = '{r}' THEN price END), 6) AS {r}" for r in REPORTERS)}
FROM panel GROUP BY product""", PANEL_SQL), ids=("A-15",))
def avg_price_matrix(spark, sf_dir):
    m = B.price_matrix(panel(spark, sf_dir), REPORTERS)
    return m.select("product", *[fround(r, 6).alias(r) for r in REPORTERS])


@register("price_gap", with_trade("""
SELECT product, competitor, round(competitor_price, 6) AS competitor_price,
       round(base_price, 6) AS base_price, round(gap, 6) AS gap, warn,
       round(gap_ratio, 6) AS gap_ratio, round(price_ratio, 6) AS price_ratio FROM gaps""",
    PANEL_SQL, AVG_SQL, GAP_SQL), ids=("J-8", "P-14"))
def price_gap(spark, sf_dir):
    g = _gaps(spark, sf_dir)
    return g.select("product", "competitor", *[fround(c, 6).alias(c) for c in
                                               ("competitor_price", "base_price", "gap")],
                    "warn", fround("gap_ratio", 6).alias("gap_ratio"),
                    fround("price_ratio", 6).alias("price_ratio"))


@register("opportunity", with_trade("""
SELECT product, competitor, base_volume, round(opportunity_usd, 4) AS opportunity_usd,
       opportunity_inr_cr FROM opp""", PANEL_SQL, AVG_SQL, GAP_SQL, OPP_SQL), ids=("A-16", "J-9"))
def opportunity(spark, sf_dir):
    o = _opp(spark, sf_dir)
    return o.select("product", "competitor", "base_volume",
                    fround("opportunity_usd", 4).alias("opportunity_usd"), "opportunity_inr_cr")


@register("opportunity_total", with_trade("""
SELECT round(total_inr_cr, 2) AS total_inr_cr, round(excluded_inr_cr, 2) AS excluded_inr_cr,
       round(total_inr_cr - excluded_inr_cr, 2) AS adjusted_inr_cr FROM tot""",
    PANEL_SQL, AVG_SQL, GAP_SQL, OPP_SQL, TOT_SQL), ids=("A-16",))
def opportunity_total(spark, sf_dir):
    t = B.opportunity_totals(_opp(spark, sf_dir), EXCLUDED_PRODUCTS, EXCLUDED_COMPETITOR)
    return t.select(*[fround(c, 2).alias(c) for c in
                      ("total_inr_cr", "excluded_inr_cr", "adjusted_inr_cr")])


@register("opportunity_fx", with_trade("""
SELECT fx_rate, round((total_inr_cr - excluded_inr_cr) * fx_rate / 83.0, 4) AS scaled_inr_cr
FROM tot CROSS JOIN (VALUES (80.0::DOUBLE), (83.0::DOUBLE), (85.0::DOUBLE), (87.0::DOUBLE)) AS r(fx_rate)""",
    PANEL_SQL, AVG_SQL, GAP_SQL, OPP_SQL, TOT_SQL), ids=("J-14",))
def opportunity_fx(spark, sf_dir):
    t = B.opportunity_totals(_opp(spark, sf_dir), EXCLUDED_PRODUCTS, EXCLUDED_COMPETITOR)
    f = B.fx_sensitivity(t, PARAMS.fx, PARAMS.fx_table)
    return f.select("fx_rate", fround("scaled_inr_cr", 4).alias("scaled_inr_cr"))


@register("unpivot_prices", with_trade(f"""
SELECT product, upper(left(r, 1)) || lower(substr(r, 2)) AS reporter, round(price, 6) AS price
FROM (SELECT product, replace(regexp_replace(lower(reporter) || '_usd_per_kg', '_usd_per_kg$', ''), '_', ' ') AS r,
             avg(price) AS price
      FROM panel WHERE reporter <> '{BASE}' GROUP BY product, reporter)""", PANEL_SQL), ids=("P-13",))
def unpivot_prices(spark, sf_dir):
    m = B.price_matrix(panel(spark, sf_dir), REPORTERS)
    wide = m.select("product", *[F.col(r).alias(f"{r.lower()}_usd_per_kg") for r in COMPETITORS])
    long = M.unpivot_prices(wide, ["product"], [f"{r.lower()}_usd_per_kg" for r in COMPETITORS],
                            "_usd_per_kg")
    return long.select("product", "reporter", fround("price", 6).alias("price"))
