"""The refresh job (O-1, O-2, A-25) run end to end on records Spark derives
from the test tables.

Each trade line becomes a raw record: partner = customer nation (key 0 is
an aggregate partner code, so its rows are dropped as aggregates), returned
lines carry an unparsable value ('n/a'), 'A'-flag lines are annual rows
(month 52 -> no date) and the quantity is shifted down by one (single-unit
lines get zero).  The job checks a driver series (mean order price by year),
cleans, gates and publishes the dimensions and a new fact version in
the shared folder; the query returns the clean counters, the row counts of
the star as read back, and the run status.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tradelens.operators import quality as Q
from tradelens.operators import warehouse as W
from tradelens.params import AGGREGATE_PARTNER_CODES
from tradelens.plans.pipeline import PipelineConfig, run_pipeline
from tradelens.plans.registry import register
from tradelens.session import scratch_path
from tradelens.sources.tables import read_table, trade, with_trade

ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def trade_records(spark, sf_dir):
    t = trade(spark, sf_dir)
    return t.select(
        *ORDER,
        F.year("shipment_date").alias("refYear"),
        F.when(F.col("l_returnflag") == "A", F.lit(52))
         .otherwise(F.month("shipment_date")).alias("refMonth"),
        F.col("market_key").alias("partnerCode"), F.col("market").alias("partnerDesc"),
        F.col("reporter").alias("reporterDesc"), F.col("product").alias("cmdCode"),
        F.col("brand").alias("cmdDesc"),
        F.when(F.col("l_returnflag") == "R", F.lit("n/a"))
         .otherwise(F.col("value").cast("string")).alias("primaryValue"),
        (F.col("qty") - 1).cast("string").alias("qty"))


def nation_iso(spark, sf_dir):
    n = read_table(spark, sf_dir, "nation")
    return n.select(F.col("n_name").alias("name"),
                    F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
                     .alias("iso"))


_AGG = ", ".join(str(c) for c in AGGREGATE_PARTNER_CODES)
PIPE_SQL = (
    """rec AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                      CASE WHEN l_returnflag = 'A' THEN NULL ELSE shipment_date END AS shipment_date,
                      market_key AS partner_code, market AS partner_desc, product AS hs_code,
                      CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(value AS DOUBLE) END AS fob_usd,
                      qty - 1 AS quantity_kg
               FROM trade)""",
    """iso AS (SELECT n_name AS name, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso FROM nation)""",
    f"""tagged AS (
  SELECT rec.*, iso.iso AS dest_iso_alpha3,
         CASE WHEN coalesce(partner_code IN ({_AGG}), false) THEN 'aggregate_partner'
              WHEN iso.iso IS NULL THEN 'aggregate_partner'
              WHEN shipment_date IS NULL THEN 'null_date'
              WHEN fob_usd IS NULL THEN 'null_value'
              WHEN fob_usd <= 0 THEN 'non_positive_value'
              WHEN quantity_kg IS NULL THEN 'null_qty'
              WHEN quantity_kg <= 0 THEN 'non_positive_qty' END AS reason
  FROM rec LEFT JOIN iso ON rec.partner_desc = iso.name)""",
    """valid AS (SELECT *, round(fob_usd / quantity_kg, 4) AS unit_price_usd FROM tagged WHERE reason IS NULL)""",
    """dedup AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY shipment_date, dest_iso_alpha3, hs_code, fob_usd
                               ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn
  FROM valid) WHERE rn = 1)""",
    """thr AS (SELECT hs_code, CASE WHEN count(*) >= 20 THEN quantile_cont(unit_price_usd, 0.99) END AS t
              FROM dedup GROUP BY hs_code)""",
)


@register("pipeline_refresh", with_trade("""
SELECT (SELECT count(*) FROM tagged) AS rows_in,
       (SELECT count(*) FROM tagged WHERE reason = 'aggregate_partner') AS rows_dropped_aggregate,
       (SELECT count(*) FROM tagged WHERE reason IN ('null_date', 'null_value', 'non_positive_value',
                                                     'null_qty', 'non_positive_qty')) AS rows_dropped_null,
       (SELECT count(*) FROM valid) - (SELECT count(*) FROM dedup) AS rows_deduped,
       (SELECT CAST(count_if(coalesce(unit_price_usd > t, false)) AS BIGINT)
        FROM dedup JOIN thr USING (hs_code)) AS rows_outlier_flagged,
       (SELECT count(*) FROM dedup) AS rows_out,
       (SELECT count(DISTINCT CAST(year(o_orderdate) AS INTEGER)) FROM orders) AS driver_years,
       (SELECT count(DISTINCT dest_iso_alpha3) FROM dedup) AS countries,
       (SELECT count(DISTINCT hs_code) FROM dedup) AS products,
       (SELECT date_diff('day', min(shipment_date), max(shipment_date)) + 1 FROM dedup) AS days,
       (SELECT count(*) FROM dedup) AS fact_rows,
       (SELECT CAST(sum(country_id) AS BIGINT) FROM dedup JOIN (
          SELECT dest_iso_alpha3, row_number() OVER (ORDER BY dest_iso_alpha3) AS country_id
          FROM (SELECT DISTINCT dest_iso_alpha3 FROM dedup)) USING (dest_iso_alpha3)) AS country_id_sum,
       'SUCCESS' AS run_status""", *PIPE_SQL), ids=("O-1", "O-2", "A-25", "S-10", "S-13", "S-17", "S-18", "Q-9", "J-2"))
def pipeline_refresh(spark, sf_dir):
    """drivers -> clean -> gate -> star on trade-derived records; counters, star counts, status."""
    suite = [Q.row_count_at_least(1), Q.not_null("fob_usd"), Q.not_null("dest_iso_alpha3"),
             Q.between("unit_price_usd", 0, strict_min=True)]
    root = scratch_path(spark, "pipeline", uuid.uuid4().hex)
    annual = (read_table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"))
              .agg(F.avg("o_totalprice").alias("price")))
    cfg = PipelineConfig(raw_dir="", warehouse_dir=root,
                         drivers={"price": (annual, ["year", "price"], ["price"])},
                         iso_table=nation_iso(spark, sf_dir), suite=suite,
                         flat=trade_records(spark, sf_dir), order_cols=ORDER)
    state: dict = {}
    report = run_pipeline(spark, cfg, out_state=state)
    status = report.select("run_status").first()["run_status"]
    counters = state.get("counters") or {}
    cols = ["rows_in", "rows_dropped_aggregate", "rows_dropped_null", "rows_deduped",
            "rows_outlier_flagged", "rows_out"]
    star = {}
    if status == "SUCCESS":
        for c, table in (("driver_years", "driver_price"), ("countries", "dim_country"),
                         ("products", "dim_product"), ("days", "dim_time")):
            star[c] = W.read_current(spark, root, table).count()
        star |= W.read_current(spark, root, "fact_shipment").agg(
            F.count("*").alias("fact_rows"), F.sum("country_id").alias("country_id_sum")).first().asDict()
    counters = counters | star
    cols += ["driver_years", "countries", "products", "days", "fact_rows", "country_id_sum"]
    row = tuple(counters.get(c) for c in cols) + (status,)
    return spark.createDataFrame([row], ", ".join(f"{c} bigint" for c in cols)
                                 + ", run_status string")
