"""Source-level operators bound to the test tables (S-2, S-3, S-4, S-6, P-11, json)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradelens.functions.dates import years_between
from tradelens.plans.registry import register
from tradelens.sources.files import union_by_name as _union
from tradelens.sources.tables import read_table, trade, with_trade


@register("latest_snapshot", """
SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role FROM conversations GROUP BY conv_id""",
          ids=("S-2",))
def latest_snapshot(spark, sf_dir):
    """Newest version per key: greatest turn per conversation (grouped max of a
    struct -- partial aggregation, no window over a possibly hot key)."""
    c = read_table(spark, sf_dir, "conversations")
    best = F.max(F.struct("turn", "role"))
    return c.groupBy("conv_id").agg(best.alias("b")).select(
        "conv_id", F.col("b.turn").alias("turn"), F.col("b.role").alias("role"))


@register("semi_structured_props", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
          ids=("S-1",))
def semi_structured_props(spark, sf_dir):
    """Semi-structured field to a typed column with an explicit schema."""
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    return e.select("event_id", "event_type",
                    F.from_json("props", "k int").getField("k").alias("k"))


@register("union_by_name", """
SELECT event_id, ts, value, NULL::VARCHAR AS event_type, NULL::BIGINT AS user_id FROM events
UNION ALL
SELECT event_id, NULL::TIMESTAMP, NULL::DOUBLE, event_type, user_id FROM events""",
          ids=("S-3",))
def union_by_name(spark, sf_dir):
    """Two feeds of all events with different columns, in different order."""
    e = read_table(spark, sf_dir, "events")
    a = e.select("event_id", "ts", "value")
    b = e.select("user_id", "event_type", "event_id")
    return _union([a, b]).select("event_id", "ts", "value", "event_type", "user_id")


@register("star_read", with_trade("""
SELECT CAST(year(shipment_date) AS INTEGER) AS year, CAST(month(shipment_date) AS INTEGER) AS month,
       market, product, CAST(sum(value) AS DOUBLE) AS fob_usd, sum(qty) AS quantity_kg, count(*) AS n_rows
FROM trade
WHERE year(shipment_date) BETWEEN 1996 AND 1999 AND product IN ('ECONOMY', 'SMALL')
  AND reporter = 'NATION_3'
GROUP BY 1, 2, 3, 4"""), ids=("S-4", "S-6", "J-1", "P-11"))
def star_read(spark, sf_dir):
    """Fact x dimensions with year/month projected, range + set + equality
    filters (pushed to the scans where they reference scan columns)."""
    t = trade(spark, sf_dir)
    f = t.filter(years_between("shipment_date", 1996, 1999)
                 & F.col("product").isin("ECONOMY", "SMALL")
                 & (F.col("reporter") == "NATION_3"))
    return (f.groupBy(F.year("shipment_date").alias("year"), F.month("shipment_date").alias("month"),
                      "market", "product")
             .agg(F.sum("value").cast("double").alias("fob_usd"),
                  F.sum("qty").alias("quantity_kg"), F.count("*").alias("n_rows")))
