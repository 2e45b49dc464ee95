"""Quality suite (one scan), constraint checks and examples on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradelens.operators import clean as C
from tradelens.operators import quality as Q
from tradelens.params import KNOWN_SOURCES
from tradelens.plans.q_clean import canonical_projection
from tradelens.plans.registry import register
from tradelens.sources.tables import read_table, trade, with_trade

REQUIRED_COLS = ["shipment_date", "year", "month", "quarter", "financial_year",
                 "is_peak_season", "hs_code", "hs_desc", "dest_iso_alpha3",
                 "dest_country_name", "fob_usd", "quantity_kg", "unit_price_usd",
                 "is_outlier", "source"]
SCOPE_CODES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]


def binding_suite() -> list[Q.Expectation]:
    """The 20-check suite with ranges bound to the test data (years 1995-2001,
    product types as codes)."""
    return [
        Q.columns_exist(REQUIRED_COLS),
        Q.row_count_at_least(100),
        Q.not_null("shipment_date"), Q.not_null("fob_usd"), Q.not_null("quantity_kg"),
        Q.not_null("unit_price_usd"), Q.not_null("hs_code"), Q.not_null("dest_iso_alpha3"),
        Q.not_null("source"),
        Q.between("fob_usd", 0, 500_000_000, strict_min=True),
        Q.between("quantity_kg", 0, strict_min=True),
        Q.between("unit_price_usd", 0, 10_000, strict_min=True),
        Q.between("year", 1995, 2001),
        Q.between("month", 1, 12),
        Q.length_equals("dest_iso_alpha3", 3),
        Q.matches_regex("hs_code", "[A-Z]+"),
        Q.in_set("hs_code", SCOPE_CODES),
        Q.in_set("source", list(KNOWN_SOURCES)),
        Q.in_set("is_peak_season", [True, False]),
        Q.in_set("is_outlier", [True, False]),
    ]


def clean_like(spark, sf_dir):
    c = canonical_projection(spark, sf_dir).withColumn(
        "dest_iso_alpha3",
        F.concat(F.lit("N"), F.regexp_extract("dest_country_name", r"(\d+)$", 1)))
    return C.flag_outliers(c, "hs_code", "unit_price_usd")


CLEAN_SQL = """
c0 AS (SELECT shipment_date, CAST(year(shipment_date) AS INTEGER) AS year,
              CAST(month(shipment_date) AS INTEGER) AS month, product AS hs_code,
              'N' || regexp_extract(market, '(\\d+)$', 1) AS dest_iso_alpha3,
              CAST(value AS DOUBLE) AS fob_usd, qty AS quantity_kg,
              round(CAST(value AS DOUBLE) / qty, 4) AS unit_price_usd, 'COMTRADE' AS source,
              month(shipment_date) IN (9, 10, 11) AS is_peak_season
       FROM trade),
thr AS (SELECT hs_code, CASE WHEN count(*) >= 20 THEN quantile_cont(unit_price_usd, 0.99) END AS t
        FROM c0 GROUP BY hs_code),
c AS (SELECT c0.*, coalesce(c0.unit_price_usd > thr.t, false) AS is_outlier
      FROM c0 JOIN thr USING (hs_code)),
n AS (SELECT count(*) AS rows FROM c)"""


def _pct(expr: str) -> str:
    return f"round(100.0 * ({expr}) / greatest((SELECT rows FROM n), 1), 4)"


def _row(idx, kind, col, bad):
    n = f"(SELECT count_if({bad}) FROM c)"
    return (f"SELECT {idx} AS idx, 'expect_{kind}' AS expectation_type, {col} AS column_name, "
            f"{n} = 0 AS success, {n} AS unexpected_count, {_pct(n)} AS unexpected_percent")


def _suite_sql() -> str:
    nn = ["shipment_date", "fob_usd", "quantity_kg", "unit_price_usd", "hs_code",
          "dest_iso_alpha3", "source"]
    parts = [
        "SELECT 0 AS idx, 'expect_columns_to_exist' AS expectation_type, CAST(NULL AS VARCHAR) AS column_name,"
        " true AS success, CAST(0 AS BIGINT) AS unexpected_count, 0.0 AS unexpected_percent",
        "SELECT 1, 'expect_table_row_count_to_be_above', NULL, (SELECT rows FROM n) >= 100, 0, 0.0",
    ]
    for i, col in enumerate(nn):
        bad = f"{col} IS NULL" + (" OR isnan(" + col + ")" if col in ("fob_usd", "quantity_kg", "unit_price_usd") else "")
        parts.append(_row(2 + i, "column_values_to_not_be_null", f"'{col}'", bad))
    rng = [("fob_usd", "fob_usd > 0 AND fob_usd <= 500000000"),
           ("quantity_kg", "quantity_kg > 0"),
           ("unit_price_usd", "unit_price_usd > 0 AND unit_price_usd <= 10000"),
           ("year", "year >= 1995 AND year <= 2001"),
           ("month", "month >= 1 AND month <= 12")]
    for j, (col, ok) in enumerate(rng):
        parts.append(_row(9 + j, "column_values_to_be_between", f"'{col}'",
                          f"NOT coalesce({ok}, false)"))
    parts.append(_row(14, "column_value_lengths_to_equal", "'dest_iso_alpha3'",
                      "NOT coalesce(length(dest_iso_alpha3) = 3, false)"))
    parts.append(_row(15, "column_values_to_match_regex", "'hs_code'",
                      "NOT coalesce(regexp_full_match(hs_code, '[A-Z]+'), false)"))
    codes = ", ".join(f"'{v}'" for v in SCOPE_CODES)
    srcs = ", ".join(f"'{v}'" for v in KNOWN_SOURCES)
    parts.append(_row(16, "column_values_to_be_in_set", "'hs_code'",
                      f"NOT coalesce(hs_code IN ({codes}), false)"))
    parts.append(_row(17, "column_values_to_be_in_set", "'source'",
                      f"NOT coalesce(source IN ({srcs}), false)"))
    parts.append(_row(18, "column_values_to_be_in_set", "'is_peak_season'",
                      "NOT coalesce(is_peak_season IN (true, false), false)"))
    parts.append(_row(19, "column_values_to_be_in_set", "'is_outlier'",
                      "NOT coalesce(is_outlier IN (true, false), false)"))
    body = "\nUNION ALL\n".join(parts)
    return with_trade(f"SELECT idx, expectation_type, column_name, success, "
                      f"CAST(unexpected_count AS BIGINT) AS unexpected_count, "
                      f"CAST(unexpected_percent AS DOUBLE) AS unexpected_percent FROM (\n{body}\n)",
                      CLEAN_SQL)


@register("expectation_suite", _suite_sql(), ids=("Q-1", "Q-2", "Q-3", "Q-4", "Q-5", "Q-6",
                                                   "Q-7", "Q-8"))
def expectation_suite(spark, sf_dir):
    res = Q.run_suite(clean_like(spark, sf_dir), binding_suite())
    return res.select("idx", "expectation_type", F.col("column").alias("column_name"), "success",
                      "unexpected_count", "unexpected_percent")


@register("suite_summary", f"""
SELECT count(*) AS n_expectations, CAST(count_if(success) AS BIGINT) AS success_count,
       CAST(count_if(NOT success) AS BIGINT) AS failure_count, count_if(NOT success) = 0 AS overall_success
FROM ({_suite_sql()})""", ids=("S-18", "Q-9"))
def suite_summary(spark, sf_dir):
    return Q.summary(Q.run_suite(clean_like(spark, sf_dir), binding_suite()))


@register("constraint_checks", """
WITH li AS (SELECT * FROM lineitem)
SELECT (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM li
                              GROUP BY 1, 2 HAVING count(*) > 1)) AS n_duplicate_keys,
       (SELECT count(*) FROM li WHERE l_partkey NOT IN (SELECT p_partkey FROM part)) AS n_orphan_part,
       (SELECT count(*) FROM li WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)) AS n_orphan_supplier,
       (SELECT CAST(count_if(NOT coalesce(round(l_extendedprice / l_quantity, 4) > 0, false)) AS BIGINT) FROM li)
         AS chk_unit_price_positive,
       (SELECT CAST(count_if(NOT coalesce(l_extendedprice >= 0 AND l_extendedprice <= 500000000, false)) AS BIGINT) FROM li)
         AS chk_value_range,
       (SELECT CAST(count_if(NOT coalesce(l_quantity > 0, false)) AS BIGINT) FROM li) AS chk_qty_positive""",
          ids=("Q-10",))
def constraint_checks(spark, sf_dir):
    from tradelens.functions.numeric import fround
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    supp = read_table(spark, sf_dir, "supplier")
    dups = Q.duplicate_keys(li, ["l_orderkey", "l_linenumber"]).agg(
        F.count("*").alias("n_duplicate_keys"))
    op = Q.orphan_keys(li, part, "l_partkey", "p_partkey").agg(F.count("*").alias("n_orphan_part"))
    os_ = Q.orphan_keys(li, supp, "l_suppkey", "s_suppkey").agg(
        F.count("*").alias("n_orphan_supplier"))
    chk = Q.constraint_summary(li, {
        "chk_unit_price_positive": fround(F.col("l_extendedprice") / F.col("l_quantity"), 4) > 0,
        "chk_value_range": (F.col("l_extendedprice") >= 0) & (F.col("l_extendedprice") <= 5e8),
        "chk_qty_positive": F.col("l_quantity") > 0,
    })
    return dups.crossJoin(op).crossJoin(os_).crossJoin(chk)


@register("unexpected_examples", with_trade("""
SELECT DISTINCT brand AS value FROM trade
WHERE NOT coalesce(brand IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#14', 'Brand#15'), false)
ORDER BY value LIMIT 5"""), ids=("L-5",))
def unexpected_examples(spark, sf_dir):
    e = Q.in_set("brand", ["Brand#11", "Brand#12", "Brand#13", "Brand#14", "Brand#15"])
    return Q.unexpected_examples(trade(spark, sf_dir), e, 5)
