"""Marts and benchmark operators on literal frames (edge cases of SURVEY §4.1)."""

import datetime as dt

from pyspark.sql import functions as F

from tradelens.operators import benchmark as B
from tradelens.operators import marts as M
from tradelens.operators import seasonality as S
from tradelens.params import BenchmarkParams


def test_price_gap_ratios_null_when_base_not_positive(spark):
    avg = spark.createDataFrame([("p1", "IN", 0.0), ("p1", "VN", 7.0),
                                 ("p2", "IN", 2.0), ("p2", "VN", 9.0)],
                                "product string, reporter string, avg_price double")
    g = {r["product"]: r for r in B.price_gaps(avg, "IN", BenchmarkParams()).collect()}
    assert g["p1"]["gap"] == 7.0 and g["p1"]["warn"] is True
    assert g["p1"]["gap_ratio"] is None and g["p1"]["price_ratio"] is None
    assert g["p2"]["gap_ratio"] == 3.5 and g["p2"]["price_ratio"] == 4.5


def test_reporter_panel_excludes_world_for_competitors_only(spark):
    rows = [("IN", 2023, "p", 10.0, 2.0, 0), ("IN", 2023, "p", 10.0, 2.0, 5),
            ("VN", 2023, "p", 99.0, 1.0, 0), ("VN", 2023, "p", 30.0, 3.0, 7),
            ("MA", 2023, "p", 5.0, 0.0, 9)]           # qty 0 -> dropped
    df = spark.createDataFrame(rows, "rep string, y int, prod string, v double, q double, partner int")
    p = {r["reporter"]: (r["fob"], r["qty"], r["price"]) for r in
         B.reporter_panel(df, "rep", "y", "prod", "v", "q", "partner", "IN").collect()}
    assert p == {"IN": (20.0, 4.0, 5.0), "VN": (30.0, 3.0, 10.0)}


def test_yoy_zero_prior_year_is_null_and_first_year_dropped(spark):
    rows = [("a", 2019, 0.0), ("a", 2020, 5.0), ("a", 2022, 10.0)]   # 2021 missing -> 0
    df = spark.createDataFrame(rows, "k string, year int, v double")
    out = {r["year"]: r["yoy_pct"] for r in M.yoy_change(df, "k", "year", "v").collect()}
    assert set(out) == {2020, 2021, 2022}
    assert out[2020] is None           # x / 0
    assert out[2021] == -100.0
    assert out[2022] is None           # previous year zero-filled


def test_histogram_max_in_last_bin_and_counts(spark):
    df = spark.createDataFrame([("g", float(v)) for v in range(0, 101)], "k string, v double")
    h = {r["bin"]: r["n"] for r in M.histogram(df, "k", "v", bins=10, clip_quantile=1.0).collect()}
    assert sum(h.values()) == 101 and max(h) == 9 and h[9] == 11


def test_concentration_shares(spark):
    df = spark.createDataFrame([("a", 50.0), ("b", 30.0), ("c", 20.0)], "k string, v double")
    r = M.concentration(df, "k", "v", top_n=2).first()
    assert (r["n_keys"], r["top1_share"], r["top2_share"]) == (3, 0.5, 0.8)


def test_peak_premium_rollup_has_whole_row(spark):
    rows = [("A", dt.date(2020, m, 1), 10.0 if m not in (9, 10, 11) else 20.0)
            for m in range(1, 13)]
    rows += [("B", dt.date(2020, m, 1), 5.0) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "seg string, d date, v double")
    out = {r["segment"]: round(r["premium"], 9) for r in
           S.peak_premium_rollup(df, F.col("seg"), "d", "v").collect()}
    assert out["B"] == 0.0
    assert out["A"] == round(20.0 / 12.5 - 1, 9)
    assert out["ALL"] == round(25.0 / 17.5 - 1, 9)
