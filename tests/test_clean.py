"""Cleaning operators on literal frames (FIXTURES.md section 4 edge cases)."""

import datetime as dt

from pyspark.sql import functions as F

from tradelens.functions.dates import financial_year, month_from_parts
from tradelens.functions.numeric import clip, coerce_double, fround
from tradelens.operators import clean as C
from tradelens.params import CleanParams


def test_month_52_and_invalid_parts_are_null(spark):
    df = spark.createDataFrame([(2020, 7), (2020, 52), (None, 3), (2020, None), (2020, 0)],
                               "y int, m int")
    out = [r[0] for r in df.select(month_from_parts("y", "m")).collect()]
    assert out == [dt.date(2020, 7, 1), None, None, None, None]


def test_financial_year_labels(spark):
    df = spark.createDataFrame([(dt.date(2024, 4, 1),), (dt.date(2025, 3, 31),),
                                (dt.date(1999, 12, 1),), (dt.date(2000, 1, 1),)], "d date")
    out = [r[0] for r in df.select(financial_year("d")).collect()]
    assert out == ["FY24-25", "FY24-25", "FY99-00", "FY99-00"]


def test_aggregate_partner_filter_keeps_null_codes(spark):
    df = spark.createDataFrame([(0,), (99,), (None,), (356,)], "code int")
    kept = C.drop_aggregate_partners(df, "code", CleanParams().aggregate_codes)
    assert sorted(kept.collect(), key=lambda r: (r[0] is None, r[0])) == [(356,), (None,)]


def test_unparsable_number_becomes_null(spark):
    df = spark.createDataFrame([("12.5",), ("n/a",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(coerce_double("v")).collect()] == [12.5, None, None, None]


def test_validity_rules_zero_negative_null(spark):
    rows = [(dt.date(2020, 1, 1), 10.0, 1.0), (dt.date(2020, 1, 1), 0.0, 1.0),
            (dt.date(2020, 1, 1), -5.0, 1.0), (dt.date(2020, 1, 1), 5.0, 0.0),
            (None, 5.0, 1.0), (dt.date(2020, 1, 1), None, 1.0)]
    df = spark.createDataFrame(rows, "shipment_date date, fob_usd double, quantity_kg double")
    assert C.valid_rows(df).count() == 1
    reasons = sorted(r[0] or "ok" for r in df.select(C.validity_reason()).collect())
    assert reasons == ["non_positive_qty", "non_positive_value", "non_positive_value",
                       "null_date", "null_value", "ok"]


def test_dedupe_keeps_first_in_input_order(spark):
    rows = [("a", 1.0, "f1", 0, "first"), ("a", 1.0, "f1", 1, "second"),
            ("a", 2.0, "f1", 2, "other value"), ("b", 1.0, "f2", 0, "only")]
    df = spark.createDataFrame(rows, "k string, v double, __file string, __pos int, tag string")
    out = C.dedupe_keep_first(df, ["k", "v"], ["__file", "__pos"])
    tags = sorted(r["tag"] for r in out.collect())
    assert tags == ["first", "only", "other value"]


def test_outlier_guard_19_vs_20_rows(spark):
    small = [("S", float(i)) for i in range(1, 20)]          # 19 rows: never flagged
    big = [("B", float(i)) for i in range(1, 21)]            # 20 rows: max is flagged
    df = spark.createDataFrame(small + big, "g string, price double")
    out = C.flag_outliers(df, "g", "price")
    flagged = {(r["g"], r["price"]) for r in out.filter("is_outlier").collect()}
    assert flagged == {("B", 20.0)}


def test_unit_price_rounding_and_clip(spark):
    df = spark.createDataFrame([(10.0, 3.0, None), (5153.62725, 1.0, 7.0)],
                               "v double, q double, x double")
    r = df.select(fround(F.col("v") / F.col("q"), 4).alias("p"),
                  clip("x", 0.0, 5.0).alias("c")).collect()
    assert r[0]["p"] == 3.3333 and r[0]["c"] is None
    assert r[1]["p"] == 5153.6272 and r[1]["c"] == 5.0


def test_name_lookup_override_drop_unknown(spark):
    names = spark.createDataFrame([("Viet Nam",), ("Bunkers",), ("Atlantis",), ("India",),
                                   ("Rep. of Korea",)], "partnerDesc string")
    iso = spark.createDataFrame([("Vietnam", "VNM"), ("India", "IND"), ("South Korea", "KOR")],
                                "name string, iso string")
    ov = C.overrides_frame(spark, {"Viet Nam": "Vietnam", "Bunkers": None,
                                   "Rep. of Korea": "South Korea", "Czechia": "Czech Republic"})
    m = {r["partnerDesc"]: (r["dest_iso_alpha3"], r["name_status"])
         for r in C.map_names_to_iso(names, "partnerDesc", ov, iso).collect()}
    assert m["Viet Nam"] == ("VNM", "mapped")
    assert m["Bunkers"] == (None, "dropped")
    assert m["Atlantis"] == (None, "unmapped")
    assert m["Rep. of Korea"] == ("KOR", "mapped")
    un = C.unmapped_names(C.map_names_to_iso(names, "partnerDesc", ov, iso), "partnerDesc")
    assert [r["name"] for r in un.collect()] == ["Atlantis"]


def test_full_clean_chain_counters_reconcile(spark):
    rows = [
        # file, pos, year, month, partnerCode, partnerDesc, cmdCode, value, qty
        ("f1", 0, 2020, 1, 356, "India", "440929", "100", "10"),
        ("f1", 1, 2020, 1, 356, "India", "440929", "100", "10"),    # duplicate by key
        ("f1", 2, 2020, 52, 356, "India", "440929", "100", "10"),   # annual row -> null date
        ("f1", 3, 2020, 2, 0, "World", "440929", "100", "10"),      # aggregate partner
        ("f1", 4, 2020, 2, 999, "Bunkers", "440929", "100", "10"),  # override -> drop
        ("f1", 5, 2020, 3, 356, "India", "440929", "bad", "10"),    # unparsable value
        ("f1", 6, 2020, 3, 356, "India", "440929", "50", "0"),      # zero quantity
        ("f1", 7, 2020, 4, None, "India", "440929", "70", "7"),     # NULL code kept
    ]
    flat = spark.createDataFrame(rows, "__file string, __pos int, refYear int, refMonth int, "
                                       "partnerCode int, partnerDesc string, cmdCode string, "
                                       "primaryValue string, qty string") \
        .withColumn("cmdDesc", F.lit("d")).withColumn("reporterDesc", F.lit("IN"))
    iso = spark.createDataFrame([("India", "IND")], "name string, iso string")
    ov = C.overrides_frame(spark, CleanParams().overrides)
    tagged = C.tag_records(flat, iso, ov)
    clean = C.clean_from_tagged(tagged)
    rep = C.clean_report(tagged, clean).first().asDict()
    assert rep["rows_in"] == 8
    assert rep["rows_dropped_aggregate"] == 2
    assert rep["rows_dropped_null"] == 3
    assert rep["rows_deduped"] == 1
    assert rep["rows_out"] == 2
    assert rep["rows_in"] == (rep["rows_out"] + rep["rows_dropped_aggregate"]
                              + rep["rows_dropped_null"] + rep["rows_deduped"])
    assert clean.columns == [c for c in C.CANONICAL_COLUMNS if c in clean.columns]
    assert {r["source"] for r in clean.collect()} == {"COMTRADE"}


def test_quantiles_match_percentile_with_hot_values_null_groups_and_null_keys(spark):
    import random

    from tradelens.functions.quantiles import group_quantiles
    rnd = random.Random(7)
    rows = [("hot", 12.5) for _ in range(2000)]
    rows += [("hot", rnd.choice([-1, 1]) * rnd.random() * 10 ** rnd.randint(-9, 9)) for _ in range(1000)]
    rows += [("cold", float(rnd.randint(-5, 50))) for _ in range(17)] + [("one", 4.0), ("cold", None)]
    rows += [(None, float(rnd.randint(0, 9))) for _ in range(40)] + [("none", None)] * 3
    rows += [("wide", v) for v in (float("inf"), -float("inf"), 0.0, -0.0, 5e-324, 1.7e308)]
    df = spark.createDataFrame(rows, "g string, v double")
    qs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    finite = df.where("g is null or g <> 'wide'")
    got = {r["g"]: tuple(r)[1:] for r in group_quantiles(finite, ["g"], "v", qs, count_col="n").collect()}
    want = {r["g"]: tuple(r)[1:] for r in finite.groupBy("g").agg(
        F.count("*").alias("n"), *[F.percentile("v", q).alias(n) for n, q in qs.items()]).collect()}
    assert got == want and got["none"] == (3,) + (None,) * 6
    wide = group_quantiles(df.where("g = 'wide'"), ["g"], "v", {"lo": 0.0, "hi": 1.0}).first()
    assert (wide["lo"], wide["hi"]) == (-float("inf"), float("inf"))


def test_quantiles_of_an_empty_table(spark):
    from tradelens.functions.quantiles import group_quantiles
    df = spark.createDataFrame([], "g string, v double")
    assert group_quantiles(df, ["g"], "v", {"p": 0.5}).collect() == []
    assert [tuple(r) for r in group_quantiles(df, [], "v", {"p": 0.5}, count_col="n").collect()] == [(0, None)]


def test_outlier_join_does_not_shuffle_the_rows(spark):
    df = spark.range(1000).selectExpr("cast(id % 3 as string) as g", "cast(id as double) as p")
    plan = C.flag_outliers(df, "g", "p")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_money_sums_pass_the_long_range(spark):
    from tradelens.functions.numeric import exact_long_sum, money_sum
    df = spark.createDataFrame([(4 * 10 ** 18 + i,) for i in range(4)] + [(-7,), (None,)], "value_units long")
    exact = 16 * 10 ** 18 + 6 - 7
    assert int(df.agg(exact_long_sum("value_units")).first()[0]) == exact
    assert df.agg(money_sum(df, "value")).first()[0] * 10_000 == exact
    assert df.where("value_units is null").agg(exact_long_sum("value_units")).first()[0] is None
