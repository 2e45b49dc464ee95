"""Quality suite contract, constraint checks, upserts and versioned tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradelens.operators import quality as Q
from tradelens.operators import warehouse as W


def test_suite_runs_all_checks_in_one_aggregate(spark):
    df = spark.createDataFrame(
        [("IND", "440929", 10.0), ("US", "44092X", None), (None, "130232", 5.0)],
        "iso string, code string, v double")
    suite = [Q.columns_exist(["iso", "code", "missing_col"]), Q.row_count_at_least(3),
             Q.not_null("v"), Q.length_equals("iso", 3), Q.matches_regex("code", r"\d{6}"),
             Q.in_set("code", ["440929", "130232"]), Q.between("v", 0, 8, strict_min=True),
             Q.not_null("nope")]
    res = Q.run_suite(df, suite)
    rows = {r["idx"]: r for r in res.collect()}
    assert len(rows) == 8
    assert rows[0]["success"] is False and "missing_col" in rows[0]["observed_value"]
    assert rows[1]["success"] is True                     # >= is inclusive
    assert rows[2]["unexpected_count"] == 1
    assert rows[3]["unexpected_count"] == 2               # NULL and 'US'
    assert rows[4]["unexpected_count"] == 1
    assert rows[5]["unexpected_count"] == 1
    assert rows[6]["unexpected_count"] == 2               # NULL and 10 > 8
    assert rows[6]["unexpected_percent"] == 66.6667
    assert rows[7]["error"] == "column missing: nope"
    # one scan: a single aggregate, no join, in the physical plan
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 1 and "Join" not in plan
    with pytest.raises(ValueError):
        Q.gate(res)


def test_regex_is_full_match_and_null_unexpected(spark):
    df = spark.createDataFrame([("123456",), ("123456\n",), ("1234567",), (None,)], "c string")
    res = Q.run_suite(df, [Q.matches_regex("c", r"\d{6}")]).first()
    assert res["unexpected_count"] == 3


def test_constraint_checks(spark):
    child = spark.createDataFrame([(1, 10), (1, 10), (2, 99), (3, None)], "id int, fk int")
    parent = spark.createDataFrame([(10,)], "pk int")
    assert Q.duplicate_keys(child, ["id", "fk"]).count() == 1
    assert Q.orphan_keys(child, parent, "fk", "pk").count() == 1


def test_upsert_semantics_and_idempotence(spark):
    target = spark.createDataFrame([("a", 1.0, "x"), ("b", 2.0, "y")], "k string, v double, note string")
    updates = spark.createDataFrame([("b", 20.0), ("c", 30.0)], "k string, v double")
    once = W.upsert(target, updates, ["k"], status_col="status")
    got = {r["k"]: (r["v"], r["note"], r["status"]) for r in once.collect()}
    assert got == {"a": (1.0, "x", "kept"), "b": (20.0, "y", "updated"), "c": (30.0, None, "inserted")}
    twice = W.upsert(once.drop("status"), updates, ["k"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.drop("status").collect()))


def test_insert_absent_and_writeback(spark):
    target = spark.createDataFrame([("a", 1.0)], "k string, v double")
    updates = spark.createDataFrame([("a", 9.0), ("b", 2.0)], "k string, v double")
    assert sorted(map(tuple, W.insert_absent(target, updates, ["k"]).collect())) == [("a", 1.0), ("b", 2.0)]
    dim = spark.createDataFrame([("a", "old"), ("b", "old")], "k string, label string")
    lab = spark.createDataFrame([("a", "Core")], "k string, label string")
    out = {r["k"]: r["label"] for r in W.write_back_labels(dim, lab, "k", "label").collect()}
    assert out == {"a": "Core", "b": "old"}


def test_surrogate_keys_keep_existing_ids(spark):
    existing = spark.createDataFrame([("x", 1), ("y", 2)], "k string, id long")
    cand = spark.createDataFrame([("y",), ("z",), ("w",)], "k string")
    ext = {r["k"]: r["id"] for r in W.extend_dimension(existing, cand, ["k"], "id").collect()}
    assert ext == {"x": 1, "y": 2, "w": 3, "z": 4}


def test_calendar_dimension(spark):
    cal = W.calendar_between(spark, "2018-01-01", "2030-12-31")
    assert cal.count() == 4748
    r = cal.filter(F.col("date") == dt.date(2024, 10, 1)).first()
    assert (r["time_id"], r["financial_year"], r["is_peak_season"], r["quarter"]) == \
        (20241001, "FY24-25", True, 4)


def test_versioned_replace_keeps_last_good(spark, tmp_dir):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([(3,)], "x int")
    assert W.write_version(a, tmp_dir, "t") == 1
    assert W.write_version(b, tmp_dir, "t", mode="append") == 2
    assert sorted(r[0] for r in W.read_current(spark, tmp_dir, "t").collect()) == [1, 2, 3]
    assert W.write_version(b, tmp_dir, "t") == 3
    assert [r[0] for r in W.read_current(spark, tmp_dir, "t").collect()] == [3]


def test_table_status_missing(spark, tmp_dir):
    W.write_version(spark.createDataFrame([(1,)], "x int"), tmp_dir, "t")
    st = W.table_status(spark, {"t": f"{tmp_dir}/t/v=1", "gone": f"{tmp_dir}/nope"})
    got = {r["table_name"]: (r["status"], r["row_count"]) for r in st.collect()}
    assert got == {"t": ("present", 1), "gone": ("missing", None)}


def test_two_names_for_one_iso_pick_earliest(spark):
    rows = [("TUR", "Türkiye", dt.date(2021, 1, 1)), ("TUR", "Turkey", dt.date(2019, 1, 1)),
            ("TUR", "Turkiye", dt.date(2019, 1, 1)), ("IND", "India", dt.date(2020, 1, 1))]
    df = spark.createDataFrame(rows, "iso string, name string, d date")
    got = {r["iso"]: r["country_name"] for r in
           W.first_name_per_key(df, "iso", "name", "d").collect()}
    assert got == {"TUR": "Turkey", "IND": "India"}   # earliest date, then name


def test_exact_duplicate_rows_counted_once(spark):
    from tradelens.operators import clean as C
    rows = [("a", 1.0), ("a", 1.0), ("a", 1.0), ("b", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    r = C.dedupe_counts(df, ["k", "v"]).first()
    assert (r["kept"], r["duplicate"]) == (2, 2)


def test_suite_kwargs_with_quotes_and_backslashes_round_trip(spark):
    import json
    df = spark.createDataFrame([("a'b",), ("x\\y",)], "c string")
    pattern = r"[a-z]'[a-z]|\w\\\w"
    res = Q.run_suite(df, [Q.matches_regex("c", pattern), Q.in_set("c", ["a'b"])]).collect()
    assert json.loads(res[0]["kwargs"]) == {"pattern": pattern}
    assert res[0]["unexpected_count"] == 0
    assert json.loads(res[1]["kwargs"]) == {"value_set": ["a'b"]}
    assert res[1]["unexpected_count"] == 1 and res[1]["unexpected_percent"] == 50.0
