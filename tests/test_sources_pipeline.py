"""Raw JSON landing zone, CSV/source resolution and the pipeline gate."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tradelens.operators import quality as Q
from tradelens.operators import warehouse as W
from tradelens.plans.pipeline import PipelineConfig, run_pipeline
from tradelens.sources import files as FS
from tradelens.sources import raw_json as R


def _rec(year, month, partner, name, code, value, qty):
    return {"refYear": year, "refMonth": month, "partnerCode": partner, "partnerDesc": name,
            "reporterDesc": "India", "cmdCode": code, "cmdDesc": "d",
            "primaryValue": value, "qty": qty}


def _write(path, payload):
    with open(path, "w") as f:
        f.write(payload if isinstance(payload, str) else json.dumps(payload))


@pytest.fixture()
def landing(tmp_dir):
    d = os.path.join(tmp_dir, "raw")
    os.makedirs(d)
    old = [_rec(2020, m, 356, "India", "440929", 1.0, 1.0) for m in range(1, 3)]
    new = [_rec(2020, m, 356, "India", "440929", 100.0 + m, 10.0) for m in range(1, 13)]
    new += [_rec(2020, 52, 356, "India", "440929", 999.0, 1.0)]        # annual row
    _write(f"{d}/comtrade_440929_2020_20240101.json", {"data": old})
    _write(f"{d}/comtrade_440929_2020_20240301.json", {"data": new, "count": 13})
    _write(f"{d}/comtrade_130232_2020_20240301.json", "{not json")       # malformed
    _write(f"{d}/comtrade_330749_2020_20240301.json", {"data": []})      # empty
    _write(f"{d}/comtrade_benchmark_VNM_440929_2020.json", {"data": new})  # must be ignored
    return d


def test_latest_snapshot_per_key_and_strict_pattern(spark, landing):
    files = R.snapshot_files(spark, landing)
    assert files.count() == 4
    latest = {(r["code"], r["year"]): r["stamp"] for r in R.latest_snapshots(files).collect()}
    assert latest[("440929", 2020)] == "20240301"


def test_flatten_skips_malformed_and_empty(spark, landing):
    flat, rejects = R.load_latest(spark, landing)
    assert flat.count() == 13
    assert rejects.count() == 1
    assert flat.select("__file").distinct().count() == 1


def test_all_empty_raises(spark, tmp_dir):
    d = os.path.join(tmp_dir, "raw2")
    os.makedirs(d)
    _write(f"{d}/comtrade_440929_2020_20240101.json", {"data": []})
    with pytest.raises(ValueError):
        R.load_latest(spark, d)


def test_manifest_states(spark, landing):
    files = R.snapshot_files(spark, landing)
    docs = R.read_documents(spark, [f"{landing}/{r['file']}" for r in files.collect()])
    expected = spark.createDataFrame(
        [("440929", 2020), ("130232", 2020), ("330749", 2020), ("999999", 2020)], "code string, year int")
    manifest = R.landing_manifest(files, docs, expected)
    assert {r["code"]: (r["status"], r["rows"]) for r in manifest.collect()} == {
        "440929": ("OK", 13), "130232": ("FAILED", 0), "330749": ("EMPTY", 0), "999999": ("MISSING", 0)}
    totals = {r["status"]: (r["documents"], r["rows"]) for r in R.manifest_totals(manifest).collect()}
    assert totals == {"OK": (1, 13), "FAILED": (1, 0), "EMPTY": (1, 0), "MISSING": (1, 0)}


def test_competitor_panel_defaults(spark, tmp_dir):
    d = os.path.join(tmp_dir, "cache")
    os.makedirs(d)
    recs = [{"refYear": None, "partnerCode": 0, "cmdCode": None, "primaryValue": None, "qty": 5},
            {"refYear": 2021, "partnerCode": 4, "cmdCode": "442090", "primaryValue": 7, "qty": None}]
    _write(f"{d}/comtrade_benchmark_Vietnam_442090_2021.json", {"data": recs})
    rows = sorted(R.competitor_panel(spark, d).collect(), key=lambda r: r["partner_code"])
    assert (rows[0]["year"], rows[0]["code"], rows[0]["fob_usd"]) == (2021, "442090", 0.0)
    assert rows[1]["quantity_kg"] == 0.0


def test_csv_code_padding_and_resolve_source(spark, tmp_dir):
    p = os.path.join(tmp_dir, "s.csv")
    _write(p, "hs_code,v\n44209,1.5\n130232,2\n")
    df = FS.read_csv(spark, p, "hs_code string, v double", code_col="hs_code")
    assert sorted(r[0] for r in df.collect()) == ["044209", "130232"]
    name, got = FS.resolve_source([
        ("missing", lambda: spark.read.parquet(os.path.join(tmp_dir, "nope"))),
        ("empty", lambda: df.filter(F.lit(False))),
        ("csv", lambda: df)])
    assert name == "csv" and got.count() == 2
    with pytest.raises(Exception):
        FS.resolve_source([("broken", lambda: df.select("no_such_column"))])


def test_landed_records_are_read_back_and_never_overwritten(spark, tmp_dir):
    recs = [_rec(2020, m, 356, "India", "440929", 10.0 * m, 1.0) for m in (1, 2, 3)]
    df = spark.createDataFrame([tuple(r.get(f.name) and str(r[f.name]) for f in R.RECORD) for r in recs],
                               ", ".join(f"{f.name} string" for f in R.RECORD))
    df = df.select(*[F.col(f.name).cast(f.dataType) for f in R.RECORD])
    R.land_records(df.limit(1), tmp_dir, "440929", 2020, "20240101")
    R.land_records(df, tmp_dir, "440929", 2020, "20240201")
    flat, _ = R.load_latest(spark, tmp_dir)
    assert sorted(r["refMonth"] for r in flat.collect()) == [1, 2, 3]
    with pytest.raises(FileExistsError):
        R.land_records(df, tmp_dir, "440929", 2020, "20240201")
    R.land_records(df.limit(0), tmp_dir, "130232", 2020, "20240201")
    assert R.snapshot_files(spark, tmp_dir).count() == 3


def _iso(spark):
    return spark.createDataFrame([("India", "IND")], "name string, iso string")


def test_pipeline_publishes_and_gate_halts(spark, landing, tmp_dir):
    wh = os.path.join(tmp_dir, "wh")
    good = PipelineConfig(raw_dir=landing, warehouse_dir=wh, iso_table=_iso(spark),
                          suite=[Q.row_count_at_least(1), Q.not_null("fob_usd")])
    rep = {r["stage"]: r["status"] for r in run_pipeline(spark, good).collect()}
    assert rep == {"clean": "SUCCESS", "validate": "SUCCESS", "load": "SUCCESS"}
    assert W.read_current(spark, wh, "fact_shipment").count() == 12
    bad = PipelineConfig(raw_dir=landing, warehouse_dir=wh, iso_table=_iso(spark),
                         suite=[Q.row_count_at_least(10_000)])
    out = run_pipeline(spark, bad).collect()
    rep = {r["stage"]: r["status"] for r in out}
    assert rep["validate"] == "FAILED" and "load" not in rep
    assert out[0]["run_status"] == "FAILED"
    # the last good snapshot is still the published one
    assert W.read_current(spark, wh, "fact_shipment").count() == 12
    audit = spark.read.parquet(os.path.join(wh, "pipeline_run"))
    assert sorted(r["status"] for r in audit.collect()) == ["FAILED", "SUCCESS"]


def test_pipeline_publishes_a_star_whose_keys_resolve(spark, landing, tmp_dir):
    wh = os.path.join(tmp_dir, "wh_star")
    annual = spark.createDataFrame([(2020, 5.0), (2021, 6.0)], "year int, rain double")
    cfg = PipelineConfig(raw_dir=landing, warehouse_dir=wh, iso_table=_iso(spark), suite=[Q.row_count_at_least(1)],
                         drivers={"rain": (annual, ["year", "rain"], ["rain"])})
    for _ in range(2):  # known members keep their ids
        rep = {r["stage"]: r["status"] for r in run_pipeline(spark, cfg).collect()}
        assert rep == {s: "SUCCESS" for s in ("drivers", "clean", "validate", "load")}
        assert [tuple(r) for r in W.read_current(spark, wh, "dim_country").collect()] == [("IND", "India", 1)]
    fact = W.read_current(spark, wh, "fact_shipment")
    time = W.read_current(spark, wh, "dim_time").withColumnRenamed("date", "shipment_date")
    assert fact.join(time.select("shipment_date", "time_id"), ["shipment_date", "time_id"]).count() == 12
    assert fact.join(W.read_current(spark, wh, "dim_product"), ["hs_code", "product_id"]).count() == 12
    header = spark.read.json(os.path.join(wh, "validation_report", "*", "header"))
    assert [r["success_count"] for r in header.collect()] == [1, 1]


def test_pipeline_halts_on_drivers_that_are_not_positive_and_on_no_clean_rows(spark, landing, tmp_dir):
    wh = os.path.join(tmp_dir, "wh_halt")
    annual = spark.createDataFrame([(2020, 5.0), (2021, None)], "year int, rain double")
    cfg = PipelineConfig(raw_dir=landing, warehouse_dir=wh, iso_table=_iso(spark),
                         drivers={"rain": (annual, ["year", "rain"], ["rain"])})
    assert [(r["stage"], r["status"]) for r in run_pipeline(spark, cfg).collect()] == [("drivers", "FAILED")]
    none = spark.createDataFrame([], "name string, iso string")
    cfg = PipelineConfig(raw_dir=landing, warehouse_dir=wh, iso_table=none, suite=[Q.not_null("fob_usd")])
    assert [(r["stage"], r["status"]) for r in run_pipeline(spark, cfg).collect()] == [("clean", "FAILED")]
    assert W.current_version(spark, wh, "fact_shipment") is None


def test_pipeline_dry_run_writes_nothing(spark, landing, tmp_dir):
    wh = os.path.join(tmp_dir, "wh_dry")
    cfg = PipelineConfig(raw_dir=landing, warehouse_dir=wh, iso_table=_iso(spark),
                         suite=[Q.row_count_at_least(1)], dry_run=True)
    out = run_pipeline(spark, cfg).collect()
    assert out[0]["run_status"] == "DRY_RUN"
    assert not os.path.exists(wh)


def test_write_clean_partitioned_with_csv_twin(spark, tmp_dir):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 2020, "440929", 1.0),
                                (dt.date(2021, 5, 1), 2021, "130232", 2.0)],
                               "shipment_date date, year int, hs_code string, fob_usd double")
    FS.write_clean(df, tmp_dir, csv_twin=True)
    back = spark.read.parquet(os.path.join(tmp_dir, "clean.parquet"))
    assert sorted(r["year"] for r in back.collect()) == [2020, 2021]
    assert back.filter("year = 2021").inputFiles()  # partition pruning by year
    csv = spark.read.option("header", True).csv(os.path.join(tmp_dir, "clean.csv"))
    assert csv.count() == 2
