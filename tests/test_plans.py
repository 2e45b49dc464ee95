"""Physical-plan properties the scale design relies on (checked with explain)."""

import re

from tradelens.plans.registry import load_all

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


def test_flagship_reads_only_needed_columns(spark):
    df = load_all()["peak_premium"].fn(spark, SF)
    schemas = _read_schemas(_plan(df))
    assert schemas, "expected a parquet scan"
    cols = set(c.split(":")[0] for c in schemas[0].split(","))
    assert cols <= {"shipment_date", "product", "value", "value_units"}


def test_filters_reach_the_scan(spark):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        load_all()["star_read"].fn(spark, SF).explain("formatted")
    pushed = [ln for ln in buf.getvalue().splitlines() if ln.startswith("PushedFilters")]
    assert any("GreaterThanOrEqual(shipment_date" in ln and "EqualTo(reporter" in ln
               for ln in pushed)


def test_quality_suite_scans_fact_at_most_twice(spark):
    # one scan for the rows, one for the per-product outlier thresholds
    plan = _plan(load_all()["expectation_suite"].fn(spark, SF))
    assert plan.count("FileScan parquet") <= 2
    assert "SortMergeJoin" not in plan


def test_risk_scan_count_is_bounded(spark):
    # per-key signals are checkpointed: the fact is not re-scanned per branch
    plan = _plan(load_all()["risk_bands"].fn(spark, SF))
    assert plan.count("FileScan parquet") <= 2


def test_bounded_dims_are_broadcast_when_building_the_fact(spark):
    from tradelens.sources.tables import build_trade
    plan = build_trade(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan.lower()


def test_fact_build_is_dealt_out_finely(spark, tmp_dir, monkeypatch):
    """The published fact's join and sort get partitions of 16 MB, as many as the input asks for."""
    from tradelens.session import fine_shuffles
    from tradelens.sources import tables

    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    number = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    dims = {"lineitem": "1 l_orderkey, 1 l_partkey, 1 l_suppkey, 1 l_linenumber, 1D l_quantity, 9.5D l_extendedprice, "
                        "0.1D l_discount, 'N' l_returnflag, timestamp'1997-03-04 05:06:07' l_shipdate",
            "orders": "1 o_orderkey, 1 o_custkey", "customer": "1 c_custkey, 1 c_nationkey",
            "part": "1 p_partkey, 'SMALL' p_type, 'B' p_brand", "supplier": "1 s_suppkey, 1 s_nationkey",
            "nation": "1 n_nationkey, 'PERU' n_name"}
    for name, row in dims.items():
        spark.range(1).selectExpr(*[c.strip() for c in row.split(", ")]).write.parquet(f"{tmp_dir}/{name}.parquet")
    seen, build = [], tables.build_trade
    monkeypatch.setattr(tables, "build_trade", lambda s, d: (
        seen.append((s.conf.get(size), s.conf.get(number, None))), build(s, d))[1])
    before = (spark.conf.get(size), spark.conf.get(number, None))
    assert tables.trade(spark, tmp_dir).count() == 1
    assert seen == [(str(16 << 20), spark.conf.get("spark.sql.shuffle.partitions"))]
    assert (spark.conf.get(size), spark.conf.get(number, None)) == before
    counts = []
    for gb in (1, 10, 100_000):
        with fine_shuffles(spark, gb << 30):
            counts.append(int(spark.conf.get(number)))
    assert counts == [256, 2560, 20_000]
    assert (spark.conf.get(size), spark.conf.get(number, None)) == before
