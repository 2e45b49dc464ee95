"""The refresh job as a chain of DataFrame functions (O-1, O-2).

Stages run in order; each yields (stage, status, detail, seconds); an
exception marks the stage FAILED and halts the run; a stage may be SKIPPED.
Order: driver series (each behind its gate), clean, validate, load.  The clean
table is written once to the shared folder; counters, gate, dimensions and fact
all read that copy, so they see the same rows.  The quality gate runs the whole
suite in one aggregate, records it as a report and raises before anything is
published.  The load extends the country and product dimensions (known members
keep their ids), builds the calendar, resolves the fact's keys and raises if any
stays NULL.  Publishing is a versioned write + pointer flip, so
a failed run leaves the last good snapshot in place.  ``dry_run`` resolves
keys and runs every check but writes nothing to the warehouse (trap T-24).
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.functions.stats import measured
from tradelens.operators import clean as C
from tradelens.operators import drivers as D
from tradelens.operators import quality as Q
from tradelens.operators import warehouse as W
from tradelens.params import CleanParams
from tradelens.sources import raw_json as R


@dataclass
class PipelineConfig:
    raw_dir: str
    warehouse_dir: str
    iso_table: DataFrame | None = None
    suite: list = field(default_factory=list)
    params: CleanParams = field(default_factory=CleanParams)
    dry_run: bool = False
    skip_load: bool = False
    # optional already-flattened records (S-1 output) instead of raw_dir,
    # with their tie-free input-order columns
    flat: DataFrame | None = None
    order_cols: tuple = ("__file", "__pos")
    # driver series: name -> (frame, required columns, columns that must be positive)
    drivers: dict = field(default_factory=dict)


def _dimension(spark: SparkSession, root: str, table: str, clean: DataFrame, key: str,
               name: str, id_col: str) -> DataFrame:
    """K-2 / K-4: the published dimension plus the members first seen in ``clean``."""
    names = W.first_name_per_key(clean, key, name, "shipment_date", name)
    if W.current_version(spark, root, table) is None:
        old = spark.createDataFrame([], names.withColumn(id_col, F.lit(0).cast("long")).schema)
    else:
        old = W.read_current(spark, root, table)
    ids = W.extend_dimension(old, names, [key], id_col)
    members = W.insert_absent(old.select(key, name), names, [key])
    return measured(ids.join(members, key).select(key, name, id_col), table)


STAGE_SCHEMA = "stage string, status string, detail string, seconds double"


def run_pipeline(spark: SparkSession, cfg: PipelineConfig,
                 out_state: dict | None = None) -> DataFrame:
    """O-1: run drivers -> clean -> validate (gate) -> load; return the stage report.

    ``out_state`` (optional) receives the run's state: clean counters,
    loaded row count and the failed step, if any."""
    report: list[tuple] = []
    state: dict = out_state if out_state is not None else {}
    run_id = uuid.uuid4().hex
    started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)

    def stage(name, fn, skip=False):
        if report and report[-1][1] == "FAILED":
            return False
        if skip:
            report.append((name, "SKIPPED", "", 0.0))
            return True
        t0 = time.time()
        try:
            detail = fn() or ""
            report.append((name, "SUCCESS", str(detail), time.time() - t0))
            return True
        except Exception as exc:  # noqa: BLE001 -- recorded, then the run halts
            report.append((name, "FAILED", f"{type(exc).__name__}: {exc}"[:500],
                           time.time() - t0))
            state["error"] = (name, str(exc))
            return False

    def do_drivers():
        for name, (frame, required, positive) in cfg.drivers.items():
            D.validate_annual(frame, required, positive)
            if not cfg.dry_run:
                W.write_version(frame, cfg.warehouse_dir, f"driver_{name}")
        return f"{len(cfg.drivers)} series"

    def do_clean():
        flat = cfg.flat if cfg.flat is not None else R.load_latest(spark, cfg.raw_dir)[0]
        ov = C.overrides_frame(spark, cfg.params.overrides)
        tagged = C.tag_records(flat, cfg.iso_table, ov, cfg.params)
        clean = measured(C.clean_from_tagged(tagged, cfg.params, cfg.order_cols), "clean")
        counters = C.clean_report(tagged, clean).first().asDict()
        state.update(clean=clean, counters=counters)
        if not counters["rows_out"]:
            raise ValueError(f"no clean rows: {counters}")
        return counters

    def do_validate():
        res = Q.run_suite(state["clean"], cfg.suite)
        if not cfg.dry_run:
            res = Q.write_report(res, f"{cfg.warehouse_dir}/validation_report/run={run_id}")
        return Q.gate(res)

    def do_load():
        clean, root = state["clean"], cfg.warehouse_dir
        dims = {"dim_country": _dimension(spark, root, "dim_country", clean, "dest_iso_alpha3",
                                          "dest_country_name", "country_id"),
                "dim_product": _dimension(spark, root, "dim_product", clean, "hs_code",
                                          "hs_desc", "product_id"),
                "dim_time": measured(W.calendar_dimension(clean.agg(
                    F.min("shipment_date").alias("lo"), F.max("shipment_date").alias("hi"))), "dim_time")}
        fact, check = W.resolve_foreign_keys(clean, [
            (dims["dim_country"], "dest_iso_alpha3", "country_id"),
            (dims["dim_product"], "hs_code", "product_id"),
            (dims["dim_time"].withColumnRenamed("date", "shipment_date"), "shipment_date", "time_id")])
        W.assert_resolved(check)
        if cfg.dry_run:
            state["loaded"] = 0
            return "dry run: nothing written"
        for table, dim in dims.items():
            W.write_version(dim, root, table)
        v = W.write_version(fact, root, "fact_shipment", partition_by=["year"])
        state["loaded"] = state["counters"]["rows_out"]
        return f"published version {v}"

    if cfg.drivers:
        stage("drivers", do_drivers)
    stage("clean", do_clean)
    stage("validate", do_validate)
    stage("load", do_load, skip=cfg.skip_load)

    status = ("FAILED" if "error" in state else ("DRY_RUN" if cfg.dry_run else "SUCCESS"))
    if not cfg.dry_run:
        W.append_audit(spark, cfg.warehouse_dir, {
            "run_id": run_id, "started_at": started,
            "finished_at": _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None),
            "status": status,
            "rows_ingested": (state.get("counters") or {}).get("rows_in"),
            "rows_loaded": state.get("loaded"),
            "failed_step": state.get("error", (None, None))[0],
            "error_message": state.get("error", (None, None))[1],
        })
    out = spark.createDataFrame(report, STAGE_SCHEMA)
    return out.withColumn("run_status", F.lit(status))
