"""Model-mode run over two batches and a rerun."""

import datetime as dt

from pyspark.sql import functions as F

from vaultkit.plans.model_run import ModelInputs, run_models
from vaultkit.plans.store import scratch_store
from vaultkit.sources import schemas as SC
from vaultkit.sources import testbed as tb
from vaultkit.spec import PRODUCT, LoadContext


def _inputs(tables, products):
    return ModelInputs(
        products={"STG_CUSTOMER": products},
        identifiers={"STG_IDENT": tb.identifiers(tables)},
        relationships={"STG_REL": tb.relationships(tables)},
        countries=tb.countries(tables),
        satellite_sources={"sat_product": (PRODUCT, "STG_CUSTOMER")},
        snapshot_models=("STG_CUSTOMER",),
    )


def test_model_run_two_batches(spark, tables):
    store = scratch_store(spark, "models")
    ctx1 = LoadContext(batch_id=tb.DAY1_BATCH, run_ts=dt.datetime(2025, 1, 1), record_source="CRM")
    ctx2 = LoadContext(batch_id=tb.DAY2_BATCH, run_ts=dt.datetime(2025, 1, 2), record_source="CRM")
    day1 = tb.stage(tb.day1_rows(tables), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS)
    r1 = run_models(store, _inputs(tables, day1), ctx1)
    assert r1["REJECT"] == 0                             # day 1 rows are clean
    assert store.read("sat_product_hist", SC.history(PRODUCT)).count() == 0   # first run: empty history
    r2 = run_models(store, _inputs(tables, tb.staging_day2(tables)), ctx2)
    assert r2["REJECT"] == tb.rejects_day2(tables).count()
    hub = store.read("hub", SC.HUB)
    assert hub.count() == hub.select("hashkey").distinct().count()
    sat = store.read("sat_product", SC.satellite(PRODUCT))
    assert sat.count() == sat.select("hashkey").distinct().count()
    hist = store.read("sat_product_hist", SC.history(PRODUCT))
    assert hist.count() == r2["SAT_PRODUCT_HIST"] > 0
    snaps = store.read("snapshot_stg_customer")
    assert {r[0] for r in snaps.select("etl_batch_id").distinct().collect()} == {tb.DAY1_BATCH, tb.DAY2_BATCH}
    n_snap = snaps.count()
    control = store.read("batch_control", SC.BATCH_CONTROL).where(F.col("etl_batch_id") == tb.DAY2_BATCH).first()
    assert control["process_status"] == "SUCCESS" and control["total_rejected_records"] == r2["REJECT"]
    log = store.read("process_log", SC.PROCESS_LOG).where(F.col("etl_batch_id") == tb.DAY2_BATCH)
    assert log.where("process_status = 'RUNNING'").count() == 0
    # a version is either active or archived, never both (rejected ids archive nothing)
    both = hist.select("hashkey", "hashdiff").join(sat.select("hashkey", "hashdiff"), ["hashkey", "hashdiff"], "left_semi")
    assert both.count() == 0
    assert log.where("model_name in ('STG_CUSTOMER', 'REJECT', 'SAT_PRODUCT')").count() == 3
    assert log.where("end_timestamp < start_timestamp").count() == 0
    before = [f for f in store.files("snapshot_stg_customer") if tb.DAY1_BATCH in f]
    # rerun of batch 2: rejects and hub unchanged, the batch's snapshot folder replaced, not duplicated
    r3 = run_models(store, _inputs(tables, tb.staging_day2(tables)), ctx2)
    assert r3["REJECT"] == r2["REJECT"] and r3["HUB"] == 0
    assert store.read("snapshot_stg_customer").count() == n_snap
    assert before == [f for f in store.files("snapshot_stg_customer") if tb.DAY1_BATCH in f] != []     # batch 1 keeps its files


def test_audit_of_many_models_is_one_merge(spark, monkeypatch):
    """200 models are planned about as fast as 2, by one MERGE; a rerun keeps first start times."""
    import time
    from vaultkit.operators import audit as A
    calls = []
    monkeypatch.setattr(A, "merge", lambda *a, merge=A.merge, **k: calls.append(1) or merge(*a, **k))
    ctx = LoadContext(batch_id="A1", run_ts=dt.datetime(2025, 1, 1), record_source="CRM")
    took = {}
    for n in (2, 2, 200):
        calls.clear()
        log = spark.createDataFrame([], SC.PROCESS_LOG)
        t = time.perf_counter()
        log = A.process_start_all(log, ctx, [("STAGE", f"STG_{k}") for k in range(n)], "CRM")
        log._jdf.queryExecution().executedPlan()
        took[n] = time.perf_counter() - t
        assert len(calls) == 1
    assert took[200] < 5 * took[2] + 0.5, took
    first = dt.datetime(2024, 12, 31)
    log = A.process_start_all(log, ctx, [("STAGE", "STG_7"), ("DM", "DM_NEW")], "CRM", first)
    rows = {r["model_name"]: r for r in log.collect()}
    assert len(rows) == 201 and rows["STG_7"]["start_timestamp"] == ctx.run_ts and rows["DM_NEW"]["start_timestamp"] == first


def test_run_of_thirty_models(spark, tables):
    day1 = tb.stage(tb.day1_rows(tables), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS)
    few = day1.limit(20)
    inputs = ModelInputs(
        products={f"STG_P{k}": few for k in range(12)}, identifiers={f"STG_I{k}": tb.identifiers(tables).limit(5) for k in range(5)},
        relationships={f"STG_R{k}": tb.relationships(tables).limit(5) for k in range(5)}, countries=tb.countries(tables),
        satellite_sources={"sat_product": (PRODUCT, "STG_P0")}, snapshot_models=("STG_P0", "STG_P1", "STG_P2"))
    store = scratch_store(spark, "thirty")
    ran = run_models(store, inputs, LoadContext(batch_id=tb.DAY1_BATCH, run_ts=dt.datetime(2025, 1, 1), record_source="CRM"))
    assert len(ran) == 30
    assert store.read("process_log", SC.PROCESS_LOG).where("process_status = 'SUCCESS'").count() == 30


def test_failed_run_is_logged(spark, tables):
    import pytest
    store = scratch_store(spark, "models-failing")
    ctx = LoadContext(batch_id="X1", run_ts=dt.datetime(2025, 1, 1), record_source="CRM")
    bad = tb.staging_day2(tables).withColumn("product_name", F.raise_error(F.lit("no such source")).cast("string"))
    with pytest.raises(Exception, match="no such source"):
        run_models(store, _inputs(tables, bad), ctx)
    control = store.read("batch_control", SC.BATCH_CONTROL).first()
    assert control["process_status"] == "FAILED" and "no such source" in control["error_message"]
    log = {r["model_name"]: r for r in store.read("process_log", SC.PROCESS_LOG).collect()}
    assert log["STG_CUSTOMER"]["process_status"] == "ERROR" and "no such source" in log["STG_CUSTOMER"]["error_message"]
    assert log["HUB"]["process_status"] == "SKIPPED" and not any(r["process_status"] == "RUNNING" for r in log.values())
