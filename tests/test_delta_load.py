"""End-to-end loads over the store: first load, delta load, rerun, invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vaultkit.plans.load import run_delta_load
from vaultkit.plans.store import scratch_store, versioned
from vaultkit.sources import testbed as tb
from vaultkit.sources import schemas as SC
from vaultkit.spec import PRODUCT, LoadContext


def _ctx(batch, day, use_watermark=False):
    return LoadContext(batch_id=batch, run_ts=dt.datetime(2025, 1, day), record_source="CRM",
                       source_object=tb.STAGING_MODEL, use_watermark=use_watermark)


@pytest.fixture(scope="module")
def loaded(spark, tables):
    store = scratch_store(spark, "test")
    day1 = tb.stage(tb.day1_rows(tables), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS)
    m1 = run_delta_load(store, day1, PRODUCT, _ctx("B1", 1))
    m2 = run_delta_load(store, tb.staging_day2(tables), PRODUCT, _ctx("B2", 2))
    sat2 = store.read("sat_product", SC.satellite(PRODUCT)).cache()
    hub2 = store.read("hub", SC.HUB).cache()
    hist2 = store.read("sat_product_hist", SC.history(PRODUCT)).cache()
    sat2.count(), hub2.count(), hist2.count()
    m3 = run_delta_load(store, tb.staging_day2(tables), PRODUCT, _ctx("B3", 3))
    return dict(store=store, m1=m1, m2=m2, m3=m3, sat2=sat2, hub2=hub2, hist2=hist2)


def test_first_load_inserts_everything(loaded, tables):
    n = tb.day1_rows(tables).count()
    assert loaded["m1"]["delta_inserted_rows"] == n
    assert loaded["m1"]["delta_updated_rows"] == 0


def test_delta_load_counts(loaded, tables):
    # day 2 without rejects stored: NEW keys are inserted, CHANGED keys updated
    m2 = loaded["m2"]
    assert m2["delta_updated_rows"] > 0 and m2["delta_inserted_rows"] > 0
    assert m2["rows_processed"] == m2["delta_inserted_rows"] + m2["delta_updated_rows"]


def test_rerun_is_unchanged(loaded):
    m3 = loaded["m3"]
    assert m3["delta_inserted_rows"] == 0 and m3["delta_updated_rows"] == 0
    store = loaded["store"]
    sat3 = store.read("sat_product", SC.satellite(PRODUCT))
    cols = [c for c in sat3.columns if c != "updated_datetime"]
    assert sat3.select(cols).exceptAll(loaded["sat2"].select(cols)).count() == 0
    assert store.read("hub", SC.HUB).count() == loaded["hub2"].count()
    assert store.read("sat_product_hist", SC.history(PRODUCT)).count() == loaded["hist2"].count()


def test_rerun_writes_no_attribute_row_but_notes_what_it_saw(loaded):
    from vaultkit.plans.load import read_satellite
    store = loaded["store"]
    rows = lambda t: {f.split("/")[-1][5:41] for f in store.files(t)}  # noqa: E731  # files of one write share an id
    assert store.rows("sat_product").where(F.col("etl_batch_id") == "B3").count() == 0 and len(rows("sat_product_seen")) >= 2
    sat = read_satellite(store, "sat_product", PRODUCT)
    assert sat.count() == loaded["sat2"].count()
    seen = sat.where(F.col("updated_datetime") == F.lit("2025-01-03 00:00:00").cast("timestamp_ntz")).count()
    assert seen == store.read("sat_product_seen").where(F.col("updated_datetime") >= F.lit("2025-01-03").cast("timestamp_ntz")).count() > 0


def test_compact_satellite_keeps_rows(spark, tables):
    from vaultkit.plans.load import compact_satellite, read_satellite
    store = scratch_store(spark, "compact-sat")
    day1 = tb.stage(tb.day1_rows(tables), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS)
    run_delta_load(store, day1, PRODUCT, _ctx("B1", 1))
    run_delta_load(store, tb.staging_day2(tables), PRODUCT, _ctx("B2", 2))
    before = read_satellite(store, "sat_product", PRODUCT)
    rows = before.collect()
    compact_satellite(store, "sat_product", PRODUCT, buckets=4)
    after = read_satellite(store, "sat_product", PRODUCT)
    assert len(store.files("sat_product")) == 4 and store.buckets("sat_product") == 4 and store.buckets("sat_product_seen") == 4
    assert sorted(map(str, after.collect())) == sorted(map(str, rows))
    m = run_delta_load(store, tb.staging_day2(tables), PRODUCT, _ctx("B3", 3))
    assert m["rows_processed"] == 0


def test_satellite_side_has_no_exchange_with_more_shuffle_partitions_than_buckets(spark, tables):
    import os
    from vaultkit.operators import delta as D
    store = scratch_store(spark, "buckets")
    day1 = tb.stage(tb.day1_rows(tables), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS)
    run_delta_load(store, day1, PRODUCT, _ctx("B1", 1), satellite_buckets=4)
    assert len(store.files("sat_product")) == 4
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(keep, ("-1", "16", "false")):
            spark.conf.set(k, v)
        base = store.rows("sat_product", versioned(SC.satellite(PRODUCT)))
        plan = D.mark(tb.staging_day2(tables), base, 4)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    lines = plan.split("\n")
    at = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
    depth = lambda x: max(x.find("+-"), x.find(":-"))
    above, d = [], depth(lines[at])
    for x in reversed(lines[:at]):              # ancestors of the scan, up to the join
        if depth(x) < d:
            above.append(x)
            d = depth(x)
        if "Join" in x and x in above:
            break
    assert "Join" in above[-1] and not any("Exchange" in x for x in above), above


def test_failed_load_is_logged(spark, tables):
    store = scratch_store(spark, "failing")
    bad = tb.staging_day2(tables).withColumn("product_name", F.raise_error(F.lit("no such source")).cast("string"))
    with pytest.raises(Exception, match="no such source"):
        run_delta_load(store, bad, PRODUCT, _ctx("F1", 1))
    row = store.read("process_log", SC.PROCESS_LOG).first()
    assert row["process_status"] == "FAILED" and "no such source" in row["error_message"] and row["end_timestamp"] is not None
    assert store.read("sat_product", SC.satellite(PRODUCT)) is None
    day1 = tb.stage(tb.day1_rows(tables), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS)
    run_delta_load(store, day1, PRODUCT, _ctx("F1", 1))
    row = store.read("process_log", SC.PROCESS_LOG).first()
    assert row["process_status"] == "SUCCESS" and row["error_message"] == ""


def test_runtime_of_a_real_load(loaded):
    from vaultkit.operators.audit import load_efficiency
    log = loaded["store"].read("process_log", SC.PROCESS_LOG)
    assert log.where("end_timestamp <= start_timestamp").count() == 0
    assert load_efficiency(log).where("runtime_seconds > 0").count() > 0


def test_hub_keys_unique(loaded):
    hub = loaded["store"].read("hub", SC.HUB)
    assert hub.count() == hub.select("hashkey").distinct().count()


def test_one_active_row_per_key(loaded):
    sat = loaded["store"].read("sat_product", SC.satellite(PRODUCT))
    active = sat.where(F.col("end_datetime").isNull())
    assert active.count() == active.select("hashkey").distinct().count()


def test_history_holds_changed_versions(loaded):
    hist = loaded["hist2"]
    assert hist.count() == loaded["m2"]["delta_updated_rows"]
    assert hist.where(F.col("end_datetime").isNull()).count() == 0


def test_process_log_success(loaded):
    log = loaded["store"].read("process_log", SC.PROCESS_LOG)
    rows = log.where("model_name = 'SAT_PRODUCT'").collect()
    assert {r["etl_batch_id"] for r in rows} == {"B1", "B2", "B3"}
    assert all(r["process_status"] == "SUCCESS" for r in rows)


def test_watermark_never_falls(spark, tables):
    store = scratch_store(spark, "wm")
    day1 = tb.stage(tb.day1_rows(tables), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS)
    run_delta_load(store, day1, PRODUCT, _ctx("W1", 1, use_watermark=True))
    w1 = store.read("source_watermark", SC.WATERMARK).first()["watermark_value"]
    older = day1.withColumn("source_lastmodifieddate", F.col("source_lastmodifieddate") - F.expr("INTERVAL 400 DAYS"))
    m = run_delta_load(store, older, PRODUCT, _ctx("W2", 2, use_watermark=True))
    w2 = store.read("source_watermark", SC.WATERMARK).first()["watermark_value"]
    assert w2 == w1
    assert m["delta_inserted_rows"] == 0


def test_bucketed_satellite_same_result_and_no_satellite_shuffle(spark, tables):
    from vaultkit.operators import delta as D
    store = scratch_store(spark, "bucketed")
    day1 = tb.stage(tb.day1_rows(tables), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS)
    run_delta_load(store, day1, PRODUCT, _ctx("B1", 1), satellite_buckets=4)
    sat = store.read("sat_product", SC.satellite(PRODUCT))
    plan = D.classify(tb.staging_day2(tables), sat)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    m = run_delta_load(store, tb.staging_day2(tables), PRODUCT, _ctx("B2", 2), satellite_buckets=4)
    assert not [x.name for x in spark.catalog.listTables() if x.name.startswith("marked_")]
    plain = scratch_store(spark, "plain")
    run_delta_load(plain, day1, PRODUCT, _ctx("B1", 1))
    m2 = run_delta_load(plain, tb.staging_day2(tables), PRODUCT, _ctx("B2", 2))
    assert m == m2
    a = store.read("sat_product", SC.satellite(PRODUCT))
    b = plain.read("sat_product", SC.satellite(PRODUCT))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_identifier_and_relationship_loads(spark, tables):
    from vaultkit.spec import IDENTIFIER, RELATIONSHIP
    store = scratch_store(spark, "entities")
    ident = tb.identifiers(tables)
    m = run_delta_load(store, ident, IDENTIFIER, _ctx("E1", 1))
    assert m["delta_inserted_rows"] == ident.select("hashkey").distinct().count()
    rel = tb.relationships(tables)
    m = run_delta_load(store, rel, RELATIONSHIP, _ctx("E1", 1))
    assert m["delta_inserted_rows"] == rel.select("hashkey").distinct().count()
    sat = store.read("sat_relationship", SC.satellite(RELATIONSHIP))
    assert set(RELATIONSHIP.columns) <= set(sat.columns)
    hub = store.read("hub", SC.HUB)
    assert {r["origin_stg"] for r in hub.select("origin_stg").distinct().collect()} == {"IDENTIFIER", "RELATIONSHIP"}
    m = run_delta_load(store, rel, RELATIONSHIP, _ctx("E2", 2))
    assert m["delta_inserted_rows"] == 0 and m["delta_updated_rows"] == 0


def test_optional_parent_id(spark, tables):
    from vaultkit.operators.delta import dq_passed
    from vaultkit.spec import RELATIONSHIP
    rel = tb.relationships(tables).withColumn("parent_dataset_product_id", F.lit(None).cast("string"))
    strict = dq_passed(rel, None, None, RELATIONSHIP, _ctx("O1", 1))
    loose = dq_passed(rel, None, None, RELATIONSHIP.optional("parent_dataset_product_id"), _ctx("O1", 1))
    assert strict.count() == 0 and loose.count() > 0


def test_rejects_limited_to_batch(spark, tables):
    from vaultkit.operators.quality import exclude_rejects
    stg = tb.staging_day2(tables)
    rej = tb.rejects_day2(tables)
    assert exclude_rejects(stg, rej, batch_id="OTHER").count() == stg.count()
    assert exclude_rejects(stg, rej, batch_id=tb.DAY2_BATCH).count() < stg.count()


def test_legacy_hash_names_and_live_columns(spark, tables):
    from vaultkit.plans.load import delta_load
    day1 = tb.stage(tb.day1_rows(tables), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS)
    sat = tb.satellite_day1(tables).withColumn("legacy_note", F.lit("x"))
    legacy = sat.withColumnsRenamed({"hashkey": "IDENTIFIER_MD5", "hashdiff": "RECORD_MD5"})
    res = delta_load(tb.staging_day2(tables), None, legacy, None, None, None, PRODUCT, _ctx("L2", 2))
    hist = res.history_new
    assert "legacy_note" in hist.columns and hist.columns[-1] == "end_datetime"
    assert hist.count() == res.metrics.first()["delta_updated_rows"] > 0


def test_compact_hub_keeps_rows_and_buckets(spark, tables):
    store = scratch_store(spark, "compact")
    day1 = tb.stage(tb.day1_rows(tables), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS)
    run_delta_load(store, day1, PRODUCT, _ctx("C1", 1))
    run_delta_load(store, tb.staging_day2(tables), PRODUCT, _ctx("C2", 2))
    before = store.read("hub", SC.HUB).collect()
    store.rewrite("hub", store.read("hub", SC.HUB), 4)
    after = store.read("hub", SC.HUB)
    assert len(store.files("hub")) == 4 and sorted(map(str, after.collect())) == sorted(map(str, before))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force the shuffle join to see the bucketed side
    try:
        plan = after.join(tb.staging_day2(tables).select("hashkey"), "hashkey", "left_semi")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Bucketed: true" in plan
    m = run_delta_load(store, tb.staging_day2(tables), PRODUCT, _ctx("C3", 3))
    assert m["delta_inserted_rows"] == 0


@pytest.fixture
def shuffled(spark):
    """Joins as between large tables: nothing is broadcast, plans are final."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(keep, ("-1", "false")):
        spark.conf.set(k, v)
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def test_outputs_of_a_bucketed_load_move_neither_hub_nor_satellite_nor_marked_set(spark, tables, shuffled):
    from vaultkit.plans.load import delta_load
    store = scratch_store(spark, "layout")
    day1 = tb.stage(tb.day1_rows(tables), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS)
    run_delta_load(store, day1, PRODUCT, _ctx("B1", 1), satellite_buckets=4)
    res = delta_load(tb.staging_day2(tables), store.read("hub", SC.HUB), store.rows("sat_product", versioned(SC.satellite(PRODUCT))),
                     None, None, None, PRODUCT, _ctx("B2", 2), 4)
    for out in (res.hub_new, res.satellite_new, res.seen, res.history_new):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and ("Join" not in plan or "Bucketed: true" in plan), plan


@pytest.mark.parametrize("adaptive", ["false", "true"])
@pytest.mark.parametrize("first", [True, False])
def test_staging_is_dealt_once_with_as_many_shuffle_partitions_as_buckets(spark, tables, shuffled, adaptive, first):
    """The exchange of the top-1 per key, behind its partial limit, is the one into the buckets."""
    from vaultkit.operators import delta as D
    store = scratch_store(spark, "once")
    day1 = tb.stage(tb.day1_rows(tables), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS)
    run_delta_load(store, day1, PRODUCT, _ctx("B1", 1), satellite_buckets=4)
    rows = tb.staging_day2(tables)
    staging = spark.createDataFrame(rows.collect(), rows.schema)
    satellite = None if first else store.rows("sat_product", versioned(SC.satellite(PRODUCT)))
    exchanges, found, old = {}, {}, spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        for n in (4, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            marked = D.mark(D.dq_passed(staging, None, None, PRODUCT, _ctx("B2", 2)), satellite, 4)
            found[n] = sorted(map(str, marked.collect()))
            plan = marked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            exchanges[n] = plan.count("Exchange hashpartitioning")
            assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert exchanges == {4: 1, 16: 2} and found[4] == found[16]


def test_history_is_read_by_the_prefixes_at_hand(spark, tables):
    """Dynamic pruning on the history's partitions, with the rows that a plain anti join gives."""
    from vaultkit.operators import delta as D
    from vaultkit.plans.load import stored_history
    store = scratch_store(spark, "prefixes")
    hist = tb.satellite_day1(tables).withColumn("end_datetime", F.lit("2024-01-01").cast("timestamp_ntz"))
    store.append("h", D.with_prefix(hist, 2), partition_by=(D.PREFIX,))
    old = store.rows("h", stored_history(PRODUCT))
    few = tb.satellite_day1(tables).where("hashkey < '20'").withColumn(D.ACTION, F.when(F.col("hashkey") < "10", D.CHANGED).otherwise(D.NEW))
    new = few.withColumn("hashdiff", F.concat(F.col("hashdiff"), F.lit("x")))
    rows = few.unionByName(new).where(F.col(D.ACTION) == D.CHANGED).drop(D.ACTION)
    got = D.archived(rows, old, _ctx("P1", 1), digits=2)
    want = D.archived(rows, hist, _ctx("P1", 1))
    assert got.count() == want.count() == rows.count() / 2 > 0 and got.exceptAll(want.select(*got.columns)).count() == 0
    assert "dynamicpruning" in D.archived_already(old, rows, ("hashdiff",), 2)._jdf.queryExecution().executedPlan().toString()


def test_metrics_come_from_the_writes(spark, tables):
    """What the writes observe equals the warehouse's counts, and no job of the load only counts."""
    from vaultkit.plans.load import delta_load
    store = scratch_store(spark, "observed")
    day1 = tb.stage(tb.day1_rows(tables), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS)
    run_delta_load(store, day1, PRODUCT, _ctx("B1", 1))
    res = delta_load(tb.staging_day2(tables), store.read("hub", SC.HUB), store.rows("sat_product", versioned(SC.satellite(PRODUCT))),
                     None, None, None, PRODUCT, _ctx("B2", 2))
    want = res.metrics.first().asDict()
    counted = {r["action"]: r["count"] for r in res.marked.groupBy("action").count().collect()}
    assert res.actions == {a: counted.get(a, 0) for a in ("NEW", "CHANGED", "UNCHANGED")}
    m = run_delta_load(store, tb.staging_day2(tables), PRODUCT, _ctx("B2", 2))
    assert m == want


def test_a_load_that_broke_off_is_completed_by_running_it_again(spark, tables, monkeypatch):
    store = scratch_store(spark, "half")
    day1 = tb.stage(tb.day1_rows(tables), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS)
    run_delta_load(store, day1, PRODUCT, _ctx("B1", 1))
    whole = scratch_store(spark, "whole")
    run_delta_load(whole, day1, PRODUCT, _ctx("B1", 1))
    run_delta_load(whole, tb.staging_day2(tables), PRODUCT, _ctx("B2", 2))
    with monkeypatch.context() as m:
        m.setattr(type(store), "add_versions", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            run_delta_load(store, tb.staging_day2(tables), PRODUCT, _ctx("B2", 2))
    run_delta_load(store, tb.staging_day2(tables), PRODUCT, _ctx("B2", 2))
    for table, schema in (("hub", SC.HUB), ("sat_product", SC.satellite(PRODUCT)), ("sat_product_hist", SC.history(PRODUCT))):
        assert sorted(map(str, store.read(table, schema).collect())) == sorted(map(str, whole.read(table, schema).collect())), table


def test_tables_of_other_names(spark, tables):
    from vaultkit.plans.load import compact_satellite, read_satellite
    names = {"hub": "keys", "sat": "product_facts", "hist": "product_past"}
    a, b = scratch_store(spark, "names"), scratch_store(spark, "usual")
    day1 = tb.stage(tb.day1_rows(tables), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS)
    for store, more in ((a, {"names": names}), (b, {})):
        run_delta_load(store, day1, PRODUCT, _ctx("B1", 1), **more)
        run_delta_load(store, tb.staging_day2(tables), PRODUCT, _ctx("B2", 2), **more)
    want = sorted(map(str, read_satellite(b, "sat_product", PRODUCT).collect()))
    assert sorted(map(str, read_satellite(a, "product_facts", PRODUCT).collect())) == want
    assert a.read("keys", SC.HUB).count() == b.read("hub", SC.HUB).count()
    compact_satellite(a, "product_facts", PRODUCT)
    assert sorted(map(str, read_satellite(a, "product_facts", PRODUCT).collect())) == want
