"""Registered queries: one per operator family, each reading the driver's tables in ``sf_dir``.

Every callable takes (spark, sf_dir) and returns a DataFrame whose columns match the oracle SQL of
the same name in ``vaultkit.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultkit.operators import delta as D
from vaultkit.sources import testbed as tb
from vaultkit.sources.schemas import BATCH_CONTROL
from vaultkit.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn=None, *, name: str | None = None):
    """Register ``fn`` under its own name (or ``name``)."""
    def register(f):
        QUERIES[name or f.__name__] = f
        return f
    return register(fn) if fn is not None else register


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


# --- step 0: minimum slice ---------------------------------------------------------------------

@query
def hash_entity(spark, sf_dir):
    t = _t(spark, sf_dir)
    return tb.staging_day2(t).select("dataset_product_id", "geographic_id", "product_name", "hashkey", "hashdiff")


@query
def delta_classified(spark, sf_dir):
    t = _t(spark, sf_dir)
    c = D.classify(tb.dq_day2(t), tb.satellite_day1(t))
    return c.select(
        "hashkey", "action",
        F.coalesce(F.col("stg.dataset_product_id"), F.col("sat.dataset_product_id")).alias("dataset_product_id"),
    )


# --- shared pieces -----------------------------------------------------------------------------

from vaultkit import functions as VF  # noqa: E402
from vaultkit.operators import audit as A  # noqa: E402
from vaultkit.operators import models as M  # noqa: E402
from vaultkit.operators.conform import append_synced, standard_hash_names  # noqa: E402
from vaultkit.operators.dedupe import latest_by, lookup_parent, sorted_distinct_list, union_all, union_distinct  # noqa: E402
from vaultkit.operators.labels import label_rows  # noqa: E402
from vaultkit.operators.quality import exclude_rejects, find_rejects, keep_known_countries, new_rejects  # noqa: E402
from vaultkit.session import materialize  # noqa: E402
from vaultkit.spec import IDENTIFIER, PRODUCT, RELATIONSHIP  # noqa: E402


def _classified(t):
    return D.classify(tb.dq_day2(t), tb.satellite_day1(t))


def _raw_text(t):
    """Part names dressed with leading dots, blank runs, a tab and an apostrophe (derived per row)."""
    p = t["part"]
    raw = F.concat(
        F.repeat(F.lit("."), (F.col("p_size") % 3).cast("int")), F.lit(" "), F.col("p_name"),
        F.repeat(F.lit(" "), (F.col("p_size") % 4).cast("int")), F.lit("\t "), F.col("p_brand"),
        F.when(F.col("p_size") % 5 == 0, F.lit("'s")).otherwise(F.lit("")),
    )
    return p.select("p_partkey", "p_brand", raw.alias("raw"))


# --- step 1: cleansing and hashing -------------------------------------------------------------

@query
def clean_names(spark, sf_dir):
    r = _raw_text(_t(spark, sf_dir))
    return r.select(
        "p_partkey",
        VF.clean_name("raw").alias("crm_name"),
        VF.market_name("raw").alias("market_name"),
        VF.market_name(VF.drop_last_chars("raw", 3)).alias("brand_name"),
        VF.last_token("raw").alias("last_token"),
        VF.market_name(VF.without_last_token("raw")).alias("name_stripped"),
    )


@query
def typed_null_conform(spark, sf_dir):
    return tb.sources(_t(spark, sf_dir))["STG_SUPPLIER"]


@query
def like_escape_filter(spark, sf_dir):
    p = _t(spark, sf_dir)["part"]
    ext = F.concat(F.upper(F.substring("p_type", 1, 1)),
                   F.when(F.col("p_size") % 2 == 0, F.lit("_")).otherwise(F.lit("X")),
                   F.col("p_partkey").cast("string"))
    nm = F.upper(F.trim("p_name"))
    maybe_brand = F.when(F.col("p_size") > 25, F.lit(None).cast("string")).otherwise(F.col("p_brand"))
    out = p.select(
        "p_partkey", "p_name", ext.alias("ext_id"),
        VF.like_escaped(ext, "S!_%", "!").alias("esc_match"),
        ext.like("S_%").alias("wild_match"),
        F.upper("p_type").isin("SMALL", "LARGE").alias("in_list"),
        (~maybe_brand.isin("Brand#1", "Brand#2")).alias("not_in_list"),
    )
    return out.where(VF.like_none(nm, ["%RING%", "BLUE %", "%BOLT"]))


@query
def placeholder_filter(spark, sf_dir):
    c = _t(spark, sf_dir)["customer"]
    k = F.col("c_custkey")
    seg = (F.when(k % 9 == 0, F.lit("-")).when(k % 9 == 1, F.lit("  ")).when(k % 9 == 2, F.lit(None).cast("string"))
           .otherwise(F.col("c_mktsegment")))
    return c.select("c_custkey", seg.alias("segment")).where(VF.not_placeholder("segment"))


@query
def try_dates(spark, sf_dir):
    o = _t(spark, sf_dir)["orders"]
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("date").cast("string")
    txt = (F.when(k % 5 == 0, F.concat(F.year("o_orderdate").cast("string"), F.lit("-13-01")))
           .when(k % 5 == 1, F.lit(""))
           .when(k % 5 == 2, F.concat(F.lit(" "), d, F.lit(" ")))
           .otherwise(d))
    return o.select("o_orderkey", txt.alias("txt")).withColumn("d", VF.try_date("txt"))


@query
def hashdiff_entity(spark, sf_dir):
    return tb.identifiers(_t(spark, sf_dir))


# --- step 2: dedupe, lookups, unions, labels ---------------------------------------------------

@query
def latest_per_key(spark, sf_dir):
    e = _t(spark, sf_dir)["events"]
    return latest_by(e, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "ts", "event_type", "value")


@query
def dedupe_versions(spark, sf_dir):
    o = _t(spark, sf_dir)["orders"]
    h = o.withColumns({"hashkey": VF.hash_of(["o_custkey"]), "hashdiff": VF.hash_of(["o_custkey", "o_orderstatus"])})
    return latest_by(h, ["hashkey", "hashdiff"], ["o_orderdate", "o_orderkey"]).select(
        "hashkey", "hashdiff", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


@query
def parent_lookup(spark, sf_dir):
    c = _t(spark, sf_dir)["customer"]
    child = c.select("c_custkey", (F.col("c_custkey") % 100).alias("parent_ref"))
    return lookup_parent(child, c.select("c_custkey", "c_name"), "parent_ref", "c_custkey", ["c_name"])


@query
def latest_parent_lookup(spark, sf_dir):
    t = _t(spark, sf_dir)
    child = t["customer"].select("c_custkey")
    orders = t["orders"].select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return lookup_parent(child, orders, "c_custkey", "o_custkey", ["o_orderkey", "o_orderstatus"],
                         latest_order=["o_orderdate", "o_orderkey"])


@query
def multi_key_lookup(spark, sf_dir):
    t = _t(spark, sf_dir)
    c, n = t["customer"], t["nation"]
    cur = n.where(F.col("n_regionkey") != 4)
    cond = (c["c_nationkey"] == cur["n_nationkey"]) & (
        F.upper(F.trim(cur["n_name"])) == F.upper(F.trim(F.concat(F.lit("nation_"), c["c_nationkey"].cast("string")))))
    return c.join(cur, cond, "left").select("c_custkey", "n_name")


@query
def substance_list(spark, sf_dir):
    li = _t(spark, sf_dir)["lineitem"]
    return sorted_distinct_list(li, ["l_partkey"], F.col("l_suppkey").cast("string"), "|", "substance")


@query(name="union_distinct")
def union_distinct_ids(spark, sf_dir):
    t = _t(spark, sf_dir)
    return union_distinct([
        t["orders"].select(F.col("o_custkey").alias("id")),
        t["customer"].select(F.col("c_custkey").alias("id")),
        t["supplier"].select(F.col("s_suppkey").alias("id")),
    ])


@query
def union_sources(spark, sf_dir):
    return union_all(tb.sources(_t(spark, sf_dir)).values())


@query
def multi_label(spark, sf_dir):
    p = _t(spark, sf_dir)["part"].select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice", "p_brand")
    rules = [
        ("SMALL", F.upper("p_type") == "SMALL"),
        ("BIG", F.col("p_size") > 40),
        ("CHEAP", F.col("p_retailprice") < 1000),
        ("BRAND1X", F.col("p_brand").like("Brand#1%")),
    ]
    return label_rows(p, rules, "label").select("p_partkey", "p_name", "label")


# --- step 3: data quality ----------------------------------------------------------------------

@query
def country_semi(spark, sf_dir):
    t = _t(spark, sf_dir)
    cn = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return keep_known_countries(cn, tb.countries(t), "n_name")


@query
def reject_rows(spark, sf_dir):
    return tb.rejects_day2(_t(spark, sf_dir))


@query
def reject_key_new_only(spark, sf_dir):
    r = tb.rejects_day2(_t(spark, sf_dir))
    stored = r.where(F.col("error_code") == "EMPTY_COUNTRY_CODE")
    return new_rejects(r, stored)


@query(name="exclude_rejects")
def exclude_rejects_ids(spark, sf_dir):
    t = _t(spark, sf_dir)
    return exclude_rejects(tb.staging_day2(t), tb.rejects_day2(t)).select("dataset_product_id", "hashkey", "hashdiff")


@query
def exclude_rejects_both_ends(spark, sf_dir):
    t = _t(spark, sf_dir)
    rel = exclude_rejects(tb.relationships(t), tb.rejects_day2(t), RELATIONSHIP.reject_id_cols)
    return rel.select("parent_dataset_product_id", "child_dataset_product_id", "hashkey")


# --- step 4: delta core ------------------------------------------------------------------------

@query
def dq_passed(spark, sf_dir):
    t = _t(spark, sf_dir)
    dq = D.dq_passed(tb.staging_day2(t), tb.rejects_day2(t), tb.watermarks_day1(t), PRODUCT, tb.ctx())
    return dq.select("dataset_product_id", "hashkey", "hashdiff", "source_lastmodifieddate")


def _events_watermarks(t):
    e = t["events"].where(F.col("ts") < tb.ts("2024-01-15 00:00:00"))
    return e.agg(F.max("ts").alias("watermark_value")).select(
        F.lit("EVENTS").alias("source_system"), F.lit("EVENTS").alias("source_object"),
        F.lit("TS").alias("watermark_column"), "watermark_value",
        tb.ts(tb.DAY1_TS).alias("updated_at"), F.lit(tb.DAY1_BATCH).alias("etl_batch_id"))


@query
def watermark_filter(spark, sf_dir):
    t = _t(spark, sf_dir)
    c = tb.ctx(source_system="EVENTS", source_object="EVENTS", watermark_column="ts")
    return D.since_watermark(t["events"], _events_watermarks(t), c).select("event_id", "ts")


@query
def delta_rows(spark, sf_dir):
    return D.delta_rows(_classified(_t(spark, sf_dir))).select("dataset_product_id", "hashkey", "hashdiff")


@query
def delta_metrics(spark, sf_dir):
    t = _t(spark, sf_dir)
    return D.delta_metrics(_classified(t), tb.hub_day1(t))


@query
def hub_upsert(spark, sf_dir):
    t = _t(spark, sf_dir)
    return D.hub_upsert(tb.hub_day1(t), _classified(t), PRODUCT, tb.ctx())


@query
def sat_touch(spark, sf_dir):
    t = _t(spark, sf_dir)
    return D.touched(_classified(t), PRODUCT, tb.ctx()).select("hashkey", "hashdiff", "updated_datetime", "etl_batch_id")


@query
def archive_changed(spark, sf_dir):
    t = _t(spark, sf_dir)
    h = D.next_history(_classified(t), tb.history_day1(t), PRODUCT, tb.ctx())
    return h.select("hashkey", "hashdiff", "start_datetime", "end_datetime", "etl_batch_id", "product_name")


@query
def sat_merge(spark, sf_dir):
    t = _t(spark, sf_dir)
    return D.next_satellite(_classified(t), tb.satellite_day1(t), PRODUCT, tb.ctx())


@query
def watermark_upsert(spark, sf_dir):
    t = _t(spark, sf_dir)
    wm = tb.watermarks_day1(t).unionByName(_events_watermarks(t))
    dq = D.dq_passed(tb.staging_day2(t), tb.rejects_day2(t), wm, PRODUCT, tb.ctx())
    return D.advance_watermark(wm, dq, tb.ctx())


def _entity_delta(t, staging, satellite, spec):
    """Next satellite of an entity with the action of every key (of repeated keys, with each of their actions)."""
    # Landed, the rejected ids have a known size: where it is small, no staging row is shuffled to look them up.
    rejects = materialize(tb.rejects_day2(t).select("dataset_product_id").distinct(), "rejected-ids")
    c = D.classify(D.dq_passed(staging, rejects, None, spec, tb.ctx()), D.with_known(satellite))
    rows = D.next_satellite(c, None, spec, tb.ctx(), keep={D.ACTION: D.key_actions()})
    return rows.withColumn(D.ACTION, F.explode(D.ACTION))


@query
def identifier_delta(spark, sf_dir):
    t = _t(spark, sf_dir)
    return _entity_delta(t, tb.identifiers_day2(t), tb.identifier_satellite_day1(t), IDENTIFIER)


@query
def relationship_delta(spark, sf_dir):
    t = _t(spark, sf_dir)
    return _entity_delta(t, tb.relationships_day2(t), tb.relationship_satellite_day1(t), RELATIONSHIP)


@query
def relationship_delta_optional_parent(spark, sf_dir):
    t = _t(spark, sf_dir)
    return _entity_delta(t, tb.relationships_without_some_parents(t), tb.relationship_satellite_day1(t),
                         RELATIONSHIP.optional("parent_dataset_product_id"))


@query
def first_load(spark, sf_dir):
    """The load's own outputs with no satellite, hub or history yet: every DQ row is new."""
    t = _t(spark, sf_dir)
    marked = D.mark(tb.dq_day2(t), None)
    return D.stamped(marked, PRODUCT, tb.ctx())


@query
def legacy_hash_names(spark, sf_dir):
    sat = tb.satellite_day1(_t(spark, sf_dir)).withColumnsRenamed({"hashkey": "IDENTIFIER_MD5", "hashdiff": "RECORD_MD5"})
    return standard_hash_names(sat).select("hashkey", "hashdiff", "dataset_product_id")


@query
def reject_image(spark, sf_dir):
    """Rejects with the record kept as VARIANT; two fields are read back from it."""
    t = _t(spark, sf_dir)
    r = find_rejects({tb.STAGING_MODEL: tb.staging_day2(t)}, tb.countries(t), tb.ctx(), as_variant=True)
    field = lambda f: F.try_variant_get("rejected_record", f"$.{f}", "string")
    return r.select("reject_key", field("product_name").alias("product_name"), field("hashkey").alias("image_hashkey"))


# --- step 5: model-mode loads ------------------------------------------------------------------

@query
def hub_full(spark, sf_dir):
    t = _t(spark, sf_dir)
    return M.hub_full(tb.sources(t).values(), [tb.identifiers(t)], [tb.relationships(t)],
                      tb.rejects_day2(t), tb.hub_day1(t), tb.ctx())


@query
def sat_incremental(spark, sf_dir):
    t = _t(spark, sf_dir)
    return M.sat_incremental(tb.staging_day2(t), tb.satellite_day1(t), tb.rejects_day2(t), PRODUCT, tb.ctx())


@query
def hist_incremental(spark, sf_dir):
    t = _t(spark, sf_dir)
    return M.expire_versions(tb.satellite_day1(t), tb.staging_day2(t), tb.history_day1(t), PRODUCT, tb.ctx(), tb.rejects_day2(t))


def _snapshot_day1(t):
    s = tb.stage(tb.day1_rows(t), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS)
    return s.select(tb.ts(tb.DAY1_TS).alias("captured_at"), *s.columns, F.col("product_type_code").alias("legacy_type"))


@query
def snapshot_batch(spark, sf_dir):
    t = _t(spark, sf_dir)
    return M.snapshot(tb.staging_day2(t), tb.rejects_day2(t), _snapshot_day1(t), tb.ctx())


@query
def mart_current_batch(spark, sf_dir):
    t = _t(spark, sf_dir)
    sat = D.next_satellite(_classified(t), tb.satellite_day1(t), PRODUCT, tb.ctx())
    return M.mart(sat, PRODUCT, tb.DAY2_BATCH)


# --- step 6: audit -----------------------------------------------------------------------------

@query
def audit_std_names(spark, sf_dir):
    """Layer and model names of the audit standard, for names derived from every event row."""
    e = _t(spark, sf_dir)["events"]
    k, u = F.col("event_id"), F.col("user_id")
    layers = ["stg", "DQ", " delta ", "dm", "Hub", "sat", "hist", "raw"]
    raw_layer = F.lit(None).cast("string")
    for i, name in enumerate(layers):
        raw_layer = F.when(k % 8 == i, F.lit(name)).otherwise(raw_layer)
    suffixes = ["_VEEVA_CRM", "_VEEVA", "_PRODUCT_FILE", "_VEEVA_PRODUCT_FILE", ""]
    suffix = F.lit("")
    for i, s_ in enumerate(suffixes):
        suffix = F.when(u % 5 == i, F.lit(s_)).otherwise(suffix)
    base = F.when(k % 3 == 0, F.lower(F.concat(F.lit(" sat_"), F.col("event_type")))).otherwise(
        F.concat(F.lit("STG_"), F.upper("event_type")))
    raw_model = F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(F.concat(base, suffix))
    return e.select("event_id", VF.standard_layer(raw_layer).alias("layer_name"), VF.standard_model(raw_model).alias("model_name"))


def _log_day1(t):
    e = t["events"]
    return e.groupBy("event_type").agg(F.min("ts").alias("start_timestamp"), F.max("ts").alias("end_timestamp"),
                                       F.count(F.lit(1)).alias("n")).select(
        F.lit(tb.DAY1_BATCH).alias("etl_batch_id"), F.lit("STAGE").alias("layer_name"),
        F.upper("event_type").alias("model_name"), F.lit("EVENTS").alias("source_system"),
        F.lit("SUCCESS").alias("process_status"), "start_timestamp", "end_timestamp",
        F.col("n").cast("long").alias("rows_processed"), F.lit("").alias("error_message"),
        F.lit(0).cast("long").alias("delta_inserted_rows"), F.lit(0).cast("long").alias("delta_updated_rows"))


@query
def process_log_upsert(spark, sf_dir):
    t = _t(spark, sf_dir)
    log = _log_day1(t)
    day1 = tb.ctx(batch_id=tb.DAY1_BATCH)
    log = A.process_start(log, day1, "STAGE", "CLICK", "EVENTS")
    log = A.process_start(log, tb.ctx(), "DELTA", "SAT_PRODUCT", "CRM")
    metrics = D.delta_metrics(_classified(t), tb.hub_day1(t))
    return A.process_success(log, metrics, tb.ctx(), "SAT_PRODUCT")


@query
def batch_control(spark, sf_dir):
    t = _t(spark, sf_dir)
    e = t["events"]
    control = e.groupBy("event_type").agg(F.min("ts").alias("s"), F.max("ts").alias("e")).select(
        F.concat(F.lit("B_"), F.upper("event_type")).alias("etl_batch_id"), F.lit("EVENTS").alias("pipeline_name"),
        F.lit(0).cast("long").alias("total_rejected_records"), F.col("s").alias("start_timestamp"),
        F.col("e").alias("end_timestamp"), F.lit("SUCCESS").alias("process_status"), F.lit("").alias("error_message"))
    control = A.batch_start(control, tb.ctx(), " vault ")
    rejects = tb.rejects_day2(t).agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(
        F.lit(1).alias("seq"), F.lit("DQ").alias("layer_name"), F.lit("REJECT").alias("model_name"),
        F.lit("success").alias("status"), F.lit(None).cast("string").alias("message"), "row_count",
        F.lit(None).cast("long").alias("rows_affected"), F.lit(None).cast("long").alias("rows_inserted"),
        F.lit(None).cast("long").alias("rows_updated"), F.lit(None).cast("long").alias("rows_deleted"))
    m = D.delta_metrics(_classified(t), tb.hub_day1(t)).select(
        F.lit(2).alias("seq"), F.lit("SAT").alias("layer_name"), F.lit("SAT_PRODUCT").alias("model_name"),
        F.lit("success").alias("status"), F.lit(None).cast("string").alias("message"),
        F.lit(None).cast("long").alias("row_count"), F.lit(None).cast("long").alias("rows_affected"),
        F.col("delta_inserted_rows").alias("rows_inserted"), F.col("delta_updated_rows").alias("rows_updated"),
        F.lit(0).cast("long").alias("rows_deleted"))
    return A.batch_end(control, rejects.unionByName(m), tb.ctx())


def _failed_results(t):
    """Run results with a failed HUB model after REJECT and the staging model, whose name is not standard."""
    def row(seq, layer, model, status, message, rows):
        return rows.select(
            F.lit(seq).alias("seq"), F.lit(layer).alias("layer_name"), F.lit(model).alias("model_name"), F.lit(status).alias("status"),
            F.lit(message).cast("string").alias("message"), F.col("row_count"), F.lit(None).cast("long").alias("rows_affected"),
            F.lit(None).cast("long").alias("rows_inserted"), F.lit(None).cast("long").alias("rows_updated"),
            F.lit(None).cast("long").alias("rows_deleted"))

    count = lambda df: df.agg(F.count(F.lit(1)).cast("long").alias("row_count"))
    none = t.spark.range(1).select(F.lit(None).cast("long").alias("row_count"))
    return union_all([row(1, "stg", "stg_product_veeva", "success", None, count(tb.staging_day2(t))),
                      row(2, "dq", "reject", "success", None, count(tb.rejects_day2(t))),
                      row(3, "hub", "hub", "error", "Compilation error in HUB", none)])


@query
def batch_control_failed(spark, sf_dir):
    t = _t(spark, sf_dir)
    control = A.batch_start(spark.createDataFrame([], BATCH_CONTROL), tb.ctx(), "vault")
    return A.batch_end(control, _failed_results(t), tb.ctx())


@query
def process_end_failed(spark, sf_dir):
    t = _t(spark, sf_dir)
    return A.process_end(_log_day1(t), _failed_results(t), tb.ctx(), "CRM")


@query
def model_log(spark, sf_dir):
    """Model-level audit: a model run opens and closes its log row, then the run-end roll-up
    upserts one row per model result (row count for the DQ layer, affected rows otherwise)."""
    t = _t(spark, sf_dir)
    log = A.model_start(_log_day1(t), tb.ctx(), "STAGE", "STG_PRODUCT", "CRM")
    log = A.model_end(log, tb.ctx(), "STG_PRODUCT", A.SUCCESS)
    rejects = tb.rejects_day2(t).agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(
        F.lit(1).alias("seq"), F.lit("DQ").alias("layer_name"), F.lit("REJECT").alias("model_name"),
        F.lit("success").alias("status"), F.lit(None).cast("string").alias("message"), "row_count",
        F.lit(None).cast("long").alias("rows_affected"), F.lit(None).cast("long").alias("rows_inserted"),
        F.lit(None).cast("long").alias("rows_updated"), F.lit(None).cast("long").alias("rows_deleted"))
    m = D.delta_metrics(_classified(t), tb.hub_day1(t)).select(
        F.lit(2).alias("seq"), F.lit("SAT").alias("layer_name"), F.lit("SAT_PRODUCT").alias("model_name"),
        F.lit("success").alias("status"), F.lit(None).cast("string").alias("message"),
        F.lit(None).cast("long").alias("row_count"), F.lit(None).cast("long").alias("rows_affected"),
        F.col("delta_inserted_rows").alias("rows_inserted"), F.col("delta_updated_rows").alias("rows_updated"),
        F.lit(0).cast("long").alias("rows_deleted"))
    return A.process_end(log, rejects.unionByName(m), tb.ctx(), "CRM")


@query
def load_efficiency(spark, sf_dir):
    return A.load_efficiency(_log_day1(_t(spark, sf_dir)))


# --- step 7 / 8 --------------------------------------------------------------------------------

@query
def relationship_edges(spark, sf_dir):
    return tb.relationships(_t(spark, sf_dir))


@query
def schema_sync(spark, sf_dir):
    t = _t(spark, sf_dir)
    old = tb.satellite_day1(t).withColumn("legacy_type", F.col("product_type_code")).drop("chc_flag")
    new = M.sat_rows(tb.dq_day2(t), PRODUCT, tb.ctx())
    return append_synced(old, new)


# --- staging pipelines over source-shaped adapters of the driver tables -----------------------

from vaultkit.plans import catalogue as CAT  # noqa: E402
from vaultkit.plans import crm as CRM  # noqa: E402
from vaultkit.sources import adapters as AD  # noqa: E402
from vaultkit.sources.declared import DeclaredSources, check_sources, shaped  # noqa: E402


def _declared(frames):
    return DeclaredSources(frames=frames)


@query
def crm_products(spark, sf_dir):
    return CRM.crm_products(_declared(AD.crm_tables(_t(spark, sf_dir))), tb.ctx())


@query
def crm_identifiers(spark, sf_dir):
    return CRM.crm_identifiers(_declared(AD.crm_tables(_t(spark, sf_dir))), tb.ctx())


@query
def crm_relationships(spark, sf_dir):
    return CRM.crm_relationships(_declared(AD.crm_tables(_t(spark, sf_dir))), tb.ctx())


@query
def catalogue_products(spark, sf_dir):
    return CAT.catalogue_products(_declared(AD.catalogue_tables(_t(spark, sf_dir))), tb.ctx())


@query
def catalogue_identifiers(spark, sf_dir):
    return CAT.catalogue_identifiers(_declared(AD.catalogue_tables(_t(spark, sf_dir))), tb.ctx())


@query
def catalogue_relationships(spark, sf_dir):
    return CAT.catalogue_relationships(_declared(AD.catalogue_tables(_t(spark, sf_dir))), tb.ctx())


from vaultkit.plans import legacy as LEG  # noqa: E402
from vaultkit.plans import market as MKT  # noqa: E402


@query
def market_products(spark, sf_dir):
    return MKT.market_products(_declared(AD.market_tables(_t(spark, sf_dir))), tb.ctx(), own_corporation=AD.MARKET_OWNER)


@query
def market_relationships(spark, sf_dir):
    return MKT.market_relationships(_declared(AD.market_tables(_t(spark, sf_dir))), tb.ctx())


@query
def legacy_products(spark, sf_dir):
    return LEG.legacy_products(shaped(AD.legacy_product_table(_t(spark, sf_dir)), "legacy_product_history"), tb.ctx(), "legacy")


@query
def legacy_products_market(spark, sf_dir):
    return LEG.legacy_products(shaped(AD.legacy_product_table(_t(spark, sf_dir)), "market_product_history"), tb.ctx(), "market")


@query
def legacy_products_catalogue(spark, sf_dir):
    return LEG.legacy_products(shaped(AD.legacy_product_table(_t(spark, sf_dir), typed_dates=True), "catalogue_product_history"), tb.ctx(), "catalogue")


@query
def legacy_identifiers(spark, sf_dir):
    return LEG.legacy_identifiers(shaped(AD.legacy_identifier_table(_t(spark, sf_dir)), "legacy_identifier_history"), tb.ctx())


@query
def legacy_relationships(spark, sf_dir):
    return LEG.legacy_relationships(shaped(AD.legacy_relationship_table(_t(spark, sf_dir)), "market_relationship_history"), tb.ctx(), "market")


@query
def legacy_relationships_catalogue(spark, sf_dir):
    return LEG.legacy_relationships(shaped(AD.legacy_relationship_table(_t(spark, sf_dir), typed_dates=True), "catalogue_relationship_history"), tb.ctx(), "catalogue")


# --- stored tables: written, and read back as another application would -------------------------

from vaultkit.plans.model_run import read_snapshot, write_snapshot  # noqa: E402
from vaultkit.plans.store import VaultStore, scratch_store  # noqa: E402


@query
def snapshot_sink(spark, sf_dir):
    """Snapshots of two batches in a table partitioned by batch; the second is run twice and replaces itself."""
    t = _t(spark, sf_dir)
    store = scratch_store(spark, "snapshots")
    store.replace_partitions("snapshot", _snapshot_day1(t), ("etl_batch_id",))
    for _ in range(2):
        write_snapshot(store, "snapshot", tb.staging_day2(t), tb.rejects_day2(t), tb.ctx())
    return read_snapshot(VaultStore(spark, store.base), "snapshot")


@query
def snapshot_one_batch(spark, sf_dir):
    """One batch of that table: a partition filter leaves only its files."""
    t = _t(spark, sf_dir)
    store = scratch_store(spark, "snapshots")
    store.replace_partitions("snapshot", _snapshot_day1(t), ("etl_batch_id",))
    write_snapshot(store, "snapshot", tb.staging_day2(t), tb.rejects_day2(t), tb.ctx())
    return read_snapshot(VaultStore(spark, store.base), "snapshot", tb.DAY2_BATCH)


@query
def reject_schema_sync(spark, sf_dir):
    """Stored rejects over three batches: one adds a column, the next drops another; read back as one table."""
    r = tb.rejects_day2(_t(spark, sf_dir))
    store = scratch_store(spark, "rejects")
    second = r.withColumns({"severity": F.length("error_code"), "etl_batch_id": F.lit("B2")})
    for batch in (r, second, second.drop("error_level").withColumn("etl_batch_id", F.lit("B3"))):
        store.append_synced("reject", batch)
    return VaultStore(spark, store.base).read("reject")


@query
def reject_image_stored(spark, sf_dir):
    """Rejects stored with the record as a VARIANT column of Parquet; two fields are read back from it."""
    t = _t(spark, sf_dir)
    store = scratch_store(spark, "rejects")
    store.append_synced("reject", find_rejects({tb.STAGING_MODEL: tb.staging_day2(t)}, tb.countries(t), tb.ctx(), as_variant=True))
    r = VaultStore(spark, store.base).read("reject")
    field = lambda f: F.try_variant_get("rejected_record", f"$.{f}", "string")
    return r.select("reject_key", field("product_name").alias("product_name"), field("hashkey").alias("image_hashkey"))


@query
def declared_drift(spark, sf_dir):
    """Catalogue products from a file that has drifted from its declaration: other order and case, one more column."""
    store = scratch_store(spark, "drift")
    c = AD.catalogue_claves(_t(spark, sf_dir))
    drifted = c.select(F.lit("x").alias("NOTAS"), *[F.col(x).alias(x.upper()) for x in reversed(c.columns)])
    drifted.write.parquet(f"{store.base}/catalogue_claves.parquet")
    check_sources(spark, store.base, ["catalogue_claves"])
    return CAT.catalogue_products(DeclaredSources(spark, store.base), tb.ctx())


@query
def load_stored(spark, sf_dir):
    """Satellite after a delta load into stored tables, bucketed: hub, satellite and marked set are joined where they lie."""
    from vaultkit.plans.load import read_satellite, run_delta_load
    t = _t(spark, sf_dir)
    store = scratch_store(spark, "load")
    store.append("reject", tb.rejects_day2(t))
    store.add_versions("sat_product", tb.satellite_day1(t), 4)
    store.append("hub", tb.hub_day1(t), 4)
    run_delta_load(store, tb.staging_day2(t), PRODUCT, tb.ctx())
    return read_satellite(VaultStore(spark, store.base), "sat_product", PRODUCT)
