"""Vault test bed derived from the driver's tables (customer, nation, orders, lineitem, ...).

Day 2 staging is the customer master seen as products; a day 1 satellite, hub and history are
derived from the same rows with deterministic differences so that every delta action occurs:
  * customers with key % 11 = 0 are missing from day 2 (ABSENT when in day 1),
  * key % 10 = 0 are missing from day 1 (NEW), key % 7 = 0 get a changed name on day 2 (CHANGED),
  * key % 13 = 0 have an empty name and key % 17 = 0 an empty country on day 2 (rejected),
  * nations of region 4 are not in the country list (rejected as unknown country).
These rules shape the data; every derivation still reads whole tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultkit.functions.hashing import with_hashes
from vaultkit.operators.conform import conform
from vaultkit.operators.delta import dq_passed, hub_rows, history_columns
from vaultkit.operators.quality import find_rejects
from vaultkit.spec import PRODUCT, IDENTIFIER, RELATIONSHIP, LoadContext

# Fixed values of the test bed.
DAY1_TS = "2025-01-01 00:00:00"
RUN_TS = dt.datetime(2025, 1, 2, 3, 4, 5)
HIST0_END_TS = "2024-12-31 00:00:00"
DAY1_BATCH = "B20250101"
DAY2_BATCH = "B20250102"
RECORD_SOURCE = "CRM"
STAGING_MODEL = "STG_CUSTOMER"
EXCLUDED_REGION = 4

# Parts into which the lines of one scan task are dealt (a scan task has 128 MB of a table at most by default).
PARTS_OF_SPLIT = 8


def memo(fn):
    """Build a derived frame once per table set (repeated uses share one DataFrame object)."""
    def wrapper(t):
        store = getattr(t, "memo", None)
        if store is None:
            return fn(t)
        if fn.__name__ not in store:
            store[fn.__name__] = fn(t)
        return store[fn.__name__]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


def ctx(**kw) -> LoadContext:
    base = dict(batch_id=DAY2_BATCH, run_ts=RUN_TS, record_source=RECORD_SOURCE, source_object=STAGING_MODEL)
    base.update(kw)
    return LoadContext(**base)


def ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


@memo
def countries(t) -> DataFrame:
    """Country reference: upper(trim(n_name)) of nations outside region 4."""
    return t["nation"].where(F.col("n_regionkey") != EXCLUDED_REGION).select(
        F.upper(F.trim("n_name")).alias("iso2_code")).distinct()


@memo
def modified(t) -> DataFrame:
    """Last order date per customer (the product's source modification time)."""
    return t["orders"].groupBy("o_custkey").agg(F.max("o_orderdate").alias("modified"))


@memo
def customer_base(t) -> DataFrame:
    c = t["customer"].select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = t["nation"].select("n_nationkey", "n_name", "n_regionkey")
    m = modified(t)
    return (c.join(n, c["c_nationkey"] == n["n_nationkey"])
             .join(m, c["c_custkey"] == m["o_custkey"], "left")
             .drop("o_custkey"))


def _strength():
    return F.col("c_acctbal").cast("decimal(18,2)").cast("string")


@memo
def staging_day2(t) -> DataFrame:
    """Conformed product staging of day 2 with hash key and hash diff."""
    k = F.col("c_custkey")
    rows = customer_base(t).where(k % 11 != 0).select(
        F.when(k % 17 == 0, F.lit("")).otherwise(F.upper(F.trim("n_name"))).alias("geographic_id"),
        F.lit("CRM").alias("dataset_id"),
        F.lit("CUSTOMER").alias("source_dataset_id"),
        k.cast("string").alias("dataset_product_id"),
        F.col("c_mktsegment").alias("product_type_code"),
        F.when(k % 13 == 0, F.lit(""))
         .when(k % 7 == 0, F.concat(F.upper("c_name"), F.lit(" V2")))
         .otherwise(F.upper("c_name")).alias("product_name"),
        _strength().alias("strength"),
        F.col("modified").alias("source_lastmodifieddate"),
    )
    return stage(rows, PRODUCT, DAY2_BATCH, RUN_TS.strftime("%Y-%m-%d %H:%M:%S"))


def stage(rows: DataFrame, spec, batch: str, load_ts: str, record_source: str = RECORD_SOURCE) -> DataFrame:
    """Conform to the entity schema, add hashes and load metadata."""
    conformed = conform(rows, spec.columns, spec.date_cols, keep=["source_lastmodifieddate"])
    hashed = with_hashes(conformed, spec.key_cols, spec.diff_cols)
    return hashed.select(
        *spec.columns, "source_lastmodifieddate", "hashkey", "hashdiff",
        ts(load_ts).alias("load_datetime"), F.lit(batch).alias("etl_batch_id"),
        F.lit(record_source).alias("record_source"),
    )


@memo
def day1_rows(t) -> DataFrame:
    """Day 1 product rows: plain names, valid countries, keys % 10 and % 17 left out.

    Keys % 13 = 0 are in: day 2 rejects them with a changed hashdiff, so no load may archive them.
    """
    k = F.col("c_custkey")
    base = customer_base(t).where((k % 10 != 0) & (k % 17 != 0))
    base = base.join(countries(t), F.upper(F.trim("n_name")) == F.col("iso2_code"), "left_semi")
    return base.select(
        F.upper(F.trim("n_name")).alias("geographic_id"),
        F.lit("CRM").alias("dataset_id"),
        F.lit("CUSTOMER").alias("source_dataset_id"),
        k.cast("string").alias("dataset_product_id"),
        F.col("c_mktsegment").alias("product_type_code"),
        F.upper("c_name").alias("product_name"),
        _strength().alias("strength"),
        F.col("modified").alias("source_lastmodifieddate"),
    )


@memo
def satellite_day1(t) -> DataFrame:
    staged = stage(day1_rows(t), PRODUCT, DAY1_BATCH, DAY1_TS)
    d1 = ts(DAY1_TS)
    return staged.select(
        "hashkey", "hashdiff", d1.alias("start_datetime"), d1.alias("load_datetime"),
        F.lit(None).cast("timestamp_ntz").alias("end_datetime"), d1.alias("updated_datetime"),
        F.lit(DAY1_BATCH).alias("etl_batch_id"), F.lit(RECORD_SOURCE).alias("record_source"),
        *PRODUCT.columns,
    )


@memo
def rejects_day2(t) -> DataFrame:
    return find_rejects({STAGING_MODEL: staging_day2(t)}, countries(t), ctx())


@memo
def dq_day2(t) -> DataFrame:
    return dq_passed(staging_day2(t), rejects_day2(t), None, PRODUCT, ctx())


@memo
def hub_day1(t) -> DataFrame:
    """Hub before day 2: day 1 satellite keys plus DQ keys of customers with key % 20 = 0."""
    sat_keys = satellite_day1(t).select("hashkey")
    extra = dq_day2(t).where(F.col("dataset_product_id").cast("long") % 20 == 0).select("hashkey")
    keys = sat_keys.unionByName(extra).distinct()
    day1 = LoadContext(batch_id=DAY1_BATCH, run_ts=dt.datetime(2025, 1, 1), record_source=RECORD_SOURCE)
    return hub_rows(keys, PRODUCT, day1)


@memo
def history_day1(t) -> DataFrame:
    """History before day 2: the day 1 versions of customers with key % 14 = 0, already expired."""
    sat = satellite_day1(t).where(F.col("dataset_product_id").cast("long") % 14 == 0)
    return sat.withColumn("end_datetime", ts(HIST0_END_TS)).select(*history_columns(PRODUCT))


@memo
def watermarks_day1(t) -> DataFrame:
    """Watermark table before day 2: one row for this source at the median-ish day 1 mark.

    The stored value is derived from the data: the latest order date before 1999-01-01.
    """
    o = t["orders"].where(F.col("o_orderdate") < ts("1999-01-01 00:00:00"))
    c = ctx()
    return o.agg(F.max("o_orderdate").alias("watermark_value")).select(
        F.lit(c.system).alias("source_system"), F.lit(c.object_name).alias("source_object"),
        F.lit(c.watermark_name).alias("watermark_column"), F.col("watermark_value"),
        ts(DAY1_TS).alias("updated_at"), F.lit(DAY1_BATCH).alias("etl_batch_id"),
    )


@memo
def identifiers(t) -> DataFrame:
    """Identifier staging: one identifier per customer (country + id), effective from the first order."""
    c = t["customer"].select("c_custkey", "c_nationkey")
    n = t["nation"].select("n_nationkey", "n_name")
    first = t["orders"].groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("modified"))
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(first, c["c_custkey"] == first["o_custkey"], "left")
    geo = F.upper(F.trim("n_name"))
    rows = j.select(
        geo.alias("geographic_id"), F.lit("CRM").alias("dataset_id"),
        F.col("c_custkey").cast("string").alias("dataset_product_id"),
        F.lit("CRM").alias("identifier_type_code"),
        F.concat(geo, F.lit("_"), F.col("c_custkey").cast("string")).alias("identifier_id"),
        F.lit(None).cast("string").alias("status_code"),
        F.col("first_order").cast("date").alias("effective_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.col("modified").alias("source_lastmodifieddate"),
    )
    return stage(rows, IDENTIFIER, DAY2_BATCH, RUN_TS.strftime("%Y-%m-%d %H:%M:%S"))


@memo
def edges(t) -> DataFrame:
    """Supplier -> part edges with the latest ship date per pair.

    Pairs seldom repeat, and each becomes a row ten times as wide that later steps sort: lines are dealt by pair
    into parts that stay small at any size of the table, and which adaptive execution does not merge again.
    """
    lines = t["lineitem"].select("l_suppkey", "l_partkey", "l_shipdate")
    return lines.repartition(PARTS_OF_SPLIT * lines.rdd.getNumPartitions(), "l_suppkey", "l_partkey").groupBy("l_suppkey", "l_partkey").agg(F.max("l_shipdate").alias("last_ship"))


@memo
def relationships(t) -> DataFrame:
    """Relationship staging: supplier (parent) supplies part (child), one row per pair."""
    s = t["supplier"].select("s_suppkey", "s_nationkey")
    n = t["nation"].select("n_nationkey", "n_name")
    e = edges(t)
    j = e.join(s, e["l_suppkey"] == s["s_suppkey"]).join(n, s["s_nationkey"] == n["n_nationkey"])
    geo = F.upper(F.trim("n_name"))
    rows = j.select(
        geo.alias("parent_geographic_id"), geo.alias("child_geographic_id"),
        F.lit("SUPPLIER").alias("parent_dataset_id"), F.lit("PART").alias("child_dataset_id"),
        F.col("l_suppkey").cast("string").alias("parent_dataset_product_id"),
        F.col("l_partkey").cast("string").alias("child_dataset_product_id"),
        F.lit("SUPPLIES").alias("relationship_type_code"),
        F.lit(None).cast("string").alias("status_code"),
        F.lit(None).cast("date").alias("effective_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.col("last_ship").alias("source_lastmodifieddate"),
    )
    return stage(rows, RELATIONSHIP, DAY2_BATCH, RUN_TS.strftime("%Y-%m-%d %H:%M:%S"))


@memo
def sources(t) -> dict[str, DataFrame]:
    """Customer, supplier and part conformed to the product schema with source constants."""
    rs = RUN_TS.strftime("%Y-%m-%d %H:%M:%S")
    n = t["nation"].select("n_nationkey", F.upper(F.trim("n_name")).alias("geo"))
    cust = t["customer"].join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("geo").alias("geographic_id"), F.lit("CRM").alias("dataset_id"), F.lit("CUSTOMER").alias("source_dataset_id"),
        F.col("c_custkey").cast("string").alias("dataset_product_id"), F.lit("BRAND").alias("product_type_code"),
        F.upper("c_name").alias("product_name"), F.col("c_mktsegment").alias("channel"),
        F.lit(None).cast("timestamp_ntz").alias("source_lastmodifieddate"))
    supp = t["supplier"].join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("geo").alias("geographic_id"), F.lit("MARKET").alias("dataset_id"), F.lit("SUPPLIER").alias("source_dataset_id"),
        F.concat(F.lit("BRAND_"), F.col("s_suppkey").cast("string")).alias("dataset_product_id"),
        F.lit("BRAND").alias("product_type_code"), F.upper("s_name").alias("product_name"),
        F.col("s_acctbal").cast("decimal(18,2)").cast("string").alias("strength"),
        F.lit(None).cast("timestamp_ntz").alias("source_lastmodifieddate"))
    part = t["part"].select(
        F.lit("MX").alias("geographic_id"), F.lit("CATALOGUE").alias("dataset_id"), F.lit("PART").alias("source_dataset_id"),
        F.upper(F.trim(F.col("p_partkey").cast("string"))).alias("dataset_product_id"),
        F.lit("PMP").alias("product_type_code"),
        F.upper(F.trim(F.concat_ws(" ", "p_name", "p_brand", "p_type"))).alias("product_name"),
        F.col("p_brand").alias("brand_name"), F.lit("A").alias("product_status_code"),
        F.col("p_retailprice").cast("decimal(18,2)").cast("string").alias("package_quantity"),
        F.lit(None).cast("timestamp_ntz").alias("source_lastmodifieddate"))
    return {
        "STG_CUSTOMER": stage(cust, PRODUCT, DAY2_BATCH, rs, "CRM"),
        "STG_SUPPLIER": stage(supp, PRODUCT, DAY2_BATCH, rs, "MARKET"),
        "STG_PART": stage(part, PRODUCT, DAY2_BATCH, rs, "CATALOGUE"),
    }


# --- day 1 and day 2 of identifiers and relationships -------------------------------------------

def _restage(df: DataFrame, spec, changes: dict) -> DataFrame:
    """Day 1 satellite of an entity: its staging columns with ``changes``, hashed again."""
    rows = df.withColumns(changes).select(*spec.columns, "source_lastmodifieddate")
    s = stage(rows, spec, DAY1_BATCH, DAY1_TS)
    d1 = ts(DAY1_TS)
    return s.select("hashkey", "hashdiff", d1.alias("start_datetime"), d1.alias("load_datetime"),
                    F.lit(None).cast("timestamp_ntz").alias("end_datetime"), d1.alias("updated_datetime"),
                    F.lit(DAY1_BATCH).alias("etl_batch_id"), F.lit(RECORD_SOURCE).alias("record_source"), *spec.columns)


def identifiers_day2(t) -> DataFrame:
    return identifiers(t).where(F.col("dataset_product_id").cast("long") % 11 != 0)


def identifier_satellite_day1(t) -> DataFrame:
    """Day 1: ids % 10 missing (NEW on day 2), ids % 7 with an effective date one day earlier (CHANGED)."""
    k = F.col("dataset_product_id").cast("long")
    earlier = F.when(k % 7 == 0, F.date_sub("effective_date", 1)).otherwise(F.col("effective_date"))
    return _restage(identifiers(t).where(k % 10 != 0), IDENTIFIER, {"effective_date": earlier})


def relationships_day2(t) -> DataFrame:
    return relationships(t).where(F.col("child_dataset_product_id").cast("long") % 11 != 0)


def relationship_satellite_day1(t) -> DataFrame:
    """Day 1: children % 10 missing (NEW on day 2), children % 7 with another status (CHANGED)."""
    k = F.col("child_dataset_product_id").cast("long")
    status = F.when(k % 7 == 0, F.lit("OLD")).otherwise(F.col("status_code"))
    return _restage(relationships(t).where(k % 10 != 0), RELATIONSHIP, {"status_code": status})


def relationships_without_some_parents(t) -> DataFrame:
    """Day 2 with a NULL parent id for children % 3 = 0."""
    k = F.col("child_dataset_product_id").cast("long")
    parent = F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("parent_dataset_product_id"))
    rows = relationships_day2(t).withColumn("parent_dataset_product_id", parent).select(*RELATIONSHIP.columns, "source_lastmodifieddate")
    return stage(rows, RELATIONSHIP, DAY2_BATCH, RUN_TS.strftime("%Y-%m-%d %H:%M:%S"))
