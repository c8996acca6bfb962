"""Spark schemas of the vault, reject and audit tables."""

from __future__ import annotations

from pyspark.sql import types as T

from vaultkit.spec import EntitySpec, SAT_META

S, TS, L = T.StringType(), T.TimestampNTZType(), T.LongType()


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


HUB = _struct([("hashkey", S), ("start_datetime", TS), ("load_datetime", TS), ("record_source", S),
               ("etl_batch_id", S), ("origin_stg", S)])

REJECT = _struct([
    ("reject_key", S), ("dataset_product_id", S), ("source_country_code", S), ("dataset_id", S),
    ("source_dataset_id", S), ("error_level", S), ("error_code", S), ("error_message", S),
    ("load_datetime", TS), ("source_lastmodifieddate", TS), ("hashkey", S), ("hashdiff", S),
    ("etl_batch_id", S), ("record_source", S), ("reject_source_model", S), ("rejected_record", S),
])

PROCESS_LOG = _struct([
    ("etl_batch_id", S), ("layer_name", S), ("model_name", S), ("source_system", S),
    ("process_status", S), ("start_timestamp", TS), ("end_timestamp", TS), ("rows_processed", L),
    ("error_message", S), ("delta_inserted_rows", L), ("delta_updated_rows", L),
])

BATCH_CONTROL = _struct([
    ("etl_batch_id", S), ("pipeline_name", S), ("total_rejected_records", L), ("start_timestamp", TS),
    ("end_timestamp", TS), ("process_status", S), ("error_message", S),
])

WATERMARK = _struct([
    ("source_system", S), ("source_object", S), ("watermark_column", S), ("watermark_value", TS),
    ("updated_at", TS), ("etl_batch_id", S),
])

RUN_RESULTS = _struct([
    ("seq", T.IntegerType()), ("layer_name", S), ("model_name", S), ("status", S), ("message", S),
    ("row_count", L), ("rows_affected", L), ("rows_inserted", L), ("rows_updated", L), ("rows_deleted", L),
])


def business(spec: EntitySpec) -> list[T.StructField]:
    return [T.StructField(c, T.DateType() if c in spec.date_cols else S, True) for c in spec.columns]


def staging(spec: EntitySpec) -> T.StructType:
    return T.StructType(business(spec) + [
        T.StructField("source_lastmodifieddate", TS, True), T.StructField("hashkey", S, True),
        T.StructField("hashdiff", S, True), T.StructField("load_datetime", TS, True),
        T.StructField("etl_batch_id", S, True), T.StructField("record_source", S, True),
    ])


def satellite(spec: EntitySpec) -> T.StructType:
    meta = [T.StructField(c, TS if c.endswith("_datetime") else S, True) for c in SAT_META]
    return T.StructType(meta + business(spec))


def history(spec: EntitySpec) -> T.StructType:
    sat = satellite(spec)
    fields = [f for f in sat.fields if f.name != "end_datetime"] + [T.StructField("end_datetime", TS, True)]
    return T.StructType(fields)
