"""Pieces shared by the staging pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultkit.functions.hashing import with_hashes
from vaultkit.operators.conform import conform
from vaultkit.operators.dedupe import latest_by
from vaultkit.spec import EntitySpec, LoadContext


def finish(rows: DataFrame, spec: EntitySpec, ctx: LoadContext, record_source: str,
           diff_cols: tuple[str, ...] | None = None, collapse_versions: bool = False) -> DataFrame:
    """Conform, hash, optionally keep one row per (hashkey, hashdiff), add load metadata."""
    conformed = conform(rows, spec.columns, spec.date_cols, keep=["source_lastmodifieddate"])
    hashed = with_hashes(conformed, spec.key_cols, diff_cols or spec.diff_cols)
    if collapse_versions:
        hashed = latest_by(hashed, ["hashkey", "hashdiff"], ["source_lastmodifieddate"])
    return hashed.select(
        *spec.columns, F.col("source_lastmodifieddate").cast("timestamp_ntz").alias("source_lastmodifieddate"),
        "hashkey", "hashdiff", ctx.ts().alias("load_datetime"), ctx.batch().alias("etl_batch_id"),
        F.lit(record_source).alias("record_source"),
    )
