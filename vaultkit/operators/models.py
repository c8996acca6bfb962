"""Model-mode loads: full hub build, incremental satellite and history, snapshots, marts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultkit.operators.conform import append_synced
from vaultkit.operators.dedupe import latest_by, union_all
from vaultkit.operators.merge import insert_new, upsert
from vaultkit.operators.quality import exclude_rejects
from vaultkit.operators.delta import archived_already, history_columns, sat_columns
from vaultkit.spec import HUB_COLUMNS, EntitySpec, LoadContext

# Origin labels of hub rows, also the tie order when one key comes from several.
ORIGIN_ORDER = ("PRODUCT", "IDENTIFIER", "RELATIONSHIP")


def _hub_candidates(frames: Iterable[DataFrame], origin: str) -> DataFrame:
    rank = F.lit(ORIGIN_ORDER.index(origin))
    return union_all(df.select("hashkey", "record_source", "etl_batch_id", rank.alias("__origin")) for df in frames)


def hub_full(products: Iterable[DataFrame], identifiers: Iterable[DataFrame], relationships: Iterable[DataFrame],
             rejects: DataFrame | None, hub: DataFrame | None, ctx: LoadContext) -> DataFrame:
    """Hub rows to insert: product keys minus rejected ids, identifier and relationship keys,
    only hashkeys the hub lacks, one row per hashkey (product first, then identifier, relationship).

    One top-1 per hashkey over all candidates (partial limit map-side) replaces a DISTINCT per
    source: duplicate keys collapse before the single shuffle. Sorts hold the key and what decides only;
    the columns that are the same for all rows are added to the rows that are left.
    """
    prods = [exclude_rejects(p, rejects, ("dataset_product_id",)) for p in products]
    cand = union_all([
        _hub_candidates(prods, "PRODUCT"),
        _hub_candidates(identifiers, "IDENTIFIER"),
        _hub_candidates(relationships, "RELATIONSHIP"),
    ])
    one = latest_by(cand, ["hashkey"], [F.col("__origin").asc(), F.col("record_source").asc_nulls_last(), F.col("etl_batch_id").asc_nulls_last()])
    origin = F.when(F.col("__origin") == 0, ORIGIN_ORDER[0]).when(F.col("__origin") == 1, ORIGIN_ORDER[1]).otherwise(ORIGIN_ORDER[2])
    values = {"start_datetime": ctx.ts(), "load_datetime": ctx.ts(), "origin_stg": origin}
    return insert_new(hub, one, ["hashkey"]).select(*[values[c].alias(c) if c in values else c for c in HUB_COLUMNS])


def sat_rows(staging: DataFrame, spec: EntitySpec, ctx: LoadContext) -> DataFrame:
    """Staging rows shaped as satellite rows stamped with the run time (one per hashkey)."""
    one = latest_by(staging, ["hashkey"], ["load_datetime", "hashdiff"])
    ts = ctx.ts()
    return one.select(
        "hashkey", "hashdiff",
        ts.alias("start_datetime"), ts.alias("load_datetime"),
        F.lit(None).cast("timestamp_ntz").alias("end_datetime"),
        ts.alias("updated_datetime"),
        F.col("etl_batch_id"), F.col("record_source"),
        *spec.columns,
    )


def new_or_changed(incoming: DataFrame, current: DataFrame | None, key: str = "hashkey", diff: str = "hashdiff") -> DataFrame:
    """Incoming rows whose key is new or whose diff differs from the current row's."""
    if current is None:
        return incoming
    cur = current.select(F.col(key).alias("__k"), F.col(diff).alias("__d"))
    j = incoming.join(cur, incoming[key] == cur["__k"], "left")
    return j.where(F.col("__k").isNull() | (F.col("__d") != incoming[diff])).drop("__k", "__d")


def sat_incremental(staging: DataFrame, satellite: DataFrame | None, rejects: DataFrame | None,
                    spec: EntitySpec, ctx: LoadContext) -> DataFrame:
    """Next satellite of the model mode: new-or-changed rows replace the whole row by hashkey.

    One full outer join on hashkey (both sides hold one row per key): a staging row wins when its
    key is new or its hashdiff differs; otherwise the satellite row stays as it is.
    """
    clean = exclude_rejects(staging, rejects, ("dataset_product_id",)) if rejects is not None else staging
    rows = sat_rows(clean, spec, ctx)
    if satellite is None:
        return rows
    cols = sat_columns(spec)
    t = satellite.select(*cols).alias("t")
    s = rows.alias("s")
    j = t.join(s, F.col("t.hashkey") == F.col("s.hashkey"), "full_outer")
    take = "(s.hashkey IS NOT NULL AND (t.hashkey IS NULL OR t.hashdiff <> s.hashdiff))"
    return j.selectExpr(*[f"CASE WHEN {take} THEN s.`{c}` ELSE t.`{c}` END AS `{c}`" for c in cols])


def expire_versions(satellite_before: DataFrame | None, incoming: DataFrame, history: DataFrame | None,
                    spec: EntitySpec, ctx: LoadContext, rejects: DataFrame | None = None, digits: int | None = None) -> DataFrame:
    """History rows of the model mode: satellite rows (before this load) whose incoming hashdiff
    differs, END_DATETIME = run time, unless the hashdiff is archived already. First run: none.

    ``rejects`` (products only): rejected ids never replace their version, so they archive nothing.
    ``digits``: the history is partitioned by that prefix of the hash diff.
    """
    if rejects is not None:
        incoming = exclude_rejects(incoming, rejects, ("dataset_product_id",))
    if satellite_before is None or history is None:
        base = satellite_before if satellite_before is not None else incoming
        return base.limit(0).select(
            *[F.col(c) if c in base.columns else F.lit(None).cast("string").alias(c) for c in history_columns(spec) if c != "end_datetime"],
            F.lit(None).cast("timestamp_ntz").alias("end_datetime"),
        )
    inc = incoming.select(F.col("hashkey").alias("__k"), F.col("hashdiff").alias("__d"))
    sat = satellite_before.select(*[c for c in sat_columns(spec) if c != "end_datetime"])
    expiring = sat.join(inc, (sat["hashkey"] == inc["__k"]) & (sat["hashdiff"] != inc["__d"]), "left_semi")
    rows = expiring.withColumn("end_datetime", ctx.ts())
    rows = rows.join(archived_already(history, rows, ("hashdiff",), digits), "hashdiff", "left_anti")
    return rows.select(*history_columns(spec))


def snapshot(staging: DataFrame, rejects: DataFrame | None, existing: DataFrame | None, ctx: LoadContext) -> DataFrame:
    """Next snapshot table: captured_at + accepted staging columns, upsert by (batch, hashkey, hashdiff).

    Existing rows are synced to the incoming schema (new columns NULL, vanished columns dropped).
    """
    clean = exclude_rejects(staging, rejects, ("dataset_product_id",))
    rows = clean.select(ctx.ts().alias("captured_at"), *clean.columns)
    keys = ["etl_batch_id", "hashkey", "hashdiff"]
    rows = latest_by(rows, keys, ["source_lastmodifieddate", "load_datetime"])
    if existing is None:
        return rows
    synced = append_synced(existing, rows.limit(0))
    return upsert(synced, rows, keys)


def mart(satellite: DataFrame, spec: EntitySpec, batch_id: str | None = None) -> DataFrame:
    """Active satellite rows (of one batch when given), business columns only."""
    rows = satellite.where(F.col("end_datetime").isNull())
    if batch_id is not None:
        rows = rows.where(F.col("etl_batch_id") == batch_id)
    return rows.select(*spec.columns)
