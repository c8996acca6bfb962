"""End-to-end delta load of one entity from one staging frame.

Order of the warehouse procedure (process log RUNNING -> DQ set -> touch -> delta -> metrics ->
hub -> archive -> satellite -> watermark -> log SUCCESS) is kept as data dependencies: every
output is computed from the *input* versions and the one marked DQ set, so the metrics are
taken before the hub changes and the archive sees the satellite before the merge.

Nothing of the satellite's size is written or kept: a load appends the rows that are new or changed
and notes unchanged keys in a narrow last-seen table. ``read_satellite`` joins the two. All counts come
from the writes themselves (``Observation``): no job only counts.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultkit.operators import audit as A
from vaultkit.operators import delta as D
from vaultkit.operators.conform import standard_hash_names
from vaultkit.plans.store import VaultStore, versioned
from vaultkit.session import materialize
from vaultkit.sources import schemas as SC
from vaultkit.spec import EntitySpec, LoadContext

SEEN = T.StructType([T.StructField("hashkey", T.StringType()), T.StructField("hashdiff", T.StringType()),
                     T.StructField("updated_datetime", T.TimestampNTZType())])
LOG_KEYS = ("etl_batch_id", "model_name")
WATERMARK_KEYS = ("source_system", "source_object", "watermark_column")
HISTORY_DIGITS = 1         # of the hash diff: the history has 16 partitions per digit


def stored_history(spec: EntitySpec) -> T.StructType:
    return T.StructType([*SC.history(spec).fields, T.StructField(D.PREFIX, T.StringType())])


@dataclass
class LoadResult:
    marked: DataFrame           # DQ set with its action, written once into the shared folder
    actions: dict[str, int]     # rows per action, observed by that write
    metrics: DataFrame          # as the warehouse counts them; a run takes them from its writes
    hub_new: DataFrame
    history_new: DataFrame
    satellite_new: DataFrame    # NEW and CHANGED rows, to be appended as the newest versions
    seen: DataFrame             # UNCHANGED keys with the time they were seen
    watermarks: DataFrame
    landed: str | None = None   # the marked set's name in the session's catalog, if it is bucketed


class _Trace:
    """Step timings to stderr when VAULTKIT_TRACE is set."""

    def __init__(self, label: str):
        self.on = bool(os.environ.get("VAULTKIT_TRACE"))
        self.label = label
        self.t = time.perf_counter()

    def step(self, name: str) -> None:
        if self.on:
            now = time.perf_counter()
            print(f"[{self.label}] {name}: {now - self.t:.2f}s", file=sys.stderr, flush=True)
            self.t = now


def _empty(spark, schema):
    return spark.createDataFrame([], schema)


def delta_load(staging: DataFrame, hub: DataFrame | None, satellite: DataFrame | None,
               history: DataFrame | None, rejects: DataFrame | None, watermarks: DataFrame | None,
               spec: EntitySpec, ctx: LoadContext, buckets: int | None = None, digits: int | None = None) -> LoadResult:
    """Everything one load produces, as DataFrames.

    ``satellite`` are its rows or row versions, ``buckets`` its and the hub's bucket count, ``digits`` the
    history's prefix. The marked DQ set feeds six outputs, so it is written once (it has the size of the
    staging input) and read back: a lost executor does not repeat the staging views. It is written in
    the satellite's buckets, so the joins that follow move neither it nor hub or satellite.
    """
    spark = staging.sparkSession
    # Legacy hash column names (IDENTIFIER_MD5 / RECORD_MD5) are read as hashkey / hashdiff.
    hub, satellite, history = [standard_hash_names(t) if t is not None else None for t in (hub, satellite, history)]
    wm = watermarks if watermarks is not None else _empty(spark, SC.WATERMARK)
    dq = D.dq_passed(staging, rejects, wm if ctx.use_watermark else None, spec, ctx)
    marked = D.mark(dq, satellite, buckets)
    seen = Observation()
    counts = [F.count_if(F.col(D.ACTION) == a).alias(a) for a in (D.NEW, D.CHANGED, D.UNCHANGED)]
    if ctx.use_watermark:
        counts.append(F.max(F.col(ctx.watermark_column)).cast("timestamp_ntz").cast("string").alias("highest"))
    landed = f"marked_{uuid.uuid4().hex}" if buckets else None
    marked = materialize(marked.observe(seen, *counts), "marked", "hashkey", buckets, landed)
    observed = dict(seen.get)
    highest = observed.pop("highest", None)
    changed = marked.where(F.col(D.ACTION) == D.CHANGED)
    hub_new = D.hub_rows(D.new_hub_keys(marked, hub), spec, ctx)
    if satellite is None:
        history_new = _empty(spark, SC.history(spec))
    else:
        history_new = D.archived(D.current_rows(changed, satellite), history, ctx, digits=digits)
    same = marked.where(F.col(D.ACTION) == D.UNCHANGED).select("hashkey", "hashdiff", ctx.ts().alias("updated_datetime"))
    next_wm = D.advance_watermark(wm, highest and dt.datetime.fromisoformat(highest), ctx) if ctx.use_watermark else wm
    return LoadResult(marked, observed, D.delta_metrics(marked, hub), hub_new, history_new, D.stamped(marked, spec, ctx), same, next_wm, landed)


def read_satellite(store: VaultStore, table: str, spec: EntitySpec) -> DataFrame | None:
    """The satellite with UPDATED_DATETIME of the last load that saw each row, changed or not."""
    rows = store.current(table, SC.satellite(spec))
    seen = store.rows(f"{table}_seen", SEEN)
    if rows is None or seen is None:
        return rows
    s = seen.groupBy("hashkey", F.col("hashdiff").alias("__d")).agg(F.max("updated_datetime").alias("__u"))
    j = rows.join(s, (rows["hashkey"] == s["hashkey"]) & (rows["hashdiff"] == s["__d"]), "left").drop(s["hashkey"])
    return j.withColumn("updated_datetime", F.greatest("updated_datetime", "__u")).select(*D.sat_columns(spec))


def compact_satellite(store: VaultStore, table: str, spec: EntitySpec, buckets: int | None = None) -> None:
    """Fold old row versions and last-seen times into one row per key, bucketed by hashkey if ``buckets``."""
    rows = read_satellite(store, table, spec)
    if rows is not None:
        store.rewrite(table, rows.withColumn(D.SEQ, F.lit(0).cast("long")), buckets)
        if store.exists(f"{table}_seen"):
            store.rewrite(f"{table}_seen", _empty(store.spark, SEEN), buckets)


def _log_rows(store: VaultStore, log: DataFrame, ctx: LoadContext, model: str) -> None:
    """Replace the partition of (batch, model): loads that overlap do not touch each other's rows."""
    mine = log.where((F.col("etl_batch_id") == ctx.batch_id) & (F.col("model_name") == A.model_name(model)))
    store.replace_partitions("process_log", mine.coalesce(1), LOG_KEYS)


def run_delta_load(store: VaultStore, staging: DataFrame, spec: EntitySpec, ctx: LoadContext,
                   names: dict[str, str] | None = None, satellite_buckets: int | None = None) -> dict:
    """Read the tables of ``store``, run ``delta_load`` and write what it changes.

    The RUNNING row of the process log is written first and closed with SUCCESS or, on any error,
    FAILED and the message. Hub, history and satellite are appended to; the partitions of this load's
    watermark and log row are replaced. Hub, history, satellite, in that order: a load that broke off is
    completed by running it again. Returns the metrics row as a dict.

    ``satellite_buckets``: the first load writes hub, satellite and last-seen table bucketed by hashkey.
    Later loads join them where they lie and shuffle only the staging side.
    """
    n = {"hub": "hub", "sat": f"sat_{spec.origin.lower()}", "hist": f"sat_{spec.origin.lower()}_hist",
         "reject": "reject", "wm": "source_watermark"}
    n.update(names or {})
    tr = _Trace(f"load {ctx.batch_id}")
    spark = staging.sparkSession

    def log() -> DataFrame:
        found = store.read("process_log", SC.PROCESS_LOG)
        return found if found is not None else _empty(spark, SC.PROCESS_LOG)

    _log_rows(store, A.process_start(log(), ctx, "DELTA", spec.name, ctx.system, A.now()), ctx, spec.name)
    tr.step("log start")
    res = None
    try:
        buckets = store.buckets(n["sat"]) if store.exists(n["sat"]) else satellite_buckets
        res = delta_load(staging, store.rows(n["hub"], SC.HUB), store.rows(n["sat"], versioned(SC.satellite(spec))),
                         store.rows(n["hist"], stored_history(spec)), store.rows(n["reject"], SC.REJECT),
                         store.rows(n["wm"], SC.WATERMARK), spec, ctx, buckets, HISTORY_DIGITS)
        tr.step("dq + mark")
        inserted, changed = store.append(n["hub"], res.hub_new, buckets), res.actions[D.CHANGED]
        metrics = {"delta_inserted_rows": inserted, "delta_updated_rows": changed, "rows_processed": inserted + changed}
        if changed or not store.exists(n["hist"]):
            history = D.with_prefix(res.history_new, HISTORY_DIGITS)
            store.append(n["hist"], history.repartition(D.PREFIX), partition_by=(D.PREFIX,))
        tr.step("write hub, history")
        if not store.exists(n["sat"]) or res.actions[D.NEW] or changed:
            store.add_versions(n["sat"], res.satellite_new, buckets)
        if res.actions[D.UNCHANGED]:
            store.append(f"{n['sat']}_seen", res.seen, buckets)
        tr.step("write satellite")
        if ctx.use_watermark:
            mine = (F.col("source_system") == ctx.system) & (F.col("source_object") == ctx.object_name)
            store.replace_partitions(n["wm"], res.watermarks.where(mine).coalesce(1), WATERMARK_KEYS)
        _log_rows(store, A.process_success(log(), metrics, ctx, spec.name, A.now()), ctx, spec.name)
        tr.step("watermark, log")
    except Exception as e:
        _log_rows(store, A.process_failed(log(), ctx, spec.name, f"{type(e).__name__}: {e}"[:2000], A.now()), ctx, spec.name)
        raise
    finally:
        if res is not None and res.landed:
            spark.sql(f"DROP TABLE IF EXISTS {res.landed}")         # the name only: the files stay in the shared folder until the end
    return metrics
