"""Model-mode run: the vault models of one batch in dependency order, with run and model audit.

Order: batch start -> REJECT -> HUB, SAT, staging snapshots -> SAT_HIST -> DM -> run-end roll-up.
The history step compares the satellite *before* this run with the incoming staging rows, so a
changed version is archived even though the satellite is rewritten in the same run.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultkit.operators import audit as A
from vaultkit.operators import models as M
from vaultkit.operators.delta import PREFIX, current_rows, sat_columns, with_prefix
from vaultkit.operators.quality import exclude_rejects, find_rejects, new_rejects
from vaultkit.plans.store import VaultStore, counted, versioned
from vaultkit.session import materialize
from vaultkit.sources import schemas as SC
from vaultkit.spec import EntitySpec, LoadContext


@dataclass
class ModelInputs:
    products: Mapping[str, DataFrame]           # staging model name -> product staging frame
    identifiers: Mapping[str, DataFrame]
    relationships: Mapping[str, DataFrame]
    countries: DataFrame                        # country reference (iso2_code)
    satellite_sources: Mapping[str, tuple[EntitySpec, str]]  # satellite table -> (spec, staging model)
    snapshot_models: tuple[str, ...] = ()       # product staging models to snapshot


LOG_KEYS = ("etl_batch_id", "model_name")
CONTROL_KEYS = ("etl_batch_id",)


def planned_models(inputs: ModelInputs) -> list[tuple[str, str]]:
    """(layer, model) of everything a run will do."""
    planned = [("STAGE", m) for m in (*inputs.products, *inputs.identifiers, *inputs.relationships)]
    planned += [("DQ", "REJECT"), ("HUB", "HUB"), *[(x, y) for t in inputs.satellite_sources for x, y in (
        ("SAT", t.upper()), ("HIST", f"{t.upper()}_HIST"), ("DM", f"DM_{t.upper()}"))]]
    return planned + [("HIST", f"{m}_SNAPSHOT") for m in inputs.snapshot_models]


def run_models(store: VaultStore, inputs: ModelInputs, ctx: LoadContext, pipeline: str = "vault") -> dict:
    """Run the models of one batch against ``store``; returns per-model processed rows.

    The batch row and a RUNNING row per model are written before the work, all models in one MERGE. On an
    error the model that failed and its message go into the log, the batch closes as FAILED and the error is
    raised. Row counts are observed by the writes. A rerun of a batch replaces its snapshot partitions.
    """
    from vaultkit.plans.load import HISTORY_DIGITS, _Trace, stored_history
    tr = _Trace(f"models {ctx.batch_id}")
    spark = inputs.countries.sparkSession
    results: list[tuple] = []
    running: list[tuple[str, str]] = []         # (layer, model) at work

    def table(name, schema):
        found = store.read(name, schema)
        return found if found is not None else spark.createDataFrame([], schema)

    def of_batch(name: str, rows: DataFrame, keys: tuple[str, ...]) -> None:
        store.replace_partitions(name, rows.where(F.col("etl_batch_id") == ctx.batch_id).coalesce(1), keys)

    def begin(layer: str, model: str) -> None:
        running[:] = [(layer, model)]

    def done(rows: int | None = None, affected: int | None = None, inserted: int = 0) -> None:
        """Result of the model at work: row count (STAGE / DQ / DM layers) or affected rows (others)."""
        (layer, model), running[:] = running[0], []
        results.append((len(results) + 1, layer, model, "success", None, rows, affected, inserted, 0, 0))

    def close() -> None:
        res = spark.createDataFrame(results, SC.RUN_RESULTS)
        at = A.now()
        of_batch("process_log", A.process_end(table("process_log", SC.PROCESS_LOG), res, ctx, ctx.system, at), LOG_KEYS)
        of_batch("batch_control", A.batch_end(table("batch_control", SC.BATCH_CONTROL), res, ctx, at), CONTROL_KEYS)

    at = A.now()
    planned = planned_models(inputs)
    of_batch("batch_control", A.batch_start(table("batch_control", SC.BATCH_CONTROL), ctx, pipeline, at), CONTROL_KEYS)
    of_batch("process_log", A.process_start_all(table("process_log", SC.PROCESS_LOG), ctx, planned, ctx.system, at), LOG_KEYS)
    tr.step("batch start")
    try:
        # Staging views feed the row counts, REJECT, HUB, SAT, HIST and snapshots: each is written once.
        staging: dict[str, DataFrame] = {}
        for name, df in {**inputs.products, **inputs.identifiers, **inputs.relationships}.items():
            begin("STAGE", name)
            landed: list[DataFrame] = []
            n = counted(df, lambda rows: landed.append(materialize(rows, "staging")))
            staging[name] = landed[0]
            done(rows=n)
        products = {k: staging[k] for k in inputs.products}
        tr.step("staging")

        begin("DQ", "REJECT")                            # only keys not stored yet
        known = store.read("reject", SC.REJECT)
        before = 0 if known is None else known.count()   # footers
        n = store.append_synced("reject", new_rejects(find_rejects(products, inputs.countries, ctx), known))
        rejects = store.read("reject", SC.REJECT)
        done(rows=before + n, inserted=n)
        tr.step("reject")

        begin("HUB", "HUB")
        hub_new = M.hub_full(products.values(), [staging[k] for k in inputs.identifiers], [staging[k] for k in inputs.relationships],
                             rejects, store.read("hub", SC.HUB), ctx)
        n = store.append("hub", hub_new)
        done(affected=n, inserted=n)
        tr.step("hub")

        # SAT_HIST and SAT per satellite: the history compares the satellite before this run, so it is written first
        for name, (spec, model) in inputs.satellite_sources.items():
            # of the satellite only the keys that come in: they are picked before the newest version of each is
            versions = store.rows(name, versioned(SC.satellite(spec)))
            before = None if versions is None else current_rows(staging[model], versions)
            sat_rejects = rejects if spec.origin == "PRODUCT" else None   # only products drop rejects, also in the history
            clean = staging[model] if sat_rejects is None else exclude_rejects(staging[model], sat_rejects, ("dataset_product_id",))
            begin("HIST", f"{name.upper()}_HIST")
            expired = M.expire_versions(before, staging[model], store.rows(f"{name}_hist", stored_history(spec)), spec, ctx, sat_rejects, HISTORY_DIGITS)
            n = store.append(f"{name}_hist", with_prefix(expired, HISTORY_DIGITS).repartition(PREFIX), partition_by=(PREFIX,))
            done(affected=n, inserted=n)
            begin("SAT", name.upper())
            rows = materialize(M.new_or_changed(M.sat_rows(clean, spec, ctx), before).select(*sat_columns(spec)), "sat-rows")
            done(affected=store.add_versions(name, rows))
            begin("DM", f"DM_{name.upper()}")
            # The batch's active rows are those just written, plus earlier ones of the same batch on a rerun.
            mart = rows
            if before is not None and not versions.where(F.col("etl_batch_id") == ctx.batch_id).isEmpty():
                earlier = store.current(name, SC.satellite(spec)).where(F.col("etl_batch_id") == ctx.batch_id)
                mart = mart.unionByName(earlier.join(rows.select("hashkey"), "hashkey", "left_anti").select(*mart.columns))
            done(rows=store.replace(f"dm_{name}", M.mart(mart, spec, ctx.batch_id)))
        tr.step("history, satellites, marts")

        # staging snapshots: one partition per batch; a rerun of the batch replaces only that partition
        for model in inputs.snapshot_models:
            begin("HIST", f"{model}_SNAPSHOT")
            done(affected=write_snapshot(store, f"snapshot_{model.lower()}", products[model], rejects, ctx))
        tr.step("snapshots")
    except Exception as e:
        layer, model = running[0] if running else ("RUN", "RUN")
        results.append((len(results) + 1, layer, model, "error", f"{type(e).__name__}: {e}"[:2000], None, 0, 0, 0, 0))
        ran = {r[2] for r in results}
        results.extend((len(results) + k, layer, model, "skipped", None, 0, 0, 0, 0, 0)
                       for k, (layer, model) in enumerate((p for p in planned if p[1] not in ran), 1))
        close()
        raise
    close()
    tr.step("audit")
    return {r[2]: (r[5] if r[5] is not None else r[6]) for r in results}


def write_snapshot(store: VaultStore, table: str, staging: DataFrame, rejects: DataFrame | None, ctx: LoadContext) -> int:
    """Replace the partitions of the batches in ``staging`` by its accepted rows, merged with what the table
    holds of them; files of other batches are not touched. Returns the rows written."""
    # Read in the shape that comes in: new columns are NULL in older files, vanished ones are left out.
    shape = T.StructType([T.StructField("captured_at", T.TimestampNTZType()), *staging.schema.fields])
    found = store.rows(table, shape)
    if found is not None:
        found = found.join(staging.select("etl_batch_id").distinct(), "etl_batch_id", "left_semi")   # prunes partitions at run time
    rows = M.snapshot(staging, rejects, found, ctx)
    n = store.replace_partitions(table, rows, ("etl_batch_id",))
    store.note_shape(table, rows)
    return n


def read_snapshot(store: VaultStore, table: str, batch_id: str | None = None) -> DataFrame | None:
    """The snapshot table, or one batch of it: the filter on the partition column leaves only its files."""
    return store.read(table) if batch_id is None else store.read_batch(table, batch_id)
