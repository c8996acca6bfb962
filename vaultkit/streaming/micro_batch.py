"""Delta load as a ``foreachBatch`` body.

The reference loads in batches with a stored high-water mark; a streaming source (new staging
files landing in a folder) maps onto that directly: each micro-batch is one load whose batch id
is derived from the epoch. An epoch that the log already shows as SUCCESS is skipped, so a replay
after a crash between the load and the stream's own commit changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultkit.functions.audit_names import model_name
from vaultkit.operators.audit import SUCCESS
from vaultkit.plans.load import run_delta_load
from vaultkit.plans.store import VaultStore
from vaultkit.sources import schemas as SC
from vaultkit.spec import EntitySpec, LoadContext


def delta_load_batches(store: VaultStore, spec: EntitySpec, context_for: Callable[[int], LoadContext],
                       prepare: Callable[[DataFrame], DataFrame] | None = None,
                       satellite_buckets: int | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: stage the micro-batch (``prepare``), then run one delta load."""
    def body(batch: DataFrame, epoch_id: int) -> None:
        ctx = context_for(epoch_id)
        log = store.read("process_log", SC.PROCESS_LOG)
        if log is not None and not log.where((F.col("etl_batch_id") == ctx.batch_id) & (F.col("model_name") == model_name(spec.name))
                                             & (F.col("process_status") == SUCCESS)).isEmpty():
            return
        run_delta_load(store, prepare(batch) if prepare is not None else batch, spec, ctx, satellite_buckets=satellite_buckets)
    return body


def epoch_context(prefix: str, record_source: str, source_object: str = "STG", **kw) -> Callable[[int], LoadContext]:
    """Batch id ``<prefix>-<epoch>``, run time = wall clock at the start of the micro-batch (UTC)."""
    def make(epoch_id: int) -> LoadContext:
        return LoadContext(batch_id=f"{prefix}-{epoch_id:06d}", run_ts=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
                           record_source=record_source, source_object=source_object, **kw)
    return make
