"""Load audit: process log, batch control, efficiency report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultkit.functions.audit_names import layer_name, model_name, standard_layer, standard_model
from vaultkit.functions.dates import seconds_between
from vaultkit.operators.merge import merge, merge_single
from vaultkit.spec import BATCH_CONTROL_COLUMNS, PROCESS_LOG_COLUMNS, LoadContext

RUNNING = "RUNNING"
SUCCESS = "SUCCESS"
FAILED = "FAILED"

# Layers whose processed-row figure is the row count of the model's table.
ROWCOUNT_LAYERS = ("STAGE", "DM", "DQ")


def _null_ts():
    return F.lit(None).cast("timestamp_ntz")


def now() -> dt.datetime:
    """Wall clock (UTC), for runners; registered queries keep the run time of their context."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _at(ctx: LoadContext, at: dt.datetime | None) -> Column:
    return ctx.ts() if at is None else F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def _log_row(ctx: LoadContext, layer: str, model: str, source_system: str, at: dt.datetime | None = None) -> dict:
    """One RUNNING log row as literal columns (no data read, no job); names are standardised."""
    return {
        "etl_batch_id": ctx.batch(),
        "layer_name": F.lit(layer_name(layer)),
        "model_name": F.lit(model_name(model)),
        "source_system": F.lit(source_system),
        "process_status": F.lit(RUNNING),
        "start_timestamp": _at(ctx, at),
        "end_timestamp": _null_ts(),
        "rows_processed": F.lit(0).cast("long"),
        "error_message": F.lit(""),
        "delta_inserted_rows": F.lit(0).cast("long"),
        "delta_updated_rows": F.lit(0).cast("long"),
    }


def process_start_all(log: DataFrame, ctx: LoadContext, planned: Sequence[tuple[str, str]], source_system: str,
                      at: dt.datetime | None = None) -> DataFrame:
    """Upsert a RUNNING row for every planned (layer, model) of a batch in one MERGE; a rerun keeps first
    start times and zeroes metrics. A model planned twice counts once, with its last layer.

    The rows are a local relation, whatever their number: the plan stays one join."""
    rows = {model_name(m): (layer_name(layer), model_name(m)) for layer, m in planned}
    src = log.sparkSession.createDataFrame(list(rows.values()), "layer_name string, model_name string")
    one = _log_row(ctx, "", "", source_system, at)
    src = src.select(*[F.col(c) if c in ("layer_name", "model_name") else one[c].alias(c) for c in PROCESS_LOG_COLUMNS])
    s = lambda c: F.col(f"s.{c}")
    upd = {c: s(c) for c in ("layer_name", "source_system", "process_status", "rows_processed", "error_message",
                             "delta_inserted_rows", "delta_updated_rows", "end_timestamp")}
    upd["start_timestamp"] = F.coalesce(F.col("t.start_timestamp"), s("start_timestamp"))
    return merge(log, src, ["etl_batch_id", "model_name"], update=upd)


def process_start(log: DataFrame, ctx: LoadContext, layer: str, model: str, source_system: str,
                  at: dt.datetime | None = None) -> DataFrame:
    """``process_start_all`` of one model."""
    return process_start_all(log, ctx, [(layer, model)], source_system, at)


def process_success(log: DataFrame, metrics: DataFrame | Mapping[str, int], ctx: LoadContext, model: str, at: dt.datetime | None = None) -> DataFrame:
    """Close the RUNNING row of (batch, model) with SUCCESS, end time ``at`` and the delta metrics.

    ``metrics`` is the one-row frame of ``delta_metrics``, or its values as a load has observed them.
    """
    names = ("delta_inserted_rows", "delta_updated_rows", "rows_processed")
    who = {"etl_batch_id": ctx.batch(), "model_name": F.lit(model_name(model))}
    if isinstance(metrics, Mapping):
        src = who | {c: F.lit(metrics[c]).cast("long") for c in names}
    else:
        src = metrics.select(*[v.alias(c) for c, v in who.items()], *names)
    return merge_single(log, src, ["etl_batch_id", "model_name"], update={
        "process_status": lambda t, s: F.lit(SUCCESS),
        "end_timestamp": lambda t, s: _at(ctx, at),
        "rows_processed": lambda t, s: s("rows_processed"),
        "error_message": lambda t, s: F.lit(""),
        "delta_inserted_rows": lambda t, s: s("delta_inserted_rows"),
        "delta_updated_rows": lambda t, s: s("delta_updated_rows"),
    }, matched_when=lambda t, s: t("process_status") == RUNNING, insert=False)


def process_failed(log: DataFrame, ctx: LoadContext, model: str, message: str, at: dt.datetime | None = None) -> DataFrame:
    """Close every RUNNING row of (batch, model) with FAILED, end time ``at`` and the error message."""
    return model_end(log, ctx, model, FAILED, at, message)


def model_start(log: DataFrame, ctx: LoadContext, layer: str, model: str, source_system: str,
                at: dt.datetime | None = None) -> DataFrame:
    """Append a RUNNING row for a model run."""
    row = _log_row(ctx, layer, model, source_system, at)
    return log.unionByName(log.sparkSession.range(1).select(*[row[c].alias(c) for c in PROCESS_LOG_COLUMNS]))


def model_end(log: DataFrame, ctx: LoadContext, model: str, status: str = SUCCESS, at: dt.datetime | None = None,
              message: str = "") -> DataFrame:
    """Close every RUNNING row of (batch, model) with ``status``."""
    hit = (F.col("etl_batch_id") == ctx.batch_id) & (F.col("model_name") == model_name(model)) & (F.col("process_status") == RUNNING)
    return log.withColumns({
        "process_status": F.when(hit, F.lit(status)).otherwise(F.col("process_status")),
        "end_timestamp": F.when(hit, _at(ctx, at)).otherwise(F.col("end_timestamp")),
        "rows_processed": F.when(hit, F.coalesce(F.col("rows_processed"), F.lit(0).cast("long"))).otherwise(F.col("rows_processed")),
        "error_message": F.when(hit, F.lit(message)).otherwise(F.col("error_message")),
    }).select(*PROCESS_LOG_COLUMNS)


def batch_start(control: DataFrame, ctx: LoadContext, pipeline: str, at: dt.datetime | None = None) -> DataFrame:
    """Upsert the batch row: RUNNING, first start kept, end and error cleared."""
    src = {
        "etl_batch_id": ctx.batch(),
        "pipeline_name": F.lit(pipeline.strip().upper()),
        "total_rejected_records": F.lit(0).cast("long"),
        "start_timestamp": _at(ctx, at),
        "end_timestamp": _null_ts(),
        "process_status": F.lit(RUNNING),
        "error_message": F.lit(""),
    }
    return merge_single(control, src, ["etl_batch_id"], update={
        "pipeline_name": lambda t, s: s("pipeline_name"),
        "start_timestamp": lambda t, s: F.coalesce(t("start_timestamp"), s("start_timestamp")),
        "end_timestamp": lambda t, s: _null_ts(),
        "process_status": lambda t, s: F.lit(RUNNING),
        "error_message": lambda t, s: F.lit(""),
    })


def run_results(results: DataFrame) -> DataFrame:
    """Normalise model results: rows_processed is the row count for STAGE/DM/DQ models, else the
    affected rows (inserted + updated + deleted when the adapter gives no total)."""
    affected = F.coalesce(
        F.col("rows_affected"),
        F.coalesce(F.col("rows_inserted"), F.lit(0)) + F.coalesce(F.col("rows_updated"), F.lit(0))
        + F.coalesce(F.col("rows_deleted"), F.lit(0)),
    )
    return results.withColumn(
        "rows_processed",
        F.when(standard_layer("layer_name").isin(*ROWCOUNT_LAYERS), F.coalesce(F.col("row_count"), F.lit(0))).otherwise(affected).cast("long"),
    )


def process_end(log: DataFrame, results: DataFrame, ctx: LoadContext, source_system: str, at: dt.datetime | None = None) -> DataFrame:
    """Upsert one row per model result (status, rows, metrics, error, standard names) into the process log."""
    r = run_results(results)
    src = r.select(
        ctx.batch().alias("etl_batch_id"),
        standard_layer("layer_name").alias("layer_name"), standard_model("model_name").alias("model_name"),
        F.lit(source_system).alias("source_system"),
        F.upper(F.coalesce(F.col("status"), F.lit("unknown"))).alias("process_status"),
        _at(ctx, at).alias("start_timestamp"), _at(ctx, at).alias("end_timestamp"),
        F.col("rows_processed"),
        F.when(F.lower(F.col("status")).isin("error", "fail"), F.coalesce(F.col("message"), F.lit(""))).otherwise(F.lit("")).alias("error_message"),
        F.coalesce(F.col("rows_inserted"), F.lit(0)).cast("long").alias("delta_inserted_rows"),
        F.coalesce(F.col("rows_updated"), F.lit(0)).cast("long").alias("delta_updated_rows"),
    )
    s = lambda c: F.col(f"s.{c}")
    upd = {c: s(c) for c in PROCESS_LOG_COLUMNS if c not in ("etl_batch_id", "model_name")}
    upd["start_timestamp"] = F.coalesce(F.col("t.start_timestamp"), s("start_timestamp"))
    return merge(log, src, ["etl_batch_id", "model_name"], update=upd)


def batch_end(control: DataFrame, results: DataFrame, ctx: LoadContext, at: dt.datetime | None = None) -> DataFrame:
    """Close the batch row: FAILED with the first error if any model failed, else SUCCESS;
    total rejected = processed rows of the REJECT model."""
    r = run_results(results).withColumn("__failed", F.lower(F.col("status")).isin("error", "fail"))
    summary = r.agg(
        F.max(F.col("__failed").cast("int")).alias("any_failed"),
        F.min_by(F.coalesce(F.col("message"), F.lit("Run failed")), F.when(F.col("__failed"), F.col("seq"))).alias("first_error"),
        F.coalesce(F.max(F.when(standard_model("model_name") == "REJECT", F.col("rows_processed"))), F.lit(0)).cast("long").alias("rejected"),
    ).select(
        ctx.batch().alias("etl_batch_id"),
        F.when(F.col("any_failed") == 1, F.lit(FAILED)).otherwise(F.lit(SUCCESS)).alias("process_status"),
        F.when(F.col("any_failed") == 1, F.coalesce(F.col("first_error"), F.lit("Run failed"))).otherwise(F.lit("")).alias("error_message"),
        F.col("rejected"),
    )
    return merge_single(control, summary, ["etl_batch_id"], update={
        "process_status": lambda t, s: s("process_status"),
        "total_rejected_records": lambda t, s: s("rejected"),
        "end_timestamp": lambda t, s: _at(ctx, at),
        "error_message": lambda t, s: s("error_message"),
    }, insert=False).select(*BATCH_CONTROL_COLUMNS)


def load_efficiency(log: DataFrame, model_name: str | None = None) -> DataFrame:
    """Runtime, rows and rows/second per process-log row, newest first."""
    rows = log if model_name is None else log.where(F.col("model_name") == model_name)
    runtime = seconds_between("start_timestamp", "end_timestamp")
    return rows.select(
        "model_name", "start_timestamp", "end_timestamp",
        runtime.alias("runtime_seconds"),
        "rows_processed", "delta_inserted_rows", "delta_updated_rows",
        F.when(runtime > 0, F.col("rows_processed") / runtime).alias("rows_per_second"),
    ).orderBy(F.col("start_timestamp").desc())
