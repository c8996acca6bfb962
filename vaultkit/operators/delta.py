"""Delta (CDC) load core: DQ set, watermark, one classification join, and what derives from it.

The warehouse load runs five statements over the satellite (touch unchanged, build delta, count,
archive, merge). Here one full outer join of the DQ set and the active satellite on HASHKEY gives
every key an action — NEW, CHANGED, UNCHANGED or ABSENT — with both sides' rows attached; the
next satellite, history rows, hub rows and metrics are all projections of that one result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultkit.functions.dates import floor_ts, minutes_before
from vaultkit.functions.predicates import all_present
from vaultkit.operators.dedupe import latest_by
from vaultkit.operators.merge import IN_S, IN_T, merge_single
from vaultkit.operators.quality import exclude_rejects
from vaultkit.spec import HUB_COLUMNS, SAT_META, EntitySpec, LoadContext

NEW = "NEW"
CHANGED = "CHANGED"
UNCHANGED = "UNCHANGED"
ABSENT = "ABSENT"

SEQ = "__seq"              # running number of a satellite's row versions: the newest row of a key counts
PREFIX = "diff_prefix"     # leading digits of the hash diff, by which the history is partitioned

KNOWN = "__known"          # hashdiffs of a key's active satellite rows

ACTION = "action"
STG = "stg"
SAT = "sat"


# --- watermark ---------------------------------------------------------------------------------

def _watermark_rows(watermarks: DataFrame, ctx: LoadContext) -> DataFrame:
    return watermarks.where(
        (F.col("source_system") == ctx.system)
        & (F.col("source_object") == ctx.object_name)
        & (F.upper(F.col("watermark_column")) == ctx.watermark_name)
    )


def watermark_floor(watermarks: DataFrame | None, ctx: LoadContext) -> Column:
    """Scalar: stored high-water mark minus the lookback, or 1900-01-01 when none is stored."""
    if watermarks is None:
        return floor_ts()
    agg = _watermark_rows(watermarks, ctx).select(
        F.coalesce(minutes_before(F.max("watermark_value"), ctx.lookback_minutes), floor_ts())
    )
    return agg.scalar()


def since_watermark(df: DataFrame, watermarks: DataFrame | None, ctx: LoadContext, column: str | None = None) -> DataFrame:
    """Rows at or after the stored watermark minus the lookback; NULL timestamps drop out.

    The bound is a scalar subquery evaluated once; being a plain comparison it reaches the scan.
    """
    return df.where(F.col(column or ctx.watermark_column) >= watermark_floor(watermarks, ctx))


def advance_watermark(watermarks: DataFrame, dq: DataFrame | dt.datetime | None, ctx: LoadContext) -> DataFrame:
    """Next watermark table: max of the DQ set's watermark column; insert if absent, raise only.

    A NULL maximum (empty DQ set) changes nothing. ``dq`` may be that maximum, as a load has observed it.
    """
    row = {"source_system": F.lit(ctx.system), "source_object": F.lit(ctx.object_name), "watermark_column": F.lit(ctx.watermark_name),
           "updated_at": ctx.ts(), "etl_batch_id": ctx.batch()}
    if isinstance(dq, DataFrame):
        highest = F.max(F.col(ctx.watermark_column)).cast("timestamp_ntz").alias("watermark_value")
        src = dq.agg(highest).select("watermark_value", *[v.alias(c) for c, v in row.items()])
    else:
        src = row | {"watermark_value": F.lit(dq and dq.isoformat(sep=" ")).cast("timestamp_ntz")}
    return merge_single(
        watermarks, src, ["source_system", "source_object", "watermark_column"],
        update={"watermark_value": lambda t, s: s("watermark_value"), "updated_at": lambda t, s: s("updated_at"),
                "etl_batch_id": lambda t, s: s("etl_batch_id")},
        matched_when=lambda t, s: s("watermark_value").isNotNull()
        & (t("watermark_value").isNull() | (s("watermark_value") > t("watermark_value"))),
        insert_when=lambda s: s("watermark_value").isNotNull(),
    )


# --- DQ set ------------------------------------------------------------------------------------

def dq_passed(staging: DataFrame, rejects: DataFrame | None, watermarks: DataFrame | None,
              spec: EntitySpec, ctx: LoadContext) -> DataFrame:
    """Staging rows that pass required fields, the watermark and the reject set; one per hashkey.

    Ties per hashkey go to the latest load_datetime, then the highest hashdiff.

    Rejects go first: the top-1 per hashkey gets fewer rows, its partial limit collapses each key map-side,
    and its exchange is the one that a join on hashkey needs, however the anti joins are carried out.
    """
    out = staging.where(all_present(spec.required_cols))
    if ctx.use_watermark:
        out = since_watermark(out, watermarks, ctx)
    out = exclude_rejects(out, rejects, spec.reject_id_cols)
    if spec.dedupe:
        out = latest_by(out, ["hashkey"], ["load_datetime", "hashdiff"])
    return out


# --- classification ----------------------------------------------------------------------------

def active(satellite: DataFrame) -> DataFrame:
    return satellite.where(F.col("end_datetime").isNull())


def classify(dq: DataFrame, satellite: DataFrame) -> DataFrame:
    """Full outer join of the DQ set and the active satellite on hashkey.

    Output: ``hashkey``, ``action`` and structs ``stg`` (DQ row or NULL) and ``sat`` (active
    satellite row or NULL). Both inputs must hold one row per hashkey (``dq_passed`` ensures it
    for the DQ set, the satellite keeps one active row per key), so no key fans out.

    Which side a key is on is told by columns of their own: testing the structs would carry all their
    fields through the join, also those that a caller never reads.
    """
    s = dq.selectExpr("hashkey", f"struct(*) AS {STG}", f"true AS {IN_S}")
    t = active(satellite).selectExpr("hashkey", f"struct(*) AS {SAT}", f"true AS {IN_T}")
    j = s.join(t, "hashkey", "full_outer")
    action = (
        F.when(F.col(IN_T).isNull(), F.lit(NEW))
        .when(F.col(IN_S).isNull(), F.lit(ABSENT))
        .when(F.col(f"{STG}.hashdiff") == F.col(f"{SAT}.hashdiff"), F.lit(UNCHANGED))
        .otherwise(F.lit(CHANGED))
    )
    return j.select("hashkey", action.alias(ACTION), STG, SAT)


def with_known(satellite: DataFrame) -> DataFrame:
    """Active satellite rows with the hashdiffs of all active rows of their key (column ``KNOWN``).

    The window needs the deal and the order that the join on hashkey needs anyway.
    """
    return active(satellite).withColumn(KNOWN, F.collect_list("hashdiff").over(Window.partitionBy("hashkey")))


def key_actions() -> Column:
    """Actions of a classified key, one per active satellite row that it has; see ``with_known``."""
    new = F.array(F.lit(NEW))
    absent = F.transform(f"{SAT}.{KNOWN}", lambda d: F.lit(ABSENT))
    joined = F.transform(f"{SAT}.{KNOWN}", lambda d: F.when(d == F.col(f"{STG}.hashdiff"), UNCHANGED).otherwise(CHANGED))
    return F.when(F.col(ACTION) == NEW, new).when(F.col(ACTION) == ABSENT, absent).otherwise(joined)


def mark(dq: DataFrame, satellite: DataFrame | None, buckets: int | None = None) -> DataFrame:
    """The DQ set with ``action`` (NEW, CHANGED, UNCHANGED): what a load needs of the classification.

    Only (hashkey, hashdiff) of the satellite is read, and ABSENT keys are not produced. A satellite of
    row versions (column ``SEQ``) is joined as it is; the newest version is then chosen among the keys of
    the DQ set only. With ``buckets`` the DQ side is dealt into the satellite's buckets, so the satellite is
    joined where it lies, whatever the number of shuffle partitions; where both numbers are equal, the
    exchange of the top-1 per key in ``dq_passed`` is that deal, and Spark leaves a second one out.
    """
    s = dq.repartition(int(buckets), "hashkey") if buckets else dq
    if satellite is None:
        return s.withColumn(ACTION, F.lit(NEW))
    versions = SEQ in satellite.columns
    t = active(satellite).select("hashkey", F.col("hashdiff").alias("__known"), *([SEQ] if versions else []))
    s = s.join(t, "hashkey", "left")
    if versions:
        s = latest_by(s, ["hashkey"], [SEQ])
    action = F.when(F.col("__known").isNull(), NEW).when(F.col("__known") == F.col("hashdiff"), UNCHANGED).otherwise(CHANGED)
    return s.withColumn(ACTION, action).select(*dq.columns, ACTION)


def current_rows(keys: DataFrame, satellite: DataFrame) -> DataFrame:
    """Active satellite rows of the hashkeys in ``keys``; of row versions the newest."""
    rows = active(satellite).join(keys.select("hashkey"), "hashkey", "left_semi")
    return latest_by(rows, ["hashkey"], [SEQ]).drop(SEQ) if SEQ in satellite.columns else rows


def with_prefix(rows: DataFrame, digits: int) -> DataFrame:
    """Rows with the partition column of the history."""
    return rows.withColumn(PREFIX, F.substring("hashdiff", 1, digits))


def archived_already(history: DataFrame, rows: DataFrame, dedupe_on: tuple[str, ...], digits: int | None = None) -> DataFrame:
    """Versions of ``rows`` that the history holds.

    History only grows: it is reduced to the versions at hand, one row each. With ``digits`` the history is
    partitioned by that prefix of the hash diff, and the prefixes at hand prune its partitions at run time.
    """
    wanted = rows.select(*dedupe_on)
    if not digits:
        return history.select(*dedupe_on).join(wanted, list(dedupe_on), "left_semi").distinct()
    known = history.select(*dedupe_on, PREFIX).join(with_prefix(wanted, digits), [*dedupe_on, PREFIX], "left_semi")
    return known.select(*dedupe_on).distinct()


def archived(rows: DataFrame, history: DataFrame | None, ctx: LoadContext, dedupe_on: tuple[str, ...] = ("hashdiff",),
             digits: int | None = None) -> DataFrame:
    """``rows`` as history rows (END_DATETIME = run time, moved last), less versions archived already."""
    live = [c for c in rows.columns if c != "end_datetime"]
    out = rows.select(*live, ctx.ts().alias("end_datetime"))
    if history is not None:
        out = out.join(archived_already(history, out, dedupe_on, digits), list(dedupe_on), "left_anti")
    return out.select(*live, "end_datetime")


def stamped(marked: DataFrame, spec: EntitySpec, ctx: LoadContext) -> DataFrame:
    """NEW and CHANGED rows of a marked DQ set as satellite rows of this load."""
    values = {"start_datetime": ctx.ts(), "load_datetime": ctx.ts(), "updated_datetime": ctx.ts(),
              "end_datetime": F.lit(None).cast("timestamp_ntz"), "etl_batch_id": ctx.batch(),
              "record_source": _record_source(ctx, F.col("record_source"))}
    rows = marked.where(F.col(ACTION).isin(NEW, CHANGED))
    return rows.select(*[values[c].alias(c) if c in values else F.col(c) for c in sat_columns(spec)])


def delta_rows(classified: DataFrame) -> DataFrame:
    """DQ rows with no active satellite row of the same (hashkey, hashdiff): NEW and CHANGED."""
    return classified.where(F.col(ACTION).isin(NEW, CHANGED)).select(f"{STG}.*")


def new_hub_keys(classified: DataFrame, hub: DataFrame | None) -> DataFrame:
    """Delta hashkeys that the hub does not hold yet (unique: the classification has one row per key).

    The hub is semi-joined against the (usually small) delta keys first, so when the delta is small
    the hub is only streamed past a hash table of delta keys instead of being shuffled.
    """
    keys = classified.where(F.col(ACTION).isin(NEW, CHANGED)).select("hashkey")
    if hub is None:
        return keys
    known = hub.select("hashkey").join(keys, "hashkey", "left_semi")
    return keys.join(known, "hashkey", "left_anti")


def delta_metrics(classified: DataFrame, hub: DataFrame | None) -> DataFrame:
    """One row: inserted = delta keys not in the hub; updated = active keys whose hashdiff changes.

    A key that the hub holds but the satellite lacks counts as neither (and is still inserted into
    the satellite), as in the warehouse load.
    """
    inserted = new_hub_keys(classified, hub).agg(F.count(F.lit(1)).alias("n")).scalar()
    return classified.agg(F.count(F.when(F.col(ACTION) == CHANGED, 1)).cast("long").alias("delta_updated_rows")).select(
        inserted.cast("long").alias("delta_inserted_rows"),
        F.col("delta_updated_rows"),
        (inserted + F.col("delta_updated_rows")).cast("long").alias("rows_processed"),
    )


# --- outputs -----------------------------------------------------------------------------------

def _record_source(ctx: LoadContext, col: Column | None = None) -> Column:
    rs = F.lit(ctx.record_source) if col is None else F.coalesce(col, F.lit(ctx.record_source))
    return F.left(rs, F.lit(ctx.record_source_max_len))


def hub_rows(keys: DataFrame, spec: EntitySpec, ctx: LoadContext) -> DataFrame:
    return keys.select(
        F.col("hashkey"),
        ctx.ts().alias("start_datetime"),
        ctx.ts().alias("load_datetime"),
        _record_source(ctx).alias("record_source"),
        ctx.batch().alias("etl_batch_id"),
        F.lit(spec.origin).alias("origin_stg"),
    )


def hub_upsert(hub: DataFrame | None, classified: DataFrame, spec: EntitySpec, ctx: LoadContext) -> DataFrame:
    """Next hub: the old hub plus one row per new delta hashkey."""
    new = hub_rows(new_hub_keys(classified, hub), spec, ctx)
    return new if hub is None else hub.select(*HUB_COLUMNS).unionByName(new)


def sat_columns(spec: EntitySpec) -> list[str]:
    return list(SAT_META) + list(spec.columns)


def history_columns(spec: EntitySpec) -> list[str]:
    return [c for c in sat_columns(spec) if c != "end_datetime"] + ["end_datetime"]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(v: str) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ts_sql(ctx: LoadContext) -> str:
    return f"CAST({_lit(ctx.run_ts.strftime('%Y-%m-%d %H:%M:%S.%f'))} AS TIMESTAMP_NTZ)"


def touched(classified: DataFrame, spec: EntitySpec, ctx: LoadContext) -> DataFrame:
    """Active satellite after step 1 only: UNCHANGED rows get UPDATED_DATETIME = run time."""
    exprs = []
    for c in sat_columns(spec):
        v = f"{SAT}.{_q(c)}"
        if c == "updated_datetime":
            v = f"CASE WHEN {ACTION} = '{UNCHANGED}' THEN {_ts_sql(ctx)} ELSE {v} END"
        exprs.append(f"{v} AS {_q(c)}")
    return classified.where(F.col(SAT).isNotNull()).selectExpr(*exprs)


def history_rows(classified: DataFrame, history: DataFrame | None, spec: EntitySpec, ctx: LoadContext,
                 dedupe_on: tuple[str, ...] = ("hashdiff",)) -> DataFrame:
    """Active rows about to change, END_DATETIME = run time, unless their version is archived already.

    The column list is the live satellite's (its struct in ``classified``), END_DATETIME moved last,
    so a satellite that gained columns archives them too. By default a version counts as archived
    when its hashdiff is anywhere in the history.
    """
    live = [c for c in classified.schema[SAT].dataType.names if c != "end_datetime"]
    cols = [f"{SAT}.{_q(c)} AS {_q(c)}" for c in live]
    rows = classified.where(F.col(ACTION) == CHANGED).selectExpr(*cols, f"{_ts_sql(ctx)} AS end_datetime")
    if history is not None:
        rows = rows.join(archived_already(history, rows, dedupe_on), list(dedupe_on), "left_anti")
    return rows.select(*live, "end_datetime")


def next_history(classified: DataFrame, history: DataFrame | None, spec: EntitySpec, ctx: LoadContext,
                 dedupe_on: tuple[str, ...] = ("hashdiff",)) -> DataFrame:
    new = history_rows(classified, history, spec, ctx, dedupe_on)
    return new if history is None else history.unionByName(new, allowMissingColumns=True).select(*new.columns)


def next_satellite(classified: DataFrame, satellite: DataFrame | None, spec: EntitySpec, ctx: LoadContext,
                   keep: Mapping[str, Column] | None = None) -> DataFrame:
    """Satellite after touch + merge.

    NEW and CHANGED take the staging row with START/LOAD/UPDATED = run time and END = NULL;
    UNCHANGED keeps its row with UPDATED = run time; ABSENT passes untouched (no delete detection).
    Expired rows of the input satellite (END set) pass through as they are. ``keep`` adds columns of the
    classification.
    """
    take_stg = f"{ACTION} IN ('{NEW}', '{CHANGED}')"
    ts = _ts_sql(ctx)
    rs = f"left(coalesce({STG}.record_source, {_lit(ctx.record_source)}), {int(ctx.record_source_max_len)})"
    stg_values = {
        "hashdiff": f"{STG}.hashdiff",
        "start_datetime": ts,
        "load_datetime": ts,
        "end_datetime": "CAST(NULL AS TIMESTAMP_NTZ)",
        "updated_datetime": ts,
        "etl_batch_id": _lit(ctx.batch_id),
        "record_source": rs,
    }
    out = ["hashkey"]
    for c in sat_columns(spec):
        if c == "hashkey":
            continue
        from_stg = stg_values.get(c, f"{STG}.{_q(c)}")
        from_sat = f"{SAT}.{_q(c)}"
        if c == "updated_datetime":
            from_sat = f"CASE WHEN {ACTION} = '{UNCHANGED}' THEN {ts} ELSE {from_sat} END"
        out.append(f"CASE WHEN {take_stg} THEN {from_stg} ELSE {from_sat} END AS {_q(c)}")
    current = classified.select(*map(F.expr, out), *[v.alias(c) for c, v in (keep or {}).items()])
    if satellite is None:
        return current
    expired = satellite.where(F.col("end_datetime").isNotNull()).select(*sat_columns(spec))
    return current.unionByName(expired, allowMissingColumns=bool(keep))


def empty_satellite(dq: DataFrame, spec: EntitySpec) -> DataFrame:
    """A zero-row satellite whose types follow the staging frame (first load)."""
    types = dict(dq.dtypes)
    cols = []
    for c in sat_columns(spec):
        if c in ("start_datetime", "load_datetime", "end_datetime", "updated_datetime"):
            t = "timestamp_ntz"
        else:
            t = types.get(c, "string")
        cols.append(F.lit(None).cast(t).alias(c))
    return dq.limit(0).select(*cols)
