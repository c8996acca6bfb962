"""MERGE as a rewrite: one full outer join of target and source gives the next table version."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IN_T = "__in_target"
IN_S = "__in_source"


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str],
          update: Mapping[str, Column] | None = None, matched_when: Column | None = None,
          insert: bool = True, insert_when: Column | None = None,
          insert_values: Mapping[str, Column] | None = None) -> DataFrame:
    """Next version of ``target`` after ``MERGE INTO target t USING source s ON keys``.

    Expressions refer to the sides as ``F.col("t.x")`` and ``F.col("s.x")``.
      * ``update``: columns set WHEN MATCHED [AND ``matched_when``]; other columns keep t's value.
        ``None`` means no WHEN MATCHED clause.
      * ``insert``: WHEN NOT MATCHED [AND ``insert_when``] THEN INSERT; values default to the
        same-named source column (NULL if the source has none), overridable by ``insert_values``.
    The source must hold at most one row per key, as MERGE requires.
    """
    t = target.withColumn(IN_T, F.lit(True)).alias("t")
    s = source.withColumn(IN_S, F.lit(True)).alias("s")
    cond = None
    for k in keys:
        c = F.col(f"t.{k}") == F.col(f"s.{k}")
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    in_t = F.col(f"t.{IN_T}").isNotNull()
    in_s = F.col(f"s.{IN_S}").isNotNull()
    matched = in_t & in_s
    do_update = matched if matched_when is None else matched & F.coalesce(matched_when, F.lit(False))
    do_insert = (~in_t) & in_s
    if insert_when is not None:
        do_insert = do_insert & F.coalesce(insert_when, F.lit(False))
    src_cols = {c.lower() for c in source.columns}
    update = dict(update or {})
    insert_values = dict(insert_values or {})
    out = []
    for f in target.schema.fields:
        name = f.name
        tv = F.col(f"t.{name}")
        if name in insert_values:
            iv = insert_values[name]
        elif name.lower() in src_cols:
            iv = F.col(f"s.{name}")
        else:
            iv = F.lit(None)
        e = tv
        if update and name in update:
            e = F.when(do_update, update[name]).otherwise(e)
        if insert:
            e = F.when(do_insert, iv).otherwise(e)
        out.append(e.cast(f.dataType).alias(name))
    keep = in_t | do_insert if insert else in_t
    return j.where(keep).select(*out)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace target rows whose key is in ``source`` by the source row; insert the rest.

    Written as anti join + union: target rows without a source match pass untouched.
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def insert_new(target: DataFrame | None, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``candidates`` whose key is not in ``target`` (INSERT ... WHERE NOT EXISTS)."""
    if target is None:
        return candidates
    return candidates.join(target.select(*keys), list(keys), "left_anti")


Side = Callable[[str], Column]


def merge_single(target: DataFrame, source: DataFrame | Mapping[str, Column], keys: Sequence[str],
                 update: Mapping[str, Callable[[Side, Side], Column]] | None = None,
                 matched_when: Callable[[Side, Side], Column] | None = None,
                 insert: bool = True, insert_when: Callable[[Side], Column] | None = None) -> DataFrame:
    """MERGE of a source that holds exactly one row (a literal row or a global aggregate).

    No join: the single source row is bound once (one bounded row read to the driver, then typed
    literals), matching target rows are updated in a projection, and the insert is that row kept
    only when no target row matches. Expressions are callables over side accessors: ``t("x")`` is
    the target column, ``s("x")`` the source value. An empty source changes nothing. A source
    given as a mapping of literal columns needs no job at all.
    """
    if isinstance(source, Mapping):
        literals = dict(source)
    else:
        rows = source.limit(2).collect()
        if len(rows) > 1:
            raise ValueError("merge_single needs a source of at most one row")
        if not rows:
            return target
        values = rows[0].asDict()
        literals = {f.name: _literal(values[f.name], f.dataType) for f in source.schema.fields}

    def t(c: str) -> Column:
        return F.col(c)

    def s(c: str) -> Column:
        return literals[c]

    match = None
    for k in keys:
        c = t(k) == s(k)
        match = c if match is None else match & c
    match = F.coalesce(match, F.lit(False))
    do_update = match if matched_when is None else match & F.coalesce(matched_when(t, s), F.lit(False))
    update = dict(update or {})
    out = []
    for f in target.schema.fields:
        e = F.col(f.name)
        if f.name in update:
            e = F.when(do_update, update[f.name](t, s)).otherwise(e)
        out.append(e.cast(f.dataType).alias(f.name))
    updated = target.select(*out)
    if not insert:
        return updated
    keep = ~target.where(match).exists()
    if insert_when is not None:
        keep = keep & F.coalesce(insert_when(s), F.lit(False))   # literals only: folded by the optimizer
    src_cols = {c.lower(): c for c in literals}
    new = target.sparkSession.range(1).where(keep).select(*[
        (s(src_cols[f.name.lower()]) if f.name.lower() in src_cols else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema.fields
    ])
    return updated.unionByName(new)


def _literal(value, data_type) -> Column:
    """A typed literal of a collected value; wall-clock timestamps are bound from their text so the
    session time zone cannot shift them."""
    from pyspark.sql import types as T
    if value is not None and isinstance(data_type, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(data_type)
    return F.lit(value).cast(data_type)
