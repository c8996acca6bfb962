"""Schema conformance: fixed column lists padded with typed NULLs, schema sync, name resolution."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultkit.functions.hashing import quote


def column_type(name: str, date_cols: Iterable[str] = (), types: Mapping[str, str] | None = None) -> str:
    if types and name in types:
        return types[name]
    return "date" if name in set(date_cols) else "string"


def conform(df: DataFrame, columns: Sequence[str], date_cols: Iterable[str] = (),
            constants: Mapping[str, object] | None = None, types: Mapping[str, str] | None = None,
            keep: Sequence[str] = ()) -> DataFrame:
    """Select ``columns`` in order; missing ones become typed NULLs, ``constants`` become literals.

    ``keep`` names extra columns carried after the conformed ones (e.g. metadata).
    """
    constants = dict(constants or {})
    present = {c.lower() for c in df.columns}
    exprs: list[str] = []
    for name in columns:
        t = column_type(name, date_cols, types)
        if name in constants:
            v = constants[name]
            lit = "NULL" if v is None else ("'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'")
            e = f"CAST({lit} AS {t})"
        elif name.lower() in present:
            e = f"CAST({quote(name)} AS {t})"
        else:
            e = f"CAST(NULL AS {t})"
        exprs.append(f"{e} AS {quote(name)}")
    return df.selectExpr(*exprs, *[quote(c) for c in keep])


def sync_columns(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Reshape ``target`` rows to ``incoming``'s schema: new columns NULL, vanished ones dropped."""
    have = {c.lower() for c in target.columns}
    exprs = [
        (F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in incoming.schema.fields
    ]
    return target.select(*exprs)


def append_synced(target: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """``target`` synced to ``incoming``'s schema, followed by ``incoming`` (append with schema sync)."""
    if target is None:
        return incoming
    return sync_columns(target, incoming).unionByName(incoming)


def resolve_column(df: DataFrame, candidates: Sequence[str], default: str | None = None) -> str:
    """First candidate present in ``df`` (case-insensitive), else ``default`` or the first candidate."""
    lower = {c.lower(): c for c in df.columns}
    for name in candidates:
        if name.lower() in lower:
            return lower[name.lower()]
    return default or candidates[0]


def standard_hash_names(df: DataFrame) -> DataFrame:
    """Rename legacy hash columns (IDENTIFIER_MD5, RECORD_MD5) to hashkey / hashdiff when needed."""
    key = resolve_column(df, ["hashkey", "identifier_md5"], "hashkey")
    diff = resolve_column(df, ["hashdiff", "record_md5"], "hashdiff")
    out = df
    if key.lower() != "hashkey" and key in df.columns:
        out = out.withColumnRenamed(key, "hashkey")
    if diff.lower() != "hashdiff" and diff in df.columns:
        out = out.withColumnRenamed(diff, "hashdiff")
    return out
