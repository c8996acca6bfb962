"""Hash key / hash diff columns: md5 over '||'-joined text, NULL read as ''."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "||"


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def hash_sql(cols: Iterable[str]) -> str:
    """SQL text of the hash over named columns."""
    parts = ", ".join(f"coalesce(cast({quote(c)} as string), '')" for c in cols)
    return f"md5(concat_ws('{SEPARATOR}', {parts}))"


def hash_of(cols: Iterable[str | Column]) -> Column:
    """``md5(concat_ws('||', coalesce(cast(c as string), ''), ...))``.

    Every ingredient is turned to text first; give doubles a fixed decimal type before hashing so
    their text does not depend on the engine's float printing. With column names only, the
    expression is passed as one SQL expression (one call into the JVM instead of four per column).
    """
    cols = list(cols)
    if all(isinstance(c, str) for c in cols):
        return F.expr(hash_sql(cols))
    parts = [F.coalesce(_as_col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def with_hashes(df: DataFrame, key_cols: Iterable[str], diff_cols: Iterable[str],
                key_name: str = "hashkey", diff_name: str = "hashdiff") -> DataFrame:
    """Add the hash key and hash diff columns of an entity."""
    return df.withColumns({key_name: hash_of(list(key_cols)), diff_name: hash_of(list(diff_cols))})
