"""Row predicates shared by staging, data-quality and delta steps."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: str | Column) -> Column:
    """Not NULL and not blank after trimming (NULL input gives false, not NULL)."""
    col = _c(c)
    return col.isNotNull() & (F.trim(col) != "")


def blank(c: str | Column) -> Column:
    """NULL or blank after trimming."""
    return ~present(c)


def all_present(cols: Iterable[str | Column]) -> Column:
    return reduce(lambda a, b: a & b, [present(c) for c in cols], F.lit(True))


def not_placeholder(c: str | Column, placeholders: Iterable[str] = ("", "-")) -> Column:
    """Not NULL and, trimmed, none of the placeholder values."""
    col = _c(c)
    return col.isNotNull() & ~F.trim(col).isin(*placeholders)


def like_none(c: str | Column, patterns: Iterable[str]) -> Column:
    """``c NOT LIKE p1 AND c NOT LIKE p2 ...`` (SQL three-valued logic kept)."""
    col = _c(c)
    return reduce(lambda a, b: a & b, [~col.like(p) for p in patterns], F.lit(True))


def like_escaped(c: str | Column, pattern: str, escape: str = "!") -> Column:
    """LIKE with an explicit escape character, so ``'B!_%'`` matches a literal underscore."""
    # Column.like has no escape argument; F.like does.
    return F.like(_c(c), F.lit(pattern), F.lit(escape))


def is_empty_or_null(c: str | Column) -> Column:
    """``c = '' OR c IS NULL`` without trimming."""
    col = _c(c)
    return col.isNull() | (col == "")
