"""Text cleansing expressions used by the staging pipelines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_leading_dots(c: str | Column) -> Column:
    return F.regexp_replace(_c(c), r"^\.+", "")


def collapse_blanks(c: str | Column) -> Column:
    """Runs of blanks (0x20 only) become one blank."""
    return F.regexp_replace(_c(c), " +", " ")


def collapse_whitespace(c: str | Column) -> Column:
    """Runs of any ASCII white space (blank, tab, newline, VT, FF, CR) become one blank."""
    return F.regexp_replace(_c(c), r"\s+", " ")


def clean_name(c: str | Column) -> Column:
    """CRM name rule: trim, drop leading dots, collapse blanks, trim, upper-case."""
    return F.upper(F.trim(collapse_blanks(strip_leading_dots(F.trim(_c(c))))))


def market_name(c: str | Column) -> Column:
    """Market name rule: collapse white space, trim, drop apostrophes, upper-case."""
    return F.upper(F.replace(F.trim(collapse_whitespace(_c(c))), F.lit("'"), F.lit("")))


def drop_last_chars(c: str | Column, n: int = 3) -> Column:
    """All but the last ``n`` characters ('' when shorter)."""
    col = _c(c)
    return col.substr(F.lit(1), F.greatest(F.length(col) - F.lit(n), F.lit(0)))


def last_token(c: str | Column) -> Column:
    """Last white-space separated token of the trimmed text; NULL for empty or one-token text."""
    t = F.trim(_c(c))
    return (F.when(t.isNull() | (t == ""), F.lit(None).cast("string"))
            .when(F.locate(" ", t) == 0, F.lit(None).cast("string"))
            .otherwise(F.regexp_substr(t, F.lit(r"[^\s]+$"))))


def without_last_token(c: str | Column) -> Column:
    """Trimmed text minus its last token; the text itself when it has one token; NULL when empty."""
    t = F.trim(_c(c))
    tail = F.regexp_substr(t, F.lit(r"[^\s]+$"))
    head = F.trim(F.left(t, F.length(t) - F.length(tail) - F.lit(1)))
    return (F.when(t.isNull() | (t == ""), F.lit(None).cast("string"))
            .when(F.locate(" ", t) == 0, t)
            .otherwise(head))


def upper_trim(c: str | Column) -> Column:
    return F.upper(F.trim(_c(c)))
