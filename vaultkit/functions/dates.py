"""Date and timestamp expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultkit.spec import WATERMARK_FLOOR


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_ts() -> Column:
    return F.lit(WATERMARK_FLOOR).cast("timestamp_ntz")


def try_date(c: str | Column) -> Column:
    """Text to DATE; malformed or empty text gives NULL instead of an error."""
    return F.try_to_date(F.trim(_c(c)))


def latest_of(cols: Iterable[str | Column]) -> Column:
    """Greatest of the timestamps, each missing one read as 1900-01-01."""
    return F.greatest(*[F.coalesce(_c(c).cast("timestamp_ntz"), floor_ts()) for c in cols])


def minutes_before(c: str | Column, minutes: int) -> Column:
    return _c(c) - F.expr(f"INTERVAL {int(minutes)} MINUTES")


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Second boundaries crossed from ``start`` to ``end`` (datediff('second', ...) semantics:
    fractions are cut off before subtracting); independent of the session time zone."""
    return F.timestamp_diff("SECOND", F.date_trunc("second", _c(start)), F.date_trunc("second", _c(end)))
