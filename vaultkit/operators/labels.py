"""Single-pass multi-label classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_rows(df: DataFrame, rules: Sequence[tuple[str, Column]], label_col: str = "label",
               distinct: bool = True) -> DataFrame:
    """Emit each row once per label whose predicate is true, in one pass over ``df``.

    Same rows as ``UNION ALL`` of one ``SELECT DISTINCT *, label WHERE predicate`` per rule, but the
    input is scanned once: an array of matching labels is exploded. A NULL predicate gives no label.
    """
    candidates = F.array(*[F.when(pred, F.lit(label)) for label, pred in rules])
    matched = F.filter(candidates, lambda x: x.isNotNull())
    out = df.withColumn(label_col, F.explode(matched))
    return out.distinct() if distinct else out
