"""Top-1 per key, parent lookups, unions and grouped lists."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in cols]


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (plain names mean DESC NULLS LAST).

    Planned as a window top-1 with a partial group limit before the shuffle, so each map task
    sends at most one row per key: a key holding a large share of the rows costs no more than any other.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def lookup_parent(child: DataFrame, parents: DataFrame, parent_ref: str | Sequence[str], parent_id: str | Sequence[str],
                  cols: Sequence[str], prefix: str = "parent_",
                  latest_order: Sequence[str | Column] | None = None) -> DataFrame:
    """Left join each child row to its parent row (``child.parent_ref = parent.parent_id``).

    ``parent_ref`` / ``parent_id`` may be lists (composite keys, compared pairwise). With
    ``latest_order`` the parent side is first reduced to its latest row per id (no fan-out);
    without it every parent row with that id is joined (the raw self-join form).
    """
    refs = [parent_ref] if isinstance(parent_ref, str) else list(parent_ref)
    ids = [parent_id] if isinstance(parent_id, str) else list(parent_id)
    p = parents
    if latest_order is not None:
        p = latest_by(p, ids, latest_order)
    p = p.select(*[F.col(c).alias(f"__pid{i}") for i, c in enumerate(ids)], *[F.col(c).alias(prefix + c) for c in cols])
    cond = None
    for i, (r, _) in enumerate(zip(refs, ids)):
        c = child[r] == p[f"__pid{i}"]
        cond = c if cond is None else cond & c
    return child.join(p, cond, "left").drop(*[f"__pid{i}" for i in range(len(ids))])


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), list(frames))


def union_distinct(frames: Iterable[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def sorted_distinct_list(df: DataFrame, keys: Sequence[str], value: str | Column, sep: str = "|",
                         name: str = "value_list") -> DataFrame:
    """Per group, the distinct values sorted and joined with ``sep`` (partial aggregation map-side)."""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(v)), sep).alias(name))
