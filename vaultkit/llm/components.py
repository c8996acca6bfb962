"""Connected components by alternating large-star and small-star steps; every step is joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultkit.llm.common import land


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame) -> DataFrame:
    """(u, v) edges, any direction -> (id, root): the least id of the component of every id in an edge.

    The number of steps grows with the logarithm of the longest chain. Equal ends and repeated edges
    are harmless; an empty table gives no rows.
    """
    e = land(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    state = _state(e)
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        lm = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lm, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lm.select("u", F.col("m").alias("v")))
        e = land(small.where("u != v").distinct(), "cc-edges")
        new = _state(e)
        if new == state:
            break
        state = new
    return e.select(F.col("u").alias("id"), F.col("v").alias("root")).union(e.select(F.col("v").alias("id"), F.col("v").alias("root"))).distinct()
