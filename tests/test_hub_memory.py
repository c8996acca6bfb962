"""What the hub build of large tables costs: no task sorts a share of a table that grows with it."""

from pyspark.sql import functions as F

from vaultkit.operators import models as M
from vaultkit.sources import testbed as tb
from vaultkit.sources.tables import Tables


def test_edges_are_dealt_into_parts_that_follow_the_table(spark, tables):
    lines = tables["lineitem"].repartition(3)
    t = Tables(spark, tables.base, {"lineitem": lines})
    assert tb.edges(t).rdd.getNumPartitions() == 3 * tb.PARTS_OF_SPLIT
    want = tables["lineitem"].groupBy("l_suppkey", "l_partkey").agg(F.max("l_shipdate"))
    assert sorted(map(tuple, tb.edges(t).collect())) == sorted(map(tuple, want.collect()))


def test_hub_sorts_keys_without_constant_columns(spark, tables):
    t = Tables(spark, tables.base)
    hub = M.hub_full(tb.sources(t).values(), [tb.identifiers(t)], [tb.relationships(t)], tb.rejects_day2(t), tb.hub_day1(t), tb.ctx())
    p = hub._jdf.queryExecution().optimizedPlan().toString()
    assert "start_datetime" not in p[p.index("WindowGroupLimit"):].split("Join LeftAnti")[0]
    assert {r[0] for r in hub.select("origin_stg").distinct().collect()} == {"PRODUCT", "IDENTIFIER", "RELATIONSHIP"}
