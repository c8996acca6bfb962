"""A key holding a third of all rows: results stay whole and the hot key is reduced map-side."""

import datetime as dt

from pyspark.sql import functions as F

from vaultkit.operators.delta import classify, dq_passed
from vaultkit.operators.dedupe import lookup_parent
from vaultkit.sources import testbed as tb
from vaultkit.spec import PRODUCT, LoadContext

CTX = LoadContext(batch_id="K1", run_ts=dt.datetime(2025, 4, 1), record_source="CRM", use_watermark=False)


def test_hot_hashkey_in_staging(spark, tables):
    stg = tb.staging_day2(tables)
    n = stg.count()
    hot = stg.where("dataset_product_id = '1'").limit(1)
    # copies of one product (same hashkey) make up a third of the input, with varying load times
    copies = hot.select(*hot.columns, F.explode(F.sequence(F.lit(1), F.lit(n // 2))).alias("copy_no")).drop("copy_no")
    skewed = stg.unionByName(copies.withColumn("load_datetime", F.col("load_datetime") - F.expr("INTERVAL 1 DAY")))
    dq = dq_passed(skewed, None, None, PRODUCT, CTX)
    plan = dq._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert dq.count() == dq.select("hashkey").distinct().count() == stg.where(
        "geographic_id <> '' AND product_name <> ''").select("hashkey").distinct().count()
    c = classify(dq, tb.satellite_day1(tables))
    assert c.count() == c.select("hashkey").distinct().count()


def test_hot_parent_lookup_keeps_every_child(spark):
    rows = [(f"c{i}", "P0") for i in range(3000)] + [(f"d{i}", f"P{i % 50}") for i in range(6000)]
    child = spark.createDataFrame(rows, "id string, parent string")
    parents = spark.createDataFrame([(f"P{i}", f"name{i}") for i in range(50)], "pid string, name string")
    out = lookup_parent(child, parents, "parent", "pid", ["name"])
    assert out.count() == len(rows)
    assert out.where("parent = 'P0' AND parent_name = 'name0'").count() == 3000 + 120
