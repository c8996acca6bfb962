"""What a delta of large tables costs: each side of the classification is shuffled once, with the fields in use only."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vaultkit.operators import delta as D
from vaultkit.plans.registry import QUERIES
from vaultkit.spec import IDENTIFIER, LoadContext

CTX = LoadContext(batch_id="W1", run_ts=dt.datetime(2025, 4, 1), record_source="CRM", use_watermark=False)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def nothing_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["relationship_delta", "relationship_delta_optional_parent", "identifier_delta"])
def test_entity_delta_joins_once_on_hashkey(spark, tables, nothing_broadcast, name):
    p = plan(QUERIES[name](spark, tables.base))
    assert p.count("FullOuter") == 1
    assert p.count("Exchange hashpartitioning(hashkey") == 2          # staging and satellite
    join = p.index("FullOuter")
    staging = p[join:p.index("Exchange hashpartitioning(hashkey", join)]
    assert "WindowGroupLimit" in staging and "LeftAnti" not in staging


@pytest.mark.parametrize("name", ["relationship_delta", "relationship_delta_optional_parent"])
def test_no_staging_row_is_shuffled_to_look_up_few_rejects(spark, tables, name):
    p = plan(QUERIES[name](spark, tables.base))
    assert p.count("LeftAnti") == 2 and "Exchange hashpartitioning(upper" not in p


def test_classification_carries_only_fields_in_use(spark):
    rows = "hashkey string, hashdiff string, end_datetime timestamp_ntz, unread string"
    side = spark.createDataFrame([("k", "d", None, "x")], rows)
    p = D.classify(side, side).select("hashkey", "action")._jdf.queryExecution().optimizedPlan().toString()
    assert "unread" not in p.split("LogicalRDD")[0] and "struct(" not in p


def test_repeated_satellite_keys_pair_with_all_their_actions(spark):
    cols = ["hashkey", "hashdiff", "record_source", "source_lastmodifieddate", *IDENTIFIER.columns]
    staging = spark.createDataFrame([("a", "1"), ("n", "5")], "hashkey string, hashdiff string").select(
        "hashkey", "hashdiff", *[F.lit(None).cast("date" if c in IDENTIFIER.date_cols else "string").alias(c) for c in cols[2:]])
    sat = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3"), ("b", "3")], "hashkey string, hashdiff string").select(
        "hashkey", "hashdiff", *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("start_datetime", "load_datetime", "end_datetime", "updated_datetime")],
        F.lit("B").alias("etl_batch_id"), F.lit("CRM").alias("record_source"),
        *[F.lit(None).cast("date" if c in IDENTIFIER.date_cols else "string").alias(c) for c in IDENTIFIER.columns])
    plain = D.classify(staging, sat)
    want = D.next_satellite(plain, None, IDENTIFIER, CTX).join(plain.select("hashkey", "action"), "hashkey")
    got = D.next_satellite(D.classify(staging, D.with_known(sat)), None, IDENTIFIER, CTX, keep={D.ACTION: D.key_actions()})
    got = got.withColumn(D.ACTION, F.explode(D.ACTION))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 4 + 4 + 1
