"""Small operators on hand-written frames."""

import datetime as dt

from pyspark.sql import functions as F

from vaultkit.operators.conform import conform, resolve_column, standard_hash_names, sync_columns
from vaultkit.operators.labels import label_rows
from vaultkit.operators.merge import merge
from vaultkit import functions as VF


def test_resolve_and_rename_legacy_hash_names(spark):
    df = spark.createDataFrame([("k", "d")], "IDENTIFIER_MD5 string, RECORD_MD5 string")
    assert resolve_column(df, ["hashkey", "identifier_md5"]) == "IDENTIFIER_MD5"
    assert standard_hash_names(df).columns == ["hashkey", "hashdiff"]


def test_conform_typed_nulls(spark):
    df = spark.createDataFrame([("a",)], "x string")
    out = conform(df, ["x", "y", "d"], date_cols=["d"], constants={"y": "c"})
    assert dict(out.dtypes) == {"x": "string", "y": "string", "d": "date"}
    assert out.first().asDict() == {"x": "a", "y": "c", "d": None}


def test_sync_columns(spark):
    old = spark.createDataFrame([(1, "gone")], "a int, legacy string")
    new = spark.createDataFrame([(2, "b")], "a int, added string")
    assert sync_columns(old, new).collect()[0].asDict() == {"a": 1, "added": None}


def test_merge_update_insert_conditions(spark):
    t = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    s = spark.createDataFrame([(2, 5), (3, 30), (4, None)], "k int, v int")
    out = merge(t, s, ["k"], update={"v": F.col("s.v")}, matched_when=F.col("s.v") > F.col("t.v"),
                insert_when=F.col("s.v").isNotNull())
    assert sorted(tuple(r) for r in out.collect()) == [(1, 10), (2, 20), (3, 30)]


def test_label_null_predicate_gives_no_label(spark):
    df = spark.createDataFrame([(1, None), (2, "A")], "id int, m string")
    out = label_rows(df, [("IS_A", F.col("m") == "A"), ("NOT_A", ~F.col("m").isin("A"))], "label")
    assert sorted(tuple(r) for r in out.collect()) == [(2, "A", "IS_A")]


def test_text_rules(spark):
    df = spark.createDataFrame([("..  a\tb  ",), ("x",), ("",), (None,), ("It's  two words",)], "s string")
    rows = df.select(VF.clean_name("s").alias("n"), VF.market_name("s").alias("w"), VF.last_token("s").alias("t"),
                     VF.without_last_token("s").alias("h"), VF.drop_last_chars("s", 3).alias("c")).collect()
    assert rows[0]["n"] == "A\tB" and rows[0]["w"] == ".. A B"
    assert rows[1]["t"] is None and rows[1]["h"] == "x" and rows[1]["c"] == ""
    assert rows[2]["h"] is None and rows[3]["n"] is None
    assert rows[4]["t"] == "words" and rows[4]["h"] == "It's  two" and rows[4]["w"] == "ITS TWO WORDS"


def test_try_date_and_seconds(spark):
    df = spark.createDataFrame([("2024-13-01",), ("",), (" 2024-02-03 ",)], "s string")
    assert [r[0] for r in df.select(VF.try_date("s")).collect()] == [None, None, dt.date(2024, 2, 3)]
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 900000), dt.datetime(2024, 1, 1, 0, 0, 9, 100000))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert ts.select(VF.seconds_between("a", "b")).first()[0] == 2   # second boundaries crossed


def test_reject_image_as_variant(spark, tables):
    from vaultkit.operators.quality import find_rejects
    from vaultkit.sources import testbed as tb
    stg = {tb.STAGING_MODEL: tb.staging_day2(tables)}
    js = find_rejects(stg, tb.countries(tables), tb.ctx())
    va = find_rejects(stg, tb.countries(tables), tb.ctx(), as_variant=True)
    assert dict(va.dtypes)["rejected_record"] == "variant"
    a = {r["reject_key"]: r["rejected_record"] for r in js.collect()}
    b = {r["reject_key"]: r["j"] for r in va.select("reject_key", F.to_json("rejected_record").alias("j")).collect()}
    assert a == b


def test_delta_edges(spark):
    from vaultkit.operators import delta as D
    from vaultkit.spec import IDENTIFIER, LoadContext
    cols = ", ".join(f"{c} {'date' if c in IDENTIFIER.date_cols else 'string'}" for c in IDENTIFIER.columns)
    sat_schema = ("hashkey string, hashdiff string, start_datetime timestamp_ntz, load_datetime timestamp_ntz, "
                  "end_datetime timestamp_ntz, updated_datetime timestamp_ntz, etl_batch_id string, record_source string, " + cols)
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)
    biz = (None,) * len(IDENTIFIER.columns)
    sat = spark.createDataFrame([
        ("k1", "d1", t0, t0, None, t0, "B0", "S") + biz,      # absent from staging
        ("k2", "d2", t0, t0, None, t0, "B0", "S") + biz,      # unchanged
        ("k3", "d3", t0, t0, t1, t0, "B0", "S") + biz,        # expired row, passes through
    ], sat_schema)
    stg_schema = cols + ", source_lastmodifieddate timestamp_ntz, hashkey string, hashdiff string, load_datetime timestamp_ntz, etl_batch_id string, record_source string"
    stg = spark.createDataFrame([biz + (t1, "k2", "d2", t1, "B1", None), biz + (t1, "k4", "d4", t1, "B1", "X" * 300)], stg_schema)
    ctx = LoadContext(batch_id="B1", run_ts=dt.datetime(2025, 1, 1), record_source="R" * 10, record_source_max_len=5)
    c = D.classify(stg, sat)
    acts = {r["hashkey"]: r["action"] for r in c.collect()}
    assert acts == {"k1": "ABSENT", "k2": "UNCHANGED", "k4": "NEW"}
    nxt = {r["hashkey"]: r for r in D.next_satellite(c, sat, IDENTIFIER, ctx).collect()}
    assert set(nxt) == {"k1", "k2", "k3", "k4"}
    assert nxt["k1"]["updated_datetime"] == t0 and nxt["k3"]["end_datetime"] == t1
    assert nxt["k2"]["updated_datetime"] == dt.datetime(2025, 1, 1) and nxt["k2"]["etl_batch_id"] == "B0"
    assert nxt["k4"]["record_source"] == "XXXXX" and nxt["k4"]["etl_batch_id"] == "B1"


def test_watermark_bound_is_inclusive(spark):
    from vaultkit.operators.delta import since_watermark
    from vaultkit.spec import LoadContext
    wm = spark.createDataFrame([("S", "O", "TS", dt.datetime(2024, 1, 1, 0, 5), None, "B")],
                               "source_system string, source_object string, watermark_column string, "
                               "watermark_value timestamp_ntz, updated_at timestamp_ntz, etl_batch_id string")
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0),), (dt.datetime(2023, 12, 31, 23, 59, 59),), (None,)], "ts timestamp_ntz")
    ctx = LoadContext(batch_id="B", run_ts=dt.datetime(2024, 2, 1), record_source="S", source_object="O", watermark_column="ts")
    assert [r[0] for r in since_watermark(df, wm, ctx).collect()] == [dt.datetime(2024, 1, 1, 0, 0)]


def test_new_or_changed(spark):
    from vaultkit.operators.models import new_or_changed
    cur = spark.createDataFrame([("k1", "a"), ("k2", "b")], "hashkey string, hashdiff string")
    inc = spark.createDataFrame([("k1", "a"), ("k2", "x"), ("k3", "c")], "hashkey string, hashdiff string")
    assert sorted(tuple(r) for r in new_or_changed(inc, cur).collect()) == [("k2", "x"), ("k3", "c")]
