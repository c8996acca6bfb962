"""The vault's tables as plain Spark tables: layouts, partitions that stay untouched, reruns."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultkit.plans.store import VaultStore, scratch_store


def _df(spark, ids, batch="B"):
    return spark.createDataFrame([(i, batch) for i in ids], "id int, etl_batch_id string")


def _keys(spark, keys, value="v"):
    return spark.createDataFrame([(k, value) for k in keys], "hashkey string, x string")


KEYED = T.StructType([T.StructField("hashkey", T.StringType()), T.StructField("x", T.StringType())])


def test_append_and_replace(spark):
    store = scratch_store(spark, "store")
    assert store.read("h") is None and not store.exists("h") and store.files("h") == []
    assert store.append("h", _df(spark, [1])) == 1
    assert store.append("h", _df(spark, [2, 3])) == 2            # rows written, observed by the write
    assert sorted(r.id for r in store.read("h").collect()) == [1, 2, 3]
    assert store.replace("h2", _df(spark, [9])) == 1 and store.replace("h2", _df(spark, [8])) == 1
    assert [r.id for r in store.read("h2").collect()] == [8]
    assert sorted(r.id for r in VaultStore(spark, store.base).read("h").collect()) == [1, 2, 3]


def test_a_partition_is_replaced_and_the_others_keep_their_files(spark):
    store = scratch_store(spark, "store")
    store.replace_partitions("s", _df(spark, [1, 2], "B1").union(_df(spark, [3], "B2")), ("etl_batch_id",))
    before = store.files("s")
    store.replace_partitions("s", _df(spark, [4, 5, 6], "B2"), ("etl_batch_id",))   # rerun of batch 2
    rows = sorted((r.etl_batch_id, r.id) for r in store.read("s").collect())
    assert rows == [("B1", 1), ("B1", 2), ("B2", 4), ("B2", 5), ("B2", 6)]
    kept = lambda files: [f for f in files if "etl_batch_id=B1" in f]
    assert kept(before) == kept(store.files("s")) != [] and not set(before) - set(kept(before)) & set(store.files("s"))
    batch = store.read_batch("s", "B1")
    assert batch.count() == 2
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(etl_batch_id" in plan and "(etl_batch_id" in plan
    store.replace_partitions("s", _df(spark, []), ("etl_batch_id",))                # no rows: nothing is replaced
    assert store.read("s").count() == 5


def test_replacing_a_partition_computed_from_the_table_itself(spark):
    store = scratch_store(spark, "store")
    store.replace_partitions("s", _df(spark, [1, 2], "B1").union(_df(spark, [3], "B2")), ("etl_batch_id",))
    more = store.read("s").where("etl_batch_id = 'B2'").withColumn("id", F.col("id") + 10)
    store.replace_partitions("s", more, ("etl_batch_id",))
    assert sorted(r.id for r in store.read("s").collect()) == [1, 2, 13]


@pytest.mark.parametrize("buckets", [None, 4])
def test_newest_row_of_a_key_counts(spark, buckets):
    store = scratch_store(spark, "versions")
    store.add_versions("sat_x", _keys(spark, "abc"), buckets)
    store.add_versions("sat_x", _keys(spark, "bd", "w"), buckets)
    assert sorted(map(tuple, store.read("sat_x", KEYED).collect())) == [("a", "v"), ("b", "w"), ("c", "v"), ("d", "w")]
    assert store.rows("sat_x", KEYED).count() == 5 and store.buckets("sat_x") == (buckets or 0)
    again = VaultStore(spark, store.base)                         # as another application would open it
    assert again.read("sat_x", KEYED).count() == 4


def test_newest_rows_of_a_bucketed_table_need_no_exchange(spark):
    store = scratch_store(spark, "versions")
    store.add_versions("sat_x", _keys(spark, "abc"), 4)
    store.add_versions("sat_x", _keys(spark, "bd", "w"), 4)
    plan = store.read("sat_x", KEYED)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan


def test_rewrite_takes_the_place_of_its_own_source(spark):
    store = scratch_store(spark, "rewrite")
    for keys in ("abc", "bd"):
        store.append("hub", _keys(spark, keys), 4)
    store.rewrite("hub", store.rows("hub", KEYED).distinct(), 2)
    assert store.buckets("hub") == 2 and sorted(r.hashkey for r in store.rows("hub", KEYED).collect()) == list("abcd")
    store.append("hub", _keys(spark, "e"))
    assert store.rows("hub", KEYED).count() == 5


def test_a_rewrite_that_broke_off_does_not_count(spark):
    store = scratch_store(spark, "broken")
    store.append("hub", _keys(spark, "abc"))
    path, fs = store._fs(f"{store.base}/hub-b2.g1")
    fs.mkdirs(path)
    assert store.rows("hub", KEYED).count() == 3


def test_columns_of_all_files_or_of_a_given_shape(spark):
    store = scratch_store(spark, "shapes")
    store.append("t", spark.sql("SELECT 1 AS a, 'x' AS b"))
    store.append("t", spark.sql("SELECT 2 AS a, 3.5D AS c"))
    assert sorted(store.read("t").columns) == ["a", "b", "c"]
    shape = T.StructType([T.StructField("c", T.DoubleType()), T.StructField("a", T.IntegerType())])
    assert sorted(map(tuple, store.read("t", shape).collect()), key=str) == [(3.5, 2), (None, 1)]


def test_unreadable_file_raises(spark):
    import os
    store = scratch_store(spark, "unreadable")
    store.append("t", _df(spark, [1]))
    for f in store.files("t"):
        f = f.removeprefix("file:")
        with open(f, "wb") as out:
            out.write(b"not parquet")
        os.remove(os.path.join(os.path.dirname(f), "." + os.path.basename(f) + ".crc"))
    with pytest.raises(Exception):
        store.read("t").collect()


def test_checkpoint_folder_is_required_off_local_masters():
    from vaultkit.session import ensure_checkpoint_dir

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
