"""Draws against SQL and a plain sort; the bracket against exact counts."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from vaultkit.llm import resampling as R

SF = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(f"SELECT doc_id, n_features, weight, score, rank FROM ({R.ORACLE_SQL})").fetchall()
    got = list(map(tuple, R.op12_resampling(spark, SF).select("doc_id", "n_features", "weight", "score", "rank").collect()))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[4] is not None for r in got) > 10


def test_words_and_runs():
    n, at = R.features("Abé-9z a".encode(), R.Hashed(), buckets=1 << 32, order=2)
    import zlib
    words = ["abé".encode(), b"9z", b"a"]
    assert n == 3 and at.tolist() == [*map(zlib.crc32, words), zlib.crc32(b" ".join(words[:2])), zlib.crc32(b" ".join(words[1:]))]
    assert R.features(None, R.Hashed())[0] == 0


def test_gains_follow_the_target():
    raw, target = np.array([90, 10, 0]), np.array([1, 9, 0])
    g = R.gains(raw, target)
    assert g[1] > 0 > g[0] and R.gains(raw * 0, target * 0).tolist() == [0, 0, 0]


@pytest.mark.parametrize("spread", [1, 7, 100_000])
@pytest.mark.parametrize("share", [0.001, 0.1, 0.5, 1.0])
def test_cutoff_with_ties(spark, spread, share):
    """Few distinct scores make a third of all rows equal; a margin of nothing has to be widened."""
    n = 3000
    df = spark.range(n).select((F.col("id") % 1500).alias("doc_id"), F.pmod(F.xxhash64("id"), F.lit(spread)).alias("score"), F.col("id").alias("at"))
    k = int(n * share)
    got = sorted(r.at for r in df.where(R.draw(df, k, n, margin=1e-9)).collect())
    rows = sorted(df.collect(), key=lambda r: (-r.score, r.doc_id, r.at))
    assert got == sorted(r.at for r in rows[:k])


def test_edge_rows(spark, edge, empty):
    target = spark.createDataFrame([("one two three",), (None,)], "text string")
    out = R.resample(edge, target, min_words=1, percent=50).collect()
    assert len(out) == edge.count()
    able = sum(r.n_features > 0 for r in out)
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, able * 50 // 100 + 1))
    assert all(r.weight == 0 for r in out if not r.n_features)
    drawn = sorted((r for r in out if r["rank"]), key=lambda r: r["rank"])
    assert [r.score for r in drawn] == sorted((r.score for r in out if r.n_features), reverse=True)[:len(drawn)]
    assert R.resample(empty, target).count() == 0
    assert R.resample(edge, target.limit(0)).count() == edge.count()
