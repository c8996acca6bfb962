"""Losses against a model counted in plain Python."""

import pytest
from tests_llm_brute import losses as brute

from vaultkit.llm import cross_entropy as X


def test_losses_equal_plain_counts(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.limit(40).collect()] + [(900, ""), (901, None), (902, "é\U0001f642")]
    good = {rows[0][0], rows[3][0], rows[5][0], 901}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(d, 1) for d in good] + [(rows[1][0], 0), (rows[0][0], 0), (rows[2][0], None), (None, 1)], "doc_id long, quality int")
    want = brute(rows, good)
    got = X.cross_entropy_difference(df, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        n, t, b = want[r.doc_id]
        assert r.n_tokens == n
        if n:
            assert r.loss_target == pytest.approx(t, rel=1e-6) and r.loss_background == pytest.approx(b, rel=1e-6)
            assert r.score == pytest.approx(t - b, abs=1e-6)
        else:
            assert r.loss_target is None and r.score is None


def test_junk_scores_above_good_text(spark):
    sf = "/root/testdata/sf0.01"
    s = X.op7_cross_entropy_difference(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    mean = {r.quality: r.m for r in s.groupBy("quality").agg({"score": "avg"}).withColumnRenamed("avg(score)", "m").collect()}
    assert mean[0] > mean[1] + 0.5


def test_edge_rows(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (1, 1), (None, 1)], "doc_id long, quality int")
    assert X.cross_entropy_difference(edge, labels).count() == edge.count()
    assert X.cross_entropy_difference(edge, labels.limit(0)).count() == edge.count()
    assert X.cross_entropy_difference(empty, labels).count() == 0
