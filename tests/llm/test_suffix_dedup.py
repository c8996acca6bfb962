"""Removed bytes against a count of every window."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vaultkit.llm import suffix_dedup as S


def brute(rows, threshold):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + threshold] for t in texts for i in range(len(t) - threshold + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - threshold + 1):
            if seen[t[i:i + threshold]] > 1:
                gone[i:i + threshold] = b"\1" * threshold
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(t), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def digest(df):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return sorted(map(tuple, df.select("doc_id", "n_bytes", removed, F.size("spans").cast("long"), F.sha2("kept", 256)).collect()), key=str)


def check(spark, rows, threshold, reach, step):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, threshold)
    assert digest(S.dedup_suffixes(df, threshold=threshold, reach=reach, step=step)) == want
    return want


@pytest.mark.parametrize("threshold,reach,step", [(24, 8, 4), (40, 20, 8), (17, 1, 1)])
def test_random_texts_of_few_words(spark, threshold, reach, step):
    rng = random.Random(threshold)
    pool = ["alpha", "beta", "gam", "ma", "délta", "e", "x\u0000y"]
    rows = [(d, " ".join(rng.choice(pool) for _ in range(rng.randrange(60)))) for d in range(60)]
    # Equal texts, empty ones, one repeated byte, a period, a text of exactly the threshold, a repeated row, null ids.
    rows += [(99, rows[5][1]), (5, rows[5][1]), (None, None), (None, rows[7][1]), (3, ""), (101, "a" * 300), (102, "b" * threshold), (103, "xy" * 70)]
    assert sum(r[2] for r in check(spark, rows, threshold, reach, step))


def test_one_passage_in_many_texts(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(80))
    rows = [(d, " ".join(word() for _ in range(rng.randrange(90))) + passage[rng.randrange(100):] + " ".join(word() for _ in range(40))) for d in range(300)]
    want = check(spark, rows, 400, 200, 8)
    assert sum(r[2] > 0 for r in want) == 300


def test_query_on_documents(spark, texts):
    got = sorted(map(tuple, S.op11_suffix_dedup(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == brute(list(texts.items()), 400)


def test_edge_rows(spark, edge, empty):
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert digest(S.dedup_suffixes(edge)) == brute(rows, 400)
    assert S.dedup_suffixes(empty).count() == 0
    with pytest.raises(ValueError):
        S.dedup_suffixes(edge, threshold=100, reach=90)
