"""SimHash windows against exact comparison of every item-sized window."""

import random

import numpy as np

from vaultkit.llm import decontaminate as D
from vaultkit.llm.shingles import grams, word_hashes, words


def brute(rows, items, similarity=0.8):
    """{(doc_id, item_id)}: exact weighted similarity of every window of the item's size."""
    index = D.Items(items)
    out = {}
    for doc, text in rows:
        h = word_hashes(words((text or "").encode()))
        for item, t in items:
            g = word_hashes(words((t or "").encode()))
            if not len(g) or not len(h):
                continue
            size = min(len(g), len(h))
            k = min(5, len(g))
            if len(h) < k:
                continue
            s = grams(g)
            bag = {int(a): float(index.weight(np.array([a], np.uint64))[0]) * int(n) for a, n in zip(*np.unique(s, return_counts=True))}
            w = grams(h, k)
            span = size - k + 1
            best = max((D.Items.similarity(index, bag, w[i:i + span]) for i in range(len(w) - span + 1)), default=0)
            if best >= similarity:
                out[doc, item] = round(best, 6)
    return out


def test_documents_equal_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): round(r.similarity, 6) for r in D.op6_benchmark_decontamination(spark, sf).collect()}
    # Windows that share no shingle cannot pass, so only documents with a shared one are compared.
    known = set(D.Items(items).known.tolist())
    near = [(d, t) for d, t in rows if known & set(grams(word_hashes(words(t.encode()))).tolist())]
    assert got == brute(near, items) and got


def _edited(rng, ws, n):
    out = list(ws)
    for _ in range(n):
        k = rng.randrange(3)
        at = rng.randrange(len(out))
        if k == 0:
            out[at] = f"new{rng.randrange(999)}"
        elif k == 1:
            out.insert(at, f"new{rng.randrange(999)}")
        else:
            del out[at]
    return out


def test_edited_items_in_long_texts(spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(rng.randint(30, 60)))) for i in range(30)] + [(100, "just three words"), (101, ""), (102, None)]
    rows = []
    for d in range(90):
        ws = [word() for _ in range(rng.randint(0, 300))]
        if d % 2:
            ws[len(ws) // 2:len(ws) // 2] = _edited(rng, items[d % 30][1].split(), rng.randrange(3))
        if d % 30 == 0:
            ws += ["Just", "three", "WORDS."]
        rows.append((d, " ".join(ws)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, [(i, t) for i, t in items if t])
    for block in (5000, 7):                       # items in one block, and in several
        got = {(r.doc_id, r.item_id): round(r.similarity, 6) for r in D.contaminated(docs, bench, block=block).collect()}
        assert got == want and len(want) > 25     # blocks are a split of the work, weights are those of the whole


def test_index_finds_every_print_within_the_radius():
    rng = np.random.default_rng(3)
    items = D.Items([(i, " ".join(f"t{i}_{k}" for k in range(20))) for i in range(40)])
    (index,) = items.indexes
    prints = index.prints.repeat(50)
    for k in range(len(prints)):
        for bit in rng.choice(64, rng.integers(0, 40), replace=False):
            prints[k] ^= np.uint64(1) << np.uint64(bit)
    got = {(w, i) for w, i, _ in index.candidates(prints)}
    far = np.array([[bin(int(a) ^ int(b)).count("1") for b in index.prints] for a in prints])
    assert got == {(int(w), int(i)) for w, i in zip(*np.nonzero(far <= D.RADIUS))}


def test_edge_rows(spark, edge, empty):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (None, "some words in it"), (2, None)], "item_id long, text string")
    got = D.contaminated(edge, bench).collect()
    assert sorted((str(r.doc_id), str(r.item_id)) for r in got) == [("1", "1"), ("1", "1"), ("None", "None")]
    assert D.contaminated(empty, bench).count() == 0
    assert D.contaminated(edge, bench.limit(0)).count() == 0


def test_stage_with_clashing_names(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    clash = docs.selectExpr("*", "1 AS dc_key", "2 AS DC_GONE")
    kept = D.stage(spark, clash, sf)
    assert kept.columns == clash.columns
    bad = {r.doc_id for r in D.op6_benchmark_decontamination(spark, sf).collect()}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - bad
