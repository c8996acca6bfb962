"""Forward-backward against enumeration, held-out accuracy, code-switched text."""

import itertools

import numpy as np

from vaultkit.llm import crf_language as C


def _enumerated(scores, first, step):
    n, k = scores.shape
    p, moved = np.zeros((n, k)), np.zeros((k, k))
    total = 0.0
    for ys in itertools.product(range(k), repeat=n):
        z = np.exp(first[ys[0]] + sum(scores[i, y] for i, y in enumerate(ys)) + sum(step[a, b] for a, b in zip(ys, ys[1:])))
        total += z
        for i, y in enumerate(ys):
            p[i, y] += z
        for a, b in zip(ys, ys[1:]):
            moved[a, b] += z
    return p / total, moved / total


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    first, step, scores = rng.normal(size=3), rng.normal(size=(3, 3)), rng.normal(size=(8, 3)) * 3
    start, lens = np.array([0, 4, 5]), np.array([4, 1, 3])
    p, moved, began = C.marginals(scores, start, lens, first, step, pairs=True)
    want = [_enumerated(scores[s:s + n], first, step) for s, n in zip(start, lens)]
    assert np.allclose(p, np.concatenate([w[0] for w in want]))
    assert np.allclose(moved, sum(w[1] for w in want)) and np.allclose(began, sum(w[0][0] for w in want))


def test_held_out_accuracy_and_contract(spark):
    rows = C.op2_crf_language(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and 200 < len(held) < 500
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.lang_pred in {*lang.values(), "und"} for r in rows)


def test_code_switched_text_gets_both_languages(spark, docs):
    by = {}
    for r in docs.collect():
        by.setdefault(r.lang, []).append(r.text)
    rows = [(k * 100 + i, t, k2) for k, (k2, ts) in enumerate(sorted(by.items())) for i, t in enumerate(ts[:25])]
    learn = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    a, b = [" ".join(by[x][-1].replace(".", " ").split()[:40]) for x in ("de", "fr")]
    mixed = spark.createDataFrame([(1, f"{a} {b}", None), (2, a, None)], learn.schema)
    got = {r.doc_id: r for r in C.languages(mixed, learn).collect()}
    assert 1 <= got[1].n_switches <= 6 and got[1].score < 0.8 and got[2].lang_pred == "de" and got[2].score > 0.9


def test_edge_rows(spark, edge, empty, docs):
    got = C.languages(edge, docs).collect()
    assert len(got) == edge.count()
    assert {r.lang_pred for r in got if r.doc_id in (2, 3, 4, 6)} == {"und"}
    assert C.languages(empty, docs).count() == 0
    none = C.languages(edge, empty).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    C.languages(edge, edge).count()           # learning from null ids, texts and languages


def test_sample_is_bounded(docs):
    rows = C.sample(docs, "doc_id", "text", "lang", 3)
    per = {}
    for _, _, lang in rows:
        per[lang] = per.get(lang, 0) + 1
    assert set(per.values()) == {3}


def test_lang_source_and_id_of_scored_rows_do_not_matter(spark, docs):
    from pyspark.sql import functions as F
    learn = docs.where("doc_id % 2 = 0")
    odd = docs.where("doc_id % 2 = 1").withColumn("h", F.md5("text"))
    other = odd.withColumns({"doc_id": -F.col("doc_id") * 7, "lang": F.lit("xx"), "source": F.col("lang")})
    result = lambda d: sorted((r.h, r.lang_pred, r.score) for r in C.languages(d, learn).join(
        d.select("doc_id", "h"), "doc_id").collect())
    assert result(odd) == result(other)


def test_a_long_sentence_is_one_chain():
    letters = C.letter_table()
    w = C.Words([("word " * 5000).encode(), b"two. three"], letters)
    assert w.lens.tolist() == [5000, 1, 1]


def test_sample_of_an_id_that_many_rows_share(spark):
    rows = spark.range(500).selectExpr("1L AS doc_id", "concat('text ', id) AS text", "'en' AS lang")
    assert len(C.sample(rows, "doc_id", "text", "lang", 20)) == 20
