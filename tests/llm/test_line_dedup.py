"""Deleted lines against a plain scan of all earlier windows."""

import random

import pytest

from vaultkit.llm import line_dedup as L


def brute(rows, min_words=50):
    """{doc_id: deleted line numbers}, documents in order of id."""
    lines = {d: [(n, x.strip()) for n, x in enumerate((t or "").split("\n")) if x.split()] for d, t in rows}
    first, gone = {}, {}
    for d in sorted(lines):
        ls = lines[d]
        for i in range(len(ls)):
            words = 0
            for e in range(i, len(ls)):
                words += len(ls[e][1].split())
                if words >= min_words:
                    break
            else:
                break
            a = first.setdefault(tuple(x for _, x in ls[i:e + 1]), (d, i))
            if a == (d, i):
                continue
            other, shift = lines[a[0]], i - a[1]
            same = lambda k: 0 <= k < len(ls) and 0 <= k - shift < len(other) and ls[k][1] == other[k - shift][1]
            lo, hi = i, e
            while same(lo - 1):
                lo -= 1
            while same(hi + 1):
                hi += 1
            gone.setdefault(d, set()).update(ls[k][0] for k in range(lo, hi + 1))
    return {d: sorted(x) for d, x in gone.items()}


def check(spark, rows, min_words):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = L.dedup_lines(df, min_words=min_words).collect()
    want = brute(rows, min_words)
    assert {r.doc_id: r.ld_gone for r in out if r.ld_gone is not None} == want
    for r in out:
        t = dict(rows)[r.doc_id]
        kept = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want.get(r.doc_id, ()))
        assert r.text == kept
    return want


def test_documents(spark, texts):
    assert check(spark, list(texts.items()), 50)


@pytest.mark.parametrize("min_words", [1, 4, 12])
def test_random_runs_with_frequent_lines(spark, min_words):
    rng = random.Random(min_words)
    pool = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randint(1, 6))) for _ in range(25)]
    rows = []
    for d in range(60):
        ls = [rng.choice(pool) for _ in range(rng.randint(0, 12))]
        if d % 3 == 0:
            ls[1:1] = pool[:6]
        if d % 5 == 0:
            ls += ["", "  " + pool[3] + " ", pool[4]]
        rows.append((d, "\n".join(ls)))
    assert check(spark, rows, min_words)


def test_run_repeated_inside_one_text(spark):
    run = "\n".join(" ".join(f"l{k}w{i}" for i in range(20)) for k in range(3))
    assert check(spark, [(1, run + "\n" + run + "\nend\n" + run), (2, "x\n" + run)], 50) == {1: [3, 4, 5, 7, 8, 9], 2: [1, 2, 3]}


def test_edge_rows(spark, edge, empty):
    out = L.dedup_lines(edge)
    assert out.count() == edge.count()
    assert L.dedup_lines(empty).count() == 0
    edge = edge.selectExpr("*", "'x' AS ld_gone", "1 AS ld_th", "2 AS ld_doc", "3 AS LD_TH2")
    kept = L.stage(spark, edge, None)
    assert kept.columns == edge.columns and kept.count() == edge.count()     # equal rows are one document


def test_stage_drops_documents_that_lose_everything(spark):
    t = "\n".join(" ".join(f"l{k}w{i}" for i in range(30)) for k in range(3))
    df = spark.createDataFrame([(1, t, 5), (2, t, 5), (3, t + "\nown line", 5), (4, None, 5), (5, "", 5)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in L.stage(spark, df, None).collect()}
    assert got == {1: (t, 5), 3: ("own line", 8), 4: (None, 5), 5: ("", 5)}


def test_common_runs():
    import numpy as np
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, 200)
    p, q = rng.integers(0, 200, 500), rng.integers(0, 200, 500)
    for i, j, n in zip(p, q, L.common(x, p, q)):
        m = 0
        while max(i, j) + m < 200 and x[i + m] == x[j + m]:
            m += 1
        assert m == n


@pytest.mark.parametrize("few", [0, 4])
def test_a_text_that_repeats_its_own_lines(spark, few, monkeypatch):
    monkeypatch.setattr(L, "FEW", few)
    block = [" ".join(f"l{k}w{i}" for i in range(1 + k % 3)) for k in range(40)]
    rows = [(1, "\n".join(["a b"] * 120)), (2, "\n".join(block * 6)), (3, "\n".join(block[5:] + ["x y z"] + block)), (4, "\n".join(["c"] + ["a b"] * 70))]
    check(spark, rows, 50)


def test_long_texts_of_equal_lines_and_repeated_blocks(spark):
    """200,000 lines each; the time of a quadratic join would be hours."""
    import time
    block = [f"line number {k} of it" for k in range(40)]
    rows = [(1, "\n".join(["a b"] * 200_000)), (2, "\n".join(block * 5_000))]
    t = time.time()
    out = {r.doc_id: (r.text, r.n) for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).selectExpr(
        "doc_id", "text", "size(ld_gone) AS n").collect()}
    assert out == {1: ("a b", 199_999), 2: ("\n".join(block), 199_960)}
    assert time.time() - t < 120
