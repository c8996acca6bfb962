"""Losses on a corpus of many scripts against plain counts over all characters and all context lengths."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from vaultkit.llm import cross_entropy as X


def brute(rows, good):
    rows = [(d, t or "") for d, t in rows]
    size = max(X.VOCABULARY, len({c for _, t in rows for c in t}))
    lead = ["<"] * (X.ORDER - 1)

    def model(texts):
        n, context = Counter(), Counter()
        for t in texts:
            s = [*lead, *t]
            for k in range(len(lead), len(s)):
                for m in range(X.ORDER):
                    n[tuple(s[k - m:k + 1])] += 1
                    context[m, tuple(s[k - m:k])] += 1

        def p(g):
            if not g:
                return 1 / size
            prior = X.PRIORS[len(g) - 1]
            return (n[g] + prior * p(g[1:])) / (context[len(g) - 1, g[:-1]] + prior)
        return p

    models = [model([t for d, t in rows if d in good]), model([t for _, t in rows])]
    out = {}
    for d, t in rows:
        s = [*lead, *t]
        grams = [tuple(s[k - len(lead):k + 1]) for k in range(len(lead), len(s))]
        out[d] = [len(grams)] + [-sum(math.log(p(g)) for g in grams) / len(grams) if grams else None for p in models]
    return out


def test_every_character_counts(spark):
    rng = random.Random(7)
    scripts = [[chr(a + k) for k in range(n)] for a, n in ((0x61, 26), (0x4E00, 400), (0xAC00, 300), (0x1F600, 60))]
    rows = [(d, "".join(rng.choice(scripts[d % 4][:12 if d % 3 else 400]) for _ in range(rng.randint(1, 120)))) for d in range(80)]
    good = {d for d in range(0, 80, 3)}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(d, 1) for d in good], "doc_id long, quality int")
    want = brute(rows, good)
    for more in ({}, {"chunk": 500}):               # one chunk, and several
        got = X.cross_entropy_difference(df, labels, **more).collect()
        assert len(got) == len(rows)
        for r in got:
            assert [r.n_tokens, r.loss_target, r.loss_background] == pytest.approx(want[r.doc_id], rel=1e-6)


def test_ngrams_of_more_symbols_than_a_long_holds():
    rng = np.random.default_rng(0)
    for top in (200, 60_000):                       # 8 and 16 bits a symbol: 40 and 80 bits an n-gram
        texts = ["".join(map(chr, rng.integers(1, top, 300).tolist() + [0xD7FF])) for _ in range(60 if top > 200 else 3)]
        symbols, n = X.codes([t.encode("utf-8", "replace") for t in texts])
        grams = X.Grams(symbols)
        assert grams.fits == (top == 200)
        g = grams.of_text(symbols, n)
        hi, lo = grams.keys(g)
        assert (grams.of_keys(hi, lo) == g).all() and len(g) == n.sum()
        assert (lo[:n[0]] & X.LAST).tolist() == [ord(c) for c in texts[0].encode("utf-8", "replace").decode()]


def test_a_text_that_occurs_twice_is_known_to_the_model(spark, docs):
    """Losses under the background are lower for a repeated text than for the same text given once."""
    rows = [(r.doc_id, r.text) for r in docs.where("length(text) > 600").limit(60).collect()]
    labels = spark.createDataFrame([(rows[0][0], 1)], "doc_id long, quality int")
    loss = lambda rs: {r.doc_id: r.loss_background for r in X.cross_entropy_difference(
        spark.createDataFrame(rs, "doc_id long, text string"), labels).collect()}
    once, twice = loss(rows), loss(rows + [(-1, rows[5][1])])
    assert twice[rows[5][0]] < once[rows[5][0]] - 0.05
