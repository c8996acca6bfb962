"""Ids and decoded texts against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest

from vaultkit.llm import bpe as B


@pytest.fixture(scope="module")
def library():
    import public_tokenizers as P
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


def want(tok, text):
    e = tok.encode(text or "", add_special_tokens=False).ids
    return (len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(tok.decode(e, skip_special_tokens=False).encode()).hexdigest())


def got(df, lexicon):
    return [(r.doc_id, (r.n_tokens, r.ids_sha256, r.decoded_sha256))
            for r in B.encode(df, fields=("n_tokens", "ids_sha256", "decoded_sha256"), lexicon=lexicon).collect()]


def test_documents_equal_the_library(spark, texts, library):
    rows = B.op4_bpe(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == {k: want(library, t) for k, t in texts.items()}


@pytest.mark.parametrize("lexicon", [0, 20, 5000])
def test_odd_texts_equal_the_library_with_any_lexicon(spark, library, lexicon):
    rng = random.Random(5)
    alphabet = "abcdefgh'stremlld  \n\t.,!?ÀéÉΣςİıßﬁ１２3½中文字日本語한국어🙂👍́‍​\x00\x1c\x85\xa0 <|>endoftext'S'RE"
    rows = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(400)]
    rows += [None, "", "<|endoftext|>", "a<|endoftext|> B<|startoftext|><|startoftext", "x" * 5000, "ab" * 3000, "I'll've can't DON'T 's's're",
             "ΑΣ ΣΑΣ", "é" * 100, "<|EndOfText|>", "éÅ", "ⅷ²³ _ __a_"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert dict(got(df, lexicon)) == {i: want(library, t) for i, t in enumerate(rows)}


def test_edge_rows(spark, edge, empty, library):
    rows = sorted(got(edge, 100), key=str)
    assert rows == sorted(((r.doc_id, want(library, r.text)) for r in edge.select("doc_id", "text").collect()), key=str)
    assert B.encode(empty).count() == 0
    out = B.stage(spark, edge, None)
    assert out.count() == edge.count() and "ids" in out.columns


def test_automaton_is_minimal_and_knows_its_words():
    words = sorted({w.encode() for w in "tap taps top tops stop stops stopped tapped a an and zand".split()})
    edges, final = B.minimal_automaton(words)
    reach, stack = set(), [0]
    while stack:
        s = stack.pop()
        if s not in reach:
            reach.add(s)
            stack += edges[s].values()
    right = lambda s: frozenset(([b""] if final[s] else []) + [bytes([b]) + w for b, t in edges[s].items() for w in right(t)])
    languages = [right(s) for s in reach]
    assert len(set(languages)) == len(languages) and right(0) == frozenset(words)


def test_long_and_short_merges_agree():
    v = B.Vocabulary(B.vocabulary_path())
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeinorstuéü") for _ in range(rng.randint(1, 30))).encode() for _ in range(300)]
    starts, lens, flat = v.merge(words)
    for w, s, n in zip(words, starts, lens):
        assert flat[s:s + n].tolist() == v._merge_long(w).tolist()
