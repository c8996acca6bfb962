"""Brute-force versions shared by the tests of this folder."""

import hashlib
import importlib.util
import pathlib

import numpy as np

HERE = pathlib.Path(__file__).parent


def _load(name):
    spec = importlib.util.spec_from_file_location(f"brute_{name}", HERE / f"{name}.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def classes(rows):
    return _load("test_jaccard_join").brute(list(rows))


def deleted_lines(rows):
    return _load("test_line_dedup").brute(list(rows))


def bench_pairs(rows, items):
    """Documents that contain an item. Only those that share a shingle with one are compared."""
    from vaultkit.llm.decontaminate import Items
    from vaultkit.llm.shingles import grams, word_hashes, words
    known = set(Items(items).known.tolist())
    near = [(d, t) for d, t in rows if known & set(grams(word_hashes(words(t.encode()))).tolist())]
    return {d for d, _ in _load("test_decontaminate").brute(near, items)}


def tokens(text):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    if not hasattr(tokens, "library"):
        tokens.library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ids = tokens.library.encode(text, add_special_tokens=False).ids
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def losses(rows, good):
    return _load("test_cross_entropy_open").brute(rows, good)
