"""Language ID of code-switched text by a linear-chain CRF over words (operator 2).

Every word of every whole text gets a label distribution by forward-backward over its sentence. A
word's emission adds up learned weights of its affixes and character n-grams (hashed, word borders
count as a character) and of its lexicon entry; transitions and starts are learned too. A text's
language is the label with the highest mean marginal, its score that mean.

Training takes a bounded sample: at most ``PER_LANG`` labelled documents per language, least hash of
doc_id first. Half of them make the lexicon, the others the weights, so that the lexicon's weight is
learned on words it has not always seen. Training sequences splice runs of words of several
languages, which is where transitions between languages come from. Only text and language are used.

Sentences end at ``.``, ``!``, ``?`` and line ends; a sentence is one chain, however long.
Defined cases: a null text, or one without letters, is ``und`` with score 0, as is every text if no
labelled row exists; equal marginals go to the first language in order of name; a null doc_id is
scored and never learned from; repeated rows get equal results; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from vaultkit.llm.common import land, slices, table, tasks

PER_LANG = 120
BITS = 16              # weight rows per n-gram length: 2 ** BITS
EPOCHS, RATE, DECAY = 25, 0.5, 1e-4
STOPS = ".!?\n"
SLICE = 1_500_000

_K2, _K3, _K4, _KW = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F))


class Words:
    """Words (runs of letters) of texts as arrays: feature rows per character, lexicon key, text and chain."""

    def __init__(self, part: list[bytes | None], letters: np.ndarray):
        texts = [(t or b"").decode("utf-8", "replace").lower() for t in part]
        cp = np.frombuffer(("\n\n" + "\n\n".join(texts) + "\n\n").encode("utf-32-le"), np.uint32)
        at = np.cumsum([2] + [len(t) + 2 for t in texts])[:-1]
        is_letter = letters[cp]
        edge = np.flatnonzero(np.diff(is_letter.astype(np.int8)))
        self.start, end = edge[::2] + 1, edge[1::2] + 1
        self.n = len(self.start)
        self.text = np.searchsorted(at, self.start, side="right") - 1
        stop = np.cumsum(np.isin(cp, np.array([ord(c) for c in STOPS], np.uint32)), dtype=np.int64)[self.start] if self.n else np.empty(0, np.int64)
        new = np.ones(self.n, bool)
        new[1:] = (stop[1:] != stop[:-1]) | (self.text[1:] != self.text[:-1])
        first = np.flatnonzero(new)
        self.chain, self.lens = first, np.diff(np.append(first, self.n))
        # Feature rows of the characters of each word; characters outside words count as the border 0.
        c = np.where(is_letter, cp, 0).astype(np.uint32)
        pos = np.flatnonzero(is_letter)
        self.size = end - self.start
        self.offset = np.cumsum(self.size) - self.size
        c0, c1, c2 = c[pos - 1], c[pos], c[pos + 1]
        two = (c0 * _K2) ^ (c1 * _K3)
        three = two ^ (c2 * _K4)
        shift = np.uint32(32 - BITS)
        self.gram2 = ((two * _KW) >> shift).astype(np.int32)
        mixed = three * _KW
        self.gram3 = ((mixed ^ (mixed >> np.uint32(15))) * _K2 >> shift).astype(np.int32)
        if self.n:
            s, e = self.start, end
            pre = (c[s] * _K2) ^ (c[s + 1] * _K3) ^ (c[np.minimum(s + 2, e)] * _K4) ^ np.uint32(1)
            suf = (c[e - 1] * _K2) ^ (c[e - 2] * _K3) ^ (c[np.maximum(e - 3, s - 1)] * _K4) ^ np.uint32(2)
            self.prefix, self.suffix = [((x * _KW) >> shift).astype(np.int32) for x in (pre, suf)]
            order = (mixed.astype(np.uint64) << np.uint64(32)) | three.astype(np.uint64)
            order = (order ^ (order >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            self.key = np.add.reduceat(order, self.offset) + self.size.astype(np.uint64)
        else:
            self.prefix = self.suffix = np.empty(0, np.int32)
            self.key = np.empty(0, np.uint64)


def entries(w: Words, lexicon: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Lexicon entry of each word: the language it was seen in most, or one past the last."""
    if not len(lexicon):
        return np.zeros(w.n, np.int64)
    k = np.minimum(np.searchsorted(lexicon, w.key), len(lexicon) - 1)
    return np.where(lexicon[k] == w.key, entry[k], entry.max() + 1)


def emissions(w: Words, lex: np.ndarray, m: dict) -> np.ndarray:
    """n x labels sums of weights."""
    if not w.n:
        return np.zeros((0, m["next"].shape[0]), np.float32)
    s = np.add.reduceat(m["two"][w.gram2] + m["three"][w.gram3], w.offset, axis=0)
    return s + m["prefix"][w.prefix] + m["suffix"][w.suffix] + m["lexicon"][lex]


def marginals(scores: np.ndarray, start: np.ndarray, lens: np.ndarray, first: np.ndarray, step: np.ndarray, pairs: bool = False):
    """Forward-backward over all chains at once, longest first. Returns marginals and, if asked, the
    expected transitions and starts. Values are scaled at every word, so no chain is too long."""
    e = np.exp(scores - scores.max(1, keepdims=True)) if len(scores) else scores
    t, pi = np.exp(step), np.exp(first)
    order = np.argsort(-lens, kind="stable")
    start, lens = start[order], lens[order]
    live = np.searchsorted(-lens, -np.arange(1, (lens[0] if len(lens) else 0) + 1), side="right")
    a, b = np.empty_like(e), np.empty_like(e)
    for k, m in enumerate(live):
        at = start[:m] + k
        x = e[at] * (pi if k == 0 else a[at - 1] @ t)
        a[at] = x / x.sum(1, keepdims=True)
    moved = np.zeros_like(t)
    for k in range(len(live) - 1, -1, -1):
        m, more = live[k], live[k + 1] if k + 1 < len(live) else 0
        b[start[more:m] + k] = 1.0
        if more:
            at = start[:more] + k
            x = e[at + 1] * b[at + 1]
            y = x @ t.T
            b[at] = y / y.sum(1, keepdims=True)
            if pairs:
                z = (a[at] * y).sum(1, keepdims=True)
                moved += (a[at] / z).T @ x * t
    p = a * b
    p /= p.sum(1, keepdims=True)
    return (p, moved, p[start].sum(0)) if pairs else p


def train(texts: list[bytes], langs: list[str], letters: np.ndarray, seed: int = 7) -> dict | None:
    """Model from labelled texts; None without labels."""
    labels = sorted(set(langs))
    if not labels:
        return None
    n = len(labels)
    rng = np.random.default_rng(seed)
    y_text = np.array([labels.index(x) for x in langs])
    half = np.zeros(len(texts), bool)
    for k in range(n):                     # every language gives documents to both halves if it has two
        half[np.flatnonzero(y_text == k)[::2]] = True
    seen = Words([t for t, h in zip(texts, half) if h], letters)
    keys, inv = np.unique(seen.key, return_inverse=True)
    count = np.zeros((len(keys), n), np.int64)
    np.add.at(count, (inv, y_text[half][seen.text]), 1)
    m = {"labels": labels, "lexicon_keys": keys, "lexicon_entry": count.argmax(1)}
    use = ~half if all((~half & (y_text == k)).any() for k in range(n)) else np.ones(len(texts), bool)
    w = Words([t for t, u in zip(texts, use) if u], letters)
    y = y_text[use][w.text]
    lex = entries(w, m["lexicon_keys"], m["lexicon_entry"])
    # Spliced chains: runs of 1 to 8 words, one to four runs after each other, in random order.
    runs, at = [], 0
    while at < w.n:
        stop = at + int(rng.integers(1, 9))
        same = np.flatnonzero(w.text[at:stop] != w.text[at])
        stop = min(w.n, at + int(same[0]) if len(same) else stop)
        runs.append((at, stop))
        at = stop
    chains, k = [], 0
    shuffled = rng.permutation(len(runs))
    while k < len(shuffled):
        take = int(rng.integers(1, 5))
        chains.append(np.concatenate([np.arange(*runs[r]) for r in shuffled[k:k + take]]))
        k += take
    perm = np.concatenate(chains) if chains else np.empty(0, np.int64)
    lens = np.array([len(c) for c in chains], np.int64)
    start = np.cumsum(lens) - lens
    want = np.zeros((w.n, n), np.float32)
    want[np.arange(w.n), y] = 1
    ys = y[perm]
    moves = np.ones(max(0, len(perm) - 1), bool)
    moves[start[1:] - 1] = False
    real = np.zeros((n, n))
    np.add.at(real, (ys[:-1][moves], ys[1:][moves]), 1)
    began = np.bincount(ys[start], minlength=n) if len(start) else np.zeros(n)
    rows = 1 << BITS
    shapes = {"two": (rows, n), "three": (rows, n), "prefix": (rows, n), "suffix": (rows, n), "lexicon": (n + 1, n), "next": (n, n), "first": (n,)}
    for name, shape in shapes.items():
        m[name] = np.zeros(shape, np.float32)
    speed = {name: np.full(shape, 1e-6, np.float64) for name, shape in shapes.items()}
    owner = np.repeat(np.arange(w.n), w.size)

    def summed(index, g, size):
        return np.stack([np.bincount(index, g[:, k], minlength=size) for k in range(n)], 1)

    for _ in range(EPOCHS if w.n else 0):
        p, moved, starts = marginals(emissions(w, lex, m)[perm], start, lens, m["first"], m["next"], pairs=True)
        g = want.copy()
        g[perm] -= p
        each = g[owner]
        grads = {"two": summed(w.gram2, each, rows), "three": summed(w.gram3, each, rows), "prefix": summed(w.prefix, g, rows),
                 "suffix": summed(w.suffix, g, rows), "lexicon": summed(lex, g, n + 1), "next": real - moved, "first": began - starts}
        for name, d in grads.items():      # Adagrad with weight decay
            speed[name] += d * d
            m[name] += (RATE * d / np.sqrt(speed[name]) - DECAY * m[name]).astype(np.float32)
    return m


def letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _predict(shared):
    def run(batches):
        m, packed = shared.value
        letters = np.unpackbits(packed).astype(bool)
        for b in batches:
            for first, part in slices(b.column(1), SLICE):
                n = len(part)
                w = Words(part, letters)
                words = np.bincount(w.text, minlength=n) if w.n else np.zeros(n, np.int64)
                if m is None or not w.n:
                    langs, score, switch = ["und"] * n, np.zeros(n), np.zeros(n, np.int64)
                else:
                    p = marginals(emissions(w, entries(w, m["lexicon_keys"], m["lexicon_entry"]), m), w.chain, w.lens, m["first"], m["next"])
                    mean = np.stack([np.bincount(w.text, p[:, k], minlength=n) for k in range(p.shape[1])], 1) / np.maximum(words, 1)[:, None]
                    best = mean.argmax(1)
                    langs = [m["labels"][k] if c else "und" for k, c in zip(best, words)]
                    score = np.clip(np.where(words > 0, mean.max(1), 0.0), 0.0, 1.0)
                    label = p.argmax(1)
                    turn = np.flatnonzero((label[1:] != label[:-1]) & (w.text[1:] == w.text[:-1])) + 1
                    switch = np.bincount(w.text[turn], minlength=n)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, n), pa.array(langs, pa.string()), pa.array(score, pa.float64()),
                                                  pa.array(words, pa.int64()), pa.array(switch, pa.int64())],
                                                 names=["doc_id", "lang_pred", "score", "n_words", "n_switches"])
    return run


def sample(docs: DataFrame, doc_id: str, text: str, lang: str, per_lang: int) -> list:
    """At most ``per_lang`` rows per language, least hash of the id first. Ranks are limited in every
    task before the shuffle. Ids are ranked first, and texts are fetched for the chosen ones; of an id that
    many rows share, no more than ``per_lang`` are."""
    docs = docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t"), F.col(lang).alias("l"))
    rank = F.row_number().over(Window.partitionBy("l").orderBy(F.xxhash64("i"), "i"))
    ids = docs.select("i", "l").where("i IS NOT NULL AND l IS NOT NULL").withColumn("r", rank).where(F.col("r") <= per_lang)
    ids = land(ids.select("i").distinct(), "sample-ids")                # at most per_lang ids a language
    rows = docs.join(ids, "i", "left_semi").where("l IS NOT NULL AND t IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy("l").orderBy(F.xxhash64("i"), "i", "t"))
    rows = rows.withColumn("r", rank).where(F.col("r") <= per_lang).collect()
    return sorted((r.i, r.t, r.l) for r in rows)


def languages(docs: DataFrame, learn: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = PER_LANG) -> DataFrame:
    """(doc_id, lang_pred, score, n_words, n_switches) for ``docs``, learned from the rows of ``learn``."""
    letters = letter_table()
    rows = sample(learn, doc_id, text, lang, per_lang)
    model = train([t.encode() for _, t, _ in rows], [x for _, _, x in rows], letters)
    shared = docs.sparkSession.sparkContext.broadcast((model, np.packbits(letters)))
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return tasks(src, _predict(shared), "doc_id long, lang_pred string, score double, n_words long, n_switches long")


def op2_crf_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    p = languages(docs, docs.where(fold != 1))
    return p.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "n_words", "n_switches")
