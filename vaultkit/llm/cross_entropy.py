"""LM scoring by cross-entropy difference (operator 7).

Two character models of order ``ORDER`` share one open vocabulary (every character of the texts, and one
symbol for the start), one order and one smoothing. The target model counts the documents labelled as good,
the background model counts all documents. A document's score is its mean loss per character under
the target less that under the background: the lower, the closer to the target. A context of four characters
holds most of a word, or a short one with its neighbour's end.

Texts are landed once, compressed, in chunks of about ``CHUNK`` bytes. Labels join the documents' ids and
places, not their texts, so that frequent or null ids move none; then each chunk meets its good places, and
its n-grams are counted. Both models are Spark tables keyed by n-gram, which grow
with the corpus and are never collected. Each chunk's distinct n-grams are joined to their two
losses, and the losses meet the texts of the chunk. An n-gram is two longs, the first two symbols and the last
three; inside a task it is one number over the symbols at hand.

Defined cases: a null or empty text has no token and null losses; a document without label, or with
a null id, counts for the background only; several labels of one document count as good if one is;
repeated rows count each time; with no target text the target model is flat; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultkit.llm.common import give_back, land, segments, slices, table, tasks

ORDER = 5                  # symbols of an n-gram; its key has room for so many
VOCABULARY = 128           # the flat estimate is over the characters of the corpus, at least so many
START = 0x110000           # no character has this code point
BITS = 21                  # of a symbol
LAST = (1 << BITS) - 1
PRIORS = (32.0, 32.0, 16.0, 4.0, 2.0)      # weight of the shorter context's estimate, in tokens, by order
CHUNK = 16_000_000         # bytes of text that are joined to the losses of their n-grams at once


def codes(part: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, length of each text): start symbols lead every text, as many as a context has."""
    texts = [(t or b"").decode("utf-8", "replace") for t in part]
    cps, n = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), np.array([len(t) for t in texts], np.int64)
    lead = ORDER - 1
    out = np.full(len(cps) + lead * len(n), START, np.int64)
    out[np.arange(len(cps)) + np.repeat(lead * np.arange(1, len(n) + 1), n)] = cps
    return out, n


class Grams:
    """N-grams as single numbers over a list of symbols, where they fit, else as rows of a table of pairs."""

    def __init__(self, symbols: np.ndarray):
        seen = np.zeros(START + 1, bool)
        seen[symbols] = True
        self.symbols = np.flatnonzero(seen)
        self.bits = max(1, int(len(self.symbols) - 1).bit_length()) if len(self.symbols) else 1
        self.place = np.full(START + 1, -1, np.int32)
        self.place[self.symbols] = np.arange(len(self.symbols))
        self.fits = self.bits * ORDER <= 63

    def of_text(self, symbols: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The number of every token with its predecessors, text after text; an object array of ints where 63 bits are too few."""
        x = self.place[symbols].astype(np.int64 if self.fits else object)
        size = len(x) - ORDER + 1
        g = x[:size]
        for k in range(1, ORDER):
            g = (g << self.bits) | x[k:k + size]
        starts, lead = segments(n + ORDER - 1)[:-1], ORDER - 1
        keep = np.ones(len(x), bool)
        for k in range(lead):
            keep[starts + k] = False
        return g[keep[lead:]]

    def of_keys(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        x = [hi >> BITS, hi & LAST, lo >> 2 * BITS, lo >> BITS & LAST, lo & LAST]
        g = np.zeros(len(hi), np.int64 if self.fits else object)
        for c in x:
            g = (g << self.bits) | self.place[c].astype(g.dtype)
        return g

    def keys(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first two symbols, last three symbols) of n-grams given as numbers."""
        mask = (1 << self.bits) - 1
        x = [self.symbols[((g >> self.bits * (ORDER - 1 - k)) & mask).astype(np.int64)] for k in range(ORDER)]
        return x[0] << BITS | x[1], x[2] << 2 * BITS | x[3] << BITS | x[4]


def _chunked(chunk: int):
    def run(batches):
        number, used, at = TaskContext.get().partitionId() << 32, 0, 0
        for b in batches:
            for first, part in slices(b.column(1), min(chunk, 1_000_000)):
                size = sum(len(t or b"") for t in part)
                if used and used + size > chunk:
                    number, used, at = number + 1, 0, 0
                used += size
                ids, m = b.column(0).slice(first, len(part)), len(part)
                packed = [pa.compress(t or b"", "zstd", asbytes=True) for t in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, number)), pa.array(np.arange(at, at + m)), ids, pa.array(packed, pa.binary()), pa.array([len(t or b"") for t in part], pa.int64())],
                    names=["chunk", "at", "doc_id", "z", "size"])
                at += m
    return run


def _parts(texts: pa.Table, limit: int = 1_000_000):
    """(first row, texts) of a chunk, unpacked about ``limit`` bytes at a time."""
    sizes = texts.column("size").to_numpy()
    ends, at = np.cumsum(sizes), 0
    packed = texts.column("z").combine_chunks()
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right")))
        yield at, [pa.decompress(z, n, "zstd", asbytes=True) if n else b"" for z, n in zip(packed.slice(at, stop - at).to_pylist(), sizes[at:stop].tolist())]
        at = stop


def _counts(texts: pa.Table, goods: pa.Table) -> pa.Table:
    """Distinct n-grams of a chunk, with their counts in good texts (t) and in all (b)."""
    good = np.isin(texts.column("at").to_numpy(), goods.column("at").to_numpy())
    found = []
    for first, part in _parts(texts):
        symbols, n = codes(part)
        if not n.sum():
            continue
        grams = Grams(symbols)
        g = grams.of_text(symbols, n)
        mine = np.repeat(good[first:first + len(part)], n)
        key, place = np.unique(g, return_inverse=True)
        hi, lo = grams.keys(key)
        found.append(pd.DataFrame({"hi": hi, "lo": lo, "t": np.bincount(place[mine], minlength=len(key)), "b": np.bincount(place, minlength=len(key))}))
        if len(found) > 8:
            found = [pd.concat(found).groupby(["hi", "lo"], as_index=False, sort=False).sum()]
    out = pd.concat(found).groupby(["hi", "lo"], as_index=False, sort=False).sum() if found else pd.DataFrame({c: np.empty(0, np.int64) for c in ("hi", "lo", "t", "b")})
    give_back()
    chunk = np.full(len(out), texts.column("chunk")[0].as_py() if len(texts) else 0, np.int64)
    return pa.table({"chunk": chunk, **{c: out[c].to_numpy().astype(np.int64) for c in ("hi", "lo", "t", "b")}})


def _masked(column: str, symbols: int):
    return F.col(column).bitwiseAND(F.lit((1 << symbols * BITS) - 1).cast("long"))


def losses(cells: DataFrame) -> DataFrame:
    """(hi, lo, lt, lb): -log p(last symbol | those before) under target and background; each context's counts are
    smoothed with the next shorter context, down to single symbols and a flat estimate."""
    def summed(df, by, suffix=""):
        return df.groupBy(*by).agg(*(F.sum(c).alias(f"{c}{suffix}") for c in "tb"))

    grams = {ORDER: land(summed(cells.select("hi", "lo", "t", "b"), ("hi", "lo")), "n-grams")}
    # The n-grams of each shorter order, keyed alike: symbols they lack are zero.
    for k in range(ORDER - 1, 0, -1):
        hi, lo = (_masked("hi", k - 3) if k > 3 else F.lit(0).cast("long")), (F.col("lo") if k >= 3 else _masked("lo", k))
        grams[k] = summed(grams[k + 1].select(hi.alias("hi"), lo.alias("lo"), "t", "b"), ("hi", "lo"))
    total = grams[1].agg(F.count("*").alias("v"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in "tb")).first()
    v = max(VOCABULARY, total.v)
    known = grams[1].select("hi", "lo", *(((F.col(c) + PRIORS[0] / v) / (total[c] + PRIORS[0])).alias(f"{c}p") for c in "tb"))
    for k in range(2, ORDER + 1):
        prior = PRIORS[k - 1]
        g = grams[k].select("hi", "lo", "t", "b", F.shiftright("lo", BITS).alias("context"),
                            (_masked("hi", k - 4) if k > 4 else F.lit(0).cast("long")).alias("hi2"),
                            (F.col("lo") if k > 3 else _masked("lo", k - 1)).alias("lo2"))
        contexts = summed(g, ("hi", "context"), "c")
        shorter = known.select(F.col("hi").alias("hi2"), F.col("lo").alias("lo2"), "tp", "bp")
        known = g.join(contexts, ["hi", "context"]).join(shorter, ["hi2", "lo2"]).select(
            "hi", "lo", *(((F.col(c) + prior * F.col(f"{c}p")) / (F.col(f"{c}c") + prior)).alias(f"{c}p") for c in "tb"))
    return known.select("hi", "lo", (-F.log("tp")).alias("lt"), (-F.log("bp")).alias("lb"))


def _score(texts: pa.Table, model: pa.Table) -> pa.Table:
    hi, lo = (model.column(c).to_numpy() for c in ("hi", "lo"))
    every = np.concatenate([x & LAST for x in (hi >> BITS, hi, lo >> 2 * BITS, lo >> BITS, lo)])
    grams = Grams(every)
    index = pd.Index(grams.of_keys(hi, lo))
    tables = [model.column(c).to_numpy() for c in ("lt", "lb")]
    ids, out = texts.column("doc_id").combine_chunks(), []
    for first, part in _parts(texts):
        symbols, n = codes(part)
        at = index.get_indexer(grams.of_text(symbols, n)) if n.sum() else np.empty(0, np.int64)
        ends, none, sums = segments(n), n == 0, []
        for t in tables:
            run_ = np.concatenate([[0.0], np.cumsum(t[at], dtype=np.float64)])
            sums.append((run_[ends[1:]] - run_[ends[:-1]]) / np.maximum(n, 1))
        out.append(pa.RecordBatch.from_arrays([ids.slice(first, len(part)), pa.array(n), pa.array(sums[0], mask=none), pa.array(sums[1], mask=none)],
                                              names=["doc_id", "n_tokens", "loss_target", "loss_background"]))
    kinds = zip(("doc_id", "n_tokens", "loss_target", "loss_background"), (pa.int64(), pa.int64(), pa.float64(), pa.float64()))
    give_back()
    return pa.Table.from_batches(out, pa.schema(list(kinds)))


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", good: str = "quality",
                             chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_tokens, loss_target, loss_background, score) of every document."""
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    texts = land(tasks(src, _chunked(chunk), "chunk long, at long, doc_id long, z binary, size long"), "chunks")
    known = labels.where(F.col(good) == 1).select(F.col(doc_id).cast("long").alias("doc_id")).distinct()
    goods = texts.select("chunk", "at", "doc_id").join(known, "doc_id").select(F.col("chunk").alias("of"), F.col("at").alias("at"))
    cells = land(texts.select("chunk", "at", "z", "size").groupBy("chunk").cogroup(goods.groupBy("of"))
                 .applyInArrow(_counts, "chunk long, hi long, lo long, t long, b long"), "cells")
    hits = cells.select("chunk", "hi", "lo").join(losses(cells), ["hi", "lo"]).select("chunk", "hi", "lo", "lt", "lb")
    out = (texts.select("chunk", "doc_id", "z", "size").groupBy("chunk").cogroup(hits.groupBy("chunk"))
           .applyInArrow(_score, "doc_id long, n_tokens long, loss_target double, loss_background double"))
    return out.withColumn("score", F.col("loss_target") - F.col("loss_background"))


def op7_cross_entropy_difference(spark, sf_dir: str) -> DataFrame:
    return cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
