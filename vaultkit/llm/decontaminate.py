"""Benchmark decontamination by SimHash of item-sized windows (operator 6).

Items and windows are bags of five-word shingles, weighted by rarity among the items. Windows have
an item's own number of words, or are the whole text where it has fewer; a window that shares no shingle
with any item of its size cannot pass the exact check, so fingerprints are made only around shared shingles.
A text shorter than an item is left out only if all its shingles weigh too little to reach the similarity. A window's 64-bit SimHash is the sign
of a sum of +-weight vectors, read off prefix sums. Multi-index lookup: the 64 bits form eight blocks
of 8; within Hamming distance ``RADIUS`` at least one block differs in at most ``RADIUS // 8`` bits,
and the index lists, per block value, every item that close. So all windows within the radius are
candidates, and exact weighted-shingle similarity (sum of minima over sum of maxima) verifies them.

Items come to the driver in blocks of about ``ITEMS`` rows; each block is one pass over the documents,
so no index (some 2 kB an item) grows past its bound. Weights are those of the whole benchmark in every block:
with several blocks Spark counts the items of each shingle once, and the shingles of two or more items (16 bytes
each; all others weigh the same) go to all tasks. So results do not depend on the blocks. Defined cases: null or empty texts and items match nothing; an item
of fewer than five words is one shingle, its whole run; repeated items and rows give their own rows;
either table empty gives no rows; other columns are ignored; a null id is reported as null.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultkit.llm.common import fresh, land, share, shared_value, slices, table, tasks
from vaultkit.llm.shingles import SHINGLE, SIMILARITY, grams, shingle_set, word_hashes, words

RADIUS = 23           # at similarity 0.8 the expected distance is 10 with deviation 3
BLOCKS, WIDTH = 8, 8
ITEMS = 5_000         # items of one index

OUT = "doc_id long, item_id long, start_word int, n_words int, hamming int, similarity double"


def _mix(x: np.ndarray, k: int) -> np.ndarray:
    x = x * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(k)
    return x ^ (x >> np.uint64(29))


def signs(shingle: np.ndarray) -> np.ndarray:
    """n x 64 matrix of +1 / -1 from the bits of mixed shingle hashes."""
    bits = np.unpackbits(_mix(shingle, 17).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int64) * 2 - 1


def pack(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1).view(np.uint64).ravel()


class Weights:
    """Rarity of shingles among ``total`` items; ``known`` holds at least those of two or more items, with their counts."""

    def __init__(self, known: np.ndarray, df: np.ndarray, total: int):
        self.rare = round(1000 * math.log(1 + max(1, total)))    # of a shingle in one item or in none
        order = np.argsort(known[df > 1])
        self.known, df = known[df > 1][order], df[df > 1][order]
        # Whole thousandths: prefix sums are exact, so equal windows have equal fingerprints.
        self.weights = np.rint(1000 * np.log(1 + total / df)).astype(np.int64)

    def __call__(self, g: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(g), self.rare, np.int64)
        k = np.minimum(np.searchsorted(self.known, g), len(self.known) - 1)
        return np.where(self.known[k] == g, self.weights[k], self.rare)


class Index:
    """Items of one number of shingles' words, with multi-index tables per block."""

    def __init__(self, items: list[tuple[int, np.ndarray]], size: int, weight):
        self.size, self.k = size, min(SHINGLE, size)
        self.ids = [i for i, _ in items]
        self.bags = [dict(zip(*np.unique(s, return_counts=True))) for _, s in items]
        self.bags = [{int(g): float(weight(np.array([g], np.uint64))[0]) * int(n) for g, n in b.items()} for b in self.bags]
        self.least = min(sum(b.values()) for b in self.bags)
        self.prints = np.concatenate([pack((signs(s) * weight(s)[:, None]).sum(0)[None]) for _, s in items])
        self.tables = []
        masks = [0]
        for r in range(1, RADIUS // BLOCKS + 1):
            masks += [sum(1 << b for b in c) for c in itertools.combinations(range(WIDTH), r)]
        masks = np.array(masks, np.int64)
        for block in self.prints.view(np.uint8).reshape(-1, BLOCKS).T:
            values = (block.astype(np.int64)[:, None] ^ masks[None, :]).ravel()
            owner = np.repeat(np.arange(len(items), dtype=np.int32), len(masks))
            order = np.argsort(values, kind="stable")
            self.tables.append((np.searchsorted(values[order], np.arange((1 << WIDTH) + 1)), owner[order]))

    def candidates(self, prints: np.ndarray):
        """(window, item) pairs within RADIUS, each once."""
        pairs = []
        for block, (starts, owner) in zip(prints.view(np.uint8).reshape(-1, BLOCKS).T, self.tables):
            lo, n = starts[block], starts[block.astype(np.int64) + 1] - starts[block]
            w = np.repeat(np.arange(len(prints)), n)
            pairs.append(w * len(self.ids) + owner[np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)])
        pairs = np.unique(np.concatenate(pairs))
        w, i = pairs // len(self.ids), pairs % len(self.ids)
        far = np.unpackbits((prints[w] ^ self.prints[i]).view(np.uint8).reshape(-1, 8), axis=1).sum(1)
        near = far <= RADIUS
        return zip(w[near].tolist(), i[near].tolist(), far[near].tolist())


class Items:
    """What a task needs of a block of items: shared shingles, their weights (by default of these items), one index per item size."""

    def __init__(self, rows: list[tuple[int, str]], weight: Weights | None = None):
        sized: dict[int, list] = {}
        for item, text in rows:
            h = word_hashes(words((text or "").encode()))
            if len(h):
                sized.setdefault(len(h), []).append((item, grams(h)))
        every = [np.unique(s) for group in sized.values() for _, s in group]
        self.known, df = np.unique(np.concatenate(every) if every else np.empty(0, np.uint64), return_counts=True)
        self.weight = weight or Weights(self.known, df, len(every))
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.known & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.indexes = [Index(g, size, self.weight) for size, g in sorted(sized.items())]
        # Which indexes hold each known shingle, listed shingle after shingle.
        pairs = [(np.unique(np.concatenate([s for _, s in g])), n) for n, (_, g) in enumerate(sorted(sized.items()))]
        flat = np.concatenate([p for p, _ in pairs]) if pairs else np.empty(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.holds = np.concatenate([np.full(len(p), n, np.int32) for p, n in pairs])[order] if pairs else np.empty(0, np.int32)
        self.holds_at = np.searchsorted(flat[order], self.known, side="left")
        self.holds_n = np.searchsorted(flat[order], self.known, side="right") - self.holds_at

    def where(self, g: np.ndarray) -> dict[int, np.ndarray]:
        """Index number -> positions of the shingles that some item of this index has."""
        at = np.flatnonzero(self.bits[(g & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if not len(at):
            return {}
        k = np.minimum(np.searchsorted(self.known, g[at]), len(self.known) - 1)
        ok = self.known[k] == g[at]
        at, k = at[ok], k[ok]
        n = self.holds_n[k]
        row = np.repeat(self.holds_at[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        owner, at = self.holds[row], np.repeat(at, n)
        return {int(o): at[owner == o] for o in np.unique(owner)}

    def search(self, h: np.ndarray, similarity: float):
        """Best window per item in a text of word hashes ``h``: {item row: (similarity, start, size, hamming)}."""
        best: dict[tuple, tuple] = {}
        todo, weighs = [], {}
        for k in sorted({ix.k for ix in self.indexes}):
            if len(h) >= k:
                g = grams(h, k)
                weighs[k] = int(self.weight(g).sum())
                todo += [(self.indexes[o], g, at) for o, at in self.where(g).items() if self.indexes[o].k == k]
        for ix, g, hits in todo:
            if ix.size > len(h) and weighs[ix.k] < (similarity - 1e-6) * ix.least:
                continue
            size = min(ix.size, len(h))
            span = size - ix.k + 1                        # shingles of a window
            if span < 1:
                continue
            reach = np.zeros(len(g) + 1, np.int64)        # starts of windows that hold a shared shingle
            np.add.at(reach, np.maximum(hits - span + 1, 0), 1)
            np.add.at(reach, hits + 1, -1)
            starts = np.flatnonzero(np.cumsum(reach[:-1]) > 0)
            starts = starts[starts + span <= len(g)]
            for chunk in np.array_split(starts, len(starts) // 4096 + 1):
                if not len(chunk):
                    continue
                lo, hi = int(chunk[0]), int(chunk[-1]) + span
                part = g[lo:hi]
                sums = np.zeros((len(part) + 1, 64), np.int64)
                np.cumsum(signs(part) * self.weight(part)[:, None], axis=0, out=sums[1:])
                for w, i, far in ix.candidates(pack(sums[chunk - lo + span] - sums[chunk - lo])):
                    s = int(chunk[w])
                    sim = self.similarity(ix.bags[i], g[s:s + span])
                    if sim >= similarity - 1e-6:
                        key = (ix.size, i)
                        if key not in best or (sim, -s) > (best[key][0], -best[key][1]):
                            best[key] = sim, s, size, far, ix.ids[i]
        return best.values()

    def similarity(self, bag: dict[int, float], window: np.ndarray) -> float:
        got, n = np.unique(window, return_counts=True)
        mine = {int(a): float(b) * int(c) for a, b, c in zip(got, self.weight(got), n)}
        low = sum(min(v, bag.get(k, 0.0)) for k, v in mine.items())
        return low / (sum(mine.values()) + sum(bag.values()) - low)


def _item_shingles(batches):
    """Distinct shingles of every item, and a null for the item itself."""
    for b in batches:
        for _, part in slices(b.column(0)):
            sets = [s for s in map(shingle_set, part) if len(s)]
            flat = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(flat), pa.nulls(len(sets), pa.int64())])], names=["g"])


def whole_weights(asked: DataFrame) -> Weights:
    """Weights over all items (column t), counted in Spark."""
    df = tasks(asked.select("t"), _item_shingles, "g long").groupBy("g").agg(F.count(F.lit(1)).alias("df"))
    found = df.where(F.col("g").isNull() | (F.col("df") > 1)).toArrow()
    g, n = found.column("g"), found.column("df").to_numpy()
    none = g.is_null().to_numpy()
    return Weights(g.drop_null().to_numpy().astype(np.int64).view(np.uint64), n[~none], int(n[none].sum()))


def _scan(shared, weight, similarity: float):
    def run(batches):
        items = shared_value(shared)
        items.weight = shared_value(weight)
        for b in batches:
            for first, part in slices(b.column(1)):
                out = []
                for doc, text in zip(b.column(0).slice(first, len(part)).to_pylist(), part):
                    ws = words(text)
                    if ws:
                        out += [(doc, item, s, n, far, sim) for sim, s, n, far, item in items.search(word_hashes(ws), similarity)]
                cols = list(zip(*out)) if out else [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                                 names=["doc_id", "item_id", "start_word", "n_words", "hamming", "similarity"])
    return run


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", similarity: float = SIMILARITY, block: int = ITEMS) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, hamming, similarity): the best window per document and item."""
    spark = docs.sparkSession
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    asked = items.where(F.col(item_text).isNotNull()).select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t"))
    n = asked.count()
    out = None
    weight = whole_weights(asked) if n > block else None
    told = share(spark, weight) if weight else None
    for k in range(max(1, math.ceil(n / block))):
        # A stated query set in blocks: each holds about `block` items, chosen by hash of the item.
        part = asked if n <= block else asked.where(F.pmod(F.xxhash64("i", "t"), F.lit(math.ceil(n / block))) == k)
        held = Items([(r.i, r.t) for r in part.toLocalIterator()], weight)
        told = told or share(spark, held.weight)
        held.weight = None                        # sent once for all blocks
        hits = tasks(src, _scan(share(spark, held), told, similarity), OUT)
        out = hits if out is None else out.union(hits)
    return out


def op6_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go. A row without id is judged by its text, like any other."""
    key, bad = fresh(docs, "dc_key", "dc_gone")
    own = F.xxhash64(F.col("doc_id"), F.col("text"))
    hits = contaminated(docs.select(own.alias(key), "text"), table(spark, sf_dir, "benchmark"), doc_id=key)
    gone = land(hits.select(F.col("doc_id").alias(bad)).distinct(), "contaminated")
    return docs.join(gone, own == F.col(bad), "left_anti").select(*docs.columns)
