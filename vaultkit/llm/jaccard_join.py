"""Chosen-path Jaccard join of five-word shingle sets (operator 3).

Equal sets are folded first; one representative stands for all its copies. A run then splits the
representatives recursively: a node picks one coordinate of their MinHash tokens (and with
probability 1/lambda - 1 a second one), and sets that share the token move on together. Nodes of at
most ``LIMIT`` sets are leaves; larger ones are split again, down to ``DEPTH`` levels. Inside a leaf all
sets are compared: MinHash agreement first, then exact Jaccard of the whole shingle sets.

All runs draw from the same ``TOKENS`` coordinates, so a pair's fate hangs on how many of them agree.
``missed`` averages over that number and counts the pairs whose agreement is too low to be compared;
``runs_for`` repeats runs until a pair at the least similarity is missed with probability 1 - recall at
most, in a node of any depth.

A pair may meet in several leaves; it counts only in the least leaf both visit, so links are exact
without shuffling pairs. Leaves that no path splits (large groups of near copies) are compared in
blocks of ``LIMIT`` x ``LIMIT`` over many tasks. Leaves return per-set counts and spanning edges.

Defined cases: a null text, or one without words, has no shingle, links to nothing and is a class of
its own; fewer than five words make one shingle; rows with equal doc_id and text get equal results; a
null doc_id takes part and gets a row, but is never the id of a class that has another; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultkit.llm.common import fresh, land, slices, table, tasks
from vaultkit.llm.components import components
from vaultkit.llm.shingles import SIMILARITY, shingle_set

TOKENS = 64          # MinHash coordinates a path can choose from
LIMIT = 256          # sets in a leaf, and side of a block
DEPTH = 4
RECALL = 0.9999
SKETCH_SLACK = 0.25  # a pair is verified if its sketch agreement is at least similarity - slack

_SEEDS = np.array([xxhash.xxh3_64_intdigest(f"token {k}") | 1 for k in range(TOKENS)], np.uint64)


def survival(agreement: float, similarity: float, depth: int = DEPTH) -> float:
    """Probability that a pair which agrees on this share of the coordinates shares a leaf after ``depth``
    splits of one run, whose nodes take a second coordinate as the least similarity asks for."""
    q, more = 1.0, 1 / similarity - 1
    for _ in range(depth):
        meet = agreement * q
        q = 1 - (1 - meet) * (1 - more * meet)
    return q


def missed(similarity: float, runs: int, depth: int = DEPTH) -> float:
    """Probability that a pair at the least similarity is not compared, in nodes split ``depth`` times."""
    out = 0.0
    for k in range(TOKENS + 1):
        share = math.comb(TOKENS, k) * similarity ** k * (1 - similarity) ** (TOKENS - k)
        out += share * (1.0 if k < least_agreement(similarity) else (1 - survival(k / TOKENS, similarity, depth)) ** runs)
    return out


def least_agreement(similarity: float) -> int:
    """Coordinates on which a pair must agree to be compared exactly."""
    return math.ceil((similarity - SKETCH_SLACK) * TOKENS)


def runs_for(similarity: float, recall: float = RECALL, depth: int = DEPTH) -> int:
    runs = 1
    while any(missed(similarity, runs, d) > 1 - recall for d in range(1, depth + 1)):
        runs += 1
        if runs > 1000:
            raise ValueError("this recall is out of reach: too many pairs agree on too few coordinates")
    return runs


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (n x TOKENS, int32) of non-empty shingle sets."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), TOKENS), np.uint32)
    for k, a in enumerate(_SEEDS):
        out[:, k] = np.minimum.reduceat(flat * a, starts) >> np.uint64(32)
    return out.view(np.int32)


def _sets(batches):
    for b in batches:
        for first, part in slices(b.column(1)):
            docs = b.column(0).slice(first, len(part))
            sets = [shingle_set(t) for t in part]
            keep = [i for i, s in enumerate(sets) if len(s)]
            bare = [i for i, s in enumerate(sets) if not len(s)]
            sig = signatures([sets[i] for i in keep]) if keep else np.empty((0, TOKENS), np.int32)
            ids = [xxhash.xxh3_128_digest(sets[i].tobytes()) for i in keep] + [None] * len(bare)
            ends = np.minimum(np.arange(len(part) + 1, dtype=np.int32) * TOKENS, sig.size)
            yield pa.RecordBatch.from_arrays(
                [docs.take(pa.array(keep + bare, pa.int64())), pa.array(ids, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sig.ravel(), pa.int32()))],
                names=["doc_id", "id", "sig"])


def _children(path, sig, similarity: float):
    """Paths of the children that a set with ``sig`` joins below ``path``: one coordinate, sometimes two."""
    def child(k):
        i = F.pmod(F.xxhash64(path, F.lit(k)), F.lit(TOKENS)).cast("int")
        return F.xxhash64(path, i, F.element_at(sig, i + 1))
    second = F.pmod(F.xxhash64(path, F.lit(-1)), F.lit(1_000_000)) < F.lit(int(1_000_000 * (1 / similarity - 1)))
    return F.array_distinct(F.when(second, F.array(child(0), child(1))).otherwise(F.array(child(0))))


def leaves(reps: DataFrame, similarity: float, runs: int, limit: int = LIMIT, depth: int = DEPTH) -> DataFrame:
    """(path, id, n): the leaves with at least two sets, over all runs. A set alone in its node has no pair there."""
    roots = F.flatten(F.array(*[_children(F.lit(r).cast("long"), F.col("sig"), similarity) for r in range(runs)]))
    frontier = reps.select("id", F.explode(F.array_distinct(roots)).alias("path"))
    out = None
    for level in range(1, depth + 1):
        frontier = land(frontier, "paths")               # counted, then joined with its counts
        sizes = frontier.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        members = land(frontier.join(sizes, "path"), "path-members")
        leaf = members if level == depth else members.where(F.col("n") <= limit)
        out = leaf if out is None else out.union(leaf)
        big = members.where(F.col("n") > limit)
        if level == depth or big.isEmpty():
            break
        frontier = big.join(reps.select("id", "sig"), "id").select(
            "id", F.explode(_children(F.col("path"), F.col("sig"), similarity)).alias("path")).distinct()
    return out


def _blocks(leaf: DataFrame, limit: int) -> DataFrame:
    """(path, a, b, c, id): every leaf as blocks; a set of chunk c goes to each pair (a, b) of chunks with c."""
    parts = F.ceil(F.col("n") / F.lit(limit)).cast("int")
    c = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    x = leaf.withColumn("parts", parts).withColumn("c", c)
    x = x.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return x.select("path", F.least("c", "o").alias("a"), F.greatest("c", "o").alias("b"), "c", "id")


def _own_pairs(path: int, seen: list[list[int]], chunk: np.ndarray, a: int, b: int) -> np.ndarray:
    """Pairs (upper triangle) that this block counts: across its two chunks, and not met in a lesser leaf."""
    n = len(seen)
    own = np.triu(np.ones((n, n), bool), 1)
    if a != b:
        own &= chunk[:, None] != chunk[None, :]
    where: dict[int, list[int]] = {}
    for i, paths in enumerate(seen):
        for p in paths:
            if p < path:
                where.setdefault(p, []).append(i)
    for members in where.values():
        if len(members) > 1:
            own[np.ix_(members, members)] = False
    return own


def _candidates(similarity: float):
    least = least_agreement(similarity)

    def run(batches):
        for batch in batches:
            out = []
            for path, a, b, sets in zip(*[c.to_pylist() for c in batch.columns[:3]], batch.column(3)):
                v = sets.values
                n = len(v)
                sig = np.asarray(v.field("sig").flatten()).reshape(n, TOKENS)
                chunk = np.asarray(v.field("c"))
                agree = np.zeros((n, n), np.int16)
                for k in range(TOKENS):
                    agree += sig[:, k][:, None] == sig[:, k][None, :]
                near = agree >= least
                if np.triu(near, 1).any():
                    near &= _own_pairs(path, v.field("seen").to_pylist(), chunk, a, b)
                    ids = v.field("id")
                    for i in np.flatnonzero(near.any(0) | near.any(1)):
                        out.append((path, a, b, int(chunk[i]), ids[int(i)].as_py()))
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
                                             names=["path", "a", "b", "c", "id"])
    return run


def similar(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """n x n: exact Jaccard of at least ``similarity``. Shingles are taken some thousand at a time."""
    n = len(sets)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    ids = np.cumsum(np.concatenate([[False], flat[1:] != flat[:-1]]))
    shared = np.bincount(ids)[ids] > 1
    _, ids = np.unique(ids[shared], return_inverse=True)
    owner = owner[shared]
    common = np.zeros((n, n), np.float32)
    step = 4096
    cuts = np.searchsorted(ids, np.arange(0, (ids[-1] + 1 if len(ids) else 0) + step, step))
    for lo, hi, base in zip(cuts, cuts[1:], range(0, len(cuts) * step, step)):
        m = np.zeros((n, step), np.float32)
        m[owner[lo:hi], ids[lo:hi] - base] = 1
        common += m @ m.T
    size = np.array([len(s) for s in sets], np.float64)
    return common >= similarity * (size[:, None] + size[None, :] - common) - 1e-9


def _verify(similarity: float):
    def run(batches):
        for batch in batches:
            out = []
            for path, a, b, sets in zip(*[c.to_pylist() for c in batch.columns[:3]], batch.column(3)):
                v = sets.values
                rows = [np.frombuffer(x.as_py(), np.uint64) for x in v.field("sh")]
                ids = v.field("id").to_pylist()
                link = similar(rows, similarity) & _own_pairs(path, v.field("seen").to_pylist(), np.asarray(v.field("c")), a, b)
                link |= link.T
                root = np.arange(len(ids))
                while True:                                  # least index reachable, by min over neighbours
                    new = np.minimum(root, np.where(link, root[None, :], len(ids)).min(1))
                    new = new[new]
                    if (new == root).all():
                        break
                    root = new
                for i in np.flatnonzero(link.any(1)):
                    out.append((ids[i], int(link[i].sum()), ids[root[i]]))
            cols = list(zip(*out)) if out else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.binary()))], names=["id", "n", "root"])
    return run


def _texts_to_sets(batches):
    for b in batches:
        for first, part in slices(b.column(1)):
            sets = [shingle_set(t) for t in part]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary()),
                 b.column(0).slice(first, len(part))], names=["id", "sh", "want"])


def jaccard_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                    recall: float = RECALL, limit: int = LIMIT) -> DataFrame:
    """(doc_id, set_id, class_id, n_links) for every row of ``docs``.

    ``class_id``: least doc_id connected by links or equal sets; ``n_links``: other sets with at least this similarity.
    """
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = land(tasks(src, _sets, "doc_id long, id binary, sig array<int>"), "shingle-sets")
    reps = land(sets.where("id IS NOT NULL").groupBy("id").agg(F.min("doc_id").alias("rep"), F.any_value("sig").alias("sig")), "set-reps")
    leaf = leaves(reps, similarity, runs_for(similarity, recall), limit)
    seen = leaf.groupBy("id").agg(F.collect_set("path").alias("seen"))       # at most runs * 2^DEPTH paths a set
    block = _blocks(leaf, limit)
    struct = F.struct("id", "c", "seen", "sig")
    close = land(block.join(seen, "id").join(reps.select("id", "sig"), "id").groupBy("path", "a", "b").agg(F.collect_list(struct).alias("s"))
                 .mapInArrow(_candidates(similarity), "path long, a int, b int, c int, id binary"), "path-candidates")
    want = close.select("id").distinct().join(reps.select("id", "rep"), "id")
    texts = src.join(want.select(F.col("id").alias("want"), "rep"), F.col("doc_id").eqNullSafe(F.col("rep")))
    sh = land(tasks(texts.select("want", "text"), _texts_to_sets, "id binary, sh binary, want binary").where("id = want")
              .dropDuplicates(["id"]).select("id", "sh"), "candidate-sets")
    struct = F.struct("id", "c", "seen", "sh")
    links = land(close.join(seen, "id").join(sh, "id").groupBy("path", "a", "b").agg(F.collect_list(struct).alias("s"))
                 .mapInArrow(_verify(similarity), "id binary, n long, root binary"), "links")
    roots = components(links.select(F.col("id").alias("u"), F.col("root").alias("v")))
    counted = links.groupBy("id").agg(F.sum("n").alias("n_links"))
    named = reps.select("id", "rep").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    named = named.join(least, "root").join(counted, "id", "left").select(
        "id", F.col("rep").alias("set_id"), "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    # Documents meet their set's row: a set with very many copies is the hot side, which AQE splits.
    known = sets.select("doc_id", "id").join(named, "id").select("doc_id", "set_id", "class_id", "n_links")
    bare = sets.where("id IS NULL").select(
        "doc_id", F.col("doc_id").alias("set_id"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return known.union(bare)


def op3_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each class stays, the one with the least doc_id (a null id comes last), the
    first of equal ones. Every row is judged by its own text: repeated rows and rows without id are members
    of classes like others, and rows that share an id go or stay apart. Rows without a word all stay."""
    row, copy = fresh(docs, "jj_row", "jj_copy")
    d = land(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    c = land(jaccard_classes(d, doc_id=row).select(F.col("doc_id").alias("jj_member"), F.col("class_id").alias("jj_class")), "classes")
    own = d.select(F.col(row).alias("jj_member"), F.col("doc_id").cast("long").alias("jj_doc"))
    first = c.join(own, "jj_member").groupBy("jj_class").agg(F.min(F.struct(F.col("jj_doc").isNull().alias("no"), "jj_doc", "jj_member")).alias("jj_first"))
    first = land(first.select("jj_class", F.col("jj_first.jj_member").alias("jj_stays")), "first-of-class")
    gone = land(c.join(first, "jj_class").where("jj_member != jj_stays").select(F.col("jj_member").alias(copy)), "copies")
    return d.join(gone, F.col(row) == F.col(copy), "left_anti").select(*docs.columns)
