"""Chosen-path join against all pairs."""

import random

import numpy as np
import pytest

from vaultkit.llm import jaccard_join as J
from vaultkit.llm.components import components
from vaultkit.llm.shingles import shingle_set


def brute(rows, similarity=0.8):
    """{doc_id: (class_id, links)} by comparing all different shingle sets."""
    sets = {d: frozenset(shingle_set((t or "").encode()).tolist()) for d, t in rows}
    reps = sorted({s for s in sets.values() if s}, key=lambda s: min(d for d in sets if sets[d] == s))
    name = {s: min(d for d in sets if sets[d] == s) for s in reps}
    root = {s: s for s in reps}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    links = dict.fromkeys(reps, 0)
    for i, a in enumerate(reps):
        for b in reps[i + 1:]:
            both = len(a & b)
            if both and both >= similarity * (len(a) + len(b) - both) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)), key=lambda s: name[s])
                root[y] = x
    return {d: (name[find(s)], links[s]) if s else (d, 0) for d, s in sets.items()}


def as_dict(df):
    return {r.doc_id: (r.class_id, r.n_links) for r in df.collect()}


def test_equals_all_pairs(spark, docs, texts):
    assert as_dict(J.op3_jaccard_join(spark, "/root/testdata/sf0.001")) == brute(texts.items())


def _near_copies(n, seed=3, words=120):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for i in range(n):
        t = list(base)
        for _ in range(rng.randrange(4)):
            t[rng.randrange(words)] = f"x{rng.randrange(5000)}"
        out.append((i, " ".join(t)))
    return out


@pytest.mark.parametrize("limit", [4, 16, 256])
def test_large_group_of_near_copies_with_small_leaves(spark, limit):
    rows = _near_copies(70) + [(100 + i, " ".join(f"v{i}_{k}" for k in range(30))) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_dict(J.jaccard_classes(df, limit=limit)) == brute(rows)


def test_copies_are_folded(spark):
    rows = [(i, "a b c d e f g h") for i in range(500)] + [(900, "A, b c d e f g h!")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {v for v in as_dict(J.jaccard_classes(df)).values()} == {(0, 0)}


def test_edge_rows(spark, edge, empty):
    got = J.jaccard_classes(edge).collect()
    assert len(got) == edge.count()
    assert all(r.class_id == r.doc_id and r.n_links == 0 for r in got if r.doc_id in (2, 3, 4, 6))
    assert J.jaccard_classes(empty).count() == 0
    kept = J.stage(spark, edge, None)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 1         # of the repeated row one stays
    assert J.stage(spark, empty, None).count() == 0


def test_stage_keeps_one_of_each_class(spark):
    rows = _near_copies(20) + [(50, "a b c d e f"), (51, "a b c d e f"), (None, "a b c d e f"), (None, "a b c d e f"), (51, "a b c d e f")]
    rows += [(3, "a clean text under the id of a copy"), (60, "no id has this one"), (None, "no row with an id has this one"), (None, "no row with an id has this one")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS jj_row", "2 AS jj_member", "3 AS jj_class")
    kept = sorted(map(tuple, J.stage(spark, df, None).select("doc_id", "text").collect()), key=str)
    first = {c for c, _ in brute(rows[:20]).values()}
    want = [r for r in rows[:20] if r[0] in first] + [rows[20], *rows[25:28]]
    assert kept == sorted(want, key=str)


def test_runs_reach_the_recall():
    runs = J.runs_for(0.8)
    assert max(J.missed(0.8, runs, d) for d in range(1, J.DEPTH + 1)) <= 1 - J.RECALL < J.missed(0.8, runs - 1)
    # Runs drawn independently of each other would miss less than the same coordinates drawn again.
    assert J.missed(0.8, runs) > (1 - J.survival(0.8, 0.8)) ** runs
    with pytest.raises(ValueError):
        J.runs_for(0.8, 1 - 1e-9)


@pytest.mark.parametrize("depth", [1, 2, 3, 4])
def test_recall_of_planted_pairs_in_nodes_split_to_a_depth(spark, depth):
    """3,000 pairs at similarity 0.8; with a limit of one set every node is split ``depth`` times."""
    rng = np.random.default_rng(depth)
    n = 3000
    a = rng.integers(0, 1 << 30, (n, J.TOKENS))
    b = np.where(rng.random((n, J.TOKENS)) < 0.8, a, rng.integers(0, 1 << 30, (n, J.TOKENS)))
    rows = [(2 * i + k, sig.tolist()) for i in range(n) for k, sig in ((0, a[i]), (1, b[i]))]
    reps = spark.createDataFrame(rows, "id long, sig array<int>").repartition(8)
    found = {}
    for runs in (1, J.runs_for(0.8)):
        leaf = J.leaves(reps, 0.8, runs, limit=1, depth=depth)
        pairs = leaf.selectExpr("path", "id DIV 2 AS pair").groupBy("path", "pair").count().where("count = 2")
        found[runs] = pairs.select("pair").distinct().count() / n
    assert 0.4 < found[1] < 0.97                # one run has one root: its coordinates are the same for all pairs
    assert found[J.runs_for(0.8)] >= 0.998


def test_similar_is_exact_over_many_shingles():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, 6000).astype(np.uint64)) for _ in range(4)] + [np.arange(k, 10000 + k, dtype=np.uint64) for k in (0, 900, 1200)]
    got = J.similar(sets, 0.8)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert got[i, j] == (both >= 0.8 * (len(a) + len(b) - both))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 101), (103, 102), (102, 103)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 102, 103: 102}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
