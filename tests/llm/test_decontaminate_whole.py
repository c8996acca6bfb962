"""Decontamination of texts shorter than an item, against every window without a limit on the difference."""

import random

from vaultkit.llm import decontaminate as D
from vaultkit.llm.shingles import grams, word_hashes, words


def brute(rows, items, similarity=0.8):
    index = D.Items(items)
    out = {}
    for item, t in items:
        g = word_hashes(words(t.encode()))
        bag = {}
        for a in grams(g).tolist():
            bag[a] = bag.get(a, 0) + float(index.weight(grams(g)[grams(g) == a][:1])[0])
        for doc, text in rows:
            h = word_hashes(words(text.encode()))
            k = min(5, len(g))
            if len(h) < k:
                continue
            w = grams(h, k)
            span = min(len(g), len(h)) - k + 1
            best = max(index.similarity(bag, w[i:i + span]) for i in range(len(w) - span + 1))
            if best >= similarity:
                out[doc, item] = round(best, 6)
    return out


def test_texts_much_shorter_than_the_item(spark):
    rng = random.Random(5)
    items = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(n))) for i, n in enumerate((50, 59, 100, 200))]
    cuts = [(0, 41), (0, 40), (1, 49), (2, 91), (2, 82), (2, 81), (2, 80), (3, 165), (3, 161), (3, 150)]
    rows = [(d, " ".join(items[i][1].split()[:n])) for d, (i, n) in enumerate(cuts)]
    got = {(r.doc_id, r.item_id): round(r.similarity, 6) for r in D.contaminated(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute(rows, items)
    assert got == want
    assert {(0, 0), (2, 1), (3, 2), (5, 2), (7, 3)} <= set(got) and (9, 3) not in got


def test_blocks_do_not_change_results(spark):
    rng = random.Random(6)
    # A common opening gives its shingles a low weight: similarities then depend on counts over all items.
    opening = " ".join(f"c{k}" for k in range(14))
    items = [(i, opening + " " + " ".join(f"w{rng.randrange(2000)}" for _ in range(rng.randint(16, 40)))) for i in range(40)]
    items += [(40, items[0][1]), (41, items[1][1]), (42, ""), (43, "just three words")]
    rows = []
    for d in range(120):
        ws = items[d % 40][1].split()
        for _ in range(d // 40):
            ws[rng.randrange(len(ws))] = f"new{rng.randrange(99)}"
        rows.append((d, " ".join([f"x{rng.randrange(99)}" for _ in range(rng.randrange(9))] + ws + ["x"] * (d % 5))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one, some = (sorted(map(tuple, D.contaminated(docs, bench, block=b).collect())) for b in (5000, 7))
    assert one == some and 40 < len(one)
    assert {(d, i): round(s, 6) for d, i, _, _, _, s in one} == brute(rows, [x for x in items if x[1]])
