"""Base columns against plain Python, sketches against exact quantiles, verdicts against labels."""

import re

import numpy as np
from pyspark.sql import functions as F

from vaultkit.llm import quality_rules as Q


def base(text):
    t = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines, seen, dup = t.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    windows = {}
    for i in range(len(ws) - 7):
        windows.setdefault(tuple(ws[i:i + 8]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


def test_base_columns(spark, texts):
    rows = Q.op8_quality_rules(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_odd_texts():
    for t in ("a b\x0b c\x0cd\re\x1cf g  h\x85i", "x\n\n x\nx\nx ", "w " * 9, "a b c d e f g h " * 2, "é🙂 # ||", " ", "a b c", "|" * 30):
        assert Q.text_counts(t.encode())[:5] == base(t), t


def test_sketch_quantiles_and_merge_order(spark):
    rng = np.random.default_rng(0)
    rows = [(f"s{k % 3}", float(x)) for k, x in enumerate(rng.lognormal(0, 2, 6000))]
    df = spark.createDataFrame(rows, "source string, x double")
    q = df.select(F.struct(F.lit("en").alias("lang"), "source", F.lit(5).alias("n_words"), *[F.col("x").alias(r) for r in Q.RATIOS]).alias("q_"))
    bins = Q.sketches(q)
    halves = Q.sketches(q.where("q_.symbol_ratio < 1")).union(Q.sketches(q.where("q_.symbol_ratio >= 1")))
    keys = ["lang", "source", "ratio"]
    a, b = [{tuple(r[k] for k in keys): (r.v0, r.v1) for r in Q.quantiles(x, keys).collect()} for x in (bins, halves)]
    assert a == b
    for (_, source, _), (v0, v1) in a.items():
        x = np.sort([v for s, v in rows if s == source])
        for q_, v in ((Q.LOW_Q, v0), (Q.HIGH_Q, v1)):
            exact = x[int(np.ceil(q_ * len(x))) - 1]
            assert abs(v - exact) <= 1.01 * Q.ALPHA * exact


def test_clean_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    r = Q.op8_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    n = {(x.quality, x.kept): x["count"] for x in r.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) == 0 and n.get((0, True), 0) <= 0.05 * n.get((0, False), 0)


def plain_fences(rows):
    """{(lang, source): {ratio: fence}} by sorted values instead of sketches."""
    groups = {}
    for lang, source, ratios in rows:
        groups.setdefault((lang, source), []).append(ratios)
    every = [r for g in groups.values() for r in g]
    q = lambda xs, p: sorted(xs)[max(0, int(np.ceil(p * len(xs))) - 1)]
    top = lambda lo, hi, r: hi + Q.FENCE * max(hi - lo, Q.SPREAD[r])
    out = {}
    for key, g in groups.items():
        out[key] = {}
        for r in Q.RATIOS:
            e = [q([x[r] for x in every], p) for p in (Q.LOW_Q, Q.HIGH_Q)]
            v = [q([x[r] for x in g], p) for p in (Q.LOW_Q, Q.HIGH_Q)]
            lo, hi = [(len(g) * a + Q.WEIGHT * b) / (len(g) + Q.WEIGHT) for a, b in zip(v, e)]
            out[key][r] = min(top(lo, hi, r), Q.CEILING * top(*e, r))
    return out


def ratios_of(text):
    n, chars, symbols, dup, _ = base(text)
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    stutter = sum(a == b for a, b in zip(ws, ws[1:]))
    return {"symbol_ratio": symbols / max(n, 1), "dup_line_ratio": dup / max(len(lines), 1), "stutter_ratio": stutter / max(n, 1), "word_length": chars / max(n, 1)}


def test_verdicts_equal_a_plain_version(spark):
    """``kept`` of every document against fences from sorted values; a text whose ratio lies within the sketch's error of its fence may differ."""
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    ratios = {r.doc_id: ratios_of(r.text) for r in rows}
    fence = plain_fences([(r.lang, r.source, ratios[r.doc_id]) for r in rows if base(r.text)[0]])
    kept = {r.doc_id: r.kept for r in Q.op8_quality_rules(spark, sf).collect()}
    differ = 0
    for r in rows:
        n = base(r.text)
        failed = n[0] < 20 or 100 * n[4] > 30 * n[0]
        over = {k: ratios[r.doc_id][k] / fence[r.lang, r.source][k] for k in Q.RATIOS} if n[0] else {}
        if any(abs(x - 1) < 5 * Q.ALPHA for x in over.values()):
            continue
        want = not failed and not any(x > 1 for x in over.values())
        assert kept[r.doc_id] == want, (r.doc_id, over)
        differ += want
    assert 0 < differ < len(rows)


def _table(spark, sources):
    rows = [(t, s) for s, ts in sources.items() for t in ts]
    return spark.createDataFrame([(i, t, "en", s) for i, (t, s) in enumerate(rows)], "doc_id long, text string, lang string, source string")


PLAIN = [" ".join(f"w{j}x{k}" for j in range(40)) for k in range(300)]
JUNK = ["ab|cd|ef#$% " * 3 + " ".join(f"u{k}|*$ v{j}" for j in range(25)) for k in range(200)]


def test_a_source_with_much_junk_does_not_vouch_for_it(spark):
    """Two in five texts of one source are symbol junk that passes the base rule."""
    df = _table(spark, {"good": PLAIN, "bad": PLAIN[:120] + JUNK[:80]})
    kept = Q.judge(df).where("q_kept")
    assert kept.where("text like '%|%'").count() == 0 and kept.count() == 420


def test_group_size_has_no_step(spark):
    """One text more or less moves a fence a little, at any size."""
    tops = []
    for n in (98, 99, 100, 101):
        df = _table(spark, {"good": PLAIN * 2, "other": [" ".join(f"longerword{j}number{k}" for j in range(40)) for k in range(n)]})
        tops.append(next(r.top_word_length for r in Q.fences(Q.sketches(Q.measured(df))).collect() if r.source == "other"))
    assert max(tops) - min(tops) < 0.05 * max(tops) and len(set(tops)) == 4


def test_edge_rows(spark, edge, empty):
    j = Q.judge(edge)
    assert j.count() == edge.count() and set(edge.columns) <= set(j.columns)
    bad = {r.doc_id for r in j.where("q_base_failed").collect()}
    assert {2, 3, 4, 6} <= bad
    assert Q.judge(empty).count() == 0
    clash = _table(spark, {"good": PLAIN[:30]}).unionByName(edge.select("doc_id", "text", "lang", "source")).selectExpr("*", "1 AS q_", "2 AS Q_C", "3 AS q_kept", "4 AS q_top", "5 AS q_g", "6 AS q_kept_aside")
    kept = Q.stage(None, clash, None)
    assert kept.columns == clash.columns and kept.count() == 30
    assert {tuple(r) for r in kept.select("q_", "Q_C", "q_kept", "q_top", "q_g", "q_kept_aside").collect()} == {(1, 2, 3, 4, 5, 6)}
