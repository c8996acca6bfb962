"""Secret scan by character Markov models (operator 5), DataFrame functions only.

Base spans come from three patterns. The method then scores every long run of identifier characters
by the log-likelihood ratio of two first-order character models: one of random strings, trained on
the values that the base patterns label, one of ordinary identifiers, trained on the words around
them. Runs above the threshold that hold no base span are added as kind ``markov``.

Positions are code points, end exclusive. Spark's functions give matches, not positions, so starts
are running sums over the pieces between matches and the matches themselves. A text of n matches takes
n log n steps, also where runs are held against base spans.

Training uses a bounded sample, about ``SAMPLE`` documents chosen by hash of the id; every text is
scanned whole. Defined cases: a null text counts as empty and has no span; repeated rows give
repeated rows; an empty table gives no rows; with no random string in the sample both models are
flat and nothing is added; other columns are ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultkit.llm.common import table

# The base patterns and least lengths.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"          # runs of AKIA[A-Z0-9]+ with 18 characters or more
HEX = r"[0-9a-f]{16,}"                 # runs of [0-9a-f]+ with 16 characters or more
KINDS = ["assign", "access", "hex", "markov"]

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-"
RUN = r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}"
WORD = r"(?<![A-Za-z0-9+/_.=-])[A-Za-z][A-Za-z_.-]{5,}"
SAMPLE = 20_000                        # documents of the training sample, about
ORDINARY = 10                          # one in so many of them gives ordinary words
THRESHOLD = 8.0                        # natural log of the odds that a run must have


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _running(values: Column, join: Callable[[Column, Column], Column], neutral: int) -> Column:
    """Running sums (or maxima, by ``join``) of an array of ints: every step joins each value with the one 1, 2, 4, ...
    places before, so an array of n takes log n passes and no array grows value by value."""
    n = F.size(values)
    steps = F.sequence(F.lit(0), F.greatest(F.ceil(F.log2(n.cast("double"))).cast("int") - 1, F.lit(0)))

    def step(acc, k):
        by = F.least(F.pow(F.lit(2.0), k).cast("int"), n)
        before = F.concat(F.array_repeat(F.lit(neutral), by), F.slice(acc, F.lit(1), n - by))
        return F.zip_with(acc, before, join)

    return F.when(n > 1, F.aggregate(steps, values, step)).otherwise(values)


def _positions(text: Column, pattern: str) -> Column:
    """array<struct<start,end,text>> of the leftmost non-overlapping matches."""
    def placed(found):
        moves = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda gap, m: F.length(gap) + F.length(m))
        ends = _let(moves, lambda v: _running(v, lambda a, b: a + b, 0))
        return F.zip_with(ends, found, lambda end, m: F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("text")))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _apart(runs: Column, base: Column) -> Column:
    """The runs that no span of ``base`` overlaps.

    Runs, by their end, and base spans, by their start, are put in one order; a run overlaps if the
    greatest end among the spans that start before its end lies behind its start."""
    none = F.lit(None).cast("struct<start:int,end:int,text:string>")
    asked = F.transform(runs, lambda r: F.struct(r["end"].alias("at"), F.lit(0).alias("span"), F.lit(-1).alias("end"), r.alias("run")))
    spans = F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("span"), b["end"].alias("end"), none.alias("run")))

    def judged(rows):
        ends = _let(F.transform(rows, lambda x: x["end"]), lambda v: _running(v, lambda a, b: F.greatest(a, b), -1))
        kept = F.zip_with(rows, ends, lambda x, end: F.when((x["span"] == 0) & (end <= x["run"]["start"]), x["run"]))
        return F.filter(kept, lambda r: r.isNotNull())

    return F.when(F.size(base) == 0, runs).otherwise(_let(F.array_sort(F.concat(asked, spans)), judged))


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,text:string>>")


def assign_spans(text: Column) -> Column:
    low = F.lower(text)
    hint = F.lit(False)
    for w in ASSIGN_WORDS:
        hint = hint | low.contains(w)
    value = lambda s: F.regexp_extract(s["text"], ASSIGN, 2)
    return F.when(hint, F.filter(_positions(text, ASSIGN), lambda s: F.length(value(s)) >= ASSIGN_VALUE)).otherwise(_none())


def access_spans(text: Column) -> Column:
    return F.when(text.contains("AKIA"), _positions(text, ACCESS)).otherwise(_none())


def hex_spans(text: Column) -> Column:
    return F.when(text.rlike(HEX), _positions(text, HEX)).otherwise(_none())


def _pairs(run: Column) -> Column:
    """Index of every pair of neighbouring characters in the pair table."""
    n = len(ALPHABET)
    at = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return F.zip_with(F.slice(at, F.lit(1), F.size(at) - 1), F.slice(at, F.lit(2), F.size(at) - 1), lambda a, b: a * n + b)


def train(docs: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE) -> list[float]:
    """Log-likelihood ratio (random against ordinary) per pair of characters, from the bounded sample."""
    n = len(ALPHABET)
    every = max(1, docs.count() // sample)
    h = F.xxhash64(key)
    d = docs.where(F.pmod(h, F.lit(every)) == 0).select(F.col(text).alias("t"), h.alias("h"))
    value = F.transform(assign_spans(F.col("t")), lambda s: F.regexp_extract(s["text"], ASSIGN, 2))
    rest = lambda spans: F.transform(spans, lambda s: s["text"])
    random = F.concat(value, rest(access_spans(F.col("t"))), rest(hex_spans(F.col("t"))))
    ordinary = F.when(F.pmod(F.shiftright("h", 20), F.lit(ORDINARY)) == 0, F.regexp_extract_all("t", F.lit(WORD), F.lit(0))).otherwise(F.array().cast("array<string>"))
    labelled = d.select(F.explode(F.array(F.struct(F.lit(1).alias("random"), random.alias("runs")),
                                          F.struct(F.lit(0).alias("random"), ordinary.alias("runs")))).alias("x")).select("x.*")
    pairs = labelled.select("random", F.explode("runs").alias("run")).select("random", F.explode(_pairs(F.col("run"))).alias("pair"))
    counts = {(r.random, r.pair): r.n for r in pairs.where("pair >= 0").groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}

    def logs(which: int) -> list[float]:
        out = []
        for a in range(n):
            row = [counts.get((which, a * n + b), 0) for b in range(n)]
            # One pseudo-count per row, shared by its characters: unseen pairs cost, but not without bound.
            out += [math.log((c + 4 / n) / (sum(row) + 4)) for c in row]
        return out

    if not any(k[0] for k in counts):
        return [0.0] * (n * n)
    return [a - b for a, b in zip(logs(1), logs(0))]


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
         model: list[float] | None = None) -> DataFrame:
    """(doc_id, assign, access, hex, markov): arrays of struct<start,end,text> per kind."""
    model = train(docs, text, doc_id) if model is None else model
    ratio = F.from_json(F.lit(json.dumps(model)), "array<double>")
    d = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    d = d.select("doc_id", assign_spans(F.col("t")).alias("assign"), access_spans(F.col("t")).alias("access"),
                 hex_spans(F.col("t")).alias("hex"), F.when(F.col("t").rlike(RUN), _positions(F.col("t"), RUN)).otherwise(_none()).alias("runs"))
    base = F.concat("assign", "access", "hex")
    odds = lambda s: F.aggregate(_pairs(s["text"]), F.lit(0.0), lambda acc, p: acc + F.get(ratio, p))
    return d.withColumn("markov", F.filter(_apart(F.col("runs"), base), lambda s: odds(s) > threshold)).select("doc_id", *KINDS)


def _listed(kinds: list[str]) -> Column:
    """All spans as kind:start:end, by start, then kind as listed."""
    def tagged(k: str) -> Column:
        return F.transform(k, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(k)).alias("n"), s["end"].alias("end")))

    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(F.concat(*map(tagged, kinds))), lambda s: F.concat_ws(
        ":", F.get(names, s["n"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_secret_scan(spark, sf_dir: str) -> DataFrame:
    s = scan(table(spark, sf_dir, "documents"))
    return s.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                    F.sha2(_listed(KINDS[:3]).cast("binary"), 256).alias("base_sha256"), _listed(KINDS).alias("spans"))
