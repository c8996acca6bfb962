"""Quality rules with adaptive thresholds (operator 8).

Per text: base counts and four ratios. Per (lang, source): DDSketch histograms of the ratios, i.e.
counts per logarithmic bin. They merge by addition in any order, so the thresholds are the same for
every partitioning and after any retry, and a hot source is pre-aggregated in every task. The
sketches give an upper fence per ratio, joined back to the documents in place of fixed cutoffs.

A group's quantiles are drawn towards those of all groups together, as if ``WEIGHT`` texts of the whole
had been among its own: a small group leans on the whole, a large one on itself, without a step between.
No fence exceeds ``CEILING`` times the fence of the whole, so a source cannot vouch for its own junk.

Defined cases: a null or empty text has no words and fails the base rule; null lang or source is a
group of its own; repeated rows are judged one by one; an empty table gives no rows; other columns are
ignored by ``judge`` except that it returns them; its own columns are ``q_``, ``q_top``, ``q_base_failed``
and ``q_kept``, in place of any that the input has under these names.
"""

from __future__ import annotations

import math
import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from vaultkit.llm.common import fresh, give_back, land, slices, table

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PCT = 20, 30            # base rule of the contract

ALPHA = 0.01                                  # relative error of a sketch quantile
GAMMA = (1 + ALPHA) / (1 - ALPHA)
LEAST = 1e-6                                  # values below share bin LOWEST
LOWEST = -100_000
RATIOS = ("symbol_ratio", "dup_line_ratio", "stutter_ratio", "word_length")
# Least spread counted as normal; stutter: words equal to the word before.
SPREAD = {"symbol_ratio": 0.05, "dup_line_ratio": 0.15, "stutter_ratio": 0.05, "word_length": 1.0}
FENCE = 4.0                                   # spreads above the upper quantile that are still accepted
LOW_Q, HIGH_Q = 0.5, 0.75
WEIGHT = 100                                  # texts of the whole that count in every group
CEILING = 2.0                                 # times the fence of the whole

COUNTS = T.StructType([T.StructField(n, T.LongType()) for n in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stutter")])
_ODD = [pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(WINDOW)]


def repeat_words(words: list[bytes]) -> int:
    """Words inside 8-word windows that occur at least twice (all occurrences count)."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    w = np.zeros(n, np.uint64)
    for k, m in enumerate(_ODD):
        w += (h[k:k + n] ^ (h[k:k + n] >> np.uint64(29))) * np.uint64(m)
    s = np.sort(w)
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = s[1:][same]
    at = np.minimum(np.searchsorted(twice, w), len(twice) - 1)
    starts = np.flatnonzero(twice[at] == w)
    mark = np.zeros(len(words) + 1, np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + WINDOW, -1)
    return int((np.cumsum(mark) > 0).sum())


def text_counts(text: bytes | None) -> tuple:
    words = (text or b"").split()             # bytes.split: exactly the ASCII white space of the contract
    if not words:
        return 0, 0, len(text or b"") - len((text or b"").translate(None, SYMBOLS)), 0, 0, 0, 0
    chars = len(b"".join(words).decode("utf-8", "replace"))
    lines = [x for x in text.split(b"\n") if x.split()]
    return (len(words), chars, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeat_words(words), len(lines), sum(map(operator.eq, words, words[1:])))


def _counts_udf():
    kind = pa.struct([pa.field(f.name, pa.int64()) for f in COUNTS])

    def counts(text: pa.Array) -> pa.Array:
        rows = [text_counts(t) for _, part in slices(text) for t in part]
        cols = list(zip(*rows)) if rows else [()] * len(kind)
        give_back()
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], fields=list(kind))

    counts.__annotations__ = {"text": pa.Array, "return": pa.Array}
    return F.arrow_udf(counts, COUNTS)


def measured(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``docs`` with one struct column ``q_`` of counts, ratios and group key."""
    counts, = fresh(docs, "q_c")
    c = docs.withColumn(counts, _counts_udf()(F.col(text)))
    n = F.greatest(F.col(f"{counts}.n_words"), F.lit(1)).cast("double")
    return c.withColumn("q_", F.struct(
        f"{counts}.*",
        (F.col(f"{counts}.n_symbols") / n).alias("symbol_ratio"),
        (F.col(f"{counts}.n_dup_lines") / F.greatest(F.col(f"{counts}.n_lines"), F.lit(1)).cast("double")).alias("dup_line_ratio"),
        (F.col(f"{counts}.n_stutter") / n).alias("stutter_ratio"),
        (F.col(f"{counts}.word_chars") / n).alias("word_length"),
        F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"))).drop(counts)


def sketches(q: DataFrame) -> DataFrame:
    """(lang, source, ratio, bin, n): DDSketch of every ratio of every group, over all its texts with words."""
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("ratio"), F.col(f"q_.{r}").alias("x")) for r in RATIOS]))
    rows = q.where("q_.n_words > 0").select("q_.lang", "q_.source", pairs.alias("p")).select("lang", "source", "p.*")
    b = F.when(F.col("x") < LEAST, LOWEST).otherwise(F.ceil(F.log("x") / F.lit(math.log(GAMMA))).cast("int"))
    return rows.select("lang", "source", "ratio", b.alias("bin")).groupBy("lang", "source", "ratio", "bin").agg(
        F.count("*").alias("n"))


def quantiles(bins: DataFrame, keys: list[str], qs: tuple = (LOW_Q, HIGH_Q)) -> DataFrame:
    """Merge the sketches of equal ``keys`` and read quantiles: the first bin whose running count reaches q * n.
    A merged sketch has as many rows as there are bins (some hundred), whatever the input."""
    m = bins.groupBy(*keys, "bin").agg(F.sum("n").alias("n"))
    run = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    m = m.withColumn("c", F.sum("n").over(run)).withColumn("t", F.sum("n").over(whole))
    value = F.when(F.col("bin") == LOWEST, 0.0).otherwise(2 * F.pow(F.lit(GAMMA), F.col("bin")) / (GAMMA + 1))
    return m.groupBy(*keys).agg(
        *[F.min(F.when(F.col("c") >= q * F.col("t"), value)).alias(f"v{i}") for i, q in enumerate(qs)],
        F.max("t").alias("t"))


def fences(bins: DataFrame, weight: float = WEIGHT, fence: float = FENCE, ceiling: float = CEILING) -> DataFrame:
    """One row per (lang, source): an upper fence per ratio, from its own sketch and the merged one of all groups."""
    own, every = quantiles(bins, ["lang", "source", "ratio"]), quantiles(bins, ["ratio"])
    every = every.select("ratio", F.col("v0").alias("e0"), F.col("v1").alias("e1"))
    j = own.join(every, "ratio")
    lo, hi = [(F.col("t") * F.col(f"v{i}") + weight * F.col(f"e{i}")) / (F.col("t") + weight) for i in (0, 1)]
    least = F.element_at(F.create_map(*[F.lit(x) for r in RATIOS for x in (r, SPREAD[r])]), F.col("ratio"))
    top = lambda a, b: b + fence * F.greatest(b - a, least)
    j = j.withColumn("top", F.least(top(lo, hi), ceiling * top(F.col("e0"), F.col("e1"))))
    return j.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("ratio") == r, F.col("top"))).alias(f"top_{r}") for r in RATIOS])


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``docs`` plus ``q_`` (counts, ratios) and ``q_top`` (fences of its group), ``q_base_failed``, ``q_kept``.

    Texts are measured twice, once for the sketches and once beside the other columns. The fences, one row
    per group, are written first: with their size known, Spark broadcasts them below its threshold, so no
    text is shuffled; more groups than that join by shuffle.
    """
    docs = docs.drop("q_", "q_top", "q_base_failed", "q_kept")
    group, = fresh(docs, "q_g")
    tops = fences(sketches(measured(docs.select(text, lang, source), text, lang, source)))
    tops = land(tops.select(F.struct("lang", "source").alias(group), F.struct("*").alias("q_top")), "fences")
    q = measured(docs, text, lang, source)
    j = q.join(tops, (F.col("q_.lang").eqNullSafe(F.col(f"{group}.lang"))) & (F.col("q_.source").eqNullSafe(F.col(f"{group}.source"))),
               "left").drop(group)
    failed = (F.col("q_.n_words") < MIN_WORDS) | (100 * F.col("q_.n_repeat_words") > MAX_REPEAT_PCT * F.col("q_.n_words"))
    over = F.lit(False)
    for r in RATIOS:
        over = over | F.coalesce(F.col(f"q_.{r}") > F.col(f"q_top.top_{r}"), F.lit(False))
    return j.withColumn("q_base_failed", failed).withColumn("q_kept", ~failed & ~over)


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    j = judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return j.select("doc_id", *[F.col(f"q_.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                    F.col("q_base_failed").alias("base_failed"), F.col("q_kept").alias("kept"),
                    *[F.col(f"q_.{r}") for r in RATIOS])


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules reject go. Columns that the rules would replace are given other names meanwhile."""
    aside = {c: new for c in docs.columns if c.lower() in ("q_", "q_top", "q_base_failed", "q_kept") for new in fresh(docs, f"{c}_aside")}
    kept = judge(docs.withColumnsRenamed(aside)).where("q_kept")
    return kept.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])
