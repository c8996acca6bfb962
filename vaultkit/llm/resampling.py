"""Importance resampling towards a target distribution (operator 12).

Words are hashed into buckets. Two counts per bucket, over all raw texts and over all target texts, give
every bucket an integer gain; a document's weight is the floored mean of the gains of its features, read
from an array of ``BUCKETS`` numbers. Gumbel noise from a hash of the id turns drawing without
replacement into "the k greatest scores".

The cutoff is found without sorting the scores. A mergeable KLL sketch brackets it; exact counts above
and inside the bracket validate it, else it is widened; only the rows of the bracket are sorted. A
fixed number of values passes the driver: the bucket counts, the bracket's counts and the cutoff row.

Defined cases: a null or empty text has no feature and weight 0; a null doc_id is hashed as the empty
text and comes last among ties; rows with equal score and doc_id are drawn in any order, all of them
counted; with no target text all T and t are 0; an empty table, or fewer than 100 / ``percent``
documents of at least ``min_words`` words, draws nothing; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultkit.llm.common import land, slices, table, tasks
from vaultkit.llm.ranking import ranked

BUCKETS = 10_000
ORDER = 1                  # features are runs of 1 to so many words
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
SKETCH_K = 1024            # size parameter of the KLL sketch
MARGIN = 0.004             # half width of the first bracket, as a share of the documents
CACHE = 500_000            # distinct words whose bucket a task remembers

# A word is a run of digits, of the letters a-z (A-Z in lower case) and of bytes above 0x7F; all else is a gap.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


class Hashed(dict):
    """Word -> crc32 of its bytes, each distinct word hashed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = h = zlib.crc32(word)
        return h


def features(text: bytes | None, known: Hashed, buckets: int = BUCKETS, order: int = ORDER) -> tuple[int, np.ndarray]:
    """(number of words, bucket of every run of 1 to ``order`` words)."""
    words = (text or b"").translate(_FOLD).split()
    n = len(words)
    hashes = list(map(known.__getitem__, words))
    runs = hashes
    for size in range(2, min(order, n) + 1):
        runs = [zlib.crc32(b" " + w, h) for h, w in zip(runs, words[size - 1:])]
        hashes = hashes + runs
    return n, np.fromiter(hashes, np.int64, len(hashes)) % buckets


def _count(buckets: int, order: int):
    def run(batches):
        known, total = Hashed(), np.zeros(buckets, np.int64)
        for b in batches:
            for _, part in slices(b.column(0)):
                for t in part:
                    total += np.bincount(features(t, known, buckets, order)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, order: int = ORDER) -> np.ndarray:
    """Features per bucket over all texts: ``buckets`` numbers, whatever the input."""
    rows = tasks(texts.select(F.col(text).alias("text")), _count(buckets, order), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(p_target / p_raw)) per bucket, with one pseudo-count per bucket."""
    n, s_all, t_all = len(raw), float(raw.sum()) + len(raw), float(target.sum()) + len(raw)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all))) for s, t in zip(raw, target)], np.int64).reshape(n)


def _weigh(gain: np.ndarray, order: int):
    def run(batches):
        known = Hashed()
        for b in batches:
            for first, part in slices(b.column(1)):
                n, sizes, weights = [], [], []
                for t in part:
                    words, at = features(t, known, len(gain), order)
                    n.append(words), sizes.append(len(at))
                    weights.append(int(gain[at].sum()) // len(at) if len(at) else 0)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(part)), *(pa.array(c, pa.int64()) for c in (n, sizes, weights))],
                    names=["doc_id", "n_words", "n_features", "weight"])
    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 * Gumbel noise) from the first 32 bits of sha256("seed:doc_id")."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def bracket(scored: DataFrame, k: int, n: int, margin: float = MARGIN, sketch_k: int = SKETCH_K) -> tuple[int | None, int | None, int]:
    """(lo, hi, rows above hi): scores between which the k-th greatest of ``n`` rows stands; None: no bound on that side.

    The sketch proposes, exact counts decide: fewer than k rows above ``hi``, at least k from ``lo`` on.
    """
    sketch = scored.agg(F.kll_sketch_agg_bigint("score", F.lit(sketch_k)).alias("s"))
    while True:
        ranks = 1 - k / n - margin, 1 - k / n + margin
        lo, hi = sketch.select(*[F.kll_sketch_get_quantile_bigint("s", F.lit(float(r))) if 0 < r < 1 else F.lit(None).cast("long") for r in ranks]).first()
        above = F.lit(False) if hi is None else F.col("score") > hi
        below = F.lit(False) if lo is None else F.col("score") < lo
        counted = scored.agg(F.count_if(above).alias("above"), F.count_if(below).alias("below")).first()
        if counted.above < k <= n - counted.below:
            return lo, hi, counted.above
        margin *= 4


def _place() -> Column:
    """Order among equal scores: doc_id, null last, then the row."""
    return F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id").alias("doc_id"), F.col("at").alias("at"))


def draw(scored: DataFrame, k: int, n: int, margin: float = MARGIN) -> Column:
    """Condition on ``scored`` (doc_id, score, at) that holds for its k first rows by score, ties to the smaller doc_id."""
    if not k:
        return F.lit(False)
    lo, hi, above = bracket(scored, k, n, margin)
    inside = scored
    if lo is not None:
        inside = inside.where(F.col("score") >= lo)
    if hi is not None:
        inside = inside.where(F.col("score") <= hi)
    last = ranked(inside.select("score", _place().alias("place")), "rank", F.desc("score"), F.asc("place")).where(F.col("rank") == k - above).first()
    no, doc, at = last.place
    kind = scored.schema["doc_id"].dataType
    cut = F.struct(F.lit(no).alias("no"), F.lit(doc).cast(kind).alias("doc_id"), F.lit(at).cast("long").alias("at"))
    return (F.col("score") > last.score) | ((F.col("score") == last.score) & (_place() <= cut))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS, order: int = ORDER, seed: int = SEED,
             margin: float = MARGIN) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``; rank is null where it is not drawn."""
    gain = gains(bucket_counts(docs, text, buckets, order), bucket_counts(target, target_text, buckets, order))
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    weighed = tasks(src, _weigh(gain, order), "doc_id long, n_words long, n_features long, weight long")
    scored = land(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn("at", F.monotonically_increasing_id()), "scores")
    able = scored.where(F.col("n_words") >= min_words)
    n = able.count()
    drawn = (F.col("n_words") >= min_words) & draw(able, percent * n // 100, n, margin)
    taken = ranked(scored.where(drawn).withColumn("place", _place()), "rank", F.desc("score"), F.asc("place"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return taken.select(*columns, "rank").union(scored.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))


def op12_resampling(spark, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# crc32 of every distinct word: a table of 256 entries from its rule, then one step per byte of the word.
ORACLE_SQL = r"""
WITH RECURSIVE
tab(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM tab WHERE k < 8),
steps AS (SELECT i, c FROM tab WHERE k = 8),
texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', item_id, text FROM benchmark),
found AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM texts),
words AS (SELECT side, id, unnest(ws) AS w FROM found),
crcs(w, hx, pos, c) AS (
  SELECT w, hex(encode(w)), 0, 4294967295 FROM (SELECT DISTINCT w FROM words)
  UNION ALL
  SELECT w, hx, pos + 1, xor(s.c, crcs.c >> 8) FROM crcs JOIN steps s
    ON s.i = xor(crcs.c & 255, CAST('0x' || substr(hx, 2 * pos + 1, 2) AS BIGINT)) WHERE 2 * pos < length(hx)),
hashed AS (SELECT w, xor(c, 4294967295) % 10000 AS bucket FROM crcs WHERE 2 * pos = length(hx)),
placed AS (SELECT side, id, bucket FROM words JOIN hashed USING (w)),
counts AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM placed GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM counts),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((counts.t + 1)::DOUBLE * (totals.s + 10000)::DOUBLE / ((counts.s + 1)::DOUBLE * (totals.t + 10000)::DOUBLE))) AS BIGINT) AS g
  FROM counts, totals),
sums AS (SELECT id, count(*) AS n, sum(g) AS g FROM placed JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id),
weights AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, CASE WHEN n > 0 THEN CAST((g - (((g % n) + n) % n)) // n AS BIGINT) ELSE 0 END AS weight
  FROM documents LEFT JOIN sums ON doc_id = id),
scores AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM weights),
able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
SELECT s.doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scores s LEFT JOIN able USING (doc_id)
"""
