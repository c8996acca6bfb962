"""Suffix-array dedup by a depth-limited radix sort (operator 11).

Two places hold the same ``threshold`` bytes exactly if their suffixes are equal through that depth. So
suffixes are ordered only that far, digit by digit from the most significant one, and a group is left
alone as soon as one suffix is in it; what is in equal groups at the end are the repeated windows.

Suffixes travel in bundles, which keeps the passes small. The anchor of a suffix is the place of the
least gram hash among its first ``REACH`` places: a function of its first ``threshold`` bytes, hence the
same in every copy. Neighbouring suffixes with one anchor make a bundle; their digits from the anchor on
are the same, and one row stands for all of them:

* Passes 1 and 2 order bundles by two digits, together the ``threshold - REACH + 1`` bytes behind the
  anchor that all suffixes of any bundle with this anchor hold. Groups of one drop out.
* In a group that is left, bundles that are equal in all bytes of all their suffixes form a class. A
  class of two or more is repeated as a whole. Where a group holds several classes, the suffixes of each
  class's first bundle are ordered on, in bundles of ``STEP``, and those again one by one.

Digits are 64-bit hashes of their bytes; a group agrees in 128 bits or more. A text is known by a 128-bit
hash, so equal texts share their rows' fate: a copy makes each of its windows repeated. Groups are only
counted and joined, never gathered: counts are added up in the tasks first, and joins meet one row per
group, so a group of any size can be split.

Defined cases: a null text counts as empty; texts shorter than ``threshold`` lose nothing; repeated rows
are places of their own; a null doc_id gets a row like others; what is kept are bytes, as a cut may split
a character; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultkit.llm.common import give_back, land, segments, slices, table, tasks

THRESHOLD = 400            # bytes
REACH = 200                # places among which a suffix finds its anchor
STEP = 8                   # suffixes of a second-level bundle
GRAM = 16                  # bytes that decide on anchors
SLICE = 400_000            # bytes of text searched for anchors at once

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_PLACE = np.uint64(0xFFFFFFFF)
_64 = xxhash.xxh3_64_intdigest


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def text_key(text: bytes) -> tuple[int, int]:
    x = xxhash.xxh3_128_intdigest(text)
    return x >> 64, x & (1 << 64) - 1


def anchored(part: list[bytes], threshold: int, reach: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, first place, last place, anchor, text) of every bundle of the texts' suffixes."""
    n = np.array([len(t) for t in part], np.int64)
    ends = np.cumsum(n)
    buffer = b"".join(part) + bytes(reach + 2 * GRAM)
    total = int(n.sum())
    valid = np.zeros(total + 1, np.int32)                 # suffixes with threshold bytes or more
    long = n >= threshold
    np.add.at(valid, (ends - n)[long], 1)
    np.add.at(valid, ends[long] - threshold + 1, -1)
    at = np.flatnonzero(np.cumsum(valid[:total]) > 0)
    if not len(at):
        return buffer, at, at, at, at
    eight = np.ndarray((total + reach + GRAM,), "<u8", buffer, strides=(1,))
    h = eight[:total + reach] * _A
    h ^= h >> np.uint64(29)
    h += eight[GRAM - 8:total + reach + GRAM - 8]
    h *= _B
    h &= ~_PLACE
    h |= np.arange(len(h), dtype=np.uint64)              # equal hashes: the first place
    width = 1
    while width < reach:
        step = min(width, reach - width)
        h = np.minimum(h[:-step], h[step:])
        width += step
    anchor = (h[at] & _PLACE).astype(np.int64)
    text = np.searchsorted(ends, at, side="right")
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    return buffer, at[new], at[np.concatenate([new[1:], [len(at)]]) - 1], anchor[new], text[new]


def _bundles(threshold: int, reach: int, whole: bool):
    """Rows of bundles; ``whole``: with all digits and their place, else only the first digit."""
    core = threshold - reach + 1
    one = core // 2

    def run(batches):
        for b in batches:
            for _, part in slices(b.column(0), SLICE):
                part = [t or b"" for t in part]
                buffer, first, last, anchor, text = anchored(part, threshold, reach)
                view = memoryview(buffer)
                a = anchor.tolist()
                cols = {"d1": _signed([_64(view[x:x + one]) for x in a])}
                if whole:
                    starts = segments(np.array([len(t) for t in part], np.int64))
                    used = np.unique(text)
                    keys = np.zeros((len(part), 2), np.uint64)
                    for i in used.tolist():
                        keys[i] = text_key(part[i])
                    cols["d2"] = _signed([_64(view[x + one:x + core]) for x in a])
                    cols["k"] = _signed([_64(view[f:e + threshold], (x - f) << 12 | e - f) for x, f, e in zip(a, first.tolist(), last.tolist())])
                    cols["th1"], cols["th2"] = _signed(keys[text, 0]), _signed(keys[text, 1])
                    cols["pos"] = pa.array((first - starts[text]) << 24 | (last - first) << 12 | (anchor - first))
                yield pa.RecordBatch.from_pydict(cols)
        give_back()
    return run


_WHOLE = "d1 long, d2 long, k long, th1 long, th2 long, pos long"


def _split(threshold: int, step: int):
    """Suffixes of opened bundles in bundles of ``step``, places counted from a grid that starts at the anchor.

    ``b``: the bytes which all suffixes of a full bundle on that place of the grid hold; ``k``: all bytes of its own."""
    def run(batches):
        for batch in batches:
            for t1, t2, z, size, opened in zip(*[c.to_pylist() for c in batch.columns]):
                view = memoryview(_text(z, size))
                keys, ks, pos = [], [], []
                for p in opened:
                    first, span, ahead = p >> 24, p >> 12 & 0xFFF, p & 0xFFF
                    anchor = first + ahead
                    for j in range((ahead - span) // step, ahead // step + 1):
                        base = anchor - j * step
                        lo, hi = max(first, base - step + 1), min(first + span, base)
                        keys.append(text_key(view[base:base - step + 1 + threshold]))
                        ks.append(_64(view[lo:hi + threshold], (base - lo) << 12 | base - hi))
                        pos.append(lo << 24 | (hi - lo) << 12 | (base - lo))
                n = len(pos)
                yield pa.RecordBatch.from_arrays(
                    [_signed([x for x, _ in keys]), _signed([x for _, x in keys]), _signed(ks), pa.array([t1] * n, pa.int64()), pa.array([t2] * n, pa.int64()),
                     pa.array(pos, pa.int64())], names=["d1", "d2", "k", "th1", "th2", "pos"])
    return run


def _keyed(batches):
    """Every row of the input with its text's hash and its text compressed: it crosses a shuffle."""
    for b in batches:
        for first, part in slices(b.column(1)):
            part = [t or b"" for t in part]
            keys = [text_key(t) for t in part]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(first, len(part)), _signed([x for x, _ in keys]), _signed([x for _, x in keys]),
                 pa.array([pa.compress(t, "zstd", asbytes=True) for t in part], pa.binary()), pa.array([len(t) for t in part], pa.int64())],
                names=["doc_id", "th1", "th2", "z", "n_bytes"])


def _text(z: bytes, size: int) -> bytes:
    return pa.decompress(z, size, "zstd", asbytes=True) if size else b""


def classes(bundles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repeated, opened): bundles of classes with two or more members; first bundles of classes that are not alone in their group."""
    c = land(bundles.groupBy("d1", "d2", "k").agg(F.count("*").alias("n"), F.min(F.struct("th1", "th2", "pos")).alias("rep")), "suffix-classes")
    groups = land(c.groupBy("d1", "d2").agg(F.count("*").alias("c")).where("c > 1").select("d1", "d2"), "suffix-groups")
    opened = c.join(groups, ["d1", "d2"], "left_semi").select("rep.*")
    repeated = bundles.join(c.where("n > 1"), ["d1", "d2", "k"], "left_semi").select("th1", "th2", "pos")
    return repeated.distinct(), opened


def _of_texts(places: DataFrame, name: str) -> DataFrame:
    return places.groupBy("th1", "th2").agg(F.collect_list("pos").alias(name))


def repeated_windows(docs: DataFrame, text: str = "text", threshold: int = THRESHOLD, reach: int = REACH, step: int = STEP) -> DataFrame:
    """(th1, th2, spans): per text, by its hash, the places (packed: start, length less one, unused) where repeated windows begin."""
    if not 0 < reach <= threshold - GRAM or reach > 4096 or step > reach:
        raise ValueError("reach must leave a gram before the threshold, and be at most 4096")
    src = docs.select(F.col(text).alias("text"))
    # What a join meets is landed first: between two plain exchanges Spark can split a group that holds many rows.
    counts = tasks(src, _bundles(threshold, reach, False), "d1 long").groupBy("d1").agg(F.count("*").alias("n"))
    counts = land(counts.where("n > 1").select("d1"), "first-digits")
    alive = land(tasks(src, _bundles(threshold, reach, True), _WHOLE).join(counts, "d1", "left_semi"), "suffix-bundles")
    repeated, opened = classes(alive)
    repeated = land(repeated, "repeated-bundles")
    opened = _of_texts(opened, "opened")
    keyed = tasks(docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text).alias("text")), _keyed, _KEYED)
    texts = land(keyed.join(opened, ["th1", "th2"]).select("th1", "th2", "z", "n_bytes", "opened"), "opened-texts")
    finer, open_again = classes(tasks(texts, _split(threshold, step), _WHOLE))
    again = land(_of_texts(open_again, "again"), "opened-again")
    single = tasks(texts.join(again, ["th1", "th2"]).select("th1", "th2", "z", "n_bytes", "again"), _split(threshold, 1), _WHOLE)
    twice = single.groupBy("d1", "d2").agg(F.min(F.struct("th1", "th2", "pos")).alias("a"), F.max(F.struct("th1", "th2", "pos")).alias("z"))
    twice = land(twice.where("a != z").select("d1", "d2"), "repeated-suffixes")
    last = single.join(twice, ["d1", "d2"], "left_semi").select("th1", "th2", "pos")
    return _of_texts(repeated.union(finer).union(last.distinct()), "spans")


_KEYED = "doc_id long, th1 long, th2 long, z binary, n_bytes long"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def merged(places: list[int] | None, threshold: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the windows at these places cover."""
    p = np.sort(np.array(places or [], np.int64))
    start, end = p >> 24, (p >> 24) + (p >> 12 & 0xFFF) + threshold
    if not len(p):
        return []
    reach = np.maximum.accumulate(end)
    new = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    return list(zip(start[new].tolist(), reach[np.concatenate([new[1:], [len(p)]]) - 1].tolist()))


def _cut(threshold: int):
    def run(batches):
        for b in batches:
            out, held = [], 0
            rows = list(zip(*[c.to_pylist() for c in b.columns]))
            for i, (doc, z, size, places) in enumerate(rows):
                t, spans, at, kept = _text(z, size), merged(places, threshold), 0, []
                for s, e in spans:
                    kept.append(t[at:s])
                    at = e
                out.append((doc, size, [{"start": s, "end": e} for s, e in spans], b"".join(kept) + t[at:]))
                held += size
                if held > SLICE or i == len(rows) - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), _SPANS, pa.binary()))],
                                                     names=["doc_id", "n_bytes", "spans", "kept"])
                    out, held = [], 0
    return run


def dedup_suffixes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, reach: int = REACH, step: int = STEP) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): the removed spans of the text's UTF-8 bytes and the bytes that are left."""
    spans = land(repeated_windows(docs, text, threshold, reach, step), "repeated-windows")
    keyed = tasks(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), _keyed, _KEYED)
    # The hot side of this join are the copies of one text, which Spark can split: spans has one row per text.
    j = keyed.join(spans, ["th1", "th2"], "left").select("doc_id", "z", "n_bytes", "spans")
    return tasks(j, _cut(threshold), "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def op11_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    d = dedup_suffixes(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return d.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
