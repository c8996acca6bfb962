"""Line dedup by winnowing over line hashes (operator 9).

Every window of consecutive lines with at least ``min_words`` words (the shortest such window from each
line on) selects one position, the first minimum of its line hashes. A selected position whose line is
selected nowhere else is in no repeated window, and its windows go no further. The windows of the other
positions are joined, by the hash of their lines, with the first place that holds them: two places that
share a run of whole equal lines with that many words share a window, its minimum, and are found. A
shared passage that begins or ends inside a line is found only as far as its whole lines reach that size.

Matches are extended line by line both ways against the text of that first place, and the lines of the
later run are deleted. A row per pair of texts carries the lines that can meet; windows on one diagonal
that touch are one match, and the ends of many matches are found together by doubling (``common``), so
a text that repeats its own lines costs little more than its length.

"Earlier" is the order (doc_id, text hash, line); a null doc_id comes last. Rows with equal doc_id
and text are one document given twice and get equal results. Lines are compared without outer white
space; blank lines do not count and stay. A null text stays null; an
empty table gives no rows. Only linear rows are made: positions meet the first one, never each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultkit.llm.common import fresh, land, slices, table, tasks

MIN_WORDS = 50

LINES = ("doc_id long, th long, h array<long>, at array<int>, "
         "fp array<struct<line:long,wins:array<struct<win:long,i:int,e:int>>>>")
FEW = 4                    # diagonals that are compared one by one


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def windows(counts: list[int], hashes: np.ndarray, min_words: int) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Selected positions: (line hash there, windows that select it as (window hash, first line, last line))."""
    ends = np.cumsum(counts)
    lasts = np.searchsorted(ends, ends - counts + min_words) if len(counts) else ends
    data = np.ascontiguousarray(hashes)
    out, selected = [], -1
    for i, e in enumerate(lasts.tolist()):
        if e >= len(counts):
            break
        run = data[i:e + 1]
        p = i + int(run.argmin())
        if p != selected:
            out.append((int(data[p]), []))
            selected = p
        out[-1][1].append((_signed(xxhash.xxh3_64_intdigest(run)), i, e))
    return out


def _line_rows(min_words: int):
    win = pa.struct([("win", pa.int64()), ("i", pa.int32()), ("e", pa.int32())])
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.struct([("line", pa.int64()), ("wins", pa.list_(win))])))

    def rows(batches):
        for b in batches:
            for first, part in slices(b.column(1)):
                out = []
                for doc, text in zip(b.column(0).slice(first, len(part)).to_pylist(), part):
                    if text is None:
                        continue
                    counts, hashes, at = [], [], []
                    for n, line in enumerate(text.split(b"\n")):
                        words = line.split()
                        if words:
                            counts.append(len(words))
                            hashes.append(_signed(xxhash.xxh3_64_intdigest(line.strip())))
                            at.append(n)
                    h = np.array(hashes, np.int64)
                    fp = windows(counts, h, min_words)
                    if fp:
                        out.append((doc, _signed(xxhash.xxh3_64_intdigest(text)), h, at, [
                            {"line": line, "wins": [dict(zip(("win", "i", "e"), w)) for w in wins]} for line, wins in fp]))
                cols = list(zip(*out)) if out else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "th", "h", "at", "fp"])
    return rows


def common(x: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Length of the longest common run from ``x[p]`` and ``x[q]`` on, for many pairs of places at once.

    Runs of 1, 2, 4, ... values are numbered so that equal numbers mean equal runs; each pair then takes the
    longest equal run, half of it, and so on."""
    names = [np.unique(x, return_inverse=True)[1].astype(np.int64)]
    while 2 << len(names) - 1 <= len(x):
        r, half = names[-1], 1 << len(names) - 1
        pair = r[:-half] * (int(r.max()) + 1) + r[half:]
        names.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
    p, q = p.copy(), q.copy()
    start = p.copy()
    for k in range(len(names) - 1, -1, -1):
        r = names[k]
        ok = (p < len(r)) & (q < len(r))
        ok[ok] = r[p[ok]] == r[q[ok]]
        p[ok] += 1 << k
        q[ok] += 1 << k
    return p - start


def covered(h: np.ndarray, a: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Marks the lines of ``h`` in the extended matches; hits: (first line, last line, first line of it in ``a``)."""
    shift = hits[:, 0] - hits[:, 2]
    order = np.lexsort((hits[:, 0], shift))
    i, e, shift = hits[order, 0], hits[order, 1], shift[order]
    new = np.concatenate([[True], (shift[1:] != shift[:-1]) | (i[1:] > e[:-1] + 1)])
    lo, hi, shift = i[new], e[np.concatenate([np.flatnonzero(new)[1:], [len(i)]]) - 1], shift[new]
    if len(lo) <= FEW:
        for k, s in enumerate(shift.tolist()):
            b, z = max(0, s), min(len(h), len(a) + s)
            differ = np.flatnonzero(h[b:z] != a[b - s:z - s]) + b
            cut = np.searchsorted(differ, lo[k])
            lo[k] = differ[cut - 1] + 1 if cut else b
            hi[k] = differ[cut] - 1 if cut < len(differ) else z - 1
    else:
        # One value between the texts that neither has keeps runs apart.
        ids = np.unique(np.concatenate([a, h]), return_inverse=True)[1]
        both = np.concatenate([ids[:len(a)], [-1], ids[len(a):]])
        off = len(a) + 1
        hi = hi + common(both, hi + 1 + off, hi + 1 - shift)
        back = both[::-1]
        lo = lo - common(back, len(both) - (lo + off), len(both) - (lo - shift))
    mark = np.zeros(len(h) + 1, np.int64)
    np.add.at(mark, lo, 1)
    np.add.at(mark, hi + 1, -1)
    return np.cumsum(mark[:-1]) > 0


def _extend(batches):
    """Matched windows of one document against one earlier text -> line numbers to delete."""
    for b in batches:
        docs, ths, gone = [], [], []
        for k in range(b.num_rows):
            lo, wins, h, at, a = b.column("lo")[k].as_py(), b.column("wins")[k].values, *(b.column(c)[k].values.to_numpy() for c in ("h", "at", "ah"))
            hits = np.stack([wins.field(c).to_numpy().astype(np.int64) for c in ("i", "e", "ai")], 1)
            hits[:, :2] -= lo
            docs.append(b.column("doc_id")[k].as_py()), ths.append(b.column("th")[k].as_py()), gone.append(at[covered(h, a, hits)])
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(ths, pa.int64()), pa.array(gone, pa.list_(pa.int32()))],
                                         names=["doc_id", "th", "gone"])


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, th, gone): numbers of the lines to delete, for the documents that lose any."""
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    t = land(tasks(src, _line_rows(min_words), LINES).dropDuplicates(["doc_id", "th"]), "line-hashes")
    key = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "th")
    selected = t.select(key.alias("d"), F.explode("fp").alias("f")).select("d", "f.*")
    often = t.select(F.explode("fp.line").alias("line")).groupBy("line").agg(F.count("*").alias("n"))
    # What a join meets is landed first: between two plain exchanges Spark can split a very frequent line or window.
    often = land(often.where("n > 1").select("line"), "selected-lines")
    fp = selected.join(often, "line", "left_semi").select("d", F.explode("wins").alias("w")).select("d", "w.*")
    first = fp.groupBy("win").agg(F.min(F.struct("d", "i")).alias("a"), F.max(F.struct("d", "i")).alias("z"))
    first = land(first.where("a != z").select("win", "a"), "first-places")
    hits = fp.join(first, "win").where((F.col("d") != F.col("a.d")) | (F.col("i") > F.col("a.i")))
    runs = hits.groupBy("d", F.col("a.d").alias("ad")).agg(           # at most one window per line of the document
        F.collect_list(F.struct("i", "e", F.col("a.i").alias("ai"))).alias("wins"),
        F.min(F.col("i") - F.col("a.i")).alias("least"), F.max(F.col("i") - F.col("a.i")).alias("most"))
    # Both joins meet one row per document; a document that many others repeat is the hot side, which AQE splits.
    mine = t.select(key.alias("d"), "h", "at")
    theirs = t.select(key.alias("ad"), F.col("h").alias("ah"))
    # Of a document only the lines that can meet the earlier text: its length, from the first diagonal to the last.
    lo = F.greatest("least", F.lit(0))
    size = F.greatest(F.col("most") + F.size("ah") - lo, F.lit(0))
    pairs = runs.join(mine, "d").join(theirs, "ad").select(
        F.col("d.doc_id").alias("doc_id"), F.col("d.th").alias("th"), lo.alias("lo"), "wins",
        F.slice("h", lo + 1, size).alias("h"), F.slice("at", lo + 1, size).alias("at"), "ah")
    gone = tasks(pairs, _extend, "doc_id long, th long, gone array<int>")
    return gone.groupBy("doc_id", "th").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))


def _text_hash():
    def th(text: pa.Array) -> pa.Array:
        return pa.array([None if t is None else _signed(xxhash.xxh3_64_intdigest(t)) for _, p in slices(text) for t in p], pa.int64())

    th.__annotations__ = {"text": pa.Array, "return": pa.Array}
    return F.arrow_udf(th, "long")


def _cut_udf():
    def cut(text: pa.Array, gone: pa.Array) -> pa.Array:
        out = []
        for first, part in slices(text):
            for t, lines in zip(part, gone.slice(first, len(part))):
                if t is not None and lines.is_valid:
                    without = set(lines.values.to_numpy().tolist())
                    t = b"\n".join(x for n, x in enumerate(t.split(b"\n")) if n not in without)
                out.append(t)
        return pa.array(out, pa.binary()).cast(pa.string())

    cut.__annotations__ = {"text": pa.Array, "gone": pa.Array, "return": pa.Array}
    return F.arrow_udf(cut, "string")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, gone: str = "ld_gone") -> DataFrame:
    """``docs`` with its text less the later repeated runs, plus ``gone`` (deleted line numbers or null), which must be a new name."""
    doc, th, th2 = fresh(docs, "ld_doc", "ld_th", "ld_th2")
    lines = repeated_lines(docs, doc_id, text, min_words).select(F.col("doc_id").alias(doc), F.col("th").alias(th2), F.col("gone").alias(gone))
    d = docs.withColumn(th, _text_hash()(F.col(text)))
    j = d.join(lines, F.col(doc_id).cast("long").eqNullSafe(F.col(doc)) & (F.col(th) == F.col(th2)), "left")
    return j.withColumn(text, _cut_udf()(F.col(text), F.col(gone))).drop(th, th2, doc)


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    d = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.coalesce(F.size("ld_gone"), F.lit(0)).alias("n_deleted_lines"), F.col("ld_gone").alias("deleted_lines"), "text")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: later repeated runs are cut out; a document left without any word is dropped."""
    gone, = fresh(docs, "ld_gone")
    d = dedup_lines(docs, gone=gone).where(F.col(gone).isNull() | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return d.select(*docs.columns)
