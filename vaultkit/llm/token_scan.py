"""Token counts by separator scan (operator 1).

Token files are flat: 16-bit little-endian ids, documents one after the other, each ended by the
end-of-document id, no index. A document's first ``HEAD`` ids carry its doc_id in digits of base
50,000, which are never the separator.

Spark's text source cuts a file of any size into byte ranges, which are tasks of their own, and breaks
a range wherever the separator's two bytes stand, also across two ids. Which of these breaks are separators hangs on
whether the range begins at an even byte, which only the ranges before it tell. So every block (range) is
scanned for both cases at once, in arrays: breaks at even places are separators, the documents between
them lie in the block, and one small row tells its length, its first separator and the document that is open
at its end. A prefix scan over these rows, in the order of the file, gives every block its first byte, its case, and
the open document that its first separator ends.

Files are written by the tasks that encode, with no shuffle. Defined cases: a null text counts as empty
and has no token; a null doc_id is a digit string of its own; repeated rows are repeated documents; an
empty table gives no rows; a file's last document may lack its separator, and an odd last byte is no id; a
document shorter than its head (foreign files) has a null doc_id; other columns are ignored. A single
document holds at most 2 GB.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultkit.llm.common import land, passing_folder, segments, setting, slices, table, tasks

RANKS = "byte_bpe_50k.tiktoken"
EOD = 50_256
BASE, HEAD = 50_000, 5


def head_of(doc_id: int | None) -> list[int]:
    x = BASE ** HEAD - 1 if doc_id is None else doc_id + (1 << 63)
    return [x // BASE ** k % BASE for k in range(HEAD)]


def id_of(head: list[int]) -> int | None:
    x = sum(int(d) * BASE ** k for k, d in enumerate(head))
    return x - (1 << 63) if len(head) == HEAD and x < 1 << 64 and all(d < BASE for d in head) else None


def _encoder(ranks: dict[bytes, int], pattern: str):
    def run(batches):
        import tiktoken
        enc = tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            for first, part in slices(b.column(1)):
                ids = b.column(0).slice(first, len(part)).to_pylist()
                rows = [np.array(head_of(i) + enc.encode_ordinary((t or b"").decode("utf-8", "replace")), "<u2").tobytes() for i, t in zip(ids, part)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["tokens"])
    return run


def write_token_files(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", ranks: str | None = None,
                      pattern: str | None = None) -> None:
    """Encode every text and write flat token files. Spark's text writer puts out the bytes of a row as
    they are and the separator after it, which is the two bytes of the end-of-document id."""
    import public_tokenizers
    with open(ranks or public_tokenizers.path(RANKS), "rb") as f:
        table_ = {base64.b64decode(a): int(n) for a, n in map(bytes.split, f)}
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = tasks(src, _encoder(table_, pattern or public_tokenizers.PATTERN), "tokens binary")
    (rows.select(F.col("tokens").cast("string").alias("value")).write.option("encoding", "ISO-8859-1")
     .option("lineSep", EOD.to_bytes(2, "little").decode("latin-1")).text(path))


_INNER = "array<struct<id:long,start:long,end:long>>"
_CASES = (0, 1)            # the block begins at an even byte, at an odd one
_BLOCKS_SQL = ("file string, at long, size long, n_bytes long, lead binary, "
               + ", ".join(f"docs{p} {_INNER}, seps{p} long, first_end{p} long, open{p} long, open_head{p} binary" for p in _CASES))
_BLOCKS = pa.schema([("file", pa.string()), ("at", pa.int64()), ("size", pa.int64()), ("n_bytes", pa.int64()), ("lead", pa.binary()), *(
    (f"{n}{p}", k) for p in _CASES for n, k in (
        ("docs", pa.list_(pa.struct([("id", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))), ("seps", pa.int64()),
        ("first_end", pa.int64()), ("open", pa.int64()), ("open_head", pa.binary())))])


def doc_id_of(head: bytes, known: int) -> int | None:
    return id_of(np.frombuffer(head[:known & ~1], "<u2").tolist()) if known else None


def block_row(file: str, at: int, size: int, lengths: np.ndarray, heads: list[bytes], sep: bytes, head: int) -> dict:
    """One block from its pieces (lengths, first bytes): places are counted from the block's first byte."""
    offsets = segments(lengths + len(sep))
    keep = 2 * HEAD

    def first_bytes(k: int, to: int) -> bytes:
        """The first bytes of the document that begins with piece k, as far as piece ``to`` goes."""
        out = b""
        while len(out) < keep and k < to:
            out += heads[k] + sep
            k += 1
        return out[:keep]

    row = {"file": file, "at": at, "size": size, "n_bytes": int(offsets[-1]), "lead": first_bytes(0, len(heads))}
    ends = offsets[1:] - len(sep)
    for p in _CASES:
        true = np.flatnonzero((ends + p) % 2 == 0)
        starts, stops, begin = offsets[true[:-1] + 1], ends[true[1:]], true[:-1] + 1
        ids = [doc_id_of(first_bytes(k, e + 1), min(keep, z - s)) if head else None for k, e, s, z in zip(
            begin.tolist(), true[1:].tolist(), starts.tolist(), stops.tolist())]
        last = int(true[-1]) + 1 if len(true) else None
        row |= {f"docs{p}": [{"id": i, "start": s, "end": e} for i, s, e in zip(ids, starts.tolist(), stops.tolist())], f"seps{p}": len(true),
                f"first_end{p}": int(ends[true[0]]) if len(true) else None, f"open{p}": None if last is None else int(offsets[last]),
                f"open_head{p}": None if last is None else first_bytes(last, len(heads))}
    return row


def _blocks(eod: int, head: int):
    sep, keep = eod.to_bytes(2, "little"), 2 * HEAD

    def run(batches):
        now, lengths, heads = None, [], []

        def rows():
            yield pa.RecordBatch.from_pylist([block_row(*now, np.concatenate(lengths), heads, sep, head)], _BLOCKS)

        for b in batches:
            paths, ats, sizes, values = b.columns
            if not len(values):
                continue
            ats_, sizes_ = ats.to_numpy(), sizes.to_numpy()
            n = np.diff(np.asarray(values.offsets)) if hasattr(values, "offsets") else None
            n = np.array([len(v) for v in values.to_pylist()], np.int64) if n is None else n.astype(np.int64)
            path = paths.dictionary_encode()
            turn = np.flatnonzero((np.diff(ats_) != 0) | (np.diff(path.indices.to_numpy()) != 0)) + 1
            for lo, hi in zip([0, *turn.tolist()], [*turn.tolist(), len(values)]):
                key = (paths[lo].as_py(), int(ats_[lo]), int(sizes_[lo]))
                if key != now:
                    if now:
                        yield from rows()
                    now, lengths, heads = key, [], []
                lengths.append(n[lo:hi])
                heads += pa.compute.binary_slice(values.slice(lo, hi - lo), 0, keep).to_pylist()
        if now:
            yield from rows()
    return run


_STITCHED = "file string, at long, base long, before long, docs array<struct<ordinal:long,id:long,start:long,end:long>>"


def _stitch(head: int):
    """Prefix scan over the blocks of a file: where each begins, documents before it, and the documents that cross blocks."""
    keep = 2 * HEAD

    def run(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["at"])
        out, base, seps, start, known = [], 0, 0, 0, b""
        whole = lambda end: end - start
        one = lambda end, first: {"ordinal": seps, "id": doc_id_of(first, min(keep, whole(end))) if head else None, "start": start // 2, "end": end // 2}
        for i, r in enumerate(rows):
            p, docs, place, before = base % 2, [], base, seps
            size = r["size"] // 2 * 2
            joined = (known + r["lead"])[:keep]
            if r[f"seps{p}"]:
                docs.append(one(min(size, base + r[f"first_end{p}"]), joined))
                seps += r[f"seps{p}"]
                start, known = base + r[f"open{p}"], r[f"open_head{p}"]
            else:
                known = joined
            base += r["n_bytes"]
            if i == len(rows) - 1 and start < size:
                docs.append(one(size, known))
            out.append({"file": r["file"], "at": r["at"], "base": place, "before": before, "docs": docs})
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("ordinal", "id", "start", "end")]))
        return pa.Table.from_pylist(out, pa.schema([("file", pa.string()), ("at", pa.int64()), ("base", pa.int64()), ("before", pa.int64()), ("docs", kind)]))
    return run


def scan_token_files(spark: SparkSession, path: str, block: int | None = None, eod: int = EOD, head: int = HEAD) -> DataFrame:
    """(file, ordinal, doc_id, start, n_tokens): every document of the token files, head and separator not counted.
    Files of other writers have no head: ``head=0`` counts every id and gives the ordinal in the file as doc_id.
    ``block`` is the size of a byte range, as the session has it by default."""
    if head not in (0, HEAD):
        raise ValueError(f"head is 0 or {HEAD}")
    sep = eod.to_bytes(2, "little").decode("latin-1")
    pieces = spark.read.option("encoding", "ISO-8859-1").option("lineSep", sep).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.col("_metadata.file_size").alias("size"),
        F.col("value").cast("binary").alias("value"))
    with setting(spark, "spark.sql.files.maxPartitionBytes", block), setting(spark, "spark.sql.files.openCostInBytes", block and 1):
        blocks = land(tasks(pieces, _blocks(eod, head), _BLOCKS_SQL), "token-blocks")
    ends = blocks.drop(*[f"docs{p}" for p in _CASES])                   # some hundred bytes a block
    scanned = land(ends.groupBy("file").applyInArrow(_stitch(head), _STITCHED), "token-scan")
    inner = F.when(F.col("base") % 2 == 0, F.col("docs0")).otherwise(F.col("docs1"))
    j = blocks.select("file", "at", "docs0", "docs1").join(scanned.select("file", "at", "base", "before"), ["file", "at"])
    j = j.select("file", "base", "before", F.posexplode(inner)).select(
        "file", (F.col("before") + F.col("pos") + 1).alias("ordinal"), F.col("col.id").alias("doc_id"),
        ((F.col("base") + F.col("col.start")) / 2).cast("long").alias("start"), ((F.col("base") + F.col("col.end")) / 2).cast("long").alias("end"))
    crossing = scanned.select("file", F.explode("docs").alias("d")).select("file", "d.ordinal", F.col("d.id").alias("doc_id"), "d.start", "d.end")
    docs = j.union(crossing)
    doc_id = F.col("doc_id") if head else F.col("ordinal")
    return docs.select("file", "ordinal", doc_id.alias("doc_id"), "start", F.greatest(F.col("end") - F.col("start") - head, F.lit(0)).alias("n_tokens"))


def op1_separator_scan(spark, sf_dir: str) -> DataFrame:
    path = passing_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return scan_token_files(spark, path).select("doc_id", "n_tokens", "ordinal", "start")
