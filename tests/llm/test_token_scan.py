"""Separator scan against the tokenizer itself, with blocks of any size."""

import base64
import uuid
from collections import Counter

import pytest

from vaultkit.llm import token_scan as S
from vaultkit.session import ensure_checkpoint_dir


@pytest.fixture(scope="module")
def enc():
    import public_tokenizers as P
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("test", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _path(spark):
    return f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"


def test_counts_equal_the_tokenizer(spark, texts, enc):
    got = {r.doc_id: r.n_tokens for r in S.op1_separator_scan(spark, "/root/testdata/sf0.001").collect()}
    assert got == {k: len(enc.encode_ordinary(t)) for k, t in texts.items()}


@pytest.mark.parametrize("block", [1777, None])
def test_documents_that_cross_blocks(spark, edge, enc, block):
    path = _path(spark)
    S.write_token_files(edge, path)
    rows = S.scan_token_files(spark, path, block=block).collect()
    want = Counter((r.doc_id, len(enc.encode_ordinary(r.text or ""))) for r in edge.select("doc_id", "text").collect())
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == want
    by_file = Counter(r.file for r in rows)
    assert all(sorted(r.ordinal for r in rows if r.file == f) == list(range(n)) for f, n in by_file.items())


def test_last_document_without_separator(spark):
    import os
    path = _path(spark).removeprefix("file:")
    os.makedirs(path)
    ids = [*S.head_of(9), 1, 2, S.EOD, *S.head_of(-3), 5, 6, 7]
    with open(f"{path}/a.bin", "wb") as f:
        f.write(b"".join(x.to_bytes(2, "little") for x in ids))
    rows = S.scan_token_files(spark, path, block=9).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in rows) == [(-3, 3), (9, 2)]


def test_empty_table(spark, empty):
    path = _path(spark)
    S.write_token_files(empty, path)
    assert S.scan_token_files(spark, path).count() == 0


def test_ids_round_trip():
    for x in (0, 1, -1, 2 ** 63 - 1, -2 ** 63, None):
        assert S.id_of(S.head_of(x)) == x and S.EOD not in S.head_of(x)


def plain(data, head):
    """(doc_id, ordinal, start, n_tokens) of one file, read id by id."""
    ids = [int.from_bytes(data[k:k + 2], "little") for k in range(0, len(data) - 1, 2)]
    out, at = [], 0
    while at < len(ids):
        end = ids.index(S.EOD, at) if S.EOD in ids[at:] else len(ids)
        doc = ids[at:end]
        out.append((S.id_of(doc[:S.HEAD]) if head else len(out), len(out), at, max(0, len(doc) - head)))
        at = end + 1
    return out


@pytest.mark.parametrize("head", [0, S.HEAD])
@pytest.mark.parametrize("block", [29, 301])
def test_separator_bytes_across_ids(spark, block, head):
    """Ids whose bytes give the separator's two bytes at odd places, in documents, in heads, around every block's end."""
    import os
    import random
    rng = random.Random(block)
    path = _path(spark).removeprefix("file:")
    os.makedirs(path)
    half = [0x5000 | k for k in (0x12, 0xC4, 0x50)], [k << 8 | 0xC4 for k in (0x12, 0x50, 0xC3)]
    want = []
    for f in range(4):
        ids = []
        for _ in range(rng.randint(1, 1 + block // 6)):
            if head:
                ids += S.head_of(rng.choice([rng.randrange(-2 ** 63, 2 ** 63), 0x5012 + 50_000 * 0x12C4, None]))
            for _ in range(rng.choice([0, 0, 1, 5, 30])):
                ids.append(rng.choice([rng.randrange(50_000), rng.choice(half[0]), rng.choice(half[1])]))
            ids.append(S.EOD)
        ids = [x for x in ids if x < 1 << 16]
        data = b"".join(x.to_bytes(2, "little") for x in ids[:len(ids) - f % 2]) + b"\x07" * (f == 3)
        with open(f"{path}/f{f}.bin", "wb") as out:
            out.write(data)
        want += [(f"f{f}.bin", *r) for r in plain(data, head)]
    rows = S.scan_token_files(spark, path, block=block, head=head).collect()
    got = [(r.file.split("/")[-1], r.doc_id, r.ordinal, r.start, r.n_tokens) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_blocks_of_one_file_are_tasks_of_their_own(spark):
    import os
    import numpy as np
    path = _path(spark).removeprefix("file:")
    os.makedirs(path)
    ids = np.random.default_rng(1).integers(0, 50_000, 1_500_000).astype("<u2")
    ids[::1000] = S.EOD
    ids.tofile(f"{path}/one.bin")
    rows = S.scan_token_files(spark, path, block=1 << 18, head=0)
    assert rows.count() == 1501 and rows.where("ordinal > 0 and n_tokens != 999").count() == 0
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with S.setting(spark, "spark.sql.files.maxPartitionBytes", 1 << 18):
        assert spark.read.option("lineSep", "x").text(path).rdd.getNumPartitions() >= 11
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == old
