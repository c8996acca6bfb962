"""Separator scan of flat token files that another writer made: no head before the tokens."""

import os
import uuid

import pytest

from vaultkit.llm import token_scan as S
from vaultkit.session import ensure_checkpoint_dir


@pytest.mark.parametrize("block", [9, 8192])
def test_files_without_heads(spark, block):
    path = f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}".removeprefix("file:")
    os.makedirs(path)
    sizes = [3, 0, 12, 5, 1, 30, 0, 7]
    ids = [x for n in sizes for x in [*range(1, n + 1), S.EOD]]
    with open(f"{path}/a.bin", "wb") as f:
        f.write(b"".join(x.to_bytes(2, "little") for x in ids))
    rows = S.scan_token_files(spark, path, block=block, head=0).collect()
    starts = [sum(sizes[:k]) + k for k in range(len(sizes))]
    assert sorted((r.doc_id, r.ordinal, r.start, r.n_tokens) for r in rows) == [(k, k, starts[k], n) for k, n in enumerate(sizes)]
