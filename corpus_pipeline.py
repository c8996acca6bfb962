"""Training-data pipeline over ``documents``: five stages, each one operator of ``vaultkit.llm``.

Every stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet into the
shared folder and gives the reread table to the next stage, so a lost executor costs one stage's
tasks at most. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from vaultkit.llm import bpe, decontaminate, jaccard_join, line_dedup, quality_rules
from vaultkit.llm.common import land, table

STAGES = [
    ("quality rules", quality_rules.stage),
    ("line dedup", line_dedup.stage),
    ("n-gram Jaccard join", jaccard_join.stage),
    ("benchmark decontamination", decontaminate.stage),
    ("BPE encoding and decoding", bpe.stage),
]

# Chosen paths, SimHash and byte-pair merges have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
