"""Registered queries of this subpackage and the SQL that states the same result, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from vaultkit.llm import (bpe, chat_format, crf_language, cross_entropy, decontaminate, hard_negatives, jaccard_join, line_dedup,
                          quality_rules, resampling, secret_scan, suffix_dedup, token_scan)

QUERIES: dict[str, Callable] = {
    "op1_separator_scan": token_scan.op1_separator_scan,
    "op2_crf_language": crf_language.op2_crf_language,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_bpe": bpe.op4_bpe,
    "op5_secret_scan": secret_scan.op5_secret_scan,
    "op6_benchmark_decontamination": decontaminate.op6_benchmark_decontamination,
    "op7_cross_entropy_difference": cross_entropy.op7_cross_entropy_difference,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_chat_format": chat_format.op10_chat_format,
    "op11_suffix_dedup": suffix_dedup.op11_suffix_dedup,
    "op12_resampling": resampling.op12_resampling,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op10_chat_format": chat_format.ORACLE_SQL,
    "op12_resampling": resampling.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}
