"""The queries of the training-data operators and their SQL, by name."""

from __future__ import annotations

from shapelog.llm import bpe, decontaminate, exact_dedup, line_dedup, ngram_join, quality, substring_dedup, suffix_dedup, toxicity, warc

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_quality": quality.op4_quality,
    "op5_bpe": bpe.op5_bpe,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_ngram_join": ngram_join.op10_ngram_join,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
}

ORACLE_SQL = {
    "op1_warc": warc.SQL,
    "op2_decontaminate": decontaminate.SQL,
    "op6_substring_dedup": substring_dedup.SQL,
    "op7_exact_dedup": exact_dedup.SQL,
    "op9_line_dedup": line_dedup.SQL,
    "op10_ngram_join": ngram_join.SQL,
}
