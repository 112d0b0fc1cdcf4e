"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from pulse.llm import (decontaminate, hadamard_kmeans, html_text, language_id, license_scan, line_dedup, mixing,
                       ngram_lm, quality_rules, simhash_dedup, substring_dedup, suffix_dedup, token_align)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": decontaminate.op1_query,
    "op2_html_extraction": html_text.op2_query,
    "op3_simhash_dedup": simhash_dedup.op3_query,
    "op4_quality_rules": quality_rules.op4_query,
    "op5_line_dedup": line_dedup.op5_query,
    "op6_mixing": mixing.op6_query,
    "op7_lm_scoring": ngram_lm.op7_query,
    "op8_license_scan": license_scan.op8_query,
    "op9_suffix_dedup": suffix_dedup.op9_query,
    "op10_substring_dedup": substring_dedup.op10_query,
    "op11_token_alignment": token_align.op11_query,
    "op12_language_id": language_id.op12_query,
    "op13_centroid_clustering": hadamard_kmeans.op13_query,
}

ORACLES: dict[str, str] = {
    "op1_decontamination": decontaminate.OP1_SQL,
    "op5_line_dedup": line_dedup.OP5_SQL,
    "op8_license_scan": license_scan.OP8_SQL,
}


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, "pipeline": corpus_pipeline.run}


def all_oracles() -> dict[str, str]:
    return {**ORACLES, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}
