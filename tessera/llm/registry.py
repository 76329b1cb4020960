"""The queries of this package and, where SQL can express them on whole tables, their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import chat, collocations, decontamination, jaccard_join, merkle, mixing, pii, quality_classifier, quality_rules, substrings, suffixes, toxicity, url_filters


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filters": url_filters.query,
        "op2_quality_rules": quality_rules.query,
        "op3_quality_classifier": quality_classifier.query,
        "op4_source_mixing": mixing.query,
        "op5_chat_formatting": chat.query,
        "op6_substring_dedup": substrings.query,
        "op7_pii": pii.query,
        "op8_decontamination": decontamination.query,
        "op9_jaccard_join": jaccard_join.query,
        "op10_suffix_dedup": suffixes.query,
        "op11_merkle_manifest": merkle.query,
        "op12_toxicity": toxicity.query,
        "op13_phrase_collocations": collocations.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filters": url_filters.ORACLE,
        "op6_substring_dedup": substrings.ORACLE,
        "op8_decontamination": decontamination.ORACLE,
        "op9_jaccard_join": jaccard_join.ORACLE,
        "op10_suffix_dedup": suffixes.ORACLE,
        "op11_merkle_manifest": merkle.ORACLE,
        "op13_phrase_collocations": collocations.ORACLE,
    }
