"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lamella.llm import bpe, centroids, conversations, decontaminate, line_dedup, quality_classifier, quality_rules, secrets, simhash, substring_dedup, topk, toxicity, warc

_MODULES = (simhash, warc, substring_dedup, line_dedup, decontaminate, toxicity, bpe, quality_classifier, secrets, quality_rules, conversations, topk, centroids)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
