"""The subpackage's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import bpe, chat, decontamination, language_id, licenses, near_dedup, quality_rules, quality_trees, toxicity, url_filters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (bpe.op1_bpe, toxicity.op2_toxicity, decontamination.op3_decontamination, chat.op4_chat, language_id.op5_language_id, near_dedup.op6_near_dedup, quality_trees.op7_quality_trees, quality_rules.op8_quality_rules, quality_rules.quality_ablation, url_filters.op9_url_filters, licenses.op10_licenses)
}
SQL = {"op4_chat": chat.OP4_SQL, "op6_near_dedup": near_dedup.OP6_SQL, "op8_quality_rules": quality_rules.OP8_SQL, "quality_ablation": quality_rules.ABLATION_SQL, "op9_url_filters": url_filters.OP9_SQL, "op10_licenses": licenses.OP10_SQL}
