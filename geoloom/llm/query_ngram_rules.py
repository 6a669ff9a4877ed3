"""Query of the quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geoloom.llm.common import table
from geoloom.llm.ngram_rules import quality_rules
from geoloom.llm.registry import query


@query("op9_ngram_likelihood_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counters, likelihood ratio and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules(docs, table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr", "base_failed", "kept"
    )
