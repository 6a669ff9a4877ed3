"""Query of the line dedup operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geoloom.llm.common import table
from geoloom.llm.linededup import dedup_lines
from geoloom.llm.registry import query


@query("op7_winnowed_line_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of every document without the runs of lines that repeat earlier ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "removed_lines", "text")
