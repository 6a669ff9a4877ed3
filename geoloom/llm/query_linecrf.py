"""Query of the quality classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import table
from geoloom.llm.linecrf import held_out, quality
from geoloom.llm.registry import query


@query("op5_line_crf_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
