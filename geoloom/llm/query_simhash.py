"""Query of the near-duplicate operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geoloom.llm.common import table
from geoloom.llm.registry import query
from geoloom.llm.simhash import near_duplicates


@query("op4_simhash_pigeonring")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
