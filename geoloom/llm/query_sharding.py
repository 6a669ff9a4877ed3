"""Query of the sharding operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import scratch, table, utf8_bytes
from geoloom.llm.registry import query
from geoloom.llm.sharding import write_shards


@query("op3_two_pass_shuffle")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal row counts; sizes and checksums come from the written shards."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    written = write_shards(docs, scratch(spark, "shards"))
    return written.select(
        "doc_id",
        (utf8_bytes(F.col("text")) + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
