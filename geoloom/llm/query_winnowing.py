"""Query of the document fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import table
from geoloom.llm.registry import query
from geoloom.llm.winnowing import fingerprinted, hashes, likeness, spelled, with_next


@query("op8_winnowing_fingerprints")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness."""
    rows = with_next(table(spark, sf_dir, "documents"))
    rows = rows.withColumn("n_chars", F.length("text").cast("bigint"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next_text", F.lit(1), cut))
    rows = fingerprinted(rows.withColumn("edited", edited), "edited", "edited_entries")
    rows = rows.withColumns({f"h_{c}": hashes(f"{c}entries") for c in ("", "edited_", "next_")})
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        spelled("entries").alias("fingerprint"),
        spelled("edited_entries").alias("edited_fingerprint"),
        likeness("h_", "h_edited_").alias("near_edited"),
        likeness("h_", "h_next_").alias("near_next"),
    )
