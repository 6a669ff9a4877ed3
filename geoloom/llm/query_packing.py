"""Query of the packing operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from geoloom.llm.common import table
from geoloom.llm.packing import packed_pieces
from geoloom.llm.registry import query


def default_tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op10_best_two_fit")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 1024 tokens, one row per piece."""
    packed = packed_pieces(table(spark, sf_dir, "documents"), default_tokenizer())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
