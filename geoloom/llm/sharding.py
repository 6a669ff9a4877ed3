"""Sharding by a two-pass external shuffle.

Pass 1 scatters the rows uniformly into buckets of about ``bucket_bytes`` by a
seeded hash. Pass 2 brings each bucket into one task's memory, puts it into a
canonical order and shuffles it with a seeded Fisher-Yates. The buckets one
after the other are a random order of all rows; position p of it goes to shard
p mod ``shards``, slot p div ``shards``, so shard sizes in rows differ by at
most one and slots have no gaps. A rerun of any task gives the same rows.

Defined results: null texts and keys are rows like any other; repeated rows are
told apart by their number in the scattered table; an empty table gives no rows
and empty shards; further columns travel along, but for names used here, which
are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.llm.common import free_name, prefix_offsets, utf8_bytes, written

BUCKET_BYTES = 32_000_000
SEED = 42
_OWN = ("bucket", "row_no", "shard", "slot", "position")


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A random order of ``n`` rows: the last open place takes a random one of the rows left, down to the first."""
    draw = np.random.default_rng([seed & 0xFFFFFFFF, bucket]).integers(0, np.arange(n, 0, -1)).tolist()
    order = list(range(n))
    for k, d in zip(range(n - 1, -1, -1), draw):
        order[k], order[d] = order[d], order[k]
    return np.array(order, np.int64)


def scattered(docs: DataFrame, *, key: str = "doc_id", text: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Pass 1: ``docs`` plus ``bucket`` and ``row_no``, written to the shared folder.

    There are at least as many buckets as shuffle partitions, so that small
    tables use all cores too. Rows of one key and text may not share a bucket:
    the row number goes into the hash.
    """
    spark = docs.sparkSession
    docs = docs.drop(*[c for c in docs.columns if c.lower() in _OWN])
    size = docs.agg(F.sum(utf8_bytes(F.col(text)) + 64).alias("s")).first()["s"] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // bucket_bytes))
    rows = docs.withColumn("row_no", F.monotonically_increasing_id())
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), key, "row_no"), F.lit(buckets)).cast("bigint"))
    return written(rows, "scatter")


def shuffled(rows: DataFrame, *, shards: int, seed: int = SEED) -> DataFrame:
    """Pass 2: every bucket of ``scattered`` in a random order, dealt out from the place where the bucket begins."""
    mine = free_name(rows, "__bucket")
    counts = rows.groupBy(F.col("bucket").alias(mine)).agg(F.count("*").alias("n"))
    before = prefix_offsets(counts, [], mine, "n", "position").select(mine, "position")
    # Joined before the grouping, whose shuffle then serves both.
    placed = rows.join(before, F.col("bucket") == F.col(mine)).drop(mine)
    names = [c for c in rows.columns if c not in _OWN]
    fields = [*(rows.schema[c] for c in names), T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())]

    def one(bucket: pa.Table) -> pa.Table:
        own = bucket.sort_by("row_no")
        place = own.column("position")[0].as_py() + np.arange(own.num_rows)
        own = own.take(pa.array(fisher_yates(own.num_rows, seed, own.column("bucket")[0].as_py()))).select(names)
        own = own.append_column("shard", pa.array((place % shards).astype(np.int32)))
        return own.append_column("slot", pa.array(place // shards))

    return placed.groupBy("bucket").applyInArrow(one, T.StructType(fields))


def shard(docs: DataFrame, *, shards: int = 16, key: str = "doc_id", text: str = "text", seed: int = SEED,
          bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` plus ``shard`` (0 to shards - 1) and ``slot`` (place in the shard, from 0)."""
    rows = scattered(docs, key=key, text=text, seed=seed, bucket_bytes=bucket_bytes)
    return shuffled(rows, shards=shards, seed=seed)


def write_shards(docs: DataFrame, path: str, *, shards: int = 16, **options) -> DataFrame:
    """Write ``shard`` of ``docs`` as one folder per shard and return the written table."""
    placed = shard(docs, shards=shards, **options)
    placed.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(placed.schema).parquet(path)
