"""Helpers the operators of this subpackage share: shared scratch folders and text rules."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of every operator here: a run of bytes other than space and the controls \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; only a local session without one gets its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="geoloom-shared-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/geoloom-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, readable after executors are lost."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``rows`` rows, so that what a task derives from one batch stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use yet, whatever the case of its own names."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = "_" + name
    return name


def prefix_offsets(counts: DataFrame, group: list[str], order: str, value: str, out: str, block: int = 1024) -> DataFrame:
    """Exclusive running sum of ``value`` per ``group`` along the integer ``order``.

    Two levels (inside blocks of consecutive ``order`` values, then over the
    blocks), so that no task sorts a whole group.
    """
    from pyspark.sql import Window as W

    b, inner, total = "__block", "__inner", "__total"
    rows = counts.withColumn(b, F.floor(F.col(order) / block))
    w = W.partitionBy(*group, b).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn(inner, F.coalesce(F.sum(value).over(w), F.lit(0)))
    blocks = rows.groupBy(*group, b).agg(F.sum(value).alias(total))
    w = W.partitionBy(*[F.col(g) for g in group] or [F.lit(0)]).orderBy(b).rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn(total, F.coalesce(F.sum(total).over(w), F.lit(0)))
    keys = [*group, b]
    joined = rows.alias("r").join(blocks.alias("s"), [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    return joined.select(*[F.col(f"r.{c}") for c in counts.columns], (F.col(f"r.{inner}") + F.col(f"s.{total}")).alias(out))


def ranked(df: DataFrame, group: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    """``df`` plus ``out``, the place (from 0) of each row of a ``group`` in ``order``; written to the shared folder.

    Rows are dealt by ranges of group and order and sorted inside them, so a
    group of any size is spread over many tasks. What a range adds to the places
    after it is a sum over at most one count per range and group.
    """
    from pyspark.sql import Window as W

    part, at, first, n, before = (free_name(df, x) for x in ("__part", "__at", "__first", "__n", "__before"))
    keys = [F.col(g).asc_nulls_first() for g in group] + order
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # The identifier counts the rows of a task in its lower 33 bits.
    number = F.monotonically_increasing_id()
    place = [F.shiftright(number, 33).alias(part), number.bitwiseAND(F.lit((1 << 33) - 1)).alias(at)]
    rows = written(dealt.select("*", *place), "ranked")
    counts = rows.groupBy(*group, part).agg(F.count("*").alias(n), F.min(at).alias(first))
    earlier = W.partitionBy(*[F.col(g) for g in group] or [F.lit(0)]).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn(before, F.coalesce(F.sum(n).over(earlier), F.lit(0)) - F.col(first))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*group, part]]
    joined = rows.alias("r").join(counts.alias("c"), same)
    return joined.select(*[F.col(f"r.{c}") for c in df.columns if c != out], (F.col(f"r.{at}") + F.col(f"c.{before}")).alias(out))


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
