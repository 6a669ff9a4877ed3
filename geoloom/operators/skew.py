"""Joins and lineage cuts that survive hot keys and lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_ROWS = 500_000
HOT_KEYS = 65_536


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    spread: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    width: int | None = None,
) -> DataFrame:
    """Join to a side that is unique on ``keys``; keys repeated very often on the left are salted.

    ``spread`` are left columns that differ between rows of one key. The hot
    keys travel as 64-bit hashes in a table cut to ``HOT_KEYS`` rows, so the
    broadcast is bounded; a hash collision only salts one key too many. With
    ``width`` the left rows stay in that many tasks, however few bytes they have.
    """
    hashed = F.xxhash64(*keys)
    hot = F.broadcast(
        left.groupBy(hashed.alias("_h"))
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > hot_rows)
        .orderBy(F.col("_n").desc(), "_h")
        .limit(HOT_KEYS)
        .select("_h", F.ceil(F.col("_n") / float(hot_rows)).cast("int").alias("_salts"))
    )
    tag = lambda df: df.withColumn("_h", hashed).join(hot, "_h", "left").withColumn(
        "_salts", F.coalesce("_salts", F.lit(1))
    )
    lhs = tag(left).withColumn("_salt", F.pmod(F.xxhash64(*spread), F.col("_salts")).cast("int")).drop("_h", "_salts")
    rhs = tag(right).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_h", "_salts")
    if width is not None:
        lhs = lhs.repartition(width, *keys, "_salt")
    return lhs.join(rhs, [*keys, "_salt"], how).drop("_salt")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in ``spark.checkpoint.dir``; only a local session without one gets its own folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="geoloom-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of an intermediate result."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_shuffles(df: DataFrame) -> None:
    """Delete the shuffle files of a result that was cut or stored; else they stay until the driver happens to collect its garbage."""
    df._jdf.queryExecution().toRdd().cleanShuffleDependencies(True)


def stored(df: DataFrame) -> DataFrame:
    """A wide intermediate result written once as Parquet in the shared folder and read from there by all its users."""
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/geoloom-stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Component (smallest member) of every node that has an edge; columns ``node, component``.

    Alternating star contraction: each round links all larger neighbours of a
    node to its smallest neighbour, so long chains shrink in logarithmic time.
    Ends when a round changes no link, and raises if ``max_rounds`` do not suffice.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = cut_lineage(pairs)
    for _ in range(max_rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        latest = cut_lineage(small.unionByName(low.withColumnRenamed("m", "v")).where("u <> v").distinct())
        # Both sides are sets of the same size exactly if neither holds a link that the other lacks.
        same = latest.count() == pairs.count() and latest.join(pairs, ["u", "v"], "left_anti").isEmpty()
        pairs = latest
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = pairs.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)

