"""Byte ranges of files: what lets one large file be read by many tasks.

A format whose records can be found from any byte is read by ranges of about
``SPLIT`` bytes. Where a record can only be told from the state at its start
(record chains, nesting of brackets), each range is first summed up on its own,
for every state it might begin in or from a guess where its first record begins.
A fold over the summaries of a file (one row for each range) then gives the state
in which each range really begins, and reads a range again where the guess was
wrong, so the result never rests on a guess. Last, all ranges are decoded.

Tasks read through pyarrow's file systems. Files in a store that only Spark
reads come as whole files with their content, one range each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT = 64 << 20
#: Schemes that tasks can open themselves.
DIRECT = {"", "file", "s3", "s3a", "gs", "hdfs", "abfs", "abfss"}


def _scheme(path: str) -> str:
    head, colon, _ = path.partition(":")
    return head.lower() if colon and "/" not in head else ""


class Bytes:
    """One file, opened in a task; ``content`` stands in for stores that tasks cannot open."""

    def __init__(self, path: str, content: bytes | None = None):
        self.path, self.content, self._file = path, content, None

    def _open(self):
        if self._file is None:
            scheme = _scheme(self.path)
            if scheme in ("", "file"):
                store, name = fs.LocalFileSystem(), self.path.partition(":")[2] if scheme else self.path
                name = "/" + name.lstrip("/") if scheme else name
            else:
                uri = "s3" + self.path[3:] if scheme == "s3a" else self.path
                store, name = fs.FileSystem.from_uri(uri)
            self._file = store.open_input_file(name)
        return self._file

    def __len__(self) -> int:
        return len(self.content) if self.content is not None else self._open().size()

    def read(self, start: int, stop: int) -> bytes:
        """Bytes ``start`` to ``stop``, fewer at the end of the file."""
        start = max(0, start)
        if self.content is not None:
            return self.content[start:stop]
        return self._open().read_at(max(0, min(stop, len(self)) - start), start) if stop > start else b""

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
            self._file = None


def files(spark: SparkSession, path, suffix: str | None = None, *, recursive: bool = True) -> DataFrame:
    """``path, length, content`` of the files below ``path``; ``content`` is null where tasks can open the file."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if suffix:
        found = found.option("pathGlobFilter", "*." + "".join(f"[{c.lower()}{c.upper()}]" for c in suffix))
    found = found.load(path)
    one = found.select("path").first()
    direct = one is None or _scheme(one["path"]) in DIRECT
    # Without the content column Spark lists the files and opens none.
    return found.select("path", "length", (F.lit(None).cast("binary") if direct else F.col("content")).alias("content"))


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Small rows that stand for much work, dealt to all tasks (a given number is not coalesced again)."""
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *by)


def split_ranges(df: DataFrame, *, start: Column, stop: Column, split: int = SPLIT) -> DataFrame:
    """One row per range: ``df`` plus ``start, stop``; a file that came with its content stays whole."""
    step = F.when(F.col("content").isNull(), F.lit(split)).otherwise(F.greatest(stop - start, F.lit(1)))
    starts = F.when(stop > start, F.sequence(start, stop - 1, step)).otherwise(F.array(start))
    return df.select("*", F.explode(starts).alias("start"), step.alias("_step"), stop.alias("_stop")).withColumn(
        "stop", F.least(F.col("start") + F.col("_step"), F.col("_stop"))
    ).drop("_step", "_stop")


def each(df: DataFrame, rows: Callable[..., Iterator[tuple]], schema: str, *, batch: int = 20_000) -> DataFrame:
    """Rows that ``rows(Bytes, row)`` yields for every row of ``df`` (columns ``path`` and ``content`` among others)."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        for part in batches:
            out = []
            for row in part.itertuples(index=False):
                data = Bytes(row.path, row.content)
                try:
                    for x in rows(data, row):
                        out.append(x)
                        if len(out) >= batch:
                            yield pd.DataFrame(out, columns=names)
                            out = []
                finally:
                    data.close()
            yield pd.DataFrame(out, columns=names)

    return df.mapInPandas(run, schema)
