"""Global ordinals and running sums without a single-task window.

A window with no partition (or with one huge partition) sends every row to one
task. Here an integer order column is cut into blocks; block totals are summed
by a window over *blocks* (a few rows per million input rows), and the rest is
a window inside each block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1_000_000
FAN = 1_000
LEVELS = 3


def _sums_before(totals: DataFrame, by: Sequence[str], pos: str, value: str, out: str, levels: int = LEVELS) -> DataFrame:
    """Exclusive running sum of ``value`` along the integer ``pos``: inside blocks of ``FAN`` rows, over the blocks, and so on.

    The last level alone has a window over a whole group; it sees one row for
    ``FAN ** (levels - 1)`` positions.
    """
    before = lambda keys, order: Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    if levels == 1:
        return totals.withColumn(out, F.coalesce(F.sum(value).over(before(by, pos)), F.lit(0)))
    up, total, base = f"{pos}_", f"{value}_", f"{out}_"
    staged = totals.withColumn(up, F.floor(F.col(pos) / FAN))
    above = _sums_before(staged.groupBy(*by, up).agg(F.sum(value).alias(total)), by, up, total, base, levels - 1).drop(total)
    inner = F.coalesce(F.sum(value).over(before([*by, up], pos)), F.lit(0))
    return staged.withColumn(out, inner).join(above, [*by, up]).withColumn(out, F.col(out) + F.col(base)).drop(up, base)


def running_sum(
    df: DataFrame,
    value: Column,
    *,
    order: str,
    out: str,
    by: Sequence[str] = (),
    inclusive: bool = True,
    block: int = BLOCK,
) -> DataFrame:
    """Running sum of ``value`` in ``order`` (a unique integer per group of ``by``)."""
    staged = df.withColumns({"_v": value.cast("bigint"), "_blk": F.floor(F.col(order) / block)})
    totals = staged.groupBy(*by, "_blk").agg(F.sum("_v").alias("_total"))
    offsets = _sums_before(totals, by, "_blk", "_total", "_offset").drop("_total")
    inside = Window.partitionBy(*by, "_blk").orderBy(order)
    frame = inside.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return (
        staged.withColumn("_run", F.coalesce(F.sum("_v").over(frame), F.lit(0)))
        .join(offsets, [*by, "_blk"])
        .withColumn(out, F.col("_run") + F.col("_offset"))
        .drop("_v", "_blk", "_run", "_offset")
    )


def ordinal(df: DataFrame, *, order: str, out: str, by: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """1-based position in ``order`` within each group of ``by``."""
    return running_sum(df, F.lit(1), order=order, out=out, by=by, block=block)


def even_sample(df: DataFrame, limit: int, *, order: str, by: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """``limit`` evenly spaced rows per group: row ``floor(i * n / limit)`` for each ``i``; all rows when few."""
    numbered = ordinal(df, order=order, out="_pos", by=by, block=block)
    if by:
        sized = numbered.join(df.groupBy(*by).agg(F.count("*").alias("_n")), list(by))
    else:
        sized = numbered.crossJoin(F.broadcast(df.agg(F.count("*").alias("_n"))))
    pos, n = F.col("_pos") - 1, F.col("_n")
    step = n / F.lit(float(limit))
    # Row `pos` is taken when some i satisfies floor(i * step) = pos; test the two integers around pos / step.
    guess = F.floor(pos / step)
    taken = F.lit(False)
    for shift in (0, 1):
        i = guess + shift
        taken = taken | ((i < limit) & (F.least(F.floor(i * step), n - 1) == pos))
    return sized.where((n <= limit) | taken).drop("_pos", "_n")


def stride_sample(df: DataFrame, target: int, *, order: str, by: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """Every ``max(1, n // target)``-th row per group, starting with the first."""
    numbered = ordinal(df, order=order, out="_pos", by=by, block=block)
    if by:
        sized = numbered.join(df.groupBy(*by).agg(F.count("*").alias("_n")), list(by))
    else:
        sized = numbered.crossJoin(F.broadcast(df.agg(F.count("*").alias("_n"))))
    stride = F.greatest(F.lit(1), F.floor(F.col("_n") / target))
    return sized.where(F.pmod(F.col("_pos") - 1, stride) == 0).drop("_pos", "_n")


def blocked_ordinal(
    df: DataFrame, *, block: Sequence[str], within: Sequence[str], out: str, by: Sequence[str] = ()
) -> DataFrame:
    """1-based position when ordered by ``block`` then ``within``; only one block is ever one task's work."""
    counts = df.groupBy(*by, *block).agg(F.count("*").alias("_cnt"))
    before = Window.partitionBy(*by).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, *block, F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*by, *block).orderBy(*within)
    return (
        df.withColumn("_rn", F.row_number().over(inside))
        .join(offsets, [*by, *block])
        .withColumn(out, (F.col("_rn") + F.col("_offset")).cast("bigint"))
        .drop("_rn", "_offset")
    )
