"""Document fingerprints by winnowing, in DataFrame functions only.

A text is a row of units: its words, cut into pieces of at most ``PIECE`` code
points, so that texts without spaces have units too. Each unit is hashed once;
a k-gram hash rolls over k unit hashes as a cyclic polynomial (rotate and xor).
In every window of ``WINDOW`` k-grams the smallest hash is kept, the rightmost
of equals, with its position. Two texts that share ``WINDOW + GRAM - 1`` units
in a row therefore share a fingerprint.

A fingerprint entry packs 32 bits of the hash and the position into one 64-bit
number, so the minimum of a window is a plain minimum; the minima of all
windows take log2(WINDOW) passes over the array.

Defined results: a null text counts as empty; an empty text has the empty
fingerprint, which is like itself (1) and unlike any other (0); a text of fewer
units than a k-gram or a window is one k-gram or one window; repeated rows have
equal fingerprints; an empty table gives no rows; further columns are kept by
``fingerprinted`` and ignored by ``with_next``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from geoloom.llm.common import free_name

PIECE, GRAM, WINDOW = 8, 3, 4
_LAST = 0x7FFFFFFF
#: Ranges of keys per shuffle partition, see ``with_next``.
RANGES = 4


def fingerprinted(df: DataFrame, text: str, out: str, *, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``df`` plus ``out``: the packed (hash, position) entries of ``text`` in order of position."""
    if window & (window - 1):
        raise ValueError("the window is a power of two")
    u, h, p = (free_name(df, n) for n in ("__units", "__grams", "__packed"))
    units = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(rf"[^\x20\x09-\x0D]{{1,{PIECE}}}"), F.lit(0))
    df = df.withColumn(u, F.transform(units, lambda x: F.xxhash64(x)))

    def packed(i: Column) -> Column:
        rolled = None
        for k in range(gram):
            x = F.coalesce(F.get(u, i + k), F.lit(0).cast("bigint"))
            turn = gram - 1 - k
            x = F.shiftleft(x, turn).bitwiseOR(F.shiftrightunsigned(x, 64 - turn)) if turn else x
            rolled = x if rolled is None else rolled.bitwiseXOR(x)
        return F.shiftleft(F.shiftrightunsigned(rolled, 32), 32).bitwiseOR((F.lit(_LAST) - i).cast("bigint"))

    places = F.when(F.size(u) > 0, F.sequence(F.lit(0), F.greatest(F.size(u) - gram, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(h, F.transform(places, packed)).drop(u)
    source, step = h, 1
    while step < window:
        # The tail has no partner; least() passes over its nulls.
        target = f"{p}{step}"
        df = df.withColumn(target, F.zip_with(source, F.slice(source, step + 1, F.size(source)), lambda a, b: F.least(a, b)))
        source, step = target, 2 * step
    # Windows that would reach beyond the text are left out, but a short text is one window.
    whole = F.slice(source, F.lit(1), F.greatest(F.size(h) - window + 1, F.lit(1)))
    df = df.withColumn(out, F.array_distinct(whole))
    return df.drop(h, *[f"{p}{1 << k}" for k in range(window.bit_length() - 1)])


def hashes(entries: Column | str) -> Column:
    """The hashes of the entries, each once."""
    return F.array_distinct(F.transform(entries, lambda x: F.shiftrightunsigned(x, 32)))


def spelled(entries: Column | str) -> Column:
    """Entries as text: hash in hex and position, in order of position."""
    pair = lambda x: F.concat(F.hex(F.shiftrightunsigned(x, 32)), F.lit(":"), (F.lit(_LAST) - x.bitwiseAND(F.lit(_LAST))).cast("string"))
    return F.array_join(F.transform(entries, pair), " ")


def likeness(a: Column | str, b: Column | str) -> Column:
    """Share of common hashes in all hashes of two arrays of ``hashes``; 1 for two empty ones."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    both = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - both
    return F.when(total == 0, F.lit(1.0)).otherwise(both / total)


def with_next(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, text, entries, next_text, next_entries``: each document with the next one by ascending key, the first after the last.

    Keys are cut into ranges at approximate quantiles; a key that fills whole
    ranges is cut further by the hash of the text. Rows of equal keys go by that
    hash and the text; null keys come last. Only the first row of each range is
    looked up across ranges.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.where("id is not null").select("id").stat.approxQuantile("id", [k / n for k in range(1, n)], 0.25 / n) if n > 1 else []
    cuts = [int(c) for c in cuts]
    hot = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b})
    points = sorted(set(cuts))
    listed = F.array(*[F.lit(c).cast("bigint") for c in points]) if points else F.array().cast("array<bigint>")
    part = F.shiftrightunsigned(F.xxhash64("text"), 58)
    at = F.size(F.filter(listed, lambda c: c <= F.col("id"))).cast("bigint") * 66
    at = F.when(F.col("id").isNull(), (len(points) + 1) * 66 + part).otherwise(at + F.when(F.col("id").isin(hot), part).otherwise(64))
    rows = rows.withColumn("range", at.cast("bigint"))
    order = F.struct("id", F.xxhash64("text").alias("h"), "text")
    # One row for each range.
    lowest = rows.groupBy("range").agg(F.min("id").alias("low"))
    heads = rows.join(F.broadcast(lowest), "range").where("id <=> low").groupBy("range").agg(F.min(order).alias("head"))
    every = W.partitionBy(F.lit(0)).orderBy("range")
    around = every.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    follow = F.coalesce(F.lead("head").over(every), F.first("head").over(around))
    heads = heads.select(F.col("range").alias("of"), follow.getField("text").alias("follow"))
    heads = fingerprinted(heads, "follow", "follow_entries")
    own = fingerprinted(rows.repartition("range"), "text", "entries")
    w = W.partitionBy("range").orderBy("id", F.xxhash64("text"), "text")
    own = own.withColumns({"next_text": F.lead("text").over(w), "next_entries": F.lead("entries").over(w), "last": F.lead(F.lit(False), 1, True).over(w)})
    joined = own.join(heads, (F.col("range") == F.col("of")) & F.col("last"), "left")
    return joined.select(
        "id", "text", "entries",
        F.when(F.col("last"), F.col("follow")).otherwise(F.col("next_text")).alias("next_text"),
        F.when(F.col("last"), F.col("follow_entries")).otherwise(F.col("next_entries")).alias("next_entries"),
    )
