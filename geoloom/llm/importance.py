"""Importance resampling of a corpus towards a target distribution.

1. Features are runs of up to ``runs`` consecutive words, hashed into buckets;
   a document is the array of its buckets, written once.
2. Each bucket has a gain, the rounded log ratio of its smoothed share in the
   target to that in the corpus; counts are over all rows of both. A document's
   weight is the sum of the gains that its array points at, and Gumbel noise
   drawn from the seed and the key turns "the highest scores" into a draw without
   replacement in proportion to exp(weight / 1000).
3. The cutoff of the draw comes from a quantile sketch: a bracket of scores
   around the wanted rank. Exact counts of what lies above and inside tell
   whether the cutoff is in it; if not, the bracket widens. Only the bracket is
   sorted. Drawn rows are ranked by ranges, none in one task.

Defined results: a null text has no words, weight 0 and takes no part in the
draw unless ``min_words`` is 0; a null key draws its noise from the seed alone
and comes after equal scores; repeated rows are rows of their own and share
their score, and if the cutoff falls among equal rows as many are drawn as fit;
an empty corpus gives no rows, an empty target only smoothed shares; further
columns are left alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import ranked, written

#: A word: a run of ASCII digits, small letters and whatever is not ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
RUNS = 1
MIN_WORDS = 20
SEED = 2024
#: Relative rank error of the sketch is one in ``ACCURACY``; the bracket spans a few of that to both sides.
ACCURACY = 10_000
_MARGIN = 2


def _buckets(words: Column, runs: int, buckets: int) -> Column:
    hashed = lambda w: (F.crc32(w.cast("binary")) % buckets).cast("int")
    if runs == 1:
        return F.transform(words, hashed)
    spans = [
        F.when(F.size(words) >= r, F.transform(F.sequence(F.lit(1), F.size(words) - (r - 1)), lambda k: hashed(F.concat_ws(" ", F.slice(words, k, r))))).otherwise(F.array().cast("array<int>"))  # noqa: B023
        for r in range(1, runs + 1)
    ]
    return F.concat(*spans)


def featured(docs: DataFrame, *, keep: list[str], key: str | None = None, text: str = "text", runs: int = RUNS,
             buckets: int = BUCKETS) -> DataFrame:
    """``row`` (columns ``keep`` of ``docs``), ``key``, ``tie`` (a hash of the text), ``n_words`` and ``buckets``.

    ``buckets`` has one entry per feature of the whole text.
    """
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # One entry of an array binds the words to a name, so that they are cut once.
    words = F.array(F.regexp_extract_all(lower, F.lit(WORD), F.lit(0)))
    both = F.transform(words, lambda w: F.struct(F.size(w).alias("n_words"), _buckets(w, runs, buckets).alias("buckets")))
    own = F.struct(*keep) if keep else F.lit(None).cast("string")
    return docs.select(own.alias("row"), (F.col(key) if key else F.lit(None)).alias("key"), F.xxhash64(text).alias("tie"), F.inline(both))


def bucket_counts(features: DataFrame) -> dict[int, int]:
    """Features of each bucket over all rows (at most as many numbers as there are buckets)."""
    counted = features.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    return {r["bucket"]: r["n"] for r in counted.collect()}


def gains(raw: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Gain of every bucket in thousandths: log of its smoothed share of the target over that of the corpus."""
    all_raw, all_target = float(sum(raw.values()) + buckets), float(sum(target.values()) + buckets)
    ratio = lambda b: (target.get(b, 0) + 1.0) * all_raw / ((raw.get(b, 0) + 1.0) * all_target)
    return [math.floor(1000.0 * math.log(ratio(b))) for b in range(buckets)]


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, drawn from seed and key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((draw + 0.5) / 4294967296.0)))


def bracket(scores: DataFrame, k: int, n: int, score: str = "score", accuracy: int = ACCURACY) -> tuple[int | None, int | None, int]:
    """(low, high, rows above high): scores between which the ``k``-th highest of ``n`` lies, proved by exact counts.

    None stands for no bound.
    """
    margin = _MARGIN / accuracy
    while True:
        q = 1 - k / n
        wanted = [max(0.0, q - margin), min(1.0, q + margin)]
        low, high = scores.agg(F.percentile_approx(score, wanted, accuracy).alias("p")).first()["p"]
        low, high = (None if q - margin <= 0 else low), (None if q + margin >= 1 else high)
        above = F.lit(False) if high is None else F.col(score) > high
        below = F.lit(False) if low is None else F.col(score) < low
        got = scores.agg(F.count_if(above).alias("above"), F.count_if(~above & ~below).alias("inside")).first()
        if got["above"] < k <= got["above"] + got["inside"]:
            return low, high, got["above"]
        margin *= 4


def importance(docs: DataFrame, target: DataFrame, *, share: int = 10, key: str = "doc_id", text: str = "text",
               target_text: str = "text", runs: int = RUNS, buckets: int = BUCKETS, min_words: int = MIN_WORDS,
               seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of ``keep``, or of all columns), ``n_features, weight, score, rank`` of all ``docs``.

    ``rank`` (from 1) is that of the ``share`` percent drawn, else null.
    """
    keep = docs.columns if keep is None else keep
    features = written(featured(docs, keep=keep, key=key, text=text, runs=runs, buckets=buckets), "features")
    wanted = featured(target, keep=[], text=target_text, runs=runs, buckets=buckets)
    gain = gains(bucket_counts(features), bucket_counts(wanted), buckets)
    table = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<bigint>")
    weight = F.aggregate("buckets", F.lit(0).cast("bigint"), lambda total, b: total + F.get(table, b))
    rows = features.select("row", "key", "tie", F.size("buckets").cast("bigint").alias("n_features"), weight.alias("weight"), (F.col("n_words") >= min_words).alias("open"))
    rows = written(rows.withColumn("score", F.col("weight") + noise(F.col("key"), seed)), "scores")
    return _drawn(rows, share).select("row", "n_features", "weight", "score", "rank")


def _drawn(rows: DataFrame, share: int) -> DataFrame:
    """``rows`` with the place of the ``share`` percent of highest scores among the open ones."""
    eligible = rows.where("open")
    n = eligible.count()
    k = share * n // 100
    none = F.lit(None).cast("bigint").alias("rank")
    if not k:
        return rows.select("*", none)
    order = [F.col("score").desc(), F.col("key").asc_nulls_last(), F.col("tie").asc()]
    low, high, above = bracket(eligible, k, n)
    inside = eligible.select("score", "key", "tie")
    inside = inside if low is None else inside.where(F.col("score") >= low)
    inside = inside if high is None else inside.where(F.col("score") <= high)
    cut = ranked(inside, [], order).where(F.col("rank") == k - above - 1).first()
    mine = F.col("key")
    if cut["key"] is None:
        tied = mine.isNotNull() | (F.col("tie") <= cut["tie"])
    else:
        tied = (mine < cut["key"]) | ((mine == cut["key"]) & (F.col("tie") <= cut["tie"]))
    reached = F.col("open") & ((F.col("score") > cut["score"]) | ((F.col("score") == cut["score"]) & F.coalesce(tied, F.lit(False))))
    # Equal rows at the cutoff may be more than fit; their ranks tell.
    top = ranked(rows.where(reached), [], order)
    top = top.withColumn("rank", F.when(F.col("rank") < k, F.col("rank") + 1))
    return top.unionByName(rows.where(~reached).select("*", none))


def resampled(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs``."""
    return importance(docs, target, **options).where("rank is not null").select("row.*")
