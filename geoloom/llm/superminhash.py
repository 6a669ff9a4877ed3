"""Near-duplicates by SuperMinHash, banding, confirmation on full sets, and union-find.

SuperMinHash gives every element of a set a random permutation of the signature's
places instead of one independent draw per place: in step j the element offers
the value j + r (r in [0, 1)) to the j-th place of its permutation, and a place
keeps its smallest offer. The offers of one element are thus correlated, which
lowers the variance of the estimate for small sets, and a set is done as soon as
the step number exceeds every kept value: a set of n elements takes about
(places / n) * log(places) steps instead of ``places``.

``BANDS`` keys of ``ROWS`` places each are the candidates' meeting points: sets of
similarity s share one with probability 1 - (1 - s^ROWS)^BANDS, at 0.8 that is
0.99993. The rest is ``grouping``: pairs whose signatures agree in too few places
(five standard deviations below the least similarity) are ruled out, all others
confirmed on the full sets.

Defined results: null and empty texts, and texts without words, have an empty set
and are linked with nothing; a text of fewer words than a shingle is one shingle;
repeated rows are one node; null keys are carried, and the smallest non-null key
names a component (null if there is none); an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.grouping import Sketch, near_groups

SHINGLE = 2
PERCENT = 80
BANDS = 24
ROWS = 5
PLACES = BANDS * ROWS
_CHUNK = 4_096
_GOLDEN, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of UTF-8 ``text``, lower-cased in A-Z."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the separators \\x20 and \\x09-\\x0D
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(shingle, len(words))
    n = len(words) - size + 1
    own = np.full(n, size, np.uint64)
    for k in range(size):
        own = mixed((own + np.uint64(_GOLDEN)) ^ hashes[k : k + n])
    return np.unique(own)


def superminhash(own: np.ndarray, places: int = PLACES) -> np.ndarray:
    """Signature of a set of 64-bit hashes: per place the smallest offer, step in the upper and draw in the lower half."""
    low = np.full(places, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(own), _CHUNK):
        seeds = own[k : k + _CHUNK]
        rows = np.arange(len(seeds))
        order = np.tile(np.arange(places, dtype=np.int16), (len(seeds), 1))
        for j in range(places):
            if int(low.max()) >> 32 < j:
                break  # every offer of this and later steps is larger than what is kept
            draw = mixed(seeds + np.uint64(_GOLDEN * (j + 1) & _MASK))
            at = j + ((draw & np.uint64(0xFFFFFFFF)) % np.uint64(places - j)).astype(np.int64)
            place = order[rows, at]
            order[rows, at] = order[:, j]
            np.minimum.at(low, place, np.uint64(j << 32) | (draw >> np.uint64(32)))
    return low


def sketch(own: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> tuple[bytes, np.ndarray]:
    """8 bits of every place, and the band keys (none for the empty set)."""
    low = superminhash(own, bands * rows)
    short = (mixed(low) >> np.uint64(56)).astype(np.uint8).tobytes()
    if not len(own):
        return short, np.zeros(0, np.uint64)
    data = low.tobytes()
    keys = [xxhash.xxh64_intdigest(data[8 * rows * k : 8 * rows * (k + 1)], k) for k in range(bands)]
    return short, np.array(keys, np.uint64)


def alike(one: np.ndarray, many: np.ndarray, least: int) -> np.ndarray:
    """Places in which signatures agree, less the fewest that a link may have."""
    return (many == one).sum(axis=1, dtype=np.int64) - least


def sketching(shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> Sketch:
    places, s = bands * rows, percent / 100
    least = max(1, math.floor(places * s - 5 * math.sqrt(places * s * (1 - s))))
    return Sketch(partial(shingles, shingle=shingle), partial(sketch, bands=bands, rows=rows), np.dtype(np.uint8), partial(alike, least=least), percent)


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``key, n_shingles, component_id, kept`` of every row of ``docs``."""
    named = docs.select(F.col(key).alias("id"), F.xxhash64(key, text).alias("row"), F.col(text).alias("text"))
    found = near_groups(named, sketching(shingle, percent, bands, rows))
    first = found.where("size > 0").groupBy("group").agg(F.min("id").alias("first"))
    # The extra join key gives both sides a shuffle of their own, so that a large group can be split among tasks.
    first = first.select(F.hash("group").alias("k"), "group", "first")
    out = found.withColumn("k", F.hash("group")).join(first, ["k", "group"], "left")
    component = F.when(F.col("size") > 0, F.col("first")).otherwise(F.col("id"))
    out = out.select(F.col("id").alias(key), F.col("size").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
