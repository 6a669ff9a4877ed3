import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from helpers import frame, odd_documents, prose, with_clashes
from pyspark.sql import functions as F

from geoloom.llm import importance as I

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def features(text, runs=1):
    """Words: bytes other than ASCII digits, small letters and what is beyond ASCII separate."""
    words = WORD.findall((text or "").encode().lower())
    return words, [b" ".join(words[k : k + r]) for r in range(1, runs + 1) for k in range(len(words) - r + 1)]


def brute(rows, target, share=10, runs=1, least=20):
    """(key, n_features, weight, score, rank) of all rows."""
    own, raw, want = [], Counter(), Counter()
    for r in rows:
        words, fs = features(r[1], runs)
        buckets = [zlib.crc32(f) % 10_000 for f in fs]
        raw.update(buckets)
        own.append((r[0], len(words), buckets, r[1]))
    for t in target:
        want.update(zlib.crc32(f) % 10_000 for f in features(t, runs)[1])
    a, b = float(sum(raw.values()) + 10_000), float(sum(want.values()) + 10_000)
    gain = lambda k: math.floor(1000 * math.log((want[k] + 1.0) * a / ((raw[k] + 1.0) * b)))
    out = []
    for key, n, buckets, text in own:
        weight = sum(map(gain, buckets))
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n, text or ""])
    able = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for k, x in enumerate(able[: share * len(able) // 100]):
        x[4] = k + 1
    return sorted((tuple(x[:5]) for x in out), key=repr)


def corpus(n=900):
    rng = random.Random(8)
    rows = odd_documents() + [(1000 + k, prose(rng, rng.randint(1, 60)).upper(), "en", "s", 1) for k in range(n)]
    return rows, [prose(rng, 40), "Été 99 naïve", None, ""]


def ran(spark, rows, target, **options):
    docs = with_clashes(frame(spark, rows)).withColumns({c: F.lit(1) for c in ("key", "tie", "buckets", "n_words", "open", "weight", "rank")})
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    out = I.importance(docs, wanted, **options)
    return sorted(map(tuple, out.select("row.doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("share", [10, 50, 100])
def test_against_brute_force(spark, share):
    rows, target = corpus()
    assert ran(spark, rows, target, share=share) == brute(rows, target, share=share)


def test_runs_of_words(spark):
    rows, target = corpus(100)
    assert ran(spark, rows, target, runs=3, min_words=5) == brute(rows, target, runs=3, least=5)


def test_equal_rows_at_the_cutoff(spark):
    rng = random.Random(9)
    rows = [(5, prose(rng, 30), "en", "s", 1)] * 30 + [(None, prose(rng, 30), "en", "s", 1)] * 10
    got = ran(spark, rows, ["th er on"], share=40)
    assert [r[4] for r in got if r[4]] and sorted(r[4] for r in got if r[4]) == list(range(1, 17))


def test_no_target_and_nothing_to_draw(spark):
    rows, _ = corpus(30)
    assert ran(spark, rows, []) == brute(rows, [])
    assert ran(spark, [], ["a"]) == []
    assert {r[4] for r in ran(spark, rows, ["a"], share=0)} == {None}


def test_bracket_widens_until_the_counts_prove_it(spark, monkeypatch):
    scores = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(700)).alias("score"))
    values = sorted((r[0] for r in scores.collect()), reverse=True)
    for accuracy in (2, 20, 10_000):
        for k in (1, 17, 500, 4999, 5000):
            low, high, above = I.bracket(scores, k, 5000, accuracy=accuracy)
            assert (low is None or low <= values[k - 1]) and (high is None or values[k - 1] <= high)
            assert above == (0 if high is None else sum(v > high for v in values))


def test_drawn_rows_keep_their_columns(spark):
    rows, target = corpus(200)
    docs = with_clashes(frame(spark, rows))
    got = I.resampled(docs, spark.createDataFrame([(t,) for t in target], "text string"))
    assert got.columns == docs.columns and got.count() == sum(x[4] is not None for x in brute(rows, target))
