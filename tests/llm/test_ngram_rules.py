import math
import random
import re
from collections import Counter

import numpy as np
from helpers import frame, junk, odd_documents, prose, with_clashes

from geoloom.llm import ngram_rules as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counters(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    marked = {k + d for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(marked)


def brute_bucket(gram):
    h = 0
    for b in gram:
        h = (h * 0x01000193 + b) % 2**32
    return (h * 0x9E3779B1) % 2**32 >> 16


def brute_ratio(rows, trusted):
    raw, good = Counter(), Counter()
    for i, text in rows:
        data = (text or "").encode()
        grams = Counter(brute_bucket(data[k : k + R.N]) for k in range(len(data) - R.N + 1))
        raw += grams
        if i in trusted:
            good += grams
    a, b = sum(raw.values()) + R.BUCKETS, sum(good.values()) + R.BUCKETS
    share = lambda g: (raw[g] + 1) / a
    ratio = lambda g: math.log((good[g] + R.BUCKETS * share(g)) / b / share(g))
    out = {}
    for _, text in rows:
        data = (text or "").encode()
        values = [ratio(brute_bucket(data[k : k + R.N])) for k in range(len(data) - R.N + 1)]
        out[text] = sum(values) / len(values) if values else 0.0
    return out


def test_against_brute_force(spark):
    rows = odd_documents()
    labels = [(i, int(i < 40)) for i, *_ in rows if i is not None and i >= 20] + [(None, 1), (20, None), (21, 0)]
    trusted = {i for i, y in labels if y == 1 and i not in (None, 21)}
    labelled = spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = R.quality_rules(with_clashes(frame(spark, rows)), labelled).collect()
    assert len(got) == len(rows)
    want = brute_ratio([(r[0], r[1]) for r in rows], trusted)
    for r in got:
        five = tuple(r[c] for c in R.FIELDS[:5])
        assert five == brute_counters(r["text"])
        assert math.isclose(r["llr"], want[r["text"]], abs_tol=1e-9)
        assert r["base_failed"] == (five[0] < 50 or 100 * five[4] > 50 * five[0])
        assert r["kept"] == (not r["base_failed"] and r["llr"] >= R.THRESHOLD)
        assert r["score"] == "kept as it is"
    odd = [r["llr"] for r in got if r["doc_id"] and r["doc_id"] >= 40]
    assert max(odd) < min(r["llr"] for r in got if r["doc_id"] and 22 <= r["doc_id"] < 40)


def test_junk_goes_and_clean_documents_stay(spark):
    rng = random.Random(6)
    rows = [(k, prose(rng, 300) if k % 4 else junk(rng, 300), "en", "s", 1) for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 4 > 0)) for k in range(0, 400, 3)], "doc_id bigint, quality int")
    got = R.quality_rules(frame(spark, rows), labels).collect()
    assert all(r["kept"] == (r["doc_id"] % 4 > 0) for r in got)


def test_repeated_words_of_many_kinds():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 50, 2000):
        words = [str(x).encode() for x in rng.integers(0, max(2, n // 8), n)]
        assert R.repeated_words(words) == brute_counters(" ".join(w.decode() for w in words))[4]


def test_no_labels_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r["llr"] for r in R.quality_rules(frame(spark, odd_documents()), none).collect()} == {0.0}
    assert R.quality_rules(frame(spark, []), none).count() == 0


def test_all_trusted_documents_count(spark):
    """More labelled documents than the former bound of 20,000."""
    n = 20_500
    docs = spark.range(n).selectExpr("id AS doc_id", "'abcd' AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality")
    assert R.trusted_ids(labels).count() == n
    good = R.trusted_ids(labels).selectExpr("k AS doc_id", "true AS trusted")
    assert [(r["raw"], r["trusted"]) for r in R.counts(docs.join(good, "doc_id", "left")).collect()] == [(n, n)]
