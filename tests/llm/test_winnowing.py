import random
import re

import xxhash
from helpers import frame, odd_documents, prose, with_clashes
from pyspark.sql import functions as F

from geoloom.llm import winnowing as N

MASK = (1 << 64) - 1


def brute(text, gram=N.GRAM, window=N.WINDOW):
    units = [xxhash.xxh64_intdigest(x.encode(), 42) for x in re.findall(rf"[^\x20\x09-\x0D]{{1,{N.PIECE}}}", text or "")]
    if not units:
        return []
    turned = lambda x, k: (x << k | x >> (64 - k)) & MASK if k else x
    grams = []
    for i in range(max(1, len(units) - gram + 1)):
        v = 0
        for k in range(gram):
            v ^= turned(units[i + k] if i + k < len(units) else 0, gram - 1 - k)
        grams.append(v >> 32)
    signed = [g - (1 << 32) if g >> 31 else g for g in grams]
    found = set()
    for a in range(max(1, len(grams) - window + 1)):
        span = range(a, min(a + window, len(grams)))
        found.add(max(i for i in span if signed[i] == min(signed[j] for j in span)))
    return [(grams[i], i) for i in sorted(found)]


def like(a, b):
    a, b = {x for x, _ in brute(a)}, {x for x, _ in brute(b)}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_entries_against_brute_force(spark):
    rng = random.Random(3)
    rows = odd_documents() + [(500 + k, " ".join(rng.choice("ab") for _ in range(k)), "en", "s", 1) for k in range(30)]
    df = with_clashes(frame(spark, rows))
    got = N.fingerprinted(df, "text", "entries").select("text", "score", N.spelled("entries").alias("f")).collect()
    for r in got:
        assert r["f"] == " ".join(f"{h:X}:{p}" for h, p in brute(r["text"]))
        assert r["score"] == "kept as it is"


def test_next_documents(spark):
    rows = odd_documents()
    for parts in (1, 4):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = N.with_next(with_clashes(frame(spark, rows))).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
        hashed = {r[0]: r[1] for r in frame(spark, rows).select("text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()}
        known = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], hashed[r[1]], r[1] or ""))
        nulls = [r["text"] for r in got if r["id"] is None]
        assert len(got) == len(rows)
        # ids in order, then the rows without id, then the first again
        follow = [(r[0], r[1] or "", n[1] or "") for r, n in zip(known, known[1:])]
        have = sorted((r["id"], r["text"], r["next_text"]) for r in got if r["id"] is not None and r["id"] != known[-1][0])
        assert have == sorted(follow)
        (last,) = [r for r in got if r["id"] == known[-1][0]]
        assert last["next_text"] in nulls
        assert sorted(r["next_text"] for r in got) == sorted(r[1] or "" for r in rows)
        for r in got:
            assert [x >> 32 & 0xFFFFFFFF for x in r["next_entries"]] == [h for h, _ in brute(r["next_text"])]


def test_one_document_follows_itself_and_one_key_may_fill_the_table(spark):
    (r,) = N.with_next(frame(spark, [(1, "a b c", "en", "s", 1)])).collect()
    assert r["next_text"] == "a b c"
    rows = [(7, f"text {k}", "en", "s", 1) for k in range(200)] + [(k, "other", "en", "s", 1) for k in (1, 9)]
    got = N.with_next(frame(spark, rows)).collect()
    assert sorted(r["next_text"] for r in got) == sorted(r[1] for r in rows)
    assert N.with_next(frame(spark, [])).count() == 0


def test_likeness(spark):
    rng = random.Random(2)
    a = prose(rng, 300)
    texts = [a, a, a[: len(a) * 3 // 4] + prose(rng, 80), prose(rng, 300), "", None]
    df = N.fingerprinted(frame(spark, [(k, t, "en", "s", 1) for k, t in enumerate(texts)]), "text", "e").withColumn("h", N.hashes("e"))
    both = df.alias("a").join(df.alias("b"), F.lit(True)).select(F.col("a.doc_id").alias("x"), F.col("b.doc_id").alias("y"), N.likeness("a.h", "b.h").alias("l"))
    got = {(r["x"], r["y"]): r["l"] for r in both.collect()}
    assert all(abs(v - like(texts[x], texts[y])) < 1e-12 for (x, y), v in got.items())
    assert got[0, 1] == 1 and 0.4 < got[0, 2] < 0.8 and got[0, 3] < 0.05 and got[4, 5] == 1 and got[0, 4] == 0


def test_a_shared_stretch_shares_a_fingerprint():
    rng = random.Random(9)
    for _ in range(200):
        shared = prose(rng, N.WINDOW + N.GRAM - 1, line=99)
        a, b = f"{prose(rng, 9)} {shared} {prose(rng, 9)}", f"{prose(rng, 4)} {shared} {prose(rng, 5)}"
        assert {x for x, _ in brute(a)} & {x for x, _ in brute(b)}
