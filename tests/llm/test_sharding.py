import random
import zlib
from collections import Counter

from helpers import frame, odd_documents, with_clashes

from geoloom.llm import sharding as S


def test_fisher_yates_is_a_seeded_permutation():
    a = S.fisher_yates(1000, 7, 3)
    assert sorted(a) == list(range(1000)) and (a == S.fisher_yates(1000, 7, 3)).all()
    assert (a != S.fisher_yates(1000, 8, 3)).any() and (a != S.fisher_yates(1000, 7, 4)).any()
    # every order of three rows comes about equally often
    seen = Counter(tuple(S.fisher_yates(3, s, 0)) for s in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 800


def test_shards_are_even_gapless_and_complete(spark, tmp_path):
    rows = odd_documents()
    got = S.write_shards(with_clashes(frame(spark, rows)), str(tmp_path / "out"), shards=4, bucket_bytes=20_000)
    out = got.collect()
    key = lambda r: (r["doc_id"], zlib.crc32((r["text"] or "").encode()), r["lang"])
    assert Counter(map(key, out)) == Counter((a, zlib.crc32((b or "").encode()), c) for a, b, c, *_ in rows)
    sizes = Counter(r["shard"] for r in out)
    assert set(sizes) == set(range(4)) and max(sizes.values()) - min(sizes.values()) <= 1
    for k, n in sizes.items():
        assert sorted(r["slot"] for r in out if r["shard"] == k) == list(range(n))
    assert all(r["score"] == "kept as it is" for r in out)


def test_same_seed_same_order_and_other_seed_other_order(spark):
    rng = random.Random(3)
    df = frame(spark, [(k, str(rng.random()), "en", "s", 1) for k in range(500)])
    place = lambda seed: {r["doc_id"]: (r["shard"], r["slot"]) for r in S.shard(df, seed=seed).collect()}
    assert place(1) == place(1) != place(2)


def test_empty_table(spark):
    assert S.shard(frame(spark, [])).count() == 0
