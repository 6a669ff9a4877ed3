import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import frame, odd_documents, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from geoloom.llm import packing as P
from geoloom.llm.query_packing import default_tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    own = Tokenizer.from_file(default_tokenizer())
    return lambda t: own.encode(t, add_special_tokens=False).ids


def test_fast_encoder_agrees_on_every_character(tokenizer):
    fast = P.encoder(default_tokenizer())
    for c in map(chr, range(0x250)):
        for t in (c, f"a{c}b", f"1{c} {c}{c} x", f" {c}\n{c}  {c}", f"'{c}s{c}'S"):
            assert fast(t) == tokenizer(t), repr(t)
    assert fast("<|endoftext|> 日本語   x") == tokenizer("<|endoftext|> 日本語   x")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'sdré.1 ")), max_size=60))
def test_fast_encoder_agrees_on_random_texts(tokenizer, text):
    assert P.encoder(default_tokenizer())(text) == tokenizer(text)


@pytest.mark.parametrize("text", ["<|endoftext|>", " <|endoftext|><|endoftext|> x", "<|endoftext", "é<|endoftext|>\n\n日"])
def test_added_tokens(tokenizer, text):
    assert P.encoder(default_tokenizer())(text) == tokenizer(text)


def check_bins(counts, plan, capacity):
    used = Counter()
    for items, times in plan:
        assert sum(items) <= capacity and times > 0
        for x in items:
            used[x] += times
    assert used == Counter({k: v for k, v in counts.items() if v})


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(0, 50), max_size=25))
def test_plan_packs_everything(counts):
    plan = P.pack_plan(counts, 40)
    check_bins(counts, plan, 40)
    bins = sum(t for _, t in plan)
    # no worse than first-fit decreasing
    free = []
    for size in sorted((k for k, v in counts.items() for _ in range(v)), reverse=True):
        k = next((k for k, f in enumerate(free) if f >= size), None)
        if k is None:
            free.append(40 - size)
        else:
            free[k] -= size
    assert bins <= len(free) + max(1, len(free) // 20)


def test_two_pieces_replace_the_smallest():
    # 60 + 30 leaves 10; two pieces of 20 fill the gap that 30 leaves
    left = np.zeros(101, np.int64)
    left[[60, 30, 20]] = 1, 1, 2
    assert sorted(P._two_for_smallest([60, 30], left, 100, 100)) == [20, 20, 60]


@pytest.mark.parametrize("times", [1, 10, 1000])
def test_swaps_pay(times):
    """The plan that counts has swaps, and no more bins than the greedy one without."""
    rng = random.Random(17)
    counts = Counter(min(1024, int(rng.lognormvariate(5.5, 1))) + 1 for _ in range(4000))
    counts = {min(1024, k): v * times for k, v in counts.items()}
    plan, swapped = P.best_plan(counts)
    check_bins(counts, plan, 1024)
    greedy, none = P._planned(counts, 1024, 0, 0.0)
    assert none == 0 and swapped > 0 and sum(t for _, t in plan) <= sum(t for _, t in greedy)


def test_large_histograms_plan_quickly_and_tightly():
    rng = random.Random(1)
    counts = {k: int(10**9 * rng.random() ** 3 / k**0.5) for k in range(1, 1025)}
    plan = P.pack_plan(counts)
    check_bins(counts, plan, 1024)
    tokens = sum(k * v for k, v in counts.items())
    assert sum(t for _, t in plan) < 1.002 * tokens / 1024 and len(plan) < 5000


def test_pieces_and_places(spark, tokenizer):
    rows = odd_documents()
    df = with_clashes(frame(spark, rows))
    got = P.packed_pieces(df, default_tokenizer(), keep_ids=True).collect()
    want = Counter()
    for i, text, *_ in rows:
        ids = np.array([*tokenizer(text or ""), 2], "<u4")
        cut = len(ids) % 1024 or 1024
        bounds = [0, *range(cut, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            want[(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = {}
    for r in got:
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        by.setdefault(r["sequence_id"], []).append(r)
    for own in by.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    assert len(by) <= -(-sum(r["length"] for r in got) // 1024) + 1
    packed = spark.createDataFrame(got, P.packed_pieces(df, default_tokenizer(), keep_ids=True).schema)
    joined = {r["sequence_id"]: bytes(r["ids"]) for r in P.sequences(packed).collect()}
    assert joined == {s: b"".join(bytes(r["ids"]) for r in sorted(own, key=lambda r: r["offset"])) for s, own in by.items()}


def test_one_length_in_many_blocks(spark):
    df = spark.range(5000).selectExpr("id", "300L as length", "'x' as sequence")
    got = P.pack(df, order=["id"], rank_block=100).collect()
    assert len(got) == 5000 and Counter(Counter(r["sequence_id"] for r in got).values()) == {3: 1666, 2: 1}
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 5000


def test_bad_lengths_and_empty_table(spark):
    with pytest.raises(ValueError):
        P.pack(spark.createDataFrame([(1, 2000)], "id bigint, length bigint"), order=["id"])
    with pytest.raises(ValueError):
        P.pack(spark.createDataFrame([(1, None)], "id bigint, length bigint"), order=["id"])
    assert P.packed_pieces(frame(spark, []), default_tokenizer()).count() == 0
