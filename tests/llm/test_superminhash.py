import random
import time

import numpy as np
import pyarrow as pa
import pytest
from helpers import frame, odd_documents, prose, with_clashes

from geoloom.llm import grouping as G
from geoloom.llm import superminhash as S


def brute_set(text, k=2):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def brute(rows, k=2):
    """(id, size, component, kept) of all rows."""
    sets = [brute_set(r[1], k) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for r, k in zip(rows, range(len(rows))):
        if r[0] is not None:
            low[find(k)] = min(low.get(find(k), r[0]), r[0])
    out = []
    for k, r in enumerate(rows):
        c = low.get(find(k)) if sets[k] else r[0]
        out.append((r[0], len(sets[k]), c, r[0] == c))
    return sorted(out, key=repr)


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else w + "x" for w in words)


def corpus(seed=3):
    rng = random.Random(seed)
    rows = odd_documents()
    for k in range(30):
        words = prose(rng, rng.randint(3, 400)).split()
        rows.append((1000 + 10 * k, " ".join(words), "en", "s", 1))
        rows += [(1001 + 10 * k + j, edited(rng, words, share), "en", "s", 1) for j, share in enumerate((0.0, 0.01, 0.05, 0.06, 0.08, 0.11))]
    return rows


def ran(spark, rows, **options):
    docs = with_clashes(frame(spark, rows)).selectExpr("*", "1 as node", "1 as size", "1 as sig", "1 as keys", "1 as component_id", "1 as n_shingles")
    return sorted(map(tuple, S.near_duplicates(docs, **options).collect()), key=repr)


def test_against_brute_force(spark):
    assert ran(spark, corpus()) == brute(corpus())


def test_chain_of_edits_is_one_component(spark):
    """Each text is linked with the next only; a leader of the bucket reaches few of them."""
    rng = random.Random(4)
    words = prose(rng, 300).split()
    rows = []
    for k in range(40):
        rows.append((k, " ".join(words), "en", "s", 1))
        at = rng.randrange(280)
        words = words[:at] + [w + "q" for w in words[at : at + 15]] + words[at + 15 :]
    assert ran(spark, rows) == brute(rows)


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(G, "BLOCK", 7)
    monkeypatch.setattr(G, "PIVOTS", 2)
    rng = random.Random(6)
    words = prose(rng, 200).split()
    rows = corpus() + [(5000 + k, edited(rng, words, 0.05), "en", "s", 1) for k in range(80)]
    assert ran(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert ran(spark, []) == []


@pytest.mark.parametrize("n", [1, 5, 60, 700, 9000])
def test_signatures_estimate_similarity(n):
    rng = np.random.default_rng(n)
    got = []
    for _ in range(60):
        common, a, b = (np.unique(rng.integers(0, 1 << 63, k).astype(np.uint64)) for k in (8 * n, n, n))
        x, y = (S.superminhash(np.union1d(common, own)) for own in (a, b))
        got.append((x == y).mean())
    assert abs(np.mean(got) - 0.8) < 0.02
    # Independent draws have a deviation of sqrt(0.16 / 120) = 0.0365; correlated ones have no more.
    assert np.std(got) < 0.045


def test_signature_does_not_depend_on_order_or_chunks(monkeypatch):
    own = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    want = S.superminhash(own)
    monkeypatch.setattr(S, "_CHUNK", 311)
    assert (S.superminhash(own[::-1]) == want).all() and S.superminhash(own[:0]).min() == np.iinfo(np.uint64).max


def test_early_stop_changes_nothing():
    """The plain form: all steps of all elements."""
    own = np.random.default_rng(2).integers(0, 1 << 63, 9).astype(np.uint64)
    low = [1 << 64] * 40
    for e in own:
        order = list(range(40))
        for j in range(40):
            draw = int(S.mixed(np.array([(int(e) + S._GOLDEN * (j + 1)) & S._MASK], np.uint64))[0])
            at = j + (draw & 0xFFFFFFFF) % (40 - j)
            order[j], order[at] = order[at], order[j]
            low[order[j]] = min(low[order[j]], j << 32 | draw >> 32)
    assert S.superminhash(own, 40).tolist() == low


def signatures(rows):
    table = pa.table({"size": np.full(len(rows), 400), "sig": [r.tobytes() for r in rows]})
    return G.Signatures(table, S.sketching())


def test_many_unlike_sets_under_one_key():
    """A bucket of 2,000 unlike sets is a matter of its signatures."""
    own = signatures(np.random.default_rng(3).integers(0, 256, (2000, S.PLACES)).astype(np.uint8))
    start = time.perf_counter()
    assert G.forest(2000, own.near) == []
    assert time.perf_counter() - start < 2


def test_links_of_a_group_are_as_many_as_its_nodes():
    own = signatures(np.tile(np.arange(S.PLACES, dtype=np.uint8), (500, 1)))
    assert len(G.forest(500, own.near)) == 499


def test_sets_are_compared_exactly():
    rng = random.Random(7)
    words = prose(rng, 120).split()
    texts = [edited(rng, words, 0.04) for _ in range(60)] + ["", "one"]
    own = G.Sets(pa.table({"text": [t.encode() for t in texts]}), S.sketching())
    for x, t in enumerate(texts):
        a = brute_set(t)
        want = [k for k, u in enumerate(texts) if a and brute_set(u) and 100 * len(a & brute_set(u)) >= 80 * len(a | brute_set(u))]
        assert own.near(x).tolist() == want
