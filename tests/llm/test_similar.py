import random
from collections import Counter
from fractions import Fraction

import numpy as np
from helpers import frame, odd_documents, prose, with_clashes

import corpus_pipeline as P
from geoloom.llm import grouping as G
from geoloom.llm import similar as S


def brute_set(text, k=5):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def brute_groups(texts):
    sets = list({brute_set(t) for t in texts})
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and Fraction(len(a & b), len(a | b)) >= Fraction(4, 5):
                root[find(i)] = find(j)
    return {s: find(k) for k, s in enumerate(sets)}


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else w + "x" for w in words)


def corpus():
    rng = random.Random(12)
    rows = odd_documents()
    for k in range(40):  # copies with 0.5, 1, 2 and 6 percent of the words changed
        words = prose(rng, rng.randint(200, 900)).split()
        rows.append((1000 + 10 * k, " ".join(words), "en", "s", 1))
        rows += [(1001 + 10 * k + j, edited(rng, words, share), "en", "s", 1) for j, share in enumerate((0.005, 0.01, 0.02, 0.06))]
    return rows


def test_one_of_each_group_against_brute_force(spark):
    rows = corpus()
    part = brute_groups([r[1] for r in rows])
    kept = S.keep_one_similar(with_clashes(frame(spark, rows))).collect()
    assert len(kept) == len(set(part.values())) == len({part[brute_set(r["text"])] for r in kept})
    for r in kept:
        ids = [x[0] for x in rows if part[brute_set(x[1])] == part[brute_set(r["text"])] and x[0] is not None]
        assert r["doc_id"] == (min(ids) if ids else None)
        assert r["score"] == "kept as it is"


def test_stage_drops_near_copies_that_differ_in_many_bits(spark):
    """Fails with the contract values of op4: half of these copies differ in more than four bits."""
    rng = random.Random(13)
    rows = []
    for k in range(60):
        words = prose(rng, 400).split()
        rows += [(2 * k, " ".join(words), "en", "s", 1), (2 * k + 1, edited(rng, words, 0.01), "en", "s", 1)]
    sets = [brute_set(r[1]) for r in rows]
    close = [k for k in range(60) if len(sets[2 * k] & sets[2 * k + 1]) >= 0.8 * len(sets[2 * k] | sets[2 * k + 1])]
    kept = {r["doc_id"] for r in P.near_dedup(spark, frame(spark, rows), "").collect()}
    assert len(close) > 50
    assert kept == {2 * k for k in range(60)} | {2 * k + 1 for k in range(60) if k not in close}


def test_candidates_by_similarity(spark):
    """Recall of the segments and the ring alone, on random pairs by their exact similarity."""
    rng = np.random.default_rng(15)
    how, found, every = S.sketching(), Counter(), Counter()
    for _ in range(1500):
        n = int(rng.integers(80, 600))
        common = rng.integers(0, 1 << 63, n)
        extra = int(n * rng.uniform(0.02, 0.13))
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 1 << 63, extra)]).astype(np.uint64)) for _ in range(2))
        s = n / (n + 2 * extra)
        if s < 0.8:
            continue
        (x, k), (y, m) = S.sketch(a), S.sketch(b)
        meet = bool((k == m).any()) and how.alike(np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16)[None])[0] >= 0
        band = "0.80" if s < 0.85 else "0.85" if s < 0.9 else "0.90"
        every[band] += 1
        found[band] += meet
    share = {b: found[b] / every[b] for b in every}
    assert min(every.values()) > 100 and share["0.80"] >= 0.9 and share["0.85"] >= 0.96 and share["0.90"] >= 0.99, share


def test_ring_is_the_plain_definition():
    rng = np.random.default_rng(16)
    one = rng.integers(0, 1 << 16, S.RING).astype(np.uint16)
    bits = lambda x: [int(v).bit_count() for v in x]
    many = np.array([one ^ np.array([(rng.random(16) < p) @ (1 << np.arange(16)) for _ in range(S.RING)], np.uint16) for p in rng.uniform(0, 0.3, 300)])
    most = S.threshold()
    for score, other in zip(S.alike(one, many, most), many):
        d = bits(one ^ other)
        chains = any(all(sum((d + d)[i : i + n]) <= n * most // S.RING for n in range(1, S.RING + 1)) for i in range(S.RING))
        assert chains == (sum(d) <= most) == (score >= 0) and (score < 0 or score == most - sum(d))


def test_a_task_compares_and_joins_links_in_one_python_worker(spark, monkeypatch):
    plans, own = [], G.written
    monkeypatch.setattr(G, "BLOCK", 8)  # large buckets and clusters, so that both kinds of blocks are compared
    monkeypatch.setattr(G, "written", lambda df, name: plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())) or own(df, name))
    docs = frame(spark, [(k, f"{prose(random.Random(5), 80)} {k}", "en", "src0", 9) for k in range(40)])
    assert S.keep_one_similar(docs).count() == 1
    links = [plan for name, plan in plans if name == "links"]
    assert len(links) >= 3
    assert all(plan.count("MapInArrow") == 1 for plan in links)


def test_empty_table(spark):
    assert S.keep_one_similar(frame(spark, [])).count() == 0
