import random

import numpy as np
import xxhash
from helpers import frame, odd_documents, prose, with_clashes

from geoloom.llm import simhash as S


def brute_fingerprint(text, k=4):
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    for sep in b"\t\n\x0b\x0c\r":
        data = data.replace(bytes([sep]), b" ")
    words = [w for w in data.split(b" ") if w]
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, threshold):
    values = sorted(set(fps))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= threshold:
                root[find(a)] = find(b)
    return {v: find(v) for v in values}


def test_fingerprints_and_components_against_brute_force(spark):
    rng = random.Random(5)
    rows = odd_documents()
    base = prose(rng, 900)
    words = base.split(" ")
    for k in range(60):  # near copies, chains of edits and exact copies
        if k % 4 == 0:
            words = base.split(" ")
        words = [w if rng.random() > 0.01 else w + "x" for w in words]
        rows.append((100 + k, " ".join(words), "en", "s", 1))
    rows += [(300 + k, base, "en", "s", 1) for k in range(40)]
    got = S.near_duplicates(with_clashes(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    fps = [(r[0], brute_fingerprint(r[1])) for r in rows]
    assert sorted((r["doc_id"] or -1, r["fingerprint"]) for r in got) == sorted((i or -1, f"{f:016x}") for i, f in fps)
    part = brute_components([f for _, f in fps], 4)
    first = {}
    for i, f in fps:
        if i is not None:
            first[part[f]] = min(i, first.get(part[f], i))
    assert all(r["component_id"] == first.get(part[int(r["fingerprint"], 16)]) for r in got)
    assert len({r["component_id"] for r in got}) < len(set(fps))


def test_links_are_complete_for_every_threshold(spark):
    rng = random.Random(2)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps):
        for flips in (1, 2, 3, 4, 5, 6, 7):
            g = f
            for b in rng.sample(range(64), flips):
                g ^= 1 << b
            fps.add(g)
    signed = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    df = spark.createDataFrame(signed, "fp bigint")
    for threshold, segments in ((0, 3), (2, 4), (4, 5), (4, 9), (6, 8)):
        got = [(int(np.int64(r["u"]).view(np.uint64)), int(np.int64(r["v"]).view(np.uint64))) for r in S.links(df, threshold=threshold, segments=segments).collect()]
        assert all((a ^ b).bit_count() <= threshold for a, b in got)
        want, have = brute_components(fps, threshold), {f: f for f in fps}

        def find(v):
            while have[v] != v:
                v = have[v]
            return v

        for a, b in got:
            have[find(a)] = find(b)
        classes = lambda part: sorted(sorted(g) for g in groups(part).values())
        assert classes(want) == classes({f: find(f) for f in fps}), (threshold, segments)


def groups(part):
    out = {}
    for f, g in part.items():
        out.setdefault(g, []).append(f)
    return out


def test_a_group_of_near_copies_gives_no_pairs(spark):
    rng = random.Random(4)
    center = rng.getrandbits(64)
    fps = {center ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64)}
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp bigint")
    assert len(fps) > 2000
    # every fingerprint meets others under a bounded number of keys, so links grow with their number
    assert S.links(df).count() < 40 * len(fps)


def test_keep_one(spark):
    rows = odd_documents()
    kept = S.keep_one(with_clashes(frame(spark, rows))).collect()
    part = brute_components([brute_fingerprint(r[1]) for r in rows], 4)
    assert len(kept) == len(set(part.values()))
    assert len({part[brute_fingerprint(r["text"])] for r in kept}) == len(kept)
    for r in kept:
        ids = [x[0] for x in rows if part[brute_fingerprint(x[1])] == part[brute_fingerprint(r["text"])] and x[0] is not None]
        assert r["doc_id"] == (min(ids) if ids else None)


def test_empty_table(spark):
    assert S.near_duplicates(frame(spark, [])).count() == 0
    assert S.keep_one(frame(spark, [])).count() == 0
