import hashlib
import random
import zlib

import pytest
from helpers import DOCS, frame, odd_documents, prose, with_clashes
from pyspark.sql import functions as F

from geoloom.llm import merkle as M


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))


def brute_tree(leaves):
    """Root, and the siblings (before, after) of every leaf from the leaf up."""
    paths, level = [[] for _ in leaves], list(leaves)
    at = list(range(len(leaves)))
    while len(level) > 1:
        for leaf, k in enumerate(at):
            run = level[k // 16 * 16 : k // 16 * 16 + 16]
            paths[leaf].append(("".join(run[: k % 16]), "".join(run[k % 16 + 1 :])))
            at[leaf] = k // 16
        level = [sha("".join(level[k : k + 16])) for k in range(0, len(level), 16)]
    return level[0], paths


def brute(rows):
    """Sorted (doc_id, leaf, subroot, root, proof) of all rows."""
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, brute_leaf(r), r[0]))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda x: x[:3])
        trees[s] = brute_tree([x[2] for x in by[s]])
    root, above = brute_tree([trees[s][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for x, path in zip(by[s], trees[s][1]):
            proof = sha("".join(a + b for a, b in path + above[k]))
            out.append((x[3], x[2], trees[s][0], root, proof))
    return sorted(out, key=repr)


def many(n=700, seed=5):
    rng = random.Random(seed)
    rows = [(rng.randrange(-50, 10_000), prose(rng, 3), "en", rng.choice(["hot", "hot", "hot", "é", "z", None]), k) for k in range(n)]
    rows += [(k, "t", "en", f"s{k:02d}", 1) for k in range(40)]  # more than 16 groups, most of one leaf
    return rows + rows[:20] + [rows[0]] * 35


@pytest.mark.parametrize("rows", [odd_documents(), many(), odd_documents()[:1], many()[:16], many()[:17]], ids=["odd", "many", "one", "16", "17"])
def test_against_brute_force(spark, rows):
    made = M.manifest(with_clashes(frame(spark, rows)).withColumns({c: F.lit(1) for c in ("leaf", "rank", "group", "key", "idx", "digest", "place")}))
    path = F.col("path")
    found = M.proofs(made, made.leaves)
    got = found.select("key", "leaf", "subroot", "root", F.sha2(M.siblings(path), 256).alias("p"), M.folded(F.col("leaf"), path).alias("f")).collect()
    assert all(r["f"] == r["root"] for r in got)
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(rows)


def test_some_requests_give_the_same_proofs(spark):
    made = M.manifest(frame(spark, many()))
    whole = {(r["group"], r["rank"]): r["path"] for r in M.proofs(made, made.leaves).collect()}
    some = M.proofs(made, made.leaves.where("rank % 7 = 3 or `group` is null")).collect()
    assert some and all(whole[r["group"], r["rank"]] == r["path"] for r in some)


def test_a_changed_leaf_does_not_fold_to_the_root(spark):
    made = M.manifest(frame(spark, many()))
    bad = M.proofs(made, made.leaves).select("root", M.folded(F.sha2("leaf", 256), F.col("path")).alias("f"))
    assert bad.where("f = root").count() == 0


def test_records_name_what_they_hold(spark, tmp_path):
    made = M.manifest(frame(spark, many()))
    M.write_manifest(made, str(tmp_path / "m"))
    rows = M.read_manifest(spark, str(tmp_path / "m")).collect()
    assert all(r["digest"] == sha("".join(r["children"])) and 1 <= len(r["children"]) <= 16 for r in rows)
    assert len({(r["level"], r["digest"]) for r in rows}) == len(rows)


def test_equal_runs_are_one_record(spark):
    made = M.manifest(spark.createDataFrame([(1, "same", "en", "s", 4)] * 64, DOCS))
    assert made.levels[0].count() == 4 and made.levels[0].distinct().count() == 1
    assert {r["f"] == r["root"] for r in M.proofs(made, made.leaves).select("root", M.folded(F.col("leaf"), F.col("path")).alias("f")).collect()} == {True}


def test_one_changed_row_changes_only_its_path(spark):
    rows = [(k, f"text {k}", "en", "s", 1) for k in range(600)]
    changed = rows[:300] + [(300, "other", "en", "s", 1)] + rows[301:]
    records = []
    for r in (rows, changed):
        made = M.manifest(frame(spark, r))
        records.append({(k, x["digest"]) for k, level in enumerate(made.levels) for x in level.collect()})
    assert len(records[0] - records[1]) == len(records[1] - records[0]) == 3


def test_empty_table(spark):
    made = M.manifest(frame(spark, []))
    assert made.root is None and M.proofs(made, made.leaves).count() == 0


def test_crc_of_the_tampered_fifth(spark):
    row = spark.range(1).select(F.crc32(F.lit(123).cast("string")).alias("c")).first()
    assert row["c"] == zlib.crc32(b"123")
