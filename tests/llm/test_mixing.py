import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

from helpers import frame, odd_documents, with_clashes
from pyspark.sql import functions as F

from geoloom.llm import mixing as M

WEIGHTS = (("domain", {"a": 3, "b": 1}), ("lang", {"en": 2}), ("source", {}))


def fill(budget, children):
    """Shares of {name: (capacity, weight)}: repeatedly saturate whoever cannot take its share."""
    out, left, open_ = {}, budget, dict(children)
    while open_:
        weight = sum(w for _, w in open_.values())
        full = [n for n, (c, w) in open_.items() if weight and Fraction(c) <= Fraction(left * w, weight) and w]
        if not full:
            return out | {n: left * w // weight if weight else 0 for n, (_, w) in open_.items()}
        for n in full:
            out[n] = open_.pop(n)[0]
        left = budget - sum(out.values())
    return out


def brute_budgets(leaves, total, epochs):
    def weight(level, name):
        return WEIGHTS[level][1].get(name, 1)

    given, level = {(): total}, 0
    for level in range(3):
        kids = defaultdict(dict)
        for leaf, tokens in leaves.items():
            c, w = kids[leaf[:level]].get(leaf[level], (0, weight(level, leaf[level])))
            kids[leaf[:level]][leaf[level]] = (c + tokens * epochs, w)
        given = {(*p, n): b for p, k in kids.items() for n, b in fill(given[p], k).items()}
    return given


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute(rows, total, epochs, seed):
    leaves = Counter()
    for r in rows:
        leaves[r["domain"] or "", r["lang"] or "", r["source"] or ""] += words(r["text"])
    budget, out = brute_budgets(leaves, total, epochs), Counter()
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    for leaf, tokens in leaves.items():
        if not tokens:
            continue
        own = [r for r in rows if (r["domain"] or "", r["lang"] or "", r["source"] or "") == leaf]
        whole, rest = divmod(budget[leaf], tokens)
        place = lambda r: md5(f"{seed}:{whole}:{r['doc_id'] if r['doc_id'] is not None else 'text:' + md5(r['text'] or '')}")
        for r in own:
            upto = sum(words(x["text"]) for x in own if place(x) <= place(r))
            for e in range(whole + (whole < epochs and upto <= rest)):
                out[r["doc_id"], r["text"], e] += 1
    return out


def corpus(spark):
    rng = random.Random(7)
    rows = odd_documents()
    for k in range(300):
        text = " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 60)))
        rows.append((1000 + k, text, rng.choice(["en", "en", "de", None]), rng.choice(["src0"] * 6 + ["src1", "src2", None]), 1))
    return frame(spark, rows).withColumn("domain", F.when(F.col("source") == "src0", "a").when(F.col("source") == "src2", None).otherwise("b"))


def test_against_brute_force(spark):
    df = corpus(spark).cache()
    rows = df.collect()
    tokens = sum(words(r["text"]) for r in rows)
    for total, epochs in ((tokens // 2, 1), (tokens, 3), (tokens * 9 // 10, 1), (tokens * 5, 2), (0, 2)):
        got = Counter((r["doc_id"], r["text"], r["epoch"]) for r in M.mixed(df, WEIGHTS, budget=total, max_epochs=epochs).collect())
        assert got == brute(rows, total, epochs, M.SEED), (total, epochs)


def test_budgets_redistribute_to_siblings_first(spark):
    rows = [("a", "en", "s", 10), ("a", "de", "s", 1000), ("b", "en", "s", 1000)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, tokens bigint")
    got = {(r["domain"], r["lang"]): r["budget"] for r in M.budgets(leaves, 400, WEIGHTS, max_epochs=1).collect()}
    # a gets 300 of 400; its "en" takes 10, and its sibling "de" takes the rest, not "b"
    assert got == {("a", "en"): 10, ("a", "de"): 290, ("b", "en"): 100}


def test_zero_weights_get_nothing(spark):
    leaves = spark.createDataFrame([("a", "x", "s", 50), ("b", "x", "s", 50)], "domain string, lang string, source string, tokens bigint")
    weights = (("domain", {"a": 0, "b": 1}), ("lang", {}), ("source", {}))
    got = {r["domain"]: r["budget"] for r in M.budgets(leaves, 80, weights, max_epochs=1).collect()}
    assert got == {"a": 0, "b": 50}


def test_clashing_columns_and_empty_table(spark):
    df = with_clashes(corpus(spark))
    got = M.mixed(df, WEIGHTS, share=0.5)
    assert {"score", "epoch", "tokens"} <= set(got.columns) and got.count() > 0
    assert got.select("score").distinct().collect()[0][0] == "kept as it is"
    assert M.mixed(df.limit(0), WEIGHTS).count() == 0
