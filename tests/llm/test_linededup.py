import random
from collections import Counter

from helpers import frame, odd_documents, prose, with_clashes
from pyspark.sql import functions as F

from geoloom.llm import linededup as L


def brute(docs, min_words):
    """Text of each (key, text) after deleting every line of a run that occurs at an earlier position."""
    parts, first = {}, {}
    order = sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0, d[2]))
    for d in order:
        segs = L.lines((d[1] or "").encode())
        real = [k for k, x in enumerate(segs) if x.split()]
        parts[d] = (segs, real, [segs[k].strip() for k in real], [len(segs[k].split()) for k in real])

    def runs(d):
        _, _, own, words = parts[d]
        for a in range(len(own)):
            total = 0
            for b in range(a, len(own)):
                total += words[b]
                if total >= min_words:
                    yield a, b, tuple(own[a : b + 1])
                    if b - a > 30:
                        break

    for d in order:
        for a, _, run in runs(d):
            first.setdefault(run, (d, a))
    out = {}
    for d in order:
        segs, real, _, _ = parts[d]
        gone = {real[k] for a, b, run in runs(d) if first[run] != (d, a) for k in range(a, b + 1)}
        out[d] = (b"".join(x for k, x in enumerate(segs) if k not in gone).decode() if d[1] is not None else None, len(gone))
    return out


def check(spark, rows, min_words):
    df = with_clashes(frame(spark, [(i, t, "en", "s", 1) for i, t in rows]))
    named = {(r[0], r[1]): r[2] for r in df.select("doc_id", "text", F.xxhash64("doc_id", "text")).collect()}
    want = brute([(i, t, named[(i, t)]) for i, t in rows], min_words)
    got = L.dedup_lines(df, min_words=min_words).collect()
    have = Counter((r["doc_id"], r["text"], r["removed_lines"]) for r in got)
    assert have == Counter((i, *want[(i, t, named[(i, t)])]) for i, t in rows)
    assert all(r["score"] == "kept as it is" for r in got)
    return got


def test_lines_join_to_the_text():
    for text in ("", "a. b! c? d.e\n\n f.\n", "x\0y. z\n", "one"):
        assert b"".join(L.lines(text.encode())).decode() == text
    assert L.lines(b"a. b\nc") == [b"a. ", b"b\n", b"c"]
    assert L.lines(b"a. b\nc\0") == [b"a. ", b"b\n", b"c\0"]


def test_random_texts_against_brute_force(spark):
    rng = random.Random(1)
    bits = ["a b c. ", "d e f g. ", "h. ", "i j! ", "k l m n o p. ", "q\n", "r s\n", "\n", "t u v? ", "long words of a line that has ten of them. "]
    rows = [(rng.choice([None, k, k, k]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for k in range(250)]
    for min_words in (1, 12):
        check(spark, rows + rows[:5], min_words)


def test_passages_inside_paragraphs_go_and_clean_texts_stay(spark):
    rng = random.Random(8)
    passage = "Passage starts here. " + prose(rng, 60, line=10).replace("\n", " ") + " end of it. "
    clean = [(k, prose(random.Random(100 + k), 150)) for k in range(20)]
    planted = [(100 + k, f"{prose(random.Random(200 + k), 30)} before. {passage}{prose(random.Random(300 + k), 30)}") for k in range(30)]
    got = {r["doc_id"]: r for r in check(spark, clean + planted, L.MIN_WORDS)}
    assert all(got[k]["text"] == t for k, t in clean)
    assert "Passage starts" in got[100]["text"]
    assert all("Passage starts" not in got[k]["text"] and "before. " in got[k]["text"] for k, _ in planted[1:])


def test_odd_documents(spark):
    got = check(spark, [(r[0], r[1]) for r in odd_documents()], L.MIN_WORDS)
    long = [r["text"] for r in got if r["doc_id"] in (4, 5)]
    assert sorted(map(len, long))[0] < 100 < sorted(map(len, long))[1]  # repeated rows are one document; the later copy goes


def test_empty_table(spark):
    assert L.dedup_lines(frame(spark, [])).count() == 0
