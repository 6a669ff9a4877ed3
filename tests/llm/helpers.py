"""Small tables that every operator must survive."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Results and helper columns of the operators, as columns of the input.
CLASHES = ("score", "predicted", "kept", "fp", "row", "id", "ids", "length", "piece", "shard", "slot", "bucket", "tokens", "epoch", "text_crc32", "removed_lines", "llr", "n", "h", "b", "position", "epochs", "rest", "end", "own", "times", "o_first", "o_length", "o_part", "size", "part", "rank", "rank_from", "p_length", "first_seq", "local", "k", "key", "node", "group", "block", "pivot", "sig", "keys", "start", "stop", "place")

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it".split()


def prose(rng: random.Random, words: int, line: int = 12) -> str:
    out = []
    for k in range(words):
        w = "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3)))
        out.append(w + (".\n" if k % (3 * line) == 3 * line - 1 else "." if k % line == line - 1 else ""))
    return " ".join(out).replace("\n ", "\n")


def junk(rng: random.Random, words: int) -> str:
    return " ".join(w + rng.choice(["$$$", "***", "###"]) for w in prose(rng, words).split())


def odd_documents(seed: int = 1) -> list[tuple]:
    """Nulls, empty and long texts, ties, repeated rows, odd characters."""
    rng = random.Random(seed)
    long = prose(rng, 6000)
    rows = [
        (1, None, "en", "src0", None),
        (2, "", None, None, 0),
        (3, " \n\t ", "en", "src1", 4),
        (None, prose(rng, 80), "en", "src0", 1),
        (None, None, None, None, None),
        (4, long, "en", "src0", len(long)),
        (4, long, "en", "src0", len(long)),
        (5, long + " more", "en", "src2", len(long)),
        (6, "x" * 50_000, "de", "src3", 50_000),
        (7, "naïve été 😀 \u2028 \x00 \x1c \u00a0 <s> \\ end", "fr", "src4", 30),
        (8, "one", "es", "src9", 3),
        (9, "one", "es", "src9", 3),
    ]
    rows += [(k, prose(rng, rng.randint(5, 200)), "en", f"src{k % 4}", 9) for k in range(20, 40)]
    rows += [(k, junk(rng, rng.randint(60, 200)), "en", f"src{k % 4}", 9) for k in range(40, 55)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("kept as it is") for c in CLASHES})
