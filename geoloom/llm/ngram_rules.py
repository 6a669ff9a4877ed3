"""Quality rules: exact base counters and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed byte n-grams: one counted on
trusted documents, one on all documents. A document's value is the mean of
log(trusted / raw) over its n-grams; documents below a fixed threshold go.
All corpus counts cover all documents, the trusted ones all documents whose
labels are all 1.

Defined results: a null text counts as empty; a text shorter than an n-gram has
ratio 0; without trusted documents every ratio is 0; repeated rows count as
often as they occur and are judged alike; an empty table gives no rows; further
columns are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

N = 4
BUCKETS = 1 << 16
#: Pseudo-count of a bucket, in units of one n-gram per bucket of either corpus.
PRIOR = 1.0
THRESHOLD = -0.3
SYMBOLS = re.compile(rb"[#*$%&|<>]")
SEPARATORS = bytes([0x20, *range(0x09, 0x0E)])
_FLUSH = 1 << 22


def buckets(text: bytes, n: int = N) -> np.ndarray:
    """Hash bucket of every run of ``n`` bytes."""
    octets = np.frombuffer(text, np.uint8)
    if len(octets) < n:
        return np.zeros(0, np.uint32)
    mixed = np.zeros(len(octets) - n + 1, np.uint32)
    for k in range(n):
        mixed = mixed * np.uint32(0x01000193) + octets[k : len(octets) - n + 1 + k]
    mixed *= np.uint32(0x9E3779B1)
    return mixed >> np.uint32(32 - BUCKETS.bit_length() + 1)


def counts(docs: DataFrame, *, text: str = "text", trusted: str = "trusted", n: int = N) -> DataFrame:
    """``bucket, raw, trusted``: n-grams of all documents and of the trusted ones (rows where ``trusted`` is true)."""
    source = docs.select(F.coalesce(F.col(trusted), F.lit(False)).alias("s"), F.col(text).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        held: list[list[np.ndarray]] = [[], []]
        size = 0

        def flush():
            for k in (0, 1):
                if held[k]:
                    total[k] += np.bincount(np.concatenate(held[k]), minlength=BUCKETS)
                    held[k] = []

        for batch in batches:
            for good, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                b = buckets(value.as_py() or b"", n)
                held[0].append(b)
                if good:
                    held[1].append(b)
                size += len(b)
                if size > _FLUSH:
                    flush()
                    size = 0
        flush()
        used = np.flatnonzero(total[0])
        cols = [pa.array(used), pa.array(total[0][used]), pa.array(total[1][used])]
        yield pa.RecordBatch.from_arrays(cols, names=["bucket", "raw", "trusted"])

    parts = source.mapInArrow(run, "bucket bigint, raw bigint, trusted bigint")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))


def log_ratios(counted: DataFrame) -> np.ndarray:
    """log(trusted / raw) of every bucket; at most ``BUCKETS`` rows reach the driver."""
    raw, trusted = np.full(BUCKETS, PRIOR), np.full(BUCKETS, PRIOR)
    for r in counted.collect():
        raw[r["bucket"]] += r["raw"]
        trusted[r["bucket"]] += r["trusted"]
    if trusted.sum() <= PRIOR * BUCKETS:
        return np.zeros(BUCKETS)
    # The prior follows the raw shares, so that buckets the trusted set is too small to show stay near 0.
    share = raw / raw.sum()
    trusted = trusted - PRIOR + PRIOR * BUCKETS * share
    return np.log(trusted / trusted.sum() / share)


def base_counters(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of UTF-8 ``text``."""
    words = text.split()
    chars = len(text.translate(None, SEPARATORS).decode())
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), chars, len(SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three words that occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
    # Two rounds of renumbering keep every code within 64 bits, whatever the number of words.
    _, pair = np.unique(ids[:-1] * len(names) + ids[1:], return_inverse=True)
    _, window, times = np.unique(pair[:-1] * len(names) + ids[2:], return_inverse=True, return_counts=True)
    twice = np.flatnonzero(times[window] > 1)
    marked = np.zeros(n, bool)
    for k in range(3):
        marked[twice + k] = True
    return int(marked.sum())


RULES = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,llr:double>"
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr")


def judged(table: np.ndarray, n: int = N):
    """Column function: counters and length-normalised log-likelihood ratio of a text (as binary)."""

    @F.arrow_udf(RULES)
    def rules(texts: pa.Array) -> pa.Array:
        rows = []
        for value in texts:
            text = value.as_py() or b""
            b = buckets(text, n)
            rows.append((*base_counters(text), float(table[b].mean()) if len(b) else 0.0))
        cols = list(zip(*rows)) or [[]] * len(FIELDS)
        kinds = [pa.int64()] * 5 + [pa.float64()]
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=list(FIELDS))

    return rules


def trusted_ids(labels: DataFrame, *, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """The ids whose labels are all 1, each once."""
    rows = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("k is not null and y is not null")
    return rows.groupBy("k").agg(F.min("y").alias("y")).where("y = 1").select("k")


def quality_rules(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the base counters, ``llr``, ``base_failed`` and ``kept``."""
    new = {*FIELDS, "base_failed", "kept"}
    plain = docs.drop(*[c for c in docs.columns if c.lower() in new])
    # The id list grows with the labels, so it is never broadcast: one plan for every size.
    good = trusted_ids(labels, key=key).withColumn("trusted", F.lit(True)).hint("merge")
    corpus = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(good, "k", "left")
    table = log_ratios(counts(corpus))
    out = plain.withColumn("__rules", judged(table)(F.col(text).cast("binary"))).select(*plain.columns, "__rules.*")
    out = out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
