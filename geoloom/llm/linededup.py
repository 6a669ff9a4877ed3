"""Removal of repeated runs of lines, by winnowing over line hashes.

A line is what ends at a line break or at a sentence end, so that passages set
into a longer paragraph count too; lines compare without the white space (space,
tab, line breaks, form feeds) around them. A *run* is a stretch of consecutive lines
(lines without words are passed over) with at least ``min_words`` words. The
operator deletes exactly the lines that lie in a run whose lines also occur, as
a run, at an earlier position; positions order by key, then text hash, then line.

1. Windows: for each line the shortest run that starts with it and the shortest
   that ends with it. Of every window the line with the smallest hash (rightmost
   of equals) is a fingerprint, so any two equal runs share fingerprints.
2. Fingerprints join by hash; only repeated ones go on.
3. A match is extended both ways over the windows around its line: each window
   stays in the match while its lines occur at an earlier place too. A place is
   compared with the first one only, so a passage of many documents gives one
   row per place and no pairs.
4. The matched lines of later places are deleted.

Every deleted line has an equal line at an earlier position, so no line vanishes
from the corpus. Overlapping repeats of a line within one run collapse to the
lines not covered by a later window.

Defined results: null and empty texts stay as they are; rows equal in key and
text are one document; a null key sorts first; an empty table gives no rows;
further columns are kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.llm.common import free_name, sliced, written

MIN_WORDS = 50
LINE_END = re.compile(rb"(?<=\n)|(?<=[.!?] )")
_ENDS = (b"\n", b". ", b"! ", b"? ")


def lines(text: bytes) -> list[bytes]:
    """Lines of a UTF-8 text, each with what ends it; joined they are the text again."""
    if b"\0" in text:
        return [x for x in LINE_END.split(text) if x]
    for end in _ENDS:
        text = text.replace(end, end + b"\0")
    return [x for x in text.split(b"\0") if x]


def hashed(text: bytes) -> tuple[list[int], list[int]]:
    """(hash, words) of each line that has words.

    The top bits of a hash rank lines by length, so that windows choose long
    lines, which seldom repeat by chance, before short ones.
    """
    hashes, words = [], []
    for line in lines(text):
        n = len(line.split())
        if n:
            rank = 0 if n >= 8 else 1 if n >= 4 else 2
            hashes.append(rank << 62 | xxhash.xxh3_64_intdigest(line.strip()) >> 2)
            words.append(n)
    return hashes, words


class Lines:
    """The lines of a batch of documents, one after the other."""

    def __init__(self, hashes: np.ndarray, words: np.ndarray, counts: np.ndarray):
        self.hashes, self.words = hashes, words
        self.starts = np.concatenate(([0], np.cumsum(counts)))
        self.doc = np.repeat(np.arange(len(counts)), counts)

    def windows(self, min_words: int) -> np.ndarray:
        """Distinct (first, last) of the shortest runs from and up to each line, in order."""
        n = len(self.words)
        upto = np.concatenate(([0], np.cumsum(self.words)))
        at = np.arange(n)
        last = np.searchsorted(upto, upto[:-1] + min_words) - 1
        first = np.searchsorted(upto, upto[1:] - min_words, side="right") - 1
        forward, backward = last < self.starts[1:][self.doc], first >= self.starts[self.doc]
        spans = np.concatenate([(at[forward] << 20) + last[forward] - at[forward], (first[backward] << 20) + at[backward] - first[backward]])
        spans = np.unique(spans)  # a window has at most min_words lines
        return np.stack([spans >> 20, (spans >> 20) + (spans & 0xFFFFF)], axis=1)

    def minima(self, spans: np.ndarray) -> np.ndarray:
        """Position of the smallest hash of every span, the rightmost of equals."""
        if not len(spans):
            return np.zeros(0, np.int64)
        h, width = self.hashes, spans[:, 1] - spans[:, 0] + 1
        level = [np.arange(len(h))]
        while 2 << (len(level) - 1) <= width.max():
            a, b = level[-1][: -(1 << (len(level) - 1))], level[-1][1 << (len(level) - 1) :]
            level.append(np.where(h[b] <= h[a], b, a))
        out = np.empty(len(spans), np.int64)
        power = np.frexp(width)[1] - 1
        for p in np.unique(power):
            at = np.flatnonzero(power == p)
            a, b = level[p][spans[at, 0]], level[p][spans[at, 1] - (1 << p) + 1]
            out[at] = np.where(h[b] <= h[a], b, a)
        return out


def _hashed_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """``id, row, hashes, words, marks`` of each document; marks are its fingerprint positions."""
    kinds = [("hashes", T.LongType()), ("words", T.IntegerType()), ("marks", T.IntegerType())]
    schema = T.StructType([docs.schema["id"], docs.schema["row"], *(T.StructField(n, T.ArrayType(k)) for n, k in kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            hashes, words, counts = [], [], []
            for value in batch.column(2):
                h, w = hashed(value.as_py() or b"")
                hashes += h
                words += w
                counts.append(len(h))
            own = Lines(np.array(hashes, np.uint64), np.array(words, np.int64), np.array(counts, np.int64))
            marks = np.unique(own.minima(own.windows(min_words)))
            doc = own.doc[marks]
            cols = [
                _lists(own.hashes.view(np.int64), own.starts),
                _lists(own.words.astype(np.int32), own.starts),
                _lists((marks - own.starts[doc]).astype(np.int32), np.searchsorted(doc, np.arange(len(counts) + 1))),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *cols], names=["id", "row", "hashes", "words", "marks"])

    return docs.select("id", "row", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, list lengths) of a list column without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def _matched_windows(docs: DataFrame, min_words: int) -> DataFrame:
    """``id, row, first, last, a, b, again``: the windows around repeated fingerprints (``at``) with a 128-bit hash of their lines.

    ``again`` marks windows whose lines occur earlier in the same document.
    """
    kinds = [T.StructField(n, T.LongType()) for n in ("first", "last", "a", "b")]
    schema = T.StructType([docs.schema["id"], docs.schema["row"], *kinds, T.StructField("again", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            (h, counts), (w, _), (at, hits) = (_flat(batch.column(k)) for k in (2, 3, 4))
            own = Lines(h.view(np.uint64), w.astype(np.int64), counts)
            marked = np.zeros(len(h), bool)
            marked[np.repeat(own.starts[:-1], hits) + at] = True
            spans = own.windows(min_words)
            spans = spans[marked[own.minima(spans)]]
            data, digest = memoryview(own.hashes.tobytes()), xxhash.xxh3_128_digest
            found = b"".join([digest(data[8 * a : 8 * b + 8]) for a, b in spans.tolist()])
            doc = own.doc[spans[:, 0]]
            place = spans - own.starts[doc][:, None]
            keys = [c.take(pa.array(doc)) for c in batch.columns[:2]]
            halves = np.frombuffer(found, np.int64).reshape(-1, 2)
            again = np.ones(len(spans), bool)
            again[np.unique(np.column_stack([doc, halves]), axis=0, return_index=True)[1]] = False
            cols = [pa.array(np.ascontiguousarray(c)) for c in (place[:, 0], place[:, 1], halves[:, 0], halves[:, 1], again)]
            yield pa.RecordBatch.from_arrays([*keys, *cols], names=["id", "row", "first", "last", "a", "b", "again"])

    return docs.select("id", "row", "hashes", "words", "at").mapInArrow(run, schema)


def repeated_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``id, row, spans``: the line spans to delete of each document that has any.

    ``row`` is ``xxhash64(key, text)``; a span is first * 2^32 + last.
    """
    named = docs.select(F.col(key).alias("id"), F.xxhash64(key, text).alias("row"), F.col(text).alias("text"))
    own = written(_hashed_lines(named.where("text is not null"), min_words), "lines")
    marks = own.select("id", "row", F.explode("marks").alias("at"), "hashes")
    marks = marks.select("id", "row", "at", F.get("hashes", F.col("at")).alias("h"))
    # The extra join key gives both sides a shuffle of their own, so that a frequent hash can be split among tasks.
    twice = marks.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select(F.hash("h").alias("k"), "h")
    hits = marks.withColumn("k", F.hash("h")).join(twice, ["k", "h"]).groupBy("id", "row").agg(F.collect_list("at").alias("at"))
    same = F.col("l.id").eqNullSafe(F.col("h.id")) & (F.col("l.row") == F.col("h.row"))
    found = own.alias("l").join(hits.alias("h"), same).select("l.id", "l.row", "l.hashes", "l.words", "h.at")
    matched = written(_matched_windows(found, min_words), "windows")
    place, key = F.struct("id", "row", "first"), F.hash("a", "b").alias("k")
    once = matched.where("not again")
    origin = once.groupBy("a", "b").agg(F.min(place).alias("origin"), F.count("*").alias("n")).where("n > 1").select(key, "a", "b", "origin")
    later = once.select("*", key).join(origin, ["k", "a", "b"]).where(place != F.col("origin")).select("id", "row", "first", "last")
    later = later.unionByName(matched.where("again").select("id", "row", "first", "last"))
    # A span is one number, first * 2^32 + last.
    return later.groupBy("id", "row").agg(F.collect_set(F.shiftleft("first", 32) + F.col("last")).alias("spans"))


CLEANED = T.StructType([T.StructField("text", T.StringType()), T.StructField("removed", T.LongType())])


@F.arrow_udf(CLEANED)
def without_lines(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts (as binary) without the lines of ``spans``; null where there are no spans."""
    out, count = [], []
    for t, s in zip(texts, spans):
        if not s.is_valid:
            out.append(None)
            count.append(0)
            continue
        own = lines(t.as_py())
        real = np.array([k for k, x in enumerate(own) if not x.isspace()])
        span = s.values.to_numpy(zero_copy_only=False)
        change = np.bincount(span >> 32, minlength=len(real) + 1) - np.bincount((span & 0xFFFFFFFF) + 1, minlength=len(real) + 1)
        keep = np.ones(len(own), bool)
        keep[real[np.cumsum(change)[:-1] > 0]] = False
        out.append(b"".join([x for x, k in zip(own, keep.tolist()) if k]))
        count.append(int(len(own) - keep.sum()))
    return pa.StructArray.from_arrays([pa.array(out, pa.binary()).cast(pa.string()), pa.array(count, pa.int64())], names=["text", "removed"])


def dedup_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", removed: str = "removed_lines",
                min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` freed of repeated runs, and the number of deleted lines in column ``removed``."""
    gone = repeated_lines(docs, key=key, text=text, min_words=min_words)
    gone = gone.select(F.col("id").alias("__id"), F.col("row").alias("__row"), F.col("spans").alias("__spans"))
    mine, out = free_name(docs, "__key"), free_name(docs, "__out")
    both = docs.withColumn(mine, F.xxhash64(key, text)).join(
        gone, (F.col(mine) == F.col("__row")) & F.col(key).eqNullSafe(F.col("__id")), "left"
    )
    # Untouched texts do not travel to Python.
    touched = F.when(F.col("__spans").isNotNull(), F.col(text).cast("binary"))
    # Marked as not to be repeated: filters on the result must not run it a second time beside the first.
    both = both.withColumn(out, without_lines.asNondeterministic()(touched, F.col("__spans")))
    cleaned = F.coalesce(F.col(f"{out}.text"), F.col(text)).alias(text)
    cols = [cleaned if c == text else F.col(c) for c in docs.columns if c != removed]
    return both.select(*cols, F.col(f"{out}.removed").alias(removed))
