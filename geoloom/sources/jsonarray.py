"""Entries of a large JSON array, read by byte ranges.

A file is one JSON object with an array under a known key (``elements``,
``features``). Where an entry begins depends on the state of the text before it:
inside a string or not, and how deep in brackets. So the files are read thrice:

1. Each range sums up its own brackets for both states it may begin in; a fold
   over the ranges of a file gives the true state at each start.
2. With it, each range finds where the array opens and closes and counts its
   separators; a second fold gives each range its part of the array and the
   number of entries before it.
3. Each range yields the entries whose separator (``[`` or ``,``) lies in it.

An entry is JSON text; it is not parsed here, so one odd entry spoils no other.
A file whose brackets or strings do not close is not ``sound``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.sources.ranges import SPLIT, each, files, split_ranges, spread

#: How far before a bracket its key may begin, and how far a type's value may reach beyond a range.
_LOOK = 4_096
_MORE = 1 << 20


def _escaped(data, start: int) -> bool:
    """Whether the byte at ``start`` follows an odd number of backslashes."""
    n, at = 0, start
    while at > 0:
        back = data.read(at - _LOOK if at > _LOOK else 0, at)
        run = len(back) - len(back.rstrip(b"\\"))
        n += run
        if run < len(back):
            break
        at -= len(back)
    return n % 2 == 1


def _unquoted(text: bytes) -> str:
    """The string that stands for ``text`` between quotes."""
    plain = text.decode("utf-8", "replace")
    try:
        return json.loads(f'"{plain}"')
    except ValueError:
        return plain


class Scan:
    """Brackets and commas of some bytes outside strings, with the depth behind each."""

    def __init__(self, text: bytes, in_string: bool, depth: int, escaped: bool):
        raw = np.frombuffer(text, np.uint8)
        quote = np.flatnonzero(raw == 34)
        slash = np.flatnonzero(raw == 92)
        if len(slash) or escaped:
            # A quote counts if the run of backslashes before it is even.
            run_start = slash[np.concatenate(([True], np.diff(slash) != 1))] if len(slash) else slash
            before = np.searchsorted(slash, quote) - 1
            run = np.zeros(len(quote), np.int64)
            has = before >= 0
            has[has] = slash[before[has]] == quote[has] - 1
            first = run_start[np.searchsorted(run_start, quote[has], side="right") - 1] if len(run_start) else run_start
            run[has] = quote[has] - first
            if escaped:  # the run goes on from before these bytes
                run[has] += first == 0
                run[(quote == 0) & ~has] = 1
            quote = quote[run % 2 == 0]
        mark = np.flatnonzero((raw == 44) | (raw == 91) | (raw == 93) | (raw == 123) | (raw == 125))
        inside = (np.searchsorted(quote, mark) + in_string) % 2 == 1
        self.quotes = quote
        self.in_string = (len(quote) + in_string) % 2 == 1
        self.at = mark[~inside]
        self.kind = raw[self.at]
        step = np.isin(self.kind, (91, 123)).astype(np.int64) - np.isin(self.kind, (93, 125))
        self.depth = depth + np.cumsum(step)
        self.end_depth = int(self.depth[-1]) if len(step) else depth

    def outside(self, at: int, in_string: bool) -> bool:
        return (int(np.searchsorted(self.quotes, at)) + in_string) % 2 == 0


def _states(ranges: DataFrame) -> DataFrame:
    """``ranges`` (``path, content, length, start, stop``) plus ``in_string, depth`` at each start and ``sound`` of the file."""

    def summed(data, row):
        text, escaped = data.read(row.start, row.stop), _escaped(data, row.start)
        plain, quoted = Scan(text, False, 0, escaped), Scan(text, True, 0, escaped)
        yield row.path, row.content, row.length, row.start, row.stop, escaped, plain.in_string, plain.end_depth, quoted.end_depth

    def joined(part: pd.DataFrame) -> pd.DataFrame:
        in_string, depth, out = False, 0, []
        for row in part.sort_values("start").itertuples(index=False):
            out.append((row.path, row.content, row.length, row.start, row.stop, row.escaped, in_string, depth))
            depth += row.quoted if in_string else row.plain
            in_string ^= bool(row.turned)
        frame = pd.DataFrame(out, columns=["path", "content", "length", "start", "stop", "escaped", "in_string", "depth"])
        frame["sound"] = (not in_string) and depth == 0 and int(part["length"].iloc[0]) > 0
        return frame

    base = "path string, content binary, length bigint, start bigint, stop bigint, escaped boolean"
    sums = each(ranges, summed, f"{base}, turned boolean, plain bigint, quoted bigint")
    return sums.groupBy("path").applyInPandas(joined, f"{base}, in_string boolean, depth bigint, sound boolean")


def _parts(states: DataFrame, key: str) -> DataFrame:
    """``states`` plus ``low, high, first`` (the range's part of the array, -1 if none, and the entries before it), ``type``, ``found``."""
    named = re.compile(rb'"' + re.escape(key.encode()) + rb'"\s*:\s*$')
    kind_of = re.compile(rb'"type"\s*:\s*"((?:[^"\\]|\\.)*)"')

    def found(data, row):
        text = data.read(row.start, row.stop)
        scan = Scan(text, row.in_string, row.depth, row.escaped)
        comma = (scan.kind == 44) & (scan.depth == 2)
        close = np.flatnonzero((scan.kind == 93) & (scan.depth == 1))
        opened = -1
        for k in np.flatnonzero((scan.kind == 91) & (scan.depth == 2)):
            at = row.start + int(scan.at[k])
            if named.search(data.read(at - _LOOK if at > _LOOK else 0, at)):
                opened = k
                break
        shut = lambda k: row.start + int(scan.at[k])
        end_a = shut(close[0]) if len(close) else -1
        inside = int(comma[: close[0]].sum() if len(close) else comma.sum())
        begin, end_b, after = -1, -1, 0
        if opened >= 0:
            later = close[close > opened]
            begin, end_b = shut(opened), shut(later[0]) if len(later) else -1
            after = 1 + int(comma[opened : later[0]].sum() if len(later) else comma[opened:].sum())
            if len(later) and after == 1 and not text[scan.at[opened] + 1 : scan.at[later[0]]].strip():
                after = 0  # an empty array
        kind = None
        shallow = row.depth == 1 or bool((scan.depth == 1).any())
        for hit in kind_of.finditer(text + data.read(row.stop, row.stop + _LOOK)) if shallow else ():
            if hit.start() < len(text) and scan.outside(hit.start(), row.in_string):
                depth = scan.depth[np.searchsorted(scan.at, hit.start()) - 1] if len(scan.at) and scan.at[0] < hit.start() else row.depth
                if depth == 1:
                    kind = _unquoted(hit.group(1))
                    break
        yield (*(getattr(row, c) for c in _COLUMNS), end_a, inside, begin, end_b, after, kind)

    def joined(part: pd.DataFrame) -> pd.DataFrame:
        within, done, first, kind, out = False, False, 0, None, []
        for row in part.sort_values("start").itertuples(index=False):
            low = high = -1
            own = 0
            if within:
                low, own = row.start, row.inside
                high = row.stop if row.end_a < 0 else row.end_a
                within, done = row.end_a < 0, row.end_a >= 0
            elif not done and row.begin >= 0:
                low, own = row.begin, row.after
                high = row.stop if row.end_b < 0 else row.end_b
                within, done = row.end_b < 0, row.end_b >= 0
            kind = kind if isinstance(kind, str) else row.kind
            out.append((*(getattr(row, c) for c in _COLUMNS), low, high, first))
            first += own
        frame = pd.DataFrame(out, columns=[*_COLUMNS, "low", "high", "first"])
        frame["type"] = kind if isinstance(kind, str) else None
        frame["found"], frame["entries"] = done, first
        return frame

    more = "end_a bigint, inside bigint, begin bigint, end_b bigint, after bigint, kind string"
    sums = each(states, found, f"{_STATE}, {more}")
    return sums.groupBy("path").applyInPandas(joined, f"{_STATE}, low bigint, high bigint, first bigint, type string, found boolean, entries bigint")


_STATE = "path string, content binary, length bigint, start bigint, stop bigint, escaped boolean, in_string boolean, depth bigint, sound boolean"
_COLUMNS = [part.split()[0] for part in _STATE.split(", ")]


def _entries(data, row) -> Iterator[tuple[str, int, str]]:
    """(path, number, text) of the entries whose separator lies in the range."""
    # The part begins outside strings and at the array's depth only if it begins with the array.
    text = data.read(row.start, row.stop)
    scan = Scan(text, row.in_string, row.depth, row.escaped)
    ends = row.start + scan.at[(scan.kind == 44) & (scan.depth == 2)]
    ends = ends[(ends >= row.low) & (ends < row.high)]
    opens = row.low > row.start or (row.low == row.start and not row.in_string and row.depth == 1)
    separators = np.concatenate(([row.low], ends)) if opens else ends
    if not len(separators):
        return
    closed = row.high < row.stop
    bounds = np.append(separators, row.high)
    number = row.first
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        last = b == row.high and not closed
        entry = text[a + 1 - row.start : b - row.start]
        if last:  # the entry goes on behind the range
            entry += _rest(data, row, scan)
        if number or entry.strip() or a != separators[0]:
            yield row.path, number, entry.decode("utf-8", "replace").strip()
        number += 1


def _rest(data, row, scan: Scan) -> bytes:
    """What follows a range up to the next separator or the end of the array."""
    out, at, in_string, depth = b"", row.stop, scan.in_string, scan.end_depth
    while at < row.length:
        more = data.read(at, min(at + _MORE, row.length))
        step = Scan(more, in_string, depth, _escaped(data, at))
        end = np.flatnonzero(((step.kind == 44) & (step.depth == 2)) | (step.depth == 1))
        if len(end):
            return out + more[: int(step.at[end[0]])]
        out, at, in_string, depth = out + more, at + len(more), step.in_string, step.end_depth
    return out


def array_parts(spark: SparkSession, path, key: str, *, split: int = SPLIT) -> DataFrame:
    """The ranges of the files with their part of the array under ``key``; read by ``array_entries`` and ``array_files``."""
    found = files(spark, path, recursive=False)
    ranges = spread(split_ranges(found, start=F.lit(0).cast("bigint"), stop=F.col("length"), split=split), "path", "start")
    return _parts(spread(_states(ranges), "path", "start"), key)


def array_files(parts: DataFrame) -> DataFrame:
    """``source, type, found, sound, entries`` of each file: its ``type`` value, whether it has the array and closes, and the array's length."""
    return parts.groupBy(F.col("path").alias("source")).agg(
        F.max("type").alias("type"), F.bool_or("found").alias("found"), F.bool_and("sound").alias("sound"), F.max("entries").alias("entries"),
    )


def array_entries(parts: DataFrame) -> DataFrame:
    """``source, pos, text`` of every entry of the sound files; ``pos`` counts from 0 in each file."""
    own = parts.where("sound and found and low >= 0")
    return each(spread(own, "path", "start"), _entries, "source string, pos bigint, text string")
