"""Bulk ingest of ESRI shapefiles and their attribute tables.

Files are read by byte ranges (``ranges``), so one large file is the work of many
tasks: record heads are found from a likely chain of heads in each range, put
right by a fold over the ranges of the file, and decoded from there. Tables have
records of one width. A damaged file yields an error row instead of failing the
job, the same one at any split.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.operators.features import nest_rings
from geoloom.sources.ranges import SPLIT, Bytes, each, files, split_ranges, spread

# Layout of the shapefile format.
FILE_CODE, VERSION, HEADER = 9994, 1000, 100
NULL_TYPE = 0
POINT_TYPES, MULTIPOINT_TYPES, POLYGON_TYPES = (1, 11, 21), (8, 18, 28), (5, 15, 25)

_CHUNK = 1 << 20
#: A table's header length is a 16-bit number.
_TABLE_HEAD = 1 << 16
_KINDS = np.isin(np.arange(32), (NULL_TYPE, *POINT_TYPES, *MULTIPOINT_TYPES, *POLYGON_TYPES))


def _named(path: str) -> str:
    """A file is named by its whole path without the suffix, so equal names in two folders differ."""
    head, slash, tail = path.rpartition("/")
    return head + slash + (tail.rpartition(".")[0] or tail)


def _header_error(data: bytes, allowed: tuple[int, ...]) -> str | None:
    if len(data) < HEADER:
        return "file is too small for a header"
    code, version, kind = (
        struct.unpack_from(">i", data, 0)[0],
        struct.unpack_from("<i", data, 28)[0],
        struct.unpack_from("<i", data, 32)[0],
    )
    if code != FILE_CODE or version != VERSION:
        return "invalid header"
    return None if kind in allowed else f"unexpected shape type {kind}"


def _heads(data: bytes, base: int, at: int, stop: int, length: int) -> Iterator[tuple[int, int, int]]:
    """(offset, record number, end) of the records that begin in ``at`` .. ``stop``; ``data`` begins at ``base``.

    A head or content beyond the file's ``length`` is the last record; its end lies behind the file.
    """
    while at < stop:
        if at + 8 > length:
            yield at, -1, length + 1
            return
        number, words = struct.unpack_from(">2i", data, at - base)
        end = at + 8 + 2 * words
        if words < 0 or end > length:
            yield at, number, length + 1
            return
        yield at, number, end
        at = end


def _resync(data: bytes, base: int, start: int, stop: int, length: int) -> int:
    """A likely record head at or after ``start``: a chain of numbered records of known types; -1 if there is none.

    The fold over the ranges of a file replaces a wrong guess.
    """
    begin = start + (start & 1) - base
    for chunk in range(begin, stop - base, _CHUNK):
        part = np.frombuffer(data[chunk : chunk + _CHUNK + 12], ">u2", offset=0, count=(min(len(data), chunk + _CHUNK + 12) - chunk) // 2)
        if len(part) < 6:
            continue
        n = len(part) - 5
        wide = part.astype(np.int64)
        number, words = wide[:n] << 16 | wide[1 : n + 1], wide[2 : n + 2] << 16 | wide[3 : n + 3]
        swapped = (wide & 0xFF) << 8 | wide >> 8
        kind = swapped[4 : n + 4] | swapped[5 : n + 5] << 16
        offset = base + chunk + 2 * np.arange(n)
        fits = (number > 0) & (number < 1 << 31) & (words >= 2) & (offset + 8 + 2 * words <= length) & (kind < 32)
        for k in np.flatnonzero(fits & _KINDS[np.minimum(kind, 31)]).tolist():
            at, want, seen = int(offset[k]), int(number[k]), 0
            if at >= stop:
                break
            for _, number_, end in _heads(data, base, at, min(stop, base + len(data) - 8), length):
                if number_ != want + seen or end > length:
                    seen = -1
                    break
                seen += 1
                if seen > 3:
                    break
            if seen >= 0:
                return at
    return -1


def _ranges(files: DataFrame, split: int) -> DataFrame:
    """``path, length, content, at, stop, index``: where the records of each range of the files really begin, and their number."""

    def summed(data, row):
        base, last = row.start, min(row.length, row.stop + 12)
        body = data.read(base, last)
        first = HEADER if row.start == HEADER else _resync(body, base, row.start, row.stop, row.length)
        count, end = 0, -1
        if first >= 0:
            for _, _, end in _heads(body, base, first, row.stop, row.length):
                count += 1
        yield row.path, row.length, row.content, row.start, row.stop, first, end, count

    def joined(part: pd.DataFrame) -> pd.DataFrame:
        at, index, out = HEADER, 0, []
        for row in part.sort_values("start").itertuples(index=False):
            if at >= row.stop:
                continue  # inside a long record, or behind a damaged one
            count, end = row.count, row.end
            if row.first != at:  # the guess was wrong: walk from the true place
                data, count = Bytes(row.path, row.content), 0
                body = data.read(at, row.stop + 12)
                for _, _, end in _heads(body, at, at, row.stop, row.length):
                    count += 1
                data.close()
            out.append((row.path, row.length, row.content, at, row.stop, end, index))
            at, index = end, index + count
        return pd.DataFrame(out, columns=["path", "length", "content", "at", "stop", "end", "index"])

    first = split_ranges(files.where(f"length > {HEADER}"), start=F.lit(HEADER).cast("bigint"), stop=F.col("length"), split=split)
    sums = each(
        spread(first, "path", "start"), summed,
        "path string, length bigint, content binary, start bigint, stop bigint, first bigint, end bigint, count bigint",
    )
    return sums.groupBy("path").applyInPandas(
        joined, "path string, length bigint, content binary, at bigint, stop bigint, end bigint, index bigint"
    )


def _records(spark: SparkSession, path, allowed: tuple[int, ...], rows, schema: str, split: int) -> DataFrame:
    """Rows of ``rows(file, index, number, content)`` for every record; ``content`` is None for a truncated one.

    A file with a bad header gives ``rows(file, -1, -1, problem)``.
    """

    def checked(data, row):
        yield row.path, row.length, row.content, _header_error(data.read(0, HEADER), allowed)

    def decoded(data, row):
        body, file = data.read(row.at, min(row.end, row.length)), _named(row.path)
        for i, (at, number, end) in enumerate(_heads(body, row.at, row.at, row.stop, row.length)):
            content = body[at + 8 - row.at : end - row.at] if end <= row.length else None
            yield from rows(file, row.index + i, number, content)

    def refused(data, row):
        yield from rows(_named(row.path), -1, -1, row.problem)

    found = each(spread(files(spark, path, "shp"), "path"), checked, "path string, length bigint, content binary, problem string")
    good = _ranges(found.where("problem is null").drop("problem"), split)
    return each(spread(good, "path", "at"), decoded, schema).unionByName(each(found.where("problem is not null"), refused, schema))


def _floats(content: bytes, start: int, count: int) -> np.ndarray:
    return np.frombuffer(content, "<f8", 2 * count, start).reshape(-1, 2)


def _polygon_rings(content: bytes) -> tuple[list | None, str | None]:
    if len(content) < 4:
        return None, "record has no shape type"
    kind = struct.unpack_from("<i", content)[0]
    if kind == NULL_TYPE:
        return [], None
    if kind not in POLYGON_TYPES:
        return None, f"unsupported shape type {kind}"
    if len(content) < 44:
        return None, "truncated record"
    n_parts, n_points = struct.unpack_from("<2i", content, 36)
    points_at = 44 + 4 * n_parts
    if n_parts <= 0 or n_points < 4 or len(content) < points_at + 16 * n_points:
        return None, "invalid part data"
    starts = np.frombuffer(content, "<i4", n_parts, 44)
    if starts[0] != 0 or (np.diff(starts) < 0).any() or starts[-1] >= n_points:
        return None, "invalid part offsets"
    rings = np.split(_floats(content, points_at, n_points), starts[1:])
    return [r.tolist() for r in rings if len(r) >= 4], None


def _points(content: bytes) -> tuple[list | None, str | None]:
    if len(content) < 4:
        return None, "record has no shape type"
    kind = struct.unpack_from("<i", content)[0]
    if kind == NULL_TYPE:
        return [], None
    if kind in POINT_TYPES:
        return (_floats(content, 4, 1).tolist(), None) if len(content) >= 20 else (None, "truncated point")
    if kind in MULTIPOINT_TYPES:
        count = struct.unpack_from("<i", content, 36)[0] if len(content) >= 40 else -1
        if count < 0 or len(content) < 40 + 16 * count:
            return None, "invalid multipoint data"
        return _floats(content, 40, count).tolist(), None
    return None, f"unsupported shape type {kind}"


def read_polygons(spark: SparkSession, path, *, split: int = SPLIT) -> DataFrame:
    """Polygon records: ``file, shape_index, record_number, parts, error`` (null shapes have no parts).

    A file is read in ranges of about ``split`` bytes; the result does not depend on it.
    """

    def rows(file, index, number, content):
        if isinstance(content, str):
            yield file, -1, -1, [], [], [], content
            return
        rings, error = (None, "truncated file") if content is None else _polygon_rings(content)
        points = [p for r in rings or [] for p in r]
        yield file, index, number, [p[0] for p in points], [p[1] for p in points], [len(r) for r in rings or []], error

    schema = (
        "file string, shape_index bigint, record_number bigint, xs array<double>, ys array<double>, lens array<int>, "
        "error string"
    )
    raw = _records(spark, path, POLYGON_TYPES, rows, schema, split)
    return raw.withColumn("parts", nest_rings(F.col("xs"), F.col("ys"), F.col("lens"))).drop("xs", "ys", "lens")


def read_points(spark: SparkSession, path, *, split: int = SPLIT) -> DataFrame:
    """Point and multipoint records, one row per point: ``file, shape_index, record_number, point_index, x, y, is_null, error``."""

    def rows(file, index, number, content):
        if isinstance(content, str):
            yield file, -1, -1, 0, np.nan, np.nan, False, content
            return
        points, error = (None, "truncated file") if content is None else _points(content)
        if not points:
            yield file, index, number, 0, np.nan, np.nan, error is None, error
        for k, (x, y) in enumerate(points or [], start=1):
            yield file, index, number, k, x, y, False, None

    schema = (
        "file string, shape_index bigint, record_number bigint, point_index bigint, x double, y double, "
        "is_null boolean, error string"
    )
    return _records(spark, path, POINT_TYPES + MULTIPOINT_TYPES, rows, schema, split)


def _attribute(raw: bytes, kind: str, decimals: int) -> str | None:
    text = raw.decode("latin-1").strip()
    if not text:
        return None
    if kind in "NFBY":
        if decimals == 0 and "." not in text and "," not in text:
            try:
                return str(int(text))
            except ValueError:
                return text
        try:
            return repr(float(text.replace(",", ".")))
        except ValueError:
            return text
    if kind == "L":
        flag = text.upper()
        return "true" if flag in ("Y", "T") else "false" if flag in ("N", "F") else text
    return text


def _table_head(head: bytes, length: int) -> tuple[str | None, int, int, int, list]:
    """(problem, records, offset of the first, width, fields) of a table; a field is (name, kind, offset, length, decimals)."""
    bad = lambda problem: (problem, 0, 0, 0, [])
    if length < 33:
        return bad("table is too small")
    count, header, width = struct.unpack_from("<IHH", head, 4)
    if header > length or width <= 1:
        return bad("invalid table header")
    fields, at, offset = [], 32, 1
    while at + 32 <= length and at < len(head) and head[at] != 0x0D:
        name = head[at : at + 11].split(b"\x00", 1)[0].decode("latin-1").strip()
        size = head[at + 16] if at + 17 < len(head) else 0
        if not name or size <= 0:
            return bad("invalid field descriptor")
        fields.append((name, chr(head[at + 11]).upper(), offset, size, head[at + 17]))
        offset, at = offset + size, at + 32
    if at >= len(head) or head[at] != 0x0D:
        return bad("missing field terminator")
    return None, count, header, width, fields


def read_attributes(spark: SparkSession, path, *, split: int = SPLIT) -> DataFrame:
    """Attribute rows: ``file, shape_index, deleted, attrs, error``; numbers keep their value as text.

    Records have one width, so ranges of record numbers are ranges of bytes.
    """

    def headed(data, row):
        problem, count, header, width, _ = _table_head(data.read(0, _TABLE_HEAD), row.length)
        whole = 0 if problem else min(count, (row.length - header) // width)
        yield row.path, row.length, row.content, problem, count, header, width, whole

    def decoded(data, row):
        file = _named(row.path)
        if row.problem is not None:
            yield file, -1, False, None, row.problem
            return
        *_, fields = _table_head(data.read(0, _TABLE_HEAD), row.length)
        body = data.read(row.header + row.start * row.width, row.header + row.stop * row.width)
        for i in range(row.start, row.stop):
            record = body[(i - row.start) * row.width : (i - row.start + 1) * row.width]
            if record[:1] == b"*":
                yield file, i, True, None, None
                continue
            values = [(n, _attribute(record[o : o + ln], k, d)) for n, k, o, ln, d in fields]
            yield file, i, False, {n: v for n, v in values if v is not None}, None
        if row.stop == row.whole < row.count:
            yield file, row.whole, False, None, "truncated table"

    head = "path string, length bigint, content binary, problem string, count bigint, header bigint, width bigint, whole bigint"
    tables = each(spread(files(spark, path, "dbf"), "path"), headed, head)
    records = F.greatest(F.lit(1), F.floor(F.lit(split) / F.greatest("width", F.lit(1)))).cast("bigint")
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("whole") - 1, F.lit(0)), F.when(F.col("content").isNull(), records).otherwise(F.col("whole") + 1))
    ranges = tables.select("*", F.explode(starts).alias("start"), records.alias("_n")).withColumn(
        "stop", F.least("whole", F.when(F.col("content").isNull(), F.col("start") + F.col("_n")).otherwise(F.col("whole")))
    )
    ranges = spread(ranges.drop("_n").where("problem is not null or count > 0"), "path", "start")
    return each(ranges, decoded, "file string, shape_index bigint, deleted boolean, attrs map<string,string>, error string")
