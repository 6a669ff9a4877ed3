"""Elevation grids, canopy images and point clouds.

Of a grid file the catalogue reads the header lines only. Values are read for the
tiles of a catalogue alone, in byte ranges: a first look counts the lines that
begin in each range, which gives the row number of its first line, and the second
one reads the rows. A catalogue that was cut to a region thus cuts what is read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoloom.functions import attributes as A
from geoloom.operators.quality import duplicate_keys
from geoloom.params import NODATA_DEFAULT
from geoloom.sources.ranges import SPLIT, each, files, split_ranges, spread

HEADER_LINES = 6


_HEAD_BYTES = 1 << 12
#: Most bytes that header lines are looked for in.
_MOST_HEAD = 1 << 20


def _head(data) -> tuple[str, int]:
    """The header lines of a grid file and the offset of the first row."""
    size = _HEAD_BYTES
    while True:
        text = data.read(0, size)
        at = -1
        for _ in range(HEADER_LINES):
            at = text.find(b"\n", at + 1)
            if at < 0:
                break
        if at >= 0 or len(text) < size or size >= _MOST_HEAD:
            body = at + 1 if at >= 0 else len(text)
            return text[:body].decode("utf-8", "replace"), body
        size *= 16


def _grids(spark: SparkSession, path) -> DataFrame:
    """``path, tile, value`` of each grid file (any upper/lower case of the suffix); ``value`` is its header."""
    heads = each(
        spread(files(spark, path, "asc"), "path"), lambda data, row: [(row.path, _head(data)[0])], "path string, value string"
    )
    return heads.withColumn("tile", F.element_at(F.split("path", "/"), -1))


def _header() -> Column:
    lines = F.slice(F.split("value", "\r?\n"), 1, HEADER_LINES)
    words = F.filter(F.transform(lines, lambda s: F.split(A.strip(s), r"\s+")), lambda w: F.size(w) >= 2)
    entry = lambda w: F.struct(F.lower(F.get(w, F.lit(0))).alias("key"), A.to_number(F.get(w, F.lit(1))).alias("value"))
    return F.transform(words, entry)


def read_tiles(spark: SparkSession, path, layer: str) -> DataFrame:
    """Tile catalogue from the grid headers with ``error`` for unusable ones."""
    df = _grids(spark, path).select("path", "tile", _header().alias("_h"))
    value = lambda key: F.get(F.filter("_h", lambda e: e["key"] == key), F.lit(0))["value"]
    cell = value("cellsize")
    corner = lambda axis: F.coalesce(value(f"{axis}llcorner"), value(f"{axis}llcenter") - cell / 2.0)
    df = df.select(
        F.lit(layer).alias("layer"),
        "path",
        "tile",
        value("ncols").cast("int").alias("ncols"),
        value("nrows").cast("int").alias("nrows"),
        corner("x").alias("xll"),
        corner("y").alias("yll"),
        cell.alias("cellsize"),
        F.coalesce(value("nodata_value"), F.lit(NODATA_DEFAULT)).alias("nodata"),
    )
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in ("ncols", "nrows", "cellsize", "xll", "yll")]
    problems = F.concat_ws(", ", F.array_compact(F.array(*missing)))
    return df.withColumn("error", F.when(problems != "", F.concat(F.lit("missing header keys: "), problems)))


def duplicate_tiles(tiles: DataFrame) -> DataFrame:
    """Tile names used more than once, ignoring case."""
    return duplicate_keys(tiles, F.lower("tile"), ["path"])


def _in_box(tiles: DataFrame, box) -> DataFrame:
    x0, y0, x1, y1 = box
    width, height = F.col("ncols") * F.col("cellsize"), F.col("nrows") * F.col("cellsize")
    apart = (F.col("xll") + width < x0) | (F.col("xll") > x1) | (F.col("yll") + height < y0) | (F.col("yll") > y1)
    return tiles.where(~apart)


def read_cells(spark: SparkSession, tiles: DataFrame, path, *, box=None, split: int = SPLIT) -> DataFrame:
    """Grid values ``tile, row, col, x, y, z`` of the given tiles; nodata becomes null.

    Rows with a wrong number of values are reported by :func:`bad_rows`. Only
    tiles in ``tiles`` are opened, and with a ``box`` (x0, y0, x1, y1) only those
    that touch it; cells whose centre lies outside are left out.
    """
    y = F.col("yll") + (F.col("nrows") - F.col("row") - 0.5) * F.col("cellsize")
    rows = _grid_rows(spark, tiles if box is None else _in_box(tiles, box), path, split)
    if box is not None:
        rows = rows.where(y.between(box[1], box[3]))
    values = rows.select("tile", "row", "xll", "yll", "nrows", "cellsize", "nodata", F.posexplode("values").alias("col", "raw"))
    z = A.to_number(F.col("raw"))
    cells = values.select(
        "tile",
        "row",
        "col",
        (F.col("xll") + (F.col("col") + 0.5) * F.col("cellsize")).alias("x"),
        y.alias("y"),
        F.when(z != F.col("nodata"), z).alias("z"),
    )
    return cells if box is None else cells.where(F.col("x").between(box[0], box[2]))


def _line_starts(data, row) -> tuple[bytes, int]:
    """The bytes from the first line that begins in a range up to its end, and where they begin.

    A line begins at the first row and behind every line feed.
    """
    body = data.read(row.start - 1, row.stop) if row.start > row.body else data.read(row.start, row.stop)
    if row.start == row.body:
        return body, row.start
    at = body.find(b"\n")
    return (b"", row.stop) if at < 0 or row.start + at >= row.stop else (body[at + 1 :], row.start + at)


_TILE = "tile string, ncols int, nrows int, xll double, yll double, cellsize double, nodata double"
_TILE_COLUMNS = [part.split()[0] for part in _TILE.split(", ")]


def _grid_rows(spark: SparkSession, tiles: DataFrame, path, split: int = SPLIT) -> DataFrame:
    found = files(spark, path, "asc")
    named = tiles.where("error is null").select("path", *_TILE_COLUMNS).dropDuplicates(["path"])
    if found.where("content is null").isEmpty():
        named = named.join(found.select("path", "content"), "path")
    else:
        named = named.withColumn("content", F.lit(None).cast("binary"))
    tile = lambda row: tuple(getattr(row, c) for c in _TILE_COLUMNS)

    def sized(data, row):
        yield row.path, row.content, _head(data)[1], len(data), *tile(row)

    def counted(data, row):
        own, at = _line_starts(data, row)
        # A line feed at the end of a range begins a line of the next one.
        yield row.path, row.start, 0 if at >= row.stop else 1 + own[:-1].count(b"\n")

    def decoded(data, row):
        own, at = _line_starts(data, row)
        if at >= row.stop:
            return
        end = row.stop
        while end < row.length and not own.endswith(b"\n"):  # the rest of the last line
            more = data.read(end, end + _HEAD_BYTES * 16)
            cut = more.find(b"\n")
            own += more if cut < 0 else more[: cut + 1]
            end += len(more) if cut < 0 else cut + 1
        lines = own.split(b"\n")
        for k, line in enumerate(lines[:-1] if own.endswith(b"\n") else lines):
            if row.first + k < row.nrows:
                yield *tile(row), row.first + k, line.rstrip(b"\r").decode("utf-8", "replace")

    whole = each(spread(named, "path"), sized, f"path string, content binary, body bigint, length bigint, {_TILE}")
    ranges = spread(split_ranges(whole, start=F.col("body"), stop=F.col("length"), split=split), "path", "start")
    counts = each(ranges, counted, "path string, start bigint, begun bigint")
    # One row for each range of a file; the texts meet nothing.
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("path", "start", F.coalesce(F.sum("begun").over(before), F.lit(0)).alias("first"))
    rows = each(spread(ranges.join(counts, ["path", "start"]), "path", "start"), decoded, f"{_TILE}, row int, line string")
    return rows.withColumn("values", F.split(A.strip(F.col("line")), r"\s+"))


def bad_rows(spark: SparkSession, tiles: DataFrame, path, *, split: int = SPLIT) -> DataFrame:
    """Grid rows whose width differs from the header."""
    rows = _grid_rows(spark, tiles, path, split)
    return rows.where(F.size("values") != F.col("ncols")).select("tile", "row", F.size("values").alias("width"), "ncols")


def read_pixels(spark: SparkSession, path) -> DataFrame:
    """Pixels ``path, width, height, row, col, r, g, b, a`` of canopy images (Spark's ``image`` source)."""
    images = spark.read.format("image").load(path).select(
        F.col("image.origin").alias("path"), F.col("image.width").alias("width"), F.col("image.height").alias("height"),
        F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"),
    )

    def unpack(batches):
        for batch in batches:
            for i in batch.itertuples(index=False):
                raw = np.frombuffer(i.data, np.uint8).reshape(i.height, i.width, i.channels)
                alpha = raw[..., 3] if i.channels == 4 else np.full((i.height, i.width), 255, np.uint8)
                row, col = np.divmod(np.arange(i.height * i.width), i.width)
                # The source delivers blue, green, red, alpha.
                planes = {"r": raw[..., 2], "g": raw[..., 1], "b": raw[..., 0], "a": alpha}
                out = pd.DataFrame({"row": row, "col": col, **{c: p.reshape(-1).astype(np.int32) for c, p in planes.items()}})
                out.insert(0, "height", i.height)
                out.insert(0, "width", i.width)
                out.insert(0, "path", i.path)
                yield out.astype({"width": "int32", "height": "int32", "row": "int32", "col": "int32"})

    schema = "path string, width int, height int, row int, col int, r int, g int, b int, a int"
    return images.where("channels >= 3").mapInPandas(unpack, schema)


def read_ply(spark: SparkSession, path) -> DataFrame:
    """Vertices of ASCII point clouds; header lines do not parse as three numbers and fall away."""
    words = F.split(A.strip(F.col("value")), r"\s+")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), words.alias("w"))
    number = lambda i: A.to_number(F.get("w", F.lit(i)))
    return (
        lines.where(F.size("w") >= 3)
        .select("path", number(0).alias("x"), number(1).alias("y"), number(2).alias("z"))
        .where("x is not null and y is not null and z is not null")
    )
