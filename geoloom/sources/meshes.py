"""Triangle mesh readers (OBJ, ASCII STL).

Files are read line by line in the splits of Spark's text source. A line's number
is its place in its split plus the lines of the splits before, so a mesh of any
size is the work of many tasks, and what depends on earlier lines (vertex
numbers, the facet and the solid a line belongs to) are running sums over line
numbers, whatever the splits. STL triangles need no line numbers: each split is
read in order on its own, and a table of one row per split puts its counts right.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoloom.functions import attributes as A
from geoloom.operators.ordering import running_sum
from geoloom.operators.skew import stored
from geoloom.schemas import TRI_COLS

BLOCK = 100_000


def _lines(spark: SparkSession, path) -> DataFrame:
    """Stripped non-empty lines with their number: ``path, line_no, line``."""
    block = F.col("_metadata.file_block_start").alias("block")
    # Numbers of one task rise along a split, and the same split has the same lines in both uses below.
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), block, F.monotonically_increasing_id().alias("id"), "value")
    blocks = raw.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    # One row for each split of a file.
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("path", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("offset"))
    rows = raw.join(blocks, ["path", "block"])
    lines = rows.select("path", (F.col("id") + F.col("offset")).alias("line_no"), A.strip(F.col("value")).alias("line")).where("line <> ''")
    # Plans over ids of tasks share no exchange, so every running sum would read and number the files anew.
    return stored(lines)


def read_obj(spark: SparkSession, path) -> DataFrame:
    """OBJ triangles ``path, tri_no, ax .. cz``: polygon faces fanned from their first vertex.

    Vertex numbers are running counts, so negative references resolve against
    the vertices seen so far. References out of range are found by
    :func:`bad_obj_faces`.
    """
    lines = _lines(spark, path)
    counted = running_sum(
        lines, F.col("line").startswith("v ").cast("int"), order="line_no", out="seen", by=["path"], block=BLOCK
    )
    words = F.split("line", r"\s+")
    vertices = counted.where(F.col("line").startswith("v ")).select(
        "path", F.col("seen").alias("v"), *[A.to_number(F.get(words, F.lit(i + 1))).alias(c) for i, c in enumerate("xyz")]
    )
    refs = F.filter(
        F.transform(F.slice(words, 2, F.size(words)), lambda w: F.split_part(w, F.lit("/"), F.lit(1)).try_cast("bigint")),
        lambda i: i.isNotNull(),
    )
    absolute = F.transform(refs, lambda i: F.when(i < 0, F.col("seen") + i + 1).otherwise(i))
    # The triangles and the levels of their numbering read the faces.
    faces = stored(counted.where(F.col("line").startswith("f ")).select("path", "line_no", absolute.alias("f")).where(F.size("f") >= 3))
    fans = faces.select("path", "line_no", "f", F.explode(F.sequence(F.lit(1), F.size("f") - 2)).alias("k")).select(
        "path",
        "line_no",
        "k",
        F.get("f", F.lit(0)).alias("va"),
        F.get("f", F.col("k")).alias("vb"),
        F.get("f", F.col("k") + 1).alias("vc"),
    )
    for p in "abc":
        corner = vertices.select("path", F.col("v").alias(f"v{p}"), *[F.col(c).alias(f"{p}{c}") for c in "xyz"])
        fans = fans.join(corner, ["path", f"v{p}"])
    # Triangles keep the order of their face lines; a face of n corners takes n - 2 numbers.
    starts = running_sum(
        faces.select("path", "line_no", (F.size("f") - 2).cast("bigint").alias("n")), F.col("n"), order="line_no", out="first",
        by=["path"], inclusive=False, block=BLOCK,
    ).select("path", "line_no", "first")
    return fans.join(starts, ["path", "line_no"]).select(
        "path",
        (F.col("first") + F.col("k")).alias("tri_no"),
        *[F.col(f"{p}{c}") for p in "abc" for c in "xyz"],
    )


def bad_obj_faces(spark: SparkSession, path) -> DataFrame:
    """Faces with a reference outside the vertices seen so far."""
    counted = running_sum(
        _lines(spark, path), F.col("line").startswith("v ").cast("int"), order="line_no", out="seen", by=["path"], block=BLOCK
    )
    words = F.split("line", r"\s+")
    refs = F.transform(
        F.slice(words, 2, F.size(words)), lambda w: F.split_part(w, F.lit("/"), F.lit(1)).try_cast("bigint")
    )
    absolute = F.transform(refs, lambda i: F.when(i < 0, F.col("seen") + i + 1).otherwise(i))
    bad = F.exists(absolute, lambda i: F.coalesce((i < 1) | (i > F.col("seen")), F.lit(True)))
    return counted.where(F.col("line").startswith("f ") & bad).select("path", "line_no", "line")


#: Lines that make STL triangles.
FACET, SOLID, VERTEX = 0, 1, 2
#: Rows of a split: its counts and last solid, triangles that begin and end in it, corners that may belong to facets of its neighbours.
COUNTS, WHOLE, EDGE = 0, 1, 2
STL_PARTS = "path string, block bigint, kind int, facet bigint, solid bigint, region string, place bigint, " + ", ".join(f"{c} double" for c in TRI_COLS)


class _StlSplit:
    """Lines of one split, in order; facets and solids count from its start."""

    def __init__(self, path: str, block: int):
        self.path, self.block = path, block
        self.facets, self.edges = 0, 0
        self.names: list[str | None] = [None]  # the solid that the split begins in is known to earlier splits
        self.open = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 3)))

    def _rows(self, kind: int, facet: np.ndarray, solid: np.ndarray, place: np.ndarray, coords: np.ndarray) -> pa.RecordBatch:
        n, low = len(facet), int(solid[0]) if len(solid) else 0
        region = pa.array(self.names[low : int(solid[-1]) + 1] if n else [], pa.string()).take(pa.array(solid - low))
        values = [pa.array(coords[:, k], pa.float64(), from_pandas=True) if k < coords.shape[1] else pa.nulls(n, pa.float64()) for k in range(len(TRI_COLS))]
        head = [pa.repeat(self.path, n), pa.repeat(pa.scalar(self.block, pa.int64()), n), pa.repeat(pa.scalar(kind, pa.int32()), n)]
        names = [c.split()[0] for c in STL_PARTS.split(", ")]
        return pa.RecordBatch.from_arrays([*head, pa.array(facet), pa.array(solid), region, pa.array(place), *values], names=names)

    def _edge(self, facet: np.ndarray, solid: np.ndarray, points: np.ndarray) -> pa.RecordBatch:
        place = self.edges + np.arange(len(facet))
        self.edges += len(facet)
        return self._rows(EDGE, facet, solid, place, points)

    def lines(self, kind: np.ndarray, names: list[str], points: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Triangles of the facets that end in these lines; the last facet stays open."""
        v = kind == VERTEX
        new = (self.facets + np.cumsum(kind == FACET)[v], len(self.names) - 1 + np.cumsum(kind == SOLID)[v], points[v])
        self.facets += int(np.count_nonzero(kind == FACET))
        self.names += names
        facet, solid, at = (np.concatenate(x) for x in zip(self.open, new, strict=True))
        corner, other = self._corners(facet, solid)
        # Later corners count only where they show that the facet goes on in another solid.
        keep = (corner < 3) | other
        facet, solid, at, corner, other = facet[keep], solid[keep], at[keep], corner[keep], other[keep]
        first, last = np.searchsorted(facet, [1, self.facets])
        if self.facets:
            if first:
                yield self._edge(facet[:first], solid[:first], at[:first])
            facet, solid, at, corner, other = facet[first:], solid[first:], at[first:], corner[first:], other[first:]
            last -= first
            begins = other[:last]
            group, used = np.cumsum(begins) - 1, corner[:last] < 3
            coords = np.full((int(begins.sum()), 3, 3), np.nan)
            coords[group[used], corner[:last][used]] = at[:last][used]
            yield self._rows(WHOLE, facet[:last][begins], solid[:last][begins], np.zeros(len(coords), np.int64), coords.reshape(-1, 9))
            facet, solid, at = facet[last:], solid[last:], at[last:]
        self.open = (facet, solid, at)

    @staticmethod
    def _corners(facet: np.ndarray, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of every corner in its facet; whether it is the first of its facet in a solid."""
        change = np.ones(len(facet), bool)
        change[1:] = facet[1:] != facet[:-1]
        starts = np.flatnonzero(change)
        corner = np.arange(len(facet)) - np.repeat(starts, np.diff([*starts, len(facet)]))
        other = change.copy()
        other[1:] |= solid[1:] != solid[:-1]
        return corner, other

    def end(self) -> Iterator[pa.RecordBatch]:
        yield self._edge(*self.open)
        yield self._rows(COUNTS, np.array([self.facets]), np.array([len(self.names) - 1]), np.zeros(1, np.int64), np.empty((1, 0)))


def _stl_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``STL_PARTS`` of the splits of a task, from ``path, block, kind, name, x, y, z`` of their lines in order."""
    split = None
    for batch in batches:
        if not batch.num_rows:
            continue
        path = batch.column("path").dictionary_encode()
        block, code, kind = batch.column("block").to_numpy(), path.indices.to_numpy(), batch.column("kind").to_numpy()
        points = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in "xyz"])
        starts = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (code[1:] != code[:-1])])
        for lo, hi in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            key = (path.dictionary[int(code[lo])].as_py(), int(block[lo]))
            if split is None or (split.path, split.block) != key:
                if split is not None:
                    yield from split.end()
                split = _StlSplit(*key)
            solids = pa.array(lo + np.flatnonzero(kind[lo:hi] == SOLID))
            yield from split.lines(kind[lo:hi], batch.column("name").take(solids).to_pylist(), points[lo:hi])
    if split is not None:
        yield from split.end()


def read_stl(spark: SparkSession, path) -> DataFrame:
    """ASCII STL triangles ``path, region, tri_no, ax .. cz``; ``region`` is the solid's name.

    Lines never leave the task that reads them; of what a split yields, only the
    corners at its ends are put together with those of other splits.
    """
    # Trims what A.strip trims, without a pattern; a word has no white space left.
    line = F.btrim("value", F.lit(" \t\n\x0b\f\r"))
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), line.alias("line"))
    word = F.col("word")
    lines = raw.withColumn("word", F.substring_index("line", " ", 1)).where(word.isin("facet", "solid", "vertex"))
    lines = lines.withColumn("words", F.when(word == "vertex", F.split("line", r"\s+")))
    number = lambda w: F.when(w.rlike(A.NUMBER), w.try_cast("double"))
    lines = lines.select(
        "path",
        "block",
        F.when(word == "facet", FACET).when(word == "solid", SOLID).otherwise(VERTEX).alias("kind"),
        F.when(word == "solid", A.strip(F.regexp_replace("line", "^solid", ""))).alias("name"),
        *[number(F.get("words", F.lit(i + 1))).alias(c) for i, c in enumerate("xyz")],
    )
    # One scan serves all below: the splits of another one might be cut otherwise.
    parts = stored(lines.mapInArrow(_stl_parts, STL_PARTS))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in ("facet", "solid")]
    # One row for each split of a file, stored so that its size is known and the triangles need no shuffle to meet it.
    splits = stored(parts.where(F.col("kind") == COUNTS).select("path", "block", *sums, F.last("region", ignorenulls=True).over(before).alias("_region")))
    placed = parts.where(F.col("kind") != COUNTS).join(splits, ["path", "block"]).withColumns(
        {"tri_no": F.col("facet") + F.col("_facet"), "solid": F.col("solid") + F.col("_solid"), "region": F.coalesce("region", "_region")}
    )
    whole = placed.where(F.col("kind") == WHOLE).select("path", "region", "tri_no", *TRI_COLS)
    order = Window.partitionBy("path", "tri_no").orderBy("block", "place")
    corners = placed.where(F.col("kind") == EDGE).withColumn("_k", F.row_number().over(order))
    pick = lambda k, c: F.max(F.when(F.col("_k") == k, F.col(f"a{c}")))
    joined = corners.groupBy("path", "solid", "tri_no").agg(
        F.max("region").alias("region"), *[pick(k + 1, c).alias(f"{p}{c}") for k, p in enumerate("abc") for c in "xyz"]
    )
    return whole.unionByName(joined.drop("solid")).where("region is not null")


def stl_errors(spark: SparkSession, path) -> DataFrame:
    """Structure problems per file: every facet needs its seven lines, every solid its end with the same name."""
    lines = _lines(spark, path)
    w = Window.partitionBy("path").orderBy("line_no")
    marked = running_sum(
        lines.withColumn("word", F.split_part("line", F.lit(" "), F.lit(1))),
        F.lit(1), order="line_no", out="pos", by=["path"], block=BLOCK,
    )
    marked = running_sum(marked, (F.col("word") == "facet").cast("int"), order="line_no", out="facet", by=["path"], block=BLOCK)
    per_facet = marked.where(~F.col("word").isin("solid", "endsolid")).groupBy("path", "facet").agg(
        F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("ls")
    )
    expected = ("facet normal", "outer loop", "vertex", "vertex", "vertex", "endloop", "endfacet")
    fits = F.size("ls") == len(expected)
    for i, text in enumerate(expected):
        fits = fits & F.coalesce(F.get("ls", F.lit(i))["line"].startswith(text), F.lit(False))
    facets = per_facet.where(~fits).select("path", F.concat(F.lit("malformed facet "), F.col("facet").cast("string")).alias("error"))
    name = A.strip(F.regexp_replace("line", "^(end)?solid", ""))
    frames = marked.where(F.col("word").isin("solid", "endsolid")).select("path", "line_no", "word", name.alias("name"))
    paired = frames.withColumns(
        {"next_word": F.lead("word").over(w), "next_name": F.lead("name").over(w), "prev_word": F.lag("word").over(w)}
    )
    wrong = (
        (F.col("word") == "solid")
        & (F.coalesce(F.col("next_word") != "endsolid", F.lit(True)) | (F.col("next_name") != F.col("name")))
    ) | ((F.col("word") == "endsolid") & F.coalesce(F.col("prev_word") != "solid", F.lit(True)))
    solids = paired.where(wrong).select("path", F.concat(F.lit("unbalanced solid "), "name").alias("error"))
    return facets.unionByName(solids)


def read_mesh(spark: SparkSession, path: str) -> DataFrame:
    """Terrain geometry by file suffix."""
    return read_obj(spark, path) if path.lower().endswith(".obj") else read_stl(spark, path)
