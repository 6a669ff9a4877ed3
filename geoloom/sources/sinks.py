"""Writers: GeoJSON features, point clouds, STL and OBJ meshes, instance exports.

All writers are distributed text or Parquet jobs. Formats that need one ordered
file per object are written as ordered line tables, partitioned by object, with
the header in its own part, so no task ever holds a whole export.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import triangles as T
from geoloom.operators.ordering import running_sum
from geoloom.operators.skew import cut_lineage, drop_shuffles
from geoloom.schemas import TRI_COLS


def parts_to_coordinates(kind: Column, parts: Column) -> Column:
    """``parts`` back to GeoJSON coordinate text."""
    pair = lambda v: F.array(v["x"], v["y"])
    ring = lambda r: F.transform(r, pair)
    polygon = lambda p: F.transform(p, ring)
    first = F.get(parts, F.lit(0))
    return (
        F.when(kind == "Point", F.to_json(pair(F.get(F.get(first, F.lit(0)), F.lit(0)))))
        .when(kind.isin("LineString", "MultiPoint"), F.to_json(ring(F.get(first, F.lit(0)))))
        .when(kind == "Polygon", F.to_json(polygon(first)))
        .otherwise(F.to_json(F.transform(parts, polygon)))
    )


def geojson_lines(features: DataFrame, crs: str | None = None, skip: Sequence[str] = ()) -> DataFrame:
    """One GeoJSON Feature per line; ``value`` plus the columns named in ``skip`` for partitioning."""
    names = [c for c in features.columns if c not in ("geom_type", "parts", *skip)]
    properties = F.to_json(F.struct(*names))
    text = F.concat(
        F.lit('{"type":"Feature","geometry":{"type":"'),
        F.col("geom_type"),
        F.lit('","coordinates":'),
        parts_to_coordinates(F.col("geom_type"), F.col("parts")),
        F.lit("},"),
        F.lit("" if crs is None else f'"crs":"{crs}",'),
        F.lit('"properties":'),
        properties,
        F.lit("}"),
    )
    return features.select(*skip, text.alias("value"))


def write_geojson(features: DataFrame, path: str, *, crs: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Line-delimited GeoJSON, optionally one folder per category or region zone."""
    copies = [F.col(c).alias(f"part_{c}") for c in partition_by]
    df = features.select("*", *copies)
    lines = geojson_lines(df, crs, skip=[f"part_{c}" for c in partition_by])
    writer = lines.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*[f"part_{c}" for c in partition_by])
    writer.text(path)


def put_file(path: str, data: bytes) -> None:
    """Write one named file from a task; the same call again leaves the same file."""
    if path.startswith("file:"):
        store, name = fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    elif "://" in path:
        store, name = fs.FileSystem.from_uri("s3" + path[3:] if path.startswith("s3a:") else path)
    else:
        store, name = fs.LocalFileSystem(), path
    store.create_dir(name.rpartition("/")[0], recursive=True)
    with store.open_output_stream(name) as out:
        out.write(data)


def write_collections(features: DataFrame, path: str, *, crs: str | None = None) -> None:
    """GeoJSON feature collections: every file of the folder is a whole one."""

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = lambda text: pa.RecordBatch.from_arrays([pa.array(text, pa.string())], names=["value"])
        begun = False
        for batch in batches:
            rows = batch.column(0).to_pylist()
            if rows:
                # Each line but the first begins with the comma that parts it from the one before.
                head = [] if begun else ['{"type":"FeatureCollection","features":[']
                first = rows[:1] if not begun else ["," + rows[0]]
                yield line([*head, *first, *("," + r for r in rows[1:])])
                begun = True
        if begun:
            yield line(["]}"])

    geojson_lines(features, crs).mapInArrow(framed, "value string").write.mode("overwrite").text(path)


def region_name(zone: Column) -> Column:
    """Output region of a zone: ``full_region``, ``inner_region`` or ``annular_region``."""
    return F.concat(zone, F.lit("_region"))


def write_features(features: DataFrame, path: str) -> None:
    """Primary storage: Parquet, one folder per category and zone."""
    features.write.mode("overwrite").partitionBy("category", "roi_zone").parquet(path)


def ply_lines(points: DataFrame, by: Sequence[str] = ("class",)) -> DataFrame:
    """Header and vertex lines per group: ``by, part (0 header, 1 body), line_no, value``."""
    counts = points.groupBy(*by).agg(F.count("*").alias("n"))
    header = F.array(
        F.lit("ply"),
        F.lit("format ascii 1.0"),
        F.concat(F.lit("element vertex "), F.col("n").cast("string")),
        F.lit("property double x"),
        F.lit("property double y"),
        F.lit("property double z"),
        F.lit("end_header"),
    )
    head = counts.select(*by, F.lit(0).alias("part"), F.posexplode(header).alias("line_no", "value"))
    body = points.select(
        *by, F.lit(1).alias("part"), F.lit(0).alias("line_no"), F.format_string("%.3f %.3f %.3f", "x", "y", "z").alias("value")
    )
    return head.unionByName(body)


def write_ply(points: DataFrame, path: str, by: Sequence[str] = ("class",)) -> None:
    """Vertex text per class; concatenating ``part=0`` and ``part=1`` gives the PLY file."""
    lines = ply_lines(points, by)
    lines.sortWithinPartitions("part", "line_no").select(*by, "part", "value").write.mode("overwrite").partitionBy(
        *by, "part"
    ).text(path)


def stl_facets(triangles: DataFrame, *, decimals: int = 3, keep: Sequence[str] = ()) -> DataFrame:
    """Facet text with recomputed normals: ``keep, tri_no, value`` (seven lines each)."""
    nx, ny, nz = T.normal()
    vertex = lambda p: F.format_string(f"      vertex %.{decimals}f %.{decimals}f %.{decimals}f", f"{p}x", f"{p}y", f"{p}z")
    text = F.concat_ws(
        "\n",
        F.format_string("  facet normal %.6g %.6g %.6g", nx, ny, nz),
        F.lit("    outer loop"),
        vertex("a"),
        vertex("b"),
        vertex("c"),
        F.lit("    endloop"),
        F.lit("  endfacet"),
    )
    return triangles.select(*keep, "tri_no", text.alias("value"))


def stl_lines(triangles: DataFrame, solid: str, *, decimals: int = 3) -> DataFrame:
    """Complete solids: ``solid name``, facets in order, ``endsolid name`` (rows carry ``part`` and ``tri_no``)."""
    facets = stl_facets(triangles, decimals=decimals, keep=[solid]).withColumn("part", F.lit(1))
    names = triangles.select(solid).distinct()
    frame = lambda part, word: names.select(
        solid, F.lit(-1 if part == 0 else 0).cast("bigint").alias("tri_no"), F.concat(F.lit(f"{word} "), solid).alias("value"), F.lit(part).alias("part")
    )
    return frame(0, "solid").unionByName(facets).unionByName(frame(2, "endsolid"))


def write_stl(triangles: DataFrame, path: str, solid: str, *, decimals: int = 3) -> None:
    """One folder per solid; files inside are sorted, so reading them in name order restores the solid."""
    lines = stl_lines(triangles, solid, decimals=decimals).withColumn("solid_name", F.col(solid))
    (
        lines.repartitionByRange(F.col(solid), F.col("part"), F.col("tri_no"))
        .sortWithinPartitions(solid, "part", "tri_no")
        .select("solid_name", "value")
        .write.mode("overwrite")
        .partitionBy("solid_name")
        .text(path)
    )


def write_stl_regions(triangles: DataFrame, path: str, solid: str, order: Sequence[str], *, decimals: int = 3) -> None:
    """All solids in one file, in the given order; each as ``write_stl`` writes it, an empty one too.

    The format wants one file: triangles are sorted in ranges by many tasks, which
    turn them into packed text, and one task strings the ranges together without
    holding them. On disk are the file, the packed text and, until that is whole,
    the shuffles of the numbers.
    """
    spark = triangles.sparkSession
    names = spark.createDataFrame([(k, n) for k, n in enumerate(order)], "_place int, _name string")
    facets = triangles.join(F.broadcast(names), F.col(solid) == F.col("_name")).select("_place", "_name", F.lit(1).alias("part"), "tri_no", *TRI_COLS)
    frames = names.select("_place", "_name", F.explode(F.array(F.lit(0), F.lit(2))).alias("part"), F.lit(0).cast("bigint").alias("tri_no"))
    keys = ["_place", "part", "tri_no"]
    ordered = frames.unionByName(facets, allowMissingColumns=True).repartitionByRange(*keys).sortWithinPartitions(*keys)
    frame = F.concat(F.when(F.col("part") == 0, "solid ").otherwise("endsolid "), "_name")
    lines = stl_facets(ordered, decimals=decimals, keep=["part", "_name"]).select(F.when(F.col("part") == 1, F.col("value")).otherwise(frame).alias("value"))
    packed = lines.mapInArrow(_packed, "size bigint, data binary")
    # Without the cut the one task would sort every range itself.
    cut = cut_lineage(packed)
    drop_shuffles(packed)
    cut.coalesce(1).mapInArrow(_unpacked, "value string").write.mode("overwrite").text(path)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of every batch as one compressed text."""
    for batch in batches:
        if batch.num_rows:
            text = "\n".join(batch.column(0).to_pylist()).encode()
            data = pa.compress(text, codec="zstd", asbytes=True)
            yield pa.RecordBatch.from_arrays([pa.array([len(text)], pa.int64()), pa.array([data], pa.binary())], names=["size", "data"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for size, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = pa.decompress(data, size, codec="zstd", asbytes=True).decode()
            yield pa.RecordBatch.from_arrays([pa.array([text], pa.string())], names=["value"])


def combined_obj_lines(vertices: DataFrame, faces: DataFrame, sources: DataFrame) -> DataFrame:
    """Meshes of several sources as one OBJ: face references moved behind the vertices of earlier sources.

    ``vertices``: ``label, v, x, y, z``; ``faces``: ``label, face_no, refs``;
    ``sources``: ``label, source_no``. Output ``source_no, part, n, value``.
    """
    counts = sources.join(vertices.groupBy("label").agg(F.count("*").alias("n")), "label", "left").withColumn(
        "n", F.coalesce("n", F.lit(0))
    )
    offsets = running_sum(counts, F.col("n"), order="source_no", out="offset", inclusive=False).select(
        "label", "source_no", "offset"
    )
    group = offsets.select("source_no", F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("n"), F.concat(F.lit("g "), "label").alias("value"))
    vs = vertices.join(offsets, "label").select(
        "source_no", F.lit(1).alias("part"), F.col("v").cast("bigint").alias("n"), F.format_string("v %s %s %s", F.col("x").cast("string"), F.col("y").cast("string"), F.col("z").cast("string")).alias("value")
    )
    refs = F.transform("refs", lambda r: (r + F.col("offset")).cast("string"))
    fs = faces.where(F.size("refs") >= 3).join(offsets, "label").select(
        "source_no", F.lit(2).alias("part"), F.col("face_no").cast("bigint").alias("n"), F.concat(F.lit("f "), F.array_join(refs, " ")).alias("value")
    )
    return group.unionByName(vs).unionByName(fs)


def write_ordered_text(lines: DataFrame, path: str, order: Sequence[str]) -> None:
    """Globally ordered text: range partitions, sorted inside, read back in file name order."""
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.mode("overwrite").text(path)


def tree_placements(instances: DataFrame) -> DataFrame:
    """Placement features of trees with rounded dimensions and provenance."""
    rounded = {c: F.round(c, 3) for c in ("x", "y", "z", "height_m", "crown_radius_m", "trunk_radius_m", "trunk_height_m")}
    return instances.where("model_error is null").withColumns(rounded).select(
        F.lit("Point").alias("geom_type"),
        F.array(F.array(F.array(F.struct("x", "y")))).alias("parts"),
        *[c for c in instances.columns if c not in ("x", "y", "model_error", "dimension_error")],
    )


def tree_information(instances: DataFrame) -> DataFrame:
    """Per-tree provenance rows."""
    return instances.select(
        "tree_id",
        "osm_id",
        "species",
        F.col("model_category").alias("species_model"),
        "source_species",
        "model_category",
        "crown_shape",
        "model_source",
        "height_source",
        "crown_radius_source",
        "trunk_radius_source",
        "used_tags",
        "defaulted_fields",
    )


def purifier_placements(placements: DataFrame) -> DataFrame:
    """Placement features of purifiers in projected coordinates."""
    point = F.struct(F.col("projected_x").alias("x"), F.col("projected_y").alias("y"))
    return placements.where(F.size("errors") == 0).select(
        F.lit("Point").alias("geom_type"),
        F.array(F.array(F.array(point))).alias("parts"),
        *[c for c in placements.columns if c not in ("errors", "projected_x", "projected_y")],
    )
