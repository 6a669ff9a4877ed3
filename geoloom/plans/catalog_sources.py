"""Round trips: the driver tables written as files of each format and read again in small byte ranges.

A region has a fixed size, so a file of one region is written by one task; how
many files there are, and how many ranges they are read in, grows with the table.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoloom.functions import measure as M
from geoloom.operators.skew import ensure_checkpoint_dir
from geoloom.plans.catalog_instances import LATTICE_CTES, lattice
from geoloom.plans.fixtures import ctes, view
from geoloom.plans.registry import query
from geoloom.sources import geojson as G
from geoloom.sources import meshes as ME
from geoloom.sources import rasters as RA
from geoloom.sources import shapefile as SH
from geoloom.sources import sinks as K

#: Range size of these queries: small, so that every file is read in several ranges.
SPLIT = 8_192
REGION = r"/(\d+)[^/]*$"


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/geoloom-{name}-{uuid.uuid4().hex}"


def region_of(path: str) -> Column:
    return F.regexp_extract(path, REGION, 1).cast("bigint")


def write_each(df: DataFrame, by: list[str], path: str, name: Callable[[pd.DataFrame], str], encode: Callable[[pd.DataFrame], bytes]) -> None:
    """One named file for each group of ``by``; a repeated task writes the same bytes again."""

    def put(part: pd.DataFrame) -> pd.DataFrame:
        K.put_file(f"{path}/{name(part)}", encode(part))
        return pd.DataFrame({"n": [len(part)]})

    df.groupBy(*by).applyInPandas(put, "n bigint").agg(F.sum("n")).collect()


# --- shapefiles ---------------------------------------------------------------------------------


def polygon_file(part: pd.DataFrame) -> bytes:
    """A shapefile with a rectangle per row, in order of ``seq``."""
    records = []
    for number, r in enumerate(part.sort_values("seq").itertuples(index=False), 1):
        ring = [(r.x0, r.y0), (r.x0, r.y1), (r.x1, r.y1), (r.x1, r.y0), (r.x0, r.y0)]
        body = struct.pack("<i4d3i", 5, r.x0, r.y0, r.x1, r.y1, 1, 5, 0) + b"".join(struct.pack("<2d", *p) for p in ring)
        records.append(struct.pack(">2i", number, len(body) // 2) + body)
    data = b"".join(records)
    head = struct.pack(">7i", SH.FILE_CODE, 0, 0, 0, 0, 0, (SH.HEADER + len(data)) // 2)
    return head + struct.pack("<2i", SH.VERSION, 5) + bytes(64) + data


def table_file(part: pd.DataFrame) -> bytes:
    """An attribute table with number, category and group of each row, every ninth one deleted."""
    fields = [("SEQ", "N", 12), ("CATEGORY", "C", 16), ("GROUP", "C", 16)]
    width = 1 + sum(n for *_, n in fields)
    head = struct.pack("<B3xIHH20x", 3, len(part), 33 + 32 * len(fields), width)
    for name, kind, n in fields:
        head += name.encode().ljust(11, b"\0") + kind.encode() + bytes(4) + bytes([n, 0]) + bytes(14)
    rows = []
    for r in part.sort_values("seq").itertuples(index=False):
        values = (str(r.seq).rjust(12), r.category.ljust(16), r.group_tag.ljust(16))
        rows.append(("*" if r.seq % 9 == 0 else " ") + "".join(values))
    return head + b"\r" + "".join(rows).encode()


@query(
    "shapefile_polygons",
    ctes("fx_rects")
    + "select region, row_number() over (partition by region order by seq) - 1 as shape_index, row_number() over (partition by region order by seq) as record_number,"
    " x0, y0, x1, y1, (x1 - x0) * (y1 - y0) as area from fx_rects",
)
def shapefile_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles written as one shapefile per region and read by byte ranges."""
    path = folder(spark, "shp")
    write_each(view(spark, sf_dir, "fx_rects"), ["region"], path, lambda p: f"{p['region'].iloc[0]}.shp", polygon_file)
    read = SH.read_polygons(spark, path, split=SPLIT).withColumn("b", M.parts_bbox(F.col("parts")))
    box = [F.col(f"b.{c}").alias(n) for c, n in (("min_x", "x0"), ("min_y", "y0"), ("max_x", "x1"), ("max_y", "y1"))]
    return read.where("error is null").select(region_of("file").alias("region"), "shape_index", "record_number", *box, M.parts_area(F.col("parts")).alias("area"))


@query(
    "shapefile_attributes",
    ctes("fx_rects")
    + "select region, row_number() over (partition by region order by seq) - 1 as shape_index, seq % 9 = 0 as deleted,"
    " case when seq % 9 <> 0 then cast(seq as varchar) end as seq, case when seq % 9 <> 0 then category end as category,"
    " case when seq % 9 <> 0 then group_tag end as group_tag from fx_rects",
)
def shapefile_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribute tables of the same regions, read by record ranges."""
    path = folder(spark, "dbf")
    write_each(view(spark, sf_dir, "fx_rects"), ["region"], path, lambda p: f"{p['region'].iloc[0]}.dbf", table_file)
    read = SH.read_attributes(spark, path, split=SPLIT).where("error is null")
    values = [F.col("attrs")[n].alias(c) for n, c in (("SEQ", "seq"), ("CATEGORY", "category"), ("GROUP", "group_tag"))]
    return read.select(region_of("file").alias("region"), "shape_index", "deleted", *values)


# --- grids --------------------------------------------------------------------------------------

#: Region box of the grid query.
BOX = (-61.0, -37.25, 30.5, 22.0)


def grid_file(part: pd.DataFrame) -> bytes:
    """A tile of 50 x 50 cells of one metre; cells without a height hold the nodata value."""
    tile = int(part["tile"].iloc[0])
    values = [["-9999"] * 50 for _ in range(50)]
    for r in part.itertuples(index=False):
        if not pd.isna(r.ground_z):
            values[int(r.row)][int(r.col)] = repr(float(r.ground_z))
    head = f"ncols 50\nnrows 50\nxllcorner {50 * (tile % 3) - 75}\nyllcorner {50 * (tile // 3) - 50}\ncellsize 1\nNODATA_value -9999\n"
    return (head + "\n".join(" ".join(v) for v in values) + "\n").encode()


@query(
    "grid_cells_in_box",
    ctes("fx_cells")
    + f'select region, tile, "row", "col", x, y, ground_z as z from fx_cells where ground_z is not null and x between {BOX[0]} and {BOX[2]} and y between {BOX[1]} and {BOX[3]}',
)
def grid_cells_in_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heights written as one grid per tile; only tiles that touch the box are opened."""
    path = folder(spark, "asc")
    cells = view(spark, sf_dir, "fx_cells").select("region", "tile", "row", "col", "ground_z")
    write_each(cells, ["region", "tile"], path, lambda p: f"{p['region'].iloc[0]}_{p['tile'].iloc[0]}.asc", grid_file)
    tiles = RA.read_tiles(spark, path, "dtm")
    read = RA.read_cells(spark, tiles, path, box=BOX, split=SPLIT).where("z is not null")
    number = lambda k: F.regexp_extract("tile", r"^(\d+)_(\d+)", k).cast("bigint")
    place = [F.col(c).cast("bigint").alias(c) for c in ("row", "col")]
    return read.select(number(1).alias("region"), number(2).alias("tile"), *place, "x", "y", "z")


# --- GeoJSON and map extracts -------------------------------------------------------------------

RECT_SQL = ctes("fx_rects") + "select seq, category, x0, y0, x1, y1, (x1 - x0) * (y1 - y0) as area from fx_rects"


def rect_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y0"))
    return view(spark, sf_dir, "fx_rects").select("seq", "category", F.lit("Polygon").alias("geom_type"), F.array(F.array(ring)).alias("parts"))


def read_rects(read: DataFrame) -> DataFrame:
    box = M.parts_bbox(F.col("parts"))
    read = read.select(G.prop("seq", "bigint").alias("seq"), G.prop("category").alias("category"), box.alias("b"), M.parts_area(F.col("parts")).alias("area"))
    names = (("min_x", "x0"), ("min_y", "y0"), ("max_x", "x1"), ("max_y", "y1"))
    return read.select("seq", "category", *[F.col(f"b.{c}").alias(n) for c, n in names], "area")


@query("geojson_collections", RECT_SQL)
def geojson_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature collections, read entry by entry from byte ranges."""
    path = folder(spark, "collections")
    K.write_collections(rect_features(spark, sf_dir), path)
    return read_rects(G.read_features(spark, path, strict=True, split=SPLIT))


@query("geojson_feature_lines", RECT_SQL)
def geojson_feature_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature per line, in folders by category."""
    path = folder(spark, "lines")
    features = rect_features(spark, sf_dir)
    K.write_geojson(features, path, partition_by=["category"])
    return read_rects(G.read_features(spark, path, lines=True))


@query(
    "map_extract_elements",
    ctes("fx_points")
    + "select osm_num as id, lat, lon, case when has_tags then key1 end as key1, case when has_tags then val1 end as val1,"
    " row_number() over (order by cast(region as varchar) || '.json', osm_num) as seq from fx_points",
)
def map_extract_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes written as one extract per region; numbers run over all files in order of their names."""
    path = folder(spark, "extract")
    tags = F.when(F.col("has_tags"), F.create_map("key1", "val1"))
    node = F.to_json(F.struct(F.lit("node").alias("type"), F.col("osm_num").alias("id"), "lat", "lon", tags.alias("tags")))
    nodes = view(spark, sf_dir, "fx_points").select("region", "osm_num", node.alias("text"))

    def extract(part: pd.DataFrame) -> bytes:
        return ('{"version": 0.6, "elements": [\n' + ",\n".join(part.sort_values("osm_num")["text"]) + "\n]}\n").encode()

    write_each(nodes, ["region"], path, lambda p: f"{p['region'].iloc[0]}.json", extract)
    read = G.read_elements(spark, path, split=SPLIT)
    entry = lambda values: F.get(values, F.lit(0))
    return read.select("id", "lat", "lon", entry(F.map_keys("tags")).alias("key1"), entry(F.map_values("tags")).alias("val1"), "seq")


# --- meshes -------------------------------------------------------------------------------------


@query(
    "obj_triangles",
    ctes("fx_cells", extra=LATTICE_CTES)
    + "select region, row_number() over (partition by region order by tri_no) as tri_no, ax, ay, az, bx, by_ as by, bz, cx, cy, cz from tri",
)
def obj_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A terrain mesh per region with references that count back from each face."""
    path = folder(spark, "obj")

    def mesh(part: pd.DataFrame) -> bytes:
        rows = part.sort_values("tri_no").itertuples(index=False)
        point = lambda r, p: f"v {float(getattr(r, p + 'x'))!r} {float(getattr(r, p + 'y'))!r} {float(getattr(r, p + 'z'))!r}\n"
        return "".join("".join(point(r, p) for p in "abc") + "f -3 -2 -1\n" for r in rows).encode()

    write_each(lattice(spark, sf_dir), ["region"], path, lambda p: f"{p['region'].iloc[0]}.obj", mesh)
    return ME.read_obj(spark, path).select(region_of("path").alias("region"), "tri_no", *[f"{p}{c}" for p in "abc" for c in "xyz"])


REGIONS = ("inlet", "outlet", "tower")


@query(
    "stl_regions",
    ctes("fx_cells", extra=LATTICE_CTES)
    + "select case tile % 3 when 0 then 'inlet' when 1 then 'outlet' else 'tower' end as region, count(*) as triangles,"
    " round(sum(round(ax, 3)), 3) as sum_ax, round(sum(round(cz, 3)), 3) as sum_cz, min(tile % 3) as place from tri group by 1",
)
def stl_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three solids in one ordered file, read again in splits; ``place`` is the order of the solids in the file."""
    path = folder(spark, "stl")
    named = F.element_at(F.array(*map(F.lit, REGIONS)), (F.col("tile") % 3 + 1).cast("int"))
    K.write_stl_regions(lattice(spark, sf_dir).withColumn("solid", named), path, "solid", REGIONS)
    sums = [F.round(F.sum(c), 3).alias(f"sum_{c}") for c in ("ax", "cz")]
    read = ME.read_stl(spark, path).groupBy("region").agg(F.count("*").alias("triangles"), *sums, F.min("tri_no").alias("first"))
    place = (F.row_number().over(Window.orderBy("first")) - 1).cast("bigint")
    return read.select("region", "triangles", "sum_ax", "sum_cz", place.alias("place"))
