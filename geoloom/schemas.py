"""Spark types of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)
RINGS = T.ArrayType(RING)
#: part -> ring (0 = shell, rest = holes) -> vertex
PARTS = T.ArrayType(RINGS)
TAGS = T.MapType(T.StringType(), T.StringType())

POINT_DDL = "struct<x:double,y:double>"
PARTS_DDL = f"array<array<array<{POINT_DDL}>>>"

LATLON = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])
MEMBER = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("geometry", T.ArrayType(LATLON)),
    ]
)
#: One raw map element as delivered by an extract.
ELEMENT = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("tags", TAGS),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("geometry", T.ArrayType(LATLON)),
        T.StructField("nodes", T.ArrayType(T.LongType())),
        T.StructField("members", T.ArrayType(MEMBER)),
    ]
)

FEATURE = T.StructType(
    [
        T.StructField("feature_key", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("osm_type", T.StringType()),
        T.StructField("osm_id", T.StringType()),
        T.StructField("osm_num", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("group_tag", T.StringType()),
        T.StructField("source_tag", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("supplemental_input_id", T.StringType()),
        T.StructField("geom_type", T.StringType()),
        T.StructField("parts", PARTS),
        T.StructField("contributes_to_geometry", T.BooleanType()),
        T.StructField("geometry_role", T.StringType()),
        T.StructField("roi_zone", T.StringType()),
        T.StructField("reconstruction_scope", T.StringType()),
        T.StructField("include_in_lod22", T.BooleanType()),
        T.StructField("centroid_distance_m", T.DoubleType()),
        T.StructField("roi_distance_m", T.DoubleType()),
        T.StructField("area_m2", T.DoubleType()),
        T.StructField("overlap_removed_area_m2", T.DoubleType()),
        T.StructField("building_base_height_m", T.DoubleType()),
        T.StructField("tags", TAGS),
        T.StructField("source_attributes", T.StringType()),
    ]
)

#: Nine coordinate columns of a triangle row, in vertex order.
TRI_COLS = ("ax", "ay", "az", "bx", "by", "bz", "cx", "cy", "cz")
