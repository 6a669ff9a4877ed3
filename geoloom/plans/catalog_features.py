"""Driver queries: classification, coordinates, measures, attributes, feature reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import attributes as A
from geoloom.functions import crs as C
from geoloom.functions import measure as M
from geoloom.operators import features as FT
from geoloom.operators import ordering as O
from geoloom.operators import overlay as OV
from geoloom.operators import planning as PL
from geoloom.operators import quality as Q
from geoloom.operators.classify import DEFAULT_PRECEDENCE, classify, skip_reason, tag_inventory
from geoloom.operators.spatial import drop_duplicate_trees
from geoloom.params import CATEGORIES, DEMO_REGION
from geoloom.plans.fixtures import ctes, purifier_catalogue, tree_models, view
from geoloom.plans.registry import query
from geoloom.schemas import TAGS

REGION = DEMO_REGION


def tagged_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_points`` with a tag map, classification and planar distance to the centre."""
    pairs = F.array(
        F.struct(F.col("key1").alias("key"), F.col("val1").alias("value")),
        F.struct(F.col("key2").alias("key"), F.col("val2").alias("value")),
    )
    tags = F.when(F.col("has_tags"), F.map_from_entries(F.filter(pairs, lambda e: e["key"].isNotNull())))
    df = view(spark, sf_dir, "fx_points").withColumn("tags", tags.cast(TAGS))
    return df.withColumns(
        {
            "cls": classify(F.col("tags")),
            "distance": M.point_roi_distance_m(F.col("lon"), F.col("lat"), REGION),
        }
    ).withColumn("roi_zone", M.roi_zone(F.col("distance"), REGION))


X_SQL = "radians(lon - 11.2558) * 6371000.0 * cos(radians(43.7696))"
Y_SQL = "radians(lat - 43.7696) * 6371000.0"
HAV = (
    "2.0 * 6371000.0 * atan2(sqrt(power(sin(radians({lat2} - {lat1}) / 2.0), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
    " * power(sin(radians({lon2} - {lon1}) / 2.0), 2)),"
    " sqrt(1.0 - (power(sin(radians({lat2} - {lat1}) / 2.0), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
    " * power(sin(radians({lon2} - {lon1}) / 2.0), 2))))"
)
HAV_CENTER = HAV.format(lat1="43.7696", lon1="11.2558", lat2="lat", lon2="lon")

CLS_SQL = (
    "select *, case when not has_tags then null"
    " when key1 = 'building' then 'buildings' when key1 = 'natural' and val1 = 'tree' then 'trees'"
    " when key1 = 'natural' and val1 = 'water' then 'water'"
    " when (key1 = 'landuse' and val1 = 'grass') or (key1 = 'natural' and val1 = 'wood') then 'green_areas'"
    " when key1 = 'highway' then 'roads' when key2 = 'surface' then 'concrete'"
    " when key1 = 'landuse' and val1 = 'industrial' then 'concrete' when key1 = 'landuse' then 'other_terrain' end as category,"
    " case when key2 = 'surface' and (key1 = 'shop' or (key1 = 'landuse' and val1 <> 'grass')) then 'surface=asphalt'"
    " when key1 = 'shop' then null else concat(key1, '=', val1) end as stag,"
    f" sqrt(power({X_SQL}, 2) + power({Y_SQL}, 2)) as distance from fx_points"
)
ZONE_SQL = "case when distance <= 150 then 'inner' when distance <= 250 then 'annular' end"
GROUP_SQL = (
    "case category when 'buildings' then 'building' when 'trees' then 'tree' when 'water' then 'water'"
    " when 'green_areas' then 'green_area' when 'roads' then 'road' when 'concrete' then 'paved_ground'"
    " when 'other_terrain' then 'other_terrain' end"
)
CLS_CTES = ctes("fx_points", extra=[("cls", CLS_SQL), ("z", f"select *, {ZONE_SQL} as roi_zone, {GROUP_SQL} as group_tag from cls")])


@query(
    "classify_zone_counts",
    CLS_CTES
    + f"select region, category, coalesce(roi_zone, 'outside') as roi_zone, count(*) as n, round(avg({HAV_CENTER}), 3) as mean_distance_m"
    " from z where category is not null group by 1, 2, 3",
)
def classify_zone_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features per region, category and zone with their mean great-circle distance."""
    df = tagged_points(spark, sf_dir).where("cls is not null")
    return df.groupBy(
        "region", F.col("cls.category").alias("category"), F.coalesce("roi_zone", F.lit("outside")).alias("roi_zone")
    ).agg(
        F.count("*").alias("n"),
        F.round(F.avg(M.distance_to_center_m(F.col("lon"), F.col("lat"), REGION)), 3).alias("mean_distance_m"),
    )


@query(
    "tag_inventory",
    CLS_CTES
    + ", kv as (select *, key1 as k_, val1 as v_ from z where has_tags union all select *, key2, val2 from z where has_tags and key2 is not null)"
    " select 'element_type' as metric, 'node' as key, count(*) as n from z"
    " union all select 'tagged_elements', 'all', count(*) from z where has_tags"
    " union all select 'tag_key', k_, count(*) from kv group by k_"
    " union all select 'tag_value', concat(k_, '=', v_), count(*) from kv group by 2"
    " union all select 'classified_source_tag', stag, count(*) from z where category is not null group by stag"
    " union all select 'unclassified_tag_value', concat(k_, '=', v_), count(*) from kv where category is null group by 2"
    " union all select 'unclassified_feature_like_tag_value', concat(k_, '=', v_), count(*) from kv where category is null group by 2",
)
def tag_inventory_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_inventory(tagged_points(spark, sf_dir).withColumn("type", F.lit("node")))


@query(
    "reject_reasons",
    CLS_CTES
    + "select region, coalesce(case when not has_tags then 'missing_tags' when category is null then 'unsupported_tags'"
    " when k = 5 then 'unsupported_or_incomplete_geometry' when roi_zone is null then 'outside_roi_policy' end, 'accepted') as reason,"
    " count(*) as n from z group by 1, 2",
)
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = tagged_points(spark, sf_dir)
    reason = skip_reason(F.lit(True), F.col("tags"), F.col("cls"), F.col("k") != 5, F.col("roi_zone"))
    return df.groupBy("region", F.coalesce(reason, F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


# --- coordinate systems ----------------------------------------------------------------------

_F = 1.0 / 298.257223563
E2 = repr(_F * (2.0 - _F))
EP2 = repr(float(E2) / (1.0 - float(E2)))


def utm_sql(source: str, keep: str, lon: str = "lon", lat: str = "lat") -> str:
    """DuckDB text of the forward projection: ``keep`` columns plus ``ux, uy``."""
    return (
        f"select {keep}, 0.9996 * n_ * (a_ + (1 - t_ + c_) * power(a_, 3) / 6 + (5 - 18 * t_ + t_ * t_ + 72 * c_ - 58 * {EP2})"
        f" * power(a_, 5) / 120) + 500000.0 as ux, 0.9996 * (m_ + n_ * tan(p_) * (a_ * a_ / 2 + (5 - t_ + 9 * c_ + 4 * c_ * c_)"
        f" * power(a_, 4) / 24 + (61 - 58 * t_ + t_ * t_ + 600 * c_ - 330 * {EP2}) * power(a_, 6) / 720)) as uy from ("
        f"select *, power(tan(p_), 2) as t_, {EP2} * power(cos(p_), 2) as c_, cos(p_) * (radians({lon}) - radians(9.0)) as a_,"
        f" 6378137.0 / sqrt(1 - {E2} * power(sin(p_), 2)) as n_, 6378137.0 * ((1 - {E2} / 4 - 3 * power({E2}, 2) / 64 - 5 * power({E2}, 3) / 256) * p_"
        f" - (3 * {E2} / 8 + 3 * power({E2}, 2) / 32 + 45 * power({E2}, 3) / 1024) * sin(2 * p_)"
        f" + (15 * power({E2}, 2) / 256 + 45 * power({E2}, 3) / 1024) * sin(4 * p_) - (35 * power({E2}, 3) / 3072) * sin(6 * p_)) as m_"
        f" from (select *, radians({lat}) as p_ from {source}))"
    )


@query("utm_forward", ctes("fx_points", extra=[("u", utm_sql("fx_points", "osm_num"))]) + "select osm_num, round(ux, 3) as x, round(uy, 3) as y from u")
def utm_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = view(spark, sf_dir, "fx_points")
    lon, lat = F.col("lon"), F.col("lat")
    return df.select("osm_num", F.round(C.utm32_x(lon, lat), 3).alias("x"), F.round(C.utm32_y(lon, lat), 3).alias("y"))


_E1 = f"((1 - sqrt(1 - {E2})) / (1 + sqrt(1 - {E2})))"
INVERSE_SQL = (
    "select osm_num, degrees(radians(9.0) + (d - (1 + 2 * t + c) * power(d, 3) / 6 + (5 - 2 * c + 28 * t - 3 * c * c"
    f" + 8 * {EP2} + 24 * t * t) * power(d, 5) / 120) / cos(p)) as lon,"
    f" degrees(p - n * tan(p) / r * (d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * {EP2}) * power(d, 4) / 24"
    f" + (61 + 90 * t + 298 * c + 45 * t * t - 252 * {EP2} - 3 * c * c) * power(d, 6) / 720)) as lat from ("
    "select *, (ux - 500000.0) / (n * 0.9996) as d from ("
    f"select *, power(tan(p), 2) as t, {EP2} * power(cos(p), 2) as c, 6378137.0 / sqrt(1 - {E2} * power(sin(p), 2)) as n,"
    f" 6378137.0 * (1 - {E2}) / power(1 - {E2} * power(sin(p), 2), 1.5) as r from ("
    f"select *, mu + (3 * {_E1} / 2 - 27 * power({_E1}, 3) / 32) * sin(2 * mu) + (21 * power({_E1}, 2) / 16 - 55 * power({_E1}, 4) / 32) * sin(4 * mu)"
    f" + 151 * power({_E1}, 3) / 96 * sin(6 * mu) + 1097 * power({_E1}, 4) / 512 * sin(8 * mu) as p from ("
    f"select *, uy / 0.9996 / (6378137.0 * (1 - {E2} / 4 - 3 * power({E2}, 2) / 64 - 5 * power({E2}, 3) / 256)) as mu from u))))"
)


@query(
    "utm_inverse",
    ctes("fx_points", extra=[("u", utm_sql("fx_points", "osm_num")), ("i", INVERSE_SQL)])
    + "select osm_num, round(lon, 8) as lon, round(lat, 8) as lat from i",
)
def utm_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = view(spark, sf_dir, "fx_points")
    lon, lat = F.col("lon"), F.col("lat")
    metric = df.select("osm_num", C.utm32_x(lon, lat).alias("x"), C.utm32_y(lon, lat).alias("y"))
    back = C.with_geographic(metric, "x", "y", C.UTM32)
    return back.select("osm_num", F.round("lon", 8).alias("lon"), F.round("lat", 8).alias("lat"))


_RF = 1.0 / 297.0
_RE2 = _RF * (2.0 - _RF)
_ARC = "(pi() / (180.0 * 3600.0))"
HELMERT_SQL = (
    "select osm_num, degrees(atan2(wy, wx)) as hlon, degrees(atan2(wz + ep * b * power(sin(th), 3), pr - e2 * a * power(cos(th), 3))) as hlat from ("
    f"select *, 6378137.0 as a, 6378137.0 * (1 - 1 / 298.257223563) as b, {E2} as e2,"
    " (power(6378137.0, 2) - power(6378137.0 * (1 - 1 / 298.257223563), 2)) / power(6378137.0 * (1 - 1 / 298.257223563), 2) as ep,"
    " sqrt(wx * wx + wy * wy) as pr, atan2(wz * 6378137.0, sqrt(wx * wx + wy * wy) * 6378137.0 * (1 - 1 / 298.257223563)) as th from ("
    f"select osm_num, -104.1 + (1 - 11.68e-6) * gx - 0.714 * {_ARC} * gy + -2.917 * {_ARC} * gz as wx,"
    f" -49.1 + 0.714 * {_ARC} * gx + (1 - 11.68e-6) * gy - 0.971 * {_ARC} * gz as wy,"
    f" -9.9 - -2.917 * {_ARC} * gx + 0.971 * {_ARC} * gy + (1 - 11.68e-6) * gz as wz from ("
    "select osm_num, nn * cos(radians(lat)) * cos(radians(lon)) as gx, nn * cos(radians(lat)) * sin(radians(lon)) as gy,"
    f" nn * (1 - {_RE2!r}) * sin(radians(lat)) as gz from (select *, 6378388.0 / sqrt(1 - {_RE2!r} * power(sin(radians(lat)), 2)) as nn from fx_points))))"
)


@query("helmert_shift", ctes("fx_points", extra=[("h", HELMERT_SQL)]) + "select osm_num, round(hlon, 8) as lon, round(hlat, 8) as lat from h")
def helmert_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = C.with_datum_shift(view(spark, sf_dir, "fx_points").select("osm_num", "lon", "lat"), "lon", "lat")
    return df.select("osm_num", F.round("lon", 8).alias("lon"), F.round("lat", 8).alias("lat"))


@query(
    "web_mercator_inverse",
    ctes("fx_points")
    + "select osm_num, case when osm_num % 50 = 0 then null else round(lon, 6) end as lon,"
    " case when osm_num % 50 = 0 then null else round(lat, 6) end as lat from fx_points",
)
def web_mercator_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degrees to Web Mercator and back; every fiftieth point is pushed out of bounds."""
    df = view(spark, sf_dir, "fx_points")
    x = F.radians("lon") * 6378137.0 + F.when(F.col("osm_num") % 50 == 0, F.lit(1e8)).otherwise(F.lit(0.0))
    y = F.log(F.tan(F.radians("lat") / 2.0 + F.lit(0.7853981633974483))) * 6378137.0
    lon, lat = C.inverse_web_mercator(F.col("mx"), F.col("my"))
    return df.select("osm_num", x.alias("mx"), y.alias("my")).select(
        "osm_num", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat")
    )


@query(
    "crs_dispatch",
    ctes("fx_points", extra=[("u", utm_sql("fx_points", "osm_num, lon, lat"))])
    + "select case osm_num % 4 when 0 then 'EPSG:4326' when 1 then 'EPSG:25832' when 2 then 'EPSG:9999' else 'EPSG:3003' end as crs, count(*) as n,"
    " count(case when osm_num % 4 <> 2 then 1 end) as located,"
    " count(case when osm_num % 4 = 2 then 1 end) as errors,"
    " round(avg(case when osm_num % 4 in (0, 1) then lon end), 6) as mean_lon, round(avg(case when osm_num % 4 in (0, 1) then lat end), 6) as mean_lat"
    " from u group by 1",
)
def crs_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed coordinate systems in one column; unknown systems become error rows."""
    df = view(spark, sf_dir, "fx_points")
    lon, lat, kind = F.col("lon"), F.col("lat"), F.col("osm_num") % 4
    ux, uy = C.utm32_x(lon, lat), C.utm32_y(lon, lat)
    mixed = df.select(
        "osm_num",
        F.when(kind == 0, lon).when(kind == 3, ux + 1e6).otherwise(ux).alias("x"),
        F.when(kind == 0, lat).otherwise(uy).alias("y"),
        F.when(kind == 0, " epsg:4326 ").when(kind == 1, "EPSG::25832").when(kind == 2, "EPSG:9999").otherwise("EPSG:3003").alias("crs"),
    )
    out = C.with_lonlat(mixed, "x", "y", "crs")
    shown = F.when(F.col("crs").isin("EPSG:3003", "EPSG:9999"), F.lit(None)).otherwise(F.lit(1.0))
    return out.groupBy(C.normalized_crs(F.col("crs")).alias("crs")).agg(
        F.count("*").alias("n"),
        F.count("lon").alias("located"),
        F.count("crs_error").alias("errors"),
        F.round(F.avg(F.col("lon") * shown), 6).alias("mean_lon"),
        F.round(F.avg(F.col("lat") * shown), 6).alias("mean_lat"),
    )


@query(
    "local_plane_roundtrip",
    ctes("fx_points") + f"select osm_num, round({X_SQL}, 3) as x, round({Y_SQL}, 3) as y, round(lon, 6) as lon, round(lat, 6) as lat from fx_points",
)
def local_plane_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = C.to_local(F.col("lon"), F.col("lat"), REGION)
    df = view(spark, sf_dir, "fx_points").select("osm_num", x.alias("x"), y.alias("y"))
    lon, lat = C.from_local(F.col("x"), F.col("y"), REGION)
    return df.select(
        "osm_num", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat")
    )


@query("haversine_to_center", ctes("fx_points") + f"select osm_num, round({HAV_CENTER}, 3) as distance_m from fx_points")
def haversine_to_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "fx_points").select(
        "osm_num", F.round(M.distance_to_center_m(F.col("lon"), F.col("lat"), REGION), 3).alias("distance_m")
    )


# --- rectangles --------------------------------------------------------------------------------


def rect_parts(spark: SparkSession, sf_dir: str, name: str = "fx_rects") -> DataFrame:
    """Rectangles as geometry in the local plane of their region."""
    df = view(spark, sf_dir, name)
    return df.withColumn("parts", M.box_parts(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))


def holed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles; every fifth one has a square hole of one metre."""
    df = rect_parts(spark, sf_dir)
    hole = F.flatten(M.box_parts(F.col("x0") + 1, F.col("y0") + 1, F.col("x0") + 2, F.col("y0") + 2))
    with_hole = F.array(F.concat(F.flatten("parts"), hole))
    return df.withColumn("parts", F.when(F.col("seq") % 5 == 0, with_hole).otherwise(F.col("parts")))


@query(
    "polygon_measures",
    ctes("fx_rects")
    + "select region, seq, (x1 - x0) * (y1 - y0) - case when seq % 5 = 0 then 1 else 0 end as area_m2, x0 as min_x, y0 as min_y, x1 as max_x, y1 as max_y,"
    " cast(5 as bigint) as vertices, round((3 * x0 + 2 * x1) / 5, 6) as mean_x, round((3 * y0 + 2 * y1) / 5, 6) as mean_y,"
    " round(case when x0 <= 0 and x1 > 0 and y0 <= 0 and y1 > 0 then 0 else"
    " sqrt(power(greatest(x0, -x1, 0), 2) + power(greatest(y0, -y1, 0), 2)) end, 3) as roi_distance_m,"
    " round(((x1 - x0) * (y1 - y0) * (x0 + x1) / 2 - case when seq % 5 = 0 then x0 + 1.5 else 0 end) /"
    " ((x1 - x0) * (y1 - y0) - case when seq % 5 = 0 then 1 else 0 end), 6) as centroid_x from fx_rects",
)
def polygon_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = holed_parts(spark, sf_dir)
    parts, kind = F.col("parts"), F.lit("Polygon")
    return df.withColumns(
        {"b": M.parts_bbox(parts), "c": M.vertex_centroid(kind, parts), "g": M.area_centroid(parts)}
    ).select(
        "region",
        "seq",
        M.parts_area(parts).alias("area_m2"),
        F.col("b.min_x").alias("min_x"),
        F.col("b.min_y").alias("min_y"),
        F.col("b.max_x").alias("max_x"),
        F.col("b.max_y").alias("max_y"),
        M.shell_vertex_count(parts).cast("bigint").alias("vertices"),
        F.round("c.x", 6).alias("mean_x"),
        F.round("c.y", 6).alias("mean_y"),
        F.round(M.roi_distance_m(kind, parts), 3).alias("roi_distance_m"),
        F.round("g.x", 6).alias("centroid_x"),
    )


@query(
    "reference_points",
    ctes("fx_rects") + "select region, seq, true as inside, round((y0 + y1) / 2, 6) as y from fx_rects",
)
def reference_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interior points lie inside their polygon, also next to a hole."""
    df = holed_parts(spark, sf_dir).withColumn("p", M.reference_point(F.lit("Polygon"), F.col("parts")))
    df = df.withColumn("polygon", F.get("parts", F.lit(0)))
    plain = F.col("seq") % 5 != 0
    return df.select(
        "region",
        "seq",
        M.point_in_polygon("polygon", "p.x", "p.y").alias("inside"),
        F.round(F.when(plain, F.col("p.y")).otherwise((F.col("y0") + F.col("y1")) / 2), 6).alias("y"),
    )


@query(
    "project_polygons",
    ctes(
        "fx_rects",
        extra=[
            ("c", "select region, seq, x0 as x, y0 as y, 1 as w from fx_rects union all select region, seq, x1, y0, 1 from fx_rects"
             " union all select region, seq, x1, y1, 1 from fx_rects union all select region, seq, x0, y1, 1 from fx_rects"),
            ("ll", "select *, 11.2558 + degrees(x / (6371000.0 * cos(radians(43.7696)))) as lon, 43.7696 + degrees(y / 6371000.0) as lat from c"),
            ("u", utm_sql("ll", "region, seq")),
        ],
    )
    + "select region, seq, round(min(ux), 3) as min_x, round(min(uy), 3) as min_y, round(max(ux), 3) as max_x, round(max(uy), 3) as max_y,"
    " 'EPSG:4326' as source_crs, 'EPSG:25832' as projected_crs from u group by 1, 2",
)
def project_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local metres to degrees to projected metres."""
    df = rect_parts(spark, sf_dir).withColumn("parts", C.delocalize_parts(F.col("parts"), REGION))
    df = df.where(C.lonlat_in_range(F.col("parts"))).withColumn("b", M.parts_bbox(M.valid_parts(C.project_parts(F.col("parts")))))
    return df.select(
        "region",
        "seq",
        *[F.round(f"b.{c}", 3).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")],
        F.lit("EPSG:4326").alias("source_crs"),
        F.lit(REGION.crs).alias("projected_crs"),
    )


RECT_DISTANCE_SQL = (
    "case when x0 <= 0 and x1 > 0 and y0 <= 0 and y1 > 0 then 0 else"
    " sqrt(power(greatest(x0, -x1, 0), 2) + power(greatest(y0, -y1, 0), 2)) end"
)


def mixed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points and rectangles as one feature table."""
    points = tagged_points(spark, sf_dir).where("cls is not null").select(
        "region",
        F.col("osm_num").alias("seq"),
        F.lit("node").alias("osm_type"),
        F.col("cls.category").alias("category"),
        F.col("cls.group_tag").alias("group_tag"),
        F.col("cls.source_tag").alias("source_tag"),
        F.lit("Point").alias("geom_type"),
        M.point_parts(F.col("lon"), F.col("lat")).alias("parts"),
        "roi_zone",
        "tags",
    )
    rects = rect_parts(spark, sf_dir).select(
        "region",
        "seq",
        F.lit("way").alias("osm_type"),
        "category",
        "group_tag",
        F.concat_ws("=", F.lit("rect"), "category").alias("source_tag"),
        F.lit("Polygon").alias("geom_type"),
        C.delocalize_parts(F.col("parts"), REGION).alias("parts"),
        M.roi_zone(M.roi_distance_m(F.lit("Polygon"), F.col("parts")), REGION).alias("roi_zone"),
        F.create_map().cast(TAGS).alias("tags"),
    )
    both = points.unionByName(rects).where("roi_zone is not null")
    return both.withColumn("contributes_to_geometry", M.contributes(F.col("geom_type")))


MIXED_SQL = CLS_CTES + (
    ", fx_rects as (select {rects} from customer), m as (select region, osm_num as seq, 'node' as osm_type, category, group_tag, stag as source_tag,"
    " 'Point' as geom_type, roi_zone, case when key1 = 'building' then val1 end as building from z where category is not null and roi_zone is not null"
    " union all select region, seq, 'way', category, group_tag, concat('rect=', category), 'Polygon', case when dist <= 150 then 'inner' else 'annular' end, null"
    " from (select *, {dist} as dist from fx_rects) where dist <= 250) "
)


def mixed_sql(tail: str) -> str:
    from geoloom.plans.fixtures import VIEWS

    return MIXED_SQL.format(rects=", ".join(VIEWS["fx_rects"][1]), dist=RECT_DISTANCE_SQL) + tail


@query(
    "geometry_diagnostics",
    mixed_sql(
        "select 'contributing' as metric, case when geom_type = 'Polygon' then 'contributing' else 'non_contributing' end as key, count(*) as n from m group by 2"
        " union all select 'geometry_type', geom_type, count(*) from m group by 2"
        " union all select 'contributing_by_category', category, count(*) from m where geom_type = 'Polygon' group by 2"
        " union all select 'non_contributing_by_category', category, count(*) from m where geom_type = 'Point' group by 2"
        " union all select 'non_contributing_by_geometry_type', geom_type, count(*) from m where geom_type = 'Point' group by 2"
    ),
)
def geometry_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.geometry_diagnostics(mixed_features(spark, sf_dir))


@query(
    "feature_summary",
    mixed_sql(
        "select c.key as key, 'by_category' as metric, count(m.seq) as n from (select unnest(["
        + ", ".join(f"'{c}'" for c in CATEGORIES)
        + "]) as key) c left join m on m.category = c.key group by 1"
        " union all select group_tag, 'by_group_tag', count(*) from m group by 1"
        " union all select source_tag, 'by_source_tag', count(*) from m group by 1"
        " union all select roi_zone, 'by_roi_zone', count(*) from m group by 1"
        " union all select source_tag, 'available_not_mapped_to_core', count(*) from m where category = 'other_terrain' group by 1"
    ),
)
def feature_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.feature_summary(mixed_features(spark, sf_dir))


@query(
    "feature_roles",
    mixed_sql(
        "select category, geom_type, roi_zone, case when roi_zone = 'inner' then 'primary_roi' else 'annular_context' end as scope,"
        " case when geom_type = 'Polygon' then 'contributing_polygon' else 'reference_only_non_contributing' end as geometry_role,"
        " category = 'buildings' and roi_zone = 'inner' as include_in_lod22,"
        " geom_type = 'Polygon' and category = 'buildings' and roi_zone = 'inner' as eligible,"
        " case when building = 'roof' then cast(2.0 as double) else cast(0.0 as double) end as base_height_m, count(*) as n from m group by all"
    ),
)
def feature_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scope, role, level-of-detail flag, footprint eligibility and roof base height."""
    df = mixed_features(spark, sf_dir)
    lod = M.in_lod22(F.col("category"), F.col("roi_zone"))
    return df.groupBy(
        "category",
        "geom_type",
        "roi_zone",
        M.reconstruction_scope(F.col("roi_zone")).alias("scope"),
        M.geometry_role(F.col("geom_type")).alias("geometry_role"),
        lod.alias("include_in_lod22"),
        FT.footprint_eligible(F.col("geom_type"), F.col("contributes_to_geometry"), lod).alias("eligible"),
        A.building_base_height(F.col("tags")).alias("base_height_m"),
    ).agg(F.count("*").alias("n"))


@query(
    "canonical_order",
    mixed_sql(
        "select region, category, group_tag, osm_type, seq, row_number() over (partition by region, category order by group_tag, osm_type, seq) as position from m"
    ),
)
def canonical_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of every feature in canonical order inside its region and category."""
    df = mixed_features(spark, sf_dir)
    return O.blocked_ordinal(
        df.select("region", "category", "group_tag", "osm_type", "seq"),
        by=["region", "category"],
        block=["group_tag", "osm_type"],
        within=["seq"],
        out="position",
    )


# --- elements -------------------------------------------------------------------------------------

WAY_LENGTH = 5


@query(
    "element_geometry",
    ctes("fx_points", extra=[("w", "select cast(floor(osm_num / 5) as bigint) as way, osm_num, lon, lat from fx_points where osm_num % 23 <> 0")])
    + "select way, case when way % 3 = 0 and way % 2 = 1 and count(*) >= 3 then 'Polygon' when count(*) + case when way % 3 = 0 then 1 else 0 end >= 2 then 'LineString' end as geom_type,"
    " count(*) + case when way % 3 = 0 then 1 else 0 end as vertices, round(avg(lon), 7) as mean_lon, round(avg(lat), 7) as mean_lat from w group by way",
)
def element_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways of five consecutive nodes looked up by id; some closed, some nodes missing, even ways are roads."""
    nodes = view(spark, sf_dir, "fx_points")
    base = nodes.select((F.floor(F.col("osm_num") / WAY_LENGTH)).alias("way"), "osm_num")
    ways = base.groupBy("way").agg(F.array_sort(F.collect_list("osm_num")).alias("ids"))
    closing = F.get(F.filter("ids", lambda i: i % 23 != 0), F.lit(0))
    ways = ways.withColumn(
        "nodes", F.when(F.col("way") % 3 == 0, F.concat("ids", F.array(closing))).otherwise(F.col("ids"))
    )
    no_geometry = F.lit(None).cast("array<struct<lat:double,lon:double>>")
    no_members = F.lit(None).cast("array<struct<type:string,role:string,geometry:array<struct<lat:double,lon:double>>>>")
    way_rows = ways.select(
        F.lit("way").alias("type"),
        F.col("way").alias("id"),
        (F.col("way") + 10**12).alias("seq"),
        F.lit(None).cast("double").alias("lat"),
        F.lit(None).cast("double").alias("lon"),
        "nodes",
    )
    node_rows = nodes.where(F.col("osm_num") % 23 != 0).select(
        F.lit("node").alias("type"), F.col("osm_num").alias("id"), F.col("osm_num").alias("seq"), "lat", "lon",
        F.lit(None).cast("array<bigint>").alias("nodes"),
    )
    elements = node_rows.unionByName(way_rows).withColumns({"geometry": no_geometry, "members": no_members})
    category = F.when(F.col("id") % 2 == 0, F.lit("roads")).otherwise(F.lit("water"))
    out = FT.element_geometry(FT.way_vertices(elements.withColumn("category", category))).where("type = 'way'")
    distinct = F.when(F.col("id") % 3 == 0, F.slice("vertices", 1, F.size("vertices") - 1)).otherwise(F.col("vertices"))
    center = M.mean_vertex(distinct)
    return out.select(
        F.col("id").alias("way"),
        "geom_type",
        F.size("vertices").cast("bigint").alias("vertices"),
        F.round(center["x"], 7).alias("mean_lon"),
        F.round(center["y"], 7).alias("mean_lat"),
    )


@query(
    "relation_rings",
    ctes("fx_rects")
    + "select region, seq, cast(1 as bigint) as polygons, cast(case when seq % 2 = 0 then 2 else 1 end as bigint) as rings,"
    " (x1 - x0) * (y1 - y0) - case when seq % 2 = 0 then 1 else 0 end as area_m2 from fx_rects",
)
def relation_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles split into four unordered, partly reversed segments, some with an inner square."""
    df = view(spark, sf_dir, "fx_rects")
    v = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    p = lambda x, y: v(F.col(x), F.col(y))
    outer = F.array(
        F.array(p("x1", "y1"), p("x1", "y0")),
        F.array(p("x0", "y0"), p("x1", "y0")),
        F.array(p("x0", "y1"), p("x0", "y0")),
        F.array(p("x1", "y1"), p("x0", "y1")),
    )
    q = lambda dx, dy: v(F.col("x0") + dx, F.col("y0") + dy)
    none = F.array().cast("array<array<struct<x:double,y:double>>>")
    inner = F.when(
        F.col("seq") % 2 == 0, F.array(F.array(q(1, 1), q(2, 1), q(2, 2)), F.array(q(1, 1), q(1, 2), q(2, 2)))
    ).otherwise(none)
    segments = df.withColumns({"_os": outer, "_is": inner})
    rings = segments.withColumns({"_o": FT.assemble_rings(F.col("_os")), "_i": FT.assemble_rings(F.col("_is"))})
    rings = rings.withColumn("parts", FT.relation_parts(F.col("_o"), F.col("_i")))
    return rings.select(
        "region",
        "seq",
        F.size("parts").cast("bigint").alias("polygons"),
        F.size(F.flatten("parts")).cast("bigint").alias("rings"),
        M.parts_area(F.col("parts")).alias("area_m2"),
    )


@query(
    "ring_nesting",
    ctes("fx_rects")
    + "select region, seq, cast(2 as bigint) as polygons, cast(3 as bigint) as rings, (x1 - x0) * (y1 - y0) - 3 as area_m2 from fx_rects",
)
def ring_nesting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three nested rings per record: shell, hole of four square metres, island of one."""
    df = view(spark, sf_dir, "fx_rects")

    v = lambda x, y: F.struct(x.alias("x"), y.alias("y"))

    def square(lo: float, hi: float) -> Column:
        at = lambda dx, dy: v(F.col("x0") + dx, F.col("y0") + dy)
        return F.array(at(lo, lo), at(hi, lo), at(hi, hi), at(lo, hi), at(lo, lo))

    shell = F.get(F.get(M.box_parts(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")), F.lit(0)), F.lit(0))
    df = df.withColumn("rings", F.array(square(1.5, 2.5), shell, square(1.0, 3.0)))
    parts = FT.nest_rings(*FT.flat_rings(F.col("rings")))
    return df.select("region", "seq", parts.alias("parts")).select(
        "region",
        "seq",
        F.size("parts").cast("bigint").alias("polygons"),
        F.size(F.flatten("parts")).cast("bigint").alias("rings"),
        M.parts_area(F.col("parts")).alias("area_m2"),
    )


@query(
    "merge_batches_last_wins",
    ctes("fx_points")
    + "select 'node' as type, osm_num as id, cast(case when osm_num % 3 = 0 then 1 else 0 end as bigint) as batch,"
    " case when osm_num % 2 = 0 then concat('second-', val1) else val1 end as value from fx_points",
)
def merge_batches_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping extracts: the later value wins, the first position stays."""
    df = view(spark, sf_dir, "fx_points")
    row = lambda b, v: [
        F.lit(b).cast("bigint").alias("batch"), F.col("osm_num").alias("pos"), F.lit("node").alias("type"),
        F.col("osm_num").alias("id"), v.alias("value"),
    ]
    first = df.where("osm_num % 3 <> 0").select(*row(0, F.col("val1")))
    second = df.where("osm_num % 2 = 0 or osm_num % 3 = 0").select(
        *row(1, F.when(F.col("osm_num") % 2 == 0, F.concat(F.lit("second-"), "val1")).otherwise(F.col("val1")))
    )
    return FT.merge_batches(first.unionByName(second)).select("type", "id", "batch", "value")


# --- attributes ---------------------------------------------------------------------------------------


@query(
    "attribute_parsing",
    ctes(
        "fx_attrs",
        extra=[
            (
                "n",
                "select *, trim(regexp_extract(replace(dbh, ',', '.'), '^[0-9.]+', 0)) as d_, regexp_extract(circonf, '^[0-9.]+', 0) as c_ from fx_attrs",
            ),
            ("v", "select *, case when d_ is null or d_ = '' then null else cast(d_ as double) end as d, case when c_ = '' then null else cast(c_ as double) end as c from n"),
        ],
    )
    + "select seq, case when trim(specie) in ('unknown', '--') then null else specie end as species, case when dbh = '-' then null else dbh end as dbh,"
    " round(case when d <= 0 then null when d > 2 then d / 100 else d end, 4) as diameter_m,"
    " case when circonf = 'n/a' then null else circonf end as source_circumference,"
    " round(case when c <= 0 then null when c > 10 then c / 100 else c end, 4) as circumference_m from v",
)
def attribute_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = view(spark, sf_dir, "fx_attrs")
    attrs = F.create_map(F.lit(" Specie"), F.col("specie"), F.lit("DBH"), F.col("dbh"), F.lit("Circonf"), F.col("circonf"))
    tags = A.tree_tags(attrs)
    return df.select("seq", tags.alias("t")).select(
        "seq",
        A.tag(F.col("t"), "species").alias("species"),
        A.tag(F.col("t"), "dbh").alias("dbh"),
        A.tag(F.col("t"), "diameter").try_cast("double").alias("diameter_m"),
        A.tag(F.col("t"), "source_circumference").alias("source_circumference"),
        A.tag(F.col("t"), "circumference").try_cast("double").alias("circumference_m"),
    )


@query(
    "positional_attributes",
    ctes("fx_rects", "fx_trees")
    + "select r.seq as shape_index, r.category, t.species from fx_rects r left join fx_trees t on t.seq = r.seq and t.seq % 4 <> 3"
    " where not exists (select 1 from fx_trees d where d.seq = r.seq and d.seq % 4 = 1)",
)
def positional_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes paired with attribute rows by position; some rows deleted, some missing."""
    shapes = view(spark, sf_dir, "fx_rects").select(F.lit("a.shp").alias("file"), F.col("seq").alias("shape_index"), "category")
    attributes = view(spark, sf_dir, "fx_trees").where("seq % 4 <> 3").select(
        F.lit("a.shp").alias("file"),
        F.col("seq").alias("shape_index"),
        (F.col("seq") % 4 == 1).alias("deleted"),
        F.create_map(F.lit("species"), F.col("species")).alias("attrs"),
    )
    out = FT.positional_attributes(shapes, attributes)
    return out.select("shape_index", "category", A.tag(F.col("attrs"), "species").alias("species"))


INPUTS_SQL = "(values ('north', 'EPSG:4326', 'trees', true), ('south', 'EPSG:3857', 'roads', true), ('west', 'EPSG:4326', 'trees', false)) as i(name, crs, category, enabled)"


def planning_inputs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [("north", "EPSG:4326", "trees", True), ("south", "EPSG:3857", "roads", True), ("west", "EPSG:4326", "trees", False)],
        "name string, crs string, category string, enabled boolean",
    )


def planning_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planning points in raw form: property map of JSON values, mixed coordinate systems, some defects."""
    df = view(spark, sf_dir, "fx_planning")
    web = F.col("input_name") == "south"
    mx = F.radians("lon") * 6378137.0
    my = F.log(F.tan(F.radians("lat") / 2.0 + F.lit(0.7853981633974483))) * 6378137.0
    quote = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    entry = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    tree = F.col("kind") == "tree"
    unsafe = F.concat(F.lit("bad id "), F.col("osm_num").cast("string"))
    entries = F.array(
        entry("ID", quote(F.when(F.col("osm_num") % 101 == 0, unsafe).otherwise(F.col("id")))),
        entry("kind", quote(F.when(F.col("osm_num") % 103 == 0, F.lit("bench")).otherwise(F.col("kind")))),
        entry("model", quote(F.col("model"))),
        entry("height_m", F.when(F.col("osm_num") % 107 == 0, F.lit("-1")).otherwise(F.col("height_m").cast("string"))),
        entry("width_m", F.when(~tree, F.col("width_m").cast("string"))),
        entry("rotation_deg", F.when(~tree, F.col("rotation_deg").cast("string"))),
        entry("street", quote(F.col("input_name"))),
    )
    return df.select(
        "region",
        "osm_num",
        "input_name",
        F.lit("plan.geojson").alias("source"),
        F.when(web, "EPSG:3857").otherwise("EPSG:4326").alias("source_crs"),
        F.col("osm_num").alias("source_feature_index"),
        F.lit("Point").alias("geom_type"),
        F.when(web, mx).otherwise(F.col("lon")).alias("x"),
        F.when(web, my).otherwise(F.col("lat")).alias("y"),
        F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("properties"),
    )


def planning_models(spark: SparkSession) -> DataFrame:
    """Allowed model names per kind; the palm model answers only to its full name."""
    trees = tree_models(spark).select(F.lit("tree").alias("kind"), F.col("name").alias("model"))
    towers = purifier_catalogue(spark).select(F.lit("air_purifier").alias("kind"), F.col("name").alias("model"))
    return trees.unionByName(towers)


PLAN_ZONE = f"case when {HAV_CENTER} <= 150 then 'inner' when {HAV_CENTER} <= 250 then 'annular' else 'outside' end"
PLAN_ERRORS = (
    "case when osm_num % 101 = 0 then 1 else 0 end + case when osm_num % 103 = 0 then 1 else 0 end"
    " + case when model = 'palm' and osm_num % 103 <> 0 then 1 else 0 end + case when osm_num % 107 = 0 and osm_num % 103 <> 0 then 1 else 0 end"
)
PLAN_CTES = ctes("fx_planning", extra=[("p", f"select *, {PLAN_ZONE} as zone, {PLAN_ERRORS} as n_errors from fx_planning")])


@query(
    "planning_normalization",
    PLAN_CTES
    + "select osm_num, cast(n_errors as bigint) as errors, zone as roi_zone, round(lon, 6) as lon, round(lat, 6) as lat,"
    " case when osm_num % 107 = 0 then cast(-1 as double) else height_m end as height_m, case when kind = 'tree' then null else rotation_deg end as rotation_deg,"
    " concat('{\"street\":\"\\\"', input_name, '\\\"\"}') as source_properties from p",
)
def planning_normalization(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = PL.normalize(planning_points(spark, sf_dir), REGION, planning_models(spark))
    return out.select(
        "osm_num",
        F.size("errors").cast("bigint").alias("errors"),
        "roi_zone",
        F.round("lon", 6).alias("lon"),
        F.round("lat", 6).alias("lat"),
        "height_m",
        "rotation_deg",
        "source_properties",
    )


@query(
    "planning_counts",
    PLAN_CTES
    + "select input_name as urban_planning_input_id, kind, count(*) as source_features, count(case when zone <> 'outside' then 1 end) as accepted_features,"
    " count(case when zone = 'outside' then 1 end) as outside_roi from p where n_errors = 0 group by cube (input_name, kind)",
)
def planning_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = PL.normalize(planning_points(spark, sf_dir), REGION, planning_models(spark))
    return Q.planning_counts(out.where(F.size("errors") == 0))


@query(
    "planning_outside_records",
    PLAN_CTES
    + f"select input_name as urban_planning_input_id, osm_num as source_feature_index, id, kind, round(lon, 6) as lon, round(lat, 6) as lat,"
    f" round({HAV_CENTER}, 3) as roi_distance_m from p where n_errors = 0 and zone = 'outside'",
)
def planning_outside_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = PL.normalize(planning_points(spark, sf_dir), REGION, planning_models(spark))
    rows = Q.outside_records(out.where(F.size("errors") == 0))
    return rows.withColumns(
        {"lon": F.round("lon", 6), "lat": F.round("lat", 6)}
    )


@query(
    "planning_routing",
    PLAN_CTES
    + "select case when kind = 'tree' then 'trees' else 'air_purifiers' end as category, concat('urban_planning=', input_name) as source_tag,"
    " case when kind = 'tree' then 'tree_reference_point' else 'air_purifier_reference_point' end as geometry_role,"
    " case when zone = 'inner' then 'primary_roi' else 'annular_context' end as reconstruction_scope,"
    " count(case when kind = 'tree' then 1 end) as with_direct_model, count(case when kind <> 'tree' then 1 end) as with_purifier_id, count(*) as n"
    " from p where n_errors = 0 and zone <> 'outside' group by 1, 2, 3, 4",
)
def planning_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = PL.route(PL.accepted(PL.normalize(planning_points(spark, sf_dir), REGION, planning_models(spark))))
    return out.groupBy("category", "source_tag", "geometry_role", "reconstruction_scope").agg(
        F.count("direct_model_category").alias("with_direct_model"),
        F.count("purifier_id").alias("with_purifier_id"),
        F.count("*").alias("n"),
    )


@query(
    "supplemental_stats",
    ctes("fx_planning")
    + f"select i.name, i.enabled, i.category, case when i.enabled then count(p.osm_num) else 0 end as loaded_features from {INPUTS_SQL}"
    " left join fx_planning p on p.input_name = i.name group by 1, 2, 3",
)
def supplemental_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = view(spark, sf_dir, "fx_planning").withColumnRenamed("input_name", "supplemental_input_id")
    return Q.supplemental_statistics(planning_inputs(spark).drop("crs"), features)


@query(
    "supplemental_totals",
    ctes("fx_planning")
    + "select case when category = 'trees' then 'trees' else 'surfaces' end as kind, count(*) as configured_inputs, count(case when enabled then 1 end) as enabled_inputs,"
    " cast(sum(loaded) as bigint) as loaded_features from (select i.name, i.enabled, i.category, case when i.enabled then count(p.osm_num) else 0 end as loaded"
    f" from {INPUTS_SQL} left join fx_planning p on p.input_name = i.name group by 1, 2, 3) group by 1",
)
def supplemental_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = view(spark, sf_dir, "fx_planning").withColumnRenamed("input_name", "supplemental_input_id")
    return Q.supplemental_totals(Q.supplemental_statistics(planning_inputs(spark), features))


@query(
    "duplicate_ids",
    ctes("fx_planning")
    + "select concat('P-', cast(osm_num % 1999 as string)) as key, count(*) as uses, min(input_name) as first_input_name,"
    " min_by(osm_num, input_name || lpad(cast(osm_num as string), 18, '0')) as first_osm_num from fx_planning group by 1 having count(*) > 1",
)
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids shared by several planning points, with the first place each was used."""
    df = view(spark, sf_dir, "fx_planning")
    key = F.concat(F.lit("P-"), (F.col("osm_num") % 1999).cast("string"))
    return Q.duplicate_keys(df, key, ["input_name", "osm_num"])


@query(
    "source_union",
    mixed_sql(
        f", u as (select 0 as source_no, category, osm_type from m union all select 1, 'trees', 'urban_planning' from (select {', '.join(__import__('geoloom.plans.fixtures', fromlist=['VIEWS']).VIEWS['fx_planning'][1])}"
        f" from events) p join {INPUTS_SQL} on i.name = p.input_name and i.enabled)"
        " select cast(source_no as bigint) as source_no, category, osm_type, count(*) as n from u group by 1, 2, 3"
    ),
)
def source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map features and planning features of enabled inputs in one table."""
    planned = FT.enabled_inputs(
        view(spark, sf_dir, "fx_planning").withColumnRenamed("input_name", "supplemental_input_id"),
        planning_inputs(spark).drop("category"),
    ).select(
        "region",
        F.col("osm_num").alias("seq"),
        F.lit("urban_planning").alias("osm_type"),
        F.lit("trees").alias("category"),
        "supplemental_input_id",
        "crs",
    )
    both = FT.union_sources(mixed_features(spark, sf_dir), planned)
    return both.groupBy(F.col("source_no").cast("bigint").alias("source_no"), "category", "osm_type").agg(F.count("*").alias("n"))


RANK_SQL = (
    "case when supplement = 'streets' then 5 when category = 'buildings' and group_tag = 'building_part' then 0"
    " when category = 'buildings' then 1 when category = 'water' then 2 when category = 'green_areas' then 4 when category = 'roads' then 6 else 7 end"
)


def ranked_rects(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rect_parts(spark, sf_dir).withColumnRenamed("supplement", "supplemental_input_id")
    return OV.precedence_rank(df, DEFAULT_PRECEDENCE)


@query(
    "precedence_rank",
    ctes("fx_rects")
    + f"select region, seq, cast({RANK_SQL} as bigint) as rank, row_number() over (partition by region, {RANK_SQL} order by seq) as position from fx_rects",
)
def precedence_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank by the most specific configured selector and the place among equals."""
    df = ranked_rects(spark, sf_dir).select("region", "seq", "rank")
    return O.ordinal(df, order="seq", out="position", by=["region", "rank"])


TREE_TOLERANCE_M = 6.0
DEDUPE_PAIRS = HAV.format(lat1="a.lat", lon1="a.lon", lat2="b.lat", lon2="b.lon")


@query(
    "dedupe_near_trees",
    ctes("fx_points", extra=[("t", "select * from fx_points where key1 = 'natural'")])
    + f", pairs as (select a.region, a.osm_num as seq, b.osm_num as s_seq, {DEDUPE_PAIRS} as d from t a join t b on a.region = b.region"
    " and a.osm_num % 2 = 0 and b.osm_num % 2 = 1 and abs(a.lat - b.lat) < 0.0002 and abs(a.lon - b.lon) < 0.0002)"
    f", best as (select region, seq, min_by(s_seq, d) as s_seq, min(d) as d from pairs where d <= {TREE_TOLERANCE_M} group by 1, 2)"
    " select t.region, t.osm_num as seq, best.seq is not null as removed, cast(best.s_seq as string) as nearest_id, round(best.d, 3) as nearest_distance_m"
    " from t left join best on best.region = t.region and best.seq = t.osm_num where t.osm_num % 2 = 0",
)
def dedupe_near_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map trees (even ids) that repeat a supplemental tree (odd ids) within six metres."""
    trees = view(spark, sf_dir, "fx_points").where("key1 = 'natural'").select("region", F.col("osm_num").alias("seq"), "lon", "lat")
    supplements = trees.where("seq % 2 = 1").withColumn("osm_id", F.col("seq").cast("string"))
    out = drop_duplicate_trees(
        trees.where("seq % 2 = 0"), supplements, tolerance_m=TREE_TOLERANCE_M, region=REGION, on=["region"]
    )
    return out.select(
        "region",
        "seq",
        F.col("nearest_id").isNotNull().alias("removed"),
        "nearest_id",
        F.round("nearest_distance_m", 3).alias("nearest_distance_m"),
    )


@query(
    "dedupe_first_removed",
    ctes("fx_points", extra=[("t", "select * from fx_points where key1 = 'natural'")])
    + f", pairs as (select a.osm_num as seq, {DEDUPE_PAIRS} as d from t a join t b on a.region = b.region"
    " and a.osm_num % 2 = 0 and b.osm_num % 2 = 1 and abs(a.lat - b.lat) < 0.0002 and abs(a.lon - b.lon) < 0.0002)"
    f" select seq, round(min(d), 3) as nearest_distance_m from pairs where d <= {TREE_TOLERANCE_M} group by 1 order by seq limit 200",
)
def dedupe_first_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's first 200 removed duplicates in feature order."""
    out = dedupe_near_trees(spark, sf_dir)
    return out.where("removed").orderBy("seq").limit(200).select("seq", "nearest_distance_m")
