"""End-to-end plans: features, point clouds, instances, review and city-model data.

Each function wires operators into a plan and returns its DataFrames; nothing
is collected. Tables that several results read (features, classified cells,
instances) are checkpointed once in the shared folder, so no result repeats the
work before them and a lost executor does not either.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import attributes as A
from geoloom.functions import crs as C
from geoloom.functions import measure as M
from geoloom.operators import features as FT
from geoloom.operators import mesh as MS
from geoloom.operators import ordering as O
from geoloom.operators import overlay as OV
from geoloom.operators import planning as PL
from geoloom.operators import purifiers as PU
from geoloom.operators import raster as R
from geoloom.operators import spatial as S
from geoloom.operators import terrain as TR
from geoloom.operators import trees as TE
from geoloom.operators.classify import DEFAULT_PRECEDENCE, DEFAULT_RULES, Rule
from geoloom.operators.skew import cut_lineage
from geoloom.params import MIN_SURFACE_M2, Region
from geoloom.sources import geojson as G
from geoloom.sources import rasters as RA

# Every source keeps its own order; sources follow each other.
SOURCE_STRIDE = 10**15


@dataclass(frozen=True)
class FeaturePlan:
    """Accepted features in total order, what was left out and why, and the surface reports."""

    features: DataFrame
    rejected: DataFrame
    duplicate_trees: DataFrame
    surfaces: DataFrame
    gaps: DataFrame


def plan_features(
    elements: DataFrame,
    region: Region,
    *,
    rules: Sequence[Rule] = DEFAULT_RULES,
    precedence: Sequence[str] = DEFAULT_PRECEDENCE,
    tree_points: DataFrame | None = None,
    surface_polygons: DataFrame | None = None,
    planning: DataFrame | None = None,
    tree_tolerance_m: float = 2.0,
) -> FeaturePlan:
    """Map elements, inventories and planning points to disjoint, zoned features.

    ``elements`` carry ``seq``; ``tree_points`` and ``surface_polygons`` are in
    the shape of :func:`supplemental_trees` / :func:`supplemental_surfaces`
    (surfaces unclipped, lon/lat ``parts``); ``planning`` is normalized.
    """
    every = FT.elements_to_features(elements, region, rules)
    every = cut_lineage(every)
    rejected = every.where("skip_reason is not null")
    accepted = every.where("skip_reason is null").drop("skip_reason")
    sources = [accepted]
    duplicates = accepted.where(F.lit(False)).select("seq")
    if tree_points is not None:
        inventory = FT.supplemental_trees(tree_points, region)
        position = F.get(F.get(F.get("parts", F.lit(0)), F.lit(0)), F.lit(0))
        located = lambda df: df.withColumns({"lon": position["x"], "lat": position["y"]})
        is_tree = FT.is_map_tree(F.col("category"), F.col("source_tag"), F.col("source_type")) & (F.col("geom_type") == "Point")
        marked = S.drop_duplicate_trees(
            located(accepted.where(is_tree)).select("seq", "lon", "lat"),
            located(inventory).select("seq", "osm_id", "lon", "lat"),
            tolerance_m=tree_tolerance_m,
            region=region,
        )
        duplicates = marked.where("nearest_id is not null")
        sources[0] = accepted.join(duplicates.select("seq"), "seq", "left_anti")
        sources.append(inventory)
    if planning is not None:
        points = PL.route(PL.accepted(planning)).withColumn("seq", F.col("source_feature_index"))
        sources.append(points.drop("x", "y", "errors", "source_crs", "source"))
    if surface_polygons is not None:
        sources.append(clip_surfaces(surface_polygons, region))
    union = FT.union_sources(*sources).withColumn("seq", F.col("source_no") * F.lit(SOURCE_STRIDE) + F.col("seq"))
    union = cut_lineage(union)

    planar = union.where("contributes_to_geometry").select(
        "seq", "category", "group_tag",
        F.col("supplemental_input_id") if "supplemental_input_id" in union.columns else F.lit(None).cast("string").alias("supplemental_input_id"),
        C.localize_parts(F.col("parts"), region).alias("parts"),
    )
    planar = cut_lineage(planar)
    surfaces = cut_lineage(OV.disjoint_surfaces(OV.precedence_rank(planar, precedence)))
    one = union.sparkSession.range(1).select()
    gaps = cut_lineage(OV.gap_fill(planar.select("seq", "parts"), one, region=region, geometry=True))
    states = surfaces.select(
        "seq", "state", "area_m2", F.col("removed_area_m2").alias("overlap_removed_area_m2"),
        F.when(F.col("state") == "clipped", C.delocalize_parts(F.col("parts"), region)).alias("_cut"),
    )
    kept = union.drop("area_m2").join(states, "seq", "left").where("state is null or state <> 'removed'")
    many = F.col("_cut").isNotNull() & F.col("geom_type").isin("Polygon", "MultiPolygon")
    shape = F.when(many, F.when(F.size("_cut") > 1, F.lit("MultiPolygon")).otherwise(F.lit("Polygon"))).otherwise(F.col("geom_type"))
    kept = kept.withColumns({"geom_type": shape, "parts": F.coalesce("_cut", "parts")}).drop("_cut")
    filled = OV.gap_features(gaps).withColumn("parts", C.delocalize_parts(F.col("parts"), region))
    filled = filled.withColumns({"source_no": F.lit(len(sources)), "seq": F.lit(len(sources)) * F.lit(SOURCE_STRIDE) + F.col("seq")})
    return FeaturePlan(kept.unionByName(filled, allowMissingColumns=True), rejected, duplicates, surfaces, gaps)


def clip_surfaces(polygons: DataFrame, region: Region) -> DataFrame:
    """Inventory polygons clipped to the region circle as surface features.

    Polygons inside the circle keep their geometry; straddling ones are cut.
    """
    local = polygons.withColumn("parts", C.localize_parts(F.col("parts"), region))
    cut = OV.clip_to_circle(local, radius=region.outer_radius_m, min_area=MIN_SURFACE_M2).drop("clipped")
    back = cut.withColumn("parts", C.delocalize_parts(F.col("parts"), region))
    return FT.supplemental_surfaces(back, region)


@dataclass(frozen=True)
class PointCloudPlan:
    """Tile pairing, classified cells, the cloud itself, counts and the alignment check."""

    tiles: DataFrame
    cells: DataFrame
    cloud: DataFrame
    counts: DataFrame
    tree_filter: DataFrame
    alignment: DataFrame


def plan_point_cloud(
    spark: SparkSession,
    *,
    dtm_path: str,
    dsm_path: str,
    footprints: DataFrame,
    region: Region,
    cellsize: float,
    canopy_pixels: DataFrame | None = None,
    canopy_size: tuple[int, int] | None = None,
    tags: DataFrame | None = None,
) -> PointCloudPlan:
    """Rasters and lon/lat footprints to a classified point cloud.

    Tiles that do not touch the region are pruned before their values are
    decoded. ``canopy_size`` is (width, height) of the overlay, stretched over
    the region's bounding box.
    """
    bbox = C.region_bbox_utm(region)
    dtm, dsm = RA.read_tiles(spark, dtm_path, "dtm"), RA.read_tiles(spark, dsm_path, "dsm")
    tiles = R.pair_tiles(dtm.where("error is null"), dsm.where("error is null"), bbox)
    used = tiles.where("status = 'used' and violation is null").select("tile")
    prune = lambda layer: layer.join(used, "tile", "left_semi")
    ground = RA.read_cells(spark, prune(dtm), dtm_path)
    surface = RA.read_cells(spark, prune(dsm), dsm_path)
    cells = R.pair_cells(ground, surface)
    polygons = S.polygon_rows(footprints.select("seq", C.project_parts(F.col("parts")).alias("parts")))
    canopy = None
    if canopy_pixels is not None:
        width, height = canopy_size or (1, 1)
        canopy = {"pixels": canopy_pixels, "bbox": bbox, "width": width, "height": height}
    classified = R.classify_cells(
        cells, polygons, bbox=bbox, relief_cells=R.relief_radius_cells(cellsize), canopy=canopy, tags=tags
    )
    classified = cut_lineage(classified)
    with_evidence = classified if canopy is not None else classified.withColumn("relief", F.lit(0.0))
    # Sampling order of the alignment check: tiles in name order, then rows and columns.
    tall = O.blocked_ordinal(
        classified.where("height >= 2"), block=["tile", "row"], within=["col"], out="seq"
    )
    return PointCloudPlan(
        tiles,
        classified,
        R.point_cloud(classified),
        R.class_counts(classified),
        R.tree_filter_counts(with_evidence),
        R.alignment(tall, polygons, order="seq"),
    )


@dataclass(frozen=True)
class TreePlan:
    instances: DataFrame
    rejected: DataFrame
    trunks: DataFrame
    crowns: DataFrame


def plan_trees(
    features: DataFrame,
    models: DataFrame,
    species_map: DataFrame,
    *,
    default_species: str = "Tilia",
    origin: tuple[float, float] = (0.0, 0.0),
    terrain: DataFrame | None = None,
) -> TreePlan:
    """Tree features (``seq, geom_type, parts, tags, roi_zone, osm_id`` and planned columns) to instances and meshes."""
    df = features.withColumn("_p", M.reference_point(F.col("geom_type"), F.col("parts"))).withColumns(
        {"lon": F.col("_p.x"), "lat": F.col("_p.y")}
    )
    df = O.ordinal(df.drop("_p"), order="seq", out="position").where("lon is not null")
    height = None
    if terrain is not None:
        lon, lat = F.col("lon"), F.col("lat")
        points = df.select("seq", (C.utm32_x(lon, lat) - origin[0]).alias("px"), (C.utm32_y(lon, lat) - origin[1]).alias("py"))
        sampled = TR.sample_terrain(points, terrain, key=["seq"], xy=("px", "py")).select("seq", "terrain_z", "terrain_status")
        df, height = df.join(sampled, "seq"), F.col("terrain_z")
    every = TE.tree_instances(df, models, species_map, default_species=default_species, terrain_z=height)
    every = cut_lineage(every)
    fine = F.col("model_error").isNull() & F.col("dimension_error").isNull() & F.col("z").isNotNull()
    good = every.where(fine)
    local = lambda mesh: MS.translate(mesh, F.lit(-origin[0]), F.lit(-origin[1]))
    keep = ["tree_id", "species"]
    return TreePlan(good, every.where(~fine), local(TE.trunk_mesh(good, keep)), local(TE.crown_mesh(good, keep)))


@dataclass(frozen=True)
class PurifierPlan:
    placements: DataFrame
    rejected: DataFrame
    mesh: DataFrame


def plan_purifiers(
    features: DataFrame,
    catalogue: DataFrame,
    meshes: DataFrame,
    *,
    origin: tuple[float, float] = (0.0, 0.0),
    terrain: DataFrame | None = None,
    terrain_name: str = "terrain",
) -> PurifierPlan:
    """Purifier points to placed towers (local frame)."""
    placed = PU.resolve(features, catalogue, origin=origin)
    if terrain is not None:
        placed = PU.place_on_terrain(placed, terrain, source=terrain_name)
    placed = cut_lineage(placed)
    good = placed.where(F.size("errors") == 0)
    ready = good.select(
        "purifier_id", "model", "scale_x", "scale_y", "scale_z", "rotation_deg",
        F.col("local_x").alias("to_x"), F.col("local_y").alias("to_y"), F.col("base_z").alias("to_z"),
    )
    return PurifierPlan(good, placed.where(F.size("errors") > 0), MS.place_meshes(ready, meshes))


@dataclass(frozen=True)
class CityModelPlan:
    layers: DataFrame
    layer_counts: DataFrame
    overlap_summary: DataFrame
    overlap_top: DataFrame
    buildings: DataFrame
    mesh: DataFrame


def plan_city_model(features: DataFrame, cloud: DataFrame, region: Region) -> CityModelPlan:
    """Surface layers, footprint quality, zonal heights and extruded buildings.

    ``features``: ``seq, category, source_tag, parts`` (lon/lat) and ``tags``;
    ``cloud``: ``x, y, z, class``.
    """
    metric = features.where(C.lonlat_in_range(F.col("parts"))).withColumn("parts", C.project_parts(F.col("parts")))
    metric = cut_lineage(metric)
    center = C.utm32_of(region.center_lon, region.center_lat)
    layers, counts = OV.surface_layers(metric.select("seq", "category", "parts"), region=region, center=center)
    footprints = metric.where("category = 'buildings'")
    check = OV.FootprintOverlaps(footprints.select("seq", "source_tag", "parts"))
    ground = R.cell_statistics(cloud.where("class = 'ground'"), z="z", how="min")
    roof = R.cell_statistics(cloud.where("class = 'building'"), z="z", how="max")
    tall = R.zonal_heights(
        S.polygon_rows(footprints.select("seq", "tags", "parts")), ground, roof, key=["seq", "polygon_no"],
        height=A.building_height([], F.col("tags")),
    )
    raised = MS.roof_raise(A.has_roof_shape(F.lit(None).cast("string"), F.col("tags")))
    # One building id per polygon part: parts of one feature may differ in height. The checkpoint fixes the numbers.
    buildings = tall.select(
        F.monotonically_increasing_id().alias("building"), "seq", "polygon_no", "base_z", "top_z",
        raised.alias("roof_raise"), F.array("polygon").alias("parts"),
    )
    buildings = cut_lineage(buildings)
    mesh = MS.extrude_buildings(buildings, ["building"], seq="building")
    return CityModelPlan(layers, counts, check.summary(), check.top(), buildings, mesh)


def region_features(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON features with the columns the plans need."""
    df = G.read_features(spark, path)
    return df.select(
        F.col("feature_index").alias("seq"),
        "geom_type",
        "parts",
        G.prop("category").alias("category"),
        G.prop("source_tag").alias("source_tag"),
        G.prop("roi_zone").alias("roi_zone"),
        G.prop("osm_id").alias("osm_id"),
        G.tags_of().alias("tags"),
    )

