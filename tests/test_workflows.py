"""End-to-end plans on small inputs."""

import json

import pytest
from pyspark.sql import functions as F
from test_features import element, frame, rect
from test_sources import asc, write

from geoloom.functions import crs as C
from geoloom.functions import measure as M
from geoloom.operators import purifiers as PU
from geoloom.params import DEMO_REGION, Region
from geoloom.plans import workflows as W
from geoloom.plans.catalog_instances import tower_meshes
from geoloom.plans.fixtures import purifier_catalogue, species_map, tree_models
from geoloom.streaming.enrich import enrich_points

LON, LAT = DEMO_REGION.center_lon, DEMO_REGION.center_lat
ATTRS = "map<string,string>"


def test_feature_plan(spark):
    rows = [
        element("way", 1, {"building": "yes"}, geometry=rect(LON, LAT, LON + 4e-4, LAT + 4e-4)),
        element("way", 2, {"natural": "water"}, geometry=rect(LON, LAT, LON + 8e-4, LAT + 4e-4)),
        element("way", 3, {"landuse": "grass"}, geometry=rect(LON + 1e-4, LAT + 1e-4, LON + 2e-4, LAT + 2e-4)),
        element("node", 4, {"natural": "tree"}, lat=LAT - 1e-3, lon=LON),
        element("node", 5, {"natural": "tree"}, lat=LAT - 1e-3, lon=LON + 1e-3),
        element("way", 6, {"shop": "x"}, geometry=rect(LON, LAT, LON + 1e-4, LAT + 1e-4)),
    ]
    trees = spark.createDataFrame(
        [(1, LON, LAT - 1e-3, "inv", 7, 1, "inventory", {"SPECIE": "Tilia", "DBH": "45"})],
        f"seq bigint, lon double, lat double, stem string, record_number bigint, point_index bigint, input_name string, attrs {ATTRS}",
    )
    big = [[[{"x": x, "y": y} for x, y in ((LON - 1e-3, LAT - 5e-3), (LON - 5e-4, LAT - 5e-3), (LON - 5e-4, LAT + 5e-3), (LON - 1e-3, LAT + 5e-3), (LON - 1e-3, LAT - 5e-3))]]]
    surfaces = spark.createDataFrame(
        [(1, "st", 1, 1, "streets", "roads", "street_area", big, {"A": "1"})],
        "seq bigint, stem string, record_number bigint, polygon_index bigint, input_name string, category string, group_tag string, "
        f"parts array<array<array<struct<x:double,y:double>>>>, attrs {ATTRS}",
    )
    plan = W.plan_features(frame(spark, rows), DEMO_REGION, tree_points=trees, surface_polygons=surfaces)
    shaped = plan.features.withColumn("local_area", M.parts_area(C.localize_parts(F.col("parts"), DEMO_REGION)))
    every = {r["osm_id"]: r for r in shaped.collect()}
    got = {k: r for k, r in every.items() if r["osm_type"] != "generated"}
    assert set(got) == {"1", "2", "5", "inv_7", "st_1"}
    # Areas belong to the polygons that come with them, and the gaps are features too.
    assert got["2"]["local_area"] == pytest.approx(got["2"]["area_m2"], rel=1e-6) and got["2"]["geom_type"] == "Polygon"
    gaps = [r for k, r in every.items() if k not in got]
    assert {r["osm_id"] for r in gaps} == {f"gap_fill_{k + 1}" for k in range(len(gaps))} and len(gaps) == plan.gaps.count() > 0
    assert all(r["local_area"] == pytest.approx(r["area_m2"], rel=1e-4) and r["category"] == "gap_fill" for r in gaps)
    assert got["2"]["state"] == "clipped" and got["1"]["state"] == "accepted"
    assert got["inv_7"]["tags"]["diameter"] == "0.45" and got["st_1"]["geometry_role"] == "polygon_surface"
    assert [r["skip_reason"] for r in plan.rejected.collect()] == ["unsupported_tags"]
    assert plan.duplicate_trees.count() == 1
    state = {r["seq"]: r["state"] for r in plan.surfaces.collect()}
    assert state[2] == "removed"  # the lawn lies under the building
    free = plan.gaps.agg(F.sum("area_m2")).first()[0]
    covered = plan.surfaces.agg(F.sum("area_m2")).first()[0]
    disc = 128 * __import__("math").sin(2 * 3.141592653589793 / 256) * 250**2
    assert free + covered == pytest.approx(disc, rel=1e-7)


def test_point_cloud_and_city_model(spark, tmp_path):
    region = Region(LON, LAT, 60.0, 30.0)
    cx, cy = C.utm32_of(LON, LAT)
    corner = f"xllcorner {cx - 10}\nyllcorner {cy - 10}"
    flat, raised = [[10.0] * 10 for _ in range(10)], [[10.0] * 10 for _ in range(10)]
    for r in range(2, 8):
        for c in range(2, 8):
            raised[r][c] = 16.0
    write(tmp_path / "dtm" / "a.asc", asc(flat, corner))
    write(tmp_path / "dsm" / "a.asc", asc(raised, corner))
    # A footprint over the raised block, back-projected to degrees.
    local = [(cx - 6, cy - 6), (cx + 6, cy - 6), (cx + 6, cy + 6), (cx - 6, cy + 6), (cx - 6, cy - 6)]
    pts = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(local)], "i int, x double, y double")
    ring = [[r["lon"], r["lat"]] for r in C.with_geographic(pts, "x", "y", C.UTM32).orderBy("i").collect()]
    feature = {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]},
               "properties": {"category": "buildings", "source_tag": "building=yes", "tags": {"building": "yes", "roof:shape": "gabled"}}}
    path = write(tmp_path / "f.geojson", json.dumps({"type": "FeatureCollection", "features": [feature]}))
    features = W.region_features(spark, path)
    plan = W.plan_point_cloud(
        spark, dtm_path=str(tmp_path / "dtm"), dsm_path=str(tmp_path / "dsm"), footprints=features, region=region, cellsize=2.0
    )
    counts = plan.counts.first()
    assert (counts["ground_points"], counts["building_points"], counts["unclassified_points"]) == (100, 36, 64)
    assert plan.alignment.first()["status"] == "passed"
    model = W.plan_city_model(features, plan.cloud, region)
    building = model.buildings.first()
    assert (building["base_z"], building["top_z"], building["roof_raise"]) == (10.0, 16.0, 1.5)
    assert model.overlap_summary.first()["overlap_status"] == "passed"
    surfaces = {r["surface"]: r["count"] for r in model.mesh.groupBy("surface").count().collect()}
    assert surfaces["wall"] == 8 and surfaces["raised_roof"] == 4 and surfaces["roof"] >= 2


def test_tree_and_purifier_plans(spark):
    cx, cy = C.utm32_of(LON, LAT)
    cols = ", ".join(f"{c} double" for c in ("ax", "ay", "az", "bx", "by", "bz", "cx", "cy", "cz"))
    mesh = spark.createDataFrame(
        [(-50.0, -50.0, 3.0, 50.0, -50.0, 3.0, 50.0, 50.0, 3.0), (-50.0, -50.0, 3.0, 50.0, 50.0, 3.0, -50.0, 50.0, 3.0)], cols
    )
    trees = spark.createDataFrame(
        [(1, LON, LAT, {"species": "Tilia"}), (2, LON + 0.1, LAT, {}), (3, LON, LAT, {"species": "Nonsense"})],
        f"seq bigint, lon double, lat double, tags {ATTRS}",
    ).select(
        "seq", F.lit("Point").alias("geom_type"), M.point_parts(F.col("lon"), F.col("lat")).alias("parts"), "tags",
        F.lit("inner").alias("roi_zone"), F.col("seq").cast("string").alias("osm_id"),
    )
    plan = W.plan_trees(trees, tree_models(spark), species_map(spark), origin=(cx, cy), terrain=mesh)
    only = plan.instances.collect()
    assert [r["tree_id"] for r in only] == ["tree_0001"] and only[0]["z"] == pytest.approx(2.95)
    assert sorted(r["seq"] for r in plan.rejected.collect()) == [2, 3]
    assert plan.trunks.count() == 56 and plan.crowns.count() == 256

    row = ("P-1", "compact_octagonal_tower", 8.0, None, None, 90.0, LON, LAT, "in", "inner", "f", "EPSG:4326", 0, "{}")
    purifiers = spark.createDataFrame(
        [row, ("P-2", *row[1:6], LON + 0.1, *row[7:])],
        "purifier_id string, model string, height_m double, width_m double, depth_m double, rotation_deg double, lon double, lat double, "
        "urban_planning_input_id string, roi_zone string, source string, source_crs string, source_feature_index bigint, source_properties string",
    )
    out = W.plan_purifiers(purifiers, PU.catalogue_dimension(purifier_catalogue(spark)), tower_meshes(spark), origin=(cx, cy), terrain=mesh)
    placed = out.placements.first()
    assert placed["purifier_id"] == "P-1" and placed["base_z"] == pytest.approx(2.95) and placed["scale_z"] == 2.0
    assert [r["purifier_id"] for r in out.rejected.collect()] == ["P-2"]
    top = out.mesh.agg(F.max(F.greatest("az", "bz", "cz"))).first()[0]
    assert top == pytest.approx(10.95)


def test_enrichment_accepts_a_stream(spark, tmp_path):
    rows = [({"natural": "tree"}, LON, LAT), ({"shop": "x"}, LON, LAT), ({"building": "yes"}, LON + 1, LAT)]
    df = spark.createDataFrame(rows, f"tags {ATTRS}, lon double, lat double")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = (
        enrich_points(stream, DEMO_REGION).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    got = sorted((r["category"], r["roi_zone"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("buildings", "outside"), ("trees", "inner")]
