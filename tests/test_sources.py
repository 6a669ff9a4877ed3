"""Readers and writers on files written by the tests."""

import json
import math
import struct
import zlib

from pyspark.sql import functions as F

from geoloom.functions import measure as M
from geoloom.operators import features as FT
from geoloom.operators import mesh as MS
from geoloom.operators import ordering as O
from geoloom.operators import purifiers as PU
from geoloom.operators import raster as R
from geoloom.operators import terrain as TR
from geoloom.operators import trees as TE
from geoloom.plans.fixtures import species_map, tree_models
from geoloom.sources import geojson as G
from geoloom.sources import meshes as ME
from geoloom.sources import rasters as RA
from geoloom.sources import shapefile as SH
from geoloom.sources import sinks as K


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_extract_scan(spark, tmp_path):
    good = {"version": 1, "elements": [{"type": "node", "id": 1, "lat": 1.5, "lon": 2.5, "tags": {"natural": "tree"}}, "junk"]}
    write(tmp_path / "a.json", json.dumps(good, indent=1))
    write(tmp_path / "b.json", json.dumps({"nope": []}))
    rows = G.read_elements(spark, str(tmp_path)).collect()
    assert [r["id"] for r in rows if r["type"]] == [1]
    broken = [r["source"] for r in G.broken_extracts(spark, str(tmp_path)).collect()]
    assert any(p.endswith("b.json") for p in broken)


def feature(geometry_, coordinates_, **properties):
    return {"type": "Feature", "geometry": {"type": geometry_, "coordinates": coordinates_}, "properties": properties}


RING = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
HOLE = [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]


def test_geojson_scan_and_round_trip(spark, tmp_path):
    features = [
        feature("Polygon", [RING, HOLE], category="buildings", roi_zone="inner"),
        feature("MultiPolygon", [[RING], [[[9, 9], [10, 9], [10, 10], [9, 9]]]], category="water", roi_zone="annular",
                include_in_building_lod22_reconstruction=False),
        feature("Point", [1.5, 2.5], category="trees", roi_zone="inner", tags={"natural": "tree"}),
        feature("LineString", [[0, 0], [3, 4]], category="roads", roi_zone="inner"),
        {"type": "Feature", "geometry": None, "properties": {}},
    ]
    path = write(tmp_path / "in" / "c.geojson", json.dumps({"type": "FeatureCollection", "features": features}, indent=2))
    df = G.read_features(spark, path)
    rows = {r["geom_type"]: r for r in df.withColumn("area", M.parts_area(F.col("parts"))).collect()}
    assert len(rows) == 4
    assert rows["Polygon"]["area"] == 15.0 and rows["MultiPolygon"]["area"] == 16.5
    assert rows["Point"]["parts"][0][0][0].asDict() == {"x": 1.5, "y": 2.5}
    assert [r["geom_type"] for r in G.read_footprints(spark, path).collect()] == ["Polygon"]
    assert G.read_polygons(spark, path).count() == 2
    assert G.read_tree_tag_points(spark, path).count() == 1

    out = str(tmp_path / "out")
    exported = df.withColumns({"category": G.prop("category"), "roi_zone": G.prop("roi_zone")}).drop("properties", "source")
    K.write_geojson(exported, out, crs="EPSG:4326", partition_by=["category"])
    lines = [json.loads(r["value"]) for r in spark.read.text(out).collect()]
    assert sorted(x["geometry"]["type"] for x in lines) == ["LineString", "MultiPolygon", "Point", "Polygon"]
    polygon = next(x for x in lines if x["geometry"]["type"] == "Polygon")
    assert polygon["geometry"]["coordinates"] == [RING, HOLE] and polygon["properties"]["category"] == "buildings"
    K.write_features(exported, str(tmp_path / "pq"))
    assert spark.read.parquet(str(tmp_path / "pq")).where("category = 'water' and roi_zone = 'annular'").count() == 1


def test_mask_scan_defaults(spark, tmp_path):
    path = write(
        tmp_path / "m.geojson",
        json.dumps({"type": "FeatureCollection", "features": [feature("Polygon", [RING], label="Road", score=0.5), feature("Polygon", [RING], confidence=True)]}),
    )
    rows = G.read_masks(spark, path).orderBy("seq").collect()
    assert [(r["raw_class"], r["confidence"]) for r in rows] == [("Road", 0.5), (None, None)]
    outside = G.read_masks(spark, path, external_buildings=True).collect()
    assert {r["raw_class"] for r in outside} == {"building_footprint"}
    bad = write(tmp_path / "bad.geojson", json.dumps({"type": "Thing", "features": []}))
    assert G.broken_collections(spark, bad).first()["error"] == "not a FeatureCollection"


def test_planning_scan(spark, tmp_path):
    props = {"id": "A-1", "kind": "tree", "model": "palm_tuft", "height_m": 4, "street": "x: \"y\""}
    a = write(tmp_path / "a.geojson", json.dumps({"type": "FeatureCollection", "features": [feature("Point", [11.0, 43.0], **props)]}))
    b = write(tmp_path / "b.geojson", json.dumps({"type": "FeatureCollection", "features": [feature("Point", [1, 2, 3], **props)]}))
    inputs = spark.createDataFrame(
        [("one", "a.geojson", "EPSG:4326", True), ("two", "b.geojson", "EPSG:3857", True), ("off", "c.geojson", "EPSG:4326", False)],
        "name string, file_name string, crs string, enabled boolean",
    )
    rows = {r["input_name"]: r for r in G.read_planning_points(spark, inputs, [a, b]).collect()}
    assert rows["one"]["x"] == 11.0 and rows["two"]["x"] is None
    assert rows["one"]["properties"]["id"] == '"A-1"' and rows["one"]["properties"]["height_m"] == "4"


def shapefile(kind, records):
    body = b"".join(struct.pack(">2i", i + 1, len(r) // 2) + r for i, r in enumerate(records))
    head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2) + struct.pack("<2i", 1000, kind) + b"\x00" * 64
    return head + body


def polygon_record(rings):
    points = [p for r in rings for p in r]
    starts, at = [], 0
    for r in rings:
        starts.append(at)
        at += len(r)
    return (
        struct.pack("<i4d2i", 5, 0, 0, 1, 1, len(rings), len(points))
        + struct.pack(f"<{len(starts)}i", *starts)
        + b"".join(struct.pack("<2d", *p) for p in points)
    )


def dbf(fields, rows):
    width = 1 + sum(n for _, _, n, _ in fields)
    head = struct.pack("<B3xIHH20x", 3, len(rows), 32 + 32 * len(fields) + 1, width)
    for name, kind, n, dec in fields:
        head += name.encode().ljust(11, b"\x00") + kind.encode() + b"\x00" * 4 + bytes([n, dec]) + b"\x00" * 14
    cell = lambda v, f: v.encode("latin-1").ljust(f[2])
    body = b"".join(r[0].encode() + b"".join(cell(v, f) for v, f in zip(r[1:], fields)) for r in rows)
    return head + b"\x0d" + body


def test_polygon_shapefile_with_attributes(spark, tmp_path):
    square = lambda lo, hi: [(lo, lo), (lo, hi), (hi, hi), (hi, lo), (lo, lo)]
    records = [polygon_record([square(0, 10), square(2, 8), square(4, 6)]), struct.pack("<i", 0), polygon_record([square(0, 3)])]
    (tmp_path / "s.shp").write_bytes(shapefile(5, records))
    (tmp_path / "s.dbf").write_bytes(
        dbf([("NAME", "C", 8, 0), ("N", "N", 6, 0), ("W", "N", 6, 1), ("L", "L", 1, 0)],
            [(" ", "caffè", "12", "1,5", "Y"), ("*", "gone", "1", "1", "N"), (" ", "x", "", "?", "N")])
    )
    shapes = SH.read_polygons(spark, str(tmp_path))
    rows = {r["record_number"]: r for r in shapes.withColumn("area", M.parts_area(F.col("parts"))).collect()}
    assert [len(p) for p in rows[1]["parts"]] == [2, 1] and rows[1]["area"] == 100 - 36 + 4
    assert rows[2]["parts"] == [] and rows[3]["area"] == 9.0
    attrs = {r["shape_index"]: r for r in SH.read_attributes(spark, str(tmp_path)).collect()}
    assert attrs[0]["attrs"] == {"NAME": "caffè", "N": "12", "W": "1.5", "L": "true"}
    assert attrs[1]["deleted"] and attrs[2]["attrs"] == {"NAME": "x", "W": "?", "L": "false"}
    paired = FT.positional_attributes(shapes, SH.read_attributes(spark, str(tmp_path)).drop("error"))
    assert sorted(r["record_number"] for r in paired.collect()) == [1, 3]


def test_point_shapefile_and_damage(spark, tmp_path):
    point = struct.pack("<i2d", 1, 3.0, 4.0)
    multi = struct.pack("<i4di", 8, 0, 0, 1, 1, 2) + struct.pack("<4d", 1.0, 2.0, 5.0, 6.0)
    (tmp_path / "p.shp").write_bytes(shapefile(1, [point, multi, struct.pack("<i", 0)]))
    (tmp_path / "t.shp").write_bytes(shapefile(1, [point])[:-4])
    (tmp_path / "bad.shp").write_bytes(b"x" * 50)
    rows = SH.read_points(spark, str(tmp_path)).collect()
    good = [(r["record_number"], r["point_index"], r["x"], r["y"]) for r in rows if r["file"].endswith("/p") and not r["is_null"]]
    assert sorted(good) == [(1, 1, 3.0, 4.0), (2, 1, 1.0, 2.0), (2, 2, 5.0, 6.0)]
    assert [r["record_number"] for r in rows if r["is_null"]] == [3]
    errors = {r["file"].rsplit("/", 1)[-1]: r["error"] for r in rows if r["error"]}
    assert errors == {"t": "truncated file", "bad": "file is too small for a header"}


def asc(values, corner="xllcorner 0\nyllcorner 0"):
    head = f"ncols {len(values[0])}\nnrows {len(values)}\n{corner}\ncellsize 2\nNODATA_value -9999\n"
    return head + "\n".join(" ".join(str(v) for v in row) for row in values) + "\n"


def test_grid_scan_pairing_and_pruning(spark, tmp_path):
    write(tmp_path / "dtm" / "sub" / "A.asc", asc([[1, 2], [3, -9999]]))
    write(tmp_path / "dtm" / "B.ASC", asc([[1, 2], [3, 4]], "xllcenter 101\nyllcenter 1"))
    write(tmp_path / "dsm" / "A.asc", asc([[9, 8], [7, 6]]))
    dtm, dsm = (RA.read_tiles(spark, str(tmp_path / d), d) for d in ("dtm", "dsm"))
    tiles = {r["tile"]: r for r in dtm.collect()}
    assert tiles["B.ASC"]["xll"] == 100.0 and tiles["A.asc"]["error"] is None
    pairs = {r["tile"]: (r["status"], r["violation"]) for r in R.pair_tiles(dtm, dsm, (0, 0, 50, 50)).collect()}
    assert pairs == {"A.asc": ("used", None), "B.ASC": ("only_dtm", None)}
    assert R.pair_tiles(dtm, dsm, (0, 0, 150, 50)).where("violation = 'unmatched_dtm'").count() == 1
    cells = RA.read_cells(spark, dtm.where("tile = 'A.asc'"), str(tmp_path / "dtm"))
    got = {(r["row"], r["col"]): (r["x"], r["y"], r["z"]) for r in cells.collect()}
    assert got == {(0, 0): (1.0, 3.0, 1.0), (0, 1): (3.0, 3.0, 2.0), (1, 0): (1.0, 1.0, 3.0), (1, 1): (3.0, 1.0, None)}
    write(tmp_path / "bad" / "C.asc", asc([[1, 2], [3, 4]]).replace("3 4", "3"))
    bad = RA.read_tiles(spark, str(tmp_path / "bad"), "dtm")
    assert RA.bad_rows(spark, bad, str(tmp_path / "bad")).first()["row"] == 1
    write(tmp_path / "dup" / "x" / "D.asc", asc([[1]]))
    write(tmp_path / "dup" / "y" / "d.ASC", asc([[1]]))
    assert RA.duplicate_tiles(RA.read_tiles(spark, str(tmp_path / "dup"), "dtm")).first()["uses"] == 2
    write(tmp_path / "nohead" / "E.asc", "1 2\n3 4\n")
    assert RA.read_tiles(spark, str(tmp_path / "nohead"), "dtm").first()["error"].startswith("missing header keys")


def png(width, height, rgba):
    chunk = lambda tag, data: struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))
    raw = b"".join(b"\x00" + bytes(rgba) * width for _ in range(height))
    return (
        b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 6, 0, 0, 0))
        + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    )


def test_canopy_image(spark, tmp_path):
    (tmp_path / "c.png").write_bytes(png(3, 2, (10, 200, 30, 255)))
    rows = RA.read_pixels(spark, str(tmp_path)).collect()
    assert len(rows) == 6 and {(r["r"], r["g"], r["b"], r["a"]) for r in rows} == {(10, 200, 30, 255)}
    assert {(r["row"], r["col"]) for r in rows} == {(i, j) for i in range(2) for j in range(3)}


OBJ = "# t\nv 0 0 0\nv 2 0 0\nv 2 2 1\nv 0 2 1\nf 1/1/1 2/2/2 3/3/3 4\nv 5 5 5\nf -1 1 2\n"


def test_obj_and_ply(spark, tmp_path):
    path = write(tmp_path / "m.obj", OBJ)
    tris = ME.read_obj(spark, path).orderBy("tri_no").collect()
    assert [(r["ax"], r["bx"], r["cx"], r["cy"]) for r in tris] == [(0.0, 2.0, 2.0, 2.0), (0.0, 2.0, 0.0, 2.0), (5.0, 0.0, 2.0, 0.0)]
    bad = write(tmp_path / "b.obj", "v 0 0 0\nf 1 2 3\n")
    assert ME.bad_obj_faces(spark, bad).count() == 1
    ply = write(tmp_path / "p.ply", "ply\nformat ascii 1.0\nelement vertex 2\nproperty double x\nend_header\n1 2 3\n4.5 5 6\n")
    assert sorted(tuple(r) [1:] for r in RA.read_ply(spark, ply).collect()) == [(1.0, 2.0, 3.0), (4.5, 5.0, 6.0)]


def test_stl_write_read_and_checks(spark, tmp_path):
    rows = [("inlet", 1, *[float(v) for v in (0, 0, 0, 1, 0, 0, 0, 1, 0)]), ("tower", 2, *[float(v) for v in (0, 0, 1, 1, 0, 1, 0, 1, 1)])]
    cols = ", ".join(f"{c} double" for c in ("ax", "ay", "az", "bx", "by", "bz", "cx", "cy", "cz"))
    mesh = spark.createDataFrame(rows, f"region string, tri_no bigint, {cols}")
    K.write_stl(mesh, str(tmp_path / "out"), "region", decimals=9)
    files = sorted((tmp_path / "out").rglob("part-*"), key=lambda p: (p.parent.name, p.name))
    text = "\n".join(f.read_text().rstrip("\n") for f in files)
    path = write(tmp_path / "all.stl", text + "\n")
    back = ME.read_stl(spark, path)
    assert sorted((r["region"], r["bx"], r["cz"]) for r in back.collect()) == [("inlet", 1.0, 0.0), ("tower", 1.0, 1.0)]
    assert ME.stl_errors(spark, path).count() == 0
    broken = write(tmp_path / "broken.stl", text.replace("    endloop\n", "", 1).replace("endsolid tower", "endsolid x"))
    assert {r["error"].split()[0] for r in ME.stl_errors(spark, broken).collect()} == {"malformed", "unbalanced"}


def test_ply_text(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0, 3.12345, "ground"), (4.0, 5.0, 6.0, "ground")], "x double, y double, z double, class string")
    K.write_ply(df, str(tmp_path / "ply"))
    head = [r["value"] for r in spark.read.text(str(tmp_path / "ply" / "class=ground" / "part=0")).collect()]
    assert head[0] == "ply" and head[2] == "element vertex 2" and head[-1] == "end_header"
    assert {r["value"] for r in spark.read.text(str(tmp_path / "ply" / "class=ground" / "part=1")).collect()} == {"1.000 2.000 3.123", "4.000 5.000 6.000"}


def test_combined_obj(spark, tmp_path):
    vertices = spark.createDataFrame(
        [("terrain", i, float(i), 0.0, 0.0) for i in (1, 2, 3)] + [("water", i, float(i), 1.0, 0.0) for i in (1, 2, 3)],
        "label string, v int, x double, y double, z double",
    )
    faces = spark.createDataFrame([("terrain", 1, [1, 2, 3]), ("water", 1, [3, 2, 1])], "label string, face_no int, refs array<int>")
    sources = spark.createDataFrame([("terrain", 0), ("water", 1)], "label string, source_no int")
    lines = K.combined_obj_lines(vertices, faces, sources)
    K.write_ordered_text(lines, str(tmp_path / "obj"), ["source_no", "part", "n"])
    text = [line for f in sorted((tmp_path / "obj").glob("part-*")) for line in f.read_text().splitlines()]
    assert text[0] == "g terrain" and text[4] == "f 1 2 3" and text[-1] == "f 6 5 4"


def test_dimensions_and_catalogue(spark, tmp_path):
    models = {"models": [
        {"name": "Oak", "aliases": ["OAK tree", "oak"], "default_height_m": 9, "default_crown_radius_m": 3, "default_trunk_radius_m": 0.2, "crown_base_fraction": 0.3},
        {"name": "Bad", "aliases": [], "default_height_m": -1, "default_crown_radius_m": 3, "default_trunk_radius_m": 0.2, "crown_base_fraction": 1.5},
    ]}
    rows = {r["name"]: r for r in G.read_tree_models(spark, write(tmp_path / "t.json", json.dumps(models))).collect()}
    assert rows["Oak"]["aliases"] == ["oak", "oak tree"] and rows["Oak"]["crown_shape"] == "ellipsoid"
    assert rows["Oak"]["error"] is None and rows["Bad"]["error"] == "invalid default_height_m"
    mapping = write(tmp_path / "s.json", json.dumps({"species_to_category": {"Quercus 'x'": "Oak", "unknown": "Oak", "a": ""}}))
    assert [r["norm"] for r in TE.species_dimension(G.read_species_map(spark, mapping)).collect()] == ["quercus x"]
    catalogue = {"schema_version": 1, "models": [
        {"name": "a", "kind": "octagonal", "output_path": "a.stl", "height_m": 4, "base_width_m": 1.5, "linear_tolerance_m": 0.01},
        {"name": "b", "kind": "round", "output_path": "b.stl", "height_m": 4, "linear_tolerance_m": 0.01},
    ]}
    cat = PU.catalogue_dimension(G.read_purifier_catalogue(spark, write(tmp_path / "p.json", json.dumps(catalogue))))
    got = {r["model"]: (r["native_width_m"], r["error"]) for r in cat.collect()}
    assert got == {"a": (1.5, None), "b": (None, "unknown kind")}
    assert {r["model"] for r in G.read_model_names(spark, str(tmp_path / "p.json"), "air_purifier").collect()} == {"a", "b"}


def test_terrain_hole_falls_back_to_nearest(spark, tmp_path):
    # Two plates with a gap between them: the left one at z = 11, the right one at z = 3.
    def quad(x0, y0, x1, y1, z):
        return [(x0, y0, z, x1, y0, z, x1, y1, z), (x0, y0, z, x1, y1, z, x0, y1, z)]

    rows = quad(-3, 1, 2, 9, 11) + quad(5, 1, 12, 9, 3)
    cols = ", ".join(f"{c} double" for c in ("ax", "ay", "az", "bx", "by", "bz", "cx", "cy", "cz"))
    mesh = spark.createDataFrame([tuple(float(v) for v in r) for r in rows], cols)
    points = spark.createDataFrame([(1, 0.5, 4.0), (2, 2.75, 6.0), (3, 4.25, 6.0), (4, -40.0, 6.0), (5, 12.0, 9.0)], "id int, x double, y double")
    got = {r["id"]: (r["terrain_z"], r["terrain_status"]) for r in TR.sample_terrain(points, mesh, key=["id"], cell=0.5).collect()}
    assert got == {1: (11.0, "hit"), 2: (11.0, "nearest"), 3: (3.0, "nearest"), 4: (None, "outside"), 5: (3.0, "hit")}
    # More doublings than a fixed number of levels would allow.
    wide = spark.createDataFrame([tuple(float(v) for v in r) for r in quad(0, 0, 1, 1, 1) + quad(200_000, 0, 200_001, 1, 2)], cols)
    middle = spark.createDataFrame([(1, 90_000.0, 0.5)], "id int, x double, y double")
    far = TR.sample_terrain(middle, wide, key=["id"], cell=0.5).collect()
    assert [(r["terrain_z"], r["terrain_status"]) for r in far] == [(1.0, "nearest")]


def test_tree_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, 11.0, 43.0, {"species": "Tilia", "height": "12 m"}), (2, 11.1, 43.0, {})], "seq bigint, lon double, lat double, tags map<string,string>")
    df = O.ordinal(df, order="seq", out="position").withColumns({"osm_id": F.col("seq").cast("string"), "roi_zone": F.lit("inner")})
    trees = TE.tree_instances(df, tree_models(spark), species_map(spark))
    placed = K.tree_placements(trees).orderBy("tree_id").collect()
    assert [r["tree_id"] for r in placed] == ["tree_0001", "tree_0002"] and placed[0]["height_source"] == "tag:height"
    assert K.tree_information(trees).count() == 2
    trunk, crown = TE.trunk_mesh(trees), TE.crown_mesh(trees)
    assert trunk.groupBy("tree_id").count().first()["count"] == 56
    assert crown.groupBy("tree_id").count().first()["count"] == 256
    quality = MS.mesh_quality(MS.translate(trunk, F.lit(0.0), F.lit(0.0)), ["tree_id"]).first()
    assert quality["closed_manifold"]
    assert math.isclose(trees.where("tree_id = 'tree_0001'").first()["trunk_height_m"], 12 * 0.34)


def test_missing_mesh_bounds_are_reported(spark):
    cols = ", ".join(f"{c} double" for c in ("ax", "ay", "az", "bx", "by", "bz", "cx", "cy", "cz"))
    mesh = spark.createDataFrame([("a", -0.75, -0.75, 0.0, 0.75, 0.75, 4.0, 0.0, 0.0, 1.0)], f"model string, {cols}")
    cat = spark.createDataFrame(
        [("a", "octagonal", "a.stl", 4.0, 1.5, 1.5, 0.002), ("b", "octagonal", "b.stl", 4.0, 1.5, 1.5, 0.002)],
        "model string, kind string, output_path string, native_height_m double, native_width_m double, native_depth_m double, linear_tolerance_m double",
    )
    assert {r["model"]: r["bounds_ok"] for r in PU.check_mesh_bounds(cat, mesh).collect()} == {"a": True, "b": False}




def test_elements_of_several_files_have_one_total_order(spark, tmp_path):
    for name, ids in (("b.json", [5, 6]), ("a.json", [7, 8, 9])):
        write(tmp_path / name, json.dumps({"elements": [{"type": "node", "id": i, "lat": 1.0, "lon": 2.0} for i in ids]}))
    rows = G.read_elements(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r["seq"], r["id"]) for r in rows] == [(1, 7), (2, 8), (3, 9), (4, 5), (5, 6)]


def test_imagery_regions_and_mask_images(spark):
    from geoloom.functions import attributes as A
    from geoloom.operators import review as RV

    images = spark.createDataFrame([("fetched", "a.png"), ("fetched", None), ("failed", "b.png")], "status string, image_path string")
    assert [r["image_path"] for r in RV.available_imagery(images).collect()] == ["a.png"]
    picked = spark.createDataFrame([("own.png",), ("",), (None,)], "source_image string").select(
        A.source_image([F.col("source_image")], F.lit("fallback.png")).alias("i"), A.source_image([], F.lit(None).cast("string")).alias("u")
    )
    assert [tuple(r) for r in picked.collect()] == [("own.png", "unknown"), ("fallback.png", "unknown"), ("fallback.png", "unknown")]
    cols = ", ".join(f"{c} double" for c in ("ax", "ay", "az", "bx", "by", "bz", "cx", "cy", "cz"))
    triangles = spark.createDataFrame([("tower", *[3.0] * 9), ("inlet", *[2.0] * 9), ("tower", *[1.0] * 9)], f"region string, {cols}")
    assert [(r["region"], r["ax"]) for r in MS.region_order(triangles).collect()] == [("inlet", 2.0), ("tower", 1.0), ("tower", 3.0)]
