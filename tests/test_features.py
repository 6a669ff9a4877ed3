"""Elements to features, attributes, planning points."""

import pytest
from pyspark.sql import functions as F

from geoloom.functions import attributes as A
from geoloom.functions import crs as C
from geoloom.operators import features as FT
from geoloom.operators import planning as PL
from geoloom.operators import quality as Q
from geoloom.operators import trees as TE
from geoloom.operators.classify import Rule, classify, tag_inventory
from geoloom.params import DEMO_REGION
from geoloom.schemas import ELEMENT

LON, LAT = DEMO_REGION.center_lon, DEMO_REGION.center_lat


def rect(w, s, e, n):
    return [{"lat": a, "lon": b} for a, b in ((s, w), (s, e), (n, e), (n, w), (s, w))]


def element(kind, id_, tags, **extra):
    row = {"type": kind, "id": id_, "tags": tags, "lat": None, "lon": None, "geometry": None, "nodes": None, "members": None}
    return {**row, **extra}


def frame(spark, rows):
    from pyspark.sql import types as T

    schema = T.StructType([*ELEMENT.fields, T.StructField("seq", T.LongType())])
    return spark.createDataFrame([tuple(r[f.name] for f in ELEMENT.fields) + (i,) for i, r in enumerate(rows)], schema)


def small(dx=0.0):
    return rect(LON + dx, LAT, LON + dx + 1e-4, LAT + 1e-4)


def test_elements_to_features(spark):
    line = [{"lat": LAT, "lon": LON}, {"lat": LAT + 1e-4, "lon": LON}]
    rows = [
        element("way", 1, {"building": "yes"}, geometry=small()),
        element("way", 2, {"highway": "primary"}, geometry=small()),
        element("node", 3, {"natural": "tree"}, lat=LAT, lon=LON),
        element("way", 4, {"shop": "bakery"}, geometry=small()),
        element("way", 5, None, geometry=small()),
        element("way", 6, {"building": "roof", "min_height": "3.5"}, geometry=rect(LON + 0.0029, LAT, LON + 0.006, LAT + 1e-4)),
        element("way", 7, {"building": "yes"}, geometry=small(1.0)),
        element("way", 8, {"building": "yes"}, geometry=line[:1]),
        element("node", 9, {"natural": "water"}),
        element("relation", 10, {"natural": "water"}, members=[
            {"type": "way", "role": "outer", "geometry": rect(LON, LAT, LON + 1e-3, LAT + 1e-3)[:3]},
            {"type": "way", "role": "outer", "geometry": rect(LON, LAT, LON + 1e-3, LAT + 1e-3)[2:][::-1]},
            {"type": "way", "role": "inner", "geometry": rect(LON + 2e-4, LAT + 2e-4, LON + 4e-4, LAT + 4e-4)},
        ]),
        element("relation", 11, {"highway": "pedestrian"}, members=[{"type": "way", "role": "outer", "geometry": small()}]),
        element(None, None, None),
    ]
    got = {r["osm_num"]: r for r in FT.elements_to_features(frame(spark, rows), DEMO_REGION).collect()}
    reasons = {k: r["skip_reason"] for k, r in got.items()}
    assert reasons == {
        1: None, 2: None, 3: None, 4: "unsupported_tags", 5: "missing_tags", 6: None, 7: "outside_roi_policy",
        8: "unsupported_or_incomplete_geometry", 9: "unsupported_or_incomplete_geometry", 10: None, 11: None, None: "invalid_element",
    }
    assert got[1]["geom_type"] == "Polygon" and got[1]["contributes_to_geometry"] and got[1]["include_in_lod22"]
    assert got[2]["geom_type"] == "LineString" and got[2]["geometry_role"] == "reference_only_non_contributing"
    assert got[6]["building_base_height_m"] == 3.5 and got[1]["building_base_height_m"] == 0.0
    # The long roof starts 230 m away: kept in the ring although its centroid is outside.
    assert got[6]["roi_zone"] == "annular" and got[6]["centroid_distance_m"] > 250
    assert got[10]["geom_type"] == "Polygon" and len(got[10]["parts"][0]) == 2
    assert got[11]["geom_type"] == "LineString"
    counts = {r["skip_reason"]: r["n"] for r in Q.skipped_by_reason(FT.elements_to_features(frame(spark, rows), DEMO_REGION)).collect()}
    assert counts["unsupported_or_incomplete_geometry"] == 2


def test_rule_order_and_key_wildcard(spark):
    rules = (Rule("water", "w", ("natural=water", "waterway")), Rule("other", "o", ("natural",)), Rule("late", "l", ("waterway=dock",)))
    df = spark.createDataFrame(
        [({"natural": "rock"},), ({"waterway": "dock", "natural": "rock"},), ({"name": "x"},), ({},), (None,)], "tags map<string,string>"
    )
    got = [r["c"] for r in df.select(classify(F.col("tags"), rules).alias("c")).collect()]
    assert [None if c is None else (c["category"], c["source_tag"]) for c in got] == [
        ("other", "natural=rock"), ("water", "waterway=dock"), None, None, None
    ]


def test_inventory_counts_untagged_elements(spark):
    df = frame(spark, [element("node", 1, {"shop": "x"}), element("way", 2, None), element(None, 3, {"building": "yes"})])
    got = {(r["metric"], r["key"]): r["n"] for r in tag_inventory(df).collect()}
    assert got[("element_type", "unknown")] == 1 and got[("tagged_elements", "all")] == 2
    assert got[("unclassified_feature_like_tag_value", "shop=x")] == 1
    assert got[("classified_source_tag", "building=yes")] == 1


def test_batches_last_value_first_position(spark):
    rows = [(0, 0, "node", 7, "old"), (0, 1, "way", 7, "a"), (1, 0, "node", 7, "new"), (1, 1, None, None, "junk")]
    df = spark.createDataFrame(rows, "batch int, pos int, type string, id bigint, value string")
    got = FT.merge_batches(df).orderBy("batch", "pos").collect()
    assert [(r["type"], r["value"], r["pos"]) for r in got] == [("node", "new", 0), ("way", "a", 1)]


def test_number_parsers_differ(spark):
    df = spark.createDataFrame([("30 cm",), ("45,5 cm",), ("0.45 m",), ("12 meters",), ("-",), ("1d",), (None,)], "v string")
    out = df.select(A.inventory_number(F.col("v")).alias("a"), A.tree_number(F.col("v")).alias("b")).collect()
    assert [r["a"] for r in out] == [30.0, 45.5, 0.45, 12.0, None, None, None]
    assert [r["b"] for r in out] == [None, None, 0.45, 12.0, None, None, None]


def test_slugs_and_collisions(spark):
    import hashlib

    names = ["Pinus pinea", "pinus-pinea", "Tilia", "!!!"]
    got = {r["species"]: r["slug"] for r in TE.unique_slugs(spark.createDataFrame([(n,) for n in names], "species string")).collect()}
    second = hashlib.sha256(b"pinus-pinea").hexdigest()[:8]
    assert got == {"Pinus pinea": "pinus_pinea", "pinus-pinea": f"pinus_pinea_{second}", "Tilia": "tilia", "!!!": "unknown_species"}


def test_projection_round_trip_and_known_point(spark):
    df = spark.createDataFrame([(9.0, 45.0), (11.2558, 43.7696)], "lon double, lat double")
    m = df.select(C.utm32_x(F.col("lon"), F.col("lat")).alias("x"), C.utm32_y(F.col("lon"), F.col("lat")).alias("y"), "lon", "lat")
    first = m.first()
    assert first["x"] == pytest.approx(500000.0) and first["y"] == pytest.approx(4982950.4, abs=0.1)
    back = C.with_geographic(m, "x", "y", C.UTM32, "blon", "blat").collect()
    for r in back:
        assert (r["blon"], r["blat"]) == (pytest.approx(r["lon"], abs=1e-8), pytest.approx(r["lat"], abs=1e-8))
    x, y = C.utm32_of(11.2558, 43.7696)
    assert (m.collect()[1]["x"], m.collect()[1]["y"]) == (pytest.approx(x, abs=1e-6), pytest.approx(y, abs=1e-6))


def test_planning_checks(spark):
    base = {"id": '"T-1"', "kind": '"tree"', "model": '"umbrella_pine"'}
    cases = {
        "fine": {**base, "height_m": "4"},
        "dup": {**base, "ID": '"x"'},
        "unsafe": {**base, "id": '"a b"'},
        "kind": {**base, "kind": '"bench"'},
        "negative": {**base, "height_m": "-1"},
        "text": {**base, "height_m": '"tall"'},
        "foreign": {**base, "rotation_deg": "3"},
        "unknown": {**base, "girth_m": "3"},
        "free": {**base, "street": '"x"'},
    }
    rows = [("in", "f", "EPSG:4326", i, "Point", LON, LAT, p) for i, p in enumerate(cases.values())]
    df = spark.createDataFrame(
        rows, "input_name string, source string, source_crs string, source_feature_index bigint, geom_type string, x double, y double, properties map<string,string>"
    )
    out = PL.normalize(df, DEMO_REGION).orderBy("source_feature_index").collect()
    bad = {name: bool(r["errors"]) for name, r in zip(cases, out)}
    assert bad == {"fine": False, "dup": True, "unsafe": True, "kind": True, "negative": True, "text": True, "foreign": True, "unknown": True, "free": False}
    assert out[0]["roi_zone"] == "inner" and out[0]["height_m"] == 4.0
