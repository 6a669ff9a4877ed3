"""Polygons from trapezoids: areas, holes, touching corners, clipped features."""

import math

import numpy as np
from pyspark.sql import functions as F

from geoloom.functions import measure as M
from geoloom.operators import overlay as OV
from geoloom.operators.rings import polygons


def box(x0, y0, x1, y1):
    return (y0, y1, x0, x0, x1, x1)


def area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def test_pieces_join_to_one_ring_without_inner_corners():
    (only,) = polygons(np.array([box(0, 0, 2, 1), box(0, 1, 1, 3), box(1, 1, 2, 3), box(2, 0, 5, 3)], float))
    assert len(only) == 1 and len(only[0]) == 5 and abs(area(only[0])) == 15


def test_hole_and_touching_corners():
    frame = [box(0, 0, 6, 1), box(0, 1, 1, 5), box(5, 1, 6, 5), box(0, 5, 6, 6)]
    (only,) = polygons(np.array(frame, float))
    assert len(only) == 2 and abs(area(only[0])) == 36 and abs(area(only[1])) == 16
    two = polygons(np.array([box(0, 0, 1, 1), box(1, 1, 2, 2)], float))
    assert sorted(abs(area(p[0])) for p in two) == [1, 1]


def test_small_pieces_are_dropped():
    assert len(polygons(np.array([box(0, 0, 1, 1), box(5, 5, 5.05, 5.1)], float), 0.01)) == 1


def rect(x0, y0, x1, y1):
    ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return [[[{"x": float(x), "y": float(y)} for x, y in ring]]]


def features(spark, rows):
    return spark.createDataFrame(
        [(k, 0, rect(*r)) for k, r in enumerate(rows)], "seq bigint, rank bigint, parts array<array<array<struct<x:double,y:double>>>>"
    )


def test_clipped_surfaces_return_what_is_left(spark):
    df = features(spark, [(0, 0, 10, 10), (5, 0, 15, 10), (3, 3, 4, 4), (100, 0, 400, 5), (200, -50, 210, 50)])
    out = {r["seq"]: r for r in OV.disjoint_surfaces(df).withColumn("shape", M.parts_area(F.col("parts"))).collect()}
    assert [out[k]["state"] for k in range(5)] == ["accepted", "clipped", "removed", "accepted", "clipped"]
    assert out[1]["parts"] == rect(10, 0, 15, 10) or len(out[1]["parts"][0][0]) == 5
    assert math.isclose(out[1]["shape"], 50.0) and math.isclose(out[1]["area_m2"], 50.0)
    assert len(out[4]["parts"]) == 2 and math.isclose(out[4]["shape"], 950.0)
    assert out[2]["parts"] is None


def test_slivers_of_a_clipped_feature_go_one_by_one(spark):
    slats = [(0, k * 0.1, 10, k * 0.1 + 0.0995) for k in range(20)]
    df = features(spark, [*slats, (2, 0, 3, 2.0)])
    last = OV.disjoint_surfaces(df).where("seq = 20").first()
    assert last["state"] == "removed" and math.isclose(last["removed_area_m2"], 2.0)


def test_circle_clip_returns_the_cut_polygon(spark):
    df = features(spark, [(-100, -100, 100, 100), (-5, -5, 5, 5), (200, 0, 300, 1)]).drop("rank")
    got = {r["seq"]: r for r in OV.clip_to_circle(df, radius=15.0, segments=64).collect()}
    assert set(got) == {0, 1} and got[0]["clipped"] and not got[1]["clipped"]
    want = 0.5 * 64 * math.sin(2 * math.pi / 64) * 15.0**2
    assert math.isclose(got[0]["area_m2"], want, rel_tol=1e-6) and len(got[0]["parts"]) == 1
    points = [p for r in got[0]["parts"][0] for p in r]
    assert len(points) >= 65 and all(math.hypot(p["x"], p["y"]) < 15.001 for p in points)
