"""Raster operators on small grids with known answers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.functions import measure as M
from geoloom.operators import ordering as O
from geoloom.operators import raster as R
from geoloom.operators import spatial as S


def grid(spark, ground, surface, x0=0.0, y0=0.0, cell=2.0):
    n = len(surface)
    rows = [
        ("t", r, c, x0 + (c + 0.5) * cell, y0 + (n - r - 0.5) * cell, ground[r][c], surface[r][c])
        for r in range(n)
        for c in range(len(surface[r]))
    ]
    return spark.createDataFrame(rows, "tile string, row int, col int, x double, y double, ground_z double, surface_z double")


def footprint(spark, x0, y0, x1, y1):
    df = spark.createDataFrame([(1, float(x0), float(y0), float(x1), float(y1))], "seq int, a double, b double, c double, d double")
    return S.polygon_rows(df.select("seq", M.box_parts(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("parts")))


def test_voxel_subsample_against_brute_force(spark):
    rng = np.random.default_rng(12)
    points = [tuple(map(float, p)) for p in np.round(rng.uniform(-9, 9, (60, 3)), 3)]
    df = spark.createDataFrame(points, "x double, y double, z double")
    got = {(r["voxel_size"], r["ix"], r["iy"]): (r["x"], r["y"], r["z"]) for r in R.voxel_subsample(df, [1.5, 6.0]).collect()}
    want = {}
    for size in (1.5, 6.0):
        for x, y, z in points:
            ix, iy = int(np.floor(x / size)), int(np.floor(y / size))
            rank = ((x - (ix + 0.5) * size) ** 2 + (y - (iy + 0.5) * size) ** 2, x, y, z)
            want[size, ix, iy] = min(want.get((size, ix, iy), rank), rank)
    assert got == {k: v[1:] for k, v in want.items()}
    assert R.voxel_sizes(500.0) == [20.0, 10.0, 5.0, 2.5]
    assert R.voxel_sizes(50.0) == [4.0, 2.0, 1.0]


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_local_relief_against_brute_force(spark, radius):
    rng = np.random.default_rng(radius)
    surface = np.round(rng.uniform(3, 30, (6, 6)), 2)
    got = {(r["row"], r["col"]): r["relief"] for r in R.local_relief(grid(spark, surface.tolist(), surface.tolist()), radius_cells=radius).collect()}
    for (r, c), relief in got.items():
        around = surface[max(0, r - radius) : r + radius + 1, max(0, c - radius) : c + radius + 1]
        assert relief == pytest.approx(surface[r, c] - around.min())


# Two roof levels, 31 m and 40 m, and a tower beside them.
STEPS = [(-3.0, 1.0, 31.0), (-1.0, 1.0, 31.3), (0.5, 1.0, 40.2), (2.0, 1.0, 40.0), (60.0, 1.0, 75.0)]


@pytest.mark.parametrize(
    ("point", "expected"),
    [((-2.0, 1.0, 31.5), 31.0), ((1.5, 1.0, 40.5), 40.0), ((1.5, 1.0, 47.0), 40.0), ((500.0, 1.0, 50.0), None), ((60.5, 1.0, 76.0), 75.0)],
)
def test_roof_estimate(spark, point, expected):
    cells = spark.createDataFrame([("t", *r) for r in STEPS], "tile string, x double, y double, surface_z double")
    candidate = spark.createDataFrame([("t", 1, *point)], "tile string, id int, x double, y double, surface_z double")
    got = R.estimate_roofs(candidate, cells, key=["id"]).first()["roof_z"]
    assert (got is None) == (expected is None)
    if expected is not None:
        assert abs(got - expected) <= 0.3  # the level is one of its cells


def flat(value, n=5):
    return [[value] * n for _ in range(n)]


def test_every_cell_gets_one_class(spark):
    surface = flat(10.0)
    for r in range(1, 4):
        for c in range(1, 4):
            surface[r][c] = 15.0
    out = R.classify_cells(grid(spark, flat(10.0), surface), footprint(spark, 2, 2, 8, 8), bbox=None)
    counts = R.class_counts(out).first()
    assert (counts["ground_points"], counts["building_points"], counts["tree_points"]) == (25, 9, 0)
    assert counts["complete"] and counts["alignment_candidates"] == 9
    cloud = R.point_cloud(out).groupBy("class").count().collect()
    assert {r["class"]: r["count"] for r in cloud} == {"ground": 25, "building": 9, "unclassified": 16}


def pixels(spark, rgba, n=5):
    return spark.createDataFrame([(r, c, *rgba) for r in range(n) for c in range(n)], "row int, col int, r int, g int, b int, a int")


def test_tree_branch_outside_and_on_roofs(spark):
    surface = flat(10.0)
    surface[2][2] = 15.0
    canopy = {"bbox": (0.0, 0.0, 10.0, 10.0), "width": 5, "height": 5}
    green = pixels(spark, (40, 160, 40, 255))
    alone = R.classify_cells(
        grid(spark, flat(10.0), surface), footprint(spark, 100, 100, 110, 110), bbox=None, relief_cells=2, canopy={"pixels": green, **canopy}
    )
    assert R.class_counts(alone).first()["tree_points"] == 1
    assert R.tree_filter_counts(alone).first()["local_relief_pass_count"] == 1
    grey = R.classify_cells(
        grid(spark, flat(10.0), surface), footprint(spark, 100, 100, 110, 110), bbox=None, relief_cells=2,
        canopy={"pixels": pixels(spark, (90, 90, 90, 255)), **canopy},
    )
    assert R.class_counts(grey).first()["tree_points"] == 0
    # A green flat roof stays building: the candidate is level with its roof.
    roof = flat(15.0)
    green_roof = R.classify_cells(
        grid(spark, flat(10.0), roof), footprint(spark, 0, 0, 10, 10), bbox=None, relief_cells=2, canopy={"pixels": green, **canopy}
    )
    assert R.class_counts(green_roof).first()["building_points"] == 25
    # A crown five metres above the roof is a tree.
    roof[2][2] = 20.0
    crown = R.classify_cells(
        grid(spark, flat(10.0), roof), footprint(spark, 0, 0, 10, 10), bbox=None, relief_cells=2, canopy={"pixels": green, **canopy}
    )
    counts = R.class_counts(crown).first()
    assert (counts["tree_points"], counts["building_points"]) == (1, 24)
    assert R.tree_filter_counts(crown).first()["roof_offset_pass_count"] == 1


def test_tree_tag_is_evidence_without_canopy_colour(spark):
    surface = flat(10.0)
    surface[2][2] = 15.0
    tags = spark.createDataFrame([(5.0, 9.0)], "tag_x double, tag_y double")
    out = R.classify_cells(
        grid(spark, flat(10.0), surface), footprint(spark, 100, 100, 110, 110), bbox=None, relief_cells=2, tags=tags,
        canopy={"pixels": pixels(spark, (90, 90, 90, 255)), "bbox": (0.0, 0.0, 10.0, 10.0), "width": 5, "height": 5},
    )
    assert R.class_counts(out).first()["tree_points"] == 1


def test_alignment_prefers_short_shift(spark):
    hole = footprint(spark, 0, 0, 10, 10)
    df = spark.createDataFrame([(1, 12.0, 5.0)], "seq bigint, x double, y double")
    out = R.alignment(df, hole, order="seq", key=["seq"]).first()
    assert (out["dx"], out["dy"], out["score"], out["status"]) == (2, 0, 1, "passed")
    far = spark.createDataFrame([(1, 100.0, 5.0)], "seq bigint, x double, y double")
    out = R.alignment(far, hole, order="seq", key=["seq"]).first()
    assert (out["dx"], out["dy"], out["score"], out["status"]) == (0, 0, 0, "warning")
    assert R.alignment(df, hole.where("false"), order="seq", key=["seq"]).first()["status"] == "failed"
    assert R.alignment(df.where("false"), hole, order="seq", key=["seq"]).first()["status"] == "warning"


def test_sampling_matches_list_arithmetic(spark):
    for n, limit in ((10, 3), (100, 7), (5, 9), (1000, 333)):
        df = spark.range(n).withColumn("seq", F.col("id") * 3)
        got = sorted(r["id"] for r in O.even_sample(df, limit, order="seq", block=16).collect())
        want = list(range(n)) if n <= limit else [min(int(i * (n / limit)), n - 1) for i in range(limit)]
        assert got == want
        stride = sorted(r["id"] for r in O.stride_sample(df, limit, order="seq", block=16).collect())
        assert stride == list(range(n))[:: max(1, n // limit)]


def test_nearest_ground_rings(spark):
    ground = spark.createDataFrame([(1.0, 1.0, 5.0, 1), (9.0, 1.0, 7.0, 2)], "gx double, gy double, gz double, gseq int")
    points = spark.createDataFrame([(1, 1.5, 1.5), (2, 7.5, 1.0), (3, 200.0, 1.0)], "id int, x double, y double")
    got = {r["id"]: r["ground_z"] for r in S.nearest_ground(points, ground, key=["id"]).collect()}
    assert got == {1: 5.0, 2: 7.0, 3: 6.0}


@pytest.mark.parametrize("max_ring", [0, 1, 5])
def test_nearest_ground_equals_a_scan_of_all_rings(spark, max_ring):
    rng = random.Random(41)
    ground = [(rng.uniform(-30, 30), rng.uniform(-30, 30), float(k), k) for k in range(60)]
    points = [(k, rng.uniform(-45, 45), rng.uniform(-45, 45)) for k in range(150)]
    cell, floor = 2.0, lambda v: math.floor(v / 2.0)
    mean, want = sum(g[2] for g in ground) / len(ground), {}
    for k, x, y in points:
        near = []
        for gx, gy, gz, seq in ground:
            dx, dy = floor(gx) - floor(x), floor(gy) - floor(y)
            if max(abs(dx), abs(dy)) <= max_ring:
                near.append((max(abs(dx), abs(dy)), (gx - x) ** 2 + (gy - y) ** 2, dx, dy, seq, gz))
        want[k] = min(near)[-1] if near else mean
    g = spark.createDataFrame(ground, "gx double, gy double, gz double, gseq int")
    p = spark.createDataFrame(points, "id int, x double, y double")
    got = {r["id"]: r["ground_z"] for r in S.nearest_ground(p, g, key=["id"], cell=cell, max_ring=max_ring).collect()}
    assert got == pytest.approx(want)


def test_roof_level_pool_order():
    x, y, z = np.array([0.0, 50.0]), np.zeros(2), np.array([30.0, 40.0])
    assert R._roof_level(x, y, z, np.array([1.0, 4.0]), 10.0) == 30.0
