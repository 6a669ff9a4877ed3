"""Bucketed joins equal brute force, also when every cell counts as crowded."""

import math
import random

import pytest
from pyspark.sql import functions as F

from geoloom.functions import measure as M
from geoloom.operators import edgecells as EC
from geoloom.operators import spatial as S

def geom(*rings):
    return [[[{"x": x, "y": y} for x, y in ring] for ring in rings]]


def polygons(spark, rows):
    df = spark.createDataFrame(rows, "seq bigint, parts array<array<array<struct<x:double,y:double>>>>")
    return S.polygon_rows(df)


@pytest.mark.parametrize("hot_rows", [None, 5, 200_000])
def test_box_pairs_equal_cross_join(spark, hot_rows):
    rng = random.Random(3)

    def boxes(n, tag):
        out = []
        for i in range(n):
            x, y = rng.uniform(-50, 50), rng.uniform(-50, 50)
            if i % 3 == 0:
                x, y = 1.25, -2.5  # a third of all rows share one place
            out.append((i, x, y, x + rng.uniform(0, 30), y + rng.uniform(0, 9)))
        return spark.createDataFrame(out, f"{tag}id int, {tag}x0 double, {tag}y0 double, {tag}x1 double, {tag}y1 double"), out

    a, ra = boxes(90, "a")
    b, rb = boxes(70, "b")
    joined = S.box_join(
        a, b, left_box=("ax0", "ay0", "ax1", "ay1"), right_box=("bx0", "by0", "bx1", "by1"), cell=8.0, pad=1.5,
        left_id=("aid",), right_id=("bid",), hot_rows=hot_rows,
    )
    got = [(r["aid"], r["bid"]) for r in joined.select("aid", "bid").collect()]
    expected = [
        (p[0], q[0])
        for p in ra
        for q in rb
        if p[1] <= q[3] + 1.5 and p[3] >= q[1] - 1.5 and p[2] <= q[4] + 1.5 and p[4] >= q[2] - 1.5
    ]
    assert sorted(got) == sorted(expected)


#: A slanted shell with two holes, one of which touches it.
SLANTED = ([(-4.0, 1.0), (9.0, -3.0), (14.0, 6.0), (5.0, 12.0), (-2.0, 9.0)], [(0.0, 3.0), (4.0, 2.0), (3.0, 6.0)], [(5.0, 12.0), (7.0, 7.0), (9.0, 8.0)])


def covers(rings, x, y):
    """Plain scan over all edges: boundaries in, interiors of holes out."""

    def edges(ring):
        return zip(ring, ring[1:] + ring[:1])

    def on(ring):
        for (ax, ay), (bx, by) in edges(ring):
            cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
            if abs(cross) <= 1e-9 * math.hypot(bx - ax, by - ay) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return True
        return False

    def within(ring):
        return sum((ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay) for (ax, ay), (bx, by) in edges(ring)) % 2 == 1

    if on(rings[0]):
        return True
    return within(rings[0]) and not any(within(h) and not on(h) for h in rings[1:])


def distance(rings, x, y):
    out = math.inf
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            dx, dy = bx - ax, by - ay
            t = max(0.0, min(1.0, ((x - ax) * dx + (y - ay) * dy) / (dx * dx + dy * dy)))
            out = min(out, math.hypot(x - ax - t * dx, y - ay - t * dy))
    return out


@pytest.mark.parametrize("cell", [0.75, 3.0, 50.0])
def test_hole_and_boundary_rules(spark, cell):
    polys = polygons(spark, [(1, geom(*[[*r, r[0]] for r in SLANTED]))])
    grid = [(x / 2, y / 2) for x in range(-12, 32) for y in range(-10, 28)]
    corners = [p for ring in SLANTED for p in ring] + [(2.5, -1.0), (2.0, 2.5), (6.0, 9.5)]  # middles of edges
    points = spark.createDataFrame(grid + corners, "x double, y double").distinct()
    inside = {(r["x"], r["y"]) for r in S.points_in_polygons(points, polys, cell=cell).collect()}
    assert inside == {p for p in grid + corners if covers(SLANTED, *p)}
    hits = {(r["x"], r["y"]) for r in S.points_near_polygons(points, polys, buffer_m=0.8, cell=cell).collect()}
    assert hits == {p for p in grid + corners if distance(SLANTED, *p) <= 0.8}
    both = S.footprint_hits(points, polys, key=["x", "y"], buffer_m=0.8, cell=cell).collect()
    assert {(r["x"], r["y"]) for r in both if r["inside"]} == inside and {(r["x"], r["y"]) for r in both if r["near"]} == hits
    assert S.points_near_polygons(points, polys, buffer_m=0.0).count() == 0


def test_edges_along_the_grid(spark):
    """Corners and edges on cell borders; holes that overlap, lie on each other, or outside of the shell."""
    rng = random.Random(21)
    rows, shapes = [], []
    for k in range(30):
        box = lambda a, b, w, h: [(a, b), (a + w, b), (a + w, b + h), (a, b + h)]
        x, y = 4.0 * rng.randrange(10), 4.0 * rng.randrange(10)
        holes = [box(x + rng.randrange(12), y + rng.randrange(12), 4.0, 4.0)[:: rng.choice([1, -1])] for _ in range(rng.randrange(4))]
        shapes.append([box(x, y, 12.0, 12.0), *[[(float(a), float(b)) for a, b in h] for h in holes]])
        rows.append((k, geom(*[[*r, r[0]] for r in shapes[-1]])))
    polys = polygons(spark, rows)
    points = spark.createDataFrame([(i, rng.randrange(120) / 2, rng.randrange(120) / 2) for i in range(500)], "id int, x double, y double")
    for hot in (3, None):
        pairs = S.box_join(
            points, polys, left_box=("x", "y"), right_box=S.POLY_BOX, cell=4.0, residual=EC.inside("x", "y"), polygon="polygon",
            left_id=["id"], right_id=["seq"], hot_rows=hot,
        ).select("id", "seq")
        brute = points.crossJoin(polys).where(M.point_in_polygon("polygon", "x", "y")).select("id", "seq")
        assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, brute.collect()))


def test_cells_hold_edges_and_not_polygons(spark):
    """A polygon a thousand cells wide: rows for its edges and the cells it covers, and few edges in each."""
    n = 4000
    ring = [(500 + (450 + 40 * math.sin(9 * t)) * math.cos(t), 30 + 25 * math.sin(t)) for t in (2 * math.pi * k / n for k in range(n))]
    polys = polygons(spark, [(1, geom([*ring, ring[0]]))])
    rows = EC.by_rows(EC.with_edges(polys, "polygon"), F.col("py0"), F.col("py1"), 1.0, 0.0)
    rows = rows.withColumn("_gx", F.explode(F.sequence(F.floor("px0"), F.floor("px1"))))
    cells = EC.localized(rows, "_gx", "_gy", F.lit(1.0), 0.0).select(F.size("_local.edges").alias("n")).collect()
    area = sum(ax * by - bx * ay for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1])) / 2
    assert sum(r["n"] for r in cells) < 4 * n and max(r["n"] for r in cells) < 80
    assert area < len(cells) < area + 2 * n


@pytest.mark.parametrize("hot_rows", [3, 200_000])
def test_indexed_containment_equals_every_pair(spark, hot_rows):
    rng = random.Random(11)
    rows = []
    for i in range(25):
        cx, cy, n = rng.uniform(0, 60), rng.uniform(0, 60), rng.randint(3, 9)
        ring = [
            (cx + math.cos(2 * math.pi * k / n) * rng.uniform(2, 9), cy + math.sin(2 * math.pi * k / n) * rng.uniform(2, 9))
            for k in range(n)
        ]
        rows.append((i, geom([*ring, ring[0]])))
    polys = polygons(spark, rows + [(100 + i, g) for i, g in rows[:8]])
    points = spark.createDataFrame([(i, rng.uniform(0, 60), rng.uniform(0, 60)) for i in range(400)], "id int, x double, y double")
    got = {r["id"] for r in S.points_in_polygons(points, polys, cell=6.0, point_id=["id"], hot_rows=hot_rows).collect()}
    brute = points.crossJoin(polys.select("polygon")).where(M.point_in_polygon("polygon", "x", "y"))
    assert got == {r["id"] for r in brute.select("id").distinct().collect()}
    near = {r["id"] for r in S.points_near_polygons(points, polys, cell=6.0, point_id=["id"], hot_rows=hot_rows).collect()}
    brute = points.crossJoin(polys.select("polygon")).where(
        M.near_boundary("polygon", "x", "y", 1.5)
    )
    assert near == {r["id"] for r in brute.select("id").distinct().collect()}


def test_reference_point_and_distance(spark):
    df = spark.createDataFrame(
        [
            ("Polygon", geom([(1.0, 1.0), (5.0, 1.0), (5.0, 3.0), (1.0, 3.0), (1.0, 1.0)])),
            ("LineString", geom([(3.0, -4.0), (3.0, 4.0)])),
            ("Point", geom([(3.0, 4.0)])),
        ],
        "kind string, parts array<array<array<struct<x:double,y:double>>>>",
    )
    out = df.select(
        "kind", M.roi_distance_m(F.col("kind"), F.col("parts")).alias("d"), M.reference_point(F.col("kind"), F.col("parts")).alias("p")
    ).collect()
    by = {r["kind"]: r for r in out}
    assert by["Polygon"]["d"] == pytest.approx(math.sqrt(2))
    assert (by["Polygon"]["p"]["x"], by["Polygon"]["p"]["y"]) == (3.0, 2.0)
    assert by["LineString"]["d"] == pytest.approx(3.0)
    assert by["Point"]["d"] == pytest.approx(5.0)
