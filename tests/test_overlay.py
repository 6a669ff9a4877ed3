"""Overlay: kernel identities, partition, clip, gap fill, overlaps with copies."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.functions import measure as M
from geoloom.operators import overlay as OV
from geoloom.operators import sweep as SW
from geoloom.operators.skew import connected_components
from geoloom.params import Region

PARTS = "array<array<array<struct<x:double,y:double>>>>"


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in [*points, points[0]]]


def square(x, y, size, hole=None):
    s = [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]
    part = [ring(s)]
    if hole:
        part.append(ring(hole))
    return [part]


def star(rng, n, cx, cy, r):
    angle = 2 * np.pi * (np.arange(n) + rng.random(n) * 0.8) / n
    radius = r * (0.4 + 0.6 * rng.random(n))
    return [(cx + math.cos(a) * q, cy + math.sin(a) * q) for a, q in zip(angle, radius)]


def edges(points):
    p = np.array(points)
    return np.column_stack([p, np.roll(p, -1, axis=0)])


def shoelace(points):
    e = edges(points)
    return abs((e[:, 0] * e[:, 3] - e[:, 2] * e[:, 1]).sum()) / 2


def test_sweep_satisfies_area_identities():
    rng = np.random.default_rng(5)
    group, poly, rows, area = [], [], [], []
    for g in range(200):
        a, b = star(rng, 11, 0, 0, 1), star(rng, 8, rng.normal() * 0.5, rng.normal() * 0.5, 1)
        area.append((shoelace(a), shoelace(b)))
        for k, p in enumerate((a, b)):
            rows.append(edges(p))
            group += [g] * len(p)
            poly += [k] * len(p)
    s = SW.sweep(np.array(group), np.array(poly), *np.vstack(rows).T)
    cover = np.zeros((len(s.slab), 2), bool)
    cover[s.cover_trap, s.cover_poly] = True
    total = lambda flag: np.bincount(s.group, weights=s.area * flag, minlength=200)
    one, two = total(cover[:, 0]), total(cover[:, 1])
    both, any_ = total(cover.all(1)), total(cover.any(1))
    np.testing.assert_allclose(np.column_stack([one, two]), area, atol=1e-12)
    np.testing.assert_allclose(one + two - both, any_, atol=1e-12)


def test_coincident_edges_and_identical_polygons():
    s = [edges([(0, 0), (2, 0), (2, 2), (0, 2)]), edges([(2, 0), (4, 0), (4, 2), (2, 2)]), edges([(0, 0), (2, 0), (2, 2), (0, 2)])]
    out = SW.sweep(np.zeros(12, int), np.repeat([0, 1, 2], 4), *np.vstack(s).T)
    cover = np.zeros((len(out.slab), 3), bool)
    cover[out.cover_trap, out.cover_poly] = True
    assert (out.area * cover.any(1)).sum() == pytest.approx(8.0)
    assert (out.area * (cover[:, 0] & cover[:, 2])).sum() == pytest.approx(4.0)
    assert (out.area * (cover[:, 0] & cover[:, 1])).sum() == pytest.approx(0.0)


@pytest.mark.parametrize(("tile", "hot_edges"), [(7.0, 50_000), (64.0, 20), (1000.0, 50_000)])
def test_partition_does_not_depend_on_tiling(spark, tile, hot_edges):
    rng = np.random.default_rng(9)
    rows = [(i, int(rng.integers(0, 3)), [[ring(star(rng, 9, *rng.uniform(-20, 20, 2), 8))]]) for i in range(40)]
    rows += [(100 + i, r, g) for i, (_, r, g) in enumerate(rows[:10])]  # copies of the first ten
    df = spark.createDataFrame(rows, f"seq bigint, rank int, parts {PARTS}")
    out = OV.partition_surfaces(df, tile=tile, hot_edges=hot_edges).collect()
    # Independent answer: sequential sweep over all polygons at once, owner = first in order.
    order = sorted(range(len(rows)), key=lambda i: (rows[i][1], rows[i][0]))
    e = [edges([(v["x"], v["y"]) for v in rows[i][2][0][0][:-1]]) for i in order]
    s = SW.sweep(np.zeros(sum(map(len, e)), int), np.repeat(np.arange(len(e)), [len(x) for x in e]), *np.vstack(e).T)
    owner = OV._first_cover(s, len(e))
    kept = np.bincount(owner, weights=s.area, minlength=len(e) + 1)
    expected = {rows[i][0]: kept[n] for n, i in enumerate(order)}
    for r in out:
        want = expected[r["seq"]]
        assert r["area_m2"] == pytest.approx(want if want > 0.01 else 0.0, abs=1e-6)
        assert (r["state"] == "removed") == (want <= 0.01)


def test_holes_and_touching_squares(spark):
    rows = [
        (1, 0, square(0, 0, 10, hole=[(2, 2), (8, 2), (8, 8), (2, 8)])),
        (2, 1, square(0, 0, 10)),
        (3, 1, square(10, 0, 10)),
    ]
    df = spark.createDataFrame(rows, f"seq bigint, rank int, parts {PARTS}")
    out = {r["seq"]: (round(r["area_m2"], 6), r["state"]) for r in OV.partition_surfaces(df).collect()}
    assert out == {1: (64.0, "accepted"), 2: (36.0, "clipped"), 3: (100.0, "accepted")}


def test_precedence_uses_most_specific_selector(spark):
    df = spark.createDataFrame(
        [(1, "roads", "road", "streets"), (2, "roads", "road", None), (3, "buildings", "building_part", None), (4, "sea", "x", None)],
        "seq int, category string, group_tag string, supplemental_input_id string",
    )
    got = {r["seq"]: r["rank"] for r in OV.precedence_rank(df, ["roads", "supplemental:streets", "buildings:building_part", "buildings"]).collect()}
    assert got == {1: 1, 2: 0, 3: 2, 4: None}


def test_clip_to_circle(spark):
    rows = [(1, square(-1, -1, 2)), (2, square(90, -10, 20)), (3, square(200, 0, 5)), (4, square(-300, -300, 600))]
    out = {r["seq"]: r for r in OV.clip_to_circle(spark.createDataFrame(rows, f"seq bigint, parts {PARTS}"), radius=100.0).collect()}
    disc = 128 * math.sin(2 * math.pi / 256) * 100**2
    assert set(out) == {1, 2, 4}
    assert out[1]["area_m2"] == pytest.approx(4.0) and not out[1]["clipped"]
    assert out[4]["area_m2"] == pytest.approx(disc)
    assert 190 < out[2]["area_m2"] < 200


def test_gap_fill_pieces_are_connected_across_tiles(spark):
    region = Region(0.0, 0.0, 200.0, 100.0)
    # A wall splits the disc into two halves; an island floats in the right one.
    rows = [(1, [[ring([(-5, -150), (5, -150), (5, 150), (-5, 150)])]]), (2, square(60, -5, 10))]
    features = spark.createDataFrame(rows, f"seq bigint, parts {PARTS}")
    one = spark.range(1).drop("id")
    for tile in (16.0, 64.0, 512.0):
        out = OV.gap_fill(features, one, region=region, tile=tile).collect()
        zones = sorted((r["zone"], round(r["area_m2"], 3)) for r in out)
        assert [z for z, _ in zones] == ["annular", "annular", "inner", "inner"]
        assert [r["gap_no"] for r in sorted(out, key=lambda r: r["gap_no"])] == [1, 2, 3, 4]
        areas = [a for z, a in zones if z == "annular"]
        assert max(areas) - min(areas) == pytest.approx(100.0, abs=0.01)


def test_components_of_a_long_chain(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(40)] + [("z1", "z2")]
    out = connected_components(spark.createDataFrame(chain, "u string, v string")).collect()
    assert {r["component"] for r in out if r["node"].startswith("n")} == {"n000"}
    assert {r["component"] for r in out if r["node"].startswith("z")} == {"z1"}
    assert len(out) == 43


def test_overlap_report_with_copies_and_multipart_features(spark):
    rows = [(i, "copy", square(0, 0, 4)) for i in range(12)]
    rows += [(20, "multi", square(0, 0, 4) + square(3, 3, 4)), (21, "lone", square(50, 50, 2)), (22, "part", square(3.9, 3.9, 1))]
    df = spark.createDataFrame(rows, f"seq bigint, source_tag string, parts {PARTS}")
    check = OV.FootprintOverlaps(df, tile=8.0)
    polygons = [(seq, p) for seq, _, parts in rows for p in parts]

    def overlap(p, q):
        lo = lambda r, k: min(v[k] for v in r[0])
        hi = lambda r, k: max(v[k] for v in r[0])
        w = min(hi(p, "x"), hi(q, "x")) - max(lo(p, "x"), lo(q, "x"))
        h = min(hi(p, "y"), hi(q, "y")) - max(lo(p, "y"), lo(q, "y"))
        return w * h if w > 0 and h > 0 else 0.0

    brute = [
        (round(overlap(p, q), 3), min(a, b), max(a, b))
        for (a, p), (b, q) in itertools.combinations(polygons, 2)
        if a != b and overlap(p, q) > 0.05
    ]
    summary = check.summary().first()
    assert summary["overlap_pair_count"] == len(brute)
    assert summary["polygon_count"] == len(polygons)
    assert summary["largest_overlap_area_m2"] == 16.0
    top = [(r["intersection_area_m2"], r["first_feature_index"], r["second_feature_index"]) for r in check.top(10).collect()]
    assert top == sorted(brute, key=lambda t: (-t[0], t[1], t[2]))[:10]


def test_surface_pieces_form_the_same_areas(spark):
    rows = [(1, 0, square(0, 0, 10)), (2, 1, square(5, 5, 10)), (3, 1, square(4, 4, 4))]
    df = spark.createDataFrame(rows, f"seq bigint, rank int, parts {PARTS}")
    pieces = OV.surface_pieces(df, tile=6.0).withColumn("polygon", OV.trapezoid_polygon())
    got = {r["seq"]: r["a"] for r in pieces.groupBy("seq").agg(F.sum(M.polygon_area(F.col("polygon"))).alias("a")).collect()}
    assert got == {1: pytest.approx(100.0), 2: pytest.approx(75.0)}


def test_top_overlaps_with_many_copies_inside_one_feature(spark):
    # One feature holds 150 copies of a square that two other features hold once.
    one = square(0, 0, 10)[0]
    rows = [(1, "many", [one] * 150), (2, "a", [one]), (3, "b", [one])]
    df = spark.createDataFrame(rows, f"seq bigint, source_tag string, parts {PARTS}")
    report = OV.FootprintOverlaps(df)
    assert report.summary().first()["overlap_pair_count"] == 301
    top = report.top(100).collect()
    assert len(top) == 100 and {(r["first_feature_index"], r["second_feature_index"]) for r in top} == {(1, 2)}
    pairs = [(r["first_feature_index"], r["second_feature_index"]) for r in report.top(301).collect()]
    assert len(pairs) == 301 and pairs.count((1, 2)) == pairs.count((1, 3)) == 150 and pairs.count((2, 3)) == 1


def test_components_raise_instead_of_stopping_early(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(64)], "u bigint, v bigint")
    with pytest.raises(RuntimeError):
        connected_components(links, max_rounds=1)


def test_many_shapes_in_a_tile_stack_quickly():
    import time

    import pandas as pd

    n = 4000
    x = np.arange(n) % 60 * 2.0
    y = np.arange(n) // 60 * 1.8
    ends = np.concatenate([np.column_stack([x, y, x, y + 1]), np.column_stack([x + 1, y + 1, x + 1, y])])
    pdf = pd.DataFrame(ends, columns=["ax", "ay", "bx", "by"])
    group = np.tile(np.arange(n), 2)
    start = time.perf_counter()
    s = OV._swept(pdf, np.zeros(2 * n, np.int64), [(2, SW.tile_edges(0, 0, 128, 128))], group)
    assert time.perf_counter() - start < 5 and math.isclose(s.area[s.cover_trap[s.cover_poly == 0]].sum(), n)


def rings_of(rng, seq, n, r, hole):
    """A jagged ring, with another one cut out of its middle, on a lattice that tile borders share."""
    shell = [(round(x * 4) / 4, round(y * 4) / 4) for x, y in star(rng, n, 0, 0, r)]
    part = [ring(shell)]
    if hole:
        part.append(ring([(x * 0.3, y * 0.3) for x, y in shell]))
    return (seq, seq, [part])


@pytest.mark.parametrize("hot_edges", [30, 50_000])
@pytest.mark.parametrize("tile", [2.0, 5.0])
def test_wide_geometries_by_backdrops(spark, tile, hot_edges):
    """Many tiles across: the same areas as in one tile, and rows for edges and tiles instead of edges times columns."""
    rng = np.random.default_rng(31)
    rows = [rings_of(rng, k, int(rng.integers(5, 90)), float(rng.uniform(6, 60)), k % 2 == 0) for k in range(12)]
    df = spark.createDataFrame(rows, f"seq bigint, rank bigint, parts {PARTS}")
    areas = lambda **o: {r["seq"]: (r["source_area"], r["owned_area"]) for r in OV.surface_areas(df, **o).collect()}
    whole, tiled = areas(tile=1000.0), areas(tile=tile, hot_edges=hot_edges)
    assert whole.keys() == tiled.keys()
    for k, (source, owned) in whole.items():
        assert tiled[k] == pytest.approx((source, owned), abs=1e-6)


def test_rows_of_a_wide_geometry(spark):
    n, tile = 3000, 1.0
    t = 2 * np.pi * np.arange(n) / n
    points = list(zip((400 + 60 * np.sin(11 * t)) * np.cos(t), 20 * np.sin(t)))
    df = spark.createDataFrame([(1, 1, [[ring(points)]])], f"seq bigint, rank bigint, parts {PARTS}")
    routed = OV.route_to_tiles(OV.edge_rows(df), tile=tile)
    per_tile = routed.groupBy(*OV.TILE_KEYS).count().collect()
    # Edges cut at rows and columns, and at most a few stretches for each side of a tile.
    assert sum(r["count"] for r in per_tile) < 3 * n + 4 * len(per_tile) and len(per_tile) < shoelace(points) + 2 * n
    assert OV.surface_areas(df, tile=tile).first()["source_area"] == pytest.approx(shoelace(points), rel=1e-9)


def test_backdrop_counts_like_a_plain_scan():
    rng = np.random.default_rng(32)
    for _ in range(200):
        n = int(rng.integers(1, 12))
        first = rng.integers(0, 9, n)
        last = np.minimum(9, first + rng.integers(0, 3, n))
        ya, yb = rng.integers(0, 6, n).astype(float), rng.integers(0, 6, n).astype(float)
        got = OV.backdrop((0, 9), first, last, ya, yb)
        for c in range(10):
            for side, beside in ((0, last < c), (1, first > c)):
                for y in np.arange(6) + 0.5:
                    odd = sum(b and min(p, q) < y < max(p, q) for b, p, q in zip(beside, ya, yb)) % 2
                    assert odd == sum(a < y < b for k, s, a, b in got if (k, s) == (c, side))
