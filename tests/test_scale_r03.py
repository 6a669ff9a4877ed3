"""Work that is shared out: the steps of round 3's findings on rows of their own."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from geoloom.operators import features as FT
from geoloom.operators import mesh as MS
from geoloom.operators import overlay as OV
from geoloom.operators import rings as RG
from geoloom.operators import trees as TE
from geoloom.plans import fixtures as FX
from geoloom.schemas import TRI_COLS
from geoloom.sources import sinks as K

COORDS = ", ".join(f"{c} double" for c in TRI_COLS)


def some_rings(rng):
    rings = []
    for _ in range(rng.choice([0, 1, 2, 3, 5, 9])):
        x, y, w, kind = rng.randint(0, 6), rng.randint(0, 6), rng.choice([0, 0.5, 1, 2, 4, 8]), rng.random()
        if kind < 0.6:
            ring = [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]
        elif kind < 0.85:
            ring = [(rng.randint(0, 9), rng.randint(0, 9)) for _ in range(rng.randint(0, 7))]
        else:
            ring = rings[0] if rings else []
        rings.append([(float(a), float(b)) for a, b in ring])
    return rings


def test_rings_of_a_batch_nest_like_those_of_one_record(monkeypatch):
    rng = random.Random(5)
    rows = [some_rings(rng) for _ in range(500)]
    axis = lambda k: pa.array([[p[k] for r in rec for p in r] for rec in rows], pa.list_(pa.float64()))
    lens = pa.array([[len(r) for r in rec] for rec in rows], pa.list_(pa.int32()))
    want = [[[[{"x": a, "y": b} for a, b in ring] for ring in part] for part in FT._even_odd_groups(rec)] for rec in rows]
    for points in (1_000_000, 7):
        monkeypatch.setattr(FT, "SCAN_POINTS", points)
        assert FT._nested.func(axis(0), axis(1), lens).to_pylist() == want


def tasks(df):
    """Partitions that hold rows."""
    return len([n for n in df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n])


def test_views_of_one_file_are_dealt_to_all_tasks(spark):
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tasks(FX.view(spark, "/root/testdata/sf0.01", "fx_rects")) == width


def test_instances_of_one_model_are_dealt(spark):
    mesh = spark.createDataFrame([("m", "tower", 0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 1.0)], f"model string, region string, tri_no bigint, {COORDS}")
    rows = [(k, "m", 1.0, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0) for k in range(3 * MS.HOT_PLACED * 4)]
    instances = spark.createDataFrame(rows, "id bigint, model string, scale_x double, scale_y double, scale_z double, rotation_deg double, to_x double, to_y double, to_z double")
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for c in limits:
            spark.conf.set(c, "-1")
        placed = MS.place_meshes(instances, mesh)
        assert placed.count() == len(rows) and tasks(placed) > 1
    finally:
        for c in limits:
            spark.conf.unset(c)


def test_faces_are_counted_with_their_edges(spark):
    quad = [(0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 1.0, 1.0, 0.0), (0.0, 0.0, 0.0, 1.0, 1.0, 0.0, 0.0, 1.0, 0.0)]
    flat = [(0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 2.0, 0.0, 0.0), (0.0, 0.0, float("nan"), 1.0, 0.0, 0.0, 1.0, 1.0, 0.0)]
    df = spark.createDataFrame([(1, *t) for t in quad] + [(2, *t) for t in flat], f"k int, {COORDS}")
    got = {r["k"]: r for r in MS.mesh_quality(df, ["k"]).collect()}
    assert (got[1]["triangles"], got[1]["rejected_triangles"], got[1]["edges"], got[1]["boundary_edges"]) == (2, 0, 5, 4)
    assert (got[2]["triangles"], got[2]["rejected_triangles"]) == (2, 2) and not got[2]["closed_manifold"]
    whole = MS.mesh_quality(df.limit(0)).first()
    assert (whole["triangles"], whole["edges"], whole["rejected_triangles"]) == (0, 0, 0)
    # One pass over the mesh: the triangles are not read again for the faces.
    plan = MS.mesh_quality(df, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_trees_are_dealt_before_they_become_triangles(spark):
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = (0.0, 0.0, 0.0, 9.0, 2.0, 2.0, 0.2, "ellipsoid")
    trees = spark.createDataFrame([(str(k), *row) for k in range(64)], "tree_id string, x double, y double, z double, height_m double, trunk_height_m double, crown_radius_m double, trunk_radius_m double, crown_shape string")
    assert tasks(TE.crown_mesh(trees.coalesce(1))) == tasks(TE.trunk_mesh(trees.coalesce(1))) == width


def test_outlines_are_walked_by_many_tasks(spark):
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = [(k, y, y + 1.0, 0.0, 0.0, 2.0, 2.0) for k in range(200) for y in (0.0, 1.0)] + [(999, 0.0, 1e-9, 0.0, 0.0, 1.0, 1.0)]
    pieces = spark.createDataFrame(rows, "seq bigint, y_lo double, y_hi double, xl_lo double, xl_hi double, xr_lo double, xr_hi double")
    out = RG.outlines(pieces, ["seq"], min_area=0.01)
    got = {r["seq"]: r["parts"] for r in out.collect()}
    assert set(got) == set(range(200)) and all(len(p) == 1 and len(p[0][0]) == 5 for p in got.values())
    assert tasks(out) == width


def test_parts_of_features_without_polygons_are_null():
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    points = [{"x": x, "y": y} for x, y in ring]
    assert RG._parts_array([[], [[ring, ring], [ring]], []]).to_pylist() == [None, [[points, points], [points]], None]
    assert RG._parts_array([]).to_pylist() == [] and np.array(RG.polygons(np.array([[0, 1, 0, 0, 1, 1.0]]))).shape == (1, 1, 5, 2)


def test_one_stl_file_is_sorted_before_its_one_task(spark, tmp_path, monkeypatch):
    cut = []
    keep = K.cut_lineage
    monkeypatch.setattr(K, "cut_lineage", lambda df: cut.append(keep(df)) or cut[-1])
    rows = [(k, ("tower", "inlet")[k % 2], 0.0, 0.0, float(k), 1.0, 0.0, 0.0, 1.0, 1.0, 0.0) for k in range(300)]
    K.write_stl_regions(spark.createDataFrame(rows, f"tri_no bigint, solid string, {COORDS}"), str(tmp_path / "m"), "solid", ("inlet", "tower"))
    (text,) = [p.read_text() for p in (tmp_path / "m").glob("part-*")]
    names = [line for line in text.splitlines() if "solid" in line]
    assert names == ["solid inlet", "endsolid inlet", "solid tower", "endsolid tower"] and text.count("endfacet") == 300
    heights = [float(line.split()[3]) for line in text.splitlines() if line.strip().startswith("vertex 0.000 0.000")]
    assert heights == [*range(1, 300, 2), *range(0, 300, 2)]
    assert len(cut) == 1


def test_gap_fill_area_clips_its_features_once(spark, tmp_path):
    from geoloom.plans import catalog_overlay as CO

    rows = spark.range(40).selectExpr("id as c_custkey", "int(id % 25) as c_nationkey", "'BUILDING' as c_mktsegment")
    rows.write.parquet(f"{tmp_path}/customer.parquet")
    out = CO.gap_fill_area(spark, str(tmp_path))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "clip(" not in plan and "MapInArrow" not in plan
    assert [tuple(r) for r in out.collect()] == [(0, True)]


def test_pieces_of_many_tiles_in_one_task(spark):
    square = lambda x, y, a: [[[(x, y), (x + a, y), (x + a, y + a), (x, y + a), (x, y)]]]
    rows = [(None if k % 3 == 0 else k % 3 - 1, k, square(-90.0 + 20 * k, -70.0 + 9 * k, 30.0)) for k in range(9)]
    df = spark.createDataFrame(rows, "region bigint, seq bigint, parts array<array<array<struct<x:double,y:double>>>>")
    tiles = OV.route_to_tiles(OV.edge_rows(df), on=["region"], tile=32.0).coalesce(1)

    def calls(rows, first):
        return pa.RecordBatch.from_arrays([pa.array([len(first)]), pa.array([rows.num_rows])], names=["tiles", "rows"])

    got = [tuple(r) for r in OV._over_tiles(tiles, ["region"], calls, "tiles bigint, rows bigint").collect()]
    assert sum(t for t, _ in got) == tiles.select("region", *OV.TILE_KEYS).distinct().count()
    assert sum(n for _, n in got) == tiles.count() and len(got) == 2  # all but the last tile, and the last
    pieces = OV.clipped_pieces(df, radius=500.0, on=["region"], tile=32.0)
    area = F.sum((F.col("xr_lo") - F.col("xl_lo") + F.col("xr_hi") - F.col("xl_hi")) / 2 * (F.col("y_hi") - F.col("y_lo")))
    found = {(r["region"], r["seq"]): r["a"] for r in pieces.groupBy("region", "seq").agg(area.alias("a")).collect()}
    assert set(found) == {(r[0], r[1]) for r in rows}
    assert all(abs(a - 900.0) < 1e-6 for a in found.values())
