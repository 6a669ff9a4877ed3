"""One large file is read by many tasks: any split gives the rows of a single range."""

import json
import random
import struct
from collections import Counter

import pytest
from test_sources import asc, dbf, polygon_record, shapefile

from geoloom.sources import geojson as G
from geoloom.sources import jsonarray as J
from geoloom.sources import meshes as ME
from geoloom.sources import rasters as RA
from geoloom.sources import shapefile as SH

SPLITS = (40, 97, 1000, 10**6)


def same(read, splits=SPLITS):
    got = [sorted(map(repr, read(s).collect())) for s in splits]
    assert got[-1] and all(g == got[-1] for g in got)
    return got[-1]


def shapes(rng, n):
    """Records of very different lengths, some with numbers that look like record heads."""
    out = []
    for k in range(n):
        if k % 11 == 3:
            out.append(struct.pack("<i", 0))
            continue
        points = [(rng.random(), rng.random()) for _ in range(rng.choice([3, 5, 9, 60]))]
        if k % 5 == 0:  # bytes of a plausible chain: numbers 7, 8, 9 of a null shape each
            fake = b"".join(struct.pack(">2i", 7 + j, 2) + struct.pack("<i", 0) for j in range(8))
            points += [struct.unpack_from("<2d", fake, 16 * j) for j in range(len(fake) // 16)]
        out.append(polygon_record([[*points, points[0]]]))
    return out


@pytest.mark.parametrize("damage", ["none", "cut in content", "cut in head", "empty"])
def test_polygons_at_any_split(spark, tmp_path, damage):
    rng = random.Random(1)
    data = shapefile(5, [] if damage == "empty" else shapes(rng, 60))
    data = {"cut in content": data[:-5], "cut in head": data + b"\x00" * 5}.get(damage, data)
    (tmp_path / "a.shp").write_bytes(data)
    (tmp_path / "b.SHP").write_bytes(shapefile(5, shapes(rng, 3)))
    (tmp_path / "bad.shp").write_bytes(b"y" * 120)
    rows = same(lambda s: SH.read_polygons(spark, str(tmp_path), split=s))
    assert len(rows) == {"none": 64, "cut in content": 64, "cut in head": 65, "empty": 4}[damage]
    assert sum("truncated" in r for r in rows) == (damage.startswith("cut"))


def test_a_record_longer_than_many_ranges(spark, tmp_path):
    rng = random.Random(2)
    ring = [(rng.random(), rng.random()) for _ in range(3000)]
    records = [*shapes(rng, 4), polygon_record([[*ring, ring[0]]]), *shapes(rng, 9)]
    (tmp_path / "long.shp").write_bytes(shapefile(5, records))
    assert len(same(lambda s: SH.read_polygons(spark, str(tmp_path), split=s), (512, 5000, 10**6))) == 14


def test_points_at_any_split(spark, tmp_path):
    rng = random.Random(3)
    single = lambda: struct.pack("<i2d", 1, rng.random(), rng.random())
    records = [single() for _ in range(200)] + [struct.pack("<i4di", 8, 0, 0, 1, 1, 2) + struct.pack("<4d", 1, 2, 5, 6)]
    (tmp_path / "p.shp").write_bytes(shapefile(1, records))
    assert len(same(lambda s: SH.read_points(spark, str(tmp_path), split=s))) == 202


@pytest.mark.parametrize("cut", [0, 3, 40])
def test_tables_at_any_split(spark, tmp_path, cut):
    rng = random.Random(4)
    rows = [(rng.choice(" *  "), f"n{k}", str(k), f"{k},5", rng.choice("YN?")) for k in range(150)]
    data = dbf([("NAME", "C", 8, 0), ("N", "N", 6, 0), ("W", "N", 6, 1), ("L", "L", 1, 0)], rows)
    (tmp_path / "t.dbf").write_bytes(data[: len(data) - cut])
    (tmp_path / "none.dbf").write_bytes(dbf([("A", "C", 3, 0)], []))
    (tmp_path / "bad.dbf").write_bytes(b"\x03" * 20)
    got = same(lambda s: SH.read_attributes(spark, str(tmp_path), split=s))
    assert len(got) == {0: 151, 3: 151, 40: 150}[cut] and sum("truncated table" in r for r in got) == (cut > 0)


def test_a_file_that_only_spark_can_open(spark, tmp_path, monkeypatch):
    from geoloom.sources import ranges

    rng = random.Random(5)
    (tmp_path / "a.shp").write_bytes(shapefile(5, shapes(rng, 20)))
    want = same(lambda s: SH.read_polygons(spark, str(tmp_path), split=s), (100,))
    monkeypatch.setattr(ranges, "DIRECT", set())
    assert same(lambda s: SH.read_polygons(spark, str(tmp_path), split=s), (100,)) == want


@pytest.mark.parametrize("end", ["\n", "\r\n", "none", "blank"])
def test_grids_at_any_split(spark, tmp_path, end):
    rng = random.Random(6)
    values = [[rng.randrange(-9999, 100) for _ in range(7)] for _ in range(31)]
    text = asc(values)
    text = {"\r\n": text.replace("\n", "\r\n"), "none": text.rstrip("\n"), "blank": text + "\n\n1 2\n"}.get(end, text)
    (tmp_path / "a.asc").write_bytes(text.encode())
    (tmp_path / "b.ASC").write_text(asc([[1, 2]]).replace("1 2", ""))
    tiles = RA.read_tiles(spark, str(tmp_path), "dtm")
    rows = same(lambda s: RA.read_cells(spark, tiles, str(tmp_path), split=s), (5, 23, 1000, 10**6))
    cells = {(r["row"], r["col"]): r for r in RA.read_cells(spark, tiles.where("tile = 'a.asc'"), str(tmp_path), split=64).collect()}
    assert len(cells) == 7 * 31 and len(rows) == 7 * 31 + 1  # the empty row of b is one empty value
    for r, line in enumerate(values):
        for c, z in enumerate(line):
            got = cells[r, c]
            assert (got["x"], got["y"], got["z"]) == (2 * c + 1.0, 2 * (31 - r) - 1.0, None if z == -9999 else float(z))


def test_a_box_opens_only_its_tiles(spark, tmp_path):
    for k in range(6):
        (tmp_path / f"t{k}.asc").write_text(asc([[k, k], [k, k]], f"xllcorner {4 * k}\nyllcorner 0"))
    tiles = RA.read_tiles(spark, str(tmp_path), "dtm")
    tiles = spark.createDataFrame(tiles.collect(), tiles.schema)
    for k in (0, 1, 4, 5):  # a tile outside is not opened: its file may be gone
        (tmp_path / f"t{k}.asc").unlink()
    cells = RA.read_cells(spark, tiles, str(tmp_path), box=(8.5, 0.5, 13.5, 2.5)).collect()
    assert sorted((r["tile"], r["x"], r["y"]) for r in cells) == [("t2.asc", 9.0, 1.0), ("t2.asc", 11.0, 1.0), ("t3.asc", 13.0, 1.0)]


def test_grid_header_longer_than_the_first_look(spark, tmp_path):
    (tmp_path / "h.asc").write_text(asc([[1, 2], [3, 4]]).replace("cellsize 2", "cellsize 2" + " " * 9000))
    tiles = RA.read_tiles(spark, str(tmp_path), "dtm")
    assert sorted(r["z"] for r in RA.read_cells(spark, tiles, str(tmp_path)).collect()) == [1.0, 2.0, 3.0, 4.0]


def entries_of(spark, path, key, split):
    return J.array_entries(J.array_parts(spark, path, key, split=split))


ODD = ['"', "\\", '\\"', "]", "[", "{,}", ",", "é ", '"features":[', "\\\\", "\t"]


def odd_values(rng, n):
    out = []
    for k in range(n):
        text = "".join(rng.choice(ODD) for _ in range(rng.randrange(9)))
        out.append(rng.choice([{"id": k, "s": text, "t": {"type": "x", text: [1, [2, [k]]]}}, text, k, None, [text, [text]], {}]))
    return out


@pytest.mark.parametrize("indent", [None, 1])
def test_json_entries_at_any_split(spark, tmp_path, indent):
    rng = random.Random(7)
    want = {}
    for name, n in (("a", 90), ("b", 1), ("c", 0)):
        values = odd_values(rng, n)
        other = {"x": [[1, 2], [3]], "features_": [4, 5], "\\": {"features": [6, 7]}, "s": 'a "features": [8'}
        whole = {**other, "features": values, "type": "Té", "after": [1, 2, {"features": [9]}]}
        (tmp_path / f"{name}.json").write_text(json.dumps(whole, indent=indent, ensure_ascii=name == "a"), encoding="utf-8")
        want[name] = values
    for split in (7, 64, 1000, 10**6):
        got = {name: {} for name in want}
        for r in entries_of(spark, str(tmp_path), "features", split).collect():
            got[r["source"].rsplit("/", 1)[-1][0]][r["pos"]] = json.loads(r["text"])
        assert {k: [v[i] for i in sorted(v)] for k, v in got.items()} == want
        assert all(sorted(v) == list(range(len(v))) for v in got.values())
        files = {r["source"].rsplit("/", 1)[-1][0]: r for r in J.array_files(J.array_parts(spark, str(tmp_path), "features", split=split)).collect()}
        assert {k: (r["type"], r["found"], r["sound"], r["entries"]) for k, r in files.items()} == {k: ("Té", True, True, len(v)) for k, v in want.items()}


@pytest.mark.parametrize("split", [5, 10**6])
def test_json_files_that_are_no_such_object(spark, tmp_path, split):
    for name, text in {"cut": '{"features": [{"a": 1}, {"b', "quote": '{"features": ["a]}', "none": '{"other": []}', "blank": "", "deep": '{"x": {"features": [1]}}'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    parts = J.array_parts(spark, str(tmp_path), "features", split=split)
    good = [r["source"] for r in J.array_files(parts).where("found and sound").collect()]
    assert good == [] and J.array_entries(parts).count() == 0
    assert G.broken_collections(spark, str(tmp_path), split=split).count() == 5 - 1  # an empty file has no range


def test_elements_are_numbered_over_all_files(spark, tmp_path):
    for name, n in (("b", 30), ("a", 20), ("c", 5)):
        rows = [{"type": "node", "id": 100 * ord(name) + k, "lat": 1.0, "lon": 2.0} for k in range(n)]
        (tmp_path / f"{name}.json").write_text(json.dumps({"elements": rows}))
    for split in (50, 10**6):
        got = sorted((r["seq"], r["id"]) for r in G.read_elements(spark, str(tmp_path), split=split).collect())
        assert [s for s, _ in got] == list(range(1, 56))
        assert [i for _, i in got] == [100 * ord(c) + k for c, n in (("a", 20), ("b", 30), ("c", 5)) for k in range(n)]


@pytest.mark.parametrize("size", [70, 900, 10**7])
def test_meshes_at_any_split(spark, tmp_path, size):
    rng = random.Random(8)
    obj, stl = [], []
    for k in range(150):
        obj.append(f"v {k} {k + 1} 0.5")
        if k > 4 and k % 3 == 0:
            obj.append("f " + " ".join(str(rng.choice([-1, -2, -5, 1, 2, k])) for _ in range(rng.choice([3, 4, 5]))))
        if k % 60 == 0:
            obj += ["", "f 9999 1 2"]
    for name, n in (("inlet", 12), ("outlet x", 9), ("tower", 7)):
        stl.append(f"solid {name}")
        for k in range(n):
            stl += ["facet normal 0 0 1", "outer loop", *(f"vertex {k} {j} 0.25" for j in range(3)), "endloop", "endfacet"]
        stl.append(f"endsolid {name}")
    stl.pop(40)  # a facet loses a line
    (tmp_path / "m.obj").write_text("\r\n".join(obj))
    (tmp_path / "m.stl").write_text("\n".join(stl))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        triangles = ME.read_obj(spark, str(tmp_path / "m.obj")).collect()
        bad = [r["line_no"] for r in ME.bad_obj_faces(spark, str(tmp_path / "m.obj")).collect()]
        regions = Counter(r["region"] for r in ME.read_stl(spark, str(tmp_path / "m.stl")).collect())
        errors = ME.stl_errors(spark, str(tmp_path / "m.stl")).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want, seen = [], 0
    for line in obj:
        word = line.split()
        if word[:1] == ["v"]:
            seen += 1
        elif word[:1] == ["f"]:
            refs = [int(r) if int(r) > 0 else seen + int(r) + 1 for r in word[1:]]
            want += [(refs[0], refs[k], refs[k + 1]) for k in range(1, len(refs) - 1)]
    want = [w for w in want if max(w) <= 150]
    assert [(int(t["ax"]) + 1, int(t["bx"]) + 1, int(t["cx"]) + 1) for t in sorted(triangles, key=lambda t: t["tri_no"])] == want
    assert sorted(bad) == [k for k, line in enumerate(obj) if "9999" in line]
    assert regions == {"inlet": 12, "outlet x": 9, "tower": 7} and len(errors) == 1
