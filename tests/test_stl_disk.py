"""STL files of any size: what writing and reading them keeps on disk, and what broken ones give."""

import random
import re
from collections import Counter

import pytest

from geoloom.schemas import TRI_COLS
from geoloom.sources import meshes as ME
from geoloom.sources import sinks as K

COORDS = ", ".join(f"{c} double" for c in TRI_COLS)


def number(words, k):
    word = words[k] if k < len(words) else ""
    return float(word) if re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", word) else None


def plain(text):
    """``region, tri_no, ax .. cz`` of a file, line by line: the first three corners of a facet, by the solid each stands in."""
    facet, solids, corners, found = 0, [], 0, {}
    for line in re.split(r"\r\n|\r|\n", text):
        line = line.strip(" \t\n\x0b\f\r")
        word = line.split(" ")[0]
        if word == "facet":
            facet, corners = facet + 1, 0
        elif word == "solid":
            solids.append(line[5:].strip())
        elif word == "vertex":
            at = found.setdefault((facet, len(solids)), [None] * 9)
            if corners < 3:
                words = re.split(r"[ \t\x0b\f]+", line)
                at[3 * corners : 3 * corners + 3] = [number(words, k) for k in (1, 2, 3)]
            corners += 1
    return Counter((solids[s - 1], f, *at) for (f, s), at in found.items() if s)


def broken(rng, facets):
    """Text with lines lost, doubled, swapped, moved or misspelt here and there."""
    lines = []
    for k in range(facets):
        if k == 0 or rng.random() < 0.1:
            lines += [f"endsolid s{k}"] * (k > 0) + [rng.choice([f"solid s{k}", "solid", "solid  a b", "\tsolid\tx"])]
        lines += ["  facet normal 0 0 1", "    outer loop", *(f"      vertex {k}.5 {j} -{rng.choice(['1e3', 'nan', '.25', '7.'])}" for j in range(3)), "    endloop", "  endfacet"]
    for _ in range(rng.choice([0, 1, facets])):
        k = rng.randrange(len(lines))
        change = rng.randrange(5)
        if change == 0:
            lines.pop(k)
        elif change == 1:
            lines[k:k] = [lines[k]] * rng.choice([1, 5])
        elif change == 2:
            lines.insert(rng.randrange(len(lines)), lines.pop(k))
        elif change == 3:
            lines[k] = lines[k].replace("facet", "facets").replace(" 0", "  0\t").replace(".5", "x")
        else:
            lines.insert(k, "")
        if not lines:
            break
    return rng.choice(["\n", "\r\n"]).join(lines) + rng.choice(["", "\n"])


@pytest.mark.parametrize("size", [60, 700, 10**7])
def test_broken_stl_files_at_any_split(spark, tmp_path, size):
    rng = random.Random(size)
    texts = {f"f{k}.stl": broken(rng, rng.choice([1, 2, 15] if size < 100 else [2, 15, 60])) for k in range(5 if size < 100 else 9)}
    texts |= {"none.stl": "", "no_facet.stl": "solid a\n" + "vertex 1 2 3\n" * 14 + "solid b\nvertex 1 2 3\n", "no_solid.stl": "facet\nvertex 1 2 3\n" * 9}
    texts["long.stl"] = "solid a\nfacet\n" + "vertex 1 2 3\n" * 14 + "solid b\n" + "vertex 4 5 6\n" * 14 + "facet\n" + "vertex 7 8 9\n" * 5
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    names = {"spark.sql.files.openCostInBytes": "1", "spark.sql.files.maxPartitionBytes": str(size), "spark.sql.execution.arrow.maxRecordsPerBatch": "7" if size == 10**7 else "10000"}
    old = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        got = ME.read_stl(spark, str(tmp_path)).select("path", "region", "tri_no", *TRI_COLS).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for name, text in texts.items():
        assert Counter(tuple(r)[1:] for r in got if r["path"].endswith(f"/{name}")) == plain(text), name


def mesh(spark, n):
    rows = [(k, ("tower", "inlet", None)[k % 3], 0.0, 0.0, float(k), 1.0, 0.0, 0.0, 1.0, 1.0, 0.0) for k in range(n)]
    return spark.createDataFrame(rows, f"tri_no bigint, solid string, {COORDS}")


def test_reading_a_stl_file_stores_triangles_instead_of_lines(spark, tmp_path, monkeypatch):
    K.write_stl_regions(mesh(spark, 3000), str(tmp_path / "m"), "solid", ("inlet", "tower"))
    kept, store = [], ME.stored
    monkeypatch.setattr(ME, "stored", lambda df: kept.append(store(df)) or kept[-1])
    read = ME.read_stl(spark, str(tmp_path / "m"))
    assert read.count() == 2000
    splits = len([p for p in (tmp_path / "m").glob("part-*")]) * spark.sparkContext.defaultParallelism
    # A triangle is one row, beside some rows for the ends of each split; a line none.
    assert sum(df.count() for df in kept) <= 2000 + 10 * splits
    # Only corners at the ends of splits are dealt by facet.
    assert read._jdf.queryExecution().optimizedPlan().toString().count("Window") == 1


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def test_writing_a_stl_file_leaves_no_shuffle_and_packs_its_lines(spark, tmp_path, monkeypatch):
    cut, keep = [], K.cut_lineage
    monkeypatch.setattr(K, "cut_lineage", lambda df: cut.append(keep(df)) or cut[-1])
    triangles, before = mesh(spark, 3000).repartition(5), shuffle_files(spark)
    K.write_stl_regions(triangles, str(tmp_path / "m"), "solid", ("inlet", "empty", "tower"))
    assert not shuffle_files(spark) - before
    (text,) = [p.read_text() for p in (tmp_path / "m").glob("part-*")]
    assert text.count("endfacet") == 2000 and text.startswith("solid inlet\n  facet normal 0.707107 ") and text.endswith("  endfacet\nendsolid tower\n")
    assert "endsolid inlet\nsolid empty\nendsolid empty\nsolid tower\n" in text
    size = cut[0].selectExpr("sum(length(data))").first()[0]
    assert size < len(text) / 5


def test_solids_without_triangles_are_written(spark, tmp_path):
    K.write_stl_regions(mesh(spark, 0), str(tmp_path / "m"), "solid", ("inlet", "tower"))
    (text,) = [p.read_text() for p in (tmp_path / "m").glob("part-*")]
    assert text == "solid inlet\nendsolid inlet\nsolid tower\nendsolid tower\n"
    assert ME.read_stl(spark, str(tmp_path / "m")).count() == 0
