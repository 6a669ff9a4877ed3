"""Map elements to features: geometry assembly, zoning, acceptance, de-duplication, union of sources."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions import attributes as A
from geoloom.functions import crs as C
from geoloom.functions import measure as M
from geoloom.operators.classify import DEFAULT_RULES, Rule, classify, skip_reason
from geoloom.params import Region
from geoloom.schemas import PARTS, PARTS_DDL

#: Vertices or pairs of rings that the nesting looks at together.
SCAN_POINTS = 1_000_000

# Rings cross into Python as flat coordinate arrays with ring lengths.
FLAT_RINGS = T.StructType(
    [
        T.StructField("xs", T.ArrayType(T.DoubleType())),
        T.StructField("ys", T.ArrayType(T.DoubleType())),
        T.StructField("lens", T.ArrayType(T.IntegerType())),
        T.StructField("part", T.ArrayType(T.IntegerType())),
    ]
)


def merge_batches(batches: DataFrame) -> DataFrame:
    """De-duplicate typed elements over extract batches: the last value wins, the first position stays.

    Input columns: ``batch``, ``pos`` and the element. Rows without type or id are dropped.
    """
    payload = [c for c in batches.columns if c not in ("batch", "pos", "type", "id")]
    order = F.struct("batch", "pos")
    return (
        batches.where(F.col("type").isNotNull() & F.col("id").isNotNull())
        .groupBy("type", "id")
        .agg(F.min(order).alias("_first"), F.max_by(F.struct(*payload), order).alias("_last"))
        .select(
            F.col("_first.batch").alias("batch"),
            F.col("_first.pos").alias("pos"),
            "type",
            "id",
            *[F.col(f"_last.{c}").alias(c) for c in payload],
        )
    )


def lonlat_points(points: Column) -> Column:
    """``{lat, lon}`` structs to vertices; incomplete points are skipped."""
    complete = F.filter(points, lambda p: p["lat"].isNotNull() & p["lon"].isNotNull())
    return F.transform(complete, lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y")))


def way_vertices(elements: DataFrame) -> DataFrame:
    """Add ``vertices`` to elements: inline geometry, else coordinates looked up by node id.

    Only ways without inline geometry take part in the node join. The join is
    on node id; a node shared by very many ways stays one small build row.
    """
    nodes = elements.where("type = 'node' and lat is not null and lon is not null").select(
        F.col("id").alias("node_id"), F.struct(F.col("lon").alias("x"), F.col("lat").alias("y")).alias("v")
    )
    # The last of several nodes with one id wins.
    if "seq" in elements.columns:
        nodes = (
            elements.where("type = 'node' and lat is not null and lon is not null")
            .groupBy(F.col("id").alias("node_id"))
            .agg(F.max_by(F.struct(F.col("lon").alias("x"), F.col("lat").alias("y")), "seq").alias("v"))
        )
    refs = (
        elements.where("type = 'way' and geometry is null")
        .select("seq", F.posexplode("nodes").alias("pos", "node_id"))
        .join(nodes, "node_id")
        .groupBy("seq")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("_pts"))
        .select("seq", F.transform("_pts", lambda p: p["v"]).alias("_looked_up"))
    )
    return elements.join(refs, "seq", "left").withColumn(
        "vertices",
        F.when(
            F.col("type") == "way",
            F.coalesce(lonlat_points(F.col("geometry")), F.col("_looked_up")),
        ),
    ).drop("_looked_up")


def _closed_chains(segments: list) -> list:
    """Closed rings of a set of segments that meet at their ends; what does not close is left out.

    One walk along an index of segment ends: a point met again closes the loop
    between its two visits, and a dead end gives up its last segment. Every
    segment is entered once, so the work grows with the number of points.
    """
    lines = [[tuple(p) for p in s] for s in segments]
    at_end: dict[tuple, list[int]] = {}
    for number, line in enumerate(lines):
        for end in (line[0], line[-1]):
            at_end.setdefault(end, []).append(number)
    for waiting in at_end.values():
        waiting.reverse()
    entered = [False] * len(lines)
    rings = []
    for first in lines:
        stops, legs = [first[0]], []
        visited = {first[0]: 0}
        while stops:
            waiting = at_end.get(stops[-1], [])
            while waiting and entered[waiting[-1]]:
                waiting.pop()
            if not waiting:
                # Dead end: the way back.
                del visited[stops.pop()]
                if legs:
                    legs.pop()
                continue
            number = waiting.pop()
            entered[number] = True
            leg = lines[number] if lines[number][0] == stops[-1] else lines[number][::-1]
            goal = leg[-1]
            if goal not in visited:
                visited[goal] = len(stops)
                stops.append(goal)
                legs.append(leg)
                continue
            since = visited[goal]
            ring = [p for part in [*legs[since:], leg] for p in part[:-1]]
            for passed in stops[since + 1 :]:
                del visited[passed]
            del stops[since + 1 :], legs[since:]
            if len(ring) >= 3:
                rings.append([*ring, ring[0]])
    return rings


def _unflatten(xs, ys, lens) -> list[list[tuple[float, float]]]:
    points = list(zip(xs, ys))
    out, at = [], 0
    for n in lens:
        out.append(points[at : at + n])
        at += n
    return out


def _flat_frame(parts_per_row: list[list[list[list]]]) -> pd.DataFrame:
    """Rows of parts (each a list of rings) in flat form."""
    rows = []
    for parts in parts_per_row:
        rings = [(k, r) for k, part in enumerate(parts) for r in part]
        points = [p for _, r in rings for p in r]
        rows.append(([p[0] for p in points], [p[1] for p in points], [len(r) for _, r in rings], [k for k, _ in rings]))
    return pd.DataFrame(rows, columns=["xs", "ys", "lens", "part"])


@F.pandas_udf(FLAT_RINGS)
def _assemble(xs: pd.Series, ys: pd.Series, lens: pd.Series) -> pd.DataFrame:
    return _flat_frame([[_closed_chains(_unflatten(*row))] for row in zip(xs, ys, lens)])


def flat_rings(rings: Column) -> tuple[Column, Column, Column]:
    """``array<array<struct<x,y>>>`` as flat coordinates and ring lengths."""
    axis = lambda name: F.transform(F.flatten(rings), lambda v: v[name])
    return axis("x"), axis("y"), F.transform(rings, lambda r: F.size(r))


def _inflate(flat: Column) -> Column:
    """Flat rings back to ``array<array<struct<x,y>>>``."""

    def ring(f: Column, n: Column, i: Column) -> Column:
        return M.let(
            F.aggregate(F.slice(f["lens"], 1, i), F.lit(0), lambda acc, k: acc + k),
            lambda at: F.transform(
                F.sequence(F.lit(0), n - 1),
                lambda j: F.struct(F.get(f["xs"], at + j).alias("x"), F.get(f["ys"], at + j).alias("y")),
            ),
        )

    return M.let(flat, lambda f: F.transform(f["lens"], lambda n, i: ring(f, n, i)))


def assemble_rings(segments: Column) -> Column:
    """Closed rings from the member segments of one relation."""
    return _inflate(_assemble(*flat_rings(segments)))


def relation_parts(outer: Column, inner: Column) -> Column:
    """Parts of a relation: every outer ring with the inner rings whose first vertex it contains first."""

    def owner(hole: Column) -> Column:
        v = F.get(hole, F.lit(0))
        return F.array_position(F.transform(outer, lambda o: M.point_in_ring(o, v["x"], v["y"])), True)

    def part(o: Column, i: Column) -> Column:
        return F.concat(F.array(o), F.filter(inner, lambda h: owner(h) == i + 1))

    return F.transform(outer, part)


def element_geometry(elements: DataFrame, category: str = "category") -> DataFrame:
    """Add ``geom_type`` and ``parts`` (lon/lat); both null when the geometry is unsupported.

    A closed way is a polygon unless it is a road. A road relation with one
    outer segment and no inner one stays a line.
    """
    df = elements if "vertices" in elements.columns else way_vertices(elements)
    way, node = F.col("type") == "way", F.col("type") == "node"
    line, n = F.col("vertices"), F.size("vertices")
    closed = (n >= 4) & (F.get(line, F.lit(0)) == F.get(line, n - 1))
    road = F.coalesce(F.col(category) == "roads", F.lit(False))
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    simple = df.where(F.coalesce(F.col("type") != "relation", F.lit(True))).withColumns(
        {
            "geom_type": F.when(node & located, F.lit("Point")).when(
                way & (n >= 2), F.when(closed & ~road, F.lit("Polygon")).otherwise(F.lit("LineString"))
            ),
            "parts": F.when(node & located, M.point_parts(F.col("lon"), F.col("lat")))
            .when(way & (n >= 2), F.array(F.array(line)))
            .cast(PARTS_DDL),
        }
    )
    # Only relations go through the ring assembly helper.
    nothing = F.array().cast("array<array<struct<x:double,y:double>>>")

    def member(role: str) -> Column:
        own = F.filter("members", lambda m: F.coalesce(m["role"] == role, F.lit(False)) & m["geometry"].isNotNull())
        lines = F.transform(own, lambda m: lonlat_points(m["geometry"]))
        return F.coalesce(F.filter(lines, lambda s: F.size(s) >= 2), nothing)

    relations = df.where("type = 'relation'").withColumns({"_outer_seg": member("outer"), "_inner_seg": member("inner")})
    relations = relations.withColumns(
        {
            "_outer": assemble_rings(F.col("_outer_seg")),
            "_inner": assemble_rings(F.col("_inner_seg")),
        }
    )
    road_line = road & (F.size("_outer_seg") == 1) & (F.size("_inner_seg") == 0)
    rings = F.size("_outer")
    relations = relations.withColumns(
        {
            "geom_type": F.when(road_line, F.lit("LineString"))
            .when(rings == 1, F.lit("Polygon"))
            .when(rings > 1, F.lit("MultiPolygon")),
            "parts": F.when(road_line, F.array(F.array(F.get("_outer_seg", F.lit(0)))))
            .when(rings >= 1, relation_parts(F.col("_outer"), F.col("_inner")))
            .cast(PARTS_DDL),
        }
    ).drop("_outer_seg", "_inner_seg", "_outer", "_inner")
    return simple.unionByName(relations)


def zone_columns(df: DataFrame, region: Region) -> DataFrame:
    """Add centroid and ROI distance, zone, scope and the flags that follow from geometry."""
    df = df.withColumn("_c", M.vertex_centroid(F.col("geom_type"), F.col("parts"))).withColumns(
        {
            "_cd": M.distance_to_center_m(F.col("_c.x"), F.col("_c.y"), region),
            "_rd": M.roi_distance_m(F.col("geom_type"), C.localize_parts(F.col("parts"), region)),
        }
    )
    return df.withColumns(
        {
            "roi_zone": M.roi_zone(F.col("_rd"), region),
            "centroid_distance_m": F.round("_cd", 3),
            "roi_distance_m": F.round("_rd", 3),
        }
    ).drop("_c", "_cd", "_rd")


def elements_to_features(
    elements: DataFrame,
    region: Region,
    rules: Sequence[Rule] = DEFAULT_RULES,
    roof_default_m: float = 2.0,
) -> DataFrame:
    """All elements as features with ``skip_reason``; accepted rows have a null reason.

    Input: the element columns plus ``seq`` (total order).
    """
    df = elements.withColumn("_cls", classify(F.col("tags"), rules)).withColumns(
        {
            "category": F.col("_cls.category"),
            "group_tag": F.col("_cls.group_tag"),
            "source_tag": F.col("_cls.source_tag"),
        }
    )
    df = zone_columns(element_geometry(way_vertices(df)), region)
    zone = F.col("roi_zone")
    reason = skip_reason(
        F.col("type").isNotNull() | F.col("tags").isNotNull() | F.col("id").isNotNull(),
        F.col("tags"),
        F.col("_cls"),
        F.col("geom_type").isNotNull(),
        zone,
    )
    return df.select(
        F.concat_ws(":", "type", F.col("id").cast("string")).alias("feature_key"),
        "seq",
        F.col("type").alias("osm_type"),
        F.col("id").cast("string").alias("osm_id"),
        F.col("id").alias("osm_num"),
        "category",
        "group_tag",
        "source_tag",
        F.lit("osm").alias("source_type"),
        "geom_type",
        "parts",
        M.contributes(F.col("geom_type")).alias("contributes_to_geometry"),
        M.geometry_role(F.col("geom_type")).alias("geometry_role"),
        "roi_zone",
        M.reconstruction_scope(zone).alias("reconstruction_scope"),
        M.in_lod22(F.col("category"), zone).alias("include_in_lod22"),
        "centroid_distance_m",
        "roi_distance_m",
        F.when(F.col("category") == "buildings", A.building_base_height(F.col("tags"), roof_default_m)).alias(
            "building_base_height_m"
        ),
        "tags",
        reason.alias("skip_reason"),
    )


def canonical_order(features: DataFrame) -> DataFrame:
    """Global output order (a range-partitioned sort)."""
    return features.orderBy("category", "group_tag", "osm_type", "osm_num", "osm_id")


def union_sources(*sources: DataFrame) -> DataFrame:
    """Concatenate feature sources in order; each keeps its rank in ``source_no``."""
    out = None
    for i, source in enumerate(sources):
        part = source.withColumn("source_no", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def enabled_inputs(features: DataFrame, inputs: DataFrame, key: str = "supplemental_input_id") -> DataFrame:
    """Attach input attributes (name, CRS, path); features of disabled inputs never get through."""
    dimension = inputs.where("enabled").drop("enabled").withColumnRenamed("name", key)
    return features.join(dimension, key)


def positional_attributes(shapes: DataFrame, attributes: DataFrame) -> DataFrame:
    """Pair shape ``i`` with attribute row ``i`` of the same file; deleted rows drop their shape.

    ``attributes``: ``file, shape_index, deleted, attrs``. Shapes beyond the
    table keep empty attributes.
    """
    joined = shapes.join(attributes, ["file", "shape_index"], "left")
    return (
        joined.where(~F.coalesce("deleted", F.lit(False)))
        .withColumn("attrs", F.coalesce("attrs", F.create_map().cast("map<string,string>")))
        .drop("deleted")
    )


def supplemental_trees(points: DataFrame, region: Region) -> DataFrame:
    """Inventory points (``lon, lat, stem, record_number, point_index, input_name, attrs, seq``) as tree features."""
    distance = M.point_roi_distance_m(F.col("lon"), F.col("lat"), region)
    base = F.concat(F.col("stem"), F.lit("_"), F.col("record_number").cast("string"))
    with_zone = points.withColumns({"_d": distance}).withColumn("roi_zone", M.roi_zone(F.col("_d"), region))
    return with_zone.where("roi_zone is not null").select(
        "seq",
        F.lit("supplemental").alias("osm_type"),
        F.when(F.col("point_index") > 1, F.concat(base, F.lit("_"), F.col("point_index").cast("string")))
        .otherwise(base)
        .alias("osm_id"),
        F.lit("trees").alias("category"),
        F.lit("tree").alias("group_tag"),
        F.concat(F.lit("supplemental="), "input_name").alias("source_tag"),
        F.lit("supplemental").alias("source_type"),
        F.col("input_name").alias("supplemental_input_id"),
        F.lit("Point").alias("geom_type"),
        M.point_parts(F.col("lon"), F.col("lat")).alias("parts"),
        F.lit(False).alias("contributes_to_geometry"),
        F.lit("reference_only_non_contributing").alias("geometry_role"),
        "roi_zone",
        M.reconstruction_scope(F.col("roi_zone")).alias("reconstruction_scope"),
        F.lit(False).alias("include_in_lod22"),
        F.round(M.distance_to_center_m(F.col("lon"), F.col("lat"), region), 3).alias("centroid_distance_m"),
        F.round("_d", 3).alias("roi_distance_m"),
        A.tree_tags(F.col("attrs")).alias("tags"),
        F.to_json("attrs").alias("source_attributes"),
    )


def supplemental_surfaces(clipped: DataFrame, region: Region) -> DataFrame:
    """Inventory polygons already clipped to the ROI, as surface features.

    Input: ``seq, stem, record_number, polygon_index, input_name, category,
    group_tag, parts`` (lon/lat), ``area_m2``, ``attrs``.
    """
    base = F.concat(F.col("stem"), F.lit("_"), F.col("record_number").cast("string"))
    named = clipped.withColumns(
        {
            "geom_type": F.when(F.size("parts") == 1, F.lit("Polygon")).otherwise(F.lit("MultiPolygon")),
            "osm_id": F.when(
                F.col("polygon_index") > 1, F.concat(base, F.lit("_"), F.col("polygon_index").cast("string"))
            ).otherwise(base),
        }
    )
    zoned = zone_columns(named, region).where("roi_zone is not null")
    return zoned.select(
        "seq",
        F.lit("supplemental").alias("osm_type"),
        "osm_id",
        "category",
        "group_tag",
        F.concat(F.lit("supplemental="), "input_name").alias("source_tag"),
        F.lit("supplemental").alias("source_type"),
        F.col("input_name").alias("supplemental_input_id"),
        "geom_type",
        "parts",
        F.lit(True).alias("contributes_to_geometry"),
        F.lit("polygon_surface").alias("geometry_role"),
        "roi_zone",
        M.reconstruction_scope(F.col("roi_zone")).alias("reconstruction_scope"),
        M.in_lod22(F.col("category"), F.col("roi_zone")).alias("include_in_lod22"),
        "centroid_distance_m",
        "roi_distance_m",
        F.round("area_m2", 3).alias("area_m2"),
        F.create_map().cast("map<string,string>").alias("tags"),
        F.to_json("attrs").alias("source_attributes"),
    )


def is_map_tree(category: Column, source_tag: Column, source_type: Column) -> Column:
    return (category == "trees") & (source_tag == "natural=tree") & F.coalesce(source_type != "supplemental", F.lit(True))


def footprint_eligible(geom_type: Column, contributes: Column, lod22: Column) -> Column:
    """Footprints for the point cloud: polygonal, both flags true or absent."""
    return M.contributes(geom_type) & F.coalesce(contributes, F.lit(True)) & F.coalesce(lod22, F.lit(True))


# Nesting of the rings of one record -----------------------------------------------------


def _even_odd_groups(rings: list) -> list:
    """Rings of one record as polygons: shell first, then its holes.

    The depth of a ring is the number of larger rings around one of its inner
    points. Rings of even depth are shells; a ring of odd depth is a hole of the
    smallest shell one level above it.
    """
    xy = [np.asarray(r, float) for r in rings if len(r) >= 4]
    sizes = np.array([abs(_twice_area(c)) for c in xy])
    keep = np.flatnonzero(sizes > 0.0)
    if not len(keep):
        return []
    xy, sizes = [xy[k] for k in keep], sizes[keep]
    named = [r for r in rings if len(r) >= 4]
    points = np.array([_inner_point(c) for c in xy])
    around = np.stack([_surrounds(c, points) for c in xy], axis=1) & (sizes[None, :] > sizes[:, None])
    depth = around.sum(axis=1)
    shell = depth % 2 == 0
    above = np.where(around & (depth[None, :] == depth[:, None] - 1), sizes[None, :], np.inf)
    owner = np.where(shell, np.arange(len(xy)), above.argmin(axis=1))
    return [
        [named[keep[i]], *(named[keep[j]] for j in np.flatnonzero((owner == i) & ~shell))] for i in np.flatnonzero(shell)
    ]


def _twice_area(c: np.ndarray) -> float:
    return float((c[:, 0] * np.roll(c[:, 1], -1) - np.roll(c[:, 0], -1) * c[:, 1]).sum())


def _scan(c: np.ndarray, y) -> tuple[np.ndarray, np.ndarray]:
    """For each height in ``y``: which edges of the ring cross it, and at which x."""
    a, b, y = c, np.roll(c, -1, axis=0), np.atleast_1d(y)[:, None]
    crossing = (a[:, 1] > y) != (b[:, 1] > y)
    rise = np.where(a[:, 1] == b[:, 1], 1.0, b[:, 1] - a[:, 1])
    return crossing, a[:, 0] + (y - a[:, 1]) * (b[:, 0] - a[:, 0]) / rise


def _inner_point(c: np.ndarray) -> tuple[float, float]:
    """Middle of the widest stretch inside the ring, on a height between two neighbouring vertex heights."""
    heights = np.unique(c[:, 1])
    middle = (heights[0] + heights[-1]) / 2.0
    k = min(int(np.searchsorted(heights, middle, "right")), len(heights) - 1)
    y = (heights[k - 1] + heights[k]) / 2.0
    crossing, x = _scan(c, y)
    at = np.sort(x[0][crossing[0]])
    if len(at) < 2:
        return float(c[0, 0]), float(y)
    wide = at[1::2] - at[: len(at) // 2 * 2 : 2]
    best = int(wide.argmax())
    return float(at[2 * best] + at[2 * best + 1]) / 2.0, float(y)


def _surrounds(c: np.ndarray, points: np.ndarray) -> np.ndarray:
    crossing, x = _scan(c, points[:, 1])
    return (crossing & (points[:, :1] < x)).sum(axis=1) % 2 == 1


def _by_size(lens: np.ndarray, which: np.ndarray):
    """Members of ``which`` of equal ring length, at most ``SCAN_POINTS`` vertices at once: ``(length, members)``."""
    which = which[np.argsort(lens[which], kind="stable")]
    cuts = np.flatnonzero(np.diff(lens[which])) + 1
    for part in np.split(which, cuts):
        if len(part):
            n = int(lens[part[0]])
            step = max(1, SCAN_POINTS // n)
            for at in range(0, len(part), step):
                yield n, part[at : at + step]


def _batch_nesting(x: np.ndarray, y: np.ndarray, lens: np.ndarray, record: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_even_odd_groups` for the rings of many records at once: ring numbers in output order and the shell of each."""
    start = np.cumsum(lens) - lens
    sizes, px, py = np.zeros(len(lens)), np.zeros(len(lens)), np.zeros(len(lens))
    low, high = np.zeros(len(lens)), np.zeros(len(lens))
    for n, rings in _by_size(lens, np.flatnonzero(lens >= 4)):
        at = start[rings][:, None] + np.arange(n)
        a, b = x[at], y[at]
        sizes[rings] = np.abs((a * np.roll(b, -1, axis=1) - np.roll(a, -1, axis=1) * b).sum(axis=1))
        low[rings], high[rings] = b.min(axis=1), b.max(axis=1)
        px[rings], py[rings] = _inner_points(a, b)
    keep = np.flatnonzero(sizes > 0.0)
    # Rings of one record stand together; `first` and `count` are those of a ring's record among the kept ones.
    of = record[keep]
    first, end = np.searchsorted(of, of, "left"), np.searchsorted(of, of, "right")
    inner, outer = [], []
    for at in _pair_blocks(end - first):
        j = np.repeat(at, (end - first)[at])
        i = np.arange(len(j)) - np.repeat(np.cumsum((end - first)[at]) - (end - first)[at], (end - first)[at]) + first[j]
        larger = (sizes[keep[i]] > sizes[keep[j]]) & (py[keep[j]] >= low[keep[i]]) & (py[keep[j]] < high[keep[i]])
        i, j = i[larger], j[larger]
        around = np.zeros(len(i), bool)
        for n, pairs in _by_size(lens[keep[i]], np.arange(len(i))):
            at_ = start[keep[i[pairs]]][:, None] + np.arange(n)
            point = keep[j[pairs]]
            crossing, cut = _scan_rows(x[at_], y[at_], py[point])
            around[pairs] = (crossing & (px[point][:, None] < cut)).sum(axis=1) % 2 == 1
        inner.append(j[around])
        outer.append(i[around])
    j, i = np.concatenate([np.zeros(0, np.int64), *inner]), np.concatenate([np.zeros(0, np.int64), *outer])
    depth = np.bincount(j, minlength=len(keep))
    shell = depth % 2 == 0
    owner = np.where(shell, np.arange(len(keep)), first)
    above = ~shell[j] & (depth[i] == depth[j] - 1)
    j, i = j[above], i[above]
    order = np.lexsort((i, sizes[keep[i]], j))
    j, i = j[order], i[order]
    nearest = np.flatnonzero(np.diff(j, prepend=-1))
    owner[j[nearest]] = i[nearest]
    out = np.flatnonzero(shell[owner])
    out = out[np.lexsort((out, ~shell[out], owner[out]))]
    return keep[out], keep[owner[out]]


def _pair_blocks(counts: np.ndarray):
    """Numbers of rings in runs whose pairs with the rings of their record are some ``SCAN_POINTS`` at most."""
    total = np.cumsum(counts)
    block = (total - counts) // SCAN_POINTS
    cuts = np.flatnonzero(np.diff(block)) + 1
    return [part for part in np.split(np.arange(len(counts)), cuts) if len(part)]


def _scan_rows(a: np.ndarray, b: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_scan` for rings of equal length, one height each."""
    y = y[:, None]
    nx, ny = np.roll(a, -1, axis=1), np.roll(b, -1, axis=1)
    crossing = (b > y) != (ny > y)
    rise = np.where(b == ny, 1.0, ny - b)
    return crossing, a + (y - b) * (nx - a) / rise


def _inner_points(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_inner_point` for rings of equal length."""
    top = b.max(axis=1)
    middle = (b.min(axis=1) + top) / 2.0
    upper = np.minimum(np.where(b > middle[:, None], b, np.inf).min(axis=1), top)
    lower = np.where(b < upper[:, None], b, -np.inf).max(axis=1)
    y = (lower + upper) / 2.0
    crossing, cut = _scan_rows(a, b, y)
    at = np.sort(np.where(crossing, cut, np.inf), axis=1)
    found = crossing.sum(axis=1)
    half = a.shape[1] // 2
    real = 2 * np.arange(half) + 1 < found[:, None]
    wide = np.where(real, np.where(real, at[:, 1 : 2 * half : 2], 0.0) - np.where(real, at[:, 0 : 2 * half : 2], 0.0), -np.inf)
    best = wide.argmax(axis=1)
    row = np.arange(len(a))
    return np.where(found < 2, a[:, 0], (at[row, 2 * best] + at[row, 2 * best + 1]) / 2.0), y


@F.arrow_udf(PARTS)
def _nested(xs: pa.Array, ys: pa.Array, lens: pa.Array) -> pa.Array:
    x, y = (v.flatten().to_numpy(zero_copy_only=False).astype(float) for v in (xs, ys))
    sizes = lens.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = len(lens)
    record = np.repeat(np.arange(rows), lens.value_lengths().to_numpy(zero_copy_only=False))
    with np.errstate(invalid="ignore", over="ignore"):
        ring, shell = _batch_nesting(x, y, sizes, record)
    new = np.diff(shell, prepend=-1) != 0
    start = np.cumsum(sizes) - sizes
    ends = np.cumsum(sizes[ring])
    vertex = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[ring] - (ends - sizes[ring]), sizes[ring])
    offsets = lambda ends: pa.array(np.concatenate([[0], ends]), pa.int32())
    points = pa.StructArray.from_arrays([xs.flatten().take(pa.array(vertex)), ys.flatten().take(pa.array(vertex))], ["x", "y"])
    rings = pa.ListArray.from_arrays(offsets(ends), points)
    polygons = pa.ListArray.from_arrays(offsets(np.append(np.flatnonzero(new)[1:], len(ring)) if len(ring) else []), rings)
    per_row = np.bincount(record[ring[new]], minlength=rows)
    return pa.ListArray.from_arrays(offsets(np.cumsum(per_row)), polygons)


def nest_rings(xs: Column, ys: Column, lens: Column) -> Column:
    """Rings of one record, in flat form, to ``parts``; a record's rings are independent of all others."""
    return _nested(xs, ys, lens)
