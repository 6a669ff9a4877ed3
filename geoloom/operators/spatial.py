"""Bucketed spatial joins.

A bare range condition plans as a nested-loop join, so every spatial join here
is an equi-join on grid cells followed by the exact predicate:

* a point falls into exactly one cell, a box into every cell it touches;
* a pair of boxes is reported only in the cell holding the lower corner of
  their overlap, so no de-duplication shuffle is needed;
* a polygon is sent to a cell as the edges there and the side of the cell's
  reference point (``edgecells``), never whole;
* cells that hold very many rows are *split*: the grid is refined inside them
  (both sides shrink) and what remains is salted in both directions, so one
  crowded square or one pile of identical positions never becomes one task.

The table of crowded cells is cut by ``limit`` before it is broadcast; a cell
outside the first ``HOT_CELLS`` holds less than ``1/HOT_CELLS`` of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import measure as M
from geoloom.operators import edgecells as EC
from geoloom.params import FOOTPRINT_BUFFER_M, INDEX_CELL_M, TREE_TAG_RADIUS_M

HOT_ROWS = 200_000
HOT_CELLS = 65_536
MAX_DEPTH = 6
MAX_SALT = 64

Box = Sequence[str]


def _corners(box: Box, pad: float) -> tuple[Column, Column, Column, Column]:
    if len(box) == 2:
        x, y = F.col(box[0]), F.col(box[1])
        lo_x, lo_y, hi_x, hi_y = x, y, x, y
    else:
        lo_x, lo_y, hi_x, hi_y = (F.col(b) for b in box)
    if pad:
        return lo_x - pad, lo_y - pad, hi_x + pad, hi_y + pad
    return lo_x, lo_y, hi_x, hi_y


def _is_point(box: Box, pad: float) -> bool:
    return len(box) == 2 and not pad


def with_cells(df: DataFrame, box: Box, cell: float, pad: float = 0.0, gx: str = "_gx", gy: str = "_gy") -> DataFrame:
    """One row per grid cell touched by the (padded) box; points keep one row."""
    x0, y0, x1, y1 = _corners(box, pad)
    if _is_point(box, pad):
        return df.withColumns({gx: F.floor(x0 / cell), gy: F.floor(y0 / cell)})
    return df.withColumn(gx, F.explode(F.sequence(F.floor(x0 / cell), F.floor(x1 / cell)))).withColumn(
        gy, F.explode(F.sequence(F.floor(y0 / cell), F.floor(y1 / cell)))
    )


def crowded_cells(sides: list[DataFrame], keys: list[str], hot_rows: int) -> DataFrame:
    """Cells above ``hot_rows``: refinement depth and the salt count of each side (at most ``HOT_CELLS`` rows)."""
    counted = None
    for i, side in enumerate(sides):
        ones = [F.lit(1 if i == j else 0).cast("bigint").alias(f"_n{j}") for j in range(len(sides))]
        part = side.select(*keys, *ones)
        counted = part if counted is None else counted.unionByName(part)
    sums = [F.sum(f"_n{j}").alias(f"_n{j}") for j in range(len(sides))]
    total = sum((F.col(f"_n{j}") for j in range(len(sides))), F.lit(0))
    depth = F.least(F.lit(MAX_DEPTH), F.ceil(F.log2(total / float(hot_rows)) / 2.0).cast("int"))
    salts = [
        F.least(F.lit(MAX_SALT), F.ceil(F.col(f"_n{j}") / float(hot_rows)).cast("int")).alias(f"_s{j}")
        for j in range(len(sides))
    ]
    return (
        counted.groupBy(*keys)
        .agg(*sums)
        .where(total > hot_rows)
        .orderBy(total.desc(), *keys)
        .limit(HOT_CELLS)
        .select(*keys, depth.alias("_depth"), *[F.greatest(s, F.lit(1)).alias(f"_s{j}") for j, s in enumerate(salts)])
    )


def grid_scale() -> Column:
    """How many fine cells replace one base cell per axis."""
    return F.pow(F.lit(2.0), F.col("_depth")).cast("bigint")


def _refine(df: DataFrame, box: Box, cell: float, pad: float) -> DataFrame:
    """Replace base cells by the finer cells chosen for crowded ones."""
    scale = grid_scale()
    x0, y0, x1, y1 = _corners(box, pad)
    fine = lambda v: F.floor(v * scale / cell)
    if _is_point(box, pad):
        return df.withColumns({"_fx": fine(x0), "_fy": fine(y0)})

    def span(lo: Column, hi: Column, base: str) -> Column:
        first, last = F.col(base) * scale, F.col(base) * scale + scale - 1
        return F.explode(F.sequence(F.greatest(fine(lo), first), F.least(fine(hi), last)))

    return df.withColumn("_fx", span(x0, x1, "_gx")).withColumn("_fy", span(y0, y1, "_gy"))


def box_join(
    left: DataFrame,
    right: DataFrame,
    *,
    left_box: Box,
    right_box: Box,
    cell: float,
    on: Sequence[str] = (),
    pad: float = 0.0,
    residual: Column | None = None,
    how: str = "inner",
    left_id: Sequence[str] = (),
    right_id: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
    polygon: str | None = None,
) -> DataFrame:
    """Every pair whose boxes overlap (bounds inclusive, right box padded), exactly once.

    ``on`` are further equality keys present on both sides; all other column
    names must differ. ``residual`` is an exact predicate on the pair. With
    ``how="left_semi"`` the left side must be points and is returned unchanged.
    ``polygon`` names the right side's geometry; with points on the left it
    travels as what each cell needs of it (column ``_local``, see ``edgecells``),
    and pairs in cells outside of it, padding included, are left out.
    """
    if polygon is not None and not _is_point(left_box, 0.0):
        raise ValueError("polygons by cells need points on the left")
    if how == "left_semi" and not _is_point(left_box, 0.0):
        raise ValueError("a semi join needs points on the left")
    keys = [*on, "_gx", "_gy"]
    lc = with_cells(left, left_box, cell)
    if polygon is None:
        rc = with_cells(right, right_box, cell, pad)
    else:
        x0, y0, x1, y1 = _corners(right_box, pad)
        rc = EC.by_rows(EC.with_edges(right, polygon), y0, y1, cell, pad)
        rc = rc.withColumn("_gx", F.explode(F.sequence(F.floor(x0 / cell), F.floor(x1 / cell))))
    join_keys = list(keys)
    if hot_rows is not None:
        hot = F.broadcast(crowded_cells([lc, rc], keys, hot_rows))
        lc, rc = (
            side.join(hot, keys, "left").withColumns(
                {
                    "_depth": F.coalesce("_depth", F.lit(0)),
                    "_s0": F.coalesce("_s0", F.lit(1)),
                    "_s1": F.lit(1) if how == "left_semi" else F.coalesce("_s1", F.lit(1)),
                }
            )
            for side in (lc, rc)
        )
        lc, rc = _refine(lc, left_box, cell, 0.0), _refine(rc, right_box, cell, pad)
        if polygon is not None:
            rc = EC.localized(rc, "_fx", "_fy", cell / grid_scale(), pad)
        spread = lambda cols, s: F.pmod(F.xxhash64(*cols), F.col(s)).cast("int")
        every = lambda s: F.explode(F.sequence(F.lit(0), F.col(s) - 1))
        lc = lc.withColumn("_t0", spread([*left_box, *left_id], "_s0"))
        rc = rc.withColumn("_t0", every("_s0"))
        if how == "left_semi":
            lc, rc = lc.withColumn("_t1", F.lit(0)), rc.withColumn("_t1", F.lit(0))
        else:
            lc = lc.withColumn("_t1", every("_s1"))
            rc = rc.withColumn("_t1", spread([*right_box, *right_id], "_s1"))
        join_keys = [*on, "_depth", "_fx", "_fy", "_t0", "_t1"]
        fx, fy, scale = "_fx", "_fy", grid_scale()
        lc, rc = lc.drop("_s0", "_s1", "_gx", "_gy"), rc.drop("_s0", "_s1", "_gx", "_gy")
    else:
        fx, fy, scale = "_gx", "_gy", F.lit(1)
        if polygon is not None:
            rc = EC.localized(rc, "_gx", "_gy", F.lit(float(cell)), pad)

    renamed = rc.select(*[F.col(c).alias(f"_r_{c}") if c in join_keys else F.col(c) for c in rc.columns])
    lx0, ly0, lx1, ly1 = _corners(left_box, 0.0)
    rx0, ry0, rx1, ry1 = _corners(right_box, pad)
    condition = (lx0 <= rx1) & (lx1 >= rx0) & (ly0 <= ry1) & (ly1 >= ry0)
    for k in join_keys:
        condition = condition & (F.col(k) == F.col(f"_r_{k}"))
    if not _is_point(left_box, 0.0) and not _is_point(right_box, pad):
        condition = (
            condition
            & (F.floor(F.greatest(lx0, rx0) * scale / cell) == F.col(fx))
            & (F.floor(F.greatest(ly0, ry0) * scale / cell) == F.col(fy))
        )
    if residual is not None:
        condition = condition & residual
    joined = lc.join(renamed, condition, how)
    extra = [c for c in join_keys if c not in on]
    return joined.drop(*[f"_r_{k}" for k in join_keys], *extra)


# --- points against polygons ------------------------------------------------------


def polygon_rows(df: DataFrame, parts: str = "parts", polygon: str = "polygon") -> DataFrame:
    """One row per part with its number and bounding box ``px0..py1``; short shells and holes dropped."""
    others = [c for c in df.columns if c != parts]
    rows = df.select(*others, F.posexplode(M.valid_parts(F.col(parts))).alias("polygon_no", polygon))
    box = M.ring_bbox(F.get(F.col(polygon), F.lit(0)))
    return (
        rows.withColumn("_b", box)
        .select(
            *rows.columns,
            F.col("_b.min_x").alias("px0"),
            F.col("_b.min_y").alias("py0"),
            F.col("_b.max_x").alias("px1"),
            F.col("_b.max_y").alias("py1"),
        )
    )


POLY_BOX = ("px0", "py0", "px1", "py1")


def distinct_polygons(polygons: DataFrame, on: Sequence[str] = (), polygon: str = "polygon") -> DataFrame:
    """Collapse identical geometry: enough whenever only "any polygon" matters."""
    return polygons.select(*on, polygon, *POLY_BOX).dropDuplicates([*on, polygon])


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    *,
    xy: tuple[str, str] = ("x", "y"),
    on: Sequence[str] = (),
    cell: float = INDEX_CELL_M,
    point_id: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Points inside at least one polygon (boundary in, strict hole interior out)."""
    return box_join(
        points,
        distinct_polygons(polygons, on),
        left_box=xy,
        right_box=POLY_BOX,
        cell=cell,
        on=on,
        residual=EC.inside(*xy),
        polygon="polygon",
        how="left_semi",
        left_id=point_id,
        hot_rows=hot_rows,
    )


def points_near_polygons(
    points: DataFrame,
    polygons: DataFrame,
    *,
    buffer_m: float = FOOTPRINT_BUFFER_M,
    xy: tuple[str, str] = ("x", "y"),
    on: Sequence[str] = (),
    cell: float = INDEX_CELL_M,
    point_id: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Points within ``buffer_m`` of any ring of a polygon; nothing for a non-positive buffer."""
    if buffer_m <= 0.0:
        return points.where(F.lit(False))
    return box_join(
        points,
        distinct_polygons(polygons, on),
        left_box=xy,
        right_box=POLY_BOX,
        cell=cell,
        on=on,
        pad=buffer_m,
        residual=EC.near_edge(*xy, buffer_m),
        polygon="polygon",
        how="left_semi",
        left_id=point_id,
        hot_rows=hot_rows,
    )


def footprint_hits(
    points: DataFrame,
    polygons: DataFrame,
    *,
    key: Sequence[str],
    xy: tuple[str, str] = ("x", "y"),
    on: Sequence[str] = (),
    buffer_m: float = 0.0,
    cell: float = INDEX_CELL_M,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Points in or near a polygon: ``on, key, inside, near`` from one spatial join (others are absent)."""
    inside = EC.inside(*xy)
    near = EC.near_edge(*xy, buffer_m) if buffer_m > 0.0 else F.lit(False)
    pairs = box_join(
        points.select(*dict.fromkeys([*on, *key, *xy])),
        distinct_polygons(polygons, on),
        left_box=xy,
        right_box=POLY_BOX,
        cell=cell,
        on=on,
        pad=buffer_m,
        residual=inside | near,
        polygon="polygon",
        left_id=key,
        hot_rows=hot_rows,
    )
    ids = list(dict.fromkeys([*on, *key]))
    return pairs.groupBy(*ids).agg(F.bool_or(inside).alias("inside"), F.bool_or(near).alias("near"))


# --- distances between points --------------------------------------------------------


def near_tag_points(
    points: DataFrame,
    tags: DataFrame,
    *,
    radius_m: float = TREE_TAG_RADIUS_M,
    xy: tuple[str, str] = ("x", "y"),
    tag_xy: tuple[str, str] = ("tag_x", "tag_y"),
    on: Sequence[str] = (),
    point_id: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Points with a tag point within ``radius_m`` (inclusive)."""
    dx, dy = F.col(tag_xy[0]) - F.col(xy[0]), F.col(tag_xy[1]) - F.col(xy[1])
    return box_join(
        points,
        tags.select(*on, *tag_xy).dropDuplicates(),
        left_box=xy,
        right_box=tag_xy,
        cell=radius_m,
        on=on,
        pad=radius_m,
        residual=(dx * dx + dy * dy) <= radius_m**2,
        how="left_semi",
        left_id=point_id,
        hot_rows=hot_rows,
    )


def nearest_ground(
    vertices: DataFrame,
    ground: DataFrame,
    *,
    key: Sequence[str],
    xy: tuple[str, str] = ("x", "y"),
    ground_xyz: tuple[str, str, str] = ("gx", "gy", "gz"),
    order: str = "gseq",
    on: Sequence[str] = (),
    cell: float = 2.0,
    max_ring: int = 12,
) -> DataFrame:
    """Ground height at each vertex: own cell, then the first ring of cells with a hit, else the mean.

    Vertices without ground in their own cell are searched from coarse to fine:
    a coarse cell of ``max_ring + 1`` cells a side lists its occupied cells, at
    most nine coarse cells hold all rings of a vertex, and only the occupied
    cells of the nearest ring are opened.
    """
    gx, gy, gz = ground_xyz
    buckets = ground.withColumns({"_bx": F.floor(F.col(gx) / cell), "_by": F.floor(F.col(gy) / cell)})
    todo = vertices.select(*dict.fromkeys([*on, *key]), *xy).withColumns(
        {"_vx": F.floor(F.col(xy[0]) / cell), "_vy": F.floor(F.col(xy[1]) / cell)}
    )
    ids = list(dict.fromkeys([*on, *key]))
    d2 = (F.col(gx) - F.col(xy[0])) ** 2 + (F.col(gy) - F.col(xy[1])) ** 2
    dx, dy = F.col("_bx") - F.col("_vx"), F.col("_by") - F.col("_vy")
    nearest = lambda pairs: pairs.groupBy(*ids).agg(
        F.min_by(F.col(gz), F.struct(d2, dx, dy, F.col(order))).alias("ground_z")
    )
    own = [*on, "_bx", "_by"]
    found = nearest(todo.withColumns({"_bx": F.col("_vx"), "_by": F.col("_vy")}).join(buckets, own))
    if max_ring > 0:
        side = max_ring + 1
        coarse = lambda v: F.floor(v / side)
        occupied = buckets.select(*own).distinct()
        pyramid = occupied.groupBy(*on, coarse(F.col("_bx")).alias("_cx"), coarse(F.col("_by")).alias("_cy")).agg(
            F.collect_list(F.struct("_bx", "_by")).alias("_cells")
        )
        probes = todo.join(found.select(*ids), ids, "left_anti")
        for v, c in (("_vx", "_cx"), ("_vy", "_cy")):
            probes = probes.withColumn(c, F.explode(F.sequence(coarse(F.col(v) - max_ring), coarse(F.col(v) + max_ring))))
        ring = lambda e: F.greatest(F.abs(e["_bx"] - F.col("_vx")), F.abs(e["_by"] - F.col("_vy")))
        probes = probes.join(pyramid, [*on, "_cx", "_cy"]).withColumn("_ring", F.array_min(F.transform("_cells", ring)))
        probes = probes.where(F.col("_ring") <= max_ring)
        # At most nine coarse cells, each with what it holds of its nearest ring.
        rings = probes.groupBy(*ids, *xy, "_vx", "_vy").agg(
            F.min("_ring").alias("_first"),
            F.collect_list(F.struct("_ring", F.filter("_cells", lambda e: ring(e) == F.col("_ring")).alias("c"))).alias("_all"),
        )
        cells = F.flatten(F.transform(F.filter("_all", lambda e: e["_ring"] == F.col("_first")), lambda e: e["c"]))
        opened = rings.select(*ids, *xy, "_vx", "_vy", F.inline(cells))
        found = found.unionByName(nearest(opened.join(buckets, own)))
    if on:
        mean = ground.groupBy(*on).agg(F.avg(gz).alias("_mean"))
        resolved = vertices.join(found, ids, "left").join(mean, list(on), "left")
    else:
        mean = ground.agg(F.avg(gz).alias("_mean"))
        resolved = vertices.join(found, ids, "left").crossJoin(F.broadcast(mean))
    return resolved.withColumn("ground_z", F.coalesce("ground_z", "_mean")).drop("_mean")


def drop_duplicate_trees(
    trees: DataFrame,
    supplements: DataFrame,
    *,
    tolerance_m: float,
    region,
    on: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Mark map trees that repeat a supplemental tree within ``tolerance_m``.

    ``trees``: ``seq, lon, lat``; ``supplements``: ``seq, osm_id, lon, lat``.
    Adds ``nearest_id`` and ``nearest_distance_m`` (null when the tree stays).
    """
    from geoloom.functions.crs import to_local

    if tolerance_m <= 0.0:
        return trees.withColumns(
            {"nearest_id": F.lit(None).cast("string"), "nearest_distance_m": F.lit(None).cast("double")}
        )
    import math

    stretch = 1.0 + 2.0 * abs(math.tan(math.radians(region.center_lat))) * region.outer_radius_m / 6.371e6 + 1e-6
    tx, ty = to_local(F.col("lon"), F.col("lat"), region)
    left = trees.select(*on, "seq", "lon", "lat", tx.alias("_x"), ty.alias("_y"))
    # Identical positions: the first supplement wins the tie, so only it is needed.
    firsts = (
        supplements.groupBy(*on, F.col("lon").alias("s_lon"), F.col("lat").alias("s_lat"))
        .agg(F.min("seq").alias("s_seq"), F.min_by("osm_id", "seq").alias("s_id"))
    )
    sx, sy = to_local(F.col("s_lon"), F.col("s_lat"), region)
    right = firsts.withColumns({"_sx": sx, "_sy": sy})
    distance = M.haversine_m(F.col("lat"), F.col("lon"), F.col("s_lat"), F.col("s_lon"))
    pairs = box_join(
        left,
        right,
        left_box=("_x", "_y"),
        right_box=("_sx", "_sy"),
        cell=max(tolerance_m, 1.0) * 2.0,
        on=on,
        pad=tolerance_m * stretch,
        residual=distance <= tolerance_m,
        left_id=("seq",),
        hot_rows=hot_rows,
    )
    best = pairs.groupBy(*on, "seq").agg(
        F.min_by("s_id", F.struct(distance, F.col("s_seq"))).alias("nearest_id"),
        F.min(distance).alias("nearest_distance_m"),
    )
    return trees.join(best, [*on, "seq"], "left")
