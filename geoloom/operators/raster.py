"""Elevation rasters: tile pairing, evidence, classification, statistics and alignment.

``TILE`` rows: ``layer, tile, ncols, nrows, xll, yll, cellsize, nodata``.
``CELL`` rows: ``tile, row, col, x, y, ground_z, surface_z`` with null for nodata.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom import params as P
from geoloom.functions import measure as M
from geoloom.operators import edgecells as EC
from geoloom.operators.ordering import stride_sample
from geoloom.operators.skew import cut_lineage
from geoloom.operators.spatial import (
    POLY_BOX,
    box_join,
    distinct_polygons,
    footprint_hits,
    near_tag_points,
)

Bbox = tuple[float, float, float, float]


# --- tiles ------------------------------------------------------------------------------


def tile_intersects(bbox: Bbox, xll="xll", yll="yll", ncols="ncols", nrows="nrows", cellsize="cellsize") -> Column:
    x0, y0, x1, y1 = bbox
    right = F.col(xll) + F.col(ncols) * F.col(cellsize)
    top = F.col(yll) + F.col(nrows) * F.col(cellsize)
    return ~((right < x0) | (F.col(xll) > x1) | (top < y0) | (F.col(yll) > y1))


def pair_tiles(dtm: DataFrame, dsm: DataFrame, bbox: Bbox) -> DataFrame:
    """Full outer pairing by exact tile name with ``status`` and ``violation``.

    Grids of a pair must be identical everywhere; an unmatched tile is a
    violation only when it touches the region.
    """
    fields = ("ncols", "nrows", "cellsize", "xll", "yll")
    left = dtm.select("tile", *[F.col(c).alias(f"g_{c}") for c in fields], F.lit(True).alias("_g"))
    right = dsm.select("tile", *[F.col(c).alias(f"s_{c}") for c in fields], F.lit(True).alias("_s"))
    joined = left.join(right, "tile", "full")
    same = F.lit(True)
    for c in fields:
        same = same & (F.col(f"g_{c}") == F.col(f"s_{c}"))
    for c in fields:
        joined = joined.withColumn(c, F.coalesce(f"g_{c}", f"s_{c}"))
    paired = F.col("_g").isNotNull() & F.col("_s").isNotNull()
    touches = tile_intersects(bbox)
    return joined.select(
        "tile",
        *fields,
        F.when(paired & touches, F.lit("used"))
        .when(paired, F.lit("skipped"))
        .when(F.col("_g").isNotNull(), F.lit("only_dtm"))
        .otherwise(F.lit("only_dsm"))
        .alias("status"),
        F.when(paired & ~same, F.lit("grid_mismatch"))
        .when(~paired & touches & F.col("_g").isNotNull(), F.lit("unmatched_dtm"))
        .when(~paired & touches, F.lit("unmatched_dsm"))
        .alias("violation"),
    )


def raster_summary(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return pairs.groupBy(*by).agg(
        F.count_if(F.col("status").isin("used", "skipped")).alias("paired_tile_count"),
        F.count_if(F.col("status") == "used").alias("used_tile_count"),
        F.count_if(F.col("status") == "skipped").alias("skipped_tile_count"),
        F.count("violation").alias("violation_count"),
    )


def pair_cells(ground: DataFrame, surface: DataFrame, used_tiles: DataFrame | None = None, on: Sequence[str] = ()) -> DataFrame:
    """Join the two layers cell by cell; tiles outside the region are pruned before the join."""
    keys = [*on, "tile", "row", "col"]
    if used_tiles is not None:
        names = used_tiles.select(*on, "tile")
        ground = ground.join(names, [*on, "tile"], "left_semi")
        surface = surface.join(names, [*on, "tile"], "left_semi")
    return ground.select(*keys, "x", "y", F.col("z").alias("ground_z")).join(
        surface.select(*keys, F.col("z").alias("surface_z")), keys
    )


def valid_cells(cells: DataFrame, bbox: Bbox | None = None) -> DataFrame:
    """Cells with both layers present and the centre inside the box (inclusive)."""
    kept = cells.where("ground_z is not null and surface_z is not null")
    if bbox is None:
        return kept
    x0, y0, x1, y1 = bbox
    return kept.where(F.col("x").between(x0, x1) & F.col("y").between(y0, y1))


def local_relief(cells: DataFrame, *, radius_cells: int, by: Sequence[str] = ("tile",), z: str = "surface_z") -> DataFrame:
    """Height above the lowest neighbour in a square window of the same tile (nodata ignored).

    The square minimum separates into a row pass and a column pass, so the cost
    per cell does not depend on the window size. Including the centre cell
    cannot change ``max(0, z - min)``.
    """
    rows = Window.partitionBy(*by, "row").orderBy("col").rangeBetween(-radius_cells, radius_cells)
    cols = Window.partitionBy(*by, "col").orderBy("row").rangeBetween(-radius_cells, radius_cells)
    swept = cells.withColumn("_row_min", F.min(z).over(rows)).withColumn("_min", F.min("_row_min").over(cols))
    return swept.withColumn("relief", F.greatest(F.lit(0.0), F.col(z) - F.col("_min"))).drop("_row_min", "_min")


def relief_radius_cells(cellsize: float) -> int:
    return max(1, int(np.ceil(P.RELIEF_RADIUS_M / cellsize)))


# --- canopy overlay -----------------------------------------------------------------------


def is_vegetation() -> Column:
    excess = 2 * F.col("g") - F.col("r") - F.col("b")
    return (F.col("a") >= P.CANOPY_MIN_ALPHA) & (F.col("g") >= P.CANOPY_MIN_GREEN) & (excess >= P.CANOPY_EXCESS_GREEN)


def canopy_pixels(pixels: DataFrame, *, on: Sequence[str] = (), radius: int = P.CANOPY_RADIUS_PX) -> DataFrame:
    """Overlay pixels with vegetation in their neighbourhood (dilation of the mask)."""
    offsets = F.array(*[F.lit(i) for i in range(-radius, radius + 1)])
    return (
        pixels.where(is_vegetation())
        .select(*on, "row", "col")
        .withColumn("_dr", F.explode(offsets))
        .withColumn("_dc", F.explode(offsets))
        .select(*on, (F.col("row") + F.col("_dr")).alias("px_row"), (F.col("col") + F.col("_dc")).alias("px_col"))
        .distinct()
    )


def canopy_evidence(
    cells: DataFrame, pixels: DataFrame, *, bbox: Bbox, width: int, height: int, on: Sequence[str] = ()
) -> DataFrame:
    """Cells inside the overlay whose pixel neighbourhood holds vegetation."""
    x0, y0, x1, y1 = bbox
    col = F.least(F.lit(width - 1), F.greatest(F.lit(0), ((F.col("x") - x0) / (x1 - x0) * width).cast("int")))
    row = F.least(F.lit(height - 1), F.greatest(F.lit(0), ((F.lit(y1) - F.col("y")) / (y1 - y0) * height).cast("int")))
    located = cells.where(F.col("x").between(x0, x1) & F.col("y").between(y0, y1)).withColumns(
        {"px_row": row, "px_col": col}
    )
    return located.join(canopy_pixels(pixels, on=on), [*on, "px_row", "px_col"], "left_semi").drop("px_row", "px_col")


# --- roof level ------------------------------------------------------------------------------


def _roof_level(x: np.ndarray, y: np.ndarray, z: np.ndarray, d2: np.ndarray, surface_z: float) -> float | None:
    """Roof height among samples around one candidate: cluster, then pick by height and distance."""
    if x is None or len(x) == 0:
        return None
    near = np.square(x[:, None] - x[None, :]) + np.square(y[:, None] - y[None, :]) <= P.ROOF_CLUSTER_RADIUS_M**2
    linked = near & (np.abs(z[:, None] - z[None, :]) <= P.ROOF_CLUSTER_Z_M)
    label = np.arange(len(x))
    while True:
        spread = np.where(linked, label[None, :], len(x)).min(axis=1)
        spread = spread[spread]
        if (spread == label).all():
            break
        label = spread
    order = np.lexsort((z, label))
    first = np.flatnonzero(np.r_[True, np.diff(label[order]) != 0])
    size = np.diff(np.r_[first, len(x)])
    roof = z[order][first + (size - 1) // 2]
    nearest = np.minimum.reduceat(d2[order], first)
    below = roof <= surface_z + P.ROOF_CLUSTER_Z_M
    close = below & (np.abs(surface_z - roof) < P.ROOF_OFFSET_M)
    pool = close if close.any() else below if below.any() else np.ones(len(roof), bool)
    return float(roof[pool][np.argmin(nearest[pool])])


@F.pandas_udf(T.DoubleType())
def roof_level(x: pd.Series, y: pd.Series, z: pd.Series, d2: pd.Series, surface_z: pd.Series) -> pd.Series:
    """Roof height from the samples within the search radius (bounded arrays per candidate)."""
    return pd.Series([_roof_level(*row) for row in zip(x, y, z, d2, surface_z)], dtype="float64")


def estimate_roofs(
    candidates: DataFrame,
    roof_cells: DataFrame,
    *,
    key: Sequence[str],
    on: Sequence[str] = ("tile",),
    radius: float = P.ROOF_SEARCH_RADIUS_M,
) -> DataFrame:
    """Candidates with ``roof_z`` (null when no roof sample is near); samples of the same tile only.

    The collected array holds the raster cells within ``radius`` of one
    candidate, so its size is bounded by the raster resolution.
    """
    right = roof_cells.select(*on, F.col("x").alias("rx"), F.col("y").alias("ry"), F.col("surface_z").alias("rz"))
    d2 = (F.col("rx") - F.col("x")) ** 2 + (F.col("ry") - F.col("y")) ** 2
    ids = list(dict.fromkeys([*on, *key]))
    pairs = box_join(
        candidates.select(*ids, "x", "y", "surface_z"),
        right,
        left_box=("x", "y"),
        right_box=("rx", "ry"),
        cell=radius,
        on=on,
        pad=radius,
        residual=(d2 > 0.0) & (d2 <= radius**2),
        left_id=key,
        right_id=("rz",),
    )
    sample = F.struct(F.col("rx").alias("x"), F.col("ry").alias("y"), F.col("rz").alias("z"), d2.alias("d2"))
    near = pairs.groupBy(*ids, "surface_z").agg(F.array_sort(F.collect_list(sample)).alias("_samples"))
    axis = lambda name: F.transform("_samples", lambda s: s[name])
    levels = near.select(
        *ids, roof_level(axis("x"), axis("y"), axis("z"), axis("d2"), F.col("surface_z")).alias("roof_z")
    )
    return candidates.join(levels, ids, "left")


# --- classification -----------------------------------------------------------------------------


def classify_cells(
    cells: DataFrame,
    polygons: DataFrame,
    *,
    bbox: Bbox | None,
    on: Sequence[str] = (),
    key: Sequence[str] = ("tile", "row", "col"),
    relief_cells: int | None = None,
    canopy: dict | None = None,
    tags: DataFrame | None = None,
) -> DataFrame:
    """Every valid cell with evidence columns and exactly one ``class``.

    ``canopy`` (``pixels, bbox, width, height``) switches the tree branch on;
    without it no tree class exists at all. Cheap filters (nodata, box, height)
    run before the spatial joins, and roof levels are estimated only for
    candidates that need one.
    """
    ids = list(dict.fromkeys([*on, *key]))
    tile_keys = [k for k in ids if k not in ("row", "col")]
    base = cells
    if canopy is not None:
        base = local_relief(base, radius_cells=relief_cells or 1, by=tile_keys)
    valid = valid_cells(base, bbox).withColumn("height", F.col("surface_z") - F.col("ground_z"))
    no, yes = F.lit(False), F.lit(True)
    buffer_m = P.FOOTPRINT_BUFFER_M if canopy is not None else 0.0
    # Footprints matter from the lowest height that any class below asks for.
    high = valid.where(F.col("height") >= min(P.BUILDING_HEIGHT_M, P.TREE_HEIGHT_M))
    hits = footprint_hits(high, polygons, key=ids, on=on, buffer_m=buffer_m).withColumns({"vegetation": no, "tagged": no})
    if canopy is not None:
        tall = valid.where(F.col("height") >= P.TREE_HEIGHT_M)
        flag = lambda df, name: df.select(
            *ids, *[(yes if c == name else no).alias(c) for c in ("inside", "near", "vegetation", "tagged")]
        )
        hits = hits.unionByName(flag(canopy_evidence(tall, on=on, **canopy), "vegetation"))
        if tags is not None:
            hits = hits.unionByName(flag(near_tag_points(tall, tags, on=on, point_id=ids), "tagged"))
        hits = hits.groupBy(*ids).agg(*[F.bool_or(c).alias(c) for c in ("inside", "near", "vegetation", "tagged")])
    # One join brings all kinds of evidence to the cells.
    evidence = valid.join(hits, ids, "left").withColumns(
        {c: F.coalesce(c, no) for c in ("inside", "near", "vegetation", "tagged")}
    ).withColumn("zone", F.col("inside") | F.col("near"))
    if canopy is None:
        evidence, tree = evidence.withColumn("roof_z", F.lit(None).cast("double")), no
    else:
        # The roof step reads the evidence three times (candidates, samples, result).
        evidence = cut_lineage(evidence)
        candidate = (F.col("height") >= P.TREE_HEIGHT_M) & (F.col("vegetation") | F.col("tagged"))
        roofs = evidence.where((F.col("height") >= P.BUILDING_HEIGHT_M) & F.col("inside"))
        levels = estimate_roofs(evidence.where(candidate & F.col("zone")), roofs, key=ids, on=tile_keys).select(*ids, "roof_z")
        evidence = evidence.join(levels, ids, "left")
        offset = F.abs(F.col("surface_z") - F.col("roof_z")) >= P.ROOF_OFFSET_M
        tree = candidate & F.when(F.col("zone"), F.coalesce(offset, no)).otherwise(
            F.coalesce(F.col("relief") >= P.RELIEF_THRESHOLD_M, no)
        )
    return evidence.withColumn(
        "class",
        F.when(tree, F.lit("tree"))
        .when((F.col("height") >= P.BUILDING_HEIGHT_M) & F.col("inside"), F.lit("building"))
        .otherwise(F.lit("unclassified")),
    )


def point_cloud(classified: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """One ground row and one surface row per cell: ``x, y, z, class``."""
    rows = F.array(
        F.struct(F.col("ground_z").alias("z"), F.lit("ground").alias("class")),
        F.struct(F.col("surface_z").alias("z"), F.col("class").alias("class")),
    )
    return classified.select(*on, "x", "y", F.explode(rows).alias("_p")).select(
        *on, "x", "y", F.col("_p.z").alias("z"), F.col("_p.class").alias("class")
    )


def class_counts(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Point counts per class and the completeness check."""
    n = lambda c: F.count_if(F.col("class") == c)
    return classified.groupBy(*by).agg(
        F.count("*").alias("ground_points"),
        n("building").alias("building_points"),
        n("tree").alias("tree_points"),
        n("unclassified").alias("unclassified_points"),
        F.count_if(F.col("height") >= P.BUILDING_HEIGHT_M).alias("alignment_candidates"),
        (F.count("*") == n("building") + n("tree") + n("unclassified")).alias("complete"),
    )


def tree_filter_counts(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The nine counters of the tree branch."""
    cand = (F.col("height") >= P.TREE_HEIGHT_M) & (F.col("vegetation") | F.col("tagged"))
    zone, has_roof = cand & F.col("zone"), F.col("roof_z").isNotNull()
    offset = F.abs(F.col("surface_z") - F.col("roof_z")) >= P.ROOF_OFFSET_M
    return classified.groupBy(*by).agg(
        F.count_if(cand).alias("evidence_candidate_count"),
        F.count_if(cand & F.col("tagged")).alias("tree_tag_supported_candidate_count"),
        F.count_if(zone).alias("building_footprint_candidate_count"),
        F.count_if(zone & ~F.col("inside")).alias("building_footprint_buffer_candidate_count"),
        F.count_if(zone & ~has_roof).alias("building_footprint_without_roof_estimate_count"),
        F.count_if(zone & has_roof).alias("roof_estimate_candidate_count"),
        F.count_if(zone & has_roof & offset).alias("roof_offset_pass_count"),
        F.count_if(cand & ~F.col("zone")).alias("local_relief_fallback_candidate_count"),
        F.count_if(cand & ~F.col("zone") & (F.col("relief") >= P.RELIEF_THRESHOLD_M)).alias("local_relief_pass_count"),
    )


# --- statistics -------------------------------------------------------------------------------


def cell_statistics(points: DataFrame, *, z: str, how: str, on: Sequence[str] = (), cell: float = P.STATS_CELL_M) -> DataFrame:
    """Minimum (ground) or maximum (roof) height per square cell."""
    if how not in ("min", "max"):
        raise ValueError("how must be 'min' or 'max'")
    agg = F.min(z) if how == "min" else F.max(z)
    return points.groupBy(
        *on, F.floor(F.col("x") / cell).alias("cell_x"), F.floor(F.col("y") / cell).alias("cell_y")
    ).agg(agg.alias("z"))


def zonal_heights(
    polygons: DataFrame,
    ground_cells: DataFrame,
    roof_cells: DataFrame,
    *,
    key: Sequence[str],
    height: Column,
    on: Sequence[str] = (),
    cell: float = P.STATS_CELL_M,
) -> DataFrame:
    """Base and top height per polygon from the statistics cells whose centre it covers.

    Base is the median ground (zero without samples); top is the highest roof,
    or base plus ``height`` when no roof lies above the base.
    """
    both = (
        ground_cells.withColumnRenamed("z", "ground_z")
        .join(roof_cells.withColumnRenamed("z", "roof_z"), [*on, "cell_x", "cell_y"], "full")
        .withColumns({"x": (F.col("cell_x") + 0.5) * cell, "y": (F.col("cell_y") + 0.5) * cell})
    )
    ids = list(dict.fromkeys([*on, *key]))
    covered = box_join(
        both,
        polygons.select(*ids, "polygon", *POLY_BOX),
        left_box=("x", "y"),
        right_box=POLY_BOX,
        cell=P.INDEX_CELL_M,
        on=on,
        residual=EC.inside("x", "y"),
        polygon="polygon",
        left_id=("cell_x", "cell_y"),
        right_id=[k for k in key if k not in on],
    )
    stats = covered.groupBy(*ids).agg(
        F.median("ground_z").alias("_base"), F.max("roof_z").alias("_top"), F.count("ground_z").alias("ground_samples")
    )
    base = F.coalesce("_base", F.lit(0.0))
    return (
        polygons.join(stats, ids, "left")
        .withColumn("base_z", base)
        .withColumn(
            "top_z", F.when(F.col("_top") > F.col("base_z"), F.col("_top")).otherwise(F.col("base_z") + height)
        )
        .withColumn("ground_samples", F.coalesce("ground_samples", F.lit(0)))
        .drop("_base", "_top")
    )


def voxel_sizes(outer_diameter_m: float) -> list[float]:
    """Review sampling sizes: double, base, half and quarter, the small ones at least one metre."""
    base = max(2.0, outer_diameter_m / 50.0)
    sizes, seen = [], set()
    for size in (base * 2.0, base, max(1.0, base / 2.0), max(1.0, base / 4.0)):
        if round(size, 3) not in seen:
            seen.add(round(size, 3))
            sizes.append(size)
    return sizes


def voxel_subsample(points: DataFrame, sizes: Sequence[float], *, by: Sequence[str] = ()) -> DataFrame:
    """Per size and square cell the point nearest to the cell centre (ties: smallest coordinates)."""
    size = F.col("voxel_size")
    df = points.select(*by, "x", "y", "z").withColumn("voxel_size", F.explode(F.array(*[F.lit(float(s)) for s in sizes])))
    df = df.withColumns({"ix": F.floor(F.col("x") / size), "iy": F.floor(F.col("y") / size)})
    dx, dy = F.col("x") - (F.col("ix") + 0.5) * size, F.col("y") - (F.col("iy") + 0.5) * size
    best = F.min(F.struct((dx * dx + dy * dy).alias("d2"), "x", "y", "z"))
    return (
        df.groupBy(*by, "voxel_size", "ix", "iy")
        .agg(best.alias("_b"))
        .select(*by, "voxel_size", "ix", "iy", F.col("_b.x").alias("x"), F.col("_b.y").alias("y"), F.col("_b.z").alias("z"))
    )


# --- alignment ------------------------------------------------------------------------------------


def alignment(
    candidates: DataFrame,
    polygons: DataFrame,
    *,
    order: str,
    on: Sequence[str] = (),
    key: Sequence[str] = ("tile", "row", "col"),
    radius: int = P.ALIGN_RADIUS_M,
    target: int | None = None,
) -> DataFrame:
    """Best horizontal offset per group with score, shift and status.

    Every candidate is tried at every offset against the footprints; ``target``
    thins them first to at most about ``2 * target`` points per group.
    """
    sample = candidates if target is None else stride_sample(candidates, target, order=order, by=list(on))
    steps = F.sequence(F.lit(-radius), F.lit(radius))
    ids = list(dict.fromkeys([*on, *key]))
    # Offsets are tried only for point-polygon pairs that some offset can bring together.
    pairs = box_join(
        sample.select(*ids, "x", "y"),
        distinct_polygons(polygons, on),
        left_box=("x", "y"),
        right_box=POLY_BOX,
        cell=P.INDEX_CELL_M,
        on=on,
        pad=float(radius),
        left_id=key,
    )
    moved = (
        pairs.withColumn("dx", F.explode(steps))
        .withColumn("mx", F.col("x") - F.col("dx"))
        .where("mx >= px0 and mx <= px1")
        .withColumn("dy", F.explode(steps))
        .withColumn("my", F.col("y") - F.col("dy"))
        .where("my >= py0 and my <= py1")
    )
    hits = moved.where(M.point_in_polygon("polygon", "mx", "my")).select(*ids, "dx", "dy").distinct()
    scores = hits.groupBy(*on, "dx", "dy").agg(F.count("*").alias("score"))
    shift = F.hypot(F.col("dx").cast("double"), F.col("dy").cast("double"))
    best = scores.groupBy(*on).agg(
        F.min(
            F.struct((-F.col("score")).alias("neg"), shift.alias("shift"), F.col("dx").alias("dx"), F.col("dy").alias("dy"))
        ).alias("_b")
    )
    n_points = candidates.groupBy(*on).agg(F.count("*").alias("candidate_points"))
    n_polygons = polygons.groupBy(*on).agg(F.count("*").alias("polygon_count"))
    if on:
        joined = n_points.join(n_polygons, list(on), "full").join(best, list(on), "left")
    else:
        joined = n_points.crossJoin(F.broadcast(n_polygons)).join(best, F.lit(True), "left")
    score = F.coalesce(-F.col("_b.neg"), F.lit(0)).cast("bigint")
    move = F.round(F.coalesce(F.col("_b.shift"), F.lit(0.0)), 3)
    points, shapes = F.coalesce("candidate_points", F.lit(0)), F.coalesce("polygon_count", F.lit(0))
    return joined.select(
        *on,
        points.alias("candidate_points"),
        shapes.alias("polygon_count"),
        F.coalesce(F.col("_b.dx"), F.lit(0)).cast("bigint").alias("dx"),
        F.coalesce(F.col("_b.dy"), F.lit(0)).cast("bigint").alias("dy"),
        score.alias("score"),
        move.alias("shift_m"),
        F.when(shapes == 0, F.lit("failed"))
        .when((points == 0) | (score <= 0), F.lit("warning"))
        .when(move > P.ALIGN_FAIL_M, F.lit("failed"))
        .when(move > P.ALIGN_WARN_M, F.lit("warning"))
        .otherwise(F.lit("passed"))
        .alias("status"),
    )


__all__ = [
    "alignment",
    "canopy_evidence",
    "canopy_pixels",
    "cell_statistics",
    "class_counts",
    "classify_cells",
    "distinct_polygons",
    "estimate_roofs",
    "is_vegetation",
    "local_relief",
    "pair_cells",
    "pair_tiles",
    "point_cloud",
    "raster_summary",
    "relief_radius_cells",
    "roof_level",
    "tile_intersects",
    "tree_filter_counts",
    "valid_cells",
    "voxel_sizes",
    "voxel_subsample",
    "zonal_heights",
]
