"""Sampling point heights from terrain triangles."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions import triangles as T
from geoloom.operators.mesh import valid_xy
from geoloom.operators.skew import cut_lineage, stored
from geoloom.operators.spatial import HOT_ROWS, box_join
from geoloom.schemas import TRI_COLS

BOX = ("tx0", "ty0", "tx1", "ty1")
SLACK = 1e-9


def with_box(triangles: DataFrame) -> DataFrame:
    lo = lambda axis: F.least(*[F.col(f"{v}{axis}") for v in "abc"])
    hi = lambda axis: F.greatest(*[F.col(f"{v}{axis}") for v in "abc"])
    return triangles.withColumns({"tx0": lo("x"), "ty0": lo("y"), "tx1": hi("x"), "ty1": hi("y")})


def sample_hits(
    points: DataFrame,
    triangles: DataFrame,
    *,
    key: Sequence[str],
    xy: tuple[str, str] = ("x", "y"),
    on: Sequence[str] = (),
    cell: float = 4.0,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Highest covering triangle per point: ``on, key, terrain_z``; points without a hit are absent."""
    ids = list(dict.fromkeys([*on, *key]))
    height = T.height_if_covered(F.col(xy[0]), F.col(xy[1]), slack=SLACK)
    faces = with_box(valid_xy(triangles)).select(*on, *TRI_COLS, *BOX)
    pairs = box_join(
        points.select(*ids, *xy),
        faces,
        left_box=xy,
        right_box=BOX,
        cell=cell,
        on=on,
        pad=SLACK,
        residual=height.isNotNull(),
        left_id=key,
        right_id=TRI_COLS,
        hot_rows=hot_rows,
    )
    return pairs.groupBy(*ids).agg(F.max(height).alias("terrain_z"))


def _hull(points: np.ndarray) -> np.ndarray:
    """Convex hull (counter-clockwise) by monotone chain."""
    pts = np.unique(points, axis=0)
    if len(pts) < 3:
        return pts

    def chain(seq):
        out: list[np.ndarray] = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (
                p[0] - out[-2][0]
            ) <= 0:
                out.pop()
            out.append(p)
        return out

    lower, upper = chain(pts), chain(pts[::-1])
    return np.array(lower[:-1] + upper[:-1])


def convex_hull(triangles: DataFrame, *, on: Sequence[str] = (), cell: float = 64.0, levels: int = 3) -> DataFrame:
    """Hull of all triangle vertices per group of ``on``: one row with ``hull`` (array of vertices).

    Hulls are merged level by level (cell, 64 cells, 4096 cells, all), so every
    task sees only the few corner points that survived the level below.
    """
    keys = list(on)
    key_types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in triangles.select(*on).schema)
    vertex = F.array(*[F.struct(F.col(f"{v}x").alias("x"), F.col(f"{v}y").alias("y")) for v in "abc"])
    points = triangles.select(*on, F.explode(vertex).alias("_v")).select(*on, "_v.x", "_v.y").distinct()
    schema = ", ".join(t for t in (key_types, "x double, y double") if t)

    def corners(pdf: pd.DataFrame) -> pd.DataFrame:
        hull = _hull(pdf[["x", "y"]].to_numpy(float))
        out = pd.DataFrame(hull, columns=["x", "y"])
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    size = cell
    for _ in range(levels):
        grid = [F.floor(F.col("x") / size).alias("_hx"), F.floor(F.col("y") / size).alias("_hy")]
        points = points.groupBy(*keys, *grid).applyInPandas(corners, schema)
        size *= 64.0
    last = points.groupBy(*keys) if keys else points.withColumn("_all", F.lit(0)).groupBy("_all")
    ordered = ", ".join(t for t in (key_types, "hull array<struct<x:double,y:double>>") if t)

    def ring(pdf: pd.DataFrame) -> pd.DataFrame:
        hull = _hull(pdf[["x", "y"]].to_numpy(float))
        row = {k: pdf[k].iloc[0] for k in keys}
        row["hull"] = [{"x": float(x), "y": float(y)} for x, y in hull]
        return pd.DataFrame([row], columns=[*keys, "hull"])

    return last.applyInPandas(ring, ordered)


def inside_hull(px, py, hull):
    """Covered by the hull, border included."""
    n = F.size(hull)
    return (n >= 3) & F.forall(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: _turn(F.get(hull, i - 1), F.get(hull, F.pmod(i, n)), px, py) >= -1e-9,
    )


def _turn(a, b, px, py):
    return (b["x"] - a["x"]) * (py - a["y"]) - (b["y"] - a["y"]) * (px - a["x"])


def sample_nearest(
    misses: DataFrame,
    triangles: DataFrame,
    *,
    key: Sequence[str],
    xy: tuple[str, str] = ("x", "y"),
    on: Sequence[str] = (),
    cell: float = 4.0,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Plane height at the nearest boundary point of the nearest triangle, for points in a mesh hole.

    The search radius doubles per level; a point is settled once its nearest
    candidate is closer than the radius, so later levels see only the leftovers.
    The levels end when no point is left, or when the radius spans all points
    and triangles; what is left then has no triangle in its group.
    """
    ids = list(dict.fromkeys([*on, *key]))
    px, py = F.col(xy[0]), F.col(xy[1])
    nearest = T.nearest_on_boundary(px, py)
    faces = with_box(valid_xy(triangles)).select(*on, *TRI_COLS, *BOX)
    todo, done, radius = misses.select(*ids, *xy), None, cell
    ends = faces.select(F.col("tx0").alias("x"), F.col("ty0").alias("y")).unionByName(
        faces.select(F.col("tx1").alias("x"), F.col("ty1").alias("y"))
    ).unionByName(todo.select(px.alias("x"), py.alias("y")))
    span = ends.agg(F.hypot(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("d")).first()["d"] or 0.0
    while True:
        pairs = box_join(
            todo, faces, left_box=xy, right_box=BOX, cell=radius, on=on, pad=radius, left_id=key,
            right_id=TRI_COLS, hot_rows=hot_rows,
        ).withColumn("_near", nearest)
        best = pairs.groupBy(*ids).agg(
            F.min_by(
                T.plane_height(F.col("_near.x"), F.col("_near.y")), F.struct("_near.d2", *TRI_COLS)
            ).alias("terrain_z"),
            F.min("_near.d2").alias("_d2"),
        )
        settled = cut_lineage(best.where(F.col("_d2") <= radius * radius).drop("_d2"))
        done = settled if done is None else done.unionByName(settled)
        todo = cut_lineage(todo.join(settled.select(*ids), ids, "left_anti"))
        if radius > span or todo.isEmpty():
            break
        radius *= 2.0
    return done


def sample_terrain(
    points: DataFrame,
    triangles: DataFrame,
    *,
    key: Sequence[str],
    xy: tuple[str, str] = ("x", "y"),
    on: Sequence[str] = (),
    cell: float = 4.0,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """All points with ``terrain_z`` and ``terrain_status``: ``hit``, ``nearest`` or ``outside``.

    A point outside the convex hull of the mesh cannot be projected; it keeps a
    null height and status ``outside`` instead of failing the run.
    """
    ids = list(dict.fromkeys([*on, *key]))
    # Hits, hull and every search radius read the triangles.
    triangles = stored(valid_xy(triangles).select(*on, *TRI_COLS))
    hits = sample_hits(points, triangles, key=key, xy=xy, on=on, cell=cell, hot_rows=hot_rows)
    hull = convex_hull(valid_xy(triangles), on=on)
    misses = points.join(hits.select(*ids), ids, "left_anti")
    located = misses.join(hull, list(on)) if on else misses.crossJoin(F.broadcast(hull.limit(1)))
    # Materialized: the level loop below reads it several times.
    within = cut_lineage(located.where(inside_hull(F.col(xy[0]), F.col(xy[1]), F.col("hull"))).select(*ids, *xy))
    near = sample_nearest(within, triangles, key=key, xy=xy, on=on, cell=cell, hot_rows=hot_rows)
    both = hits.withColumn("terrain_status", F.lit("hit")).unionByName(near.withColumn("terrain_status", F.lit("nearest")))
    return points.join(both, ids, "left").withColumn("terrain_status", F.coalesce("terrain_status", F.lit("outside")))
