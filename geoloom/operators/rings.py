"""Polygons from the trapezoids of an overlay: the boundary of each feature's pieces.

Corners are snapped to micrometres. Horizontal and vertical sides of a feature
cancel wherever two pieces meet along them, so only the boundary is left; it is
a set of closed directed walks with the feature on their left. One feature is
one group, as its polygon is one row in any case; features that an overlay did
not touch need no rings.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.operators.features import _even_odd_groups
from geoloom.schemas import PARTS

GRID = 1e6
TRAPEZOID = ("y_lo", "y_hi", "xl_lo", "xl_hi", "xr_lo", "xr_hi")


def _net(line: np.ndarray, lo: np.ndarray, hi: np.ndarray, sign: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of each line where the signs of its intervals do not cancel: ``line, from, to, sign``."""
    at = np.concatenate([lo, hi])
    where, change = np.concatenate([line, line]), np.concatenate([sign, -sign])
    order = np.lexsort((at, where))
    at, where, total = at[order], where[order], np.cumsum(change[order])
    live = np.flatnonzero((where[1:] == where[:-1]) & (at[1:] > at[:-1]) & (total[:-1] != 0))
    return where[live], at[live], at[live + 1], total[live]


def boundary(t: np.ndarray) -> np.ndarray:
    """Directed boundary edges ``x0, y0, x1, y1`` (snapped integers) of trapezoid rows in the order of ``TRAPEZOID``."""
    y0, y1, l0, l1, r0, r1 = np.rint(t * GRID).astype(np.int64).T
    flat = np.concatenate([y0, y1])
    y, a, b, s = _net(flat, np.concatenate([l0, l1]), np.concatenate([r0, r1]), np.repeat([1, -1], len(y0)))
    edges = [np.stack([np.where(s > 0, a, b), y, np.where(s > 0, b, a), y], axis=1)]
    left, right = l0 == l1, r0 == r1
    x, a, b, s = _net(
        np.concatenate([r0[right], l0[left]]), np.concatenate([y0[right], y0[left]]), np.concatenate([y1[right], y1[left]]),
        np.repeat([1, -1], [right.sum(), left.sum()]),
    )
    edges.append(np.stack([x, np.where(s > 0, a, b), x, np.where(s > 0, b, a)], axis=1))
    edges.append(np.stack([r0, y0, r1, y1], axis=1)[~right])
    edges.append(np.stack([l1, y1, l0, y0], axis=1)[~left])
    out = np.concatenate(edges)
    return out[(out[:, 0] != out[:, 2]) | (out[:, 1] != out[:, 3])]


def walks(edges: np.ndarray) -> list[list[tuple[int, int]]]:
    """Closed walks over all edges; where several leave a corner, the leftmost one goes on."""
    leaving: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for x0, y0, x1, y1 in edges.tolist():
        leaving.setdefault((x0, y0), []).append((x1, y1))
    rings = []
    for start in list(leaving):
        while leaving.get(start):
            ring, here = [start], leaving[start].pop()
            while here != start:
                ring.append(here)
                ends = leaving.get(here)
                if not ends:
                    ring = []  # snapping tore this walk; its area is below the grid
                    break
                if len(ends) > 1:
                    back = complex(here[0] - ring[-2][0], here[1] - ring[-2][1])
                    ends.sort(key=lambda p: np.angle(complex(p[0] - here[0], p[1] - here[1]) / back))
                here = ends.pop()
            ring = _corners(ring)
            if len(ring) >= 3:
                rings.append([*ring, ring[0]])
    return rings


def _corners(ring: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ring without points that lie on the line of their neighbours, within the grid."""
    kept: list[tuple[int, int]] = []
    for p in [*ring, *ring[:1]]:
        while len(kept) >= 2 and _straight(kept[-2], kept[-1], p):
            kept.pop()
        kept.append(p)
    if len(kept) > 1:
        kept.pop()
    while len(kept) >= 3 and _straight(kept[-1], kept[0], kept[1]):
        kept.pop(0)
    return kept


def _straight(a: tuple[int, int], b: tuple[int, int], c: tuple[int, int]) -> bool:
    dx, dy = c[0] - a[0], c[1] - a[1]
    across = dx * (b[1] - a[1]) - dy * (b[0] - a[0])
    ahead = (b[0] - a[0]) * (c[0] - b[0]) + (b[1] - a[1]) * (c[1] - b[1])
    return ahead >= 0 and abs(across) <= 2 * max(abs(dx), abs(dy))


def polygons(t: np.ndarray, min_area: float = 0.0) -> list[list[list[tuple[float, float]]]]:
    """Polygons (shell and holes) of the union of trapezoids; those of at most ``min_area`` are left out."""
    rings = [[(x / GRID, y / GRID) for x, y in r] for r in walks(boundary(t))]
    size = lambda r: abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:]))) / 2.0
    # Most features are one ring, which needs no nesting.
    grouped = [rings] if len(rings) == 1 else _even_odd_groups(rings)
    return [p for p in grouped if size(p[0]) - sum(map(size, p[1:])) > min_area]


def _parts_array(features: list[list[list[list[tuple[float, float]]]]]) -> pa.Array:
    """Polygons of many features as one column of parts; null where a feature has none."""
    polygons_ = [p for parts in features for p in parts]
    rings = [r for p in polygons_ for r in p]
    xy = np.array([v for r in rings for v in r], float).reshape(-1, 2)
    offsets = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], ["x", "y"])
    ring_column = pa.ListArray.from_arrays(offsets([len(r) for r in rings]), points)
    polygon_column = pa.ListArray.from_arrays(offsets([len(p) for p in polygons_]), ring_column)
    none = pa.array([not parts for parts in features], pa.bool_())
    return pa.ListArray.from_arrays(offsets([len(parts) for parts in features]), polygon_column, mask=none)


def outlines(pieces: DataFrame, keys: Sequence[str], *, min_area: float = 0.0) -> DataFrame:
    """``keys, parts``: the polygons of each feature's trapezoids; features left with none have no row."""
    keys = list(keys)

    @F.arrow_udf(PARTS)
    def shape(*sides: pa.Array) -> pa.Array:
        columns = np.column_stack([s.flatten().to_numpy(zero_copy_only=False).astype(float) for s in sides])
        ends = np.cumsum(sides[0].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        return _parts_array([polygons(t, min_area) for t in np.split(columns, ends[:-1])] if len(ends) else [])

    # Walking a boundary is heavy per byte, so its tasks keep the configured parallelism instead of being coalesced by size.
    width = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = pieces.select(*keys, F.struct(*TRAPEZOID).alias("_t")).repartition(width, *keys).groupBy(*keys).agg(F.collect_list("_t").alias("_t"))
    return lists.select(*keys, shape(*[F.col(f"_t.{c}") for c in TRAPEZOID]).alias("parts")).where("parts is not null")
