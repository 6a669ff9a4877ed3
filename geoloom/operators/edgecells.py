"""Polygons by grid cells: the edges near a cell, and what the cell's reference point is inside of.

A point needs no whole polygon to know whether it lies inside. Walk from it to
the reference point of its cell, first along x, then along y: the edges crossed
on the way lie in the cell, and each changes the side. So a cell carries the
edges that touch it and, for its reference point, the rings that it is inside of
(``flags``). A cell without edges is inside or outside as a whole (``solid``);
cells outside are left out. A polygon thus gives rows for its edges and for the
cells it covers, and no row holds all of it.

The reference point lies off the middle of the cell by an irrational share, so
that edges along the grid do not run through it. The walk along x uses the ray
cast of ``measure.point_in_polygon`` term by term, boundary and hole rules too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.measure import BOUNDARY_EPS

#: Bands of rows that edges are sorted into before the single rows.
BAND = 32
#: Place of the reference point in its cell.
REF_X, REF_Y = 0.41421356237, 0.73205080757
#: Rounding of coordinates: edges this near to a cell belong to it.
ROUNDING = 1e-6

EDGES, LOCAL = "_edges", "_local"


def with_edges(df: DataFrame, polygon: str) -> DataFrame:
    """``df`` with the edges of all rings (``r`` ring number, ``a`` and ``b`` ends) in place of the polygon."""
    edge = (
        "named_struct('r', no, 'ax', get(ring, i - 1).x, 'ay', get(ring, i - 1).y,"
        " 'bx', get(ring, pmod(i, size(ring))).x, 'by', get(ring, pmod(i, size(ring))).y)"
    )
    rings = f"transform({polygon}, (ring, no) -> case when size(ring) >= 2 then transform(sequence(1, size(ring)), i -> {edge}) end)"
    return df.withColumn(EDGES, F.expr(f"flatten(filter({rings}, e -> e is not null))")).drop(polygon)


def by_rows(df: DataFrame, low: Column, high: Column, cell: float, pad: float, out: str = "_gy") -> DataFrame:
    """One row per grid row between the heights ``low`` and ``high``, each with the edges that reach it."""
    bounds = df.withColumns({"_y0": F.floor(low / cell), "_y1": F.floor(high / cell)})
    reach = lambda first, last: (
        f"filter({EDGES}, e -> least(e.ay, e.by) <= ({last} + 1) * {cell!r}D + {pad + ROUNDING!r}D"
        f" and greatest(e.ay, e.by) >= {first} * {cell!r}D - {pad + ROUNDING!r}D)"
    )
    banded = bounds.withColumn("_band", F.explode(F.sequence(F.floor(F.col("_y0") / BAND), F.floor(F.col("_y1") / BAND))))
    banded = banded.withColumn(EDGES, F.expr(reach(f"_band * {BAND}", f"(_band * {BAND} + {BAND - 1})")))
    rows = F.sequence(F.greatest("_y0", F.col("_band") * BAND), F.least(F.col("_y1"), F.col("_band") * BAND + BAND - 1))
    return banded.withColumn(out, F.explode(rows)).withColumn(EDGES, F.expr(reach(out, out))).drop("_y0", "_y1", "_band")


def _meets_y(e: str, y: str) -> str:
    return f"(({e}.by > {y}) <> ({e}.ay > {y}))"


def _at_y(e: str, y: str) -> str:
    """Where an edge that straddles the height ``y`` crosses it."""
    return f"(try_divide(({e}.ax - {e}.bx) * ({y} - {e}.by), {e}.ay - {e}.by) + {e}.bx)"


def _at_x(e: str, x: str) -> str:
    return f"(try_divide(({e}.ay - {e}.by) * ({x} - {e}.bx), {e}.ax - {e}.bx) + {e}.by)"


def localized(df: DataFrame, gx: str, gy: str, size: Column, pad: float) -> DataFrame:
    """``df`` with ``_local`` (reference point, flags, edges) in place of the edges; cells that are outside go."""
    df = df.withColumns({"_size": size, "_cx": F.col(gx) * size, "_cy": F.col(gy) * size})
    q = f"{pad + ROUNDING!r}D"
    mid_x, mid_y, half = "(_cx + _size / 2)", "(_cy + _size / 2)", f"(_size / 2 + {q})"
    touches = (
        f"least(e.ax, e.bx) <= _cx + _size + {q} and greatest(e.ax, e.bx) >= _cx - {q}"
        f" and least(e.ay, e.by) <= _cy + _size + {q} and greatest(e.ay, e.by) >= _cy - {q}"
        f" and abs((e.bx - e.ax) * ({mid_y} - e.ay) - (e.by - e.ay) * ({mid_x} - e.ax))"
        f" <= {half} * (abs(e.by - e.ay) + abs(e.bx - e.ax)) * 1.000000001D"
    )
    xc, yc = f"(_cx + {REF_X!r}D * _size)", f"(_cy + {REF_Y!r}D * _size)"
    crossed = f"transform(filter({EDGES}, e -> {_meets_y('e', yc)} and {xc} < {_at_y('e', yc)}), e -> e.r)"
    odd = "filter(array_distinct(c), r -> pmod(size(filter(c, o -> o = r)), 2) = 1)"
    flags = f"get(transform(array({crossed}), c -> {odd}), 0)"
    cell = f"named_struct('x', {xc}, 'y', {yc}, 'flags', {flags}, 'edges', filter({EDGES}, e -> {touches}))"
    # Generated from an array of one or none, so that the filter does not compute the cell again.
    kept = f"filter(array({cell}), l -> size(l.edges) > 0 or (size(l.flags) = 1 and l.flags[0] = 0))"
    return df.withColumn(LOCAL, F.explode(F.expr(kept))).drop(EDGES, "_size", "_cx", "_cy")


def _near(e: str, x: str, y: str, limit: float) -> str:
    dx, dy = f"({e}.bx - {e}.ax)", f"({e}.by - {e}.ay)"
    t = (
        f"greatest(0D, least(1D, coalesce(try_divide(({x} - {e}.ax) * {dx} + ({y} - {e}.ay) * {dy}, "
        f"{dx} * {dx} + {dy} * {dy}), 0D)))"
    )
    d = f"{limit!r}D"
    return (
        f"({x} >= least({e}.ax, {e}.bx) - {d} and {x} <= greatest({e}.ax, {e}.bx) + {d}"
        f" and {y} >= least({e}.ay, {e}.by) - {d} and {y} <= greatest({e}.ay, {e}.by) + {d}"
        f" and hypot({x} - ({e}.ax + {t} * {dx}), {y} - ({e}.ay + {t} * {dy})) <= {d})"
    )


def inside(x: str, y: str, local: str = LOCAL) -> Column:
    """``measure.point_in_polygon`` for the cell of the point."""
    xc, yc = f"{local}.x", f"{local}.y"
    along_x = f"({_meets_y('e', y)} and ({x} < {_at_y('e', y)}) <> ({xc} < {_at_y('e', y)}))"
    along_y = f"(((e.bx > {xc}) <> (e.ax > {xc})) and ({y} < {_at_x('e', xc)}) <> ({yc} < {_at_x('e', xc)}))"
    covers = lambda r: (
        f"(array_contains({local}.flags, {r}) <> "
        f"(pmod(size(filter({local}.edges, e -> e.r = {r} and coalesce({along_x}, false) <> coalesce({along_y}, false))), 2) = 1))"
    )
    near = lambda r: f"exists({local}.edges, e -> e.r = {r} and {_near('e', x, y, BOUNDARY_EPS)})"
    holes = f"array_sort(array_distinct(concat({local}.flags, transform(filter({local}.edges, e -> e.r > 0), e -> e.r))))"
    first = (
        f"aggregate(filter({holes}, h -> h > 0), cast(null as boolean), (acc, h) ->"
        f" case when acc is not null then acc when {near('h')} then true when {covers('h')} then false end)"
    )
    return F.expr(
        f"case when size({local}.edges) = 0 then true when {near('0')} then true when not {covers('0')} then false"
        f" else coalesce({first}, true) end"
    )


def near_edge(x: str, y: str, limit: float, local: str = LOCAL) -> Column:
    """``measure.near_boundary`` for the cell of the point; cells must have been padded by ``limit``."""
    return F.expr(f"exists({local}.edges, e -> {_near('e', x, y, float(limit))})")
