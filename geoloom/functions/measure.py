"""Measures and exact predicates on ring, part and multi-part columns.

Rings are ``array<struct<x,y>>``; polygons are ``array<ring>`` with the shell
first; features carry ``parts`` (an array of polygons). All functions return
column expressions built from higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoloom.functions.crs import to_local
from geoloom.params import EARTH_RADIUS_M, Region

INF = float("inf")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside higher-order functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def haversine_m(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    h = F.pow(F.sin(F.radians(lat_b - lat_a) / 2.0), F.lit(2.0)) + F.cos(F.radians(lat_a)) * F.cos(
        F.radians(lat_b)
    ) * F.pow(F.sin(F.radians(lon_b - lon_a) / 2.0), F.lit(2.0))
    return 2.0 * EARTH_RADIUS_M * F.atan2(F.sqrt(h), F.sqrt(1.0 - h))


def distance_to_center_m(lon: Column, lat: Column, region: Region) -> Column:
    return haversine_m(F.lit(region.center_lat), F.lit(region.center_lon), lat, lon)


# --- segments -------------------------------------------------------------


def _segment_distance(px: Column, py: Column, a: Column, b: Column) -> Column:
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    t = F.try_divide((px - a["x"]) * dx + (py - a["y"]) * dy, dx * dx + dy * dy)
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(t, F.lit(0.0))))
    return F.hypot(px - (a["x"] + t * dx), py - (a["y"] + t * dy))


def line_distance(line: Column, px: Column, py: Column) -> Column:
    """Distance to an open polyline; infinity when it has no vertex."""


    def measured(ln: Column) -> Column:
        to_vertices = F.aggregate(ln, F.lit(INF), lambda acc, v: F.least(acc, F.hypot(v["x"] - px, v["y"] - py)))
        to_segments = F.aggregate(
            F.sequence(F.lit(1), F.greatest(F.size(ln), F.lit(1))),
            F.lit(INF),
            lambda acc, i: F.when(i >= F.size(ln), acc).otherwise(
                F.least(acc, _segment_distance(px, py, F.get(ln, i - 1), F.get(ln, i)))
            ),
        )
        return F.least(to_vertices, to_segments)

    return let(line, measured)


# The predicates below are SQL text over column names: they sit in the inner loop of every spatial join, and one
# parsed expression is far cheaper to build than hundreds of column calls.


def _ends(ring: str) -> tuple[str, str]:
    return f"get({ring}, i - 1)", f"get({ring}, pmod(i, size({ring})))"


def _steps(ring: str) -> str:
    return f"sequence(1, greatest(size({ring}), 1))"


def _ring_near(ring: str, x: str, y: str, limit: float) -> str:
    """Some edge of the closed ring lies within ``limit``; the edge's box is tested before its distance."""
    a, b = _ends(ring)
    dx, dy = f"({b}.x - {a}.x)", f"({b}.y - {a}.y)"
    t = (
        f"greatest(0D, least(1D, coalesce(try_divide(({x} - {a}.x) * {dx} + ({y} - {a}.y) * {dy}, "
        f"{dx} * {dx} + {dy} * {dy}), 0D)))"
    )
    d = f"{limit!r}D"
    return (
        f"exists({_steps(ring)}, i -> size({ring}) >= 2"
        f" and {x} >= least({a}.x, {b}.x) - {d} and {x} <= greatest({a}.x, {b}.x) + {d}"
        f" and {y} >= least({a}.y, {b}.y) - {d} and {y} <= greatest({a}.y, {b}.y) + {d}"
        f" and hypot({x} - ({a}.x + {t} * {dx}), {y} - ({a}.y + {t} * {dy})) <= {d})"
    )


def _ring_covers(ring: str, x: str, y: str) -> str:
    """Half-open ray cast: an edge counts when it straddles ``y`` and crosses right of ``x``."""
    a, b = _ends(ring)
    crosses = (
        f"({b}.y > {y}) <> ({a}.y > {y})"
        f" and {x} < try_divide(({a}.x - {b}.x) * ({y} - {b}.y), {a}.y - {b}.y) + {b}.x"
    )
    return f"(size({ring}) >= 3 and pmod(size(filter({_steps(ring)}, i -> {crosses})), 2) = 1)"


BOUNDARY_EPS = 1e-9


def point_in_polygon(polygon: str, x: str, y: str) -> Column:
    """Containment with boundaries inside: shell edge in, strict hole interior out, hole edge in."""
    shell = f"get({polygon}, 0)"
    hole = (
        f"case when acc is not null then acc when {_ring_near('h', x, y, BOUNDARY_EPS)} then true"
        f" when {_ring_covers('h', x, y)} then false end"
    )
    holes = f"aggregate(slice({polygon}, 2, size({polygon})), cast(null as boolean), (acc, h) -> {hole})"
    return F.expr(
        f"case when {_ring_near(shell, x, y, BOUNDARY_EPS)} then true when not {_ring_covers(shell, x, y)} then false"
        f" when size({polygon}) = 1 then true else coalesce({holes}, true) end"
    )


def near_boundary(polygon: str, x: str, y: str, limit: float) -> Column:
    """Some ring (holes included) passes within ``limit``."""
    return F.expr(f"exists({polygon}, r -> {_ring_near('r', x, y, float(limit))})")


def point_in_ring(ring: Column, px: Column, py: Column) -> Column:
    """The ray cast of :func:`point_in_polygon` for ring columns, without the boundary rule."""

    def inside(r: Column) -> Column:
        n = F.size(r)

        def crosses(i: Column) -> Column:
            cur, prev = F.get(r, i - 1), F.get(r, F.pmod(i - 2 + n, n))
            straddles = (cur["y"] > py) != (prev["y"] > py)
            at = F.try_divide((prev["x"] - cur["x"]) * (py - cur["y"]), prev["y"] - cur["y"]) + cur["x"]
            return straddles & F.coalesce(px < at, F.lit(False))

        hits = F.size(F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), crosses))
        return (n >= 3) & (F.pmod(hits, F.lit(2)) == 1)

    return let(ring, inside)


# --- scalar measures --------------------------------------------------------


def ring_bbox(ring: Column) -> Column:
    return let(
        ring,
        lambda r: F.struct(
            F.array_min(F.transform(r, lambda v: v["x"])).alias("min_x"),
            F.array_min(F.transform(r, lambda v: v["y"])).alias("min_y"),
            F.array_max(F.transform(r, lambda v: v["x"])).alias("max_x"),
            F.array_max(F.transform(r, lambda v: v["y"])).alias("max_y"),
        ),
    )


def parts_bbox(parts: Column) -> Column:
    """Bounding box over the shells."""
    shells = F.flatten(F.transform(parts, lambda p: F.get(p, F.lit(0))))
    return ring_bbox(shells)


def signed_ring_area(ring: Column) -> Column:
    """Shoelace sum, measured from the first vertex to keep large coordinates accurate."""

    def measured(r: Column) -> Column:
        n, o = F.size(r), F.get(r, F.lit(0))

        def step(acc: Column, i: Column) -> Column:
            p, q = F.get(r, i - 1), F.get(r, F.pmod(i, n))
            return acc + (p["x"] - o["x"]) * (q["y"] - o["y"]) - (q["x"] - o["x"]) * (p["y"] - o["y"])

        total = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0.0), step)
        return F.when(n < 3, F.lit(0.0)).otherwise(total / 2.0)

    return let(ring, measured)


def polygon_area(polygon: Column) -> Column:
    shell = F.abs(signed_ring_area(F.get(polygon, F.lit(0))))
    holes = F.slice(polygon, 2, F.greatest(F.size(polygon) - 1, F.lit(0)))
    return F.aggregate(holes, shell, lambda acc, hole: acc - F.abs(signed_ring_area(hole)))


def parts_area(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda acc, p: acc + polygon_area(p))


def local_area_m2(parts: Column, region: Region) -> Column:
    """Area of lon/lat geometry in the local plane of the region."""
    from geoloom.functions.crs import localize_parts

    return parts_area(localize_parts(parts, region))


def shell_vertex_count(parts: Column) -> Column:
    """Vertices of all shells, closing vertex included."""
    return F.aggregate(parts, F.lit(0), lambda acc, p: acc + F.size(F.get(p, F.lit(0))))


def mean_vertex(vertices: Column) -> Column:
    mean = lambda vs, axis: F.try_divide(
        F.aggregate(vs, F.lit(0.0), lambda acc, v: acc + v[axis]), F.size(vs)
    )
    return let(vertices, lambda vs: F.struct(mean(vs, "x").alias("x"), mean(vs, "y").alias("y")))


def vertex_centroid(geom_type: Column, parts: Column) -> Column:
    """Mean vertex: first ring for a single polygon or line, every ring for a multi-polygon."""
    every = F.flatten(F.flatten(parts))
    first = F.get(F.get(parts, F.lit(0)), F.lit(0))
    return mean_vertex(F.when(geom_type == "MultiPolygon", every).otherwise(first))


def area_centroid(parts: Column) -> Column:
    """Area-weighted centroid with holes."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))

    def add(p: Column, q: Column) -> Column:
        return F.struct(*[(p[k] + q[k]).alias(k) for k in ("a", "mx", "my")])

    def raw(r: Column) -> Column:
        n, o = F.size(r), F.get(r, F.lit(0))
        return F.aggregate(
            F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
            zero,
            lambda acc, i: _moment_step(acc, F.get(r, i - 1), F.get(r, F.pmod(i, n)), o),
        )

    def moment(ring: Column, sign: Column) -> Column:
        def oriented(m: Column) -> Column:
            flip = F.when(m["a"] < 0, -sign).otherwise(sign)
            o = F.get(ring, F.lit(0))
            return F.struct(
                (flip * m["a"]).alias("a"),
                (flip * (m["mx"] / 3.0 + m["a"] * o["x"])).alias("mx"),
                (flip * (m["my"] / 3.0 + m["a"] * o["y"])).alias("my"),
            )

        return let(raw(ring), oriented)

    rings = F.flatten(
        F.transform(
            parts,
            lambda p: F.transform(p, lambda r, i: moment(r, F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0)))),
        )
    )
    return let(
        F.aggregate(rings, zero, add),
        lambda t: F.struct(F.try_divide(t["mx"], t["a"]).alias("x"), F.try_divide(t["my"], t["a"]).alias("y")),
    )


def _moment_step(acc: Column, p: Column, q: Column, o: Column) -> Column:
    px, py, qx, qy = p["x"] - o["x"], p["y"] - o["y"], q["x"] - o["x"], q["y"] - o["y"]
    cross = px * qy - qx * py
    return F.struct(
        (acc["a"] + cross / 2.0).alias("a"),
        (acc["mx"] + (px + qx) * cross / 2.0).alias("mx"),
        (acc["my"] + (py + qy) * cross / 2.0).alias("my"),
    )


def interior_point(parts: Column) -> Column:
    """A point inside the polygon: middle of the widest chord of a scan line.

    The scan line lies halfway between the vertices that bracket the middle of
    the bounding box, so it never passes through a vertex.
    """
    return F.array_max(
        F.transform(parts, lambda p: _widest_chord(p))
    )["point"]


def _widest_chord(polygon: Column) -> Column:
    def bracket(ys: Column) -> Column:
        return let(
            (F.array_min(ys) + F.array_max(ys)) / 2.0,
            lambda mid: (
                F.array_max(F.filter(ys, lambda y: y <= mid))
                + F.coalesce(F.array_min(F.filter(ys, lambda y: y > mid)), F.array_max(ys))
            )
            / 2.0,
        )

    def crossings(ring: Column, y: Column) -> Column:
        n = F.size(ring)
        return F.array_compact(
            F.transform(
                F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                lambda i: _cross_x(F.get(ring, i - 1), F.get(ring, F.pmod(i, n)), y),
            )
        )

    def chords(xs: Column, y: Column) -> Column:
        return F.array_max(
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.floor(F.size(xs) / 2).cast("int") - 1, F.lit(0))),
                lambda k: F.struct(
                    (F.get(xs, 2 * k + 1) - F.get(xs, 2 * k)).alias("width"),
                    F.struct(((F.get(xs, 2 * k) + F.get(xs, 2 * k + 1)) / 2.0).alias("x"), y.alias("y")).alias("point"),
                ),
            )
        )

    scan_line = let(F.transform(F.flatten(polygon), lambda v: v["y"]), bracket)
    return let(
        scan_line,
        lambda y: let(
            F.array_sort(F.flatten(F.transform(polygon, lambda r: crossings(r, y)))), lambda xs: chords(xs, y)
        ),
    )


def _cross_x(a: Column, b: Column, y: Column) -> Column:
    return F.when(
        (a["y"] > y) != (b["y"] > y), a["x"] + F.try_divide((y - a["y"]) * (b["x"] - a["x"]), b["y"] - a["y"])
    )


def reference_point(geom_type: Column, parts: Column) -> Column:
    """Point itself, mean of a multi-point, inner vertex of a line, or an interior point."""
    first = F.get(F.get(parts, F.lit(0)), F.lit(0))
    every = F.flatten(F.flatten(parts))
    n = F.size(first)
    inner = F.when(n > 2, F.slice(first, 2, F.greatest(n - 2, F.lit(1)))).otherwise(first)
    on_line = let(
        mean_vertex(first),
        lambda c: F.array_min(
            F.transform(
                inner, lambda v: F.struct(F.hypot(v["x"] - c["x"], v["y"] - c["y"]).alias("d"), v.alias("point"))
            )
        )["point"],
    )
    return (
        F.when(geom_type == "Point", F.get(first, F.lit(0)))
        .when(geom_type == "MultiPoint", mean_vertex(every))
        .when(geom_type == "LineString", on_line)
        .otherwise(interior_point(parts))
    )


# --- region of interest ----------------------------------------------------------


def roi_distance_m(geom_type: Column, local_parts: Column) -> Column:
    """Distance of geometry in the local plane from the origin (the region centre)."""
    zero = F.lit(0.0)
    first = F.get(F.get(local_parts, F.lit(0)), F.lit(0))

    def polygon(p: Column) -> Column:
        shell = F.get(p, F.lit(0))
        rings = F.filter(p, lambda r: F.size(r) > 0)
        return F.when(point_in_ring(shell, zero, zero), zero).otherwise(
            F.aggregate(rings, F.lit(INF), lambda acc, r: F.least(acc, line_distance(r, zero, zero)))
        )

    return F.when(geom_type.isin("Polygon", "MultiPolygon"), F.array_min(F.transform(local_parts, polygon))).otherwise(
        line_distance(first, zero, zero)
    )


def point_roi_distance_m(lon: Column, lat: Column, region: Region) -> Column:
    x, y = to_local(lon, lat, region)
    return F.hypot(x, y)


def roi_zone(distance: Column, region: Region, outside: str | None = None) -> Column:
    """Zone by distance with inclusive bounds; ``outside`` names the zone beyond the outer circle."""
    beyond = F.lit(outside).cast("string")
    if region.inner_radius_m is None:
        return F.when(distance <= region.outer_radius_m, F.lit("full")).otherwise(beyond)
    return (
        F.when(distance <= region.inner_radius_m, F.lit("inner"))
        .when(distance <= region.outer_radius_m, F.lit("annular"))
        .otherwise(beyond)
    )


def candidate_zone(lon: Column, lat: Column, region: Region) -> Column:
    """Zone of a review candidate by its centroid; never outside."""
    if region.inner_radius_m is None:
        return F.lit("full")
    near = distance_to_center_m(lon, lat, region) <= region.inner_radius_m
    return F.when(near, F.lit("inner")).otherwise(F.lit("annular"))


def reconstruction_scope(zone: Column) -> Column:
    return F.when(zone.isin("inner", "full"), F.lit("primary_roi")).otherwise(F.lit("annular_context"))


def in_lod22(category: Column, zone: Column) -> Column:
    return (category == "buildings") & F.coalesce(zone.isin("inner", "full"), F.lit(False))


def contributes(geom_type: Column) -> Column:
    return geom_type.isin("Polygon", "MultiPolygon")


def geometry_role(geom_type: Column) -> Column:
    return F.when(contributes(geom_type), F.lit("contributing_polygon")).otherwise(
        F.lit("reference_only_non_contributing")
    )


def valid_parts(parts: Column) -> Column:
    """Drop parts whose shell has fewer than four vertices and holes below four."""
    kept = F.filter(parts, lambda p: (F.size(p) > 0) & (F.size(F.get(p, F.lit(0))) >= 4))
    return F.transform(kept, lambda p: F.filter(p, lambda ring, i: (i == 0) | (F.size(ring) >= 4)))


def box_parts(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Axis-aligned rectangle as a one-part geometry (closed, counter-clockwise)."""
    v = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ring = F.array(v(x0, y0), v(x1, y0), v(x1, y1), v(x0, y1), v(x0, y0))
    return F.array(F.array(ring))


def point_parts(x: Column, y: Column) -> Column:
    return F.array(F.array(F.array(F.struct(x.alias("x"), y.alias("y")))))
