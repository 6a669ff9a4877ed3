"""Column arithmetic on triangle rows (columns ``ax .. cz``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _edge(p: str, q: str, axis: str, prefix: str) -> Column:
    return F.col(f"{prefix}{q}{axis}") - F.col(f"{prefix}{p}{axis}")


def cross_product(prefix: str = "") -> tuple[Column, Column, Column]:
    ux, uy, uz = (_edge("a", "b", axis, prefix) for axis in "xyz")
    vx, vy, vz = (_edge("a", "c", axis, prefix) for axis in "xyz")
    return uy * vz - uz * vy, uz * vx - ux * vz, ux * vy - uy * vx


def cross_length(prefix: str = "") -> Column:
    x, y, z = cross_product(prefix)
    return F.sqrt(x * x + y * y + z * z)


def normal(prefix: str = "") -> tuple[Column, Column, Column]:
    """Unit normal; all zero for a degenerate triangle."""
    length = cross_length(prefix)
    return tuple(F.coalesce(F.try_divide(c, length), F.lit(0.0)) for c in cross_product(prefix))  # type: ignore[return-value]


def xy_area(prefix: str = "") -> Column:
    return F.abs(cross_product(prefix)[2]) / 2.0


def all_finite(prefix: str = "") -> Column:
    ok = F.lit(True)
    for v in "abc":
        for axis in "xyz":
            c = F.col(f"{prefix}{v}{axis}")
            ok = ok & c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    return ok


def barycentric(px: Column, py: Column, prefix: str = "") -> tuple[Column, Column, Column]:
    """Weights of (px, py) in the XY projection; null for a degenerate triangle."""
    c = lambda name: F.col(f"{prefix}{name}")
    denom = (c("by") - c("cy")) * (c("ax") - c("cx")) + (c("cx") - c("bx")) * (c("ay") - c("cy"))
    safe = F.when(F.abs(denom) >= 1e-12, denom)
    u = ((c("by") - c("cy")) * (px - c("cx")) + (c("cx") - c("bx")) * (py - c("cy"))) / safe
    v = ((c("cy") - c("ay")) * (px - c("cx")) + (c("ax") - c("cx")) * (py - c("cy"))) / safe
    return u, v, 1.0 - u - v


def plane_height(px: Column, py: Column, prefix: str = "") -> Column:
    u, v, w = barycentric(px, py, prefix)
    return u * F.col(f"{prefix}az") + v * F.col(f"{prefix}bz") + w * F.col(f"{prefix}cz")


def height_if_covered(px: Column, py: Column, prefix: str = "", slack: float = 1e-9) -> Column:
    """Height of the triangle at (px, py), or null when the point lies outside it."""
    u, v, w = barycentric(px, py, prefix)
    return F.when((u >= -slack) & (v >= -slack) & (w >= -slack), plane_height(px, py, prefix))


def nearest_on_boundary(px: Column, py: Column, prefix: str = "") -> Column:
    """Struct ``(d2, x, y)`` of the boundary point of the XY triangle nearest to (px, py)."""

    def on_edge(p: str, q: str) -> Column:
        sx, sy = F.col(f"{prefix}{p}x"), F.col(f"{prefix}{p}y")
        dx, dy = _edge(p, q, "x", prefix), _edge(p, q, "y", prefix)
        t = F.coalesce(F.try_divide((px - sx) * dx + (py - sy) * dy, dx * dx + dy * dy), F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
        nx, ny = sx + t * dx, sy + t * dy
        return F.struct(((px - nx) ** 2 + (py - ny) ** 2).alias("d2"), nx.alias("x"), ny.alias("y"))

    return F.least(on_edge("a", "b"), on_edge("b", "c"), on_edge("c", "a"))
