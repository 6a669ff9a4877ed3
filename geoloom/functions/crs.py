"""Coordinate systems as column expressions.

Forward and inverse transverse Mercator, the seven-parameter datum shift,
Web Mercator, and the local equirectangular plane around a region centre.
Everything stays in JVM expressions; nothing here needs a UDF.

Long chains of intermediate values are added as staged columns (``with_*``
functions) rather than nested into one expression, so that the optimizer keeps
each intermediate once instead of inlining it dozens of times.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.params import EARTH_RADIUS_M, WEB_MERCATOR_LIMIT_M, WEB_MERCATOR_RADIUS_M, Region


@dataclass(frozen=True)
class Ellipsoid:
    semi_major: float
    inverse_flattening: float

    @property
    def flattening(self) -> float:
        return 1.0 / self.inverse_flattening

    @property
    def semi_minor(self) -> float:
        return self.semi_major * (1.0 - self.flattening)

    @property
    def e2(self) -> float:
        return self.flattening * (2.0 - self.flattening)

    @property
    def ep2(self) -> float:
        return self.e2 / (1.0 - self.e2)


@dataclass(frozen=True)
class TransverseMercator:
    ellipsoid: Ellipsoid
    central_meridian_deg: float
    scale: float
    false_easting: float


@dataclass(frozen=True)
class DatumShift:
    """Position-vector seven-parameter shift towards WGS84."""

    tx: float
    ty: float
    tz: float
    rx_arcsec: float
    ry_arcsec: float
    rz_arcsec: float
    scale_ppm: float


# Ellipsoids, grids and the Rome40 datum shift.
WGS84 = Ellipsoid(6378137.0, 298.257223563)
INTL1924 = Ellipsoid(6378388.0, 297.0)
UTM32 = TransverseMercator(WGS84, 9.0, 0.9996, 500000.0)
GAUSS_BOAGA_WEST = TransverseMercator(INTL1924, 9.0, 0.9996, 1500000.0)
ROME40_TO_WGS84 = DatumShift(-104.1, -49.1, -9.9, 0.971, -2.917, 0.714, -11.68)

SUPPORTED_SHAPE_CRS = ("EPSG:4326", "EPSG:25832", "EPSG:3003")
SUPPORTED_PLANNING_CRS = ("EPSG:4326", "EPSG:3857")


def _sq(c: Column) -> Column:
    return c * c


def utm32_x(lon: Column, lat: Column) -> Column:
    """Easting in EPSG:25832."""
    a, t, c, n = _forward_terms(lon, lat)
    ep2 = UTM32.ellipsoid.ep2
    series = (
        a
        + (1.0 - t + c) * F.pow(a, F.lit(3.0)) / 6.0
        + (5.0 - 18.0 * t + _sq(t) + 72.0 * c - 58.0 * ep2) * F.pow(a, F.lit(5.0)) / 120.0
    )
    return UTM32.scale * n * series + UTM32.false_easting


def utm32_y(lon: Column, lat: Column) -> Column:
    """Northing in EPSG:25832."""
    a, t, c, n = _forward_terms(lon, lat)
    e2, ep2, a0 = UTM32.ellipsoid.e2, UTM32.ellipsoid.ep2, UTM32.ellipsoid.semi_major
    phi = F.radians(lat)
    arc = a0 * (
        (1.0 - e2 / 4.0 - 3.0 * e2**2 / 64.0 - 5.0 * e2**3 / 256.0) * phi
        - (3.0 * e2 / 8.0 + 3.0 * e2**2 / 32.0 + 45.0 * e2**3 / 1024.0) * F.sin(2.0 * phi)
        + (15.0 * e2**2 / 256.0 + 45.0 * e2**3 / 1024.0) * F.sin(4.0 * phi)
        - (35.0 * e2**3 / 3072.0) * F.sin(6.0 * phi)
    )
    series = (
        _sq(a) / 2.0
        + (5.0 - t + 9.0 * c + 4.0 * _sq(c)) * F.pow(a, F.lit(4.0)) / 24.0
        + (61.0 - 58.0 * t + _sq(t) + 600.0 * c - 330.0 * ep2) * F.pow(a, F.lit(6.0)) / 720.0
    )
    return UTM32.scale * (arc + n * F.tan(phi) * series)


def _forward_terms(lon: Column, lat: Column) -> tuple[Column, Column, Column, Column]:
    e2, ep2 = UTM32.ellipsoid.e2, UTM32.ellipsoid.ep2
    phi = F.radians(lat)
    a = F.cos(phi) * (F.radians(lon) - math.radians(UTM32.central_meridian_deg))
    t = _sq(F.tan(phi))
    c = ep2 * _sq(F.cos(phi))
    n = UTM32.ellipsoid.semi_major / F.sqrt(1.0 - e2 * _sq(F.sin(phi)))
    return a, t, c, n


def with_geographic(
    df: DataFrame, x: str, y: str, grid: TransverseMercator, lon: str = "lon", lat: str = "lat"
) -> DataFrame:
    """Add geographic degrees for transverse Mercator metres in columns ``x``/``y``."""
    ell = grid.ellipsoid
    e2, ep2 = ell.e2, ell.ep2
    root = math.sqrt(1.0 - e2)
    e1 = (1.0 - root) / (1.0 + root)
    rectifying = ell.semi_major * (1.0 - e2 / 4.0 - 3.0 * e2**2 / 64.0 - 5.0 * e2**3 / 256.0)
    mu = F.col(y) / grid.scale / rectifying
    m = F.col("_mu")
    staged = (
        df.withColumn("_mu", mu)
        .withColumn(
            "_phi",
            m
            + (3.0 * e1 / 2.0 - 27.0 * e1**3 / 32.0) * F.sin(2.0 * m)
            + (21.0 * e1**2 / 16.0 - 55.0 * e1**4 / 32.0) * F.sin(4.0 * m)
            + (151.0 * e1**3 / 96.0) * F.sin(6.0 * m)
            + (1097.0 * e1**4 / 512.0) * F.sin(8.0 * m),
        )
        .withColumns(
            {
                "_w": 1.0 - e2 * _sq(F.sin("_phi")),
                "_t": _sq(F.tan("_phi")),
                "_c": ep2 * _sq(F.cos("_phi")),
            }
        )
        .withColumn("_n", ell.semi_major / F.sqrt("_w"))
        .withColumns(
            {
                "_r": ell.semi_major * (1.0 - e2) / F.pow("_w", F.lit(1.5)),
                "_d": (F.col(x) - grid.false_easting) / (F.col("_n") * grid.scale),
            }
        )
    )
    d, t, c, phi = F.col("_d"), F.col("_t"), F.col("_c"), F.col("_phi")
    lat_rad = phi - (F.col("_n") * F.tan(phi) / F.col("_r")) * (
        _sq(d) / 2.0
        - (5.0 + 3.0 * t + 10.0 * c - 4.0 * _sq(c) - 9.0 * ep2) * F.pow(d, F.lit(4.0)) / 24.0
        + (61.0 + 90.0 * t + 298.0 * c + 45.0 * _sq(t) - 252.0 * ep2 - 3.0 * _sq(c)) * F.pow(d, F.lit(6.0)) / 720.0
    )
    lon_rad = (
        math.radians(grid.central_meridian_deg)
        + (
            d
            - (1.0 + 2.0 * t + c) * F.pow(d, F.lit(3.0)) / 6.0
            + (5.0 - 2.0 * c + 28.0 * t - 3.0 * _sq(c) + 8.0 * ep2 + 24.0 * _sq(t)) * F.pow(d, F.lit(5.0)) / 120.0
        )
        / F.cos(phi)
    )
    return staged.withColumns({lon: F.degrees(lon_rad), lat: F.degrees(lat_rad)}).drop(
        "_mu", "_phi", "_w", "_t", "_c", "_n", "_r", "_d"
    )


def geocentric(lon: Column, lat: Column, ell: Ellipsoid) -> tuple[Column, Column, Column]:
    """Geodetic degrees on an ellipsoid to geocentric metres (height zero)."""
    phi, lam = F.radians(lat), F.radians(lon)
    n = ell.semi_major / F.sqrt(1.0 - ell.e2 * _sq(F.sin(phi)))
    return n * F.cos(phi) * F.cos(lam), n * F.cos(phi) * F.sin(lam), n * (1.0 - ell.e2) * F.sin(phi)


def geodetic(x: Column, y: Column, z: Column, ell: Ellipsoid = WGS84) -> tuple[Column, Column]:
    """Geocentric metres to (lon, lat) degrees, closed form."""
    second = (ell.semi_major**2 - ell.semi_minor**2) / ell.semi_minor**2
    p = F.hypot(x, y)
    theta = F.atan2(z * ell.semi_major, p * ell.semi_minor)
    lat = F.atan2(
        z + second * ell.semi_minor * F.pow(F.sin(theta), F.lit(3.0)),
        p - ell.e2 * ell.semi_major * F.pow(F.cos(theta), F.lit(3.0)),
    )
    return F.degrees(F.atan2(y, x)), F.degrees(lat)


def with_datum_shift(
    df: DataFrame,
    lon: str,
    lat: str,
    source: Ellipsoid = INTL1924,
    shift: DatumShift = ROME40_TO_WGS84,
    out_lon: str | None = None,
    out_lat: str | None = None,
) -> DataFrame:
    """Shift geographic degrees from ``source`` to WGS84."""
    arc = math.pi / (180.0 * 3600.0)
    rx, ry, rz = shift.rx_arcsec * arc, shift.ry_arcsec * arc, shift.rz_arcsec * arc
    s = 1.0 + shift.scale_ppm * 1.0e-6
    gx, gy, gz = geocentric(F.col(lon), F.col(lat), source)
    g = df.withColumns({"_gx": gx, "_gy": gy, "_gz": gz})
    x, y, z = F.col("_gx"), F.col("_gy"), F.col("_gz")
    g = g.withColumns(
        {
            "_wx": shift.tx + s * x - rz * y + ry * z,
            "_wy": shift.ty + rz * x + s * y - rx * z,
            "_wz": shift.tz - ry * x + rx * y + s * z,
        }
    )
    new_lon, new_lat = geodetic(F.col("_wx"), F.col("_wy"), F.col("_wz"), WGS84)
    return g.withColumns({out_lon or lon: new_lon, out_lat or lat: new_lat}).drop(
        "_gx", "_gy", "_gz", "_wx", "_wy", "_wz"
    )


def normalized_crs(crs: Column) -> Column:
    return F.replace(F.upper(F.trim(crs)), F.lit("::"), F.lit(":"))


def with_lonlat(
    df: DataFrame, x: str, y: str, crs: str, lon: str = "lon", lat: str = "lat", error: str = "crs_error"
) -> DataFrame:
    """Per-row dispatch on the CRS name; unsupported names give a message in ``error``."""
    code = normalized_crs(F.col(crs))
    df = with_geographic(df, x, y, UTM32, "_ulon", "_ulat")
    df = with_geographic(df, x, y, GAUSS_BOAGA_WEST, "_rlon", "_rlat")
    df = with_datum_shift(df, "_rlon", "_rlat")
    pick = lambda raw, utm, rome: (
        F.when(code == "EPSG:4326", F.col(raw)).when(code == "EPSG:25832", F.col(utm)).when(code == "EPSG:3003", F.col(rome))
    )
    return df.withColumns(
        {
            lon: pick(x, "_ulon", "_rlon"),
            lat: pick(y, "_ulat", "_rlat"),
            error: F.when(
                F.coalesce(~code.isin(*SUPPORTED_SHAPE_CRS), F.lit(True)),
                F.concat(F.lit("unsupported CRS: "), F.coalesce(F.col(crs), F.lit("<null>"))),
            ),
        }
    ).drop("_ulon", "_ulat", "_rlon", "_rlat")


def inverse_web_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    """EPSG:3857 metres to degrees; null outside the Web Mercator square."""
    ok = (F.abs(x) <= WEB_MERCATOR_LIMIT_M) & (F.abs(y) <= WEB_MERCATOR_LIMIT_M)
    lon = F.degrees(x / WEB_MERCATOR_RADIUS_M)
    lat = F.degrees(2.0 * F.atan(F.exp(y / WEB_MERCATOR_RADIUS_M)) - math.pi / 2.0)
    return F.when(ok, lon), F.when(ok, lat)


def to_local(lon: Column, lat: Column, region: Region) -> tuple[Column, Column]:
    """Metres in the equirectangular plane whose origin is the region centre."""
    x = F.radians(lon - region.center_lon) * region.meters_per_radian_lon
    y = F.radians(lat - region.center_lat) * EARTH_RADIUS_M
    return x, y


def from_local(x: Column, y: Column, region: Region) -> tuple[Column, Column]:
    lon = region.center_lon + F.degrees(x / region.meters_per_radian_lon)
    lat = region.center_lat + F.degrees(y / EARTH_RADIUS_M)
    return lon, lat


def map_vertices(parts: Column, fn) -> Column:
    """Apply ``fn(x, y) -> (x, y)`` to every vertex of a ``parts`` column."""

    def vertex(v: Column) -> Column:
        x, y = fn(v["x"], v["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(parts, lambda part: F.transform(part, lambda ring: F.transform(ring, vertex)))


def project_parts(parts: Column) -> Column:
    """Reproject lon/lat geometry to EPSG:25832."""
    return map_vertices(parts, lambda lon, lat: (utm32_x(lon, lat), utm32_y(lon, lat)))


def localize_parts(parts: Column, region: Region) -> Column:
    return map_vertices(parts, lambda lon, lat: to_local(lon, lat, region))


def delocalize_parts(parts: Column, region: Region) -> Column:
    return map_vertices(parts, lambda x, y: from_local(x, y, region))


def lonlat_in_range(parts: Column) -> Column:
    """True when every vertex is a valid longitude/latitude."""
    return F.forall(
        parts,
        lambda part: F.forall(
            part,
            lambda ring: F.forall(ring, lambda v: v["x"].between(-180.0, 180.0) & v["y"].between(-90.0, 90.0)),
        ),
    )


def utm32_of(lon: float, lat: float) -> tuple[float, float]:
    """Driver-side scalar version for one-row parameters such as a region centre."""
    e2, ep2, a0 = WGS84.e2, WGS84.ep2, WGS84.semi_major
    phi = math.radians(lat)
    a = math.cos(phi) * (math.radians(lon) - math.radians(UTM32.central_meridian_deg))
    t, c = math.tan(phi) ** 2, ep2 * math.cos(phi) ** 2
    n = a0 / math.sqrt(1.0 - e2 * math.sin(phi) ** 2)
    arc = a0 * sum(
        k * f
        for k, f in (
            (1.0 - e2 / 4.0 - 3.0 * e2**2 / 64.0 - 5.0 * e2**3 / 256.0, phi),
            (-(3.0 * e2 / 8.0 + 3.0 * e2**2 / 32.0 + 45.0 * e2**3 / 1024.0), math.sin(2.0 * phi)),
            (15.0 * e2**2 / 256.0 + 45.0 * e2**3 / 1024.0, math.sin(4.0 * phi)),
            (-(35.0 * e2**3 / 3072.0), math.sin(6.0 * phi)),
        )
    )
    x = UTM32.false_easting + UTM32.scale * n * (
        a + (1.0 - t + c) * a**3 / 6.0 + (5.0 - 18.0 * t + t * t + 72.0 * c - 58.0 * ep2) * a**5 / 120.0
    )
    y = UTM32.scale * (
        arc
        + n
        * math.tan(phi)
        * (
            a * a / 2.0
            + (5.0 - t + 9.0 * c + 4.0 * c * c) * a**4 / 24.0
            + (61.0 - 58.0 * t + t * t + 600.0 * c - 330.0 * ep2) * a**6 / 720.0
        )
    )
    return x, y


def region_bbox_utm(region: Region) -> tuple[float, float, float, float]:
    x, y = utm32_of(region.center_lon, region.center_lat)
    r = region.outer_radius_m
    return x - r, y - r, x + r, y + r
