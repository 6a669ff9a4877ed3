"""Parameters shared by the operators: the region of interest and the fixed thresholds."""

from __future__ import annotations

import math
from dataclasses import dataclass

EARTH_RADIUS_M = 6_371_000.0
WEB_MERCATOR_RADIUS_M = 6_378_137.0
WEB_MERCATOR_LIMIT_M = math.pi * WEB_MERCATOR_RADIUS_M

# Thresholds of the raster classification.
NODATA_DEFAULT = -9999.0
BUILDING_HEIGHT_M = 2.0
TREE_HEIGHT_M = 1.5
RELIEF_THRESHOLD_M = 3.0
RELIEF_RADIUS_M = 4.0
ROOF_OFFSET_M = 4.0
ROOF_SEARCH_RADIUS_M = 8.0
ROOF_CLUSTER_RADIUS_M = 3.0
ROOF_CLUSTER_Z_M = 1.5
FOOTPRINT_BUFFER_M = 1.5
TREE_TAG_RADIUS_M = 8.0
CANOPY_RADIUS_PX = 1
CANOPY_MIN_ALPHA = 16
CANOPY_MIN_GREEN = 60
CANOPY_EXCESS_GREEN = 8
ALIGN_RADIUS_M = 6
ALIGN_WARN_M = 2.0
ALIGN_FAIL_M = 5.0
INDEX_CELL_M = 32.0
STATS_CELL_M = 2.0

# Overlay and mesh tolerances.
ROI_SEGMENTS = 256
LAYER_SEGMENTS = 192
MIN_SURFACE_M2 = 0.01
MIN_OVERLAP_M2 = 0.05
TERRAIN_CLEARANCE_M = 0.05
DEFAULT_BUILDING_HEIGHT_M = 9.0
DEFAULT_ROOF_RAISE_M = 1.5
TRUNK_SEGMENTS = 14
CROWN_SEGMENTS = 16
CROWN_RINGS = 8

# Feature categories in report order.
CATEGORIES = (
    "buildings",
    "roads",
    "green_areas",
    "concrete",
    "water",
    "trees",
    "other_terrain",
    "gap_fill",
)


@dataclass(frozen=True)
class Region:
    """Circular region of interest; ``inner_diameter_m=None`` means one uniform zone."""

    center_lon: float
    center_lat: float
    outer_diameter_m: float
    inner_diameter_m: float | None = None
    crs: str = "EPSG:25832"

    @property
    def outer_radius_m(self) -> float:
        return self.outer_diameter_m / 2.0

    @property
    def inner_radius_m(self) -> float | None:
        return None if self.inner_diameter_m is None else self.inner_diameter_m / 2.0

    @property
    def meters_per_radian_lon(self) -> float:
        return EARTH_RADIUS_M * math.cos(math.radians(self.center_lat))

    def lonlat_bbox(self) -> tuple[float, float, float, float]:
        """(min_lon, min_lat, max_lon, max_lat) of the outer circle."""
        d_lat = math.degrees(self.outer_radius_m / EARTH_RADIUS_M)
        d_lon = math.degrees(self.outer_radius_m / self.meters_per_radian_lon)
        return (
            self.center_lon - d_lon,
            self.center_lat - d_lat,
            self.center_lon + d_lon,
            self.center_lat + d_lat,
        )


#: Region used by the driver queries.
DEMO_REGION = Region(11.2558, 43.7696, outer_diameter_m=500.0, inner_diameter_m=300.0)
