"""Purifier instances: metadata checks, catalogue join, dimensions, terrain placement, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import attributes as A
from geoloom.functions import crs as C
from geoloom.operators.mesh import mesh_bounds
from geoloom.operators.planning import SAFE_ID
from geoloom.operators.quality import long_counts
from geoloom.operators.terrain import sample_terrain
from geoloom.params import TERRAIN_CLEARANCE_M

DIMENSIONS = (("height", "height_m", "HEIGHT_M"), ("width", "width_m", "WIDTH_M"), ("depth", "depth_m", "DEPTH_M"))


def catalogue_dimension(models: DataFrame) -> DataFrame:
    """Catalogue rows with native sizes; octagonal towers use the base width twice.

    Adds ``error`` for unknown kinds, missing or non-positive sizes, absolute
    paths and repeated names.
    """
    octagonal, four = F.col("kind") == "octagonal", F.col("kind") == "four_side"
    width = F.when(octagonal, F.col("base_width_m")).when(four, F.col("width_m"))
    depth = F.when(octagonal, F.col("base_width_m")).when(four, F.col("depth_m"))
    repeated = models.groupBy("name").agg(F.count("*").alias("_uses"))
    df = models.join(repeated, "name", "left").withColumns({"native_width_m": width, "native_depth_m": depth})
    bad = lambda c: F.coalesce(F.col(c) <= 0.0, F.lit(True))
    error = (
        F.when(F.coalesce(A.strip(F.col("name")) == "", F.lit(True)), F.lit("missing name"))
        .when(F.col("_uses") > 1, F.lit("duplicate name"))
        .when(F.coalesce(~F.col("kind").isin("octagonal", "four_side"), F.lit(True)), F.lit("unknown kind"))
        .when(bad("height_m") | bad("native_width_m") | bad("native_depth_m"), F.lit("sizes must be positive"))
        .when(bad("linear_tolerance_m"), F.lit("tolerance must be positive"))
        .when(F.coalesce(F.col("output_path").startswith("/"), F.lit(True)), F.lit("output path must be relative"))
    )
    return df.select(
        F.col("name").alias("model"),
        "kind",
        "output_path",
        F.col("height_m").alias("native_height_m"),
        "native_width_m",
        "native_depth_m",
        "linear_tolerance_m",
        error.alias("error"),
    )


def check_mesh_bounds(catalogue: DataFrame, meshes: DataFrame) -> DataFrame:
    """Catalogue with ``bounds_ok``: mesh extent equals the native size and the base lies at zero."""
    b = mesh_bounds(meshes, ["model"])
    tol = F.col("linear_tolerance_m")
    size = lambda axis: F.col(f"max_{axis}") - F.col(f"min_{axis}")
    ok = (
        (F.abs("min_z") <= tol)
        & (F.abs(size("x") - F.col("native_width_m")) <= tol)
        & (F.abs(size("y") - F.col("native_depth_m")) <= tol)
        & (F.abs(size("z") - F.col("native_height_m")) <= tol)
    )
    return catalogue.join(b, "model", "left").withColumn("bounds_ok", F.coalesce(ok, F.lit(False))).select(
        *catalogue.columns, "bounds_ok"
    )


def metadata_errors() -> Column:
    """Error list of normalized purifier rows."""
    text = lambda c: F.coalesce(A.strip(F.col(c)) == "", F.lit(True))
    checks = {
        "missing purifier_id": text("purifier_id"),
        "unsafe purifier_id": ~text("purifier_id") & ~F.col("purifier_id").rlike(SAFE_ID),
        "missing model": text("model"),
        "missing urban_planning_input_id": text("urban_planning_input_id"),
        "missing source": text("source"),
        "invalid roi_zone": F.coalesce(~F.col("roi_zone").isin("inner", "annular", "full"), F.lit(True)),
        "invalid source_crs": F.coalesce(~F.col("source_crs").isin("EPSG:4326", "EPSG:3857"), F.lit(True)),
        "invalid source_feature_index": F.coalesce(F.col("source_feature_index") < 0, F.lit(True)),
        "missing source_properties": F.col("source_properties").isNull(),
        "invalid coordinates": F.col("lon").isNull() | F.col("lat").isNull() | F.isnan("lon") | F.isnan("lat"),
    }
    for _, name, _ in DIMENSIONS:
        checks[f"{name} must be positive"] = F.isnan(name) | (F.col(name) <= 0.0)
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(m)) for m, c in checks.items()]))


def resolve(features: DataFrame, catalogue: DataFrame, *, origin: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Placements with dimension provenance, rotation and scale; ``errors`` lists what is wrong with a row."""
    known = catalogue.where("error is null").drop("error")
    df = features.withColumn("errors", metadata_errors()).join(known, "model", "left")
    df = df.withColumn(
        "errors",
        F.when(
            F.col("native_height_m").isNull() & F.col("model").isNotNull(),
            F.array_append("errors", F.lit("unknown model")),
        ).otherwise(F.col("errors")),
    )
    for short, name, field in DIMENSIONS:
        df = df.withColumn(
            f"_{short}", A.target_dimension(F.col(name), field, F.col(f"native_{short}_m"), F.col("model"))
        )
    x, y = C.utm32_x(F.col("lon"), F.col("lat")), C.utm32_y(F.col("lon"), F.col("lat"))
    df = df.withColumns({"projected_x": x, "projected_y": y})
    out = {
        "local_x": F.col("projected_x") - origin[0],
        "local_y": F.col("projected_y") - origin[1],
        "rotation_source": F.when(
            F.col("rotation_deg").isNull(), F.concat(F.lit("default:"), F.col("model"))
        ).otherwise(F.lit("attribute:ROTATION_D")),
        "rotation_deg": F.pmod(F.coalesce("rotation_deg", F.lit(0.0)), F.lit(360.0)),
        "base_z": F.lit(0.0),
        "terrain_source": F.lit("z=0 fallback"),
    }
    for short, name, _ in DIMENSIONS:
        axis = {"height": "z", "width": "x", "depth": "y"}[short]
        out[name] = F.col(f"_{short}.value")
        out[f"{short}_source"] = F.col(f"_{short}.source")
        out[f"scale_{axis}"] = F.col(f"_{short}.value") / F.col(f"native_{short}_m")
    return df.withColumns(out).drop("_height", "_width", "_depth", "output_path")


def place_on_terrain(placements: DataFrame, triangles: DataFrame, *, source: str, on: Sequence[str] = ()) -> DataFrame:
    """Base heights from the terrain; all four rotated corners must be on it."""
    cos, sin = F.cos(F.radians("rotation_deg")), F.sin(F.radians("rotation_deg"))
    w, d = F.col("width_m") / 2.0, F.col("depth_m") / 2.0
    offsets = [(F.lit(0.0), F.lit(0.0)), (-w, -d), (-w, d), (w, -d), (w, d)]
    probes = F.array(
        *[
            F.struct(
                F.lit(n).alias("corner"),
                (F.col("local_x") + ox * cos - oy * sin).alias("x"),
                (F.col("local_y") + ox * sin + oy * cos).alias("y"),
            )
            for n, (ox, oy) in enumerate(offsets)
        ]
    )
    points = placements.select(*on, "purifier_id", F.explode(probes).alias("_c")).select(
        *on, "purifier_id", "_c.corner", "_c.x", "_c.y"
    )
    sampled = sample_terrain(points, triangles, key=["purifier_id", "corner"], on=on)
    height = sampled.groupBy(*on, "purifier_id").agg(
        F.count_if(F.col("terrain_status") == "outside").alias("_out"),
        F.max(F.when(F.col("corner") == 0, F.col("terrain_z"))).alias("_z"),
    )
    joined = placements.join(height, [*on, "purifier_id"], "left")
    on_mesh = F.col("_out") == 0
    return joined.withColumns(
        {
            "base_z": F.when(on_mesh, F.col("_z") - TERRAIN_CLEARANCE_M),
            "terrain_source": F.lit(source),
            "errors": F.when(on_mesh, F.col("errors")).otherwise(
                F.array_append("errors", F.lit("footprint is not on the terrain"))
            ),
        }
    ).drop("_out", "_z")


def counts(placements: DataFrame) -> DataFrame:
    """By model, input and the source of every parameter."""
    always = F.lit(True)
    return long_counts(
        placements,
        {
            "model": (F.col("model"), always),
            "input": (F.col("urban_planning_input_id"), always),
            "height_source": (F.col("height_source"), always),
            "width_source": (F.col("width_source"), always),
            "depth_source": (F.col("depth_source"), always),
            "rotation_source": (F.col("rotation_source"), always),
        },
    )
