"""Triangle meshes as tables: bounds, quality, transforms, concatenation, extrusion."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom import params as P
from geoloom.functions import measure as M
from geoloom.functions import triangles as T
from geoloom.operators import sweep as S
from geoloom.operators.ordering import even_sample, running_sum
from geoloom.operators.overlay import TILE_KEYS, TILE_M, _covered_by, _swept, _tile_of, edge_rows, route_to_tiles
from geoloom.operators.skew import lookup_join
from geoloom.schemas import TRI_COLS

REGIONS = ("inlet", "outlet", "tower")
#: Instances of one model in one task.
HOT_PLACED = 2_000

# Triangle limits of the review scene by kind.
REVIEW_LIMITS = {"building": 20_000, "terrain": 8_000, "surface_layer": 4_000}


def mesh_bounds(triangles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Extremes, extent and mean vertex per group."""
    agg = []
    for axis in "xyz":
        cols = [F.col(f"{v}{axis}") for v in "abc"]
        agg += [F.min(F.least(*cols)).alias(f"min_{axis}"), F.max(F.greatest(*cols)).alias(f"max_{axis}")]
    for axis in "xy":
        agg.append((F.sum(sum((F.col(f"{v}{axis}") for v in "abc"), F.lit(0.0))) / (F.count("*") * 3)).alias(f"mean_{axis}"))
    return triangles.groupBy(*by).agg(*agg, F.count("*").alias("triangles"))


def focus_point(triangles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean vertex of the building triangles, or of everything when there is no building."""
    b = F.col("kind") == "building"
    total = lambda axis, cond: F.sum(F.when(cond, sum((F.col(f"{v}{axis}") for v in "abc"), F.lit(0.0))))
    n = F.count_if(b)
    pick = lambda axis: F.when(n > 0, total(axis, b) / (n * 3)).otherwise(total(axis, F.lit(True)) / (F.count("*") * 3))
    return triangles.groupBy(*by).agg(pick("x").alias("focus_x"), pick("y").alias("focus_y"))


def with_normals(triangles: DataFrame) -> DataFrame:
    nx, ny, nz = T.normal()
    return triangles.withColumns({"nx": nx, "ny": ny, "nz": nz})


def valid_xy(triangles: DataFrame) -> DataFrame:
    """Terrain triangles with a non-degenerate XY footprint."""
    return triangles.where(T.all_finite() & (T.xy_area() > 1e-12))


def rejected(triangles: DataFrame) -> DataFrame:
    """Non-finite or degenerate triangles."""
    return triangles.where(~T.all_finite() | (T.cross_length() <= 1e-12))


def edge_counts(triangles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Uses of every undirected edge (vertices rounded to nine decimals)."""
    return _edge_uses(triangles, by).groupBy(*by, "_e").agg(F.count("*").alias("n"))


def _edge_uses(triangles: DataFrame, by: Sequence[str], face: Column | None = None) -> DataFrame:
    """Three rows per triangle: the edge ``_e`` and, with ``face``, that value in ``_f`` on the first of them."""
    v = lambda p: F.struct(*[F.round(f"{p}{axis}", 9).alias(axis) for axis in "xyz"]).alias(f"_v{p}")
    extra = [] if face is None else [face.alias("_face")]
    # Rounding is the dear part: a vertex is rounded once for both of its edges.
    rounded = triangles.select(*by, *[v(p) for p in "abc"], *extra)
    own = lambda k: [] if face is None else [(F.col("_face") if k == 0 else F.lit(None).cast("int")).alias("f")]
    edges = F.array(*[
        F.struct(F.least(f"_v{p}", f"_v{q}").alias("u"), F.greatest(f"_v{p}", f"_v{q}").alias("v"), *own(k)) for k, (p, q) in enumerate(("ab", "bc", "ca"))
    ])
    rows = rounded.select(*by, F.explode(edges).alias("_t"))
    return rows.select(*by, F.struct("_t.u", "_t.v").alias("_e"), *([] if face is None else [F.col("_t.f").alias("_f")]))


def mesh_quality(triangles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Edge statistics, rejected triangles and the closed-manifold verdict per group."""
    # Every triangle has a first edge, so faces are counted on the way: the mesh is built and dealt once.
    unusable = F.when(~T.all_finite() | (T.cross_length() <= 1e-12), 1).otherwise(0)
    uses = _edge_uses(triangles, by, unusable).groupBy(*by, "_e").agg(
        F.count("*").alias("n"), F.count("_f").alias("_faces"), F.count_if(F.col("_f") == 1).alias("_rejected")
    )
    # A group without a name has no edge statistics.
    named = F.lit(True)
    for c in by:
        named = named & F.col(c).isNotNull()
    totals = uses.groupBy(*by).agg(
        F.coalesce(F.sum("_faces"), F.lit(0)).alias("triangles"),
        F.coalesce(F.sum("_rejected"), F.lit(0)).alias("rejected_triangles"),
        F.count("*").alias("edges"),
        F.count_if(F.col("n") == 1).alias("boundary_edges"),
        F.count_if(F.col("n") > 2).alias("overused_edges"),
        F.count_if(F.col("n") != 2).alias("bad_edges"),
    )
    stats = ("edges", "boundary_edges", "overused_edges", "bad_edges")
    joined = totals.withColumns({c: F.when(named, F.col(c)) for c in stats})
    return joined.withColumn("closed_manifold", (F.col("bad_edges") == 0) & (F.col("rejected_triangles") == 0))


def region_completeness(triangles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Triangles per required region; complete when all three are present and nothing else is."""
    counts = [F.count_if(F.col("region") == r).alias(r) for r in REGIONS]
    other = F.count_if(~F.col("region").isin(*REGIONS))
    return triangles.groupBy(*by).agg(*counts, other.alias("other")).withColumn(
        "complete", (F.least(*REGIONS) > 0) & (F.col("other") == 0)
    )


def translate(triangles: DataFrame, dx: Column, dy: Column, dz: Column | None = None) -> DataFrame:
    shift = {"x": dx, "y": dy, "z": F.lit(0.0) if dz is None else dz}
    return triangles.withColumns({c: F.col(c) + shift[c[1]] for c in TRI_COLS})


def place_meshes(instances: DataFrame, meshes: DataFrame, *, model: str = "model") -> DataFrame:
    """Instance meshes: scale about the base centre, rotate about +Z, move to the target.

    ``instances``: ``scale_x, scale_y, scale_z, rotation_deg, to_x, to_y, to_z``
    and the model name; ``meshes``: ``model, region, tri_no`` and coordinates.
    Instances with unusable parameters must have been rejected before.
    """
    bounds = mesh_bounds(meshes, [model]).select(
        model,
        ((F.col("min_x") + F.col("max_x")) / 2.0).alias("_mx"),
        ((F.col("min_y") + F.col("max_y")) / 2.0).alias("_my"),
        F.col("min_z").alias("_mz"),
    )
    cos, sin = F.cos(F.radians("rotation_deg")), F.sin(F.radians("rotation_deg"))
    spread = [c for c, kind in instances.dtypes if "map<" not in kind and "variant" not in kind]
    width = int(instances.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A few models stand for all instances: those of one model are dealt to many tasks.
    df = lookup_join(instances, meshes.join(bounds, model), [model], spread=spread, how="inner", hot_rows=HOT_PLACED, width=width)
    df = df.withColumns({"_cos": cos, "_sin": sin})
    moved = {}
    for v in "abc":
        x = (F.col(f"{v}x") - F.col("_mx")) * F.col("scale_x")
        y = (F.col(f"{v}y") - F.col("_my")) * F.col("scale_y")
        z = (F.col(f"{v}z") - F.col("_mz")) * F.col("scale_z")
        moved[f"{v}x"] = x * F.col("_cos") - y * F.col("_sin") + F.col("to_x")
        moved[f"{v}y"] = x * F.col("_sin") + y * F.col("_cos") + F.col("to_y")
        moved[f"{v}z"] = z + F.col("to_z")
    return df.withColumns(moved).drop("_cos", "_sin", "_mx", "_my", "_mz")


def transform_errors(instances: DataFrame) -> Column:
    """Message for non-finite parameters or non-positive scale factors."""
    finite = F.lit(True)
    for c in ("scale_x", "scale_y", "scale_z", "rotation_deg", "to_x", "to_y", "to_z"):
        finite = finite & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    positive = (F.col("scale_x") > 0) & (F.col("scale_y") > 0) & (F.col("scale_z") > 0)
    return F.when(~finite, F.lit("transformation values must be finite")).when(
        ~positive, F.lit("scale factors must be positive")
    )


def vertex_offsets(meshes: DataFrame, *, order: str, by: Sequence[str] = ()) -> DataFrame:
    """First vertex number of every source mesh when meshes are concatenated in order."""
    return running_sum(meshes, F.col("vertices"), order=order, out="vertex_offset", by=by, inclusive=False)


def concat_meshes(sources: dict[str, DataFrame], limits: dict[str, int] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Labelled union of triangle sets; ``limits`` (such as ``REVIEW_LIMITS``) thin kinds evenly, otherwise all triangles stay."""
    limits = limits or {}
    out = None
    for kind, triangles in sources.items():
        limit = limits.get(kind.split(":")[0])
        rows = triangles if limit is None else even_sample(triangles, limit, order="tri_no", by=by)
        rows = rows.select(*by, F.lit(kind).alias("kind"), "tri_no", *TRI_COLS)
        out = rows if out is None else out.unionByName(rows)
    return out


def region_order(triangles: DataFrame) -> DataFrame:
    """Deterministic order inside a region (by the nine coordinates)."""
    return triangles.orderBy("region", *TRI_COLS)


# --- extrusion -------------------------------------------------------------------------------


def _tri(kind: Column, *points: tuple[Column, Column, Column]) -> Column:
    cols = [kind.alias("surface")]
    for p, name in zip(points, "abc"):
        cols += [v.cast("double").alias(f"{name}{axis}") for v, axis in zip(p, "xyz")]
    return F.struct(*cols)


def wall_triangles(buildings: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Two triangles per ring edge and, with a roof shape, one more up to the raised centroid.

    ``buildings``: ``parts, base_z, top_z, roof_raise``.
    """
    centered = buildings.withColumn("_c", M.area_centroid(F.col("parts")))
    rings = centered.select(*keep, "base_z", "top_z", "roof_raise", "_c", F.explode(F.flatten("parts")).alias("_r"))
    ends = F.transform(
        F.sequence(F.lit(1), F.size("_r") - 1),
        lambda i: F.struct(F.get(F.col("_r"), i - 1).alias("p"), F.get(F.col("_r"), i).alias("q")),
    )
    edges = rings.where(F.size("_r") >= 4).withColumn("_ends", ends).select(
        *keep, "base_z", "top_z", "roof_raise", "_c", F.explode("_ends").alias("_e")
    )
    px, py, qx, qy = F.col("_e.p.x"), F.col("_e.p.y"), F.col("_e.q.x"), F.col("_e.q.y")
    lo, hi = F.col("base_z"), F.col("top_z")
    wall = F.lit("wall")
    peak = F.when(
        F.col("roof_raise") > 0.0,
        _tri(F.lit("raised_roof"), (px, py, hi), (qx, qy, hi), (F.col("_c.x"), F.col("_c.y"), hi + F.col("roof_raise"))),
    )
    tris = F.array_compact(
        F.array(
            _tri(wall, (px, py, lo), (qx, qy, lo), (qx, qy, hi)),
            _tri(wall, (px, py, lo), (qx, qy, hi), (px, py, hi)),
            peak,
        )
    )
    return edges.withColumn("_tris", tris).select(*keep, F.explode("_tris").alias("_t")).select(*keep, "_t.*")


def roof_triangles(buildings: DataFrame, keep: Sequence[str], *, seq: str = "seq", on: Sequence[str] = (), tile: float = TILE_M) -> DataFrame:
    """Flat roof faces: the footprint cut into trapezoids, two triangles each (tiny ones dropped)."""
    shapes = buildings.select(*on, F.col(seq).alias("seq"), "parts")
    routed = route_to_tiles(edge_rows(shapes), on=on, tile=tile)
    key_types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shapes.select(*on).schema)
    schema = ", ".join(
        t for t in (key_types, "seq bigint, ax double, ay double, bx double, by double, cx double, cy double") if t
    )
    keys = list(on)

    def cover(pdf: pd.DataFrame) -> pd.DataFrame:
        box = _tile_of(pdf)
        seqs, group = np.unique(pdf["seq"].to_numpy(np.int64), return_inverse=True)
        s = _swept(pdf, np.zeros(len(pdf), np.int64), [(2, S.tile_edges(*box))], group.astype(np.int64))
        live = np.flatnonzero(_covered_by(s, 0) & _covered_by(s, 2))
        label, y0, y1, l0, l1, r0, r1 = S.merge_runs(s, live, s.group[live])
        first = np.column_stack([l0, y0, r0, y0, r1, y1])
        second = np.column_stack([l0, y0, r1, y1, l1, y1])
        tri = np.vstack([first, second])
        area = np.abs((tri[:, 2] - tri[:, 0]) * (tri[:, 5] - tri[:, 1]) - (tri[:, 4] - tri[:, 0]) * (tri[:, 3] - tri[:, 1])) / 2
        ok = area > 0.001
        out = pd.DataFrame(tri[ok], columns=["ax", "ay", "bx", "by", "cx", "cy"])
        out.insert(0, "seq", seqs[np.concatenate([label, label])][ok])
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    faces = routed.groupBy(*on, *TILE_KEYS).applyInPandas(cover, schema).withColumnRenamed("seq", seq)
    tops = buildings.select(*dict.fromkeys([*on, seq, *keep]), "top_z")
    return faces.join(tops, [*on, seq]).select(
        *keep,
        F.lit("roof").alias("surface"),
        *[F.col(c) if c[1] != "z" else F.col("top_z").alias(c) for c in TRI_COLS],
    )


def extrude_buildings(buildings: DataFrame, keep: Sequence[str], *, seq: str = "seq", on: Sequence[str] = ()) -> DataFrame:
    """Walls, flat roofs and raised roof faces of buildings."""
    return wall_triangles(buildings, keep).unionByName(roof_triangles(buildings, keep, seq=seq, on=on))


def roof_raise(has_shape: Column) -> Column:
    return F.when(has_shape, F.lit(P.DEFAULT_ROOF_RAISE_M)).otherwise(F.lit(0.0))

