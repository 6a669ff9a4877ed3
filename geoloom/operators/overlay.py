"""Polygon overlay as tiled jobs: precedence partition, clip, gap fill, overlaps, union area.

Every operator follows the same plan: polygons become edge rows, edge rows are
routed to the square tiles they can influence (crowded tiles are refined), each
tile is swept independently in an Arrow grouped map, and per-tile results are
summed per feature. A river that crosses a thousand tiles is therefore worked
on by a thousand tasks, and no feature-by-feature pair list is ever built.

Identical copies of a geometry are collapsed before routing, because all but
the best-ranked copy are fully covered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions import measure as M
from geoloom.operators import sweep as S
from geoloom.operators.ordering import blocked_ordinal
from geoloom.operators.rings import outlines
from geoloom.operators.skew import connected_components, cut_lineage, lookup_join
from geoloom.operators.spatial import _refine, box_join, crowded_cells
from geoloom.params import LAYER_SEGMENTS, MIN_OVERLAP_M2, MIN_SURFACE_M2, ROI_SEGMENTS, Region

TILE_M = 128.0
HOT_EDGES = 50_000
#: Tiles between the outer columns of a geometry from which on its edges go to their own tiles only.
WIDE = 4
TILE_KEYS = ["_depth", "_fx", "_fy"]


def edge_rows(polygons: DataFrame, parts: str = "parts") -> DataFrame:
    """One row per non-horizontal edge with the x-range of its whole geometry (``ex0, ex1``)."""
    others = [c for c in polygons.columns if c != parts]
    boxed = polygons.withColumn("_b", M.parts_bbox(F.col(parts)))
    rings = boxed.select(*others, "_b", F.explode(F.flatten(parts)).alias("_ring"))
    ends = F.transform(
        F.sequence(F.lit(0), F.size("_ring") - 1),
        lambda i: F.struct(
            F.get(F.col("_ring"), i).alias("a"), F.get(F.col("_ring"), F.pmod(i + 1, F.size("_ring"))).alias("b")
        ),
    )
    return (
        rings.where(F.size("_ring") >= 3)
        .withColumn("_ends", ends)
        .select(*others, "_b", F.explode("_ends").alias("_e"))
        .where("_e.a.y <> _e.b.y")
        .select(
            *others,
            F.col("_e.a.x").alias("ax"),
            F.col("_e.a.y").alias("ay"),
            F.col("_e.b.x").alias("bx"),
            F.col("_e.b.y").alias("by"),
            F.col("_b.min_x").alias("ex0"),
            F.least("_e.a.y", "_e.b.y").alias("ey0"),
            F.col("_b.max_x").alias("ex1"),
            F.greatest("_e.a.y", "_e.b.y").alias("ey1"),
        )
    )


EDGE_BOX = ("ex0", "ey0", "ex1", "ey1")


def backdrop(columns: tuple[int, int], first: np.ndarray, last: np.ndarray, ya: np.ndarray, yb: np.ndarray) -> list[tuple[int, int, float, float]]:
    """(column, side, y, y): the stretches of the tile sides of one row that lie inside a polygon.

    An edge in the columns ``first`` to ``last`` counts at the left side (0) of the
    tiles behind it and at the right side (1) of those before it. Two stretches
    that meet cancel their common end, so a stretch is known by the ends that an
    odd number of edges have, and it changes only where an edge begins or ends.
    """
    out: list[tuple[int, int, float, float]] = []
    for side in (0, 1):
        # Walk away from the edges' own tiles: to the right for the left sides, to the left for the right ones.
        at = last + 1 if side == 0 else first - 1
        order = np.argsort(at if side == 0 else -at, kind="stable")
        steps, k, ends = at[order].tolist(), 0, set()
        column, stop, step = (columns[0], columns[1] + 1, 1) if side == 0 else (columns[1], columns[0] - 1, -1)
        while column != stop:
            while k < len(order) and (steps[k] - column) * step <= 0:
                e = order[k]
                ends ^= {float(ya[e]), float(yb[e])} if ya[e] != yb[e] else set()
                k += 1
            until = steps[k] if k < len(order) else stop
            until = min(until, stop) if step > 0 else max(until, stop)
            if ends:
                y = sorted(ends)
                spans = list(zip(y[::2], y[1::2]))
                out += [(c, side, lo, hi) for c in range(column, until, step) for lo, hi in spans]
            column = until
    return out


def _base_tiles(edges: DataFrame, tile: float) -> DataFrame:
    """Edge rows in the base tiles ``_gx, _gy`` in which they count.

    The edges of a narrow geometry go to all tiles across its width. Those of a
    wide one go to the tiles they touch, and its other tiles get the stretches
    of :func:`backdrop`, so its rows are as many as its edges and tiles together.
    """
    others = [c for c in edges.columns if c not in ("ax", "ay", "bx", "by", *EDGE_BOX)]
    low, high = F.floor(F.col("ex0") / tile), F.floor(F.col("ex1") / tile)
    wide = high - low >= WIDE
    rows = edges.withColumn("_gy", F.explode(F.sequence(F.floor(F.col("ey0") / tile), F.floor(F.col("ey1") / tile))))
    rows = rows.where((F.col("ey1") > F.col("_gy") * tile) & (F.col("ey0") < (F.col("_gy") + 1) * tile))
    clip = lambda y: F.greatest(F.col("_gy") * tile, F.least((F.col("_gy") + 1) * tile, F.col(y)))
    slope = (F.col("bx") - F.col("ax")) / (F.col("by") - F.col("ay"))
    at = lambda y, p: F.when(y == F.col(f"{p}y"), F.col(f"{p}x")).otherwise(F.col("ax") + (y - F.col("ay")) * slope)
    rows = rows.withColumns({"_ya": clip("ay"), "_yb": clip("by")})
    rows = rows.withColumns({"_xa": at(F.col("_ya"), "a"), "_xb": at(F.col("_yb"), "b")})
    first, last = F.floor(F.least("_xa", "_xb") / tile), F.floor(F.greatest("_xa", "_xb") / tile)
    placed = rows.withColumn("_gx", F.explode(F.sequence(F.when(wide, first).otherwise(low), F.when(wide, last).otherwise(high))))
    own = lambda cut, whole: F.when(wide, cut).otherwise(F.col(whole)).alias(whole)
    side = [own(F.col("_gx") * tile, "ex0"), own(F.least("_ya", "_yb"), "ey0"), own((F.col("_gx") + 1) * tile, "ex1"), own(F.greatest("_ya", "_yb"), "ey1")]
    ends = [own(F.col(c), e) for c, e in (("_xa", "ax"), ("_ya", "ay"), ("_xb", "bx"), ("_yb", "by"))]
    placed = placed.select(*others, "_gx", "_gy", *ends, *side)

    def filled(part: pd.DataFrame) -> pd.DataFrame:
        columns = int(part["_low"].iloc[0]), int(part["_high"].iloc[0])
        made = backdrop(columns, *(part[c].to_numpy() for c in ("_first", "_last", "_ya", "_yb")))
        out = pd.DataFrame(made, columns=["_gx", "_side", "ay", "by"])
        for k, c in enumerate([*others, "_gy"]):
            out.insert(k, c, part[c].iloc[0])
        return out

    types = [f"`{c}` {edges.schema[c].dataType.simpleString()}" for c in others]
    spread = rows.where(wide).select(*others, "_gy", low.alias("_low"), high.alias("_high"), first.alias("_first"), last.alias("_last"), "_ya", "_yb")
    inner = spread.groupBy(*others, "_gy").applyInPandas(filled, ", ".join([*types, "_gy bigint, _gx bigint, _side int, ay double, by double"]))
    x = (F.col("_gx") + F.col("_side")) * tile
    inner = inner.select(
        *others, "_gx", "_gy", x.alias("ax"), "ay", x.alias("bx"), "by",
        (F.col("_gx") * tile).alias("ex0"), F.col("ay").alias("ey0"), ((F.col("_gx") + 1) * tile).alias("ex1"), F.col("by").alias("ey1"),
    )
    return placed.unionByName(inner)


def route_to_tiles(
    edges: DataFrame, *, on: Sequence[str] = (), tile: float = TILE_M, hot_edges: int = HOT_EDGES
) -> DataFrame:
    """Send every edge to the tiles it influences, cut to the tile.

    Edges beside a tile are moved onto its side, which keeps the inside/outside
    parity of every scan line in the tile.
    """
    keys = [*on, "_gx", "_gy"]
    cells = _base_tiles(edges, tile)
    hot = F.broadcast(crowded_cells([cells], keys, hot_edges))
    fine = _refine(
        cells.join(hot, keys, "left").withColumn("_depth", F.coalesce("_depth", F.lit(0))), EDGE_BOX, tile, 0.0
    ).drop("_gx", "_gy", "_s0")
    size = tile / F.pow(F.lit(2.0), F.col("_depth"))
    placed = fine.withColumns(
        {
            "tx0": F.col("_fx") * size,
            "ty0": F.col("_fy") * size,
            "tx1": (F.col("_fx") + 1) * size,
            "ty1": (F.col("_fy") + 1) * size,
        }
    ).where("ey1 > ty0 and ey0 < ty1")
    inside_y = lambda y: F.greatest(F.col("ty0"), F.least(F.col("ty1"), y))
    slope = (F.col("bx") - F.col("ax")) / (F.col("by") - F.col("ay"))
    at = lambda y, own_y, own_x: F.when(y == own_y, own_x).otherwise(F.col("ax") + (y - F.col("ay")) * slope)
    cut = placed.withColumns({"_ya": inside_y(F.col("ay")), "_yb": inside_y(F.col("by"))}).withColumns(
        {"_xa": at(F.col("_ya"), F.col("ay"), F.col("ax")), "_xb": at(F.col("_yb"), F.col("by"), F.col("bx"))}
    )
    left = F.greatest("_xa", "_xb") <= F.col("tx0")
    right = F.least("_xa", "_xb") >= F.col("tx1")
    pushed = lambda x: F.when(left, F.col("tx0")).when(right, F.col("tx1")).otherwise(F.col(x))
    placed = cut.withColumns({"ax": pushed("_xa"), "ay": F.col("_ya"), "bx": pushed("_xb"), "by": F.col("_yb")}).drop(
        *EDGE_BOX, "_ya", "_yb", "_xa", "_xb"
    )
    # The sweep is heavy per byte, so its tasks keep the configured parallelism instead of being coalesced by size.
    width = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(width, *on, *TILE_KEYS)


def _over_tiles(routed: DataFrame, on: Sequence[str], made: Callable[[pa.Table, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """``made`` over the routed edges, many whole tiles at once: it gets their rows and where each tile starts.

    A tile has few edges, so a call for each one costs more than its sweep.
    """
    keys = [*on, *TILE_KEYS]

    def starts(rows: pa.Table) -> np.ndarray:
        fresh = np.zeros(rows.num_rows, bool)
        fresh[:1] = True
        for k in keys:
            code = rows.column(k).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            fresh[1:] |= code[1:] != code[:-1]
        return np.flatnonzero(fresh)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            first = starts(rows)
            if len(first) > 1:  # the last tile may go on in the next batch
                yield made(rows.slice(0, int(first[-1])), first[:-1])
                rows = rows.slice(int(first[-1]))
            held = rows
        if held is not None and held.num_rows:
            yield made(held, np.zeros(1, np.int64))

    return routed.sortWithinPartitions(*keys).mapInArrow(run, schema)


def _numbers(rows: pa.Table, columns: Sequence[str]) -> list[np.ndarray]:
    return [rows.column(c).to_numpy() for c in columns]


def _seqs(rows: pa.Table) -> np.ndarray:
    return pc.fill_null(rows.column("seq"), np.iinfo(np.int64).min).to_numpy()


def _tile_of(pdf: pd.DataFrame) -> tuple[float, float, float, float]:
    row = pdf.iloc[0]
    return float(row["tx0"]), float(row["ty0"]), float(row["tx1"]), float(row["ty1"])


def _swept(pdf: pd.DataFrame, poly: np.ndarray, extra: list[tuple[int, np.ndarray]], group=None) -> S.Sweep:
    """Sweep the edges of a tile together with extra polygons given as (id, edges)."""
    e = pdf[["ax", "ay", "bx", "by"]].to_numpy(float)
    group = np.zeros(len(e), np.int64) if group is None else group
    groups = np.unique(group) if len(group) else np.zeros(1, np.int64)
    stacked, of_group, of_poly = [e], [group], [poly]
    for number, edges in extra:
        stacked.append(np.tile(edges, (len(groups), 1)))
        of_group.append(np.repeat(groups, len(edges)))
        of_poly.append(np.full(len(groups) * len(edges), number))
    e, group, poly = np.concatenate(stacked), np.concatenate(of_group), np.concatenate(of_poly)
    return S.sweep(group, poly, *e.T)


def _covered_by(s: S.Sweep, poly: int) -> np.ndarray:
    flag = np.zeros(len(s.slab), bool)
    flag[s.cover_trap[s.cover_poly == poly]] = True
    return flag


# --- precedence partition ------------------------------------------------------------


def _leaders(features: DataFrame, on: Sequence[str], priority: Sequence[str]) -> DataFrame:
    """Best-ranked feature of every distinct geometry, with the number of copies."""
    return features.groupBy(*on, "parts").agg(
        F.min(F.struct(*priority)).alias("_lead"), F.count("*").alias("_copies")
    ).select(*on, "parts", *[F.col(f"_lead.{p}").alias(p) for p in priority], "_copies")


def surface_pieces(
    features: DataFrame, *, on: Sequence[str] = (), tile: float = TILE_M, hot_edges: int = HOT_EDGES
) -> DataFrame:
    """Disjoint trapezoids, each owned by the first feature in ``(rank, seq)`` order that covers it.

    Input columns: ``on``, ``rank``, ``seq``, ``parts``. Output: ``on``, ``seq``
    and the trapezoid ``y_lo, y_hi, xl_lo, xl_hi, xr_lo, xr_hi``.
    """
    lead = _leaders(features, on, ("rank", "seq")).select(*on, "rank", "seq", "parts")
    routed = route_to_tiles(edge_rows(lead), on=on, tile=tile, hot_edges=hot_edges)
    key_types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in features.select(*on).schema)
    schema = ", ".join(
        t for t in (key_types, "seq bigint, y_lo double, y_hi double, xl_lo double, xl_hi double, xr_lo double, xr_hi double") if t
    )
    keys = list(on)

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        order, poly = _priority(pdf)
        s = _swept(pdf, poly, [(-1, S.tile_edges(*_tile_of(pdf)))])
        owner = _first_cover(s, len(order))
        live = np.flatnonzero(_covered_by(s, -1) & (owner < len(order)))
        label, *shape = S.merge_runs(s, live, owner[live])
        out = pd.DataFrame(dict(zip(("y_lo", "y_hi", "xl_lo", "xl_hi", "xr_lo", "xr_hi"), shape)))
        out.insert(0, "seq", order[label])
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    return routed.groupBy(*on, *TILE_KEYS).applyInPandas(own, schema)


def _priority(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers in (rank, seq) order and the position of every edge's feature in it."""
    table = pdf[["rank", "seq"]].drop_duplicates().sort_values(["rank", "seq"])
    order = table["seq"].to_numpy(np.int64)
    by_seq = np.argsort(order, kind="stable")
    return order, by_seq[np.searchsorted(order[by_seq], pdf["seq"].to_numpy(np.int64))]


def _first_cover(s: S.Sweep, none: int) -> np.ndarray:
    """Smallest covering polygon number per trapezoid (``none`` when uncovered)."""
    owner = np.full(len(s.slab), none, np.int64)
    real = s.cover_poly >= 0
    np.minimum.at(owner, s.cover_trap[real], s.cover_poly[real])
    return owner


def surface_areas(
    features: DataFrame, *, on: Sequence[str] = (), tile: float = TILE_M, hot_edges: int = HOT_EDGES
) -> DataFrame:
    """Per distinct geometry leader: ``source_area`` and ``owned_area`` (columns ``on, seq``)."""
    lead = _leaders(features, on, ("rank", "seq")).select(*on, "rank", "seq", "parts")
    routed = route_to_tiles(edge_rows(lead), on=on, tile=tile, hot_edges=hot_edges)
    key_types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in features.select(*on).schema)
    schema = ", ".join(t for t in (key_types, "seq bigint, source_area double, owned_area double") if t)
    keys = list(on)

    def measure(pdf: pd.DataFrame) -> pd.DataFrame:
        order, poly = _priority(pdf)
        s = _swept(pdf, poly, [(-1, S.tile_edges(*_tile_of(pdf)))])
        area = np.where(_covered_by(s, -1), s.area, 0.0)
        owner = _first_cover(s, len(order))
        owned = np.bincount(owner, weights=area, minlength=len(order) + 1)[: len(order)]
        real = s.cover_poly >= 0
        covered = np.bincount(s.cover_poly[real], weights=area[s.cover_trap[real]], minlength=len(order))
        out = pd.DataFrame({"seq": order, "source_area": covered[: len(order)], "owned_area": owned})
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    tiles = routed.groupBy(*on, *TILE_KEYS).applyInPandas(measure, schema)
    return tiles.groupBy(*on, "seq").agg(F.sum("source_area").alias("source_area"), F.sum("owned_area").alias("owned_area"))


def partition_surfaces(
    features: DataFrame,
    *,
    on: Sequence[str] = (),
    tile: float = TILE_M,
    hot_edges: int = HOT_EDGES,
    min_area: float = MIN_SURFACE_M2,
) -> DataFrame:
    """Features with ``source_area_m2, area_m2, removed_area_m2, state``.

    ``state`` is ``accepted``, ``clipped`` (more than ``min_area`` removed) or
    ``removed`` (nothing above ``min_area`` left). The reference order is
    ``(rank, seq)``; because the union of all results before a feature equals
    the union of all originals before it, features are independent.
    """
    areas = surface_areas(features, on=on, tile=tile, hot_edges=hot_edges).withColumnRenamed("seq", "_lead_seq")
    lead = (
        features.groupBy(*on, "parts")
        .agg(F.min(F.struct("rank", "seq")).alias("_l"))
        .select(*on, "parts", F.col("_l.seq").alias("_lead_seq"))
    )
    measured = lead.join(areas, [*on, "_lead_seq"], "left")
    joined = lookup_join(features, measured, [*on, "parts"], spread=["seq"])
    owned = F.when(F.col("seq") == F.col("_lead_seq"), F.coalesce("owned_area", F.lit(0.0))).otherwise(F.lit(0.0))
    return (
        joined.withColumns({"source_area_m2": F.coalesce("source_area", F.lit(0.0)), "_owned": owned})
        .withColumn("area_m2", F.when(F.col("_owned") > min_area, F.col("_owned")).otherwise(F.lit(0.0)))
        .withColumn("removed_area_m2", F.greatest(F.lit(0.0), F.col("source_area_m2") - F.col("area_m2")))
        .withColumn(
            "state",
            F.when(F.col("area_m2") == 0.0, F.lit("removed"))
            .when(F.col("removed_area_m2") > min_area, F.lit("clipped"))
            .otherwise(F.lit("accepted")),
        )
        .drop("_lead_seq", "source_area", "owned_area", "_owned")
    )


def disjoint_surfaces(
    features: DataFrame,
    *,
    on: Sequence[str] = (),
    tile: float = TILE_M,
    hot_edges: int = HOT_EDGES,
    min_area: float = MIN_SURFACE_M2,
) -> DataFrame:
    """:func:`partition_surfaces` with the remaining polygons in ``parts``.

    Of a clipped feature every separate piece of at most ``min_area`` is dropped;
    areas and state are those of what is left, and removed features have no parts.
    """
    states = cut_lineage(partition_surfaces(features, on=on, tile=tile, hot_edges=hot_edges, min_area=min_area))
    cut = states.where("state = 'clipped'").select(*on, "seq")
    pieces = surface_pieces(features, on=on, tile=tile, hot_edges=hot_edges).join(cut, [*on, "seq"], "left_semi")
    shapes = outlines(pieces, [*on, "seq"], min_area=min_area).withColumnRenamed("parts", "_cut")
    clipped = F.col("state") == "clipped"
    joined = states.join(shapes, [*on, "seq"], "left")
    left = F.when(clipped, F.col("_cut")).when(F.col("state") == "accepted", F.col("parts"))
    area = F.when(clipped, F.coalesce(M.parts_area(F.col("_cut")), F.lit(0.0))).otherwise(F.col("area_m2"))
    return (
        joined.withColumns({"parts": left, "area_m2": area})
        .withColumn("removed_area_m2", F.greatest(F.lit(0.0), F.col("source_area_m2") - F.col("area_m2")))
        .withColumn("state", F.when(clipped & F.col("_cut").isNull(), F.lit("removed")).otherwise(F.col("state")))
        .drop("_cut")
    )


def overlap_statistics(partitioned: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts and removed area of :func:`partition_surfaces` per group."""
    return partitioned.groupBy(*by).agg(
        F.count("*").alias("input_features"),
        F.count_if(F.col("state") != "removed").alias("accepted_features"),
        F.count_if(F.col("state") == "clipped").alias("clipped_features"),
        F.count_if(F.col("state") == "removed").alias("removed_features"),
        F.round(F.sum("removed_area_m2"), 3).alias("removed_area_m2"),
    )


def precedence_rank(
    features: DataFrame, selectors: Sequence[str], *, out: str = "rank"
) -> DataFrame:
    """Position of the most specific selector that is present in the list (supplement, group, category).

    The list is configuration, so it becomes a map literal; features that match
    nothing get a null rank.
    """
    positions = F.create_map(*[F.lit(v) for i, s in enumerate(selectors) for v in (s, i)])
    supplement = F.concat(F.lit("supplemental:"), F.nullif(F.col("supplemental_input_id"), F.lit("")))
    group = F.concat(F.col("category"), F.lit(":"), F.nullif(F.col("group_tag"), F.lit("")))
    look = lambda s: F.when(s.isNotNull(), F.try_element_at(positions, F.coalesce(s, F.lit(""))))
    return features.withColumn(out, F.coalesce(look(supplement), look(group), look(F.col("category"))).cast("bigint"))


# --- union area ----------------------------------------------------------------------


def union_area(features: DataFrame, *, on: Sequence[str] = (), tile: float = TILE_M, hot_edges: int = HOT_EDGES) -> DataFrame:
    """Area covered by at least one polygon, per group of ``on``."""
    ranked = features.select(*on, "seq", "parts").withColumn("rank", F.lit(0))
    areas = surface_areas(ranked, on=on, tile=tile, hot_edges=hot_edges)
    return areas.groupBy(*on).agg(F.sum("owned_area").alias("union_area_m2"))


# --- pairwise overlaps ------------------------------------------------------------------


def geometry_overlaps(
    shapes: DataFrame,
    *,
    gid: str = "gid",
    on: Sequence[str] = (),
    side: str | None = None,
    tile: float = TILE_M,
    hot_edges: int = HOT_EDGES,
) -> DataFrame:
    """Intersection area of every overlapping pair of geometries (``gid_a < gid_b`` unless ``side`` is given).

    With ``side`` (an integer column holding 0 or 1) only pairs across sides are
    reported, ``gid_a`` from side 0 and ``gid_b`` from side 1.
    """
    flag = F.lit(0) if side is None else F.col(side)
    shapes = shapes.select(*on, F.col(gid).cast("bigint").alias("gid"), flag.cast("bigint").alias("side"), "parts")
    routed = route_to_tiles(edge_rows(shapes), on=on, tile=tile, hot_edges=hot_edges)
    key_types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shapes.select(*on).schema)
    schema = ", ".join(t for t in (key_types, "gid_a bigint, gid_b bigint, area double") if t)
    keys, two_sided = list(on), side is not None

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf[["side", "gid"]].drop_duplicates().sort_values(["side", "gid"])
        code = {pair: i for i, pair in enumerate(map(tuple, ids.to_numpy(np.int64)))}
        poly = np.array([code[p] for p in zip(pdf["side"].to_numpy(np.int64), pdf["gid"].to_numpy(np.int64))], np.int64)
        s = _swept(pdf, poly, [(-1, S.tile_edges(*_tile_of(pdf)))])
        area = np.where(_covered_by(s, -1), s.area, 0.0)
        real = (s.cover_poly >= 0) & (area[s.cover_trap] > 0.0)
        trap, cover = s.cover_trap[real], s.cover_poly[real]
        order = np.lexsort((cover, trap))
        trap, cover = trap[order], cover[order]
        depth_end = np.searchsorted(trap, trap, "right")
        first, step = S._spread(depth_end - np.arange(len(trap)) - 1)
        second = first + 1 + step
        a, b, w = cover[first], cover[second], area[trap[first]]
        sides, gids = ids["side"].to_numpy(np.int64), ids["gid"].to_numpy(np.int64)
        if two_sided:
            cross = sides[a] != sides[b]
            a, b, w = a[cross], b[cross], w[cross]
        total = pd.DataFrame({"a": a, "b": b, "area": w}).groupby(["a", "b"], as_index=False)["area"].sum()
        out = pd.DataFrame(
            {"gid_a": gids[total["a"].to_numpy(int)], "gid_b": gids[total["b"].to_numpy(int)], "area": total["area"]}
        )
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    tiles = routed.groupBy(*on, *TILE_KEYS).applyInPandas(pairs, schema)
    return tiles.groupBy(*on, "gid_a", "gid_b").agg(F.sum("area").alias("area"))


class FootprintOverlaps:
    """Overlap quality check of footprints, on distinct geometries with multiplicities.

    ``features``: ``seq`` (feature index), ``parts``, ``source_tag``. Pairs run
    across features only; every polygon part counts on its own. Copies of one
    geometry are never paired row by row: their pairs are counted, and only the
    pairs that can reach the top list are spelled out.
    """

    def __init__(
        self,
        features: DataFrame,
        *,
        on: Sequence[str] = (),
        tile: float = TILE_M,
        hot_edges: int = HOT_EDGES,
        min_area: float = MIN_OVERLAP_M2,
    ) -> None:
        self.features, self.on, self.min_area = features, list(on), min_area
        polygons = features.select(*on, "seq", "source_tag", F.explode("parts").alias("polygon"))
        self.polygons = polygons
        distinct = polygons.groupBy(*on, "polygon").agg(
            F.count("*").alias("n"),
            F.min("seq").alias("gid_seq"),
            F.max("seq").alias("max_seq"),
        )
        # The checkpoint fixes the numbers that name the geometries.
        self.shapes = cut_lineage(
            distinct.withColumn("gid", F.monotonically_increasing_id()).withColumn(
                "shape_area", M.polygon_area(F.col("polygon"))
            )
        )
        shapes = self.shapes.withColumn("parts", F.array("polygon"))
        crossing = geometry_overlaps(shapes, on=on, tile=tile, hot_edges=hot_edges)
        own = self.shapes.where("n > 1 and gid_seq < max_seq").select(
            *on, F.col("gid").alias("gid_a"), F.col("gid").alias("gid_b"), F.col("shape_area").alias("area")
        )
        # Both reports read the shapes and the pairs several times.
        self.pairs = cut_lineage(crossing.unionByName(own).where(F.col("area") > min_area))
        self.members = lookup_join(
            polygons, self.shapes.select(*on, "polygon", "gid"), [*on, "polygon"], spread=["seq"], how="inner"
        ).select(*on, "gid", "seq", "source_tag")

    def pair_counts(self) -> DataFrame:
        """Per geometry pair: the number of feature pairs it stands for."""
        counts = self.shapes.select(*self.on, "gid", "n")
        per = (
            self.pairs.join(counts.select(*self.on, F.col("gid").alias("gid_a"), F.col("n").alias("n_a")), [*self.on, "gid_a"])
            .join(counts.select(*self.on, F.col("gid").alias("gid_b"), F.col("n").alias("n_b")), [*self.on, "gid_b"])
        )
        per_feature = self.members.groupBy(*self.on, "gid", "seq").agg(F.count("*").alias("m"))
        # Several polygons of one feature are not compared with each other.
        repeated = per_feature.join(
            self.members.groupBy(*self.on, "seq").agg(F.count("*").alias("_k")).where("_k > 1").drop("_k"), [*self.on, "seq"]
        )
        same = (
            self.pairs.join(
                repeated.select(*self.on, F.col("gid").alias("gid_a"), F.col("seq").alias("_f"), F.col("m").alias("m_a")),
                [*self.on, "gid_a"],
            )
            .join(
                repeated.select(*self.on, F.col("gid").alias("gid_b"), F.col("seq").alias("_f"), F.col("m").alias("m_b")),
                [*self.on, "gid_b", "_f"],
            )
            .groupBy(*self.on, "gid_a", "gid_b")
            .agg(
                F.sum(
                    F.when(F.col("gid_a") == F.col("gid_b"), F.floor(F.col("m_a") * (F.col("m_a") - 1) / 2)).otherwise(
                        F.col("m_a") * F.col("m_b")
                    )
                ).alias("_same")
            )
        )
        every = F.when(F.col("gid_a") == F.col("gid_b"), F.floor(F.col("n_a") * (F.col("n_a") - 1) / 2)).otherwise(
            F.col("n_a") * F.col("n_b")
        )
        return per.join(same, [*self.on, "gid_a", "gid_b"], "left").select(
            *self.on,
            "gid_a",
            "gid_b",
            "area",
            (every - F.coalesce("_same", F.lit(0))).cast("bigint").alias("pair_count"),
        ).where("pair_count > 0")

    def summary(self) -> DataFrame:
        """Counts, holes, invalid geometries, overlap pairs, largest overlap and status per group."""
        base = self.features.groupBy(*self.on).agg(
            F.count("*").alias("feature_count"),
            F.sum(F.size("parts")).cast("bigint").alias("polygon_count"),
            F.sum(F.aggregate("parts", F.lit(0), lambda acc, p: acc + F.size(p) - 1)).cast("bigint").alias(
                "inner_ring_count"
            ),
            F.count_if((F.size("parts") == 0) | (M.parts_area(F.col("parts")) <= 0.0)).alias(
                "invalid_or_empty_geometry_count"
            ),
        )
        found = self.pair_counts().groupBy(*self.on).agg(
            F.sum("pair_count").alias("overlap_pair_count"), F.round(F.max("area"), 3).alias("largest_overlap_area_m2")
        )
        joined = base.join(found, self.on, "left") if self.on else base.crossJoin(F.broadcast(found))
        return joined.withColumns(
            {
                "overlap_pair_count": F.coalesce("overlap_pair_count", F.lit(0)).cast("bigint"),
                "largest_overlap_area_m2": F.coalesce("largest_overlap_area_m2", F.lit(0.0)),
            }
        ).withColumn(
            "overlap_status", F.when(F.col("overlap_pair_count") > 0, F.lit("warning")).otherwise(F.lit("passed"))
        )

    def top(self, limit: int = 100) -> DataFrame:
        """The ``limit`` largest overlaps over all groups, ties by feature indices."""
        keys = self.on
        rank = Window.partitionBy(*keys, "gid").orderBy("seq")
        # One row per geometry and feature with its number of polygons. Pairs go by feature indices, so no pair
        # with a later feature can be among the first `limit` of its geometry pair.
        per_feature = self.members.groupBy(*keys, "gid", "seq").agg(F.min("source_tag").alias("source_tag"), F.count("*").alias("m"))
        few = per_feature.withColumn("_n", F.row_number().over(rank)).where(F.col("_n") <= limit + 1).drop("_n")
        areas = self.shapes.select(*keys, "gid", "shape_area")
        lead = self.shapes.select(*keys, "gid", "gid_seq")
        best = (
            self.pairs.join(lead.select(*keys, F.col("gid").alias("gid_a"), F.col("gid_seq").alias("_la")), [*keys, "gid_a"])
            .join(lead.select(*keys, F.col("gid").alias("gid_b"), F.col("gid_seq").alias("_lb")), [*keys, "gid_b"])
            .join(self.pair_counts().select(*keys, "gid_a", "gid_b"), [*keys, "gid_a", "gid_b"], "left_semi")
            .withColumn("_shown", F.round("area", 3))
        )
        # Rank geometry pairs by area and by the earliest feature that can appear in them, keeping ties.
        first = F.least("_la", "_lb")
        cutoff = best.orderBy(F.col("_shown").desc(), first).limit(limit)
        worst = cutoff.agg(F.min("_shown").alias("_min_area"))
        chosen = best.crossJoin(F.broadcast(worst)).where(F.col("_shown") >= F.col("_min_area"))
        side = lambda s: few.select(
            *keys, F.col("gid").alias(f"gid_{s}"), F.col("seq").alias(f"_f{s}"), F.col("source_tag").alias(f"_t{s}"), F.col("m").alias(f"_m{s}")
        )
        measured = lambda s: areas.select(
            *keys, F.col("gid").alias(f"gid_{s}"), F.col("shape_area").alias(f"_ar{s}")
        )
        spelled = (
            chosen.join(side("a"), [*keys, "gid_a"])
            .join(side("b"), [*keys, "gid_b"])
            .where((F.col("_fa") != F.col("_fb")) & ((F.col("gid_a") != F.col("gid_b")) | (F.col("_fa") < F.col("_fb"))))
            .join(measured("a"), [*keys, "gid_a"])
            .join(measured("b"), [*keys, "gid_b"])
            # Polygons of the same two features give equal rows; more than `limit` of them cannot be shown.
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least(F.col("_ma") * F.col("_mb"), F.lit(limit)).cast("int"))))
        )
        forward = F.col("_fa") < F.col("_fb")
        smaller = F.greatest(F.least("_ara", "_arb"), F.lit(1e-9))
        return (
            spelled.select(
                *keys,
                F.least("_fa", "_fb").alias("first_feature_index"),
                F.greatest("_fa", "_fb").alias("second_feature_index"),
                F.when(forward, F.col("_ta")).otherwise(F.col("_tb")).alias("first_source_tag"),
                F.when(forward, F.col("_tb")).otherwise(F.col("_ta")).alias("second_source_tag"),
                F.col("_shown").alias("intersection_area_m2"),
                F.round(F.col("area") / smaller, 4).alias("overlap_ratio_of_smaller"),
            )
            .orderBy(F.col("intersection_area_m2").desc(), "first_feature_index", "second_feature_index", *keys)
            .limit(limit)
        )


# --- clip to a circle ---------------------------------------------------------------------


def clip_to_circle(
    features: DataFrame,
    *,
    radius: float,
    segments: int = ROI_SEGMENTS,
    center: tuple[float, float] = (0.0, 0.0),
    on: Sequence[str] = (),
    min_area: float = MIN_SURFACE_M2,
    tile: float = TILE_M,
    hot_edges: int = HOT_EDGES,
) -> DataFrame:
    """Features (``seq, parts``) cut to the circle polygon, with ``area_m2`` and ``clipped``; empty ones dropped.

    Only polygons that straddle the circle are swept: inside ones keep their
    polygons, outside ones are dropped by their distance.
    """
    cx, cy = center
    vertices = F.flatten(F.flatten("parts"))
    reach = F.array_max(F.transform(vertices, lambda v: F.hypot(v["x"] - cx, v["y"] - cy)))
    box = M.parts_bbox(F.col("parts"))
    gap = F.hypot(
        F.greatest(box["min_x"] - cx, F.lit(cx) - box["max_x"], F.lit(0.0)),
        F.greatest(box["min_y"] - cy, F.lit(cy) - box["max_y"], F.lit(0.0)),
    )
    sized = features.withColumns({"_reach": reach, "_gap": gap})
    inner_radius = radius * float(np.cos(np.pi / segments))
    inside = F.col("_reach") <= inner_radius
    straddling = (~inside) & (F.col("_gap") <= radius)
    whole = sized.where(inside).drop("_reach", "_gap").withColumns(
        {"area_m2": M.parts_area(F.col("parts")), "clipped": F.lit(False)}
    )
    cut_source = sized.where(straddling).drop("_reach", "_gap")
    pieces = clipped_pieces(
        cut_source, radius=radius, segments=segments, center=center, on=on, tile=tile, hot_edges=hot_edges
    )
    shapes = outlines(pieces, [*on, "seq"]).withColumnRenamed("parts", "_cut")
    cut = cut_source.join(shapes, [*on, "seq"]).withColumns(
        {"parts": F.col("_cut"), "area_m2": M.parts_area(F.col("_cut")), "clipped": F.lit(True)}
    )
    return whole.unionByName(cut.drop("_cut")).where(F.col("area_m2") > min_area)


def clipped_pieces(
    features: DataFrame,
    *,
    radius: float,
    segments: int = ROI_SEGMENTS,
    center: tuple[float, float] = (0.0, 0.0),
    on: Sequence[str] = (),
    tile: float = TILE_M,
    hot_edges: int = HOT_EDGES,
) -> DataFrame:
    """Trapezoids of every feature's intersection with the circle polygon."""
    routed = route_to_tiles(edge_rows(features.select(*on, "seq", "parts")), on=on, tile=tile, hot_edges=hot_edges)
    circle = S.circle_edges(radius, segments, *center)
    key_types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in features.select(*on).schema)
    schema = ", ".join(
        t for t in (key_types, "seq bigint, y_lo double, y_hi double, xl_lo double, xl_hi double, xr_lo double, xr_hi double") if t
    )
    keys = list(on)

    def clip(rows: pa.Table, first: np.ndarray) -> pa.RecordBatch:
        tile_of = np.repeat(np.arange(len(first)), np.diff(np.append(first, rows.num_rows)))
        boxes = np.column_stack([x[first] for x in _numbers(rows, ("tx0", "ty0", "tx1", "ty1"))])
        e = np.column_stack(_numbers(rows, ("ax", "ay", "bx", "by")))
        own, seqs, group = S._dense(tile_of, _seqs(rows))
        low, high = np.full(len(own), np.inf), np.full(len(own), -np.inf)
        np.minimum.at(low, group, np.minimum(e[:, 1], e[:, 3]))
        np.maximum.at(high, group, np.maximum(e[:, 1], e[:, 3]))
        round_ = [S.clamp_to_tile(circle, *box) for box in boxes.tolist()]
        many = np.array([len(x) for x in round_], np.int64)
        arcs = np.concatenate(round_)
        # Of the circle a feature meets only what lies on its scan lines.
        at, step = S._spread(many[own])
        arc = arcs[(np.cumsum(many) - many)[own[at]] + step]
        near = (np.maximum(arc[:, 1], arc[:, 3]) > low[at]) & (np.minimum(arc[:, 1], arc[:, 3]) < high[at])
        at, arc = at[near], arc[near]
        sides = np.array([S.tile_edges(*box) for box in boxes.tolist()])[own].reshape(-1, 4)
        all_ = np.concatenate([e, arc, sides])
        poly = np.repeat([0, 1, 2], [len(e), len(arc), len(sides)])
        s = S.sweep(np.concatenate([group, at, np.repeat(np.arange(len(own)), 2)]), poly, *all_.T)
        live = np.flatnonzero(_covered_by(s, 0) & _covered_by(s, 1) & _covered_by(s, 2))
        label, *shape = S.merge_runs(s, live, s.group[live])
        lead = pa.array(first[own[label]])
        cols = [*(rows.column(k).combine_chunks().take(lead) for k in keys), pa.array(seqs[label]), *map(pa.array, shape)]
        return pa.RecordBatch.from_arrays(cols, names=[*keys, "seq", "y_lo", "y_hi", "xl_lo", "xl_hi", "xr_lo", "xr_hi"])

    return _over_tiles(routed, on, clip, schema)


def surface_layers(
    features: DataFrame,
    *,
    region: Region,
    center: tuple[float, float],
    excluded: Sequence[str] = ("buildings", "trees"),
    on: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Layers of the city model: (features clipped to the domain, one row per category).

    ``features`` are metric (``seq, category, parts``). A category whose
    features all vanish is reported with ``feature_count = 0`` and an error text.
    """
    kept = features.where(~F.col("category").isin(*excluded))
    clipped = clip_to_circle(
        kept, radius=region.outer_radius_m, segments=LAYER_SEGMENTS, center=center, on=on, min_area=0.0
    ).withColumn("clipped_to_outer_region", F.lit(True))
    counts = clipped.groupBy("category").agg(F.count("*").alias("feature_count"))
    layers = (
        kept.groupBy("category")
        .agg(F.count("*").alias("source_count"))
        .join(counts, "category", "left")
        .select(
            "category",
            "source_count",
            F.coalesce("feature_count", F.lit(0)).cast("bigint").alias("feature_count"),
            F.when(F.col("feature_count").isNull(), F.lit("layer does not overlap the region")).alias("error"),
        )
    )
    return clipped, layers


# --- gap fill ---------------------------------------------------------------------------


def gap_pieces(
    features: DataFrame,
    regions: DataFrame,
    *,
    region: Region,
    on: Sequence[str] = (),
    tile: float = TILE_M,
    hot_edges: int = HOT_EDGES,
) -> DataFrame:
    """Uncovered trapezoids of the region circle, split by zone, with connected piece labels per tile.

    ``features``: ``on, seq, parts`` in the local plane; ``regions``: one row
    per group of ``on`` to fill. Rows of kind ``piece`` are trapezoids, rows of
    kind ``border`` are the contact intervals on tile sides.
    """
    outer, inner = region.outer_radius_m, region.inner_radius_m
    lead = features.groupBy(*on, "parts").agg(F.min("seq").alias("seq"))
    edges = edge_rows(lead.select(*on, "seq", "parts"))
    lo, hi = int(np.floor(-outer / tile)), int(np.floor(outer / tile))
    # Marker edges make every tile of the circle present, also those without polygons.
    span = F.sequence(F.lit(lo), F.lit(hi))
    side = lambda c: F.col(c) * F.lit(float(tile))
    marker = (
        regions.select(*on)
        .withColumn("_mx", F.explode(span))
        .withColumn("_my", F.explode(span))
        .select(
            *on,
            F.lit(-1).cast("bigint").alias("seq"),
            (side("_mx") + tile / 2).alias("ax"),
            (side("_my") + tile / 4).alias("ay"),
            (side("_mx") + tile / 2).alias("bx"),
            (side("_my") + 3 * tile / 4).alias("by"),
            (side("_mx") + tile / 1024).alias("ex0"),
            (side("_my") + tile / 1024).alias("ey0"),
            (side("_mx") + tile - tile / 1024).alias("ex1"),
            (side("_my") + tile - tile / 1024).alias("ey1"),
        )
    )
    near = edges.where((F.col("ey1") > -outer) & (F.col("ey0") < outer) & (F.col("ex1") > -outer) & (F.col("ex0") < outer))
    routed = route_to_tiles(near.unionByName(marker), on=on, tile=tile, hot_edges=hot_edges)
    circle = S.circle_edges(outer, ROI_SEGMENTS)
    core = None if inner is None else S.circle_edges(inner, ROI_SEGMENTS)
    key_types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in regions.select(*on).schema)
    numbers = ("at", "lo", "hi", "y_lo", "y_hi", "xl_lo", "xl_hi", "xr_lo", "xr_hi")
    codes = ("depth", "fx", "fy", "piece", "kind", "zone", "side")
    schema = ", ".join(t for t in (key_types, *[f"{c} bigint" for c in codes], *[f"{c} double" for c in numbers]) if t)
    keys = list(on)

    def fill(rows: pa.Table, first: np.ndarray) -> pa.RecordBatch:
        tile_of = np.repeat(np.arange(len(first)), np.diff(np.append(first, rows.num_rows)))
        boxes = np.column_stack([x[first] for x in _numbers(rows, ("tx0", "ty0", "tx1", "ty1"))])
        seq = _seqs(rows)
        real = seq >= 0
        _, seqs, poly = S._dense(tile_of[real], seq[real])
        stacked, of_tile, of_poly = [np.column_stack(_numbers(rows, ("ax", "ay", "bx", "by")))[real]], [tile_of[real]], [poly]
        for number, cut in ((-1, S.tile_edges), (-2, partial(S.clamp_to_tile, circle)), *([] if core is None else [(-3, partial(S.clamp_to_tile, core))])):
            extra = [cut(*box) for box in boxes.tolist()]
            stacked += extra
            of_tile.append(np.repeat(np.arange(len(first)), [len(x) for x in extra]))
            of_poly.append(np.full(len(of_tile[-1]), number))
        s = S.sweep(np.concatenate(of_tile), np.concatenate(of_poly), *np.concatenate(stacked).T)
        free = _covered_by(s, -1) & _covered_by(s, -2) & (_first_cover(s, len(seqs)) == len(seqs)) & (s.area > 0)
        zone = np.zeros(len(s.slab), np.int64) if core is None else np.where(_covered_by(s, -3), 1, 2)
        # Pieces are numbered anew in each tile.
        piece = S.label_components(s, free, zone) - np.searchsorted(s.group, s.group)
        at_ = np.flatnonzero(free)
        whole, *shape = S.merge_runs(s, at_, (piece + np.searchsorted(s.group, s.group))[at_])
        none = np.zeros((len(whole), 3))
        table = [np.column_stack([s.group[whole], piece[whole], np.zeros(len(whole)), zone[whole], np.full(len(whole), -1), none, *shape])]
        box = boxes[s.group].T
        sides = (
            (0, box[0], (s.xl_lo <= box[0]) & (s.xl_hi <= box[0]), s.y_lo, s.y_hi),
            (1, box[2], (s.xr_lo >= box[2]) & (s.xr_hi >= box[2]), s.y_lo, s.y_hi),
            (2, box[1], s.y_lo <= box[1], s.xl_lo, s.xr_lo),
            (3, box[3], s.y_hi >= box[3], s.xl_hi, s.xr_hi),
        )
        for code, at, touches, lo_, hi_ in sides:
            i = np.flatnonzero(free & touches & (hi_ > lo_))
            fixed = [s.group[i], piece[i], np.ones(len(i)), zone[i], np.full(len(i), code), at[i], lo_[i], hi_[i]]
            table.append(np.column_stack([*fixed, np.zeros((len(i), 6))]))
        out = np.vstack(table)
        lead = first[out[:, 0].astype(np.int64)]
        cols = [rows.column(k).combine_chunks().take(pa.array(lead)) for k in keys]
        cols += [pa.array(rows.column(k).to_numpy()[lead].astype(np.int64)) for k in TILE_KEYS]
        cols += [pa.array(out[:, k].astype(np.int64)) for k in range(1, 5)] + [pa.array(np.ascontiguousarray(out[:, k])) for k in range(5, 14)]
        return pa.RecordBatch.from_arrays(cols, names=[*keys, *codes, *numbers])

    filled = _over_tiles(routed, on, fill, schema)
    names = lambda c, values: F.get(F.array(*[F.lit(v) for v in values]), F.col(c).cast("int"))
    return filled.select(
        *on,
        F.concat_ws("_", "depth", "fx", "fy", "piece").alias("node"),
        names("kind", ("piece", "border")).alias("kind"),
        names("zone", ("full", "inner", "annular")).alias("zone"),
        names("side", ("left", "right", "bottom", "top")).alias("side"),
        *numbers,
    )


def gap_fill(
    features: DataFrame,
    regions: DataFrame,
    *,
    region: Region,
    on: Sequence[str] = (),
    tile: float = TILE_M,
    hot_edges: int = HOT_EDGES,
    min_area: float = MIN_SURFACE_M2,
    geometry: bool = False,
) -> DataFrame:
    """One row per connected uncovered piece of the region circle above ``min_area``.

    Columns: ``on``, ``zone``, ``component``, ``area_m2``, ``cx``, ``cy``,
    ``centroid_distance_m``, ``gap_no`` (inner pieces first) and, with
    ``geometry``, its polygon in ``parts``.
    """
    cells = cut_lineage(gap_pieces(features, regions, region=region, on=on, tile=tile, hot_edges=hot_edges))
    keys = list(on)
    scope = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.col("node")) if keys else F.col("node")
    border = cells.where("kind = 'border' and hi > lo").select(*keys, "zone", "side", "at", "lo", "hi", scope.alias("id"))
    contacts = None
    for low, high in (("right", "left"), ("top", "bottom")):
        a = border.where(F.col("side") == low).select(
            *keys, "zone", F.col("at").alias("at"), F.col("id").alias("u"), F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"),
            F.col("at").alias("a_at"),
        )
        b = border.where(F.col("side") == high).select(
            *keys, "zone", F.col("at").alias("at"), F.col("id").alias("v"), F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"),
            F.col("at").alias("b_at"),
        )
        touching = F.least("a_hi", "b_hi") - F.greatest("a_lo", "b_lo") > 1e-9
        found = box_join(
            a, b, left_box=("a_lo", "a_at", "a_hi", "a_at"), right_box=("b_lo", "b_at", "b_hi", "b_at"),
            cell=tile, on=[*keys, "zone", "at"], residual=touching, left_id=("u",), right_id=("v",),
        ).select("u", "v")
        contacts = found if contacts is None else contacts.unionByName(found)
    groups = connected_components(contacts)
    w_lo, w_hi = F.col("xr_lo") - F.col("xl_lo"), F.col("xr_hi") - F.col("xl_hi")
    h = F.col("y_hi") - F.col("y_lo")
    area = (w_lo + w_hi) / 2.0 * h
    # First moments of a trapezoid between two straight sides.
    my = h * (F.col("y_lo") * (w_lo + w_hi) / 2.0 + h * (w_lo + 2.0 * w_hi) / 6.0)
    sq = lambda a, b: F.col(a) * F.col(a) + F.col(a) * F.col(b) + F.col(b) * F.col(b)
    mx = h * (sq("xr_lo", "xr_hi") - sq("xl_lo", "xl_hi")) / 6.0
    pieces = cells.where("kind = 'piece'").withColumn("node_id", scope)
    labelled = pieces.join(groups, pieces["node_id"] == groups["node"], "left").withColumn(
        "component", F.coalesce("component", "node_id")
    )
    shapes = (
        labelled.groupBy(*keys, "zone", "component")
        .agg(
            F.sum(area).alias("area_m2"), F.sum(mx).alias("_mx"), F.sum(my).alias("_my"),
            F.min("y_lo").alias("_y"), F.min(F.least("xl_lo", "xl_hi")).alias("_x"),
        )
        .where(F.col("area_m2") > min_area)
        .withColumns({"cx": F.col("_mx") / F.col("area_m2"), "cy": F.col("_my") / F.col("area_m2")})
        .withColumn("centroid_distance_m", F.hypot("cx", "cy"))
        .withColumns({"_zone": F.when(F.col("zone") == "annular", 1).otherwise(0), "_row": F.floor(F.col("_y") / tile)})
    )
    numbered = blocked_ordinal(shapes, block=["_zone", "_row"], within=["_y", "_x", "component"], out="gap_no", by=keys)
    gaps = numbered.select(*keys, "gap_no", "zone", "component", "area_m2", "cx", "cy", "centroid_distance_m")
    if not geometry:
        return gaps
    names = [*keys, "zone", "component"]
    kept = labelled.join(gaps.select(*names), names, "left_semi")
    return gaps.join(outlines(kept, names), names)


def gap_features(gaps: DataFrame) -> DataFrame:
    """Rows of :func:`gap_fill` with geometry as generated features (``parts`` in the plane of the gaps)."""
    distance = F.round("centroid_distance_m", 3)
    return gaps.select(
        F.col("gap_no").alias("seq"),
        F.lit("generated").alias("osm_type"),
        F.concat(F.lit("gap_fill_"), F.col("gap_no").cast("string")).alias("osm_id"),
        F.lit("gap_fill").alias("category"),
        F.lit("gap_fill").alias("group_tag"),
        F.lit("generated=roi_difference").alias("source_tag"),
        F.lit("generated").alias("source_type"),
        F.when(F.size("parts") > 1, F.lit("MultiPolygon")).otherwise(F.lit("Polygon")).alias("geom_type"),
        "parts",
        F.lit(True).alias("contributes_to_geometry"),
        F.lit("generated_gap_fill_contributing_polygon").alias("geometry_role"),
        F.col("zone").alias("roi_zone"),
        M.reconstruction_scope(F.col("zone")).alias("reconstruction_scope"),
        F.lit(False).alias("include_in_lod22"),
        distance.alias("centroid_distance_m"),
        distance.alias("roi_distance_m"),
        F.round("area_m2", 3).alias("area_m2"),
        F.create_map().cast("map<string,string>").alias("tags"),
    )


def trapezoid_polygon() -> Column:
    """A trapezoid row as one polygon (a list with one closed ring)."""
    v = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(v("xl_lo", "y_lo"), v("xr_lo", "y_lo"), v("xr_hi", "y_hi"), v("xl_hi", "y_hi"), v("xl_lo", "y_lo"))
    return F.array(ring)
