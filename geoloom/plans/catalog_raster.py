"""Driver queries: rasters, point-polygon joins, classification, statistics, alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import attributes as A
from geoloom.functions import crs as C
from geoloom.operators import raster as R
from geoloom.operators import spatial as S
from geoloom.params import DEMO_REGION
from geoloom.plans.catalog_features import rect_parts
from geoloom.plans.fixtures import ctes, view
from geoloom.plans.registry import query

BBOX = (-70.0, -45.0, 70.0, 45.0)
KEYS = ("region", "tile", "row", "col")
BBOX_SQL = "x between -70 and 70 and y between -45 and 45"
VALID_SQL = f"ground_z is not null and surface_z is not null and {BBOX_SQL}"
CELL_KEY = 'region, tile, "row", "col"'


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "fx_cells")


def rect_polygons(spark: SparkSession, sf_dir: str, categories: tuple[str, ...] | None = None) -> DataFrame:
    df = rect_parts(spark, sf_dir).select("region", "seq", "category", "parts")
    if categories is not None:
        df = df.where(F.col("category").isin(*categories))
    return S.polygon_rows(df)


def tag_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree tags in the local plane of their region."""
    x, y = C.to_local(F.col("lon"), F.col("lat"), DEMO_REGION)
    return view(spark, sf_dir, "fx_points").where("key1 = 'natural' and val1 = 'tree'").select(
        "region", F.col("osm_num").alias("tag_seq"), x.alias("tag_x"), y.alias("tag_y")
    )


X_SQL = "radians(lon - 11.2558) * 6371000.0 * cos(radians(43.7696))"
Y_SQL = "radians(lat - 43.7696) * 6371000.0"
TAGS_CTE = ("tags", f"select region, osm_num, {X_SQL} as tx, {Y_SQL} as ty from fx_points where key1 = 'natural' and val1 = 'tree'")
VALID_CTE = ("valid", f"select *, surface_z - ground_z as height from fx_cells where {VALID_SQL}")
INSIDE_CTE = (
    "inside",
    f"select distinct c.region, c.tile, c.\"row\", c.\"col\" from valid c join fx_rects p on p.region = c.region"
    " and c.x between p.x0 and p.x1 and c.y between p.y0 and p.y1",
)


@query("cell_pairs_valid", ctes("fx_cells") + f"select {CELL_KEY}, x, y, round(ground_z, 3) as ground_z, round(surface_z, 3) as surface_z from fx_cells where {VALID_SQL}")
def cell_pairs_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground and surface layers joined cell by cell, nodata and outside cells removed."""
    df = cells(spark, sf_dir)
    ground = df.select(*KEYS, "x", "y", F.col("ground_z").alias("z"))
    surface = df.select(*KEYS, F.col("surface_z").alias("z"))
    paired = R.valid_cells(R.pair_cells(ground, surface, on=["region"]), BBOX)
    return paired.select(*KEYS, "x", "y", F.round("ground_z", 3).alias("ground_z"), F.round("surface_z", 3).alias("surface_z"))


def tile_catalogue(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two layers of tiles: the surface layer lacks some tiles, and one grid differs."""
    df = cells(spark, sf_dir)
    tiles = df.groupBy("region", "tile").agg(
        (F.min("x") - 0.5).alias("xll"),
        (F.min("y") - 0.5).alias("yll"),
        (F.max("col") + 1).cast("int").alias("ncols"),
        (F.max("row") + 1).cast("int").alias("nrows"),
    )
    named = tiles.select(
        F.concat(F.col("region").cast("string"), F.lit("_"), F.col("tile").cast("string"), F.lit(".asc")).alias("tile"),
        "region", F.col("tile").alias("tile_no"), "ncols", "nrows", F.lit(1.0).alias("cellsize"), "xll", "yll",
    )
    dtm = named.where("tile_no <> 5")
    dsm = named.where("tile_no <> 0").withColumn("xll", F.col("xll") + F.when(F.col("tile_no") == 3, 0.5).otherwise(0.0))
    return dtm, dsm


TILE_BBOX = (-20.0, -40.0, 20.0, 40.0)
TILE_SQL = ctes(
    "fx_cells",
    extra=[
        ("t", "select region, tile, min(x) - 0.5 as xll, min(y) - 0.5 as yll, max(\"col\") + 1 as ncols, max(\"row\") + 1 as nrows from fx_cells group by 1, 2"),
        ("s", "select *, not (xll + ncols < -20 or xll > 20 or yll + nrows < -40 or yll > 40) as touches from t"),
        (
            "pr",
            "select concat(cast(region as string), '_', cast(tile as string), '.asc') as tile, case when tile = 5 then 'only_dsm' when tile = 0 then 'only_dtm'"
            " when touches then 'used' else 'skipped' end as status, case when tile = 3 then 'grid_mismatch' when tile = 5 and touches then 'unmatched_dsm'"
            " when tile = 0 and touches then 'unmatched_dtm' end as violation, xll, yll from s",
        ),
    ],
)


@query("tile_pairing", TILE_SQL + "select tile, status, violation, xll, yll from pr")
def tile_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.pair_tiles(*tile_catalogue(spark, sf_dir), TILE_BBOX).select("tile", "status", "violation", "xll", "yll")


@query(
    "raster_summary",
    TILE_SQL
    + "select count(case when status in ('used', 'skipped') then 1 end) as paired_tile_count, count(case when status = 'used' then 1 end) as used_tile_count,"
    " count(case when status = 'skipped' then 1 end) as skipped_tile_count, count(violation) as violation_count from pr",
)
def raster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.raster_summary(R.pair_tiles(*tile_catalogue(spark, sf_dir), TILE_BBOX))


@query(
    "tile_pruning",
    TILE_SQL
    + "select c.region, c.tile, count(*) as n, round(sum(c.surface_z), 3) as total from fx_cells c join pr on pr.tile = concat(cast(c.region as string), '_', cast(c.tile as string), '.asc')"
    " where pr.status = 'used' group by 1, 2",
)
def tile_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only cells of paired tiles that touch the region are joined."""
    pairs = R.pair_tiles(*tile_catalogue(spark, sf_dir), TILE_BBOX).where("status = 'used'")
    used = pairs.select(
        F.split_part("tile", F.lit("_"), F.lit(1)).cast("bigint").alias("region"),
        F.regexp_extract("tile", r"_([0-9]+)\.", 1).cast("bigint").alias("tile"),
    )
    df = cells(spark, sf_dir)
    ground = df.select(*KEYS, "x", "y", F.col("ground_z").alias("z"))
    paired = R.pair_cells(ground, df.select(*KEYS, F.col("surface_z").alias("z")), used, on=["region"])
    return paired.groupBy("region", "tile").agg(F.count("*").alias("n"), F.round(F.sum("surface_z"), 3).alias("total"))


@query(
    "tile_names_difference",
    TILE_SQL + "select case status when 'only_dtm' then 'only_dtm' when 'only_dsm' then 'only_dsm' else 'both' end as side, count(*) as n from pr group by 1",
)
def tile_names_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intersection and both differences of the two layers' tile names."""
    dtm, dsm = (d.select("tile") for d in tile_catalogue(spark, sf_dir))
    sides = (
        dtm.intersect(dsm).withColumn("side", F.lit("both"))
        .unionByName(dtm.exceptAll(dsm).withColumn("side", F.lit("only_dtm")))
        .unionByName(dsm.exceptAll(dtm).withColumn("side", F.lit("only_dsm")))
    )
    return sides.groupBy("side").agg(F.count("*").alias("n"))


@query("points_in_polygons", ctes("fx_cells", "fx_rects", extra=[VALID_CTE, INSIDE_CTE]) + f"select {CELL_KEY} from inside")
def points_in_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = R.valid_cells(cells(spark, sf_dir), BBOX)
    return S.points_in_polygons(valid, rect_polygons(spark, sf_dir), on=["region"], point_id=KEYS).select(*KEYS)


BUFFER_SQL = (
    "select distinct c.region, c.tile, c.\"row\", c.\"col\" from valid c join fx_rects p on p.region = c.region"
    " and c.x between p.x0 - 1.5 and p.x1 + 1.5 and c.y between p.y0 - 1.5 and p.y1 + 1.5"
    " where case when c.x between p.x0 and p.x1 and c.y between p.y0 and p.y1"
    " then least(c.x - p.x0, p.x1 - c.x, c.y - p.y0, p.y1 - c.y)"
    " else sqrt(power(greatest(p.x0 - c.x, c.x - p.x1, 0), 2) + power(greatest(p.y0 - c.y, c.y - p.y1, 0), 2)) end <= 1.5"
)


@query("points_within_buffer", ctes("fx_cells", "fx_rects", extra=[VALID_CTE, ("near", BUFFER_SQL)]) + f"select {CELL_KEY} from near")
def points_within_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells within 1.5 m of a footprint edge, inside or outside."""
    valid = R.valid_cells(cells(spark, sf_dir), BBOX)
    return S.points_near_polygons(valid, rect_polygons(spark, sf_dir), on=["region"], point_id=KEYS).select(*KEYS)


TAGGED_SQL = (
    "select distinct c.region, c.tile, c.\"row\", c.\"col\" from valid c join tags t on t.region = c.region"
    " and t.tx between c.x - 8 and c.x + 8 and t.ty between c.y - 8 and c.y + 8 where power(t.tx - c.x, 2) + power(t.ty - c.y, 2) <= 64"
)


@query("tree_tag_evidence", ctes("fx_cells", "fx_points", extra=[VALID_CTE, TAGS_CTE, ("tagged", TAGGED_SQL)]) + f"select {CELL_KEY} from tagged")
def tree_tag_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = R.valid_cells(cells(spark, sf_dir), BBOX)
    return S.near_tag_points(valid, tag_points(spark, sf_dir), on=["region"], point_id=KEYS).select(*KEYS)


RELIEF_SQL = (
    "select *, greatest(0, surface_z - min(m1) over (partition by region, tile, \"col\" order by \"row\" range between 4 preceding and 4 following)) as relief from ("
    "select *, min(surface_z) over (partition by region, tile, \"row\" order by \"col\" range between 4 preceding and 4 following) as m1 from fx_cells)"
)


@query("local_relief", ctes("fx_cells", extra=[("rel", RELIEF_SQL)]) + f"select {CELL_KEY}, round(relief, 3) as relief from rel where surface_z is not null")
def local_relief(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = R.local_relief(cells(spark, sf_dir), radius_cells=R.relief_radius_cells(1.0), by=["region", "tile"])
    return df.where("surface_z is not null").select(*KEYS, F.round("relief", 3).alias("relief"))


# The overlay image is derived from customers: one pixel per customer and region.
PIXELS_SQL = (
    "select cast(floor(c_custkey / 1500) as bigint) as region, cast(floor((c_custkey % 1500) / 50) as bigint) as pr, c_custkey % 50 as pc,"
    " c_custkey * 37 % 256 as r, c_custkey * 91 % 256 as g, c_custkey * 53 % 256 as b, case when c_custkey % 20 = 0 then 200 else 3 end as a from customer"
)
WIDTH, HEIGHT = 50, 30


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/customer.parquet")
    k = F.col("c_custkey")
    return df.select(
        F.floor(k / 1500).cast("bigint").alias("region"),
        F.floor((k % 1500) / 50).cast("int").alias("row"),
        (k % 50).cast("int").alias("col"),
        *[((k * f) % 256).cast("int").alias(c) for c, f in (("r", 37), ("g", 91), ("b", 53))],
        F.when(k % 20 == 0, 200).otherwise(3).alias("a"),
    )


CANOPY_SQL = (
    "select distinct c.region, c.tile, c.\"row\", c.\"col\" from (select *, cast(least(49, greatest(0, floor((x + 70) / 140 * 50))) as bigint) as pc,"
    " cast(least(29, greatest(0, floor((45 - y) / 90 * 30))) as bigint) as pr from valid) c"
    " join px on px.region = c.region and px.a >= 16 and px.g >= 60 and 2 * px.g - px.r - px.b >= 8 and abs(px.pr - c.pr) <= 1 and abs(px.pc - c.pc) <= 1"
)


@query("canopy_evidence", ctes("fx_cells", extra=[VALID_CTE, ("px", PIXELS_SQL), ("veg", CANOPY_SQL)]) + f"select {CELL_KEY} from veg")
def canopy_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = R.valid_cells(cells(spark, sf_dir), BBOX)
    out = R.canopy_evidence(valid, pixels(spark, sf_dir), bbox=BBOX, width=WIDTH, height=HEIGHT, on=["region"])
    return out.select(*KEYS)


FOOTPRINTS = ("buildings", "roads", "concrete", "green_areas", "water")


@query(
    "height_classes",
    ctes("fx_cells", "fx_rects", extra=[VALID_CTE, INSIDE_CTE])
    + "select v.region, v.tile, case when v.height >= 2 and i.region is not null then 'building' else 'unclassified' end as class, count(*) as n,"
    " round(sum(v.surface_z), 3) as total_z from valid v left join inside i on i.region = v.region and i.tile = v.tile and i.\"row\" = v.\"row\" and i.\"col\" = v.\"col\" group by 1, 2, 3",
)
def height_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification without a canopy overlay: building or unclassified, never tree."""
    out = R.classify_cells(cells(spark, sf_dir), rect_polygons(spark, sf_dir), bbox=BBOX, on=["region"], key=KEYS)
    return out.groupBy("region", "tile", "class").agg(F.count("*").alias("n"), F.round(F.sum("surface_z"), 3).alias("total_z"))


def full_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.classify_cells(
        cells(spark, sf_dir),
        rect_polygons(spark, sf_dir),
        bbox=BBOX,
        on=["region"],
        key=KEYS,
        relief_cells=R.relief_radius_cells(1.0),
        canopy={"pixels": pixels(spark, sf_dir), "bbox": BBOX, "width": WIDTH, "height": HEIGHT},
        tags=tag_points(spark, sf_dir),
    )


def _join(alias: str) -> str:
    return f"left join {alias} on {alias}.region = v.region and {alias}.tile = v.tile and {alias}.\"row\" = v.\"row\" and {alias}.\"col\" = v.\"col\" "


EVIDENCE_CTES = ctes(
    "fx_cells",
    "fx_rects",
    "fx_points",
    extra=[
        VALID_CTE,
        INSIDE_CTE,
        ("near", BUFFER_SQL),
        TAGS_CTE,
        ("tagged", TAGGED_SQL),
        ("px", PIXELS_SQL),
        ("veg", CANOPY_SQL),
        ("rel", RELIEF_SQL),
        (
            "ev",
            "select v.*, rel.relief, inside.region is not null as is_in, inside.region is not null or near.region is not null as zone, tagged.region is not null as tag,"
            " tagged.region is not null or veg.region is not null as evidence from valid v "
            + "".join(_join(a) for a in ("rel", "inside", "near", "tagged", "veg")),
        ),
        ("cand", "select * from ev where height >= 1.5 and evidence"),
    ],
)


@query(
    "tree_evidence_counts",
    EVIDENCE_CTES
    + "select region, count(*) as evidence_candidate_count, count(case when tag then 1 end) as tree_tag_supported_candidate_count,"
    " count(case when zone then 1 end) as building_footprint_candidate_count, count(case when zone and not is_in then 1 end) as building_footprint_buffer_candidate_count,"
    " count(case when not zone then 1 end) as local_relief_fallback_candidate_count, count(case when not zone and relief >= 3 then 1 end) as local_relief_pass_count"
    " from cand group by 1",
)
def tree_evidence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six tree-branch counters that do not depend on roof levels."""
    return R.tree_filter_counts(full_classification(spark, sf_dir), by=["region"]).drop(
        "building_footprint_without_roof_estimate_count", "roof_estimate_candidate_count", "roof_offset_pass_count"
    )


@query("tree_filter_counts")
def tree_filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine counters of the tree branch (roof levels come from clustering)."""
    return R.tree_filter_counts(full_classification(spark, sf_dir), by=["region"])


@query("cell_classes")
def cell_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete classification with the tree branch: counts per region and the completeness check."""
    return R.class_counts(full_classification(spark, sf_dir), by=["region"])


@query("roof_estimate")
def roof_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roof level near every elevated footprint cell."""
    valid = R.valid_cells(cells(spark, sf_dir), BBOX).withColumn("height", F.col("surface_z") - F.col("ground_z"))
    roofs = S.points_in_polygons(valid.where("height >= 2"), rect_polygons(spark, sf_dir), on=["region"], point_id=KEYS)
    out = R.estimate_roofs(roofs, roofs, key=KEYS, on=["region", "tile"])
    return out.select(*KEYS, F.round("surface_z", 3).alias("surface_z"), F.round("roof_z", 3).alias("roof_z"))


ROOF_NEIGHBOURS = (
    "select a.region, a.tile, a.\"row\", a.\"col\", count(b.x) as samples from roof a left join roof b on b.region = a.region and b.tile = a.tile"
    " and power(b.x - a.x, 2) + power(b.y - a.y, 2) <= 64 and (b.x <> a.x or b.y <> a.y) group by 1, 2, 3, 4"
)


@query(
    "roof_sample_counts",
    ctes(
        "fx_cells",
        "fx_rects",
        extra=[
            VALID_CTE,
            INSIDE_CTE,
            ("roof", f"select v.* from valid v join inside i using ({CELL_KEY}) where v.height >= 2"),
            ("nb", ROOF_NEIGHBOURS),
        ],
    )
    + f"select {CELL_KEY}, samples > 0 as has_roof from nb",
)
def roof_sample_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A roof level exists exactly where another roof cell lies within eight metres in the tile."""
    return roof_estimate(spark, sf_dir).select(*KEYS, F.col("roof_z").isNotNull().alias("has_roof"))


# --- statistics -----------------------------------------------------------------------------------


@query(
    "cell_stats",
    ctes("fx_cells", extra=[VALID_CTE])
    + "select region, cast(floor(x / 2) as bigint) as cell_x, cast(floor(y / 2) as bigint) as cell_y, round(min(ground_z), 3) as ground_z, round(max(surface_z), 3) as roof_z from valid group by 1, 2, 3",
)
def cell_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = R.valid_cells(cells(spark, sf_dir), BBOX)
    low = R.cell_statistics(valid, z="ground_z", how="min", on=["region"])
    high = R.cell_statistics(valid, z="surface_z", how="max", on=["region"]).withColumnRenamed("z", "roof_z")
    return low.join(high, ["region", "cell_x", "cell_y"]).select(
        "region", "cell_x", "cell_y", F.round("z", 3).alias("ground_z"), F.round("roof_z", 3).alias("roof_z")
    )


ZONAL_CTES = ctes(
    "fx_cells",
    "fx_rects",
    extra=[
        VALID_CTE,
        ("low", "select region, floor(x / 2) as cx, floor(y / 2) as cy, min(ground_z) as gz from valid group by 1, 2, 3"),
        ("high", "select region, floor(x / 2) as cx, floor(y / 2) as cy, max(surface_z) as rz from valid where height >= 2 group by 1, 2, 3"),
        ("grid", "select coalesce(low.region, high.region) as region, (coalesce(low.cx, high.cx) + 0.5) * 2 as x, (coalesce(low.cy, high.cy) + 0.5) * 2 as y, gz, rz"
         " from low full join high on high.region = low.region and high.cx = low.cx and high.cy = low.cy"),
        ("b", "select * from fx_rects where category = 'buildings'"),
        ("st", "select b.region, b.seq, median(g.gz) as base, max(g.rz) as top, count(g.gz) as n from b left join grid g on g.region = b.region"
         " and g.x between b.x0 and b.x1 and g.y between b.y0 and b.y1 group by 1, 2"),
        ("zh", "select *, coalesce(base, 0) as base_z, case when top > coalesce(base, 0) then top else coalesce(base, 0) + case when seq % 3 = 0 then 12 when seq % 3 = 1 then 6.5 else 9 end end as top_z from st"),
    ],
)


def zonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buildings with base and top height from the elevation cells they cover."""
    valid = R.valid_cells(cells(spark, sf_dir), BBOX)
    low = R.cell_statistics(valid, z="ground_z", how="min", on=["region"])
    tall = valid.where(F.col("surface_z") - F.col("ground_z") >= 2)
    high = R.cell_statistics(tall, z="surface_z", how="max", on=["region"])
    third = F.col("seq") % 3
    tags = F.when(third == 0, F.create_map(F.lit("building:levels"), F.lit("4"))).when(
        third == 1, F.create_map(F.lit("height"), F.lit("6.5 m"))
    ).otherwise(F.create_map().cast("map<string,string>"))
    polygons = rect_polygons(spark, sf_dir, ("buildings",))
    return R.zonal_heights(
        polygons, low, high, key=["seq"], on=["region"], height=A.building_height([], tags)
    )


@query("zonal_heights", ZONAL_CTES + "select region, seq, round(base_z, 3) as base_z, round(top_z, 3) as top_z, n as ground_samples from zh")
def zonal_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zonal(spark, sf_dir).select(
        "region", "seq", F.round("base_z", 3).alias("base_z"), F.round("top_z", 3).alias("top_z"), "ground_samples"
    )


@query("terrain_median", ZONAL_CTES + "select region, round(median(gz), 3) as terrain_z from low group by 1")
def terrain_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = R.valid_cells(cells(spark, sf_dir), BBOX)
    low = R.cell_statistics(valid, z="ground_z", how="min", on=["region"])
    return low.groupBy("region").agg(F.round(F.median("z"), 3).alias("terrain_z"))


@query(
    "building_height",
    ctes("fx_trees")
    + "select seq, case when seq % 4 = 0 then cast(7.5 as double) when height_tag is not null then cast(replace(height_tag, ' m', '') as double)"
    " when seq % 5 = 0 then cast(seq % 9 as double) * 3 else cast(9 as double) end as height_m, seq % 6 = 0 as has_roof_shape from fx_trees",
)
def building_height(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Height attribute, height tag, storeys, default."""
    df = view(spark, sf_dir, "fx_trees")
    entry = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    tags = F.map_from_entries(
        F.filter(
            F.array(
                entry("height", F.col("height_tag")),
                entry("building:levels", F.when(F.col("seq") % 5 == 0, (F.col("seq") % 9).cast("string"))),
                entry("roof:shape", F.when(F.col("seq") % 6 == 0, F.lit("gabled"))),
            ),
            lambda e: e["value"].isNotNull(),
        )
    )
    prop = F.when(F.col("seq") % 4 == 0, F.lit(7.5))
    return df.select("seq", prop.alias("p"), tags.alias("tags")).select(
        "seq",
        A.building_height([F.col("p")], F.col("tags")).alias("height_m"),
        A.has_roof_shape(F.lit(None).cast("string"), F.col("tags")).alias("has_roof_shape"),
    )


@query(
    "voxel_subsample",
    ctes(
        "fx_cells",
        extra=[
            VALID_CTE,
            ("s", "select v.*, sz from valid v, (values (cast(20 as double)), (cast(10 as double)), (cast(5 as double)), (cast(2.5 as double))) as q(sz)"),
            ("k", "select *, floor(x / sz) as ix, floor(y / sz) as iy, power(x - (floor(x / sz) + 0.5) * sz, 2) + power(y - (floor(y / sz) + 0.5) * sz, 2) as d2 from s"),
            ("rk", "select *, row_number() over (partition by region, sz, ix, iy order by d2, x, y, ground_z) as rn from k"),
        ],
    )
    + "select region, sz as voxel_size, cast(ix as bigint) as ix, cast(iy as bigint) as iy, x, y, round(ground_z, 3) as z from rk where rn = 1",
)
def voxel_subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = R.valid_cells(cells(spark, sf_dir), BBOX).withColumn("z", F.col("ground_z"))
    out = R.voxel_subsample(valid, R.voxel_sizes(DEMO_REGION.outer_diameter_m), by=["region"])
    return out.withColumn("z", F.round("z", 3))


NEAREST_SQL = ctes(
    "fx_cells",
    "fx_rects",
    extra=[
        ("g", "select *, floor(x / 2) as bx, floor(y / 2) as by_ from fx_cells where ground_z is not null"),
        ("v", "select region, seq, x0 as x, y0 as y, floor(x0 / 2) as vx, floor(y0 / 2) as vy from fx_rects"),
        ("p", "select v.region, v.seq, g.ground_z, greatest(abs(g.bx - v.vx), abs(g.by_ - v.vy)) as ring, power(g.x - v.x, 2) + power(g.y - v.y, 2) as d2,"
         " g.bx - v.vx as dx, g.by_ - v.vy as dy, g.seq as gseq from v join g on g.region = v.region and abs(g.bx - v.vx) <= 12 and abs(g.by_ - v.vy) <= 12"),
        ("rk", "select *, row_number() over (partition by region, seq order by ring, d2, dx, dy, gseq) as rn from p"),
        ("m", "select region, avg(ground_z) as mean_z from g group by 1"),
    ],
) + "select v.region, v.seq, round(coalesce(rk.ground_z, m.mean_z), 3) as ground_z from v left join rk on rk.region = v.region and rk.seq = v.seq and rk.rn = 1 left join m on m.region = v.region"


@query("nearest_ground", NEAREST_SQL)
def nearest_ground(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground under the first corner of every rectangle: own cell, rings, then the mean."""
    corners = view(spark, sf_dir, "fx_rects").select("region", "seq", F.col("x0").alias("x"), F.col("y0").alias("y"))
    ground = cells(spark, sf_dir).where("ground_z is not null").select(
        "region", F.col("x").alias("gx"), F.col("y").alias("gy"), F.col("ground_z").alias("gz"), F.col("seq").alias("gseq")
    )
    out = S.nearest_ground(corners, ground, key=["seq"], on=["region"])
    return out.select("region", "seq", F.round("ground_z", 3).alias("ground_z"))


ALIGN_SQL = ctes(
    "fx_cells",
    "fx_rects",
    extra=[
        VALID_CTE,
        ("cd", "select * from valid where height >= 2"),
        ("off", "select dx, dy from (select unnest(range(-6, 7)) as dx) a, (select unnest(range(-6, 7)) as dy) b"),
        ("mv", "select s.region, s.seq, o.dx, o.dy, s.x - o.dx as mx, s.y - o.dy as my from cd s, off o"),
        ("hit", "select distinct m.region, m.seq, m.dx, m.dy from mv m join fx_rects p on p.region = m.region and p.category = 'buildings' and m.mx between p.x0 and p.x1 and m.my between p.y0 and p.y1"),
        ("sc", "select region, dx, dy, count(*) as score from hit group by 1, 2, 3"),
        ("best", "select *, row_number() over (partition by region order by score desc, sqrt(dx * dx + dy * dy), dx, dy) as rn from sc"),
        ("nn", "select region, count(*) as candidate_points from cd group by 1"),
        ("np", "select region, count(*) as polygon_count from fx_rects where category = 'buildings' group by 1"),
    ],
) + (
    "select nn.region, candidate_points, polygon_count, coalesce(dx, 0) as dx, coalesce(dy, 0) as dy, coalesce(score, 0) as score,"
    " round(sqrt(cast(coalesce(dx * dx + dy * dy, 0) as double)), 3) as shift_m,"
    " case when coalesce(score, 0) <= 0 then 'warning' when sqrt(dx * dx + dy * dy) > 5 then 'failed' when sqrt(dx * dx + dy * dy) > 2 then 'warning' else 'passed' end as status"
    " from nn join np on np.region = nn.region left join best on best.region = nn.region and best.rn = 1"
)


@query("alignment_offset", ALIGN_SQL)
def alignment_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Horizontal shift that puts most elevated cells inside building footprints, per region."""
    valid = R.valid_cells(cells(spark, sf_dir), BBOX)
    tall = valid.where(F.col("surface_z") - F.col("ground_z") >= 2)
    return R.alignment(tall, rect_polygons(spark, sf_dir, ("buildings",)), order="seq", on=["region"], key=["seq"])
