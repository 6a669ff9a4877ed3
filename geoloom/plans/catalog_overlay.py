"""Driver queries: overlaps, precedence partition, clipping, gap fill, layers, review candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import attributes as A
from geoloom.functions import crs as C
from geoloom.functions import measure as M
from geoloom.operators import overlay as OV
from geoloom.operators import quality as Q
from geoloom.operators import review as RV
from geoloom.operators.skew import stored
from geoloom.params import DEMO_REGION
from geoloom.plans.catalog_features import RANK_SQL, holed_parts, ranked_rects, rect_parts
from geoloom.plans.fixtures import ctes, view
from geoloom.plans.registry import query

PAIRS_SQL = (
    "select a.region, a.seq as first_feature_index, b.seq as second_feature_index, a.category as first_source_tag, b.category as second_source_tag,"
    " (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) as area,"
    " least((a.x1 - a.x0) * (a.y1 - a.y0), (b.x1 - b.x0) * (b.y1 - b.y0)) as smaller from fx_rects a join fx_rects b on a.region = b.region and a.seq < b.seq"
    " and a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1"
)


def footprint_check(spark: SparkSession, sf_dir: str) -> OV.FootprintOverlaps:
    df = rect_parts(spark, sf_dir).withColumn("source_tag", F.col("category"))
    return OV.FootprintOverlaps(df.select("region", "seq", "source_tag", "parts"), on=["region"])


@query(
    "footprint_overlaps",
    ctes("fx_rects", extra=[("p", PAIRS_SQL)])
    + "select region, first_feature_index, second_feature_index, first_source_tag, second_source_tag, round(area, 3) as intersection_area_m2,"
    " round(area / smaller, 4) as overlap_ratio_of_smaller from p order by area desc, first_feature_index, second_feature_index limit 100",
)
def footprint_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred largest overlaps."""
    return footprint_check(spark, sf_dir).top(100)


@query(
    "footprint_qa",
    ctes("fx_rects", extra=[("p", PAIRS_SQL)])
    + "select r.region, r.n as feature_count, r.n as polygon_count, cast(0 as bigint) as inner_ring_count, cast(0 as bigint) as invalid_or_empty_geometry_count,"
    " coalesce(q.n, 0) as overlap_pair_count, coalesce(q.largest, 0) as largest_overlap_area_m2, case when q.n > 0 then 'warning' else 'passed' end as overlap_status"
    " from (select region, count(*) as n from fx_rects group by 1) r left join (select region, count(*) as n, max(area) as largest from p where area > 0.05 group by 1) q on q.region = r.region",
)
def footprint_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return footprint_check(spark, sf_dir).summary()


@query(
    "copied_footprints_qa",
    ctes(
        "fx_rects",
        extra=[
            ("c", "select region, seq, case when seq % 3 = 0 then 0 else x0 end as x0, case when seq % 3 = 0 then 0 else y0 end as y0,"
             " case when seq % 3 = 0 then 5 else x1 end as x1, case when seq % 3 = 0 then 5 else y1 end as y1 from fx_rects"),
            ("p", "select a.region, (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) as area from c a join c b"
             " on a.region = b.region and a.seq < b.seq and a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1"),
        ],
    )
    + "select region, count(*) as overlap_pair_count, max(area) as largest_overlap_area_m2 from p where area > 0.05 group by 1",
)
def copied_footprints_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all footprints are copies of one square: their pairs are counted, not built."""
    df = view(spark, sf_dir, "fx_rects")
    same = F.col("seq") % 3 == 0
    box = [F.when(same, v).otherwise(F.col(c)).cast("double") for c, v in (("x0", 0), ("y0", 0), ("x1", 5), ("y1", 5))]
    shapes = df.select("region", "seq", F.col("category").alias("source_tag"), M.box_parts(*box).alias("parts"))
    return OV.FootprintOverlaps(shapes, on=["region"]).summary().select(
        "region", "overlap_pair_count", "largest_overlap_area_m2"
    )


UNIT_SQL = (
    "select region, seq, category, rank, x0 + i as ux, y0 + j as uy from (select *, unnest(range(cast(x1 - x0 as bigint))) as i from (select *, "
    f"{RANK_SQL} as rank from fx_rects)) a, (select unnest(range(20)) as j) b where y0 + j < y1"
)
PARTITION_CTES = ctes(
    "fx_rects",
    extra=[
        ("unit", UNIT_SQL),
        ("own", "select region, ux, uy, arg_min(seq, cast(rank as bigint) * 1000000000 + seq) as seq from unit group by 1, 2, 3"),
        ("kept", "select region, seq, cast(count(*) as double) as area from own group by 1, 2"),
        (
            "res",
            "select r.region, r.seq, r.category, r.supplement, (x1 - x0) * (y1 - y0) as source_area, coalesce(k.area, 0) as area_m2 from fx_rects r"
            " left join kept k on k.region = r.region and k.seq = r.seq",
        ),
        (
            "st",
            "select *, source_area - area_m2 as removed, case when area_m2 = 0 then 'removed' when source_area - area_m2 > 0.01 then 'clipped' else 'accepted' end as state from res",
        ),
    ],
)


@query(
    "surface_partition",
    PARTITION_CTES + "select region, seq, round(area_m2, 3) as area_m2, round(removed, 3) as removed_area_m2, state from st",
)
def surface_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every surface minus everything that precedes it."""
    out = OV.partition_surfaces(ranked_rects(spark, sf_dir).select("region", "seq", "rank", "parts"), on=["region"])
    return out.select(
        "region", "seq", F.round("area_m2", 3).alias("area_m2"), F.round("removed_area_m2", 3).alias("removed_area_m2"), "state"
    )


@query("surface_partition_geometry", PARTITION_CTES + "select region, seq, cast(ux as bigint) as ux, cast(uy as bigint) as uy from own")
def surface_partition_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit squares inside the polygons that the precedence partition leaves of every surface."""
    out = OV.disjoint_surfaces(ranked_rects(spark, sf_dir).select("region", "seq", "rank", "parts"), on=["region"])
    polygons = out.where("parts is not null").select("region", "seq", F.explode("parts").alias("polygon"))
    # A polygon becomes a row for each of its squares: the tasks keep the configured parallelism.
    polygons = polygons.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "region", "seq")
    box = M.parts_bbox(F.array("polygon"))
    span = lambda lo, hi: F.sequence(F.floor(box[lo]).cast("bigint"), F.ceil(box[hi]).cast("bigint") - 1)
    squares = polygons.withColumn("ux", F.explode(span("min_x", "max_x"))).withColumn("uy", F.explode(span("min_y", "max_y")))
    middle = squares.withColumns({"px": F.col("ux") + F.lit(0.5), "py": F.col("uy") + F.lit(0.5)})
    return middle.where(M.point_in_polygon("polygon", "px", "py")).select("region", "seq", "ux", "uy")


@query(
    "surface_partition_stats",
    PARTITION_CTES
    + "select region, category, count(*) as input_features, count(case when state <> 'removed' then 1 end) as accepted_features,"
    " count(case when state = 'clipped' then 1 end) as clipped_features, count(case when state = 'removed' then 1 end) as removed_features,"
    " round(sum(removed), 3) as removed_area_m2 from st group by 1, 2",
)
def surface_partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ranked_rects(spark, sf_dir).select("region", "seq", "rank", "category", "parts")
    return OV.overlap_statistics(OV.partition_surfaces(ranked, on=["region"]), ["region", "category"])


@query(
    "surface_partition_by_supplement",
    PARTITION_CTES
    + "select region, supplement as supplemental_input_id, count(*) as input_features, count(case when state <> 'removed' then 1 end) as accepted_features,"
    " count(case when state = 'clipped' then 1 end) as clipped_features, count(case when state = 'removed' then 1 end) as removed_features,"
    " round(sum(removed), 3) as removed_area_m2 from st where supplement is not null group by 1, 2",
)
def surface_partition_by_supplement(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ranked_rects(spark, sf_dir).select("region", "seq", "rank", "supplemental_input_id", "parts")
    out = OV.partition_surfaces(ranked, on=["region"]).where("supplemental_input_id is not null")
    return OV.overlap_statistics(out, ["region", "supplemental_input_id"])


@query(
    "surface_pieces_area",
    PARTITION_CTES + "select region, seq, round(area_m2, 3) as area_m2 from st where area_m2 > 0",
)
def surface_pieces_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas recomputed from the trapezoids that make up the disjoint surfaces."""
    pieces = OV.surface_pieces(ranked_rects(spark, sf_dir).select("region", "seq", "rank", "parts"), on=["region"])
    shapes = pieces.withColumn("polygon", OV.trapezoid_polygon())
    return shapes.groupBy("region", "seq").agg(F.round(F.sum(M.polygon_area(F.col("polygon"))), 3).alias("area_m2"))


UNION_CTES = ctes("fx_rects", extra=[("unit", UNIT_SQL), ("cells", "select distinct region, ux, uy from unit")])


@query("union_area", UNION_CTES + "select region, round(cast(count(*) as double), 3) as union_area_m2 from cells group by 1")
def union_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = OV.union_area(rect_parts(spark, sf_dir).select("region", "seq", "parts"), on=["region"])
    return out.select("region", F.round("union_area_m2", 3).alias("union_area_m2"))


def circle_area_sql(x: str = "ux", y: str = "uy") -> str:
    """Unit squares wholly inside the 256-gon of radius 250 or wholly outside it (others are left out)."""
    far = f"sqrt(power(greatest(abs({x}), abs({x} + 1)), 2) + power(greatest(abs({y}), abs({y} + 1)), 2))"
    near = f"sqrt(power(greatest({x}, -{x} - 1, 0), 2) + power(greatest({y}, -{y} - 1, 0), 2))"
    return f"case when {far} <= 250 * cos(pi() / 256) then 'in' when {near} >= 250 then 'out' else 'edge' end"


@query(
    "clip_to_roi",
    ctes(
        "fx_rects",
        extra=[
            ("u", f"select region, seq, (x1 - x0) * (y1 - y0) as full_area, unnest(range(cast(x1 - x0 as bigint))) + x0 as ux, y0, y1 from fx_rects"),
            ("q", f"select u.*, y0 + j as uy from u, (select unnest(range(20)) as j) b where y0 + j < y1"),
            ("s", f"select region, seq, {circle_area_sql()} as side from q"),
            ("t", "select region, seq, count(case when side = 'in' then 1 end) as n_in, count(case when side = 'edge' then 1 end) as n_edge from s group by 1, 2"),
        ],
    )
    + "select region, seq, true as within_bounds from t where n_in > 0",
)
def clip_to_roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles clipped to the region circle; the area lies between the sure and the possible unit squares."""
    df = rect_parts(spark, sf_dir).select("region", "seq", "x0", "y0", "x1", "y1", "parts")
    out = OV.clip_to_circle(df, radius=DEMO_REGION.outer_radius_m, on=["region"])
    grid = out.withColumn("ux", F.explode(F.sequence(F.col("x0").cast("int"), F.col("x1").cast("int") - 1))).withColumn(
        "uy", F.explode(F.sequence(F.col("y0").cast("int"), F.col("y1").cast("int") - 1))
    )
    side = F.expr(circle_area_sql())
    counts = grid.groupBy("region", "seq", "area_m2").agg(
        F.count_if(side == "in").alias("n_in"), F.count_if(side == "edge").alias("n_edge")
    )
    fits = (F.col("area_m2") >= F.col("n_in") - 1e-6) & (F.col("area_m2") <= F.col("n_in") + F.col("n_edge") + 1e-6)
    return counts.where("n_in > 0").select("region", "seq", fits.alias("within_bounds"))


@query("clipped_areas")
def clipped_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact clipped areas (also of rectangles with holes) for every straddling or inside rectangle."""
    out = OV.clip_to_circle(
        holed_parts(spark, sf_dir).select("region", "seq", "parts"), radius=DEMO_REGION.outer_radius_m, on=["region"]
    )
    return out.select("region", "seq", F.round("area_m2", 3).alias("area_m2"), "clipped")


@query(
    "surface_layers",
    ctes("fx_rects")
    + "select category, count(*) as source_count, count(case when sqrt(power(greatest(x0, -x1, 0), 2) + power(greatest(y0, -y1, 0), 2)) < 249.9 then 1 end) as feature_count,"
    " cast(null as varchar) as error from fx_rects where category <> 'buildings' and not sqrt(power(greatest(x0, -x1, 0), 2) + power(greatest(y0, -y1, 0), 2)) between 249.9 and 250 group by 1",
)
def surface_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City-model layers: non-building categories clipped to the domain circle."""
    df = rect_parts(spark, sf_dir)
    gap = F.hypot(
        F.greatest(F.col("x0"), -F.col("x1"), F.lit(0.0)), F.greatest(F.col("y0"), -F.col("y1"), F.lit(0.0))
    )
    # Rectangles that end within a hand's breadth of the circle depend on its corners; they are tested elsewhere.
    clear = df.where(~gap.between(249.9, 250.0)).select("region", "seq", "category", "parts")
    return OV.surface_layers(clear, region=DEMO_REGION, center=(0.0, 0.0), on=["region"])[1]


def gap_features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    df = rect_parts(spark, sf_dir).select("region", "seq", "parts")
    return df, df.select("region").distinct()


@query("gap_fill")
def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connected uncovered pieces of every region circle, numbered inner first."""
    out = OV.gap_fill(*gap_features(spark, sf_dir), region=DEMO_REGION, on=["region"])
    return out.select(
        "region", "gap_no", "zone", F.round("area_m2", 3).alias("area_m2"), F.round("centroid_distance_m", 3).alias("roi_distance_m")
    )


@query("gap_fill_features")
def gap_fill_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated features of the gaps; area and corners come from their polygons."""
    gaps = OV.gap_fill(*gap_features(spark, sf_dir), region=DEMO_REGION, on=["region"], geometry=True)
    corners = F.aggregate(F.flatten("parts"), F.lit(0), lambda n, r: n + F.size(r) - 1)
    return gaps.select(
        "region", "gap_no", "zone", F.round(M.parts_area(F.col("parts")), 3).alias("area_m2"), corners.alias("corners"),
        F.abs(M.parts_area(F.col("parts")) - F.col("area_m2")).alias("area_error_m2") < 1e-3,
    ).toDF("region", "gap_no", "zone", "area_m2", "corners", "area_agrees")


@query(
    "gap_fill_area",
    UNION_CTES
    + f", s as (select region, {circle_area_sql()} as side from cells), c as (select 250.0 * 250.0 * 128 * sin(2 * pi() / 256) as disc),"
    " t as (select region, count(case when side = 'in' then 1 end) as n_in, count(case when side = 'edge' then 1 end) as n_edge from s group by 1)"
    " select region, true as within_bounds from t",
)
def gap_fill_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap area plus covered area equals the region polygon."""
    import math

    features, regions = gap_features(spark, sf_dir)
    gaps = OV.gap_fill(features, regions, region=DEMO_REGION, on=["region"], min_area=0.0)
    free = gaps.groupBy("region").agg(F.sum("area_m2").alias("free"))
    # Read by several branches of the overlay, each of which would clip all features anew.
    inside = stored(OV.clipped_pieces(features, radius=DEMO_REGION.outer_radius_m, on=["region"]))
    again = inside.select(
        "region", F.xxhash64("seq", "y_lo", "xl_lo").alias("seq"), F.array(OV.trapezoid_polygon()).alias("parts")
    )
    covered = OV.union_area(again, on=["region"])
    disc = 0.5 * 256 * math.sin(2.0 * math.pi / 256) * DEMO_REGION.outer_radius_m**2
    fits = F.abs(F.col("free") + F.col("union_area_m2") - disc) < 1e-3
    return free.join(covered, "region").select("region", fits.alias("within_bounds"))


# --- review of segmentation masks ---------------------------------------------------------------------


def masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rect_parts(spark, sf_dir, "fx_masks")


def mask_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rect_parts(spark, sf_dir)
    return df.select(
        "region", "seq", "category", "parts", F.lit("way").alias("osm_type"), F.col("seq").cast("string").alias("osm_id")
    )


MASK_SQL = ctes(
    "fx_masks",
    "fx_rects",
    extra=[
        (
            "mk",
            "select *, case raw_class when 'Building' then 'building' when 'paving-stones' then 'paving_stones' when 'tree canopy' then 'tree_canopy' else raw_class end as cls,"
            " case raw_class when 'Building' then 'buildings' when 'asphalt' then 'roads_paved_concrete' when 'paving-stones' then 'roads_paved_concrete' else 'terrain' end as grp,"
            " case raw_class when 'Building' then 'buildings' when 'asphalt' then 'roads' when 'paving-stones' then 'concrete' when 'tree canopy' then 'green_areas' else 'water' end as cat,"
            " case raw_class when 'Building' then 'building=segmentation_candidate' when 'asphalt' then 'surface=asphalt' when 'paving-stones' then 'surface=paved'"
            " when 'tree canopy' then 'landcover=vegetation' else 'natural=water' end as tag from fx_masks",
        ),
        (
            "ov",
            "select m.region, m.seq, r.seq as rseq, r.category, (least(m.x1, r.x1) - greatest(m.x0, r.x0)) * (least(m.y1, r.y1) - greatest(m.y0, r.y0)) / ((m.x1 - m.x0) * (m.y1 - m.y0)) as ratio"
            " from mk m join fx_rects r on r.region = m.region and m.x0 < r.x1 and r.x0 < m.x1 and m.y0 < r.y1 and r.y0 < m.y1"
            " and case m.grp when 'buildings' then r.category = 'buildings' when 'terrain' then r.category in ('green_areas', 'water', 'concrete') else r.category in ('roads', 'concrete') end",
        ),
        ("bm", "select *, row_number() over (partition by region, seq order by ratio desc, rseq) as rn from ov"),
        (
            "cd",
            "select m.*, b.rseq, b.category as mcat, coalesce(round(b.ratio, 4), 0) as ratio, row_number() over (partition by m.region, m.grp order by m.seq) as n"
            " from mk m left join bm b on b.region = m.region and b.seq = m.seq and b.rn = 1",
        ),
    ],
)
CONF_SQL = "round(greatest(0, least(1, confidence)), 4)"


@query(
    "mask_candidates",
    MASK_SQL
    + f"select region, concat(grp, '_', cast(n as string)) as candidate_id, cls as segmentation_class, cat as category, tag as source_tag, {CONF_SQL} as confidence,"
    " case when grp = 'buildings' then case when rseq is null then 'add_missing_building_candidate' else 'refine_existing_footprint_for_lod22' end"
    " else concat('add_or_refine_', cat, '_surface') end as proposed_action, case when rseq is null then null else concat('way:', cast(rseq as string)) end as matched_source_feature_id,"
    " mcat as matched_source_category, ratio as matched_overlap_ratio, case when grp = 'buildings' then cast(5 as bigint) end as footprint_vertex_count,"
    " case when grp = 'buildings' and rseq is not null then cast(0 as bigint) end as footprint_vertex_count_delta, (x1 - x0) * (y1 - y0) as area_m2 from cd",
)
def mask_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = RV.build_candidates(masks(spark, sf_dir), mask_sources(spark, sf_dir), on=["region"])
    return out.select(
        "region",
        "candidate_id",
        "segmentation_class",
        "category",
        "source_tag",
        "confidence",
        "proposed_action",
        "matched_source_feature_id",
        "matched_source_category",
        "matched_overlap_ratio",
        "footprint_vertex_count",
        "footprint_vertex_count_delta",
        M.parts_area(F.col("parts")).alias("area_m2"),
    )


@query("mask_best_overlap", MASK_SQL + "select region, seq, rseq as matched_seq, round(ratio, 4) as ratio from bm where rn = 1")
def mask_best_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = RV.best_matches(RV.prepare_masks(masks(spark, sf_dir)), mask_sources(spark, sf_dir), on=["region"])
    return out.select("region", "seq", "matched_seq", F.round("matched_ratio", 4).alias("ratio"))


@query(
    "mask_confidence",
    MASK_SQL
    + f"select region, grp as candidate_group, count(confidence) as n, round(min({CONF_SQL}), 4) as min_confidence, round(max({CONF_SQL}), 4) as max_confidence,"
    f" round(avg({CONF_SQL}), 4) as mean_confidence from cd group by 1, 2",
)
def mask_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = RV.prepare_masks(masks(spark, sf_dir)).withColumn("confidence", A.confidence(F.col("confidence")))
    return Q.confidence_statistics(df, by=["region", "candidate_group"])


@query(
    "review_set",
    MASK_SQL
    + "select 'stage_1_source_feature' as role, category, count(*) as n from fx_rects group by 2 union all select null, cat, count(*) from cd group by 2",
)
def review_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source features and candidates in one review table."""
    sources = mask_sources(spark, sf_dir)
    both = RV.review_set(sources, RV.build_candidates(masks(spark, sf_dir), sources, on=["region"]))
    return both.groupBy(F.col("visual_enrichment_role").alias("role"), "category").agg(F.count("*").alias("n"))


@query(
    "candidate_zones",
    ctes("fx_masks")
    + "select region, seq, case when 2.0 * 6371000.0 * asin(sqrt(power(sin(radians((y0 + y1) / 2 * 180 / (pi() * 6371000.0)) / 2), 2) + cos(radians(43.7696))"
    " * cos(radians(43.7696 + (y0 + y1) / 2 * 180 / (pi() * 6371000.0))) * power(sin(radians((x0 + x1) / 2 * 180 / (pi() * 6371000.0 * cos(radians(43.7696)))) / 2), 2))) <= 150"
    " then 'inner' else 'annular' end as roi_zone, round((x1 - x0) * (y1 - y0), 3) as area_m2 from fx_masks",
)
def candidate_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone by great-circle distance of the centroid, and local-plane area, from degrees."""
    df = masks(spark, sf_dir).withColumn("parts", C.delocalize_parts(F.col("parts"), DEMO_REGION))
    return df.withColumn("c", M.area_centroid(F.col("parts"))).select(
        "region",
        "seq",
        M.candidate_zone(F.col("c.x"), F.col("c.y"), DEMO_REGION).alias("roi_zone"),
        F.round(M.local_area_m2(F.col("parts"), DEMO_REGION), 3).alias("area_m2"),
    )
