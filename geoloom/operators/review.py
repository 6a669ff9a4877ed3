"""Review candidates from segmentation masks: class mapping, best source match, statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions import attributes as A
from geoloom.functions import measure as M
from geoloom.operators.ordering import ordinal
from geoloom.operators.overlay import geometry_overlaps
from geoloom.params import Region


def available_imagery(imagery: DataFrame) -> DataFrame:
    return imagery.where((F.col("status") == "fetched") & F.col("image_path").isNotNull())


def prepare_masks(masks: DataFrame) -> DataFrame:
    """Valid masks of mapped classes with ``segmentation_class`` and ``candidate_group``.

    ``masks`` carry the free text columns ``raw_class`` (already coalesced or a
    single property) and ``parts``.
    """
    df = masks.withColumn("segmentation_class", A.semantic_class(F.col("raw_class"))).withColumn(
        "candidate_group", A.target_group(F.col("segmentation_class"))
    )
    return df.where(F.col("candidate_group").isNotNull() & (F.size("parts") > 0) & (M.parts_area(F.col("parts")) > 0.0))


def best_matches(
    candidates: DataFrame, sources: DataFrame, *, on: Sequence[str] = (), tile: float = 128.0
) -> DataFrame:
    """Best source per candidate by overlap share within the allowed categories; the first source wins ties.

    ``candidates``: ``seq, candidate_group, parts``; ``sources``: ``seq,
    category, parts``. Identical source geometries of one category are
    represented by their first feature, which would win the tie anyway.
    """
    firsts = sources.groupBy(*on, "category", "parts").agg(F.min("seq").alias("source_seq"))
    shapes = candidates.select(*on, F.col("seq").alias("gid"), F.lit(0).alias("side"), "parts").unionByName(
        firsts.select(*on, F.col("source_seq").alias("gid"), F.lit(1).alias("side"), "parts")
    )
    areas = geometry_overlaps(shapes, on=on, side="side", tile=tile)
    pairs = (
        areas.join(candidates.select(*on, F.col("seq").alias("gid_a"), "candidate_group", M.parts_area(F.col("parts")).alias("_area")), [*on, "gid_a"])
        .join(firsts.select(*on, F.col("source_seq").alias("gid_b"), "category"), [*on, "gid_b"])
        .where(F.array_contains(A.match_categories(F.col("candidate_group")), F.col("category")))
        .withColumn("ratio", F.col("area") / F.greatest("_area", F.lit(1e-18)))
    )
    best = F.max(F.struct("ratio", (-F.col("gid_b")).alias("neg")))
    return pairs.groupBy(*on, F.col("gid_a").alias("seq")).agg(best.alias("_b")).select(
        *on, "seq", (-F.col("_b.neg")).alias("matched_seq"), F.col("_b.ratio").alias("matched_ratio")
    )


def build_candidates(
    masks: DataFrame,
    sources: DataFrame,
    *,
    on: Sequence[str] = (),
    source_label: str = "segmentation",
    backend: str = "external_geojson_segmentation",
    region: Region | None = None,
    image: str | None = None,
) -> DataFrame:
    """Review candidates with their match, action, confidence and running id per group.

    ``source_image`` is the mask's own, else ``image``, else ``unknown``.
    ``region`` adds the zone by area centroid (lon/lat geometry); without it
    the zone is left to the caller.
    """
    df = prepare_masks(masks)
    matched = best_matches(df, sources, on=on)
    source_info = sources.select(
        *on,
        F.col("seq").alias("matched_seq"),
        F.col("category").alias("matched_source_category"),
        A.feature_id(F.col("osm_type"), F.col("osm_id")).alias("matched_source_feature_id"),
        M.shell_vertex_count(F.col("parts")).cast("bigint").alias("matched_footprint_vertex_count"),
    )
    df = df.join(matched, [*on, "seq"], "left").join(source_info, [*on, "matched_seq"], "left")
    df = ordinal(df, order="seq", out="_n", by=[*on, "candidate_group"])
    cls, group = F.col("segmentation_class"), F.col("candidate_group")
    category = A.suggested_category(cls, group)
    building = group == "buildings"
    vertices = M.shell_vertex_count(F.col("parts")).cast("bigint")
    action = A.proposed_action(group, F.col("matched_source_category"), category)
    if source_label == "sat2lod2":
        action = F.when(
            building & F.col("matched_seq").isNotNull(), F.lit("import_sat2lod2_refined_footprint_for_lod22")
        ).when(building, F.lit("import_sat2lod2_missing_building_candidate")).otherwise(action)
    out = df.withColumns(
        {
            "candidate_id": F.concat(group, F.lit("_"), F.col("_n").cast("string")),
            "category": category,
            "source": F.lit(source_label),
            "source_tag": A.suggested_tag(cls, category),
            "segmentation_backend": F.coalesce(
                F.nullif(F.col("backend"), F.lit("")) if "backend" in df.columns else F.lit(None).cast("string"), F.lit(backend)
            ),
            "confidence": A.confidence(F.col("confidence")),
            "source_image": A.source_image(
                [F.col("source_image")] if "source_image" in df.columns else [], F.lit(image).cast("string")
            ),
            "review_status": F.lit("needs_review"),
            "contributes_to_geometry": F.lit(False),
            "geometry_role": F.lit("segmentation_candidate_review_only"),
            "proposed_action": action,
            "matched_overlap_ratio": F.coalesce(F.round("matched_ratio", 4), F.lit(0.0)),
            "include_in_lod22": F.lit(False),
            "footprint_vertex_count": F.when(building, vertices),
            "footprint_vertex_count_delta": F.when(building, vertices - F.col("matched_footprint_vertex_count")),
            "matched_footprint_vertex_count": F.when(building, F.col("matched_footprint_vertex_count")),
        }
    ).drop("_n", "matched_ratio")
    if region is not None:
        center = M.area_centroid(F.col("parts"))
        out = out.withColumn("_c", center).withColumns(
            {
                "roi_zone": M.candidate_zone(F.col("_c.x"), F.col("_c.y"), region),
                "area_m2": F.round(M.local_area_m2(F.col("parts"), region), 3),
            }
        ).drop("_c").withColumn("reconstruction_scope", M.reconstruction_scope(F.col("roi_zone")))
    return out


def review_set(sources: DataFrame, candidates: DataFrame) -> DataFrame:
    """Source features and candidates together, told apart by ``visual_enrichment_role``."""
    return sources.withColumn("visual_enrichment_role", F.lit("stage_1_source_feature")).unionByName(
        candidates.withColumn("visual_enrichment_role", F.lit(None).cast("string")), allowMissingColumns=True
    )
