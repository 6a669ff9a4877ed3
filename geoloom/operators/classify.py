"""Ordered first-match tag classification, rejection reasons and the tag inventory."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.measure import let


@dataclass(frozen=True)
class Rule:
    """``match_any`` holds ``key`` (any value) or ``key=value`` expressions."""

    category: str
    group_tag: str
    match_any: tuple[str, ...]


# Default classification rules, first match wins.
DEFAULT_RULES = (
    Rule("buildings", "building", ("building",)),
    Rule("buildings", "building_part", ("building:part",)),
    Rule("trees", "tree", ("natural=tree",)),
    Rule(
        "water",
        "water",
        (
            "natural=water",
            "natural=wetland",
            "natural=bay",
            "water",
            "waterway",
            "landuse=reservoir",
            "landuse=basin",
        ),
    ),
    Rule(
        "green_areas",
        "green_area",
        (
            "landuse=grass",
            "landuse=forest",
            "landuse=meadow",
            "landuse=recreation_ground",
            "landuse=village_green",
            "landuse=allotments",
            "landuse=orchard",
            "landuse=vineyard",
            "landuse=plant_nursery",
            "landuse=cemetery",
            "leisure=park",
            "leisure=garden",
            "leisure=pitch",
            "leisure=golf_course",
            "leisure=nature_reserve",
            "natural=wood",
            "natural=scrub",
            "natural=grassland",
            "natural=heath",
            "natural=tree_row",
        ),
    ),
    Rule("roads", "road", ("highway",)),
    Rule(
        "concrete",
        "paved_ground",
        (
            "surface=asphalt",
            "surface=chipseal",
            "surface=cobblestone",
            "surface=compacted",
            "surface=concrete",
            "surface=concrete:lanes",
            "surface=concrete:plates",
            "surface=fine_gravel",
            "surface=gravel",
            "surface=paved",
            "surface=paving_stones",
            "surface=sett",
            "surface=stone",
            "surface=tiles",
            "surface=unpaved",
            "amenity=parking",
            "amenity=marketplace",
            "amenity=bicycle_parking",
            "amenity=motorcycle_parking",
            "landuse=industrial",
            "landuse=commercial",
            "landuse=retail",
            "landuse=construction",
            "landuse=railway",
            "landuse=brownfield",
            "place=square",
            "area=yes",
        ),
    ),
    Rule(
        "other_terrain",
        "other_terrain",
        (
            "landuse",
            "leisure",
            "natural",
            "amenity",
            "tourism",
            "historic",
            "place",
            "surface",
            "area",
            "man_made",
        ),
    ),
)

DEFAULT_PRECEDENCE = (
    "buildings:building_part",
    "buildings",
    "water",
    "supplemental:green_areas",
    "green_areas",
    "supplemental:streets",
    "roads",
    "concrete",
    "other_terrain",
)

# Keys that usually describe a physical feature.
FEATURE_LIKE_KEYS = (
    "aeroway",
    "amenity",
    "barrier",
    "building",
    "craft",
    "emergency",
    "geological",
    "healthcare",
    "highway",
    "historic",
    "landuse",
    "leisure",
    "man_made",
    "natural",
    "office",
    "place",
    "power",
    "public_transport",
    "railway",
    "shop",
    "sport",
    "surface",
    "tourism",
    "water",
    "waterway",
)


def classify(tags: Column, rules: Sequence[Rule] = DEFAULT_RULES) -> Column:
    """Struct ``(category, group_tag, source_tag)`` of the first matching rule, or null.

    Rules are configuration of fixed size: their expressions become one literal
    map from expression to position, every tag looks itself up, and the smallest
    position wins. No join, no shuffle, and the expression stays small however
    long the rule list is.
    """
    expressions = [(e, r) for r in rules for e in r.match_any]
    first = {}
    for position, (expression, _) in enumerate(expressions):
        first.setdefault(expression, position)
    ranks = F.create_map(*[F.lit(v) for pair in first.items() for v in pair])
    pick = lambda values, n: F.get(F.array(*[F.lit(v) for v in values]), n)

    def ranked(e: Column) -> Column:
        text = F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))
        n = F.least(F.try_element_at(ranks, e["key"]), F.try_element_at(ranks, text))
        return F.struct(n.alias("n"), text.alias("source_tag"))

    matches = F.filter(F.transform(F.map_entries(tags), ranked), lambda m: m["n"].isNotNull())
    return let(
        F.array_min(matches),
        lambda m: F.when(
            m.isNotNull(),
            F.struct(
                pick([r.category for _, r in expressions], m["n"]).alias("category"),
                pick([r.group_tag for _, r in expressions], m["n"]).alias("group_tag"),
                m["source_tag"].alias("source_tag"),
            ),
        ),
    )


def skip_reason(
    is_object: Column, tags: Column, classified: Column, has_geometry: Column, zone: Column
) -> Column:
    """First failing acceptance check, or null for an accepted element."""
    return (
        F.when(~is_object, F.lit("invalid_element"))
        .when(tags.isNull(), F.lit("missing_tags"))
        .when(classified.isNull(), F.lit("unsupported_tags"))
        .when(~has_geometry, F.lit("unsupported_or_incomplete_geometry"))
        .when(zone.isNull(), F.lit("outside_roi_policy"))
    )


def tag_inventory(elements: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Long-form counts ``(metric, key, n)`` over elements with ``type`` and ``tags``.

    Every element fans out into its metric rows in one pass and one map-side
    combined aggregate counts them all.
    """
    row = lambda metric, key: F.struct(F.lit(metric).alias("metric"), key.alias("key"))
    tags = F.when(F.size("tags") > 0, F.col("tags"))
    cls = F.col("_cls")
    pair = lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))
    entries = F.coalesce(F.map_entries(tags), F.array().cast("array<struct<key:string,value:string>>"))
    none = F.array().cast("array<struct<metric:string,key:string>>")
    rows = F.concat(
        F.array(row("element_type", F.coalesce("type", F.lit("unknown")))),
        F.when(tags.isNotNull(), F.array(row("tagged_elements", F.lit("all")))).otherwise(none),
        F.transform(entries, lambda e: row("tag_key", e["key"])),
        F.transform(entries, lambda e: row("tag_value", pair(e))),
        F.when(tags.isNotNull() & cls.isNotNull(), F.array(row("classified_source_tag", cls["source_tag"]))).otherwise(none),
        F.when(cls.isNull(), F.transform(entries, lambda e: row("unclassified_tag_value", pair(e)))).otherwise(none),
        F.when(
            cls.isNull(),
            F.transform(
                F.filter(entries, lambda e: e["key"].isin(*FEATURE_LIKE_KEYS)),
                lambda e: row("unclassified_feature_like_tag_value", pair(e)),
            ),
        ).otherwise(none),
    )
    return (
        elements.withColumn("_cls", classify(F.col("tags"), rules))
        .select(F.explode(rows).alias("_r"))
        .groupBy(F.col("_r.metric").alias("metric"), F.col("_r.key").alias("key"))
        .agg(F.count("*").alias("n"))
    )
