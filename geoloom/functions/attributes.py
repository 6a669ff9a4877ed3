"""Tag and attribute functions: parsing, normalization, provenance of dimensions."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoloom.functions.measure import let

# Attribute synonyms of municipal tree inventories.
SPECIES_KEYS = ("species", "specie", "genus", "taxon", "nome_specie")
DBH_KEYS = (
    "dbh",
    "dbh_cm",
    "diameter_breast_height",
    "diametro",
    "diametro_cm",
    "diameter",
    "diameter_m",
    "diam_m",
    "trunk_diameter",
)
CIRCUMFERENCE_KEYS = (
    "circumference",
    "circumference_cm",
    "circonf",
    "circonf_cm",
    "circonferenza",
    "circonferenza_cm",
)
PLACEHOLDERS = ("-", "--", "unknown", "sconosciuto", "non noto", "n/a")
SPECIES_PLACEHOLDERS = (*PLACEHOLDERS, "da riconoscere")

# Java's parser would also take "1d" or "0x1p3", which are not numbers here.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def to_number(text: Column) -> Column:
    clean = strip(text)
    return F.when(clean.rlike(NUMBER), clean.try_cast("double"))


def _remove(text: Column, *words: str) -> Column:
    return reduce(lambda acc, w: F.replace(acc, F.lit(w), F.lit("")), words, text)


def tag(tags: Column, key: str) -> Column:
    return F.try_element_at(tags, F.lit(key))


def building_base_height(tags: Column, roof_default_m: float = 2.0) -> Column:
    """Clearance below roof-only buildings; zero for ordinary ones."""
    raw = to_number(tag(tags, "min_height"))
    return F.when(F.coalesce(tag(tags, "building") != "roof", F.lit(True)), F.lit(0.0)).otherwise(
        F.when(raw >= 0.0, raw).otherwise(F.lit(float(roof_default_m)))
    )


def normalized_key(key: Column) -> Column:
    return F.regexp_replace(F.lower(strip(key)), r"[ -]", "_")


def normalized_attributes(attributes: Column) -> Column:
    """Map with normalized keys; the last of several colliding keys wins."""
    entries = F.transform(
        F.map_entries(attributes), lambda e: F.struct(normalized_key(e["key"]).alias("key"), e["value"].alias("value"))
    )
    last = lambda es: F.filter(
        es, lambda e, i: ~F.exists(F.slice(es, i + 2, F.size(es)), lambda later: later["key"] == e["key"])
    )
    return F.map_from_entries(let(entries, last))


def first_attribute(attributes: Column, keys: tuple[str, ...]) -> Column:
    """First value over the synonyms that is neither blank nor a placeholder."""

    def usable(value: Column) -> Column:
        text = strip(value)
        return F.when((text != "") & ~F.lower(text).isin(*PLACEHOLDERS), value)

    return F.coalesce(*[usable(F.try_element_at(attributes, F.lit(k))) for k in keys])


def inventory_number(value: Column) -> Column:
    """Number with centimetre or metre words and comma decimals, e.g. ``45,5 cm``."""
    text = _remove(F.lower(strip(value)), "cm", "centimetri", "centimeters", "metres", "meters", "meter", "m")
    return to_number(F.replace(text, F.lit(","), F.lit(".")))


def dbh_to_diameter_m(value: Column) -> Column:
    return let(inventory_number(value), lambda n: F.when(n > 2.0, n / 100.0).when(n > 0.0, n))


def circumference_to_m(value: Column) -> Column:
    return let(inventory_number(value), lambda n: F.when(n > 10.0, n / 100.0).when(n > 0.0, n))


def tree_tags(attributes: Column) -> Column:
    """Tree tags from free inventory attributes (text map)."""

    def build(attrs: Column) -> Column:
        found = F.struct(
            first_attribute(attrs, SPECIES_KEYS).alias("species"),
            first_attribute(attrs, ("genus",)).alias("genus"),
            first_attribute(attrs, DBH_KEYS).alias("dbh"),
            first_attribute(attrs, CIRCUMFERENCE_KEYS).alias("circumference"),
        )
        return let(found, tags)

    def tags(f: Column) -> Column:
        entries = {
            "natural": F.lit("tree"),
            "species": f["species"],
            "genus": f["genus"],
            "dbh": f["dbh"],
            "diameter": F.round(dbh_to_diameter_m(f["dbh"]), 4).cast("string"),
            "source_circumference": f["circumference"],
            "circumference": F.round(circumference_to_m(f["circumference"]), 4).cast("string"),
        }
        pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in entries.items()])
        return F.map_from_entries(F.filter(pairs, lambda e: e["value"].isNotNull()))

    return let(normalized_attributes(attributes), build)


def tree_number(value: Column) -> Column:
    """Tree tag number: metre words only, no comma or centimetre handling."""
    return to_number(_remove(F.lower(value), "metres", "meters", "meter", "m"))


def building_number(value: Column) -> Column:
    """Building tag number: only the letter ``m`` is removed."""
    return to_number(_remove(F.lower(value), "m"))


def first_tree_number(tags: Column, keys: tuple[str, ...]) -> Column:
    """Struct ``(key, value)`` of the first parsable tag, or null."""
    keyed = lambda k: let(
        tree_number(tag(tags, k)), lambda n: F.when(n.isNotNull(), F.struct(F.lit(k).alias("key"), n.alias("value")))
    )
    return F.coalesce(*[keyed(k) for k in keys])


def source_species(tags: Column) -> Column:
    """Struct ``(key, value)`` of the first non-blank species-like tag."""
    return F.coalesce(
        *[
            F.when(strip(tag(tags, k)) != "", F.struct(F.lit(k).alias("key"), strip(tag(tags, k)).alias("value")))
            for k in ("species", "genus", "taxon", "name")
        ]
    )


def normalized_species(name: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(F.lower(name), "[\"']", " "), r"\s+", " "))


def slug(text: Column, fallback: str = "unknown_species") -> Column:
    joined = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(joined, "^_+|_+$", ""), F.lit("")), F.lit(fallback))


# --- tree dimensions with provenance -----------------------------------------------


def sourced(value: Column, source: Column) -> Column:
    return F.struct(value.cast("double").alias("value"), source.alias("source"))


def tree_height(tags: Column, model: Column) -> Column:
    """Tagged height, else allometry from the circumference, else the model default."""

    def choose(found: Column) -> Column:
        tagged, circ = found["tagged"], found["circumference"]
        allometric = F.greatest(
            F.lit(4.0), F.least(model["default_height_m"], 6.0 + 2.2 * F.sqrt(F.greatest(circ, F.lit(0.0))))
        )
        return (
            F.when(
                tagged["value"] > 1.5,
                sourced(F.least(tagged["value"], F.lit(35.0)), F.concat(F.lit("tag:"), tagged["key"])),
            )
            .when(circ > 0.0, sourced(allometric, F.lit("allometry:circumference")))
            .otherwise(
                sourced(model["default_height_m"], F.concat(F.lit("default:"), model["name"], F.lit(".height_m")))
            )
        )

    return let(_found(tags, ("height", "tree:height")), choose)


def _found(tags: Column, keys: tuple[str, ...]) -> Column:
    return F.struct(
        first_tree_number(tags, keys).alias("tagged"),
        first_tree_number(tags, ("circumference",))["value"].alias("circumference"),
    )


def crown_radius(tags: Column, model: Column, height: Column) -> Column:
    def choose(tagged: Column) -> Column:
        return F.when(
            tagged["value"] > 0.5,
            sourced(F.least(tagged["value"] / 2.0, height * 0.48), F.concat(F.lit("tag:"), tagged["key"])),
        ).otherwise(
            sourced(
                F.least(model["default_crown_radius_m"], height * 0.42),
                F.concat(F.lit("default:"), model["name"], F.lit(".crown_radius_m")),
            )
        )

    return let(first_tree_number(tags, ("crown:diameter", "diameter_crown")), choose)


def trunk_radius(tags: Column, model: Column, height: Column) -> Column:
    def choose(found: Column) -> Column:
        tagged, circ = found["tagged"], found["circumference"]
        return (
            F.when(tagged["value"] > 0.05, sourced(tagged["value"] / 2.0, F.concat(F.lit("tag:"), tagged["key"])))
            .when(circ > 0.1, sourced(circ / (2.0 * math.pi), F.lit("allometry:circumference")))
            .otherwise(
                sourced(
                    F.least(model["default_trunk_radius_m"], height * 0.035),
                    F.concat(F.lit("default:"), model["name"], F.lit(".trunk_radius_m")),
                )
            )
        )

    return let(_found(tags, ("diameter", "trunk:diameter")), choose)


def trunk_height(height: Column, base_fraction: Column) -> Column:
    return F.greatest(F.lit(1.8), F.least(height * base_fraction, height - 1.0))


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def planned_or(value: Column, field: str, fallback: Column, halve: bool = False) -> Column:
    """A planned dimension wins over the fallback; diameters are halved to radii."""
    used = value / 2.0 if halve else value
    return F.when(value.isNotNull(), sourced(used, F.lit(f"urban_planning:{field}"))).otherwise(fallback)


def target_dimension(value: Column, field: str, native: Column, model_name: Column) -> Column:
    return F.when(value.isNotNull(), sourced(value, F.lit(f"attribute:{field}"))).otherwise(
        sourced(native, F.concat(F.lit("default:"), model_name))
    )


def building_height(height_props: list[Column], tags: Column, default_m: float = 9.0) -> Column:
    """Height attribute, then height tags, then storeys of three metres, then the default."""
    props = [F.when(p > 0.0, p) for p in height_props]
    text = F.coalesce(F.nullif(tag(tags, "height"), F.lit("")), tag(tags, "building:height"))
    return F.coalesce(
        *props,
        building_number(text),
        building_number(tag(tags, "building:levels")) * 3.0,
        F.lit(float(default_m)),
    )


def has_roof_shape(roof_shape: Column, tags: Column) -> Column:
    return F.coalesce(roof_shape != "", F.lit(False)) | tag(tags, "roof:shape").isNotNull()


# --- segmentation review -----------------------------------------------------------

# Segmentation vocabulary by meaning.
SEMANTIC_CLASSES = {
    "building": ("building", "buildings", "building_footprint", "roof", "rooftop"),
    "road": ("road", "roads", "street", "highway", "asphalt", "carriageway"),
    "paved": (
        "paved",
        "pavement",
        "paving",
        "paving_stones",
        "concrete",
        "parking",
        "sidewalk",
        "square",
        "impervious",
    ),
    "green": ("vegetation", "green", "grass", "tree_canopy", "park", "garden"),
    "water": ("water", "river", "canal", "pond"),
    "terrain": ("bare_soil", "soil", "ground", "terrain", "other_terrain", "unknown_terrain"),
}
MATCH_CATEGORIES = {
    "buildings": ("buildings",),
    "roads_paved_concrete": ("roads", "concrete", "gap_fill", "other_terrain"),
    "terrain": ("green_areas", "water", "concrete", "other_terrain", "gap_fill"),
}


def semantic_class(*candidates: Column) -> Column:
    named = F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])
    return F.coalesce(F.regexp_replace(F.lower(named), "[ -]", "_"), F.lit("unknown"))


def target_group(cls: Column) -> Column:
    k = SEMANTIC_CLASSES
    return (
        F.when(cls.isin(*k["building"]), F.lit("buildings"))
        .when(cls.isin(*k["road"], *k["paved"]), F.lit("roads_paved_concrete"))
        .when(cls.isin(*k["green"], *k["water"], *k["terrain"]), F.lit("terrain"))
    )


def suggested_category(cls: Column, group: Column) -> Column:
    k = SEMANTIC_CLASSES
    return (
        F.when(group == "buildings", F.lit("buildings"))
        .when(cls.isin(*k["road"]), F.lit("roads"))
        .when(cls.isin(*k["paved"]), F.lit("concrete"))
        .when(cls.isin(*k["green"]), F.lit("green_areas"))
        .when(cls.isin(*k["water"]), F.lit("water"))
        .otherwise(F.lit("other_terrain"))
    )


def suggested_tag(cls: Column, category: Column) -> Column:
    return (
        F.when(category == "buildings", F.lit("building=segmentation_candidate"))
        .when(cls == "asphalt", F.lit("surface=asphalt"))
        .when(category == "roads", F.lit("highway=segmentation_candidate"))
        .when(cls == "concrete", F.lit("surface=concrete"))
        .when(category == "concrete", F.lit("surface=paved"))
        .when(category == "green_areas", F.lit("landcover=vegetation"))
        .when(category == "water", F.lit("natural=water"))
        .otherwise(F.concat(F.lit("landcover="), cls))
    )


def proposed_action(group: Column, matched_category: Column, category: Column) -> Column:
    """Review action; ``matched_category`` is null when nothing overlaps."""
    matched = matched_category.isNotNull()
    return (
        F.when((group == "buildings") & matched, F.lit("refine_existing_footprint_for_lod22"))
        .when(group == "buildings", F.lit("add_missing_building_candidate"))
        .when(matched_category == "gap_fill", F.concat(F.lit("replace_gap_fill_with_"), category))
        .when(matched_category == "other_terrain", F.concat(F.lit("retag_weak_terrain_as_"), category))
        .otherwise(F.concat(F.lit("add_or_refine_"), category, F.lit("_surface")))
    )


def match_categories(group: Column) -> Column:
    out = F.lit(None).cast("array<string>")
    for name, categories in MATCH_CATEGORIES.items():
        out = F.when(group == name, F.array(*[F.lit(c) for c in categories])).otherwise(out)
    return out


def confidence(value: Column) -> Column:
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)), 4)


def source_image(candidates: list[Column], fallback: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], fallback, F.lit("unknown"))


def feature_id(osm_type: Column, osm_id: Column, candidate_id: Column | None = None) -> Column:
    ids = [osm_id] if candidate_id is None else [osm_id, candidate_id]
    return F.concat(
        F.coalesce(osm_type, F.lit("feature")), F.lit(":"), F.coalesce(*ids, F.lit("unknown"))
    )
