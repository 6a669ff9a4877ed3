"""Planning points: normalization with an error list instead of a failing run, zoning and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import attributes as A
from geoloom.functions import crs as C
from geoloom.functions import measure as M
from geoloom.params import Region

# Identifiers and modelling properties by kind.
SAFE_ID = r"^[A-Za-z0-9][A-Za-z0-9._-]*$"
KINDS = ("tree", "air_purifier")
DIMENSIONS = {
    "tree": ("height_m", "crown_diameter_m", "trunk_diameter_m"),
    "air_purifier": ("height_m", "width_m", "depth_m", "rotation_deg"),
}
ALL_DIMENSIONS = tuple(sorted({d for ds in DIMENSIONS.values() for d in ds}))
MODELLING = ("id", "kind", "model", *ALL_DIMENSIONS)


def _numeric_json(text: Column) -> Column:
    """Number of a raw JSON value; text, booleans and null give null."""
    return F.when(text.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"), text.try_cast("double"))


def _folded(properties: Column) -> Column:
    """``m`` (first value per lower-case key) and ``given`` (number of entries) of one property map."""

    def by_key(entries: Column) -> Column:
        folded = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
        return M.let(folded, lambda es: F.struct(_first_by_key(es).alias("m"), F.size(es).alias("given")))

    return M.let(F.map_entries(properties), by_key)


def _parsed(m: Column, given: Column) -> Column:
    """Typed fields and structural flags of one folded property map."""
    raw = lambda name: F.try_element_at(m, F.lit(name))
    quoted = lambda name: F.when(
        raw(name).startswith('"'), A.strip(F.regexp_replace(raw(name), '^"|"$', ""))
    )
    return F.struct(
        F.map_keys(m).alias("keys"),
        (F.size(m) != given).alias("repeated"),
        *[quoted(name).alias(name) for name in ("id", "kind", "model")],
        *[_numeric_json(raw(name)).alias(name) for name in ALL_DIMENSIONS],
    )


def _staged(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``df`` plus a column that is computed once per row, however often it is used (generated rows are not inlined)."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _first_by_key(entries: Column) -> Column:
    """Map of the first entry per key."""
    keys = lambda es: F.transform(es, lambda e: e["key"])
    return M.let(
        keys(entries),
        lambda ks: F.map_from_entries(
            F.filter(entries, lambda e, i: F.array_position(ks, e["key"]) == (i + 1).cast("bigint"))
        ),
    )


def _problems(p: Column) -> Column:
    """Messages about one parsed property map."""
    has = lambda name: F.array_contains(p["keys"], name)
    missing = lambda name: F.coalesce(p[name] == "", F.lit(True))
    checks: list[tuple[str, Column]] = [
        ("duplicate property name", p["repeated"]),
        ("missing id", missing("id")),
        ("unsafe id", ~missing("id") & ~p["id"].rlike(SAFE_ID)),
        ("missing kind", missing("kind")),
        ("unknown kind", ~missing("kind") & ~p["kind"].isin(*KINDS)),
        ("missing model", missing("model")),
        (
            "unknown modelling property",
            F.exists(p["keys"], lambda k: ~k.isin(*MODELLING) & (k.endswith("_m") | k.startswith("rotation"))),
        ),
    ]
    for kind, allowed in DIMENSIONS.items():
        of_kind = p["kind"] == kind
        for name in ALL_DIMENSIONS:
            if name in allowed:
                bad = p[name].isNull() | (F.lit(name != "rotation_deg") & (p[name] <= 0.0))
                checks.append((f"{name} must be a valid number", of_kind & has(name) & bad))
            else:
                checks.append((f"{name} is not allowed for {kind}", of_kind & has(name)))
    return F.array_distinct(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(m)) for m, c in checks])))


def normalize(points: DataFrame, region: Region, model_names: DataFrame | None = None) -> DataFrame:
    """Planning features with typed columns, zone and ``errors`` (empty = accepted).

    Input: ``input_name, source, source_crs, source_feature_index, geom_type,
    x, y`` and ``properties`` as ``map<string, string>`` of raw JSON values
    (text values keep their quotes). ``model_names`` has ``kind, model``.
    """
    mercator_x, mercator_y = C.inverse_web_mercator(F.col("x"), F.col("y"))
    web = F.col("source_crs") == "EPSG:3857"
    folded = _staged(points, _folded(F.col("properties")), "_f")
    parsed = _staged(folded, _parsed(F.col("_f.m"), F.col("_f.given")), "_n").drop("_f")
    df = parsed.withColumns(
        {
            "_problems": _problems(F.col("_n")),
            "lon": F.when(web, mercator_x).when(F.col("x").between(-180.0, 180.0), F.col("x")),
            "lat": F.when(web, mercator_y).when(F.col("y").between(-90.0, 90.0), F.col("y")),
        }
    )
    fields = ("id", "kind", "model", *ALL_DIMENSIONS)
    df = df.withColumns({name: F.col(f"_n.{name}") for name in fields}).drop("_n")
    if model_names is not None:
        known = model_names.select("kind", "model").distinct().withColumn("_known", F.lit(True))
        df = df.join(known, ["kind", "model"], "left")
    else:
        df = df.withColumn("_known", F.lit(True))
    others = F.array(
        F.when(
            F.col("kind").isin(*KINDS) & (F.col("model") != "") & F.col("_known").isNull(), F.lit("unknown model")
        ),
        F.when(F.coalesce(F.col("geom_type") != "Point", F.lit(True)), F.lit("geometry is not a point")),
        F.when(F.col("lon").isNull() | F.col("lat").isNull(), F.lit("invalid coordinates")),
    )
    distance = M.distance_to_center_m(F.col("lon"), F.col("lat"), region)
    extra = F.map_filter("properties", lambda k, v: ~F.lower(k).isin(*MODELLING))
    return (
        df.withColumns(
            {
                "errors": F.concat("_problems", F.array_compact(others)),
                "_d": distance,
                "source_properties": F.to_json(extra),
            }
        )
        .withColumns(
            {
                "roi_zone": M.roi_zone(F.col("_d"), region, outside="outside"),
                "roi_distance_m": F.round("_d", 3),
                "contributes_to_geometry": F.lit(False),
                "urban_planning_input_id": F.col("input_name"),
            }
        )
        .drop("_problems", "_known", "_d", "properties", "input_name")
    )


def accepted(normalized: DataFrame) -> DataFrame:
    return normalized.where((F.size("errors") == 0) & (F.col("roi_zone") != "outside"))


def route(features: DataFrame) -> DataFrame:
    """Accepted planning points as tree or purifier reference features."""
    tree = F.col("kind") == "tree"
    return features.withColumns(
        {
            "osm_type": F.lit("urban_planning"),
            "osm_id": F.col("id"),
            "category": F.when(tree, "trees").otherwise("air_purifiers"),
            "group_tag": F.when(tree, "tree").otherwise("air_purifier"),
            "source_tag": F.concat(F.lit("urban_planning="), "urban_planning_input_id"),
            "source_type": F.lit("urban_planning"),
            "geom_type": F.lit("Point"),
            "parts": M.point_parts(F.col("lon"), F.col("lat")),
            "geometry_role": F.when(tree, "tree_reference_point").otherwise("air_purifier_reference_point"),
            "reconstruction_scope": M.reconstruction_scope(F.col("roi_zone")),
            "include_in_lod22": F.lit(False),
            "centroid_distance_m": F.col("roi_distance_m"),
            "direct_model_category": F.when(tree, F.col("model")),
            "purifier_id": F.when(~tree, F.col("id")),
            "tags": F.when(tree, F.create_map().cast("map<string,string>")),
        }
    )
