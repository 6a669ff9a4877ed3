"""JSON and GeoJSON readers: map extracts, feature collections, catalogues, dimensions.

Extracts and collections are read entry by entry from byte ranges (``jsonarray``),
so one large file is the work of many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions import attributes as A
from geoloom.functions import crs as C
from geoloom.functions import measure as M
from geoloom.schemas import ELEMENT, PARTS_DDL
from geoloom.sources.jsonarray import array_entries, array_files, array_parts
from geoloom.sources.ranges import SPLIT

_STRUCT = T.StructType
_FEATURE = _STRUCT(
    [
        T.StructField("type", T.StringType()),
        T.StructField(
            "geometry",
            _STRUCT([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]),
        ),
        T.StructField("properties", T.StringType()),
    ]
)


def read_elements(spark: SparkSession, path, *, split: int = SPLIT) -> DataFrame:
    """Elements of cached map extracts with ``source``, ``pos`` and ``seq``.

    Entries that are no objects come back with all fields null, which the
    acceptance check turns into ``invalid_element`` rows. Batches are numbered
    by file name, so the numbering does not depend on scan order or ``split``.
    """
    parts = array_parts(spark, path, "elements", split=split)
    rows = array_entries(parts).withColumn("e", F.from_json("text", ELEMENT))
    # A file's first number is a sum over the files before it: one row for each file.
    counts = array_files(parts).where("sound and found").select("source", "entries")
    before = Window.orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("source", F.coalesce(F.sum("entries").over(before), F.lit(0)).alias("first"))
    numbered = rows.join(first, "source")
    seq = (F.col("first") + F.col("pos") + 1).alias("seq")
    return numbered.select("source", F.col("pos").cast("int").alias("pos"), "e.*", seq, F.col("source").alias("batch"))


def broken_extracts(spark: SparkSession, path, *, split: int = SPLIT) -> DataFrame:
    """Files without an ``elements`` list, and those whose brackets or strings do not close."""
    return array_files(array_parts(spark, path, "elements", split=split)).where("not (found and sound)").select("source")


def coordinates_to_parts(kind: Column, raw: Column) -> Column:
    """GeoJSON coordinate text to ``parts``, by geometry type."""
    pair = "array<double>"
    vertex = lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))
    ring = lambda r: F.transform(r, vertex)
    polygon = lambda p: F.transform(p, ring)
    parse = lambda depth: F.from_json(raw, "array<" * depth + pair + ">" * depth)
    point = F.array(F.array(F.array(vertex(F.from_json(raw, pair)))))
    return (
        F.when(kind == "Point", point)
        .when(kind.isin("LineString", "MultiPoint"), F.array(F.array(ring(parse(1)))))
        .when(kind == "Polygon", F.array(polygon(parse(2))))
        .when(kind == "MultiPolygon", F.transform(parse(3), polygon))
        .cast(PARTS_DDL)
    )


def read_features(spark: SparkSession, path, *, strict: bool = False, lines: bool = False, split: int = SPLIT) -> DataFrame:
    """Features of GeoJSON collections: ``source, feature_index, geom_type, parts, properties`` (JSON text).

    Features without geometry are dropped. ``strict`` keeps only files that
    declare themselves a FeatureCollection (see :func:`broken_collections`).
    ``lines`` reads files of one feature per line; their features have no number.
    """
    rows = _features(spark, path, strict=strict, split=split) if not lines else _feature_lines(spark, path)
    kind = F.col("f.geometry.type")
    return rows.where(F.col("f.geometry").isNotNull() & kind.isNotNull()).select(
        "source",
        "feature_index",
        kind.alias("geom_type"),
        coordinates_to_parts(kind, F.col("f.geometry.coordinates")).alias("parts"),
        F.col("f.properties").alias("properties"),
    )


def _features(spark: SparkSession, path, *, strict: bool = False, split: int = SPLIT) -> DataFrame:
    """``source, feature_index, f`` of every entry of the ``features`` lists."""
    parts = array_parts(spark, path, "features", split=split)
    if strict:
        parts = parts.where("type = 'FeatureCollection'")
    return array_entries(parts).select("source", F.col("pos").alias("feature_index"), F.from_json("text", _FEATURE).alias("f"))


def _feature_lines(spark: SparkSession, path) -> DataFrame:
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("source"), F.from_json("value", _FEATURE).alias("f"))
    return lines.select("source", F.lit(None).cast("bigint").alias("feature_index"), "f")


def broken_collections(spark: SparkSession, path, *, split: int = SPLIT) -> DataFrame:
    """Files that are no FeatureCollection or lack a feature list, and empty ones."""
    return array_files(array_parts(spark, path, "features", split=split)).select(
        "source",
        F.when(~(F.col("found") & F.col("sound")), F.lit("missing features list"))
        .when(F.coalesce(F.col("type") != "FeatureCollection", F.lit(True)), F.lit("not a FeatureCollection"))
        .when(F.col("entries") == 0, F.lit("no features"))
        .alias("error"),
    ).where("error is not null")


def prop(name: str, kind: str = "string", column: str = "properties") -> Column:
    """One property of the JSON text column."""
    value = F.get_json_object(column, f"$['{name}']")
    return value if kind == "string" else value.try_cast(kind)


def tags_of(column: str = "properties") -> Column:
    return F.from_json(F.get_json_object(column, "$.tags"), "map<string,string>")


def read_footprints(spark: SparkSession, path) -> DataFrame:
    """Polygonal features whose contribution and level-of-detail flags are true or absent."""
    df = read_features(spark, path)
    flag = lambda n: F.coalesce(prop(n, "boolean"), F.lit(True))
    return df.where(
        M.contributes(F.col("geom_type"))
        & flag("contributes_to_geometry")
        & flag("include_in_building_lod22_reconstruction")
    ).withColumn("tags", tags_of())


def read_polygons(spark: SparkSession, path) -> DataFrame:
    return read_features(spark, path).where(M.contributes(F.col("geom_type")))


def read_masks(spark: SparkSession, path, *, external_buildings: bool = False) -> DataFrame:
    """Segmentation masks; external building polygons get default class, backend and image."""
    df = read_features(spark, path, strict=True).where(M.contributes(F.col("geom_type")))
    named = F.coalesce(
        *[F.nullif(prop(n), F.lit("")) for n in ("segmentation_class", "semantic_class", "class", "label", "category")]
    )
    backend = F.coalesce(F.nullif(prop("backend"), F.lit("")), F.nullif(prop("model"), F.lit("")))
    image = F.coalesce(*[F.nullif(prop(n), F.lit("")) for n in ("source_image", "image_path", "imagery_source")])
    if external_buildings:
        named = F.coalesce(F.nullif(prop("segmentation_class"), F.lit("")), F.lit("building_footprint"))
        backend = F.coalesce(backend, F.lit("external building reconstruction"))
        image = F.coalesce(image, F.lit("external orthophoto"))
    # A confidence given as text or boolean is no number.
    score = F.coalesce(F.get_json_object("properties", "$.confidence"), F.get_json_object("properties", "$.score"))
    return df.select(
        "source",
        F.col("feature_index").alias("seq"),
        "geom_type",
        "parts",
        named.alias("raw_class"),
        backend.alias("backend"),
        image.alias("source_image"),
        A.to_number(score).alias("confidence"),
    )


def read_tree_tag_points(spark: SparkSession, path) -> DataFrame:
    """Projected positions of ``natural=tree`` points."""
    df = read_features(spark, path).where("geom_type = 'Point'").withColumn("tags", tags_of())
    v = F.get(F.get(F.get("parts", F.lit(0)), F.lit(0)), F.lit(0))
    located = df.where(A.tag(F.col("tags"), "natural") == "tree").select(v["x"].alias("lon"), v["y"].alias("lat"))
    lon, lat = F.col("lon"), F.col("lat")
    return located.select(C.utm32_x(lon, lat).alias("tag_x"), C.utm32_y(lon, lat).alias("tag_y"))


def read_planning_points(spark: SparkSession, inputs: DataFrame, paths: list[str]) -> DataFrame:
    """Planning points of the enabled inputs in the shape :func:`geoloom.operators.planning.normalize` takes.

    ``inputs``: ``name, file_name, crs, enabled``; ``paths`` are the files of
    the enabled inputs (disabled files are never opened).
    """
    rows = _features(spark, paths).withColumnRenamed("feature_index", "source_feature_index")
    dimension = inputs.where("enabled").select(
        "file_name", F.col("name").alias("input_name"), F.col("crs").alias("source_crs")
    )
    xy = F.from_json(F.col("f.geometry.coordinates"), "array<double>")
    exact = F.when((F.col("f.geometry.type") == "Point") & (F.size(xy) == 2), xy)
    return (
        rows.withColumn("file_name", F.element_at(F.split("source", "/"), -1))
        .join(dimension, "file_name")
        .select(
            "input_name",
            "source",
            "source_crs",
            F.col("source_feature_index").cast("bigint").alias("source_feature_index"),
            F.col("f.geometry.type").alias("geom_type"),
            F.get(exact, F.lit(0)).alias("x"),
            F.get(exact, F.lit(1)).alias("y"),
            raw_properties(F.col("f.properties")).alias("properties"),
        )
    )


def raw_properties(text: Column) -> Column:
    """JSON object text to a map of raw JSON values (text keeps its quotes)."""
    keys = F.json_object_keys(text)
    value = F.from_json(text, "map<string,string>")
    # get_json_object strips quotes; they are restored for values that the object text shows as strings.
    pattern = lambda k: F.concat(F.lit('"'), k, F.lit('"\\s*:\\s*"'))
    entry = lambda k: F.struct(
        k.alias("key"),
        F.when(F.regexp_like(text, pattern(k)), F.concat(F.lit('"'), F.try_element_at(value, k), F.lit('"')))
        .otherwise(F.try_element_at(value, k))
        .alias("value"),
    )
    return F.map_from_entries(F.transform(F.array_distinct(keys), entry))


# --- dimensions -------------------------------------------------------------------------------


def _json_files(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Small catalogue files, one row each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


_TREE_MODEL = _STRUCT(
    [
        T.StructField("name", T.StringType()),
        T.StructField("aliases", T.ArrayType(T.StringType())),
        T.StructField("default_height_m", T.DoubleType()),
        T.StructField("default_crown_radius_m", T.DoubleType()),
        T.StructField("default_trunk_radius_m", T.DoubleType()),
        T.StructField("crown_base_fraction", T.DoubleType()),
        T.StructField("crown_shape", T.StringType()),
    ]
)


def read_tree_models(spark: SparkSession, path) -> DataFrame:
    """Tree model library with ``error`` for unusable entries; aliases are lower-cased and unique."""
    files = _json_files(spark, path, _STRUCT([T.StructField("models", T.ArrayType(_TREE_MODEL))]))
    rows = files.select(F.posexplode("models").alias("model_no", "m")).select("model_no", "m.*")
    sizes = ("default_height_m", "default_crown_radius_m", "default_trunk_radius_m", "crown_base_fraction")
    error = F.when(F.coalesce(F.col("name") == "", F.lit(True)), F.lit("missing name"))
    error = error.when(F.exists(F.coalesce("aliases", F.array()), lambda a: F.coalesce(a == "", F.lit(True))), F.lit("empty alias"))
    for name in sizes:
        error = error.when(F.coalesce(F.col(name) <= 0.0, F.lit(True)), F.lit(f"invalid {name}"))
    error = error.when(F.col("crown_base_fraction") >= 1.0, F.lit("crown_base_fraction must be below one"))
    lowered = F.array_distinct(
        F.concat(F.array(F.lower("name")), F.transform(F.coalesce("aliases", F.array()), lambda a: F.lower(a)))
    )
    return rows.withColumns(
        {
            "aliases": lowered,
            "crown_shape": F.coalesce(F.nullif(F.col("crown_shape"), F.lit("")), F.lit("ellipsoid")),
            "error": error,
        }
    )


def read_species_map(spark: SparkSession, path) -> DataFrame:
    """Species to category rows (``entry_no, species, category``) in file order."""
    schema = _STRUCT([T.StructField("species_to_category", T.MapType(T.StringType(), T.StringType()))])
    files = _json_files(spark, path, schema)
    return files.select(F.posexplode("species_to_category").alias("entry_no", "species", "category")).where(
        F.coalesce(F.col("category") != "", F.lit(False))
    )


_PURIFIER = _STRUCT(
    [T.StructField(c, T.StringType()) for c in ("name", "kind", "output_path")]
    + [
        T.StructField(c, T.DoubleType())
        for c in ("height_m", "base_width_m", "width_m", "depth_m", "linear_tolerance_m")
    ]
)


def read_purifier_catalogue(spark: SparkSession, path) -> DataFrame:
    """Raw catalogue rows of version 1 files (see ``purifiers.catalogue_dimension``)."""
    schema = _STRUCT([T.StructField("schema_version", T.IntegerType()), T.StructField("models", T.ArrayType(_PURIFIER))])
    files = _json_files(spark, path, schema)
    return files.where("schema_version = 1").select(F.explode("models").alias("m")).select("m.*")


def read_model_names(spark: SparkSession, path, kind: str) -> DataFrame:
    """Allowed model names of one kind of planning point: ``kind, model``."""
    schema = _STRUCT([T.StructField("models", T.ArrayType(_STRUCT([T.StructField("name", T.StringType())])))])
    names = _json_files(spark, path, schema).select(F.explode("models").alias("m"))
    return names.select(F.lit(kind).alias("kind"), A.strip(F.col("m.name")).alias("model")).where("model <> ''")
