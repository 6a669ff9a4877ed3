"""Tree instances: model resolution, dimensions with provenance, meshes and summaries."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom import params as P
from geoloom.functions import attributes as A
from geoloom.functions import crs as C
from geoloom.operators.quality import source_prefix_counts


def model_names(models: DataFrame) -> DataFrame:
    """Lookup rows ``(norm, name)``: every model answers to its name and aliases, the first model wins.

    ``models``: ``model_no, name, aliases, ...``.
    """
    names = models.select(
        "model_no", "name", F.explode(F.array_union(F.array("name"), F.coalesce("aliases", F.array()))).alias("alias")
    )
    return names.groupBy(A.normalized_species(F.col("alias")).alias("norm")).agg(
        F.min_by("name", "model_no").alias("name")
    )


def species_dimension(species_map: DataFrame) -> DataFrame:
    """``(species, category)`` rows to normalized unique species; placeholders dropped, the last entry wins."""
    norm = A.normalized_species(F.col("species"))
    return (
        species_map.withColumn("norm", norm)
        .where((F.col("norm") != "") & ~F.col("norm").isin(*A.SPECIES_PLACEHOLDERS))
        .groupBy("norm")
        .agg(F.max_by("category", "entry_no").alias("category"))
    )


def resolve_models(
    trees: DataFrame, models: DataFrame, species_map: DataFrame, default_species: str
) -> DataFrame:
    """Trees with ``species, source_species, model, model_source, model_error``.

    ``trees`` need ``tags`` and may carry ``direct_model_category``. The two
    dimension joins carry no hint: their size decides the strategy at run time.
    """
    if "direct_model_category" not in trees.columns:
        trees = trees.withColumn("direct_model_category", F.lit(None).cast("string"))
    source = A.source_species(F.col("tags"))
    direct = F.col("direct_model_category")
    df = trees.withColumn("_src", F.when(direct.isNull(), source)).withColumns(
        {
            "source_species": F.col("_src.value"),
            "species": F.coalesce(direct, F.col("_src.value"), F.lit(default_species)),
        }
    )
    categories = species_dimension(species_map).withColumnRenamed("norm", "_species_norm")
    df = df.withColumn("_species_norm", A.normalized_species(F.col("species"))).join(categories.withColumnRenamed("category", "_category"), "_species_norm", "left")
    names = model_names(models).select(F.col("norm").alias("_norm"), F.col("name").alias("_name"))
    details = models.select(
        F.col("name").alias("_name"),
        F.struct(
            "name",
            "default_height_m",
            "default_crown_radius_m",
            "default_trunk_radius_m",
            "crown_base_fraction",
            "crown_shape",
        ).alias("model"),
    )
    dimension = names.join(details, "_name")
    df = df.withColumn("_norm", A.normalized_species(F.coalesce(direct, F.col("_category")))).join(
        dimension, "_norm", "left"
    )
    return df.withColumns(
        {
            "model_source": F.when(direct.isNotNull(), F.lit("urban_planning:model"))
            .when(
                F.col("_src").isNotNull(),
                F.concat(F.lit("tag:"), F.col("_src.key"), F.lit(":species_category_mapping")),
            )
            .otherwise(F.lit(f"default:{default_species}:species_category_mapping")),
            "model_error": F.when(direct.isNotNull() & F.col("model").isNull(), F.lit("planned model is unavailable"))
            .when(direct.isNull() & F.col("_category").isNull(), F.lit("species is not mapped"))
            .when(F.col("model").isNull(), F.lit("species maps to an unavailable model")),
        }
    ).drop("_src", "_species_norm", "_category", "_norm", "_name")


def tree_instances(
    trees: DataFrame,
    models: DataFrame,
    species_map: DataFrame,
    *,
    default_species: str = "Tilia",
    terrain_z: Column | None = None,
) -> DataFrame:
    """Resolved instances with one provenance column per dimension.

    ``trees``: ``seq, position, lon, lat, tags, roi_zone, osm_id`` and optional
    planned columns. ``position`` is the scan position (skipped rows count), see
    :func:`geoloom.operators.ordering.ordinal`. Rows with ``model_error`` or
    ``dimension_error`` are the reject table.
    """
    df = resolve_models(trees, models, species_map, default_species)
    for name in ("height_m", "crown_diameter_m", "trunk_diameter_m"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("double"))
        df = df.withColumnRenamed(name, f"planned_{name}")
    if "id" not in df.columns:
        df = df.withColumn("id", F.lit(None).cast("string"))
    direct = F.col("direct_model_category").isNotNull()
    planned = lambda name: F.when(direct, F.col(f"planned_{name}"))
    tags, model = F.col("tags"), F.col("model")
    bad = [
        F.when(direct & (F.isnan(f"planned_{n}") | (F.col(f"planned_{n}") <= 0.0)), F.lit(f"{n} must be a finite positive number"))
        for n in ("height_m", "crown_diameter_m", "trunk_diameter_m")
    ]
    df = df.withColumn("_h", A.planned_or(planned("height_m"), "height_m", A.tree_height(tags, model)))
    h = F.col("_h.value")
    df = df.withColumns(
        {
            "_c": A.planned_or(planned("crown_diameter_m"), "crown_diameter_m", A.crown_radius(tags, model, h), halve=True),
            "_t": A.planned_or(planned("trunk_diameter_m"), "trunk_diameter_m", A.trunk_radius(tags, model, h), halve=True),
            "dimension_error": F.coalesce(*bad),
        }
    )
    z = F.lit(0.0) if terrain_z is None else terrain_z - P.TERRAIN_CLEARANCE_M
    number = F.when(F.length(F.col("position").cast("string")) >= 4, F.col("position").cast("string")).otherwise(
        F.lpad(F.col("position").cast("string"), 4, "0")
    )
    out = df.select(
        *[c for c in ("region", "seq", "osm_id", "roi_zone") if c in df.columns],
        F.when(direct, A.strip(F.col("id"))).otherwise(F.concat(F.lit("tree_"), number)).alias("tree_id"),
        "species",
        "source_species",
        F.col("model.name").alias("model_category"),
        F.col("model.crown_shape").alias("crown_shape"),
        C.utm32_x(F.col("lon"), F.col("lat")).alias("x"),
        C.utm32_y(F.col("lon"), F.col("lat")).alias("y"),
        z.alias("z"),
        h.alias("height_m"),
        F.col("_c.value").alias("crown_radius_m"),
        F.col("_t.value").alias("trunk_radius_m"),
        A.trunk_height(h, F.col("model.crown_base_fraction")).alias("trunk_height_m"),
        "model_source",
        F.col("_h.source").alias("height_source"),
        F.col("_c.source").alias("crown_radius_source"),
        F.col("_t.source").alias("trunk_radius_source"),
        "model_error",
        "dimension_error",
    )
    sources = [F.col(c) for c in ("model_source", "height_source", "crown_radius_source", "trunk_radius_source")]
    fields = ("species_model", "height_m", "crown_radius_m", "trunk_radius_m")
    return out.withColumns(
        {
            "used_tags": F.array_compact(F.array(*[F.when(s.startswith("tag:"), s) for s in sources])),
            "defaulted_fields": F.array_compact(
                F.array(*[F.when(s.startswith("default"), F.lit(f)) for f, s in zip(fields, sources)])
            ),
        }
    )


SOURCE_COLUMNS = {
    "species_model": "model_source",
    "height_m": "height_source",
    "crown_radius_m": "crown_radius_source",
    "trunk_radius_m": "trunk_radius_source",
}


def provenance_counts(instances: DataFrame) -> DataFrame:
    return source_prefix_counts(instances, SOURCE_COLUMNS, ("tag", "allometry", "default", "urban_planning"))


def information_summary(instances: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many trees got their model and dimensions from which kind of source."""
    starts = lambda c, *ps: F.lit(False) if not ps else _any([F.col(c).startswith(f"{p}:") for p in ps])
    any_info = _any(
        [
            F.size("used_tags") > 0,
            starts("model_source", "urban_planning"),
            starts("height_source", "allometry", "urban_planning"),
            starts("crown_radius_source", "urban_planning"),
            starts("trunk_radius_source", "allometry", "urban_planning"),
        ]
    )
    all_tags = F.lit(True)
    for c in SOURCE_COLUMNS.values():
        all_tags = all_tags & F.col(c).startswith("tag:")
    return instances.groupBy(*by).agg(
        F.count("*").alias("tree_count"),
        F.count_if(any_info).alias("trees_with_any_information"),
        F.count_if(starts("model_source", "tag")).alias("trees_with_species_tag_model"),
        F.count_if(starts("model_source", "urban_planning")).alias("trees_with_planning_model"),
        F.count_if(starts("model_source", "default")).alias("trees_with_fallback_model"),
        F.count_if(all_tags).alias("trees_with_all_values_from_tags"),
    )


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def species_counts(instances: DataFrame, by: str = "species") -> DataFrame:
    """Trees per species, most frequent first."""
    return instances.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), by)


def unique_slugs(names: DataFrame, name: str = "species") -> DataFrame:
    """File-safe names: the first of colliding names keeps the slug, the others add a SHA-256 prefix.

    The prefix has eight digits and grows only for names whose shorter prefix
    is shared by another name of the group or equals an existing slug.
    """
    slugs = names.select(name).distinct().withColumn("_slug", A.slug(F.col(name)))
    rank = Window.partitionBy("_slug").orderBy(name)
    df = slugs.withColumn("_rn", F.row_number().over(rank)).withColumn("_sha", F.sha2(F.col(name), 256))
    lengths = F.sequence(F.lit(8), F.lit(64))
    proposals = df.where("_rn > 1").select(
        name, "_slug", "_rn", F.explode(lengths).alias("_len"), "_sha"
    ).withColumn("_p", F.concat("_slug", F.lit("_"), F.expr("substr(_sha, 1, _len)")))
    taken = slugs.select(F.col("_slug").alias("_p")).distinct().withColumn("_taken", F.lit(True))
    # An earlier colliding name owns a shared prefix.
    first = Window.partitionBy("_p").orderBy("_rn", name)
    chosen = (
        proposals.withColumn("_claim", F.row_number().over(first))
        .join(taken, "_p", "left")
        .where("_claim = 1 and _taken is null")
        .groupBy(name)
        .agg(F.min_by("_p", "_len").alias("slug"))
    )
    return df.join(chosen, name, "left").select(
        name, F.when(F.col("_rn") == 1, F.col("_slug")).otherwise(F.col("slug")).alias("slug")
    )


# --- meshes ---------------------------------------------------------------------------------


def _ring_point(cx: Column, cy: Column, radius: Column, index: Column, segments: int) -> tuple[Column, Column]:
    angle = index * (2.0 * math.pi / segments)
    return cx + radius * F.cos(angle), cy + radius * F.sin(angle)


def _tri(label: Column, *points: tuple[Column, Column, Column]) -> Column:
    cols = [label.alias("surface")]
    for p, name in zip(points, "abc"):
        cols += [v.cast("double").alias(f"{name}{axis}") for v, axis in zip(p, "xyz")]
    return F.struct(*cols)


def _emit(df: DataFrame, keep: Sequence[str], triangles: list[Column], order: Column, per: int) -> DataFrame:
    rows = df.select(*keep, order.alias("_o"), F.posexplode(F.array(*triangles)).alias("_k", "_t"))
    return rows.select(*keep, (F.col("_o") * per + F.col("_k")).cast("bigint").alias("tri_no"), "_t.*")


def _dealt(instances: DataFrame) -> DataFrame:
    """A tree becomes many triangles, so its rows keep the configured parallelism instead of being coalesced by size."""
    return instances.repartition(int(instances.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def trunk_mesh(instances: DataFrame, keep: Sequence[str] = ("tree_id",)) -> DataFrame:
    """Frustum of 14 segments: two side and two cap triangles each."""
    n = P.TRUNK_SEGMENTS
    df = _dealt(instances).withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    top_z, radius = z + F.col("trunk_height_m"), F.col("trunk_radius_m")
    i, j = F.col("_i"), F.pmod(F.col("_i") + 1, F.lit(n))
    b0, b1 = _ring_point(x, y, radius, i, n), _ring_point(x, y, radius, j, n)
    t0, t1 = _ring_point(x, y, radius * 0.72, i, n), _ring_point(x, y, radius * 0.72, j, n)
    side, cap = F.lit("trunk"), F.lit("trunk_cap")
    tris = [
        _tri(side, (*b0, z), (*b1, z), (*t1, top_z)),
        _tri(side, (*b0, z), (*t1, top_z), (*t0, top_z)),
        _tri(cap, (x, y, z), (*b1, z), (*b0, z)),
        _tri(cap, (x, y, top_z), (*t0, top_z), (*t1, top_z)),
    ]
    return _emit(df, keep, tris, i, 4)


def crown_mesh(instances: DataFrame, keep: Sequence[str] = ("tree_id",)) -> DataFrame:
    """Ellipsoid crown (8 rings of 16 segments) or cone, by crown shape."""
    n, rings = P.CROWN_SEGMENTS, P.CROWN_RINGS
    instances = _dealt(instances)
    shape = F.col("crown_shape")
    factor = F.when(shape == "umbrella", 1.08).when(shape == "columnar", 0.72).when(shape == "tuft", 0.78).otherwise(1.0)
    round_ = instances.where(shape != "conical").withColumns(
        {
            "_cz": F.col("z") + (F.col("trunk_height_m") + F.col("height_m")) / 2.0,
            "_rz": F.greatest(F.lit(0.8), (F.col("height_m") - F.col("trunk_height_m")) / 2.0),
            "_rr": F.col("crown_radius_m") * factor,
        }
    )
    round_ = round_.withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(rings - 1)))).withColumn(
        "_i", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    )
    x, y = F.col("x"), F.col("y")
    i, j = F.col("_i"), F.pmod(F.col("_i") + 1, F.lit(n))

    def at(g: Column, k: Column) -> tuple[Column, Column, Column]:
        phi = -math.pi / 2.0 + g * (math.pi / rings)
        return (*_ring_point(x, y, F.col("_rr") * F.cos(phi), k, n), F.col("_cz") + F.col("_rz") * F.sin(phi))

    g = F.col("_g")
    a, b, c, d = at(g, i), at(g, j), at(g + 1, j), at(g + 1, i)
    crown = F.lit("crown")
    round_mesh = _emit(round_, keep, [_tri(crown, a, b, c), _tri(crown, a, c, d)], g * n + i, 2)

    cone = instances.where(shape == "conical").withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    base_z, top_z = F.col("z") + F.col("trunk_height_m") * 0.82, F.col("z") + F.col("height_m")
    p, q = _ring_point(x, y, F.col("crown_radius_m"), i, n), _ring_point(x, y, F.col("crown_radius_m"), j, n)
    cone_mesh = _emit(
        cone,
        keep,
        [
            _tri(crown, (*p, base_z), (*q, base_z), (x, y, top_z)),
            _tri(crown, (x, y, base_z), (*q, base_z), (*p, base_z)),
        ],
        i,
        2,
    )
    return round_mesh.unionByName(cone_mesh)
