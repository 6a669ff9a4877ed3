"""Driver queries: tree and purifier instances, meshes, terrain sampling, mesh reports."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import attributes as A
from geoloom.functions import crs as C
from geoloom.functions import triangles as T
from geoloom.operators import mesh as MS
from geoloom.operators import ordering as O
from geoloom.operators import purifiers as PU
from geoloom.operators import terrain as TR
from geoloom.operators import trees as TE
from geoloom.params import DEMO_REGION
from geoloom.plans.catalog_features import utm_sql
from geoloom.plans.catalog_raster import cells, zonal
from geoloom.plans.catalog_features import rect_parts
from geoloom.plans.fixtures import SPECIES_MAP, TREE_MODELS, ctes, purifier_catalogue, species_map, tree_models, view
from geoloom.plans.registry import query
from geoloom.schemas import TRI_COLS

# --- trees ------------------------------------------------------------------------------------


def tree_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees with text tags; every ninth one carries a crown diameter."""
    df = view(spark, sf_dir, "fx_trees")
    entry = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    tags = F.map_from_entries(
        F.filter(
            F.array(
                entry("species", F.col("species")),
                entry("height", F.col("height_tag")),
                entry("diameter", F.col("diameter_m").cast("string")),
                entry("circumference", F.col("circumference_m").cast("string")),
                entry("crown:diameter", F.when(F.col("seq") % 9 == 0, F.lit("5.5 m"))),
            ),
            lambda e: e["value"].isNotNull(),
        )
    )
    df = df.select(
        "region", "seq", "lon", "lat", tags.alias("tags"), F.lit("inner").alias("roi_zone"), F.col("seq").cast("string").alias("osm_id")
    )
    return O.ordinal(df, order="seq", out="position", by=["region"])


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TE.tree_instances(tree_rows(spark, sf_dir), tree_models(spark), species_map(spark), default_species="Tilia")


MODEL_ROWS = ", ".join(f"('{m[0]}', {m[2]}, {m[3]}, {m[4]}, {m[5]}, '{m[6]}')" for m in TREE_MODELS)
SPECIES_ROWS = ", ".join(f"('{s}', '{c.replace(' ', '_')}')" for s, c in SPECIES_MAP)
TREE_CTES = ctes(
    "fx_trees",
    extra=[
        ("md", f"select name, cast(h as double) as h, cast(cr as double) as cr, cast(tr as double) as tr, cast(bf as double) as bf, shape from (values {MODEL_ROWS}) as v(name, h, cr, tr, bf, shape)"),
        ("sm", f"select * from (values {SPECIES_ROWS}) as v(sp, cat)"),
        ("u", utm_sql("fx_trees", "*")),
        (
            "t1",
            "select u.*, coalesce(u.species, 'Tilia') as sp, md.*, case when height_tag is null then null else cast(replace(height_tag, ' m', '') as double) end as ht,"
            " row_number() over (partition by region order by seq) as pos from u join sm on sm.sp = coalesce(u.species, 'Tilia') join md on md.name = sm.cat",
        ),
        (
            "t2",
            "select *, case when ht > 1.5 then least(ht, 35) when circumference_m > 0 then greatest(4, least(h, 6 + 2.2 * sqrt(circumference_m))) else h end as height_m,"
            " case when ht > 1.5 then 'tag:height' when circumference_m > 0 then 'allometry:circumference' else concat('default:', name, '.height_m') end as height_source from t1",
        ),
        (
            "t3",
            "select *, case when seq % 9 = 0 then least(2.75, height_m * 0.48) else least(cr, height_m * 0.42) end as crown_radius_m,"
            " case when seq % 9 = 0 then 'tag:crown:diameter' else concat('default:', name, '.crown_radius_m') end as crown_radius_source,"
            " case when diameter_m > 0.05 then diameter_m / 2 when circumference_m > 0.1 then circumference_m / (2 * pi()) else least(tr, height_m * 0.035) end as trunk_radius_m,"
            " case when diameter_m > 0.05 then 'tag:diameter' when circumference_m > 0.1 then 'allometry:circumference' else concat('default:', name, '.trunk_radius_m') end as trunk_radius_source,"
            " case when species is null then 'default:Tilia:species_category_mapping' else 'tag:species:species_category_mapping' end as model_source,"
            " greatest(1.8, least(height_m * bf, height_m - 1)) as trunk_height_m from t2",
        ),
    ],
)


@query(
    "tree_instances",
    TREE_CTES
    + "select region, seq, concat('tree_', case when pos >= 1000 then cast(pos as varchar) else lpad(cast(pos as varchar), 4, '0') end) as tree_id, sp as species, name as model_category, shape as crown_shape,"
    " round(ux, 3) as x, round(uy, 3) as y, round(height_m, 3) as height_m, round(crown_radius_m, 3) as crown_radius_m, round(trunk_radius_m, 4) as trunk_radius_m,"
    " round(trunk_height_m, 3) as trunk_height_m, model_source, height_source, crown_radius_source, trunk_radius_source,"
    " cast((model_source like 'tag:%')::int + (height_source like 'tag:%')::int + (crown_radius_source like 'tag:%')::int + (trunk_radius_source like 'tag:%')::int as bigint) as used_tags,"
    " cast((model_source like 'default%')::int + (height_source like 'default%')::int + (crown_radius_source like 'default%')::int + (trunk_radius_source like 'default%')::int as bigint) as defaulted_fields from t3",
)
def tree_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = instances(spark, sf_dir).where("model_error is null")
    return df.select(
        "region",
        "seq",
        "tree_id",
        "species",
        "model_category",
        "crown_shape",
        *[F.round(c, 3).alias(c) for c in ("x", "y", "height_m", "crown_radius_m")],
        F.round("trunk_radius_m", 4).alias("trunk_radius_m"),
        F.round("trunk_height_m", 3).alias("trunk_height_m"),
        "model_source",
        "height_source",
        "crown_radius_source",
        "trunk_radius_source",
        F.size("used_tags").cast("bigint").alias("used_tags"),
        F.size("defaulted_fields").cast("bigint").alias("defaulted_fields"),
    )


@query(
    "tree_information",
    TREE_CTES
    + "select region, count(*) as tree_count, count(case when model_source like 'tag:%' or height_source like 'tag:%' or height_source like 'allometry:%' or crown_radius_source like 'tag:%'"
    " or trunk_radius_source like 'tag:%' or trunk_radius_source like 'allometry:%' then 1 end) as trees_with_any_information,"
    " count(case when model_source like 'tag:%' then 1 end) as trees_with_species_tag_model, cast(0 as bigint) as trees_with_planning_model,"
    " count(case when model_source like 'default:%' then 1 end) as trees_with_fallback_model,"
    " count(case when model_source like 'tag:%' and height_source like 'tag:%' and crown_radius_source like 'tag:%' and trunk_radius_source like 'tag:%' then 1 end) as trees_with_all_values_from_tags from t3 group by 1",
)
def tree_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TE.information_summary(instances(spark, sf_dir), by=["region"])


@query(
    "tree_provenance_counts",
    TREE_CTES
    + ", s as (select 'species_model' as field, model_source as src from t3 union all select 'height_m', height_source from t3"
    " union all select 'crown_radius_m', crown_radius_source from t3 union all select 'trunk_radius_m', trunk_radius_source from t3)"
    " select field, split_part(src, ':', 1) as source, count(*) as n from s group by 1, 2",
)
def tree_provenance_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TE.provenance_counts(instances(spark, sf_dir))


@query("tree_species_counts", TREE_CTES + "select sp as species, count(*) as n from t3 group by 1")
def tree_species_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TE.species_counts(instances(spark, sf_dir))


@query(
    "unmapped_species",
    ctes("fx_attrs")
    + "select seq, case when trim(specie) in ('Tilia cordata', 'Pinus pinea') or specie is null then null else 'species is not mapped' end as model_error from fx_attrs",
)
def unmapped_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Species that have no model category become error rows instead of failing the run."""
    df = view(spark, sf_dir, "fx_attrs").select(
        "seq", F.when(F.col("specie").isNotNull(), F.create_map(F.lit("species"), F.col("specie"))).otherwise(F.create_map().cast("map<string,string>")).alias("tags")
    )
    return TE.resolve_models(df, tree_models(spark), species_map(spark), "Tilia").select("seq", "model_error")


PLANNED_SQL = (
    "select osm_num, name as model_category, case when height_m is not null then height_m else h end as height_m,"
    " case when width_m is not null then width_m / 2 else least(cr, case when height_m is not null then height_m else h end * 0.42) end as crown_radius_m,"
    " case when height_m is not null then 'urban_planning:height_m' else concat('default:', name, '.height_m') end as height_source,"
    " case when width_m is not null then 'urban_planning:crown_diameter_m' else concat('default:', name, '.crown_radius_m') end as crown_radius_source, id as tree_id"
    " from fx_planning join md on md.name = case when model = 'palm' then 'palm_tuft' else model end where kind = 'tree'"
)


@query(
    "planned_overrides",
    ctes(
        "fx_planning",
        extra=[
            ("md", f"select name, cast(h as double) as h, cast(cr as double) as cr from (values {MODEL_ROWS}) as v(name, h, cr, tr, bf, shape)"),
            ("p", PLANNED_SQL),
        ],
    )
    + "select osm_num, tree_id, model_category, round(height_m, 3) as height_m, round(crown_radius_m, 3) as crown_radius_m, height_source, crown_radius_source, 'urban_planning:model' as model_source from p",
)
def planned_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned trees: direct models (by name or alias) and planned dimensions win over defaults."""
    df = view(spark, sf_dir, "fx_planning").where("kind = 'tree'").select(
        "region",
        F.col("osm_num").alias("seq"),
        F.lit(1).alias("position"),
        "lon",
        "lat",
        "id",
        F.col("model").alias("direct_model_category"),
        "height_m",
        F.col("width_m").alias("crown_diameter_m"),
        F.lit("inner").alias("roi_zone"),
        F.create_map().cast("map<string,string>").alias("tags"),
    )
    out = TE.tree_instances(df, tree_models(spark), species_map(spark))
    return out.select(
        F.col("seq").alias("osm_num"),
        "tree_id",
        "model_category",
        F.round("height_m", 3).alias("height_m"),
        F.round("crown_radius_m", 3).alias("crown_radius_m"),
        "height_source",
        "crown_radius_source",
        "model_source",
    )


@query(
    "species_slugs",
    "with n as (select distinct concat(case p_partkey % 4 when 0 then 'Tilia ' when 1 then 'tilia-' when 2 then 'TILIA  ' else 'Acer ' end, p_brand) as species from part),"
    " s as (select species, trim(regexp_replace(lower(species), '[^a-z0-9]+', '_', 'g'), '_') as slug from n),"
    " r as (select *, row_number() over (partition by slug order by species) as rn from s)"
    " select species, case when rn = 1 then slug else concat(slug, '_', substr(sha256(species), 1, 8)) end as slug from r",
)
def species_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/part.parquet")
    kind = F.col("p_partkey") % 4
    prefix = F.when(kind == 0, "Tilia ").when(kind == 1, "tilia-").when(kind == 2, "TILIA  ").otherwise("Acer ")
    return TE.unique_slugs(df.select(F.concat(prefix, F.col("p_brand")).alias("species")))


# --- tree meshes ----------------------------------------------------------------------------------


def mesh_summary(mesh: DataFrame, by: list[str]) -> DataFrame:
    """Bounds, triangle count and surface area per group, rounded."""
    area = mesh.groupBy(*by).agg(F.round(F.sum(T.cross_length() / 2.0), 3).alias("surface_m2"))
    bounds = MS.mesh_bounds(mesh, by)
    cols = [F.round(c, 3).alias(c) for c in ("min_x", "max_x", "min_y", "max_y", "min_z", "max_z")]
    return bounds.select(*by, "triangles", *cols).join(area, by)


def plain_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances moved to the origin, which keeps rounded coordinates comparable."""
    df = instances(spark, sf_dir).where("model_error is null")
    return df.withColumns({"x": F.lit(0.0), "y": F.lit(0.0)})


@query(
    "trunk_mesh",
    TREE_CTES
    + ", k as (select t3.*, unnest(range(14)) as i from t3), a as (select *, 2 * pi() * i / 14 as f from k)"
    " select region, seq, cast(56 as bigint) as triangles, round(min(trunk_radius_m * cos(f)), 3) as min_x, round(max(trunk_radius_m * cos(f)), 3) as max_x,"
    " round(min(trunk_radius_m * sin(f)), 3) as min_y, round(max(trunk_radius_m * sin(f)), 3) as max_y, cast(0 as double) as min_z, round(any_value(trunk_height_m), 3) as max_z from a group by 1, 2",
)
def trunk_mesh(spark: SparkSession, sf_dir: str) -> DataFrame:
    mesh = TE.trunk_mesh(plain_trees(spark, sf_dir), keep=["region", "seq"])
    return mesh_summary(mesh, ["region", "seq"]).drop("surface_m2")


CROWN_SQL = (
    ", cr_ as (select *, case shape when 'umbrella' then 1.08 when 'columnar' then 0.72 when 'tuft' then 0.78 else 1 end * crown_radius_m as rr,"
    " (trunk_height_m + height_m) / 2 as cz, greatest(0.8, (height_m - trunk_height_m) / 2) as rz from t3)"
    " select region, seq, case when shape = 'conical' then cast(32 as bigint) else cast(256 as bigint) end as triangles,"
    " round(-case when shape = 'conical' then crown_radius_m else rr end, 3) as min_x, round(case when shape = 'conical' then crown_radius_m else rr end, 3) as max_x,"
    " round(-case when shape = 'conical' then crown_radius_m else rr end, 3) as min_y, round(case when shape = 'conical' then crown_radius_m else rr end, 3) as max_y,"
    " round(case when shape = 'conical' then trunk_height_m * 0.82 else cz - rz end, 3) as min_z, round(case when shape = 'conical' then height_m else cz + rz end, 3) as max_z from cr_"
)


@query("crown_mesh", TREE_CTES + CROWN_SQL)
def crown_mesh(spark: SparkSession, sf_dir: str) -> DataFrame:
    mesh = TE.crown_mesh(plain_trees(spark, sf_dir), keep=["region", "seq"])
    return mesh_summary(mesh, ["region", "seq"]).drop("surface_m2")


@query(
    "crown_mesh_by_species",
    TREE_CTES
    + "select sp as species, cast(sum(case when shape = 'conical' then 32 else 256 end) as bigint) as triangles, trim(regexp_replace(lower(sp), '[^a-z0-9]+', '_', 'g'), '_') as slug from t3 group by 1",
)
def crown_mesh_by_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = instances(spark, sf_dir).where("model_error is null")
    mesh = TE.crown_mesh(trees, keep=["species"])
    return mesh.groupBy("species").agg(F.count("*").alias("triangles")).join(TE.unique_slugs(trees), "species")


@query(
    "local_frame_mesh",
    TREE_CTES + "select region, seq, round(ux - 680000, 3) as mean_x, round(uy - 4840000, 3) as mean_y from t3",
)
def local_frame_mesh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trunks moved to a local origin: the mean vertex stays on the tree's axis."""
    mesh = TE.trunk_mesh(instances(spark, sf_dir).where("model_error is null"), keep=["region", "seq"])
    moved = MS.translate(mesh, F.lit(-680000.0), F.lit(-4840000.0))
    out = MS.mesh_bounds(moved, ["region", "seq"])
    return out.select("region", "seq", F.round("mean_x", 3).alias("mean_x"), F.round("mean_y", 3).alias("mean_y"))


# --- purifiers ------------------------------------------------------------------------------------------


def purifier_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "fx_planning").where("kind = 'air_purifier'").select(
        "region",
        F.col("id").alias("purifier_id"),
        "model",
        "height_m",
        "width_m",
        F.lit(None).cast("double").alias("depth_m"),
        "rotation_deg",
        "lon",
        "lat",
        F.col("input_name").alias("urban_planning_input_id"),
        F.when(F.col("osm_num") % 97 == 0, F.lit("nowhere")).otherwise(F.lit("inner")).alias("roi_zone"),
        F.lit("plan.geojson").alias("source"),
        F.lit("EPSG:4326").alias("source_crs"),
        F.col("osm_num").alias("source_feature_index"),
        F.lit("{}").alias("source_properties"),
    )


def placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PU.resolve(purifier_rows(spark, sf_dir), PU.catalogue_dimension(purifier_catalogue(spark)))


PUR_CTES = ctes(
    "fx_planning",
    extra=[
        ("u", utm_sql("fx_planning", "*")),
        (
            "pu",
            "select *, coalesce(height_m, 4) as th, coalesce(width_m, 1.5) as tw, case when rotation_deg is null then 0 else rotation_deg % 360 end as rot from u where kind = 'air_purifier'",
        ),
    ],
)


@query(
    "purifier_placement",
    PUR_CTES
    + "select id as purifier_id, round(ux, 3) as projected_x, round(uy, 3) as projected_y, round(th, 3) as height_m, round(tw, 3) as width_m, cast(1.5 as double) as depth_m,"
    " round(tw / 1.5, 6) as scale_x, cast(1 as double) as scale_y, round(th / 4, 6) as scale_z, cast(rot as double) as rotation_deg,"
    " case when height_m is null then concat('default:', model) else 'attribute:HEIGHT_M' end as height_source,"
    " case when width_m is null then concat('default:', model) else 'attribute:WIDTH_M' end as width_source,"
    " case when rotation_deg is null then concat('default:', model) else 'attribute:ROTATION_D' end as rotation_source,"
    " cast(case when osm_num % 97 = 0 then 1 else 0 end as bigint) as errors from pu",
)
def purifier_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placements(spark, sf_dir).select(
        "purifier_id",
        *[F.round(c, 3).alias(c) for c in ("projected_x", "projected_y", "height_m", "width_m", "depth_m")],
        *[F.round(c, 6).alias(c) for c in ("scale_x", "scale_y", "scale_z")],
        "rotation_deg",
        "height_source",
        "width_source",
        "rotation_source",
        F.size("errors").cast("bigint").alias("errors"),
    )


@query(
    "purifier_counts",
    PUR_CTES
    + ", s as (select 'model' as metric, model as key from pu union all select 'input', input_name from pu"
    " union all select 'height_source', case when height_m is null then concat('default:', model) else 'attribute:HEIGHT_M' end from pu"
    " union all select 'width_source', case when width_m is null then concat('default:', model) else 'attribute:WIDTH_M' end from pu"
    " union all select 'depth_source', concat('default:', model) from pu"
    " union all select 'rotation_source', case when rotation_deg is null then concat('default:', model) else 'attribute:ROTATION_D' end from pu)"
    " select metric, key, count(*) as n from s group by 1, 2",
)
def purifier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PU.counts(placements(spark, sf_dir))


def tower_meshes(spark: SparkSession) -> DataFrame:
    """Two box-shaped stand-in towers of native size, one region per height band."""
    half, rows = 0.75, []
    bands = (("inlet", 0.0, 1.0), ("tower", 1.0, 3.0), ("outlet", 3.0, 4.0))
    corners = [(-half, -half), (half, -half), (half, half), (-half, half)]
    for model in ("compact_octagonal_tower", "compact_four_side_tower"):
        n = 0
        for name, lo, hi in bands:
            faces = []
            for (x0, y0), (x1, y1) in zip(corners, corners[1:] + corners[:1]):
                faces += [((x0, y0, lo), (x1, y1, lo), (x1, y1, hi)), ((x0, y0, lo), (x1, y1, hi), (x0, y0, hi))]
            for z in ([lo] if lo == 0.0 else []) + ([hi] if hi == 4.0 else []):
                c = [(x, y, z) for x, y in corners]
                faces += [(c[0], c[1], c[2]), (c[0], c[2], c[3])]
            for a, b, c in faces:
                rows.append((model, name, n, *a, *b, *c))
                n += 1
    coords = ", ".join(f"{c} double" for c in TRI_COLS)
    return spark.createDataFrame(rows, f"model string, region string, tri_no bigint, {coords}")


def placed_towers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = placements(spark, sf_dir).where(F.size("errors") == 0).select(
        F.col("region").alias("area"),
        "purifier_id",
        "model",
        "scale_x",
        "scale_y",
        "scale_z",
        "rotation_deg",
        F.lit(0.0).alias("to_x"),
        F.lit(0.0).alias("to_y"),
        F.lit(2.0).alias("to_z"),
    )
    return MS.place_meshes(ready, tower_meshes(spark))


_TOWER_X = "greatest(abs(0.75 * tw / 1.5 * cos(radians(rot)) - 0.75 * sin(radians(rot))), abs(0.75 * tw / 1.5 * cos(radians(rot)) + 0.75 * sin(radians(rot))))"
_TOWER_Y = "greatest(abs(0.75 * tw / 1.5 * sin(radians(rot)) + 0.75 * cos(radians(rot))), abs(0.75 * tw / 1.5 * sin(radians(rot)) - 0.75 * cos(radians(rot))))"


@query(
    "purifier_mesh",
    PUR_CTES
    + f"select id as purifier_id, round(-{_TOWER_X}, 3) as min_x, round({_TOWER_X}, 3) as max_x, round(-{_TOWER_Y}, 3) as min_y, round({_TOWER_Y}, 3) as max_y,"
    " cast(2 as double) as min_z, round(2 + th, 3) as max_z, cast(28 as bigint) as triangles from pu where osm_num % 97 <> 0",
)
def purifier_mesh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled, rotated and moved tower meshes by their bounds."""
    return mesh_summary(placed_towers(spark, sf_dir), ["purifier_id"]).drop("surface_m2")


@query(
    "purifier_aggregate_mesh",
    PUR_CTES
    + "select r.region, cast(count(*) * r.n as bigint) as triangles from pu, (values ('inlet', 10), ('outlet', 10), ('tower', 8)) as r(region, n) where osm_num % 97 <> 0 group by r.region, r.n",
)
def purifier_aggregate_mesh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregate mesh is the union of the units: triangles per region add up."""
    return placed_towers(spark, sf_dir).groupBy("region").agg(F.count("*").alias("triangles"))


@query(
    "tower_mesh_quality",
    PUR_CTES + "select id as purifier_id, cast(28 as bigint) as triangles, cast(42 as bigint) as edges, cast(0 as bigint) as bad_edges, true as closed_manifold, true as complete from pu where osm_num % 97 <> 0",
)
def tower_mesh_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placed towers stay closed: every edge used exactly twice, all three regions present."""
    mesh = placed_towers(spark, sf_dir)
    quality = MS.mesh_quality(mesh, ["purifier_id"])
    complete = MS.region_completeness(mesh, ["purifier_id"]).select("purifier_id", "complete")
    return quality.join(complete, "purifier_id").select(
        "purifier_id", "triangles", "edges", "bad_edges", "closed_manifold", "complete"
    )


# --- terrain ----------------------------------------------------------------------------------------------


def lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two terrain triangles per square of valid neighbouring cells (tiles are separate meshes)."""
    c = cells(spark, sf_dir).select("region", "tile", "row", "col", "seq", "x", "y", F.col("ground_z").alias("z"))

    def corner(name: str, dr: int, dc: int) -> DataFrame:
        return c.where("z is not null").select(
            "region", "tile", (F.col("row") - dr).alias("row"), (F.col("col") - dc).alias("col"),
            F.struct("x", "y", "z").alias(name),
        )

    keys = ["region", "tile", "row", "col"]
    squares = c.where("z is not null").withColumn("p", F.struct("x", "y", "z"))
    for name, dr, dc in (("q", 0, 1), ("r", 1, 1), ("s", 1, 0)):
        squares = squares.join(corner(name, dr, dc), keys)
    tri = lambda *ps: F.struct(*[F.col(f"{p}.{axis}").alias(f"{v}{axis}") for p, v in zip(ps, "abc") for axis in "xyz"])
    both = squares.withColumn("_t", F.array(tri("p", "q", "r"), tri("p", "r", "s")))
    rows = both.select("region", "tile", "seq", F.posexplode("_t").alias("k", "t"))
    return rows.select("region", "tile", (F.col("seq") * 2 + F.col("k")).alias("tri_no"), "t.*")


LATTICE_CTES = [
    ("cv", "select * from fx_cells where ground_z is not null"),
    (
        "sq",
        "select p.region, p.tile, p.seq, p.x as px, p.y as py, p.ground_z as pz, q.x as qx, q.y as qy, q.ground_z as qz, r.x as rx, r.y as ry, r.ground_z as rz, s.x as sx, s.y as sy, s.ground_z as sz"
        " from cv p join cv q on q.region = p.region and q.tile = p.tile and q.\"row\" = p.\"row\" and q.\"col\" = p.\"col\" + 1"
        " join cv r on r.region = p.region and r.tile = p.tile and r.\"row\" = p.\"row\" + 1 and r.\"col\" = p.\"col\" + 1"
        " join cv s on s.region = p.region and s.tile = p.tile and s.\"row\" = p.\"row\" + 1 and s.\"col\" = p.\"col\"",
    ),
    (
        "tri",
        "select region, tile, seq * 2 as tri_no, px as ax, py as ay, pz as az, qx as bx, qy as by_, qz as bz, rx as cx, ry as cy, rz as cz from sq"
        " union all select region, tile, seq * 2 + 1, px, py, pz, rx, ry, rz, sx, sy, sz from sq",
    ),
]
PROBE_SQL = (
    "select region, osm_num, radians(lon - 11.2558) * 6371000.0 * cos(radians(43.7696)) * 0.2 + 0.0371 as x, radians(lat - 43.7696) * 6371000.0 * 0.15 + 0.0193 as y from fx_points"
)


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling points spread over the lattice, some of them in holes or beside it, none midway between two triangles."""
    x, y = C.to_local(F.col("lon"), F.col("lat"), DEMO_REGION)
    return view(spark, sf_dir, "fx_points").select(
        "region", "osm_num", (x * 0.2 + 0.0371).alias("x"), (y * 0.15 + 0.0193).alias("y")
    )


BARY = (
    "select p.region, p.osm_num, t.*, ((t.by_ - t.cy) * (p.x - t.cx) + (t.cx - t.bx) * (p.y - t.cy)) / ((t.by_ - t.cy) * (t.ax - t.cx) + (t.cx - t.bx) * (t.ay - t.cy)) as u,"
    " ((t.cy - t.ay) * (p.x - t.cx) + (t.ax - t.cx) * (p.y - t.cy)) / ((t.by_ - t.cy) * (t.ax - t.cx) + (t.cx - t.bx) * (t.ay - t.cy)) as v"
    " from probes p join tri t on t.region = p.region and p.x between least(t.ax, t.bx, t.cx) - 1e-9 and greatest(t.ax, t.bx, t.cx) + 1e-9"
    " and p.y between least(t.ay, t.by_, t.cy) - 1e-9 and greatest(t.ay, t.by_, t.cy) + 1e-9"
)


@query(
    "terrain_hits",
    ctes("fx_cells", "fx_points", extra=[*LATTICE_CTES, ("probes", PROBE_SQL), ("bc", BARY)])
    + "select region, osm_num, round(max(u * az + v * bz + (1 - u - v) * cz), 3) as terrain_z from bc where u >= -1e-9 and v >= -1e-9 and 1 - u - v >= -1e-9 group by 1, 2",
)
def terrain_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Height of the terrain triangle under every probe."""
    out = TR.sample_hits(probes(spark, sf_dir), lattice(spark, sf_dir), key=["osm_num"], on=["region"])
    return out.select("region", "osm_num", F.round("terrain_z", 3).alias("terrain_z"))


def _edge_sql(p: str, q: str) -> str:
    return (
        f"select m.region, m.osm_num, m.x, m.y, t.tri_no, t.{p[0]}x as sx, t.{p[1]} as sy, t.{p[0]}z as sz, t.{q[0]}x - t.{p[0]}x as dx, t.{q[1]} - t.{p[1]} as dy, t.{q[0]}z - t.{p[0]}z as dz"
        " from miss m join tri t on t.region = m.region and abs(t.ax - m.x) < 8 and abs(t.ay - m.y) < 8"
    )


_A, _B, _CC = ("a", "ay"), ("b", "by_"), ("c", "cy")
NEAR_SQL = (
    "select region, osm_num, arg_min(sz + t * dz, (power(x - sx - t * dx, 2) + power(y - sy - t * dy, 2))) as z from ("
    "select *, greatest(0, least(1, ((x - sx) * dx + (y - sy) * dy) / (dx * dx + dy * dy))) as t from ("
    + " union all ".join(_edge_sql(p, q) for p, q in ((_A, _B), (_B, _CC), (_CC, _A)))
    + ")) group by 1, 2"
)


@query(
    "terrain_sample",
    ctes(
        "fx_cells",
        "fx_points",
        extra=[
            *LATTICE_CTES,
            ("probes", PROBE_SQL),
            ("bc", BARY),
            ("hit", "select region, osm_num, max(u * az + v * bz + (1 - u - v) * cz) as z from bc where u >= -1e-9 and v >= -1e-9 and 1 - u - v >= -1e-9 group by 1, 2"),
            # The lattice hull is cut only at its corners; probes near a corner are left out on both sides.
            ("miss", "select p.* from probes p left join hit on hit.region = p.region and hit.osm_num = p.osm_num where hit.z is null and abs(x) < 74.5 and abs(y) < 49.5 and not (abs(x) > 70 and abs(y) > 45)"),
            ("near", NEAR_SQL),
        ],
    )
    + "select p.region, p.osm_num, round(coalesce(hit.z, near.z), 3) as terrain_z, case when hit.z is not null then 'hit' when near.z is not null then 'nearest' else 'outside' end as terrain_status"
    " from probes p left join hit on hit.region = p.region and hit.osm_num = p.osm_num left join near on near.region = p.region and near.osm_num = p.osm_num"
    " where not (abs(x) > 70 and abs(y) > 45)",
)
def terrain_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit, nearest terrain inside the hull, or outside."""
    points = probes(spark, sf_dir).where("not (abs(x) > 70 and abs(y) > 45)")
    out = TR.sample_terrain(points, lattice(spark, sf_dir), key=["osm_num"], on=["region"])
    return out.select("region", "osm_num", F.round("terrain_z", 3).alias("terrain_z"), "terrain_status")


@query("purifier_on_terrain")
def purifier_on_terrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purifiers whose four rotated corners are on the terrain get its height minus the clearance."""
    x, y = C.to_local(F.col("lon"), F.col("lat"), DEMO_REGION)
    placed = placements(spark, sf_dir).withColumns({"local_x": x * 0.2, "local_y": y * 0.15})
    out = PU.place_on_terrain(placed, lattice(spark, sf_dir), source="lattice", on=["region"])
    return out.select("region", "purifier_id", F.round("base_z", 3).alias("base_z"), F.size("errors").alias("errors"))


@query(
    "mesh_quality",
    ctes(
        "fx_cells",
        extra=[
            *LATTICE_CTES,
            ("e", "select region, tile, tri_no, ax as x0, ay as y0, az as z0, bx as x1, by_ as y1, bz as z1 from tri union all select region, tile, tri_no, bx, by_, bz, cx, cy, cz from tri"
             " union all select region, tile, tri_no, cx, cy, cz, ax, ay, az from tri"),
            ("n", "select region, tile, least(x0 * 1000 + y0, x1 * 1000 + y1) as u, greatest(x0 * 1000 + y0, x1 * 1000 + y1) as v, count(*) as n from e group by 1, 2, 3, 4"),
            ("q", "select region, tile, count(*) as edges, count(case when n = 1 then 1 end) as boundary_edges, count(case when n > 2 then 1 end) as overused_edges, count(case when n <> 2 then 1 end) as bad_edges from n group by 1, 2"),
            ("f", "select region, tile, count(*) as triangles from tri group by 1, 2"),
        ],
    )
    + "select q.*, f.triangles, cast(0 as bigint) as rejected_triangles, bad_edges = 0 as closed_manifold from q join f using (region, tile)",
)
def mesh_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An open terrain is no closed manifold: its border edges are used once."""
    return MS.mesh_quality(lattice(spark, sf_dir), ["region", "tile"])


@query(
    "triangle_normals",
    ctes("fx_cells", extra=LATTICE_CTES)
    + "select region, tri_no, round(((by_ - ay) * (cz - az) - (bz - az) * (cy - ay)) / l, 4) as nx, round(((bx - ax) * (cy - ay) - (by_ - ay) * (cx - ax)) / l, 4) as nz from ("
    "select *, sqrt(power((by_ - ay) * (cz - az) - (bz - az) * (cy - ay), 2) + power((bz - az) * (cx - ax) - (bx - ax) * (cz - az), 2) + power((bx - ax) * (cy - ay) - (by_ - ay) * (cx - ax), 2)) as l from tri)",
)
def triangle_normals(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = MS.with_normals(lattice(spark, sf_dir))
    return out.select("region", "tri_no", F.round("nx", 4).alias("nx"), F.round("nz", 4).alias("nz"))


@query(
    "even_sample",
    ctes("fx_cells", extra=[*LATTICE_CTES, ("o", "select *, row_number() over (partition by region order by tri_no) - 1 as pos, count(*) over (partition by region) as n from tri"),
                            ("i", "select region, n, unnest(range(1000)) as i from (select distinct region, n from o)"),
                            ("k", "select region, least(cast(floor(i * (n / 1000.0)) as bigint), n - 1) as pos from i")])
    + "select o.region, o.tri_no from o join k on k.region = o.region and k.pos = o.pos where o.n > 1000 union all select region, tri_no from o where n <= 1000",
)
def even_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thousand evenly spaced triangles per region."""
    return O.even_sample(lattice(spark, sf_dir), 1000, order="tri_no", by=["region"]).select("region", "tri_no")


@query(
    "mesh_offsets",
    ctes("fx_cells", extra=LATTICE_CTES)
    + "select region, tile, 3 * n as vertices, cast(coalesce(sum(3 * n) over (partition by region order by tile rows between unbounded preceding and 1 preceding), 0) as bigint) as vertex_offset"
    " from (select region, tile, count(*) as n from tri group by 1, 2)",
)
def mesh_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First vertex number of every tile mesh when the meshes of a region are concatenated."""
    sizes = lattice(spark, sf_dir).groupBy("region", "tile").agg((3 * F.count("*")).alias("vertices"))
    return MS.vertex_offsets(sizes, order="tile", by=["region"])


@query(
    "mesh_concat",
    ctes("fx_cells", extra=LATTICE_CTES)
    + "select region, case when tile < 2 then 'terrain' when tile < 4 then 'building' else 'surface_layer:water' end as kind, tri_no,"
    " round(ax, 3) as x1, round(ay, 3) as y1, round(az, 3) as z1, round(bx, 3) as x2, round(by_, 3) as y2, round(bz, 3) as z2,"
    " round(cx, 3) as x3, round(cy, 3) as y3, round(cz, 3) as z3 from tri",
)
def mesh_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled union of meshes, every triangle of them."""
    mesh = lattice(spark, sf_dir)
    out = MS.concat_meshes(
        {
            "terrain": mesh.where("tile < 2"),
            "building": mesh.where("tile in (2, 3)"),
            "surface_layer:water": mesh.where("tile >= 4"),
        },
        by=["region"],
    )
    corners = [F.round(f"{v}{axis}", 3).alias(f"{axis}{k}") for k, v in enumerate("abc", 1) for axis in "xyz"]
    return out.select("region", "kind", "tri_no", *corners)


@query(
    "scene_focus",
    ctes("fx_cells", extra=LATTICE_CTES)
    + "select region, round(coalesce(avg((ax + bx + cx) / 3) filter (where tile in (2, 3)), avg((ax + bx + cx) / 3)), 3) as focus_x,"
    " round(coalesce(avg((ay + by_ + cy) / 3) filter (where tile in (2, 3)), avg((ay + by_ + cy) / 3)), 3) as focus_y from tri group by 1",
)
def scene_focus(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("tile").isin(2, 3), "building").otherwise("terrain")
    out = MS.focus_point(lattice(spark, sf_dir).withColumn("kind", kind), ["region"])
    return out.select("region", F.round("focus_x", 3).alias("focus_x"), F.round("focus_y", 3).alias("focus_y"))


# --- extrusion -----------------------------------------------------------------------------------------------


def extruded(spark: SparkSession, sf_dir: str) -> DataFrame:
    heights = zonal(spark, sf_dir).select("region", "seq", "base_z", "top_z")
    parts = rect_parts(spark, sf_dir).where("category = 'buildings'").select("region", "seq", "parts")
    raised = MS.roof_raise(A.has_roof_shape(F.when(F.col("seq") % 2 == 0, F.lit("gabled")), F.create_map().cast("map<string,string>")))
    buildings = parts.join(heights, ["region", "seq"]).withColumn("roof_raise", raised)
    return MS.extrude_buildings(buildings, ["region", "seq"], on=["region"])


@query(
    "extrude_buildings",
    ctes("fx_rects")
    + "select region, seq, s as surface, round(case s when 'roof' then (x1 - x0) * (y1 - y0) when 'raised_roof' then (x1 - x0) * (y1 - y0) else 2 * (x1 - x0 + y1 - y0) end, 3) as xy_measure"
    " from fx_rects, (values ('wall'), ('roof'), ('raised_roof')) as v(s) where category = 'buildings' and (s <> 'raised_roof' or seq % 2 = 0)",
)
def extrude_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roofs cover the footprint, raised roofs cover it too, walls follow the outline."""
    mesh = extruded(spark, sf_dir)
    rise = F.greatest("az", "bz", "cz") - F.least("az", "bz", "cz")
    wall = F.try_divide(T.cross_length() / 2.0, rise)
    return mesh.groupBy("region", "seq", "surface").agg(
        F.round(F.sum(F.when(F.col("surface") == "wall", wall).otherwise(T.xy_area())), 3).alias("xy_measure")
    )


