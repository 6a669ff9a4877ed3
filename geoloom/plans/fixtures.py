"""Spatial views over the driver's tables, in SQL that Spark and DuckDB both run.

No driver table is spatial, so integers are mapped to coordinates. Every view
carries ``region``: consecutive keys are cut into regions of fixed size, each
with its own local plane, so the number of regions grows with the data while
the density inside one stays that of a real map.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

D = "cast({} as double)"


def _d(v: object) -> str:
    return f"cast({v} as double)"


VIEWS: dict[str, tuple[str, list[str]]] = {
    "fx_points": (
        "events",
        [
            "cast(floor(event_id / 10000) as bigint) as region",
            "event_id as osm_num",
            "event_type",
            "cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k",
            f"{_d(11.2558)} + (((event_id * 7919) % 10007) - 5003) * {_d(0.0045)} / 5003 as lon",
            f"{_d(43.7696)} + (((event_id * 104729) % 10009) - 5004) * {_d(0.0033)} / 5004 as lat",
            "case event_type when 'purchase' then 'building' when 'signup' then 'natural' when 'click' then 'highway'"
            " when 'view' then 'landuse' else 'shop' end as key1",
            "case event_type when 'purchase' then case when k % 4 = 0 then 'roof' else 'yes' end"
            " when 'signup' then case when k % 3 = 0 then 'tree' when k % 3 = 1 then 'water' else 'wood' end"
            " when 'click' then 'primary'"
            " when 'view' then case when k % 3 = 0 then 'grass' when k % 3 = 1 then 'industrial' else 'farmland' end"
            " else 'kiosk' end as val1",
            "case when event_id % 7 = 0 then 'surface' end as key2",
            "case when event_id % 7 = 0 then 'asphalt' end as val2",
            "event_id % 11 <> 0 as has_tags",
        ],
    ),
    "fx_rects": (
        "customer",
        [
            "cast(floor(c_custkey / 1500) as bigint) as region",
            "c_custkey as seq",
            "case c_mktsegment when 'BUILDING' then 'buildings' when 'MACHINERY' then 'roads' when 'AUTOMOBILE' then 'concrete'"
            " when 'HOUSEHOLD' then 'green_areas' else 'water' end as category",
            "case when c_custkey % 10 = 0 then 'building_part' else 'plain' end as group_tag",
            "case when c_custkey % 13 = 0 then 'streets' end as supplement",
            f"{_d('((c_custkey * 7919) % 601) - 300')} as x0",
            f"{_d('((c_custkey * 104729) % 607) - 303')} as y0",
            f"{_d('((c_custkey * 7919) % 601) - 300 + 4 + c_custkey % 9')} as x1",
            f"{_d('((c_custkey * 104729) % 607) - 303 + 4 + c_nationkey % 7')} as y1",
        ],
    ),
    "fx_cells": (
        "orders",
        [
            "cast(floor(o_orderkey / 15000) as bigint) as region",
            "cast(floor((o_orderkey % 15000) / 2500) as bigint) as tile",
            'cast(floor((o_orderkey % 2500) / 50) as bigint) as "row"',
            'o_orderkey % 50 as "col"',
            "o_orderkey as seq",
            f"{_d('o_orderkey % 50')} + {_d(0.5)} + 50 * (cast(floor((o_orderkey % 15000) / 2500) as bigint) % 3) - 75 as x",
            f"50 - {_d('floor((o_orderkey % 2500) / 50)')} - {_d(0.5)}"
            " + 50 * cast(floor(cast(floor((o_orderkey % 15000) / 2500) as bigint) / 3) as bigint) - 50 as y",
            f"case when o_orderkey % 97 = 0 then null else {_d(50.0)} + (o_custkey % 40) * {_d(0.1)} end as ground_z",
            f"case when o_orderkey % 89 = 0 then null else {_d(50.0)} + (o_custkey % 40) * {_d(0.1)}"
            f" + case when o_orderstatus = 'F' then {_d(6.0)} + o_orderkey % 7 else (o_orderkey % 15) * {_d(0.1)} end end as surface_z",
        ],
    ),
    "fx_trees": (
        "part",
        [
            "cast(floor(p_partkey / 2000) as bigint) as region",
            "p_partkey as seq",
            "case p_type when 'STANDARD' then 'Tilia cordata' when 'SMALL' then 'Acer campestre' when 'LARGE' then 'Pinus pinea'"
            " when 'ECONOMY' then 'Cupressus' when 'MEDIUM' then 'Quercus ilex' else null end as species",
            "case when p_size % 3 = 0 then cast(p_size as string) when p_size % 3 = 1 then concat(cast(p_size as string), ' m')"
            " else null end as height_tag",
            f"case when p_partkey % 4 = 0 then {_d('20 + p_size')} / 100 else null end as diameter_m",
            f"case when p_partkey % 5 = 0 then {_d('60 + p_size')} / 100 else null end as circumference_m",
            f"{_d(11.2558)} + (((p_partkey * 7919) % 2003) - 1001) * {_d(0.003)} / 1001 as lon",
            f"{_d(43.7696)} + (((p_partkey * 104729) % 2011) - 1005) * {_d(0.0022)} / 1005 as lat",
        ],
    ),
    "fx_masks": (
        "supplier",
        [
            "cast(floor(s_suppkey / 100) as bigint) as region",
            "s_suppkey as seq",
            "case s_nationkey % 5 when 0 then 'Building' when 1 then 'asphalt' when 2 then 'paving-stones' when 3 then 'tree canopy'"
            " else 'water' end as raw_class",
            f"{_d('((s_suppkey * 7919) % 601) - 300')} as x0",
            f"{_d('((s_suppkey * 104729) % 607) - 303')} as y0",
            f"{_d('((s_suppkey * 7919) % 601) - 300 + 12')} as x1",
            f"{_d('((s_suppkey * 104729) % 607) - 303 + 10')} as y1",
            "s_acctbal / 10000 as confidence",
        ],
    ),
    "fx_attrs": (
        "part",
        [
            "p_partkey as seq",
            "case p_type when 'STANDARD' then ' Tilia cordata ' when 'SMALL' then 'unknown' when 'LARGE' then 'Pinus pinea' when 'ECONOMY' then '--'"
            " else null end as specie",
            "case when p_partkey % 5 = 0 then cast(p_size as string) when p_partkey % 5 = 1 then concat(cast(p_size as string), ',5 cm')"
            " when p_partkey % 5 = 2 then concat('0.', cast(p_size as string), ' m') when p_partkey % 5 = 3 then '-' else null end as dbh",
            "case when p_partkey % 3 = 0 then concat(cast(10 * p_size as string), ' cm') when p_partkey % 3 = 1 then cast(p_size as string)"
            " else 'n/a' end as circonf",
        ],
    ),
    "fx_planning": (
        "events",
        [
            "cast(floor(event_id / 10000) as bigint) as region",
            "event_id as osm_num",
            "case when event_type in ('signup', 'click') then 'tree' else 'air_purifier' end as kind",
            "concat('P-', cast(event_id as string)) as id",
            "case when event_id % 3 = 0 then 'north' else 'south' end as input_name",
            "case when event_type in ('signup', 'click') then case when event_id % 2 = 0 then 'umbrella_pine' else 'palm' end"
            " else case when event_id % 2 = 0 then 'compact_octagonal_tower' else 'compact_four_side_tower' end end as model",
            f"case when event_id % 5 in (0, 1) then {_d('3 + event_id % 7')} end as height_m",
            f"case when event_id % 5 in (1, 2) then {_d('1 + event_id % 4')} end as width_m",
            f"case when event_id % 5 = 3 then {_d('event_id % 800')} end as rotation_deg",
            f"{_d(11.2558)} + (((event_id * 7919) % 10007) - 5003) * {_d(0.0045)} / 5003 as lon",
            f"{_d(43.7696)} + (((event_id * 104729) % 10009) - 5004) * {_d(0.0033)} / 5004 as lat",
            "event_type",
        ],
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables of small rows and their keys: a file of them is one task's work to read, and geometry is heavy per byte.
SPREAD = {"customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = VIEWS[name]
    rows = table(spark, sf_dir, source)
    if source in SPREAD:
        rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), SPREAD[source])
    return rows.selectExpr(*[c.replace('"', "`") for c in columns])


def ctes(*names: str, extra: Sequence[tuple[str, str]] = ()) -> str:
    """``with`` clause for DuckDB holding the named views and further definitions."""
    parts = []
    for name in names:
        source, columns = VIEWS[name]
        parts.append(f"{name} as (select {', '.join(columns)} from {source})")
    parts += [f"{name} as ({sql})" for name, sql in extra]
    return "with " + ", ".join(parts) + " "


# Parametric tree models (name, aliases, height, crown radius, trunk radius, base fraction, shape).
TREE_MODELS = [
    ("columnar_conifer", ["columnar conifer", "fastigiate conifer", "cypress form"], 18.0, 2.3, 0.1449, 0.2, "conical"),
    ("fastigiate_broadleaf", ["fastigiate broadleaf", "columnar broadleaf"], 14.0, 2.4, 0.085, 0.34, "columnar"),
    ("generic_round_broadleaf", ["generic broadleaf"], 11.0, 3.5, 0.06, 0.35, "ellipsoid"),
    (
        "large_round_broadleaf",
        ["large round broadleaf", "decurrent broadleaf", "round broadleaf"],
        16.0,
        5.2,
        0.1399,
        0.34,
        "ellipsoid",
    ),
    ("palm_tuft", ["palm", "tuft crown"], 11.0, 2.0, 0.075, 0.74, "tuft"),
    (
        "pyramidal_conifer",
        ["pyramidal conifer", "excurrent conifer", "conical conifer"],
        16.0,
        3.9,
        0.18,
        0.24,
        "conical",
    ),
    (
        "small_round_broadleaf",
        ["small round broadleaf", "ornamental broadleaf", "fruit tree"],
        8.5,
        2.8,
        0.0684,
        0.36,
        "rounded",
    ),
    ("umbrella_pine", ["umbrella pine", "pinus pinea form"], 14.0, 5.3, 0.3024, 0.58, "umbrella"),
    ("weeping_broadleaf", ["weeping broadleaf", "pendulous broadleaf"], 9.0, 3.8, 0.095, 0.42, "ellipsoid"),
]
# Species of the driver views and their model categories.
SPECIES_MAP = [
    ("Tilia", "large_round_broadleaf"),
    ("Tilia cordata", "large_round_broadleaf"),
    ("Acer campestre", "small_round_broadleaf"),
    ("Pinus pinea", "umbrella_pine"),
    ("Cupressus", "columnar_conifer"),
    ("Quercus ilex", "large round broadleaf"),
]


def tree_models(spark: SparkSession) -> DataFrame:
    rows = [(i, *m) for i, m in enumerate(TREE_MODELS)]
    return spark.createDataFrame(
        rows,
        "model_no int, name string, aliases array<string>, default_height_m double, default_crown_radius_m double, "
        "default_trunk_radius_m double, crown_base_fraction double, crown_shape string",
    )


def species_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i, *s) for i, s in enumerate(SPECIES_MAP)], "entry_no int, species string, category string"
    )


def purifier_catalogue(spark: SparkSession) -> DataFrame:
    # The two purifier towers.
    rows = [
        ("compact_octagonal_tower", "octagonal", "models/compact_octagonal_tower.stl", 4.0, 1.5, None, None, 0.002),
        ("compact_four_side_tower", "four_side", "models/compact_four_side_tower.stl", 4.0, None, 1.5, 1.5, 0.002),
    ]
    return spark.createDataFrame(
        rows,
        "name string, kind string, output_path string, height_m double, base_width_m double, width_m double, "
        "depth_m double, linear_tolerance_m double",
    )
