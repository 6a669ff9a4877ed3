"""Count reports and uniqueness checks as grouping sets in long form."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.params import CATEGORIES


def long_counts(df: DataFrame, metrics: dict[str, tuple[Column, Column]]) -> DataFrame:
    """``(metric, key, n)``: per metric a key column and a row condition, counted in one pass."""
    rows = F.array(
        *[
            F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(m).alias("metric"), key.cast("string").alias("key")))
            for m, (key, cond) in metrics.items()
        ]
    )
    return (
        df.select(F.explode(F.array_compact(rows)).alias("_r"))
        .groupBy(F.col("_r.metric").alias("metric"), F.col("_r.key").alias("key"))
        .agg(F.count("*").alias("n"))
    )


def geometry_diagnostics(features: DataFrame) -> DataFrame:
    """Contributing and other features by category and geometry type."""
    yes, always = F.col("contributes_to_geometry"), F.lit(True)
    return long_counts(
        features,
        {
            "contributing": (F.when(yes, "contributing").otherwise("non_contributing"), always),
            "geometry_type": (F.col("geom_type"), always),
            "contributing_by_category": (F.col("category"), yes),
            "non_contributing_by_category": (F.col("category"), ~yes),
            "non_contributing_by_geometry_type": (F.col("geom_type"), ~yes),
        },
    )


def non_contributing(features: DataFrame) -> DataFrame:
    return features.where(~F.col("contributes_to_geometry"))


def feature_summary(features: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """By category (zeros included), group tag, source tag, zone, and unmapped terrain."""
    always = F.lit(True)
    counted = long_counts(
        features,
        {
            "by_category": (F.col("category"), always),
            "by_group_tag": (F.col("group_tag"), always),
            "by_source_tag": (F.col("source_tag"), always),
            "by_roi_zone": (F.col("roi_zone"), always),
            "available_not_mapped_to_core": (F.col("source_tag"), F.col("category") == "other_terrain"),
        },
    )
    spark = features.sparkSession
    zeros = spark.createDataFrame([(c,) for c in categories], "key string").select(
        F.lit("by_category").alias("metric"), "key", F.lit(0).cast("bigint").alias("n")
    )
    return counted.unionByName(zeros).groupBy("metric", "key").agg(F.sum("n").alias("n"))


def skipped_by_reason(features: DataFrame) -> DataFrame:
    return features.where("skip_reason is not null").groupBy("skip_reason").agg(F.count("*").alias("n"))


def supplemental_statistics(inputs: DataFrame, features: DataFrame) -> DataFrame:
    """Per configured input: enabled flag and loaded features (zero when none)."""
    loaded = features.groupBy(F.col("supplemental_input_id").alias("name")).agg(F.count("*").alias("loaded_features"))
    return inputs.join(loaded, "name", "left").withColumn(
        "loaded_features", F.when(F.col("enabled"), F.coalesce("loaded_features", F.lit(0))).otherwise(F.lit(0))
    )


def supplemental_totals(statistics: DataFrame) -> DataFrame:
    kind = F.when(F.col("category") == "trees", "trees").otherwise("surfaces")
    return statistics.groupBy(kind.alias("kind")).agg(
        F.count("*").alias("configured_inputs"),
        F.count_if("enabled").alias("enabled_inputs"),
        F.sum("loaded_features").alias("loaded_features"),
    )


def planning_counts(features: DataFrame) -> DataFrame:
    """Accepted and outside features per input and kind with all subtotals (null = all)."""
    return features.cube("urban_planning_input_id", "kind").agg(
        F.count("*").alias("source_features"),
        F.count_if(F.col("roi_zone") != "outside").alias("accepted_features"),
        F.count_if(F.col("roi_zone") == "outside").alias("outside_roi"),
    )


def outside_records(features: DataFrame) -> DataFrame:
    return features.where(F.col("roi_zone") == "outside").select(
        "urban_planning_input_id", "source_feature_index", "id", "kind", "lon", "lat", "roi_distance_m"
    )


def duplicate_keys(df: DataFrame, key: Column | str, location: Sequence[str]) -> DataFrame:
    """Keys used more than once, with the first location and the number of uses."""
    column = F.col(key) if isinstance(key, str) else key
    return (
        df.groupBy(column.alias("key"))
        .agg(F.count("*").alias("uses"), F.min(F.struct(*location)).alias("_first"))
        .where("uses > 1")
        .select("key", "uses", *[F.col(f"_first.{c}").alias(f"first_{c}") for c in location])
    )


def source_prefix_counts(df: DataFrame, columns: dict[str, str], prefixes: Sequence[str]) -> DataFrame:
    """Per dimension column: how many rows took the value from each kind of source."""
    metrics = {
        f"{name}|{prefix}": (F.lit(prefix), F.col(column).startswith(f"{prefix}:"))
        for name, column in columns.items()
        for prefix in prefixes
    }
    counted = long_counts(df, metrics)
    return counted.select(F.split_part("metric", F.lit("|"), F.lit(1)).alias("field"), F.col("key").alias("source"), "n")


def confidence_statistics(candidates: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return candidates.groupBy(*by).agg(
        F.count("confidence").alias("n"),
        F.round(F.min("confidence"), 4).alias("min_confidence"),
        F.round(F.max("confidence"), 4).alias("max_confidence"),
        F.round(F.avg("confidence"), 4).alias("mean_confidence"),
    )


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
