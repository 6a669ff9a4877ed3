"""Stateless enrichment of element points, usable on batch and streaming DataFrames alike.

Classification, distance and zone are plain expressions without state, so a
stream of points needs no watermark; joins against footprints are ordinary
stream-static joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions import measure as M
from geoloom.operators.classify import DEFAULT_RULES, Rule, classify
from geoloom.params import Region


def enrich_points(points: DataFrame, region: Region, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """``tags, lon, lat`` rows with category, group, source tag, distance and zone; unclassified rows dropped."""
    df = points.withColumn("_cls", classify(F.col("tags"), rules)).where("_cls is not null")
    distance = M.point_roi_distance_m(F.col("lon"), F.col("lat"), region)
    return (
        df.withColumns(
            {
                "category": F.col("_cls.category"),
                "group_tag": F.col("_cls.group_tag"),
                "source_tag": F.col("_cls.source_tag"),
                "roi_distance_m": F.round(distance, 3),
                "roi_zone": M.roi_zone(distance, region, outside="outside"),
            }
        )
        .drop("_cls")
    )
