"""Review counts of landing features by scene."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import points_in_boxes, points_in_polygons

TIERS = {"preferred": 2, "fallback": 1}


def scene_review(features: DataFrame, scenes: DataFrame, contexts: DataFrame, probes: DataFrame, polygons: DataFrame, size: float, bits: int = 11) -> DataFrame:
    """(scene, measure, label, n): what a reviewer compares between two runs of one scene.

    ``features`` (lon, lat, tier, flags) are counted in each of ``scenes`` (scene and edges, all of which belong): all
    of them, those of each tier, those with each of the lowest ``bits`` flags. ``contexts`` (scene, label and edges)
    count the features inside, ``probes`` (scene, label, lon, lat) the ``polygons`` that cover the point by the
    even-odd rule. A scene, context or probe that meets nothing counts 0; null coordinates lie nowhere."""
    edges = ("west", "south", "east", "north")
    inside = points_in_boxes(features, scenes.select("scene", *edges), size, closed=True)
    counts = {"features": F.count("*")} | {k: F.count_if(F.col("tier") == v) for k, v in TIERS.items()} | {f"flag {1 << k}": F.count_if(F.col("flags").bitwiseAND(F.lit(1 << k)) != 0) for k in range(bits)}
    found = inside.groupBy("scene").agg(*[c.alias(name) for name, c in counts.items()])
    whole = scenes.select("scene").join(found, "scene", "left").na.fill(0, list(counts)).unpivot("scene", list(counts), "measure", "n")
    own = points_in_boxes(features.select("lon", "lat"), contexts.select("scene", "label", *edges), size, closed=True)
    hits = points_in_polygons(probes.select("scene", "label", "lon", "lat"), polygons.select(*edges, "edges"), size)

    def by_label(names: DataFrame, rows: DataFrame, measure: str) -> DataFrame:
        n = rows.groupBy("scene", "label").agg(F.count("*").alias("n"))
        return names.select("scene", "label").join(n, ["scene", "label"], "left").select("scene", F.lit(measure).alias("measure"), "label", F.coalesce("n", F.lit(0)).alias("n"))

    return whole.select("scene", "measure", F.lit(None).cast("string").alias("label"), "n").unionByName(by_label(contexts, own, "context")).unionByName(by_label(probes, hits, "probe"))
