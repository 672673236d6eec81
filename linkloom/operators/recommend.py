"""Tables behind the recommendations dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def recommend_top_k(gold: DataFrame, k: int) -> DataFrame:
    """The ``k`` likeliest providers of every patient, each provider once.

    Parallel relations fold before ranking, and ranks beyond ``k`` are cut
    before the shuffle.
    """
    best = gold.groupBy("src_id", "dst_id").agg(F.max("probability").alias("probability"))
    by_patient = Window.partitionBy("src_id").orderBy(F.col("probability").desc(), "dst_id")
    return best.withColumn("rank", F.row_number().over(by_patient)).filter(F.col("rank") <= k)


def unscored_links(bronze: DataFrame, silver: DataFrame, keys: list[str]) -> DataFrame:
    """Bronze rows that did not reach silver."""
    return bronze.join(silver.select(*keys).distinct(), keys, "left_anti")


def enrich(relations: DataFrame, scores: DataFrame, locations: DataFrame) -> DataFrame:
    """Relations with the patient's ``score`` and the provider's ``lat`` and ``lon``, where known.

    The side tables are files of known size, so the planner picks the join.
    """
    patient = scores.select(F.col("id").alias("src_id"), "score")
    provider = locations.select(F.col("id").alias("dst_id"), "lat", "lon")
    return relations.join(patient, "src_id", "left").join(provider, "dst_id", "left")


def unlinked_pairs(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """The distinct given pairs that join known nodes and are not edges."""
    known = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return (
        pairs.select("src", "dst")
        .distinct()
        .join(known.select(F.col("id").alias("src")), "src", "left_semi")
        .join(known.select(F.col("id").alias("dst")), "dst", "left_semi")
        .join(edges.select("src", "dst").distinct(), ["src", "dst"], "left_anti")
        .select("src", "dst")
    )


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.pow(F.sin(F.radians(lat2 - lat1) / 2.0), 2)
    half_lon = F.pow(F.sin(F.radians(lon2 - lon1) / 2.0), 2)
    chord = half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon
    return F.lit(2.0 * EARTH_KM) * F.asin(F.sqrt(F.greatest(F.least(chord, F.lit(1.0)), F.lit(0.0))))


def nearby_links(
    relations: DataFrame, patients: DataFrame, providers: DataFrame, km: float
) -> DataFrame:
    """Relations whose patient and provider are at most ``km`` apart, with the distance.

    Only related pairs are measured, by two joins on ids.
    """
    p = patients.select(F.col("id").alias("src_id"), F.col("lat").alias("_la"), F.col("lon").alias("_lo"))
    q = providers.select(F.col("id").alias("dst_id"), F.col("lat").alias("_lb"), F.col("lon").alias("_lp"))
    apart = haversine_km(F.col("_la"), F.col("_lo"), F.col("_lb"), F.col("_lp"))
    return (
        relations.join(p, "src_id")
        .join(q, "dst_id")
        .withColumn("km", apart)
        .filter(F.col("km") <= km)
        .drop("_la", "_lo", "_lb", "_lp")
    )
