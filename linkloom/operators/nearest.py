"""The nearest providers of every patient, by a descent through cells that split where they are dense.

Providers lie in square cells of latitude and longitude, each cut into 16 while it holds more
than a few. All patients go down together: of the cells a patient still has, those are kept that
may hold one of its ``k`` nearest, judged by the least and the greatest distance of a cell and
its number of providers. So a patient keeps a few cells at every level, however many providers or
patients crowd into one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.operators.recommend import EARTH_KM, haversine_km
from linkloom.session import materialise

#: Levels, each with a quarter of the side of the one above; providers up to which a cell is whole.
LEVELS, CROWD = 11, 8
SIDE = 360.0  # of the first cell, in degrees


def _cell(level: int, lat: Column, lon: Column) -> list[Column]:
    side = SIDE / 4**level
    return [F.floor((lat + 180.0) / side).alias("row"), F.floor((lon + 180.0) / side).alias("col")]


def _least_km(lat: Column, lon: Column, row: Column, col: Column, side: Column) -> Column:
    """At most the distance to anything in the cell.

    The way there crosses the nearer parallel of the cell, or one of its meridians.
    """
    south, west = row * side - 180.0, col * side - 180.0
    up = F.greatest(south - lat, lat - (south + side), F.lit(0.0))
    east = F.pmod(west - lon, F.lit(360.0))  # degrees to go east, and west, to the cell
    back = F.pmod(lon - (west + side), F.lit(360.0))
    inside = (F.pmod(lon - west, F.lit(360.0)) <= side) | (side >= 360.0)
    turn = F.when(inside, 0.0).otherwise(F.least(east, back, F.lit(90.0)))
    across = F.asin(F.cos(F.radians(lat)) * F.sin(F.radians(turn)))
    return EARTH_KM * F.greatest(F.radians(up), across)


def _most_km(lat: Column, lon: Column, row: Column, col: Column, side: Column) -> Column:
    """At least the distance to anything in the cell: to its middle, then half its sides on."""
    middle = haversine_km(lat, lon, (row + 0.5) * side - 180.0, (col + 0.5) * side - 180.0)
    return middle + EARTH_KM * F.radians(side)


def _within_reach() -> Column:
    """Whether a cell that begins at ``least`` may hold one of the nearest, which lie within ``_reach``."""
    return F.col("_reach").isNull() | (F.col("least") <= F.col("_reach") * (1 + 1e-9) + 1e-6)


def provider_cells(points: DataFrame, crowd: int = CROWD, levels: int = LEVELS) -> list[DataFrame]:
    """For each level the cells ``(row, col, n, split)`` below split cells of the level above."""
    cells, inside = [], points
    for level in range(levels + 1):
        placed = inside.select("*", *_cell(level, F.col("lat"), F.col("lon")))
        here = placed.groupBy("row", "col").agg(F.count(F.lit(1)).alias("n"), F.sum("held").alias("_held"))
        split = (F.col("n") > crowd) if level < levels else F.lit(False)
        here = materialise(here.select("row", "col", F.col("_held").alias("n"), split.alias("split")), "cells")
        cells.append(here)
        crowded = here.filter("split").select("row", "col")
        if crowded.isEmpty():
            break
        inside = materialise(placed.join(crowded, ["row", "col"], "left_semi").drop("row", "col"), "crowded")
    return cells


def nearest_providers(
    patients: DataFrame, providers: DataFrame, k: int, crowd: int = CROWD, levels: int = LEVELS
) -> DataFrame:
    """``(src_id, dst_id, km, rank)``: the ``k`` nearest of ``providers(id, lat, lon)`` of each patient.

    Distances are great-circle ones; equal distances go by id. Providers at the very same place
    are one place, of which the ``k`` smallest ids matter. Rows without an id or coordinates, or
    with coordinates beyond 90 and 180 degrees, are left out. A patient with fewer than ``k``
    providers in all gets all of them. Repeated ids are rows of their own.
    """
    real = "id is not null and abs(lat) <= 90 and abs(lon) <= 180"
    providers = providers.filter(real).select("id", *(F.col(c).cast("double").alias(c) for c in ("lat", "lon")))
    at_place = Window.partitionBy("lat", "lon").orderBy("id")
    first = providers.withColumn("_nth", F.row_number().over(at_place)).filter(F.col("_nth") <= k)
    points = first.groupBy("lat", "lon").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    points = materialise(points.withColumn("held", F.size("ids").cast("long")), "places")
    patients = patients.filter(real).select(
        F.col("id").alias("src_id"), F.col("lat").cast("double").alias("_la"), F.col("lon").cast("double").alias("_lo")
    )
    patients = materialise(patients.withColumn("_p", F.monotonically_increasing_id()), "patients")

    # The first level is one cell, and one more for places at 180 degrees of longitude.
    here = patients.select("_p", "_la", "_lo", F.lit(0).cast("long").alias("row"), F.explode(F.array(F.lit(0), F.lit(1))).alias("col"))
    here = here.withColumn("_reach", F.lit(None).cast("double"))
    leaves = None
    by_reach = Window.partitionBy("_p").orderBy("most").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for level, cells in enumerate(provider_cells(points, crowd, levels)):
        side, at = F.lit(SIDE / 4**level), [F.col(c) for c in ("_la", "_lo", "row", "col")]
        met = here.join(cells, ["row", "col"]).withColumn("most", _most_km(*at, side)).withColumn("least", _least_km(*at, side))
        # A cell holds what its parent held or less, so the parent's reach already rules cells out.
        met = met.filter(_within_reach()).select("*", F.lit(level).alias("level"))
        known = met if leaves is None else met.unionByName(leaves.filter(_within_reach()))
        # The reach that surely holds k providers; a cell that begins beyond it is of no use.
        summed = known.withColumn("_sum", F.sum("n").over(by_reach))
        reach = F.min(F.when(F.col("_sum") >= k, F.col("most"))).over(Window.partitionBy("_p"))
        kept = summed.withColumn("_reach", reach).filter(_within_reach())
        kept = materialise(kept.drop("_sum"), "kept_cells")
        leaves = kept.filter("not split")
        deeper = F.explode(F.sequence(F.lit(0), F.lit(15))).alias("_q")
        going = kept.filter("split").select("_p", "_la", "_lo", "_reach", "row", "col", deeper)
        here = going.select(
            "_p", "_la", "_lo", "_reach", (F.col("row") * 4 + F.expr("_q div 4")).alias("row"), (F.col("col") * 4 + F.col("_q") % 4).alias("col")
        )
        # Judged before the cells are looked up, so those out of reach are not shipped.
        below = [F.col(c) for c in ("_la", "_lo", "row", "col")]
        here = here.withColumn("least", _least_km(*below, F.lit(SIDE / 4 ** (level + 1)))).filter(_within_reach()).drop("least")
    placed = None
    for level in range(levels + 1):
        of_level = points.select("ids", "lat", "lon", F.lit(level).alias("level"), *_cell(level, F.col("lat"), F.col("lon")))
        placed = of_level if placed is None else placed.unionByName(of_level)
    found = leaves.select("_p", "_la", "_lo", "level", "row", "col").join(placed, ["level", "row", "col"])
    found = found.withColumn("km", haversine_km(F.col("_la"), F.col("_lo"), F.col("lat"), F.col("lon")))
    found = found.select("_p", "km", F.explode("ids").alias("dst_id"))
    nearest = Window.partitionBy("_p").orderBy("km", "dst_id")
    found = found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
    return found.join(patients.select("_p", "src_id"), "_p").select("src_id", "dst_id", "km", "rank")
