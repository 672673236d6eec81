"""Exact distribution of a score column, without pulling it to one place."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators.ordering import running_totals

QUARTILES = (0.25, 0.5, 0.75)


def score_histogram(df: DataFrame, column: str, bins: int = 20, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Count and density per equal bin of [low, high]; ``high`` itself belongs to the last bin.

    Values below are in bin -1, those above in bin ``bins``.
    """
    value = F.col(column).cast("double")
    inside = F.least(F.floor((value - low) * bins / (high - low)), F.lit(bins - 1))
    place = F.when(value < low, F.lit(-1).cast("long")).when(value > high, F.lit(bins).cast("long")).otherwise(inside)
    counted = (
        df.filter(value.isNotNull())
        .groupBy(place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # One row per bin: the grand total is a sum over at most ``bins`` rows.
    total = counted.agg(F.sum("n")).first()[0] or 1
    return counted.withColumn("density", F.col("n") * bins / ((high - low) * total))


def score_box(df: DataFrame, column: str) -> DataFrame:
    """One row: quartiles (interpolated), whisker fences and the number of outlying points.

    Equal values fold to counts, whose running totals place every value; only
    the few rows that hold a quartile are kept.
    """
    value = F.col(column).cast("double")
    counts = (
        df.filter(value.isNotNull())
        .groupBy(value.alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("all", F.lit(1))
    )
    placed = running_totals(counts, ["all"], ["value"], ["n"])
    total = placed.agg(F.sum("n")).first()[0] or 0
    at = [(q, p, math.floor(p), math.ceil(p)) for q in QUARTILES for p in [q * max(total - 1, 0)]]

    def value_at(i: int):
        here = (F.col("n_before") <= i) & (F.col("n_before") + F.col("n") > i)
        return F.max(F.when(here, F.col("value")))

    quartiles = placed.agg(
        *[
            (value_at(lo) + (value_at(hi) - value_at(lo)) * (p - lo)).alias(f"q{int(q * 100)}")
            for q, p, lo, hi in at
        ]
    ).first()
    q25, q75 = quartiles["q25"], quartiles["q75"]
    if q25 is None:
        low = high = None
    else:
        low, high = q25 - 1.5 * (q75 - q25), q75 + 1.5 * (q75 - q25)
    outlying = F.sum(F.when((F.col("value") < low) | (F.col("value") > high), F.col("n")).otherwise(0))
    return placed.agg(
        F.sum("n").alias("n"),
        F.lit(q25).alias("q25"),
        F.lit(quartiles["q50"]).alias("q50"),
        F.lit(q75).alias("q75"),
        F.lit(low).alias("low_fence"),
        F.lit(high).alias("high_fence"),
        outlying.alias("n_outlying"),
    )


def outlying_rows(df: DataFrame, column: str) -> DataFrame:
    """The rows beyond the whiskers of ``score_box``: 1.5 times the distance of the quartiles away."""
    box = score_box(df, column).select("low_fence", "high_fence").first()
    value = F.col(column).cast("double")
    if box["low_fence"] is None:
        return df.limit(0)
    return df.filter((value < box["low_fence"]) | (value > box["high_fence"]))


#: Bins to a bandwidth, and bandwidths from a value at which its kernel has died out.
FINE, REACH = 1000, 9.0


def kernel_bandwidth(df: DataFrame, column: str) -> float:
    """0.9 times the smaller of deviation and quartile distance / 1.34, times n to the power -1/5; 0 if constant."""
    value = F.col(column).cast("double")
    moments = df.agg(F.count(value).alias("n"), F.stddev_samp(value).alias("sd")).first()
    if moments["n"] < 2:
        return 0.0
    box = score_box(df, column).select("q25", "q75").first()
    widths = [w for w in (moments["sd"], (box["q75"] - box["q25"]) / 1.34) if w > 0]
    return 0.9 * min(widths, default=0.0) * moments["n"] ** -0.2


def score_density(df: DataFrame, column: str, low: float, high: float, points: int, bandwidth: float | None = None) -> DataFrame:
    """``(x, density)``: a Gaussian kernel density at ``points`` equal places from ``low`` to ``high``.

    Each value is shared out between the two bins around it, far finer than the kernel; then bins
    meet only the places in reach of their kernel. Nulls don't count; without two different
    values there are no rows.
    """
    value = F.col(column).cast("double")
    known = df.filter(value.isNotNull()).select(value.alias("v"))
    width = kernel_bandwidth(df, column) if bandwidth is None else bandwidth
    if not width > 0:
        return df.sparkSession.createDataFrame([], "x double, density double")
    step, gap = width / FINE, (high - low) / (points - 1)
    at = F.col("v") / step
    part = at - F.floor(at)
    sides = F.explode(F.array(F.struct(F.floor(at).alias("bin"), (1 - part).alias("w")), F.struct((F.floor(at) + 1).alias("bin"), part.alias("w"))))
    bins = known.select(sides.alias("s")).groupBy("s.bin").agg(F.sum("s.w").alias("w"))
    middle = F.col("bin") * step
    first = F.greatest(F.ceil((middle - REACH * width - low) / gap), F.lit(0))
    last = F.least(F.floor((middle + REACH * width - low) / gap), F.lit(points - 1))
    met = bins.withColumns({"_a": first, "_b": last}).filter("_a <= _b").select("bin", "w", F.explode(F.sequence("_a", "_b")).alias("i"))
    away = (F.col("i") * gap + low - middle) / width
    total = known.count() * width * math.sqrt(2 * math.pi)
    summed = met.groupBy("i").agg((F.sum(F.col("w") * F.exp(-0.5 * away * away)) / total).alias("density"))
    every = df.sparkSession.range(points).withColumnRenamed("id", "i").join(summed, "i", "left")
    return every.select((F.col("i") * gap + low).alias("x"), F.coalesce("density", F.lit(0.0)).alias("density"))
