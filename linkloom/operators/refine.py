"""Row-wise rules of the silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.names import base_name

# The confidence thresholds.
CONFIDENT = 0.55
TRIAGE_PREDICTION = 0.8
TRIAGE_PROBABILITY = 0.6


def confident_links(df: DataFrame, threshold: float = CONFIDENT) -> DataFrame:
    """Links at or above the threshold; an unknown probability is dropped."""
    return df.filter(F.col("probability") >= threshold)


def low_confidence_links(df: DataFrame, threshold: float = CONFIDENT) -> DataFrame:
    """The links ``confident_links`` leaves out for their low probability."""
    return df.filter(F.col("probability") < threshold)


def clean_parties(df: DataFrame) -> DataFrame:
    """Replace both party names by their base names, each from its own column."""
    return df.withColumns({c: base_name(F.col(c)) for c in ("Purchaser", "Seller")})


def triage_candidates(predictions: DataFrame) -> DataFrame:
    """Links the model likes and the source did not."""
    return predictions.filter(
        (F.col("gnn_prediction") > F.col("probability"))
        & (F.col("gnn_prediction") > TRIAGE_PREDICTION)
        & (F.col("probability") < TRIAGE_PROBABILITY)
    ).select("Purchaser", "Seller", "probability", "gnn_prediction")


def refine_probability(predictions: DataFrame) -> DataFrame:
    """Raise ``probability`` to the prediction; an unknown value on either side leaves it."""
    raised = F.when(
        F.col("gnn_prediction") >= F.col("probability"), F.col("gnn_prediction")
    ).otherwise(F.col("probability"))
    return predictions.withColumn("probability", raised).drop("gnn_prediction")
