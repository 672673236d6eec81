"""Losses and ranking metrics over ``scores(..., label, score)`` with raw scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.vectors import sigmoid
from linkloom.operators.ordering import running_totals


def bce_terms() -> Column:
    """Binary cross entropy of one row, from the logit."""
    s, y = F.col("score"), F.col("label")
    return F.greatest(s, F.lit(0.0)) - s * y + F.log1p(F.exp(-F.abs(s)))


def bce_loss(scores: DataFrame, group: list[str]) -> DataFrame:
    return scores.groupBy(*group).agg(F.avg(bce_terms()).alias("bce_loss"))


def margin_loss(pos: DataFrame, neg: DataFrame, group: list[str]) -> DataFrame:
    """Mean over each edge ``eid`` and its corruptions of the hinge at margin 1.

    Corruptions drawn beside their edge bring its score as ``edge_score``; others look it up.
    """
    if "edge_score" not in neg.columns:
        neg = neg.join(pos.select("eid", F.col("score").alias("edge_score")), "eid")
    hinge = F.greatest(F.lit(0.0), sigmoid(F.col("score")) - sigmoid(F.col("edge_score")) + 1.0)
    return neg.groupBy(*group).agg(F.avg(hinge).alias("margin_loss"))


def _score_counts(scores: DataFrame, group: list[str]) -> DataFrame:
    """Positives and negatives per distinct score: ties fold before any ordering."""
    return scores.groupBy(*group, "score").agg(
        F.sum(F.col("label").cast("bigint")).alias("pos"),
        F.sum((1 - F.col("label")).cast("bigint")).alias("neg"),
    )


def _fold_metrics(counted: DataFrame, group: list[str]) -> DataFrame:
    """AUC and average precision from counts at a score, below it (``_before``) and in all.

    AUC: a positive wins against every negative below it and half of its ties.
    Average precision: precision at each distinct score, weighted by its recall.
    """
    pos_above = F.col("_p") - F.col("pos_before")
    all_above = pos_above + F.col("_n") - F.col("neg_before")
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") * F.lit(0.5)))
    n_pos, n_neg = F.max("_p"), F.max("_n")
    area = wins / (n_pos.cast("double") * n_neg)
    steps = F.sum(F.try_divide(F.col("pos"), F.col("_p")) * (pos_above / all_above))
    return counted.groupBy(*group).agg(
        F.when((n_pos > 0) & (n_neg > 0), area).alias("auc"),
        F.when(n_pos > 0, steps).alias("ap"),
    )


def batch_metrics(scores: DataFrame, group: list[str]) -> DataFrame:
    """``auc`` and ``ap`` for groups bounded by the batch size.

    Rows move once, by group; counts, windows and the fold all use that placement.
    """
    below = (
        Window.partitionBy(*group)
        .orderBy("score")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*group)
    placed = scores.select(*group, "label", "score").repartition(*group)
    counted = _score_counts(placed, group).select(
        "*",
        *[F.coalesce(F.sum(c).over(below), F.lit(0)).alias(f"{c}_before") for c in ("pos", "neg")],
        F.sum("pos").over(whole).alias("_p"),
        F.sum("neg").over(whole).alias("_n"),
    )
    return _fold_metrics(counted, group)


def split_metrics(scores: DataFrame, group: list[str]) -> DataFrame:
    """``auc`` and ``ap`` for groups of any size, such as a whole split."""
    counted = running_totals(_score_counts(scores, group), group, ["score"], ["pos", "neg"])
    totals = counted.groupBy(*group).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return _fold_metrics(counted.join(totals, group), group)


def mean_metrics(metrics: DataFrame, group: list[str]) -> DataFrame:
    """Unweighted means of per-batch metrics; batches of one class are left out."""
    return metrics.groupBy(*group).agg(F.avg("auc").alias("mean_auc"), F.avg("ap").alias("mean_ap"))
