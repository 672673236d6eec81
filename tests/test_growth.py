"""Work that must not turn over, from broadcasts to shuffles or from scans to joins, as tables grow."""

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from linkloom.model import drawn_model
from linkloom.operators import metrics, nearest, sampling
from linkloom.plans import evaluate as ev
from linkloom.plans.train import train_head
from linkloom.session import materialise, scratch_path
from linkloom.streaming import fresh


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_corruptions_with_their_edge_score_need_no_join(spark):
    pos = spark.range(50).select(F.col("id").alias("eid"), (F.col("id") % 2).alias("split"), (F.col("id") / 9 - 2).alias("score"))
    neg = pos.withColumnRenamed("score", "edge_score").select("*", F.explode(F.array(F.lit(-1.0), F.lit(0.5))).alias("score"))
    beside = metrics.margin_loss(pos, neg, ["split"])
    looked_up = metrics.margin_loss(pos, neg.drop("edge_score"), ["split"])
    assert "Join" not in plan_of(beside)
    assert np.allclose(sorted(r.margin_loss for r in beside.collect()), sorted(r.margin_loss for r in looked_up.collect()))


def test_step_metrics_move_scores_once(spark):
    scores = materialise(
        spark.range(400).select((F.col("id") % 4).alias("batch_id"), (F.col("id") % 3 == 0).cast("int").alias("label"), (F.col("id") % 7 / 7.0).alias("score")),
        "scores",
    )
    found = ev.step_metrics(scores, "run")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        moved = [x for x in plan_of(ev.step_metrics(scores, "run")).splitlines() if "Exchange" in x and "Reused" not in x and "hashpartitioning" in x]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(moved) == 1
    assert found.count() == 12


def test_cells_out_of_reach_are_dropped_before_they_are_looked_up(spark, monkeypatch):
    kept = []

    def written(df, label, *more):
        out = materialise(df, label, *more)
        if label == "kept_cells":
            kept.append(plan_of(df))
        return out

    monkeypatch.setattr(nearest, "materialise", written)
    at = lambda s: ((F.abs(F.hash("id", F.lit(s))) % 10_000) / 10_000.0)
    providers = spark.range(300).select("id", (45 + at(1)).alias("lat"), (9 + at(2)).alias("lon"))
    found = nearest.nearest_providers(providers.limit(40), providers, 2)
    assert found.count() == 80 and found.filter("km = 0").count() == 40
    assert all("_reach" in p[p.index("Join") :] for p in kept[1:])


def test_fresh_embeddings_broadcast_no_table_of_nodes(spark, monkeypatch):
    plans = []

    def written(df, label, *more):
        out = materialise(df, label, *more)
        plans.append(plan_of(df))
        return out

    monkeypatch.setattr(fresh, "materialise", written)
    model = drawn_model((4, 8, 4), "mean", 3)
    state = fresh.FreshEmbeddings(spark, scratch_path(spark, "fresh"), model, 5, buckets=2)
    for version in range(2):
        links = spark.range(30).select((F.col("id") % 9).alias("src"), (F.col("id") % 5 + 10 + version).alias("dst"))
        state.add(links, version)
    assert not [p for p in plans if "BroadcastHashJoin" in p]
    assert state.embeddings().count() == 15


def test_the_link_head_joins_alike_at_every_size(spark, monkeypatch):
    plans = []
    fit = LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, df: plans.append(plan_of(df)) or fit(self, df))
    x = materialise(spark.range(20).select("id", F.array(F.rand(1), F.rand(2)).alias("x")), "x")
    edges = spark.range(60).select(F.col("id").alias("eid"), (F.col("id") % 20).alias("src"), (F.col("id") * 7 % 20).alias("dst"))
    train_head(x, sampling.label_and_stack(edges, sampling.negative_edges(edges, 20, 1, 7).drop("nth")))
    assert "SortMergeJoin" in plans[0] and "BroadcastHashJoin" not in plans[0]
