"""Connected components by contraction: hook to the smallest neighbour, shorten, relabel, repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.session import materialise


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node in ``links(a, b)``; a component is named by its smallest node.

    Every round keeps only links between different components, so they shrink quickly. Each
    table is written: joins read plain files, and adaptive execution can split a hub's rows.
    Self-links, repeated links and links with a null end add nothing.
    """
    links = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = materialise(links.distinct(), "links")
    labels = None
    while True:
        both = links.union(links.select("b", "a")).toDF("node", "near")
        hooks = both.groupBy("node").agg(F.min("near").alias("root")).filter("root < node")
        hooks = materialise(hooks, "hooks")
        if hooks.isEmpty():
            break
        hooks = _shorten(hooks)
        labels = hooks if labels is None else materialise(_follow(labels, hooks), "labels")
        links = links.transform(_relabel, hooks, "a").transform(_relabel, hooks, "b").filter("a <> b")
        links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        links = materialise(links, "links")
    if labels is None:
        node = links.select(F.col("a").alias("node"), F.col("a").alias("component"))
        return node.limit(0)
    found = labels.select("node", F.col("root").alias("component"))
    own = found.select(F.col("component").alias("node"), "component").distinct()
    return found.union(own)


def _relabel(links: DataFrame, hooks: DataFrame, end: str) -> DataFrame:
    other = "b" if end == "a" else "a"
    joined = links.join(hooks, links[end] == hooks["node"], "left")
    return joined.select(F.coalesce("root", end).alias(end), other)


def _follow(labels: DataFrame, hooks: DataFrame) -> DataFrame:
    """Labels one step further; a component may have become a member of another one."""
    up = hooks.toDF("_node", "_root")
    moved = labels.join(up, labels["root"] == up["_node"], "left")
    moved = moved.select("node", F.coalesce("_root", "root").alias("root"))
    return moved.union(hooks.join(labels.select("node"), "node", "left_anti").select("node", "root"))


def _shorten(hooks: DataFrame) -> DataFrame:
    """Pointer jumping until every hook ends at a root."""
    while True:
        up = hooks.toDF("_node", "_root")
        jumped = hooks.join(up, hooks["root"] == up["_node"], "left")
        jumped = jumped.select("node", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("_moved"))
        jumped = materialise(jumped, "jumped")
        moved = not jumped.filter("_moved").isEmpty()
        hooks = jumped.drop("_moved")
        if not moved:
            return hooks
