"""Relations as a directed multigraph of edge and node tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.draws import normal
from linkloom.operators.ordering import positional_index


def edge_table(relations: DataFrame) -> DataFrame:
    """Just the two ids, still distributed."""
    return relations.select("src_id", "dst_id")


def build_edges(relations: DataFrame, keys: list[str]) -> DataFrame:
    """``edges(eid, src, dst)``: the edge id is the row's position by ``keys``."""
    ids = relations.select(*keys, F.col("src_id").alias("src"), F.col("dst_id").alias("dst"))
    return positional_index(ids, keys, "eid", ["src", "dst"]).select("eid", "src", "dst")


def graph_summary(edges: DataFrame) -> DataFrame:
    """One row: node count (largest id + 1) and edge count."""
    return edges.agg(
        (F.coalesce(F.max(F.greatest("src", "dst")), F.lit(-1)) + 1).alias("n_nodes"),
        F.count(F.lit(1)).alias("n_edges"),
    )


def count_nodes(edges: DataFrame) -> int:
    return graph_summary(edges).first()["n_nodes"]


def dense_nodes(edges: DataFrame, n_nodes: int | None = None) -> DataFrame:
    """``nodes(id)`` from 0 to the largest id; ids without edges are isolated nodes."""
    return edges.sparkSession.range(count_nodes(edges) if n_nodes is None else n_nodes)


def endpoint_nodes(edges: DataFrame) -> DataFrame:
    """``nodes(id)`` that have at least one edge."""
    both = F.explode(F.array("src", "dst")).alias("id")
    return edges.select(both).distinct()


def node_features(nodes: DataFrame, width: int, seed: int) -> DataFrame:
    """One standard-normal vector per node, the same in every split and run."""
    x = F.array(*[normal(seed, F.col("id"), F.lit(i)) for i in range(width)])
    return nodes.select("id", x.alias("x"))


def stored_features(nodes: DataFrame, vectors: DataFrame, n_vectors: int) -> DataFrame:
    """Real feature vectors ``vectors(vec_id, embedding)``, shared out by node id."""
    wanted = nodes.withColumn("vec_id", F.col("id") % n_vectors)
    return wanted.join(vectors.select("vec_id", "embedding"), "vec_id").select(
        "id", F.col("embedding").cast("array<double>").alias("x")
    )


def degree_profile(edges: DataFrame) -> DataFrame:
    """How many nodes have a given in- or out-degree: the hub-and-spoke shape."""
    ends = F.explode(
        F.array(
            F.struct(F.lit("out").alias("direction"), F.col("src").alias("node")),
            F.struct(F.lit("in").alias("direction"), F.col("dst").alias("node")),
        )
    )
    degrees = (
        edges.select(ends.alias("end"))
        .groupBy("end.direction", "end.node")
        .agg(F.count(F.lit(1)).alias("degree"))
    )
    return degrees.groupBy("direction", "degree").agg(F.count(F.lit(1)).alias("n_nodes"))


def parallel_counts(edges: DataFrame) -> DataFrame:
    """``links(src, dst, n)``: parallel edges folded into one row with their number.

    Sums over links weighted by ``n`` equal sums over edges, and copies of one
    pair meet in a partial aggregate instead of a join.
    """
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
