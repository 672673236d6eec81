"""Inputs of the registered queries, derived from the given tables by Spark.

Orders relate customers to suppliers: each line item is one candidate link from
a customer (patient) to a supplier (provider). Tables many queries start from are
written once per session, as the real job writes its bronze and silver tables.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.config import Params
from linkloom.functions.draws import draw, driver_draw
from linkloom.model import SageLayer, SageModel, drawn_model
from linkloom.operators.graph import build_edges, count_nodes, node_features
from linkloom.operators.ordering import assign_batches, positional_index, split_edges
from linkloom.plans.lockstep import write_file
from linkloom.session import materialise, scratch_path, shared_file, spread
from linkloom.streaming.jobs import silver_rows

# Fixed values shared with the comparison SQL.
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
PURCHASER_ENDINGS = (" LLC", ", Ltd.", " Inc", "")
WIDTHS = (4, 8, 4)
WIDE, WIDE_LAYER = (15, 20), 5
MODEL_SEED = 3
FEATURE_SEED = 5
RUN = Params(num_negative_samples=3, num_node_features=4, num_hidden_graph_layers=8)
ARCHIVE_ROWS = 5000

_stored: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf: str, name: str, build: Callable[[], object]):
    """``build()`` the first time in this session, its result afterwards."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _stored:
        _stored[key] = build()
    return _stored[key]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _ending(key: str):
    return F.array(*[F.lit(e) for e in PURCHASER_ENDINGS])[(F.col(key) % 4).cast("int")]


def relations(spark: SparkSession, sf: str) -> DataFrame:
    """Candidate links with party names and a confidence, one per line item."""
    customer = table(spark, sf, "customer")
    shift = customer.agg(F.max("c_custkey")).first()[0] + 1
    # Names meet the orders first: there are fewer of them than line items.
    orders = table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return (
        spread(table(spark, sf, "lineitem").select(*KEYS))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            *KEYS,
            F.col("o_custkey").alias("src_id"),
            (F.col("l_suppkey") + shift).alias("dst_id"),
            F.concat("c_name", _ending("l_orderkey")).alias("Purchaser"),
            F.concat("s_name", _ending("l_linenumber")).alias("Seller"),
            draw(1, *[F.col(k) for k in KEYS]).alias("probability"),
        )
    )


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf, "bronze", lambda: materialise(relations(spark, sf), "bronze"))


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver_rows(bronze(spark, sf))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze with a drawn prediction; unknown for some lines."""
    drawn = draw(2, *[F.col(k) for k in KEYS])
    return bronze(spark, sf).withColumn(
        "gnn_prediction", F.when(F.col("l_linenumber") != 7, drawn)
    )


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """``(eid, src, dst, split)`` of the silver relations."""

    def build():
        placed = build_edges(silver(spark, sf), KEYS)
        labelled = split_edges(placed, placed.count(), RUN.test_p, RUN.valid_p)
        return materialise(labelled, "split_edges", ("split",))

    return once(spark, sf, "edges", build)


def split(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return edges(spark, sf).filter(F.col("split") == name).drop("split")


def n_nodes(spark: SparkSession, sf: str) -> int:
    return once(spark, sf, "n_nodes", lambda: count_nodes(edges(spark, sf)))


def nodes(spark: SparkSession, sf: str) -> DataFrame:
    return spark.range(n_nodes(spark, sf))


def node_x(spark: SparkSession, sf: str, width: int = WIDTHS[0]) -> DataFrame:
    return node_features(nodes(spark, sf), width, FEATURE_SEED)


def model(kind: str = "mean") -> SageModel:
    return drawn_model(WIDTHS, kind, MODEL_SEED)


def wide_layer(kind: str = "mean") -> SageLayer:
    """One convolution of the untuned run's size; its weights are drawn as layer WIDE_LAYER."""
    n_in, n_out = WIDE
    shapes = {"self": (n_out, n_in), "neigh": (n_out, n_in), "bias": (n_out, 1), "pool": (n_in, n_in), "pool_bias": (n_in, 1)}
    drawn = {}
    for part, shape in shapes.items():
        values = [driver_draw(MODEL_SEED, WIDE_LAYER, part, *at) - 0.5 for at in np.ndindex(shape)]
        drawn[part] = np.array(values).reshape(shape)
    pool = (drawn["pool"], drawn["pool_bias"][:, 0]) if kind != "mean" else (None, None)
    return SageLayer(drawn["self"], drawn["neigh"], drawn["bias"][:, 0], kind, *pool)


def batched(spark: SparkSession, sf: str) -> DataFrame:
    """All silver edges in shuffled batches, each with its split."""
    return once(
        spark,
        sf,
        "batched",
        lambda: materialise(
            assign_batches(
                edges(spark, sf), "eid", RUN.batch_size, RUN.seed
            ),
            "batched",
        ),
    )


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """Drawn labels and tied scores ``(batch_id, eid, split, label, score)`` for every edge."""
    return batched(spark, sf).select(
        "batch_id",
        "eid",
        "split",
        (draw(21, F.col("eid")) < 0.5).cast("int").alias("label"),
        ((F.floor(draw(22, F.col("eid")) * 20) - 10) / F.lit(5.0)).alias("score"),
    )


def patient_locations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), *_place("c_custkey", 31))


def patient_scores(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("score"))


def provider_locations(spark: SparkSession, sf: str) -> DataFrame:
    shift = table(spark, sf, "customer").agg(F.max("c_custkey")).first()[0] + 1
    s = table(spark, sf, "supplier")
    return s.select((F.col("s_suppkey") + shift).alias("id"), *_place("s_suppkey", 33))


def _place(key: str, seed: int):
    """Six-decimal coordinates within one degree of a point."""
    return (
        F.round(45.0 + draw(seed, F.col(key)), 6).alias("lat"),
        F.round(9.0 + draw(seed + 1, F.col(key)), 6).alias("lon"),
    )


def csv_of(df: DataFrame, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.write.option("header", True).csv(path)
    return path


def landing_json(df: DataFrame, label: str = "landing") -> str:
    """A landing folder with the rows as JSON lines."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("ignoreNullFields", False).json(path)
    return path


def zipped(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows as JSON lines in archives ``(path, content)`` of bounded size."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("relations.json", "\n".join(part["line"]))
        name = f"landing-{part['archive_id'].iloc[0]}.zip"
        return pd.DataFrame({"path": [name], "content": [buffer.getvalue()]})

    lines = positional_index(df, keys, "_at").select(
        F.floor(F.col("_at") / ARCHIVE_ROWS).alias("archive_id"),
        F.to_json(F.struct(*df.columns)).alias("line"),
    )
    return lines.groupBy("archive_id").applyInPandas(pack, "path string, content binary")


def write_zipped(df: DataFrame, keys: list[str], folder: str) -> None:
    """The archives of ``zipped`` as files of a folder, written by the tasks."""

    def write(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, root = shared_file(folder)
                system.create_dir(root, recursive=True)
                write_file(system, f"{root}/{name}", content)
            yield batch.select(["path"])

    zipped(df, keys).mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()
