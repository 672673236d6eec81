"""Embeddings that follow the links as they arrive.

Both layers take means, so a node's state is the sum of what its in-links bring to each layer and
their number. Arriving links add to the sums of their destinations; where that changes a hidden
vector, the difference is added along the links that leave it. So a micro-batch reads and writes
the two-hop frontier of its links, and embeddings after any number of them are those of a full
pass over all links.

State and links are logs: a version is a folder with the rows it changed, spread over buckets of
ids. The same version written again replaces itself and reads only earlier ones, so a replayed
micro-batch changes nothing. Every ``FULL`` versions all rows are written, and older ones are no
longer read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkloom.functions.vectors import affine, linear, zeros
from linkloom.model import SageLayer, SageModel
from linkloom.operators.graph import node_features, parallel_counts
from linkloom.operators.refine import refine_probability
from linkloom.operators.scoring import predict_links
from linkloom.session import materialise, shared_file, shuffled

#: Buckets of ids; versions after which all state is written.
BUCKETS, FULL = 64, 16

_STATE = "id long, n long, sum1 array<double>, h1 array<double>, sum2 array<double>, x array<double>"


def _plus(a: str, b: str) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _message(layer: SageLayer, vector: str) -> Column:
    """What a node sends along its out-links."""
    return F.col(vector) if layer.kind == "mean" else linear(F.col(vector), layer.pool, layer.pool_bias, activate=True)


def _sums(messages: DataFrame, width: int) -> DataFrame:
    """``(id, added)``: element-wise sums of ``n`` times ``message`` by destination."""
    parts = [F.sum(F.col("message")[i] * F.col("n")).alias(f"_{i}") for i in range(width)]
    folded = messages.groupBy("dst").agg(*parts)
    return folded.select(F.col("dst").alias("id"), F.array(*[F.col(f"_{i}") for i in range(width)]).alias("added"))


class FreshEmbeddings:
    """State of all nodes in a folder, for one model. Maxima can't be kept as sums, so no ``pool``.

    ``features`` gives ``(id, x)`` for a table of ids; drawn ones by default.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        model: SageModel,
        seed: int,
        features: Callable[[DataFrame], DataFrame] | None = None,
        full: int = FULL,
        buckets: int = BUCKETS,
    ):
        if model.kind == "pool":
            raise ValueError("maxima of neighbours can't follow arriving links by sums")
        self.spark, self.folder, self.model, self.full = spark, folder, model, full
        self.buckets = buckets
        self.features = features or (lambda ids: node_features(ids, model.first.in_width, seed))

    def _versions(self, log: str, before: int | None) -> list[int]:
        system, root = shared_file(f"{self.folder}/{log}")
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        done = [f for f in found if system.get_file_info(f"{f.path}/_SUCCESS").type == fs.FileType.File]
        versions = sorted(int(f.base_name.removeprefix("v")) for f in done)
        return [v for v in versions if before is None or v < before]

    def _read(self, log: str, schema: str, versions: list[int]) -> DataFrame:
        parts = [
            self.spark.read.schema(f"{schema}, bucket int").parquet(f"{self.folder}/{log}/v{v}").withColumn("v", F.lit(v))
            for v in versions
        ]
        out = self.spark.createDataFrame([], f"{schema}, bucket int, v int")
        for part in parts:
            out = out.unionByName(part)
        return out

    def _write(self, rows: DataFrame, log: str, key: str, version: int) -> None:
        bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int"))
        path = f"{self.folder}/{log}/v{version}"
        bucketed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)

    def _state(self, ids: DataFrame | None, before: int | None) -> DataFrame:
        """The latest rows, of ``ids`` only if given; just the buckets of those are read."""
        versions = self._versions("state", before)
        whole = [v for v in versions if v % self.full == 0]
        rows = self._read("state", _STATE, [v for v in versions if not whole or v >= whole[-1]])
        if ids is not None:
            keyed = ids.select("id", F.pmod(F.xxhash64("id"), F.lit(self.buckets)).cast("int").alias("bucket"))
            rows = rows.join(shuffled(keyed), ["bucket", "id"], "left_semi")
        latest = rows.groupBy("id").agg(F.max_by(F.struct("n", "sum1", "h1", "sum2", "x"), "v").alias("s"))
        return latest.select("id", "s.*")

    def _links_from(self, ids: DataFrame, before: int) -> DataFrame:
        rows = self._read("links", "src long, dst long, n long", self._versions("links", before))
        keyed = ids.select(F.col("id").alias("src"), F.pmod(F.xxhash64("id"), F.lit(self.buckets)).cast("int").alias("bucket"))
        return rows.join(shuffled(keyed), ["bucket", "src"], "left_semi").select("src", "dst", "n")

    def embeddings(self) -> DataFrame:
        """``(id, x)`` of all nodes, without a last activation."""
        return self._state(None, None).select("id", "x")

    def add(self, links: DataFrame, version: int, nodes: DataFrame | None = None) -> None:
        """Take in ``links(src, dst)`` as one version, and ``nodes(id)`` that may have no links.

        Versions are numbers from 0 that grow; links with a null end are passed over.
        """
        first, second = self.model.first, self.model.second
        fresh = links.filter("src is not null and dst is not null").select("src", "dst")
        fresh = materialise(parallel_counts(fresh), "fresh_links")
        ends = fresh.select(F.explode(F.array("src", "dst")).alias("id"))
        if nodes is not None:
            ends = ends.unionByName(nodes.select("id"))
        ends = materialise(ends.distinct(), "ends")
        known = materialise(self._state(ends, version), "known")

        # First layer: sums of the destinations and of new nodes, and their hidden vectors.
        x = self.features(ends).withColumnRenamed("x", "feature")
        sent = x.select(F.col("id").alias("src"), _message(first, "feature").alias("message"))
        met = fresh.join(shuffled(sent), "src")
        more = fresh.groupBy(F.col("dst").alias("id")).agg(F.sum("n").alias("more"))
        added = _sums(met, first.in_width).join(shuffled(more), "id")
        zero1, zero2 = zeros(first.in_width), zeros(second.in_width)
        now = ends.join(shuffled(known.withColumn("old", F.lit(True))), "id", "left").join(shuffled(added), "id", "left").join(shuffled(x), "id")
        now = now.filter("old is null or more is not null")
        now = now.withColumns(
            {
                "n": F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0)),
                "sum1": F.zip_with(F.coalesce("sum1", zero1), F.coalesce("added", zero1), lambda a, b: a + b),
                "before": F.coalesce("h1", zero2),
            }
        )
        mean = F.transform("sum1", lambda v: v / F.greatest(F.col("n"), F.lit(1)))
        now = now.withColumn("mean1", mean)
        now = now.withColumn("h1", affine([(F.col("feature"), first.self_), (F.col("mean1"), first.neigh)], first.bias, True))
        now = materialise(now.select("id", "n", "sum1", "h1", "before", "old"), "first_layer")

        # Second layer: new links bring the new hidden vectors, old ones the differences.
        hidden = now.select("id", "h1").unionByName(known.join(shuffled(now), "id", "left_anti").select("id", "h1"))
        hidden = hidden.select(F.col("id").alias("src"), _message(second, "h1").alias("message"))
        moved = now.filter("old")
        leaving = self._links_from(moved, version)
        step = moved.select(F.col("id").alias("src"), _message(second, "h1").alias("_new"), _message(second, "before").alias("_old"))
        step = step.select("src", F.zip_with("_new", "_old", lambda a, b: a - b).alias("message"))
        arriving = fresh.join(shuffled(hidden), "src").select("dst", "n", "message")
        arriving = arriving.unionByName(leaving.join(shuffled(step), "src").select("dst", "n", "message"))
        added = materialise(_sums(arriving, second.in_width), "second_sums")

        touched = materialise(added.select("id").unionByName(now.select("id")).distinct(), "touched")
        changed = now.select("id", F.col("n").alias("_n"), F.col("sum1").alias("_sum1"), F.col("h1").alias("_h1"))
        rows = touched.join(shuffled(self._state(touched, version)), "id", "left")
        rows = rows.join(shuffled(changed), "id", "left").join(shuffled(added), "id", "left")
        rows = rows.select(
            "id",
            F.coalesce("_n", "n").alias("n"),
            F.coalesce("_sum1", "sum1").alias("sum1"),
            F.coalesce("_h1", "h1").alias("h1"),
            F.zip_with(F.coalesce("sum2", zero2), F.coalesce("added", zero2), lambda a, b: a + b).alias("sum2"),
        )
        mean = F.transform("sum2", lambda v: v / F.greatest(F.col("n"), F.lit(1)))
        rows = rows.withColumn("mean2", mean)
        out = affine([(F.col("h1"), second.self_), (F.col("mean2"), second.neigh)], second.bias, False)
        rows = materialise(rows.select("id", "n", "sum1", "h1", "sum2", out.alias("x")), "changed_state")
        self._write(fresh, "links", "src", version)
        if version % self.full == 0 and version:
            rows = rows.unionByName(self._state(None, version).join(shuffled(rows.select("id")), "id", "left_anti"))
        self._write(rows, "state", "id", version)


def fresh_gold(
    relations: DataFrame, fresh: FreshEmbeddings, checkpoint: str, path: str, nodes: DataFrame | None = None
) -> StreamingQuery:
    """Let each arriving batch change the embeddings, then score and refine it with them.

    Every batch has a version of the state and a folder of ``path``; a replayed one replaces both.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        batch = materialise(batch, "arrived")
        links = batch.select(F.col("src_id").alias("src"), F.col("dst_id").alias("dst"))
        fresh.add(links, batch_id, nodes if batch_id == 0 else None)
        refined = refine_probability(predict_links(batch, shuffled(fresh.embeddings()), fresh.model))
        refined.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = (
        relations.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
