"""Dense numbers for ids of any size, the same over all runs."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.ordering import positional_index
from linkloom.session import materialise, shared_file


class IdDictionary:
    """``(id, number)`` in a folder. New ids get the numbers after the last one; old ones keep theirs.

    Every call that brings new ids writes one version; a version that was not finished does not
    count and is written again. One writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _versions(self) -> list[str]:
        system, root = shared_file(self.folder)
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        done = [f for f in found if system.get_file_info(f"{f.path}/_SUCCESS").type == fs.FileType.File]
        return sorted(f.base_name for f in done)

    def numbers(self) -> DataFrame:
        paths = [f"{self.folder}/{v}" for v in self._versions()]
        schema = "id long, number long"
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def size(self) -> int:
        return self.numbers().count()

    def add(self, ids: DataFrame) -> DataFrame:
        """Number the ids that are new, in their order, and return all numbers; null is no id."""
        known = self.numbers()
        new = ids.filter("id is not null").select("id").distinct().join(known, "id", "left_anti")
        new = materialise(new, "new_ids")
        if not new.isEmpty():
            first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
            placed = positional_index(new, ["id"], "_at").select("id", (F.col("_at") + first).alias("number"))
            placed.write.mode("overwrite").parquet(f"{self.folder}/v{len(self._versions()):06d}")
        return self.numbers()


def encode_edges(edges: DataFrame, numbers: DataFrame) -> DataFrame:
    """Edges with numbers in place of the ids of both ends; other columns stay.

    An edge with an end that has no number is left out.
    """
    src = numbers.select(F.col("id").alias("src"), F.col("number").alias("_src"))
    dst = numbers.select(F.col("id").alias("dst"), F.col("number").alias("_dst"))
    both = edges.join(src, "src").join(dst, "dst")
    named = {"src": F.col("_src"), "dst": F.col("_dst")}
    return both.select(*[named.get(c, F.col(c)).alias(c) for c in edges.columns])


def build_dense_graph(edges: DataFrame, dictionary: IdDictionary) -> tuple[DataFrame, int]:
    """Edges over dense numbers, and how many nodes there are; ids may be as large as a long."""
    numbers = dictionary.add(edges.select(F.explode(F.array("src", "dst")).alias("id")))
    return encode_edges(edges, numbers), dictionary.size()
