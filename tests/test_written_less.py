"""What intermediate tables hold: only the columns that are read again, packed tightly."""

from pathlib import Path

from pyspark.sql import functions as F

from linkloom.operators import graph, ordering
from linkloom.session import materialise, scratch_path, spread


def test_positions_are_written_without_columns_nobody_reads(spark, monkeypatch):
    written = []

    def kept(df, label, *more):
        written.append({c for c in df.columns if not c.startswith("_")})
        return materialise(df, label, *more)

    monkeypatch.setattr(ordering, "materialise", kept)
    rows = spark.range(40).select(
        (39 - F.col("id")).alias("k"), F.col("id").alias("src_id"), (F.col("id") + 100).alias("dst_id")
    )
    edges = graph.build_edges(rows, ["k"])
    assert sorted(map(tuple, edges.collect())) == [(i, 39 - i, 139 - i) for i in range(40)]
    batches = ordering.assign_batches(edges, "eid", 7, 3)
    assert batches.columns == ["eid", "src", "dst", "batch_id"]
    assert sorted(r["count"] for r in batches.groupBy("batch_id").count().collect()) == [5, 7, 7, 7, 7, 7]
    assert written == [{"src", "dst"}, {"eid", "src", "dst"}]


def test_written_tables_are_packed(spark):
    held = materialise(spark.range(10), "packed_tightly")
    assert all(".zstd." in Path(f).name for f in held.inputFiles())


def test_files_that_many_tasks_read_are_not_shuffled(spark):
    path = scratch_path(spark, "one_file")
    spark.range(200_000).withColumn("u", F.rand(1)).coalesce(1).write.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        read = spark.read.parquet(path)
        assert len(read.inputFiles()) == 1
        assert spread(read) is read
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
