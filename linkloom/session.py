"""Session helpers: the shared folder and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def build_session(cores: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("linkloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.scheduler.mode", "FAIR")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a
    machine-local path would lose data with its machine, so it is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="linkloom-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; never reused."""
    return f"{shared_folder(spark)}/linkloom/{label}-{uuid.uuid4().hex[:12]}"


def shared_file(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of something in the shared folder, as seen from a task."""
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def spread(df: DataFrame) -> DataFrame:
    """Redistribute rows read by fewer tasks than there are cores; else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shuffled(df: DataFrame) -> DataFrame:
    """A table that grows with the data: joins with it are shuffled, however small its files look.

    Ids pack so tightly that the planner takes files of many million rows for small ones, and
    collects them on the driver to broadcast them.
    """
    return df.hint("shuffle_merge")


def materialise(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, fixes rows that depend
    on sampled range bounds, and leaves a columnar table whose size Spark knows. Such
    tables are written once and read a few times, so they are packed tightly.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
