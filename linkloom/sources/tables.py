"""Batch tables: CSV imports, scans, full refreshes, previews."""

from __future__ import annotations

import time
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from linkloom.session import shared_file


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A comma-separated file with header; types are inferred."""
    return spark.read.csv(path, header=True, inferSchema=True, sep=",")


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Full refresh of a table, all at once; ``path`` keeps its files in a chosen folder.

    The rows are written to a new folder first, then one command of the catalogue points the table
    there. A reader sees the old rows or the new ones, a write that fails leaves the old ones, and
    a table may be refreshed from itself. Columns that are new at the end are added to the table;
    any other change of its columns replaces the table, which is then missing for a moment.
    """
    spark = df.sparkSession
    folder = (path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{name}").rstrip("/")
    version = f"{folder}/version-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(version)
    if spark.catalog.tableExists(name):
        old = [(f.name, f.dataType) for f in spark.table(name).schema]
        new = [(f.name, f.dataType) for f in df.schema]
        if new[: len(old)] == old:
            if added := df.schema.fields[len(old) :]:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, version, "parquet", schema=df.schema)


def drop_old_versions(spark: SparkSession, name: str, keep: int = 1) -> int:
    """Delete folders that a table no longer points to, but for the newest ``keep``; how many went."""
    told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}
    system, current = shared_file(told["Location"])
    parent, _, now = current.rstrip("/").rpartition("/")
    found = system.get_file_info(fs.FileSelector(parent))
    old = sorted(f.path for f in found if f.base_name.startswith("version-") and f.base_name < now)
    for gone in old[: max(len(old) - keep, 0)]:
        system.delete_dir(gone)
    return max(len(old) - keep, 0)


def csv_to_table(spark: SparkSession, csv: str, name: str, path: str | None = None) -> DataFrame:
    overwrite_table(read_csv(spark, csv), name, path)
    return read_table(spark, name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def stream_table(spark: SparkSession, name: str) -> DataFrame:
    """A table as a stream of its rows."""
    return spark.readStream.table(name)


def preview(df: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows by ``keys``: a top-n, not a sort."""
    return df.orderBy(*keys).limit(n)
