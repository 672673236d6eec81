"""JSON records whose types may widen as files arrive, with nothing lost and nobody asked.

Every micro-batch looks at its own files first: new fields are added to the remembered schema and
whole numbers become fractions where fractions arrive. Batches are kept by the version of the
schema they were read with. What doesn't fit, as text where a number belongs, is kept as its text
and is tried again with the types of the day whenever the records are read, so it turns up once:
as a row, or aside.
"""

from __future__ import annotations

import json

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from linkloom.session import materialise, shared_file
from linkloom.sources.landing import RESCUED, inferred_schema, remember_schema, stored_schema

#: Files of a micro-batch; their names are all that the driver gets.
MAX_FILES = 1000


def widened(old: T.DataType, new: T.DataType | None) -> T.DataType:
    """``old`` with fields that only ``new`` has and with whole numbers as fractions where ``new`` has these.

    Other differences stay as in ``old``.
    """
    if isinstance(old, T.NullType) and new is not None:
        return new
    if isinstance(old, T.LongType) and isinstance(new, T.DoubleType):
        return new
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widened(old.elementType, new.elementType), True)
    if not (isinstance(old, T.StructType) and isinstance(new, T.StructType)):
        return old
    seen, known = {f.name: f.dataType for f in new.fields}, set(old.fieldNames())
    kept = [T.StructField(f.name, widened(f.dataType, seen.get(f.name)), True) for f in old.fields]
    return T.StructType([*kept, *[f for f in new.fields if f.name not in known]])


def _parsed(text: str, schema: T.StructType) -> Column:
    """Records of a text column as a struct with RESCUED, which holds the text of what doesn't fit."""
    whole = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
    return F.from_json(text, whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED})


def land_records(
    spark: SparkSession, landing: str, schema_location: str, checkpoint: str, path: str, max_files: int = MAX_FILES
) -> StreamingQuery:
    """Take in the JSON lines that arrived under ``landing``, a folder of ``path`` for each micro-batch.

    A replayed batch overwrites its folder. A backlog of any size is cut into batches of
    ``max_files`` files. Lines without text are no records.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(landing)
    lines = lines.filter(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("file"))

    def take(batch: DataFrame, batch_id: int) -> None:
        batch = materialise(batch, "arrived")
        files = [r[0] for r in batch.select("file").distinct().collect()]
        if not files:
            return
        _, schema = stored_schema(spark, schema_location)
        seen = inferred_schema(spark, files)
        remember_schema(spark, schema_location, seen if schema is None else widened(schema, seen))
        version, schema = stored_schema(spark, schema_location)
        schema = schema or T.StructType([])
        rows = batch.select(_parsed("value", schema).alias("r")).select("r.*")
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}/version={max(version, 0)}")

    query = lines.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _schema_at(spark: SparkSession, location: str, version: int) -> T.StructType:
    rows = spark.read.text(location).filter(F.col("version") == version).collect()
    return T.StructType.fromJson(json.loads(rows[0]["value"])) if rows else T.StructType([])


def read_records(spark: SparkSession, path: str, schema_location: str) -> DataFrame:
    """All records in the types of the day; ``_corrupt_record`` has the text of those that don't fit them."""
    _, latest = stored_schema(spark, schema_location)
    latest = latest or T.StructType([])
    system, root = shared_file(path)
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    folders: dict[int, list[str]] = {}
    for f in found:
        if f.base_name == "_SUCCESS" and "/version=" in f.path:
            folder = f.path.rsplit("/", 1)[0].removeprefix(root)
            folders.setdefault(int(folder.rsplit("=", 1)[1]), []).append(f"{path}{folder}")
    names = [f.name for f in latest.fields]
    out = spark.createDataFrame([], T.StructType([*latest.fields, T.StructField(RESCUED, T.StringType())]))
    for version, paths in sorted(folders.items()):
        schema = _schema_at(spark, schema_location, version)
        rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])).parquet(*paths)
        good = rows.filter(F.col(RESCUED).isNull())
        types = {f.name: f.dataType for f in latest.fields}
        have = set(schema.fieldNames())
        cast = [(F.col(n).cast(types[n]) if n in have else F.lit(None).cast(types[n])).alias(n) for n in names]
        out = out.unionByName(good.select(*cast, F.lit(None).cast("string").alias(RESCUED)))
        again = rows.filter(F.col(RESCUED).isNotNull()).select(_parsed(RESCUED, latest).alias("r"))
        out = out.unionByName(again.select("r.*").select(*names, RESCUED))
    return out
