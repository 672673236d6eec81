"""The JSON landing zone and its remembered schema."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Holds the text of a record that is not JSON or has a value that does not fit its column.
RESCUED = "_corrupt_record"


def merge_schemas(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old fields, widened where the new type holds more, then fields only the new schema has."""
    seen, known = {f.name: f for f in new.fields}, set(old.fieldNames())
    widened = [f if f.name not in seen else _wider(f, seen[f.name]) for f in old.fields]
    return T.StructType([*widened, *[f for f in new.fields if f.name not in known]])


def _wider(old: T.StructField, new: T.StructField) -> T.StructField:
    """Whole numbers become fractions, structs merge; all other differences become text."""
    a, b = old.dataType, new.dataType
    kinds = {type(a), type(b)}
    if a == b or isinstance(b, T.NullType):
        return old
    if kinds == {T.LongType, T.DoubleType}:
        return T.StructField(old.name, T.DoubleType(), True)
    if kinds == {T.StructType}:
        return T.StructField(old.name, merge_schemas(a, b), True)
    return T.StructField(old.name, b if isinstance(a, T.NullType) else T.StringType(), True)


def stored_schema(spark: SparkSession, location: str) -> tuple[int, T.StructType | None]:
    """The latest remembered schema and its version, or ``(-1, None)``."""
    try:
        rows = spark.read.text(location).orderBy("version", ascending=False).limit(1).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # a denied or damaged place isn't a new one
            raise
        return -1, None
    if not rows:
        return -1, None
    return rows[0]["version"], T.StructType.fromJson(json.loads(rows[0]["value"]))


def evolve_schema(spark: SparkSession, sample: str, location: str) -> T.StructType:
    """Infer from ``sample``, widen the remembered schema with new columns, remember it.

    Versions are separate folders, so a failed write leaves the last one whole.
    """
    _, old = stored_schema(spark, location)
    seen = inferred_schema(spark, sample)
    return remember_schema(spark, location, seen if old is None else merge_schemas(old, seen))


def inferred_schema(spark: SparkSession, files: str | list[str]) -> T.StructType:
    seen = spark.read.option("columnNameOfCorruptRecord", RESCUED).json(files).schema
    return T.StructType([f for f in seen.fields if f.name != RESCUED])


def remember_schema(spark: SparkSession, location: str, merged: T.StructType) -> T.StructType:
    version, old = stored_schema(spark, location)
    if merged != old and merged.fields:  # an empty first file tells nothing
        text = spark.createDataFrame([(merged.json(),)], "value string")
        text.write.mode("overwrite").text(f"{location}/version={version + 1}")
    return merged


def with_new_fields(old: T.DataType, new: T.DataType) -> T.DataType:
    """``old`` with the fields only ``new`` has, at any depth; types that differ stay as in ``old``."""
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(with_new_fields(old.elementType, new.elementType), old.containsNull)
    if not (isinstance(old, T.StructType) and isinstance(new, T.StructType)):
        return old
    seen, known = {f.name: f.dataType for f in new.fields}, set(old.fieldNames())
    kept = [T.StructField(f.name, with_new_fields(f.dataType, seen.get(f.name)), f.nullable) for f in old.fields]
    return T.StructType([*kept, *[f for f in new.fields if f.name not in known]])


def unseen_files(spark: SparkSession, path: str, checkpoint: str | None) -> list[str]:
    """Files under ``path`` that the log of the stream's checkpoint doesn't name; all without one."""
    files = spark.read.format("binaryFile").load(path).select("path")
    if checkpoint is not None:
        try:
            log = spark.read.text(f"{checkpoint}/sources/0")
            bare = lambda c: F.regexp_replace(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "^file:/+", "/")
            seen = log.select(bare(F.get_json_object("value", "$.path")).alias("seen")).dropna()
            files = files.join(seen, F.regexp_replace("path", "^file:/+", "/") == F.col("seen"), "left_anti")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return [r["path"] for r in files.collect()]


def read_landing_stream(
    spark: SparkSession,
    path: str,
    schema_location: str,
    sample: str | None = None,
    max_files: int | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Incremental scan of the JSON files under ``path``.

    The schema is remembered. Before each run it is inferred from the files that ``checkpoint``
    has not seen, or from all without one, and new fields are added; types change only by
    ``sample``, which names files to widen them by. A record that is not JSON or has a value
    that does not fit keeps its text in ``_corrupt_record``. ``max_files`` cuts a backlog into
    several micro-batches. A file that lands between the inference and the run is read by the
    schema before it.
    """
    if sample is not None:
        evolve_schema(spark, sample, schema_location)
    _, schema = stored_schema(spark, schema_location)
    files = unseen_files(spark, path, checkpoint)
    if files:
        seen = inferred_schema(spark, files)
        schema = remember_schema(spark, schema_location, seen if schema is None else with_new_fields(schema, seen))
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if schema is None or not schema.fields:  # no record has told a field yet
        return reader.text(path).filter(F.trim("value") != "").select(F.col("value").alias(RESCUED))
    if RESCUED not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
    return reader.schema(schema).option("columnNameOfCorruptRecord", RESCUED).json(path)
