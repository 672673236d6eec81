"""Landing to bronze, bronze to silver, and gold kept fresh as links arrive.

Every job takes what is available and stops; its checkpoint makes a restart
continue where the last run ended and add nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkloom.model import SageModel
from linkloom.operators.refine import clean_parties, confident_links, refine_probability
from linkloom.operators.scoring import predict_links
from linkloom.sources.landing import RESCUED, read_landing_stream


def append_stream(
    df: DataFrame, checkpoint: str, path: str | None = None, table: str | None = None
) -> StreamingQuery:
    """Append all available rows to a folder or a table, exactly once, then stop."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if path is not None:
        writer = writer.option("path", path)
    query = writer.toTable(table) if table is not None else writer.start()
    query.awaitTermination()
    return query


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """A folder whose later files may have more columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def bronze_stream(
    spark: SparkSession,
    landing: str,
    schema_location: str,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    sample: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Landing JSON to bronze, with columns that new files bring; name ``sample`` files to widen types."""
    rows = read_landing_stream(spark, landing, schema_location, sample, max_files, checkpoint)
    return append_stream(rows, checkpoint, path, table)


def rescued_rows(bronze: DataFrame) -> DataFrame:
    """Bronze records that could not be read in full, with their text; silver leaves them aside."""
    return bronze.filter(F.col(RESCUED).isNotNull())


def silver_rows(bronze: DataFrame) -> DataFrame:
    """Confident links with cleaned names; the same rule for batches and streams."""
    if RESCUED in bronze.columns:
        bronze = bronze.filter(F.col(RESCUED).isNull()).drop(RESCUED)
    return clean_parties(confident_links(bronze))


def silver_stream(
    bronze: DataFrame, checkpoint: str, path: str | None = None, table: str | None = None
) -> StreamingQuery:
    return append_stream(silver_rows(bronze), checkpoint, path, table)


def score_stream(relations: DataFrame, embeddings: DataFrame, model: SageModel) -> DataFrame:
    """Arriving relations joined to the stored embeddings and scored."""
    return predict_links(relations, embeddings, model)


def incremental_gold(
    relations: DataFrame, embeddings: DataFrame, model: SageModel, checkpoint: str, path: str
) -> StreamingQuery:
    """Score and refine each arriving batch into its own folder of ``path``.

    A replayed batch overwrites its folder, so a retry leaves no copies.
    """

    def refine(batch: DataFrame, batch_id: int) -> None:
        refined = refine_probability(predict_links(batch, embeddings, model))
        refined.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = (
        relations.writeStream.foreachBatch(refine)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
