"""Documents to training sequences: quality, language, near copies, packing.

Each stage takes (spark, docs, sf_dir) and returns what goes on; its output is written as
Parquet and read back as the next one's documents. The last one returns sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import id_remainder, table
from linkloom.llm.jaccard import jaccard_components
from linkloom.llm.language import UNKNOWN, fit_languages, predict_languages
from linkloom.llm.packing import pack_documents
from linkloom.llm.quality import fit_quality, score_quality
from linkloom.llm.queries import vocabulary_path
from linkloom.session import materialise

#: Language predictions below this posterior are rejected.
LEAST_POSTERIOR = 0.5
#: Rows handed to a Python worker at once, which hold whole documents here.
ROWS_AT_ONCE = 2000


def _bounded(spark: SparkSession) -> None:
    """Fewer rows per Arrow batch than by default, for this session; they are read when a stage's result is written."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if not 0 < now <= ROWS_AT_ONCE:
        spark.conf.set(name, str(ROWS_AT_ONCE))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier predicts to be good; rows without text and repeated rows are scored like others.

    Decided by row, null and repeated ids included; an empty table stays empty.
    """
    _bounded(spark)
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")), carry=True)
    return scored.filter("predicted = 1").select("row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; a text that is null or has no letter has none and goes.

    Decided by row; languages as likely as each other go by name. An empty table stays empty.
    """
    _bounded(spark)
    path = vocabulary_path("piece_bpe_32k.model")
    model = fit_languages(docs.filter(id_remainder("doc_id", 3) != 1), path)
    named = predict_languages(docs, model, path, carry=True)
    return named.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_POSTERIOR)).select("row.*")


def jaccard_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the first with the smallest id; a null id is the largest.

    Rows are told apart by a key of their own: ids may repeat or be null.
    """
    _bounded(spark)
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row"))
    keyed = materialise(rows, "keyed")
    found = jaccard_components(keyed.select(F.col("row").alias("doc_id"), "doc.text"))
    placed = found.select(F.col("doc_id").alias("row"), "component_id").join(keyed.select("row", "doc.doc_id"), "row")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    kept = placed.groupBy("component_id").agg(first).select("first.row")
    return keyed.join(kept, "row", "left_semi").select("doc.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids, each from one document, with the ids.

    A null text counts as empty and gives its end id alone; rows with null or repeated ids are
    packed like others. An empty table gives no sequences.
    """
    _bounded(spark)
    # Workers still hold what earlier stages left them.
    packed = pack_documents(docs, vocabulary_path("byte_bpe_50k.json"), share=0.3)
    return packed.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("jaccard_dedup", jaccard_dedup),
    ("packing", packing),
]

#: Learned stages have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
