"""Stages of the pipeline decide by row where ids repeat or are null."""

import random

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def words(seed, n=60):
    return " ".join(random.Random(seed).choice("abcdefghij") * 3 + str(random.Random(seed + k).random())[2:6] for k in range(n))


def test_dedup_keeps_one_row_of_each_group(spark):
    one, two, three = words(1), words(1000), words(2000)
    near = one + " more"
    rows = [(7, one), (7, one), (7, near), (3, two), (9, near), (None, one), (None, three), (None, three), (4, ""), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [(r.doc_id, r.text) for r in pipeline.jaccard_dedup(spark, docs, SF).collect()]
    assert len(kept) == 5
    assert [i for i, t in kept if t in (one, near)] == [7] and (3, two) in kept
    assert kept.count((None, three)) == 1 and (4, "") in kept and (4, None) in kept


def test_filters_decide_by_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for stage in (pipeline.quality_classifier, pipeline.language_id):
        good = {r.text for r in stage(spark, docs, SF).collect()}
        bad = [r.text for r in docs.select("text").distinct().collect() if r.text not in good]
        clean = min(t for t in good if t and len(t) > 500)
        added = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long"))
        parts = [added.limit(1).withColumn("text", F.lit(clean))]
        if bad:
            junk = min(t or "" for t in bad)
            same = added.limit(1).withColumn("doc_id", F.lit(10**9).cast("long"))
            parts += [same.withColumn("text", F.lit(t)) for t in (junk, clean)]
        both = docs
        for p in parts:
            both = both.unionByName(p)
        out = [(r.doc_id, r.text) for r in stage(spark, both, SF).filter("doc_id is null or doc_id = 1000000000").collect()]
        assert (None, clean) in out
        assert [t for i, t in out if i is not None] == ([clean] if bad else [])
