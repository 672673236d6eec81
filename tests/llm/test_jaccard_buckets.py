"""Buckets of fingerprints are as many as the shingles of all rows ask for, copies included."""

from linkloom.llm import jaccard


def test_copies_count_for_the_buckets(spark, monkeypatch):
    totals = []
    whole = jaccard.sets_shared_enough

    def watch(rows, sets_of, total, percent):
        totals.append(total)
        return whole(rows, sets_of, total, percent)

    monkeypatch.setattr(jaccard, "sets_shared_enough", watch)
    text = " ".join(f"w{i}" for i in range(24))  # 20 shingles of 5 words
    docs = spark.createDataFrame([(i, text) for i in range(10)] + [(10, "a b c d e")], "doc_id long, text string")
    found = jaccard.jaccard_components(docs).collect()
    assert {r.component_id for r in found} == {0, 10}
    assert totals[0] == 10 * 20 + 1
