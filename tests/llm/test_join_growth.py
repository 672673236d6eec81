"""What the join shuffles and pairs grows with its input, not with Spark's partitions or with rows it drops."""

import random

import numpy as np
from pyspark.sql import functions as F

from linkloom.llm import jaccard


def test_blocks_follow_the_classes_and_not_the_partitions(spark, monkeypatch):
    sizes, whole = {}, jaccard.materialise

    def counted(df, label, *more):
        out = whole(df, label, *more)
        sizes[label] = sizes.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "materialise", counted)
    draw, n = random.Random(3), 160
    passage = draw.sample(range(1, 1 << 62), 40)
    drawn = [passage + draw.sample(range(1, 1 << 62), draw.randint(7, 13)) for _ in range(n)]
    # Each has a neighbour, so all are classes of their own.
    pairs = [[*s, draw.randint(1, 1 << 62)] for s in drawn]
    sets = [np.sort(np.array(s, np.uint64)) for s in [*drawn, *pairs]]
    rows = [(bytearray(jaccard.set_digest(s)), len(s), i, bytearray(s.tobytes())) for i, s in enumerate(sets)]
    table = spark.createDataFrame(rows, "set_id binary, n long, k0 long, shingles binary")
    none = spark.createDataFrame([], "node binary, component binary")
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        links = [(bytes(r.a), bytes(r.b)) for r in jaccard._between_components(table, none, 75).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sizes["blocks"] <= 2
    assert sizes["routed"] <= 2 * len(sets)
    names = {jaccard.set_digest(s): i for i, s in enumerate(sets)}
    joined = {frozenset((names[a], names[b])) for a, b in links}
    least = list(range(len(sets)))
    for _ in range(len(sets)):
        for a, b in joined:
            least[a] = least[b] = min(least[a], least[b])
    assert all(least[i] == least[n + i] for i in range(n))


def test_rows_that_a_join_drops_are_not_shuffled(spark):
    rows = spark.range(20_000).select(F.expr("if(id % 500 = 7, null, id)").alias("key"), F.col("id").alias("other"))
    rows = rows.union(rows.filter("key < 100"))  # ids may repeat
    wanted = spark.range(0, 20_000, 100).select(F.col("id").alias("key"))
    passed = jaccard.likely(rows, "key", wanted)
    exact = sorted(map(tuple, rows.join(wanted, "key").collect()))
    assert sorted(map(tuple, passed.join(wanted, "key").collect())) == exact and exact
    assert passed.count() < 2_000


def test_marks_of_binary_keys_and_of_none(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MOST_BITS", 1 << 15)  # more rows pass, none is lost
    rows = spark.range(5_000).select(F.expr("unhex(md5(cast(id as string)))").alias("set_id"))
    wanted = rows.limit(3_000)
    passed = jaccard.likely(rows, "set_id", wanted)
    assert passed.join(wanted, "set_id").count() == 3_000 and passed.count() < 5_000
    assert jaccard.likely(rows, "set_id", rows.limit(0)).count() == 0
