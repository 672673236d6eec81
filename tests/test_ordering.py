import random

import pytest
from pyspark.sql import functions as F

from linkloom.operators import ordering
from linkloom.operators.distribution import score_box, score_histogram


@pytest.fixture(params=[1, 4, 16])
def partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_positions_do_not_depend_on_partitioning(spark, partitions):
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("k"), F.lit("x").alias("c"))
    placed = ordering.positional_index(df, ["k"]).collect()
    keys = sorted(r["k"] for r in placed)
    assert {r["k"]: r["pos"] for r in placed} == {k: i for i, k in enumerate(keys)}


def test_running_totals_with_one_hot_group(spark, rows, partitions):
    rng = random.Random(4)
    data = [("hot" if rng.random() < 0.6 else f"g{i % 7}", i, rng.randrange(5)) for i in range(2000)]
    got = ordering.running_totals(rows("g string, i long, v long", data), ["g"], ["i"], ["v"]).collect()
    expected, sums = {}, {}
    for g, i, v in sorted(data, key=lambda r: r[1]):
        expected[i] = sums.get(g, 0)
        sums[g] = sums.get(g, 0) + v
    assert {r["i"]: r["v_before"] for r in got} == expected


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 100])
def test_split_sizes_truncate_and_partition(spark, n):
    edges = spark.range(n).select(F.col("id").alias("eid"))
    labelled = ordering.split_edges(edges, n, 0.1, 0.2).groupBy("split").count().collect()
    sizes = {r["split"]: r["count"] for r in labelled}
    test, valid = int(0.1 * n), int(0.2 * n)
    assert sizes.get("testing", 0) == test and sizes.get("validation", 0) == valid
    assert sum(sizes.values()) == n


def test_split_follows_input_order(spark):
    edges = spark.range(20).select(F.col("id").alias("eid"))
    got = {r["eid"]: r["split"] for r in ordering.split_edges(edges, 20, 0.1, 0.2).collect()}
    assert [got[i][:2] for i in range(20)] == ["tr"] * 14 + ["va"] * 4 + ["te"] * 2


def test_hash_split_is_close_to_its_shares(spark):
    edges = spark.range(5000).select(F.col("id").alias("eid"))
    got = ordering.split_edges(edges, 5000, 0.1, 0.2, method="hash").groupBy("split").count().collect()
    sizes = {r["split"]: r["count"] for r in got}
    assert abs(sizes["testing"] - 500) < 100 and abs(sizes["validation"] - 1000) < 120


def test_batches_are_full_but_the_last(spark, partitions):
    batched = ordering.assign_batches(spark.range(101), "id", 12, 7)
    sizes = {r["batch_id"]: r["count"] for r in batched.groupBy("batch_id").count().collect()}
    assert sizes == {**{b: 12 for b in range(8)}, 8: 5}
    assert ordering.cap_steps(batched, 2).select("batch_id").distinct().count() == 3


def test_sample_has_the_exact_size(spark):
    assert ordering.sample_fraction(spark.range(15), "id", 0.3, 5).distinct().count() == 4
    assert ordering.sample_fraction(spark.range(5), "id", 0.3, 5).count() == 2


def test_quartiles_and_outlying_points(spark, rows):
    values = [1.0, 2.0, 2.0, 3.0, 4.0, 100.0, None]
    box = score_box(rows("v double", [(v,) for v in values]), "v").first()
    assert (box["n"], box["q25"], box["q50"], box["q75"], box["n_outlying"]) == (6, 2.0, 2.5, 3.75, 1)
    empty = score_box(rows("v double", [(None,)]), "v").first()
    assert empty["q50"] is None


def test_histogram_keeps_one_in_the_last_bin(rows):
    bins = score_histogram(rows("v string", [("0",), ("0.5",), ("1",)]), "v", 2).collect()
    assert {r["bin"]: (r["n"], r["density"]) for r in bins} == {0: (1, 2 / 3), 1: (2, 4 / 3)}


def test_running_totals_of_a_null_group(rows):
    df = rows("g string, k long, n long", [(None if i % 2 else "a", i, 1) for i in range(40)])
    found = ordering.running_totals(df, ["g"], [F.col("k")], ["n"]).collect()
    assert all(r.n_before == r.k // 2 for r in found)
