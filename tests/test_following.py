"""Tables that are refreshed, numbers that stay, embeddings that follow, densities, endings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.functions.names import base_name
from linkloom.model import drawn_model
from linkloom.operators import distribution as dist
from linkloom.operators.dictionary import IdDictionary, build_dense_graph
from linkloom.operators.graph import node_features
from linkloom.operators.sage import embed_all
from linkloom.session import scratch_path
from linkloom.sources import tables
from linkloom.streaming.fresh import FreshEmbeddings


@pytest.mark.parametrize("kind", ["mean", "mean_pool"])
def test_embeddings_follow_arriving_links(spark, rows, kind):
    model = drawn_model((3, 5, 4), kind)
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 25, (60, 2))]
    links += [(0, 24)] * 3 + [(a, 7) for a in range(25)]
    fresh = FreshEmbeddings(spark, scratch_path(spark, "fresh"), model, 5, full=2, buckets=3)
    nodes = spark.range(30)
    for version, part in enumerate((links[:20], links[20:50], [], links[50:])):
        for _ in range(1 + (version == 1)):  # one batch is replayed
            fresh.add(rows("src long, dst long", [*part, (None, 3)]), version, nodes if version == 0 else None)
    whole = embed_all(rows("eid long, src long, dst long", [(i, *e) for i, e in enumerate(links)]), node_features(nodes, 3, 5), model, False)
    ours = {r.id: r.x for r in fresh.embeddings().collect()}
    theirs = {r.id: r.x for r in whole.collect()}
    assert ours.keys() == theirs.keys()
    assert max(abs(a - b) for i in ours for a, b in zip(ours[i], theirs[i])) < 1e-6


def test_a_batch_writes_its_frontier(spark, rows):
    fresh = FreshEmbeddings(spark, scratch_path(spark, "fresh"), drawn_model((3, 5, 4)), 5, buckets=4)
    chain = [(i, i + 1) for i in range(200)]
    fresh.add(rows("src long, dst long", chain), 0)
    fresh.add(rows("src long, dst long", [(5, 100)]), 1)
    written = spark.read.parquet(f"{fresh.folder}/state/v1").select("id").collect()
    assert {r.id for r in written} == {100, 101}


def test_maxima_are_refused(spark):
    with pytest.raises(ValueError):
        FreshEmbeddings(spark, "x", drawn_model((3, 5, 4), "pool"), 5)


def test_table_is_refreshed_from_itself_or_not_at_all(spark):
    name, path = f"t{scratch_path(spark, 'x')[-12:]}", scratch_path(spark, "table")
    tables.overwrite_table(spark.range(10), name, path)
    before = spark.table(name)
    tables.overwrite_table(spark.table(name).filter("id >= 5"), name, path)
    assert spark.table(name).count() == 5
    assert before.count() in (5, 10)  # a reader that began before finds all its files
    with pytest.raises(Exception):
        tables.overwrite_table(spark.table(name).selectExpr("id + CAST(raise_error('no') AS INT) AS id"), name, path)
    assert spark.table(name).count() == 5
    tables.overwrite_table(spark.table(name).withColumn("more", F.lit("x")), name, path)
    assert {tuple(r) for r in spark.table(name).collect()} == {(i, "x") for i in range(5, 10)}
    tables.overwrite_table(spark.table(name).select("more"), name, path)
    assert spark.table(name).columns == ["more"] and spark.table(name).count() == 5
    assert tables.drop_old_versions(spark, name, 0) >= 3 and spark.table(name).count() == 5


def test_numbers_of_large_ids_stay(spark, rows):
    big = 1 << 60
    numbers = IdDictionary(spark, scratch_path(spark, "numbers"))
    schema = "eid long, src long, dst long"
    first, n = build_dense_graph(rows(schema, [(0, big, 3), (1, 3, big + 9)]), numbers)
    assert n == 3 and {tuple(r) for r in first.collect()} == {(0, 1, 0), (1, 0, 2)}
    again, n = build_dense_graph(rows(schema, [(0, big, 3), (1, -5, big + 9), (2, None, 3)]), numbers)
    assert n == 4 and {tuple(r) for r in again.collect()} == {(0, 1, 0), (1, 3, 2)}
    assert IdDictionary(spark, numbers.folder).size() == 4
    assert numbers.add(rows("id long", [(3,)])).count() == 4


def test_density_equals_the_direct_sum(rows):
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(-2, 0.5, 300), rng.exponential(3, 100), [40.0]])
    df = rows("v double", [(float(x),) for x in v] + [(None,)])
    sd, (q25, q75) = v.std(ddof=1), np.quantile(v, [0.25, 0.75])
    width = 0.9 * min(sd, (q75 - q25) / 1.34) * len(v) ** -0.2
    got = dist.score_density(df, "v", -5.0, 45.0, 101).orderBy("x").toPandas()
    away = (got["x"].to_numpy()[:, None] - v[None, :]) / width
    direct = np.exp(-0.5 * away**2).sum(1) / (len(v) * width * np.sqrt(2 * np.pi))
    assert np.abs(got["density"].to_numpy() - direct).max() < 1e-6
    fences = q25 - 1.5 * (q75 - q25), q75 + 1.5 * (q75 - q25)
    assert sorted(r.v for r in dist.outlying_rows(df, "v").collect()) == sorted(v[(v < fences[0]) | (v > fences[1])])
    counted = {r.bin: r.n for r in dist.score_histogram(df, "v", 10, 0.0, 5.0).collect()}
    assert counted[-1] == (v < 0).sum() and counted[10] == (v > 5).sum()


def test_density_of_too_little(rows):
    for data in ([], [(1.0,)], [(1.0,), (1.0,)]):
        assert dist.score_density(rows("v double", data), "v", 0.0, 1.0, 5).count() == 0
        assert dist.outlying_rows(rows("v double", data), "v").count() == 0


def test_endings_of_several_words(rows):
    names = {
        "018f2b10979746da820c5269e4d87bb2 LLC": "018f2b10979746da820c5269e4d87bb2", "018f2b Ltd.": "018f2b",
        "A, Inc. LLC": "A", "Zinc Inc": "Zinc", "Foo S.A.": "Foo", "Foo S. A.": "Foo", "Plan S A": "Plan S A",
        "Foo L.L.C.": "Foo", "Bar GmbH & Co. KG": "Bar", "Baz Sp. z o.o.": "Baz", "Acme S. de R.L. de C.V.": "Acme",
        "Acme A/S": "Acme", "Acme Co., Ltd.": "Acme", "Acme, Private Limited": "Acme", "Visa": "Visa", "": "",
        "LLC": "LLC", "GmbH & Co. KG": "GmbH & Co. KG", "S.A.": "S.A.", "Co., Ltd.": "Co., Ltd.", "  Acme Inc  ": "Acme",
    }
    got = rows("name string", [(n,) for n in [*names, None]]).select("name", base_name(F.col("name")).alias("base"))
    assert {r.name: r.base for r in got.collect()} == names | {None: None}
