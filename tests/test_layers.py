import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.config import Params
from linkloom.functions import vectors as V
from linkloom.model import drawn_model, load_model, save_model
from linkloom.operators import graph, sage, scoring
from linkloom.plans.batches import edge_batches, pack_batches
from linkloom.plans.evaluate import forward, packed_forward
from linkloom.session import scratch_path

# Node 5 is isolated; (0, 1) is a parallel edge; 2 has a self-loop.
PAIRS = [(0, 1), (0, 1), (2, 1), (2, 2), (1, 3), (4, 3), (0, 4)]
KINDS = ["mean", "pool", "mean_pool"]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(i, s, d) for i, (s, d) in enumerate(PAIRS)], "eid long, src long, dst long")


def features(spark, width, n=6):
    x = np.random.default_rng(width).normal(size=(n, width))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")
    return x, df


def plain_layer(layer, x, activate):
    q = x if layer.kind == "mean" else np.maximum(x @ layer.pool.T + layer.pool_bias, 0)
    out = np.empty((len(x), layer.out_width))
    for v in range(len(x)):
        seen = [q[s] for s, d in PAIRS if d == v]
        fold = np.max if layer.kind == "pool" else np.mean
        agg = fold(seen, axis=0) if seen else np.zeros(layer.in_width)
        out[v] = layer.self_ @ x[v] + layer.neigh @ agg + layer.bias
    return np.maximum(out, 0) if activate else out


def collected(df):
    return np.array([r["x"] for r in df.orderBy("id").collect()])


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("widths", [(3, 5, 2), (12, 20, 12)])
def test_embeddings_equal_plain_numpy(spark, edges, kind, widths):
    model = drawn_model(widths, kind)
    x, nodes = features(spark, widths[0])
    hidden = plain_layer(model.first, x, True)
    for final in (True, False):
        got = collected(sage.embed_all(edges, nodes, model, final))
        assert np.allclose(got, plain_layer(model.second, hidden, final), atol=1e-12)


def test_isolated_node_has_a_zero_neighbourhood(spark, edges):
    model = drawn_model((3, 5, 2))
    x, nodes = features(spark, 3)
    got = collected(sage.sage_layer(graph.parallel_counts(edges), nodes, model.first, False))
    assert np.allclose(got[5], model.first.self_ @ x[5] + model.first.bias)


@pytest.mark.parametrize("width", [4, 80])
def test_scores_from_shares_equal_scores_from_vectors(spark, edges, width):
    model = drawn_model((2, 2, width))
    x, nodes = features(spark, width)
    w_u, w_v, b = model.head
    got = {r["eid"]: r["score"] for r in scoring.mlp_link_score(edges, nodes, model).collect()}
    assert all(abs(got[i] - (w_u @ x[s] + w_v @ x[d] + b)) < 1e-12 for i, (s, d) in enumerate(PAIRS))
    got = {r["eid"]: r["score"] for r in scoring.dot_link_score(edges, nodes, width).collect()}
    assert all(abs(got[i] - 1 / (1 + np.exp(-x[s] @ x[d]))) < 1e-12 for i, (s, d) in enumerate(PAIRS))


def test_spelled_out_and_arrow_maps_agree(spark, monkeypatch):
    x, nodes = features(spark, 4)
    w, b = np.arange(12.0).reshape(3, 4) - 5, np.array([0.5, -1.0, 2.0])
    results = []
    for limit in (64, 0):
        monkeypatch.setattr(V, "SPELLED_OUT", limit)
        mapped = V.affine([(F.col("x"), w), (F.slice("x", 1, 3), None)], b, True)
        results.append(collected(nodes.select("id", mapped.alias("x"))))
    assert np.allclose(*results) and np.allclose(results[0], np.maximum(x @ w.T + b + x[:, :3], 0))


def test_unknown_endpoints_stay_without_prediction(spark):
    _, nodes = features(spark, 4)
    links = spark.createDataFrame([(0, 1, 0.5), (0, 99, 0.6)], "src_id long, dst_id long, probability double")
    got = {r["dst_id"]: r["gnn_prediction"] for r in scoring.predict_links(links, nodes, drawn_model((2, 2, 4))).collect()}
    assert 0 < got[1] < 1 and got[99] is None


@pytest.mark.parametrize("kind", KINDS)
def test_packed_scores_equal_joined_scores(spark, edges, kind):
    params = Params(batch_size=3, num_negative_samples=2, fanouts=(2, 3))
    _, nodes = features(spark, 4)
    model = drawn_model((4, 6, 4), kind)
    batches = edge_batches(edges, 6, params)
    key = ["batch_id", "eid", "label", "score"]
    joined = sorted(map(tuple, forward(batches, nodes, model).select(key).collect()))
    packed = packed_forward(pack_batches(batches, nodes, params), model, params.fanouts)
    assert np.allclose(joined, sorted(map(tuple, packed.select(key).collect())))


@pytest.mark.parametrize("kind", ["mean", "pool"])
def test_model_survives_a_round_trip(spark, kind):
    model, path = drawn_model((3, 4, 3), kind), scratch_path(spark, "model")
    save_model(spark, model, path)
    back = load_model(spark.read.parquet(path))
    assert back.kind == kind and set(back.weights) == set(model.weights)
    assert all(np.array_equal(back.weights[k], w) for k, w in model.weights.items())
