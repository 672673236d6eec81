import random

from linkloom.operators import metrics

SCORES = "g string, label int, score double"


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(rows):
    n_pos = sum(y for y, _ in rows)
    if not n_pos:
        return None
    total, last = 0.0, 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        kept = [y for y, s in rows if s >= t]
        total += (sum(kept) / n_pos - last) * sum(kept) / len(kept)
        last = sum(kept) / n_pos
    return total


def close(a, b):
    return a is b or abs(a - b) < 1e-12


def test_ranking_metrics_equal_brute_force(rows):
    rng = random.Random(1)
    data = [
        (rng.choice(["hot", "hot", "hot", "a", "b"]), int(rng.random() < 0.4), rng.randrange(12) / 3 - 2)
        for _ in range(600)
    ]
    data += [("ones", 1, 0.5), ("ones", 1, 0.7), ("zeros", 0, 0.1), ("tied", 1, 0.3), ("tied", 0, 0.3)]
    df = rows(SCORES, data)
    for result in (metrics.batch_metrics(df, ["g"]), metrics.split_metrics(df, ["g"])):
        got = {r["g"]: (r["auc"], r["ap"]) for r in result.collect()}
        assert set(got) == {g for g, _, _ in data}
        for g, (auc, ap) in got.items():
            mine = [(y, s) for h, y, s in data if h == g]
            assert close(auc, brute_auc(mine)) and close(ap, brute_ap(mine)), g
    assert got["tied"][0] == 0.5 and got["ones"] == (None, 1.0) and got["zeros"] == (None, None)


def test_mean_leaves_out_single_class_batches(rows):
    df = rows("split string, auc double, ap double", [("v", 0.5, 0.2), ("v", None, 0.4)])
    mean = metrics.mean_metrics(df, ["split"]).first()
    assert mean["mean_auc"] == 0.5 and abs(mean["mean_ap"] - 0.3) < 1e-12
