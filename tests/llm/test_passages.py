"""Passages that repeat: the index by itself, the operator against brute force, odd rows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import substring
from linkloom.llm.fm_index import FMIndex, WaveletTree


def test_wavelet_ranks():
    rng = np.random.default_rng(2)
    for n_symbols in (1, 2, 3, 40):
        sequence = np.minimum(rng.geometric(0.2, 500), n_symbols) - 1
        tree = WaveletTree(sequence, n_symbols + 2)
        symbol, at = rng.integers(0, n_symbols + 2, 300), rng.integers(0, 501, 300)
        assert tree.rank(symbol, at).tolist() == [(sequence[:i] == c).sum() for c, i in zip(symbol, at)]


@pytest.mark.parametrize("seed", range(20))
def test_matching_statistics(seed):
    rng = random.Random(seed)
    letters, most = rng.choice([1, 2, 3, 10]), rng.choice([1, 2, 4, 13])
    texts = [[rng.randint(1, letters) for _ in range(rng.randint(1, 30))] for _ in range(rng.randint(1, 8))]
    labels = [rng.randint(0, 50) for _ in texts]
    index = FMIndex([np.array(t) for t in texts], np.array(labels), most)
    queries = texts + [[rng.randint(0, letters + 1) for _ in range(rng.randint(0, 30))] for _ in range(5)]
    lengths, places = index.matching_statistics([np.array(q, np.int64) for q in queries])
    holds = lambda t, part: any(t[i : i + len(part)] == part for i in range(len(t) - len(part) + 1))
    for q, length, place in zip(queries, lengths, places):
        for i in range(len(q)):
            fits = [k for k in range(1, min(most, len(q) - i) + 1) if any(holds(t, q[i : i + k]) for t in texts)]
            assert length[i] == max(fits, default=0)
            if length[i] == most:
                assert index.least_label(place[i : i + 1])[0] == min(n for t, n in zip(texts, labels) if holds(t, q[i : i + most]))


def by_hand(rows, width=13):
    first = {}
    words = [(i, (t or "").split()) for i, t in rows]
    number = lambda i: float("inf") if i is None else i
    for i, ws in words:
        for k in range(len(ws) - width + 1):
            key = tuple(ws[k : k + width])
            first[key] = min(first.get(key, float("inf")), number(i))
    out = []
    for i, ws in words:
        gone = set()
        for k in range(len(ws) - width + 1):
            if first[tuple(ws[k : k + width])] < number(i):
                gone |= set(range(k, k + width))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def found(docs):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    rows = substring.repeated_passages(docs).select("doc_id", "n_words", removed, F.sha2("kept", 256))
    return sorted(map(tuple, rows.collect()), key=str)


@pytest.mark.parametrize("often", [2000, 1])  # no gram is dealt by windows, every one is
def test_passages_equal_brute_force(spark, monkeypatch, often):
    monkeypatch.setattr(substring, "OFTEN", often)
    monkeypatch.setattr(substring, "PART_BITS", 2)
    monkeypatch.setattr(substring, "SHARD", 40)
    monkeypatch.setattr(substring, "BATCH", 2000)
    rng = random.Random(often)
    word = lambda: f"w{rng.randrange(400)}"
    shared = [[word() for _ in range(n)] for n in (12, 13, 14, 30, 60)]
    data = []
    for i in rng.sample(range(1000), 60):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += [word() for _ in range(rng.randint(0, 20))] + rng.choice(shared)[rng.randint(0, 2) :]
        data.append((i, rng.choice([" ", "\n", " \t "]).join(text)))
    data += [(5000 + i, data[3][1]) for i in range(6)] + [(5000, data[3][1]), (7, "a " * 60), (8, "a " * 20), (9, "b " * 12)]
    data += [(None, data[3][1]), (None, data[5][1]), (1, None), (2, ""), (2, " \n"), (3, "Größe 漢字 " * 9), (4, "größe 漢字 " * 9), (6, "Größe 漢字 " * 8)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in data], "doc_id long, text string, part long, kept string").repartition(3)
    assert found(docs) == sorted(by_hand(data), key=str)


def test_a_long_text_and_nothing(spark):
    long = " ".join(f"t{i % 9973}" for i in range(300_000))
    data = [(1, "x " + " ".join(f"t{i}" for i in range(100, 130))), (2, long), (3, long)]
    assert found(spark.createDataFrame(data, "doc_id long, text string")) == sorted(by_hand(data), key=str)
    assert found(spark.createDataFrame([], "doc_id long, text string")) == []
