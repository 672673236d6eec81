"""Search between components against brute force; every set begins as a component of its own."""

import itertools
import random

import numpy as np
import pytest

from linkloom.llm import jaccard


@pytest.mark.parametrize("heavy", [10, 1_000_000])  # few tokens broadcast, all shared ones broadcast
def test_between_components_finds_every_link(spark, monkeypatch, heavy):
    monkeypatch.setattr(jaccard, "HEAVY", heavy)
    draw = random.Random(5)
    common = draw.sample(range(1, 1 << 62), 12)
    sets = []
    for _ in range(15):
        base = draw.sample(range(1, 1 << 62), draw.randint(4, 30))
        for _ in range(4):
            kept = [t for t in base if draw.random() > 0.08]
            sets.append(sorted({*kept, *common[: draw.choice([0, 6, 12])]}))
    sets.append(sorted(common))
    sets = list({tuple(s) for s in sets if s})
    wanted = set()
    for (i, a), (j, b) in itertools.combinations(enumerate(sets), 2):
        both = len(set(a) & set(b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            wanted.add(frozenset((i, j)))
    arrays = [np.array(s, np.uint64) for s in sets]
    names = {jaccard.set_digest(s): i for i, s in enumerate(arrays)}
    rows = [
        (bytearray(jaccard.set_digest(s)), len(s), jaccard.least_hash(s, jaccard.SEEDS[0]), bytearray(s.tobytes()))
        for s in arrays
    ]
    table = spark.createDataFrame(rows, "set_id binary, n long, k0 long, shingles binary")
    none = spark.createDataFrame([], "node binary, component binary")
    links = jaccard._between_components(table, none, 75).collect()
    found = {frozenset((names[bytes(r.a)], names[bytes(r.b)])) for r in links}
    assert wanted and joined(found, len(sets)) == joined(wanted, len(sets))


def joined(links, n):
    """The smallest member of each one's component."""
    least = list(range(n))
    for _ in range(n):
        for link in links:
            low = min(least[i] for i in link)
            for i in link:
                least[i] = low
    return least


def test_a_common_passage_routes_in_proportion(spark, monkeypatch):
    """Texts of one passage and little else: what is searched grows with their number, not its square."""

    def routed(n):
        sizes = {}
        whole = jaccard.materialise

        def counted(df, label, *more):
            out = whole(df, label, *more)
            sizes[label] = sizes.get(label, 0) + out.count()
            return out

        monkeypatch.setattr(jaccard, "materialise", counted)
        draw = random.Random(n)
        passage = draw.sample(range(1, 1 << 62), 40)
        sets = [np.sort(np.array(passage + draw.sample(range(1, 1 << 62), draw.randint(7, 13)), np.uint64)) for _ in range(n)]
        rows = [(bytearray(jaccard.set_digest(s)), len(s), i, bytearray(s.tobytes())) for i, s in enumerate(sets)]
        table = spark.createDataFrame(rows, "set_id binary, n long, k0 long, shingles binary")
        none = spark.createDataFrame([], "node binary, component binary")
        links = {frozenset((bytes(r.a), bytes(r.b))) for r in jaccard._between_components(table, none, 75).collect()}
        names = {jaccard.set_digest(s): i for i, s in enumerate(sets)}
        links = [{names[x] for x in link} for link in links]
        brute = [
            {i, j} for (i, a), (j, b) in itertools.combinations(enumerate(sets), 2) if 100 * 40 >= 75 * (len(a) + len(b) - 40)
        ]
        assert joined(links, n) == joined(brute, n)
        return sizes["routed"] + sizes["prefixes"], len(links)

    few, many = routed(60), routed(240)
    assert many[0] <= few[0] * 2 and many[1] <= 240 + 20


def test_lower_halves_of_linked_sets_share_enough():
    draw = random.Random(8)
    linked = 0
    for _ in range(4000):
        a = set(draw.sample(range(10_000), draw.randint(1, 24)))
        b = {t for t in a if draw.random() > 0.12} | set(draw.sample(range(10_000), draw.randint(0, 4)))
        both = len(a & b)
        if b and 100 * both >= 75 * (len(a) + len(b) - both):
            linked += 1
            (p, least), (q, other) = (jaccard.lower_half(np.array(sorted(s)), 75) for s in (a, b))
            assert len({*p.tolist()} & {*q.tolist()}) >= max(least, other)
    assert linked > 1000
