"""Candidates and nearest providers against brute force, around hubs and crowds."""

import math
import random
from collections import Counter, defaultdict

import pytest

from linkloom.operators import candidates, nearest
from linkloom.session import materialise


def best_by_hand(pairs, k):
    of_u, of_v = defaultdict(set), defaultdict(set)
    for u, v in pairs:
        of_u[u].add(v)
        of_v[v].add(u)
    out = set()
    for u, vs in of_u.items():
        score = Counter()
        for v in vs:
            for other in of_v[v] - {u}:
                score.update(of_u[other])
        ranked = sorted((-n, w) for w, n in score.items() if w not in vs)[:k]
        out |= {(u, w, -n, i + 1) for i, (n, w) in enumerate(ranked)}
    return out


def rows_of(df):
    return {tuple(r) for r in df.select("src", "dst", "score", "rank").collect()}


@pytest.mark.parametrize("sizes", [(64, 1000, 32), (3, 0, 1), (1, 0, 2), (100, 0, 1)])
def test_candidates_equal_brute_force(rows, sizes):
    rng = random.Random(sum(sizes))
    pairs = {(rng.randrange(30), 100 + min(int(rng.expovariate(0.1)), 24)) for _ in range(120)}
    pairs |= {(u, 100) for u in range(0, 30, 2)} | {(7, 100 + v) for v in range(25)}
    links = rows("src long, dst long", [*pairs, *list(pairs)[:20], (1, None), (None, 101)])
    assert rows_of(candidates.candidate_links(links, 3, *sizes)) == best_by_hand(pairs, 3)


def test_candidates_of_nothing(rows):
    assert candidates.candidate_links(rows("src long, dst long", []), 3).count() == 0


def test_candidate_rows_around_a_hub_grow_with_the_links(spark, monkeypatch):
    """Half of all links go to one provider; written rows grow as the links do."""

    def written(n):
        total = 0

        def counted(df, label, *more):
            nonlocal total
            out = materialise(df, label, *more)
            total += out.count()
            return out

        monkeypatch.setattr(candidates, "materialise", counted)
        links = spark.range(2 * n).selectExpr(
            "id div 2 AS src", f"CASE WHEN id % 2 = 0 THEN {10 * n} ELSE {10 * n + 1} + (id * 7919) % ({n} div 4) END AS dst"
        )
        found = candidates.candidate_links(links, 2, whole=100, first=4)
        assert found.select("src").distinct().count() == n
        return total

    assert written(2000) < 5 * written(500)


def km(a, b):
    la, lo, lb, lp = map(math.radians, (*a, *b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, max(h, 0.0))))


SPOTS = {
    "everywhere": lambda r: (r.uniform(-90, 90), r.uniform(-180, 180)),
    "one cell": lambda r: (45 + r.uniform(0, 1e-4), 9 + r.uniform(0, 1e-4)),
    "far north, across 180": lambda r: (r.uniform(84, 90), r.choice([-1, 1]) * r.uniform(178, 180)),
    "city and country": lambda r: (45 + r.gauss(0, r.choice([1e-3, 5])), 9 + r.gauss(0, r.choice([1e-3, 5]))),
    "few places": lambda r: (r.choice([-90.0, 0.0, 90.0]), r.choice([-180.0, 0.0, 180.0])),
}


@pytest.mark.parametrize("spots", SPOTS)
def test_nearest_equal_brute_force(rows, spots):
    rng = random.Random(spots)
    providers = [(i, *SPOTS[spots](rng)) for i in range(60)]
    patients = [(i, *SPOTS[rng.choice([spots, "everywhere"])](rng)) for i in range(40)]
    schema = "id long, lat double, lon double"
    odd = [(None, 1.0, 1.0), (900, None, 1.0), (901, 91.0, 0.0)]
    found = nearest.nearest_providers(rows(schema, patients + odd), rows(schema, providers + odd), 4, crowd=3)
    got = defaultdict(list)
    for r in found.collect():
        got[r.src_id].append((r["rank"], r.km, r.dst_id))
    assert set(got) == {p[0] for p in patients}
    for i, *here in patients:
        true = sorted((km(here, there), j) for j, *there in providers)[:4]
        mine = sorted(got[i])
        assert [r for r, _, _ in mine] == [1, 2, 3, 4]
        assert all(abs(a - b) < 1e-6 for (_, a, _), (b, _) in zip(mine, true))
        if spots == "everywhere":
            assert [j for _, _, j in mine] == [j for _, j in true]


def test_nearest_with_too_few(rows):
    schema = "id long, lat double, lon double"
    one = rows(schema, [(1, 10.0, 10.0)])
    assert nearest.nearest_providers(one, rows(schema, [(5, 0.0, 0.0), (4, 0.0, 0.0)]), 3).count() == 2
    assert nearest.nearest_providers(one, rows(schema, []), 3).count() == 0
