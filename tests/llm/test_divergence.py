"""Divergence of sources against plain counting, with cells of several sizes."""

import re
import tracemalloc
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from linkloom.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long"


def by_hand(rows, least, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        words = term.findall((text or "").translate(lower))
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = set()
    for lang in {g[0] for g in counts}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        groups = {g[1]: c for g, c in counts.items() if g[0] == lang}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[k] for k in kept) + 5 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in groups.items()}, share(sum(groups.values(), Counter()))
        for s, own in p.items():
            pairs = [(-sum(abs(own[t] - p[o][t]) for t in kept), o.encode(), o) for o in p if o != s]
            out |= {(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(sorted(pairs))}
            terms = sorted((q[t] - own[t], t.encode(), t) for t in kept if groups[s][t] and own[t] > q[t])[:top]
            out |= {(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(terms)}
    return out


ROWS = [
    (i, text, lang, f"s{i % 7}" if i % 5 else None, "clash", 3)
    for i, (text, lang) in enumerate(
        [("The cat and THE dog, größe Ä ä", "en"), ("der Hund und die Katze 12 x_y", "de"), ("cat cat dog", "en"), (None, "en"), ("", None)] * 12
    )
] + [(None, "the the the", "en", "s1", "", 0), (3, "only", "fr", "a", "", 0), (3, "else", "fr", "b", "", 0), (4, None, None, None, None, None)]


@pytest.mark.parametrize(("groups", "terms"), [(16, 4096), (2, 2), (1, 1), (3, 5)])
def test_divergence_equals_counting(spark, groups, terms):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    found = divergence.source_divergence(docs, least=3, top=2, groups=groups, terms=terms)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert {tuple(r) for r in found.collect()} == by_hand(ROWS, 3, 2)


def test_divergence_of_nothing(spark):
    assert divergence.source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shares_are_exact_beyond_a_long(spark):
    c, n, v = 4_000_000_000_001, 8_999_999_999_999_000, 123_457
    row = spark.sql(f"SELECT {c}L AS c, {n}L AS n, {v}L AS v").selectExpr(divergence._share("c", "n", "v") + " AS p").first()
    assert row.p == 1 + 10**9 * (c + 5) // (n + 5 * v)


def test_a_long_text_is_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 10)
    words = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(500)]
    rows = [(1, " ".join(words * 200), "en", "a", "", 0), (2, " ".join(words[:300]), "en", "b", "", 0)]
    found = divergence.source_divergence(spark.createDataFrame(rows, SCHEMA), least=1)
    assert {tuple(r) for r in found.collect()} == by_hand(rows, 1, 50)


def test_counting_many_terms_takes_little_memory():
    """Distinct terms of a task, held twice and handed on as rows at once, took a worker's memory."""

    def batches():
        for k in range(60):
            texts = [" ".join(f"w{chr(97 + i % 26)}q{'abcdefghij'[j // 100]}{chr(97 + j // 10 % 10)}{chr(97 + j % 10)}x{chr(97 + k % 26)}{chr(97 + k // 26)}" for j in range(1000)) for i in range(6)]
            yield pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * 6), pa.array([f"s{k % 3}"] * 6)], ["text", "lang", "source"])

    tracemalloc.start()
    n, docs = 0, 0
    for out in divergence.count_batches(batches()):
        n += sum(out.column("n").to_pylist())
        docs += sum(d for d, t in zip(out.column("docs").to_pylist(), out.column("term").to_pylist()) if t is None)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert (n, docs) == (360_000, 360)
    assert peak < 45e6, peak
