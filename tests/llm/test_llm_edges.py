"""Nulls, empty and long texts, repeats, empty tables and extra columns; parts against plain versions."""

import io
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from linkloom.llm import hamming, jaccard, language, licenses, line_crf, packing, prefix_bpe, quality, token_file, warc
from linkloom.llm.components import components
from linkloom.session import scratch_path

BYTES, WORDS, PIECES = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, lang string, set_id string, score string"
LONG = "one two three four five six seven eight nine ten. " * 4000
ROWS = [
    (1, None, "en", "x", None), (2, "", "en", "x", "y"), (3, " \n\t ", None, None, None), (None, "alpha beta gamma", "de", "", ""),
    (4, LONG, "en", None, None), (5, LONG, "en", None, None), (6, "Größe ça ïo <|endoftext|> 漢字   x  y\n\nz", "fr", None, None),
    (7, "a b", "en", None, None), (7, "a b", "en", None, None), (8, "MIT License. " * 3, "en", None, None),
]
LABELS = [(1, 0), (4, 1), (5, 1), (8, 0), (None, 1), (7, None)]


def operators(spark, docs):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int")
    return {
        "licenses": lambda: licenses.scan_licenses(docs),
        "jaccard": lambda: jaccard.jaccard_components(docs),
        "rules": lambda: line_crf.apply_rules(docs, line_crf.fit_field(docs, labels)),
        "quality": lambda: quality.score_quality(docs, quality.fit_quality(docs, labels)),
        "files": lambda: token_file.read_token_files(token_file.write_token_files(docs, BYTES, scratch_path(spark, "t"))),
        "bpe": lambda: prefix_bpe.encode_documents(docs, WORDS),
        "language": lambda: language.predict_languages(docs, language.fit_languages(docs, PIECES), PIECES),
        "packing": lambda: packing.pack_documents(docs, BYTES),
    }


@pytest.mark.parametrize("data", [ROWS, []], ids=["odd rows", "no rows"])
def test_odd_documents(spark, data):
    docs = spark.createDataFrame(data, SCHEMA)
    for name, run in operators(spark, docs).items():
        rows = run().collect()
        if name == "packing":
            assert sum(r.start == 0 for r in rows) == len(data)
        else:
            assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in data), name
        if data and name == "jaccard":
            found = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
            assert found[1] == (0, 1) and found[3] == (0, 3) and found[5][1] == 4 and found[7] == (1, 7)
            assert found[None][1] is None
        if data and name == "language":
            assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"}


def test_odd_pages(spark):
    schema = "page_id long, url string, html string, _digest string"
    data = [(3, None, "x", ""), (1, "u\r\nv", "x", ""), (2, "u", None, ""), (5, "u", "", ""), (None, "u", "x", ""), (1, "u", "x", "")]
    for rows in (data, []):
        manifest = warc.write_archives(spark.createDataFrame(rows, schema), scratch_path(spark, "w"))
        found = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in warc.read_archives(manifest).collect())
        expected = [(0, "response", 0), (1, "response", 0), (1, "response", 0), (2, "response", 0), (3, "revisit", 1), (5, "revisit", 2)]
        assert found == (expected if rows else [])


def test_damaged_archives():
    whole = warc.gzip_member(warc.page_record(1, "u", b"payload", None)) + warc.gzip_member(warc.page_record(2, None, b"", 1))
    read = lambda data: [warc.parse_page(*x)[0] for x in warc.WarcReader(io.BytesIO(data).read)]
    assert read(whole) == [1, 2] and read(b"") == []
    with pytest.raises(ValueError):
        read(whole[:-9])
    with pytest.raises(ValueError):
        read(warc.gzip_member(warc.page_record(1, "u", b"payload", None).replace(b"payload", b"playoad")))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []),
            (8, [1.0, 0.0, 0.0]), (9, [-1.0, 0.0]), (10, [1.0, 0.0]), (None, [1.0, 0.0]), (11, [None, 1.0])]
    for rows in (data, []):
        vectors = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, rep int")
        found = {r.vec_id: (r.n_links, r.component_id) for r in hamming.near_vectors(vectors).collect()}
        alone = {i: (0, i) for i in (3, 4, 5, 6, 7, 8, 9, 11, None)}
        assert found == (alone | dict.fromkeys((1, 2, 10), (2, 1)) if rows else {})


def test_components(spark):
    draw = random.Random(4)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(300, 340)]
    label = {x: x for pair in links for x in pair}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: c for x, c in label.items() if any(x in p and p[0] != p[1] for p in links)}


def test_divide_skip():
    draw = random.Random(7)
    for _ in range(300):
        lists = [sorted(draw.sample(range(60), draw.randrange(1, 40))) for _ in range(draw.randrange(1, 25))]
        starts = [draw.randrange(len(x) + 1) if draw.random() < 0.3 else 0 for x in lists]
        least = draw.randrange(1, len(lists) + 2)
        counts = Counter(v for x, s in zip(lists, starts) for v in x[s:])
        assert sorted(jaccard.divide_skip(lists, starts, least)) == sorted((v, n) for v, n in counts.items() if n >= least)


@pytest.mark.parametrize("bits", [1, 5, 8, 11, 16, 17, 24, 31, 32])
def test_packed_ids(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 20_003, dtype=np.uint64).astype(np.uint32)
    out = io.BytesIO()
    writer = token_file.TokenWriter(out, bits, 64)
    for k, part in enumerate(np.split(ids, [0, 1, 700, 700, 9000])):
        writer.add(k, part)
    writer.close()
    file = token_file.TokenFile(out)
    assert np.array_equal(np.concatenate([x for _, _, x in file.documents(run=1000)]), ids)
    for start, n in ((0, 0), (63, 2), (640, 64), (20_000, 3), (5, 9000)):
        assert np.array_equal(file.read(start, n), ids[start : start + n])
    assert token_file.bits_for(50257) == 16


def test_prefix_bpe_on_random_text():
    library, encoder = Tokenizer.from_file(WORDS), prefix_bpe.WordEncoder(WORDS)
    draw = random.Random(1)
    alphabet = "aaabbcdehilnorstuTHE  \n'.,!0123-_éßİſΣσ漢字🙂́ \x1c\x85"
    for _ in range(400):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randrange(60))) + draw.choice(["", "<|endoftext|> I'LL they've"])
        ids = library.encode(text, add_special_tokens=False).ids
        found, decoded = encoder.encode(text)
        assert np.frombuffer(found, "<u4").tolist() == ids
        assert decoded == library.decode(ids, skip_special_tokens=False)


def test_token_stream_on_random_text():
    from linkloom.llm.token_stream import TokenStream

    library, stream, draw = Tokenizer.from_file(BYTES), TokenStream(BYTES), random.Random(2)
    alphabet = "aaabcdeTHE   \n\t'.,!09-_éßΣ漢🙂́ \x1c\x85 "
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(60))) for _ in range(600)] + ["it's I'll <|endoftext|> a", ""]
    assert [x.tolist() for x in stream.ids(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_forward_sums_all_cuts():
    vocab = {p: k for k, p in enumerate(["▁", "a", "b", "ab", "▁a", "ba", "▁ab"])}
    p = np.random.default_rng(3).random((len(vocab) + 1, 2))

    def total(s, k):
        return 1.0 if not s else sum(p[i, k] * total(s[len(w) :], k) for w, i in vocab.items() if s.startswith(w))

    words = ["ab", "abab", "b", "aab"]
    found = np.exp(language.Lattice(words, vocab, 3).log_likelihood(p))
    assert np.allclose(found, [[total("▁" + w, k) for k in (0, 1)] for w in words])


def test_chain_field_against_all_labellings():
    import itertools

    draw = np.random.default_rng(5)
    field = line_crf.ChainField()
    field.w, field.t = draw.normal(size=field.w.shape), draw.normal(size=(2, 2))
    x, y = draw.normal(size=(1, 6, line_crf.FEATURES)), draw.integers(0, 2, (1, 6))
    scores = x[0] @ field.w
    value = lambda v: sum(scores[k, v[k]] for k in range(6)) + sum(field.t[a, b] for a, b in zip(v, v[1:]))
    every = list(itertools.product((0, 1), repeat=6))
    likelihood, dw, dt = field.gradient(x, y, np.ones((1, 6), bool))
    assert np.isclose(likelihood, value(y[0]) - np.log(sum(np.exp(value(v)) for v in every)))
    assert field.decode(scores, np.array([0, 6])).tolist() == list(max(every, key=value))
    for weights, d in ((field.w, dw), (field.t, dt)):
        weights[1, 0] += 1e-6
        assert np.isclose((field.gradient(x, y, np.ones((1, 6), bool))[0] - likelihood) / 1e-6, d[1, 0], atol=1e-4)
        weights[1, 0] -= 1e-6


def test_attention_gradients():
    draw = np.random.default_rng(6)
    model = quality.AttentionModel(5)
    x, firsts, y = draw.normal(size=(7, 5)), np.array([0, 3, 4, 7]), np.array([1.0, 0, 1])

    def loss():
        s = model._forward(x, firsts)[-1]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    base, found = loss(), model.gradients(x, firsts, y)
    for name, d in found.items():
        at = (0,) * d.ndim
        model.p[name][at] += 1e-6
        assert np.isclose((loss() - base) / 1e-6, d[at], atol=1e-4), name
        model.p[name][at] -= 1e-6


def test_matching_statistics():
    draw = random.Random(8)
    sequences = [[draw.randrange(4) for _ in range(draw.randrange(1, 15))] for _ in range(5)]
    automaton = licenses.GeneralisedAutomaton(sequences)
    runs = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    text = [draw.randrange(5) for _ in range(200)]
    lengths, states = automaton.statistics(text)
    for k, (n, s) in enumerate(zip(lengths, states)):
        best = max((m for m in range(k + 2) if m == 0 or tuple(text[k + 1 - m : k + 1]) in runs))
        ends = {(i, j) for i, q in enumerate(sequences) for j in range(n, len(q) + 1) if q[j - n : j] == text[k + 1 - n : k + 1]}
        assert n == best and (not n or set(automaton.ends[s]) == ends)


def test_license_spans():
    text = ("some words " + licenses.TEMPLATES["bsd-3-clause"].replace("binary", "tarball") + " more").encode()
    spans = licenses.LicenseScanner().scan(licenses.words_of(text))[1]
    assert [s[2] for s in spans] == ["bsd-3-clause"] and spans[0][3] > 0.9
