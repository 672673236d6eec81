"""The registered queries over whole small tables against brute force in plain Python."""

import hashlib
import re
import zlib
from base64 import b32encode
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def table(name, columns, order):
    return duckdb.sql(f"select {columns} from '{SF}/{name}.parquet' order by {order}").fetchall()


@pytest.fixture(scope="module")
def texts():
    return {i: t or "" for i, t in table("documents", "doc_id, text", "doc_id")}


@pytest.fixture(scope="module")
def result(spark):
    def run(name):
        return {r[0]: r for r in driver.queries()[name](spark, SF).collect()}

    return run


def test_license_scan(result, texts):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    rows = result("op1_license_scan")
    assert rows.keys() == texts.keys()
    some = 0
    for i, text in texts.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        found = []
        for phrase, label in phrases.items():
            p = phrase.split()
            found += [(k, label) for k in range(len(words)) if words[k : k + len(p)] == p]
        r = rows[i]
        places = [k for k, _ in found]
        assert (r.n_words, r.n_base) == (len(words), len(found))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if found else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in found}))
        assert {x for _, x in found} <= set(r.labels.split(",")) and 0 <= r.score <= 1
        some += bool(found)
    assert some > 1


def test_jaccard(result, texts):
    rows = result("op2_jaccard_join")
    sets = {}
    for i, text in texts.items():
        w = SPACED.findall(lower(text))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    label = {i: i for i in sets}
    pairs = [
        (i, j) for i in sets for j in sets
        if i < j and (both := len(sets[i] & sets[j])) and 100 * both >= 75 * len(sets[i] | sets[j])
    ]
    for _ in sets:
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    assert pairs
    assert {i: (r.n_shingles, r.component_id) for i, r in rows.items()} == {i: (len(s), label[i]) for i, s in sets.items()}


def test_quality_rules(result, texts):
    rows = result("op3_quality_rules")
    for i, text in texts.items():
        w, r = SPACED.findall(text), rows[i]
        windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        twice = {k + d for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for d in range(8)}
        lines, seen = 0, set()
        for line in text.split("\n"):
            if SPACED.search(line):
                lines += line in seen
                seen.add(line)
        failed = len(w) < 20 or 100 * len(twice) > 30 * len(w)
        expected = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(twice), failed)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == expected
        assert not (r.kept and failed)
    judged = table("labels", "doc_id, quality", "doc_id")
    kept = [rows[i].kept for i, q in judged if q == 1 and not rows[i].base_failed]
    dropped = [not rows[i].kept for i, q in judged if q == 0]
    assert np.mean(kept) > 0.97 and np.mean(dropped) > 0.9


def held_out_accuracy(rows, truth, predicted):
    judged = [(predicted(rows[i]), y) for i, y in truth if rows[i].held_out and y is not None]
    return np.mean([a == b for a, b in judged]), len(judged)


def test_quality_classifier(spark):
    sf = SF.replace("0.001", "0.01")
    rows = {r[0]: r for r in driver.queries()["op4_quality_classifier"](spark, sf).collect()}
    truth = duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)
    accuracy, n = held_out_accuracy(rows, truth, lambda r: r.predicted)
    assert n > 50 and accuracy > 0.95


def test_token_files(result, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows, start = result("op5_token_binary"), 0
    assert rows.keys() == texts.keys()
    for i in sorted(texts):
        ids = np.array([*tokenizer.encode(texts[i], add_special_tokens=False).ids, 0], "<u4")
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_warc(result):
    rows, first = result("op6_warc"), {}
    pages = table("pages", "page_id, html", "page_id")
    assert len(rows) == len(pages)
    for i, html in pages:
        payload, r = (html or "").encode(), rows[i]
        other = first.setdefault(payload, i)
        assert (r.payload_bytes, r.payload_digest) == (len(payload), b32encode(hashlib.sha1(payload).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if other == i else ("revisit", other))


def test_embedding_dedup(spark):
    sf = SF.replace("0.001", "0.1")
    rows = {r[0]: r for r in driver.queries()["op7_embedding_dedup"](spark, sf).collect()}
    data = duckdb.sql(f"select vec_id, embedding from '{sf}/embeddings.parquet' order by vec_id").fetchall()
    x = np.array([v for _, v in data], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    for _ in label:
        label = np.minimum(label, np.where(near, label[None, :], len(x)).min(1, initial=len(x)))
    ids = [i for i, _ in data]
    for k, i in enumerate(ids):
        c = ids[label[k]]
        assert (rows[i].n_links, rows[i].component_id, rows[i].kept) == (near[k].sum(), c, c == i)


def test_prefix_bpe(result, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = result("op8_prefix_bpe")
    for i, text in texts.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_language_id(spark):
    sf = SF.replace("0.001", "0.01")
    rows = {r[0]: r for r in driver.queries()["op9_language_id"](spark, sf).collect()}
    truth = duckdb.sql(f"select doc_id, lang from '{sf}/documents.parquet'").fetchall()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    accuracy, n = held_out_accuracy(rows, truth, lambda r: r.lang_pred)
    assert n > 200 and accuracy > 0.97


def test_packing(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = driver.queries()["op10_packing"](spark, SF).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for i, parts in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[i], add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert (r.start, r.offset, r.doc_tokens) == (at, 0, len(ids))
            assert r.length <= 2048 and r.length & (r.length - 1) == 0
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_pipeline(spark, texts, tmp_path):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, quality = docs.columns, dict(table("labels", "doc_id, quality", "doc_id"))
    kept = {r[0] for r in docs.select("doc_id").collect()}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert k == len(pipeline.STAGES) - 1 or out.columns == columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        left = {r[0] for r in docs.select("doc_id").distinct().collect()}
        assert left <= kept
        if name == "quality_classifier":
            good = [i for i, q in quality.items() if q == 1 and texts[i]]
            assert np.mean([i in left for i in good]) > 0.97
            assert np.mean([i not in left for i, q in quality.items() if q == 0]) > 0.8
        if name == "language_id":
            assert len(left) > 0.97 * len(kept)
        kept = left
    ids = {r[0] for r in pipeline.run(spark, SF).select("doc_id").distinct().collect()}
    assert ids == kept
