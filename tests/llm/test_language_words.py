"""Words of any length and script: whole words, no cuts, the same sums as the short way."""

import re
import time

import numpy as np
import public_tokenizers
import pytest

from linkloom.llm import language

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_words_are_letters_with_their_marks():
    assert language.words_of("½ ①② Ⅷ 12 _ ٣") == []
    assert language.words_of("हिन्दी भाषा") == ["हिन्दी", "भाषा"]
    assert language.words_of("Ça ét́ x½y z2z") == ["ça", "ét́", "x", "y", "z", "z"]
    assert language.words_of("Straße, NAÏVE") == ["straße", "naïve"]


def test_long_words_have_the_sums_of_lattices():
    vocab = {"▁": 0, "a": 1, "b": 2, "ab": 3, "▁a": 4, "aba": 5}
    p = np.random.default_rng(1).uniform(0.1, 2.0, (7, 3))
    words = ["a", "ab", "abcab", "ba" * 19]
    lattice = language.Lattice(words, vocab, 3)
    short, share = lattice.log_likelihood(p), lattice.expected(p[:, :1])
    for k, w in enumerate(words):
        word = language.LongWord(w, vocab)
        assert np.allclose(word.log_likelihood(p), short[k])
        counts = np.zeros(7)
        word.expected(p[:, :1], counts, 2.0)
        assert np.allclose(counts, 2 * np.bincount(lattice.piece, share * (lattice.word == k), 7))


@pytest.mark.parametrize("letters", [41, 10_000])
def test_a_long_run_is_one_word(letters):
    """Its sum is that of its parts only where no piece crosses them."""
    vocab = {"▁": 0, "a": 1, "b": 2}
    p = np.array([[0.5], [0.2], [0.1], [0.01]])
    found = language.LongWord("ab" * letters, vocab).log_likelihood(p)
    assert np.allclose(found, np.log(0.5) + letters * np.log(0.02))


def test_texts_without_letters_and_long_runs(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("der die das und nicht", "de"), ("the and of with not", "en")] * 5)]
    rows += [(100, "½ ① Ⅷ", None), (101, "dieund" * 3000, None), (102, "theand" * 3000, None), (103, "हिन्दी", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit_languages(docs, PIECES)
    found = {r.doc_id: r.lang_pred for r in language.predict_languages(docs, model, PIECES).collect()}
    assert found[100] == "und" and found[101] == "de" and found[102] == "en" and found[103] != "und"


def test_words_with_accents_cost_no_more_than_a_search_for_letters():
    """Looking for marks one class of characters after another took several times as long."""
    text = "Fühlt der naïve Gärtner él niño, größer 12 Äpfel. " * 20_000
    language.words_of("é")

    def seconds(work):
        taken = []
        for _ in range(3):
            begun = time.perf_counter()
            work(text)
            taken.append(time.perf_counter() - begun)
        return min(taken)

    letters = re.compile(r"[^\W\d_]+")
    assert language.words_of(text) == letters.findall(text.lower())
    assert seconds(language.words_of) < 2 * seconds(letters.findall)
