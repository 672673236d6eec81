"""Language of a text by unigram pieces, with the segmentation marginalised.

The pieces are those of a fixed public vocabulary. A word's probability in a language is the
sum over all ways to cut it into pieces, found by the forward algorithm; a text's is the
product over its words. Piece probabilities per language are expected counts over all cuts
(one step of expectation maximisation from equal probabilities) in all training texts.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import carried, id_remainder, map_texts, pieces, strings, table, worker_cache

UNKNOWN, SMOOTHING = "und", 0.05
#: Words of more letters go by one at a time and are not remembered.
SHORT = 40
#: Words of at most SHORT letters remembered per worker; all are forgotten when it is full.
REMEMBERED = 900_000
_LETTERS = re.compile(r"[^\W\d_]+")


def vocabulary(path: str) -> dict[str, int]:
    """Ordinary pieces of a sentencepiece model, numbered."""
    import sentencepiece

    cache = worker_cache("pieces")
    if path not in cache:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        odd = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
        names = dict.fromkeys(model.id_to_piece(i) for i in ids if not odd(i))
        cache[path] = {name: k for k, name in enumerate(names)}
    return cache[path]


def piece_trie(vocab: dict[str, int]) -> list:
    """Nodes ``[piece or -1, next node by letter]``: following letters meets the pieces that begin there."""
    cache = worker_cache("trie")
    if cache.get("of") is not vocab:
        root = [-1, {}]
        for name, piece in vocab.items():
            node = root
            for letter in name:
                node = node[1].setdefault(letter, [-1, {}])
            node[0] = piece
        cache.update(of=vocab, root=root, longest=max(map(len, vocab), default=1))
    return cache["root"]


def kinds_of_characters() -> np.ndarray:
    """For each code point 1 if ``_LETTERS`` takes it, 2 if it is odd, else 0.

    Odd are marks, and numbers that are no decimal digits: what keeps ``_LETTERS`` from being runs
    of letters.
    """
    cache = worker_cache("kinds of characters")
    if "is" not in cache:
        odd = lambda c: unicodedata.category(c)[0] == "M" or (c.isalnum() and not c.isalpha() and not c.isdecimal())
        kinds = np.zeros(sys.maxunicode + 1, np.uint8)
        for run in _LETTERS.finditer("".join(map(chr, range(sys.maxunicode + 1)))):
            kinds[run.start() : run.end()] = 1
        kinds[[i for i in range(128, sys.maxunicode + 1) if odd(chr(i))]] = 2
        cache["is"] = kinds
    return cache["is"]


def words_of(text: str) -> list[str]:
    """Runs of letters with their marks, in lower case; each is cut alone, as pieces don't cross words."""
    text = text.lower()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = kinds_of_characters()[codes]
    if (kinds == 2).any():
        import regex

        return regex.findall(r"\p{L}[\p{L}\p{M}]*", text)
    # No letter is a blank, so what is left between others is the runs.
    return np.where(kinds == 1, codes, np.uint32(32)).tobytes().decode("utf-32-le", "surrogatepass").split()


class LongWord:
    """All cuts of one word of any length, letter by letter; sums are kept near one on the way."""

    def __init__(self, word: str, vocab: dict[str, int]):
        self.letters, self.none, self.begins = "▁" + word, len(vocab), piece_trie(vocab)[1]
        self.longest = worker_cache("trie")["longest"]

    def _from(self, i: int) -> Iterator[tuple[int, int]]:
        """Where the pieces that begin at a place end, and which they are; a letter may be none."""
        node, end = self.begins.get(self.letters[i]), i + 1
        if node is None or node[0] < 0:
            yield end, self.none
        while node is not None:
            if node[0] >= 0:
                yield end, node[0]
            if end == len(self.letters):
                break
            node, end = node[1].get(self.letters[end]), end + 1

    def log_likelihood(self, p: np.ndarray) -> np.ndarray:
        """The forward sum of every language, in a window as long as the longest piece."""
        span, moved = self.longest + 1, 0.0
        window = np.zeros((span, p.shape[1]))
        window[0] = 1
        for i in range(len(self.letters)):
            here = window[i % span].copy()
            window[i % span] = 0
            if not 1e-60 < (top := here.max()) < 1e60 and top > 0:
                window, here, moved = window / top, here / top, moved + math.log(top)
            for end, piece in self._from(i):
                window[end % span] += here * p[piece]
        return np.log(np.maximum(window[len(self.letters) % span], 1e-290)) + moved

    def expected(self, p: np.ndarray, counts: np.ndarray, times: float) -> None:
        """Add to ``counts`` how often each piece is used, over all cuts, ``times`` over; ``p`` has one column."""
        logs, n = np.log(p[:, 0]), len(self.letters)

        def more(a: float, b: float) -> float:
            low, high = min(a, b), max(a, b)
            return high if low == -math.inf else high + math.log1p(math.exp(low - high))

        before, after = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]
        for i in range(n):
            for end, piece in self._from(i):
                before[end] = more(before[end], before[i] + logs[piece])
        for i in reversed(range(n)):
            for end, piece in self._from(i):
                after[i] = more(after[i], after[end] + logs[piece])
        for i in range(n):
            for end, piece in self._from(i):
                counts[piece] += times * math.exp(before[i] + logs[piece] + after[end] - before[n])


class Lattice:
    """All cuts of some words of at most SHORT letters: an edge for each piece at each place."""

    def __init__(self, words: list[str], vocab: dict[str, int], longest: int):
        base, at, none, packed = [], 0, len(vocab), []
        add, begins = packed.append, piece_trie(vocab)[1]
        for k, w in enumerate(words):
            w = "▁" + w
            n = len(w)
            base.append(at)
            at += n + 1
            for i in range(n):
                node, place = begins.get(w[i]), (k << 6 | i) << 6 | i
                if node is None or node[0] < 0:  # a letter outside the vocabulary is a piece of its own
                    add((place + 1) << 24 | none)
                if node is None:
                    continue
                for letter in w[i + 1 : i + longest]:
                    place += 1
                    if node[0] >= 0:
                        add(place << 24 | node[0])
                    node = node[1].get(letter)
                    if node is None:  # no piece begins like this
                        break
                else:
                    if node[0] >= 0:
                        add((place + 1) << 24 | node[0])
        self.base, self.size = np.array(base, np.int64), at
        self.lengths = np.array([len(w) + 1 for w in words], np.int64)
        edges = np.array(packed, np.int64)  # word, start, end (6 bits each) and piece (24 bits)
        self.piece, word = edges & 0xFFFFFF, edges >> 36
        start, end = edges >> 30 & 63, edges >> 24 & 63
        self.word = word
        self.tail, self.head = self.base[word] + start, self.base[word] + end
        self.start, self.end = start, end

    @staticmethod
    def _steps(key: np.ndarray, then: np.ndarray):
        """Edges in runs of equal ``key``, and in each where ``then`` changes."""
        order = np.lexsort((then, key))
        cuts = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
        for a, b in zip(cuts, np.append(cuts[1:], len(order))):
            edges = order[a:b]
            t = then[edges]
            yield edges, np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Sum over all cuts up to each place; ``p`` has a column per language."""
        alpha = np.zeros((self.size, p.shape[1]))
        alpha[self.base] = 1
        for edges, runs in self._steps(self.end, self.head):
            got = np.add.reduceat(alpha[self.tail[edges]] * p[self.piece[edges]], runs, axis=0)
            alpha[self.head[edges[runs]]] = got
        return alpha

    def backward(self, p: np.ndarray) -> np.ndarray:
        beta = np.zeros((self.size, p.shape[1]))
        beta[self.base + self.lengths] = 1
        steps = list(self._steps(self.start, self.tail))
        for edges, runs in reversed(steps):
            got = np.add.reduceat(beta[self.head[edges]] * p[self.piece[edges]], runs, axis=0)
            beta[self.tail[edges[runs]]] = got
        return beta

    def log_likelihood(self, p: np.ndarray) -> np.ndarray:
        """A row per word. ``p`` is raised by a constant per letter, which keeps sums near one."""
        alpha = self.forward(p)
        return np.log(np.maximum(alpha[self.base + self.lengths], 1e-290))

    def expected(self, p: np.ndarray) -> np.ndarray:
        """For each edge the share of all cuts, by probability, that use it."""
        alpha, beta = self.forward(p), self.backward(p)
        total = alpha[self.base + self.lengths][self.word, 0]
        return alpha[self.tail, 0] * p[self.piece, 0] * beta[self.head, 0] / total


def _longest(vocab: dict[str, int]) -> int:
    return min(SHORT + 1, max(map(len, vocab)))


def count_pieces(docs: DataFrame, path: str) -> DataFrame:
    """``(lang, piece, n)``: expected piece counts of every training text, summed per task first.

    ``piece`` -1 counts texts. Rows with null text or language teach nothing.
    """
    def count(batches):
        vocab = vocabulary(path)
        longest, flat = _longest(vocab), np.full((len(vocab) + 1, 1), 0.05)
        sums: dict[str, np.ndarray] = {}
        texts_seen, held, long = Counter(), {}, 0

        def settle():
            every = set().union(*held.values())
            for w in [w for w in every if len(w) > SHORT]:
                word = LongWord(w, vocab)
                for lang, seen in held.items():
                    if w in seen:
                        sums.setdefault(lang, np.zeros(len(vocab) + 1))
                        word.expected(flat, sums[lang], seen[w])
            words = [w for w in every if len(w) <= SHORT]
            for i in range(0, len(words), 20_000):
                part = words[i : i + 20_000]
                lattice = Lattice(part, vocab, longest)
                share = lattice.expected(flat)
                for lang, seen in held.items():
                    n = np.array([seen.get(w, 0) for w in part], float)
                    got = np.bincount(lattice.piece, share * n[lattice.word], len(vocab) + 1)
                    sums[lang] = sums.get(lang, 0) + got
            held.clear()

        for batch in batches:
            for text, lang in zip(strings(batch.column(0)), batch.column(1).to_pylist()):
                texts_seen[lang] += 1
                words = words_of(text)
                held.setdefault(lang, Counter()).update(words)
                long += sum(len(w) for w in words if len(w) > SHORT)
                if sum(map(len, held.values())) > 600_000 or long > 10_000_000:
                    settle()
                    long = 0
        settle()
        for lang, n in texts_seen.items():
            got = sums.get(lang, np.zeros(len(vocab) + 1))
            hit = np.flatnonzero(got)
            yield pa.RecordBatch.from_pydict({
                "lang": [lang] * (len(hit) + 1), "piece": pa.array(np.append(hit, -1), pa.int32()),
                "n": np.append(got[hit], float(n)),
            })

    rows = docs.filter("text is not null and lang is not null").select("text", "lang")
    counted = rows.mapInArrow(count, "lang string, piece int, n double")
    return counted.groupBy("lang", "piece").agg(F.sum("n").alias("n"))


class LanguageModel:
    """Names of languages, log priors and piece probabilities (a column per language)."""

    def __init__(self, counts: list[tuple[str, int, float]], vocab: dict[str, int]):
        self.langs = sorted({c[0] for c in counts})
        column = {lang: k for k, lang in enumerate(self.langs)}
        seen, n = np.zeros((len(vocab) + 1, len(self.langs))), np.ones(len(self.langs))
        for lang, piece, c in counts:
            if piece < 0:
                n[column[lang]] += c
            else:
                seen[piece, column[lang]] += c
        p = (seen + SMOOTHING) / (seen.sum(0) + SMOOTHING * len(seen))
        # The same factor per letter for every language leaves their order and ratios as they are.
        letters = np.array([len(w) for w in vocab] + [1])
        self.p, self.priors = p * 10.0 ** letters[:, None], np.log(n / n.sum())
        self.name = uuid.uuid4().hex


def fit_languages(docs: DataFrame, path: str) -> LanguageModel:
    """Learn from every row of ``docs(text, lang)``; the driver gets languages x pieces numbers."""
    counts = [tuple(r) for r in count_pieces(docs, path).collect()]
    return LanguageModel(counts, vocabulary(path))


class _Scorer:
    """Log likelihoods of words, remembered by the worker while the model stays the same."""

    def __init__(self, model: LanguageModel, vocab: dict[str, int]):
        self.model, self.vocab, self.longest = model, vocab, _longest(vocab)
        cache = worker_cache("language words")
        if cache.get("model") != model.name:
            cache.clear()
            cache.update(model=model.name, known={}, rows=np.zeros((REMEMBERED, len(model.langs))))
        self.known, self.rows = cache["known"], cache["rows"]

    def learn(self, words: set[str]) -> None:
        words = {w for w in words if len(w) <= SHORT}
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(words)
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            first = len(self.known)
            found = Lattice(part, self.vocab, self.longest).log_likelihood(self.model.p)
            self.rows[first : first + len(part)] = found
            self.known.update(zip(part, range(first, first + len(part))))

    def posterior(self, words: list[str]) -> np.ndarray:
        short = [w for w in words if len(w) <= SHORT]
        at = np.fromiter(map(self.known.__getitem__, short), np.int64, len(short))
        v = self.rows[at].sum(0) + self.model.priors
        if len(short) < len(words):
            for w in words:
                if len(w) > SHORT:
                    v = v + LongWord(w, self.vocab).log_likelihood(self.model.p)
        v = np.exp(v - v.max())
        return v / v.sum()


def predict_languages(docs: DataFrame, model: LanguageModel, path: str, carry: bool = False) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row; the score is the language's posterior.

    Null text, and text without a letter, is ``und`` with score 0, and so is all where no
    language was learned. Ties go to the first name. Null and repeated ids are kept, other
    columns ignored; an empty table gives no rows. With ``carry`` the whole row comes along as
    ``row``.
    """
    def predict(batch):
        scorer = _Scorer(model, vocabulary(path)) if model.langs else None
        texts = strings(batch.column(1))
        for part in pieces([len(t) for t in texts], 1 << 18):
            cut = [words_of(t) for t in texts[part]]
            names, scores = [UNKNOWN] * len(cut), [0.0] * len(cut)
            if scorer:
                scorer.learn(set().union(*cut))
                for k, words in enumerate(cut):
                    if words:
                        p = scorer.posterior(words)
                        best = int(p.argmax())
                        names[k], scores[k] = model.langs[best], float(p[best])
            yield {n: batch.column(n)[part] for n in kept} | {"lang_pred": names, "score": scores}

    kept, row, schema = carried(docs, carry)
    kept = ["doc_id", *kept]
    rows = docs.select(F.col("doc_id").cast("long"), "text", *row)
    return map_texts(rows, predict, f"doc_id long, lang_pred string, score double{schema}", *rows.columns)


def op9_language_id(spark, sf: str, path: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = id_remainder("doc_id", 3) == 1
    model = fit_languages(docs.filter(~held_out), path)
    predicted = predict_languages(docs, model, path)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
