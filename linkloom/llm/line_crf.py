"""Quality rules over lines: a linear-chain conditional random field marks content or boilerplate.

The field is trained on the lines of labelled documents, each line taking its document's
quality as label; neighbouring lines pull each other's labels together. Viterbi decoding
labels every line, and the share of words in content lines decides whether a text is kept.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import binaries, map_texts, pieces, table, window_hashes, word_hashes
from linkloom.llm.quality import training_labels

#: Most labelled documents the field is fitted on; lines of one sequence in training.
FIT_DOCUMENTS, SEQUENCE = 2000, 64
STEPS, RATE, DECAY = 150, 0.1, 1e-3
LEAST_WORDS, MOST_REPEATED, WINDOW, LEAST_CONTENT = 20, 30, 8, 0.5

# Fixed value: the symbols that are counted.
SYMBOLS = b"#*$%&|<>"

_GROUPS = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", SYMBOLS, b"0123456789", b"!?", b".,;:", b"|\t", b"{}[]()=_\\/")
_MEMBER = np.zeros((len(_GROUPS), 256), np.int64)
for _k, _group in enumerate(_GROUPS):
    _MEMBER[_k, list(_group)] = 1
#: Shares of letters by group, word length, words, repeated words, repeated line, ends a sentence, no words, one.
FEATURES = len(_GROUPS) + 7


class Lines:
    """Lines of some texts in a row, with what the rules count and the field looks at."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        ends = np.flatnonzero(buf == 10)
        starts = np.concatenate([[0], ends[:-1] + 1])
        sizes = np.array([len(t) + 1 for t in texts])
        doc_ends = np.cumsum(sizes)
        #: First line of each text, and one entry more.
        self.firsts = np.concatenate([[0], np.searchsorted(starts, doc_ends[:-1]), [len(starts)]])
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.firsts))

        space = (buf == 32) | ((buf >= 9) & (buf <= 13))
        letter = ~space & ((buf & 0xC0) != 0x80)
        self.letters = np.add.reduceat(letter.astype(np.int64), starts)
        begin = ~space
        begin[1:] &= space[:-1]
        at = np.flatnonzero(begin)
        self.word_line = np.searchsorted(starts, at, side="right") - 1
        self.words = np.bincount(self.word_line, minlength=len(starts))
        self.hashes, self.places = word_hashes(texts)
        self.counts = np.stack([np.add.reduceat(_MEMBER[k][buf], starts) for k in range(len(_GROUPS))], axis=1)
        filled = np.flatnonzero(~space)
        last = np.searchsorted(filled, ends) - 1
        tail = np.where(last >= 0, buf[filled[np.maximum(last, 0)]] if len(filled) else 0, 0)
        self.sentence = (self.words > 0) & np.isin(tail, list(b".!?"))
        self.repeated = self._repeated_lines()

    def _repeated_lines(self) -> np.ndarray:
        """Whether an earlier line of the text is the same, for lines with a word."""
        out, at = np.zeros(len(self.doc), bool), 0
        words = self.words.tolist()
        for text in self.texts:
            seen = set()
            for line in text.split(b"\n"):
                if words[at]:
                    if line in seen:
                        out[at] = True
                    seen.add(line)
                at += 1
        return out

    def per_text(self, of_lines: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, of_lines, len(self.texts)).astype(np.int64)

    def repeated_words(self) -> np.ndarray:
        """Words of each text in windows of ``WINDOW`` words that the text holds twice or more."""
        windows = window_hashes(self.hashes, WINDOW)
        out = np.zeros(len(self.texts), np.int64)
        for k, (s, e) in enumerate(zip(self.places[:-1].tolist(), self.places[1:].tolist())):
            n = e - s - WINDOW + 1
            if n < 2:
                continue
            _, back, times = np.unique(windows[s : s + n], return_inverse=True, return_counts=True)
            twice = np.flatnonzero(times[back] > 1)
            if len(twice):
                edge = np.zeros(e - s + 1, np.int64)
                np.add.at(edge, twice, 1)
                np.add.at(edge, twice + WINDOW, -1)
                out[k] = np.count_nonzero(np.cumsum(edge[:-1]))
        return out

    def features(self) -> np.ndarray:
        k, n = len(_GROUPS), np.maximum(1, self.letters)
        x = np.zeros((len(self.doc), FEATURES))
        x[:, :k] = self.counts / n[:, None]
        x[:, k] = np.minimum(3, n / np.maximum(1, self.words) / 6)
        x[:, k + 1] = np.minimum(1, self.words / 20)
        same = np.zeros(len(self.hashes), bool)
        same[1:] = (self.hashes[1:] == self.hashes[:-1]) & (self.word_line[1:] == self.word_line[:-1])
        x[:, k + 2] = np.bincount(self.word_line[same], minlength=len(x)) / np.maximum(1, self.words)
        x[:, k + 3] = self.repeated
        x[:, k + 4] = self.sentence
        x[:, k + 5] = self.words == 0
        x[:, k + 6] = 1
        return x


class ChainField:
    """Two labels, 0 boilerplate and 1 content: weights of features and of neighbouring labels."""

    def __init__(self):
        self.w, self.t = np.zeros((FEATURES, 2)), np.zeros((2, 2))

    def gradient(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean log likelihood of padded sequences and its gradients, by forward and backward sums.

        ``x`` is (sequences, places, features), ``y`` labels, ``mask`` 1 where a place is filled.
        """
        n, size = y.shape
        scores = x @ self.w
        alpha, beta = np.zeros((n, size, 2)), np.zeros((n, size, 2))
        alpha[:, 0] = scores[:, 0]
        for k in range(1, size):
            step = _log_sum(alpha[:, k - 1][:, :, None] + self.t) + scores[:, k]
            alpha[:, k] = np.where(mask[:, k, None], step, alpha[:, k - 1])
        for k in range(size - 2, -1, -1):
            step = _log_sum((self.t + (scores[:, k + 1] + beta[:, k + 1])[:, None, :]).swapaxes(1, 2))
            beta[:, k] = np.where(mask[:, k + 1, None], step, beta[:, k + 1])
        total = _log_sum(alpha[:, -1][:, :, None])[:, 0]
        marginal = np.exp(alpha + beta - total[:, None, None]) * mask[:, :, None]
        gold = np.eye(2)[y] * mask[:, :, None]
        both = mask[:, 1:] & mask[:, :-1]
        pair = alpha[:, :-1, :, None] + self.t + (scores[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]
        expected = (np.exp(np.minimum(pair, 0)) * both[:, :, None, None]).sum((0, 1))
        seen = np.einsum("nki,nkj->ij", gold[:, :-1] * both[:, :, None], gold[:, 1:] * both[:, :, None])
        value = (scores * gold).sum() + (self.t * seen).sum() - total.sum()
        return value / n, np.einsum("nkf,nky->fy", x, gold - marginal) / n, (seen - expected) / n

    def fit(self, sequences: list[tuple[np.ndarray, int]]) -> ChainField:
        """Adam on all sequences ``(features, label)`` at once, cut into ``SEQUENCE`` lines each."""
        parts = [(x[i : i + SEQUENCE], y) for x, y in sequences for i in range(0, len(x), SEQUENCE)]
        x, y = np.zeros((len(parts), SEQUENCE, FEATURES)), np.zeros((len(parts), SEQUENCE), np.int64)
        mask = np.zeros((len(parts), SEQUENCE), bool)
        for k, (rows, label) in enumerate(parts):
            x[k, : len(rows)], y[k], mask[k, : len(rows)] = rows, label, True
        m = [np.zeros_like(self.w), np.zeros_like(self.t)]
        v = [np.zeros_like(self.w), np.zeros_like(self.t)]
        for step in range(1, STEPS + 1):
            _, dw, dt = self.gradient(x, y, mask)
            for k, (p, d) in enumerate(((self.w, dw), (self.t, dt))):
                d = d - DECAY * p
                m[k], v[k] = 0.9 * m[k] + 0.1 * d, 0.999 * v[k] + 0.001 * d * d
                p += RATE * m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def decode(self, scores: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """The best labels of every text's lines (Viterbi); ties go to content."""
        out = np.ones(len(scores), np.int64)
        (t00, t01), (t10, t11) = self.t.tolist()
        rows = scores.tolist()
        for s, e in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
            a, b = rows[s]
            back = []
            for k in range(s + 1, e):
                x, y = rows[k]
                to0, to1 = (a + t00 > b + t10), (a + t01 > b + t11)
                a, b, = (a + t00 if to0 else b + t10) + x, (a + t01 if to1 else b + t11) + y
                back.append((not to0, not to1))
            label = int(b >= a)
            out[e - 1] = label
            for k in range(e - 2, s - 1, -1):
                label = int(back[k - s][label])
                out[k] = label
        return out


def _log_sum(v: np.ndarray) -> np.ndarray:
    """Over the last but one axis of two entries."""
    return np.logaddexp(v[:, 0], v[:, 1])


def fit_field(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> ChainField | None:
    """A field from at most ``most`` labelled documents, in one task; None without both labels."""
    sample = F.broadcast(training_labels(labels, most=most))  # at most ``most`` rows of two numbers
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")

    def encode(batch):
        texts, y = binaries(batch.column(1)), batch.column(2).to_pylist()
        for part in pieces([len(t) for t in texts]):
            lines = Lines(texts[part])
            x = lines.features().astype("<f4")
            cut = [x[a:b].tobytes() for a, b in zip(lines.firsts[:-1], lines.firsts[1:])]
            yield {"doc_id": batch.column(0)[part], "y": pa.array(y[part], pa.int32()), "lines": cut}

    def fit(batches):
        rows = sorted((d, x, y) for batch in batches for d, y, x in zip(*(c.to_pylist() for c in batch.columns)))
        field = None
        if len({r[2] for r in rows}) == 2:
            field = ChainField().fit([(np.frombuffer(x, "<f4").reshape(-1, FEATURES).astype(float), y) for _, x, y in rows])
        yield pa.RecordBatch.from_pydict({"field": [pickle.dumps(field and (field.w, field.t))]})

    encoded = map_texts(rows, encode, "doc_id long, y int, lines binary", "doc_id", "text", "y")
    state = pickle.loads(encoded.repartition(1).mapInArrow(fit, "field binary").first()[0])
    if state is None:
        return None
    field = ChainField()
    field.w, field.t = state
    return field


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "content_words long, base_failed boolean, kept boolean"
)


def apply_rules(docs: DataFrame, field: ChainField | None, least_content: float = LEAST_CONTENT) -> DataFrame:
    """Counts and verdict of every row.

    A text fails at once with under 20 words or with over 30 % of them in repeated windows;
    otherwise it is kept if ``least_content`` of its words are in content lines. Without a field
    every line is content. Null text counts as empty and fails. Null and repeated ids are kept,
    other columns ignored; an empty table gives no rows.
    """
    def run(batch):
        texts = binaries(batch.column(1))
        for part in pieces([len(t) for t in texts]):
            lines = Lines(texts[part])
            n, repeated = lines.per_text(lines.words), lines.repeated_words()
            content = n
            if field is not None:
                content = lines.per_text(lines.words * field.decode(lines.features() @ field.w, lines.firsts))
            failed = (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)
            yield {
                "doc_id": batch.column(0)[part], "n_words": n, "word_chars": lines.per_text(lines.letters),
                "n_symbols": lines.per_text(lines.counts[:, 1]), "n_dup_lines": lines.per_text(lines.repeated),
                "n_repeat_words": repeated, "content_words": content, "base_failed": failed,
                "kept": ~failed & (content >= least_content * n),
            }

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_texts(rows, run, SCHEMA, "doc_id", "text")


def op3_quality_rules(spark, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return apply_rules(docs, fit_field(docs, table(spark, sf, "labels")))
