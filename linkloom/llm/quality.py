"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded from its characters and words; a
gated attention, learned with the encoder from document labels alone, weighs the passages,
and the weighted sum is scored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import binaries, carried, id_remainder, map_texts, mix, pieces, table, word_hashes

PASSAGE_WORDS, HASHED, HIDDEN, ATTENTION = 60, 64, 24, 12
#: Most labelled documents a model is fitted on; chosen by a hash of their ids.
FIT_DOCUMENTS = 3000
EPOCHS, BATCH, RATE, DECAY = 30, 64, 4e-3, 1e-4
THRESHOLD = 0.3

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "symbol": b"#*$%&<>|\\/=+^~@{}[]_",
    "bang": b"!?",
    "stop": b".,;:",
    "bar": b"|",
    "line": b"\n",
    "foreign": bytes(range(0xC0, 0x100)),
}
_CLASS_OF = np.zeros((256, len(_CLASSES)), np.float32)
for _i, _members in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_members), _i] = 1
WIDTH = len(_CLASSES) + 4 + HASHED


def encode_passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages in a row, and where each text's begin (one entry more).

    A passage is ``PASSAGE_WORDS`` words of a text, the last may be shorter; a text without
    words is one passage of zeros.
    """
    words, places = word_hashes(texts)
    counts = np.diff(places)
    n_passages = np.maximum(1, -(-counts // PASSAGE_WORDS))
    firsts = np.concatenate([[0], np.cumsum(n_passages)])
    x = np.zeros((firsts[-1], WIDTH), np.float32)
    if not len(words):
        return x, firsts
    doc = np.repeat(np.arange(len(texts)), counts)
    passage = firsts[doc] + (np.arange(len(words)) - places[doc]) // PASSAGE_WORDS
    size = np.bincount(passage, minlength=len(x))
    starts = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    full = passage[starts]

    # Characters: a passage's bytes run from its first word to the next passage's.
    buf = np.frombuffer(b" ".join(texts), np.uint8)
    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    begin = ~space
    begin[1:] &= space[:-1]
    cuts = np.flatnonzero(begin)[starts]
    for i in range(len(_CLASSES)):
        x[full, i] = np.add.reduceat(_CLASS_OF[buf, i], cuts)
    letters = np.add.reduceat((~space).astype(np.float32), cuts)
    k = len(_CLASSES)
    x[:, :k] /= np.maximum(1, np.bincount(full, letters, len(x)))[:, None]
    # Words: mean length, share of distinct ones, share equal to the one before, fullness.
    x[full, k] = letters / size[full] / 10
    order = np.lexsort((words, passage))
    p, w = passage[order], words[order]
    new = np.concatenate([[True], (p[1:] != p[:-1]) | (w[1:] != w[:-1])])
    x[:, k + 1] = np.bincount(p[new], minlength=len(x)) / np.maximum(1, size)
    same = np.concatenate([[False], (words[1:] == words[:-1]) & (passage[1:] == passage[:-1])])
    x[:, k + 2] = np.bincount(passage[same], minlength=len(x)) / np.maximum(1, size)
    x[:, k + 3] = size / PASSAGE_WORDS
    bucket = (mix(words) % np.uint64(HASHED)).astype(np.int64)
    bag = np.bincount(passage * HASHED + bucket, minlength=len(x) * HASHED).reshape(len(x), HASHED)
    x[:, k + 4 :] = np.sqrt(bag / np.maximum(1, size)[:, None])
    return x, firsts


def _sigmoid(v):
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


class AttentionModel:
    """Encoder, gated attention and score; ``gradients`` is their backward pass."""

    def __init__(self, width: int = WIDTH, seed: int = 11):
        draw = np.random.default_rng(seed)
        scaled = lambda *s: draw.normal(0, 1 / np.sqrt(s[0]), s)
        self.mean, self.scale = np.zeros(width), np.ones(width)
        self.p = {
            "E": scaled(width, HIDDEN), "e": np.zeros(HIDDEN), "V": scaled(HIDDEN, ATTENTION),
            "U": scaled(HIDDEN, ATTENTION), "a": scaled(ATTENTION), "c": scaled(HIDDEN), "d": np.zeros(1),
        }

    def _forward(self, x: np.ndarray, firsts: np.ndarray):
        p, starts = self.p, firsts[:-1]
        sizes = np.diff(firsts)
        h = np.tanh(x @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        raw = (t * g) @ p["a"]
        weight = np.exp(raw - np.repeat(np.maximum.reduceat(raw, starts), sizes))
        weight /= np.repeat(np.add.reduceat(weight, starts), sizes)
        z = np.add.reduceat(weight[:, None] * h, starts, axis=0)
        return h, t, g, weight, z, _sigmoid(z @ p["c"] + p["d"])

    def scores(self, x: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        return self._forward((x - self.mean) / self.scale, firsts)[-1]

    def weights(self, x: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        return self._forward((x - self.mean) / self.scale, firsts)[3]

    def gradients(self, x: np.ndarray, firsts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy, for inputs already scaled."""
        p, sizes = self.p, np.diff(firsts)
        h, t, g, weight, z, s = self._forward(x, firsts)
        ds = (s - y) / len(y)
        dz = np.repeat(ds[:, None] * p["c"], sizes, axis=0)
        dw = (dz * h).sum(1)
        draw = weight * (dw - np.repeat(np.add.reduceat(weight * dw, firsts[:-1]), sizes))
        dt, dg = draw[:, None] * p["a"] * g * (1 - t**2), draw[:, None] * p["a"] * t * g * (1 - g)
        dh = (weight[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - h**2)
        return {
            "E": x.T @ dh, "e": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg,
            "a": draw @ (t * g), "c": z.T @ ds, "d": ds.sum(keepdims=True),
        }

    def fit(self, bags: list[np.ndarray], y: np.ndarray, seed: int = 5) -> AttentionModel:
        """Adam over shuffled mini-batches of bags."""
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(0), every.std(0) + 0.05
        bags = [(b - self.mean) / self.scale for b in bags]
        draw, step = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(v) for k, v in self.p.items()}
        for _ in range(EPOCHS):
            order = draw.permutation(len(bags))
            for i in range(0, len(order), BATCH):
                part = [bags[j] for j in order[i : i + BATCH]]
                firsts = np.concatenate([[0], np.cumsum([len(b) for b in part])])
                step += 1
                for k, d in self.gradients(np.concatenate(part), firsts, y[order[i : i + BATCH]]).items():
                    d = d + DECAY * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v[k] = 0.999 * v[k] + 0.001 * d * d
                    fixed = m[k] / (1 - 0.9**step), v[k] / (1 - 0.999**step)
                    self.p[k] = self.p[k] - RATE * fixed[0] / (np.sqrt(fixed[1]) + 1e-8)
        return self


def training_labels(labels: DataFrame, label: str = "quality", most: int = FIT_DOCUMENTS) -> DataFrame:
    """``(doc_id, y)`` of at most ``most`` labelled ids outside the held-out fold, by a hash of the id."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (id_remainder("doc_id", 5) != 0))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    return known.orderBy(F.xxhash64(F.lit(29), "doc_id"), "doc_id").limit(most)


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> AttentionModel | float:
    """A model of ``labels(doc_id, quality)``, fitted in one task on a bounded sample.

    Without both labels in the sample there is nothing to learn: then the share of label 1
    (a half without any) is returned and scores every text. Rows that repeat an id all count.
    """
    sample = F.broadcast(training_labels(labels, most=most))  # at most ``most`` rows of two numbers
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")

    def encode(batch):
        texts, y = binaries(batch.column(1)), batch.column(2).to_pylist()
        for part in pieces([len(t) for t in texts]):
            x, firsts = encode_passages(texts[part])
            bags = [x[a:b].astype("<f4").tobytes() for a, b in zip(firsts[:-1], firsts[1:])]
            yield {"doc_id": batch.column(0)[part], "y": pa.array(y[part], pa.int32()), "bag": bags}

    def fit(batches):
        rows = sorted((d, b, y) for batch in batches for d, y, b in zip(*(c.to_pylist() for c in batch.columns)))
        y = np.array([r[2] for r in rows], float)
        if len(set(y)) < 2:
            model = float(y.mean()) if len(y) else 0.5
        else:
            bags = [np.frombuffer(r[1], "<f4").reshape(-1, WIDTH).astype(float) for r in rows]
            model = AttentionModel().fit(bags, y)
        state = model if isinstance(model, float) else (model.p, model.mean, model.scale)
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(state)]})

    encoded = map_texts(rows, encode, "doc_id long, y int, bag binary", "doc_id", "text", "y")
    state = pickle.loads(encoded.repartition(1).mapInArrow(fit, "model binary").first()[0])
    if isinstance(state, float):
        return state
    model = AttentionModel()
    model.p, model.mean, model.scale = state
    return model


def score_quality(
    docs: DataFrame, model: AttentionModel | float, threshold: float = THRESHOLD, carry: bool = False
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row; null text counts as empty.

    Null and repeated ids are kept, other columns ignored; an empty table gives no rows.
    With ``carry`` the whole row comes along as ``row``.
    """
    def score(batch):
        texts = binaries(batch.column(1))
        for part in pieces([len(t) for t in texts]):
            if isinstance(model, float):
                s = np.full(len(texts[part]), model)
            else:
                s = model.scores(*encode_passages(texts[part]))
            yield {n: batch.column(n)[part] for n in kept} | {"score": s}

    kept, row, schema = carried(docs, carry)
    kept = ["doc_id", "held_out", *kept]
    held_out = (id_remainder("doc_id", 5) == 0).alias("held_out")
    rows = docs.select(F.col("doc_id").cast("long"), "text", held_out, *row)
    scored = map_texts(rows, score, f"doc_id long, held_out boolean, score double{schema}", *rows.columns)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op4_quality_classifier(spark, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf, "labels")))
