"""Exact byte-pair encoding by dynamic programming over prefixes.

For every prefix of a word exactly one token can be the last one of its encoding. A suffix
match gives the tokens that end a prefix, longest first; a token is the right one if it and
the last token of the prefix before it are compatible, that is, if the pair encodes to itself.
Back-pointers from the whole word give its ids.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import load_tokenizer, map_texts, pieces, strings, table, worker_cache

#: Words, and chunks between spaces, remembered per worker; all are forgotten when it is full.
REMEMBERED, REMEMBERED_CHUNKS = 500_000, 600_000
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in plain)}
    return [other.get(b, chr(b)) for b in range(256)]


class SuffixAutomaton:
    """Of reversed tokens as a trie: walking a word backwards from a place meets all tokens that end there."""

    def __init__(self, tokens: list[tuple[int, ...]]):
        self.next: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for k, symbols in enumerate(tokens):
            at = 0
            for s in reversed(symbols):
                if s not in self.next[at]:
                    self.next[at][s] = len(self.next)
                    self.next.append({})
                    self.token.append(-1)
                at = self.next[at][s]
            self.token[at] = k

    def ending(self, symbols: list[int], end: int) -> list[tuple[int, int]]:
        """``(token, length)`` of all tokens that are a suffix of ``symbols[:end]``, shortest first."""
        out, at, k = [], 0, end
        while k and (at := self.next[at].get(symbols[k - 1], -1)) >= 0:
            k -= 1
            if self.token[at] >= 0:
                out.append((self.token[at], end - k))
        return out


class PrefixBPE:
    """The model of a tokenizers file: byte-level BPE, with or without a word-end mark.

    Tokens are numbered by rank here: single symbols first, then merges in their order.
    """

    def __init__(self, model: dict):
        vocab, self.mark = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.symbol = [letters[b] for b in range(256)]
        singles = [*self.symbol, *(x + self.mark for x in self.symbol)] if self.mark else list(self.symbol)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        rank = {s: k for k, s in enumerate(singles)}
        self.symbols: list[tuple[int, ...]] = [(k,) for k in range(len(singles))]
        self.parts = [(k, k) for k in range(len(singles))]
        self.merged: dict[tuple[int, int], int] = {}
        names = list(singles)
        for left, right in merges:
            a, b = rank[left], rank[right]
            name = (left.removesuffix(self.mark) if self.mark else left) + right
            if name in rank:
                raise ValueError(f"two merges give {name!r}")
            k = rank[name] = len(names)
            names.append(name)
            self.symbols.append(self.symbols[a] + self.symbols[b])
            self.parts.append((a, b))
            self.merged[a, b] = k
        self.id = [vocab.get(name, -1) for name in names]
        self.names = names
        self.n_singles = len(singles)
        self.matches = SuffixAutomaton(self.symbols)
        self.tested: dict[tuple[int, int], bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` next to each other encode to just these two tokens.

        Both are taken apart from the seam outwards, latest merge first; a merge across the seam
        that comes before all that was taken apart so far would have happened instead.
        """
        known = self.tested.get((left, right))
        if known is not None:
            return known
        a, b, limit, fine = left, right, len(self.names), True
        while True:
            joined = self.merged.get((a, b))
            if joined is not None and joined < limit:
                fine = False
                break
            if max(a, b) < self.n_singles:
                break
            # What was merged later is taken apart; a tie goes to the right, as merges run leftmost first.
            if a > b:
                a, limit = self.parts[a][1], a
            else:
                b, limit = self.parts[b][0], b + 1
        self.tested[left, right] = fine
        return fine

    def encode_symbols(self, symbols: list[int]) -> list[int]:
        n = len(symbols)
        last = [(-1, 0)] * (n + 1)
        for end in range(1, n + 1):
            for token, length in reversed(self.matches.ending(symbols, end)):
                before = end - length
                if not before or (last[before][0] >= 0 and self.compatible(last[before][0], token)):
                    last[end] = token, before
                    break
        out, at = [], n
        while at:
            token, at = last[at]
            out.append(token)
        return out[::-1]

    def encode_word(self, word: bytes) -> list[int]:
        symbols = list(word)
        if self.mark and symbols:
            symbols[-1] += 256
        return self.encode_symbols(symbols)


class _Chunks(dict):
    """Ids and decoded text of chunks; what is missing is encoded and remembered."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> tuple[bytes, str]:
        if len(self) >= REMEMBERED_CHUNKS:
            self.clear()
        found = self[chunk] = self.encode(chunk)
        return found


class WordEncoder:
    """Ids and decoded text as the tokenizers library gives them, word by word through a cache."""

    def __init__(self, path: str):
        cache = worker_cache(f"words:{path}")
        if "bpe" not in cache:
            with open(path, encoding="utf-8") as f:
                self._check(described := json.load(f))
            special = [t["content"] for t in described["added_tokens"]]
            cache.update(
                bpe=PrefixBPE(described["model"]), words={}, chunks=_Chunks(None), special=special,
                special_id={t["content"]: t["id"] for t in described["added_tokens"]},
            )
        self.bpe, self.known, self.chunks = cache["bpe"], cache["words"], cache["chunks"]
        self.chunks.encode = self._chunk
        self.special, self.special_id = cache["special"], cache["special_id"]
        self.library = load_tokenizer(path)
        self.cut = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")

    @staticmethod
    def _check(described: dict) -> None:
        model = described["model"]
        odd = [model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")]
        if any(odd) or described["decoder"] or described["post_processor"]:
            raise ValueError("only plain byte-level BPE with word ends, without a decoder, is covered")

    def normal(self, text: str) -> str:
        """NFC and lower case; the library itself does all but plain Latin text."""
        if text.isascii():
            return text.lower()
        if max(text) < "\u0300" and "\u0130" not in text and unicodedata.is_normalized("NFC", text):
            return text.lower()
        return self.library.normalizer.normalize_str(text)

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids of a whole text and their decoded text; the strings of special tokens stay as they are.

        No word crosses a space, so the normal text is cut there and chunks are looked up.
        """
        found = []
        for k, part in enumerate(self.at_special.split(text) if any(s in text for s in self.special) else [text]):
            if k % 2:
                found.append((np.uint32(self.special_id[part]).astype("<u4").tobytes(), part))
            else:
                found += map(self.chunks.__getitem__, self.normal(part).split(" "))
        return b"".join([x[0] for x in found]), " ".join([x[1] for x in found if x[1]])

    def _chunk(self, chunk: str) -> tuple[bytes, str]:
        words = [chunk] if chunk.isalpha() else self.cut.findall(chunk)
        found = [self.known.get(w) or self._learn(w) for w in words]
        return b"".join([x[0] for x in found]), " ".join([x[1] for x in found if x[1]])

    def _learn(self, word: str) -> tuple[bytes, str]:
        kept = [t for t in self.bpe.encode_word(word.encode()) if self.bpe.id[t] >= 0]
        ids = np.array([self.bpe.id[t] for t in kept], "<u4").tobytes()
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        found = self.known[word] = ids, " ".join([self.bpe.names[t] for t in kept])
        return found


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids, decoded)`` of every whole text; ids as little-endian unsigned 32-bit integers.

    Null text counts as empty: no ids, empty decoded text. Null and repeated ids are kept, other
    columns ignored; an empty table gives no rows.
    """
    def run(batch):
        encoder, texts = WordEncoder(path), strings(batch.column(1))
        for part in pieces([len(t) for t in texts], 1 << 18):
            ids, decoded = zip(*map(encoder.encode, texts[part]))
            yield {"doc_id": batch.column(0)[part], "ids": pa.array(ids, pa.binary()), "decoded": pa.array(decoded, pa.string())}

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_texts(rows, run, "doc_id long, ids binary, decoded string", "doc_id", "text")


def op8_prefix_bpe(spark, sf: str, path: str) -> DataFrame:
    encoded = encode_documents(table(spark, sf, "documents"), path)
    return encoded.select(
        "doc_id",
        F.floor(F.length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )

