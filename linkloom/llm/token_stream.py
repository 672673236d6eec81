"""Token ids of whole texts from the tokenizers library, chunk by chunk through a worker's cache.

A single space or line end between two characters that aren't white space is a safe place to
cut for a byte-level pre-tokenizer: none of its patterns crosses it. Texts are cut there, chunks
seen before are looked up. New chunks of plain Latin text are cut on by the pre-tokenizer's own
pattern, and the library's model encodes each new part; all else goes to the library whole.
"""

from __future__ import annotations

import json

import numpy as np
import regex

from linkloom.llm.common import load_tokenizer, worker_cache
from linkloom.llm.prefix_bpe import byte_letters

#: Chunks, and parts of them, remembered per worker; all are forgotten when it is full.
REMEMBERED, REMEMBERED_PARTS = 1_000_000, 700_000
# Fixed value: the pattern of the byte-level pre-tokenizer.
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_MARKS = frozenset(".,;:!?")
_LETTERS = dict(enumerate(byte_letters()))


class _Uncut(Exception):
    """A space next to other white space: the text can't be cut there."""


class _Chunks(dict):
    """Ids of chunks with the space before them; what is missing is encoded and remembered."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.most = encode, REMEMBERED

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Uncut
        if "\n" in chunk:  # seldom seen again as a whole
            return self.encode(chunk)
        if len(self) >= self.most:
            self.clear()
        found = self[chunk] = self.encode(chunk)
        return found


class TokenStream:
    """``ids(texts)``: a uint32 array per text, as ``encode(text, add_special_tokens=False)``.

    ``share`` of the usual number of chunks and parts is remembered.
    """

    def __init__(self, path: str, share: float = 1.0):
        self.tokenizer = load_tokenizer(path)
        cache = worker_cache(f"chunks:{path}")
        self.known, self.parts = cache.setdefault("known", _Chunks(None)), worker_cache(f"parts:{path}")
        self.known.encode, self.known.most = self._chunk, int(share * REMEMBERED)
        self.most_parts = int(share * REMEMBERED_PARTS)
        pre = json.loads(self.tokenizer.to_str())
        kind, plain = pre["pre_tokenizer"] or {}, not (pre["normalizer"] or pre["post_processor"])
        if not plain or (kind.get("type"), kind.get("use_regex"), kind.get("add_prefix_space")) != ("ByteLevel", True, False):
            raise ValueError("only plain byte-level tokenizers are covered")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, np.uint32).tobytes()

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(self._text(t), np.uint32) for t in texts]

    def _text(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.whole(text)
        first, *chunks = text.split(" ")
        if first[-1:].isspace() or not first:
            return self.whole(text)
        try:
            return self.whole(first) + b"".join(map(self.known.__getitem__, chunks))
        except _Uncut:
            return self.whole(text)

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a chunk with the space before it."""
        if not chunk.isascii() and max(chunk) > "\u024f":
            return self.whole(" " + chunk)
        if chunk.isalpha():
            return self._part(" " + chunk)
        if chunk[-1] in _MARKS and chunk[:-1].isalpha():
            return self._part(" " + chunk[:-1]) + self._part(chunk[-1])
        lines = chunk.split("\n")
        if not all(lines) or any(len(x.split()) > 1 or x[0].isspace() or x[-1].isspace() for x in lines):
            return self.whole(" " + chunk)
        out = [self.known[lines[0]] if len(lines) > 1 else b"".join(map(self._part, _PARTS.findall(" " + chunk)))]
        for line in lines[1:]:
            out.append(self._part("\n"))
            if line.isalpha():
                out.append(self._part(line))
            else:
                out += map(self._part, _PARTS.findall(line))
        return b"".join(out)

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            if len(self.parts) >= self.most_parts:
                self.parts.clear()
            letters = part.encode().decode("latin-1").translate(_LETTERS)
            found = np.array([t.id for t in self.tokenizer.model.tokenize(letters)], np.uint32).tobytes()
            self.parts[part] = found
        return found
