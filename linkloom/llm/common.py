"""What the operators share: batches of texts, word hashes, caches of a worker, shared files."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text worked on at once; a longer text is a piece of its own.
PIECE = 1 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACES = bytes(32 if 9 <= c <= 13 else c for c in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BYTE_VALUES = np.random.default_rng(17).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE_VALUES[32] = 0


def table(spark, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def lower_ascii(text: bytes) -> bytes:
    return text.translate(_LOWER)


def binaries(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def pieces(sizes: list[int], most: int = PIECE) -> Iterator[slice]:
    """Neighbouring texts of together about ``most`` bytes."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        total += size
        if total >= most:
            yield slice(first, i + 1)
            first, total = i + 1, 0
    if first < len(sizes):
        yield slice(first, len(sizes))


def map_texts(df: DataFrame, fn: Callable, schema: str, *columns: str) -> DataFrame:
    """``fn(record_batch)`` yields dicts of columns, for pieces of every Arrow batch of ``columns``."""
    names = T.StructType.fromDDL(schema).names

    def run(batches):
        for batch in batches:
            for out in fn(batch):
                yield pa.RecordBatch.from_arrays([_arrow(out[n]) for n in names], names)

    return df.select(*columns).mapInArrow(run, schema)


def carried(docs: DataFrame, carry: bool) -> tuple[list[str], list[Column], str]:
    """What takes the whole row along as the column ``row``: its name, the column and its schema."""
    if not carry:
        return [], [], ""
    return ["row"], [F.struct(*docs.columns).alias("row")], f", row {docs.schema.simpleString()}"


def _arrow(values):
    return values if isinstance(values, (pa.Array, pa.ChunkedArray)) else pa.array(values)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts, and where each text's begin.

    The second array has one entry more than there are texts.
    """
    buf = b" ".join(texts).translate(_SPACES)
    ends = np.cumsum([len(t) + 1 for t in texts])
    hashes, starts, low = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while low < len(buf):
        high = len(buf)
        if high - low > 4 * PIECE:  # cut between words
            high = buf.rfind(b" ", low, low + 4 * PIECE)
            high = high if high > low else buf.find(b" ", low + 4 * PIECE)
            high = high if high > low else len(buf)
        h, s = _window_hashes(np.frombuffer(buf, np.uint8, high - low, low))
        hashes.append(h)
        starts.append(s + low)
        low = high
    places = np.searchsorted(np.concatenate(starts), np.concatenate([[0], ends]))
    return np.concatenate(hashes), places


def _window_hashes(window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = window == 32
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    at = np.arange(len(window)) - np.repeat(
        np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(window)]]))
    )
    powers = np.full(at.max() + 1, _MULTIPLIER, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    return mix(np.add.reduceat(_BYTE_VALUES[window] * powers[at], starts)), starts


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each window of ``width`` consecutive words, of all texts in a row."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(width), np.uint64)
    for k in range(width):
        h = h * _MULTIPLIER + words[k : k + n]
    return mix(h)


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, across tasks."""
    return sys.__dict__.setdefault("_linkloom_caches", {}).setdefault(name, {})


def release_caches() -> None:
    """Forget what earlier operators left in this worker, which Spark uses again for other tasks."""
    held = sys.__dict__.get("_linkloom_caches")
    if held:
        held.clear()
        gc.collect()
        with contextlib.suppress(OSError, AttributeError):  # hand the memory back, where that can be asked for
            ctypes.CDLL(None).malloc_trim(0)


def load_tokenizer(path: str):
    """The tokenizer of a file, loaded once per worker; unused truncation and padding are off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark spreads the work
    from tokenizers import Tokenizer

    cache = worker_cache("tokenizers")
    if path not in cache:
        cache[path] = Tokenizer.from_file(path)
        cache[path].no_truncation()
        cache[path].no_padding()
    return cache[path]


def shared_file(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a file in the shared folder, as seen from a task."""
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def attempt_name(stem: str, ending: str) -> str:
    """A name no other attempt of a task uses; the manifest tells which attempt counts."""
    return f"{stem}-{uuid.uuid4().hex[:12]}{ending}"
