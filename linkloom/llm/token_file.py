"""Token ids in fixed-width binary files.

A file holds a 24-byte head (magic, bits per id, ids per block, two zeros), then blocks of
bit-packed ids (least significant bit first), then the byte offset of every block and the
index of documents (id, whether it is null, first id, number of ids), then a 32-byte foot
(number of blocks and of documents, where the two tables start, number of ids). Blocks hold a
multiple of eight ids, so each begins at a whole byte and can be unpacked alone with numpy.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import attempt_name, pieces, shared_file, strings, table
from linkloom.llm.token_stream import TokenStream
from linkloom.session import materialise, scratch_path

BLOCK = 8192
_HEAD, _FOOT, _MAGIC = "<4sIIIQ", "<QQQQ", b"LTK1"
_DOC = np.dtype([("doc_id", "<i8"), ("null", "<i8"), ("start", "<i8"), ("n", "<i8")])
MANIFEST = "shard long, file string, n_docs long, n_tokens long, bits int"
ENTRIES = "shard long, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as ``bits`` bits each, least significant first, filled up to a whole byte."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    wide = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:  # whole bytes need no shifting
        return wide[:, : bits // 8].tobytes()
    return np.packbits(np.unpackbits(wide, axis=1, count=bits, bitorder="little"), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    out = np.zeros((count, 4), np.uint8)
    if bits % 8 == 0:
        out[:, : bits // 8] = np.frombuffer(data, np.uint8, count * bits // 8).reshape(count, -1)
        return out.view("<u4").ravel()
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little")
    narrow = np.packbits(flat.reshape(count, bits), axis=1, bitorder="little")
    out[:, : narrow.shape[1]] = narrow
    return out.view("<u4").ravel()


class TokenWriter:
    """Appends documents to an open binary stream; memory holds one block and the index."""

    def __init__(self, out, bits: int, block: int = BLOCK):
        if block % 8:
            raise ValueError("a block holds a multiple of eight ids")
        self.out, self.bits, self.block = out, bits, block
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_tokens = 0
        self.offsets, self.docs = [], []
        out.write(struct.pack(_HEAD, _MAGIC, bits, block, 0, 0))
        self.place = struct.calcsize(_HEAD)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is None, self.n_tokens, len(ids)))
        self.n_tokens += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= 64 * self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate([*self.waiting, np.zeros(0, np.uint32)])
        whole = len(ids) if last else len(ids) // self.block * self.block
        for i in range(0, whole, self.block):
            data = pack(ids[i : min(i + self.block, whole)], self.bits)
            self.offsets.append(self.place)
            self.out.write(data)
            self.place += len(data)
        self.waiting, self.n_waiting = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        offsets, docs = np.array(self.offsets, "<u8").tobytes(), np.array(self.docs, _DOC).tobytes()
        at = self.place
        self.out.write(offsets)
        self.out.write(docs)
        self.out.write(struct.pack(_FOOT, len(self.offsets), len(self.docs), at, self.n_tokens))


class TokenFile:
    """Random access to a file: any range of ids, or the documents in order."""

    def __init__(self, handle):
        self.handle = handle
        handle.seek(0)
        magic, self.bits, self.block, _, _ = struct.unpack(_HEAD, handle.read(struct.calcsize(_HEAD)))
        if magic != _MAGIC:
            raise ValueError("not a token file")
        handle.seek(0, 2)
        handle.seek(handle.tell() - struct.calcsize(_FOOT))
        n_blocks, n_docs, at, self.n_tokens = struct.unpack(_FOOT, handle.read(struct.calcsize(_FOOT)))
        handle.seek(at)
        self.offsets = np.frombuffer(handle.read(8 * n_blocks), "<u8")
        self.docs = np.frombuffer(handle.read(_DOC.itemsize * n_docs), _DOC)

    def read(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count``; only the blocks they lie in are read."""
        if start < 0 or count < 0 or start + count > self.n_tokens:
            raise IndexError("outside the file")
        if not count:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (start + count - 1) // self.block
        self.handle.seek(int(self.offsets[first]))
        held = min(self.n_tokens, (last + 1) * self.block) - first * self.block
        data = self.handle.read(-(-held * self.bits // 8))
        ids = unpack(data, self.bits, held)
        return ids[start - first * self.block :][:count]

    def documents(self, run: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start, ids), reading about ``run`` ids at a time."""
        n = self.docs["n"].tolist()
        for part in pieces(n, run):
            docs = self.docs[part]
            base = int(docs["start"][0])
            ids = self.read(base, int(docs["start"][-1] + docs["n"][-1]) - base)
            for d, null, s, k in docs.tolist():
                yield None if null else d, s, ids[s - base : s - base + k]


def write_token_files(
    docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 0, block: int = BLOCK
) -> DataFrame:
    """Encode every whole text and write files in ascending ``doc_id`` order; returns the manifest.

    Null text counts as empty, so each row adds at least ``end_id``. Null ids come first, rows
    of one id lie in the order of their texts' hashes. An empty table gives an empty manifest.
    Other columns are ignored. A retried task writes another file; the manifest, written by
    Spark, names the one that counts.
    """
    def write(batches):
        stream = TokenStream(tokenizer_path)
        bits = bits_for(max(stream.tokenizer.get_vocab_size(), end_id + 1))
        shard, writer, n = TaskContext.get().partitionId(), None, 0
        system, root = shared_file(folder)
        name = attempt_name(f"tokens-{shard:06d}", ".bin")
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), strings(batch.column(1))
            for part in pieces([len(t) for t in texts]):
                if writer is None:
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                    writer = TokenWriter(out, bits, block)
                for doc_id, found in zip(ids[part], stream.ids(texts[part])):
                    writer.add(doc_id, np.append(found, np.uint32(end_id)))
                    n += 1
        if writer is not None:
            writer.close()
            out.close()
            row = {"shard": [shard], "file": [f"{folder}/{name}"], "n_docs": [n], "n_tokens": [writer.n_tokens]}
            yield pa.RecordBatch.from_pydict(row | {"bits": pa.array([bits], pa.int32())})

    by = ["doc_id", F.xxhash64("text")]
    ordered = docs.select("doc_id", "text").repartitionByRange(*by).sortWithinPartitions(*by)
    return materialise(ordered.mapInArrow(write, MANIFEST), "token_manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Every document of the files with the place of its ids in the whole sequence and their crc32."""
    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                system, path = shared_file(row["file"])
                with system.open_input_file(path) as handle:
                    rows = [
                        (row["shard"], d, s, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                        for d, s, ids in TokenFile(handle).documents()
                    ]
                for i in range(0, len(rows), 10_000):
                    columns = zip(*rows[i : i + 10_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in columns],
                        ["shard", "doc_id", "local_start", "n_tokens", "ids_crc32"],
                    )

    shards = manifest.count()
    placed = manifest.repartitionByRange(max(1, shards), "shard")
    entries = placed.mapInArrow(read, ENTRIES)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    bases = manifest.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    return entries.join(bases, "shard").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def op5_token_binary(spark, sf: str, tokenizer_path: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    manifest = write_token_files(docs, tokenizer_path, scratch_path(spark, "tokens"))
    return read_token_files(manifest)
