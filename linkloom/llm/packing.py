"""Training sequences by power-of-two decomposition of documents.

A document of n ids is cut into n // 2048 pieces of 2048 and one piece for every bit set in
the rest, longest first. Equal lengths are bucketed; each piece is a whole sequence of its
bucket, so no sequence crosses documents and none needs padding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import pieces, strings, table
from linkloom.llm.token_stream import TokenStream

LONGEST = 2048
SEQUENCES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)
_PARTITION_BITS, _RANK_BITS = 24, 34


def binary_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Powers of two that add up to ``n``, none above ``longest``, in descending order."""
    rest = n % longest
    bits = reversed(range(rest.bit_length()))
    return [longest] * (n // longest) + [1 << b for b in bits if rest >> b & 1]


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 1, longest: int = LONGEST, share: float = 1.0
) -> DataFrame:
    """One row per sequence: its piece of a document and the ids, little-endian unsigned 32-bit.

    ``sequence_id`` is unique and holds the bucket (log2 of the length) in its upper bits, then
    the input partition, then the rank in both, so a bucket is a range of ids and nothing is
    counted or shuffled. ``offset`` is always 0. Null text counts as empty and gives one piece
    with ``end_id``. Null and repeated ids are kept, each row is a document of its own; other
    columns are ignored. ``share`` of a worker's usual memory of chunks is used.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest length is a power of two")

    def cut(batches):
        stream, ranks = TokenStream(tokenizer_path, share), [0] * longest.bit_length()
        partition = TaskContext.get().partitionId() << _RANK_BITS
        for batch in batches:
            docs, texts = batch.column(0), strings(batch.column(1))
            for part in pieces([len(t) for t in texts]):
                rows = []
                for d, found in zip(range(part.start, part.stop), stream.ids(texts[part])):
                    raw, at = np.append(found, np.uint32(end_id)).astype("<u4").tobytes(), 0
                    for n in binary_lengths(len(found) + 1, longest):
                        bucket = n.bit_length() - 1
                        sequence = bucket << _PARTITION_BITS + _RANK_BITS | partition | ranks[bucket]
                        ranks[bucket] += 1
                        rows.append((d, at, n, raw[4 * at : 4 * (at + n)], len(found) + 1, sequence, 0))
                        at += n
                doc, *rest = map(pa.array, zip(*rows))
                yield pa.RecordBatch.from_arrays([docs.take(doc), *rest], NAMES)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, SEQUENCES)


NAMES = [x.split()[0] for x in SEQUENCES.split(", ")]


def op10_packing(spark, sf: str, tokenizer_path: str) -> DataFrame:
    packed = pack_documents(table(spark, sf, "documents"), tokenizer_path)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
