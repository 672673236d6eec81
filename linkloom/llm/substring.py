"""Removal of passages that start in an earlier document, by FM-indexes.

A window is a run of ``width`` words. Of two equal windows the smallest of their 5-word grams, by
hash, is the same gram, so

1. every document sends the hashes of its windows' smallest grams, about a fifth of its words;
   grams of a single document are dropped, and with them all windows that can't repeat;
2. neighbouring windows with the same smallest gram are a unit of at most ``2 * width - 5`` words.
   Units go to the shard of their gram, so equal windows meet in one shard. Windows of a gram that
   occurs very often are units of their own, fold to the smallest document id first and go to the
   shard of their own hash, so no gram makes a large shard;
3. a shard puts its units into an FM-index and streams them through it backwards. Where the
   matching statistics reach ``width``, the interval of the match tells the smallest document
   that holds the window;
4. documents look their units up and lose the words of the windows that an earlier one holds.

Texts are written once with the number of their part, a run of neighbouring rows. What the
shards find is written by part as well, so a task reads only what its own rows need and texts
are never shuffled.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import binaries, mix, pieces, shared_file, table, window_hashes, word_hashes
from linkloom.llm.fm_index import FMIndex
from linkloom.session import scratch_path

WIDTH, GRAM = 13, 5
#: Rows of a part, as a power of two. Grams a bucket and a chunk hold, units a shard holds.
PART_BITS, BUCKET, CHUNK, SHARD = 13, 4_000_000, 1_000_000, 60_000
#: Windows of a gram that occurs more often are dealt one by one.
OFTEN = 2_000
#: Bytes of text worked on at once.
BATCH = 4 << 20

_NO_ID = np.iinfo(np.int64).max
_UNITS = "unit long, gram long, part long, low long, high long, words binary"


def _smallest_grams(words: np.ndarray, places: np.ndarray, width: int):
    """Of all windows of all texts: their places, hashes of grams, and the place of the smallest one."""
    n = len(words) - width + 1
    text = np.repeat(np.arange(len(places) - 1), np.diff(places))
    whole = np.flatnonzero(text[: max(n, 0)] == text[width - 1 :]) if n > 0 else np.zeros(0, np.int64)
    grams, span = window_hashes(words, GRAM), width - GRAM + 1
    if not len(whole):
        return whole, grams, whole
    # The low bits tell the place, the rest orders the grams; doubling finds the least of a span.
    bits = np.uint64((1 << span.bit_length()) - 1)
    least = (grams & ~bits) | (np.arange(len(grams), dtype=np.uint64) & bits)
    have = 1
    while have < span:
        more = min(have, span - have)
        least = np.minimum(least[: len(least) - more], least[more:])
        have += more
    low = (least[whole] & bits).astype(np.int64)
    return whole, grams, whole + ((low - whole) & int(bits))


def _bucket(grams: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((grams >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)


def _read_part(path: str, part: int, columns: list[str]) -> pa.Table | None:
    """What a written table holds of one part; None if nothing."""
    system, root = shared_file(path)
    folder = f"{root}/part={part}"
    if system.get_file_info(folder).type == fs.FileType.NotFound:
        return None
    files = [f.path for f in system.get_file_info(fs.FileSelector(folder)) if f.path.endswith(".parquet")]
    return pa.concat_tables([pq.ParquetFile(system.open_input_file(f)).read(columns) for f in files])


def _written(rows: DataFrame, label: str) -> DataFrame:
    """A table written to the shared folder, packed more tightly than by default."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _written_by_part(rows: DataFrame, label: str) -> str:
    path = scratch_path(rows.sparkSession, label)
    rows.repartition("part").write.partitionBy("part").parquet(path)
    return path


def _repeated_grams(texts: DataFrame, width: int) -> tuple[str, int]:
    """Where the grams that several rows hold are written, ``(key, often)`` by part; number of buckets.

    A key is the bucket and 32 more bits of a hash; a chance collision may keep a gram, never
    drop one.
    """
    words = F.length("text") / 6  # only the number of buckets depends on this
    expected = texts.agg(F.sum(words)).first()[0] or 0
    n_buckets = int(max(24, expected // (4 * BUCKET)))
    names = ["bucket", "part", "grams", "seen"]

    def ship(batches):
        part, held, size = None, [], 0

        def out():
            grams, row = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((row, grams))
            grams, row = grams[order], row[order]
            first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            last = np.append(first[1:], len(grams)) - 1
            # Occurrences, cut at what the type holds, and whether several rows have the gram.
            seen = (np.minimum(last - first + 1, 32767) << 1 | (row[first] != row[last])).astype(np.uint16)
            grams = grams[first]
            bucket = _bucket(grams, n_buckets)
            cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
            for b in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
                mine = slice(cuts[b], cuts[b + 1])
                row_of = [[b], [part], [grams[mine].astype(np.uint32).tobytes()], [seen[mine].tobytes()]]
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row_of, kinds)], names)

        n_rows = 0
        for batch in batches:
            parts, data = batch.column(0).to_numpy(), binaries(batch.column(1))
            for piece in _pieces_of_parts(parts, data):
                if held and (parts[piece.start] != part or size >= CHUNK):
                    yield from out()
                    held, size = [], 0
                part = int(parts[piece.start])
                words, places = word_hashes(data[piece])
                _, grams, least = _smallest_grams(words, places, width)
                at = least[np.flatnonzero(np.diff(least, prepend=-1))]
                held.append((grams[at], n_rows + np.searchsorted(places, at, "right")))
                n_rows += len(data[piece]) + 1
                size += len(at)
        if held:
            yield from out()

    def settle(rows: pa.Table) -> pa.Table:
        kinds = [("grams", np.uint32), ("seen", np.uint16)]
        grams, seen = ([np.frombuffer(x, k) for x in rows.column(c).to_pylist()] for c, k in kinds)
        sizes, bucket = [len(g) for g in grams], np.int64(rows.column("bucket")[0].as_py())
        grams, seen = np.concatenate(grams), np.concatenate(seen)
        order = np.argsort(grams, kind="stable")
        ranked = grams[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        n_chunks = np.diff(np.append(first, len(ranked)))
        several = (n_chunks > 1) | (np.maximum.reduceat(seen[order] & 1, first) > 0)
        often = np.add.reduceat((seen[order] >> 1).astype(np.int64), first) > OFTEN
        flag = np.empty(len(grams), np.int8)
        flag[order] = np.repeat(several * (1 + often), n_chunks)
        parts = np.repeat(rows.column("part").to_numpy(), sizes)[flag > 0]
        keys = ((bucket << 32) | grams.astype(np.int64))[flag > 0]
        # Only one row of a part and gram is needed.
        _, at = np.unique(np.stack([parts, keys]), axis=1, return_index=True) if len(keys) else (0, [])
        found = [pa.array(parts[at]), pa.array(keys[at]), pa.array((flag[flag > 0] == 2)[at])]
        return pa.Table.from_arrays(found, ["part", "key", "often"])

    shipped = texts.select("part", "text").mapInArrow(ship, "bucket int, part long, grams binary, seen binary")
    found = shipped.groupBy("bucket").applyInArrow(settle, "part long, key long, often boolean")
    return _written_by_part(found, "grams"), n_buckets


def _pieces_of_parts(parts: np.ndarray, data: list[bytes]):
    """Pieces of neighbouring rows of one part, of about BATCH bytes."""
    cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
    for low, high in zip(cuts[:-1], cuts[1:]):
        for piece in pieces([len(t) for t in data[low:high]], BATCH):
            yield slice(low + piece.start, low + piece.stop)


class _Lookup:
    """Sorted keys of the part that a task is at."""

    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns, self.part, self.rows = path, columns, None, None

    def at(self, part: int):
        """``(keys, other column)`` by ascending key."""
        if part != self.part:
            self.part, rows = part, _read_part(self.path, part, self.columns)
            self.rows = None
            if rows is not None:
                keys = rows.column(0).to_numpy()
                order = np.argsort(keys)
                self.rows = keys[order], rows.column(1).combine_chunks().take(pa.array(order))
        return self.rows


def _units(words: np.ndarray, places: np.ndarray, repeated, n_buckets: int, width: int):
    """``(first window, last window, hash, gram)`` of each unit of the texts."""
    none = np.zeros(0, np.int64)
    whole, grams, least = _smallest_grams(words, places, width)
    if repeated is None or not len(whole):
        return none, none, none, none
    keys, often = repeated
    mine = grams[least]
    key = (_bucket(mine, n_buckets).astype(np.int64) << 32) | (mine & np.uint64(0xFFFFFFFF)).astype(np.int64)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    kept = keys[at] == key
    whole, least, mine = whole[kept], least[kept], mine[kept]
    if not len(whole):
        return none, none, none, none
    alone = often.to_numpy(zero_copy_only=False)[at[kept]]
    new = np.concatenate([[True], (np.diff(whole) > 1) | (np.diff(least) != 0)]) | alone
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(whole)) - 1
    windows = window_hashes(words, width)
    a, b = whole[first], whole[last]
    ends = windows[a] * np.uint64(0x9E3779B97F4A7C15) + windows[b] * np.uint64(0xC2B2AE3D27D4EB4F)
    unit = mix(ends ^ (b - a).astype(np.uint64)).view(np.int64)
    return a, b, unit, np.where(alone[first], unit, mix(mine[first]).view(np.int64))


def _collect_units(texts: DataFrame, repeated: str, n_buckets: int, width: int) -> DataFrame:
    """Units of every part with the smallest and largest id of the documents that hold them."""
    names = [x.split()[0] for x in _UNITS.split(", ")]

    def run(batches):
        lookup = _Lookup(repeated, ["key", "often"])
        for batch in batches:
            parts, data = batch.column(0).to_numpy(), binaries(batch.column(2))
            ids = batch.column(1).fill_null(_NO_ID).to_numpy()
            for piece in _pieces_of_parts(parts, data):
                part = int(parts[piece.start])
                words, places = word_hashes(data[piece])
                a, b, unit, gram = _units(words, places, lookup.at(part), n_buckets, width)
                if not len(unit):
                    continue
                doc = ids[piece][np.searchsorted(places, a, "right") - 1]
                order = np.argsort(unit, kind="stable")
                first = np.flatnonzero(np.concatenate([[True], np.diff(unit[order]) != 0]))
                low, high = (f.reduceat(doc[order], first) for f in (np.minimum, np.maximum))
                one, back = np.sort(order[first]), np.argsort(order[first])  # texts overlap in this order
                low, high = low[back], high[back]
                split = b" ".join(data[piece]).split()
                held = [b" ".join(split[i : j + width]) for i, j in zip(a[one].tolist(), b[one].tolist())]
                columns = [unit[one], gram[one], np.full(len(one), part), low, high]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(held, pa.binary())], names)

    return texts.select("part", "doc_id", "text").mapInArrow(run, _UNITS)


def _search_shard(rows: pa.Table, width: int) -> pa.Table:
    """For each unit the smallest document of each of its windows, where one is earlier than another."""
    numbers: dict[bytes, int] = {}
    ids = rows.column("unit").to_numpy()
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(ids[order]) != 0]))
    low = np.minimum.reduceat(rows.column("low").to_numpy()[order], first)
    high = np.maximum.reduceat(rows.column("high").to_numpy()[order], first)
    rows = rows.select(["unit", "words"]).take(pa.array(order[first]))
    units = [
        np.array([numbers.setdefault(w, len(numbers) + 1) for w in text.split()], np.int64)
        for text in rows.column("words").to_pylist()
    ]
    index = FMIndex(units, low, width)
    lengths, places = index.matching_statistics(units)
    lane, at = np.nonzero(lengths >= width)  # in order of lanes, then of places
    earliest = index.least_label(places[lane, at])
    useful = np.bincount(lane, earliest < high[lane], len(units)) > 0
    sizes = np.bincount(lane, minlength=len(units))
    found = np.split(earliest, np.cumsum(sizes)[:-1])
    kept = np.flatnonzero(useful)
    earliest = pa.array([found[i].tobytes() for i in kept], pa.binary())
    return pa.Table.from_arrays([rows.column("unit").take(pa.array(kept)), earliest], ["unit", "earliest"])


def repeated_passages(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, n_words, spans, kept)`` of every row of ``docs(doc_id, text)``.

    ``spans`` are the ranges of words ``[first, last)`` covered by windows that also start in a
    document with a smaller id, ``kept`` the other words, joined by one space. A null text has no
    words; a text with fewer than ``width`` words has no window. Rows that repeat an id take
    nothing from each other. A null id counts as larger than all others. Other columns are
    ignored; an empty table gives no rows.
    """
    part = F.shiftright(F.monotonically_increasing_id(), PART_BITS)
    named = docs.select(part.alias("part"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = _written(named, "texts")

    repeated, n_buckets = _repeated_grams(texts, width)
    units = _written(_collect_units(texts, repeated, n_buckets, width), "units")
    n_shards = max(1, units.count() // SHARD)
    columns = ["unit", "gram", "words", "low", "high"]
    often = units.filter("gram = unit").groupBy("unit", "gram").agg(
        F.first("words").alias("words"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    dealt = units.filter("gram <> unit").select(columns).union(often.select(columns))
    shards = dealt.withColumn("shard", F.pmod("gram", F.lit(n_shards))).drop("gram").groupBy("shard")
    found = shards.applyInArrow(lambda rows: _search_shard(rows, width), "unit long, earliest binary")
    found = units.select("unit", "part").distinct().join(found, "unit").select("part", "unit", "earliest")
    earlier = _written_by_part(found, "earlier")
    schema = "doc_id long, n_words long, spans array<struct<first:long,last:long>>, kept binary"
    span = pa.struct([("first", pa.int64()), ("last", pa.int64())])

    def run(batches):
        grams, found = _Lookup(repeated, ["key", "often"]), _Lookup(earlier, ["unit", "earliest"])
        for batch in batches:
            parts, data = batch.column(0).to_numpy(), binaries(batch.column(2))
            ids = batch.column(1).fill_null(_NO_ID).to_numpy()
            for piece in _pieces_of_parts(parts, data):
                part = int(parts[piece.start])
                words, places = word_hashes(data[piece])
                gone = np.zeros(len(words) + 1, np.int64)
                if (here := found.at(part)) is not None:
                    a, b, unit, _ = _units(words, places, grams.at(part), n_buckets, width)
                    at = np.minimum(np.searchsorted(here[0], unit), len(here[0]) - 1)
                    hit = here[0][at] == unit
                    a, b, at = a[hit], b[hit], at[hit]
                    doc = ids[piece][np.searchsorted(places, a, "right") - 1]
                    first = np.frombuffer(b"".join(here[1].take(pa.array(at)).to_pylist()), np.int64)
                    sizes = b - a + 1
                    window = np.repeat(a - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(first))
                    window = window[first < np.repeat(doc, sizes)]
                    np.add.at(gone, window, 1)
                    np.subtract.at(gone, window + width, 1)
                gone = np.cumsum(gone[:-1]) > 0
                spans, kept = [], []
                for text, s, e in zip(data[piece], places[:-1].tolist(), places[1:].tolist()):
                    mine, split = gone[s:e], text.split()
                    if mine.any():
                        turns = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]]))).tolist()
                        spans.append([{"first": x, "last": y} for x, y in zip(turns[::2], turns[1::2])])
                        split = compress(split, (~mine).tolist())
                    else:
                        spans.append([])
                    kept.append(b" ".join(split))
                columns = [batch.column(1).slice(piece.start, len(kept)), pa.array(np.diff(places).astype(np.int64))]
                columns += [pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "spans", "kept"])

    out = texts.select("part", "doc_id", "text").mapInArrow(run, schema)
    return out.withColumn("kept", F.col("kept").cast("string"))


def op11_substring_dedup(spark, sf: str) -> DataFrame:
    found = repeated_passages(table(spark, sf, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
