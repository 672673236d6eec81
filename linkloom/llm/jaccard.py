"""Exact Jaccard join of word n-gram sets by T-occurrence search (DivideSkip).

A set links to another only if ``percent`` of its shingles occur in other sets. So

1. copies of a set are folded; a pass over fingerprints, dealt into buckets, counts for each set
   how many occur in a different one, and drops sets with too few. It takes the lower half of
   every set by hash: two linked sets share at least ``percent`` - 50 of a hundred there;
2. the remaining sets are laid out by min-hash in blocks of bounded size. Each block is
   searched by DivideSkip: short inverted lists are merged on a heap that skips, long ones
   are probed by binary search, and what reaches the required overlap is linked. A set that
   links to an indexed one isn't indexed itself, so copies cost a number of links in
   proportion to their group;
3. the same count over components instead of sets leaves the sets that could still link to
   another component. Two of different components overlap in tokens that several components
   hold and in no others, so sets with the same such tokens and the same size link to the same
   sets and fold to a class. Classes are packed into blocks, and all pairs of blocks that share a
   token of a prefix are searched the same way, so no link between components is lost.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import binaries, lower_ascii, mix, pieces, release_caches, table, window_hashes, word_hashes
from linkloom.llm.components import components
from linkloom.operators.ordering import running_totals
from linkloom.session import materialise

WIDTH, PERCENT = 5, 75
#: Fingerprints a bucket holds, shingles a chunk holds, sets and shingles a block holds.
BUCKET, CHUNK, BLOCK_SETS, BLOCK_SHINGLES = 2_000_000, 1_500_000, 500, 2_000_000
#: Shares of all shingles; tokens with more than one are broadcast, fewer than this number.
HEAVY = 100_000
#: Bits for each wanted key and in all (8 MB), of the marks that rows are looked up in before a join.
BITS_PER_KEY, MOST_BITS = 16, 1 << 26
#: Weight of a probe against a merged element when lists are divided.
MU = 0.0085
SEEDS = (0x51ED270B, 0x2545F491, 0x9E3779B1, 0x7F4A7C15)

BUCKETED = "bucket int, chunk long, tokens binary, docs binary, sizes binary, groups binary, many binary"
COUNTED = "chunk long, docs binary, counts binary, keys binary, needed binary"


# Shingle sets


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``width``-word shingles of each text.

    A text with fewer words has its whole sequence as the one shingle, an empty one has none.
    """
    words, places = word_hashes([lower_ascii(t) for t in texts])
    shingles, out = window_hashes(words, width), []
    for s, e in zip(places[:-1].tolist(), places[1:].tolist()):
        if e - s >= width:
            out.append(np.unique(shingles[s : e - width + 1]))
        else:
            out.append(window_hashes(words[s:e], e - s) if e > s else np.zeros(0, np.uint64))
    return out


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _text_sets(batch, width: int):
    """``(row in the batch, set)`` of one Arrow batch whose second column is the text."""
    release_caches()
    texts = binaries(batch.column(1))
    for part in pieces([len(t) for t in texts]):
        yield from zip(range(part.start, part.stop), shingle_sets(texts[part], width))


def describe_sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, n_shingles, set_id)`` of every row; ``set_id`` is a digest of the set, null if empty."""
    def run(batches):
        for batch in batches:
            found = [(len(s), set_digest(s) if len(s) else None) for _, s in _text_sets(batch, width)]
            sizes, digests = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())],
                ["doc_id", "n_shingles", "set_id"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, n_shingles long, set_id binary")


# Sets with enough shingles that occur in another group


def least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def lower_half(shingles: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The lower half of a set by hash, and how many of it any linked set has in its own.

    Of two linked sets with n and m shingles at least ``percent`` of the larger number are
    common. Take the set whose half ends first: what it holds beyond, half of its shingles at
    most, may be common too, the rest of the common ones lie in both halves. That leaves
    ``percent`` - 50 of a hundred of the larger set, so of either. Below 60 the whole set serves.
    """
    n = len(shingles)
    if percent < 60:
        return shingles, least_overlap(n, percent)
    return shingles[: (n + 1) // 2], least_overlap(n, percent - 50)


#: Fingerprints of a set that may be missed, as groups are told apart by 32 bits there.
SLACK = 2


def _ship(chunk: int, sets: list, n_buckets: int):
    """Rows of BUCKETED for one chunk of ``(key, group, shingles, needed)``, and its own row of keys.

    Shingles that several groups of the chunk share are settled here and sent once.
    """
    sizes = np.array([len(s) for _, _, s, _ in sets])
    tokens = np.concatenate([s for _, _, s, _ in sets])
    groups = np.array([g & 0xFFFFFFFF for _, g, _, _ in sets], np.uint32)
    doc = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
    order = np.argsort(tokens, kind="stable")
    sorted_tokens = tokens[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_tokens[1:] != sorted_tokens[:-1]]))
    g = groups[doc[order]]
    shared = np.minimum.reduceat(g, starts) != np.maximum.reduceat(g, starts)
    settled = np.zeros(len(tokens), bool)
    settled[order] = np.repeat(shared, np.diff(np.append(starts, len(tokens))))
    local = np.bincount(doc[settled], minlength=len(sets)).astype(np.uint32)
    keys = b"".join(k for k, *_ in sets)
    needed = np.array([max(0, n - SLACK) for *_, n in sets], np.uint32)  # the smallest sets all stay
    own = {"chunk": chunk, "docs": np.arange(len(sets), dtype=np.uint32).tobytes(), "counts": local.tobytes()}
    own |= {"keys": keys, "needed": needed.tobytes()}

    many = sorted_tokens[starts[shared]]
    single, single_doc = tokens[~settled], doc[~settled]
    place = _bucket(single, n_buckets)
    order = np.argsort(place, kind="stable")  # keeps documents in order within a bucket
    cuts = np.searchsorted(place[order], np.arange(n_buckets + 1))
    many_place = _bucket(many, n_buckets)
    for b in range(n_buckets):
        here = order[cuts[b] : cuts[b + 1]]
        common = many[many_place == b]
        if len(here) or len(common):
            docs, counts = np.unique(single_doc[here], return_counts=True)
            yield {
                "bucket": b,
                "chunk": chunk,
                "tokens": single[here].astype(np.uint32).tobytes(),
                "docs": docs.astype(np.uint32).tobytes(),
                "sizes": counts.astype(np.uint32).tobytes(),
                "groups": groups[docs].tobytes(),
                "many": common.astype(np.uint32).tobytes(),
            }
    yield {"bucket": chunk % n_buckets, "chunk": chunk, "own": own}


def _bucket(tokens: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((tokens >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)


def _settle(rows: pd.DataFrame) -> pd.DataFrame:
    """One bucket: for each chunk and document, how many of its fingerprints another group holds."""
    release_caches()
    out = [(r.chunk, r.docs, r.sizes, r.groups, r.many) for r in rows[rows.tokens.isna()].itertuples()]
    rows = rows[rows.tokens.notna()]
    read = lambda column, kind: [np.frombuffer(x, kind) for x in rows[column]]
    tokens, docs, sizes, groups = (read(*x) for x in (("tokens", "u4"), ("docs", "u4"), ("sizes", "u4"), ("groups", "u4")))
    many = np.unique(np.concatenate([np.zeros(0, np.uint32), *read("many", "u4")]))
    every = np.concatenate([np.zeros(0, np.uint32), *tokens])
    if len(every):
        group = np.concatenate([np.repeat(g, s) for g, s in zip(groups, sizes)])
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        g = group[order]
        shared = np.minimum.reduceat(g, starts) != np.maximum.reduceat(g, starts)
        shared |= np.isin(ranked[starts], many)
        hit = np.zeros(len(every), bool)
        hit[order] = np.repeat(shared, np.diff(np.append(starts, len(every))))
        at = 0
        for chunk, t, d, s in zip(rows["chunk"], tokens, docs, sizes):
            if len(t):
                counts = np.add.reduceat(hit[at : at + len(t)].astype(np.uint32), (np.cumsum(s) - s).astype(np.int64))
                keep = counts > 0
                out.append((chunk, d[keep].tobytes(), counts[keep].astype(np.uint32).tobytes(), None, None))
                at += len(t)
    return pd.DataFrame(out, columns=["chunk", "docs", "counts", "keys", "needed"])


def _decide(rows: pd.DataFrame) -> pd.DataFrame:
    """One chunk: the keys of the sets that reach the count they need."""
    own = rows[rows["keys"].notna()].iloc[0]
    needed = np.frombuffer(own.needed, np.uint32)
    total = np.zeros(len(needed), np.int64)
    for d, c in zip(rows.docs, rows.counts):
        total[np.frombuffer(d, np.uint32)] += np.frombuffer(c, np.uint32)
    keys = [own["keys"][16 * i : 16 * i + 16] for i in np.flatnonzero(total >= needed)]
    return pd.DataFrame({"set_id": pd.Series(keys, dtype=object)})


def sets_shared_enough(rows: DataFrame, sets_of, n_shingles: int, percent: int) -> DataFrame:
    """Distinct ids of sets of whose lower half enough occurs in that of a set of another group.

    ``sets_of(batch)`` yields ``(key, group, shingles)``. Fingerprints have 32 bits besides the
    bucket's, so a chance collision may keep a set, never drop one.
    """
    n_buckets = max(24, -(-n_shingles // BUCKET))
    names = [x.split()[0] for x in BUCKETED.split(", ")]
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5]

    def ship(batches):
        first, n_chunks, held, size = TaskContext.get().partitionId() << 32, 0, {}, 0

        def out():
            for r in _ship(first + n_chunks, list(held.values()), n_buckets):
                if own := r.pop("own", None):
                    r |= {"docs": own["docs"], "sizes": own["counts"], "groups": own["keys"], "many": own["needed"]}
                yield pa.RecordBatch.from_arrays([pa.array([r.get(n)], k) for n, k in zip(names, kinds)], names)

        for batch in batches:
            for key, group, shingles in sets_of(batch):
                if len(shingles) and key not in held:
                    held[key] = key, group, *lower_half(shingles, percent)
                    size += len(held[key][2])
                if size >= CHUNK:
                    yield from out()
                    n_chunks, held, size = n_chunks + 1, {}, 0
        if held:
            yield from out()

    counted = rows.mapInArrow(ship, BUCKETED).groupBy("bucket").applyInPandas(_settle, COUNTED)
    return counted.groupBy("chunk").applyInPandas(_decide, "set_id binary").distinct()


# T-occurrence search


def divide_skip(lists: list[list[int]], starts: list[int], least: int) -> list[tuple[int, int]]:
    """``(id, occurrences)`` of all ids in at least ``least`` of the ascending lists.

    ``starts`` is where each list is read from. The longest lists are left out of the merge and
    only probed for ids that the others can't settle.
    """
    if len(lists) < least:
        return []
    by_size = sorted(range(len(lists)), key=lambda i: starts[i] - len(lists[i]))
    longest = len(lists[by_size[0]]) - starts[by_size[0]]
    n_long = min(least - 1, int(least / (MU * math.log2(longest + 1) + 1)))
    long, short = by_size[:n_long], by_size[n_long:]
    need, at, found = least - n_long, list(starts), []
    heap = [(lists[i][at[i]], i) for i in short if at[i] < len(lists[i])]
    heapq.heapify(heap)
    while len(heap) >= need:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= need:
            count = len(popped)
            for k, i in enumerate(long):
                if count + len(long) - k < least:
                    break
                place = bisect_left(lists[i], top, starts[i])
                count += place < len(lists[i]) and lists[i][place] == top
            if count >= least:
                found.append((top, count))
            target = top + 1
        else:  # skip to where enough lists can meet
            while heap and len(popped) < need - 1:
                popped.append(heapq.heappop(heap)[1])
            target = heap[0][0] if heap else None
        for i in popped if target is not None else ():
            at[i] = bisect_left(lists[i], target, at[i])
            if at[i] < len(lists[i]):
                heapq.heappush(heap, (lists[i][at[i]], i))
    return found


def search_block(block: list[tuple[bytes, np.ndarray]], percent: int) -> list[tuple[bytes, bytes]]:
    """Links of one block: every set is searched among the indexed ones of at most its size."""
    block = sorted(block, key=lambda x: (len(x[1]), x[0]))
    index: dict[int, list[int]] = {}
    sizes, names, links = [], [], []
    for name, shingles in block:
        n, tokens = len(shingles), shingles.tolist()
        low = bisect_left(sizes, least_overlap(n, percent))
        lists, starts = [], []
        for t in tokens:
            held = index.get(t)
            if held is not None and held[-1] >= low:
                lists.append(held)
                starts.append(bisect_left(held, low) if low else 0)
        linked = False
        for k, overlap in divide_skip(lists, starts, least_overlap(n, percent)):
            if 100 * overlap >= percent * (n + sizes[k] - overlap):
                links.append((names[k], name))
                linked = True
        if not linked:
            for t in tokens:
                index.setdefault(t, []).append(len(sizes))
            sizes.append(n)
            names.append(name)
    return links


def search_blocks(laid: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` within runs of equal ``(seed, key)`` of ``(seed, key, set_id, shingles)``.

    The sets of one key are laid next to each other by a range partitioning that may cut a
    large one anywhere; runs end at a block's bound. What that keeps apart is left to the
    search between components.
    """
    def run(batches):
        block, last, held = [], None, 0

        def out():
            links = search_block(block, percent) if len(block) > 1 else []
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*links)], ["a", "b"])

        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(4)))
            for seed, key, name, shingles in rows:
                if (seed, key) != last or len(block) >= BLOCK_SETS or held >= BLOCK_SHINGLES:
                    yield from out()
                    block, last, held = [], (seed, key), 0
                block.append((name, np.frombuffer(shingles, np.uint64)))
                held += len(block[-1][1])
        yield from out()

    by = ["seed", "key", "set_id"]
    laid = laid.select(*by, "shingles").repartitionByRange(*by).sortWithinPartitions(*by)
    return laid.mapInArrow(run, "a binary, b binary")


def least_hash(shingles: np.ndarray, seed: int) -> int:
    return int(mix(shingles ^ np.uint64(seed)).min().view(np.int64))


# The join


def likely(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose ``key`` may be in ``wanted``: all that are, and some that are not.

    Wide rows pass here before a join, which then shuffles few that it drops. A hash of each
    wanted key sets a bit; the bits are broadcast, MOST_BITS at most, beyond which more rows pass.
    """
    bits = min(MOST_BITS, 1 << max(15, (BITS_PER_KEY * wanted.count()).bit_length()))
    place = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    marks = wanted.select(place.alias("_place")).groupBy(F.bitmap_bucket_number("_place").alias("_bucket"))
    marks = marks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = (F.bitmap_bucket_number(place) == F.col("_bucket")) & (F.getbit(byte, (at % 8).cast("int")) == 1)
    return rows.join(F.broadcast(marks), marked, "left_semi")


def gather_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``(set_id, n, k0.., shingles)`` of the sets ``wanted(doc_id, set_id)``, each once."""
    keys = ", ".join(f"k{i} long" for i in range(len(SEEDS)))

    def run(batches):
        for batch in batches:
            wanted_ids, rows = batch.column(2).to_pylist(), []
            for i, shingles in _text_sets(batch, width):
                if len(shingles) and set_digest(shingles) == wanted_ids[i]:
                    rows.append((wanted_ids[i], len(shingles), *(least_hash(shingles, s) for s in SEEDS), shingles.tobytes()))
                if len(rows) >= 500:
                    yield _set_batch(rows)
                    rows = []
            if rows:
                yield _set_batch(rows)

    rows = likely(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id", wanted)
    rows = rows.join(wanted, "doc_id").select("doc_id", "text", "set_id")
    found = rows.mapInArrow(run, f"set_id binary, n long, {keys}, shingles binary")
    return found


def _set_batch(rows):
    kinds = [pa.binary(), *[pa.int64()] * (len(SEEDS) + 1), pa.binary()]
    names = ["set_id", "n", *(f"k{i}" for i in range(len(SEEDS))), "shingles"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def _labelled(sets: DataFrame, found: DataFrame) -> DataFrame:
    """Sets with their component; alone they are their own. Shuffled at every size: ``found`` grows with the input."""
    named = found.withColumnRenamed("node", "set_id").hint("merge")
    return sets.join(named, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))


PACKED = (
    "block long, part long, high_size long, high_component binary, "
    "names binary, components binary, sizes binary, lengths binary, shingles binary"
)


def _pack(laid: DataFrame) -> DataFrame:
    """Sets in their order as rows of a block, of at most BLOCK_SETS sets or about BLOCK_SHINGLES / 8 shingles.

    ``laid`` has a number ``part``, which a block never crosses.
    """
    def run(batches):
        first, n_blocks, rows, held = TaskContext.get().partitionId() << 32, 0, [], 0

        def out():
            parts, names, sizes, components, shingles, numbers = zip(*rows)
            row = [first + n_blocks, parts[0], *max(zip(sizes, components)), b"".join(names), b"".join(components)]
            row += [np.array(numbers, np.int64).tobytes()]
            row += [np.array([len(s) // 8 for s in shingles], np.int64).tobytes(), b"".join(shingles)]
            kinds = [*[pa.int64()] * 3, *[pa.binary()] * 6]
            columns = [pa.array([v], k) for v, k in zip(row, kinds)]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PACKED.split(", ")])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if rows and (row[0] != rows[0][0] or len(rows) >= BLOCK_SETS or held >= BLOCK_SHINGLES // 8):
                    yield out()
                    n_blocks, rows, held = n_blocks + 1, [], 0
                rows.append(row)
                held += len(row[4]) // 8
        if rows:
            yield out()

    return laid.select("part", "set_id", "size", "component", "shingles", "n").mapInArrow(run, PACKED)


def _rare_prefixes(sets: DataFrame, total: int, percent: int) -> DataFrame:
    """``(no, token)``: the prefix of each set of ``sets(no, cno, n, shingles)``.

    Tokens are ordered by how many sets hold them, those of a single component ``cno`` before all
    others and left out. Of two linked sets of different components each has one of the common
    tokens among its first ``n - least + 1``, so rare tokens lead the search and what many
    documents share only where nothing else could link. Sets with no such token have no row.

    ``total`` is the number of shingles: fewer than HEAVY tokens are in more than total / HEAVY
    sets, so these are broadcast, and no group of the shuffled join is larger than that.
    """
    tokens = sets.select("no", "cno", "shingles").mapInArrow(_explode_tokens, "token long, no long, cno long")
    held = tokens.groupBy("token").agg(F.count("*").alias("held"), F.min("cno").alias("_a"), F.max("cno").alias("_b"))
    held = materialise(held.filter("_a <> _b").select("token", "held"), "held")
    heavy = F.col("held") > total // HEAVY
    most = held.filter(heavy)
    few = tokens.join(F.broadcast(most), "token", "left_anti").join(held.filter(~heavy), "token")
    both = few.select("no", "token", "held").union(tokens.join(F.broadcast(most), "token").select("no", "token", "held"))
    of_set = Window.partitionBy("no")
    place = F.row_number().over(of_set.orderBy("held", "token"))
    ranked = both.select("*", place.alias("place")).select("*", F.count("*").over(of_set).alias("shared"))
    ranked = ranked.join(sets.select("no", "n"), "no")
    least = F.expr(f"({percent} * n + 99) div 100")
    return ranked.filter(F.col("place") <= F.col("shared") - least + 1).select("no", "token")


class _Block:
    """Classes with their component, the size of their sets, and the tokens they share with others."""

    def __init__(self, names: bytes, components: bytes, sizes: bytes, lengths: bytes, shingles: bytes):
        self.names = [names[i : i + 16] for i in range(0, len(names), 16)]
        self.components = [components[i : i + 16] for i in range(0, len(components), 16)]
        self.sizes, self.lengths = np.frombuffer(sizes, np.int64), np.frombuffer(lengths, np.int64)
        flat = np.frombuffer(shingles, np.uint64)
        self.sets = np.split(flat, np.cumsum(self.lengths)[:-1])

    def index(self):
        """Distinct tokens, where each one's list begins (one entry more), and the lists."""
        doc = np.repeat(np.arange(len(self.sets)), self.lengths)
        flat = np.concatenate(self.sets)
        order = np.lexsort((doc, flat))
        tokens, starts = np.unique(flat[order], return_index=True)
        return tokens, np.append(starts, len(flat)), doc[order]


def search_pair(queries: _Block, indexed: _Block, percent: int) -> list[tuple[bytes, bytes]]:
    """A link from each query to every other component in the indexed block that it links to.

    DivideSkip on arrays: the short lists of a query are merged, what they hold often enough is
    probed by binary search in the long ones.
    """
    tokens, starts, lists = indexed.index()
    links = []
    for name, component, n, shingles in zip(queries.names, queries.components, queries.sizes.tolist(), queries.sets):
        least = least_overlap(n, percent)
        at = np.searchsorted(tokens, shingles)
        at = at[np.take(tokens, at, mode="clip") == shingles]
        if len(at) < least:
            continue
        lengths = starts[at + 1] - starts[at]
        at = at[np.argsort(-lengths, kind="stable")]
        n_long = min(least - 1, int(least / (MU * math.log2(int(lengths.max()) + 1) + 1)))
        merged = np.concatenate([lists[starts[k] : starts[k + 1]] for k in at[n_long:]])
        counts = np.bincount(merged, minlength=len(indexed.sets))
        found = np.flatnonzero(counts >= least - n_long)
        overlap = counts[found]
        for k in at[:n_long] if len(found) else ():
            held = lists[starts[k] : starts[k + 1]]
            overlap = overlap + (np.take(held, np.searchsorted(held, found), mode="clip") == found)
        seen = {component}
        for d, both in zip(found.tolist(), overlap.tolist()):
            other = indexed.components[d]
            if other not in seen and 100 * both >= percent * (n + int(indexed.sizes[d]) - both):
                seen.add(other)
                links.append((name, indexed.names[d]))
    return links


def _explode_tokens(batches):
    for batch in batches:
        for no, cno, shingles in zip(*(batch.column(i).to_pylist() for i in range(3))):
            tokens = np.frombuffer(shingles, np.int64)
            columns = [pa.array(tokens), pa.array(np.full(len(tokens), no)), pa.array(np.full(len(tokens), cno))]
            yield pa.RecordBatch.from_arrays(columns, ["token", "no", "cno"])


_MEMBERS = "class binary, set_id binary, n long, size long, component binary, key long, cno long, shingles binary"


def _classes(sets: DataFrame, ranks: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Sets of ``sets(no, cno, n, ..)`` folded by size and by the tokens that several components hold.

    ``ranks(component, size, key)`` describes the components.

    Returns the members and the classes, whose ``shingles`` are just those tokens. Sets with too
    few of them for any link are left out. A class of one component keeps it, one of several is a
    component of its own.
    """
    tokens = sets.select("no", "cno", "shingles").mapInArrow(_explode_tokens, "token long, no long, cno long")
    held = tokens.groupBy("token").agg(F.min("cno").alias("_a"), F.max("cno").alias("_b")).filter("_a <> _b")
    held = materialise(held.select("token"), "held")
    shared = tokens.join(held, "token").groupBy("no").agg(F.sort_array(F.collect_list("token")).alias("shared"))
    shared = sets.drop("shingles").join(ranks, "component").join(shared, "no").filter(F.size("shared") >= F.expr(f"({percent} * n + 99) div 100"))
    names = [x.split()[0] for x in _MEMBERS.split(", ")]

    def run(batches):
        for batch in batches:
            lists = [np.array(x, np.int64).tobytes() for x in batch.column("shared").to_pylist()]
            sizes = batch.column("n").to_pylist()
            digests = [hashlib.blake2b(x + n.to_bytes(8, "little"), digest_size=16).digest() for x, n in zip(lists, sizes)]
            rest = [batch.column(c) for c in names[1:-1]]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), *rest, pa.array(lists, pa.binary())], names)

    members = materialise(shared.select(*names[1:-1], "shared").mapInArrow(run, _MEMBERS), "members")
    folded = members.groupBy("class").agg(
        *[F.min(c).alias(c) for c in ("set_id", "key", "size", "component", "cno")],
        *[F.first(c).alias(c) for c in ("n", "shingles")],
        F.max("component").alias("_last"),
    )
    several = F.col("component") != F.col("_last")
    folded = folded.withColumns(
        {"several": several, "no": F.monotonically_increasing_id(), "size": F.when(several, 2).otherwise(F.col("size")),
         "component": F.when(several, F.col("class")).otherwise(F.col("component"))}
    )
    folded = materialise(folded.drop("_last"), "classes_of_sets")
    return members, folded.withColumn("cno", F.when(F.col("several"), -1 - F.col("no")).otherwise(F.col("cno")))


def _between_components(sets: DataFrame, found: DataFrame, percent: int) -> DataFrame | None:
    """Links that join all components with links between them; None if there can't be any.

    Sets that could link elsewhere are folded to classes and packed into blocks, small components
    apart from large ones. A class is searched for in the blocks that hold a token of its prefix
    in one of theirs and a component after its own; two linked classes always share one. Where a
    class links to itself or to another, its members of different components are linked.

    Blocks are filled along the order of classes, so their number follows the classes and not the
    partitions. A class goes to a block once, however many tokens lead there; with a passage common
    to n classes that is n * n / BLOCK_SETS times at most, the pairs being compared in the tasks.
    """
    total = sets.agg(F.sum("n")).first()[0] or 0

    def sets_of(batch):
        for name, shingles, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
            yield name, int.from_bytes(c[:8], "little"), np.frombuffer(shingles, np.uint64)

    labelled = _labelled(sets.select("set_id", "shingles"), found).select("set_id", "shingles", "component")
    open_sets = materialise(sets_shared_enough(labelled, sets_of, total, percent), "open_ids")
    if open_sets.isEmpty():
        return None
    numbers = found.select("component").distinct().withColumn("cno", 2 * F.monotonically_increasing_id())
    numbered = found.join(materialise(numbers, "numbers"), "component")
    left = _labelled(likely(sets.select("set_id", "n", "k0", "shingles"), "set_id", open_sets), numbered)
    left = left.join(open_sets.hint("merge"), "set_id", "left_semi").withColumn("no", F.monotonically_increasing_id())
    left = materialise(left.withColumn("cno", F.coalesce("cno", 2 * F.col("no") + 1)), "open_sets")
    ranks = materialise(left.groupBy("component").agg(F.count("*").alias("size"), F.min("k0").alias("key")), "ranks")
    members, left = _classes(left, ranks, percent)
    firsts = members.groupBy("class", "component").agg(F.min("set_id").alias("b"))
    firsts = firsts.join(left.filter("several").select("class", F.col("set_id").alias("a")), "class").filter("a <> b")
    firsts = materialise(firsts.select("class", "a", "b"), "class_members")
    itself = F.expr(f"100 * (length(shingles) div 8) >= {percent} * (2 * n - length(shingles) div 8)")
    own = firsts.join(left.filter("several").filter(itself).select("class"), "class", "left_semi").select("a", "b")

    n_open = left.agg(F.sum(F.expr("length(shingles) div 8"))).first()[0] or 0
    prefixes = materialise(_rare_prefixes(left, n_open, percent), "prefixes")
    most = BLOCK_SHINGLES // 8
    weight = F.greatest(F.lit(most), F.expr(f"{BLOCK_SETS} * (length(shingles) div 8)").cast("long"))
    order = ["large", "key", "size", "component", "set_id"]
    order_of = left.withColumns({"large": F.col("size") > 1, "weight": weight}).select("no", *order, "weight")
    order_of = order_of.join(prefixes.select("no").distinct(), "no", "left_semi")
    part = F.floor(F.col("weight_before") / (BLOCK_SETS * most)).alias("part")
    parts = running_totals(order_of, [], order, ["weight"]).select("no", part)
    laid = left.join(materialise(parts, "parts"), "no").repartition("part").sortWithinPartitions("part", "set_id")
    blocks = materialise(_pack(laid), "blocks")

    def held_in(batches):
        for batch in batches:
            for block, names in zip(*(c.to_pylist() for c in batch.columns)):
                ids = pa.array([names[i : i + 16] for i in range(0, len(names), 16)], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, pa.array([block] * len(ids))], ["set_id", "block"])

    held = blocks.select("block", "names").mapInArrow(held_in, "set_id binary, block long")
    held = held.join(left.select("no", "set_id"), "set_id").join(prefixes, "no")
    held = materialise(held.select("token", "block").distinct(), "held_blocks")
    # Tokens that lead to the same blocks are one route, told by what their blocks mix to.
    mixed = [F.bit_xor(F.xxhash64(F.lit(seed), "block")) for seed in (1, 2)]
    route = F.struct(F.count("*").alias("n"), mixed[0].alias("x"), mixed[1].alias("y"))
    routes = materialise(held.groupBy("token").agg(route.alias("route")), "routes")
    highs = blocks.select("block", F.struct("high_size", "high_component").alias("high"))
    ways = held.join(routes, "token").select("route", "block").distinct().join(highs, "block").groupBy("route")
    ways = materialise(ways.agg(F.collect_list("block").alias("blocks"), F.max("high").alias("high")), "route_blocks")
    asked = prefixes.join(routes, "token").select("no", "route").distinct()
    asked = asked.join(left.select("no", F.struct("size", "component").alias("own")), "no")
    asked = asked.join(ways, "route").filter("own < high").groupBy("no", "own")
    asked = asked.agg(F.array_distinct(F.flatten(F.collect_list("blocks"))).alias("blocks"))
    routed = asked.select("no", "own", F.explode("blocks").alias("block")).join(highs, "block").filter("own < high")
    routed = materialise(routed.select("no", F.col("block").alias("part")), "routed")
    queries = routed.join(left.select("no", "set_id", "size", "component", "shingles", "n"), "no")
    queries = _pack(queries.repartitionByRange("part", "set_id").sortWithinPartitions("part", "set_id"))

    def search(batches):
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                links = search_pair(_Block(*row[:5]), _Block(*row[5:]), percent)
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*links)], ["a", "b"])

    parts = ("names", "components", "sizes", "lengths", "shingles")
    q = queries.select("part", *(F.col(c).alias(f"q_{c}") for c in parts))
    i = blocks.select(F.col("block").alias("part"), *(F.col(c).alias(f"i_{c}") for c in parts))
    both = materialise(q, "queries").join(i, "part").select(*(f"{x}_{c}" for x in "qi" for c in parts))
    links = materialise(both.mapInArrow(search, "a binary, b binary"), "class_links")
    linked = links.select("a").union(links.select("b")).distinct()
    return links.union(own).union(firsts.join(linked, "a", "left_semi").select("a", "b"))


def jaccard_components(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row of ``docs(doc_id, text)``.

    Texts link when 100 * intersection >= ``percent`` * union of their shingle sets. A text
    without words is linked with nothing. Rows that repeat an id are nodes of their own that
    share its number. A row with a null id keeps its size, has no component and links nothing.
    Only components are kept: once two are known to be one, no further link between them is
    searched for, so there is no list of links and no number of links. Other columns are ignored; an empty table gives no rows.
    """
    described = materialise(describe_sets(docs, width), "sets")
    named = described.filter("doc_id is not null and set_id is not null")
    classes = materialise(
        named.groupBy("set_id").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n")), "classes"
    )
    # Texts are shipped by row, so copies count too.
    total = named.agg(F.sum("n_shingles")).first()[0] or 0

    def sets_of(batch):
        ids = batch.column(0)
        for i, shingles in _text_sets(batch, width):
            if len(shingles) and ids[i].is_valid:
                digest = set_digest(shingles)
                yield digest, int.from_bytes(digest[:8], "little"), shingles

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    close = sets_shared_enough(texts, sets_of, total, percent)
    wanted = classes.join(close, "set_id", "left_semi").select(F.col("first_id").alias("doc_id"), "set_id")
    sets = materialise(gather_sets(docs, materialise(wanted, "wanted"), width).dropDuplicates(["set_id"]), "shingles")

    laid = sets.select(F.lit(0).alias("seed"), F.col("k0").alias("key"), "set_id", "shingles")
    links = materialise(search_blocks(laid, percent), "links")
    found = materialise(components(links), "components")

    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("seed"), F.col(f"k{i}").alias("key")) for i in range(len(SEEDS))]))
    firsts = _labelled(sets.drop("shingles", "n"), found).select("set_id", "component", keys.alias("k"))
    firsts = firsts.groupBy("k.seed", "k.key", "component").agg(F.min("set_id").alias("set_id"))
    firsts = materialise(firsts, "firsts")
    several = firsts.groupBy("seed", "key").agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    laid = firsts.join(several, ["seed", "key"]).join(sets.select("set_id", "shingles"), "set_id")
    links = materialise(links.union(search_blocks(laid, percent)), "links")
    found = materialise(components(links), "components")

    more = _between_components(sets, found, percent)
    if more is not None:
        links = materialise(links.union(more), "links")
        found = materialise(components(links), "components")

    members = classes.join(found.withColumnRenamed("node", "set_id"), "set_id")
    smallest = members.groupBy("component").agg(F.min("first_id").alias("component_id"))
    linked = materialise(members.join(smallest, "component").select("set_id", F.col("component_id").alias("_c")), "linked")
    labels = classes.join(linked, "set_id", "left").select("set_id", F.coalesce("_c", "first_id").alias("_c"))
    labels = materialise(labels, "labels")
    alone = F.when(F.col("set_id").isNull(), F.col("doc_id"))
    joined = described.join(labels, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", alone))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"))


def op2_jaccard_join(spark, sf: str) -> DataFrame:
    return jaccard_components(table(spark, sf, "documents"))
