"""Near-duplicate vectors by iterative quantisation, multi-index Hamming tables and an exact rerank.

A rotation of the centred vectors is learned such that their signs along it are balanced binary
codes that keep close to the vectors. The code is cut into substrings, each the key of a table of
its own, and pairs that share a key are ranked again by the original vectors. In every table a
vector also looks under the keys it would have if the signs it is least sure of were flipped, so
a pair meets where a substring differs in few bits. Keys are as long as the number of vectors
asks for. How many substrings are needed follows from pairs planted at the threshold on a sample:
where the code of one rotation has too few, further rotations are learned from other beginnings.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import table
from linkloom.llm.components import components
from linkloom.session import materialise

LEAST_COSINE = 0.95
#: Vectors that rotations are learned on, rounds of learning.
SAMPLE, ROUNDS = 2048, 20
#: Of the sample, vectors that pairs are planted on, pairs for each, and the share that may be missed.
PLANTED_ON, PLANTED, MISSED = 512, 8, 0.001
#: Keys a vector looks under in a table, chosen among the flips of its least sure signs; most signs of a key.
PROBES, UNSURE, LONGEST = 8, 5, 48
#: Bits of a code, and those that a pair may differ in beyond what planted pairs do.
CODE, SPARE = 63, 4

_FLIPS = (np.arange(1 << UNSURE)[:, None] >> np.arange(UNSURE)) & 1


def learned_rotation(x: np.ndarray, seed: int) -> np.ndarray:
    """Iterative quantisation of centred vectors: signs and rotation are fitted to each other in turn."""
    width = x.shape[1]
    r = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, width)))[0]
    for _ in range(ROUNDS):
        left, _, right = np.linalg.svd(np.where(x @ r >= 0, 1.0, -1.0).T @ x)
        r = (left @ right).T
    return r


class Tables:
    """A mean, learned directions as columns, and how many of them make a key.

    Substrings follow each other along the columns; the code is made of the first columns.
    """

    def __init__(self, mean: np.ndarray, columns: np.ndarray, bits: int, radius: int = CODE):
        self.mean, self.columns, self.bits, self.radius = mean, columns, bits, radius

    @property
    def n_tables(self) -> int:
        return self.columns.shape[1] // self.bits

    def codes(self, x: np.ndarray) -> np.ndarray:
        signs = (x - self.mean) @ self.columns[:, :CODE] >= 0
        return signs @ (1 << np.arange(signs.shape[1], dtype=np.int64))

    def keys(self, x: np.ndarray, t: int) -> np.ndarray:
        """``PROBES`` keys in table ``t`` for each vector, its own first."""
        along = (x - self.mean) @ self.columns[:, t * self.bits : (t + 1) * self.bits]
        weights = 1 << np.arange(self.bits, dtype=np.int64)
        n = min(UNSURE, self.bits)
        unsure = np.argsort(np.abs(along), 1)[:, :n]
        flips = _FLIPS[: 1 << n, :n]
        cost = np.take_along_axis(along, unsure, 1) ** 2 @ flips.T
        chosen = np.argsort(cost, 1, kind="stable")[:, :PROBES]  # no flip costs nothing
        chosen = np.pad(chosen, ((0, 0), (0, PROBES - chosen.shape[1])), mode="edge")
        flipped = flips[chosen] * weights[unsure][:, None, :]
        return ((along >= 0) @ weights)[:, None] ^ flipped.sum(2)


def planted_pairs(x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of ``x`` and others in random directions at the threshold from them."""
    a = np.repeat(x[:PLANTED_ON], -(-PLANTED_ON * PLANTED // min(len(x), PLANTED_ON)), 0)
    if x.shape[1] == 1:
        return a, a
    z = np.random.default_rng(5).normal(size=a.shape)
    z -= (z * a).sum(1, keepdims=True) * a
    z /= np.sqrt((z * z).sum(1, keepdims=True))
    return a, least * a + math.sqrt(1 - least * least) * z


def lay_tables(x: np.ndarray, n: int, least: float, missed: float = MISSED) -> tuple[Tables, int]:
    """Tables for ``n`` unit vectors like those of ``x``, which find all but ``missed`` of planted pairs.

    The codes' radius is what planted pairs differ in at most, and a little more.
    """
    bits = min(max(math.ceil(math.log2(max(n, 2))) + 1, 2), LONGEST)
    tables = Tables(x.mean(0), np.zeros((x.shape[1], 0)), bits)
    a, b = planted_pairs(x, least)
    found, t, seed = np.zeros(len(a), bool), 0, 0
    while found.mean() < 1 - missed:
        while tables.n_tables <= t or tables.columns.shape[1] < min(CODE, x.shape[1]):
            tables.columns = np.concatenate([tables.columns, learned_rotation(x - tables.mean, seed)], 1)
            seed += 1
        p, q = (tables.keys(v, t) for v in (a, b))
        found |= (p == q[:, :1]).any(1) | (q == p[:, :1]).any(1)
        t += 1
    apart = np.bitwise_count(tables.codes(a) ^ tables.codes(b))
    used = max(t * bits, min(CODE, tables.columns.shape[1]))
    return Tables(tables.mean, tables.columns[:, :used], bits, int(apart.max()) + SPARE), t


def _rows(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().cast(pa.float64())
    return flat.to_numpy(zero_copy_only=False).reshape(-1, width)


def _typed(vectors: DataFrame) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def _is_valid():
    """An id, and a vector of finite numbers that has a direction."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0)
    return F.coalesce(valid, F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fit_tables(classes: DataFrame, least: float) -> tuple[Tables, int]:
    """Tables and their number, laid out by at most ``SAMPLE`` vectors, chosen by a hash of their ids."""
    sample = classes.orderBy(F.xxhash64(F.lit(7), "rep"), "rep").limit(SAMPLE).select("v").collect()
    return lay_tables(unit(np.array([r.v for r in sample], np.float64)), classes.count(), least)


def candidates(classes: DataFrame, tables: Tables, n_tables: int) -> DataFrame:
    """Pairs ``a < b`` where one looks under the other's key in some table and codes are close, each pair once."""
    width, bits, radius = len(tables.mean), tables.bits, tables.radius

    def encode(batches):
        for batch in batches:
            x = unit(_rows(batch.column(1), width))
            keys = np.concatenate([tables.keys(x, t) + (t << bits) for t in range(n_tables)], 1)
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * keys.shape[1], keys.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tables.codes(x)), lists], ["rep", "code", "keys"])

    coded = classes.select("rep", "v").mapInArrow(encode, "rep long, code long, keys array<long>")
    coded = materialise(coded, "coded")
    own = F.array(*[F.col("keys")[t * PROBES] for t in range(n_tables)])
    homes = coded.select(F.col("rep").alias("a"), F.col("code").alias("a_code"), F.explode(own).alias("key"))
    looks = coded.select(F.col("rep").alias("b"), F.col("code").alias("b_code"), F.posexplode("keys").alias("nth", "key"))
    met = homes.join(looks, "key")
    # Two vectors under the same key meet twice; the second time is passed over.
    once = F.when(F.col("nth") % PROBES == 0, F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b"))
    close = F.bit_count(F.col("a_code").bitwiseXOR(F.col("b_code"))) <= radius
    return met.filter(once & close).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _verified(pairs: DataFrame, classes: DataFrame, width: int, least: float) -> DataFrame:
    """Pairs whose cosine, in double precision, is at least ``least``."""
    def check(batches):
        for batch in batches:
            p, q = (_rows(batch.column(k), width) for k in (2, 3))
            cosine = (p * q).sum(1) / (np.sqrt((p * p).sum(1)) * np.sqrt((q * q).sum(1)))
            keep = pa.array(cosine >= least)
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], ["a", "b"])

    v = classes.select("rep", "v")
    both = pairs.join(v.toDF("a", "p"), "a").join(v.toDF("b", "q"), "b").select("a", "b", "p", "q")
    return both.mapInArrow(check, "a long, b long")


def near_vectors(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row of ``vectors(vec_id, embedding)``.

    Equal vectors are folded first and counted by their number. Vectors that are null, empty,
    zero or hold null or non-finite components, and rows with a null id, link with nothing.
    Vectors of different lengths are never compared. Rows that repeat an id are vectors of
    their own that share its number. Other columns are ignored; an empty table gives no rows.
    """
    every = _typed(vectors)
    rows = materialise(every.filter(_is_valid()), "vectors")
    folded = rows.groupBy("v").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("n"))
    # Two vectors may share their smallest id: number the classes by a hash of the vector as well.
    classes = folded.withColumn("rep", F.xxhash64("v")).withColumn("width", F.size("v"))
    classes = materialise(classes, "classes")
    links = None
    for (width,) in classes.select("width").distinct().orderBy("width").collect():
        own = classes.filter(F.col("width") == width)
        met = materialise(candidates(own, *fit_tables(own, least)), "met")
        found = _verified(met, own, width, least)
        links = found if links is None else links.union(found)
    if links is None:
        plain = every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return plain.withColumn("kept", F.col("vec_id").isNotNull())
    links = materialise(links, "links")
    number = classes.select("rep", "n", "least_id")
    both = links.union(links.select("b", "a")).toDF("rep", "near")
    counted = both.join(number.select(F.col("rep").alias("near"), "n"), "near").groupBy("rep").agg(F.sum("n").alias("others"))
    found = components(links).withColumnRenamed("node", "rep")
    members = number.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    smallest = members.groupBy("component").agg(F.min("least_id").alias("component_id"))
    described = members.join(smallest, "component").join(counted, "rep", "left").select(
        "rep", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("links"), "component_id"
    )
    described = materialise(described, "described")
    fine = rows.select("vec_id", F.xxhash64("v").alias("rep"))
    linked = fine.join(described, "rep").select("vec_id", F.col("links").alias("n_links"), "component_id")
    bad = every.filter(~_is_valid())
    alone = bad.select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op7_embedding_dedup(spark, sf: str) -> DataFrame:
    return near_vectors(table(spark, sf, "embeddings"))
