"""Divergence of sources by cube partitioning.

Every language has its sources (groups) and its frequent terms. The pairs of groups times the
terms are cut into cells (group block, group block, term block). A cell gets the two slices of
counts it needs, replicated to all cells that share them, and adds up the differences of its
pairs over its terms; the partial sums are reduced along the term axis. A cell is bounded by two
blocks of groups times a block of terms, whatever the size of a source or a language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import binaries, pieces, release_caches, strings, table
from linkloom.session import materialise

#: Least number of documents of a term, smoothing of a count, steps of a share, ranks of terms.
LEAST, SMOOTH, STEPS, TOP = 30, 5, 1_000_000_000, 50
#: Sides of a cell.
GROUPS, TERMS = 16, 4096
#: Distinct counts that a task holds before it hands them on, and hands on at once.
HELD, SENT = 100_000, 10_000

_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_COUNTED = "lang string, source string, term string, n long, docs long"


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of ``count_terms`` for Arrow batches of texts, languages and sources."""
    release_caches()
    n, d, groups = {}, {}, {}

    def rows():
        for g, k in groups.items():
            yield *g, None, 0, k
        for g, counts in n.items():
            for t, k in counts.items():
                yield *g, t.decode("utf-8", "replace"), k, d[g][t]

    def out():
        left, kinds = rows(), [*[pa.string()] * 3, *[pa.int64()] * 2]
        while part := list(islice(left, SENT)):
            columns = [pa.array(c, k) for c, k in zip(zip(*part), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for part in pieces(pc.binary_length(batch.column(0)).fill_null(0).to_pylist()):
            texts = batch.slice(part.start, part.stop - part.start)
            for text, lang, source in zip(binaries(texts.column(0)), strings(texts.column(1)), strings(texts.column(2))):
                terms, g = text.translate(_TERM_BYTES).split(), (lang, source)
                groups[g] = groups.get(g, 0) + 1
                if terms:
                    n.setdefault(g, Counter()).update(terms)
                    d.setdefault(g, Counter()).update(set(terms))
            if sum(map(len, n.values())) > HELD:
                yield from out()
                n, d, groups = {}, {}, {}
    if groups:
        yield from out()


def count_terms(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)`` per group and term, and a row with a null term per group.

    ``docs`` is the number of rows of the group that hold the term.
    """
    parts = docs.select("text", "lang", "source").mapInArrow(count_batches, _COUNTED)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str, vocabulary: str) -> str:
    """SQL of 1 + floor(STEPS * (count + SMOOTH) / (total + SMOOTH * vocabulary)), exact in longs.

    Divided in three steps of 1000, so nothing exceeds a long below 9e15 terms. 0 without terms.
    """
    below, rest, share = f"({total} + {SMOOTH} * {vocabulary})", f"({count} + {SMOOTH})", "0L"
    for _ in range(3):
        share = f"({share} * 1000 + ({rest} * 1000) div {below})"
        rest = f"(({rest} * 1000) % {below})"
    return f"CASE WHEN {vocabulary} = 0 THEN 0L ELSE 1 + {share} END"


_CELL = ["lang", "block", "low", "high"]


def _cell_sums(cell: pd.DataFrame) -> pd.DataFrame:
    """Differences of the pairs of groups of one cell, added up over its terms."""

    def slice_of(row):
        number, base = np.asarray(row.numbers, np.int64), np.asarray(row.bases, np.int64)
        dense = np.repeat(base[:, None], row.width, axis=1)  # what a group without the term has
        if row.g is not None and len(row.g):
            dense[np.searchsorted(number, row.g), np.asarray(row.t, np.int64)] = row.p
        return number, dense

    sides = [slice_of(r) for r in cell.sort_values("side").itertuples()]
    (a, rows), (b, others) = sides[0], sides[-1]
    out = []
    for k, number in enumerate(a.tolist()):
        sums, later = np.abs(others - rows[k]).sum(1), b > number
        out.append(pd.DataFrame({"g": number, "h": b[later], "value": sums[later]}))
    found = pd.concat(out, ignore_index=True)
    return found.assign(lang=cell["lang"].iloc[0])[["lang", "g", "h", "value"]]


def _pair_sums(counted: DataFrame, members: DataFrame, widths: DataFrame) -> DataFrame:
    """``(lang, g, h, value)`` of all pairs g < h of groups of a language, by cells."""
    slices = counted.groupBy("lang", "block", "side").agg(F.collect_list(F.struct("g", "t", "p")).alias("held"))
    sides = members.groupBy("lang", "side", "n_blocks", "n_sides").agg(
        F.sort_array(F.collect_list(F.struct("g", "base"))).alias("groups")
    )
    grid = sides.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    grid = grid.join(widths, ["lang", "block"], "left").join(slices, ["lang", "block", "side"], "left")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_sides") - 1))
    cells = grid.select("*", every.alias("other")).select(
        "lang",
        "block",
        F.least("side", "other").alias("low"),
        F.greatest("side", "other").alias("high"),
        "side",
        F.coalesce("width", F.lit(0)).cast("int").alias("width"),
        F.col("groups.g").alias("numbers"),
        F.col("groups.base").alias("bases"),
        *[F.col(f"held.{c}").alias(c) for c in "gtp"],
    )
    partial = cells.groupBy(*_CELL).applyInPandas(_cell_sums, "lang string, g long, h long, value long")
    return partial.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


def source_divergence(
    docs: DataFrame, least: int = LEAST, top: int = TOP, groups: int = GROUPS, terms: int = TERMS
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how sources of a language differ in its frequent terms.

    Part ``pair`` has all other sources of the language, by the sum of differences of shares over
    all kept terms; part ``term`` the ``top`` terms that a source uses more than its language
    does. Equal values go by the item's bytes. Null texts, languages and sources count as empty
    ones; every row is a document, whether its id is null or repeated. A source without kept
    terms has pairs and no terms, a language without kept terms has pairs of value 0, a single
    source has no pairs, an empty table gives no rows. Other columns are ignored.
    """
    parts = materialise(count_terms(docs), "term_counts")
    real = parts.filter("term is not null")
    kept = real.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("_docs"))
    kept = kept.filter(F.col("_docs") >= least).drop("_docs")
    languages = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    languages = materialise(languages.withColumn("n_blocks", F.expr(f"(v + {terms} - 1) div {terms}")), "languages")
    kept = kept.join(languages, "lang").withColumn("block", F.pmod(F.xxhash64("term"), "n_blocks"))
    place = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")) - 1
    kept = materialise(kept.select("lang", "term", "lang_n", "block", place.cast("long").alias("t")), "kept_terms")
    widths = kept.groupBy("lang", "block").agg(F.count("*").alias("width"))

    held = materialise(real.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "held")
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = parts.filter("term is null").select("lang", "source")
    of_language = Window.partitionBy("lang")
    members = (
        named.join(totals, ["lang", "source"], "left")
        .join(languages, "lang", "left")
        .fillna(0, ["total", "v", "lang_total"])
        .fillna(1, ["n_blocks"])
        .withColumn("g", F.row_number().over(of_language.orderBy("source")).cast("long") - 1)
        .withColumn("n_sides", F.expr(f"(count(*) over (partition by lang) + {groups} - 1) div {groups}"))
        .withColumn("side", F.expr(f"g div {groups}"))
        .withColumn("base", F.expr(_share("0L", "total", "v")))
    )
    members = materialise(members, "groups")

    counted = held.join(members, ["lang", "source"]).withColumn("p", F.expr(_share("n", "total", "v")))
    q = F.expr(_share("lang_n", "lang_total", "v"))
    ahead = counted.withColumn("value", F.col("p") - q).filter("value > 0")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = ahead.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    ranked = ranked.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)

    pairs = materialise(_pair_sums(counted, members, widths), "pair_sums")
    both = pairs.union(pairs.select("lang", "h", "g", "value"))
    first = members.select("lang", "g", "source")
    second = members.select("lang", F.col("g").alias("h"), F.col("source").alias("item"))
    both = both.join(first, ["lang", "g"]).join(second, ["lang", "h"])
    both = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return both.withColumn("rank", F.row_number().over(by_value)).union(ranked)


def op12_source_divergence(spark, sf: str) -> DataFrame:
    return source_divergence(table(spark, sf, "documents"))
