"""License scan by a generalised suffix automaton.

The automaton holds the words of all templates and phrases. A file is streamed through it and
gives, for every word, the longest run ending there that occurs in a template (matching
statistics). Long maximal runs are chained, template by template, into covered spans.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import binaries, map_texts, pieces, table

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices and texts of public licences.
TEMPLATES = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
        AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
        this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License.""",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": """This program is free software: you can redistribute it and/or modify it under the terms
        of the GNU General Public License as published by the Free Software Foundation, either version 3
        of the License, or (at your option) any later version. This program is distributed in the hope
        that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this
        program.""",
    "bsd-3-clause": """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: Redistributions of source code must
        retain the above copyright notice, this list of conditions and the following disclaimer.
        Redistributions in binary form must reproduce the above copyright notice, this list of conditions
        and the following disclaimer in the documentation and/or other materials provided with the
        distribution. Neither the name of the copyright holder nor the names of its contributors may be
        used to endorse or promote products derived from this software without specific prior written
        permission.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear
        in all copies.""",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
}

#: Shortest match that joins a chain, widest gap inside one, and the share of a template's
#: words that a span must cover to name it.
LEAST_MATCH, WIDEST_GAP, COVERED = 3, 12, 0.75

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.translate(_WORDS).split()


class GeneralisedAutomaton:
    """Suffix automaton of several sequences, with every place a state's strings end at."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        for k, sequence in enumerate(sequences):
            last = 0
            for place, symbol in enumerate(sequence):
                last = self._extend(last, symbol)
                self.ends[last].append((k, place + 1))
        # An end of a state is an end of all its suffix links.
        for s in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[s] > 0:
                self.ends[self.link[s]] += self.ends[s]

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, p: int, q: int, symbol: int) -> int:
        """``q`` as reached from ``p``: itself, or a copy for the shorter strings."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, symbol: int) -> int:
        if symbol in self.next[last]:  # an earlier sequence has been here
            return self._split(last, self.next[last][symbol], symbol)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and symbol not in self.next[p]:
            self.next[p][symbol] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][symbol], symbol)
        return new

    def statistics(self, symbols: list[int]) -> tuple[list[int], list[int]]:
        """For each place the length of the longest match that ends there, and its state."""
        lengths, states, s, n = [], [], 0, 0
        for x in symbols:
            while s and x not in self.next[s]:
                s = self.link[s]
                n = self.length[s]
            if x in self.next[s]:
                s, n = self.next[s][x], n + 1
            else:
                s = n = 0
            lengths.append(n)
            states.append(s)
        return lengths, states


class LicenseScanner:
    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES):
        phrase_words = [words_of(p.encode()) for p in phrases]
        template_words = [words_of(t.encode()) for t in templates.values()]
        self.ids: dict[bytes, int] = {}
        sequences = [[self.ids.setdefault(w, len(self.ids)) for w in ws] for ws in (*template_words, *phrase_words)]
        self.names, self.sizes = list(templates), [len(ws) for ws in template_words]
        self.automaton = a = GeneralisedAutomaton(sequences)
        # Phrases that end wherever a state's strings do: those of the state and of its links.
        self.phrases: list[tuple[tuple[int, str], ...]] = [()] * len(a.next)
        own: dict[int, list[tuple[int, str]]] = {}
        for words, label in zip(phrase_words, phrases.values()):
            s = 0
            for w in words:
                s = a.next[s][self.ids[w]]
            own.setdefault(s, []).append((len(words), label))
        for s in sorted(range(1, len(a.next)), key=a.length.__getitem__):
            self.phrases[s] = (*own.get(s, ()), *self.phrases[a.link[s]])
        n = len(self.ids)
        self.pairs = np.zeros((n + 1, n + 1), bool)
        for sequence in sequences:
            self.pairs[sequence[:-1], sequence[1:]] = True
        self.shortest = min(map(len, (*phrase_words, *template_words)))

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str, float]]]:
        """``(start, end, label)`` of every phrase and ``(start, end, template, coverage)`` of every span.

        Words outside a pair of words that some template holds match one word at most, so the
        automaton is fed with the runs of such pairs only.
        """
        none = len(self.ids)
        ids = np.fromiter(map(self.ids.get, words, [none] * len(words)), np.int64, len(words))
        if self.shortest < 2:
            runs = [(0, len(words))] if len(words) else []
        else:
            hit = np.concatenate([[False], self.pairs[ids[:-1], ids[1:]], [False]]) if len(ids) > 1 else np.zeros(2, bool)
            edges = np.flatnonzero(hit[1:] != hit[:-1]).reshape(-1, 2)
            runs = [(int(a), int(b) + 1) for a, b in edges]
        found, matches = [], []
        for first, end in runs:
            lengths, states = self.automaton.statistics(ids[first:end].tolist())
            for k, (n, s) in enumerate(zip(lengths, states)):
                at = first + k + 1
                found += [(at - size, at, label) for size, label in self.phrases[s] if size <= n]
                grows = k + 1 < len(lengths) and lengths[k + 1] == n + 1
                if n >= LEAST_MATCH and not grows:
                    matches.append((at - n, at, s))
        return found, self._chain(matches)

    def _chain(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, str, float]]:
        """Spans from matches in order: each goes on the best chain that it continues in text and template."""
        open_chains: dict[int, list[list[int]]] = {}  # template: [start, end, template's end, covered]
        spans = []

        def close(template: int, chain: list[int]) -> None:
            share = chain[3] / self.sizes[template]
            if share >= COVERED:
                spans.append((chain[0], chain[1], self.names[template], min(1.0, share)))

        for start, end, state in matches:
            n = end - start
            for template, place in self.automaton.ends[state]:
                if template >= len(self.names):
                    continue
                chains = open_chains.setdefault(template, [])
                for old in [c for c in chains if start - c[1] > WIDEST_GAP]:
                    chains.remove(old)
                    close(template, old)
                best = None
                for c in chains:
                    fits = c[1] < end and c[2] < place and place - n - c[2] <= WIDEST_GAP
                    if fits and (best is None or c[3] > best[3]):
                        best = c
                if best is None:
                    chains.append([start, end, place, n])
                else:
                    fresh = min(n, end - best[1], place - best[2])
                    best[1:] = [end, place, best[3] + fresh]
        for template, chains in open_chains.items():
            for chain in chains:
                close(template, chain)
        return sorted(spans)


def scan_licenses(docs: DataFrame, scanner: LicenseScanner | None = None) -> DataFrame:
    """``(doc_id, n_words, phrases, spans)`` of every whole text.

    ``phrases`` are all places of base phrases ``(start, end, label)``, ``spans`` covered
    templates ``(start, end, template, coverage)``, in words from 0. Null text counts as empty.
    Null and repeated ids are kept, other columns ignored; an empty table gives no rows.
    """
    scanner = scanner or LicenseScanner()
    phrase = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))
    span = pa.list_(pa.struct([
        ("start", pa.int64()), ("end", pa.int64()), ("template", pa.string()), ("coverage", pa.float64()),
    ]))

    def run(batch):
        texts = binaries(batch.column(1))
        for part in pieces([len(t) for t in texts]):
            counts, phrases, spans = [], [], []
            for text in texts[part]:
                words = words_of(text)
                found, covered = scanner.scan(words)
                counts.append(len(words))
                phrases.append([dict(zip(("start", "end", "label"), x)) for x in found])
                spans.append([dict(zip(("start", "end", "template", "coverage"), x)) for x in covered])
            yield {
                "doc_id": batch.column(0)[part], "n_words": pa.array(counts, pa.int64()),
                "phrases": pa.array(phrases, phrase), "spans": pa.array(spans, span),
            }

    schema = (
        "doc_id long, n_words long, phrases array<struct<start:long,end:long,label:string>>, "
        "spans array<struct<start:long,end:long,template:string,coverage:double>>"
    )
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_texts(rows, run, schema, "doc_id", "text")


def op1_license_scan(spark, sf: str) -> DataFrame:
    scanned = scan_licenses(table(spark, sf, "documents"))
    base = F.array_sort(F.array_distinct("phrases.label"))
    every = F.array_sort(F.array_union("phrases.label", "spans.template"))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.start").alias("first_word"),
        F.array_max("phrases.start").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(F.coalesce(F.array_max("spans.coverage"), F.lit(0.0))).alias("score"),
    )
