"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm.divergence import op12_source_divergence
from linkloom.llm.hamming import op7_embedding_dedup
from linkloom.llm.jaccard import op2_jaccard_join
from linkloom.llm.language import op9_language_id
from linkloom.llm.licenses import op1_license_scan
from linkloom.llm.line_crf import op3_quality_rules
from linkloom.llm.packing import op10_packing
from linkloom.llm.prefix_bpe import op8_prefix_bpe
from linkloom.llm.quality import op4_quality_classifier
from linkloom.llm.substring import op11_substring_dedup
from linkloom.llm.token_file import op5_token_binary
from linkloom.llm.warc import op6_warc
from linkloom.llm.whitening import op13_embedding_whitening

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def llm_queries() -> dict[str, Query]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_jaccard_join": op2_jaccard_join,
        "op3_quality_rules": op3_quality_rules,
        "op4_quality_classifier": op4_quality_classifier,
        "op5_token_binary": lambda s, d: op5_token_binary(s, d, vocabulary_path("byte_bpe_50k.json")),
        "op6_warc": op6_warc,
        "op7_embedding_dedup": op7_embedding_dedup,
        "op8_prefix_bpe": lambda s, d: op8_prefix_bpe(s, d, vocabulary_path("word_bpe_49k.json")),
        "op9_language_id": lambda s, d: op9_language_id(s, d, vocabulary_path("piece_bpe_32k.model")),
        "op10_packing": lambda s, d: op10_packing(s, d, vocabulary_path("byte_bpe_50k.json")),
        "op11_substring_dedup": op11_substring_dedup,
        "op12_source_divergence": op12_source_divergence,
        "op13_embedding_whitening": op13_embedding_whitening,
    }


# Exact cosine links over all pairs, and components by following links to the smallest id.
OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), u AS (
  SELECT vec_id, e FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach(node, seen) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT links.b, reach.seen FROM reach JOIN links ON links.a = reach.node
), least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON node = vec_id
"""

# Every window of 13 words with the smallest document it starts in.
OP11_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT row, doc_id, start, array_to_string(list_slice(words, start, start + 12), ' ') AS words
  FROM (SELECT row, doc_id, words, unnest(generate_series(1, len(words) - 12)) AS start FROM d)
), earlier AS (
  SELECT row, start FROM (SELECT row, start, doc_id, min(doc_id) OVER (PARTITION BY words) AS least FROM windows)
  WHERE least < doc_id OR (doc_id IS NULL AND least IS NOT NULL)
), gone AS (
  SELECT row, list(DISTINCT place) AS places
  FROM (SELECT row, unnest(generate_series(start, start + 12)) AS place FROM earlier) GROUP BY row
)
SELECT doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
  sha256(CASE WHEN places IS NULL THEN array_to_string(words, ' ') ELSE
    array_to_string(list_filter(words, lambda w, i: NOT list_contains(places, i)), ' ') END) AS kept_sha256
FROM d LEFT JOIN gone USING (row)
"""

# Counts by terms, exact shares as huge integers, all pairs of sources of a language.
OP12_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), terms AS (
  SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM terms GROUP BY lang, term HAVING count(DISTINCT row) >= 30
), languages AS (
  SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang
), members AS (SELECT DISTINCT lang, source FROM d), counts AS (
  SELECT m.lang, m.source, k.term, k.lang_n, count(t.term) AS n
  FROM members m JOIN kept k USING (lang) LEFT JOIN terms t ON t.lang = m.lang AND t.source = m.source AND t.term = k.term
  GROUP BY ALL
), totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL), shares AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (lang_n + 5)) // (lang_total + 5 * v)::HUGEINT AS q
  FROM counts JOIN totals USING (lang, source) JOIN languages USING (lang)
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM members a JOIN members b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR rank <= 50
"""


def llm_oracles() -> dict[str, str]:
    """SQL for the queries that DuckDB can express and run on the whole test tables."""
    return {"op7_embedding_dedup": OP7_SQL, "op11_substring_dedup": OP11_SQL, "op12_source_divergence": OP12_SQL}
