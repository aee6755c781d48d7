"""Queries that apply each operator to its whole table with production settings."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.llm import (
    chunks,
    ctw,
    embeddings,
    encoding,
    extraction,
    jaccard,
    language,
    lines,
    negatives,
    packing,
    parsing,
    quality,
    trie,
)
from gaugeworks.llm.common import table
from gaugeworks.sources.shared import materialise


def op1_hyperdimensional_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


def op2_projection_forest(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_context_tree(spark, sf_dir):
    return ctw.score_documents(table(spark, sf_dir, "documents"))


def op4_line_spread(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.remove_spread_lines(documents, counts=True)


def op5_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_weak_supervision(spark, sf_dir):
    return quality.verdicts(table(spark, sf_dir, "documents"))


def op7_gear_chunks(spark, sf_dir):
    return chunks.repeats(table(spark, sf_dir, "documents"))


def op8_grouped_prefix_join(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op9_bpe_words(spark, sf_dir):
    return encoding.digests(table(spark, sf_dir, "documents"))


def op10_line_blocks(spark, sf_dir):
    return extraction.extract(table(spark, sf_dir, "pages"))


def op11_hilbert_zone_maps(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = negatives.whole_vectors(table(spark, sf_dir, "embeddings"), 256, moved, F.col("vec_id") % 100 == 0)
    return negatives.hard_negatives(vectors)


def op12_prefix_free_parsing(spark, sf_dir):
    return parsing.removal_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_block_trie(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    turns = materialise(trie.numbered_turns(conversations), "turns")
    return trie.prefix_trie(trie.rebuilt(turns), conversations)


QUERIES = {
    name: function for name, function in list(globals().items()) if name.startswith("op")
}

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op4_line_spread": f"""
WITH split AS (
  SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents
), bare AS (
  SELECT doc_id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split
), trimmed AS (
  SELECT *, trim(line, {_WHITE}) AS key FROM bare
), spread AS (
  SELECT key FROM trimmed WHERE key <> '' GROUP BY key HAVING count(DISTINCT source) >= {lines.MIN_SITES}
), marked AS (
  SELECT t.*, s.key IS NOT NULL AS found FROM trimmed t LEFT JOIN spread s USING (key)
), totals AS (
  SELECT doc_id, count(*) FILTER (key <> '') AS n_lines, count(*) FILTER (found) AS n_found,
         string_agg(line, chr(10) ORDER BY place) FILTER (NOT found) AS rest
  FROM marked GROUP BY doc_id
)
SELECT doc_id, source,
       CASE WHEN n_found > 0 AND n_found < n_lines THEN rest ELSE text END AS text,
       coalesce(n_lines, 0) AS n_lines,
       CASE WHEN n_found < n_lines THEN n_found ELSE 0 END AS n_removed
FROM documents LEFT JOIN totals USING (doc_id)""",
    "op8_grouped_prefix_join": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce({_LOWER}, ''), '[\x20\x09-\x0D]+'),
                             lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {jaccard.SHINGLE - 1}], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {jaccard.SHINGLE - 2}, 2))) AS i
        FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.n >= {jaccard.PERCENT} * (x.n + y.n - c.n)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id""",
    "op11_hilbert_zone_maps": """
WITH vectors AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.r, a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS k
  FROM scores WHERE same QUALIFY k <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.r, k ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.r = p.r AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10""",
    "op13_block_trie": f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
  SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id
), families AS (
  SELECT s.conv_id, s.conv_id - s.conv_id % 20 AS base,
         xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(s.conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
               lambda v, b: list_reduce([xor(v, b)] || [0::BIGINT for i in range(8)],
                 lambda a, z: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 4 AS lent
  FROM sizes s
), rebuilt AS (
  SELECT f.conv_id, place, role, text FROM families f JOIN turns t ON t.conv_id = f.base AND place <= lent
  UNION ALL
  SELECT f.conv_id, place - lent + least(lent, coalesce(n, 0)), role, text
  FROM families f JOIN turns t ON t.conv_id = f.conv_id AND place > lent LEFT JOIN sizes b ON b.conv_id = f.base
), paths AS (
  SELECT f.conv_id, list(md5(role) || md5(text) ORDER BY place) FILTER (place IS NOT NULL) AS path,
         list(len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '')) ORDER BY place)
           FILTER (place IS NOT NULL) AS words
  FROM families f LEFT JOIN rebuilt USING (conv_id) GROUP BY f.conv_id
), steps AS (
  SELECT conv_id, d AS depth, array_to_string(path[:d], '') AS node, array_to_string(path[:d - 1], '') AS parent,
         CASE WHEN d = 0 THEN 0 ELSE words[d] END AS words, d = coalesce(len(path), 0) AS ending
  FROM (SELECT *, unnest(range(0, coalesce(len(path), 0) + 1)) AS d FROM paths)
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, any_value(CASE WHEN depth > 0 THEN parent END) AS parent, count(*) AS n_convs,
         (count(*) - 1) * any_value(words) AS repeated,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ending), '')) AS ends_sha256
  FROM steps GROUP BY node, depth
), children AS (
  SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), subtrees AS (
  SELECT s.node, sum(n.repeated) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
  FROM nodes n LEFT JOIN children c USING (node) JOIN steps s ON s.conv_id = n.conv_id AND s.depth <= n.depth GROUP BY s.node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.leaves AS n_leaves,
       s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN children c ON c.node = n.node JOIN subtrees s ON s.node = n.node""",
}
