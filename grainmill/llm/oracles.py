"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

from grainmill.llm import quality

#: The white space of words and line ends, as a string literal and as a class.
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"[^\x20\x09-\x0D]+"
_KEY = f"translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP7 = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
lines AS MATERIALIZED (
  SELECT r, doc_id, pos, line, {_KEY} AS k FROM (
    SELECT r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM docs)
), frequent AS (
  SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(f.k)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN frequent f ON lines.k = f.k GROUP BY r, doc_id
"""

OP4 = rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {_SPACES}) <> '') AS l FROM documents
), grams AS (
  SELECT r, unnest(generate_series(1, len(w) - 4)) AS i, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM docs WHERE len(w) >= 5
), again AS (
  SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, generate_series(0, 4) AS s(k) GROUP BY r
), lines AS (
  SELECT r, source, {_KEY} AS k FROM (SELECT r, source, unnest(l) AS line FROM docs)
), common AS (
  SELECT source, k FROM lines GROUP BY source, k HAVING count(DISTINCT r) > {quality.MAX_DOCS_PER_HOST}
), removed AS (
  SELECT r, sum(length(lines.k)) AS total, count(c.k) AS n, coalesce(sum(length(c.k)), 0) AS chars
  FROM lines LEFT JOIN common c ON lines.k = c.k AND lines.source IS NOT DISTINCT FROM c.source GROUP BY r
), judged AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         coalesce(removed.n, 0)::BIGINT AS n_lines_removed,
         coalesce(1 - removed.chars::DOUBLE / removed.total::DOUBLE, 1.0) AS share_left
  FROM docs LEFT JOIN covered USING (r) LEFT JOIN removed USING (r)
)
SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words AS base_failed,
       NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words) AND share_left >= {quality.LEAST_LEFT} AS kept
FROM judged
"""

_BITS = "array_to_string(list_transform(string_split(sha1(p), ''), lambda x: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][strpos('0123456789abcdef', x)]), '')"

OP2 = f"""
WITH own AS (
  SELECT page_id, octet_length(encode(p))::BIGINT AS payload_bytes, {_BITS} AS bits FROM (SELECT page_id, coalesce(html, '') AS p FROM pages)
), named AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', list_sum(list_transform(range(5), lambda k: substr(bits, (i * 5 + k + 1)::BIGINT, 1)::INT * (2 ** (4 - k))::INT))::BIGINT + 1, 1)), '') AS payload_digest FROM own
), firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM named GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM named JOIN firsts USING (payload_digest)
"""

OP10 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings)
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings e JOIN least l ON e.vec_id = l.a LEFT JOIN n ON e.vec_id = n.a
"""

OP1 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [w[1]]
                 ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS inter FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL
), links AS (SELECT a, b FROM shared WHERE 100 * inter >= 80 * (na + nb - inter)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least ON doc_id = a
"""

ORACLES = {"op1_minhash_near_dedup": OP1, "op10_embedding_near_dedup": OP10, "op2_warc_round_trip": OP2, "op4_quality_rules": OP4, "op7_line_dedup": OP7}
