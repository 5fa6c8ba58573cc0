"""DuckDB forms of the queries that SQL can express."""

OP2 = r"""
WITH words AS (SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words),
windows AS (SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i:i+4], ' '))) AS s, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM words),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 5) AS r(k) GROUP BY doc_id),
counts AS (
  SELECT words.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: list_contains([{stop}], x)))::BIGINT AS n_stop_words, len(l)::BIGINT AS n_lines
  FROM words JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
based AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * word_chars >= 200 * n_words AND 100 * word_chars <= 1400 * n_words AND 100 * n_symbols <= 20 * n_words
    AND 100 * n_stop_words >= 3 * n_words AND 100 * n_dup_lines <= 40 * n_lines AS kept
FROM based
"""

OP6 = """
WITH hashed AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM hashed WINDOW g AS (PARTITION BY text_sha256)
"""

OP5 = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
places AS (SELECT r, b, unnest(range(0, greatest(octet_length(b) - 199, 0))) AS p FROM docs),
repeated AS (SELECT r, p FROM (SELECT r, p, md5(b[p + 1:p + 200]) AS s FROM places) QUALIFY count(*) OVER (PARTITION BY s) > 1),
marked AS (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 200 THEN 0 ELSE 1 END AS new FROM repeated),
numbered AS (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS g FROM marked),
spans AS (SELECT r, min(p) AS a, max(p) + 200 AS e FROM numbered GROUP BY r, g),
gone AS (SELECT r, sum(e - a) AS n_removed, count(*) AS n_spans, max(e) AS e FROM spans GROUP BY r),
pieces AS (
  SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS e FROM spans
  UNION ALL SELECT r, e, octet_length(b) FROM gone JOIN docs USING (r)),
kept AS (SELECT r, unhex(string_agg(CASE WHEN e > a THEN hex(b[a + 1:e]) ELSE '' END, '' ORDER BY a)) AS k FROM pieces JOIN docs USING (r) GROUP BY r)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(coalesce(k, b)) AS kept_sha256
FROM docs LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""

OP9 = """
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM hashed)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""


def oracle_sql() -> dict[str, str]:
    from .quality_rules import STOP_WORDS

    quoted = ", ".join(f"'{x}'" for x in dict.fromkeys(STOP_WORDS))
    return {"op2_quality_rules": OP2.replace("{stop}", quoted), "op5_suffix_dedup": OP5, "op6_exact_dedup": OP6, "op9_warc": OP9}
