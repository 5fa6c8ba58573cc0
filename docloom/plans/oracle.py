"""DuckDB forms of the registered queries, over views of the input tables."""

from __future__ import annotations

from ..functions.patterns import KEYWORDS
from ..functions.text import PAGE_NUMBER
from ..functions.wordlists import STOPWORDS
from ..operators import headings
from .queries import LEGAL

_LEGAL = f"legal AS (SELECT *, greatest(1, length(text) // 4) AS token_estimate, num % 7 = 0 AS has_tables FROM ({LEGAL.replace('AS STRING', 'AS VARCHAR')}))"
_LINES = """lines AS (
  SELECT doc_id, pos // 40 AS page, pos % 40 AS line_idx, text, CASE WHEN length(text) <= 40 THEN 14 WHEN length(text) <= 80 THEN 12 ELSE 11 END AS size, length(text) <= 30 AS bold, (pos % 40 + 0.5) / 40 AS y
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents))"""
_SIGNATURE = r"regexp_replace(lower(regexp_replace(text, '^\s+|\s+$', '', 'g')), '\d+', '#', 'g')"
_NUMBER = r"regexp_matches(text, '(?i)^\s*(?:page\s*)?[-–—(\[]?\s*(?:\d{1,5}|[ivxlcdm]{1,7})\s*[-–—)\]]?(?:\s*(?:of|/)\s*\d{1,5})?\s*$')"
_REPEATED = f"""pages AS (SELECT doc_id, count(DISTINCT page) AS n_pages FROM lines GROUP BY 1),
edges AS (SELECT DISTINCT doc_id, page, {_SIGNATURE} AS signature FROM lines WHERE (y < 0.1 OR y > 0.9) AND trim(text) <> ''),
repeated AS (SELECT doc_id, signature, count(*) AS pages FROM edges JOIN pages USING (doc_id) GROUP BY doc_id, signature, n_pages HAVING n_pages > 1 AND count(*) >= greatest(2, CAST(floor(n_pages * 0.3) AS BIGINT)))"""
_HEADINGS = "heads AS (SELECT user_id AS doc_id, event_id AS n, length(event_type) % 4 + 1 AS level, event_type AS title, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events)"
_LEVELS = f"""{_HEADINGS}, shifted AS (SELECT *, level - min(level) OVER (PARTITION BY doc_id) + 1 AS a FROM heads),
levels AS (SELECT doc_id, n, title, i, CAST(i + least(0, min(a - i) OVER (PARTITION BY doc_id ORDER BY i)) AS INT) AS level FROM shifted)"""
_STATE = """state AS (SELECT user_id AS doc_id, 'extract' AS stage, event_id % 50 AS unit_id, max_by(CASE event_type WHEN 'view' THEN 'running' WHEN 'error' THEN 'failed' ELSE 'done' END, event_id) AS status,
  CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS attempts FROM events GROUP BY 1, 2, 3)"""
_WORDS = """words AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda w: w <> '') AS w FROM documents),
bench AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda w: w <> '') AS w FROM benchmark)"""
_EDGES = """edges AS (SELECT concat('c', o_custkey) AS from_id, CASE WHEN l_returnflag = 'R' THEN 'distinguishes' ELSE 'cites' END AS relation, concat('s', l_suppkey) AS to_id, o_orderstatus AS basis, l_orderkey * 10 + l_linenumber AS seq
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
last AS (SELECT from_id, relation, to_id, max_by(basis, seq) AS basis FROM edges GROUP BY 1, 2, 3)"""
_TOKENS = """tokens AS (SELECT doc_id, regexp_extract_all(lower(strip_accents(source)), '[\\p{L}\\p{N}]+') AS s, regexp_extract_all(lower(strip_accents(text)), '[\\p{L}\\p{N}]+') AS t FROM documents),
each AS (SELECT doc_id, len(s) + len(t) AS length, len(list_filter(list_concat(s, t), lambda x: x = 'mit')) AS f1, len(list_filter(list_concat(s, t), lambda x: x = 'license')) AS f2 FROM tokens)"""


#: White space, and patterns of Java with its Unicode classes in the words of RE2.
_S = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _re2(pattern: str) -> str:
    spelled = pattern.replace("(?iU)", "(?i)").replace("(?U)", "").replace(r"[\d:.\s", rf"[\p{{Nd}}:.{_S[1:-1]}").replace(r"\s", _S).replace(r"\d", r"\p{Nd}").replace(r"\S", _S.replace("[", "[^", 1))
    return spelled.replace("'", "''")


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_S}+|{_S}+$', '', 'g')"


def _bare(x: str) -> str:
    """A title without its numbering."""
    label = _re2(f"(?iU)^{headings._LABEL}+")
    return f"trim(regexp_replace(lower(regexp_replace(regexp_replace({_strip(x)}, '{label}', ''), '[.:]+$', '')), '{_S}+', ' ', 'g'))"


def _detected_headings() -> str:
    part, page, placeholder = _re2(f"(?iU)^{headings._PART}"), _re2(PAGE_NUMBER), _re2(headings._PLACEHOLDER)
    dotted, named = _re2(r"(?U)^(\d+(?:\.\d+){0,4})\.?\s+\S"), _re2(rf"(?iU)^(?:{headings._PART}|[A-Z]\.\s+\S|[IVXLC]+\.\s+\S)")
    return f"""WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
placed AS (SELECT doc_id, unnest(l) AS text, unnest(range(0, len(l))) AS pos FROM split),
lines AS (SELECT doc_id, CAST(pos // 40 AS INT) AS page, CAST(pos % 40 AS INT) AS line_idx, text, CASE WHEN length(text) <= 40 THEN 14 WHEN length(text) <= 80 THEN 12 ELSE 11 END AS size, length(text) <= 30 AS bold FROM placed),
sizes AS (SELECT doc_id, size AS body, sum(length(text)) AS chars, min(page * 40 + line_idx) AS first FROM lines GROUP BY 1, 2),
bodies AS (SELECT doc_id, body FROM sizes QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY chars DESC, first) = 1),
shares AS (SELECT doc_id, CAST(coalesce(sum(length(text)) FILTER (WHERE bold), 0) AS DOUBLE) / greatest(sum(length(text)), 1) AS bold_share FROM lines GROUP BY 1),
short AS (SELECT *, {_strip('text')} AS own FROM lines WHERE length({_strip('text')}) BETWEEN 1 AND 120),
read AS (SELECT *, {_bare('text')} AS bare, CASE WHEN regexp_matches(own, '{part}') THEN 1 WHEN regexp_extract(own, '{dotted}', 1) <> '' THEN len(string_split(regexp_extract(own, '{dotted}', 1), '.')) WHEN regexp_matches(own, '{named}') THEN 1 END AS depth,
  regexp_replace(text, '\\P{{L}}', '', 'g') AS letters FROM short),
likely AS (SELECT *, size >= body * 0.95e0 AS near FROM read JOIN bodies USING (doc_id) JOIN shares USING (doc_id)
  WHERE len(list_filter(regexp_split_to_array(own, '{_S}+'), lambda w: w <> '')) <= 16 AND regexp_matches(own, '\\p{{L}}') AND NOT regexp_matches(own, '[,;]$') AND NOT regexp_matches(own, '{page}')
    AND NOT regexp_matches(bare || '.', '{placeholder}') AND bare <> '' AND NOT (own[-1] = '.' AND depth IS NULL AND length(own) > 40)),
styled AS (SELECT *, bold AND bold_share < 0.5 AND near AS strong, length(letters) >= 4 AND NOT regexp_matches(letters, '\\P{{Lu}}') AND near AS caps FROM likely),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY doc_id ORDER BY size DESC, strong DESC, caps DESC) AS style FROM styled
  WHERE size >= body * 1.12e0 OR strong AND (depth IS NOT NULL OR length(text) <= 80) OR caps AND depth IS NOT NULL),
levelled AS (SELECT *, least(CASE WHEN max(style) OVER (PARTITION BY doc_id) = 1 AND depth IS NOT NULL THEN depth ELSE style END, 3) AS lv FROM ranked),
marked AS (SELECT *, CASE WHEN lag(page) OVER w = page AND lag(line_idx) OVER w = line_idx - 1 AND lag(lv) OVER w = lv AND depth IS NULL THEN 0 ELSE 1 END AS starts FROM levelled WINDOW w AS (PARTITION BY doc_id ORDER BY page, line_idx)),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY doc_id ORDER BY page, line_idx) AS run FROM marked),
heads AS (SELECT doc_id, run, page, lv, string_agg(own, ' ' ORDER BY line_idx) AS title, max(line_idx) AS line_idx FROM numbered GROUP BY 1, 2, 3, 4),
gaps AS (SELECT *, lv - min(lv) OVER (PARTITION BY doc_id) + 1 - run AS d FROM heads),
flat AS (SELECT *, CAST(run + least(0, min(d) OVER (PARTITION BY doc_id ORDER BY run)) AS INT) AS level FROM gaps),
ups AS (SELECT *, {', '.join(f"last_value(CASE WHEN level = {k} THEN title END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY run) AS t{k}" for k in (1, 2, 3))} FROM flat),
paths AS (SELECT *, list_filter([{', '.join(f'CASE WHEN level >= {k} THEN t{k} END' for k in (1, 2, 3))}], lambda t: t IS NOT NULL) AS p FROM ups)
SELECT doc_id, CAST(run - 1 AS INT) AS n, level, title, page, line_idx, array_to_string(list_filter(p, lambda t, i: i = 1 OR {_bare('t')} <> {_bare('p[i - 1]')}), ' > ') AS path FROM paths"""


_SNIPPETS = f"""WITH {_TOKENS}, own AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\\p{{L}}\\p{{N}}]+') AS w, regexp_split_to_array(coalesce(text, ''), '[\\p{{L}}\\p{{N}}]+') AS gap
  FROM documents JOIN (SELECT doc_id FROM each WHERE f1 > 0 AND f2 > 0) USING (doc_id)),
marked AS (SELECT *, list_transform(w, lambda x: CASE WHEN lower(strip_accents(x)) IN ('mit', 'license') THEN 1 ELSE 0 END) AS hit FROM own),
summed AS (SELECT *, list_transform(range(0, greatest(1, len(w) - 11)), lambda i: coalesce(list_sum(hit[i + 1:i + 12]), 0)) AS sums FROM marked),
best AS (SELECT *, list_position(sums, list_max(sums)) - 1 AS a FROM summed),
ends AS (SELECT *, least(len(w), a + 12) AS b FROM best)
SELECT doc_id, CASE WHEN len(w) = 0 THEN text ELSE concat(CASE WHEN a > 0 THEN ' … ' ELSE '' END,
  array_to_string(list_transform(range(a, b), lambda j: concat(CASE WHEN j = a AND a > 0 THEN '' ELSE gap[j + 1] END, CASE WHEN hit[j + 1] = 1 THEN concat('[', w[j + 1], ']') ELSE w[j + 1] END)), ''),
  CASE WHEN b < len(w) THEN ' … ' ELSE gap[b + 1] END) END AS snippet FROM ends"""


def _count(kind: str) -> str:
    pattern = rf"(?i)\b(?:{KEYWORDS[kind]})\b".replace("'", "''")
    return f"len(regexp_extract_all(text, '{pattern}'))"


def _terms(kind: str) -> str:
    """Identifiers that LEGAL writes into its kinds of sections, by weight."""
    long_ = "num % 31 <> 0"
    return {"CASE": f"CASE WHEN {long_} AND num % 5 = 0 THEN 3 ELSE 0 END", "CONCEPT": f"CASE WHEN {long_} AND num % 5 = 1 THEN 2 ELSE 0 END", "RULE": f"CASE WHEN {long_} AND num % 5 = 2 THEN 4 ELSE 0 END"}.get(kind, "0")


def _raw(kind: str) -> str:
    table = "+ CASE WHEN has_tables THEN 6 ELSE 0 END" if kind == "COMPARISON" else ""
    return f"({3 if kind == 'EXAMPLE' else 1} * {_count(kind)} + {_terms(kind)} {table})"


_KINDS = ("CASE", "CONCEPT", "RULE", "EXAMPLE", "COMPARISON")
_SKIP = """CASE WHEN token_estimate < 40 THEN 'too short' WHEN regexp_matches(title, '(?i)^\\s*index\\s*$') THEN concat('front/back matter (', title, ')') END"""
_CLASSED = f"""scored AS (SELECT section_id, {_SKIP} AS skip_reason, {', '.join(f'round_even({_raw(k)} * 1000.0 / token_estimate, 2) AS s{i}' for i, k in enumerate(_KINDS))} FROM legal),
long AS (SELECT section_id, k, i, s FROM (SELECT section_id, skip_reason, unnest([{', '.join(f"'{k}'" for k in _KINDS)}]) AS k, unnest(range(5)) AS i, unnest([s0, s1, s2, s3, s4]) AS s FROM scored) WHERE s >= 2 AND skip_reason IS NULL),
typed AS (SELECT section_id, string_agg(k, ',' ORDER BY s DESC, i) AS types, max_by(k, s * 10 - i) AS first_type FROM long GROUP BY 1)"""


def _id(prefix: str, *parts: str) -> str:
    return f"concat('{prefix}_', substr(sha256(concat_ws('|', {', '.join(parts)})), 1, 16))"


_LOOSE = lambda x: rf"regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}§]+', '', 'g')"
#: One record for each legal section: items and answers as plans.queries.extracted writes them.
_NAMED = f"CASE kind WHEN 'CASE' THEN concat('CASE:acmev', {_LOOSE('nat')}) WHEN 'CONCEPT' THEN concat('CONCEPT:', {_LOOSE('levy')}) WHEN 'RULE' THEN concat('RULE:', {_LOOSE('levy')}) ELSE concat(kind, ':', doc_id, ':', section_id, ':i1') END"
_BUILT = f"""{_LEGAL}, own AS (SELECT *, ['CASE', 'CONCEPT', 'RULE', 'EXAMPLE', 'COMPARISON'][num % 5 + 1] AS kind, CAST(num % 90 + 1 AS INT) AS page, concat(seg, ' levy') AS levy FROM legal),
built AS (SELECT *, {_id('rec', _NAMED)} AS record_id,
  CASE kind WHEN 'CASE' THEN concat('Acme v. ', nat) END AS case_name, {_id('top', 'lower(nat)')} AS topic_id, {_id('sub', 'lower(nat)', 'lower(seg)')} AS subtopic_id,
  CASE WHEN num % 31 = 0 AND kind = 'CASE' THEN concat('case_name not found in source: ', chr(39), 'Acme v. ', nat, chr(39)) WHEN num % 31 = 0 AND kind = 'RULE' THEN concat('provision not found in source: ', chr(39), 'Section ', num, 'F', chr(39)) ELSE '' END AS fault FROM own)"""


def oracle_sql() -> dict[str, str]:
    stop = ", ".join(f"'{w}'" for w in sorted(STOPWORDS))
    return {
        "content_ids": "SELECT doc_id, concat('doc_', substr(sha256(text), 1, 16)) AS content_id FROM documents",
        "content_duplicates": "SELECT concat('doc_', substr(sha256(text), 1, 16)) AS content_id, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1",
        "token_estimate": "SELECT doc_id, CAST(greatest(1, length(text) // 4) AS INT) AS tokens FROM documents",
        "text_quality_counts": r"SELECT doc_id, CAST(len(w) AS INT) AS words, CAST(len(list_filter(w, lambda x: regexp_matches(x, '\p{L}{2}'))) AS INT) AS lettered FROM (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents)",
        "line_signatures": f"WITH {_LINES} SELECT {_SIGNATURE} AS signature, count(*) AS n FROM lines WHERE text <> '' GROUP BY 1",
        "repeated_edges": f"WITH {_LINES}, {_REPEATED} SELECT * FROM repeated",
        "clean_text_lengths": rf"""WITH {_LINES}, {_REPEATED},
kept AS (SELECT doc_id, page, line_idx, text FROM lines WHERE NOT ((y < 0.1 OR y > 0.9) AND ({_NUMBER} OR (doc_id, {_SIGNATURE}) IN (SELECT (doc_id, signature) FROM repeated)))),
texts AS (SELECT doc_id, page, string_agg(text, chr(10) ORDER BY line_idx) AS t FROM kept GROUP BY 1, 2),
tidy AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '(\p{{Ll}})-\n(\p{{Ll}})', '\1\2', 'g'), '[ \t\x{{a0}}]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS t FROM texts),
after AS (SELECT doc_id, sum(length(t)) AS after FROM tidy GROUP BY 1)
SELECT doc_id, CAST(sum(length(text)) AS BIGINT) AS before, CAST(coalesce(any_value(after), 0) AS BIGINT) AS after FROM lines LEFT JOIN after USING (doc_id) GROUP BY doc_id""",
        "telegraphic_notes": rf"""WITH cut AS (SELECT conv_id, turn, text, list_filter(string_split_regex(text, '\s+'), lambda w: w <> '') AS w FROM conversations),
kept AS (SELECT *, list_filter(w, lambda x: NOT list_contains([{stop}], lower(trim(x, ',.;:()')))) AS k FROM cut)
SELECT conv_id, turn, CASE WHEN len(k) >= 2 THEN array_to_string(k, ' ') ELSE text END AS note FROM kept""",
        "keyword_counts": f"WITH {_LEGAL} SELECT section_id, {', '.join(f'CAST({_count(k)} AS INT) AS {k.lower()}_words' for k in _KINDS)} FROM legal",
        "class_scores": f"WITH {_LEGAL} SELECT section_id, {', '.join(f'CAST(round({_raw(k)} * 100000.0 / token_estimate) AS BIGINT) AS {k.lower()}_x100' for k in _KINDS)} FROM legal",
        "class_types": f"WITH {_LEGAL}, {_CLASSED} SELECT section_id, CASE WHEN skip_reason IS NOT NULL THEN '' ELSE coalesce(types, 'CONCEPT') END AS types, skip_reason IS NULL AND types IS NULL AS unclear FROM scored LEFT JOIN typed USING (section_id)",
        "skip_reasons": f"WITH {_LEGAL} SELECT section_id, {_SKIP} AS skip_reason FROM legal",
        "term_keys": r"""WITH names AS (SELECT DISTINCT unnest([{'kind': 'case_name', 'value': concat('The ', upper(substr(c_mktsegment, 1, 1)), lower(substr(c_mktsegment, 2)), ' Company  vs. ', upper(substr(n_name, 1, 1)),
  CASE WHEN contains(n_name, ' ') THEN concat(lower(substr(string_split(n_name, ' ')[1], 2)), ' ', upper(substr(string_split(n_name, ' ')[2], 1, 1)), lower(substr(string_split(n_name, ' ')[2], 2))) ELSE lower(substr(n_name, 2)) END, ' Private Limited,')},
  {'kind': 'provision', 'value': concat('S. ', c_custkey, '-F')}]) AS t FROM customer JOIN nation ON c_nationkey = n_nationkey),
normal AS (SELECT t.kind AS kind, t.value AS value, CASE t.kind WHEN 'provision' THEN concat('Section ', replace(replace(t.value, 'S. ', ''), '-F', 'F')) ELSE trim(replace(replace(t.value, '  ', ' '), ' vs. ', ' v. '), ' ,;:') END AS normal FROM names)
SELECT *, regexp_replace(regexp_replace(replace(replace(replace(lower(normal), 'limited', 'ltd'), 'company', 'co'), 'private', 'pvt'), '^the\s+', ''), '[^\p{L}\p{N}§]+', '', 'g') AS term_key FROM normal""",
        "body_size": f"WITH {_LINES} SELECT doc_id, CAST(size AS INT) AS body FROM (SELECT doc_id, size, row_number() OVER (PARTITION BY doc_id ORDER BY sum(length(text)) DESC, min(page * 40 + line_idx)) AS r FROM lines GROUP BY doc_id, size) WHERE r = 1",
        "normalised_levels": f"WITH {_LEVELS} SELECT doc_id, n, level FROM levels",
        "parent_heading": f"WITH {_LEVELS} SELECT a.doc_id, a.n, a.level, max(b.n) AS parent_n FROM levels a LEFT JOIN levels b ON a.doc_id = b.doc_id AND b.i < a.i AND b.level < a.level GROUP BY ALL",
        "topic_paths": f"""WITH {_LEVELS}, ups AS (SELECT *, {', '.join(f'last_value(CASE WHEN level = {k} THEN title END IGNORE NULLS) OVER w AS t{k}' for k in range(1, 5))} FROM levels WINDOW w AS (PARTITION BY doc_id ORDER BY i))
SELECT doc_id, n, concat(t1, CASE WHEN level > 1 AND t2 <> t1 THEN concat(' > ', t2) ELSE '' END, CASE WHEN level > 2 AND t3 <> t2 THEN concat(' > ', t3) ELSE '' END, CASE WHEN level > 3 AND t4 <> t3 THEN concat(' > ', t4) ELSE '' END) AS path FROM ups WHERE level <= 4""",
        "block_assignment": rf"""WITH {_LINES}, numbered AS (SELECT *, count(*) FILTER (WHERE bold) OVER (PARTITION BY doc_id ORDER BY page, line_idx) AS block FROM lines)
SELECT doc_id, block, count(*) AS n_lines FROM numbered WHERE NOT bold GROUP BY 1, 2""",
        "page_ranges": """WITH pages AS (SELECT DISTINCT l_partkey AS part, l_linenumber AS p FROM lineitem), runs AS (SELECT part, min(p) AS a, max(p) AS b FROM (SELECT *, p - row_number() OVER (PARTITION BY part ORDER BY p) AS g FROM pages) GROUP BY part, g)
SELECT part, string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE concat(a, '–', b) END, ', ' ORDER BY a) AS ranges FROM runs GROUP BY part""",
        "ngram_containment": f"""WITH {_WORDS}, own AS (SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 6, 1)), lambda i: array_to_string(w[i:i+7], ' '))) AS g FROM words),
known AS (SELECT DISTINCT unnest(list_transform(range(1, greatest(len(w) - 6, 1)), lambda i: array_to_string(w[i:i+7], ' '))) AS g FROM bench),
found AS (SELECT doc_id, count(*) AS total, count(known.g) AS shared FROM own LEFT JOIN known USING (g) GROUP BY 1)
SELECT doc_id, coalesce(total, 0) AS total, coalesce(shared, 0) AS shared FROM documents LEFT JOIN found USING (doc_id)""",
        "longest_shared_run": f"""WITH {_WORDS}, own AS (SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i:i+5], ' '))) AS g, unnest(range(1, greatest(len(w) - 4, 1))) AS i FROM words),
known AS (SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i:i+5], ' '))) AS g, unnest(range(1, greatest(len(w) - 4, 1))) AS j FROM bench),
seeds AS (SELECT doc_id, item_id, j - i AS d, i - row_number() OVER (PARTITION BY doc_id, item_id, j - i ORDER BY i) AS island FROM own JOIN known USING (g)),
runs AS (SELECT doc_id, item_id, count(*) + 5 AS run FROM seeds GROUP BY doc_id, item_id, d, island)
SELECT doc_id, item_id, max(run) AS run FROM runs GROUP BY 1, 2""",
        "interval_merge": """WITH own AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + 60 AS e FROM orders),
marked AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM own),
runs AS (SELECT *, sum(new) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM marked)
SELECT o_custkey, min(s) AS start_day, max(e) AS end_day, count(*) AS parts FROM runs GROUP BY o_custkey, run""",
        "entity_registry": """WITH first AS (SELECT n_name AS entity_id, concat(lower(c_mktsegment), ' code') AS a, min(c_custkey) AS seq FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
SELECT entity_id, min_by(a, seq) AS canonical, CAST(count(*) AS INT) AS n_aliases, string_agg(a, ', ' ORDER BY seq) AS aliases FROM first GROUP BY 1""",
        "relation_dedupe": f"WITH {_EDGES} SELECT * FROM last",
        "relations_of": f"WITH {_EDGES} SELECT * FROM last WHERE from_id = 's7' OR to_id = 's7'",
        "pages_outside_section": "SELECT l_orderkey, concat('evidence e', l_orderkey, ' cites pages outside 1-5') AS error FROM lineitem GROUP BY l_orderkey HAVING max(l_linenumber) > 5 OR min(l_linenumber) < 1",
        "identifier_support": rf"WITH {_LEGAL} SELECT section_id, contains(l, regexp_replace(lower(nat), '[^\p{{L}}\p{{N}}§]+', '', 'g')) AS has_nation, contains(l, concat(lower(seg), 'levy')) AS has_levy FROM (SELECT *, regexp_replace(lower(text), '[^\p{{L}}\p{{N}}§]+', '', 'g') AS l FROM legal)",
        "verdicts": """WITH c AS (SELECT l_discount < 0.1 AND l_tax < 0.08 AND l_quantity > 1 AS sound, l_returnflag <> 'R' AS copy_ok, l_linenumber = 7 AS flagged FROM lineitem)
SELECT CASE WHEN sound AND NOT copy_ok THEN 'REGENERATE' WHEN NOT sound OR flagged THEN 'HUMAN_REVIEW' ELSE 'PASS' END AS first, CASE WHEN NOT sound OR NOT copy_ok OR flagged THEN 'HUMAN_REVIEW' ELSE 'PASS' END AS again, count(*) AS n FROM c GROUP BY 1, 2""",
        "topic_tree_counts": """WITH own AS (SELECT concat('r', n_regionkey) AS r, concat('n', n_nationkey) AS s FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT concat('r', r_regionkey) AS topic_id, r_name AS name, CAST(NULL AS VARCHAR) AS parent_id, (SELECT count(*) FROM own WHERE r = concat('r', r_regionkey)) AS n FROM region
UNION ALL SELECT concat('n', n_nationkey), n_name, concat('r', n_regionkey), (SELECT count(*) FROM own WHERE s = concat('n', n_nationkey)) FROM nation""",
        "upsert_latest": f"WITH {_STATE} SELECT * FROM state",
        "stage_summary": f"WITH {_STATE} SELECT concat('s', unit_id % 4) AS stage, count(*) FILTER (WHERE status = 'running') AS running, count(*) FILTER (WHERE status = 'done') AS done, count(*) FILTER (WHERE status = 'failed') AS failed FROM state GROUP BY 1",
        "recover_interrupted": f"WITH {_STATE} SELECT CASE status WHEN 'running' THEN 'failed' ELSE status END AS status, CASE status WHEN 'running' THEN 'interrupted' ELSE '' END AS error, count(*) AS n FROM state GROUP BY 1, 2",
        "todo_units": f"WITH {_STATE} SELECT doc_id, stage, unit_id FROM state WHERE status <> 'done'",
        "review_pending": "SELECT doc_id AS review_id, source, n_chars AS created_at FROM labels JOIN documents USING (doc_id) WHERE quality = 0 OR toxic = 1",
        "merged_library": """WITH last AS (SELECT o_custkey, max_by(o_orderpriority, o_orderkey) AS priority, max_by(o_totalprice, o_orderkey) AS amount FROM orders GROUP BY 1)
SELECT coalesce(c_custkey, o_custkey) AS c_custkey, c_name, CASE WHEN c_custkey IS NULL THEN amount ELSE c_acctbal END AS amount, priority FROM customer FULL JOIN last ON c_custkey = o_custkey""",
        "keyword_and": f"WITH {_TOKENS} SELECT doc_id FROM each WHERE f1 > 0 AND f2 > 0",
        "bm25_top": f"""WITH {_TOKENS}, n AS (SELECT count(*) AS n, avg(length) AS mean, count(*) FILTER (WHERE f1 > 0) AS d1, count(*) FILTER (WHERE f2 > 0) AS d2 FROM each),
idf AS (SELECT *, ln((n - d1 + 0.5) / (d1 + 0.5)) AS i1, ln((n - d2 + 0.5) / (d2 + 0.5)) AS i2 FROM n),
scored AS (SELECT doc_id, -((CASE WHEN i1 > 0 THEN i1 ELSE 1e-6 END) * f1 * 2.2 / (f1 + 1.2 * (0.25 + 0.75 * length / mean)) + (CASE WHEN i2 > 0 THEN i2 ELSE 1e-6 END) * f2 * 2.2 / (f2 + 1.2 * (0.25 + 0.75 * length / mean))) AS s FROM each, idf WHERE f1 > 0 AND f2 > 0)
SELECT doc_id, round(s, 6) AS score FROM scored ORDER BY s, doc_id LIMIT 20""",
        "vector_topk": "WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 7) SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(e AS DOUBLE[])), 5) AS score FROM embeddings, q ORDER BY list_dot_product(CAST(embedding AS DOUBLE[]), CAST(e AS DOUBLE[])) DESC, vec_id LIMIT 10",
        "search_snippets": _SNIPPETS,
        "detected_headings": _detected_headings(),
        "vector_topk_each": """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL),
scored AS (SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(v.e, q.e) AS s FROM v, (SELECT * FROM v WHERE vec_id % 20 = 0) AS q)
SELECT query_id, vec_id, round(s, 5) AS score FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) <= 10""",
        "usage_cost": """WITH u AS (SELECT event_type AS model, count(*) AS calls, CAST(sum(user_id) AS BIGINT) AS input_tokens, CAST(sum(event_id % 100) AS BIGINT) AS output_tokens, CAST(sum(event_id % 7) AS BIGINT) AS cache_read_tokens, CAST(sum(event_id % 3) AS BIGINT) AS cache_write_tokens FROM events GROUP BY 1),
p AS (SELECT * FROM (VALUES ('view', 4.0, 20.0), ('click', 2.0, 10.0), ('error', 1.0, 5.0)) AS t(model, i, o))
SELECT u.*, round((input_tokens * CAST(coalesce(i, 0) AS DOUBLE) + cache_read_tokens * CAST(coalesce(i, 0) AS DOUBLE) * CAST(0.1 AS DOUBLE) + cache_write_tokens * CAST(coalesce(i, 0) AS DOUBLE) * CAST(1.25 AS DOUBLE) + output_tokens * CAST(coalesce(o, 0) AS DOUBLE)) / 1e6, 4) AS cost FROM u LEFT JOIN p USING (model)""",
        "cost_estimate": f"""WITH {_LEGAL}, t AS (SELECT count(*) AS n, CAST(coalesce(sum(token_estimate), 0) AS BIGINT) AS tokens FROM legal WHERE {_SKIP} IS NULL)
SELECT n, tokens, {', '.join(f"round(((tokens + 2500 * n) * 2e0 + tokens * {s}e0 * {k}e0 * 10e0 + (tokens * {s}e0 + 2500 * n) * 4e0 + tokens * {s}e0 * {k}e0 * 20e0) / 1e6, 2) AS {name}" for name, s, k in (('low', 0.25, 1.2), ('high', 0.6, 2.0)))} FROM t""",
        "run_totals": "SELECT count(*) AS documents, count(*) AS sections, CAST(sum(length(o_orderpriority)) AS BIGINT) AS skipped, CAST(sum(o_orderkey % 5) AS BIGINT) AS stored FROM orders",
        "export_sources": """WITH spans AS (SELECT l_orderkey AS record_id, l_partkey AS doc, min(l_linenumber) AS a, max(l_linenumber) AS b FROM lineitem GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY a, doc) AS r, count(*) OVER (PARTITION BY record_id) AS n FROM spans)
SELECT record_id, doc AS first_doc, coalesce(p_name, '') AS first_file, a AS page_start, b AS page_end, CAST(n - 1 AS INT) AS n_more FROM ranked LEFT JOIN part ON doc = p_partkey WHERE r = 1""",
        "legal_terms": f"""WITH {_LEGAL}, long AS (SELECT * FROM legal WHERE num % 31 <> 0),
found AS (SELECT section_id, 'case_name' AS kind, concat('Acme v. ', nat) AS value, 3 AS place FROM long WHERE num % 5 = 0 UNION ALL SELECT section_id, 'date', '12 March 1999', strpos(text, '12 March 1999') - 1 FROM long WHERE num % 5 = 0
  UNION ALL SELECT section_id, 'defined_term', concat(lower(seg), ' levy'), 1 FROM long WHERE num % 5 = 1
  UNION ALL SELECT section_id, 'provision', concat('Section ', num, 'F'), 6 FROM long WHERE num % 5 = 2 UNION ALL SELECT section_id, 'provision', 'Rule 7', strpos(text, 'Rule 7') - 1 FROM long WHERE num % 5 = 2)
SELECT section_id, kind, value, CAST(place AS INT) AS "start", CAST(place + length(value) AS INT) AS "end" FROM found""",
        "protected_terms": f"""WITH {_LEGAL}, long AS (SELECT * FROM legal WHERE num % 31 <> 0),
found AS (SELECT section_id, 'case_name' AS kind, concat('Acme v. ', nat) AS display FROM long WHERE num % 5 = 0 UNION ALL SELECT section_id, 'date', '12 March 1999' FROM long WHERE num % 5 = 0
  UNION ALL SELECT section_id, 'defined_term', concat(lower(seg), ' levy') FROM long WHERE num % 5 = 1 UNION ALL SELECT section_id, 'provision', concat('Section ', num, 'F') FROM long WHERE num % 5 = 2 UNION ALL SELECT section_id, 'provision', 'Rule 7' FROM long WHERE num % 5 = 2)
SELECT section_id, kind, {_LOOSE('display')} AS term_key, count(*) AS mentions, min(display) AS display FROM found GROUP BY 1, 2, 3""",
        "heading_texts": r"""WITH own AS (SELECT p_partkey, p_partkey % 5 AS k, p_partkey AS n, p_type, concat(CASE p_partkey % 5 WHEN 0 THEN concat(p_partkey % 9 + 1, ' ') WHEN 1 THEN concat(p_partkey % 9 + 1, '.', p_partkey % 5 + 1, ' ') WHEN 2 THEN concat('Chapter ', p_partkey % 20 + 1, ': ') WHEN 3 THEN '(a) ' ELSE '' END, p_type, CASE WHEN p_partkey % 7 = 0 THEN ',' ELSE '' END) AS title FROM part)
SELECT p_partkey, concat(CASE k WHEN 0 THEN concat(n % 9 + 1, ' ') WHEN 1 THEN concat(n % 5 + 1, ' ') ELSE '' END, lower(p_type), CASE WHEN n % 7 = 0 THEN ',' ELSE '' END) AS bare, CAST(CASE k WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 1 END AS INT) AS depth, n % 7 <> 0 AS heading,
  k <> 2 AND k <> 3 AND length(regexp_replace(title, '\P{L}', '', 'g')) >= 4 AND NOT regexp_matches(title, '\p{Ll}') AS caps FROM own""",
        "bookmark_headings": "SELECT p_brand AS doc_id, p_partkey AS page, CAST(least(p_size % 5, 3) AS INT) AS level, p_name AS title, CAST(CASE WHEN p_size % 2 = 0 THEN 2 ELSE 0 END AS INT) AS line_idx FROM part WHERE p_partkey >= 1",
        "built_records": f"""WITH {_BUILT} SELECT record_id, kind AS record_type, section_id, case_name, CAST(CASE kind WHEN 'COMPARISON' THEN 1 ELSE 2 END AS INT) AS n_statements, 2 AS n_evidence, topic_id, subtopic_id FROM built""",
        "validated_records": f"WITH {_BUILT} SELECT record_id, section_id, CASE WHEN fault = '' THEN 'PASS' ELSE 'HUMAN_REVIEW' END AS status, fault AS reasons, CAST(0 AS DOUBLE) AS similarity FROM built",
        "statements_check": f"WITH {_LEGAL} SELECT section_id, '' AS errors FROM legal",
        "merged_records": f"""WITH {_BUILT} SELECT record_id, min(kind) AS record_type, count(*) AS n_merged, CAST(CASE min(kind) WHEN 'CASE' THEN 1 + count(DISTINCT seg) WHEN 'COMPARISON' THEN 1 ELSE 2 END AS INT) AS n_statements, CAST(2 * count(*) AS INT) AS n_evidence FROM built GROUP BY record_id""",
        "record_relations": f"""WITH {_BUILT}, edges AS (SELECT record_id AS from_id, 'part_of' AS relation, subtopic_id AS to_id FROM built UNION ALL SELECT subtopic_id, 'part_of', topic_id FROM built
  UNION ALL SELECT record_id, 'defines', {_id('ent', "'PROVISION'", "concat('section', num, 'f')")} FROM built WHERE kind = 'RULE' UNION ALL SELECT record_id, 'illustrates', {_id('rec', f"concat('CONCEPT:', {_LOOSE('levy')})")} FROM built WHERE kind = 'EXAMPLE')
SELECT DISTINCT from_id, relation, to_id, 'source' AS basis FROM edges""",
        "broken_evidence": f"""WITH {_BUILT} SELECT record_id, section_id, 1 AS pos, concat(section_id, ':f2') AS evidence FROM built WHERE num % 7 = 0 AND kind IN ('CASE', 'CONCEPT', 'RULE')""",
        "export_overview": f"""WITH {_BUILT} SELECT record_id, kind AS type, CASE kind WHEN 'CASE' THEN case_name ELSE levy END AS title, nat AS topic, seg AS subtopic, doc_id AS documents, CAST(page AS VARCHAR) AS pages, false AS proprietary, kind = 'RULE' AS needs_review FROM built""",
        "merged_knowledge": f"""WITH {_BUILT} SELECT record_id, min(kind) AS content_type, 'PASS' AS status, CAST(count(DISTINCT doc_id) AS INT) AS n_sources FROM built GROUP BY record_id""",
        "knowledge_export": f"""WITH {_BUILT}, texts AS (SELECT *, concat('"Claims fail in ', nat, '"') AS a, concat('"A charge that ', seg, ' firms pay"') AS b FROM built),
json AS (SELECT *, CASE kind WHEN 'CASE' THEN concat('{{"case_name":"', case_name, '","citation":"","court":"","year":"12 M","parties":[],"material_facts":[],"legal_issue":[],"relevant_law":[],"decision":"","legal_principles":[', a, ',', b, '],"important_factors":[]}}')
  WHEN 'CONCEPT' THEN concat('{{"concept_name":"', levy, '","definition":', b, ',"key_points":[', a, '],"important_factors":[]}}')
  WHEN 'RULE' THEN concat('{{"rule_name":"', levy, '","relevant_provision":["Section ', num, 'F"],"requirements":[', a, ',', b, '],"conditions":[],"exceptions":[],"quoted_provision":""}}')
  WHEN 'EXAMPLE' THEN concat('{{"scenario":"', levy, '","concept_illustrated":["', levy, '"],"important_facts":[', a, '],"result":""}}')
  ELSE concat('{{"title":"', levy, '","compared":["Early","(unspecified)"],"aspects":["pay"],"comparison":[{{"subject":"Early","aspect":"pay","value":"none"}}],"key_differences":[', a, ']}}') END AS knowledge FROM texts),
files AS (SELECT record_id, doc_id AS document, min(page) AS page_start, row_number() OVER (PARTITION BY record_id ORDER BY doc_id) AS r FROM built GROUP BY 1, 2)
SELECT record_id, kind AS content_type, CASE kind WHEN 'CASE' THEN case_name ELSE levy END AS title, nat AS topic, seg AS subtopic, knowledge, document, page_start, CASE WHEN fault = '' THEN '' ELSE 'approved by reviewer' END AS reason FROM json JOIN files USING (record_id) WHERE r = 1""",
        "contents": """WITH own AS (SELECT p_brand AS topic, CASE WHEN p_size % 3 <> 0 THEN p_type END AS subtopic FROM part)
SELECT topic, NULL AS subtopic, count(*) AS n FROM own GROUP BY 1 UNION ALL SELECT topic, subtopic, count(*) FROM own WHERE subtopic IS NOT NULL GROUP BY 1, 2""",
        "small_functions": """SELECT p_partkey, trim(regexp_replace(p_name, '\\s+', ' ', 'g')) AS title, concat('f-', p_partkey) AS note, CASE WHEN p_partkey % 2 = 0 THEN 'year' ELSE 'day' END AS precision, concat('[[p. ', p_partkey, ']]') AS marker,
  concat('| ', p_name, ' |  |', chr(10), '| ', p_brand, ' | ', p_type, ' |') AS "table", round_even(len(list_filter(string_split_regex(p_name, '\\s+'), lambda w: regexp_matches(w, '\\p{L}{2}'))) * 1.0 / (len(string_split_regex(p_name, '\\s+')) + 2), 3) AS quality,
  p_size > 30 AS scan, CAST(least((p_size + 30) / 64.0, 1) AS DOUBLE) AS images FROM part""",
        "table_cells": """SELECT table_id, CAST(t.r AS INT) AS r, CAST(t.c AS INT) AS c, t.s AS subject, t.a AS attribute, t.v AS value FROM (SELECT n_nationkey AS table_id, unnest([{'r': 1, 'c': 1, 's': n_name, 'a': 'key', 'v': CAST(n_nationkey AS VARCHAR)}, {'r': 2, 'c': 1, 's': n_name, 'a': 'region', 'v': CAST(n_regionkey AS VARCHAR)}, {'r': 2, 'c': 2, 's': 'All', 'a': 'region', 'v': '9'}]) AS t FROM nation)""",
        "entity_ids": f"""WITH own AS (SELECT c_custkey, unnest(['CASE', 'STATUTE', 'PROVISION', 'COURT']) AS entity_type, c_name FROM customer)
SELECT c_custkey, entity_type, {_id('ent', 'entity_type', f"concat(CASE entity_type WHEN 'PROVISION' THEN 'the' ELSE '' END, {_LOOSE('c_name')}, 'act')")} AS entity_id FROM own""",
        "law_entities": f"WITH {_BUILT} SELECT section_id, concat('Section ', num, 'F') AS provision, {_id('ent', "'PROVISION'", "concat('section', num, 'f')")} AS entity_id FROM built WHERE kind = 'RULE'",
        "record_topics": f"WITH {_BUILT} SELECT DISTINCT topic_id, nat AS name, NULL AS parent_id FROM built UNION SELECT DISTINCT subtopic_id, seg, topic_id FROM built",
        "record_counts": f"WITH {_BUILT} SELECT kind AS record_type, count(*) AS n FROM built GROUP BY 1",
        "record_evidence": f"WITH {_BUILT} SELECT record_id, concat(section_id, ':', f) AS evidence_id, doc_id, page AS page_start, page AS page_end FROM (SELECT *, unnest(['f1', 'f2']) AS f FROM built)",
        "requests": f"""WITH {_BUILT} SELECT section_id, CAST(length(concat_ws(chr(10), concat('Document section: ', title), concat('Topic path: ', nat, ' > ', seg), concat('Pages: ', page, '-', page + 1), concat('Likely content types (by keywords, may be incomplete): ', seg), 'Identifiers found in this section (to be kept exactly):', '- (none detected)', concat('<section_text>', chr(10), text, chr(10), '</section_text>'))) AS INT) AS n,
  concat('- [f1] (fact, explicit) claims fail in ', nat, ' - [f2] (fact, explicit) ', seg, ' firms pay a charge') AS notes FROM built""",
        "stage_cycle": "SELECT CAST(o_custkey AS VARCHAR) AS doc_id, CAST(o_orderkey AS VARCHAR) AS unit_id, CASE WHEN o_orderkey % 5 = 0 THEN 'failed' ELSE 'done' END AS status, CAST(1 + CAST(o_orderkey % 3 = 0 AS INT) AS INT) AS attempts, CASE WHEN o_orderkey % 5 = 0 THEN concat('e', o_orderkey) END AS error, CASE WHEN o_orderkey % 2 = 0 THEN 'out' END AS output_path FROM orders WHERE o_custkey <> 7",
        "stage_failures": "SELECT CAST(o_custkey AS VARCHAR) AS doc_id, CAST(o_orderkey AS VARCHAR) AS unit_id, concat('e', o_orderkey) AS error FROM orders WHERE o_orderkey % 5 = 0",
        "documents_by_status": "SELECT doc_id, 'failed' AS status FROM documents WHERE n_chars <= 1000 AND doc_id % 10 <> 0",
        "phrase_search": """WITH own AS (SELECT conv_id * 1000 + turn AS id, regexp_extract_all(lower(strip_accents(role)), '[\\p{L}\\p{N}]+') AS r, regexp_extract_all(lower(strip_accents(text)), '[\\p{L}\\p{N}]+') AS t FROM conversations),
each AS (SELECT id, len(r) + len(t) AS length, len(list_filter(list_concat(r, t), lambda x: x = 'user')) AS f1, len(list_filter(range(1, greatest(len(t), 1)), lambda i: t[i] = 'the' AND t[i + 1] = 'of')) + len(list_filter(range(1, greatest(len(r), 1)), lambda i: r[i] = 'the' AND r[i + 1] = 'of')) AS f2 FROM own),
n AS (SELECT count(*) AS n, avg(length) AS mean, count(*) FILTER (WHERE f1 > 0) AS d1, count(*) FILTER (WHERE f2 > 0) AS d2 FROM each), idf AS (SELECT *, ln((n - d1 + 0.5) / (d1 + 0.5)) AS i1, ln((n - d2 + 0.5) / (d2 + 0.5)) AS i2 FROM n)
SELECT id, round(-((CASE WHEN i1 > 0 THEN i1 ELSE 1e-6 END) * f1 * 2.2 / (f1 + 1.2 * (0.25 + 0.75 * length / mean)) + (CASE WHEN i2 > 0 THEN i2 ELSE 1e-6 END) * f2 * 2.2 / (f2 + 1.2 * (0.25 + 0.75 * length / mean))), 6) AS score FROM each, idf WHERE f1 > 0 AND f2 > 0""",
    }
