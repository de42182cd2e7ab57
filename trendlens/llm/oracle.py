"""DuckDB twins of the queries that SQL can express, written out from their contracts."""

from __future__ import annotations

from trendlens.llm.license_scan import TEMPLATES

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS inter
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * inter >= 75 * (p.n + q.n - inter)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

_PHRASES = {"apache": "apache license", "cc-by": "cc by", "gpl": "gnu general public license", "mit": "mit license"}


def _stands(phrase: str) -> str:
    return " AND ".join(f"w[i + {k}] = '{part}'" for k, part in enumerate(phrase.split(), 1))


_PLACES = " UNION ALL ".join(
    f"SELECT doc_id, '{label}' AS label, i FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM words) WHERE {_stands(p)}"
    for label, p in _PHRASES.items())
_TEMPLATE_ROWS = ", ".join(f"('{label}', list_distinct(string_split('{notice}', ' ')))" for label, notice in TEMPLATES)

OP7 = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), places AS ({_PLACES}), base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY doc_id
), templates(label, t) AS (VALUES {_TEMPLATE_ROWS}), blocks AS (
  SELECT doc_id, list_distinct(regexp_extract_all(line, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS b
  FROM (SELECT doc_id, unnest(string_split({_LOWERED}, chr(10))) AS line FROM documents)
), matches AS (
  SELECT doc_id, label, max(len(list_intersect(b, t)) / len(t)) AS containment FROM blocks, templates
  WHERE len(list_intersect(b, t)) >= ceil(0.92 * len(t) - 1e-9) GROUP BY ALL
), best AS (SELECT doc_id, max(containment) AS containment FROM matches GROUP BY doc_id), named AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM matches) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word,
       coalesce(b.base_labels, '') AS base_labels, coalesce(n.labels, '') AS labels,
       CASE WHEN b.n_base > 0 THEN 1.0 ELSE coalesce(c.containment, 0.0) END AS score
FROM words w LEFT JOIN base b USING (doc_id) LEFT JOIN named n USING (doc_id) LEFT JOIN best c USING (doc_id)
"""

# CRC-32, bit by bit (reflected polynomial 0xEDB88320), of the ASCII digits of a number
_BITS = ("flatten(list_transform(string_split(c::VARCHAR, ''), "
         "lambda ch: list_transform(range(8), lambda k: (unicode(ch)::BIGINT >> k) & 1)))")
_CRC32 = (f"xor(list_reduce(list_concat([4294967295::BIGINT], {_BITS}), "
          "lambda crc, bit: xor(crc >> 1, 3988292384 * (xor(crc, bit) & 1))), 4294967295)")

# a path is the hex digests (32 letters each) of its turns
OP11 = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (SELECT c, {_CRC32} % 6 AS h, c - c % 100 AS b FROM (SELECT DISTINCT c FROM turns)), joined AS (
  SELECT v.c, t.p, t.r, t.x FROM convs v JOIN turns t ON t.c = v.b AND t.p < v.h
  UNION ALL SELECT v.c, t.p, t.r, t.x FROM convs v JOIN turns t ON t.c = v.c AND t.p >= v.h
), numbered AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY p) AS d, md5(length(r) || ':' || r || x) AS k, length(x) AS chars
  FROM joined
), paths AS (
  SELECT c, d, chars, string_agg(k, '') OVER (PARTITION BY c ORDER BY d) AS path FROM numbered
  UNION ALL SELECT c, 0, 0, '' FROM convs
), nodes AS (
  SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM paths GROUP BY path, d
), kids AS (
  SELECT path[:32 * (d - 1)] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
), sums AS (
  SELECT path[:32 * k] AS path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM (
    SELECT n.path, unnest(range(n.d + 1)) AS k, CASE WHEN q.path IS NULL THEN 1 ELSE 0 END AS leaf,
           (n.n_convs - 1) * n.chars AS saved FROM nodes n LEFT JOIN kids q USING (path)) GROUP BY 1
), ends AS (
  SELECT path, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
  FROM (SELECT c, arg_max(path, d) AS path FROM paths GROUP BY c) GROUP BY path
)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(q.n_children, 0) AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN sums s USING (path) LEFT JOIN kids q USING (path) LEFT JOIN ends e USING (path)
LEFT JOIN nodes u ON u.d = n.d - 1 AND u.path = n.path[:32 * (n.d - 1)]
"""

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP12 = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT doc_id, i, line, translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE keeper <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE keeper IS NULL OR keeper = doc_id), ''))
         AS kept_sha256
FROM keyed LEFT JOIN repeated USING (k) GROUP BY doc_id
"""

ORACLE: dict[str, str] = {"op6_jaccard_join": OP6, "op7_license_scan": OP7, "op11_prefix_trie": OP11,
                          "op12_line_dedup": OP12}
