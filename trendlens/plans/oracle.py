"""DuckDB SQL twins of the named queries (same column names, same rules).

Tables are the pre-registered views over the test parquet files.  Shared
pieces (stop list, hashing, tokenising, scoring) are SQL fragments written
from the same fixed values and rules the Spark side documents.
"""

from __future__ import annotations

from trendlens.operators import search as S
from trendlens.plans import queries as Q
from trendlens.sources.stopwords import ENGLISH_STOP_WORDS


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STOP_LIST = "[" + ", ".join(_quote(w) for w in ENGLISH_STOP_WORDS) + "]"
ANALYZER = r"'[^\p{L}\p{N}]+'"


def h1(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 8))::UBIGINT::BIGINT"


def h2(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 9, 8))::UBIGINT::BIGINT"


def analyze(expr: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({expr}), {ANALYZER}), lambda t: t <> '')"


def java_hash_text(expr: str) -> str:
    """32-bit x31 string hash over UTF-16 units (BMP text), as a signed decimal string."""
    h = (f"(CASE WHEN length({expr}) = 0 THEN 0 ELSE list_reduce(list_transform(string_split({expr}, ''), "
         f"lambda c: unicode(c)::BIGINT), lambda a, x: (a * 31 + x) % 4294967296) END)")
    return f"(CASE WHEN {h} >= 2147483648 THEN {h} - 4294967296 ELSE {h} END)::VARCHAR"


def md5_utf16le(expr: str) -> str:
    """md5 hex of the UTF-16LE code units of a (BMP) string."""
    return (f"md5(array_to_string(list_transform(string_split({expr}, ''), "
            rf"lambda c: printf('\x%02X\x%02X', unicode(c) % 256, unicode(c) // 256)), '')::BLOB)")


DOC_WORDS = "SELECT w FROM (SELECT unnest(string_split(lower(text), ' ')) AS w FROM documents) WHERE w <> ''"
KEPT_WORDS = f"SELECT w FROM ({DOC_WORDS}) WHERE w NOT IN (SELECT unnest({STOP_LIST}))"


def sketch_cte(words_sql: str, p, name: str = "cells") -> str:
    """CTEs ``wc`` (word counts) and ``{name}`` (sketch cells) over a one-column ``w`` query."""
    return f"""
    wc AS (SELECT w, count(*) AS n FROM ({words_sql}) WHERE w IS NOT NULL GROUP BY w),
    wh AS (SELECT w, n, {h1('w::VARCHAR')} AS h1, {h2('w::VARCHAR')} AS h2 FROM wc),
    {name} AS (
        SELECT r::INTEGER AS row, (h1 + r * h2) % {p.width} AS bucket, sum(n)::BIGINT AS cnt
        FROM wh, range({p.depth}) t(r) GROUP BY 1, 2)
    """


def estimate_sql(items_sql: str, p, cells: str = "cells") -> str:
    """Estimates of the distinct values ``w`` of ``items_sql`` against ``cells``."""
    return f"""
    SELECT i.w, min(coalesce(c.cnt, 0))::BIGINT AS estimate
    FROM (SELECT w, {h1('w::VARCHAR')} AS h1, {h2('w::VARCHAR')} AS h2
          FROM (SELECT DISTINCT w FROM ({items_sql}) WHERE w IS NOT NULL)) i
    CROSS JOIN range({p.depth}) t(r)
    LEFT JOIN {cells} c ON c.row = t.r AND c.bucket = (i.h1 + t.r * i.h2) % {p.width}
    GROUP BY i.w
    """


TOPK_EXACT = f"""
    SELECT w AS word, count(*) AS count FROM ({KEPT_WORDS})
    GROUP BY w ORDER BY count DESC, word ASC LIMIT {Q.TOP_K}
"""

CMS_CELLS = f"WITH {sketch_cte(KEPT_WORDS, Q.TOPK_PARAMS)} SELECT row, bucket, cnt FROM cells"


# 500 items at 1 %: floor(500 * ln(100) / ln(2)^2) bits and round(bits / 500 * ln 2) probes
BLOOM_BITS, BLOOM_PROBES = 4792, 7


def _bloom_sql() -> str:
    """Every word is hashed once; a word is dropped when all its positions are set."""
    return f"""
    WITH stop AS MATERIALIZED (
        SELECT w, {h1('w')} AS a, {h2('w')} AS b FROM (SELECT DISTINCT lower(unnest({STOP_LIST})) AS w)),
    bits AS MATERIALIZED (SELECT list(DISTINCT (a + i * b) % {BLOOM_BITS}) AS l FROM stop, range({BLOOM_PROBES}) t(i)),
    wc AS MATERIALIZED (
        SELECT w, n, {h1('w')} AS a, {h2('w')} AS b FROM (SELECT w, count(*) AS n FROM ({DOC_WORDS}) GROUP BY w)),
    hit AS MATERIALIZED (
        SELECT w, count(*) AS hits FROM (SELECT w, (a + i * b) % {BLOOM_BITS} AS pos FROM wc, range({BLOOM_PROBES}) t(i))
        WHERE pos IN (SELECT unnest(l) FROM bits) GROUP BY w)
    SELECT wc.w AS word, wc.n AS count FROM wc LEFT JOIN hit USING (w) WHERE coalesce(hits, 0) < {BLOOM_PROBES}
    """


# -- counted store and search ----------------------------------------------------

def store_cte() -> str:
    return f"""
    store AS (
        SELECT 'my_index' AS "index", 'my_type' AS "type", id, min(s) AS text, count(*) AS count
        FROM (SELECT lower(text) AS s, {java_hash_text('lower(text)')} AS id FROM documents WHERE text IS NOT NULL)
        GROUP BY id),
    toks AS (
        SELECT "index", "type", id, len(arr) AS dl, unnest(arr) AS term
        FROM (SELECT "index", "type", id, {analyze('text')} AS arr FROM store)),
    nd AS (SELECT count(*) AS n FROM store)
    """


def _term_scores(pred: str, boost: float) -> str:
    idf = "(1 + ln((SELECT n FROM nd) / (d.df + 1)))"
    return f"""
    SELECT "index", "type", id, sum(s) AS score FROM (
        SELECT t."index", t."type", t.id,
               sqrt(t.tf) * {idf} * {idf} / sqrt(t.dl) * {float(boost)} AS s
        FROM (SELECT "index", "type", id, dl, term, count(*) AS tf FROM toks WHERE {pred} GROUP BY ALL) t
        JOIN (SELECT term, count(*) AS df
              FROM (SELECT DISTINCT "index", "type", id, term FROM toks WHERE {pred}) GROUP BY term) d
        USING (term))
    GROUP BY ALL
    """


def _constant(pred: str | None, boost: float) -> str:
    if pred is None:
        return f'SELECT "index", "type", id, {float(boost)} AS score FROM store'
    return f"""SELECT "index", "type", id, {float(boost)} AS score FROM store
               WHERE ("index", "type", id) IN (SELECT "index", "type", id FROM toks WHERE {pred})"""


def scored_sql(q) -> str:
    """``index, type, id, score`` of every document matching ``q`` (mirrors the Spark contract)."""
    if isinstance(q, S.Term):
        return _term_scores(f"term = {_quote(q.value)}", q.boost)
    if isinstance(q, S.MultiMatch):
        return _term_scores(f"list_contains({analyze(_quote(q.text))}, term)", q.boost)
    if isinstance(q, S.Fuzzy):
        n = len(q.value)     # edits allowed by length unless the query names them
        edits = q.fuzziness if q.fuzziness is not None else 0 if n <= 2 else 1 if n <= 5 else 2
        pred = f"levenshtein(term, {_quote(q.value)}) <= {edits}"
        if q.prefix_length:
            pred += f" AND starts_with(term, {_quote(q.value[:q.prefix_length])})"
        return _term_scores(pred, q.boost)
    if isinstance(q, S.MatchAll):
        return _constant(None, q.boost)
    if isinstance(q, S.Prefix):
        return _constant(f"starts_with(term, {_quote(q.value)})", q.boost)
    if isinstance(q, S.Wildcard):
        # a glob as a whole-term regular expression: ? one character, * any run
        rule = "".join({"?": ".", "*": ".*"}.get(c, f"\\x{{{ord(c):x}}}") for c in q.pattern)
        return _constant(f"regexp_full_match(term, {_quote(rule)}, 's')", q.boost)
    if isinstance(q, S.Bool):
        must = [scored_sql(c) for c in q.must]
        should = [scored_sql(c) for c in q.should]
        if not must:
            any_of = " UNION ALL ".join(should) if should else _constant(None, 1.0)
            sql = f'SELECT "index", "type", id, sum(score) AS score FROM ({any_of}) GROUP BY ALL'
        else:
            sql = must[0]
        for other in must[1:]:
            sql = f"""SELECT a."index", a."type", a.id, a.score + b.score AS score
                      FROM ({sql}) a JOIN ({other}) b USING ("index", "type", id)"""
        for c in should if must else []:
            sql = f"""SELECT a."index", a."type", a.id, a.score + coalesce(b.score, 0) AS score
                      FROM ({sql}) a LEFT JOIN ({c}) b USING ("index", "type", id)"""
        for c in q.must_not:
            sql = f"""SELECT * FROM ({sql}) WHERE ("index", "type", id) NOT IN
                      (SELECT "index", "type", id FROM ({scored_sql(c)}))"""
        return sql
    if isinstance(q, S.Boosting):
        return f"""
        SELECT p."index", p."type", p.id,
               p.score * CASE WHEN n.id IS NOT NULL THEN {float(q.negative_boost)} ELSE 1.0 END AS score
        FROM ({scored_sql(q.positive)}) p LEFT JOIN ({scored_sql(q.negative)}) n USING ("index", "type", id)
        """
    raise TypeError(q)


def top_sql(q, size: int) -> str:
    return f"SELECT * FROM ({hits_sql(q)}) ORDER BY score DESC, id LIMIT {size}"


def hits_sql(q) -> str:
    return f"""
    WITH {store_cte()}
    SELECT s."index", s."type", s.id, s.text, s.count, round(h.score, 6) AS score,
           to_json({{'text': s.text, 'count': s.count}}) AS json
    FROM store s JOIN ({scored_sql(q)}) h USING ("index", "type", id)
    """


# -- entities ---------------------------------------------------------------------

def _entities(rows_sql: str) -> str:
    """``rows_sql`` yields (tweet_id, content_type, content_name); adds the content id."""
    return f"""
    SELECT tweet_id, content_type, content_name,
           {md5_utf16le("content_type || coalesce(content_name, 'null')")} AS content_id
    FROM (SELECT DISTINCT tweet_id, content_type, content_name FROM ({rows_sql}))
    """


ORACLE: dict[str, str] = {
    "topk_words_exact": TOPK_EXACT,
    "topk_words_cms": f"""
        WITH {sketch_cte(KEPT_WORDS, Q.TOPK_PARAMS)}
        SELECT w AS word, estimate FROM ({estimate_sql('SELECT w FROM wc', Q.TOPK_PARAMS)})
        ORDER BY estimate DESC, word ASC LIMIT {Q.TOP_K}
    """,
    "topk_string": f"""
        SELECT coalesce(string_agg(word || ':' || count || '|', '' ORDER BY count DESC, word ASC), '') AS topk
        FROM ({TOPK_EXACT})
    """,
    "word_count_lookup": f"""
        WITH {sketch_cte(KEPT_WORDS, Q.COUNT_PARAMS)},
        req AS (SELECT unnest(string_split({_quote(Q.LOOKUP_REQUEST)}, ' ')) AS query),
        est AS ({estimate_sql('SELECT query AS w FROM req', Q.COUNT_PARAMS)})
        SELECT r.query,
               (CASE WHEN lower(r.query) IN (SELECT unnest({STOP_LIST})) THEN 0
                     ELSE coalesce(e.estimate, 0) END)::BIGINT AS count
        FROM req r LEFT JOIN est e ON e.w = r.query
    """,
    "cms_table": CMS_CELLS,
    "cms_merge": CMS_CELLS,
    "cms_total": f"SELECT count(*)::BIGINT AS total FROM ({KEPT_WORDS})",
    "cms_long_items": f"""
        WITH {sketch_cte('SELECT l_partkey AS w FROM lineitem', Q.TOPK_PARAMS)}
        SELECT w AS l_partkey, estimate
        FROM ({estimate_sql('SELECT l_partkey AS w FROM lineitem', Q.TOPK_PARAMS)})
    """,
    "bloom_stopword_filter": _bloom_sql(),
    "track_filter": f"""
        SELECT doc_id AS id, lang FROM (SELECT doc_id, lang, {analyze('text')} AS tk FROM documents)
        WHERE lang = 'en' AND (
            list_has_any(tk, {analyze(_quote(' '.join(k for k in Q.TRACK_KEYWORDS if len(k.split()) == 1)))})
            {''.join(f" OR len(list_filter({analyze(_quote(k))}, lambda x: NOT list_contains(tk, x))) = 0"
                     for k in Q.TRACK_KEYWORDS if len(k.split()) > 1)})
    """,
    "split_keep_empty": f"""
        SELECT doc_id, unnest(range(len(arr)))::INTEGER AS pos, unnest(arr) AS piece
        FROM (SELECT doc_id, string_split(text, {_quote(Q.SPLIT_SEPARATOR)}) AS arr FROM documents)
    """,
    "doc_counts": f'WITH {store_cte()} SELECT "index", "type", id, text, count FROM store',
    "stream_doc_counts": f'WITH {store_cte()} SELECT "index", "type", id, text, count FROM store',
    "doc_counts_sha2": """
        SELECT 'my_index' AS "index", 'my_type' AS "type", sha256(lower(text)) AS id, lower(text) AS text, count(*) AS count
        FROM documents WHERE text IS NOT NULL GROUP BY lower(text)
    """,
    "stream_topk": TOPK_EXACT,
    **{name: hits_sql(q) for name, q in Q.SEARCHES.items()},
    "hits_term_fr": hits_sql(S.Term(Q.TERM_FR)),
    "stream_hits_term": hits_sql(Q.SEARCHES["hits_term"]),
    "entities_reply": _entities("""
        SELECT conv_id * 1000 + turn AS tweet_id, 'reply_to_status' AS content_type,
               (conv_id * 1000 + turn - 1)::VARCHAR AS content_name
        FROM conversations WHERE turn > 0 AND conv_id * 1000 + turn - 1 > 0"""),
    "entities_source": _entities("""
        SELECT doc_id AS tweet_id, 'source' AS content_type, source AS content_name
        FROM documents WHERE source IS NOT NULL"""),
    "entities_url": _entities("""
        SELECT page_id AS tweet_id, 'url' AS content_type,
               unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS content_name
        FROM pages"""),
}

# a stream that has read all documents holds what one pass over them gives
ORACLE["stream_sketch_topk"] = ORACLE["topk_words_cms"]
ORACLE |= {
    "entities_events": _entities("""
        SELECT event_id AS tweet_id, unnest(['account_mentioned', 'reply_to_account', 'hashtag']) AS content_type,
               unnest([user_id::VARCHAR, CASE WHEN user_id > 0 THEN user_id::VARCHAR END, lower(event_type)]) AS content_name
        FROM events""") + " WHERE content_type <> 'reply_to_account' OR content_name IS NOT NULL",
    "entities_reposts": _entities("""
        SELECT l_orderkey * 10 + l_linenumber AS tweet_id, unnest(['account_retweeted', 'status_retweeted']) AS content_type,
               unnest([l_suppkey::VARCHAR, l_partkey::VARCHAR]) AS content_name
        FROM lineitem""").replace("SELECT DISTINCT", "SELECT"),   # order lines that share their numbers are posts of their own
    "entities_places": _entities("""
        SELECT c_custkey AS tweet_id, unnest(['place_country-code', 'place_fullname']) AS content_type,
               unnest([n_nationkey::VARCHAR, n_name]) AS content_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "topk_words_own_stop_list": f"""
        WITH wc AS (SELECT w, count(*) AS n FROM ({DOC_WORDS}) GROUP BY w),
        stop AS (SELECT w FROM wc ORDER BY n DESC, w LIMIT 30)
        SELECT w AS word, n AS count FROM wc WHERE w NOT IN (SELECT trim(w) FROM stop) ORDER BY n DESC, w LIMIT {Q.TOP_K}
    """,
    "parsed_posts": """
        SELECT lang, count(*) AS posts, sum(length(text))::BIGINT AS chars FROM documents WHERE doc_id % 7 <> 0 GROUP BY lang
        UNION ALL SELECT NULL, count(*), 12 * count(*) FROM documents WHERE doc_id % 7 = 0
    """,
    "cms_from_error": f"""
        WITH wh AS (SELECT w, n, {h1('w')} AS a, {h2('w')} AS b FROM (SELECT w, count(*) AS n FROM ({KEPT_WORDS}) GROUP BY w))
        SELECT r::INTEGER AS row, (a + r * b) % 1000 AS bucket, sum(n)::BIGINT AS cnt FROM wh, range(10) t(r) GROUP BY 1, 2
    """,
    "cms_saved": CMS_CELLS,
    "store_updated": ORACLE["doc_counts"],
    "requests_search": f"""
        WITH {store_cte()},
        req AS (
            SELECT min(item_id) AS request_id, value
            FROM (SELECT item_id, regexp_split_to_array(lower(text), {ANALYZER})[1] AS value FROM benchmark)
            WHERE value <> '' GROUP BY value),
        tf AS (
            SELECT r.request_id, t.id, t.dl, count(*) AS tf FROM toks t JOIN req r ON t.term = r.value GROUP BY ALL),
        scored AS (
            SELECT f.request_id, f.id, sqrt(tf) * (1 + ln((SELECT n FROM nd) / (d.df + 1))) ^ 2 / sqrt(dl) AS score
            FROM tf f JOIN (SELECT request_id, count(*) AS df FROM tf GROUP BY request_id) d USING (request_id))
        SELECT x.request_id, x.id, s.count, round(x.score, 6) AS score FROM scored x JOIN store s USING (id)
    """,
}


def _two_fields_sql(text: str) -> str:
    """Pages scored per field like stored texts; a page has its better field's score."""
    field = lambda name: f"""
        SELECT '{name}' AS f, id, len(arr) AS dl, unnest(arr) AS term
        FROM (SELECT page_id::VARCHAR AS id, {analyze("html" if name == "text" else "url")} AS arr FROM pages)"""  # noqa: E731
    return f"""
    WITH toks AS ({field("text")} UNION ALL {field("url")}),
    tf AS (SELECT f, id, dl, term, count(*) AS tf FROM toks
           WHERE list_contains({analyze(_quote(text))}, term) GROUP BY ALL),
    dfs AS (SELECT f, term, count(*) AS df FROM tf GROUP BY ALL),
    sums AS (SELECT f, id, sum(sqrt(tf) * (1 + ln((SELECT count(*) FROM pages) / (df + 1))) ^ 2 / sqrt(dl)) AS score
             FROM tf JOIN dfs USING (f, term) GROUP BY f, id)
    SELECT 'my_index' AS "index", 'page' AS "type", id, 1::BIGINT AS count, round(max(score), 6) AS score
    FROM sums GROUP BY id
    """


def _bloom_held(bits: int, probes: int, members: str, asked: str) -> str:
    """CTEs ``asked`` (its columns, and ``maybe``): the positions of each distinct word, joined to the members' positions."""
    return f"""
    members AS ({members}), asked0 AS ({asked}),
    bits AS MATERIALIZED (SELECT DISTINCT ({h1('w')} + i * {h2('w')}) % {bits} AS pos FROM members, range({probes}) t(i)),
    spots AS MATERIALIZED (
        SELECT w, ({h1('w')} + i * {h2('w')}) % {bits} AS pos FROM (SELECT DISTINCT w FROM asked0), range({probes}) t(i)),
    held AS (SELECT w, count(bits.pos) = count(*) AS maybe FROM spots LEFT JOIN bits USING (pos) GROUP BY w),
    asked AS (SELECT asked0.*, maybe FROM asked0 JOIN held USING (w))
    """


# 100,000 items at 1 %: floor(100000 * ln(100) / ln(2)^2) bits and round(bits / 100000 * ln 2) probes
BLOOM_LARGE_BITS, BLOOM_LARGE_PROBES = 958505, 7

_LANG_WORDS = ("SELECT DISTINCT lang, w FROM (SELECT lang, unnest(string_split(lower(text), ' ')) AS w FROM documents) "
               "WHERE w <> ''")

ORACLE |= {
    "hits_top_term": top_sql(S.Term(Q.TOP_TERM), Q.TOP_HITS),
    "hits_top_match": top_sql(S.MultiMatch(Q.TOP_MATCH), Q.TOP_HITS),
    "hits_two_fields": _two_fields_sql(Q.PAGE_MATCH),
    "requests_search_whole": f"""
        WITH {store_cte()},
        req AS (SELECT min(item_id) AS request_id, text FROM benchmark GROUP BY text),
        terms AS (SELECT request_id, unnest(list_distinct({analyze('text')})) AS term FROM req),
        tf AS (SELECT id, term, dl, count(*) AS tf FROM toks GROUP BY ALL),
        dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        gains AS (SELECT id, term, sqrt(tf) * (1 + ln((SELECT n FROM nd) / (df + 1))) ^ 2 / sqrt(dl) AS gain
                  FROM tf JOIN dfs USING (term)),
        scored AS (SELECT request_id, id, sum(gain) AS score FROM terms JOIN gains USING (term) GROUP BY ALL)
        SELECT x.request_id, x.id, s.count, round(x.score, 6) AS score FROM scored x JOIN store s USING (id)
    """,
    # a line that lost its last character, a word, and a text where a number belongs are bad; each keeps its text
    "parsed_posts_whole": """
        WITH bad AS (
            SELECT unnest([length(json_object('id', doc_id, 'text', text, 'lang', lang)::VARCHAR) - 1,
                           length(lang) + 1, length(lang) + 10]) AS chars FROM documents)
        SELECT lang, count(*) AS posts, sum(length(text))::BIGINT AS chars FROM documents GROUP BY lang
        UNION ALL SELECT NULL, count(*), sum(chars)::BIGINT FROM bad
    """,
    "documents_info": f"""
        SELECT lower(text) AS sentence, {java_hash_text('lower(text)')} AS id, 'my_index' AS "index", 'my_type' AS "type"
        FROM documents WHERE text IS NOT NULL
    """,
    "store_appended": f"""
        WITH {store_cte()}, english AS (
            SELECT id, min(s) AS text, count(*) AS count
            FROM (SELECT lower(text) AS s, {java_hash_text('lower(text)')} AS id FROM documents WHERE lang = 'en') GROUP BY id)
        SELECT "index", "type", id, coalesce(e.text, s.text) AS text, coalesce(e.count, s.count) AS count
        FROM store s LEFT JOIN english e USING (id)
    """,
    "bloom_flags": f"""
        WITH {_bloom_held(BLOOM_BITS, BLOOM_PROBES, f"SELECT lower(unnest({STOP_LIST})) AS w",
                          f"SELECT w, count(*) AS n FROM ({DOC_WORDS}) GROUP BY w")}
        SELECT length(w)::INTEGER AS letters, maybe, count(*) AS words, sum(n)::BIGINT AS count FROM asked GROUP BY ALL
    """,
    "bloom_large": f"""
        WITH {_bloom_held(BLOOM_LARGE_BITS, BLOOM_LARGE_PROBES, f"SELECT w FROM ({_LANG_WORDS}) WHERE lang = 'en'",
                          _LANG_WORDS)}
        SELECT lang, maybe, count(*) AS words FROM asked GROUP BY ALL
    """,
}

ORACLE |= {
    "polled_counts": ORACLE["doc_counts"],
    "stream_own_sketch": ORACLE["topk_words_cms"],
    "user_word_counts": """
        SELECT lang, w, count(*) AS count FROM (SELECT lang, unnest(string_split(lower(text), ' ')) AS w FROM documents)
        WHERE w <> '' GROUP BY ALL
    """,
    "user_reduced": """
        SELECT lang, count(*) AS docs, sum(length(text))::BIGINT AS chars,
               first(text ORDER BY length(text) DESC, text) AS longest
        FROM documents GROUP BY lang
    """,
}
