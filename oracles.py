"""DuckDB SQL for every query in ``catalog``, written independently of the Spark code."""

from __future__ import annotations

from linkloom.constants import WHITESPACE

RUN_TS = "2024-06-24 09:00:00"
WS = f"'{WHITESPACE}'"
ORACLES: dict[str, str] = {}


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# Domain tables.

DOCS = r"""docs AS (
  SELECT doc_id, 'doc-' || doc_id AS link, split_part(text, chr(10), 1) AS title,
         text AS content,
         strftime(DATE '2024-06-24' - CAST(doc_id % 6 AS INTEGER), '%Y-%m-%d') || ': 08:00:00'
           AS date
  FROM documents)"""

FETCHES = r"""fetches AS (
  SELECT event_id,
         'https://site' || user_id || '.example.org/p/'
           || (CAST(json_extract(props, '$.k') AS INTEGER) % 10) AS url,
         CAST(CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404 WHEN 'view' THEN 503
              ELSE 200 END AS INTEGER) AS status,
         ts
  FROM events)"""

STATE = r"""state AS (
  SELECT arg_max(event_id, (ts, event_id)) AS id, url,
         arg_max(status, (ts, event_id)) AS status_code, 'about the ' || url AS title,
         strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS created_at
  FROM fetches WHERE ts < TIMESTAMP '2024-01-16' GROUP BY url)"""

CHECKS = r"""checks AS (
  SELECT url, arg_max(status, (ts, event_id)) AS status,
         strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS updated_at
  FROM fetches WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY url)"""

EDGES = r"""pairs AS MATERIALIZED (
  SELECT DISTINCT o_custkey AS c, l_suppkey AS s
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
edges AS (
  SELECT 'c' || c AS url, 's' || s AS link, s AS pos FROM pairs
  UNION ALL SELECT 's' || s, 'c' || c, c FROM pairs)"""

_STRIPPED = (
    r"regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script\s*>', {0}, 'g'),"
    r" '(?is)<style.*?</style\s*>', {0}, 'g'), '(?s)<!--.*?-->', {0}, 'g')"
)


def _unescape(expr: str) -> str:
    for entity, char in (
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"),
        ("&nbsp;", " "), ("&amp;", "&"),
    ):
        expr = f"replace({expr}, '{entity}', '{char}')"
    return expr


def _visible(html: str = "html") -> str:
    marked = f"regexp_replace({_STRIPPED.format('chr(1)')}, '(?s)<[^>]*>', chr(1), 'g')"
    marked = marked.replace("(html,", f"({html},")
    nodes = f"list_transform(string_split({_unescape(marked)}, chr(1)), lambda x: trim(x, {WS}))"
    return f"array_to_string(list_filter({nodes}, lambda x: x <> ''), ' ')"


ANCHORS = rf"""tags AS (
  SELECT page_id, url, unnest(a) AS a, unnest(range(len(a))) AS pos
  FROM (SELECT page_id, url,
               regexp_extract_all({_STRIPPED.format("''")}, '(?is)<a\s[^>]*>.*?</a\s*>') AS a
        FROM pages)),
anchors AS (
  SELECT page_id, url, CAST(pos AS INTEGER) AS pos,
         {_unescape("regexp_extract(a, '(?i)href=\"([^\"]*)\"', 1)")} AS href,
         {_unescape("regexp_replace(a, '(?s)<[^>]*>', '', 'g')")} AS text
  FROM tags)"""

_SHAPES = (
    "href",
    "'javascript:' || href",
    "'JavaScript:' || href",
    "'#' || href",
    "'-' || href",
    "'img' || href",
    "'Img' || href",
    "href || '/index.html?x=1'",
    "'mailto:' || href",
    "'http://h.com' || href",
    "''",
)


def _shaped(source: str, columns: str, shapes: tuple[str, ...], name: str) -> str:
    parts = [
        f"SELECT {columns}, CAST({i} AS INTEGER) AS variant, {shape} AS {name} FROM {source}"
        for i, shape in enumerate(shapes)
    ]
    return "(" + "\n  UNION ALL ".join(parts) + ")"


_ORIGIN = "regexp_extract(url, '^[a-zA-Z]+://[^/?#]*')"


def _kept(href: str = "href") -> str:
    return (
        f"NOT (starts_with({href}, 'javascript:') OR starts_with({href}, '#')"
        f" OR starts_with({href}, '-') OR starts_with({href}, 'i')"
        f" OR contains({href}, 'index.html'))"
    )


def _resolved(href: str = "href") -> str:
    return f"CASE WHEN starts_with({href}, '/') THEN {_ORIGIN} || {href} ELSE {href} END"


# Keywords and scores over a table (key, title, date, content).

HALF_EVEN = """CASE WHEN len = 0 THEN 0 ELSE least(100,
    (10000 * n) // len + CASE WHEN 2 * ((10000 * n) % len) > len THEN 1
      WHEN 2 * ((10000 * n) % len) = len AND ((10000 * n) // len) % 2 = 1 THEN 1
      ELSE 0 END) END"""


def _counts(source: str, key: str) -> str:
    return rf"""tokens AS (
  SELECT {key}, unnest(t) AS word, unnest(range(len(t))) AS pos
  FROM (SELECT {key}, regexp_extract_all(lower(content), '\p{{L}}{{2,}}') AS t FROM {source})),
counts AS (
  SELECT {key}, word, count(*) AS n, min(pos) AS first FROM tokens GROUP BY {key}, word),
ranked AS (
  SELECT {key}, word, n,
         CAST(row_number() OVER (PARTITION BY {key} ORDER BY n DESC, first) - 1 AS INTEGER) AS rank
  FROM counts)"""


PIECES = f"""list_filter(string_split(content, ','), lambda p: length(trim(p, {WS})) > 30
    OR contains(lower(p), 'the') OR contains(lower(p), 'de')
    OR contains(lower(p), 'der') OR contains(lower(p), 'la'))"""


def _features(source: str, key: str) -> str:
    """A table ``features`` (key, word, n, len, hundredths) of distinct keys."""
    return f"""{_counts(source, key)},
lengths AS (SELECT {key}, length(array_to_string({PIECES}, ' ')) AS len FROM {source}),
sized AS (
  SELECT lengths.{key}, word, n, len FROM lengths
  LEFT JOIN (SELECT * FROM ranked WHERE rank = 0) USING ({key})),
features AS (
  SELECT *, CAST(CASE WHEN n IS NULL THEN NULL ELSE {HALF_EVEN} END AS INTEGER) AS hundredths,
         CASE WHEN word IN ('the', 'de') THEN 'coin' WHEN word IN ('der', 'la') THEN 'other'
              ELSE 'none' END AS tier,
         CASE WHEN n IS NULL THEN '[]' ELSE '[["' || word || '", ' || n || ']]' END AS keyword
  FROM sized)"""


TIER_EFFECT = """CAST(CASE WHEN len BETWEEN 2000 AND 10000 AND hundredths BETWEEN 25 AND 90
    THEN CASE tier WHEN 'coin' THEN 4 WHEN 'other' THEN 2 ELSE -2 END ELSE 0 END AS INTEGER)"""

TITLE_HIT = "(contains(lower(title), 'the') OR contains(lower(title), 'de'))"


def _recency(as_of: str, ymd: str) -> str:
    return (
        f"CASE {as_of} - {ymd} WHEN 0 THEN 0 WHEN 2 THEN -1 WHEN 3 THEN -2 WHEN 4 THEN -3"
        " ELSE -4 END"
    )


def _score(as_of: int, title: str = "title", date: str = "date") -> str:
    ymd = f"CAST(replace(substr({date}, 1, 10), '-', '') AS INTEGER)"
    hit = TITLE_HIT.replace("title", title)
    return f"""CASE WHEN {date} IS NULL THEN NULL ELSE CAST(greatest(0, least(10,
      4 + CASE WHEN {hit} THEN 1 ELSE 0 END + coalesce({TIER_EFFECT}, 0)
      + {_recency(str(as_of), ymd)})) / 10.0 AS DOUBLE) END"""


# Sources and sinks.

ORACLES["request_plan"] = """
SELECT keyword, start,
       'https://api.example.org/v1/search/news.json?query=' || keyword || '&start=' || start
         || '&display=100' AS url
FROM (SELECT keyword, unnest(range(1, greatest(found, 1) + 1, 100)) AS start
      FROM (SELECT p_name AS keyword, CAST(count(*) AS BIGINT) AS found
            FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY p_name))"""

ORACLES["api_items"] = _with(DOCS) + """
SELECT doc_id, CAST(i AS INTEGER) AS pos, title, link || '/' || i AS link, date
FROM (SELECT doc_id, link, date, unnest(lines) AS title, unnest(range(len(lines))) AS i
      FROM (SELECT doc_id, link, date, string_split(content, chr(10)) AS lines FROM docs))"""

ORACLES["api_rejects"] = """
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'no body' ELSE 'unreadable body' END AS reject_reason
FROM documents WHERE doc_id % 5 < 3"""

ORACLES["page_scan"] = """
SELECT page_id, url, CAST(0 AS INTEGER) AS variant, html FROM pages
UNION ALL SELECT page_id, url, 1, NULL FROM pages"""

ORACLES["ready_urls"] = _with(FETCHES, STATE) + "SELECT url FROM state WHERE status_code = 200"

_FEED = """'{"id":' || id || ',"link":"' || url || '","title":"' || title || '","date":"'
  || created_at || '"}'"""
ORACLES["recheck_feed"] = _with(FETCHES, STATE) + f"SELECT {_FEED} AS value FROM state"

ORACLES["json_records"] = _with(FETCHES, STATE, f"feed AS (SELECT *, {_FEED} AS v FROM state)") + """
SELECT CAST(0 AS INTEGER) AS variant, v AS value, id, url AS link, title, created_at AS date,
       false AS malformed FROM feed
UNION ALL SELECT 1, '[' || v, NULL, NULL, NULL, NULL, true FROM feed
UNION ALL SELECT 2, '["' || replace(v, '"', '\\"') || '"]', NULL, NULL, NULL, NULL, true FROM feed"""

ORACLES["total_url_rows"] = _with(DOCS) + """
SELECT link || '/' || i AS url, date AS created_at
FROM (SELECT link, date, unnest(range(len(string_split(content, chr(10))))) AS i FROM docs)"""

ORACLES["ready_rows"] = _with(DOCS, _features("docs", "doc_id")) + f"""
SELECT CAST(200 AS INTEGER) AS status_code, link AS url, title, content, keyword,
       {_score(20240624)} AS score, date AS created_at, '{RUN_TS}' AS updated_at
FROM docs JOIN features USING (doc_id)"""

ORACLES["not_ready_rows"] = _with(FETCHES) + f"""
SELECT status AS status_code, url, 'fetch ' || event_id AS title, '{RUN_TS}' AS created_at,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM fetches WHERE status <> 200"""

ORACLES["log_export"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value, props
FROM events"""

ORACLES["csv_saving"] = _with(DOCS) + "SELECT doc_id, title, link, date, content FROM docs"

# Links and pages.

ORACLES["page_anchors"] = _with(ANCHORS) + "SELECT page_id, pos, href, text FROM anchors"

ORACLES["link_filter"] = _with(ANCHORS) + f"""
SELECT page_id, pos, variant, href
FROM {_shaped("anchors", "page_id, pos", _SHAPES, "href")} WHERE {_kept()}"""

ORACLES["link_resolve"] = _with(ANCHORS) + f"""
SELECT page_id, pos, variant, {_resolved()} AS link
FROM {_shaped("anchors", "page_id, pos, url", _SHAPES, "href")}"""

ORACLES["page_link_set"] = _with(ANCHORS) + f"""
SELECT DISTINCT page_id, link FROM (SELECT page_id, {_resolved()} AS link FROM anchors
WHERE {_kept()}) WHERE starts_with(link, 'http')"""

ORACLES["page_link_records"] = _with(ANCHORS) + f"""
SELECT page_id, pos, text AS title, {_resolved()} AS link, '{RUN_TS}' AS date
FROM anchors WHERE {_kept()}"""

ORACLES["visible_text"] = f"SELECT page_id, {_visible()} AS content FROM pages"

ORACLES["element_search"] = rf"""
SELECT page_id, CAST(pos AS INTEGER) AS pos,
       {_unescape("regexp_replace(d, '(?s)<[^>]*>', '', 'g')")} AS text
FROM (SELECT page_id, unnest(ds) AS d, unnest(range(len(ds))) AS pos
      FROM (SELECT page_id,
                   regexp_extract_all({_STRIPPED.format("''")},
                     '(?is)<div class="ad">.*?</div>') AS ds
            FROM pages))"""

ORACLES["attribute_get"] = _with(ANCHORS) + """
SELECT page_id, pos, href, CAST(NULL AS VARCHAR) AS title FROM anchors"""

ORACLES["block_extract"] = rf"""
SELECT page_id, CAST(item AS INTEGER) AS item,
       {_unescape("regexp_extract(li, 'href=\"([^\"]*)\"', 1)")} AS link,
       trim(replace({_unescape("regexp_replace(li, '(?s)<[^>]*>', '', 'g')")}, ' ', ''), {WS})
         AS title
FROM (SELECT page_id, unnest(lis) AS li, unnest(range(len(lis))) AS item
      FROM (SELECT page_id,
                   regexp_extract_all(regexp_extract(html, '(?is)<nav>(.*?)</nav>', 1),
                     '(?is)<li>.*?</li>') AS lis
            FROM pages))"""

_OWN = r"""own AS (
  SELECT page_id, unnest(links) AS a, unnest(range(len(links))) AS i
  FROM (SELECT page_id, regexp_extract_all(html, '(?is)<a [^>]*>.*?</a>') AS links FROM pages))"""
_OWN_HREF = _unescape("regexp_extract(a, 'href=\"([^\"]*)\"', 1)")
_OWN_TEXT = f"trim(replace({_unescape("regexp_replace(a, '(?s)<[^>]*>', '', 'g')")}, ' ', ''), {WS})"
ORACLES["list_portal"] = _with(_OWN) + f"""
SELECT page_id, CAST(i AS INTEGER) AS item, {_OWN_HREF} AS link, '1 min' AS date,
       {_OWN_TEXT} AS title FROM own"""
_RESULTS = f"""SELECT page_id, CAST(i AS INTEGER) AS pos, {_OWN_HREF} AS link FROM own
UNION ALL SELECT page_id, CAST((SELECT count(*) FROM own WHERE own.page_id = pages.page_id) AS INTEGER),
  'http://nested' FROM pages"""
ORACLES["result_portal"] = _with(_OWN) + _RESULTS
_CARDS = f"SELECT page_id, CAST(i AS INTEGER) AS pos, {_OWN_HREF} AS link FROM own"
ORACLES["card_portal"] = _with(_OWN) + _CARDS
ORACLES["site_dispatch"] = _with(DOCS, _OWN) + f"""
SELECT title, link || '/' || i AS link, date, 'naver' AS site
FROM (SELECT link, date, unnest(lines) AS title, unnest(range(len(lines))) AS i
      FROM (SELECT link, date, string_split(content, chr(10)) AS lines FROM docs))
UNION ALL SELECT {_OWN_TEXT}, {_OWN_HREF}, '1 min', 'daum' FROM own
UNION ALL SELECT NULL, link, NULL, 'google' FROM ({_RESULTS})
UNION ALL SELECT NULL, link, NULL, 'bing' FROM ({_CARDS})"""

ORACLES["portal_requests"] = """
SELECT keyword, form, before || keyword || after AS url
FROM (SELECT DISTINCT p_name AS keyword FROM part),
     (VALUES ('list', 'https://search.daum.net/search?w=news&nil_search=btn&DA=NTB&enc=utf8&cluster=y&cluster_page=1&q=', ''),
             ('result', 'https://www.google.com/search?q=', '&tbm=nws&gl=ko&hl=kr'),
             ('card', 'https://www.bing.com/news/search?q=', '')) f(form, before, after)"""

ORACLES["class_detect"] = """
SELECT page_id, CASE WHEN NOT contains(html, 'class="ad">') THEN ''
  ELSE CASE page_id % 4 WHEN 0 THEN 'algocore|ad' WHEN 2 THEN 'ad|lead story' ELSE 'ad' END
  END AS classes
FROM pages"""

ORACLES["merge_lists"] = _with(ANCHORS) + """
SELECT arg_min(list_id, (list_id, pos)) AS list_id, arg_min(pos, (list_id, pos)) AS pos, link
FROM (SELECT page_id AS list_id, pos, href AS link FROM anchors
      UNION ALL SELECT page_id + 1, pos, href FROM anchors)
GROUP BY link"""

# Scalars.

_REST = "regexp_replace(url, '^[a-z]+:', '')"
_HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
ORACLES["url_root"] = f"""
SELECT page_id, CAST(0 AS INTEGER) AS variant, {_ORIGIN} || '/' AS root FROM pages
UNION ALL SELECT page_id, 1, 'https://' || {_HOST} || '/' FROM pages
UNION ALL SELECT page_id, 2, 'https://' || substr({_REST}, 3) || '/' FROM pages
UNION ALL SELECT page_id, 3, 'http://' || {_HOST} || '/' FROM pages
UNION ALL SELECT page_id, 4, 'localhost:///' FROM pages
UNION ALL SELECT page_id, 5, 'https:///' FROM pages"""

ORACLES["url_join"] = _with(ANCHORS) + f"""
SELECT page_id, pos, CAST(0 AS INTEGER) AS variant, {_ORIGIN} || href AS link FROM anchors
UNION ALL SELECT page_id, pos, 1, regexp_extract(url, '^[a-z]+:') || '//cdn.x' || href FROM anchors
UNION ALL SELECT page_id, pos, 2, {_ORIGIN} || href FROM anchors
UNION ALL SELECT page_id, pos, 3, {_ORIGIN} || '/a' || href || '?q=1#f' FROM anchors
UNION ALL SELECT page_id, pos, 4, {_ORIGIN} || '/a/' FROM anchors
UNION ALL SELECT page_id, pos, 5, 'foo' || href FROM anchors"""

ORACLES["headline_clean"] = rf"""
SELECT doc_id, regexp_replace(
    '비트코인, 상승!  ' || text,
    '[^\p{{L}}\p{{N}}_\s\v\x{{85}}\p{{Z}}\x1c-\x1f]', '', 'g') AS cleaned
FROM documents"""

_NORM = "strftime(ts, '%Y-%m-%d: %H:%M:%S')"
ORACLES["pubdate_norm"] = f"""
SELECT event_id, CAST(variant AS INTEGER) AS variant,
       CASE WHEN variant < 2 THEN {_NORM} END AS date
FROM (SELECT event_id, ts, unnest([0, 1, 2, 3]) AS variant FROM events)"""

ORACLES["date_int"] = """
SELECT event_id, CAST(variant AS INTEGER) AS variant,
       CASE WHEN variant < 2 THEN CAST(strftime(ts, '%Y%m%d') AS INTEGER) END AS ymd
FROM (SELECT event_id, ts, unnest([0, 1, 2]) AS variant FROM events)"""

ORACLES["title_squash"] = f"SELECT doc_id, trim(replace(text, ' ', ''), {WS}) AS title FROM documents"

ORACLES["seoul_date"] = "SELECT event_id, CAST(ts + INTERVAL 9 HOUR AS DATE) AS day FROM events"

ORACLES["keyword_json"] = _with(DOCS, _counts("docs", "doc_id")) + """
SELECT doc_id, '[' || coalesce(string_agg('["' || word || '", ' || n || ']', ', ' ORDER BY rank), '')
  || ']' AS keyword
FROM docs LEFT JOIN (SELECT * FROM ranked WHERE rank < 3) USING (doc_id) GROUP BY doc_id"""

# Keywords and scores.

LEXICON = r"""lexicon AS (
  SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{L}{2,}')) AS word FROM benchmark)"""

ORACLES["noun_tokens"] = _with(DOCS, _counts("docs", "doc_id"), LEXICON) + """
SELECT doc_id, CAST(pos AS INTEGER) AS pos, word
FROM tokens WHERE word IN (SELECT word FROM lexicon)"""

ORACLES["compound_tokens"] = _with(
    DOCS,
    _counts("docs", "doc_id"),
    LEXICON,
    """begun AS (
  SELECT t.word, i AS place, max(length(l.word)) AS size
  FROM (SELECT DISTINCT word FROM tokens) t, range(1, 400) p(i), range(3, 400) q(n), lexicon l
  WHERE i + n - 1 <= length(t.word) AND l.word = substr(t.word, i, n)
  GROUP BY ALL)""",
    """cut AS (
  (SELECT word, 0 AS part, place, size FROM begun
   QUALIFY row_number() OVER (PARTITION BY word ORDER BY place) = 1)
  UNION ALL
  (SELECT b.word, part + 1, b.place, b.size
   FROM cut c JOIN begun b ON b.word = c.word AND b.place >= c.place + c.size
   QUALIFY row_number() OVER (PARTITION BY b.word ORDER BY b.place) = 1))""",
).replace("WITH", "WITH RECURSIVE", 1) + """
SELECT doc_id, CAST(pos AS INTEGER) AS pos, part, substr(word, CAST(place AS INTEGER), CAST(size AS INTEGER)) AS word
FROM tokens JOIN cut USING (word)"""

ORACLES["lexicon_keywords"] = _with(DOCS, _counts("docs", "doc_id"), LEXICON) + """
SELECT doc_id, CAST(rank AS INTEGER) AS rank, word, n
FROM (SELECT doc_id, word, n,
             row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) AS rank
      FROM counts WHERE word IN (SELECT word FROM lexicon))
WHERE rank <= 3"""

ORACLES["top_keyword"] = _with(DOCS, _counts("docs", "doc_id")) + """
SELECT doc_id, word, n FROM ranked WHERE rank = 0"""

ORACLES["top_k_keywords"] = _with(DOCS, _counts("docs", "doc_id")) + """
SELECT doc_id, rank, word, n FROM ranked WHERE rank < 3"""

ORACLES["sentence_filter"] = _with(DOCS) + f"""
SELECT doc_id, CAST(pos AS INTEGER) AS pos, piece
FROM (SELECT doc_id, unnest(p) AS piece, unnest(range(len(p))) AS pos
      FROM (SELECT doc_id, {PIECES} AS p FROM docs))"""

ORACLES["clean_length"] = _with(DOCS) + f"""
SELECT doc_id, CAST(length(array_to_string({PIECES}, ' ')) AS INTEGER) AS clean_length FROM docs"""

_DOC_FEATURES = _with(DOCS, _features("docs", "doc_id"))

ORACLES["keyword_share"] = _DOC_FEATURES + """
SELECT doc_id, CAST(hundredths / 100.0 AS DOUBLE) AS share FROM features"""

ORACLES["title_hit"] = _with(DOCS) + f"SELECT doc_id, {TITLE_HIT} AS title_hit FROM docs"

ORACLES["keyword_tier"] = _DOC_FEATURES + f"""
SELECT doc_id, tier, coalesce({TIER_EFFECT}, 0) AS tier_effect FROM features"""

_YMD = "CAST(replace(substr(date, 1, 10), '-', '') AS INTEGER)"
_AS_DAY = "CAST(strptime(CAST(as_of AS VARCHAR), '%Y%m%d') AS DATE)"
ORACLES["recency_adjust"] = _with(DOCS) + f"""
SELECT doc_id, as_of, CAST({_recency("as_of", _YMD)} AS INTEGER) AS tenths,
       CAST({_recency(_AS_DAY, "CAST(substr(date, 1, 10) AS DATE)")} AS INTEGER) AS by_days
FROM (SELECT doc_id, date, CAST(unnest(range(20240620, 20240631)) AS INTEGER) AS as_of FROM docs)"""

ORACLES["relevance_score"] = _DOC_FEATURES + f"""
SELECT doc_id, keyword, CAST(len AS INTEGER) AS clean_length, {_score(20240624)} AS score
FROM docs JOIN features USING (doc_id)"""

ORACLES["enrich_links"] = _with(
    DOCS,
    f"texts AS (SELECT url AS link, {_visible()} AS content FROM pages)",
    _features("texts", "link"),
    f"""links AS (
  SELECT url AS title, url AS link, '{RUN_TS}' AS date FROM pages
  UNION ALL SELECT url, url, '{RUN_TS}' FROM pages
  UNION ALL SELECT title, link, date FROM docs)""",
) + f"""
SELECT title, link, date, coalesce(content, '') AS content, coalesce(keyword, '[]') AS keyword,
       {_score(20240624)} AS score
FROM links LEFT JOIN features USING (link) LEFT JOIN texts USING (link)"""

# Status and routes.

ORACLES["status_classify"] = _with(FETCHES) + """
SELECT event_id, url, status, CASE status WHEN 200 THEN 'ready' ELSE 'not_ready' END AS route
FROM fetches"""
ORACLES["route_ready"] = _with(FETCHES) + "SELECT event_id, url FROM fetches WHERE status = 200"
ORACLES["route_not_ready"] = _with(FETCHES) + (
    "SELECT event_id, url, status FROM fetches WHERE status <> 200"
)
ORACLES["route_mixed"] = """
SELECT event_id, CASE event_type WHEN 'click' THEN 'ready' WHEN 'view' THEN 'not_ready'
  ELSE 'reject' END AS route
FROM events"""

ORACLES["delete_flags"] = _with(FETCHES, STATE, CHECKS) + """
SELECT url, url IN (SELECT url FROM state WHERE status_code = 200) AS deleted FROM checks"""

ORACLES["delete_remaining"] = _with(FETCHES, CHECKS) + """
SELECT event_id, url FROM fetches
WHERE ts < TIMESTAMP '2024-01-16' AND url NOT IN (SELECT url FROM checks)"""

_MIGRATE = (
    FETCHES,
    STATE,
    CHECKS,
    f"""texts AS (
  SELECT 'https://site' || doc_id // 13 % (SELECT max(user_id) + 1 FROM events)
           || '.example.org/p/' || doc_id % 10 AS url,
         trim(arg_max(text, doc_id), {WS}) AS content
  FROM documents GROUP BY url)""",
    _features("texts", "url"),
    """moved AS (
  SELECT checks.url, status, title, created_at, updated_at, coalesce(content, '') AS content,
         coalesce(keyword, '[]') AS keyword, len, hundredths, tier
  FROM checks LEFT JOIN state USING (url) LEFT JOIN features USING (url)
       LEFT JOIN texts USING (url))""",
)
_NEW_READY = f"""
SELECT status_code, url, title, '' AS content, '[]' AS keyword, CAST(0.4 AS DOUBLE) AS score,
       created_at, created_at AS updated_at
FROM state WHERE status_code = 200 AND url NOT IN (SELECT url FROM checks)
UNION ALL
SELECT status, url, title, content, keyword, {_score(20240124, date="created_at")}, created_at,
       '{RUN_TS}'
FROM moved WHERE status = 200"""
_NEW_NOT_READY = """
SELECT status_code, url, title, created_at, created_at AS updated_at
FROM state WHERE status_code <> 200 AND url NOT IN (SELECT url FROM checks)
UNION ALL
SELECT status, url, title, created_at, updated_at FROM moved WHERE status <> 200"""

ORACLES["answer_snapshot"] = _with(FETCHES) + f"""
SELECT doc_id, link, coalesce(status, 500) AS status, '{RUN_TS}' AS updated_at
FROM (SELECT doc_id, 'https://site' || doc_id // 13 % (SELECT max(user_id) + 1 FROM events)
               || '.example.org/p/' || doc_id % 10 AS link FROM documents) d
LEFT JOIN (SELECT url AS link, arg_max(coalesce(status, 500), (ts, event_id)) AS status
           FROM fetches GROUP BY url) USING (link)"""

ORACLES["migrate_ready"] = _with(*_MIGRATE) + _NEW_READY
ORACLES["migrate_not_ready"] = _with(*_MIGRATE) + _NEW_NOT_READY

ORACLES["batch_assign"] = """
SELECT list_id, pos,
       (row_number() OVER (PARTITION BY list_id ORDER BY pos NULLS FIRST) - 1) // 20 AS batch
FROM (SELECT CASE WHEN user_id % 10 <> 0 THEN user_id END AS list_id,
             CASE WHEN event_id % 100 <> 0 THEN event_id END AS pos
      FROM events)"""

ORACLES["bucket_assign"] = """
SELECT collection, list_id, day, links, CASE WHEN n <= 10 THEN n END AS slot,
       CASE WHEN n <= 4 THEN 1 WHEN n <= 6 THEN 2 WHEN n <= 8 THEN 3 WHEN n <= 10 THEN 4 END
         AS group_no,
       n > 10 AS rejected
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY collection ORDER BY list_id, day, links)
               AS INTEGER) AS n
      FROM (SELECT CASE WHEN user_id % 5 <> 0 THEN user_id END AS collection,
                   CAST(day(ts) % 4 AS INTEGER) AS list_id, CAST(day(ts) AS INTEGER) AS day,
                   count(*) AS links
            FROM events GROUP BY ALL))"""

# Crawls and nested results.

ORACLES["frontier_step"] = _with(EDGES) + """
SELECT link AS url, CAST(1 AS INTEGER) AS depth,
       arg_min(k, (s, pos)) AS order_key
FROM (SELECT link, CAST(substr(url, 2) AS BIGINT) AS s, pos, substr(url, 2) || '/' || pos AS k
      FROM edges WHERE starts_with(url, 's'))
WHERE link NOT IN (SELECT 'c' || c_custkey FROM customer WHERE c_acctbal > 5000)
GROUP BY link"""

_BFS = EDGES + """,
start AS (SELECT max('c' || c_custkey) AS url FROM customer),
level1 AS MATERIALIZED (
  SELECT link AS url, min(pos) AS k1 FROM edges JOIN start USING (url)
  GROUP BY link),
reached AS (
  SELECT link AS url, min((k1, pos)) AS key FROM level1 JOIN edges USING (url) GROUP BY link),
level2 AS (
  SELECT * FROM reached ANTI JOIN start USING (url) ANTI JOIN level1 USING (url)),
queue AS (
  SELECT url, 0 AS depth, '' AS order_key, 0 AS a, 0 AS b FROM start
  UNION ALL SELECT url, 1, CAST(k1 AS VARCHAR), k1, 0 FROM level1
  UNION ALL SELECT url, 2, key[1] || '/' || key[2], key[1], key[2] FROM level2),
visited AS MATERIALIZED (
  SELECT url, CAST(depth AS INTEGER) AS depth, order_key FROM queue
  ORDER BY depth, a, b LIMIT 1000)"""

ORACLES["bfs_crawl"] = _with(_BFS) + "SELECT url, depth, order_key FROM visited"

ORACLES["crawl_results"] = _with(_BFS) + f"""
SELECT url AS page_url, depth, pos, 'to ' || link AS title, link, '{RUN_TS}' AS date
FROM visited JOIN edges USING (url) WHERE depth < 2"""

ORACLES["deep_crawl"] = _with(EDGES) + """
SELECT 'c' || c_custkey AS seed, url AS page_url, pos, 'to ' || link AS title, link
FROM customer JOIN edges ON url = 'c' || c_custkey"""

ORACLES["deep_crawl_wide"] = _with(EDGES) + """,
seeds AS (SELECT 'c' || c_custkey AS seed FROM customer),
level1 AS (
  SELECT seed, link AS url, min(pos) AS k1 FROM seeds JOIN edges ON url = seed GROUP BY ALL),
level2 AS (
  SELECT seed, link AS url, min((k1, pos)) AS key
  FROM level1 JOIN edges USING (url)
  WHERE link <> seed GROUP BY ALL),
queue AS (
  SELECT seed, seed AS url, 0 AS depth, 0 AS a, 0 AS b FROM seeds
  UNION ALL SELECT seed, url, 1, k1, 0 FROM level1
  UNION ALL SELECT seed, url, 2, key[1], key[2] FROM level2
            ANTI JOIN level1 USING (seed, url))
SELECT seed, url, CAST(depth AS INTEGER) AS depth,
       row_number() OVER (PARTITION BY seed ORDER BY depth, a, b) - 1 AS visit
FROM queue QUALIFY visit < 36"""

_LINES = """(SELECT doc_id, lines, unnest(range(len(lines))) AS i
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))"""
ORACLES["flatten_maps"] = f"""
SELECT doc_id, 'a' || doc_id AS page_url, CAST(i AS INTEGER) AS pos, lines[i + 1] AS title,
       'l' || i AS link FROM {_LINES}
UNION ALL
SELECT doc_id, 'b' || doc_id, CAST(len(lines) - 1 - i AS INTEGER), lines[i + 1], 'l' || i
FROM {_LINES}"""

ORACLES["flatten_nested"] = f"""
SELECT doc_id, CAST(i AS INTEGER) AS pos, lines[i + 1] AS item, CAST(1 AS INTEGER) AS levels
FROM {_LINES}
UNION ALL
SELECT doc_id, CAST(unnest(range(len(p))) AS INTEGER), unnest(p), 2
FROM (SELECT doc_id, flatten(list_transform(lines[1:1] || lines[3:], lambda x: string_split(x, ','))) AS p
      FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))"""

# Whole runs.

_STORED_READY = f"""
SELECT 'request_url' AS stored_in, link AS url, CAST(200 AS INTEGER) AS status_code, title,
       content, keyword, {_score(20240624)} AS score, date AS created_at, '{RUN_TS}' AS updated_at
"""
_STORED_NOT_READY = f"""
SELECT 'not_request_url', link, CAST(status AS INTEGER), title, NULL, NULL, NULL, date, '{RUN_TS}'
"""

_DOC_TEXTS = (
    DOCS,
    f"texts AS (SELECT doc_id, trim(content, {WS}) AS content FROM docs)",
    _features("texts", "doc_id"),
    """answers AS (
  SELECT docs.doc_id, CASE WHEN quality IS NULL OR docs.doc_id % 7 = 0 THEN 500
    WHEN quality = 1 THEN 200 ELSE 404 END
    AS status
  FROM docs LEFT JOIN labels USING (doc_id))""",
)
_DOC_FLOW = _with(*_DOC_TEXTS) + f"""
{_STORED_READY} FROM (SELECT doc_id, link, title, date FROM docs) JOIN texts USING (doc_id)
  JOIN features USING (doc_id) JOIN answers USING (doc_id) WHERE status = 200
UNION ALL {_STORED_NOT_READY} FROM docs JOIN answers USING (doc_id) WHERE status <> 200"""

ORACLES["status_flow"] = f"""
SELECT * FROM ({_DOC_FLOW}) flow
WHERE CAST(substr(url, 5) AS BIGINT) % 13 <> 0 AND CAST(substr(url, 5) AS BIGINT) % 11 <> 0
UNION ALL
SELECT 'reject_url', CASE WHEN doc_id % 13 <> 0 THEN link END, NULL, title,
       CASE WHEN doc_id % 13 = 0 THEN 'link' ELSE 'date' END, NULL, NULL,
       CASE WHEN doc_id % 11 = 0 THEN 'soon' ELSE strftime(DATE '2024-06-24'
         - CAST(doc_id % 6 AS INTEGER), '%Y-%m-%d: 08:00:00') END, NULL
FROM (SELECT doc_id, 'doc-' || doc_id AS link, string_split(text, chr(10))[1] AS title
      FROM documents) WHERE doc_id % 13 = 0 OR doc_id % 11 = 0"""
_FIRST = _with(
    *_DOC_TEXTS,
    """items AS (
  SELECT doc_id, link, date, unnest(string_split(content, chr(10))) AS title FROM docs)""",
) + f"""
{_STORED_READY} FROM items JOIN texts USING (doc_id)
  JOIN features USING (doc_id) JOIN answers USING (doc_id) WHERE status = 200
UNION ALL {_STORED_NOT_READY} FROM items JOIN answers USING (doc_id) WHERE status <> 200
UNION ALL SELECT 'total_url', link, NULL, NULL, NULL, NULL, NULL, date, NULL FROM items"""
ORACLES["first_collection"] = _FIRST
ORACLES["stream_collection"] = _FIRST

ORACLES["deep_collection"] = _with(
    ANCHORS,
    f"""records AS (
  SELECT page_id, text AS title, {_resolved()} AS link, '{RUN_TS}' AS date
  FROM anchors WHERE {_kept()})""",
    f"""shown AS (
  SELECT link, {_visible()} AS content
  FROM (SELECT link, min(page_id) AS page_id FROM records GROUP BY link) JOIN pages USING (page_id))""",
    _features("shown", "link"),
    """answered AS (
  SELECT *, CASE length(link) % 3 WHEN 0 THEN 200 WHEN 1 THEN 404 ELSE 500 END AS status
  FROM records)""",
) + f"""
{_STORED_READY} FROM answered JOIN shown USING (link) JOIN features USING (link)
WHERE status = 200
UNION ALL {_STORED_NOT_READY} FROM answered WHERE status <> 200"""

ORACLES["stream_latest_status"] = _with(*_MIGRATE) + f"""
SELECT 'request_url' AS stored_in, url, status_code, title, content, keyword, score, created_at,
       updated_at FROM ({_NEW_READY})
UNION ALL
SELECT 'not_request_url', url, status_code, title, NULL, NULL, NULL, created_at, updated_at
FROM ({_NEW_NOT_READY})"""
