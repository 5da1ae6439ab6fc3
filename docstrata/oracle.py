"""The queries of ``catalog`` as SQL text, for checking on another engine."""

from __future__ import annotations

import re

# Fixed values, written here again so that a wrong one in the package shows.
CLEAN_TAGS = ["script", "style", "nav", "footer", "header", "noscript", "iframe"]
BODIES = {"Employment Appeals Tribunal": "1", "Equality Tribunal": "2", "Labour Court": "3", "Workplace Relations Commission": "4"}

SITE = "https://site.example"
RUN_TS = "2024-07-01T00:00:00"
# The 29 whitespace code points as a regular-expression class.
_WS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{_WS}+|{_WS}+$', '', 'g')"


def _collapse(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{_WS}+', ' ', 'g'))"


def _encode(expr: str) -> str:
    return f"replace({expr}, '/', '%2F')"


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(c.strip() for c in ctes) + "\n"


# -- shared building blocks ------------------------------------------------------------

_BODIES = "bodies(body, body_id) AS (VALUES " + ", ".join(f"('{b}', '{i}')" for b, i in BODIES.items()) + ")"

_SUPPLIER_RANGES = """ranges AS (
  SELECT l_suppkey AS range_id, CAST(min(l_shipdate) AS DATE) AS a, CAST(max(l_shipdate) AS DATE) AS b
  FROM lineitem GROUP BY l_suppkey)"""
_USER_RANGES = """ranges AS (
  SELECT user_id AS range_id, CAST(min(ts) AS DATE) AS a, CAST(max(ts) AS DATE) AS b
  FROM events GROUP BY user_id)"""


def _partitions(size: str) -> str:
    """Partitions one after the other: each starts the day after the last one ended."""
    full_end = {
        "monthly": "CAST(date_trunc('month', {s}) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE)",
        "quarterly": "CAST(date_trunc('month', {s}) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)",
        "weekly": "({s} + 6)",
    }[size]
    first = full_end.format(s="a")
    after = full_end.format(s="(e + 1)")
    return f"""parts(range_id, s, e, b) AS (
  SELECT range_id, a, least({first}, b), b FROM ranges WHERE a <= b
  UNION ALL
  SELECT range_id, CAST(e + 1 AS DATE), least({after}, b), b FROM parts WHERE e < b)"""


def _frontier(ranges: str, size: str) -> str:
    start, end = "strftime(s, '%d/%m/%Y')", "strftime(e, '%d/%m/%Y')"
    return _with(ranges, _partitions(size), _BODIES) + f"""
SELECT range_id, body, body_id, CAST(s AS VARCHAR) AS partition_start, CAST(e AS VARCHAR) AS partition_end,
  body || '|' || CAST(s AS VARCHAR) AS partition_key,
  '{SITE}/en/search/?decisions=1&body=' || body_id || '&from=' || {_encode(start)} || '&to=' || {_encode(end)}
    || '&pageNumber=1' AS url
FROM parts CROSS JOIN bodies"""


_PAGES = """page_rows AS (
  SELECT page_id, 'PG/ ' || lpad(CAST(page_id AS VARCHAR), 8, '0') AS identifier,
    'Body ' || regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS body,
    CAST(DATE '2024-01-01' + CAST((page_id * 7) % 366 AS INTEGER) AS DATE) AS day,
    strftime(CAST(DATE '2024-01-01' + CAST((page_id * 7) % 366 AS INTEGER) AS DATE), '%d/%m/%Y') AS published_date,
    CAST(CAST(date_trunc('month', DATE '2024-01-01' + CAST((page_id * 7) % 366 AS INTEGER)) AS DATE) AS VARCHAR) AS partition_date,
    url AS doc_url, html,
    CASE WHEN contains(url, '?page=') THEN 'pdf'
         WHEN url LIKE '%#top' OR url LIKE '%/' THEN 'doc' ELSE 'html' END AS file_type
  FROM pages)"""


def _without_tags(expr: str, tags: list[str], blank: str) -> str:
    for tag in tags:
        expr = f"regexp_replace({expr}, '<{tag}\\b[^>]*>.*?</{tag}\\s*>', '{blank}', 'gis')"
    return expr


def _page_text(expr: str) -> str:
    text = f"regexp_replace({expr}, '<!--.*?-->', ' ', 'gs')"
    text = _without_tags(text, CLEAN_TAGS, " ")
    text = f"regexp_replace({text}, '<[^>]*>', ' ', 'g')"
    text = f"replace({text}, '&quot;', '\"')"
    text = f"regexp_replace({text}, '&amp;?', '&', 'g')"
    return _collapse(text)


def _page_clean(expr: str) -> str:
    body = f"regexp_extract({expr}, '<body>(.*)$', 1, 's')"
    body = _without_tags(body, CLEAN_TAGS, "")
    body = f"regexp_replace({body}, '</body>.*$', '', 's')"
    body = f"replace({body}, '<br>', '<br/>')"
    # A bold run that is left open ends where its paragraph does.
    body = f"regexp_replace({body}, '<p><b>([^<]*)<br/>(<p>|</article>)', '<p><b>\\1<br/></b></p>\\2', 'g')"
    body = f"regexp_replace({body}, '<p><b>([^<]*)</p>', '<p><b>\\1</b></p>', 'g')"
    body = f"replace({body}, '&quot;', '\"')"
    body = f"replace(regexp_replace({body}, '&amp;?', '&', 'g'), '&', '&amp;')"
    return f"'<body>' || {body} || '</body>'"


_LANDING_KEY = (
    "replace(body, ' ', '_') || '/' || partition_date || '/' || replace(identifier, '/', '-') || '.' || file_type"
)
_FILE_NAME = "replace(replace(identifier, '/', '-'), ' ', '_') || '.' || file_type"

_DOCS = """doc_rows AS (
  SELECT 'D-' || CAST(doc_id AS VARCHAR) AS identifier, doc_id, lang, source, text,
    sha256(text) AS file_hash, sha256('old ' || text) AS other_hash
  FROM documents)"""
_STORED = """stored AS (
  SELECT identifier, source, CASE WHEN quality = 1 AND toxic = 1 THEN other_hash
    WHEN quality = 1 OR toxic = 1 THEN file_hash END AS file_hash
  FROM labels JOIN doc_rows USING (doc_id))"""
_CHANGES = """changes AS (
  SELECT d.identifier, d.file_hash, s.file_hash AS stored_hash,
    CASE WHEN s.identifier IS NULL THEN 'insert' WHEN s.file_hash IS NULL THEN 'insert_noop'
         WHEN s.file_hash IS NOT DISTINCT FROM d.file_hash THEN 'skip' ELSE 'update' END AS action
  FROM doc_rows d LEFT JOIN stored s ON d.identifier = s.identifier)"""

_FOLD = """users AS (
  SELECT c_custkey AS identifier, CASE WHEN c_acctbal > 5000 THEN 'view' END AS file_hash
  FROM customer WHERE c_acctbal >= 0),
arrivals AS (
  SELECT user_id AS identifier, event_id, CASE WHEN event_type <> 'error' THEN event_type END AS file_hash FROM events),
chain AS (
  SELECT identifier, event_id, file_hash, 1 AS seq FROM arrivals
  UNION ALL SELECT identifier, NULL, file_hash, 0 FROM users),
neighbours AS (
  SELECT *, lag(file_hash) OVER w AS prev, row_number() OVER w AS rn FROM chain
  WINDOW w AS (PARTITION BY identifier ORDER BY seq, event_id)),
folded AS (
  SELECT identifier, event_id, file_hash,
    CASE WHEN rn = 1 THEN 'insert' WHEN prev IS NULL THEN 'insert_noop'
         WHEN prev IS NOT DISTINCT FROM file_hash THEN 'skip' ELSE 'update' END AS action
  FROM neighbours WHERE seq = 1)"""

_BEFORE = """before AS (
  SELECT identifier, CASE WHEN contains(doc_url, '://blog.') THEN sha256(doc_url) ELSE sha256(html) END AS file_hash
  FROM page_rows WHERE partition_date BETWEEN '2024-01-01' AND '2024-06-30')"""
_UPSERTS = """upserts AS (
  SELECT p.*, sha256(p.html) AS file_hash,
    CASE WHEN b.identifier IS NULL THEN 'inserted' WHEN b.file_hash = sha256(p.html) THEN 'skipped' ELSE 'updated' END AS status
  FROM page_rows p LEFT JOIN before b ON p.identifier = b.identifier)"""

_ZONES = """landing AS (
  SELECT identifier, source, CASE WHEN lang <> 'es' THEN lang || '/' || identifier END AS file_path FROM doc_rows),
transformed AS (
  SELECT 'D-' || CAST(doc_id AS VARCHAR) AS identifier FROM labels
  UNION ALL SELECT 'B-' || CAST(item_id AS VARCHAR) FROM benchmark),
blobs AS (SELECT file_path FROM landing WHERE source <> 'src3' AND file_path IS NOT NULL)"""

_WEEK = "CAST(DATE '2024-01-01' + 7 * CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7.0) AS INTEGER) AS DATE)"
_OUTCOMES = f"""outcomes AS (
  SELECT event_type AS body, {_WEEK} AS partition_start,
    CAST({_WEEK} + 6 AS DATE) AS partition_end,
    'E-' || CAST(event_id AS VARCHAR) AS identifier,
    CASE WHEN value < 1 THEN 'request_failed' WHEN value < 3 THEN 'failed' WHEN value < 5 THEN 'no_url'
         WHEN value < 20 THEN 'skipped' ELSE 'landed' END AS outcome,
    '{SITE}/' || CAST(event_id AS VARCHAR) AS url, props AS error, user_id, value
  FROM events)"""
_STATS = _OUTCOMES + """,
captured AS (
  SELECT body, partition_start, partition_end, user_id + 1 AS page_number, count(*) * 100 AS page_total,
    CASE WHEN min(value) < 0.1 THEN 'timeout' END AS error
  FROM outcomes GROUP BY ALL),
totals AS (
  SELECT body, partition_start, partition_end, max(CASE WHEN page_number = 1 THEN page_total END) AS total_results,
    count(*) FILTER (error IS NULL) AS pages_captured
  FROM captured GROUP BY ALL),
counted AS (
  SELECT body, partition_start, partition_end,
    count(*) FILTER (outcome IN ('landed', 'failed', 'no_url')) AS records_scraped,
    count(*) FILTER (outcome = 'skipped') AS records_skipped,
    count(*) FILTER (outcome IN ('failed', 'request_failed')) AS records_failed
  FROM outcomes GROUP BY ALL),
types(body) AS (VALUES ('click'), ('error'), ('purchase'), ('refund'), ('signup'), ('view')),
last_day AS (SELECT max(partition_end) AS d FROM outcomes),
base AS (
  SELECT body, CAST(g AS DATE) AS partition_start, least(CAST(CAST(g AS DATE) + 6 AS DATE), d) AS partition_end
  FROM types, last_day, generate_series(TIMESTAMP '2024-01-01', CAST(d AS TIMESTAMP), INTERVAL 7 DAY) AS t(g)),
stat AS (
  SELECT base.body, base.partition_start, base.partition_end,
    CAST(coalesce(total_results, 0) AS BIGINT) AS total_results,
    CAST(coalesce(records_scraped, 0) AS BIGINT) AS records_scraped,
    CAST(coalesce(records_skipped, 0) AS BIGINT) AS records_skipped,
    CAST(coalesce(records_failed, 0) AS BIGINT) AS records_failed,
    CAST(coalesce(pages_captured, 0) AS BIGINT) AS pages_captured
  FROM base LEFT JOIN totals USING (body, partition_start, partition_end)
  LEFT JOIN counted USING (body, partition_start, partition_end))"""
_FAILED = "outcome IN ('failed', 'bad_item', 'request_failed')"
_TOP3 = f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY body, partition_start, partition_end ORDER BY url, error) AS rn
  FROM outcomes WHERE {_FAILED}),
top3 AS (
  SELECT body, partition_start, partition_end, count(*) AS n_shown,
    string_agg(url || ' ' || error, '; ' ORDER BY url, error) AS failed_urls,
    string_agg(chr(10) || '    FAILED: ' || url || ' — ' || error, '' ORDER BY url, error) AS failed_lines
  FROM ranked WHERE rn <= 3 GROUP BY ALL)"""
_DATES = "CAST(partition_start AS VARCHAR) AS partition_start, CAST(partition_end AS VARCHAR) AS partition_end"
_SUMS = ", ".join(
    f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("total_results", "records_scraped", "records_skipped", "records_failed")
)
_RUN_SUMS = """CAST(sum(total_results) AS BIGINT) AS total_expected, CAST(sum(records_scraped) AS BIGINT) AS total_scraped,
  CAST(sum(records_skipped) AS BIGINT) AS total_skipped, CAST(sum(records_failed) AS BIGINT) AS total_failed,
  count(*) AS partitions_processed"""

_PROPS = "replace(replace(error, '\\', '\\\\'), '\"', '\\\"')"

_LINES = """lines AS (
  SELECT 'run-' || CAST(user_id AS VARCHAR) AS file, event_id AS seq, event_type, value AS v, props,
    CASE event_type
      WHEN 'view' THEN '{"timestamp": "t", "level": "WARNING", "message": "Found ' || event_id || ' results"}'
      WHEN 'click' THEN CASE WHEN value < 2 THEN '{"a": 1}' ELSE '2024-01-01 10:00:00 [spider] INFO: Queueing: body=' || event_id || '  ' END
      WHEN 'error' THEN '  [spider]  ERROR: ' || chr(9) || ' Request failed: ' || props
      WHEN 'purchase' THEN ' ''' || CASE WHEN value < 5 THEN 'item_scraped_count' WHEN value < 10 THEN 'downloader/request_count'
        WHEN value < 15 THEN 'retry/count' WHEN value < 20 THEN 'log_count/ERROR' ELSE 'elapsed_time_seconds' END || ''': ' || event_id || ','
      ELSE CASE WHEN value < 5 THEN '5' WHEN value < 10 THEN '   ' ELSE '[spider] DEBUG: noise' END END AS value
  FROM events),
parsed AS (
  SELECT file, seq,
    CASE WHEN event_type = 'view' THEN 'WARNING' WHEN event_type = 'click' THEN 'INFO' WHEN event_type = 'error' THEN 'ERROR' END AS level,
    CASE WHEN event_type = 'view' THEN 'Found ' || seq || ' results'
         WHEN event_type = 'click' AND v < 2 THEN ''
         WHEN event_type IN ('click', 'error') THEN rtrim(regexp_extract(value, '\\]\\s+(INFO|ERROR|WARNING):\\s+(.+)$', 2)) END AS message
  FROM lines)"""


def _counter(name: str, alias: str) -> str:
    found = f"nullif(regexp_extract(value, '''{name}'':\\s*([\\d.]+)', 1), '')"
    return f"arg_min({found}, seq) FILTER ({found} IS NOT NULL) AS {alias}"


_LISTED = f"""listed AS (
  SELECT doc_id, lang, source, text, n_chars, CAST(doc_id // 10 AS INTEGER) AS page,
    CAST(DATE '2024-01-01' + to_months(CAST((doc_id // 10) % 12 AS INTEGER)) AS DATE) AS month,
    CASE WHEN source = 'src5' THEN 'n/a' ELSE strftime(CAST(DATE '2024-01-01' + CAST(n_chars % 366 AS INTEGER) AS DATE), '%d/%m/%Y') END AS published_date,
    CASE WHEN source = 'src5' THEN NULL ELSE strftime(CAST(DATE '2024-01-01' + CAST(n_chars % 366 AS INTEGER) AS DATE), '%Y-%m-%d') END AS published_date_iso,
    {_strip('text')} AS description,
    '{SITE}/cases/' || CAST(doc_id AS VARCHAR) || '.html' AS doc_url,
    CAST(row_number() OVER (PARTITION BY lang, doc_id // 10 ORDER BY doc_id) - 1 AS INTEGER) AS pos
  FROM documents)"""
# First arrival per identifier; the order is capture time (by page), month, language, page, position.
_FIRST = """outcome_rows AS (
  SELECT *, 'H-' || sha256(text) AS identifier,
    CASE WHEN source = 'src3' THEN 'failed' ELSE 'landed' END AS outcome,
    CASE lang WHEN 'en' THEN 'pdf' WHEN 'de' THEN 'doc' ELSE 'html' END AS ftype
  FROM listed WHERE source <> 'src9'),
first_rows AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY page, month, lang, pos) AS rn FROM outcome_rows)
  WHERE rn = 1)"""
_FIRST_HASH = f"CASE WHEN ftype = 'html' THEN sha256({_collapse('text')}) ELSE sha256(text) END"
_FIRST_PATH = "lang || '/' || CAST(month AS VARCHAR) || '/' || identifier || '.' || ftype"
_LANDING_STATE = _with(_LISTED, _FIRST) + f"""
SELECT identifier, description, published_date_iso, source AS ref_no, doc_url, lang AS body,
  CAST(month AS VARCHAR) AS partition_date,
  CASE WHEN outcome = 'landed' THEN {_FIRST_PATH} END AS file_path,
  CASE WHEN outcome = 'landed' THEN {_FIRST_HASH} END AS file_hash,
  CASE WHEN outcome = 'landed' THEN ftype ELSE 'unknown' END AS file_type
FROM first_rows"""

_INCREMENT = """landed_before AS (SELECT DISTINCT identifier FROM outcome_rows WHERE month <= DATE '2024-06-30'),
all_rows AS (
  SELECT *, 'H-' || sha256(text) AS identifier,
    CASE source WHEN 'src9' THEN 'pending' WHEN 'src3' THEN 'failed' ELSE 'landed' END AS outcome
  FROM listed),
fresh AS (
  SELECT *, min(CASE WHEN outcome = 'landed' THEN (page, month, lang, pos) END) OVER (PARTITION BY identifier) AS landed_at
  FROM all_rows WHERE identifier NOT IN (SELECT identifier FROM landed_before)),
marked AS (
  SELECT lang, CASE WHEN (page, month, lang, pos) > landed_at THEN 'skipped' ELSE outcome END AS outcome FROM fresh
  UNION ALL
  SELECT lang, 'skipped' FROM all_rows WHERE identifier IN (SELECT identifier FROM landed_before))"""

# Two runs, one per half-year.  The second does not skip what the first landed; it then
# compares: equal hashes leave the row alone, a failure nulls it, a null stays.
_HALVES = f"""halves AS (
  SELECT *, CASE WHEN outcome = 'landed' THEN {_FIRST_HASH} END AS h FROM (
    SELECT *, row_number() OVER (PARTITION BY identifier, month > DATE '2024-06-30' ORDER BY page, month, lang, pos) AS nth
    FROM outcome_rows) WHERE nth = 1),
final AS (
  SELECT * FROM halves a WHERE month <= DATE '2024-06-30' AND outcome = 'landed'
  UNION ALL
  SELECT * FROM halves b WHERE month > DATE '2024-06-30' AND NOT EXISTS (
    SELECT 1 FROM halves a WHERE a.month <= DATE '2024-06-30' AND a.identifier = b.identifier))"""

# HTML documents of more than 4,000 bytes do not land, those of more than 2,000 are not cleaned.
_BAD = """all_rows AS (
  SELECT *, 'H-' || sha256(text) AS identifier, CASE lang WHEN 'en' THEN 'pdf' WHEN 'de' THEN 'doc' ELSE 'html' END AS ftype,
    CASE source WHEN 'src9' THEN 'pending' WHEN 'src3' THEN 'failed' ELSE 'landed' END AS outcome
  FROM listed),
fresh AS (
  SELECT *, min(CASE WHEN outcome = 'landed' THEN (page, month, lang, pos) END) OVER (PARTITION BY identifier) AS landed_at FROM all_rows),
marked AS (
  SELECT *, CASE WHEN (page, month, lang, pos) > landed_at THEN 'skipped'
    WHEN outcome = 'landed' AND ftype = 'html' AND strlen(text) > 4000 THEN 'bad_item' ELSE outcome END AS kind FROM fresh),
statuses AS (
  SELECT *, CASE WHEN kind = 'failed' THEN 'no_path' WHEN ftype = 'html' AND strlen(text) > 2000 THEN 'clean_error' ELSE 'inserted' END AS status
  FROM (SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY page, month, lang, pos) AS nth FROM marked WHERE kind IN ('landed', 'failed'))
  WHERE nth = 1)"""


def _put_aside(zone: str, rows: str, limit: int) -> str:
    return f"""SELECT '{zone}', 'quarantined', 1, identifier, doc_url, lang, CAST(month AS VARCHAR),
  'ValueError: ' || strlen(text) || ' bytes, more than {limit}' FROM {rows}"""


_FLAGSHIP = _with(_PAGES, _BEFORE) + f"""
SELECT body, partition_date, count(*) AS n_pages, count(DISTINCT h) AS n_contents, min(h) AS min_hash
FROM (SELECT body, partition_date,
        CASE WHEN file_type = 'html' THEN sha256({_page_text('html')}) ELSE sha256(html) END AS h
      FROM page_rows p WHERE NOT EXISTS (SELECT 1 FROM before b WHERE b.identifier = p.identifier))
GROUP BY body, partition_date"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "flagship": _FLAGSHIP,
        "frontier_monthly": _frontier(_SUPPLIER_RANGES, "monthly"),
        "frontier_quarterly": _frontier(_SUPPLIER_RANGES, "quarterly"),
        "frontier_weekly": _frontier(_USER_RANGES, "weekly"),
        "sql_partitions": _with(_SUPPLIER_RANGES, _partitions("monthly")) + """
SELECT range_id, CAST(s AS VARCHAR) AS partition_start, strftime(e, '%d/%m/%Y') AS search_to FROM parts""",
        "frontier_size": _with(_SUPPLIER_RANGES) + """
SELECT range_id, CAST(4 * (date_diff('month', a, b) + 1) AS BIGINT) AS combinations FROM ranges""",
        "check_ranges": """
WITH texts AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN strftime(l_shipdate, '%d/%m/%Y') WHEN l_linenumber = 1 THEN ''
              ELSE strftime(l_shipdate, '%Y-%m-%d') END AS s,
    CASE WHEN l_linenumber = 2 THEN strftime(l_shipdate, '%Y') || '-02-30'
         ELSE strftime(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) - 25, '%Y-%m-%d') END AS e
  FROM lineitem),
typed AS (
  SELECT s, e, CASE WHEN s LIKE '____-__-__' THEN TRY_CAST(s AS DATE) END AS sd,
    CASE WHEN e LIKE '____-__-__' THEN TRY_CAST(e AS DATE) END AS ed FROM texts)
SELECT CASE WHEN s = '' OR e = '' THEN 'missing date' WHEN sd IS NULL THEN 'invalid start_date'
    WHEN ed IS NULL THEN 'invalid end_date' WHEN ed < sd THEN 'end before start' ELSE 'ok' END AS range_error,
  count(*) AS n_ranges
FROM typed GROUP BY 1""",
        "partition_assign_orders": """
WITH days AS (SELECT CAST(o_orderdate AS DATE) AS d, o_totalprice AS p, DATE '1994-12-15' AS a FROM orders),
months AS (SELECT *, date_diff('month', a, d) AS m FROM days),
starts AS (
  SELECT 'monthly' AS size, greatest(CAST(date_trunc('month', d) AS DATE), a) AS s, p FROM months
  UNION ALL SELECT 'weekly', CAST(a + 7 * CAST(floor(date_diff('day', a, d) / 7.0) AS INTEGER) AS DATE), p FROM months
  UNION ALL SELECT 'quarterly', greatest(CAST(DATE '1994-12-01' + to_months(CAST(m - m % 3 AS INTEGER)) AS DATE), a), p FROM months)
SELECT size, CAST(s AS VARCHAR) AS partition_start, count(*) AS n_orders, max(p) AS max_price FROM starts GROUP BY ALL""",
        "partition_counts_events": f"""
SELECT event_type, CAST({_WEEK} AS VARCHAR) AS partition_start, count(*) AS n_events FROM events GROUP BY ALL""",
        "iso_dates": """
WITH texts AS (
  SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN strftime(o_orderdate, '%d/%m/%Y')
    WHEN '2' THEN CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR)
    WHEN '3' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN '4' THEN o_orderstatus || '/x/y' ELSE '' END AS published_date
  FROM orders)
SELECT o_orderkey, published_date,
  CASE WHEN length(published_date) - length(replace(published_date, '/', '')) = 2
       THEN split_part(published_date, '/', 3) || '-' || split_part(published_date, '/', 2) || '-' || split_part(published_date, '/', 1)
  END AS published_date_iso,
  CASE WHEN published_date LIKE '__/__/____' THEN CAST(CAST(try_strptime(published_date, '%d/%m/%Y') AS DATE) AS VARCHAR) END AS published_dt
FROM texts""",
        "total_results": """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS total_results FROM orders""",
        "classify_and_key": _with(_PAGES) + f"""
SELECT identifier, file_type,
  CASE file_type WHEN 'html' THEN 'text/html' WHEN 'pdf' THEN 'application/pdf' ELSE 'application/msword' END AS mime_type,
  {_LANDING_KEY} AS file_path, {_FILE_NAME} AS file_name
FROM page_rows""",
        "normalize_text": f"SELECT page_id, {_page_text('html')} AS normalized_text FROM pages",
        "content_hash": _with(_PAGES) + f"""
SELECT identifier, file_type,
  CASE WHEN file_type = 'html' THEN sha256({_page_text('html')}) ELSE sha256(html) END AS file_hash
FROM page_rows""",
        "clean_main": f"""
SELECT page_id, c AS cleaned_html, sha256(c) AS file_hash FROM (SELECT page_id, {_page_clean('html')} AS c FROM pages)""",
        "transformed_bytes": _with(_PAGES) + f"""
SELECT identifier, file_type, CAST(strlen(c) AS BIGINT) AS length, sha256(c) AS file_hash
FROM (SELECT identifier, file_type, CASE WHEN file_type = 'html' THEN {_page_clean('html')} ELSE html END AS c FROM page_rows)""",
        "duplicate_content": f"""
SELECT file_hash, count(*) AS n_rows, min(doc_id) AS first_key
FROM (SELECT doc_id, sha256({_collapse('text')}) AS file_hash FROM documents) GROUP BY file_hash HAVING count(*) > 1""",
        "duplicate_identifiers": """
SELECT sha256(text) AS identifier, count(*) AS n_rows FROM documents GROUP BY text HAVING count(*) > 1""",
        "name_collisions": """
SELECT source || '-' || lang || '.html' AS file_path, count(DISTINCT doc_id // 10) AS n_identifiers
FROM documents GROUP BY 1 HAVING count(DISTINCT doc_id // 10) > 1""",
        "cleaning_rules": """
SELECT page_id, 'x Return to Search Page ' || page_id AS text,
  '<div id="main"><a href="/s"><i>x</i> Return to Search</a><input type="hidden" value="' || page_id || '"/><p>Page ' || page_id || '</p></div>' AS main
FROM pages""",
        "sql_html_functions": """
SELECT page_id, sha256('Page ' || page_id) AS html_hash,
  sha256('<html><body><script>s</script><p>Page <b>' || page_id || '</b></p></body></html>') AS pdf_hash,
  sha256('Page ' || page_id) AS other_hash, 'Page ' || page_id AS text, '<body><p>Page <b>' || page_id || '</b></p></body>' AS main
FROM pages""",
        "late_charset": "SELECT page_id, url || ' éü' || chr(145) AS text FROM pages",
        "strange_charsets": "SELECT page_id, url || ' é +AGE- \\ud800' AS text FROM pages",
        "skip_known": _with(_DOCS, _STORED) + """
SELECT identifier, source FROM doc_rows d WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.identifier = d.identifier)""",
        "skipped_known": _with(_DOCS, _STORED) + """
SELECT identifier, source FROM doc_rows d WHERE EXISTS (SELECT 1 FROM stored s WHERE s.identifier = d.identifier)""",
        "known_counts": _with(_DOCS) + """
SELECT source, count(l.doc_id) AS records_skipped, count(*) - count(l.doc_id) AS records_scraped
FROM doc_rows d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY source""",
        "dedup_first": _with(_DOCS) + """
SELECT file_hash, doc_id, lang, source FROM (
  SELECT *, row_number() OVER (PARTITION BY file_hash ORDER BY doc_id) AS rn FROM doc_rows) WHERE rn = 1""",
        "classify_changes": _with(_DOCS, _STORED, _CHANGES) + "SELECT identifier, file_hash, stored_hash, action FROM changes",
        "classify_repairs": _with(_DOCS, _STORED) + """
SELECT d.identifier, h AS file_hash, s.file_hash AS stored_hash,
  CASE WHEN s.identifier IS NULL THEN 'insert' WHEN h IS NULL OR s.file_hash = h THEN 'skip' ELSE 'update' END AS action
FROM (SELECT identifier, CASE WHEN lang <> 'fr' THEN file_hash END AS h FROM doc_rows) d
LEFT JOIN stored s ON d.identifier = s.identifier""",
        "apply_changes": _with(_DOCS, _STORED, _CHANGES) + """
SELECT identifier, CASE WHEN action IN ('insert', 'update') THEN file_hash ELSE stored_hash END AS file_hash,
  CASE WHEN action IN ('insert', 'update') THEN 1 ELSE 0 END AS version FROM changes""",
        "sink_counts": _with(_DOCS, _STORED, _CHANGES) + """
SELECT count(*) FILTER (action IN ('insert', 'insert_noop')) AS inserted, count(*) FILTER (action = 'update') AS updated,
  count(*) FILTER (action = 'skip') AS skipped FROM changes""",
        "fold_changes": _with(_FOLD) + "SELECT identifier, event_id, file_hash, action FROM folded",
        "fold_final": _with(_FOLD) + """
SELECT identifier, event_id, file_hash, action FROM (
  SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY event_id DESC) AS rn FROM folded
  WHERE action IN ('insert', 'update')) WHERE rn = 1""",
        "transform_upsert": _with(_PAGES, _BEFORE, _UPSERTS) + f"""
SELECT identifier, published_date, doc_url, body, partition_date, file_type, file_hash, {_FILE_NAME} AS file_path,
  {_LANDING_KEY} AS original_file_path, status FROM upserts""",
        "transform_counts": _with(_PAGES, _BEFORE, _UPSERTS) + """
SELECT count(*) FILTER (s = 'inserted') AS inserted, count(*) FILTER (s = 'updated') AS updated,
  count(*) FILTER (s = 'skipped') AS skipped, count(*) FILTER (s = 'failed') AS failed
FROM (SELECT CASE WHEN file_type = 'pdf' THEN 'failed' ELSE status END AS s FROM upserts)""",
        "source_hash_skip": _with(_PAGES, _BEFORE, _UPSERTS) + """
SELECT identifier, file_hash, partition_date FROM upserts WHERE status <> 'skipped'""",
        "reconcile_zones": _with(_DOCS, _ZONES) + """
SELECT coalesce(l.identifier, t.identifier) AS identifier, l.file_path AS landing_path,
  t.identifier || '.html' AS transformed_path,
  CASE WHEN l.identifier IS NULL THEN 'orphan' WHEN l.file_path IS NULL THEN 'no_path' WHEN b.file_path IS NULL THEN 'missing_blob'
       WHEN t.identifier IS NULL THEN 'pending' ELSE 'ok' END AS state
FROM landing l FULL JOIN transformed t ON l.identifier = t.identifier LEFT JOIN blobs b ON l.file_path = b.file_path""",
        "dangling_paths": _with(_DOCS, _ZONES) + """
SELECT identifier, file_path FROM landing l WHERE file_path IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM blobs b WHERE b.file_path = l.file_path)""",
        "present_paths": _with(_DOCS, _ZONES) + """
SELECT identifier, file_path FROM landing l WHERE EXISTS (SELECT 1 FROM blobs b WHERE b.file_path = l.file_path)""",
        "partition_stats": _with(_STATS) + f"""
SELECT body, {_DATES}, total_results, records_scraped, records_skipped, records_failed, pages_captured,
  total_results - (records_scraped + records_skipped) AS missing_results FROM stat""",
        "crawl_rollup": _with(_STATS) + f"""
SELECT body, CAST(partition_start AS VARCHAR) AS partition_start, {_SUMS}, count(*) AS partitions
FROM stat GROUP BY ROLLUP (body, partition_start)""",
        "crawl_summary": _with(_STATS) + f"""
SELECT 'crawl_complete' AS event, 'finished' AS reason, *, 'Crawl summary: {{"event":"crawl_complete","reason":"finished","total_expected":'
  || total_expected || ',"total_scraped":' || total_scraped || ',"total_skipped":' || total_skipped || ',"total_failed":'
  || total_failed || ',"partitions_processed":' || partitions_processed || '}}' AS message
FROM (SELECT {_RUN_SUMS} FROM stat)""",
        "failed_urls": _with(_OUTCOMES) + f"SELECT body, {_DATES}, url, error FROM outcomes WHERE {_FAILED}",
        "failed_urls_top3": _with(_OUTCOMES, _TOP3) + f"SELECT body, {_DATES}, failed_urls FROM top3",
        "unfinished_partitions": _with(_STATS) + f"""
SELECT body, {_DATES} FROM stat WHERE NOT (pages_captured > 0 AND records_failed = 0)""",
        "failure_events": _with(_OUTCOMES) + f"""
SELECT body, {_DATES}, 'ERROR' AS level,
  CASE WHEN outcome = 'failed' THEN 'Document download failed: {{"event":"document_download_failed","identifier":"' || identifier || '",'
       ELSE 'Request failed: {{"event":"request_failed",' END
  || '"url":"' || url || '","error":"' || {_PROPS} || '","body":"' || body || '","partition":"' || CAST(partition_start AS VARCHAR) || '"}}' AS message
FROM outcomes WHERE outcome IN ('failed', 'request_failed')""",
        "summary_format": _with(_STATS, _TOP3) + f"""
SELECT body || ' | ' || CAST(partition_start AS VARCHAR) || ' to ' || CAST(partition_end AS VARCHAR) || ' | found: ' || total_results
  || ', new: ' || records_scraped || ', skipped: ' || records_skipped || ', failed: ' || records_failed
  || coalesce(failed_lines, '') AS summary
FROM stat LEFT JOIN top3 USING (body, partition_start, partition_end)
UNION ALL
SELECT 'Crawl complete | partitions: ' || partitions_processed || ', found: ' || total_expected || ', new: ' || total_scraped
  || ', skipped: ' || total_skipped || ', failed: ' || total_failed
FROM (SELECT {_RUN_SUMS} FROM stat)""",
        "partition_history": _with(_STATS) + f"""
SELECT body, {_DATES}, total_results, records_scraped, records_skipped, records_failed, url, error
FROM stat LEFT JOIN (SELECT body, partition_start, partition_end, url, error FROM outcomes WHERE {_FAILED})
USING (body, partition_start, partition_end)""",
        "run_history": _with(_STATS) + f"""
SELECT 'crawl_complete' AS event, body AS reason, {_RUN_SUMS} FROM stat GROUP BY body""",
        "parse_logs": _with(_LINES) + "SELECT seq, level, message FROM parsed",
        "shown_logs": _with(_LINES) + """
SELECT seq, level, message, CASE level WHEN 'ERROR' THEN 'error' WHEN 'WARNING' THEN 'warning' ELSE 'info' END AS channel
FROM parsed WHERE contains(message, 'Found') OR contains(message, 'Queueing:') OR contains(message, 'Request failed')""",
        "log_levels": _with(_LINES) + """
SELECT CASE level WHEN 'ERROR' THEN 'error' WHEN 'WARNING' THEN 'warning' ELSE 'info' END AS channel, count(*) AS n_lines
FROM parsed WHERE message <> '' GROUP BY 1""",
        "log_stats": _with(_LINES) + f"""
SELECT file, {_counter('item_scraped_count', 'items')}, {_counter('elapsed_time_seconds', 'elapsed')},
  {_counter('downloader/request_count', 'requests')}, {_counter('retry/count', 'retries')}, {_counter('log_count/ERROR', 'errors')}
FROM lines GROUP BY file""",
        "extract_listing": _with(_LISTED) + f"""
SELECT 'D-' || CAST(doc_id AS VARCHAR) AS identifier, description, published_date, published_date_iso, source AS ref_no,
  doc_url, lang AS body, CAST(month AS VARCHAR) AS partition_date, page + 1 AS page_number, pos, '{RUN_TS}' AS scraped_at
FROM listed WHERE source <> 'src7'""",
        "rejected_items": _with(_LISTED) + """
SELECT doc_url, lang AS body, CAST(month AS VARCHAR) AS partition_date, pos FROM listed WHERE source = 'src7'""",
        "page_totals": _with(_LISTED) + f"""
SELECT '{SITE}/en/search/?body=' || lang || '&pageNumber=' || (page + 1) AS url, page + 1 AS page_number,
  count(*) AS page_total, '{SITE}/en/search/?body=' || lang || '&pageNumber=' || (page + 2) AS next_url
FROM listed GROUP BY lang, page""",
        "next_page_frontier": _with(_LISTED) + f"""
SELECT '{SITE}/en/search/?body=' || lang || '&pageNumber=' || (page + 2) AS url, lang AS body,
  CAST(min(month) AS VARCHAR) AS partition_start, page + 2 AS page_number
FROM listed l WHERE NOT EXISTS (SELECT 1 FROM listed n WHERE n.lang = l.lang AND n.page = l.page + 1)
GROUP BY lang, page""",
        "landing_state": _LANDING_STATE,
        "landing_stream": _LANDING_STATE,
        "landing_stream_late": _LANDING_STATE,
        "objects_by_key": _with(_LISTED, _FIRST) + f"""
SELECT {_FIRST_PATH} AS file_path, sha256(text) AS content_hash,
  CASE ftype WHEN 'pdf' THEN 'application/pdf' WHEN 'doc' THEN 'application/msword' ELSE 'text/html' END AS content_type,
  strlen(text) AS length
FROM first_rows WHERE outcome = 'landed' AND source = 'src2' AND strlen(text) > 0""",
        "bad_documents": _with(_LISTED, _BAD) + f"""
SELECT 'landing' AS zone, kind, count(*) AS n_rows, NULL::VARCHAR AS identifier, NULL::VARCHAR AS url, NULL::VARCHAR AS body,
  NULL::VARCHAR AS partition_date, NULL::VARCHAR AS error FROM marked WHERE kind <> 'pending' GROUP BY kind
UNION ALL SELECT 'transformed', status, count(*), NULL, NULL, NULL, NULL, NULL FROM statuses GROUP BY status
UNION ALL {_put_aside('landing', "marked WHERE kind = 'bad_item'", 4000)}
UNION ALL {_put_aside('transformed', "statuses WHERE status = 'clean_error'", 2000)}""",
        "landing_range": _with(_LISTED, _FIRST) + f"""
SELECT identifier, CAST(month AS VARCHAR) AS partition_date,
  CASE WHEN outcome = 'landed' THEN {_FIRST_HASH} END AS file_hash
FROM first_rows WHERE month BETWEEN DATE '2024-04-01' AND DATE '2024-06-30'""",
        "hash_update_counts": _with(_LISTED, _FIRST) + f""",
stored AS (
  SELECT identifier, CASE WHEN outcome = 'landed' THEN {_FIRST_HASH} END AS h FROM (
    SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY page, month, lang, pos) AS nth
    FROM outcome_rows WHERE month <= DATE '2024-06-30') WHERE nth = 1),
chain AS (
  SELECT identifier, 1 AS seq, page, month, lang, pos, CASE WHEN outcome = 'landed' THEN {_FIRST_HASH} END AS h FROM outcome_rows
  UNION ALL SELECT identifier, 0, NULL, NULL, NULL, NULL, h FROM stored),
steps AS (
  SELECT *, lag(h) OVER w AS prev, row_number() OVER w AS nth FROM chain
  WINDOW w AS (PARTITION BY identifier ORDER BY seq, page, month, lang, pos))
SELECT count(*) FILTER (nth = 1 OR prev IS NULL) AS inserted,
  count(*) FILTER (nth > 1 AND prev IS NOT NULL AND prev IS DISTINCT FROM h) AS updated,
  count(*) FILTER (nth > 1 AND prev IS NOT NULL AND prev IS NOT DISTINCT FROM h) AS skipped
FROM steps WHERE seq = 1""",
        "transform_rerun": _with(_LISTED, _FIRST) + """
SELECT CASE WHEN outcome <> 'landed' THEN 'no_path' WHEN month <= DATE '2024-06-30' THEN 'skipped' ELSE 'inserted' END AS status,
  count(*) AS n_rows FROM first_rows GROUP BY 1""",
        "transform_stream": _with(_LISTED, _FIRST, _HALVES) + """
SELECT CAST(month AS VARCHAR) AS partition_date, ftype AS file_type, count(*) AS n_rows
FROM final WHERE outcome = 'landed' GROUP BY ALL""",
        "landing_increment": _with(_LISTED, _FIRST, _INCREMENT) + """
SELECT lang AS body, outcome, count(*) AS n_rows FROM marked WHERE outcome <> 'pending' GROUP BY ALL""",
        "transformed_state": _with(_LISTED, _FIRST) + f"""
SELECT identifier, description, source AS ref_no, doc_url, lang AS body, CAST(month AS VARCHAR) AS partition_date,
  ftype AS file_type,
  sha256(CASE WHEN ftype = 'html' THEN '<body>' || replace(text, '&', '&amp;') || '</body>' ELSE text END) AS file_hash,
  identifier || '.' || ftype AS file_path, {_FIRST_PATH} AS original_file_path, {_FIRST_HASH} AS original_file_hash
FROM first_rows WHERE outcome = 'landed'""",
    }
    return {name: re.sub(r"[ \t]+\n", "\n", text).strip() for name, text in sql.items()}
