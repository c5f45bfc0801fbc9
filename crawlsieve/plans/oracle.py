"""Independent DuckDB SQL for the derived fixtures and every checked query.

These strings are the correctness oracle: they restate each operator in
plain SQL over the pre-registered views (``pages``, ``documents``, ...).
"""

from __future__ import annotations

from html.entities import html5

# Whitespace class shared with the Spark side (RE2 syntax).
WS = r"[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

CDX_CTE = r"""
cdx_ranked AS (
  SELECT page_id, url, 0 AS crawl_rank FROM pages WHERE page_id % 3 = 0 OR page_id % 5 <> 1
  UNION ALL
  SELECT page_id, url, 1 AS crawl_rank FROM pages WHERE page_id % 3 = 0 OR page_id % 5 = 1
),
cdx_parts AS (
  SELECT page_id, url, crawl_rank,
    array_to_string(list_reverse(string_split(regexp_extract(url, '^[a-z]+://([^/]+)', 1), '.')), ',')
      || ')' || regexp_extract(url, '^[a-z]+://[^/]+(/.*)$', 1) AS surt,
    strftime(make_timestamp(CAST(1720915200 + page_id * 7919 + crawl_rank * 2592000 AS BIGINT) * 1000000),
             '%Y%m%d%H%M%S') AS ts,
    CASE (page_id + crawl_rank) % 10 WHEN 7 THEN '404' WHEN 8 THEN '301' ELSE '200' END AS status,
    CASE WHEN page_id % 11 = 4 THEN ''
         ELSE ', "languages": "' || CASE WHEN page_id % 13 = 6 THEN 'ind,' ELSE '' END
              || CASE regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]*)', 1)
                   WHEN 'en' THEN 'eng' WHEN 'fr' THEN 'fra' WHEN 'de' THEN 'deu' ELSE 'spa' END
              || '"' END AS languages
  FROM cdx_ranked
),
cdx AS (
  SELECT CASE crawl_rank WHEN 0 THEN 'CC-MAIN-2024-30' ELSE 'CC-MAIN-2024-33' END AS crawl,
         CAST(crawl_rank AS INTEGER) AS crawl_rank,
         CAST(page_id // 25 AS INTEGER) AS block_id,
         CAST(page_id % 25 AS INTEGER) AS line_no,
         surt || ' ' || ts || ' ' ||
         CASE WHEN (page_id + crawl_rank) % 37 = 5 THEN '{"url": "broken'
              ELSE '{"url": "' || url || '", "status": "' || status || '"' || languages
                   || ', "length": "' || CAST(length(url) AS VARCHAR)
                   || '", "offset": "' || CAST(page_id * 1000 AS VARCHAR)
                   || '", "filename": "warc/' || CAST(page_id % 8 AS VARCHAR) || '.warc.gz"}' END AS line
  FROM cdx_parts
),
cdx_parsed AS (
  SELECT crawl, crawl_rank, block_id, line_no, line,
         split_part(line, ' ', 1) AS surt_url,
         split_part(line, ' ', 2) AS "timestamp",
         CASE WHEN len(string_split(line, ' ')) >= 3 THEN substr(line, length(split_part(line, ' ', 1)) + length(split_part(line, ' ', 2)) + 3) END AS js
  FROM cdx
),
cdx_meta AS (
  SELECT *, coalesce(CASE WHEN json_valid(js) THEN json_type(js) = 'OBJECT' ELSE false END, false) AS is_obj
  FROM cdx_parsed
),
cdx_outcome AS (
  SELECT crawl, crawl_rank, block_id, line_no, line, surt_url, "timestamp", js,
    CASE WHEN NOT is_obj THEN 'parse_error'
         WHEN NOT coalesce(list_contains(list_transform(string_split(json_extract_string(js, '$.languages'), ','), lambda x: trim(x)), 'eng'), false) THEN 'language'
         WHEN coalesce(json_extract_string(js, '$.status'), '') <> '200' THEN 'status'
         ELSE 'pass' END AS outcome
  FROM cdx_meta
),
passed AS (
  SELECT * FROM cdx_outcome WHERE outcome = 'pass'
),
ranked_first AS (
  SELECT *, row_number() OVER (PARTITION BY surt_url ORDER BY crawl_rank, block_id, line_no) AS dup_rn
  FROM passed
),
kept AS (
  SELECT * EXCLUDE (dup_rn) FROM ranked_first WHERE dup_rn = 1
)
"""


def with_cdx(body: str) -> str:
    return "WITH " + CDX_CTE.strip() + "\n" + body


def _meta(k: str) -> str:
    return f"CASE WHEN outcome <> 'parse_error' THEN json_extract_string(js, '$.{k}') END"


_FILTER = "SELECT crawl, block_id, line_no, surt_url FROM cdx_outcome WHERE {pred}"
_LANG_TOKEN = ("outcome <> 'parse_error' AND coalesce(list_contains(list_transform(string_split("
               "json_extract_string(js, '$.languages'), ','), lambda x: trim(x)), 'eng'), false)")

ORACLE: dict[str, str] = {
    "cdx_parse": with_cdx(f"""
SELECT crawl, block_id, line_no, surt_url, "timestamp",
       {_meta('url')} AS url, {_meta('status')} AS status,
       {_meta('languages')} AS languages, {_meta('filename')} AS filename,
       outcome = 'parse_error' AS parse_error
FROM cdx_outcome"""),
    "cdx_typed_metadata": with_cdx("""
SELECT crawl, block_id, line_no, json_extract_string(js, '$.url') AS url,
       TRY_CAST(json_extract_string(js, '$.status') AS INTEGER) AS status,
       TRY_CAST(json_extract_string(js, '$.length') AS BIGINT) AS length,
       TRY_CAST(json_extract_string(js, '$.offset') AS BIGINT) AS "offset",
       json_extract_string(js, '$.filename') AS filename,
       json_extract_string(js, '$.languages') AS languages
FROM cdx_outcome WHERE outcome <> 'parse_error'"""),
    "surt_normalize": with_cdx("""
SELECT crawl, block_id, line_no, surt_url AS key_from_pair, surt_url AS key_plain FROM cdx_outcome"""),
    "filter_language_contains": with_cdx(_FILTER.format(
        pred="outcome <> 'parse_error' AND coalesce(contains(json_extract_string(js, '$.languages'), 'eng'), false)")),
    "filter_language_token": with_cdx(_FILTER.format(pred=_LANG_TOKEN)),
    "filter_status": with_cdx(_FILTER.format(
        pred="outcome <> 'parse_error' AND coalesce(json_extract_string(js, '$.status') = '200', false)")),
    "filter_status_numeric": with_cdx(_FILTER.format(
        pred="outcome <> 'parse_error' AND coalesce(TRY_CAST(json_extract_string(js, '$.status') AS INTEGER) = 200, false)")),
    "filter_malformed": with_cdx(_FILTER.format(pred="outcome <> 'parse_error'")),
    "filter_crawl_name": with_cdx("""
SELECT crawl, CAST(count(*) AS BIGINT) AS n FROM cdx GROUP BY crawl"""),
    "funnel_index": with_cdx("""
, k AS (SELECT crawl, count(*) AS kept FROM kept GROUP BY crawl)
SELECT o.crawl,
       CAST(count(*) AS BIGINT) AS total,
       CAST(count(*) FILTER (WHERE outcome = 'parse_error') AS BIGINT) AS parse_error,
       CAST(count(*) FILTER (WHERE outcome = 'language') AS BIGINT) AS language,
       CAST(count(*) FILTER (WHERE outcome = 'status') AS BIGINT) AS status,
       CAST(count(*) FILTER (WHERE outcome = 'pass') - coalesce(any_value(k.kept), 0) AS BIGINT) AS duplicate,
       CAST(coalesce(any_value(k.kept), 0) AS BIGINT) AS kept
FROM cdx_outcome o LEFT JOIN k ON o.crawl = k.crawl GROUP BY o.crawl"""),
    "dedup_first_seen": with_cdx("""
SELECT crawl, block_id, line_no, crawl_rank, surt_url, "timestamp", json_extract_string(js, '$.url') AS url FROM kept"""),
    "dedup_stats": with_cdx("""
SELECT CAST(count(*) AS BIGINT) AS processed, CAST(count(DISTINCT surt_url) AS BIGINT) AS unique_urls,
       CAST(count(*) - count(DISTINCT surt_url) AS BIGINT) AS skipped FROM passed"""),
    "dedup_latest": with_cdx("""
SELECT crawl, block_id, line_no, crawl_rank, surt_url, "timestamp" FROM (
  SELECT *, row_number() OVER (PARTITION BY surt_url ORDER BY "timestamp" DESC, crawl_rank DESC, block_id DESC, line_no DESC) AS rn FROM passed)
WHERE rn = 1"""),
    "dedup_incremental": with_cdx("""
SELECT crawl, block_id, line_no, surt_url, "timestamp" FROM (
  SELECT *, row_number() OVER (PARTITION BY surt_url ORDER BY crawl_rank, block_id, line_no) AS rn
  FROM passed WHERE crawl_rank = 1 AND surt_url NOT IN (SELECT surt_url FROM passed WHERE crawl_rank = 0))
WHERE rn = 1"""),
    "batch_fixed_size": with_cdx("""
SELECT crawl, block_id, line_no, surt_url,
       CAST((row_number() OVER (PARTITION BY crawl ORDER BY block_id, line_no) - 1) // 50 AS BIGINT) AS batch_no
FROM kept"""),
    "batch_per_block": with_cdx("""
SELECT crawl, block_id, line_no, surt_url,
       CAST((row_number() OVER (PARTITION BY crawl, block_id ORDER BY line_no) - 1) // 10 AS BIGINT) AS batch_no
FROM passed"""),
    "batch_messages": with_cdx("""
, b AS (
  SELECT *, (row_number() OVER (PARTITION BY crawl ORDER BY block_id, line_no) - 1) // 50 AS batch_no,
         '{"surt_url":"' || surt_url || '","timestamp":"' || "timestamp" || '","metadata":'
           || replace(replace(js, '": "', '":"'), '", "', '","') || '}' AS j
  FROM kept)
SELECT crawl, CAST(batch_no AS BIGINT) AS batch_no, CAST(count(*) AS BIGINT) AS n,
       '[' || string_agg(j, ',' ORDER BY block_id, line_no) || ']' AS body
FROM b GROUP BY crawl, batch_no"""),
    "batch_counts": with_cdx("""
SELECT crawl, CAST(ceil(count(*) / 50.0) AS BIGINT) AS batches FROM kept GROUP BY crawl"""),
    "batch_item_stats": with_cdx("""
SELECT crawl, CAST(batch_no AS BIGINT) AS batch_no, CAST(count(*) AS BIGINT) AS n_items FROM (
  SELECT crawl, (row_number() OVER (PARTITION BY crawl ORDER BY block_id, line_no) - 1) // 50 AS batch_no FROM kept)
GROUP BY crawl, batch_no"""),
}


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_C1 = {0x80: 0x20AC, 0x82: 0x201A, 0x83: 0x0192, 0x84: 0x201E, 0x85: 0x2026, 0x86: 0x2020,
       0x87: 0x2021, 0x88: 0x02C6, 0x89: 0x2030, 0x8A: 0x0160, 0x8B: 0x2039, 0x8C: 0x0152,
       0x8E: 0x017D, 0x91: 0x2018, 0x92: 0x2019, 0x93: 0x201C, 0x94: 0x201D, 0x95: 0x2022,
       0x96: 0x2013, 0x97: 0x2014, 0x98: 0x02DC, 0x99: 0x2122, 0x9A: 0x0161, 0x9B: 0x203A,
       0x9C: 0x0153, 0x9E: 0x017E, 0x9F: 0x0178}


# Named references from the standard library's table, looked up in a DuckDB map.
_NAMES = dict(sorted(html5.items()))
_SHORT = "|".join(sorted((n for n in _NAMES if not n.endswith(";")), key=len, reverse=True))
_MAP = "MAP {" + ", ".join(f"{k!r}: chr({ord(v)})" if len(v) == 1 else f"{k!r}: chr({ord(v[0])}) || chr({ord(v[1])})"
                           for k, v in _NAMES.items()) + "}"
_ENT_RE = "&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"


def _sql_ref_char(r: str) -> str:
    body = f"regexp_replace({r}, ';$', '')"
    digits = f"regexp_replace({body}, '^#[xX]?0*', '')"
    num = (f"(CASE WHEN length({digits}) > 7 THEN -1 WHEN lower({body}) LIKE '#x%' THEN coalesce(TRY_CAST('0x' || {digits} AS BIGINT), 0) "
           f"ELSE coalesce(TRY_CAST({digits} AS BIGINT), 0) END)")
    c1 = " ".join(f"WHEN {k} THEN {v}" for k, v in _C1.items())
    n = f"(CASE {num} {c1} ELSE {num} END)"
    cp = f"(CASE WHEN {n} > 0 AND {n} <= 1114111 AND NOT ({n} BETWEEN 55296 AND 57343) THEN {n} ELSE 65533 END)"
    short = f"regexp_extract({r}, '^({_SHORT})')"
    named = (f"coalesce(names[{r}], CASE WHEN {short} <> '' THEN names[{short}] || substr({r}, length({short}) + 1) ELSE '&' || {r} END)")
    return f"CASE WHEN starts_with({r}, '#') THEN chr(CAST({cp} AS INTEGER)) ELSE {named} END"


def sql_decode_entities(x: str) -> str:
    pieces = f"regexp_split_to_array({x}, {_sql_str(_ENT_RE)})"
    chars = f"list_transform(regexp_extract_all({x}, {_sql_str(_ENT_RE)}, 1), lambda r: {_sql_ref_char('r')})"
    chars = f"(SELECT {chars} FROM (SELECT {_MAP} AS names))"
    joined = (f"array_to_string(list_transform(list_zip({pieces}, list_concat({chars}, [''])), "
              f"lambda z: coalesce(z[1], '') || coalesce(z[2], '')), '')")
    return f"CASE WHEN contains({x}, '&') THEN {joined} ELSE {x} END"


def sql_strip(x: str, patterns) -> str:
    for p in patterns:
        x = f"regexp_replace({x}, {_sql_str(p)}, '', 'g')"
    return x


_SCRIPT = r"(?is)<script\b[^>]*>.*?(</script\s*>|\z)"
_STYLE = r"(?is)<style\b[^>]*>.*?(</style\s*>|\z)"
_COMMENT = r"(?s)<!--.*?(-->|\z)"
_TAG = r"<(/?[A-Za-z][^>]*|[!?][^>]*)(>|\z)"


# One tag: attributes with quotes only around whole values, else any character but '>'.
_ATTRS = r"""(?:[\s/](?:[\s/]+|[^\s>/=]+(?:\s*=\s*(?:"[^"]*(?:"|\z)|'[^']*(?:'|\z)|[^\s>"'][^\s>]*))?|[^>])*)?(?:>|\z)"""
_SCRUB = "(?is)" + "|".join(
    [rf"<{e}{_ATTRS}{c}(?:</{e}(?:[\s/][^>]*)?(?:>|\z)|\z)" for e, c in
     (("script", ".*?"), ("style", ".*?"), ("textarea", "(.*?)"), ("title", "(.*?)"))]
    + [r"<!--(?:-?>|.*?(?:--!?>|\z))", r"</?[a-z][^\s/>]*" + _ATTRS, r"<[!?][^>]*(?:>|\z)", r"</[^a-z>][^>]*(?:>|\z)"])


def sql_flat_text(col: str) -> str:
    inner = sql_decode_entities(f"regexp_replace({col}, {_sql_str(_SCRUB)}, '\\1\\2', 'g')")
    return f"coalesce(trim(regexp_replace({inner}, '{WS}+', ' ', 'g')), '')"


_DROP = ("script", "style", "noscript", "template", "nav", "header", "footer", "aside", "form")
_BLOCK = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "br", "div", "ul", "ol",
          "blockquote", "pre", "td", "th", "tr", "table", "section", "article", "main",
          "title", "body", "html", "head", "hr", "dd", "dt", "dl", "figcaption")


def sql_main_text(col: str, include_tables: bool = True, lines_only: bool = False) -> str:
    drops = list(_DROP) + ([] if include_tables else ["table"])
    art = f"array_to_string(regexp_extract_all({col}, '(?is)<article\\b[^>]*>(.*?)(</article\\s*>|\\z)', 1), '\n')"
    x = sql_strip(art, [_COMMENT] + [rf"(?is)<{t}\b[^>]*>.*?(</{t}\s*>|\z)" for t in drops])
    x = f"regexp_replace({x}, '(?i)</?({'|'.join(_BLOCK)})\\b[^>]*>', chr(10), 'g')"
    x = sql_decode_entities(sql_strip(x, [_TAG]))
    lines = f"list_filter(list_transform(string_split({x}, chr(10)), lambda l: trim(regexp_replace(l, '{WS}+', ' ', 'g'))), lambda l: l <> '')"
    if lines_only:
        return lines
    return f"nullif(array_to_string({lines}, chr(10)), '')"


ORACLE.update({
    "extract_flat_text": f"SELECT page_id, {sql_flat_text('html')} AS text FROM pages",
    "filter_nonblank": f"SELECT doc_id FROM documents WHERE coalesce(regexp_matches(text, '[^{WS[1:]}'), false)",
    "filter_length": "SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars FROM documents WHERE length(text) BETWEEN 500 AND 1000000",
    "extract_main_text": f"SELECT page_id, {sql_main_text('html')} AS text FROM pages",
    "extract_main_text_strict": f"""
SELECT page_id, nullif(array_to_string(list_filter(ls, lambda x, i: list_position(ls, x) = i), chr(10)), '') AS text
FROM (SELECT page_id, {sql_main_text('html', include_tables=False, lines_only=True)} AS ls FROM pages)""",
})


# Markup that is easy to get wrong, per page; the text is put together from the
# parts, not taken from the markup.
ORACLE["extract_flat_text_markup"] = """
SELECT page_id, 'hello ' || page_id || ' more text kept' || page_id || ' tail → α ⋅ ¬in ∉ ✓ ' || chr(39) || 'x a<b>c' || page_id
       || ' T & T©2024 &nosuch; &am <3 1 < 2 end' || CASE WHEN page_id % 3 = 0 THEN '' ELSE ' cut' END AS text
FROM pages"""

_HTTP_RAW = ("'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) "
             "|| 'Content-Length: ' || CAST(strlen(html) AS VARCHAR) || "
             "CASE WHEN page_id % 41 = 2 THEN '' WHEN page_id % 7 = 3 THEN chr(10) || chr(10) "
             "ELSE chr(13) || chr(10) || chr(13) || chr(10) END || html")
_HTTP_RE = r"(?s)^(.*?)(\r\n\r\n|\n\n)"

ORACLE.update({
    "http_body_split": f"""
SELECT page_id,
       CASE WHEN m <> '' THEN regexp_extract(raw, '{_HTTP_RE}', 1) END AS head,
       CASE WHEN m <> '' THEN substr(raw, length(m) + 1) END AS body
FROM (SELECT page_id, raw, regexp_extract(raw, '{_HTTP_RE}', 0) AS m
      FROM (SELECT page_id, {_HTTP_RAW} AS raw FROM pages))""",
    "document_records": with_cdx(f"""
, docs AS (
  SELECT k.surt_url, k."timestamp", json_extract_string(k.js, '$.filename') AS filename,
         {sql_flat_text('p.html')} AS full_text
  FROM kept k JOIN pages p ON p.url = json_extract_string(k.js, '$.url'))
SELECT coalesce(surt_url, 'unknown') AS url, coalesce("timestamp", 'unknown') AS "timestamp", full_text,
       CAST(length(full_text) AS INTEGER) AS char_count, filename
FROM docs
WHERE coalesce(regexp_matches(full_text, '[^{WS[1:]}'), false) AND length(full_text) BETWEEN 500 AND 1000000"""),
})


_BLOCKS = """
, blk AS (
  SELECT crawl, crawl_rank, CAST(block_id + 1 AS BIGINT) AS bid, line_no, line,
         'cdx-' || lpad(CAST(block_id // 4096 AS VARCHAR), 5, '0') || '.gz' AS cdx_filename
  FROM cdx),
blk_idx AS (
  SELECT crawl, any_value(crawl_rank) AS crawl_rank, bid, any_value(cdx_filename) AS cdx_filename,
         split_part(min_by(line, line_no), ' ', 1) AS start_key,
         split_part(min_by(line, line_no), ' ', 2) AS start_ts
  FROM blk GROUP BY crawl, bid)
"""

_HTTP_RAW_P = _HTTP_RAW.replace("html", "p.html").replace("page_id", "p.page_id")

_RECORDS = f"""
WITH raw AS (
  SELECT page_id, url, 'warc/' || CAST(page_id % 8 AS VARCHAR) || '/' || lpad(CAST(page_id // 4096 AS VARCHAR), 5, '0') || '.warc.gz' AS filename,
         {_HTTP_RAW} AS raw,
         'GET ' || regexp_extract(url, '^[a-z]+://[^/]+(/.*)$', 1) || ' HTTP/1.1' || chr(13) || chr(10) || 'Host: '
           || regexp_extract(url, '^[a-z]+://([^/]+)', 1) || chr(13) || chr(10) || chr(13) || chr(10) AS req,
         'fetchTimeMs: ' || CAST(page_id % 997 AS VARCHAR) || chr(13) || chr(10) AS meta
  FROM pages),
recs AS (
  SELECT page_id, url, filename, 0 AS record_no, 'request' AS warc_type, req AS payload FROM raw
  UNION ALL SELECT page_id, url, filename, 1, 'response', raw FROM raw
  UNION ALL SELECT page_id, url, filename, 2, 'metadata', meta FROM raw),
split AS (
  SELECT *, regexp_extract(payload, '{_HTTP_RE}', 0) AS m FROM recs)
"""

ORACLE.update({
    "block_index_scan": with_cdx(_BLOCKS + """
SELECT crawl, start_key, start_ts, cdx_filename, bid AS block_id FROM blk_idx"""),
    "block_index_rejects": with_cdx(_BLOCKS + """
SELECT crawl, CASE bid % 4 WHEN 0 THEN '"' || start_key ELSE start_key END AS start_key,
       CASE bid % 4 WHEN 1 THEN 'too_few_fields' WHEN 2 THEN 'bad_offset' WHEN 3 THEN 'bad_length'
            ELSE 'valid_quoted' END AS reason
FROM blk_idx"""),
    "multi_crawl_union": with_cdx(_BLOCKS + """
SELECT crawl, CAST(1 - crawl_rank AS INTEGER) AS crawl_rank, bid AS block_id, start_key FROM blk_idx"""),
    "cdx_block_scan": with_cdx(_BLOCKS + """
SELECT crawl, bid AS block_id,
       CAST(row_number() OVER (PARTITION BY crawl, bid ORDER BY line_no) - 1 AS INTEGER) AS line_no, line
FROM blk"""),
    "block_limit": with_cdx(_BLOCKS + """
SELECT crawl, bid AS block_id,
       CAST(row_number() OVER (PARTITION BY crawl, bid ORDER BY line_no) - 1 AS INTEGER) AS line_no, line
FROM blk WHERE bid <= 4"""),
    "cdx_block_failures": with_cdx(_BLOCKS + """
SELECT crawl, bid AS block_id,
       CASE bid % 5 WHEN 1 THEN 'BadGzipFile' WHEN 2 THEN 'FileNotFoundError' ELSE 'EOFError' END AS error
FROM blk_idx WHERE bid % 5 IN (1, 2, 3)"""),
    "errors_by_type": with_cdx(_BLOCKS + """
SELECT CASE bid % 5 WHEN 1 THEN 'BadGzipFile' WHEN 2 THEN 'FileNotFoundError' ELSE 'EOFError' END AS error_type,
       CAST(count(*) AS BIGINT) AS n
FROM blk_idx WHERE bid % 5 IN (1, 2, 3) GROUP BY 1"""),
    "bytes_by_file": with_cdx(_BLOCKS + """
SELECT crawl, cdx_filename AS file, CAST(count(DISTINCT bid) AS BIGINT) AS n_ranges,
       CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes_decompressed
FROM blk GROUP BY crawl, cdx_filename"""),
    "total_blocks": with_cdx(_BLOCKS + """
SELECT crawl, CAST(max(bid) AS BIGINT) AS total_blocks FROM blk_idx GROUP BY crawl"""),
    "batch_message_explode": with_cdx("""
SELECT crawl, CAST((rn - 1) // 50 AS BIGINT) AS batch_no, CAST((rn - 1) % 50 AS INTEGER) AS item_no,
       surt_url, "timestamp", json_extract_string(js, '$.url') AS url
FROM (SELECT *, row_number() OVER (PARTITION BY crawl ORDER BY block_id, line_no) AS rn FROM kept)"""),
    "warc_record_scan": _RECORDS + """
SELECT page_id, filename, CAST(record_no AS INTEGER) AS record_no, warc_type, url AS target_uri,
       CAST(strlen(payload) AS BIGINT) AS content_length,
       CASE WHEN warc_type = 'response' AND m = '' THEN 'no_body' END AS error
FROM split""",
    "filter_warc_response": _RECORDS + """
SELECT page_id, url AS target_uri, CASE WHEN m <> '' THEN substr(payload, length(m) + 1) END AS body,
       CASE WHEN m = '' THEN 'no_body' END AS error
FROM split WHERE warc_type = 'response'""",
    "funnel_documents": _RECORDS + f"""
, t AS (
  SELECT filename, warc_type,
         CASE WHEN warc_type = 'response' THEN {sql_flat_text("CASE WHEN m <> '' THEN substr(payload, length(m) + 1) END")} END AS text
  FROM split),
f AS (
  SELECT *, coalesce(regexp_matches(text, '[^{WS[1:]}'), false) AS nb,
         coalesce(length(text) BETWEEN 500 AND 1000000, false) AS kl FROM t)
SELECT filename,
       CAST(count(*) // 3 AS BIGINT) AS ranges_fetched, CAST(0 AS BIGINT) AS download_errors,
       CAST(count(*) AS BIGINT) AS records_total,
       CAST(count(*) FILTER (WHERE warc_type = 'response') AS BIGINT) AS responses,
       CAST(count(*) FILTER (WHERE warc_type = 'response') AS BIGINT) AS extractions_attempted,
       CAST(count(*) FILTER (WHERE warc_type = 'response' AND nb) AS BIGINT) AS extractions_nonblank,
       CAST(count(*) FILTER (WHERE warc_type = 'response' AND nb AND NOT kl) AS BIGINT) AS filtered_length,
       CAST(count(*) FILTER (WHERE warc_type = 'response' AND nb AND kl) AS BIGINT) AS extractions_successful
FROM f GROUP BY filename""",
})


_FOLD = """
WITH RECURSIVE d AS (
  SELECT doc_id, doc_id % 4 AS lane, length(text) AS len,
         row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) AS rn
  FROM documents WHERE length(text) BETWEEN 500 AND 1000000),
f(lane, rn, doc_id, len, batch_no, docs, size) AS (
  SELECT lane, rn, doc_id, len, 0, 1, len * 1.5 FROM d WHERE rn = 1
  UNION ALL
  SELECT d.lane, d.rn, d.doc_id, d.len,
         CASE WHEN f.docs >= 10 OR f.size >= 40000 THEN f.batch_no + 1 ELSE f.batch_no END,
         CASE WHEN f.docs >= 10 OR f.size >= 40000 THEN 1 ELSE f.docs + 1 END,
         CASE WHEN f.docs >= 10 OR f.size >= 40000 THEN d.len * 1.5 ELSE f.size + d.len * 1.5 END
  FROM f JOIN d ON d.lane = f.lane AND d.rn = f.rn + 1)
"""

ORACLE.update({
    "batch_threshold": _FOLD + "SELECT doc_id, lane, CAST(batch_no AS BIGINT) AS upload_batch_no FROM f",
    "batch_stats": _FOLD + """
SELECT lane, CAST(batch_no AS BIGINT) AS upload_batch_no, CAST(count(*) AS BIGINT) AS n_items,
       CAST(sum(len * 1.5) AS DOUBLE) AS est_bytes
FROM f GROUP BY lane, batch_no""",
})


_DOC_SQL = ORACLE["document_records"]

ORACLE.update({
    "document_sink_roundtrip": _DOC_SQL.replace(
        "CAST(length(full_text) AS INTEGER) AS char_count, filename",
        "CAST(length(full_text) AS INTEGER) AS char_count, filename, substr(\"timestamp\", 1, 4) AS year, "
        "substr(\"timestamp\", 5, 2) AS month, substr(\"timestamp\", 7, 2) AS day, true AS token_count_ok"),
    "batch_sink_roundtrip": ORACLE["batch_message_explode"],
    "resume_pending_blocks": with_cdx(_BLOCKS + """
SELECT crawl, bid AS block_id FROM blk_idx WHERE bid % 5 IN (1, 2, 3)"""),
    "crawl_progress": with_cdx(_BLOCKS + """
SELECT crawl, CAST(count(*) AS BIGINT) AS total_blocks,
       CAST(count(*) FILTER (WHERE bid % 5 NOT IN (1, 2, 3)) AS BIGINT) AS done_blocks,
       CAST(round(100.0 * count(*) FILTER (WHERE bid % 5 NOT IN (1, 2, 3)) / count(*), 4) AS DOUBLE) AS progress_percent,
       (SELECT CAST(ceil(count(*) / 50.0) AS BIGINT) FROM kept WHERE kept.crawl = blk_idx.crawl) AS batches_published
FROM blk_idx GROUP BY crawl"""),
    "crawl_status": with_cdx(_BLOCKS + """
SELECT crawl, CASE WHEN any_value(crawl_rank) = 1 THEN 'pending'
                   WHEN count(*) FILTER (WHERE bid % 5 IN (1, 2, 3)) > 0 THEN 'error' ELSE 'completed' END AS status
FROM blk_idx GROUP BY crawl"""),
})
ORACLE["run_summary"] = ORACLE["crawl_status"].replace(
    "SELECT crawl, CASE", "SELECT status, CAST(count(*) AS BIGINT) AS n_crawls FROM (SELECT crawl, CASE", 1) + ") GROUP BY status"


ORACLE.update({
    "worker_stream": with_cdx(f"""
, docs AS (
  SELECT k.surt_url, k."timestamp", 'warc/' || CAST(p.page_id % 8 AS VARCHAR) || '/' || lpad(CAST(p.page_id // 4096 AS VARCHAR), 5, '0') || '.warc.gz' AS filename, p.raw,
         regexp_extract(p.raw, '{_HTTP_RE}', 0) AS m
  FROM kept k JOIN (SELECT page_id, url, {_HTTP_RAW} AS raw FROM pages) p
    ON p.url = json_extract_string(k.js, '$.url')),
txt AS (
  SELECT surt_url, "timestamp", filename, {sql_flat_text('substr(raw, length(m) + 1)')} AS full_text
  FROM docs WHERE m <> '')
SELECT surt_url AS url, "timestamp", full_text, CAST(length(full_text) AS INTEGER) AS char_count, filename,
       true AS token_count_ok
FROM txt
WHERE coalesce(regexp_matches(full_text, '[^{WS[1:]}'), false) AND length(full_text) BETWEEN 500 AND 1000000"""),
    "stream_dedup": ORACLE["dedup_first_seen"],
})

ORACLE["batcher_job"] = ORACLE["batch_message_explode"]
ORACLE["worker_job"] = ORACLE["worker_stream"]
ORACLE["batcher_two_runs"] = ORACLE["batch_message_explode"]
ORACLE["funnel_incremental"] = ORACLE["funnel_index"] + " HAVING any_value(o.crawl_rank) = 1"
ORACLE.update({
    # block 1 of the index is the first block of a crawl; each run numbers its batches from 0
    "batch_counts_two_runs": with_cdx("""
, b AS (SELECT crawl, crawl_rank, block_id, dense_rank() OVER (PARTITION BY crawl ORDER BY block_id) AS id
        FROM (SELECT DISTINCT crawl, crawl_rank, block_id FROM cdx)),
two AS (SELECT p.*, CASE WHEN b.id = 1 THEN 1 ELSE 2 END AS run
        FROM passed p JOIN b ON b.crawl = p.crawl AND b.block_id = p.block_id),
won AS (SELECT *, row_number() OVER (PARTITION BY surt_url ORDER BY run, crawl_rank, block_id, line_no) AS rn FROM two)
SELECT crawl, CAST(sum(n) AS BIGINT) AS batches FROM (
  SELECT crawl, run, ceil(count(*) / 50.0) AS n FROM won WHERE rn = 1 GROUP BY crawl, run) GROUP BY crawl"""),
    "status_after_repair": with_cdx("""
SELECT DISTINCT crawl, 'error' AS status, 1 AS run FROM cdx
UNION ALL SELECT DISTINCT crawl, 'completed' AS status, 2 AS run FROM cdx"""),
    # after the reset the second crawl runs alone against the first one's seen keys
    "reset_reruns_blocks": with_cdx("""
, n AS (SELECT crawl, count(*) AS items FROM kept GROUP BY crawl)
SELECT o.crawl, 'completed' AS status, CAST(any_value(n.items) AS BIGINT) AS items,
       CAST(CASE WHEN any_value(o.crawl_rank) = 1 THEN count(*) ELSE 0 END AS BIGINT) AS lines_again
FROM cdx_outcome o LEFT JOIN n ON n.crawl = o.crawl GROUP BY o.crawl"""),
})

ORACLE["sink_audit"] = ("SELECT status, true AS has_batches, CAST(CASE status WHEN 'ok' THEN n ELSE 0 END AS BIGINT) AS rows "
                        "FROM (SELECT count(*) AS n FROM (" + ORACLE["worker_stream"] + ")), (VALUES ('attempt'), ('ok')) v(status)")
ORACLE["worker_job_twice"] = ("SELECT url, \"timestamp\", full_text, char_count, filename FROM (" + ORACLE["worker_stream"] + ")")
ORACLE["worker_rejects"] = with_cdx("""
SELECT outcome, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE length(p.url) % 5 WHEN 1 THEN 'EOFError' WHEN 2 THEN 'FileNotFoundError'
              ELSE CASE WHEN p.page_id % 41 = 2 THEN 'no_body' ELSE 'ok' END END AS outcome
  FROM kept k JOIN pages p ON p.url = json_extract_string(k.js, '$.url')) GROUP BY outcome""")


ORACLE["extract_strict_dedup"] = "WITH t AS (" + ORACLE["extract_main_text_strict"] + """),
b AS (SELECT page_id, unnest(string_split(text, chr(10))) AS block, generate_subscripts(string_split(text, chr(10)), 1) AS pos
      FROM t WHERE text IS NOT NULL),
f AS (SELECT block FROM b WHERE length(block) >= 20 GROUP BY block HAVING count(DISTINCT page_id) > 2)
SELECT t.page_id, k.text FROM t LEFT JOIN (
  SELECT page_id, string_agg(block, chr(10) ORDER BY pos) AS text FROM b WHERE block NOT IN (SELECT block FROM f) GROUP BY page_id) k
  ON k.page_id = t.page_id"""

# --- whole runs ---------------------------------------------------------------------

ORACLE["worker_stream_commits"] = ORACLE["worker_after_reset"] = ORACLE["worker_job_twice"]

# documents as run_worker lays them out: lanes are (crawl, day), in order of (url, timestamp)
_UPLOADS = """
WITH RECURSIVE w AS (SELECT * FROM (""" + ORACLE["worker_job_twice"] + """)),
o AS (SELECT w.*, k.crawl, length(full_text) AS len,
        row_number() OVER (PARTITION BY k.crawl, substr(w."timestamp", 1, 8) ORDER BY w.url, w."timestamp") AS rn
      FROM w JOIN (""" + with_cdx("SELECT crawl, surt_url, \"timestamp\" FROM kept") + """) k
        ON k.surt_url = w.url AND k."timestamp" = w."timestamp"),
f(crawl, day, rn, url, len, batch_no, docs, size) AS (
  SELECT crawl, substr("timestamp", 1, 8), rn, url, len, 0, 1, len * 1.5 FROM o WHERE rn = 1
  UNION ALL
  SELECT o.crawl, f.day, o.rn, o.url, o.len,
         CASE WHEN f.docs >= 10 OR f.size >= 40000 THEN f.batch_no + 1 ELSE f.batch_no END,
         CASE WHEN f.docs >= 10 OR f.size >= 40000 THEN 1 ELSE f.docs + 1 END,
         CASE WHEN f.docs >= 10 OR f.size >= 40000 THEN o.len * 1.5 ELSE f.size + o.len * 1.5 END
  FROM f JOIN o ON o.crawl = f.crawl AND substr(o."timestamp", 1, 8) = f.day AND o.rn = f.rn + 1)
"""
ORACLE["worker_upload_files"] = _UPLOADS + """
SELECT crawl, substr(day, 1, 4) AS year, substr(day, 5, 2) AS month, substr(day, 7, 2) AS day, CAST(count(*) AS BIGINT) AS docs,
       CAST(sum(len * 1.5) AS DOUBLE) AS est_bytes, min(url) AS first_url
FROM f GROUP BY crawl, f.day, batch_no"""

ORACLE["batch_times"] = _UPLOADS + """
SELECT CAST(count(o.url) AS BIGINT) AS rows, true AS timed
FROM (""" + with_cdx("SELECT DISTINCT crawl FROM kept") + """) c LEFT JOIN o ON o.crawl = c.crawl GROUP BY c.crawl"""

ORACLE["sink_outcomes"] = with_cdx("""
, n AS (SELECT crawl, ceil(count(*) / 50.0) AS n FROM kept GROUP BY crawl)
SELECT * FROM (
  SELECT 'stage-one' AS run_id, 'batches' AS sink, CAST(2 AS BIGINT) AS attempts, CAST(1 AS BIGINT) AS retries,
         CAST(1 AS BIGINT) AS ok, CAST(1 AS BIGINT) AS failed, CAST(0 AS BIGINT) AS lost, CAST(sum(n) AS BIGINT) AS rows FROM n
  UNION ALL
  SELECT 'stage-one', 'ledger', 2, 1, 2, 0, 0, CAST(2 * count(*) AS BIGINT) FROM (SELECT DISTINCT crawl, block_id FROM cdx)
  UNION ALL
  SELECT 'stage-two', 'documents', 1, 0, 1, 0, 0, (SELECT count(*) FROM (""" + ORACLE["worker_job_twice"] + """)))""")

# the same fold as batch_threshold; a batch says by its own rows why it closed
ORACLE["worker_stream_batches"] = _FOLD + """
SELECT lane, CAST(batch_no AS BIGINT) AS upload_batch_no,
       CASE WHEN count(*) >= 10 THEN 'count' WHEN sum(len * 1.5) >= 40000 THEN 'bytes' ELSE 'flush' END AS reason,
       CAST(count(*) AS BIGINT) AS docs, CAST(sum(len * 1.5) AS DOUBLE) AS est_bytes
FROM f GROUP BY lane, batch_no"""
