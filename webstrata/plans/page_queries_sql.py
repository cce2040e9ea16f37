"""What each page query has to give, as DuckDB SQL over the ``pages`` table.

Nothing is parsed here: the values follow from the page number, the URL and the HTML
as ``page_crawl`` defines them.
"""

from __future__ import annotations

from ..functions.urls import DEFAULT_PAGE_TYPES, DEFAULT_PAGES
from ..operators.filters import MEDIA_EXTENSIONS, URL_REJECT
from ..schema import BAD_HEADER, TRUNCATED, UNWRITTEN_SIZE, VERSION
from .page_crawl import META, ODD_LINKS, XML
from .page_queries import HEADS, PHRASES

_CRLF = "chr(13) || chr(10)"

# ``cap``: the crawl. ``doc`` is the whole record as text.
_CAP = f"""
base AS (
  SELECT p.page_id, p.url, p.html, p.page_id % 10 = 0 AS is_seed,
         repeat('L', CAST(p.page_id % 10 AS INTEGER)) AS path,
         '10.0.' || (p.page_id % 7) || '.' || (p.page_id % 251) AS ip,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(p.page_id) AS ts,
         CAST(CASE p.page_id % 20 WHEN 0 THEN 404 WHEN 1 THEN 301 ELSE 200 END AS INTEGER) AS status,
         CASE p.page_id % 5 WHEN 0 THEN 'text/html; charset=utf-8' WHEN 1 THEN 'Text/HTML; Charset="ISO8859-1"'
              WHEN 2 THEN 'application/xhtml+xml; charset=UTF8' WHEN 3 THEN 'text/html' END AS header,
         CASE p.page_id % 5 WHEN 0 THEN 'text/html' WHEN 1 THEN 'text/html' WHEN 2 THEN 'application/xhtml+xml'
              WHEN 3 THEN 'text/html' END AS content_type,
         CASE p.page_id % 5 WHEN 0 THEN 'UTF-8' WHEN 1 THEN 'ISO-8859-1' WHEN 2 THEN 'UTF-8'
              WHEN 3 THEN 'WINDOWS-1252' ELSE 'KOI8-R' END AS charset,
         CASE p.page_id % 5 WHEN 3 THEN '{META}' WHEN 4 THEN '{XML}' ELSE '' END || p.html AS body,
         regexp_extract(p.url, '^[a-z]+://([^/?#]+)', 1) AS host,
         regexp_extract(p.url, '^([a-z]+)://', 1) AS scheme,
         regexp_extract(p.url, '^[a-z]+://[^/?#]+', 0) AS root,
         regexp_extract(p.url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS upath
  FROM pages p),
linked AS (
  SELECT b.*, v.url AS via, CASE WHEN b.is_seed THEN '' ELSE s.url END AS seed_url
  FROM base b
  LEFT JOIN pages v ON v.page_id = b.page_id - 1 AND NOT b.is_seed
  LEFT JOIN pages s ON s.page_id = b.page_id - b.page_id % 10 AND NOT b.is_seed),
parts AS (
  SELECT *, nullif(regexp_extract(upath, '\\.([^./]*)$', 1), '') AS extension,
         strftime(ts, '%Y%m%d%H%M%S') AS digits, strftime(ts, '%Y-%m-%d %H:%M:%S') AS crawl_time,
         strftime(ts, '%Y-%m-%d') AS crawl_date,
         'GET / HTTP/1.0' || {_CRLF} || 'Host: ' || lower(host) || {_CRLF} || {_CRLF} AS request,
         'HTTP/1.1 ' || status || ' ' || CASE status WHEN 404 THEN 'Not Found' WHEN 301 THEN 'Moved Permanently' ELSE 'OK' END
           || {_CRLF} || 'X-Powered-By: PHP/5.2.0' || {_CRLF}
           || coalesce('Content-Type: ' || header || {_CRLF}, '')
           || 'Connection: close' || {_CRLF} || {_CRLF} || body AS response
  FROM linked),
cap AS (
  SELECT *, '{VERSION}' || {_CRLF} AS magic,
         'URL: ' || url || {_CRLF} || 'Ip-Address: ' || ip || {_CRLF} || 'Crawl-Time: ' || digits || {_CRLF}
           || 'Is-Seed: ' || CASE WHEN is_seed THEN 'true' ELSE 'false' END || {_CRLF} AS fixed,
         CASE WHEN path <> '' THEN 'Path-From-Seed: ' || path || {_CRLF} ELSE '' END AS path_line
  FROM parts),
docs AS (
  SELECT *,
         magic || fixed || 'Seed-Url: ' || {_CRLF} || path_line || {_CRLF} || request || response AS doc,
         magic || fixed || 'Seed-Url: ' || seed_url || {_CRLF} || path_line
           || coalesce('Via: ' || via || {_CRLF}, '') || {_CRLF} || request || response AS full_doc
  FROM cap)
"""


def _from_crawl(select: str) -> str:
    return f"WITH {_CAP}\n{select}"


_PARSED_COLUMNS = f"""url AS uri, '{VERSION}' AS version, url, ip, crawl_time, is_seed, nullif(path, '') AS path_from_seed,
       via, nullif(seed_url, '') AS seed_url, scheme, extension, md5(request) AS request_md5, md5(response) AS response_md5,
       md5(body) AS body_md5, status, content_type, charset, CAST(NULL AS VARCHAR) AS error,
       CAST(4 + (CASE WHEN is_seed THEN 0 ELSE 3 END) AS INTEGER) AS n_fields"""

_RAW = "SELECT url AS uri, md5({doc}) AS doc_md5, CAST(strlen({doc}) AS INTEGER) AS bytes FROM docs"

_ODD_URL = """CASE page_id % 8 WHEN 0 THEN 'dns:' || lower(host) WHEN 1 THEN root || '/robots.txt'
       WHEN 2 THEN root || '/s' || page_id || '.css' WHEN 3 THEN root || '/j' || page_id || '.js'
       WHEN 4 THEN root || '/i' || page_id || '.JPG?a=b.c' WHEN 5 THEN root || '/d.x/f' || page_id || '.pdf#p.1'
       ELSE url END"""
_ODD_EXTENSION = """CASE page_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 'txt' WHEN 2 THEN 'css' WHEN 3 THEN 'js'
       WHEN 4 THEN 'jpg' WHEN 5 THEN 'pdf' ELSE extension END"""

_VARIANT = """CASE page_id % 6 WHEN 0 THEN root WHEN 1 THEN root || '/a/INDEX.Php#x' WHEN 2 THEN root || '/a/default.asp?q=/b.c#x'
       WHEN 3 THEN regexp_replace(root, '//(www\\.)?', '//') || substr(url, length(root) + 1)
       WHEN 4 THEN 'no url' ELSE url END"""


def _canonical(source: str, url: str, keep: str) -> str:
    """CTEs ``canon(keep..., u, canonical)`` by the four steps of the rule."""
    pages = "|".join(DEFAULT_PAGES)
    types = "|".join(DEFAULT_PAGE_TYPES)
    return f"""
ca AS (SELECT {keep}, {url} AS u FROM {source}),
cb AS (SELECT *, regexp_extract(u, '^([^/?#]*/[^/?#]*/)([^?#]*)(\\?[^#]*)?', 1) AS pre,
              regexp_extract(u, '^([^/?#]*/[^/?#]*/)([^?#]*)(\\?[^#]*)?', 2) AS p,
              regexp_extract(u, '^([^/?#]*/[^/?#]*/)([^?#]*)(\\?[^#]*)?', 3) AS q FROM ca),
cc AS (SELECT *, regexp_replace(p, '(?i)/({pages})\\.({types})$', '/') AS p2 FROM cb),
cd AS (SELECT *, CASE WHEN q = '' AND p <> p2 THEN p2 WHEN p <> '' AND p NOT LIKE '%/%' THEN p || '/'
                      WHEN regexp_matches(p, '/[^/.]+$') THEN p || '/' ELSE p END AS p3 FROM cc),
canon AS (SELECT *, CASE WHEN pre = '' THEN NULL
                         ELSE pre || CASE WHEN lower(p3) LIKE 'www.%' THEN '' ELSE 'www.' END || p3 || q END AS canonical FROM cd)
"""


# Links: ``plain`` are those of the page itself, ``odd`` the ones put behind it.
_ODD_KINDS = [
    # href, or None for "no link"; kind of target
    ("'x' || page_id || '.html'", "dir || href"),
    ("'/r'", "broot || href"),
    ("'q.html'", "dir || href"),
    ("'../u'", "parent || 'u'"),
    ("'#f'", "broot || bpath || bquery || href"),
    ("'?k=' || page_id", "broot || bpath || href"),
    ("'//c.com/y'", "bscheme || ':' || href"),
    ("'http://b.com'", "'http://b.com/'"),
    ("'https://b.com/z'", "href"),
    ("'http://b.com/m/../n'", "'http://b.com/n'"),
    ("'mailto:m@a.com'", "href"),
    ("'http://[bad'", "NULL"),
    (None, None),
    (None, None),
    (None, None),  # another element
    ("'v'", "dir || href"),
    ("'w'", "dir || href"),
]
# Position of each odd tag among the ``a`` tags behind the page's own.
_A_POSITION = {k: sum(not t.lower().startswith("<abbr") for t in ODD_LINKS[:k]) for k in range(len(ODD_LINKS))}

_ODD_LINKS = "\nUNION ALL ".join(
    f"SELECT page_id, url, base_url, bscheme, broot, bpath, bquery, dir, parent, n + {_A_POSITION[k]} AS pos, {href} AS href, {k} AS kind FROM hosts"
    for k, (href, _) in enumerate(_ODD_KINDS)
    if href is not None
)
_LINKS = f"""
{_CAP},
bases AS (
  SELECT *, CASE WHEN page_id % 4 = 3 THEN 'http://z' || (page_id % 3) || '.com/k/' ELSE url END AS base_url,
         len(regexp_extract_all(html, '(?i)<a(?:\\s[^>]*)?>')) AS n
  FROM base),
hosts AS (
  SELECT *, bdir AS dir, regexp_replace(bdir, '[^/]+/$', '') AS parent
  FROM (SELECT *, regexp_extract(base_url, '^([a-z]+)://', 1) AS bscheme,
               regexp_extract(base_url, '^[a-z]+://[^/?#]+', 0) AS broot,
               regexp_extract(base_url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS bpath,
               regexp_extract(base_url, '^[^?#]*(\\?[^#]*)', 1) AS bquery,
               regexp_extract(base_url, '^[a-z]+://[^/?#]+', 0) || regexp_extract(base_url, '^[a-z]+://[^/?#]+([^?#]*/)', 1) AS bdir
        FROM bases)),
plain AS (
  SELECT page_id, url, base_url, bscheme, broot, bpath, bquery, dir, parent, pos - 1 AS pos, href, -1 AS kind
  FROM (SELECT h.*, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS href,
               generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">', 1), 1) AS pos FROM hosts h)),
odd AS ({_ODD_LINKS}),
links AS (SELECT * FROM plain UNION ALL SELECT * FROM odd),
resolved AS (
  SELECT *, CASE {" ".join(f"WHEN kind = {k} THEN {target}" for k, (_, target) in enumerate(_ODD_KINDS) if target)}
                 ELSE broot || href END AS target_url FROM links),
judged AS (
  SELECT *, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS src_host,
         CASE WHEN target_url IS NULL THEN NULL
              ELSE coalesce(regexp_extract(target_url, '^[a-z]+://([^/?#]+)', 1) = regexp_extract(url, '^[a-z]+://([^/?#]+)', 1), FALSE)
         END AS is_internal FROM resolved)
"""

# All attributes of the odd tags: position, attribute number, name, value.
_ODD_ATTRIBUTES = [
    (0, 1, "href", "'x' || page_id || '.html'"), (1, 1, "href", "'/r'"), (2, 1, "href", "'q.html'"), (3, 1, "href", "'../u'"),
    (4, 1, "href", "'#f'"), (5, 1, "href", "'?k=' || page_id"), (6, 1, "href", "'//c.com/y'"), (7, 1, "href", "'http://b.com'"),
    (8, 1, "href", "'https://b.com/z'"), (9, 1, "href", "'http://b.com/m/../n'"), (10, 1, "href", "'mailto:m@a.com'"),
    (11, 1, "href", "'http://[bad'"), (12, 1, "name", "'top'"), (13, 1, "hreflang", "'en'"),
    (14, 1, "disabled", "CAST(NULL AS VARCHAR)"), (14, 2, "href", "'v'"), (15, 1, "class", "'c'"), (15, 2, "href", "'w'"),
]
_ATTRIBUTES = "\nUNION ALL ".join(
    f"SELECT page_id, CAST(n + {pos} AS INTEGER) AS pos, {at} AS attr_pos, '{name}' AS name, {value} AS value FROM hosts"
    for pos, at, name, value in _ODD_ATTRIBUTES
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TAGS = "\nUNION ALL ".join(
    f"SELECT page_id, CAST(n + {_A_POSITION[k]} AS INTEGER) AS pos, replace({_quoted(tag)}, '{{id}}', CAST(page_id AS VARCHAR)) AS tag FROM hosts"
    for k, tag in enumerate(ODD_LINKS)
    if not tag.lower().startswith("<abbr")
)

_MEDIA = ", ".join(f"'{x}'" for x in MEDIA_EXTENSIONS)
_PAGE_WORDS = """SELECT page_id, page_id % 5 AS kind, words[page_id % 50 + 9] AS v, words[page_id % 70 + 10] AS w
  FROM (SELECT page_id, string_split(trim(regexp_replace(html, '[^A-Za-z]+', ' ', 'g')), ' ') AS words FROM pages)"""
_OTHER_DAY = "(SELECT *, strftime(ts + to_days(CAST(page_id % 7 AS INTEGER)), '%Y-%m-%d') AS day FROM cap)"
_ROLLED = "CAST(0 AS BIGINT) AS rolled_late, CAST(0 AS BIGINT) AS rolled_early"
_HEAD_CHARSETS = ("WINDOWS-1251", "KOI8-R", None, None, None, "ISO-8859-2", "UTF-8")
_TEXT_LINE = f"html || {_CRLF}"
_NARROW = "regexp_replace(html, '[^\\x00-\\x7e\\xa0-\\xff]', '?', 'g')"
_RECRAWL_PAGE = "CASE WHEN page_id % 3 = 0 THEN 0 ELSE page_id % 40 END"

ORACLES: dict[str, str] = {
    "scan_archive": _from_crawl(_RAW.format(doc="full_doc")),
    "scan_multi": _from_crawl(
        "SELECT CASE WHEN page_id % 2 = 0 THEN 'even, 1' ELSE '{odd}' END AS crawl, r.* FROM docs, LATERAL (SELECT url AS uri,"
        " md5(doc) AS doc_md5, CAST(strlen(doc) AS INTEGER) AS bytes) r"
    ),
    "scan_table": _from_crawl(
        f"SELECT url AS uri, day AS crawl_date, charset, CAST(strlen(body) AS INTEGER) AS body_bytes FROM {_OTHER_DAY}"
        " WHERE status = 200"
    ),
    "parse_where": _from_crawl(
        f"SELECT page_id, url AS uri, status, charset, day FROM {_OTHER_DAY}"
        " WHERE status <> 404 AND page_id >= 20 AND day BETWEEN '2024-01-04' AND '2024-01-05'"
    ),
    "scan_single_docs": _from_crawl(
        "SELECT url, status, charset, CAST(strlen(body) AS INTEGER) AS body_bytes, md5(body) AS body_md5 FROM cap"
    ),
    "skip_open_files": _from_crawl(_RAW.format(doc="doc") + " WHERE page_id % 9 < 3"),
    "sink_archive": _from_crawl(_RAW.format(doc="doc")),
    "sink_archive_rolling": _from_crawl(f"SELECT count(*) AS records, CAST(sum(strlen(doc) + 4) AS BIGINT) AS bytes, {_ROLLED} FROM docs"),
    "sink_compression": _from_crawl(
        "SELECT k AS compression, stored, r.* FROM (" + _RAW.format(doc="doc") + ") r,"
        " (VALUES ('NONE', 'NONE'), ('RECORD', 'RECORD'), ('BLOCK', 'BLOCK'), ('DEFAULT', 'BLOCK')) AS kinds(k, stored)"
    ),
    "sink_counts": _from_crawl(
        """SELECT sink, count(*) AS records, CAST(sum(CASE WHEN sink LIKE 'archive%' THEN strlen(doc) + 4 WHEN sink = 'rolling' THEN strlen(doc)
    WHEN sink IN ('table', 'stream') THEN strlen(request) + strlen(response) ELSE strlen(body) END) AS BIGINT) AS bytes
FROM docs, (VALUES ('archive'), ('archive by task'), ('rolling'), ('table'), ('stream'), ('written'), ('rejected')) AS sinks(sink)
WHERE sink NOT IN ('written', 'rejected') OR (strlen(body) > 3000) = (sink = 'rejected') GROUP BY 1"""
    ),
    "sink_table": _from_crawl(f"SELECT {_PARSED_COLUMNS}, crawl_date FROM cap"),
    "sink_rolling": _from_crawl(f"SELECT count(*) AS records, CAST(sum(strlen(doc)) AS BIGINT) AS bytes, {_ROLLED} FROM docs"),
    "named_fields": _from_crawl(
        "SELECT page_id, url, ip AS ip_address, digits AS crawl_time, CASE WHEN is_seed THEN 'true' ELSE 'false' END AS is_seed,"
        " seed_url, nullif(path, '') AS path_from_seed, via, CAST(5 + (CASE WHEN is_seed THEN 0 ELSE 2 END) AS INTEGER) AS n_fields FROM cap"
    ),
    "field_rename": _from_crawl(
        "SELECT page_id, CASE WHEN is_seed THEN 'Address,Crawl-Time,Is-Seed,Seed-Url,URL'"
        " ELSE 'Address,Crawl-Time,Is-Seed,Path-From-Seed,Referrer,Seed-Url,URL' END AS labels, ip AS address, via AS referrer FROM cap"
    ),
    "crawl_time_14": _from_crawl("SELECT page_id, digits FROM cap"),
    "encode_record": _from_crawl(_RAW.format(doc="full_doc")),
    "frame_record": _from_crawl(
        "SELECT url AS uri, printf('%08X', strlen(doc)) AS prefix, CAST(strlen(doc) + 4 AS INTEGER) AS framed_bytes, md5(doc) AS doc_md5 FROM docs"
    ),
    "rewrite_record": _from_crawl(
        f"""SELECT uri, md5(d) AS doc_md5, CAST(strlen(d) AS INTEGER) AS bytes FROM (
  SELECT url AS uri, magic || 'URL: ' || url || {_CRLF} || 'Crawl-Time: ' || digits || {_CRLF}
    || 'Is-Seed: ' || CASE WHEN is_seed THEN 'true' ELSE 'false' END || {_CRLF}
    || CASE WHEN seed_url <> '' THEN 'Seed-Url: ' || seed_url || {_CRLF} ELSE '' END || path_line
    || 'Via: http://www.example.org/' || {_CRLF} || 'Note: from ' || url || {_CRLF} || {_CRLF}
    || request || 'HTTP/1.1 204 No Content' || {_CRLF} || {_CRLF} AS d FROM cap)"""
    ),
    "field_lookup": _from_crawl("SELECT url AS uri, nullif(path, '') AS path, '-' AS nothing FROM cap"),
    "derived_select": _from_crawl(
        "SELECT url AS uri, url, ip, crawl_time, is_seed, nullif(seed_url, '') AS seed_url, nullif(path, '') AS path_from_seed,"
        " via, content_type, charset, status, scheme, extension FROM cap"
    ),
    "filter_size": _from_crawl(
        f"SELECT url AS uri, CAST(strlen(body) AS INTEGER) AS body_bytes,"
        f" CASE WHEN strlen(body) > 3000 THEN '{UNWRITTEN_SIZE}' ELSE 'written' END AS annotation FROM cap"
    ),
    "filter_size_split": _from_crawl(
        f"SELECT url AS uri, CAST(strlen(body) AS INTEGER) AS body_bytes,"
        f" CASE WHEN strlen(body) > 3000 THEN '{UNWRITTEN_SIZE}' ELSE 'written' END AS annotation, crawl_date FROM cap"
    ),
    "filter_url_reject": _from_crawl(
        f"SELECT * FROM (SELECT page_id, {_ODD_URL} AS url FROM cap)"
        f" WHERE NOT regexp_matches(url, {_quoted(URL_REJECT)})"
    ),
    "filter_media": _from_crawl(
        f"SELECT * FROM (SELECT page_id, {_ODD_URL} AS url, {_ODD_EXTENSION} AS extension FROM cap)"
        f" WHERE extension IS NULL OR extension NOT IN ({_MEDIA})"
    ),
    "filter_has_request": _from_crawl(
        f"""SELECT uri, CAST(CASE WHEN uri LIKE 'http%' THEN strlen('GET ' || uri) + 4 ELSE 0 END AS INTEGER) AS request_bytes,
  CAST(CASE WHEN uri LIKE 'http%' THEN strlen(body) ELSE strlen(response) END AS INTEGER) AS body_bytes
FROM (SELECT {_ODD_URL} AS uri, body, response FROM cap)"""
    ),
    "filter_valid_record": _from_crawl(
        f"SELECT page_id, CASE page_id % 7 WHEN 1 THEN '{TRUNCATED}' WHEN 2 THEN '{BAD_HEADER}' ELSE 'none' END AS error,"
        " CAST(CASE page_id % 7 WHEN 1 THEN 10 ELSE strlen(doc) END AS INTEGER) AS bytes FROM docs"
    ),
    "parse_record": _from_crawl(f"SELECT {_PARSED_COLUMNS} FROM cap"),
    "parse_version": _from_crawl(
        f"SELECT page_id, CASE WHEN page_id % 7 IN (1, 2) THEN NULL ELSE '{VERSION}' END AS version,"
        f" CASE page_id % 7 WHEN 1 THEN '{TRUNCATED}' WHEN 2 THEN '{BAD_HEADER}' END AS error FROM cap"
    ),
    "parse_fields": _from_crawl(
        "SELECT url AS uri, 'Crawl-Time=' || digits || '|Ip-Address=' || ip || '|Is-Seed=' || CASE WHEN is_seed THEN 'true' ELSE 'false' END"
        " || '|Note=a:b c' || CASE WHEN path <> '' THEN '|Path-From-Seed=' || path ELSE '' END"
        " || CASE WHEN seed_url <> '' THEN '|Seed-Url=' || seed_url ELSE '' END || '|URL=' || url"
        " || coalesce('|Via=' || via, '') AS fields FROM cap"
    ),
    "parse_request": _from_crawl("SELECT url AS uri, md5(request) AS request_md5, CAST(strlen(request) AS INTEGER) AS bytes FROM cap"),
    "parse_response": _from_crawl("SELECT url AS uri, md5(response) AS response_md5, CAST(strlen(response) AS INTEGER) AS bytes FROM cap"),
    "parse_status": _from_crawl("SELECT url AS uri, status FROM cap"),
    "split_body": _from_crawl("SELECT url AS uri, md5(body) AS body_md5, CAST(strlen(body) AS INTEGER) AS bytes FROM cap"),
    "header_content_type": _from_crawl("SELECT page_id, lower(header) AS header FROM cap"),
    "normalize_mime": f"SELECT page_id, lower(CASE kind WHEN 0 THEN v || '/' || w WHEN 1 THEN v || '/' || w || '+xml' WHEN 3 THEN v || '/' || w END)"
    f" AS content_type FROM ({_PAGE_WORDS})",
    "mime_params_charset": f"SELECT page_id, upper(CASE kind WHEN 0 THEN v WHEN 1 THEN CASE WHEN v IS NOT NULL THEN w END WHEN 2 THEN v END)"
    f" AS charset FROM ({_PAGE_WORDS})",
    "clean_charset": f"""SELECT page_id, upper(CASE kind WHEN 0 THEN v WHEN 1 THEN CASE WHEN w IS NOT NULL THEN v END
  WHEN 2 THEN CASE WHEN v IS NOT NULL THEN 'ISO-8859-1' END WHEN 3 THEN CASE WHEN v IS NOT NULL THEN 'UTF-8' END ELSE v || '_' || w || '-1' END)
  AS charset FROM ({_PAGE_WORDS})""",
    "sniff_xml_encoding": "SELECT page_id, CASE WHEN page_id % 5 = 4 THEN 'KOI8-R' END AS encoding FROM pages",
    "sniff_meta": "SELECT page_id, CASE WHEN page_id % 5 = 3 THEN 'text/html' END AS content_type,"
    " CASE WHEN page_id % 5 = 3 THEN 'WINDOWS-1252' END AS charset FROM pages",
    "detect_charset": _from_crawl("SELECT url AS uri, content_type, charset FROM cap"),
    "detect_html5_charset": _from_crawl(
        f"""SELECT url AS uri, content_type, CASE WHEN found THEN declared ELSE charset END AS charset
FROM (SELECT *, [{', '.join('NULL' if x is None else _quoted(x) for x in _HEAD_CHARSETS)}][page_id % {len(HEADS)} + 1] AS declared,
        declared IS NOT NULL AND page_id % 5 NOT IN (2, 3, 4) AS found FROM cap)"""
    ),
    "decode_text": f"""SELECT page_id, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS chars
FROM (SELECT page_id, CASE WHEN kind IN (0, 3) THEN html WHEN kind IN (1, 2) THEN {_NARROW}
    ELSE regexp_replace(html, '[^\\x00-\\x7e]', '?', 'g') || [{', '.join(_quoted(x) for _, x in PHRASES)}][kind - 3] END AS t
  FROM (SELECT page_id, html, page_id % {4 + len(PHRASES)} AS kind FROM pages))""",
    "url_scheme": _from_crawl("SELECT page_id, CASE WHEN page_id % 8 = 0 THEN 'dns' ELSE scheme END AS scheme FROM cap"),
    "url_extension": _from_crawl(f"SELECT page_id, {_ODD_EXTENSION} AS extension FROM cap"),
    "normalize_url": _from_crawl(
        "SELECT page_id, CASE WHEN page_id % 4 = 2 THEN root || '/..' || substr(url, length(root) + 1) ELSE url END AS normal FROM cap"
    ),
    "canonical_url": _from_crawl(f"SELECT * FROM (WITH {_canonical('cap', _VARIANT, 'page_id')} SELECT page_id, u AS url, canonical FROM canon)"),
    "url_fingerprint": _from_crawl(
        f"""SELECT page_id, CASE WHEN canonical IS NULL THEN CAST(0 AS BIGINT)
  ELSE CAST(CASE WHEN h >= 9223372036854775808 THEN h - 18446744073709551616 ELSE h END AS BIGINT) END AS fingerprint
FROM (WITH {_canonical('cap', _VARIANT, 'page_id')}
  SELECT page_id, canonical, CAST(CAST('0x' || substring(md5(canonical), 3, 14) AS UBIGINT) AS HUGEINT) * 256 AS h FROM canon)"""
    ),
    **dict.fromkeys(("dedupe_captures", "dedupe_table"), _from_crawl(
        f"""SELECT 'http://www.h' || page || '.com/a/' AS canonical_url, uri, page_id, crawl_time, md5(response) AS response_md5
FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY ts DESC, uri) AS rn
  FROM (SELECT page_id, ts, crawl_time, response, {_RECRAWL_PAGE} AS page,
          'http://' || CASE WHEN page_id % 2 = 0 THEN 'www.' ELSE '' END || 'h' || ({_RECRAWL_PAGE}) || '.com/a'
          || CASE WHEN page_id % 5 = 0 THEN '/index.html' ELSE '' END || '#' || page_id AS uri FROM cap))
WHERE rn = 1"""
    )),
    "extract_elements": f"""WITH {_LINKS}
SELECT page_id, CAST(pos AS INTEGER) AS pos, '<a href="' || href || '">' AS tag FROM plain UNION ALL {_TAGS}""",
    "extract_attributes": f"""WITH {_LINKS}
SELECT page_id, CAST(pos AS INTEGER) AS pos, 1 AS attr_pos, 'href' AS name, href AS value FROM plain UNION ALL {_ATTRIBUTES}""",
    "element_content": """SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos, content
FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<li(?:\\s[^>]*)?>(.*?)</li>', 1)) AS content,
             generate_subscripts(regexp_extract_all(html, '(?is)<li(?:\\s[^>]*)?>(.*?)</li>', 1), 1) AS pos FROM pages)""",
    "base_href": f"WITH {_LINKS} SELECT page_id, base_url FROM hosts",
    "extract_links": f"WITH {_LINKS} SELECT url AS src_url, base_url, CAST(pos AS INTEGER) AS pos, href FROM links",
    **dict.fromkeys(("resolve_links", "page_links"), f"""WITH {_LINKS}
SELECT url AS src_url, CAST(pos AS INTEGER) AS pos, href, target_url, is_internal FROM judged WHERE target_url IS NOT NULL"""),
    "count_links": f"""WITH {_LINKS}
SELECT src_host AS host, count(*) FILTER (WHERE is_internal) AS internal, count(*) FILTER (WHERE NOT is_internal) AS "external",
       count(*) FILTER (WHERE target_url IS NULL) AS unresolved FROM judged GROUP BY 1""",
    "resolve_seed": _from_crawl("SELECT page_id, url AS uri, seed_url FROM cap"),
    "via_join": _from_crawl(
        "SELECT a.url AS uri, a.via, b.status AS via_status, b.content_type AS via_content_type, b.crawl_time AS via_crawl_time"
        " FROM cap a LEFT JOIN cap b ON a.via = b.url"
    ),
    "count_charsets": _from_crawl("SELECT charset, count(*) AS documents FROM cap GROUP BY 1"),
    "count_mime_types": _from_crawl("SELECT content_type, count(*) AS documents FROM cap GROUP BY 1"),
    "bytes_written": _from_crawl(
        """SELECT shard, uri, CAST(sum(n) OVER (PARTITION BY shard ORDER BY encode(uri) ROWS UNBOUNDED PRECEDING) AS BIGINT) AS position,
  count(*) OVER (PARTITION BY shard) AS shard_records
FROM (SELECT scheme AS shard, url AS uri, strlen(doc) + 4 AS n FROM docs)"""
    ),
    "output_text": _from_crawl("SELECT charset || chr(9) || count(*) AS line FROM cap GROUP BY charset"),
    "stream_ingest": _from_crawl(
        "SELECT url AS uri, crawl_time, status, content_type, charset, md5(body) AS body_md5, crawl_date FROM cap"
    ),
    "stream_filter": _from_crawl(
        "SELECT url AS uri, CAST(strlen(body) AS INTEGER) AS body_bytes FROM cap"
        " WHERE strlen(body) <= 3000 AND NOT regexp_matches(url, '^.*/fr/.*$')"
    ),
}
