"""The column builders that need no Python, under names for SQL queries."""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import mime, urls


def _r(pattern: str) -> str:
    if "'" in pattern:
        raise ValueError(f"pattern with a single quote: {pattern}")
    return f"r'{pattern}'"


def definitions() -> dict[str, str]:
    """Function name -> signature and body of a SQL function."""
    parts = _r(urls._CANONICAL_PARTS)
    return {
        "url_scheme": rf"(url STRING) RETURNS STRING RETURN nullif(lower(regexp_extract(url, r'\A([^:]+):', 1)), '')",
        "url_extension": f"(url STRING) RETURNS STRING RETURN nullif(lower(regexp_extract(url, {_r(urls._EXTENSION)}, 1)), '')",
        "url_host": f"(url STRING) RETURNS STRING RETURN nullif(lower(regexp_extract(url, {_r(urls._HOST)}, 1)), '')",
        "canonical_url": f"""(url STRING) RETURNS STRING RETURN
            SELECT CASE WHEN pre <> '' THEN concat(pre, if(startswith(lower(left(p, 4)), 'www.'), '', 'www.'),
                     CASE WHEN q = '' AND p <> d THEN d
                          WHEN (p <> '' AND instr(p, '/') = 0) OR p RLIKE r'/[^/.]+\\z' THEN concat(p, '/')
                          ELSE p END, q) END
            FROM (SELECT *, regexp_replace(p, {_r(urls._DEFAULT_PAGE)}, '/') AS d
                  FROM (SELECT regexp_extract(url, {parts}, 1) AS pre, regexp_extract(url, {parts}, 2) AS p,
                               regexp_extract(url, {parts}, 3) AS q))""",
        "url_fingerprint": """(url STRING) RETURNS BIGINT RETURN
            coalesce(shiftleft(CAST(conv(substring(md5(canonical_url(url)), 3, 14), 16, 10) AS BIGINT), 8), 0L)""",
        "mime_type": f"""(header STRING) RETURNS STRING RETURN
            CASE WHEN instr(regexp_extract(header, {_r(mime._MIME)}, 1), '/') > 0
                 THEN lower(regexp_extract(header, {_r(mime._MIME)}, 1)) END""",
        "clean_charset": r"""(label STRING) RETURNS STRING RETURN
            nullif(regexp_replace(regexp_replace(regexp_extract(regexp_replace(upper(label), r'(?s)\A"(.*)"\z', r'$1'),
              r'\A[A-Z0-9_\-]*', 0), r'\A(?!ISO-).*8859[\-_]1\z', 'ISO-8859-1'), r'\A.*UTF8\z', 'UTF-8'), '')""",
        "charset_param": f"""(header STRING) RETURNS STRING RETURN
            CASE WHEN contains(header, ';')
                 THEN clean_charset(trim(BOTH ' \t\r\n' FROM regexp_extract(header, {_r(mime._CHARSET)}, 1))) END""",
        "frame_document": "(doc BINARY) RETURNS BINARY RETURN concat(unhex(lpad(hex(CAST(octet_length(doc) AS BIGINT)), 8, '0')), doc)",
        "unframe_document": "(framed BINARY) RETURNS BINARY RETURN substring(framed, 5, octet_length(framed))",
    }


def register_functions(spark: SparkSession) -> list[str]:
    """Make the functions known to this session's SQL; returns their names."""
    names = []
    for name, definition in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{definition}")
        names.append(name)
    return names
