"""Content type and character set: header values and in-document declarations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MIME = r'\A\s*"?\s*([A-Za-z0-9/+.\-]*)'
_CHARSET = r"(?is)\A[^;]*;(?:.*;)?\s*charset[^=;]*=([^;]*)"

# One pass over the body up to the first thing that settles the matter: an XML
# declaration as first tag, the end of the head, or the meta element. The last
# alternative also stops at a content-type meta that has no content attribute.
_DECLARATION = (
    r"(?is)\A[^<]*<\?xml(?:.*?\?>)?"
    r"|</head"
    r'|<meta\s+http-equiv\s*=\s*"content-type[^"]*"\s*+(?:(?!content)|content\s*=\s*"[^"]*")'
)
# The charset attribute of a meta element, behind any other attributes. Each of these is taken whole or not at all,
# so that nothing is tried twice.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""
_ATTRIBUTE = rf"""(?!charset\s*+=)[^\s=>/"'<]++(?:\s*+=\s*+{_VALUE})?+[\s/]*+"""
_META_CHARSET = rf"<meta[\s/]++(?:{_ATTRIBUTE})*+charset\s*+=\s*+{_VALUE}"
_COMMENT = r"(?s)<!--.*?-->"
_HTML5_CHARSET = rf"(?is)\A<meta[\s/]++(?:{_ATTRIBUTE})*+charset\s*+=\s*+({_VALUE})\z"
_XML_ENCODING = r'(?is)<\?xml(?>.*?encoding)[^"]*"([^"]*)".*\?>\z'
_META_CONTENT = r'(?is)content\s*=\s*"([^"]*)"\z'


def content_type_header(response_head: Column) -> Column:
    """Value of the last Content-Type header in lower case, null without one, by byte searches only."""
    mark = "\ncontent-type:"
    head = F.lower(response_head)
    return F.when(F.contains(head, F.lit(mark)), F.substring_index(F.substring_index(head, mark, -1), "\n", 1))


def normalize_mime(value: Column) -> Column:
    """Lower-case ``type/subtype`` at the start of a header value, else null."""
    token = F.lower(F.regexp_extract(value, _MIME, 1))
    return F.when(F.instr(token, "/") > 0, token)


def clean_charset(label: Column) -> Column:
    """Bring a charset label into its usual spelling; null if nothing is left."""
    unquoted = F.regexp_replace(F.upper(label), r'(?s)\A"(.*)"\z', "$1")
    name = F.regexp_extract(unquoted, r"\A[A-Z0-9_\-]*", 0)
    latin1 = F.regexp_replace(name, r"\A(?!ISO-).*8859[\-_]1\z", "ISO-8859-1")
    return F.nullif(F.regexp_replace(latin1, r"\A.*UTF8\z", "UTF-8"), F.lit(""))


def charset_label(value: Column) -> Column:
    """Charset parameter of a header value as written, null if there is none; the last one wins."""
    has_params = F.contains(value, F.lit(";"))
    label = F.btrim(F.regexp_extract(value, _CHARSET, 1), F.lit(" \t\r\n"))
    return F.when(has_params, F.nullif(label, F.lit("")))


def charset_param(value: Column) -> Column:
    """Charset parameter of a header value in its usual spelling."""
    return clean_charset(charset_label(value))


def declaration(body_text: Column, html5: bool = False) -> Column:
    """The piece of a body that declares its type or charset, '' if there is none."""
    if html5:
        return F.regexp_extract(F.regexp_replace(body_text, _COMMENT, ""), f"(?is){_META_CHARSET}|{_DECLARATION}", 0)
    return F.regexp_extract(body_text, _DECLARATION, 0)


def html5_charset(found: Column) -> Column:
    """Charset attribute of a meta element as written, null if the declaration is another one."""
    value = F.btrim(F.regexp_extract(found, _HTML5_CHARSET, 1), F.lit("\"' \t\r\n"))
    return F.nullif(value, F.lit(""))


def is_xml_declaration(found: Column) -> Column:
    return found.rlike(r"(?i)\A[^<]*<\?xml")


def xml_encoding(found: Column) -> Column:
    """Double-quoted encoding of an XML declaration, upper case; null without one."""
    return F.nullif(F.upper(F.regexp_extract(found, _XML_ENCODING, 1)), F.lit(""))


def meta_content(found: Column) -> Column:
    """Content of a content-type meta element, null if the declaration is none.

    It is the regular expression that has no match elsewhere: an XML declaration ends
    in ``?>``, a head in ``</head``."""
    return F.when(found.rlike(_META_CONTENT), F.regexp_extract(found, _META_CONTENT, 1))


def sniffable(content_type: Column) -> Column:
    """Bodies are looked into only when the header leaves the type open or says text."""
    return content_type.isNull() | F.startswith(content_type, F.lit("text"))


def sniffed_type(meta: Column, header_type: Column) -> Column:
    """Type after looking at the meta content: it overrides the header, a blank one does not."""
    html = F.lit("text/html")
    return (
        F.when(meta.isNull(), header_type)
        .when(F.trim(meta) == "", F.coalesce(header_type, html))
        .otherwise(F.coalesce(normalize_mime(meta), html))
    )
