"""URL expressions: scheme, extension, normalisation, canonical form, resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Page names that stand for their directory.
DEFAULT_PAGES = ("index", "default")
DEFAULT_PAGE_TYPES = (
    "asp", "cfm", "jsp", "htm", "php",
    "html", "shtm",
    "dhtml", "shtml", "xhtml",
)

# Schemes whose URLs have a path that can carry a file extension. The host is taken
# as a whole, so that its dots do not count.
_EXTENSION = r"(?i)\A(?:https?|ftp|file):(?://[^/?#]*+)?+[^?#]*\.([^./?#]+)(?=[?#]|\z)"
_DEFAULT_PAGE = rf"(?i)/(?:{'|'.join(DEFAULT_PAGES)})\.(?:{'|'.join(DEFAULT_PAGE_TYPES)})$"

# What makes a reference no URI: characters that may not stand there, incomplete
# percent escapes, and square brackets other than those of an IP literal as host.
_NOT_URI = r"[\x00-\x20\x7f\"<>\\^`{|}]|%(?![0-9A-Fa-f]{2})"
_BAD_BRACKET = (
    r"\A(?:[A-Za-z][A-Za-z0-9+.\-]*:)?+(?://(?:[^/?#\[\]@]*@)?+(?:\[[0-9A-Fa-f:.]+\])?+)?+[^?#\[\]]*+[\[\]]"
)

_HOST = r"\A[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^:/?#]*)"
_SPLIT_AT_PATH = r"(?s)\A([A-Za-z][A-Za-z0-9+.\-]*:(?://[^/?#]*+)?+)(/[^?#]*)(.*)\z"
_CANONICAL_PARTS = r"\A([^/?#]*/[^/?#]*/)([^?#]*)(\?[^#]*)?"
_HAS_SCHEME = r"\A[A-Za-z][A-Za-z0-9+.\-]*:"


def scheme(url: Column) -> Column:
    """Lower-case text before the first colon."""
    return F.nullif(F.lower(F.regexp_extract(url, r"\A([^:]+):", 1)), F.lit(""))


def extension(url: Column) -> Column:
    """Lower-case suffix after the last dot of the last path segment."""
    return F.nullif(F.lower(F.regexp_extract(url, _EXTENSION, 1)), F.lit(""))


def host(url: Column) -> Column:
    """Lower-case host of a hierarchical URL without user info and port."""
    return F.nullif(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def is_valid(url: Column) -> Column:
    has_bracket = F.contains(url, F.lit("[")) | F.contains(url, F.lit("]"))
    return ~url.rlike(_NOT_URI) & ~(has_bracket & url.rlike(_BAD_BRACKET))


def remove_dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` in an absolute path (RFC 3986, 5.2.4)."""

    def step(done: Column, part: Column) -> Column:
        parent = F.when(F.size(done) > 0, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)
        return F.when(part == ".", done).when(part == "..", parent).otherwise(F.concat(done, F.array(part)))

    parts = F.split(F.substr(path, F.lit(2)), "/")
    start = F.array().cast("array<string>")
    closing = F.when(path.rlike(r"/\.{1,2}\z"), F.lit("/")).otherwise(F.lit(""))
    kept = F.aggregate(parts, start, step)
    solved = F.concat(
        F.lit("/"), F.array_join(kept, "/"), F.when(F.size(kept) > 0, closing).otherwise(F.lit(""))
    )
    return F.when(F.contains(path, F.lit("/.")), solved).otherwise(path)


def _squeeze_path(path: Column) -> Column:
    """Like ``remove_dot_segments`` but runs of slashes count as one and a leading
    ``..`` that has nothing to cancel is kept."""

    def step(done: Column, part: Column) -> Column:
        can_cancel = (F.size(done) > 0) & (F.element_at(done, -1) != "..")
        return F.when(
            (part == "..") & F.when(F.size(done) > 0, can_cancel).otherwise(F.lit(False)),
            F.slice(done, F.lit(1), F.size(done) - 1),
        ).otherwise(F.concat(done, F.array(part)))

    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    body = F.array_join(kept, "/")
    open_end = path.rlike(r"(?:/|/\.)\z") | (path.rlike(r"/\.\.\z") & ~body.rlike(r"(?:\A|/)\.\.\z"))
    solved = F.concat(F.lit("/"), body, F.when((body != "") & open_end, F.lit("/")).otherwise(F.lit("")))
    return solved


def normalize_url(url: Column) -> Column:
    """Remove dot segments and doubled slashes from the path of a URL.

    Anything that is not a valid hierarchical URL is returned as it is."""
    prefix = F.regexp_extract(url, _SPLIT_AT_PATH, 1)
    path = F.regexp_extract(url, _SPLIT_AT_PATH, 2)
    rest = F.regexp_extract(url, _SPLIT_AT_PATH, 3)
    odd = path.rlike(r"//|/\.{1,2}(?:/|\z)") & is_valid(url)
    return F.when(odd, F.concat(prefix, _squeeze_path(path), rest)).otherwise(url)


def _canonical(prefix: Column, path: Column, query: Column) -> Column:
    directory = F.regexp_replace(path, _DEFAULT_PAGE, "/")
    no_slash = (path != "") & (F.instr(path, "/") == 0)
    settled = (
        F.when((query == "") & (path != directory), directory)
        .when(no_slash | path.rlike(r"/[^/.]+\z"), F.concat(path, F.lit("/")))
        .otherwise(path)
    )
    www = F.when(F.startswith(F.lower(F.left(path, F.lit(4))), F.lit("www.")), F.lit("")).otherwise(F.lit("www."))
    return F.when(prefix != "", F.concat(prefix, www, settled, query))


def canonical_url(url: Column) -> Column:
    """One spelling for URLs that name the same page; null if there are not two
    slashes before any query or fragment.

    The fragment goes, ``www.`` is put in front, a default page name without query
    goes, a last segment without dot gets a closing slash, the query stays. ``url``
    should be a plain column: it is used several times."""
    return _canonical(*[F.regexp_extract(url, _CANONICAL_PARTS, i) for i in (1, 2, 3)])


def with_canonical_url(df: DataFrame, url: str, to: str = "canonical_url") -> DataFrame:
    """Add the canonical form of the normalised URL, step by step so that nothing is
    computed twice."""
    keep = [x for x in df.columns if x != to]
    df = df.select("*", normalize_url(F.col(url)).alias("_normal"))
    parts = [F.regexp_extract("_normal", _CANONICAL_PARTS, i).alias(f"_part{i}") for i in (1, 2, 3)]
    df = df.select("*", *parts)
    return df.select(*keep, _canonical(F.col("_part1"), F.col("_part2"), F.col("_part3")).alias(to))


def url_fingerprint(url: Column) -> Column:
    """Signed 64-bit key of the canonical URL, 0 if there is none.

    Digest bytes 1..7 of the MD5 fill the upper seven bytes; the lowest is zero."""
    digest = F.md5(canonical_url(url))
    upper = F.conv(F.substring(digest, 3, 14), 16, 10).cast("bigint")
    return F.coalesce(F.shiftleft(upper, 8), F.lit(0).cast("bigint"))


def _path_part(relative: Column) -> Column:
    return F.substring_index(F.substring_index(relative, "#", 1), "?", 1)


def _tail(text: Column, after_chars: Column) -> Column:
    return F.substring(text, after_chars + 1, F.length(text))


def with_base_parts(df: DataFrame, base: str, to: str = "_base") -> DataFrame:
    """Add the parts of a base URL that resolution needs, worked out once per page."""
    df = df.select(
        "*",
        F.when(is_valid(F.col(base)), F.regexp_extract(base, r"\A[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*", 0)).alias("_root"),
    )
    df = df.select("*", F.substring_index(_tail(F.col(base), F.length("_root")), "#", 1).alias("_place"))
    df = df.select("*", F.substring_index("_place", "?", 1).alias("_path"))
    path = F.when(F.col("_path") == "", F.lit("/")).otherwise(F.col("_path"))
    parts = F.struct(
        F.substring_index("_root", ":", 1).alias("scheme"),
        F.col("_root").alias("root"),
        path.alias("path"),
        F.concat(F.left(path, F.length(path) - F.length(F.substring_index(path, "/", -1)))).alias("dir"),
        _tail(F.col("_place"), F.length("_path")).alias("query"),
    )
    return df.withColumn(to, F.when(F.col("_root") != "", parts)).drop("_root", "_place", "_path")


def with_resolved(df: DataFrame, ref: str, to: str, base: str = "_base") -> DataFrame:
    """Add a reference resolved against ``with_base_parts`` (RFC 3986); null if that fails.

    An absolute web URL without path names the root of its site; its query and fragment
    are kept. Other schemes are returned as they are. The steps are
    projections of their own so that no intermediate value is computed twice."""
    c = F.col
    keep = df.columns
    whole = F.when(F.startswith(c(ref), F.lit("//")), F.concat(c(base)["scheme"], F.lit(":"), c(ref))).otherwise(c(ref))
    df = df.select("*", F.when(is_valid(c(ref)), whole).alias("_ref"))
    start = F.lower(F.substring("_ref", 1, 8))
    is_web = F.startswith(start, F.lit("http://")) | (start == "https://")
    df = df.select("*", is_web.alias("_web"), (~is_web & c("_ref").rlike(_HAS_SCHEME)).alias("_other"))
    df = df.select("*", F.when(c("_web"), F.regexp_extract("_ref", r"\A[^/?#]*//[^/?#]*", 0)).otherwise(c(base)["root"]).alias("_root"))
    df = df.select("*", F.when(c("_web"), _tail(c("_ref"), F.length("_root"))).otherwise(c("_ref")).alias("_rel"))
    df = df.select("*", _path_part(c("_rel")).alias("_path"))
    rest = _tail(c("_rel"), F.length("_path"))
    same_path = F.when(F.startswith(c("_rel"), F.lit("?")), F.lit("")).otherwise(c(base)["query"])
    full = F.when(c("_web") | F.startswith(c("_path"), F.lit("/")), c("_path")).otherwise(F.concat(c(base)["dir"], c("_path")))
    df = df.select(
        "*",
        F.when(c("_other"), c("_ref"))
        .when(c("_web") & F.endswith(c("_root"), F.lit("//")), F.lit(None).cast("string"))
        .when(c("_web") & (c("_path") == ""), F.concat(c("_root"), F.lit("/"), rest))
        .when(c("_path") == "", F.concat(c("_root"), c(base)["path"], same_path, rest))
        .alias("_done"),
        (c("_other") | (c("_path") == "") | (c("_web") & F.endswith(c("_root"), F.lit("//")))).alias("_settled"),
        full.alias("_full"),
        rest.alias("_rest"),
    )
    target = F.when(c("_settled"), c("_done")).otherwise(F.concat(c("_root"), remove_dot_segments(c("_full")), c("_rest")))
    # As a generator of one row, so that a filter on the target stays above it instead of
    # repeating the expressions of all steps below.
    return df.select(*[k for k in keep if k != to], F.explode(F.array(target)).alias(to))
