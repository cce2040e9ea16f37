"""One query per operator, each over the whole ``pages`` table.

The crawl they work on is made from the pages (``page_crawl``), written or encoded,
and read back or parsed. Results are plain columns, so that they can be compared with
SQL over the same pages.
"""

from __future__ import annotations

import codecs
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import bytesview as B
from ..functions import mime as M
from ..functions import urls as U
from ..functions.stages import cut
from ..operators import assemble, dedupe, filters, lineage, links, parse, text
from ..schema import MAGIC, RAW, FieldNames
from ..sources import archive, documents, rolling, table
from ..sources.counted import stream_written
from ..sources.scratch import fresh_dir
from ..streaming import ingest
from . import reports
from .page_crawl import body_text, content_type_header, crawl, linked_pages, raw_crawl, read_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

c = F.col


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _time(column: str = "crawl_time") -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def _digest(binary: Column | str) -> Column:
    return F.md5(c(binary) if isinstance(binary, str) else binary)


def _parsed(spark: SparkSession, sf_dir: str, lineage_joins: bool = False) -> DataFrame:
    return parse.parse_records(raw_crawl(spark, sf_dir, lineage_joins))


# Sources and sinks -----------------------------------------------------------------


def _raw_columns() -> list:
    return ["uri", _digest("doc").alias("doc_md5"), F.octet_length("doc").alias("bytes")]


def _raw_rows(raw: DataFrame) -> DataFrame:
    return raw.select(*_raw_columns())


@_query
def scan_archive(spark, sf_dir):
    path = fresh_dir(spark, "archive")
    archive.sink_archive(raw_crawl(spark, sf_dir, True), path)
    return _raw_rows(archive.scan_archive(spark, path))


@_query
def scan_multi(spark, sf_dir):
    root = fresh_dir(spark, "crawls")
    captures = crawl(read_pages(spark, sf_dir))
    paths = []
    for name, chosen in (("even, 1", c("page_id") % 2 == 0), ("{odd}", c("page_id") % 2 == 1)):
        paths.append(f"{root}/{name}")
        archive.sink_archive(assemble.encode_record(captures.where(chosen)), paths[-1])
    raw = archive.scan_multi(spark, paths)
    return raw.select(F.substring_index("crawl_dir", "/", -1).alias("crawl"), *_raw_columns())


def _spread_over_days(captures: DataFrame) -> DataFrame:
    """The crawl as one of seven days, by page number."""
    return captures.withColumn("crawl_time", F.timestamp_add("DAY", c("page_id") % 7, c("crawl_time")))


@_query
def scan_table(spark, sf_dir):
    path = fresh_dir(spark, "table")
    table.sink_table(parse.parse_records(assemble.encode_record(_spread_over_days(crawl(read_pages(spark, sf_dir))))), path)
    found = table.scan_table(spark, path).where("status = 200")
    return found.select("uri", c(table.DATE).cast("string").alias("crawl_date"), "charset", F.octet_length("body").alias("body_bytes"))


@_query
def scan_single_docs(spark, sf_dir):
    path = fresh_dir(spark, "documents")
    documents.sink_documents(raw_crawl(spark, sf_dir), path)
    docs = documents.scan_documents(spark, f"{path}/{documents.FOLDERS}")
    parsed = parse.parse_records(docs)
    return parsed.select("url", "status", "charset", F.octet_length("body").alias("body_bytes"), _digest("body").alias("body_md5"))


@_query
def skip_open_files(spark, sf_dir):
    """Job folders, one in the other, with finished and unfinished files side by side, and an unfinished folder."""
    root = fresh_dir(spark, "mixed")
    captures = crawl(read_pages(spark, sf_dir))

    def write(chosen: Column, folder: str) -> DataFrame:
        return archive.write_open_files(assemble.encode_record(captures.where(chosen)), f"{root}/{folder}", max_bytes=200_000)

    for k, folder in enumerate(("job-1", "job-1/job-2", "job-3")):
        mine = c("page_id") % 9 == k
        archive.publish_files(write(mine, folder), f"{root}/{folder}")
        write(c("page_id") % 9 == k + 3, folder)  # never published
        broken = f"{folder}/broken.invalid"
        archive.publish_files(write(c("page_id") % 9 == k + 6, broken), f"{root}/{broken}")
    return _raw_rows(archive.scan_archive(spark, root))


@_query
def sink_archive(spark, sf_dir):
    path = fresh_dir(spark, "archive")
    archive.sink_archive(raw_crawl(spark, sf_dir), path, max_bytes=1 << 20)
    return _raw_rows(archive.scan_archive(spark, path))


def _roll_check(rows: DataFrame, limit: int) -> DataFrame:
    """Files that were closed too late or too early, from ``file``, place ``at`` and bytes ``n`` of each record."""
    files = rows.groupBy("file").agg(F.count("*").alias("records"), F.sum("n").alias("bytes"), F.max_by("n", "at").alias("last"))
    written = F.regexp_extract("file", r"part-(\d+)", 1), F.max("file").over(Window.partitionBy("task"))
    rolled = files.withColumn("task", written[0]).withColumn("rolled", c("file") < written[1])
    return rolled.agg(
        F.sum("records").alias("records"),
        F.sum("bytes").alias("bytes"),
        F.count_if(c("bytes") - c("last") > limit).alias("rolled_late"),
        F.count_if(c("rolled") & (c("bytes") <= limit)).alias("rolled_early"),
    )


@_query
def sink_archive_rolling(spark, sf_dir):
    limit = 100_000
    path = fresh_dir(spark, "archive")
    archive.sink_archive(raw_crawl(spark, sf_dir), path, max_bytes=limit)
    size = (F.octet_length("doc") + 4).cast("bigint").alias("n")
    rows = archive.scan_archive(spark, path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"), size)
    return _roll_check(rows, limit)


@_query
def sink_compression(spark, sf_dir):
    out = []
    for kind in ("NONE", "RECORD", "BLOCK", "DEFAULT"):
        path = fresh_dir(spark, kind.lower())
        archive.sink_archive(raw_crawl(spark, sf_dir), path, kind)
        found = archive.stored_compression(spark, path).withColumnRenamed("compression", "stored")
        rows = archive.scan_archive(spark, path).withColumn("file", F.input_file_name())
        out.append(rows.join(found, "file").select(F.lit(kind).alias("compression"), "stored", *_raw_columns()))
    return reduce(DataFrame.unionByName, out)


@_query
def sink_table(spark, sf_dir):
    path = fresh_dir(spark, "table")
    table.sink_table(_parsed(spark, sf_dir, True), path, rebalance=True)
    return table.scan_table(spark, path).select(
        "uri", "version", "url", "ip", _time(), "is_seed", "path_from_seed", "via", "seed_url", "scheme", "extension",
        _digest("request").alias("request_md5"), _digest("response").alias("response_md5"), _digest("body").alias("body_md5"),
        "status", "content_type", "charset", "error", F.size("fields").alias("n_fields"),
        c(table.DATE).cast("string").alias("crawl_date"),
    )


@_query
def sink_rolling(spark, sf_dir):
    limit = 100_000
    path = fresh_dir(spark, "rolled")
    rolling.sink_rolling(raw_crawl(spark, sf_dir), path, limit)
    file = F.concat(F.substring_index("_metadata.file_name", "-", 2), F.lit("-"), F.lpad(c("file_no").cast("string"), 9, "0"))
    rows = spark.read.parquet(path).select(
        file.alias("file"), c("_metadata.row_index").alias("at"), F.octet_length("doc").cast("bigint").alias("n")
    )
    return _roll_check(rows, limit)


@_query
def sink_counts(spark, sf_dir):
    """Records and bytes as each sink's own job counted them."""
    raw = raw_crawl(spark, sf_dir)
    captures = parse.parse_records(raw)
    source, streamed = fresh_dir(spark, "incoming"), fresh_dir(spark, "ingested")
    raw.write.parquet(source)
    query = ingest.stream_ingest(ingest.stream_rows(spark, source, RAW, max_files=3), streamed, fresh_dir(spark, "state"))
    query.awaitTermination()
    split = table.sink_split(captures, fresh_dir(spark, "split"), 3000)
    found = {
        "archive": archive.sink_archive(raw, fresh_dir(spark, "archive"), max_bytes=100_000),
        "archive by task": archive.sink_archive(raw, fresh_dir(spark, "archive"), max_bytes=-1),
        "rolling": rolling.sink_rolling(raw, fresh_dir(spark, "rolled"), 100_000),
        "table": table.sink_table(captures, fresh_dir(spark, "table")),
        "stream": stream_written(query),
        **split,
    }
    return spark.createDataFrame([(k, *v) for k, v in found.items()], "sink string, records long, bytes long")


# Record assembly -------------------------------------------------------------------


@_query
def named_fields(spark, sf_dir):
    df = assemble.named_fields(crawl(read_pages(spark, sf_dir), True))
    labels = [label for _, label in FieldNames().items()]
    values = [F.try_element_at("fields", F.lit(x)).alias(x.lower().replace("-", "_")) for x in labels]
    return df.select("page_id", *values, F.size("fields").alias("n_fields"))


@_query
def field_rename(spark, sf_dir):
    df = assemble.named_fields(crawl(read_pages(spark, sf_dir), True))
    df = assemble.rename_fields(df, FieldNames(), FieldNames(ip="Address", via="Referrer"))
    labels = F.array_join(F.array_sort(F.map_keys("fields")), ",").alias("labels")
    return df.select("page_id", labels, F.try_element_at("fields", F.lit("Address")).alias("address"), F.try_element_at("fields", F.lit("Referrer")).alias("referrer"))


@_query
def crawl_time_14(spark, sf_dir):
    return crawl(read_pages(spark, sf_dir)).select("page_id", assemble.crawl_time_14(c("crawl_time")).alias("digits"))


@_query
def encode_record(spark, sf_dir):
    return _raw_rows(raw_crawl(spark, sf_dir, True))


@_query
def frame_record(spark, sf_dir):
    framed = assemble.frame_record(raw_crawl(spark, sf_dir))
    return framed.select(
        "uri",
        F.hex(F.substring("doc", 1, 4)).alias("prefix"),
        F.octet_length("doc").alias("framed_bytes"),
        _digest(B.unframe(c("doc"))).alias("doc_md5"),
    )


@_query
def rewrite_record(spark, sf_dir):
    new = assemble.rewrite_record(
        _parsed(spark, sf_dir, True),
        {"Ip-Address": None, "Note": F.concat(F.lit("from "), c("uri")), "Via": "http://www.example.org/"},
        response=F.encode(F.lit("HTTP/1.1 204 No Content\r\n\r\n"), "UTF-8"),
    )
    return _raw_rows(new)


@_query
def field_lookup(spark, sf_dir):
    df = parse.field_lookup(_parsed(spark, sf_dir, True), "Path-From-Seed", "path")
    df = parse.field_lookup(df, "No-Such-Field", "nothing")
    return df.select("uri", "path", F.coalesce("nothing", F.lit("-")).alias("nothing"))


@_query
def derived_select(spark, sf_dir):
    df = parse.derived_select(_parsed(spark, sf_dir, True))
    return df.withColumn("crawl_time", _time()).drop("fields")


# Filters ---------------------------------------------------------------------------


@_query
def filter_size(spark, sf_dir):
    df = _parsed(spark, sf_dir)
    limit = 3000
    kept = filters.filter_size(df, limit).withColumn("annotation", F.lit("written"))
    rejected = filters.annotate_size(df, limit).where(c("annotation").isNotNull())
    return kept.unionByName(rejected).select("uri", F.octet_length("body").alias("body_bytes"), "annotation")


@_query
def filter_size_split(spark, sf_dir):
    """Written and rejected by one write, and both read back."""
    path = fresh_dir(spark, "split")
    table.sink_split(_parsed(spark, sf_dir), path, 3000)
    kept = table.scan_split(spark, path).select("uri", F.octet_length("body").alias("body_bytes"), F.lit("written").alias("annotation"), "crawl_date")
    rejected = table.scan_split(spark, path, "rejected").select("uri", c("content_bytes").cast("int").alias("body_bytes"), "annotation", "crawl_date")
    return kept.unionByName(rejected).withColumn("crawl_date", c("crawl_date").cast("string"))


def _odd_urls(pages: DataFrame) -> DataFrame:
    """Pages under URLs of other kinds, by page number."""
    root = F.regexp_extract("url", r"^[a-z]+://[^/?#]+", 0)
    number = c("page_id").cast("string")
    kind = c("page_id") % 8
    odd = (
        F.when(kind == 0, F.concat(F.lit("dns:"), U.host(c("url"))))
        .when(kind == 1, F.concat(root, F.lit("/robots.txt")))
        .when(kind == 2, F.concat(root, F.lit("/s"), number, F.lit(".css")))
        .when(kind == 3, F.concat(root, F.lit("/j"), number, F.lit(".js")))
        .when(kind == 4, F.concat(root, F.lit("/i"), number, F.lit(".JPG?a=b.c")))
        .when(kind == 5, F.concat(root, F.lit("/d.x/f"), number, F.lit(".pdf#p.1")))
        .otherwise(c("url"))
    )
    return pages.select("page_id", odd.alias("url"), "html")


@_query
def filter_url_reject(spark, sf_dir):
    return filters.filter_url_reject(_odd_urls(read_pages(spark, sf_dir))).select("page_id", "url")


@_query
def filter_media(spark, sf_dir):
    df = _odd_urls(read_pages(spark, sf_dir)).withColumn("extension", U.extension(c("url")))
    return filters.filter_media(df).select("page_id", "url", "extension")


@_query
def filter_has_request(spark, sf_dir):
    captures = crawl(_odd_urls(read_pages(spark, sf_dir)))
    raw = assemble.encode_record(captures.withColumn("request", F.encode(F.concat(F.lit("GET "), c("uri"), F.lit("\r\n\r\n")), "UTF-8")))
    parsed = parse.parse_records(raw)
    return parsed.select("uri", F.octet_length("request").alias("request_bytes"), F.octet_length("body").alias("body_bytes"))


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = cut(assemble.encode_record(crawl(read_pages(spark, sf_dir)), keep=("page_id",)), "raw")
    doc = (
        F.when(c("page_id") % 7 == 1, F.substring("doc", 1, 10))
        .when(c("page_id") % 7 == 2, F.concat(F.lit(MAGIC.replace(b"0.3", b"0.1")), B.after(c("doc"), len(MAGIC))))
        .otherwise(c("doc"))
    )
    return raw.withColumn("doc", doc)


@_query
def filter_valid_record(spark, sf_dir):
    damaged = _damaged(spark, sf_dir)
    good = parse.valid_records(damaged, "DROPMALFORMED").withColumn("error", F.lit("none"))
    bad = parse.valid_records(damaged, "PERMISSIVE").where(c("error").isNotNull())
    return good.unionByName(bad).select("page_id", "error", F.octet_length("doc").alias("bytes"))


# Parsing ---------------------------------------------------------------------------


@_query
def parse_record(spark, sf_dir):
    return _parsed(spark, sf_dir, True).select(
        "uri", "version", "url", "ip", _time(), "is_seed", "path_from_seed", "via", "seed_url", "scheme", "extension",
        _digest("request").alias("request_md5"), _digest("response").alias("response_md5"), _digest("body").alias("body_md5"),
        "status", "content_type", "charset", "error", F.size("fields").alias("n_fields"),
    )


@_query
def parse_where(spark, sf_dir):
    """A RAW table by days, of which conditions on the parsed records read two."""
    path = fresh_dir(spark, "raw")
    raw = assemble.encode_record(_spread_over_days(crawl(read_pages(spark, sf_dir))), keep=("page_id", "crawl_time"))
    raw.withColumn("day", F.to_date("crawl_time")).drop("crawl_time").write.partitionBy("day").parquet(path)
    where = ["day BETWEEN date'2024-01-04' AND date'2024-01-05' AND status <> 404 AND page_id >= 20", c("charset").isNotNull()]
    return parse.parse_records(spark.read.parquet(path), where=where).select("page_id", "uri", "status", "charset", c("day").cast("string").alias("day"))


@_query
def parse_version(spark, sf_dir):
    return parse.parse_records(_damaged(spark, sf_dir)).select("page_id", "version", "error")


@_query
def parse_fields(spark, sf_dir):
    raw = raw_crawl(spark, sf_dir, True)
    extra = F.encode(F.lit("Note: first\nNote: a:b c\nBlank: \r\nNote:\r\nSeed-Url: \t\r\n"), "UTF-8")
    raw = raw.withColumn("doc", F.concat(F.lit(MAGIC), extra, B.after(c("doc"), len(MAGIC))))
    pairs = F.array_sort(F.transform(F.map_entries("fields"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return parse.parse_records(raw).select("uri", F.array_join(pairs, "|").alias("fields"))


@_query
def parse_request(spark, sf_dir):
    return _parsed(spark, sf_dir).select("uri", _digest("request").alias("request_md5"), F.octet_length("request").alias("bytes"))


@_query
def parse_response(spark, sf_dir):
    return _parsed(spark, sf_dir).select("uri", _digest("response").alias("response_md5"), F.octet_length("response").alias("bytes"))


@_query
def parse_status(spark, sf_dir):
    return _parsed(spark, sf_dir).select("uri", "status")


@_query
def split_body(spark, sf_dir):
    return _parsed(spark, sf_dir).select("uri", _digest("body").alias("body_md5"), F.octet_length("body").alias("bytes"))


# Type, charset and text ------------------------------------------------------------


@_query
def header_content_type(spark, sf_dir):
    head = B.view(c("response"))
    df = crawl(read_pages(spark, sf_dir)).select("page_id", F.substring_index(head, "\r\n\r\n", 1).alias("head"))
    return df.select("page_id", F.btrim(M.content_type_header(c("head")), F.lit(" \r")).alias("header"))


def _page_words(pages: DataFrame) -> DataFrame:
    """``kind`` 0 to 4 and two words of each page, ``v`` and ``w``; null where a page has too few."""
    words = F.split(F.trim(F.regexp_replace("html", "[^A-Za-z]+", " ")), " ")
    some = pages.select("page_id", (c("page_id") % 5).alias("kind"), words.alias("words"))
    return some.select(
        "page_id", "kind", F.get("words", (c("page_id") % 50 + 8).cast("int")).alias("v"), F.get("words", (c("page_id") % 70 + 9).cast("int")).alias("w")
    )


def _spelled(*spellings: tuple) -> Column:
    """The parts of the spelling that has the page's kind, put together."""
    out = F.lit(None).cast("string")
    for k, parts in enumerate(spellings):
        out = F.when(c("kind") == k, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])).otherwise(out)
    return out


@_query
def normalize_mime(spark, sf_dir):
    v, w = c("v"), c("w")
    value = _spelled((v, "/", w), (' "', F.upper(v), "/", w, '+xml"; q=1'), (v, w), ("\t", v, "/", w, " ; charset=", v), (v, ";/", w))
    return _page_words(read_pages(spark, sf_dir)).select("page_id", M.normalize_mime(value).alias("content_type"))


@_query
def mime_params_charset(spark, sf_dir):
    v, w = c("v"), c("w")
    value = _spelled(("text/html;charset=", v), ("text/html; a=b; CHARSET=", v, "; charset = ", w), ('a/b;charset="', v, '"'), ("text/html charset=", v), ("a/b; charset=;x=", w))
    return _page_words(read_pages(spark, sf_dir)).select("page_id", M.charset_param(value).alias("charset"))


@_query
def clean_charset(spark, sf_dir):
    v, w = c("v"), c("w")
    label = _spelled(('"', v, '"'), (v, " ", w), ("x-", v, "8859_1"), (v, "utf8"), (v, "_", w, "-1;2"))
    return _page_words(read_pages(spark, sf_dir)).select("page_id", M.clean_charset(label).alias("charset"))


@_query
def sniff_xml_encoding(spark, sf_dir):
    found = read_pages(spark, sf_dir).select("page_id", M.declaration(body_text()).alias("found"))
    return found.select("page_id", F.when(M.is_xml_declaration(c("found")), M.xml_encoding(c("found"))).alias("encoding"))


@_query
def sniff_meta(spark, sf_dir):
    found = read_pages(spark, sf_dir).select("page_id", M.meta_content(M.declaration(body_text())).alias("meta"))
    return found.select(
        "page_id",
        M.sniffed_type(c("meta"), F.lit(None).cast("string")).alias("content_type"),
        M.charset_param(c("meta")).alias("charset"),
    )


@_query
def detect_charset(spark, sf_dir):
    return _parsed(spark, sf_dir).select("uri", "content_type", "charset")


#: What stands in the head of a page in place of its own meta element.
HEADS = (
    '<meta charset="windows-1251">', "<META name=x content='charset=no' / charset = koi8-r >", '<!-- <meta charset="big5"> -->',
    '<meta name="description" content="charset=latin1">', '</head><meta charset="big5">',
    '<meta http-equiv="Content-Type" content="text/html; charset=iso-8859-2">', '<meta data-charset="big5" charset=utf8>',
)


@_query
def detect_html5_charset(spark, sf_dir):
    pages = read_pages(spark, sf_dir)
    head = F.element_at(F.array(*[F.lit(x) for x in HEADS]), (c("page_id") % len(HEADS) + 1).cast("int"))
    changed = pages.withColumn("html", F.replace("html", F.lit('<meta charset="utf-8">'), head))
    return parse.parse_records(assemble.encode_record(crawl(changed)), html5=True).select("uri", "content_type", "charset")


#: Labels as pages spell them, and words that they can encode.
PHRASES = [
    ("SJIS", "日本語"), ("CP932", "髙い日本"), ("EUCJP", "日本語"), ("ISO-2022-JP", "日本語"), ("CP949", "한국어"), ("X-GBK", "中文網"),
    ("BIG5HKSCS", "香港"), ("KOI8_R", "Привет"), ("LATIN2", "Žluťoučký"), ("CP866", "Привет"), ("ISO8859-7", "Ελλάδα"),
]


@_query
def decode_text(spark, sf_dir):
    """Pages in UTF-8, ISO-8859-1, Windows-1252 and UTF-16LE, or in ASCII with a phrase in another charset."""
    line = F.concat(c("html"), F.lit("\r\n"))
    # Only characters that ISO-8859-1 has, where the bytes are in it.
    narrow = F.regexp_replace(line, "[^\\x00-\\x7e\\xa0-\\xff]", "?")
    pages = read_pages(spark, sf_dir).select(
        "page_id", (c("page_id") % (4 + len(PHRASES))).alias("kind"), F.encode(line, "UTF-8").alias("in_utf8"),
        F.encode(F.regexp_replace("html", "[^\\x00-\\x7e]", "?"), "US-ASCII").alias("plain"),
        F.encode(narrow, "ISO-8859-1").alias("in_latin"), F.encode(line, "UTF-16LE").alias("in_utf16"),
    )
    pages, kind = cut(pages, "encoded"), c("kind")
    plain, in_latin, in_utf16 = c("plain"), c("in_latin"), c("in_utf16")
    body, charset = F.when(kind == 0, c("in_utf8")), F.when(kind == 0, "UTF-8")
    for k, (bytes_, name) in enumerate([(in_latin, None), (in_latin, "WINDOWS-1252"), (in_utf16, "UTF-16LE")], 1):
        body, charset = body.when(kind == k, bytes_), charset.when(kind == k, name)
    for k, (name, phrase) in enumerate(PHRASES, 4):
        coded = phrase.encode(codecs.lookup(name.removeprefix("X-")).name)
        body, charset = body.when(kind == k, F.concat(plain, F.lit(coded + b"\r\n"))), charset.when(kind == k, name)
    decoded = text.decode_text(cut(pages.select("page_id", body.alias("body"), charset.alias("charset")), "bodies"))
    return decoded.select("page_id", F.md5(F.encode("text", "UTF-8")).alias("text_md5"), F.length("text").alias("chars"))


# URLs ------------------------------------------------------------------------------


@_query
def url_scheme(spark, sf_dir):
    return _odd_urls(read_pages(spark, sf_dir)).select("page_id", U.scheme(c("url")).alias("scheme"))


@_query
def url_extension(spark, sf_dir):
    return _odd_urls(read_pages(spark, sf_dir)).select("page_id", U.extension(c("url")).alias("extension"))


def _rooted(pages: DataFrame) -> DataFrame:
    """``root`` (scheme and host) and ``rest`` (path, query, fragment) of each page URL."""
    return pages.select(
        "page_id", "url",
        F.regexp_extract("url", r"^([a-z]+://[^/?#]+)(.*)$", 1).alias("root"),
        F.regexp_extract("url", r"^([a-z]+://[^/?#]+)(.*)$", 2).alias("rest"),
    )


@_query
def normalize_url(spark, sf_dir):
    df = _rooted(read_pages(spark, sf_dir))
    kind = c("page_id") % 4
    url = (
        F.when(kind == 0, F.concat("root", F.lit("/a/./b/../.."), "rest"))
        .when(kind == 1, F.concat("root", F.lit("//x//.."), "rest"))
        .when(kind == 2, F.concat("root", F.lit("/.."), "rest"))
        .otherwise(c("url"))
    )
    return df.select("page_id", U.normalize_url(url).alias("normal"))


def _page_variants(pages: DataFrame) -> DataFrame:
    """Several spellings of page URLs, by page number."""
    df = _rooted(pages)
    kind = c("page_id") % 6
    bare = F.regexp_replace("root", "//(www\\.)?", "//")
    url = (
        F.when(kind == 0, c("root"))
        .when(kind == 1, F.concat("root", F.lit("/a/INDEX.Php#x")))
        .when(kind == 2, F.concat("root", F.lit("/a/default.asp?q=/b.c#x")))
        .when(kind == 3, F.concat(bare, "rest"))
        .when(kind == 4, F.lit("no url"))
        .otherwise(c("url"))
    )
    return df.select("page_id", url.alias("url"))


@_query
def canonical_url(spark, sf_dir):
    df = _page_variants(read_pages(spark, sf_dir))
    return df.select("page_id", "url", U.canonical_url(c("url")).alias("canonical"))


@_query
def url_fingerprint(spark, sf_dir):
    df = _page_variants(read_pages(spark, sf_dir))
    return df.select("page_id", U.url_fingerprint(c("url")).alias("fingerprint"))


def _recrawled(pages: DataFrame) -> DataFrame:
    """Captures of few pages, one of them a third of all, in several spellings."""
    page = F.when(c("page_id") % 3 == 0, F.lit(0)).otherwise(c("page_id") % 40).cast("string")
    url = F.concat(
        F.lit("http://"), F.when(c("page_id") % 2 == 0, "www.").otherwise(""), F.lit("h"), page, F.lit(".com/a"),
        F.when(c("page_id") % 5 == 0, "/index.html").otherwise(""),
    )
    captures = crawl(pages).select("page_id", "crawl_time", "response")
    return captures.select(F.concat(url, F.lit("#"), c("page_id").cast("string")).alias("uri"), url.alias("url"), "page_id", "crawl_time", "response")


def _latest_captures(captures: DataFrame, late_bytes: int = dedupe.LATE_BYTES) -> DataFrame:
    out = dedupe.dedupe_captures(captures, late_bytes=late_bytes)
    return out.select("canonical_url", "uri", "page_id", _time(), _digest("response").alias("response_md5"))


@_query
def dedupe_captures(spark, sf_dir):
    return _latest_captures(_recrawled(read_pages(spark, sf_dir)))


@_query
def dedupe_table(spark, sf_dir):
    """The same out of a capture table, where bodies are fetched last."""
    path = fresh_dir(spark, "table")
    table.sink_table(_recrawled(read_pages(spark, sf_dir)), path)
    return _latest_captures(table.scan_table(spark, path), late_bytes=0)


# HTML and links --------------------------------------------------------------------


@_query
def extract_elements(spark, sf_dir):
    return links.extract_elements(linked_pages(read_pages(spark, sf_dir)), "a", ("page_id",))


@_query
def extract_attributes(spark, sf_dir):
    tags = links.extract_elements(linked_pages(read_pages(spark, sf_dir)), "a", ("page_id",))
    return links.extract_attributes(tags)


@_query
def element_content(spark, sf_dir):
    pages = read_pages(spark, sf_dir).select("page_id", F.encode("html", "UTF-8").alias("body"))
    return links.element_content(pages, "li", ("page_id",))


@_query
def base_href(spark, sf_dir):
    return links.with_base(linked_pages(read_pages(spark, sf_dir))).select("page_id", "base_url")


@_query
def extract_links(spark, sf_dir):
    return links.extract_links(linked_pages(read_pages(spark, sf_dir)))


@_query
def resolve_links(spark, sf_dir):
    return links.resolve_links(links.extract_links(linked_pages(read_pages(spark, sf_dir))))


@_query
def page_links(spark, sf_dir):
    return links.page_links(linked_pages(read_pages(spark, sf_dir)))


@_query
def count_links(spark, sf_dir):
    return reports.count_links(linked_pages(read_pages(spark, sf_dir)))


# Lineage ---------------------------------------------------------------------------


@_query
def resolve_seed(spark, sf_dir):
    captures = crawl(read_pages(spark, sf_dir), True).select("page_id", "uri", "via", "is_seed", "crawl_time")
    return lineage.resolve_seed(captures).select("page_id", "uri", "seed_url")


@_query
def via_join(spark, sf_dir):
    captures = _parsed(spark, sf_dir, True).select("uri", "via", "status", "content_type", "crawl_time")
    out = lineage.via_join(captures, ("status", "content_type", "crawl_time"))
    return out.select("uri", "via", "via_status", "via_content_type", _time("via_crawl_time"))


# Reports ---------------------------------------------------------------------------


@_query
def count_charsets(spark, sf_dir):
    return reports.count_charsets(_parsed(spark, sf_dir))


@_query
def count_mime_types(spark, sf_dir):
    return reports.count_mime_types(_parsed(spark, sf_dir))


@_query
def bytes_written(spark, sf_dir):
    """Records of a URI that was captured several times were appended in the order of the crawl."""
    raw = cut(assemble.encode_record(crawl(read_pages(spark, sf_dir)), keep=("page_id",)), "raw")
    raw = raw.withColumn("shard", F.when(F.startswith("uri", F.lit("https")), "https").otherwise("http"))
    running = reports.running_bytes(raw, "shard", ("uri", "page_id"))
    total = reports.bytes_written(raw, "shard").withColumnRenamed("shard", "_of")
    return running.join(total.select("_of", "records"), c("shard") == c("_of")).select(
        "shard", "uri", "position", c("records").alias("shard_records")
    )


@_query
def output_text(spark, sf_dir):
    path = fresh_dir(spark, "report")
    reports.output_text(reports.count_charsets(_parsed(spark, sf_dir)), path, "charset")
    return spark.read.text(path).select(c("value").alias("line"))


# Streaming -------------------------------------------------------------------------


def _streamed(spark: SparkSession, sf_dir: str, transform=None) -> DataFrame:
    """The crawl written as RAW files and taken in by the stream."""
    source, target, state = (fresh_dir(spark, x) for x in ("incoming", "ingested", "state"))
    raw_crawl(spark, sf_dir).write.parquet(source)
    ingest.stream_ingest(ingest.stream_rows(spark, source, RAW), target, state, transform=transform).awaitTermination()
    return table.scan_table(spark, target)


@_query
def stream_ingest(spark, sf_dir):
    return _streamed(spark, sf_dir).select(
        "uri", _time(), "status", "content_type", "charset", _digest("body").alias("body_md5"),
        c(table.DATE).cast("string").alias("crawl_date"),
    )


@_query
def stream_filter(spark, sf_dir):
    kept = _streamed(spark, sf_dir, lambda df: ingest.stream_filter(df, 3000, r"^.*/fr/.*$"))
    return kept.select("uri", F.octet_length("body").alias("body_bytes"))
