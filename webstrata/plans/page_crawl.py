"""A crawl made out of the ``pages`` table.

Every value is a closed form of ``page_id``, so that the result of each query can be
worked out without parsing anything. Pages come in chains of ten: the first is a
seed, each other one was reached from the page before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stages import cut
from ..functions.urls import host
from ..operators.assemble import encode_record

XML = '<?xml version="1.0" encoding="koi8-r"?>'
META = (
    '<html><head><meta http-equiv="Content-Type" content="text/html; charset=windows-1252"></head>'
)
CONTENT_TYPES = {
    0: "text/html; charset=utf-8",
    1: 'Text/HTML; Charset="ISO8859-1"',
    2: "application/xhtml+xml; charset=UTF8",
    3: "text/html",
}
START = "2024-01-01 00:00:00"

# Links put behind each page; {id} stands for the page number.
ODD_LINKS = (
    '<a href="x{id}.html">',
    "<A HREF='/r'>",
    "<a href=q.html>",
    '<a href="../u">',
    '<a href="#f">',
    '<a href="?k={id}">',
    '<a href="//c.com/y">',
    '<a href="http://b.com">',
    '<a href="https://b.com/z">',
    '<a href="http://b.com/m/../n">',
    '<a href="mailto:m@a.com">',
    '<a href="http://[bad">',
    '<a name="top">',
    '<a hreflang="en">',
    '<abbr href="x">',
    '<a disabled href="v">',
    '<a class="c" href="w">',
)


def read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def page_fields() -> dict[str, Column]:
    """Crawl metadata of a page by its number."""
    page_id = F.col("page_id")
    chain = page_id % 10
    return {
        "is_seed": chain == 0,
        "path_from_seed": F.repeat(F.lit("L"), chain.cast("int")),
        "ip": F.concat_ws(".", F.lit("10"), F.lit("0"), page_id % 7, page_id % 251),
        "crawl_time": F.timestamp_add("MINUTE", page_id, F.lit(START).cast("timestamp_ntz")),
        "status": F.when(page_id % 20 == 0, 404).when(page_id % 20 == 1, 301).otherwise(200),
    }


def content_type_header() -> Column:
    page_id = F.col("page_id")
    out = F.lit(None).cast("string")
    for k, v in CONTENT_TYPES.items():
        out = F.when(page_id % 5 == k, F.lit(v)).otherwise(out)
    return out


def body_text() -> Column:
    page_id = F.col("page_id")
    prefix = F.when(page_id % 5 == 3, F.lit(META)).when(page_id % 5 == 4, F.lit(XML)).otherwise(F.lit(""))
    return F.concat(prefix, F.col("html"))


def crawl(pages: DataFrame, lineage: bool = False) -> DataFrame:
    """Captures ready to be written: ``page_id``, field columns, request, response.

    With ``lineage`` referrer and seed URL are looked up by page number; the other
    side of the joins carries only numbers and URLs."""
    fields = page_fields()
    reason = F.when(F.col("status") == 404, "Not Found").when(F.col("status") == 301, "Moved Permanently").otherwise("OK")
    header = content_type_header()
    head = F.concat(
        F.lit("HTTP/1.1 "), F.col("status").cast("string"), F.lit(" "), reason,
        F.lit("\r\nX-Powered-By: PHP/5.2.0\r\n"),
        F.when(header.isNotNull(), F.concat(F.lit("Content-Type: "), header, F.lit("\r\n"))).otherwise(F.lit("")),
        F.lit("Connection: close\r\n\r\n"),
    )
    request = F.concat(F.lit("GET / HTTP/1.0\r\nHost: "), host(F.col("url")), F.lit("\r\n\r\n"))
    df = pages.select("*", *[v.alias(k) for k, v in fields.items()])
    columns = [
        F.col("page_id"), F.col("url").alias("uri"), F.col("url"), F.col("ip"), F.col("crawl_time"),
        F.col("is_seed"), F.col("path_from_seed"), F.col("status"),
        F.encode(request, "UTF-8").alias("request"),
        F.encode(F.concat(head, body_text()), "UTF-8").alias("response"),
    ]
    if not lineage:
        return cut(df.select(*columns), "crawl")
    urls = pages.select("page_id", "url")
    parent = urls.select((F.col("page_id") + 1).alias("_child"), F.col("url").alias("_via"))
    seed = urls.where("page_id % 10 = 0").select(F.col("page_id").alias("_seed_id"), F.col("url").alias("_seed"))
    out = (
        df.join(parent, F.col("page_id") == F.col("_child"), "left")
        .join(seed, F.col("page_id") - F.col("page_id") % 10 == F.col("_seed_id"), "left")
        .select(
            *columns,
            F.when(~F.col("is_seed"), F.col("_via")).alias("via"),
            F.when(F.col("is_seed"), F.lit("")).otherwise(F.col("_seed")).alias("seed_url"),
        )
    )
    return cut(out, "crawl")


def raw_crawl(spark: SparkSession, sf_dir: str, lineage: bool = False) -> DataFrame:
    """RAW rows of the crawl."""
    return cut(encode_record(crawl(read_pages(spark, sf_dir), lineage)), "raw")


def linked_pages(pages: DataFrame) -> DataFrame:
    """Pages with odd links behind them and, on every fourth, a base element: ``url``, ``body``."""
    page_id = F.col("page_id").cast("string")
    base = F.when(
        F.col("page_id") % 4 == 3,
        F.concat(
            F.lit('<head><base target="t" href="http://z'), (F.col("page_id") % 3).cast("string"), F.lit('.com/k/"></head>')
        ),
    ).otherwise(F.lit(""))
    odd = F.concat(*[F.replace(F.lit(x), F.lit("{id}"), page_id) for x in ODD_LINKS])
    return pages.select("page_id", "url", F.encode(F.concat(base, F.col("html"), odd), "UTF-8").alias("body"))
