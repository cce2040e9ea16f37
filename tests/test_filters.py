"""Filters, and filters on columns that operators derive."""

from pyspark.sql import functions as F

from webstrata import (
    annotate_size, decode_text, dedupe_captures, extract_links, filter_media, filter_size, filter_url_reject, page_links,
    parse_records,
)
from webstrata.operators.links import with_base
from webstrata.plans.page_crawl import linked_pages, raw_crawl, read_pages


def test_size(spark):
    df = spark.createDataFrame([("a", bytearray(9)), ("b", bytearray(10)), ("c", bytearray(11)), ("d", None)], "uri string, body binary")
    assert [r.uri for r in filter_size(df, 10).collect()] == ["a", "b", "d"]
    assert [r.annotation for r in annotate_size(df, 10).collect()] == [None, None, "unwritten:size", None]
    assert filter_size(df).count() == 4


def test_urls(spark):
    urls = ["dns:a.com", "http://a.com/robots.txt", "http://a.com/x.css", "http://a.com/x.js", "http://a.com/js", "http://a.com/x.json", "http://a.com/", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r.url for r in filter_url_reject(df).collect()] == ["http://a.com/x.json", "http://a.com/", None]


def test_media(spark):
    df = spark.createDataFrame([(e,) for e in ("html", "jpg", "mp3", None, "php")], "extension string")
    assert [r.extension for r in filter_media(df).collect()] == ["html", None, "php"]


def test_filters_on_derived_columns(spark, sf_dir):
    """Each has to be planned and run as it stands; pushed into the operator, its
    expressions would multiply until nothing can be compiled."""
    captures = parse_records(raw_crawl(spark, sf_dir))
    pages = linked_pages(read_pages(spark, sf_dir))
    cases = [
        (captures, "status = 200 and charset = 'UTF-8' and content_type like 'text%' and length(body) > 0"),
        (dedupe_captures(captures), "canonical_url like 'http://www%'"),
        (with_base(pages), "base_url like 'http://z%'"),
        (extract_links(pages), "base_url like 'http://z%' and href like '/%'"),
        (page_links(pages), "is_internal and target_url like 'http%'"),
        (page_links(pages, keep_unresolved=True), "target_url is null"),
        (decode_text(captures), "text like '%a%'"),
    ]
    for df, condition in cases:
        kept, every = df.where(condition), df.select("*", F.expr(condition).alias("_wanted"))
        assert len(kept._jdf.queryExecution().optimizedPlan().toString()) < 200_000
        assert 0 < kept.count() == every.where("_wanted").count()
