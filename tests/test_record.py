"""Envelope parsing: hand-made documents and what they have to give."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from webstrata import encode_record, parse_records, rewrite_record, valid_records
from webstrata.operators.assemble import named_fields, rename_fields
from webstrata.schema import BAD_HEADER, CAPTURE, MAGIC, TRUNCATED, VERSION, FieldNames

# A record with all that a usual one has: every field but a seed URL, an extension in capitals, a request with a query,
# and a type in the header that the page completes with a charset.
SAMPLE = (
    b"URL: http://library.example.org/shelf.7/List.HTML?page=2\r\n"
    b"Ip-Address: 192.0.2.44\r\nCrawl-Time: 20240229235958\r\nIs-Seed: false\r\n"
    b"Path-From-Seed: LRE\r\nVia: http://library.example.org/start?x=1:2\r\n\r\n"
    b"GET /shelf.7/List.HTML?page=2 HTTP/1.1\r\nHost: library.example.org\r\nAccept: */*\r\n\r\n"
    b"HTTP/1.1 203 Non-Authoritative Information\r\nContent-Length: 77\r\nContent-Type: Text/HTML\r\n\r\n"
    b"<html>\n\n<head><title>Shelf 7</title>\n"
    b'<META HTTP-EQUIV="Content-Type" CONTENT="text/html; charset=iso8859_1">\n</HEAD><p>'
)
OLD = MAGIC.replace(b"0.3", b"0.1")


def http(head: bytes, body: bytes = b"", fields: bytes = b"URL: http://a.com/x.htm\r\n") -> bytes:
    return MAGIC + fields + b"\r\n" + b"GET /x.htm HTTP/1.0\r\n\r\n" + head + body


DOCS = {
    "sample": MAGIC + SAMPLE,
    "old_version": OLD + SAMPLE,
    "short": MAGIC[:6],
    "null": None,
    "dns": MAGIC + b"URL: dns:www.example.com\r\n\r\n20070123\nwww.example.com. 300 IN A 1.2.3.4\n",
    "https": http(b"HTTP/1.1 404 Not Found\r\nContent-Type: text/plain; charset=utf8\r\n\r\n", b"x", b"URL: https://a.com/b\r\n"),
    "colonless": MAGIC + b"URL: http://a.com/\r\nnocolon\r\nVia: x\r\n\r\nHTTP/1.0 200 OK\r\n\r\nB",
    "dup_empty": http(b"HTTP/1.0 200\r\n\r\n", b"", b"URL: http://a.com/\r\nA: 1\r\nA: 2\r\nB: 1\r\nB: \r\nSeed-Url: \r\n"),
    "value_colon": http(b"HTTP/1.0 200\r\n\r\n", b"", b"URL: http://a.com:80/x\r\n"),
    "similar_label": http(b"HTTP/1.0 200\r\n\r\n", b"", b"URL: http://a.com/\r\nURL2: http://b.com/\r\n"),
    "powered_by": http(b"HTTP/1.0 200\r\nContent-Type: text/html\r\nX-Powered-By: PHP/5.2.0\r\n\r\n"),
    "two_types": http(b"HTTP/1.0 200\r\ncontent-type: text/css\r\nCONTENT-TYPE: image/gif\r\n\r\n", b"GIF"),
    "bad_status": http(b"HTTP/1.0 abc\r\n\r\n"),
    "big_status": http(b"HTTP/1.0 99999999999\r\n\r\n"),
    "no_blank": http(b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n"),
    "no_request_end": MAGIC + b"URL: http://a.com/\r\n\r\nGET / HTTP/1.0\r\nHost: a.com",
    "lf_only": MAGIC + SAMPLE.replace(b"\r\n", b"\n"),
    "binary_body": http(b"HTTP/1.0 200\r\nContent-Type: image/png\r\n\r\n", bytes(range(256))),
    "empty_body": http(b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\n"),
    "blank_in_body": http(b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n", b"one\n\ntwo\r\n\r\nthree\n\r\n"),
    "mixed_blank": http(b"HTTP/1.0 200 OK\n\n\r\nrest"),
    "latin1_field": http(b"HTTP/1.0 200\r\n\r\n", b"", b"URL: http://a.com/\r\nNote: caf\xe9\r\nVia: http://b.com/\r\n"),
    "utf8_field": http(b"HTTP/1.0 200\r\n\r\nB\xff", b"", "URL: http://é.com/ü.HTML\r\n".encode()),
    "only_magic": MAGIC,
    "empty_fields": MAGIC + b"\r\nHTTP/1.0 200\r\n\r\nx",
}


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([(k, None if v is None else bytearray(v)) for k, v in DOCS.items()], "uri string, doc binary")


@pytest.fixture(scope="module")
def parsed(raw):
    return {r["uri"]: r for r in parse_records(raw).collect()}


def test_schema(raw):
    got = parse_records(raw).schema
    assert [(f.name, f.dataType.simpleString()) for f in got] == [(f.name, f.dataType.simpleString()) for f in CAPTURE]


def test_sample(parsed):
    for name in ("sample", "lf_only"):
        r = parsed[name]
        assert (r.status, r.content_type, r.charset, r.scheme, r.extension) == (203, "text/html", "ISO-8859-1", "http", "html")
        assert (r.is_seed, r.path_from_seed, r.via) == (False, "LRE", "http://library.example.org/start?x=1:2")
        assert r.crawl_time == dt.datetime(2024, 2, 29, 23, 59, 58)
        assert r.version == VERSION and r.error is None
        assert r.seed_url is None and len(r.fields) == 6
        assert bytes(r.body).startswith(b"<html>\n\n<head>") and bytes(r.body).endswith(b"</HEAD><p>")
        assert bytes(r.request).startswith(b"GET /shelf.7") and bytes(r.request).endswith(b"*/*\n\n" if name == "lf_only" else b"*/*\r\n\r\n")
        assert bytes(r.response).startswith(b"HTTP/1.1 203 Non")


def test_bad_envelopes(parsed):
    assert parsed["old_version"].error == BAD_HEADER
    assert parsed["short"].error == TRUNCATED and parsed["null"].error == TRUNCATED
    for name in ("old_version", "short", "null"):
        r = parsed[name]
        assert all(r[c] is None for c in ("version", "url", "fields", "status", "body", "request", "charset", "content_type"))


def test_not_http(parsed):
    r = parsed["dns"]
    assert (r.scheme, r.status, r.content_type, r.charset, r.extension) == ("dns", 0, None, None, None)
    assert bytes(r.request) == b"" and bytes(r.body) == bytes(r.response) == b"20070123\nwww.example.com. 300 IN A 1.2.3.4\n"


def test_https_like_http(parsed):
    r = parsed["https"]
    assert (r.scheme, r.status, r.content_type, r.charset, bytes(r.body)) == ("https", 404, "text/plain", "UTF-8", b"x")
    assert bytes(r.request) == b"GET /x.htm HTTP/1.0\r\n\r\n"


def test_fields(parsed):
    r = parsed["colonless"]
    assert r.fields == {"URL": "http://a.com/"} and bytes(r.request) == b"Via: x\r\n\r\n"
    assert r.via is None and r.status == 200 and bytes(r.body) == b"B"
    assert parsed["dup_empty"].fields == {"URL": "http://a.com/", "A": "2", "B": "1"}
    assert parsed["dup_empty"].seed_url is None
    assert parsed["value_colon"].url == "http://a.com:80/x"
    assert parsed["similar_label"].url == "http://a.com/"
    r = parsed["latin1_field"]
    assert r.fields["Note"] == "caf�" and r.via == "http://b.com/" and r.status == 200
    r = parsed["utf8_field"]
    assert (r.url, r.extension, bytes(r.body)) == ("http://é.com/ü.HTML", "html", b"B\xff")
    assert parsed["only_magic"].fields == {} and bytes(parsed["only_magic"].body) == b""
    assert parsed["empty_fields"].url is None and bytes(parsed["empty_fields"].body) == b"HTTP/1.0 200\r\n\r\nx"


def test_response(parsed):
    assert parsed["powered_by"].content_type == "text/html"
    assert parsed["two_types"].content_type == "image/gif"
    assert parsed["bad_status"].status == 0 and parsed["big_status"].status == 0
    assert bytes(parsed["no_blank"].body) == b"" and parsed["no_blank"].content_type == "text/html"
    assert bytes(parsed["no_request_end"].request) == b"GET / HTTP/1.0\r\nHost: a.com"
    assert bytes(parsed["no_request_end"].response) == b"" and parsed["no_request_end"].status == 0
    assert bytes(parsed["binary_body"].body) == bytes(range(256)) and parsed["binary_body"].charset is None
    assert bytes(parsed["empty_body"].body) == b""
    assert bytes(parsed["blank_in_body"].body) == b"one\n\ntwo\r\n\r\nthree\n\r\n"
    assert bytes(parsed["mixed_blank"].body) == b"\r\nrest"


def test_modes(raw):
    assert valid_records(raw, "DROPMALFORMED").count() == len(DOCS) - 3
    assert parse_records(raw, mode="DROPMALFORMED").where("error is not null").count() == 0
    assert valid_records(raw, "PERMISSIVE").where("error is not null").count() == 3
    with pytest.raises(Exception, match="bad document header|document truncated"):
        parse_records(raw, mode="FAILFAST").select("status").collect()
    good = raw.where("uri = 'sample'")
    assert parse_records(good, mode="FAILFAST").first()["status"] == 203
    with pytest.raises(ValueError):
        valid_records(raw, "OTHER")


def test_encode_then_parse(spark):
    names = FieldNames(url="Address", via="Referrer")
    row = (
        "http://a.com/x", "10.0.0.1", dt.datetime(2024, 5, 6, 7, 8, 9), True, "  ", None, "http://s.com/",
        bytearray(b"GET /x\r\n\r\n"), bytearray(b"HTTP/1.1 301 M\r\nContent-Type: a/b\r\n\r\n\x00\xff"),
    )
    df = spark.createDataFrame(
        [row, ("dns:a.com", None, None, None, "LL", "http://v.com/\r\nX: y", None, bytearray(b"q"), bytearray(b"p"))],
        "uri string, ip string, crawl_time timestamp_ntz, is_seed boolean, path_from_seed string, via string,"
        "seed_url string, request binary, response binary",
    )
    raw = encode_record(df, names)
    doc = bytes(raw.where("uri = 'http://a.com/x'").first()["doc"])
    assert doc == (
        MAGIC + b"Address: http://a.com/x\r\nIp-Address: 10.0.0.1\r\nCrawl-Time: 20240506070809\r\nIs-Seed: true\r\n"
        b"Seed-Url: http://s.com/\r\n\r\nGET /x\r\n\r\nHTTP/1.1 301 M\r\nContent-Type: a/b\r\n\r\n\x00\xff"
    )
    got = {r["uri"]: r for r in parse_records(raw, names).collect()}
    r = got["http://a.com/x"]
    assert (r.url, r.status, r.content_type, bytes(r.body)) == ("http://a.com/x", 301, "a/b", b"\x00\xff")
    r = got["dns:a.com"]
    assert r.via == "http://v.com/ X: y" and bytes(r.request) == b"" and bytes(r.body) == b"p" and r.path_from_seed == "LL"
    assert "Ip-Address" not in r.fields
    fields = {r["uri"]: r["fields"] for r in named_fields(df).collect()}
    assert set(fields["http://a.com/x"]) == {"URL", "Ip-Address", "Crawl-Time", "Is-Seed", "Seed-Url"}
    assert fields["dns:a.com"]["Ip-Address"] == "" and fields["dns:a.com"]["Path-From-Seed"] == "LL"
    renamed = rename_fields(named_fields(df), FieldNames(), names).where("uri like 'http%'").first()["fields"]
    assert "Address" in renamed and "URL" not in renamed and renamed["Ip-Address"] == "10.0.0.1"


def test_utc_digits_of_instants(spark):
    df = spark.sql("select 'http://a/' as uri, timestamp'2024-01-02 03:04:05+02:00' as crawl_time")
    assert named_fields(df).first()["fields"]["Crawl-Time"] == "20240102010405"


def test_rewrite(raw):
    cap = parse_records(raw.where("uri in ('sample', 'dup_empty')"))
    out = rewrite_record(cap, {"Via": None, "Note": "n", "A": F.concat(F.col("uri"), F.lit("!"))})
    docs = {r["uri"]: bytes(r["doc"]) for r in out.collect()}
    assert docs["dup_empty"] == MAGIC + b"URL: http://a.com/\r\nA: dup_empty!\r\nB: 1\r\nNote: n\r\n\r\n" + (
        b"GET /x.htm HTTP/1.0\r\n\r\nHTTP/1.0 200\r\n\r\n"
    )
    again = {r["uri"]: r for r in parse_records(out).collect()}
    assert again["sample"].via is None and again["sample"].fields["Note"] == "n" and again["sample"].status == 203
    changed = rewrite_record(cap, response=F.encode(F.lit("HTTP/1.0 500 E\r\n\r\nx"), "UTF-8"))
    assert {r.status for r in parse_records(changed).collect()} == {500}
    same = rewrite_record(cap)
    a, b = (parse_records(x).orderBy("uri").collect() for x in (raw.where("uri in ('sample', 'dup_empty')"), same))
    assert [{k: v for k, v in x.asDict().items()} for x in a] == [{k: v for k, v in x.asDict().items()} for x in b]


def test_no_python_in_the_plan(raw):
    plan = parse_records(raw)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_unused_columns_are_not_computed(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([("u", bytearray(MAGIC), "x")], "uri string, doc binary, other string").write.parquet(path)
    plan = parse_records(spark.read.parquet(path)).select("uri")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<uri:string>" in plan


def test_rename_over_a_field_of_its_own(spark):
    df = spark.createDataFrame([({"Via": "a", "Referrer": "b", "X": "c"},), ({"Referrer": "b"},), (None,)], "fields map<string,string>")
    got = [r.fields for r in rename_fields(df, FieldNames(), FieldNames(via="Referrer")).collect()]
    assert got == [{"Referrer": "a", "X": "c"}, {"Referrer": "b"}, None]
    both = spark.createDataFrame([({"Via": "a", "Ip-Address": "b"},)], "fields map<string,string>")
    swapped = rename_fields(both, FieldNames(), FieldNames(via="Ip-Address", ip="Via")).first().fields
    assert swapped == {"Ip-Address": "a", "Via": "b"}
