"""Content type and charset goldens."""

import pytest
from pyspark.sql import functions as F

from webstrata import decode_text, parse_records
from webstrata.functions import charset as C
from webstrata.functions import mime as M
from webstrata.schema import MAGIC

HEADERS = [
    ("text/html; charset=utf-8", "text/html", "UTF-8"),
    ('Text/HTML; Charset="utf8"', "text/html", "UTF-8"),
    ("text/html; charset=ISO8859-1", "text/html", "ISO-8859-1"),
    ("text/html; charset=x-iso-8859-1", "text/html", "ISO-8859-1"),
    ("text/html; charset=iso8859_1", "text/html", "ISO-8859-1"),
    ("text/html; charset=Shift_JIS", "text/html", "SHIFT_JIS"),
    ("text/html; charset=foo bar", "text/html", "FOO"),
    ("text/html; charset", "text/html", None),
    ("text", None, None),
    ("application/xhtml+xml; charset=UTF8", "application/xhtml+xml", "UTF-8"),
    ("text/html;charset=a;charset=b", "text/html", "B"),
    ("text/html; x=1; charset = koi8-r ; y=2", "text/html", "KOI8-R"),
    ("text/html; charset=", "text/html", None),
    ('"text/html"', "text/html", None),
    ("image/vnd.microsoft.icon", "image/vnd.microsoft.icon", None),
]
META = '<meta http-equiv="Content-Type" content="text/html; charset=windows-1252">'
BODIES = [
    ("text/html", f"<html><head>{META}", "text/html", "WINDOWS-1252"),
    ("text/html; charset=utf-8", f"<html><head>{META}", "text/html", "WINDOWS-1252"),
    ("text/html; charset=utf-8", '<meta http-equiv="content-type" content="text/x">', "text/x", "UTF-8"),
    ("text/plain", '<meta http-equiv="Content-Type" content="foo">', "text/html", None),
    (None, '<?xml version="1.0" encoding="koi8-r"?>', None, "KOI8-R"),
    (None, 'junk <?XML version="1.0" ENCODING = "koi8-r"?><a>', None, "KOI8-R"),
    (None, "<?xml version=\"1.0\" encoding='koi8-r'?>", None, None),
    (None, f'<?xml version="1.0"?>{META}', None, None),
    (None, '<!-- --><?xml version="1.0" encoding="koi8-r"?>', None, None),
    ("text/html", "<meta http-equiv='Content-Type' content='text/html; charset=x'>", "text/html", None),
    ("text/html", '<meta content="text/html; charset=x" http-equiv="Content-Type">', "text/html", None),
    ("text/html", f"<head></head>{META}", "text/html", None),
    ("text/html", '<meta charset="x">', "text/html", None),
    ("text/html", f'<meta http-equiv="content-type" name="x">{META}', "text/html", None),
    ("text/html", f'<meta http-equiv="refresh" content="1">{META}', "text/html", "WINDOWS-1252"),
    ("text/html", f"<meta http-equiv=\"content-type\"  content='q'>{META}", "text/html", "WINDOWS-1252"),
    ("image/png", META, "image/png", None),
    (None, META, "text/html", "WINDOWS-1252"),
    ("text/plain; charset=a", '<META\n HTTP-EQUIV = "Content-Type"\n CONTENT = "">', "text/plain", "A"),
    ("text/html", "x" * 100_000 + META + "y" * 100_000, "text/html", "WINDOWS-1252"),
]


def document(content_type, body):
    header = f"Content-Type: {content_type}\r\n" if content_type else ""
    return bytearray(MAGIC + f"URL: http://a.com/\r\n\r\nGET /\r\n\r\nHTTP/1.0 200 OK\r\n{header}\r\n{body}".encode())


def test_header_values(spark):
    df = spark.createDataFrame([(v,) for v, _, _ in HEADERS], "v string")
    got = df.select("v", M.normalize_mime(F.col("v")), M.charset_param(F.col("v"))).collect()
    assert [tuple(r) for r in got] == HEADERS


def test_headers_in_records(spark):
    rows = [(str(i), document(v, "x")) for i, (v, _, _) in enumerate(HEADERS)]
    got = parse_records(spark.createDataFrame(rows, "uri string, doc binary")).collect()
    assert [(r.content_type, r.charset) for r in got] == [(t, c) for _, t, c in HEADERS]


@pytest.mark.parametrize("at", range(len(BODIES)))
def test_declarations(spark, at):
    if not hasattr(test_declarations, "got"):
        rows = [(str(i), document(h, b)) for i, (h, b, _, _) in enumerate(BODIES)]
        test_declarations.got = parse_records(spark.createDataFrame(rows, "uri string, doc binary")).collect()
    r = test_declarations.got[at]
    assert (r.content_type, r.charset) == BODIES[at][2:]


def test_decode(spark):
    rows = [
        ("utf-8", "é–\n".encode(), "é–"),
        ("UTF-8", b"a\xffb\r\n", "a�b"),
        (None, b"\xe9\n\n", "é\n"),
        ("no-such-charset", b"\xe9\x80", "é\x80"),
        ("US-ASCII", b"a\xe9", "a�"),
        ("WINDOWS-1252", b"\x80\x93\xe9", "€“é"),
        ("windows-1252", b"\x81", "�"),
        ("KOI8-R", "Привет".encode("koi8-r"), "Привет"),
        ("ISO-8859-15", b"\xa4", "€"),
        ("CP1251", "Да".encode("cp1251"), "Да"),
        ("SHIFT_JIS", "日本\r".encode("shift_jis"), "日本"),
        ("EUC-KR", "한국".encode("euc-kr"), "한국"),
        ("GB18030", "中文".encode("gb18030"), "中文"),
        ("UTF-16LE", "aé日".encode("utf-16-le"), "aé日"),
        ("UTF-16", "aé日".encode("utf-16"), "aé日"),
        ("UTF16", b"\x00a\xfe\x01", "a\ufe01"),
        ("utf-32", b"\xff\xfe\x00\x00a\x00\x00\x00", "a"),
        ("x-user-defined", b"\xe9", "é"),
        ("x", b"\xe9", "é"),
        ("--", b"\xe9", "é"),
        ("IBM037", b"\xc8\x89", "Hi"),
        ("ISO-2022-JP", "日本a".encode("iso-2022-jp"), "日本a"),
        ("BIG5", b"\xa4\xff", "�"),
        ("UTF-8", b"", ""),
        ("UTF-8", None, None),
    ]
    df = spark.createDataFrame([(c, None if b is None else bytearray(b), t) for c, b, t in rows], "charset string, body binary, want string")
    for r in decode_text(df).collect():
        if r.charset == "BIG5":
            assert "�" in r.text
        else:
            assert r.text == r.want, r


SPELLINGS = [
    ("SJIS", "shift_jis"), ("X-SJIS", "shift_jis"), ("CP932", "cp932"), ("MS932", "cp932"), ("CP949", "cp949"), ("X-WINDOWS-949", "cp949"),
    ("X-GBK", "gbk"), ("CP936", "gbk"), ("KSC5601", "euc_kr"), ("EUCJP", "euc_jp"), ("BIG5HKSCS", "big5hkscs"), ("UTF16", "utf_16"),
    ("KOI8_R", "koi8_r"), ("LATIN2", "iso8859_2"), ("CP866", "cp866"), ("X-MAC-ROMAN", "mac_roman"), ("ISO_8859-15", "iso8859_15"),
    ("csShiftJIS", "shift_jis"), ("windows-1251", "cp1251"), ("TIS-620", "tis_620"),
]


def test_every_registered_label_is_decoded(spark):
    """All labels of the registry and some other spellings, on bytes that any charset has something for."""
    data = bytes(range(0x20, 0x7F)) + b"\xa4\xa2\xb0\xa1\xc6\xfc" + bytes(range(0xC0, 0xE0))
    names = SPELLINGS + [(k.lower(), v) for k, v in C.codecs_by_label().items() if v not in ("utf_16", "utf_32")]
    df = spark.createDataFrame([(k, v, bytearray(data)) for k, v in names], "charset string, codec string, body binary")
    wrong = [r.charset for r in decode_text(df).collect() if r.codec not in ("utf_16", "utf_32") and r.text != data.decode(r.codec, "replace")]
    assert not wrong
    assert [r[0] for r in df.select(C.label(df.charset)).collect()] == [v for _, v in names]


def test_only_multi_byte_rows_go_to_python(spark):
    df = spark.createDataFrame([("UTF-8", bytearray(b"x"))], "charset string, body binary")
    plan = decode_text(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "CASE WHEN" in plan


HTML5 = [
    ('<meta charset="windows-1251">', "WINDOWS-1251"),
    ("<META CHARSET = 'Big5' >", "BIG5"),
    ("<meta charset=utf8/>", "UTF-8"),
    ('<meta name="a" content=\'x charset="no"\' charset=koi8-r>', "KOI8-R"),
    ("<meta/charset=koi8-r>", "KOI8-R"),
    ('<meta name="description" content="charset=big5">', None),
    ("<meta charsets=big5>", None),
    ("<meta data-charset=big5>", None),
    ("<metacharset=big5>", None),
    ("<!-- <meta charset=big5> --><meta charset=koi8-r>", "KOI8-R"),
    ("<!-- <meta charset=big5> -->", None),
    ("</head><meta charset=big5>", None),
    ('<meta http-equiv="Content-Type" charset="big5">', "BIG5"),
    ('<meta http-equiv="Content-Type" content="text/html; charset=koi8-r" charset="big5">', "BIG5"),
    (META, "WINDOWS-1252"),
    (META + '<meta charset="big5">', "WINDOWS-1252"),
    ('<meta charset="">', None),
    ("<meta " + "a=b " * 20_000 + "charset=big5>", "BIG5"),
    ("<meta " + "a=b " * 20_000 + ">", None),
]


def test_html5_charsets(spark):
    head = MAGIC + b"URL: http://a.com/\r\n\r\nGET / HTTP/1.0\r\n\r\nHTTP/1.0 200 OK\r\n"
    rows = [(str(i), bytearray(head + b"\r\n<html><head>" + body.encode())) for i, (body, _) in enumerate(HTML5)]
    raw = spark.createDataFrame(rows, "uri string, doc binary")
    got = {int(r.uri): r for r in parse_records(raw, html5=True).collect()}
    for i, (body, want) in enumerate(HTML5):
        assert got[i].charset == want, body
        assert got[i].content_type == ("text/html" if want else None), body
    plain = {int(r.uri): r.charset for r in parse_records(raw).collect()}
    assert {plain[i] for i in plain} == {None, "WINDOWS-1252", "KOI8-R"}  # by http-equiv alone
