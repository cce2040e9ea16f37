"""Random records against a plain byte-wise reading of the format."""

import random
import re

from webstrata import encode_record, parse_records
from webstrata.schema import MAGIC

PIECES = [
    b"\r\n", b"\n", b"\r\n\r\n", b"\n\n", b"\r", b":", b" ", b"\t", b"URL: http://a.com/x\r\n", b"URL:https://b.com\n",
    b"URL: dns:c\r\n", b"A: 1\r\n", b"A:2\n", b"A:\r\n", b"Via: \t v \r\n", b"word", b"GET / HTTP/1.0\r\n", b"Host: h\r\n",
    b"HTTP/1.1 200 OK\r\n", b"HTTP/1.0  404\n", b"\xff\xfe", "é".encode(), b"HTTP 12x\r\n", b"Content-Type: text/html\r\n",
]


def random_document(rng):
    if rng.random() < 0.5:
        return MAGIC + b"".join(rng.choices(PIECES, k=rng.randint(0, 14)))
    blank = rng.choice([b"\r\n", b"\n"])
    parts = [b"URL: http://a.com/\r\n", b"".join(rng.choices(PIECES[8:15], k=rng.randint(0, 5))), blank]
    for start in (b"GET / HTTP/1.0\r\n", b"HTTP/1.0 301 M\r\n"):
        parts += [start if rng.random() < 0.8 else b"", b"".join(rng.choices(PIECES[15:], k=rng.randint(0, 5))), rng.choice([b"\n\r\n", b"\n\n", b""])]
    return MAGIC + b"".join(parts) + b"".join(rng.choices(PIECES, k=rng.randint(0, 5)))


def split_at_blank_line(data):
    found = re.search(rb"\n\r?\n", data)
    return (data[: found.start()], data[: found.end()], data[found.end() :]) if found else (data, data, b"")


def read(doc):
    rest, fields = doc[len(MAGIC) :], {}
    while rest:
        line, _, after = rest.partition(b"\n")
        name, colon, value = line.partition(b":")
        rest = after
        if not colon:
            break
        value = value.lstrip(b" \t").removesuffix(b"\r")
        if value:
            fields[name.decode("utf-8", "replace")] = value.decode("utf-8", "replace")
    web = re.match("https?:", fields.get("URL", ""), re.I) is not None
    _, request, response = split_at_blank_line(rest) if web else (b"", b"", rest)
    head, _, body = split_at_blank_line(response) if web else (b"", b"", response)
    status = re.match(rb"\S*\s+(\d+)", head)
    return fields, request, response, body, int(status[1]) if status else 0


def test_random_documents(spark):
    rng = random.Random(7)
    docs = sorted({random_document(rng) for _ in range(9000)})
    df = spark.createDataFrame([(str(i), bytearray(d)) for i, d in enumerate(docs)], "uri string, doc binary")
    seen = 0
    for r in parse_records(df).collect():
        doc = docs[int(r.uri)]
        got = (r.fields, bytes(r.request), bytes(r.response), bytes(r.body), r.status)
        assert got == read(doc), doc
        assert (r.url, r.via) == (r.fields.get("URL"), r.fields.get("Via"))
        seen += bool(r.status)
    assert seen > 500


def test_random_captures_survive(spark):
    rng = random.Random(11)
    rows = []
    for i in range(2000):
        scheme = rng.choice(["http", "https", "HTTP", "dns", "ftp"])
        uri = f"{scheme}://h{i}.com/{rng.choice(['', 'a.html', 'é', 'x?y=z#f'])}"
        if scheme == "dns":
            uri = f"dns:h{i}.com"
        request = b"GET / HTTP/1.0\r\n" + b"X: y\r\n" * rng.randint(0, 3) + b"\r\n"
        head = f"HTTP/1.1 {rng.randint(100, 599)} R\r\nA: b\r\n\r\n".encode()
        body = rng.randbytes(rng.randint(0, 300)) + rng.choice([b"", b"\r\n\r\n", b"\n\nx"])
        via = rng.choice([None, "", " ", "http://v.com/"])
        rows.append((uri, rng.choice([True, False, None]), via, bytearray(request), bytearray(head + body), len(head)))
    df = spark.createDataFrame(rows, "uri string, is_seed boolean, via string, request binary, response binary, head int")
    got = {r.uri: r for r in parse_records(encode_record(df)).collect()}
    assert len(got) == len(rows)
    for uri, is_seed, via, request, response, head in rows:
        r = got[uri]
        web = uri.lower().startswith("http")
        assert r.url == uri and r.is_seed == is_seed and r.via == (via if via and via.strip() else None)
        assert bytes(r.response) == bytes(response) and bytes(r.request) == (bytes(request) if web else b"")
        assert bytes(r.body) == bytes(response[head:] if web else response)
        assert r.status == (int(response[9:12]) if web else 0)
