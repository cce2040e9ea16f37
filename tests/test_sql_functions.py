"""SQL functions give what the column builders give."""

from pyspark.sql import functions as F
from test_mime import HEADERS
from test_urls import CANONICAL

from webstrata import register_functions
from webstrata.functions import bytesview as B
from webstrata.functions import mime as M
from webstrata.functions import urls as U

URL_CASES = [u for u, _, _ in CANONICAL] + ["ftp://u@A.com:1/x.y.Z", "dns:a.com", "http://a.com/f.", "HTTP://[::1]/q.js?a.b"]


def test_url_functions(spark):
    assert "canonical_url" in register_functions(spark)
    df = spark.createDataFrame([(u,) for u in URL_CASES], "u string")
    df.createOrReplaceTempView("some_urls")
    got = spark.sql(
        "select u, url_scheme(u), url_extension(u), url_host(u), canonical_url(u), url_fingerprint(u) from some_urls"
    ).collect()
    x = F.col("u")
    want = df.select(x, U.scheme(x), U.extension(x), U.host(x), U.canonical_url(x), U.url_fingerprint(x)).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_other_functions(spark):
    register_functions(spark)
    df = spark.createDataFrame([(h,) for h, _, _ in HEADERS], "h string")
    got = df.select("h", F.expr("mime_type(h)"), F.expr("charset_param(h)"), F.expr("clean_charset(h)")).collect()
    x = F.col("h")
    want = df.select(x, M.normalize_mime(x), M.charset_param(x), M.clean_charset(x)).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    raw = df.select(F.encode("h", "UTF-8").alias("d"))
    rows = raw.select("d", F.expr("frame_document(d)").alias("f"), F.expr("unframe_document(frame_document(d))").alias("u"), B.frame(F.col("d")).alias("w")).collect()
    assert all(r.f == r.w and r.u == r.d for r in rows)
