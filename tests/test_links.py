"""Elements, attributes, base and links."""

from pyspark.sql import functions as F

from webstrata import count_links, element_content, extract_attributes, extract_elements, page_links
from webstrata.functions import urls as U
from webstrata.operators.links import _hrefs, _resolved, with_base

PAGE = "http://a.com/d/p.html"
GOLDEN = [
    ('<a href="x.html">', "http://a.com/d/x.html"),
    ("<A HREF='/r'>", "http://a.com/r"),
    ("<a href=q.html>", "http://a.com/d/q.html"),
    ('<a href="../u">', "http://a.com/u"),
    ('<a href="#f">', "http://a.com/d/p.html#f"),
    ('<a href="?k=1">', "http://a.com/d/p.html?k=1"),
    ('<a href="//c.com/y">', "http://c.com/y"),
    ('<a href="http://b.com">', "http://b.com/"),
    ('<a href="https://b.com/z">', "https://b.com/z"),
    ('<a href="http://b.com/m/../n">', "http://b.com/n"),
    ('<a href="mailto:m@a.com">', "mailto:m@a.com"),
    ('<a href="http://[bad">', None),
    ('<a name="top">', "-"),
    ('<a hreflang="en">', "-"),
    ('<abbr href="x">', "-"),
    ('<a disabled href="v">', "http://a.com/d/v"),
    ('<a class="c" href="w">', "http://a.com/d/w"),
    ('<head><base target="t" href="http://z.com/k/"></head><a href="x">', "http://z.com/k/x"),
    ('<head><base href="k/"></head><a href="x">', "http://a.com/d/k/x"),
    ('<head><base href="http://[bad"></head><a href="x">', "http://a.com/d/x"),
    ('<head><base target="t"></head><a href="x">', "http://a.com/d/x"),
    ('<base href="http://z.com/k/"><a href="x">', "http://a.com/d/x"),
    ('<a title="see href=no" href="yes">', "http://a.com/d/yes"),
    ("<a title='a > b' href=\"x\">", "-"),
    ('<a title="q\\" href=z" href="ok">', "http://a.com/d/ok"),
    ('<a href = "sp" >', "http://a.com/d/sp"),
    ("<a\n\thref='nl'\n>", "http://a.com/d/nl"),
    ('<a href="open>text', "http://a.com/d/open"),
    ("<a href=x/y/ >", "http://a.com/d/x/y/"),
    ("<!-- <a href='c'> -->", "http://a.com/d/c"),
    ('<a href="é?ü">', "http://a.com/d/é?ü"),
]


def pages(spark, htmls):
    rows = [(PAGE, i, bytearray(h.encode())) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, "url string, n int, body binary")


def test_golden_links(spark):
    rows = [(f"{PAGE}?{i}", bytearray(h.encode())) for i, (h, _) in enumerate(GOLDEN)]
    df = spark.createDataFrame(rows, "url string, body binary").withColumn("u", F.lit(PAGE))
    one = df.select(F.col("u").alias("url"), "body", F.col("url").alias("id"))
    got = {}
    staged = with_base(one.withColumn("_html", F.col("body").cast("string")), "url", "body").withColumn("src_url", F.col("url"))
    staged = U.with_base_parts(staged, "base_url").withColumn("src_host", U.host(F.col("url")))
    for r in _resolved(_hrefs(staged, ("id", "src_host", "_base")), True).collect():
        got[int(r["id"].rsplit("?", 1)[1])] = r["target_url"]
    assert [got.get(i, "-") for i in range(len(GOLDEN))] == [w for _, w in GOLDEN]


def test_page_links(spark):
    html = "".join(h for h, _ in GOLDEN[:17])
    df = pages(spark, [html])
    got = page_links(df).orderBy("pos").collect()
    assert [r.target_url for r in got] == [w for _, w in GOLDEN[:17] if w not in (None, "-")]
    assert [r.target_url for r in got if not r.is_internal] == [
        "http://c.com/y", "http://b.com/", "https://b.com/z", "http://b.com/n", "mailto:m@a.com",
    ]
    assert page_links(df).columns == ["src_url", "pos", "href", "target_url", "is_internal"]
    counts = count_links(df).collect()
    assert [tuple(r) for r in counts] == [("a.com", 8, 5, 1)]


def test_elements_and_attributes(spark):
    df = pages(spark, ['<p><P class=a id="b" checked data-x=\'1 2\'/><pre><p\n>x</p><p'])
    tags = extract_elements(df, "p")
    assert [(r.pos, r.tag) for r in tags.collect()] == [
        (0, "<p>"), (1, "<P class=a id=\"b\" checked data-x='1 2'/>"), (2, "<p\n>"),
    ]
    got = [(r.pos, r.name, r.value) for r in extract_attributes(tags).collect()]
    assert got == [(1, "class", "a"), (1, "id", "b"), (1, "checked", None), (1, "data-x", "1 2")]


def test_content(spark):
    df = pages(
        spark,
        [
            "<TITLE>one</title><title x>two</TITLE><title></title>",
            "<title>open <title>closed</title> <title>never",
            "<title />no</title>",
            "<title>at the end</title",
        ],
    )
    got = element_content(df, "title", ("n",)).orderBy("n", "pos").collect()
    assert [(r.n, r.content) for r in got] == [
        (0, "one"), (0, "two"), (0, ""), (1, "open <title>closed"), (3, "at the end"),
    ]


def test_large_pages_stay_linear(spark):
    big = [
        "<li>" * 200_000,
        '<a title="' + "x\\" * 1_000_000 + 'z" href="far">',
        "<a " + "b " * 300_000 + 'href="far">',
        "<" * 1_000_000,
        "<head " * 200_000,
    ]
    df = pages(spark, big)
    assert extract_elements(df, "li").count() == 200_000
    assert element_content(df, "li").count() == 0
    hrefs = [r.href for r in page_links(df).collect()]
    assert hrefs == ["far", "far"]
