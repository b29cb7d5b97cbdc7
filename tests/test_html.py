from html import unescape

import pytest

from pyspark.sql import functions as F

from webloom.functions import html

PAGE = """<html><head><meta charset="utf-8"><meta name="description" content="D1"><meta name="description" content="D2">
<meta property="og:x" content="n"><title>T1</title><link rel="stylesheet" href="/s.css"><link rel="icon" href="/f.ico">
<link rel="x" href="/y.svg"><script src="https://c/x.js"></script><script src="/l.js">var t="</p><a href='https://no'>";</script></head>
<body><!-- <a href="https://no2">x</a> --><h1> H <b>one</b></h1><h2>S &amp; T</h2><p>P1<p>P2</p><img src="https://i/1.png">
<img src="/2.png"><a href="https://e/1">a</a><a href="http://e/2">b</a><a href="/d.pdf">c</a><a href="#top">d</a><a>e</a>
<a href="https://e/f.pdf">f</a></body></html>"""


def parse(spark, *pages):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "page_id int, html string")
    rows = html.parse_pages(df).orderBy("page_id").collect()
    out = [r["content"].asDict(recursive=True) for r in rows]
    return out[0] if len(out) == 1 else out


def test_whole_page(spark):
    c = parse(spark, PAGE)
    assert c["links"] == {
        "https": ["https://e/1", "https://e/f.pdf"],
        "http": ["http://e/2"],
        "files": ["/d.pdf"],
        "internal": ["#top", ""],
    }
    assert c["metadata"] == {
        "charset": ["utf-8"],
        "other": {"description": ["D1", "D2"]},
        "title": ["T1"],
        "styles": ["/s.css"],
        "logo": ["/f.ico"],
        "scripts": ["https://c/x.js"],
    }
    assert c["imgs"] == {"imgs": ["https://i/1.png"]}
    assert c["texts"] == {"h1": [" H one"], "h2": ["S & T"], "p": ["P1", "P2"]}


@pytest.mark.parametrize(
    "tag, links",
    [
        ("<a href=/x.zip>", {"files": ["/x.zip"]}),
        ("<A  HREF = 'https://q/a b'>", {"https": ["https://q/a b"]}),
        ('<a title="a > b" href="/y">', {"internal": ["/y"]}),
        ("<a title=\" href='https://no'\" href='/z'>", {"internal": ["/z"]}),
        ("<a href>", {"internal": [""]}),
        ("<a/href=http://s/>", {"http": ["http://s/"]}),
        ('<a href="/one" href="/two">', {"internal": ["/one"]}),
        ('<a href="?a=1&amp;b=2">', {"internal": ["?a=1&b=2"]}),
        ("<abbr href='https://no'>", {}),
        ("<a href='X.PDF'>", {"internal": ["X.PDF"]}),
        ("<a href='mypdf'>", {"files": ["mypdf"]}),
        ("<noscript><a href='https://no'></noscript>", {}),
        ("<!-- <a href='https://no'> never closed", {}),
        ("<script>'<a href=https://no>'", {}),
        ("<a\nhref\n=\n'https://nl'>", {"https": ["https://nl"]}),
        ("<textarea><a href='https://no'></textarea><a href='/t'>", {"internal": ["/t"]}),
    ],
)
def test_links(spark, tag, links):
    want = {"https": [], "http": [], "files": [], "internal": [], **links}
    assert parse(spark, f"<body>{tag}x</a>")["links"] == want


def test_presence_of_attributes(spark):
    c = parse(
        spark,
        "<meta http-equiv=x content='text/html; charset=utf-8'><meta charset=''><meta name content=c>"
        "<meta charset=u name=hidden><meta name=n><title>a</title><title>b</title>",
    )
    assert c["metadata"]["charset"] == ["", "u"]
    assert c["metadata"]["other"] == {"": ["c"], "n": [""]}
    assert c["metadata"]["title"] == ["ab"]
    assert parse(spark, "<p>x")["metadata"]["title"] == [""]


@pytest.mark.parametrize(
    "body, p",
    [
        ("<p>a<br>b <i>c</i><div>d</div>", ["ab c"]),
        ("<p>a<script>if (x<y) '<p>'&amp;</script>b</p>", ["aif (x<y) '<p>'&amp;b"]),
        ("<ul><li><p>a<li><p>b</ul>", ["a", "b"]),
        ("<p>&eacute;&#233;&#xE9;&nbsp;&euro;&amp;lt;&bogus;&&#0;", ["ééé €&lt;&bogus;&�"]),
        ("<P CLASS=x>up</P><pre>no</pre>", ["up"]),
        ("<p></p><p> </p>", ["", " "]),
        ("<p>a<!-- <p>b</p> -->c</p>", ["ac"]),
        ("<p>1 < 2</p>", ["1 < 2"]),
        ("no paragraphs", []),
    ],
)
def test_paragraphs(spark, body, p):
    assert parse(spark, f"<body>{body}")["texts"]["p"] == p


def test_headings(spark):
    c = parse(spark, "<h1>a</h1><H2 id='>'>b<h2>c</h2><h3>no</h3><h1>d<em>e</em></h1>")
    assert c["texts"]["h1"] == ["a", "de"]
    assert c["texts"]["h2"] == ["b", "c"]


def test_long_tag_does_not_overflow(spark):
    c = parse(spark, f"<a data-x=\"{'y' * 200_000}\" {'z ' * 50_000} href='/far'>t</a>")
    assert c["links"]["internal"] == ["/far"]


def test_decode_body(spark):
    df = spark.createDataFrame(
        [
            (bytearray("añé".encode("latin-1")), "text/html; charset=ISO-8859-1"),
            (bytearray("añé".encode()), "text/html; charset=utf-8"),
            (bytearray("añé".encode()), None),
            (bytearray("añé".encode()), "text/html"),
        ],
        "body binary, ct string",
    )
    got = df.select(html.decode_body(F.col("body"), F.col("ct")).alias("t")).collect()
    assert [r.t for r in got] == ["añé"] * 4


def test_needs_render(spark):
    prose = "<html><body>" + "a plain paragraph " * 150 + "</body></html>"
    cases = [
        (PAGE[:900], True),
        (prose, False),
        (prose.replace("<body>", '<body ID="APP">'), True),
        (prose + "<body></body>", True),
        ("<html><body>" + "z" * 2000 + "</body></html>", True),
        ("<html>" + "z" * 2000, False),
        (prose.replace("<html>", "<html ng-app>"), True),
    ]
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(cases)], "i int, h string")
    got = df.select("i", html.needs_render(F.col("h")).alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == [want for _, want in cases]


REFERENCES = [
    "don&apos;t", "&copy 2024", "&#0000000065;", "&#150;&#129;&#x80;", "&notit;", "&amp", "&ampx", "&nope;",
    "&#x1F600;&#x1f600", "&#99999999999;", "&#xD800;", "&#0;", "&#;", "&#x;", "&", "&&lt;", "&NotEqualTilde;",
    "&lt;&#38;amp;", "a&b;c", "&CounterClockwiseContourIntegral;", "&not;in", "&notin;", "&#65 &#65x", "é&eacute",
]


def test_references_as_the_standard_library_reads_them(spark):
    df = spark.createDataFrame([(t,) for t in REFERENCES], "t string")
    for r in df.select("t", html.decode_entities(F.col("t")).alias("d")).collect():
        assert r.d == unescape(r.t).replace(unescape("&#129;"), chr(129)), r.t


def test_references_in_attributes(spark):
    df = spark.createDataFrame(
        [("?a=1&copy=2",), ("?a&notit=3",), ("&copy;=1",), ("&copy!",), ("&lt&#38;x",), ("&amp",)], "t string"
    )
    got = [r.d for r in df.select(html.decode_entities(F.col("t"), True).alias("d")).collect()]
    assert got == ["?a=1&copy=2", "?a&notit=3", "©=1", "©!", "<&x", "&"]
