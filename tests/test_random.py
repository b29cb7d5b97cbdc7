"""Random inputs against plain Python."""

import random
import re
from collections import Counter
from html.parser import HTMLParser

from pyspark.sql import functions as F

from webloom.functions import html
from webloom.operators import index

BLOCKS = {"h1", "h2", "p", "div", "ul", "li"}


class Reader(HTMLParser):
    """Links, headings and paragraphs; a paragraph ends at the next block tag."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.links, self.texts, self.open = [], {"h1": [], "h2": [], "p": []}, None

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.links.append(dict(reversed(attrs)).get("href") or "")
        if tag in BLOCKS and (self.open == "p" or tag in ("h1", "h2")):
            self.open = None
        if tag in self.texts:
            self.open = tag
            self.texts[tag].append("")

    def handle_endtag(self, tag):
        if tag in BLOCKS and (self.open == "p" or tag == self.open):
            self.open = None

    def handle_data(self, data):
        if self.open:
            self.texts[self.open][-1] += data


def random_page(rng):
    text = lambda: rng.choice(["a b", "x &amp; y", "&eacute;&#241;", "1 &lt; 2", "", " ", "ü\n"])
    value = lambda: rng.choice(["/p", "https://e.x/?a=1&amp;b=2", "http://u", "f.pdf", "#t", ""])

    def anchor():
        q = rng.choice(['"', "'"])
        extra = rng.choice(["", ' title="a > b"', " data-href='https://no'", " disabled"])
        href = rng.choice([f" href={q}{value()}{q}", f" HREF = {q}{value()}{q}", ""])
        parts = [extra, href]
        rng.shuffle(parts)
        return f"<a{''.join(parts)}>{text()}</a>"

    def inline():
        return "".join(
            rng.choice([text, anchor, lambda: f"<b>{text()}</b>", lambda: f"<!-- <p>{text()} -->", lambda: "<br/>"])()
            for _ in range(rng.randrange(4))
        )

    def block():
        return rng.choice([
            lambda: f"<p class=x>{inline()}</p>", lambda: f"<p>{inline()}", lambda: f"<h1>{inline()}</h1>",
            lambda: f"<h2 id='>'>{inline()}</h2>", lambda: f"<div>{inline()}</div>",
            lambda: f"<ul><li>{inline()}<li>{inline()}</ul>",
            lambda: f"<script>var s = '<a href=\"https://no\"><p>';</script>",
            lambda: "<style>p > a {}</style>",
        ])()

    return "<html><body>" + "".join(block() for _ in range(rng.randrange(12))) + "</body></html>"


def test_pages_against_a_parser(spark):
    rng = random.Random(5)
    pages = [random_page(rng) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string").repartition(8)
    for r in html.parse_pages(df).collect():
        reader = Reader()
        # Inside a paragraph script text would count as text; here it stands between blocks.
        reader.feed(re.sub(r"<(script|style)>.*?</\1>", "<div></div>", pages[r.page_id]))
        reader.close()
        links = r.content.links
        got = sorted(links.https + links.http + links.files + links.internal)
        assert got == sorted(reader.links), pages[r.page_id]
        texts = r.content.texts.asDict()
        if "<script>" not in pages[r.page_id] and "<style>" not in pages[r.page_id]:
            assert texts == reader.texts, pages[r.page_id]


def test_index_against_counting(spark):
    rng = random.Random(6)
    letters = "ab éÑñü.,-\n0Ω"
    docs = ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_key bigint, text string").repartition(8)
    want = {
        (t, i): n
        for i, d in enumerate(docs)
        for t, n in Counter(re.findall("[a-z0-9áéíóúñ]+", d.lower())).items()
    }
    posts = index.postings(index.tokens(df))
    assert {(r.token, r.doc_key): r.tf for r in posts.collect()} == want
    freqs = {r.token: r.doc_freq for r in index.doc_freq(df).collect()}
    assert freqs == Counter(t for t, _ in want)
    assert all(r.idf >= 0 for r in index.idf(index.doc_freq(df), df).collect())


def test_sorted_index_files_do_not_overlap(spark, tmp_path):
    posts = spark.range(20_000).selectExpr(
        "case when id % 3 = 0 then 'hot' else concat('t', id % 500) end as token",
        "id as doc_key", "1L as tf",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index.write_sorted(posts, str(tmp_path / "i"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = (
        spark.read.parquet(str(tmp_path / "i"))
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.min(F.struct("token", "doc_key")).alias("lo"), F.max(F.struct("token", "doc_key")).alias("hi"),
             F.max((F.col("token") == "hot").cast("int")).alias("hot"))
        .orderBy("lo")
        .collect()
    )
    assert all(a.hi < b.lo for a, b in zip(files, files[1:]))
    assert sum(f.hot for f in files) > 1
