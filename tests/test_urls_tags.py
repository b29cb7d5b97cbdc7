import json

import pytest
from pyspark.sql import functions as F

from webloom.functions import tags, urls
from webloom.operators.tagging import to_page_rows
from webloom.schema import CONTENT
from webloom.sources import config_files


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "url, domain, scheme, path, clean",
    [
        ("https://h.es:8080/a%20b?x=1#f", "h.es", "https", "/a b", "_a_b"),
        ("http://h.es", "h.es", "http", "", "empty"),
        ("https://under_score.es/x", "under_score.es", "https", "/x", "_x"),
        ("https://h.es/a+b", "h.es", "https", "/a+b", "_a_b"),
        ("HTTPS://me:pw@H.es/ñ b", "H.es", "https", "/ñ b", "___b"),
        ("https://[::1]:80/x", "::1", "https", "/x", "_x"),
        ("https://h.es?q=/a", "h.es", "https", "", "empty"),
    ],
)
def test_parts(spark, url, domain, scheme, path, clean):
    u = F.lit(url)
    assert one(spark, urls.domain(u)) == domain
    assert one(spark, urls.scheme(u)) == scheme
    assert one(spark, urls.path(u)) == path
    assert one(spark, urls.sanitize_path(urls.path(u))) == clean


def test_broken_escape_is_null(spark):
    assert one(spark, urls.path(F.lit("https://h.es/a%2"))) is None


def test_internal_links(spark):
    links = F.array(*[F.lit(v) for v in ["/x", "y", "#t", "mailto:a", "//c/z", "", "/", "../u"]])
    got = one(spark, urls.resolve_internal(F.lit("https://h.es:8080/d/p"), links))
    assert got == ["https://h.es/x", "https://h.es/y", "https://h.es/../u"]


def test_lookup_candidates(spark):
    assert one(spark, urls.lookup_candidates(F.lit(" a.es "))) == ["https://a.es", "https://a.es/"]
    assert one(spark, urls.lookup_candidates(F.lit("https://a.es/"))) == [
        "https://a.es/",
        "https://a.es",
    ]


def content(**fields):
    return {
        "links": {"http": None, "https": fields.get("https"), "files": None, "internal": None},
        "metadata": {
            "charset": None, "logo": fields.get("logo"), "scripts": None, "styles": None,
            "title": None, "other": None,
        },
        "imgs": None,
        "texts": {"h1": fields.get("h1"), "h2": None, "p": fields.get("p")},
    }


def tags_of(spark, domain, path, c, dictionary=tags.DEFAULT_DICTIONARY):
    df = spark.createDataFrame([(c,)], f"content {CONTENT.simpleString()}")
    return df.select(
        tags.page_tags(F.lit(domain), F.lit(path), F.col("content"), dictionary).alias("t")
    ).first().t


def test_all_tag_kinds(spark):
    c = content(
        h1=["Tutorial API"],
        p=["We offer cloud systems and data tools, y soporte"],
        https=["https://e/"],
    )
    assert tags_of(spark, "blog.shop.es", "/login/products", c) == [
        "autenticación", "blog", "cloud s", "data tools", "ecommerce", "educación",
        "producto", "sitio_seguro", "stems", "tecnología",
    ]


def test_no_content_no_tags(spark):
    assert tags_of(spark, "x.es", "/", content()) == []


def test_patterns_overlap_and_limits(spark):
    c = content(p=["We are experts in big data", "we are a, bb, one two three four five, ññ"])
    got = tags_of(spark, "x.es", "/", c, tags.Dictionary({}, tags.DEFAULT_DICTIONARY.patterns))
    assert got == ["big data", "experts in big data"]


def test_pattern_without_literal_start(spark):
    d = tags.Dictionary({}, [r"(?:we|you) like ([a-z\s]+)", "only ([a-z]+)"])
    c = content(p=["You like green tea", "only cats"])
    assert tags_of(spark, "x.es", "/", c, d) == ["cats", "green tea"]


def test_page_row(spark):
    df = spark.createDataFrame(
        [("https://a.es/x?q=1", content(h1=["X"], p=["about us"], https=["https://b.es/"]))],
        f"url string, content {CONTENT.simpleString()}",
    )
    r = to_page_rows(df, F.lit("2025-01-02")).first()
    assert (r.domain, r.real_path, r.path, r.date) == ("a.es", "/x", "_x", "2025-01-02")
    assert r.tags == ["empresa", "sitio_seguro"]


def test_dictionary_and_seed_files(spark, tmp_path):
    d = tmp_path / "dictionary.json"
    d.write_text(json.dumps({"keywords": {"a": ["x", "y"], "b": ["z"]}, "patterns": ["p (q)"]}, indent=1))
    loaded = config_files.load_dictionary(spark, str(d))
    assert loaded == tags.Dictionary({"a": ["x", "y"], "b": ["z"]}, ["p (q)"])
    raw = spark.read.schema(config_files.DICTIONARY_SCHEMA).option("multiLine", True).json(str(d))
    assert sorted(map(tuple, config_files.keyword_rows(raw).collect())) == [
        ("a", "x"), ("a", "y"), ("b", "z"),
    ]
    assert config_files.pattern_rows(raw).first().pattern == "p (q)"
    s = tmp_path / "config.json"
    s.write_text(json.dumps({"seeds": [{"https://a": 2}, {"https://b": 0}], "workers": 3}, indent=1))
    assert sorted(map(tuple, config_files.read_seeds(spark, str(s)).collect())) == [
        ("https://a", 2), ("https://b", 0),
    ]


def test_odd_dictionaries(spark):
    """Empty word lists and patterns without a group give no tag and no error."""
    df = spark.createDataFrame([(["We sell data tools"],)], "segs array<string>")
    got = df.select(
        tags.keyword_tags(F.col("segs"), {"none": [], "x": ["tools"]}).alias("k"),
        tags.phrase_tags(F.col("segs"), ["sell", "sell ([a-z]+)", r"\\(sell\\)", "(?:sell)"]).alias("p"),
        tags.keyword_tags(F.col("segs"), {}).alias("e"),
    ).first()
    assert (got.k, got.p, got.e) == (["x"], ["data"], [])
