"""Pages and dictionary words read on Arrow batches, against the single-field expressions."""

import random

from pyspark.sql import functions as F

from webloom.functions import html, tags

BITS = [
    "<", ">", "<!--", "-->", "<!-->", "</", "=", "'", '"', " ", "a", "\U0001f600", "K", "ſ", "&notit;", "&#150;",
    "&ampx", "&#x1f600;", "&#0;", "&eacute", "&nope;", " href=", " src=", " name=", "'https://e/x'", "f.pdf", "<p>", "</p>",
    "<h1>", "<h2 id='>'>", "</h2>", "<div", "<a ", "<img ", "<meta ", "<script>", "</script>", "<TITLE>", "</title>", "</b ",
]


def odd_pages(n):
    rng = random.Random(3)
    pages = ["".join(rng.choice(BITS) for _ in range(rng.randrange(50))) for _ in range(n)]
    return list(enumerate([None, "", "<script a='</script>", "<script>x</b </script>", *pages]))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lists_are_those_of_the_single_fields(spark):
    df = spark.createDataFrame(odd_pages(600), "page_id int, html string")
    parsed = html.parse_pages(df)
    m = F.col("m")
    single = df.select("page_id", html.mask_inert(F.col("html")).alias("m")).select(
        "page_id",
        html.headings(m, 1).alias("h1"),
        html.headings(m, 2).alias("h2"),
        html.paragraphs(m).alias("p"),
        html.title(m).alias("title"),
    )
    fields = parsed.select("page_id", "content.texts.*", "content.metadata.title")
    got = {r.page_id: r.asDict() for r in fields.collect()}
    assert got == {r.page_id: r.asDict() for r in single.collect()}
    # Spark's functions on arrays would scan, cut and decode value by value.
    plan = plan_of(parsed)
    assert plan.count("ArrowEvalPython") == 1 and "regexp" not in plan and "element_at" not in plan


def test_broken_characters_are_no_error(spark):
    df = spark.sql("SELECT 1 AS page_id, cast(x'3C703E77652061726520FF' AS string) AS html")
    parsed = html.parse_pages(df)
    assert parsed.select("content.texts.p").first().p == ["we are �"]
    raw = spark.sql("SELECT array(cast(x'4D616B6520FF' AS string)) AS s")
    assert raw.select(tags.keyword_tags(F.col("s"), {"t": ["make"]}).alias("k")).first().k == ["t"]


def test_filter_goes_below_the_parser(spark):
    df = spark.createDataFrame(odd_pages(3), "page_id int, html string")
    plan = plan_of(html.parse_pages(df).where("page_id = 2"))
    assert plan.index("ArrowEvalPython") < plan.index("Filter")


def test_a_longer_dictionary_is_no_longer_plan(spark):
    df = spark.createDataFrame([(["We Sell Tools", None, "x"],), (None,)], "s array<string>")

    def tagged(n):
        words = {f"t{i}": [f"word{i}", "tools" if i == 0 else "none"] for i in range(n)}
        return df.select(tags.keyword_tags(F.col("s"), words).alias("k"))

    assert [r.k for r in tagged(500).collect()] == [["t0"], []]
    assert len(plan_of(tagged(500))) == len(plan_of(tagged(1)))


def test_keywords_and_phrases_are_searched_once(spark):
    content = "struct(struct(array('s') AS logo, array() AS scripts, array() AS styles) AS metadata, \
struct(array() AS https, array() AS files) AS links, \
struct(array('We offer Cloud, and x') AS h1, array('blog') AS h2, array() AS p) AS texts)"
    df = spark.range(1).select(F.expr(content).alias("content"))
    tagged = df.select(tags.page_tags(F.lit("d"), F.lit("p"), F.col("content")).alias("t"))
    assert tagged.first().t == ["cloud", "marca", "noticias"]
    assert plan_of(tagged).count("ArrowEvalPython") == 1
