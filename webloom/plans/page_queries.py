"""Queries on raw pages: extraction, URL parts, tags, page rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions import html, tags, urls
from webloom.operators import search
from webloom.operators.tagging import with_url
from webloom.plans import inputs
from webloom.plans import oracle_parts as o
from webloom.plans.registry import query

SEP = " | "


def _joined(array: Column) -> Column:
    return F.array_join(array, SEP)


def _sql_joined(array: str) -> str:
    return f"coalesce(array_to_string({array}, '{SEP}'), '')"


@query(
    "page_links",
    f"""WITH {o.pages_ctes()}
SELECT page_id, unnest({o.targets()}) AS link FROM masked""",
)
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    """Every anchor target of every page."""
    pages = inputs.masked_pages(spark, sf)
    return pages.select(
        "page_id", F.explode(html.link_targets(F.col("masked"))).alias("link")
    )


@query(
    "link_class_counts",
    f"""WITH {o.pages_ctes()},
l AS (SELECT unnest({o.targets()}) AS link FROM masked)
SELECT {o.link_class('link')} AS link_class, count(*) AS links FROM l GROUP BY 1""",
)
def link_class_counts(spark: SparkSession, sf: str) -> DataFrame:
    links = page_links(spark, sf)
    return links.groupBy(html.link_class(F.col("link")).alias("link_class")).agg(
        F.count(F.lit(1)).alias("links")
    )


@query(
    "page_meta",
    f"""WITH {o.pages_ctes()}
SELECT page_id, {o.title()} AS title,
  {_sql_joined(f"list_filter({o.attributes('meta', 'charset')}, lambda v: v IS NOT NULL)")} AS charsets
FROM masked""",
)
def page_meta(spark: SparkSession, sf: str) -> DataFrame:
    pages = inputs.masked_pages(spark, sf)
    m = F.col("masked")
    return pages.select(
        "page_id",
        F.get(html.title(m), F.lit(0)).alias("title"),
        _joined(html.meta_charsets(m)).alias("charsets"),
    )


_NAMED = (
    f"list_filter({o.tags('meta')}, lambda t: ({o.attribute('t', 'charset')}) IS NULL "
    f"AND ({o.attribute('t', 'name')}) IS NOT NULL)"
)


@query(
    "page_meta_named",
    f"""WITH {o.pages_ctes()},
t AS (SELECT page_id, ents, wins, unnest({_NAMED}) AS tag,
        generate_subscripts({_NAMED}, 1) AS pos FROM masked),
n AS (SELECT page_id, pos, {o.attribute('tag', 'name')} AS name,
        coalesce({o.attribute('tag', 'content')}, '') AS content FROM t)
SELECT page_id, name, string_agg(content, '{SEP}' ORDER BY pos) AS contents
FROM n GROUP BY page_id, name""",
)
def page_meta_named(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("masked")
    lists = [html.attribute_values(m, "meta", n) for n in ("charset", "name", "content")]
    metas = inputs.masked_pages(spark, sf).select("page_id", html.named_metas(*lists).alias("pairs"))
    return metas.select(
        "page_id", F.explode(html.meta_map(F.col("pairs"))).alias("name", "contents")
    ).select("page_id", "name", _joined(F.col("contents")).alias("contents"))


@query(
    "page_assets",
    f"""WITH {o.pages_ctes()}, {o.parsed_cte()}
SELECT page_id, {_sql_joined('styles')} AS styles, {_sql_joined('logo')} AS logos,
  {_sql_joined('scripts')} AS scripts, {_sql_joined('imgs')} AS imgs FROM parsed""",
)
def page_assets(spark: SparkSession, sf: str) -> DataFrame:
    pages = inputs.masked_pages(spark, sf)
    m = F.col("masked")
    return pages.select("page_id", "masked", html.link_hrefs(m).alias("hrefs")).select(
        "page_id",
        _joined(html.stylesheets(F.col("hrefs"))).alias("styles"),
        _joined(html.logos(F.col("hrefs"))).alias("logos"),
        _joined(html.https_only(html.attribute_values(m, "script", "src"))).alias("scripts"),
        _joined(html.https_only(html.attribute_values(m, "img", "src"))).alias("imgs"),
    )


@query(
    "page_texts",
    f"""WITH {o.pages_ctes()},
t AS (SELECT page_id, {o.headings(1)} AS h1, {o.headings(2)} AS h2, {o.paragraphs()} AS p FROM masked),
u AS (SELECT page_id, 'h1' AS element, unnest(h1) AS text FROM t
  UNION ALL SELECT page_id, 'h2', unnest(h2) FROM t
  UNION ALL SELECT page_id, 'p', unnest(p) FROM t)
SELECT * FROM u""",
)
def page_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Headings and paragraphs, one row each."""
    m = F.col("masked")
    lists = F.create_map(
        F.lit("h1"), html.headings(m, 1), F.lit("h2"), html.headings(m, 2), F.lit("p"),
        html.paragraphs(m),
    )
    return (
        inputs.masked_pages(spark, sf)
        .select("page_id", F.explode(lists).alias("element", "texts"))
        .select("page_id", "element", F.explode("texts").alias("text"))
    )


_CONTENT_FIELDS = [
    ("http", "content.links.http"),
    ("https", "content.links.https"),
    ("files", "content.links.files"),
    ("internal", "content.links.internal"),
    ("logo", "content.metadata.logo"),
    ("scripts", "content.metadata.scripts"),
    ("styles", "content.metadata.styles"),
    ("imgs", "content.imgs.imgs"),
    ("h1", "content.texts.h1"),
    ("h2", "content.texts.h2"),
    ("p", "content.texts.p"),
]


@query(
    "page_content",
    f"""WITH {o.pages_ctes()}, {o.parsed_cte()}
SELECT page_id, title, {", ".join(f"{_sql_joined(n)} AS {n}" for n, _ in _CONTENT_FIELDS)}
FROM parsed""",
)
def page_content(spark: SparkSession, sf: str) -> DataFrame:
    """The whole content record, lists joined."""
    parsed = html.parse_pages(inputs.marked_pages(spark, sf))
    return parsed.select(
        "page_id",
        F.get("content.metadata.title", F.lit(0)).alias("title"),
        *[_joined(F.col(path)).alias(name) for name, path in _CONTENT_FIELDS],
    )


@query(
    "page_decode",
    """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN html
  ELSE regexp_replace(html, '[^\\x00-\\xFF]', '?', 'g') END AS html FROM pages""",
)
def page_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes of two encodings back to text."""
    latin = F.col("page_id") % 2 == 1
    narrow = F.regexp_replace("html", r"[^\x00-\xFF]", "?")
    responses = inputs.table(spark, sf, "pages").select(
        "page_id",
        F.when(latin, F.encode(narrow, "ISO-8859-1")).otherwise(F.encode("html", "UTF-8")).alias("body"),
        F.when(latin, "text/html; charset=ISO-8859-1").otherwise("text/html").alias("ct"),
    )
    return responses.select("page_id", html.decode_body(F.col("body"), F.col("ct")).alias("html"))


_SHELLS = {
    "as_is": "html",
    "no_body": "regexp_replace(html, '(?s)<body>.*</body>', '<BODY></BODY>')",
    "app": "replace(html, '<article', '<div id=\"App\"><article')",
    "bare": "regexp_replace(html, '(?s)<body>.*</body>', '<body>xyz</body>') || repeat('z', 1000)",
}


@query(
    "needs_render",
    "WITH v AS ("
    + " UNION ALL ".join(
        f"SELECT page_id, '{k}' AS variant, {e} AS html FROM pages" for k, e in _SHELLS.items()
    )
    + """),
s AS (SELECT page_id, variant, html, lower(html) AS low FROM v),
b AS (SELECT *, instr(low, '<body') AS b0, instr(low, '</body>') AS b1 FROM s),
c AS (SELECT *, substring(low, b0, b1 - b0) AS body FROM b)
SELECT page_id, variant, (strlen(html) < 1000 OR contains(low, '<body></body>')
  OR contains(low, '<body/>') OR (b0 > 0 AND b1 > b0
    AND 2 * length(body) - length(replace(body, 'a', '')) - length(replace(body, 'p', '')) < 10)
  OR contains(low, 'id="root"') OR contains(low, 'id="app"') OR contains(low, 'ng-app'))
  AS needs_render FROM c""",
)
def needs_render(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as it is and in three stripped forms."""
    variants = F.create_map(*[c for k, e in _SHELLS.items() for c in (F.lit(k), F.expr(e))])
    return (
        inputs.table(spark, sf, "pages")
        .select("page_id", F.explode(variants).alias("variant", "html"))
        .select("page_id", "variant", html.needs_render(F.col("html")).alias("needs_render"))
    )


_ODD_URLS = [
    "url",
    "replace(url, '.example.', '_x.example.') || '/a%20b+c'",
    "replace(url, '://', '://me:pw@') || '%C3%A9'",
    "regexp_replace(url, '^([a-z]+://[^/]*).*', '\\1:8080')",
]


def _odd_urls_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT page_id, {i} AS form, {e} AS url FROM pages" for i, e in enumerate(_ODD_URLS)
    )


@query(
    "url_parts",
    f"""WITH u AS ({_odd_urls_sql()}),
s AS (SELECT page_id, form, {o.domain('url')} AS domain, {o.scheme('url')} AS scheme,
  {o.path('url')} AS path FROM u)
SELECT page_id, form, domain, scheme, path, {o.sanitized('path')} AS sanitized,
  'https://' || domain || path AS canonical FROM s""",
)
def url_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of every page address, also with ports, user names and escapes."""
    forms = [F.expr(e.replace("'\\1:8080'", "'$1:8080'")) for e in _ODD_URLS]
    u = F.col("url")
    addresses = inputs.table(spark, sf, "pages").select(
        "page_id", F.posexplode(F.array(*forms)).alias("form", "url")
    )
    return addresses.select(
        "page_id",
        "form",
        urls.domain(u).alias("domain"),
        urls.scheme(u).alias("scheme"),
        urls.path(u).alias("path"),
    ).select(
        "*",
        urls.sanitize_path(F.col("path")).alias("sanitized"),
        urls.canonical_url(F.col("domain"), F.col("path")).alias("canonical"),
    )


@query(
    "internal_links",
    f"""WITH {o.pages_ctes()}, {o.parsed_cte()}
SELECT page_id, unnest({o.internal_urls('internal')}) AS url FROM parsed""",
)
def internal_links(spark: SparkSession, sf: str) -> DataFrame:
    pages = inputs.masked_pages(spark, sf)
    internal = html.links_of_class(html.link_targets(F.col("masked")), "internal")
    return pages.select(
        "page_id", F.explode(urls.resolve_internal(F.col("url"), internal)).alias("url")
    )


# ---------------------------------------------------------------------- tags

# Words and phrases that occur in the documents, besides the usual dictionary.
KEYWORDS = {**tags.KEYWORDS, "english": ["the ", "with"], "french": ["des ", "les "], "año": ["ñ"]}
PATTERNS = tags.DEFAULT_DICTIONARY.patterns + [
    f"and the {tags.PHRASE_GROUP}",
    f"de la {tags.PHRASE_GROUP}",
]


def _document_segments(spark: SparkSession, sf: str) -> DataFrame:
    """A document as a page text: its lines are the segments."""
    return inputs.table(spark, sf, "documents").select(
        "doc_id", F.split("text", "\n", -1).alias("segments")
    )


_SEGMENTS = "s AS (SELECT doc_id, string_split(text, chr(10)) AS segments FROM documents)"


@query(
    "tag_keywords",
    f"""WITH {_SEGMENTS},
t AS (SELECT doc_id, lower(array_to_string(segments, ' ')) AS text FROM s)
SELECT doc_id, unnest({o.keyword_rows('text', KEYWORDS)}) AS tag FROM t""",
)
def tag_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return _document_segments(spark, sf).select(
        "doc_id", F.explode(tags.keyword_tags(F.col("segments"), KEYWORDS)).alias("tag")
    )


@query(
    "tag_phrases",
    f"""WITH {_SEGMENTS}
SELECT doc_id, unnest({o.phrase_list('segments', PATTERNS)}) AS tag FROM s""",
)
def tag_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return _document_segments(spark, sf).select(
        "doc_id", F.explode(tags.phrase_tags(F.col("segments"), PATTERNS)).alias("tag")
    )


def _sql_structure() -> str:
    return o.flag_list([(tag, f"len({field}) > 0") for tag, _, field in tags.STRUCTURE_TAGS])


def _sql_url_tags(domain: str, path: str) -> str:
    return o.flag_list(
        [(tag, o.contains_any(f"lower({domain})", words)) for tag, words in tags.DOMAIN_TAGS]
        + [(tag, o.contains_any(f"lower({path})", words)) for tag, words in tags.PATH_TAGS]
    )


@query(
    "tag_structure",
    f"""WITH {o.pages_ctes()}, {o.parsed_cte()}
SELECT page_id, unnest({_sql_structure()}) AS tag FROM parsed""",
)
def tag_structure(spark: SparkSession, sf: str) -> DataFrame:
    parsed = html.parse_pages(inputs.marked_pages(spark, sf))
    return parsed.select(
        "page_id", F.explode(tags.structure_tags(F.col("content"))).alias("tag")
    )


_TAG_URLS = """u AS (SELECT page_id, replace(url, 'www.', CASE page_id % 3 WHEN 0 THEN 'Shop.'
  WHEN 1 THEN 'github.' ELSE 'store.' END) || CASE page_id % 4 WHEN 0 THEN '/Login/products'
  WHEN 1 THEN '/contact-news' WHEN 2 THEN '/Blog' ELSE '' END AS url
  FROM (SELECT page_id, regexp_replace(url, '[?#].*', '') AS url FROM pages) x)"""


@query(
    "tag_url",
    f"""WITH {_TAG_URLS}
SELECT page_id, unnest({_sql_url_tags(o.domain('url'), o.path('url'))}) AS tag FROM u""",
)
def tag_url(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("page_id")
    plain = F.regexp_replace("url", "[?#].*", "")
    host = F.when(n % 3 == 0, "Shop.").when(n % 3 == 1, "github.").otherwise("store.")
    end = (
        F.when(n % 4 == 0, "/Login/products")
        .when(n % 4 == 1, "/contact-news")
        .when(n % 4 == 2, "/Blog")
        .otherwise("")
    )
    u = F.col("url")
    return (
        inputs.table(spark, sf, "pages")
        .select("page_id", F.concat(F.replace(plain, F.lit("www."), host), end).alias("url"))
        .select("page_id", F.explode(tags.url_tags(urls.domain(u), urls.path(u))).alias("tag"))
    )


_SEGS = "(h1 || h2 || p)"
TAGGED_FROM_PARSED = f"""text AS MATERIALIZED (SELECT *, lower(array_to_string({_SEGS}, ' ')) AS all_text,
  {o.domain('url')} AS domain, {o.path('url')} AS real_path FROM parsed),
tagged AS MATERIALIZED (SELECT *, list_sort(list_distinct(
  {o.keyword_rows('all_text', tags.KEYWORDS)}
  || {o.phrase_list(_SEGS, tags.DEFAULT_DICTIONARY.patterns)}
  || {_sql_structure()} || {_sql_url_tags('domain', 'real_path')})) AS tags FROM text)"""


TAGGED_CTES = f"{o.pages_ctes()}, {o.parsed_cte()},\n{TAGGED_FROM_PARSED}"


@query("page_tags", f"WITH {TAGGED_CTES} SELECT page_id, unnest(tags) AS tag FROM tagged")
def page_tags(spark: SparkSession, sf: str) -> DataFrame:
    parsed = html.parse_pages(inputs.marked_pages(spark, sf))
    u = F.col("url")
    return parsed.select(
        "page_id",
        F.explode(tags.page_tags(urls.domain(u), urls.path(u), F.col("content"))).alias("tag"),
    )


PAGE_ROWS_SQL = f"""WITH {TAGGED_CTES}
SELECT domain, {o.sanitized('real_path')} AS path, '{inputs.DAY}' AS date, real_path,
  {_sql_joined('tags')} AS tags, title, {_sql_joined('https')} AS https,
  {_sql_joined('p')} AS p FROM tagged"""


def flat_page_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "domain",
        "path",
        "date",
        "real_path",
        _joined(F.col("tags")).alias("tags"),
        F.get("content.metadata.title", F.lit(0)).alias("title"),
        _joined(F.col("content.links.https")).alias("https"),
        _joined(F.col("content.texts.p")).alias("p"),
    )


@query("page_rows", PAGE_ROWS_SQL)
def page_rows(spark: SparkSession, sf: str) -> DataFrame:
    """HTML to lake rows in one pass."""
    return flat_page_rows(inputs.page_rows(spark, sf))


LOOKUP = " thther.example.org/en/685/ "


@query(
    "page_lookup",
    f"""WITH {TAGGED_CTES}
SELECT 'https://' || domain || real_path AS url, '{inputs.DAY}' AS date, title FROM tagged
WHERE 'https://' || domain || real_path
  IN ('https://thther.example.org/en/685/', 'https://thther.example.org/en/685')""",
)
def page_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """All versions of one address; the filter comes before the parsing."""
    return search.page_lookup(with_url(inputs.page_rows(spark, sf)), LOOKUP).select(
        "url", "date", F.get("content.metadata.title", F.lit(0)).alias("title")
    )
