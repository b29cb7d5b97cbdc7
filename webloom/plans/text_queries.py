"""Queries on document texts: tokens, index, IDF, search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions import text as txt
from webloom.operators import blocks, bounded, dictionary, index, search, segments
from webloom.operators.tagging import with_url
from webloom.plans import inputs
from webloom.plans import oracle_parts as o
from webloom.plans.page_queries import TAGGED_CTES
from webloom.plans.registry import query
from webloom.session import scratch_path, stage_table

SEARCH_TEXT = "thand  Étre the ention"
TERMS = search.terms_of(SEARCH_TEXT)
_TERM_FILTER = " OR ".join(f"starts_with(token, '{t}')" for t in TERMS)
_INDEX = o.index_ctes()


def _postings(spark: SparkSession, sf: str) -> DataFrame:
    return index.document_postings(inputs.documents(spark, sf))


def _idf(spark: SparkSession, sf: str) -> DataFrame:
    docs = inputs.documents(spark, sf)
    return index.idf(index.doc_freq(docs), docs)


def _matched(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Postings of the searched terms and their IDF, from one pass over the texts.

    The frequency of a token depends on its own postings only, so the terms can
    be picked before anything is counted.
    """
    docs = inputs.documents(spark, sf)
    matched = index.postings(search.prefix_terms(index.tokens(docs), TERMS))
    stored = stage_table(matched, "matched-postings")
    return stored, index.idf(index.doc_freq_of(stored), docs)


@query(
    "tokens",
    f"""WITH tok AS ({o.token_rows('documents')})
SELECT doc_key, count(*) AS n_tokens, count(DISTINCT token) AS n_distinct,
  max(token) AS last_token FROM tok WHERE token <> '' GROUP BY doc_key""",
)
def tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Token counts per document, without leaving the document's row."""
    docs = inputs.documents(spark, sf).select(
        "doc_key", txt.token_array(F.col("text")).alias("tokens")
    )
    return docs.where(F.size("tokens") > 0).select(
        "doc_key",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.size(F.array_distinct("tokens")).cast("bigint").alias("n_distinct"),
        F.array_max("tokens").alias("last_token"),
    )


@query("term_freq", f"WITH {_INDEX} SELECT token, doc_key, tf FROM tf")
def term_freq(spark: SparkSession, sf: str) -> DataFrame:
    return _postings(spark, sf)


@query("idf", f"WITH {_INDEX} SELECT token, doc_freq, round(idf, 6) AS idf FROM idf")
def idf(spark: SparkSession, sf: str) -> DataFrame:
    return _idf(spark, sf).select("token", "doc_freq", F.round("idf", 6).alias("idf"))


@query(
    "inverted_index",
    f"""WITH {_INDEX}, {o.DOCUMENT_MAPPINGS}
SELECT token, (doc_key // {index.BLOCK_DOCS})::bigint AS block,
  string_agg(doc_key || ':' || tf || ':' || (pagerank * 1000)::bigint, ' ' ORDER BY doc_key) AS docs
FROM tf JOIN mappings USING (doc_key) GROUP BY 1, 2""",
)
def inverted_index(spark: SparkSession, sf: str) -> DataFrame:
    """Postings with frequency and rank as arrays. Postings are counted inside rows and move
    once, to their token's task."""
    docs = inputs.ranked_documents(spark, sf)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = size // index.BYTES_PER_POSTING
    nested = index.nested_index(index.document_postings(docs), extra=("pagerank",), rows=rows)
    rank = lambda d: F.round(d["pagerank"] * 1000).cast("bigint")
    docs = F.transform(
        "docs", lambda d: F.concat_ws(":", d["doc_key"], d["tf"], rank(d))
    )
    return nested.select("token", "block", F.array_join(docs, " ").alias("docs"))


@query(
    "index_sample",
    f"WITH {_INDEX} SELECT token, doc_key, tf FROM tf ORDER BY token, doc_key LIMIT 20",
)
def index_sample(spark: SparkSession, sf: str) -> DataFrame:
    return index.index_sample(_postings(spark, sf))


@query(
    "index_sample_token",
    f"WITH {_INDEX} SELECT token, doc_key, tf FROM tf WHERE token = 'the' ORDER BY doc_key LIMIT 50",
)
def index_sample_token(spark: SparkSession, sf: str) -> DataFrame:
    return index.index_sample(_postings(spark, sf), "the", 50)


@query(
    "prefix_terms",
    f"WITH {_INDEX} SELECT token, doc_freq FROM df WHERE {_TERM_FILTER}",
)
def prefix_terms(spark: SparkSession, sf: str) -> DataFrame:
    return search.prefix_terms(index.doc_freq(inputs.documents(spark, sf)), TERMS)


_SCORES = f"""{_INDEX}, scores AS (SELECT doc_key, sum(tf * idf) AS content_score,
  count(*) AS matches FROM tf JOIN idf USING (token) WHERE {_TERM_FILTER} GROUP BY doc_key)"""


@query(
    "search_scores",
    f"WITH {_SCORES} SELECT doc_key, round(content_score, 4) AS content_score, matches FROM scores",
)
def search_scores(spark: SparkSession, sf: str) -> DataFrame:
    found = search.scores(*_matched(spark, sf), TERMS)
    return found.select("doc_key", F.round("content_score", 4).alias("content_score"), "matches")


@query(
    "search_topk",
    f"""WITH {_SCORES}, {o.DOCUMENT_MAPPINGS},
hits AS (SELECT *, 0 AS exact, contains(url, '{SEARCH_TEXT}')::int AS partial
  FROM scores JOIN mappings USING (doc_key)),
ranked AS (SELECT *, row_number() OVER (ORDER BY {o.RANK_ORDER}) AS rank FROM hits)
SELECT rank, url, title, round(content_score, 2) AS score, matches, external_refs AS popularity,
  pagerank FROM ranked WHERE rank <= 100""",
)
def search_topk(spark: SparkSession, sf: str) -> DataFrame:
    """One text query from raw documents to ranked hits."""
    hits = search.search(*_matched(spark, sf), inputs.document_mappings(spark, sf), SEARCH_TEXT)
    return hits.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "search_flags",
    f"""WITH {o.DOCUMENT_MAPPINGS},
q AS (SELECT *, CASE doc_key % 3 WHEN 0 THEN ' ' || url WHEN 1 THEN substring(url, 9)
  ELSE 'src1' END AS query FROM mappings)
SELECT doc_key, (url = trim(query) OR url = 'https://' || trim(query))::int AS exact,
  contains(url, trim(query))::int AS partial FROM q""",
)
def search_flags(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("doc_key") % 3
    asked = (
        F.when(n == 0, F.concat(F.lit(" "), "url"))
        .when(n == 1, F.expr("substring(url, 9)"))
        .otherwise("src1")
    )
    return search.with_url_flags(inputs.document_mappings(spark, sf), asked).select(
        "doc_key", "exact", "partial"
    )


SEARCH_BATCH_SQL = f"""WITH {_INDEX}, {o.DOCUMENT_MAPPINGS},
terms AS (SELECT DISTINCT item_id AS query_id, unnest(string_split_regex(lower(text), '\\s+')) AS term
  FROM benchmark),
wanted AS (SELECT DISTINCT query_id, token, idf FROM terms JOIN idf
  ON starts_with(token, term) WHERE term <> ''),
scores AS (SELECT query_id, doc_key, sum(tf * idf) AS content_score, count(*) AS matches
  FROM wanted JOIN tf USING (token) GROUP BY ALL),
flagged AS (SELECT s.*, m.*, (m.url = trim(b.text) OR m.url = 'https://' || trim(b.text))::int AS exact,
  contains(m.url, trim(b.text))::int AS partial
  FROM (SELECT query_id, doc_key AS dk, content_score, matches FROM scores) s
  JOIN mappings m ON m.doc_key = s.dk JOIN benchmark b ON b.item_id = s.query_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {o.RANK_ORDER}) AS rank
  FROM flagged)
SELECT query_id, rank, url, title, round(content_score, 2) AS score, matches::bigint AS matches,
  external_refs AS popularity, pagerank FROM ranked WHERE rank <= 100"""


@query("search_batch", SEARCH_BATCH_SQL)
def search_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark text as a query."""
    queries = inputs.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    docs = inputs.documents(spark, sf)
    stored = stage_table(_postings(spark, sf), "postings")
    idf = stage_table(index.idf(index.doc_freq_of(stored), docs), "idf")
    found = search.search_batch(stored, idf, inputs.document_mappings(spark, sf), queries)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@query("search_batch_bounded", SEARCH_BATCH_SQL)
def search_batch_bounded(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark text as a query, with posting blocks opened by their bounds."""
    queries = inputs.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    docs = inputs.documents(spark, sf)
    placed = blocks.with_blocks(docs, F.octet_length("text"))
    stored = stage_table(blocks.postings_of(blocks.forward_rows(placed, 1)), "postings")
    block_table = stage_table(blocks.block_bounds(stored), "block-table")
    freqs = block_table.groupBy("token").agg(F.sum("n").alias("doc_freq"))
    idf = stage_table(index.idf(freqs, docs), "idf")
    places = stored.groupBy("doc_key", "seq", "block").agg(F.sum("tf").alias("length"))
    places = stage_table(places, "places")
    mappings = inputs.document_mappings(spark, sf)
    found = bounded.search_batch(stored, block_table, places, None, idf, mappings, queries)
    return found.hits.withColumn("rank", F.col("rank").cast("bigint"))


# Keys of documents that the second batch adds start here.
ADDED = 10_000_000_000

FINAL_DOCUMENTS = f"""final AS (
  SELECT doc_id, CASE WHEN doc_id % 70 = 0 THEN 'back ' || source || ' ' || lang
    WHEN doc_id % 10 = 0 THEN 'changed ' || text ELSE text END AS text
  FROM documents WHERE doc_id % 7 <> 0 OR doc_id % 70 = 0
  UNION ALL SELECT doc_id + {ADDED}, text FROM documents WHERE doc_id % 25 = 1)"""


@query(
    "index_segments",
    f"""WITH {FINAL_DOCUMENTS}, {o.index_ctes("final", "doc_id")}
SELECT token, doc_freq, round(idf, 6) AS idf, sum(tf)::bigint AS n,
  sum(doc_key % 1000003 * tf)::bigint AS marks
FROM tf JOIN idf USING (token) GROUP BY ALL""",
)
def index_segments(spark: SparkSession, sf: str) -> DataFrame:
    """The index after three batches: all documents; changed and added ones; removed and
    returning ones. ``marks`` tells which documents a token's postings are of."""
    docs = inputs.table(spark, sf, "documents")
    key, text = F.col("doc_id").alias("doc_key"), F.col("text")
    store = segments.from_documents(
        spark, scratch_path(spark, "index"), docs.select(key, "text")
    )
    changed = docs.where("doc_id % 10 = 0").select(key, F.concat(F.lit("changed "), text).alias("text"))
    added = docs.where("doc_id % 25 = 1").select((F.col("doc_id") + ADDED).alias("doc_key"), "text")
    store.apply(changed.unionByName(added))
    back = docs.where("doc_id % 70 = 0").select(
        key, F.concat(F.lit("back "), "source", F.lit(" "), "lang").alias("text")
    )
    store.apply(back, docs.where("doc_id % 7 = 0").select(key))
    mark = F.col("doc_key") % 1000003 * F.col("tf")
    per_token = store.postings().groupBy("token").agg(F.sum("tf").alias("n"), F.sum(mark).alias("marks"))
    return per_token.join(store.idf(), "token").select(
        "token", "doc_freq", F.round("idf", 6).alias("idf"), "n", "marks"
    )


@query(
    "tag_dictionary_join",
    """WITH names AS (SELECT DISTINCT lower(p_name) AS name FROM part),
words AS (SELECT name AS word FROM names UNION SELECT unnest(string_split(name, ' ')) FROM names)
SELECT doc_id, word FROM documents JOIN words ON contains(lower(text), word) WHERE word <> ''""",
)
def tag_dictionary_join(spark: SparkSession, sf: str) -> DataFrame:
    """Names of parts, and the words in them, wherever they stand in a document."""
    names = inputs.table(spark, sf, "part").select(F.lower("p_name").alias("word")).distinct()
    words = names.unionByName(names.select(F.explode(F.split("word", " ")).alias("word")))
    docs = inputs.documents(spark, sf).withColumn("text", F.lower("text"))
    return dictionary.dictionary_join(docs, words).withColumnRenamed("doc_key", "doc_id")


DOC_TEXT = """concat_ws(' ', domain, regexp_replace(real_path, '[/-]', ' ', 'g'),
  'https://' || domain || real_path, array_to_string(tags, ' '), array_to_string(h1, ' '),
  array_to_string(h2, ' '), array_to_string(p, ' '))"""


@query(
    "doc_text",
    f"WITH {TAGGED_CTES} SELECT 'https://' || domain || real_path AS url, {DOC_TEXT} AS text FROM tagged",
)
def doc_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_url(inputs.page_rows(spark, sf))
    return rows.select(
        "url",
        txt.document_text(
            F.col("domain"), F.col("real_path"), F.col("url"), F.col("tags"),
            F.col("content.texts"),
        ).alias("text"),
    )


@query(
    "doc_mappings",
    f"""WITH {TAGGED_CTES}
SELECT DISTINCT 'https://' || domain || real_path AS url, coalesce(h1[1], h2[1], domain) AS title,
  0::bigint AS external_refs, 0.15::double AS pagerank FROM tagged""",
)
def doc_mappings(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_url(inputs.page_rows(spark, sf))
    return index.doc_mappings(rows).drop("doc_key").distinct()


@query(
    "doc_keys",
    f"""WITH {TAGGED_CTES}
SELECT DISTINCT 'https://' || domain || real_path AS url, 1::bigint AS keys, 1::bigint AS urls FROM tagged""",
)
def doc_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys per URL and URLs per key, where four hashes have to do for all URLs."""
    rows = with_url(inputs.page_rows(spark, sf)).select("url")
    few = lambda url: F.pmod(F.xxhash64(url), F.lit(4))
    keys = index.with_doc_keys(rows, few).distinct()
    per_key = keys.groupBy("doc_key").agg(F.count_distinct("url").alias("urls"))
    return (
        keys.join(per_key, "doc_key")
        .groupBy("url")
        .agg(F.count_distinct("doc_key").alias("keys"), F.max("urls").alias("urls"))
    )
