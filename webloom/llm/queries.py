"""Named queries of the training-data operators, with check SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import (
    chat_repair,
    exact_dedup,
    licences,
    merkle,
    mixing,
    near_dups,
    neighbours,
    packing,
    prefix_trie,
    quality_fm,
    repeats,
    toxicity,
    url_globs,
)
from webloom.llm.check_sql import OP2_SQL, OP8_SQL, OP11_SQL, OP13_SQL
from webloom.plans.registry import query

THRESHOLD = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def quality_model(docs: DataFrame, labels: DataFrame) -> quality_fm.Model:
    return quality_fm.train(docs, labels.where(~held_out(F.col("doc_id"))))


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return quality_fm.score(docs, model, keep=["doc_id"]).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


@query("op2_near_dups", OP2_SQL)
def op2_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document among those with similar word 5-shingles."""
    return near_dups.near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id"
    )


OP3_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept,
       sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
"""


@query("op3_exact_dedup", OP3_SQL)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of every group of equal texts stays."""
    index = exact_dedup.build_index(table(spark, sf_dir, "documents"))
    return exact_dedup.lookup(index).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.col("sha256").alias("text_sha256"),
    )


# (action, rule) with host and path, then wildcard rules for what no rule fits.
SITE_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
GLOB_RULES = (
    ("block", "+spam-farm+/*"),
    ("block", "+cheap-pills+/*"),
    ("block", "*/casino*"),
    ("block", "*.exe"),
)

OP5_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
           THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*', 0)
           ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path
  FROM u),
r AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN (host LIKE '%spam-farm%' OR host LIKE '%cheap-pills%') AND path <> '' THEN 'block'
    WHEN contains(path, '/casino') OR ends_with(host || path, '.exe') THEN 'block'
    ELSE 'allow' END AS verdict
FROM r
"""


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document's pieces in sequences of 2,048 tokens."""
    return packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op5_url_globs", OP5_SQL)
def op5_url_globs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's address."""
    rules = [url_globs.site_rule(a, r) for a, r in SITE_RULES]
    rules += [url_globs.glob_rule(a, g) for a, g in GLOB_RULES]
    return url_globs.judge(table(spark, sf_dir, "pages"), rules, keep=["page_id"])


# Share of all words that each language shall have.
TARGETS = {"en": 0.5, "de": 0.18, "fr": 0.18, "es": 0.14}


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain): the language of the documents that the labels cover."""
    covered = labels.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    return docs.select("doc_id", F.col("lang").alias("domain")).join(covered, "doc_id")


@query("op6_mixing")
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate and copies of every document for the target weights."""
    docs = table(spark, sf_dir, "documents")
    labelled = labelled_domains(docs, table(spark, sf_dir, "labels"))
    return mixing.rates(docs, labelled, TARGETS)


def _licence_sql() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({quote(n)}, {quote(t)})" for n, t in licences.TEMPLATES)
    return f"""
WITH t AS (SELECT * FROM (VALUES {rows}) v(licence, passage)),
l AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines
      FROM documents),
p AS (
  SELECT doc_id, unnest(lines) AS passage, unnest(range(1, len(lines) + 1)) AS line FROM l
  UNION ALL SELECT doc_id, text, 0 FROM l WHERE len(lines) > 1),
every AS (
  SELECT 'p' AS side, doc_id, line, NULL AS licence, passage FROM p
  UNION ALL SELECT 't', NULL, NULL, licence, passage FROM t),
w AS (
  SELECT side, doc_id, line, licence, list_filter(string_split(regexp_replace(
    translate(passage, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS words FROM every),
b AS (
  SELECT side, doc_id, line, licence, CASE WHEN len(words) < 2 THEN words ELSE
    list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))
    END AS bigrams FROM w),
m AS (
  SELECT x.doc_id, x.line, y.licence,
    2.0::DOUBLE * len(list_intersect(x.bigrams, y.bigrams)) / (len(x.bigrams) + len(y.bigrams))
      AS dice
  FROM (SELECT * FROM b WHERE side = 'p' AND len(bigrams) > 0) x
  JOIN (SELECT * FROM b WHERE side = 't') y
    ON len(x.bigrams) BETWEEN len(y.bigrams) * 0.6 AND len(y.bigrams) * 1.6),
r AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, licence, line) AS nth,
    count(*) OVER (PARTITION BY doc_id) AS n FROM m WHERE dice >= 0.8)
SELECT l.doc_id, coalesce(r.n, 0) AS n_matches, r.licence, r.dice, r.line
FROM l LEFT JOIN r ON l.doc_id = r.doc_id AND r.nth = 1
"""


@query("op7_licences", _licence_sql())
def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document: their number and the clearest one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licences.with_matches(docs).select(
        "doc_id", "matches", licences.best_match(F.col("matches")).alias("best")
    )
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.col("best.licence").alias("licence"),
        (-F.col("best.low")).alias("dice"),
        F.col("best.line").cast("long").alias("line"),
    )


@query("op8_repeats", OP8_SQL)
def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of earlier ones."""
    return repeats.cut_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_removed",
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


@query("op9_chat_repair")
def op9_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of every conversation, repaired and rendered."""
    return chat_repair.repair(table(spark, sf_dir, "conversations"))


@query("op10_neighbours")
def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    found = neighbours.neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
    return found.withColumnRenamed("id", "vec_id")


def tampered(doc_id: Column, n_chars: Column) -> Column:
    """``n_chars``, one more where 7 divides the crc32 of the id."""
    more = (n_chars.cast("decimal(20,0)") + 1).cast("string")
    return F.when(F.crc32(doc_id.cast("string")) % 7 == 0, more).otherwise(n_chars.cast("string"))


@query("op11_merkle", OP11_SQL)
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document, and whether its tampered row still leads to the root."""
    docs = table(spark, sf_dir, "documents")
    c = {n: F.col(n) for n in ("doc_id", "source", "lang", "n_chars", "text")}
    claim = merkle.leaf_hash(*(c | {"n_chars": tampered(c["doc_id"], c["n_chars"])}).values())
    found = merkle.proofs(merkle.build(docs, list(c), extra={"claim": claim}))
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        merkle.proof_digest(F.col("siblings")).alias("proof_sha256"),
        merkle.fold(F.col("claim"), F.col("siblings"), F.col("left")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


TOXIC = 0.5


@query("op12_toxicity")
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return toxicity.score(docs, toxicity.train(docs, labels), keep=["doc_id"]).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
    )


@query("op13_prefix_trie", OP13_SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie over conversations whose first turns come from the first one of their twenty."""
    rows = prefix_trie.turn_rows(table(spark, sf_dir, "conversations"))
    heads = F.crc32(F.col("c").cast("string")) % 4
    base = F.col("c") - F.col("c") % 20
    paths, lengths = prefix_trie.with_shared_heads(rows, prefix_trie.conversations(rows), base, heads, 3)
    nodes = prefix_trie.trie(paths, lengths)
    return nodes.select(
        "conv_id",
        F.col("d").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )
