"""From raw documents to packed training sequences, stage by stage.

Every stage gets what its predecessor kept, as a table written and read again, and all
but the last return rows with the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import exact_dedup, mixing, near_dups, packing, quality_fm
from webloom.llm import queries as q
from webloom.plans.registry import query
from webloom.session import stage_table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without those the classifier takes for bad ones; it learns from ``labels``."""
    model = q.quality_model(docs, q.table(spark, sf_dir, "labels"))
    scored = quality_fm.score(docs, model, score_col="_quality", keep=docs.columns)
    return scored.where(F.col("_quality") >= q.THRESHOLD).select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts, that with the largest id."""
    return exact_dedup.distinct_rows(docs)


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each component of similar documents, that with the smallest id."""
    return near_dups.one_of_each(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of the languages ask for."""
    labelled = q.labelled_domains(docs, q.table(spark, sf_dir, "labels"))
    return mixing.mixed(docs, labelled, q.TARGETS)


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences. ``doc`` tells copies of a document apart."""
    return packing.packed_documents(docs, q.tokenizer_path())


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", distinct_documents),
    ("n-gram Jaccard join", dissimilar_documents),
    ("mixing sources to target weights", mixed_documents),
    ("best-fit packing", packed_documents),
]

# The classifier and the tokenizer cannot be written in SQL; tests/llm compares
# each stage with a brute-force version.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    rows = q.table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        rows = stage_table(stage(spark, rows, sf_dir), f"pipeline-{number}")
    return rows
