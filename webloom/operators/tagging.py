"""From crawl events to page rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import tags, urls


def to_page_rows(
    events: DataFrame,
    date: Column,
    dictionary: tags.Dictionary = tags.DEFAULT_DICTIONARY,
) -> DataFrame:
    """Crawl events (url, content) as lake rows.

    ``date`` is the crawl day as text; it is passed in, so a rerun gives the same
    rows.
    """
    parts = events.select(
        urls.domain(F.col("url")).alias("domain"),
        F.coalesce(urls.path(F.col("url")), F.lit("")).alias("real_path"),
        date.alias("date"),
        "content",
    )
    return parts.select(
        "domain",
        urls.sanitize_path(F.col("real_path")).alias("path"),
        "date",
        "real_path",
        tags.page_tags(
            F.col("domain"), F.col("real_path"), F.col("content"), dictionary
        ).alias("tags"),
        "content",
    )


def with_url(pages: DataFrame) -> DataFrame:
    """Lake rows with their identity; the lake itself does not store it."""
    return pages.withColumn("url", urls.canonical_url(F.col("domain"), F.col("real_path")))
