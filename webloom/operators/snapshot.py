"""One row per key: daily dedupe and latest snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in ``order``.

    ``row_number() = 1`` lets Catalyst put a group limit before the shuffle, so
    every task sends at most one row per key and a hot key stays small.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def page_tiebreak() -> list[Column]:
    """Order among rows with the same url and date: depends on the row, not on the run.

    The links come first, so a pass that reads only the links picks the same row
    as a pass that reads everything.
    """
    meta = F.col("content.metadata")
    return [
        F.xxhash64("content.links"),
        F.xxhash64(
            "path",
            "tags",
            *[meta[n] for n in ("charset", "logo", "scripts", "styles", "title")],
            F.map_entries(meta["other"]),
            "content.imgs",
            "content.texts",
        ),
    ]


def daily_dedupe(
    pages: DataFrame,
    key: str = "url",
    date: str = "date",
    tiebreak: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per (key, date)."""
    return first_per_key(pages, [key, date], page_tiebreak() if tiebreak is None else tiebreak)


def latest_snapshot(
    pages: DataFrame,
    key: str = "url",
    date: str = "date",
    tiebreak: Sequence[Column] | None = None,
) -> DataFrame:
    """Newest row per key."""
    order = page_tiebreak() if tiebreak is None else tiebreak
    return first_per_key(pages, [key], [F.col(date).desc(), *order])


def latest_links(pages: DataFrame) -> DataFrame:
    """(url, links) of the newest row per url; reads no content besides the links.

    Gives the links of the row that ``daily_dedupe`` and ``latest_snapshot`` keep.
    """
    narrow = pages.select("url", "date", F.col("content.links").alias("links"))
    return latest_snapshot(narrow, tiebreak=[F.xxhash64("links")]).select("url", "links")
