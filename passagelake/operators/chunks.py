"""Clean pages to overlapping chunks with stable ids.  Nothing here shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from passagelake.config import CHUNK_OVERLAP, CHUNK_SIZE
from passagelake.functions.splitter import add_overlap, split_recursive
from passagelake.functions.text import chunk_id, strip


def chunk_pages(
    pages: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``(id, slug, chunk_idx, url, title, text)``, one row per chunk, and the page's columns ``keep``.

    The tail of the previous chunk is taken inside the page's own array, so no
    window over the chunks is needed.
    """
    split = pages.select(
        "slug", "url", "title", *keep, split_recursive(F.col("text"), size).alias("_pieces")
    )
    lapped = split.select(
        "slug", "url", "title", *keep, F.posexplode(add_overlap(F.col("_pieces"), overlap))
    )
    return lapped.select(
        chunk_id(F.col("slug"), F.col("pos")).alias("id"),
        "slug",
        F.col("pos").alias("chunk_idx"),
        "url",
        "title",
        strip(F.col("col")).alias("text"),
        *keep,
    )


def presented(chunks: DataFrame) -> DataFrame:
    """Chunks in the order of their pages' names and of their places; for showing, not storing."""
    return chunks.orderBy("slug", "chunk_idx")


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """One row: chunk count, page count, mean characters per chunk."""
    pages = chunks.groupBy("slug").agg(
        F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")
    )
    totals = pages.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("chunks"),
        F.count("*").alias("pages"),
        F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"),
    )
    return totals.select(
        "chunks", "pages", (F.col("chars") / F.greatest("chunks", F.lit(1))).alias("mean_chars")
    )
