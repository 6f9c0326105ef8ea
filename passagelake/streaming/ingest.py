"""Incremental ingest: new page files become chunks as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from passagelake.config import EMBED_DIM
from passagelake.operators.chunks import chunk_pages
from passagelake.operators.embedding import embed
from passagelake.operators.pages import extract_pages, split_bad_pages, with_slug
from passagelake.schema import RAW_PAGE

_FIRST = "page_id long, url string, html string"


def first_of_slug(key: tuple, pages: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The page of a slug with the smallest id, the first time the slug is met; later none."""
    best = None
    for page in pages:
        if not state.exists and len(page):
            one = page.loc[[page["page_id"].idxmin()]] if page["page_id"].notna().any() else page.head(1)
            if best is None or best["page_id"].isna().all() or one["page_id"].iloc[0] < best["page_id"].iloc[0]:
                best = one
    if best is not None:
        state.update((int(best["page_id"].iloc[0]) if best["page_id"].notna().all() else None,))
        yield best[["page_id", "url", "html"]]


def new_slugs(pages: DataFrame, site_prefix: str = "") -> DataFrame:
    """A stream of raw pages as ``(page_id, url, html)`` of the first page of each slug.

    What was met before is state, one number a slug, kept in the query's checkpoint; pages
    of a batch meet by slug, and nothing that is stored is listed or read.
    """
    good, _ = split_bad_pages(pages)
    slugged = with_slug(good.select("page_id", "url", "html"), site_prefix)
    return slugged.groupBy("slug").applyInPandasWithState(
        first_of_slug, _FIRST, "page_id long", "append", GroupStateTimeout.NoTimeout
    )


def ingest_stream(
    spark: SparkSession,
    page_folder: str,
    target: str,
    checkpoint: str,
    site_prefix: str = "",
    files_per_batch: int = 1000,
    encoder_factory: Callable | None = None,
    dim: int = EMBED_DIM,
    encoder_id: str | None = None,
) -> StreamingQuery:
    """Append the embedded chunks of pages whose slug was not met yet.

    Takes what is in ``page_folder`` now and ends; run again, it goes on from the
    checkpoint.  The files of a batch count when all are written, so a batch that
    failed half-way leaves no chunk twice.
    """
    pages = (
        spark.readStream.schema(RAW_PAGE)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(page_folder)
    )
    clean = extract_pages(new_slugs(pages, site_prefix), site_prefix)
    vectors = embed(chunk_pages(clean), encoder_factory, dim, encoder_id=encoder_id)
    return (
        vectors.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
