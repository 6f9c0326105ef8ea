"""Raw web pages to clean pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from passagelake.functions.html import with_title_and_text
from passagelake.functions.text import slugify
from passagelake.session import broadcast_if_small


def with_slug(pages: DataFrame, site_prefix: str = "") -> DataFrame:
    return pages.withColumn("slug", slugify(F.col("url"), site_prefix))


def page_problem() -> Column:
    """Why a page cannot be read, or null."""
    return F.when(F.col("url").isNull(), "url missing").when(
        F.col("html").isNull(), "html missing"
    )


def split_bad_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable pages, unreadable pages with a ``reason``)."""
    # Plain null checks, which reach the file scan.
    good = pages.where("url is not null and html is not null")
    bad = pages.where("url is null or html is null")
    return good, bad.withColumn("reason", page_problem())


def extract_pages(pages: DataFrame, site_prefix: str = "") -> DataFrame:
    """``(slug, url, title, text)`` of every readable page; other columns pass through."""
    good, _ = split_bad_pages(pages)
    extra = [c for c in pages.columns if c not in ("url", "html", "slug")]
    clean = with_title_and_text(with_slug(good, site_prefix))
    return clean.select(*extra, "slug", "url", "title", "text")


def first_per_slug(pages: DataFrame, order_by: str = "page_id") -> DataFrame:
    """The first page of each slug.

    The limit on the row number also runs before the shuffle, so a slug that most
    pages share sends one row per task.
    """
    order = Window.partitionBy("slug").orderBy(order_by)
    return pages.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def new_pages(
    pages: DataFrame, existing: DataFrame, site_prefix: str = "", order_by: str = "page_id"
) -> DataFrame:
    """Raw pages whose slug is neither stored yet nor taken by an earlier page.

    Slugs and ids decide; the pages' text moves only for those that are new.
    """
    good, _ = split_bad_pages(pages)
    slugged = with_slug(good, site_prefix)
    firsts = slugged.groupBy("slug").agg(F.min(order_by).alias("_first"))
    fresh = firsts.join(existing.select("slug"), "slug", "left_anti")
    fresh = broadcast_if_small(fresh.withColumnRenamed("slug", "_slug"))
    chosen = (F.col("slug") == F.col("_slug")) & F.col(order_by).eqNullSafe(F.col("_first"))
    return first_per_slug(slugged.join(fresh, chosen).select(*slugged.columns), order_by)


def merge_pages(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Stored and new clean pages as one table, marked by origin."""
    return existing.withColumn("origin", F.lit("cached")).unionByName(
        new.withColumn("origin", F.lit("new"))
    )


def ingest_pages(
    pages: DataFrame, existing: DataFrame, site_prefix: str = "", order_by: str = "page_id"
) -> DataFrame:
    """``existing`` clean pages plus the extraction of whatever is new."""
    fresh = extract_pages(new_pages(pages, existing, site_prefix, order_by), site_prefix)
    return merge_pages(
        existing.select("slug", "url", "title", "text"),
        fresh.select("slug", "url", "title", "text"),
    )


def page_outcomes(
    pages: DataFrame, existing: DataFrame, site_prefix: str = "", order_by: str = "page_id"
) -> DataFrame:
    """What ingest does with each page: new, cached, slug taken, or why it is skipped.

    Only ids, urls and slugs are moved, not the pages.
    """
    narrow = with_slug(
        pages.select(order_by, "url", page_problem().alias("_problem")), site_prefix
    )
    usable = narrow.where("_problem is null")
    firsts = usable.groupBy("slug").agg(F.min(order_by).alias("_first"))
    known = existing.select("slug").distinct().withColumn("_known", F.lit(True))
    # Keyed by slug with one row each, so a slug shared by many pages only
    # repeats on the page side, where adaptive execution can split it.
    fates = firsts.join(known, "slug", "left")
    outcome = (
        F.when(F.col("_problem").isNotNull(), F.col("_problem"))
        .when(F.col("_known"), F.lit("cached"))
        .when(F.col(order_by) == F.col("_first"), F.lit("new"))
        .otherwise(F.lit("slug taken"))
    )
    return narrow.join(fates, "slug", "left").select(
        order_by, "url", "slug", outcome.alias("outcome")
    )


def processed_counts(outcomes: DataFrame) -> DataFrame:
    """Pages per outcome."""
    return outcomes.groupBy("outcome").agg(F.count("*").alias("pages"))
