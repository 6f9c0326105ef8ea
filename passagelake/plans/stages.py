"""The whole chain from raw pages to answers, stage by stage, each timed."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from passagelake import config
from passagelake.operators.changes import GONE, NEW, SAME, carry_vectors, changes, text_digest, without
from passagelake.operators.chunks import chunk_pages
from passagelake.operators.embedding import embed, embed_queries, encoder_of, hashing_id
from passagelake.operators.index import suggested_nlist
from passagelake.operators.pages import (
    extract_pages,
    new_pages,
    split_bad_pages,
    with_slug,
)
from passagelake.operators.prompts import answers_with_sources, build_prompts, generate
from passagelake.operators.search import exact_search, ivf_search
from passagelake.operators.two_level import TwoLevel, assign_two_level, train_two_level
from passagelake.session import broadcast_if_small, scratch_path
from passagelake.sources import grouped
from passagelake.sources.tables import (
    create_collection,
    load_collection,
    read_table,
    require,
    upsert_rows,
    write_table,
)

DEFAULT_QUESTION = "How do I submit a job that runs on several nodes?"


def stage_shares(timings: DataFrame, total: Column | float | None = None) -> DataFrame:
    """Share of the total time per stage, with a bar of one block per two percent.

    ``total`` is the wall clock from end to end; without it, the stages' sum.
    """
    if total is None:
        total = timings.agg(F.sum("elapsed")).scalar()
    elif not isinstance(total, Column):
        total = F.lit(float(total))
    percent = F.when(total > 0, 100 * F.col("elapsed") / total).otherwise(F.lit(0.0))
    return timings.select(
        "label", "elapsed", percent.alias("percent"),
        F.repeat(F.lit("█"), F.floor(percent / 2).cast("int")).alias("bar"),
    )


def questions(spark: SparkSession, texts: list[str] | None = None) -> DataFrame:
    """``(qid, qtext)``; the default question if none is asked."""
    texts = texts or [DEFAULT_QUESTION]
    return spark.createDataFrame(list(enumerate(texts)), "qid bigint, qtext string")


def build_chunks(
    pages: DataFrame, size: int = config.CHUNK_SIZE, overlap: int = config.CHUNK_OVERLAP,
    site_prefix: str = "",
) -> DataFrame:
    """Raw pages to chunks, one page per slug; slugs and ids tell which, before any html moves."""
    nothing = pages.sparkSession.createDataFrame([], "slug string")
    clean = extract_pages(new_pages(pages, nothing, site_prefix), site_prefix)
    return chunk_pages(clean, size, overlap)


def search_text(
    queries: DataFrame,
    collection: DataFrame,
    centroids: DataFrame | None = None,
    k: int = config.TOP_K,
    nprobe: int | None = config.NPROBE,
    where: Column | str | None = None,
    encoder_factory: Callable | None = None,
    dim: int = config.EMBED_DIM,
    encoder_id: str | None = None,
) -> DataFrame:
    """Hits for ``(qid, qtext)``: by bucket if centroids are given, else exact, as if ``nprobe`` is None."""
    encoded = embed_queries(queries, encoder_factory, dim, encoder_id)
    if centroids is None or nprobe is None:
        return exact_search(encoded, collection, k, where=where)
    return ivf_search(encoded, collection, centroids, k, nprobe, where=where)


#: Parts that the chain's tables are split into by page, and folders that they share.
PARTS, FOLDERS = 512, 32


def by_part(rows: DataFrame) -> DataFrame:
    """``rows`` with the part of their page, in ``cid``."""
    return rows.withColumn("cid", F.pmod(F.xxhash64("slug"), F.lit(PARTS)).cast("int"))


@dataclass
class Chain:
    """Stages that each read the table before and write their own.

    A stage can be re-run alone; it fails with the step to run if its input is
    missing.  Pages, chunks and vectors are kept by part of their page and in versions, so a re-run
    rewrites only what changed: ``sync`` compares digests of pages, takes changed pages apart anew,
    carries over the vectors of texts that were encoded before, encodes the others, and replaces
    rows of changed pages in the collection.
    """

    spark: SparkSession
    folder: str
    encoder_factory: Callable | None = None
    encoder_id: str | None = None
    dim: int = config.EMBED_DIM
    nlist: int | None = None
    site_prefix: str = ""
    subject: str = ""
    size: int = config.CHUNK_SIZE
    overlap: int = config.CHUNK_OVERLAP
    timings: list[tuple[str, float]] = field(default_factory=list)

    def _at(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _has(self, name: str) -> bool:
        return grouped.is_grouped(self.spark, self._at(name))

    @contextmanager
    def _timed(self, label: str):
        start = time.perf_counter()
        try:
            yield
        finally:
            self.timings.append((label, time.perf_counter() - start))

    def _store(self, rows: DataFrame, name: str) -> str:
        firsts = list(range(0, PARTS, PARTS // FOLDERS))
        return grouped.create(by_part(rows), self._at(name), config.INSERT_BATCH_ROWS, firsts, keys=False)

    def _replace(self, rows: DataFrame, slugs: DataFrame, name: str) -> None:
        """``rows`` instead of what the table has of the pages ``slugs``."""
        stored = read_table(self.spark, self._at(name))
        firsts = stored.schema["grp"].metadata["firsts"]
        parts = [r[0] for r in by_part(slugs).select("cid").distinct().collect()]
        groups = grouped.groups_of(parts, firsts)
        part = stored.where(F.col("grp").isin(groups)).drop("grp")
        merged = without(part, slugs, "slug").unionByName(by_part(rows))
        grouped.replace_groups(merged, groups, rows.select("id"), self._at(name), config.INSERT_BATCH_ROWS)

    def _pages(self, pages: DataFrame) -> DataFrame:
        """Raw pages as the table keeps them, with a digest of what they were made from."""
        digested = pages.withColumn("digest", text_digest("html"))
        return extract_pages(digested, self.site_prefix).select(
            F.col("slug").alias("id"), "slug", "url", "title", "text", "digest"
        )

    def clean_pages(self, pages: DataFrame) -> str:
        """Append the pages whose slug is not stored yet."""
        target = self._at("pages")
        with self._timed("pages"):
            if not self._has("pages"):
                fresh = new_pages(pages, pages.sparkSession.createDataFrame([], "slug string"), self.site_prefix)
                return self._store(self._pages(fresh), "pages")
            fresh = self._pages(new_pages(pages, read_table(self.spark, target), self.site_prefix))
            fresh = self._kept(fresh, "pages")
            return target if fresh.isEmpty() else grouped.append(by_part(fresh), target, config.INSERT_BATCH_ROWS)

    def update_pages(self, pages: DataFrame) -> str:
        """Make the table what ``pages`` are now: new, changed and vanished ones are replaced."""
        if not self._has("pages"):
            return self.clean_pages(pages)
        with self._timed("pages"):
            good, _ = split_bad_pages(pages)
            firsts = with_slug(good, self.site_prefix).groupBy("slug").agg(
                F.min_by(text_digest("html"), "page_id").alias("digest")
            )
            stored = read_table(self.spark, self._at("pages")).select("slug", "digest")
            moved = self._kept(changes(firsts, stored, "slug").where(F.col("change") != SAME), "moved")
            if not moved.isEmpty():
                same = without(firsts, moved, "slug")
                fresh = self._kept(self._pages(new_pages(pages, same, self.site_prefix)), "pages")
                self._replace(fresh, moved, "pages")
            return self._at("pages")

    def _kept(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` computed once: they are read several times, also by what replaces their source."""
        return read_table(self.spark, write_table(rows, scratch_path(self.spark, name)))

    def _chunks(self, pages: DataFrame) -> DataFrame:
        kept = pages.withColumnRenamed("digest", "page_digest")
        chunks = chunk_pages(kept, self.size, self.overlap, keep=("page_digest",))
        return chunks.withColumn("digest", text_digest("text"))

    def chunk(self, size: int | None = None, overlap: int | None = None) -> str:
        self.size = self.size if size is None else size
        self.overlap = self.overlap if overlap is None else overlap
        with self._timed("chunks"):
            pages = require(self.spark, self._at("pages"), "clean_pages")
            return self._store(self._chunks(pages), "chunks")

    def _embedded(self, chunks: DataFrame) -> DataFrame:
        """Chunks with vectors: those of texts encoded before, by this encoder, are carried over."""
        if self._has("vectors"):
            stored = read_table(self.spark, self._at("vectors"))
            if encoder_of(stored, "embedding") == (self.encoder_id or hashing_id(self.dim)):
                chunks = carry_vectors(chunks, stored)
        return embed(chunks, self.encoder_factory, self.dim, encoder_id=self.encoder_id)

    def embed(self) -> str:
        with self._timed("vectors"):
            chunks = require(self.spark, self._at("chunks"), "chunk").drop("cid", "grp")
            return self._store(self._embedded(chunks), "vectors")

    def index(self) -> str:
        """Train the buckets, as many as the rows ask for, and write the collection by them."""
        with self._timed("index"):
            vectors = require(self.spark, self._at("vectors"), "embed")
            rows = vectors.select("id", "url", "title", "text", "embedding")
            index = train_two_level(rows, self.nlist).write(self._at("centroids"))
            return create_collection(assign_two_level(rows, index), self._at("collection"), self.dim)

    def sync(self) -> dict[str, int]:
        """Bring chunks, vectors and collection up to the pages; how many pages changed in which way."""
        stages = (("chunks", self.chunk), ("vectors", self.embed), ("collection", self.index))
        if not all(self._has(name) for name, _ in stages):
            for _, stage in stages:
                stage()
            return {NEW: read_table(self.spark, self._at("pages")).count()}
        pages = require(self.spark, self._at("pages"), "clean_pages").drop("cid", "grp")
        with self._timed("chunks"):
            stored = read_table(self.spark, self._at("vectors"))
            known = stored.select("slug", F.col("page_digest").alias("digest"))
            found = changes(pages.select("slug", "digest"), known, "slug").where(F.col("change") != SAME)
            moved = self._kept(found, "moved")
            counts = {r[0]: r[1] for r in moved.groupBy("change").count().collect()}
            if not counts:
                return {}
            fresh = pages.join(broadcast_if_small(moved.where(F.col("change") != GONE).select("slug")), "slug", "left_semi")
            chunks = self._kept(self._chunks(fresh), "chunks")
        with self._timed("vectors"):
            vectors = self._kept(self._embedded(chunks), "vectors")
            had = stored.select("id", "slug").join(broadcast_if_small(moved.select("slug")), "slug", "left_semi")
            gone = self._kept(without(had, vectors, "id").select("id"), "gone")
        with self._timed("index"):
            # The collection first: what the vectors' table doesn't show yet is done again after a failure.
            rows = vectors.select("id", "url", "title", "text", "embedding")
            index = TwoLevel.read(self.spark, self._at("centroids"))
            upsert_rows(rows, self._at("collection"), self.dim, index, gone=gone)
        with self._timed("vectors"):
            self._replace(chunks, moved, "chunks")
            self._replace(vectors, moved, "vectors")
        rows = read_table(self.spark, self._at("vectors")).count()
        wanted, has = self.nlist or suggested_nlist(rows), index.buckets.count()
        if not wanted / 2 <= has <= wanted * 2:
            self.index()
        return counts

    def search(
        self, queries: DataFrame, k: int = config.TOP_K, nprobe: int | None = config.NPROBE,
        where: Column | str | None = None,
    ) -> DataFrame:
        """Hits of ``nprobe`` buckets, or of all of them if it is None."""
        collection = load_collection(self.spark, self._at("collection"), step="index")
        index = TwoLevel.read(self.spark, self._at("centroids"), "index")
        return search_text(
            queries, collection, index.buckets, k, nprobe, where,
            self.encoder_factory, self.dim, self.encoder_id,
        )

    def answer(
        self, queries: DataFrame, generator_factory: Callable, k: int = config.TOP_K,
        nprobe: int | None = config.NPROBE,
    ) -> DataFrame:
        """``(qid, answer, sources)``."""
        # Prompts and sources both read the hits; the search runs once.
        found = write_table(self.search(queries, k, nprobe), self._at("hits"))
        hits = read_table(self.spark, found)
        prompts = build_prompts(queries, hits, config.system_prompt(self.subject))
        return answers_with_sources(generate(prompts, generator_factory), hits)

    def run(
        self, pages: DataFrame, generator_factory: Callable, queries: DataFrame | None = None,
        k: int = config.TOP_K, nprobe: int | None = config.NPROBE,
    ) -> tuple[DataFrame, DataFrame]:
        """All stages in order: (stored answers, time shares).  Run again, pages that are
        stored stay as they are, and nothing is encoded that was before."""
        start = time.perf_counter()
        first = len(self.timings)
        queries = questions(self.spark) if queries is None else queries
        self.clean_pages(pages)
        self.sync()
        with self._timed("answers"):
            answers = self.answer(queries, generator_factory, k, nprobe)
            write_table(answers, self._at("answers"))
        total = time.perf_counter() - start
        timings = self.spark.createDataFrame(
            self.timings[first:], "label string, elapsed double"
        )
        return read_table(self.spark, self._at("answers")), stage_shares(timings, total)
