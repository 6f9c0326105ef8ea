"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from passagelake.config import EMBED_DIM, MAX_LENGTHS
from passagelake.functions.text import (
    chunk_id,
    context_block,
    preview,
    score_band,
    score_text,
    slugify,
)
from passagelake.functions.vectors import (
    cosine_similarity,
    inner_product,
    l2_distance,
    l2_norm,
    l2_normalize,
)
from passagelake.functions.packed import as_arrays, as_bytes
from passagelake.operators import prompts
from passagelake.operators.bounded import bounded_nearest
from passagelake.operators.chunks import chunk_pages, chunk_stats, presented
from passagelake.operators.embedding import embed, embed_queries, missing_vectors
from passagelake.operators.index import (
    assign_buckets,
    bucket_sizes,
    collection_stats,
    mean_vectors,
    probe,
    train_centroids,
)
from passagelake.operators.pages import (
    extract_pages,
    ingest_pages,
    new_pages,
    page_outcomes,
    processed_counts,
)
from passagelake.operators.search import (
    as_nested_hits,
    described_hits,
    exact_search,
    ivf_search,
    recall_at_k,
    single_query_search,
)
from passagelake.operators.two_level import assign_two_level, recall_curve, train_two_level
from passagelake.plans.stages import Chain, build_chunks, search_text, stage_shares
from passagelake.schema import duplicate_keys, validate_schema
from passagelake.session import broadcast_if_small, scratch_path
from passagelake.sources.tables import (
    create_collection,
    insert_rows,
    load_collection,
    read_clean_pages,
    read_page_lines,
    read_table,
    spread,
    upsert_rows,
    write_clean_pages,
    write_counted,
    write_page_files,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]

VECTOR_DIM = 64  # width of the vectors in the embeddings table
SITE_PREFIX = "https://"
FILTER_LABEL = 3


# --- inputs --------------------------------------------------------------------


def _table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return df.select(*columns) if columns else df


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return spread(_table(spark, sf, "pages", "page_id", "url", "html"))


def _stored_pages(pages: DataFrame) -> DataFrame:
    """Pages an earlier run is taken to have stored: the French part of the sites."""
    return extract_pages(pages.where(F.col("url").contains("/fr/")), SITE_PREFIX).select(
        "slug", "url", "title", "text"
    )


def _document_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as clean pages."""
    docs = spread(_table(spark, sf, "documents", "doc_id", "text", "lang", "source"))
    return docs.select(
        F.concat(F.lit("doc_"), "doc_id").alias("slug"),
        F.concat_ws("/", F.lit("corpus"), "source", "doc_id").alias("url"),
        F.concat_ws(" ", "source", "lang").alias("title"),
        "text",
    )


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunk_pages(_document_pages(spark, sf))


def _stored_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks from a table: searches read them to score, and again for the hits' text."""
    return read_table(spark, write_table(_chunks(spark, sf), scratch_path(spark, "chunks")))


def _collection(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    """The vector table as a collection; its label is the title."""
    vectors = spread(_table(spark, sf, "embeddings", "vec_id", "embedding", "label"))
    return vectors.select(
        F.col("vec_id").cast("string").alias("id"),
        F.concat(F.lit("vectors/"), "vec_id").alias("url"),
        F.concat(F.lit("label "), "label").alias("title"),
        F.concat(F.lit("vector "), "vec_id", F.lit(" of label "), "label").alias("text"),
        "embedding", *extra,
    )


def _label_queries(collection: DataFrame) -> DataFrame:
    """One query per label: the mean of all vectors that carry it."""
    return mean_vectors(collection, "label").select(
        F.col("label").cast("bigint").alias("qid"), F.col("c").alias("qv")
    )


def _stored_index(rows: DataFrame, dim: int) -> tuple[DataFrame, DataFrame]:
    """(collection stored by bucket, centers of its buckets), as many as the rows ask for."""
    spark = rows.sparkSession
    index = train_two_level(rows)
    placed = as_arrays(assign_two_level(rows, index))
    target = create_collection(placed, scratch_path(spark, "collection"), dim, sizes=index.sizes)
    return load_collection(spark, target), index.buckets


def _text_queries(spark: SparkSession, sf: str) -> DataFrame:
    asked = _table(spark, sf, "benchmark", "item_id", "text")
    return asked.select(F.col("item_id").alias("qid"), F.col("text").alias("qtext"))


def _text_hits(spark: SparkSession, sf: str) -> DataFrame:
    return exact_search(
        embed_queries(_text_queries(spark, sf)), embed(_stored_chunks(spark, sf))
    )


def _rounded(score: Column | str = "score") -> Column:
    return F.round(score, 6).alias("score")


def _hits(found: DataFrame) -> DataFrame:
    return found.select(
        "qid", F.col("rk").cast("bigint").alias("rk"), "id", _rounded(), "text", "url", "title"
    )


# --- pages ---------------------------------------------------------------------


def slugify_urls(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages", "page_id", "url")
    return pages.select("page_id", slugify(F.col("url"), SITE_PREFIX).alias("slug"))


def page_extract(spark: SparkSession, sf: str) -> DataFrame:
    return extract_pages(_pages(spark, sf), SITE_PREFIX)


def pages_incremental(spark: SparkSession, sf: str) -> DataFrame:
    pages = _pages(spark, sf)
    return ingest_pages(pages, _stored_pages(pages), SITE_PREFIX)


def page_outcome_list(spark: SparkSession, sf: str) -> DataFrame:
    pages = _pages(spark, sf)
    return page_outcomes(pages, _stored_pages(pages), SITE_PREFIX)


def page_counts(spark: SparkSession, sf: str) -> DataFrame:
    return processed_counts(page_outcome_list(spark, sf))


def page_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return build_chunks(_pages(spark, sf), site_prefix=SITE_PREFIX).withColumn(
        "chunk_idx", F.col("chunk_idx").cast("bigint")
    )


def page_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    target = write_clean_pages(page_extract(spark, sf), scratch_path(spark, "pages-json"))
    return read_page_lines(spark, target)


def page_files(spark: SparkSession, sf: str) -> DataFrame:
    """Clean pages as one JSON document per file, read back; the file's name is the slug."""
    nothing = spark.createDataFrame([], "slug string")
    clean = extract_pages(new_pages(_pages(spark, sf), nothing, SITE_PREFIX), SITE_PREFIX)
    folder = write_page_files(clean, scratch_path(spark, "page-files"))
    return read_clean_pages(spark, folder)


def broken_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Every page with a menu that is never closed, and with references that lack their semicolon."""
    more = "<div><nav>menu &copy 2024</div><p>After &copy 2024 &amp more.</p></article>"
    pages = _pages(spark, sf)
    broken = pages.withColumn("html", F.regexp_replace("html", "(?i)</article>", more))
    return extract_pages(broken, SITE_PREFIX).select("page_id", "slug", "title", "text")


def page_faults(spark: SparkSession, sf: str) -> DataFrame:
    """What ingest does with pages of which some lack their url or html, or share one slug."""
    page = F.col("page_id")
    url = F.when(page % 13 == 0, None).when(page % 19 == 0, "https://same.example/").otherwise(F.col("url"))
    html = F.when(page % 17 == 0, None).otherwise(F.col("html"))
    pages = _pages(spark, sf).withColumns({"url": url, "html": html})
    return page_outcomes(pages, _stored_pages(pages), SITE_PREFIX)


# --- chunks --------------------------------------------------------------------


def chunk_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _chunks(spark, sf).withColumn("chunk_idx", F.col("chunk_idx").cast("bigint"))


def chunk_documents_small(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of 60 characters reach every separator and the hard cut."""
    pieces = chunk_pages(_document_pages(spark, sf), size=60, overlap=10)
    return pieces.select("id", "text")


def chunk_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return chunk_stats(_chunks(spark, sf)).select(
        "chunks", "pages", F.round("mean_chars", 6).alias("mean_chars")
    )


def chunk_table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    target = write_table(_chunks(spark, sf), scratch_path(spark, "chunks"))
    stored = read_table(spark, target)
    return stored.groupBy("title").agg(
        F.count("*").alias("chunks"), F.sum(F.length("text")).alias("chars")
    )


def chunks_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks as they are shown: by page, then by place."""
    shown = presented(_chunks(spark, sf))
    return shown.select("slug", F.col("chunk_idx").cast("bigint").alias("chunk_idx"), "id")


def chunk_counts_observed(spark: SparkSession, sf: str) -> DataFrame:
    """Figures of the chunk table, told by the job that writes it."""
    long = F.count_if(F.length("text") > MAX_LENGTHS["text"])
    seen = write_counted(
        _chunks(spark, sf), scratch_path(spark, "chunks"), chunks=F.count(F.lit(1)), pages=F.count_if(F.col("chunk_idx") == 0),
        chars=F.sum(F.length("text")), too_long=long,
    )
    return spark.createDataFrame([tuple(seen[n] for n in ("chunks", "pages", "chars", "too_long"))], "chunks long, pages long, chars long, too_long long")


def chunk_previews(spark: SparkSession, sf: str) -> DataFrame:
    return _chunks(spark, sf).select("id", preview(F.col("text")).alias("preview"))


# --- checks --------------------------------------------------------------------


def schema_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents as rows: long texts break the limit, bare ones lack a vector."""
    docs = _document_pages(spark, sf).withColumnRenamed("slug", "id")
    vectors = _table(spark, sf, "embeddings", "vec_id", "embedding")
    joined = docs.join(
        vectors.select(F.concat(F.lit("doc_"), "vec_id").alias("id"), "embedding"), "id", "left"
    )
    return validate_schema(joined, VECTOR_DIM)


def duplicate_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Titles are no keys: taken as ids, they repeat."""
    return duplicate_keys(_document_pages(spark, sf).select(F.col("title").alias("id")))


# --- vectors -------------------------------------------------------------------


def embed_hashing(spark: SparkSession, sf: str) -> DataFrame:
    vectors = embed(_document_pages(spark, sf).select("slug", "text"))
    long = vectors.select("slug", F.posexplode_outer("embedding").alias("b", "w"))
    return long.where("w <> 0").select(
        "slug", F.col("b").cast("bigint").alias("b"), F.round(F.col("w").cast("double"), 6).alias("w")
    )


def _half_embedded(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, some with a vector of their own, others without one."""
    docs = _document_pages(spark, sf).select("slug", "text")
    vectors = _table(spark, sf, "embeddings", "vec_id", "embedding").select(
        F.concat(F.lit("doc_"), "vec_id").alias("slug"), "embedding"
    )
    return docs.join(vectors, "slug", "left")


def embed_missing_only(spark: SparkSession, sf: str) -> DataFrame:
    vectors = embed(_half_embedded(spark, sf), dim=VECTOR_DIM)
    long = vectors.select("slug", F.posexplode_outer("embedding").alias("b", "w"))
    return long.where("w <> 0").select(
        "slug", F.col("b").cast("bigint").alias("b"), F.round(F.col("w").cast("double"), 6).alias("w")
    )


def still_missing(spark: SparkSession, sf: str) -> DataFrame:
    return missing_vectors(_half_embedded(spark, sf), VECTOR_DIM).select("slug")


def vector_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Each vector against its label's mean, by every measure."""
    rows = _collection(spark, sf, "label")
    means = broadcast_if_small(mean_vectors(rows, "label"))
    v, c = F.col("embedding"), F.col("c")
    unit = l2_normalize(c)
    return rows.join(means, "label").select(
        "id",
        F.round(cosine_similarity(v, c), 6).alias("cosine"),
        F.round(inner_product(v, c), 6).alias("ip"),
        F.round(l2_distance(v, c), 6).alias("l2"),
        F.round(l2_norm(unit), 6).alias("unit_norm"),
    )


def unit_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Every element of each vector, made three times as long, after normalisation."""
    longer = F.transform(F.col("embedding").cast("array<double>"), lambda x: 3 * x)
    rows = _collection(spark, sf).select("id", F.posexplode(l2_normalize(longer)).alias("i", "x"))
    return rows.select("id", F.col("i").cast("bigint").alias("i"), F.round("x", 6).alias("x"))


def score_bands(spark: SparkSession, sf: str) -> DataFrame:
    rows = _collection(spark, sf, "label")
    means = broadcast_if_small(mean_vectors(rows, "label"))
    scored = rows.join(means, "label").select(
        "id", cosine_similarity(F.col("embedding"), F.col("c")).alias("score")
    )
    return scored.select(
        "id", _rounded(), score_text(F.col("score")).alias("score_text"),
        score_band(F.col("score")).alias("band"),
    )


# --- search --------------------------------------------------------------------


def _exact(metric: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = _collection(spark, sf, "label")
        return _hits(exact_search(_label_queries(rows), rows, metric=metric))

    return run


def single_query_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The mean of the whole collection as the one query."""
    rows = _collection(spark, sf)
    query = mean_vectors(rows.withColumn("qid", F.lit(0)), "qid")
    return _hits(single_query_search(query.select(F.col("qid").cast("bigint"), F.col("c").alias("qv")), rows))


def filtered_topk(spark: SparkSession, sf: str) -> DataFrame:
    rows = _collection(spark, sf, "label")
    return _hits(exact_search(_label_queries(rows), rows, where=F.col("label") == FILTER_LABEL))


def hits_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Nested hits, flattened again for comparison."""
    rows = _collection(spark, sf, "label")
    nested = as_nested_hits(exact_search(_label_queries(rows), rows))
    return nested.select("qid", F.posexplode("hits")).select(
        "qid", F.col("pos").cast("bigint").alias("pos"), F.col("col.id").alias("id"),
        F.round("col.distance", 6).alias("distance"), F.col("col.entity.title").alias("title"),
        F.col("col.entity.url").alias("url"), F.col("col.entity.text").alias("text"),
    )


def kmeans_lloyd(spark: SparkSession, sf: str) -> DataFrame:
    centroids = train_centroids(_collection(spark, sf))
    return centroids.select(F.col("cid").cast("bigint"), F.posexplode("c").alias("i", "x")).select(
        "cid", F.col("i").cast("bigint").alias("i"), F.round("x", 6).alias("x")
    )


def kmeans_mllib(spark: SparkSession, sf: str) -> DataFrame:
    """What holds of MLlib's centroids whatever their seeds: as many as wanted, and each vector in the
    bucket of the nearest."""
    rows = _collection(spark, sf)
    centroids = train_centroids(rows, iters=10, method="mllib")
    placed = assign_buckets(rows, centroids).select("id", "embedding", "cid")
    every = F.broadcast(centroids.agg(F.collect_list(F.struct("cid", "c")).alias("all")))  # 16 rows
    scores = F.transform("all", lambda x: F.struct(F.round(cosine_similarity(F.col("embedding"), x["c"]), 9).alias("s"), (-x["cid"]).alias("n"), x["cid"].alias("cid")))
    best = placed.join(every).select("id", "cid", F.array_max(scores)["cid"].alias("nearest"))
    return best.agg(
        centroids.agg(F.count("*")).scalar().alias("buckets"), F.count("*").alias("vectors"),
        F.count_if(~F.col("cid").eqNullSafe(F.col("nearest"))).alias("misplaced"),
    )


def ivf_bucket_sizes(spark: SparkSession, sf: str) -> DataFrame:
    rows = _collection(spark, sf)
    placed = assign_buckets(rows, train_centroids(rows))
    return bucket_sizes(placed).select(F.col("cid").cast("bigint").alias("cid"), "n")


def probe_selection(spark: SparkSession, sf: str) -> DataFrame:
    rows = _collection(spark, sf, "label")
    probes = probe(_label_queries(rows), train_centroids(rows))
    return probes.select(
        "qid", F.col("rk").cast("bigint").alias("rk"), F.col("cid").cast("bigint").alias("cid"),
        _rounded(),
    )


def ivf_topk(spark: SparkSession, sf: str) -> DataFrame:
    stored, centroids = _stored_index(_collection(spark, sf), VECTOR_DIM)
    queries = _label_queries(_collection(spark, sf, "label"))
    return _hits(ivf_search(queries, stored, centroids))


def ivf_recall(spark: SparkSession, sf: str) -> DataFrame:
    stored, centroids = _stored_index(_collection(spark, sf), VECTOR_DIM)
    queries = _label_queries(_collection(spark, sf, "label"))
    exact = exact_search(queries, stored, fields=[])
    approx = ivf_search(queries, stored, centroids, fields=[])
    return recall_at_k(exact, approx).withColumn("recall", F.round("recall", 6))


def bounded_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest rows of every twentieth vector, by bounds of cells instead of all tiles."""
    rows = _table(spark, sf, "embeddings", "vec_id", "embedding")
    items = rows.select(F.col("vec_id").cast("string").alias("id"), "embedding")
    asked = rows.where(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qv"))
    found = bounded_nearest(asked, items, cells=16)
    return found.select("qid", F.col("rk").cast("bigint").alias("rk"), "id", _rounded())


def kmeans_two_level(spark: SparkSession, sf: str) -> DataFrame:
    """Centers of the buckets inside coarse cells, as many as the rows ask for."""
    buckets = train_two_level(_collection(spark, sf)).buckets
    return buckets.select(F.col("cid").cast("bigint"), F.posexplode("c").alias("i", "x")).select(
        "cid", F.col("i").cast("bigint").alias("i"), F.round("x", 6).alias("x")
    )


def recall_by_nprobe(spark: SparkSession, sf: str) -> DataFrame:
    """The recall of every number of probed buckets, told by one search."""
    stored, buckets = _stored_index(_collection(spark, sf), VECTOR_DIM)
    queries = _label_queries(_collection(spark, sf, "label"))
    exact = exact_search(queries, stored, fields=[])
    curve = recall_curve(queries, exact, stored, buckets)
    return curve.withColumn("nprobe", F.col("nprobe").cast("bigint")).withColumn("recall", F.round("recall", 6))


# --- collections ---------------------------------------------------------------


def collection_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return collection_stats(_stored_index(_collection(spark, sf), VECTOR_DIM)[0])


def _renewed(rows: DataFrame) -> DataFrame:
    """A second delivery: one label again with new texts, and all rows under new keys."""
    again = rows.where(F.col("title") == f"label {FILTER_LABEL}").withColumn(
        "text", F.concat(F.lit("renewed "), "text")
    )
    return again.unionByName(again.withColumn("id", F.concat(F.lit("new_"), "id")))


def upsert_collection(spark: SparkSession, sf: str) -> DataFrame:
    """The stored, bucketed collection after the second delivery."""
    rows = _collection(spark, sf)
    centroids = read_table(spark, write_table(train_centroids(rows), scratch_path(spark, "centroids")))
    target = create_collection(
        assign_buckets(rows, centroids), scratch_path(spark, "collection"), VECTOR_DIM
    )
    upsert_rows(_renewed(rows), target, VECTOR_DIM, centroids)
    return load_collection(spark, target).select("id", "url", "title", "text")


def collection_lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    """Create, create again, insert, load, count by title."""
    rows = _collection(spark, sf)
    target = scratch_path(spark, "collection")
    create_collection(rows, target, VECTOR_DIM)
    create_collection(rows, target, VECTOR_DIM)
    insert_rows(rows.withColumn("id", F.concat(F.lit("new_"), "id")), target, VECTOR_DIM)
    stored = load_collection(spark, target)
    return stored.groupBy("title").agg(
        F.count("*").alias("n"), F.count_distinct("id").alias("keys")
    )


# --- text search, prompts, answers ----------------------------------------------


def text_search(spark: SparkSession, sf: str) -> DataFrame:
    return _hits(_text_hits(spark, sf))


def text_search_ivf(spark: SparkSession, sf: str) -> DataFrame:
    """The same questions against the stored, bucketed chunks; until these are made vectors are bytes."""
    target = write_table(as_bytes(embed(_chunks(spark, sf))), scratch_path(spark, "vectors"))
    rows = spread(read_table(spark, target)).select("id", "url", "title", "text", "embedding")
    stored, centroids = _stored_index(rows, EMBED_DIM)
    return _hits(search_text(_text_queries(spark, sf), stored, centroids))


def text_search_shown(spark: SparkSession, sf: str) -> DataFrame:
    shown = described_hits(_text_hits(spark, sf))
    return shown.withColumn("rk", F.col("rk").cast("bigint"))


def context_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Every chunk as the numbered passage it would be."""
    return _chunks(spark, sf).select(
        chunk_id(F.col("slug"), F.col("chunk_idx")).alias("id"),
        context_block(F.col("chunk_idx") + 1, F.col("text")).alias("block"),
    )


def build_prompts(spark: SparkSession, sf: str) -> DataFrame:
    built = prompts.build_prompts(_text_queries(spark, sf), _text_hits(spark, sf))
    return built.select("qid", F.posexplode("messages")).select(
        "qid", F.col("pos").cast("bigint").alias("pos"),
        F.col("col.role").alias("role"), F.col("col.content").alias("content"),
    )


def answer_sources(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.answer_sources(_text_hits(spark, sf)).withColumn("i", F.col("i").cast("bigint"))


def quoting_generator() -> prompts.Generator:
    """Stands in for a model: answers with the first line of the first passage."""

    def answer(chats: list[list[dict]]) -> list[str]:
        passages = [chat[-1]["content"].removeprefix("Context:\n[1] ") for chat in chats]
        return [passage.split("\n", 1)[0] for passage in passages]

    return answer


def generate_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Answers with sources.  Each question is asked again, under a negative number, of a
    source that holds nothing: those have no context."""
    asked, chunks = _text_queries(spark, sf), embed(_stored_chunks(spark, sf))
    again = asked.withColumn("qid", -1 - F.col("qid"))
    found = exact_search(embed_queries(asked), chunks)
    nothing = exact_search(embed_queries(again), chunks, where=F.col("title") == "no such source")
    target = write_table(found.unionByName(nothing), scratch_path(spark, "hits"))
    hits = read_table(spark, target)
    built = prompts.build_prompts(asked.unionByName(again), hits)
    return prompts.answers_with_sources(prompts.generate(built, quoting_generator), hits)


def chain_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Every stage in order, through stored tables; all buckets are looked into."""
    chain = Chain(spark, scratch_path(spark, "chain"), site_prefix=SITE_PREFIX)
    answers, _ = chain.run(_pages(spark, sf), quoting_generator, _text_queries(spark, sf), nprobe=None)
    return answers


def chain_update(spark: SparkSession, sf: str) -> DataFrame:
    """The collection after a second run: of every ten pages one has a heading more, and one is gone."""
    chain = Chain(spark, scratch_path(spark, "chain"), site_prefix=SITE_PREFIX)
    pages = _pages(spark, sf)
    chain.clean_pages(pages)
    chain.sync()
    longer = F.regexp_replace("html", "(?i)</article>", "<p>Revised once more.</p></article>")
    kind = F.col("page_id") % 10
    chain.update_pages(pages.where(kind != 7).withColumn("html", F.when(kind == 3, longer).otherwise(F.col("html"))))
    chain.sync()
    return load_collection(spark, chain._at("collection")).select("id", "url", "title", "text")


def embed_udf(spark: SparkSession, sf: str) -> DataFrame:
    """A caller's encoder: letter counts as a vector of 26 numbers."""
    from string import ascii_lowercase

    def factory():
        def encode(texts: list[str]) -> list[list[float]]:
            return [[float(t.lower().count(c)) for c in ascii_lowercase] for t in texts]

        return encode

    vectors = embed(
        _document_pages(spark, sf).select("slug", "text"), factory, 26, encoder_id="letters"
    )
    return vectors.select(
        "slug", F.round(l2_norm(F.col("embedding")), 4).alias("norm"),
        F.round(F.element_at("embedding", 5).cast("double"), 4).alias("e_share"),
    )


def stage_timings(spark: SparkSession, sf: str) -> DataFrame:
    """Event values summed per type, as if they were a stage's seconds."""
    events = _table(spark, sf, "events", "event_type", "value")
    timings = events.groupBy(F.col("event_type").alias("label")).agg(
        F.round(F.sum("value"), 3).alias("elapsed")
    )
    shares = stage_shares(timings)
    return shares.withColumn("percent", F.round("percent", 1))


QUERIES: dict[str, Query] = {
    "slugify_urls": slugify_urls,
    "page_extract": page_extract,
    "pages_incremental": pages_incremental,
    "page_outcomes": page_outcome_list,
    "page_counts": page_counts,
    "page_chunks": page_chunks,
    "page_json_lines": page_json_lines,
    "page_files": page_files,
    "broken_pages": broken_pages,
    "page_faults": page_faults,
    "chunk_documents": chunk_documents,
    "chunk_documents_small": chunk_documents_small,
    "chunk_stats": chunk_statistics,
    "chunk_table_roundtrip": chunk_table_roundtrip,
    "chunk_previews": chunk_previews,
    "chunks_in_order": chunks_in_order,
    "chunk_counts_observed": chunk_counts_observed,
    "schema_violations": schema_violations,
    "duplicate_keys": duplicate_ids,
    "embed_hashing": embed_hashing,
    "embed_missing_only": embed_missing_only,
    "missing_vectors": still_missing,
    "embed_udf": embed_udf,
    "vector_functions": vector_functions,
    "unit_vectors": unit_vectors,
    "score_bands": score_bands,
    "exact_topk_cosine": _exact("cosine"),
    "exact_topk_ip": _exact("ip"),
    "exact_topk_l2": _exact("l2"),
    "single_query_topk": single_query_topk,
    "filtered_topk": filtered_topk,
    "bounded_topk": bounded_topk,
    "hits_nested": hits_nested,
    "kmeans_lloyd": kmeans_lloyd,
    "kmeans_mllib": kmeans_mllib,
    "ivf_bucket_sizes": ivf_bucket_sizes,
    "probe_selection": probe_selection,
    "ivf_search": ivf_topk,
    "ivf_recall": ivf_recall,
    "recall_curve": recall_by_nprobe,
    "kmeans_two_level": kmeans_two_level,
    "collection_stats": collection_statistics,
    "collection_lifecycle": collection_lifecycle,
    "upsert_collection": upsert_collection,
    "text_search": text_search,
    "text_search_ivf": text_search_ivf,
    "text_search_shown": text_search_shown,
    "context_blocks": context_blocks,
    "build_prompts": build_prompts,
    "answer_sources": answer_sources,
    "generate_answers": generate_answers,
    "chain_answers": chain_answers,
    "chain_update": chain_update,
    "stage_timings": stage_timings,
}
