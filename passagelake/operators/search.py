"""Exact and bucket-probed top-K search, and what is made of the hits."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from passagelake.config import METRIC, NPROBE, SMALL_SIDE_ROWS, TOP_K
from passagelake.functions.text import preview, rank_text, score_band, score_text
from passagelake.operators.embedding import check_same_encoder
from passagelake.operators.index import with_probes
from passagelake.operators.nearest import (
    FEW_SCORES,
    by_tiles,
    check_arguments,
    for_few_queries,
    in_cells,
)
from passagelake.session import small_table

OUTPUT_FIELDS = ["text", "url", "title"]

# Hits that may be broadcast: a key has at most 128 characters, so some 64 MB.
FEW_HITS = 262_144


def _filtered(collection: DataFrame, where: Column | str | None) -> DataFrame:
    return collection if where is None else collection.where(where)


def with_fields(
    hits: DataFrame, collection: DataFrame, fields: list[str] = OUTPUT_FIELDS, few: bool = False
) -> DataFrame:
    """Fetch ``fields`` for the hits only; scoring never reads them.

    ``few`` says that the hits are known to be few: they then go to where the
    collection lies, and it is not shuffled.
    """
    if not fields:
        return hits
    hits = F.broadcast(hits) if few else hits
    return hits.join(collection.select("id", *fields), "id").select(
        "qid", "rk", "id", "score", *fields
    )


def _search(
    queries: DataFrame, rows: DataFrame, k: int, metric: str, fields: list[str],
    small_rows: int, probes: tuple[DataFrame, int] | None = None,
) -> DataFrame:
    """``probes`` are the centroids, and how many buckets each query looks into."""
    check_arguments(k, metric)
    queries = queries.select("qid", "qv")
    centroids, nprobe = probes or (None, 0)
    cell = "cid" if probes else None
    known = small_table(queries, small_rows)
    if known is None or known.num_rows * max(k, nprobe) > FEW_SCORES:
        if probes:
            queries = with_probes(queries, centroids, nprobe, metric, small_rows)
        return with_fields(by_tiles(queries, rows, k, metric, cell), rows, fields)
    pairs = None
    if probes:
        # Vectors are fetched once; a probe is a row number and a bucket.
        numbers = pa.array(range(known.num_rows), pa.int64())
        asked = queries.sparkSession.createDataFrame(pa.table({"qid": numbers, "qv": known["qv"]}))
        pairs = with_probes(asked, centroids, nprobe, metric, small_rows).select("qid", "cid").toArrow()
        # Both the scoring and the fetch keep to the probed buckets.
        rows = in_cells(rows, pairs, cell)
    hits = for_few_queries(known, queries, rows, k, metric, cell, pairs)
    few = pc.count_distinct(known["qid"], mode="all").as_py() * k <= FEW_HITS
    return with_fields(hits, rows, fields, few)


def exact_search(
    queries: DataFrame,
    collection: DataFrame,
    k: int = TOP_K,
    metric: str = METRIC,
    where: Column | str | None = None,
    fields: list[str] = OUTPUT_FIELDS,
    small_rows: int = SMALL_SIDE_ROWS,
) -> DataFrame:
    """Best ``k`` of the whole collection for each query ``(qid, qv)``.

    ``where`` is applied before any vector is scored.
    """
    check_same_encoder(queries, collection)
    rows = _filtered(collection, where)
    return _search(queries, rows, k, metric, fields, small_rows)


def ivf_search(
    queries: DataFrame,
    collection: DataFrame,
    centroids: DataFrame,
    k: int = TOP_K,
    nprobe: int = NPROBE,
    metric: str = METRIC,
    where: Column | str | None = None,
    fields: list[str] = OUTPUT_FIELDS,
    small_rows: int = SMALL_SIDE_ROWS,
) -> DataFrame:
    """Best ``k`` among the ``nprobe`` buckets nearest to each query.

    ``collection`` has the bucket in ``cid``; stored by it, only probed buckets
    are read.
    """
    check_same_encoder(queries, collection)
    rows = _filtered(collection, where)
    return _search(queries, rows, k, metric, fields, small_rows, (centroids, nprobe))


def single_query_search(
    query: DataFrame, collection: DataFrame, k: int = TOP_K, metric: str = METRIC,
    where: Column | str | None = None,
) -> DataFrame:
    """Top-K for exactly one query row."""
    if query.limit(2).count() != 1:
        raise ValueError("exactly one query is expected")
    return exact_search(query, collection, k, metric, where)


def as_nested_hits(hits: DataFrame) -> DataFrame:
    """``(qid, hits)``: hits in rank order as id, distance and entity structs."""
    hit = F.struct(
        F.col("id"), F.coalesce("score", F.lit(0.0)).alias("distance"),
        F.struct(*[F.coalesce(f, F.lit("")).alias(f) for f in OUTPUT_FIELDS]).alias("entity"),
    )
    ordered = F.array_sort(F.collect_list(F.struct(F.col("rk"), hit.alias("hit"))))
    return hits.groupBy("qid").agg(F.transform(ordered, lambda x: x["hit"]).alias("hits"))


def described_hits(hits: DataFrame) -> DataFrame:
    """Hits as they are shown: rank, signed score, band, and a one-line preview."""
    score = F.coalesce("score", F.lit(0.0))
    return hits.select(
        "qid", "rk", "id",
        rank_text(F.col("rk")).alias("rank_text"),
        score_text(score).alias("score_text"),
        score_band(score).alias("band"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("url", F.lit("")).alias("url"),
        preview(F.coalesce("text", F.lit(""))).alias("preview"),
    )


def recall_at_k(exact: DataFrame, approx: DataFrame, k: int = TOP_K) -> DataFrame:
    """One row: share of the exact top ``k`` that the approximate search found."""
    wanted = exact.where(F.col("rk") <= k).select("qid", "id")
    found = approx.where(F.col("rk") <= k).select("qid", "id", F.lit(1).alias("found"))
    return wanted.join(found, ["qid", "id"], "left").agg(
        F.count_distinct("qid").alias("queries"),
        F.count("*").alias("expected"),
        F.count("found").alias("found"),
        (F.count("found") / F.greatest(F.count("*"), F.lit(1))).alias("recall"),
    )
