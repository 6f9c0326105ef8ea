"""Bucket index: K-means centroids and the bucket of every vector."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from passagelake.config import METRIC, NLIST, NPROBE, SMALL_SIDE_BYTES, SMALL_SIDE_ROWS
from passagelake.functions.packed import KINDS, as_arrays, is_packed, kind_of, unpack, width_of
from passagelake.operators.nearest import (
    by_tiles,
    closest,
    matrix_of,
    nearest,
    nearest_in,
    numbered,
    prepared,
    with_vectors,
)
from passagelake.session import broadcast_if_small, checkpointed, scratch_path, small_table
from passagelake.sources.tables import read_table, write_table


def _vector_mean(column: str):
    return vector_to_array(Summarizer.mean(array_to_vector(F.col(column).cast("array<double>"))))


def mean_vectors(collection: DataFrame, by: str) -> DataFrame:
    """``(by, c)``: the mean vector of each group, added up before the shuffle."""
    return collection.groupBy(by).agg(_vector_mean("embedding").alias("c"))


def suggested_nlist(rows: int, small: int = 1_000_000) -> int:
    """Square root of the row count, four times that for a large collection."""
    return max(1, round((1 if rows < small else 4) * rows**0.5))


def train_centroids(
    collection: DataFrame,
    nlist: int = NLIST,
    iters: int = 2,
    seed: int = 42,
    method: str = "lloyd",
    metric: str = METRIC,
    small_rows: int = SMALL_SIDE_ROWS,
) -> DataFrame:
    """``(cid, c)``: centroids of ``nlist`` buckets over the whole collection.

    ``lloyd`` starts from the vectors whose ids have the lowest MD5, which neighbours and
    copies don't share, and is repeatable anywhere; ``mllib`` starts from k-means|| seeds.
    The collection is read once per pass by jobs that run here and now: store vectors
    that an encoder derives before they are trained on.
    """
    vectors = collection.select("id", "embedding")
    if method == "mllib":
        return _mllib(as_arrays(vectors), nlist, iters, seed, metric)
    if method != "lloyd":
        raise ValueError(f"method is 'lloyd' or 'mllib', not {method!r}")
    usable = vectors.where((width_of(vectors) > 0) & F.col("id").isNotNull())
    order = (F.md5(F.col("id").cast("string").cast("binary")), "id")
    # Only nlist ids are left to number; their vectors are fetched by a join.
    chosen = usable.select("id").distinct().orderBy(*order).limit(nlist)
    numbered_ids = chosen.withColumn("cid", F.row_number().over(Window.orderBy(*order)) - 1)
    if nlist <= small_rows:  # stored, as looking whether they are small would sort all ids once more
        spark = vectors.sparkSession
        numbered_ids = read_table(spark, write_table(numbered_ids, scratch_path(spark, "seeds")))
    seeds = usable.join(broadcast_if_small(numbered_ids), "id").dropDuplicates(["cid"])
    centroids = seeds.select("cid", _doubles(seeds).alias("c"))
    first = usable.select(width_of(usable)).first()
    width = first[0] if first else 0
    if nlist > small_rows or 2 * 8 * nlist * width > SMALL_SIDE_BYTES:
        for _ in range(iters):
            centroids = checkpointed(_step_by_tiles(vectors, centroids, metric))
        return centroids
    # Few centroids are fetched after each pass, so that no pass is run again.
    known = centroids.toArrow()
    for _ in range(iters):
        known = _lloyd_step(vectors, known, metric).toArrow()
    return vectors.sparkSession.createDataFrame(known.sort_by("cid"))


def _doubles(df: DataFrame) -> Column:
    own = unpack(F.col("embedding"), kind_of(df)) if is_packed(df) else F.col("embedding")
    return own.cast("array<double>")


def _mllib(vectors: DataFrame, nlist: int, iters: int, seed: int, metric: str) -> DataFrame:
    measure = "euclidean" if metric == "l2" else "cosine"
    points = vectors.where(F.size("embedding") > 0).select(
        array_to_vector("embedding").alias("features")
    )
    if measure == "cosine":
        # A vector without length has no angle.
        points = points.where(F.exists(vector_to_array("features"), lambda x: x != 0))
    model = KMeans(k=nlist, maxIter=iters, seed=seed, distanceMeasure=measure).fit(points)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return vectors.sparkSession.createDataFrame(rows, "cid int, c array<double>")


def _small_centroids(centroids: DataFrame, small_rows: int) -> pa.Table | None:
    known = small_table(centroids.select("cid", "c"), small_rows)
    return None if known is None else known.sort_by("cid")


def _moved(centroids: DataFrame, means: DataFrame) -> DataFrame:
    """Each centroid at the mean of its vectors; one without vectors stays."""
    return centroids.join(means, "cid", "left").select("cid", F.coalesce("mean", "c").alias("c"))


def _lloyd_step(vectors: DataFrame, known: pa.Table, metric: str) -> DataFrame:
    known = known.sort_by("cid")
    return _moved(
        vectors.sparkSession.createDataFrame(known), _bucket_means(vectors, known, metric)
    )


def _step_by_tiles(vectors: DataFrame, centroids: DataFrame, metric: str) -> DataFrame:
    placed = as_arrays(_assign_large(vectors, centroids, metric).where("cid is not null"))
    return _moved(centroids, mean_vectors(placed, "cid").withColumnRenamed("c", "mean"))


def _bucket_means(vectors: DataFrame, known: pa.Table, metric: str) -> DataFrame:
    """Mean vector per bucket; each task sends one sum per bucket it has met."""
    centers, numbers = matrix_of(known["c"]), KINDS[kind_of(vectors)]
    shared = vectors.sparkSession.sparkContext.broadcast(
        (known["cid"].to_numpy(), centers, prepared(centers, metric))
    )
    schema = "cid int, n bigint, total array<double>"
    out = pa.schema([
        ("cid", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.float64())),
    ])

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cids, centers, targets = shared.value
        counts, totals = np.zeros(len(cids), dtype=np.int64), np.zeros_like(centers)
        for batch in batches:
            batch, matrix = with_vectors(batch, "embedding", numbers)
            if not batch.num_rows:
                continue
            nearest_center = closest(prepared(matrix, metric), targets, metric)
            order = np.argsort(nearest_center, kind="stable")
            met, starts = np.unique(nearest_center[order], return_index=True)
            totals[met] += np.add.reduceat(matrix[order], starts, axis=0)
            counts += np.bincount(nearest_center, minlength=len(cids))
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cids[met], pa.int32()), pa.array(counts[met]),
             pa.array(list(totals[met]), pa.list_(pa.float64()))],
            schema=out,
        )

    sums = vectors.select("embedding").mapInArrow(add_up, schema)
    merged = sums.groupBy("cid").agg(
        F.sum("n").alias("n"),
        vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total"),
    )
    return merged.select("cid", F.transform("total", lambda x: x / F.col("n")).alias("mean"))


def digest(df: DataFrame, column: str) -> Column:
    """Tells different vectors apart."""
    return F.md5(column) if is_packed(df, column) else F.md5(F.col(column).cast("string").cast("binary"))


def _assign_large(collection: DataFrame, centroids: DataFrame, metric: str) -> DataFrame:
    """Buckets when the centroids are too many for one task.

    Each different vector is placed once and meets its rows by a digest, so that rows stay
    as many as they are, whatever their ids.
    """
    own = digest(collection, "embedding")
    different = collection.select(own.alias("qid"), F.col("embedding")).dropDuplicates(["qid"])
    different = as_arrays(different).withColumnRenamed("embedding", "qv")
    chosen = by_tiles(different, _as_items(centroids), k=1, metric=metric)
    found = chosen.select(F.col("qid").alias("_digest"), F.col("id").alias("cid"))
    return collection.withColumn("_digest", own).join(found, "_digest", "left").drop("_digest")


def assign_buckets(
    collection: DataFrame,
    centroids: DataFrame,
    metric: str = METRIC,
    small_rows: int = SMALL_SIDE_ROWS,
) -> DataFrame:
    """The collection with ``cid``, the bucket of each row's vector; null without one.

    Only the vectors travel to Python; the other columns stay where they are.
    """
    collection = collection.drop("cid")
    known = _small_centroids(centroids, small_rows)
    if known is None:
        return _assign_large(collection, centroids, metric)
    shared = collection.sparkSession.sparkContext.broadcast(
        (known["cid"].to_numpy(), prepared(matrix_of(known["c"]), metric))
    )
    numbers = KINDS[kind_of(collection)]

    def bucket(vectors: pa.Array) -> pa.Array:
        cids, targets = shared.value
        asked, matrix = with_vectors(numbered(vectors), "v", numbers)
        found = np.full(len(vectors), -1, dtype=np.int32)
        if asked.num_rows:
            rows = closest(prepared(matrix, metric), targets, metric)
            found[asked["row"].to_numpy()] = cids[rows]
        return pa.array(found, mask=found < 0)

    return collection.withColumn("cid", F.arrow_udf(bucket, "int")(F.col("embedding")))


def bucket_sizes(collection: DataFrame) -> DataFrame:
    return collection.groupBy("cid").agg(F.count("*").alias("n"))


def collection_stats(collection: DataFrame) -> DataFrame:
    """One row: rows, vector width, buckets, bytes of vector payload."""
    has_buckets = "cid" in collection.columns
    width = F.size("embedding")
    return collection.agg(
        F.count("*").alias("row_count"),
        F.max(width).cast("bigint").alias("dim"),
        (F.count_distinct("cid") if has_buckets else F.lit(0)).cast("bigint").alias("nlist"),
        (F.coalesce(F.sum(width), F.lit(0)) * 4).cast("bigint").alias("vector_bytes"),
    )


def probe(
    queries: DataFrame,
    centroids: DataFrame,
    nprobe: int = NPROBE,
    metric: str = METRIC,
    small_rows: int = SMALL_SIDE_ROWS,
) -> DataFrame:
    """``(qid, rk, cid, score)``: the nearest ``nprobe`` buckets of each query."""
    return nearest(
        queries, _as_items(centroids), nprobe, metric, small_rows=small_rows, items_first=True
    ).withColumnRenamed("id", "cid")


def _as_items(centroids: DataFrame) -> DataFrame:
    return centroids.select(F.col("cid").alias("id"), F.col("c").alias("embedding"))


def with_probes(
    queries: DataFrame,
    centroids: DataFrame,
    nprobe: int = NPROBE,
    metric: str = METRIC,
    small_rows: int = SMALL_SIDE_ROWS,
) -> DataFrame:
    """Each query row once per bucket to be scanned for it, the bucket in ``cid``."""
    items = _as_items(centroids)
    known = small_table(items, small_rows)
    if known is None:
        different = queries.select(digest(queries, "qv").alias("qid"), "qv").dropDuplicates(["qid"])
        probes = probe(different, centroids, nprobe, metric, small_rows)
        found = probes.select(F.col("qid").alias("_digest"), "cid")
        return queries.withColumn("_digest", digest(queries, "qv")).join(found, "_digest").drop("_digest")
    hits = nearest_in(F.col("qv"), known, items.schema["id"].dataType, nprobe, metric)
    return queries.withColumn("cid", F.explode(F.transform(hits, lambda h: h["id"])))
