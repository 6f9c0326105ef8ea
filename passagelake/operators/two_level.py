"""A bucket index of two levels: coarse cells, and buckets trained inside each cell.

With ``nlist`` buckets in about ``sqrt(nlist)`` cells, a vector is compared with the cells' centers
and then with the buckets of its own cell only, so a pass over n vectors costs ``n * sqrt(nlist)``
comparisons instead of ``n * nlist``.  The vectors are shuffled once, by cell; a cell that
holds most of them is spread over tasks, which only send sums.

Buckets are numbered through their cells, so buckets of one cell are neighbours by number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from passagelake.config import METRIC, SMALL_SIDE_BYTES, SMALL_SIDE_ROWS, TOP_K
from passagelake.functions.packed import KINDS, as_arrays, as_bytes, is_packed, kind_of, unpack, width_of
from passagelake.operators.index import assign_buckets, digest, probe, suggested_nlist, train_centroids
from passagelake.operators.nearest import by_tiles, closest, matrix_of, numbered, prepared, with_vectors
from passagelake.session import broadcast_if_small, scratch_path, small_table
from passagelake.sources.tables import read_table, require, write_table


@dataclass
class TwoLevel:
    """``cells (cid, c)`` and ``buckets (cid, c, cell)``: centers of both levels.

    ``sizes`` tells ``(cid, rows)`` as the last pass of training met them, before its centers moved, if
    all rows of the collection were among them.
    """

    cells: DataFrame
    buckets: DataFrame
    sizes: list[tuple[int, int]] | None = None

    @classmethod
    def read(cls, spark: SparkSession, folder: str, step: str = "the index step") -> TwoLevel:
        return cls(*(require(spark, f"{folder}/{name}", step) for name in ("cells", "buckets")))

    def write(self, folder: str) -> TwoLevel:
        """Both tables in a folder, and the index that reads them there."""
        spark = self.cells.sparkSession
        for name in ("cells", "buckets"):
            write_table(getattr(self, name), f"{folder}/{name}")
        return TwoLevel.read(spark, folder)


def shape(nlist: int) -> tuple[int, int]:
    """How many cells, and how many buckets in each, make about ``nlist``."""
    cells = max(1, round(nlist**0.5))
    return cells, -(-nlist // cells)


def train_two_level(
    collection: DataFrame, nlist: int | None = None, iters: int = 2, metric: str = METRIC,
    small_rows: int = SMALL_SIDE_ROWS,
) -> TwoLevel:
    """Train both levels on the whole collection; ``nlist`` follows its row count if not given.

    Buckets of a cell start from its vectors whose ids have the lowest MD5.  A cell with
    fewer vectors than it may have buckets has as many as vectors.
    """
    spark = collection.sparkSession
    vectors = collection.select("id", "embedding").where((width_of(collection) > 0) & F.col("id").isNotNull())
    n_cells, inner = shape(nlist or suggested_nlist(vectors.count()))
    folder = scratch_path(spark, "two-level")
    cells = train_centroids(vectors, n_cells, iters, metric=metric, small_rows=small_rows)
    # The one shuffle of the vectors: tasks then meet few cells each, however crowded these are.
    kind = kind_of(vectors)
    if not is_packed(vectors):
        vectors = vectors.withColumn("embedding", F.col("embedding").cast(kind))
    placed = as_bytes(assign_buckets(vectors, cells, metric, small_rows))
    placed = placed.select("id", F.col("embedding").alias("packed"), F.col("cid").alias("cell"))
    by_cell = placed.hint("rebalance", "cell").sortWithinPartitions("cell")
    rows = read_table(spark, write_table(by_cell, f"{folder}/rows"))
    lowest = Window.partitionBy("cell").orderBy(F.md5(F.col("id").cast("string").cast("binary")), "id")
    ids = rows.select("cell", "id").distinct().withColumn("_n", F.row_number().over(lowest)).where(F.col("_n") <= inner)
    cid = (F.col("cell") * inner + F.col("_n") - 1).cast("int")
    # Stored, as looking whether they are small would sort all ids once more.
    chosen = write_table(ids.select("cell", "id", cid.alias("cid")), f"{folder}/seeds")
    chosen = broadcast_if_small(read_table(spark, chosen))
    seeds = rows.join(chosen, ["cell", "id"]).dropDuplicates(["cid"])
    buckets = seeds.select("cid", unpack(F.col("packed"), kind).cast("array<double>").alias("c"), "cell")
    first = rows.select(width_of(rows, "packed")).first()
    if max(n_cells, inner) > small_rows or 8 * n_cells * inner * (first[0] if first else 0) > SMALL_SIDE_BYTES:
        rows = rows.withColumn("embedding", unpack(F.col("packed"), kind))
        cells = read_table(spark, write_table(cells, f"{folder}/cells"))
        for n in range(iters):
            buckets = read_table(spark, write_table(buckets, f"{folder}/buckets-{n}"))
            placed = _assign_in_cells(rows, buckets, metric).where("cid is not null")
            mean = vector_to_array(Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>"))))
            means = placed.groupBy("cid").agg(mean.alias("mean"))
            buckets = buckets.join(means, "cid", "left").select("cid", F.coalesce("mean", "c").alias("c"), "cell")
        return TwoLevel(cells, read_table(spark, write_table(buckets, f"{folder}/buckets")))
    # Few centers are fetched after each pass, so that no pass is run again.
    known, sizes = buckets.toArrow().sort_by("cid"), None
    for _ in range(iters):
        moved = _means(rows, kind, known, metric).toArrow()
        means = dict(zip(moved["cid"].to_pylist(), moved["mean"].to_pylist(), strict=True))
        centers = [means.get(i, c) for i, c in zip(known["cid"].to_pylist(), known["c"].to_pylist(), strict=True)]
        known = known.set_column(1, "c", pa.array(centers, pa.list_(pa.float64())))
        sizes = list(zip(moved["cid"].to_pylist(), moved["n"].to_pylist(), strict=True))
    if sizes is not None and sum(n for _, n in sizes) != collection.count():
        sizes = None
    return TwoLevel(cells, spark.createDataFrame(known, "cid int, c array<double>, cell int"), sizes)


def _known(buckets: DataFrame, small_rows: int) -> pa.Table | None:
    """All buckets, if they are small: a vector is only compared with those of its cell, so that these
    count against the limit of rows, and all against that of bytes."""
    known = small_table(buckets.select("cid", "c", "cell"), small_rows)
    return None if known is None else known.sort_by("cid")


def _by_cell(known: pa.Table, metric: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per cell its buckets' numbers and centers."""
    cids, cells, centers = known["cid"].to_numpy(), known["cell"].to_numpy(), prepared(matrix_of(known["c"]), metric)
    return {int(c): (cids[cells == c], centers[cells == c]) for c in np.unique(cells)}


def _in_cells(matrix: np.ndarray, cells: np.ndarray, inside: dict, metric: str) -> np.ndarray:
    """The nearest bucket of each row among those of its cell."""
    found = np.full(len(matrix), -1, np.int32)
    for cell in np.unique(cells):
        cids, centers = inside[int(cell)]
        mine = np.flatnonzero(cells == cell)
        found[mine] = cids[closest(matrix[mine], centers, metric)]
    return found


def _means(rows: DataFrame, kind: str, known: pa.Table, metric: str) -> DataFrame:
    """``(cid, n, mean)`` of the rows ``(cell, packed)`` nearest to each bucket of their cell."""
    sent, numbers = rows.sparkSession.sparkContext.broadcast(_by_cell(known, metric)), KINDS[kind]

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, sums = sent.value, {}
        for batch in batches:
            batch, matrix = with_vectors(batch, "packed", numbers)
            if not batch.num_rows:
                continue
            found = _in_cells(prepared(matrix, metric), batch["cell"].to_numpy(), inside, metric)
            order = np.argsort(found, kind="stable")
            met, starts = np.unique(found[order], return_index=True)
            totals = np.add.reduceat(matrix[order], starts, axis=0)
            for cid, n, total in zip(met.tolist(), np.diff(starts, append=len(order)).tolist(), totals, strict=True):
                count, earlier = sums.get(cid, (0, 0.0))
                sums[cid] = count + n, earlier + total
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.int32()), pa.array([n for n, _ in sums.values()], pa.int64()),
                pa.array([t for _, t in sums.values()], pa.list_(pa.float64())),
            ],
            names=["cid", "n", "total"],
        )

    merged = rows.select("cell", "packed").mapInArrow(add_up, "cid int, n bigint, total array<double>")
    merged = merged.groupBy("cid").agg(
        F.sum("n").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total")
    )
    return merged.select("cid", "n", F.transform("total", lambda x: x / F.col("n")).alias("mean"))


def _assign_in_cells(rows: DataFrame, buckets: DataFrame, metric: str) -> DataFrame:
    """``rows`` with ``cid`` when the buckets are too many for one task: cells meet by key."""
    own = digest(rows, "embedding")
    different = rows.select(own.alias("qid"), "embedding", "cell").dropDuplicates(["qid"])
    different = as_arrays(different).withColumnRenamed("embedding", "qv")
    items = buckets.select(F.col("cid").alias("id"), F.col("c").alias("embedding"), "cell")
    found = by_tiles(different, items, 1, metric, "cell").select(F.col("qid").alias("_digest"), F.col("id").alias("cid"))
    return rows.withColumn("_digest", own).join(found, "_digest", "left").drop("_digest")


def assign_two_level(
    collection: DataFrame, index: TwoLevel, metric: str = METRIC, small_rows: int = SMALL_SIDE_ROWS
) -> DataFrame:
    """The collection with ``cid``: the nearest bucket of the cell nearest to each row's vector."""
    collection = collection.drop("cid")
    cells = small_table(index.cells.select("cid", "c"), small_rows)
    known = None if cells is None else _known(index.buckets, small_rows * cells.num_rows)
    if known is None:
        placed = assign_buckets(collection, index.cells, metric, small_rows).withColumnRenamed("cid", "cell")
        return _assign_in_cells(placed, index.buckets, metric).drop("cell")
    cells = cells.sort_by("cid")
    sent = collection.sparkSession.sparkContext.broadcast(
        (cells["cid"].to_numpy(), prepared(matrix_of(cells["c"]), metric), _by_cell(known, metric))
    )
    held_as = KINDS[kind_of(collection)]

    def bucket(vectors: pa.Array) -> pa.Array:
        numbers, centers, inside = sent.value
        asked, matrix = with_vectors(numbered(vectors), "v", held_as)
        found = np.full(len(vectors), -1, np.int32)
        if asked.num_rows:
            matrix = prepared(matrix, metric)
            mine = numbers[closest(matrix, centers, metric)]
            found[asked["row"].to_numpy()] = _in_cells(matrix, mine, inside, metric)
        return pa.array(found, mask=found < 0)

    return collection.withColumn("cid", F.arrow_udf(bucket, "int")(F.col("embedding")))


def assigned(collection: DataFrame, index: DataFrame | TwoLevel, metric: str = METRIC) -> DataFrame:
    """The collection with ``cid`` by the centers of one level or of two."""
    if isinstance(index, TwoLevel):
        return assign_two_level(collection, index, metric)
    return assign_buckets(collection, index, metric)


# --- how many buckets to look into --------------------------------------------------


def recall_curve(
    queries: DataFrame, exact: DataFrame, collection: DataFrame, buckets: DataFrame, k: int = TOP_K,
    metric: str = METRIC,
) -> DataFrame:
    """``(nprobe, found, expected, recall)`` for every number of probed buckets, in one pass.

    A true neighbour is found as soon as its bucket is looked into, so the place of its bucket in
    its query's order says from which ``nprobe`` on.  ``exact`` holds the true hits
    ``(qid, rk, id)``; the curve counts them by that place and adds up.
    """
    nlist = buckets.select("cid").count()
    wanted = exact.where(F.col("rk") <= k).select("qid", "id")
    placed = collection.select("id", "cid").join(broadcast_if_small(wanted), "id")
    order = probe(queries, buckets, nlist, metric).select("qid", "cid", "rk")
    place = placed.join(order, ["qid", "cid"]).groupBy(F.col("rk").alias("nprobe")).agg(F.count("*").alias("n"))
    every = collection.sparkSession.range(1, nlist + 1).select(F.col("id").cast("int").alias("nprobe"))
    up_to = Window.orderBy("nprobe")  # as many rows as there are buckets
    counted = every.join(place, "nprobe", "left").select(
        "nprobe", F.sum(F.coalesce("n", F.lit(0))).over(up_to).alias("found")
    )
    expected = wanted.agg(F.count("*")).scalar()
    share = F.col("found") / F.greatest("expected", F.lit(1))
    return counted.withColumn("expected", expected).withColumn("recall", share)


def smallest_nprobe(curve: DataFrame, recall: float) -> int:
    """The fewest buckets to look into for a recall, or all of them."""
    enough = curve.agg(F.min(F.when(F.col("recall") >= recall, F.col("nprobe"))), F.max("nprobe")).first()
    return enough[0] or enough[1] or 1
