"""The exact k nearest of many queries among many items, by bounds instead of all tiles.

Items lie in cells around centers, each with the radius of its farthest item. A query first meets the items of its
nearest cell; the k-th distance found there bounds what can still matter.  By the triangle
inequality a cell whose center is farther than that bound and the cell's radius together holds nothing
nearer, so the query goes on to the other cells only.  Cells meet queries by key, in tiles: an item
moves once for each tile of queries that its cell still meets, not for every tile of all.

The result is that of ``nearest``; how much is spared depends on how the vectors cluster.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from passagelake.config import METRIC, SMALL_SIDE_ROWS, TOP_K
from passagelake.operators.index import train_centroids
from passagelake.operators.nearest import arrow_schema, by_tiles, check_arguments, matrix_of, prepared, rank_hits, with_vectors
from passagelake.session import scratch_path, small_table
from passagelake.sources.tables import read_table, write_table

#: Distances are computed with an error below this share of the lengths involved.
SLACK = 1e-6
#: The cell of items of length zero: no angle tells where they are, so every query meets them.
NOWHERE = -1


def _geometry(centers: pa.Table, metric: str) -> tuple[np.ndarray, np.ndarray]:
    centers = centers.sort_by("cid")
    return centers["cid"].to_numpy(), prepared(matrix_of(centers["c"]), metric)


def _distances(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    squares = (vectors**2).sum(1)[:, None] + (centers**2).sum(1)[None, :] - 2 * vectors @ centers.T
    return np.sqrt(np.maximum(squares, 0))


def _with_cell(df: DataFrame, vector: str, centers: tuple, metric: str) -> DataFrame:
    """``df`` with its nearest ``cell`` and the distance to that center; rows without a vector go."""
    sent = df.sparkSession.sparkContext.broadcast(centers)
    schema = T.StructType([*df.schema, T.StructField("cell", T.IntegerType()), T.StructField("far", T.DoubleType())])
    out = arrow_schema(schema)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cids, places = sent.value
        for batch in batches:
            batch, matrix = with_vectors(batch, vector)
            if not batch.num_rows:
                continue
            matrix = prepared(matrix, metric)
            far = _distances(matrix, places)
            best = far.argmin(axis=1)
            cell = cids[best].astype(np.int32)
            if metric == "cosine":
                cell = np.where((matrix != 0).any(axis=1), cell, NOWHERE).astype(np.int32)
            columns = [*batch.columns, pa.array(cell), pa.array(far[np.arange(len(best)), best])]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    return df.mapInArrow(place, schema)


def _reached(queries: DataFrame, centers: tuple, radii: dict[int, float], metric: str) -> DataFrame:
    """``(qid, qv, cell)``: the cells beyond its own that may hold something within a query's ``bound``."""
    sent = queries.sparkSession.sparkContext.broadcast((*centers, radii))
    schema = T.StructType([*queries.select("qid", "qv").schema, T.StructField("cell", T.IntegerType())])
    out = arrow_schema(schema)

    def reach(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cids, places, radii = sent.value
        radius = np.array([radii.get(int(c), -np.inf) for c in cids])  # an empty cell is never reached
        for batch in batches:
            vectors = prepared(matrix_of(batch["qv"]), metric)
            far = _distances(vectors, places)
            bound = batch["bound"].to_numpy(zero_copy_only=False)
            slack = SLACK * (1 + np.abs(far))
            near = (far - radius[None, :] <= bound[:, None] + slack) & (cids[None, :] != batch["cell"].to_numpy()[:, None])
            row, at = np.nonzero(near)
            cells = cids[at]
            if NOWHERE in radii:
                row = np.concatenate([row, np.arange(batch.num_rows)])
                cells = np.concatenate([cells, np.full(batch.num_rows, NOWHERE)])
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch["qid"].take(take), batch["qv"].take(take), pa.array(cells.astype(np.int32))], schema=out
            )

    return queries.select("qid", "qv", "cell", "bound").mapInArrow(reach, schema)


def bounded_nearest(
    queries: DataFrame, items: DataFrame, k: int = TOP_K, metric: str = METRIC, centers: DataFrame | None = None,
    cells: int = 64,
) -> DataFrame:
    """``(qid, rk, id, score)``: exactly the ``k`` nearest ``items (id, embedding)`` of each of ``queries (qid, qv)``.

    ``centers (cid, c)`` are those of an index, or ``cells`` are trained.  Placed items and first hits
    are written to the shared folder, as both passes read them.  Rows of one ``qid`` are one query.
    """
    return _passes(queries, items, k, metric, centers, cells)[0]


def _passes(
    queries: DataFrame, items: DataFrame, k: int, metric: str, centers: DataFrame | None, cells: int
) -> tuple[DataFrame, DataFrame]:
    """The hits, and the queries by the cells that they met after their own."""
    check_arguments(k, metric)
    if metric == "ip":
        raise ValueError("inner products have no triangle inequality; use nearest")
    spark, folder = items.sparkSession, scratch_path(items.sparkSession, "bounded")
    if centers is None:
        centers = train_centroids(items, cells, metric=metric)
    known = small_table(centers.select("cid", "c"), SMALL_SIDE_ROWS)
    if known is None:
        raise ValueError(f"at most {SMALL_SIDE_ROWS} centers go to every task")
    where = _geometry(known, metric)
    placed = _with_cell(items.select("id", "embedding"), "embedding", where, metric)
    placed = read_table(spark, write_table(placed, f"{folder}/items"))
    found = placed.groupBy("cell").agg(F.max("far")).collect()  # one row a cell
    radii = {r[0]: r[1] for r in found}
    asked = _with_cell(queries.select("qid", "qv"), "qv", where, metric)
    asked = read_table(spark, write_table(asked, f"{folder}/queries"))
    # A query without direction is equally far from all: any cell will do to begin with.
    start = asked.withColumn("cell", F.when(F.col("cell") == NOWHERE, int(where[0][0])).otherwise(F.col("cell")))
    first = by_tiles(start, placed, k, metric, "cell")
    first = read_table(spark, write_table(first, f"{folder}/first"))
    kth = first.where(F.col("rk") == k).select(F.col("qid").alias("_qid"), F.col("score").alias("_kth"))
    distance = F.col("_kth") if metric == "l2" else F.sqrt(F.greatest(2 - 2 * F.col("_kth"), F.lit(0.0)))
    bound = F.coalesce(distance, F.lit(float("inf")))
    # Directions decide for cosine only if both have one; otherwise all cells stay in play.
    bound = F.when(asked["cell"] == NOWHERE, float("inf")).otherwise(bound)
    bounded = asked.join(kth, asked["qid"].eqNullSafe(kth["_qid"]), "left").select(
        "qid", "qv", F.when(asked["cell"] == NOWHERE, int(where[0][0])).otherwise(asked["cell"]).alias("cell"), bound.alias("bound")
    )
    further = read_table(spark, write_table(_reached(bounded, where, radii, metric), f"{folder}/further"))
    second = by_tiles(further, placed, k, metric, "cell")
    both = first.select("qid", "id", "score").union(second.select("qid", "id", "score"))
    return rank_hits(both, k, metric), further
