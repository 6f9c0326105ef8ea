"""The k nearest items of each query vector, exactly, in one of three ways.

``queries`` is ``(qid, qv)`` and ``items`` is ``(id, embedding)``; with ``cell``
named, both have that column too and a query only meets items of its own cells.

* few queries: they go to every task, the items are read where they lie, each
  task keeps its best k per query, and only those are shuffled;
* few items: they go to every task and each query is answered in place;
* neither: both sides are cut into tiles of bounded size, each pair of tiles
  meets in one task, and again only the best k per query go further.

Pairs are never materialised: tasks multiply blocks of vectors.

All ways give the same answer.  Rows that share a ``qid`` (null is a value like others)
are one query with several vectors: an item counts once, with its best score.  Rows that
share an ``id`` are one item with several vectors.  Items without an id are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from passagelake.config import (
    METRIC,
    SCORE_DIGITS,
    SMALL_SIDE_ROWS,
    TILE_ITEMS,
    TILE_QUERIES,
    TOP_K,
)
from passagelake.functions.packed import joined
from passagelake.session import small_table
from passagelake.sources.grouped import in_groups

METRICS = ("cosine", "ip", "l2")

# Cells whose tile counts may be broadcast: three numbers each.
GRID_ROWS = 262_144

# Scores a task may keep for all queries together.
FEW_SCORES = 2_097_152

_BLOCK_SCORES = 2_000_000
_BLOCK_ROWS = 16_384
_SLACK = 1e-7


# --- inside a task -------------------------------------------------------------


def _lengths(vectors: pa.Array | pa.ChunkedArray, numbers: type) -> pa.Array | pa.ChunkedArray:
    """How many numbers each vector has, of arrays or of their bytes."""
    if pa.types.is_binary(vectors.type) or pa.types.is_large_binary(vectors.type):
        return pc.divide(pc.binary_length(vectors), numbers().itemsize)
    return pc.list_value_length(vectors)


def matrix_of(vectors: pa.Array | pa.ChunkedArray, numbers: type = np.float32) -> np.ndarray:
    """Rows of a list column, or of one of bytes of ``numbers``, as a matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if not len(vectors):
        return np.empty((0, 0))
    lengths = pc.min_max(_lengths(vectors, numbers)).as_py()
    if lengths["min"] != lengths["max"]:
        raise ValueError(f"vectors have {lengths['min']} to {lengths['max']} numbers")
    if pa.types.is_list(vectors.type) or pa.types.is_large_list(vectors.type):
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
    else:
        flat = np.frombuffer(joined(vectors), numbers)
    return flat.astype(np.float64).reshape(len(vectors), lengths["min"])


def with_vectors(rows, column: str, numbers: type = np.float32):
    """The rows of a batch or table that have a complete vector, and their matrix."""
    # Left to the task: a filter in the plan would compute derived vectors twice.
    filled = pc.fill_null(pc.greater(_lengths(rows[column], numbers), 0), False)
    if "id" in rows.schema.names:
        filled = pc.and_(filled, pc.is_valid(rows["id"]))
    if not pc.all(filled, min_count=0).as_py():
        rows = rows.filter(filled)
    matrix = matrix_of(rows[column], numbers)
    finite = np.isfinite(matrix).all(axis=1)
    if not finite.all():
        rows, matrix = rows.filter(pa.array(finite)), matrix[finite]
    return rows, matrix


def numbered(vectors: pa.Array) -> pa.Table:
    return pa.table({"row": pa.array(range(len(vectors)), pa.int64()), "v": vectors})


def _unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; rows without length stay zero."""
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    return matrix / np.where(norms == 0, 1.0, norms)[:, None]


def _closeness(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """All pairs, larger is nearer, up to rounding noise."""
    dots = a @ b.T
    if metric != "l2":
        return dots
    return 2 * dots - (a * a).sum(1)[:, None] - (b * b).sum(1)[None, :]


def _l2_pairs(a: np.ndarray, ia: np.ndarray, b: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """Distance of each chosen pair, free of the cancellation in the block form."""
    out = np.empty(len(ia))
    for start in range(0, len(ia), _BLOCK_ROWS):
        rows = slice(start, start + _BLOCK_ROWS)
        gap = a[ia[rows]] - b[ib[rows]]
        out[rows] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return out


def prepared(matrix: np.ndarray, metric: str) -> np.ndarray:
    return _unit(matrix) if metric == "cosine" else matrix


class _Best:
    """The k best ``(query, id, score)`` seen so far for each of some queries."""

    def __init__(self, queries: np.ndarray, k: int, metric: str):
        self.queries, self.k, self.metric = queries, k, metric
        # What a candidate has to reach: closeness, and for equals a lower id.
        self.floor = np.full(len(queries), -np.inf)
        self.floor_id = np.full(len(queries), None, dtype=object)
        self.rows = pd.DataFrame({"q": [], "id": np.array([], dtype=object), "score": []})

    def offer(self, ids: np.ndarray, items: np.ndarray, which: np.ndarray | None = None) -> None:
        which = np.arange(len(self.queries)) if which is None else which
        step = max(1, _BLOCK_SCORES // max(1, len(which)))
        for start in range(0, len(items), step):
            self._offer_block(ids[start : start + step], items[start : start + step], which)

    def _offer_block(self, ids: np.ndarray, items: np.ndarray, which: np.ndarray) -> None:
        near = _closeness(self.queries[which], items, self.metric)
        floor = self.floor[which]
        # The k-th best of a block bounds it only if the block has k different ids.
        if len(items) > self.k and np.isinf(floor).any() and pd.Index(ids).is_unique:
            cut = len(items) - self.k
            floor = np.maximum(floor, np.partition(near, cut, axis=1)[:, cut])
        # The slack lets every true candidate through; rounded scores decide.
        slack = _SLACK
        if self.metric == "l2":
            slack += 1e-12 * ((items * items).sum(1).max() + (self.queries * self.queries).sum(1).max())
        q, i = np.nonzero(near >= floor[:, None] - slack)
        if self.metric == "l2":
            score = np.round(_l2_pairs(self.queries, which[q], items, i), SCORE_DIGITS)
            reach = -score * score
        else:
            score = reach = np.round(near[q, i], SCORE_DIGITS)
        q = which[q]
        better = reach > self.floor[q]
        tied = np.flatnonzero(reach == self.floor[q])
        better[tied] = ids[i[tied]] < self.floor_id[q[tied]]
        if better.any():
            self._merge(pd.DataFrame({"q": q[better], "id": ids[i[better]], "score": score[better]}))

    def _merge(self, found: pd.DataFrame) -> None:
        rows = found if self.rows.empty else pd.concat([self.rows, found])
        rows = rows.sort_values(["q", "score", "id"], ascending=[True, self.metric == "l2", True])
        rows = rows.drop_duplicates(["q", "id"])
        place = rows.groupby("q").cumcount()
        self.rows = rows[place < self.k]
        last = rows[place == self.k - 1]
        q, worst = last["q"].to_numpy(dtype=int), last["score"].to_numpy()
        self.floor[q] = -worst * worst if self.metric == "l2" else worst
        self.floor_id[q] = last["id"].to_numpy()


def closest(vectors: np.ndarray, centers: np.ndarray, metric: str) -> np.ndarray:
    """Position of the nearest center of each vector, the lower one on a tie."""
    out = np.empty(len(vectors), dtype=np.int64)
    step = max(1, _BLOCK_SCORES // max(1, len(centers)))
    for start in range(0, len(vectors), step):
        near = _closeness(vectors[start : start + step], centers, metric)
        out[start : start + step] = np.argmax(np.round(near, SCORE_DIGITS), axis=1)
    return out


def _batch(schema: pa.Schema, qids, ids, scores) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.asarray(values), type=column.type)
            for values, column in zip((qids, ids, scores), schema)
        ],
        schema=schema,
    )


# --- plans ---------------------------------------------------------------------


def check_arguments(k: int, metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"metric is one of {METRICS}, not {metric!r}")
    if k < 1:
        raise ValueError("k is at least 1")


def _result_schema(queries: DataFrame, items: DataFrame) -> T.StructType:
    return T.StructType([
        T.StructField("qid", queries.schema["qid"].dataType),
        T.StructField("id", items.schema["id"].dataType),
        T.StructField("score", T.DoubleType()),
    ])


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def rank_hits(hits: DataFrame, k: int, metric: str = METRIC) -> DataFrame:
    """Best k per query as ``(qid, rk, id, score)``; ties go to the lower id."""
    order = F.col("score").asc() if metric == "l2" else F.col("score").desc()
    by_query = Window.partitionBy("qid").orderBy(order, "id")
    by_item = Window.partitionBy("qid", "id").orderBy(order)
    # One shuffle, by query, serves both windows.
    once = hits.repartition("qid").withColumn("n", F.row_number().over(by_item)).where("n = 1")
    return (
        once.withColumn("rk", F.row_number().over(by_query))
        .where(F.col("rk") <= k)
        .select("qid", "rk", "id", "score")
    )


def for_few_queries(
    known: pa.Table, queries: DataFrame, items: DataFrame, k: int, metric: str,
    cell: str | None = None, pairs: pa.Table | None = None,
) -> DataFrame:
    """Nearest items of the queries in ``known``, the fetched rows of ``queries``.

    Their cells are in ``known``, or in ``pairs``: ``(row, cell)`` by position in it.
    """
    schema = _result_schema(queries, items)
    known = known.append_column("_row", pa.array(range(known.num_rows), pa.int64()))
    if cell and pairs is None:
        pairs = known.select(["_row", cell])
    known, matrix = with_vectors(known, "qv")
    if not known.num_rows:
        return items.sparkSession.createDataFrame([], schema).select(
            "qid", F.lit(0).alias("rk"), "id", "score"
        )
    # A vector that a query has in several rows is scored once.
    places: dict[tuple, int] = {}
    keys = zip(known["qid"].to_pylist(), map(np.ndarray.tobytes, matrix))
    rows = np.array([places.setdefault(key, len(places)) for key in keys])
    first = np.unique(rows, return_index=True)[1]
    qids = np.array([qid for qid, _ in places] + [None], dtype=object)[:-1]
    vectors = prepared(matrix[first], metric)
    members = None
    if cell:
        at = dict(zip(known["_row"].to_pylist(), rows.tolist()))
        met = pd.Series([at.get(r, -1) for r in pairs[pairs.column_names[0]].to_pylist()])
        met = met[(met >= 0).to_numpy()]
        cells = pairs[cell].to_pandas()[met.index]
        members = {c: np.unique(g) for c, g in met.groupby(cells)}
        items = in_cells(items, pairs, cell)
    shared = items.sparkSession.sparkContext.broadcast((qids, vectors, members))
    out = arrow_schema(schema)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, vectors, members = shared.value
        best = _Best(vectors, k, metric)
        for batch in batches:
            batch, matrix = with_vectors(batch, "embedding")
            if not batch.num_rows:
                continue
            matrix = prepared(matrix, metric)
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            if members is None:
                best.offer(ids, matrix)
                continue
            cells = batch.column(cell).to_numpy(zero_copy_only=False)
            for c in np.unique(cells):
                rows = np.flatnonzero(cells == c)
                best.offer(ids[rows], matrix[rows], members[c])
        rows = best.rows
        yield _batch(out, qids[rows["q"].to_numpy(dtype=int)], rows["id"], rows["score"])

    columns = ["id", "embedding"] + ([cell] if cell else [])
    return rank_hits(items.select(*columns).mapInArrow(scan, schema), k, metric)


def in_cells(items: DataFrame, known: pa.Table, cell: str) -> DataFrame:
    """Only items of cells some query asks for; whole folders if stored by cell or group."""
    asked = known[cell].unique().to_pylist()
    return in_groups(items, asked).where(F.col(cell).isin(asked))


def nearest_in(
    vector: Column, known: pa.Table, id_type: T.DataType, k: int, metric: str = METRIC
) -> Column:
    """Expression: the k nearest rows of the small table ``known``, nearest first.

    ``known`` is ``(id, embedding)``; the result is an array of ``(id, score)``.
    """
    from pyspark.sql import SparkSession

    result = T.ArrayType(T.StructType([
        T.StructField("id", id_type), T.StructField("score", T.DoubleType()),
    ]))
    arrow_type = arrow_schema(T.StructType([T.StructField("hits", result)])).field(0).type
    known, matrix = with_vectors(known, "embedding")
    shared = SparkSession.active().sparkContext.broadcast(
        (known["id"].to_numpy(zero_copy_only=False), prepared(matrix, metric))
    )

    def answer(vectors: pa.Array) -> pa.Array:
        ids, items = shared.value
        asked, matrix = with_vectors(numbered(vectors), "v")
        counts = np.zeros(len(vectors), dtype=np.int64)
        best = _Best(prepared(matrix, metric), k, metric)
        if asked.num_rows and len(items):
            best.offer(ids, items)
            answered = asked["row"].to_numpy()[best.rows["q"].to_numpy(dtype=int)]
            counts = np.bincount(answered, minlength=len(vectors))
        rows = best.rows
        offsets = np.concatenate([[0], np.cumsum(counts)])
        hit_type = arrow_type.value_type
        hits = pa.StructArray.from_arrays(
            [pa.array(np.asarray(rows[f.name]), type=f.type) for f in hit_type], fields=list(hit_type)
        )
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), hits, type=arrow_type)

    return F.arrow_udf(answer, result)(vector)


def _few_items(
    queries: DataFrame, known: pa.Table, id_type: T.DataType, k: int, metric: str
) -> DataFrame:
    hits = nearest_in(F.col("qv"), known, id_type, k, metric)
    found = queries.select("qid", F.explode(hits).alias("hit"))
    return rank_hits(found.select("qid", "hit.id", "hit.score"), k, metric)


def by_tiles(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    metric: str,
    cell: str | None = None,
    tile_queries: int = TILE_QUERIES,
    tile_items: int = TILE_ITEMS,
) -> DataFrame:
    """Nearest items when both sides are large."""
    schema = _result_schema(queries, items)
    key = cell or "_cell"
    if not cell:
        queries, items = (df.withColumn(key, F.lit(0)) for df in (queries, items))
    queries = queries.select("qid", "qv", key)
    items = items.select("id", "embedding", key)

    def tiles(df: DataFrame, rows: int, name: str) -> DataFrame:
        return df.groupBy(key).agg(F.ceil(F.count("*") / rows).cast("int").alias(name))

    # One row per cell: how many tiles each side of it has.  A crowded cell just
    # has more tiles, so no task grows with it.
    grid = tiles(queries, tile_queries, "_nq").join(tiles(items, tile_items, "_ni"), key)
    counts = small_table(grid, GRID_ROWS)
    if counts is not None:
        grid = F.broadcast(items.sparkSession.createDataFrame(counts))

    def placed(df: DataFrame, own: str, other: str, ident: str, mine: str, theirs: str) -> DataFrame:
        vector = "qv" if ident == "qid" else "embedding"
        return df.join(grid, key).select(
            *df.columns,
            F.pmod(F.xxhash64(ident, vector), F.col(own)).cast("int").alias(mine),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(theirs),
        )

    left = placed(queries, "_nq", "_ni", "qid", "_tq", "_ti")
    right = placed(items, "_ni", "_nq", "id", "_ti", "_tq")
    out = arrow_schema(schema)

    def meet(q: pa.Table, i: pa.Table) -> pa.Table:
        q, asked = with_vectors(q, "qv")
        i, offered = with_vectors(i, "embedding")
        if not q.num_rows or not i.num_rows:
            return out.empty_table()
        best = _Best(prepared(asked, metric), k, metric)
        best.offer(i["id"].to_numpy(), prepared(offered, metric))
        rows = best.rows
        qids = np.array(q["qid"].to_pylist() + [None], dtype=object)[rows["q"].to_numpy(dtype=int)]
        return pa.Table.from_batches([_batch(out, qids, rows["id"], rows["score"])])

    grouped = left.groupBy(key, "_tq", "_ti").cogroup(right.groupBy(key, "_tq", "_ti"))
    return rank_hits(grouped.applyInArrow(meet, schema), k, metric)


def nearest(
    queries: DataFrame,
    items: DataFrame,
    k: int = TOP_K,
    metric: str = METRIC,
    cell: str | None = None,
    small_rows: int = SMALL_SIDE_ROWS,
    tile_queries: int = TILE_QUERIES,
    tile_items: int = TILE_ITEMS,
    items_first: bool = False,
) -> DataFrame:
    """``(qid, rk, id, score)``: the ``k`` nearest items of each query.

    ``items_first`` says that the items are expected to be the few, as centroids
    are.  Vectors that are null or empty are left out on either side.  The sides are
    measured, by jobs of their own, while the plan is built.
    """
    check_arguments(k, metric)
    if items_first and not cell:
        known = small_table(items.select("id", "embedding"), small_rows)
        if known is not None:
            return _few_items(queries, known, items.schema["id"].dataType, k, metric)
    known = small_table(queries.select("qid", "qv", *([cell] if cell else [])), small_rows)
    if known is not None and known.num_rows * k <= FEW_SCORES:
        return for_few_queries(known, queries, items, k, metric, cell)
    return by_tiles(queries, items, k, metric, cell, tile_queries, tile_items)
