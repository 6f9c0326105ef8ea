"""Approximate nearest neighbours by a forest of random-projection trees.

* *Trees.*  A tree halves the vectors by random directions, at the median of a sample; all trees have
  one depth, so that a leaf has about ``leaf_rows`` rows of the table.  The trees are fitted on a
  sample of at most ``sample`` rows (those with the smallest hashes of their ids), but every row
  is in a leaf of every tree.
* *Search.*  A query enters all trees with one priority queue.  The branch that lies least far on
  the wrong side of a split (the farthest of the splits above it) is opened next, whatever its
  tree, until the wanted number of leaves is reached and some tree's leaves hold more than ``k`` rows.
* *How many leaves.*  Among the sample's rows, ``PROBES`` of them are searched exactly.  For each true
  neighbour the place of its first leaf in the query's order is known, so one histogram tells the
  recall for every number of leaves, and the smallest that reaches ``recall`` is taken.  The
  whole table is denser than its sample, which makes neighbours nearer and recall higher.
* *Reranking.*  Leaves are packed into groups of bounded size; a leaf with more rows (a third of all
  rows may be copies of one vector) is split over several.  Queries meet the groups of their
  leaves by key, in tiles, and a task keeps each query's ``k`` best candidates by exact inner
  products of the original vectors in double precision.  Only these are shuffled.

Broadcast are the trees and the leaves' sizes, bounded by ``sample``; rows, queries and candidates
are never gathered.  With fewer rows than a leaf holds, a single leaf makes the search exact.

Rows without an id, without a vector, of length zero, or with null or non-finite components take no part.
Rows that share an id are one item with several vectors, or one query: the best pair counts.  Ties go
to the smaller id.  Vectors of several widths are refused.  Empty tables give an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F


#: Rows of the sample that are searched exactly to see how many leaves the recall takes.
PROBES = 256
#: Rows of a tile of either side.
TILE_ROWS, TILE_QUERIES = 16_384, 16_384
#: Scores that are worked on at once.
BLOCK_SCORES = 1 << 21


def usable(rows: DataFrame) -> DataFrame:
    """``(id, vector)`` of the rows of ``(vec_id, embedding)`` that take part."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    some = F.exists(x, lambda v: v != 0)
    kept = rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite & some, F.lit(False)))
    return kept.select(F.col("vec_id").cast("long").alias("id"), x.alias("vector"))


def matrix_of(vectors: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(vectors) * width:
        raise ValueError(f"vectors don't all have {width} components")
    return flat.reshape(len(vectors), width)


# --- the forest ------------------------------------------------------------------


@dataclass
class Forest:
    """``planes[tree, node]`` and ``cuts[tree, node]``: node n has the children 2n + 1 and 2n + 2."""

    planes: np.ndarray
    cuts: np.ndarray
    depth: int

    @property
    def trees(self) -> int:
        return len(self.planes)

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def margins(self, vectors: np.ndarray) -> np.ndarray:
        """How far each vector lies above each split: ``[vector, tree, node]``."""
        flat = self.planes.reshape(-1, self.planes.shape[2])
        return (vectors @ flat.T).reshape(len(vectors), *self.cuts.shape) - self.cuts

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        above, each, tree = self.margins(vectors) > 0, np.arange(len(vectors))[:, None], np.arange(self.trees)
        node = np.zeros((len(vectors), self.trees), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + above[each, tree, node]
        return node - (self.leaves - 1)

    def distances(self, margins: np.ndarray) -> np.ndarray:
        """How far each leaf is for a query: ``[tree, leaf]``, of its ``margins[tree, node]``."""
        far = np.zeros((self.trees, 1))
        for level in range(self.depth):
            m = margins[:, (1 << level) - 1 : (1 << level + 1) - 1]
            sides = np.stack([np.maximum(m, 0), np.maximum(-m, 0)], axis=2)
            far = np.maximum(far[:, :, None], sides).reshape(self.trees, -1)
        return far

    def visit(self, margins: np.ndarray, wanted: int, sizes: np.ndarray, rows: int) -> list[int]:
        """The nearest leaves of all trees, numbered through, by one priority queue.

        ``margins[tree][node]`` are a query's.  At least ``wanted`` leaves are opened, and more until
        those of one tree hold ``rows`` rows by ``sizes``, or none is left.
        """
        inner, found, held = self.leaves - 1, [], [0] * self.trees
        queue = [(0.0, tree, 0) for tree in range(self.trees)]
        while queue and (len(found) < wanted or max(held) < rows):
            far, tree, node = heapq.heappop(queue)
            if node >= inner:
                leaf = tree * self.leaves + node - inner
                found.append(leaf)
                held[tree] += sizes[leaf]
                continue
            m = margins[tree][node]
            heapq.heappush(queue, (max(far, m), tree, 2 * node + 1))
            heapq.heappush(queue, (max(far, -m), tree, 2 * node + 2))
        return found


def fit(vectors: np.ndarray, trees: int, depth: int, seed: int = 42) -> Forest:
    """Trees that halve the vectors of a sample at the medians of random directions."""
    chooser, width = np.random.default_rng(seed), vectors.shape[1]
    nodes = (1 << depth) - 1
    planes = chooser.normal(size=(trees, nodes, width))
    planes /= np.maximum(np.sqrt((planes * planes).sum(axis=2, keepdims=True)), 1e-300)
    cuts = np.zeros((trees, nodes))
    for tree in range(trees):
        members = {0: np.arange(len(vectors))}
        for node in range(nodes):
            mine = members.pop(node)
            along = vectors[mine] @ planes[tree, node]
            cuts[tree, node] = np.median(along) if len(mine) else 0.0
            above = along > cuts[tree, node]
            members[2 * node + 1], members[2 * node + 2] = mine[~above], mine[above]
    return Forest(planes, cuts, depth)


def recall_curve(forest: Forest, vectors: np.ndarray, asked: np.ndarray, k: int) -> np.ndarray:
    """The recall among ``vectors`` for 1, 2, ... leaves, of the rows ``asked`` of them."""
    leaves = forest.leaves_of(vectors)
    total = forest.trees * forest.leaves
    hits, wanted = np.zeros(total, np.int64), 0
    for start in range(0, len(asked), 64):
        some = asked[start : start + 64]
        scores = vectors[some] @ vectors.T
        scores[np.arange(len(some)), some] = -np.inf
        near = np.argsort(-scores, axis=1)[:, : min(k, len(vectors) - 1)]
        for margins, best in zip(forest.margins(vectors[some]), near, strict=True):
            order = np.argsort(forest.distances(margins).reshape(-1), kind="stable")
            place = np.empty(total, np.int64)
            place[order] = np.arange(total)
            first = place.reshape(forest.trees, forest.leaves)[np.arange(forest.trees), leaves[best]].min(axis=1)
            np.add.at(hits, first, 1)
            wanted += len(best)
    return np.cumsum(hits) / max(1, wanted)


# --- reranking -------------------------------------------------------------------


class _Nearest:
    """The k best items of each query so far: larger inner products first, then smaller ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        # Rows of a query that repeats count together.
        self.known, self.owner = np.unique(ids, return_inverse=True)
        self.vectors, self.k = vectors, k
        self.floor = np.full(len(self.known), -np.inf)
        self.q, self.ids, self.scores = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    def offer(self, which: np.ndarray, ids: np.ndarray, items: np.ndarray) -> None:
        step = max(1, BLOCK_SCORES // max(1, len(items)))
        for start in range(0, len(which), step):
            self._offer(which[start : start + step], ids, items)

    def _offer(self, which: np.ndarray, ids: np.ndarray, items: np.ndarray) -> None:
        asked = self.vectors[which]
        scores = asked @ items.T
        scores[self.known[self.owner[which]][:, None] == ids] = -np.inf
        floor = self.floor[self.owner[which]]
        if len(ids) > self.k and len(np.unique(ids)) == len(ids):
            cut = len(ids) - self.k
            floor = np.maximum(floor, np.partition(scores, cut, axis=1)[:, cut])
        # Rounding differs between blocks: near the floor, exact sums decide.
        slack = 1e-12 * np.sqrt((asked * asked).sum(axis=1).max() * (items * items).sum(axis=1).max())
        row, column = np.nonzero((scores >= floor[:, None] - slack) & (scores > -np.inf))
        exact = (asked[row] * items[column]).sum(axis=1)
        q = np.concatenate([self.q, self.owner[which[row]]])
        found, exact = np.concatenate([self.ids, ids[column]]), np.concatenate([self.scores, exact])
        order = np.lexsort((-exact, found, q))
        q, found, exact = q[order], found[order], exact[order]
        fresh = np.ones(len(q), bool)  # an item counts once, with its best score
        fresh[1:] = (q[1:] != q[:-1]) | (found[1:] != found[:-1])
        q, found, exact = q[fresh], found[fresh], exact[fresh]
        order = np.lexsort((found, -exact, q))
        q, found, exact = q[order], found[order], exact[order]
        starts = np.flatnonzero(np.diff(q, prepend=-1))
        place = np.arange(len(q)) - np.repeat(starts, np.diff(starts, append=len(q)))
        last = place == self.k - 1
        self.floor[q[last]] = exact[last]
        kept = place < self.k
        self.q, self.ids, self.scores = q[kept], found[kept], exact[kept]


HITS = "query_id long, vec_id long, score double"


def _rerank(queries: pa.Table, rows: pa.Table, width: int, k: int) -> pa.Table:
    """The best of ``rows (leaf, id, vector)`` for ``queries (id, vector, leaves)`` that meet in a leaf."""
    asked = matrix_of(queries["vector"], width)
    best = _Nearest(queries["id"].to_numpy(), asked, k)
    lists = queries["leaves"].combine_chunks()
    query = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    visited = lists.flatten().to_numpy()
    leaf, ids, vectors = rows["leaf"].to_numpy(), rows["id"].to_numpy(), matrix_of(rows["vector"], width)
    order, by_query = np.argsort(leaf, kind="stable"), np.argsort(visited, kind="stable")
    for one in np.unique(leaf):
        mine = order[slice(*np.searchsorted(leaf[order], [one, one + 1]))]
        which = query[by_query[slice(*np.searchsorted(visited[by_query], [one, one + 1]))]]
        if len(which):
            best.offer(which, ids[mine], vectors[mine])
    return pa.table({"query_id": best.known[best.q], "vec_id": best.ids, "score": best.scores})


def _packed(sizes: np.ndarray, tile: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For each leaf its first group and how many it has, and the number of groups."""
    first, parts = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    group, filled = 0, 0
    for leaf, n in enumerate(sizes.tolist()):
        if n > tile or filled + n > tile:
            group, filled = group + (filled > 0), 0
        first[leaf] = group
        if n > tile:
            parts[leaf] = -(-n // tile)
            group += int(parts[leaf])
        else:
            filled += n
    return first, parts, group + 1


def search(
    rows: DataFrame, is_query: Column, k: int = 20, recall: float = 0.96, trees: int = 4, leaf_rows: int = 256,
    sample: int = 1 << 15,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: about the ``k`` nearest rows of ``rows (vec_id, embedding)`` by
    inner product for those of them that ``is_query`` tells, never the query itself."""
    spark = rows.sparkSession
    items = usable(rows)
    some = items.orderBy(F.xxhash64("id", F.lit(7)), "id").limit(sample).toArrow()
    result = "query_id long, rank int, vec_id long, score double"
    if not some.num_rows:
        return spark.createDataFrame([], result)
    width = len(some["vector"][0])
    known = matrix_of(some["vector"], width)
    total = items.count()
    depth = max(0, min((total // leaf_rows).bit_length() - 1, (some.num_rows // 32).bit_length() - 1))
    forest = fit(known, trees if depth else 1, depth)
    curve = recall_curve(forest, known, np.arange(min(PROBES, len(known))), k)
    wanted = int(np.searchsorted(curve, recall)) + 1
    # Plain arrays: classes of this package travel with functions, not with broadcasts.
    sent = spark.sparkContext.broadcast((forest.planes, forest.cuts, forest.depth))

    def in_leaves(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest(*sent.value)
        for batch in batches:
            step = max(1, BLOCK_SCORES // max(1, forest.cuts.size))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                leaves = forest.leaves_of(matrix_of(part["vector"], width)) + np.arange(forest.trees) * forest.leaves
                each = pa.array(np.repeat(np.arange(part.num_rows), forest.trees))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaves.reshape(-1)), part["id"].take(each), part["vector"].take(each)],
                    names=["leaf", "id", "vector"],
                )

    placed = items.mapInArrow(in_leaves, "leaf long, id long, vector array<double>")
    counted = placed.groupBy("leaf").agg(F.count("*").alias("n")).toArrow()  # one row a leaf
    sizes = np.zeros(forest.trees * forest.leaves, np.int64)
    sizes[counted["leaf"].to_numpy()] = counted["n"].to_numpy()
    first, parts, groups = _packed(sizes, TILE_ROWS)
    queries = usable(rows.where(is_query))
    tiles = -(-queries.count() // TILE_QUERIES) or 1
    seen = spark.sparkContext.broadcast((sizes.tolist(), first, parts))

    def asked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, (sizes, first, parts) = Forest(*sent.value), seen.value
        for batch in batches:
            step = max(1, BLOCK_SCORES // max(1, forest.cuts.size))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                at, group, leaves = [], [], []
                for i, margins in enumerate(forest.margins(matrix_of(part["vector"], width))):
                    visited = np.array(forest.visit(margins.tolist(), wanted, sizes, k + 1))
                    copies = parts[visited]
                    begin = np.repeat(np.cumsum(copies) - copies, copies)
                    mine = np.repeat(first[visited], copies) + np.arange(copies.sum()) - begin
                    leaf, order = np.repeat(visited, copies), np.argsort(mine, kind="stable")
                    edges = np.flatnonzero(np.diff(mine[order], prepend=-1))
                    at += [i] * len(edges)
                    group += mine[order][edges].tolist()
                    leaves += [x.tolist() for x in np.split(leaf[order], edges[1:])]
                rows = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(group, pa.int64()), part["id"].take(rows), part["vector"].take(rows),
                        pa.array(leaves, pa.list_(pa.int64())),
                    ],
                    names=["group", "id", "vector", "leaves"],
                )

    # Where a row of a split leaf goes is told by its id; leaves' groups are as many as leaves.
    of_leaf = spark.createDataFrame(
        [(i, int(g), int(p)) for i, (g, p) in enumerate(zip(first, parts, strict=True))], "leaf long, first long, parts long"
    )
    spread = F.pmod(F.xxhash64("id", F.lit(11)), F.col("parts"))
    left = placed.join(F.broadcast(of_leaf), "leaf").select(
        (F.col("first") + spread).alias("group"), F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"),
        "leaf", "id", "vector",
    )
    right = queries.mapInArrow(asked, "group long, id long, vector array<double>, leaves array<long>").select(
        "group", F.pmod(F.xxhash64("id", F.lit(13)), F.lit(tiles)).cast("int").alias("tile"), "id", "vector", "leaves"
    )

    def meet(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return _rerank(queries, rows, width, k)

    hits = left.groupBy("group", "tile").cogroup(right.groupBy("group", "tile")).applyInArrow(meet, HITS)
    once = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
