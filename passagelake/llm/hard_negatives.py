"""Hard negatives: rows of another label that score just below an anchor's positives.

An anchor's positives are its best rows of the same label; a positive opens a window of scores,
``low`` to ``high`` hundredths of its own, and its negatives are the best rows of other labels
inside.  Scores are inner products of whole numbers, ``floor(scale * x)``, so they are exact.

* *Scoring.*  Anchors meet all rows in blocks: tasks multiply matrices.  Few anchors go to every
  task and rows are read in place; beyond ``SMALL_ANCHORS`` rows or bytes both sides are
  cut into tiles of bounded size, by hash, that meet by key, whatever a label's share of all rows.
* *Before the shuffle.*  Anchors meet all rows twice.  First a task keeps each anchor's best rows of
  its label.  When the positives are known, and so the windows, a task keeps the best rows of each
  window.  What it leaves out is beaten by enough rows of its own, so the result is whole.
* *Secondary sort.*  Scores of positives and negatives are packed into binary keys (anchor,
  descending score, positives first, id), dealt by anchor and sorted inside partitions: one
  shuffle, the DataFrame form of repartitionAndSortWithinPartitions.  A stream over the sorted
  keys opens a window at each positive and emits negatives until it is full; it holds
  the open windows of one anchor, never its rows.

Rows without id or label, without a vector or with a null or non-finite component take no part;
nor do anchors or rows meet rows of another width.  Rows that share an id are rows of their own, but
never positives of each other; an anchor in several rows is mined for each.  Ties go to the smaller
id.  Empty tables give an empty result.  Other columns are ignored.  Scores beyond 2**53 are refused.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from passagelake.llm.common import stored
from passagelake.session import small_table

#: Anchors that are sent whole to every task: rows, and bytes of their vectors.
SMALL_ANCHORS, SMALL_BYTES = 8_192, 32 << 20
#: Rows of a tile of either side.
TILE = 8_192
#: Scores that are worked on at once.
BLOCK_SCORES = 1 << 21
EXACT = 2.0**53
LEAST = np.iinfo(np.int64).min


def whole_numbers(rows: DataFrame, scale: int = 256) -> DataFrame:
    """``(vec_id, label, vector, width)`` of the rows that take part, of ``(vec_id, label, embedding)``."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
    return kept.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(v * scale).cast("double")).alias("vector"), F.size(x).alias("width"),
    )


# --- inside a task ---------------------------------------------------------------


@dataclass
class Anchors:
    """Anchors of one width; ``number`` tells them apart, ``low`` and ``high`` are their windows."""

    number: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, table: pa.Table, windows: int) -> dict[int, Anchors]:
        """By width, from ``(anchor, vec_id, label, vector, width)`` and, with windows, ``scores``."""
        out = {}
        widths = table["width"].to_numpy()
        for width in np.unique(widths):
            part = table.filter(pa.array(widths == width))
            low, high = np.full((2, part.num_rows, windows), -1, np.int64)
            low += 1  # empty, as no score is 0 or more and -1 or less
            for i, scores in enumerate(part["scores"].to_pylist() if windows else []):
                for j, p in enumerate(scores):
                    low[i, j], high[i, j] = -(-p[0] // 100), p[1] // 100
            out[int(width)] = cls(
                part["anchor"].to_numpy(), part["vec_id"].to_numpy(), part["label"].to_numpy(),
                _matrix(part["vector"], int(width)), low, high,
            )
        return out


def _matrix(vectors: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), width)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of whole vectors, as whole numbers."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most > EXACT:
        # Each component's own products bound the sums more tightly.
        if (np.abs(a) @ np.abs(b).T).max(initial=0) > EXACT:
            raise ValueError("scores beyond 2**53 are not exact")
    return (a @ b.T).astype(np.int64)


class _Best:
    """The ``k`` best rows of each of some groups: higher scores first, then smaller ids."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.floor = np.full(groups, LEAST)
        self.group, self.score, self.ids = np.empty((3, 0), np.int64)

    def offer(self, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, groups: np.ndarray) -> None:
        """Row i of ``scores`` belongs to group ``groups[i]``."""
        floor = self.floor[groups]
        if scores.shape[1] > self.k:
            cut = scores.shape[1] - self.k
            held = np.where(allowed, scores, LEAST)
            floor = np.maximum(floor, np.partition(held, cut, axis=1)[:, cut])
        row, column = np.nonzero(allowed & (scores >= floor[:, None]))
        if not len(row):
            return
        group = np.concatenate([self.group, groups[row]])
        score = np.concatenate([self.score, scores[row, column]])
        found = np.concatenate([self.ids, ids[column]])
        order = np.lexsort((found, -score, group))
        group, score, found = group[order], score[order], found[order]
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        place = np.arange(len(group)) - np.repeat(starts, np.diff(starts, append=len(group)))
        last = place == self.k - 1
        self.floor[group[last]] = score[last]
        kept = place < self.k
        self.group, self.score, self.ids = group[kept], score[kept], found[kept]


def _blocks(table: pa.Table | pa.RecordBatch, width: int, anchors: int) -> Iterator[tuple]:
    """``(ids, labels, vectors)`` of the rows of one width, so many that the scores fit."""
    part = table.filter(pc.equal(table["width"], width))
    step = max(1, BLOCK_SCORES // max(1, anchors))
    for start in range(0, part.num_rows, step):
        some = part.slice(start, step)
        yield some["vec_id"].to_numpy(), some["label"].to_numpy(), _matrix(some["vector"], width)


class Positives:
    """The best rows of each anchor's label."""

    def __init__(self, by_width: dict[int, Anchors], k: int):
        self.by_width = by_width
        self.best = {w: _Best(len(a.ids), k) for w, a in by_width.items()}

    def add(self, rows: pa.Table | pa.RecordBatch) -> None:
        for width, a in self.by_width.items():
            for ids, labels, vectors in _blocks(rows, width, len(a.ids)):
                allowed = (a.labels[:, None] == labels) & (a.ids[:, None] != ids)
                self.best[width].offer(exact_products(a.vectors, vectors), allowed, ids, np.arange(len(a.ids)))

    def found(self) -> Iterator[tuple]:
        for width, best in self.best.items():
            yield self.by_width[width].number[best.group], best.score, best.ids


class Negatives(Positives):
    """The best rows of other labels inside each window."""

    def __init__(self, by_width: dict[int, Anchors], k: int):
        self.by_width = by_width
        self.best = {w: _Best(a.low.size, k) for w, a in by_width.items()}

    def add(self, rows: pa.Table | pa.RecordBatch) -> None:
        for width, a in self.by_width.items():
            for ids, labels, vectors in _blocks(rows, width, len(a.ids)):
                scores = exact_products(a.vectors, vectors)
                other = a.labels[:, None] != labels
                for j in range(a.low.shape[1]):
                    some = np.flatnonzero(a.low[:, j] <= a.high[:, j])
                    if len(some):
                        s = scores[some]
                        allowed = other[some] & (s >= a.low[some, j, None]) & (s <= a.high[some, j, None])
                        self.best[width].offer(s, allowed, ids, some * a.low.shape[1] + j)

    def found(self) -> Iterator[tuple]:
        for width, best in self.best.items():
            a = self.by_width[width]
            anchor, score, ids = a.number[best.group // max(1, a.low.shape[1])], best.score, best.ids
            # A row may be in several windows of an anchor: it is told by the first of them.
            order = np.lexsort((best.group, ids, score, anchor))
            whole, window = np.stack([anchor, score, ids])[:, order], best.group[order]
            starts = np.flatnonzero((np.diff(whole, axis=1, prepend=LEAST) != 0).any(axis=0))
            first = np.repeat(window[starts], np.diff(starts, append=len(order)))
            yield tuple(whole[:, window == first])


FOUND = "anchor long, score long, id long"


def _found(kept: Positives) -> Iterator[pa.RecordBatch]:
    for columns in kept.found():
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "score", "id"])


def meet(anchors: DataFrame, rows: DataFrame, kind: type[Positives], k: int, windows: int = 0) -> DataFrame:
    """``(anchor, score, id)``: what each task keeps of the rows for each anchor."""
    known = small_table(anchors, SMALL_ANCHORS, SMALL_BYTES)
    if known is not None:
        sent = rows.sparkSession.sparkContext.broadcast(known)

        def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept = kind(Anchors.of(sent.value, windows), k)
            for batch in batches:
                kept.add(batch)
            yield from _found(kept)

        return rows.mapInArrow(scan, FOUND)

    def tiled(df: DataFrame, key: str, name: str, tiles: int, other: str, others: int) -> DataFrame:
        mine = F.pmod(F.xxhash64(key, "vector"), F.lit(tiles)).alias(name)
        return df.select("*", mine, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    tiles = [-(-df.count() // TILE) or 1 for df in (anchors, rows)]
    left = tiled(anchors, "anchor", "ta", tiles[0], "tr", tiles[1])
    # Rows repeat with one id and vector at most as often as the table repeats them.
    right = tiled(rows, "vec_id", "tr", tiles[1], "ta", tiles[0])

    def tile(a: pa.Table, b: pa.Table) -> pa.Table:
        kept = kind(Anchors.of(a, windows), k)
        kept.add(b.combine_chunks())
        return pa.Table.from_batches(list(_found(kept)), pa.schema([(n, pa.int64()) for n in ("anchor", "score", "id")]))

    return left.groupBy("ta", "tr").cogroup(right.groupBy("ta", "tr")).applyInArrow(tile, FOUND)


# --- the secondary sort ------------------------------------------------------------

POSITIVE, NEGATIVE = 0, 1
KEY = ">QQBQ"
SIGN = 1 << 63


def packed(anchor: Column, score: Column, kind: Column, number: Column) -> Column:
    """A binary key that sorts by anchor, falling score, kind and id."""

    def ordered(c: Column) -> Column:  # eight bytes, negative numbers first
        return F.unhex(F.lpad(F.hex(c.cast("long").bitwiseXOR(F.lit(-SIGN))), 16, "0"))

    return F.concat(ordered(anchor), ordered(F.bitwise_not(score)), F.unhex(F.lpad(F.hex(kind), 2, "0")), ordered(number))


def unpacked(key: bytes) -> tuple[int, int, int, int]:
    """``(anchor, score, kind, id)`` of a packed key."""
    anchor, score, kind, number = struct.unpack(KEY, key)
    return anchor - SIGN, ~(score - SIGN), kind, number - SIGN


def mined(keys: Iterable[bytes], negatives: int, low: int, high: int) -> Iterator[tuple]:
    """``(anchor, positive, rank, negative, positive score, negative score)`` of sorted keys."""
    current, windows = None, []
    for key in keys:
        anchor, score, kind, number = unpacked(key)
        if anchor != current:
            current, windows = anchor, []
        if kind == POSITIVE:
            windows.append([score, number, 0])
            continue
        for window in windows:
            p, positive, n = window
            if low * p <= 100 * score <= high * p:
                window[2] = n = n + 1
                yield anchor, positive, n, number, p, score
        # Full windows and those that all further scores are below are closed.
        windows = [w for w in windows if w[2] < negatives and 100 * score >= low * w[0]]


MINED = (
    "anchor long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


def _stream(negatives: int, low: int, high: int) -> Callable:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = [f.split()[0] for f in MINED.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for row in mined((k for b in batches for k in b["key"].to_pylist()), negatives, low, high):
            out.append(row)
            if len(out) == 10_000:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    return stream


def hard_negatives(
    rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    scale: int = 256,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of
    ``rows (vec_id, label, embedding)``; ``anchor`` tells which of them are anchors."""
    if not 0 < low <= high:
        raise ValueError("a window lies between two positive shares")
    every = stored(whole_numbers(rows, scale), "whole-vectors")
    # Numbered by a hash of the row, as a table may repeat ids.
    asked = every.where(anchor).distinct()
    asked = stored(asked.withColumn("anchor", F.xxhash64("vec_id", "label", "vector")), "anchors")
    same = meet(asked, every, Positives, positives)
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id"))
    best = stored(same.withColumn("place", place).where(F.col("place") <= positives).drop("place"), "positives")
    bounds = F.array(F.col("score") * low, F.col("score") * high)
    windows = best.groupBy("anchor").agg(F.collect_list(bounds).alias("scores"))  # at most ``positives`` each
    opened = stored(asked.join(windows, "anchor"), "windows")
    other = meet(opened, every, Negatives, negatives, positives)
    keys = best.select("anchor", packed(F.col("anchor"), F.col("score"), F.lit(POSITIVE), F.col("id")).alias("key")).union(
        other.select("anchor", packed(F.col("anchor"), F.col("score"), F.lit(NEGATIVE), F.col("id")).alias("key"))
    )
    sorted_ = keys.repartition("anchor").sortWithinPartitions("key").select("key")
    found = sorted_.mapInArrow(_stream(negatives, low, high), MINED)
    return found.join(asked.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
