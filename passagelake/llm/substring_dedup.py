"""Removal of repeated passages by difference-cover anchors.

A window is ``WINDOW`` consecutive words of a document; a word is removed if a window that
covers it also starts in a document with a smaller doc_id.

* *Anchors.*  Hashing every window would shuffle every position.  Instead ``ANCHOR`` words are
  hashed at positions that are in the difference cover ``COVER`` modulo ``PERIOD``.  The
  cover's differences hit every remainder, so for any two positions some shift below
  ``PERIOD`` puts both on the cover: two equal windows share an aligned anchor within
  them (``WINDOW = ANCHOR + PERIOD - 1``).  Anchors of two or more documents are found by a
  shuffle of hashes, 3 positions in 7.
* *Extension.*  Around shared anchors only, all windows that hold the anchor are hashed
  whole (96 of 128 bits) and shuffled; for each the smallest doc_id is found.
* *Removal.*  Documents learn which of their windows start in a smaller one and lose
  the words these cover.

Documents are handled in blocks of ``BLOCK`` neighbouring ids.  A block sends an anchor
or window once, with the smallest doc_id and whether several documents of the block
have it, so a passage of a third of all documents is a row per block in the
shuffle.  Replies go to blocks, and meet the texts (compressed) by a shuffle in which each
task streams its blocks in order.  No pairs are formed.

The anchors' hashes only choose what is looked at; a false match costs work and changes
nothing.  Windows are equal if 96 bits of two independent hashes agree.

Null texts have no words.  A null doc_id is larger than any other, and documents
without one don't repeat each other.  Rows that repeat a doc_id are parts of one document as far as
windows go; each keeps its own words.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from passagelake.llm.common import Words, partitions, pieces, text_bytes

WINDOW, ANCHOR, PERIOD, COVER = 13, 7, 7, (0, 1, 3)
BLOCK = 512
NO_ID = np.iinfo(np.int64).max

#: Odd multipliers of the words of a window, for two hashes.
_FACTORS = np.random.default_rng(13).integers(0, 1 << 62, (2, WINDOW), np.uint64) * np.uint64(4) + np.uint64(1)
_FACTORS[1] += np.uint64(2)

ROWS = "part long, block long, data binary"
REPLIES = "block long, kind int, data binary"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class _Piece:
    """Some documents of a block: their words' hashes, one document after the other."""

    def __init__(self, doc_ids: np.ndarray, texts: pa.Array):
        self.doc_ids, self.words = doc_ids, Words(texts)
        self.starts = self.words.starts
        digests = b"".join(map(xxhash.xxh3_128_digest, self.words.vocabulary))
        self.hashes = np.frombuffer(digests, "<u8").reshape(-1, 2)[self.words.ids].T
        sizes = np.diff(self.starts)
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.place = np.arange(self.starts[-1]) - self.starts[self.owner]
        self.left = sizes[self.owner] - self.place  # words from a position to the end

    def hash_at(self, at: np.ndarray, size: int, which: int) -> np.ndarray:
        total = np.zeros(len(at), np.uint64)
        for t in range(size):
            total += self.hashes[which][at + t] * _FACTORS[which, t]
        return _mixed(total)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions of anchors and their hashes of 48 bits."""
        at = np.flatnonzero(np.isin(self.place % PERIOD, COVER) & (self.left >= ANCHOR))
        return at, self.hash_at(at, ANCHOR, 0) >> np.uint64(16)

    def ids_at(self, at: np.ndarray) -> np.ndarray:
        return self.doc_ids[self.owner[at]]


def _block_pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """A batch by block, each in pieces of bounded size."""
    blocks = batch["block"].to_numpy()
    order = np.argsort(blocks, kind="stable")
    cuts = np.flatnonzero(np.diff(blocks[order])) + 1
    for rows in np.split(order, cuts) if len(order) else []:
        for part in pieces(batch.take(pa.array(rows))):
            yield int(blocks[rows[0]]), part


def _loaded(part: pa.RecordBatch) -> _Piece:
    return _Piece(part["doc_id"].fill_null(NO_ID).to_numpy(), part["text"])


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts by keys (the last first), and where each run of equal ones begins."""
    order = np.lexsort(keys) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    if not len(order):
        return order, order
    new = np.zeros(len(order), bool)
    new[0] = True
    for key in keys:
        new[1:] |= np.diff(key[order]) != 0
    return order, np.flatnonzero(new)


def _packed(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(b"".join(a.tobytes() for a in arrays), 1)


def _unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    """Arrays of equal length from what ``_packed`` made."""
    data = zstandard.decompress(data)
    sizes = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(data) // sum(sizes), 0, []
    for kind, size in zip(kinds, sizes, strict=True):
        out.append(np.frombuffer(data, kind, n, at))
        at += n * size
    return out


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


def _by_part(high: np.ndarray, bits: int, parts: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted hashes of ``bits`` bits by the part they belong to."""
    part = (high >> np.uint64(max(0, bits - 32))) * np.uint64(parts) >> np.uint64(32)
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield int(part[a]), slice(a, b)


def _send_anchors(parts: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, part in _block_pieces(batch):
                piece = _loaded(part)
                at, hashes = piece.anchors()
                order, runs = _runs(hashes)
                if not len(runs):
                    continue
                ids = piece.ids_at(at)[order]
                several = np.minimum.reduceat(ids, runs) != np.maximum.reduceat(ids, runs)
                high = hashes[order][runs]
                yield _batch(ROWS, [
                    (p, block, _packed(high[s] << np.uint64(1) | several[s])) for p, s in _by_part(high, 48, parts)
                ])

    return apply


def _gathered(batches: Iterator[pa.RecordBatch], *kinds: str) -> tuple[list[int], np.ndarray, list[np.ndarray]]:
    """All rows of a part: blocks, the row that each entry came with, and the entries."""
    blocks, entries = [], []
    for batch in batches:
        blocks += batch["block"].to_pylist()
        entries += [_unpacked(d, *kinds) for d in batch["data"].to_pylist()]
    columns = [np.concatenate([e[i] for e in entries] or [np.empty(0, k)]) for i, k in enumerate(kinds)]
    return blocks, np.repeat(np.arange(len(blocks)), [len(e[0]) for e in entries]), columns


def _replies(blocks: list[int], rows: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Entries sent back to the blocks that their rows came from."""
    order = np.argsort(rows, kind="stable")
    bounds = np.searchsorted(rows[order], np.arange(len(blocks) + 1))
    found = [c[order] for c in columns]
    for first in range(0, len(blocks), 1000):
        yield _batch(REPLIES, [
            (blocks[i], 0, _packed(*(c[bounds[i] : bounds[i + 1]] for c in found)))
            for i in range(first, min(first + 1000, len(blocks))) if bounds[i] < bounds[i + 1]
        ])


def _shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks, rows, (entries,) = _gathered(batches, "<u8")
    hashes, several = entries >> np.uint64(1), entries & np.uint64(1)
    order, runs = _runs(hashes)
    if len(runs):
        sizes = np.diff(np.append(runs, len(order)))
        shared = (sizes > 1) | (np.maximum.reduceat(several[order], runs) > 0)
        mine = order[np.repeat(shared, sizes)]
        yield from _replies(blocks, rows[mine], hashes[mine])


def _smallest_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks, rows, (first, second, ids, several) = _gathered(batches, "<u8", "<u4", "<i8", "u1")
    order, runs = _runs(second, first)
    if len(runs):
        sizes = np.diff(np.append(runs, len(order)))
        least = np.repeat(np.minimum.reduceat(ids[order], runs), sizes)
        told = (least < ids[order]) | (several[order] > 0)
        yield from _replies(blocks, rows[order][told], first[order][told], least[told])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts on their way to their block."""
    for batch in batches:
        for block, part in _block_pieces(batch):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema) as out:
                out.write_batch(part)
            yield _batch(REPLIES, [(block, 1, zstandard.compress(sink.getvalue(), 1))])


def _streamed(batches: Iterator[pa.RecordBatch], *kinds: str) -> Iterator[tuple[int, list[np.ndarray], pa.RecordBatch]]:
    """Each piece of text with all replies to its block, which come before it."""
    now, replies, table = None, [], None
    for batch in batches:
        for row in batch.to_pylist():
            if row["block"] != now:
                now, replies, table = row["block"], [], None
            if row["kind"] == 0:
                replies.append(_unpacked(row["data"], *kinds))
            else:
                if table is None:
                    table = [np.concatenate([r[i] for r in replies] or [np.empty(0, k)]) for i, k in enumerate(kinds)]
                    replies = []
                for part in pa.ipc.open_stream(zstandard.decompress(row["data"])):
                    yield now, table, part


def _among(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each value is (or would be) in a sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def _send_windows(parts: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, (shared,), part in _streamed(batches, "<u8"):
            piece = _loaded(part)
            at, hashes = piece.anchors()
            at = at[_among(hashes, np.unique(shared))[1]]
            if not len(at):
                continue
            marks = np.zeros(len(piece.owner) + 1, np.int64)
            np.add.at(marks, np.maximum(at - (PERIOD - 1), 0), 1)
            np.add.at(marks, at + 1, -1)
            starts = np.flatnonzero((np.cumsum(marks[:-1]) > 0) & (piece.left >= WINDOW))
            first = piece.hash_at(starts, WINDOW, 0)
            second = (piece.hash_at(starts, WINDOW, 1) >> np.uint64(32)).astype("<u4")
            order, runs = _runs(second, first)
            if not len(runs):
                continue
            ids = piece.ids_at(starts)[order]
            least, most = np.minimum.reduceat(ids, runs), np.maximum.reduceat(ids, runs)
            first, second, several = first[order][runs], second[order][runs], (least != most).astype("u1")
            yield _batch(ROWS, [
                (p, block, _packed(first[s], second[s], least[s], several[s])) for p, s in _by_part(first, 64, parts)
            ])

    return apply


def _remove(with_text: bool):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = None, (np.empty(0, np.uint64), np.empty(0, np.int64))
        for block, (hashes, least), part in _streamed(batches, "<u8", "<i8"):
            if block != known:
                order, runs = _runs(hashes)
                table = (
                    (hashes[order][runs], np.minimum.reduceat(least[order], runs)) if len(runs) else (hashes, least)
                )
                known = block
            piece = _loaded(part)
            size = len(piece.owner)
            starts = np.flatnonzero(piece.left >= WINDOW)
            at, found = _among(piece.hash_at(starts, WINDOW, 0), table[0])
            starts, at = starts[found], at[found]
            starts = starts[table[1][at] < piece.ids_at(starts)]
            marks = np.zeros(size + WINDOW + 1, np.int64)
            marks[starts] += 1
            marks[starts + WINDOW] -= 1
            gone = np.cumsum(marks[:size]) > 0
            before = np.concatenate([[0], np.cumsum(gone)])
            removed = before[piece.starts[1:]] - before[piece.starts[:-1]]
            bounds = (piece.starts - before[piece.starts]).tolist()
            words = list(map(piece.words.vocabulary.__getitem__, piece.words.ids[~gone].tolist()))
            kept = [b" ".join(words[a:b]) for a, b in zip(bounds, bounds[1:])]
            columns = {
                "doc_id": part["doc_id"], "n_words": pa.array(np.diff(piece.starts)), "n_removed": pa.array(removed),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            }
            if with_text:
                columns["kept_text"] = pa.array([k.decode() for k in kept], pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return apply


def substring_dedup(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)``, and the ``kept_text`` if asked for."""
    count = partitions(docs.sparkSession, text_bytes(docs), 32 << 20)
    block = F.coalesce(F.floor(F.col("doc_id") / F.lit(BLOCK)), F.pmod(F.xxhash64("text"), F.lit(1 << 20)))
    rows = docs.select("doc_id", "text", block.cast("long").alias("block"))
    texts = rows.mapInArrow(_pack, REPLIES)

    def at_blocks(replies: DataFrame) -> DataFrame:
        return replies.union(texts).repartition(count, "block").sortWithinPartitions("block", "kind")

    def at_parts(sent: DataFrame) -> DataFrame:
        return sent.repartitionById(count, F.col("part").cast("int"))

    anchors = at_parts(rows.mapInArrow(_send_anchors(count), ROWS)).mapInArrow(_shared_anchors, REPLIES)
    windows = at_blocks(anchors).mapInArrow(_send_windows(count), ROWS)
    smallest = at_parts(windows).mapInArrow(_smallest_ids, REPLIES)
    result = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return at_blocks(smallest).mapInArrow(_remove(with_text), result)
