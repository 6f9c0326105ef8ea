"""Near duplicates by SimHash, linked by meet-in-the-middle ball hashing.

A text's fingerprint has a bit for each that is set in over half of the XXH64 hashes of its word
shingles.  Fingerprints link at ``radius`` or fewer differing bits.  Each *different*
fingerprint emits every variant within half the radius; two fingerprints within the
radius share the one halfway between them, so shuffling on variants brings all of them
together.  All fingerprints that meet at a variant lie within half the radius of it,
thus within the radius of each other: linking each to the smallest there loses
no connection and forms no pairs, and a variant never gathers more fingerprints than
a ball holds, however many copies the texts have.  Links are deduplicated and verified by
counting differing bits, and components follow by alternating stars over fingerprints.
Copies only meet their fingerprint's component by an equi-join, which Spark splits when
hot.

Words are runs without blanks, A-Z lower-cased.  A text of fewer words than a shingle is one
shingle; without words (null too) its fingerprint is zero, which links like any other.
A component is named by its smallest doc_id; null doc_ids are members but never the name
unless they are alone.  Repeated rows are rows of their own.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from passagelake.llm.common import components, partitions, pieces, stored

BITS = 64


def shingle_hashes(text: bytes, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of the word shingles of a text, repeats included."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    last = ends[words - 1 :].tolist() or [len(line)]
    first = [0, *(ends[: len(last) - 1] + 1).tolist()]
    return np.array([xxh64_intdigest(line[a:b], seed) for a, b in zip(first, last, strict=True)], "<u8")


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of some 64-bit hashes."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits of a long text
        block = hashes[start : start + (1 << 16)]
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``(doc_id, tie, fp)`` of ``docs (doc_id, text)``: a hash of the text, and the
    fingerprint as a signed long."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                texts = pc.fill_null(part["text"].cast(pa.large_binary()), b"").to_pylist()
                found = np.array([majority(shingle_hashes(text, words)) for text in texts], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["tie"], pa.array(found.view(np.int64))], names=["doc_id", "tie", "fp"]
                )

    tied = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    return tied.mapInArrow(apply, "doc_id long, tie long, fp long")


def ball_masks(radius: int) -> list[int]:
    """All signed 64-bit masks of at most ``radius`` bits."""
    masks = (sum(1 << i for i in c) for n in range(radius + 1) for c in combinations(range(BITS), n))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """``(a, b)`` pairs of distinct ``fp`` within the radius that connect all such pairs."""
    if radius % 2:
        raise ValueError("the radius is twice what each fingerprint is varied by")
    masks = ball_masks(radius // 2)
    count = partitions(fps.sparkSession, fps.count() * len(masks), 2_000_000)
    variants = fps.select(
        "fp", F.explode(F.array(*map(F.lit, masks))).alias("mask")
    ).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant")).repartition(count, "variant")
    met = variants.withColumn("least", F.min("fp").over(Window.partitionBy("variant")))
    pairs = met.where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """``(doc_id, tie, fp, component_id, root)`` of ``docs (doc_id, text)``.

    ``tie`` is a hash of the text, which tells rows of one doc_id apart; ``root`` names a
    component even if none of its rows has a doc_id.
    """
    prints = stored(fingerprints(docs, words), "fingerprints")
    groups = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-groups")
    roots = components(links(groups.select("fp"), radius), "simhash-links")
    placed = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(names, "root").select("fp", "component_id", "root")
    return prints.join(named, "fp").select("doc_id", "tie", "fp", "component_id", "root")


def hex_fingerprint(column: str = "fp") -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
