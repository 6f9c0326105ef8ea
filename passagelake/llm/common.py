"""Helpers the operators share: words of a batch, stored intermediate tables, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from passagelake.session import scratch_path

#: The characters that separate words, and what texts are compared without.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"

#: Texts of a batch are worked on in pieces of about so many bytes.
PIECE_BYTES = 8 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_store(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder, and its path there; for tasks that write own formats."""
    if folder.startswith(("/", "file:")):
        return pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(folder)


def partitions(spark: SparkSession, size: int, each: int) -> int:
    """Shuffle partitions for ``size`` units of data, ``each`` in one, never fewer than set."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // each))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def pieces(batch: pa.RecordBatch, column: str = "text", size: int | None = None):
    """Slices of a batch whose texts hold about ``size`` bytes each (one row at least)."""
    size = size or PIECE_BYTES
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """Words of some texts: runs without ``BLANKS``; a null text has none.

    ``ids`` holds the words of all texts one after the other, as numbers into
    ``vocabulary`` (bytes); text i has ``ids[starts[i]:starts[i + 1]]``.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        # Lower-cased before the cast: a cast slice keeps offsets that ascii_lower misreads.
        texts = pc.fill_null((pc.ascii_lower(texts) if lower else texts).cast(pa.large_string()), "")
        lists = pc.ascii_split_whitespace(texts)
        flat = lists.flatten()
        full = pc.not_equal(flat, "")
        keep = full.to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(keep)])
        offsets = lists.offsets.to_numpy()
        self.starts = before[offsets - offsets[0]]
        coded = pc.dictionary_encode(flat.filter(full))
        self.ids = coded.indices.to_numpy()
        self.vocabulary = coded.dictionary.cast(pa.large_binary()).to_pylist()

    def __len__(self) -> int:
        return len(self.starts) - 1


def crc32_of(column: str) -> Column:
    """crc32 of a value written as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)``: the smallest node that each node of ``edges (a, b)`` can reach.

    Alternating large-star and small-star steps: every step joins a node's
    neighbours to the smallest among them, so the number of steps grows with the
    logarithm of the longest chain.  Stars are built by partial minima and joins,
    never by gathering a node's neighbours, so a node may have any number of them.
    Each step is written to the shared folder; it ends when no edge changes.
    """
    current = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b").distinct(), name,
    )
    while True:
        # Large star: neighbours above a node go to the smallest one around it.
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = (
            both.join(least, "a").where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        # Small star: a node and its lower neighbours go to the smallest of these.
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        following = stored(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(lowest.select("a", F.col("m").alias("b"))).distinct(), name,
        )
        changed = not following.exceptAll(current).isEmpty() or not current.exceptAll(following).isEmpty()
        current = following
        if not changed:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
