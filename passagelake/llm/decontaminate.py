"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks.

Texts and items are normalised (letters lower-cased, runs of anything but letters and digits a
blank) and cut into shingles of ``words`` words (an item of fewer words is one shingle).

* *Windows.*  A window has the size of an item.  It can only be similar to an item if it
  shares a shingle with it, so windows are laid where the text holds a shingle of an
  item, aligned as the item has it.  An item of fewer words than a shingle has windows where
  the text holds these words in a row.  Texts never leave the task that scans them; only
  these windows do, each different one once.
* *Fingerprints.*  A 64-bit SimHash of the shingles, weighted by how often they occur.
* *Candidates.*  A fingerprint is cut into ``blocks`` blocks.  If two differ in at most
  ``radius`` bits, some block differs in at most ``radius // blocks``; items are listed
  under every value within that distance of each block, so an equi-join on blocks
  finds all pairs within the radius.  Pairs farther apart are dropped.
* *Verification.*  The weighted Jaccard similarity of the shingles (the sum of the smaller
  counts over the sum of the larger ones) decides exactly.

Everything is DataFrame expressions.  Shingles of the items are broadcast only if they
are at most ``SMALL_SHINGLES``; beyond that the same join shuffles hashes.  A passage that many
documents hold is fingerprinted and verified once, and meets its documents by an
equi-join on the MD5 of the window.

Null and blank texts or items never match; null doc_ids may.  Repeated rows give one result
per doc_id and item; its window is the most similar one, then the first, then the shortest.  Repeated items are
items of their own.  Empty tables give an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from passagelake.llm.common import stored

SMALL_SHINGLES = 1 << 20
BITS = 64


def normal_words(text: Column) -> Column:
    """The normalised words of a text; none if it has no letter or digit."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingled(table: DataFrame, words: int) -> DataFrame:
    """``table`` with its array column ``parts`` exploded into ``place`` and ``shingle``, a hash."""
    shifted = [F.expr(f"slice(parts, {i + 1}, greatest(size(parts) - {words - 1}, 1))").alias(f"w{i}") for i in range(words)]
    rows = table.select("*", F.posexplode(F.arrays_zip(*shifted)).alias("place", "s")).where("s.w0 is not null")
    return rows.withColumn("shingle", F.xxhash64(*[f"s.w{i}" for i in range(words)])).drop("s")


def fingerprints(counts: DataFrame, key: str) -> DataFrame:
    """``(key, fp)`` from ``(key, shingle, n)``."""
    sums = [
        F.sum(F.when(F.getbit("shingle", F.lit(i)) == 1, F.col("n")).otherwise(-F.col("n"))).alias(f"b{i}")
        for i in range(BITS)
    ]
    bits = [F.when(F.col(f"b{i}") > 0, F.lit(1 << i if i < 63 else -(1 << 63))).otherwise(F.lit(0)) for i in range(BITS)]
    return counts.groupBy(key).agg(*sums).select(key, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fp"))


def _blocks(fp: Column, blocks: int) -> Column:
    """An array of ``(block number, value)`` as one number each."""
    size = BITS // blocks
    mask = F.lit((1 << size) - 1)
    return F.array(*[
        F.shiftrightunsigned(fp, i * size).bitwiseAND(mask) + F.lit(i << size) for i in range(blocks)
    ])


def near_pairs(windows: DataFrame, items: DataFrame, radius: int, blocks: int) -> DataFrame:
    """``(window, item)`` pairs of ``(window, fp)`` and ``(item, item_fp)`` within the radius."""
    size = BITS // blocks
    masks = windows.sparkSession.range(1 << size).where(F.bit_count("id") <= radius // blocks)
    masks = F.array(*[F.lit(r[0]) for r in masks.collect()])  # bounded by the size of a block
    listed = items.select("item", "item_fp", F.explode(_blocks(F.col("item_fp"), blocks)).alias("value"))
    listed = listed.select("item", "item_fp", F.explode(masks).alias("mask"), "value").select(
        "item", "item_fp", F.col("value").bitwiseXOR(F.col("mask")).alias("value")
    )
    asked = windows.select("window", "fp", F.explode(_blocks(F.col("fp"), blocks)).alias("value"))
    # The list is thousands of times its table's size, which Spark doesn't foresee: never broadcast.
    met = asked.join(listed.hint("merge"), "value").where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    return met.select("window", "item").distinct()


def contaminated(
    docs: DataFrame, items: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = 19, blocks: int = 4
) -> DataFrame:
    """``(doc_id, item_id, start, n_words, similarity)``: the windows of ``docs (doc_id, text)``
    that are similar to an item of ``items (item_id, text)``, one per document and item."""
    held = items.select("item_id", normal_words(F.col("text")).alias("parts")).where("size(parts) > 0").distinct()
    held = stored(
        held.withColumns({"size": F.size("parts"), "item": F.xxhash64("item_id", "parts")}), "items"
    )
    places = shingled(held.select("item", "size", "parts"), words).select("item", "size", "place", "shingle").distinct()
    item_counts = stored(places.groupBy("item", "shingle").agg(F.count("*").alias("n")), "item-shingles")
    # Where a text holds a shingle of an item, and so where the item's window would be.
    offsets = stored(places.select("shingle", F.col("place").alias("offset"), "size").distinct(), "item-places")
    if offsets.count() <= SMALL_SHINGLES:
        offsets = F.broadcast(offsets)
    texts = docs.select("doc_id", normal_words(F.col("text")).alias("parts")).where("size(parts) > 0")
    start = F.greatest(F.col("place") - F.col("offset"), F.lit(0)).alias("start")
    met = shingled(texts, words).join(offsets, "shingle")
    for size in [r[0] for r in held.where(F.col("size") < words).select("size").distinct().collect()]:
        met = met.union(shingled(texts, size).join(offsets.where(F.col("size") == size), "shingle"))
    found = met.select(
        "doc_id", start, F.expr("slice(parts, greatest(place - offset, 0) + 1, size + least(place - offset, 0))").alias("parts")
    )
    laid = stored(
        found.select("doc_id", "start", F.array_join("parts", " ").alias("line")).distinct()
        .withColumn("window", F.md5(F.col("line").cast("binary"))), "windows",
    )
    different = laid.select("window", "line").distinct().select("window", F.split("line", " ").alias("parts"))
    counts = stored(
        shingled(different, words).groupBy("window", "shingle").agg(F.count("*").alias("n")), "window-shingles"
    )
    pairs = near_pairs(
        fingerprints(counts, "window"), fingerprints(item_counts, "item").withColumnRenamed("fp", "item_fp"), radius, blocks
    )
    both = pairs.join(counts, "window").join(
        item_counts.select("item", "shingle", F.col("n").alias("m")), ["item", "shingle"]
    ).groupBy("window", "item").agg(F.sum(F.least("n", "m")).alias("common"))
    sizes = counts.groupBy("window").agg(F.sum("n").alias("window_total"))
    item_sizes = item_counts.groupBy("item").agg(F.sum("n").alias("item_total"))
    alike = F.col("common") / (F.col("window_total") + F.col("item_total") - F.col("common"))
    matched = both.join(sizes, "window").join(item_sizes, "item").select("window", "item", alike.alias("similarity"))
    matched = matched.where(F.col("similarity") >= similarity).join(held.select("item", "item_id"), "item")
    hits = laid.join(matched, "window")
    hits = hits.withColumn("n_words", F.size(F.split("line", " ")).cast("long"))
    best = F.max_by(
        F.struct("start", "n_words", "similarity"), F.struct("similarity", -F.col("start"), -F.col("n_words"))
    )
    return hits.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", F.col("best.start").cast("long").alias("start"), "best.n_words", "best.similarity"
    )
