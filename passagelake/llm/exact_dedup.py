"""Exact deduplication by an extendible-hash index on shared files.

Texts are equal when they are identical without blanks (``common.BLANKS``).  The
index maps the 64-bit hash of such a text to the row that stays:

* *Directory.*  A slot is the top ``depth`` bits of a hash.  The directory doubles
  until no slot holds more than ``bucket_keys`` distinct hashes; slots that are not
  full without their last bits share a bucket of fewer bits.
* *Buckets.*  The directory sends texts to their buckets, and owner tasks hold ranges of
  these.  There texts of one hash form a chain with an entry for each different text, told
  apart by comparing whole bytes, so colliding hashes only lengthen a chain; and there
  the row that stays is chosen.
* *Lookup.*  A row's hash leads to its slot, the slot to its bucket, and hash and SHA-256 to the
  entry of the chain.

On their way copies are folded: partial aggregates, in ``FOLDS`` parts of a group, leave that many
rows of it for its owner, however many copies there are.  The lookup is an equi-join whose hot keys
Spark splits.  Row fingerprints, directory and index are tables in the shared folder; the driver sees
only how full the fullest slot is.

Null texts count as empty; empty and blank texts are equal to each other.  Of equal
texts the longest original stays, then the smallest doc_id (null ids come last).
Repeated rows are counted one by one; rows that share the doc_id that stays all have
``kept`` true.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from passagelake.llm.common import BLANKS, partitions, stored

#: Bits after which the directory stops doubling.
MAX_DEPTH = 40
#: Rows of a group of copies that reach its owner, at most.
FOLDS = 4


def without_blanks(text: Column) -> Column:
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", F.char_length(text).alias("length"), without_blanks(text).alias("body")
    ).withColumn("key", F.xxhash64("body"))


def _top(key: str, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def directory(keys: DataFrame, bucket_keys: int) -> tuple[DataFrame, int]:
    """``(slot, bucket, local_depth)`` for a table of distinct ``key``, and the depth.

    A bucket's name is its bits after a leading 1, which no two buckets share.
    """
    depth = max(0, (keys.count() // bucket_keys).bit_length() - 1)
    while True:
        slots = keys.groupBy(_top("key", depth).alias("slot")).agg(F.count("*").alias("n"))
        fullest = slots.agg(F.max("n")).first()[0] or 0
        if fullest <= bucket_keys or depth == MAX_DEPTH:
            break
        depth += 1
    level = slots.select("*", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("bits"))
    level = level.withColumn("prefix", F.expr(f"shiftright(slot, {depth} - bits)"))
    fill = level.groupBy("bits", "prefix").agg(F.sum("n").alias("keys"))
    fits = (F.col("keys") <= bucket_keys) | (F.col("bits") == depth)
    placed = level.join(fill, ["bits", "prefix"]).where(fits).groupBy("slot").agg(
        F.min("bits").cast("int").alias("local_depth")
    )
    name = F.expr(f"shiftleft(1L, local_depth) + shiftright(slot, {depth} - local_depth)")
    return placed.select("slot", name.alias("bucket"), "local_depth"), depth


def build_index(
    docs: DataFrame, fingerprints: DataFrame, bucket_keys: int = 1 << 15
) -> tuple[DataFrame, DataFrame, int]:
    """The index of ``docs``, ``(bucket, key, chain, sha, keep_id, group_size)``; its directory and depth."""
    spark = docs.sparkSession
    slots, depth = directory(fingerprints.select("key").distinct(), bucket_keys)
    slots = stored(slots, "directory")
    # Longest first, then smallest doc_id, as one number.
    rank = F.expr(
        f"cast(length as decimal(10, 0)) * {2**65}BD - coalesce(cast(doc_id as decimal(20, 0)), {2**64}BD)"
    )
    part = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).alias("part")
    folded = _keyed(docs).withColumn("rank", rank).groupBy("key", "body", part).agg(
        F.max_by("doc_id", "rank").alias("best"), F.max("rank").alias("rank"), F.count("*").alias("n")
    )
    owners = partitions(spark, slots.count() * bucket_keys, 1 << 20)
    routed = folded.withColumn("slot", _top("key", depth)).join(slots, "slot").repartitionByRange(owners, "bucket")
    # In the owner's range: equal bytes are one entry, different bytes of one hash follow in the chain.
    entries = routed.groupBy("bucket", "key", "body").agg(
        F.max_by("best", "rank").alias("keep_id"), F.sum("n").alias("group_size")
    )
    chain = F.row_number().over(Window.partitionBy("bucket", "key").orderBy("body"))
    sha = F.unhex(F.sha2("body", 256)).alias("sha")
    return stored(entries.select("bucket", "key", chain.alias("chain"), sha, "keep_id", "group_size"), "index"), slots, depth


def exact_dedup(docs: DataFrame, bucket_keys: int = 1 << 15) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` of ``docs (doc_id, text)``."""
    fingerprints = stored(
        _keyed(docs).select("doc_id", "key", F.unhex(F.sha2("body", 256)).alias("sha")), "fingerprints"
    )
    index, slots, depth = build_index(docs, fingerprints, bucket_keys)
    asked = fingerprints.withColumn("slot", _top("key", depth)).join(slots.select("slot", "bucket"), "slot")
    found = asked.join(index.drop("chain"), ["bucket", "key", "sha"])
    return found.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
