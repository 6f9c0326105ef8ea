"""Mixing sources to target weights by a low-discrepancy schedule.

The words to take are cut into slots of ``block`` words.  Slot i is given to the
source whose share of the cumulative targets holds the i-th point of a golden-ratio
sequence on a grid of 2**31 points, so any run of slots has nearly its share of each
source.  A source's slots are ranked; slot r takes block r of the source's shuffled
stream, starting over after the last.  The stream is the source's documents in the
order of the MD5 of their ids, cut into blocks of equal words (the last may be shorter).

Targets: sources in the order of their code points (null last) weigh 5, 2, 1, 5, ...;
targets share out the size of all documents by weight, stop at ``most`` times
their source's size, and what is over goes to the others by weight until none is over.

Ranks and positions are prefix sums in two steps, over chunks and inside a chunk, and a
chunk is bounded however large its source is.  Only one number per source and chunk
meets in one task.  The schedule has no more than ``most`` rounds of a source, so no
document is taken more than ``most`` times its size.

Null or blank texts have size 0 and are never taken.  Rows that repeat a doc_id are
documents of their own for the sizes; what is taken of them is told by id, shared by
size.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from passagelake.llm.common import BLANKS, stored

WEIGHTS = (5, 2, 1)
GRID = 31
#: The golden ratio's fraction on the grid, made odd so that the sequence has full period.
GOLDEN = 1327217885
CHUNK_SLOTS = 1 << 16
CHUNK_DOCUMENTS = 1 << 10


def word_count(text: Column) -> Column:
    """Words of a text: runs without blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(rf"[^{BLANKS[0]}\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, most: int = 3, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``(source, number, source_size, n_docs, target)`` of ``sized (source, size)``."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    number = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weighed = sources.withColumn("number", number).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int")).cast("double")
    ).withColumn("top", (F.col("source_size") * most).cast("double"))
    # Sources reach their top in the order of top / weight; those before the first one
    # that stays below it have reached theirs, the rest share what is left by weight.
    order = Window.orderBy(F.col("top") / F.col("weight"), "number")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()).cast("double")
    share = (total - F.coalesce(F.sum("top").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    shared = weighed.withColumn("share", share).withColumn("full", F.col("top") <= F.col("share") * F.col("weight"))
    level = F.max(F.when(~F.col("full"), F.col("share"))).over(Window.partitionBy())
    return shared.select(
        "source", "number", "source_size", "n_docs",
        F.when(F.col("full"), F.col("top")).otherwise(F.col("weight") * level).alias("target"),
    )


def schedule(targets: DataFrame, slots: int) -> DataFrame:
    """``(number, block)`` for each of ``slots`` slots: a source and its next block."""
    spark = targets.sparkSession
    order = Window.orderBy("number")
    high = F.sum("target").over(order) / F.sum("target").over(Window.partitionBy())
    cuts = targets.withColumn("high", F.round(high * 2**GRID).cast("long"))
    cuts = cuts.withColumn("low", F.lag("high", 1, 0).over(order)).where("high > low")
    cell = GRID - 16  # points meet their source by the 2**16 cells that it touches
    cells = cuts.select(
        "number", "low", "high",
        F.explode(F.sequence(F.shiftright("low", cell), F.shiftright(F.col("high") - 1, cell))).alias("cell"),
    )
    if targets.count() <= 1 << 16:
        cells = F.broadcast(cells)
    point = F.pmod(F.pmod("id", F.lit(1 << GRID)) * F.lit(GOLDEN), F.lit(1 << GRID))
    points = spark.range(slots).withColumn("point", point).withColumn("cell", F.shiftright("point", cell))
    dealt = points.join(cells, "cell").where("low <= point and point < high").select(
        "id", "number", F.expr(f"id div {CHUNK_SLOTS}").alias("chunk")
    )
    counts = dealt.groupBy("number", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("number").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("number", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("number", "chunk").orderBy("id")) - 1
    return dealt.withColumn("rank", rank).join(counts, ["number", "chunk"]).select(
        "number", (F.col("base") + F.col("rank")).alias("block")
    )


def mix_sources(docs: DataFrame, most: int = 3, block: int | None = None) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` of ``docs (doc_id, text, source)``.

    ``block`` is the words of a block, by default a 512th of the smallest target above
    0, between 1 and 1024.
    """
    sized = stored(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes"
    )
    targets = stored(source_targets(sized, most), "targets")
    rows, total, least = targets.agg(
        F.sum("n_docs"), F.sum("source_size"), F.min(F.when(F.col("target") > 0, F.col("target")))
    ).first()
    block = block or max(1, min(1024, int((least or 0) // 512)))
    # Where each document begins in its source's stream.
    bits = max(0, ((rows or 0) // CHUNK_DOCUMENTS).bit_length())
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    streamed = sized.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "number", "source_size", "target", digest.alias("digest"),
        F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), 32 - bits).alias("chunk"),
    )
    sums = streamed.groupBy("number", "chunk").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("number").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("number", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("number", "chunk").orderBy("digest", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    start = F.col("base") + F.coalesce(F.col("inside"), F.lit(0))
    placed = streamed.withColumn("inside", F.sum("size").over(inside)).join(sums, ["number", "chunk"]).select(
        "doc_id", "source", "size", "number", "source_size", "target", start.alias("start")
    )
    # The blocks that each document meets in each round of its source's stream.
    rounds = placed.where("size > 0").select(
        "number", "start", "size",
        F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("round"), "source_size", "target",
    ).where("round * source_size <= target").select(
        "number", "start", (F.col("round") * F.col("source_size") + F.col("start")).alias("begin"), "size"
    ).withColumn("end", F.col("begin") + F.col("size"))
    spans = rounds.select(
        "number", "start", "begin", "end",
        F.explode(F.sequence(F.expr(f"begin div {block}"), F.expr(f"(end - 1) div {block}"))).alias("block"),
    )
    words = F.least("end", (F.col("block") + 1) * block) - F.greatest("begin", F.col("block") * block)
    taken = spans.join(schedule(targets, round((total or 0) / block)), ["number", "block"]).groupBy(
        "number", "start"
    ).agg(F.sum(words).alias("words"))
    return placed.join(taken, ["number", "start"], "left").select(
        "doc_id", "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.coalesce("words", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("taken"),
    )
