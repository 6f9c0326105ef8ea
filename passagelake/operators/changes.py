"""What a re-run has to do: rows compared by key and digest, vectors carried over by text.

A digest stands for a text.  What differs is found by joining keys and digests alone; texts and
vectors move only for rows that are new or changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from passagelake.session import broadcast_if_small

NEW, CHANGED, GONE, SAME = "new", "changed", "gone", "same"


def text_digest(text: Column | str) -> Column:
    """MD5 of a text; of a null none."""
    return F.md5((F.col(text) if isinstance(text, str) else text).cast("binary"))


def changes(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """``(key, change)``: what happened to each key between two tables ``(key, digest)``.

    A key that repeats in ``before`` counts as one with the least digest.
    """
    old = before.groupBy(key).agg(F.min("digest").alias("_old"))
    both = now.select(key, F.col("digest").alias("_new"), F.lit(True).alias("_now")).join(
        old.withColumn("_before", F.lit(True)), key, "full"
    )
    change = (
        F.when(F.col("_now").isNull(), GONE).when(F.col("_before").isNull(), NEW)
        .when(F.col("_new").eqNullSafe(F.col("_old")), SAME).otherwise(CHANGED)
    )
    return both.select(key, change.alias("change"))


def carry_vectors(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """``rows`` with the ``embedding`` that a stored row of the same text has, else null.

    Both have a ``digest`` of their text.  Only stored vectors of texts that ``rows`` hold move, one for
    each text, wherever it stood before.
    """
    wanted = broadcast_if_small(rows.select("digest").distinct())
    held = stored.where(F.col("embedding").isNotNull()).join(wanted, "digest", "left_semi")
    one = held.select("digest", "embedding").dropDuplicates(["digest"])
    return rows.drop("embedding").join(one, "digest", "left")


def without(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` but those whose key is among ``keys``."""
    return rows.join(broadcast_if_small(keys.select(key)), key, "left_anti").select(*rows.columns)
