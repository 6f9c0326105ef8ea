"""Table layouts and the checks a collection has to pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from passagelake.config import EMBED_DIM, MAX_LENGTHS
from passagelake.functions.vectors import has_dim

RAW_PAGE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

CLEAN_PAGE = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
])

CHUNK = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("slug", T.StringType()),
    T.StructField("chunk_idx", T.IntegerType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
])

COLLECTION_FIELDS = ["id", "url", "title", "text", "embedding"]
# Bookkeeping a collection may carry beside its declared fields.
SYSTEM_FIELDS = ["cid", "grp", "encoder_id"]

MESSAGES = T.ArrayType(T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
]))

HIT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("distance", T.DoubleType()),
    T.StructField("entity", T.StructType([
        T.StructField("text", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
    ])),
])


def check_fields(df: DataFrame) -> None:
    """Raise unless ``df`` has the declared fields and no other."""
    names = set(df.columns) - set(SYSTEM_FIELDS)
    missing = sorted(set(COLLECTION_FIELDS) - names)
    extra = sorted(names - set(COLLECTION_FIELDS))
    if missing or extra:
        raise ValueError(f"fields do not match the collection: missing {missing}, extra {extra}")


def row_violations(dim: int = EMBED_DIM) -> Column:
    """Array of the names of the rules a row breaks; empty for a good row."""
    rules = []
    for field, longest in MAX_LENGTHS.items():
        rules.append(F.when(F.col(field).isNull(), F.lit(f"{field}_missing")))
        rules.append(F.when(F.length(field) > longest, F.lit(f"{field}_too_long")))
    rules.append(F.when(~has_dim(F.col("embedding"), dim), F.lit("embedding_dim")))
    return F.array_compact(F.array(*rules))


def validate_schema(collection: DataFrame, dim: int = EMBED_DIM) -> DataFrame:
    """One row ``(id, rule)`` per broken rule."""
    check_fields(collection)
    return collection.select("id", F.explode(row_violations(dim)).alias("rule"))


def checked(collection: DataFrame, dim: int = EMBED_DIM) -> DataFrame:
    """The same rows; the job that reads them fails at the first bad one.

    The check rides along with the write, so the rows are read only once.
    """
    check_fields(collection)
    broken = row_violations(dim)
    message = F.concat(
        F.lit("row "), F.coalesce("id", F.lit("without id")), F.lit(" breaks "),
        F.array_join(broken, ", "),
    )
    verdict = F.when(F.size(broken) == 0, F.col("id")).otherwise(
        F.raise_error(message).cast("string")
    )
    return collection.withColumn("id", verdict)


def duplicate_keys(collection: DataFrame) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return collection.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
