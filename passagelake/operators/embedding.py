"""Vectors for texts: a pluggable batch encoder, or hashing as a stand-in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from passagelake.config import EMBED_BATCH, EMBED_DIM
from passagelake.functions.vectors import has_dim
from passagelake.operators.batching import call_in_batches
from passagelake.operators.hashing import token_text, unit_counts

Encoder = Callable[[list[str]], "list[list[float]] | np.ndarray"]

_ENCODER_KEY = "encoder_id"


def hashing_id(dim: int = EMBED_DIM) -> str:
    return f"hashing-md5-{dim}"


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def token_bucket(token: Column, dim: int) -> Column:
    digest = F.conv(F.substring(F.md5(token), 1, 8), 16, 10)
    return digest.cast("bigint") % dim


def marked(vector: Column, encoder_id: str, dim: int) -> Column:
    """Name the encoder in the column's metadata, which files keep."""
    return vector.alias("embedding", metadata={_ENCODER_KEY: encoder_id, "dim": dim})


def encoder_of(df: DataFrame, column: str) -> str | None:
    return df.schema[column].metadata.get(_ENCODER_KEY)


def check_same_encoder(queries: DataFrame, collection: DataFrame) -> None:
    """Vectors of different encoders cannot be compared; unmarked ones are trusted."""
    theirs, ours = encoder_of(queries, "qv"), encoder_of(collection, "embedding")
    if theirs and ours and theirs != ours:
        raise ValueError(f"queries were encoded by {theirs!r}, the collection by {ours!r}")


def _with_hashing(df: DataFrame, text: Column, dim: int) -> DataFrame:
    """Count tokens per bucket and scale to unit length.

    Spark puts texts in lower case; tasks take blocks of them apart and hash each different token of one once.
    """
    def hashed(texts: pa.Array) -> pa.Array:
        flat = unit_counts(texts, dim)
        return pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, dim, np.int32), pa.array(flat))

    return df.withColumn("_vector", F.arrow_udf(hashed, "array<float>")(token_text(text)))


def _encode_udf(
    factory: Callable[[], Encoder], dim: int, batch: int, budget: int | None, split_errors: bool
):
    def encode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = factory()  # once per task, not per batch

        def unit(texts: list[str]) -> np.ndarray:
            block = np.asarray(encoder(texts), dtype=np.float64)
            if block.shape != (len(texts), dim):
                raise ValueError(f"encoder returned {block.shape}, not {(len(texts), dim)}")
            norms = np.linalg.norm(block, axis=1, keepdims=True)
            return (block / np.where(norms == 0, 1, norms)).astype(np.float32)

        for column in columns:
            vectors, errors = call_in_batches(column.to_pylist(), unit, batch, budget, split_errors=split_errors)
            yield pa.StructArray.from_arrays(
                [pa.array(vectors, pa.list_(pa.float32())), pa.array(errors, pa.string())], names=["vector", "error"]
            )

    # The annotations are read at run time; postponed ones would be strings.
    encode.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(encode, "vector array<float>, error string")


def embed(
    df: DataFrame,
    encoder_factory: Callable[[], Encoder] | None = None,
    dim: int = EMBED_DIM,
    text: str = "text",
    encoder_id: str | None = None,
    batch: int = EMBED_BATCH,
    budget: int | None = None,
    errors: str | None = None,
) -> DataFrame:
    """Add ``embedding`` to rows that have none of the right width.

    ``encoder_factory`` makes, inside the task, a function from a list of texts to
    a matrix; its rows are scaled to unit length.  Without one, tokens are hashed:
    a lexical stand-in.  Rows that carry a vector keep it and are not encoded.

    A call has at most ``batch`` texts of similar length, and at most ``budget`` characters when
    all count as the longest.  A text that the encoder fails on fails the job, unless ``errors`` names
    a column for what went wrong: its row then has no vector.
    """
    if encoder_factory is not None and not encoder_id:
        raise ValueError("name the encoder with encoder_id")
    encoder_id = encoder_id or hashing_id(dim)
    columns = [c for c in df.columns if c not in ("embedding", errors)]
    stored = F.col("embedding") if "embedding" in df.columns else None
    needed = F.col(text)
    if stored is not None:
        known = encoder_of(df, "embedding")
        if known and known != encoder_id:
            raise ValueError(f"stored vectors are by {known!r}, not {encoder_id!r}")
        needed = F.when(~has_dim(stored, dim), needed)
    if encoder_factory is None:
        df = _with_hashing(df, needed, dim)
        wrong = F.lit(None).cast("string")
    else:
        encode = _encode_udf(encoder_factory, dim, batch, budget, errors is not None)
        df = df.withColumn("_encoded", encode(needed)).withColumn("_vector", F.col("_encoded.vector"))
        wrong = F.col("_encoded.error")
    vector = F.col("_vector")
    if stored is not None:
        vector = F.when(has_dim(stored, dim), stored).otherwise(vector)
    told = [wrong.alias(errors)] if errors else []
    return df.select(*columns, marked(vector, encoder_id, dim), *told)


def embed_queries(
    queries: DataFrame,
    encoder_factory: Callable[[], Encoder] | None = None,
    dim: int = EMBED_DIM,
    encoder_id: str | None = None,
) -> DataFrame:
    """``(qid, qtext, qv)`` from ``(qid, qtext)``, by the collection's encoder."""
    encoded = embed(queries, encoder_factory, dim, "qtext", encoder_id)
    return encoded.select("qid", "qtext", F.col("embedding").alias("qv"))


def missing_vectors(df: DataFrame, dim: int = EMBED_DIM) -> DataFrame:
    """Rows still to be embedded."""
    return df.where(~has_dim(F.col("embedding"), dim))
