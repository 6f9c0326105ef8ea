"""Session helpers: where to write shared scratch tables, and checked small collects."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from passagelake.config import SMALL_SIDE_BYTES, SMALL_SIDE_ROWS


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only a local session may leave it unset; it then gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="passagelake-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()


def small_table(
    df: DataFrame, rows: int = SMALL_SIDE_ROWS, size: int = SMALL_SIDE_BYTES
) -> pa.Table | None:
    """``df`` on the driver, or None if it is larger than a task may be sent whole.

    One number a row, its bytes, is looked at first and no further than the limit, so that a
    large input costs a look at some of its partitions.  Vectors whose width the column's
    metadata tells are not computed for that.  Only what is within both limits is fetched.
    """
    open_ = [_bytes_of(f) for f in df.schema if "dim" not in f.metadata] or [F.lit(0)]
    found = df.select(sum(open_[1:], open_[0]).alias("bytes")).take(rows + 1)
    if len(found) > rows:
        return None
    known = sum(r[0] for r in found) + sum(8 * len(found) * f.metadata.get("dim", 0) for f in df.schema)
    return df.toArrow() if known <= size else None


def _bytes_of(field: T.StructField) -> Column:
    """About the bytes that a value of this column takes."""
    if isinstance(field.dataType, T.ArrayType):
        return F.coalesce(8 * F.size(field.name), F.lit(0))
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(field.name), F.lit(0))
    return F.lit(8)


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` fetched and marked for broadcast if small, else as it is.

    Sizes of aggregates are only guessed before they run; without this, a large
    table may be shuffled to meet a handful of rows.
    """
    table = small_table(df)
    return df if table is None else F.broadcast(df.sparkSession.createDataFrame(table, df.schema))
