"""Reading and writing each stage's table, and the life of a collection."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from passagelake.config import EMBED_DIM, INSERT_BATCH_ROWS
from passagelake.schema import CLEAN_PAGE, check_fields, checked, duplicate_keys
from passagelake.session import broadcast_if_small, scratch_path
from passagelake.sources import grouped

_BROKEN = "_corrupt_record"


def _is_path(target: str) -> bool:
    return "/" in target


def table_exists(spark: SparkSession, target: str) -> bool:
    """Whether a table of that name, or data at that path, is there."""
    if not _is_path(target):
        return spark.catalog.tableExists(target)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(path)


def read_table(spark: SparkSession, target: str) -> DataFrame:
    if grouped.is_grouped(spark, target):
        return grouped.read(spark, target)
    return spark.read.parquet(target) if _is_path(target) else spark.table(target)


def require(spark: SparkSession, target: str, step: str) -> DataFrame:
    """The table ``step`` writes, or an error that says to run it first."""
    if not table_exists(spark, target):
        raise ValueError(f"{target} not found. Run {step} first.")
    try:
        df = read_table(spark, target)
    except AnalysisException as error:
        raise ValueError(f"{target} cannot be read. Run {step} first.") from error
    if df.isEmpty():
        raise ValueError(f"{target} is empty. Run {step} first.")
    return df


def write_table(df: DataFrame, target: str, mode: str = "overwrite") -> str:
    """Write a stage's rows.  A table cannot be overwritten by what reads it."""
    writer = df.write.mode(mode)
    writer.parquet(target) if _is_path(target) else writer.saveAsTable(target)
    return target


def spread(df: DataFrame) -> DataFrame:
    """Use idle cores for an input of few splits; larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def write_counted(df: DataFrame, target: str, mode: str = "overwrite", **metrics: Column) -> dict[str, int]:
    """Write a table and tell ``metrics`` (aggregates) of its rows, observed by the one job that writes."""
    seen = Observation()
    write_table(df.observe(seen, *[m.alias(name) for name, m in metrics.items()]), target, mode)
    return seen.get


# --- pages ---------------------------------------------------------------------


def read_clean_pages(spark: SparkSession, folder: str, step: str = "the page step") -> DataFrame:
    """``(slug, url, title, text)`` from one JSON document per file; the stem is the slug.

    The job that reads a file which is no such document fails and names it;
    ``split_clean_pages`` sets those files apart.
    """
    pages = _page_files(spark, folder, step)
    message = F.concat(F.lit("page file "), "slug", F.lit(" is not a JSON document"))
    slug = F.when(~_broken(), F.col("slug")).otherwise(F.raise_error(message).cast("string"))
    return pages.select(slug.alias("slug"), "url", "title", "text")


def split_clean_pages(
    spark: SparkSession, folder: str, step: str = "the page step"
) -> tuple[DataFrame, DataFrame]:
    """(clean pages, ``(slug, reason)`` of files that are no JSON documents)."""
    pages = _page_files(spark, folder, step)
    good = pages.where(~_broken()).select("slug", "url", "title", "text")
    bad = pages.where(_broken()).select("slug", F.lit("not a JSON document").alias("reason"))
    return good, bad


def _broken() -> Column:
    """Whether a file could not be parsed.  Spark refuses a scan of the broken text alone, so
    a field stands beside it."""
    return F.length(F.concat_ws("", F.col(_BROKEN), F.substring("url", 1, 0))) > 0


def _page_files(spark: SparkSession, folder: str, step: str) -> DataFrame:
    if not table_exists(spark, folder):
        raise ValueError(f"{folder} not found. Run {step} first.")
    pages = (
        spark.read.schema(T.StructType([*CLEAN_PAGE, T.StructField(_BROKEN, T.StringType())]))
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", _BROKEN)
        .option("pathGlobFilter", "*.json")
        .json(folder)
    )
    stem = F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1)
    # File names come with %XX; a plus sign in them is one.
    slug = F.url_decode(F.replace(stem, F.lit("+"), F.lit("%2B")))
    pages = pages.select(slug.alias("slug"), "url", "title", "text", _BROKEN)
    if pages.isEmpty():
        raise ValueError(f"No pages found in {folder}. Run {step} first.")
    return pages


def write_page_files(pages: DataFrame, folder: str) -> str:
    """One JSON document per page, in a file named after its slug; slugs are unique.

    Tasks write their pages' files; a repeated task writes the same ones again.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = (LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/"))
        if not folder.startswith(("/", "file:")):
            files, at = FileSystem.from_uri(folder)
        files.create_dir(at, recursive=True)
        for batch in batches:
            for slug, *fields in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page = dict(zip(("url", "title", "text"), fields, strict=True))
                if "/" in slug:
                    raise ValueError(f"slug {slug!r} can't name a file")
                with files.open_output_stream(f"{at}/{slug}.json") as out:
                    out.write(json.dumps(page, ensure_ascii=False, indent=2).encode())
            yield batch.select(["slug"])

    pages.select("slug", "url", "title", "text").mapInArrow(write, "slug string").write.format("noop").mode("overwrite").save()
    return folder


def write_clean_pages(pages: DataFrame, folder: str, mode: str = "overwrite") -> str:
    """Clean pages as UTF-8 JSON lines, many per file, with the slug as a field."""
    pages.select("slug", "url", "title", "text").write.mode(mode).json(folder)
    return folder


def read_page_lines(spark: SparkSession, folder: str) -> DataFrame:
    """What ``write_clean_pages`` wrote."""
    return spark.read.schema("slug string, url string, title string, text string").json(folder)


# --- collections ---------------------------------------------------------------


def _write_collection(
    collection: DataFrame, target: str, mode: str, dim: int, batch_rows: int
) -> None:
    rows = checked(collection, dim)
    partitioned = "cid" in rows.columns
    if partitioned:
        # Evens out file sizes: crowded buckets are split, thin ones share a task.
        rows = rows.hint("rebalance", "cid")
    writer = rows.write.mode(mode).option("maxRecordsPerFile", batch_rows)
    if partitioned:
        writer = writer.partitionBy("cid")
    writer.parquet(target) if _is_path(target) else writer.saveAsTable(target)


def _refuse(keys: DataFrame, why: str) -> None:
    found = keys.select("id").head(1)
    if found:
        raise ValueError(f"key {found[0][0]!r} is {why}")


def create_collection(
    collection: DataFrame, target: str, dim: int = EMBED_DIM, batch_rows: int = INSERT_BATCH_ROWS,
    sizes: list[tuple[int, int]] | None = None,
) -> str:
    """Drop what is at ``target`` and write the collection anew.

    Rows are checked while they are written; with ``cid`` present the table is
    laid out by bucket, so that a search reads probed buckets only: at a path in groups of
    buckets and in versions.  Repeated keys are refused before anything is written.  ``sizes`` are
    about the rows of each bucket, ``(cid, rows)``, if known; else rows are counted first.
    """
    _refuse(duplicate_keys(collection.select("id")), "repeated in the rows")
    if _is_path(target) and "cid" in collection.columns:
        return grouped.create(checked(collection, dim).drop("grp"), target, batch_rows, sizes=sizes)
    _write_collection(collection, target, "overwrite", dim, batch_rows)
    return target


def insert_rows(
    rows: DataFrame, target: str, dim: int = EMBED_DIM, batch_rows: int = INSERT_BATCH_ROWS
) -> str:
    """Append checked rows.  Keys that repeat or are stored are refused; ``upsert_rows`` replaces."""
    spark = rows.sparkSession
    by_group = grouped.is_grouped(spark, target)
    stored = read_table(spark, target).drop("grp")
    if set(stored.columns) != set(rows.columns):
        raise ValueError(f"the collection has {stored.columns}, the rows {rows.columns}")
    _refuse(duplicate_keys(rows.select("id")), "repeated in the rows")
    if by_group:
        _refuse(grouped.stored_keys(rows.select("id"), target), "already stored")
        return grouped.append(checked(rows.select(*stored.columns), dim), target, batch_rows)
    _refuse(stored.select("id").join(broadcast_if_small(rows.select("id")), "id", "left_semi"), "already stored")
    _write_collection(rows.select(*stored.columns), target, "append", dim, batch_rows)
    return target


def drop_collection(spark: SparkSession, name: str) -> None:
    """Drop a named collection; one kept at a path is replaced by creating it again."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def load_collection(
    spark: SparkSession, target: str, keep_in_memory: bool = False, step: str = "the index step"
) -> DataFrame:
    """The stored collection; memory-resident, spilling to disk, if asked for."""
    df = require(spark, target, step)
    return df.persist(StorageLevel.MEMORY_AND_DISK) if keep_in_memory else df


def upsert(collection: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` plus every stored row whose key they do not replace.

    Both have the same columns.  Of rows that share a key, the one that is last by
    text, url and title is taken.
    """
    check_fields(collection)
    check_fields(rows)
    if set(collection.columns) != set(rows.columns):
        raise ValueError(f"the collection has {collection.columns}, the rows {rows.columns}")
    order = Window.partitionBy("id").orderBy(F.desc("text"), F.desc("url"), F.desc("title"))
    rows = rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    keys = broadcast_if_small(rows.select("id"))
    return collection.join(keys, "id", "left_anti").select(*collection.columns).unionByName(rows)


def upsert_rows(
    rows: DataFrame, target: str, dim: int = EMBED_DIM, centroids: DataFrame | None = None,
    batch_rows: int = INSERT_BATCH_ROWS, gone: DataFrame | None = None,
) -> str:
    """Store ``upsert`` of the collection: of one by bucket only the groups it touches are
    rewritten, as a new version that readers see when it is complete.

    Rows without a bucket get theirs from ``centroids``, which may be those of a two-level index.
    Stored rows whose ``id`` is in ``gone`` go.
    """
    spark = rows.sparkSession
    by_group = grouped.is_grouped(spark, target)
    stored = read_table(spark, target)
    if "cid" in stored.columns and "cid" not in rows.columns:
        if centroids is None:
            raise ValueError("the collection has buckets: give rows with cid, or the centroids")
        from passagelake.operators.two_level import assigned

        rows = assigned(rows, centroids)
    # The new rows are read several times; what replaces a table can't read it.
    rows = read_table(spark, write_table(checked(rows, dim), scratch_path(spark, "upsert")))
    gone = rows.select("id").limit(0) if gone is None else gone.select("id")
    replaced = rows.select("id").union(gone)
    if not by_group:
        left = stored.join(broadcast_if_small(gone), "id", "left_anti").select(*stored.columns)
        merged = write_table(upsert(left, rows), scratch_path(spark, "upsert"))
        _write_collection(read_table(spark, merged), target, "overwrite", dim, batch_rows)
        return target
    held = stored.select("id", "grp").join(broadcast_if_small(replaced), "id", "left_semi").select("grp")
    placed = rows.select(grouped.group_of(F.col("cid"), stored.schema["grp"].metadata["firsts"]).alias("grp"))
    touched = [r[0] for r in held.union(placed).distinct().collect()]  # numbers of groups
    part = stored.where(F.col("grp").isin(touched)).drop("grp")
    part = part.join(broadcast_if_small(gone), "id", "left_anti").select(*part.columns)
    return grouped.replace_groups(upsert(part, rows), touched, rows.select("id"), target, batch_rows)
