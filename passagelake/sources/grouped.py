"""A collection laid out in few folders: groups of neighbouring buckets, in versions.

* *Groups.*  Buckets are packed in the order of their numbers into at most ``MAX_GROUPS`` groups of
  about equal size; a folder holds a group, however many buckets there are.  Rows lie
  sorted by bucket and url, so a search for some buckets reads their groups, and in these the row
  groups whose statistics show the buckets.  Files carry Bloom filters of id, url and title.
* *Versions.*  Every write goes to folders of its own.  A manifest lists the folders that are the
  collection; the newest complete one counts, so a write that fails half-way leaves the collection
  as it was.  One writer at a time is assumed.  ``drop_old_versions`` removes what no
  manifest in use lists.
* *Keys.*  Beside the rows lies a blocked Bloom filter of their ids, one table for each write that added
  some.  An insert asks the filters about its keys by a join on blocks, and reads stored ids only for keys
  that the filters don't rule out.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from passagelake.session import broadcast_if_small, small_table

MAX_GROUPS = 200
#: Rows below which a further group isn't worth a folder.
LEAST_ROWS = 2_048
#: Bytes of a Parquet row group: what statistics on the bucket can skip.
ROW_GROUP_BYTES = 16 << 20
#: The key filter: keys in a block of 8 words of 64 bits, and bits set for a key.
BLOCK_KEYS, WORDS, PROBES = 20, 8, 7
#: Tables of keys that an insert may ask one by one; more are put together first.
KEY_TABLES = 16
#: Keys that are looked for by a filter that reaches the files.
FEW_KEYS = 10


# --- folders ---------------------------------------------------------------------


def _files(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def _names(spark: SparkSession, path: str) -> list[str]:
    files, at = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    names = (n.removeprefix(prefix) for n in _names(spark, path) if n.startswith(prefix))
    return sorted(int(n) for n in names if n.isdigit())


def _manifests(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete manifests; one being written has another name."""
    names = (n.removesuffix(".json") for n in _names(spark, f"{path}/manifests") if n.endswith(".json"))
    return sorted(int(n) for n in names if n.isdigit())


def is_grouped(spark: SparkSession, path: str) -> bool:
    return "/" in path and bool(_manifests(spark, path))


def _entries(spark: SparkSession, path: str) -> list[tuple]:
    """``(kind, version, number)`` of the newest manifest: folders of rows by group and version,
    tables of keys with their number of blocks, and the first bucket of each group; a few hundred."""
    files, at = _files(spark, f"{path}/manifests/{_manifests(spark, path)[-1]}.json")
    stream = files.open(at)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return [tuple(e) for e in json.loads(text)]


def _switch(spark: SparkSession, path: str, entries: list[tuple]) -> None:
    """From here on the collection is what ``entries`` list: the manifest gets its name when it is whole."""
    number = max(_manifests(spark, path), default=-1) + 1
    files, draft = _files(spark, f"{path}/manifests/{number}.draft")
    _, final = _files(spark, f"{path}/manifests/{number}.json")
    stream = files.create(draft, True)
    stream.write(bytearray(json.dumps(sorted(entries)).encode()))
    stream.close()
    if not files.rename(draft, final):
        raise OSError(f"manifest {number} of {path} could not be named")


def _next_version(spark: SparkSession, path: str) -> int:
    """A version that no earlier write has used, failed ones included."""
    used = _numbers(spark, f"{path}/rows", "version=") + _numbers(spark, f"{path}/keys", "version=")
    return max(used, default=0) + 1


def drop_old_versions(spark: SparkSession, path: str) -> int:
    """Remove the folders that the current manifest doesn't list; how many it were."""
    entries, removed = _entries(spark, path), 0
    kept = {(kind, version, number if kind == "rows" else None) for kind, version, number in entries}

    def drop(folder: str) -> None:
        nonlocal removed
        files, at = _files(spark, folder)
        removed += bool(files.delete(at, True))

    for version in _numbers(spark, f"{path}/rows", "version="):
        folder = f"{path}/rows/version={version}"
        groups = _numbers(spark, folder, "grp=")
        listed = [g for g in groups if ("rows", version, g) in kept]
        for group in groups:
            if listed and group not in listed:
                drop(f"{folder}/grp={group}")
        if not listed:
            drop(folder)
    for version in _numbers(spark, f"{path}/keys", "version="):
        if ("keys", version, None) not in kept:
            drop(f"{path}/keys/version={version}")
    for number in _manifests(spark, path)[:-1]:
        drop(f"{path}/manifests/{number}.json")
    return removed


# --- groups ----------------------------------------------------------------------


def packed(sizes: list[tuple[int, int]], groups: int = MAX_GROUPS, least: int = LEAST_ROWS) -> list[int]:
    """The first bucket of each group, for ``(bucket, rows)`` in order."""
    aim = max(least, -(-sum(n for _, n in sizes) // max(1, groups // 2)))
    firsts, filled = [], 0
    for cid, n in sorted(sizes):
        if not firsts or (filled and filled + n > aim):
            firsts.append(cid)
            filled = 0
        filled += n
    return firsts or [0]


def group_of(cid: Column, firsts: list[int]) -> Column:
    """The group of a bucket; what lies before the first belongs to it."""
    starts = F.array(*[F.lit(f) for f in firsts[1:]]) if len(firsts) > 1 else F.array().cast("array<int>")
    return F.size(F.filter(starts, lambda s: s <= cid))


def groups_of(cids: list[int], firsts: list[int]) -> list[int]:
    return sorted({max(0, bisect_right(firsts, c) - 1) for c in cids})


def in_groups(rows: DataFrame, cids: list[int]) -> DataFrame:
    """Only the groups that hold these buckets, which prunes folders; other layouts as they are."""
    firsts = rows.schema["grp"].metadata.get("firsts") if "grp" in rows.columns else None
    return rows if firsts is None else rows.where(F.col("grp").isin(groups_of(cids, firsts)))


def _write_rows(rows: DataFrame, path: str, version: int, firsts: list[int], batch_rows: int) -> list[tuple]:
    spark, folder = rows.sparkSession, f"{path}/rows/version={version}"
    writer = (
        rows.withColumn("grp", group_of(F.col("cid"), firsts)).hint("rebalance", "grp")
        .sortWithinPartitions("grp", "cid", "url").write.option("maxRecordsPerFile", batch_rows)
        .option("parquet.block.size", ROW_GROUP_BYTES)
    )
    # A dictionary of the numbers of vectors saves little room for the time that looking them up takes.
    writer = writer.option("parquet.enable.dictionary#embedding.list.element", "false")
    for column in ("id", "url", "title"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.partitionBy("grp").parquet(folder)
    return [("rows", version, g) for g in _numbers(spark, folder, "grp=")]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The collection as the newest manifest lists it, with its bucket and group."""
    entries = _entries(spark, path)
    folders = [f"{path}/rows/version={v}/grp={g}" for kind, v, g in entries if kind == "rows"]
    firsts = [n for _, n in sorted((g, n) for kind, g, n in entries if kind == "first")]
    if not folders:
        first = _numbers(spark, f"{path}/rows", "version=")[0]
        empty = spark.read.parquet(f"{path}/rows/version={first}").limit(0)
        return _with_firsts(empty, firsts)
    rows = spark.read.option("basePath", f"{path}/rows").parquet(*folders)
    return _with_firsts(rows.drop("version"), firsts)


def _with_firsts(rows: DataFrame, firsts: list[int]) -> DataFrame:
    columns = [c for c in rows.columns if c != "grp"]
    return rows.select(*columns, F.col("grp").cast("int").alias("grp", metadata={"firsts": firsts}))


# --- keys ------------------------------------------------------------------------


def _bits() -> list[Column]:
    """The numbers of a key's bits in its block, of which some may be the same."""
    place = F.xxhash64("id", F.lit(1))
    return [F.shiftrightunsigned(place, 9 * i).bitwiseAND(F.lit(64 * WORDS - 1)) for i in range(PROBES)]


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")


def _probes(keys: DataFrame, blocks: int) -> DataFrame:
    """``(id, block, word, bit, n)``: the bits of each key, and how many these are."""
    placed = keys.select("id", _block(blocks), F.array_distinct(F.array(*_bits())).alias("bits"))
    each = placed.select("id", "block", F.size("bits").alias("n"), F.explode("bits").alias("b"))
    masks = F.array(*[F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)])
    bit = F.get(masks, F.col("b").bitwiseAND(F.lit(63)).cast("int"))
    return each.select("id", "block", F.shiftright("b", 6).cast("int").alias("word"), bit.alias("bit"), "n")


def _key_words(ids: DataFrame, blocks: int) -> DataFrame:
    """``(block, word, bits)`` of the filter; a key stays one row until the words of its block are whole."""

    def mask(w: int, i: int) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(f"bit {i}").bitwiseAND(F.lit(63)).cast("int"))
        return F.when(F.shiftright(f"bit {i}", 6) == w, bit).otherwise(F.lit(0).cast("bigint"))

    def word(w: int) -> Column:
        return reduce(Column.bitwiseOR, [mask(w, i) for i in range(PROBES)])

    names = [f"word {w}" for w in range(WORDS)]
    placed = ids.select(_block(blocks), *[b.alias(f"bit {i}") for i, b in enumerate(_bits())])
    masks = placed.select("block", *[word(w).alias(name) for w, name in enumerate(names)])
    whole = masks.groupBy("block").agg(*[F.bit_or(name).alias(name) for name in names])
    words = F.array(*[F.struct(F.lit(w).alias("word"), F.col(name).alias("bits")) for w, name in enumerate(names)])
    return whole.select("block", F.inline(words)).where("bits <> 0")


def _write_keys(ids: DataFrame, path: str, version: int, n: int | None = None) -> tuple:
    blocks = max(1, -(-(ids.count() if n is None else n) // BLOCK_KEYS))
    _key_words(ids, blocks).sortWithinPartitions("block", "word").write.parquet(f"{path}/keys/version={version}")
    return ("keys", version, blocks)


def possible_keys(ids: DataFrame, path: str) -> DataFrame:
    """Those of ``ids`` that the filters of stored keys don't rule out: all stored ones, few others."""
    spark = ids.sparkSession
    found, tables = ids.limit(0).select("id"), [e for e in _entries(spark, path) if e[0] == "keys"]
    if not tables:
        return ids.select("id").distinct()
    for _, version, blocks in tables:
        stored = spark.read.parquet(f"{path}/keys/version={version}")
        met = stored.join(broadcast_if_small(_probes(ids, blocks)), ["block", "word"])
        hits = met.where(F.col("bits").bitwiseAND(F.col("bit")) != 0).groupBy("id", "n").agg(F.count("*").alias("hits"))
        found = found.union(hits.where("hits = n").select("id"))
    return found.distinct()


def stored_keys(ids: DataFrame, path: str) -> DataFrame:
    """Those of ``ids`` that are stored; stored ids are read only if a filter lets some pass."""
    spark = ids.sparkSession
    possible = possible_keys(ids, path)
    known = small_table(possible)
    if known is None:
        return read(spark, path).select("id").join(possible, "id", "left_semi")
    if not known.num_rows:
        return ids.limit(0).select("id")
    if known.num_rows <= FEW_KEYS:  # compared with the files' own Bloom filters
        return read(spark, path).select("id").where(F.col("id").isin(known["id"].to_pylist()))
    asked = F.broadcast(spark.createDataFrame(known, possible.schema))
    return read(spark, path).select("id").join(asked, "id", "left_semi")


# --- the life of a collection --------------------------------------------------------


def create(
    rows: DataFrame, path: str, batch_rows: int, firsts: list[int] | None = None, keys: bool = True,
    sizes: list[tuple[int, int]] | None = None,
) -> str:
    """Write ``rows`` with their bucket ``cid`` as the collection at ``path``, whatever was there.

    ``firsts`` are the first buckets of the groups, if known; else buckets are packed by their rows, which
    ``sizes`` tell about; without it they are counted.
    Without ``keys`` there is no filter of ids, and all stored ids count as possible.
    """
    spark, total = rows.sparkSession, None
    if firsts is None and sizes:
        firsts = packed(sizes)
        missing = F.raise_error(F.lit("rows without a bucket have no place in a collection by bucket")).cast("int")
        rows = rows.withColumn("cid", F.coalesce("cid", missing))
    if firsts is None:
        sizes = [tuple(r) for r in rows.groupBy("cid").agg(F.count("*").alias("n")).collect()]  # one a bucket
        if any(cid is None for cid, _ in sizes):
            raise ValueError("rows without a bucket have no place in a collection by bucket")
        firsts, total = packed(sizes), sum(n for _, n in sizes)
    version = _next_version(spark, path)
    entries = _write_rows(rows, path, version, firsts, batch_rows)
    if keys:
        entries.append(_write_keys(read_version(spark, path, version).select("id"), path, version, total))
    _switch(spark, path, entries + [("first", g, n) for g, n in enumerate(firsts)])
    return path


def read_version(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/rows/version={version}")


def append(rows: DataFrame, path: str, batch_rows: int) -> str:
    """Add rows whose keys are known to be new."""
    spark = rows.sparkSession
    entries, version = _entries(spark, path), _next_version(spark, path)
    firsts = [n for _, n in sorted((g, n) for kind, g, n in entries if kind == "first")]
    entries += _write_rows(rows, path, version, firsts, batch_rows)
    _add_keys(read_version(spark, path, version).select("id"), path, version, entries)
    _switch(spark, path, entries)
    return path


def _add_keys(ids: DataFrame, path: str, version: int, entries: list[tuple]) -> None:
    """A table of keys for new ids, or one of all ids if there are many tables."""
    spark = ids.sparkSession
    tables = [e for e in entries if e[0] == "keys"]
    if not tables:  # made without a filter
        return
    if len(tables) < KEY_TABLES:
        entries.append(_write_keys(ids, path, version))
        return
    for table in tables:
        entries.remove(table)
    listed = [f"{path}/rows/version={v}/grp={g}" for kind, v, g in entries if kind == "rows"]
    entries.append(_write_keys(spark.read.parquet(*listed).select("id"), path, version))


def replace_groups(
    merged: DataFrame, groups: list[int], new_ids: DataFrame, path: str, batch_rows: int
) -> str:
    """``merged`` becomes all that ``groups`` hold; other groups stay as they are.

    ``new_ids`` are those that may not have been stored; keys that are gone stay in the filter, which
    only costs a look at the rows.
    """
    spark = merged.sparkSession
    version = _next_version(spark, path)
    entries = [e for e in _entries(spark, path) if not (e[0] == "rows" and e[2] in groups)]
    firsts = [n for _, n in sorted((g, n) for kind, g, n in entries if kind == "first")]
    entries += _write_rows(merged.select(*[c for c in merged.columns if c != "grp"]), path, version, firsts, batch_rows)
    _add_keys(new_ids, path, version, entries)
    _switch(spark, path, entries)
    return path
